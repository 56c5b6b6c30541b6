"""A prefix tree of integer sets and the similarity join over it.

Sets are written in one order of their tokens, so sets with the same beginning share a
path. Paths without branches are one edge. A probe walks the tree in steps of up to STEP
tokens and carries its overlap with the path; all branches of a step are one array
operation. A branch goes when the overlap so far plus what the path or the probe has left
can't reach the threshold. Rare tokens come first: sets that differ do so early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEP = 32


def _ranks(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets over 0..V-1, rare tokens first, each in rising order."""
    tokens = np.concatenate(sets)
    tokens.sort()
    first = np.concatenate([[True], tokens[1:] != tokens[:-1]])[:len(tokens)]
    count = np.diff(np.append(np.flatnonzero(first), len(tokens)))
    tokens = tokens[first]
    # a chunk has few enough tokens for half the bytes; of equal counts the lesser token comes first
    order = np.empty(len(tokens), dtype=np.int32)
    order[np.argsort(count, kind="stable")] = np.arange(len(tokens), dtype=np.int32)
    return [np.sort(order[np.searchsorted(tokens, s)]) for s in sets]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class Trie:
    """Sets in lexicographic order; `place` gives each one's position in the input."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        ranks = _ranks(sets)
        self.place = sorted(range(len(sets)), key=lambda i: ranks[i].astype(">u4").tobytes())
        self.sets = [ranks[i] for i in self.place]
        del ranks
        self.size = np.array([len(s) for s in self.sets], dtype=np.int64)
        depth, parent, low, high, holds = [0], [0], [0], [len(sets) - 1], [-1]
        path, stack = [0], [0]

        def add(d: int, p: int, first: int, own: int, of: int) -> int:
            depth.append(d), parent.append(p), low.append(first), high.append(-1), holds.append(own), path.append(of)
            return len(depth) - 1

        for i, s in enumerate(self.sets):
            common = _shared(self.sets[i - 1], s) if i else 0
            last = 0
            while depth[stack[-1]] > common:
                last = stack.pop()
                high[last] = i - 1
            if depth[stack[-1]] < common:
                node = add(common, stack[-1], low[last], -1, i - 1)
                parent[last] = node
                stack.append(node)
            stack.append(add(len(s), stack[-1], i, i, i))
        for node in stack:
            high[node] = len(sets) - 1
        self.depth, self.parent = np.array(depth), np.array(parent)
        self.low, self.high, self.holds = np.array(low), np.array(high), np.array(holds)
        pieces = [self.sets[path[v]][depth[parent[v]]:depth[v]] for v in range(1, len(depth))]
        lengths = np.array([0] + [len(x) for x in pieces])
        self.edge_end = np.cumsum(lengths)
        self.edge_start = self.edge_end - lengths
        self.edges = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        self.shortest = np.array([self.size[a:b + 1].min() for a, b in zip(low, high)])
        self.longest = np.array([self.size[a:b + 1].max() for a, b in zip(low, high)])
        self.children = np.argsort(self.parent[1:], kind="stable") + 1
        counts = np.bincount(self.parent[1:], minlength=len(depth))
        self.child_end = np.cumsum(counts)
        self.child_start = self.child_end - counts
        self.inside = np.zeros(int(self.edges.max()) + 1 if len(self.edges) else 1, dtype=bool)

    def _under(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All children of the nodes, and which of the nodes each one is under."""
        count = self.child_end[nodes] - self.child_start[nodes]
        of = np.repeat(np.arange(len(nodes)), count)
        at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.child_start[nodes], count)
        return self.children[at], of

    def links(self, i: int, label: np.ndarray | None, wanted: np.ndarray | None, num: int, den: int) -> np.ndarray:
        """Sets after the i-th, not yet under its label (if there are labels), whose overlap is num/den of the union or more."""
        probe = self.sets[i]
        n = len(probe)
        fewest, most = -(-num * n // den), den * n // num
        self.inside[probe] = True
        found = []
        nodes = self._under(np.zeros(1, dtype=np.int64))[0]
        overlap = done = np.zeros(len(nodes), dtype=np.int64)
        while len(nodes):
            single = self.low[nodes] == self.high[nodes]
            keep = (self.high[nodes] > i) & (self.longest[nodes] >= fewest) & (self.shortest[nodes] <= most)
            if label is not None:
                keep &= ~(single & (label[self.low[nodes]] == label[i]))
            if wanted is not None:
                keep &= ~(single & ~wanted[self.low[nodes]])
            nodes, overlap, done = nodes[keep], overlap[keep], done[keep]
            if not len(nodes):
                break
            start = self.edge_start[nodes] + done
            length = np.minimum(self.edge_end[nodes] - start, STEP)
            offset = np.cumsum(length) - length
            at = np.arange(int(length.sum())) + np.repeat(start - offset, length)
            overlap = overlap + np.add.reduceat(self.inside[self.edges[at]].astype(np.int64), offset)
            done = done + length
            ended = start + length == self.edge_end[nodes]
            so_far = self.depth[self.parent[nodes]] + done
            passed = np.searchsorted(probe, self.edges[start + length - 1], side="right")
            reach = overlap + np.minimum(self.longest[nodes] - so_far, n - passed)
            need = -(-num * (n + np.maximum(self.shortest[nodes], fewest)) // (num + den))
            keep = reach >= need
            nodes, overlap, done, ended, so_far = nodes[keep], overlap[keep], done[keep], ended[keep], so_far[keep]
            own = self.holds[nodes]
            linked = ended & (own > i) & (den * overlap >= num * (n + so_far - overlap))
            found.append(own[linked])
            below, of = self._under(nodes[ended])
            nodes = np.concatenate([nodes[~ended], below])
            overlap = np.concatenate([overlap[~ended], overlap[ended][of]])
            done = np.concatenate([done[~ended], np.zeros(len(below), dtype=np.int64)])
        self.inside[probe] = False
        out = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        return out if wanted is None else out[wanted[out]]


def every(sets: list[np.ndarray], num: int, den: int, sides: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """All links between the sets, each once: a set, and those that it is linked with. `sides` as in `join`."""
    if len(sets) < 2:
        return
    trie = Trie(sets)
    place = np.array(trie.place)
    side = None if sides is None else np.asarray(sides)[place]
    for i in range(len(sets) - 1):
        found = trie.links(i, None, None if side is None else side != side[i], num, den)
        if len(found):
            yield int(place[i]), place[found]


def join(sets: list[np.ndarray], num: int, den: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Enough links (i, j) between the sets to connect all that are linked, at most one fewer than sets.

    With `sides`, only links between sets of different sides count.
    """
    if len(sets) < 2:
        return []
    trie = Trie(sets)
    label = np.arange(len(sets))
    side = None if sides is None else np.asarray(sides)[trie.place]
    out = []
    for i in range(len(sets) - 1):
        if (label == label[i]).all():
            break
        wanted = None if side is None else side != side[i]
        for j in trie.links(i, label, wanted, num, den):
            if label[j] != label[i]:
                out.append((trie.place[i], trie.place[int(j)]))
                label[label == label[j]] = label[i]
    return out
