from __future__ import annotations

from collections import Counter

#: Nulls, blanks, ties, repeated rows, one long text.
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "b"), (4, "one", "en", "a"),
    (5, "One two three four", "en", None), (6, "one two three four", "fr", "b"), (6, "one two three four", "fr", "b"),
    (7, "x" * 100_000, None, "a"), (8, "a b c d e f g h " * 4_000, "de", "a"), (None, "one two three four", "en", "c"),
    (9, "naïve Émile ﬀ 漢字 🙂 #tag", "fr", "b"),
]


def bag(rows):
    return Counter(map(tuple, rows))
