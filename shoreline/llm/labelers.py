"""Candidate spans of personal data, and the labelers that vote on them.

Plain functions over one text. Every scan is linear in the text: candidates are found from what they can't
lack (an @, a digit run, a plus sign, a colon), and all that looks around them is bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate
from typing import NamedTuple
from zlib import crc32

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# --- fixed values: gazetteers and cue words ------------------------------------------------------

TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz io dev app ai co me tv eu de fr es it nl be at ch uk ie pt pl cz se no fi dk "
    "ru ua tr gr hu ro bg jp cn kr in id vn th my sg au nz ca us mx br ar cl za eg ng ke il sa ae example test".split())
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98 212 213 216 218 234 254 255 256 351 352 353 354 358 359 370 371 372 380 381 385 386 420 421 "
    "852 855 856 880 886 961 962 963 964 965 966 968 971 972 973 974 977 992 993 994 995 996 998".split())
#: First digits of card numbers, as ranges of their first four, with the lengths in use.
CARD_RANGES = (
    (2221, 2720, (16,)), (3000, 3059, (14,)), (3400, 3499, (15,)), (3528, 3589, (16,)), (3600, 3699, (14,)),
    (3700, 3799, (15,)), (3800, 3899, (14,)), (4000, 4999, (13, 16, 19)), (5100, 5599, (16,)), (6011, 6011, (16, 19)),
    (6200, 6299, (16, 17, 18, 19)), (6440, 6599, (16, 19)),
)
CUES = (
    frozenset("email e-mail mail mailto contact write reach correo courriel send".split()),
    frozenset("ip ipv4 ipv6 address host server addr client gateway dns from login".split()),
    frozenset("card visa mastercard amex credit debit payment paid tarjeta carte karte pan".split()),
    frozenset("phone tel telephone call mobile cell fax whatsapp telefon teléfono téléphone ring dial".split()),
)
AGAINST = frozenset("version v release isbn issn doi order invoice section chapter page figure table item id no nr lot sku serial rfc".split())

# --- patterns --------------------------------------------------------------------------------------

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
SPELT_AT = re.compile(r"\s?[(\[{] ?at ?[)\]}]\s?| at ")
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[(\[{] ?dot ?[)\]}]\s?| dot )[A-Za-z0-9-]{1,63}){1,5}")
SPELT_DOT = re.compile(r"[(\[{] ?dot ?[)\]}]| dot ")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SIX = re.compile(r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}")
CHAIN = re.compile(r"[0-9]([\x20-]?[0-9])+")
GROUP = re.compile(r"[0-9]+")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PLUS_SHAPE = re.compile(r"\+[0-9]{1,3}(?![0-9])[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4}(?![0-9]))(?:[ .-]?[0-9]{2,4}(?![0-9])){1,4}|\+[0-9]{8,15}(?![0-9])")
LOCAL_PHONE = re.compile(
    r"(?<![0-9+])(?:\([0-9]{2,4}\) ?[0-9]{3,4}[ .-]?[0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}|00[1-9][0-9]{0,2}(?:[ .-][0-9]{2,4}){2,4})(?![0-9])")
ANY = re.compile(r"[0-9@:]| at |[(\[{] ?at ?[)\]}]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(GROUP.findall(text))


# --- base: what always counts ----------------------------------------------------------------------


def base_emails(text: str) -> list[tuple[int, int]]:
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        # what lies before the next @ belongs to no earlier match
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))
    return out


def base_ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in DOTTED.finditer(text):
        parts = list(GROUP.finditer(text, m.start(), m.end()))
        for i in range(0, len(parts) - 3, 4):
            if all(len(x := p[0].lstrip("0")) <= 3 and int(x or 0) <= 255 for p in parts[i:i + 4]):
                out.append((parts[i].start(), parts[i + 3].end()))
    return out


def base_cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CHAIN.finditer(text) if 16 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)]


def base_phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PLUS.finditer(text) if 8 <= len(_only_digits(m[0])) <= 15]


# --- candidates beyond the base --------------------------------------------------------------------
# `starts` are the first positions of all base spans, sorted.


def more_emails(text: str, starts: list[int]) -> list[tuple[int, int]]:
    out = []
    for m in SPELT_AT.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and LOCAL.match(text, start - 1):
            start -= 1
        d = SPELT_DOMAIN.match(text, m.end())
        # the bare word is a sign only with a spelt dot
        if start < m.start() and d and ("at" != m[0].strip() or SPELT_DOT.search(d[0])):
            out.append((start, d.end()))
    return out


def more_ips(text: str, starts: list[int]) -> list[tuple[int, int]]:
    return [m.span() for m in SIX.finditer(text) if m[0].count(":") == 7 or "::" in m[0]]


def more_cards(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """Numbers of 13 to 19 digits: a group by itself, or four of four, or 4-6-5, within a longer chain too."""
    out = []
    for chain in CHAIN.finditer(text):
        if chain.end() - chain.start() < 13:
            continue
        groups = list(GROUP.finditer(text, chain.start(), chain.end()))
        i = 0
        while i < len(groups):
            sizes = [g.end() - g.start() for g in groups[i:i + 4]]
            if 13 <= sizes[0] <= 19:
                take = 1
            elif sizes == [4, 4, 4, 4]:
                take = 4
            elif sizes[:3] == [4, 6, 5]:
                take = 3
            else:
                i += 1
                continue
            out.append((groups[i].start(), groups[i + take - 1].end()))
            i += take
    return out


def more_phones(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """Numbers of 7 to 15 digits; one with a plus ends before the next base span."""
    found = [m.span() for m in LOCAL_PHONE.finditer(text)]
    at = text.find("+")
    while at >= 0:
        k = bisect_left(starts, at + 1)
        if m := PLUS_SHAPE.match(text, at, starts[k] if k < len(starts) else len(text)):
            found.append(m.span())
        at = text.find("+", at + 1)
    return [(a, b) for a, b in found if 7 <= len(_only_digits(text[a:b])) <= 15]


BASE = (base_emails, base_ips, base_cards, base_phones)
MORE = (more_emails, more_ips, more_cards, more_phones)

# --- labelers --------------------------------------------------------------------------------------
# Each says 1 (personal data), -1 (not) or 0 (can't tell).

STRICT = (
    re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"),
    re.compile(r"(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"),
    re.compile(r"[0-9]{15,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ -])[0-9]{6}\2[0-9]{5}"),
    re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{4}"),
)
FIVES = re.compile(r"\w+(?:-\w+)?")


def shape(kind: int, span: str) -> int:
    """Regular expression: the usual way to write it."""
    return 1 if len(span) <= 254 and STRICT[kind].fullmatch(span) else -1


def checked(kind: int, span: str) -> int:
    """Regular expression and arithmetic: checksum of a card, range and length of the others."""
    if kind == EMAIL:
        return -1 if ".." in span or len(span) > 254 else 1
    if kind == IP:
        return 1 if ":" in span or all(len(p) <= 3 and int(p) <= 255 for p in span.split(".")) else -1
    digits = _only_digits(span)
    if kind == CARD:
        return 1 if luhn(digits) else -1
    return 1 if 10 <= len(digits) <= 13 else 0 if 8 <= len(digits) <= 15 else -1


def listed(kind: int, span: str) -> int:
    """Gazetteer: top-level names, address ranges in use, card issuers, calling codes."""
    if kind == EMAIL:
        return 1 if re.split(r"\W+", span.lower())[-1 if span[-1].isalnum() else -2] in TOP_LEVEL else -1
    if kind == IP:
        first = span.split(".")[0]
        return 0 if ":" in span else 1 if len(first) <= 3 and 1 <= int(first) <= 223 else -1
    digits = _only_digits(span)
    if kind == CARD:
        return 1 if any(a <= int(digits[:4]) <= b and len(digits) in sizes for a, b, sizes in CARD_RANGES) else -1
    if span[0] != "+" and not digits.startswith("00"):
        return 0
    digits = digits.removeprefix("00") if span[0] != "+" else digits
    return 1 if any(digits[:k] in CALLING_CODES for k in (1, 2, 3)) else -1


class Around(NamedTuple):
    left: str
    right: str
    #: Up to three words before, the nearest last.
    before: list[str]
    after: list[str]


REACH = 48


def around(text: str, start: int, end: int) -> Around:
    before, after = text[max(0, start - REACH):start], text[end:end + REACH]
    return Around(before[-1:], after[:1], FIVES.findall(before.lower())[-3:], FIVES.findall(after.lower())[:2])


def alone(near: Around) -> int:
    """Context: not part of a longer token."""
    def joined(c: str) -> bool:
        return c.isalnum() or c in "_@/\\#=" and c != ""
    return -1 if joined(near.left) or joined(near.right) else 1


def cued(kind: int, near: Around) -> int:
    """Context: a word before that says what follows."""
    if any(w in CUES[kind] for w in near.before):
        return 1
    return -1 if near.before and near.before[-1] in AGAINST else 0


def in_prose(near: Around) -> int:
    """Context: between words, or between numbers as in a table."""
    sides = [words[i] for words, i in ((near.before, -1), (near.after, 0)) if words]
    if not sides:
        return 0
    return 1 if all(not w.isdigit() for w in sides) else -1 if all(w.isdigit() for w in sides) else 0


LABELERS = 6
VOTES = 3 ** LABELERS
#: Features of the classifier: six votes, shape, length, word before, characters on both sides.
HASHED = 256
FEATURES = 3 * LABELERS + 4 * HASHED


def votes(kind: int, span: str, near: Around) -> tuple[int, ...]:
    return shape(kind, span), checked(kind, span), listed(kind, span), alone(near), cued(kind, near), in_prose(near)


def features(kind: int, span: str, near: Around, said: tuple[int, ...]) -> list[int]:
    outline = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{len(m[0])}", span))[:40]
    word = near.before[-1] if near.before else ""
    hashed = (outline, str(len(span).bit_length()), word if not word.isdigit() else "9", _class(near.left) + _class(near.right))
    return [3 * i + v + 1 for i, v in enumerate(said)] + [
        3 * LABELERS + HASHED * i + crc32(x.encode()) % HASHED for i, x in enumerate(hashed)]


def _class(c: str) -> str:
    return "^" if not c else "a" if c.isalpha() else "9" if c.isdigit() else c if c in " \n.,;:()" else "."


def candidates(text: str | None) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(kind, start, end, base, vote pattern, features) by kind, then start.

    Candidates beyond the base overlap neither a base span nor an earlier one of their kind.
    """
    if text is None or not ANY.search(text):
        return []
    base = [f(text) for f in BASE]
    taken = sorted(span for spans in base for span in spans)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    out = []
    for kind, (found, more) in enumerate(zip(base, MORE)):
        spans = [(a, b, True) for a, b in found]
        free = 0
        for a, b in sorted(more(text, starts)):
            if a >= free and not ((k := bisect_left(starts, b)) and reach[k - 1] > a):
                spans.append((a, b, False))
                free = b
        for a, b, is_base in sorted(spans):
            span, near = text[a:b], around(text, a, b)
            # a very long match is judged by its first characters
            said = votes(kind, span[:300], near)
            pattern = sum((v + 1) * 3 ** i for i, v in enumerate(said))
            out.append((kind, a, b, is_base, pattern, features(kind, span[:300], near, said)))
    return out
