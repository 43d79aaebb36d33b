"""Base spans that scans must return exactly, found in time linear in the text."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable

Span = tuple[str, int, int]

#: The kinds, in the order in which equal starts are listed.
PII_KINDS = ("email", "ip", "card", "phone")
SECRET_KINDS = ("assign", "access", "hex")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digit runs are taken whole, so that no place is read again and again.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}+")


def emails(text: str) -> list[Span]:
    """Each at-sign is met once: the run before it, cut at the last match, and the longest domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def pii_spans(text: str) -> list[Span]:
    out = emails(text) if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x) < 4 and int(x) <= 255 or len(x) >= 4 and int(x.lstrip("0")[:4] or 0) <= 255 for x in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return listed(out, PII_KINDS)


def secret_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, span and the candidate itself: the assigned value, the key, or the digits."""
    out = [("assign", *m.span(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], SECRET_KINDS.index(s[0])))


def touching(spans: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span shares a place with one of ``spans``; these are merged, so that each look is a binary search."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def meets(start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at > 0 and ends[at - 1] > start

    return meets


def listed(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By start, then kind as listed; kinds that aren't listed come after, by name."""
    order = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], order.get(s[0], len(kinds)), s[0], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
