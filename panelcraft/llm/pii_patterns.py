"""Base spans of personal data: four patterns over whole texts, in time linear in the text.

Matches are leftmost and do not overlap within a kind; one that fails its check is dropped, and the search goes on after it.
"""

from __future__ import annotations

import re

#: In the order in which spans with equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # a match never starts inside a run of digits
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """An address is found from its @: to the left every allowed character, to the right the domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)
