"""Personal data by fixed patterns: spans of a text, as (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

import re
from collections.abc import Iterator

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Repeats take all they can and give nothing back, which changes no match and keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def small_parts(parts: list[str]) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the local part is what of it stands before, not further back than the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Sorted by start, then kind in the order of KINDS."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not any(digit in text for digit in "0123456789"):
        return in_order(out)
    if text.count(".") >= 3:
        out += [("ip", *m.span()) for m in IP.finditer(text) if small_parts(m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return in_order(out)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
