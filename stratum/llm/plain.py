"""Texts whose splitting by a Unicode pattern is beyond doubt.

Every character of ``RANGE`` is ASCII or a precomposed Latin letter or sign: its class, its lower
case and its composed form are the same in every Unicode version and library. Left out are the
no-break space, the soft hyphen, the dotted capital I and control characters.
"""

from __future__ import annotations

import re
import unicodedata

RANGE = "\t\n\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u024f"
is_plain = re.compile(f"[{RANGE}]*").fullmatch


def _members(kind: str) -> str:
    """The characters of RANGE whose general category starts with ``kind``, as a class body."""
    codes = [c for c in range(0x250) if re.match(f"[{RANGE}]", chr(c)) and unicodedata.category(chr(c))[0] == kind]
    runs: list[list[int]] = []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{z:04x}" for a, z in runs)


def spelled_out(pattern: str) -> str:
    """The pattern with letter, digit and space classes spelled out for texts within RANGE."""
    letters, digits, spaces = _members("L"), _members("N"), r" \t\n\r"
    pattern = pattern.replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{digits}]")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{digits}]")
    pattern = pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
    return pattern.replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]")
