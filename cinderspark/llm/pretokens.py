"""The pre-token split of byte-level BPE, by character classes instead of a regular expression."""

from __future__ import annotations

import numpy as np
import regex

#: What the split equals, match by match.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE, WHITE, LETTER, NUMBER, OTHER = range(5)
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of every code point, made once a process."""
    global _classes
    if _classes is None:
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, of in ((WHITE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(of, points):
                a, b = (x if x < 0xD800 else x + 0x800 for x in (m.start(), m.end() - 1))
                table[a : b + 1] = kind
        table[32] = SPACE
        _classes = table
    return _classes


def split(text: str) -> list[str]:
    """All matches of :data:`PATTERN`, in order; together they are the text."""
    if not text:
        return []
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes()[code]
    white = kind <= WHITE
    n = len(code)
    start = np.empty(n, bool)
    start[0] = True
    # a run of one class is a token; white space is one class here
    run = np.where(white, np.uint8(WHITE), kind)
    start[1:] = run[1:] != run[:-1]
    # where white space ends before other text, its last character stands apart, and a space goes to what follows
    last = np.flatnonzero(white[:-1] & ~white[1:])
    start[last] = True
    start[last[kind[last] == SPACE] + 1] = False
    if "'" in text:
        for i in np.flatnonzero((code == 39) & start).tolist():
            after = 2 if text[i + 1 : i + 2] in ("s", "t", "m", "d") else 3 if text[i + 1 : i + 3] in ("re", "ve", "ll") else 0
            if after:
                start[i + 1] = False
                if i + after < n:
                    start[i + after] = True
    cuts = np.flatnonzero(start).tolist()
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], n], strict=True)]
