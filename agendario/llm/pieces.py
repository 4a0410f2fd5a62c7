"""Splitting texts at places where no byte-level pre-token can cross, so that pieces can be looked up.

The pre-token pattern of the public byte-level vocabularies never joins a non-space character
with a space that follows it. Before a single white space character between non-spaces a text can therefore be cut:
the pre-tokens of the text are those of its pieces, in order. Texts with two white space
characters in a row are cut less often (only where the same holds).
"""

from __future__ import annotations

import re

#: White space as Unicode's White_Space property has it (Python's ``\\s`` has more).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_TWO = re.compile(r"[\s\x85][\s\x85]")
_SAFE = re.compile(rf"(?<=[^\s\x85])(?=[ \n][^\s\x85])")


def pieces(text: str) -> list[str]:
    """Pieces of a text, in order; joined they give the text again."""
    if "\0" in text or _TWO.search(text):
        cuts = [0, *(m.start() for m in _SAFE.finditer(text)), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
    out = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return out if out[0] else out[1:]


def pretoken_pattern(pattern: str):
    """The ``regex`` pattern with its white space classes spelled out."""
    import regex

    spelled = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{WHITE}\p{{L}}\p{{N}}]").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
    return regex.compile(spelled)
