"""Word normalisation shared by the text operators."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile("[a-z0-9]+")
#: No combining mark lies beyond the first two planes.
_MARKS = re.compile("[" + "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.combining(c)) + "]+")


def words(text: str) -> list[str]:
    """Runs of [a-z0-9] after lower-casing, NFKD and dropping combining marks."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _WORD.findall(text)
