"""Words of letters and digits, as benchmark and licence matching read them."""

from __future__ import annotations

import re

#: fixed values: bytes that separate words (ASCII other than 0-9 and a-z)
SEPARATORS = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_TABLE = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
#: the same words in the original text, before lower-casing
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return text.encode("utf-8").lower().translate(_TABLE).split() if text else []
