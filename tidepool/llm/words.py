"""Words of a text as the scans take them: A-Z lower-cased, runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, that is digits, letters a-z and everything
outside ASCII. On UTF-8 bytes those are the bytes 0-9, a-z and 0x80-0xFF, so a
byte table does the work and no character is decoded.
"""

from __future__ import annotations

import re

_WORD_BYTE = [48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)]
_LOWER = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
_TABLE = bytes(_LOWER[b] if _WORD_BYTE[_LOWER[b]] else 32 for b in range(256))
_RUN = re.compile(rb"[^ ]+")


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def byte_spans(text: str) -> list[tuple[int, int]]:
    """Where each word stands in the text's UTF-8 bytes."""
    return [m.span() for m in _RUN.finditer(text.encode("utf-8", "surrogatepass").translate(_TABLE))]
