"""ASCII-lower-cased words of UTF-8 texts: runs of 0-9, a-z and characters beyond ASCII."""

from __future__ import annotations

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_MAP = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_MAP).split()
