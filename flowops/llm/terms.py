"""Words of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case, as bytes."""

from __future__ import annotations

from collections.abc import Iterator

# Every other byte becomes a space; bytes from 0x80 on belong to characters beyond ASCII.
FOLD = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b > 127 else 0x20 for b in range(256))
# Bytes of text whose words are held as a list at once, unless one word is longer.
SLICE = 1 << 18


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists from slices that are cut between words."""
    plain, at = raw.translate(FOLD), 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end
