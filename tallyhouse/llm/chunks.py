"""Words of texts of any length in bounded memory."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

#: Texts of more bytes or characters are not split in one go; words of them that are held at a time.
LONG_TEXT, WORDS = 1 << 20, 1 << 16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_chunks(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words between white space, in lists that begin with the last `overlap` words of the list before.

    One list for most texts, also for one without words.
    """
    if len(text) < LONG_TEXT:
        yield text.split()
        return
    found = (m[0] for m in _WORD.finditer(text))
    held: list[bytes] = []
    while more := list(islice(found, WORDS)):
        held += more
        yield held
        held = held[-overlap:] if overlap else []
