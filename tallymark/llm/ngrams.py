"""Hashed character n-grams of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def ngram_indices(text: str, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Indices below 2 ** bits of the n-grams of the lower-cased text, in pieces.

    Pieces overlap by the largest n-gram less one character, so a text of any
    length costs bounded memory and loses no n-gram.
    """
    over = max(sizes) - 1
    for at in range(0, max(1, len(text)), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK + over].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        # n-grams that begin in the overlap belong to the next piece
        last = at + CHUNK >= len(text)
        for size in sizes:
            n = len(codes) - size + 1 if last else min(CHUNK, len(codes) - size + 1)
            if n <= 0:
                continue
            hashed = np.full(n, size * 0x2545F491 & 0xFFFFFFFF, np.uint32)
            for i in range(size):
                hashed = (hashed ^ codes[i : i + n]) * np.uint32(ODD[i])
                hashed ^= hashed >> np.uint32(15)
            yield hashed >> np.uint32(32 - bits)
