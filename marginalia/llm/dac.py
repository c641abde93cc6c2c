"""Directly addressable codes: integer sequences with random access to every element.

An id is cut into chunks of ``chunk_bits`` bits, lowest first. Level 0 holds the first chunk
of every id; its bitmap says which ids go on. Level 1 holds the second chunks of those, and
so on. The place of an id in the next level is the number of set bits before it, which a rank
directory (one count per ``RANK_BITS`` bits) answers without reading what lies between. So any
element, or any run of elements, is read without decoding its neighbours.
"""

from __future__ import annotations

import numpy as np

RANK_BITS = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def encode(ids: np.ndarray, chunk_bits: int = 8) -> list[dict[str, bytes | int]]:
    """Levels as dicts: n (entries), chunks, bitmap and ranks (little-endian bytes)."""
    kind = np.uint8 if chunk_bits <= 8 else np.uint16
    left, levels = np.ascontiguousarray(ids, dtype=np.uint32), []
    while True:
        more = left >> chunk_bits
        on = more != 0
        bits = np.packbits(on, bitorder="little")
        padded = np.zeros(-(-max(len(bits), 1) // (RANK_BITS // 8)) * (RANK_BITS // 8), np.uint8)
        padded[: len(bits)] = bits
        counts = _ONES[padded].reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        chunks = (left & ((1 << chunk_bits) - 1)).astype(np.dtype(kind).newbyteorder("<"))
        levels.append({"n": len(left), "chunks": chunks.tobytes(), "bitmap": bits.tobytes(), "ranks": ranks.tobytes()})
        left = more[on]
        if not len(left):
            return levels


class Reader:
    """Random access to the levels of one encoded sequence."""

    def __init__(self, levels: list, chunk_bits: int = 8):
        kind = np.dtype(np.uint8 if chunk_bits <= 8 else np.uint16).newbyteorder("<")
        self.bits = chunk_bits
        self.chunks = [np.frombuffer(x["chunks"], kind) for x in levels]
        self.bitmaps = [np.frombuffer(x["bitmap"], np.uint8) for x in levels]
        self.ranks = [np.frombuffer(x["ranks"], "<u4") for x in levels]

    def __len__(self) -> int:
        return len(self.chunks[0])

    def rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before ``i``: the directory, then at most one block."""
        block = min(i // RANK_BITS, len(self.ranks[level]) - 1)
        bitmap, first, last = self.bitmaps[level], block * RANK_BITS // 8, i >> 3
        found = int(self.ranks[level][block]) + int(_ONES[bitmap[first:last]].sum())
        return found + (bin(int(bitmap[last]) & ((1 << (i & 7)) - 1)).count("1") if i & 7 else 0)

    def token(self, i: int) -> int:
        value, shift = 0, 0
        for level, chunks in enumerate(self.chunks):
            value |= int(chunks[i]) << shift
            if not self.bitmaps[level][i >> 3] >> (i & 7) & 1:
                break
            i, shift = self.rank(level, i), shift + self.bits
        return value

    def run(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Ids of positions start..stop-1: one rank lookup per level, then plain slices."""
        out = self.chunks[level][start:stop].astype(np.uint32)
        if level + 1 < len(self.chunks) and stop > start:
            low = start >> 3
            on = np.unpackbits(self.bitmaps[level][low : (stop + 7) >> 3], bitorder="little")
            on = on[start - 8 * low : stop - 8 * low].astype(bool)
            count = int(np.count_nonzero(on))
            if count:
                at = self.rank(level, start)
                out[on] |= self.run(at, at + count, level + 1) << np.uint32(self.bits)
        return out
