"""Compressed presence bitmaps over dense ordinals: runs where they are shorter, packed bits elsewhere."""

from __future__ import annotations

import numpy as np


class Bitmap:
    """An immutable set of ordinals below `size`.

    Bits are kept packed, eight to a byte, for the set operations; dumps() stores run boundaries instead where that
    takes fewer bytes, which it nearly always does for presence (long runs of ones with few gaps).
    """

    __slots__ = ("bits", "size")

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    @classmethod
    def of(cls, ordinals: np.ndarray, size: int) -> Bitmap:
        flags = np.zeros(size, dtype=bool)
        flags[ordinals] = True
        return cls(np.packbits(flags), size)

    def __and__(self, other: Bitmap) -> Bitmap:
        return Bitmap(self.bits & other.bits, self.size)

    def __or__(self, other: Bitmap) -> Bitmap:
        return Bitmap(self.bits | other.bits, self.size)

    def __sub__(self, other: Bitmap) -> Bitmap:
        """AND-NOT."""
        return Bitmap(self.bits & ~other.bits, self.size)

    def ordinals(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.bits, count=self.size))

    def __len__(self) -> int:
        return int(np.unpackbits(self.bits, count=self.size).sum())

    def dumps(self) -> bytes:
        flags = np.unpackbits(self.bits, count=self.size)
        edges = np.flatnonzero(np.diff(flags, prepend=0, append=0)).astype("<u4")
        head = np.uint32(self.size).tobytes()
        return head + (b"R" + edges.tobytes() if edges.nbytes < self.bits.nbytes else b"B" + self.bits.tobytes())

    @classmethod
    def loads(cls, data: bytes) -> Bitmap:
        size = int(np.frombuffer(data[:4], "<u4")[0])
        if data[4:5] == b"B":
            return cls(np.frombuffer(data[5:], np.uint8), size)
        edges = np.frombuffer(data[5:], "<u4").reshape(-1, 2).astype(np.int64)
        flags = np.zeros(size + 1, dtype=np.int8)
        np.add.at(flags, edges[:, 0], 1)
        np.add.at(flags, edges[:, 1], -1)
        return cls(np.packbits(np.cumsum(flags[:size]).astype(bool)), size)
