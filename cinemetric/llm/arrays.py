"""Compressed array blobs that rows carry, and grouping of positions by slot."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes()
    names = b"".join(a.dtype.str.encode().ljust(4) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + names + b"".join(a.tobytes() for a in arrays))


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", n, 8)
    kinds = [data[8 + 8 * n + 4 * i : 12 + 8 * n + 4 * i].decode().strip() for i in range(n)]
    at, out = 8 + 12 * n, []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


def by_slot(slots: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each slot with the positions that have it, in their order."""
    if len(slots):
        order = np.argsort(slots, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(slots[order])) + 1):
            yield int(slots[part[0]]), part


def hash_range(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Ranges of unsigned 64-bit hashes: slot order is hash order."""
    return ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
