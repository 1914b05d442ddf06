"""Whole-number arrays as short byte strings."""

from __future__ import annotations

import numpy as np
import zstandard

_LEVEL = 3


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Compressed bytes of unsigned numbers; of the differences where they ascend."""
    x = np.ascontiguousarray(values).astype(np.uint64, copy=False)
    if ascending and len(x):
        x = np.diff(x, prepend=np.uint64(0))
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(_LEVEL).compress(planes.tobytes())


def unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    """The numbers of ``pack``, as unsigned 64-bit ones."""
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    x = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)
    return np.cumsum(x, dtype=np.uint64) if ascending else x
