"""Hashing and compact storage of number arrays."""

from __future__ import annotations

import numpy as np
import zstandard

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed: finaliser of splitmix64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def odd(n: int, seed: int) -> np.ndarray:
    """Fixed odd numbers that look random."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def press(values: np.ndarray) -> bytes:
    """Compressed array: bytes of equal weight side by side."""
    values = np.ascontiguousarray(values)
    if not len(values):
        return zstandard.ZstdCompressor(level=1).compress(b"")
    planes = values.view(np.uint8).reshape(len(values), -1).T
    used = len(planes)
    if values.dtype.kind == "u" and values.ndim == 1:  # bytes that are zero throughout need not be gathered
        used = -(-int(values.max()).bit_length() // 8)
    return zstandard.ZstdCompressor(level=1).compress(planes[:used].tobytes() + bytes((len(planes) - used) * len(values)))


def unpress(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    planes = raw.reshape(np.dtype(kind).itemsize, -1)
    out = np.zeros(planes.shape[1], dtype=kind)
    places = out.view(np.uint8).reshape(-1, len(planes))
    for k, plane in enumerate(planes):
        if plane.any():
            places[:, k] = plane
    return out


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences of ascending keys; their running sum gives the keys back."""
    return np.diff(keys, prepend=np.uint64(0))
