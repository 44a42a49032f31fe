"""Arrays of numbers as few bytes: integers by planes of their bytes, sorted keys by their steps."""

from __future__ import annotations

import zlib

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """The bytes of integers, first bytes together, then second ones, and so on: they compress better so."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of little-endian numbers as bytes; sorted uint64 keys as their steps."""
    parts, heads = [], []
    for x in arrays:
        x = np.ascontiguousarray(x)
        steps = x if x.dtype != np.uint64 else np.diff(x, prepend=np.uint64(0))
        part = zlib.compress(planes(steps), 1)
        parts.append(part)
        heads.append(len(part))
    return np.array(heads, "<u4").tobytes() + b"".join(parts)


def unpack(packed: bytes, kinds: list[str]) -> list[np.ndarray]:
    at, out = 4 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(packed, "<u4", len(kinds)).tolist(), strict=True):
        own = from_planes(zlib.decompress(packed[at : at + size]), kind)
        out.append(np.cumsum(own, dtype=np.uint64) if kind == "<u8" else own)
        at += size
    return out
