"""Vectors as whole numbers, and products of blocks of them that are exact: float64 BLAS where no sum can reach 2**53, int64 where none
can reach 2**63, Python's integers beyond that."""

from __future__ import annotations

import json
import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole numbers below this size, and sums of them that stay below it, are exact in float64; below the other one in int64.
EXACT, LONG = 1 << 53, 1 << 63


def sound(v: Column) -> Column:
    """Whether a list of numbers is there, has components, and none of them is null or not finite."""
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a column of equally long lists without nulls, as doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def floors(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) exactly; scale is a power of two. Whole numbers in float64; Python's integers where one reaches 2**53."""
    if scale < 1 or scale & (scale - 1):
        raise ValueError("the scale must be a power of two, so that products with it are exact")
    if not x.size or np.abs(x).max() < EXACT / scale:
        return np.floor(x * scale)
    return np.array([int(v) * scale if abs(v) >= EXACT else math.floor(v * scale) for v in x.ravel().tolist()], object).reshape(x.shape)


def size(a: np.ndarray) -> int:
    """The largest magnitude, 0 of nothing."""
    return int(max(abs(int(a.max())), abs(int(a.min())))) if a.size else 0


def whole(a: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as int64 or as Python's integers."""
    return a.astype(kind) if a.dtype == object or kind is not object else a.astype(np.int64).astype(object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exactly."""
    bound = a.shape[1] * size(a) * size(b)
    if bound < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    kind = np.int64 if bound < LONG else object
    return whole(a, kind) @ whole(b, kind).T


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """|x|^2 - 2 x.c + |c|^2 of all rows of both, exactly: every partial sum is bounded by (|x| + |c|)^2 of the largest components."""
    bound = 2 * x.shape[1] * (size(x) + size(c)) ** 2
    if bound < EXACT:
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    kind = np.int64 if bound < LONG else object
    x, c = whole(x, kind), whole(c, kind)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def added(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """The sum of two whole arrays: int64 while it fits, else Python's integers."""
    if a is None:
        return b
    kind = np.int64 if size(a) + size(b) < LONG else object
    return whole(a, kind) + whole(b, kind)


def encoded(a: np.ndarray) -> bytes:
    """A whole matrix in the narrowest integers that hold it."""
    m = size(a)
    if m >= LONG:
        return struct.pack("<cII", b"O", *a.shape) + json.dumps([int(v) for v in a.ravel().tolist()]).encode()
    code = next(c for c, bits in zip("bhiq", (7, 15, 31, 63), strict=True) if m < 1 << bits)
    return struct.pack("<cII", code.encode(), *a.shape) + np.ascontiguousarray(a.astype(code)).tobytes()


def decoded(raw: bytes) -> np.ndarray:
    code, n, d = struct.unpack_from("<cII", raw)
    if code == b"O":
        return np.array(json.loads(bytes(raw[9:])), object).reshape(n, d)
    return np.frombuffer(raw, code.decode(), offset=9).reshape(n, d)
