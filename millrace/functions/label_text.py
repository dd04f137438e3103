"""SF12: label lines of many persons at once, as bytes of equal width: every number within 0 and 1 has eight characters, so that the lines
of a batch are one table of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .decimals import SPLITTER, _halves

KEYPOINTS, PLACES = 17, 6
#: Characters of a line: the class, four numbers, and two numbers and a digit for each keypoint; a space before each.
WIDTH = 1 + 4 * (PLACES + 3) + KEYPOINTS * (2 * (PLACES + 3) + 2)


def scaled(x: np.ndarray, places: int) -> np.ndarray:
    """x * 10**places rounded half to even on the exact product, as decimals.fixed_text does it."""
    scale = float(10**places)
    b_high, b_low = _halves(scale)
    product, split = x * scale, x * SPLITTER
    high = split - (split - x)
    low = x - high
    error = ((high * b_high - product) + high * b_low + low * b_high) + low * b_low
    near = np.rint(product)
    off = product - near
    return near + ((off == 0.5) & (error > 0)) - ((off == -0.5) & (error < 0))


def digits(x: np.ndarray) -> np.ndarray:
    """The eight characters of numbers within 0 and 1, in a last dimension of bytes."""
    n = scaled(x, PLACES).astype(np.int64)
    out = np.empty((*x.shape, PLACES + 2), np.uint8)
    for k in range(PLACES, 0, -1):
        n, rest = n // 10, n % 10
        out[..., k + 1] = rest + 48
    out[..., 0], out[..., 1] = n + 48, ord(".")
    return out


def padded(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `width` numbers of each list and which of them are there; what is null or missing is 0."""
    n = len(lists)
    values, there = np.zeros((n, width)), np.zeros((n, width), bool)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ok = at < width
    values[row[ok], at[ok]], there[row[ok], at[ok]] = numbers[ok], known[ok]
    return values, there


def unit(x: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, np.fmin(1.0, x)) + 0.0


def coco_lines(box: pa.Array, flat: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
    """A line for each box (x, y, width, height) and its flat keypoints (x, y, v) in an image of some size; null where the box or the size
    lacks a number. Keypoints that are missing are 0."""
    b, has = padded(box, 4)
    p, _ = padded(flat, 3 * KEYPOINTS)
    sized = width.is_valid().to_numpy(zero_copy_only=False) & height.is_valid().to_numpy(zero_copy_only=False)
    w, h = (x.fill_null(1).to_numpy(zero_copy_only=False).astype(np.float64) for x in (width, height))
    if (w == 0).any() or (h == 0).any():
        raise ZeroDivisionError("an image has no width or no height")
    p = p.reshape(-1, KEYPOINTS, 3)
    head = np.stack([(b[:, 0] + b[:, 2] / 2) / w, (b[:, 1] + b[:, 3] / 2) / h, b[:, 2] / w, b[:, 3] / h], axis=1)
    points = np.stack([p[:, :, 0] / w[:, None], p[:, :, 1] / h[:, None]], axis=2)
    seen = np.trunc(p[:, :, 2]).astype(np.int64)
    out = np.full((len(b), WIDTH), ord(" "), np.uint8)
    out[:, 0] = ord("0")
    each = PLACES + 3
    out[:, 1 : 1 + 4 * each].reshape(-1, 4, each)[:, :, 1:] = digits(unit(head))
    rest = out[:, 1 + 4 * each :].reshape(-1, KEYPOINTS, 2 * each + 2)
    rest[:, :, : 2 * each].reshape(-1, KEYPOINTS, 2, each)[:, :, :, 1:] = digits(unit(points))
    rest[:, :, -1] = np.clip(seen, 0, 9) + 48
    lines = pa.Array.from_buffers(pa.binary(WIDTH), len(out), [None, pa.py_buffer(out)]).cast(pa.string())
    good = has.all(axis=1) & sized
    odd = good & ((seen < 0) | (seen > 9)).any(axis=1)  # their visibilities need more than one character
    if odd.any() or not good.all():
        found = lines.to_pylist()
        for k in np.flatnonzero(odd).tolist():
            words = found[k].split(" ")
            words[7::3] = map(str, seen[k].tolist())
            found[k] = " ".join(words)
        lines = pa.array([x if ok else None for x, ok in zip(found, good.tolist(), strict=True)], pa.string())
    return lines
