"""SC6: sizes of images from their headers, read by ranges: as many bytes as the headers before the size have, whatever the image has."""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .events import located

#: Markers of JPEG segments that hold the size (frame headers), and of those that have no length.
FRAMES = frozenset({*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC})
BARE = frozenset({0x01, *range(0xD0, 0xD8)})
#: The end of the image and the start of its data: no size comes after them.
ENDS = (0xD9, 0xDA)


def _big(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _little(b: bytes) -> int:
    return int.from_bytes(b, "little")


def _jpeg(f: BinaryIO) -> tuple[int, int] | None:
    """The size in the first frame header; segments before it are jumped over, however many there are."""
    at = 2
    while True:
        f.seek(at)
        head = f.read(9)
        if len(head) < 2 or head[0] != 0xFF:
            return None
        if head[1] == 0xFF:  # a byte to fill up
            at += 1
        elif head[1] in BARE:
            at += 2
        elif head[1] in ENDS or len(head) < 4 or _big(head[2:4]) < 2:
            return None
        elif head[1] in FRAMES:
            return (_big(head[7:9]), _big(head[5:7])) if len(head) == 9 else None
        else:
            at += 2 + _big(head[2:4])


def _webp(h: bytes) -> tuple[int, int] | None:
    kind = h[12:16]
    if kind == b"VP8 " and len(h) >= 30:
        return _little(h[26:28]) & 0x3FFF, _little(h[28:30]) & 0x3FFF
    if kind == b"VP8X" and len(h) >= 30:
        return _little(h[24:27]) + 1, _little(h[27:30]) + 1
    if kind == b"VP8L" and len(h) >= 25:
        bits = _little(h[21:25])
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    return None


def header_size(f: BinaryIO) -> tuple[int, int] | None:
    """Width and height of a PNG, GIF, BMP, JPEG or WebP image; None for others and for what ends too soon."""
    h = f.read(32)
    if h[:4] == b"\x89PNG" and len(h) >= 24:
        return _big(h[16:20]), _big(h[20:24])
    if h[:3] == b"GIF" and len(h) >= 10:
        return _little(h[6:8]), _little(h[8:10])
    if h[:2] == b"BM" and len(h) >= 26:
        return _little(h[18:22]), abs(int.from_bytes(h[22:26], "little", signed=True))
    if h[:2] == b"\xff\xd8":
        return _jpeg(f)
    return _webp(h) if h[:4] == b"RIFF" else None


def _frame(sizes: list[tuple[int, int] | None], index: pd.Index) -> pd.DataFrame:
    return pd.DataFrame({"width": pd.Series([s and s[0] for s in sizes], index=index, dtype="Int32"), "height": pd.Series([s and s[1] for s in sizes], index=index, dtype="Int32")})


def image_size(content: Column) -> Column:
    """Struct of width and height of images that are there as bytes."""

    @F.pandas_udf("width int, height int")
    def size(contents: pd.Series) -> pd.DataFrame:
        return _frame([None if c is None else header_size(io.BytesIO(c)) for c in contents], contents.index)

    return size(content)


def with_sizes(rows: DataFrame, path: str = "image_path", error: str = "size_error") -> DataFrame:
    """rows with width, height and error of the images at their paths; the tasks open the files and read their headers alone."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found, errors = [], []
            for p in f[path]:
                size, why = None, None
                try:
                    system, name = located(p)
                    with system.open_input_file(name) as stream:
                        size = header_size(stream)
                    why = None if size else "no image header"
                except Exception as e:  # noqa: BLE001  a file's own failure is its result
                    why = f"{type(e).__name__}: {e}"[:500]
                found.append(size)
                errors.append(why)
            yield f.assign(**_frame(found, f.index), **{error: errors})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("width", "height", error))
    return rows.drop("width", "height", error).mapInPandas(read, f"{fields}, width int, height int, `{error}` string")
