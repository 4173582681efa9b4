"""Media columns: Netpbm and BMP images as numpy arrays, area-resized by integral images, kept as NPY tiles.

``decode_image`` reads P1 to P6 Netpbm (8 or 16 bits) and uncompressed BMP of 1, 4, 8, 24 and 32 bits;
``encode_pgm`` and ``encode_bmp`` write them. ``area_resize`` takes exact area means from a summed-area table, so
each output pixel costs four look-ups whatever the factor. ``difference_hash`` compares neighbouring pixels of a
9 x 8 tile. ``media_features`` applies all of this to a binary column in Arrow batches, without a shuffle.

A null or empty value, or one that is no image (a header that promises more samples than there are bytes, a sample beyond the
header's greatest), gives null size, tile and hash; ``encode_payloads`` makes at least
one block of 64 bytes of any text, null included. Values are taken one at a time, and results go on in batches of about
``PASS_BYTES``, so memory follows the longest value. Repeated values give equal results; an empty table gives an
empty result; columns besides the id and the value are not read, and these may have any name.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import arrow_map, prepare, table

BLOCK = 64
#: Bytes of results that go on together.
PASS_BYTES = 4 << 20


def encode_pgm(pixels: np.ndarray) -> bytes:
    """A binary greyscale image of 8-bit samples."""
    h, w = pixels.shape
    return b"P5\n%d %d\n255\n" % (w, h) + np.ascontiguousarray(pixels, dtype=np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """24 bits a pixel, or 8 with a palette of greys for (height, width); rows from the bottom and padded to four bytes."""
    h, w = pixels.shape[:2]
    depth = 3 if pixels.ndim == 3 else 1
    stride = (depth * w + 3) // 4 * 4
    rows = np.zeros((h, stride), dtype=np.uint8)
    rows[:, : depth * w] = pixels[::-1, :, ::-1].reshape(h, 3 * w) if depth == 3 else pixels[::-1]
    palette = b"" if depth == 3 else np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).tobytes()
    start = 54 + len(palette)
    return struct.pack("<2sIHHI", b"BM", start + rows.size, 0, 0, start) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8 * depth, 0, rows.size, 2835, 2835, len(palette) // 4, 0) + palette + rows.tobytes()


def _netpbm(data: bytes) -> np.ndarray:
    kind = int(data[1:2])
    fields, at = [], 2
    while len(fields) < (2 if kind in (1, 4) else 3):
        m = re.compile(rb"(?:\s+|#[^\n\r]*[\n\r])*(\d+)").match(data, at)
        if not m:
            raise ValueError("broken header")
        fields.append(int(m[1]))
        at = m.end()
    w, h, top = *fields[:2], fields[2] if len(fields) > 2 else 1
    if not (w > 0 and h > 0 and 0 < top < 65536):
        raise ValueError("broken header")
    planes = 3 if kind in (3, 6) else 1
    if (w * h if kind in (1, 4) else w * h * planes) > 8 * len(data):
        raise ValueError("too few samples")
    if kind <= 3:
        body = re.sub(rb"#[^\n\r]*", b" ", data[at:])
        values = [c - 48 for c in body if c in b"01"] if kind == 1 else list(map(int, body.split()))
        x = np.array(values[: w * h * planes], dtype=np.int64)
        if len(x) and not 0 <= x.min() <= x.max() <= top:
            raise ValueError("a sample out of range")
    elif kind == 4:
        x = np.unpackbits(np.frombuffer(data, np.uint8, (w + 7) // 8 * h, at + 1).reshape(h, -1), axis=1)[:, :w].ravel()
    else:
        x = np.frombuffer(data, np.uint8 if top < 256 else ">u2", w * h * planes, at + 1)
        if x.max() > top:
            raise ValueError("a sample out of range")
    if len(x) < w * h * planes:
        raise ValueError("too few samples")
    x = x.reshape((h, w, 3) if planes == 3 else (h, w))
    if kind in (1, 4):
        x = 1 - x
    return x.astype(np.uint8) if top == 255 else np.round(x.astype(np.float64) * 255 / top).astype(np.uint8)


def _bmp(data: bytes) -> np.ndarray:
    start, = struct.unpack_from("<I", data, 10)
    header, w, h, _, bits, packed = struct.unpack_from("<IiiHHI", data, 14)
    if packed not in (0, 3) or w <= 0 or h == 0 or bits not in (1, 4, 8, 24, 32) or (packed == 3 and bits != 32):
        raise ValueError("not an uncompressed image")
    if w * abs(h) > 8 * len(data):
        raise ValueError("too few samples")
    rows = np.frombuffer(data, np.uint8, (w * bits + 31) // 32 * 4 * abs(h), start).reshape(abs(h), -1)
    if bits <= 8:
        index = np.unpackbits(rows, axis=1).reshape(abs(h), -1, bits) @ (1 << np.arange(bits)[::-1])
        used, = struct.unpack_from("<I", data, 46)
        palette = np.frombuffer(data, np.uint8, 4 * (used or 1 << bits), 14 + header).reshape(-1, 4)
        if index[:, :w].max() >= len(palette):
            raise ValueError("a sample out of range")
        x = palette[index[:, :w]][:, :, 2::-1]
    else:
        x = rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(x[::-1] if h > 0 else x)


def decode_image(data: bytes) -> np.ndarray:
    """Samples of 8 bits, (height, width) or (height, width, 3). Raises ValueError for anything else."""
    try:
        if data[:2] == b"BM":
            return _bmp(data)
        if re.match(rb"P[1-6][\s#]", data[:3]):
            return _netpbm(data)
    except (struct.error, IndexError, OverflowError) as e:
        raise ValueError(str(e)) from e
    raise ValueError("not an image of a known kind")


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact means over the area that each output pixel covers, in float64."""
    x = pixels.astype(np.float64)
    h, w = x.shape[:2]
    table = np.zeros((h + 1, w + 1, *x.shape[2:]))
    np.cumsum(np.cumsum(x, axis=0), axis=1, out=table[1:, 1:])

    def along(t: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The table, linear between whole rows, at fractional edges."""
        low = np.minimum(edges.astype(np.int64), len(t) - 2)
        part = (edges - low).reshape(-1, *[1] * (t.ndim - 1))
        return t[low] * (1 - part) + t[low + 1] * part

    rows = along(table, np.arange(height + 1) * (h / height))
    both = along(rows.swapaxes(0, 1), np.arange(width + 1) * (w / width)).swapaxes(0, 1)
    return np.diff(np.diff(both, axis=0), axis=1) / (h / height * w / width)


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits: whether each pixel of the 9 x 8 grey tile is darker than the one to its right. Means are rounded to 1e-6 first."""
    x = pixels.astype(np.float64)
    if x.ndim == 3:
        x = x @ np.array([0.299, 0.587, 0.114])
    small = np.round(area_resize(x, 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy(pixels: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, pixels, allow_pickle=False)
    return out.getvalue()


def tile_of(pixels: np.ndarray, side: int) -> np.ndarray:
    return np.clip(np.rint(np.round(area_resize(pixels, side, side), 6)), 0, 255).astype(np.uint8)


def in_passes(batches: Iterator[pa.RecordBatch], kinds: list[pa.DataType], row: Callable[[object], tuple]) -> Iterator[list[pa.Array]]:
    """Ids with what ``row`` makes of each value, in batches of about ``PASS_BYTES``."""
    for batch in batches:
        out, start, size = [], 0, 0
        for i, value in enumerate(batch.column(1)):
            out.append(row(value.as_py()))
            size += sum(len(x) for x in out[-1] if isinstance(x, (bytes, str)))
            if size >= PASS_BYTES or i + 1 == batch.num_rows:
                yield [batch.column(0).slice(start, len(out)), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))]
                out, start, size = [], i + 1, 0


def media_features(df: DataFrame, id_col: str, media_col: str, side: int = 32) -> DataFrame:
    """``height``, ``width``, ``tile`` (an NPY file of side x side pixels) and ``dhash`` of each image of a binary column."""
    prepare(df.sparkSession)
    given = df.select(F.col(f"`{id_col}`"), F.col(f"`{media_col}`"))

    def features(value: bytes | None) -> tuple:
        try:
            p = decode_image(value or b"")
        except ValueError:
            return (None,) * 4
        return *p.shape[:2], npy(tile_of(p, side)), difference_hash(p)

    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.string()]
    return arrow_map(given, lambda batches: in_passes(batches, kinds, features), [(id_col, given.schema.fields[0].dataType), ("height", "int"), ("width", "int"), ("tile", "binary"), ("dhash", "string")])


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


#: What ``encode_payloads`` gives for a text, in order.
NAMES = {"n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "media": "binary", "tile": "binary"}
FORMS = {"pgm": encode_pgm, "bmp": encode_bmp}


def encode_payloads(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", side: int = 32, keep_media: bool = True, form: str = "pgm") -> DataFrame:
    """Each text as a grey image 64 samples wide in a ``form`` (pgm or bmp), read back from the stored form.

    Besides the figures of the stored form: ``feature``, the difference hash and the tile's crc32, ``tile`` (its NPY tile)
    and, unless ``keep_media`` is false, ``media`` (the image).
    """
    prepare(df.sparkSession)
    encode = FORMS[form]
    given = df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    names = [n for n in NAMES if keep_media or n != "media"]

    def stored(text: str | None) -> tuple:
        n, raw = payload(text)
        media = encode(np.frombuffer(raw, np.uint8).reshape(-1, BLOCK))
        pixels = decode_image(media)
        pixels = pixels if pixels.ndim == 2 else pixels[:, :, 0]  # a palette gives three equal samples
        back = pixels.tobytes()
        tile = npy(tile_of(pixels, side))
        row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), f"{difference_hash(pixels)}-{zlib.crc32(tile):08x}")
        return (*row, media, tile) if keep_media else (*row, tile)

    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return arrow_map(given, lambda batches: in_passes(batches, [arrow[NAMES[n]] for n in names], stored), [(id_col, given.schema.fields[0].dataType), *((n, NAMES[n]) for n in names)])


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_payloads(table(spark, sf_dir, "documents"), keep_media=False)


QUERIES = {"op6_media": op6_media}
ORACLES: dict[str, str] = {}
