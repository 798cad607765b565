"""Media columns: Netpbm and BMP images decoded to numpy arrays, area-resized by integral images,
written as NPY tiles with difference hashes.

Every image is worked on alone, in one map over Arrow batches: no shuffle, memory is that of one image and one
batch. A null or undecodable image gives null results; an image of no pixels counts as undecodable.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches

#: Pixels a row of the images that hold payloads; three samples each.
ROW = 64
TILE = (8, 9)


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6, as (height, width, channels); samples are scaled to 8 bits where the largest is not 255."""
    head = re.match(rb"P([1-6])", data)
    if not head:
        raise ValueError("not a Netpbm image")
    kind, at, fields = int(head[1]), 2, []
    while len(fields) < (2 if kind in (1, 4) else 3):
        m = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*(\d+)").match(data, at)
        if not m:
            raise ValueError("broken header")
        fields.append(int(m[1]))
        at = m.end()
    width, height, top = (*fields, 1)[:3]
    channels = 3 if kind in (3, 6) else 1
    n = width * height * channels
    if not 0 < top < 65536 or not 0 < n <= 8 * len(data):
        raise ValueError("samples of 16 bits at most, one pixel at least, and no more than there can be")
    if kind < 4:
        body = re.sub(rb"#[^\n\r]*", b"", data[at:])
        samples = re.findall(rb"[01]", body) if kind == 1 else body.split()
        flat = np.array([int(x) for x in samples[:n]], np.int64)
    elif kind == 4:
        rows = np.frombuffer(data, np.uint8, height * -(-width // 8), at + 1).reshape(height, -1)
        flat = np.unpackbits(rows, axis=1)[:, :width].reshape(-1)
    else:
        flat = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    if flat.max() > top or flat.min() < 0:
        raise ValueError("a sample beyond the largest")
    flat = flat.reshape(height, width, channels)
    if kind in (1, 4):
        return np.uint8(255) * (1 - flat).astype(np.uint8)
    return flat if top == 255 else ((flat.astype(np.int64) * 510 + top) // (2 * top)).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 (palette), 24 or 32 bits a pixel, as (height, width, 3)."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP image")
    start, head = (int.from_bytes(data[i : i + 4], "little") for i in (10, 14))
    width, height = (int.from_bytes(data[i : i + 4], "little", signed=True) for i in (18, 22))
    bits, packed = int.from_bytes(data[28:30], "little"), int.from_bytes(data[30:34], "little")
    if packed or bits not in (8, 24, 32) or width <= 0 or not height:
        raise ValueError("an uncompressed image of 8, 24 or 32 bits a pixel is needed")
    pitch = (width * bits + 31) // 32 * 4
    if pitch * abs(height) > len(data):
        raise ValueError("fewer pixels than stated")
    rows = np.frombuffer(data, np.uint8, pitch * abs(height), start).reshape(abs(height), pitch)
    rows = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    if bits == 8:
        colours = int.from_bytes(data[46:50], "little") or 256
        palette = np.frombuffer(data, np.uint8, colours * 4, 14 + head).reshape(-1, 4)
        if rows.max() >= len(palette):
            raise ValueError("a colour beyond the palette")
        rows = palette[rows[:, :, 0]]
    rows = rows[:, :, 2::-1]
    return rows if height < 0 else rows[::-1]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over height x width boxes of equal area, by the integral image; boxes may cut pixels."""
    h, w, c = pixels.shape
    whole = np.zeros((h + 1, w + 1, c))
    np.cumsum(np.cumsum(pixels, axis=0, dtype=np.int64), axis=1, out=whole[1:, 1:])

    def at(axis: int, n: int, size: int, table: np.ndarray) -> np.ndarray:
        edges = np.arange(n + 1) * (size / n)
        low = np.minimum(edges.astype(np.int64), size)
        part = (edges - low).reshape([-1 if i == axis else 1 for i in range(3)])
        a, b = table.take(low, axis), table.take(np.minimum(low + 1, size), axis)
        return a + (b - a) * part

    table = at(1, width, w, at(0, height, h, whole))
    boxes = np.diff(np.diff(table, axis=0), axis=1)
    return boxes / (h * w / (height * width))


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits as hex: whether each of 8 x 8 boxes is brighter than its right neighbour."""
    small = area_resize(pixels, *TILE).mean(axis=2)
    return np.packbits(np.round(small[:, :-1], 6) > np.round(small[:, 1:], 6)).tobytes().hex()


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


#: What analyse() adds. payload: the decoded samples; tile: an NPY file.
ADDED = "width int, height int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"


def _one(media: bytes | None, tile: int) -> dict:
    if media is None:
        return {}
    out = {"media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest()}
    try:
        pixels = decode(media)
    except (ValueError, IndexError, OverflowError):
        return out
    payload = np.ascontiguousarray(pixels).data
    small = np.rint(area_resize(pixels, tile, tile)).astype(np.uint8)
    return out | {
        "width": pixels.shape[1], "height": pixels.shape[0], "payload_bytes": payload.nbytes,
        "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(pixels.reshape(-1)[-16:].tobytes()),
        "feature": difference_hash(pixels), "tile": npy(small),
    }


def analyse(df: DataFrame, id_col: str, media_col: str, tile: int = 16) -> DataFrame:
    """For each row its id, what its image holds, its difference hash and an NPY tile of tile x tile pixels.

    A null image gives nulls; one that can't be decoded - broken, cut off, of another kind, with samples or colours
    beyond those stated - its stored bytes and digest alone. Rows with equal or null ids stay apart; other columns of df are not looked at.
    """
    from pyspark.sql.types import _parse_datatype_string

    rows = small_batches(df).select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    added = _parse_datatype_string(ADDED).fieldNames()
    schema = pa.schema([(n, t) for n, t in zip(added, (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()), strict=True)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                table = pa.Table.from_pylist([_one(x.as_py(), tile) for x in part.column(1)], schema=schema)
                yield from table.add_column(0, "id", part.column(0)).to_batches()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, {ADDED}").withColumnRenamed("id", id_col)


def as_ppm(payload: Column) -> Column:
    """A P6 image that holds payload, a positive multiple of 192 bytes, losslessly."""
    rows = (F.length(payload) / (3 * ROW)).cast("int").cast("string")
    return F.concat(F.concat(F.lit(f"P6\n{ROW} "), rows, F.lit("\n255\n")).cast("binary"), payload)


def payload_of(text: Column) -> Column:
    """The UTF-8 bytes of text (null: empty), with spaces up to a positive multiple of 192 bytes."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    full = F.greatest(F.lit(1), F.ceil(F.length(data) / (3 * ROW)).cast("int")) * (3 * ROW)
    return F.concat(data, F.repeat(F.lit(" "), (full - F.length(data)).cast("int")).cast("binary"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), as_ppm(payload_of(F.col("text"))).alias("media"))
    key = F.struct("doc_id", "n_bytes")
    found = analyse(docs.select(key.alias("key"), "media"), "key", "media")
    return found.select("key.doc_id", "key.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile")
