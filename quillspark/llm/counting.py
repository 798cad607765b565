"""Corpus counts of hashed items, joined back to the batches that hold them, with little shuffle.

A batch of bounded size explodes its rows to hashed items and sends each distinct one with its local count to the hash
range ("bucket") that holds its row of the count table; a bucket sums them. To each batch it returns the sums alone, less
what the batch itself sent, in the order in which the batch sent the hashes; the batch makes its hashes again and so
knows whose they are. An item of which each third row has one crosses the shuffle once per batch, not once per row, and a
count table is never in one place. Items and counts travel as packed arrays, a row for each batch and bucket; a row for each item would by estimate be
a multiple of that.

With many batches and buckets a packed array would hold next to nothing. Beyond CELLS of them the counts go in two
steps: to RANGES hash ranges, where GROUP batches are merged, and from there to the buckets; the sums come back the same
way. It is the same join again, with merged groups in place of batches.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MB = 1 << 20
CELLS, RANGES, GROUP = 1 << 26, 1024, 1024
BLOBS = "bucket long, batch long, hashes binary, counts binary"
SUMS = "bucket long, batch long, sums binary"
_BLOBS = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
_SUMS = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("sums", pa.binary())])


def batch_bytes(total_bytes: int, parts: int = 96) -> int:
    """Text of a batch: up to 6 MB, whatever the input; less for small inputs, so that all cores work."""
    return max(MB, min(6 * MB, total_bytes // parts))


def n_buckets(items: float) -> int:
    """Buckets of half a million to 4 million items."""
    return math.ceil(max(1, items / 4e6, min(items / 5e5, 192)))


def n_ranges(batches: int, buckets: int) -> int:
    """Ranges to which batches send: the buckets themselves, or, if these are too many, RANGES of them (see totals)."""
    return buckets if batches * buckets <= CELLS else min(RANGES, buckets)


def _table(columns: list, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack_hashes(h: np.ndarray) -> bytes:
    """Ascending hashes by Elias and Fano: the lower bytes of each as they are, the upper parts as a row of bits in which
    each hash is a one behind as many zeros as the upper part has grown."""
    base, n = int(h[0]), len(h)
    k = min(range(4, 9), key=lambda k: 8 * k * n + n + ((int(h[-1]) >> 8 * k) - (base >> 8 * k)))
    if k == 8:
        return b"\x08" + h.astype("<u8").tobytes()
    upper = (h >> np.uint64(8 * k)).astype(np.int64) - (base >> 8 * k)
    bits = np.zeros(int(upper[-1]) + n, bool)
    bits[upper + np.arange(n)] = True
    low = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k])
    return bytes([k]) + (base >> 8 * k).to_bytes(8, "little") + len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes() + low.tobytes()


def unpack_hashes(data: bytes) -> np.ndarray:
    k = data[0]
    if k == 8:
        return np.frombuffer(data, "<u8", offset=1)
    base, n = int.from_bytes(data[1:9], "little"), int.from_bytes(data[9:17], "little")
    places = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), 17), count=n))
    out = np.zeros((len(places), 8), np.uint8)
    out[:, :k] = np.frombuffer(data, np.uint8, offset=17 - (-n // 8)).reshape(-1, k)
    return out.view("<u8").reshape(-1) | (places - np.arange(len(places)) + base).astype(np.uint64) << np.uint64(8 * k)


def pack_counts(c: np.ndarray) -> bytes:
    """A byte each; those of 255 and more follow whole. Most are equal, so what Zstandard leaves is a fraction of it."""
    large = c[c >= 255]
    return len(c).to_bytes(8, "little") + len(large).to_bytes(8, "little") + pa.compress(large.astype("<u8").tobytes() + np.minimum(c, 255).astype(np.uint8).tobytes(), "zstd", asbytes=True)


def unpack_counts(data: bytes) -> np.ndarray:
    n, many = (int.from_bytes(data[i : i + 8], "little") for i in (0, 8))
    plain = pa.decompress(data[16:], n + 8 * many, "zstd", asbytes=True)
    out = np.frombuffer(plain, np.uint8, offset=8 * many).astype(np.int64)
    out[out == 255] = np.frombuffer(plain, "<u8", many)
    return out


def emit(batch: int, hashes: np.ndarray, counts: np.ndarray, buckets: int, first: int = 0) -> pa.Table:
    """What a batch sends: its distinct hashes, ascending, and their counts, by bucket; buckets number from `first`."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    full, at = np.unique(bucket, return_index=True)
    at = [*at.tolist(), len(hashes)]
    cuts = list(zip(at, at[1:], strict=False))
    return _table([full.astype(np.int64) - first, [batch] * len(full), [pack_hashes(hashes[a:b]) for a, b in cuts], [pack_counts(counts[a:b]) for a, b in cuts]], _BLOBS)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], list[int]]:
    """Distinct hashes of all blobs and their counts; of each hash of each blob where it is among them and what all other
    blobs have of it; and where blobs end."""
    parts = [unpack_hashes(x.as_py()) for x in table.column("hashes")]
    local = np.concatenate([unpack_counts(x.as_py()) for x in table.column("counts")])
    found, place = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(place, weights=local, minlength=len(found)).astype(np.int64)
    return found, counts, (place, counts[place] - local), np.cumsum([len(x) for x in parts]).tolist()


def _returned(table: pa.Table, others: np.ndarray, ends: list[int]) -> pa.Table:
    own = [pack_counts(others[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
    return _table([table.column("bucket").to_pylist(), table.column("batch").to_pylist(), own], _SUMS)


def _sum(table: pa.Table) -> pa.Table:
    _, _, (_, others), ends = _merged(table)
    return _returned(table, others, ends)


def totals(blobs: DataFrame, batches: int, buckets: int) -> DataFrame:
    """What other batches emitted to n_ranges(batches, buckets) ranges: SUMS rows, one for each blob."""
    ranges = n_ranges(batches, buckets)
    if ranges == buckets:
        return blobs.groupBy("bucket").applyInArrow(_sum, SUMS)
    each = -(-buckets // ranges)

    def send(table: pa.Table) -> pa.Table:
        found, counts, _, _ = _merged(table)
        return emit(table.column("many")[0].as_py(), found, counts, ranges * each)

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, (place, others), ends = _merged(left)
        return _returned(left, in_order(right)[place] + others, ends)

    grouped = blobs.withColumn("many", F.pmod(F.xxhash64("batch"), F.lit(batches // GROUP + 1)))
    fine = grouped.groupBy("bucket", "many").applyInArrow(send, BLOBS)
    sums = fine.groupBy("bucket").applyInArrow(_sum, SUMS).select("bucket", "batch", "sums", (F.col("bucket") / each).cast("long").alias("range"))
    return grouped.groupBy("bucket", "many").cogroup(sums.groupBy("range", "batch")).applyInArrow(back, SUMS)


def in_order(sums: pa.Table) -> np.ndarray:
    """What other batches have of a batch's hashes, in their order."""
    order, packed = np.argsort(sums.column("bucket").to_numpy()), sums.column("sums")
    return np.concatenate([np.empty(0, np.int64), *(unpack_counts(packed[i].as_py()) for i in order.tolist())])
