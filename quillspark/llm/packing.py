"""Variable-capacity best-fit packing: several permitted sequence lengths, planned jointly over the histogram of lengths.

0. Texts are measured in tokens of a byte-pair vocabulary; each is followed by one separator.
1. Texts longer than the largest length become full pieces and a rest, so every piece fits some bin. A piece knows the
   bytes of the text that it holds, so that bins can be filled with what they were planned for.
2. The plan works on counts by length, the longest first. Pieces of a length go to the open bins with the least room
   that is enough, many at once; when none has room, bins of the least-cost size open: cost over the words that such a
   bin can still be expected to hold, given what shorter pieces remain. In the end each bin shrinks to the smallest
   permitted length that holds its contents. Its work and its size depend on the largest length, not on the rows.
3. A piece's rank among those of its length (counts by length and part, then row numbers inside; a length that a third
   of all rows have is spread over the parts) says which entry of the plan it takes.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, small_batches

SIZES = (512, 1024, 2048, 4096)


def default_cost(size: int) -> float:
    """Linear layers and attention of one sequence, in units of a token's linear layers."""
    return size + size * size / 16384


def plan(histogram: dict[int, int], sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = default_cost) -> tuple[np.ndarray, np.ndarray]:
    """Placements (length, first rank, ranks, first bin, offset) and bins (first bin, bins, capacity), as integer rows.

    Ranks r of a length from the first on go to bins from the first on, one each, at that offset in the bin.
    """
    sizes = tuple(sorted(sizes))
    room: dict[int, list[tuple[int, int, int]]] = {}  # free words: bins (first, how many, size)
    order: list[int] = []
    placed: list[tuple[int, int, int, int, int]] = []
    stock, n_bins = sum(k * c for k, c in histogram.items()), 0

    def put(free: int, bins: tuple[int, int, int]) -> None:
        if free not in room:
            room[free] = []
            insort(order, free)
        room[free].append(bins)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        stock -= length * left  # of shorter pieces
        while left:
            at = bisect_left(order, length)
            if at < len(order):
                free = order[at]
                first, n, size = room[free].pop()
                k = min(n, left)
                if k < n:
                    room[free].append((first + k, n - k, size))
                elif not room[free]:
                    del room[free], order[at]
                placed.append((length, rank, k, first, size - free))
                put(free - length, (first, k, size))
                left, rank = left - k, rank + k
                continue

            def rate(size: int, length: int = length, left: int = left) -> float:
                each = min(size // length, left)
                return cost(size) / min(size, each * length + stock / -(-left // each))

            size = min((s for s in sizes if s >= length), key=lambda s: (rate(s), s))
            each = min(size // length, left)
            n = left // each
            for layer in range(each):
                placed.append((length, rank, n, n_bins, layer * length))
                rank += n
            left -= n * each
            put(size - each * length, (n_bins, n, size))
            n_bins += n
    bins = [(first, n, sizes[bisect_left(sizes, size - free)]) for free, own in room.items() for first, n, size in own]
    return np.array(sorted(placed), np.int64).reshape(-1, 5), np.array(sorted(bins), np.int64).reshape(-1, 3)


PIECES = "array<struct<start:long,length:long,first_byte:long,last_byte:long>>"
_PIECE = pa.struct([(n, pa.int64()) for n in ("start", "length", "first_byte", "last_byte")])


def token_pieces(df: DataFrame, ranks_path: str, pattern: str, top: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id and pieces: runs of at most `top` tokens, with the bytes (UTF-8, end exclusive) that they hold.

    ranks_path: a vocabulary as ranks, pattern: what parts texts before byte pairs are merged. The last piece has the
    separator besides, a token without bytes, which is a piece of its own behind a full one. Null counts as empty.
    """
    spec = df.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    rows = small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, spec.value.splitlines())}
        encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        for batch in batches:
            out = []
            for x in batch.column(1):
                text = x.as_py() or ""
                tokens = encode(text)
                starts = np.arange(0, len(tokens) + 1, top)
                ends = np.append(starts[1:], len(tokens) + 1)
                if len(starts) == 1:
                    out.append([(0, int(ends[0]), 0, len(text.encode("utf-8", "surrogatepass")))])
                else:
                    bytes_before = np.concatenate([[0], np.cumsum(sizes[tokens])])
                    last = bytes_before[np.minimum(ends, len(tokens))]
                    out.append(list(zip(starts.tolist(), (ends - starts).tolist(), bytes_before[starts].tolist(), last.tolist(), strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[dict(zip(("start", "length", "first_byte", "last_byte"), p, strict=True)) for p in ps] for ps in out], pa.list_(_PIECE))], ["id", "pieces"])

    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, pieces {PIECES}").withColumnRenamed("id", id_col)


def pack(df: DataFrame, length: Column, id_col: str = "doc_id", sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = default_cost) -> DataFrame:
    """A row for each piece of at most the largest size: id, piece, start, length, bin_id, capacity, offset.

    length: tokens of a row; null or less than 1 counts as 1, so that every row has a place. Equal rows, and rows with
    equal or null ids, are packed each for itself. An empty table gives no rows. Other columns are not looked at.
    """
    top = max(sizes)
    rows = df.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(length, F.lit(1)), F.lit(1)).cast("long").alias("whole"))
    piece = lambda k: F.struct((k * top).alias("start"), F.least(F.lit(top).cast("long"), F.col("whole") - k * top).alias("length"))
    rows = rows.select("id", F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("whole") - 1) / top)), piece).alias("pieces"))
    return pack_pieces(rows.withColumnRenamed("id", id_col), "pieces", id_col, sizes, cost)


def pack_pieces(df: DataFrame, pieces: str, id_col: str = "doc_id", sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = default_cost) -> DataFrame:
    """A row for each element of the array `pieces`: id, piece (its place), the element's fields, of which length is one
    and between 1 and the largest size, bin_id, capacity, offset."""
    spark, top = df.sparkSession, max(sizes)
    fields = df.schema[pieces].dataType.elementType.fieldNames()
    rows = df.select(F.col(id_col).alias("id"), F.posexplode(pieces).alias("piece", "own")).select("id", "piece", "own.*", F.monotonically_increasing_id().alias("row"))
    rows = cut(rows)
    n = rows.count()
    parts = int(max(1, min(n / 1000, 4096), n / 1_000_000))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    counts = cut(rows.groupBy("length", "part").agg(F.count("*").alias("c")), n)
    before = counts.withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("part")) - F.col("c"))
    histogram = {r["length"]: r["c"] for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # lengths up to top
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("length", "part").orderBy("row")))
    ranked = ranked.join(before.select("length", "part", "before"), ["length", "part"])
    ranked = ranked.select((F.col("before") + F.col("place") - 1).alias("rank"), "length", "id", "piece", *fields)
    shared = spark.sparkContext.broadcast(plan(histogram, sizes, cost))
    names = ["id", "piece", *fields, "bin_id", "capacity", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed, bins = shared.value
        lengths = np.searchsorted(placed[:, 0], np.arange(top + 2))
        for batch in batches:
            rank, length = (batch.column(i).to_numpy() for i in (0, 1))
            at = np.empty(len(length), np.int64)
            for k in np.unique(length):
                own = length == k
                a, b = lengths[k], lengths[k + 1]
                at[own] = a + np.searchsorted(placed[a:b, 1], rank[own], side="right") - 1
            bin_id = placed[at, 3] + rank - placed[at, 1]
            capacity = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(bin_id), pa.array(capacity), pa.array(placed[at, 4])], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[2:])
    out = ranked.mapInArrow(work, f"{kinds}, bin_id long, capacity long, offset long")
    return out.withColumnRenamed("id", id_col)


def pack_texts(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = default_cost) -> DataFrame:
    """A row for each piece of each text: id, piece, start and length in tokens, first_byte and last_byte in the text,
    bin_id, capacity, and offset in the bin. Null and empty texts are one separator; rows as in pack."""
    return pack_pieces(token_pieces(df, ranks_path, pattern, max(sizes), id_col, text_col), "pieces", id_col, sizes, cost)


def sequences(placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each bin: its capacity, fill, and pieces in order; a bin has at most capacity pieces."""
    own = [c for c in placed.columns if c not in ("bin_id", "capacity", "offset")]
    piece = F.struct("offset", *own)
    return placed.groupBy("bin_id").agg(F.first("capacity").alias("capacity"), F.sum("length").alias("filled"), F.array_sort(F.collect_list(piece)).alias("pieces"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every whole document and one separator each."""
    import public_tokenizers

    return pack_texts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
