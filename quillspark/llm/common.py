"""What the operators share: the cluster's shared folder, lineage cuts, word hashes and blob columns."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut, shared_dir, table_path

__all__ = ["cut", "grams", "mixed", "read", "restored", "shared_dir", "small_batches", "table_path", "text_bytes", "word_hashes", "words"]

#: One step of the shingle mixer: an odd multiplier, so that the step can be undone and loses nothing.
MIX = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(29)


#: Rows and bytes of the batches that texts travel in to Python workers, where the session has Spark's defaults: with
#: 10,000 long texts at once, buffers outside the heap outgrow an executor.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}


def small_batches(df: DataFrame) -> DataFrame:
    """df, whose session from now on hands texts to Python in small batches, unless it has limits of its own."""
    conf = df.sparkSession.conf
    for key, (default, wanted) in BATCH.items():
        if conf.get(key) == default:
            conf.set(key, wanted)
    return df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ with A-Z in lower case, as UTF-8: bytes.lower and bytes.split know ASCII alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Words are hashed as sums of VALUES[byte] * FACTOR ** place, modulo 2**64, then mixed: sums over a text give all of its
#: words at once. Texts are worked on in pieces of at most BLOCK bytes, unless one word is longer.
FACTOR, BLOCK = 0x2545F4914F6CDD1D, 1 << 18
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * MIX)


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = lambda x: np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(BLOCK, x, np.uint64))])
    return up(FACTOR), up(pow(FACTOR, -1, 1 << 64))


def _word_sums(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers()
    if len(b) <= BLOCK:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[b] * up[: len(b)])])
        return (sums[ends] - sums[starts]) * down[starts]
    total, place = 0, 1  # one word
    for at in range(0, len(b), BLOCK):
        part = b[at : at + BLOCK]
        total += int((VALUES[part] * up[: len(part)]).sum()) * place
        place = place * int(up[BLOCK]) % (1 << 64)
    return np.array([total % (1 << 64)], np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of words(text), in order."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass").lower() if text else b"", np.uint8)
    edges = np.flatnonzero(np.diff(~BLANK[b], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if len(b) <= BLOCK:
        sums = _word_sums(b, starts, ends)
    else:
        parts, i = [], 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
            at = starts[i]
            parts.append(_word_sums(b[at : ends[j - 1]], starts[i:j] - at, ends[i:j] - at))
            i = j
        sums = np.concatenate([np.empty(0, np.uint64), *parts])
    return mixed(sums + (ends - starts).astype(np.uint64) * MIX)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """The hashes of all runs of n words, in order; empty if there are fewer."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1]
    for i in range(1, n):
        out = (out ^ (out >> SHIFT)) * MIX + h[i : len(h) - n + 1 + i]
    return mixed(out + np.uint64(n))


def restored(kind: type, state: dict):
    """An object of kind from its vars(), as broadcasts carry plain data."""
    out = kind.__new__(kind)
    vars(out).update(state)
    return out


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; what numbers of blocks are derived from."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
