"""Chunking: a sequential rule as a fold over a block's parts, in one expression, so a block never leaves its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T

#: Characters of a chunk, and how many of them the slices of an oversize part share.
LIMIT, OVERLAP = 760, 80
NUMBERED = r"^([一二三四五六七八九十百]+|\d{1,3})[、.)）]"


def parts_of(block: Column) -> Column:
    """Sentences and lines, stripped, without empty ones."""
    cut = F.split(T.clean_text(block), rf"(?<={T.SENTENCE_END})|\n+")
    return F.filter(F.transform(cut, T.strip), lambda x: x != "")


def slices(part: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    """Pieces of limit characters, each beginning overlap before the end of the one before."""
    step = limit - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(part) - limit) / F.lit(step)).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(part, i * step + 1, F.lit(limit)))


def _topics(text: Column, lex: L.Lexicon) -> Column:
    terms = [t for table in (lex.capabilities, lex.systems) for ts in table.values() for t in ts]
    return L.any_term(T.semantic_key(text), terms)


def chunks_of(block: Column, lex: L.Lexicon = L.DOMAIN, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    """The chunks of a block: parts are gathered up to limit characters. A part that begins a numbered item begins a
    chunk, and so does one that states an obligation of its own: chunk and part both have one and both have a topic."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def with_now(acc: Column) -> Column:
        return F.when(acc["now"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"])))

    def step(acc: Column, part: Column) -> Column:
        now = acc["now"]
        obliges = lambda s: L.has_obligation(s, T.semantic_key(s), lex)
        splits = part.rlike(NUMBERED) | (obliges(part) & obliges(now) & _topics(part, lex) & _topics(now, lex))
        fits = F.length(now) + 1 + F.length(part) <= limit
        return (
            F.when(F.length(part) > limit, F.struct(F.concat(with_now(acc), slices(part, limit, overlap)).alias("done"), F.lit("").alias("now")))
            .when(now == "", F.struct(acc["done"].alias("done"), part.alias("now")))
            .when(splits | ~fits, F.struct(with_now(acc).alias("done"), part.alias("now")))
            .otherwise(F.struct(acc["done"].alias("done"), F.concat(now, F.lit("\n"), part).alias("now")))
        )

    # most blocks are one part, which needs no fold
    return T.let(parts_of(block), lambda parts: F.when((F.size(parts) == 1) & (F.length(parts[0]) <= limit), parts).otherwise(F.aggregate(parts, empty, step, with_now)))


def chunks(blocks: DataFrame, lex: L.Lexicon = L.DOMAIN, limit: int = LIMIT, overlap: int = OVERLAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """source_id, pdf_page, block_index, chunk_index, chunk, and the blocks' columns in keep; chunks that only navigate are
    kept and marked."""
    rows = T.each(blocks.select("source_id", "pdf_page", "block_index", *keep, chunks_of(F.col("block"), lex, limit, overlap).alias("own")), "own", "pos", "chunk")
    return rows.select("source_id", "pdf_page", "block_index", *keep, (F.col("pos") + 1).alias("chunk_index"), "chunk", T.is_navigation(F.col("chunk")).alias("is_navigation"))
