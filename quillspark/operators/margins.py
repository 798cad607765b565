"""Repeated page furniture: lines that come back at the top or bottom of many pages of a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..sources.documents import block_lines


def is_margin_noise(line, lex: L.Lexicon = L.DOMAIN):
    """Short lines without obligations, semantic terms or systems."""
    systems = [t for terms in lex.systems.values() for t in terms]
    return T.let(T.semantic_key(line), lambda key: F.length(key).between(2, 45) & ~L.has_obligation(line, key, lex) & ~L.any_term(key, lex.semantic + systems))


def edge_keys(texts: Column, lex: L.Lexicon, edge: int) -> Column:
    """The distinct keys of a page's first and last lines that can be furniture."""
    ends = F.concat(F.slice(texts, 1, edge), F.slice(texts, F.greatest(F.size(texts) - edge + 1, F.lit(1)), edge))
    return F.array_distinct(F.transform(F.filter(ends, lambda x: is_margin_noise(x, lex)), T.semantic_key))


def repeated_margin_lines(blocks: DataFrame, pages: DataFrame, lex: L.Lexicon = L.DOMAIN, edge: int = 3, share: float = 0.15) -> DataFrame:
    """source_id, line_key, n_pages: keys among the first and last `edge` lines of at least max(3, share of the pages) pages.

    A page's keys are distinct before the shuffle, so each page counts once; pages without lines still count as pages.
    """
    lines = F.array_sort(F.collect_list(F.struct("block_index", "block")))
    edges = blocks.groupBy("source_id", "pdf_page").agg(lines.alias("ls"))
    keys = edge_keys(F.transform("ls", lambda x: x["block"]), lex, edge)
    counts = edges.select("source_id", F.explode(keys).alias("line_key")).groupBy("source_id", "line_key").agg(F.count("*").alias("n_pages"))
    totals = pages.groupBy("source_id").agg(F.count("*").alias("n_all"))
    limit = F.greatest(F.lit(3), F.floor(F.col("n_all") * share))
    return counts.join(totals, "source_id").where(F.col("n_pages") >= limit).select("source_id", "line_key", "n_pages")


def remove_margin_noise(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    """blocks without repeated lines, wherever they stand; block_index counts those that are left."""
    keyed = blocks.withColumn("line_key", T.semantic_key(F.col("block")))
    left = keyed.join(repeated.select("source_id", "line_key"), ["source_id", "line_key"], "left_anti")
    kept = left.groupBy("source_id", "pdf_page").agg(F.array_sort(F.collect_list(F.struct("block_index", "block"))).alias("ls"))
    return kept.select("source_id", "pdf_page", F.posexplode("ls").alias("pos", "x")).select("source_id", "pdf_page", (F.col("pos") + 1).alias("block_index"), F.col("x.block").alias("block"))


def cleaned_blocks(pages: DataFrame, lex: L.Lexicon = L.DOMAIN, edge: int = 3, share: float = 0.15) -> DataFrame:
    """The blocks of pages without repeated lines: what remove_margin_noise leaves, with lines kept in their page's row.
    A source's pages are one row, in which its repeated keys are found, so pages are read once and joined with nothing."""
    page = F.struct("pdf_page", block_lines(F.col("text")).alias("ls"))
    own = pages.select("source_id", page.alias("page")).groupBy("source_id").agg(F.collect_list("page").alias("pages"))
    least = F.greatest(F.lit(3), F.floor(F.size("pages") * share)).cast("int")
    keys = F.array_sort(F.flatten(F.transform("pages", lambda p: edge_keys(p["ls"], lex, edge))))
    # a page's keys are distinct; sorted, a key of `least` pages stands again least - 1 places on
    noise = T.let(keys, lambda ks: F.array_distinct(F.filter(ks, lambda x, i: x == F.get(ks, i + least - 1))))

    def left(ls: Column, found: Column) -> Column:
        return F.when(F.size(found) == 0, ls).otherwise(F.filter(ls, lambda x: ~F.array_contains(found, T.semantic_key(x))))

    kept = T.let(noise, lambda found: F.transform("pages", lambda p: F.struct(p["pdf_page"].alias("pdf_page"), left(p["ls"], found).alias("ls"))))
    rows = T.each(own.select("source_id", kept.alias("pages")), "pages", "at", "page").select("source_id", "page.pdf_page", "page.ls")
    return T.each(rows, "ls", "pos", "block").select("source_id", "pdf_page", (F.col("pos") + 1).alias("block_index"), "block")
