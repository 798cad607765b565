"""Language ID by Bayesian evidence fusion: text likelihoods, declared markup language, address suffix and host priors.

1. Character trigrams (bytes of the lower-cased text without digits and ASCII punctuation, hashed) are counted by
   declared language over all texts that have one; a language's model is their smoothed share. A language that fewer
   than one in LABELS of the labelled rows declare is counted as OTHER, so that a model's size is bounded.
2. Each text gets the mean log-likelihood of its trigrams in each language.
3. Grouped aggregation of what the texts alone say gives how often each declared value and suffix goes with each
   language, and the priors: a host's counts smoothed by its domain's, and these by all.
4. The posterior adds up the logs. Trigrams aren't independent, so a text of n of them counts with a * n ** b; a and b
   are those of GRID under which the declared languages of all rows are likeliest, of which DOUBT may be wrong.

A document is rejected if it has no trigrams, if its best language explains it no better than chance, or if the
posterior is under the threshold. Nulls in any column are missing evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, small_batches

BITS = 14
LABELS, OTHER = 256, "other"
GRID = [(a, b) for b in (0.5, 0.75, 1.0) for a in (0.02, 0.05, 0.1, 0.2, 0.5, 1.0)]
DOUBT = 0.02
_BLANK = bytes.maketrans(bytes(i for i in range(128) if not chr(i).isalpha()), b" " * sum(not chr(i).isalpha() for i in range(128)))


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams with a letter in the middle."""
    if not text:
        return np.empty(0, np.int64)
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass").translate(_BLANK), np.uint8)
    code = (b[:-2].astype(np.uint32) << 16) | (b[1:-1].astype(np.uint32) << 8) | b[2:]
    code = code[b[1:-1] != 32]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def train(df: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Languages and their log-shares of trigrams, over all rows with a label. At most LABELS + 1 languages, and 2**BITS
    rows of each, come back."""
    rows = small_batches(df).select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    counts = rows.where("label is not null").groupBy("label").agg(F.count("*").alias("c"))
    n = counts.agg(F.sum("c").alias("n")).first()["n"] or 0
    common = [r["label"] for r in counts.where(F.col("c") * LABELS >= n).select("label").collect()]
    rows = rows.withColumn("label", F.when(F.col("label").isin(common), F.col("label")).when(F.col("label").isNotNull(), OTHER))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if y is not None:
                    own = counts.setdefault(y, np.zeros(1 << BITS, np.int64))
                    t = trigrams(x.as_py())
                    if len(t) < 2000:
                        np.add.at(own, t, 1)
                    else:
                        own += np.bincount(t, minlength=1 << BITS)
        for y, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([y] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["label", "feature", "c"])

    found = rows.mapInArrow(work, "label string, feature int, c long").groupBy("label", "feature").agg(F.sum("c").alias("c")).toPandas()
    languages = sorted(found["label"].unique())
    counts = np.full((1 << BITS, max(1, len(languages))), 0.5)
    place = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, (found["feature"].to_numpy(np.int64), found["label"].map(place).to_numpy(np.int64)), found["c"].to_numpy(np.float64))
    return languages, np.log(counts / counts.sum(0)).astype(np.float32)


def likelihoods(df: DataFrame, text: str, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """df's other columns, n_trigrams, and means: the mean log-likelihood of the trigrams in each language."""
    shared = df.sparkSession.sparkContext.broadcast(model[1])
    others = [c for c in df.columns if c != text]
    rows = small_batches(df).select(*others, F.col(text).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sizes, means = [], []
            for x in batch.column(batch.num_columns - 1):
                t = trigrams(x.as_py())
                sizes.append(len(t))
                total = np.zeros(table.shape[1]) if not len(t) else table[t].sum(0, dtype=np.float64) if len(t) < 3000 else np.bincount(t, minlength=len(table)) @ table
                means.append((total / max(1, len(t))).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(means, pa.list_(pa.float64()))], [*others, "n_trigrams", "means"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(work, f"{schema}, n_trigrams long, means array<double>")


def _shares(counts: Column, prior: Column, weight: float) -> Column:
    """Counts by language smoothed by weight rows of prior."""
    return F.zip_with(counts, prior, lambda c, p: (c + F.lit(weight) * p) / (F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + F.lit(weight)))


def text_weight(scored: DataFrame, languages: list[str]) -> Column:
    """The weight of a text of n_trigrams trigrams, fitted on the rows that declare one of the languages."""
    place = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("declared")).cast("int")
    rows = scored.where((F.col("n_trigrams") > 0) & (place > 0)).select("means", "n_trigrams", place.alias("own"), F.array_max("means").alias("best"))

    def loss(a: float, b: float) -> Column:
        w = F.lit(a) * F.pow("n_trigrams", F.lit(b))
        total = F.aggregate("means", F.lit(0.0), lambda acc, m: acc + F.exp((m - F.col("best")) * w))
        p = F.exp((F.element_at("means", F.col("own")) - F.col("best")) * w) / total
        return -F.sum(F.log(p * (1 - DOUBT) + DOUBT / len(languages)))

    losses = rows.agg(*[loss(a, b).alias(f"l{i}") for i, (a, b) in enumerate(GRID)]).first()
    a, b = min(((x, ab) for x, ab in zip(losses, GRID, strict=True) if x is not None), default=(0, (0.2, 0.75)))[1]
    return F.lit(a) * F.pow("n_trigrams", F.lit(b))


def identify(
    df: DataFrame, id_col: str, text_col: str, label_col: str, host: Column, domain: Column, declared: Column, suffix: Column,
    model: tuple[list[str], np.ndarray] | None = None, threshold: float = 0.5,
) -> DataFrame:
    """For each row its id, language, confidence (the posterior), text_language, n_trigrams and accepted.

    language is null for texts without trigrams; rows with null or equal ids each give a row. Of equally likely
    languages the first by name counts. Without any labelled text there are no languages, and every row is rejected.
    """
    model = model or train(df, text_col, label_col)
    languages = model[0]
    if not languages:
        return df.select(id_col, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_language"), F.lit(0).cast("long").alias("n_trigrams"), F.lit(False).alias("accepted"))
    n = len(languages)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), host.cast("string").alias("host"), domain.cast("string").alias("domain"), declared.cast("string").alias("declared"), suffix.cast("string").alias("suffix"))
    scored = cut(likelihoods(rows, "text", model))
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_position("means", F.array_max("means")).cast("int")
    scored = scored.withColumn("best", F.when(F.col("n_trigrams") > 0, best))
    hits = [F.count_if(F.col("best") == i + 1).cast("double").alias(f"c{i}") for i in range(n)]
    counts = F.array(*[F.col(f"c{i}") for i in range(n)])

    n_rows, total = scored.count(), scored.agg(*hits).first()
    base = [(total[f"c{i}"] + 1.0) / (sum(total) + n) for i in range(n)]
    everywhere = F.array(*[F.lit(x) for x in base])
    domains = cut(scored.where("best is not null and domain is not null").groupBy("domain").agg(*hits).select("domain", _shares(counts, everywhere, 20.0).alias("domain_prior")), n_rows)
    hosts = scored.where("best is not null and host is not null").groupBy("host", "domain").agg(*hits).select("host", "domain", counts.alias("counts"))
    hosts = hosts.join(domains, "domain", "left").select("host", F.col("domain").alias("d"), _shares(F.col("counts"), F.coalesce("domain_prior", everywhere), 10.0).alias("prior"))
    hosts = cut(hosts, n_rows)

    def evidence(column: str) -> DataFrame:
        """log P(value | language), smoothed by the value's share of all rows."""
        values = scored.where(F.col("best").isNotNull() & F.col(column).isNotNull()).groupBy(column).agg(*hits)
        share = (F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + 1) / F.lit(sum(total) + 1.0)
        return cut(values.select(column, F.array(*[F.log((F.col(f"c{i}") + 5 * share) / F.lit(total[f"c{i}"] + 5.0)) for i in range(n)]).alias(f"log_{column}")), n_rows)

    out = scored.join(hosts, scored["host"].eqNullSafe(hosts["host"]) & scored["domain"].eqNullSafe(hosts["d"]), "left").drop(hosts["host"]).drop("d")
    for column in ("declared", "suffix"):
        out = out.join(evidence(column), column, "left")
    none = F.array(*[F.lit(0.0)] * n)
    weight = text_weight(scored, languages)
    logs = F.transform(F.col("means"), lambda x: x * weight)
    for more in (F.transform(F.coalesce("prior", everywhere), lambda p: F.log(p)), F.coalesce("log_declared", none), F.coalesce("log_suffix", none)):
        logs = F.zip_with(logs, more, lambda a, b: a + b)
    out = out.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    out = out.withColumn("confidence", 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    chance = float(-np.log(1 << BITS))
    known = F.col("n_trigrams") > 0
    place = F.array_position("logs", F.col("top")).cast("int")
    accepted = known & (F.col("confidence") >= threshold) & (F.array_max("means") > chance)
    return out.select(
        F.col("id").alias(id_col), F.when(known, F.element_at(names, place)).alias("language"), F.when(known, F.col("confidence")).alias("confidence"),
        F.when(known, F.element_at(names, F.col("best"))).alias("text_language"), "n_trigrams", accepted.alias("accepted"),
    )


def _address(host: Column) -> tuple[Column, Column]:
    """Domain and suffix of a host's name; of a name without dots what precedes its number, and none."""
    named = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    domain = F.when(named != "", named).otherwise(F.nullif(F.regexp_replace(host, r"[0-9]+$", ""), F.lit("")))
    return domain, F.nullif(F.regexp_extract(host, r"\.([^.0-9]+)$", 1), F.lit(""))


def identify_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents by text, source, and lang: source is the host, of whose name come domain and suffix; lang is the declared
    language, or, where it is null, what markup in the text declares."""
    host = F.lower("source")
    markup = F.nullif(F.lower(F.regexp_extract("text", r"(?i)<html[^>]{0,500}\blang\s*=\s*[\"']?([a-z]+)", 1)), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), "text", host.alias("host"), F.coalesce("lang", markup).alias("declared"))
    domain, suffix = _address(F.col("host"))
    return identify(rows, "id", "text", "declared", F.col("host"), domain, F.col("declared"), suffix).withColumnRenamed("id", id_col)


def visible_text(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>|&\w+;|&#\d+;", " ")


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Models from the documents; the host and its domain, the html lang attribute, and the end of the host's name."""
    host = F.nullif(F.lower(F.regexp_extract("url", r"^\w+://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    domain, suffix = _address(host)
    rows = pages.select(
        "page_id", visible_text(F.col("html")).alias("text"), host.alias("host"), domain.alias("domain"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1)), F.lit("")).alias("declared"), suffix.alias("suffix"),
    )
    return identify(rows, "page_id", "text", "declared", F.col("host"), F.col("domain"), F.col("declared"), F.col("suffix"), model=train(docs, "text", "lang"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(read(spark, sf_dir, "documents"))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_pages(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))
