"""Files in and out: uploads, PDF readings through a seam, token tables, JSON packs, Markdown results; sinks by document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.ocr import TOKENS

PAGES = "source_id string, pdf_page int, block_index int, block string, x0 double, y0 double, x1 double, y1 double, engine string, error string"


def uploads(spark: SparkSession, path: str, signature: bytes = b"%PDF-", limit: int = 1 << 30) -> DataFrame:
    """Files by content: sha256, name, length, bytes. Others than `signature`, and larger than limit, go; equal files once."""
    rows = spark.read.format("binaryFile").load(path).where(F.col("length") <= limit)
    rows = rows.where(F.substring("content", 1, len(signature)) == F.lit(signature))
    named = rows.select(F.sha2("content", 256).alias("sha256"), F.regexp_replace("path", r"^.*/", "").alias("name"), "length", "content")
    first = named.groupBy("sha256").agg(F.min_by(F.struct("name", "length", "content"), "name").alias("f"))
    return first.select("sha256", T.safe_stem(F.col("f.name")).alias("stem"), "f.name", "f.length", "f.content")


Reader = Callable[[bytes], Iterator[tuple[int, int, str, float, float, float, float]]]


def extracted(files: DataFrame, readers: list[tuple[str, Reader]]) -> DataFrame:
    """Blocks of files (sha256, content), by the first reader that can read a file; if none can, a row with all errors.

    A reader yields (page, block, text, x0, y0, x1, y1). PDF libraries are not part of this package: this is their seam.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sha, content in zip(batch["sha256"], batch["content"], strict=True):
                errors = []
                for name, reader in readers:
                    try:
                        own = [(sha, p, b, t, x0, y0, x1, y1, name, None) for p, b, t, x0, y0, x1, y1 in reader(bytes(content))]
                    except Exception as e:  # any reader's own errors; kept as data
                        errors.append(f"{name}={e}")
                        continue
                    rows += own
                    break
                else:
                    rows.append((sha, None, None, None, None, None, None, None, None, "; ".join(errors)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")])

    out = files.select("sha256", "content").mapInPandas(work, PAGES)
    return out.withColumn("block", T.clean_text(F.col("block"))).where("error is not null or block <> ''")


#: A region is rendered at this scale.
SCALE = 1.8
#: content, page, box (x0, y0, x1, y1) and scale to an image.
Renderer = Callable[[bytes, int, list[float], float], bytes]


def region_crops(files: DataFrame, regions: DataFrame, render: Renderer, scale: float = SCALE) -> DataFrame:
    """An image for each region (source_id, region_id, pdf_page, bbox, reason_code) of files (source_id, content), as
    crop_file, crop and error. A region whose file is missing, or that can't be rendered, has no crop and an error.

    Files meet only regions: each file's bytes go once to a task, with its regions in one array. The renderer is a seam,
    as readers are.
    """
    own = regions.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("pdf_page", "region_id", "bbox", "reason_code"))).alias("regions"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content, found in zip(batch["source_id"], batch["content"], batch["regions"], strict=True):
                rows = []
                for r in found:
                    crop = error = None
                    try:
                        if content is None:
                            raise ValueError("no file")
                        crop = render(bytes(content), int(r["pdf_page"]), [float(x) for x in r["bbox"]], scale)
                    except Exception as e:  # any renderer's own errors; kept as data
                        error = str(e)
                    rows.append((source, r["region_id"], int(r["pdf_page"]), list(r["bbox"]), r["reason_code"], f"{r['region_id']}.png" if error is None else "", crop, error))
                yield pd.DataFrame(rows, columns=["source_id", "region_id", "pdf_page", "bbox", "reason_code", "crop_file", "crop", "error"])

    joined = own.join(files.select("source_id", "content"), "source_id", "left").select("source_id", "content", "regions")
    return joined.mapInPandas(work, "source_id string, region_id string, pdf_page int, bbox array<double>, reason_code string, crop_file string, crop binary, error string")


def crop_manifest(crops: DataFrame) -> DataFrame:
    """What a reader of crops gets, per source: the count, and a JSON of each region with its file."""
    one = F.struct("region_id", "pdf_page", "bbox", "crop_file", "reason_code")
    return crops.groupBy("source_id").agg(F.count("*").alias("region_count"), F.to_json(F.array_sort(F.collect_list(one))).alias("regions"))


def page_path(mode: Column, page: Column, kind: str = "md") -> Column:
    """Where a page's reading lies, below the folder of its run."""
    return F.concat(F.lit("pages/"), mode, F.lit("/"), F.format_string("page_%04d", page.cast("int")), F.lit(f".{kind}"))


def resolved(rows: DataFrame, listing: DataFrame, raw: str = "path", manifest: str = "manifest") -> DataFrame:
    """rows with resolved: the raw path if listing (path) has it, else the file of that name beside the manifest if it has
    that, else the raw path; and whether it was found. Paths meet by hash joins."""
    name = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    known = listing.select("path").distinct()
    beside = F.concat(F.regexp_extract(manifest, r"^(.*/)?[^/]*$", 1), name(raw))
    out = rows.withColumn("beside", beside)
    out = out.join(known.select(F.col("path").alias("as_is")), F.col(raw) == F.col("as_is"), "left").join(known.select(F.col("path").alias("near")), F.col("beside") == F.col("near"), "left")
    return out.withColumn("resolved", F.coalesce("as_is", "near", raw)).withColumn("found", F.coalesce("as_is", "near").isNotNull()).drop("beside", "as_is", "near")


def token_tables(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Token tables (TSV with a header line) as rows: key, ord, and the tokens' columns."""
    rows = texts.select(key, F.posexplode(T.lines(F.col(text))).alias("ord", "line")).where("ord > 0 and line <> ''")
    return rows.select(key, "ord", F.from_csv("line", TOKENS, {"sep": "\t", "quote": "\u0000", "mode": "PERMISSIVE"}).alias("t")).select(key, "ord", "t.*")


def json_packs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def screening_results(spark: SparkSession, path: str) -> DataFrame:
    """name, batch_no, text of each screen_result_*.md."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter="screen_result_*.md").select("value", F.col("_metadata.file_name").alias("name"))
    return rows.select("name", F.regexp_extract("name", r"(\d+)\.md$", 1).cast("int").alias("batch_no"), F.col("value").alias("text"))


def write_texts(texts: DataFrame, key: str, path: str) -> None:
    """One folder of text per document, each a whole document in one row; committed atomically by Spark."""
    texts.select(key, "text").write.mode("overwrite").partitionBy(key).option("lineSep", "\n").text(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """parquet, json, csv or orc; arrays and structs as JSON where the format is flat."""
    if kind == "csv":
        df = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
        options = {"header": "true"} | options
    df.write.mode("overwrite").format(kind).options(**options).save(path)
