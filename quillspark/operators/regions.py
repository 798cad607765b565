"""Visual regions: image boxes that hold text and aren't covered by native text, gathered to regions for recognition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G

COVERED, GAP, HEIGHT, NARROW = 0.45, 20.0, 300.0, 80.0
TOP, BOTTOM = 70.0, 65.0


def uncovered(images: DataFrame, native: DataFrame, keys: list[str]) -> DataFrame:
    """Images that no native box of their page covers by COVERED or more: a spatial anti join inside pages."""
    other = native.select(*[F.col(k).alias(f"n_{k}") for k in keys], F.col("box").alias("n_box"))
    on = G.overlap_ratio(F.col("box"), F.col("n_box")) >= COVERED
    for k in keys:
        on = (F.col(k) == F.col(f"n_{k}")) & on
    return images.join(other, on, "left_anti")


def vertical_groups(boxes: DataFrame, keys: list[str], gap: float = GAP) -> DataFrame:
    """Adds grp: a new one begins where a box lies more than gap under all before it (by y0, x0)."""
    w = Window.partitionBy(*keys).orderBy("box.y0", "box.x0", "image_id")
    low = F.max("box.y1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(low.isNull() | (F.col("box.y0") - low > gap), 1).otherwise(0)
    return boxes.withColumn("fresh", fresh).withColumn("grp", F.sum("fresh").over(w)).drop("fresh")


def split_tall(boxes: DataFrame, keys: list[str], height: float = HEIGHT) -> DataFrame:
    """Splits groups (keys, grp) so that a part's boxes end within height of its first; a fold over a group's boxes. Adds part."""
    item = F.struct(F.col("box.y0").alias("y0"), F.col("box.x0").alias("x0"), F.col("image_id"), F.col("box"))
    rows = boxes.groupBy(*keys, "grp").agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.struct(F.array().cast("array<int>").alias("parts"), F.lit(0).alias("part"), F.lit(0.0).alias("top"))

    def step(acc, x):
        fresh = (acc["part"] == 0) | (x["box"]["y1"] - acc["top"] > height)
        part = F.when(fresh, acc["part"] + 1).otherwise(acc["part"])
        return F.struct(F.concat(acc["parts"], F.array(part)).alias("parts"), part.alias("part"), F.when(fresh, x["y0"]).otherwise(acc["top"]).alias("top"))

    rows = rows.withColumn("parts", F.aggregate("items", start, step, lambda acc: acc["parts"]))
    return rows.select(*keys, "grp", F.explode(F.arrays_zip("items", "parts")).alias("x")).select(*keys, "grp", F.col("x.parts").alias("part"), "x.items.image_id", "x.items.box")


def _bands(images: DataFrame, native: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Of pages mostly covered by a large image: bands of HEIGHT with less than three native boxes' centres and no region."""
    box = F.col("box")
    large = images.where((G.area(box) / F.greatest(F.lit(1.0), F.col("page_width") * F.col("page_height")) >= 0.35) & (F.col("pixel_width") >= 500))
    pages = large.groupBy(*keys).agg(F.max("page_width").alias("page_width"), F.greatest(F.lit(TOP), F.max("page_height") - BOTTOM).alias("end"))
    pages = pages.where(F.col("end") > TOP)
    k = F.explode(F.sequence(F.lit(0), F.ceil((F.col("end") - TOP) / HEIGHT).cast("int") - 1)).alias("band")
    bands = pages.select(*keys, "page_width", "end", k)
    bands = bands.withColumn("box", G.rect(F.lit(0.0), F.lit(TOP) + F.col("band") * HEIGHT, F.col("page_width"), F.least(F.col("end"), F.lit(TOP) + (F.col("band") + 1) * HEIGHT)))
    centres = native.select(*keys, ((F.col("box.y0") + F.col("box.y1")) / 2).alias("c"))
    full = bands.join(centres, keys).where(F.col("c").between(F.col("box.y0"), F.col("box.y1"))).groupBy(*keys, "band").agg(F.count("*").alias("n")).where("n >= 3")
    taken = bands.join(found.select(*keys, F.col("box").alias("r")), keys).where(G.overlap_ratio(F.col("r"), F.col("box")) >= COVERED)
    out = bands.join(full.select(*keys, "band"), [*keys, "band"], "left_anti").join(taken.select(*keys, "band").distinct(), [*keys, "band"], "left_anti")
    return out.select(*keys, "box", F.lit(1).cast("long").alias("image_count"))


def detect(images: DataFrame, native: DataFrame, keys: list[str] = ["source_id", "pdf_page"]) -> DataFrame:  # noqa: B006
    """images: keys, image_id, box, page_width, page_height, pixel_width, pixel_height; native: keys, box.

    Regions by page; where a page has several, one that covers them all, so that recognition runs once a page.
    """
    box = F.col("box")
    small = images.where(G.text_like(box, F.col("page_height"), F.col("pixel_width"), F.col("pixel_height")))
    parts = split_tall(vertical_groups(uncovered(small, native, keys), keys), keys)
    size = images.groupBy(*keys).agg(F.max("page_width").alias("page_width"), F.max("page_height").alias("page_height"))
    found = parts.groupBy(*keys, "grp", "part").agg(G.union(box).alias("box"), F.count("*").alias("image_count"))
    found = found.where((F.col("image_count") > 1) | (F.col("box.x1") - F.col("box.x0") >= NARROW)).join(size, keys)
    found = found.select(*keys, G.expand(box, F.col("page_width"), F.col("page_height")).alias("box"), "image_count")
    every = found.unionByName(_bands(images, native, found, keys))
    out = every.groupBy(*keys).agg(G.union(box).alias("box"), F.sum("image_count").alias("image_count"), F.count("*").alias("n"))
    reason = F.when(F.col("n") > 1, "page_image_text_without_native_layer").otherwise("image_text_without_native_layer")
    edges = [F.round(F.col(f"box.{c}"), 2) for c in ("x0", "y0", "x1", "y1")]
    return out.select(F.format_string("VR-P%04d-001", F.col(keys[-1]).cast("int")).alias("region_id"), *keys, F.array(*edges).alias("bbox"), "image_count", reason.alias("reason_code"), F.lit("pending").alias("status"))
