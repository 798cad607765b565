"""Dense ordinals in a total order without one task per partition key.

row_number() over a key that holds a third of all rows is one task's work. Here rows are numbered inside buckets (an
order-preserving function of the order), and the buckets' counts are summed up over the far fewer buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, name: str, keys: list[str], *order: str) -> DataFrame:
    """ordinal for keys of bounded size (a source): one window, which reads df once, and shuffles nothing where df is dealt by
    some of the keys already."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def ordinal(df: DataFrame, name: str, keys: list[str], bucket: Column, *order: str) -> DataFrame:
    """df with column name: 1, 2, ... for each value of keys, by bucket, then order. order should be total."""
    rows = df.withColumn("__b", bucket)
    counts = rows.groupBy(*keys, "__b").agg(F.count("*").alias("__n"))
    before = counts.select(*keys, "__b", (F.sum("__n").over(Window.partitionBy(*keys).orderBy("__b")) - F.col("__n")).alias("__before"))
    inside = rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order)))
    same = [rows_key.eqNullSafe(key) for rows_key, key in ((inside[k], before[k]) for k in [*keys, "__b"])]
    on = same[0]
    for more in same[1:]:
        on = on & more
    out = inside.join(before, on).withColumn(name, F.col("__r") + F.col("__before"))
    return out.select(*[inside[c] for c in df.columns if c != name], name)
