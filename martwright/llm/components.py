"""Connected components of a link table, by alternating star contractions.

Each round relinks all larger neighbours of a node to its smallest neighbour
(large star), then the smaller ones (small star); the number of rounds grows
with the logarithm of the longest path.  Rounds are joins and grouped minima
on node ids, written to the shared folder; only whether the work is done
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written to and read from the shared folder (cuts the lineage)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text(columns: list[str], text: Column, changed: Column) -> list[Column]:
    """The columns with the new text; ``n_chars`` follows where it changed."""
    return [text.alias(c) if c == "text" else
            F.when(changed, F.length(text).cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c)
            for c in columns]


def _starred(links: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has just one, which has
    none itself: then links already lead to each component's smallest node."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("x"), F.lit(0).alias("up")))).alias("e"))
    up = ends.groupBy("e.x").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
    return up.where("up > 1 or (up = 1 and low = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b): for every node ``a`` with a smaller node in its component, the
    component's smallest node ``b``.  links: (a, b) in any order."""
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    e = stored(e, "links")
    while not _starred(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = stored(small.select("x.a", "x.b").where("a > b").distinct(), "links")
    return e
