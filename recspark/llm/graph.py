"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of a link; the component is its smallest id.

    ``links`` has the long columns ``a`` and ``b``.  Each round hangs every end
    below its smallest neighbour, follows that twice, renames the ends and drops
    links inside a component, so links shrink fast; all state lies in stored
    tables and nothing but the end test reaches the driver.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    ends = stored(links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
                  .withColumn("component", F.col("id")), "link-ends")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("up"))
        up = stored(up, "link-up")
        top = stored(up.join(up.select(F.col("id").alias("up"), F.col("up").alias("top")), "up").select("id", "top"), "link-top")
        ends = stored(ends.join(top.withColumnRenamed("id", "component"), "component", "left")
                      .select("id", F.coalesce("top", "component").alias("component")), "link-ends")
        links = (links.join(top.select(F.col("id").alias("a"), F.col("top").alias("ta")), "a")
                 .join(top.select(F.col("id").alias("b"), F.col("top").alias("tb")), "b").filter("ta <> tb")
                 .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        links = stored(links, "links")
    return ends
