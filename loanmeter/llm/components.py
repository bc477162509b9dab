"""Connected components of a link table, by alternating star contraction.

Each round replaces links by links to smaller ids: the large star moves the larger neighbours of a node to
its smallest one, the small star does so for the smaller neighbours. What remains in the end are stars
around the smallest id of each component. Links stay in tables; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmeter.llm.shared_tables import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every linked node but the smallest of its component.

    ``links`` has two columns of ids; direction, repeats and loops do not matter.
    """
    a, b = links.columns
    stars = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    stars, mark = stored(stars, "stars"), None
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return stars.toDF("node", "component")
        mark = now


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("m"))
    moved = both.where("v > u").join(least, F.col("u") == F.col("centre"))
    # Repeats are left to the small star.
    return moved.select(F.col("v").alias("u"), F.least("m", "centre").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("m"))
    moved = links.join(least, F.col("u") == F.col("centre")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.toDF("u", "v")).distinct()
