"""Follow ``page -> next page`` links of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.session import ensure_checkpoint_dir


def follow_links(starts: DataFrame, links: DataFrame) -> DataFrame:
    """Pages reached from each start, in visiting order.

    ``starts`` has ``(start)``, ``links`` has ``(page, next)`` with one row per
    page.  Returns ``(start, position, page)``, position 0 being the start.  A
    page already visited ends its chain, so cycles are safe.

    Links are doubled: after round *k* every page knows the page ``2**k`` steps
    ahead, so a chain of a million pages takes twenty joins instead of a
    million.  All joins are on the unique page, hence free of hot keys.
    """
    ensure_checkpoint_dir(starts.sparkSession)
    jump = links.where(F.col("next").isNotNull()).select("page", "next").checkpoint()
    reached = (starts.where(F.col("start").isNotNull()).distinct()
               .select("start", F.lit(0).cast("bigint").alias("position"),
                       F.col("start").alias("page")))
    step, known = 1, -1
    while True:
        ahead = reached.join(jump, "page").select(
            "start", (F.col("position") + step).alias("position"), F.col("next").alias("page"))
        # the earliest visit wins; a cycle only adds later visits of known pages
        reached = (reached.unionByName(ahead).groupBy("start", "page")
                   .agg(F.min("position").alias("position")).checkpoint())
        found = reached.count()
        if found == known:
            return reached.select("start", "position", "page")
        known = found
        jump = jump.join(jump.select(F.col("page").alias("next"), F.col("next").alias("__far")),
                         "next").select("page", F.col("__far").alias("next")).checkpoint()
        step *= 2
