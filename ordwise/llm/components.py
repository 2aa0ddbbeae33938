"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.store import saved

ROWS_A_TASK = 500_000


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in the links (a, b): comp is the smallest id
    reachable. Ids without links are not listed; nulls and loops are ignored.

    Each round takes the least label among the neighbours (a partial aggregate,
    so a hub's links meet map-side) and then the label of that label, which
    halves the paths. Labels are written out each round; only the count of
    changes reaches the driver. Links that fit one partition by their counted rows are
kept in one, so that small graphs need no shuffle a round.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = saved(links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("other"))).distinct(), "cc-links")
    if both.count() <= ROWS_A_TASK:
        both = both.coalesce(1)
    labels = saved(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("comp"))
                   .select("id", "comp"), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "comp"), "other").groupBy("id").agg(
            F.min("comp").alias("near"))
        low = labels.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("root"))
        step = saved(low.join(jump, "comp").select("id", "was", F.least("comp", "root").alias("comp")), "cc-step")
        changed = step.where("was <> comp").limit(1).count()
        labels = step.select("id", "comp")
        if not changed:
            return labels
