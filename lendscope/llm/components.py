"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import stored


def _parents(links: DataFrame) -> DataFrame:
    """Each label that has a smaller neighbour, and the smallest root it leads to."""
    both = links.select(F.col("a").alias("label"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("label"), F.col("a").alias("other"))
    )
    steps = both.groupBy("label").agg(F.min("other").alias("parent")).where("parent < label")
    steps = stored(steps, "parents")
    while True:
        above = steps.select(F.col("label").alias("parent"), F.col("parent").alias("top"))
        jumped = stored(
            steps.join(above, "parent", "left").select(
                "label",
                F.coalesce("top", "parent").alias("parent"),
                F.col("top").isNotNull().alias("moved"),
            ),
            "jumped",
        )
        steps = jumped.drop("moved")
        if not jumped.where("moved").head(1):
            return steps


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after joining the components that links (a, b) of nodes touch.

    A label is the smallest node of its component.  Every round replaces each
    label by the smallest label its chain of smaller neighbours leads to, so the
    number of labels with links falls fast; a chain is followed by doubling.
    """
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        apart = stored(
            links.join(of_a, "a")
            .join(of_b, "b")
            .where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct(),
            "apart",
        )
        if not apart.head(1):
            return labels
        parents = _parents(apart)
        labels = stored(
            labels.join(parents, "label", "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            ),
            "labels",
        )
        # Linked nodes of one component need no second look; the rest is linked by labels.
        links = apart
