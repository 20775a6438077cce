"""Quality scores from a sparse ensemble of rules over text statistics.

A small forest is grown on labelled rows.  Every path from a root to a node is a
rule: a conjunction of bounds on statistics.  A logistic model with an absolute
penalty picks few of them and gives each a weight.  The rules that stay are one
Spark column, so scoring needs no model object.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import stored
from lendscope.llm.text_statistics import (
    RATIOS,
    labelled_sample,
    ratio_columns,
    statistics,
)

#: Labelled rows to learn from, about.
TRAINING_ROWS = 4000
INPUTS = (*[name for name, _, _ in RATIOS], "n_words")

# A rule: (statistic, is at most, bound) of each condition, all of which must hold.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """Rules with weights, and the weight of no rule."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, over the columns named in INPUTS."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: Rule) -> Column:
    """Whether all conditions of a rule hold."""
    found = F.lit(True)
    for name, at_most, bound in rule:
        found = found & ((F.col(name) <= bound) if at_most else (F.col(name) > bound))
    return found


def _simplified(path: Rule) -> Rule:
    """One bound per statistic and side, in a fixed order."""
    tightest: dict[tuple[str, bool], float] = {}
    for name, at_most, bound in path:
        known = tightest.get((name, at_most), bound)
        tightest[name, at_most] = min(known, bound) if at_most else max(known, bound)
    return tuple((name, at_most, bound) for (name, at_most), bound in sorted(tightest.items()))


def _paths(node, path: Rule = ()) -> set[Rule]:
    """All paths from the root of a fitted tree to its other nodes."""
    found = {_simplified(path)} if path else set()
    if node.getClass().getSimpleName() == "InternalNode":
        name, bound = INPUTS[node.split().featureIndex()], node.split().threshold()
        found |= _paths(node.leftChild(), (*path, (name, True, bound)))
        found |= _paths(node.rightChild(), (*path, (name, False, bound)))
    return found


def fit(
    sample: DataFrame, *, trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 5
) -> RuleModel:
    """Fit on rows with ``label`` (0 or 1) and the columns named in INPUTS."""
    totals = sample.agg(F.count("*").alias("n"), F.avg("label").alias("share")).head()
    if not totals["n"]:
        return RuleModel((), 0.0)
    if totals["share"] in (0.0, 1.0):
        return RuleModel((), 6.0 if totals["share"] else -6.0)
    inputs = VectorAssembler(inputCols=list(INPUTS), outputCol="features")
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird"
    ).fit(inputs.transform(sample))
    rules = sorted(set().union(*[_paths(t._java_obj.rootNode()) for t in forest.trees]))
    if not rules:
        return RuleModel((), 0.0)
    columns = [holds(r).cast("double").alias(f"rule_{i}") for i, r in enumerate(rules)]
    marked = VectorAssembler(
        inputCols=[f"rule_{i}" for i in range(len(rules))], outputCol="features"
    ).transform(sample.select("label", *columns))
    line = LogisticRegression(
        regParam=penalty, elasticNetParam=1.0, maxIter=60, standardization=False
    ).fit(marked.select("label", "features").cache())
    weighted = [(r, float(w)) for r, w in zip(rules, line.coefficients, strict=True) if abs(w) > 1e-6]
    return RuleModel(tuple(weighted), float(line.intercept))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    keep: Column | None = None,
    bound: int = TRAINING_ROWS,
) -> RuleModel:
    """Fit on about ``bound`` labelled documents; ``keep`` says which labels may be used."""
    sample = labelled_sample(documents, labels, label, bound, keep)
    known = sample.select("doc_id", "label").dropDuplicates(["doc_id"])
    counted = statistics(sample).select("doc_id", "n_words", *ratio_columns())
    return fit(stored(counted.join(known, "doc_id").coalesce(2), "labelled").cache())


def score_quality(
    documents: DataFrame,
    model: RuleModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.3,
    carry: bool = False,
) -> DataFrame:
    """One row per row of documents: doc_id, score, predicted; the whole row where carried.

    All texts are scored whole; a null text scores like an empty one, whose
    statistics are all 0.  A null id stays null, repeated rows come back each, an
    empty table gives an empty result, and other columns are not looked at.
    Without labels the score is 0.5; with labels of one class it is near that class.
    """
    counted = statistics(documents, id_column=id_column, text_column=text_column, carry=carry)
    whole = ["row"] * carry
    return (
        counted.select("doc_id", "n_words", *ratio_columns(), *whole)
        .select("doc_id", model.score().alias("score"), *whole)
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
