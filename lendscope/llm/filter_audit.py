"""What each filter of a chain removes, in every order the chain can have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import stored

#: The last filter of the audit: the text of a smaller id, anywhere in the table.
COPY = "E"
_WORDS = r"[\x20\x09-\x0D]+"
_ROWS_SETTING = "spark.sql.cteRecursionRowLimit"


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that look at it alone."""
    words = F.filter(F.split(text, _WORDS), lambda word: word != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": n_words < 200,
        "B": 100 * n_distinct < 50 * n_words,
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _label_flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id: whether any of its labels says good, and toxic."""
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("string").alias("label_key"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents counted by part and by the set of filters they fail.

    Columns part, mask (bit i is the i-th filter, A first), n, n_good, n_toxic.  A null
    text is an empty one and a null language the part ``''``.  A null doc_id is larger
    than all others and has no labels; rows that share an id and a text are no copies of
    each other.  Only thin rows are shuffled: texts are replaced by their digest and
    masks, and a text held by a third of all rows is a few counts per task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    failures = text_failures(F.col("body"))
    own = F.lit(0)
    for bit, letter in enumerate(failures):
        own = own.bitwiseOR(F.when(failures[letter], 1 << bit).otherwise(0))
    thin = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            text.alias("body"),
        )
        .select("doc_id", "part", F.unhex(F.sha2("body", 256)).alias("digest"), own.alias("own"))
        .groupBy("doc_id", "part", "digest", "own")
        .agg(F.count("*").alias("n"))
    )
    # A null id has no labels; its rows are dealt by their texts.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none "), F.hex("digest")))
    flagged = (
        thin.withColumn("label_key", key)
        .join(_label_flags(labels), "label_key", "left")
        .select(
            "doc_id", "part", "digest", "own", "n",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )
    # Of each text and kind of row: how many there are, and how many have the least id.
    least = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"))
    kinds = (
        flagged.groupBy("digest", "own", "part", "good", "toxic")
        .agg(F.sum("n").alias("n"), F.min(least).alias("least"),
             F.min(F.struct(least.alias("id"), F.col("n"))).alias("first"))
        .withColumn("n_first", F.col("first.n"))
    )
    of_text = Window.partitionBy("digest")
    copies = F.col("n") - F.when(
        F.col("least") == F.min("least").over(of_text), F.col("n_first")
    ).otherwise(0)
    counted = kinds.withColumn("copies", copies)
    sides = F.explode(
        F.array(
            F.struct(F.col("own").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
            F.struct(
                F.col("own").bitwiseOR(F.lit(1 << len(failures))).alias("mask"),
                F.col("copies").alias("n"),
            ),
        )
    )
    return (
        counted.select("part", "good", "toxic", sides.alias("side"))
        .groupBy("part", F.col("side.mask").alias("mask"))
        .agg(
            F.sum("side.n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("side.n")).otherwise(0)).alias("n_good"),
            F.sum(F.when(F.col("toxic"), F.col("side.n")).otherwise(0)).alias("n_toxic"),
        )
    )


def _counted(name: str, condition: str) -> str:
    """SQL: the sum of one count over the mask cells that meet a condition."""
    return (
        f"aggregate(filter(c.cells, x -> {condition}), 0L, (total, x) -> total + x.{name})"
    )


def audit_orders(cells: DataFrame, letters: str) -> DataFrame:
    """Counts of each step of each order of the filters, per part.

    A recursive query extends each prefix of an order by the letters that it lacks.  A
    level's rows carry the bits applied so far, meet the mask cells of their part (at most
    two to the number of letters, in one array) and emit the counts of their last step.
    """
    spark = cells.sparkSession
    packed = stored(
        cells.groupBy("part").agg(
            F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("cells")
        ),
        "mask-cells",
    )
    filters = ", ".join(
        f"named_struct('letter', '{letter}', 'bit', {1 << bit})"
        for bit, letter in enumerate(letters)
    )
    free, fails = "(x.mask & s.applied) = 0", "(x.mask & l.bit) != 0"
    query = f"""
        WITH RECURSIVE steps AS (
          SELECT part, '' AS prefix, 0 AS applied, 0 AS step, 0L AS kept, 0L AS removed,
                 0L AS redundant, 0L AS unique_fails, 0L AS good_lost, 0L AS toxic_lost
          FROM {{packed}}
          UNION ALL
          SELECT s.part, concat(s.prefix, l.letter), s.applied | l.bit, s.step + 1,
                 {_counted("n", f"(x.mask & (s.applied | l.bit)) = 0")},
                 {_counted("n", f"{free} AND {fails}")},
                 {_counted("n", f"NOT ({free}) AND {fails}")},
                 {_counted("n", "x.mask = l.bit")},
                 {_counted("n_good", f"{free} AND {fails}")},
                 {_counted("n_toxic", f"{free} AND {fails}")}
          FROM (SELECT *, explode(filter(array({filters}), f -> (f.bit & applied) = 0)) AS l
                FROM steps) s
          JOIN {{packed}} c ON c.part = s.part
        )
        SELECT * FROM steps WHERE step > 0"""
    before = spark.conf.get(_ROWS_SETTING)
    spark.conf.set(_ROWS_SETTING, "-1")
    try:
        steps = stored(spark.sql(query, packed=packed), "order-steps")
    finally:
        spark.conf.set(_ROWS_SETTING, before)
    orders = steps.where(F.col("step") == len(letters)).select(
        "part",
        F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"),
    )
    every_order = Window.partitionBy("part", F.substring("prefix", -1, 1))
    return (
        orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
        .join(steps, ["part", "step", "prefix"])
        .withColumn("shapley", F.sum("removed").over(every_order))
        .drop("prefix", "applied")
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Interaction of the five filters over documents, per language and over all orders.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley: 600 rows per part, zeros included; none for an empty table.
    Extra columns of either table are not looked at.
    """
    letters = "".join(text_failures(F.lit(""))) + COPY
    found = audit_orders(mask_cells(documents, labels), letters)
    return found.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    )
