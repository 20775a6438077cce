"""Mixing sources by a temperature, as permutations cut into blocks within a token budget.

The share of a source is its share of tokens raised to an exponent and normalised:
1 keeps the given shares, 0 makes all equal.  The exponent is found by bisection for
a wanted entropy of the shares, or as the smallest at which no source is repeated
more often than allowed.

A source with a wanted number of tokens is passed through in epochs, each a
permutation of its documents by a hash, cut into blocks by the first bits of the
hash.  Whole epochs repeat all documents; the last one takes whole blocks in order
while they fit, and of the block in which the budget ends the documents that fit
in order.  So only that one block of a source is ever ranked.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import stored

BLOCKS = 256
#: Sources; more are an error, since their shares are held by the driver.
MOST_SOURCES = 10_000
_STEPS = 100


@dataclass(frozen=True)
class Mixture:
    """Exponent, share of each source, and tokens it gets."""

    exponent: float
    shares: dict[str | None, float]
    tokens: dict[str | None, int]


def _ordered(sizes: Mapping) -> list:
    return sorted(sizes, key=lambda s: (s is None, s))


def shares_at(sizes: Mapping[str | None, int], exponent: float) -> dict[str | None, float]:
    """Normalised powers of the sources' shares; a source without tokens gets none."""
    total = sum(sizes.values())
    powers = {
        s: math.exp(exponent * math.log(sizes[s] / total)) if sizes[s] else 0.0
        for s in _ordered(sizes)
    }
    whole = math.fsum(powers.values())
    return {s: p / whole if whole else 0.0 for s, p in powers.items()}


def entropy(shares: Mapping[str | None, float]) -> float:
    """In nats."""
    return -math.fsum(p * math.log(p) for p in shares.values() if p)


def _bisect(fits, low: float, high: float) -> float:
    """The smallest point at which ``fits`` holds, if it does from some point on."""
    if fits(low):
        return low
    for _ in range(_STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def temper(
    sizes: Mapping[str | None, int],
    budget: int,
    *,
    target_entropy: float | None = None,
    most_repeats: float | None = None,
) -> Mixture:
    """Choose the exponent between 0 and 1 and share out the budget.

    With ``target_entropy`` (nats) the shares have that entropy, or the nearest that
    exponents allow; with ``most_repeats`` no source is passed through more often
    than that, or as little as exponents allow; with both the larger exponent holds.
    Tokens are whole and add up to the budget; remainders go to the largest.
    """
    sized = {s: n for s, n in sizes.items() if n > 0}
    if not sized:
        return Mixture(1.0, dict.fromkeys(sizes, 0.0), dict.fromkeys(sizes, 0))
    exponent = 0.0
    if target_entropy is not None:
        exponent = _bisect(lambda x: entropy(shares_at(sized, x)) <= target_entropy, 0.0, 1.0)
    if most_repeats is not None:

        def fits(x: float) -> bool:
            return all(p * budget <= most_repeats * sized[s] for s, p in shares_at(sized, x).items())

        exponent = max(exponent, _bisect(fits, 0.0, 1.0))
    if target_entropy is None and most_repeats is None:
        exponent = 1.0
    shares = shares_at(sizes, exponent)
    exact = {s: shares[s] * budget for s in _ordered(sized)}
    tokens = {s: int(x) for s, x in exact.items()}
    left = budget - sum(tokens.values())
    for s in sorted(exact, key=lambda s: (tokens[s] - exact[s], s is None, s))[: max(left, 0)]:
        tokens[s] += 1
    return Mixture(exponent, shares, dict.fromkeys(sizes, 0) | tokens)


def word_count(text_column: str) -> Column:
    """Words between ASCII white space; 0 for null."""
    words = F.regexp_count(F.col(text_column), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def _hashed(epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), F.col("doc_id"), F.col("copy"))


def _block(order: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(order, 32) * blocks / F.lit(1 << 32)


def mix(
    documents: DataFrame,
    *,
    budget: float = 1.0,
    target_entropy_share: float | None = 0.95,
    most_repeats: float | None = 4.0,
    blocks: int = BLOCKS,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, epoch, block, position, copy.

    One row for each time a document is taken.  ``budget`` is the number of tokens
    as a multiple of the tokens given, ``target_entropy_share`` the wanted entropy
    as a share of the largest one (equal sources).  Tokens are words between white
    space.  Ordered by (block, position) within epochs the rows are the training
    order of a source.

    A source never gets more than its tokens by the budget and misses them by less
    than its next document.  A null source is a source of its own.  Documents
    without words take no tokens and come once in each whole epoch; if their
    source has no tokens at all they are left out.  Rows with equal ids count as
    ``copy`` 0, 1, ... in an order by their tokens; a null id is an id.  An empty
    table gives an empty result; other columns are not looked at.
    """
    taken = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("n_tokens"),
    )
    numbered = Window.partitionBy("doc_id").orderBy("source", "n_tokens")
    rows = stored(taken.withColumn("copy", F.row_number().over(numbered) - 1), "sized")
    found = rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).limit(MOST_SOURCES + 1)
    sizes = {r["source"]: r["n"] for r in found.collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sized = sum(n > 0 for n in sizes.values())
    wanted = math.log(sized) * target_entropy_share if sized and target_entropy_share else None
    mixture = temper(
        sizes,
        round(budget * sum(sizes.values())),
        target_entropy=wanted,
        most_repeats=most_repeats,
    )
    return realise(rows, sizes, mixture, blocks=blocks, seed=seed)


def realise(
    rows: DataFrame, sizes: Mapping, mixture: Mixture, *, blocks: int = BLOCKS, seed: int = 17
) -> DataFrame:
    """Rows (doc_id, source, n_tokens, copy) taken as often as the mixture says."""
    spark = rows.sparkSession
    plan = [
        (s, mixture.tokens[s] // n if n else 0, mixture.tokens[s] % n if n else 0)
        for s, n in sizes.items()
    ]
    # One row a source, and sources are bounded.
    plan_rows = F.broadcast(
        spark.createDataFrame(plan, "planned string, whole long, rest long")
    )
    planned = rows.join(plan_rows, F.col("source").eqNullSafe(F.col("planned")))
    whole = planned.where("whole > 0").withColumn(
        "epoch", F.explode(F.expr("sequence(0L, whole - 1)"))
    )
    columns = ["doc_id", "source", "n_tokens", "epoch", "block", "position", "copy"]

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("position", _hashed(F.col("epoch"), seed)).withColumn(
            "block", F.floor(_block(F.col("position"), blocks)).cast("int")
        )

    last = placed(planned.where("rest > 0").withColumn("epoch", F.col("whole")))
    sums = last.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    # A fixed number of blocks a source, so these windows stay small.
    in_order = Window.partitionBy("source").orderBy("block")
    before = sums.withColumn("up_to", F.sum("tokens").over(in_order)).select(
        F.col("source").alias("of"), F.col("block").alias("at"), "tokens", "up_to"
    )
    bounded = last.join(
        before, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))
    )
    fitting = bounded.where("up_to <= rest").select(*columns)
    inside = Window.partitionBy("source").orderBy("position", "doc_id", "copy")
    cut = (
        bounded.where("up_to > rest and up_to - tokens < rest")
        .withColumn("reached", F.col("up_to") - F.col("tokens") + F.sum("n_tokens").over(inside))
        .where("reached <= rest")
        .select(*columns)
    )
    return placed(whole).select(*columns).union(fitting).union(cut)
