"""From raw documents to encoded training text, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.llm import language_crf, mixing, pieces, rule_quality
from lendscope.llm.common import drop, recording, stored, table
from lendscope.llm.near_dedup import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words whose most likely languages have less probability than this on average are in none,
#: and so are those of whose features a smaller share is known from two texts or more.
SURE_LANGUAGE, KNOWN_LANGUAGE = 0.5, 0.75
GOOD_FROM = 0.3
#: Bits of the map of rows that go.
_BITS = 1 << 23


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or more of the languages that the given ones teach.

    Texts without letters go, those whose words have no clear language each, and those
    whose words are not known from other texts, so that a wrong label cannot keep its own
    text; how many languages share a text does not matter.
    """
    model = language_crf.learn(docs, evidence=True)
    found = language_crf.identify(docs.select(*COLUMNS), model, carry=True, sure=True).where(
        (F.col("lang_pred") != language_crf.UNKNOWN)
        & (F.col("word_score") >= SURE_LANGUAGE)
        & (F.col("known_share") >= KNOWN_LANGUAGE)
    )
    return found.select("row.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from the labels call good."""
    model = rule_quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = rule_quality.score_quality(
        docs.select(*COLUMNS), model, threshold=GOOD_FROM, carry=True
    )
    return scored.where("predicted = 1").select("row.*")


def with_row_keys(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own (``row_key``), stored so that it stays the same."""
    keyed = docs.select(*COLUMNS).withColumn("row_key", F.monotonically_increasing_id())
    return stored(keyed, "row-keys")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words.

    Rows are told apart by a key of their own, so ids need not be there or differ: rows
    with a null id are documents like others, and of rows that share an id each is a
    document.  Of a group the row with the smallest (doc_id, text) stays, where a null id
    comes last.  A text without words is near no other; of its rows with one id that is
    not null and one text a single one stays.
    """
    rows = with_row_keys(docs)
    scratch: list[str] = []
    with recording(scratch):
        found = near_duplicates(rows, id_column="row_key", width=5).select(
            F.col("doc_id").alias("row_key"), "component_id"
        )
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    text = F.coalesce(F.concat(F.lit("="), "text"), F.lit(""))
    lone = F.when(wordless, F.concat(F.lit("="), F.col("doc_id").cast("string"), F.lit(":"), text))
    placed = stored(
        rows.select("row_key", "doc_id", lone.alias("lone"))
        .join(found, "row_key")
        .select(
            "row_key",
            "doc_id",
            F.coalesce("lone", F.col("component_id").cast("string")).alias("group"),
        ),
        "near-groups",
    )
    drop(spark, scratch)
    # Only where rows of a group share its smallest id are texts compared.
    by_id = placed.groupBy("group", "doc_id").agg(
        F.count("*").alias("n"), F.min("row_key").alias("row_key")
    )
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "n", "row_key")
    first = stored(
        by_id.groupBy("group").agg(F.min(order).alias("first")).select("group", "first.*"),
        "near-firsts",
    )
    kept = first.where("n = 1").select("row_key")
    tied = first.where("n > 1").select(
        F.col("group").alias("tied_group"), F.col("doc_id").alias("tied_id")
    )
    if tied.head(1):
        tying = placed.join(
            tied,
            (F.col("group") == F.col("tied_group"))
            & F.col("doc_id").eqNullSafe(F.col("tied_id")),
        ).select("row_key", "group")
        texts = F.struct("text", "lang", "source", "n_chars", "row_key")
        kept = kept.union(
            rows.join(tying, "row_key")
            .groupBy("group")
            .agg(F.min(texts).alias("first"))
            .select("first.row_key")
        )
    gone = stored(placed.select("row_key").join(kept, "row_key", "left_anti"), "near-gone")
    return without(rows, gone).select(*COLUMNS)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose ``row_key`` is not among those of ``gone``.

    A map of fixed size over hashes of the keys that go tells most rows that stay without
    a shuffle; only rows that share a bit with one that goes, and those that go, meet the
    keys themselves.
    """
    bit = F.pmod(F.xxhash64("row_key"), F.lit(_BITS))
    word, place = F.floor(bit / 64).cast("int"), (bit % 64).cast("int")
    words = gone.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("bits")
    )
    marked = rows.withColumn("of_word", word).join(
        F.broadcast(words), F.col("of_word") == F.col("word"), "left"
    )
    shares = F.coalesce(F.call_function("shiftright", F.col("bits"), place) % 2 != 0, F.lit(False))
    checked = marked.where(shares).select(*rows.columns).join(gone, "row_key", "left_anti")
    return marked.where(~shares).select(*rows.columns).unionByName(checked.select(*rows.columns))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as before, sources at evened shares; a row for each time one is taken.

    Rows are drawn by a hash of id and text, so ids need not be there or differ; rows
    that are equal in both are told apart by their number.
    """
    rows = docs.select(*COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text"))
    taken = mixing.mix(rows, id_column="row_key").select(
        F.col("doc_id").alias("row_key"), "copy"
    )
    # Only rows whose key occurs twice need numbers; in the order in which mix numbers
    # copies, where what ties is of one source and size.
    repeated = (
        rows.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key")
    )
    repeated = stored(repeated, "repeated-rows")
    numbered = Window.partitionBy("row_key").orderBy(
        "source", mixing.word_count("text"), "doc_id", "text", "lang", "n_chars"
    )
    single = rows.join(repeated, "row_key", "left_anti").withColumn("copy", F.lit(0))
    several = rows.join(repeated, "row_key", "left_semi").withColumn(
        "copy", (F.row_number().over(numbered) - 1).cast("int")
    )
    return single.unionByName(several).join(taken, ["row_key", "copy"]).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the pieces of each text, with the two next best segmentations."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("languages", known_languages),
    ("quality", good_quality),
    ("near_dedup", one_of_each_group),
    ("mixing", mixed_sources),
    ("encoding", encoded),
]

# Trained models, hashes of orders and piece lattices are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written.

    What a stage stored on its way is deleted once its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        scratch: list[str] = []
        with recording(scratch):
            docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
            drop(spark, scratch)
    return docs
