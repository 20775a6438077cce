"""MinHash near-duplicates by an inverted join over signature coordinates.

Each distinct shingle set is posted under its (coordinate, value) pairs.  Two sets
of similarity ``percent`` agree on nearly that share of all coordinates, so those
that agree on at least ``matches`` are compared in full.  A document enters only
the lists of its rarest pairs, as many as a partner with that many agreements
cannot avoid (the prefix); the frequent lists are skipped, and what they would
have counted is read from the two signatures.

A short list yields its pairs.  In a long one a pivot, the member with the most
company, is compared with all others; what links is one component from then on.
After that only members of different components are compared, each pair in the
first list that both are in, and by their sets inside that join, so that only what
links leaves it.  So a group of n near copies costs about n comparisons but for those
that hang together just below the threshold, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import hold, ready, stored, word_hashes
from lendscope.llm.components import merge

#: Coordinates of a signature, and how many of them, the first ones, have lists.
COORDINATES, LISTED = 128, 64
#: Standard deviations that the agreements of a pair at the least similarity may fall
#: short of their mean: all but about six pairs in a million are found.
SLACK = 4.75
#: Lists of more members have a pivot.
SHORT = 8
PIVOT_ROUNDS = 2
#: A list of more members is dealt to several tasks, about so many to each.
SPLIT = 500
_BITS = (1 << 22) + 15
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LONE = np.uint64(0xD6E8FEB86659FD93)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _PAIR
    return values ^ (values >> np.uint64(29))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Words are runs without ASCII white space, A-Z lower-cased.  A text of fewer
    words than ``width`` has its whole word sequence as its one shingle; one
    without words, or null, has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    ends = len(words) - size + 1
    # A shorter sequence starts from another constant: it equals no full shingle.
    rolled = np.full(ends, _LONE + np.uint64(size) if size < width else _PAIR, np.uint64)
    for i in range(size):
        rolled = _mixed(rolled) + each[i : i + ends]
    return np.unique(_mixed(rolled))


def _multipliers(coordinates: int) -> np.ndarray:
    drawn = np.random.default_rng(7).integers(0, 1 << 31, coordinates, dtype=np.uint32)
    return drawn * np.uint32(2) + np.uint32(1)


def least_matches(coordinates: int, percent: int) -> int:
    """Agreements of so many coordinates that pairs of that similarity hardly ever miss."""
    share = percent / 100
    return max(1, int(coordinates * share - SLACK * (coordinates * share * (1 - share)) ** 0.5))


def signature(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest value of each coordinate's order over the hashes."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), ~np.uint32(0))
    for start in range(0, len(short), 512):
        np.minimum(least, (short[start : start + 512] * factors[:, None]).min(1), out=least)
    return least.view(np.int32)


def _signatures(batches: Iterator[pa.RecordBatch], width: int, coordinates: int):
    hold("hashes", word_hashes.clear)
    factors = _multipliers(coordinates)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        sizes, high, low, signatures = [], [], [], []
        for text in texts:
            found = shingle_hashes(text, width)
            sizes.append(len(found))
            key = xxhash.xxh3_128_intdigest(found.tobytes())
            high.append((key >> 64) - (1 << 63))
            low.append((key & ((1 << 64) - 1)) - (1 << 63))
            if not len(found):
                signatures.append(None)
                continue
            signatures.append(signature(found, factors))
        yield pa.RecordBatch.from_arrays(
            [
                ids.cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(signatures, pa.list_(pa.int32())),
            ],
            names=["doc_id", "n_shingles", "key_high", "key_low", "signature"],
        )


def _marked(ids: DataFrame) -> np.ndarray:
    """A bit map of fixed size over the ids modulo its bits; other ids may share a bit."""
    words = ids.groupBy(F.expr(f"cast(pmod(doc_id, {_BITS}) div 32 as int)").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(doc_id, {_BITS}) % 32 as int))")).alias("bits")
    )
    found = words.toArrow()
    marks = np.zeros(_BITS // 32 + 1, np.uint32)
    marks[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return np.unpackbits(marks.view(np.uint8), bitorder="little").astype(bool)


def _sets(batches: Iterator[pa.RecordBatch], width: int, marks: np.ndarray, short: bool):
    hold("hashes", word_hashes.clear)
    for batch in batches:
        ids = batch.column(0).fill_null(0).to_numpy()
        batch = batch.filter(pa.array(marks[np.mod(ids, _BITS)]))
        found = [shingle_hashes(t, width) for t in batch.column(1).to_pylist()]
        sizes = pa.array([len(f) for f in found], pa.int32())
        if short:
            found = [np.unique(f >> np.uint64(32)).astype(np.uint32).view(np.int32) for f in found]
        else:
            found = [f.view(np.int64) for f in found]
        kind = pa.list_(pa.int32() if short else pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), sizes, pa.array(found, kind)], names=["node", "n", "shingles"]
        )


def _sets_of(
    texts: DataFrame, wanted: DataFrame, width: int, short: bool = False
) -> DataFrame:
    """node, n and shingles of the wanted ids (doc_id); short ones are halves of the hashes.

    Tasks drop most other texts by a map of fixed size, so that no text is shuffled.
    """
    marks = _marked(wanted)
    kind = "int" if short else "bigint"
    made = texts.select("doc_id", "text").mapInArrow(
        lambda batches: _sets(batches, width, marks, short),
        f"node long, n int, shingles array<{kind}>",
    )
    return made.join(wanted.withColumnRenamed("doc_id", "node"), "node", "left_semi")


def _prefixes(nodes: DataFrame, listed: int, matches: int) -> DataFrame:
    """(node, company, prefix): the lists a node must enter to meet every partner.

    ``company`` counts the postings of all lists the node could be in.
    """
    posts = nodes.select(
        "node",
        F.posexplode(F.slice("signature", 1, listed)).alias("coordinate", "value"),
    ).select(
        "node",
        (F.shiftleft(F.col("coordinate").cast("long"), 32) + F.col("value").cast("long")).alias(
            "post"
        ),
    )
    shared = posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        posts.join(shared, "post")
        .groupBy("node")
        .agg(
            F.sum("n").alias("company"),
            F.sort_array(F.collect_list(F.struct("n", "post"))).alias("lists"),
        )
        .where(F.size("lists") >= matches)
    )
    # Lists of one member come first in the order by length and count as entered.
    return ranked.select(
        "node",
        "company",
        F.expr(f"transform(slice(lists, 1, size(lists) - {matches - 1}), x -> x.post)").alias(
            "prefix"
        ),
    )


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with their label, of lists with more than one, and the list's figures."""
    labelled = lists.join(labels, "node")
    parts = labelled.groupBy("post", "label").agg(F.count("*").alias("n"))
    totals = parts.groupBy("post").agg(
        F.sum("n").alias("members"),
        F.count("*").alias("labels"),
        F.max_by("label", F.struct("n", "label")).alias("major"),
    )
    return labelled.join(totals.where("labels > 1").drop("labels"), "post")


def _kept_nodes(batches: Iterator[pa.RecordBatch], marks: np.ndarray):
    for batch in batches:
        yield batch.filter(pa.array(marks[np.mod(batch.column(0).to_numpy(), _BITS)]))


def _agreeing(pairs: DataFrame, nodes: DataFrame, matches: int) -> DataFrame:
    """Those of the pairs whose signatures agree often enough.

    Tasks drop the signatures of most nodes that are in no pair by a map of fixed size, so
    that they are not shuffled.
    """
    pairs = stored(pairs.distinct(), "near-pairs")
    marks = _marked(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
    wanted = nodes.select("node", "signature").mapInArrow(
        lambda batches: _kept_nodes(batches, marks), "node long, signature array<int>"
    )
    first = wanted.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    second = wanted.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .where(_agreements("sa", "sb") >= matches)
        .select("a", "b")
    )


def _agreements(one: str, other: str):
    return F.expr(f"aggregate(zip_with({one}, {other}, (x, y) -> int(x = y)), 0, (n, x) -> n + x)")


def _links(agreeing: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs that are similar in full."""
    agreeing = stored(agreeing, "near-agreeing")
    wanted = agreeing.select(F.col("a").alias("doc_id")).union(agreeing.select("b")).distinct()
    sets = stored(_sets_of(texts, wanted, width), "near-sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    compared = (
        agreeing.join(left, "a")
        .join(right, "b")
        .select("a", "b", F.size("xa").alias("na"), F.size("xb").alias("nb"),
                F.size(F.array_intersect("xa", "xb")).alias("both"))
    )
    similar = compared.where(f"100L * both >= {percent}L * (na + nb - both)")
    return stored(similar.select("a", "b"), "near-links")


def _linked_labels(texts, nodes, width: int, percent: int, coordinates: int, listed: int):
    """Component label of every node that is in a list."""
    matches = least_matches(coordinates, percent)
    prefixes = stored(_prefixes(nodes, listed, least_matches(listed, percent)), "prefixes")
    labels = prefixes.select("node", F.col("node").alias("label"))
    lists = prefixes.select("node", "company", F.explode("prefix").alias("post"))
    for _ in range(PIVOT_ROUNDS):
        lists = stored(_open(lists, labels), "near-open").select(
            "post", "node", "company", "label", "members"
        )
        pivots = (
            lists.where(F.col("members") > SHORT)
            .groupBy("post")
            .agg(F.max(F.struct("company", "node", "label")).alias("pivot"))
        )
        beside = lists.where(F.col("members") > SHORT).join(pivots, "post")
        pairs = beside.where("label <> pivot.label").select(
            F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")
        )
        short = lists.where(F.col("members") <= SHORT).select("post", "node", "label")
        other = short.select("post", F.col("node").alias("b"), F.col("label").alias("lb"))
        pairs = pairs.union(
            short.join(other, "post")
            .where("node < b and label <> lb")
            .select(F.col("node").alias("a"), "b")
        )
        links = _links(_agreeing(pairs, nodes, matches), texts, width, percent)
        labels = merge(labels, links)
        # A pivot has met all others of its list, a short list is done.
        lists = beside.where("node <> pivot.node").select("node", "company", "post")
    lists = stored(_open(lists, labels), "near-open").select(
        "post", "node", "label", "major", F.ceil(F.col("members") / SPLIT).alias("parts")
    )
    open_nodes = stored(lists.select(F.col("node").alias("doc_id")).distinct(), "near-open")
    sets = _sets_of(texts, open_nodes, width, short=True)
    members = lists.join(sets.join(prefixes.select("node", "prefix"), "node"), "node")
    # A long list is dealt in parts; each part meets all who are not in the largest component.
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    minor = members.where("label <> major").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("m_part"),
        *[F.col(c).alias(f"m_{c}") for c in ("post", "node", "label", "prefix", "n", "shingles")],
    )
    # Whatever is not in the list's largest component meets all of other components, in
    # the first list both are in.  Halves of hashes that fall together in a set could hide
    # a shared shingle, so as many are granted; what passes is compared in full.
    shared = (
        F.size(F.array_intersect("shingles", "m_shingles"))
        + F.col("n")
        - F.size("shingles")
        + F.col("m_n")
        - F.size("m_shingles")
    )
    met = dealt.join(
        minor,
        (F.col("post") == F.col("m_post"))
        & (F.col("part") == F.col("m_part"))
        & F.expr("label <> m_label and (label = major or node < m_node)")
        & F.expr(f"100 * n >= {percent} * m_n and 100 * m_n >= {percent} * n")
        & (F.expr("array_intersect(prefix, m_prefix)[0]") == F.col("post"))
        & (100 * shared >= percent * (F.col("n") + F.col("m_n") - shared)),
    )
    pairs = met.select(F.least("node", "m_node").alias("a"), F.greatest("node", "m_node").alias("b"))
    return merge(labels, _links(pairs.distinct(), texts, width, percent))


def _with_shared_ids(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels after linking the different texts that come with one id."""
    each = members.distinct()
    shared = each.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    links = stored(
        each.join(shared.where("n > 1"), "doc_id")
        .where("node <> a")
        .select("a", F.col("node").alias("b")),
        "shared-ids",
    )
    if not links.head(1):
        return labels
    touched = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    new = touched.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    return merge(stored(labels.union(new), "near-labels"), links)


def near_duplicates(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 2,
    percent: int = 80,
    coordinates: int = COORDINATES,
    listed: int = LISTED,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose sets of word shingles have 100 * intersection >= percent *
    union are linked; the set of a text with fewer words is its whole sequence.
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it
    is the document's own.  A null or wordless text is linked with nothing.  Rows
    with equal ids are one document for the links, and repeated rows come back as
    often as they are, so more than one may be kept.  A null id gives a null
    component and ``kept`` false and takes part in no link.  An empty table gives
    an empty result.  Other columns are not looked at.
    """
    spark = ready(documents.sparkSession)
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    signed = stored(
        texts.mapInArrow(
            lambda batches: _signatures(batches, width, coordinates),
            "doc_id long, n_shingles long, key_high long, key_low long, signature array<int>",
        ),
        "signatures",
    )
    known = signed.where("doc_id is not null and n_shingles > 0")
    key = ["key_high", "key_low"]
    classes = stored(
        known.groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")),
        "classes",
    )
    nodes = stored(
        known.join(classes.select(*key, "node"), key)
        .where("doc_id = node")
        .dropDuplicates(["node", *key])
        .select(F.col("doc_id").alias("node"), "signature", *key),
        "nodes",
    )
    nodes = nodes.drop(*key)
    labels = _linked_labels(texts, nodes, width, percent, coordinates, listed)
    labels = _with_shared_ids(known.join(classes, key).select("doc_id", "node"), labels)
    moved = labels.where("node <> label")
    groups = (
        classes.join(moved, "node", "left")
        .where("copies > 1 or label is not null")
        .select(*key, F.coalesce("label", "node").alias("component"))
    )
    return (
        signed.join(groups, key, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
            .alias("component_id"),
        )
        .withColumn(
            "kept",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)),
        )
    )
