"""The trie of conversations that share their first turns, and what sharing saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import ready, stored

#: Height of a band: a node is added up to this many ancestors at once.
BAND = 8
#: Turns numbered by one task at a time, and ids of one list of members.
_PIECE, _IDS = 1024, 65_536
#: Every this many conversations share the beginning of the first of them.
_FAMILY, _MOST_SHARED = 100, 5
_TAGS = ["tag0", "tag1", "tag2", "tag3"]
_ENDLESS = "unhex(md5('root'))"


def _numbered(rows: DataFrame, piece: Column, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows with their place inside their piece of a conversation, and what pieces hold.

    A conversation of any length is numbered by many tasks: the second table has one row
    per piece with the number of turns before it (``before``).
    """
    rows = rows.withColumn("piece", piece)
    inside = Window.partitionBy("conv_id", "piece").orderBy(*order)
    pieces = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy(F.col("piece").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return rows.withColumn("place", F.row_number().over(inside)), pieces.select(
        "conv_id", "piece", "n", before.alias("before")
    )


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, without their texts, and all conversations.

    A turn has conv_id, depth (from 1), same (a digest of role and text) and chars; a
    conversation has conv_id.  Turns are ordered by number (null first), equal ones by
    role and digest of the text; those without conv_id belong to none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    thin = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("body"),
        F.length(text).cast("long").alias("chars"),
    )
    numbered, pieces = _numbered(
        thin,
        F.floor(F.col("turn") / _PIECE).cast("long"),
        [F.col("turn").asc_nulls_first(), F.col("role"), F.col("body")],
    )
    pieces = stored(pieces, "turn-pieces")
    sizes = pieces.groupBy("conv_id").agg(F.sum("n").alias("turns"))
    base = F.col("conv_id") - F.col("conv_id") % _FAMILY
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (_MOST_SHARED + 1)
    all_of_them = stored(
        sizes.select("conv_id", base.alias("base"), shared.alias("shared"))
        .join(sizes.select(F.col("conv_id").alias("base"), "turns"), "base", "left")
        .select(
            "conv_id", "base", "shared",
            F.least("shared", F.coalesce("turns", F.lit(0))).cast("long").alias("taken"),
        ),
        "conversations",
    )
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.hex("body"))))
    placed = stored(
        numbered.join(
            pieces.join(all_of_them, "conv_id").withColumnRenamed("piece", "at"),
            (numbered["conv_id"] == pieces["conv_id"])
            & numbered["piece"].eqNullSafe(F.col("at")),
        ).select(
            numbered["conv_id"],
            (F.col("before") + F.col("place")).alias("turn"),
            "shared", "taken", same.alias("same"), "chars",
        ),
        "placed-turns",
    )
    own = placed.where("turn > shared").select(
        "conv_id", (F.col("taken") + F.col("turn") - F.col("shared")).alias("depth"), "same", "chars"
    )
    heads = placed.where((F.col("turn") <= _MOST_SHARED) & (F.col("conv_id") % _FAMILY == 0))
    copied = heads.select(F.col("conv_id").alias("base"), F.col("turn").alias("depth"), "same", "chars")
    first = all_of_them.join(copied, "base").where("depth <= taken")
    return (
        own.unionByName(first.select("conv_id", "depth", "same", "chars")),
        all_of_them.select("conv_id"),
    )


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, key and chars of the last turn, for each prefix of each conversation.

    The key is a digest of four sums of hashes of (depth, turn), so it is found by
    running sums; equal keys are taken for equal prefixes (128 bits).
    """
    seeds = [F.xxhash64(F.lit(k), "depth", "same") for k in (1, 2)]
    low = F.lit(0xFFFFFFFF)
    halves = [h for s in seeds for h in (s.bitwiseAND(low), F.shiftrightunsigned(s, 32))]
    tagged = turns.select(
        "conv_id", "depth", "chars",
        F.floor(F.col("depth") / _PIECE).alias("piece"),
        *[h.alias(tag) for tag, h in zip(_TAGS, halves, strict=True)],
    )
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth")
    earlier = (
        Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = (
        tagged.groupBy("conv_id", "piece")
        .agg(*[F.sum(tag).alias(tag) for tag in _TAGS])
        .select(
            "conv_id", "piece",
            *[F.coalesce(F.sum(tag).over(earlier), F.lit(0)).alias(f"{tag}_before") for tag in _TAGS],
        )
    )
    running = tagged.select(
        "conv_id", "depth", "chars", "piece",
        *[F.sum(tag).over(inside).alias(tag) for tag in _TAGS],
    ).join(sums, ["conv_id", "piece"])
    key = F.unhex(
        F.md5(F.concat_ws(",", "depth", *[F.col(tag) + F.col(f"{tag}_before") for tag in _TAGS]))
    )
    roots = conversations.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.expr(_ENDLESS).alias("key"),
        F.lit(0).cast("long").alias("chars"),
    )
    return stored(
        running.select("conv_id", "depth", key.alias("key"), "chars").unionByName(roots),
        "prefixes",
    )


def _paths(rows: DataFrame, band: int) -> DataFrame:
    """The rows with ``path``: their ancestors in their band, then themselves.

    A band's root has the whole band above it as path.  Rows have conv_id, level (without
    gaps from 0), key and chars.
    """
    at = F.floor(F.col("level") / band)
    root = (F.col("level") % band == 0) & (F.col("level") > 0)
    banded = rows.withColumn(
        "band", F.explode(F.when(root, F.array(at, at - 1)).otherwise(F.array(at)))
    )
    steps = (
        banded.groupBy("conv_id", "band")
        .agg(F.array_sort(F.collect_list(F.struct("level", "key", "chars"))).alias("steps"))
        .select("conv_id", "band", "steps", F.posexplode("steps").alias("i", "step"))
    )
    # Of a band's root there are two rows: the one that ends the band above is kept.
    only = (F.col("step.level") == 0) | (F.col("i") > 0)
    return steps.where(only).select(
        "conv_id", "step.*", F.slice(F.col("steps.key"), F.lit(1), F.col("i") + 1).alias("path")
    )


def _in_band(nodes: DataFrame, band: int) -> DataFrame:
    """Totals of each node over its descendants in its band, itself included."""
    whole = F.when(F.col("level") % band == 0, F.array("key")).otherwise(F.col("path"))
    return (
        nodes.select(F.explode(whole).alias("key"), "leaves", "saved")
        .groupBy("key")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )


def subtree_totals(nodes: DataFrame, members: DataFrame, band: int = BAND) -> DataFrame:
    """key, leaves and saved of each node's whole subtree.

    Nodes have key, level, path, leaves and saved of their own.  Each is added to its
    ancestors in its band.  Bands' roots, with these totals, are the nodes of a trie
    ``band`` times lower, which is added up in the same way; its completed totals go from
    each root to the band above it.  So there are as many rounds as digits of the greatest
    depth to base ``band``, and a node gives at most ``band`` rows in each.
    """
    lowest = nodes.agg(F.max("level")).head()[0]
    levels = [(nodes, stored(_in_band(nodes, band), "band-totals"))]
    height = 1
    while lowest is not None and lowest >= band:
        lowest, height = lowest // band, height * band
        roots = members.where(F.col("depth") % height == 0).withColumn(
            "level", F.floor(F.col("depth") / height)
        )
        upper = _paths(roots, band).groupBy("key").agg(
            F.first("level").alias("level"), F.first("path").alias("path")
        )
        totals = levels[-1][1]
        upper = stored(upper.join(totals, "key"), "band-roots")
        levels.append((upper, stored(_in_band(upper, band), "band-totals")))
    complete = levels[-1][1]
    for nodes, totals in reversed(levels[:-1]):
        # The roots that hang below a band: their paths at this level name its nodes.
        hanging = nodes.where((F.col("level") % band == 0) & (F.col("level") > 0))
        above = F.explode(F.slice(F.col("path"), 1, band)).alias("above")
        given = (
            hanging.select("key", "path")
            .join(complete, "key")
            .select(above, "leaves", "saved")
            .withColumnRenamed("above", "key")
        )
        complete = stored(
            totals.unionByName(given)
            .groupBy("key")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")),
            "subtree-totals",
        )
    return complete


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's lists, which come one after the other, joined by commas."""
    key, digest = None, hashlib.sha256()

    def done(keys: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "digest"]
        )

    for batch in batches:
        keys, digests = [], []
        for own, part in zip(
            batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True
        ):
            if own != key:
                if key is not None:
                    keys.append(key)
                    digests.append(digest.hexdigest())
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(part.encode())
        yield done(keys, digests)
    if key is not None:
        yield done([key], [digest.hexdigest()])


def end_digests(members: DataFrame) -> DataFrame:
    """key and digest of the ids of the conversations that end there.

    Ids are joined in lists of bounded ranges first; a digest needs its bytes in order, so
    one task reads the lists of a node one after the other and holds one batch of them.
    """
    spark = ready(members.sparkSession)
    ends = members.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    lists = (
        ends.groupBy("key", F.floor(F.col("conv_id") / _IDS).alias("range"))
        .agg(ids.alias("ids"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")
        .sortWithinPartitions("key", "range")
        .select("key", "ids")
    )
    return lists.mapInArrow(_digests, "key binary, digest string")


def _with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The nodes with the conv_id of their parent.

    Parents of over a thousandth of all nodes, at most a thousand, are broadcast, so no
    task gets all children of one.
    """
    many = nodes.count() // 1000
    wide = children.where(F.col("n_children") > many).select("parent")
    names = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    wide_names = F.broadcast(names.join(wide, "parent"))
    of_wide = nodes.join(wide_names, "parent")
    of_others = nodes.join(F.broadcast(wide), "parent", "left_anti").join(names, "parent", "left")
    return of_wide.unionByName(of_others)


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Conversation c begins with the first h turns of conversation c - c % 100 (all if it
    has fewer, none if it is absent), h = crc32 of c's decimals % 6, then come its own
    turns after its first h.  Null roles and texts are empty ones; repeated rows are
    turns each; extra columns are not looked at; an empty table has no node.  Returns
    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    turns, ids = rebuilt_turns(conversations)
    members = prefixes(turns, ids)
    paths = _paths(members.withColumn("level", F.col("depth")), band)
    kinds = paths.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("level").alias("level"),
        F.count("*").alias("n_convs"),
        F.first("chars").alias("chars"),
        F.first("path").alias("path"),
    )
    parent = F.when(F.size("path") > 1, F.element_at("path", -2))
    found = stored(kinds.withColumn("parent", parent), "trie-nodes")
    children = stored(
        found.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")),
        "trie-children",
    )
    nodes = found.join(children.withColumnRenamed("parent", "key"), "key", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("long")
    )
    own = nodes.select(
        "key", "level", "path",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    totals = subtree_totals(own, members, band)
    named = _with_parents(nodes.drop("path"), children)
    return (
        named.join(totals, "key")
        .join(end_digests(members), "key", "left")
        .select(
            "conv_id",
            F.col("level").alias("depth"),
            "parent_conv_id", "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
