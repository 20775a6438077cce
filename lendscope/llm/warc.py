"""Web archives: pages written as WARC records and read back.

A page is an HTTP response in chunked transfer framing.  A block longer than a
segment is cut into a first record and continuation records, which may stand in
any file.  Of pages with equal payloads one is a response and the others are
revisits that name it.  The reader parses each file by itself, brings the segments
of an origin together in order, checks their total length, undoes the framing and
gives revisits the payload length of what they refer to.

Files are written by Spark's text writer: a row is a record without its end, the
line separator is the end of a record, so the commit of files is Spark's own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import ready, stored
from lendscope.session import scratch_path

END = "\r\n\r\n"
#: Payloads of fewer bytes are never revisits.
LEAST_REVISITED = 100
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 4096
#: With records of bounded size this bounds a file, which one task reads as a whole.
RECORDS_A_FILE = 1000
_RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, digest string, "
    "origin string, number int, total long, block binary"
)
_NAMES = [part.split()[0] for part in _RECORD.split(", ")]


def payload_bytes(column: str = "html") -> Column:
    """The payload of a page in UTF-8; empty for null."""
    return F.coalesce(F.encode(F.col(column), "UTF-8"), F.lit(b""))


def record_name(page_id: Column, digest: Column) -> Column:
    """Record id of a page: rows with equal ids and payloads share one."""
    return F.concat(
        F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), digest
    )


def with_originals(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, and refers_to where another page is the response.

    Only ids and digests are grouped and joined; payloads are shuffled only where
    the revisits are too many to be sent to every task.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload_bytes().alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    named = rows.where((F.length("payload") >= LEAST_REVISITED) & F.col("page_id").isNotNull())
    named = named.select("page_id", "digest")
    groups = (
        named.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("refers_to < last")
        .drop("last")
    )
    revisits = named.join(groups, "digest").where("page_id > refers_to").distinct()
    return rows.join(stored(revisits, "revisits"), ["page_id", "digest"], "left")


def _chunked(payload: bytes, size: int) -> bytes:
    parts = [
        b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size])
        for i in range(0, len(payload), size)
    ]
    return b"".join([*parts, b"0\r\n\r\n"])


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is longer or shorter than its size")
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        raise ValueError("a response without the end of its headers")
    framed = b"transfer-encoding: chunked" in head.lower().replace(b"  ", b" ")
    return _unchunked(body) if framed else body


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields if v is not None]]
    return ("\r\n".join(lines) + END).encode()


def page_records(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    segment: int,
) -> list[bytes]:
    """The records of a page, each without its end."""
    name = f"urn:page:{'none' if page_id is None else page_id}:{digest}"
    uri = url.replace("\r", "%0D").replace("\n", "%0A") if url else None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    common = [
        ("WARC-Target-URI", uri),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        block = head + b"\r\n"
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", f"<{name}>"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            *common,
            ("Content-Length", len(block)),
        ]
        return [_header(fields) + block]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload, CHUNK_BYTES)
    cuts = [block[i : i + segment] for i in range(0, len(block), segment)]
    made = []
    for number, part in enumerate(cuts, 1):
        fields = [
            ("WARC-Type", "response" if number == 1 else "continuation"),
            ("WARC-Record-ID", f"<{name}>" if number == 1 else f"<{name}:{number}>"),
            *(common if number == 1 else common[1:2]),
            ("WARC-Segment-Number", number if len(cuts) > 1 else None),
            ("WARC-Segment-Origin-ID", f"<{name}>" if number > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if number == len(cuts) > 1 else None),
            ("Content-Length", len(part)),
        ]
        made.append(_header(fields) + part)
    return made


def _written(batches: Iterator[pa.RecordBatch], segment: int):
    for batch in batches:
        made: list[bytes] = []
        for row in batch.to_pylist():
            made += page_records(
                row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], segment
            )
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])


def write_archives(pages: DataFrame, path: str, *, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write pages (page_id, url, html) as gzip-compressed WARC files into a new folder.

    A null html is an empty payload; rows without page_id are responses of their
    own and are never referred to; a null url is left out.  Repeated rows are
    repeated records.  An empty table gives no records.
    """
    ready(pages.sparkSession)
    rows = with_originals(pages).select("page_id", "url", "payload", "digest", "refers_to")
    records = rows.mapInArrow(lambda batches: _written(batches, segment_bytes), "record binary")
    (
        # Bytes go to the file as they are; the cast changes none.
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_A_FILE)
        .text(path)
    )


def records_in(content: bytes) -> Iterator[tuple]:
    """The records of one archive file, plain or gzip-compressed in one or more members."""
    if content[:2] == b"\x1f\x8b":
        parts = []
        while content:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(content) + member.flush())
            content = member.unused_data
        content = b"".join(parts)
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:head].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in lines:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        begin = head + 4
        end = begin + int(fields["content-length"])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not as long as it says")
        name = fields["warc-record-id"].strip("<>")
        origin = fields.get("warc-segment-origin-id")
        number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
        refers = fields.get("warc-refers-to")
        yield (
            name,
            fields["warc-type"].lower(),
            fields.get("warc-target-uri"),
            refers.strip("<>") if refers else None,
            fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            origin.strip("<>") if origin else name,
            int(number) if number else None,
            int(total) if total else None,
            content[begin:end],
        )
        at = end + 4


def _parsed(batches: Iterator[pa.RecordBatch]):
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows = [
                (*r[:8], payload_of(r[8]) if r[1] == "response" and r[6] is None else r[8])
                for r in records_in(content.as_py())
            ]
            for start in range(0, len(rows), 256):
                columns = zip(*rows[start : start + 256], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES
                )


def _joined(batches: Iterator[pa.RecordBatch]):
    """Blocks put together from their segments, as payloads."""
    for batch in batches:
        payloads = [
            payload_of(b"".join(p["block"] for p in parts)) for parts in batch.column("parts").to_pylist()
        ]
        kept = [batch.column(n) for n in ("record_id", "target_uri", "digest", "copies")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(payloads, pa.binary())],
            names=["record_id", "target_uri", "digest", "copies", "payload"],
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record but continuations: record_id, record_type, target_uri, refers_to, digest,
    payload.

    ``digest`` is what the record says; a revisit has no payload.  Segments whose
    numbers have a gap, or whose lengths do not add up to the total they name, are
    an error.  Records that were written twice come back twice.
    """
    ready(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(_parsed, _RECORD)
    columns = ["record_id", "record_type", "target_uri", "refers_to", "digest"]
    whole = records.where("number is null").select(
        *columns, F.when(F.col("record_type") == "response", F.col("block")).alias("payload")
    )
    # Equal records of an origin fall together before its segments meet.
    segments = (
        records.where("number is not null")
        .groupBy("origin", "number")
        .agg(
            F.first("block").alias("block"),
            F.max("total").alias("total"),
            F.max("target_uri").alias("target_uri"),
            F.max("digest").alias("digest"),
            F.count("*").alias("copies"),
        )
    )
    origins = segments.groupBy(F.col("origin").alias("record_id")).agg(
        F.max("target_uri").alias("target_uri"),
        F.max("digest").alias("digest"),
        F.max("copies").alias("copies"),
        F.max("total").alias("total"),
        F.max("number").alias("last"),
        F.sum(F.length("block")).alias("length"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
    )
    sound = F.coalesce(
        (F.col("length") == F.col("total")) & (F.col("last") == F.size("parts")), F.lit(False)
    )
    checked = origins.select(
        "record_id",
        "target_uri",
        "digest",
        "copies",
        F.when(sound, F.col("parts"))
        .otherwise(
            F.raise_error(F.concat(F.lit("segments are missing of "), F.col("record_id")))
        )
        .alias("parts"),
    )
    joined = checked.mapInArrow(
        _joined, "record_id string, target_uri string, digest string, copies long, payload binary"
    )
    repeated = joined.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    return whole.union(
        repeated.select(
            "record_id",
            F.lit("response").alias("record_type"),
            "target_uri",
            F.lit(None).cast("string").alias("refers_to"),
            "digest",
            "payload",
        )
    )


def page_of(name: str) -> Column:
    """The page id in a record id."""
    found = F.split(F.col(name), ":")[2]
    return F.when(found != "none", found.cast("long"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages and read them back: page_id, payload_bytes, payload_digest, record_type,
    refers_to.

    Lengths and digests are those of the payloads as read; a revisit has those of
    the response it names, whose digest must be the one it says.  See
    ``write_archives`` for nulls, repeated rows and empty tables.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    read = stored(
        read_archives(spark, path).select(
            page_of("record_id").alias("page_id"),
            "record_id",
            "record_type",
            "refers_to",
            F.length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
            "digest",
        ),
        "read",
    )
    wrong = F.raise_error(F.concat(F.lit("the payload differs from the digest of "), "record_id"))
    responses = read.where("record_type = 'response'").select(
        "page_id",
        "payload_bytes",
        F.when(F.col("payload_digest") == F.col("digest"), F.col("payload_digest"))
        .otherwise(wrong)
        .alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    named = (
        read.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("original"))
        .agg(F.max("payload_bytes").alias("length"), F.max("payload_digest").alias("found"))
    )
    revisits = (
        read.where("record_type = 'revisit'")
        .join(named, F.col("refers_to") == F.col("original"), "left")
        .select(
            "page_id",
            F.col("length").alias("payload_bytes"),
            F.when(F.col("found") == F.col("digest"), F.col("found"))
            .otherwise(wrong)
            .alias("payload_digest"),
            "record_type",
            page_of("refers_to").alias("refers_to"),
        )
    )
    return responses.union(revisits)
