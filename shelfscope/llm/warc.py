"""WARC archives without repeated payloads, and revisit resolution when they are read.

Writing: of the records with one payload, one is a response and the others are revisit
records that name it and carry no payload. Only headers (id, digest, length) are shuffled
to find that out, by payload digest; payloads are not compared. Reading: archives become
one row per record, and revisits are joined to the responses that they refer to.

Archives are gzip files of consecutive records, one file a task, written by Spark's own
commit protocol: a task that is repeated leaves no partial archive. They are read as lines
in order, so a task holds one record at a time and an archive may have any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import Workspace, stage

RESPONSE, REVISIT = "response", "revisit"
#: Payloads of fewer bytes are never worth a revisit record.
LEAST_BYTES = 1000
# The version line and the profile of revisits to an identical payload.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = "record_type string, record_id string, key string, url string, digest string, refers_to string, payload_bytes long, sound boolean"


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null, and no line break inside a value."""
    plain = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), plain, F.lit("\r\n")), F.lit(""))


def _record(kind: str, payload: Column, original: dict[str, Column], date: str) -> Column:
    """The text of one record but for its last line feed, which the writer adds."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _field("Content-Length", F.col("payload_bytes")), F.lit("\r\n")
    )
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        *(_field(name, value) for name, value in original.items()),
        _field("X-Page-ID", F.col("key")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(http) + F.octet_length(payload)),
        F.lit("\r\n"),
        http,
        payload.cast("string"),
        F.lit("\r\n\r"),
    ).alias("value")


def find_revisits(headers: DataFrame, space: Workspace, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The ``headers`` (row, record_id, key, url, digest, payload_bytes) that repeat a payload, each with its original's.

    The original is the record of the largest key, nulls last, then of the largest row. A
    digest's headers are summed up inside map tasks, so one that a third of all records
    share sends one header a task; the join that follows reads staged tables, whose hot
    digest Spark's skew handling splits.
    """
    large = headers.filter(F.col("payload_bytes") >= least_bytes)
    best = F.max(F.struct("key", "row", "record_id", "url")).alias("best")
    groups = large.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n")).filter("n > 1")
    names = {"row": "first_row", "record_id": "original_id", "url": "original_url"}
    originals = space.stage(groups.select("digest", *(F.col(f"best.{c}").alias(n) for c, n in names.items())), "originals").frame
    return large.join(originals, "digest").filter("row != first_row").drop("first_row")


def write_deduplicated(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES
) -> None:
    """Write one record per row of ``pages`` to gzip archives under ``path``, each large payload once.

    A null payload is an empty one; a null key or URL has no header line. Every row is a
    record, also one that repeats another's key or all of it. Line breaks in a URL are
    percent-encoded. Record ids and dates are new in every run. Other columns don't matter.

    The rows are staged once with their digests and numbers, so no later step depends on
    their order or hashes a payload again. A payload is shuffled at most once, by its row
    number (never by a hot digest), and only if the revisits are too many to broadcast.
    """
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    plain = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), body.alias("payload"))
    with Workspace(pages.sparkSession, "warc") as space:
        rows = plain.select(
            F.monotonically_increasing_id().alias("row"),
            F.uuid().alias("record_id"),
            "key",
            "url",
            F.sha1("payload").alias("digest"),
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            "payload",
        )
        rows = space.stage(rows, "rows").frame
        revisits = space.stage(find_revisits(rows.drop("payload"), space, least_bytes), "revisits").frame
        responses = rows.join(revisits.select("row"), "row", "left_anti")
        referred = {
            "WARC-Profile": F.lit(PROFILE),
            "WARC-Refers-To": F.concat(F.lit("<urn:uuid:"), F.col("original_id"), F.lit(">")),
            "WARC-Refers-To-Target-URI": F.col("original_url"),
            "WARC-Refers-To-Date": F.lit(date),
        }
        records = responses.select(_record(RESPONSE, F.col("payload"), {}, date)).unionByName(
            revisits.select(_record(REVISIT, F.lit(b""), referred, date))
        )
        records.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _parsed(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record in a stream of bytes."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            version, *lines = held[at:end].decode("utf-8", "replace").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record where one should begin: {version[:40]!r}")
            fields = {name.lower(): value.removeprefix(" ") for name, _, value in (line.partition(":") for line in lines)}
            block = end + 4
            after = block + int(fields["content-length"]) + 4
            if len(held) < after:
                break
            yield fields, bytes(held[block : after - 4])
            at = after
        del held[:at]
    if held:
        raise ValueError("an archive ends inside a record")


def _reader(payloads: bool):
    """Rows of ``HEADERS``, and the payload if asked, from the lines of whole archives."""

    def bare(value: str | None) -> str | None:
        return value.removeprefix("<urn:uuid:").removesuffix(">") if value is not None else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in HEADERS.split(", ")] + ["payload"] * payloads
        columns: list[list] = [[] for _ in names]
        size = 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.string()] * 6 + [pa.int64(), pa.bool_()] + [pa.binary()] * payloads
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        lines = (b"\n".join(b.column(0).to_pylist()) + b"\n" for b in batches if b.num_rows)
        for fields, block in _parsed(lines):
            kind = fields.get("warc-type")
            _, _, payload = block.partition(b"\r\n\r\n")
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            length, sound = None, None
            if kind == RESPONSE:
                length, sound = len(payload), hashlib.sha1(payload).hexdigest() == digest
            refers = bare(fields.get("warc-refers-to"))
            row = [kind, bare(fields.get("warc-record-id")), fields.get("x-page-id"), fields.get("warc-target-uri"), digest, refers, length, sound]
            for column, value in zip(columns, row + [payload] * payloads, strict=True):
                column.append(value)
            size += 1 + len(payload) * payloads
            if size >= 1 << (24 if payloads else 13):
                yield batch()
                columns, size = [[] for _ in names], 0
        yield batch()

    return read


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the gzip archives under ``path``: ``HEADERS``, and with ``payloads`` the payload (binary).

    ``payload_bytes`` and ``sound`` (the payload has the digest that its header says) are
    of what was read, and null for revisits. A file that ends inside a record is an error.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_reader(payloads), HEADERS + ", payload binary" * payloads)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every record with the payload that it stands for: ``payload_bytes``, ``digest``, ``refers_key``, ``sound``.

    A revisit gets the figures and the key of the response it refers to, joined on payload
    digest and record id; they are null if there is none. The join reads a staged table of
    headers, so the revisits of a hot digest can be split. The result reads that table.
    """
    headers = stage(records.select(*(field.split()[0] for field in HEADERS.split(", "))), "warc-headers").frame
    responses = headers.filter(F.col("record_type") == RESPONSE)
    named = responses.select(
        "digest",
        F.col("record_id").alias("refers_to"),
        F.col("key").alias("refers_key"),
        F.col("payload_bytes").alias("read_bytes"),
        F.col("sound").alias("read_sound"),
    )
    revisits = headers.filter(F.col("record_type") == REVISIT).join(named, ["digest", "refers_to"], "left")
    columns = ["key", "url", "record_type", "record_id", "digest", "payload_bytes", "sound", "refers_key"]
    resolved = revisits.withColumns({"payload_bytes": F.col("read_bytes"), "sound": F.col("read_sound")}).select(*columns)
    return responses.withColumn("refers_key", F.lit(None).cast("string")).select(*columns).unionByName(resolved)
