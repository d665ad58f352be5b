"""WARC archives: captures written as records, read back as records, and assembled into transactions."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
RECORD_END = LINE + LINE
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit")
ATTACHED = ("request", "metadata")
KEY_FIELD = "capture-key"

#: Payloads of fewer bytes are always stored in full.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
#: Bytes of records that a reading task hands on at once.
BATCH_BYTES = 8 << 20

RECORD_SCHEMA = (
    "warc_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "warc_date string, header_digest string, http_head string, block string, payload binary, "
    "payload_bytes long, payload_digest string, problem string"
)


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32: five hex digits are four digits of base 32."""
    hexed = F.sha1(data)
    digits = F.concat(*[F.lpad(F.conv(F.substring(hexed, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _one_line(value: Column) -> Column:
    """A header's value; one that would break the line is percent-encoded as a whole."""
    return F.when(value.rlike(r"[\x00-\x1f\x7f]"), F.url_encode(value)).otherwise(value)


def _named(kind: Column | str, key: Column, url: Column, digest: Column) -> Column:
    """What a record's name is made of: the capture alone decides, so a repeated run writes the same archives."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    told = F.concat_ws("|", kind, F.coalesce(key, F.lit("")), F.coalesce(url, F.lit("")), digest)
    return F.md5(told.cast("binary"))


def _record_id(name: str) -> Column:
    parts = [F.substring(name, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def plan_captures(
    pages: DataFrame, key: str = "page_id", url: str = "url", content: str = "html", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """(key, url, payload, payload_bytes, payload_digest, first) of every row of ``pages``.

    ``first`` (key, url) is the capture that holds the payload in full, or null where the row's
    own does: of rows with equal payloads of at least ``least_bytes`` bytes the one of the
    largest key does, a null key being the smallest. Rows equal in key and payload are all full.
    A null content is an empty payload. Only digests that several rows have meet the rows
    again; the aggregate before combines in every map task, and a hot digest is split by AQE,
    as both sides of the join are plain shuffles.
    """
    data = F.coalesce(F.col(content), F.lit("").cast(pages.schema[content].dataType)).cast("binary")
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), data.alias("payload")
    ).select(
        "key", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    shared = cut(
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_bytes", "payload_digest")
        .agg(F.max(F.struct("key", "url")).alias("first"), F.count("*").alias("rows"))
        .filter("rows > 1").drop("rows")
    )
    own = F.col("first").isNull() | F.col("first.key").eqNullSafe(F.col("key"))
    return rows.join(shared, ["payload_bytes", "payload_digest"], "left").select(
        "key", "url", "payload", "payload_bytes", "payload_digest", F.when(~own, F.col("first")).alias("first")
    )


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record without its end. A header whose value is null is left out."""
    lines = [F.lit(VERSION + LINE)]
    for name, value in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit("")))
    return F.concat(F.concat(*lines, F.lit(LINE)).cast("binary"), block)


def records_of(captures: DataFrame, date: str = DATE) -> DataFrame:
    """(value): request, response or revisit, and metadata record of each of ``plan_captures``' rows.

    A revisit holds the HTTP head alone and names the full capture. Request and metadata name
    their capture by WARC-Concurrent-To; the metadata tells its key.
    """
    key, url, digest = F.col("key").cast("string"), F.col("url"), F.col("payload_digest")
    address = _one_line(url)
    full = F.col("first").isNull()
    kind = F.when(full, "response").otherwise("revisit")
    named = captures.select(
        "*",
        _named(kind, key, url, digest).alias("capture"),
        _named("request", key, url, digest).alias("request"),
        _named("metadata", key, url, digest).alias("metadata"),
        _named("response", F.col("first.key").cast("string"), F.col("first.url"), digest).alias("full"),
    )
    capture = _record_id("capture")
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(RECORD_END),
    ).cast("binary")
    asked = F.concat(
        F.lit("GET "),
        F.coalesce(F.nullif(F.regexp_extract(address, r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/")),
        F.lit(f" HTTP/1.1{LINE}Host: "),
        F.coalesce(F.regexp_extract(address, r"^[a-z]+://([^/?#]*)", 1), F.lit("")),
        F.lit(RECORD_END),
    ).cast("binary")
    told = F.coalesce(F.concat(F.lit(f"{KEY_FIELD}: "), _one_line(key), F.lit(LINE)), F.lit("")).cast("binary")
    common = [("WARC-Date", date), ("WARC-Target-URI", address)]
    stored = _record(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", capture),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
            ("WARC-Profile", F.when(~full, REVISIT_PROFILE)),
            ("WARC-Refers-To", F.when(~full, _record_id("full"))),
            ("WARC-Refers-To-Target-URI", F.when(~full, _one_line(F.col("first.url")))),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        F.when(full, F.concat(head, F.col("payload"))).otherwise(head),
    )
    attached = [
        _record(
            [
                ("WARC-Type", what),
                ("WARC-Record-ID", _record_id(what)),
                *common,
                ("WARC-Concurrent-To", capture),
                ("Content-Type", media),
            ],
            block,
        )
        for what, media, block in (
            ("request", "application/http;msgtype=request", asked),
            ("metadata", "application/warc-fields", told),
        )
    ]
    records = named.select(F.explode(F.array(attached[0], stored, attached[1])).alias("value"))
    return records.select(F.col("value").cast("string").alias("value"))


def write_archives(captures: DataFrame, path: str, date: str = DATE) -> None:
    """Write archives to a folder, a gzip file for each partition. The bytes of a record go through
    Spark's text writer untouched, with the two line ends after a record as its separator."""
    records_of(captures, date).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


class _Parser:
    """Takes the lines of archives and gives records; it holds the record at hand and no more."""

    def __init__(self, payload: bool):
        self.payload = payload
        self.file: int | None = None
        self.head: list[bytes] | None = None
        self.need = -1
        self.parts: list[bytes] = []
        self.after = 0

    def line(self, data: bytes) -> Iterator[tuple]:
        if self.need >= 0:
            whole = data + b"\r\n"
            if len(whole) <= self.need:
                self.parts.append(whole)
                self.need -= len(whole)
                if self.need == 0:
                    self.after = 2
                    yield self.done(None)
                return
            self.parts.append(whole[: self.need])
            rest = whole[self.need :]
            self.after = 1
            yield self.done(None if rest == b"\r\n" else "text after the block")
            if rest != b"\r\n":
                self.after = 0
                yield from self.line(rest[:-2])
        elif self.head is not None:
            if data:
                self.head.append(data)
                return
            length = self.headers().get("content-length", [""])[-1]
            if not length.isdigit():
                yield self.done("no length")
                return
            self.need, self.parts = int(length), []
            if self.need == 0:
                self.after = 2
                yield self.done(None)
        elif data.startswith(b"WARC/"):
            self.head = []
            self.after = 0

    def headers(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        last = None
        for raw in self.head or []:
            if raw[:1] in (b" ", b"\t") and last:  # a folded line
                found[last][-1] += " " + raw.decode("utf-8", "replace").strip()
                continue
            name, _, value = raw.decode("utf-8", "replace").partition(":")
            last = name.strip().lower()
            found.setdefault(last, []).append(value.strip())
        return found

    def end(self) -> Iterator[tuple]:
        """The file is over: a record that is not complete is given as truncated."""
        if self.head is not None:
            yield self.done("truncated")
        self.after = 0

    def done(self, problem: str | None) -> tuple:
        headers, block = self.headers(), b"".join(self.parts)
        self.head, self.need, self.parts = None, -1, []

        def one(name: str) -> str | None:
            return headers.get(name, [None])[0]

        kind = (one("warc-type") or "").lower()
        digest = one("warc-payload-digest")
        head, text = None, None
        body = block
        if (one("content-type") or "").startswith("application/http"):
            start, _, body = block.partition(b"\r\n\r\n")
            head = start.decode("utf-8", "replace")
        if kind not in CAPTURES:
            text = block.decode("utf-8", "replace")
        return (
            kind,
            one("warc-record-id"),
            headers.get("warc-concurrent-to", []),
            one("warc-refers-to"),
            one("warc-target-uri"),
            one("warc-date"),
            digest.partition(":")[2] or digest if digest else None,
            head,
            text,
            body if self.payload and kind in CAPTURES else None,
            len(body),
            base64.b32encode(hashlib.sha1(body).digest()).decode(),
            problem,
        )


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives at ``path`` (``RECORD_SCHEMA``).

    Archives are gzip files, as a whole or record by record, so each is read by one task, as a
    stream of its lines: a task holds one record at a time. Blocks are measured by their
    Content-Length and may hold anything, line ends and WARC headers included. ``payload_bytes``
    and ``payload_digest`` are computed from the bytes that were read; ``header_digest`` is what the
    header claims. Without ``payload`` the bytes stay behind. A record that the file's end cuts, that
    has no length, or that is followed by something else than line ends is given with its
    ``problem``; reading goes on at the next line that starts a record. A plain file is read
    as well if Spark has no reason to split it, else an error tells so.
    """
    lines = spark.read.option("lineSep", LINE).text(path).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    kinds = [
        pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 6, pa.binary(), pa.int64(), pa.string(), pa.string()
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

        parser, rows, held = _Parser(payload), [], 0
        for batch in batches:
            files = batch.column(0).to_numpy()
            if batch.num_rows and batch.column(1).to_numpy().max() > 0:
                raise ValueError("a plain archive was split between tasks: compress it with gzip")
            for i, value in enumerate(batch.column(2)):
                if files[i] != parser.file:
                    rows.extend(parser.end())
                    parser.file = files[i]
                for row in parser.line(value.as_py()):
                    rows.append(row)
                    held += len(row[9] or b"") + len(row[8] or "") + 500
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
        rows.extend(parser.end())
        if rows:
            yield batch_of(rows)

    return lines.mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture, a response or revisit record, with what is concurrent to it.

    Columns: record_id, record_type, target_uri, warc_date, refers_to, http_head, payload, payload_bytes,
    payload_digest, header_digest, problem, request (record_id, http_head, block), metadata (record_id, block),
    n_requests, n_metadata. A request or metadata record belongs to the captures that its
    WARC-Concurrent-To names and to those that name it. If several of a kind do, the one of the
    smallest record id is nested and all are counted (``unattached`` and the records themselves
    hold the rest). Repeated capture records stay repeated; the attached are reduced to one row
    a capture before they meet it, by an aggregate that combines in every map task, so that
    neither a hot capture nor repeated records multiply. A record without an id attaches
    nothing. ``records`` is read three times: give it stored.
    """
    attached = records.filter(F.col("warc_type").isin(*ATTACHED)).select(
        "warc_type", "record_id", "concurrent_to", "http_head", "block"
    )
    naming = (
        records.filter(F.col("warc_type").isin(*CAPTURES) & F.col("record_id").isNotNull())
        .select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id"))
        .distinct()
    )
    pairs = attached.select(F.explode("concurrent_to").alias("capture"), "warc_type", "record_id", "http_head", "block")
    pairs = pairs.unionByName(attached.join(naming, "record_id").select(*pairs.columns))
    request, metadata = F.col("warc_type") == "request", F.col("warc_type") == "metadata"
    grouped = pairs.groupBy("capture").agg(
        F.min(F.when(request, F.struct("record_id", "http_head", "block"))).alias("request"),
        F.min(F.when(metadata, F.struct("record_id", "block"))).alias("metadata"),
        F.count_if(request).alias("n_requests"),
        F.count_if(metadata).alias("n_metadata"),
    )
    captures = records.filter(F.col("warc_type").isin(*CAPTURES))
    none = F.lit(0).cast("long")
    return captures.join(grouped, captures["record_id"] == grouped["capture"], "left").select(
        "record_id", F.col("warc_type").alias("record_type"), "target_uri", "warc_date", "refers_to", "http_head",
        "payload", "payload_bytes", "payload_digest", "header_digest", "problem", "request", "metadata",
        F.coalesce("n_requests", none).alias("n_requests"), F.coalesce("n_metadata", none).alias("n_metadata"),
    )


def unattached(records: DataFrame) -> DataFrame:
    """The request and metadata records that no capture of ``records`` is concurrent to."""
    captures = records.filter(F.col("warc_type").isin(*CAPTURES))
    named = captures.select(F.explode(F.concat(F.array("record_id"), "concurrent_to")).alias("name")).distinct()
    attached = records.filter(F.col("warc_type").isin(*ATTACHED))
    found = (
        attached.select("record_id", F.explode(F.concat(F.array("record_id"), "concurrent_to")).alias("name"))
        .join(named, "name", "left_semi").select("record_id").distinct()
    )
    return attached.join(found, "record_id", "left_anti")


def capture_key(kind: str) -> Column:
    """The key that a capture's metadata tells, as ``kind``; null where it tells none."""
    told = F.regexp_extract(F.col("metadata.block"), rf"(?:^|\n){KEY_FIELD}: ([^\r\n]*)", 1)
    return F.nullif(told, F.lit("")).try_cast(kind)


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """``captures`` with ``referred``: the response that a revisit refers to, as (key, payload,
    payload_bytes, payload_digest); null for a response, or if the archives lack it.

    The key is read as text. Only responses that something refers to are gathered, once each,
    and checkpointed, so both sides of the join are plain shuffles and AQE splits a response
    that a third of all captures refer to. ``captures`` is read four times: give it stored.
    """
    revisits = captures.filter(F.col("refers_to").isNotNull())
    names = revisits.select(F.col("refers_to").alias("full_id")).distinct()
    full = captures.filter("record_type = 'response'").select(
        F.col("record_id").alias("full_id"),
        F.struct(
            capture_key("string").alias("key"), "payload", "payload_bytes", "payload_digest"
        ).alias("referred"),
    ).join(names, "full_id", "left_semi")
    full = cut(full.groupBy("full_id").agg(F.min("referred").alias("referred")))
    others = captures.filter(F.col("refers_to").isNull())
    found = revisits.join(full, revisits["refers_to"] == full["full_id"], "left").drop("full_id")
    return found.unionByName(others.withColumn("referred", F.lit(None).cast(full.schema["referred"].dataType)))
