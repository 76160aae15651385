"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is a request, a response (or a revisit of an equal earlier one) and a
metadata record that point to each other by WARC-Concurrent-To. Records are written
by Spark's text writer, one string per record, so they reach any file system that
Spark can write to; they are read as binary files and cut by Content-Length. Files
hold a bounded number of records and are compressed as a whole.

Assembly joins requests and metadata, combined per identifier they point to, to the
responses, and gives one nested row per capture. Identifiers may point either way.

Defined cases: null payloads are empty. Payloads below ``MIN_REVISIT`` bytes are never
revisited. Rows that share the smallest id of equal payloads are all responses; a null
id never stands for others. Line breaks in an address are percent-encoded, a null
address gives no target. Requests and metadata without a response are left out of the
assembly. Records cut off at the end of a file raise an error.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import join_hot, lean_batches, stored

MIN_REVISIT = 100
#: Captures per file; three records each.
CAPTURES_PER_FILE = 2_000
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def _urn(*parts: Column) -> Column:
    """A record identifier that follows from its parts."""
    h = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column, fields: list[tuple[str, Column]], content: str, block: Column) -> Column:
    """One record without the two line ends behind it; fields that are null are left out."""
    head = [F.lit(f"WARC/1.1{_END}WARC-Type: "), kind, F.lit(_END)]
    for name, value in fields:
        head.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")))
    size = F.octet_length(block).cast("string")
    head += [F.lit(f"Content-Type: {content}{_END}Content-Length: "), size, F.lit(_END + _END), block]
    return F.concat(*head)


def with_revisits(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload) with digest, size and the page that each revisits.

    Only ids and digests are grouped; a digest with a third of all pages is met by
    broadcast. Pages that revisit are then the side that the pages are met with.
    """
    marked = pages.select(
        "*",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"),
    )
    keys = marked.filter(f"payload_bytes >= {MIN_REVISIT}").select("page_id", F.unhex("payload_digest").alias("digest"))
    keys = stored(spark, keys, "payload-digests")
    groups = keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
    groups = groups.filter("size > 1 and first_id is not null")
    later = join_hot(keys, groups, "digest", "size", keys.count())
    later = later.filter("first_id is not null and not page_id <=> first_id")
    later = later.select(
        F.col("page_id").alias("_page"), F.lower(F.hex("digest")).alias("_digest"), F.col("first_id").alias("refers_to")
    ).distinct()
    return marked.join(
        later, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left"
    ).drop("_page", "_digest")


def write(
    spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """Write a capture per row of ``pages`` to new files under ``path``."""
    plain = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.replace(F.replace(F.col(url_col).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"),
    )
    rows = with_revisits(spark, plain)
    page, digest, again = F.col("page_id"), F.col("payload_digest"), F.col("refers_to").isNotNull()
    own = F.when(again, _urn(F.lit("revisit"), page, digest)).otherwise(_urn(F.lit("response"), page, digest))
    target = ("WARC-Target-URI", F.col("url"))
    date = ("WARC-Date", F.lit(DATE))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(_END + _END),
    )
    response = _record(
        F.when(again, "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", own), date, target,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
            ("WARC-Profile", F.when(again, F.lit(_PROFILE))),
            ("WARC-Refers-To", F.when(again, _urn(F.lit("response"), F.col("refers_to"), digest))),
        ],
        "application/http; msgtype=response",
        F.when(again, http).otherwise(F.concat(http, F.col("payload"))),
    )
    parts = F.regexp_extract("url", r"^\w+://([^/?#]*)([^#]*)", 1), F.regexp_extract("url", r"^\w+://([^/?#]*)([^#]*)", 2)
    request = _record(
        F.lit("request"),
        [("WARC-Record-ID", _urn(F.lit("request"), own)), date, target, ("WARC-Concurrent-To", own)],
        "application/http; msgtype=request",
        F.concat(
            F.lit("GET "), F.coalesce(F.nullif(parts[1], F.lit("")), F.lit("/")), F.lit(f" HTTP/1.1{_END}Host: "),
            F.coalesce(parts[0], F.lit("")), F.lit(_END + _END),
        ),
    )
    metadata = _record(
        F.lit("metadata"),
        [("WARC-Record-ID", _urn(F.lit("metadata"), own)), date, target, ("WARC-Concurrent-To", own)],
        "application/warc-fields",
        F.concat(
            F.coalesce(F.concat(F.lit("page-id: "), page.cast("string"), F.lit(_END)), F.lit("")),
            F.lit("payload-length: "), F.col("payload_bytes").cast("string"), F.lit(_END),
        ),
    )
    (
        rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
        .write.option("lineSep", _END + _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * CAPTURES_PER_FILE)
        .text(path)
    )


_RECORDS = (
    "type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "declared_digest string, fields map<string, string>, payload binary, payload_bytes bigint, payload_sha256 string"
)


def records_of(raw: bytes):
    """The records of one archive: lower-cased headers, each with its values, and the block."""
    at, end = 0, len(raw)
    while at < end:
        if raw[at : at + 2] == b"\r\n":
            at += 2
            continue
        stop = raw.find(b"\r\n\r\n", at)
        if not raw.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no record starts at byte {at}")
        headers: dict[str, list[str]] = {}
        for line in raw[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        at = stop + 4 + size
        if at > end:
            raise ValueError("the last record is cut off")
        yield headers, raw[stop + 4 : at]


def _row(headers: dict[str, list[str]], block: bytes) -> tuple:
    def one(name):
        return headers.get(name, [None])[0]

    kind, payload, fields = one("warc-type"), block, {}
    if "http" in (one("content-type") or ""):
        _, _, payload = block.partition(b"\r\n\r\n")
    elif "warc-fields" in (one("content-type") or ""):
        for line in block.decode("utf-8", "replace").splitlines():
            name, colon, value = line.partition(":")
            if colon:
                fields[name.strip().lower()] = value.strip()
    return (
        kind, one("warc-record-id"), headers.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"),
        one("warc-date"), (one("warc-payload-digest") or ":").rpartition(":")[2].lower() or None,
        list(fields.items()), payload, len(payload), hashlib.sha256(payload).hexdigest(),
    )


def _parse(batches):
    text, many = pa.string(), pa.list_(pa.string())
    kinds = [text, text, many, text, text, text, text, pa.map_(text, text), pa.binary(), pa.int64(), text]
    names = [f.split()[0] for f in _RECORDS.replace("map<string, string>", "map").split(", ")]
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            if raw[:2] == b"\x1f\x8b":
                raw = gzip.decompress(raw)
            rows, size = [], 0
            for headers, block in records_of(raw):
                rows.append(_row(headers, block))
                size += len(block)
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, plain or compressed."""
    lean_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_parse, _RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture.

    ``record_id, type, target_uri, date, refers_to, declared_digest, payload,
    payload_bytes, payload_sha256, requests, metadata``; the last two are arrays of
    what points to the response or is pointed to by it.
    """
    responses = records.filter("type in ('response', 'revisit')")
    others = records.filter("type in ('request', 'metadata')")
    forward = others.select(F.explode("concurrent_to").alias("capture"), *others.columns)
    back = responses.select(F.explode("concurrent_to").alias("_other"), F.col("record_id").alias("capture")).join(
        others, F.col("_other") == F.col("record_id")
    )
    pointed = forward.unionByName(back.select("capture", *others.columns))
    parts = pointed.groupBy("capture").agg(
        F.collect_set(F.when(F.col("type") == "request", F.struct("record_id", "target_uri", "payload"))).alias("requests"),
        F.collect_set(
            F.when(F.col("type") == "metadata", F.struct("record_id", F.map_entries("fields").alias("fields")))
        ).alias("metadata"),
    )
    joined = responses.drop("concurrent_to", "fields").join(
        parts.withColumnRenamed("capture", "_capture"), F.col("record_id") == F.col("_capture"), "left"
    ).drop("_capture")
    as_maps = F.transform("metadata", lambda m: F.struct(m.record_id, F.map_from_entries(m.fields).alias("fields")))
    return joined.withColumn("metadata", as_maps)


def page_captures(spark: SparkSession, captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of assembled captures.

    Size and digest of a response are those of the bytes read; of a revisit, those
    that its metadata and header declare.
    """
    field = lambda name: F.col("metadata")[0]["fields"][name].cast("bigint")
    again = F.col("type") == "revisit"
    rows = captures.select(
        field("page-id").alias("page_id"),
        "record_id",
        F.when(again, field("payload-length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("declared_digest")).otherwise(F.col("payload_sha256")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").alias("target"),
    )
    rows = stored(spark, rows, "captures")
    sizes = rows.groupBy("target").agg(F.count(F.lit(1)).alias("size"))
    named = rows.filter("record_type = 'response'").groupBy("record_id").agg(F.min("page_id").alias("refers_to"))
    keyed = named.join(sizes, F.col("record_id") == F.col("target")).select("target", "refers_to", "size")
    return join_hot(rows, keyed, "target", "size", rows.count()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
