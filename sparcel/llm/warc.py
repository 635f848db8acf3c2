"""WARC archives: writing pages as request, response and metadata records, reading, and assembling captures.

Writing is a projection and Spark's text writer, with the record separator as line separator: any
store that Spark writes to will do, and the commit protocol leaves no half archives behind. Equal
payloads are found by their digests; one record holds the payload, the others are revisits of it.

Reading splits at the version line, which any payload may hold as well, so fragments are joined
again until the record has as many bytes as its header says. Archives are gzip files, hence each is
read by one task, in order, record by record.

Assembling joins the records of a transaction through ``WARC-Concurrent-To``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
SEPARATOR = "\r\n\r\n"
#: Payloads from this size on are stored once.
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "content_type string, payload_bytes long, payload_digest string, stated_digest string, payload binary, fields string, whole boolean"
)


def _record(kind: str, key: Column) -> Column:
    """A record id that depends on the page and the kind of record alone."""
    h = F.md5(F.concat(F.lit(kind + "|"), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; those with a null value are left out."""
    made = [F.coalesce(F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v), F.lit("\r\n")), F.lit("")) for name, v in pairs]
    return F.concat(*made)


def _whole(header: Column, block: Column) -> Column:
    return F.concat(F.lit(VERSION + "\r\n"), header, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(SEPARATOR), block)


def archive_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(value): the text of three records for every page, without the separator behind them.

    * A null payload is empty. Null ids and urls leave their header lines out; line breaks in a url
      are percent-encoded.
    * Of equal payloads of at least ``least`` bytes the row with the largest id is the response (all
      rows of that id, if it repeats); a null id is smaller than any other.
    * Rows alike in id, url and payload get the same record ids, once for each row.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A").alias("url"), body.alias("body"))
    rows = rows.withColumns({"digest": F.sha1("body"), "size": F.octet_length("body")})
    rows = rows.withColumn("key", F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("url", F.lit("\n")), "digest"))
    large = rows.where(F.col("size") >= least)
    groups = (
        large.groupBy("digest").agg(F.max("id").alias("top"), F.max_by("key", F.struct("id", "key")).alias("top_key"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("digest").alias("same"), "top", "top_key")
    )
    # small payloads never meet a group: a key of their own spreads them
    ask = F.when(F.col("size") >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), "key"))
    met = rows.withColumn("ask", ask).join(groups, F.col("ask") == F.col("same"), "left")
    revisit = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    response_id = _record("response", F.col("key"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(SEPARATOR))
    digest = F.concat(F.lit("sha1:"), "digest")
    host = F.regexp_extract("url", r"^[^:/?#]+://([^/?#]*)", 1)
    path = F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*([^#]*)", 1)
    request = _whole(
        _lines(("WARC-Type", "request"), ("WARC-Record-ID", _record("request", F.col("key"))), ("WARC-Concurrent-To", response_id),
               ("WARC-Target-URI", F.col("url")), ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=request")),
        F.concat(F.lit("GET "), F.coalesce(F.when(path != "", path), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(SEPARATOR)),
    )
    response = _whole(
        _lines(("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", response_id), ("WARC-Target-URI", F.col("url")),
               ("WARC-Date", DATE), ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(revisit, PROFILE)),
               ("WARC-Refers-To", F.when(revisit, _record("response", F.col("top_key")))), ("Content-Type", "application/http; msgtype=response")),
        F.when(revisit, http).otherwise(F.concat(http, "body")),
    )
    metadata = _whole(
        _lines(("WARC-Type", "metadata"), ("WARC-Record-ID", _record("metadata", F.col("key"))), ("WARC-Concurrent-To", response_id),
               ("WARC-Target-URI", F.col("url")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")),
        _lines(("page-id", F.col("id").cast("string")), ("payload-bytes", F.col("size").cast("string"))),
    )
    return met.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(records: DataFrame, path: str) -> None:
    """One gzip archive for each partition."""
    records.write.option("compression", "gzip").option("lineSep", SEPARATOR).text(path)


def _header(raw: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(value.strip().decode("utf-8", "replace"))
    return out


def parse(raw: bytes, keep_payload: bool) -> tuple[tuple | None, bool]:
    """(record, whether all its bytes are there) of what follows a version line."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        return None, False
    h = _header(head)
    try:
        size = int(h["content-length"][0])
    except (KeyError, ValueError):
        return None, True
    block, whole = rest[:size], len(rest) >= size

    def one(name: str) -> str | None:
        return h[name][0] if name in h else None

    kind = one("warc-type")
    payload, fields = block, None
    if (one("content-type") or "").startswith("application/http"):
        _, http, payload = block.partition(b"\r\n\r\n")
        payload = payload if http else b""
    elif (one("content-type") or "") == "application/warc-fields":
        fields = block.decode("utf-8", "replace")
    digest = one("warc-payload-digest")
    return (
        one("warc-record-id"), kind, h.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-date"),
        one("content-type"), len(payload), hashlib.sha1(payload).hexdigest(), digest, payload if keep_payload else None, fields, whole,
    ), whole


def _parsed(batches: Iterator[pa.RecordBatch], keep_payload: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    version = VERSION.encode() + b"\r\n"
    file, held = None, None
    out: list[tuple] = []
    size = 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for path, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            if path != file:
                if held is not None and (record := parse(held, keep_payload)[0]):
                    out.append(record)  # the archive ends within a record
                file, held = path, None
                if not raw:
                    continue  # what stands before the first version line
            held = raw if held is None else held + version + raw
            record, whole = parse(held, keep_payload)
            if whole:
                held = None
                if record:
                    out.append(record)
                    size += record[7]
            if size > 1 << 24 or len(out) > 5000:
                yield batch_of(out)
                out, size = [], 0
    if held is not None and (record := parse(held, keep_payload)[0]):
        out.append(record)
    if out:
        yield batch_of(out)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per record. ``payload`` is the body of an HTTP block, else the block; null if not asked for.

    ``whole`` is false for a record that its archive ends in. Blocks without a length are skipped.
    An empty folder of archives gives no rows.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType.fromDDL(RECORD)
    arrow = to_arrow_schema(schema)
    raw = spark.read.option("lineSep", VERSION + "\r\n").text(path)
    named = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return named.mapInArrow(lambda it: _parsed(it, keep_payload, arrow), schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``requests``, ``metadata``.

    The capture is the response or revisit; other records belong to it if they are concurrent to it,
    or it to them. Requests and metadata whose response is missing form a capture with a null
    response, under the id that they name. Records that repeat an id are one record; a response that
    was written n times gives n rows.
    """
    main = F.col("type").isin("response", "revisit")
    response = F.struct("record_id", "type", "refers_to", "target_uri", "date", "payload_bytes", "payload_digest", "stated_digest", "payload", "whole")
    other = F.struct("record_id", "type", "target_uri", "date", "payload_bytes", "fields", "payload")
    # responses that name the other side: (other record, capture)
    back = records.where(main & (F.size("concurrent_to") > 0)).select(F.explode("concurrent_to").alias("named"), F.col("record_id").alias("capture"))
    rest = records.where(~main & F.col("type").isin("request", "metadata"))
    own = rest.join(back.groupBy("named").agg(F.min("capture").alias("capture")), rest.record_id == F.col("named"), "left")
    keyed = own.select(
        F.coalesce("capture", F.get("concurrent_to", F.lit(0)), "record_id").alias("capture_id"),
        F.lit(None).cast(records.select(response.alias("r")).schema["r"].dataType).alias("response"), other.alias("other"),
    )
    mains = records.where(main).select(
        F.col("record_id").alias("capture_id"), response.alias("response"), F.lit(None).cast(keyed.schema["other"].dataType).alias("other"),
    )
    grouped = mains.unionByName(keyed).groupBy("capture_id").agg(
        F.first("response", ignorenulls=True).alias("response"), F.count("response").alias("__n"), F.collect_set("other").alias("others"),
    )

    def of(kind: str) -> Column:
        return F.array_sort(F.filter("others", lambda x: x["type"] == kind))

    return grouped.select(
        "capture_id", "response", of("request").alias("requests"), of("metadata").alias("metadata"),
        F.explode(F.sequence(F.lit(1), F.greatest("__n", F.lit(1)))).alias("__i"),
    ).drop("__i")


def page_captures(captures: DataFrame, id_type: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of captures that ``archive_records`` made.

    A revisit has the size and digest of the payload that it refers to.
    """
    number = F.regexp_extract(F.get("metadata", F.lit(0))["fields"], r"page-id: ([^\r]*)\r\n", 1)
    rows = captures.where(F.col("response").isNotNull()).select(
        F.when(number != "", number).cast(id_type).alias("page_id"), "response.record_id", "response.type", F.col("response.refers_to").alias("ref"),
        "response.payload_bytes", "response.payload_digest",
    )
    stored = (
        rows.where("type = 'response'").groupBy(F.col("record_id").alias("original"))
        .agg(F.first("page_id").alias("origin"), F.first("payload_bytes").alias("full_bytes"), F.first("payload_digest").alias("full_digest"))
    )
    # responses refer to nothing: a key of their own spreads them
    met = rows.withColumn("ask", F.coalesce("ref", "record_id")).join(stored, F.col("ask") == F.col("original"), "left")
    revisit = F.col("type") == "revisit"
    return met.select(
        "page_id", F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, F.col("origin")).alias("refers_to"),
    )
