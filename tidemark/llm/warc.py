"""WARC archives of pages, and the assembly of their transactions.

Writing: each page becomes a request, a response (or a revisit of the response with the
same payload) and a metadata record. Reading: archives are parsed by the records' own
lengths, and the records of a capture are joined through WARC-Concurrent-To into one
nested row. Both ends go through Spark's own files, so any store it knows will do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import map_arrow, scratch_path, staged

#: Payloads shorter than this are always written in full.
MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
END_OF_RECORD = "\r\n\r\n"
CAPTURE_DATE = "2024-01-01T00:00:00Z"


def _uuid(text: Column) -> Column:
    h = F.md5(text.cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[x for k, (s, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
                                           for x in ([F.lit("-")] if k else []) + [F.substring(h, s, n)]], F.lit(">"))


def _record(kind: str | Column, record_id: Column, content_type: str, block: Column, *headers: Column) -> Column:
    """One record without the two line ends that close it; a null header is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        F.concat_ws("\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
                    F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {CAPTURE_DATE}"), *headers,
                    F.lit(f"Content-Type: {content_type}"),
                    F.concat(F.lit("Content-Length: "), F.octet_length(block))),
        F.lit("\r\n\r\n"), block)


def _line(value: Column) -> Column:
    """A value as one header line: line ends and percent signs escaped."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _identified(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("n"),
                        F.sha1(html.cast("binary")).alias("sha1"), F.sha2(html.cast("binary"), 256).alias("sha256"))


def _page_uuid(kind: str, page_id: str = "page_id", sha256: str = "sha256") -> Column:
    return _uuid(F.concat_ws("|", F.lit(kind), F.coalesce(F.col(page_id).cast("string"), F.lit("null")), sha256))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES,
                   min_revisit: int = MIN_REVISIT_BYTES) -> None:
    """Write three records per row of ``pages`` (page_id, url, html) as gzipped archives under ``path``.

    Of pages with equal payloads of ``min_revisit`` bytes or more, that with the largest
    page_id is a response and the others are revisits of it; where all ids are null, all are
    responses. A null html is empty. Rows equal in id and payload share their record ids.
    """
    rows = _identified(pages)
    slim = rows.filter(F.col("n") >= min_revisit).select("page_id", "sha256")
    # Aggregated before the shuffle and stored: the join below is split where a payload is very common.
    target = staged(slim.groupBy("sha256").agg(F.max("page_id").alias("target_id"), F.count("*").alias("copies"))
                    .filter("copies > 1 and target_id is not null")
                    .select(F.col("sha256").alias("t_sha256"), "target_id"), "targets")
    size = rows.agg(F.coalesce(F.sum(F.col("n") + 2048), F.lit(0))).first()[0]
    rows = rows.join(target, F.col("sha256") == F.col("t_sha256"), "left")
    revisit = F.col("target_id").isNotNull() & ~F.col("target_id").eqNullSafe(F.col("page_id"))
    uri, own = _line(F.coalesce("url", F.lit(""))), _page_uuid("capture")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n"), F.lit("\r\n\r\n"))
    target_uri = F.concat(F.lit("WARC-Target-URI: "), uri)
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), own)
    response = _record(
        F.when(revisit, "revisit").otherwise("response"), own, "application/http; msgtype=response",
        F.when(revisit, http).otherwise(F.concat(http, F.col("html"))), target_uri,
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _page_uuid("capture", "target_id"))))
    request = _record("request", _page_uuid("request"), "application/http; msgtype=request", F.concat(
        F.lit("GET "), uri, F.lit(" HTTP/1.1\r\n\r\n")), target_uri, concurrent)
    metadata = _record("metadata", _page_uuid("metadata"), "application/warc-fields", F.concat(
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("page-id: "), F.col("page_id"), F.lit("\r\n"))),
        F.concat(F.lit("has-url: "), F.col("url").isNotNull().cast("string"), F.lit("\r\n"))), target_uri, concurrent)
    archives = max(1, -(-int(size) // archive_bytes))
    # Dealt at random over archives of a bounded size, whatever the payloads.
    (rows.select(F.concat_ws(END_OF_RECORD, request, response, metadata).alias("value"), _page_uuid("deal").alias("d"))
     .repartition(archives, F.xxhash64("d")).select("value")
     .write.option("lineSep", END_OF_RECORD).option("compression", "gzip").text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; a record's length is its own word."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        yield headers, data[head_end + 4:head_end + 4 + n]
        at = head_end + 4 + n + len(END_OF_RECORD)


def http_payload(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


_RECORD = ("capture string, kind string, record_id string, uri string, refers_to string, digest string, "
           "payload_bytes long, content_type string, fields string, payload binary")


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``: gzipped (one stream or one per record) or plain.

    ``capture`` is the id of the record that a record is concurrent to, or its own;
    digest and payload_bytes are computed from the payload of a response, and stated by a
    revisit. An archive is one row of at most about ``ARCHIVE_BYTES``, as written.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows: list[dict] = []
                held = 0
                for head, block in parse_records(data):
                    kind = head.get("warc-type", "")
                    body = http_payload(block) if kind == "response" else b""
                    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    digest = hashlib.sha1(body).hexdigest() if kind == "response" else stated
                    rows.append({
                        "capture": head.get("warc-concurrent-to", head["warc-record-id"]), "kind": kind,
                        "record_id": head["warc-record-id"], "uri": head.get("warc-target-uri"),
                        "refers_to": head.get("warc-refers-to"), "digest": digest,
                        "payload_bytes": len(body) if kind == "response" else None,
                        "content_type": head.get("content-type"),
                        "fields": block.decode("utf-8", "replace") if kind in ("request", "metadata") else None,
                        "payload": body if with_payload and kind == "response" else None})
                    held += len(body) if with_payload else 0
                    if len(rows) >= 2000 or held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]])
                        for x in _RECORD.split(", ")])
    # Whole archives one at a time: a batch of several could be too much for a worker.
    files = spark.read.format("binaryFile").load(path).select("content")
    return map_arrow(files, parse, _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, request and metadata.

    Records meet through ``capture``; of several requests or metadata records of one capture
    that with the least record id counts, and n_records tells how many there were. Captures
    that were written several times come out as often; records without a response or revisit
    are left out.
    """
    def least(kind: str, *names: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("record_id", *names)))

    main = F.col("kind").isin("response", "revisit")
    rows = records.groupBy("capture").agg(
        F.min(F.when(main, F.struct("record_id", "kind", "uri", "refers_to", "digest", "payload_bytes", "payload")))
        .alias("response"),
        least("request", "uri", "fields").alias("request"), least("metadata", "fields").alias("metadata"),
        F.count_if(main).alias("times"), F.count("*").alias("n_records"))
    rows = rows.filter("times > 0")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .drop("copy", "times"))


def _unescaped(value: Column) -> Column:
    out = F.replace(F.replace(value, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def captures(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Assembled captures of archives that ``write_archives`` wrote, revisits resolved.

    Columns: page_id (long), url, record_type, payload_bytes, payload_digest, refers_to (page_id
    of the response that a revisit names), response, request and metadata.
    """
    rows = staged(assemble(read_records(spark, path, with_payload)), "captures")
    rows = rows.withColumn("page_id", F.nullif(F.regexp_extract("metadata.fields", r"page-id: ([^\r]*)\r\n", 1),
                                               F.lit("")).cast("long"))
    full = rows.filter(F.col("response.kind") == "response").select(
        F.col("capture").alias("t_capture"), F.col("page_id").alias("t_page_id"),
        F.col("response.payload_bytes").alias("t_bytes")).dropDuplicates(["t_capture"])
    # Stored, so that very many revisits of one response are split as a skewed join side.
    full = staged(full, "responses")
    rows = rows.join(full, F.col("response.refers_to") == F.col("t_capture"), "left")
    revisit = F.col("response.kind") == "revisit"
    url = F.when(F.col("metadata.fields").contains("has-url: true"), _unescaped(F.col("response.uri")))
    return rows.select(
        "page_id", url.alias("url"), F.col("response.kind").alias("record_type"),
        F.when(revisit, F.col("t_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.when(revisit, F.col("t_page_id")).alias("refers_to"),
        "response", "request", "metadata")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives to the shared folder, read them back, one row per capture."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return captures(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
