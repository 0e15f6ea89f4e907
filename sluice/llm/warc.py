"""WARC archives: writing captures, and assembling transactions from records.

A capture is three records: a request and a metadata record name the response
(or revisit) they belong to in ``WARC-Concurrent-To``. Equal payloads of at least
``LEAST_BYTES`` are stored once; the other captures are revisits of that response.

Writing: records are composed by DataFrame functions and written by Spark's text
writer. Every WARC record ends in two line breaks, so those are the writer's line
separator, and a part file is a plain or gzipped WARC file. It holds what one
task writes: a split of the pages, or a shuffle partition of the join by
payload, which adaptive execution keeps near its advisory size.

Reading: each file is parsed as a stream by its content lengths, in the task that
reads it. Records are then joined: requests and metadata to the response that
they are concurrent to, full outer, so that a record whose partner is missing is
a capture with a null part. One nested row comes out per capture.

Archives live in the folder given, by default the shared scratch folder.

Defined cases: null html is an empty payload; a null url has no target field; a
null id has no id field and comes back as null, and counts as the smallest id;
line breaks in a url are percent-encoded; repeated rows are captures of their
own, and of equal rows with the largest id one is the response; an empty table
gives an empty archive. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import ROW, join_key, with_rows
from sluice.storage import exists, scratch_path

LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BREAK = "\r\n"
_CHUNK = 1 << 20
_BATCH_BYTES = 8 << 20


def _urn(kind: str) -> Column:
    digits = F.md5(F.concat_ws(":", F.lit(kind), *ROW))
    parts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record; fields with a null value are left out."""
    head = [F.concat(F.lit(f"{name}: "), value, F.lit(_BREAK)) for name, value in fields]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_BREAK + _BREAK))
    return F.concat(F.lit("WARC/1.1" + _BREAK), F.concat_ws("", *head), length, block)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The ``record`` texts of all captures, three a page."""
    rows = with_rows(pages).select(
        *ROW, F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    rows = rows.withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html"), "urn": _urn("response")})
    # The response of equal payloads: largest id, rows in file order for equal ids.
    large = rows.filter(F.col("bytes") >= LEAST_BYTES).groupBy(F.col("digest").alias("_digest")).agg(
        F.max(F.struct("id", *ROW, "urn", "url")).alias("first"), F.count("*").alias("n")
    )
    large = large.filter("n > 1").withColumnRenamed("_digest", "digest").select(join_key("digest").alias("_payload"), "first")
    joined = rows.join(large, (join_key("digest") == F.col("_payload")) & (F.col("bytes") >= LEAST_BYTES), "left")
    revisit = F.col("first").isNotNull() & (F.col("first.urn") != F.col("urn"))
    clean = lambda c: F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    target = ("WARC-Target-URI", clean(F.col("url")))
    date = ("WARC-Date", F.lit(DATE))
    partner = ("WARC-Concurrent-To", F.col("urn"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_BREAK + _BREAK),
    )
    response = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", F.col("urn")),
            target,
            date,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To", F.when(revisit, F.col("first.urn"))),
            ("WARC-Refers-To-Target-URI", F.when(revisit, clean(F.col("first.url")))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(http, F.when(revisit, "").otherwise(F.col("html"))),
    )
    path = F.coalesce(F.nullif(F.regexp_extract(clean(F.col("url")), "^[a-z]+://[^/]*(/.*)$", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract(clean(F.col("url")), "^[a-z]+://([^/]*)", 1), F.lit(""))
    request = _record(
        [
            ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request")), partner, target, date,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{_BREAK}Host: "), host, F.lit(_BREAK + _BREAK)),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata")), partner, target, date,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit(f"via: pages{_BREAK}"), F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(_BREAK)), F.lit(""))),
    )
    return joined.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write(pages: DataFrame, path: str | None = None, compression: str = "gzip", **columns) -> str:
    """Write the captures of ``pages`` as WARC files into a new folder, whose path is returned."""
    path = path or scratch_path(pages.sparkSession, "warc")
    found = records(pages, **columns)
    found.write.option("lineSep", _BREAK + _BREAK).option("compression", compression).text(path)
    return path


def _pieces(content: bytes) -> Iterator[bytes]:
    """The bytes of a plain or gzipped file, members one after the other, about a megabyte at a time."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[k : k + _CHUNK] for k in range(0, len(content), _CHUNK))
        return
    at, inflate = 0, zlib.decompressobj(31)
    while at < len(content):
        piece = content[at : at + _CHUNK]
        out = inflate.decompress(piece)
        at += len(piece) - len(inflate.unused_data)
        if inflate.eof:
            inflate = zlib.decompressobj(31)
            while at < len(content) and content[at] == 0:
                at += 1
        if out:
            yield out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields in lower case, block)`` of the records of a WARC file."""
    held, source = bytearray(), _pieces(content)

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(source, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while fill(1) and held[:1] in (b"\r", b"\n"):
            del held[: len(held) - len(held.lstrip(b"\r\n"))]
        if not held:
            return
        size = 4096
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(size):
                raise ValueError("a WARC header has no end")
            size = len(held) + 4096
        lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:60]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        if not fill(end + 4 + length):
            raise ValueError("a WARC record is cut off")
        yield fields, bytes(held[end + 4 : end + 4 + length])
        del held[: end + 4 + length]


_FIELDS = ("warc-type", "warc-record-id", "warc-concurrent-to", "warc-target-uri", "warc-refers-to", "warc-payload-digest")
_SCHEMA = pa.schema(
    [(x[5:].replace("-", "_"), pa.string()) for x in _FIELDS]
    + [("payload_bytes", pa.int64()), ("payload_sha1", pa.string()), ("block", pa.binary()), ("payload", pa.binary())]
)
RECORD = "type string, record_id string, concurrent_to string, target_uri string, refers_to string, payload_digest string"
RECORD += ", payload_bytes long, payload_sha1 string, block binary, payload binary"


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records below a folder. Payloads are hashed as they are read, and left out if not wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for content in batch.column("content"):
                for fields, block in parse(content.as_py()):
                    payload = None
                    if fields.get("warc-type") == "response":
                        block, _, payload = block.partition(b"\r\n\r\n")
                    sums = (None, None) if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
                    rows.append((*(fields.get(x) for x in _FIELDS), *sums, block, payload if with_payload else None))
                    size += len(block) + len(payload or b"") + 400
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, x, strict=True)) for x in rows], _SCHEMA)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, x, strict=True)) for x in rows], _SCHEMA)

    if not exists(spark, path):
        raise FileNotFoundError(path)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: ``request``, ``response`` (a response or revisit) and ``metadata``, nested.

    ``found`` is read once for each kind of record; hand in a table rather than
    archives that would be parsed each time.
    """
    whole = F.struct(*[F.col(name) for name in found.columns])

    def of(*types: str, name: str) -> DataFrame:
        key = "record_id" if name == "response" else "concurrent_to"
        return found.filter(F.col("type").isin(*types)).select(F.col(key).alias("capture"), whole.alias(name))

    response = of("response", "revisit", name="response")
    both = response.join(of("request", name="request"), "capture", "full_outer")
    return both.join(of("metadata", name="metadata"), "capture", "full_outer").select("capture", "request", "response", "metadata")


def page_number(metadata: str = "metadata") -> Column:
    """The ``page-id`` that :func:`write` put into a metadata record."""
    number = F.regexp_extract(F.col(f"{metadata}.block").cast("string"), "(?m)^page-id: (.*?)\\r?$", 1)
    return F.when(number != "", number.cast("long"))
