"""WARC archives: writing captures, reading records, assembling transactions.

`write` turns pages into three records each (request, response or revisit, metadata), the first and last naming the
middle one in WARC-Concurrent-To, and writes them as WARC 1.1, each record a gzip member of its own, so that a record
can be read alone from its offset. Files are bounded in bytes: a task gathers members up to FILE_BYTES, and each such
run is one row, and one file, of Spark's text sink, whose line separator is an empty gzip member. `read` takes files
member by member and parses records from their Content-Length. `assemble` joins request, response and metadata records
through their concurrent-to identifiers, over chains of any length, and returns one nested row for each capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.llm.common import materialise, salted, shared_dir

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
EPOCH = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_BYTES = 16 << 20
#: A gzip member without content, as the text sink is to write it (in ISO-8859-1, a byte for each character).
NOTHING = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
RECORDS = "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, payload_bytes long, payload_digest string, digest_ok boolean, http map<string,string>, payload binary"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: 20 bits, five hex digits, are four characters."""
    hexed = F.sha1(payload)
    alphabet = F.lit(BASE32)
    out = []
    for i in range(8):
        bits = F.conv(F.substring(hexed, i * 5 + 1, 5), 16, 10).cast("int")
        out += [F.substring(alphabet, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def record_id(page_id: Column, digest: Column, part: str, number: Column) -> Column:
    """A urn from the page id, its payload's digest, the kind of record and a number unless null, in the form of a UUID."""
    h = F.md5(F.concat_ws(":", F.lit("payx"), F.lit(part), F.coalesce(page_id.cast("string"), F.lit("null")), digest, number.cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]], F.lit(">"))


def deduplicate(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """page_id, url, body (binary), payload_bytes, payload_digest, number, refers_to, refers_number.

    Of equal payloads of at least `smallest` bytes the one with the largest page_id is the response and has a null
    refers_to, others refer to it. Payload groups are found from digests, summed before the shuffle. A digest with
    over 1/HEAVY of all rows is looked up in a broadcast of at most HEAVY rows; its rows do not meet in one task.

    number is the row's place in pages if a page_id, or none, repeats among equal payloads, else null; refers_number is
    that of the first such row of refers_to. Places hold while pages gives its rows in one order, as files do.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), body.alias("body"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("body").cast("long"), "payload_digest": base32_sha1(F.col("body"))})
    copies = rows.where(F.col("payload_bytes") >= smallest).groupBy(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes"), "page_id").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    groups = copies.groupBy("digest", "bytes").agg(F.max(F.struct(F.col("page_id").alias("id"), F.col("row"))).alias("first"), F.sum("n").alias("n"), (F.max("n") > 1).alias("again"))
    groups = materialise(groups.where("n > 1").select("digest", "bytes", "n", F.struct("first.id", "first.row", "again").alias("first")), "payloads")
    heavy_from = max(64, pages.count() // HEAVY)
    heavy = groups.where(F.col("n") > heavy_from).select("digest", "bytes", F.col("first").alias("heavy"))
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes"))
    rows = rows.join(F.broadcast(heavy), same, "left").drop("digest", "bytes")
    light = groups.where(F.col("n") <= heavy_from).select(F.concat_ws(":", "digest", "bytes").alias("lookup"), "first")
    # Rows of heavy groups get a lookup value of their own, so that they spread.
    rows = rows.withColumn("lookup", F.when(F.col("heavy").isNull(), F.concat_ws(":", "payload_digest", "payload_bytes")).otherwise(F.concat(F.lit("#"), F.col("row").cast("string"))))
    rows = rows.join(light, "lookup", "left")
    first = F.coalesce("heavy", "first")
    other = first["id"] != F.col("page_id")
    number = F.when(first["again"] | (F.col("payload_bytes") < smallest), F.col("row")).alias("number")
    return rows.select("page_id", "url", "body", "payload_bytes", "payload_digest", number, F.when(other, first["id"]).alias("refers_to"), F.when(other & first["again"], first["row"]).alias("refers_number"))


HEAVY = 200


def _header(kind: str, own: Column, content_type: str, length: Column, *more: Column) -> Column:
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), own, F.lit(f"\r\nWARC-Date: {EPOCH}\r\nContent-Type: {content_type}")]
    return F.concat(*lines, *more, F.lit("\r\nContent-Length: "), length.cast("string"), F.lit(END))


def write(pages: DataFrame, path: str | None = None, smallest: int = 0) -> str:
    """Write pages (page_id, url, html) as WARC files of about FILE_BYTES; returns their folder. Null html is empty."""
    spark = pages.sparkSession
    path = path or shared_dir(spark, "warc")
    rows = deduplicate(pages, smallest)
    clean = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    uri = F.concat(F.lit("\r\nWARC-Target-URI: "), clean)
    digest = F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"))
    identifier = lambda part: record_id(F.col("page_id"), F.col("payload_digest"), part, F.col("number"))
    own, page = identifier("response"), F.concat(F.lit("\r\nX-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), page, F.lit(END))
    size = F.octet_length(http)
    revisit = F.concat(_header("revisit", own, "application/http; msgtype=response", size, uri, digest, F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("refers_to"), F.col("payload_digest"), "response", F.col("refers_number"))), http)
    response = F.concat(_header("response", own, "application/http; msgtype=response", size + F.col("payload_bytes"), uri, digest), http)
    linked = F.concat(F.lit("\r\nWARC-Concurrent-To: "), own)
    ask = F.concat(F.lit("GET / HTTP/1.1\r\nX-Target: "), clean, F.lit(END))
    request = F.concat(_header("request", identifier("request"), "application/http; msgtype=request", F.octet_length(ask), uri, linked), ask)
    notes = F.concat(F.lit("fetchedBytes: "), F.col("payload_bytes").cast("string"), F.lit("\r\n"))
    metadata = F.concat(_header("metadata", identifier("metadata"), "application/warc-fields", F.octet_length(notes), uri, linked), notes)
    whole = F.when(F.col("refers_to").isNull(), F.concat(response.cast("binary"), F.col("body"))).otherwise(revisit.cast("binary"))
    end = F.lit(END.encode())
    records = rows.select(*[F.concat(x.cast("binary"), end).alias(name) for name, x in (("request", request), ("response", whole), ("metadata", metadata))])
    files = records.mapInArrow(_files, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("lineSep", NOTHING).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)
    return path


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, those of a row in order, as runs of gzip members of about FILE_BYTES."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for record in row:
                member = gzip.compress(record, 2, mtime=0)
                held.append(member)
                size += len(member)
            if size >= FILE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])


def unzipped(content: bytes, step: int = 1 << 12) -> Iterator[bytes]:
    """The gzip members of a file one by one, or all of it if it isn't compressed."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        one, parts, take = zlib.decompressobj(31), [], step
        while not one.eof and at < len(view):
            piece = view[at : at + take]
            parts.append(one.decompress(piece))
            at, take = at + len(piece) - len(one.unused_data), min(take * 4, 1 << 22)
        yield b"".join(parts)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def parse(content: bytes) -> Iterator[tuple]:
    """Records of one WARC file, as RECORDS; the payload is what follows the HTTP header in requests and responses."""
    for part in unzipped(content):
        yield from _parsed(part)


def _parsed(content: bytes) -> Iterator[tuple]:
    at = 0
    while (at := content.find(VERSION[:5].encode(), at)) >= 0:
        head = content.find(END.encode(), at)
        if head < 0:
            return
        fields: dict[str, list[str]] = {}
        for m in _FIELD.finditer(content, at, head):
            fields.setdefault(m[1].decode("utf-8", "replace").strip().lower(), []).append(m[2].decode("utf-8", "replace").strip())
        one = lambda k: fields.get(k, [None])[0]  # noqa: B023, E731
        length = int(one("content-length") or 0)
        block = content[head + 4 : head + 4 + length]
        at = head + 4 + length
        kind, payload, size, http = one("warc-type"), block, len(block), {}
        if (one("content-type") or "").startswith("application/http"):
            cut = block.find(END.encode())
            http = {m[1].decode("utf-8", "replace").lower(): m[2].decode("utf-8", "replace") for m in _FIELD.finditer(block, 0, cut if cut >= 0 else len(block))}
            payload = block[cut + 4 :] if cut >= 0 else b""
            size = len(payload)
            if kind == "revisit":
                size = int(http.get("content-length") or 0)
        said = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
        computed = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if kind == "revisit":
            digest, ok = said, None
        else:
            digest, ok = computed, said is None or said == computed
        yield one("warc-record-id"), kind, fields.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), size, digest, ok, list(http.items()), payload


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all files below path. A revisit's payload_bytes and payload_digest are those its headers state
    of the full payload; those of other records are taken from the payload itself, and digest_ok compares."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("http", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse(content.as_py()):
                    rows.append(row if payloads else (*row[:-1], None))
                    held += len(row[-1])
                    if held > 1 << 22 or len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def members(records: DataFrame) -> DataFrame:
    """record_id, record_type, capture_id of every record.

    A response or revisit is a capture. Another record belongs to the capture it names or is named by in
    WARC-Concurrent-To, the smallest of several; else to that of records linked to it in such a way, the nearest first,
    over any number of steps; else it is one itself.
    """
    is_main = F.coalesce(F.col("record_type").isin("response", "revisit"), F.lit(False))
    main = records.where(is_main).select(F.col("record_id").alias("b"), F.col("record_id").alias("capture_id"))
    other = records.where(~is_main).select("record_id", "record_type")
    named = records.select("record_id", F.explode("concurrent_to").alias("to"))
    links = materialise(named.select(F.col("record_id").alias("a"), F.col("to").alias("b")).unionByName(named.select(F.col("to").alias("a"), F.col("record_id").alias("b"))), "links")
    sizes, total = links.groupBy("b").agg(F.count(F.lit(1)).alias("n")), links.count()
    step = lambda reached: salted(links, reached, "b", "a", sizes, total).groupBy("a").agg(F.min("capture_id").alias("capture_id"))
    found = materialise(step(main), "near")
    open_ = other.join(found.select(F.col("a").alias("record_id")), "record_id", "left_anti").select(F.col("record_id").alias("a"))
    last = found
    while not (open_ := materialise(open_, "open")).isEmpty():
        last = materialise(step(last.toDF("b", "capture_id")).join(open_, "a", "left_semi"), "near")
        if last.isEmpty():
            break
        found, open_ = found.unionByName(last), open_.join(last, "a", "left_anti")
    others = other.join(found.withColumnRenamed("a", "record_id"), "record_id", "left").select("record_id", "record_type", F.coalesce("capture_id", "record_id").alias("capture_id"))
    return others.unionByName(records.where(is_main).select("record_id", "record_type", F.col("record_id").alias("capture_id")))


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: capture_id, the nested response, request and metadata records, and their numbers.

    Of several requests or metadata records of one capture the one with the smallest record_id is nested and all are
    counted; `members` has every one of them. Records without a capture make a row without a response.
    """
    belongs = members(records).select("record_id", "capture_id")
    fields = F.struct("record_id", "record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest", "digest_ok", "http")
    rows = records.select("record_id", "record_type", fields.alias("r")).join(belongs.distinct(), "record_id")
    kind = F.when(F.col("record_type").isin("response", "revisit"), "response").otherwise(F.col("record_type"))
    pick = lambda k: F.min_by(F.when(kind == k, F.col("r")), F.when(kind == k, F.col("record_id")))
    return rows.groupBy("capture_id").agg(pick("response").alias("response"), pick("request").alias("request"), pick("metadata").alias("metadata"), F.count_if(kind == "request").alias("n_requests"), F.count_if(kind == "metadata").alias("n_metadata"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Write pages as WARC, read the files back and return what they say of each page.

    page_id, payload_bytes, payload_digest, record_type, refers_to, has_request, has_metadata, digest_ok (whether a
    response's payload has the digest that its header states; null for revisits). One row for each row of
    pages, also where page_id and payload repeat; a null page_id is kept as null. Other columns than page_id, url and
    html are ignored.
    """
    path = write(pages)
    records = materialise(read(pages.sparkSession, path, payloads=False).drop("payload"), "records")
    captures = assemble(records).withColumn("page_id", F.element_at("response.http", F.lit("x-page-id")).try_cast("long"))
    captures = materialise(captures, "captures")
    # What a revisit refers to is an identifier; the response under it says of which page it is.
    original = records.where("record_type = 'response'").select(F.col("record_id").alias("to"), F.element_at("http", F.lit("x-page-id")).try_cast("long").alias("refers_to")).distinct()
    found = captures.select("*", F.col("response.refers_to").alias("to")).join(original, "to", "left")
    return found.select("page_id", "response.payload_bytes", "response.payload_digest", "response.record_type", "refers_to", (F.col("n_requests") > 0).alias("has_request"), (F.col("n_metadata") > 0).alias("has_metadata"), "response.digest_ok")
