"""WARC archives of captured pages, written and read back.

Writing: each page becomes a request record, a response or revisit record, and a metadata
record, tied together by WARC-Concurrent-To. Payloads of ``MIN_SHARED_BYTES`` or more that
occur more than once are stored once, with the smallest page id; the others are revisits. The
smallest id is found by a partial aggregate over digests, so a payload that a third of all
pages share meets in one small row. Archives are written by Spark's text writer, whose line
separator is the blank lines that end a record; each file is a gzip-compressed WARC file (one
member) of at most ``PAGES_PER_FILE`` pages, and pages are dealt to so many tasks that a task
has about ``FILE_BYTES`` of payload at most, so long pages make more files, not longer ones.

Reading: each file is unpacked as a stream and walked record by record by Content-Length, so
payloads may hold anything and a task holds the packed file and a few records, never the
unpacked file. A file that ends inside a record is an error. ``transactions`` joins request, response and metadata records through the
concurrent-to identifiers and gives one nested row per capture.

Defined cases: a null or empty html is an empty payload; a null url is an empty target; a
null page_id stays null and sorts last; of rows that tie for the smallest page id, one (by
url, then row) is the response and the others revisit it; rows that repeat are captures of
their own; an empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import short_batches, type_of

MIN_SHARED_BYTES = 100
PAGES_PER_FILE = 2000
FILE_BYTES = 64 << 20            # payload of a writing task, about
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"    # captures carry no time of their own
EOL = "\r\n"

RECORD = ("record_id string, record_type string, concurrent_to string, refers_to string, "
          "target_uri string, payload_digest string, content_type string, headers map<string,string>, "
          "payload_bytes long, payload_sha256 string, content binary")


def _urn(*parts: Column) -> Column:
    """A record id from the SHA-1 of what identifies the record."""
    h = F.sha1(F.concat_ws("\u0000", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header_value(c: Column) -> Column:
    """Header lines end at line breaks, so these are percent-encoded, and so is the sign."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(kind: str, record_id: Column, content_type: str, body: Column,
            more: list[tuple[str, Column]]) -> Column:
    """The record without the blank lines that end it; headers whose value is null are left out."""
    lines = [F.lit(VERSION), F.lit(f"WARC-Type: {kind}"),
             F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}"),
             *[F.concat(F.lit(f"{name}: "), value) for name, value in more],
             F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL * 2), body)


def captures(pages: DataFrame, min_shared_bytes: int = MIN_SHARED_BYTES,
             tasks: int | None = None) -> DataFrame:
    """page_id, url, html, payload_digest, capture and, for revisits, original and
    original_page: the record ids of this capture and of the response it repeats, and that
    one's page. Which payloads are shared is found on digests; payloads are shuffled once, by
    what identifies their row, into ``tasks`` partitions if given."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    rows = rows.withColumn("row", F.sha1(F.concat_ws(
        "\u0000", F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
        F.coalesce(F.col("url"), F.lit("\u0001")), F.col("payload_digest")).cast("binary")))
    large = (rows.where(F.octet_length("html") >= min_shared_bytes)
             .groupBy("row", "payload_digest", "page_id", "url").agg(F.count(F.lit(1)).alias("n")))
    first = F.min(F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url"), F.col("row")))
    shared = (large.groupBy("payload_digest").agg(first.alias("o"), F.sum("n").alias("n"))
              .where("n > 1").select("payload_digest", F.col("o.row").alias("original_row"),
                                     F.col("o.page_id").alias("original_page")))
    again = large.join(shared, "payload_digest").select("row", "original_row", "original_page")
    if tasks:
        rows = rows.repartition(tasks, "row")
    rows = rows.join(again, "row", "left")
    copy = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    rows = rows.withColumn("copy", copy)
    revisit = (F.col("row") != F.col("original_row")) | (F.col("copy") > 1)
    revisit = F.col("original_row").isNotNull() & revisit
    return rows.select("page_id", "url", "html", "payload_digest",
                       _urn(F.col("row"), F.col("copy").cast("string")).alias("capture"),
                       F.when(revisit, _urn(F.col("original_row"), F.lit("1"))).alias("original"),
                       F.when(revisit, F.col("original_page")).alias("original_page"))


def tasks_for(pages: DataFrame, file_bytes: int | None = None) -> int | None:
    """How many tasks write ``file_bytes`` each, if the session's shuffles have fewer."""
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    tasks = math.ceil(total / (file_bytes or FILE_BYTES))
    return tasks if tasks > int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def records(pages: DataFrame, min_shared_bytes: int = MIN_SHARED_BYTES,
            tasks: int | None = None) -> DataFrame:
    """value: three records per page, as text."""
    rows = captures(pages, min_shared_bytes, tasks)
    target = ("WARC-Target-URI", _header_value(F.col("url")))
    mine = F.col("capture")
    status = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"
                            "Content-Length: "), F.octet_length("html").cast("string"),
                      F.lit(EOL * 2))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest")))
    response = _record("response", mine, "application/http; msgtype=response",
                       F.concat(status, "html"), [target, digest])
    revisit = _record(
        "revisit", mine, "application/http; msgtype=response", status,
        [target, digest, ("WARC-Refers-To", F.col("original")),
         ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))])
    request = _record("request", _urn(mine, F.lit("request")),
                      "application/http; msgtype=request",
                      F.concat(F.lit("GET "), _header_value(F.col("url")), F.lit(f" HTTP/1.1{EOL * 2}")),
                      [target, ("WARC-Concurrent-To", mine)])
    fields = [("pageId", F.col("page_id").cast("string")),
              ("payloadBytes", F.octet_length("html").cast("string")),
              ("refersToPage", F.col("original_page").cast("string"))]
    metadata = _record("metadata", _urn(mine, F.lit("metadata")), "application/warc-fields",
                       F.concat_ws("", *[F.concat(F.lit(f"{n}: "), v, F.lit(EOL))
                                         for n, v in fields]),
                       [target, ("WARC-Concurrent-To", mine)])
    return rows.select(F.explode(F.array(
        request, F.when(F.col("original").isNull(), response).otherwise(revisit), metadata))
        .alias("value"))


def write_archives(pages: DataFrame, path: str, min_shared_bytes: int = MIN_SHARED_BYTES,
                   pages_per_file: int = PAGES_PER_FILE) -> None:
    """Gzip-compressed archive files of at most ``pages_per_file`` pages below ``path``."""
    (records(pages, min_shared_bytes, tasks_for(pages)).write.option("lineSep", EOL * 2)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", 3 * pages_per_file).text(path))


# -------------------------------------------------------------- reading ----
def plain(archive: bytes) -> io.BufferedIOBase:
    """The archive as a stream without its gzip layer, if it has one."""
    packed = io.BytesIO(archive)
    return gzip.GzipFile(fileobj=packed) if archive[:2] == b"\x1f\x8b" else packed


def parse(archive: bytes):
    """(headers, content) of the records of one archive file, by their Content-Length."""
    stream, end = plain(archive), EOL.encode()
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record before byte {stream.tell()}")
        headers = {}
        while (line := stream.readline()) != end:
            if not line.endswith(end):
                raise ValueError("an archive ends inside a record's header")
            name, sign, value = line[:-2].decode("utf-8").partition(": ")
            headers[name if sign else name.rstrip(":")] = value
        size = int(headers["Content-Length"])
        content = stream.read(size)
        if len(content) < size or stream.read(4) != end * 2:
            raise ValueError("an archive ends inside a record")
        yield headers, content


def payload_of(headers: dict[str, str], content: bytes) -> bytes:
    """What follows the HTTP header; of records without one, all."""
    if not headers.get("Content-Type", "").startswith("application/http"):
        return content
    return content[content.index(b"\r\n\r\n") + 4:]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``; payload_bytes and payload_sha256 describe
    the payload as it was read."""
    short_batches(spark)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("content"))
    names = ["record_id", "record_type", "concurrent_to", "refers_to", "target_uri",
             "payload_digest", "content_type", "headers", "payload_bytes", "payload_sha256", "content"]
    wanted = ["WARC-Record-ID", "WARC-Type", "WARC-Concurrent-To", "WARC-Refers-To",
              "WARC-Target-URI", "WARC-Payload-Digest", "Content-Type"]
    kinds = [*[pa.string()] * 7, pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(),
             pa.binary()]

    def walk(batches):
        def rows(out):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for archive in batch.column(0):
                out, size = [], 0
                for headers, content in parse(archive.as_py()):
                    payload = payload_of(headers, content)
                    out.append((*map(headers.get, wanted), list(headers.items()), len(payload),
                                hashlib.sha256(payload).hexdigest(), content))
                    size += len(content)
                    if size > 4_000_000 or len(out) >= 2000:
                        yield rows(out)
                        out, size = [], 0
                if out:
                    yield rows(out)

    return files.mapInArrow(walk, RECORD)


def transactions(rows: DataFrame) -> DataFrame:
    """One row per capture: capture (record id), url, request, response and metadata, the last
    three nested. Request and metadata records meet the response or revisit record that their
    concurrent-to id names, in one shuffle; what belongs to no response is left out."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    url = F.replace(F.replace(F.replace(F.col("target_uri"), F.lit("%0A"), F.lit("\n")),
                              F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))

    def one(*kinds):
        return F.first(F.when(F.col("record_type").isin(*kinds), whole), ignorenulls=True)

    main = F.col("record_type").isin("response", "revisit")
    joined = rows.groupBy(F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to"))
                          .alias("capture")).agg(
        F.first(F.when(main, url), ignorenulls=True).alias("url"),
        one("request").alias("request"), one("response", "revisit").alias("response"),
        one("metadata").alias("metadata"))
    return joined.where("response IS NOT NULL")


def warc_field(content: Column, name: str) -> Column:
    """Value of a line of an application/warc-fields block; null if it has none."""
    text = F.decode(content, "UTF-8")
    return F.nullif(F.regexp_extract(text, rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))


def payload(response: str) -> Column:
    """What follows the HTTP header of the response record in the named column."""
    content = F.col(f"{response}.content")
    head = F.expr(f"position(unhex('0D0A0D0A'), {response}.content)")
    return F.substr(content, head + F.lit(4))


def page_archive(pages: DataFrame, path: str, bodies: bool = True) -> DataFrame:
    """Write the pages to ``path``, read the archives back, and describe each page: page_id,
    url, payload_bytes, payload_digest, record_type, refers_to (page id), html (of responses;
    without ``bodies`` null, and payloads are not shuffled again)."""
    write_archives(pages, path)
    rows = read_records(pages.sparkSession, path)
    is_main = F.col("record_type").isin("response", "revisit")
    if not bodies:
        rows = rows.withColumn("content", F.when(~is_main, F.col("content")))
    rows = transactions(rows)
    kind = type_of(pages, "page_id")
    page = lambda f: warc_field(F.col("metadata.content"), f)
    is_response = F.col("response.record_type") == "response"
    return rows.select(
        page("pageId").cast(kind).alias("page_id"), "url",
        F.when(is_response, F.col("response.payload_bytes"))
        .otherwise(page("payloadBytes").cast("long")).alias("payload_bytes"),
        F.when(is_response, F.col("response.payload_sha256"))
        .otherwise(F.regexp_replace("response.payload_digest", "^sha256:", ""))
        .alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        page("refersToPage").cast(kind).alias("refers_to"),
        F.when(is_response, F.decode(payload("response"), "UTF-8")).alias("html"))
