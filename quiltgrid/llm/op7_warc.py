r"""WARC: write transactions of records, read archives back, assemble captures.

A capture is written as three records: its request, its response (or a revisit of
an earlier equal payload) and its metadata; request and metadata name the response
in WARC-Concurrent-To. Spark's text writer makes the files: a row is a record and
the line separator is the record separator; a file is one gzip member. Reading takes
compressed files as binary rows and unpacks and parses them record by record, by
Content-Length. The records of a transaction then meet by the ids that they are
concurrent to, along chains too, and one nested row is made per capture.

Scale: digests are computed once, into a narrow table; equal payloads are found there
by aggregation; the joins on digests and on record ids carry narrow rows, and their
hot keys (empty payloads, say) are dealt out by Spark's skew joins; payloads are
shuffled once, by unique capture key.

Defined cases: a null html has an empty payload; a null url writes no target;
line ends in a url are percent-encoded; rows that repeat a page_id are captures of
their own, as are rows with a null one; null page_ids come after all others, so that
one is the response only if all of its payload are null; of equal payloads with equal
smallest page_id the one with the least row key is the response; an empty table writes
no records; extra columns are ignored; what is broken in an archive is a row with its
problem, and belongs to no capture.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgrid.llm.common import materialize, shared_dir

END = "\r\n"
RECORD_END = "\r\n\r\n"
#: Payloads shorter than this are always responses.
MIN_REVISIT_BYTES = 0
#: Bytes of payload that a file is planned for.
FILE_BYTES = 8_000_000
#: Bytes of blocks that are handed on at once.
ROWS_BYTES = 8_000_000
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(sha1: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: five hex digits are four digits of base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1, a, n), 16, 32), n * 4 // 5, "0") for a, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _record_id(kind: str, row: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(kind), row))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record's text: headers with a null value are left out."""
    rows = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind if isinstance(kind, Column) else F.lit(kind))]
    rows += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    rows.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(END, *rows), F.lit(END + END), block)


def row_key(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """A Parquet table and a key that each of its rows keeps, however its files are dealt out to tasks."""
    rows = spark.read.parquet(path)
    return rows, F.concat_ws("-", F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index").cast("string"))


def write_warc(pages: DataFrame, path: str, key: Column | None = None, min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``path``.

    ``key`` tells rows apart and must be the same in each scan, as ``row_key``'s is;
    without one the pages are written in the shared folder first.
    """
    if key is None:
        stored = shared_dir(pages.sparkSession)
        pages.select("page_id", "url", "html").write.parquet(stored)
        pages, key = row_key(pages.sparkSession, stored)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"), key.alias("_row"))
    narrow = materialize(rows.select("page_id", "_row", F.sha1(F.encode("payload", "UTF-8")).alias("sha1"), F.octet_length("payload").alias("n_bytes")))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "_row")
    firsts = narrow.where(F.col("n_bytes") >= min_bytes).groupBy("sha1").agg(F.min(order).alias("first"), F.count("*").alias("twins")).where("twins > 1")
    revisits = (
        narrow.where(F.col("n_bytes") >= min_bytes).join(firsts, "sha1")
        .where(F.col("first._row") != F.col("_row")).select("_row", F.col("first._row").alias("_first"))
    )
    facts = narrow.select("_row", "n_bytes", base32(F.col("sha1")).alias("digest")).join(revisits, "_row", "left")
    total = narrow.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()["b"]
    files = max(1, round(total / file_bytes))
    # Dealt out once, by the row: a task that runs again makes the same file.
    rows = rows.repartition(files, "_row").join(facts, "_row")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    own, is_revisit = _record_id("response", F.col("_row")), F.col("_first").isNotNull()
    uri, date = ("WARC-Target-URI", url), ("WARC-Date", F.lit(DATE))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END + END))
    request = _record("request", [("WARC-Record-ID", _record_id("request", F.col("_row"))), date, uri, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1{END}{END}")))
    answer = _record(
        F.when(is_revisit, "revisit").otherwise("response"),
        [("WARC-Record-ID", own), date, uri, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), ("WARC-Refers-To", F.when(is_revisit, _record_id("response", F.col("_first")))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.when(is_revisit, "").otherwise(F.col("payload"))),
    )
    metadata = _record("metadata", [("WARC-Record-ID", _record_id("metadata", F.col("_row"))), date, uri, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)))
    out = rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    out.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("refers_to", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("stated_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("block", T.BinaryType()), T.StructField("problem", T.StringType()),
])


def unpacked(content: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of an archive in pieces of about ``size``: of all gzip members, one after the other, or as they are."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[at : at + size] for at in range(0, len(content), size))
        return
    member, started = zlib.decompressobj(31), False
    for at in range(0, len(content), size):
        rest = content[at : at + size]
        while rest:
            started = True
            yield member.decompress(rest, size)
            rest = member.unused_data if member.eof else member.unconsumed_tail
            if member.eof:
                member, started = zlib.decompressobj(31), False
    if started:
        yield member.flush()
        if not member.eof:
            raise EOFError


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, list[str]], bytes, str | None]]:
    """(headers, block, problem) of each record; a header may come several times.

    An archive is unpacked as its records are taken; one record is in memory. What is
    broken is a row too, with its ``problem``: a record without a length is passed over
    up to the next one, a block or an archive that is cut off is the last.
    """
    source, have, broken = unpacked(content), bytearray(), None

    def fill(until) -> int:
        """Unpack until ``until()`` finds a place, or nothing is left: -1 then."""
        nonlocal broken
        while (found := until()) < 0 and broken is None:
            try:
                have.extend(next(source))
            except StopIteration:
                broken = ""
            except (EOFError, zlib.error):
                broken = "compressed data is broken"
        return found

    while True:
        start = fill(lambda: have.find(b"WARC/"))
        if start < 0:
            if broken or have.strip():
                yield {}, bytes(have), broken or "no record"
            return
        del have[:start]
        head_end = fill(lambda: have.find(b"\r\n\r\n"))
        if head_end < 0:
            yield {}, bytes(have), broken or "headers are cut off"
            return
        headers: dict[str, list[str]] = {}
        for line in have[:head_end].decode("utf-8", "replace").split(END)[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        length = headers.get("content-length", [""])[0]
        start = head_end + 4
        if not (length.isascii() and length.isdigit()):
            yield headers, b"", "no length"
            del have[:start]
            continue
        stop = start + int(length)
        if fill(lambda: 0 if len(have) >= stop else -1) < 0:
            yield headers, bytes(have[start:]), broken or "block is cut off"
            return
        yield headers, bytes(have[start:stop]), None if headers.get("warc-record-id", [""])[0] else "no record id"
        del have[:stop]


def read_warc(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """A row per record; the payload's size and digest are taken from the bytes read.

    Blocks of responses are kept only if ``keep_blocks``; those of other kinds always.
    A file comes to its task as its compressed bytes and is unpacked record by record.
    Broken records have a ``problem``, and neither type nor size nor digest.
    """

    def parse(batches):
        import pandas as pd

        names = RECORDS.fieldNames()
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for h, block, problem in parse_warc(content):
                    one = lambda name, h=h: h.get(name, [None])[0]
                    kind, size, digest = None if problem else one("warc-type"), None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    stated = one("warc-payload-digest")
                    block = block if keep_blocks or kind != "response" else None
                    rows.append((one("warc-record-id"), kind, one("warc-target-uri"), h.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-date"), stated and stated.partition(":")[2], size, digest, block, problem))
                    held += len(block or b"")
                    if len(rows) == 1000 or held > ROWS_BYTES:
                        yield pd.DataFrame(rows, columns=names, dtype=object)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, RECORDS)


def captures_of(records: DataFrame) -> DataFrame:
    """(record_id, capture_id) of the records that are concurrent to others which are so too, or to several.

    Those make chains; all links' components are found then, by the least id that spreads
    along links and from node to label until nothing moves.
    """
    links = materialize(records.select(F.col("record_id").alias("u"), F.explode("concurrent_to").alias("v")).where("u is not null and u <> v").distinct())
    several = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    chained = links.join(links.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u")
    if several.unionByName(chained).isEmpty():
        return links.select(F.col("u").alias("record_id"), F.col("v").alias("capture_id")).limit(0)
    both = materialize(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        moved = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("to"))
        far = labels.select(F.col("u").alias("to"), F.col("label").alias("far"))
        moved = materialize(moved.join(far, "to", "left").select("u", "label", F.least("to", "far").alias("to")))
        labels = moved.select("u", F.col("to").alias("label"))
        if moved.where("label <> to").isEmpty():
            return labels.select(F.col("u").alias("record_id"), F.col("label").alias("capture_id"))


def assemble_transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: its id, request, answer (response or revisit) and metadata.

    Records belong together if a chain of WARC-Concurrent-To names leads from one to the
    other, whatever its direction and length. A capture is named by its answer, else by
    what its records are concurrent to; a request or metadata record whose answer is missing makes a
    capture without one. Of several records of a kind the one with the least id is taken;
    broken records belong to none.
    """
    part = F.struct("record_id", "type", "target_uri", "date", "refers_to", "stated_digest", "payload_bytes", "payload_digest", "block")
    whole = records.where("problem is null")
    keyed = whole.select("record_id", F.coalesce(F.get("concurrent_to", F.lit(0)), "record_id").alias("capture_id"), "type", part.alias("part"))
    chains = captures_of(whole.select("record_id", "concurrent_to"))
    if not chains.isEmpty():
        chains = chains.withColumnsRenamed({"record_id": "of", "capture_id": "chain"})
        keyed = keyed.join(chains, F.col("record_id") == F.col("of"), "left").withColumn("capture_id", F.coalesce("chain", "capture_id"))
    pick = lambda *kinds: F.min_by("part", F.when(F.col("type").isin(*kinds), F.col("part.record_id")))
    found = keyed.groupBy("capture_id").agg(pick("request").alias("request"), pick("response", "revisit").alias("answer"), pick("metadata").alias("metadata"))
    return found.withColumn("capture_id", F.coalesce("answer.record_id", "capture_id"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Captures with the page_id of their metadata, and the full payload's size and digest.

    A revisit takes them from the response that it refers to.
    """
    page = F.regexp_extract(F.decode("metadata.block", "UTF-8"), r"page-id: (-?\d+)", 1)
    own = captures.select("capture_id", F.when(page != "", page).cast("long").alias("page_id"), F.col("answer.type").alias("record_type"), F.col("answer.refers_to").alias("_to"), "answer.payload_bytes", "answer.payload_digest")
    originals = own.where("record_type = 'response'").select(F.col("capture_id").alias("_to"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_b"), F.col("payload_digest").alias("_d"))
    responses = own.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = own.where("record_type = 'revisit'").join(originals, "_to", "left").select("page_id", F.col("_b").alias("payload_bytes"), F.col("_d").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(revisits)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    pages, key = row_key(spark, f"{sf_dir}/pages.parquet")
    write_warc(pages, path, key)
    records = materialize(read_warc(spark, path, keep_blocks=False))  # archives are unpacked once
    captures = materialize(assemble_transactions(records))
    return resolve_revisits(captures)


ORACLE_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h,
    min(page_id) over (partition by sha1(coalesce(html, ''))) as first
  from pages),
d as (
  select *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::bigint, 5))::bigint >> (15 - 5 * (i % 4))::bigint) & 31) + 1, 1)), '') as payload_digest
  from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from d
"""
