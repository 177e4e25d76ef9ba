"""WARC archives: a deterministic sharded writer and a reader.

Slim rows (id, digest, size) decide everything first: which record of each payload is the response, and, from exact
running sums in id order, to which shard every record belongs. Then each shard is written by one task, sorted by id, with
headers and digests made anew; a file is closed when its compressed size is reached and the next one begins.

Files are plain ``.warc.gz`` files in the archive's folder. A task writes each under a temporary name of its own and
renames it, so a lost executor or a repeated task leaves no half file; the manifest of (name, records, bytes, sha256),
JSON lines that Spark commits after all tasks, says which files the archive consists of and is what the reader goes by.
Equal input gives equal files, byte for byte.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, get_file, hot_keys, put_file, ranked, salted_join, scratch, table, tidying, workers_can_import

REVISIT_FROM = 100  # bytes; smaller payloads are always written in full
SHARD_BYTES = 32 << 20  # payload bytes of one group of records
ROLL_BYTES = 16 << 20  # compressed size at which a file is closed
MOST_SHARDS = 1 << 16  # a shard takes the larger of SHARD_BYTES and this share of all bytes; so many bounds go to each task
DATE = "1970-01-01T00:00:00Z"  # fixed, so that reruns agree
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
MANIFEST = "name string, records long, bytes long, sha256 string"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def record_id(page_id: int | None, tie: int, copy: int) -> str:
    """By page, hash of its content, and number among rows equal in both."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page:{page_id}:{tie}:{copy}')}>"


def _base32(hex_digest: str) -> str:
    return "sha256:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def make_record(page_id: int | None, tie: int, copy: int, url: str | None, payload: bytes, digest: str, first: tuple[int | None, int] | None) -> bytes:
    """One record. ``first``: page and tie of the record with the same payload that this one revisits; its payload then is left out."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, tie, copy)}", f"WARC-Date: {DATE}"]
    uri = " ".join((url or "").split()) or f"urn:page:{page_id}"
    head += [f"WARC-Target-URI: {uri}", f"WARC-Page-ID: {'' if page_id is None else page_id}", f"WARC-Payload-Digest: {_base32(digest)}", f"WARC-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + b"\r\n\r\n"
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(*first, 0)}", f"WARC-Refers-To-Page-ID: {'' if first[0] is None else first[0]}"]
    block = http if first is not None else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Block-Digest: {_base32(hashlib.sha256(block).hexdigest())}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each record of one file of gzip members; digests and lengths are checked."""
    with gzip.open(io.BytesIO(content)) as f:
        while line := f.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"not a record: {line[:40]!r}")
            head: dict[str, str] = {}
            while (line := f.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                head[name] = value.strip()
            block = f.read(int(head["Content-Length"]))
            if _base32(hashlib.sha256(block).hexdigest()) != head["WARC-Block-Digest"] or f.read(4) != b"\r\n\r\n":
                raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
            yield head, block


def _pack(batches: Iterator[pa.RecordBatch], folder: str, roll: int, level: int) -> Iterator[pa.RecordBatch]:
    """Rows as sorted in ``write_warc`` to files in the folder and to their lines of the manifest; needs one open file in memory.

    A fact (kind 0) comes just before the rows that it is about: their payload occurs elsewhere too.
    """
    held, size, records, shard, part = io.BytesIO(), 0, 0, None, 0
    fact, last, copy, met = None, None, 0, False

    def closed() -> pa.RecordBatch:
        content, name = held.getvalue(), f"part-{shard:05d}-{part:05d}.warc.gz"
        put_file(folder, name, content)
        return pa.RecordBatch.from_pydict({"name": [name], "records": [records], "bytes": [len(content)], "sha256": [hashlib.sha256(content).hexdigest()]})

    for batch in batches:
        for own, page, tie, digest, kind, url, html, first, first_tie in zip(*[batch.column(i).to_pylist() for i in range(9)], strict=True):
            if kind == 0:
                fact, met = (page, tie, digest, first, first_tie), False
                continue
            copy, last = (copy + 1 if (page, tie) == last else 0), (page, tie)
            refers = None
            if fact is not None and fact[:3] == (page, tie, digest) and (met or fact[3:] != (page, tie)):
                refers = fact[3:]
            met = True
            if records and (own != shard or size >= roll):
                yield closed()
                part, held, size, records = (part + 1 if own == shard else 0), io.BytesIO(), 0, 0
            shard = own
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)  # gzip without a time stamp
            record = make_record(page, tie, copy, url, (html or "").encode(), digest, refers)
            size += held.write(packer.compress(record) + packer.flush())
            records += 1
    if records:
        yield closed()


def _unpack(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, sha in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            content = get_file(folder, name)
            if hashlib.sha256(content).hexdigest() != sha:
                raise ValueError(f"{name} differs from its manifest")
            rows, held = [], 0
            for head, block in read_records(content):
                payload = block.partition(b"\r\n\r\n")[2]
                digest = base64.b32decode(head["WARC-Payload-Digest"].partition(":")[2]).hex()
                full = head["WARC-Type"] == "response"
                if full and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(head["WARC-Payload-Length"])):
                    raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
                page, refers = head["WARC-Page-ID"], head.get("WARC-Refers-To-Page-ID")
                rows.append((int(page) if page else None, int(head["WARC-Payload-Length"]), digest, head["WARC-Type"], int(refers) if refers else None, head["WARC-Target-URI"], payload if payloads and full else None))
                held += len(payload)
                if len(rows) == 500 or held > 8 << 20:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])


def _written(pages: DataFrame, to: str, shard_bytes: int, roll_bytes: int, level: int) -> None:
    html = F.coalesce(F.col("html"), F.lit(""))
    tie = F.xxhash64("url", "html").alias("tie")
    own = pages.select("page_id", "url", "html", F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("n"), tie)
    slim = cut(own.select("page_id", "digest", "n", "tie"))
    none = F.col("page_id").isNull()
    key = F.struct(none.alias("none"), F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("tie").alias("tie"))
    big = slim.filter(F.col("n") >= REVISIT_FROM)
    once = cut(big.groupBy("digest").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("digest", "c", F.when(~F.col("first.none"), F.col("first.page_id")).alias("first"), F.col("first.tie").alias("first_tie")))
    placed = ranked(slim, [none, F.col("page_id"), F.col("tie")], "place", {"before": "n"})
    per = max(shard_bytes, -(-(slim.agg(F.sum("n")).first()[0] or 0) // MOST_SHARDS))
    starts = placed.groupBy((F.col("before") / per).cast("long").alias("shard")).agg(F.min(key).alias("at"))
    bounds = sorted(tuple(r["at"]) for r in starts.collect())[1:]  # at most MOST_SHARDS of them

    @F.pandas_udf("long")
    def shard_of(none: pd.Series, ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in zip(none.tolist(), ids.tolist(), ties.tolist(), strict=True)], dtype="int64")

    repeats = salted_join(big.select("page_id", "digest", "tie"), once.drop("c"), ["digest"], F.xxhash64("page_id", "tie"), hot_keys(once, "digest", "c"))
    no = F.lit(None)
    fact = F.struct(F.lit(0).alias("kind"), no.cast("string").alias("url"), no.cast("string").alias("html"), F.col("first").alias("first"), F.col("first_tie").alias("first_tie"))
    facts = repeats.groupBy("page_id", "digest", "tie").agg(F.max("first").alias("first"), F.max("first_tie").alias("first_tie")).select("page_id", "digest", "tie", fact.alias("r"))
    rows = own.select("page_id", "digest", "tie", F.struct(F.lit(1).alias("kind"), "url", "html", no.cast("long").alias("first"), no.cast("long").alias("first_tie")).alias("r"))
    both = rows.unionByName(facts).withColumn("shard", shard_of(none, F.coalesce("page_id", F.lit(0)), "tie"))
    sorting = ["shard", none, "page_id", "tie", "digest", "r.kind", "r.url", "r.html"]
    dealt = both.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions(*sorting)  # a task holds one shard
    packed = dealt.select("shard", "page_id", "tie", "digest", "r.kind", "r.url", "r.html", "r.first", "r.first_tie").mapInArrow(lambda it: _pack(it, to, roll_bytes, level), MANIFEST)
    packed.write.json(f"{to}/manifest")


def write_warc(pages: DataFrame, to: str | None = None, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = 6) -> str:
    """Writes one record per row of ``pages`` (page_id, url, html; more columns are not looked at); returns the archive's folder.

    A null html is an empty payload and a null url an URN of the page id. Payloads of any length are one record. Rows of
    one page_id get one record each. Among equal payloads the smallest page_id is the response, of several rows with
    that id the one whose content hash is smallest, of equal rows one. Null ids come last and may be revisits (of the
    smallest id, or of one of them). An empty table gives an archive without files.
    """
    spark = pages.sparkSession
    workers_can_import(spark)
    to = to or scratch(spark, "warc")
    with tidying():
        _written(pages, to, shard_bytes, roll_bytes, level)
    return to


def read_warc(spark, archive: str, payloads: bool = False) -> DataFrame:
    """The records of an archive: page_id, payload_bytes, payload_digest (bare hex), record_type, refers_to, url, payload.

    Only files of the manifest are read; one that is missing or differs from it is an error.
    """
    workers_can_import(spark)
    manifest = spark.read.schema(MANIFEST).json(f"{archive}/manifest")
    tasks = max(1, min(manifest.count(), 20_000))
    return manifest.select("name", "sha256").repartition(tasks).mapInArrow(lambda it: _unpack(it, archive, payloads), PAGES)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    archive = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
