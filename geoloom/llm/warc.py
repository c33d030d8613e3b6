"""WARC archives (operator 8): a deterministic sharded writer, and a reader.

Records are range-sorted by page, so neighbouring pages lie in the same file.
The bounds of the ranges (shards) are quantiles of the rows with the least hashes,
and their number follows from the bytes of the table: both depend on the rows
alone, so the same rows give the same files, byte for byte, however they are
dealt and whatever the session's settings are.  A task writes a shard as gzip
members, one for each record, and rolls to a new file when the compressed size
reaches ``roll_bytes``.  Headers, record ids and digests are made anew from the
payload.  A task writes under temporary names that hold its attempt; only the
names that successful tasks report are moved to their final names, by tasks too,
and the manifest is written last, so a lost executor or a second attempt leaves
nothing that a reader would see.

Of records with equal payloads of at least ``least_bytes`` bytes, that with the
largest page_id is a response, the others are revisits that refer to it.

Defined results: a null html is an empty payload; rows that repeat the largest
page_id of a payload are all responses; a null page_id is a revisit wherever its
payload has a page_id, else a response; a null url leaves out the target; ties in
page_id are ordered by url, then payload, and rows that agree in all are the same
record, written again; a very long payload is one record, which a task holds;
extra columns, whatever their names, are ignored; an empty table gives an empty
archive with a manifest.  Memory: one record at a time, whatever the size of a
file or shard.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, remember, shared_dir, small_batches, store_of, stored

ROLL_BYTES, LEAST_BYTES = 256 << 20, 0
#: Payload of a shard, as long as that makes at most so many shards; rows for each shard that place its bounds.
SHARD_BYTES, MOST_SHARDS, PLACING = 32 << 20, 20_000, 32
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "MANIFEST.json"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16], version=5)}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record, not compressed."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}"] if url is not None else []),
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}", f"X-Payload-Length: {len(payload)}"] if revisit else []),
        *([f"X-Page: {page_id}"] if page_id is not None else []), f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without name or time."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _writer(uri: str, roll_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = store_of(uri)
        attempt, files, out, size, n, now, k = uuid.uuid4().hex, [], None, 0, 0, None, 0

        def close() -> None:
            nonlocal out, k
            if out is not None:
                out.close()
                files.append((f"_temporary/{attempt}-{len(files)}", f"part-{now:05d}-{k:05d}.warc.gz", n, size))
                out, k = None, k + 1

        for pdf in batches:
            for shard, page, url, html, refers in zip(pdf["shard"], pdf["page_id"], pdf["url"], pdf["html"], pdf["refers_to"], strict=True):
                if shard != now:
                    close()
                    now, k = shard, 0
                page, refers = None if pd.isna(page) else int(page), None if pd.isna(refers) else int(refers)
                data = member(record(page, url, (html or "").encode("utf-8", "surrogatepass"), refers, refers is not None))
                if out is None:
                    out, size, n = store.open_output_stream(f"{path}/_temporary/{attempt}-{len(files)}", compression=None), 0, 0
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    close()
        close()
        if files:
            yield pd.DataFrame(files, columns=["temp", "file", "records", "bytes"])

    return run


def _mover(uri: str):
    """Gives files their final names; a second attempt finds some of them moved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = store_of(uri)
        for pdf in batches:
            for temp, file in zip(pdf["temp"], pdf["file"], strict=True):
                try:
                    store.move(f"{path}/{temp}", f"{path}/{file}")
                except OSError:
                    if store.get_file_info(f"{path}/{file}").type != fs.FileType.File:
                        raise
            yield pdf[["file"]]

    return run


def with_references(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows (page_id, url, html, refers_to, tie), and a stored table of the same rows (page_id, tie, bytes)."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("_d"), F.octet_length(html).alias("_n")).withColumn("tie", F.xxhash64("url", "_d"))
    slim = stored(p.select("page_id", "tie", "_d", F.col("_n").cast("long").alias("bytes")), "payloads")
    again = slim.where(F.col("bytes") >= least_bytes).groupBy("_d").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_rows"))
    # written first: where few payloads repeat, its size on disk lets the join send it to the pages, which then aren't shuffled
    again = stored(again.where((F.col("_rows") > 1) & F.col("_last").isNotNull()).select("_d", "_last"), "repeated-payloads")
    other = F.when(F.coalesce(F.col("page_id") < F.col("_last"), F.col("_last").isNotNull()), F.col("_last"))
    return p.join(again, "_d", "left").select("page_id", "url", "html", other.alias("refers_to"), "tie"), slim


#: Pages without an id come first.
_FIRST = -(1 << 63)


def sharding(slim: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[Column, int]:
    """Number of the shard of a row (page_id, tie), and how many shards there are; of ``slim`` a bounded number of rows places the bounds, the same for the same rows."""
    n, size = slim.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    shards = min(-(-(size or 0) // shard_bytes) or 1, MOST_SHARDS)
    page = F.coalesce("page_id", F.lit(_FIRST))
    chance = min(1.0, PLACING * shards / max(n, 1))
    chosen = slim.where(F.shiftrightunsigned(F.xxhash64(F.lit(8), page, "tie"), 11) < F.lit(int(chance * 2**53)))
    keys = sorted((r["page"], r["tie"], r["n"]) for r in chosen.groupBy(page.alias("page"), "tie").agg(F.count(F.lit(1)).alias("n")).collect()) if shards > 1 else []
    upto = np.cumsum([k[2] for k in keys])
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)) if keys else np.empty(0, np.int64)
    bounds = np.array([keys[i][:2] for i in at], np.int64).reshape(-1, 2)
    places = [tuple(x) for x in bounds.tolist()]

    @F.pandas_udf("int")
    def shard(page: pd.Series, tie: pd.Series) -> pd.Series:
        p, t = page.to_numpy(np.int64), tie.to_numpy(np.int64)
        out = np.searchsorted(bounds[:, 0], p)
        for i in np.flatnonzero(np.searchsorted(bounds[:, 0], p, side="right") > out):  # on a bound's page the tie decides
            out[i] = bisect_left(places, (p[i], t[i]))
        return pd.Series(out.astype(np.int32))

    return shard(page, F.col("tie")), len(places) + 1


def write(pages: DataFrame, uri: str, roll_bytes: int = ROLL_BYTES, least_bytes: int = LEAST_BYTES, shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Writes the archive to a folder that executors reach; returns the manifest's entries, one for each file."""
    spark = pages.sparkSession
    small_batches(spark)
    store, path = store_of(uri)
    store.create_dir(f"{path}/_temporary", recursive=True)
    rows, slim = with_references(pages, least_bytes)
    shard, shards = sharding(slim, shard_bytes)
    dealt = rows.withColumn("shard", shard).repartitionById(shards, "shard").sortWithinPartitions("shard", "page_id", "url", "tie", "refers_to")
    done = dealt.select("shard", "page_id", "url", "html", "refers_to").mapInPandas(_writer(uri, roll_bytes), "temp string, file string, records long, bytes long")
    done = sorted(done.collect(), key=lambda r: r["file"])
    if done:
        names = spark.createDataFrame([(r["temp"], r["file"]) for r in done], "temp string, file string").repartition(max(1, min(len(done) // 64, 1000)))
        moved = names.mapInPandas(_mover(uri), "file string").count()
        if moved != len(done):
            raise RuntimeError(f"{len(done)} files were written, {moved} moved")
    entries = [{"file": r["file"], "records": r["records"], "bytes": r["bytes"]} for r in done]
    store.delete_dir(f"{path}/_temporary")
    with store.open_output_stream(f"{path}/{MANIFEST}.new") as f:
        f.write(json.dumps({"files": entries}, indent=1).encode())
    store.move(f"{path}/{MANIFEST}.new", f"{path}/{MANIFEST}")
    discard(slim)
    return entries


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Records of a gzip file read in chunks; holds one record."""
    z, out = zlib.decompressobj(31), []
    for data in chunks:
        while data:
            out.append(z.decompress(data))
            data = b""
            if z.eof:
                yield b"".join(out)
                data, z, out = z.unused_data, zlib.decompressobj(31), []


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def _reader(uri: str, payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = store_of(uri)
        for pdf in batches:
            for name in pdf["file"]:
                rows = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as f:
                    for data in records(iter(lambda f=f: f.read(1 << 20), b"")):
                        h, block = parsed(data)
                        body = block.partition(b"\r\n\r\n")[2]
                        response = h["WARC-Type"] == "response"
                        if base32_sha1(block) != h["WARC-Block-Digest"][5:] or response and base32_sha1(body) != h["WARC-Payload-Digest"][5:]:
                            raise ValueError(f"{name}: a record's digest is wrong")
                        rows.append((
                            int(h["X-Page"]) if "X-Page" in h else None, h.get("WARC-Target-URI"), len(body) if response else int(h["X-Payload-Length"]), h["WARC-Payload-Digest"][5:],
                            h["WARC-Type"], int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None, body.decode("utf-8", "surrogatepass") if payload and response else None,
                        ))
                        if len(rows) == 256:
                            yield _frame(rows)
                            rows = []
                if rows:
                    yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})


def read(spark: SparkSession, uri: str, payload: bool = True) -> DataFrame:
    """Records of the files that the manifest names; ``html`` is null for revisits, or without ``payload``."""
    store, path = store_of(uri)
    with store.open_input_stream(f"{path}/{MANIFEST}") as f:
        files = [(x["file"],) for x in json.loads(f.read())["files"]]
    names = spark.createDataFrame(files, "file string").repartition(max(1, min(len(files), 10_000)))
    return names.mapInPandas(_reader(uri, payload), READ)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    remember(spark, uri)
    write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), uri)
    return read(spark, uri, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM k
"""
