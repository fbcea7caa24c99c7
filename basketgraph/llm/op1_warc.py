"""Deterministic sharded WARC writer and reader.

Pages are cut into shards by ranges of page_id that hold about equal payload
bytes, sorted within a shard, and written as one gzip member per record; a file
is closed once its compressed size reaches the roll size. A task writes under
temporary names of its own attempt; the job then renames the files named by the
tasks that Spark accepted and writes a manifest last, so a lost or repeated task
leaves nothing that a reader of the manifest would see. Record ids, headers,
digests and the order of files depend on the rows only.

Of records with equal payloads (of at least ``min_revisit_bytes``) the one with
the largest page_id is the response; the others are revisit records that refer
to it and carry no payload.

Defined results: a null html is an empty payload; a null url has no target
header; null page ids sort first and, among equal payloads, revisit any
other; rows that repeat a page_id and its payload are all of the type that this
page has; an empty table writes an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query
from basketgraph.session import shared_path

SHARD_BYTES = 32 << 20
ROLL_BYTES = 16 << 20
#: Fixed record date: archives of the same rows are equal byte for byte.
RECORD_DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("7f2d5a9e-2a53-4c5f-9a53-0d1f5d1c0b11")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "shard int, seq int, name string, temp string, records long, bytes long, sha256 string"
RECORD_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, digest_ok boolean"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append(f"WARC-Block-Digest: sha1:{base32_sha1(block)}")
    if is_revisit:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    head += [f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the rows that revisit a payload; payloads are compared by SHA-1 and length."""
    narrow = pages.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("n")).where(F.col("n") >= min_revisit_bytes)
    groups = narrow.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1 and refers_to is not null")
    found = narrow.join(groups, ["digest", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, out: str, min_revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write (page_id, url, html) under ``out``; returns the manifest (also written as MANIFEST.json)."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    bounds = common.key_bounds(pages, "page_id", F.length("payload") + 200, shard_bytes)
    # a revisit's decision row sorts right before its page row, so one shuffle brings both to the writer
    marks = revisits(pages, min_revisit_bytes).select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    rows = pages.select("page_id", F.sha1("payload").alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "payload").unionByName(marks)
    rows = rows.withColumn("shard", common.shard_of("page_id", bounds)).repartitionById(len(bounds) + 1, F.col("shard"))
    rows = rows.sortWithinPartitions(F.asc_nulls_first("page_id"), "digest", "kind", "url")
    temp = f"{out}/_temporary"
    common.make_dirs(spark, temp)
    manifest = common.stored(rows.mapInArrow(_writer(temp, roll_bytes), MANIFEST_SCHEMA), "op1-manifest").orderBy("shard", "seq")
    files = manifest.collect()  # one row per archive file
    common.rename_all(spark, [(f"{temp}/{f['temp']}", f"{out}/{f['name']}") for f in files])
    common.put_text(spark, f"{out}/MANIFEST.json", json.dumps([{k: f[k] for k in ("name", "records", "bytes", "sha256")} for f in files], indent=0))
    return manifest


def _writer(temp: str, roll_bytes: int):
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fs, base = common.task_fs(temp)
        attempt, out, mark, seq, shard = uuid.uuid4().hex, None, None, 0, 0
        name = sha = None
        records = size = 0
        done = []

        def close():
            out.close()
            done.append((shard, seq, f"pages-{shard:06d}-{seq:05d}.warc.gz", name, records, size, sha.hexdigest()))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "digest", "kind", "refers_to", "url", "payload", "shard")]
            for page_id, digest, kind, refers_to, url, payload, shard_no in zip(*cols, strict=True):
                shard = shard_no
                if kind == 0:
                    mark = (page_id, digest, refers_to)
                    continue
                is_revisit = mark is not None and mark[:2] == (page_id, digest)
                if out is None:
                    name, sha, records, size = f"{attempt}-{seq:05d}", hashlib.sha256(), 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(warc_record(page_id, url, payload, mark[2] if is_revisit else None, is_revisit)) + z.flush()
                out.write(member)
                sha.update(member)
                records, size = records + 1, size + len(member)
                if size >= roll_bytes:
                    close()
                    out, seq = None, seq + 1
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "seq", "name", "temp", "records", "bytes", "sha256"), d, strict=True)) for d in done], schema=pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("temp", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    return write


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    z, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(z.decompress(data))
        if z.eof:
            yield b"".join(parts)
            data, z, parts = z.unused_data or stream.read(chunk), zlib.decompressobj(31), []
        else:
            data = stream.read(chunk)
    if any(parts):
        raise ValueError("truncated archive")


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    is_revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    ok = "sha1:" + base32_sha1(block) == fields["WARC-Block-Digest"]
    size = int(fields["X-Payload-Length"])
    if not is_revisit:
        payload = block.partition(b"\r\n\r\n")[2]
        ok, size, digest = ok and base32_sha1(payload) == digest, len(payload), base32_sha1(payload)
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers), "payload_bytes": size, "payload_digest": digest, "digest_ok": ok,
    }


def read_warc(spark: SparkSession, out: str, manifest: DataFrame) -> DataFrame:
    """The records of the manifest's files, each file streamed by one task; digests are computed again."""
    names = manifest.select("name")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = common.task_fs(out)
        for batch in batches:
            for name in batch["name"]:
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for raw in members(f):
                        rows.append(parse_record(raw))
                        if len(rows) == 2000:
                            yield _frame(rows)
                            rows = []
                yield _frame(rows)

    n_files = max(1, names.count())
    return names.repartition(min(n_files, 4096)).mapInPandas(parse, RECORD_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "digest_ok"])
    return df.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64", "digest_ok": "bool"})


@query("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read(spark, sf_dir, "pages")
    out = shared_path(spark, "op1-warc")
    manifest = write_warc(pages, out)
    return read_warc(spark, out, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")
