"""Deterministic sharded WARC writer and reader.

Method. Payload digests come from one native pass; of records with equal payloads the one with the smallest key is
the response, the others become revisits of it. Records are sorted by ranges of the key whose bounds depend on the
rows alone, one range a shard; a shard's task rolls its gzip-per-record files by compressed size and regenerates all
headers and digests. A file is written under a temporary name of the task attempt and renamed when it is whole, to a
name that depends on shard and number alone, so a repeated attempt replaces like by like. The manifest table is
written last, by Spark's own committer: what it does not list is not part of the archive. The reader goes by the
manifest, streams every file and checks each payload against its digest.

Defined cases: null payloads count as empty; payloads below ``min_revisit_bytes`` are all responses; rows without a
key sort first and are responses; rows that repeat a key and payload are of the same type, their record ids are told
apart by a counter; without a url there is no target header; extra columns are not written; an empty table gives an
archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import col, range_bounds, range_part, text_of

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MANIFEST = ("file string, shard int, number int, records long, responses long, revisits long, bytes long, "
            "sha256 string")
RECORDS = ("key long, record_type string, refers_to long, url string, payload_digest string, payload_bytes long, "
           "payload binary")


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column, by built-in functions."""
    digest = F.sha1(data)
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0"), digits, BASE32)
                      for i in range(4)])


def _fs(uri: str):
    """File system and path of a folder that all workers share."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers),
             f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    """One gzip member without a time stamp."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _key_text(key) -> str:
    return "null" if key is None else str(key)


def plan_records(df: DataFrame, key: str, payload: str, min_revisit_bytes: int = 0, salts: int = 32) -> DataFrame:
    """(key, digest, first): the rows that revisit an equal payload and the smallest key that holds it.

    Keys and digests only. Groups pre-aggregate before their shuffle; the join back is salted, as one payload may
    hold a third of all rows.
    """
    data = F.encode(text_of(payload), "utf-8")
    ids = df.select(col(key).cast("long").alias("k"), sha1_base32(data).alias("digest"), F.octet_length(data).alias("n"))
    groups = (ids.groupBy("digest", "n").agg(F.min("k").alias("first"), F.count("*").alias("rows"))
              .where((F.col("rows") > 1) & (F.col("n") >= min_revisit_bytes) & F.col("first").isNotNull())
              .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    return (ids.withColumn("salt", F.pmod(F.hash("k"), F.lit(salts))).join(groups, ["digest", "salt"])
            .where("k <> first").select("k", "digest", "first").distinct())


def write_warc(df: DataFrame, out: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit_bytes: int = 0, shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20, level: int = 6,
               date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all rows under the new shared folder ``out`` and return the manifest as committed.

    Shards hold about ``shard_bytes`` of payload, files about ``roll_bytes`` compressed. A task holds one record and
    the file stream.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(F.octet_length(text_of(payload)).cast("long"))).first()[0] or 0
    bounds = range_bounds(df, key, max(1, -(-total // shard_bytes)))
    revisits = plan_records(df, key, payload, min_revisit_bytes)
    rows = (df.select(col(key).cast("long").alias("k"), col(url).cast("string").alias("url"), text_of(payload).alias("body"))
            .withColumn("digest", sha1_base32(F.encode("body", "utf-8"))).withColumn("first", F.lit(None).cast("long")))
    # what a record revisits travels as a row of its own just before it: payloads move once, without a join
    marks = revisits.select("k", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("body"), "digest", "first")
    dealt = (rows.unionByName(marks).withColumn("shard", range_part("k", bounds))
             .repartitionById(len(bounds) + 1, F.col("shard"))
             .sortWithinPartitions(F.col("k").asc_nulls_first(), "digest", F.col("first").isNull(), F.col("url").asc_nulls_first())
             .select("shard", "k", "url", "body", "digest", "first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _fs(out)
        fs.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple] = []
        stream = None

        def close():
            nonlocal stream
            stream.close()
            if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{folder}/{name}")
            fs.move(f"{folder}/{temp}", f"{folder}/{name}")
            done.append((name, shard, number, counts[0], counts[1], counts[2], size, sha.hexdigest()))
            stream = None

        def put(data: bytes):
            nonlocal size
            packed = _gzip(data, level)
            stream.write(packed)
            sha.update(packed)
            size += len(packed)

        shard, number, size, name, temp, sha, counts, last, copy = -1, 0, 0, "", "", None, [], None, 0
        marked, to = None, None
        for batch in batches:
            for s, k, target, body, digest, mark in zip(*(c.to_pylist() for c in batch.columns)):
                if mark is not None:
                    marked, to = (k, digest), mark
                    continue
                first = to if marked == (k, digest) else None
                if stream is not None and (s != shard or size >= roll_bytes):
                    close()
                    number = number + 1 if s == shard else 0
                if stream is None:
                    shard, size, sha, counts = s, 0, hashlib.sha256(), [0, 0, 0]
                    name = f"part-{shard:06d}-{number:05d}.warc.gz"
                    temp = f".{name}.{attempt}.tmp"
                    stream = fs.open_output_stream(f"{folder}/{temp}", compression=None)
                    put(_record("warcinfo", [("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Date", date),
                                             ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                                b"format: WARC File Format 1.1\r\n"))
                copy = copy + 1 if last == (s, k) else 0
                last = (s, k)
                data = body.encode("utf-8", "surrogatepass")
                http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(data)}\r\n\r\n").encode()
                head = [("WARC-Record-ID", f"<urn:x-page:{_key_text(k)}" + (f":{copy}>" if copy else ">")),
                        ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response")]
                if target is not None:
                    head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", target)))
                head.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()))
                if first is None:
                    put(_record("response", head, http + data))
                else:
                    head += [("WARC-Refers-To", f"<urn:x-page:{first}>"),
                             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    put(_record("revisit", head, http))
                counts[0] += 1
                counts[2 - (first is None)] += 1
        if stream is not None:
            close()
        if done:
            schema = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("number", pa.int32()), *[(n, pa.int64()) for n in
                                ("records", "responses", "revisits", "bytes")], ("sha256", pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    data, d, out = b"", zlib.decompressobj(31), []
    while data or (data := stream.read(1 << 20)):
        out.append(d.decompress(data))
        data = d.unused_data
        if d.eof:
            yield b"".join(out)
            d, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("archive ends within a record")


def read_warc(spark: SparkSession, out: str, with_payload: bool = True) -> DataFrame:
    """All response and revisit records that the manifest of ``out`` lists; a digest that differs raises an error."""
    listed = spark.read.schema(MANIFEST).parquet(f"{out}/_manifest").select("file")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _fs(out)
        schema = pa.schema([("key", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        head, _, block = member.partition(b"\r\n\r\n")
                        first, *lines = head.decode().split("\r\n")
                        fields = dict(x.split(": ", 1) for x in lines)
                        kind, block = fields["WARC-Type"], block[:int(fields["Content-Length"])]
                        if kind == "warcinfo":
                            continue
                        page = fields["WARC-Record-ID"].strip("<>").split(":")[2]
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response":
                            n, own = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
                            if own != digest:
                                raise ValueError(f"{name}: payload of {page} differs from its digest")
                        else:
                            n, body = int(re.search(rb"Content-Length: (\d+)", http)[1]), None
                        to = fields.get("WARC-Refers-To")
                        rows.append((None if page == "null" else int(page), kind, to and int(to.strip("<>").split(":")[2]),
                                     fields.get("WARC-Target-URI"), digest, n, body if with_payload else None))
                        held += len(block)
                        if len(rows) >= 4096 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return listed.repartition(tasks, "file").mapInArrow(read, RECORDS)
