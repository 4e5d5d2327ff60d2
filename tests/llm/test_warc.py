import base64
import glob
import gzip
import hashlib

from cohortlab.llm.common import shared_folder
from cohortlab.llm.warc import read_warc, write_warc

PAGES = [(3, "http://a/x y\n", "same"), (1, "http://b", "same"), (2, None, ""), (5, "http://c", None), (None, "http://d", "same"),
         (7, "http://e", "é" * 50_000), (7, "http://e", "é" * 50_000), (8, "http://f", "line\r\n\r\nbreaks\n"), (9, "http://g", "same")]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, shard string")


def want(rows, least=0):
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        first = min(same) if len(data) >= least and same and k is not None else k
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if k == first else "revisit", None if k == first else first))
    return sorted(out, key=repr)


def got(spark, out):
    return sorted((tuple(r) for r in read_warc(spark, out).select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip_and_revisits(spark):
    for least in (0, 3, 5):
        out = shared_folder(spark, "warc-test")
        write_warc(frame(spark), out, min_revisit_bytes=least, shard_bytes=1000, roll_bytes=300)
        assert got(spark, out) == want(PAGES, least)
        bodies = {(r.key, bytes(r.payload)) for r in read_warc(spark, out).where("record_type = 'response'").collect()}
        assert bodies <= {(k, (h or "").encode()) for k, _, h in PAGES}


def test_files_depend_on_rows_alone_and_follow_the_manifest(spark):
    found = []
    for parts in (1, 7):
        out = shared_folder(spark, "warc-test")
        manifest = write_warc(frame(spark, PAGES * 20).repartition(parts), out, shard_bytes=100_000, roll_bytes=2000).collect()
        folder = out.removeprefix("file:")
        files = {f.rpartition("/")[2]: open(f, "rb").read() for f in glob.glob(f"{folder}/part-*")}
        assert {m.file: m.sha256 for m in manifest} == {f: hashlib.sha256(b).hexdigest() for f, b in files.items()}
        assert not glob.glob(f"{folder}/.part*.tmp") and sum(m.records for m in manifest) == len(PAGES) * 20
        assert all(gzip.decompress(b).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for b in files.values())
        found.append(files)
    assert found[0] == found[1] and len(found[0]) > 1


def test_empty_table(spark):
    out = shared_folder(spark, "warc-test")
    assert write_warc(frame(spark).where("page_id = -1"), out).count() == 0
    assert read_warc(spark, out).count() == 0
