"""The pipeline against plain versions of its stages on a small table, and its stages on odd rows."""

import hashlib
import os

import numpy as np
import pytest
import test_text_dedup as brute_dedup
import test_pii as brute_pii

import __spark_entry__ as entry
import corpus_pipeline as cp
from cohortlab.llm import mixing, quality
from cohortlab.llm.common import crc_mod, table, tokenizer
from cohortlab.llm.sentencepiece_codec import model
from llm_samples import SF, needs_data


@needs_data
def test_stages_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    after = {}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == names
        after[name] = docs.collect()
    first = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    m = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"), crc_mod("doc_id", 4) != 2)
    good = {i for i, r in first.items() if m.predict(np.array([quality.features(r.text or "")]))[0] >= 0.7}
    assert {r.doc_id for r in after["quality"]} == good
    classes = brute_dedup.classes([(r.doc_id, r.text) for r in after["quality"]])
    assert {r.doc_id for r in after["near_duplicates"]} == {i for i, c in classes if i == c}
    by_id = {r.doc_id: r for r in after["near_duplicates"]}
    for r in after["personal_data"]:
        found = brute_pii.brute(by_id[r.doc_id].text)
        assert all(by_id[r.doc_id].text[s:e] not in r.text for k, s, e in found if k == "email")
        assert (r.text == by_id[r.doc_id].text) or r.n_chars == len(r.text)
    assert {r.doc_id for r in after["mixing"]} <= set(by_id)
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    texts, lib = {r.doc_id: r.text for r in after["mixing"]}, model(tokenizer("piece_bpe_32k.model")).library
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in after["mixing"])
    assert all(r.ids == lib.encode(texts[r.doc_id] or "") and r.n_tokens == len(r.ids) for r in last)


@needs_data
def test_stages_on_odd_rows(spark, odd, none):
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns, name
        assert stage(spark, none, SF).count() == 0, name
    assert cp.STAGES[-1][1](spark, odd, SF).count() == odd.count()


def test_mixing_writes_the_mixtures_order(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id < 2400, 'a', 'b') AS source", "repeat('w ', 1000) AS text").cache()
    got = [r.doc_id for r in cp.mix_sources(spark, docs, SF).collect()]
    planned = mixing.mix(docs).orderBy("mix_block", "mix_order").select("doc_id", "mix_block").collect()
    assert len({r.mix_block for r in planned}) == 3 and got == [r.doc_id for r in planned]


def test_last_stage_decodes_every_document(spark):
    docs = spark.createDataFrame([(1, "a", "Plain words."), (2, "a", "é😀  two  blanks"), (3, "b", None)], "doc_id long, source string, text string")
    lib = model(tokenizer("piece_bpe_32k.model")).library
    for r in cp.encode_tokens(spark, docs, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(r.ids).encode()).hexdigest()


def test_registered(spark):
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
@pytest.mark.parametrize("name", ["op4_warc", "op5_vector_dedup", "op6_mixing", "op7_minhash_dedup"])
def test_oracles(spark, name):
    import duckdb

    from tools.oracle_check import _rows

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = entry.queries()[name](spark, sf)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert _rows([tuple(r) for r in got.collect()], got.columns, 0) == _rows(res.fetchall(), cols, 0)
