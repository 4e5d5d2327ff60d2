import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cohortlab.llm.common import tokenizer
from cohortlab.llm.sentencepiece_codec import encode_decode, model

from llm_samples import ODD

PATH = tokenizer("piece_bpe_32k.model")


def test_codec_equals_the_library_on_random_texts():
    m, rng = model(PATH), random.Random(3)
    signs = "aeéthn \n\t  ▁▁0123<s>/üñ中文😀\x00\r&$*"
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 5, 30, 300]))) for _ in range(1500)]
    texts += ["the" * 3000, " " * 5000, "\n" * 300, "▁" * 99]
    for text, got in zip(texts, m.encode(texts)):
        want = m.library.encode(text)
        assert got.tolist() == want, text[:80]
        assert m.decode(got) == m.library.decode(want)


def test_decode_of_any_ids_equals_the_library():
    m, rng = model(PATH), random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(259, 32000) for _ in range(rng.randrange(20))]
        assert m.decode(ids) == m.library.decode(ids)


def test_the_table_of_units_may_overflow():
    from cohortlab.llm.sentencepiece_codec import MergeModel

    small, texts = MergeModel(PATH, memo=20), [f"word{i} and other{i * 7} things" for i in range(300)]
    assert [g.tolist() for g in small.encode(texts)] == small.library.encode(texts)


def test_odd_rows(odd):
    rows = encode_decode(odd, PATH, check_every=1).collect()
    assert len(rows) == len(ODD)
    lib = model(PATH).library
    for r in rows:
        assert r.ids == lib.encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ") and r.score_.startswith("kept")


def test_empty_table_and_taken_name(none, odd):
    assert encode_decode(none, PATH).count() == 0
    with pytest.raises(ValueError):
        encode_decode(odd, PATH, ids="TEXT")


def test_every_distinct_text_is_held_against_the_library(monkeypatch):
    class Rows:  # gives the function that Spark would run on Arrow batches
        columns, schema = ["text"], T.StructType([T.StructField("text", T.StringType())])
        mapInArrow = staticmethod(lambda run, schema: run)

    texts = [f"text number {i} \0 with words" for i in range(40)]
    batch = lambda t: iter([pa.RecordBatch.from_arrays([pa.array([t, t])], names=["text"])])
    run = encode_decode(Rows, PATH)
    assert all(b.num_rows == 2 for t in texts for b in run(batch(t)))
    monkeypatch.setattr(type(model(PATH)), "decode_all", lambda self, ids, ends: ["wrong"] * len(ends))
    for t in texts:
        with pytest.raises(RuntimeError):
            list(run(batch(t)))
