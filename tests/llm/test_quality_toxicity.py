import os
import zlib

import numpy as np
import pytest

from cohortlab.llm import quality, toxicity
from cohortlab.llm.common import crc_mod, table

from llm_samples import ODD, SF, needs_data

BIG = "/root/testdata/sf0.1"


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x[:2000], y[:2000], rounds=20)
    assert ((m.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9 and (0, 1) in m.pairs


@needs_data
def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    m = quality.train(docs, labels, crc_mod("doc_id", 4) != 2)
    rows = quality.score(docs, m).join(labels, "doc_id").where(crc_mod("doc_id", 4) == 2).select("score", "quality").collect()
    assert rows and np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) >= 0.9


def test_quality_of_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (None, 1), (9, 0), (4, 0), (10, 1)], "doc_id long, quality int")
    m = quality.train(odd, labels, crc_mod("doc_id", 4) >= 0)
    rows = quality.score(odd, m).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    blank = quality.train(none, labels, crc_mod("doc_id", 4) >= 0)
    assert {r.score for r in quality.score(odd, blank).collect()} == {0.5}
    assert quality.score(none, m).count() == 0


def test_misspellings_share_vectors():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(300)]
    bad = [t.split() for t in texts[:100]]
    for i, t in enumerate(bad):
        t[7] = ["xylozorp", "xylozorps", "xylozorpy"][i % 3]
    m = toxicity.fit([" ".join(t) for t in bad] + texts[100:250], np.array([1.0] * 100 + [0.0] * 150))
    unseen = [" ".join([*t.split()[:30], "xylozorpen", *t.split()[30:]]) for t in texts[250:]]
    assert (m.predict(unseen) >= 0.5).mean() > 0.9 and (m.predict(texts[250:]) < 0.5).mean() > 0.9


def test_nul_characters_within_texts_part_words_only():
    texts = ["aa\0bb cc dd\0", "ee ff", "gg hh", "\0ii jj", "kk\0\0ll mm"]
    blank = [t.replace("\0", " ") for t in texts]
    m = toxicity.SubwordModel(np.random.default_rng(3).normal(size=toxicity.BUCKETS).astype(np.float32), 0.1)
    assert m.predict(texts).tolist() == m.predict(blank).tolist() == [m.predict([t])[0] for t in blank]
    marked = [f"{t} bad" if i % 2 else t for i, t in enumerate(texts * 20)]
    y = np.array([float(i % 2) for i in range(len(marked))])
    assert (toxicity.fit(marked, y).table == toxicity.fit([t.replace("\0", " ") for t in marked], y).table).all()


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (5, 1), (6, None), (None, 1), (9, 0), (10, 0)], "doc_id long, toxic int")
    m = toxicity.train(odd, labels, crc_mod("doc_id", 5) >= 0)
    rows = toxicity.score(odd, m).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    blank = toxicity.train(none, labels, crc_mod("doc_id", 5) >= 0)
    assert all(r.score < 0.01 for r in toxicity.score(odd, blank).collect())
    assert toxicity.score(none, m).count() == 0


@pytest.mark.skipif(not os.path.isdir(BIG), reason="driver test data not present")
def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels").where("toxic IS NOT NULL")
    m = toxicity.train(docs, labels, crc_mod("doc_id", 5) != 0, train_rows=1500)
    rows = toxicity.score(docs.join(labels, "doc_id").where(crc_mod("doc_id", 5) == 0), m).select("doc_id", "score", "toxic").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    hit = [r.score >= 0.5 for r in rows if r.toxic == 1]
    clean = [r.score < 0.5 for r in rows if r.toxic == 0]
    assert np.mean(hit) > 0.85 and np.mean(clean) > 0.93


def test_neutral_words_in_front_do_not_change_a_window():
    """Windows start at every word: a phrase scores alike wherever it stands, also across the pieces of a very long text."""
    rng = np.random.default_rng(3)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    plain = [" ".join(rng.choice(words, 60)) for _ in range(160)]
    bad = [p + " you utter blockhead scum " + " ".join(rng.choice(words, 30)) for p in plain[:60]]
    model = toxicity.fit(plain[60:] + bad, np.array([0] * 100 + [1] * 60))
    phrase = "you utter blockhead scum"
    alone = model.predict([phrase])[0]
    assert alone > 0.5
    for before in range(8):
        assert model.predict([" ".join(words[:before]) + " " + phrase + " " + " ".join(words[5:9])])[0] >= alone - 1e-9
    long = ("x " * 250_000)[:-len(phrase) // 2 - 1]
    assert toxicity.WINDOW == 4 and model.predict([long + " " + phrase + " y" * 300_000])[0] >= alone - 1e-9


def test_windows_of_short_and_long_texts():
    first, end = toxicity.windows(np.array([0, 0, 1, 2, 2, 2, 2, 2]), 4)
    assert list(zip(first.tolist(), end.tolist())) == [(0, 2), (2, 3), (3, 7), (4, 8)]
    assert [len(x) for x in toxicity.windows(np.zeros(0, np.int64), 4)] == [0, 0]


def test_long_documents_do_not_take_the_places_of_short_ones(spark):
    rows = [(i, "long " * 200 if i < 30 else f"kind words {i}" if i % 2 else f"vile scum {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, toxic int")
    seen = []
    from unittest import mock

    with mock.patch.object(toxicity, "fit", lambda t, y: seen.append((t, y))):
        toxicity.train(docs, labels, labels.doc_id >= 0, train_rows=20, train_chars=100)
    texts, y = seen[0]
    assert len(texts) == 20 and sum(y) == 10 and not any("long" in t for t in texts)
