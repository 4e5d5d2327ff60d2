"""Dictionaries of any size, places in an order, and preparation fitted on all rows or on the training rows."""

import pytest
from pyspark.sql import functions as F

from cohortlab.operators import encode, prepare
from cohortlab.operators.ranks import numbered


def test_dictionary_of_many_values(spark):
    n = 150_000
    df = spark.range(n).select("id", F.concat(F.lit("v"), F.lpad(((F.col("id") * 7) % n).cast("string"), 6, "0")).alias("many"),
                               F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 3 == 1, "a").alias("few"))
    fitted = encode.fit_label_encoder(df, ["many", "few"])
    out = encode.apply_label_encoder(df, fitted, ["many", "few"])
    assert "array(" not in out._jdf.queryExecution().optimizedPlan().toString()
    row = out.agg(F.count("*").alias("n"), F.sum((F.col("many") == (F.col("id") * 7) % n).cast("int")).alias("same"),
                  F.sum((F.col("few") == F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 0)).cast("int")).alias("few"),
                  F.count_if(F.col("few").isNull()).alias("none")).first()
    assert tuple(row) == (n, n, n * 2 // 3, n // 3) and fitted.count() == n + 2


def test_unseen_values_and_odd_names(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "`the col` string")
    b = spark.createDataFrame([("y", 1), ("z", 2), (None, 3)], "`the col` string, n int")
    fitted = encode.fit_label_encoder(a, ["the col"])
    assert sorted(map(tuple, encode.apply_label_encoder(b, fitted, ["the col"], unseen=-1).collect())) == [(-1, 2), (-1, 3), (1, 1)]
    assert encode.fit_label_encoder(a.where("false"), ["the col"]).count() == 0


def test_places_in_an_order(spark):
    rows = [(g, (i * 37) % 101 if i % 10 else None, i) for g in (None, "a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(9)
    got = {}
    for r in numbered(df, ["g"], ["v", "i"]).collect():
        got.setdefault(r.g, {})[r.place] = (r.v is not None, r.v or 0, r.i)
    for g, places in got.items():
        assert sorted(places) == list(range(300)) and [places[k] for k in range(300)] == sorted(places.values())
    assert set(got) == {None, "a", "b"}


def frame(spark):
    rows = [(f"S{i:03d}_MR{1 + (i % 10 == 9)}", f"P{i // 2:03d}", "M" if i % 3 else "F", None if i % 7 == 0 else float(i % 20) + (1000 if i == 3 else 0),
             None if i % 11 == 0 else float(i % 2)) for i in range(200)]
    return spark.createDataFrame(rows, "ID string, Subject_ID string, sex string, v double, CDR double")


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_where_the_fits_come_from(spark, fit_on):
    df = frame(spark)
    p = prepare.prepare(df, fit_on=fit_on)
    data = {r.ID: r for r in p.data.collect()}
    train = [r for r in df.collect() if r.ID in data and data[r.ID].split == "train"]
    import statistics

    seen = [r.v for r in (train if fit_on == "train" else df.collect()) if r.v is not None]
    assert p.fill["v"] == statistics.median(seen) and ("CDR" in p.fill) == (fit_on == "all")
    assert {r["value"]: r["code"] for r in p.dictionary.collect()} == {"F": 0, "M": 1}
    by_subject = {}
    for r in p.data.collect():
        by_subject.setdefault(r.Subject_ID, set()).add(r.split)
    assert all(len(s) == 1 for s in by_subject.values()) and all(not i.endswith("MR2") for i in data)
    filled = [r.v if r.v is not None else p.fill["v"] for r in train]
    assert p.moments["v"][0] == pytest.approx(sum(filled) / len(filled))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        prepare.prepare(frame(spark), fit_on="test")


def test_two_models_take_one_preparation(spark, monkeypatch):
    from cohortlab.plans import q_prep, q_scoring
    import os

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("driver test data not present")
    calls, real = [], q_prep._prepared
    monkeypatch.setattr(q_prep, "_prepared", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert q_scoring.x4_two_model_comparison(spark, "/root/testdata/sf0.001").columns
    assert len(calls) == 1
