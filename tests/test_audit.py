"""The audit's checks on tables with known faults."""

from cohortlab.operators.audit import Direction, run_audit

SCHEMA = "id long, a double, s string, CDR double"


def status(spark, original, enhanced, **more):
    args = dict(key="id", check_columns=["a", "s"], label="CDR", directions=[Direction("v", "greater")], spot_ids=[1, 2], spot_equal=["a"], spot_present=["v"])
    return {r.check_id: (r.status, r.n_issues) for r in run_audit(original, enhanced, **(args | more)).collect()}


def test_faults_are_counted(spark):
    original = spark.createDataFrame([(1, 1.0, "x", 0.0), (2, 2.0, None, 1.0), (3, 3.0, "z", None), (4, 4.0, "w", 0.0), (None, 5.0, "n", 0.0)], SCHEMA)
    good = spark.createDataFrame([(1, 1.0, "x", 0.0, 9.0, None), (2, 2.0, "", 1.0, 3.0, None), (3, 3.0, "z", None, 4.0, None), (4, 4.0, "w", 0.0, 8.0, None),
                                  (None, 5.0, "n", 0.0, 8.0, None)], SCHEMA + ", v double, empty double")
    got = status(spark, original, good)
    assert got == {1: ("PASS", 0), 2: ("FAIL", 1), 3: ("PASS", 0), 4: ("WARN", 1), 5: ("PASS", 0), 6: ("PASS", 1), 7: ("PASS", 0), 8: ("PASS", 0), 9: ("NOT READY", 1)}
    bad = spark.createDataFrame([(1, 1.5, "x", 0.0, None, "g"), (1, 1.0, "x", 0.0, None, "g"), (2, 2.0, "q", 1.0, 3.0, "g"), (9, 3.0, "z", None, 4.0, "g")], SCHEMA + ", v double, Group string")
    got = status(spark, original.where("id IS NOT NULL"), bad)
    # 3 and 4 are missing, 9 is extra, 1 repeats; a of 1 and s of 2 differ; 1 fails the spot check
    assert got[1] == ("PASS", 0) and got[2] == ("FAIL", 4) and got[3] == ("FAIL", 2) and got[5] == ("FAIL", 1) and got[7] == ("FAIL", 1) and got[8] == ("FAIL", 1)


def test_two_actions(spark, monkeypatch):
    """Two results are read from the tables, however many checks there are."""
    original = spark.createDataFrame([(1, 1.0, "x", 0.0)], SCHEMA)
    enhanced = spark.createDataFrame([(1, 1.0, "x", 0.0, 2.0)], SCHEMA + ", v double")
    calls, kind = [], type(original)
    real = kind.first
    monkeypatch.setattr(kind, "first", lambda self: calls.append(1) or real(self))
    status(spark, original, enhanced)
    assert len(calls) == 2


def test_a_hot_key_makes_no_pairs(spark):
    many = spark.range(60_000).selectExpr("0L AS id", "1.0D AS a", "'x' AS s", "0.0D AS CDR", "1.0D AS v")
    got = status(spark, many.drop("v"), many, directions=[], spot_ids=[0])
    assert got[2] == ("FAIL", 59_999) and got[3] == ("PASS", 0) and got[7] == ("FAIL", 1)
