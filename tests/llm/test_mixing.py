import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortlab.llm.mixing import mix, word_tokens
from llm_samples import ODD


def docs(spark, sizes):
    rows = [(k * 1000 + i, s, "w " * (5 + (i * 7) % 40)) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def token_sums(df):
    return {r.source: r.n for r in df.groupBy("source").agg(F.sum(word_tokens("text")).alias("n")).collect()}


def entropy(sums):
    total = sum(sums.values())
    return -sum(v / total * math.log(v / total) for v in sums.values() if v)


def test_entropy_and_whole_epochs(spark):
    src = docs(spark, {"a": 900, "b": 90, None: 60})
    have = token_sums(src)
    out = mix(src, target_entropy=0.9, max_repeat=None, buckets=16).cache()
    got = token_sums(out)
    assert abs(sum(got.values()) - sum(have.values())) <= 3 * 60 * 3
    assert entropy(got) / math.log(3) == pytest.approx(0.9, abs=0.02) and entropy(have) / math.log(3) < 0.7
    copies = defaultdict(list)
    for r in out.collect():
        copies[r.source].append((r.doc_id, r.mix_epoch))
    for source, rows in copies.items():
        assert len(rows) == len(set(rows))  # a document stands once in an epoch
        last = max(e for _, e in rows)
        ids = {d for d, _ in rows}
        for e in range(last):  # all epochs but the last are whole
            assert {d for d, x in rows if x == e} == {r.doc_id for r in src.where(F.col("source").eqNullSafe(F.lit(source))).collect()}
        assert ids >= {d for d, e in rows if e == last}


def test_repetition_limit_wins(spark):
    src = docs(spark, {"a": 900, "b": 30})
    have, got = token_sums(src), token_sums(mix(src, target_entropy=1.0, max_repeat=2.0, buckets=16))
    assert got["b"] / have["b"] == pytest.approx(2.0, abs=0.1)
    plain = mix(src, target_entropy=None, max_repeat=None, buckets=16)
    assert plain.count() == 930 and plain.where("mix_epoch > 0").count() == 0


def test_blocks_hold_the_sources_in_proportion(spark):
    out = mix(docs(spark, {"a": 800, "b": 400}), target_entropy=None, buckets=256, block_tokens=7000)
    rows = out.groupBy("mix_block").agg(F.avg((F.col("source") == "a").cast("int")).alias("a"), F.count("*").alias("n")).collect()
    assert len(rows) > 2 and all(0.5 < r.a < 0.85 for r in rows)


def test_odd_rows_and_names(odd, none):
    out = mix(odd, target_entropy=None)
    assert out.columns == [*odd.columns, "mix_epoch", "mix_block", "mix_order"] and out.count() == len(ODD)
    assert mix(none).count() == 0
    clash = mix(odd.withColumn("MIX_EPOCH", F.lit(7)), target_entropy=None)
    assert clash.columns == [*odd.columns, "MIX_EPOCH_in", "mix_epoch", "mix_block", "mix_order"] and clash.where("MIX_EPOCH_in <> 7").count() == 0


@pytest.mark.parametrize("blocks", [10, 100, 700])
def test_every_block_gets_its_quota(spark, blocks):
    """Of every source, each block holds its budgeted tokens, give or take a document, whatever the number of blocks."""
    sizes = {f"s{i}": 2200 if i == 0 else 700 + 60 * i for i in range(8)}
    src = docs(spark, sizes)
    total = sum(token_sums(src).values())
    out = mix(src, target_entropy=0.99, buckets=32, block_tokens=math.ceil(total / blocks)).withColumn("n", word_tokens("text"))
    runs = token_sums(out)
    got = out.groupBy("mix_block", "source").agg(F.sum("n").alias("n")).collect()
    blocks = math.ceil(total / math.ceil(total / blocks))
    share = {(r.mix_block, r.source): r.n for r in got}
    assert {b for b, _ in share} == set(range(blocks))
    for b in range(blocks):
        assert all(abs(share.get((b, s), 0) - runs[s] / blocks) <= 2 * 45 for s in sizes)
        assert abs(sum(share.get((b, s), 0) for s in sizes) - sum(runs.values()) / blocks) <= 8 * 45


def test_equal_rows_and_ties_of_places(spark):
    rows = [(1, "a", "one two")] * 5 + [(2, "a", "")] * 3 + [(None, "b", "x y z")] * 4
    out = mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), target_entropy=None)
    assert out.count() == 12 and {r.mix_block for r in out.collect()} == {0}
