import random
import re

import pytest

from cohortlab.llm.pii import base_spans, find_mentions, find_personal, mentions, redact, score_patterns
from llm_samples import ODD


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_against_the_patterns():
    rng = random.Random(5)
    for signs in ("a1@.+ -()4x%é\n", "0123456789 -", "+12 ().-3", "255.10"):
        for _ in range(4000):
            t = "".join(rng.choice(signs) for _ in range(rng.choice([4, 10, 25, 60])))
            assert base_spans(t) == brute(t), t
    assert base_spans("pay 4111 1111-1111 1111 now") == [("card", 4, 23)]


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000):
        base_spans(t)


@pytest.fixture(scope="module")
def contexts(spark):
    rows = [(i, f"well then mail bob{i}@site.org today and member number 41{i:02d}-77 joins") for i in range(40)]
    rows += [(100 + i, f"well then mail code{i}{i}{i} today or never") for i in range(3)]
    rows += [(200 + i, f"chapter {i}00 of the book") for i in range(10)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_of_seeds_find_unseen_identifiers(spark, contexts):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in find_personal(contexts).collect()}
    assert all([k for k, _, _ in got[i]] == ["email"] for i in range(40))
    assert all([k for k, _, _ in got[100 + i]] == ["context"] for i in range(3))
    assert all(got[200 + i] == [] for i in range(10))


def scored(rows, rounds, least=0.8, seeds=3):
    """Confidence and trusted instances of every pattern by plain loops over (instance, seed, pattern, others)."""
    first = {i for i, s, _, _ in rows if s}
    trust, names = {i: 1.0 for i in first}, {p for _, _, p, _ in rows}
    for k in range(rounds):
        conf = {p: sum(trust.get(i, 0.0) for i, _, q, _ in rows if q == p) / (sum(1 + o for _, _, q, o in rows if q == p) + 2.0) for p in names}
        many = {p: len({i for i, _, q, _ in rows if q == p and i in trust}) for p in names}
        if k + 1 < rounds:
            good = {p for p in names if conf[p] >= least and many[p] >= seeds}
            trust = {i: 1.0 for i in first}
            for i, _, p, _ in rows:
                if i not in first and p in good:
                    trust[i] = max(trust.get(i, 0.0), conf[p])
    return {p: (conf[p], many[p]) for p in names}


def test_scores_against_brute_force(spark, contexts):
    from pyspark.sql import functions as F

    rows = [(500 + i, f"use grade x{i}77 please") for i in range(4)] + [(600 + i, f"well then mail x{i}77 as {'well then mail ' * i}") for i in range(4)]
    df = contexts.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = find_mentions(df, "text", [F.col("doc_id")])
    rows = [(r.instance, r.seed, p, o) for r in found.collect() for p, o in zip(r.patterns, r.others)]
    for rounds in (1, 2, 4):
        want = scored(rows, rounds)
        got = {r.pattern: (r.confidence, r.seeds) for r in score_patterns(found, rounds).collect()}
        assert got.keys() == want.keys() and all(abs(got[p][0] - want[p][0]) < 1e-9 and got[p][1] == want[p][1] for p in want)


def test_promoted_instances_are_seeds_of_the_next_turn(spark):
    """Base seeds give 'mail'; the codes that it finds stand after 'badge' too, and that finds codes which no seed's pattern knows."""
    rows = [(i, f"well then mail bob{i}@site.org today") for i in range(200)]
    rows += [(1000 + i, f"well then mail QX-{i}12{i}/7 today and later badge QX-{i}12{i}/7 shown") for i in range(30)]
    rows += [(2000 + i, f"some badge W.{i}9.{i}9 here") for i in range(2)] + [(3000 + i, f"page {i}00 of it") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = lambda rounds: {r.doc_id: [s.kind for s in r.spans] for r in find_personal(df, rounds=rounds, confidence=0.7).collect()}
    one, three = kinds(1), kinds(3)
    assert all("context" in one[1000 + i] for i in range(30)) and all(one[2000 + i] == [] for i in range(2))
    assert all(three[2000 + i] == ["context"] for i in range(2)) and all(three[3000 + i] == [] for i in range(5))


def test_common_words_are_no_patterns(spark):
    """A word that seeds follow often, but ordinary words far more often, finds nothing."""
    text = "the the the the the the the the "
    rows = [(i, f"{text}the bob{i}@site.org {text}") for i in range(50)] + [(100 + i, f"{text}the 55{i}55{i} {text}") for i in range(5)]
    got = {r.doc_id: [s.kind for s in r.spans] for r in find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == ["email"] for i in range(50)) and all(got[100 + i] == [] for i in range(5))


def test_fields_of_compact_records(spark):
    rows = [(1, '{"ip":"1.2.3.4","acct":"AB123456","n":"1000"}'), (2, 'token="9f3ac1774b",x=1;password = zz991z'), (3, "q" * 300 + "=12345")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, dict(rows)[r.doc_id][s.start:s.end]) for s in r.spans] for r in find_personal(df).collect()}
    assert got == {1: [("ip", "1.2.3.4"), ("context", "AB123456")], 2: [("context", "9f3ac1774b"), ("context", "zz991z")], 3: []}


def test_long_words_do_not_merge():
    a, b = "k" * 100 + "a 12345", "k" * 100 + "b 12345"
    assert {p for m in mentions(a) for p in m[5] if p[0] == "L"} != {p for m in mentions(b) for p in m[5] if p[0] == "L"}


def test_redaction_and_odd_rows(spark, odd, none):
    more = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (1, "c@d.co and 1.2.3.4"), (None, "x@y.zz"), (5, None)], "doc_id long, text string")
    rows = sorted((r.text, len(r.spans)) for r in redact(find_personal(more)).where("text is not null").collect())
    assert rows == [("[EMAIL]", 1), ("[EMAIL]", 1), ("[EMAIL]", 1), ("[EMAIL] and [IP]", 2)]
    out = find_personal(odd)
    assert out.columns == [*odd.columns, "spans"] and out.count() == len(ODD)
    assert redact(find_personal(none)).count() == 0
    assert find_personal(odd.withColumnRenamed("score_", "Spans")).columns == [*odd.columns[:-1], "Spans_in", "spans"]
