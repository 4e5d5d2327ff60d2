import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.llm import chat


def talks(n, turns, seed=1):
    rng = random.Random(seed)
    words = ["some", "plain", "words", "and", "then", "more", "of", "them"]
    out = []
    for c in range(n):
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            k, lines = (3, 1) if role == "user" else (25, 3)
            text = "\n".join(" ".join(rng.choices(words, k=k + rng.randrange(6))).capitalize() + ("?" if role == "user" else ".") for _ in range(lines))
            out.append((c, t, role, text))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return chat.fit(chat.as_transcript(spark.createDataFrame(talks(200, 8), "conv_id long, turn long, role string, text string")))


def test_markers():
    assert chat.split_marker("### Human:") == ("user", "") and chat.split_marker("[User] hi") == ("user", "hi")
    assert chat.split_marker("**AI**: yes") == ("assistant", "yes") and chat.split_marker("Bob: hi") == ("other", "hi")
    assert chat.split_marker("plain line") == ("", "plain line") and chat.split_marker("") == ("", "")


def test_only_the_marker_of_the_role_is_taken_off():
    assert chat.said("User: hi", "user") == "hi" and chat.said("A: yes", "assistant") == chat.said("[Bot] yes", "assistant") == "yes"
    for line in ("Note: hi", "Step 2: hi", "**Bold** text", "- item: hi", "a) first", "User: hi", "plain"):
        assert chat.said(line, "assistant") == line


def test_unmarked_turns_keep_their_openings(spark, model):
    openings = ["Note: ", "Step 2: ", "**Bold** ", "- item: ", "a) ", "PS> ", ""]
    rows = [(c, t, role, openings[(c + t) % 7] + text) for c, t, role, text in talks(14, 6, seed=3)]
    raw = chat.as_transcript(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), missing=1)
    got = {}
    for r in sorted(chat.parse(raw, model).collect(), key=lambda r: (r.id, r.start_turn, r.start_line)):
        assert r.rendered == f"<|{r.role}|>\n{r.text}\n"
        got.setdefault(r.id, []).append(r.text)
    assert {c: "\n".join(t) for c, t in got.items()} == {c: "\n".join(x[3] for x in rows if x[0] == c) for c in range(14)}


def test_viterbi_is_the_best_of_all_paths(model):
    from itertools import product

    lines = ["User: what?", "And more of it.", "", "Some long answer of plain words and then more of them."]
    e = model.scores(lines, None)
    score = lambda p: model.start[p[0]] + e[0][p[0]] + sum(model.step[a, b] + e[i + 1][b] for i, (a, b) in enumerate(zip(p, p[1:])))
    best = max(product(range(6), repeat=len(lines)), key=score)
    assert score(model.path(model.start, e)) == pytest.approx(score(best))


def test_roles_come_back(spark, model):
    raw = chat.as_transcript(spark.createDataFrame(talks(60, 8, seed=9), "conv_id long, turn long, role string, text string"))
    rows = chat.parse(raw, model).collect()
    right = np.mean([r.role == r.source_role and r.start_line == 0 for r in rows])
    assert right > 0.9 and all(r.rendered == f"<|{r.role}|>\n{r.text}\n" for r in rows)


def test_segments_give_the_same_as_one_pass(spark, model):
    raw = chat.as_transcript(spark.createDataFrame(talks(3, 90, seed=5), "conv_id long, turn long, role string, text string")).cache()
    whole = {(r.id, r.start_turn, r.start_line): r.role for r in chat.parse(raw, model).collect()}
    cut = {(r.id, r.start_turn, r.start_line): r.role for r in chat.parse(raw, model, segment=7).collect() if not r.continues}
    assert whole == cut


def test_odd_rows(spark, model):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, ""), (None, 0, "user", "alone"), (None, 0, "user", "alone too"),
            (2, 5, "tool", "x " * 20_000), (2, 5, "assistant", "tie\n\n\n"), (3, -4, "system", "\n" * 50)]
    df = spark.createDataFrame([(*r, "u") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    raw = chat.as_transcript(df)
    got = chat.parse(raw, model).collect()
    assert {r.id for r in got} == {1, 2, 3, None} and sum(r.id is None for r in got) == 2
    assert chat.parse(raw.where(F.col("id") == 9), model).count() == 0
    empty = chat.fit(raw.where(F.col("id") == 9))
    assert chat.parse(raw, empty).count() >= 4
