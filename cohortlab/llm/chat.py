"""Chat formatting: raw transcripts to canonical turns by a hidden Markov model.

Method. A transcript is a sequence of lines. Each line shows a speaker marker (of a role, of nobody known, or none) and
line features: length, a question mark, how it starts, how the line before ended. Hidden states are a role's first line
and its further lines. Start, transition and emission tables are smoothed counts over labelled transcripts, aggregated
by Spark. Viterbi recovers the states, and every run of a turn's lines is rendered as ``<|role|>`` and its text.

Long conversations are cut into segments of ``segment`` source turns. The best score from every entry state to every
exit state of a segment is a small matrix, and matrices combine along a conversation, forwards for scores and backwards
for states; then each segment is decoded between the states at its ends. Those passes stream over sorted rows and keep
one vector, so a conversation of any length is exact and is never gathered.

Defined cases: null text counts as an empty line; rows without a conversation id are a conversation each; rows that
repeat id and turn follow each other by a hash of their text; a null turn comes first; only a marker of the decoded role
is taken off a turn, so an unmarked turn that opens with such a marker's words (an answer 'A) ...') reads as marked; roles that are not known are
written without a marker and do not train; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, cut, text_of

ROLES = ("system", "user", "assistant")
#: Words that name a speaker, by role.
SPEAKERS = {"system": ("system", "instructions", "context"), "user": ("user", "human", "q", "question", "customer"),
            "assistant": ("assistant", "ai", "bot", "a", "answer")}
#: How transcripts write a speaker: the name's place in SPEAKERS and what stands around it.
STYLES = ((0, "", ": "), (1, "### ", ":\n"), (2, "", ") "), (0, "[", "] "), (4, "**", "**: "), (0, "<", "> "))

_MARKER = re.compile(r"\W{0,5}([A-Za-z]+)(?: ?\d+)?\s?(?:[:>\])]|\*\*)+:?\s*").match
_ROLE_OF = {w: r for r, words in SPEAKERS.items() for w in words}


def split_marker(line: str) -> tuple[str, str]:
    """(role, 'other' or '', the rest) of a line that may open with a speaker marker; a small 'a' or 'q' names a list item."""
    m = _MARKER(line)
    if not m or len(m[1]) > 14:
        return "", line
    return "other" if m[1] in ("a", "q") else _ROLE_OF.get(m[1].lower(), "other"), line[m.end():]


def said(line: str, role: str) -> str:
    """A turn's first line without the marker of its role; any other opening is part of the text."""
    marker, rest = split_marker(line)
    return rest if marker == role else line


def symbol(line: str, before: str | None) -> str:
    """The observed symbol of a line, given the line before it."""
    marker, rest = split_marker(line)
    words = len(rest.split())
    return "|".join((marker or "-", str(min(7, words.bit_length())), "?" if rest.rstrip().endswith("?") else ".",
                     "A" if rest[:1].isupper() else "a" if rest[:1].isalpha() else "-",
                     "^" if before is None else "e" if before.rstrip()[-1:] in (".", "!", "?", "") else "m"))


def as_transcript(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  missing: int = 8) -> DataFrame:
    """Turns as the lines of a raw transcript: (conv, turn, role, lines). A conversation has one of STYLES; one turn in
    ``missing`` has lost its marker; both are chosen by hashes."""
    c = F.coalesce(col(conv).cast("string"), F.concat(F.lit("~"), F.xxhash64(col(turn), col(role), text_of(text)).cast("string")))
    style = F.pmod(F.xxhash64(F.lit(3), c), F.lit(len(STYLES)))
    mark = F.lit("")
    for k, (word, a, b) in enumerate(STYLES):
        for r in ROLES:
            names = SPEAKERS[r]
            said = f"{a}{names[min(word, len(names) - 1)].capitalize()}{b}"
            mark = F.when((style == k) & (col(role) == r), F.lit(said)).otherwise(mark)
    mark = F.when(F.pmod(F.xxhash64(F.lit(5), c, col(turn)), F.lit(missing)) == 0, F.lit("")).otherwise(mark)
    return df.select(col(conv).alias("id"), c.alias("conv"), col(turn).cast("long").alias("turn"), col(role).alias("role"),
                     F.split(F.concat(mark, text_of(text)), "\n").alias("lines"))


@dataclass
class RoleModel:
    """Log probabilities over the states (role, first line or further line)."""

    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray]
    unseen: np.ndarray

    def scores(self, lines: list[str], before: str | None) -> np.ndarray:
        seen = [symbol(x, b) for x, b in zip(lines, [before, *lines])]
        return np.array([self.emit.get(s, self.unseen) for s in seen])

    def forward(self, enter: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best score of each state after the lines ``e``, and where it came from; ``enter`` is the score of each state
        on the first line without its emission."""
        back = np.zeros((len(e), len(enter)), np.int8)
        v = enter + e[0]
        for i in range(1, len(e)):
            m = v[:, None] + self.step
            back[i] = m.argmax(axis=0)
            v = m.max(axis=0) + e[i]
        return v, back

    def path(self, enter: np.ndarray, e: np.ndarray, end: int | None = None) -> list[int]:
        v, back = self.forward(enter, e)
        states = [int(v.argmax()) if end is None else end]
        for i in range(len(e) - 1, 0, -1):
            states.append(int(back[i, states[-1]]))
        return states[::-1]


def _place(name: Column, further: Column | bool) -> Column:
    """State number of a role's first or further line."""
    return F.array_position(F.array(*[F.lit(r) for r in ROLES]), name).cast("int") * 2 - 2 + F.lit(further).cast("int")


def fit(transcripts: DataFrame, smoothing: float = 0.5) -> RoleModel:
    """Tables from labelled transcripts (id, conv, turn, role, lines); only counts of states and symbols are collected."""
    known = transcripts.where(F.col("role").isin(*ROLES))

    @F.pandas_udf("array<string>")
    def symbols(lines: pd.Series, before: pd.Series) -> pd.Series:
        return pd.Series([[symbol(x, b) for x, b in zip(own, [last, *own])] for own, last in zip(lines, before)])

    following = known.select("conv", (F.col("turn") + 1).alias("turn"), F.col("role").alias("role0"),
                             F.size("lines").alias("n0"), F.element_at("lines", -1).alias("last"))
    # a turn number that repeats in a conversation has no one predecessor: one of them is taken
    following = following.groupBy("conv", "turn").agg(F.min(F.struct("role0", "n0", "last")).alias("p"))
    pairs = known.join(following, ["conv", "turn"], "left").select("role", "lines", "p")
    tables = cut(pairs.select("role", symbols("lines", "p.last").alias("s"), "p"))
    emits = (tables.select("role", F.posexplode("s").alias("i", "s")).groupBy(_place(F.col("role"), F.col("i") > 0).alias("state"), "s").count())
    n = 2 * len(ROLES)
    emit: dict[str, np.ndarray] = {}
    for r in emits.collect():  # states times symbols, whatever the corpus
        emit.setdefault(r["s"], np.zeros(n))[r["state"]] += r["count"]
    size = F.size("s")
    inner = tables.groupBy("role").agg(F.sum((size > 1).cast("long")).alias("bi"), F.sum(F.greatest(size - 2, F.lit(0)).cast("long")).alias("ii"),
                                       F.sum(F.col("p").isNull().cast("long")).alias("first")).collect()
    outer = tables.where("p IS NOT NULL").groupBy(_place(F.col("p.role0"), F.col("p.n0") > 1).alias("a"), _place(F.col("role"), False).alias("b")).count().collect()
    start, step = np.full(n, 1e-6), np.full((n, n), 1e-6)
    for r in inner:
        k = 2 * ROLES.index(r["role"])
        start[k] += r["first"] + smoothing
        step[k, k + 1] += r["bi"] + smoothing
        step[k + 1, k + 1] += r["ii"] + smoothing
    for r in outer:
        step[r["a"], r["b"]] += r["count"] + smoothing
    total = sum(emit.values(), np.zeros(n)) + smoothing * (len(emit) + 1)
    return RoleModel(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)),
                     {s: np.log((c + smoothing) / total) for s, c in emit.items()}, np.log(smoothing / total))


def _runs(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    held = None
    for pdf in frames:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if len(pdf):
            cuts = np.flatnonzero((pdf[by] != pdf[by].shift()).any(axis=1))
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield pdf.iloc[a:b]
            held = pdf.iloc[cuts[-1]:]
    if held is not None and len(held):
        yield held


def parse(transcripts: DataFrame, model: RoleModel, segment: int = 512) -> DataFrame:
    """(id, start_turn, start_line, role, continues, source_role, text, rendered): a row for each recovered turn, or for
    each segment's part of one (``continues``: the part goes on from the segment before)."""
    n = 2 * len(ROLES)
    turns = transcripts.withColumn("seg", F.floor(F.coalesce("turn", F.lit(0)) / F.lit(segment)).cast("long"))
    spans = turns.groupBy("conv").agg(F.min("seg").alias("low"), F.max("seg").alias("high"))
    long = spans.where("low < high").select("conv")

    def ordered(df: DataFrame, *by: str) -> DataFrame:
        return df.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by, F.col("turn").asc_nulls_first(), F.xxhash64("lines"))

    # the last line before every segment of a long conversation, and the matrix of every segment
    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _runs(frames, ["conv", "seg"]):
            lines = [x for part in pdf["lines"] for x in part]
            out, last = [], lines[-1]
            for before in (None, "x.", "x"):  # what the line before may be: none, a closed or an open one
                e = model.scores(lines, before)
                rows = [model.forward(model.start, e)[0]] if before is None else [model.forward(model.step[i], e)[0] for i in range(n)]
                out.append([float(x) for row in rows for x in row])
            yield pd.DataFrame({"conv": [pdf["conv"].iloc[0]], "seg": [pdf["seg"].iloc[0]], "opening": [out[0]], "after_end": [out[1]],
                                "after_mid": [out[2]], "ended": [symbol("", last).endswith("e")]})

    steps = cut(ordered(turns.join(long, "conv", "left_semi").select("conv", "seg", "turn", "lines"), "conv", "seg")
                .mapInPandas(matrices, "conv string, seg long, opening array<double>, after_end array<double>, after_mid array<double>, ended boolean"))

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, v, ended = None, None, False
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                new = r.conv != conv
                m = None if new else np.array(r.after_end if ended else r.after_mid).reshape(n, n)
                rows.append((r.conv, r.seg, [] if new else v.tolist(), [] if new else m.ravel().tolist(), ended and not new,
                             r.opening if new else None))
                v = np.array(r.opening) if new else (v[:, None] + m).max(axis=0)
                v, conv, ended = v - v.max(), r.conv, r.ended
            yield pd.DataFrame(rows, columns=["conv", "seg", "enter", "matrix", "ended", "opening"])

    def leave(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, end = None, 0
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                first = not len(r.enter)
                total = np.array(r.opening)[None, :] if first else np.array(r.enter)[:, None] + np.array(r.matrix).reshape(n, n)
                if r.conv != conv:
                    end = int(total.max(axis=0).argmax())
                come = -1 if first else int(total[:, end].argmax())
                rows.append((r.conv, r.seg, come, end, r.ended))
                conv, end = r.conv, come
            yield pd.DataFrame(rows, columns=["conv", "seg", "come", "end", "ended"])

    entered = (steps.repartition("conv").sortWithinPartitions("conv", "seg")
               .mapInPandas(enter, "conv string, seg long, enter array<double>, matrix array<double>, ended boolean, opening array<double>"))
    ends = (entered.repartition("conv").sortWithinPartitions(F.col("conv"), F.col("seg").desc())
            .mapInPandas(leave, "conv string, seg long, come int, `end` int, ended boolean"))

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _runs(frames, ["conv", "seg"]):
            lines = [x for part in pdf["lines"] for x in part]
            where = [(t, i, r) for t, r, part in zip(pdf["turn"], pdf["role"], pdf["lines"]) for i in range(len(part))]
            come, end, ended = pdf["come"].iloc[0], pdf["end"].iloc[0], pdf["ended"].iloc[0]
            inner = not pd.isna(come) and come >= 0
            e = model.scores(lines, ("x." if ended else "x") if inner else None)
            path = model.path(model.step[int(come)] if inner else model.start, e, None if pd.isna(end) else int(end))
            rows = []
            for i, s in enumerate(path):
                if s % 2 == 0 or i == 0:
                    rows.append([*where[i], s // 2, s % 2 == 1, []])
                rows[-1][5].append(said(lines[i], ROLES[s // 2]) if s % 2 == 0 else lines[i])
            texts = ["\n".join(r[5]).strip("\n") for r in rows]
            yield pd.DataFrame({"id": pdf["id"].iloc[0], "start_turn": pd.array([r[0] for r in rows], "Int64"), "start_line": [r[1] for r in rows],
                                "role": [ROLES[r[3]] for r in rows], "continues": [r[4] for r in rows], "source_role": [r[2] for r in rows],
                                "text": texts, "rendered": [f"{t}\n" if r[4] else f"<|{ROLES[r[3]]}|>\n{t}\n" for r, t in zip(rows, texts)]})

    kind = transcripts.schema["id"].dataType.simpleString()
    return (ordered(turns.join(ends, ["conv", "seg"], "left"), "conv", "seg").select("id", "conv", "seg", "turn", "role", "lines", "come", "end", "ended")
            .mapInPandas(decode, f"id {kind}, start_turn long, start_line int, role string, continues boolean, source_role string, "
                                 "text string, rendered string"))
