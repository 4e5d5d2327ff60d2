"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Method. A text is normalised as the model says (blanks become U+2581, one is put in front) and cut where no
piece of the vocabulary can span: before a blank that follows another character, and around line feeds. Within
a unit an agenda holds the adjacent symbol pairs whose union is a piece, by score; the pair with the best score,
leftmost on ties, is merged until none is left. Symbols that are not pieces become byte pieces. The short units
of an Arrow batch work off their agendas together, one row of a numpy matrix each; long units keep theirs in a
heap, so a unit of any length costs n log n. Units repeat, so each Python worker keeps a bounded table of solved
units.

The distinct texts of every Arrow batch (or the share ``check_every`` of them) are encoded and decoded by the
sentencepiece library as well; a difference raises an error that names the row.

Defined cases: null text counts as empty; the empty text has no ids and decodes to itself; ids of null are empty.
Extra columns pass through; the results' names must not be taken.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLANK = "▁"
NEVER, NONE = np.int32(2**31 - 1), 2**16 - 1
#: Characters of texts that are worked off together, and units in a matrix.
CHARS, ROWS = 2_000_000, 16_384


class MergeModel:
    """Pieces, scores and byte pieces of one model file, and the codec over them."""

    def __init__(self, model_path: str, memo: int = 500_000, memo_chars: int = 48):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        normal, self.bytes = {}, [-1] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                normal[piece] = i
        self.ids, self.unk = normal, lib.unk_id()
        # equal scores share a rank: ties are broken by place alone
        order = {s: r for r, s in enumerate(sorted({lib.get_score(i) for i in normal.values()}, reverse=True))}
        self.rank = {p: order[lib.get_score(i)] for p, i in normal.items() if len(p) > 1}
        if any(x != BLANK and y == BLANK for p in self.rank for x, y in zip(p, p[1:])):
            raise ValueError("a piece of this vocabulary spans a word boundary")
        self.lines_part = not any("\n" in p for p in self.rank)
        surface = [b""] * lib.get_piece_size()
        for p, i in normal.items():
            surface[i] = p.replace(BLANK, " ").encode()
        for v, i in enumerate(self.bytes):
            if i >= 0:
                surface[i] = bytes([v])
        surface[self.unk] = " ⁇ ".encode()
        self.surface = pa.array(surface, pa.large_binary())
        self.memo, self.most, self.memo_chars = {}, memo, memo_chars
        self._pairs()

    def _pairs(self) -> None:
        """Numbers for all symbols (pieces and characters of pieces) and the sorted table of pairs that merge."""
        chars = sorted({c for p in self.ids for c in p})
        number = {s: i for i, s in enumerate(dict.fromkeys([*self.ids, *chars]))}
        if len(number) >= NONE:
            raise ValueError(f"vocabularies of {NONE} symbols or more are not supported")
        found = sorted((number[p[:i]] << 16 | number[p[i:]], r) for p, r in self.rank.items()
                       for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
        self.pair_key, self.pair_rank = (np.array([x[k] for x in found], t) for k, t in enumerate((np.uint32, np.int32)))
        # a rank tells the union, but for runs of blanks, whose scores are equal: they take the heap
        self.union = np.full(max(self.rank.values(), default=0) + 1, NONE, np.uint16)
        mixed = [p for p in self.rank if p.strip(BLANK)]
        self.union[[self.rank[p] for p in mixed]] = [number[p] for p in mixed]
        self.in_rows = bool(found) and len({self.rank[p] for p in mixed}) == len(mixed)
        self.symbol_id = np.array([*(self.ids.get(s, -1) for s in number), *[-1] * (NONE + 1 - len(number))], np.int32)
        self.char = np.full(0x110000, NONE, np.uint16)
        for c in chars:
            self.char[ord(c)] = number[c] if c in self.ids else NONE

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's union, NEVER if it is no piece."""
        key = left.astype(np.uint32) << np.uint32(16) | right
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def learn(self, units: list[str]) -> None:
        """Solve unseen units and note their ids."""
        by_length: dict[int, list[str]] = {}
        for u in units:
            by_length.setdefault(0 if BLANK * 2 in u or not self.in_rows else len(u), []).append(u)
        for u in by_length.pop(0, []):
            self.memo[u] = self.solve(u)
        for length, same in by_length.items():
            for a in range(0, len(same), ROWS):
                self._solve_rows(same[a:a + ROWS], length)

    def _solve_rows(self, units: list[str], length: int) -> None:
        """Units of one length, a row each; every round merges the best pair of every row that has one."""
        syms = self.char[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].reshape(-1, length)
        rows = np.flatnonzero((syms != NONE).all(axis=1))
        for i in np.flatnonzero((syms == NONE).any(axis=1)):
            self.memo[units[i]] = self.solve(units[i])
        syms = syms[rows]
        agenda = self._ranks(syms[:, :-1], syms[:, 1:])
        while len(rows):
            n, width = syms.shape
            here = np.arange(n)
            at = agenda.argmin(axis=1) if width > 1 else np.zeros(n, np.int64)
            best = agenda[here, at] if width > 1 else np.full(n, NEVER)
            live = best != NEVER
            if not live.all():
                ids = self.symbol_id[syms[~live]].tobytes()
                for k, i in enumerate(rows[~live].tolist()):
                    self.memo[units[i]] = ids[4 * width * k:4 * width * (k + 1)]
                rows, syms, agenda, at, best = rows[live], syms[live], agenda[live], at[live], best[live]
                n = len(rows)
                here = here[:n]
                if not n:
                    break
            to = self.union[best]
            syms[here, at] = to
            syms = syms[np.arange(width) != at[:, None] + 1].reshape(n, width - 1)
            agenda = agenda[np.arange(width - 1) != at[:, None]].reshape(n, width - 2)
            has = np.flatnonzero(at < width - 2)
            agenda[has, at[has]] = self._ranks(to[has], syms[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            agenda[has, at[has] - 1] = self._ranks(syms[has, at[has] - 1], to[has])

    def _long(self, unit: str) -> list[str]:
        rank, syms, n = self.rank.get, list(unit), len(unit)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, i, x + y) for i, (x, y) in enumerate(zip(syms, syms[1:])) if (r := rank(x + y)) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, union = heapq.heappop(agenda)
            j = right[i]
            if not syms[i] or j < 0 or syms[i] + syms[j] != union:
                continue  # one of the two was merged meanwhile
            syms[i], syms[j], right[i] = union, "", right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (r := rank(syms[x] + syms[y])) is not None:
                    heapq.heappush(agenda, (r, x, syms[x] + syms[y]))
        return [s for s in syms if s]

    def solve(self, unit: str) -> bytes:
        """The ids of one unit, as 32-bit integers."""
        out = []
        for s in self._long(unit):
            if (i := self.ids.get(s)) is not None:
                out.append(i)
            else:
                parts = [self.bytes[v] for v in s.encode()]
                out.extend(parts if min(parts) >= 0 else [self.unk])
        return np.array(out, np.int32).tobytes()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        part, chars = [], 0
        for t in texts:
            part.append(t)
            chars += len(t)
            if chars >= CHARS:
                yield from self._encode(part)
                part, chars = [], 0
        yield from self._encode(part)

    def _cut(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The units of all texts one after the other, by number, and where each text's units end."""
        raw = [(" " + t.replace(BLANK, " ")).encode() if t else b"" for t in texts]
        data = b"".join(raw)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        code = np.frombuffer(data, np.uint8)
        blank = code == 32
        opens = np.zeros(len(code) + 1, bool)
        opens[ends - np.fromiter(map(len, raw), np.int64, len(raw))] = True
        opens[1:-1] |= blank[1:] & ~blank[:-1]
        if self.lines_part:
            opens[:-1] |= code == 10
            opens[1:] |= code == 10
        opens[-1] = False
        starts = np.flatnonzero(opens)
        offsets = pa.py_buffer(np.append(starts, len(code)).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(data)])
        return units.dictionary_encode(), np.searchsorted(starts, ends)

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        cut, ends = self._cut(texts)
        distinct = pc.replace_substring(cut.dictionary.cast(pa.large_string()), " ", BLANK).to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.memo.get, distinct))
        new = [i for i, ids in enumerate(known) if ids is None]
        if len(self.memo) + len(new) > self.most:  # the table starts anew
            self.memo.clear()
        self.learn([u for i in new if len(u := distinct[i]) <= self.memo_chars])
        for i in new:
            u = distinct[i]
            known[i] = self.memo[u] if len(u) <= self.memo_chars else self.solve(u)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        solved, number = np.frombuffer(b"".join(known), np.int32), cut.indices.to_numpy()
        size = sizes[number]
        done = np.concatenate([[0], size.cumsum()])
        ids = solved[np.arange(done[-1]) + np.repeat((sizes.cumsum() - sizes)[number] - done[:-1], size)]
        return iter(np.split(ids, done[ends[:-1]])) if len(texts) else iter(())

    def decode(self, ids) -> str:
        return next(self.decode_all(np.asarray(ids, np.int32), [len(ids)]))

    def decode_all(self, ids: np.ndarray, ends) -> Iterator[str]:
        """Texts of ids that lie one after the other; ``ends`` are their ends."""
        parts = self.surface.take(pa.array(ids))
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[:len(ids) + 1]
        data, start = (parts.buffers()[2] or pa.py_buffer(b"")).to_pybytes(), 0
        for end in offsets[np.asarray(ends, np.int64)].tolist():
            yield data[start:end].removeprefix(b" ").decode("utf-8", "replace")
            start = end


_MODELS: dict[str, MergeModel] = {}


def model(path: str) -> MergeModel:
    """The model of a file, loaded once in each worker."""
    if path not in _MODELS:
        _MODELS[path] = MergeModel(path)
    return _MODELS[path]


def encode_decode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded",
                  check_every: int = 1) -> DataFrame:
    """Add the ids of every whole text and, if named, the text decoded from them.

    ``model_path`` must be readable on every worker. ``check_every``: one row in so many, chosen by a checksum of
    its text, is held against the library (1: all, 0: none), copies in an Arrow batch once. One pass over the rows,
    no shuffle; a worker holds one Arrow batch.
    """
    for name in filter(None, (ids, decoded)):
        if name.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"column {name} exists already")
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False)),
                           *([T.StructField(decoded, T.StringType())] if decoded else [])])
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = model(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            at = {t: i for i, t in enumerate(dict.fromkeys(texts))}  # copies are worked off once
            own = list(codec.encode(list(at)))
            said = list(codec.decode_all(np.concatenate([*own, np.zeros(0, np.int32)]), np.cumsum([len(x) for x in own])))
            checked = [i for t, i in at.items() if check_every == 1 or check_every and zlib.crc32(t.encode()) % check_every == 0]
            if checked:
                want = codec.library.encode([*map(list(at).__getitem__, checked)], num_threads=1)
                back = codec.library.decode(want, num_threads=1)
                for i, ids_wanted, text_wanted in zip(checked, want, back):
                    if said[i] != text_wanted or not np.array_equal(np.array(ids_wanted, np.int32), own[i]):
                        raise RuntimeError(f"codec and sentencepiece differ on {list(at)[i][:200]!r}")
            found = [own[at[t]] for t in texts]
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            cols = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))]
            if decoded:
                cols.append(pa.array([said[at[t]] for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, ids, *([decoded] if decoded else [])])

    return df.mapInArrow(run, schema)
