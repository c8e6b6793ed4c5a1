"""Encoding and decoding with SentencePiece models by a batched Viterbi.

Words of equal length advance together: for each end position all substrings that end there are hashed
from one running sum per word and looked up in the sorted hashes of all pieces, and the best way to
each position is kept as a back pointer (piece and length) for all words at once.

Unigram models maximise the sum of piece scores. A BPE model's result is not the path of highest
score, but it too is decided position by position: it ends with the one piece whose pairing with the
last piece before it is stable, that is, byte-pair merging of the two texts together gives the two
pieces. Such paths score their last length and all others nothing, so the maximum is the merge result
itself. Verdicts on pairs are computed once per pair and worker and kept in a sorted table.

Characters without a piece become their UTF-8 bytes under byte fallback, else the unknown id (one for
a stretch). Units between places no piece spans are encoded once a group of batches, and those of up to
KEPT characters are remembered, CACHE of them a generation, so a worker's memory is bounded whatever the
texts hold. A unit of more than LONG characters, such as a text without white space, takes the same steps
alone, in time linear in its length.

Null and empty texts have no ids; null decodes to null. Rows are encoded one by one: null ids, repeated
rows and repeated ids come back as they are, an empty table gives no rows, and no column other than the two
named is read, so others may be called anything.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import BASES, Recent, batches, bound_batches, mixed, powers
from fleetlake.llm.piece_model import BPE, BYTE, CONTROL, NORMAL, SPACE, UNKNOWN, load_pieces
from fleetlake.llm.token_counts import PairMerger

CACHE, KEPT, TEXTS, GROUP = 250_000, 64, 4000, 6 << 20
PAIRS, FRESH = 4_000_000, 1 << 16
CELLS, LONG, TOP = 1 << 18, 1024, 18


class Edges(NamedTuple):
    """How the first and the last symbol of a piece's text grow while it is merged alone: (time, symbol), time
    being the highest rank merged so far. `whole`: the piece is what is left."""

    whole: bool
    first: list
    last: list


class PairVerdicts:
    """Whether two neighbouring pieces stay apart under merging, for many pairs at once.

    Up to the first merge across their border both texts are merged as if alone, so it is enough to see
    which symbols meet there, and whether their piece has a lower rank than what changes one of them next.
    Verdicts lie in a large sorted table and a small one, which joins the large one when it is full.
    """

    def __init__(self, path: str):
        self.merger = PairMerger(path)
        self.pieces = self.merger.model.pieces
        self.width = len(self.pieces) + 2
        self.tables = [(np.zeros(0, np.int64), np.zeros(0, bool))] * 2
        self.known: dict[int, Edges] = {}

    def edges(self, piece: int) -> Edges:
        found = self.known.get(piece)
        if found is None:
            text = self.pieces[piece]
            first, last = [(-np.inf, text[0])], [(-np.inf, text[-1])]
            left = [text]
            if len(text) > 1:
                left, time = list(text), -np.inf
                while True:
                    ranks = [(self.merger.rank[a + b], i) for i, (a, b) in enumerate(pairwise(left)) if a + b in self.merger.rank]
                    if not ranks:
                        break
                    rank, i = min(ranks)
                    time = max(time, rank)
                    left[i : i + 2] = [left[i] + left[i + 1]]
                    if left[0] != first[-1][1]:
                        first.append((time, left[0]))
                    if left[-1] != last[-1][1]:
                        last.append((time, left[-1]))
            found = self.known[piece] = Edges(left == [text], first, last)
        return found

    def judged(self, code: int) -> bool:
        one, two = divmod(code, self.width)
        unknown, start = self.width - 2, self.width - 1
        if two == unknown:
            return True
        right = self.edges(two)
        if one == unknown or one == start:
            return right.whole
        left = self.edges(one)
        if not (left.whole and right.whole):
            return False
        rank, last, first = self.merger.rank, left.last, right.first
        i = j = 0
        while True:
            ends = last[i + 1][0] if i + 1 < len(last) else np.inf
            grows = first[j + 1][0] if j + 1 < len(first) else np.inf
            across = rank.get(last[i][1] + first[j][1])
            if across is not None:
                if across < min(ends, grows):
                    return False
                if across == min(ends, grows):  # the same piece at two places: the leftmost goes first
                    parts = [self.pieces[one], self.pieces[two]]
                    return [s for s in self.merger.merged("".join(parts))[0] if s] == parts
            if ends == grows == np.inf:
                return True
            if ends <= grows:
                i += 1
            if grows <= ends:
                j += 1

    @staticmethod
    def _found(table, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, stable = table
        if not len(codes):
            return np.zeros(len(asked), bool), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
        known = codes[at] == asked
        return known, known & stable[at]

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        asked = one * self.width + two
        known, verdicts = self._found(self.tables[0], asked)
        rest = np.flatnonzero(~known)
        if len(rest):
            known, verdicts[rest] = self._found(self.tables[1], asked[rest])
            rest = rest[~known]
        if len(rest):
            fresh, place = np.unique(asked[rest], return_inverse=True)
            found = np.fromiter(map(self.judged, fresh.tolist()), bool, len(fresh))
            verdicts[rest] = found[place]
            self._keep(1, fresh, found)
            if len(self.tables[1][0]) > FRESH:
                self._keep(0, *self.tables[1])
                self.tables[1] = (self.tables[1][0][:0], self.tables[1][1][:0])
        return verdicts

    def _keep(self, which: int, codes: np.ndarray, stable: np.ndarray) -> None:
        old = self.tables[which]
        if len(old[0]) + len(codes) > PAIRS:
            old = (old[0][:0], old[1][:0])
        codes, stable = np.concatenate([old[0], codes]), np.concatenate([old[1], stable])
        order = np.argsort(codes, kind="stable")
        self.tables[which] = (codes[order], stable[order])


class Codec(Recent):
    """Ids of units as little-endian 32-bit numbers, by unit."""

    def __init__(self, path: str):
        super().__init__(CACHE)
        model = self.model = load_pieces(path)
        self.unknown, self.bytes = model.unknown_id(), model.byte_ids()
        normal = [i for i, t in enumerate(model.types) if t == NORMAL]
        self.longest = max(len(model.pieces[i]) for i in normal)
        hashes = np.array([self._hash(model.pieces[i]) for i in normal], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(normal)[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have one hash")
        # Where the keys with each value of the highest bits begin: most probes end at once.
        self.heads = np.searchsorted(self.keys, np.arange(1 << TOP, dtype=np.uint64) << np.uint64(64 - TOP))
        self.heads = np.append(self.heads, len(self.keys))
        self.crowd = int(np.diff(self.heads).max())
        lowest = min(model.scores[i] for i in normal)
        self.scores = np.array([*model.scores, lowest - 10.0])
        self.verdicts = PairVerdicts(path) if model.kind == BPE else None
        spans = any(SPACE in model.pieces[i].lstrip(SPACE) for i in normal)
        breaks = any("\n" in model.pieces[i] for i in normal)
        self.units = re.compile("(?s).+" if spans else " *[^ ]+| +" if breaks else "\n| *[^ \n]+| +")
        self.numbers = {model.pieces[i]: i for i in normal}
        self.pairs: dict[int, bool] = {}
        self.text = [self._bytes_of(i) for i in range(len(model.pieces))]
        self.sizes = np.array([len(t) for t in self.text])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        self.spelling = np.frombuffer(b"".join(self.text), np.uint8)

    def _bytes_of(self, i: int) -> bytes:
        piece, kind = self.model.pieces[i], self.model.types[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(SPACE, " ").encode()

    @staticmethod
    def _hash(piece: str) -> int:
        total, power = 0, 1
        for char in piece:
            total = (total + (ord(char) + 1) * power) % (1 << 64)
            power = power * BASES[1] % (1 << 64)
        return int(mixed(np.array([total], np.uint64))[0])

    def _pieces(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and their ids."""
        bucket = (hashes >> np.uint64(64 - TOP)).astype(np.int64)
        at, end = self.heads[bucket], self.heads[bucket + 1]
        left = np.flatnonzero(at < end)
        which, ids = [], []
        for _ in range(self.crowd):
            if not len(left):
                break
            same = self.keys[at[left]] == hashes[left]
            which.append(left[same])
            ids.append(self.ids[at[left[same]]])
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        if not which:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(which), np.concatenate(ids)

    def _viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length (rows of code points): ids from the right, -1 before them,
        and where the unknown characters are. The unknown id is the number of pieces here."""
        m, n = codes.shape
        unknown, start = len(self.model.pieces), len(self.model.pieces) + 1
        sums = np.zeros((n + 1, m), np.uint64)
        np.cumsum((codes.T.astype(np.uint64) + np.uint64(1)) * powers(BASES[1], n)[:, None], axis=0, out=sums[1:])
        undo = powers(pow(BASES[1], -1, 1 << 64), n)
        # By position, then word, so that a step reads whole rows.
        best, last, back = np.full((n + 1, m), -np.inf), np.full((n + 1, m), unknown), np.zeros((n + 1, m), np.int64)
        best[0], last[0] = 0, start
        for end in range(1, n + 1):
            for length in range(min(end, self.longest), 0, -1):
                begin = end - length
                open_rows = np.flatnonzero(back[end] == 0) if self.verdicts else np.arange(m)
                if not len(open_rows):
                    break
                known, ids = self._pieces(mixed((sums[end, open_rows] - sums[begin, open_rows]) * undo[begin]))
                if length > 1:
                    open_rows, piece = open_rows[known], ids
                else:
                    piece = np.full(len(open_rows), unknown)
                    piece[known] = ids
                if not len(open_rows):
                    continue
                before = last[begin, open_rows]
                if self.verdicts:
                    score = np.where(self.verdicts.of(before, piece), float(length), -np.inf)
                else:
                    score = best[begin, open_rows] + self.scores[piece]
                better = score > best[end, open_rows]
                rows = open_rows[better]
                best[end, rows], last[end, rows], back[end, rows] = score[better], piece[better], length
        out, spots = np.full((m, n), -1), np.zeros((m, n), np.int64)
        at, row = np.full(m, n), np.arange(m)
        for column in range(n - 1, -1, -1):
            live = row[at > 0]
            if not len(live):
                break
            out[live, column] = last[at[live], live]
            at[live] -= back[at[live], live]
            spots[live, column] = at[live]
        return out, spots

    def _learned(self, units: list[str]):
        """(unit, its ids) of every unit."""
        by_length: dict[int, list[str]] = {}
        for unit in units:
            if len(unit) > LONG:
                yield unit, self._alone(unit.replace(" ", SPACE))
            else:
                by_length.setdefault(len(unit), []).append(unit)
        for n, words in by_length.items():
            size = max(1, CELLS // n)
            for at in range(0, len(words), size):
                part = words[at : at + size]
                raw = "".join(part).replace(" ", SPACE).encode("utf-32-le", "surrogatepass")
                codes = np.frombuffer(raw, np.uint32).reshape(len(part), n)
                ids, spots = self._viterbi(codes)
                strange = (ids == len(self.model.pieces)).any(axis=1)
                flat = ids[ids >= 0].astype("<i4").tobytes()
                ends = np.cumsum(4 * (ids >= 0).sum(axis=1)).tolist()
                begin = 0
                for i, (unit, end) in enumerate(zip(part, ends, strict=True)):
                    yield unit, self._spelled(codes[i], ids[i], spots[i]) if strange[i] else flat[begin:end]
                    begin = end

    def _alone(self, unit: str) -> bytes:
        """The same lattice for one unit of any length, position by position."""
        unknown, start, n = len(self.model.pieces), len(self.model.pieces) + 1, len(unit)
        width, pairs = unknown + 2, self.pairs
        best, last, back = [0.0] + [-np.inf] * n, [start] + [unknown] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for length in range(min(end, self.longest), 0, -1):
                begin = end - length
                piece = self.numbers.get(unit[begin:end], unknown if length == 1 else -1)
                if piece < 0:
                    continue
                if self.verdicts:
                    code = last[begin] * width + piece
                    stable = pairs.get(code)
                    if stable is None:
                        if len(pairs) >= CACHE:
                            pairs.clear()
                        stable = pairs[code] = self.verdicts.judged(code)
                    if stable:
                        last[end], back[end] = piece, length
                        break
                else:
                    score = best[begin] + self.scores[piece]
                    if score > best[end]:
                        best[end], last[end], back[end] = score, piece, length
        ids, spots, at = [], [], n
        while at > 0:
            ids.append(last[at])
            at -= back[at]
            spots.append(at)
        codes = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self._spelled(codes, np.array(ids[::-1]), np.array(spots[::-1]))

    def _spelled(self, codes, ids, spots) -> bytes:
        out: list[int] = []
        for piece, at in zip(ids.tolist(), spots.tolist(), strict=True):
            if piece == len(self.model.pieces):
                out += [self.bytes[b] for b in chr(codes[at]).encode()] if self.bytes else [self.unknown]
            elif piece >= 0:
                out.append(piece)
        return np.array(out, "<i4").tobytes()

    def known(self, units) -> dict[str, bytes]:
        """The ids of every different unit; what has to be encoded for that is encoded together, and what the
        cache forgets meanwhile stays at hand."""
        found, fresh = {}, []
        for unit in dict.fromkeys(units):
            ids = self.get(unit)
            if ids is None:
                ids = self.older.get(unit)
                if ids is None:
                    fresh.append(unit)
                    continue
                self.keep(unit, ids)
            found[unit] = ids
        for unit, ids in self._learned(fresh):
            found[unit] = ids
            if len(unit) <= KEPT:
                self.keep(unit, ids)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        prefix = " " if self.model.dummy_prefix else ""
        split = [self.units.findall(prefix + t.replace(SPACE, " ")) if t else [] for t in texts]
        out = []
        for at in range(0, len(split), TEXTS):
            part = split[at : at + TEXTS]
            ids = self.known(chain.from_iterable(part))
            out += [b"".join(map(ids.__getitem__, units)) for units in part]
        return out if self.bytes else [self._fused(raw) for raw in out]

    def spelled_alike(self, texts: list[str | None], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the pieces ids[ends[i]:ends[i+1]] spell text i, `▁` read as a space."""
        prefix = b" " if self.model.dummy_prefix else b""
        raw = [prefix + t.replace(SPACE, " ").encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        length = np.array([len(r) for r in raw], np.int64)
        sizes = self.sizes[ids]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        same = np.diff(stops[ends]) == length
        if not same.all():  # rare: the texts that differ in length leave, the others are compared
            for i in np.flatnonzero(same).tolist():
                own = ids[ends[i] : ends[i + 1]].tolist()
                same[i] = b"".join(map(self.text.__getitem__, own)) == raw[i]
            return same
        spelled = self.spelling[np.repeat(self.begins[ids] - stops[:-1], sizes) + np.arange(stops[-1])]
        wrong = np.concatenate([[0], np.cumsum(spelled != np.frombuffer(b"".join(raw), np.uint8))])
        bounds = np.concatenate([[0], np.cumsum(length)])
        return wrong[bounds[1:]] == wrong[bounds[:-1]]

    def _fused(self, raw: bytes) -> bytes:
        ids = np.frombuffer(raw, "<i4")
        again = np.zeros(len(ids), bool)
        again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[~again].tobytes()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _groups(it):
    """Batches taken together up to about GROUP bytes: a lattice step costs the same for few words."""
    held, size = [], 0
    for batch in it:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and round_trip (decoding the ids gives the text back, `▁` read as a space)."""
    bound_batches(docs.sparkSession)

    def encode(it):
        coder = codec(model)
        for group in _groups(batches(it)):
            batch = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
            texts = batch.column(1).to_pylist()
            raw = coder.encode(texts)
            values = np.frombuffer(b"".join(raw), "<i4")
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            same = coder.spelled_alike(texts, values, ends)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(same)], names=["doc_id", "ids", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>, round_trip boolean")


def decoded(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows with lists of ids; null ids within a list are skipped."""
    bound_batches(rows.sparkSession)

    def decode(it):
        coder = codec(model)
        for batch in batches(it):
            texts = [None if x is None else coder.decode([i for i in x if i is not None]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(decode, "doc_id long, text string")
