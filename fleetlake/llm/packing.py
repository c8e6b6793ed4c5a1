"""Packing of tokenised texts into sequences of bounded length.

Lengths are bounded by the capacity, so a packing is planned on the number of pieces of each length:
at most `capacity` numbers, whatever the size of the corpus. Pieces above a third of the capacity fit
at most two to a sequence and are matched greedily, the longest with the longest that still fits;
shorter ones go, longest first, to the tightest remaining gap. The plan is a list of runs: so many
equal sequences, each with a piece of one length at one offset. Pieces of equal length are numbered in
parallel (blocks by hash, with the sizes of earlier blocks added), and the number finds the place.

A text is its token ids and one end id; null counts as empty and is the end id alone. Only longer texts are
cut, into pieces of `capacity`; the last may be shorter.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import Recent, batches, bound_batches, written

CACHE = 300_000

# How the word-level tokenizer file normalises and splits text.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# The same pattern for words of printable ASCII and composed Latin letters, which NFC leaves alone.
SIMPLE = re.compile("[!-~À-ÖØ-öø-įı-ſ]+").fullmatch
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+").findall
# Byte-level tokenizers write bytes without a visible Latin-1 character as the letters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(Recent):
    """Little-endian 32-bit ids of the tokens of a word (UTF-8), `size` words a generation.

    Only for tokenizers that drop white space and never join text across it: each word between ASCII
    white space is then encoded by itself. Any other white space stays inside its word.
    """

    def __init__(self, path: str, size: int = CACHE):
        super().__init__(size)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        self.plain = parts["normalizer"] == NORMALIZER and parts["pre_tokenizer"] == SPLITTER
        self.parts: Recent = Recent(size)
        self.parts.made = self._part

    def of(self, text: bytes) -> bytes:
        words = text.split()
        fresh = self.absent(words)
        self.fresh = dict(zip(fresh, self.encoded(fresh), strict=True))
        return b"".join(map(self.__getitem__, words))

    def encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of words. Simple ones (Latin letters, digits, ASCII marks, no special token) are cut by the
        tokenizer's own pattern here, so that only its merge table has to be asked, once per part."""
        texts = [word.decode() for word in words]
        hard = [t for t in texts if not (self.plain and SIMPLE(t)) or "<|" in t]
        found = self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)
        slow = {t: pack_ids(f.ids) for t, f in zip(hard, found, strict=True)}
        parts = self.parts
        return [slow[t] if t in slow else b"".join([parts[p] for p in PARTS(t.lower())]) for t in texts]

    def _part(self, part: str) -> bytes:
        mapped = part.encode().decode("latin-1").translate(BYTE_LETTERS)
        return pack_ids([t.id for t in self.model.tokenize(mapped)])

    def made(self, word: bytes) -> bytes:
        ids = self.fresh.get(word)
        return self.encoded([word])[0] if ids is None else ids


@lru_cache(maxsize=2)
def word_ids(path: str, size: int = CACHE) -> WordIds:
    return WordIds(path, size)


def tokenised_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str, cache: int = CACHE) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of every text."""
    bound_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(it):
        ids = word_ids(tokenizer, cache)
        for batch in batches(it):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (ids.of(text) if text else b"") + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def planned(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, pieces, first sequence, offset) that place counts[length] pieces.

    Numbers count the pieces of one length from 0. Sequence and offset of a run's i-th piece are first
    sequence + i and the run's offset.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many) with it
    sizes: list[int] = []  # the gaps that have runs, in order
    sequences = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n
        gap = capacity - offset - length
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        fits = bisect_left(large, capacity - length + 1) - 1
        partner = large[fits] if fits >= 0 else 0
        n = left[length] // 2 if partner == length else min(left[length], left.get(partner, 0))
        if n:
            runs.append((length, used[length], n, sequences, 0))
            used[length] += n
            left[length] -= n
            put(partner, n, sequences, length)
        else:
            n = left[length]
            put(length, n, sequences, 0)
        sequences += n
        large = [k for k in large if left[k]]

    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                n = max(1, left[length] // each)
                full = min(each, left[length])
                for i in range(full):
                    if i < full - 1:
                        runs.append((length, used[length], n, sequences, i * length))
                        used[length] += n
                        left[length] -= n
                    else:
                        put(length, n, sequences, i * length)
                sequences += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            take = min(n, left[length])
            if take < n:
                if gap not in gaps:
                    gaps[gap] = []
                    insort(sizes, gap)
                gaps[gap].append((first + take, n - take))
            put(length, take, first, capacity - gap)
    return runs


def numbered(pieces: DataFrame, blocks: int) -> DataFrame:
    """`pieces` with `number`, counting the pieces of each length from 0, in no single task.

    Pieces of one length are dealt to `blocks` blocks by hash; a block is numbered by itself and the
    sizes of the earlier blocks are added.
    """
    block = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(blocks)).cast("int")
    pieces = pieces.withColumn("block", block)
    sizes = pieces.groupBy("length", "block").count()
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    own = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own).cast("long") - 1)
    rows = ranked.join(sizes, ["length", "block"])
    return rows.withColumn("number", F.col("own") + F.col("earlier")).drop("block", "own", "earlier")


def packed_sequences(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = 64,
    cache: int = CACHE,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every text.

    `tokenizer` names a tokenizer file that every node has. `blocks` is how many tasks may number the
    pieces of one length at once; raise it with the corpus. `cache` is how many words a Python worker
    remembers; fewer cost time, not results.

    Null ids and repeated rows are packed like any others, each row's pieces by themselves; an empty table
    gives no rows; columns other than the two named are not read.
    """
    pieces = written(tokenised_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, cache), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = sorted(planned(counts, capacity))
    plan = docs.sparkSession.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))
    wide = max(counts.values(), default=0) + 1

    def place(it):
        runs = plan.value
        keys = runs[:, 0] * wide + runs[:, 1]
        for batch in batches(it):
            length, number = (np.asarray(batch.column(i)) for i in (3, 5))
            at = np.searchsorted(keys, length * wide + number, side="right") - 1
            sequence = runs[at, 3] + number - runs[at, 1]
            arrays = [*batch.columns[:5], pa.array(sequence), pa.array(runs[at, 4])]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rows = numbered(pieces, blocks).select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    return rows.mapInArrow(place, PIECES + ", sequence_id long, offset long")
