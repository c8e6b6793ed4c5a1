"""Token counts of texts under a SentencePiece BPE model, by byte-pair merging without identifiers.

A text is its characters in a linked list. All adjacent pairs that form a piece wait in a heap by rank
(best score first, then leftmost); the lowest is merged again and again, stale entries are skipped.
The count is the number of initial symbols minus the merges. A character that is no piece counts as
its UTF-8 bytes under byte fallback, else as one.

No piece spans from a character to a space after it or across a line break that no piece holds, so
the units between such places are merged one by one and their counts are kept per Python worker, in a
cache of CACHE units per generation. Null and empty texts have no tokens. Rows
are counted one by one: null ids, repeated rows and repeated ids come back as they are, an empty table
gives no rows, and other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import Recent, batches, bound_batches
from fleetlake.llm.piece_model import BPE, NORMAL, SPACE, load_pieces

CACHE = 300_000


class PairMerger:
    """Merges the characters of one unit (spaces written as `SPACE`)."""

    def __init__(self, path: str):
        model = load_pieces(path)
        if model.kind != BPE:
            raise ValueError("byte-pair merging needs a BPE model")
        self.model = model
        self.rank = {p: -s for p, s, t in zip(model.pieces, model.scores, model.types, strict=True) if t == NORMAL}
        self.fallback = model.byte_ids() is not None
        inner = {c for p in self.rank for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            self.units = re.compile("(?s).+")
        elif "\n" in inner:
            self.units = re.compile(" *[^ ]+| +")
        else:
            self.units = re.compile("\n| *[^ \n]+| +")

    def merged(self, unit: str) -> tuple[list[str], int]:
        """The symbols that are left, empty strings where one was merged away, and the merges."""
        symbols, rank, last = list(unit), self.rank, len(unit)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        heap = []
        for i in range(last - 1):
            score = rank.get(symbols[i] + symbols[i + 1])
            if score is not None:
                heap.append((score, i, i + 1, 2))
        heapify(heap)
        merges = 0
        while heap:
            _, i, j, size = heappop(heap)
            left, right = symbols[i], symbols[j]
            if not left or not right or len(left) + len(right) != size:
                continue
            merges += 1
            symbols[i], symbols[j] = left + right, ""
            after[i] = nxt = after[j]
            if nxt < last:
                before[nxt] = i
                score = rank.get(symbols[i] + symbols[nxt])
                if score is not None:
                    heappush(heap, (score, i, nxt, size + len(symbols[nxt])))
            prev = before[i]
            if prev >= 0:
                score = rank.get(symbols[prev] + symbols[i])
                if score is not None:
                    heappush(heap, (score, prev, i, size + len(symbols[prev])))
        return symbols, merges

    def count(self, unit: str) -> int:
        _, merges = self.merged(unit)
        extra = sum(len(c.encode()) - 1 for c in unit if c not in self.rank) if self.fallback else 0
        return len(unit) - merges + extra


class UnitCounts(Recent):
    """Counts by unit, merged when first asked for."""

    def __init__(self, merger: PairMerger):
        super().__init__(CACHE)
        self.merger = merger

    def made(self, unit: str) -> int:
        return self.merger.count(unit.replace(" ", SPACE))

    def of(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if self.merger.model.dummy_prefix:
            text = " " + text
        return sum(map(self.__getitem__, self.merger.units.findall(text)))


@lru_cache(maxsize=2)
def unit_counts(path: str) -> UnitCounts:
    return UnitCounts(PairMerger(path))


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; the model file is at `model` on every node."""
    bound_batches(docs.sparkSession)

    def count(it):
        counts = unit_counts(model)
        for batch in batches(it):
            texts = batch.column(1)
            sizes = texts.fill_null("").cast("binary")
            sizes = pa.compute.binary_length(sizes).cast("int64")
            tokens = np.fromiter((counts.of(t) if t else 0 for t in texts.to_pylist()), np.int64, len(texts))
            arrays = [batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
