"""Ranked lexical search, term at a time with a limited set of accumulators.

Terms are the maximal runs of bytes of ASCII letters, ASCII digits and non-ASCII characters, A-Z lowered.
One pass over the texts keeps the postings of the terms that a fixed-size filter of all query terms lets
through, in blocks of documents: per block the terms, their documents and occurrences, and the lengths.

For each query a block takes its terms rarest first. A term may give documents new accumulators while the
highest sum that it and the later terms can give inside the block reaches the query's threshold; after
that only the documents that have an accumulator are looked up in the postings of the later terms, so their
scores are exact. The threshold is the higher of the k-th partial score in the block and a k-th score known
beforehand: a first pass scores the documents that hold a query's rarest terms. Scores equal to
the threshold stay, so ties at the k-th place are settled by id over all blocks.

Queries go in passes of about LOAD / 2 terms, so what a pass sends to the tasks grows with neither
table. An item without terms has no rows. Documents with null, empty or term-free texts count nowhere; those with a null id count in the
statistics and are not ranked. Repeated rows are documents of their own, and repeated items are answered
once each. Other columns, whatever their names, are not read. An empty table gives no rows. Long texts are
cut into pieces only at places between terms. Terms are compared by two 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import BASES, batches, binary_column, bound_batches, dropped, mixed, runs, span_hashes, text_bytes, written

LOAD = 1 << 18
DOCS, BYTES = 4096, 8 << 20
FILTER_BITS = 1 << 24

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms_of(column: pa.Array, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each term of a batch of texts the number of its text and two hashes, in order."""
    data, bounds = text_bytes(column)
    start, end = runs(IN_TERM[data], bounds)
    doc = np.searchsorted(bounds, start, side="right") - 1
    one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(start, start[at] + piece)))
        raw = data[start[at] : end[stop - 1]]
        codes = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint64) + np.uint64(1)
        begin, finish = start[at:stop] - start[at], end[at:stop] - start[at]
        size = (finish - begin).astype(np.uint64) << np.uint64(40)
        one[at:stop] = mixed(span_hashes(codes, begin, finish, BASES[0]) ^ size)
        two[at:stop] = mixed(span_hashes(codes, begin, finish, BASES[2]) ^ size)
        at = stop
    return doc, one, two


def _places(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return [(h & mask).astype(np.int64) for h in (one, two, (one >> np.uint64(24)) ^ (two >> np.uint64(17)))]


def counted(doc: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (term, doc) with occurrences, sorted by term and doc."""
    order = np.lexsort((doc, two, one))
    doc, one, two = doc[order], one[order], two[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.flatnonzero(new)
    return doc[at], one[at], two[at], np.diff(np.append(at, len(doc)))


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(number, item_id, one, two, times): the different terms of every item; `number` tells items apart."""

    def split(it):
        for batch in batches(it):
            doc, one, two = terms_of(batch.column(2))
            doc, one, two, times = counted(doc, one, two)
            names, numbers = batch.column(1).take(pa.array(doc)), batch.column(0).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [numbers, names, pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(times.astype(np.int64))],
                names=["number", "item_id", "one", "two", "times"],
            )

    rows = items.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(split, "number long, item_id long, one long, two long, times long")


def term_filter(terms: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, packed, in which every query term has its three places set."""

    def mark(it):
        for batch in batches(it):
            at = np.unique(np.concatenate(_places(*(np.asarray(c).view(np.uint64) for c in batch.columns))))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["word", "bits"])

    words = terms.select("one", "two").mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(FILTER_BITS >> 5, np.uint32)
    for row in words.collect():  # at most FILTER_BITS / 32 rows
        out[row["word"]] = row["bits"]
    return out


def passing(bits: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    keep = np.ones(len(one), bool)
    for at in _places(one, two):
        keep &= (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
    return keep


BLOCK = "docs binary, lengths binary, one binary, two binary, first binary, places binary, times binary, n_docs long, n_terms long"


class Block(NamedTuple):
    """Postings of up to DOCS documents: of term t those at first[t] to first[t+1]."""

    docs: np.ndarray  # ids
    lengths: np.ndarray
    one: np.ndarray  # terms, sorted by (one, two)
    two: np.ndarray
    first: np.ndarray
    places: np.ndarray  # documents of postings
    times: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        kinds = dict(docs=np.int64, lengths=np.int64, one=np.uint64, two=np.uint64, first=np.int64, places=np.int32, times=np.int64)
        return cls(*(np.frombuffer(row[name], kind) for name, kind in kinds.items()))

    def terms(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Which term each (one, two) is here, -1 where the block has none of it."""
        at = np.searchsorted(self.one, one)
        found = np.full(len(one), -1)
        left = np.arange(len(one))
        while len(left):  # several steps only where two terms share their first hash
            left = left[at[left] < len(self.one)]
            left = left[self.one[at[left]] == one[left]]
            same = self.two[at[left]] == two[left]
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return found


def posting_blocks(docs: DataFrame, bits, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents with the postings of all terms in the filter; n_docs and n_terms count
    the documents that hold a term and their terms. Documents without id have no place in a block, but
    their postings do: they are under the place -1."""

    def index(it):
        held, size = [], 0

        def block():
            ids, lengths, parts, base = [], [], [], 0
            for names, known, n, doc, one, two, times in held:
                place = np.where(known, np.cumsum(known) - 1 + base, -1)
                ids.append(names[known])
                lengths.append(n[known])
                base += int(known.sum())
                parts.append((place[doc], one, two, times))
            place, one, two, times = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((place, two, one))
            place, one, two, times = place[order], one[order], two[order], times[order]
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            at = np.flatnonzero(new)
            all_lengths = np.concatenate([h[2] for h in held])
            columns = [np.concatenate(ids), np.concatenate(lengths), one[at], two[at], np.append(at, len(one)), place.astype(np.int32), times]
            arrays = [binary_column([np.ascontiguousarray(c).tobytes()]) for c in columns]
            counts = [pa.array([int(x)], pa.int64()) for x in ((all_lengths > 0).sum(), all_lengths.sum())]
            names = [c.split()[0] for c in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([*arrays, *counts], names=names)

        for batch in batches(it):
            doc, one, two = terms_of(batch.column(1))
            n = np.bincount(doc, minlength=batch.num_rows)
            keep = passing(bits.value, one, two)
            names = batch.column(0)
            known = np.asarray(names.is_valid()) & (n > 0)
            held.append((np.asarray(names.fill_null(0)), known, n, *counted(doc[keep], one[keep], two[keep])))
            size += batch.nbytes
            if size >= BYTES or sum(len(h[0]) for h in held) >= DOCS:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(index, BLOCK)


def document_frequencies(blocks: DataFrame) -> DataFrame:
    """(one, two, df) of the terms in the blocks."""

    def count(it):
        for batch in batches(it):
            for row in batch.to_pylist():
                one, two, first = (np.frombuffer(row[c], np.int64) for c in ("one", "two", "first"))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (one, two, np.diff(first))], names=["one", "two", "n"])

    rows = blocks.select("one", "two", "first").mapInArrow(count, "one long, two long, n long")
    return rows.groupBy("one", "two").agg(F.sum("n").alias("df"))


class Asked(NamedTuple):
    """A block of queries: of query q the terms at first[q] to first[q+1], rarest first."""

    numbers: list
    items: list
    first: np.ndarray
    one: np.ndarray
    two: np.ndarray
    df: np.ndarray
    factor: np.ndarray  # weight times the term's repeats in the item
    floor: np.ndarray  # known k-th scores


def asked_of(rows: list, n: int) -> Asked:
    """The queries of rows (number, item_id, floor, terms: list of (df, one, two, times))."""
    lists = [sorted(r["terms"]) for r in rows]
    flat = [t for own in lists for t in own]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * t[0] + 1))) * t[3] for t in flat]
    first = np.concatenate([[0], np.cumsum([len(own) for own in lists])]).astype(np.int64)
    column = lambda i, kind: np.array([t[i] for t in flat], np.int64).view(kind)
    floor = np.array([r["floor"] for r in rows], np.int64)
    return Asked([r["number"] for r in rows], [r["item_id"] for r in rows], first, column(1, np.uint64), column(2, np.uint64), column(0, np.int64), np.array(weights, np.int64), floor)


def impacts(block: Block, n: int, total: int) -> np.ndarray:
    """What each posting adds for a weight of 1; 0 for documents without id."""
    m = 25 + (75 * block.lengths * n) // max(total, 1)
    known = block.places >= 0
    out = np.zeros(len(block.places), np.int64)
    times = block.times[known]
    out[known] = (1_000_000_000 * times) // (1000 * times + 8 * m[block.places[known]])
    return out


class Scorer:
    """Scores the queries of one Asked in one Block; `created` counts accumulators, `read` postings."""

    def __init__(self, block: Block, n: int, total: int, k: int):
        self.block, self.k = block, k
        self.gain = impacts(block, n, total)
        self.most = np.maximum.reduceat(self.gain, block.first[:-1]) if len(block.one) else np.zeros(0, np.int64)
        self.sums, self.has = np.zeros(len(block.docs), np.int64), np.zeros(len(block.docs), bool)
        self.created = self.read = 0

    def _postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.block.first[term], self.block.first[term + 1]
        places = self.block.places[a:b]
        skip = int(np.searchsorted(places, 0))  # documents without id come first
        return places[skip:], self.gain[a + skip : b]

    def _kth(self, docs: np.ndarray) -> int:
        if len(docs) < self.k:
            return 0
        values = self.sums[docs]
        return int(np.partition(values, len(values) - self.k)[len(values) - self.k])

    def best(self, terms: np.ndarray, factor: np.ndarray, reach: np.ndarray, floor: int, seeds: int | None = None):
        """Places and scores of the documents that can be among the k best, scores exact.

        `terms` are in the order of rarity, `reach[i]` is the most that those from i on can add. With
        `seeds` only the first so many terms create accumulators.
        """
        live = np.zeros(0, np.int64)
        stop, last = len(terms), len(terms) if seeds is None else seeds
        for i in range(len(terms)):
            if i >= last or reach[i] < max(floor, 1):
                stop = i
                break
            places, gain = self._postings(terms[i])
            self.read += len(places)
            self.sums[places] += factor[i] * gain
            fresh = places[~self.has[places]]
            self.has[fresh] = True
            self.created += len(fresh)
            if len(fresh):
                live = np.concatenate([live, fresh])
            if seeds is None and i + 1 < len(terms) and reach[i + 1] < self._limit(reach, i):
                floor = max(floor, self._kth(live))
        self.has[live] = False
        live.sort()
        for i in range(stop, len(terms)):
            if seeds is None:
                live, gone = self._split(live, max(floor, self._kth(live)) - reach[i])
                self.sums[gone] = 0
            if not len(live):
                break
            places, gain = self._postings(terms[i])
            at = np.minimum(np.searchsorted(places, live), max(len(places) - 1, 0))
            hit = places[at] == live if len(places) else np.zeros(len(live), bool)
            self.read += len(live)
            self.sums[live[hit]] += factor[i] * gain[at[hit]]
        scores = self.sums[live]
        self.sums[live] = 0
        return live, scores

    @staticmethod
    def _limit(reach: np.ndarray, i: int) -> int:
        """A k-th partial score can pass the remaining reach only if what came so far could."""
        return int(reach[0] - reach[i + 1]) + 1

    def _split(self, live: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        good = self.sums[live] >= least
        return live[good], live[~good]


def _ranked(blocks: DataFrame, asked, n: int, total: int, k: int, seeding: bool) -> DataFrame:
    """(number, item_id, doc_id, score): at most k documents of every block and query."""

    def score(it):
        queries = asked.value
        for batch in batches(it):
            for row in batch.to_pylist():
                yield from scored_block(Block.read(row), queries, n, total, k, seeding)

    return blocks.mapInArrow(score, "number long, item_id long, doc_id long, score long")


def scored_block(block: Block, queries: Asked, n: int, total: int, k: int, seeding: bool) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(block, n, total, k)
    found = block.terms(queries.one, queries.two)
    bound = np.where(found >= 0, queries.factor * scorer.most[found] if len(scorer.most) else 0, 0)
    running = np.concatenate([[0], np.cumsum(bound)])
    totals = running[queries.first[1:]] - running[queries.first[:-1]]
    out = []
    for q in np.flatnonzero(totals >= np.maximum(queries.floor, 1)):
        a, b = queries.first[q], queries.first[q + 1]
        there = np.flatnonzero(found[a:b] >= 0) + a
        reach = np.cumsum(bound[there][::-1])[::-1]
        seeds = None
        if seeding:
            enough = np.searchsorted(np.cumsum(queries.df[a:b]), k) + 1  # rarest terms of k documents
            seeds = int((there < a + enough).sum())
            if not seeds:
                continue
        live, scores = scorer.best(found[there], queries.factor[there], reach, int(queries.floor[q]), seeds)
        good = scores >= max(int(queries.floor[q]), 1)
        names, scores = block.docs[live[good]], scores[good]
        order = np.lexsort((names, -scores))[:k]
        out.append((q, names[order], scores[order]))
    if out:
        which = np.repeat([o[0] for o in out], [len(o[1]) for o in out])
        numbers, items = pa.array([queries.numbers[i] for i in which], pa.int64()), pa.array([queries.items[i] for i in which], pa.int64())
        yield pa.RecordBatch.from_arrays([numbers, items, *(pa.array(np.concatenate([o[j] for o in out])) for j in (1, 2))], names=["number", "item_id", "doc_id", "score"])


def _by_item(terms: DataFrame) -> tuple[DataFrame, int]:
    """Each item's terms in one row with the pass it belongs to, and the number of passes: so many that
    one holds about LOAD / 2 terms."""
    passes = -(-2 * terms.count() // LOAD)
    columns = [F.first("item_id").alias("item_id"), F.collect_list(F.struct("df", "one", "two", "times")).alias("terms")]
    rows = terms.groupBy("number").agg(*columns)
    return rows.withColumn("pass", F.pmod(F.xxhash64("number"), F.lit(max(passes, 1)))), passes


def top_k(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores above 0 for every item."""
    spark = docs.sparkSession
    context = spark.sparkContext
    bound_batches(spark)
    terms = written(query_terms(items, item_col, item_text_col), "query-terms")
    bits = context.broadcast(term_filter(terms))
    blocks = written(posting_blocks(docs, bits, id_col, text_col), "postings")
    n, total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weighed = terms.join(document_frequencies(blocks), ["one", "two"])
    weighed = written(weighed, "weighed-terms")
    dropped(terms)
    asked, passes = _by_item(weighed)
    order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")

    def best(rows):
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    results = None
    for number in range(passes):
        rows = [r.asDict() | {"floor": 0} for r in asked.filter(F.col("pass") == number).collect()]
        shared = context.broadcast(asked_of(rows, n))
        seeds = best(_ranked(blocks, shared, n, total, k, True)).filter(F.col("rank") == k)
        floors = {r["number"]: r["score"] for r in seeds.select("number", "score").collect()}
        shared.unpersist()
        rows = [r | {"floor": floors.get(r["number"], 0)} for r in rows]
        shared = context.broadcast(asked_of(rows, n))
        found = written(best(_ranked(blocks, shared, n, total, k, False)), "ranked")
        shared.unpersist()
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return results.select("item_id", "rank", "doc_id", "score")
