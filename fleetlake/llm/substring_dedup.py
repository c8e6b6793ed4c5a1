"""Removal of word passages that occur earlier in the corpus, on a compacted de Bruijn graph.

The edges of the graph are the windows of `window` consecutive words of one text; a window may go if
its word sequence starts earlier too (smaller doc_id, or the same text further left), and every word
that such a window covers is removed. Windows are judged on the input.

Edges are never handled one by one. Each window has an anchor, the lowest hash among its `anchor`-word
grams (leftmost of equals), which depends on the window's words alone. Consecutive windows with one
anchor form a path; about one row per seven words leaves the texts. Then, by Spark joins:

* paths whose anchor occurs once in the corpus cannot repeat and go;
* equal paths (anchor and content hash, 128 bits from two independent hashes) become one path with its
  first source coordinate and its occurrences, so that thousands of copies cost one row each;
* a path that one path alone follows in all its copies, and that alone comes before it, is joined to it;
  pointer doubling gives every path the head of its chain and its place in it, so a repeated passage of
  any length is one row a copy;
* an anchor with one path does not branch: all windows of the path are first at its first source;
* where several paths share an anchor, one text per path is read again at its source coordinates and
  its windows are compared one by one, again by two hashes.

Counting is done before rows meet by key and hot keys are met in joins that Spark can split, so
neither a copied text nor a passage that many texts share lands in one task.

Null and empty texts have no words. Rows without doc_id take no part and stay whole. Rows that repeat
one doc_id count as one document and should hold one text. Words are runs of bytes outside `[\\x20\\x09-\\x0D]`, unchanged.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import BASES, batches, dropped, lean_workers, mixed, span_hashes, words_of, written

WINDOW, ANCHOR = 20, 8
PATH = ["anchor", "path", "lead", "edges"]
PATHS = "anchor long, path long, doc_id long, at int, lead int, edges int"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def batch_paths(column: pa.Array, window: int, anchor: int):
    """anchor, path, number of the text, first word, anchor's place in the first window, edges."""
    words = words_of(column)
    total = len(words.doc)
    none = np.zeros(0, np.int64)
    if total < window:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    one, two = words.hashes(0), words.hashes(1)
    at = np.arange(total - anchor + 1)
    grams = mixed(span_hashes(one, at, at + anchor, BASES[1]))
    place = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1).argmin(axis=1)
    begin = np.flatnonzero(words.doc[: total - window + 1] == words.doc[window - 1 :])
    spot = begin + place[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (spot[1:] != spot[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    edges = np.diff(np.append(first, len(begin)))
    begin, spot = begin[first], spot[first]
    lead = spot - begin
    content = span_hashes(two, begin, begin + edges + window - 1, BASES[3])
    path = mixed(content ^ (lead * 64 + edges).astype(np.uint64))
    doc = words.doc[begin]
    return grams[spot], path, doc, begin - words.first[doc], lead, edges


def _paths(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def cut(it):
        for batch in batches(it):
            key, path, doc, at, lead, edges = batch_paths(batch.column(1), window, anchor)
            ids = batch.column(0).take(pa.array(doc))
            small = [pa.array(x.astype(np.int32)) for x in (at, lead, edges)]
            yield pa.RecordBatch.from_arrays([_signed(key), _signed(path), ids, *small], names=["anchor", "path", "doc_id", "at", "lead", "edges"])

    return docs.mapInArrow(cut, PATHS)


def _opened(texts: DataFrame, window: int) -> DataFrame:
    """Windows of branching paths, from rows (doc_id, text, wanted: list of path, place)."""

    def read(it):
        names = ["anchor", "path", "lead", "edges", "place", "one", "two", "doc_id", "start"]
        for batch in batches(it):
            words = words_of(batch.column(1))
            one, two = words.hashes(0), words.hashes(1)
            wanted = batch.column(2)
            row = np.repeat(np.arange(len(wanted)), np.diff(np.asarray(wanted.offsets)))
            fields = wanted.flatten()
            key = {name: np.asarray(fields.field(name)) for name in (*PATH, "at")}
            many = key["edges"]
            each = np.repeat(np.arange(len(row)), many)
            place = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
            start = key["at"][each] + place
            inside = words.first[row[each]] + start + window <= words.first[row[each] + 1]
            each, place, start = each[inside], place[inside], start[inside]
            begin = words.first[row[each]] + start
            hashes = [_signed(mixed(span_hashes(h, begin, begin + window, BASES[2 * i + 1]))) for i, h in enumerate((one, two))]
            path = [pa.array(key[name][each]) for name in PATH]
            ids = batch.column(0).take(pa.array(row[each]))
            arrays = [*path, pa.array(place.astype(np.int32)), *hashes, ids, pa.array(start.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "anchor long, path long, lead int, edges int, place int, one long, two long, doc_id long, start int"
    return texts.mapInArrow(read, schema)


def chains(places: DataFrame) -> DataFrame:
    """(id, head, offset, total) of the paths in chains of two and more, from occurrences (id, copies, edges,
    doc_id, at): the chain's first path, the windows of the chain before this path and in all.

    Two paths are joined where the second follows the first in every copy of either. A path whose head is
    not known yet takes its predecessor's predecessor, so rounds are logarithmic in the longest chain.
    """
    one = places.select(F.col("id").alias("before"), "copies", "doc_id", (F.col("at") + F.col("edges")).alias("at"), F.col("edges").alias("offset"))
    two = places.select("id", "copies", "doc_id", "at")
    pairs = one.join(two, ["doc_id", "at", "copies"]).groupBy("id", "before", "copies", "offset").agg(F.count("*").alias("n"))
    links = written(pairs.filter("n = copies").select("id", "before", "offset"), "chain-links")
    heads = links.select(F.col("before").alias("id")).join(links.select("id"), "id", "left_anti").distinct()
    found = written(heads.select("id", F.col("id").alias("head"), F.lit(0).cast("long").alias("offset")), "chain-heads")
    tables = [links, found]
    open_links = links.select("id", "before", F.col("offset").cast("long").alias("offset"))
    while True:
        known = found.select(F.col("id").alias("before"), "head", F.col("offset").alias("more"))
        more = open_links.select(F.col("id").alias("before"), F.col("before").alias("up"), F.col("offset").alias("far"))
        met = open_links.join(known.unionByName(more, allowMissingColumns=True), "before")
        far = F.when(F.col("head").isNull(), F.col("far")).otherwise(F.col("more"))
        step = met.select("id", "head", F.coalesce("up", "before").alias("before"), (F.col("offset") + far).alias("offset"))
        step = written(step, "chain-step")
        tables.append(step)
        found = found.unionByName(step.filter("head IS NOT NULL").select("id", "head", "offset"))
        open_links = step.filter("head IS NULL").select("id", "before", "offset")
        if open_links.isEmpty():
            break
    sizes = places.groupBy("id").agg(F.max("edges").alias("edges"))
    long = found.join(sizes, "id")
    totals = long.groupBy("head").agg(F.max(F.col("offset") + F.col("edges")).alias("total"))
    spans = written(long.join(totals, "head").select("id", "head", "offset", "total"), "chains")
    dropped(*tables)
    return spans


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Rows (doc_id, at, bits, run): bit i says that the window from word at + i occurs earlier too; where
    `run` is not null, all of so many windows from `at` on do.

    `docs` has doc_id and text; `window` must be at most `anchor` + 31.
    """
    lean_workers(docs.sparkSession)
    docs = docs.filter(F.col("doc_id").isNotNull())
    found = written(_paths(docs, window, anchor), "paths")
    # Counts are written before they are joined: next to a plain scan Spark can split a hot anchor.
    again = written(found.groupBy("anchor").count().filter("count > 1").select("anchor"), "repeated-anchors")
    live = written(found.join(again, "anchor", "left_semi"), "repeated-paths")
    dropped(found, again)
    first = F.min(F.struct("doc_id", "at"))
    paths = live.groupBy(*PATH).agg(first.alias("first"), F.count("*").alias("copies"))
    paths = written(paths.withColumn("id", F.monotonically_increasing_id()), "path-table")
    branching = written(paths.groupBy("anchor").count().filter("count > 1").select("anchor"), "branching-anchors")
    wanted = paths.join(branching, "anchor", "left_semi").select(*PATH, "first.*")
    # Written, so that its size is known: while it is small it goes to the texts, not they to it.
    by_text = written(wanted.groupBy("doc_id").agg(F.collect_list(F.struct(*PATH, "at")).alias("wanted")), "wanted-windows")
    windows = written(_opened(docs.join(by_text, "doc_id").select("doc_id", "text", "wanted"), window), "windows")
    origin = written(windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "start")).alias("origin")), "origins")
    foreign = windows.join(origin, ["one", "two"]).filter(F.col("origin") != F.struct("doc_id", "start"))
    masks = foreign.groupBy(*PATH).agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("mask"))
    judged = paths.join(masks, PATH, "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    judged = written(judged.filter("copies > 1 OR mask <> 0").select(*PATH, "id", "copies", "first", "mask"), "judged-paths")
    dropped(paths, branching, by_text, windows, origin)
    places = written(live.join(judged, PATH).select("id", "copies", "edges", "doc_id", "at", "first", "mask"), "judged-places")
    dropped(live, judged)
    spans = chains(places.filter("copies > 1"))
    marks = places.join(spans, "id", "left")
    is_first = F.struct("doc_id", "at") == F.col("first")
    # What follows the head of a chain is part of the head's run, but for the first copy, which has masks.
    marks = marks.filter(is_first | F.col("head").isNull() | (F.col("head") == F.col("id")))
    bits = F.when(is_first, F.col("mask")).when(F.col("head").isNull(), F.expr("shiftleft(1, edges) - 1")).otherwise(0)
    run = F.when(~is_first & F.col("head").isNotNull(), F.col("total"))
    marks = written(marks.select("doc_id", "at", bits.alias("bits"), run.alias("run")).filter("bits <> 0 OR run IS NOT NULL"), "repeats")
    dropped(places)
    return marks


def covered(at: np.ndarray, bits: np.ndarray, run: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words are covered by the windows that (at, bits, run) mark; run is 0 where bits count."""
    edge = np.zeros(n + 1, np.int64)
    for place in range(int(bits.max()).bit_length() if len(bits) else 0):
        begin = np.minimum(at[(bits >> place) & 1 == 1] + place, n)
        np.add.at(edge, begin, 1)
        np.add.at(edge, np.minimum(begin + window, n), -1)
    long = run > 0
    np.add.at(edge, np.minimum(at[long], n), 1)
    np.add.at(edge, np.minimum(at[long] + run[long] - 1 + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """`docs` (doc_id, text) with n_words, n_removed and kept_text.

    kept_text is the kept words joined by one space where words were removed, else the text as it is.
    Columns of `docs` with one of the three names are replaced.
    """
    hits = repeated_windows(docs.select("doc_id", "text"), window, anchor)
    marks = written(hits.groupBy("doc_id").agg(F.collect_list(F.struct("at", "bits", F.coalesce("run", F.lit(0)).alias("run"))).alias("__marks")), "marks")
    dropped(hits)
    rows = docs.join(marks, "doc_id", "left")
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_words", "n_removed", "kept_text")]
    kept = rows.select("doc_id", *others, "text", "__marks")
    schema = kept.drop("__marks").schema.add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept_text", T.StringType())
    names = schema.names

    def cut(it):
        for batch in batches(it):
            sizes, removed, texts = [], [], []
            marks = batch.column(batch.num_columns - 1)
            for text, mark in zip(batch.column(batch.num_columns - 2), marks, strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = raw.split()
                gone = np.zeros(0, bool)
                if mark.is_valid:
                    at, bits, run = (np.asarray(mark.values.field(i)) for i in (0, 1, 2))
                    gone = covered(at, bits, run, len(words), window)
                    raw = b" ".join(compress(words, (~gone).tolist()))
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                texts.append(raw if text.is_valid else None)
            new = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=names)

    return kept.mapInArrow(cut, schema)


def kept_digests(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) of every row."""
    rows = without_repeats(docs.select("doc_id", "text"), window, anchor)

    def digest(it):
        for batch in batches(it):
            shas = []
            for text in batch.column(3):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shas)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    columns = rows.select("doc_id", "n_words", "n_removed", "kept_text")
    return columns.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
