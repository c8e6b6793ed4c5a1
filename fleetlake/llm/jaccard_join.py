"""Exact Jaccard join of word-shingle sets, with the components its links form.

Two texts link when 100 * |intersection| >= percent * |union| of their sets of distinct `width`-word
shingles (A-Z lower-cased). A text with fewer words is one shingle; one without words has no set.

1. Texts with equal sets are one class, represented by the lowest doc_id. Everything below is about
   classes.
2. Shingles are ordered by how often they occur in the corpus, rarest first. They are counted in parts of
   the hash range, by 42 bits; any order gives the same links, so collisions cost time only. Those that
   occur once are in no two sets: they count in a prefix, but only repeated ones go back to their text.
   So a passage that many texts share comes last, and keys are left to near copies.
3. With this order, linked sets of n shingles share one among their first n - ceil(t n) + 1, and two
   among their first n - ceil(t n) + 2. A shingle that more than `frequent` prefixes hold is indexed
   in pairs, all others singly: a prefix that shares no rare shingle and at most one frequent one
   leaves too few for a link. Sets so small that one shared shingle links them are indexed singly too.
   For the first key two linked sets share, what follows it in either set, and one frequent shingle
   that precedes a single key, bound what they share; pairs of a key that this rules out are never formed, and a
   set for which it rules out even the smallest one under a key is not indexed there.
4. Of the classes under one key all are compared with one leader, at first the one with the fewest rarer shingles, and links join them to one
   component. Other leaders follow, up to `rounds`, while they still join many classes and the keys
   that hold several components are large; then all pairs of a key from different components are compared. Pairs that components already
   join are never formed, so a large group of near copies costs a multiple of its rows, not its square. Keys that hold
   the same classes, such as those of one shared passage, form their pairs once, by the first place that the classes have one of them.
5. Compared pairs are first held against counts per hash bucket, which bound what two sets can share,
   and those that remain are verified on their whole sets.

Null and empty texts have no shingles and are their own component. Rows without doc_id are left out
of the join and come back with a null component. Rows that repeat a doc_id count as one document.
Shingles are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import BASES, batches, binary_column, bound_batches, dropped, mixed, packed, span_hashes, text_bytes, words_of, written
from fleetlake.llm.components import components

WIDTH = 3
#: Shingles are counted by parts of the hash range; a task sends those of its texts in groups of about GROUP shingles.
PARTS, GROUP = 1 << 10, 1 << 18
BUCKETS, FULL = 256, 65_535
#: How many classes a key holds, and which: keys with equal columns hold the same ones.
SAME = ["members", "one", "two"]


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted within it, and where each text's begin."""
    words = words_of(column, lower=True)
    n, total = len(words.bounds) - 1, len(words.doc)
    hashes = words.hashes()
    count = np.diff(words.first)
    begin = np.arange(max(total - width + 1, 0))
    begin = begin[words.doc[begin] == words.doc[begin + width - 1]] if len(begin) else begin
    short = np.flatnonzero((count > 0) & (count < width))
    keys = np.concatenate([span_hashes(hashes, begin, begin + width, BASES[1]), span_hashes(hashes, words.first[short], words.first[short + 1], BASES[1]) ^ np.uint64(1)])
    doc = np.concatenate([words.doc[begin], short])
    keys = mixed(keys)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(n + 1))


def _sums(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(keys, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, one, two, counts) of every text: sums that tell its set, and how many shingles fall into
    each of BUCKETS hash buckets."""

    def profile(it):
        for batch in batches(it):
            keys, bounds = shingle_sets(batch.column(1), width)
            one, two = (pa.array(_sums(k, bounds).view(np.int64)) for k in (keys, mixed(keys ^ np.uint64(BASES[3]))))
            n = np.diff(bounds)
            place = np.repeat(np.arange(len(n)), n) * BUCKETS + (keys >> np.uint64(56)).astype(np.int64)
            counts = np.minimum(np.bincount(place, minlength=len(n) * BUCKETS), FULL).astype(np.uint16)
            counts = binary_column(packed(counts, np.arange(len(n) + 1) * BUCKETS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int32)), one, two, counts], names=["doc_id", "n", "one", "two", "counts"])

    return docs.mapInArrow(profile, "doc_id long, n int, one long, two long, counts binary")


#: The shingles of a group of texts that lie in one part of the hash range: `cells` are 32 bits of each, in order,
#: `owners` the numbers of their texts in the group. One part's row also has the group's ids and set sizes.
CELLS = "grp long, part int, cells binary, owners binary, ids binary, sizes binary"


def _cells(docs: DataFrame, width: int) -> DataFrame:
    """The shingles of all texts as rows of CELLS. The number of a task tells its groups apart, so `docs`
    should come from files, whose rows a repeated task meets in the same order."""

    def rows(group: int, held: list) -> pa.RecordBatch:
        sizes = np.concatenate([n for _, _, n in held])
        keys, owner = np.concatenate([k for _, k, _ in held]), np.repeat(np.arange(len(sizes)).astype(np.uint16), sizes)
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        ends = np.searchsorted(keys >> np.uint64(54), np.arange(PARTS + 1).astype(np.uint64))
        with_ids = group % PARTS
        parts = np.flatnonzero((np.diff(ends) > 0) | (np.arange(PARTS) == with_ids))
        values = packed((keys >> np.uint64(22)).astype(np.uint32), ends), packed(owner, ends)
        extra = np.concatenate([i for i, _, _ in held]).tobytes(), sizes.astype(np.int32).tobytes()
        columns = [binary_column([v[i] for i in parts]) for v in values] + [binary_column([e if i == with_ids else None for i in parts]) for e in extra]
        names = ["grp", "part", "cells", "owners", "ids", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), group)), pa.array(parts.astype(np.int32)), *columns], names=names)

    def pack(it):
        group, held, size = TaskContext.get().partitionId() << 32, [], 0
        for whole in batches(it):
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                keys, bounds = shingle_sets(batch.column(1), width)
                held.append((np.asarray(batch.column(0)), keys, np.diff(bounds)))
                size += len(keys)
                if size >= GROUP or len(held) == 64:
                    yield rows(group, held)
                    group, held, size = group + 1, [], 0
        if held:
            yield rows(group, held)

    return docs.mapInArrow(pack, CELLS)


def _column(rows: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, and how many each row has."""
    read = [text_bytes(chunk) for chunk in rows.column(name).chunks]
    data = np.concatenate([d for d, _ in read] or [np.zeros(0, np.uint8)])
    return data.view(kind), np.concatenate([np.diff(b) for _, b in read] or [np.zeros(0, np.int64)]) // np.dtype(kind).itemsize


def _repeated(rows: pa.Table) -> pa.Table:
    """Of one part's rows of CELLS the shingles that occur more than once, with `times`."""
    cells, sizes = _column(rows, "cells", np.uint32)
    owners, _ = _column(rows, "owners", np.uint16)
    order = np.argsort(cells, kind="stable")
    new = np.flatnonzero(np.diff(cells[order], prepend=~cells[order[:1]]))  # the first one of each run
    runs = np.diff(new, append=len(cells))
    times = np.empty(len(cells), np.uint32)
    times[order] = np.repeat(runs, runs)
    keep = times > 1
    ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(sizes)])]
    columns = [binary_column(packed(v[keep], ends)) for v in (cells, owners, times)]
    columns = [rows.column("grp"), rows.column("part"), *columns, rows.column("ids"), rows.column("sizes")]
    table = pa.table(columns, names=["grp", "part", "cells", "owners", "times", "ids", "sizes"])
    return table.filter(pc.or_(pa.array(np.diff(ends) > 0), pc.is_valid(table.column("ids"))))


def _prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, alone, keys): of the first n - ceil(t n) + 2 shingles, rarest first, those that occur in
    other texts as well, and how many of the set's occur in no other; texts without such keys are left out."""

    def cut(rows: pa.Table) -> pa.Table:
        ids, n = _column(rows, "ids", np.int64)[0], _column(rows, "sizes", np.int32)[0].astype(np.int64)
        cells, each = _column(rows, "cells", np.uint32)
        tokens = (np.repeat(np.asarray(rows.column("part")).astype(np.int64), each) << 32) | cells.astype(np.int64)
        doc, times = _column(rows, "owners", np.uint16)[0].astype(np.int64), _column(rows, "times", np.uint32)[0]
        order = np.lexsort((tokens, times, doc))
        shared = np.bincount(doc, minlength=len(n))
        need = np.clip(n - (n * percent + 99) // 100 + 2 - (n - shared), 0, shared)
        place = np.arange(len(doc)) - (np.cumsum(shared) - shared)[doc[order]]
        take = order[place < need[doc[order]]]
        ends = np.concatenate([[0], np.cumsum(need)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[take]))
        columns = [pa.array(ids), pa.array(n.astype(np.int32)), pa.array((n - shared).astype(np.int32)), lists]
        return pa.table(columns, names=["doc_id", "n", "alone", "keys"]).filter(pa.array(need > 0))

    met = _cells(docs, width).groupBy("part").applyInArrow(_repeated, CELLS.replace("ids", "times binary, ids"))
    return met.groupBy("grp").applyInArrow(cut, "doc_id long, n int, alone int, keys array<long>")


def _possible(pairs: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The `pairs` (a, b) whose sets may link: two sets share at most what their counts per hash bucket share."""
    left = counts.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("of_a"))
    right = counts.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("of_b"))

    def bound(it):
        for batch in batches(it):
            x, y = (text_bytes(batch.column(i))[0].view(np.uint16).reshape(-1, BUCKETS).astype(np.int64) for i in (4, 5))
            n = np.asarray(batch.column(2)).astype(np.int64) + np.asarray(batch.column(3))
            least = np.minimum(x, y)
            most = np.where((least == FULL).any(axis=1), n, least.sum(axis=1))
            keep = pa.array((100 + percent) * most >= percent * n)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], names=["a", "b"])

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "of_a", "of_b")
    return rows.mapInArrow(bound, "a long, b long")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def pack(it):
        for batch in batches(it):
            keys, bounds = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_column(packed(keys, bounds))], names=["doc", "shingles"])

    return docs.mapInArrow(pack, "doc long, shingles binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` (a, b) with `linked`, verified on whole sets."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("of_b"))

    def verify(it):
        for batch in batches(it):
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    return rows.mapInArrow(verify, "a long, b long, linked boolean")


def index_keys(prefixes: DataFrame, frequent: int, percent: int) -> DataFrame:
    """(key, doc, n, pos): single rare shingles and pairs of frequent ones, for keys of two classes or more.

    Linked sets differ in size by a factor of 100 / percent at most. A key therefore also holds one of
    two neighbouring steps of the logarithm of the size, of which two such sets share at least one.
    `pos` is how many shingles of a set cannot be shared if the key is the first that two sets share:
    those before the key's first shingle, but for one if a frequent one, which has no key alone, is among them.
    """
    exploded = prefixes.select(F.col("doc_id").alias("doc"), "n", "alone", F.posexplode("keys").alias("pos", "token"))
    exploded = exploded.select("doc", "n", (F.col("alone") + F.col("pos")).alias("pos"), "token")
    # Counts are written before they are joined: next to a plain scan Spark can split a hot key.
    counts = written(exploded.groupBy("token").count().filter("count > 1"), "token-counts")
    shared = written(exploded.join(counts, "token"), "prefix-tokens")
    rare = shared.filter((F.col("count") <= frequent) | (F.col("n") * percent <= 100))
    often = shared.filter(F.col("count") > frequent).groupBy("doc", "n")
    often = often.agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("tokens"))
    heads = often.select("doc", F.col("tokens")[0]["pos"].alias("head"))
    behind = F.coalesce(F.col("head") < F.col("pos"), F.lit(False)).cast("int")
    rare = rare.join(heads, "doc", "left").select(F.col("token").alias("key"), "doc", "n", (F.col("pos") - behind).alias("pos"))
    first = often.select("doc", "n", "tokens", F.posexplode("tokens").alias("i", "x"))
    later = F.slice("tokens", F.col("i") + 2, F.size("tokens"))
    pairs = first.select("doc", "n", "x", F.explode(later).alias("y"))
    pairs = pairs.select(F.xxhash64("x.token", "y.token").alias("key"), "doc", "n", F.col("x.pos").alias("pos"))
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) * (1 - 1e-9)) if percent < 100 else F.col("n").cast("long")
    sized = rare.unionByName(pairs).withColumn("step", F.explode(F.array(step, step + 1)))
    sized = sized.select(F.xxhash64("key", "step").alias("key"), "doc", "n", "pos")
    several = sized.groupBy("key").agg(F.count("*").alias("count"), F.min("n").alias("least")).filter("count > 1")
    several = written(several.select("key", "least"), "key-counts")
    # What too little follows the key in for a link even to the smallest set there forms no pair of this key.
    able = (100 + percent) * (F.col("n") - F.col("pos")) >= percent * (F.col("n") + F.col("least"))
    keys = written(sized.join(several, "key").filter(able).drop("least"), "index-keys")
    dropped(counts, shared, several)
    return keys


def _near_labels(links: DataFrame) -> DataFrame:
    """(node, component): the lowest node at most two links away, which is one label for each leader's
    star. Nodes of one label are connected; the reverse need not hold and is settled at the end."""
    both = links.union(links.select("b", "a"))
    one = both.groupBy("a").agg(F.least("a", F.min("b")).alias("component"))
    far = both.join(one.select(F.col("a").alias("b"), "component"), "b")
    return far.groupBy("a").agg(F.least("a", F.min("component")).alias("component")).withColumnRenamed("a", "node")


def class_links(docs: DataFrame, width: int = WIDTH, percent: int = 90, frequent: int = 1000, rounds: int = 8):
    """(classes: doc_id, n, class_id of every text with a set, labels: node, component of linked classes).

    `docs` has doc_id and text.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    profiles = written(_profiles(docs, width), "shingle-profiles")
    texts = profiles.filter("n > 0")
    ids = written(texts.groupBy("n", "one", "two").agg(F.min("doc_id").alias("class_id")), "classes")
    classes = written(texts.join(ids, ["n", "one", "two"]).select("doc_id", "n", "class_id"), "class-members")
    prefixes = written(_prefixes(docs, width, percent), "prefixes")
    owners = ids.select(F.col("class_id").alias("doc_id"))
    keys = index_keys(prefixes.join(owners, "doc_id", "left_semi"), frequent, percent)
    dropped(prefixes)
    counts = profiles.select("doc_id", "n", "counts")
    labels = tested = links = None
    earlier = 0
    for turn in range(rounds + 1):
        state = keys.withColumn("comp", F.col("doc"))
        if labels is not None:
            own = labels.select(F.col("node").alias("doc"), "component")
            state = keys.join(own, "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
        order = F.struct((F.col("pos") if turn % 2 == 0 else F.lit(0)).alias("least"), F.xxhash64("doc", F.lit(turn)).alias("mix"), "doc")
        groups = state.groupBy("key").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(F.struct(order.alias("by"), "n", "pos", "comp")).alias("lead"), F.count("*").alias("members"),
            *[F.bit_xor(F.xxhash64("doc", F.lit(i))).alias(name) for i, name in enumerate(SAME[1:])],
        )
        groups = written(groups.filter("low <> high"), "key-groups")
        active = written(state.join(groups, "key"), "active-keys")
        apart = F.col("comp") != F.col("lead.comp")
        busy = active.agg(F.count("*"), F.sum(F.when(apart, F.col("members")))).first()
        if not busy[0]:
            dropped(active, groups)
            break
        last = turn == rounds or (turn and (busy[1] <= 12 * busy[0] or busy[1] > 0.8 * earlier))
        earlier = busy[1]
        if last:
            met = active.groupBy(*SAME, "doc").agg(*[F.min(c).alias(c) for c in ("n", "pos", "comp", "low")])
            met = written(met, "class-groups")
            x = met.filter("comp <> low").select(*SAME, F.col("doc").alias("x"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("comp").alias("of"))
            rows = x.join(met.drop("low"), SAME).filter("of <> comp")
        else:
            lead = [F.col(f"lead.{c}").alias(d) for c, d in (("by.doc", "x"), ("n", "m"), ("pos", "at"), ("comp", "of"))]
            rows = active.select("doc", "n", "pos", "comp", *lead).filter("of <> comp")
        most = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
        rows = rows.filter((100 + percent) * most >= percent * (F.col("n") + F.col("m")))
        rows = rows.select(F.least("doc", "x").alias("a"), F.greatest("doc", "x").alias("b")).distinct()
        if tested is not None:
            rows = rows.join(tested, ["a", "b"], "left_anti")
        rows = written(rows, "pairs")
        dropped(active, groups, *([met] if last else []))
        tested = rows if tested is None else tested.unionByName(rows)
        near = written(_possible(rows, counts, percent), "possible-pairs")
        wanted = written(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), "paired")
        sets = written(_sets(docs.join(wanted, "doc_id", "left_semi"), width), "shingle-sets")
        checked = written(_linked(near, sets, percent), "checked-pairs")
        dropped(sets, near, wanted)
        found = checked.filter("linked").select("a", "b")
        links = found if links is None else links.unionByName(found)
        if last:
            break
        labels = written(_near_labels(links), "near-labels")
    if links is None:
        links = ids.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")).limit(0)
    found = components(links)
    dropped(*([links, tested] if tested is not None else []), keys, profiles, ids)
    return classes, found


def linked_components(docs: DataFrame, width: int = WIDTH, percent: int = 90, frequent: int = 1000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text)."""
    classes, labels = class_links(docs, width, percent, frequent)
    own = labels.select(F.col("node").alias("class_id"), "component")
    known = classes.join(own, "class_id", "left").select("doc_id", "n", F.coalesce("component", "class_id").alias("component_id"))
    known = known.dropDuplicates(["doc_id"])
    rows = docs.select("doc_id").join(known, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
