"""Gradient-boosted trees grown leaf by leaf from histograms that Spark sums.

Features are cut into at most 255 bins at approximate quantiles. For a tree, each pass over the rows adds
gradients, curvatures and counts up per (node, feature, bin) on the executors; only the smaller child of a
split is counted, its sibling is what is left of the parent. A pass covers the children of every split
found so far, so a tree takes as many passes as it may be deep: the sums of the last leaves stand in their
parents'. The tree itself is then grown from the known
splits best gain first up to the leaf cap. Gradients are integers (multiples of 2**-24), so sums, and with
them trees, depend neither on partitions nor on order.

Rows lie in packed blocks with their present score, written anew every REWRITE trees; a lost executor
costs at most the passes since then. What reaches the driver is bounded by leaves x features x bins.
A pass is a Spark job, whose fixed cost is all that a small table pays for: where rows x features stay
within TASK_CELLS, and there are trees for it, the same trees are grown in the one task that holds the blocks.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.session import scratch_dir

BINS, UNIT, BLOCK_ROWS, REWRITE, FEW = 256, float(1 << 24), 65_536, 20, 8
#: Rows times features that one task trains on, and that a task of a cached RDD passes over.
TASK_CELLS, PASS_CELLS = 1 << 24, 1 << 24
BLOCKS = "n long, bins binary, label binary, weight binary, held binary, score binary"
HELD_OUT = -1


class Split(NamedTuple):
    gain: float
    feature: int
    bin: int


class Tree(NamedTuple):
    """Nodes numbered from the root, 0; a leaf has feature -1. Rows of bin <= cut, or of value <= at, go left."""

    feature: np.ndarray
    cut: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def places(self, columns, limits: np.ndarray) -> np.ndarray:
        """The node each row ends in; `columns[f]` is compared with the limit of the node."""
        columns = np.asarray(columns)
        node = np.zeros(columns.shape[1], np.int64)
        for _ in range(len(self.feature)):
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                break
            own = node[inner]
            values = columns[self.feature[own], inner]
            node[inner] = np.where(values <= limits[own], self.left[own], self.right[own])
        return node


class Model(NamedTuple):
    features: list
    start: float
    trees: list
    losses: list  # mean held-out loss after each number of trees, from 0 on

    def margins(self, columns) -> np.ndarray:
        columns = np.asarray(columns)
        total = np.full(columns.shape[1], self.start)
        for tree in self.trees:
            total += tree.value[tree.places(columns, tree.at)]
        return total

    def probability(self) -> Column:
        """The probability of class 1 as a column of the features; missing numbers count as 0."""
        model = self

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            values = [c.fillna(0).to_numpy(float) for c in columns]
            return pd.Series(1 / (1 + np.exp(-model.margins(values))))

        return score(*[F.col(c).cast("double") for c in self.features])


def cut_points(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Up to bins - 1 increasing bounds per feature, the last of several equal quantiles counting once."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 20_000).alias(f"_{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(found[i] or [], float)) for i in range(len(features))]


def blocks_of(rows: DataFrame, features: list[str], label: str, weight: str, held: str, cuts: list[np.ndarray], start: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    def pack(it):
        for batch in it:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                values = [np.asarray(c.fill_null(0.0), float) for c in part.columns]
                bins = np.stack([np.searchsorted(c, x) for c, x in zip(shared.value, values, strict=False)], axis=1).astype(np.uint8)
                y, w, h = values[len(features) :]
                columns = [bins.tobytes(), y.tobytes(), w.tobytes(), h.astype(bool).tobytes(), np.full(len(y), start).tobytes()]
                arrays = [pa.array([part.num_rows], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BLOCKS.split(", ")])

    chosen = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_{i}") for i, c in enumerate([*features, label, weight, held])]
    return rows.select(*chosen).mapInArrow(pack, BLOCKS)


def unpacked(batch: pa.RecordBatch):
    """(bins by feature, label, weight, held, score) of each block."""
    for row in batch.to_pylist():
        yield unpacked_block(*row.values())


def unpacked_block(n, bins, label, weight, held, score) -> tuple:
    columns = np.ascontiguousarray(np.frombuffer(bins, np.uint8).reshape(n, -1).T)
    return columns, np.frombuffer(label), np.frombuffer(weight), np.frombuffer(held, bool), np.frombuffer(score)


def gradients(y, w, score) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer gradients and curvatures of the weighted logistic loss, and the loss itself without weights."""
    p = 1 / (1 + np.exp(-score))
    loss = np.logaddexp(0, score) - y * score
    return np.rint(w * (p - y) * UNIT), np.rint(w * p * (1 - p) * UNIT), np.rint(loss * UNIT)


def _advanced(columns, score, trees) -> np.ndarray:
    for tree in trees:
        score = score + tree.value[tree.places(columns, tree.cut)]
    return score


def _add_cells(totals: np.ndarray, columns: np.ndarray, own: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
    """Add the rows `own`, each to the cells of its slot, to the (3, slots * features * BINS) totals."""
    first, g, h = slot * (len(columns) * BINS), g[own], h[own]
    for f, bins in enumerate(columns):
        cell = first + bins[own] + f * BINS
        for j, values in enumerate((g, h, None)):
            totals[j] += np.bincount(cell, values, totals.shape[1]).astype(np.int64)


def _added(parts, trees: list, tree: Tree, wanted: dict) -> list:
    """[cells, gradients, curvatures, rows] of unpacked blocks, empty without any; the loss goes by HELD_OUT."""
    table = np.full(len(tree.feature), -1)
    for node, slot in wanted.items():
        table[node] = slot
    totals, loss, held_rows = None, 0, 0
    for columns, y, w, held, score in parts:
        if totals is None:
            totals = np.zeros((3, len(wanted) * len(columns) * BINS), np.int64)
        score = _advanced(columns, score, trees)
        g, h, losses = gradients(y, w, score)
        loss += int(losses[held].sum())
        held_rows += int(held.sum())
        slot = np.where(held, -1, table[tree.places(columns, tree.cut)])
        own = np.flatnonzero(slot >= 0)
        _add_cells(totals, columns, own, slot[own], g, h)
    if totals is None:
        return []
    used = np.flatnonzero(totals[2])
    sums = [np.append(totals[0][used], loss), np.append(totals[1][used], 0), np.append(totals[2][used], held_rows)]
    return [np.append(used, HELD_OUT), *sums]


def histograms(blocks: DataFrame | RDD, recent: list, shape: Tree, nodes: list[int], features: int) -> tuple[dict, float | None]:
    """(features, BINS, 3) sums of every one of `nodes` over the rows not held out, and the mean loss of the
    held-out rows before this tree.

    Blocks of many tasks are summed by a shuffle. Those of a few tasks come as an RDD: the sums of each are
    added here, and a pass has no plan to make and no table to broadcast.
    """
    slots = {node: i for i, node in enumerate(nodes)}
    if isinstance(blocks, RDD):
        found = [x for x in blocks.mapPartitions(lambda it: [_added((unpacked_block(*b) for b in it), recent, shape, slots)]).collect() if x]
        cells, *sums = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64) for _ in range(4))
    else:
        shared = blocks.sparkSession.sparkContext.broadcast((recent, shape, slots))

        def add(it):
            found = _added((part for batch in it for part in unpacked(batch)), *shared.value)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["cell", "g", "h", "n"])

        rows = blocks.mapInArrow(add, "cell long, g long, h long, n long")
        rows = rows.groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n"))
        cells, *sums = (np.asarray(c.combine_chunks()) for c in rows.toArrow().columns)
        shared.unpersist()
    held, real = cells == HELD_OUT, cells != HELD_OUT
    table = np.zeros((len(slots) * features * BINS, 3), np.int64)
    np.add.at(table, cells[real], np.stack([s[real] for s in sums], axis=1))
    table = table.reshape(len(slots), features, BINS, 3)
    loss, _, rows_held = (int(s[held].sum()) for s in sums)
    loss = loss / rows_held / UNIT if rows_held else None
    return {node: table[slot] for node, slot in slots.items()}, loss


def best_split(hist: np.ndarray, min_rows: int, penalty: float) -> Split | None:
    """The split of highest gain, the lowest feature and bin of several; None if nothing is gained."""
    left = np.cumsum(hist, axis=1)[:, :-1]
    total = hist.sum(axis=1)[:, None]
    right = total - left
    term = lambda s: (s[..., 0] / UNIT) ** 2 / (s[..., 1] / UNIT + penalty)
    fits = (left[..., 2] >= min_rows) & (right[..., 2] >= min_rows) & (left[..., 1] > 0) & (right[..., 1] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, term(left) + term(right) - term(total), -np.inf)
    at = int(np.argmax(gain))
    feature, cut = divmod(at, gain.shape[1])
    return Split(float(gain[feature, cut]), feature, cut) if gain[feature, cut] > 1e-9 else None


class Growth:
    """A tree in the making: every split found so far is taken, whatever its gain, up to `depth`."""

    def __init__(self, cuts: list[np.ndarray], depth: int, min_rows: int, penalty: float):
        self.cuts, self.depth, self.min_rows, self.penalty = cuts, depth, min_rows, penalty
        self.levels, self.sums, self.split, self.children = [0], {}, {}, {}

    def add(self, node: int, hist: np.ndarray) -> None:
        self.sums[node] = hist
        found = best_split(hist, self.min_rows, self.penalty) if self.levels[node] < self.depth else None
        if found:
            self.split[node] = found
            self.children[node] = (len(self.levels), len(self.levels) + 1)
            self.levels += [self.levels[node] + 1] * 2

    def shape(self, chosen=None, rate: float = 0.0) -> tuple[Tree, dict]:
        """The tree of all splits, or of the chosen ones with leaf values; and its number for each node."""
        inner = self.split if chosen is None else chosen
        order, at = [0], 0
        while at < len(order):
            order += self.children[order[at]] if order[at] in inner else ()
            at += 1
        place = {node: i for i, node in enumerate(order)}
        rows = []
        for node in order:
            if node in inner:
                found, (left, right) = self.split[node], self.children[node]
                rows.append((found.feature, found.bin, self.cuts[found.feature][found.bin], place[left], place[right], 0.0))
            else:
                rows.append((-1, 0, 0.0, 0, 0, self.value(node) * rate if rate else 0.0))
        return Tree(*(np.array(c) for c in zip(*rows, strict=True))), place

    def value(self, node: int) -> float:
        g, h, _ = self.sums[node][0].sum(axis=0)
        return float(-(g / UNIT) / (h / UNIT + self.penalty)) if h > 0 else 0.0

    def chosen(self, leaves: int) -> set:
        """Splits taken best gain first until there are `leaves` leaves; of equal gains the older node's."""
        taken, heap = set(), [(-self.split[0].gain, 0)] if 0 in self.split else []
        while heap and len(taken) < leaves - 1:
            _, node = heapq.heappop(heap)
            taken.add(node)
            for child in self.children[node]:
                if child in self.split:
                    heapq.heappush(heap, (-self.split[child].gain, child))
        return taken


class Held:
    """Blocks in the memory of one task: the score of every row, and its node in the tree that grows."""

    def __init__(self, blocks):
        parts = zip(*(unpacked_block(*b) for b in blocks), strict=True)
        self.bins, self.y, self.w, self.held, self.score = (np.concatenate(c, axis=-1) for c in parts)

    def begin(self) -> float | None:
        """Start a tree; the mean loss of the held-out rows before it."""
        self.node = np.where(self.held, -1, 0)
        self.g, self.h, losses = gradients(self.y, self.w, self.score)
        return int(losses[self.held].sum()) / int(self.held.sum()) / UNIT if self.held.any() else None

    def histograms(self, growth: Growth, nodes: list[int]) -> dict:
        """(features, BINS, 3) sums of every one of `nodes` over the rows not held out."""
        table = np.full(len(growth.levels) + 1, -1)  # the last place: held-out rows, whose node is -1
        self._descend(growth, self.node)
        table[nodes] = np.arange(len(nodes))
        slot = table[self.node]
        own = np.flatnonzero(slot >= 0)
        totals = np.zeros((3, len(nodes) * len(self.bins) * BINS), np.int64)
        _add_cells(totals, self.bins, own, slot[own], self.g, self.h)
        return dict(zip(nodes, totals.T.reshape(len(nodes), len(self.bins), BINS, 3), strict=True))

    def _descend(self, growth: Growth, node: np.ndarray) -> None:
        """Move rows from the nodes that have been split since, in place."""
        splits = np.full((5, len(growth.levels) + 1), -1)
        for parent, (_, feature, cut) in growth.split.items():
            splits[:, parent] = (1, feature, cut, *growth.children[parent])
        while len(inner := np.flatnonzero(splits[0][node] > 0)):
            own = node[inner]
            values = self.bins[splits[1][own], inner]
            node[inner] = np.where(values <= splits[2][own], splits[3][own], splits[4][own])

    def advance(self, growth: Growth, chosen: set, rate: float) -> None:
        """Add the finished tree to the scores, the held-out rows' too."""
        leaf = list(range(len(growth.levels)))
        for parent, children in growth.children.items():  # parents come before their children
            for child in children:
                leaf[child] = child if parent in chosen else leaf[parent]
        values = np.array([growth.value(node) * rate for node in leaf])
        node = np.where(self.held, 0, self.node)
        self._descend(growth, node)
        self.score = self.score + values[node]


def grown(blocks: DataFrame | RDD | Held, recent: list, cuts: list[np.ndarray], leaves: int, depth: int, rate: float, min_rows: int, penalty: float) -> tuple[Tree, float | None]:
    """The next tree and the held-out loss before it."""
    growth, loss, wanted = Growth(cuts, depth, min_rows, penalty), None, [0]
    pairs: list[tuple[int, int, int]] = []
    if isinstance(blocks, Held):
        loss = blocks.begin()
    while wanted:
        if isinstance(blocks, Held):
            found = blocks.histograms(growth, wanted)
        else:
            shape, place = growth.shape()
            sums, now = histograms(blocks, recent, shape, [place[n] for n in wanted], len(cuts))
            loss = now if loss is None else loss
            found = {n: sums[place[n]] for n in wanted}
        for parent, small, large in pairs:
            found[large] = growth.sums[parent] - found[small]
        before = set(growth.split)
        for node in sorted(found):
            growth.add(node, found[node])
        pairs, wanted = [], []
        for parent in sorted(set(growth.split) - before):
            cut, (left, right) = growth.split[parent], growth.children[parent]
            if growth.levels[left] == depth:  # leaves for certain: their sums stand in the parent's
                below, whole = growth.sums[parent][cut.feature, : cut.bin + 1].sum(axis=0), growth.sums[parent][cut.feature].sum(axis=0)
                growth.sums[left], growth.sums[right] = below[None, None], (whole - below)[None, None]
                continue
            n = growth.sums[parent][cut.feature, : cut.bin + 1, 2].sum()
            small, large = (left, right) if 2 * n <= growth.sums[parent][0, :, 2].sum() else (right, left)
            pairs.append((parent, small, large))
            wanted.append(small)
    chosen = growth.chosen(leaves)
    if isinstance(blocks, Held):
        blocks.advance(growth, chosen, rate)
    return growth.shape(chosen, rate)[0], loss


def _ended(tree: Tree, losses: list, patience: int) -> bool:
    """Whether the tree is no longer wanted: it has no split, or the loss has not fallen for `patience` rounds."""
    return len(tree.feature) == 1 or bool(losses) and len(losses) - 1 - int(np.argmin(losses)) >= patience


def _grown_in_task(held: Held, trees: int, patience: int, *setting) -> tuple[list, list]:
    """All trees and held-out losses of `fit`."""
    made, losses = [], []
    while len(made) < trees:
        tree, loss = grown(held, [], *setting)
        losses += [] if loss is None else [loss]
        if _ended(tree, losses, patience):
            break
        made.append(tree)
    if losses and len(losses) == len(made):
        losses.append(held.begin())
    return made, losses


def _rewritten(blocks: DataFrame, recent: list) -> DataFrame:
    """Blocks whose scores include the recent trees, written to the scratch folder and kept in memory."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(recent)

    def advance(it):
        for batch in it:
            scores = [_advanced(columns, score, shared.value).tobytes() for columns, _, _, _, score in unpacked(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.binary())], names=batch.schema.names)

    path = scratch_dir(spark, "boosting")
    (blocks.mapInArrow(advance, BLOCKS) if recent else blocks).write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path).cache()


def _source(blocks: DataFrame, cells: int) -> DataFrame | RDD:
    """What the passes read: the blocks, or their rows as a cached RDD where few tasks can hold them."""
    rows = blocks.rdd
    if rows.getNumPartitions() > FEW and cells <= FEW * PASS_CELLS:
        rows = rows.coalesce(min(FEW, blocks.sparkSession.sparkContext.defaultParallelism))
    return rows.map(tuple).cache() if rows.getNumPartitions() <= FEW else blocks


def _moved_on(source: RDD, tree: Tree) -> RDD:
    """The rows with the tree in their scores, so that no pass goes through a finished tree again."""

    def advance(block):
        columns, _, _, _, score = unpacked_block(*block)
        return (*block[:-1], _advanced(columns, score, [tree]).tobytes())

    return source.map(advance).cache()


def fit(
    rows: DataFrame, features: list[str], label: str, weight: str | None = None, held_out: str | None = None, trees: int = 200, depth: int = 6,
    leaves: int = 31, rate: float = 0.05, patience: int = 20, min_rows: int = 20, penalty: float = 1e-3,
) -> Model:
    """Trees until the held-out loss has not fallen for `patience` rounds; those after its lowest point go.

    Null and NaN features count as 0. Without rows, or with one class, the model is a constant.
    """
    held = F.col(held_out) if held_out else F.lit(False)
    named = rows.select(*features, F.col(label).cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1.0)).alias("_w"), held.cast("double").alias("_held"))
    named = named.withColumns({c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features})
    base = named.where("_held = 0")
    n, ones = base.agg(F.coalesce(F.sum("_w"), F.lit(0.0)), F.coalesce(F.sum(F.col("_w") * F.col("_y")), F.lit(0.0))).first()
    if not n or not 0 < ones < n:
        return Model(features, math.inf if n and ones else -math.inf if n else 0.0, [], [])
    start = math.log(ones / (n - ones))
    cuts = cut_points(base, features)
    blocks = _rewritten(blocks_of(named, features, "_y", "_w", "_held", cuts, start), [])
    setting = (cuts, leaves, depth, rate, min_rows, penalty)
    cells = blocks.agg(F.sum("n")).first()[0] * len(features)
    if trees >= REWRITE and cells <= TASK_CELLS:
        task = blocks.coalesce(1).rdd.mapPartitions(lambda it: [_grown_in_task(Held(it), trees, patience, *setting)])
        made, losses = task.first()
    else:
        made, losses = _grown_by_passes(blocks, cells, trees, patience, *setting)
    blocks.unpersist()
    return Model(features, start, made[: int(np.argmin(losses))] if losses else made, losses)


def _grown_by_passes(blocks: DataFrame, cells: int, trees: int, patience: int, *setting) -> tuple[list, list]:
    """All trees and held-out losses of `fit`, every pass over the rows being a job."""
    first, made, recent, losses = blocks, [], [], []  # recent: trees that the scores of `blocks` lack
    source = older = _source(blocks, cells)
    while len(made) < trees:
        passing = [] if isinstance(source, RDD) else recent
        tree, loss = grown(source, passing, *setting)
        if older is not source:
            older.unpersist()
            older = source
        losses += [] if loss is None else [loss]
        if _ended(tree, losses, patience):
            break
        made.append(tree)
        recent.append(tree)
        if len(recent) == REWRITE:
            newer = _rewritten(blocks, recent)
            newer.count()
            source.unpersist()
            if blocks is not first:
                blocks.unpersist()
            blocks, recent = newer, []
            source = older = _source(newer, cells)
        elif isinstance(source, RDD):
            source = _moved_on(source, tree)
    if losses and len(losses) == len(made):
        root = Growth(setting[0], 0, *setting[4:]).shape()[0]
        losses.append(histograms(source, [] if isinstance(source, RDD) else recent, root, [0], len(setting[0]))[1])
    for held in (older, source, *([] if blocks is first else [blocks])):
        held.unpersist()
    return made, losses
