"""Exact duplicates through a cuckoo-filter index over content digests.

Texts are equal when they are identical after each run of `[\\x20\\x09-\\x0D]` became one space. The
content of a text is its SHA-256; the index holds 16-bit fingerprints of live digests, two candidate
buckets of four slots each, and every hit is verified against the digest stored for that slot. A full
index doubles and is rebuilt from the stored digests.

Every input partition runs its own index first and sends one row per distinct digest on, so a text
that fills a third of the table costs one row per partition. Digests are then dealt by hash and each
partition of them is merged by one more index.

Null texts count as empty. Rows without `doc_id` never become the kept row of a group that has ids; in
a group without any id all rows stay. Rows that repeat the kept id stay too. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches, bound_batches, dropped, written

SLOTS = 4
KICKS = 200


class CuckooIndex:
    """Digests (at least 10 bytes, evenly spread) with a number each; insert, find, delete."""

    def __init__(self, buckets: int = 256):
        self.keys: dict[int, bytes] = {}
        self.next = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.owners = [0] * (buckets * SLOTS)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") or 1
        one = int.from_bytes(key[:8], "little") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def _slot(self, key: bytes) -> int:
        mark, one, two = self._places(key)
        for bucket in (one, two):
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if self.prints[slot] == mark and self.keys[self.owners[slot]] == key:
                    return slot
        return -1

    def find(self, key: bytes) -> int:
        """The number of a live digest, -1 for any other."""
        slot = self._slot(key)
        return self.owners[slot] if slot >= 0 else -1

    def insert(self, key: bytes) -> int:
        """The number of the digest, given now if it was not live."""
        found = self.find(key)
        if found >= 0:
            return found
        number, self.next = self.next, self.next + 1
        self.keys[number] = key
        if not self._place(key, number):
            self._grow()
        return number

    def delete(self, key: bytes) -> bool:
        """Take a live digest out; False if it was not live."""
        slot = self._slot(key)
        if slot < 0:
            return False
        del self.keys[self.owners[slot]]
        self.prints[slot] = 0
        return True

    def _place(self, key: bytes, number: int) -> bool:
        mark, one, two = self._places(key)
        bucket = one
        for kick in range(KICKS):
            for at in ((one, two) if kick == 0 else (bucket,)):
                for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.owners[slot] = mark, number
                        return True
            slot = bucket * SLOTS + (mark + kick) % SLOTS
            self.prints[slot], mark = mark, self.prints[slot]
            self.owners[slot], number = number, self.owners[slot]
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        while True:
            self._clear(self.buckets * 2)
            if all(self._place(key, number) for number, key in self.keys.items()):
                return


def _indexed(it):
    """Rows (digest, lowest id, rows) of one partition, one per distinct digest."""
    index, least, rows = CuckooIndex(), [], []
    for batch in batches(it):
        columns = (batch.column(i).to_pylist() for i in range(3))
        for key, low, count in zip(*columns, strict=True):
            number = index.insert(key)
            if number == len(least):
                least.append(low)
                rows.append(count)
            else:
                rows[number] += count
                if low is not None and (least[number] is None or low < least[number]):
                    least[number] = low
    keys = list(index.keys.values())
    for at in range(0, len(keys), 10_000):
        part = slice(at, at + 10_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[part], pa.binary()), pa.array(least[part], pa.int64()), pa.array(rows[part], pa.int64())],
            names=["digest", "low", "n"],
        )


def normalised(text):
    """Runs of white space become one space. A single space already is one and costs no match."""
    white = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), white, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    digest = F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"))


def digest_groups(marks: DataFrame) -> DataFrame:
    """(digest, low, n) of each distinct digest of rows (doc_id, digest), by two levels of index."""
    bound_batches(marks.sparkSession)
    schema = "digest binary, low long, n long"
    single = marks.select("digest", F.col("doc_id").alias("low"), F.lit(1).cast("long").alias("n"))
    return single.mapInArrow(_indexed, schema).repartition("digest").mapInArrow(_indexed, schema)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    bound_batches(docs.sparkSession)
    marks = written(digests(docs, id_col, text_col), "digests")
    groups = digest_groups(marks)
    return marks.join(groups, "digest").select(
        "doc_id",
        F.col("low").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("low")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their own columns and whole texts.

    The list of the (id, digest) that go is written first, so its size is known: while it is small Spark
    sends it to the texts, and they are not shuffled.
    """
    bound_batches(docs.sparkSession)
    marks = written(digests(docs, id_col, text_col), "digests")
    gone = marks.join(digest_groups(marks), "digest").filter(~F.col("doc_id").eqNullSafe(F.col("low")))
    gone = written(gone.select(F.col("doc_id").alias("__gone_id"), F.col("digest").alias("__gone_digest")).distinct(), "gone")
    dropped(marks)
    rows = docs.withColumn("__own_digest", F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone_id")) & (F.col("__own_digest") == F.col("__gone_digest"))
    return rows.join(gone, same, "left_anti").drop("__own_digest")


def updated_index(index: DataFrame, inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """An index (digest, low, n: live rows) after rows (doc_id, digest) were added and taken out.

    Digests whose last live row goes leave the index. `low` stays the lowest id under which a text was
    ever live without a break, since the ids of its other rows are not stored. Deleting more rows of a
    digest than are live leaves it out.
    """
    added = digest_groups(inserts).withColumn("gone", F.lit(False))
    removed = digest_groups(deletes).withColumn("gone", F.lit(True))
    columns = ["digest", "low", "n", "gone"]
    stored = index.withColumn("gone", F.lit(False)).select(columns)
    rows = stored.unionByName(added.select(columns)).unionByName(removed.select(columns))
    ordered = rows.repartition("digest").sortWithinPartitions("digest", "gone")
    return ordered.mapInArrow(_updated, "digest binary, low long, n long")


def _updated(it):
    index, least, rows = CuckooIndex(), {}, {}
    for batch in batches(it):
        for key, low, count, gone in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            number = index.find(key)
            if not gone:
                number = index.insert(key)
                known = least.get(number)
                least[number] = low if known is None else known if low is None else min(known, low)
                rows[number] = rows.get(number, 0) + count
            elif number >= 0:
                rows[number] -= count
                if rows[number] <= 0:
                    index.delete(key)
    numbers = np.array(list(index.keys), np.int64).tolist()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([index.keys[n] for n in numbers], pa.binary()),
            pa.array([least[n] for n in numbers], pa.int64()),
            pa.array([rows[n] for n in numbers], pa.int64()),
        ],
        names=["digest", "low", "n"],
    )
