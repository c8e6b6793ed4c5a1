"""Exact duplicates, repeated passages and near duplicates against brute force."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import exact_dedup, jaccard_join, substring_dedup
from fleetlake.llm.components import components
from fleetlake.llm.exact_dedup import CuckooIndex
from tests.llm.helpers import LONG, WHITE, frame, linked, passages, shingles


def test_cuckoo_index_keeps_every_live_digest():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5_000)]
    index = CuckooIndex(buckets=4)
    numbers = [index.insert(k) for k in keys]
    assert numbers == list(range(5_000)) and index.buckets >= 1_250
    assert [index.insert(k) for k in keys] == numbers
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert [index.find(k) for k in keys] == [-1 if i % 2 == 0 else i for i in range(5_000)]
    assert index.insert(keys[0]) == 5_000


def test_cuckoo_index_verifies_equal_fingerprints():
    one, two = b"\x00" * 8 + b"\x01\x00" + b"a" * 22, b"\x00" * 8 + b"\x01\x00" + b"b" * 22
    index = CuckooIndex()
    assert index.insert(one) == 0 and index.find(two) == -1
    assert index.insert(two) == 1 and index.find(one) == 0
    many = [b"\x00" * 8 + b"\x01\x00" + i.to_bytes(22, "big") for i in range(8)]
    assert len({index.insert(k) for k in many[:6]}) == 6


def test_exact_groups(spark):
    texts = ["a b", "a\t\n b", "", None, "a  b", " a b", LONG, LONG, "A b", "a\xa0b", "a b", " ", "\n"]
    rows = {r["doc_id"]: r for r in exact_dedup.exact_groups(frame(spark, texts)).collect()}
    plain = [re.sub(WHITE, " ", t or "") for t in texts]
    for i, t in enumerate(plain):
        assert rows[i]["keep_id"] == plain.index(t) and rows[i]["group_size"] == plain.count(t)
        assert rows[i]["kept"] == (plain.index(t) == i)
        assert rows[i]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_rows_without_id_and_repeats(spark):
    docs = frame(spark, [(None, "x"), (3, "x"), (3, "x"), (5, "x"), (None, "y"), (7, "z")])
    docs = docs.withColumn("digest", F.lit(1)).withColumn("low", F.lit(2))
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [
        (False, 3, "x"), (False, 3, "x"), (False, 7, "z"), (True, 0, "y")]


def test_exact_index_update(spark):
    marks = exact_dedup.digests(frame(spark, ["a", "a", "b", "c"]))
    index = exact_dedup.digest_groups(marks)
    gone = exact_dedup.digests(frame(spark, [(0, "a"), (2, "b"), (8, "never")]))
    more = exact_dedup.digests(frame(spark, [(9, "c"), (10, "d")]))
    rows = exact_dedup.updated_index(index, more, gone).collect()
    sha = {hashlib.sha256(t.encode()).digest(): t for t in "abcd"}
    assert {sha[bytes(r["digest"])]: (r["low"], r["n"]) for r in rows} == {"a": (0, 1), "c": (3, 2), "d": (10, 1)}


def test_empty_tables(spark):
    none = frame(spark, ["x"]).limit(0)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert substring_dedup.kept_digests(none).count() == 0
    assert jaccard_join.linked_components(none.select("doc_id", "text")).count() == 0


def corpus(seed, n=60):
    """Texts that share passages, repeat themselves, are copies or nearly so."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a"] * 4 + [f"v{i}" for i in range(60)]
    take = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    common, line, texts = take(60), take(22), []
    for _ in range(n):
        kind, own = rng.random(), take(rng.randint(0, 120))
        at = rng.randint(0, len(own))
        if kind < 0.3:
            own[at:at] = common[rng.randint(0, 20) : rng.randint(40, 60)]
        elif kind < 0.4:
            own = own[:30] + line + own[30:50] + line + line + ["the"] * rng.randint(0, 45)
        elif kind < 0.7 and texts:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_against_brute_force(spark, seed):
    texts = corpus(seed) + ["", None, " \n", "one two"]
    docs = frame(spark, texts)
    expected = passages(list(enumerate(texts)))
    for r in substring_dedup.kept_digests(docs).collect():
        own, gone = expected[r["doc_id"]]
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        assert (r["n_words"], r["n_removed"]) == (len(own), sum(gone)), r
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_a_long_repeat_is_one_chain(spark, monkeypatch):
    """2,000 words in five texts, three of them copies: one chain but for the paths at its ends."""
    passage = " ".join(f"p{i}" for i in range(2000))
    texts = [f"a b c {passage} d e", f"x {passage} y", f"x {passage} y", f"{passage}", f"{passage} q {passage}", " ".join(f"z{i}" for i in range(300))]
    seen, real = [], substring_dedup.chains
    monkeypatch.setattr(substring_dedup, "chains", lambda places: seen.append(real(places)) or seen[-1])
    docs = frame(spark, texts)
    marks = substring_dedup.repeated_windows(docs.select("doc_id", "text")).collect()
    totals = {(r["head"], r["total"]) for r in seen[0].collect()}
    assert len([t for _, t in totals if t >= 1900]) == 1 and len(totals) <= 4
    assert len([r for r in marks if r["run"] and r["run"] >= 1900]) == 5  # one row for each copy after the first
    assert len(marks) < 60
    expected = passages(list(enumerate(texts)))
    for r in substring_dedup.kept_digests(docs).collect():
        assert r["n_removed"] == sum(expected[r["doc_id"]][1])


def test_chains_of_paths(spark):
    """Chains end where copies differ in number, where another path follows, and at the end of a text."""
    rows = [(doc, i) for doc in (1, 2, 3) for i in range(40)] + [(4, i) for i in range(10, 20)] + [(5, i) for i in range(30, 40)] + [(5, 60)]
    copies = {i: sum(j == i for _, j in rows) for _, i in rows}
    places = spark.createDataFrame([(i, copies[i], 2 + i % 3, doc, sum(2 + j % 3 for d, j in rows if d == doc and j < i)) for doc, i in rows], "id long, copies long, edges int, doc_id long, at int")
    found = {r["id"]: (r["head"], r["offset"], r["total"]) for r in substring_dedup.chains(places).collect()}
    size = lambda a, b: sum(2 + j % 3 for j in range(a, b))
    want = {i: (a, size(a, i), size(a, b)) for a, b in ((0, 10), (10, 20), (20, 30), (30, 40)) for i in range(a, b)}
    assert found == want
    assert substring_dedup.chains(places.limit(0)).count() == 0


def test_passages_whole_rows(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    docs = frame(spark, [(1, f"x  y\n{passage}"), (2, f"{passage} tail"), (4, "as  it\tis"), (None, passage), (6, None), (7, LONG)])
    docs = docs.withColumn("marks", F.lit("m")).withColumn("n_words", F.lit("n")).drop("n_words")
    rows = {r["doc_id"]: r for r in substring_dedup.without_repeats(docs).collect()}
    assert rows[1]["kept_text"] == f"x  y\n{passage}" and rows[4]["kept_text"] == "as  it\tis"
    assert rows[2]["kept_text"] == "tail" and rows[2]["n_removed"] == 55 and rows[2]["marks"] == "m"
    assert rows[None]["kept_text"] == passage and rows[None]["n_removed"] == 0
    assert rows[6]["kept_text"] is None and rows[7]["n_words"] == 30_000
    repeated = passages([(7, LONG)])[7][1]
    assert rows[7]["n_removed"] == sum(repeated) > 20_000


@pytest.mark.parametrize(("seed", "frequent"), [(4, 1000), (5, 2), (6, 1)])
def test_links_against_brute_force(spark, seed, frequent):
    texts = corpus(seed, 80) + ["", None, "One two", "one  TWO", "one", "\t"]
    docs = frame(spark, texts).select("doc_id", "text")
    expected = linked(list(enumerate(texts)))
    found = {r["doc_id"]: r for r in jaccard_join.linked_components(docs, frequent=frequent).collect()}
    assert {k: r["component_id"] for k, r in found.items()} == expected
    assert {k: r["n_shingles"] for k, r in found.items()} == {i: len(shingles(t)) for i, t in enumerate(texts)}


def test_links_of_a_chain_and_of_a_large_family(spark):
    base = [f"b{i}" for i in range(80)]
    chain = [" ".join(base[k:] + [f"n{j}" for j in range(k)]) for k in range(0, 40, 2)]
    family = [" ".join([*(f"f{i}" for i in range(100)), f"own{k}"]) for k in range(150)]
    texts = chain + family + ["unlike all of the others here"]
    docs = frame(spark, texts).select("doc_id", "text")
    expected = linked(list(enumerate(texts)))
    for frequent in (1000, 20):
        found = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(docs, frequent=frequent).collect()}
        assert found == expected


def test_links_behind_one_frequent_shingle(spark):
    """Variants of a template's last word share the shingle of most prefixes, then only rarer ones."""
    for seed in range(3):
        base = [f"t{seed}x{i}" for i in range(22)]
        inner = [[*base[:p], f"in{seed}x{k}", *base[p + 1 :]] for k in range(100) for p in [3 + k % 16]]
        last = [[*base[:-1], f"end{seed}x{k}"] for k in range(8)]
        texts = [" ".join(t) for t in inner + last]
        docs = frame(spark, texts).select("doc_id", "text")
        expected = linked(list(enumerate(texts)))
        assert {expected[i] for i in range(100, 108)} == {100}
        found = {r["doc_id"]: r["component_id"] for r in jaccard_join.linked_components(docs, frequent=50).collect()}
        assert found == expected


def test_links_by_one_frequent_shingle(spark):
    texts = ["a b c", *(f"a b c d{i}" for i in range(6)), *(f"a b c d{i} e" for i in range(3)), "x y z"]
    docs = frame(spark, texts).select("doc_id", "text")
    for percent in (50, 30):
        expected = linked(list(enumerate(texts)), percent=percent)
        found = jaccard_join.linked_components(docs, percent=percent, frequent=2).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_keys_of_one_passage_form_their_pairs_once(spark, monkeypatch):
    """Texts that share a passage but do not link meet once, not once per shingle of the passage."""
    saved, write = {}, jaccard_join.written

    def keep(df, label):
        saved.setdefault(label, []).append(write(df, label).localCheckpoint())
        return write(df, label)

    monkeypatch.setattr(jaccard_join, "written", keep)
    texts = [" ".join([f"p{g}x{i}" for i in range(30)] + [f"own{g}x{k}x{i}" for i in range(20 + k % 3)]) for g in range(3) for k in range(6)]
    texts += [" ".join(texts[0].split()[:-4] + ["and", "then", "its", "end"]), texts[7] + " tail"]
    expected = linked(list(enumerate(texts)), percent=60)
    classes, labels = jaccard_join.class_links(frame(spark, texts).select("doc_id", "text"), percent=60, rounds=0)
    own = {r["node"]: r["component"] for r in labels.collect()}
    assert {r["doc_id"]: own.get(r["class_id"], r["class_id"]) for r in classes.collect()} == expected
    assert len(set(expected.values())) == len(texts) - 2
    assert saved["class-groups"][0].count() * 3 < saved["active-keys"][0].count()


def test_shared_passages_come_behind_rarer_shingles(spark, monkeypatch):
    """A passage of seven texts makes no keys while they hold enough shingles that occur four times."""
    saved, write = {}, jaccard_join.written

    def keep(df, label):
        saved.setdefault(label, []).append(write(df, label).localCheckpoint())
        return write(df, label)

    monkeypatch.setattr(jaccard_join, "written", keep)
    own = [" ".join(f"own{k}x{i}" for i in range(90)) for k in range(7)]
    texts = [" ".join([*(f"p{i}" for i in range(30)), text]) for text in own]
    texts += [" ".join([text, *(f"z{k}x{j}x{i}" for i in range(300))]) for k, text in enumerate(own) for j in range(3)]
    docs = frame(spark, texts).select("doc_id", "text")
    classes, labels = jaccard_join.class_links(docs, percent=60)
    assert classes.count() == len(texts) and labels.count() == 0
    assert linked(list(enumerate(texts)), percent=60) == {i: i for i in range(len(texts))}
    assert sum(t.count() for t in saved.get("pairs", [])) == 0


def test_sets_that_cannot_link_under_a_key_are_not_indexed_there(spark):
    """Ten shingles of ten are too few to be shared late: only places that leave enough for the smallest set stay."""
    rows = [(1, 10, 0, [7, 8, 9]), (2, 10, 1, [5, 6, 7]), (3, 10, 0, [8, 7, 9])]
    prefixes = spark.createDataFrame(rows, "doc_id long, n int, alone int, keys array<long>")
    found = {(r["doc"], r["pos"]) for r in jaccard_join.index_keys(prefixes, 1000, 90).collect()}
    assert found == {(1, 0), (3, 0)}


@pytest.mark.parametrize("operator", [jaccard_join.linked_components, substring_dedup.without_repeats])
def test_tables_that_nothing_reads_any_more_are_gone(spark, operator):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} tail{k} {' '.join(f'o{k}x{i}' for i in range(3 * (k % 4)))}" for k in range(12)] + [LONG, None, ""]
    rows = operator(frame(spark, texts).select("doc_id", "text"))
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before}
    assert left <= {"class-members", "near-labels", "labels", "chains", "marks"}
    assert rows.count() == len(texts)


def test_links_null_and_repeated_ids(spark):
    docs = frame(spark, [(None, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "A b c d")]).select("doc_id", "text")
    found = sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard_join.linked_components(docs).collect())
    assert found == [(-1, None), (2, 2), (2, 2), (3, 2)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(31)} | {90: 90, 95: 90, 100: 90}
