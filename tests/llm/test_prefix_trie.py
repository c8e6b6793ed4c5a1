"""The trie against plain Python, contraction of chains and stars against plain sums."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import ordered, prefix_trie

NAMES = "conv_id long, turn long, role string, text string"


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """The contract's rows from (conv, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest((role or "", text or "")), (role or "", text or "")))
    plain = {c: [r[3] for r in sorted(rs)] for c, rs in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in plain:
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(plain.get(c - c % 100, [])[:h] + plain[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return {
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    }


def talks(seed):
    """Shared heads, copies, a conversation of many turns, turnless ones, ties, repeated rows, nulls."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(300, 340)]:  # 300 is missing below: heads that are absent
        if c != 300:
            rows += [(c, t, rng.choice(["user", None]), rng.choice("abc")) for t in range(rng.randint(1, 9))]
    rows += [(400, t, "user", "same") for t in range(7)] + [(c, t, "user", "same") for c in range(401, 480) for t in range(7)]
    rows += [(502, t, "user", f"long {t % 3}") for t in range(300)] + [(503, t, "user", f"long {t % 3}") for t in range(280)]
    rows += [(610, None, None, None)] * 3 + [(610, 1, "a", "b"), (610, 1, "ab", ""), (None, 0, "user", "x"), (700, 0, "", "ü\U0001f600"), (700, 1, "user", "z" * 50_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "held"), [(1, 1 << 20), (2, 1)])
def test_against_brute_force(spark, monkeypatch, seed, held):
    if held == 1:
        real = ordered.folded
        monkeypatch.setattr(prefix_trie, "folded", lambda *a: real(*a, held=held))
    rows = talks(seed)
    df = spark.createDataFrame(rows, NAMES).withColumns({"depth": F.lit("d"), "kids": F.lit(0), "conv": F.lit(-1)}).repartition(4)
    found = [tuple(r) for r in prefix_trie.trie(df).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)


def test_nothing_and_one_turn(spark):
    empty = spark.createDataFrame([], NAMES)
    assert prefix_trie.trie(empty).count() == 0
    rows = [(5, 0, "user", "hi")]  # crc32("5") % 6 turns of conversation 0, which is absent
    assert {tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, NAMES)).collect()} == brute(rows)


def test_prefix_sums_do_not_depend_on_ranges(spark):
    rows = [(c, t, "r", f"{c % 2} {t}") for c in range(3) for t in range(700)]
    df = prefix_trie.turns(spark.createDataFrame(rows, NAMES), "conv_id", "turn", "role", "text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # eight ranges for three conversations
    cut = {tuple(r) for r in prefix_trie.prefix_sums(df).select("conv", "pos", "a", "b", "prev_a").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    one = {}
    for c in range(3):
        sums = [0, 0]
        for t in range(700):
            raw = digest(("r", f"{c % 2} {t}"))
            last = sums[0]
            for j, base in enumerate(prefix_trie.BOTH):
                sums[j] = (sums[j] + pow(base, t + 1, 1 << 64) * int.from_bytes(raw[8 * j : 8 * j + 8], "little")) % (1 << 64)
            one[c, t + 1] = (*map(prefix_trie.signed, sums), prefix_trie.signed(last))
    assert cut == {(*k, *v) for k, v in one.items()}
    assert [one[0, t] for t in range(1, 700)] == [one[2, t] for t in range(1, 700)] != [one[1, t] for t in range(1, 700)]


def test_contraction_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """1,000 nodes in a line, a leaf hanging off every tenth, each node worth its depth."""
    line = [(d, d, d - 1 if d else None, d) for d in range(1000)] + [(5000 + d, d + 1, d, 1) for d in range(0, 990, 10)]
    kids = defaultdict(int)
    for _, d, p, _ in line:
        kids[p] += p is not None
    rows = [(c, d, p, None if p is None else d - 1, kids[c] if c < 5000 else 0, int((kids[c] if c < 5000 else 0) == 0), v) for c, d, p, v in line]
    tree = spark.createDataFrame(rows, "conv long, depth long, pconv long, pdepth long, kids long, leaves long, saved long")
    rounds, real = [], prefix_trie.contracted
    monkeypatch.setattr(prefix_trie, "contracted", lambda live: rounds.append(1) or real(live))
    found = {(r["conv"], r["depth"]): (r["leaves"], r["saved"]) for r in prefix_trie.subtree_totals(tree).collect()}
    assert len(found) == len(rows) and len(rounds) <= 16
    leaves, saved = 1, 999
    for d in range(999, -1, -1):
        if d < 999:
            hanging = d < 990 and d % 10 == 0
            leaves, saved = leaves + hanging, saved + d + hanging
        assert found[d, d] == (leaves, saved)
