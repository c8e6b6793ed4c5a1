"""Lexical search against plain Python over all pairs; what the accumulators save."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import lexical_search
from tests.llm.helpers import LONG, frame, lowered

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(lowered(text))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            if not c or doc is None:
                continue
            m = 25 + (75 * sum(c.values()) * n) // total
            score = 0
            for t in terms(text):
                if t in c:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    """Small blocks, several passes, ties, repeated rows, a word of every text, nulls and odd texts."""
    monkeypatch.setattr(lexical_search, "DOCS", 40)
    monkeypatch.setattr(lexical_search, "LOAD", 60)
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 500}"
    texts = [(i, "The " + " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(300)]
    texts += [(i, texts[0][1]) for i in range(300, 340)] + [texts[3]] * 3
    texts += [(400, None), (401, ""), (402, "!! \x00 --"), (None, "w1 w2 rare"), (403, "Ünï漢 ÜNï漢 w1"), (404, LONG), (405, "a" * 50_000 + "!b")]
    items = [(i, " ".join(rng.choice([word(), "the", "THE"]) for _ in range(rng.randint(0, 12)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "the"), (53, "rare ünï漢 ÜNï漢"), (54, texts[0][1]), (55, "w1x1 " * 40), (56, "nowhere")]
    docs = frame(spark, texts).withColumns({"score": F.lit(1), "terms": F.lit("x"), "pass": F.lit(0)})
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(3).withColumns({"number": F.lit("n"), "df": F.lit(2)})
    found = lexical_search.top_k(docs, asked)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(texts, items)


def test_tables_without_rows_and_repeated_items(spark):
    docs = frame(spark, ["one two", "two three"])
    asked = spark.createDataFrame([(1, "one"), (1, "three"), (None, "two")], "item_id long, text string")
    assert lexical_search.top_k(docs.limit(0), asked).count() == 0
    assert lexical_search.top_k(docs, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    found = [(r["item_id"], r["rank"], r["doc_id"]) for r in lexical_search.top_k(docs, asked).collect()]
    assert sorted(found, key=str) == sorted([(1, 1, 0), (1, 1, 1), (None, 1, 0), (None, 2, 1)], key=str)


def test_long_texts_are_cut_between_terms():
    texts = pa.array(["ab, cd" * 50, None, "x" * 1000 + " y", "é" * 30])
    whole, cut = lexical_search.terms_of(texts), lexical_search.terms_of(texts, piece=7)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_common_terms_create_no_accumulators():
    """A word of every text adds nothing to the accumulators once a rare one has set the threshold."""
    docs = np.arange(4000)
    places = np.concatenate([[7, 9], docs]).astype(np.int32)
    block = lexical_search.Block(
        docs, np.full(4000, 20), np.array([1, 2], np.uint64), np.array([1, 2], np.uint64), np.array([0, 2, 4002]), places, np.ones(4002, np.int64)
    )
    scorer = lexical_search.Scorer(block, 4000, 80_000, 2)
    reach = np.array([8000 * scorer.most[0] + 1 * scorer.most[1], scorer.most[1]])
    live, scores = scorer.best(np.array([0, 1]), np.array([8000, 1]), reach, 0)
    assert live.tolist() == [7, 9] and (scores == 8000 * scorer.gain[0] + scorer.gain[9]).all()
    assert scorer.created == 2 and scorer.read == 4
    assert not scorer.sums.any() and not scorer.has.any()
