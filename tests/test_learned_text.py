"""Learned labels, induced wrappers and ranked sentences against plain Python."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import bayes as BY
from fleetlake.operators import textops as TX
from fleetlake.operators import wrappers as WR
from fleetlake.plans import registry


def split(text):
    return {w for w in re.split(r"[^\w]+", (text or "").lower()) if w}


def plain_labels(texts, seeds, rounds, alpha, z, odds, least):
    """Shares of the first of two classes, with the same counts and weights."""
    words = {i: split(t) for i, t in texts}
    share = {i: float(bool(w & set(seeds))) for i, w in words.items()}
    for _ in range(rounds):
        n, rows = max(sum(share.values()), 1e-9), len(texts)
        count, inside = defaultdict(int), defaultdict(float)
        for i, w in words.items():
            for t in w:
                count[t] += 1
                inside[t] += share[i]
        weight, base = {}, math.log(n / (rows - n))
        for t, df in count.items():
            a, b = inside[t] + alpha * n / rows, df - inside[t] + alpha * (rows - n) / rows
            found = math.log(a / n) - math.log(b / (rows - n))
            if df >= least and abs(found) >= max(odds, z * math.sqrt(1 / a + 1 / b)):
                here, there = a / (n + 2 * alpha * n / rows), b / (rows - n + 2 * alpha * (rows - n) / rows)
                lacks = math.log((1 - here) / (1 - there))
                weight[t], base = math.log(here / there) - lacks, base + lacks
        share = {i: 1 / (1 + math.exp(-max(-50, min(50, base + sum(weight.get(t, 0.0) for t in w))))) for i, w in words.items()}
    return share


def test_labels_equal_a_plain_version(spark):
    rng = random.Random(8)
    bad, good = ["awful", "vile", "nasty", "rotten"], [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.sample(good, 8) + (rng.sample(bad, 3) if i % 5 == 0 else []))) for i in range(200)] + [(900, None), (901, ""), (902, "unheard")]
    df = spark.createDataFrame(texts, "id long, content string").repartition(3)
    model = BY.learn_labels(df, "id", "content", {"bad": ["awful"]}, "good", rounds=3, z=2.0, odds=1.0, least=3)
    want = plain_labels(texts, ["awful"], 3, 1.0, 2.0, 1.0, 3)
    found = {r["id"]: r for r in BY.labelled(model, df, "id", "content").collect()}
    for i, p in want.items():
        assert found[i]["probability"] == pytest.approx(max(p, 1 - p), abs=1e-6)
        assert found[i]["label"] == ("bad" if p >= 0.5 else "good")
    assert sum(found[i]["label"] == "bad" for i in range(0, 200, 5)) >= 38  # a quarter was never seeded
    assert BY.labelled(model, df.limit(0), "id", "content").count() == 0


def test_shares_meet_texts_not_pairs(spark, monkeypatch):
    """What learning keeps and joins is one row per text; without broadcasts the labels are the same."""
    saved, save = [], BY.save_scratch
    monkeypatch.setattr(BY, "save_scratch", lambda df, label: saved.append(save(df, label)) or saved[-1])
    texts = [(i, f"a{i % 7} b{i % 5} c{i % 3}" + (" awful vile" if i % 4 == 0 else " fine")) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(texts, "id long, content string")
    found = []
    for size in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            model = BY.learn_labels(df, "id", "content", {"bad": ["awful"]}, "good", rounds=2, z=1.0, odds=1.0, least=2)
            found.append({r["id"]: (r["label"], round(r["probability"], 9)) for r in BY.labelled(model, df, "id", "content").collect()})
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1] and all(found[0][i][0] == ("bad" if i % 4 == 0 else "good") for i in range(60))
    assert max(x.count() for x in saved) == len(texts)


def test_abuse_is_learned_from_seed_words(spark):
    """No label is read in learning. A third of the texts that are labelled abusive hold no abusive word."""
    root = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    found = {r["doc_id"]: r["label"] == "toxic" for r in registry.q16_learned_labels(spark, root).collect()}
    assert sum(found[i] == bool(t) for i, t in truth.items() if i in found) >= 0.95 * len(truth)
    docs = {r["doc_id"]: split(r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()}
    abuse = set("trash pathetic idiot worthless disgusting stupid clown scum loser moron".split())
    unseeded = [i for i, t in truth.items() if t and i in docs and docs[i] & abuse and not docs[i] & set(registry.ABUSE_SEEDS["toxic"])]
    assert unseeded and all(found[i] for i in unseeded)
    assert sum(found[i] for i, t in truth.items() if not t and i in found) <= 0.01 * len(truth)


HTML = '<!DOCTYPE html><html lang="{l}"><head><meta charset="{c}"><title>{t}</title></head><body><p>a<p>b<br>{h}</body></html>'


def test_wrappers_of_sites_that_differ(spark):
    rows = []
    for i in range(60):
        site, name = i % 3, f"head {i} &amp; more"
        inner = ["<h1>{}</h1>", "<div><h2>{}</h2><h2>{}</h2><b>{}</b></div>", "<i>{}</i>"][site].format(*[name] * 3)
        rows.append((i, f"http://S{site}.org/{i}", HTML.format(l="en", c="utf-8", t=f"title {i}", h=inner), name))
    rows += [(100, "nowhere", HTML.format(l="fr", c="x", t="t", h="<h1>lost</h1>"), "lost"), (101, None, None, None), (102, "http://s0.org/", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, name string").repartition(4)
    examples = pages.where("page_id < 30 AND page_id % 5 <> 0").select(F.col("page_id").alias("page"), F.lit("heading").alias("field"), F.col("name").alias("value"))
    titles = pages.where("page_id = 1").select(F.col("page_id").alias("page"), F.lit("title").alias("field"), F.lit("title 1").alias("value"))
    found = {r["page_id"]: r for r in WR.induce_and_extract(pages, "page_id", "url", "html", examples.unionByName(titles), ["heading", "title"]).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["heading"] == r[3] and found[i]["title"] == f"title {i}" for i, r in enumerate(rows[:60]))
    assert found[100]["title"] == "t" and found[101]["heading"] is None and found[102]["title"] is None


def test_ranked_sentences_equal_a_plain_walk(spark):
    rng = random.Random(2)
    texts = [(i % 3, ". ".join(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(4)) + ".") for i in range(30)] + [(7, None), (8, "..."), (9, "One. one two! Two")]
    df = spark.createDataFrame(texts, "g int, t string")
    sentences = TX.counted_sentences(df, ["g"], "t")
    rows = [tuple(r) for r in sentences.collect()]
    for g in {r[0] for r in rows}:
        own = {s: h for k, s, h in rows if k == g}
        words = {s: {w for w in re.split(r"\W+", s.lower()) if w} for s in own}
        x = {s: float(h) for s, h in own.items()}
        for _ in range(4):
            mass = defaultdict(float)
            for s, ws in words.items():
                for w in ws:
                    mass[w] += x[s] / len(ws)
            holders = {w: sum(w in ws for ws in words.values()) for w in mass}
            x = {s: 0.15 * own[s] + 0.85 * sum(mass[w] / holders[w] for w in ws) for s, ws in words.items()}
        found = {r["sentence"]: r["score"] for r in TX.ranked_sentences(sentences, ["g"]).where(F.col("g") == g).collect()}
        assert found == pytest.approx(x)
    told = {r["g"]: r for r in TX.summarize_by_rank(df, ["g"], "t", 10).collect()}
    assert told[7]["summary"] is None and told[9]["event_count"] == 1 and all(len(r["summary"].replace("|", "").split()) <= 10 for r in told.values() if r["summary"])


def test_large_groups_alone_are_walked_by_joins(spark, monkeypatch):
    """Small groups need no table of (sentence, word) pairs; either way gives the same scores, in batches of three rows too."""
    rng = random.Random(4)
    texts = [(i % 5 if i % 9 else None, ". ".join(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(5)) + ".") for i in range(60)] + [(7, None), (8, "... !!!"), (9, "-. --.")]
    texts += [(6, ". ".join(" ".join(rng.choice("klmnopq") for _ in range(5)) for _ in range(60)))]
    sentences = TX.counted_sentences(spark.createDataFrame(texts, "g int, t string"), ["g"], "t")
    saved, save = [], TX.save_scratch
    monkeypatch.setattr(TX, "save_scratch", lambda df, label: saved.append((label, save(df, label))) or saved[-1][1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = [{(r["g"], r["sentence"]): r["score"] for r in TX.ranked_sentences(sentences, ["g"], **size).collect()} for size in ({}, {"task_chars": 500}, {"task_chars": 0})]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    edges = [df for label, df in saved if label == "edges"]
    assert len(edges) == 2 and 0 < edges[0].count() < edges[1].count()  # none for the first of three
    assert len(found[0]) == sentences.count() and found[0] == pytest.approx(found[2]) and found[1] == pytest.approx(found[2])


@pytest.mark.parametrize("text", ["a &amp; b", "cut&amp", "cut&am", "&#65;&#65 x", "\n\ntwo &lt;&lt\nlines &gt", "&#x41 &copy;"])
def test_references_stay_as_they_stand_in_the_page(text):
    page = f"<html>\n<head><title>{text}</title></head><body><h1>{text}</h1></body></html>"
    found = WR.TagPaths().paths(page)
    assert found["html/head/title#"] == [1, text] and found["html/body/h1#"] == [1, text]
