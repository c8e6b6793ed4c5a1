"""Classifiers by held-out accuracy, URL rules and vector search against brute force, the pipeline."""

import math
import random
import re
import zlib
from fnmatch import fnmatchcase

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlake.llm import exact_topk, language, quality, queries, url_filter
from tests.llm.helpers import LONG, frame, linked, passages


def test_language_held_out(spark):
    root = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    rows = queries.op5_language(spark, root).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    rows = frame(spark, ["the cat sat on the mat", "die katze und der hund", None, "", "12 !!", "a", "ü", LONG, "漢字"])
    rows = rows.withColumn("lang_pred", F.lit("x"))
    train = spark.createDataFrame([("the cat sat on the", "en"), ("der hund und die katze", "de"), (None, "fr"), ("a", None)], "text string, lang string")
    model = language.learned(train)
    assert model.languages == ["de", "en"]
    found = {r["doc_id"]: r for r in language.identified(rows, model, ["doc_id"]).collect()}
    assert [found[i]["lang_pred"] for i in range(5)] == ["en", "de", "und", "und", "und"]
    assert found[2]["score"] == 0 and all(found[i]["lang_pred"] in ("de", "en") for i in (5, 6, 7, 8))
    nothing = language.learned(train.limit(0))
    assert {r["lang_pred"] for r in language.identified(rows, nothing, ["doc_id"]).collect()} == {"und"}


def plain_language(training, texts):
    """Bundles and cosines letter by letter, in plain Python over lists of +1 and -1."""
    letters, classes = [list(map(int, v)) for v in language.letter_vectors()], language.letter_classes()
    size = language.DIMENSIONS

    def bundle(text):
        codes, total = [], [0] * size
        for c in f" {text} ":
            code = int(classes[ord(c)]) if ord(c) < language.CODES else 0
            if code or not codes or codes[-1]:
                codes.append(code)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            x, y, z = letters[a], letters[b], letters[c]
            for d in range(size):
                total[d] += x[d - 2] * y[d - 1] * z[d]
        return total

    sums = {}
    for text, lang in training:
        own = sums.setdefault(lang, [0] * size)
        for d, x in enumerate(bundle(text)):
            own[d] += x
    out = {}
    for i, text in texts:
        own = bundle(text or "")
        norm = sum(x * x for x in own) ** 0.5
        if not norm or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        cosines = {lang: sum(p * q for p, q in zip(own, v)) / norm / sum(p * p for p in v) ** 0.5 for lang, v in sums.items()}
        best = max(sorted(cosines), key=lambda lang: cosines[lang])
        out[i] = (best, min(1.0, max(0.0, (1 + cosines[best]) / 2)))
    return out


def test_language_equals_a_plain_bundle(spark):
    training = [("the cat sat on the mat", "en"), ("a dog and a cat", "en"), ("der hund und die katze", "de"), ("el perro y el gato", "es"), ("12", "xx"), ("la niña", "es"), ("la niña", "es")]
    texts = list(enumerate(["the dog", "die katze sass", "el gato negro", "x", "niña!", "", None, "77", "der the el", "漢字 katze", "the dog"]))
    rows = spark.createDataFrame(training, "text string, lang string").repartition(3)
    model = language.learned(rows)
    assert model.languages == ["de", "en", "es"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identified(frame(spark, texts), model, ["doc_id"]).collect()}
    for i, (lang, score) in plain_language([t for t in training if t[1] != "xx"], texts).items():
        assert found[i][0] == lang and found[i][1] == pytest.approx(score, abs=1e-5)
    assert language.identified(frame(spark, texts).limit(0), model, ["doc_id"]).count() == 0


def test_gram_vectors_are_bound_and_permuted():
    letters = language.letter_vectors()
    gram = np.array([5 * language.BUCKETS**2 + 7 * language.BUCKETS + 9])
    expected = np.roll(letters[5], 2) * np.roll(letters[7], 1) * letters[9]
    assert (language.gram_vectors(gram)[0] == expected).all()


def test_quality_held_out(spark):
    root = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    rows = queries.op9_quality(spark, root).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def plain_statistics(text):
    """The numbers of one text, byte by byte and word by word."""
    raw = (text or "").encode()
    kind = lambda b: next((k for k, own in KINDS.items() if b in own), "high" if b >= 128 else "other")
    kinds, size = [kind(b) for b in raw], len(raw)
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    lines = [x for x in re.split(rb"[\x0A-\x0D]+", raw) if x]
    n, share = len(words), lambda part, whole: (part + 0.02) / (whole + 1.0)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(n, 1)
    spread = math.sqrt(max(sum(x * x for x in lengths) / max(n, 1) - mean**2, 0))
    triples = [tuple(words[i : i + 3]) for i in range(n - 2)]
    return [math.log(x + 1e-3) for x in (
        n + 1, *(share(kinds.count(k), size) for k in ("upper", "digit", "break", "stop", "mark", "high")), mean + 1, spread + 1,
        share(sum(kind(w[0]) == "upper" and kind(w[min(1, len(w) - 1)]) == "upper" for w in words), n),
        share(sum(kind(w[-1]) == "mark" for w in words), n), share(sum(kind(w[0]) == kind(w[-1]) == "mark" for w in words), n),
        (len(set(words)) + 1) / (n + 1), share(sum(a == b for a, b in zip(words, words[1:])), n),
        share(len(triples) - len(set(triples)), len(triples)), share(len(lines) - len(set(lines)), len(lines)), size / max(len(lines), 1) + 1,
    )]


KINDS = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": b"\t ", "break": b"\n\x0b\x0c\r", "stop": b".,;:?'\"()-", "mark": b"!#$%&*|=<>_~^@+/\\"}


def test_quality_equals_log_densities_from_raw_rows(spark):
    """Statistics, moments and scores against plain Python and matrix inverses; repeated rows, no rows."""
    rng = random.Random(11)
    word = lambda: rng.choice(["Plain", "word", "AB", "x1", "é漢", "##", "it's", "end!", "a"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))).replace("a ", rng.choice(["a\n", "a "])) for _ in range(150)] + ["", None, "\n\n", LONG]
    rows = [(i, t, i % 2 if i % 7 else None) for i, t in enumerate(texts)] + [(0, texts[0], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    model = quality.fit(quality.measured(df, ["quality"]))
    x = np.array([plain_statistics(t) for _, t, _ in rows])
    own = {k: x[[q == k for _, _, q in rows]] for k in (0, 1)}
    known = np.concatenate(list(own.values()))
    centre, scale, d = known.mean(0), np.sqrt(np.maximum(known.var(0), 1e-6)), x.shape[1]
    density = []
    for k in (0, 1):
        z, n = (own[k] - centre) / scale, len(own[k])
        cov, w = np.cov(z.T, bias=True), min(1.0, 0.1 + d / (n + d))
        cov = 0.7 * ((1 - w) * cov + w * np.diag(np.diag(cov))) + 0.3 * np.eye(d)
        off = (x - centre) / scale - z.mean(0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off) - 0.5 * np.linalg.slogdet(cov)[1])
    odds = density[1] - density[0] + math.log(len(own[1]) / len(own[0]))
    want = {i: 1 / (1 + math.exp(-max(-30, min(30, o)))) for (i, _, _), o in zip(rows, odds, strict=True)}
    found = quality.scored(df, model, ["doc_id"], "text").collect()
    assert len(found) == len(rows) and all(r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6) for r in found)
    assert quality.scored(df.limit(0), model, ["doc_id"], "text").count() == 0


def test_quality_of_odd_texts_and_labels(spark):
    texts = ["", None, " ", "x", "!!! ***", LONG, "\n\n\n", "ok then"]
    docs = frame(spark, texts).withColumn("__x", F.lit(1))
    good = [(f"word{i} and other{i} things {i}", 1) for i in range(30)]
    bad = [(f"AA{i}!!! BB!!! AA{i}!!!", 0) for i in range(20)] + [("a", None), (None, 0), ("b", 7)]
    fitted = lambda rows: quality.fit(quality.measured(spark.createDataFrame(rows, "text string, quality int"), ["quality"]))
    model = fitted(good + bad)
    found = quality.scored(docs, model, ["doc_id", "lang"], "text").collect()
    assert len(found) == len(texts) and all(0 <= r["score"] <= 1 for r in found)
    probe = frame(spark, ["words and other plain things 7", "CC!!! DD!!! CC!!!"])
    assert {r["doc_id"]: r["predicted"] for r in quality.scored(probe, model, ["doc_id"], "text").collect()} == {0: 1, 1: 0}
    assert {r["score"] for r in quality.scored(docs, fitted(good), ["doc_id"], "text").collect()} == {1.0}
    assert {r["score"] for r in quality.scored(docs, fitted([]), ["doc_id"], "text").collect()} == {0.5}


def test_repeated_runs_score_alike(spark):
    docs = frame(spark, ["plain words here", "AA!!! BB!!!"] * 20).withColumn("quality", (F.col("doc_id") % 2 == 0).cast("int"))
    known = quality.measured(docs, ["doc_id", "quality"])
    runs = [sorted(quality.scored(known, quality.fit(known.repartition(n)), ["doc_id"]).collect()) for n in (2, 5)]
    assert all(abs(a["score"] - b["score"]) < 1e-9 for a, b in zip(*runs, strict=True))


RULES = dict(net="block")
URLS = [
    "http://net/", "http://x.net", "http://x.net/", "HTTP://A.B.NET/x?y", "https://example.net/en/1", "https://m.example.net/en", "https://notexample.net/en/1",
    "http://example.com/de/1#a", "http://example.com/de", "http://sub.example.com/de/", "http://badexample.com/de/", "http://o.org/fr/x", "http://o.org/en/fr/",
    "http://a.com/x.net/en/", "http://a.com/?u=http://b.net/", "no scheme", "", None, "://", "http://", "http://casino.example.com/", "http://my-casino-win.org/fr/1",
    "http://a.com/casino", "http://user@x.net:80/", "http://ünï.org/fr/é?", "http://a.com/" + "p" * 5000, "x://y.net/\n", "http://x.net?/", "http://A\nB.net/en/",
]


def test_urls_against_plain_rules(spark):
    sites = [(r.verdict, *r.site.partition("/")[::2], r.site) for r in queries.SITE_RULES]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    for r in url_filter.url_verdicts(pages, queries.SITE_RULES, queries.HOST_GLOBS).collect():
        url = URLS[r["page_id"]] or ""
        rest = url.partition("://")[2] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [s for s in sites if (host == s[1] or host.endswith("." + s[1])) and path.startswith("/" + s[2])]
        best = max(fits, key=lambda s: len(s[3]), default=None)
        spam = any(word in host for word in ("casino", "cheap-pills", "free-bets", "spam-farm", "ads-track"))
        expected = best[0] if best else "block" if spam else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best[3], expected), url


def test_globs_against_fnmatch():
    rng = random.Random(5)
    draw = lambda letters, k: "".join(rng.choice(letters) for _ in range(rng.randint(0, k)))
    globs = [(draw("ab.*?", 6), draw("ab/*?", 9)) for _ in range(60)]
    automaton = url_filter.GlobSet(globs)
    assert automaton.words > 3
    sides = [(draw("ab.", 7), draw("ab/", 10)) for _ in range(300)]
    texts = [h.encode() + b"\xff" + p.encode() for h, p in sides]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = automaton.matches(np.frombuffer(b"".join(texts), np.uint8), bounds)
    for i, (host, path) in enumerate(sides):
        for k, (h, p) in enumerate(globs):
            assert found[i, k] == (fnmatchcase(host, h) and fnmatchcase(path, p)), (sides[i], globs[k])


def test_thousands_of_globs(spark):
    """A rule list of real size as an argument: 3,000 host globs at once, a very long and a repeated url."""
    rng = random.Random(9)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9)))
    globs = [("block", (rng.choice([f"*.{name()}.com", f"*{name()}*", f"{name()}.org", f"ads?.{name()}.net"]), rng.choice(["*", f"/{name()}/*", "*.js"]))) for _ in range(3000)]
    hosts = [rng.choice([f"www.{name()}.com", f"x{name()}y.net", f"{name()}.org", f"ads1.{name()}.net"]) for _ in range(300)]
    hosts += [g[0].replace("*", "q").replace("?", "7") for _, g in globs[:100]]
    urls = [f"http://{h}{rng.choice(['/', '/a.js', f'/{name()}/x', '/deep/path'])}" for h in hosts] + ["http://long.org/" + "p" * 100_000 + ".js"] * 2
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string").repartition(3)
    found = {r["page_id"]: r for r in url_filter.url_verdicts(pages, [], globs).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, _, path = url[7:].partition("/")
        want = any(fnmatchcase("." + host, h) and fnmatchcase("/" + path, p) for _, (h, p) in globs)
        assert found[i]["verdict"] == ("block" if want else "allow"), url[:80]


def test_url_tables_without_rows_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.url_verdicts(pages, [], []).collect()] == [(1, "a.net", "/", None, "allow")]
    assert url_filter.url_verdicts(pages.limit(0), queries.SITE_RULES, queries.HOST_GLOBS).count() == 0


def brute_top(vectors, asked, k):
    whole = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in vectors.items()}
    out = set()
    for q in asked & whole.keys():
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("n", "dim"), [(300, 8), (4, 3), (1, 2)])
def test_top_k_against_brute_force(spark, n, dim):
    rng = np.random.default_rng(n)
    vectors = {i: rng.normal(size=dim).astype(np.float32).tolist() for i in range(n)}
    for i in range(0, n // 3):
        vectors[3 * i] = vectors[0]
    rows = [(i, v) for i, v in vectors.items()] + [(1000, None), (1050, [None] * dim), (1100, [float("nan")] * dim), (1150, [float("inf")] * dim), (1200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = exact_topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()
    assert {tuple(r) for r in found} == brute_top(vectors, {i for i in vectors if i % 50 == 0}, 5) and len(found) == len(set(found))


def test_clustered_vectors_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 100)
    monkeypatch.setattr(exact_topk, "QUERIES", 40)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 8)) * 4
    rows = [(i, (centres[i % 60] + rng.normal(size=8) * 0.1).astype(np.float32).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    found = {tuple(r) for r in exact_topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()}
    assert found == brute_top(dict(rows), set(range(0, 3000, 50)), 5)


def test_a_floor_leaves_out_what_cannot_reach_it():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 50
    x = np.concatenate([centres[i] + rng.normal(size=(50, 16)) for i in range(40)]).round()
    pivots, ids = x[rng.integers(0, 2000, 48)], np.arange(2000)
    table, norms = exact_topk._distances(x, pivots), (x**2).sum(1)
    scored = 0
    for q in range(0, 2000, 100):
        args = (x[q], q, norms[q], table[q], x, ids, norms, table, 5)
        everything = np.sort(np.delete(x @ x[q], q))[::-1][:5]
        scores, _, first = exact_topk.best_in_block(*args, seeds=16)
        best, _, n = exact_topk.best_in_block(*args, floor=scores[-1])
        assert (best == everything).all()
        assert len(exact_topk.best_in_block(*args, floor=everything[0] + 1e6)[0]) == 0
        scored += first + n
    assert scored < 0.1 * 20 * 2000


def test_repeated_rows_and_clashing_columns_of_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (2, [1.0, 1.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "v", "dim", "score", "rank", "query_id")})
    found = [tuple(r) for r in exact_topk.top_k(df, df.filter("vec_id % 50 = 0"), k=3).collect()]
    unit = 256 * 256
    assert sorted(found) == [(0, 1, 2, 3 * unit), (0, 2, 1, 2 * unit), (0, 3, 2, unit), (50, 1, 2, 3 * unit), (50, 2, 1, 2 * unit), (50, 3, 0, unit)]


def test_top_k_of_nothing_and_of_mixed_lengths(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(df.limit(0), df.limit(0)).count() == 0
    found = {tuple(r) for r in exact_topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()}
    assert found == {(0, 1, 1, 256 * 256 * 5), (50, 1, 2, 256 * 256 * 2)}


def test_pipeline_stages_take_odd_rows(spark, small):
    """Nulls in any column, repeated rows, empty texts and columns called like the stages' own."""
    names = ["score", "predicted", "n_words", "kept_text", "marks", "component_id", "low", "length"]
    docs = frame(spark, [(1, "a plain text"), (1, "a plain text"), (None, "x y"), (3, None), (4, ""), (5, LONG)])
    docs = docs.withColumns({n: F.lit(n) for n in names}).withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.lit(None).cast("long"))
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, small)
            assert out.columns == docs.columns
            assert {r["score"] for r in out.collect()} <= {"score"}
        assert corpus_pipeline.STAGES[-1][1](spark, rows, small).count() >= rows.count()


def test_pipeline_drops_near_copies_by_five_words(spark, small):
    """A copy with 4 of 200 words changed has 176 of 216 5-word shingles, but 186 of 210 3-word ones."""
    base = [f"b{i}" for i in range(200)]
    scattered = [f"n{i}" if i in (30, 80, 120, 170) else w for i, w in enumerate(base)]
    longer, shorter = [*base, *(f"e{i}" for i in range(30))], base[:170]
    other = [f"n{i}" if i % 25 == 5 else w for i, w in enumerate(base)]  # 8 words: 156 of 236
    texts = [" ".join(t) for t in (base, scattered, longer, shorter, other)]
    assert set(linked(list(enumerate(texts[:4]))).values()) == {0, 1, 2, 3}
    expected = linked(list(enumerate(texts)), percent=80, width=5)
    kept = dict(corpus_pipeline.STAGES)["jaccard_dedup"](spark, frame(spark, texts), small)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c in expected.items() if i == c} == {0, 4}


def test_pipeline_stages_against_brute_force(spark, small):
    """Each stage on what its predecessor kept, the classifier taken as given."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    good = by_name["quality"](spark, docs, small).cache()
    assert good.columns == docs.columns and docs.count() * 0.7 < good.count() < docs.count()
    rows = {r["doc_id"]: r["text"] for r in good.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert sum(labels[i] == 0 for i in rows if i in labels) == 0

    plain, seen = {}, set()
    for i in sorted(rows):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", rows[i])
        if key not in seen:
            plain[i] = rows[i]
        seen.add(key)
    distinct = by_name["exact_dedup"](spark, good, small).cache()
    assert {r["doc_id"]: r["text"] for r in distinct.collect()} == plain

    parts = linked(list(plain.items()), percent=80, width=5)
    near = by_name["jaccard_dedup"](spark, distinct, small).cache()
    kept = {i: t for i, t in plain.items() if parts[i] == i}
    assert near.columns == docs.columns and {r["doc_id"]: r["text"] for r in near.collect()} == kept

    expected = {}
    for i, (own, gone) in passages(list(kept.items())).items():
        left = [w for w, g in zip(own, gone, strict=True) if not g]
        if left or not own:
            expected[i] = " ".join(left) if any(gone) else kept[i]
    cut = by_name["substring_dedup"](spark, near, small)
    assert cut.columns == docs.columns
    for r in cut.collect():
        assert r["text"] == expected.pop(r["doc_id"]) and r["n_chars"] == len(r["text"])
    assert not expected
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, small).collect()} == {r["doc_id"] for r in cut.collect()}
