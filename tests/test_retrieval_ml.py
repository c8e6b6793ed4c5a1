import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetlake.operators import ivfpq as IV
from fleetlake.operators import latent as LT
from fleetlake.operators import ml as ML
from fleetlake.operators import ranking as R
from fleetlake.operators import retrieval as RT
from fleetlake.operators import textindex as TI
from fleetlake.plans import registry
from fleetlake.sinks import tables as SK


def vectors(spark, n, dims, seed):
    m = np.random.default_rng(seed).normal(size=(n, dims)).astype("float32")
    m /= np.linalg.norm(m, axis=1)[:, None]
    return m, spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id bigint, embedding array<float>")


def brute(q, c, k):
    scores = q.astype("float64") @ c.astype("float64").T
    return {(i, int(j)) for i, row in enumerate(scores) for j in sorted(range(len(row)), key=lambda j: (-row[j], j))[:k]}


@pytest.mark.parametrize("block", [4096, 4])
def test_top_k_equals_brute_force(spark, block):
    c, corpus = vectors(spark, 300, 16, 1)
    q, queries = vectors(spark, 21, 16, 2)
    hits = RT.top_k(queries.withColumnRenamed("id", "qid"), corpus.repartition(5), "qid", "id", 3, block=block).collect()
    assert {(r.qid, r.id) for r in hits} == brute(q, c, 3)
    assert len(hits) == 63 and {r.rank for r in hits} == {1, 2, 3}


def test_text_search_equals_a_dense_product(spark):
    import math
    import re

    texts = ["Fan failure on board", "fan fan FAN", "link down: fan ok", "nothing shared", "", None, "fan"]
    asked = ["fan failure", "link", "absent words"]
    corpus = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    queries = spark.createDataFrame(list(enumerate(asked)), "q long, content string")
    split = lambda t: [w for w in re.split(r"[^a-z0-9]+", (t or "").lower()) if w]
    vocabulary = {w for t in texts for w in split(t)}
    idf = {w: math.log((len(texts) + 1) / (sum(w in split(t) for t in texts) + 1)) for w in vocabulary}

    def unit(text):
        weights = {w: split(text).count(w) * idf[w] for w in split(text) if w in idf}
        length = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / length for w, x in weights.items()}

    want = set()
    for q, text in enumerate(asked):
        scores = [(-round(sum(x * unit(t).get(w, 0) for w, x in unit(text).items()), 8), i) for i, t in enumerate(texts)]
        want |= {(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:3])}
    assert {tuple(r) for r in TI.text_top_k(queries, corpus, "q", "id").collect()} == want


def test_top_k_ties_and_empty_vectors(spark):
    corpus = spark.createDataFrame(
        [(5, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [3.0, 0.0]), (1, [0.0, 1.0]), (7, [0.0, 0.0]), (8, None)], "id int, embedding array<float>"
    ).repartition(3)
    queries = spark.createDataFrame([("q", [1.0, 0.0]), ("zero", [0.0, 0.0])], "qid string, embedding array<float>")
    rows = RT.top_k(queries, corpus, "qid", "id", 2).orderBy("rank").collect()
    assert [(r.qid, r.id, r.rank) for r in rows] == [("q", 2, 1), ("q", 5, 2)]
    assert all(r.score == pytest.approx(1.0) for r in rows)


def test_cosine_column(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(RT.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.96) and got[1] is None


def test_approximate_recall(spark):
    """At least 0.9 of the exact neighbours, k rows for every query, one cell holding most vectors."""
    m, corpus = vectors(spark, 3000, 32, 3)
    crowd = m[:1500] * 0.5 + 1
    rows = [(i + 10_000, [float(x) for x in v]) for i, v in enumerate(crowd)] + [(20_000, [0.0] * 32), (20_001, None), (20_002, [float("nan")] * 32)]
    corpus = corpus.unionByName(spark.createDataFrame(rows, corpus.schema))
    queries = corpus.where("id % 60 = 0 AND id < 20000").withColumnRenamed("id", "qid")
    exact = RT.top_k(queries, corpus.where("id < 20000"), "qid", "id", 3)
    near = IV.top_k_approx(queries, corpus, "qid", "id", 3).cache()
    assert RT.recall(near, exact, "qid", "id").first().recall >= 0.9
    assert {r["count"] for r in near.groupBy("qid").count().collect()} == {3} and near.select("qid").distinct().count() == 75


def test_approximate_search_fills_k_and_takes_odd_tables(spark):
    _, corpus = vectors(spark, 40, 8, 5)
    queries = corpus.withColumnRenamed("id", "qid")
    few = IV.top_k_approx(queries, corpus, "qid", "id", 30, probes=1, rerank=1, cells=6)
    assert {r["count"] for r in few.groupBy("qid").count().collect()} == {30}
    assert IV.top_k_approx(queries, corpus.limit(0), "qid", "id", 3).count() == 0
    assert IV.top_k_approx(queries.limit(0), corpus, "qid", "id", 3).count() == 0


def test_registered_approximate_search(spark):
    root = "/root/testdata/sf0.01"
    exact, near = registry.q25_similar_vectors(spark, root), registry.similar_vectors_approx(spark, root)
    assert RT.recall(near, exact, "label", "vec_id").first().recall >= 0.9
    assert near.count() == exact.count()


def test_text_search_finds_the_right_chunk(spark):
    corpus = spark.createDataFrame(
        [(0, "Throttling starts once the temperature is above 85 degrees"),
         (1, "Repeated ECC memory errors call for a row remap"),
         (2, "Network link flapping on the switch port")],
        "chunk_id int, content string",
    )
    model = RT.text_embedder(corpus, dims=256)
    asked = spark.createDataFrame([("q1", "temperature above 85 degrees"), ("q2", "row remap after memory errors")], "q string, content string")
    hits = RT.top_k(RT.embed(asked, model), RT.embed(corpus, model), "q", "chunk_id", 1)
    assert {r.q: r.chunk_id for r in hits.collect()} == {"q1": 0, "q2": 1}
    context = RT.assemble_context(hits.join(corpus, "chunk_id"), "q", "chunk_id", "content", max_chars=20).orderBy("q").first()
    assert context.context == "[0] Throttling starts on" and context.sources.startswith("0 (score: ")


def test_registered_vector_search_near_the_exact_one(spark, small):
    """At least 0.9 of the exact neighbours are among the 50 nearest by learned vectors."""
    asked = spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", F.col("text").alias("content"))
    exact = TI.text_top_k(asked, registry.chunks(spark, small), "item_id", "chunk_id", k=3).select("item_id", "chunk_id")
    found = registry.q26_vector_search(spark, small).select("item_id", "chunk_id")
    assert exact.count() == found.count() and found.join(exact, ["item_id", "chunk_id"]).count() >= 0.9 * exact.count()


def test_reranking_weighs_only_the_texts_it_is_given(spark, small, monkeypatch):
    """The given pairs have the scores of a search over everything, without postings of other texts."""
    corpus = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.col("text").alias("content"))
    asked = spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", F.col("text").alias("content"))
    exact = TI.text_top_k(asked, corpus, "item_id", "doc_id", k=3)
    saved, save = {}, TI.save_scratch
    monkeypatch.setattr(TI, "save_scratch", lambda df, label: saved.setdefault(label, save(df, label)))
    found = TI.reranked(asked, corpus, exact.select("item_id", "doc_id"), "item_id", "doc_id", k=3).select(*exact.columns)
    assert found.count() == exact.count() and found.exceptAll(exact).count() == 0
    assert "blocks" not in saved
    near = exact.select(F.col("doc_id").alias("_doc")).distinct()
    assert near.count() < corpus.count() and saved["token-counts"].select("_doc").distinct().exceptAll(near).count() == 0


def test_scan_of_many_slices_equals_brute_force(spark):
    """Later slices of a task are held against the k-th score so far; equal scores go by id."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-2, 3, (3500, 4)), np.zeros((1, 4))]).astype(np.float32)
    corpus = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)], "id int, embedding array<float>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (6, 4)) + 0.5)], "q int, embedding array<float>")
    hits = {(r.q, r["rank"]): (r.id, r.score) for r in RT.top_k(asked, corpus.coalesce(1), "q", "id", 7).collect()}
    rows = {r.id: np.array(r.embedding) for r in corpus.collect()}
    for r in asked.collect():
        q = np.array(r.embedding)
        scores = sorted((-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 10), i) for i, v in rows.items() if v.any())
        assert [hits[r.q, n + 1][0] for n in range(7)] == [i for _, i in scores[:7]]
    assert len(hits) == 42


def test_vectors_of_null_and_empty_texts_in_slices(spark):
    model = LT.TextModel(np.linspace(0.1, 1, LT.FEATURES), np.random.default_rng(3).normal(size=(LT.FEATURES, 5)).astype(np.float32))
    tokens = pa.array([[9], None, [], [3, 3, 7], [7, 3, 3]], pa.list_(pa.int32()))
    whole, part = model.vectors(tokens).to_pylist(), model.vectors(tokens.slice(1, 3)).to_pylist()
    assert whole[1:4] == part and whole[1] is None and whole[2] == [0.0] * 5 and whole[3] == whole[4]
    at, w = LT.weighed([3, 3, 7], model.idf)
    assert whole[3] == pytest.approx((w @ model.basis[at]).tolist(), rel=1e-5)


def test_learned_vectors_keep_the_strongest_directions(spark):
    """Against NumPy's SVD of the same matrix; vectors do not depend on partitions."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words[10 * g : 10 * g + 13], 30)) for g in range(3) for _ in range(40)] + ["", None]
    corpus = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    model = LT.fit_text_model(corpus, dims=8, rounds=6)
    tokens = [r[0] for r in corpus.where("content IS NOT NULL").select(LT.hashed_tokens("content")).collect()]
    matrix = np.zeros((len(tokens), LT.FEATURES))
    for i, row in enumerate(tokens):
        at, w = LT.weighed(row, model.idf)
        matrix[i, at] = w
    want = np.linalg.svd(matrix[:, matrix.any(axis=0)], compute_uv=False)[:8]
    assert np.linalg.svd(matrix @ model.basis, compute_uv=False) == pytest.approx(want, rel=1e-3)
    one, two = (sorted(map(tuple, RT.embed(corpus.repartition(n), model).select("id", "embedding").collect())) for n in (1, 7))
    assert one == two and one[-1][1] is None and not any(one[-2][1])


def test_counted_rows_give_the_vectors_of_their_texts(spark):
    texts = ["fan fan link", "", None, "...", "Fan LINK fan", "one two three four"]
    corpus = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = LT.counted_tokens(corpus, ("id",))
    held = {r.id: (r.at, r.n) for r in rows.collect()}
    assert held[0] == held[4] and sorted(held[0][1]) == [1, 2] and held[0][0] == sorted(set(held[0][0]))
    assert held[1] == held[3] == ([], []) and held[2] == (None, None) and held[5][1] == [1] * len(held[5][0])
    model, same = LT.fit_counted(rows, dims=4), LT.fit_text_model(corpus, dims=4)
    assert np.array_equal(model.idf, same.idf) and np.allclose(model.basis @ model.basis.T[:, :50], same.basis @ same.basis.T[:, :50], atol=1e-4)
    got = {r.id: r.v for r in rows.select("id", LT.embed_counted(model).alias("v")).collect()}
    assert got == {r.id: r.embedding for r in RT.embed(corpus, model).collect()} and got[2] is None and any(got[0])


def test_partial_sums_do_not_grow_with_the_partitions(spark):
    def add(batch, total):
        total[TaskContext.get().partitionId()] += batch.num_rows

    sums = LT._summed(spark.range(0, 4000, 1, 100), add, 100, 1)
    assert sums.sum() == 4000 and np.count_nonzero(sums) <= 2 * spark.sparkContext.defaultParallelism


def test_index_refresh_touches_only_changes(spark):
    chunks = spark.createDataFrame([(i, f"text number {i}") for i in range(6)], "chunk_id int, content string")
    model = RT.text_embedder(chunks, dims=64)
    index = RT.build_index(chunks, model)
    later = chunks.where("chunk_id <> 0").withColumn(
        "content", F.when(F.col("chunk_id") == 1, "changed").otherwise(F.col("content"))
    ).unionByName(spark.createDataFrame([(9, "brand new")], "chunk_id int, content string"))
    changes = {r.chunk_id: r._change for r in RT.index_changes(index, later).collect()}
    assert changes == {0: "delete", 1: "update", 9: "insert"}
    fresh = RT.refresh_index(index, later, model)
    want = RT.build_index(later, model)
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, want.collect()))
    assert RT.index_changes(fresh, later).count() == 0


def test_hash_rank_is_the_row_number(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select("id", (F.col("id") % 7 == 0).alias("g"))
    mine = R.ranked_by_hash(df, ["id"], ["g"], digits=2)
    w = Window.partitionBy("g").orderBy(F.md5(F.col("id").cast("string")), "id")
    assert mine.exceptAll(df.withColumn("rank", F.row_number().over(w))).count() == 0


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 20 == 0).cast("int").alias("y"))
    split = ML.stratified_split(df, "y", ["id"])
    sizes = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert sizes == {(0, True): 190, (0, False): 760, (1, True): 10, (1, False): 40}
    again = ML.stratified_split(df.repartition(13), "y", ["id"])
    assert split.exceptAll(again).count() == 0
    assert 100 < ML.sampled_split(df, "y", [0, 1]).count() < 300


def test_weights_and_metrics(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    weights = {r.y: r.weight for r in ML.balanced_weights(df, "y").collect()}
    assert weights == {0: pytest.approx(5 / 6), 1: pytest.approx(5 / 4)}
    m = ML.binary_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.fn, m.precision, m.recall, m.f1) == (1, 1, 1, 0.5, 0.5, 0.5)
    none = ML.binary_metrics(df.withColumn("p", F.lit(0)), "y", "p").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_training_separates_and_keeps_ids(spark):
    n = F.col("id")
    rows = spark.range(600).select(
        n.cast("string").alias("gpu_id"),
        (n % 4 == 0).cast("int").alias("is_anomaly"),
        *[(F.when(n % 4 == 0, 90.0).otherwise(70.0) + (n * 7 % 11)).alias(c) for c in ML.FEATURES],
    )
    split = ML.stratified_split(rows, "is_anomaly", ["gpu_id"])
    model = ML.train(split, maxIter=5, maxDepth=3)
    scored = ML.score(model, split.where("is_test"))
    assert {"gpu_id", "score", "is_anomaly_predicted", "status"} <= set(scored.columns)
    metrics = ML.binary_metrics(scored.withColumn("p", (F.col("score") > 0.5).cast("int")), "is_anomaly", "p").first()
    assert metrics.f1 == 1.0
    ranked = ML.compare_models({"a": scored.withColumn("p", F.lit(0)), "b": scored.withColumn("p", F.col("is_anomaly"))}, "is_anomaly", "p")
    assert {r.model: r.promote for r in ranked.collect()} == {"a": False, "b": True}


def test_pairs_are_scored_by_vectors_of_texts_not_by_rows_of_tokens(spark, monkeypatch):
    """The shuffled rows are pairs and vectors; groups of few texts and queries give the same scores."""
    corpus = spark.range(40).selectExpr("id", "concat('w', id % 3, ' w', id % 5, ' v', id % 7, ' v', id % 7) AS content")
    asked = spark.range(9).selectExpr("id AS q", "concat('w', id % 3, ' v', id % 7, ' unheard') AS content")
    want = {tuple(r) for r in TI.text_top_k(asked, corpus, "q", "id").collect()}
    monkeypatch.setattr(TI, "TEXT_ROWS", 3)
    monkeypatch.setattr(TI, "QUERY_ROWS", 2)
    assert {tuple(r) for r in TI.text_top_k(asked, corpus, "q", "id").collect()} == want and len(want) == 27
    index = TI.build_text_index(corpus, "id")
    heads = TI.unit_weights(TI.token_counts(asked.withColumnRenamed("q", "_query"), "_query", "content"), "_query", index.tokens).withColumnRenamed("weight", "_q")
    pairs = heads.select("_query").distinct().crossJoin(index.postings.select("_doc").distinct())
    heads = SK.save_scratch(heads, "heads")
    scored = TI.exact_scores(index, SK.save_scratch(pairs, "pairs"), heads)
    plain = heads.join(index.postings, "token").groupBy("_query", "_doc").agg(F.round(F.sum(F.col("_q") * F.col("weight")), 8).alias("score"))
    assert {tuple(r) for r in scored.collect()} == {tuple(r) for r in plain.collect()}
    joins = [x for x in scored._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert joins and not any("token" in x for x in joins)


def searched_plainly(asked, corpus, k):
    """Rows with the same id are one text; rows without id count for the number of texts with a token, as one."""
    import math
    import re
    from collections import Counter, defaultdict

    split = lambda t: [w for w in re.split(r"[^a-z0-9]+", (t or "").lower()) if w]

    def counted(rows):
        found = defaultdict(Counter)
        for i, t in rows:
            found[i].update(split(t))
        return found

    texts, queries = counted(corpus), counted(asked)
    df = Counter(w for c in texts.values() for w in c)
    idf = {w: math.log((len(corpus) + 1) / (n + 1)) for w, n in df.items() if n < len(corpus)}

    def unit(c):
        weights = {w: n * idf[w] for w, n in c.items() if w in idf}
        length = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / length for w, x in weights.items()}

    units, want = {i: unit(c) for i, c in texts.items() if i is not None}, set()
    for q, c in queries.items():
        scores = sorted((-round(sum(x * u.get(w, 0) for w, x in unit(c).items()), 8), i) for i, u in units.items()) if q is not None else []
        want |= {(q, i, -s, r + 1) for r, (s, i) in enumerate([x for x in scores if x[0] < 0][:k])}
    return want


def odd_corpus(n):
    """Common, rare and single words, copies, ids that come twice, rows without id, text or words."""
    rng = np.random.default_rng(11)
    words = [f"w{int(x)}" for x in rng.zipf(1.4, 40 * n) % 300]
    rows = [(int(i), " ".join([*words[40 * i : 40 * i + int(rng.integers(1, 40))], f"only{i}", f"pair{i // 2}"])) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(9)] + [(5, "w1 w2 again"), (5, "w2 again"), (None, "w1 w7 lost"), (None, "w7 lost"), (n + 20, None), (n + 21, ""), (n + 22, " -- ")]
    asked = [(q, " ".join([*words[q * 90 : q * 90 + 6], f"only{q}", f"pair{q}", "unheard"])) for q in range(12)]
    return rows, [*asked, (3, "again lost"), (None, "w1 w2"), (40, None), (41, "unheard")]


@pytest.mark.parametrize("common, passes, part", [(1 << 20, 4096, 2048), (60, 4, 16), (0, 1, 7), (500, 5, 50)])
def test_text_search_over_odd_tables_in_small_parts(spark, monkeypatch, common, passes, part):
    """Whatever number of tokens travels to the texts, of queries goes at a time and of texts is a part."""
    rows, asked = odd_corpus(150)
    for name, value in (("COMMON", common), ("PASS_QUERIES", passes), ("TEXT_ROWS", part), ("SLICE_WORDS", part * 20), ("BLOCK_ROWS", 4)):
        monkeypatch.setattr(TI, name, value)
    corpus = spark.createDataFrame(rows, "id long, content string").repartition(3)
    queries = spark.createDataFrame(asked, "q long, content string")
    found = {tuple(r) for r in TI.text_top_k(queries, corpus, "q", "id", k=4).collect()}
    assert found == searched_plainly(asked, rows, 4) and len(found) > 40
    named = TI.text_top_k(queries.selectExpr("'q' || q AS q", "content"), corpus.selectExpr("'d' || id AS id", "content"), "q", "id", k=4).collect()
    assert {tuple(r) for r in named} == searched_plainly([(q if q is None else f"q{q}", t) for q, t in asked], [(i if i is None else f"d{i}", t) for i, t in rows], 4)
    assert TI.text_top_k(queries, corpus.limit(0), "q", "id").count() == TI.text_top_k(queries.limit(0), corpus, "q", "id").count() == 0


def test_text_search_keeps_no_table_of_tokens_and_texts(spark, monkeypatch):
    """What is written is one row per text, the tokens and results of the size of the queries; no pair of a text and a query."""
    corpus = spark.range(400).selectExpr("id", "concat('w', id % 3, ' w', id % 5, ' v', id % 7, ' x', id) AS content")
    asked = spark.range(30).selectExpr("id AS q", "concat('w', id % 3, ' v', id % 7) AS content")
    saved, save = [], TI.save_scratch
    monkeypatch.setattr(TI, "save_scratch", lambda df, label: saved.append(save(df, label)) or saved[-1])
    assert TI.text_top_k(asked, corpus, "q", "id").count() == 90
    assert max(x.count() for x in saved) <= 400 + 15


def test_text_search_opens_only_what_can_reach_the_known_score():
    rng = np.random.default_rng(2)
    texts = [[*(f"c{w}" for w in rng.choice(6, 3, replace=False)), f"r{i % 100}"] for i in range(500)]
    lists = pa.table({"_doc": pa.array(range(500)), "tokens": pa.array(texts), "times": pa.array([[1] * 4] * 500, pa.list_(pa.int32())), "length": pa.array([5.0] * 500)})
    asked = TI.Asked.of(pa.table({"_query": [1] * 3, "token": ["c1", "c2", "r7"], "weight": [0.2, 0.2, 0.96], "idf": [0.3, 0.3, 4.9]}))
    free, bound = TI.Part(lists, asked), TI.Part(lists, asked)
    live, scores = free.best(0, 3, 0.0)
    floor = np.sort(scores)[-3]
    kept, same = bound.best(0, 3, floor)
    assert set(kept) <= set(live) and sorted(same)[-3:] == sorted(scores)[-3:]
    assert bound.opened == 5 < free.opened / 20 and free.seeds(0, 3)[0] <= floor + 1e-12
