import pytest
from pyspark.sql import functions as F

from fleetlake.functions import text as X
from fleetlake.functions.numeric import percent_text
from fleetlake.operators import aggregates as AG
from fleetlake.operators import chunking as CH
from fleetlake.operators import textops as TX


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("r")).first().r


@pytest.mark.parametrize("length, count", [(0, 0), (1, 1), (700, 1), (701, 2), (800, 2), (801, 2), (1400, 2), (1401, 3)])
def test_chunk_counts(spark, length, count):
    pieces = one(spark, CH.chunk_column(F.col("t")), t="é" * length)
    assert len(pieces) == count
    assert [len(p) for p in pieces] == [min(800, length - at) for at in range(0, length, 700)]


def test_chunks_reassemble(spark):
    text = "".join(chr(97 + i % 26) for i in range(3333))
    pieces = one(spark, CH.chunk_column(F.col("t"), 50, 7), t=text)
    assert pieces[0] + "".join(p[7:] for p in pieces[1:]) == text


def test_chunk_table_ids_are_dense(spark):
    docs = spark.createDataFrame([(f"d{i}", "x " * (i * 40)) for i in range(50)], "name string, body string")
    table = CH.chunk_documents(docs, "name", "body", digits=1).collect()
    assert sorted(r.chunk_id for r in table) == list(range(len(table)))
    ordered = sorted(table, key=lambda r: r.chunk_id)
    for before, after in zip(ordered, ordered[1:]):
        assert after.chunk_index in (0, before.chunk_index + 1)
    assert all(r.content == r.content.strip() for r in table)


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        CH.chunk_column(F.col("t"), 10, 10)


def test_chunker_in_sql(spark):
    CH.register_chunker(spark, "cut", 5, 2)
    assert [tuple(r) for r in spark.sql("SELECT * FROM cut('abcdefg')").collect()] == [(0, "abcde"), (1, "defg"), (2, "g")]


def test_strip_and_fences(spark):
    assert one(spark, X.strip_space(F.col("t")), t="\n\t a b \r\n") == "a b"
    assert one(spark, X.strip_fences(F.col("t")), t="```sql\nSELECT 1\n```") == "SELECT 1"
    assert one(spark, X.strip_fences(F.col("t")), t="SELECT 1") == "SELECT 1"


def test_ids_and_templates(spark):
    assert one(spark, X.zero_padded(F.col("t"), F.lit(7), 3), t="gpu") == "gpu-007"
    assert one(spark, X.zero_padded(F.col("t"), F.lit(12345), 3), t="gpu") == "gpu-12345"
    assert one(spark, X.short_code(F.col("t")), t="us-east-1") == "useast"
    assert one(spark, X.fill_template("<{a}|{b}>", a=F.col("a"), b=F.col("b")), a="x", b=None) == "<x|>"
    assert one(spark, percent_text(F.col("t").cast("double")), t="0.0512") == "5.12%"


def test_classify(spark):
    rules = {"first": "aa", "second": "bb"}
    assert one(spark, TX.classify(F.col("t"), rules), t="bb aa bb") == "second"
    assert one(spark, TX.classify(F.col("t"), rules), t="AA bb") == "first"
    assert one(spark, TX.classify(F.col("t"), rules), t="none") is None
    assert one(spark, TX.classify(F.col("t"), rules), t=None) is None
    assert one(spark, TX.classify(F.col("t")), t="Driver crash, exit code 3") == "software_bug"


def test_patterns_need_whole_words(spark):
    assert one(spark, TX.classify(F.col("t")), t="A report on the dashboard and its exported keyboards") is None
    df = spark.createDataFrame([("translate the account",), ("how many, and which guide?",), ("Current SLA",), (None,)], "t string")
    assert [r.route for r in TX.route_questions(df, "t").collect()] == ["none", "both", "both", "none"]


def test_classify_words(spark):
    rules = {"en": ["the", "of"], "de": ["der", "die"]}
    df = spark.createDataFrame([("The of der",), ("der\nDIE the",), ("the der",), ("theder",), ("",), (None,)], "t string")
    assert [r.label for r in TX.classify_words(df, "t", rules).collect()] == ["en", "de", "en", None, None, None]


def test_extract(spark):
    got = one(spark, TX.extract(F.col("t"), {"size": r"([0-9]+B) ", "other": "zzz(.)"}), t="a 70B model")
    assert (got.size, got.other) == ("70B", None)


def test_summaries(spark):
    df = spark.createDataFrame(
        [("a", "Fan stopped. Link down."), ("a", "Link down."), ("a", ""), ("b", "w " * 100), ("c", None)], "k string, t string"
    )
    got = {r.k: r for r in TX.summarize_groups(df, ["k"], "t", max_words=3).collect()}
    assert (got["a"].event_count, got["a"].summary) == (3, "Link down")
    assert got["b"].summary == "w w w"
    assert (got["c"].event_count, got["c"].summary) == (1, None)
    whole = {r.k: r.summary for r in TX.summarize_groups(df, ["k"], "t").collect()}
    assert whole["a"] in ("Link down | Fan stopped",  "Link down. | Fan stopped")


def test_ordered_concat_parts_do_not_depend_on_slots(spark):
    df = spark.range(2500).select(F.lit("hot").alias("k"), "id", F.col("id").cast("string").alias("t"))
    for slot in (F.lit(0), F.floor(F.col("id") / 10), F.floor(F.col("id") / 999)):
        parts = AG.ordered_concat(df, ["k"], ["id"], "t", slot, ",", 1000).orderBy("part").collect()
        assert [p.texts for p in parts] == [1000, 1000, 500]
        assert ",".join(p.combined for p in parts) == ",".join(map(str, range(2500)))


def test_completion_errors_stay_in_their_batch(spark):
    df = spark.createDataFrame([(i, "bad" if i == 5 else "ok") for i in range(8)], "id int, p string").coalesce(1)

    def answer(prompts):
        if "bad" in prompts:
            raise RuntimeError("boom")
        return [p.upper() for p in prompts]

    rows = {r.id: r for r in TX.complete(df, "p", answer, batch=4).collect()}
    assert rows[0].response == "OK" and rows[0].error is None
    assert rows[5].response is None and "boom" in rows[5].error and rows[7].error
    TX.register_text_functions(spark, lambda ps: [p + "!" for p in ps])
    assert spark.sql("SELECT model_query('hi') AS r").first().r == "hi!"


def test_routes(spark):
    texts = {
        "How many machines run hot at the moment, by current telemetry?": "data",
        "Give me the steps for replacing a fan": "docs",
        "Seven nodes are showing link errors, what do we do next?": "both",
        "Hello": "none",
    }
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    assert {r.q: r.route for r in TX.route_questions(df, "q").collect()} == texts


def test_responses(spark):
    body = '{"choices":[{"message":{"content":"hi","context":{"documents":[{"doc_name":"a","score":0.5},{"score":0.1},{"doc_name":"c"},{"doc_name":"d"}]}}}]}'
    assert one(spark, X.response_text(F.col("t")), t=body) == "hi"
    assert one(spark, X.response_text(F.col("t")), t="{}") == "No response"
    assert [tuple(s) for s in one(spark, X.response_sources(F.col("t")), t=body)] == [("a", 0.5), ("Unknown", 0.1), ("c", None)]
    assert one(spark, X.response_sources(F.col("t")), t="{}") is None
    found = '{"attachments":[{"text":{}},{"query":{"query":"SELECT 1"}}]}'
    assert one(spark, X.first_query(F.col("t")), t=found) == "SELECT 1"
    assert one(spark, X.first_query(F.col("t")), t="{}") is None
    assert one(spark, X.record_payload("t"), t="x") == '{"t":"x"}'


def test_flags(spark):
    df = spark.createDataFrame([(None, 0.7), (None, 0.71), (False, 0.9), (None, None)], "f boolean, s double")
    flags = df.select(X.anomaly_flag(F.col("f"), F.col("s")).alias("x")).select("x", X.flag_status(F.col("x")).alias("y"))
    assert [tuple(r) for r in flags.collect()] == [
        (False, "Normal"), (True, "ANOMALY DETECTED"), (False, "Normal"), (None, "Normal")
    ]
