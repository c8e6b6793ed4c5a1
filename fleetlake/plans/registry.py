"""Every query of the library over a data folder: name -> callable(spark, root) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.functions import text as X
from fleetlake.functions.numeric import percent_text, settle
from fleetlake.functions.timing import hour_of
from fleetlake.operators import aggregates as AG
from fleetlake.operators import bayes as BY
from fleetlake.operators import chunking as CH
from fleetlake.operators import features as FE
from fleetlake.operators import ivfpq as IV
from fleetlake.operators import joins as J
from fleetlake.operators import latent as LT
from fleetlake.operators import ml as ML
from fleetlake.operators import monitor as MON
from fleetlake.operators import ranking as R
from fleetlake.operators import retrieval as RT
from fleetlake.operators import textindex as TI
from fleetlake.operators import textops as TX
from fleetlake.operators import wrappers as WR
from fleetlake.plans import dashboard as D
from fleetlake.plans import explore as E
from fleetlake.schemas import check_contract, table_schemas
from fleetlake.session import scratch_dir
from fleetlake.sinks import changes as CG
from fleetlake.sinks import feed as FEED
from fleetlake.sinks import tables as SK
from fleetlake.sources import adapters as A
from fleetlake.sources.tables import read_stream, read_table
from fleetlake.streaming import corrected as CR
from fleetlake.streaming import flows as ST

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

FILTERS = D.Filters(start="2024-01-08", end="2024-01-21", cluster="All", provider="ASIA")
PERIOD = D.Filters(start="2024-01-08", end="2024-01-21")
KEY = ["gpu_id", "window_start"]
NUMERIC = ["avg_temp", "avg_utilization", "prediction"]
SLICES = ["cluster_id", "gpu_type"]


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def settled(df: DataFrame, *exact: str) -> DataFrame:
    """Round every double column to 8 digits for comparison across engines."""
    return df.select(
        *[
            settle(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "double" and f.name not in exact else F.col(f.name)
            for f in df.schema
        ]
    )


def flat_window(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


# Exploration ---------------------------------------------------------------------------------


@query
def q01_inventory_listing(spark, root):
    return E.inventory_listing(A.inventory(spark, root))


@query
def q02_clouds(spark, root):
    return E.clouds(A.inventory(spark, root))


@query
def q03_telemetry_summary(spark, root):
    return E.telemetry_summary(A.telemetry(spark, root))


@query
def q04_reading_types(spark, root):
    return E.reading_types(A.readings(spark, root))


@query
def q05_resolution_rates(spark, root):
    return E.resolution_rates(A.line_events(spark, root))


@query
def q06_top_descriptions(spark, root):
    return E.top_descriptions(A.part_event_counts(spark, root), weight="n")


@query
def q07_jobs_by_framework(spark, root):
    return E.jobs_by_framework(A.jobs(spark, root))


@query
def q08_costly_jobs(spark, root):
    # The five jobs are known before their lines are summed.
    top = R.top_rows(A.job_rows(spark, root), 5, F.col("cost_usd").desc(), "job_id")
    return E.costly_jobs(A.jobs(spark, root, top))


@query
def q09_label_balance(spark, root):
    return E.label_balance(read_table(spark, root, "labels").select(F.col("toxic").alias("is_anomaly")))


def training_set(spark, root):
    return FE.label_window_features(A.labels(spark, root), A.label_readings(spark, root))


@query
def q10_training_summary(spark, root):
    return E.training_summary(training_set(spark, root))


@query
def q11_training_by_label(spark, root):
    return E.training_by_label(training_set(spark, root))


@query
def q12_table_counts(spark, root):
    names = {
        "cluster_inventory": "customer",
        "gpu_telemetry": "events",
        "gpu_health_events": "lineitem",
        "ml_job_runs": "orders",
        "gpu_anomaly_labels": "labels",
        "gpu_runbook_documents": "documents",
    }
    return E.table_counts({name: read_table(spark, root, table) for name, table in names.items()})


@query
def q13_training_set(spark, root):
    return settled(training_set(spark, root))


def located_events(spark, root):
    return A.health_events(spark, root, located=True)


@query
def q14_event_preview(spark, root):
    return E.event_preview(located_events(spark, root))


@query
def q15_job_preview(spark, root):
    return E.job_preview(A.job_rows(spark, root))


# Text ----------------------------------------------------------------------------------------


@query
def q16_classify_events(spark, root):
    events = A.health_events(spark, root)
    return events.select("event_id", "gpu_id", "severity", "description", TX.classify(F.col("description")).alias("root_cause"))


# Function words per language, for documents without a language tag.
LANGUAGES = {
    "en": ["the", "of", "and", "that"],
    "fr": ["le", "les", "que", "des"],
    "de": ["der", "die", "und", "ist"],
    "es": ["el", "los", "una", "del"],
}

# What asks for a number and what for a procedure in the conversations of the data folder.
QUESTION_RULES = {
    "data": "(?:^| )(?:of|and|que|der)(?: |$)",
    "docs": "(?:^| )(?:that|with|los|mit|avec)(?: |$)",
}

CAUSE_PROMPT = "{severity} event on {gpu_id} of cluster {cluster_id}: {description}. Name its cause, the repair and a safeguard."


@query
def q16_classify_documents(spark, root):
    docs = read_table(spark, root, "documents")
    return TX.classify_words(docs.select("doc_id", "text"), "text", LANGUAGES).select("doc_id", "label")


#: Three words that abuse begins with; what else it uses is learned.
ABUSE_SEEDS = {"toxic": ["idiot", "stupid", "moron"]}


@query
def q16_learned_labels(spark, root):
    """Abusive documents, learned from three seed words over all documents."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    model = BY.learn_labels(docs, "doc_id", "text", ABUSE_SEEDS, "clean")
    return BY.labelled(model, docs, "doc_id", "text").select("doc_id", "label")


@query
def q17_extract_jobs(spark, root):
    jobs = A.job_rows(spark, root)
    return jobs.select("job_id", TX.extract(F.col("description"), TX.JOB_FIELDS).alias("m")).select("job_id", "m.*")


@query
def q17_extract_pages(spark, root):
    pages = read_table(spark, root, "pages")
    return pages.select("page_id", TX.extract(F.col("html"), TX.PAGE_FIELDS).alias("m")).select("page_id", "m.*")


@query
def q17_induced_pages(spark, root):
    """The fields of all pages by induced wrappers; every tenth page, by a hash, is an example."""
    pages = read_table(spark, root, "pages")
    shown = pages.where(F.crc32(F.col("page_id").cast("string").cast("binary")) % 10 == 0)
    values = shown.select(F.col("page_id").alias("page"), TX.extract(F.col("html"), TX.PAGE_FIELDS).alias("m")).select("page", "m.*")
    examples = values.unpivot("page", list(TX.PAGE_FIELDS), "field", "value").where("value IS NOT NULL")
    return WR.induce_and_extract(pages, "page_id", "url", "html", examples, list(TX.PAGE_FIELDS))


@query
def page_path_support(spark, root):
    """How many pages of a site have each head path exactly once."""
    paths = WR.page_paths(read_table(spark, root, "pages"), "page_id", "url", "html")
    rows = WR.path_support(paths).where(F.col("path").isin(["html@lang", "html/head/title#", "html/head/meta@charset"]))
    return rows.select("host", "path", "pages", "once", settle(F.col("support")).alias("support"))


@query
def q18_cluster_summaries(spark, root):
    summaries = TX.summarize_groups(located_events(spark, root), ["cluster_id"], "description", 80)
    return R.top_rows(summaries, 10, F.col("event_count").desc(), "cluster_id")


@query
def q18_conversation_summaries(spark, root):
    return TX.summarize_groups(read_table(spark, root, "conversations"), ["conv_id"], "text", 80)


@query
def q18_ranked_summaries(spark, root):
    """The sentences that hold a conversation together, by a walk over shared words."""
    return TX.summarize_by_rank(read_table(spark, root, "conversations"), ["conv_id"], "text", 80)


@query
def q18_cluster_event_log(spark, root):
    return AG.ordered_concat(
        located_events(spark, root),
        ["cluster_id"],
        ["timestamp", "event_id"],
        "description",
        slot=hour_of(F.col("timestamp")),
        part_rows=500,
    )


def critical_prompts(spark, root):
    critical = located_events(spark, root).where(F.col("severity") == "critical")
    columns = {c: F.col(c) for c in ("description", "severity", "gpu_id", "cluster_id")}
    return critical.select("event_id", "cluster_id", "gpu_id", X.fill_template(CAUSE_PROMPT, **columns).alias("prompt"))


@query
def q19_prompts(spark, root):
    return critical_prompts(spark, root)


@query
def q19_completions(spark, root):
    def answer(prompts):
        return [f"{len(p)} characters" for p in prompts]

    return TX.complete(critical_prompts(spark, root), "prompt", answer).drop("prompt")


@query
def q48_routes(spark, root):
    return TX.route_questions(A.questions(spark, root), "text", QUESTION_RULES).select("conv_id", "turn", "route")


@query
def fences_stripped(spark, root):
    """Texts of which every third comes with an SQL fence and every third with a plain one."""
    turns = read_table(spark, root, "conversations")
    fence = F.element_at(F.array(F.lit(""), F.lit("```sql\n"), F.lit("```\n")), (F.col("conv_id") % 3 + 1).cast("int"))
    turns = turns.withColumn("text", F.concat(fence, "text", F.when(fence != "", "\n```").otherwise("")))
    return turns.select("conv_id", "turn", F.md5(X.strip_fences(F.col("text"))).alias("text_md5"))


@query
def unpacked_responses(spark, root):
    """Answer, first source and first query picked from JSON responses that lack a level in some rows."""
    turns = read_table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    sources = F.array(F.struct("role", F.lit(0.5).alias("score")))
    cited = F.struct(F.struct(F.transform(sources, lambda d: F.struct(d["role"].alias("doc_name"), d["score"].alias("score"))).alias("documents")).alias("context"), F.col("text").alias("content"))
    full = F.to_json(F.struct(F.array(F.struct(cited.alias("message"))).alias("choices"), F.array(F.struct(F.struct(F.col("text").alias("query")).alias("query"))).alias("attachments")))
    bare = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"))).alias("choices")))
    kind = F.col("conv_id") % 4
    body = F.when(kind == 0, full).when(kind == 1, bare).when(kind == 2, F.lit('{"choices": []}'))
    rows = turns.withColumn("body", body)
    return rows.select(
        "conv_id",
        "turn",
        F.md5(X.response_text(F.col("body"))).alias("answer_md5"),
        F.try_element_at(X.response_sources(F.col("body")), F.lit(1))["doc_name"].alias("first_source"),
        F.md5(X.first_query(F.col("body"))).alias("query_md5"),
    )


@query
def answers_in_sql(spark, root):
    """A model function called from SQL over all user questions."""
    TX.register_text_functions(spark, lambda prompts: [f"{len(p)} characters" for p in prompts])
    A.questions(spark, root).createOrReplaceTempView("fleet_questions")
    return spark.sql("SELECT conv_id, turn, model_query(text) AS answer FROM fleet_questions")


# Documents and retrieval ---------------------------------------------------------------------


def chunks(spark, root):
    return CH.chunk_documents(read_table(spark, root, "documents"), "doc_id", "text")


@query
def q24_chunks(spark, root):
    return chunks(spark, root).select("chunk_id", "doc_name", "chunk_index", F.md5("content").alias("content_md5"))


@query
def chunks_by_table_function(spark, root):
    """The chunker as a SQL table function; the Column form of q24 is the one to use at scale."""
    CH.register_chunker(spark, "chunk_text")
    read_table(spark, root, "documents").createOrReplaceTempView("fleet_documents")
    return spark.sql("SELECT doc_id, c.chunk_index, md5(c.content) AS content_md5 FROM fleet_documents, LATERAL chunk_text(text) c")


@query
def q25_similar_vectors(spark, root):
    vectors = read_table(spark, root, "embeddings")
    hits = RT.top_k(RT.centroids(vectors, "label"), vectors, "label", "vec_id", k=3)
    return settled(hits)


@query
def q25_cited_context(spark, root):
    vectors = read_table(spark, root, "embeddings")
    hits = RT.top_k(RT.centroids(vectors, "label"), vectors, "label", "vec_id", k=3)
    docs = read_table(spark, root, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    context = RT.assemble_context(hits.join(docs, "vec_id"), "label", "vec_id", "text")
    return context.select("label", F.md5("context").alias("context_md5"), "sources")


@query
def q26_text_search(spark, root):
    """The three documents nearest to each benchmark item by TF-IDF cosine."""
    corpus = read_table(spark, root, "documents").select("doc_id", F.col("text").alias("content"))
    asked = read_table(spark, root, "benchmark").select("item_id", F.col("text").alias("content"))
    return settled(TI.text_top_k(asked, corpus, "item_id", "doc_id", k=3))


@query
def q26_vector_search(spark, root):
    """The same question over the chunks: the 50 nearest by learned vectors, ranked again by TF-IDF cosine."""
    corpus = SK.save_scratch(chunks(spark, root), "chunks")
    rows = LT.counted_tokens(corpus, ("chunk_id",))
    model = LT.fit_counted(rows)
    asked = read_table(spark, root, "benchmark").select("item_id", F.col("text").alias("content"))
    held = rows.withColumn("embedding", LT.embed_counted(model))
    near = RT.top_k(RT.embed(asked, model), held, "item_id", "chunk_id", k=50)
    return settled(TI.reranked(asked, corpus, near, "item_id", "chunk_id", k=3))


@query
def similar_vectors_approx(spark, root):
    """The neighbours of q25_similar_vectors by inverted lists and quantised residuals."""
    vectors = read_table(spark, root, "embeddings")
    return settled(IV.top_k_approx(RT.centroids(vectors, "label"), vectors, "label", "vec_id", k=3))


@query
def index_changes(spark, root):
    """An index of the rated documents and the benchmark items, refreshed with all documents, trimmed."""
    docs = read_table(spark, root, "documents")
    rated = docs.join(read_table(spark, root, "labels").select("doc_id"), "doc_id", "left_semi")
    items = read_table(spark, root, "benchmark").select((F.col("item_id") + 1_000_000_000).alias("doc_id"), "text")
    rated = rated.select("doc_id", "text").unionByName(items)
    indexed = rated.select("doc_id", F.sha2(F.col("text"), 256).alias("content_hash"))
    trimmed = docs.select("doc_id", X.strip_space(F.col("text")).alias("text"))
    return RT.index_changes(indexed, trimmed, "doc_id", "text").select("doc_id", "_change")


# Dashboard and questions ---------------------------------------------------------------------


@query
def q20_hottest_clusters(spark, root):
    return D.hottest_clusters(A.telemetry(spark, root), A.readings(spark, root))


@query
def q21_most_errors(spark, root):
    return D.most_errors(A.telemetry(spark, root), A.readings(spark, root))


@query
def q22_provider_utilization(spark, root):
    return D.provider_utilization(A.telemetry(spark, root), A.clusters(spark, root), "AMERICA")


@query
def q23_longest_jobs(spark, root):
    return D.longest_jobs(A.jobs(spark, root))


@query
def q27_cluster_options(spark, root):
    return D.cluster_options(A.inventory(spark, root))


@query
def q28_provider_options(spark, root):
    return D.provider_options(A.inventory(spark, root))


@query
def q29_tiles(spark, root):
    return D.tiles(A.telemetry(spark, root), located_events(spark, root), A.clusters(spark, root), FILTERS)


@query
def q30_active_alerts(spark, root):
    return D.active_alerts(located_events(spark, root), A.clusters(spark, root), PERIOD)


@query
def q31_heatmap(spark, root):
    return D.heatmap(A.telemetry(spark, root), A.clusters(spark, root), PERIOD)


@query
def q31_heatmap_matrix(spark, root):
    rows = D.heatmap(A.telemetry(spark, root), A.clusters(spark, root), PERIOD, "gpu_type")
    kinds = read_table(spark, root, "customer").select("c_mktsegment").distinct().orderBy("c_mktsegment")
    return settled(D.heatmap_matrix(rows, "gpu_type", [r[0] for r in kinds.collect()]))


@query
def q31_gpu_matrix(spark, root):
    """Readings per cluster and GPU as maps per cluster, here folded to sizes for comparison."""
    readings = A.telemetry(spark, root).withColumn("hot", (F.col("temp_celsius") > 90).cast("double"))
    cells = AG.pivot_map(readings, "cluster_id", "gpu_id", "hot")
    hot = F.size(F.filter(F.map_values("cells"), lambda x: x > 0.5))
    sizes = [F.sum(F.size("cells")).cast("int").alias("gpus"), F.sum(hot).cast("int").alias("mostly_hot")]
    return cells.groupBy("cluster_id").agg(*sizes)


@query
def q32_temperature_series(spark, root):
    return D.temperature_series(A.telemetry(spark, root), A.clusters(spark, root), PERIOD)


@query
def q33_recent_alerts(spark, root):
    return D.recent_alerts(located_events(spark, root), A.clusters(spark, root), PERIOD)


@query
def q44_anomalous_gpus(spark, root):
    return D.anomalous_gpus(A.telemetry(spark, root), "3")


@query
def q47_thermal_warnings(spark, root):
    return D.thermal_warnings(A.readings(spark, root))


# Feature tables ------------------------------------------------------------------------------


@query
def q34_hourly_features(spark, root):
    return settled(FE.hourly_features(A.readings(spark, root)))


def rolling(spark, root):
    return FE.rolling_features(FE.hourly_features(A.readings(spark, root)))


@query
def q34_rolling_features(spark, root):
    return settled(rolling(spark, root).select(*KEY, "error_count_24h", "util_trend"))


@query
def q34_feature_table(spark, root):
    """The feature table with all declared columns, in the declared order and types."""
    return settled(SK.conform(rolling(spark, root), table_schemas()["gpu_health_features"]))


@query
def q35_upsert(spark, root):
    """Feature table up to a day, upserted with the features from the day before it onwards.

    The readings are filtered, not the features: a predicate on the raw time reaches the scan.
    """
    readings, columns = A.readings(spark, root), [*KEY, "avg_temp", "error_count_1h"]
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    old = FE.hourly_features(readings.where(F.col("timestamp") < day)).select(*columns).withColumn("avg_temp", F.lit(0.0))
    new = FE.hourly_features(readings.where(F.col("timestamp") >= day - F.expr("INTERVAL 1 DAY"))).select(*columns)
    return settled(CG.upsert(old, new, KEY))


@query
def q36_labelled_features(spark, root):
    joined = J.join_features_to_labels(FE.hourly_features(A.readings(spark, root)), A.hour_labels(spark, root))
    return settled(joined)


@query
def q41_snapshot_features(spark, root):
    return FE.trailing_snapshot(A.wide_telemetry(spark, root), clock=A.readings(spark, root), window="6 hours")


@query
def q41_recent_snapshot(spark, root):
    """The last 15 minutes of readings per machine, stamped with the instant the run stands for."""
    readings = A.readings(spark, root)
    now = readings.agg(F.max("timestamp")).scalar()
    return FE.stamped(FE.trailing_snapshot(A.wide_telemetry(spark, root), clock=readings, window="15 minutes"), now)


@query
def q42_cluster_snapshot(spark, root):
    snapshot = FE.trailing_snapshot(A.wide_telemetry(spark, root), clock=A.readings(spark, root), window="7 days")
    columns = ["gpu_id", "cluster_id", "avg_temperature", "max_temperature", "avg_utilization", "max_utilization", "avg_power_draw", "reading_count"]
    return snapshot.where(F.col("cluster_id") == "3").select(*columns).orderBy("gpu_id")


@query
def range_join_pairs(spark, root):
    windows = A.labels(spark, root).withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    readings = A.label_readings(spark, root).select("gpu_id", "timestamp", "event_id", "temp_celsius")
    return J.range_join(windows, readings, "gpu_id", "window_start", "window_end", "timestamp")


@query
def asof_features(spark, root):
    """Point-in-time lookup: each label with the newest finished hour of features before it."""
    hourly = FE.hourly_features(A.label_readings(spark, root))
    known = hourly.select("gpu_id", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("known_at"), "avg_temp", "error_count_1h")
    return settled(J.asof_join(A.labels(spark, root), known, "gpu_id", "window_start", "known_at"))


@query
def event_clusters(spark, root):
    events = A.health_events(spark, root).select("event_id", "gpu_id", "severity")
    owners = A.telemetry(spark, root).select("gpu_id", "cluster_id")
    return J.with_cluster_of_gpu(events, owners, A.clusters(spark, root)).select("event_id", "severity", "cluster_name", "cloud_provider")


# Tables and changes --------------------------------------------------------------------------


@query
def snapshot_diff(spark, root):
    """Change rows between the feature table of all readings and that of the non-error readings."""
    readings = A.readings(spark, root)
    columns = [*KEY, "max_temp", "error_count_1h"]
    old = FE.hourly_features(readings).select(*columns)
    new = FE.hourly_features(readings.where(F.col("event_type") != "error")).select(*columns)
    return settled(CG.diff_snapshots(old, new, KEY))


@query
def applied_changes(spark, root):
    """Applying the change rows to the old snapshot gives the new one."""
    readings = A.readings(spark, root)
    columns = [*KEY, "max_temp", "error_count_1h"]
    old = FE.hourly_features(readings).select(*columns)
    new = FE.hourly_features(readings.where(F.col("event_type") != "error")).select(*columns)
    return settled(CG.apply_changes(old, CG.diff_snapshots(old, new, KEY), KEY))


@query
def table_contract(spark, root):
    """Violations when events are checked as a table keyed by (gpu_id, event type)."""
    events = A.health_events(spark, root).withColumn("description", F.nullif("description", F.lit("Network link flapping on port 0")))
    return check_contract(events, table_schemas()["gpu_health_events"], ["gpu_id", "event_type"])


@query
def declared_jobs(spark, root):
    """The job table with all declared columns and types."""
    return SK.conform(A.jobs(spark, root), table_schemas()["ml_job_runs"])


@query
def written_and_evolved(spark, root):
    """Overwrite, append and schema evolution on a written table, read back and summed up."""
    path = scratch_dir(spark, "evolved")
    first = read_table(spark, root, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("place"))
    more = read_table(spark, root, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("place"))
    SK.overwrite(first, f"{path}/a")
    SK.overwrite(first, f"{path}/a")
    SK.append(more, f"{path}/a")
    current = spark.read.parquet(f"{path}/a")
    wider = read_table(spark, root, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    SK.overwrite(SK.evolved(current, wider), f"{path}/b")
    table = spark.read.parquet(f"{path}/b")
    return table.groupBy("place", "brand").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query
def published_versions(spark, root):
    """Two published versions of a table: the newest one is read."""
    base = scratch_dir(spark, "versions")
    nations = read_table(spark, root, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    SK.publish(nations, base)
    suppliers = read_table(spark, root, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    SK.publish(CG.upsert(SK.read_version(spark, base), suppliers, ["c_nationkey"]), base)
    return SK.read_version(spark, base)


@query
def upserted_partitions(spark, root):
    """Upsert into a table partitioned by day that rewrites only the days it touches."""
    path = scratch_dir(spark, "days")
    hourly = FE.hourly_features(A.readings(spark, root)).select(*KEY, "error_count_1h", F.to_date("window_start").alias("day"))
    hourly.write.partitionBy("day").parquet(path)
    late = hourly.where(F.col("day") >= F.lit("2024-01-25").cast("date")).withColumn("error_count_1h", F.col("error_count_1h") + 100)
    CG.upsert_partitions(path, late, KEY, "day")
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("error_count_1h").alias("errors"))


@query
def missing_entities(spark, root):
    """Create-if-absent: customers without any event yet."""
    wanted = read_table(spark, root, "customer").select("c_custkey")
    existing = read_table(spark, root, "events").select(F.col("user_id").alias("c_custkey"))
    return SK.absent_from(wanted, existing, ["c_custkey"])


@query
def latest_versions(spark, root):
    versions = read_table(spark, root, "orders").select("o_orderpriority", F.col("o_orderkey").cast("string").alias("version"))
    return SK.latest_numeric_version(versions, "o_orderpriority", "version")


@query
def formatted_rows(spark, root):
    """Ids, codes, record payloads and percentages as text."""
    supplier = read_table(spark, root, "supplier")
    key = F.col("s_suppkey")
    return supplier.select(
        "s_suppkey",
        X.zero_padded(X.short_code(F.col("s_name"), 6), key, 3).alias("padded_id"),
        X.record_payload("s_suppkey", "s_name", "s_nationkey").alias("payload"),
        percent_text(key / 1000, 2).alias("share"),
    )


# Monitoring ----------------------------------------------------------------------------------


def day_profile(spark, root):
    return MON.profile(
        A.predictions(spark, root), "prediction_timestamp", NUMERIC, ["gpu_type"], ("1 day",), SLICES
    )


@query
def profile_metrics(spark, root):
    return settled(flat_window(day_profile(spark, root)))


@query
def profile_metrics_hourly(spark, root):
    metrics = MON.profile(A.predictions(spark, root), "prediction_timestamp", NUMERIC, [], ("1 hour", "1 day"), SLICES)
    return settled(flat_window(metrics))


@query
def profile_metrics_sketched(spark, root):
    metrics = MON.profile(
        A.predictions(spark, root), "prediction_timestamp", NUMERIC, ["gpu_type"], ("1 day",), SLICES, distinct="approx"
    )
    return settled(flat_window(metrics))


@query
def q38_profile_report(spark, root):
    metrics = MON.profile(A.predictions(spark, root), "prediction_timestamp", NUMERIC, [], ("1 hour", "1 day"), SLICES)
    return settled(flat_window(MON.profile_report(metrics, NUMERIC)))


def day_drift(spark, root):
    return MON.drift(
        A.predictions(spark, root), "prediction_timestamp", ["avg_temp", "avg_utilization"], ["prediction", "gpu_type"], "1 day", SLICES
    )


def drift_statistics(metrics):
    return settled(
        flat_window(metrics).select(
            "window_start",
            "slice_key",
            "slice_value",
            "column_name",
            "n_ref",
            "n_cur",
            F.col("ks_test.statistic").alias("ks_stat"),
            F.col("ks_test.pvalue").alias("ks_pvalue"),
            F.col("chi_squared_test.statistic").alias("chi2_stat"),
        )
    )


@query
def drift_consecutive(spark, root):
    return drift_statistics(day_drift(spark, root))


@query
def q39_drift_report(spark, root):
    return settled(flat_window(MON.drift_report(day_drift(spark, root))))


def first_week(spark, root):
    """Predictions of the first seven days, the baseline of the drift queries."""
    rows = A.predictions(spark, root)
    start = read_table(spark, root, "events").agg(F.min("ts") + F.expr("INTERVAL 7 DAYS")).scalar()
    return rows.where(F.col("prediction_timestamp") < start)


@query
def drift_from_baseline(spark, root):
    return drift_statistics(
        MON.drift(
            A.predictions(spark, root),
            "prediction_timestamp",
            ["avg_temp", "avg_utilization"],
            ["prediction", "gpu_type"],
            "1 day",
            ["gpu_type"],
            baseline=first_week(spark, root),
        )
    )


@query
def retrain_triggers(spark, root):
    rows = MON.retrain_triggers(day_drift(spark, root))
    return settled(flat_window(rows).select("window_start", "slice_key", "slice_value", "column_name", "drift_score", "retrain"))


@query
def q40_anomaly_alerts(spark, root):
    metrics = MON.windowed_metrics(
        A.predictions(spark, root),
        "prediction_timestamp",
        SLICES,
        {"anomaly_rate": "avg(CASE WHEN prediction = 1 THEN 1.0D ELSE 0.0D END)"},
    )
    return settled(flat_window(MON.alerts(metrics, "anomaly_rate", 0.05)))


@query
def profile_quantiles(spark, root):
    """Daily quantiles of the predictions' numbers, read off mergeable summaries."""
    shares = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    return flat_window(MON.value_quantiles(A.predictions(spark, root), "prediction_timestamp", NUMERIC, shares, "1 day", SLICES))


@query
def q45_profile_change(spark, root):
    """Newest daily profiles of the 15-minute feature table, their means against its first week's."""
    columns = ["avg_temperature", "max_temperature", "avg_utilization", "avg_power_draw"]
    span = F.window(F.col("timestamp").cast("timestamp"), "15 minutes")
    wide = A.wide_telemetry(spark, root).groupBy("gpu_id", span.alias("_window")).agg(*FE.snapshot_statistics())
    features = SK.save_scratch(wide.select("gpu_id", F.col("_window.start").cast("timestamp_ntz").alias("window_start"), *columns), "snapshots")
    week = features.agg(F.min("window_start") + F.expr("INTERVAL 7 DAYS")).scalar()
    metrics = MON.profile(features, "window_start", columns, [], ("1 day",), [])
    changed = MON.change_from_baseline(metrics, features.where(F.col("window_start") < week), columns)
    named = {"mean": "mean_value", "stddev": "stddev_value", "min": "min_value", "max": "max_value", "percent_change": "pct_change_from_baseline"}
    rows = flat_window(changed).select("column_name", "window_start", "window_end", *[settle(F.col(c), 2).alias(n) for c, n in named.items()])
    return R.top_rows(rows, 20, F.col("window_end").desc(), "column_name")


@query
def profile_change_previous(spark, root):
    metrics = MON.profile(A.predictions(spark, root), "prediction_timestamp", ["avg_temp", "avg_utilization"], [], ("1 day",), ["gpu_type"])
    rows = flat_window(MON.change_from_previous(metrics))
    return settled(rows.select("window_start", "slice_key", "slice_value", "column_name", "mean", "previous_mean", "percent_change"))


@query
def q46_cohorts(spark, root):
    snapshot = FE.trailing_snapshot(A.wide_telemetry(spark, root), clock=A.readings(spark, root), window="7 days")
    return MON.compare_cohorts(snapshot, F.col("cluster_id") == "3")


# Training and scoring ------------------------------------------------------------------------


@query
def q43_score_flags(spark, root):
    scored = A.predictions(spark, root).select("prediction_timestamp", "cluster_id", "score")
    return settled(ML.with_flag(scored))


def training_rows(spark, root):
    return J.join_features_to_labels(FE.hourly_features(A.readings(spark, root)), A.hour_labels(spark, root))


@query
def q49_split(spark, root):
    return ML.stratified_split(A.hour_labels(spark, root), "is_anomaly", KEY)


@query
def q49_class_weights(spark, root):
    return settled(ML.balanced_weights(A.hour_labels(spark, root), "is_anomaly"))


@query
def q49_class_balance(spark, root):
    return settled(AG.positive_rate(A.hour_labels(spark, root), "is_anomaly"))


@query
def q49_metrics(spark, root):
    """Metrics of the rule score > 0.7 against the error flag, over all predictions."""
    rows = A.predictions(spark, root).select("prediction", (F.col("score") > 0.7).cast("int").alias("said"))
    return settled(ML.binary_metrics(rows, "prediction", "said"))


@query
def q49_promotion(spark, root):
    rows = A.predictions(spark, root)
    models = {
        "score_rule": rows.select("prediction", (F.col("score") > 0.7).cast("int").alias("said")),
        "heat_rule": rows.select("prediction", (F.col("avg_temp") > 90).cast("int").alias("said")),
    }
    return settled(ML.compare_models(models, "prediction", "said"))


@query
def q49_trained_scores(spark, root):
    """Train on the labelled hours and score them, ids kept. The feature table is written first:
    boosting reads its input once per tree and must not redo the aggregation each time."""
    path = scratch_dir(spark, "training")
    split = ML.stratified_split(training_rows(spark, root), "is_anomaly", KEY)
    SK.overwrite(split, path)
    rows = spark.read.parquet(path)
    model = ML.train(rows)
    return ML.score(model, rows).select(*KEY, "is_anomaly", "is_test", "score", "is_anomaly_predicted", "status")


# Streaming -----------------------------------------------------------------------------------


@query
def stream_hourly_features(spark, root):
    """Hourly features of the event stream, upserted batch by batch, equal to the batch table."""
    stream = read_stream(spark, root, "events", ts="ts").select(*A.reading_columns())
    base, checkpoint = scratch_dir(spark, "hourly"), scratch_dir(spark, "hourly-state")
    ST.run_available(ST.hourly_stream(stream), checkpoint, sink=ST.upsert_sink(base), mode="update")
    table = ST.read_merged(spark, base, KEY)
    return settled(table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query
def stream_snapshot_features(spark, root):
    """Fifteen-minute tumbling features of the event stream."""
    stream = read_stream(spark, root, "events", ts="ts").select(*A.wide_columns())
    base, checkpoint = scratch_dir(spark, "quarter"), scratch_dir(spark, "quarter-state")
    ST.run_available(ST.snapshot_stream(stream), checkpoint, sink=ST.upsert_sink(base), mode="update")
    table = ST.read_merged(spark, base, KEY)
    stamps = ["window_start", "window_end", "first_reading", "last_reading"]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query
def stream_document_index(spark, root):
    """An index that follows the arriving documents: one embedded row per document."""
    docs = read_table(spark, root, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"))
    rows = LT.counted_tokens(docs, ("chunk_id",))
    model = LT.fit_counted(rows, dims=64)
    stream = read_stream(spark, root, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"))
    base, checkpoint = scratch_dir(spark, "index"), scratch_dir(spark, "index-state")
    ST.run_available(stream, checkpoint, sink=ST.index_sink(base, model))
    index = ST.read_merged(spark, base, ["chunk_id"])
    whole = rows.select("chunk_id", LT.embed_counted(model).alias("_whole"))
    both = index.join(whole, "chunk_id")
    same = F.col("embedding").eqNullSafe(F.col("_whole")).alias("as_in_batch")
    return both.select("chunk_id", "content_hash", F.size("embedding").alias("dims"), same)


@query
def stream_scored_events(spark, root):
    """Alert flags on the arriving events, appended as they come."""
    stream = read_stream(spark, root, "events").select("event_id", (F.col("value") / 500).alias("score"))
    path, checkpoint = scratch_dir(spark, "scored"), scratch_dir(spark, "scored-state")
    ST.run_available(ML.with_flag(stream), checkpoint, path=path)
    return settled(spark.read.parquet(path))


@query
def stream_model_scores(spark, root):
    """The trained classifier scoring feature rows as they arrive; whether each score is the batch score."""
    path, arriving, out, checkpoint = (scratch_dir(spark, n) for n in ("training", "arriving", "scores", "scores-state"))
    split = ML.stratified_split(training_rows(spark, root), "is_anomaly", KEY)
    SK.overwrite(split, path)
    rows = spark.read.parquet(path)
    model = ML.train(rows, maxIter=20)
    SK.overwrite(rows.select(*KEY, *ML.FEATURES), arriving)
    stream = spark.readStream.schema(spark.read.parquet(arriving).schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    ST.run_available(ML.score(model, stream), checkpoint, path=out)
    whole = ML.score(model, rows).select(*KEY, F.col("score").alias("_whole"), F.col("status").alias("_status"))
    both = spark.read.parquet(out).join(whole, KEY)
    same = (F.abs(F.col("score") - F.col("_whole")) < 1e-12) & (F.col("status") == F.col("_status"))
    return both.select(*KEY, same.alias("as_in_batch"))


def corrected(spark, root, measures, window, columns):
    """Moments of the event stream; a row counts whatever its delay."""
    base, checkpoint = scratch_dir(spark, "moments"), scratch_dir(spark, "moments-state")
    stream = read_stream(spark, root, "events", ts="ts").select(*columns)
    ST.run_available(stream, checkpoint, sink=CR.correcting_sink(base, measures, window=window))
    return CR.corrected_windows(spark, base, measures)


@query
def stream_hourly_corrected(spark, root):
    """Hourly features of the event stream without a watermark, equal to the batch table in any order."""
    table = CR.hourly_table(corrected(spark, root, CR.HOURLY, "1 hour", A.reading_columns()))
    return settled(table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query
def stream_snapshot_corrected(spark, root):
    """Fifteen-minute features of the event stream without a watermark."""
    table = CR.snapshot_table(corrected(spark, root, CR.SNAPSHOT, "15 minutes", A.wide_columns()))
    stamps = ["window_start", "window_end", "first_reading", "last_reading"]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query
def stream_change_feed(spark, root):
    """The changes of two versions of a document table, recorded as they were written and streamed to a
    consumer: rated documents and benchmark items first, then all documents, trimmed."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    rated = docs.join(read_table(spark, root, "labels").select("doc_id"), "doc_id", "left_semi")
    items = read_table(spark, root, "benchmark").select((F.col("item_id") + 1_000_000_000).alias("doc_id"), "text")
    base, out, checkpoint = (scratch_dir(spark, n) for n in ("versions", "consumed", "consumer"))
    FEED.publish_recorded(rated.unionByName(items), base, ["doc_id"])
    ST.run_available(FEED.stream_changes(spark, base), checkpoint, sink=ST.upsert_sink(out))
    FEED.publish_recorded(docs.select("doc_id", X.strip_space(F.col("text")).alias("text")), base, ["doc_id"])
    ST.run_available(FEED.stream_changes(spark, base), checkpoint, sink=ST.upsert_sink(out))
    seen = spark.read.parquet(out)
    return seen.select("doc_id", "_version", "_change", F.sha2("text", 256).alias("content_hash"))
