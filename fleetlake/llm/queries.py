"""The operators of this package bound to the tables of a data folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import chat_format, exact_dedup, exact_topk, jaccard_join, language, lexical_search, packing, prefix_trie, quality
from fleetlake.llm import sentencepiece_codec, substring_dedup, token_counts, url_filter
from fleetlake.llm.common import table, written

PIECE_MODEL, WORD_TOKENIZER = "piece_bpe_32k.model", "word_bpe_49k.json"
SITE_RULES = [
    url_filter.SiteRule("block", "net/"),
    url_filter.SiteRule("allow", "example.net/en/"),
    url_filter.SiteRule("block", "example.com/de/"),
    url_filter.SiteRule("allow", "org/fr/"),
]
HOST_GLOBS = [("block", (f"*.*{word}*", "*")) for word in ("casino", "cheap-pills", "free-bets", "spam-farm", "ads-track")]


def fold(count: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip of every whole text."""
    rows = sentencepiece_codec.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept_digests(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learned(docs.filter(fold(4) != 2))
    rows = docs.select("doc_id", "text", (fold(4) == 2).alias("held_out"))
    return language.identified(rows, model, ["doc_id", "held_out"])


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), SITE_RULES, HOST_GLOBS)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(table(spark, sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(3) == 1).alias("held_out"))
    known = written(quality.measured(docs, ["doc_id", "held_out"]), "statistics")
    model = quality.fit(quality.training_rows(known, table(spark, sf_dir, "labels")))
    return quality.scored(known, model, ["doc_id", "held_out"])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def conversation_log(talks: DataFrame) -> DataFrame:
    """Rows of a conversation table as a log in which every row opens a message."""
    return talks.select("conv_id", F.col("turn").alias("message"), F.lit(0).alias("seq"), F.lit("open").alias("kind"), "role", "text")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose two texts hold what the template marks turns with."""
    planted = r"\### Assistant: </turn> ok"
    rows = [(-7, turn, role, planted) for turn, role in enumerate(("user", "assistant"))]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.formatted(conversation_log(talks)))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = (
        op1_sentencepiece, op2_token_counts, op3_exact_dedup, op4_substring_dedup, op5_language,
        op6_url_filter, op7_jaccard_join, op8_exact_topk, op9_quality, op10_packing, op11_chat_format,
        op12_lexical_search, op13_prefix_trie,
    )
    return {f.__name__: f for f in chosen}


ORACLE = {
    "op3_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        ), groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM texts JOIN groups USING (t)
    """,
    "op4_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), places AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM split WHERE len(w) >= 20
        ), windows AS (
            SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS content FROM places
        ), judged AS (
            SELECT doc_id, p, row_number() OVER (PARTITION BY content ORDER BY doc_id, p) > 1 AS again FROM windows
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS word FROM judged WHERE again
        ), kept AS (
            SELECT s.doc_id, len(s.w) AS n_words, u.word, u.place, g.word IS NOT NULL AS removed
            FROM split AS s
            LEFT JOIN (
                SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM split
            ) AS u USING (doc_id)
            LEFT JOIN gone AS g ON g.doc_id = u.doc_id AND g.word = u.place
        )
        SELECT doc_id, any_value(n_words) AS n_words, count(*) FILTER (removed) AS n_removed,
            sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT removed), '')) AS kept_sha256
        FROM kept GROUP BY doc_id
    """,
    "op6_url_filter": r"""
        WITH cut AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), ruled AS (
            SELECT page_id, host, path, CASE
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM cut
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host, 'casino|cheap-pills|free-bets|spam-farm|ads-track') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM split WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
            WHERE 100 * k >= 90 * (x.n + y.n - k)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS other FROM documents
            UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a
        )
        SELECT node AS doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
        FROM reach LEFT JOIN sizes ON sizes.doc_id = node GROUP BY node
    """,
    "op8_exact_topk": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
                AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_chat_format": r"""
        WITH talks AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, 4 + length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g')) + 2 + length(text)
                + length(regexp_replace(text, '[^\\]', '', 'g')) + len(regexp_extract_all(text, '</turn>'))
                + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x))), 0) + 8 AS chars
            FROM talks
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op12_lexical_search": r"""
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), times AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL
        ), lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM times GROUP BY doc_id
        ), totals AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM lengths
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM times, totals GROUP BY term
        ), items AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
            FROM items JOIN times USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_prefix_trie": r"""
        WITH talks AS (
            SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
                length(coalesce(text, '')) AS chars, turn
            FROM conversations WHERE conv_id IS NOT NULL
        ), placed AS (
            SELECT conv_id, said, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos FROM talks
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
            ), 4294967295) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM talks)
        ), parts AS (
            SELECT c.conv_id, 0 AS own, p.pos, said, chars FROM convs AS c JOIN placed AS p ON p.conv_id = c.base AND p.pos <= c.h
            UNION ALL SELECT c.conv_id, 1, p.pos, said, chars FROM convs AS c JOIN placed AS p USING (conv_id) WHERE p.pos > c.h
        ), steps AS (
            SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(said, '') OVER w) AS node, chars FROM parts
            WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
        ), rows AS (
            SELECT conv_id, depth, node, chars FROM steps UNION ALL SELECT conv_id, 0, '', 0 FROM convs
        ), ends AS (SELECT conv_id, arg_max(node, depth) AS node FROM rows GROUP BY conv_id
        ), nodes AS (
            SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(chars) AS chars FROM rows GROUP BY node
        ), links AS (
            SELECT DISTINCT x.node AS node, y.node AS parent FROM rows AS x JOIN rows AS y ON x.conv_id = y.conv_id AND x.depth = y.depth + 1
        ), kids AS (SELECT parent AS node, count(*) AS n FROM links GROUP BY parent
        ), below AS (
            SELECT DISTINCT x.node AS node, y.node AS low FROM rows AS x JOIN rows AS y ON x.conv_id = y.conv_id AND x.depth <= y.depth
        ), totals AS (
            SELECT b.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.chars)::BIGINT AS saved_tokens
            FROM below AS b JOIN nodes AS m ON m.node = b.low LEFT JOIN kids AS k ON k.node = b.low GROUP BY b.node
        ), closed AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM ends GROUP BY node)
        SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens,
            sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes AS m JOIN totals USING (node) LEFT JOIN kids AS k USING (node) LEFT JOIN closed USING (node)
        LEFT JOIN links AS l USING (node) LEFT JOIN nodes AS p ON p.node = l.parent
    """,
}


def oracle_queries() -> dict[str, str]:
    return dict(ORACLE)