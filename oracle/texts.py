"""Text, chunk and vector queries."""

from oracle.parts import EVENTS, JOBS, with_

_CAUSES = [
    ("hardware_failure", r"\b(?:power supply|fan failure|module failed|hardware|boards?)\b"),
    ("thermal_throttle", r"\b(?:thermal\w*|throttl\w*|overheat\w*|temperatures?|cooling|fans?)\b"),
    ("memory_error", r"\b(?:ecc|memory|pages? retired|row remap\w*)\b"),
    ("software_bug", r"\b(?:drivers?|kernel|crash\w*|exit codes?|segfaults?|exceptions?)\b"),
    ("network_issue", r"\b(?:networks?|link flap\w*|ports?|infiniband|packets?)\b"),
]
_LANGUAGES = [
    ("en", "'the', 'of', 'and', 'that'"),
    ("fr", "'le', 'les', 'que', 'des'"),
    ("de", "'der', 'die', 'und', 'ist'"),
    ("es", "'el', 'los', 'una', 'del'"),
]


def _best(text: str, rules: list[tuple[str, str]]) -> str:
    return _top([(label, f"len(regexp_extract_all(lower({text}), '{pattern}'))") for label, pattern in rules])


def _top(hits: list[tuple[str, str]]) -> str:
    scores = ", ".join(f"{{'hits': {count}, 'rank': -{i}, 'label': '{label}'}}" for i, (label, count) in enumerate(hits))
    return f"CASE WHEN list_max([{scores}]).hits > 0 THEN list_max([{scores}]).label END"


_SAID = _top([(label, f"len(list_filter(w, lambda x: x IN ({words})))") for label, words in _LANGUAGES])


def _summary(source: str, key: str, text: str) -> str:
    return rf"""pieces AS (SELECT {key}, unnest(regexp_split_to_array({text}, '[.!?]\s+|[.!?]$|\n')) AS piece FROM {source}),
said AS (SELECT {key}, regexp_replace(piece, '^\s+|\s+$', '', 'g') AS sentence FROM pieces),
counted AS (SELECT {key}, sentence, count(*) AS hits FROM said WHERE sentence <> '' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY hits DESC, sentence) AS r FROM counted),
sized AS (SELECT *, sum(len(regexp_split_to_array(sentence, '\s+'))) OVER (PARTITION BY {key} ORDER BY r) AS words FROM ranked),
kept AS (SELECT {key}, r, CASE WHEN words > 80 THEN array_to_string(regexp_split_to_array(sentence, '\s+')[1:80], ' ') ELSE sentence END AS sentence
  FROM sized WHERE words <= 80 OR r = 1),
told AS (SELECT {key}, string_agg(sentence, ' | ' ORDER BY r) AS summary FROM kept GROUP BY 1),
totals AS (SELECT {key}, count(*) AS event_count FROM {source} GROUP BY 1)"""


def _ranked(source: str, key: str, text: str, rounds: int = 4) -> str:
    """The walk of the summaries by rank, its rounds written out one by one."""
    steps = ["x0 AS (SELECT s, hits::DOUBLE AS x FROM named)"]
    for i in range(rounds):
        steps.append(f"m{i} AS (SELECT w, sum(x / words) AS m FROM edges JOIN x{i} USING (s) GROUP BY 1)")
        steps.append(f"b{i} AS (SELECT s, sum(m / sentences) AS y FROM edges JOIN m{i} USING (w) GROUP BY 1)")
        steps.append(f"x{i + 1} AS (SELECT s, (1 - 0.85::DOUBLE) * hits + 0.85::DOUBLE * coalesce(y, 0) AS x FROM named LEFT JOIN b{i} USING (s))")
    plain = _summary(source, key, text).replace(
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY hits DESC, sentence) AS r FROM counted)",
        rf"""named AS (SELECT *, row_number() OVER () AS s FROM counted),
pairs AS (SELECT DISTINCT {key}, s, unnest(regexp_split_to_array(lower(sentence), '[^\p{{L}}\p{{N}}]+')) AS word FROM named),
kept_pairs AS (SELECT s, {key} || ' ' || word AS w FROM pairs WHERE word <> ''),
edges AS (SELECT s, w, count(*) OVER (PARTITION BY s) AS words, count(*) OVER (PARTITION BY w) AS sentences FROM kept_pairs),
{", ".join(steps)},
ranked AS (SELECT {key}, sentence, row_number() OVER (PARTITION BY {key} ORDER BY round(x, 6) DESC, sentence) AS r FROM named JOIN x{rounds} USING (s))""",
    )
    return plain


_PROMPT = """severity || ' event on ' || gpu_id || ' of cluster ' || cluster_id || ': ' || description
  || '. Name its cause, the repair and a safeguard.'"""

_HITS = """cells AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings),
means AS (SELECT label, p, avg(x) AS x FROM cells GROUP BY 1, 2),
asked AS (SELECT label, list(x ORDER BY p) AS q FROM means GROUP BY 1),
scored AS (SELECT asked.label, vec_id, list_dot_product(q, embedding::DOUBLE[])
    / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS score
  FROM asked CROSS JOIN embeddings),
hits AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM scored QUALIFY rank <= 3)"""

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

TEXTS = {
    "q16_classify_events": with_(EVENTS)
    + f"SELECT event_id, gpu_id, severity, description, {_best('description', _CAUSES)} AS root_cause FROM health",
    "q16_classify_documents": rf"""SELECT doc_id, {_SAID} AS label
FROM (SELECT doc_id, regexp_split_to_array(lower(text), '\s+') AS w FROM documents)""",
    "q17_extract_jobs": with_(JOBS)
    + r"""SELECT job_id, nullif(regexp_extract(description, 'with (.+?) on dataset', 1), '') AS framework,
       nullif(regexp_extract(description, '([0-9]+B) ', 1), '') AS model_size,
       nullif(regexp_extract(description, 'on dataset (\S+)', 1), '') AS dataset,
       nullif(regexp_extract(description, 'for (\S+)$', 1), '') AS objective FROM jobs""",
    "q17_extract_pages": """SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS language,
       nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') AS heading,
       nullif(regexp_extract(html, 'charset="([^"]+)"', 1), '') AS charset FROM pages""",
    "q18_cluster_summaries": with_(EVENTS, _summary("health", "cluster_id", "description"))
    + "SELECT cluster_id, event_count, summary FROM totals LEFT JOIN told USING (cluster_id) ORDER BY event_count DESC, cluster_id LIMIT 10",
    "q18_conversation_summaries": with_(_summary("conversations", "conv_id", "text"))
    + "SELECT conv_id, event_count, summary FROM totals LEFT JOIN told USING (conv_id)",
    "q18_ranked_summaries": with_(_ranked("conversations", "conv_id", "text"))
    + "SELECT conv_id, event_count, summary FROM totals LEFT JOIN told USING (conv_id)",
    "q18_cluster_event_log": with_(EVENTS)
    + """, placed AS (SELECT *, (row_number() OVER (PARTITION BY cluster_id ORDER BY "timestamp", event_id) - 1) // 500 AS part FROM health)
SELECT cluster_id, part, string_agg(description, ' | ' ORDER BY "timestamp", event_id) AS combined, count(*) AS texts
FROM placed GROUP BY 1, 2""",
    "q19_prompts": with_(EVENTS)
    + f"SELECT event_id, cluster_id, gpu_id, {_PROMPT} AS prompt FROM health WHERE severity = 'critical'",
    "q19_completions": with_(EVENTS)
    + f"""SELECT event_id, cluster_id, gpu_id, len({_PROMPT}) || ' characters' AS response, CAST(NULL AS VARCHAR) AS error
FROM health WHERE severity = 'critical'""",
    "q48_routes": """SELECT conv_id, turn, CASE WHEN d AND p THEN 'both' WHEN d THEN 'data' WHEN p THEN 'docs' ELSE 'none' END AS route
FROM (SELECT *, regexp_matches(lower(text), '(?:^| )(?:of|and|que|der)(?: |$)') AS d, regexp_matches(lower(text), '(?:^| )(?:that|with|los|mit|avec)(?: |$)') AS p
  FROM conversations WHERE role = 'user')""",
    "q24_chunks": f"""WITH cut AS (SELECT CAST(doc_id AS VARCHAR) AS doc_name, unnest(range(0, len(text), 700)) AS pos, text FROM documents)
SELECT row_number() OVER (ORDER BY md5(doc_name), doc_name, pos) - 1 AS chunk_id, doc_name, CAST(pos // 700 AS INTEGER) AS chunk_index,
       md5({_STRIP.format("substring(text, pos + 1, 800)")}) AS content_md5 FROM cut""",
    "chunks_by_table_function": """SELECT doc_id, CAST(pos // 700 AS INTEGER) AS chunk_index, md5(substring(text, pos + 1, 800)) AS content_md5
FROM (SELECT doc_id, text, unnest(range(0, len(text), 700)) AS pos FROM documents)""",
    "fences_stripped": f"""SELECT conv_id, turn, md5({_STRIP.format("text")}) AS text_md5 FROM conversations""",
    "unpacked_responses": """SELECT conv_id, turn, md5(CASE WHEN k < 2 THEN text ELSE 'No response' END) AS answer_md5,
       CASE WHEN k = 0 THEN role END AS first_source, CASE WHEN k = 0 THEN md5(text) END AS query_md5
FROM (SELECT *, conv_id % 4 AS k FROM conversations)""",
    "answers_in_sql": "SELECT conv_id, turn, len(text) || ' characters' AS answer FROM conversations WHERE role = 'user'",
    "stream_document_index": "SELECT doc_id AS chunk_id, sha256(text) AS content_hash, 64 AS dims, true AS as_in_batch FROM documents",
    "q25_similar_vectors": with_(_HITS) + "SELECT label, vec_id, round(score, 8) AS score, CAST(rank AS INTEGER) AS rank FROM hits",
    "q26_text_search": r"""WITH d AS (SELECT doc_id, token, count(*) AS tf FROM (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS token FROM documents) WHERE token <> '' GROUP BY 1, 2),
q AS (SELECT item_id, token, count(*) AS tf FROM (
  SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS token FROM benchmark) WHERE token <> '' GROUP BY 1, 2),
w AS (SELECT token, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE) AS idf FROM d GROUP BY 1 HAVING idf > 0),
dw AS (SELECT doc_id, token, tf * idf AS x FROM d JOIN w USING (token)), qw AS (SELECT item_id, token, tf * idf AS x FROM q JOIN w USING (token)),
dn AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM dw GROUP BY 1), qn AS (SELECT item_id, sqrt(sum(x * x)) AS n FROM qw GROUP BY 1),
s AS (SELECT item_id, doc_id, round(sum(qw.x / qn.n * (dw.x / dn.n)), 8) AS score
  FROM qw JOIN qn USING (item_id) JOIN dw USING (token) JOIN dn USING (doc_id) GROUP BY 1, 2)
SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 3""",
    "q25_cited_context": with_(_HITS)
    + """SELECT label, md5(string_agg('[' || vec_id || '] ' || substring(text, 1, 500), chr(10) || chr(10) ORDER BY rank)) AS context_md5,
       string_agg(vec_id || ' (score: ' || format('{:.4f}', score) || ')', ', ' ORDER BY rank) AS sources
FROM hits JOIN documents ON doc_id = vec_id GROUP BY 1""",
    "index_changes": f"""WITH old_i AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL SELECT item_id + 1000000000, sha256(text) FROM benchmark),
new_i AS (SELECT doc_id, sha256({_STRIP.format("text")}) AS h FROM documents)
SELECT doc_id, CASE WHEN o.h IS NULL THEN 'insert' WHEN n.h IS NULL THEN 'delete' ELSE 'update' END AS _change
FROM old_i o FULL JOIN new_i n USING (doc_id) WHERE o.h IS DISTINCT FROM n.h""",
    "stream_change_feed": f"""WITH old_i AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL SELECT item_id + 1000000000, text FROM benchmark),
new_i AS (SELECT doc_id, {_STRIP.format("text")} AS text FROM documents)
SELECT doc_id, 1::BIGINT AS _version, 'insert' AS _change, sha256(text) AS content_hash FROM old_i
UNION ALL SELECT doc_id, 2, CASE WHEN o.text IS NULL THEN 'insert' WHEN n.text IS NULL THEN 'delete' ELSE 'update' END, sha256(coalesce(n.text, o.text))
FROM old_i o FULL JOIN new_i n USING (doc_id) WHERE o.text IS DISTINCT FROM n.text""",
    "page_path_support": """WITH hosts AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[^:]*://([^/?#]*)', 1)) AS host, html FROM pages WHERE html IS NOT NULL),
found AS (
  SELECT page_id, host, 'html@lang' AS path, len(regexp_extract_all(html, '<html[^>]* lang=')) AS times FROM hosts
  UNION ALL SELECT page_id, host, 'html/head/title#', len(regexp_extract_all(html, '<title>')) FROM hosts
  UNION ALL SELECT page_id, host, 'html/head/meta@charset', len(regexp_extract_all(html, '<meta charset=')) FROM hosts),
sites AS (SELECT host, count(*) AS pages FROM hosts GROUP BY 1)
SELECT host, path, any_value(pages) AS pages, count(*) AS once, round(count(*) / any_value(pages)::DOUBLE, 8) AS support
FROM found JOIN sites USING (host) WHERE times = 1 GROUP BY 1, 2""",
}
TEXTS["q17_induced_pages"] = TEXTS["q17_extract_pages"]
