"""Text helpers as Column expressions (JVM side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Texts shown for missing answers and sources, and for the two states of a flag.
NO_ANSWER = "No response"
NO_SOURCE = "Unknown"
FLAGGED = "ANOMALY DETECTED"
UNFLAGGED = "Normal"


def strip_space(text: Column) -> Column:
    """Remove leading and trailing ASCII whitespace of every kind (`trim` removes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


# The two fence patterns below.
def strip_fences(text: Column) -> Column:
    """Remove a leading ``` or ```sql fence and a trailing fence from generated text."""
    opened = F.regexp_replace(strip_space(text), r"^```(?:sql)?\s*", "")
    return F.regexp_replace(opened, r"\s*```$", "")


def zero_padded(prefix: Column, number: Column, width: int) -> Column:
    """prefix-007; numbers wider than the pad are kept whole."""
    digits = number.cast("string")
    return F.concat(prefix, F.lit("-"), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def short_code(name: Column, length: int = 6) -> Column:
    """Lower-case name without separators, cut to `length`: 'us-east-1' -> 'useast'."""
    return F.substring(F.regexp_replace(F.lower(name), "[-_]", ""), 1, length)


def fill_template(template: str, **columns: Column) -> Column:
    """A prompt from literal text and columns: fill_template('GPU {gpu}', gpu=col).

    Missing values become empty text, since one null would null the whole prompt.
    """
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def preview(text: Column, length: int = 500) -> Column:
    """First characters, counted in code points."""
    return F.substring(text, 1, length)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    clean = strip_space(text)
    return F.when(clean == "", F.lit(0)).otherwise(F.size(F.split(clean, r"\s+")))


def record_payload(*columns: str) -> Column:
    """The row as a JSON record, the body a scoring service would receive."""
    return F.to_json(F.struct(*columns))


def response_text(body: Column, default: str = NO_ANSWER) -> Column:
    """Text of the first choice in a chat response, with a default at every missing level."""
    return F.coalesce(F.get_json_object(body, "$.choices[0].message.content"), F.lit(default))


def response_sources(body: Column, limit: int = 3) -> Column:
    """At most `limit` cited documents of a chat response as array<struct<doc_name, score>>."""
    shape = "struct<choices:array<struct<message:struct<context:struct<documents:array<struct<doc_name:string,score:double>>>>>>>"
    documents = F.try_element_at(F.from_json(body, shape)["choices"], F.lit(1))["message"]["context"]["documents"]
    named = F.transform(
        documents,
        lambda d: F.struct(
            F.coalesce(d["doc_name"], F.lit(NO_SOURCE)).alias("doc_name"), d["score"].alias("score")
        ),
    )
    return F.slice(named, 1, limit)


def first_query(body: Column) -> Column:
    """SQL of the first attachment that carries a query, or null."""
    shape = "struct<attachments:array<struct<query:struct<query:string>>>>"
    attachments = F.from_json(body, shape)["attachments"]
    with_query = F.filter(attachments, lambda a: a["query"]["query"].isNotNull() & (a["query"]["query"] != ""))
    return F.try_element_at(with_query, F.lit(1))["query"]["query"]


def anomaly_flag(is_anomaly: Column, score: Column, threshold: float = 0.7) -> Column:
    """The reported flag, else score > threshold, else null."""
    return F.coalesce(is_anomaly, score > F.lit(threshold))


def flag_status(flag: Column) -> Column:
    """Null counts as normal."""
    return F.when(flag, F.lit(FLAGGED)).otherwise(F.lit(UNFLAGGED))
