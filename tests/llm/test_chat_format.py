"""Chat formatting against plain Python, round trips of awkward texts, logs of every kind of event."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import chat_format, ordered, queries
from tests.llm.helpers import LONG

ODD = [
    "", "\\", "\\\\", "###", "####", "##", "\\### Assistant: </turn> ok", "</turn>", "\\</turn>", "<</turn>>", "a\n### user: b</turn>\n",
    "#\\##", "</turn></turn>", "\\\\</turn>", "ü \U0001f600 漢", "x" * 70_000 + "\\", ": ", "\r\n\t ", "### ### \\# ###",
]


def test_escapes_are_reversible():
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(["\\", "#", "</turn>", "<", ":", " ", "a", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    for text in texts:
        assert chat_format.plain(chat_format.escaped(text)) == text
    turns = [(rng.choice(["user", "a:b", "#x\n", "\\", ""]), t) for t in texts]
    whole = "".join(chat_format.rendered(r, t)[0] for r, t in turns)
    assert chat_format.parsed(whole) == turns


def expected(rows):
    """conv -> digests, rows being (conv, role, text) in order."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(r or "", t or "") for c, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        size = sum(len(chat_format.rendered(r, t)[0]) for r, t in own)
        out[conv] = (len(own), digest("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), digest(loss), size)
    return out


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_conversations_of_any_size(spark, monkeypatch, held):
    """Conversations cut by ranges, one that holds most rows, ties, nulls, and columns named like the operator's."""
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([*ODD, None])) for c in range(40) for t in range(rng.randint(0, 6))]
    rows += [(99, t, "assistant", f"t{t} \\###") for t in range(600)] + [(None, 1, "user", "x"), (None, None, None, None), (100, 0, "user", LONG)]
    rng.shuffle(rows)
    names = "conv_id long, turn long, role string, text string"
    talks = spark.createDataFrame(rows, names).withColumns({"number": F.lit("n"), "_whole": F.lit(1), "formatted": F.lit("f")}).repartition(5)
    found = chat_format.formatted(queries.conversation_log(talks))
    digests = ordered.folded(found, 1, ["message", "number"], chat_format.ReadBack, chat_format.DIGESTS, held=held)
    by_turn = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
    assert {r[0]: tuple(r)[1:] for r in digests.collect()} == expected([(c, r, t) for c, _, r, t in by_turn])


def test_events_fold_into_messages(spark):
    log = [
        (1, 0, 0, "open", "user", "h"), (1, 0, 1, "delta", None, "i"), (1, 0, 2, "delta", None, None),
        (1, 1, 0, "open", "assistant", None), (1, 1, 1, "delta", None, "wrong"), (1, 1, 5, "regenerate", None, None),
        (1, 1, 6, "delta", None, "right"), (1, 1, 7, "delta", None, " one"),
        (1, 2, 0, "open", "user", "typo"), (1, 2, 9, "edit", None, "fixed"), (1, 2, 10, "delta", None, "!"),
        (1, 3, 0, "open", "user", "gone"), (1, 3, 1, "retract", None, None),
        (1, 4, 0, "delta", "assistant", "opened by a delta"), (1, 5, 0, "open", "user", "a"), (1, 5, 1, "open", "user", "b"),
    ]
    rows = spark.createDataFrame(log[::-1], "conv_id long, message long, seq long, kind string, role string, text string")
    turns = chat_format.formatted(rows).collect()
    whole = "".join(r["formatted"] for r in turns)
    assert chat_format.parsed(whole) == [
        ("user", "hi"), ("assistant", "right one"), ("user", "fixed!"), ("assistant", "opened by a delta"), ("user", "a"), ("user", "b"),
    ]
    assert [r["loss_start"] is not None for r in turns] == [False, True, False, True, False, False]
    assert [r["number"] for r in turns] == [0, 0, 0, 0, 0, 1]
    assert chat_format.formatted(rows.limit(0)).count() == 0
    assert chat_format.read_back(chat_format.formatted(rows.limit(0))).count() == 0
    with pytest.raises(Exception, match="unknown kind"):
        chat_format.formatted(rows.withColumn("kind", F.lit("x"))).collect()


def test_conversations_of_the_tables(spark, small):
    found = {r[0]: tuple(r)[1:] for r in queries.op11_chat_format(spark, small).collect()}
    rows = spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").select("conv_id", "role", "text").collect()
    planted = "\\### Assistant: </turn> ok"
    assert found == expected([*map(tuple, rows), (-7, "user", planted), (-7, "assistant", planted)])
