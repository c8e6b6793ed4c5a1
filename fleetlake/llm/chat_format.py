"""Chat formatting from event logs: fold every conversation's log into its messages, then render them.

A log row is (conv_id, message, seq, kind, role, text). `message` places a message in its conversation,
`seq` the event among those of that message. `open` starts a message, `delta` appends streamed text, `edit`
puts a new text in place, `regenerate` throws the text away and waits for new deltas, `retract` removes
the message. Two `open` of one place are two messages. A delta, edit or regeneration that comes first
opens the message itself. A later role that is not null replaces the role; null roles and texts are empty.

Rows are dealt by ranges of (conversation, message) and sorted there, so a conversation that holds a third
of the log is folded and rendered by many tasks; one message is one value and must fit in a task. Order
beyond `seq` is by kind, role and text, so repeated rows and ties give the same result on every run.
Null ids, places and numbers sort first; rows without an id are one conversation. An empty log gives no
rows. Columns other than the six named ones are left behind, whatever they are called.

A turn is `### role: text</turn>` and a line end. Inside texts a backslash goes before every backslash, every
`#` of three or more in a row and the `<` of `</turn>`; inside roles before `\\`, `#`, `<`, `:` and line ends.
"""

from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fleetlake.llm.common import bound_batches
from fleetlake.llm.ordered import NOTHING, batched, folded, ordered, values_of

OPEN, END, BREAK = "### ", "</turn>", ": "
IN_TEXT, IN_ROLE, ESCAPED = re.compile(r"\\|#{3,}|</turn>"), re.compile(r"[\\#<:\n]"), re.compile(r"\\(.)", re.S)
KINDS = ("open", "delta", "edit", "regenerate", "retract")
LOG = ["conv_id", "message", "seq", "kind", "role", "text"]
FORMATTED = "conv_id long, message long, number long, role string, formatted string, loss_start long, loss_length long"
DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str) -> str:
    return IN_TEXT.sub(lambda m: "\\" + "\\".join(m[0]) if m[0][0] == "#" else "\\" + m[0], text)


def plain(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its escaped text begins and how long it is, in code points."""
    head = OPEN + IN_ROLE.sub(r"\\\g<0>", role) + BREAK
    body = escaped(text)
    return f"{head}{body}{END}\n", len(head), len(body)


def _unescaped(text: str, mark: str, at: int) -> int:
    """Where the first `mark` from `at` on stands that no backslash escapes."""
    floor = at
    while True:
        found = text.index(mark, at)
        back = found
        while back > floor and text[back - 1] == "\\":
            back -= 1
        if (found - back) % 2 == 0:
            return found
        at = found + 1


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        stop = _unescaped(formatted, BREAK, at + len(OPEN))
        end = _unescaped(formatted, END, stop + len(BREAK))
        turns.append((plain(formatted[at + len(OPEN) : stop]), plain(formatted[stop + len(BREAK) : end])))
        at = end + len(END) + 1
    return turns


def messages(events):
    """(conv_id, message, role, text) of each final message from events in order."""
    key, role, parts, live = NOTHING, "", [], False
    for conv, place, _, kind, own_role, text in events:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of event: {kind}")
        if key is NOTHING or (conv, place) != key or kind == "open":
            if live:
                yield (*key, role, "".join(parts))
            if key is NOTHING or (conv, place) != key or kind == "open":
                key, role, parts, live = (conv, place), "", [], kind != "retract"
        if own_role is not None:
            role = own_role
        if kind == "retract":
            live, parts = False, []
            continue
        live = True
        if kind in ("edit", "regenerate", "open"):
            parts = []
        if kind != "regenerate" and text:
            parts.append(text)
    if live:
        yield (*key, role, "".join(parts))


def formatted(log: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per final message, sorted by conversation, message and number (among the messages of one
    place): role, its formatted turn, and the span of the turn under the loss mask (null: none). The
    turns of a conversation in this order, with nothing between, are its formatted text."""
    bound_batches(log.sparkSession)
    types = dict(conv_id="long", message="long", seq="long", kind="string", role="string", text="string")
    rows = ordered(log.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]), LOG[:2], LOG[2:])
    schema = to_arrow_schema(StructType.fromDDL(FORMATTED))

    def render(it):
        def turns():
            before, number = NOTHING, 0
            for conv, place, role, text in messages(values_of(it)):
                number = number + 1 if (conv, place) == before else 0
                before = (conv, place)
                turn, start, length = rendered(role, text)
                span = (start, length) if role in loss_roles else (None, None)
                yield (conv, place, number, role, turn, *span)

        yield from batched(turns(), schema)

    return rows.mapInArrow(render, FORMATTED)


class ReadBack:
    """Digests of a conversation from its formatted turns and loss spans alone."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = sha256(), sha256()

    def add(self, values) -> None:
        _, _, _, turn, start, length = values
        for role, text in parsed(turn):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            text = plain(turn[start : start + length])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(turn)

    def result(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation of `formatted` rows, as that function leaves them: n_turns, turns_sha256 (role, line
    end, text, line end of each turn), loss_chars and loss_sha256 (texts under the mask, unescaped),
    formatted_chars. A digest is one chain per conversation, streamed in order in constant memory."""
    return folded(turns, 1, ["message", "number"], ReadBack, DIGESTS)
