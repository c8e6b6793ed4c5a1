"""The prefix trie of conversations, its subtree totals by parallel tree contraction.

Turns are read in order, but only 128 bits of each turn's digest and its length travel. A prefix is named
by two polynomials over those bits, so the prefix sums of a conversation cut by ranges are put together
from its parts: a task numbers its own rows, and what came before is at most two rows a task. A node
is the group of rows with one name; it is addressed by its smallest member and its depth.

Contraction works on the tree of nodes in rounds. Rake: every leaf adds its total to its parent and leaves.
Compress: of the nodes with one child an independent set is spliced out, those whose label is higher than
that of the neighbours in their chain; a label is the place and value of the lowest bit in which a node's
depth differs from its child's, so labels of neighbours differ and regular chains halve. The child then
carries what the spliced node adds. When nothing is left, rounds are expanded in reverse: a spliced
node's total is its own sum, its child's total and what that child carried. All messages to a parent are
sums or maxima, combined before the shuffle, and a message to a child goes to an only child, so no
node, however many children it has, becomes a hot key. Children find their parent's address in one
ordered pass over parents and children.

Null roles and texts are empty. Turns of one place in a conversation are ordered by their digest, and
repeated rows are turns of their own. Rows without a conversation id belong to no conversation and
take no part. Other columns, whatever their names, are not read. Without rows there are no nodes.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetlake.llm.common import BASES, bound_batches, dropped, written
from fleetlake.llm.ordered import batched, folded, ordered, values_of

HEAD = 5
BOTH, WRAP = (BASES[0], BASES[2]), 1 << 64
EMPTY = sha256(b"").hexdigest()


def longs(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names.split()])


SCANNED = longs("conv part pos a b prev_a prev_b chars marker")
MEMBERS = longs("conv depth a b prev_a prev_b chars ends")
PARENTS = longs("conv depth pconv a b")
NODE = longs("conv depth pconv pdepth leaves saved edge_leaves edge_saved kids cconv cdepth cedge_leaves cedge_saved state")


def turns(talks: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, digest, chars), the digest of role and text telling all pairs apart."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.length(who).cast("string"), F.lit(":"), who, said)
    digest = F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest")
    rows = talks.filter(F.col(conv).isNotNull())
    return rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), digest, F.length(said).cast("long").alias("chars"))


def signed(x: int) -> int:
    x %= WRAP
    return x - WRAP if x >> 63 else x


def _scan(it):
    """Places and prefix sums of turns inside their part; at its end a marker for the first and one for the
    last conversation, with its number of turns here and their sums."""
    part = TaskContext.get().partitionId()
    conv, n, sums, weights, marks = None, 0, (0, 0), (1, 1), []

    def rows():
        nonlocal conv, n, sums, weights
        for own, _, digest, chars in values_of(it):
            if own != conv:
                if conv is not None and not marks:
                    marks.append((conv, part, n, *map(signed, sums), 0, 0, 0, 1))
                conv, n, sums, weights = own, 0, (0, 0), (1, 1)
            n, before = n + 1, sums
            weights = tuple(w * base % WRAP for w, base in zip(weights, BOTH, strict=True))
            halves = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:16], "little")
            sums = tuple((s + w * h) % WRAP for s, w, h in zip(sums, weights, halves, strict=True))
            yield (own, part, n, *map(signed, sums), *map(signed, before), chars, 0)
        if conv is not None:
            marks.append((conv, part, n, *map(signed, sums), 0, 0, 0, 1))
        yield from marks

    yield from batched(rows(), to_arrow_schema(SCANNED))


def carried(marks: list) -> dict:
    """(part, conv) -> turns and sums of the earlier parts of a conversation, for parts that have some."""
    out, held = {}, {}
    for row in sorted(marks, key=lambda r: (r["conv"], r["part"])):
        n, a, b = held.get(row["conv"], (0, 0, 0))
        if n:
            out[row["part"], row["conv"]] = (n, a, b)
        a, b = ((x + pow(base, n, WRAP) * row[c]) % WRAP for x, base, c in zip((a, b), BOTH, "ab", strict=True))
        held[row["conv"]] = (n + row["pos"], a, b)
    return out


def prefix_sums(rows: DataFrame) -> DataFrame:
    """(conv, pos, a, b, prev_a, prev_b, chars) of every turn, prev being the prefix one turn shorter."""
    scanned = written(ordered(rows, ["conv", "turn", "digest"], []).mapInArrow(_scan, SCANNED), "prefix-parts")
    carry = carried(scanned.filter("marker = 1").collect())  # at most two rows a task
    plain = scanned.filter("marker = 0").select(*SCANNED.names[:-1])
    if not carry:
        return plain
    shared = rows.sparkSession.sparkContext.broadcast(carry)

    def shift(it):
        def moved():
            for conv, part, pos, a, b, prev_a, prev_b, chars in values_of(it):
                n, *sums = shared.value.get((part, conv), (0, 0, 0))
                if n:
                    steps = [pow(base, n, WRAP) for base in BOTH] * 2
                    pos += n
                    a, b, prev_a, prev_b = (signed(s + w * x) for s, w, x in zip(sums * 2, steps, (a, b, prev_a, prev_b), strict=True))
                yield conv, part, pos, a, b, prev_a, prev_b, chars

        yield from batched(moved(), to_arrow_schema(longs(" ".join(SCANNED.names[:-1]))))

    return plain.mapInArrow(shift, plain.schema)


def rebuilt(rows: DataFrame, group: int = 100) -> DataFrame:
    """MEMBERS: a row per conversation and depth of its rebuilt turns, 0 being the root; the names of the
    prefix and of the one before it, the length of the last text, and whether the conversation ends.

    A conversation c takes the first h turns of c - c % group, h being crc32(c) % 6, then its own after its
    first h. Own prefixes are the head's sums plus the own turns' sums, moved to their new places.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)
    head = F.when(F.col("pos") <= HEAD, F.struct("pos", "a", "b", "chars"))
    own = rows.groupBy("conv").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(head)).alias("own"))
    base = own.select(F.col("conv").alias("base"), F.col("own").alias("head"))
    known = own.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % group}).join(base, "base", "left")
    taken = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array().cast(own.schema["own"].dataType))
    root = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("pos", "a", "b", "chars")])
    mine = F.when(F.col("n") > F.col("h"), F.when(F.col("h") > 0, F.get("own", F.col("h").cast("int") - 1)).otherwise(root))
    starts = known.select("conv", "n", "h", F.concat(F.array(root), taken).alias("head"), mine.alias("mine"))
    starts = written(starts, "conversation-heads")

    def step(i: Column) -> Column:
        at, last = F.get("head", i), F.get("head", F.greatest(i - 1, F.lit(0)))
        ends = ((i == F.size("head") - 1) & (F.col("n") <= F.col("h"))).cast("long")
        return F.struct(i.cast("long").alias("depth"), at["a"].alias("a"), at["b"].alias("b"), last["a"].alias("prev_a"), last["b"].alias("prev_b"), at["chars"].alias("chars"), ends.alias("ends"))

    heads = starts.select("conv", F.explode(F.transform(F.sequence(F.lit(0), F.size("head") - 1), step)).alias("x")).select("conv", "x.*")
    last = F.element_at("head", -1)
    moves = starts.filter("mine IS NOT NULL").select(
        "conv", "n", (F.size("head") - 1 - F.col("h")).alias("shift"), last["a"].alias("to_a"), last["b"].alias("to_b"), F.col("mine.a").alias("from_a"), F.col("mine.b").alias("from_b")
    )
    tails = rows.filter(F.col("pos") > h).join(moves, "conv")
    tails = tails.select("conv", "pos", "a", "b", "prev_a", "prev_b", "chars", "n", "shift", "to_a", "to_b", "from_a", "from_b")
    steps = {s: [pow(base, s, WRAP) for base in BOTH] for s in range(-HEAD, 1)}

    def move(it):
        def moved():
            for conv, pos, a, b, prev_a, prev_b, chars, n, shift, to_a, to_b, from_a, from_b in values_of(it):
                by_a, by_b = steps[shift]
                at = lambda x, y: (signed(to_a + (x - from_a) * by_a), signed(to_b + (y - from_b) * by_b))
                yield (conv, pos + shift, *at(a, b), *at(prev_a, prev_b), chars, int(pos == n))

        yield from batched(moved(), to_arrow_schema(MEMBERS))

    return heads.select(*MEMBERS.names).unionByName(tails.mapInArrow(move, MEMBERS))


class Listed:
    """The digest of ascending ids joined by commas."""

    def __init__(self):
        self.digest, self.some = sha256(), False

    def add(self, values) -> None:
        self.digest.update(b",%d" % values[0] if self.some else b"%d" % values[0])
        self.some = True

    def result(self) -> tuple:
        return (self.digest.hexdigest(),)


def parents_of(nodes: DataFrame) -> DataFrame:
    """(conv, depth, pconv) of every node but the root: parents and children in one order, a parent first."""
    up = nodes.select("depth", "a", "b", F.lit(0).alias("kind"), "conv")
    down = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("prev_a").alias("a"), F.col("prev_b").alias("b"), F.lit(1).alias("kind"), "conv")
    rows = ordered(up.unionByName(down), ["depth", "a", "b", "kind", "conv"], [])

    def follow(it):
        def found():
            key, parent = None, None
            for *own, kind, conv in values_of(it):
                if kind == 0:
                    key, parent = own, conv
                else:
                    yield conv, own[0] + 1, parent if own == key else None, *own[1:]

        yield from batched(found(), to_arrow_schema(PARENTS))

    seen = written(rows.mapInArrow(follow, PARENTS), "parents")
    # The parent of the first rows of a task may lie in an earlier one: at most one name a task.
    cut = seen.filter("pconv IS NULL").select("conv", "depth", "a", "b")
    names = cut.select((F.col("depth") - 1).alias("depth"), "a", "b").distinct()
    known = nodes.join(F.broadcast(names), ["depth", "a", "b"]).select((F.col("depth") + 1).alias("depth"), "a", "b", F.col("conv").alias("pconv"))
    late = cut.join(F.broadcast(known), ["depth", "a", "b"])
    return seen.filter("pconv IS NOT NULL").select("conv", "depth", "pconv").unionByName(late.select("conv", "depth", "pconv"))


def _sent(rows: DataFrame, *messages: tuple[Column, dict]) -> DataFrame:
    """The messages (condition, columns) of every row, one row each; columns not named are null."""
    names = list(dict.fromkeys(n for _, columns in messages for n in columns))
    kind = lambda c: (c if isinstance(c, Column) else F.lit(c)).cast("long")
    made = [F.when(when, F.struct(*[kind(columns.get(n)).alias(n) for n in names])) for when, columns in messages]
    return rows.select(F.explode(F.array(*made)).alias("m")).filter("m IS NOT NULL").select("m.*")


def _own(names: list[str]) -> dict:
    return {n: F.col(n) for n in names}


def contracted(live: DataFrame) -> DataFrame:
    """NODE rows of one round: leaves that were raked (state 0), spliced nodes (1) and those that are left (2)."""
    c, kept = F.col, ["pconv", "pdepth", "leaves", "saved", "edge_leaves", "edge_saved"]
    leaf, child = c("kids") == 0, c("pconv").isNotNull()
    opened = lambda x: F.when(~leaf, x)
    up = dict(
        conv=c("pconv"), depth=c("pdepth"), add_leaves=F.when(leaf, c("leaves") + c("edge_leaves")), add_saved=F.when(leaf, c("saved") + c("edge_saved")),
        kids=opened(F.lit(1)), cconv=opened(c("conv")), cdepth=opened(c("depth")), cedge_leaves=opened(c("edge_leaves")), cedge_saved=opened(c("edge_saved")),
    )
    met = _sent(live, (~leaf, _own(["conv", "depth", *kept])), (child, up)).groupBy("conv", "depth")
    below = ["cconv", "cdepth", "cedge_leaves", "cedge_saved"]
    sums = [F.sum("add_leaves").alias("add_leaves"), F.sum("add_saved").alias("add_saved"), F.coalesce(F.sum("kids"), F.lit(0)).alias("kids")]
    inner = met.agg(*[F.max(n).alias(n) for n in [*kept, *below]], *sums)
    inner = inner.withColumns({n: c(n) + F.coalesce(f"add_{n}", F.lit(0)) for n in ("leaves", "saved")})

    apart = c("depth").bitwiseXOR(c("cdepth"))
    low = apart.bitwiseAND(-apart)
    unary = (c("kids") == 1) & c("pconv").isNotNull()
    inner = inner.withColumn("label", F.when(unary, 2 * low + (c("depth").bitwiseAND(low) != 0).cast("long")))
    kept += ["kids", *below]
    chain = c("label").isNotNull()
    told = _sent(
        inner,
        (F.lit(True), _own(["conv", "depth", *kept, "label"])),
        (chain, dict(conv=c("cconv"), depth=c("cdepth"), above=c("label"))),
        (chain, dict(conv=c("pconv"), depth=c("pdepth"), under=c("label"))),
    )
    near = told.groupBy("conv", "depth").agg(*[F.max(n).alias(n) for n in [*kept, "label", "above", "under"]])
    out = F.coalesce((c("label") > F.coalesce("above", F.lit(-1))) & (c("label") > F.coalesce("under", F.lit(-1))), F.lit(False))
    marked = near.withColumn("state", F.when(out, 1).otherwise(2))
    gone = c("state") == 1
    carry = dict(conv=c("cconv"), depth=c("cdepth"), new_pconv=c("pconv"), new_pdepth=c("pdepth"), more_leaves=c("leaves") + c("edge_leaves"), more_saved=c("saved") + c("edge_saved"))
    heard = _sent(marked, (F.lit(True), _own(["conv", "depth", *kept, "state"])), (gone, carry))
    left = heard.groupBy("conv", "depth").agg(*[F.max(n).alias(n) for n in [*kept, "state", "new_pconv", "new_pdepth", "more_leaves", "more_saved"]])
    changes = {n: F.coalesce(f"new_{n}", n) for n in ("pconv", "pdepth")} | {f"edge_{n}": c(f"edge_{n}") + F.coalesce(f"more_{n}", F.lit(0)) for n in ("leaves", "saved")}
    raked = live.filter(leaf).withColumn("state", F.lit(0).cast("long")).select(*NODE.names)
    return left.withColumns(changes).select(*NODE.names).unionByName(raked)


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(conv, depth, leaves, saved): the sums of `leaves` and `saved` over the subtree of every node of
    `tree` (conv, depth, pconv, pdepth, kids, leaves, saved)."""
    nothing = {n: F.lit(0).cast("long") for n in ("edge_leaves", "edge_saved")} | {n: F.lit(None).cast("long") for n in ("cconv", "cdepth", "cedge_leaves", "cedge_saved")}
    live = tree.withColumns(nothing | {"state": F.lit(2).cast("long")}).select(*NODE.names)
    rounds = []
    while not rounds or not live.isEmpty():
        rounds.append(written(contracted(live), "contracted"))
        live = rounds[-1].filter("state = 2")
    names = ["conv", "depth", "leaves", "saved"]
    later = None
    for done in reversed(rounds):
        found = done.filter("state = 0").select(*names)
        if later is not None:
            below = later.select(F.col("conv").alias("cconv"), F.col("depth").alias("cdepth"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
            spliced = done.filter("state = 1").join(below, ["cconv", "cdepth"])
            sums = [(F.col(n) + F.col(f"cedge_{n}") + F.col(f"more_{n}")).alias(n) for n in ("leaves", "saved")]
            found = found.unionByName(spliced.select("conv", "depth", *sums)).unionByName(later)
        found = written(found, "totals")
        dropped(done, *([later] if later is not None else []))
        later = found
    return later


def trie(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node
    of the trie of rebuilt conversations."""
    bound_batches(talks.sparkSession)
    rows = written(prefix_sums(turns(talks, conv, turn, role, text)), "prefixes")
    members = written(rebuilt(rows), "members")
    dropped(rows)
    grouped = members.groupBy(*["depth", "a", "b"]).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("prev_a").alias("prev_a"), F.max("prev_b").alias("prev_b")
    )
    nodes = written(grouped, "nodes")
    last = ordered(members.filter("ends = 1").select("depth", "a", "b", "conv"), ["depth", "a", "b", "conv"], [])
    ends = folded(last, 3, ["conv"], Listed, "ends_sha256 string")
    parents = parents_of(nodes)
    kids = parents.groupBy(F.col("pconv").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    own = nodes.join(ends, ["depth", "a", "b"], "left").select("conv", "depth", "n_convs", saved, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    tree = own.join(parents, ["conv", "depth"], "left").join(kids, ["conv", "depth"], "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    tree = tree.withColumns({"leaves": (F.col("kids") == 0).cast("long"), "pdepth": F.when(F.col("pconv").isNotNull(), F.col("depth") - 1)})
    tree = written(tree, "tree")
    totals = subtree_totals(tree)
    found = tree.drop("leaves", "saved").join(totals, ["conv", "depth"])
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("pconv").alias("parent_conv_id"), "n_convs", F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
