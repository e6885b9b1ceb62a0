"""Repair of the structure of conversations.

The rows of a conversation are edited so that its roles read as an optional system turn and
then user and assistant by turns. The cheapest edits are found by a Viterbi pass that keeps
one survivor for each state of that grammar. Survivors are leaves of a tree of edits with
pointers back and counts of references: what no survivor stands on any more goes, and once
all survivors stand on one node, the edits up to it are final and leave the tree. So it
holds only what is still open. Of equally cheap ways to one state the open parts are
compared whole, back to where they meet.

Spark deals conversations, sorts their rows and streams them through the pass. A conversation
comes twice, first as roles and faults only, from which the edits are found (one byte each),
then with its texts, to which they are applied one row at a time. So a conversation of any
length takes one byte a row, and what is open, besides the batch at hand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Costs of the edits; TRUNCATED comes on top where a row that is cut short stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States of s?(ua)+ or nothing: at the start, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEEDS = "uuau"  # what may be put in each state
AFTER = {"u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}

SOUND, BLANK, DUPLICATE, CUT_SHORT = range(4)


class Node:
    """An edit, the one before it, and how many nodes and survivors stand on it."""

    __slots__ = ("before", "depth", "edit", "uses")

    def __init__(self, edit: str, before: Node | None):
        self.edit, self.before, self.uses, self.depth = edit, before, 0, 0
        if before is not None:
            before.uses += 1
            self.depth = before.depth + 1


def first(a: Node, b: Node) -> Node:
    """That of two ways whose edits come first in ASCII, compared whole from where they part."""
    edits: tuple[list[str], list[str]] = ([], [])
    x, y = a, b
    while x is not y:
        if x.depth >= y.depth:
            edits[0].append(x.edit)
            x = x.before
        else:
            edits[1].append(y.edit)
            y = y.before
    return a if edits[0][::-1] <= edits[1][::-1] else b


class Survivors:
    """The cheapest way to each state over the rows so far, the first of equally cheap ones.

    ``final`` holds the edits that all survivors share; ``nodes`` is the size of the tree.
    """

    EASY = 64  # nodes that are let be

    def __init__(self) -> None:
        self.root = Node("", None)
        self.best: dict[int, tuple[int, Node]] = {}
        self.final = bytearray()
        self.nodes, self.limit = 0, self.EASY
        self._stand({START: (0, self.root)})

    def row(self, initial: str, fault: int) -> None:
        """One more row. Before it a turn may be put in; two would only lead back, or be dearer than a deletion."""
        self._insert()
        extra = TRUNCATED if fault == CUT_SHORT else 0
        ways: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.best.items():
            self._way(ways, state, cost + DELETE, self._node("D", node))
            if fault in (BLANK, DUPLICATE):
                continue
            needed = NEEDS[state]
            self._way(ways, AFTER[needed], cost + REROLE + extra, self._node("R", node))
            if initial == needed:
                self._way(ways, AFTER[needed], cost + KEEP + extra, self._node("K", node))
            elif initial == "s" and state == START:
                self._way(ways, SYSTEM, cost + KEEP + extra, self._node("K", node))
        if ASSISTANT in ways:
            # after an assistant's turn all is possible that is before it, but for keeping a
            # system turn; to delete that one instead costs DELETE more at most
            least = ways[ASSISTANT][0]
            for state, more in ((START, DELETE - KEEP), (SYSTEM, 0)):
                if state in ways and ways[state][0] > least + more:
                    self._release(ways.pop(state)[1])
        self._stand(ways)
        if self.nodes > self.limit:
            self._settle()
            self.limit = max(self.EASY, 2 * self.nodes)

    def end(self) -> int:
        """The cost of the cheapest edits, all of which are final."""
        self._insert()
        ends = [self.best[state] for state in (START, ASSISTANT) if state in self.best]
        least = min(cost for cost, _ in ends)
        nodes = [node for cost, node in ends if cost == least]
        chosen = nodes[0] if len(nodes) == 1 else first(*nodes)
        self._stand({START: (least, chosen)})
        self._settle()
        return least

    def _insert(self) -> None:
        ways = dict(self.best)
        for state, (cost, node) in self.best.items():
            self._way(ways, AFTER[NEEDS[state]], cost + INSERT, self._node("I", node))
        self._stand(ways)

    def _node(self, edit: str, before: Node) -> Node:
        self.nodes += 1
        return Node(edit, before)

    def _way(self, ways: dict[int, tuple[int, Node]], state: int, cost: int, node: Node) -> None:
        """Another way to a state; the dearer one, or of equal ones the later, is let go."""
        held = ways.get(state)
        if held is None:
            ways[state] = (cost, node)
            return
        keeps = cost < held[0] or cost == held[0] and first(held[1], node) is node
        lost = held[1] if keeps else node
        if keeps:
            ways[state] = (cost, node)
        self._release(lost)

    def _stand(self, ways: dict[int, tuple[int, Node]]) -> None:
        for _, node in ways.values():
            node.uses += 1
        left, self.best = self.best, ways
        for _, node in left.values():
            node.uses -= 1
            self._release(node)

    def _release(self, node: Node) -> None:
        """Take what nothing stands on off the tree."""
        while node.uses == 0 and node.before is not None:
            before, node.before = node.before, None
            before.uses -= 1
            self.nodes -= 1
            node = before

    def _settle(self) -> None:
        """Emit the edits up to the node on which all survivors stand, which becomes the root."""
        path = []
        node = next(iter(self.best.values()))[1]
        while node is not self.root:
            path.append(node)
            node = node.before
        standing = {id(node) for _, node in self.best.values()}
        while path and self.root.uses == 1 and id(self.root) not in standing:
            self.root = path.pop()
            self.final += self.root.edit.encode()
            self.root.before = None
            self.nodes -= 1


def _ended(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def damaged(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by crc32('conv_id:turn') modulo 20.

    0 drops a row (it stays, marked, for its conversation's sake), 1 empties its text, 2 takes
    the ends of its sentences, 3 repeats it, 4 makes it a user's. Nulls count as one space;
    turns and conversations keep theirs.
    """
    blank = F.lit(" ")
    conv, turn = F.col(f"`{id_col}`"), F.col(f"`{turn_col}`")
    key = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(f"`{text_col}`"), blank)
    rows = conversations.select(
        conv.alias("conv_id"),
        turn.cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(f"`{role_col}`"), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0))).alias("times"),
    )
    return rows.withColumn("times", F.explode("times")).drop("times")


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows with pos, their place in the conversation, fault, and illegal: not to come after the row before.

    A conversation's rows follow turn (nulls first), then role and text by their bytes. The
    first fault counts: blank, duplicate (role and text were there before), cut short.
    """
    held = rows.withColumn("hash", F.sha2("text", 256))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    again = held.filter("not dropped").groupBy("conv_id", "role", "hash").agg(F.min(turn).alias("first"), F.count("*").alias("n"))
    again = again.filter("n > 1").drop("n").alias("g")
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("conv_id", "role", "hash")]
    met = held.alias("h").join(again, same, "left").select("h.*", (turn > F.col("g.first")).alias("later"))

    order = W.partitionBy("conv_id").orderBy(F.desc("dropped"), F.asc_nulls_first("turn"), "role", "text")
    alive = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("hash").alias("hash"))
    before = F.lag(F.when(~F.col("dropped"), alive)).over(order)
    ended = _ended(F.col("text"))
    met = met.withColumns({"pos": F.row_number().over(order), "before": before})
    twin = F.col("before").isNotNull() & F.col("before").eqNullSafe(alive)
    step = F.concat(F.left("before.role", F.lit(1)), F.left("role", F.lit(1)))
    return met.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "dropped",
        "pos",
        F.when(ended == "", BLANK)
        .when(F.coalesce("later", F.lit(False)) | twin, DUPLICATE)
        .when(~F.substring(ended, -1, 1).isin(".", "!", "?"), CUT_SHORT)
        .otherwise(SOUND)
        .alias("fault"),
        F.coalesce(~F.col("dropped") & ~step.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The edited rows of each conversation, in order: conv_id, number, edit, role, text, found.

    Takes ``conv_id, turn, role, text, dropped`` (see ``damaged``). edit is K(eep), R(erole),
    D(elete) or I(nsert); deleted rows are there as they were. The first row of a conversation
    has number 0, no edit, and in found what was wrong and the cost of the edits.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    faulty = with_faults(rows)
    passes = faulty.withColumn("texts", F.explode(F.array(F.lit(False), F.lit(True))))
    passes = passes.filter("not (texts and dropped)").select(
        "conv_id", "turn", "role", F.when(F.col("texts"), F.col("text")).alias("text"), "dropped", "pos", "fault", "illegal", "texts"
    )
    # the window has dealt the rows by conversation already
    passes = passes.sortWithinPartitions("conv_id", "texts", "pos")
    found = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint>"
    return passes.mapInArrow(_edited, f"conv_id {kind}, number bigint, edit string, role string, text string, found {found}")


FOUND = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EDITED = pa.schema(
    [
        ("number", pa.int64()),
        ("edit", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("found", pa.struct([(name, pa.int64()) for name in FOUND])),
    ]
)
ROWS, BYTES = 4096, 1 << 22  # of an output batch


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the batches, a bounded slice of each at a time."""
    for batch in batches:
        for start in range(0, len(batch), 256):
            yield from batch.slice(start, 256).to_pylist()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, out, size = None, [], 0

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        schema = EDITED.insert(0, pa.field("conv_id", kind))
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            yield batch

    for conv, rows in groupby(_read(typed()), key=lambda r: r["conv_id"]):
        for row in edits_of(rows):
            out.append({"conv_id": conv, **row})
            size += len(row["text"] or "")
            if len(out) >= ROWS or size >= BYTES:
                yield batch_of(out)
                out, size = [], 0
    if out:
        yield batch_of(out)


def edits_of(rows: Iterator[dict]) -> Iterator[dict]:
    """Edited rows of one conversation, whose rows come without texts and then with them."""
    survivors, counts, illegal = Survivors(), [0, 0, 0, 0], 0
    low = high = last = None
    distinct = number = at = state = 0
    edits = None

    def close() -> dict:
        nonlocal edits
        cost = survivors.end()
        edits = survivors.final.decode()
        gaps = high - low + 1 - distinct if distinct else 0
        found = dict(zip(FOUND, (gaps, counts[BLANK], counts[DUPLICATE], counts[CUT_SHORT], illegal, cost)))
        return {"number": 0, "edit": None, "role": None, "text": None, "found": found}

    def edited(edit: str, role: str, text: str) -> dict:
        nonlocal number, at, state
        number, at = number + 1, at + 1
        if edit != "D":
            put = role if edit == "K" else ROLES[NEEDS[state]]
            state = SYSTEM if edit == "K" and state == START and role[:1] == "s" else AFTER[NEEDS[state]]
            role = put
        return {"number": number, "edit": edit, "role": role, "text": text, "found": None}

    for row in rows:
        if row["dropped"]:
            continue
        if not row["texts"]:
            survivors.row(row["role"][:1], row["fault"])
            counts[row["fault"]] += 1
            illegal += row["illegal"]
            turn = row["turn"]
            if turn is not None and turn != last:
                low, high, last = turn if low is None else low, turn, turn
                distinct += 1
            continue
        if edits is None:
            yield close()
        while edits[at] == "I":
            yield edited("I", "", "")
        yield edited(edits[at], row["role"], row["text"])
    if edits is None:
        yield close()
    while at < len(edits):
        yield edited("I", "", "")


def digests(edited: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired`` rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Null conversations are one. A conversation without rows has zeros, an empty audit and
    the digest of nothing. Rows follow each other as ``repaired`` left them.
    """
    kind = edited.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{name} bigint" for name in FOUND)
    return edited.mapInArrow(_digested, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = conv = kind = None
    edits, hashed, begun = bytearray(), hashlib.sha256(), False

    def closed() -> pa.RecordBatch:
        fields = [("conv_id", kind), *((n, pa.int64()) for n in FOUND), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        row = {"conv_id": conv, **found, "audit": edits.decode(), "repaired_sha256": hashed.hexdigest()}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema(fields))

    done = []
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in _read([batch]):
            if row["number"] == 0:
                if found is not None:
                    done.append(closed())
                conv, found = row["conv_id"], row["found"]
                edits, hashed, begun = bytearray(), hashlib.sha256(), False
                continue
            edits += row["edit"].encode()
            if row["edit"] != "D":
                hashed.update(("\n" * begun + f"{row['role']}:{row['text']}").encode())
                begun = True
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if found is not None:
        yield closed()
