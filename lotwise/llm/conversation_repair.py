"""Cheapest repair of damaged conversations, with an audit of its edits.

A conversation is its rows by turn, those without a turn first; rows of one turn
by role and then by the SHA-256 of their text. A row's first fault counts: blank
(no character but blanks), duplicate (role and text stood earlier in the
conversation), truncated (its last character that is no blank does not end a
sentence). Edits make the initials of the roles read `(s?(ua)+)?`: keep a row
(free), give it the role user or assistant (3), delete it (4; the only edit for
blank and duplicate rows), insert a row without text (3); a truncated row that
is not deleted adds 3. The audit is the initials of the edits in order (K, R, D,
I); of equally cheap ones it is the least in ASCII.

Method. A dynamic program over rows and four states (nothing, after s, after u,
after a) whose edit prefixes are persistent: a prefix is a node linked to the
one before it, with its binary-lifting ancestors and the rolling hash of its
letters, so that all states share their common past. Equal costs are decided by
searching the longest common prefix over the ancestors' hashes; hashes that
agree are trusted only if the nodes are one and the same, which equal prefixes
always are, else the letters themselves are compared. Each state also carries
the running SHA-256 of its repaired text, so texts are read once and not kept.

Scale. Texts are shuffled once, by conversation, and streamed in order: a task
holds one row, four states and the letters of one audit, however long the
conversation is, as the past that all states share is written out and its nodes
freed (states that no cheapest repair can go through are dropped, so that this
past grows; only while nothing but deletions is open does it not). Duplicates are found without texts: rows are counted per
conversation, role, digest and turn, partially before the shuffle, and come to
the stream as marks that precede their rows. The digest of a conversation's
whole repaired text is sequential by its definition, so one conversation's rows
pass through one task; nothing of them is gathered there.

Defined cases. Null roles and texts are one space. Null ids are one conversation.
A role's initial is its first character; an empty role has none, and so fits
nowhere. Repeated rows are duplicates of one another. An empty table has no
conversations. Other columns are ignored. Turns must be whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = b"KRDI"
RESTORED, DELETED, INSERTED, CUT = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
#: The state that a written initial leads to. States: 0 nothing, 1 after s, 2 after u, 3 after a.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The initial and role that an insertion or a new role writes in each state.
WRITES = {0: "user", 1: "user", 2: "assistant", 3: "user"}
PRIME, BASE = (1 << 61) - 1, 0x1F3A5C7E9B2D4861
SETTLE = 1024


class Node:
    """One edit at the end of a prefix of edits."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None, letter: int):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + letter) % PRIME
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def at_depth(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def letters(self, since: int = 0) -> bytes:
        """The letters after the first `since` ones."""
        out, node = bytearray(), self
        while node.depth > since:
            out.append(node.letter)
            node = node.up[0]
        return bytes(out[::-1])


def parting(a: Node, b: Node) -> tuple[Node, Node]:
    """Two prefixes of one depth at the first letter in which they differ (the same node twice if in none)."""
    if a is b:
        return a, b
    whole = a, b
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and a.up[k].hash != b.up[k].hash:
            a, b = a.up[k], b.up[k]
    if a.hash != b.hash and a.up[0] is b.up[0]:
        return a, b
    a, b = whole  # hashes collided: equal prefixes are one node
    while a.up[0] is not b.up[0]:
        a, b = a.up[0], b.up[0]
    # the first difference is at or after the parting of the nodes
    return next(((x, y) for x, y in zip(_path(whole[0], a.depth), _path(whole[1], a.depth)) if x.letter != y.letter), (a, a))


def _path(node: Node, depth: int) -> list[Node]:
    out = []
    while node.depth >= depth and node.up:
        out.append(node)
        node = node.up[0]
    return out[::-1]


def before(a: Node, b: Node) -> bool:
    """Whether the letters of `a` come before those of `b` in ASCII."""
    depth = min(a.depth, b.depth)
    x, y = parting(a.at_depth(depth), b.at_depth(depth))
    if x is y:
        return a.depth < b.depth
    return x.letter < y.letter


class Repair:
    """The states after the rows read so far: cost, prefix of edits, digest of what is written."""

    def __init__(self, settle: int = SETTLE):
        self.states = {0: (0, Node(None, 0), hashlib.sha256())}
        self.done = bytearray()
        self.settle = self.due = settle
        self._insert()

    def _best(self, offers: list[tuple[int, int, int, str | None]]) -> dict:
        """Of (target, cost added, source and letter, text written) the cheapest per target, then the least in ASCII."""
        best: dict[int, tuple] = {}
        for target, added, source, letter, written in offers:
            cost, node, digest = self.states[source]
            cost += added
            found = best.get(target)
            if found is None or cost < found[0]:
                best[target] = (cost, node, letter, source, digest, written)
            elif cost == found[0] and before(Node(node, letter), Node(found[1], found[2])):
                best[target] = (cost, node, letter, source, digest, written)
        return {t: self._step(*b) for t, b in best.items()}

    @staticmethod
    def _step(cost, node, letter, source, digest, written):
        if written is not None:
            digest = digest.copy()
            digest.update(("\n" + written if source else written).encode())
        return cost, Node(node, letter), digest

    def _insert(self) -> None:
        """Insertions between two rows. They cost, so two in a row are enough to reach every state."""
        for target, sources in ((2, (0, 1, 3)), (3, (2,))):
            offers = [(target, INSERTED, s, INSERT, WRITES[s] + ":") for s in sources if s in self.states]
            for state, found in self._best(offers).items():
                own = self.states.get(state)
                if own is None or found[0] < own[0] or found[0] == own[0] and before(found[1], own[1]):
                    self.states[state] = found

    def row(self, role: str, text: str, gone: bool, cut: bool) -> None:
        """`gone` rows must be deleted, `cut` ones cost more if they are not."""
        offers = []
        follow, more = NEXT.get(role[:1], {}), CUT * cut
        for s in self.states:
            offers.append((s, DELETED, s, DELETE, None))
            if gone:
                continue
            if s in follow:
                offers.append((follow[s], more, s, KEEP, f"{role}:{text}"))
            offers.append((3 if s == 2 else 2, RESTORED + more, s, REROLE, f"{WRITES[s]}:{text}"))
        self.states = self._best(offers)
        self._insert()
        self._prune()
        if max(node.depth for _, node, _ in self.states.values()) >= self.due:
            self._write_out()

    def _prune(self) -> None:
        """Drop the states before the first question once no cheapest repair goes through them.

        Whatever follows them can follow a written answer as well, with at most one kept system row deleted.
        """
        answered = self.states[3][0]
        if 0 in self.states and answered + DELETED < self.states[0][0]:
            del self.states[0]
        if 1 in self.states and answered < self.states[1][0]:
            del self.states[1]

    def _write_out(self) -> None:
        """Letters that all states share are final: keep them as bytes and free their nodes."""
        nodes = [node for _, node, _ in self.states.values()]
        depth = min(n.depth for n in nodes)
        shared = nodes[0].at_depth(depth)
        for n in nodes[1:]:
            x, y = parting(shared, n.at_depth(shared.depth))
            shared = shared if x is y else x.up[0]
        self.done += shared.letters()
        fresh = {id(shared): Node(None, 0)}
        for n in nodes:
            for old in _path(n, shared.depth + 1):
                if id(old) not in fresh:
                    fresh[id(old)] = Node(fresh[id(old.up[0])], old.letter)
        self.states = {s: (c, fresh[id(n)], d) for s, (c, n, d) in self.states.items()}
        self.due = max(self.settle, 2 * max(n.depth for _, n, _ in self.states.values()))

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and SHA-256 of the repaired text."""
        cost, node, digest = self.states[3]
        nothing = self.states.get(0)
        if nothing and (nothing[0] < cost or nothing[0] == cost and before(nothing[1], node)):
            cost, node, digest = nothing
        return cost, (bytes(self.done) + node.letters()).decode(), digest.hexdigest()


class Conversation:
    """Faults and repair of one conversation, row after row in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns, self.initial, self.repair = 0, None, Repair()

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        bare = text.rstrip(BLANKS)
        blank = not bare
        cut = not blank and not again and bare[-1] not in ENDS
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut
        self.repair.row(role, text, blank or again, cut)

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result()


RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)
REPAIRED = "at bigint, role string, text string, edit string"
BATCH = 1000


def _batch(ids: list, rows: list[tuple], kind: pa.DataType, fields: str) -> pa.RecordBatch:
    """Rows under their id as a batch; both lists are emptied."""
    names, types = zip(*(f.split() for f in fields.split(", ")))
    arrow = {"bigint": pa.int64(), "string": pa.string()}
    arrays = [pa.array(ids, kind), *(pa.array(c, arrow[t]) for c, t in zip(zip(*rows), types))]
    ids.clear()
    rows.clear()
    return pa.RecordBatch.from_arrays(arrays, ["conv", *names])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each group of rows seen at an earlier turn after its mark, to one row per conversation."""
    ids, out, kind = [], [], None
    own = conv = seen = last = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for one, turn, role, digest, text, mark in zip(*(c.to_pylist() for c in batch.columns)):
            if own is None or one != conv:
                if own is not None:
                    ids.append(conv)
                    out.append(own.result())
                if len(out) >= BATCH:
                    yield _batch(ids, out, kind, RESULT)
                own, conv, seen, last = Conversation(), one, None, None
            key = (turn, role, digest)
            if mark:
                seen = key
                continue
            own.row(turn, role, text, key == seen or key == last)
            last = key
    if own is not None:
        ids.append(conv)
        out.append(own.result())
        yield _batch(ids, out, kind, RESULT)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its rows in order, to its repaired rows."""
    ids, out, kind = [], [], None
    conv, audit, at, state, n = None, "", 0, 0, 0

    def write(role: str, text: str, edit: str) -> None:
        nonlocal state, n
        ids.append(conv)
        out.append((n, role, text, edit))
        state, n = NEXT[role[:1]][state], n + 1

    def insert() -> None:
        nonlocal at
        while audit[at : at + 1] == "I":
            write(WRITES[state], "", "I")
            at += 1

    for batch in batches:
        kind = batch.schema.field(0).type
        for one, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
            if edits is not None:
                conv, audit, at, state, n = one, edits, 0, 0, 0
            else:
                edit = audit[at]
                at += 1
                if edit != "D":
                    write(WRITES[state] if edit == "R" else role, text, edit)
            insert()
            if len(out) >= BATCH:
                yield _batch(ids, out, kind, REPAIRED)
    if out:
        yield _batch(ids, out, kind, REPAIRED)


def _keyed(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    def whole(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), whole(role).alias("role"),
        F.unhex(F.sha2(whole(text), 256)).alias("digest"), whole(text).alias("text"),
    )


def _in_order(*names: str) -> list:
    return [F.col(n).asc_nulls_first() for n in names]


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation."""
    keyed = _keyed(rows, conv, turn, role, text)
    same = ["conv", "role", "digest"]
    turns = keyed.groupBy(*same, "turn").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*same).orderBy(*_in_order("turn")))
    marks = turns.withColumn("place", place).where("place > 1")
    light = marks.select("conv", "turn", "role", "digest", F.lit("").alias("text"), F.lit(1).alias("mark"))
    both = keyed.withColumn("mark", F.lit(0)).unionByName(light)
    dealt = both.repartition("conv").sortWithinPartitions(*_in_order("conv", "turn", "role", "digest"), F.col("mark").desc())
    kind = dict(keyed.dtypes)["conv"]
    return dealt.mapInArrow(_judge, f"conv {kind}, {RESULT}").withColumnRenamed("conv", conv)


def repaired_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, at, role, text, edit (K, R or I): the repaired conversations; those that lose all rows have none."""
    keyed = _keyed(rows, conv, turn, role, text).withColumn("audit", F.lit(None).cast("string"))
    reports = repair(rows, conv, turn, role, text)
    audits = reports.select(F.col(conv).alias("conv"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    both = keyed.unionByName(audits, allowMissingColumns=True).withColumn("row", F.col("audit").isNull())
    dealt = both.repartition("conv").sortWithinPartitions(*_in_order("conv", "row", "turn", "role", "digest"))
    kind = dict(keyed.dtypes)["conv"]
    out = dealt.select("conv", "role", "text", "audit").mapInArrow(_replay, f"conv {kind}, {REPAIRED}")
    return out.withColumnRenamed("conv", conv)
