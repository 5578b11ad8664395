"""Repair of conversations: the cheapest edits that give a well-formed dialogue.

Every row becomes one sign of a signature: what its role begins with, and
whether it is cut short or has to go. Signatures of all conversations, read from
the end, are put into an acyclic word graph that shares suffixes: a node stands
for a suffix, however many conversations end in it, and holds the cheapest cost
and the best audit from each state of the grammar to the end. To share them over
tasks, distinct signatures are sorted by their reversal, so that those with a
common suffix are neighbours: a task keeps the nodes of the current suffix and
makes only those by which a signature differs from the one before.

Long conversations are cut into pieces of ``PIECE`` rows. For a piece that is not
the last, a node holds cost and audit to each state in which the piece may end,
and the pieces of a conversation are put together from the last to the first.

The grammar: ``(s?(ua)+)?`` over the initials of roles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weblode.llm.common import read_table, share_code, stage
from weblode.llm.op12_merkle import crc32_sql
from weblode.operators.skew import assign_slots, slots_needed

NAME = "op11_conversations"

#: Rows of a piece.
PIECE = 512
#: A signature of more pieces than this is spread over several join keys.
PIECES_PER_SLOT = 100_000

# Costs, states, and what may follow in each.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
_KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: White space: space, tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
MUST_GO = "x"

_FAR = 1 << 60


def _inserts(state: int) -> list[tuple[int, str]]:
    """States that inserts lead to and their audit; more would lead in circles."""
    out, audit = [(state, "")], ""
    while (state := _NEXT[state]) not in [s for s, _ in out]:
        audit += "I"
        out.append((state, audit))
    return out


def _ways(sign: str) -> list[list[tuple[int, str, int]]]:
    """For each state, (cost, audit, next state) of the best way over one row."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        for at, inserted in _inserts(state):
            options = [(DELETE, "D", at)]
            if sign != MUST_GO:
                late = TRUNCATED if sign.isupper() else 0
                options.append((REROLE + late, "R", _NEXT[at]))
                if (at, sign.lower()) in _KEEPS:
                    options.append((late, "K", _KEEPS[at, sign.lower()]))
            for cost, edit, end in options:
                way = (INSERT * len(inserted) + cost, inserted + edit)
                best[end] = min(way, best.get(end, way))
        out.append([(cost, audit, end) for end, (cost, audit) in best.items()])
    return out


WAYS = {sign: _ways(sign) for sign in "suaoSUAO" + MUST_GO}

#: A node: for each exit, (cost, audit) from each state.
Node = list[list[tuple[int, str]]]

#: The end of a conversation, and of a piece that is not the last: there is one
#: exit for each state, and inserts before the next row are made by the next piece.
END: Node = [[(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]]
OPEN: Node = [[(0, "") if state == end else (_FAR, "") for state in range(4)] for end in range(4)]


def before(sign: str, node: Node) -> Node:
    """The node of a suffix with one more sign in front. Audits of equal cost
    are compared whole: none begins with another, as both spend the same."""
    return [
        [min((cost + to[end][0], audit + to[end][1]) for cost, audit, end in ways) for ways in WAYS[sign]]
        for to in node
    ]


_SOLVED = "signature string, last boolean, costs array<long>, audits array<string>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs and audits, exit by exit, of sorted reversed signatures."""
    path, done, kind = [], "", None
    for batch in batches:
        costs, audits = [], []
        for backwards, last in zip(batch["backwards"].to_pylist(), batch["last"].to_pylist(), strict=True):
            if last != kind:
                path, done, kind = [END if last else OPEN], "", last
            shared = next((k for k, (a, b) in enumerate(zip(done, backwards, strict=False)) if a != b), min(len(done), len(backwards)))
            del path[shared + 1 :]
            for sign in backwards[shared:]:
                path.append(before(sign, path[-1]))
            done = backwards
            flat = [entry for to in path[-1] for entry in to]
            costs.append([cost for cost, _ in flat])
            audits.append([audit for _, audit in flat])
        yield pa.RecordBatch.from_arrays(
            [batch["signature"], batch["last"], pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
            names=["signature", "last", "costs", "audits"])


class _Audit:
    """An audit as a chain of pieces, so that a long one is not copied over and over."""

    def __init__(self, text: str, rest: _Audit | None = None):
        self.text, self.rest = text, rest

    def __lt__(self, other: _Audit) -> bool:
        a, i, b, j = self, 0, other, 0
        while a is not None and b is not None and not (a is b and i == j):
            n = min(len(a.text) - i, len(b.text) - j)
            mine, others = a.text[i : i + n], b.text[j : j + n]
            if mine != others:
                return mine < others
            i, j = i + n, j + n
            if i == len(a.text):
                a, i = a.rest, 0
            if j == len(b.text):
                b, j = b.rest, 0
        return a is None and b is not None

    def whole(self) -> str:
        texts, at = [], self
        while at is not None:
            texts.append(at.text)
            at = at.rest
        return "".join(texts)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, cost, audit) from pieces sorted by conversation, last piece first."""
    nothing = object()
    conv, to = nothing, []

    def result(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.string())], names=["conv", "cost", "audit"])

    kind = None
    for batch in batches:
        rows, kind = [], batch["conv"].type
        for own, last, costs, audits in zip(*(batch[c].to_pylist() for c in ("conv", "last", "costs", "audits")), strict=True):
            if last:
                if conv is not nothing:
                    rows.append((conv, to[START][0], to[START][1].whole()))
                conv, to = own, [(cost, _Audit(audit)) for cost, audit in zip(costs, audits, strict=True)]
                continue
            entries = []
            for state in range(4):
                best = None
                for end in range(4):
                    way = (costs[4 * end + state] + to[end][0], _Audit(audits[4 * end + state], to[end][1]))
                    if best is None or way[0] < best[0] or (way[0] == best[0] and way[1] < best[1]):
                        best = way
                entries.append(best)
            to = entries
        if rows:
            yield result(rows)
    if conv is not nothing:
        yield result([(conv, to[START][0], to[START][1].whole())])


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with their place, fault and sign. One shuffle, by conversation: a
    conversation is sorted, and spilled if it is long, not held in memory."""
    one = rows.repartition("conv")
    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    repeated = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    place = F.row_number().over(Window.partitionBy("conv").orderBy(*order)) - 1
    kept = F.rtrim(F.col("text"), F.lit(SPACE))
    numbered = one.withColumn("again", repeated > 1).withColumn("place", place)
    fault = (
        F.when(kept == "", "blank").when(F.col("again"), "duplicate")
        .when(~F.right(kept, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    sign = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    numbered = numbered.select("conv", "turn", "role", "text", "place", fault.alias("fault"), sign.alias("sign"))
    sign = F.when(F.col("fault") == "truncated", F.upper("sign")).when(F.col("fault").isNull(), F.col("sign")).otherwise(MUST_GO)
    return numbered.withColumn("sign", sign)


def audits(numbered: DataFrame, piece: int = PIECE) -> DataFrame:
    """``(conv, cost, audit)`` of the cheapest repair of every conversation."""
    at = F.expr(f"place div {piece}")
    # signs of a piece, last row first
    signs = F.reverse(F.array_sort(F.collect_list(F.struct("place", "sign"))))
    backwards = F.array_join(F.transform(signs, lambda s: s["sign"]), "")
    pieces = numbered.groupBy("conv", at.alias("piece")).agg(backwards.alias("backwards"))
    last = F.col("piece") == F.max("piece").over(Window.partitionBy("conv"))
    pieces = stage(pieces.select("conv", "piece", last.alias("last"), F.col("backwards").alias("signature")))
    kinds = stage(pieces.groupBy("signature", "last").agg(F.count(F.lit(1)).alias("n")))
    words = kinds.select("signature", "last", F.col("signature").alias("backwards"))
    solved = words.repartitionByRange("last", "backwards").sortWithinPartitions("last", "backwards").mapInArrow(_solve, _SOLVED)
    # a signature of very many conversations is joined slot by slot
    named = F.concat(F.col("last").cast("string"), "signature").alias("named")
    heavy = kinds.where(F.col("n") > PIECES_PER_SLOT).select(named, slots_needed("n", PIECES_PER_SLOT).alias("slots"))
    n_heavy = heavy.count()
    spread, keys = assign_slots(pieces.select("conv", "piece", "last", named), "named", "conv", heavy, n_heavy), ["named"]
    solved = solved.select(named, "costs", "audits")
    if n_heavy:
        slots = F.coalesce("slots", F.lit(1))
        solved = solved.join(heavy, "named", "left").withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("slots")
        keys = ["named", "slot"]
    found = spread.join(solved, keys).select("conv", "piece", "last", "costs", "audits")
    found = found.repartition("conv").sortWithinPartitions(F.col("conv"), F.col("piece").desc())
    schema = StructType([StructField("conv", numbered.schema["conv"].dataType), *StructType.fromDDL("cost long, audit string")])
    return found.mapInArrow(_joined, schema)


class _Conversation:
    """Applies an audit to rows as they come."""

    def __init__(self, conv, hold: bool):
        self.conv, self.hold, self.audit, self.cost, self.at, self.state = conv, hold, "", 0, 0, START
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.initial = None
        self.turns = self.illegal = 0
        self.sha, self.lines, self.rows = hashlib.sha256(), 0, []

    def _line(self, role: str, text: str, edit: str, turn: int | None) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        if self.hold:
            self.rows.append((self.conv, self.lines, turn, role, text, edit))
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, _NEXT[self.state]
            self._line(_ROLE[self.state], "", "insert", None)

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.high:  # turns ascend
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = _NEXT[self.state]
            self._line(_ROLE[self.state], text, "rerole", turn)
        elif edit == "K":
            self.state = _KEEPS[self.state, role[:1]]
            self._line(role, text, "keep", turn)

    def result(self) -> tuple:
        self._inserted()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.audit, self.sha.hexdigest())


_RESULT = ["gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string",
           "repaired_sha256 string"]
_ROWS = ["place long", "turn long", "role string", "text string", "edit string"]
#: Rows that are handed on at once.
_BATCH = 1000


def _apply(hold: bool, types: list[pa.DataType], names: list[str]):
    """Conversations whose rows come in order, behind their audit."""

    def packed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), [kind, *types], strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], names=["conv", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, kind = None, [], pa.null()
        for batch in batches:
            kind = batch["conv"].type
            columns = (batch[c].to_pylist() for c in ("conv", "kind", "turn", "role", "text", "fault", "cost", "audit"))
            for conv, which, turn, role, text, fault, cost, audit in zip(*columns, strict=True):
                if current is None or conv != current.conv:
                    if current is not None:
                        result = current.result()
                        out += current.rows if hold else [result]
                    current = _Conversation(conv, hold)
                if which == 1:
                    current.audit, current.cost = audit, cost
                elif which == 2:
                    current.row(turn, role, text, fault)
                if hold and len(current.rows) >= _BATCH:
                    out, current.rows = out + current.rows, []
                if len(out) >= _BATCH:
                    yield packed(out, kind)
                    out = []
        if current is not None:
            result = current.result()
            out += current.rows if hold else [result]
        if out:
            yield packed(out, kind)

    return run


def _sorted(rows: DataFrame, piece: int) -> DataFrame:
    """A row per conversation (kind 0), its audit (kind 1) and its rows in order
    (kind 2), conversation by conversation."""
    share_code(rows.sparkSession)
    known = rows.select("conv").distinct()
    numbered = stage(_numbered(rows.where("turn is not null or role is not null or text is not null or copy is not null")))
    none = {c: F.lit(None).cast(t) for c, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("fault", "string"), ("place", "int"),
        ("cost", "long"), ("audit", "string"))}
    parts = []
    for kind, part in enumerate((known, audits(numbered, piece), numbered.drop("sign"))):
        lacking = {c: v for c, v in none.items() if c not in part.columns}
        parts.append(part.withColumns(lacking).withColumn("kind", F.lit(kind)))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.repartition("conv").sortWithinPartitions("conv", "kind", "place")


def _run(rows: DataFrame, piece: int, hold: bool) -> DataFrame:
    fields = _ROWS if hold else _RESULT
    names = [f.split(" ")[0] for f in fields]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in fields]
    schema = StructType([
        StructField("conv", rows.schema["conv"].dataType), *StructType.fromDDL(", ".join(fields))])
    return _sorted(rows, piece).mapInArrow(_apply(hold, types, names), schema)


def turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as the repair takes them. Null roles and texts are one space."""
    return conversations.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        F.lit(0).alias("copy"),
    )


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Faults and the cheapest repair of every conversation: ``(conv, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    ``rows`` are those of ``turns``; a row that is null but for ``conv`` stands for a
    conversation without rows, whose result is zeros, an empty audit and the
    hash of nothing. The rows of the null conversation are one conversation.
    Turns ascend, null first; rows of one turn follow each other by role and
    text, so the order of the input does not matter, and repeated rows are
    duplicates. An empty table gives an empty result; only the columns above
    are used.

    A conversation may be as long as most of all rows: its signature is solved
    piece by piece, and its rows pass one task in order, as the hash of their
    text can be made in no other way, but are not held there. Its audit, a sign per
    edit, is one value of the result. A single text is held whole.
    """
    return _run(rows, piece, False)


def repaired(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The rows of the repaired conversations: ``(conv, place, turn, role, text,
    edit)``, edit being keep, rerole or insert; inserted rows have no turn and an
    empty text. Conversations are treated as in ``repair``."""
    return _run(rows, piece, True)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``turns`` with faults, by a hash of conversation and turn: some are
    dropped (what is left names the conversation), emptied, cut short,
    repeated, or given to the user."""
    rows = turns(conversations, "conv_id", "turn", "role", "text")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv"), F.lit(":"), text("turn"))) % 20
    rows = rows.withColumn("fate", fate)
    fates = F.col("fate")
    gone = lambda c: F.when(fates != 0, c)
    cut = F.when(fates == 1, "").when(fates == 2, F.translate(F.col("text"), ".!?", "")).otherwise(F.col("text"))
    copies = F.when(fates == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv", gone(F.col("turn")).alias("turn"), gone(F.when(fates == 4, "user").otherwise(F.col("role"))).alias("role"),
        gone(cut).alias("text"), F.explode(copies).alias("copy"), "fate",
    ).withColumn("copy", gone(F.col("copy"))).drop("fate")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after the damage that the contract states."""
    return repair(damaged(read_table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = f"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fate
    FROM conversations),
kept AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM given WHERE fate <> 0),
placed AS (
    SELECT *, rtrim(text, {_WHITE}) AS body, substr(role, 1, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place
    FROM kept),
told AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
    FROM placed),
faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM told GROUP BY conv_id),
inserts(q, q2, cost, audit, lines) AS (VALUES
    (0, 0, 0, '', ''), (0, 2, 2, 'I', 'user:' || chr(10)), (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (1, 1, 0, '', ''), (1, 2, 2, 'I', 'user:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (2, 2, 0, '', ''), (2, 3, 2, 'I', 'assistant:' || chr(10)),
    (3, 3, 0, '', ''), (3, 2, 2, 'I', 'user:' || chr(10))),
edits(q2, q3, cost, edit, initial, role) AS (VALUES
    (0, 0, 3, 'D', NULL, NULL), (1, 1, 3, 'D', NULL, NULL), (2, 2, 3, 'D', NULL, NULL), (3, 3, 3, 'D', NULL, NULL),
    (0, 2, 2, 'R', NULL, 'user'), (1, 2, 2, 'R', NULL, 'user'), (2, 3, 2, 'R', NULL, 'assistant'), (3, 2, 2, 'R', NULL, 'user'),
    (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (2, 3, 0, 'K', 'a', NULL),
    (3, 2, 0, 'K', 'u', NULL)),
ways AS (
    SELECT conv_id, 0::BIGINT AS place, 0 AS q,
        struct_pack(cost := 0::BIGINT, audit := '', lines := '') AS best
    FROM faults
    UNION ALL
    SELECT w.conv_id, w.place + 1, e.q3, min(struct_pack(
        cost := (w.best.cost + i.cost + e.cost + CASE WHEN e.edit <> 'D' AND t.fault = 'truncated' THEN 1 ELSE 0 END)::BIGINT,
        audit := w.best.audit || i.audit || e.edit,
        lines := w.best.lines || i.lines || CASE WHEN e.edit = 'D' THEN ''
            ELSE coalesce(e.role, t.role) || ':' || t.text || chr(10) END))
    FROM ways w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place + 1
    JOIN inserts i ON i.q = w.q
    JOIN edits e ON e.q2 = i.q2 AND (e.edit = 'D' OR (t.fault NOT IN ('blank', 'duplicate')
        AND (e.edit = 'R' OR e.initial = t.initial)))
    GROUP BY w.conv_id, w.place, e.q3),
ends AS (
    SELECT w.conv_id, min(struct_pack(cost := w.best.cost + i.cost, audit := w.best.audit || i.audit,
        lines := w.best.lines || i.lines)) AS best
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.place
    JOIN inserts i ON i.q = w.q AND i.q2 IN (0, 3)
    GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
    coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost,
    coalesce(e.best.audit, '') AS audit,
    sha256(coalesce(left(e.best.lines, greatest(length(e.best.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
