"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is well formed when its roles read (system)? (user assistant)+ or it is empty. Its rows,
by turn, are repaired by the cheapest edits: Keep (0), Rerole to user or assistant (3), Delete (4,
required for blank and duplicate rows), Insert an empty user or assistant turn (3); a truncated
row that stays adds 3. Of equally cheap repairs the one whose audit (the edits' initials) is least in ASCII wins.

Search (``search``). A node is (row, state of the role grammar). An explicit stack of prefixes is
explored depth first, the most promising edit on top. ``suffix_bounds`` is the least cost any
completion can have; a prefix whose cost plus bound exceeds the incumbent's (cost, audit), or equals its
cost with an audit that is already larger, is cut. A table per node keeps the best (cost, audit)
prefix seen; worse ones are dominated, as equal nodes have equal completions. The search ends when the stack
is empty: the incumbent is optimal. (At one node prefixes of equal cost are never prefixes of
each other, because they differ in inserts and each costs 3; so comparing them decides.)

Any length. Rows are dealt by ranges of (conversation, turn, role, digest of the text), so a
conversation that holds a third of all rows is spread over tasks. A conversation of at
most ``PIECE`` rows that lies within a task is finished there. Others are cut into pieces of that size, each searched for
every entry and exit state; their best (cost, audit) are chained per conversation in a second step,
which sees no texts, and every piece then replays its own edits in parallel.

Duplicates (role and text seen earlier in the conversation) are known before: a grouped minimum finds
the first turn of each repeated text, and identical rows are counted into one before they are dealt.

Edge cases: null conv_id is a conversation of its own; a null turn comes first and is left out of the gaps; a null
role or text is one space, so the text is blank and the role must be changed or deleted; rows of
equal turn are ordered by role, then digest of role and text; texts of any length stay whole; a conversation
without rows has no result (``op12`` gives it cost 0 and an empty audit); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, broadcast_if_small, read_table, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after a role's initial; absent: not allowed.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that a rerole or insert makes in each state, and the state after it.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}
ACCEPTED = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
#: Rows of a piece, and rows of a task.
PIECE = 512
TASK_ROWS = 200_000


@dataclass
class Row:
    """A row of a conversation; ``copies`` identical rows, of which the first may be original."""

    initial: str
    forced: bool       # blank or duplicate: must go
    truncated: bool
    extra: int = 0     # further copies, duplicates of this one


def edits(row: Row, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, audit, next state) of the ways to treat a row in a state; copies are deleted."""
    gone = "D" * row.extra
    tail = DELETE * row.extra
    yield DELETE + tail, "D" + gone, state
    if not row.forced:
        late = TRUNCATED * row.truncated
        if (to := STEP.get((state, row.initial))) is not None:
            yield KEEP + late + tail, "K" + gone, to
        yield REROLE + late + tail, "R" + gone, NEXT[state][1]


INF = 1 << 60


def suffix_bounds(rows: list[Row], exits: list[int]) -> list[list[int]]:
    """bounds[i][state]: no completion from row i in that state costs less (audits left out). ``exits``: cost of ending in each state."""
    def with_inserts(after: list[int]) -> list[int]:
        """Up to two inserts before going on; a third would return to where the first led."""
        for _ in range(2):
            after = [min(after[s], INSERT + after[NEXT[s][1]]) for s in STATES]
        return after

    bounds = [with_inserts(exits)]
    for row in reversed(rows):
        bounds.append(with_inserts([min(cost + bounds[-1][to] for cost, _, to in edits(row, s)) for s in STATES]))
    return bounds[::-1]


@dataclass
class Search:
    """What a search found, and how much it looked at."""

    cost: int
    audit: str
    expanded: int = 0
    dominated: int = 0
    bounded: int = 0


def search(rows: list[Row], start: int, ends: tuple[int, ...]) -> Search | None:
    """The cheapest edits (least audit among equals) from state ``start`` to one of ``ends``; None if there are none."""
    n = len(rows)
    bounds = suffix_bounds(rows, [0 if s in ends else INF for s in STATES])
    if bounds[0][start] >= INF:
        return None
    best = Search(INF, "")
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[at][state]
        if least > best.cost or least == best.cost and audit > best.audit[:len(audit)]:
            best.bounded += 1
            continue
        known = seen.get((at, state))
        if known is not None and known <= (cost, audit):
            best.dominated += 1
            continue
        seen[at, state] = (cost, audit)
        best.expanded += 1
        if at == n and state in ends and (cost, audit) < (best.cost, best.audit):
            best.cost, best.audit = cost, audit
        more = [(INSERT, "I", NEXT[state][1], at)]
        if at < n:
            more += [(c, letters, to, at + 1) for c, letters, to in edits(rows[at], state)]
        # the last pushed is explored first: least bound, then least letter
        more = sorted(((cost + c + bounds[to_row][to], letters, c, to, to_row) for c, letters, to, to_row in more), reverse=True)
        for total, letters, c, to, to_row in more:
            if total < INF:
                stack.append((to_row, to, cost + c, audit + letters))
    return best if best.cost < INF else None


# ---------------------------------------------------------------- rows in Spark

def with_nulls(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a space for a null role or text."""
    return rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def counted(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, code, later, copies): identical rows as one, ``later`` if the
    conversation has the same role and text at an earlier turn.

    Only texts that a conversation repeats are grouped; texts that occur once stay where they are."""
    rows = rows.withColumn("code", F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256)))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeated = rows.groupBy("conv_id", "code").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("first")).filter("n > 1")
    repeated = store(repeated.select(F.col("conv_id").alias("conv"), F.col("code").alias("same"), "first"), "turns-repeated")
    r = repeated if repeated.isEmpty() else broadcast_if_small(repeated, 80)
    rows = rows.join(r, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("code") == F.col("same")), "left").drop("conv")
    once = rows.filter("same is null").select("conv_id", "turn", "role", "text", "code", F.lit(False).alias("later"), F.lit(1).cast("long").alias("copies"))
    many = rows.filter("same is not null").groupBy("conv_id", "turn", "role", "text", "code").agg(
        F.min("first").alias("first"), F.count(F.lit(1)).alias("copies"))
    return once.unionByName(many.select("conv_id", "turn", "role", "text", "code", (turn != F.col("first")).alias("later"), "copies"))


def ordered(rows: DataFrame, row_count: int) -> DataFrame:
    """Rows dealt to tasks by ranges of their order, sorted within."""
    tasks = max(1, -(-row_count // TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "code")]
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


# ---------------------------------------------------------------- pieces

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = "array<struct<role:string,text:string>>"
SUMMARY = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ",audit:string>"
PATHS = "array<struct<start:int,end:int,cost:bigint,audit:string>>"
PART = ("struct<first_turn:bigint,last_turn:bigint,turns:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,"
        f"first:string,last:string,paths:{PATHS},copies:array<bigint>,role:array<string>,text:array<string>>")


def schema_of(conv_id: T.DataType, columns: str) -> T.StructType:
    """conv_id, piece and the columns."""
    return T.StructType([T.StructField("conv_id", conv_id), T.StructField("piece", T.LongType()), *T.StructType.fromDDL(columns).fields])


def arrow_type(kind: T.DataType) -> pa.DataType:
    """The Arrow type of the kinds used here."""
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]


def emitted(rows: Iterator[dict], kind: T.StructType) -> Iterator[pa.RecordBatch]:
    """Batches of at most 1,000 rows and about 8 million characters of text."""
    out, held, size = pa.schema([(f.name, arrow_type(f.dataType)) for f in kind.fields]), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(t["text"]) for t in row.get("turns") or ()) + sum(map(len, (row.get("part") or {}).get("text", ())))
        if len(held) >= 1000 or size >= 8_000_000:
            yield pa.RecordBatch.from_pylist(held, out)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, out)


class Piece:
    """Rows of one conversation in order, and what is counted on them."""

    def __init__(self):
        self.rows: list[Row] = []
        self.part = {"first_turn": None, "last_turn": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                     "first": None, "last": None, "paths": [], "copies": [], "role": [], "text": []}

    def add(self, turn: int | None, role: str, text: str, later: bool, copies: int) -> None:
        p, initial, shown = self.part, role[:1], text.strip(BLANKS)
        blank, cut = not shown, bool(shown) and shown[-1] not in ".!?"
        p["blank"] += copies if blank else 0
        p["duplicate"] += 0 if blank else copies if later else copies - 1
        p["truncated"] += cut and not later
        p["illegal"] += copies - 1 + (p["last"] is not None and p["last"] + initial not in LEGAL)
        p["first"] = initial if p["first"] is None else p["first"]
        p["last"] = initial
        if turn is not None:
            p["first_turn"] = turn if p["first_turn"] is None else p["first_turn"]
            p["turns"] += turn != p["last_turn"]
            p["last_turn"] = turn
        forced = blank or later
        self.rows.append(Row(initial, forced, cut and not forced, copies - 1))
        p["copies"].append(copies)
        p["role"].append(role)
        p["text"].append("" if forced else text)  # a row that must go is never written

    def solve(self, starts: tuple[int, ...], goals: list[tuple[int, ...]]) -> dict:
        """The piece with its best path from each start to each goal."""
        found = [(s, goal[0], search(self.rows, s, goal)) for s in starts for goal in goals]
        self.part["paths"] = [{"start": s, "end": e, "cost": f.cost, "audit": f.audit} for s, e, f in found if f]
        return self.part


def replay(audit: str, part: dict, state: int) -> list[dict]:
    """The repaired turns of a piece that is entered in ``state``."""
    out, at, left = [], 0, 0
    for letter in audit:
        if letter == "I":
            role, state = NEXT[state]
            out.append({"role": role, "text": ""})
            continue
        if not left:  # the next row; its copies follow as deletions
            role, text, left = part["role"][at], part["text"][at], part["copies"][at]
            at += 1
            if letter == "K":
                out.append({"role": role, "text": text})
                state = STEP[state, role[:1]]
            elif letter == "R":
                role, state = NEXT[state]
                out.append({"role": role, "text": text})
        left -= 1
    return out


class Chain:
    """Pieces of a conversation joined in order: per state the best (cost, audit), and how each piece got there."""

    def __init__(self):
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}
        self.back: list[tuple[int, dict[int, dict]]] = []
        self.total = dict.fromkeys(["blank", "duplicate", "truncated", "illegal", "turns"], 0)
        self.first_turn = self.last_turn = self.last = None

    def add(self, piece: int, part: dict) -> None:
        reached: dict[int, tuple[int, str]] = {}
        via: dict[int, dict] = {}
        for path in part["paths"]:
            if path["start"] in self.best:
                cost, audit = self.best[path["start"]]
                new = (cost + path["cost"], audit + path["audit"])
                if path["end"] not in reached or new < reached[path["end"]]:
                    reached[path["end"]], via[path["end"]] = new, path
        self.best = reached
        self.back.append((piece, via))
        for c in self.total:
            self.total[c] += part[c]
        if part["first_turn"] is not None:
            self.total["turns"] -= part["first_turn"] == self.last_turn
            self.first_turn = part["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = part["last_turn"]
        self.total["illegal"] += self.last is not None and self.last + part["first"] not in LEGAL
        self.last = part["last"]

    def summary(self) -> dict:
        cost, audit = min(self.best[s] for s in ACCEPTED if s in self.best)
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.total["turns"]
        return {"gaps": gaps, **{c: self.total[c] for c in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}

    def paths(self) -> list[tuple[int, int, str]]:
        """(piece, state it is entered in, audit) of the best repair."""
        state, out = min((s for s in ACCEPTED if s in self.best), key=self.best.__getitem__), []
        for piece, via in reversed(self.back):
            out.append((piece, via[state]["start"], via[state]["audit"]))
            state = via[state]["start"]
        return out[::-1]


def _searched(kind: T.StructType, most: int) -> Callable:
    """Streams ordered rows: a finished row per conversation of one piece that lies within the task; a row
    per piece (at most ``most`` rows) of longer ones, and of the first and the last, which may go on in a neighbour."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext
        number, conv, piece, open_ = TaskContext.get().partitionId() << 32, None, None, True

        def closed(whole: bool) -> dict:
            if not whole:
                return {"conv_id": conv, "piece": number, "summary": None, "turns": None, "part": piece.solve(tuple(STATES), [(e,) for e in STATES])}
            chain, part = Chain(), piece.solve((START,), [ACCEPTED])
            chain.add(number, part)
            done = chain.summary()
            return {"conv_id": conv, "piece": number, "summary": done, "turns": replay(done["audit"], part, START), "part": None}

        for batch in batches:
            for c, turn, role, text, later, copies in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if piece is None:
                    conv, piece = c, Piece()  # the first one may have begun in the task before
                elif c != conv or len(piece.rows) >= most:
                    open_ = open_ or c == conv
                    yield closed(not open_)
                    number += 1
                    open_ = c == conv
                    conv, piece = c, Piece()
                piece.add(turn, role, text, later, copies)
        if piece is not None:
            yield closed(False)

    return lambda batches: emitted(rows(batches), kind)


def _chained(kind: T.StructType) -> Callable:
    """Streams the pieces of each conversation in order: a row per piece, the last with the summary."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, chain = None, None

        def closed() -> list[dict]:
            out = [{"conv_id": conv, "piece": p, "start": s, "audit": a, "summary": None} for p, s, a in chain.paths()]
            out[-1]["summary"] = chain.summary()
            return out

        for batch in batches:
            for c, piece, part in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if chain is not None and c != conv:
                    yield from closed()
                    chain = None
                if chain is None:
                    conv, chain = c, Chain()
                chain.add(piece, part)
        if chain is not None:
            yield from closed()

    return lambda batches: emitted(rows(batches), kind)


def _replayed(kind: T.StructType) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                yield {"conv_id": r["conv_id"], "piece": r["piece"], "turns": replay(r["audit"], r["part"], r["start"])}

    return lambda batches: emitted(rows(batches), kind)


# ---------------------------------------------------------------- operator

@dataclass
class Repaired:
    """``conversations`` (conv_id, the counts, cost, audit); ``turns`` (conv_id, piece, whole, turns): the repaired turns
    (role, text) in order, by piece; ``whole`` tells conversations of one piece."""

    conversations: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, piece: int = PIECE) -> Repaired:
    """Repairs all conversations of ``rows`` (conv_id, turn, role, text); ``piece`` bounds the rows held at once."""
    kind = rows.schema["conv_id"].dataType
    rows = with_nulls(rows)
    found = schema_of(kind, f"summary {SUMMARY}, turns {TURNS}, part {PART}")
    dealt = ordered(counted(rows), rows.count()).select("conv_id", "turn", "role", "text", "later", "copies")
    solved = store(dealt.mapInArrow(_searched(found, piece), found), "turns-searched")

    parts = solved.filter("part is not null").select("conv_id", "piece", "part")
    seen = parts.select("conv_id", "piece", F.col("part").dropFields("copies", "role", "text").alias("part"))
    seen = seen.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    kind_chain = schema_of(kind, f"start int, audit string, summary {SUMMARY}")
    chains = store(seen.mapInArrow(_chained(kind_chain), kind_chain), "turns-chained")
    kind_turns = schema_of(kind, f"turns {TURNS}")
    late = parts.join(chains.select("piece", "start", "audit"), "piece").select("conv_id", "piece", "start", "audit", "part")
    late = late.mapInArrow(_replayed(kind_turns), kind_turns)

    done = solved.filter("part is null")
    summaries = done.select("conv_id", "summary").unionByName(chains.filter("summary is not null").select("conv_id", "summary"))
    turns = done.select("conv_id", "piece", F.lit(True).alias("whole"), "turns").unionByName(
        late.select("conv_id", "piece", F.lit(False).alias("whole"), "turns"))
    return Repaired(summaries.select("conv_id", "summary.*"), turns)


def _hashed(kind: T.StructType) -> Callable:
    """Streams pieces in order; one SHA-256 per conversation, fed turn by turn."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, sha, begun = None, None, False
        for batch in batches:
            for c, piece, turns in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if sha is not None and c != conv:
                    yield {"conv_id": conv, "piece": None, "repaired_sha256": sha.hexdigest()}
                    sha = None
                if sha is None:
                    conv, sha, begun = c, hashlib.sha256(), False
                for t in turns:
                    sha.update(f"{chr(10) if begun else ''}{t['role']}:{t['text']}".encode())
                    begun = True
        if sha is not None:
            yield {"conv_id": conv, "piece": None, "repaired_sha256": sha.hexdigest()}

    return lambda batches: emitted(rows(batches), kind)


def repaired_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines joined by newlines."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = turns.filter("whole").select("conv_id", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    kind = schema_of(turns.schema["conv_id"].dataType, "repaired_sha256 string")
    long = turns.filter("not whole").select("conv_id", "piece", "turns").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(long.mapInArrow(_hashed(kind), kind).select("conv_id", "repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage: drops, empties, cuts, repeats and reroles rows by a checksum of ``conv_id:turn``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = with_nulls(rows).withColumn("kind", F.crc32(key.cast("binary")) % 20).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def op12(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    fixed = repair(damaged(rows))
    result = fixed.conversations.join(repaired_digests(fixed.turns).withColumnRenamed("conv_id", "same"), F.col("conv_id").eqNullSafe(F.col("same")))
    result = result.drop("same").withColumnRenamed("conv_id", "same")
    result = rows.select("conv_id").distinct().join(result, F.col("conv_id").eqNullSafe(F.col("same")), "left")
    return result.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, _k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS bytes
  FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 20 AS kind FROM keyed, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text)) AS i FROM hurt),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
         left(role, 1) AS r, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; at most two inserts are useful in one place
inserts(st, new, price, letters, added) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
         (0, 2, 3, 'I', E'\nuser:'), (1, 2, 3, 'I', E'\nuser:'), (3, 2, 3, 'I', E'\nuser:'), (2, 3, 3, 'I', E'\nassistant:'),
         (0, 3, 6, 'II', E'\nuser:\nassistant:'), (1, 3, 6, 'II', E'\nuser:\nassistant:'), (3, 3, 6, 'II', E'\nuser:\nassistant:')),
edits(st, new, letter) AS (
  VALUES (0, 0, 'D'), (1, 1, 'D'), (2, 2, 'D'), (3, 3, 'D'), (0, 2, 'R'), (1, 2, 'R'), (3, 2, 'R'), (2, 3, 'R'),
         (0, 1, 'Ks'), (0, 2, 'Ku'), (1, 2, 'Ku'), (3, 2, 'Ku'), (2, 3, 'Ka')),
found(conv_id, i, st, cost, audit, lines) AS (
  SELECT conv_id, 0::BIGINT, 0, 0::BIGINT, '', '' FROM counts
  UNION ALL
  SELECT conv_id, i, st, cost, audit, lines FROM (
    SELECT f.conv_id, j.i, e.new AS st, f.audit || n.letters || e.letter[1] AS audit,
           f.cost + n.price + CASE e.letter[1] WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN j.fault = 't' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
           f.lines || n.added || CASE e.letter[1] WHEN 'D' THEN ''
             WHEN 'R' THEN E'\n' || CASE e.new WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || j.text
             ELSE E'\n' || j.role || ':' || j.text END AS lines
    FROM found f JOIN judged j ON j.conv_id IS NOT DISTINCT FROM f.conv_id AND j.i = f.i + 1
    JOIN inserts n ON n.st = f.st
    JOIN edits e ON e.st = n.new AND (e.letter = 'D' OR j.fault NOT IN ('b', 'd') AND (e.letter = 'R' OR e.letter = 'K' || j.r)))
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, st ORDER BY cost, audit) = 1),
ended AS (
  SELECT f.conv_id, f.cost + n.price AS cost, f.audit || n.letters AS audit, f.lines || n.added AS lines
  FROM found f JOIN counts c ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.n = f.i JOIN inserts n ON n.st = f.st WHERE n.new IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY f.conv_id ORDER BY f.cost + n.price, f.audit || n.letters) = 1)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
       sha256(coalesce(substr(e.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
