"""Conversation structure repair: the cheapest edits that make a conversation's roles read
``(system? (user assistant)+)?``, told as an audit string of one letter per edit.

A dynamic program runs over a conversation's rows with four states (nothing yet, after
system, after user, after assistant).  Each state holds the least cost and the ASCII-least
audit among equally cheap ones.  Audits are persistent: a node is a parent and the edits
of one row, so the states share their prefixes; every node has its ancestors at distances
of powers of two and a rolling hash of its whole prefix.  Two equally cheap audits are
compared by searching the longest common prefix over those hashes; equal hashes are
verified on the edits themselves.

Rows are dealt by ranges of (conversation, turn), so one conversation may lie over many
tasks.  A task solves the conversations that lie within it.  What lies at the edge of a
task, or is longer than a block, is cut into blocks solved from each state that can come
before; a second pass chains the blocks of a conversation the same way (a node is then
the audit of a block), and a third hashes the repaired rows as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, stage, tidied

START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = ("su", "ua", "au")
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def _after_insert(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _after_keep(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=256)
def row_edits(initial: str, must_go: bool, truncated: bool, costs: Costs) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) for one row: the cheapest, then ASCII-least
    edits of each pair of states.  Insertions come before the row's own edit; more than
    two of them lead nowhere that fewer don't."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        state = before
        for inserts in range(3):
            spent, done = inserts * costs.insert, "I" * inserts
            options = [(state, spent + costs.delete, done + "D")]
            if not must_go:
                kept = spent + (costs.truncated if truncated else 0)
                to = _after_keep(state, initial)
                if to is not None:
                    options.append((to, kept, done + "K"))
                options.append((_after_insert(state), kept + costs.rerole, done + "R"))
            for to, cost, edits in options:
                if (before, to) not in best or (cost, edits) < best[before, to]:
                    best[before, to] = (cost, edits)
            state = _after_insert(state)
    return [(before, to, cost, edits) for (before, to), (cost, edits) in best.items()]


def endings(state: int, costs: Costs) -> list[tuple[int, str]]:
    """(cost, insertions) with which a conversation in this state may end."""
    out = []
    for inserts in range(3):
        if state in (START, ASSISTANT):
            out.append((inserts * costs.insert, "I" * inserts))
        state = _after_insert(state)
    return out


class Trails:
    """Audits that share prefixes.  Node 0 is the empty audit; nodes compared with each
    other have as many pieces."""

    def __init__(self) -> None:
        self._up: list[list[int]] = [[]]     # ancestors 1, 2, 4, ... pieces back
        self._piece = [""]
        self._hash = [0]
        self._same: set[tuple[int, int]] = set()

    def add(self, parent: int, piece: str) -> int:
        node, up = len(self._piece), [parent]
        while len(self._up[up[-1]]) >= len(up):
            up.append(self._up[up[-1]][len(up) - 1])
        h = self._hash[parent]
        for c in piece:
            h = (h * _BASE + ord(c)) % _MODULUS
        self._up.append(up)
        self._piece.append(piece)
        self._hash.append(h)
        return node

    def text(self, node: int) -> list[str]:
        """The node's pieces, first to last."""
        out = []
        while node:
            out.append(self._piece[node])
            node = self._up[node][0]
        return out[::-1]

    def _equal(self, a: int, b: int) -> bool:
        """Whether two audits are really the same: piece by piece back to a shared node."""
        path = []
        while a != b and (a, b) not in self._same:
            if not a or not b or self._piece[a] != self._piece[b]:
                return False
            path.append((a, b))
            a, b = self._up[a][0], self._up[b][0]
        self._same.update(path)
        return True

    def less(self, a: int, b: int) -> bool | None:
        """Whether audit ``a`` comes before audit ``b`` (None: they are equal)."""
        if a == b:
            return None
        x, y, whole = a, b, self._hash
        if whole[x] == whole[y]:
            return None if self._equal(x, y) else "".join(self.text(a)) < "".join(self.text(b))
        for k in range(len(self._up[x]) - 1, -1, -1):
            if k < len(self._up[x]) and k < len(self._up[y]):
                u, v = self._up[x][k], self._up[y][k]
                if whole[u] != whole[v]:
                    x, y = u, v
        if not self._equal(self._up[x][0], self._up[y][0]):     # a collision on the way
            return "".join(self.text(a)) < "".join(self.text(b))
        return self._piece[x] < self._piece[y]


def step(trails: Trails, heads: dict[int, tuple[int, int]], moves: list[tuple[int, int, int, str]]) -> dict:
    """State -> (cost, node) after one more row or block; ``moves`` as ``row_edits``."""
    best: dict[int, tuple[int, int, str]] = {}
    for before, to, cost, piece in moves:
        if before not in heads:
            continue
        total, node = heads[before][0] + cost, heads[before][1]
        if to in best:
            had, at, other = best[to]
            if total > had:
                continue
            if total == had:
                less = trails.less(node, at)
                if not (piece < other if less is None else less):
                    continue
        best[to] = (total, node, piece)
    return {to: (total, trails.add(node, piece)) for to, (total, node, piece) in best.items()}


def finish(trails: Trails, heads: dict[int, tuple[int, int]], costs: Costs) -> tuple[int, list[str], str]:
    """(cost, pieces, closing insertions) of the best complete audit."""
    ends = [(total + cost, node, tail) for state, (total, node) in heads.items() for cost, tail in endings(state, costs)]
    best = ends[0]
    for end in ends[1:]:
        if end[0] < best[0] or (end[0] == best[0] and (trails.less(end[1], best[1]) or (
                end[1] == best[1] and end[2] < best[2]))):
            best = end
    return best[0], trails.text(best[1]), best[2]


def repaired_rows(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) rows that an audit leaves of ``rows``, and the state after it."""
    out, at = [], 0
    for edit in audit:
        if edit == "I":
            state = _after_insert(state)
            out.append(("assistant" if state == ASSISTANT else "user", ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "D":
            continue
        state = _after_insert(state) if edit == "R" else _after_keep(state, role[:1])
        out.append((("assistant" if state == ASSISTANT else "user") if edit == "R" else role, text))
    return out, state


class _Hash:
    """SHA-256 of ``role:text`` rows joined by line feeds, as they come."""

    def __init__(self) -> None:
        self._sha, self._any = hashlib.sha256(), False

    def add(self, rows: list[tuple[str, str]]) -> None:
        for role, text in rows:
            self._sha.update(f"{chr(10) if self._any else ''}{role}:{text}".encode())
            self._any = True

    def value(self) -> str:
        return self._sha.hexdigest()


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_PATH = T.StructType([T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
                      T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
_FACTS = T.StructType([T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
                       T.StructField("low", T.LongType()), T.StructField("high", T.LongType()),
                       T.StructField("turns", T.LongType())]
                      + [T.StructField(c, T.LongType()) for c in _COUNTS])
_ANSWER = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("gaps", T.LongType())]
                       + [T.StructField(c, T.LongType()) for c in _COUNTS]
                       + [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                          T.StructField("repaired_sha256", T.StringType())])
_SOLVED = T.StructType(list(_ANSWER.fields) + [
    T.StructField("turn", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("uid", T.LongType()),
    T.StructField("facts", _FACTS), T.StructField("paths", T.ArrayType(_PATH)),
    T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])


class _Block:
    """Rows of one conversation in order, as far as they have come."""

    def __init__(self, key: tuple, whole: bool, entries: tuple[int, ...], costs: Costs) -> None:
        self.key, self.whole, self.costs = key, whole, costs    # key: conv_id, turn, digest, uid of the first row
        self.trails = Trails()
        self.heads = {s: {s: (0, 0)} for s in entries}
        self.rows: list[tuple[str, str]] = []
        self.bytes = 0
        self.facts = dict.fromkeys(["first", "last", "low", "high"]) | dict.fromkeys(["turns", *_COUNTS], 0)

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        f = self.facts
        if f["last"] is None:
            f["first"] = role[:1]
        elif f["last"] + role[:1] not in LEGAL:
            f["illegal"] += 1
        f["last"] = role[:1]
        if turn is not None:
            f["low"] = turn if f["low"] is None else f["low"]
            f["turns"] += f["high"] != turn
            f["high"] = turn
        if fault:
            f[fault] += 1
        edits = row_edits(role[:1], fault in ("blank", "duplicate"), fault == "truncated", self.costs)
        for entry, heads in self.heads.items():
            self.heads[entry] = step(self.trails, heads, edits)
        self.rows.append((role, text))
        self.bytes += len(role) + len(text)

    def full(self, most_rows: int) -> bool:
        return len(self.rows) >= most_rows or self.bytes >= BLOCK_BYTES

    def answer(self) -> dict:
        """The conversation's row, when this block is the whole of it."""
        cost, pieces, tail = finish(self.trails, self.heads[START], self.costs)
        audit, sha = "".join(pieces) + tail, _Hash()
        sha.add(repaired_rows(audit, self.rows)[0])
        return {"conv_id": self.key[0], "cost": cost, "audit": audit, "repaired_sha256": sha.value(),
                **_totals(self.facts)}

    def record(self) -> dict:
        """The block's row, to be chained."""
        paths = [{"entry": entry, "exit": to, "cost": cost, "audit": "".join(self.trails.text(node))}
                 for entry, heads in self.heads.items() for to, (cost, node) in heads.items()]
        return {**dict(zip(["conv_id", "turn", "digest", "uid"], self.key)), "facts": self.facts, "paths": paths,
                "roles": [r for r, _ in self.rows], "texts": [t for _, t in self.rows]}


def _totals(facts: dict) -> dict:
    gaps = 0 if facts["low"] is None else facts["high"] - facts["low"] + 1 - facts["turns"]
    return {"gaps": gaps, **{c: facts[c] for c in _COUNTS}}


def _joined(a: dict, b: dict) -> dict:
    """Facts of a block followed by another block of its conversation."""
    if b["last"] is None or a["last"] is None:
        return b if a["last"] is None else a
    out = {c: a[c] + b[c] for c in _COUNTS} | {"first": a["first"], "last": b["last"]}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    out["turns"] = a["turns"] + b["turns"] - (a["high"] is not None and a["high"] == b["low"])
    return out


def _rows_out(schema: T.StructType) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return lambda rows: pa.RecordBatch.from_pylist(rows, schema=arrow)


def _solve(costs: Costs, block_rows: int):
    """Rows of a range in order -> answers of the conversations inside it, blocks of the
    others.  A row of kind 0 says that the next one repeats an earlier row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, block, repeated = _rows_out(_SOLVED), None, False
        out, held = [], 0

        def close(b: _Block, ended: bool) -> None:
            nonlocal held
            out.append(b.answer() if ended and b.whole else b.record())
            held += 200 if ended and b.whole else 64 + 20 * len(b.rows) + b.bytes

        for part in (p for b in batches for p in slices(b, "text")):
            for kind, conv, turn, digest, uid, role, text, here, blank, cut in zip(*(c.to_pylist() for c in part.columns)):
                if kind == 0:
                    repeated = True
                    continue
                if block is None:
                    block = _Block((conv, turn, digest, uid), False, (START, SYSTEM, USER, ASSISTANT), costs)
                elif block.key[0] != conv:
                    close(block, True)
                    block = _Block((conv, turn, digest, uid), True, (START,), costs)
                elif block.full(block_rows):
                    close(block, False)
                    block = _Block((conv, turn, digest, uid), False, (START, SYSTEM, USER, ASSISTANT), costs)
                if here:
                    block.add(turn, role, text, "blank" if blank else "duplicate" if repeated else
                              "truncated" if cut else None)
                repeated = False
                if held >= 1 << 20 or len(out) >= 2000:
                    yield pack(out)
                    out, held = [], 0
        if block is not None:
            close(block, False)
        if out:
            yield pack(out)

    return tidied(run)


_CHAINED = T.StructType([T.StructField("uid", T.LongType()), T.StructField("entry", T.IntegerType()),
                         T.StructField("letters", T.StringType()), T.StructField("tail", T.StringType()),
                         T.StructField("totals", T.StructType(list(_ANSWER.fields)[1:7]))])


def _chain(costs: Costs):
    """Blocks in order, conversation by conversation -> each block's part of the audit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, conv, open_ = _rows_out(_CHAINED), None, False
        trails, heads, facts, uids, moves = Trails(), {}, {}, [], []

        def close() -> list[dict]:
            cost, pieces, tail = finish(trails, heads, costs)
            out, state = [], START
            for uid, piece, paths in zip(uids, pieces, moves):
                entry, state = state, next(to for e, to, _, text in paths if e == state and text == piece)
                out.append({"uid": uid, "entry": entry, "letters": piece, "tail": None, "totals": None})
            out[-1] |= {"tail": tail, "totals": {**_totals(facts), "cost": cost}}
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if not open_ or row["conv_id"] != conv:
                    if open_:
                        yield pack(close())
                    conv, open_, facts = row["conv_id"], True, row["facts"]
                    trails, heads, uids, moves = Trails(), {START: (0, 0)}, [], []
                else:
                    facts = _joined(facts, row["facts"])
                paths = [(p["entry"], p["exit"], p["cost"], p["audit"]) for p in row["paths"]]
                heads = step(trails, heads, paths)
                uids.append(row["uid"])
                moves.append(paths)
        if open_:
            yield pack(close())

    return tidied(run)


def _hash_chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order with their letters -> answers, hashing the rows as they pass."""
    pack, sha, audit = _rows_out(_ANSWER), _Hash(), []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            rows, state = repaired_rows(row["letters"], list(zip(row["roles"], row["texts"])), row["entry"])
            sha.add(rows)
            audit.append(row["letters"])
            if row["totals"] is not None:       # the conversation's last block
                sha.add(repaired_rows(row["tail"], [], state)[0])
                audit.append(row["tail"])
                yield pack([{"conv_id": row["conv_id"], "audit": "".join(audit), "repaired_sha256": sha.value(),
                             **row["totals"]}])
                sha, audit = _Hash(), []


def repair_conversations(spark: SparkSession, rows: DataFrame, costs: Costs = Costs(),
                         absent: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (conv_id, turn, role, text; others are ignored):
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows go by turn, NULL turns first; rows of one turn by a digest of role and text, so
    repeated rows lie side by side.  NULL roles and texts count as one space, a NULL
    ``conv_id`` is a conversation of its own.  ``absent`` rows name their conversation only;
    one without other rows has zeros, an empty audit and the empty string's hash.  A row's
    first fault counts: blank, duplicate (an earlier row has its role and text), truncated
    (its last visible character is none of ``.!?``).  An empty role has no initial, so such
    a row can't be kept as it is.  Edits: K keep, R new role, D delete, I insert; their costs
    are ``costs``, which must be positive for insertions.  A block has at most
    ``block_rows`` rows; the result doesn't depend on it.
    """
    ship_package(spark)
    space = F.lit(" ")
    base = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), space).alias("role"),
                       F.coalesce(F.col("text").cast("string"), space).alias("text"),
                       F.coalesce(~absent if absent is not None else F.lit(True), F.lit(True)).alias("here"))
    held = stage(spark, base.select(
        "conv_id", "turn",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("uid"), "role", F.when(F.col("here"), F.col("text")).otherwise("").alias("text"),
        "here", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut")), "op11-rows")
    # Repeats go by row number, never by text: no join has a hot key, and no text is moved.
    slim = held.where("here").select("conv_id", "digest", "turn", "uid")
    firsts = (slim.groupBy("conv_id", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("late"), "turn", "uid")).alias("f")).select("f.uid"))
    order = ["conv_id", "turn", "digest", "uid"]
    marks = slim.join(firsts, "uid", "left_anti").select(
        F.lit(0).alias("kind"), *order, F.lit("").alias("role"), F.lit("").alias("text"),
        *[F.lit(False).alias(c) for c in ("here", "blank", "cut")])
    stream = held.select(F.lit(1).alias("kind"), *order, "role", "text", "here", "blank", "cut").unionByName(marks)
    solved = stage(spark, stream.repartitionByRange(*order).sortWithinPartitions(*order, "kind")
                   .mapInArrow(_solve(costs, block_rows), _SOLVED), "op11-solved")
    done = solved.where("cost IS NOT NULL").select(*_ANSWER.names)
    blocks = solved.where("cost IS NULL")
    chained = stage(spark, blocks.select(*order, "facts", "paths").repartition("conv_id").sortWithinPartitions(*order)
                    .mapInArrow(_chain(costs), _CHAINED), "op11-chained")
    rest = (blocks.select(*order, "roles", "texts").join(chained, "uid")
            .repartition("conv_id").sortWithinPartitions(*order).mapInArrow(tidied(_hash_chained), _ANSWER))
    return done.unionByName(rest)
