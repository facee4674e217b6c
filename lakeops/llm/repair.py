"""Repair of damaged conversations by a generalised LR parse of their roles.

The roles of a sound conversation follow a grammar: an optional system turn, then pairs of a user and an assistant turn, or nothing at all.
Every row can be kept, deleted or given another role, and empty turns can be put in anywhere, each at a cost. All ways are
parsed side by side on a graph-structured stack: each node is an LR state over the node below it, edits that lead to equal stack tops
meet in one node, and that node keeps the least (cost, audit), the audit being the initials of the edits so far.

Rows are range-partitioned by conversation and order and numbered in place, so a conversation of any size lies over as many tasks as it
needs. A task parses its part of a conversation that began before it from every possible stack top; those tables, one per
task and conversation, are then chained along the conversation. Only flags of a row reach the parser, texts stay in Spark.

Defined cases: turns sort with nulls first; rows of one turn sort by role, then text (by their first 32 characters, then by hash), equal
ones are adjacent; null roles and texts count as empty unless the caller fills them; a null conversation id is a conversation; an
empty table gives empty results; other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import stored

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
HEAD_CHARS = 32
FLUSH_ROWS = 20_000

# The LR table of   Dialogue -> (nothing) | Pairs    Pairs -> Head u a | Pairs u a    Head -> (nothing) | s
SHIFT = {(0, "s"): 1, (2, "u"): 3, (3, "a"): 4, (5, "u"): 6, (6, "a"): 7}
REDUCE_BEFORE = {(0, "u"): (0, "Head"), (1, "u"): (1, "Head")}
REDUCE = {4: (3, "Pairs"), 7: (3, "Pairs")}
GOTO = {(0, "Head"): 2, (0, "Pairs"): 5}
ACCEPTING = (0, 5)
Stack = tuple  # (state, the node below or None)


def _reduced(stack: Stack, rule: tuple[int, str]) -> Stack:
    size, name = rule
    for _ in range(size):
        stack = stack[1]
    return GOTO[stack[0], name], stack


def push(stack: Stack, symbol: str) -> Stack | None:
    """The stack after one more role, or nothing if the grammar does not allow it."""
    if rule := REDUCE_BEFORE.get((stack[0], symbol)):
        stack = _reduced(stack, rule)
    if (to := SHIFT.get((stack[0], symbol))) is None:
        return None
    stack = (to, stack)
    return _reduced(stack, REDUCE[to]) if to in REDUCE else stack


def _tops() -> list[Stack]:
    """The stacks between two roles. Each top of this grammar stands over one stack only, so nodes merge by their top."""
    found = [(0, None)]
    for stack in found:
        found += [s for x in "sua" if (s := push(stack, x)) and s[0] not in {f[0] for f in found}]
    return found


STACKS = _tops()
TOP = {stack[0]: i for i, stack in enumerate(STACKS)}
KINDS = [(role, fault) for role in ("s", "u", "a", "x") for fault in ("sound", "lost", "truncated")]


def _inserted(top: int) -> list[tuple[int, str]]:
    """Tops after up to two inserted turns, and their roles; more only come back to where fewer lead."""
    out, level = [(top, "")], [(top, "")]
    for _ in range(2):
        level = [(TOP[s[0]], roles + x) for t, roles in level for x in "ua" if (s := push(STACKS[t], x))]
        out += level
    return out


def _moves(kind: tuple[str, str]) -> list[list[tuple[int, int, str, str]]]:
    """From each top: the tops after this row, with cost, edits and roles made (``=`` kept, ``-`` deleted), the least per top."""
    role, fault = kind
    out = []
    for top in range(len(STACKS)):
        best: dict[int, tuple[int, str, str]] = {}
        for at, put in _inserted(top):
            ways = [(at, DELETE, "D", "-")]
            if fault != "lost":
                dear = TRUNCATED if fault == "truncated" else 0
                taken = [(role, 0, "K", "="), ("u", REROLE, "R", "u"), ("a", REROLE, "R", "a")]
                ways += [(TOP[s[0]], cost + dear, edit, made) for x, cost, edit, made in taken if (s := push(STACKS[at], x))]
            for to, cost, edit, made in ways:
                way = (cost + INSERT * len(put), "I" * len(put) + edit, put + made)
                best[to] = min(best.get(to, way), way)
        out.append([(to, *way) for to, way in best.items()])
    return out


MOVES = [_moves(k) for k in KINDS]
# The least way from each top to an accepted end.
ENDS = [min((INSERT * len(put), "I" * len(put), put) for to, put in _inserted(top) if STACKS[to][0] in ACCEPTING) for top in range(len(STACKS))]
Front = tuple[tuple[int, int, int], ...]  # (top, cost above the least, rank of its audit) of each node


@lru_cache(maxsize=200_000)
def step(kind: int, front: Front) -> tuple[int, Front, tuple]:
    """One row: the cost all nodes share, the next nodes, and for each the node before with the edits.

    Audits of nodes between rows all end in a row's edit, so none begins another, and equal costs are told apart by the rank of the audit
    before, then the edits.
    """
    best: dict[int, tuple[int, int, str, int, str]] = {}
    for top, cost, rank in front:
        for to, more, edits, made in MOVES[kind][top]:
            way = (cost + more, rank, edits, top, made)
            if to not in best or way < best[to]:
                best[to] = way
    least = min(w[0] for w in best.values())
    ranks = {to: i for i, (to, _) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3]))}
    after = tuple(sorted((to, w[0] - least, ranks[to]) for to, w in best.items()))
    return least, after, tuple((to, w[3], w[2], w[4]) for to, w in sorted(best.items()))


Part = dict[tuple[int, int], tuple[int, str, str]]  # (top before, top after): cost, audit, roles made


def parse(kinds: bytes | bytearray, entries: list[int]) -> Part:
    """A run of rows from each given top to every top it can lead to."""
    out: Part = {}
    for entry in entries:
        front, total, links = ((entry, 0, 0),), 0, []
        for kind in kinds:
            more, front, back = step(kind, front)
            total += more
            links.append(back)
        for top, cost, _ in front:
            edits, made, at = [], [], top
            for back in reversed(links):
                _, at, edit, roles = next(b for b in back if b[0] == at)
                edits.append(edit)
                made.append(roles)
            out[entry, top] = (total + cost, "".join(reversed(edits)), "".join(reversed(made)))
    return out


def chain(parts: list[Part]) -> tuple[int, list[tuple[str, str]]]:
    """The least (cost, audit) through all parts of a conversation, as the audit and the roles made of each."""
    front: dict[int, tuple[int, int]] = {0: (0, 0)}
    links: list[dict[int, tuple[int, str, str]]] = []
    for part in parts:
        best: dict[int, tuple[int, int, str, int, str]] = {}
        for (top, to), (cost, audit, made) in part.items():
            if top in front:
                way = (front[top][0] + cost, front[top][1], audit, top, made)
                if to not in best or way < best[to]:
                    best[to] = way
        ranks = {to: i for i, (to, _) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3]))}
        front = {to: (w[0], ranks[to]) for to, w in best.items()}
        links.append({to: (w[3], w[2], w[4]) for to, w in best.items()})
    cost, _, edits, made, top = min((c + ENDS[t][0], rank, *ENDS[t][1:], t) for t, (c, rank) in front.items())
    pieces = []
    for back in reversed(links):
        top, audit, roles = back[top]
        pieces.append((audit, roles))
    pieces.reverse()
    if pieces:
        pieces[-1] = (pieces[-1][0] + edits, pieces[-1][1] + made)
    return cost, pieces


def placed(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows in order, each with its ``place``: ascending over the whole table, consecutive within a partition. Stored."""
    named = rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumns({"_role": F.substring("role", 1, HEAD_CHARS), "_text": F.substring("text", 1, HEAD_CHARS), "_hash": F.xxhash64("role", "text"), "_from": F.spark_partition_id()})
    # Equal rows are told apart by the partition they come from: they too can lie in several.
    order = ["conv_id", "turn", "_role", "_text", "_hash"]
    dealt = named.repartitionByRange(*order, "_from").sortWithinPartitions(*order, "role", "text", "_from")
    return stored(dealt.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place")), "placed")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, place, role initial, fault) of placed rows; the first fault that holds of blank, duplicate and truncated. Stored."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = rows.groupBy("conv_id", same.alias("same")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    solid = r"[^\x20\x09-\x0D]"
    marked = rows.select(
        "conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(solid)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated").otherwise("")
    return stored(marked.join(first, "place", "left").select("conv_id", "turn", "place", "initial", fault.alias("fault")), "faults")


_PART = "conv_id bigint, first bigint, rows bigint, illegal bigint, head string, tail string, ways array<struct<top: int, to: int, cost: bigint, audit: string, made: string>>, done boolean"
_PART_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("first", pa.int64()), ("rows", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
    ("ways", pa.list_(pa.struct([("top", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("made", pa.string())]))), ("done", pa.bool_()),
])
_FAULT = {"": "sound", "blank": "lost", "duplicate": "lost", "truncated": "truncated"}
_LEGAL = {"su", "ua", "au"}


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation of a partition the ways through its rows, in runs of consecutive places. Holds a byte a row and what a parse of one run links."""
    codes = {k: i for i, k in enumerate(KINDS)}
    out: list[tuple] = []
    conv, kinds, start, before, initials, pairs, opens = None, bytearray(), 0, 0, ["", ""], 0, True

    def close(last: bool) -> None:
        # The first run of a partition can continue a conversation, the last can go on in the next; both also hold where places jump.
        ways = parse(kinds, list(range(len(STACKS))) if opens else [0])
        if not (opens or last):
            cost, [(audit, made)] = chain([ways])
            ways = {(0, 0): (cost, audit, made)}
        listed = [dict(zip(("top", "to", "cost", "audit", "made"), (*k, *v), strict=True)) for k, v in ways.items()]
        out.append((conv, start, len(kinds), pairs, *initials, listed, not (opens or last)))

    def flush() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PART_SCHEMA, strict=True)], schema=_PART_SCHEMA)
        out.clear()
        return made

    for batch in batches:
        for now, place, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "initial", "fault")), strict=True):
            # Places of a conversation jump where a stored partition of rows ended: these partitions have other bounds.
            if kinds and (now != conv or place != before + 1):
                close(now == conv)
                kinds, pairs, opens = bytearray(), 0, now == conv
                if len(out) >= FLUSH_ROWS:
                    yield flush()
            if kinds:
                pairs += initials[1] + initial not in _LEGAL
            else:
                conv, start, initials = now, place, [initial, initial]
            before, initials[1] = place, initial
            kinds.append(codes[initial if initial in ("s", "u", "a") else "x", _FAULT[fault]])
    if kinds:
        close(True)
    if out:
        yield flush()


_PIECE = "conv_id bigint, first bigint, cost bigint, illegal bigint, audit string, made string"
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("first", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()), ("made", pa.string())])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of conversations that touch an edge of a run, sorted by conversation and place, each with its piece of the repair."""

    def finish(rows: list[dict]) -> pa.RecordBatch:
        cost, pieces = chain([{(w["top"], w["to"]): (w["cost"], w["audit"], w["made"]) for w in r["ways"]} for r in rows])
        crossed = [0, *[a["tail"] + b["head"] not in _LEGAL for a, b in zip(rows, rows[1:], strict=False)]]
        made = [(r["conv_id"], r["first"], 0 if i else cost, r["illegal"] + crossed[i], *p) for i, (r, p) in enumerate(zip(rows, pieces, strict=True))]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), _PIECE_SCHEMA, strict=True)], schema=_PIECE_SCHEMA)

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != held[0]["conv_id"]:
                yield finish(held)
                held = []
            held.append(row)
    if held:
        yield finish(held)


def pieces(found: DataFrame) -> DataFrame:
    """The repair of each conversation, in one row per run of places and partition it lies in: edits from ``first`` on, roles made. Stored.

    The first row of a conversation has its cost.
    """
    dealt = found.repartitionByRange("place").sortWithinPartitions("place")
    parts = stored(dealt.select("conv_id", "place", "initial", "fault").mapInArrow(_parts, _PART), "parts")
    whole = parts.where("done").select("conv_id", "first", F.col("ways")[0]["cost"].alias("cost"), "illegal", F.col("ways")[0]["audit"].alias("audit"), F.col("ways")[0]["made"].alias("made"))
    # Few runs touch the edges of a partition or of a stored partition of rows.
    edge = parts.where("NOT done").repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(_chained, _PIECE)
    return stored(whole.unionByName(edge), "pieces")


_EDIT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("made", pa.string())])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for conv, place, audit, made in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first", "audit", "made")), strict=True):
            put = 0
            for edit, role in zip(audit, made, strict=True):
                out.append((conv, place, put, edit, role))
                place, put = (place, put + 1) if edit == "I" else (place + 1, 0)
                if len(out) >= FLUSH_ROWS:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _EDIT_SCHEMA, strict=True)], schema=_EDIT_SCHEMA)
                    out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _EDIT_SCHEMA, strict=True)], schema=_EDIT_SCHEMA)


def repaired(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place and put (their order), edit, role, text."""
    edits = chosen.select("conv_id", "first", "audit", "made").mapInArrow(_edits, "conv_id bigint, place bigint, put bigint, edit string, made string")
    named = F.when(F.col("made") == "u", "user").when(F.col("made") == "a", "assistant")
    stay = edits.where("edit IN ('K', 'R')").join(rows.select("place", "role", "text"), "place")
    stay = stay.select("conv_id", "place", "put", "edit", F.coalesce(named, "role").alias("role"), "text")
    return stay.unionByName(edits.where("edit = 'I'").select("conv_id", "place", "put", "edit", named.alias("role"), F.lit("").alias("text")))


def summary(found: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per conversation: gaps in its turns, rows by fault, illegal neighbours, cost and audit of the repair."""
    n = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = found.groupBy("conv_id").agg(F.coalesce(n, F.lit(0)).alias("gaps"), *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    audits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda p: p["audit"]), "")
    whole = chosen.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audits.alias("audit"))
    return counts.join(whole.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, out = None, None, []
    schema = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if digest is None or now != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = now, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if len(out) >= FLUSH_ROWS:
            yield flush()
            out = []
    if digest is not None:
        out.append((conv, digest.hexdigest()))
    if out:
        yield flush()


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation. It is taken turn after turn, so one task streams a conversation and holds none."""
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place", "put")
    return dealt.select("conv_id", "role", "text").mapInArrow(_hashes, "conv_id bigint, sha256 string")


def repair(rows: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(one row per conversation, the repaired turns). Both are read from stored tables."""
    in_order = placed(rows, **columns)
    found = faults(in_order)
    chosen = pieces(found)
    return summary(found, chosen), repaired(in_order, chosen)


def null_as_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))
