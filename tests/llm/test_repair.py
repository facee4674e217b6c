import hashlib
import re
from itertools import product
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.llm import repair
from lakeops.llm.queries import QUERIES, damaged

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, first int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def flags(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """Least (cost, audit) and the repaired turns over the four states of the grammar as an automaton, with audits as whole strings."""
    front = {"": (0, "", ())}

    def put(front):
        for _ in range(3):
            for state, (cost, audit, turns) in list(front.items()):
                for role in ("user", "assistant"):
                    to = NEXT.get((state, role[0]))
                    way = (cost + 5, audit + "I", (*turns, (role, "")))
                    if to is not None and (to not in front or way[:2] < front[to][:2]):
                        front[to] = way
        return front

    for (role, text), fault in zip(rows, flags(rows), strict=True):
        after = {}
        for state, (cost, audit, turns) in put(front).items():
            ways = [(state, 2, "D", turns)]
            if fault not in ("blank", "duplicate"):
                dear = 5 if fault == "truncated" else 0
                for to_role, more, edit in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if (to := NEXT.get((state, to_role[:1]))) is not None:
                        ways.append((to, more + dear, edit, (*turns, (to_role, text))))
            for to, more, edit, made in ways:
                way = (cost + more, audit + edit, made)
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        front = after
    return min((x for s, x in put(front).items() if s in ("", "a")), key=lambda x: x[:2])


def exhaustive(rows):
    """Every sequence of edits with at most three inserted turns."""
    best = None
    for per_row in product(*[[("D", None), ("K", None), ("R", "user"), ("R", "assistant")]] * len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for (e, _), f in zip(per_row, flags(rows), strict=True)):
            continue
        for gaps in product(*[[(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]] * (len(rows) + 1)):
            cost, audit, turns = 0, "", []
            for i, put in enumerate(gaps):
                cost, audit, turns = cost + 5 * len(put), audit + "I" * len(put), turns + [(r, "") for r in put]
                if i < len(rows):
                    edit, role = per_row[i]
                    audit += edit
                    cost += {"D": 2, "K": 0, "R": 1}[edit] + (5 if edit != "D" and flags(rows)[i] == "truncated" else 0)
                    turns += [] if edit == "D" else [(role or rows[i][0], rows[i][1])]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, tuple(turns))
    return best


def expected(rows):
    """From the rows after damage: per conversation the columns of the contract."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r[1:])
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        said, numbers = [t[1:] for t in turns], [t[0] for t in turns if t[0] is not None]
        cost, audit, made = cheapest(said)
        found = flags(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)
    return out


def broken(rows):
    """The stated damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        conv_turn = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, how = " " if role is None else role, " " if text is None else text, crc32(conv_turn.encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def got(spark, rows):
    made, turns = repair.repair(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA))
    sha = {r.conv_id: r.sha256 for r in repair.digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r.conv_id: (*(r[n] for n in names), sha.get(r.conv_id, empty)) for r in made.collect()}


ROW = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b.", "c", " ", "d! "]))


@settings(max_examples=60, derandomize=True, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_definition_is_the_least(rows):
    assert cheapest(rows) == exhaustive(rows)


@settings(max_examples=400, derandomize=True, deadline=None)
@given(st.lists(ROW, max_size=12), st.lists(st.integers(0, 12), max_size=3))
def test_parse_in_parts(rows, cuts):
    """The parse equals the definition however the conversation is cut."""
    kinds = bytes(repair.KINDS.index((r[:1] if r[:1] in ("s", "u", "a") else "x", repair._FAULT[f])) for (r, _), f in zip(rows, flags(rows), strict=True))
    edges = sorted({0, len(rows), *[c for c in cuts if c < len(rows)]})
    parts = [repair.parse(kinds[a:b], range(len(repair.STACKS))) for a, b in zip(edges, edges[1:], strict=False)]
    cost, made = repair.chain(parts)
    want = cheapest(rows)
    audit, roles = ("".join(x) for x in zip(*made, strict=True)) if made else ("", "")
    assert (cost, audit) == want[:2]
    assert [r for r in roles if r not in "=-"] == [t[0][0] for t, e in zip(want[2], audit.replace("D", ""), strict=True) if e != "K"]


def test_op12_by_definition(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(broken(rows))
    for conv in {r[0] for r in rows} - set(want):
        want[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = {r.conv_id: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, small).collect()}
    assert found == want


@pytest.mark.parametrize("shuffles", ["1", "7"])
def test_edges(spark, shuffles):
    """Nulls, empty and long texts, ties, repeated rows, other roles, and a conversation over several tasks."""
    rows = [(1, 0, "user", "x" * 200_000 + "."), (1, 0, "assistant", "b."), (1, 0, "assistant", "b."), (1, 7, "", ""), (None, None, "user", "a."), (None, 1, "tool", "a."),
            (None, 1, "assistant", "n"), (2, None, "system", "s."), (2, None, "", "\t"), (3, 4, "u2", "k."), (3, 5, "aa", "k.")]
    rows += [(9, i, ("user", "assistant", "user", "tool")[i % 4 if i % 5 else 0], f"t{i % 311}{'.' if i % 7 else ''}") for i in range(900)]
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_damage_and_empty(spark):
    rows = [(c, t, r, x) for c in (None, *range(30)) for t, r, x in ((None, None, None), (1, "assistant", "a. b!"), (2, "system", None), (2, "user", "q?"))]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    assert sorted(map(repr, damaged(table).collect())) == sorted(map(repr, spark.createDataFrame(broken(rows), "conv_id bigint, turn bigint, role string, text string").collect()))
    assert got(spark, broken(rows)) == expected(broken(rows))
    assert got(spark, []) == {}


@pytest.mark.parametrize("then", ["1", "3"])
def test_parse_bounds_differ_from_the_order(spark, then):
    """Rows are stored in seven partitions and parsed in fewer, so places jump within a conversation and within a task."""
    rows = [(c, i, ("user", "assistant")[i % 2] if i % 9 else "tool", f"t{i % 83}{'.' if i % 5 else ''}") for c in (None, 1, 2) for i in range(150)]
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        in_order = repair.placed(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
        found = repair.faults(in_order)
        spark.conf.set("spark.sql.shuffle.partitions", then)
        chosen = repair.pieces(found)
        sha = {r.conv_id: r.sha256 for r in repair.digests(repair.repaired(in_order, chosen)).collect()}
        made = {r.conv_id: (*r[1:8], sha[r.conv_id]) for r in repair.summary(found, chosen).collect()}
        assert in_order.select((F.col("place") / 2**33).cast("int")).distinct().count() > int(then)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert made == expected(rows)
