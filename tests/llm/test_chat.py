import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import chat
from lakeops.llm.queries import QUERIES

PART = st.one_of(st.sampled_from([*chat.CONTROLS, "\\", "<", "|", "-", "n", "\n", "[", "im_start|>", "</", chat.PROBE]), st.text(max_size=3))
TEXT = st.lists(PART, max_size=6).map("".join)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted int, spans int"


@settings(max_examples=500, derandomize=True, deadline=None)
@given(turns=st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    formatted, spans, rewritten = chat.locate(turns, chat.marked_turns)
    assert chat.read_turns(formatted) == turns and not rewritten
    assert [chat.unescape(formatted[a:b]) for _, _, a, b in spans] == [t for _, t in turns]
    assert all(c not in chat.escape(t) for _, t in turns for c in chat.CONTROLS)
    edges = [0, *[s[1] for s in spans]]
    assert [s[0] for s in spans] == edges[:-1]


def thinking_dropped(turns):
    """Shows a turn's thoughts only while it is the last."""
    return "".join(f"#{r}: {t if i == len(turns) - 1 else t.split('</think>')[-1]}\n" for i, (r, t) in enumerate(turns))


def with_prompt(turns):
    """Ends in a prompt that the next turn replaces."""
    return "".join(f"<{r}>{t}</{r}>" for r, t in turns) + "<next>"


def test_templates_of_others():
    turns = [("user", "a"), ("assistant", "<think>x</think>b"), ("user", "c")]
    assert chat.locate(turns, thinking_dropped)[2]
    text, spans, rewritten = chat.locate(turns, with_prompt)
    assert not rewritten and [text[a:b] for _, _, a, b in spans] == [t for _, t in turns]


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    out = {}
    for conv, turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), learned)]
        out[conv] = (len(turns), sha[0], len(learned), sha[1], len(chat.marked_turns(turns)))
    return out


def test_op2_by_definition(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").collect()
    got = {r.conv_id: tuple(r[1:6]) for r in QUERIES["op2_chat_format"](spark, small).collect()}
    said = "</s>[INST] ok [/INST]"
    own = got.pop(-7)
    assert got == expected(rows)
    assert own[:4] == (2, hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_edges(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "x" * 300_000), (1, 1, "assistant", ""), (None, None, "assistant", "n"), (None, 2, "a\nb", "\\n"),
            (2, 5, "assistant", "same"), (2, 5, "assistant", "same")]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r[1:6]) for r in chat.chat_digest(chat.format_chats(table)).collect()}
    assert got == expected(table.collect())
    assert chat.chat_digest(chat.format_chats(table.limit(0))).collect() == []
    marked = chat.format_chats(table, lambda turns: "".join(f"#{r}: {t}\n" for r, t in turns)).where("conv_id = 1").first()
    assert marked.formatted.startswith("#: \n#user: x")
