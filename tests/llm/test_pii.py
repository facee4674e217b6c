import hashlib
import re
from itertools import product

import numpy as np
from compare import connect
from edge_cases import edge_docs, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import pii
from lakeops.llm.queries import QUERIES

# The patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = sum(d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(reversed(digits)))
            passes = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 8 <= len(digits) <= 15,
            }[kind]
            if passes:
                out.append((kind, *m.span()))
    return out


PART = st.sampled_from(["a", "é", "_", "%", "@", ".", "-", "+", " ", "(", ")", "\n", "0", "7", "12", "255", "256", "a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 (234) 555-0101"])


@settings(max_examples=1500, derandomize=True, deadline=None)
@given(text=st.lists(PART, max_size=14).map("".join))
def test_base_equals_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)
    base, whole = pii.find_spans([text])[0]
    assert base == plain_spans(text) and set(base) <= set(whole)
    assert all(y <= a or x >= b for _, a, b in set(whole) - set(base) for _, x, y in base)


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "+" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " " * 300_000, "1 " * 100_000):
        pii.find_spans([text])


def test_viterbi_and_likelihood_by_enumeration():
    model, rng = pii.tagger(), np.random.default_rng(3)
    k = len(pii._TAGS)
    batch = [rng.normal(size=(n, k)) * 3 for n in (1, 3, 5, 2, 5)]
    for scores, tags in zip(batch, model.decode(batch), strict=True):
        paths = list(product(range(k), repeat=len(scores)))
        value = [model.first[p[0]] + sum(scores[t, x] for t, x in enumerate(p)) + sum(model.moves[a, b] for a, b in zip(p, p[1:])) for p in paths]
        assert tuple(tags) == paths[int(np.argmax(value))]
        weight = np.exp(value) / np.exp(value).sum()
        marginal, pairs = pii._expected(scores, model.moves, model.first)
        want = np.zeros_like(scores)
        for p, w in zip(paths, weight, strict=True):
            want[np.arange(len(p)), p] += w
        assert np.allclose(marginal, want) and np.isclose(pairs.sum(), len(scores) - 1)


def test_learned_spans():
    """Numbers the patterns leave out are found in new contexts; other numbers are left alone. No text is of the labelled table."""
    found = {"ring (646) 555-0123 tonight": "phone", "his line 718-555-0166 is busy": "phone", "card 4000.0566.5566.5556 ok": "card"}
    for text, kind in found.items():
        base, whole = pii.find_spans([text])[0]
        assert base == [] and [k for k, _, _ in whole] == [kind]
    others = ("on 2023-11-30 it was", "version 4.5.6 of", "id 7119402835566021 and", "costs 1,250.00 now", "see pages 3-9 there", 'token = "b07d11ce94fa2235e8d06c7a5fb31904ee27c8d3"')
    for text in others:
        assert pii.find_spans([text])[0] == ([], [])
    known = " ".join(pii.LABELLED)
    assert not [x for text in (*found, *others) for x in re.findall(r"[0-9a-f().-]*[0-9][0-9a-f ().-]{6,}", text) if x.strip() in known]
    assert pii.masked("mail a@b.co or +1 (234) 555-0101.") == "mail [email] or [phone]."


def test_spans_that_touch():
    """Two numbers of a kind side by side are two spans."""
    text = "ring (646) 555-0123 718-555-0166 tonight"
    assert [(k, text[a:b]) for k, a, b in pii.find_spans([text])[0][1]] == [("phone", "(646) 555-0123"), ("phone", "718-555-0166")]
    text = "our lines: 347-555-0111 347-555-0112 347-555-0118 are open"
    assert [text[a:b] for _, a, b in pii.find_spans([text])[0][1]] == ["347-555-0111", "347-555-0112", "347-555-0118"]


def test_labelled_table_is_invented():
    """None of its marked or numeric parts stands in a document."""
    parts = {m[2] for line in pii.LABELLED for m in pii._MARK.finditer(line) if "example" not in m[2]}
    parts |= {x for line in pii.LABELLED for x in re.findall("[0-9a-f]{9,}", line) if re.search("[0-9]", x)}
    con = connect("/root/testdata/sf0.1")
    # Published test numbers and reserved addresses may stand anywhere.
    public = {"10.0.0.1", "8.8.8.8", "4111 1111 1111 1111", "4111111111111111"}
    assert [x for x in sorted(parts - public) if con.execute("SELECT count(*) FROM documents WHERE contains(text, ?)", [x]).fetchone()[0]] == []


def test_op5_by_definition(spark, small, edge_docs, no_docs):
    for docs, got in ((spark.read.parquet(f"{small}/documents.parquet"), QUERIES["op5_personal_data"](spark, small)), (edge_docs, pii.personal_data(edge_docs))):
        want = []
        for r in docs.collect():
            spans = plain_spans(r.text or "")
            counts = [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]
            want.append((r.doc_id, *counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
        assert sorted((tuple(r[:6]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert pii.personal_data(no_docs).collect() == []


def test_a_long_sequence_pads_no_others(monkeypatch):
    """Decoding batches are bounded by their padded size, and spans do not depend on the batch."""
    sizes, decode = [], pii.Tagger.decode

    def seen(self, sequences):
        sizes.append((len(sequences), max(map(len, sequences))))
        return decode(self, sequences)

    texts = [f"call {i} 555 0101 now" for i in range(500)] + ["1 2 " * 2500, "call +1 555 010 1234 " * 1000]
    alone = [pii.find_spans([t])[0] for t in texts]
    monkeypatch.setattr(pii.Tagger, "decode", seen)
    assert pii.find_spans(texts) == alone
    assert sum(n for n, _ in sizes) == len(texts)
    assert all(n == 1 or n * longest <= 1 << 20 for n, longest in sizes)
