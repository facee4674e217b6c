import zlib

import numpy as np
import pytest
from conftest import rows
from edge_cases import edge_docs, no_docs  # noqa: F401
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.llm import toxicity
from lakeops.llm.queries import QUERIES, learns


def plain_logit(model, words):
    """One window, word by word, from the definition."""
    w, h = model.weights, toxicity.HIDDEN

    def vector(word):
        of, _, counts = toxicity.triples([word])
        return (w["words"][model.vocabulary.get(word, 0)] + w["triples"][of].sum(axis=0) / counts[0]) @ w["project"] + w["shift"]

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def read(xs, u):
        state, out = np.zeros(h), []
        for x in xs:
            z, r = sig(x[:h] + state @ u[:, :h]), sig(x[h : 2 * h] + state @ u[:, h : 2 * h])
            state = (1 - z) * np.tanh(x[2 * h :] + r * (state @ u[:, 2 * h :])) + z * state
            out.append(state)
        return out

    xs = [vector(x) for x in words]
    ahead = read([x[: 3 * h] for x in xs], w["u_ahead"])
    back = read([x[3 * h :] for x in reversed(xs)], w["u_back"])[::-1]
    states = np.array([np.concatenate(p) for p in zip(ahead, back, strict=True)])
    energy = states @ w["attend"]
    attention = np.exp(energy - energy.max())
    return (attention / attention.sum()) @ states @ w["out"] + w["bias"][0]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    clean = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(clean, rng.integers(1, 200))) for _ in range(200)]
    texts += [" ".join([*rng.choice(clean, rng.integers(1, 90)), "vilest", *rng.choice(clean, rng.integers(1, 90))]) for _ in range(100)]
    return toxicity.train(texts, [0] * 200 + [1] * 100, epochs=25)


def test_network_by_definition(model):
    rng = np.random.default_rng(2)
    texts = ["", "vilest", "Unseen Wörter hier", " ".join(f"w{i}" for i in rng.integers(0, 99, 333)), None, "w1 " * 64, "w2 " * 65, "w3 " * 112, "w4 " * 113]
    for text, got in zip(texts, model.logits(texts), strict=True):
        words = toxicity.words_of(text)
        covered, logits = set(), []
        for a in toxicity.starts(len(words)):
            part = range(a, min(len(words), a + toxicity.WINDOW))
            covered |= set(part)
            logits.append(plain_logit(model, [words[i] for i in part]))
        assert covered == set(range(len(words))) and abs(max(logits) - got) < 1e-3


@settings(max_examples=40, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), cuts=st.lists(st.integers(0, 40), max_size=6), cached=st.booleans())
def test_scores_are_those_of_the_text_alone(model, seed, cuts, cached):
    """To the last bit, in any order and batches, with or without words seen before."""
    rng = np.random.default_rng(seed)
    texts = ["", None, "vilest", *[" ".join(rng.choice([*(f"w{i}" for i in range(80)), "vilest", "Wörter", "x" * 40], rng.choice([1, 5, 64, 65, 300]))) for _ in range(37)]]
    alone = [toxicity.Model(model.vocabulary, model.weights).scores([t])[0] for t in texts]
    order, edges = rng.permutation(len(texts)), sorted({0, len(texts), *cuts})
    other = toxicity.Model(model.vocabulary, model.weights)
    if cached:
        other.scores(texts[::-1])
    for a, b in zip(edges, edges[1:], strict=False):
        part = order[a:b]
        assert other.scores([texts[i] for i in part]).tolist() == [alone[i] for i in part]


def test_gradients():
    """Against differences of the loss."""
    rng = np.random.default_rng(1)
    names = ["a", "b", "cc", "ddd", "é"]
    words, w = toxicity.Words(names, {"a": 1, "cc": 2}), toxicity.initial_weights(2)
    ids = rng.integers(0, 5, (6, 4))
    mask = (np.arange(6)[:, None] < np.array([6, 3, 6, 2])).astype(np.float32)
    args = (words, ids, mask, np.array([0, 0, 1, 2]), np.array([1, 0, 1], np.float32))
    _, grads = toxicity.loss_and_gradients(w, *args)
    for key, grad in grads.items():
        for at in list(zip(*np.nonzero(np.abs(grad) > 1e-4), strict=True))[:6]:
            ends = []
            for step in (1e-2, -1e-2):
                moved = {k: v.astype(np.float64) for k, v in w.items()}
                moved[key][at] += step
                ends.append(toxicity.loss_and_gradients(moved, *args)[0])
            assert abs((ends[0] - ends[1]) / 2e-2 - grad[at]) < 2e-3 + 0.03 * abs(grad[at]), key


def test_one_bad_word_in_a_long_text(model):
    long = " ".join(f"w{i % 60}" for i in range(4000))
    half = long[: len(long) // 2].rpartition(" ")[0]
    clean, bad, first, last = model.scores([long, f"{half} vilest {half}", f"vilest {long}", f"{long} vilest"])
    assert clean < 0.5 < min(bad, first, last)


def test_op4_on_held_out(spark, small):
    """Trained on the larger table's labels: held-out documents are told apart; no label, source or id enters a score."""
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, folder).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for d, r in got.items())
    held = [(got[d].score, t) for d, t in truth.items() if got[d].held_out]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad]) > 0.95
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.95


def test_edges(spark, model, edge_docs, no_docs):
    scored = toxicity.score(edge_docs, model)
    assert scored.count() == edge_docs.count() and rows(scored, "_row.*") == rows(edge_docs)
    by_text = {}
    for r in scored.select("_row.text", "score").collect():
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert toxicity.drop_toxic(edge_docs, model).columns == edge_docs.columns
    assert toxicity.score(no_docs, model).collect() == []
    assert toxicity.train([], []).scores(["a", None]).tolist() == [0.0, 0.0]
    assert toxicity.train(["a"], [1]).scores([""]).tolist() == [1.0]
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (99, 0)], "doc_id bigint, toxic int")
    texts, known = toxicity.labelled_sample(edge_docs, labels, F.lit(True))
    assert sorted(zip(texts, known, strict=True)) == [("", 0), ("", 1)]
    assert toxicity.labelled_sample(edge_docs, labels, learns())[1] is not None


def test_a_repeated_id_displaces_no_other(spark):
    """Many rows of one labelled id are one sample, the same in any order of the rows."""
    many = spark.range(7000).selectExpr("1L AS doc_id", "'bad ' || id AS text")
    docs = many.unionByName(spark.createDataFrame([(2, "good")], "doc_id bigint, text string")).coalesce(1)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    for rows in (docs, docs.repartition(7)):
        assert toxicity.labelled_sample(rows, labels, F.lit(True)) == (["bad 0", "good"], [1, 0])
