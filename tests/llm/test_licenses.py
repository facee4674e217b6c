import re
from collections import Counter

from conftest import plan, rows
from edge_cases import edge_docs, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import licenses

NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def plain(text):
    """The base columns by comparing words at every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for label, phrase in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_edges(spark, edge_docs, no_docs):
    more = [(50, "MIT License, mit LICENSE mit\x00license", None, None, None, None, None, None), (50, "MIT License, mit LICENSE mit\x00license", None, None, None, None, None, None),
            (None, "the GNU general  public.license", None, None, None, None, None, None)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, edge_docs.schema))
    got = Counter((r.doc_id, *(r[c] for c in NAMES)) for r in licenses.scan(docs).collect())
    assert got == Counter((d.doc_id, *plain(d.text)) for d in docs.collect())
    assert licenses.scan(no_docs).collect() == []


def test_random_phrases(spark):
    found = []

    @settings(max_examples=300, derandomize=True, deadline=None, database=None)
    @given(st.lists(st.sampled_from(["mit", "MIT", "license", "Apache", "general", "public", "x", "é", "licensé", "K", ",", "\n", "4"]), max_size=14))
    def draw(parts):
        found.append(" ".join(parts))

    draw()
    got = scanned(spark, found)
    for i, text in enumerate(found):
        assert tuple(got[i][c] for c in NAMES) == plain(text), text
        assert 0 <= got[i].score <= 1 and set(filter(None, got[i].base_labels.split(","))) <= set(filter(None, got[i].labels.split(",")))


def test_notices(spark):
    """Whole notices, with a word put in or left out, and with too much of them missing."""
    notice = dict(licenses.NOTICES)["bsd"].split()
    edited = [*notice[:7], "all", *notice[7:]]
    texts = ["x y " + " ".join(notice) + " z", "A " + ", ".join(edited), " ".join(notice[:6] + notice[7:]), " ".join(notice[:7]), " ".join(notice[::-1]), "word " * 5000 + " ".join(notice)]
    got = scanned(spark, texts)
    assert [got[i].labels for i in range(6)] == ["bsd", "bsd", "bsd", "", "", "bsd"]
    assert [round(got[i].score, 2) for i in (0, 1, 3, 4)] == [1.0, round(14 / 15, 2), 0.5, 0.0]
    assert got[1].n_base == 0 and got[1].base_labels == ""


def test_no_python_and_texts_unshuffled(spark, edge_docs):
    shown = plan(licenses.scan(edge_docs.select("doc_id", "text")))
    assert "Python" not in shown and "Arrow" not in shown
    assert "text#" not in "".join(line for line in shown.split("\n") if "Exchange hashpartitioning" in line)


def test_many_places_in_one_text(spark):
    got = scanned(spark, ["mit license " * 30_000])[0]
    assert (got.n_words, got.n_base, got.first_word, got.last_word) == (60_000, 30_000, 0, 59_998)
    assert rows(licenses.scan(spark.createDataFrame([(1, None)], "doc_id bigint, text string"))) == [(1, 0, 0, None, None, "", "", 0.0)]
