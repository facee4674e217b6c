from collections import Counter, defaultdict

import corpus_pipeline
from edge_cases import edge_docs  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import exact, packing, simhash
from lakeops.llm.queries import learns, table, toxicity_model
from lakeops.llm.tokens import encoder, public_path


def test_stages(spark, small):
    """Each stage against a plain version on what it was given."""
    docs = table(spark, small, "documents")
    model = toxicity_model(docs, table(spark, small, "labels"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = stage(spark, docs, small)
        got = after.collect()
        if name != "sequence_packing":
            assert after.columns == docs.columns and len({r.doc_id for r in got}) == len(got)
            assert all(before[r.doc_id] == r for r in got)
        kept[name] = [r.doc_id for r in got]
        if name == "toxicity":
            scores = dict(zip(before, model.scores([r.text for r in before.values()]), strict=True))
            assert set(kept[name]) == {d for d, s in scores.items() if s < 0.5}
        if name == "exact_dedup":
            last = {r.text: d for d, r in sorted(before.items())}
            assert set(kept[name]) == set(last.values())
        if name == "simhash_near_dedup":
            prints = {d: simhash.fingerprint(r.text, 4) for d, r in before.items()}
            groups = defaultdict(set)
            for a in prints:
                groups[a] = {b for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4}
            seen, least = set(), set()
            for a in sorted(prints):
                if a not in seen:
                    least.add(a)
                    todo = [a]
                    while todo:
                        x = todo.pop()
                        if x not in seen:
                            seen.add(x)
                            todo += groups[x]
            assert set(kept[name]) == least
        if name == "source_mixing":
            assert sorted(kept[name]) == sorted(before)
        if name == "sequence_packing":
            assert set(kept[name]) == set(before)
        docs = after
    run = corpus_pipeline.run(spark, small)
    assert sorted({r.doc_id for r in run.collect()}) == sorted(set(kept["source_mixing"]))
    assert learns() is not None


def test_run_on_empty_tables(spark, small, tmp_path):
    """No documents: no pieces. No labels: no document is toxic, all texts are packed."""
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    for name, d, la in (("no_docs", docs.limit(0), labels), ("no_labels", docs.limit(40), labels.limit(0))):
        d.write.parquet(str(tmp_path / name / "documents.parquet"))
        la.write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "no_docs")).collect() == []
    got = corpus_pipeline.run(spark, str(tmp_path / "no_labels")).collect()
    given = table(spark, str(tmp_path / "no_labels"), "documents")
    left = simhash.keep_representatives(exact.drop_copies(given), words=4, max_bits=4)
    assert got and {r.doc_id for r in got} == {r.doc_id for r in left.collect()}


def test_run_on_edge_rows(spark, small, tmp_path, edge_docs):
    """Null ids, texts and sources, repeated rows, a very long text: each different text is packed once, whole."""
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, small, "labels").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encode = encoder(public_path("word_bpe_49k.json")).encode
    left = simhash.keep_representatives(exact.drop_copies(edge_docs), words=4, max_bits=4).collect()
    want = Counter()
    for r, ids in zip(left, encode([r.text or "" for r in left]), strict=True):
        want[r.doc_id] += len(ids) // 4 + 1
    lengths = Counter()
    for r in got:
        lengths[r.doc_id] += r.length
    assert lengths == want


def test_order_with_a_clashing_column(spark, small, tmp_path):
    """A column named as the file's own: the stored order is still that of the files."""
    docs = table(spark, small, "documents").withColumn("_metadata", F.lit("mine"))
    docs, ids = stored_unevenly(spark, docs, str(tmp_path / "mixed"))
    in_order(corpus_pipeline.packed(spark, docs, small), ids)
    assert packing.stored_order(spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, _metadata string")) == []


def test_held_pieces_are_counted_by_row(monkeypatch):
    """Sequences of many small pieces are handed on by their pieces, not by their number."""
    monkeypatch.setattr(packing, "HELD_ROWS", 100)
    item = (1, 0, 0, 1, 0, 0)
    sizes = [b.num_rows for b in packing._packed(((1, item) for _ in range(1000)), 50, 4, True)]
    assert sum(sizes) == 1000 and max(sizes) == 100


def stored_unevenly(spark, docs, path):
    """Three files, each longer than the one before; the ids in stored order."""
    rows = docs.orderBy("doc_id").collect()
    cuts = [0, len(rows) // 12, len(rows) // 3, len(rows)]
    parts = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    spark.sparkContext.parallelize(parts, 3).flatMap(lambda x: x).toDF(docs.schema).write.parquet(path)
    return spark.read.parquet(path), [r.doc_id for r in rows]


def in_order(made, ids):
    """By sequence id, the first document of each sequence never steps back in stored order."""
    place, first = {d: i for i, d in enumerate(ids)}, {}
    for r in made.collect():
        first[r.sequence_id] = min(first.get(r.sequence_id, len(ids)), place[r.doc_id])
    got = [first[s] for s in sorted(first)]
    assert len(got) > 3 and got[0] == 0 and got == sorted(got)


def test_packing_keeps_the_stored_order(spark, small, tmp_path, monkeypatch):
    """Files of unequal size are read largest first; packing takes them by number, in every round."""
    docs, ids = stored_unevenly(spark, table(spark, small, "documents"), str(tmp_path / "mixed"))
    assert [r.doc_id for r in docs.select("doc_id").collect()] != ids
    in_order(corpus_pipeline.packed(spark, docs, small), ids)
    monkeypatch.setattr(packing, "REPACK_ROWS", 20)
    in_order(packing.pack(docs, public_path("word_bpe_49k.json"), 1, 4096, open_limit=4, order=packing.stored_order(docs)), ids)
