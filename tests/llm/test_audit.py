import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from conftest import rows
from edge_cases import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from lakeops.llm import audit

def audited(docs, labels):
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failed = audit.failed_sets(docs, audit.text_rules(F.coalesce("text", F.lit(""))))
    found = audit.edges(audit.with_labels(failed, labels, marks), "ABCDE", list(marks))
    return audit.by_order(found, "ABCDE", list(marks))


def applied(docs, labels):
    """Each order applied filter by filter to the rows themselves."""
    first, said = {}, {}
    for d in docs:
        if d.doc_id is not None:
            first[d.text or ""] = min(first.get(d.text or "", d.doc_id), d.doc_id)
    for r in labels:
        marks = said.setdefault(r.doc_id, [0, 0])
        marks[0], marks[1] = marks[0] | (r.quality == 1), marks[1] | (r.toxic == 1)

    def fails(d):
        text = d.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": d.doc_id is not None and first[text] < d.doc_id}
        return {f for f, x in found.items() if x}

    parts = {}
    for d in docs:
        parts.setdefault(d.source or "", []).append((fails(d), *(said.get(d.doc_id, [0, 0]) if d.doc_id is not None else [0, 0])))
    out = {}
    for part, failed in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = failed
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                total = sum(f in x[0] for x in failed)
                out[part, "".join(order), k + 1] = [len(left), len(gone), total - len(gone), sum(x[0] == {f} for x in failed), sum(x[1] for x in gone), sum(x[2] for x in gone)]
                shapley[f] += len(gone)
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return sorted((*k, *v) for k, v in out.items())


def test_orders_by_application(spark, edge_docs, no_docs):
    many = " ".join(f"w{i % 150}" for i in range(400))
    more = [(100 + i, t, None, f"s{i % 3}", None, None, None, None) for i, t in enumerate([many, many, many + " #", "A " * 300, "A b $ " * 90, many + " $", "a b c"])]
    docs = edge_docs.unionByName(spark.createDataFrame(more, edge_docs.schema))
    labels = spark.createDataFrame(
        [(i, i % 2, (i // 2) % 2, 0) for i in range(120)] + [(3, 1, 1, 0), (3, 0, None, 0), (None, 1, 1, 0), (5, None, None, 0)],
        "doc_id bigint, quality int, toxic int, mask int",
    )
    assert rows(audited(docs, labels)) == sorted(applied(docs.collect(), labels.collect()), key=repr)
    assert audited(no_docs, labels).collect() == []
    assert rows(audited(docs, labels.limit(0))) == sorted(applied(docs.collect(), []), key=repr)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_paths(n):
    reach, leave = audit.path_counts(n)
    size = [bin(s).count("1") for s in range(1 << n)]
    assert reach == [factorial(k) for k in size] and leave == [factorial(n - k) for k in size]
