import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from edge_cases import edge_docs, no_docs  # noqa: F401
from tokenizers import Tokenizer

from lakeops.llm import components, lengths, simhash
from lakeops.llm.tokens import public_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(spark, texts, words):
    """Fingerprints from Spark's own hash function, counted bit by bit."""
    out = {}
    for text in set(texts):
        found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
        frame = spark.createDataFrame([(s,) for s in shingles], "s string").selectExpr("xxhash64(s) AS h")
        hashes = [r.h & (2**64 - 1) for r in frame.collect()]
        out[text] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out


def plain_components(items, max_bits):
    """(id, fp) rows to component ids by comparing all pairs of fingerprints."""
    prints = sorted({fp for _, fp in items})
    lead = {p: p for p in prints}

    def find(p):
        while lead[p] != p:
            p = lead[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                lead[max(find(a), find(b))] = min(find(a), find(b))
    ids = defaultdict(list)
    for doc, fp in items:
        ids[find(fp)].append(doc)
    return {fp: min((d for d in ids[find(fp)] if d is not None), default=None) for fp in prints}


def test_fingerprints(spark, edge_docs):
    texts = ["", "One two", "one TWO three Four five \x0b six\x85seven É", " a  b\tc\nd e f " * 40]
    want = plain_print(spark, texts, 4)
    assert [simhash.fingerprint(t, 4) for t in texts] == [want[t] for t in texts]
    assert simhash.fingerprint(None, 4) == 0


def test_chunks(monkeypatch):
    text = " ".join(str(i * i) for i in range(500))
    whole = simhash.fingerprint(text, 4)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text, 4) == whole


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 7])
def test_components_against_all_pairs(spark, max_bits):
    """Random fingerprints, chains of small steps, and a dense ball of many."""
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, max_bits + 2))))
    ball = rng.getrandbits(64)
    prints += [ball ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)]
    items = [(i if i % 7 else None, p) for i, p in enumerate(prints + prints[:40])]
    table = spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in items], "doc_id bigint, fp bigint").repartition(5)
    want = plain_components(items, max_bits)
    for block in (simhash.BLOCK, 30):  # whole keys, and hot keys as pairs of blocks
        got = simhash.fingerprint_components(table, max_bits, block).select("fp", "component_id").collect()
        assert {r.fp & (2**64 - 1): r.component_id for r in got} == want


def test_a_hot_key_is_split(spark):
    """Every pair of a hot key's rows meets in a group, no group holds more than about two blocks, other keys are left alone."""
    keyed = spark.range(500).selectExpr("0 AS place", "7L AS value", "id * 31 AS fp").unionByName(spark.range(40).selectExpr("1 AS place", "id % 4 AS value", "id AS fp"))
    split = simhash._split_hot(keyed, 50)
    groups = defaultdict(set)
    for r in split.collect():
        groups[r.place, r.value, r.pair].add(r.fp)
    assert max(map(len, groups.values())) < 170 and len(groups) == 45 + 4
    assert {frozenset(v) for (place, _, _), v in groups.items() if place} == {frozenset(range(i, 40, 4)) for i in range(4)}
    met = {(a, b) for (place, _, _), v in groups.items() if not place for a in v for b in v}
    assert len(met) == 500 * 500


def test_near_duplicates(spark, edge_docs, no_docs, small):
    for docs in (edge_docs, spark.read.parquet(f"{small}/documents.parquet")):
        data = [(r.doc_id, r.text, simhash.fingerprint(r.text, 4)) for r in docs.collect()]
        named = plain_components([(d, p) for d, _, p in data], 4)
        got = simhash.near_duplicates(docs)
        assert rows(got) == sorted(((d, f"{p:016x}", named[p]) for d, _, p in data), key=repr)
        stay = simhash.keep_representatives(docs)
        assert stay.columns == docs.columns
        components_left = Counter(named[simhash.fingerprint(r.text, 4)] for r in stay.collect())
        assert set(components_left.values()) == {1} and set(components_left) == set(named.values())
        assert all(r.doc_id == named[simhash.fingerprint(r.text, 4)] for r in stay.collect())
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_representatives(no_docs).collect() == []


def test_long_path(spark):
    """A path, a star and a loop."""
    edges = [(i, i + 1) for i in range(400)] + [(10_000, 20_000 + i) for i in range(300)] + [(7, 7)]
    found = components.roots(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert rows(found) == sorted([(i, 0) for i in range(1, 401)] + [(20_000 + i, 10_000) for i in range(300)], key=repr)


def test_length_histogram(spark, edge_docs, no_docs, small, monkeypatch):
    monkeypatch.setattr(lengths, "BUCKET", 50)
    path, tokenizer = public_path("byte_bpe_50k.json"), Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    for docs in (edge_docs, spark.read.parquet(f"{small}/documents.parquet")):
        sizes = np.array([len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.select("text").collect()])
        histogram = lengths.length_histogram(lengths.token_lengths(docs, path))
        want = []
        for n in np.unique(sizes).tolist():
            over, under = sizes[sizes >= n], sizes[sizes < n]
            want.append((n, int((sizes == n).sum()), len(over), int(over.sum()), len(under), int(under.sum()), int(np.minimum(sizes, n).sum())))
        assert rows(histogram) == sorted(want, key=repr)
        for limit in (0, 1, 100, 10**6):
            cut = lengths.truncated_total(histogram, limit).first()
            assert (cut.tokens, cut.docs_cut) == (int(np.minimum(sizes, limit).sum()), int((sizes > limit).sum()))
        shares = [0.1, 0.5, 0.99, 1.0]
        assert list(lengths.quantiles(histogram, shares).first()) == np.quantile(sizes, shares, method="inverted_cdf").tolist()
    empty = lengths.length_histogram(lengths.token_lengths(no_docs, path))
    assert empty.collect() == [] and lengths.truncated_total(empty, 5).first().tokens == 0 and lengths.quantiles(empty, [0.5]).first()[0] is None
