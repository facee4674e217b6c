"""How filters interact: what each removes in every order of applying them, by counting paths through the lattice of subsets.

A state is the set of filters applied so far, an edge applies one more. An edge removes the documents that fail its filter and none
of its state, so a document counts by the set of filters it fails, whatever the order, and one pass over the documents gives the
counts of every edge. Orders are paths from the empty set to the full one: a forward pass counts the paths that reach a
state, a backward pass those that lead on from it, and their product says in how many orders an edge is a step. Removals weighted by
it sum to the Shapley value times the number of orders; the steps of one order are the edges along its path.

Documents are reduced to narrow rows once (which rules fail, a digest of the text), and those to one row per part and failed set
before anything is exploded. The tables of the lattice depend on the filters alone: n filters have n! orders and n * 2^(n-1) edges.

Defined cases: a null text is empty, a null part is the empty string; a null id has no smaller one and is smaller than none, so such a
document never fails as a copy, and it has no labels; rows that share an id and a text do not fail by each other; a document whose
label rows differ counts if any of them says 1; an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import stored

SPACES = r"[\x20\x09-\x0D]+"


def text_rules(text: Column, least_words: int = 200, least_distinct: int = 50, most_capitals: int = 2, symbols: str = "[#$%&*|]") -> dict[str, Column]:
    """Conditions a text fails by: too short, too repetitive, too many capitals, holding symbols. Shares are in percent."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < least_words,
        "B": 100 * F.size(F.array_distinct(words)) < least_distinct * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > most_capitals * F.length(text),
        "D": text.rlike(symbols),
    }


def failed_sets(docs: DataFrame, rules: dict[str, Column], doc_id: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, part, mask): bit i is set if the document fails rule i; the last bit if its text is that of a smaller id."""
    mask = reduce(add, [F.coalesce(rule, F.lit(False)).cast("int") * (1 << i) for i, rule in enumerate(rules.values())])
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"),
    )
    rows = stored(narrow, "failed")
    # Copies combine map-side; the join back is by digest and id, so a text with very many copies is spread over its ids.
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + copy.cast("int") * (1 << len(rules))).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame, marks: dict[str, Column], doc_id: str = "doc_id") -> DataFrame:
    """Whether any label row of the document meets each mark."""
    said = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("doc_id"))
    said = said.agg(*[F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in marks.items()])
    return rows.join(said, "doc_id", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in marks})


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Per state, the paths that reach it from the empty set and those that lead from it to the full set."""
    reach, leave = [0] * (1 << n), [0] * (1 << n)
    reach[0] = leave[-1] = 1
    for state in range(1 << n):  # a state comes after all its subsets
        for i in range(n):
            if not state >> i & 1:
                reach[state | 1 << i] += reach[state]
    for state in reversed(range(1 << n)):
        leave[state] += sum(leave[state | 1 << i] for i in range(n) if not state >> i & 1)
    return reach, leave


def edges(rows: DataFrame, names: str, marks: list[str]) -> DataFrame:
    """Every edge of every part: what arrives at its state, what it removes, and its filter's totals read from other edges.

    ``rows`` has part, mask and a 0/1 column per mark. Columns: part, state, filter, arrived, removed, one ``<mark>_lost`` each, fails,
    unique_fails, shapley.
    """
    n, full = len(names), (1 << len(names)) - 1
    spark = rows.sparkSession
    cells = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("docs"), *[F.sum(F.col(m).cast("long")).alias(m) for m in marks])
    # A part without documents that pass all filters still has all edges.
    none = cells.select("part").distinct().select("part", F.lit(0).alias("mask"), *[F.lit(0).cast("long").alias(c) for c in ("docs", *marks)])
    reach, leave = path_counts(n)
    touched = [
        (mask, state, i, mask >> i & 1, reach[state] * leave[state | 1 << i])
        for state in range(full) for i in range(n) if not state >> i & 1 for mask in range(full + 1) if not mask & state
    ]
    lattice = spark.createDataFrame(touched, "mask int, state int, filter int, hit int, paths long")
    hit = F.col("hit") == 1
    found = cells.unionByName(none).join(F.broadcast(lattice), "mask").groupBy("part", "state", "filter", "paths").agg(
        F.sum("docs").alias("arrived"), F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("removed"),
        *[F.sum(F.when(hit, F.col(m)).otherwise(0)).alias(f"{m}_lost") for m in marks],
    )
    # A filter's edges are at most 2^(n-1) a part. The first removes all it fails, the last only what no other removes.
    same = Window.partitionBy("part", "filter")
    last = F.lit(full) - F.expr("shiftleft(1, filter)")
    return found.select(
        "part", "state", "filter", "arrived", "removed", *[f"{m}_lost" for m in marks],
        F.sum(F.when(F.col("state") == 0, F.col("removed"))).over(same).alias("fails"),
        F.sum(F.when(F.col("state") == last, F.col("removed"))).over(same).alias("unique_fails"),
        F.sum(F.col("paths") * F.col("removed")).over(same).alias("shapley"),
    )


def by_order(found: DataFrame, names: str, marks: list[str]) -> DataFrame:
    """The edges along the path of every order: one row per part, order and step."""
    steps = []
    for order in permutations(range(len(names))):
        state = 0
        for k, i in enumerate(order):
            steps.append((state, i, "".join(names[j] for j in order), k + 1))
            state |= 1 << i
    paths = found.sparkSession.createDataFrame(steps, "state int, filter int, filter_order string, step int")
    return found.join(F.broadcast(paths), ["state", "filter"]).select(
        "part", "filter_order", "step", (F.col("arrived") - F.col("removed")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", *[f"{m}_lost" for m in marks], "shapley",
    )
