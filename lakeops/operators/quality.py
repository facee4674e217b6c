"""Data quality: quarantine, gates, referential integrity, expectations, control totals."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalars import holds

REASON = "_dq_reason"


class QualityGateError(RuntimeError):
    """More rows were rejected than the gate allows."""


class ExpectationError(RuntimeError):
    """Rows violate a declared expectation."""


def all_hold(rules: Mapping[str, Column]) -> Column:
    """Conjunction of the rules; unknown where a rule is unknown and none is false."""
    return reduce(and_, rules.values())


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row does not meet, joined by commas; empty for a good row."""
    return F.concat_ws(",", *[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()])


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with a reason.

    An unknown predicate (null input) rejects, so valid and rejected together are the input. The rules are
    plain conjuncts of the valid side, so they reach its scan.
    """
    good = all_hold(rules)
    return df.filter(good), df.filter(~holds(good)).withColumn(REASON, failed_rules(rules))


def gate_metrics(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: rows in the batch, valid, rejected and rejected share. One pass, no separate counts."""
    bad = F.count_if(~holds(all_hold(rules)))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("batch_rows"),
        (total - bad).alias("valid_rows"),
        bad.alias("rejected_rows"),
        F.try_divide(bad, total).alias("rejected_share"),
    )


def quality_gate(metrics: DataFrame, max_share: float = 0.10) -> dict:
    """The metrics row; raises when the rejected share is above ``max_share``."""
    row = metrics.first().asDict()
    if row["rejected_rows"] > max_share * row["batch_rows"]:
        raise QualityGateError(f"{row['rejected_rows']} of {row['batch_rows']} rows rejected")
    return row


def ri_split(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key exists in ``dim``, and orphans with a reason (null keys are orphans)."""
    known = dim.select(F.col(dim_key or key).alias(key))
    orphans = fact.join(known, key, "left_anti").withColumn(REASON, F.lit(f"{key} not found"))
    return fact.join(known, key, "left_semi"), orphans


def expect(df: DataFrame, rules: Mapping[str, Column], null_ok: bool = True) -> DataFrame:
    """Fail fast: raise if any row breaks a rule. With ``null_ok`` an unknown result passes, as in SQL CHECK."""
    counts = [
        F.count_if(~F.coalesce(rule, F.lit(null_ok))).alias(name) for name, rule in rules.items()
    ]
    broken = {name: n for name, n in df.agg(*counts).first().asDict().items() if n}
    if broken:
        raise ExpectationError(f"rows breaking each rule: {broken}")
    return df


def guarded(df: DataFrame, name: str, rule: Column, null_ok: bool = True) -> DataFrame:
    """Lazy form of :func:`expect`: the job that reads the rows stops at the first violation."""
    ok = F.coalesce(rule, F.lit(null_ok))
    return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"rule broken: {name}")).cast("boolean")))


def control_totals(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Checks as rows (check, actual): all aggregates in one pass, then turned into rows."""
    totals = df.agg(*[c.cast("double").alias(n) for n, c in checks.items()])
    return totals.unpivot([], list(checks), "check", "actual")


def reconcile(actual: DataFrame, expected: Mapping[str, float]) -> DataFrame:
    """Actual against expected control totals with a verdict per check."""
    pairs = [F.struct(F.lit(k).alias("check"), F.lit(float(v)).alias("expected")) for k, v in expected.items()]
    wanted = F.map_from_entries(F.array(*pairs))
    goal = F.try_element_at(wanted, F.col("check"))
    return actual.select("check", "actual", goal.alias("expected"), holds(F.col("actual") == goal).alias("matches"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table as rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
