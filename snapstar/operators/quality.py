"""Row-level quality rules.

A rule is a name and a predicate that is *true* for a good row.  A row fails
a rule when the predicate is false **or null**, so valid and invalid are an
exact partition of the input (with separate valid/invalid filters three-valued
logic lets a row with a null fall into neither set).

All rules of a set evaluate in one projection; splitting and gating need one
pass, and the gate's counts come from a single aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED = "failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def not_null(*cols: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", F.col(c).isNotNull()) for c in cols]


def between(col: str, lo, hi, name: str | None = None) -> Rule:
    return Rule(name or f"{col}_between_{lo}_{hi}", F.col(col).between(lo, hi))


def non_negative(col: str, allow_null: bool = False) -> Rule:
    pred = F.col(col) >= 0
    if allow_null:
        pred = F.col(col).isNull() | pred
    return Rule(f"{col}_non_negative", pred)


def failed_rules(rules: Sequence[Rule]) -> Column:
    """array<string> of the names of failed rules (empty when valid)."""
    flags = [F.when(~F.coalesce(r.predicate, F.lit(False)), F.lit(r.name)) for r in rules]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def with_failures(df: DataFrame, rules: Sequence[Rule], col: str = FAILED) -> DataFrame:
    return df.withColumn(col, failed_rules(rules))


def all_pass(rules: Sequence[Rule]) -> Column:
    """Conjunction of the raw predicates.  As a filter condition a null
    counts as false, so this keeps exactly the valid rows - and, unlike a
    test on ``failed_rules``, simple predicates (not-null, ranges, IN) reach
    the parquet scan as pushed filters."""
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.predicate
    return cond


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with ``failed_rules``) - an exact partition."""
    valid = df.filter(all_pass(rules))
    marked = with_failures(df, rules)
    invalid = marked.filter(F.size(FAILED) > 0)
    return valid, invalid


def mark(df: DataFrame, rules: Sequence[Rule], col: str) -> DataFrame:
    """With whether a row passes all rules, for a table that is stored and then split."""
    return df.withColumn(col, F.coalesce(all_pass(rules), F.lit(False)))


def split_marked(df: DataFrame, rules: Sequence[Rule], col: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`split`, for a table stored by :func:`mark`: whoever counts the valid rows
    reads one column and not all that the rules look at."""
    return df.where(F.col(col)).drop(col), with_failures(df.where(~F.col(col)).drop(col), rules)


def rule_counts(df: DataFrame, rules: Sequence[Rule], extra_null_cols: Sequence[str] = ()) -> DataFrame:
    """One row: total rows, invalid rows, failures per rule and, optionally,
    ``<col>_nulls`` counts - all in a single aggregate over one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    any_fail = F.lit(False)
    for r in rules:
        bad = ~F.coalesce(r.predicate, F.lit(False))
        aggs.append(F.count_if(bad).alias(r.name))
        any_fail = any_fail | bad
    aggs.insert(1, F.count_if(any_fail).alias("invalid_rows"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in extra_null_cols]
    return df.agg(*aggs)


class QualityGateError(RuntimeError):
    pass


def gate(df: DataFrame, rules: Sequence[Rule], max_invalid: int = 0) -> DataFrame:
    """Fail when more than ``max_invalid`` rows break a rule; else return the
    valid rows.  One aggregate action."""
    counts = rule_counts(df, rules).first().asDict()
    if counts["invalid_rows"] > max_invalid:
        broken = {k: v for k, v in counts.items() if k not in ("rows", "invalid_rows") and v}
        raise QualityGateError(f"{counts['invalid_rows']} invalid rows of {counts['rows']}: {broken}")
    return split(df, rules)[0]


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows`` and ``<col>_nulls`` for each column."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])
