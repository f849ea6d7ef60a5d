"""Row-level data-quality rules with drop / warn / fail actions (Q1-Q4).

A rule is a named SQL predicate. A null predicate counts as failed. All rules
of a table see the same rows (the table's output after casts), as declarative
expectations do. Failing a ``fail`` rule raises inside the plan
(``raise_error``), so no extra pass over the data is needed; counts for the
report come from one aggregate with a ``count_if`` per rule (partial
aggregation, one tiny shuffle), or from metrics observed while the table is
written (``observe_expectations``), without a pass of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACTIONS = ("drop", "warn", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}: {self.action}")

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "warn")


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "drop")


def expect_or_fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "fail")


def apply_expectations(df: DataFrame, rules: Sequence[Expectation],
                       warn_flags: bool = False) -> DataFrame:
    """Enforce ``rules`` on ``df``.

    fail -> the job stops on the first failing row; drop -> failing rows are
    removed; warn -> rows kept (with a boolean ``<name>`` column when
    ``warn_flags``).
    """
    fails = [r for r in rules if r.action == "fail"]
    for r in fails:
        df = df.filter(F.when(r.passed(), F.lit(True)).otherwise(
            F.raise_error(F.lit(f"expectation '{r.name}' failed: {r.predicate}"))))
    if warn_flags:
        df = df.withColumns({r.name: r.passed() for r in rules if r.action == "warn"})
    drops = [r.passed() for r in rules if r.action == "drop"]
    if drops:
        cond = drops[0]
        for c in drops[1:]:
            cond = cond & c
        df = df.filter(cond)
    return df


def expectation_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: rule, action, passed_records, failed_records (Q4)."""
    aggs = []
    for i, r in enumerate(rules):
        aggs.append(F.count_if(r.passed()).alias(f"p{i}"))
        aggs.append(F.count_if(~r.passed()).alias(f"f{i}"))
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                 F.col(f"p{i}").alias("passed_records"), F.col(f"f{i}").alias("failed_records"))
        for i, r in enumerate(rules)]))
    return wide.select(rows.alias("r")).select("r.*")


def observe_expectations(df: DataFrame, rules: Sequence[Expectation], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """``df`` with the rules' counts observed as its rows go by (Q2, Q4): write it, then read ``observed_report``.

    Put it before ``apply_expectations``, so that dropped rows count. On a stream
    the counts come per micro-batch under ``observedMetrics`` of its progress:
    there, use ``expectation_metrics`` with a name.
    """
    seen = Observation(name)
    return df.observe(seen, *expectation_metrics(rules)), seen


def expectation_metrics(rules: Sequence[Expectation]) -> list[Column]:
    return [c for i, r in enumerate(rules) for c in (F.count_if(r.passed()).alias(f"p{i}"), F.count_if(~r.passed()).alias(f"f{i}"))]


def observed_report(spark: SparkSession, observation: Observation, rules: Sequence[Expectation]) -> DataFrame:
    """The report of ``expectation_report`` from an observation whose frame has been written; two numbers per rule."""
    got = observation.get
    rows = [(r.name, r.action, got[f"p{i}"], got[f"f{i}"]) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule string, action string, passed_records long, failed_records long")
