"""Judge rows against declared rules and split them into valid and rejected.

Both sides come from the one rule list of a table: a row is rejected when any
rule holds, so no row can land on both sides or on neither.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import (
    normalize_blank_strings,
    parse_dates,
    parsed_name,
    text_name,
    type_numbers,
)
from orderlake.operators.duplicates import COUNT, add_duplicate_count
from orderlake.operators.skew import DEFAULT_POLICY, SkewPolicy

SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """A defect: its reason code and the condition under which a row has it."""

    reason: str
    broken: Callable[[], Column]


@dataclass(frozen=True)
class TableSpec:
    """Everything that distinguishes the cleaning of one table from another's."""

    name: str
    key: str
    schema: T.StructType
    rules: tuple[Rule, ...]
    dates: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    text: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        text = tuple(f.name for f in self.schema if isinstance(f.dataType, T.StringType))
        object.__setattr__(self, "text", text)


def any_broken(rules: Sequence[Rule]) -> Column:
    """True when a rule holds; a condition that is NULL counts as kept."""
    return reduce(Column.__or__, (F.coalesce(r.broken(), F.lit(False)) for r in rules))


def reasons(rules: Sequence[Rule]) -> Column:
    """Reason codes of all broken rules, in list order; empty when none is broken."""
    return F.concat_ws(SEPARATOR, *(F.when(r.broken(), F.lit(r.reason)) for r in rules))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("rejection_reason", reasons(rules))


def prepare(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Normalise text, type numbers and parse dates: all that needs one row only."""
    typed = type_numbers(normalize_blank_strings(raw, spec.text), spec.schema)
    return parse_dates(typed, spec.dates)


def judge(raw: DataFrame, spec: TableSpec, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Prepared rows plus the duplicate count; the rules can be applied to these."""
    return add_duplicate_count(prepare(raw, spec), spec.key, policy)


def _helpers(spec: TableSpec) -> list[str]:
    texts = [text_name(f.name) for f in spec.schema]
    return [COUNT, *(parsed_name(c) for c in spec.dates), *texts]


def valid_rows(judged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break no rule, with real dates and the time of ingestion."""
    changes = {c: F.col(parsed_name(c)) for c in spec.dates}
    changes |= {c: F.upper(c) for c in spec.upper}
    changes["ingestion_timestamp"] = F.current_timestamp()
    return (
        judged.where(~any_broken(spec.rules))
        .withColumns(changes)
        .drop("source_file", *_helpers(spec))
    )


def rejected_rows(judged: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break a rule, with every reason and the time.

    Numbers that came as text are the text that came.
    """
    came = [c for c in spec.schema.fieldNames() if text_name(c) in judged.columns]
    return (
        with_reasons(judged.where(any_broken(spec.rules)), spec.rules)
        .withColumns({c: F.col(text_name(c)) for c in came})
        .withColumn("rejected_timestamp", F.current_timestamp())
        .drop(*_helpers(spec))
    )


def split(
    raw: DataFrame, spec: TableSpec, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[DataFrame, DataFrame]:
    """The whole cleaning of one table: ``(valid, rejected)``."""
    judged = judge(raw, spec, policy)
    return valid_rows(judged, spec), rejected_rows(judged, spec)


def reject_summary(rejected: DataFrame) -> DataFrame:
    """Rejected rows per combination of reasons."""
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))
