"""Gates and data-quality reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fogline.operators.keys import selective_first


class QualityError(ValueError):
    """A gate refused the data."""


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{context}: missing columns {missing}")


def require_rows(df: DataFrame, context: str) -> None:
    if df.isEmpty():
        raise QualityError(f"{context}: no rows")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row; NULL key values count as equal."""
    require_columns(df, keys, "key check")
    return df.groupBy(*selective_first(keys)).agg(F.count("*").alias("key_count")).select(*keys, "key_count").where(F.col("key_count") > 1)


def key_audit(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Rows and duplicate key groups per value of ``by`` (one of the keys)."""
    require_columns(df, [*keys, by], "key audit")
    per_key = df.groupBy(*selective_first(list(dict.fromkeys([by, *keys])))).agg(F.count("*").alias("key_count"))
    return per_key.groupBy(by).agg(
        F.sum("key_count").alias("row_count"),
        F.count_if(F.col("key_count") > 1).alias("duplicate_key_group_count"),
    )


def require_unique(df: DataFrame, keys: Sequence[str], context: str) -> None:
    groups = duplicate_keys(df, keys).count()
    if groups:
        raise QualityError(f"{context}: {groups} duplicate key group(s) on {list(keys)}")


def require_no_decode_errors(df: DataFrame, context: str, error: str = "error") -> None:
    """One unreadable file rejects the whole day."""
    failed = df.where(F.col(error).isNotNull()).agg(
        F.count_distinct("blob_name").alias("n"), F.min("blob_name").alias("example")
    ).first()
    if failed["n"]:
        raise QualityError(f"{context}: {failed['n']} file(s) failed to decode, e.g. {failed['example']}")


def require_complete_snapshot(df: DataFrame, id_col: str, expected_total: int | None = None) -> int:
    """A non-empty snapshot whose ids are all present and distinct; returns the id count.

    Anything else must not be used to infer that listings have gone.
    """
    counts = df.agg(F.count("*").alias("rows"), F.count_distinct(id_col).alias("ids")).first()
    if not counts["rows"]:
        raise QualityError("snapshot is empty")
    if counts["rows"] != counts["ids"]:
        raise QualityError(f"snapshot has {counts['rows']} rows but {counts['ids']} distinct ids")
    if expected_total is not None and counts["rows"] != expected_total:
        raise QualityError(f"snapshot has {counts['rows']} rows, expected {expected_total}")
    return counts["ids"]


def require_monotonic(snapshot: dt.date, previous: dt.date) -> bool:
    """False on a same-day retry, True when the snapshot moves on, an error when it goes back."""
    if snapshot < previous:
        raise QualityError(f"snapshot {snapshot} is earlier than the last successful one {previous}")
    return snapshot > previous


def split_missing_identity(df: DataFrame, required: Sequence[str]) -> tuple[Column, DataFrame]:
    """(is_complete condition, one-row count of kept and rejected rows)."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    counts = df.agg(
        F.count("*").alias("rows_read"),
        F.count_if(complete).alias("rows_kept"),
        F.count_if(~complete).alias("rows_skipped_missing_identity"),
    )
    return complete, counts


def observe_counts(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count rows and conditions while the returned frame is written, without a second pass."""
    observation = Observation(name)
    counts = [F.count_if(condition).alias(label) for label, condition in conditions.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


@dataclass(frozen=True)
class Rules:
    """Declarative checks on one table. Names listed in ``warn`` do not fail the run."""

    model: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combination: Sequence[Sequence[str]] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    violations: dict[str, Column] = field(default_factory=dict)
    warn: Sequence[str] = ()


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per check: model, check_name, severity, failures, passed.

    Row-level checks share one pass; each key check is one grouped count.
    """
    conditions: dict[str, Column] = {f"not_null({c})": F.col(c).isNull() for c in rules.not_null}
    for name, values in rules.accepted.items():
        conditions[f"accepted_values({name})"] = F.col(name).isNotNull() & ~F.col(name).isin(*values)
    conditions.update(rules.violations)

    parts: list[DataFrame] = []
    if conditions:
        labels = list(conditions)
        counted = df.agg(*[F.count_if(conditions[n]).alias(f"c{i}") for i, n in enumerate(labels)])
        pairs = F.array(
            *[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(labels)]
        )
        parts.append(counted.select(F.inline(pairs)))
    for keys in [[c] for c in rules.unique] + [list(k) for k in rules.unique_combination]:
        label = f"unique({', '.join(keys)})"
        # NULL values never collide with each other in a uniqueness test.
        present = df.dropna(subset=keys) if len(keys) == 1 else df
        parts.append(
            present.groupBy(*keys)
            .count()
            .agg(F.count_if(F.col("count") > 1).alias("failures"))
            .select(F.lit(label).alias("check_name"), "failures")
        )
    if not parts:
        raise ValueError(f"no checks for {rules.model}")
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        F.lit(rules.model).alias("model"),
        "check_name",
        F.when(F.col("check_name").isin(*rules.warn), F.lit("warn")).otherwise(F.lit("error")).alias("severity")
        if rules.warn
        else F.lit("error").alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def require_passed(report: DataFrame) -> None:
    failed = report.where(~F.col("passed") & (F.col("severity") == "error")).collect()
    if failed:
        raise QualityError("; ".join(f"{r['model']}.{r['check_name']}: {r['failures']}" for r in failed))
