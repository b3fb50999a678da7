"""Query registry: a Spark callable and, where SQL can say it, the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workload.standins import STANDINS, DuckDialect, Tables, comparable
from workload.sqlviews import VIEWS


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return register


#: Ordinary settings of the queries' jobs. A view's row is some twenty times as wide as the columns it is made of in the files, so
#: a split of the usual 128 MB gives a task millions of wide rows to sort; and the number of pieces must follow the data.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def callable_for(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Instants are built from zone-less columns, which must read as UTC everywhere.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        return comparable(REGISTRY[name].run(Tables(spark, sf_dir)))

    run.__name__ = name
    return run


def _definition(view: str) -> str:
    if view in STANDINS:
        return re.sub(r"\{(\w+)\}", r"\1", STANDINS[view](DuckDialect()))
    return VIEWS[view]


def _uses(text: str) -> list[str]:
    known = [*STANDINS, *VIEWS]
    return [v for v in known if re.search(rf"\b{v}\b", text)]


def oracle_text(body: str) -> str:
    """Prefix the view definitions a statement needs, dependencies first."""
    ordered: list[str] = []

    def visit(view: str) -> None:
        if view in ordered:
            return
        for other in _uses(_definition(view)):
            if other != view:
                visit(other)
        ordered.append(view)

    for view in _uses(body):
        visit(view)
    body = body.strip()
    if not ordered:
        return body
    views = ",\n".join(f"{v} AS ({_definition(v).strip()})" for v in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
