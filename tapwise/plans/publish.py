"""A published table of many periods: a view over one immutable table for each.

A period is written once and never again: publishing another one neither reads nor writes it. The view takes
the periods' rows as one set. Each period is a set by itself, so only rows whose ride start lies in several
periods' spans, which are kept with the tables, are compared when the view is read.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tapwise.operators.periods import Span, shared_rows, spans_of
from tapwise.schema import OUTPUT_COLUMNS

# Properties of our tables and views.
MEMBERS, OWNER = "tapwise.members", "tapwise.publication"


@dataclass(frozen=True)
class Member:
    """A period's table, and the span of its rows."""

    table: str
    span: Span


def members(spark: SparkSession, target: str) -> dict[str, Member]:
    """The periods that the view `target` is made of; none if it is not there or none of ours."""
    if not spark.catalog.tableExists(target):
        return {}
    found = _properties(spark, target).get(MEMBERS)

    def instant(text: str | None) -> datetime | None:
        return None if text is None else datetime.fromisoformat(text)

    return {
        period: Member(m["table"], Span(instant(m["first"]), instant(m["last"]), m["timeless"]))
        for period, m in json.loads(found or "{}").items()
    }


def publish_period(rows: DataFrame, target: str, period: str, folder: str | None = None) -> DataFrame:
    """Writes `rows` as the period's table, and switches the view `target` to it when it is complete.

    Readers always find a whole table; a failed run changes nothing and leaves no files. The
    period's version before is kept for readers still on it; older ones go, with their files. The other
    periods are left alone. Tables go under `folder`, which must be shared storage, or else to the warehouse.

    The table is placed by card and sorted by time, so that readers of some cards or days skip the other files.
    Equal rows lie together then: taking each once costs no shuffle of its own.
    """
    if not re.fullmatch(r"[a-z0-9]+(_[a-z0-9]+)*", period):
        raise ValueError(f"a period's name is made of small letters, digits and single underscores, not {period!r}")
    spark = rows.sparkSession
    stamp = f"{datetime.now(UTC):%Y%m%d%H%M%S%f}"
    version = f"{target}__{period}__{stamp}_{uuid.uuid4().hex[:8]}"
    place = None if folder is None else f"{folder.rstrip('/')}/{version.rpartition('.')[2]}"
    keys = ("card_id", "ride_start_time")
    placed = rows.toDF(*OUTPUT_COLUMNS).repartitionByRange(*keys).distinct().sortWithinPartitions(*keys)
    try:
        writer = placed.write.format("parquet")
        if place is not None:
            writer = writer.option("path", place)
        writer.saveAsTable(version)
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{OWNER}' = '{target.lower()} {period}')")
        span = spans_of([spark.table(version)])[0]
        _switch(spark, target, members(spark, target) | {period: Member(version, span)})
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        if place is not None:
            _delete(spark, place)
        raise
    for old in [v for v in _versions(spark, target, period) if v.lower() != version.lower()][:-1]:
        _drop(spark, old)
    return spark.table(target)


def drop_publication(spark: SparkSession, target: str) -> None:
    """The view and all its periods' tables, with their files."""
    periods = members(spark, target)
    spark.sql(f"DROP VIEW IF EXISTS {target}")
    for period in periods:
        for version in _versions(spark, target, period):
            _drop(spark, version)


def _switch(spark: SparkSession, target: str, parts: dict[str, Member]) -> None:
    told = {
        period: {
            "table": m.table,
            "first": m.span.first and m.span.first.isoformat(),
            "last": m.span.last and m.span.last.isoformat(),
            "timeless": m.span.timeless,
        }
        for period, m in parts.items()
    }
    columns = ", ".join(OUTPUT_COLUMNS)
    shared = shared_rows([m.span for m in parts.values()])
    alone = "" if shared is None else f" WHERE NOT {shared}"
    selects = [f"SELECT {columns} FROM {m.table}{alone}" for m in parts.values()]
    if shared is not None:
        several = " UNION ALL ".join(f"SELECT {columns} FROM {m.table} WHERE {shared}" for m in parts.values())
        selects.append(f"SELECT DISTINCT {columns} FROM ({several})")
    spark.sql(
        f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ('{MEMBERS}' = '{json.dumps(told)}') AS {' UNION ALL '.join(selects)}"
    )


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _versions(spark: SparkSession, target: str, period: str) -> list[str]:
    """The tables that were written for this period of `target`, oldest first; no others."""
    database, _, name = target.rpartition(".")
    own = re.compile(rf"{re.escape(name.lower())}__{period}__\d{{20}}_[0-9a-f]{{8}}")
    prefix = f"{database}." if database else ""
    found = sorted(
        prefix + t.name
        for t in spark.catalog.listTables(database or None)
        if t.tableType != "VIEW" and own.fullmatch(t.name)
    )
    return [v for v in found if _properties(spark, v).get(OWNER) == f"{target.lower()} {period}"]


def _drop(spark: SparkSession, version: str) -> None:
    """The table, and its files, which the catalog leaves where it did not choose the place."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    if details and details["data_type"].rstrip("/").rpartition("/")[2] == version.rpartition(".")[2]:
        _delete(spark, details["data_type"])


def _delete(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
