"""What was written to the zones, as a small table per run of the pipeline.

A run writes its tables into folders of their own. Its record comes last and names them, so readers go from the
tables of one run to those of the next at once, and a run that fails changes nothing for them. The
record also keeps what the write saw: rows of each table, and how many lines or shipments an order has at most.

One run at a time may write under a base path. Folders of the run before stay, for readers that began with them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from orderlake.sources.work import file_system, subfolders

RECORDS = "_records"
SCHEMA = (
    "zone string, table_name string, folder string, rows long, partition_by array<string>, "
    "buckets int, bucket_by string, most_per_order long, columns string"
)


@dataclass(frozen=True)
class Written:
    """A table of a zone. ``folder`` is seen from the base path; a raw table is counted only and has none."""

    zone: str
    table_name: str
    folder: str | None
    rows: int
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: str | None = None
    most_per_order: int | None = None
    # Names and types as DDL, for tables without a row too.
    columns: str | None = None


Record = dict[tuple[str, str], Written]

_known: dict[tuple, Record] = {}
_lock = threading.Lock()


def new_run() -> str:
    return f"run-{uuid.uuid4().hex[:12]}"


def _numbers(spark: SparkSession, base: str) -> list[str]:
    files, path = file_system(spark, f"{base.rstrip('/')}/{RECORDS}")
    return [n for n in subfolders(spark, str(path.toString())) if n.isdigit()] if files.exists(path) else []


def _read(spark: SparkSession, base: str, number: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(f"{base.rstrip('/')}/{RECORDS}/{number}")


def record(spark: SparkSession, base: str) -> DataFrame:
    """The last record as a table. Without any it is empty."""
    numbers = _numbers(spark, base)
    return _read(spark, base, numbers[-1]) if numbers else spark.createDataFrame([], SCHEMA)


def _entries(spark: SparkSession, base: str, number: str) -> Record:
    files, path = file_system(spark, f"{base.rstrip('/')}/{RECORDS}/{number}")
    # A record never changes; one that was deleted and made anew has another age.
    key = (base, number, files.getFileStatus(path).getModificationTime())
    with _lock:
        if key not in _known:
            rows = (row.asDict() for row in _read(spark, base, number).collect())
            made = [Written(**row | {"partition_by": tuple(row["partition_by"] or ())}) for row in rows]
            _known[key] = {(w.zone, w.table_name): w for w in made}
        return _known[key]


def last_record(spark: SparkSession, base: str) -> Record:
    """What the last run left, by zone and table."""
    numbers = _numbers(spark, base)
    return _entries(spark, base, numbers[-1]) if numbers else {}


def commit(spark: SparkSession, base: str, tables: Iterable[Written]) -> None:
    """Make the tables of a run the current ones, all at once; others stay as they are."""
    base = base.rstrip("/")
    numbers = _numbers(spark, base)
    now = dict(last_record(spark, base)) | {(w.zone, w.table_name): w for w in tables}
    number = f"{int(numbers[-1]) + 1 if numbers else 1:08}"
    aside = f"{base}/{RECORDS}/.{uuid.uuid4().hex}"
    rows = [asdict(w) | {"partition_by": list(w.partition_by)} for w in now.values()]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(aside)
    files, written = file_system(spark, aside)
    _, place = file_system(spark, f"{base}/{RECORDS}/{number}")
    if files.exists(place) or not files.rename(written, place):
        raise RuntimeError(f"another run has written record {number} under {base}")


def unused_folders(spark: SparkSession, base: str) -> list[str]:
    """Folders of runs that neither of the last two records names."""
    base = base.rstrip("/")
    numbers = _numbers(spark, base)
    recent = [_entries(spark, base, n) for n in numbers[-2:]]
    named = {w.folder for entries in recent for w in entries.values()}
    # A record carries on what it does not replace, so the last one names every table.
    places = {tuple(w.folder.split("/")[:2]) for entries in recent for w in entries.values() if w.folder}
    found = []
    for zone, table in sorted(places):
        runs = [n for n in subfolders(spark, f"{base}/{zone}/{table}") if n.startswith("run-")]
        found += [f"{zone}/{table}/{run}" for run in runs if f"{zone}/{table}/{run}" not in named]
    return found
