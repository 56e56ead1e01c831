"""The zones of the lake: raw CSV in, processed, rejected and curated Parquet out.

A zone is a directory under a base path with one directory per table. The pipeline writes each run into a folder below
that, and the record of the run tells which one is current; a table without a record is read as it lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.schemas import ORDER_ANALYTICS, RAW, TABLES
from orderlake.sources.records import Written, last_record
from orderlake.sources.work import observed, remove_work_folder, subfolders

RAW_ZONE = "raw"
PROCESSED = "processed"
REJECTED = "rejected"
CURATED = "curated"
CURATED_TABLE = "order_analytics"
ROLLUP_TABLE = "order_rollup"
# Rows per order of the lines and shipments, where an order has more than one.
COUNTS = "counts"
# Columns that folders are named by and that are no part of the table.
DERIVED = {"order_month": T.DateType()}
# The catalog's entries for tables in buckets; Spark knows buckets from the catalog only.
BUCKETED = "orderlake_buckets"
BAD_LINE = "_bad_line"
# Lines with another number of fields than the header, as the scan of a run met them.
BAD_LINES = "bad_lines"
# Columns with about as many values as rows or orders: Parquet would list their values first and give that up later.
UNLISTED = (
    "order_id", "order_item_id", "shipment_id", "inventory_id", "customer_id", "customer_name", "product_id", "product_name",
    "line_revenue", "unit_price",
)
# Ending of the view of a raw table with typed numbers.
TYPED = "_typed"


def zone_path(base: str, zone: str, table: str) -> str:
    return f"{base.rstrip('/')}/{zone}/{table}"


def raw_header(spark: SparkSession, path: str, table: str) -> list[str]:
    """The column names of the files. Values are never sampled."""
    header = [name.lower() for name in spark.read.option("header", True).csv(path).columns]
    absent = [f.name for f in RAW[table] if f.name not in header]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)} in the header")
    return header


def raw_schema(spark: SparkSession, path: str, table: str) -> T.StructType:
    """Declared types in the column order of the files; extra columns pass as text."""
    declared = {f.name: f.dataType for f in RAW[table]}
    return T.StructType(
        [
            T.StructField(name, declared.get(name, T.StringType()))
            for name in raw_header(spark, path, table)
        ]
    )


def _scan(spark: SparkSession, base: str, table: str, whole_lines: bool = False) -> DataFrame:
    path = zone_path(base, RAW_ZONE, table)
    names = [*raw_header(spark, path, table), BAD_LINE]
    return (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", BAD_LINE)
        # A scan of few columns does not see how many fields a line has.
        .option("columnPruning", not whole_lines)
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_raw(spark: SparkSession, base: str, table: str, lines: bool = False) -> DataFrame:
    """Raw rows of one table, all text, with the file each came from.

    A file whose header differs from the others' is an error: its values would
    otherwise land under wrong names. Lines with too few or too many fields are rows here, and
    ``bad_lines`` shows them as they are. With ``lines`` such a row carries its line in ``_bad_line``, so that one scan
    gives both; the pipeline reads in this way.
    """
    return _scan(spark, base, table, True) if lines else _scan(spark, base, table).drop(BAD_LINE)


def bad_lines(spark: SparkSession, base: str, table: str) -> DataFrame:
    """``(source_file, <key>, line)`` of lines with another number of fields than the header."""
    # A plain null check would be pushed into the scan, which fills the column after it.
    found = _scan(spark, base, table, True).where(F.coalesce(BAD_LINE, F.lit("")) != "")
    return _lines(found, table)


def _lines(found: DataFrame, table: str) -> DataFrame:
    return found.select("source_file", RAW[table][0].name, F.col(BAD_LINE).alias("line"))


def bad_lines_of(rows: DataFrame, table: str) -> DataFrame:
    """The same from written rows that carry their line."""
    return _lines(rows.where(F.col(BAD_LINE).isNotNull()), table)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that the folders of a written table are named by."""
    found: list[str] = []
    while named := [f for f in subfolders(spark, path) if "=" in f and f[0] not in "._"]:
        found.append(named[0].split("=")[0])
        path = f"{path}/{named[0]}"
    return found


def _declared(zone: str, table: str) -> dict[str, T.DataType]:
    if zone == CURATED:
        return {f.name: f.dataType for f in ORDER_ANALYTICS} if table == CURATED_TABLE else {}
    return {f.name: f.dataType for f in RAW.get(table, ())}


def current(spark: SparkSession, base: str, zone: str, table: str) -> Written | None:
    """What the record of the last run says about a table."""
    return last_record(spark, base).get((zone, table))


def current_path(spark: SparkSession, base: str, zone: str, table: str) -> str:
    """Where the rows of a table lie now."""
    entry = current(spark, base, zone, table)
    return zone_path(base, zone, table) if entry is None else f"{base.rstrip('/')}/{entry.folder}"


def read_zone(
    spark: SparkSession, base: str, zone: str, table: str, derived: bool = False
) -> DataFrame:
    """A written table. Columns that its folders are named by have their declared types and places.

    Columns made for the folders only are left out unless ``derived`` asks for them, for filters that skip folders.
    """
    return read_written(spark, base, zone, table, current(spark, base, zone, table), derived)


def read_written(
    spark: SparkSession, base: str, zone: str, table: str, entry: Written | None, derived: bool = False
) -> DataFrame:
    """The same for a table that a run has written, whether or not its record is there yet."""
    path = zone_path(base, zone, table) if entry is None else f"{base.rstrip('/')}/{entry.folder}"
    if entry is not None and entry.buckets:
        return spark.table(_bucketed_table(spark, base, path, entry))
    by = partition_columns(spark, path) if entry is None else entry.partition_by
    if entry is not None:
        df = _listed(spark, path, entry)
    elif not by:
        return spark.read.parquet(path)
    else:
        df = spark.read.schema(_declared_partitions(spark, path, zone, table, by)).parquet(path)
    declared = _declared(zone, table) if by else {}
    order = [name for name in declared if name in df.columns]
    shown = df.select(*order, *(c for c in df.columns if c not in order))
    return shown if derived else shown.drop(*(c for c in by if c in DERIVED and c not in declared))


_frames: dict[tuple, DataFrame] = {}


def _listed(spark: SparkSession, path: str, entry: Written) -> DataFrame:
    """The files of a run's table. They never change, so those in many folders are listed once per session."""
    if not entry.partition_by:
        return spark.read.schema(entry.columns).parquet(path)
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _frames:
        _frames[key] = spark.read.schema(entry.columns).parquet(path)
    return _frames[key]


def _declared_partitions(
    spark: SparkSession, path: str, zone: str, table: str, by: Sequence[str]
) -> T.StructType:
    """The schema of a table whose folders' names do not tell their types."""
    kinds = DERIVED | _declared(zone, table)
    found = spark.read.parquet(path).schema
    return T.StructType(
        [T.StructField(f.name, kinds.get(f.name, f.dataType) if f.name in by else f.dataType) for f in found]
    )


def _bucket_name(path: str) -> str:
    return f"`{BUCKETED}`.`t_{hashlib.md5(path.encode()).hexdigest()}`"


def _bucket_database(spark: SparkSession, base: str) -> None:
    """The database of such entries. Its tables lie elsewhere, and its folder is not in the session's warehouse."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{BUCKETED}` LOCATION '{base.rstrip('/')}/_buckets'")


def _bucketed_table(spark: SparkSession, base: str, path: str, entry: Written) -> str:
    """The catalog's entry for a table in buckets, made where this session's catalog has none."""
    name = _bucket_name(path)
    if not spark.catalog.tableExists(name):
        _bucket_database(spark, base)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({entry.columns}) USING parquet {_clustered(entry)} LOCATION '{path}'"
        )
    return name


def _clustered(entry: Written) -> str:
    return f"CLUSTERED BY (`{entry.bucket_by}`) INTO {entry.buckets} BUCKETS"


def write_zone(
    df: DataFrame, base: str, zone: str, table: str, partition_by: Sequence[str] = ()
) -> None:
    """Write a table in place, without a record."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(zone_path(base, zone, table))


def write_run(
    df: DataFrame,
    base: str,
    zone: str,
    table: str,
    run: str,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: str | None = None,
    most_per_order: int | None = None,
) -> Written:
    """Write a table into the folder of a run and count its rows on the way.

    With ``buckets`` rows lie in so many files by ``bucket_by``, so that tables with as many buckets are joined on it,
    or grouped by it, without a shuffle.
    """
    folder = f"{zone}/{table}/{run}"
    path = f"{base.rstrip('/')}/{folder}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    unlisted = [name for name in UNLISTED if name in df.columns and name not in partition_by]
    packed = {"compression": "zstd"} | {f"parquet.enable.dictionary#{name}": "false" for name in unlisted}
    if buckets:
        name = _bucket_name(path)
        _bucket_database(df.sparkSession, base)
        # A task has one bucket. Sorted by the write it would be compared by bucket first, which tells no rows apart.
        dealt = counted.repartition(buckets, bucket_by).sortWithinPartitions(bucket_by).write.options(**packed)
        dealt.bucketBy(buckets, bucket_by).format("parquet").option("path", path).saveAsTable(name)
    elif partition_by:
        counted.write.options(**packed).partitionBy(*partition_by).parquet(path)
    else:
        counted.write.options(**packed).parquet(path)
    by = bucket_by if buckets else None
    columns = df._jdf.schema().toDDL()
    return Written(
        zone, table, folder, observed(seen, {"rows": 0})["rows"], tuple(partition_by), buckets, by, most_per_order, columns
    )


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# The months that a task may keep a file open for; with more of them it sorts the rest of its rows.
OPEN_FILES = 16


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes into folders by value keep a file per value open. Else a task sorts its rows first, and spills them."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, max(int(before), OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def remove_run_folders(spark: SparkSession, base: str, folders: Sequence[str]) -> None:
    """Delete folders of runs with what the catalog knows of them."""
    for folder in folders:
        path = f"{base.rstrip('/')}/{folder}"
        if spark.catalog.tableExists(_bucket_name(path)):
            spark.sql(f"DROP TABLE {_bucket_name(path)}")
        remove_work_folder(spark, path)


def register_views(spark: SparkSession, base: str) -> None:
    """Temp views ``raw_*``, ``processed_*``, ``rejected_*`` and ``order_analytics``."""
    for table in TABLES:
        read_raw(spark, base, table).createOrReplaceTempView(f"{RAW_ZONE}_{table}")
        for zone in (PROCESSED, REJECTED):
            read_zone(spark, base, zone, table).createOrReplaceTempView(f"{zone}_{table}")
    read_zone(spark, base, CURATED, CURATED_TABLE).createOrReplaceTempView(CURATED_TABLE)


def _free(spark: SparkSession, name: str, path: str) -> None:
    """Drop a table that was registered here before, for this or an earlier run; refuse to touch any other."""
    if not spark.catalog.tableExists(name):
        return
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    there, here = (p.split(":", 1)[-1].strip("/") for p in (told.get("Location", ""), path))
    if told.get("Type") != "EXTERNAL" or not f"{there}/".startswith(f"{here}/"):
        raise ValueError(f"{name} exists and is not an external table over {path}")
    spark.sql(f"DROP TABLE {name}")


def _typed_sql(column: str, kind: T.DataType) -> str:
    """A column of text as SQL that gives its declared type, as the cleaning does."""
    if isinstance(kind, T.StringType):
        return f"`{column}`"
    if not isinstance(kind, T.IntegralType):
        return f"try_cast(`{column}` AS {kind.simpleString()}) AS `{column}`"
    exact = f"try_cast(`{column}` AS decimal(38, 6))"
    return f"CASE WHEN {exact} = floor({exact}) THEN try_cast({exact} AS {kind.simpleString()}) END AS `{column}`"


def _register_raw(spark: SparkSession, base: str, database: str, table: str) -> None:
    """The raw rows as they are, all text, and a view of them with typed numbers beside it."""
    name, path = f"`{database}`.`{table}`", zone_path(base, RAW_ZONE, table)
    _free(spark, name, path)
    kinds = raw_schema(spark, path, table)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in kinds])
    spark.catalog.createTable(name, path, "csv", text, header="true", enforceSchema="false")
    typed = ", ".join(_typed_sql(f.name, f.dataType) for f in kinds)
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}{TYPED}` AS SELECT {typed} FROM {name}")


def register_tables(spark: SparkSession, base: str, databases: dict[str, str]) -> None:
    """Catalog tables over the zones, so that database-qualified SQL text runs as it is.

    ``databases`` maps a zone to the name of its database; zones left out are
    not registered. The tables are external: dropping them keeps the files. A table of the same name that
    lies elsewhere is an error. Tables show the run that is current now; register them anew after the next. A raw table
    has text only, like ``read_raw``, and its numbers are typed in ``<table>_typed``.
    """
    for zone, database in databases.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for table in (CURATED_TABLE,) if zone == CURATED else TABLES:
            if zone == RAW_ZONE:
                _register_raw(spark, base, database, table)
                continue
            name = f"`{database}`.`{table}`"
            _free(spark, name, zone_path(base, zone, table))
            entry, path = current(spark, base, zone, table), current_path(spark, base, zone, table)
            by = partition_columns(spark, path) if entry is None else entry.partition_by
            columns = read_zone(spark, base, zone, table, derived=True)._jdf.schema().toDDL()
            parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
            if entry is not None and entry.buckets:
                parts = _clustered(entry)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
            if by:
                spark.catalog.recoverPartitions(name)
