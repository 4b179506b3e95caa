"""Tables between stages, run exports, and the warehouse table kept by load id."""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHARED_COLUMNS = {
    "Load_ID": "load_id",
    "Publication_status": "publication_status",
    "Sector": "sector",
    "Ticket category": "ticket_category",
    "Year & stats": "label",
}
# Column names of the published series tables, which differ by series.
SERIES_COLUMNS = {
    "ticket_category": _SHARED_COLUMNS
    | {"ordering value of ticket category": "category_order", "ordering of year & stats": "label_order"},
    "ticket_type": _SHARED_COLUMNS
    | {"ordering values of ticket category": "category_order", "ordering value of year and stats": "label_order"},
}


# Columns of the usage views.
USAGE_VIEW = {
    "financial_year_key": "int", "year_and_quarter": "string", "Long-distance": "double", "London and South East": "double",
    "Regional": "double", "Non-franchised": "double", "source_item_id": "int", "publication_status": "string",
}


def plain_series(df: DataFrame, kind: str) -> DataFrame:
    """A series table with plain column names; a table that has them already is left as it is."""
    return df.withColumnsRenamed(SERIES_COLUMNS[kind])


def is_published(df: DataFrame, kind: str) -> bool:
    """True if the table has its published column names."""
    return any(name in df.columns for name in SERIES_COLUMNS[kind])


def published_series(df: DataFrame, kind: str) -> DataFrame:
    """A series table with its published column names."""
    return df.withColumnsRenamed({plain: name for name, plain in SERIES_COLUMNS[kind].items()})


def new_run_id(now: datetime | None = None) -> str:
    """An id that sorts by time; runs of the same second still differ."""
    return f"{(now or datetime.now()).strftime('%Y%m%d_%H-%M-%S')}_{uuid.uuid4().hex[:8]}"


def write_run(df: DataFrame, root: str, name: str, run_id: str, fmt: str = "parquet") -> DataFrame:
    """Write a result under its run id and return it as read back. A result that is there is not overwritten.

    What follows reads the written table, so nothing upstream is computed again, also not after
    executors are lost.
    """
    path = f"{root}/{name}/run_id={run_id}"
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    reader = df.sparkSession.read.schema(df.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def _latest(spark: SparkSession, path: str) -> str:
    """The last run id below a path. Ids are text, so they come from file names, not from typed partitions."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    latest = files.select(F.regexp_extract("path", "/run_id=([^/]+)/", 1).alias("run_id")).where("run_id <> ''").agg(F.max("run_id")).first()[0]
    if latest is None:
        raise ValueError(f"no run in {path}")
    return latest


def read_run(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """A result of a given run, by default of the latest. A run that does not exist is an error."""
    run_id = _latest(spark, f"{root}/{name}") if run_id is None else run_id
    try:
        return spark.read.parquet(f"{root}/{name}/run_id={run_id}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"there is no run {run_id} of {name} in {root}") from e
        raise


COMPLETED = "completed"


def complete_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Record that all results of a run are written; the last thing a stage does."""
    write_run(spark.createDataFrame([(run_id,)], "run string"), root, COMPLETED, run_id)


def completed_run(spark: SparkSession, root: str, run_id: str | None = None) -> str:
    """The given run, or the latest, if it was completed. All results of a stage are read by this one id."""
    try:
        run_id = _latest(spark, f"{root}/{COMPLETED}") if run_id is None else run_id
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"no run was completed in {root}") from e
        raise
    return read_run(spark, root, COMPLETED, run_id).first().run


def max_load_id(table: DataFrame) -> DataFrame:
    """Latest load id as one row."""
    return table.agg(F.max("load_id").alias("load_id"))


def snapshot(table: DataFrame, load_id: int) -> DataFrame:
    """Rows of one load; on a table partitioned by load id only that partition is read."""
    return table.where(F.col("load_id") == load_id)


def latest_snapshot(table: DataFrame) -> DataFrame:
    return table.where(F.col("load_id") == max_load_id(table).scalar())


def newest_load(spark: SparkSession, path: str, load_column: str = "load_id") -> int | None:
    """Latest load id of a table partitioned by it, from the names of its files alone; None without a load."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ids = files.select(F.regexp_extract("path", f"/{load_column}=(-?[0-9]+)/", 1).alias("id")).where("id <> ''")
    return ids.agg(F.max(F.col("id").cast("int"))).first()[0]


CLAIM_SECONDS = 30.0


def _claims(spark: SparkSession, folder: str) -> tuple[set[str], set[str]]:
    """Claims below a folder, and those that were withdrawn."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rows = files.select(F.regexp_extract("path", "/(claim|withdrawn)=([0-9a-f]+)/", 1).alias("kind"), F.regexp_extract("path", "/(claim|withdrawn)=([0-9a-f]+)/", 2).alias("id")).distinct().collect()
    return tuple({r["id"] for r in rows if r["kind"] == kind} for kind in ("claim", "withdrawn"))


def claim(spark: SparkSession, folder: str, patience: float = CLAIM_SECONDS) -> bool:
    """True for at most one of all callers that ever claim `folder`, whatever their timing.

    Only written files are needed, no locks: a caller first writes its claim and then looks. One who sees no other claim wins, as
    whoever comes later sees this one. Callers who see each other agree by their random ids: the larger ones
    withdraw in writing, and the least wins as soon as all others have. A caller who died between
    claim and load blocks the folder; the others give up after `patience` seconds.
    """
    me = uuid.uuid4().hex
    note = spark.createDataFrame([(me,)], "id string").coalesce(1)
    note.write.parquet(f"{folder}/claim={me}")
    deadline = time.monotonic() + patience
    while True:
        claimed, withdrawn = _claims(spark, folder)
        others = claimed - withdrawn - {me}
        if not others:
            return True
        if me > min(others) or time.monotonic() > deadline:
            note.write.parquet(f"{folder}/withdrawn={me}")
            return False
        time.sleep(0.2)


def append_load(df: DataFrame, path: str, load_column: str = "load_id") -> None:
    """Append one load to the warehouse table, as the partition of its load id.

    A load id the table already holds is refused, and so is a load whose columns differ from the
    table's in name or type, as both would leave nulls in the one or the other. Of loaders that come at once
    with one load id, one `claim` wins and the others are refused, so a partition never has two loads in it.
    """
    spark = df.sparkSession
    load_ids = [row[0] for row in df.select(load_column).distinct().limit(2).collect()]
    if len(load_ids) != 1:
        raise ValueError(f"expected one load id, found {load_ids}")
    target = f"{path}/{load_column}={load_ids[0]}"
    try:
        existing = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    except AnalysisException as e:
        # An empty folder, or one with claims alone, has no schema to tell.
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        existing = None
    if existing is not None and existing != {f.name: f.dataType for f in df.schema}:
        raise ValueError(f"columns of the load, {df.schema.simpleString()}, differ from those of {path}: {existing}")
    if existing is not None and has_load(spark, target):
        raise ValueError(f"load {load_ids[0]} is already in {path}")
    if not claim(spark, f"{path}/_claims/{load_column}={load_ids[0]}"):
        raise ValueError(f"load {load_ids[0]} is being appended to {path} by another loader, or one that died left its claim in _claims")
    try:
        df.drop(load_column).write.mode("errorifexists").parquet(target)
    except AnalysisException as e:
        if e.getCondition() == "PATH_ALREADY_EXISTS":
            raise ValueError(f"load {load_ids[0]} is already in {path}") from e
        raise


def has_load(spark: SparkSession, target: str) -> bool:
    """True if a partition folder is there."""
    try:
        spark.read.format("binaryFile").load(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_usage(spark: SparkSession, source: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """A usage view with the columns the rollup needs, from Parquet or over JDBC; a missing one is an error."""
    view = read_warehouse(spark, source, jdbc)
    return view.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in USAGE_VIEW.items()])


def read_warehouse(spark: SparkSession, source: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """The warehouse table from Parquet, or over JDBC where connection options are given."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=source, **jdbc).load()
    return spark.read.parquet(source)
