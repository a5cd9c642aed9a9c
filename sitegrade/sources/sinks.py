"""Layer tables, dated exports and the serving database."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sitegrade import fixed_values as fixed

# Serving tables and their typed columns.
SERVING_TABLES: dict[str, str] = {
    "mart_rat_inspection": fixed.MART_RAT_DDL,
    "mart_rat_risk_model": fixed.RISK_MODEL_DDL,
    "mart_restaurant_inspection": fixed.MART_RESTAURANT_DDL,
}


def serving_schema(table: str) -> T.StructType:
    """Needs a running session, which parses the column list."""
    return T.StructType.fromDDL(SERVING_TABLES[table])


VERSION = "version-"


@dataclass(frozen=True)
class TableStore:
    """Layer tables as parquet folders below ``{root}/{layer}/{table}`` on shared storage.

    Each :meth:`save` writes a version folder of its own; Spark marks it when the
    write is complete, and readers take the newest marked one.  So a write that
    fails leaves the table as it was, and one that succeeds disturbs no reader:
    the version before it stays until the next is written.  A table has one
    writer at a time.
    """

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def save(self, df: DataFrame, layer: str, table: str, folders: str | None = None, spread: Sequence[str] = ()) -> DataFrame:
        """Replace the table and return a scan of it; ``df`` may itself read the table.

        The scan has no lineage behind it, so a lost executor costs a re-read
        and not a re-run, and its file sizes tell Spark which joins may
        broadcast.  With ``folders``, each value of that column has a folder of
        its own, which a filter on the column leaves out whole; a large one is
        dealt to several tasks by ranges of the ``spread`` columns.
        """
        if folders:
            df = df.repartitionByRange(folders, *spread)
        spark, base = df.sparkSession, self.path(layer, table)
        versions = _children(spark, base)
        number = max([0, *(int(v.removeprefix(VERSION)) for v in versions if v.startswith(VERSION))]) + 1
        fresh = f"{base}/{VERSION}{number:08d}"
        writer = df.write.mode("error")
        (writer.partitionBy(folders) if folders else writer).parquet(fresh)
        kept = _complete(spark, base, versions)[-1:]
        for old in versions:
            if old.startswith(VERSION) and old not in kept:
                _remove(spark, f"{base}/{old}")
        return spark.read.schema(df.schema).parquet(fresh)

    def read(
        self, spark: SparkSession, layer: str, table: str, schema: T.StructType | None = None
    ) -> DataFrame:
        """The newest complete version."""
        base = self.path(layer, table)
        versions = _complete(spark, base, _children(spark, base))
        if not versions:
            raise FileNotFoundError(f"no complete table in {base}")
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(f"{base}/{versions[-1]}")

    def save_folders(self, df: DataFrame, layer: str, table: str, column: str, touched: Collection[dt.date | None], lies_in_folders: bool = False) -> None:
        """Replace the ``touched`` folders of a table that has one for each value of ``column``; all rows of ``df`` belong to them.

        Folders that get no row go.  Others are neither read nor written.  ``df``
        may read the table itself: Spark moves the new files in when all are
        written.  A folder's rows meet in one task, or in several if they are many.
        Rows of which ``lies_in_folders`` says that they come from the files of
        another table with these folders are written as they are read, without a
        shuffle: that makes about as many files as they come from.
        """
        spark, base = df.sparkSession, self.path(layer, table)
        names = [f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for value in touched]
        before = {name: _children(spark, f"{base}/{name}") for name in names}
        writer = (df if lies_in_folders else df.hint("rebalance", column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(base)
        for name, files in before.items():
            if files and _children(spark, f"{base}/{name}") == files:  # the names of new files are new
                _remove(spark, f"{base}/{name}")

    def read_folders(self, spark: SparkSession, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """A table of :meth:`save_folders`; without rows where there is none yet."""
        base = self.path(layer, table)
        return spark.read.schema(schema).parquet(base) if _children(spark, base) else spark.createDataFrame([], schema)

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        base = self.path(layer, table)
        return bool(_complete(spark, base, _children(spark, base)))


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, so that any store that Spark writes to will do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[str]:
    files, where = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(where)) if files.exists(where) else []


def _complete(spark: SparkSession, base: str, versions: Sequence[str]) -> list[str]:
    marks = {v: _file_system(spark, f"{base}/{v}/_SUCCESS") for v in versions if v.startswith(VERSION)}
    return sorted(v for v, (files, mark) in marks.items() if files.exists(mark))


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def export_path(root: str, warehouse: str, schema: str, date: str, table: str) -> str:
    return f"{root.rstrip('/')}/{warehouse}/{schema}/{date}/{table}.parquet"


def export_mart(df: DataFrame, path: str) -> None:
    """Write a mart to a dated parquet dataset."""
    df.write.mode("overwrite").parquet(path)


def export_marts(marts: Mapping[str, DataFrame], root: str, warehouse: str, schema: str, date: str) -> dict[str, str]:
    """Export every serving table; says where each lies."""
    paths = {table: export_path(root, warehouse, schema, date, table) for table in SERVING_TABLES}
    for table, path in paths.items():
        export_mart(marts[table], path)
    return paths


def serving_clean(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL and zoned timestamps lose their zone."""
    def cleaned(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = F.nullif(col, F.lit(""))
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        return col.alias(field.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def serving_cast(df: DataFrame, table: str) -> DataFrame:
    """A serving table's columns in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in serving_schema(table).fields])


def jdbc_options(url: str, table: str, schema: str = "public", connections: int = 16) -> dict[str, str]:
    """Truncate and reload in batches; an existing table keeps its definition.

    A missing table is created with the database's default types for the serving
    schema's columns.  Every task writes its own partition; ``connections``
    bounds how many do so at once.
    """
    return {
        "url": url,
        "dbtable": f"{schema}.{table}",
        "truncate": "true",
        "batchsize": str(fixed.SERVING_BATCH_ROWS),
        "numPartitions": str(connections),
    }


def write_serving(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, **where) -> None:
    """Clean, cast and load one mart; credentials go into ``properties``."""
    ready = serving_cast(serving_clean(df), table)
    options = {**jdbc_options(url, table, **where), **(properties or {})}
    ready.write.format("jdbc").mode("overwrite").options(**options).save()


class LoadFailed(RuntimeError):
    """Some serving tables were not loaded; ``outcome`` says what became of each."""

    def __init__(self, outcome: Mapping[str, str]):
        super().__init__(", ".join(f"{table}: {what}" for table, what in outcome.items() if what != "loaded"))
        self.outcome = dict(outcome)


def load_marts(
    marts: Mapping[str, DataFrame], write: Callable[[DataFrame, str], None]
) -> dict[str, str]:
    """Load all serving tables; one bad table does not keep the others from loading.

    Raises :class:`LoadFailed` at the end unless every table is ``loaded``.
    """
    outcome, cause = {}, None
    for table in SERVING_TABLES:
        if table not in marts:
            outcome[table] = "missing"
            continue
        try:
            write(marts[table], table)
            outcome[table] = "loaded"
        except Exception as error:
            outcome[table], cause = f"failed: {error}", error
    if set(outcome.values()) != {"loaded"}:
        raise LoadFailed(outcome) from cause
    return outcome
