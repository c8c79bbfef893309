"""Reading and writing tables: parquet, CSV, JDBC, SQL text, and the cache-through read."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, fmt: str, path: str | None = None, schema: StructType | str | None = None, **options) -> DataFrame:
    """Any Spark source. CSV defaults to a header line, and infers types only without a schema."""
    if fmt == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, drop_index: bool = True) -> DataFrame:
    """CSV with a header. ``drop_index`` removes the unnamed first column some writers store."""
    df = read_table(spark, "csv", path, schema)
    unnamed = [c for c in df.columns[:1] if c in ("_c0", "", "Unnamed: 0")]
    return df.drop(*unnamed) if drop_index else df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def jdbc_options(
    url: str, table: str | None = None, query: str | None = None, partition_column: str | None = None,
    lower: object = None, upper: object = None, partitions: int | None = None, **options,
) -> dict[str, str]:
    """Options of a JDBC read. A partition column with bounds reads in parallel ranges;
    Spark accepts that with a table (or a parenthesised subquery), not with ``query``."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    result = {"url": url, **{k: str(v) for k, v in options.items()}}
    if partition_column is None:
        result["dbtable" if table else "query"] = table or query
        return result
    if lower is None or upper is None or not partitions:
        raise ValueError("a partition column needs lower, upper and partitions")
    result["dbtable"] = table or f"({query}) part"
    result.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return result


def read_jdbc(spark: SparkSession, url: str, **how) -> DataFrame:
    """A remote table or query; filters and columns are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **how)).load()


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a SQL text with the given frames as its tables. Tables are named in braces, as ``{orders}``; no view is left behind."""
    return spark.sql(text, **tables)


class _Files:
    """The few file operations that publishing needs, on any file system Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._no_overwrite = spark.sparkContext._gateway.new_array(self._hadoop.fs.Options.Rename, 0)
        self._context = self._hadoop.fs.FileContext.getFileContext(self.path(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._context.util().exists(self.path(name))

    def remove(self, name: str) -> None:
        if self.exists(name):
            self._context.delete(self.path(name), True)

    def publish(self, source: str, target: str) -> bool:
        """Rename in one step, unless the target exists by now."""
        try:
            self._context.rename(self.path(source), self.path(target), self._no_overwrite)
        except Py4JJavaError:
            if self.exists(target):
                return False
            raise
        return True


def acquire_cached(spark: SparkSession, build: Callable[[], DataFrame], path: str, fmt: str = "parquet") -> DataFrame:
    """Build and store the table when its stored copy is missing; always read the stored copy.

    ``path`` must be storage every executor sees. Parquet keeps types, CSV does not. The table is written to a
    folder of its own, checked for the mark of a finished write, and published by renaming; so a copy is whole or not there. Of
    two writers at once the first to publish wins, and the other reads the winner's copy. The rest of a write that was broken off, a
    folder without that mark, is replaced.
    """
    path = path.rstrip("/")
    files = _Files(spark, path)
    if not files.exists(f"{path}/_SUCCESS"):
        staging = f"{path}.staging-{uuid.uuid4().hex}"
        try:
            writer = build().write.mode("errorifexists")
            writer.csv(staging, header=True) if fmt == "csv" else writer.format(fmt).save(staging)
            if not files.exists(f"{staging}/_SUCCESS"):
                raise RuntimeError("the write left no _SUCCESS mark; set mapreduce.fileoutputcommitter.marksuccessfuljobs")
            while not files.publish(staging, path) and not files.exists(f"{path}/_SUCCESS"):
                files.remove(path)
        finally:
            files.remove(staging)
    return read_table(spark, fmt, path)
