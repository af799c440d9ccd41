"""Lake tables: raw scans, partitioned sinks, latest-partition reads and manifests."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import delete_folder, work_folder

# Cell texts that CSV files use for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

FILE, BLOCK, ROW = "_source_file", "_source_block", "_source_row"
POSITION = (FILE, BLOCK, ROW)


class Workspace:
    """Intermediate tables of one run, in the folder shared by all executors.

    Written tables survive the loss of an executor, cut the lineage and have a known size, which the planner uses to
    choose between broadcast and shuffle. ``codec`` compresses them; its default is the session's.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, codec: str | None = None):
        self.spark = spark
        self.folder = folder or work_folder(spark)
        self.codec = codec or spark.conf.get("spark.sql.parquet.compression.codec")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, frame: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        writer = frame.write.mode("overwrite").option("compression", self.codec)
        writer.partitionBy(*partition_by).parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def save_all(self, frames: Mapping[str, DataFrame], partition_by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
        """Save independent tables side by side, so that small ones do not leave the cluster idle."""
        if not frames:
            return {}
        with ThreadPoolExecutor(min(len(frames), 8)) as pool:
            saved = pool.map(lambda item: self.save(item[1], item[0], partition_by), frames.items())
            return dict(zip(frames, saved, strict=True))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing will read again."""
        for name in names:
            delete_folder(self.spark, self.path(name))

    def close(self) -> None:
        """Delete the whole folder."""
        delete_folder(self.spark, self.folder)


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV as text columns, with the usual null markers read as null.

    The columns are those of the header, so a contract can report a missing one. Files of one folder must agree on it:
    one with other columns, or the same in another order, fails the read instead of being read by position.
    ``multi_line`` allows line breaks in quoted cells, at the price of files that cannot be split.
    """

    def reader() -> DataFrameReader:
        return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)

    rows = reader().option("enforceSchema", False).schema(reader().csv(path).schema).csv(path)
    return rows.select(*[_or_null(name) for name in rows.columns])


def _or_null(name: str) -> Column:
    return F.when(~F.col(name).isin(*NULL_TOKENS), F.col(name)).alias(name)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped, and a line that is no JSON fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_glob(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """All Parquet files below ``base`` that match a path pattern, as one table with its partition columns."""
    return spark.read.option("basePath", base).parquet(f"{base}/{pattern}")


def with_position(rows: DataFrame) -> DataFrame:
    """Add the place of each row: source file, start of its split, and a rank that rises along the split.

    The three together (``POSITION``) order the rows of a table by file and place, however Spark cuts and packs the
    files. Write the result before use (``Workspace.save``), which fixes the values.
    """
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def row_numbers(rows: DataFrame, positioned: DataFrame) -> DataFrame:
    """Zero-based row number inside the source file, for ``rows`` that carry the position columns.

    Splits are counted first (one row per split), so no sort or window runs over the rows themselves.
    """
    splits = positioned.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.min(ROW).alias("_first"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_skipped", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = rows.join(starts, [FILE, BLOCK], "left")
    return numbered.withColumn("row_number", F.col("_skipped") + F.col(ROW) - F.col("_first")).drop(
        "_n", "_first", "_skipped"
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or no rows when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_csv_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """CSV export, or a frame without columns and rows when nothing has been written there yet."""
    try:
        return read_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([]))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there. Like ``folders`` it asks Hadoop's file system, so it needs a classic session."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folders(spark: SparkSession, base: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders below ``base``; only folder names are listed."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{column}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(str(status.getPath().getName()).partition("=")[2] for status in found or [])


def latest_folder(spark: SparkSession, base: str, column: str = "run_date") -> str:
    """Path of the greatest ``column=value`` folder below ``base``."""
    found = folders(spark, base, column)
    if not found:
        raise FileNotFoundError(f"no {column} folder below {base}")
    return f"{base}/{column}={found[-1]}"


def ingest_metadata(frame: DataFrame, profile: str, run_date: str) -> DataFrame:
    return frame.withColumns({"ingest_profile": F.lit(profile), "ingest_run_date": F.lit(run_date)})


def write_partition(frame: DataFrame, path: str, *partition_columns: str) -> None:
    """Replace only the partitions that ``frame`` holds; the other runs of the table stay."""
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_columns)
        .parquet(path)
    )


def latest_partition(
    spark: SparkSession, path: str, column: str = "run_date", schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the greatest partition value, which the folder names tell; no file of another partition is opened."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("basePath", path).parquet(latest_folder(spark, path, column))


def write_export(frame: DataFrame, path: str) -> None:
    """A mart as Parquet and as header CSV, in as many parts as the data needs."""
    frame.write.mode("overwrite").parquet(f"{path}/parquet")
    write_csv(frame, f"{path}/csv")


def write_csv(frame: DataFrame, path: str, codec: str = "none") -> None:
    frame.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", codec).csv(path)


def save_table(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a catalog table from a query, below the warehouse or a path of its own.

    The rows go to a new folder, and then the table is pointed at it: one change of the catalog where the columns stay.
    A query that fails leaves the table as it was, and readers that have begun keep the rows they began with. Folders
    of earlier contents stay until they are deleted.
    """
    spark = frame.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}"
    folder = f"{base}/{uuid.uuid4().hex}"
    frame.write.parquet(folder)
    if spark.catalog.tableExists(name):
        if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in frame.schema]:
            spark.sql(f"alter table {name} set location '{folder}'")
            return
        spark.sql(f"drop table {name}")
    spark.catalog.createTable(name, path=folder, source="parquet", schema=frame.schema)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def manifest(
    tables: Mapping[str, DataFrame], profile: str, run_partition: str, name_column: str, count_column: str
) -> DataFrame:
    """Rows per table; each branch is one map-side combined count."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias(count_column)).select(
            F.lit(profile).alias("profile"),
            F.lit(run_partition).alias("run_partition"),
            F.lit(name).alias(name_column),
            count_column,
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
