"""Reading raw files, reading and writing tables, and listing what is there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.spec import LABEL


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a path or glob matches anything on its file system."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm_path)
    return found is not None and len(found) > 0


def available(
    spark: SparkSession, paths: Mapping[str, str], missing: str = "error"
) -> tuple[dict[str, str], list[str]]:
    """Split named paths into those present and the names that are not.

    ``missing="error"`` raises instead, for jobs that need every input.
    """
    if missing not in ("error", "skip"):
        raise ValueError("missing must be 'error' or 'skip'")
    absent = [name for name, path in paths.items() if not path_exists(spark, path)]
    if absent and missing == "error":
        raise FileNotFoundError("missing input: " + ", ".join(f"{n} ({paths[n]})" for n in absent))
    return {n: p for n, p in paths.items() if n not in absent}, absent


def read_raw(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with every column as text; columns are found by name, never by position."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    codec: str = "zstd",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write Parquet, optionally in one folder per value of ``partition_by``.

    Partitioned rows are gathered by value first, which keeps the number of files
    low; the rebalance splits a value that holds a large part of the rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def without_label(df: DataFrame, forbid: Sequence[str] = (LABEL,)) -> DataFrame:
    """Drop columns an operational file must not carry, in whatever case they are spelled."""
    banned = {f.lower() for f in forbid}
    return df.select(*[c for c in df.columns if c.lower() not in banned])


def write_report(
    df: DataFrame,
    path: str,
    forbid: Sequence[str] = (LABEL,),
    single_file: bool = False,
    mode: str = "overwrite",
) -> DataFrame:
    """Write a header CSV without the forbidden columns and return what was written.

    ``single_file`` is meant for tables of a known small size, such as metrics.
    """
    out = without_label(df, forbid)
    (out.coalesce(1) if single_file else out).write.mode(mode).option("header", True).csv(path)
    return out


def files(spark: SparkSession, path: str) -> DataFrame:
    """Path and bytes of every data file that a path or glob names, from the file system's listing."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, waiting = [], [s for s in fs.globStatus(at) or ()]
    while waiting:
        status = waiting.pop()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            waiting.extend(fs.listStatus(status.getPath()))
        else:
            found.append((status.getPath().toUri().toString(), status.getLen()))
    return spark.createDataFrame(found, "file string, bytes long").withColumn("file", _named(F.col("file")))


def _named(path: Column) -> Column:
    """A path with one slash after its scheme, however it was written."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return read_raw(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def source_inventory(
    spark: SparkSession,
    sources: Mapping[str, str],
    fmt: str = "csv",
    samples: int = 3,
) -> DataFrame:
    """One row per file: source, path, bytes, columns, row count and its first rows as JSON.

    Files are listed from the file system, so that those without rows appear with 0. The counts
    scan no columns. Of each block of a file the first ``samples`` rows are kept before anything
    is shuffled, and of those the first in the file.
    """
    tables = []
    for name, path in sources.items():
        df = _scan(spark, path, fmt)
        columns = df.columns
        meta = F.col("_metadata")
        rows = df.groupBy(_named(meta["file_path"]).alias("file")).agg(F.count("*").alias("rows"))
        counts = files(spark, path).join(rows, "file", "left").select(
            "file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows")
        )
        block = Window.partitionBy("file", "_block").orderBy("_seq")
        head = (
            df.select(
                _named(meta["file_path"]).alias("file"),
                meta["file_block_start"].alias("_block"),
                F.monotonically_increasing_id().alias("_seq"),
                F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("_row"),
            )
            .withColumn("_n", F.row_number().over(block))
            .where(F.col("_n") <= samples)
            .withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("_block", "_seq")))
            .where(F.col("_n") <= samples)
            .groupBy("file")
            .agg(F.array_sort(F.collect_list(F.struct("_n", "_row"))).alias("_head"))
            .select("file", F.col("_head._row").alias("first_rows"))
        )
        tables.append(
            counts.join(head, "file", "left").select(
                F.lit(name).alias("source"),
                "file",
                "bytes",
                F.lit(",".join(columns)).alias("columns"),
                "rows",
                "first_rows",
            )
        )
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def source_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and column count per named table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("source"), F.lit(len(df.columns)).alias("column_count"), "rows"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
