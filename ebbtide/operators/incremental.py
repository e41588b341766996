"""Customer-period usage that grows file by file instead of being rebuilt.

A store keeps partial sums per source file and customer-period, a ledger of the file versions they came from, and the finished
table, cut by period. Adding files reads only new or changed ones, and only periods that these touch, before or
after a change, are summed up and written again. Partial sums count once the ledger names their batch, and
a batch whose periods were not finished is finished by the next call, so a job that dies may simply be run again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbtide.functions.scalars import real
from ebbtide.operators.rollup import clean_sums, log_period, usage_sums
from ebbtide.sources.io import path_exists, read_raw
from ebbtide.spec import ID, LOG_COUNTERS, LOG_SECONDS, SECONDS_PER_DAY

LEDGER = "file string, bytes long, modified timestamp, batch string, added timestamp"
FINISHED = "batch string"
#: Folder name of a period; a period may be any text, an empty one included.
FOLDER = "_folder"


@dataclass(frozen=True)
class UsageStore:
    """Monthly (or otherwise grained) usage with clean seconds under ``path``, from header CSV files."""

    spark: SparkSession
    path: str
    id_col: str = ID
    date_col: str = "date"
    counters: Sequence[str] = LOG_COUNTERS
    seconds: str = LOG_SECONDS
    cap: float = SECONDS_PER_DAY
    grain: str = "month"

    @property
    def sums(self) -> list[str]:
        return [*self.counters, self.seconds, "log_rows", f"{self.seconds}_clean", "invalid_secs_rows", "capped_secs_rows"]

    def _schema(self, *first: str) -> StructType:
        kinds = {self.seconds: "double", f"{self.seconds}_clean": "double"}
        columns = [*first, f"{self.id_col} string", f"{self.grain} string", *[f"{c} {kinds.get(c, 'long')}" for c in self.sums], f"{FOLDER} string"]
        return StructType.fromDDL(", ".join(columns))

    def _read(self, name: str, schema: str | StructType) -> DataFrame:
        at = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(at) if path_exists(self.spark, at) else self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """Every version of a file that was added: file, bytes, modified, batch, added."""
        return self._read("ledger", LEDGER)

    def current(self) -> DataFrame:
        """The latest version of every file."""
        latest = Window.partitionBy("file").orderBy(F.desc("added"), F.desc("batch"))
        return self.ledger().withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth")

    def partials(self) -> DataFrame:
        """Sums per file version, customer and period, of all batches that the ledger names."""
        return self._read("partials", self._schema("batch string", "file string"))

    def table(self) -> DataFrame:
        """Usage of all files added so far, as a full build of them would give it."""
        return self._read("usage", self._schema()).drop(FOLDER)

    def _listed(self, paths: Sequence[str]) -> DataFrame:
        meta = [F.col(f"_metadata.{m}").alias(c) for m, c in (("file_path", "file"), ("file_size", "bytes"), ("file_modification_time", "modified"))]
        return self.spark.read.format("binaryFile").load(list(paths)).select("path", *meta)

    def _partial_sums(self, files: Sequence[str], batch: str) -> DataFrame:
        logs = read_raw(self.spark, list(files)).withColumns({"file": F.col("_metadata.file_path"), self.grain: log_period(self.date_col, self.grain)})
        rows = logs.where(F.col(self.grain).isNotNull() & F.col(self.id_col).isNotNull())
        # each text is read as a number once, below the sums, which use it many times
        kept = rows.select("file", self.id_col, self.grain, *[real(F.col(c)).alias(c) for c in (*self.counters, self.seconds)])
        sums = kept.groupBy("file", self.id_col, self.grain).agg(*usage_sums(self.counters, self.seconds, "null"), *clean_sums(self.seconds, self.cap))
        return sums.select(F.lit(batch).alias("batch"), "file", self.id_col, self.grain, *self.sums, self._folder())

    def _folder(self) -> Column:
        return F.concat(F.lit("p"), F.col(self.grain)).alias(FOLDER)

    def add(self, paths: Sequence[str]) -> DataFrame:
        """Add files, folders or globs; files that were added before and have not changed are left out. Returns the table.

        A file is known by its path, and a version of it by size and time of change. A changed file replaces what it said
        before. One writer at a time.
        """
        known = self.current().select("file", "bytes", "modified")
        new = self._listed(paths).join(known, ["file", "bytes", "modified"], "left_anti").collect()
        if new:
            batch = uuid.uuid4().hex
            self._partial_sums([re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in new], batch).hint("rebalance", FOLDER).write.mode("append").partitionBy("batch", FOLDER).parquet(f"{self.path}/partials")
            versions = self.spark.createDataFrame([(r["file"], r["bytes"], r["modified"], batch) for r in new], "file string, bytes long, modified timestamp, batch string")
            versions.withColumn("added", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        self.finish()
        return self.table()

    def finish(self) -> list[str]:
        """Sum up the periods that batches not yet finished touch, and write only these. Returns their folder names."""
        open_ = self.ledger().select("file", "batch").join(self._read("finished", FINISHED), "batch", "left_anti")
        batches = [r["batch"] for r in open_.select("batch").distinct().collect()]
        if not batches:
            return []
        # what a changed file said before is touched as well
        versions = self.ledger().join(open_.select("file").distinct(), "file", "left_semi").select("file", "batch")
        of_them = [r["batch"] for r in versions.select("batch").distinct().collect()]
        held = self.partials().where(F.col("batch").isin(of_them)).join(F.broadcast(versions), ["file", "batch"], "left_semi")
        touched = sorted(r[FOLDER] for r in held.select(FOLDER).distinct().collect())
        valid = self.current().select("file", "batch")
        rows = self.partials().where(F.col(FOLDER).isin(touched)).join(valid, ["file", "batch"], "left_semi")
        whole = rows.groupBy(self.id_col, self.grain).agg(*[F.sum(c).alias(c) for c in self.sums]).withColumn(FOLDER, self._folder())
        whole.hint("rebalance", FOLDER).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(f"{self.path}/usage")
        if not versions.join(valid, ["file", "batch"], "left_anti").isEmpty():  # else every touched period has rows
            left = {r[FOLDER] for r in rows.select(FOLDER).distinct().collect()}
            for gone in set(touched) - left:
                self._delete(f"{self.path}/usage/{FOLDER}={gone}")
        self.spark.createDataFrame([(b,) for b in batches], FINISHED).coalesce(1).write.mode("append").parquet(f"{self.path}/finished")
        return touched

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
