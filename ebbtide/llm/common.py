"""Reading, ids and durable intermediate tables shared by the text operators."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text, a missing text as the empty one; clashing extra columns stay out."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: later steps neither recompute it nor depend on one executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with numbers that no other row of the scan has; fixed once the result is stored."""
    from pyspark import TaskContext

    at = TaskContext.get().partitionId() << 40
    for batch in batches:
        yield batch, np.arange(at, at + batch.num_rows)
        at += batch.num_rows


_kept: dict[str, dict[str, object]] = {}


def keep_only(operator: str) -> dict[str, object]:
    """What a worker keeps from task to task of an operator. Workers outlive jobs, so whatever others kept is forgotten."""
    for other in _kept.keys() - {operator}:
        del _kept[other]
    return _kept.setdefault(operator, {})


def kept(operator: str, key: str, make: Callable[[], object]):
    """Made once, and kept by the worker until it works for another operator."""
    own = keep_only(operator)
    if key not in own:
        own[key] = make()
    return own[key]


def pieces_for(amount: float, per_piece: float, least: int = 1) -> int:
    """How many partitions keep each below per_piece."""
    return max(least, math.ceil((amount or 0) / per_piece))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that they needn't have it installed."""
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), "ebbtide.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
