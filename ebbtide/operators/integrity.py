"""Checksums of published files and their verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_NAME = "manifest.json"
#: Bytes of a file that a task holds at a time.
PIECE_BYTES = 4_000_000
#: A folder has no bytes.
LISTED = "path string, bytes long"
MANIFEST = "path string, bytes long, sha256 string"


def _opened_as(spark: SparkSession, folder: str) -> str:
    """The folder as tasks open it: mount points resolved, every scheme by the name that Arrow's file systems know."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    resolved = at.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(at).toString()
    scheme, _, rest = resolved.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return f"{scheme}:{'//' * (not rest.startswith('//'))}{quote(rest, safe='/:@')}"


Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# Tasks get the functions below by value, with their imports inside, so executors needn't have the package.


def _lister(uri: str, recursive: bool) -> Rows:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)
        root = root.rstrip("/")
        for batch in batches:
            for folder in batch["path"].to_pylist():
                found = files.get_file_info(fs.FileSelector(f"{root}/{folder}" if folder else root, recursive=recursive))
                kept = [x for x in found if x.type == fs.FileType.File or not recursive]
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([x.path[len(root) + 1 :] for x in kept], pa.string()),
                    "bytes": pa.array([x.size if x.type == fs.FileType.File else None for x in kept], pa.int64()),
                })

    return listed


def _hasher(uri: str, piece: int) -> Rows:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch["path"].to_pylist():
                digest, size = hashlib.sha256(), 0
                with files.open_input_stream(f"{root.rstrip('/')}/{path}", compression=None) as stream:
                    while data := stream.read(piece):
                        digest.update(data)
                        size += len(data)
                yield pa.RecordBatch.from_pydict({"path": [path], "bytes": pa.array([size], pa.int64()), "sha256": [digest.hexdigest()]})

    return hashed


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path below ``folder`` and size of every file in it, hidden and empty ones too.

    One task lists the folder itself, the others the trees below its folders.
    """
    uri = _opened_as(spark, folder)
    top = spark.createDataFrame([("",)], "path string").mapInArrow(_lister(uri, False), LISTED)
    folders = top.where("bytes is null").select("path").repartition("path")
    return top.where("bytes is not null").unionByName(folders.mapInArrow(_lister(uri, True), LISTED))


def file_manifest(spark: SparkSession, folder: str, exclude: Sequence[str] = (MANIFEST_NAME,)) -> DataFrame:
    """Path below ``folder``, size and SHA-256 of every file in it, but for files of the excluded names.

    Files are dealt to tasks. A task reads one after another in pieces of ``PIECE_BYTES``, so
    neither its memory nor the driver's depends on the size of a file. The file system has to be one that Arrow can
    open on the executors; mount points are resolved.
    """
    name = F.element_at(F.split("path", "/"), -1)
    files = list_files(spark, folder).where(~name.isin(list(exclude)))
    dealt = files.repartition("path").sortWithinPartitions(F.desc("bytes"))
    return dealt.select("path").mapInArrow(_hasher(_opened_as(spark, folder), PIECE_BYTES), MANIFEST)


def _names(spark: SparkSession, names: Sequence[str], column: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


def verify_manifest(
    actual: DataFrame,
    expected: DataFrame,
    required: Sequence[str] = (),
    forbidden: Sequence[str] = (),
) -> DataFrame:
    """Failures as rows ``(failure, path)``; none if the files match the manifest."""
    spark = actual.sparkSession
    have = actual.select("path", F.col("sha256").alias("_actual"))
    want = expected.select("path", F.col("sha256").alias("_expected"))
    compared = want.join(have, "path", "left")
    differing = compared.select(
        F.when(F.col("_actual").isNull(), "missing file")
        .when(F.col("_actual") != F.col("_expected"), "checksum mismatch")
        .alias("failure"),
        "path",
    ).where(F.col("failure").isNotNull())
    absent = _names(spark, required, "path").join(have, "path", "left_anti").select(
        F.lit("required file missing").alias("failure"), "path"
    )
    patterns = F.array(*[F.lit(f) for f in forbidden]).cast("array<string>")
    present = (
        have.select(
            F.explode(F.filter(patterns, lambda p: F.contains(F.lower("path"), F.lower(p)))).alias("path")
        )
        .distinct()
        .select(F.lit("forbidden file present").alias("failure"), "path")
    )
    return differing.unionByName(absent).unionByName(present)
