"""Hashes of words and byte windows, and corpus-wide frequencies of hashes by blocks.

Documents are dealt into chunks of a few MB. A chunk sends every distinct hash once, packed by
bucket; a bucket counts its hashes and sends the counts back in the same order. So a hash that a
third of all documents hold costs one entry per chunk, and nothing is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import pieces_for

#: Bytes of text in a chunk and hashes in a bucket, about.
CHUNK_BYTES, BUCKET_HASHES = 4_000_000, 1_000_000
#: Bytes hashed together; small enough for the processor's cache.
RUN_BYTES = 400_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 2**64))
#: One random number per byte.
BYTES = np.random.Generator(np.random.PCG64(2024)).integers(0, 2**64, 256, dtype=np.uint64)

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, mod 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * RUN_BYTES)
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x)])) for x in (MULTIPLIER, INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_hash(data: np.ndarray) -> np.ndarray:
    """Sums of which two differences make the hash of any stretch of bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTES[data] * powers(len(data))[0], out=out[1:])
    return out


def stretch_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((running[end] - running[start]) * powers(len(running))[1][start])


def runs(sizes: list[int]) -> Iterator[slice]:
    """Consecutive documents of about RUN_BYTES together."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > RUN_BYTES:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield slice(start, len(sizes))


def chunked(docs: DataFrame, *key: str) -> tuple[DataFrame, int, int]:
    """The documents with a column chunk, the number of chunks and the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = pieces_for(total, CHUNK_BYTES)
    return docs.withColumn("chunk", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")), n, total


PACKED = "chunk int, bucket int, hashes binary, counts binary"
COUNTED = "chunk int, bucket int, counts binary"


def pack(chunk: int, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """Distinct rising hashes with counts (255: as many or more), cut by bucket (rising ranges).

    Of a hash 32 bits within its bucket are sent. As buckets grow in number and not in size, one hash in some
    thousands is taken for another at any scale, and is then counted too often, never too rarely.
    """
    edges = bounds(buckets)
    cuts = np.searchsorted(hashes, edges)
    cuts[-1] = len(hashes)
    drop = np.uint64(max(0, (2**64 // buckets).bit_length() - 32))
    counts = np.minimum(counts, 255).astype(np.uint8)
    parts = [(b, slice(*cuts[b : b + 2])) for b in range(buckets) if cuts[b] < cuts[b + 1]]
    return pa.table({
        "chunk": pa.array([chunk] * len(parts), pa.int32()), "bucket": pa.array([b for b, _ in parts], pa.int32()),
        "hashes": pa.array([((hashes[s] - edges[b]) >> drop).astype(np.uint32).tobytes() for b, s in parts], pa.binary()),
        "counts": pa.array([counts[s].tobytes() for _, s in parts], pa.binary()),
    })


def bounds(buckets: int) -> np.ndarray:
    return np.array([min(b * (2**64 // buckets), 2**64 - 1) for b in range(buckets)] + [2**64 - 1], dtype=np.uint64)


def level(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte, rising: exact to 199, then logarithmic."""
    return np.where(counts < 200, counts, np.minimum(255, 200 + np.log2(np.maximum(counts, 200) / 200) * 2)).astype(np.uint8)


def _count(table: pa.Table) -> pa.Table:
    hashes = [np.frombuffer(b, dtype=np.uint32) for b in table["hashes"].to_pylist()]
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype=np.uint8)
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    found = level(np.bincount(place, counts).astype(np.int64))[place]
    ends = np.cumsum([len(h) for h in hashes])
    parts = [found[e - len(h) : e].tobytes() for e, h in zip(ends, hashes)]
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "counts": pa.array(parts, pa.binary())})


def frequencies(packed: DataFrame) -> DataFrame:
    """For each chunk and bucket the levels of all its hashes over the whole corpus, in the order sent."""
    return packed.groupBy("bucket").applyInArrow(_count, COUNTED)


def unpack(table: pa.Table) -> np.ndarray:
    """The levels of a chunk's distinct rising hashes."""
    order = np.argsort(table["bucket"].to_numpy())
    counts = table["counts"].to_pylist()
    return np.frombuffer(b"".join(counts[i] for i in order), dtype=np.uint8)
