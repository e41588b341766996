"""Best-fit packing of token sequences into bins of several permitted lengths.

Sequences are dealt into shards by a hash of their id, and every shard is packed on its own from
the counts per length, so a shard costs the same whatever its texts look like. Within a shard,
lengths are taken in falling order. A sequence goes into the open bin with the least room that
still takes it; if none does, a bin of the permitted length is opened whose cost per token held will be least, judged
by the waiting sequences that its remaining room takes. A bin costs its tokens and, for attention, a share that grows
with the square of its length. Finally each bin shrinks to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import pieces_for, stored

PACKED = "shard int, doc_id long, piece int, start long, length int, bin int, bin_capacity int, bin_used int, bin_start int"


def bin_cost(size: int, attention: float) -> float:
    """What a bin costs to train on: its tokens, and a share that grows with the square of its length."""
    return size + attention * size * size


def pack_lengths(lengths: Sequence[int], sizes: Sequence[int], attention: float = 1 / 65536) -> tuple[list[int], list[int], list[int]]:
    """For each length (1 to the largest size): its bin and start there; and the final size of every bin."""
    sizes = sorted(sizes)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    rising = [lengths[i] for i in reversed(order)]
    sums = [0]
    for n in rising:
        sums.append(sums[-1] + n)
    rooms: list[int] = []  # distinct rooms of open bins, rising
    open_bins: dict[int, list[int]] = {}
    used: list[int] = []
    bin_of, start = [0] * len(lengths), [0] * len(lengths)
    for done, i in enumerate(order, 1):
        n = lengths[i]
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
        else:
            waiting = len(lengths) - done  # these are the first of rising

            def cost_per_token(size: int) -> float:
                fits = sums[min(bisect_right(rising, size - n), waiting)]
                return bin_cost(size, attention) / (n + min(size - n, fits))

            room, b = min((s for s in sizes if s >= n), key=cost_per_token), len(used)
            used.append(0)
        bin_of[i], start[i] = b, used[b]
        used[b] += n
        if room - n:
            if room - n not in open_bins:
                open_bins[room - n] = []
                insort(rooms, room - n)
            open_bins[room - n].append(b)
    return bin_of, start, [sizes[bisect_left(sizes, u)] for u in used]


def _shard_packer(sizes: tuple[int, ...], attention: float):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, starts, final = pack_lengths(pdf["length"].tolist(), sizes, attention)
        at = np.array(bins, dtype=np.int64)
        used = np.bincount(at, weights=pdf["length"].to_numpy(), minlength=len(final)).astype(np.int64)
        return pdf.assign(bin=at, bin_capacity=np.array(final)[at], bin_used=used[at], bin_start=starts)[
            ["shard", "doc_id", "piece", "start", "length", "bin", "bin_capacity", "bin_used", "bin_start"]
        ]

    return pack


def best_fit_pack(lengths: DataFrame, sizes: Sequence[int] = (512, 1024, 2048, 4096, 8192), shard_rows: int = 50_000,
                  attention: float = 1 / 65536, id_col: str = "doc_id", length_col: str = "n_tokens") -> DataFrame:
    """Every sequence with its bin: doc_id, piece, start, length, bin_id, bin_capacity, bin_used, bin_start.

    Sequences longer than the largest size are cut into pieces of that size (`piece` counts from
    0, `start` is the token offset). Null, zero and negative lengths need no room and give no
    row. Rows without an id are packed like others. Repeated rows are packed as often as they come. Bins
    never cross shards; a shard has about `shard_rows` pieces, dealt by a hash of id and offset, so
    copies of one length or one very long document can't fill a shard. An empty table gives an empty result.
    """
    sizes = tuple(sorted(int(s) for s in sizes))
    largest = sizes[-1]
    whole = lengths.select(F.col(id_col).cast("long").alias("doc_id"), F.col(length_col).cast("long").alias("n")).where("n > 0")
    whole = stored(whole, "lengths")  # lengths may be dear to compute and are needed twice
    n_pieces = whole.agg(F.sum(F.ceil(F.col("n") / largest))).first()[0]
    shards = pieces_for(n_pieces, shard_rows)
    cut = whole.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / largest).cast("int")))).select(
        "doc_id", "piece", (F.col("piece").cast("long") * largest).alias("start"),
        F.least(F.lit(largest).cast("long"), F.col("n") - F.col("piece").cast("long") * largest).cast("int").alias("length"),
    )
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("int"))
    packed = dealt.groupBy("shard").applyInPandas(_shard_packer(sizes, attention), PACKED)
    return packed.select(
        "doc_id", "piece", "start", "length", F.concat_ws("-", "shard", "bin").alias("bin_id"),
        "bin_capacity", "bin_used", "bin_start",
    )
