"""Sharding: contiguous cuts of least largest size over ordered atomic groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, table

#: Ordered units that the driver sees, whatever the input's size: one long for each.
UNITS_LOG2 = 16
#: Parts of a unit that holds very many rows, for numbering its slots.
SALTS = 64


def minimax_cuts(sizes: np.ndarray, n_shards: int) -> np.ndarray:
    """Ends (exclusive) of n_shards contiguous runs of sizes whose largest sum is as small as can be.

    The smallest feasible capacity is found by binary search; a capacity is feasible if greedy filling needs no more
    than n_shards runs. Within that capacity each cut is then put as near as it may to equal shares, between the
    earliest place from which the rest still fits and the latest place that the run before it allows.
    """
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    total, n = int(ends[-1]), len(sizes)

    def greedy(capacity: int) -> int:
        at = used = 0
        while at < n and used <= n_shards:
            at = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
            used += 1
        return used

    low, high = max(int(sizes.max(initial=0)), -(-total // n_shards)), max(total, 0)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(mid) <= n_shards else (mid + 1, high)
    earliest = [n]
    for _ in range(n_shards - 1):
        earliest.append(int(np.searchsorted(ends, ends[earliest[-1]] - low, "left")))
    earliest.reverse()
    cuts, at = [], 0
    for k in range(n_shards):
        latest = int(np.searchsorted(ends, ends[at] + low, "right")) - 1
        share = total * (k + 1) / n_shards
        near = int(np.searchsorted(ends, share))
        if near and abs(ends[near - 1] - share) <= abs(ends[min(near, n)] - share):
            near -= 1
        at = min(max(near, earliest[k], at), latest)
        cuts.append(at)
    cuts[-1] = n
    return np.array(cuts)


def shard_by_size(rows: DataFrame, group: Column, size: Column, order: list[Column], n_shards: int) -> DataFrame:
    """rows with two more columns, shard (int) and slot (long), replaced if they are there already.

    Rows of equal `group` share a shard. Groups are ordered by a 64-bit hash and gathered by its leading bits into
    2**16 atomic units, so that the driver holds 65,536 sums at any input size; `minimax_cuts` cuts these. A unit is a
    65,536th of the rows, and so a shard's size is off the best cut between single groups by less than a thousandth
    unless one group is larger than that. Slots count from 0 in each shard without gaps: a unit's first slot follows
    from the counts, and units with many rows (a hot group) are numbered in salted parts.

    An empty table stays empty; null groups count as one group; rows that tie in `order` are numbered as they were
    read, and are told apart so that a hot group of them is split, too.
    """
    spark = rows.sparkSession
    clash = [c for c in ("shard", "slot") if c in rows.columns]
    kept = [c for c in rows.columns if c not in clash]
    keyed = rows.select(
        *kept,
        F.shiftrightunsigned(F.xxhash64(group), 64 - UNITS_LOG2).cast("int").alias("_unit"),
        size.cast("long").alias("_size"),
        F.struct(*order, F.monotonically_increasing_id()).alias("_order"),
    )
    keyed = materialize(keyed, "shard")
    seen = keyed.groupBy("_unit").agg(F.count("*").alias("n"), F.sum("_size").alias("s")).collect()
    sizes, counts = (np.zeros(1 << UNITS_LOG2, dtype=np.int64) for _ in range(2))
    for r in seen:
        counts[r._unit], sizes[r._unit] = r.n, r.s
    cuts = minimax_cuts(sizes, n_shards)
    shard = np.searchsorted(cuts, np.arange(len(sizes)), "right")
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    first = np.concatenate([[0], cuts[:-1]])
    slot0 = before - before[np.minimum(first, len(sizes) - 1)][np.minimum(shard, n_shards - 1)]
    hot = counts > max(512, int(counts.sum()) // 2048)

    # below 2048 units are hot, each in SALTS parts
    salt = F.pmod(F.xxhash64("_order", F.lit(1)), F.lit(SALTS)).cast("int")
    parts: dict[tuple[int, int], int] = {}
    if hot.any():
        chosen = keyed.where(F.col("_unit").isin([int(x) for x in np.flatnonzero(hot)]))
        for r in sorted(chosen.groupBy("_unit", salt.alias("salt")).count().collect()):
            parts[r._unit, r.salt] = r["count"]
    cells = [(int(r._unit), 0, int(shard[r._unit]), int(slot0[r._unit])) for r in seen if not hot[r._unit]]
    done: dict[int, int] = {}
    for (unit, part), n in parts.items():
        cells.append((unit, part, int(shard[unit]), int(slot0[unit]) + done.get(unit, 0)))
        done[unit] = done.get(unit, 0) + n
    schema = T.StructType(
        [
            T.StructField("_unit", T.IntegerType()),
            T.StructField("_salt", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("_slot0", T.LongType()),
        ]
    )
    placed = F.broadcast(spark.createDataFrame(cells, schema).coalesce(1))  # 65,536 + 2048 * SALTS rows at most
    is_hot = F.col("_unit").isin([int(x) for x in np.flatnonzero(hot)]) if hot.any() else F.lit(False)
    keyed = keyed.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)))
    within = Window.partitionBy("_unit", "_salt").orderBy("_order")
    numbered = keyed.withColumn("_n", F.row_number().over(within))
    return numbered.join(placed, ["_unit", "_salt"]).select(
        *kept, "shard", (F.col("_slot0") + F.col("_n") - 1).alias("slot")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards of nearly equal bytes; equal texts stay together. A null text counts as empty."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_text"),
    )
    out = shard_by_size(rows, F.col("_text"), F.col("size"), [F.col("doc_id"), F.col("text_crc32")], 40)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
