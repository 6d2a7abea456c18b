"""Minimax contiguous sharding of documents that keeps equal texts together.

Texts are ordered by a 64-bit hash. All texts with the same leading hash bits form an atom, so
equal texts are never parted, and the number of atoms is fixed whatever the size of the table.
The smallest capacity that lets at most ``shards`` contiguous runs of atoms hold everything is
found by binary search, each candidate checked greedily, and the runs are cut under it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ATOM_BITS = 16
ROWS_PER_WINDOW = 20_000


def greedy_ends(prefix: np.ndarray, capacity: int) -> np.ndarray:
    """For every start the end of the longest run of atoms within ``capacity``."""
    return np.searchsorted(prefix, prefix[:-1] + capacity, side="right") - 1


def shards_needed(prefix: np.ndarray, capacity: int, limit: int) -> int:
    """Runs that a greedy pass opens, at most ``limit + 1``."""
    at, used, last = 0, 0, len(prefix) - 1
    while at < last and used <= limit:
        at = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        used += 1
    return used


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least bound on a shard's size under which the atoms fit, in order."""
    if not len(sizes):
        return 0
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low, high = max(int(sizes.max()), -(-int(prefix[-1]) // shards)), int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        if shards_needed(prefix, middle, shards) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def cut(sizes: np.ndarray, shards: int) -> np.ndarray:
    """A shard for every atom: contiguous runs, none above the smallest capacity.

    Below the capacity each cut is made nearest to an even share of what is left, as long as
    the rest still fits the shards that are left. One atom far above the mean thus does not
    leave shards empty.
    """
    n = len(sizes)
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    ends = greedy_ends(prefix, smallest_capacity(sizes, shards)) if n else np.empty(0, np.int64)
    need = np.zeros(n + 1, np.int64)
    for at in range(n - 1, -1, -1):
        need[at] = 1 + need[ends[at]]
    placed, at = np.empty(n, np.int64), 0
    for shard in range(shards):
        left = shards - shard
        if at == n:
            break
        target = prefix[at] + (prefix[n] - prefix[at]) / left
        near = int(np.searchsorted(prefix, target))
        if near > at + 1 and target - prefix[near - 1] < prefix[min(near, n)] - target:
            near -= 1
        first_fit = at + int(np.argmax(need[at : n + 1] <= left - 1))
        end = int(min(max(near, first_fit, at + 1), ends[at]))
        placed[at:end] = shard
        at = end
    return placed


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    overhead: int = 16,
    atom_bits: int = ATOM_BITS,
    window_rows: int = ROWS_PER_WINDOW,
) -> DataFrame:
    """One row per row: ``doc_id, size, text_crc32, shard, slot``; slots are gapless from 0.

    The size is the text's bytes plus ``overhead``. Null texts count as empty and lie with the
    empty ones. Rows with equal ids get slots of their own; null ids are allowed. An empty table
    gives an empty result, and other columns are not read. Slots are numbered in windows of
    about ``window_rows`` rows, so a text that fills much of the table is numbered in parts.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + overhead).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - atom_bits).alias("_atom"),
    )
    # At most 2 ** atom_bits rows whatever the table holds.
    atoms = (
        rows.groupBy("_atom").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("_atom")
    )
    placed = cut(atoms["size"].to_numpy(np.int64), shards)
    counts = atoms["n"].to_numpy(np.int64)
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    starts = np.searchsorted(placed, np.arange(shards))
    plan = pd.DataFrame(
        {
            "_atom": atoms["_atom"].to_numpy(np.int64),
            "shard": placed.astype(np.int32),
            "_offset": before - before[starts[placed]] if len(placed) else before,
            "_parts": -(-counts // window_rows),
        }
    )
    schema = "_atom BIGINT, shard INT, _offset BIGINT, _parts BIGINT"
    cuts = spark.createDataFrame(list(plan.itertuples(index=False, name=None)) if plan.empty else plan, schema)
    part = F.pmod(F.xxhash64("doc_id"), F.col("_parts"))
    known = rows.join(F.broadcast(cuts), "_atom").withColumn("_part", part)
    parts = known.where("_parts > 1").groupBy("_atom", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_atom").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_atom", "_part", F.sum("_n").over(earlier).alias("_earlier"))
    within = F.row_number().over(Window.partitionBy("_atom", "_part").orderBy("doc_id")) - 1
    slot = F.col("_offset") + F.coalesce("_earlier", F.lit(0)) + within
    return known.join(parts, ["_atom", "_part"], "left").select(
        "doc_id", "size", "text_crc32", "shard", slot.cast("bigint").alias("slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Write the rows of ``docs``, whose ids must be unique, to one folder ``_shard=N`` per shard.

    Where ``docs`` has a column of that name, the folders' name gets more underscores.
    """
    name = "_shard"
    while name in docs.columns:
        name = f"_{name}"
    where = placed.select(F.col("doc_id").alias("_placed"), F.col("shard").alias("_to"))
    held = docs.select(F.struct("*").alias("_whole"), F.col(id_column).alias("_id"))
    found = held.join(where, F.col("_id").eqNullSafe(F.col("_placed")))
    found.select("_whole.*", F.col("_to").alias(name)).write.partitionBy(name).parquet(path)
