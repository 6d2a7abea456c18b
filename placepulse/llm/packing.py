"""Variable-capacity best-fit packing of documents into training sequences.

Only ids and token counts are packed. They are dealt into packs of bounded size by a hash of their
place; every pack is filled by best-fit decreasing with all permitted lengths in play. A new bin is
opened at the length with the least cost per token it can still expect to hold, and in the end
every bin shrinks to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence beyond its tokens, in tokens.
SEQUENCE_COST = 64
ROWS_PER_PACK = 10_000

PACKED = (
    "doc_id BIGINT, piece INT, piece_start BIGINT, n_tokens BIGINT, bin_id BIGINT, "
    "bin_length INT, bin_tokens INT, bin_offset INT"
)


def fit(sizes: Sequence[int], lengths: Sequence[int], cost: int = SEQUENCE_COST) -> tuple[list[int], list[int]]:
    """The bin of every size (descending, each from 1 to the longest length) and each bin's length."""
    lengths = sorted(lengths)
    room: list[int] = []  # the distinct free spaces, ascending
    by_room: dict[int, list[int]] = {}
    filled: list[int] = []
    placed: list[int] = []
    left = sum(sizes)

    def offer(bin_id: int, free: int) -> None:
        if free:
            if not by_room.setdefault(free, []):
                insort(room, free)
            by_room[free].append(bin_id)

    for size in sizes:
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            bin_id = by_room[free].pop()
            if not by_room[free]:
                room.pop(at)
        else:
            free = min((n for n in lengths if n >= size), key=lambda n: ((n + cost) / min(n, left), n))
            bin_id = len(filled)
            filled.append(0)
        filled[bin_id] += size
        placed.append(bin_id)
        offer(bin_id, free - size)
        left -= size
    return placed, [lengths[bisect_left(lengths, n)] for n in filled]


def _pack(lengths: Sequence[int], cost: int):
    longest = max(lengths)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_n", "doc_id"], ascending=[False, True], kind="stable")
        tokens = rows["_n"].to_numpy(np.int64)
        pieces = -(-tokens // longest)
        row = np.repeat(np.arange(len(rows)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * longest
        size = np.minimum(tokens[row] - start, longest)
        order = np.argsort(-size, kind="stable")
        row, piece, start, size = row[order], piece[order], start[order], size[order]
        placed, chosen = fit(size.tolist(), lengths, cost)
        bins = np.array(placed, np.int64)
        by_bin = np.argsort(bins, kind="stable")
        running = np.cumsum(size[by_bin]) - size[by_bin]
        first = np.searchsorted(bins[by_bin], bins[by_bin])
        offset = np.empty(len(size), np.int64)
        offset[by_bin] = running - running[first] if len(size) else running
        total = np.bincount(bins, weights=size, minlength=len(chosen)).astype(np.int64)
        base = int(rows["_pack"].iloc[0]) << 32
        out = pd.DataFrame(
            {
                "doc_id": rows["doc_id"].iloc[row].astype("Int64"),
                "piece": piece,
                "piece_start": start,
                "n_tokens": size,
                "bin_id": base + bins,
                "bin_length": np.array(chosen, np.int64)[bins],
                "bin_tokens": total[bins],
                "bin_offset": offset,
            }
        )
        return out

    return pack


def pack_documents(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Column | None = None,
    cost: int = SEQUENCE_COST,
    pack_rows: int = ROWS_PER_PACK,
) -> DataFrame:
    """One row per piece of a document: where it starts, its bin, the bin's length and its place there.

    ``tokens`` is the token count of a row, by default its number of words. A document above the
    longest length is cut into pieces of that length and a rest. Documents without tokens, with
    null or empty text, take no room and are listed with piece 0 and a null bin. Rows with equal
    or null ids are packed one by one. Pack ``ceil(rows / pack_rows)`` is the only unit of work
    that meets in one task. An empty table gives an empty result; other columns are not read.
    """
    count = word_count(F.col(text_column)) if tokens is None else F.coalesce(tokens, F.lit(0)).cast("bigint")
    counted = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), count.alias("_n"))
    packs = max(1, -(-docs.count() // pack_rows))
    # Ids may be null or repeat without bound, so rows are dealt by their place in the table.
    dealt = counted.withColumn("_pack", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(packs)))
    packed = dealt.where("_n > 0").groupBy("_pack").applyInPandas(_pack(tuple(lengths), cost), PACKED)
    none = counted.where("_n <= 0").selectExpr(
        "doc_id", "0 AS piece", "0L AS piece_start", "0L AS n_tokens", "CAST(NULL AS BIGINT) AS bin_id",
        "CAST(NULL AS INT) AS bin_length", "CAST(NULL AS INT) AS bin_tokens", "CAST(NULL AS INT) AS bin_offset",
    )
    return packed.unionByName(none)
