"""Near-duplicate detection: one-permutation MinHash, banded buckets, star-shaped candidates.

Each distinct set of word shingles is hashed once; its hashes fall into bins, and the least of a
bin is its signature value (one permutation). Empty bins borrow from the first filled bin in a
random order of their own (optimal densification). Rows of the signature are banded into buckets.

Inside a bucket only stars are compared: a centre with the members outside its component. Links
are confirmed on full sets. The centre is the member that shares buckets with most others, as an
original does with its copies, by one order for all buckets, so that stars of different buckets
are mostly the same pairs. A link between two members that both miss the centre would be lost by
one star: the centre leaves, and buckets that still hold several components get another one. When
a round finds no link after ``SURE_ROUNDS``, what is left in buckets of several components is
compared exactly, by the rarest shingles of each set: two sets that are similar enough share one
of those, however many documents have a long form or licence in common.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved, small_side, without
from placepulse.llm.graph import components
from placepulse.llm.shingles import mix, shingle_sets
from placepulse.operators.joins import lookup_join

WIDTH = 5
PERCENT = 75
BANDS = 32
ROWS = 4
#: Stars tried in every bucket even if they find nothing, before the rest is compared exactly.
SURE_ROUNDS = 5
_EMPTY = np.uint64(2**64 - 1)


def orders(bins: int) -> np.ndarray:
    """For every bin the order in which it looks for a filled one: a random permutation each."""
    return np.random.RandomState(bins).rand(bins, bins).argsort(axis=1)


def signatures(sets: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Densified one-permutation signatures of non-empty sorted sets, one row each."""
    bins = len(order)
    out = np.full((len(sets), bins), _EMPTY)
    ranks = order.argsort(axis=1)
    sparse = []
    for row, hashes in enumerate(sets):
        at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(at, prepend=_EMPTY))
        out[row, at[first].astype(np.int64)] = hashes[first]
        if len(first) <= bins // 8:
            sparse.append((row, at[first].astype(np.int64)))
    held = out.copy()
    for row, filled in sparse:
        out[row] = held[row, filled[ranks[:, filled].argmin(axis=1)]]
        own = held[row, filled]
        out[row, filled] = own
    rows, columns = np.nonzero(out == _EMPTY)
    for attempt in range(bins):
        if not len(rows):
            break
        got = held[rows, order[columns, attempt]]
        some = got != _EMPTY
        out[rows[some], columns[some]] = got[some]
        rows, columns = rows[~some], columns[~some]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket for every band of every signature."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    return mix((signature * factors).reshape(len(signature), bands, rows).sum(axis=2, dtype=np.uint64))


def _features(width: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("_digest", pa.binary()), ("_bands", pa.list_(pa.int64())),
         ("_hash", pa.string())]
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = orders(bands * rows)
        for batch in batches:
            ids = batch.column("_id")
            held: list[tuple[int, bytes | None]] = []
            kept: list[np.ndarray] = []
            keys: list[np.ndarray] = []

            def sign():
                if kept:
                    keys.append(band_keys(signatures(kept, order), bands, rows))
                    kept.clear()

            texts = (t.as_py() for t in batch.column("_text"))
            for one in shingle_sets(texts, width):
                held.append((len(one), hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None))
                if len(one):
                    kept.append(one)
                if len(kept) >= 256:
                    sign()
            sign()
            sizes = np.array([n for n, _ in held], np.int64)
            flat = np.concatenate(keys).view(np.int64).ravel() if keys else np.empty(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes), pa.array([d for _, d in held], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), batch.column("_hash")], schema=schema)

    return features


def _sets(width: int):
    schema = pa.schema([("id", pa.int64()), ("set", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            held, weight = [], 0
            for one in zip(ids, shingle_sets((t.as_py() for t in batch.column("_text")), width), strict=True):
                held.append(one)
                weight += len(one[1])
                if weight > 500_000:
                    yield _rows(held, schema)
                    held, weight = [], 0
            if held:
                yield _rows(held, schema)

    return sets


def _rows(held: list[tuple[int, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    values = [pa.array([i for i, _ in held], pa.int64()), pa.array([s.view(np.int64) for _, s in held], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(values, schema=schema)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    other = sets.toDF("b", "_other")
    both = pairs.join(other, "b").join(sets.toDF("a", "_set"), "a")
    common = F.size(F.array_intersect("_set", "_other"))
    union = F.size("_set") + F.size("_other") - common
    return both.where(100 * common >= percent * union).select("a", "b").distinct()


def _merge(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links, the old ones taken as nodes."""
    if labels is None:
        return components(links)
    for end in ("a", "b"):
        of = labels.toDF(end, f"_{end}")
        links = links.join(of, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    merged = components(links.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    moved = labels.join(merged.toDF("component", "_to"), "component", "left").select(
        "id", F.coalesce("_to", "component").alias("component")
    )
    # A node may be new itself, or the label that it was: either way the merged label is the least.
    return saved(moved.union(merged).groupBy("id").agg(F.min("component").alias("component")), "labels")


def _rest_pairs(labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs ``a, b`` of different labels (``_member, _label``) that can be similar enough.

    Shingles are put in one order: first those within one label, which no such pair shares, then
    the rarer before the more frequent. Of two similar sets the first ``n - least overlap + 1``
    shingles meet. The overlap is at least ``percent`` of the larger set and, the larger one not
    being smaller, ``2 * percent / (100 + percent)`` of the smaller one. At the first shingle that two
    sets share, what either has left must still reach the overlap that the two sizes ask for: that
    rules out nearly all pairs of documents that have a form or a licence in common.
    """
    held = sets.join(small_side(labels.toDF("id", "_label")), "id")
    held = held.select("id", "_label", F.size("set").alias("_n"), F.xxhash64("set").alias("_set"), F.explode("set").alias("_one"))
    counts = held.groupBy("_one").agg(
        F.min("_label").alias("_low"), F.max("_label").alias("_high"), F.count(F.lit(1)).alias("_times")
    )
    counts = small_side(saved(counts.where("_low < _high").select("_one", "_times"), "shared_shingles"))
    ranked = held.join(counts, "_one").groupBy("id", "_label", "_n", "_set").agg(
        F.array_sort(F.collect_list(F.struct("_times", "_one"))).alias("_shared")
    )
    first = F.col("_n") - F.size("_shared")
    index = F.col("_n") - F.ceil(2 * percent * F.col("_n") / (100 + percent) - 1e-9) + 1 - first
    probe = F.col("_n") - F.ceil(percent * F.col("_n") / 100 - 1e-9) + 1 - first
    ranked = saved(ranked.withColumn("_index", index).withColumn("_probe", probe), "prefixes")

    def prefix(length: str, suffix: str, bands: Column) -> DataFrame:
        some = ranked.where(f"{length} > 0").select(
            "id", "_label", "_n", (F.col("_n") - F.size("_shared")).alias("_first"), F.explode(bands).alias("_band"),
            F.posexplode(F.expr(f"slice(_shared, 1, int({length}))")).alias("_pos", "_one"),
        )
        left = (F.col("_n") - F.col("_first") - F.col("_pos")).alias("_left")
        some = some.select("_band", F.col("_one._one").alias("_one"), "id", "_label", "_n", left)
        return some.select("_band", "_one", *(F.col(c).alias(f"{c}{suffix}") for c in ("id", "_label", "_n", "_left")))

    # Sizes that can be similar are in one band or in neighbouring ones.
    band = F.floor(F.log("_n") / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("_n").cast("bigint")
    small, large = prefix("_index", "x", F.array(band)), prefix("_probe", "y", F.array(band, band - 1))
    less = F.struct("_nx", "idx") < F.struct("_ny", "idy")
    fits = (F.col("_labelx") != F.col("_labely")) & less & (100 * F.col("_nx") >= percent * F.col("_ny"))
    # Of the first shingle that both have, in order, this and what is left behind it bounds the overlap.
    overlap = F.ceil(percent * (F.col("_nx") + F.col("_ny")) / (100 + percent) - 1e-9)
    fits = fits & (F.least("_leftx", "_lefty") >= overlap)
    both = small.join(large, (small["_one"] == large["_one"]) & (small["_band"] == large["_band"]) & fits)
    return both.select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")).distinct()


def _text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _numbered(texts: DataFrame) -> tuple[DataFrame, int | None]:
    """``_id, _text, _hash`` with an id beyond all others for every text that has none, and the greatest real id.

    The latter is null if all rows have ids.
    """
    ids = texts.agg(F.count_if(F.col("_id").isNull()).alias("n"), F.max("_id").alias("most")).first()
    if not ids["n"]:
        return texts, None
    most = -1 if ids["most"] is None else ids["most"]
    unnamed = texts.where("_id IS NULL").drop("_id")
    kinds = saved(unnamed.select("_hash").distinct().withColumn("_at", F.monotonically_increasing_id()), "unnamed")
    part = F.shiftright("_at", 33)
    starts, after = [], most + 1
    for row in kinds.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect():
        starts.append((row["_part"], after))
        after += row["n"]
    if after > 2**63:
        raise ValueError("no ids are left above the greatest for the rows without one")
    starts = saved(texts.sparkSession.createDataFrame(starts, "_part BIGINT, _start BIGINT"), "starts")
    given = kinds.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        "_hash", (F.col("_start") + F.col("_at") - F.shiftleft("_part", 33)).alias("_id")
    )
    given = lookup_join(unnamed, saved(given, "given"), ["_hash"], "inner")
    return texts.where("_id IS NOT NULL").unionByName(given), most


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id, kept``.

    Words are what ASCII white space separates, A-Z as a-z. A text's set is its distinct shingles
    of ``width`` words, or its whole sequence if shorter. Texts are linked if their sets' Jaccard
    similarity is at least ``percent`` / 100. ``component_id`` is the smallest id reachable. Null
    texts and texts without words have an empty set and no link. Equal ids are one node of the
    graph. Of rows with a null id each text is a node of its own: they take the component of the
    ids they are linked to; where there is none it is null and one text is ``kept``. An empty table gives an empty result; other columns are not read.

    A shingle is a 64-bit hash here. Two texts at exactly 0.75 share no bucket with probability
    (1 - 0.75 ** 4) ** 32 = 5e-6; the chance falls steeply above.
    """
    found = _grouped(docs, id_column, text_column, width, percent, bands, rows)
    return found.drop("_hash")


def _grouped(
    docs: DataFrame, id_column: str, text_column: str, width: int, percent: int, bands: int, rows: int
) -> DataFrame:
    """As ``near_duplicates``, with a 128-bit hash of the text."""
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("_text"), _text_hash(F.col(text_column)).alias("_hash")
    )
    texts, most = _numbered(texts)
    ddl = "doc_id BIGINT, n_shingles BIGINT, _digest BINARY, _bands ARRAY<BIGINT>, _hash STRING"
    features = saved(texts.mapInArrow(_features(width, bands, rows), ddl), "features")
    repeated = features.where("n_shingles > 0").groupBy("_digest").agg(
        F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n")
    )
    repeated = small_side(saved(repeated.where("_n > 1").select("_digest", "_least"), "classes"))
    classed = features.join(repeated, "_digest", "left").withColumn("_node", F.coalesce("_least", "doc_id"))

    nodes = classed.where("n_shingles > 0 AND doc_id = _node")
    buckets = nodes.select(F.explode("_bands").alias("_key"), F.col("_node").alias("_member"))
    full = buckets.groupBy("_key").agg(
        F.min("_member").alias("_least"), F.max("_member").alias("_most"), F.count(F.lit(1)).alias("_n")
    )
    shared = full.where("_least < _most").select("_key", "_n")
    members = saved(buckets.join(shared, "_key"), "buckets")
    popular = members.groupBy("_member").agg(F.least(F.sum("_n"), F.lit(2**31 - 1)).alias("_others"))
    order = F.shiftleft("_others", 32) + F.pmod(F.xxhash64("_member"), F.lit(2**32))
    members = saved(members.join(popular, "_member").select("_key", "_member", order.alias("_order")), "members")

    ids = saved(members.select(F.col("_member").alias("_id")).distinct(), "candidates")
    chosen = texts.join(small_side(ids), "_id", "left_semi").repartition("_id")
    sets = saved(chosen.mapInArrow(_sets(width), "id BIGINT, set ARRAY<BIGINT>"), "sets")

    labels, turn = None, 0
    while True:
        if labels is None:
            known = members.withColumn("_label", F.col("_member"))
        else:
            known = members.join(labels.toDF("_member", "_found"), "_member", "left").select(
                "_key", "_member", "_order", F.coalesce("_found", "_member").alias("_label")
            )
        # Buckets with one component have nothing left to link.
        state = known.groupBy("_key").agg(
            F.min("_label").alias("_low"), F.max("_label").alias("_high"), F.max("_order").alias("_first")
        )
        open_ = known.join(state.where("_low < _high").select("_key", "_first"), "_key")
        open_ = saved(open_.withColumn("_centre", F.col("_order") == F.col("_first")).drop("_first"), "open")
        stars = open_.where("_centre").select("_key", F.col("_member").alias("_hub"), F.col("_label").alias("_own"))
        spokes = open_.join(stars, "_key").where("_label <> _own AND _member <> _hub")
        pairs = spokes.select(F.least("_hub", "_member").alias("a"), F.greatest("_hub", "_member").alias("b")).distinct()
        links = saved(confirmed(pairs, sets, percent), "links")
        turn += 1
        members = open_.where("NOT _centre").select("_key", "_member", "_order")
        if not links.isEmpty():
            labels = _merge(labels, links)
        elif turn >= SURE_ROUNDS:
            # Centres were compared with their whole buckets; labels are those of this round.
            rest = open_.where("NOT _centre").select("_key", "_member", "_label")
            state = rest.groupBy("_key").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"))
            rest = rest.join(state.where("_low < _high").select("_key"), "_key").select("_member", "_label").distinct()
            rest = saved(rest, "rest")
            if not rest.isEmpty():
                links = saved(confirmed(_rest_pairs(rest, sets, percent), sets, percent), "links")
                labels = labels if links.isEmpty() else _merge(labels, links)
            break
        if members.isEmpty():
            break
    if labels is not None:
        found = small_side(labels.toDF("_node", "_component"))
        classed = classed.join(found, "_node", "left")
        component = F.coalesce("_component", "_node")
    else:
        component = F.col("_node")
    real = (lambda c: c) if most is None else (lambda c: F.when(c <= most, c))
    return classed.select(
        real(F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        real(component).alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "_hash",
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group stays, with all its columns."""
    found = _grouped(docs, id_column, text_column, WIDTH, PERCENT, BANDS, ROWS)
    gone = saved(found.where("NOT kept").select("doc_id", "_hash"), "dropped")
    return without(docs, gone, {"doc_id": F.col(id_column).cast("bigint"), "_hash": _text_hash(F.col(text_column))})
