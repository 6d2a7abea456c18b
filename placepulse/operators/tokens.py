"""Vocabulary and token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.functions.text import words
from placepulse.operators.joins import fits_broadcast
from placepulse.schema import MAX_TOKENS

# Ids of the special tokens, ahead of the vocabulary.
PAD_ID, UNKNOWN_ID, FIRST_TOKEN_ID = 0, 1, 2


def count_terms(tokens: DataFrame, size: int) -> DataFrame:
    """The most frequent tokens ``(token, count)``; equal counts in token order."""
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), "token").limit(size)


def build_vocab(df: DataFrame, size: int, text: str = "cleaned_text") -> DataFrame:
    """The ``size`` most frequent words with their ids ``(token, count, token_id)``.

    The ids follow the rank, so the ranking sees no more than ``size`` rows.
    """
    kept = count_terms(df.select(F.explode(words(F.col(text))).alias("token")), size)
    ranked = kept.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("order"), "token"))).alias("_v")
    )
    return ranked.select(F.posexplode("_v").alias("_rank", "_entry")).select(
        F.col("_entry.token").alias("token"),
        (-F.col("_entry.order")).alias("count"),
        (F.col("_rank") + FIRST_TOKEN_ID).cast("int").alias("token_id"),
    )


def encode_tokens(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "cleaned_text",
    max_len: int = MAX_TOKENS,
) -> DataFrame:
    """Replace the text by ``input_ids`` and ``attention_mask``, both of length ``max_len``.

    Words beyond the length are cut, missing ones are padded, and a word outside the vocabulary
    has the unknown id. One row comes out per row, whatever its other columns hold, and nothing is
    shuffled: the vocabulary is sent to the tasks, and one that measures too large for that raises
    an error. A task looks up each different word of a batch once.
    """
    entries = vocab.select("token", "token_id")
    if not fits_broadcast(entries):
        raise ValueError("the vocabulary is too large to be sent to every task")
    shared = df.sparkSession.sparkContext.broadcast({row["token"]: row["token_id"] for row in entries.collect()})

    @F.arrow_udf("array<int>")
    def look_up(batch: pa.Array) -> pa.Array:
        coded = batch.flatten().dictionary_encode()
        known = shared.value
        ids = pa.array([known.get(word, UNKNOWN_ID) for word in coded.dictionary.to_pylist()], pa.int32())
        ends = np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.ListArray.from_arrays(offsets, ids.take(coded.indices))

    kept = [name for name in df.columns if name != text]
    head = F.slice(words(F.coalesce(F.col(text), F.lit(""))), 1, max_len)
    found = df.select(*kept, look_up(head).alias("_ids"))
    n = F.size("_ids")
    pad = F.lit(max_len) - n
    return found.select(
        *kept,
        F.concat("_ids", F.array_repeat(F.lit(PAD_ID), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
    )
