"""Score what is new and publish it with per-attraction statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions.text import full_review
from placepulse.operators.columns import select_columns, with_source
from placepulse.operators.filters import drop_nulls
from placepulse.operators.joins import attach_attraction_id, new_reviews, normalize_titles
from placepulse.operators.profiling import sentiment_stats
from placepulse.operators.sets import extend_dimension, new_titles, union_sources
from placepulse.schema import ATTRACTIONS, NEW_REVIEWS, REVIEWS, SCORED_REVIEWS
from placepulse.session import durable, job_scratch
from placepulse.sources.files import read_reviews_csv, write_scored
from placepulse.sources.keys import KeyIndex
from placepulse.sources.tables import Change, TableStore

Scorer = Callable[[DataFrame], DataFrame]


def load_batch(spark: SparkSession, paths: dict[str, str | list[str]]) -> DataFrame:
    """Title, text and source of all new review files, keyed by source name; null texts dropped."""
    tables = [
        with_source(read_reviews_csv(spark, path, NEW_REVIEWS), source) for source, path in paths.items()
    ]
    batch = select_columns(union_sources(*tables), ["title", "text_review", "source"])
    return drop_nulls(batch, ["text_review"])


def score_new_reviews(
    batch: DataFrame,
    existing: DataFrame | KeyIndex,
    scorer: Scorer,
    output: str | None = None,
    without_part: str | None = None,
) -> DataFrame:
    """Label the reviews not published before: those not in the table ``existing``, or not in its index.

    With an index the cost follows the batch; ``without_part`` leaves out a part of it.

    ``scorer`` adds ``predicted_sentiment`` from ``full_review``: a fitted model wrapped by
    ``operators.training.predict`` or any model through ``operators.stars.score_with``.
    """
    batch = drop_nulls(batch, ["text_review"])
    unseen = existing.unseen(batch, without_part) if isinstance(existing, KeyIndex) else new_reviews(batch, existing)
    reviewed = unseen.withColumn("full_review", full_review(F.col("title"), F.col("text_review")))
    scored = scorer(reviewed).select(*SCORED_REVIEWS.fieldNames())
    if output:
        scored = durable(scored)
        write_scored(scored, output)
    return scored


@dataclass(frozen=True)
class Published:
    """The three published tables after a run."""

    attractions: DataFrame
    reviews: DataFrame
    stats: DataFrame


def publish_reviews(
    scored: DataFrame,
    store: TableStore,
    aliases: DataFrame,
    mode: str = "append",
    part: str | None = None,
) -> Published:
    """Normalize titles, add new attractions, add the reviews, rebuild the statistics.

    ``append`` adds to the published reviews; ``replace`` makes this batch all there is, unless
    it is empty. ``part`` names the batch, so that publishing it again changes nothing. The three
    tables change in one commit; if another writer publishes meanwhile, the work is done again on what that left.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be append or replace, not {mode!r}")
    with job_scratch(store.spark):  # all three tables are read from the store afterwards
        scored = durable(normalize_titles(scored, aliases))
        return store.changed(lambda change: _published(scored, change, mode, part))


def _published(scored: DataFrame, tables: Change, mode: str, part: str | None) -> Published:
    known = tables.read_table("attractions", ATTRACTIONS)
    titles = durable(new_titles(scored, known))
    if not titles.isEmpty():
        tables.replace_table(extend_dimension(known, titles), "attractions")
    attractions = tables.read_table("attractions", ATTRACTIONS)

    rows = attach_attraction_id(scored, attractions).select(*REVIEWS.fieldNames())
    if mode == "replace":
        tables.replace_table(rows, "reviews", skip_if_empty=True)
    else:
        tables.append_table(rows, "reviews", part)
    reviews = tables.read_table("reviews", REVIEWS)

    stats = sentiment_stats(attractions, reviews)
    tables.replace_table(stats, "sentiment_stats")
    return Published(attractions, reviews, tables.read_table("sentiment_stats", stats.schema))
