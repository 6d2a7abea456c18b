"""Rating and label functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placepulse.schema import LABELS, UNKNOWN_LABEL, id_to_label, label_to_id

__all__ = ["display_label", "id_to_label", "label_to_id", "parse_stars", "sentiment3", "sentiment_label"]


def parse_stars(c: Column) -> Column:
    """``"5 stars"`` to 5: the first word as a number."""
    return F.split(c, " ")[0].try_cast("int")


def sentiment_label(rating: Column) -> Column:
    """Rating 1..5 to its class name; anything else, null included, is ``unknown``."""
    label = F.when(rating == 1, LABELS[0])
    for stars, name in enumerate(LABELS[1:], start=2):
        label = label.when(rating == stars, name)
    return label.otherwise(UNKNOWN_LABEL)


def sentiment3(rating: Column) -> Column:
    """Rating to Positive (4, 5), Neutral (3) or Negative (1, 2); null outside 1..5."""
    return (
        F.when(rating.isin(4, 5), "Positive")
        .when(rating == 3, "Neutral")
        .when(rating.isin(1, 2), "Negative")
    )


def display_label(c: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))
