"""Encode features, train and evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.operators.columns import rename_label
from placepulse.operators.filters import require_labels
from placepulse.operators.joins import encode_labels
from placepulse.operators.metrics import classification_report, weighted_metrics
from placepulse.operators.profiling import label_audit
from placepulse.operators.tokens import build_vocab, encode_tokens
from placepulse.operators.training import Params, Selection, predict, save_model, select_best
from placepulse.schema import MAX_TOKENS, label_vocab
from placepulse.session import durable
from placepulse.sources.files import write_label_map, write_parquet

FEATURE_COLUMNS = ("review_id", "label", "cleaned_text")


@dataclass(frozen=True)
class Encoded:
    """Token ids of all splits, the vocabulary and the audit of unusable labels."""

    features: DataFrame
    vocab: DataFrame
    labels: DataFrame
    audit: DataFrame


def encode_features(
    split: DataFrame,
    vocab_size: int = 50_000,
    max_len: int = MAX_TOKENS,
    output: str | None = None,
    id_column: str = "review_id",
) -> Encoded:
    """Label ids and token ids for every split, with the vocabulary taken from training only.

    Only the id, the split and the label accompany the tokens: the predicted rating, of which
    the label is a function, is not a feature.
    """
    audit = label_audit(split)
    mapped = rename_label(encode_labels(split)).where(F.col("label").isNotNull())
    train = mapped.where(F.col("split") == "train")
    vocab = durable(build_vocab(train, vocab_size))
    slim = mapped.select(id_column, "split", "label", "cleaned_text")
    features = encode_tokens(slim, vocab, max_len=max_len)
    labels = label_vocab(split.sparkSession)
    if output:
        features.write.mode("overwrite").partitionBy("split").parquet(f"{output}/features")
        write_parquet(vocab, f"{output}/vocab")
        write_label_map(split.sparkSession, f"{output}/labels")
    return Encoded(features, vocab, labels, audit)


@dataclass(frozen=True)
class Evaluation:
    """The chosen model with its scores on the test set."""

    selection: Selection
    predictions: DataFrame
    metrics: DataFrame
    report: DataFrame


def train_and_evaluate(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    grid: Sequence[Params] = (Params(),),
    model_path: str | None = None,
    text: str = "cleaned_text",
) -> Evaluation:
    """Check the labels, train over the grid, keep the best model, report on the test set.

    Training and validation data are read once per trial and are therefore made durable.
    """
    train = durable(require_labels(train, training=True))
    validation = durable(require_labels(validation))
    best = select_best(train, validation, grid, text=text)
    predictions = durable(predict(best.model, require_labels(test)))
    if model_path:
        save_model(best.model, model_path)
    return Evaluation(best, predictions, weighted_metrics(predictions), classification_report(predictions))
