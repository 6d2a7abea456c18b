"""The five-class sentiment classifier on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.functions.text import is_blank
from placepulse.operators.metrics import class_weights, weighted_metrics
from placepulse.schema import LABELS, NO_TEXT_LABEL, id_to_label
from placepulse.session import durable

FEATURES = 1 << 16
PATIENCE = 3
WEIGHT_DECAY = 0.01


@dataclass(frozen=True)
class Params:
    """One point of the parameter grid."""

    reg_param: float = WEIGHT_DECAY
    max_iter: int = 20
    features: int = FEATURES


@dataclass(frozen=True)
class Selection:
    """The best model with its parameters and its validation F1, and the F1 of every trial."""

    model: PipelineModel
    params: Params
    f1: float
    history: tuple[float, ...]


def with_class_weight(train: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight``. The weights have one row per class of the five-label vocabulary."""
    weights = class_weights(train, label).where(F.col(label).between(0, len(LABELS) - 1))
    return train.join(F.broadcast(weights.select(label, "weight")), label)


def fit_features(train: DataFrame, features: int = FEATURES, text: str = "cleaned_text") -> PipelineModel:
    """Words hashed to ``features`` counters, weighted by inverse document frequency."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
    ]
    return Pipeline(stages=stages).fit(train)


def fit_classifier(featured: DataFrame, params: Params, label: str = "label") -> LogisticRegressionModel:
    """Multinomial logistic regression with class weights and weight decay."""
    regression = LogisticRegression(
        featuresCol="_tfidf",
        labelCol=label,
        weightCol="weight",
        family="multinomial",
        regParam=params.reg_param,
        maxIter=params.max_iter,
    )
    return regression.fit(featured)


def _featured_train(train: DataFrame, features: PipelineModel, label: str) -> DataFrame:
    """What the optimizer reads again and again, computed once: label, weight, vector."""
    return durable(features.transform(with_class_weight(train, label)).select(label, "weight", "_tfidf"))


def train_classifier(
    train: DataFrame, params: Params = Params(), text: str = "cleaned_text", label: str = "label"
) -> PipelineModel:
    """Features and classifier as one model from text to class."""
    features = fit_features(train, params.features, text)
    classifier = fit_classifier(_featured_train(train, features, label), params, label)
    return PipelineModel(stages=[*features.stages, classifier])


def predict(model: PipelineModel | LogisticRegressionModel, df: DataFrame, output: str = "predicted_sentiment") -> DataFrame:
    """Add the class id ``prediction`` and its label."""
    scored = model.transform(df)
    prediction = F.col("prediction").cast("int")
    return scored.select(*df.columns, prediction.alias("prediction"), id_to_label(prediction).alias(output))


def model_scorer(model: PipelineModel, text: str = "full_review", output: str = "predicted_sentiment"):
    """A scorer for new reviews from a fitted or loaded model: ``output`` by ``text``, blank text is ``No Text``."""

    def score(df: DataFrame) -> DataFrame:
        # The row travels as one value, so that no column of the model clashes with one of its own.
        row = F.struct(*df.columns).alias("_row")
        asked = df.select(row, F.coalesce(F.col(text), F.lit("")).alias("cleaned_text"))
        label = F.when(is_blank(F.col("cleaned_text")), NO_TEXT_LABEL).otherwise(F.col("_label"))
        return predict(model, asked, "_label").select("_row.*", label.alias(output))

    return score


def select_best(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[Params],
    patience: int = PATIENCE,
    text: str = "cleaned_text",
    label: str = "label",
) -> Selection:
    """Try the grid in order, keep the best validation F1, stop after ``patience`` misses.

    Text is turned into features once for all trials that use the same number of them.
    """
    best: Selection | None = None
    history: list[float] = []
    misses = 0
    prepared: dict[int, tuple[PipelineModel, DataFrame, DataFrame]] = {}
    for params in grid:
        if params.features not in prepared:
            features = fit_features(train, params.features, text)
            judged = durable(features.transform(validation).select(label, "_tfidf"))
            prepared[params.features] = (features, _featured_train(train, features, label), judged)
        features, featured, judged = prepared[params.features]
        classifier = fit_classifier(featured, params, label)
        f1 = weighted_metrics(predict(classifier, judged), label).first()["f1"] or 0.0
        history.append(f1)
        if best is None or f1 > best.f1:
            model = PipelineModel(stages=[*features.stages, classifier])
            best, misses = Selection(model, params, f1, ()), 0
        else:
            misses += 1
            if misses >= patience:
                break
    if best is None:
        raise ValueError("the parameter grid is empty")
    return Selection(best.model, best.params, best.f1, tuple(history))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
