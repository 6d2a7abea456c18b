"""Mixing documents to target weights over soft domain memberships, with DataFrame functions only.

A Bernoulli naive Bayes classifier over words, fitted on the labelled table, gives every document
a posterior over domains. A document's rate is how often it is to be used; the rates are fitted by
projected gradient steps on the least squares between expected domain token totals and targets.
Each step needs the domain totals under the current rates: one aggregate of a narrow table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved, small_side

#: Domains, by what the labels say, and the shares of tokens they are to have.
TARGETS = {"clean": 0.92, "junk": 0.03, "toxic": 0.05}
#: Labelled rows the classifier is fitted on: those with the smallest hashes of their ids.
LABELLED_ROWS = 20_000
#: Words the classifier keeps: those with the largest evidence.
MODEL_WORDS = 20_000
#: How far a word's count in a domain must exceed its expectation, in standard deviations.
MIN_DEVIATION = 5.0
MIN_DOCUMENTS = 5
#: Evidence is bounded, so that memberships stay soft.
MAX_LOG_ODDS = 6.0
STEPS = 40
TOLERANCE = 1e-6


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain of a labelled row; null if neither label tells."""
    return (
        F.when(toxic == 1, "toxic")
        .when(quality == 0, "junk")
        .when(quality == 1, "clean")
    )


_BREAKS = r"[\x00-\x20.,;:!?\"()\[\]{}%#*$&|]+"


def with_words(docs: DataFrame, known: list[str] | None = None) -> DataFrame:
    """``docs`` with ``_words`` of ``_text``: its distinct words in lower case, and three marks.

    With ``known``, only words and marks out of this list: all others say nothing to the model, and
    dropped here they are never exploded. Marks stand for how often symbols, capitals and repeats
    occur, in powers of two per word. Each step is a column of its own, so that Spark computes it
    once and not in every use. Explode with ``explode_outer``: for ``explode`` Spark adds a filter
    on the array's size and pushes it below, where all steps are computed again for each use.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))

    def mark(name: str, count: str) -> Column:
        level = F.round(F.log2((F.col(count) + F.lit(0.01)) / F.col("_n"))).cast("int")
        return F.concat(F.lit(f" {name} "), F.greatest(F.lit(-4), F.least(F.lit(4), level)).cast("string"))

    # One pass leaves the few symbols and capitals, which are then told apart.
    split = docs.withColumns(
        {"_split": F.split(F.lower(text), _BREAKS), "_odd": F.regexp_replace(text, "[^%#*$&|!A-Z]+", "")}
    )
    kinds = split.withColumns(
        {
            "_kinds": F.array_distinct("_split"),
            "_n": F.greatest(F.size("_split"), F.lit(1)),
            "_symbols": F.length(F.regexp_replace("_odd", "[A-Z]+", "")),
        }
    )
    sized = kinds.withColumns({"_many": F.size("_kinds"), "_capitals": F.length("_odd") - F.col("_symbols")})
    wanted = (lambda word: word != "") if known is None else (lambda word: word.isin(known))
    marks = F.array(mark("symbols", "_symbols"), mark("capitals", "_capitals"), mark("kinds", "_many"))
    marked = sized.select(*docs.columns, "_kinds", marks.alias("_marks"))
    words = F.concat(F.filter("_kinds", wanted), F.filter("_marks", wanted))
    return marked.withColumn("_words", words).drop("_kinds", "_marks", "_text")


def fit_domains(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> tuple[DataFrame, dict]:
    """The log odds of a word by domain, at most ``MODEL_WORDS`` rows; log priors and what absence of all words says.

    Of a document labelled twice the strictest label counts. A domain never seen gets no weight.
    """
    names = list(targets)
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        domain_of(F.min("quality"), F.max("toxic")).alias("domain")
    )
    known = known.where(F.col("_id").isNotNull() & F.col("domain").isin(names)).orderBy(F.xxhash64("_id"), "_id")
    known = saved(known.limit(LABELLED_ROWS), "labelled")
    taught = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text"))
    taught = with_words(taught.join(small_side(known), "_id").select("domain", "_text"))
    sizes = {row["domain"]: row["n"] for row in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = taught.select("domain", F.explode_outer("_words").alias("word"))
    counts = words.groupBy("word").agg(
        F.count(F.lit(1)).alias("_all"), *(F.count_if(F.col("domain") == d).alias(f"n_{d}") for d in names)
    )
    total = sum(sizes.values())
    overall = F.col("_all") / total if total else F.lit(0.0)

    def share(d: str) -> Column:
        # Shrunk to the word's overall rate, so that rare words say little.
        return (F.col(f"n_{d}") + 2 * overall) / (sizes.get(d, 0) + 2) * 0.998 + 0.001

    def deviation(d: str) -> Column:
        expected = F.greatest(overall * sizes.get(d, 0), F.lit(0.5))
        return (F.col(f"n_{d}") - expected) / F.sqrt(expected)

    marked = reduce(lambda x, y: F.greatest(x, y), [deviation(d) for d in names] + [F.lit(0.0)])
    rated = counts.where((F.col("_all") >= MIN_DOCUMENTS) & (marked >= MIN_DEVIATION)).orderBy(F.desc(marked), "word")
    rated = rated.limit(MODEL_WORDS).select("word", *(share(d).alias(f"s_{d}") for d in names))
    weights = [F.log(F.col(f"s_{d}") / (1 - F.col(f"s_{d}"))).alias(f"w_{d}") for d in names]
    rated = saved(rated.select("word", *weights, *(F.log(1 - F.col(f"s_{d}")).alias(f"o_{d}") for d in names)), "domain_words")
    absent = rated.agg(*(F.coalesce(F.sum(f"o_{d}"), F.lit(0.0)).alias(d) for d in names)).first()
    priors = {d: float(np.log((sizes.get(d, 0) + 1e-3) / (total + 1e-3 * len(names)))) for d in names}
    return rated.drop(*(f"o_{d}" for d in names)), {d: (priors[d], absent[d]) for d in names}


def memberships(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``doc_id, text_hash, n_tokens`` and a posterior ``p_<domain>`` per row of ``docs``."""
    names = list(targets)
    model, priors = fit_domains(docs, labels, targets)
    known = [row["word"] for row in model.select("word").collect()]  # at most ``MODEL_WORDS``
    # Splitting at a plain blank: counting words by a pattern takes several times as long.
    blanked = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x09-\x0D]", " ")
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.size(F.array_remove(F.split(blanked, " "), "")).cast("bigint").alias("n_tokens"),
        F.col("text").alias("_text"),
    )
    rows = with_words(rows, known)
    # Exploded in a step of its own: beside a generator, the other columns are computed per word.
    rows = rows.select("_row", "doc_id", "text_hash", "n_tokens", F.explode_outer("_words").alias("word"))
    # The model has a fixed bound of rows; a document's words meet in the task that reads them.
    evidence = rows.join(F.broadcast(model), "word", "left").groupBy("_row", "doc_id", "text_hash", "n_tokens")
    summed = evidence.agg(*(F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)).alias(f"w_{d}") for d in names))
    logit = {d: F.col(f"w_{d}") + priors[d][1] for d in names}
    top = reduce(lambda x, y: F.greatest(x, y), [*logit.values(), logit[names[0]]])
    likely = {d: F.exp(F.greatest(logit[d] - top, F.lit(-MAX_LOG_ODDS)) + priors[d][0]) for d in names}
    whole = sum(likely.values(), F.lit(0.0))
    return summed.select("doc_id", "text_hash", "n_tokens", *((likely[d] / whole).alias(f"p_{d}") for d in names))


def fit_rates(members: DataFrame, targets: dict[str, float] = TARGETS, steps: int = STEPS) -> DataFrame:
    """``members`` with ``rate``, not negative, so that ``sum(rate * n_tokens * p_d)`` meets the targets.

    The total of tokens stays. The steps start at rate 1 and move in the metric of the token
    counts, preconditioned by the domains' Gram matrix; the only state between them is one number
    per domain. Targets of domains without mass are shared out among the others.
    """
    names = list(targets)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    tokens = F.col("n_tokens").cast("double")
    p = {d: F.col(f"p_{d}") for d in names}
    first = members.agg(
        F.coalesce(F.sum(tokens), F.lit(0.0)).alias("all"),
        *(F.coalesce(F.sum(tokens * p[a] * p[b]), F.lit(0.0)).alias(f"{a}*{b}") for a, b in pairs),
    ).first()
    gram = np.zeros((len(names), len(names)))
    for a, b in pairs:
        i, j = names.index(a), names.index(b)
        gram[i, j] = gram[j, i] = first[f"{a}*{b}"]
    present = np.diag(gram) > 1e-9 * max(first["all"], 1e-300)
    goal = np.array([targets[d] for d in names]) * present
    goal = goal / goal.sum() * first["all"] if goal.sum() > 0 else goal
    moves: list[list[float]] = []

    def rate() -> Column:
        if not moves:
            return F.lit(1.0)
        each = F.array(*(F.array(*(F.lit(float(x)) for x in move)) for move in moves))
        step = lambda r, y: F.greatest(F.lit(0.0), r + sum((p[d] * y[i] for i, d in enumerate(names)), F.lit(0.0)))
        return F.aggregate(each, F.lit(1.0), step)

    for _ in range(steps if present.any() else 0):
        rated = members.select("n_tokens", *p.values(), rate().alias("_rate"))
        row = rated.agg(*(F.sum(F.col("_rate") * tokens * p[d]).alias(d) for d in names)).first()
        rest = (goal - np.array([row[d] or 0.0 for d in names])) * present
        if np.abs(rest).max() <= TOLERANCE * first["all"]:
            break
        move = np.linalg.pinv(gram) @ rest
        if np.abs(move).max() <= 1e-9:
            break  # the rest is out of reach: the domains are not told apart
        moves.append(move.tolist())
    return members.withColumn("rate", rate())


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """One row per row: ``doc_id, n_tokens, p_<domain>..., rate, text_hash``.

    Null and empty texts have no tokens and the prior memberships. Null and repeated ids are rows
    like others. Without labels, or with an empty table of documents, every rate is 1. Other
    columns are not read.
    """
    return fit_rates(saved(memberships(docs, labels, targets), "memberships"), targets)


def apply_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` used at their rates: each row as many times as its rate says, the fraction decided by a hash."""
    rated = mix(docs, labels, targets).select("doc_id", "text_hash", "rate")
    chance = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    times = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("bigint")).alias("_times")
    # Rows alike in id and text have the same rate and need it once; most rows are used once.
    odd = rated.select(F.col("doc_id").alias("_rated"), F.col("text_hash").alias("_hash"), times).where("_times <> 1")
    odd = small_side(saved(odd.distinct(), "rates"))
    # The row travels as one struct, so its own names can't meet those used here.
    held = docs.select(
        F.struct("*").alias("_whole"), F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_text")
    )
    same = F.col("_id").eqNullSafe(F.col("_rated")) & F.col("_text").eqNullSafe(F.col("_hash"))
    copies = F.explode(F.array_repeat(F.lit(0), F.coalesce("_times", F.lit(1)).cast("int"))).alias("_copy")
    return held.join(odd, same, "left").select("_whole", copies).select("_whole.*")
