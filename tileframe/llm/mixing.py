"""Mixing documents to target shares of domains, with soft membership; DataFrame functions only.

A labelled table gives some documents a domain. A naive Bayes classifier over hashed words turns that into
a probability for every domain and document; evidence grows with the root of a text's length, so that long texts
stay soft. Documents then get nonnegative rates (expected copies): projected gradient descent on the squared
distance between each domain's expected tokens and its target. The gradient of a document depends on its
probabilities and one number per domain, so an iteration is one aggregate over a narrow table, and only a
handful of sums reach the driver. Rates start at one, and stay near one where the targets allow it.

Where ``ITERATIONS`` steps do not bring every domain within ``TOLERANCE`` of the budget, the rates nearest to one that meet
the targets are found exactly: they are ``max(0, 1 - p . v)`` for one number ``v`` per domain, by Newton's method with line
search on the convex dual problem. It goes on until the tolerance is met. Targets that no rates can meet get the rates that
come nearest to them, and a warning that names the shares reached.

``LABELLED`` bounds the labelled documents from which the classifier is fitted (chosen by a hash of the id);
everything else covers all documents. Tokens are words between ASCII white space.

Defined results: a null or empty text has no words and the classifier's prior; a null id is never labelled; a label row with
a null is no label; an id labelled several times counts for each; without any labels there is one domain and all rates
are one; a domain nobody is labelled with drops out of the targets. Repeated rows get the same rate each. Only the
named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import settled, stored, text_or_empty, words_of

LABELLED = 20_000
BUCKETS = 2048
TARGETS = {"good": 0.90, "low": 0.08, "toxic": 0.02}
ITERATIONS, TOLERANCE = 40, 1e-3
#: A share of the budget: keeps the dual problem bounded where the targets cannot be met, far below the tolerance elsewhere.
_PULL = 1e-8
_SEED = 17


@dataclass
class Model:
    """Classifier and rates: log priors, log odds of words by domain, and the steps of the descent."""

    domains: list[str]
    prior: list[float]
    odds: list[list[float]]
    steps: list[list[float]] = field(default_factory=list)


def domain_of_labels() -> Column:
    """The domain of a row of ``labels``."""
    return (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    )


def _sql(values: list) -> str:
    return "array(" + ", ".join(_sql(v) if isinstance(v, list) else f"{v!r}D" for v in values) + ")"


def _numbers(values: list) -> Column:
    """A constant array of doubles, or of arrays of doubles."""
    return F.expr(_sql(values))


def _buckets(text: str) -> Column:
    words = words_of(text_or_empty(text))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def fit_classifier(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """``labelled``: ``key, domain``. Counts of hashed words by domain come to the driver: a table of fixed size."""
    known = labelled.where(F.col(key).isNotNull() & F.col("domain").isNotNull()).select(
        F.col(key).alias("_id"), F.col("domain").alias("_domain")
    )
    total = known.count()
    if total > LABELLED:
        share = int(LABELLED / total * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share)
    # At most about LABELLED short lines: a proven bound.
    rows = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(known), "_id")
    counted = rows.select("_domain", F.explode_outer(_buckets("_text")).alias("_b")).groupBy("_domain", "_b").count()
    counts, docs_of = {}, {r["_domain"]: r["count"] for r in rows.groupBy("_domain").count().collect()}
    domains = sorted(docs_of)
    for d in domains:
        counts[d] = [0.0] * BUCKETS
    for r in counted.where("_b IS NOT NULL").collect():
        counts[r["_domain"]][r["_b"]] = float(r["count"])
    if not domains:
        return Model(["all"], [0.0], [[0.0] * BUCKETS])
    every = [sum(counts[d][b] for d in domains) + 1.0 for b in range(BUCKETS)]
    size = sum(every)
    odds = []
    for d in domains:
        own = sum(counts[d]) + BUCKETS
        odds.append([math.log((counts[d][b] + 1.0) / own) - math.log(every[b] / size) for b in range(BUCKETS)])
    n = sum(docs_of.values())
    return Model(domains, [math.log(docs_of[d] / n) for d in domains], odds)


def with_membership(rows: DataFrame, text: str, model: Model) -> DataFrame:
    """``rows`` with ``n_words`` and ``p``, the probabilities of the model's domains."""
    out = rows.withColumn("_buckets", _buckets(text)).withColumn("n_words", F.size("_buckets").cast("long"))
    sums = []
    for prior, odds in zip(model.prior, model.odds, strict=True):
        out = out.withColumn("_odds", _numbers(odds))
        total = F.aggregate("_buckets", F.lit(0.0), lambda a, b: a + F.get("_odds", b))
        name = f"_s{len(sums)}"
        out = out.withColumn(name, F.lit(prior) + total / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double")))
        sums.append(F.col(name))
    top = F.greatest(*sums) if len(sums) > 1 else sums[0]
    out = out.withColumn("_e", F.array(*[F.exp(s - top) for s in sums]))
    whole = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("_whole", whole).withColumn("p", F.transform("_e", lambda x: x / F.col("_whole")))
    return out.drop("_buckets", "_odds", "_e", "_whole", *[f"_s{i}" for i in range(len(sums))])


def rate_of(model: Model) -> Column:
    """The rate of a row with ``p``: all steps of the descent, each cut off at zero."""
    if not model.steps:
        return F.lit(1.0)

    def step(rate: Column, move: Column) -> Column:
        dots = [F.get(F.col("p"), F.lit(i)) * F.get(move, F.lit(i)) for i in range(len(model.domains))]
        total = dots[0]
        for d in dots[1:]:
            total = total + d
        return F.greatest(F.lit(0.0), rate - total)

    return F.aggregate(_numbers(model.steps), F.lit(1.0), step)


def fit_rates(soft: DataFrame, model: Model, targets: dict[str, float], budget: float | None = None) -> Model:
    """Append the steps of the descent. ``soft`` (stored) has ``n_words, p``. ``budget``: tokens wanted in all; by default
    so many that the first of ``targets`` that is present is used whole."""
    shares = {d: targets.get(d, 0.0) for d in model.domains}
    if not sum(shares.values()):
        return model
    k = range(len(model.domains))
    mass = [F.coalesce(F.sum(F.col("n_words") * F.get("p", F.lit(i))), F.lit(0.0)) for i in k]
    have = list(soft.agg(*[m.alias(f"m{i}") for i, m in enumerate(mass)]).first())
    whole = sum(shares.values())
    if budget is None:
        lead = next(d for d in targets if shares.get(d))
        budget = have[model.domains.index(lead)] / (shares[lead] / whole)
    wanted = [budget * shares[d] / whole for d in model.domains]
    for _ in range(ITERATIONS):
        rated = soft.withColumn("_w", F.col("n_words") * rate_of(model))
        got = list(rated.agg(*[F.coalesce(F.sum(F.col("_w") * F.get("p", F.lit(i))), F.lit(0.0)) for i in k]).first())
        miss = [g - w for g, w in zip(got, wanted, strict=True)]
        if max(map(abs, miss)) <= TOLERANCE * max(budget, 1.0):
            return model
        model.steps.append([m / h if h > 0 else 0.0 for m, h in zip(miss, have, strict=True)])
    return nearest_rates(soft, model, np.array(wanted), max(budget, 1.0))


def nearest_rates(soft: DataFrame, model: Model, wanted: np.ndarray, budget: float) -> Model:
    """The rates ``max(0, 1 - p . v)`` that meet the targets, as a model with the one step ``v``."""
    k = range(len(wanted))

    def look(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Value of the dual function, tokens of each domain, and the tokens that move with ``v``; one pass."""
        step = Model(model.domains, model.prior, model.odds, [v.tolist()])
        rows = soft.select(F.col("n_words").alias("_n"), "p", rate_of(step).alias("_r"))
        p = [F.get("p", F.lit(i)) for i in k]
        live = F.when(F.col("_r") > 0, F.col("_n")).otherwise(0)
        sums = [F.col("_n") * F.col("_r") * F.col("_r")] + [F.col("_n") * F.col("_r") * x for x in p] + [live * x * y for x in p for y in p]
        found = np.array(rows.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(f"_{i}") for i, x in enumerate(sums)]).first(), dtype=float)
        value = 0.5 * found[0] + v @ wanted + 0.5 * _PULL * budget * (v @ v)
        return value, found[1 : 1 + len(wanted)], found[1 + len(wanted) :].reshape(len(wanted), len(wanted))

    v = np.zeros(len(wanted))
    value, got, moving = look(v)
    while np.abs(got - wanted).max() > TOLERANCE * budget:
        slope = wanted - got + _PULL * budget * v
        move = -np.linalg.solve(moving + _PULL * budget * np.eye(len(wanted)), slope)
        if np.abs(slope).max() <= 0.01 * TOLERANCE * budget or -(slope @ move) <= 1e-12 * abs(value):
            shares = ", ".join(f"{d} {g / budget:.4f} (wanted {w / budget:.4f})" for d, g, w in zip(model.domains, got, wanted, strict=True))
            warnings.warn(f"no rates meet the targets; tokens as shares of the budget: {shares}", stacklevel=2)
            break
        part = 1.0
        while True:
            there = look(v + part * move)
            # The slack is for sums that differ with the order of their rows.
            if there[0] <= value + 1e-4 * part * (slope @ move) + 1e-12 * abs(value):
                break
            part /= 2
        v, (value, got, moving) = v + part * move, there
    return Model(model.domains, model.prior, model.odds, [v.tolist()])


def _copies(key: Column) -> Column:
    chance = F.pmod(F.xxhash64(key, F.lit(_SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    floor = F.floor("rate").cast("long")
    return floor + (chance < F.col("rate") - floor).cast("long")


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, key: str = "doc_id", text: str = "text",
    budget: float | None = None,
) -> DataFrame:
    """Per row: the key, ``n_words``, a probability ``p_<domain>`` for each domain of ``targets``, ``rate``, and ``copies``, the
    rate rounded up or down by a hash of the key."""
    targets = targets or TARGETS
    model = fit_classifier(docs, labelled, key, text)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    soft = stored(with_membership(rows, "_text", model).drop("_text"), "membership")
    model = fit_rates(soft, model, targets, budget)
    place = {d: i for i, d in enumerate(model.domains)}
    shown = [(F.get("p", F.lit(place[d])) if d in place else F.lit(0.0)).alias(f"p_{d}") for d in targets]
    return soft.withColumn("rate", rate_of(model)).select(
        F.col("_key").alias(key), "n_words", *shown, "rate", _copies(F.col("_key")).alias("copies")
    )


def mixed(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, key: str = "doc_id", text: str = "text",
    budget: float | None = None,
) -> DataFrame:
    """``docs`` with each row repeated as often as its rate says. Texts are read, never shuffled."""
    model = fit_classifier(docs, labelled, key, text)
    rows = docs.select(F.col(f"`{text}`").alias("_text"))
    soft = stored(with_membership(rows, "_text", model).select("n_words", "p"), "membership")
    model = fit_rates(soft, model, targets or TARGETS, budget)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rated = with_membership(docs.select(whole, F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")), "_text", model)
    rated = rated.withColumn("rate", rate_of(model)).select("_row", _copies(F.col("_key")).alias("_n"))
    counted = settled(rated, "_n").where("_n > 0")
    repeated = counted.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i"))
    return repeated.select("_row.*")
