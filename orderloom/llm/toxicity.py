"""Toxicity by non-negative positive-unlabelled learning.

Known are some toxic texts and a sample of all texts, whatever they are. With the share of toxic
texts (the class prior) the risk on clean texts is that on the sample less the part the toxic
ones have in it. That difference cannot be negative in truth; where it becomes so on the
training rows, the classifier has begun to learn them by heart and the step is taken back.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..session import handed_over, release
from .shared import content, slices, travels

travels(__name__)

WORDS = regex.compile(r"\p{L}+")
#: Beginnings of words that count as features of their own.
BEGINNINGS = (4, 5)
#: Texts the fit uses: this many toxic ones at most, and about this many of all.
TOXIC_ROWS, ALL_ROWS = 2_000, 6_000
#: Features of the model at most, those in most toxic texts first.
FEATURES = 50_000
#: A feature is used if it is in so many toxic texts, and so many deviations above chance.
LEAST, DEVIATIONS = 3, 4.0
STEPS, RATE, DECAY = 600, 0.05, 5e-4
#: Words a worker remembers; when full it forgets them all, which changes no result.
REMEMBERED = 200_000


class Model(NamedTuple):
    features: dict[str, int]
    weights: np.ndarray
    bias: float


def word_features(word: str) -> list[str]:
    return [word, *["^" + word[:n] for n in BEGINNINGS if len(word) >= n]]


def text_features(text: str) -> list[str]:
    """Distinct features of a whole text. A beginning that several of its words share counts as
    one more feature."""
    found: set[str] = set()
    for word in set(WORDS.findall(text.lower())):
        for feature in word_features(word):
            found.add("2" + feature if feature in found else feature)
    return sorted(found)


class Rows(NamedTuple):
    """Sparse rows of ones: the columns of all rows, and where each row starts."""

    columns: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(rows: list) -> "Rows":
        sizes = [len(r) for r in rows]
        columns = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if rows else []
        return Rows(np.asarray(columns, dtype=np.int64), np.r_[0, np.cumsum(sizes)].astype(np.int64))

    def times(self, weights: np.ndarray) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(weights[self.columns])]
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def transposed_times(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(
            self.columns, np.repeat(values, np.diff(self.starts)), minlength=width
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def train(
    toxic: Rows, sample: Rows, width: int, prior: float, steps: int = STEPS, rate: float = RATE,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier, by gradient steps on the corrected risk."""
    weights, bias = np.zeros(width), float(np.log(prior / (1.0 - prior)))
    mean, spread = np.zeros(width + 1), np.zeros(width + 1)
    n_toxic, n_all = max(1, len(toxic.starts) - 1), max(1, len(sample.starts) - 1)
    for step in range(1, steps + 1):
        on_toxic, on_all = toxic.times(weights) + bias, sample.times(weights) + bias
        # risk of calling clean texts toxic: that of the sample less the toxic texts in it
        clean_risk = (
            np.logaddexp(0.0, on_all).mean() - prior * np.logaddexp(0.0, on_toxic).mean()
        )
        clean_all, clean_toxic = _sigmoid(on_all) / n_all, -prior * _sigmoid(on_toxic) / n_toxic
        if clean_risk >= 0:
            pull_toxic = clean_toxic - prior * _sigmoid(-on_toxic) / n_toxic
            pull_all = clean_all
        else:
            pull_toxic, pull_all = -clean_toxic, -clean_all
        slope = np.r_[
            toxic.transposed_times(pull_toxic, width) + sample.transposed_times(pull_all, width)
            + DECAY * weights,
            pull_toxic.sum() + pull_all.sum(),
        ]
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope * slope
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def fit(
    docs: DataFrame, toxic_ids: DataFrame, prior: float, text: str = "text", key: str = "doc_id",
    toxic_rows: int = TOXIC_ROWS, all_rows: int = ALL_ROWS,
) -> Model:
    """A classifier from documents, keys of confirmed toxic ones, and the share of toxic texts.

    At most ``toxic_rows`` toxic texts and about ``all_rows`` of all texts are used, chosen by a
    hash of the key, and at most FEATURES features; that bounds what the driver holds. Without a
    toxic text the model has no features and its scores are the prior.
    """
    draw = F.xxhash64(F.col(key), F.lit("toxicity"))
    share = min(1.0, all_rows / max(1, docs.count()))
    confirmed = (
        toxic_ids.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
        .orderBy(draw, key).limit(toxic_rows).select(F.col(key).alias("_toxic"))
    )
    in_sample = F.pmod(draw, F.lit(1_000_000)) < int(share * 1_000_000)
    chosen = (
        docs.select(F.col(key), content(text).alias("_text"))
        .join(F.broadcast(confirmed), F.col(key) == F.col("_toxic"), "left")
        .select("_text", F.col("_toxic").isNotNull().alias("toxic"),
                F.coalesce(in_sample, F.lit(False)).alias("sampled"))
        .where("toxic OR sampled")
    )

    def spell(frames):
        for frame in frames:
            yield pd.DataFrame({
                "toxic": frame["toxic"], "sampled": frame["sampled"],
                "features": [text_features(t) for t in frame["_text"]],
            })

    rows = handed_over(
        chosen.mapInPandas(spell, "toxic boolean, sampled boolean, features array<string>"),
        "spelled",
    )
    sizes = rows.agg(F.count_if("toxic").alias("t"), F.count_if("sampled").alias("a")).first()
    chance = F.col("in_all") + 1.0
    chance = chance / F.lit(float(sizes.a + 1)) * F.lit(float(sizes.t))
    used = (
        rows.select("toxic", "sampled", F.explode("features").alias("feature"))
        .groupBy("feature").agg(
            F.count_if("toxic").alias("in_toxic"), F.count_if("sampled").alias("in_all"))
        .where((F.col("in_toxic") >= LEAST)
               & ((F.col("in_toxic") - chance) / F.sqrt(chance + 1) >= DEVIATIONS))
        .orderBy(F.desc("in_toxic"), "feature").limit(FEATURES).toPandas()
    )
    features = {f: i for i, f in enumerate(used["feature"])}
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not features:
        release(rows)
        return Model({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    held = rows.sparkSession.sparkContext.broadcast(features)

    def number(frames):
        for frame in frames:
            known = held.value
            yield pd.DataFrame({
                "toxic": frame["toxic"], "sampled": frame["sampled"],
                "columns": [[known[f] for f in fs if f in known] for fs in frame["features"]],
            })

    matrix = rows.mapInPandas(
        number, "toxic boolean, sampled boolean, columns array<int>"
    ).toPandas()
    release(rows)
    weights, bias = train(
        Rows.of(list(matrix.loc[matrix["toxic"], "columns"])),
        Rows.of(list(matrix.loc[matrix["sampled"], "columns"])), len(features), prior,
    )
    return Model(features, weights, bias)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns but the text, and score (0 to 1) and predicted (1 from 0.5 on).

    A null text counts as empty; an empty text has the score of a text without any feature.
    """
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))
    others = [c for c in docs.columns if c not in (text, "score", "predicted")]
    schema = docs.select(*others).schema.add("score", "double").add("predicted", "integer")

    def score(batches):
        features, weights, bias = held.value
        known: dict[str, tuple[tuple[str, int, int], ...]] = {}
        for batch in slices(batches):
            sums = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                seen: set[str] = set()
                found: set[int] = set()
                for w in set(WORDS.findall(t.lower())):
                    columns = known.get(w)
                    if columns is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        columns = known[w] = tuple(
                            (f, features.get(f, -1), features.get("2" + f, -1))
                            for f in word_features(w) if f in features or "2" + f in features
                        )
                    for feature, once, again in columns:
                        found.add(again if feature in seen else once)
                        seen.add(feature)
                found.discard(-1)
                sums.append(bias + float(weights[sorted(found)].sum()) if found else bias)
            chance = _sigmoid(np.array(sums, dtype=float))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(chance, pa.float64()),
                 pa.array((chance >= 0.5).astype(np.int32), pa.int32())],
                names=[*others, "score", "predicted"],
            )

    return docs.select(*others, content(text).alias("_scored")).mapInArrow(score, schema)
