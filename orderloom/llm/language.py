"""Language identification by unigram pieces, summed over all segmentations.

The pieces are the byte strings of a fixed public vocabulary. Each language has a probability
for every piece; a word's probability in a language is the sum over all ways to cut it into
pieces, computed by a forward pass over its bytes, and a text's is the product over its words.
The probabilities are fitted by expectation-maximisation: a backward pass gives the expected
number of times that each piece was used.
"""

from __future__ import annotations

import base64
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ..session import handed_over, release
from .shared import content, slices, travels

travels(__name__)

UNKNOWN = "und"
#: Labelled rows of each language that the fit uses, in expectation.
SAMPLE_ROWS = 1000
ROUNDS = 3
#: Added to every expected count.
SMOOTHING = 0.01
#: Each byte is scaled by this, so that words of up to LONG bytes stay in a double's range.
SCALE = 16.0
LONG = 56
#: Words a worker remembers; when full it forgets them all, which changes no result.
REMEMBERED = 250_000
LETTERS = regex.compile(r"\p{L}+")


def read_pieces(path: str) -> list[str]:
    """Byte strings of a rank file, each byte as the letter of the same number."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]).decode("latin-1") for line in file if line.strip()]


def as_bytes(word: str) -> str:
    """A word with the space before it, one letter per UTF-8 byte."""
    return " " + word.encode("utf-8", "replace").decode("latin-1")


class Cuts(NamedTuple):
    """Every place of every piece in some words, ordered by the end of the piece."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    sizes: np.ndarray


class Pieces:
    """Finds the pieces in words."""

    def __init__(self, pieces: list[str]):
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        for number, piece in enumerate(pieces):
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()

    def cuts(self, words: list[str]) -> Cuts:
        rows, ends, found = [], [], []
        for row, word in enumerate(words):
            hits = list(self.automaton.iter(word))
            rows.append(len(hits))
            for end, number in hits:
                ends.append(end)
                found.append(number)
        row = np.repeat(np.arange(len(words)), rows)
        end = np.array(ends, dtype=np.int64) + 1
        piece = np.array(found, dtype=np.int64)
        order = np.argsort(end, kind="stable")
        row, end, piece = row[order], end[order], piece[order]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        return Cuts(row, end - self.lengths[piece], end, piece, sizes)


def forward(cuts: Cuts, weight: np.ndarray) -> np.ndarray:
    """Scaled sums over the segmentations of every prefix: word, place, column of ``weight``.

    ``weight`` has a row for every cut, the scaled probability of its piece in each column.
    """
    alpha = np.zeros((len(cuts.sizes), int(cuts.sizes.max(initial=0)) + 1, weight.shape[1]))
    alpha[:, 0] = 1.0
    bounds = np.searchsorted(cuts.end, np.arange(1, alpha.shape[1] + 1))
    for place in range(1, alpha.shape[1]):
        part = slice(bounds[place - 1], bounds[place])
        row = cuts.row[part]
        if not len(row):
            continue
        gains = alpha[row, cuts.start[part]] * weight[part]
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        alpha[row[firsts], place] = np.add.reduceat(gains, firsts, axis=0)
    return alpha


def expected(cuts: Cuts, weight: np.ndarray, alpha: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected number of uses of every cut, each word seen ``times`` times."""
    beta = np.zeros_like(alpha)
    beta[np.arange(len(cuts.sizes)), cuts.sizes] = 1.0
    order = np.lexsort((cuts.row, cuts.start))
    starts = cuts.start[order]
    bounds = np.searchsorted(starts, np.arange(0, alpha.shape[1] + 1))
    for place in range(alpha.shape[1] - 2, -1, -1):
        part = order[bounds[place]:bounds[place + 1]]
        if not len(part):
            continue
        row = cuts.row[part]
        gains = beta[row, cuts.end[part]] * weight[part]
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        beta[row[firsts], place] += np.add.reduceat(gains, firsts, axis=0)
    whole = alpha[np.arange(len(cuts.sizes)), cuts.sizes, 0]
    use = alpha[cuts.row, cuts.start, 0] * weight[:, 0] * beta[cuts.row, cuts.end, 0]
    return use / whole[cuts.row] * times[cuts.row]


def long_uses(pieces: Pieces, word: str, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every cut's piece in a word of any length, and its expected number of uses.

    The same forward and backward pass on logarithms, which stay in range however long the word.
    """
    starts, ends, found = [], [], []
    for end, number in pieces.automaton.iter(word):
        starts.append(end + 1 - int(pieces.lengths[number]))
        ends.append(end + 1)
        found.append(number)
    start, end, piece = np.array(starts), np.array(ends), np.array(found)
    chance = logs[piece]
    alpha, beta = np.full(len(word) + 1, -np.inf), np.full(len(word) + 1, -np.inf)
    alpha[0] = beta[len(word)] = 0.0
    bounds = np.searchsorted(end, np.arange(len(word) + 2))
    for place in range(1, len(word) + 1):
        part = slice(bounds[place], bounds[place + 1])
        alpha[place] = np.logaddexp.reduce(alpha[start[part]] + chance[part])
    order = np.argsort(start, kind="stable")
    bounds = np.searchsorted(start[order], np.arange(len(word) + 2))
    for place in range(len(word) - 1, -1, -1):
        part = order[bounds[place]:bounds[place + 1]]
        beta[place] = np.logaddexp.reduce(beta[end[part]] + chance[part])
    return piece, np.exp(alpha[start] + chance + beta[end] - alpha[len(word)])


class Model(NamedTuple):
    """Languages, and the log probability of every piece (row) in each of them (column)."""

    languages: list[str]
    pieces: list[str]
    logs: np.ndarray


class Scorer:
    """Log probabilities of words in all languages, remembered from text to text."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.pieces)
        lengths = self.pieces.lengths[:, None]
        self.scaled = np.exp(model.logs) * SCALE**lengths
        self.places: dict[str, int] = {}
        self.vectors = np.zeros((0, len(model.languages)))

    def long_word(self, word: str) -> np.ndarray:
        """The same forward pass with a scale of its own at every byte."""
        sums, log_scale = {0: np.ones(len(self.model.languages))}, 0.0
        hits: dict[int, list[int]] = {}
        for end, number in self.pieces.automaton.iter(word):
            hits.setdefault(end + 1, []).append(number)
        reach = int(self.pieces.lengths.max(initial=1))
        for place in range(1, len(word) + 1):
            total = np.zeros(len(self.model.languages))
            for number in hits.get(place, ()):
                before = sums.get(place - int(self.pieces.lengths[number]))
                if before is not None:
                    total = total + before * np.exp(self.model.logs[number])
            top = total.max(initial=0.0)
            if top > 0:  # keep the recent sums on one scale
                sums = {p: s / top for p, s in sums.items() if p > place - reach}
                log_scale += np.log(top)
                total = total / top
            sums[place] = total
        return np.log(np.maximum(sums[len(word)], 1e-300)) + log_scale

    def learn(self, words: list[str]) -> None:
        spelled = [as_bytes(w) for w in words]
        found = np.zeros((len(words), len(self.model.languages)))
        short = [i for i, w in enumerate(spelled) if len(w) <= LONG]
        for at in range(0, len(short), 4096):  # bounds the memory of a pass
            some = short[at:at + 4096]
            cuts = self.pieces.cuts([spelled[i] for i in some])
            alpha = forward(cuts, self.scaled[cuts.piece])
            ends = alpha[np.arange(len(some)), cuts.sizes]
            found[some] = np.log(ends) - cuts.sizes[:, None] * np.log(SCALE)
        for i, word in enumerate(spelled):
            if len(word) > LONG:
                found[i] = self.long_word(word)
        first = len(self.vectors)
        self.vectors = np.concatenate([self.vectors, found])
        self.places.update(zip(words, range(first, first + len(words))))

    def texts(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Best language and its probability for each text, all languages being equally likely."""
        if len(self.places) > REMEMBERED:
            self.places.clear()
            self.vectors = self.vectors[:0]
        split = [LETTERS.findall(t.lower()) for t in texts]
        new = sorted({w for words in split for w in words if w not in self.places})
        if new:
            self.learn(new)
        names, scores = [], []
        for words in split:
            if not words or not self.model.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            logs = self.vectors[[self.places[w] for w in words]].sum(axis=0)
            best = int(logs.argmax())
            names.append(self.model.languages[best])
            scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
        return names, scores


def _sampled(labelled: DataFrame, language: str, sizes: dict[str, int], rows: int) -> DataFrame:
    """About ``rows`` texts of each language, chosen by a hash of the text."""
    draw = F.pmod(F.xxhash64("_text", F.lit("language")), F.lit(1_000_000)) / 1e6
    keep = F.lit(False)
    for name, size in sorted(sizes.items()):
        keep = keep | ((F.col(language) == name) & (draw < rows / size))
    return labelled.where(keep)


def fit(
    labelled: DataFrame, pieces: list[str], text: str = "text", language: str = "lang",
    sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS,
) -> Model:
    """Piece probabilities of each language from labelled texts.

    Rows without a language are left out, and languages without a word. Of each language about ``sample_rows`` rows are used,
    so the fit costs the same at every size. The driver sees one probability per piece and
    language.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col(language).isNotNull()).select(
        F.col(language).alias("language"), content(text).alias("_text")
    )
    counts = rows.groupBy("language").agg(F.count("*").alias("size"))
    sizes = {r[0]: r[1] for r in counts.collect()}  # a number per language
    words = F.explode(F.regexp_extract_all(F.lower("_text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    counted = handed_over(
        _sampled(rows, "language", sizes, sample_rows)
        .select("language", words.alias("word"))
        .groupBy("language", "word").agg(F.count("*").alias("times"))
        .repartition(2 * spark.sparkContext.defaultParallelism, "word"),
        "words",
    )
    languages = sorted(r[0] for r in counted.select("language").distinct().collect())
    probability = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    held_pieces = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds if languages else 0):
        held = spark.sparkContext.broadcast(probability)

        def uses(frames):
            finder, current = Pieces(held_pieces.value), held.value
            column = {name: i for i, name in enumerate(languages)}
            total = np.zeros(current.shape)
            for whole in frames:
                is_long = whole["word"].str.encode("utf-8").str.len() >= LONG
                for row in whole[is_long].itertuples():
                    spoken = column[row.language]
                    piece, use = long_uses(finder, as_bytes(row.word), np.log(current[:, spoken]))
                    np.add.at(total[:, spoken], piece, use * row.times)
                frame = whole[~is_long]
                for at in range(0, len(frame), 4096):
                    some = frame.iloc[at:at + 4096]
                    cuts = finder.cuts([as_bytes(w) for w in some["word"]])
                    spoken = some["language"].map(column).to_numpy()
                    scale = SCALE ** finder.lengths[cuts.piece]
                    weight = (current[cuts.piece, spoken[cuts.row]] * scale)[:, None]
                    alpha = forward(cuts, weight)
                    use = expected(cuts, weight, alpha, some["times"].to_numpy(float))
                    np.add.at(total, (cuts.piece, spoken[cuts.row]), use)
            piece, spoken = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "spoken": spoken, "uses": total[piece, spoken]})

        summed = (
            counted.mapInPandas(uses, "piece long, spoken long, uses double")
            .groupBy("piece", "spoken").agg(F.sum("uses").alias("uses")).toPandas()
        )
        total = np.full(probability.shape, SMOOTHING)
        np.add.at(total, (summed["piece"].to_numpy(), summed["spoken"].to_numpy()),
                  summed["uses"].to_numpy())
        probability = total / total.sum(axis=0)
    release(counted)
    return Model(languages, pieces, np.log(probability))


def identified(
    docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True
) -> DataFrame:
    """All columns, the text only if asked for, and lang_pred and score.

    ``lang_pred`` is ``und``, with score 0, for texts that are null or have no letter, and for all
    texts if the model knows no language. Equally likely languages: the first by name. Columns of
    the names of the two are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast({"model": tuple(model)})
    made = ("lang_pred", "score", *(() if keep_text else (text,)))
    others = [c for c in docs.columns if c not in made]
    schema = docs.select(*others).schema.add("lang_pred", "string").add("score", "double")

    def score(batches):
        value = held.value
        scorer = value.get("scorer")
        if scorer is None:  # one for all tasks of a worker
            scorer = value["scorer"] = Scorer(Model(*value["model"]))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            names, scores = scorer.texts(texts)
            keep = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*others, "lang_pred", "score"],
            )

    return docs.select(*dict.fromkeys([*others, text])).mapInArrow(score, schema)


def held_out(key: str, folds: int, fold: int) -> Column:
    """Rows kept from learning: those whose key, as text, has this CRC-32 remainder."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == fold
