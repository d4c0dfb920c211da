"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document whose signal exceeds a cutoff. Each rule has a fixed list of cutoffs,
lenient ones first. Of the labelled good texts of a stratum, those that a cutoff rejects are
counted; the cutoff is certified if so few would be rejected by chance too rarely were its true
rate of false rejection above the limit, by the exact binomial distribution. Cutoffs of a rule
are tested in their order, which needs no correction since counts only rise; strata and rules
share the error probability in equal parts (Bonferroni). So with the stated confidence no stratum
loses more than the limit, all rules together, of its good texts.

Of the certified cutoffs of a rule the one that rejects the most labelled bad texts is taken, the
most lenient of several; a rule that rejects none is left out, as is one without labels enough.

Everything is built from DataFrame functions. Words are counted in the row they stand in, so no
text is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import handed_over
from .shared import content

#: White space between words, characters that count as symbols, window of repeats.
SPACE, SYMBOLS, WINDOW = r"[\x20\x09-\x0D]+", "#*$%&|<>", 5
LEAST_WORDS, MOST_REPEATED = 10, 20


class Rule(NamedTuple):
    name: str
    #: SQL over the counts; a document is rejected if it exceeds the cutoff.
    signal: str
    #: Falling: the first rejects the fewest.
    cutoffs: tuple[float, ...]


def falling(start: float, end: float, steps: int = 32) -> tuple[float, ...]:
    """Cutoffs in equal proportion from start down to end."""
    ratio = (end / start) ** (1 / (steps - 1))
    return tuple(round(start * ratio**i, 6) for i in range(steps))


RULES = (
    Rule("symbols", "n_symbols / n_words", falling(5.0, 0.01)),
    Rule("long_words", "word_chars / n_words", falling(40.0, 4.0)),
    Rule("short_words", "n_words / word_chars", falling(1.0, 0.15)),
    Rule("repeated_words", "n_repeat_words / n_words", falling(0.2, 0.005)),
    Rule("repeated_lines", "n_dup_lines / n_lines", falling(0.9, 0.01)),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _same_as_neighbour(pairs: str, value: str) -> str:
    """Places ``i`` of the sorted pairs whose value stands beside an equal one."""
    at = lambda j: f"get({pairs}, {j}).{value}"
    return (
        f"transform(filter(sequence(0, size({pairs}) - 1), j -> "
        f"coalesce({at('j')} = {at('j - 1')}, false) OR coalesce({at('j')} = {at('j + 1')}, false)),"
        f" j -> get({pairs}, j).i)"
    )


def with_counts(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The counts of a text beside its row; a null text has no words.

    Repeated windows are found by hash; those that share one are compared word by word.
    """
    none = "CAST(array() AS array<int>)"
    lines = r"filter(split(_t, '\n', -1), l -> l RLIKE '[^\\x20\\x09-\\x0D]')"
    columns = docs.columns
    rows = docs.withColumn("_t", content(text))
    rows = rows.withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    rows = rows.withColumn("_h", F.expr("transform(_w, w -> xxhash64(w))"))
    hashed = ", ".join(f"get(_h, i + {k})" for k in range(window))
    rows = rows.withColumn("_x", F.expr(
        f"IF(size(_h) < {window}, CAST(array() AS array<bigint>),"
        f" transform(sequence(0, size(_h) - {window}), i -> xxhash64({hashed})))"
    ))
    rows = rows.withColumn("_s", F.expr(
        "IF(size(array_distinct(_x)) < size(_x),"
        " sort_array(transform(_x, (x, i) -> struct(x AS x, i AS i))),"
        " CAST(array() AS array<struct<x:bigint,i:int>>))"
    ))
    rows = rows.withColumn("_f", F.expr(
        f"IF(size(_s) = 0, {none}, {_same_as_neighbour('_s', 'x')})"
    ))
    rows = rows.withColumn("_s", F.expr(
        f"sort_array(transform(_f, i -> struct(array_join(slice(_w, i + 1, {window}), ' ') AS x,"
        " i AS i)))"
    ))
    rows = rows.withColumn("_f", F.expr(
        f"IF(size(_s) = 0, {none}, sort_array({_same_as_neighbour('_s', 'x')}))"
    ))
    covered = F.expr(
        "aggregate(transform(_f, (p, j) -> "
        f"least({window}, coalesce(get(_f, j + 1) - p, {window}))), 0L, (n, c) -> n + c)"
    )
    rows = rows.withColumn("_l", F.expr(lines))
    return rows.select(
        *columns, F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_t", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long")
        .alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return F.expr(
        f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    )


def _binomial_start(n: str, p: float) -> tuple[str, str, str]:
    """A place far below the mean, the probability of that place, and a bound of all below it.

    Small samples start at 0. Large ones start twelve deviations below the mean, by the
    saddle-point form of the binomial probability, and what lies below is bounded by a geometric
    series; it is added, so a certificate is never given too easily.
    """
    start = f"IF({n} * {p!r} <= 400, 0L, CAST(floor({n} * {p!r} - 12 * sqrt({n} * {p * (1 - p)!r})) AS bigint))"
    series = lambda m: f"(1 / (12D * {m}) - 1 / (360D * pow({m}, 3)) + 1 / (1260D * pow({m}, 5)))"
    apart = lambda m, mean: f"({m} * ln({m} / ({mean})) + ({mean}) - {m})"
    at, rest = "_start", f"({n} - _start)"
    mass = (
        f"IF(_start = 0, pow({1 - p!r}, {n}), sqrt({n} / (2 * pi() * {at} * {rest})) * exp("
        f"{series(n)} - {series(at)} - {series(rest)}"
        f" - {apart(at, f'{n} * {p!r}')} - {apart(rest, f'{n} * {1 - p!r}')}))"
    )
    ratio = f"(_start * {1 - p!r} / (({n} - _start + 1) * {p!r}))"
    below = f"IF(_start = 0, 0D, _mass * {ratio} / (1 - {ratio}))"
    return start, mass, below


def with_allowed(sizes: DataFrame, n: str, p: float, error: str, out: str = "allowed") -> DataFrame:
    """The largest k with P(X <= k) <= error for X binomial of ``n`` and ``p``; -1 if there is none.

    So many false rejections among n still show, at that error, that the true rate is below p.
    ``error`` is SQL and below 0.5, hence k is below the mean.
    """
    start, mass, below = _binomial_start(f"double({n})", p)
    odds = p / (1 - p)
    step = f"s.mass * (double({n}) - k + 1) / k * {odds!r}D"
    fold = f"""aggregate(
        sequence(_start + 1, greatest(_start + 1, CAST(ceil(double({n}) * {p!r}) AS bigint))),
        struct(_mass AS mass, _mass + _below AS upto,
               IF(_mass + _below <= {error}, _start, -1L) AS best),
        (s, k) -> struct({step} AS mass, s.upto + {step} AS upto,
                         IF(s.upto + {step} <= {error}, k, s.best) AS best),
        s -> s.best)"""
    kept = sizes.columns
    return (
        sizes.withColumn("_start", F.expr(start)).withColumn("_mass", F.expr(mass))
        .withColumn("_below", F.expr(below)).withColumn(out, F.expr(fold)).select(*kept, out)
    )


def _signals(rules: Sequence[Rule]) -> str:
    """The signals of a row as an array in the order of the rules; without words they are 0."""
    safe = [f"coalesce(try_divide({', '.join(r.signal.split(' / '))}), 0D)" for r in rules]
    return f"array({', '.join(safe)})"


def _first_rejecting(rule: Rule, signal: str) -> str:
    """1-based number of the first cutoff that a signal exceeds; one too many if none."""
    steps = ", ".join(f"{c!r}D" for c in rule.cutoffs)
    return f"size(filter(array({steps}), c -> NOT {signal} > c)) + 1"


def certified_cutoffs(
    counted: DataFrame, labels: DataFrame, limit: float, confidence: float,
    rules: Sequence[Rule] = RULES, key: str = "_id", stratum: str = "_stratum",
) -> DataFrame:
    """One row per stratum and rule that has a cutoff: _stratum, rule, cutoff, n_good,
    false_rejected, allowed, bad_rejected.

    ``counted`` has the counts, ``_text_id`` and the base verdict of every document, ``labels`` a
    key and ``good``. Texts that the base rejects are not at stake and are not counted. A text
    counts once in its stratum, however many copies it has, and is good only if all its labels
    say so.
    """
    places = [_first_rejecting(r, f"get(_signals, {i})") for i, r in enumerate(rules)]
    labelled = (
        counted.where("NOT base_failed").join(
            labels.groupBy(F.col(key).alias("_key")).agg(F.bool_and("good").alias("good")),
            F.col(key) == F.col("_key"),
        )
        .withColumn("_signals", F.expr(_signals(rules)))
        .groupBy(stratum, "_text_id")
        .agg(F.bool_and("good").alias("good"), F.first("_signals").alias("_signals"))
    )
    at_place = handed_over(
        labelled.select(stratum, "good", F.posexplode(F.array(*map(F.expr, places))).alias("rule", "place"))
        .groupBy(stratum, "rule", "place")
        .agg(F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad")),
        "places",
    )
    # rows of a rule: as many as it has cutoffs, and one
    upto = Window.partitionBy(stratum, "rule").orderBy("place").rowsBetween(
        Window.unboundedPreceding, 0
    )
    counts = at_place.select(
        stratum, "rule", "place", F.sum("good").over(upto).alias("false_rejected"),
        F.sum("bad").over(upto).alias("bad_rejected"),
    )
    sizes = at_place.where("rule = 0").groupBy(stratum).agg(F.sum("good").alias("n_good"))
    tests = at_place.agg(F.count_distinct(F.struct(stratum)) * len(rules)).scalar()
    sizes = sizes.where("n_good > 0").withColumn("_error", F.lit(1 - confidence) / tests)
    allowed = with_allowed(sizes, "n_good", limit / len(rules), "_error")
    names = F.array(*[F.lit(r.name) for r in rules])
    cutoffs = F.expr("array(" + ", ".join(
        f"array({', '.join(f'{c!r}D' for c in r.cutoffs)})" for r in rules) + ")")
    best = F.max_by(
        F.struct("place", "false_rejected", "bad_rejected"),
        F.struct("bad_rejected", -F.col("place")),
    )
    found = (
        counts.withColumnRenamed(stratum, "_of")
        .join(allowed, F.col("_of").eqNullSafe(F.col(stratum)))
        .where("false_rejected <= allowed AND bad_rejected > 0")
        .groupBy(stratum, "rule", "n_good", "allowed").agg(best.alias("b"))
    )
    return found.select(
        stratum, F.get(names, F.col("rule")).alias("rule"),
        F.get(F.get(cutoffs, F.col("rule")), F.col("b.place") - 1).alias("cutoff"),
        "n_good", "b.false_rejected", "allowed", "b.bad_rejected",
    ).where("cutoff IS NOT NULL")


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text",
    key: str = "doc_id", quality: str = "quality", limit: float = 0.02,
    confidence: float = 0.95, rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """Verdicts of all documents, and the cutoffs they come from (``certified_cutoffs``).

    Verdicts: key, stratum, the counts, base_failed, failed_rules (names of the rules whose
    cutoff the document exceeds), kept (neither). Labels of 1 are good, of 0 bad; other labels
    and rows without key say nothing. With the given confidence at most the share ``limit`` of
    the good texts that the base keeps is rejected in any stratum, null being one.

    A null or empty text has no words and fails the base. Rows that repeat a key all have its
    labels. Further columns of the input are not read. No documents give no rows, no labels no
    cutoffs.
    """
    small = docs.select(
        F.col(key).alias("_id"), F.col(stratum).alias("_stratum"), content(text).alias("_text")
    )
    counted = handed_over(
        with_counts(small, "_text").withColumn("_text_id", F.md5("_text"))
        .withColumn("base_failed", base_failed()).drop("_text"),
        "counted",
    )
    known = labels.select(
        F.col(key).alias("_id"), (F.col(quality) == 1).alias("good")
    ).where(F.col(quality).isin(0, 1))
    limits = handed_over(certified_cutoffs(counted, known, limit, confidence, rules), "limits")
    # one row per stratum, as many entries as there are rules
    by_stratum = limits.groupBy(F.col("_stratum").alias("_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_limits")
    )
    over = ", ".join(
        f"IF(coalesce(get(_signals, {i}) > _limits['{r.name}'], false), '{r.name}', NULL)"
        for i, r in enumerate(rules)
    )
    verdicts = (
        counted.withColumn("_signals", F.expr(_signals(rules)))
        .join(by_stratum, F.col("_stratum").eqNullSafe(F.col("_of")), "left")
        .withColumn("failed_rules", F.expr(f"array_compact(array({over}))"))
        .select(
            F.col("_id").alias(key), F.col("_stratum").alias("stratum"), *COUNTS, "base_failed",
            "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
        )
    )
    return verdicts, limits.withColumnRenamed("_stratum", "stratum")
