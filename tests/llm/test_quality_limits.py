import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from orderloom.llm import quality_limits
from orderloom.llm.quality_limits import Rule, falling

from odd_rows import LONG, ROWS, empty, odd  # noqa: F401


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
            len(lines) - len(set(lines)), len(again))


TEXTS = [
    None, "", " \t\r\n", "a b c d", "a b c d e", "a b c d e a b c d e", "a b c d e f a b c d e",
    "a a a a a a a", "x y\x1cz w\x0bv", "# * $%& |<> €\U0001f600 <<",
    "one\n\none\n one\n\t\ntwo\none", "a b c d e f g " * 3 + "q " + "c d e f g", LONG,
]


def test_counts_match_brute_force(spark):
    draw = random.Random(7)
    texts = TEXTS + [" ".join(draw.choices("abc", k=draw.randrange(400))) for _ in range(20)]
    texts += ["\n".join(draw.choices(["a b", "c", "", " "], k=30)) for _ in range(5)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)],
                                 "i int, text string, n_words int, _w string")
    docs = docs.drop("n_words")
    got = {r.i: tuple(r[c] for c in quality_limits.COUNTS)
           for r in quality_limits.with_counts(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def exact_allowed(n, p, error):
    p, error, term, total, best = Fraction(p), Fraction(error), None, Fraction(0), -1
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > error:
            return best
        best = k
    return best


def test_allowed_rejections_are_exact(spark):
    cases = [(n, e) for n in (1, 5, 40, 160, 161, 300, 700) for e in (0.2, 0.05, 1e-3, 1e-6)]
    sizes = spark.createDataFrame(cases, "n long, e double")
    for p in (0.02, 0.3):
        got = {(r.n, r.e): r.allowed for r in quality_limits.with_allowed(sizes, "n", p, "e").collect()}
        assert got == {(n, e): exact_allowed(n, p, e) for n, e in cases}


def test_allowed_rejections_of_large_samples(spark):
    """Above 400 expected rejections the sum starts late; the bound may be one too careful."""
    cases = [(n, e) for n in (2000, 30_000, 400_000) for e in (0.05, 1e-4)]
    p = 0.25
    got = {(r.n, r.e): r.allowed for r in quality_limits.with_allowed(
        spark.createDataFrame(cases, "n long, e double"), "n", p, "e").collect()}
    for n, e in cases:
        log = lambda k: (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                         + k * math.log(p) + (n - k) * math.log1p(-p))
        upto = lambda k: math.fsum(math.exp(log(i)) for i in range(k + 1))
        k = got[n, e]
        assert upto(k) <= e * (1 + 1e-6) and upto(k + 1) > e * (1 - 1e-6)


RULES = (Rule("symbols", "n_symbols / n_words", falling(4.0, 0.1, 6)),
         Rule("long_words", "word_chars / n_words", falling(20.0, 3.0, 6)))


def labelled(n=400):
    """Texts of two strata; bad ones have symbols, some good ones long words."""
    draw = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        good, lang = draw.random() < 0.7, draw.choice(["en", None])
        words = ["wort" * (3 if good and draw.random() < 0.05 else 1) + str(draw.randrange(10**6))
                 for _ in range(20)]
        text = " ".join(words if good or draw.random() < 0.2 else ["##" + w + " %%" for w in words])
        docs.append((i, text, lang))
        if draw.random() < 0.8:
            labels.append((i, int(good)))
    docs += [(10_000 + i, docs[0][1], "en") for i in range(50)]
    labels += [(10_000 + i, 1) for i in range(50)] + [(1, None), (2, 7), (None, 1), (3, 0), (3, 1)]
    return docs, labels


def brute_limits(docs, labels, limit, confidence, rules):
    marks = {}
    for key, q in labels:
        if key is not None and q in (0, 1):
            marks[key] = marks.get(key, True) and q == 1
    texts = {}
    for key, text, lang in docs:
        if key in marks:
            c = dict(zip(quality_limits.COUNTS, counts(text)))
            if c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"]:
                good, _ = texts.get((lang, text), (True, c))
                texts[lang, text] = good and marks[key], c
    strata = {lang for lang, _ in texts}
    out = {}
    for lang in strata:
        own = [x for (la, _), x in texts.items() if la == lang]
        n = sum(good for good, _ in own)
        allowed = exact_allowed(n, limit / len(rules), (1 - confidence) / (len(strata) * len(rules)))
        for rule in rules:
            a, b = rule.signal.split(" / ")
            options = []
            for step, cut in enumerate(rule.cutoffs):
                hit = [good for good, c in own if c[a] / c[b] > cut]
                if sum(hit) <= allowed and len(hit) > sum(hit):
                    options.append((len(hit) - sum(hit), -step, cut))
            if options:
                out[lang, rule.name] = max(options)[2]
    return out


def test_cutoffs_and_verdicts_match_brute_force(spark):
    docs, labels = labelled()
    how = {"limit": 0.2, "confidence": 0.9, "rules": RULES}
    verdicts, limits = quality_limits.judged(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"), **how)
    expected = brute_limits(docs, labels, *how.values())
    assert {(r.stratum, r.rule): r.cutoff for r in limits.collect()} == expected
    assert {("en", "symbols"), (None, "symbols")} <= set(expected)
    assert all(r.false_rejected <= r.allowed for r in limits.collect())
    got = {r.doc_id: (r.base_failed, sorted(r.failed_rules), r.kept) for r in verdicts.collect()}
    for key, text, lang in docs:
        c = dict(zip(quality_limits.COUNTS, counts(text)))
        base = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        over = sorted(r.name for r in RULES if (lang, r.name) in expected and c[
            r.signal.split(" / ")[0]] / c[r.signal.split(" / ")[1]] > expected[lang, r.name])
        assert got[key] == (base, over, not base and not over)


def test_guarantee_holds_on_new_documents(spark):
    """Cutoffs from one draw, false rejections on another: below the limit in every stratum."""
    draw = random.Random(4)

    def texts(n, first):
        for i in range(n):
            long = "wort" * draw.randrange(1, 7)
            yield first + i, " ".join(long + str(draw.randrange(10**6)) for _ in range(12)), "en"

    seen, new = list(texts(1500, 0)), list(texts(1500, 5000))
    bad = [(10_000 + i, " ".join(["w" * 40 + str(i * 20 + j) for j in range(12)]), "en") for i in range(50)]
    labels = [(k, 1) for k, *_ in seen] + [(k, 0) for k, *_ in bad]
    verdicts, _ = quality_limits.judged(
        spark.createDataFrame(seen + new + bad, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"), limit=0.1)
    kept = {r.doc_id: r.kept for r in verdicts.collect()}
    assert sum(not kept[k] for k, *_ in new) <= 150
    assert not any(kept[k] for k, *_ in bad)


def test_awkward_rows(odd, empty, spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 0), (5, 1, 0), (None, 1, 0), (99, 0, 1), (6, None, None)],
        "doc_id long, quality int, toxic int")
    verdicts, limits = quality_limits.judged(odd, labels)
    got = sorted((str(r.doc_id), *(r[c] for c in quality_limits.COUNTS)) for r in verdicts.collect())
    assert got == sorted((str(k), *counts(t)) for k, t, _ in ROWS)
    assert limits.count() == 0
    assert all(r.kept == (not r.base_failed) for r in verdicts.collect())
    for docs, marks in ((empty, labels), (empty, labels.limit(0)), (odd, labels.limit(0))):
        verdicts, limits = quality_limits.judged(docs, marks)
        assert verdicts.count() == docs.count() and limits.count() == 0


def test_no_text_leaves_its_task_and_no_python(spark, small_folder):
    from orderloom.llm.queries import op13_certified_quality

    plan = op13_certified_quality(spark, small_folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
