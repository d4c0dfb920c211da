"""Statistics against known values, metrics against brute force, models on a small table."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import churn, ml, stats
from orderloom.plans.shop import Shop
from orderloom.session import handed_over

from conftest import values


@pytest.mark.parametrize("t, df, p", [
    (0.0, 5, 1.0), (2.0, 10, 0.0733880348), (-2.0, 10, 0.0733880348), (12.706, 1, 0.05),
    (1.959964, 1e9, 0.05), (0.5, 3, 0.651445),
])
def test_t_tail(spark, t, df, p):
    row = spark.sql(f"SELECT {t}D AS t, {df}D AS df").select(stats.two_sided_p("t", "df")).first()
    assert row[0] == pytest.approx(p, rel=2e-4)


@pytest.mark.parametrize("t, df", [(5.0, 30), (1.3, 4.7), (3.0, 12.5)])
def test_t_tail_equals_the_integrated_density(spark, t, df):
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    steps, inside = 20_000, 0.0
    for i in range(steps):
        x = (i + 0.5) * t / steps
        inside += scale * (1 + x * x / df) ** (-(df + 1) / 2) * t / steps
    row = spark.sql(f"SELECT {t}D AS t, {df}D AS df").select(stats.two_sided_p("t", "df")).first()
    assert row[0] == pytest.approx(1 - 2 * inside, rel=1e-3)


def test_group_comparison(spark):
    scores = {"fast": [5, 4, 5, 3, 4, 5], "slow": [3, 2, 4, 1]}
    rows = [("delivered", i, 2 if g == "fast" else 9, v)
            for g, vs in scores.items() for i, v in enumerate(vs)]
    rows += [("delivered", 90, -1, 1), ("delivered", 91, 3, None), ("canceled", 92, 3, 1)]
    fact = spark.createDataFrame(
        rows, "order_status string, order_id int, days_to_deliver int, review_score int")
    row = stats.conclusion(stats.rated_deliveries(fact)).first()
    mean = lambda x: sum(x) / len(x)
    var = lambda x: sum((v - mean(x)) ** 2 for v in x) / (len(x) - 1)
    a, b = scores["fast"], scores["slow"]
    se = var(a) / len(a) + var(b) / len(b)
    assert (row.fast_n, row.slow_n) == (6, 4)
    assert row.t_statistic == pytest.approx((mean(a) - mean(b)) / math.sqrt(se))
    pooled = math.sqrt((5 * var(a) + 3 * var(b)) / 8)
    assert row.cohens_d == pytest.approx((mean(a) - mean(b)) / pooled)
    assert row.effect == "Large" and row.worth_investing and 0 < row.p_value < 0.1
    assert row.significant == (row.p_value < 0.05)


def test_group_of_one_has_no_variance(spark):
    fact = spark.createDataFrame(
        [("delivered", 1, 2, 5), ("delivered", 2, 9, 1), ("delivered", 3, 9, 2)],
        "order_status string, order_id int, days_to_deliver int, review_score int")
    row = stats.group_moments(stats.rated_deliveries(fact)).first()
    assert row.fast_variance is None and row.slow_variance == 0.5


@pytest.fixture(scope="module")
def scored(spark):
    random.seed(3)
    rows = []
    for i in range(400):
        label = int(random.random() < 0.8)
        score = min(max(random.gauss(0.4 + 0.3 * label, 0.2), 0.0), 1.0)
        # every other score keeps all its digits, the others make ties
        rows.append((f"p{i}", label, score if i % 2 else round(score, 1)))
    return spark.createDataFrame(rows, "customer_unique_id string, label int, score double")


def test_metrics_against_brute_force(scored):
    rows = [(r.label, r.score) for r in scored.collect()]
    ones, zeros = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    precision, seen = 0.0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        hits = sum(a >= s for a in ones)
        precision += (hits - seen) / len(ones) * hits / (hits + sum(b >= s for b in zeros))
        seen = hits

    def f1(threshold):
        tp, fp = sum(b <= threshold for b in zeros), sum(a <= threshold for a in ones)
        return 2 * tp / (tp + fp + len(zeros))

    best = max({s for _, s in rows}, key=lambda s: (f1(s), s))
    quality = ml.ranking_quality(scored).first()
    assert quality.roc_auc == pytest.approx(auc)
    assert quality.average_precision == pytest.approx(precision)
    found = ml.best_threshold(scored).first()
    assert found.threshold == best and found.best_f1 == pytest.approx(f1(best))
    row = ml.evaluation(scored).first()
    correct = sum((s >= best) == bool(y) for y, s in rows) / len(rows)
    assert row.accuracy == pytest.approx(correct, abs=1e-4)
    assert row.recall_retained == pytest.approx(
        sum(b < best for b in zeros) / len(zeros), abs=1e-4)
    last = ml.roc_points(scored).collect()[-1]
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_one_class_only(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "customer_unique_id string, label int, score double")
    assert ml.best_threshold(df).first().threshold == 0.5
    assert ml.ranking_quality(df).first().roc_auc is None


def test_imputation_uses_the_exact_median(spark):
    df = spark.createDataFrame(
        [(1.0, "x"), (2.0, None), (10.0, "y"), (20.0, "x"), (None, "x")], "a double, c string")
    got = values(ml.impute(df, ["a"], ["c"]))
    assert got[-1] == (6.0, "x") and got[1] == (2.0, "unknown")


def test_models_fit_and_score(spark, small_folder):
    features = handed_over(Shop.over_fixtures(spark, small_folder).churn_features)
    n = features.count()
    sizes = {ml.LOGISTIC: {"maxIter": 20}, ml.FOREST: {"numTrees": 5, "maxDepth": 3},
             ml.BOOSTED: {"maxIter": 3, "maxDepth": 3}}
    compared = {}
    for model, size in sizes.items():
        prepared, fitted, ready = ml.fit(features, model, drop_leaky=True, **size)
        scored = handed_over(ml.scores(fitted, ready))
        assert scored.count() == n
        assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
        pairs = scored.alias("a").join(scored.alias("b"), F.expr("a.label = 1 AND b.label = 0"))
        won = "avg(CASE WHEN a.score > b.score THEN 1D WHEN a.score = b.score THEN 0.5D ELSE 0D END)"
        auc = pairs.select(F.expr(won)).first()[0]
        assert ml.ranking_quality(scored).first().roc_auc == pytest.approx(auc)
        compared[model] = scored
        numeric = [c for c in churn.NUMERIC_FEATURES if c not in churn.LEAKY_FEATURES]
        names = ml.feature_names(prepared, numeric)
        assert ml.importance(fitted, names).count() == len(names) == ready.first().features.size
        out = ml.predictions(scored, ml.best_threshold(scored), model)
        assert out.where("predicted_label NOT IN (0, 1)").count() == 0
    table = ml.comparison(compared).collect()
    assert sorted(r.model for r in table) == sorted(ml.MODELS)
    assert [r.roc_auc for r in table] == sorted((r.roc_auc for r in table), reverse=True)
    with pytest.raises(ValueError):
        ml.classifier("other")


def test_unseen_category_is_all_zeros(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "n double, c string")
    prepared = ml.feature_pipeline(train, ["n"], ["c"]).fit(train)
    fresh = spark.createDataFrame([(2.0, "z"), (2.0, "b")], "n double, c string")
    got = [list(r.features.toArray()) for r in prepared.transform(fresh).collect()]
    assert got == [[0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]


@pytest.mark.parametrize("share", [0.8, 0.5, 0.0, 1.0])
def test_split_takes_exactly_the_rounded_share_of_each_label(spark, share):
    draw = random.Random(5)
    rows = [(f"p{i}", draw.choice([1, 1, 1, 0, None])) for i in range(487)] + [("alone", 7)]
    df = spark.createDataFrame(rows, "customer_unique_id string, is_churned int")
    got = {r.customer_unique_id: r for r in ml.with_split(df.repartition(3), train_share=share).collect()}
    assert len(got) == len(rows)
    for label in (0, 1, None, 7):
        own = [k for k, y in rows if y == label]
        assert sum(got[k].is_train for k in own) == math.floor(share * len(own) + 0.5)
    again = {r.customer_unique_id: r.is_train for r in ml.with_split(df.repartition(7), train_share=share).collect()}
    assert again == {k: r.is_train for k, r in got.items()}
    other = {r.customer_unique_id: r.is_train
             for r in ml.with_split(df, train_share=share, seed=1).collect()}
    assert (other != again) == (0 < share < 1)


def test_split_moves_no_row_and_knows_no_window_over_a_label(spark):
    df = spark.range(40).selectExpr("id AS customer_unique_id", "int(id % 2) AS is_churned",
                                    "repeat('wide', 10) AS wide")
    plan = ml.with_split(df)._jdf.queryExecution().sparkPlan().toString()
    assert all("_slice" in line for line in plan.splitlines() if "windowspecdefinition(" in line)
    assert not any("wide" in line for line in plan.splitlines() if "Exchange hash" in line)
