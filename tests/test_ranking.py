"""Ranks without a single-task window, against the single-task window."""

import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from orderloom.operators import ranking, showcase

from conftest import values


@pytest.fixture(scope="module")
def people(spark):
    """A third of the rows in one group, and a third of all values equal."""
    random.seed(7)
    rows = []
    for i in range(3000):
        state = "HOT" if i % 3 == 0 else random.choice(["A", "B", None])
        spend = 50.0 if random.random() < 0.34 else round(random.uniform(1, 500), 2)
        rows.append((f"p{i:05d}", state, spend, i % 17))
    return spark.createDataFrame(rows, "id string, state string, spend double, k int").repartition(5)


def compare(mine, theirs):
    assert sorted(values(mine), key=repr) == sorted(values(theirs), key=repr)


@pytest.mark.parametrize("tiles, rows", [(10, 3000), (7, 3000), (10, 4), (4, 1)])
def test_ntile(people, tiles, rows):
    df = people.orderBy("id").limit(rows).select("id", "spend")
    window = Window.orderBy("spend", "id")
    compare(
        ranking.ntile(df, "spend", "id", tiles, "tile").select("id", "tile"),
        df.select("id", F.ntile(tiles).over(window).cast("bigint").alias("tile")),
    )


@pytest.mark.parametrize("rows", [3000, 1])
def test_percent_rank(people, rows):
    df = people.orderBy("id").limit(rows).select("id", "spend")
    compare(
        ranking.percent_rank(df, "spend", "share").select("id", "share"),
        df.select("id", F.round(F.percent_rank().over(Window.orderBy("spend")), 4).alias("share")),
    )


def test_rank_within_groups(people):
    window = Window.partitionBy("state").orderBy(F.desc("spend"))
    compare(
        ranking.rank_within(people, ["state"], "spend", "place").select("id", "place"),
        people.select("id", F.rank().over(window).cast("bigint").alias("place")),
    )


def test_number_within_groups(people):
    window = Window.partitionBy("state").orderBy("spend", "id")
    compare(
        ranking.number_within(people, ["state"], ["spend", "id"], "place").select("id", "place"),
        people.select("id", F.row_number().over(window).cast("bigint").alias("place")),
    )


def test_running_total(people):
    counts = people.groupBy("spend").agg(F.count("*").alias("n"))
    window = Window.orderBy("spend").rowsBetween(Window.unboundedPreceding, 0)
    compare(
        ranking.with_running_total(counts, ["spend"], "n", "upto").select("spend", "upto"),
        counts.select("spend", F.sum("n").over(window).alias("upto")),
    )


def test_medians(people):
    rows = people.collect()
    got = dict(values(ranking.medians(people, ["spend", "k"])))
    assert got == {"spend": statistics.median(r.spend for r in rows),
                   "k": statistics.median(r.k for r in rows)}


def test_rows_are_really_spread(people):
    placed = ranking.with_position(people, ["state", "spend", "id"], "place")
    sizes = [r["count"] for r in
             people.repartitionByRange(4, "state", "spend", "id")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500
    assert sorted(r.place for r in placed.select("place").collect()) == list(range(1, 3001))


@pytest.mark.parametrize("limit, rows", [(100, 3000), (40, 3000), (100, 25), (100, 7)])
def test_top_decile_equals_full_ranking(people, limit, rows):
    """Also where the list ends inside a large group of equal spends."""
    df = people.orderBy("id").limit(rows).select(
        F.col("id").alias("customer_unique_id"), "state",
        F.when(F.col("spend") > 400, 400.0).otherwise(F.col("spend")).alias("total_spend_brl"),
        F.lit(1).alias("total_orders"), F.lit(1.0).alias("avg_review_score"),
        F.lit("x").alias("order_frequency_segment"), F.lit("y").alias("satisfaction_segment"))
    spend = F.col("total_spend_brl")
    full = df.select(
        "customer_unique_id",
        F.ntile(10).over(Window.orderBy("total_spend_brl", "customer_unique_id")).alias("d"),
        F.round(F.percent_rank().over(Window.orderBy("total_spend_brl")), 4).alias("p"),
        F.rank().over(Window.partitionBy("state").orderBy(spend.desc())).cast("bigint").alias("r"),
        "total_spend_brl",
    ).where("d = 10").orderBy(spend.desc(), F.desc("customer_unique_id")).limit(limit)
    mine = showcase.top_decile_spenders(df, limit)
    compare(mine.select("customer_unique_id", "spend_percentile", "rank_in_state"),
            full.select("customer_unique_id", "p", "r"))


def test_partition_of_a_hot_group_is_split(spark):
    """A third of all rows in one group: the join back to the group is spread over tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        group = F.when(F.col("id") % 3 == 0, "HOT").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 500).cast("string")))
        df = spark.range(300_000).select(group.alias("g"), F.xxhash64("id").alias("v"), "id")
        numbered = ranking.number_within(df, ["g"], ["v", "id"], "place")
        last = numbered.groupBy("g").agg(F.max("place").alias("n"))
        assert sorted(values(last)) == sorted(values(df.groupBy("g").count()))
        plan = last._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# ---- quantiles and thresholds of groups -----------------------------------------------------


def test_quantiles_of_groups_with_one_hot_group(spark):
    import numpy as np

    draw = random.Random(11)
    values_of = {"hot": [draw.gauss(0, 1) for _ in range(900)], "one": [3.25], "two": [1.0, 2.5],
                 None: [draw.choice([0.1, 0.2]) for _ in range(40)], "same": [7.5] * 30}
    rows = [(g, v) for g, vs in values_of.items() for v in vs] + [("hot", None), ("empty", None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = {"least": 0.0, "low": 0.25, "mid": 0.5, "odd": 0.937, "most": 1.0}
    found = {r.g: r for r in ranking.quantiles(df, ["g"], "v", shares, "n").collect()}
    assert set(found) == set(values_of)
    for g, vs in values_of.items():
        assert found[g].n == len(vs)
        for name, share in shares.items():
            assert found[g][name] == pytest.approx(np.quantile(vs, share), abs=1e-12)


def test_quantiles_without_groups_and_without_rows(spark):
    df = spark.range(11).selectExpr("double(id) AS v")
    assert [tuple(r) for r in ranking.quantiles(df, [], "v", {"q": 0.25}).collect()] == [(2.5,)]
    nothing = df.where("false")
    assert [tuple(r) for r in ranking.quantiles(nothing, [], "v", {"q": 0.25}).collect()] == [(None,)]
    assert ranking.quantiles(nothing.selectExpr("1 AS g", "v"), ["g"], "v", {"q": 0.25}).count() == 0


def test_quantiles_use_no_window_over_a_group(spark):
    df = spark.range(50).selectExpr("id % 2 AS g", "double(id) AS v")
    plan = ranking.quantiles(df, ["g"], "v", {"q": 0.5})._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("_slice" in line for line in windows)


def test_thresholds_are_the_rows_of_a_place(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "a", "a", "b", None]), draw.randrange(20), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x int, k int").repartition(5)
    from pyspark.sql import functions as F

    found = ranking.thresholds(df, ["g"], ["x", "k"], F.floor(F.col("_size") * 0.5)).collect()
    expected = {}
    for g in {r[0] for r in rows}:
        own = sorted((x, k) for h, x, k in rows if h == g)
        expected[g] = own[len(own) // 2 - 1]
    assert {r.g: (r.x, r.k) for r in found} == expected
    assert ranking.thresholds(df, ["g"], ["x", "k"], F.lit(0)).count() == 0
