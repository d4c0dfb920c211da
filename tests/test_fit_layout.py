"""How rows are dealt out for a fit, and the walk through hand-made trees."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orderloom.operators import ml, trees

NODES = """tree int, node int, feature int, threshold double, left_values array<double>, left int,
right int, value double, weight double"""


def test_split_leaves_rows_where_they_are(spark):
    rows = spark.range(0, 400, 1, 7).select(
        F.concat(F.lit("p"), "id").alias("customer_unique_id"), (F.col("id") % 5 > 0).cast("int").alias("is_churned"))
    split = ml.with_split(rows)
    assert split.rdd.getNumPartitions() == 7
    assert split.where("is_train").groupBy("is_churned").count().orderBy("is_churned").collect() == [(0, 64), (1, 256)]


def test_rows_are_dealt_over_the_cores_whatever_their_layout(spark):
    rows = spark.range(0, 1000, 1, 200).select(F.col("id").cast("string").alias("customer_unique_id"))
    layout = lambda df: sorted(df.rdd.glom().map(lambda p: [r[0] for r in p]).collect())
    dealt = ml._dealt(rows)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert layout(dealt) == layout(ml._dealt(rows.orderBy(F.desc("customer_unique_id")).coalesce(3)))
    assert ml._dealt(rows.limit(0)).count() == 0


def test_walk_through_categories_and_broken_trees(spark):
    nodes = spark.createDataFrame([
        (0, 0, 0, 1.5, None, 1, 2, 0.5, 1.0), (0, 1, None, None, None, None, None, 0.1, 1.0),
        (0, 2, 1, None, [0.0, 2.0], 5, 6, 0.5, 1.0),
        (0, 5, None, None, None, None, None, 0.2, 1.0), (0, 6, None, None, None, None, None, 0.4, 1.0),
        (1, 0, 1, 0.5, None, 1, 2, 0.5, 3.0),  # its right child is missing
        (1, 1, None, None, None, None, None, 0.8, 3.0)], NODES)
    rows = spark.createDataFrame([
        ("low", Vectors.dense(1.5, 0.0)), ("cat", Vectors.dense(2.0, 2.0)),
        ("other", Vectors.dense(2.0, 1.0)), ("half", Vectors.dense(2.0, 0.5)),
        ("nan", Vectors.dense(float("nan"), 0.0)), ("far", Vectors.dense(2.0, 9.0))],
        ["customer_unique_id", "features"])
    found = {r[0]: round(r[1], 9) for r in trees.scored_by_nodes(rows, nodes, 2, False).collect()}
    assert found == {"low": 0.625, "cat": 0.2, "other": 0.4, "half": 0.7, "nan": 0.65, "far": 0.4}


def test_walk_copies_no_row_for_a_tree(spark):
    nodes = spark.createDataFrame([(t, 0, None, None, None, None, None, 0.5, 1.0) for t in range(50)], NODES)
    rows = spark.createDataFrame([("a", Vectors.dense(1.0))], ["customer_unique_id", "features"])
    scored = trees.scored_by_nodes(rows, nodes, 3, False)
    assert scored.collect() == [("a", 0.5)]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
