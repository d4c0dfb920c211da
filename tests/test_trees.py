"""Stored models, recomputed by another engine from their exported tables."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderloom.operators import ml, trees
from orderloom.plans.shop import Shop
from orderloom.session import fresh_path, handed_over

SIZES = {ml.LOGISTIC: {"maxIter": 400}, ml.FOREST: {"numTrees": 7, "maxDepth": 4},
         ml.BOOSTED: {"maxIter": 5, "maxDepth": 3}}


@pytest.fixture(scope="module")
def features(spark, small_folder):
    return handed_over(Shop.over_fixtures(spark, small_folder).churn_features)


@pytest.fixture(scope="module")
def fits(features):
    return {m: ml.fitted_once(features, m, drop_leaky=True, **size) for m, size in SIZES.items()}


def exported(spark, df, name):
    path = fresh_path(spark, name)
    df.coalesce(1).write.parquet(path)
    return f"read_parquet('{path.removeprefix('file:')}/*.parquet')"


WALK = """
with recursive walk as (
    select customer_unique_id, v, 0 as node, tree from {rows}, (select distinct tree from {nodes})
    union all
    select customer_unique_id, v,
           if(coalesce(v[feature + 1] <= threshold, list_contains(left_values, v[feature + 1])),
              n."left", n."right"), tree
    from walk join {nodes} n using (tree, node) where n."left" is not null)
select customer_unique_id, {combine} as score
from walk join {nodes} n using (tree, node) where n."left" is null group by 1"""
COMBINE = {ml.FOREST: "sum(value * weight) / sum(weight)",
           ml.BOOSTED: "1 / (1 + exp(-2 * sum(value * weight)))"}


@pytest.mark.parametrize("model", [ml.FOREST, ml.BOOSTED])
def test_another_engine_scores_the_exported_nodes_alike(spark, fits, model):
    found = fits[model]
    nodes = handed_over(trees.node_table(spark, found.path, model == ml.BOOSTED))
    assert set(trees.malformed(nodes).first()) == {0}
    rows = found.ready.select("customer_unique_id", vector_to_array("features").alias("v"))
    theirs = dict(duckdb.sql(WALK.format(
        rows=exported(spark, rows, "rows"), nodes=exported(spark, nodes, "nodes"),
        combine=COMBINE[model])).fetchall())
    depth = SIZES[model]["maxDepth"]
    mine = {r[0]: r[1] for r in trees.scored_by_nodes(
        found.ready, nodes, depth, model == ml.BOOSTED).collect()}
    spark_says = {r.customer_unique_id: r.score for r in found.scored.collect()}
    assert set(mine) == set(theirs) == set(spark_says)
    assert len({round(x, 6) for x in mine.values()}) > 5
    assert all(abs(mine[k] - theirs[k]) < 1e-9 and abs(mine[k] - spark_says[k]) < 1e-9 for k in mine)
    assert ml.agreement(found).where("NOT agrees").count() == 0
    # one level short, the walk ends at inner nodes and finds fewer leaves
    assert trees.scored_by_nodes(found.ready, nodes, depth - 1, model == ml.BOOSTED).exceptAll(
        trees.scored_by_nodes(found.ready, nodes, depth, model == ml.BOOSTED)).count() > 0


def test_rows_stay_while_they_walk(spark, fits):
    found = fits[ml.FOREST]
    nodes = handed_over(trees.node_table(spark, found.path, False))
    plan = trees.scored_by_nodes(found.ready, nodes, 4, False)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_faulty_node_tables_show(spark, fits):
    nodes = handed_over(trees.node_table(spark, fits[ml.FOREST].path, False))
    root = nodes.where("tree = 0 AND node = 0").first()
    gone = nodes.where(~((F.col("tree") == 0) & (F.col("node") == root.left)))
    assert trees.malformed(gone).first().missing == 1
    shared = nodes.withColumn("right", F.when(F.col("tree") == 0, F.col("left")).otherwise(F.col("right")))
    assert trees.malformed(shared).first().shared > 0
    mute = nodes.withColumn("value", F.lit(None).cast("double"))
    assert trees.malformed(mute).first().mute > 0


def test_wrong_scores_do_not_agree(fits):
    found = fits[ml.FOREST]
    off = found._replace(scored=found.scored.withColumn("score", F.col("score") + 1e-6))
    assert ml.agreement(off).where("agrees").count() == 0


def test_gradient_certifies_the_optimum_and_nothing_else(spark, fits):
    found = fits[ml.LOGISTIC]
    slopes = {r.feature: r.gradient for r in ml.optimality(found).collect()}
    assert set(slopes) == {*found.names, "intercept"}
    assert max(map(abs, slopes.values())) < 1e-4
    # the same slopes from the exported rows and coefficients, in another engine
    train = ml._weighted(found.ready.where("is_train"), ml.LOGISTIC)
    rows = exported(spark, train.select(
        "customer_unique_id", F.col("is_churned").alias("y"), F.col("weight").alias("w"),
        vector_to_array("features").alias("v")), "train")
    beta = "[" + ", ".join(f"{float(c)!r}" for c in found.fitted.coefficients.toArray()) + "]::double[]"
    theirs = dict(duckdb.sql(f"""
        with known as (
            select w, w * (1 / (1 + exp(-(list_inner_product(v, {beta}) + {found.fitted.intercept!r}))) - y) as e, v
            from {rows}),
        long as (select w, e, unnest(v) as x, generate_subscripts(v, 1) as slot from known),
        sums as (
            select slot, sum(e * x) / sum(w) as slope,
                   sqrt(greatest((sum(w * x * x) - sum(w * x) * sum(w * x) / sum(w))
                                 / (sum(w) - sum(w * w) / sum(w)), 0)) as spread
            from long group by slot)
        select slot, if(spread > 0, slope / spread + {found.fitted.getRegParam()!r} * ({beta})[slot] * spread, 0)
        from sums""").fetchall())
    assert all(abs(theirs[i + 1] - slopes[n]) < 1e-9 for i, n in enumerate(found.names))
    # coefficients beside the optimum are not certified
    moved = found.fitted.coefficients.toArray().copy()
    moved[0] += 0.5
    off = trees.loss_gradient(train, moved, found.fitted.intercept, found.fitted.getRegParam(), found.names)
    assert max(abs(r.gradient) for r in off.collect()) > 1e-3


@pytest.mark.parametrize("model", ml.MODELS)
def test_importances_come_from_the_nodes(fits, model):
    found = ml.importance_agreement(fits[model])
    assert found.count() == len(fits[model].names) and found.where("NOT agrees").count() == 0


def test_fits_are_named_by_rows_and_settings(spark, features, monkeypatch):
    calls = []
    whole = ml.fit
    monkeypatch.setattr(ml, "fit", lambda *a, **k: calls.append(a) or whole(*a, **k))
    size = {"numTrees": 2, "maxDepth": 2}
    first = ml.fitted_once(features, ml.FOREST, **size)
    again = ml.fitted_once(features.repartition(3), ml.FOREST, **size)
    assert len(calls) == 1 and again.path == first.path
    # a changed value, a repeated row and another size are other fits
    one = F.col("customer_unique_id") == features.first().customer_unique_id
    changed = features.withColumn("total_orders", F.col("total_orders") + one.cast("int"))
    names = {ml.digest(df) for df in (features, changed, features.limit(5), features.union(features))}
    assert len(names) == 4
    assert ml.digest(features, 1) != ml.digest(features, 2)
    assert ml.fitted_once(features, ml.FOREST, numTrees=2, maxDepth=1).path != first.path
    assert len(calls) == 2
