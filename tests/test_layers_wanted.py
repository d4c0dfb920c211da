"""What the stored layers build, and how quoted files and baskets are read."""

from pyspark.sql import functions as F

from orderloom.operators import orders
from orderloom.plans import build, queries
from orderloom.sources import quoted, schemas


def test_layers_end_with_the_wanted_one(spark, tmp_path):
    folder, names = str(tmp_path), {}
    for source, ddl in schemas.SOURCES.items():
        columns = [c.name for c in schemas.struct(ddl)]
        (tmp_path / f"{source}.csv").write_text(",".join(columns) + "\n")
        names[source] = f"{source}.csv"
    layers = {layer: queries._table_name(layer) for layer in ("bronze", "silver", "gold")}
    counts = build.build_layers(spark, folder, names, layers, f"{folder}/out", last="bronze")
    assert counts == {f"raw_{source}": 0 for source in schemas.SOURCES}
    counts = build.build_layers(spark, folder, names, layers, f"{folder}/out", last="silver")
    assert {n for n in counts if not n.startswith("raw_")} == {
        "silver_orders", "silver_customers", "silver_churn_features"}


def test_whole_splits_are_not_searched_for_pieces(spark, tmp_path):
    lines = ["id,text", *[f'{i},"say ""{i}"""' for i in range(30_000)]]
    (tmp_path / "plain.csv").write_text("\n".join(lines) + "\n")
    found = quoted.records(spark, str(tmp_path / "plain.csv"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [r.record for r in found.orderBy("record").collect()] == sorted(lines)


def test_line_breaks_after_plain_batches(spark, tmp_path):
    lines = ["id,text", *[f"{i},x" for i in range(25_000)], '7,"two\nlines"', "8,y"]
    (tmp_path / "mixed.csv").write_text("\n".join(lines) + "\n")
    found = quoted.records(spark, str(tmp_path / "mixed.csv"))
    assert sorted(r.record for r in found.collect()) == sorted(lines)
    assert found.where("header").count() == 1


def test_baskets_add_up_without_decimals_between(spark):
    rows = [(1, 10, 5, 0.1, 0.2), (1, 10, 5, 0.2, None), (1, 11, 6, 1e9, -0.25), (2, None, None, None, None)]
    items = spark.createDataFrame(
        rows, "order_id long, product_id long, seller_id long, price double, freight_value double")
    found = orders.item_rollup(items)
    got = {r.order_id: r for r in found.collect()}
    assert got[1].items_subtotal_brl == 1000000000.3 and got[1].freight_total_brl == -0.05
    assert got[2].items_subtotal_brl is None and got[2].item_count == 1
    assert got[2].distinct_products == 0 and got[1].distinct_products == 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(_price" not in plan and "sum(_whole_price" in plan


def test_imputed_features_are_computed_once(spark, monkeypatch):
    handed = []
    monkeypatch.setattr(queries, "handed_over", lambda df, *a: handed.append(df) or df)
    monkeypatch.setattr(queries.ml, "impute", lambda df: df)

    class Given:
        churn_features = spark.range(1).select(*[
            F.lit(0).alias(c) for c in ("customer_unique_id", *queries.churn.NUMERIC_FEATURES,
                                        *queries.churn.CATEGORICAL_FEATURES)])

    queries.REGISTRY["impute_median"](Given())
    assert len(handed) == 1
