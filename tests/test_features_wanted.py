"""What the model preparation reads, and what payments carry to their order."""

from pyspark.sql import functions as F

from orderloom.operators import ml, staging
from orderloom.plans import queries


def test_categories_are_encoded_without_reading_numbers(spark, small_folder, monkeypatch):
    stored, keep = [], queries.handed_over

    def recorded(df, *purpose):
        stored.append((set(df.columns), df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df, *purpose)

    monkeypatch.setattr(queries, "handed_over", recorded)
    found = queries.all_queries()["one_hot"](spark, small_folder)
    people = found.groupBy("customer_unique_id").agg(F.sum("value").alias("ones"))
    assert people.where("ones <> 4").count() == 0 < people.count()
    (columns, plan), = stored
    assert columns == {"customer_unique_id", *ml.CATEGORICAL_FEATURES}
    assert "AS seller_id" not in plan  # no basket
    assert found.where("feature NOT RLIKE '^(state|order_frequency_segment|satisfaction_segment|primary_payment_type)_'").isEmpty()


def test_preparation_without_numbers(spark):
    rows = ml.impute(spark.createDataFrame([("x", None), ("y", "b")], "a string, c string"), (), ["c"])
    prepared = ml.feature_pipeline(rows, (), ["c"]).fit(rows)
    assert ml.feature_names(prepared, (), ["c"]) == ["c_b", "c_unknown"]
    found = prepared.transform(rows).orderBy("a").select(ml.vector_to_array("features")).collect()
    assert [r[0] for r in found] == [[0.0, 1.0], [1.0, 0.0]]


def test_largest_payment_names_the_type_and_moves_once(spark):
    rows = [("o1", 1, "voucher", 5.0), ("o1", 2, "boleto", 7.0), ("o1", 3, "credit_card", 7.0),
            ("o2", 1, "voucher", None), ("o3", 1, None, 9.0), ("o3", 2, "boleto", 1.0),
            ("o4", 1, "boleto", 2.0), ("o4", None, "voucher", 2.0), ("o5", 1, "a", 3.0), ("o5", 1, "b", 3.0)]
    source = spark.createDataFrame(
        rows, "order_id string, payment_sequential int, payment_type string, payment_value double")
    found = staging.order_payments(source)
    assert {r.order_id: r.primary_payment_type for r in found.collect()} == {
        "o1": "credit_card", "o2": None, "o3": None, "o4": "boleto", "o5": "b"}
    assert "max_by" not in found._jdf.queryExecution().optimizedPlan().toString()
