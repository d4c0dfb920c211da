"""The named queries: coverage, agreement with their check statements, and their plans."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tools.compare import connect, difference

QUERIES, STATEMENTS = driver.queries(), driver.oracle_sql()
#: No SQL equivalent: fitted models.
ROWS_ONLY = {
    "logreg_scores", "forest_scores", "gbt_scores", "model_comparison", "importance_values",
    "top_features", "customer_scores",
}
OWN = sorted(q for q in QUERIES if not re.match(r"op\d+_|pipeline$", q))
SAMPLE = (
    "kpi_monthly", "dim_customers", "fct_orders", "churn_features", "gold_delivery_by_state",
    "top_decile_customers", "seller_flag", "rank_in_state", "spend_percent_rank",
    "order_sequence", "eval_metrics", "impute_median", "customer_segments", "mask_phone",
    "audit_rollup", "running_totals",
)


@pytest.mark.parametrize("library", ["ahocorasick", "public_tokenizers", "corpus_pipeline", "orderloom.llm"])
def test_the_rest_is_served_without_document_operators(library):
    """In a process of its own, in which one import fails."""
    code = f"""
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {library!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as driver
print(len(driver.queries()), len(driver.oracle_sql()), sum(q.startswith("op") for q in driver.queries()))
"""
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True,
                          cwd=Path(driver.__file__).parent, check=True)
    assert done.stdout.split() == [str(len(OWN)), str(len(set(STATEMENTS) & set(OWN))), "0"]


def test_every_query_has_a_check_statement():
    assert {q for q in OWN if q not in STATEMENTS} == ROWS_ONLY
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.fixture(scope="module")
def con(small_folder):
    return connect(small_folder)


@pytest.mark.parametrize("name", SAMPLE)
def test_agreement(spark, small_folder, con, name):
    mine = QUERIES[name](spark, small_folder).toArrow()
    assert difference(mine, con.execute(STATEMENTS[name]).to_arrow_table()) is None
    assert mine.num_rows > 0


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in OWN if n not in ROWS_ONLY])
def test_no_query_pairs_all_rows(spark, small_folder, name):
    plan = QUERIES[name](spark, small_folder)._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_customers_meet_orders_of_every_status(spark, small_folder, con):
    rows = QUERIES["join_customer_orders_left"](spark, small_folder).collect()
    mine = {r.customer_unique_id: (r.total_orders, r.first_order_at) for r in rows}
    assert mine == {k: (n, at) for k, n, at in con.execute("""
        select md5(cast(c_custkey as varchar)), count(o_orderkey),
               min(o_orderdate + to_seconds(o_orderkey * 7919 % 86400))
        from read_parquet(?) left join orders on o_custkey = c_custkey group by c_custkey
    """, [f"{small_folder}/customer.parquet"]).fetchall()}


def test_lines_are_read_once_per_need(spark, small_folder):
    """Payments, baskets by product and baskets by seller each read the lines once."""
    from orderloom.plans.shop import Shop
    shop = Shop.over_fixtures(spark, small_folder)
    plan = shop.fct_orders._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 3 and "Expand" not in plan
    features = shop.churn_features._jdf.queryExecution().optimizedPlan().toString()
    assert features.count("Relation [l_orderkey") == 3 and "Expand" not in features


@pytest.mark.parametrize("name", ["class_weights", "class_balance_90", "filter_tenure"])
def test_labels_and_dates_need_neither_items_nor_payments(spark, small_folder, name):
    plan = QUERIES[name](spark, small_folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_extendedprice" not in plan


@pytest.mark.parametrize("name", [
    "fct_orders", "dim_customers", "churn_features", "seller_ranking", "cohort_retention",
    "delivery_performance", "order_sequence", "rank_in_state",
])
def test_row_grain_never_meets_in_one_task(spark, small_folder, name):
    df = QUERIES[name](spark, small_folder)
    simple = df._jdf.queryExecution().sparkPlan().toString()
    for line in simple.splitlines():
        if "Window [" in line and "windowspecdefinition(" in line:
            grouped = "_slice" in line or "category_en" in line
            assert grouped, line


def test_unused_joins_disappear(spark, small_folder):
    from orderloom.plans.shop import Shop
    shop = Shop.over_fixtures(spark, small_folder)
    plan = shop.int_orders.groupBy("order_status").count()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "lineitem" not in text
    scan = shop.stg_order_payments.select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" in scan and "l_extendedprice" not in scan
