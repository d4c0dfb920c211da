"""Check statement of every query that SQL can express (DuckDB SQL)."""

from __future__ import annotations

import hashlib

from .ctes import LONG_NAMES, compose, mean, performance, r, total

S: dict[str, str] = {}

# ---- sources and models

for _name in (
    "src_orders", "src_customers", "src_order_items", "src_order_payments",
    "src_order_reviews", "src_products", "src_sellers", "src_geolocation",
    "src_category_translation", "src_churn_predictions", "stg_orders", "stg_customers",
    "stg_order_items", "stg_order_reviews", "stg_order_payments", "stg_products",
    "stg_sellers", "stg_geolocation", "int_orders", "int_customer_orders", "dim_customers",
    "fct_orders", "kpi_monthly", "churn_features", "mart_churn", "silver_orders",
    "silver_customers", "silver_churn_features", "gold_customer_segments",
):
    S[_name] = f"select * from {_name}"

S["stored_silver"] = S["silver_customers"]
S["stored_gold"] = S["gold_customer_segments"]
S["stored_marts"] = S["fct_orders"]
S["gold_monthly_kpis"] = S["gold_monthly"] = "select * from gold_monthly"
S["gold_delivery_by_state"] = "select * from gold_by_state where total_orders >= 100"
S["churn_features_silver"] = "select * from silver_churn_features"
S["src_audit"] = "select * exclude (k, odd) from audit_log"
S["bronze_orders"] = """select * replace (cast(order_id as varchar) as order_id) from src_orders"""
S["bronze_customers"] = "select * from stg_customers"
S["bronze_order_items"] = """
select cast(order_id as varchar) as order_id, cast(order_item_id as varchar) as order_item_id,
       cast(product_id as varchar) as product_id, cast(seller_id as varchar) as seller_id,
       shipping_limit_date, price, freight_value from src_order_items"""
S["bronze_order_payments"] = """
select * replace (cast(order_id as varchar) as order_id) from src_order_payments"""
S["stored_bronze"] = S["bronze_order_payments"]
S["bronze_order_reviews"] = """
select review_id, cast(order_id as varchar) as order_id, review_score, review_comment_title,
       review_comment_message, review_creation_date as review_created_at,
       review_answer_timestamp as review_answered_at from src_order_reviews"""
S["bronze_products"] = """
select cast(product_id as varchar) as product_id, product_category_name as category_name_pt,
       product_name_lenght as name_length, product_description_lenght as description_length,
       product_photos_qty as photos_qty, product_weight_g as weight_g, product_length_cm,
       product_height_cm, product_width_cm from src_products"""
S["bronze_sellers"] = """
select cast(seller_id as varchar) as seller_id, zip_code_prefix, city, state from stg_sellers"""
S["bronze_geolocation"] = """
select geolocation_zip_code_prefix as zip_code_prefix, geolocation_lat as lat,
       geolocation_lng as lng, geolocation_city as city, geolocation_state as state
from src_geolocation"""
S["bronze_category_translation"] = "select * from src_category_translation"

# ---- reading and writing

# an empty text and a missing one look alike in a CSV file: both are read as NULL
S["ingest_csv"] = f"""
select * replace (nullif(review_comment_message, '') as review_comment_message),
       'order_reviews.csv' as _source_file from ({S['bronze_order_reviews']})"""
# the narrowest type that holds all values; written numbers are small or not by their size
_CHOICE = """case when count({c}) = 0 then 'void'
     when any_value(typeof({c})) in ('BIGINT', 'INTEGER') then
          if(max(abs(try_cast({c} as hugeint))) <= 2147483647, 'int', 'bigint')
     when any_value(typeof({c})) = 'DOUBLE' then 'double'
     when any_value(typeof({c})) = 'DATE' then 'date'
     when any_value(typeof({c})) like 'TIMESTAMP%' then 'timestamp_ntz' else 'string' end"""
_SMALL = "(select max(order_id) <= 2147483647 from src_order_payments)"
S["scan_csv_inferred"] = f"""
select * replace (cast(order_id as int) as order_id,
                  cast(payment_sequential as int) as payment_sequential),
       'order_id int, payment_sequential int, payment_type string, payment_installments int, '
       || 'payment_value double' as types
from src_order_payments where {_SMALL}"""
_FILES = {
    "orders": """order_id customer_id order_status order_purchase_timestamp order_approved_at
        order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date""",
    "customers": """customer_id customer_unique_id customer_zip_code_prefix customer_city
        customer_state""",
    "order_items": """order_id order_item_id product_id seller_id shipping_limit_date price
        freight_value""",
    "order_payments": """order_id payment_sequential payment_type payment_installments
        payment_value""",
    "order_reviews": """review_id order_id review_score review_comment_title
        review_comment_message review_creation_date review_answer_timestamp""",
    "products": """product_id product_category_name product_name_lenght
        product_description_lenght product_photos_qty product_weight_g product_length_cm
        product_height_cm product_width_cm""",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "geolocation": """geolocation_zip_code_prefix geolocation_lat geolocation_lng
        geolocation_city geolocation_state""",
    "category_translation": "product_category_name product_category_name_english",
}
S["inferred_types"] = " union all ".join(
    f"select '{source}' as source, {i}::int as position, '{c}' as column_name,"
    f" {_CHOICE.format(c=c)} as data_type from src_{source}"
    for source, columns in _FILES.items() for i, c in enumerate(columns.split())
) + " union all " + " union all ".join(
    f"select 'odd_payments', {i}::int, '{c}', "
    + ("'string'" if c == "payment_installments" else _CHOICE.format(c=c) + " from src_order_payments")
    for i, c in enumerate(_FILES["order_payments"].split())
)
S["scan_csv_declared"] = "select * from src_churn_predictions"
S["scan_table"] = "select * from src_sellers"
S["scan_jsonl_audit"] = """
select timestamp, level, session, function, row_count, duration_ms, status,
       cast(k as varchar) as k from audit_log"""
S["write_audit_event"] = """
select status, level, count(*) as events, cast(sum(row_count) as bigint) as rows_returned
from audit_log group by all"""
S["add_lineage_cols"] = """
select *, 'sellers.csv' as _source_file, true as stamped from src_sellers"""
S["write_table"] = "select * from stg_customers"
S["write_count"] = """
select count(*) as rows_read, count(*) as rows_written from int_orders"""
_RAW_COLUMNS = {
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
              "order_delivered_carrier_date,order_delivered_customer_date,"
              "order_estimated_delivery_date",
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,"
                 "customer_state",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,"
                   "freight_value",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,"
                      "payment_value",
    "order_reviews": "review_id,order_id,review_score,review_comment_title,"
                     "review_comment_message,review_creation_date,review_answer_timestamp",
    "products": "product_id,product_category_name,product_name_lenght,"
                "product_description_lenght,product_photos_qty,product_weight_g,"
                "product_length_cm,product_height_cm,product_width_cm",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                   "geolocation_city,geolocation_state",
    "category_translation": "product_category_name,product_category_name_english",
}
S["compat_views"] = " union all ".join(
    f"select '{t}' as source, count(*) as n_rows, '{c}' as columns from src_{t}"
    for t, c in _RAW_COLUMNS.items()
)
S["create_schema"] = "select * from kpi_monthly"
S["list_tables"] = """
select 'kpi_monthly' as table_name,
       'order_month, total_orders, avg_review_score, avg_days_to_deliver, csat_rate, '
       || 'on_time_rate, avg_order_value_brl, total_gmv_brl, orders_with_comment, '
       || 'low_score_orders, voucher_orders' as columns, count(*) as n_rows
from kpi_monthly
union all
select 'int_customer_orders',
       'customer_unique_id, state, city, total_orders, delivered_orders, canceled_orders, '
       || 'first_order_at, last_order_at, customer_lifespan_days, total_spend_brl, '
       || 'avg_order_value_brl, avg_review_score, review_count, avg_days_to_deliver, '
       || 'on_time_deliveries', count(*)
from int_customer_orders"""
S["materialise_view"] = "select * from stg_customers"
S["materialise_table"] = f"""
select order_status, count(*) as orders, cast({total('total_payment_value')} as double) as paid
from int_orders group by order_status"""
S["write_predictions"] = "select * from scores"
S["rows_out"] = "select * from kpi_monthly order by order_month"

# ---- projections and filters

S["surrogate_key"] = """
select product_id, md5(product_id || '-'
       || ifnull(product_category_name, '_dbt_utils_surrogate_key_null_')) as product_sk
from src_products"""
_STATUS = "select order_status, count(*) as n, max(purchased_at) as newest from stg_orders"
S["filter_status_eq"] = _STATUS + " where order_status = 'delivered' group by 1"
S["filter_status_in"] = _STATUS + """
 where order_status in ('approved','delivered','processing','shipped') group by 1"""
S["filter_not_null"] = """
select order_id, days_to_deliver, review_score from int_orders
where (days_to_deliver is null or review_score is null) = false"""
S["filter_nonneg"] = "select order_id, review_score, speed from rated"
S["filter_spend_pos"] = """
select count(*) filter (where total_spend_brl > 0) as spenders,
       count(*) filter (where total_spend_brl >= 100) as worth_keeping from dim_customers"""
S["filter_month_between"] = """
select order_month, total_orders from kpi_monthly
where order_month >= date '1996-03-01' and order_month <= date '1997-02-28'"""
S["filter_tenure"] = "select customer_unique_id, days_since_first_order from churn_features"
S["has_comment"] = """
select review_id, ifnull(length(comment_message), 0) > 0 as has_review_comment
from stg_order_reviews"""
S["delivered_on_time"] = """
select order_id, not (customer_delivered_at > estimated_delivery_at) as delivered_on_time
from stg_orders"""
S["bool_to_int"] = """
select customer_unique_id, has_low_review, had_late_delivery, used_voucher_ever,
       used_credit_card_ever from churn_features"""
S["default_nulls"] = """
select customer_unique_id, cancel_rate, avg_freight_brl, avg_review_score,
       avg_days_to_deliver, primary_payment_type, avg_item_count from churn_features"""
S["seg_frequency"] = """
select order_frequency_segment as segment, count(*) as customers from dim_customers group by 1"""
S["seg_satisfaction"] = """
select satisfaction_segment as segment, count(*) as customers from dim_customers group by 1"""
S["seg_risk_tier"] = "select customer_unique_id, churn_risk_tier as tier from scores"
BUCKET = """case when days_to_deliver > 21 or days_to_deliver is null
              then '5. 22+ days (extreme)'
            when days_to_deliver > 14 then '4. 15–21 days (very slow)'
            when days_to_deliver > 7 then '3. 8–14 days (slow)'
            when days_to_deliver > 3 then '2. 4–7 days (standard)'
            else '1. ≤ 3 days (fast)' end"""
S["seg_delivery_bucket"] = f"""
select order_id, {BUCKET} as bucket from int_orders where days_to_deliver is not null"""
TILE = "ntile(10) over (order by total_spend_brl, customer_unique_id)"
S["seg_spend_tier"] = f"""
select customer_unique_id, case when d = 10 then 'Top 10% spender' when d in (8, 9)
       then 'High spender' when d between 5 and 7 then 'Mid spender' else 'Low spender' end
       as tier
from (select customer_unique_id, {TILE} as d from spenders)"""
_COHORT = f"""
select *, {r('returned_customers / cohort_size * 100.0e0', 2)} as retention_pct,
       case when retention_pct < 1 then 'Below average retention'
            when retention_pct < 2 then 'Average retention'
            else 'Above average retention' end as retention_label
from cohorts"""
S["seg_retention_label"] = f"""
select cohort_month, retention_label from ({_COHORT}) where cohort_size >= 20"""
ACTION = """case
    when churn_risk_tier = 'medium' then 'Nurture: send re-engagement email with personalised offer'
    when churn_risk_tier = 'low' or ifnull(satisfaction_segment, 'neutral') = 'neutral'
        then 'Monitor: include in loyalty program communications'
    when satisfaction_segment = 'satisfied'
        then 'Win-back: satisfied but inactive — offer loyalty discount'
    else 'Service recovery: address complaint before re-engagement' end"""
S["recommend_action"] = f"select customer_unique_id, {ACTION} as action from mart_churn"
S["weight_by_segment"] = """
select customer_unique_id, case order_frequency_segment when 'one_time' then 0e0
       when 'repeat' then 0.10e0 else 0.15e0 end as weight from dim_customers"""


def _hmac(text: str, chars: int = 8, secret: bytes = b"demo-secret-for-checks") -> str:
    """Keyed hash from two plain hashes over padded keys."""
    key = secret if len(secret) <= 64 else hashlib.sha256(secret).digest()
    key = key + bytes(64 - len(key))
    pads = ["".join(f"{b ^ pad:02X}" for b in key) for pad in (0x36, 0x5C)]
    inner = f"unhex(sha256(unhex('{pads[0]}') || encode({text})))"
    return f"'cust_' || substr(sha256(unhex('{pads[1]}') || {inner}), 1, {chars})"


_MASKED = f"* replace ({_hmac('customer_unique_id')} as customer_unique_id)"
S["customer_segments"] = f"""
select {_MASKED} from (
    select customer_unique_id, state, city, total_orders, total_spend_brl,
           avg_order_value_brl, avg_review_score, avg_days_to_deliver, order_frequency_segment,
           satisfaction_segment, first_order_at, last_order_at, customer_lifespan_days
    from dim_customers where state = 'NATION_3' and order_frequency_segment = 'loyal'
      and satisfaction_segment = 'dissatisfied' and total_spend_brl >= 1000
    order by total_spend_brl desc, customer_unique_id limit 40)"""
_RISK = f"""
    select customer_unique_id, {r('churn_probability', 4)} as churn_probability, churn_risk_tier,
           state, order_frequency_segment, satisfaction_segment, total_orders, total_spend_brl,
           avg_review_score, last_order_at from mart_churn"""
S["churn_risk"] = f"""
select {_MASKED} from ({_RISK}
    where churn_risk_tier = 'high' and total_spend_brl >= 500
    order by churn_probability desc, customer_unique_id limit 60)"""
S["monthly_kpis_range"] = """
select * exclude (orders_with_comment) from kpi_monthly
where order_month between date '1995-06-01' and date '1999-12-31'"""
S["validate_date_col"] = r"""
with texts as (
    select order_id, case order_id % 5 when 0 then strftime(purchased_at, '%Y-%m-%d')
           when 1 then strftime(purchased_at, '%d/%m/%Y')
           when 2 then strftime(purchased_at, '%Y-%m-31')
           when 3 then strftime(purchased_at, '%Y-%m-%d OR 1=1')
           else strftime(purchased_at, '%Y%m%d') end as written from stg_orders),
read as (
    select *, case when regexp_full_match(written, '\d{4}-\d{2}-\d{2}')
              then try_cast(written as date) end as parsed_date from texts)
select *, case when parsed_date is null then 'not a valid date'
          when parsed_date < date '1996-01-01' or parsed_date > date '1999-12-31'
          then 'outside range' end as rejected_because from read"""
S["run_sql"] = """
select state, count(*) as customers, cast(sum(total_orders) as bigint) as orders
from dim_customers where state is not null group by state"""
S["bind_params"] = """
select customer_unique_id, total_orders from dim_customers
where state = 'NATION_7' and total_orders > 4"""
S["project_monthly_view"] = f"""
select cast(order_month as date) as month, total_orders,
       {r('csat_rate * 100.0e0', 2)} as csat_pct, {r('on_time_rate * 100.0e0', 2)} as on_time_pct,
       avg_review_score, {r('total_gmv_brl / 1000', 1)} as gmv_k_brl, avg_days_to_deliver,
       low_score_orders from kpi_monthly"""
S["project_monthly_trend"] = f"""
select strftime(order_month, '%Y-%m') as month, total_orders,
       {r('csat_rate * 100.0e0', 1)} as csat_pct, {r('on_time_rate * 100.0e0', 1)} as on_time_pct,
       {r('total_gmv_brl / 1000', 1)} as gmv_k_brl from gold_monthly"""
S["project_churn_view"] = "select * from score_listing"
S["at_risk_list"] = """
select customer_unique_id, churn_risk_tier, churn_prob, spend_brl, total_orders, avg_review,
       state, last_order
from score_listing where spend_brl > 200 and churn_prob > 0.5
order by churn_prob desc, customer_unique_id limit 50"""
S["audit_filter"] = """
select timestamp, function, status, row_count from audit_log
where function in ('error', 'click') and status in ('error', 'success')"""

# ---- joins

S["join_order_payment_review"] = """
select order_id, total_payment_value, primary_payment_type, review_score, has_review_comment
from int_orders"""
S["join_order_payment_review_bucketed"] = S["join_order_payment_review"]
S["join_translation"] = "select product_id, category_name_en, category_name_pt from stg_products"
S["join_customer_orders_left"] = """
select customer_unique_id,
       first(state order by purchased_at desc, customer_id desc)
           filter (where purchased_at is not null) as state,
       count(order_id) as total_orders, min(purchased_at) as first_order_at
from stg_customers left join stg_orders using (customer_id) group by 1"""
S["join_orders_customer_left"] = """
select customer_unique_id, total_orders, last_order_at from silver_customers"""
S["join_fact_star"] = """
select order_id, customer_unique_id, customer_sk, item_count, items_subtotal_brl
from fct_orders"""
S["join_fact_star_bucketed"] = S["join_fact_star"]
S["join_geo_composite"] = "select customer_unique_id, city, state, lat, lng from dim_customers"
S["cross_reference_date"] = """
select customer_unique_id, last_order_at, reference_date
from dim_customers cross join newest_purchase"""
S["collect_reference_date"] = """
select customer_unique_id, days_since_last_order, days_since_first_order
from silver_churn_features"""
S["join_churn_features"] = """
select customer_unique_id, total_orders, avg_item_count, avg_distinct_sellers
from churn_features"""
S["join_predictions"] = """
select customer_unique_id, churn_probability, churn_risk_tier, state, total_orders
from mart_churn"""
S["join_predictions_inner"] = """
select customer_unique_id, churn_risk_tier, city, total_spend_brl
from scores join dim_customers using (customer_unique_id)"""
S["join_seller_category"] = "select * from seller_performance"
S["join_fact_dim_state"] = "select * rename (state as dimension) from state_performance"
S["join_gold_state"] = "select * from gold_by_state"
S["cohort_self_join"] = "select * from cohorts"

# ---- aggregations

S["agg_payments"] = "select * from stg_order_payments"
S["agg_geo_zip"] = "select * from stg_geolocation"
S["agg_geo_city"] = "select * from city_centroids"
S["agg_geo_city_raw"] = "select * from city_centroids_raw"
S["agg_items"] = "select * from item_rollup"
S["agg_payments_silver"] = "select * from silver_payments"
S["churn_order_aggs"] = "select * from order_signals"
S["arg_max"] = """
select seller_id, product_id from src_order_items
qualify row_number() over (partition by seller_id
        order by price desc, order_id desc, order_item_id desc) = 1"""
S["bool_or_agg"] = """
select payment_installments, bool_or(payment_value > 99000) as any_large,
       bool_or(payment_type = 'cash') as any_cash from src_order_payments group by 1"""
S["any_value"] = "select zip_code_prefix, city, state from stg_geolocation"
S["cond_count"] = """
select order_status, count(*) filter (where delivered_on_time) as on_time,
       count(*) filter (where review_score = 1) as low_score,
       count(*) filter (where used_voucher) as with_voucher
from int_orders group by order_status"""
S["safe_ratio"] = f"""
select order_status, {r('count(*) filter (where review_score >= 4) / nullif(count(review_score), 0)', 4)}
       as csat_rate from int_orders group by order_status"""
S["unsafe_ratio"] = "select order_month, csat_rate, on_time_rate from gold_monthly"
S["count_distinct"] = """
select seller_id, count(distinct order_id) as orders, count(distinct product_id) as products
from src_order_items group by seller_id"""
S["delivery_performance"] = """
select * rename (state as dimension) from state_performance where total_orders >= 100
order by avg_days_to_deliver desc, state limit 30"""
for _by in ("order_day_of_week", "order_month", "primary_payment_type"):
    S[f"delivery_performance_{_by}"] = f"""
select {performance(f'{_by} as dimension', (2, 2, 3), LONG_NAMES)}
from fct_orders where order_status = 'delivered' and {_by} is not null
group by {_by} having count(*) >= 50 order by avg_days_to_deliver desc, {_by} limit 40"""
S["delivery_by_state_dash"] = "select * from state_dashboard"
S["delivery_bucket_kpis"] = f"""
with grouped as (
    select {BUCKET} as delivery_bucket, count(*) as total_orders,
           {r('avg(review_score)', 3)} as avg_review_score,
           {r('avg(days_to_deliver)', 1)} as avg_days_actual,
           {r('count(*) filter (where review_score >= 4) / count(review_score) * 100.0e0', 1)}
               as csat_pct,
           {r('count(*) filter (where delivered_on_time) / count(*) * 100.0e0', 1)}
               as on_time_pct
    from fct_orders where order_status = 'delivered' and days_to_deliver is not null
      and review_score is not null group by 1)
select *, {r('total_orders / (select sum(total_orders) from grouped) * 100.0e0', 1)}
       as pct_of_orders from grouped"""
S["kpi_header"] = f"""
select cast(sum(total_orders) as bigint) as total_orders,
       {r(f"{mean('csat_rate')} * 100.0e0", 1)} as avg_csat_pct,
       {r(f"{mean('on_time_rate')} * 100.0e0", 1)} as avg_on_time_pct,
       {r(mean('avg_review_score'), 2)} as avg_review_score,
       {r(f"cast({total('total_gmv_brl')} as double) / 1e6", 2)} as total_gmv_m_brl
from kpi_monthly"""


def _weighted(c: str) -> str:
    known = f"sum(total_orders) filter (where {c} is not null)"
    return f"cast(sum(cast({c} as decimal(28,8)) * total_orders) as double) / nullif({known}, 0)"


S["kpi_header_weighted"] = f"""
select cast(sum(total_orders) as bigint) as total_orders,
       {r(f"{_weighted('csat_rate')} * 100.0e0", 1)} as avg_csat_pct,
       {r(f"{_weighted('on_time_rate')} * 100.0e0", 1)} as avg_on_time_pct,
       {r(_weighted('avg_review_score'), 2)} as avg_review_score,
       {r(f"cast({total('total_gmv_brl')} as double) / 1e6", 2)} as total_gmv_m_brl
from kpi_monthly"""
S["segment_breakdown"] = f"""
select order_frequency_segment, satisfaction_segment, count(*) as customers,
       {r(mean('total_spend_brl'), 2)} as avg_spend_brl,
       {r(mean('avg_review_score'), 2)} as avg_review
from gold_customer_segments group by all"""
S["frequency_spend"] = f"""
select order_frequency_segment, count(*) as customers,
       {r(mean('total_spend_brl'), 2)} as avg_spend_brl from dim_customers group by 1"""
S["state_avg_days"] = f"""
select state, {r(mean('avg_days_to_deliver'), 2)} as avg_delivery_days from dim_customers
group by state order by avg_delivery_days desc nulls last, state limit 10"""
S["score_by_weekday"] = f"""
select order_day_of_week, count(*) as orders, {r('avg(review_score)', 3)} as avg_review_score
from fct_orders group by 1"""
S["cohort_spend"] = f"""
select date_trunc('month', first_order_at) as cohort_month, count(*) as customers,
       {r(mean('total_spend_brl'), 2)} as avg_lifetime_spend from dim_customers group by 1"""
S["late_vs_ontime_csat"] = f"""
select if(delivery_delta_days >= 3, 'late', 'on_time') as punctuality, count(*) as orders,
       {r('count(*) filter (where review_score > 3) / nullif(count(review_score), 0) * 100.0e0', 1)}
           as csat_pct
from fct_orders where order_status = 'delivered'
  and (delivery_delta_days >= 3 or delivered_on_time) group by 1"""
S["status_distribution"] = "select order_status, count(*) as n from stg_orders group by 1"


def _balance(table: str, label: str) -> str:
    return f"""
select {label}, count(*) as n,
       {r(f'count(*) / (select count(*) from {table}) * 100.0e0', 2)} as pct
from {table} group by {label}"""


S["class_balance"] = _balance("silver_churn_features", "churned")
S["class_balance_90"] = _balance("churn_features", "is_churned")
S["share_of_total"] = _balance("stg_orders", "order_status")
S["delivery_sanity"] = f"""
select {r('avg(days_to_deliver)', 1)} as avg_days,
       {r('sum(cast(delivered_on_time as int)) / count(*) * 100.0e0', 1)} as on_time_pct,
       {r('avg(review_score)', 2)} as avg_review
from silver_orders where order_status = 'delivered'"""
S["tier_counts"] = """
select churn_risk_tier, count(*) as customers from scores group by 1"""
S["score_histogram"] = """
select cast(least(floor(churn_prob * 40) + 1, 40) as bigint) as bin, count(*) as customers
from score_listing group by 1"""
S["review_histogram"] = f"""
select speed, review_score, count(*) as reviews,
       {r('count(*) / sum(count(*)) over (partition by speed) * 100.0e0', 1)} as pct
from rated group by speed, review_score"""


def _quartiles(
    segment: str, value: str = "churn_prob", source: str = "score_listing",
    count: str = "customers",
) -> str:
    marks = {"minimum": 0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75,
             "maximum": 1}
    columns = ", ".join(
        f"{r(f'quantile_cont({value}, {q})', 6)} as {n}" for n, q in marks.items()
    )
    return f"""select {segment}, count({value}) as {count}, {columns} from {source}
        where {value} is not null group by 1"""


S["score_quartiles"] = _quartiles("freq_segment")
S["score_quartiles_by_satisfaction"] = _quartiles("sat_segment")
S["payment_quartiles"] = _quartiles(
    "payment_type", "payment_value", "src_order_payments", "payments")
S["spend_quartiles_by_state"] = _quartiles("state", "total_spend_brl", "dim_customers")
S["having_min"] = """
select city, state, count(*) as accounts from stg_customers group by all having count(*) > 49"""
S["group_by_alias"] = f"""
select {BUCKET} as delivery_bucket, count(*) as orders from int_orders group by 1"""

# ---- windows

S["mom_delta"] = f"""
with months as (
    select cast(order_month as date) as month, total_orders,
           {r('csat_rate * 100.0e0', 1)} as csat_pct,
           {r('on_time_rate * 100.0e0', 1)} as on_time_pct,
           {r('total_gmv_brl / 1000', 1)} as gmv_k_brl
    from kpi_monthly)
select now.month, now.total_orders, now.csat_pct,
       {r('now.csat_pct - before.csat_pct', 1)} as csat_delta_pp, now.on_time_pct,
       {r('now.on_time_pct - before.on_time_pct', 1)} as on_time_delta_pp, now.gmv_k_brl,
       {r('(now.gmv_k_brl - before.gmv_k_brl) / nullif(before.gmv_k_brl, 0) * 100.0e0', 1)}
           as gmv_growth_pct
from months now left join months before
  on before.month = (select max(month) from months m where m.month < now.month)"""
_RUNNING = f"""
select cast(k.order_month as date) as month, k.total_orders,
       {r('any_value(k.total_gmv_brl) / 1000', 1)} as gmv_k_brl,
       cast(sum(e.total_orders) as bigint) as cumulative_orders,
       {r('cast(sum(cast(e.total_gmv_brl as decimal(28,8))) as double) / 1000', 1)}
           as cumulative_gmv_k_brl,
       {r('''cast(sum(cast(e.avg_review_score as decimal(28,8)) * e.total_orders) as double)
             / sum(e.total_orders)''', 3)} as running_avg_review
from kpi_monthly k join kpi_monthly e on e.order_month <= k.order_month
group by k.order_month, k.total_orders"""
S["running_totals"] = f"select * exclude (running_avg_review) from ({_RUNNING})"
S["running_weighted_avg"] = f"select month, running_avg_review from ({_RUNNING})"
S["spend_ntile"] = f"select *, {TILE} as spend_decile from spenders"
S["spend_percent_rank"] = f"""
select *, {r('percent_rank() over (order by total_spend_brl)', 4)} as spend_percentile
from spenders"""
S["rank_in_state"] = """
select *, rank() over (partition by state order by total_spend_brl desc) as rank_in_state
from spenders"""
S["top_decile_customers"] = f"""
with ranked as (
    select d.*, {TILE} as spend_decile,
           {r('percent_rank() over (order by total_spend_brl)', 4)} as spend_percentile,
           rank() over (partition by state order by total_spend_brl desc) as rank_in_state
    from dim_customers d where total_spend_brl > 0)
select customer_unique_id, state, total_orders, {r('total_spend_brl', 2)} as total_spend_brl,
       avg_review_score, order_frequency_segment, satisfaction_segment, spend_decile,
       spend_percentile, rank_in_state, 'Top 10% spender' as spend_tier
from ranked where spend_decile = 10
order by total_spend_brl desc, customer_unique_id desc limit 100"""
S["latest_review"] = "select * exclude (review_id) from latest_reviews"
S["latest_address"] = "select customer_unique_id, state, city from int_customer_orders"
S["order_sequence"] = """
select customer_unique_id, order_id, purchased_at, row_number() over (
       partition by customer_unique_id order by purchased_at, order_id) as order_rank
from fct_orders where order_status in ('delivered','shipped','processing','approved')"""
S["max_over_all"] = """
select customer_unique_id, total_spend_brl, max(total_spend_brl) over () as highest_spend
from dim_customers"""
S["category_median_gap"] = """
select distinct category_en, avg_delivery_days, days_above_category_median
from seller_ranked"""
S["category_size"] = """
select distinct category_en, avg_delivery_days, sellers_in_category from seller_ranked"""
_SELLERS = """
select seller_id, category_en, orders, avg_delivery_days, on_time_pct, avg_review,
       delivery_rank_in_category, days_above_category_median, sellers_in_category,
       performance_flag from seller_flagged"""
S["seller_ranking"] = _SELLERS + " where delivery_rank_in_category <= 5"
S["seller_flag"] = """
select seller_id, category_en, performance_flag from seller_flagged"""
S["cohort_retention"] = f"select * from ({_COHORT}) where cohort_size >= 50"

# ---- sorting and limiting

S["sort_month"] = "select order_month, total_orders from kpi_monthly"
S["topk_spend"] = """
select customer_unique_id, total_spend_brl from dim_customers
order by total_spend_brl desc nulls last, customer_unique_id limit 100"""
_PRIORITY = f"""
select customer_unique_id, churn_prob, churn_risk_tier, state, total_orders,
       {r('total_spend_brl', 2)} as total_spend_brl,
       {r('avg_review_score', 2)} as avg_review_score, order_frequency_segment,
       satisfaction_segment, cast(last_order_at as date) as last_order_date,
       date_diff('day', last_order_at, timestamp '2001-08-31') as days_inactive,
       {r('priority', 3)} as priority_score, {ACTION} as recommended_action
from retention_targets order by priority desc, customer_unique_id"""
S["retention_priority"] = _PRIORITY + " limit 50"
S["topk_priority"] = f"""
select customer_unique_id, priority_score from ({_PRIORITY} limit 50)"""
S["topk_churn"] = f"{_RISK} order by churn_probability desc, customer_unique_id limit 25"
S["worst_states"] = """
select state, total_orders, avg_days_to_deliver, on_time_pct, avg_review_score
from gold_by_state where total_orders >= 100
order by avg_days_to_deliver desc, state limit 5"""
S["worst_on_time"] = """
select * rename (state as dimension) from state_performance where total_orders >= 100
order by on_time_pct, state limit 10"""
S["topk_per_group"] = """
select category_en, seller_id, delivery_rank_in_category from seller_ranked
where delivery_rank_in_category <= 5"""
S["dynamic_sort"] = """
select * from state_dashboard order by csat_pct desc nulls last, state"""
S["limit_clamp"] = """
select customer_unique_id, total_orders from dim_customers
order by total_spend_brl desc nulls last, customer_unique_id limit 500"""

# ---- set operations

S["distinct_rows"] = "select distinct city, state from stg_customers"
S["distinct_on"] = "select order_id, review_score, review_created_at from latest_reviews"

# ---- scalar functions

S["fn_cast_ts"] = """
select order_id, if(order_id % 10 = 0, null, order_purchase_timestamp) as purchased_at
from src_orders"""
S["fn_cast_date"] = "select order_id, cast(purchased_at as date) as day from stg_orders"
S["fn_days_between"] = """
select order_id,
       cast(customer_delivered_at as date) - cast(purchased_at as date) as days_to_deliver,
       cast(customer_delivered_at as date) - cast(estimated_delivery_at as date) as delta
from stg_orders"""
S["fn_hours_between"] = """
select order_id, (epoch(approved_at) - epoch(purchased_at)) / 3600 as hours from stg_orders"""
S["fn_month_trunc"] = """
select cast(strftime(purchased_at, '%Y-%m-01') as timestamp) as order_month, count(*) as n
from stg_orders group by 1"""
S["fn_week_trunc"] = """
select cast(cast(purchased_at as date) - cast(isodow(purchased_at) - 1 as int) as timestamp)
           as order_week, count(*) as n from stg_orders group by 1"""
S["fn_day_of_week"] = """
select cast(isodow(purchased_at) % 7 as bigint) as day_of_week, count(*) as n
from stg_orders group by 1"""
S["fn_days_since_ref"] = """
select order_id, date '2001-08-31' - cast(purchased_at as date) as days_inactive
from stg_orders"""
S["fn_interval_minus"] = """
select order_id, purchased_at - interval 90 day as cutoff from stg_orders"""
S["fn_month_label"] = """
select substr(cast(purchased_at as varchar), 1, 7) as month, count(*) as n
from stg_orders group by 1"""
S["fn_now"] = "select true as in_past, count(*) as n from stg_orders"
S["fn_round"] = f"""
select payment_type, {r(mean('payment_value'), 2)} as mean_value,
       {r(mean('payment_value'), 0)} as whole_value from src_order_payments group by 1"""
S["fn_nullif"] = """
select product_id, if(product_photos_qty = 0, null, product_photos_qty) as photos
from src_products"""
S["fn_coalesce"] = """
select product_id, ifnull(product_category_name, 'unknown') as category from src_products"""
S["fn_scale"] = f"""
select order_month, {r('csat_rate * 100.0e0', 2)} as csat_pct,
       {r('total_gmv_brl / 1e6', 3)} as gmv_m_brl from kpi_monthly"""
S["fn_priority_score"] = f"""
select customer_unique_id, churn_prob, total_spend_brl, priority_score
from ({_PRIORITY})"""
S["fn_upper"] = "select distinct upper(city) as city, state from stg_customers"
S["fn_md5_key"] = "select order_id, order_item_id, order_item_sk from stg_order_items"
S["fn_string_agg"] = """
select cast(payment_installments as varchar) as table_name,
       string_agg(payment_type, ', ' order by payment_type) as columns
from (select distinct payment_installments, payment_type from src_order_payments)
group by 1"""
S["fn_preview"] = """
select ts as timestamp, trim(substr('  SELECT k FROM ' || function, 1, 20)) as preview
from audit_calls"""
S["fn_json_fields"] = "select ts as timestamp, k, email from audit_calls"
S["fn_redact_map"] = """
select ts as timestamp, cast(k as varchar) as k, '<redacted>' as email,
       if(odd, 'x''; DROP TABLE t; --', 'plain') as filter from audit_calls"""
S["mask_customer_id"] = f"""
select customer_unique_id, {_hmac('customer_unique_id')} as masked,
       if(name = '', '', {_hmac('name', 12)}) as masked_name from contacts"""
_EMAIL = """case when not contains(email, '@') then '***' else left(email, 1) || '***@***'
       || ['.uk', '.com', ''][n % 3 + 1] end"""
S["mask_email"] = f"select customer_unique_id, {_EMAIL} as masked from contacts"
S["mask_phone"] = """
select customer_unique_id, if(no_phone, '***', '+' || country || '-***-'
       || repeat('*', length(line))) as masked from contacts"""
S["mask_name"] = """
select customer_unique_id, if(name = '', '***', left(segment, 1) || '*** d*** C*** '
       || left(split_part(name, ' ', 4), 1) || '***') as masked from contacts"""
S["mask_columns"] = f"""
select {_hmac('customer_unique_id')} as customer_unique_id, {_EMAIL} as email, city
from contacts"""

# ---- access log as batch

S["audit_rollup"] = f"""
select date_trunc('hour', ts) as window_start, function, count(*) as calls,
       count(*) filter (where status = 'error') as errors,
       cast(sum(k * 20) as bigint) as rows_returned, {r(mean('duration'), 4)} as avg_ms
from audit_calls group by 1, 2"""

S["audit_live"] = S["audit_rollup"]
S["audit_live_late"] = """
select cast(max(timestamp) as timestamp) as seen,
       count(*) + count(*) filter (where day = first_day) as events,
       count(*) filter (where day = first_day) as late
from (select timestamp, substr(timestamp, 1, 10) as day,
             min(substr(timestamp, 1, 10)) over () as first_day from audit_log)"""
S["kpi_monthly_live"] = S["kpi_monthly_refreshed"] = S["kpi_monthly"]

# ---- models and statistics

S["column_medians"] = f"select column_name, {r('median', 6)} as median from medians"
_NUMBERS = """days_since_last_order days_since_first_order customer_lifespan_days
recency_to_lifespan_ratio total_orders delivered_orders canceled_orders cancel_rate total_spend_brl
avg_order_value_brl avg_freight_brl freight_to_value_ratio avg_review_score review_count
has_low_review pct_reviews_with_comment avg_days_to_deliver on_time_delivery_rate had_late_delivery
used_voucher_ever used_credit_card_ever avg_item_count avg_distinct_products
avg_distinct_sellers""".split()
_CATEGORIES = "state order_frequency_segment satisfaction_segment primary_payment_type".split()
_FILLED = ", ".join(
    [f"ifnull({c}::double, (select median({c}::double) from churn_features)) as {c}" for c in _NUMBERS]
    + [f"ifnull({c}, 'unknown') as {c}" for c in _CATEGORIES]
)
S["impute_median"] = f"select customer_unique_id, {_FILLED} from churn_features"
S["standard_scale"] = "with filled as (" + S["impute_median"] + ") select customer_unique_id, " + (
    ", ".join(
        r(f"({c} - (select avg({c}) from filled)) / (select if(stddev_pop({c}) = 0, 1, stddev_pop({c})) from filled)", 4)
        + f" as {c}" for c in _NUMBERS)
) + " from filled"
S["one_hot"] = "with filled as (" + S["impute_median"] + ") " + " union all ".join(
    f"""select customer_unique_id, '{c}_' || label as feature, if({c} = label, 1e0, 0e0) as value
    from filled, (select distinct {c} as label from filled)""" for c in _CATEGORIES
)
_SPLIT = """(
    select *, row_number() over (
               partition by is_churned
               order by ('0x' || substr(md5('42-' || customer_unique_id), 1, 15))::bigint,
                        customer_unique_id)
           <= floor(0.8e0 * count(*) over (partition by is_churned) + 0.5e0) as is_train
    from churn_features)"""
S["stratified_split"] = f"""
select is_train, is_churned, count(*) as n from {_SPLIT} group by all"""
S["stratified_split_members"] = f"select customer_unique_id, is_churned, is_train from {_SPLIT}"
_SLOTS = " union all ".join(
    [f"select '{c}' as feature" for c in _NUMBERS]
    + [f"(select distinct '{c}_' || ifnull({c}, 'unknown') as feature from {_SPLIT} where is_train)"
       for c in _CATEGORIES]
)
S["fit_logreg"] = f"""
select feature, 0e0 as gradient from ({_SLOTS}) union all select 'intercept', 0e0"""
S["fit_forest"] = S["fit_gbt"] = f"""
select customer_unique_id, is_train, is_churned as label, true as agrees from {_SPLIT}"""
S["model_nodes"] = """
select model, trees, 0::bigint as orphans, 0::bigint as shared, 0::bigint as missing,
       0::bigint as mute
from (values ('random_forest', 200::bigint), ('gradient_boosting', 300::bigint)) m(model, trees)"""
S["feature_importance"] = f"""
select model, feature, true as agrees
from ({_SLOTS}), (values ('logistic_regression'), ('random_forest'), ('gradient_boosting')) m(model)"""
S["score_customers"] = """
select customer_unique_id, true as probability_agrees, true as label_agrees, true as known_model,
       true as timed from churn_features"""
S["class_weights"] = """
select count(*) / (2.0e0 * count(*) filter (where is_churned = 0)) as balanced_retained,
       count(*) / (2.0e0 * count(*) filter (where is_churned = 1)) as balanced_churned,
       count(*) filter (where is_churned = 1) / count(*) filter (where is_churned = 0)
           as ratio_churned from churn_features"""
S["best_threshold"] = f"select threshold, {r('f1', 6)} as best_f1 from best"
S["eval_metrics"] = f"""
with cells as (
    select count(*) filter (where label = 1 and score >= threshold) as hit,
           count(*) filter (where label = 1 and score < threshold) as missed,
           count(*) filter (where label = 0 and score >= threshold) as alarm,
           count(*) filter (where label = 0 and score < threshold) as clear,
           any_value(threshold) as threshold
    from given_scores, best),
pairs as (
    select sum(p.ones * n.zeros * case when p.score > n.score then 1e0
                                       when p.score = n.score then 0.5e0 else 0 end)
           / (sum(p.ones * n.zeros)) as auc
    from score_counts p, score_counts n),
curve as (
    select ones, sum(ones) over down as tp, sum(ones + zeros) over down as called
    from score_counts window down as (order by score desc)),
ap as (select cast(sum(cast(ones * (tp / called) as decimal(38,12))) as double) / sum(ones)
              as precision from curve)
select {r('auc', 4)} as roc_auc, {r('precision', 4)} as average_precision,
       {r('(2 * hit / (2 * hit + alarm + missed) + 2 * clear / (2 * clear + alarm + missed)) / 2', 4)}
           as f1_macro,
       {r('2 * clear / (2 * clear + alarm + missed)', 4)} as f1_retained,
       {r('clear / (clear + alarm)', 4)} as recall_retained,
       {r('(hit + clear) / (hit + clear + alarm + missed)', 4)} as accuracy,
       {r('threshold', 3)} as threshold
from cells, pairs, ap"""
S["roc_points"] = f"""
select score, {r('sum(zeros) over down / sum(zeros) over ()', 8)} as fpr,
       {r('sum(ones) over down / sum(ones) over ()', 8)} as tpr
from score_counts window down as (order by score desc)"""
S["ab_groups"] = f"""
select fast_n, slow_n, {r('fast_mean', 6)} as fast_mean, {r('slow_mean', 6)} as slow_mean,
       {r('fast_variance', 6)} as fast_variance, {r('slow_variance', 6)} as slow_variance,
       {r('difference', 6)} as difference from ab_moments"""
S["ab_welch"] = f"""
select {r('difference / sqrt(a + b)', 4)} as t_statistic,
       {r('(a + b) ** 2 / (a ** 2 / (fast_n - 1) + b ** 2 / (slow_n - 1))', 4)}
           as degrees_of_freedom from ab_tested"""
_EFFECT = """case when abs(d) >= 0.8 then 'Large' when abs(d) >= 0.5 then 'Medium'
       when abs(d) >= 0.2 then 'Small' else 'Negligible' end"""
S["ab_cohens_d"] = f"select {r('d', 5)} as cohens_d, {_EFFECT} as effect from ab_tested"


def _tail(start: str) -> str:
    """Area under the density of t from sinh(start) on, Simpson's rule in s with x = sinh(s)."""
    at = f"({start} + i * 0.01e0)"
    return f"""list_sum(list_transform(range(0, 4001), lambda i:
        case when i in (0, 4000) then 1e0 when i % 2 = 1 then 4e0 else 2e0 end
        * exp(-(dof + 1) / 2 * ln(1e0 + sinh({at}) ** 2 / dof)) * cosh({at})))"""


_TESTED = f"""
with tested as (
    select *, difference / sqrt(a + b) as t,
           (a + b) ** 2 / (a ** 2 / (fast_n - 1) + b ** 2 / (slow_n - 1)) as dof from ab_tested),
valued as (select *, {_tail('asinh(abs(t))')} / {_tail('0e0')} as p from tested)"""
S["ab_p_value"] = _TESTED + f"""
select {r('t', 4)} as t_statistic, {r('dof', 4)} as degrees_of_freedom, {r('p', 6)} as p_value
from valued"""
S["ab_conclusion"] = _TESTED + f"""
select fast_n, slow_n, {r('difference', 4)} as difference, {r('d', 4)} as cohens_d,
       {_EFFECT} as effect, p < 0.05 as significant, abs(d) >= 0.2 as worth_investing from valued"""

# ---- data quality

S["dq_not_null"] = """
select count(*) - count(order_id) as order_id,
       count(*) - count(customer_delivered_at) as customer_delivered_at,
       count(*) - count(total_payment_value) as total_payment_value,
       count(*) - count(review_score) as review_score from int_orders"""
S["dq_unique"] = """
select order_id, count(*) as n_rows from src_order_payments group by 1 having count(*) > 1"""
S["dq_composite_key"] = """
select order_id, payment_sequential, count(*) as n_rows from src_order_payments
group by all having count(*) > 1"""
S["dq_accepted_values"] = """
select count(*) filter (where order_status not in ('approved','canceled','created','delivered',
           'invoiced','processing','shipped','unavailable')) as unknown_status,
       count(*) filter (where order_status not in ('delivered','canceled')) as still_open
from stg_orders"""


def _report() -> str:
    keys = {
        "src_orders": ["order_id"], "src_customers": ["customer_id"],
        "src_products": ["product_id"], "src_sellers": ["seller_id"],
        "src_category_translation": ["product_category_name"], "stg_orders": ["order_id"],
        "stg_customers": ["customer_id"], "stg_order_items": ["order_item_sk"],
        "stg_order_payments": ["order_id"], "stg_products": ["product_id"],
        "stg_sellers": ["seller_id"], "int_orders": ["order_id"],
        "churn_features": ["customer_unique_id"], "int_customer_orders": ["customer_unique_id"],
        "dim_customers": ["customer_unique_id", "customer_sk"], "fct_orders": ["order_id"],
        "kpi_monthly": ["order_month"], "mart_churn": ["customer_unique_id"],
    }
    filled = {
        "src_orders": ["customer_id"], "src_customers": ["customer_unique_id"],
        "src_order_items": ["order_id", "order_item_id"],
        "src_order_reviews": ["review_id", "order_id"], "src_order_payments": ["order_id"],
        "src_geolocation": ["geolocation_zip_code_prefix"], "stg_orders": ["customer_id"],
        "stg_customers": ["customer_unique_id"], "stg_order_reviews": ["review_id", "order_id"],
        "churn_features": ["is_churned"], "mart_churn": ["churn_probability", "churn_risk_tier"],
    }
    allowed = {
        ("stg_orders", "order_status"): "'approved','canceled','created','delivered',"
        "'invoiced','processing','shipped','unavailable'",
        ("stg_order_reviews", "review_score"): "1, 2, 3, 4, 5",
        ("churn_features", "is_churned"): "0, 1",
        ("mart_churn", "churn_risk_tier"): "'critical','high','medium','low'",
    }
    parts = []
    for t, columns in keys.items():
        for c in columns:
            parts.append((t, c, "unique", f"""select count(*) from (select {c} from {t}
                where {c} is not null group by {c} having count(*) > 1)"""))
            parts.append((t, c, "not_null", f"select count(*) from {t} where {c} is null"))
    for t, columns in filled.items():
        parts += [(t, c, "not_null", f"select count(*) from {t} where {c} is null")
                  for c in columns]
    parts += [(t, c, "accepted_values", f"select count(*) from {t} where {c} not in ({v})")
              for (t, c), v in allowed.items()]
    rows = " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, '{test}' as test, ({q}) as failures"
        for t, c, test, q in parts
    )
    return f"select *, failures = 0 as passed from ({rows})"


S["dq_report"] = _report()

# ---- access log

S["audit_event"] = """
select timestamp, level, function, row_count, duration_ms, sql_preview, status, error, warning,
       '<redacted>' as email from audit_log"""
_SUMMARY = f"""
select count(*) as total_queries, {r(mean('duration_ms'), 1)} as avg_duration_ms,
       count(*) filter (where status = 'error') as errors,
       count(distinct session) as unique_sessions from audit_log"""
S["audit_summary"] = _SUMMARY
S["audit_summary_info"] = _SUMMARY + " where level = 'INFO'"
S["audit_calls_per_tool"] = "select function, count(*) as calls from audit_log group by 1"
S["audit_avg_duration"] = f"""
select function, {r(mean('duration_ms'), 4)} as avg_ms from audit_log group by 1"""
S["audit_rows_per_function"] = """
select function, cast(sum(row_count) as bigint) as rows_returned from audit_log group by 1"""
S["audit_history"] = """
select replace(substr(timestamp, 1, 19), 'T', ' ') as timestamp, function, row_count,
       duration_ms, status, session,
       '{"k":"' || k || '","email":"<redacted>","filter":"'
       || if(odd, 'x''; DROP TABLE t; --', 'plain') || '"}' as params from audit_log"""
_LOG = "select timestamp, level, session, function, row_count, status from audit_log where "
S["audit_window"] = _LOG + """
timestamp >= '2024-01-10T00:00:00' and timestamp <= '2024-01-12T23:59:59'"""
S["audit_bulk"] = _LOG + "row_count > 1000 and status <> 'error'"
S["audit_session"] = _LOG + "session = 's7'"
S["audit_errors"] = _LOG + "level = 'ERROR'"
S["audit_suspicious"] = _LOG + "odd"
S["audit_timeline"] = """
select timestamp, session, function, row_count, status from audit_log
where timestamp like '2024-01-05%'"""


def all_statements() -> dict[str, str]:
    return {name: compose(text) for name, text in S.items()}
