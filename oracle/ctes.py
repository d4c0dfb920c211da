"""Named building blocks of the check statements (DuckDB SQL).

A block may use the blocks above it; ``compose`` prepends those a statement needs.
"""

from __future__ import annotations

import re


def r(x: str, n: int) -> str:
    """Half-up rounding on decimal digits."""
    return f"cast(round(cast({x} as decimal(28,8)), {n}) as double)"


def total(x: str) -> str:
    return f"sum(cast({x} as decimal(28,8)))"


def mean(x: str) -> str:
    return f"(cast({total(x)} as double) / nullif(count({x}), 0))"


CTES: dict[str, str] = {}

CTES["src_orders"] = """
with numbered as (
    select o_orderkey k,
           o_orderdate + to_seconds(o_orderkey * 7919 % 86400) as bought,
           case when not (o_orderstatus = 'P' and o_orderkey % 4 = 0) then 'delivered'
                else ['canceled','shipped','created','approved','invoiced','processing',
                      'unavailable'][(o_orderkey % 7) + 1] end as st
    from orders)
select k as order_id, 'u' || lpad(cast(k as varchar), 10, '0') as customer_id,
       st as order_status, bought as order_purchase_timestamp,
       if(st = 'created', null, bought + to_minutes(k * 37 % 2880)) as order_approved_at,
       if(st in ('delivered','shipped'), bought + to_hours(12 + k * 13 % 96), null)
           as order_delivered_carrier_date,
       if(st = 'delivered' and k % 101 <> 0, bought + to_hours(30 + k * 7919 % 900), null)
           as order_delivered_customer_date,
       cast(cast(bought as date) as timestamp) + to_days(cast(10 + k * 31 % 25 as int))
           as order_estimated_delivery_date
from numbered"""

CTES["src_customers"] = """
select 'u' || lpad(cast(o_orderkey as varchar), 10, '0') as customer_id,
       md5(cast(o_custkey as varchar)) as customer_unique_id,
       cast(n_nationkey * 100 + o_orderkey % 7 as int) as customer_zip_code_prefix,
       format('city_{}_{}', n_nationkey, o_orderkey % 3) as customer_city,
       n_name as customer_state
from orders
join customer on c_custkey = o_custkey
join nation on n_nationkey = (c_nationkey + if(o_orderkey % 10 = 0, 1, 0)) % 25"""

CTES["src_order_items"] = """
select l_orderkey as order_id,
       ('0x' || substr(md5(concat_ws('|', l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'),
           l_linenumber)), 1, 15))::bigint as order_item_id,
       l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
       l_extendedprice as price, floor(l_extendedprice * 5) / 100.0e0 as freight_value
from lineitem"""

CTES["src_order_payments"] = """
select l_orderkey as order_id, l_linenumber as payment_sequential,
       case (l_orderkey + l_linenumber + l_partkey) % 9
            when 0 then 'voucher' when 1 then 'boleto' when 2 then 'boleto'
            when 3 then 'debit_card' when 8 then 'not_defined' else 'credit_card' end
           as payment_type,
       cast(1 + l_orderkey % 12 as int) as payment_installments,
       l_extendedprice + floor(l_extendedprice * 5) / 100.0e0 as payment_value
from lineitem"""

CTES["src_order_reviews"] = """
select format('r{}_{}', order_id, j) as review_id, order_id,
       cast(greatest(1, 5 - floor((30 + order_id * 7919 % 900) / 216.0e0)
            - (order_id + j) % 2) as int) as review_score,
       cast(null as varchar) as review_comment_title,
       case (order_id + j) % 4 when 0 then 'late parcel' when 1 then '' when 2 then 'ok' end
           as review_comment_message,
       order_delivered_customer_date + to_days(cast(1 + j as int)) as review_creation_date,
       order_delivered_customer_date + to_days(cast(3 + j as int)) as review_answer_timestamp
from src_orders, (values (0), (1)) copies(j)
where order_delivered_customer_date is not null and order_id % 13 <> 0
  and (j = 0 or order_id % 20 = 0)"""

CTES["src_products"] = """
select p_partkey as product_id, if(p_partkey % 50 = 0, null, p_type) as product_category_name,
       cast(length(p_name) as int) as product_name_lenght,
       cast(length(p_name) * 10 as int) as product_description_lenght,
       cast(p_size % 5 as int) as product_photos_qty,
       cast(p_size * 100 as double) as product_weight_g,
       cast(p_size as double) as product_length_cm,
       cast(p_size + 1 as double) as product_height_cm,
       cast(p_size + 2 as double) as product_width_cm
from part"""

CTES["src_category_translation"] = """
select p_type as product_category_name, lower(p_type) || '_en' as product_category_name_english
from part where p_type in ('ECONOMY','MEDIUM','PROMO','STANDARD') group by p_type"""

CTES["src_sellers"] = """
select s_suppkey as seller_id, cast(s_nationkey * 100 + s_suppkey % 7 as int)
           as seller_zip_code_prefix,
       format('city_{}_{}', s_nationkey, s_suppkey % 3) as seller_city, n_name as seller_state
from supplier join nation on n_nationkey = s_nationkey"""

CTES["src_geolocation"] = """
select cast(c_nationkey * 100 + c_custkey % 7 as int) as geolocation_zip_code_prefix,
       c_nationkey - 30.0e0 + (c_custkey % 100) / 1000.0e0 as geolocation_lat,
       c_nationkey - 60.0e0 - (c_custkey % 90) / 1000.0e0 as geolocation_lng,
       format('city_{}_{}', c_nationkey, c_custkey % 7 % 3) as geolocation_city,
       n_name as geolocation_state
from customer join nation on n_nationkey = c_nationkey"""

CTES["src_churn_predictions"] = """
select md5(cast(c_custkey as varchar)) as customer_unique_id,
       (c_custkey * 7919 % 1000) / 1000.0e0 as churn_probability,
       cast(c_custkey * 7919 % 1000 >= 500 as int) as predicted_label,
       'fixture' as model_name, '2018-10-17 00:00:00' as prediction_generated_at
from customer"""

CTES["audit_calls"] = """
select ts, 's' || (user_id % 20) as session, event_type as function,
       cast(json_extract_string(props, '$.k') as int) as k,
       'u' || user_id || '@mail.org' as email,
       cast(json_extract_string(props, '$.k') as int) % 25 = 0 as odd,
       value as duration, event_id,
       if(event_type = 'error', 'error', 'success') as status
from events"""

CTES["audit_log"] = f"""
select strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp,
       case when status = 'error' then 'ERROR' when k * 20 > 1000 then 'WARNING' else 'INFO' end
           as level,
       session, 'orderloom.audit' as logger, 'data_access' as event, function,
       cast(k * 20 as bigint) as row_count, {r('duration', 2)} as duration_ms,
       'SELECT k FROM ' || function || ' WHERE k = ' || k as sql_preview, status,
       if(status = 'error', 'failed ' || event_id, null) as error,
       if(status <> 'error' and k * 20 > 1000, 'large_result_set:' || (k * 20) || '_rows', null)
           as warning,
       k, odd
from audit_calls"""

CTES["contacts"] = """
select md5(cast(c_custkey as varchar)) as customer_unique_id, c_custkey as n,
       case c_custkey % 17 when 0 then 'no address' when 1 then '' else
           'user' || c_custkey || '@' || lower(c_mktsegment)
           || ['.co.uk', '.com', ''][c_custkey % 3 + 1] end as email,
       c_custkey % 19 = 0 as no_phone, c_nationkey + 1 as country, c_custkey % 900 + 100 as area,
       lpad(cast(c_custkey as varchar), 4, '0') as line,
       if(c_custkey % 23 = 0, '', lower(c_mktsegment) || ' da ' || replace(c_name, '#', ' '))
           as name,
       'city_' || c_nationkey as city, lower(c_mktsegment) as segment
from customer"""

CTES["stg_orders"] = """
select order_id, customer_id, order_status, order_purchase_timestamp as purchased_at,
       order_approved_at as approved_at, order_delivered_carrier_date as carrier_delivered_at,
       order_delivered_customer_date as customer_delivered_at,
       order_estimated_delivery_date as estimated_delivery_at
from src_orders"""

CTES["stg_customers"] = """
select customer_id, customer_unique_id, customer_zip_code_prefix as zip_code_prefix,
       customer_city as city, customer_state as state
from src_customers"""

CTES["stg_order_items"] = """
select md5(order_id || '-' || order_item_id) as order_item_sk, order_id, order_item_id,
       product_id, seller_id, shipping_limit_date as shipping_limit_at, price, freight_value
from src_order_items"""

CTES["stg_order_payments"] = f"""
with ordered as (
    select *, row_number() over (partition by order_id
              order by payment_value desc, payment_sequential desc, payment_type desc) as place
    from src_order_payments)
select order_id, count(*) as payment_installments_total,
       {r('sum(cast(payment_value as decimal(28,8)))', 2)} as total_payment_value,
       max(payment_type) filter (where place = 1) as primary_payment_type,
       max(payment_type = 'voucher') as used_voucher,
       max(payment_type = 'boleto') as used_boleto,
       max(payment_type = 'credit_card') as used_credit_card,
       max(payment_type = 'debit_card') as used_debit_card
from ordered group by order_id"""

CTES["stg_order_reviews"] = """
select review_id, order_id, review_score, review_comment_title as comment_title,
       review_comment_message as comment_message, review_creation_date as review_created_at,
       review_answer_timestamp as review_answered_at
from src_order_reviews"""

CTES["stg_products"] = """
select product_id, ifnull(product_category_name_english, p.product_category_name)
           as category_name_en,
       p.product_category_name as category_name_pt,
       product_name_lenght as product_name_length,
       product_description_lenght as product_description_length,
       product_photos_qty as photos_qty, product_weight_g as weight_g,
       product_length_cm as length_cm, product_height_cm as height_cm,
       product_width_cm as width_cm
from src_products p left join src_category_translation t
  on t.product_category_name = p.product_category_name"""

CTES["stg_sellers"] = """
select seller_id, seller_zip_code_prefix as zip_code_prefix, seller_city as city,
       seller_state as state
from src_sellers"""

CTES["stg_geolocation"] = f"""
select geolocation_zip_code_prefix as zip_code_prefix, {r(mean('geolocation_lat'), 4)} as lat,
       {r(mean('geolocation_lng'), 4)} as lng, min(geolocation_city) as city,
       min(geolocation_state) as state
from src_geolocation group by 1"""

CTES["latest_reviews"] = """
select * from stg_order_reviews
qualify row_number() over (partition by order_id
        order by review_created_at desc nulls last, review_id desc) = 1"""

CTES["int_orders"] = """
select o.*, date_diff('day', purchased_at, customer_delivered_at) as days_to_deliver,
       date_diff('day', estimated_delivery_at, customer_delivered_at) as delivery_delta_days,
       estimated_delivery_at >= customer_delivered_at as delivered_on_time,
       (epoch(approved_at) - epoch(purchased_at)) / 3600 as hours_to_approve,
       total_payment_value, primary_payment_type, used_voucher, used_credit_card,
       review_score, ifnull(length(comment_message) > 0, false) as has_review_comment,
       review_created_at
from stg_orders o
left join stg_order_payments p on p.order_id = o.order_id
left join latest_reviews v on v.order_id = o.order_id"""

CTES["dated_orders"] = """
select *, date_trunc('month', purchased_at) as order_month,
       cast(date_trunc('week', purchased_at) as timestamp) as order_week,
       cast(dayofweek(purchased_at) as bigint) as order_day_of_week
from int_orders"""


def _history(bought: str, accounts: str) -> str:
    return f"""
select customer_unique_id,
       first(state order by {bought} desc, customer_id desc)
           filter (where {bought} is not null) as state,
       first(city order by {bought} desc, customer_id desc)
           filter (where {bought} is not null) as city,
       count(order_id) as total_orders,
       count(*) filter (where order_status = 'delivered') as delivered_orders,
       count(*) filter (where order_status = 'canceled') as canceled_orders,
       min({bought}) as first_order_at, max({bought}) as last_order_at,
       date_diff('day', min({bought}), max({bought})) as customer_lifespan_days,
       {r(total('total_payment_value'), 2)} as total_spend_brl,
       {r(mean('total_payment_value'), 2)} as avg_order_value_brl,
       {r('avg(review_score)', 2)} as avg_review_score,
       count(review_score) as review_count,
       {r('avg(days_to_deliver)', 1)} as avg_days_to_deliver,
       count(*) filter (where delivered_on_time) as on_time_deliveries
from {accounts} group by customer_unique_id"""


CTES["int_customer_orders"] = _history(
    "purchased_at", "stg_customers left join int_orders using (customer_id)"
)

CTES["city_centroids"] = f"""
select city, state, {r(mean('lat'), 4)} as lat, {r(mean('lng'), 4)} as lng
from stg_geolocation group by city, state"""

CTES["city_centroids_raw"] = f"""
select geolocation_city as city, geolocation_state as state,
       {r(mean('geolocation_lat'), 4)} as lat, {r(mean('geolocation_lng'), 4)} as lng
from src_geolocation group by all"""

SEGMENTS = """
       case when total_orders = 1 then 'one_time' when total_orders in (2, 3, 4) then 'repeat'
            else 'loyal' end as order_frequency_segment,
       case when avg_review_score >= 4 then 'satisfied'
            when avg_review_score >= 3 then 'neutral' else 'dissatisfied' end
           as satisfaction_segment"""

CTES["dim_customers"] = f"""
select md5(customer_unique_id) as customer_sk, h.*, lat, lng, {SEGMENTS}
from int_customer_orders h left join city_centroids using (city, state)"""

CTES["item_rollup"] = f"""
select order_id, count(*) as item_count, count(distinct product_id) as distinct_products,
       count(distinct seller_id) as distinct_sellers,
       cast({total('price')} as double) as items_subtotal_brl,
       cast({total('freight_value')} as double) as freight_total_brl
from stg_order_items group by order_id"""

CTES["fct_orders"] = """
select order_id, customer_unique_id, customer_sk, order_status, purchased_at, approved_at,
       customer_delivered_at, estimated_delivery_at, item_count, distinct_products,
       distinct_sellers, items_subtotal_brl, freight_total_brl, total_payment_value,
       primary_payment_type, used_voucher, used_credit_card, days_to_deliver,
       delivery_delta_days, delivered_on_time, hours_to_approve, review_score,
       has_review_comment, review_created_at, order_month, order_week, order_day_of_week
from dated_orders
left join (select customer_id, customer_unique_id from stg_customers) using (customer_id)
left join (select customer_unique_id, customer_sk from dim_customers) using (customer_unique_id)
left join item_rollup using (order_id)"""


def _monthly(source: str, orders: str) -> str:
    return f"""
select order_month, {orders} as total_orders,
       {r('avg(review_score)', 3)} as avg_review_score,
       {r('avg(days_to_deliver)', 2)} as avg_days_to_deliver,
       {r("count(*) filter (where review_score > 3) / nullif(count(review_score), 0)", 4)}
           as csat_rate,
       {r("count(*) filter (where delivered_on_time) / count(order_id)", 4)} as on_time_rate,
       {r(mean('total_payment_value'), 2)} as avg_order_value_brl,
       {r(total('total_payment_value'), 2)} as total_gmv_brl,
       count(*) filter (where has_review_comment) as orders_with_comment,
       count(*) filter (where review_score = 1) as low_score_orders,
       count(*) filter (where used_voucher) as voucher_orders
from {source} where order_status = 'delivered' group by order_month"""


CTES["kpi_monthly"] = _monthly("fct_orders", "count(distinct order_id)")

CTES["order_signals"] = f"""
with dearest as (
    select customer_unique_id, primary_payment_type as habit from fct_orders
    where total_payment_value is not null
    qualify row_number() over (partition by customer_unique_id
            order by total_payment_value desc, order_id desc) = 1)
select customer_unique_id, avg(item_count) as avg_item_count,
       avg(distinct_products) as avg_distinct_products,
       avg(distinct_sellers) as avg_distinct_sellers,
       {mean('freight_total_brl')} as avg_freight_brl,
       max(used_voucher) as used_voucher_ever, max(used_credit_card) as used_credit_card_ever,
       any_value(habit) as primary_payment_type,
       ifnull(min(review_score), 5) as min_review_score,
       count(*) filter (where has_review_comment) / nullif(count(review_score), 0)
           as pct_reviews_with_comment
from fct_orders left join dearest using (customer_unique_id)
where customer_unique_id is not null group by customer_unique_id"""

CTES["newest_purchase"] = "select max(purchased_at) as reference_date from stg_orders"

CTES["churn_features"] = """
with aged as (
    select *, reference_date - interval 90 day as churn_cutoff_date,
           date_diff('day', last_order_at, reference_date) as since_last,
           date_diff('day', first_order_at, reference_date) as since_first
    from dim_customers cross join newest_purchase)
select d.customer_unique_id, customer_sk, state,
       since_last as days_since_last_order, since_first as days_since_first_order,
       customer_lifespan_days,
       ifnull(since_last / nullif(since_first, 0), 1.0e0) as recency_to_lifespan_ratio,
       total_orders, delivered_orders, canceled_orders,
       ifnull(canceled_orders / nullif(total_orders, 0), 0e0) as cancel_rate,
       order_frequency_segment, total_spend_brl, avg_order_value_brl,
       ifnull(avg_freight_brl, 0e0) as avg_freight_brl,
       ifnull(avg_freight_brl / nullif(avg_order_value_brl, 0), 0e0) as freight_to_value_ratio,
       ifnull(avg_review_score, 3e0) as avg_review_score, review_count,
       if(ifnull(min_review_score, 5) < 3, 1, 0) as has_low_review,
       ifnull(pct_reviews_with_comment, 0e0) as pct_reviews_with_comment, satisfaction_segment,
       ifnull(avg_days_to_deliver, 15e0) as avg_days_to_deliver,
       ifnull(on_time_deliveries / nullif(delivered_orders, 0), 0e0) as on_time_delivery_rate,
       if(ifnull(delivered_orders, 1) > ifnull(on_time_deliveries, 0), 1, 0)
           as had_late_delivery,
       if(used_voucher_ever, 1, 0) as used_voucher_ever,
       if(used_credit_card_ever, 1, 0) as used_credit_card_ever,
       ifnull(primary_payment_type, 'unknown') as primary_payment_type,
       ifnull(avg_item_count, 1e0) as avg_item_count,
       ifnull(avg_distinct_products, 1e0) as avg_distinct_products,
       ifnull(avg_distinct_sellers, 1e0) as avg_distinct_sellers,
       reference_date, churn_cutoff_date,
       if(last_order_at > churn_cutoff_date, 0, 1) as is_churned
from aged d left join order_signals s on s.customer_unique_id = d.customer_unique_id
where first_order_at <= churn_cutoff_date"""

CTES["scores"] = """
select customer_unique_id, churn_probability, predicted_label, model_name,
       cast(prediction_generated_at as timestamp) as prediction_generated_at,
       case when churn_probability < 0.40 then 'low' when churn_probability < 0.65 then 'medium'
            when churn_probability < 0.85 then 'high' else 'critical' end as churn_risk_tier
from src_churn_predictions"""

CTES["mart_churn"] = """
select s.*, state, order_frequency_segment, satisfaction_segment, total_orders,
       total_spend_brl, avg_order_value_brl, avg_review_score, avg_days_to_deliver,
       first_order_at, last_order_at, customer_lifespan_days
from scores s left join dim_customers d on d.customer_unique_id = s.customer_unique_id"""

CTES["score_listing"] = f"""
select customer_unique_id, {r('churn_probability', 3)} as churn_prob, churn_risk_tier, state,
       order_frequency_segment as freq_segment, satisfaction_segment as sat_segment,
       total_orders, {r('total_spend_brl', 2)} as spend_brl,
       {r('avg_review_score', 2)} as avg_review, cast(last_order_at as date) as last_order
from mart_churn"""

CTES["silver_payments"] = f"""
with chosen as (
    select order_id, payment_type as kind from src_order_payments
    where payment_type <> 'not_defined'
    qualify row_number() over (partition by order_id
            order by payment_sequential, payment_value, payment_type) = 1)
select order_id, {r(total('payment_value'), 2)} as total_payment_value,
       any_value(kind) as primary_payment_type,
       max(payment_type = 'voucher') as used_voucher,
       max(payment_type = 'credit_card') as used_credit_card
from src_order_payments left join chosen using (order_id) group by order_id"""

CTES["silver_orders"] = """
select o.*, date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date)
           as days_to_deliver,
       date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date)
           as delivery_delta_days,
       o.order_estimated_delivery_date >= o.order_delivered_customer_date as delivered_on_time,
       (epoch(o.order_approved_at) - epoch(o.order_purchase_timestamp)) / 3600
           as hours_to_approve,
       total_payment_value, primary_payment_type, used_voucher, used_credit_card, review_score,
       ifnull(length(comment_message) > 0, false) as has_review_comment, review_created_at,
       date_trunc('month', o.order_purchase_timestamp) as order_month,
       cast(date_trunc('week', o.order_purchase_timestamp) as timestamp) as order_week,
       cast(dayofweek(o.order_purchase_timestamp) as bigint) as order_day_of_week
from src_orders o left join silver_payments using (order_id)
left join latest_reviews using (order_id)"""

CTES["silver_customers"] = f"""
with history as ({_history(
    "order_purchase_timestamp",
    "silver_orders left join stg_customers using (customer_id)")})
select *, {SEGMENTS} from history"""

CTES["silver_churn_features"] = """
with newest as (select max(order_purchase_timestamp) as last_day from src_orders),
aged as (
    select c.*, date_diff('day', last_order_at, last_day) as since_last,
           date_diff('day', first_order_at, last_day) as since_first
    from silver_customers c, newest)
select customer_unique_id, since_last as days_since_last_order,
       since_first as days_since_first_order, customer_lifespan_days, total_orders,
       total_spend_brl, avg_order_value_brl, avg_review_score, avg_days_to_deliver,
       on_time_deliveries, review_count,
       cast(order_frequency_segment = 'one_time' as int) as is_one_time,
       cast(order_frequency_segment = 'repeat' as int) as is_repeat,
       cast(order_frequency_segment = 'loyal' as int) as is_loyal,
       cast(satisfaction_segment = 'dissatisfied' as int) as is_dissatisfied,
       cast(satisfaction_segment = 'satisfied' as int) as is_satisfied,
       cast(since_last > 180 as int) as churned
from aged"""

CTES["gold_monthly"] = _monthly("silver_orders", "count(order_id)")

CTES["gold_customer_segments"] = """
select c.*, lat, lng from silver_customers c left join city_centroids_raw using (city, state)"""


def performance(by: str, digits: tuple[int, int, int], names: tuple[str, ...]) -> str:
    """Select list of a delivery performance table."""
    days, delta, score = digits
    rows = (
        "count(*)", r("avg(days_to_deliver)", days), r("avg(delivery_delta_days)", delta),
        r("count(*) filter (where delivered_on_time) / count(*) * 100.0e0", 1),
        r("avg(review_score)", score),
        r("count(*) filter (where review_score > 3) / nullif(count(review_score), 0) * 100.0e0",
          1),
    )
    return ", ".join([by, *[f"{x} as {n}" for x, n in zip(rows, names)]])


LONG_NAMES = ("total_orders", "avg_days_to_deliver", "avg_delta_vs_estimate", "on_time_pct",
              "avg_review_score", "csat_pct")
SHORT_NAMES = ("orders", "avg_days", "avg_delta", "on_time_pct", "avg_review", "csat_pct")

CTES["delivered_with_state"] = """
select f.*, d.state from fct_orders f join dim_customers d on d.customer_sk = f.customer_sk
where f.order_status = 'delivered' and d.state is not null"""

CTES["state_performance"] = f"""
select {performance('state', (2, 2, 3), LONG_NAMES)} from delivered_with_state group by state"""

CTES["state_dashboard"] = f"""
select {performance('state', (1, 1, 2), SHORT_NAMES)} from delivered_with_state
group by state having count(*) >= 100"""

CTES["gold_by_state"] = f"""
select {performance('p.state', (1, 1, 2), LONG_NAMES)}
from silver_orders o
left join stg_customers a on a.customer_id = o.customer_id
left join silver_customers p on p.customer_unique_id = a.customer_unique_id
where order_status = 'delivered' and p.state is not null group by p.state"""

CTES["cohorts"] = """
with placed as (
    select customer_unique_id, purchased_at, row_number() over (
           partition by customer_unique_id order by purchased_at, order_id) as nth
    from fct_orders where order_status in ('delivered','shipped','processing','approved'))
select cast(date_trunc('month', one.purchased_at) as date) as cohort_month,
       count(*) as cohort_size, count(two.nth) as returned_customers
from placed one left join placed two
  on two.customer_unique_id = one.customer_unique_id and two.nth = 2
where one.nth = 1 group by 1"""

CTES["seller_lines"] = """
select i.seller_id, ifnull(category_name_en, 'unknown') as category_en, f.order_id,
       days_to_deliver, review_score, delivered_on_time
from fct_orders f join stg_order_items i on i.order_id = f.order_id
join stg_products p on p.product_id = i.product_id
where f.order_status = 'delivered' and days_to_deliver is not null"""

CTES["seller_performance"] = f"""
select seller_id, category_en, count(distinct order_id) as orders,
       {r('avg(days_to_deliver)', 1)} as avg_delivery_days,
       {r('avg(review_score)', 2)} as avg_review,
       {r('count(*) filter (where delivered_on_time) / count(*) * 100.0e0', 1)} as on_time_pct
from seller_lines group by seller_id, category_en"""

CTES["seller_ranked"] = f"""
select *, rank() over (partition by category_en order by avg_delivery_days desc)
           as delivery_rank_in_category,
       {r('avg_delivery_days - median(avg_delivery_days) over (partition by category_en)', 1)}
           as days_above_category_median,
       count(*) over (partition by category_en) as sellers_in_category
from seller_performance where orders >= 20"""

CTES["seller_flagged"] = """
select *, case when days_above_category_median >= 3 and delivery_rank_in_category = 1
                    then 'Underperformer: action needed'
               when days_above_category_median >= 1.5 then 'Watch: above category average'
               else 'On track' end as performance_flag
from seller_ranked"""

CTES["retention_targets"] = f"""
with listed as (
    select customer_unique_id, {r('churn_probability', 3)} as churn_prob, churn_risk_tier,
           d.* exclude (customer_unique_id)
    from scores join dim_customers d using (customer_unique_id) where total_spend_brl >= 100)
select *, {r('''churn_prob * 0.5e0
        + total_spend_brl / nullif((select max(total_spend_brl) from listed), 0) * 0.35e0
        + case order_frequency_segment when 'loyal' then 0.15e0 when 'repeat' then 0.10e0
               else 0e0 end''', 4)} as priority
from listed"""

CTES["spenders"] = """
select customer_unique_id, state, total_spend_brl from dim_customers where total_spend_brl > 0"""

CTES["rated"] = """
select order_id, review_score, if(days_to_deliver > 7, 'slow', 'fast') as speed
from int_orders
where order_status = 'delivered' and review_score is not null and days_to_deliver >= 0"""

CTES["ab_moments"] = """
with sums as (
    select speed, count(*) as n, sum(cast(review_score as bigint)) as s,
           sum(cast(review_score * review_score as bigint)) as q
    from rated group by speed),
wide as (
    select max(n) filter (where speed = 'fast') as fast_n,
           max(n) filter (where speed = 'slow') as slow_n,
           cast(max(s) filter (where speed = 'fast') as double) as fs,
           cast(max(s) filter (where speed = 'slow') as double) as ss,
           cast(max(q) filter (where speed = 'fast') as double) as fq,
           cast(max(q) filter (where speed = 'slow') as double) as sq
    from sums)
select fast_n, slow_n, fs / fast_n as fast_mean, ss / slow_n as slow_mean,
       (fq - fs * fs / fast_n) / (fast_n - 1) as fast_variance,
       (sq - ss * ss / slow_n) / (slow_n - 1) as slow_variance,
       fs / fast_n - ss / slow_n as difference
from wide"""

CTES["ab_tested"] = """
select *, fast_variance / fast_n as a, slow_variance / slow_n as b,
       difference / sqrt(((fast_n - 1) * fast_variance + (slow_n - 1) * slow_variance)
                         / (fast_n + slow_n - 2)) as d
from ab_moments"""

CTES["given_scores"] = """
select customer_unique_id, is_churned as label, churn_probability as score
from churn_features join src_churn_predictions using (customer_unique_id)"""

CTES["score_counts"] = """
select score, count(*) filter (where label = 1) as ones,
       count(*) filter (where label = 0) as zeros
from given_scores group by score"""

CTES["f1_curve"] = """
select score, 2 * tp / (tp + fp + all_zeros) as f1 from (
    select score, sum(zeros) over upto as tp, sum(ones) over upto as fp,
           sum(zeros) over () as all_zeros
    from score_counts window upto as (order by score))"""

CTES["best"] = """
select score as threshold, f1 from f1_curve order by f1 desc, score desc limit 1"""

CTES["medians"] = """
select column_name, cast(median(value) as double) as median from (
    unpivot (select cast(columns(* exclude (customer_unique_id, customer_sk, state,
        order_frequency_segment, satisfaction_segment, primary_payment_type, reference_date,
        churn_cutoff_date, is_churned)) as double) from churn_features)
    on columns(*) into name column_name value value)
group by column_name"""


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def compose(statement: str) -> str:
    """The statement preceded by the blocks it needs, directly or through others."""
    needed: set[str] = set()
    queue = [statement]
    while queue:
        text = queue.pop()
        for name, body in CTES.items():
            if name not in needed and _uses(text, name) and text is not body:
                needed.add(name)
                queue.append(body)
    blocks = ", ".join(f"{name} as ({CTES[name]})" for name in CTES if name in needed)
    if not blocks:
        return statement
    own = re.match(r"\s*with\b", statement)
    return f"with {blocks}, {statement[own.end():]}" if own else f"with {blocks} {statement}"
