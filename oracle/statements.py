"""One SQL statement per registered query that SQL can express."""

from __future__ import annotations

from oracle.models import CTES
from oracle.quality import summary_sql
from oracle.sqltext import assemble, average, pct, ratio
from tradewind.tables import SOURCE_TABLES

STATEMENTS: dict[str, str] = {}

# Cell texts that a CSV load reads as missing.
_MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
            "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_MISSING_LIST = ", ".join(f"'{token}'" for token in _MISSING)


def _cell(column: str) -> str:
    return f"nullif(trim(case when {column} in ({_MISSING_LIST}) then null else {column} end), '') as {column}"


def _best(columns: str, relation: str, order: str) -> str:
    return f"(select {columns} from {relation} order by {order} limit 1)"


_CLEAN = (
    "trim(regexp_replace(regexp_replace(lower(strip_accents(text)), 'http\\S+|www\\.\\S+', ' ', 'g'),"
    " '[^a-z]+', ' ', 'g'))"
)

EXTRA = {
    "sql_daily": """
        select order_purchase_date as ds, sum(order_total)::double as y, count(*) as order_count
        from fact_orders where order_status not in ('canceled', 'unavailable') group by 1""",
    "sql_aged": "select *, row_number() over (order by ds desc) as age, count(*) over () as days from sql_daily",
    "sql_trimmed": """
        select ds, y, order_count from sql_aged
        where days < 60 or age >= coalesce((select min(age) from sql_aged where age <= 45 and order_count >=
            0.25 * (select median(order_count) from sql_aged where age <= 90)), 46)""",
    "sql_series": """
        select d as ds, coalesce(y, 0) as y, coalesce(order_count, 0) as order_count
        from (select unnest(generate_series(min(ds)::timestamp, max(ds)::timestamp, interval 1 day))::date as d
              from sql_trimmed) left join sql_trimmed on ds = d""",
    "sql_naive": """
        select t.ds, t.y, t.order_count,
               coalesce(p.y, (select avg(y) from (select y from sql_series where ds <= (select max(ds) - 90 from sql_series)
                                                  order by ds desc limit 28))) as predicted
        from sql_series t
        left join sql_series p on p.ds = t.ds - 364 and p.ds <= (select max(ds) - 90 from sql_series)
        where t.ds > (select max(ds) - 90 from sql_series)""",
    "sql_clean": f"select doc_id, {_CLEAN} as clean_text from documents",
    "sql_tokens": "select doc_id, list_filter(string_split(clean_text, ' '), lambda w: length(w) >= 2) as ws from sql_clean",
    "sql_review_text": f"""
        select * from (select *, {_CLEAN.replace("(text)", "(review_comment_message)")} as clean_text from stg_order_reviews
                       where review_comment_message is not null)
        join (select order_id, customer_state, is_late_delivery, delivery_days, order_total from fact_orders) using (order_id)
        where length(clean_text) >= 3""",
    "sql_split": """
        select order_id, label, row_number() over (partition by label order by md5(order_id || ':42'), order_id)
               <= floor(0.2 * count(*) over (partition by label) + 0.5) as held_out
        from (select order_id, (review_score >= 4)::int::double as label from sql_review_text where review_score <> 3)""",
    "sql_review_tokens": """
        select order_id, string_split(clean_text, ' ') as every,
               list_filter(string_split(clean_text, ' '), lambda w: length(w) >= 2) as ws from sql_review_text""",
    "sql_review_words": """
        select order_id, 'words' as block, term, count(*) as n
        from (select order_id, unnest(ws) as term from sql_review_tokens union all
              select order_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from sql_review_tokens)
        group by all""",
    "sql_review_chars": """
        select order_id, 'chars' as block, substring(w, i::int, n) as term, count(*) as n
        from (select order_id, ' ' || w || ' ' as w from (select order_id, unnest(every) as w from sql_review_tokens) where w <> '')
        cross join (values (3), (4), (5)) as t(n)
        cross join lateral (select unnest(range(1, length(w) - n + 2)) as i)
        group by order_id, term""",
    "sql_training": "select order_id, label from sql_split where not held_out",
    "sql_sizes": "select count(*) as all_rows, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from sql_training",
    "sql_log_odds": """
        select block, term, documents, positive,
               round(ln((positive + 1) / (p + 2)) - ln((documents - positive + 1) / (n + 2)), 6)::decimal(12,6) as weight
        from (select *, row_number() over (partition by block order by occurrences desc, term) as place
              from (select block, term, sum(w.n) as occurrences, count(*) as documents, count(*) filter (label = 1) as positive
                    from sql_review_words w join sql_training using (order_id) group by block, term having count(*) >= 3)), sql_sizes
        where place <= 40000""",
    "sql_baseline": """
        select order_id, review_score, review_creation_date, customer_state, is_late_delivery, delivery_days, order_total, sentiment_probability,
               predicted_sentiment, rating_sentiment, predicted_sentiment = rating_sentiment as agrees_with_rating
        from (select *, case when sentiment_probability >= 0.6 then 'positive' when sentiment_probability <= 0.4 then 'negative' else 'neutral' end as predicted_sentiment,
                     case when review_score >= 4 then 'positive' when review_score <= 2 then 'negative' else 'neutral' end as rating_sentiment
              from (select r.*, round(1 / (1 + exp(-greatest(-30, least(30, (coalesce(s, 0) + (select round(ln((p + 1) / (n + 1)), 6)::decimal(12,6) from sql_sizes))::double)))), 4) as sentiment_probability
                    from sql_review_text r left join (select order_id, sum(weight) as s from sql_review_words join sql_log_odds using (block, term) group by 1) using (order_id)))""",
    "sql_baseline_summary": f"""
        select predicted_sentiment, rating_sentiment, is_late_delivery, count(*) as review_count,
               round(avg(sentiment_probability), 4)::decimal(20,4) as avg_probability,
               {average("review_score", 2, 0)} as avg_review_score
        from sql_baseline group by 1, 2, 3""",
}
_ALL = {**CTES, **EXTRA}


def _add(name: str, body: str) -> None:
    STATEMENTS[name] = assemble(_ALL, body)


for _name in CTES:
    if _name != "src_timeline":
        _add(_name, f"SELECT * FROM {_name}")

# loading
_add("load_csv_orders", "select * from src_orders")
_add("load_csv_order_items", "select * from src_order_items")
_add("load_csv_geolocation", f"""
    select geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, {_cell("geolocation_city")},
           {_cell("geolocation_state")} from src_geolocation""")
_add("load_csv_order_reviews", f"""
    select {_cell("review_id")}, {_cell("order_id")}, review_score, {_cell("review_comment_title")},
           {_cell("review_comment_message")}, review_creation_date, review_answer_timestamp from src_order_reviews""")
_add("load_merge_products", """
    select i.* from (select 'p' || l_partkey as product_id, 'flag_' || l_returnflag as product_category_name,
               l_linenumber as product_name_lenght, null::int as product_description_lenght,
               null::int as product_photos_qty, (l_quantity * 10)::int as product_weight_g,
               null::int as product_length_cm, null::int as product_height_cm, null::int as product_width_cm
        from lineitem
        qualify row_number() over (partition by l_partkey order by l_returnflag, l_linenumber, l_quantity) = 1) i
    union all
    select * from src_products where product_id not in (select 'p' || l_partkey from lineitem)""")
_STRATEGY = {"geolocation": "full_refresh", "order_reviews": "full_refresh"}
_SOURCE_NAMES = [n.removeprefix("src_") for n in CTES if n.startswith("src_") and n != "src_timeline"]
_add("load_status", " union all ".join(
    f"select '{n}' as table_name, '{_STRATEGY.get(n, 'merge')}' as load_strategy, "
    f"(select count(*) from src_{n}) as rows_in_table, 2::bigint as loads" for n in _SOURCE_NAMES))
_add("load_bucket_merge", """
    select 1 as step, count(*) as rows_in_source, count(distinct customer_id) as rows_loaded, 64::int as buckets_written, 1::bigint as moved from src_customers
    union all
    select 2, (select count(*) from src_customers where customer_id = (select min(customer_id) from src_customers)), count(distinct customer_id), 1::int, 1::bigint
    from src_customers""")
_KEYS = {
    "customers": "customer_id", "order_items": "order_id, order_item_id", "orders": "order_id",
    "order_payments": "order_id, payment_sequential", "products": "product_id", "sellers": "seller_id",
    "product_category_translation": "product_category_name",
}
_add("raw_key_duplicates", " union all ".join(
    f"select '{n}' as table_name, count(*) as rows, count(*) - count(distinct ({k})) as duplicate_rows from src_{n}"
    for n, k in _KEYS.items()))

# Published sizes of the tables.
_PUBLISHED = {t.name: t.expected_rows for t in SOURCE_TABLES if t.expected_rows}


def _rules(n: str) -> str:
    """Existence, size, repeated keys and the distance from the published size of one loaded table."""
    rows = f"(select count(*)::double from src_{n})"
    rules = [("loaded", "1::double", "true"), ("filled", rows, f"{rows} > 0")]
    if n in _KEYS:
        repeats = f"(select (count(*) - count(distinct ({_KEYS[n]})))::double from src_{n})"
        rules.append(("distinct_keys", repeats, f"{repeats} = 0"))
    if n in _PUBLISHED:
        share = f"abs({rows} / {_PUBLISHED[n]}::double - 1)"
        rules.append(("as_published", share, f"{share} <= 0.02"))
    return " union all ".join(f"select '{n}' as table_name, '{r}' as rule, round({m}, 6) as measured, {p} as passed" for r, m, p in rules)


_add("validate_raw", " union all ".join(map(_rules, _SOURCE_NAMES)))

# data quality
for _layer in ("sources", "staging", "marts", "analytics"):
    _add(f"quality_{_layer}", summary_sql(_layer))

# serving
_GROUPS = f"""
    select rfm_segment, lifecycle_stage, count(*) as customer_count,
           {average("recency_days", 0, 0)} as avg_recency_days, {average("frequency", 2, 0)} as avg_frequency,
           {average("monetary", 2)} as avg_monetary, sum(monetary)::decimal(20,2) as total_monetary"""
_add("serve_kpis", "select * from agg_kpi_summary")
_add("serve_customer_segment", """
    select customer_key, customer_state, recency_days, frequency, monetary, rfm_segment, lifecycle_stage,
           null::varchar as cluster_label from agg_customer_rfm where customer_key = 'u7'""")
_add("serve_segments", _GROUPS + " from agg_customer_rfm group by all")
_add("serve_rfm_segments", _GROUPS + f", {average('avg_review_score', 2)} as avg_review_score from agg_customer_rfm group by all")
_add("serve_categories", """
    select product_category, revenue, order_count, revenue_share_pct, avg_review_score
    from agg_category_performance order by revenue desc, product_category limit 25""")
_SHOP = """select seller_id, seller_state, revenue, order_count, avg_review_score, late_delivery_pct, is_at_risk_seller
    from agg_seller_performance"""
_add("serve_sellers", _SHOP + " order by revenue desc, seller_id limit 50")
_add("serve_sellers_at_risk", _SHOP + " where is_at_risk_seller order by revenue desc, seller_id limit 50")
_add("serve_delivery_impact", "select * from agg_delivery_review_correlation")
_PUBLISHED = {
    "kpi_summary": "agg_kpi_summary", "revenue_monthly": "agg_revenue_monthly",
    "category_performance": "agg_category_performance", "delivery_performance": "agg_delivery_performance",
    "delivery_review": "agg_delivery_review_correlation", "cohort_retention": "agg_cohort_retention",
    "geographic_revenue": "agg_geographic_revenue",
}
_add("snapshot_export", " union all ".join(
    [f"select '{d}' as dataset, (select count(*) from {t}) as rows" for d, t in _PUBLISHED.items()]
    + ["select 'seller_performance', least(500, (select count(*) from agg_seller_performance))",
       "select 'rfm_segments', (select count(distinct (rfm_segment, lifecycle_stage)) from agg_customer_rfm)"]))

# insights
_add("insight_peak_month", f"""
    select {_best("year_month", "agg_revenue_monthly", "revenue desc, month_start_date")} as peak_month,
           (select max(revenue) from agg_revenue_monthly) as peak_revenue,
           {average("mom_growth_pct", 2)} as recent_mom_growth_pct
    from (select * from agg_revenue_monthly order by month_start_date desc limit 6)""")
_GAP = """from agg_delivery_review_correlation where lateness_bucket <> 'ALL DELIVERED' and regexp_matches(lateness_bucket, '{}')"""
_add("insight_review_gap", f"""
    select a as punctual_review_score, b as late_review_score, a1 as punctual_one_star_pct, b1 as late_one_star_pct,
           (select max(correlation_coefficient) from agg_delivery_review_correlation
            where lateness_bucket = 'ALL DELIVERED') as correlation_coefficient,
           (a - b)::decimal(20,6) as review_gap
    from (select {average("avg_review_score", 6, 3)} as a, {average("one_star_pct", 6)} as a1 {_GAP.format("early|promise")})
    cross join (select {average("avg_review_score", 6, 3)} as b, {average("one_star_pct", 6)} as b1 {_GAP.format("late")})""")
_add("insight_years_in_view", f"""
    select sum(revenue)::decimal(20,2) as revenue, sum(order_count)::bigint as orders,
           {ratio("sum(revenue)", "greatest(sum(order_count), 1)", 2)} as avg_order_value,
           first(year_month order by revenue desc, month_start_date) as best_month
    from agg_revenue_monthly where year_number in (1996, 1998)""")
_add("insight_quarterly_rollup", f"""
    select *, {pct("revenue - lag(revenue) over (order by year_quarter)", "lag(revenue) over (order by year_quarter)", 1, 2, 2)} as qoq_growth_pct
    from (select year_quarter, sum(revenue)::decimal(20,2) as revenue, sum(order_count)::bigint as orders,
                 sum(active_customers)::bigint as customers, {average("avg_order_value", 6)} as avg_order_value,
                 {average("avg_review_score", 6, 3)} as avg_review from agg_revenue_monthly group by 1)""")
_add("insight_category_concentration", """
    select sum(revenue_share_pct) filter (place <= 10)::decimal(20,2) as top_share_pct, count(*) as categories,
           max(revenue_share_pct) as largest_share_pct
    from (select *, row_number() over (order by revenue desc, product_category) as place from agg_category_performance)""")
_add("insight_leading_categories", """
    select product_category, revenue, revenue_share_pct, avg_review_score from agg_category_performance
    order by revenue desc, product_category limit 12""")
_add("insight_leading_sellers", """
    select seller_id[1:10] || '…' as seller, seller_state, revenue, order_count, avg_review_score, late_delivery_pct,
           is_at_risk_seller from agg_seller_performance order by revenue desc, seller_id limit 20""")
_add("insight_at_risk_sellers", "select count(*) filter (is_at_risk_seller) as at_risk_sellers from agg_seller_performance")
_add("insight_customer_totals", f"""
    select count(*) as customers, sum(monetary)::decimal(20,2) as lifetime_value,
           {pct("sum((lifecycle_stage = 'Active')::int)", "count(*)")} as active_pct,
           {_best("rfm_segment", "agg_customer_rfm group by rfm_segment, lifecycle_stage", "sum(monetary) desc, rfm_segment, lifecycle_stage")} as most_valuable_segment
    from agg_customer_rfm""")
_add("insight_retention_triangle", "select cohort_label, " + ", ".join(
    f"max(retention_pct) filter (months_since_acquisition = {m}) as month_{m}" for m in range(13))
    + " from agg_cohort_retention where months_since_acquisition <= 12 group by 1")
_add("insight_first_month_retention", f"""
    select {average("retention_pct", 2)} as month_one_retention_pct from agg_cohort_retention
    where months_since_acquisition = 1""")
_add("insight_monthly_late_rate", f"""
    select year_month, all_orders, late_orders, {pct("late_orders", "all_orders")} as late_pct
    from (select year_month, sum(order_count)::bigint as all_orders,
                 coalesce(sum(order_count) filter (is_late_delivery), 0)::bigint as late_orders
          from agg_delivery_performance group by 1)""")
_REGION_MEANS = f"""{average("avg_delivery_days", 6)} as avg_delivery_days,
    {average("avg_review_score", 6, 3)} as avg_review_score, {average("freight_to_gmv_pct", 6)} as freight_to_gmv_pct"""
_add("insight_region_rollup", f"""
    select region, sum(revenue)::decimal(20,2) as revenue, sum(order_count)::bigint as orders,
           sum(customer_count)::bigint as customers, {_REGION_MEANS} from agg_geographic_revenue group by 1""")
_add("insight_state_spread", """
    select count(*) as states, first(state order by revenue desc, state) as largest_state,
           first(revenue_share_pct order by revenue desc, state) as largest_share_pct,
           median(freight_to_gmv_pct)::decimal(20,4) as median_freight_pct,
           min(avg_delivery_days) as fastest_days, max(avg_delivery_days) as slowest_days from agg_geographic_revenue""")
_add("insight_north_against_southeast", f"""
    select case region when 'Southeast' then 'southeast' else 'north' end as side, {_REGION_MEANS}
    from agg_geographic_revenue where region in ('North', 'Northeast', 'Southeast') group by 1""")

# forecasting and features
_add("forecast_daily_revenue", "select * from sql_daily")
_add("forecast_prepared_series", "select * from sql_series")
_add("forecast_seasonal_naive", "select * from sql_naive")
_add("forecast_naive_accuracy", """
    select round(avg(abs(predicted - y)), 4) as mae, round(sqrt(avg((predicted - y) ^ 2)), 4) as rmse,
           round(avg(abs((predicted - y) / y)) filter (y <> 0) * 100, 4) as mape, round(avg(predicted - y), 4) as bias
    from sql_naive""")
_LOGS = {n: f"ln(1 + greatest({n}, 0)::double)" for n in ("recency_days", "frequency", "monetary", "avg_order_value")}
_add("segment_features", "select customer_key, " + ", ".join(
    f"round(({e} - avg({e}) over ()) / stddev_samp({e}) over (), 5) as z_{n}" for n, e in _LOGS.items())
    + " from agg_customer_rfm")

# text
_add("text_normalise", "select doc_id, length(clean_text)::int as length, md5(clean_text) as digest from sql_clean")
_add("text_word_ngrams", """
    select term, count(*) as occurrences, count(distinct doc_id) as documents
    from (select doc_id, unnest(ws) as term from sql_tokens union all
          select doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from sql_tokens)
    group by term""")
_add("text_char_ngrams", """
    select substring(w, i::int, n) as term, sum(k)::bigint as occurrences, count(distinct doc_id) as documents
    from (select doc_id, ' ' || w || ' ' as w, count(*) as k
          from (select doc_id, unnest(string_split(clean_text, ' ')) as w from sql_clean) where w <> '' group by all)
    cross join (values (3), (4), (5)) as t(n)
    cross join lateral (select unnest(range(1, length(w) - n + 2)) as i)
    group by term""")
_add("sentiment_corpus", f"""
    select order_id, review_score, review_creation_date, customer_state, is_late_delivery, delivery_days, order_total,
           (review_score >= 4)::int::double as label, md5(clean_text) as digest
    from (select *, {_CLEAN.replace("(text)", "(review_comment_message)")} as clean_text from stg_order_reviews
          where review_comment_message is not null)
    join (select order_id, customer_state, is_late_delivery, delivery_days, order_total from fact_orders) using (order_id)
    where length(clean_text) >= 3 and review_score <> 3""")
_add("sentiment_split", "select * from sql_split")
_add("sentiment_vocabulary", """
    select block, term, occurrences::bigint as occurrences, documents, round(ln((1.0 + all_rows) / (1.0 + documents)) + 1, 6) as idf,
           (case block when 'words' then 0 else 40000 end + place - 1)::int as index
    from (select *, row_number() over (partition by block order by occurrences desc, term) as place
          from (select block, term, sum(g.n) as occurrences, count(*) as documents
                from (select * from sql_review_words union all select * from sql_review_chars) g join sql_training using (order_id)
                group by block, term having count(*) >= 3)), sql_sizes
    where place <= 40000""")
_add("sentiment_log_odds", """
    select *, 'catalog' as run_id from sql_log_odds union all
    select 'intercept', '', all_rows, p, round(ln((p + 1) / (n + 1)), 6)::decimal(12,6), 'catalog' from sql_sizes""")
_add("sentiment_baseline", "select *, 'catalog' as run_id from sql_baseline")
_add("serve_sentiment_baseline", "select * from sql_baseline_summary")
_add("insight_late_reviews_baseline", f"""
    select late::bigint as late_reviews, negative::bigint as late_negative_reviews, {pct("negative", "late")} as late_negative_pct
    from (select sum(review_count) filter (is_late_delivery) as late,
                 coalesce(sum(review_count) filter (is_late_delivery and predicted_sentiment = 'negative'), 0) as negative from sql_baseline_summary)""")

# facts by date
_add("dated_orders", """
    select order_status, count(*) as orders, sum(order_total)::decimal(20,2) as revenue from fact_orders
    where order_purchase_date between date '1996-11-20' and date '1997-02-10' group by 1""")
_add("dated_items", """
    select seller_state, count(*) as items, sum(freight_value)::decimal(20,2) as freight from fact_order_items
    where order_purchase_date between date '1998-02-01' and date '1998-02-28' group by 1""")
_add("holiday_orders", """
    select year_quarter, count(*) as orders, sum(order_total)::decimal(20,2) as revenue
    from fact_orders join dim_date on date_day = order_purchase_date
    where is_weekend and year_quarter in ('1996-Q4', '1997-Q4') group by 1""")

# streaming and incremental
_add("stream_upsert_users", """
    select * from events
    qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc nulls last, event_type, value, props) = 1""")
_add("stream_daily_revenue", """
    select date_trunc('day', ts)::timestamp as window_start, sum(value::decimal(18,2)) as revenue, count(*) as purchases
    from events group by 1""")
_add("monthly_totals_incremental", """
    select date_trunc('month', order_purchase_date)::date as month_start_date, count(*) as order_count,
           sum(order_total)::decimal(14,2) as revenue, sum(freight_total)::decimal(14,2) as freight_revenue,
           strftime(min(order_purchase_date), '%Y-%m') as order_month
    from fact_orders where order_status not in ('canceled', 'unavailable') group by 1""")
_add("fact_orders_by_month", """
    select strftime(order_purchase_date, '%Y-%m') as order_month, count(*) as orders,
           sum(order_total)::decimal(20,2) as revenue from fact_orders group by 1""")
_add("customer_location_history", """
    select customer_unique_id, customer_zip_code_prefix, customer_state, moment as valid_from,
           lead(moment) over (partition by customer_unique_id order by moment, customer_zip_code_prefix nulls first, customer_state nulls first) as valid_to,
           lead(moment) over (partition by customer_unique_id order by moment, customer_zip_code_prefix nulls first, customer_state nulls first) is null as is_current
    from (select customer_unique_id, customer_zip_code_prefix, customer_state, order_purchase_timestamp as moment,
                 lag((customer_zip_code_prefix, customer_state)) over
                     (partition by customer_unique_id
                     order by order_purchase_timestamp, customer_zip_code_prefix nulls first, customer_state nulls first) as before
          from stg_orders join stg_customers using (customer_id)
          qualify before is null or before is distinct from (customer_zip_code_prefix, customer_state))""")
