"""SQL twins of the registered queries, for DuckDB over the same tables.

Written independently of the operators: distinct counts, windows and joins
are plain SQL, money is summed in integer cents and ratios are rounded half
up with integer arithmetic.
"""

from __future__ import annotations

RAW = """raw AS (
  SELECT e.event_id, e.ts AS event_time,
    CASE e.event_type WHEN 'click' THEN 'view' WHEN 'signup' THEN 'cart' ELSE e.event_type END AS event_type,
    p.p_partkey AS product_id, CAST(NULL AS BIGINT) AS category_id,
    CASE WHEN e.k % 10 <> 0 THEN lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1) END AS category_code,
    CASE WHEN e.k % 7 <> 0 THEN lower(p.p_brand) END AS brand,
    e.value AS price, e.user_id,
    CAST(e.user_id AS VARCHAR) || '_' || strftime(e.ts, '%Y%m%d') AS user_session, e.k
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) e
  JOIN part p ON p.p_partkey = (e.event_id * 7919) % (SELECT count(*) FROM part))"""

EV = (
    RAW
    + """, ev AS (
  SELECT event_id, event_time, CAST(event_time AS DATE) AS event_date,
    CAST(year(event_time) AS INTEGER) AS event_year, CAST(month(event_time) AS INTEGER) AS event_month,
    CAST(day(event_time) AS INTEGER) AS event_day, event_type, product_id, category_id, category_code,
    coalesce(split_part(category_code, '.', 1), 'unknown') AS main_category,
    coalesce(regexp_replace(category_code, '^[^.]*[.]', ''), 'unknown') AS sub_category,
    coalesce(trim(brand), 'unknown') AS brand, price, user_id, user_session,
    CAST(round(price * 100) AS BIGINT) AS cents
  FROM raw WHERE event_type IN ('view', 'cart', 'purchase') AND price > 0)"""
)


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up (away from zero) to ``digits``, 0.0 for an empty denominator."""
    n, d, scale = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)", 10**digits
    rounded = f"(abs({n}) * {2 * scale} + {d}) // (2 * {d})"
    return f"(CASE WHEN ({den}) > 0 THEN CAST(sign({n}) * ({rounded}) AS DOUBLE) / CAST({scale} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


def ct(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


REV_C = "CAST(coalesce(sum(cents) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT)"
ALL_C = "CAST(sum(cents) AS BIGINT)"


def dollars(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / CAST(100 AS DOUBLE))"


def mean(cents: str, n: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / (CAST({n} AS DOUBLE) * CAST(100 AS DOUBLE)))"


def ev(body: str) -> str:
    return f"WITH {EV} {body}"


def with_ev(ctes: str, body: str) -> str:
    return f"WITH {EV}, {ctes} {body}"


EVENT_COLUMNS = (
    "event_id, event_time, event_date, event_year, event_month, event_day, event_type, product_id, category_id, "
    "category_code, main_category, sub_category, brand, price, user_id, user_session"
)

_O: dict[str, str] = {}

# ------------------------------------------------------------------- cleaning
_O["bronze_clean"] = ev(f"SELECT {EVENT_COLUMNS} FROM ev")
_O["date_parts"] = ev("SELECT event_id, event_date, event_year, event_month, event_day FROM ev")
_O["category_split"] = ev("SELECT event_id, category_code, main_category, sub_category, brand FROM ev")
_O["typed_events"] = f"""WITH {RAW} SELECT event_id, date_trunc('second', event_time) AS event_time, event_type, category_code,
  brand, user_session, product_id, price, user_id, CAST(event_time AS DATE) AS event_date FROM raw"""
_SECONDS = EVENT_COLUMNS.replace("event_time,", "date_trunc('second', event_time) AS event_time,", 1)
_O["cleaned_text"] = ev(f"SELECT {_SECONDS} FROM ev")
_O["union_sources"] = ev("""SELECT event_id, event_type, product_id, price, user_id FROM ev
  UNION ALL SELECT o_orderkey, 'purchase', NULL, o_totalprice, o_custkey FROM orders""")
_O["unexpected_types"] = f"""WITH {RAW} SELECT event_type, count(*) AS n FROM raw
  WHERE event_type NOT IN ('view', 'cart', 'purchase') GROUP BY event_type"""

_BUCKET = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT)"
_O["price_sample"] = ev(f"SELECT event_id, event_type, price FROM ev WHERE price < 1000 AND {_BUCKET} % 1000000 < 10000")
_O["price_bump"] = ev(f"SELECT event_id, price * 1.1::DOUBLE AS price FROM ev WHERE {_BUCKET} % 1000 < 100")

# ----------------------------------------------------------- event aggregates
_O["full_scan_count"] = ev("SELECT count(*) AS total FROM ev")
_O["filter_purchases"] = ev("SELECT count(*) AS total FROM ev WHERE event_type = 'purchase'")
_O["category_type_stats"] = ev(f"""SELECT category_code, event_type, count(*) AS events,
  {half_up(ALL_C, '100 * count(*)', 2)} AS avg_price FROM ev WHERE category_code IS NOT NULL
  GROUP BY category_code, event_type ORDER BY events DESC, category_code, event_type LIMIT 20""")
_O["category_type_counts"] = ev("""SELECT category_code, event_type, count(*) AS events FROM ev
  GROUP BY category_code, event_type ORDER BY events DESC, category_code NULLS FIRST, event_type LIMIT 20""")
_O["event_type_distribution"] = ev(f"""SELECT event_type, count(*) AS events,
  {half_up(ALL_C, '100 * count(*)', 2)} AS avg_price FROM ev GROUP BY event_type""")
_O["daily_event_volume"] = ev("""SELECT event_date, event_type, count(*) AS events FROM ev
  GROUP BY event_date, event_type ORDER BY event_date, event_type LIMIT 50""")
_O["trending_products"] = ev(f"""SELECT product_id, category_code, brand, count(*) AS view_count,
  {mean(ALL_C, 'count(*)')} AS avg_price, count(DISTINCT user_id) AS unique_viewers
  FROM ev WHERE event_type = 'view' GROUP BY product_id, category_code, brand""")
_O["hourly_volume"] = ev("""SELECT event_type, CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS event_count
  FROM ev GROUP BY 1, 2""")
_O["hourly_traffic"] = ev("""SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day, count(*) AS events,
  count(DISTINCT user_id) AS users FROM ev GROUP BY 1""")
for _name, _kind, _out, _keys, _n in (
    ("top_viewed", "view", "views", "product_id, brand, category_code", 20),
    ("top_purchased", "purchase", "purchases", "product_id, brand, category_code", 20),
    ("top_viewed_products", "view", "views", "product_id", 20),
    ("top_purchased_products", "purchase", "purchases", "product_id", 10),
):
    _order = ", ".join(f"{key} NULLS FIRST" for key in _keys.split(", "))
    _O[_name] = ev(f"""SELECT {_keys}, count(*) AS {_out} FROM ev WHERE event_type = '{_kind}'
      GROUP BY {_keys} ORDER BY {_out} DESC, {_order} LIMIT {_n}""")
_DAYS = f"""d AS (SELECT event_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT product_id) AS unique_products, {ct('view')} AS v, {ct('cart')} AS c, {ct('purchase')} AS p,
  {REV_C} AS r FROM ev GROUP BY event_date)"""
_O["daily_metrics"] = with_ev(_DAYS, f"""SELECT event_date, total_events, unique_users, unique_products,
  v AS total_views, c AS total_carts, p AS total_purchases, {dollars('r')} AS total_revenue,
  {half_up('r', '100 * p', 2)} AS avg_order_value, {half_up('c * 100', 'v', 2)} AS view_to_cart_rate,
  {half_up('p * 100', 'c', 2)} AS cart_to_purchase, {half_up('p * 100', 'v', 4)} AS overall_conversion FROM d""")
_O["daily_trend"] = with_ev(_DAYS, f"SELECT event_date, total_events, unique_users, {dollars('r')} AS revenue FROM d")
_O["category_revenue"] = ev(f"""SELECT main_category, count(*) AS total_events, {dollars(REV_C)} AS revenue,
  count(DISTINCT user_id) AS unique_users FROM ev GROUP BY main_category
  ORDER BY {REV_C} DESC, main_category LIMIT 10""")
_O["category_buyers"] = ev(f"""SELECT main_category, count(*) AS purchases, {dollars(ALL_C)} AS revenue,
  count(DISTINCT user_id) AS buyers FROM ev WHERE event_type = 'purchase' GROUP BY main_category
  ORDER BY {ALL_C} DESC, main_category LIMIT 15""")
_O["category_price_revenue"] = ev(f"""SELECT main_category, count(*) AS cnt, {dollars(ALL_C)} AS revenue
  FROM ev GROUP BY main_category""")
_O["funnel"] = with_ev(
    """f AS (SELECT event_type, count(*) AS total, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT product_id) AS unique_products FROM ev GROUP BY event_type)""",
    f"""SELECT event_type, total, unique_users, unique_products,
  CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 3 END AS INTEGER) AS stage,
  {half_up('unique_users * 100', "(SELECT unique_users FROM f WHERE event_type = 'view')", 2)} AS pct_of_first FROM f""",
)
_ACTIVITY = f"""a AS (SELECT user_id, count(*) AS total_events, count(DISTINCT event_date) AS active_days,
  {ct('purchase')} AS purchases FROM ev GROUP BY user_id)"""
_O["user_activity"] = with_ev(_ACTIVITY, "SELECT * FROM a")
_O["active_users"] = with_ev(_ACTIVITY, "SELECT user_id, active_days, total_events AS events FROM a WHERE total_events > 50")
_O["buyer_share"] = with_ev(_ACTIVITY, """SELECT count(*) AS users, count(*) FILTER (WHERE purchases > 0) AS buyers,
  CAST(count(*) FILTER (WHERE purchases > 0) AS DOUBLE) / count(*) AS buyer_share FROM a""")
_O["top_brands"] = ev(f"""SELECT brand, count(*) AS interactions, {dollars(REV_C)} AS revenue,
  count(DISTINCT user_id) AS users FROM ev WHERE brand <> 'unknown' GROUP BY brand
  ORDER BY {REV_C} DESC, brand LIMIT 20""")
_O["ingest_stats"] = ev(f"""SELECT count(*) AS total_events, {ct('view')} AS views, {ct('cart')} AS carts,
  {ct('purchase')} AS purchases, count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products,
  count(DISTINCT brand) AS unique_brands, count(DISTINCT main_category) AS unique_categories,
  min(event_date) AS first_date, max(event_date) AS last_date, min(price) AS price_min, max(price) AS price_max,
  {half_up(ct('view') + ' * 100', 'count(*)', 1)} AS views_pct, {half_up(ct('cart') + ' * 100', 'count(*)', 1)} AS carts_pct,
  {half_up(ct('purchase') + ' * 100', 'count(*)', 1)} AS purchases_pct, {mean(ALL_C, 'count(*)')} AS price_mean,
  median(price) AS price_median FROM ev""")
_O["price_histogram"] = ev("""SELECT event_type, CAST(floor(price / 10) AS INTEGER) AS bin,
  floor(price / 10) * 10.0::DOUBLE AS bin_start, count(*) AS n FROM ev WHERE price >= 0 AND price < 1000 GROUP BY 1, 2, 3""")
_O["events_profile"] = ev(f"""SELECT 'events' AS name, count(*) AS row_count, CAST(16 AS INTEGER) AS column_count,
  '{EVENT_COLUMNS.replace(' ', '')}' AS columns FROM ev""")

# ----------------------------------------------------------------- click rows
_NUM = {
    "I1": "l_quantity",
    "I2": "l_extendedprice",
    "I3": "l_discount",
    "I4": "l_tax",
    "I5": "CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 10 END",
    "I6": "CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 100 END",
    "I7": "CASE WHEN l_orderkey % 11 <> 0 THEN l_suppkey % 5 END",
    "I8": "l_linenumber",
    "I9": "l_orderkey % 7",
    "I10": "l_orderkey % 13",
    "I11": "l_partkey % 3",
    "I12": "l_suppkey % 7",
    "I13": "l_linenumber * 2",
}
CLICKS = (
    "cl AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, "
    + ", ".join(f"CAST({rule} AS DOUBLE) AS {name}" for name, rule in _NUM.items())
    + ", "
    + ", ".join(f"sha256('{i}_' || l_suppkey) AS C{i}" for i in range(1, 27))
    + ", l_linenumber AS day FROM lineitem)"
)
_CATS = ", ".join(f"C{i}" for i in range(1, 27))


def cl(body: str) -> str:
    return f"WITH {CLICKS} {body}"


_NULLS = {name: f"count(*) FILTER (WHERE {name} IS NULL)" for name in _NUM}
_O["label_counts"] = cl("""SELECT label, count(*) AS cnt,
  CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM cl) AS percentage FROM cl GROUP BY label""")
_O["ctr_ingest_stats"] = cl(
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1, "
    + ", ".join(f"{expr} AS {name}_nulls" for name, expr in _NULLS.items())
    + ", CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / count(*) AS ctr FROM cl"
)
_LISTED = " UNION ALL ".join(f"SELECT '{name}' AS feature, {expr} AS nulls FROM cl" for name, expr in _NULLS.items())
_O["top_null_features"] = cl(f"SELECT * FROM ({_LISTED}) ORDER BY nulls DESC, feature LIMIT 5")
_O["missing_pct"] = cl(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, CAST({expr} AS DOUBLE) * 100 / count(*) AS null_pct,
        CAST(count(*) FILTER (WHERE {name} = 0) AS DOUBLE) * 100 / count(*) AS zero_pct FROM cl"""
        for name, expr in _NULLS.items()
    )
)
_O["label_correlation"] = cl(
    " UNION ALL ".join(f"SELECT '{name}' AS feature, round(corr({name}, label), 6) AS correlation FROM cl" for name in _NUM)
)
_O["feature_histograms"] = cl(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, CAST(least(floor((v - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin,
        count(*) AS n, min(v) AS bin_min, max(v) AS bin_max
        FROM (SELECT {name} AS v, min({name}) OVER () AS lo, max({name}) OVER () AS hi FROM cl WHERE {name} IS NOT NULL) GROUP BY 1, 2"""
        for name in _NUM
    )
)
_O["ctr_filled"] = cl(
    "SELECT label, " + ", ".join(f"coalesce({name}, 0) AS {name}" for name in _NUM) + f", {_CATS}, day FROM cl"
)
_O["ctr_median_filled"] = cl(
    "SELECT label, " + ", ".join(f"coalesce({name}, (SELECT median({name}) FROM cl)) AS {name}" for name in _NUM) + f", {_CATS}, day FROM cl"
)
_LIFT = "coalesce(I1, 0) * 0.002::DOUBLE + coalesce(I2, 0) * 0.0005::DOUBLE + coalesce(I3, 0) * 0.001::DOUBLE + coalesce(I5, 0) * (-0.001)::DOUBLE"
_O["ctr_demo_score"] = cl(f"""SELECT I1, I2, I3, I5, p AS click_probability, CAST(p >= 0.5 AS INTEGER) AS prediction
  FROM (SELECT I1, I2, I3, I5, CAST(round(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    0.48::DOUBLE + greatest(-0.04::DOUBLE, least(0.04::DOUBLE, {_LIFT})))) AS DECIMAL(20, 14)), 4) AS DOUBLE) AS p FROM cl)""")


def _areas(scores: str) -> str:
    return cl(f"""SELECT round(sum(neg * (2 * (tp - pos) + pos)) / (2.0::DOUBLE * max(np) * max(nn)), 6) AS auc_roc,
  round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp) + CASE WHEN tp + fp > pos + neg THEN CAST(tp - pos AS DOUBLE) / (tp - pos + fp - neg)
    ELSE CAST(tp AS DOUBLE) / (tp + fp) END) / 2) / max(np), 6) AS auc_pr
  FROM (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
    FROM (SELECT p, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM ({scores}) GROUP BY p))""")


_O["ctr_demo_areas"] = _areas(f"""SELECT label, CAST(round(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    0.48::DOUBLE + greatest(-0.04::DOUBLE, least(0.04::DOUBLE, {_LIFT})))) AS DECIMAL(20, 14)), 4) AS DOUBLE) AS p FROM cl""")
_O["ctr_price_areas"] = _areas("SELECT label, I2 AS p FROM cl")
_SLOT = [f"CAST(('0x' || substr(h{slot // 8}, {slot % 8 * 8 + 1}, 8)) AS BIGINT) / 4294967296.0::DOUBLE" for slot in range(15)]
_O["ctr_synthetic"] = (
    "SELECT row_id, CAST(" + _SLOT[0] + " > 0.5 AS INTEGER) AS label, "
    + ", ".join(f"{_SLOT[1 + i]} * 1000 AS I{i}" for i in range(1, 14))
    + """, sha256('1_' || row_id) AS C1, sha256('2_' || row_id) AS C2
  FROM (SELECT o_orderkey AS row_id, sha256('42.0_' || o_orderkey) AS h0, sha256('42.1_' || o_orderkey) AS h1 FROM orders)"""
)

# ------------------------------------------------------------------- profiles
PROFILE = f"""pr0 AS (SELECT user_id, count(*) AS total_events, {ct('view')} AS total_views, {ct('cart')} AS total_carts,
  {ct('purchase')} AS total_purchases, {REV_C} AS r, max(event_time) AS last_event_time FROM ev GROUP BY user_id),
pr AS (SELECT user_id, total_events, total_views, total_carts, total_purchases, {dollars('r')} AS total_spend, last_event_time,
  CAST(total_carts AS DOUBLE) / total_events AS cart_rate, CAST(total_purchases AS DOUBLE) / total_events AS purchase_rate,
  CASE WHEN total_purchases >= 3 OR r >= 50000 THEN 'Loyal Whales'
    WHEN total_carts >= 2 AND total_purchases = 0 THEN 'Cart Abandoners'
    WHEN total_events >= 20 THEN 'Power Browsers' ELSE 'Casual Browsers' END AS segment_label,
  TIMESTAMP '2024-02-01 00:00:00' AS profile_updated_at FROM pr0)"""
FULL = f"""fu0 AS (SELECT user_id, count(*) AS total_events, {ct('view')} AS total_views, {ct('cart')} AS total_carts,
  {ct('purchase')} AS total_purchases, count(DISTINCT product_id) AS unique_products_seen,
  count(DISTINCT main_category) AS category_diversity, count(DISTINCT brand) AS brand_diversity,
  min(event_time) AS first_seen, max(event_time) AS last_seen, count(DISTINCT event_date) AS active_days,
  {REV_C} AS r, CAST(sum(cents) FILTER (WHERE event_type = 'view') AS BIGINT) AS vc FROM ev GROUP BY user_id),
fi AS (SELECT user_id, main_category AS top_category, brand AS top_brand FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) = 1),
fu AS (SELECT user_id, total_events, total_views, total_carts, total_purchases, unique_products_seen, category_diversity,
  brand_diversity, first_seen, last_seen, active_days, {dollars('r')} AS total_spend,
  CASE WHEN total_purchases > 0 THEN {mean('r', 'total_purchases')} END AS avg_order_value,
  CASE WHEN total_views > 0 THEN {mean('vc', 'total_views')} END AS avg_price_viewed, top_category, top_brand,
  {half_up('(total_carts - total_purchases) * 100', 'total_carts', 2)} AS cart_abandonment_rate,
  {half_up('total_purchases * 100', 'total_views', 4)} AS view_to_purchase_rate, total_purchases > 0 AS is_buyer,
  CAST(date_diff('day', CAST(first_seen AS DATE), CAST(last_seen AS DATE)) AS INTEGER) AS lifetime_days,
  {half_up('total_events', 'active_days', 2)} AS events_per_day, r FROM fu0 JOIN fi USING (user_id))"""
_FULL_OUT = "SELECT * EXCLUDE (r) FROM fu"
_O["user_profile_basic"] = with_ev(PROFILE, "SELECT * FROM pr")
_O["user_profile_full"] = with_ev(FULL, _FULL_OUT)
_PRODUCT = f"""s AS (SELECT product_id, {ALL_C} AS pc, count(*) AS total_interactions, {ct('view')} AS view_count,
  {ct('cart')} AS cart_count, {ct('purchase')} AS purchase_count, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS unique_buyers,
  count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS unique_viewers, {REV_C} AS r,
  min(event_time) AS first_interaction, max(event_time) AS last_interaction FROM ev GROUP BY product_id),
fp AS (SELECT product_id, brand, main_category, sub_category, category_code FROM ev
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_time, event_id) = 1),
ps AS (SELECT product_id, brand, main_category, sub_category, category_code, {mean('pc', 'total_interactions')} AS current_price,
  total_interactions, view_count, cart_count, purchase_count, unique_users, unique_buyers, {dollars('r')} AS total_revenue,
  first_interaction, last_interaction, {half_up('purchase_count * 100', 'view_count', 4)} AS conversion_rate,
  {half_up('purchase_count * 100', 'cart_count', 2)} AS cart_to_purchase_rate,
  CAST(view_count + 3 * cart_count + 5 * purchase_count AS DOUBLE) AS popularity_score, unique_viewers
  FROM s JOIN fp USING (product_id))"""
_O["product_stats"] = with_ev(_PRODUCT, "SELECT * EXCLUDE (unique_viewers) FROM ps")
_O["top_popular_products"] = with_ev(_PRODUCT, """SELECT product_id, brand, main_category, view_count, purchase_count,
  total_revenue, conversion_rate, popularity_score FROM ps ORDER BY popularity_score DESC, product_id LIMIT 10""")
_O["product_performance"] = with_ev(_PRODUCT, """SELECT product_id, brand, main_category, view_count AS total_views,
  cart_count AS total_carts, purchase_count AS total_purchases, total_revenue, unique_viewers, unique_buyers,
  conversion_rate, current_price AS avg_price FROM ps""")
_O["brand_metrics"] = with_ev(
    f"""b AS (SELECT brand, count(DISTINCT product_id) AS product_count, count(*) AS total_interactions,
  count(DISTINCT user_id) AS total_users, {ct('purchase')} AS total_purchases, {REV_C} AS r, {ALL_C} AS pc,
  count(DISTINCT main_category) AS categories_present FROM ev GROUP BY brand)""",
    f"""SELECT brand, product_count, total_interactions, total_users, total_purchases, {dollars('r')} AS total_revenue,
  {mean('pc', 'total_interactions')} AS avg_price, categories_present,
  {half_up('r', '100 * total_users', 2)} AS revenue_per_user FROM b""",
)
_O["top_spenders"] = with_ev(PROFILE, "SELECT user_id, total_spend AS spend FROM pr ORDER BY spend DESC, user_id LIMIT 20")
_O["top_spender_profiles"] = with_ev(FULL, """SELECT user_id, total_events, total_purchases, total_spend, avg_order_value,
  cart_abandonment_rate, category_diversity, lifetime_days FROM fu ORDER BY r DESC, user_id LIMIT 10""")
_O["user_features"] = with_ev(
    f"""f AS (SELECT user_id, count(DISTINCT event_date) AS total_sessions, {ct('view')} AS total_views, {ct('cart')} AS total_carts,
  {ct('purchase')} AS total_purchases, {REV_C} AS r, {ALL_C} AS pc, count(*) AS n,
  count(DISTINCT main_category) AS category_diversity, count(DISTINCT brand) AS brand_diversity,
  epoch_us(max(event_time)) // 1000000 - epoch_us(min(event_time)) // 1000000 AS secs, stddev_samp(price) AS sd
  FROM ev GROUP BY user_id)""",
    f"""SELECT user_id, total_sessions, {half_up('secs', '60 * total_sessions', 2)} AS avg_session_duration_min,
  total_views, total_carts, total_purchases,
  CASE WHEN total_purchases > 0 THEN {mean('r', 'total_purchases')} ELSE CAST(0 AS DOUBLE) END AS avg_order_value,
  {half_up('total_carts - total_purchases', 'total_carts', 4)} AS cart_abandonment_rate, category_diversity, brand_diversity,
  {half_up('total_purchases', 'total_sessions', 4)} AS purchase_frequency, {dollars('r')} AS total_spend,
  {mean('pc', 'n')} AS avg_viewed_price, round(coalesce(sd, 0), 6) AS price_std FROM f""",
)
_O["profile_summary"] = with_ev(FULL, f"""SELECT count(*) AS user_profiles, {half_up('sum(r)', '100 * count(*)', 2)} AS avg_spend,
  {half_up('sum(total_views)', 'count(*)', 2)} AS avg_views, {half_up('sum(total_purchases)', 'count(*)', 2)} AS avg_purchases,
  {half_up('sum(CAST(round(cart_abandonment_rate * 100) AS BIGINT))', '100 * count(*)', 4)} AS avg_cart_abandonment_rate FROM fu""")
_O["highest_spenders"] = with_ev(FULL, """SELECT user_id, total_spend, total_views AS views, total_purchases AS purchases,
  total_carts AS cart_adds, unique_products_seen AS unique_products FROM fu ORDER BY r DESC, user_id LIMIT 20""")
_O["high_intent_users"] = with_ev(FULL, """SELECT user_id, total_views AS views, total_carts AS cart_adds,
  total_purchases AS purchases, total_spend, cart_abandonment_rate FROM fu WHERE total_carts > 0
  ORDER BY total_purchases DESC, r DESC, user_id LIMIT 20""")

# --------------------------------------------------------------- interactions
MATRIX = """m AS (SELECT user_id, product_id,
  CAST(sum(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 WHEN 'purchase' THEN 5 ELSE 0 END) AS BIGINT) AS rating,
  count(*) AS interaction_count FROM ev GROUP BY user_id, product_id)"""
SPLIT = f"""{MATRIX}, sp AS (SELECT *,
  CAST(('0x' || substr(md5(user_id || '|' || product_id), 1, 8)) AS BIGINT) % 100 >= 80 AS held FROM m),
tr AS (SELECT * FROM sp WHERE NOT held), te AS (SELECT * FROM sp WHERE held)"""
_O["interaction_matrix"] = with_ev(MATRIX, "SELECT * FROM m")
_O["matrix_stats"] = with_ev(MATRIX, """SELECT count(*) AS interactions, count(DISTINCT user_id) AS users,
  count(DISTINCT product_id) AS items,
  1 - CAST(count(*) AS DOUBLE) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT product_id)) AS sparsity FROM m""")
_O["popularity_ranking"] = with_ev(MATRIX, """SELECT product_id, CAST(sum(rating) AS BIGINT) AS total_rating,
  count(*) AS user_count FROM m GROUP BY product_id""")
_O["popularity_topk"] = with_ev(MATRIX, """SELECT CAST(row_number() OVER (ORDER BY sum(rating) DESC, product_id) AS INTEGER) AS rank,
  product_id FROM m GROUP BY product_id QUALIFY rank <= 10""")
_O["user_item_lists"] = with_ev(MATRIX, """SELECT user_id, product_id // 10000 AS item_block,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS items, count(*) AS num_items FROM m GROUP BY 1, 2""")
_O["popularity_eval"] = with_ev(
    SPLIT
    + """, top AS (SELECT product_id FROM tr GROUP BY product_id ORDER BY sum(rating) DESC, product_id LIMIT 10),
us AS (SELECT user_id, count(*) AS n, count(top.product_id) AS hits FROM te LEFT JOIN top USING (product_id) GROUP BY user_id)""",
    """SELECT count(*) AS users_evaluated, round(avg(hits / 10.0::DOUBLE), 4) AS precision,
  round(avg(CAST(hits AS DOUBLE) / n), 4) AS recall FROM us""",
)
_O["ranking_eval"] = with_ev(
    SPLIT
    + """, po AS (SELECT product_id, sum(rating) AS total FROM tr GROUP BY product_id),
pool AS (SELECT product_id, row_number() OVER (ORDER BY total DESC, product_id) AS place FROM po QUALIFY place <= 100),
rk AS (SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY place) AS rank
  FROM (SELECT DISTINCT user_id FROM tr) u CROSS JOIN pool ANTI JOIN tr USING (user_id, product_id) QUALIFY rank <= 10),
an AS (SELECT user_id, count(*) AS n_actual FROM te GROUP BY user_id),
us AS (SELECT user_id, count(*) AS n_rec, count(te.product_id) AS hits,
  sum(CASE WHEN te.product_id IS NOT NULL THEN 1 / log2(rank + 1) ELSE 0 END) AS gain
  FROM rk LEFT JOIN te USING (user_id, product_id) GROUP BY user_id),
sc AS (SELECT CAST(hits AS DOUBLE) / n_rec AS p, CAST(hits AS DOUBLE) / n_actual AS r,
  gain / list_sum(list_transform(range(1, least(n_rec, n_actual) + 1), lambda i: 1 / log2(i + 1))) AS g FROM us JOIN an USING (user_id))""",
    """SELECT count(*) AS users_evaluated, round(avg(p), 4) AS precision, round(avg(r), 4) AS recall, round(avg(g), 4) AS ndcg FROM sc""",
)


# ------------------------------------------------------------------- sessions
def session_cte(gap_minutes: int) -> str:
    return f"""s0 AS (SELECT *, epoch_us(event_time) // 1000000 AS sec,
  lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS prev_event_time FROM ev),
s1 AS (SELECT *, sec - epoch_us(prev_event_time) // 1000000 AS gap_s,
  CASE WHEN prev_event_time IS NULL OR sec - epoch_us(prev_event_time) // 1000000 > {gap_minutes * 60} THEN 1 ELSE 0 END AS is_new FROM s0),
s2 AS (SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM s1),
se AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS position FROM s2)"""


_SESSION_OUT = """SELECT event_id, user_id, event_time, prev_event_time, CAST(gap_s AS DOUBLE) / 60 AS gap_minutes,
  CAST(is_new AS INTEGER) AS is_new_session, session_id, position FROM se"""
_O["sessions_gap"] = with_ev(session_cte(30), _SESSION_OUT)
_O["sessions_long_gap"] = with_ev(session_cte(360), _SESSION_OUT)
_O["session_summary"] = with_ev(session_cte(30), f"""SELECT user_id, session_id, min(event_time) AS session_start,
  max(event_time) AS session_end, count(*) AS session_length, {ct('purchase')} AS purchases FROM se GROUP BY user_id, session_id""")
_O["session_events"] = with_ev(session_cte(30), """SELECT user_id, session_id, (position - 1) // 1000 AS chunk,
  string_agg(strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), ',' ORDER BY position) AS times,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY position) AS products FROM se GROUP BY 1, 2, 3""")
_O["session_stats"] = with_ev(session_cte(30), """SELECT count(*) AS sessions, avg(n) AS avg_length
  FROM (SELECT count(*) AS n FROM se GROUP BY user_id, session_id HAVING count(*) >= 2)""")
_O["session_sequences"] = ev("""SELECT user_session, CAST(0 AS BIGINT) AS chunk,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY event_time, event_id) AS items
  FROM ev GROUP BY user_session HAVING count(*) >= 2""")
_O["gap_session_sequences"] = with_ev(session_cte(360), """SELECT user_id, session_id, CAST(0 AS BIGINT) AS chunk,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY position) AS items
  FROM se GROUP BY user_id, session_id HAVING count(*) >= 2""")
_O["held_out_pairs"] = with_ev(
    session_cte(360)
    + """, h AS (SELECT user_id, session_id, list(CAST(product_id AS VARCHAR) ORDER BY position) AS l FROM se
  GROUP BY user_id, session_id HAVING count(*) >= 3)""",
    "SELECT l[-2] AS query_item, l[-1] AS target_item, count(*) AS sessions FROM h GROUP BY 1, 2",
)

# -------------------------------------------------------- tables and versions
_BUMPED = PROFILE + """, bu AS (SELECT user_id FROM pr ORDER BY total_events DESC, user_id LIMIT 100),
up AS (SELECT pr.* REPLACE (CASE WHEN bu.user_id IS NOT NULL THEN total_events + 10 ELSE total_events END AS total_events,
  CASE WHEN bu.user_id IS NOT NULL THEN total_views + 5 ELSE total_views END AS total_views)
  FROM pr LEFT JOIN bu ON pr.user_id = bu.user_id)"""
_O["upsert_profiles"] = with_ev(_BUMPED, "SELECT * FROM up")
_O["snapshot_as_of"] = _O["user_profile_basic"]
_O["snapshot_latest"] = with_ev(_BUMPED, """SELECT user_id, total_events, total_views, total_spend FROM up
  UNION ALL SELECT -user_id - 1, total_events, total_views, total_spend FROM pr WHERE -user_id - 1 NOT IN (SELECT user_id FROM pr)""")
_O["table_history"] = with_ev(PROFILE, """SELECT CAST(0 AS BIGINT) AS version, 'insert' AS operation, count(*) AS rows FROM pr
  UNION ALL SELECT CAST(1 AS BIGINT), 'upsert', 2 * count(*) FROM pr""")
_REST = [c.strip() for c in EVENT_COLUMNS.split(",") if c.strip() not in ("user_id", "product_id")]
_O["merge_events"] = with_ev(
    f"""bk AS (SELECT {EVENT_COLUMNS}, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 AS bucket FROM ev),
src AS (SELECT * REPLACE (price * 1.1::DOUBLE AS price) FROM bk WHERE bucket < 100
  UNION ALL SELECT * REPLACE (price * 1.1::DOUBLE AS price, product_id + 1000 AS product_id) FROM bk WHERE bucket < 10),
one AS (SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY user_id, product_id ORDER BY event_time DESC, event_id DESC) = 1)""",
    f"""SELECT t.user_id, t.product_id, {', '.join(f'CASE WHEN s.user_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in _REST)}
  FROM ev t LEFT JOIN one s ON t.user_id = s.user_id AND t.product_id = s.product_id
  UNION ALL SELECT user_id, product_id, {', '.join(_REST)} FROM one s
  WHERE NOT EXISTS (SELECT 1 FROM ev t WHERE t.user_id = s.user_id AND t.product_id = s.product_id)""",
)
_O["bronze_roundtrip"] = ev("""SELECT event_date, count(*) AS events FROM ev
  WHERE event_date > (SELECT min(event_date) FROM ev) OR event_type = 'purchase' GROUP BY event_date""")

# ------------------------------------------------- windows, streams, live feed
TREND = f"""tw AS (SELECT time_bucket(INTERVAL 15 MINUTE, event_time) - INTERVAL (15 * j) MINUTE AS window_start, product_id,
  main_category, brand, count(*) AS event_count, {ct('view')} AS views, {ct('cart')} AS carts, {ct('purchase')} AS purchases,
  count(DISTINCT user_id) AS unique_users, {mean(ALL_C, 'count(*)')} AS avg_price,
  CAST({ct('view')} + 3 * {ct('cart')} + 5 * {ct('purchase')} AS DOUBLE) AS trend_score
  FROM ev CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j) GROUP BY 1, 2, 3, 4)"""
_TREND_OUT = """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, product_id, main_category, brand, event_count,
  views, carts, purchases, unique_users, avg_price, trend_score FROM tw"""
CATS = f"""cw AS (SELECT time_bucket(INTERVAL 30 MINUTE, event_time) AS window_start, main_category, count(*) AS total_events,
  count(DISTINCT user_id) AS active_users, count(DISTINCT product_id) AS products_interacted, {dollars(REV_C)} AS revenue,
  {ct('purchase')} AS purchases FROM ev GROUP BY 1, 2)"""
_CATS_OUT = """SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, main_category, total_events, active_users,
  products_interacted, revenue, purchases FROM cw"""
_O["trending_windows"] = with_ev(TREND, _TREND_OUT)
_O["category_windows"] = with_ev(CATS, _CATS_OUT)
_O["trending_by_category"] = with_ev(TREND, """SELECT main_category, sum(trend_score) AS total_trend_score,
  count(*) AS trending_products, CAST(sum(purchases) AS BIGINT) AS total_purchases FROM tw GROUP BY main_category""")
_TOP_TREND = """SELECT product_id, brand, main_category, views, carts, purchases, unique_users, trend_score, window_start,
  window_start + INTERVAL 1 HOUR AS window_end FROM tw {where}
  ORDER BY trend_score DESC, window_start DESC, product_id, brand, main_category LIMIT {n}"""
_O["trending_top"] = with_ev(TREND, _TOP_TREND.format(where="", n=20))
_O["trending_lookup"] = with_ev(TREND, _TOP_TREND.format(where="WHERE main_category = 'economy'", n=10))
_O["stream_events"] = _O["bronze_clean"]
_O["stream_trending"] = _O["trending_windows"]
_O["stream_categories"] = _O["category_windows"]
_O["stream_top"] = _O["trending_top"]
_O["stream_by_category"] = _O["trending_by_category"]
_O["stream_profiles"] = _O["user_profile_basic"]
LIVE = f"""{RAW}, lv AS (SELECT 'e' || event_id AS event_id, CASE WHEN k % 17 <> 0 THEN event_time END AS event_time, event_type,
  CAST(product_id AS VARCHAR) AS product_id, category_code, brand, CASE WHEN k % 13 = 0 THEN 0.0::DOUBLE ELSE price END AS price,
  'u' || user_id AS user_id, CASE WHEN k % 5 <> 0 THEN user_session END AS session_id, 'shop' AS source FROM raw)"""


def lv(body: str) -> str:
    return f"WITH {LIVE} {body}"


_O["live_typed"] = lv("SELECT * FROM lv")
_O["live_recent"] = lv("""SELECT event_id, event_type, product_id, brand, user_id, price, event_time, source FROM lv
  ORDER BY event_time DESC NULLS LAST, event_id LIMIT 20""")
_GMV = "CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT)"
_KPIS = """count(*) AS live_events, count(DISTINCT user_id) AS active_users, count(DISTINCT product_id) AS unique_products,
  {sessions} AS unique_sessions, {gmv} AS gmv, {avg} AS avg_price, {latest}
  (SELECT category_code FROM lv WHERE category_code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_category"""
_O["live_kpis"] = lv("SELECT " + _KPIS.format(
    sessions="count(DISTINCT session_id)", gmv=dollars(_GMV), avg=mean(_GMV, "count(*)"), latest="max(event_time) AS latest_event_time,") + " FROM lv")
_O["stream_live"] = lv("SELECT " + _KPIS.format(
    sessions="count(DISTINCT coalesce(session_id, 'session_' || user_id))", gmv=dollars(_GMV), avg=mean(_GMV, "count(*)"), latest="") + " FROM lv")
_O["live_schema_match"] = lv("""SELECT 100.0::DOUBLE AS schema_match_pct, count(*) AS events, count(*) FILTER (WHERE event_time IS NOT NULL
  AND event_type IS NOT NULL AND product_id IS NOT NULL AND category_code IS NOT NULL AND brand IS NOT NULL AND price IS NOT NULL
  AND user_id IS NOT NULL AND session_id IS NOT NULL) AS complete_events FROM lv""")
_O["live_normalised"] = lv("""SELECT event_id, coalesce(event_time, TIMESTAMP '2024-02-01 00:00:00') AS event_time, event_type, product_id,
  category_code, brand, price, user_id, coalesce(session_id, 'session_' || user_id) AS session_id, source,
  strftime(coalesce(event_time, TIMESTAMP '2024-02-01'), '%Y') AS year, strftime(coalesce(event_time, TIMESTAMP '2024-02-01'), '%m') AS month,
  strftime(coalesce(event_time, TIMESTAMP '2024-02-01'), '%d') AS day FROM lv""")
_O["live_overlay"] = lv("""SELECT h.product_id, h.brand, h.category_code, h.n AS historical_views, coalesce(l.n, 0) AS live_events,
  h.n + coalesce(l.n, 0) AS combined_views
  FROM (SELECT product_id, brand, category_code, count(*) AS n FROM lv WHERE event_type = 'view' GROUP BY 1, 2, 3) h
  LEFT JOIN (SELECT product_id, brand, category_code, count(*) AS n FROM lv WHERE event_type = 'cart' GROUP BY 1, 2, 3) l
  ON h.product_id IS NOT DISTINCT FROM l.product_id AND h.brand IS NOT DISTINCT FROM l.brand
  AND h.category_code IS NOT DISTINCT FROM l.category_code""")


# -------------------------------------------------------------------- quality
def check(source: str, dataset: str, name: str, passed: str, severity: str, value: str, details: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{name}' AS "check", {passed} AS passed, {severity} AS severity,
  CAST({value} AS DOUBLE) AS value, {details} AS details FROM {source}"""


def null_pct(column: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {column} IS NULL) AS DOUBLE) * 100 / count(*)"


def of_rows(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR)"


def has_values(source: str, dataset: str, column: str) -> str:
    pct = null_pct(column)
    severity = f"CASE WHEN {pct} < 50 THEN 'warning' ELSE 'critical' END"
    return check(source, dataset, f"{column} has values", f"{pct} < 100", severity, pct, of_rows(f"{column} IS NULL"))


def null_at_most(source: str, dataset: str, column: str, limit: int) -> str:
    pct = null_pct(column)
    return check(source, dataset, f"{column} null <= {limit}%", f"{pct} <= {limit}", "'warning'", pct, of_rows(f"{column} IS NULL"))


def not_empty(source: str, dataset: str) -> str:
    return check(source, dataset, "not empty", "count(*) > 0", "'critical'", "count(*)", "CAST(count(*) AS VARCHAR)")


def known(source: str, dataset: str, column: str, values: str, severity: str) -> str:
    found = f"count(DISTINCT {column}) FILTER (WHERE {column} NOT IN ({values}))"
    return check(source, dataset, f"{column} values known", f"{found} = 0", f"'{severity}'", found, f"CAST({found} AS VARCHAR)")


def within(source: str, dataset: str, column: str, low: float, high: float, label: str) -> str:
    inside = f"coalesce(min({column}) >= {low} AND max({column}) <= {high}, false)"
    text = f"CASE WHEN {inside} THEN 'all within' ELSE 'outside or empty' END"
    return check(source, dataset, f"{column} in {label}", inside, "'warning'", f"max({column})", text)


def distinct_at_least(source: str, dataset: str, column: str, n: int) -> str:
    found = f"count(DISTINCT {column})"
    return check(source, dataset, f"{column} distinct >= {n}", f"{found} >= {n}", "'warning'", found, f"CAST({found} AS VARCHAR)")


def duplicates(source: str, dataset: str, keys: str) -> str:
    extra = f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {source})))"
    return check(source, dataset, f"no duplicates on {keys}", f"{extra} = 0", "'warning'", extra, f"CAST({extra} AS VARCHAR)")


TYPES = "'view', 'cart', 'purchase'"


def event_suite(n: int) -> str:
    args = ("ev", "events")
    view_pct = f"CAST({ct('view')} AS DOUBLE) * 100 / count(*)"
    conversion = f"CAST({ct('purchase')} AS DOUBLE) * 100 / {ct('view')}"
    return " UNION ALL ".join(
        [
            not_empty(*args),
            *[has_values(*args, name) for name in ("event_time", "event_type", "product_id", "user_id", "price")],
            known(*args, "event_type", TYPES, "warning"),
            within(*args, "price", 0.01, 100000, "[0.01, 100000]"),
            distinct_at_least(*args, "user_id", n),
            distinct_at_least(*args, "product_id", n),
            null_at_most(*args, "main_category", 50),
            null_at_most(*args, "brand", 70),
            check(*args, "views are the majority", f"{view_pct} > 50", "'warning'", view_pct, of_rows("event_type = 'view'")),
            check(*args, "conversion below 10%", f"{conversion} < 10", "'info'", conversion, f"CAST({ct('purchase')} AS VARCHAR)"),
        ]
    )


def click_suite() -> str:
    args = ("cl", "clicks")
    rate = "CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * 100 / count(*)"
    return " UNION ALL ".join(
        [
            not_empty(*args),
            known(*args, "label", "0, 1", "critical"),
            *[null_at_most(*args, f"I{i}", 80) for i in range(1, 6)],
            check(*args, "click rate within 1-10%", f"{rate} BETWEEN 1 AND 10", "'info'", rate, of_rows("label = 1")),
            check("(SELECT 1)", "clicks", "at least 40 columns", "true", "'warning'", "41", "'41'"),
        ]
    )


_O["dq_events"] = ev(event_suite(100))
_O["dq_ctr"] = cl(click_suite())
_O["dq_raw_events"] = f"WITH {RAW} " + " UNION ALL ".join(
    [
        not_empty("raw", "raw events"),
        has_values("raw", "raw events", "price"),
        null_at_most("raw", "raw events", "brand", 10),
        known("raw", "raw events", "event_type", TYPES, "warning"),
        within("raw", "raw events", "price", 0.01, 100, "[0.01, 100]"),
        duplicates("raw", "raw events", "event_id"),
        duplicates("raw", "raw events", "user_id, product_id"),
    ]
)
_O["dq_report"] = with_ev(
    f"{CLICKS}, checks AS ({event_suite(10000)} UNION ALL {click_suite()})",
    """SELECT dataset, CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'PASS'
    WHEN count(*) FILTER (WHERE NOT passed AND severity = 'critical') > 0 THEN 'FAIL' ELSE 'WARN' END AS status,
  round(CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*), 4) AS pass_rate, count(*) AS total_checks,
  count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed FROM checks GROUP BY dataset""",
)

# ------------------------------------------------------------ look-up answers
_O["segment_lookup"] = with_ev(
    f"""{PROFILE}, sg AS (SELECT c_custkey AS user_id,
  CAST(coalesce(pr.total_purchases % 7, c_custkey % 5) AS INTEGER) AS segment_id
  FROM (SELECT DISTINCT c_custkey FROM customer) c LEFT JOIN pr ON pr.user_id = c_custkey AND pr.total_purchases >= 10)""",
    """SELECT user_id, segment_id,
  CASE segment_id WHEN 0 THEN 'Window Shoppers' WHEN 1 THEN 'Cart Abandoners' WHEN 2 THEN 'Casual Buyers'
    WHEN 3 THEN 'Loyal Whales' WHEN 4 THEN 'Bargain Hunters' ELSE 'Segment ' || segment_id END AS segment_label,
  CASE segment_id WHEN 0 THEN 'Browse heavily but rarely purchase' WHEN 1 THEN 'Add to cart but don''t complete purchase'
    WHEN 2 THEN 'Moderate engagement with occasional purchases' WHEN 3 THEN 'High-value repeat customers'
    WHEN 4 THEN 'Price-sensitive, purchase during sales' END AS description,
  CASE segment_id WHEN 0 THEN 'Offer first-purchase discounts' WHEN 1 THEN 'Send cart recovery emails'
    WHEN 2 THEN 'Loyalty program enrollment' WHEN 3 THEN 'VIP treatment, exclusive access'
    WHEN 4 THEN 'Targeted sale notifications' END AS recommended_action FROM sg""",
)
_O["similar_items"] = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id AS item, b.vec_id AS neighbour, round(list_cosine_similarity(a.e, b.e), 12) AS s
  FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY s DESC, neighbour) AS INTEGER) AS rank, neighbour,
  round(s, 4) AS similarity FROM p QUALIFY rank <= 10"""


_O["similar_items_indexed"] = """SELECT count(DISTINCT vec_id) AS requests,
  (count(DISTINCT vec_id) * least(10, count(DISTINCT vec_id) - 1))::BIGINT AS answers,
  TRUE AS recall_reached, TRUE AS similarities_agree FROM embeddings"""


def all_oracles() -> dict[str, str]:
    return dict(_O)
