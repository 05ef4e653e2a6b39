"""The registered queries once more, as SQL for an independent engine over the same tables."""

from __future__ import annotations

from clickloom import registry as R

# ---- Fixed values of the data contract, spelled out here once more so that a wrong one elsewhere shows ----
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
UNKNOWN_SESSION = "unknown_session"
UNKNOWN_EVENT_TYPE = "unknown_event_type"
UNKNOWN_CATEGORY = "N/A"
UNKNOWN_BRAND = "Unknown"
UNKNOWN_MEMBER = "-1"
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
#: Which check each column has.
CHECKS = {
    "ecom_events": {"not_null": ("event_time", "product_id", "user_id")},
    "dim_datetime": {
        "not_null": ("datetime_sk", "datetime_hour_utc"),
        "unique": ("datetime_sk", "datetime_hour_utc"),
    },
    "dim_products": {
        "not_null": ("product_sk", "product_id", "product_brand"),
        "unique": ("product_sk", "product_id"),
    },
    "dim_users": {"not_null": ("user_sk", "user_id"), "unique": ("user_sk", "user_id")},
    "fct_events": {
        "not_null": ("event_sk", "product_sk", "user_sk", "datetime_sk", "event_type", "event_at_utc"),
        "unique": ("event_sk",),
    },
}
PARENTS = {"product_sk": "dim_products", "user_sk": "dim_users", "datetime_sk": "dim_datetime"}

CLICKSTREAM = """
loads AS (
    SELECT
        CASE WHEN e.event_id % 17 <> 0 THEN date_trunc('second', e.ts) END AS event_time,
        CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
             WHEN 'signup' THEN NULL ELSE e.event_type END AS event_type,
        CASE WHEN e.event_id % 19 <> 0 THEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) END AS product_id,
        CAST(p.p_size AS DECIMAL(38, 9)) AS category_id,
        CASE WHEN e.event_id % 5 <> 0 THEN p.p_type END AS category_code,
        CASE WHEN e.event_id % 7 <> 0 THEN p.p_brand END AS brand,
        CASE WHEN e.event_id % 13 <> 0 THEN e.value END AS price,
        CASE WHEN e.event_id % 23 <> 0 THEN e.user_id END AS user_id,
        CASE WHEN e.event_id % 10 <> 0 THEN e.user_id || '-' || strftime(e.ts, '%Y-%m-%d') END AS user_session,
        e.event_id
    FROM events e LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
raw AS (
    SELECT * EXCLUDE (event_id) FROM loads
    UNION ALL
    SELECT * EXCLUDE (event_id) FROM loads WHERE event_id % 20 = 0
)"""

ORDER_LINES = """
raw AS (
    SELECT
        l.l_shipdate AS event_time,
        CASE l.l_returnflag WHEN 'R' THEN 'remove_from_cart' WHEN 'A' THEN 'cart' ELSE 'purchase' END AS event_type,
        l.l_partkey AS product_id,
        CAST(p.p_size AS DECIMAL(38, 9)) AS category_id,
        p.p_type AS category_code,
        p.p_brand AS brand,
        l.l_extendedprice AS price,
        o.o_custkey AS user_id,
        CAST(o.o_orderkey AS VARCHAR) AS user_session
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""


def time_text(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN ''"
        f" WHEN epoch_us({ts}) % 1000 = 0 THEN strftime({ts}, '.%g') ELSE strftime({ts}, '.%f') END || '+00'"
    )


def key(*parts: str) -> str:
    texts = [f"coalesce(CAST({part} AS VARCHAR), '{NULL_KEY_TOKEN}')" for part in parts]
    return f"md5({f" || '{KEY_SEPARATOR}' || ".join(texts)})"


def staged(raw: str = "raw", name: str = "stg") -> str:
    sk = key("r.user_session", time_text("r.event_time"), "r.event_type", "r.product_id", "r.user_id")
    return f"""
{name} AS (
    SELECT
        r.user_id, r.product_id, r.category_id,
        coalesce(r.user_session, '{UNKNOWN_SESSION}') AS user_session_id,
        r.event_time AS event_at_utc,
        coalesce(r.event_type, '{UNKNOWN_EVENT_TYPE}') AS event_type,
        coalesce(r.category_code, '{UNKNOWN_CATEGORY}') AS category_code,
        coalesce(r.brand, '{UNKNOWN_BRAND}') AS product_brand,
        coalesce(r.price, 0.0) AS event_price,
        {sk} AS event_sk
    FROM {raw} r
    WHERE r.user_id IS NOT NULL AND r.product_id IS NOT NULL AND r.event_time IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY r.user_session, r.event_time, r.event_type, r.product_id, r.user_id
        ORDER BY r.price NULLS FIRST, r.brand NULLS FIRST, r.category_code NULLS FIRST, r.category_id NULLS FIRST
    ) = 1
)"""


STG = staged()

HOURS = f"""
dim_datetime AS (
    SELECT
        h AS datetime_hour_utc,
        {key(time_text("h"))} AS datetime_sk,
        CAST(h AS DATE) AS date_utc,
        CAST(year(h) AS INTEGER) AS year_utc,
        CAST(month(h) AS INTEGER) AS month_utc,
        CAST(day(h) AS INTEGER) AS day_utc,
        CAST(hour(h) AS INTEGER) AS hour_utc,
        dayname(h) AS day_name_utc,
        strftime(h, '%a') AS day_name_short_utc,
        CAST(dayofweek(h) + 1 AS INTEGER) AS day_of_week_utc,
        CAST(dayofyear(h) AS INTEGER) AS day_of_year_utc,
        CAST(strftime(h, '%U') AS INTEGER) AS week_of_year_utc,
        CAST(quarter(h) AS INTEGER) AS quarter_of_year_utc,
        strftime(h, '%Y-%m') AS year_month_utc
    FROM (SELECT DISTINCT date_trunc('hour', event_at_utc) AS h FROM stg)
)"""

PRODUCTS = f"""
dim_products AS (
    SELECT product_id, {key("product_id")} AS product_sk, category_id, category_code, product_brand
    FROM stg
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_at_utc DESC, event_sk DESC) = 1
)"""

USERS = f"""
dim_users AS (SELECT DISTINCT user_id, {key("user_id")} AS user_sk FROM stg)"""


def fact(staged: str = "stg", name: str = "fct", known: bool = False) -> str:
    def only(condition: str) -> str:
        return f" WHERE {condition}" if known else ""

    return f"""
{name} AS (
    SELECT
        coalesce(p.product_sk, '{UNKNOWN_MEMBER}') AS product_sk,
        coalesce(u.user_sk, '{UNKNOWN_MEMBER}') AS user_sk,
        coalesce(d.datetime_sk, '{UNKNOWN_MEMBER}') AS datetime_sk,
        s.event_type, s.user_session_id, s.event_price, s.event_at_utc, s.event_sk
    FROM {staged} s
    LEFT JOIN (SELECT * FROM dim_products{only(R.KNOWN_PRODUCT)}) p ON p.product_id = s.product_id
    LEFT JOIN (SELECT * FROM dim_users{only(R.KNOWN_USER)}) u ON u.user_id = s.user_id
    LEFT JOIN (SELECT * FROM dim_datetime{only(R.KNOWN_HOUR)}) d
        ON d.datetime_hour_utc = date_trunc('hour', s.event_at_utc)
)"""


def sql(select: str, *ctes: str) -> str:
    return f"WITH {','.join(ctes)}\n{select}"


def star(raw: str, *more: str) -> tuple[str, ...]:
    return (raw, STG, HOURS, PRODUCTS, USERS, *more)


DATETIME_COLUMNS = "SELECT * REPLACE (CAST(date_utc AS VARCHAR) AS date_utc) FROM dim_datetime"
CATEGORY_AS_TEXT = "SELECT * REPLACE (CAST(category_id AS VARCHAR) AS category_id) FROM "
NATURAL_FACT = f"""
natural_fact AS (
    SELECT event_sk, {key("product_id")} AS product_sk, {key("user_id")} AS user_sk FROM stg
)"""


def sales(parts: str) -> str:
    return f"""
SELECT {parts}, count(*) AS n_purchases, CAST(sum(CAST(event_price AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM fct JOIN dim_datetime USING (datetime_sk) WHERE event_type = 'purchase' GROUP BY {parts}"""


FUNNEL = f"""
SELECT
    count(*) AS n_sessions,
    count(v) AS n_view,
    count(*) FILTER (c >= v) AS n_view_then_cart,
    count(*) FILTER (p >= c AND c >= v) AS n_view_cart_purchase,
    count(*) FILTER (p IS NOT NULL AND v IS NULL) AS n_purchase_without_view,
    CAST(sum(p - v) FILTER (p > v) AS DOUBLE) / count(*) FILTER (p > v) / 1e6 AS avg_seconds_view_to_purchase
FROM (
    SELECT
        min(epoch_us(event_at_utc)) FILTER (event_type = 'view') AS v,
        min(epoch_us(event_at_utc)) FILTER (event_type = 'cart') AS c,
        min(epoch_us(event_at_utc)) FILTER (event_type = 'purchase') AS p
    FROM fct WHERE user_session_id <> '{UNKNOWN_SESSION}' GROUP BY user_session_id
)"""

TOP_PRODUCTS = """
SELECT
    product_id, product_brand, category_code,
    count(*) FILTER (event_type = 'view') AS n_views,
    count(*) FILTER (event_type = 'cart') AS n_carts,
    count(*) FILTER (event_type = 'purchase') AS n_purchases,
    coalesce(CAST(sum(CAST(event_price AS DECIMAL(18, 2))) FILTER (event_type = 'purchase') AS DOUBLE), 0) AS revenue
FROM fct JOIN dim_products USING (product_sk)
GROUP BY ALL ORDER BY n_purchases DESC, product_id LIMIT 20"""

SURROGATE_KEYS = f"""
SELECT
    event_id,
    {time_text("ts")} AS micros_text,
    {time_text("date_trunc('millisecond', ts)")} AS millis_text,
    {time_text("date_trunc('second', ts)")} AS seconds_text,
    {key("event_id", time_text("ts"), "event_type")} AS event_key,
    {key("nullif(event_type, 'signup')", "user_id")} AS nullable_key
FROM events"""

# Events up to the mark keep what the first run staged; later ones are staged from both deliveries.
LOOKBACK = (
    f"""
again AS (
    SELECT * FROM raw
    UNION ALL
    SELECT * REPLACE (price - {R.PRICE_CUT} AS price) FROM raw WHERE event_time >= '{R.REDELIVERED_FROM}'
)""",
    staged("again", "stg_again"),
    f"""
mark AS (SELECT max(event_at_utc) - INTERVAL {R.LOOKBACK_DAYS} DAY AS t FROM stg),
stg_merged AS (
    SELECT * FROM stg WHERE event_at_utc <= (SELECT t FROM mark)
    UNION ALL
    SELECT * FROM stg_again WHERE event_at_utc > (SELECT t FROM mark)
)""",
)


def suite_sql(known: bool, events: str = "raw", fact: str = "fct") -> str:
    """All checks by hand; ``known`` restricts the dimensions as in the unknown-member queries."""
    tables = {"ecom_events": events, "fct_events": fact}
    limits = {"dim_products": R.KNOWN_PRODUCT, "dim_users": R.KNOWN_USER, "dim_datetime": R.KNOWN_HOUR}
    for name, condition in limits.items():
        tables[name] = f"(SELECT * FROM {name} WHERE {condition})" if known else name
    rows = []

    def add(table: str, column: str, check: str, failing: str) -> None:
        rows.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name,"
            f" (SELECT count(*) FROM {failing}) AS failures"
        )

    for table, checks in CHECKS.items():
        for c in checks["not_null"]:
            add(table, c, "not_null", f"{tables[table]} WHERE {c} IS NULL")
        for c in checks.get("unique", ()):
            repeated = f"(SELECT {c} FROM {tables[table]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            add(table, c, "unique", repeated)
    unaccepted = f"(SELECT DISTINCT event_type FROM {tables['fct_events']} WHERE event_type NOT IN {EVENT_TYPES})"
    add("fct_events", "event_type", "accepted_values", unaccepted)
    for c, parent in PARENTS.items():
        known_keys = f"(SELECT {c} FROM {tables[parent]})"
        add("fct_events", c, "relationships", f"{tables['fct_events']} WHERE {c} IS NOT NULL AND {c} NOT IN {known_keys}")
    return "\nUNION ALL\n".join(rows)


ORPHAN_KEYS = f"""
SELECT 'user_sk' AS column_name, user_sk AS from_field, count(*) AS n_records FROM natural_fact
WHERE user_sk NOT IN (SELECT user_sk FROM dim_users WHERE {R.KNOWN_USER}) GROUP BY user_sk
UNION ALL
SELECT 'product_sk', product_sk, count(*) FROM natural_fact
WHERE product_sk NOT IN (SELECT product_sk FROM dim_products WHERE {R.KNOWN_PRODUCT}) GROUP BY product_sk"""

NULL_ROWS = "\nUNION ALL\n".join(
    f"{CATEGORY_AS_TEXT.replace('SELECT *', f"SELECT '{c}' AS column_name, *")}raw WHERE {c} IS NULL"
    for c in ("event_time", "product_id", "user_id")
)

#: Days 1 and 25 of the fact stand there once more, without users; the checks see what comes from the day of the mark on.
INCREMENTAL = (
    f"""
fct_twice AS (
    SELECT * FROM fct
    UNION ALL
    SELECT * REPLACE (NULL AS user_sk) FROM fct WHERE day(event_at_utc) IN (1, 25)
),
mark AS (SELECT date_trunc('day', max(event_at_utc)) AS t FROM fct WHERE day(event_at_utc) <= {R.ARRIVALS[0]}),
raw_new AS (SELECT * FROM raw WHERE event_time >= (SELECT t FROM mark)),
fct_new AS (SELECT * FROM fct_twice WHERE event_at_utc >= (SELECT t FROM mark))""",
)

DIMENSIONS_TOGETHER = """
SELECT 'product' AS dimension, product_id, product_sk, product_brand, category_code, NULL::BIGINT AS user_id,
       NULL::VARCHAR AS user_sk, NULL::TIMESTAMP AS datetime_hour_utc, NULL::VARCHAR AS datetime_sk FROM dim_products
UNION ALL
SELECT 'user', NULL, NULL, NULL, NULL, user_id, user_sk, NULL, NULL FROM dim_users
UNION ALL
SELECT 'hour', NULL, NULL, NULL, NULL, NULL, NULL, datetime_hour_utc, datetime_sk FROM dim_datetime"""

FIRST_ARRIVAL = f"coalesce(day(event_time), 1) <= {R.ARRIVALS[0]}"
#: Quoting every field turns a missing text into an empty one.
FILLED = """
SELECT * REPLACE (CAST(category_id AS VARCHAR) AS category_id, coalesce(event_type, '') AS event_type,
    coalesce(category_code, '') AS category_code, coalesce(brand, '') AS brand,
    coalesce(user_session, '') AS user_session) FROM raw"""

ORACLE: dict[str, str] = {
    "stg_ecom_events": sql(CATEGORY_AS_TEXT + "stg", CLICKSTREAM, STG),
    "stg_order_lines": sql(CATEGORY_AS_TEXT + "stg", ORDER_LINES, STG),
    "surrogate_keys": SURROGATE_KEYS,
    "dim_datetime": sql(DATETIME_COLUMNS, CLICKSTREAM, STG, HOURS),
    "dim_datetime_order_lines": sql(DATETIME_COLUMNS, ORDER_LINES, STG, HOURS),
    "dim_products": sql(CATEGORY_AS_TEXT + "dim_products", ORDER_LINES, STG, PRODUCTS),
    "dim_products_clickstream": sql(CATEGORY_AS_TEXT + "dim_products", CLICKSTREAM, STG, PRODUCTS),
    "dim_users": sql("SELECT * FROM dim_users", CLICKSTREAM, STG, USERS),
    "fct_events": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact())),
    "fct_order_lines": sql("SELECT * FROM fct", *star(ORDER_LINES, fact())),
    "fct_events_unknown_member": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact(known=True))),
    "fct_events_large_dims": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact(known=True))),
    "fct_events_incremental": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact())),
    "fct_events_merge_lookback": sql("SELECT * FROM fct", *star(CLICKSTREAM, *LOOKBACK, fact("stg_merged"))),
    "high_water_mark": sql(
        "SELECT newest AS newest_event_at_utc, count(*) AS n_events_of_last_day"
        " FROM raw, (SELECT max(event_at_utc) AS newest FROM stg) WHERE event_time > newest - INTERVAL 1 DAY"
        " GROUP BY newest",
        CLICKSTREAM,
        STG,
    ),
    "raw_append_history": sql(CATEGORY_AS_TEXT + "raw", CLICKSTREAM),
    "ingest_months": sql(
        CATEGORY_AS_TEXT.replace("SELECT *", "SELECT strftime(event_time, '%Y-%m') AS month, *") + "raw", ORDER_LINES
    ),
    "stream_new_files": sql(CATEGORY_AS_TEXT + "stg", CLICKSTREAM, STG),
    "dq_not_null": sql(NULL_ROWS, CLICKSTREAM),
    "dq_unique": sql(
        "SELECT event_sk AS unique_field, count(*) AS n_records FROM (SELECT "
        + key("user_session", time_text("event_time"), "event_type", "product_id", "user_id")
        + " AS event_sk FROM raw WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND event_time IS NOT NULL)"
        " GROUP BY event_sk HAVING count(*) > 1",
        CLICKSTREAM,
    ),
    "dq_accepted_values": sql(
        f"SELECT event_type AS value_field, count(*) AS n_records FROM stg WHERE event_type NOT IN {EVENT_TYPES}"
        " GROUP BY event_type",
        CLICKSTREAM,
        STG,
    ),
    "dq_relationships": sql(ORPHAN_KEYS, CLICKSTREAM, STG, PRODUCTS, USERS, NATURAL_FACT),
    "orphan_events": sql(
        "SELECT * FROM natural_fact WHERE product_sk NOT IN"
        f" (SELECT product_sk FROM dim_products WHERE {R.KNOWN_PRODUCT})",
        CLICKSTREAM,
        STG,
        PRODUCTS,
        NATURAL_FACT,
    ),
    "dq_suite": sql(suite_sql(known=True), *star(CLICKSTREAM, fact(known=True))),
    "run_pipeline": sql(suite_sql(known=False), *star(CLICKSTREAM, fact())),
    "fct_events_mixed_ingest": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact())),
    "fct_events_late_rows": sql(
        f"SELECT * FROM fct WHERE day(event_at_utc) <= {R.ARRIVALS[0]} OR day(event_at_utc) > {R.ARRIVALS[1]}",
        *star(CLICKSTREAM, fact()),
    ),
    "dims_incremental": sql(DIMENSIONS_TOGETHER, *star(ORDER_LINES)),
    "landed_month_skipped": sql(
        f"{CATEGORY_AS_TEXT}raw WHERE {FIRST_ARRIVAL}"
        f" UNION ALL {CATEGORY_AS_TEXT}raw WHERE {FIRST_ARRIVAL}",
        CLICKSTREAM,
    ),
    "stream_fact": sql(
        f"SELECT * FROM fct WHERE day(event_at_utc) <= {R.ARRIVALS[1]}", *star(CLICKSTREAM, fact())
    ),
    "dq_suite_incremental": sql(
        suite_sql(known=False, events="raw_new", fact="fct_new"), *star(CLICKSTREAM, fact(), *INCREMENTAL)
    ),
    "csv_quoted_fields": sql(FILLED, CLICKSTREAM),
    "fct_events_merge_clustered": sql("SELECT * FROM fct", *star(CLICKSTREAM, *LOOKBACK, fact("stg_merged"))),
    # Of the second part's events, the foreign writer left out those without a time, which no table has anyway.
    "fct_events_foreign_files": sql("SELECT * FROM fct", *star(CLICKSTREAM, fact())),
    "sales_by_hour_merged": sql(sales("hour_utc"), *star(CLICKSTREAM, *LOOKBACK, fact("stg_merged"))),
    "top_products_of_days": sql(TOP_PRODUCTS, *star(CLICKSTREAM, fact())),
    "purchase_funnel_sessions": sql(FUNNEL, *star(CLICKSTREAM, fact())),
    "top_products": sql(TOP_PRODUCTS, *star(ORDER_LINES, fact())),
    "purchase_funnel": sql(FUNNEL, *star(CLICKSTREAM, fact())),
    "sales_by_hour": sql(sales("hour_utc"), *star(CLICKSTREAM, fact())),
    "sales_by_weekday": sql(sales("day_of_week_utc, day_name_utc"), *star(CLICKSTREAM, fact())),
    "sales_by_weekday_order_lines": sql(sales("day_of_week_utc, day_name_utc"), *star(ORDER_LINES, fact())),
}
