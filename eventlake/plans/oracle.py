"""SQL twins of the registered queries, written on their own for DuckDB."""

from __future__ import annotations

from eventlake.sources import samples

EV = """
ev AS (
  SELECT event_id, event_type, user_id,
    CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS product_id,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS total_amount,
    ts AS event_timestamp, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
  FROM events)
"""
ENR = EV + """,
enr AS (
  SELECT ev.*, p_name AS product_name, p_type AS category, p_brand AS brand, p_retailprice AS price
  FROM ev LEFT JOIN part ON p_partkey = product_id)
"""
BUY, VIEW, CART, FIND = (
    f"count(*) FILTER (event_type = '{kind}')" for kind in ("purchase", "view", "click", "signup")
)
REVENUE = "CAST(coalesce(sum(total_amount), 0) AS DOUBLE)"

DAILY = f"""
daily AS (
  SELECT event_date AS report_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
    {REVENUE} AS total_revenue, {BUY} AS total_orders, {VIEW} AS views, {CART} AS cart_adds
  FROM ev GROUP BY 1),
summary AS (
  SELECT *, CASE WHEN total_orders = 0 THEN 0.0 ELSE total_revenue / total_orders END AS avg_order_value,
    CASE WHEN unique_users = 0 THEN 0.0 ELSE CAST(total_orders AS DOUBLE) / unique_users END AS conversion_rate
  FROM daily)
"""


def _windows(source: str, size: str, key: str = "") -> str:
    """Window metrics over ev or enr."""
    bucket = f"time_bucket(INTERVAL '{size}', event_timestamp)"
    by = f", {key}" if key else ""
    return f"""
      SELECT {bucket} AS window_start, {bucket} + INTERVAL '{size}' AS window_end{by},
        count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
        count(DISTINCT product_id) AS unique_products,
        CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
        {BUY} AS purchase_count, {VIEW} AS view_count, {CART} AS cart_count, {FIND} AS search_count
      FROM {source} GROUP BY ALL"""


METRIC_COLUMNS = """window_start, window_end, total_events, unique_users, total_revenue,
  purchase_count, view_count, cart_count, search_count,
  CASE WHEN purchase_count > 0 THEN total_revenue / purchase_count END AS avg_order_value"""
CATEGORY_COLUMNS = """window_start, window_end, category, total_events AS event_count,
  total_revenue AS revenue, unique_products"""


def _counts(size: str, by: str = "") -> str:
    bucket = f"time_bucket(INTERVAL '{size}', event_timestamp)"
    return f"""
      SELECT {bucket} AS window_start, {bucket} + INTERVAL '{size}' AS window_end{by}, count(*) AS event_count
      FROM ev GROUP BY ALL"""


def _threshold(source: str, high: int, low: int, mean: float, sd: float, where: str = "") -> str:
    return f"""
      SELECT window_start, window_end, event_count, CAST({mean} AS DOUBLE) AS avg_count,
        CAST({sd} AS DOUBLE) AS stddev_count,
        (event_count - CAST({mean} AS DOUBLE)) / CAST({sd} AS DOUBLE) AS z_score,
        CASE WHEN event_count > {high} THEN 'High Traffic Spike' ELSE 'Traffic Drop' END AS anomaly_type,
        CASE WHEN event_count > {2 * high} THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
        window_end AS detection_time
      FROM {source} WHERE (event_count > {high} OR event_count < {low}) {where}"""


HOURLY_LIMITS = (25, 6, 14.0, 4.0)
HOURS = f"hours AS ({_counts('1 hour')})"
CLOSED = "AND window_end <= (SELECT max(ts) FROM events) - INTERVAL '2 minutes'"
STREAMED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'"

ROLLING = f"""
{HOURS},
sums AS (
  SELECT *, count(event_count) OVER w AS history,
    CAST(sum(event_count) OVER w AS DOUBLE) AS total,
    CAST(sum(event_count * event_count) OVER w AS DOUBLE) AS squares
  FROM hours
  WINDOW w AS (ORDER BY window_start RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND INTERVAL '1 second' PRECEDING)),
stats AS (
  SELECT window_start, window_end, event_count, history,
    CASE WHEN history > 0 THEN total / history END AS avg_count,
    CASE WHEN history > 1 THEN
      sqrt((history * squares - total * total) / (CAST(history AS DOUBLE) * (history - 1))) END AS stddev_count
  FROM sums)
"""
ROLLING_ALERTS = """
SELECT window_start, window_end, event_count, avg_count, stddev_count,
  CASE WHEN stddev_count <> 0 THEN (event_count - avg_count) / stddev_count END AS z_score,
  CASE WHEN event_count > avg_count + 2 * stddev_count THEN 'High Traffic Spike'
    ELSE 'Traffic Drop' END AS anomaly_type,
  CASE WHEN abs(event_count - avg_count) > 4 * stddev_count THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  window_end AS detection_time
FROM stats
WHERE history >= 10 AND (event_count > avg_count + 2 * stddev_count OR event_count < avg_count - 2 * stddev_count)
"""

COHORT = """
active AS (SELECT DISTINCT user_id, event_date FROM {source}),
first AS (
  SELECT user_id, min(event_date) AS first_visit_date,
    CAST(date_trunc('week', min(event_date)) AS DATE) AS cohort_week
  FROM active GROUP BY 1),
weeks AS (
  SELECT user_id, CAST(date_trunc('week', event_date) AS DATE) AS activity_week, min(event_date) AS first_day
  FROM active GROUP BY ALL),
joined AS (
  SELECT weeks.*, cohort_week,
    CAST(floor(date_diff('day', cohort_week, activity_week) / 7) AS INTEGER) AS period_week
  FROM weeks JOIN first USING (user_id)),
sizes AS (SELECT cohort_week, count(*) AS cohort_size FROM first GROUP BY 1),
retention AS (
  SELECT cohort_week, cohort_size, period_week, count(DISTINCT user_id) AS retained_users,
    CAST(count(DISTINCT user_id) AS DOUBLE) / cohort_size AS retention_rate
  FROM joined JOIN sizes USING (cohort_week) GROUP BY 1, 2, 3)
"""
EVENT_COHORT = EV + "," + COHORT.format(source="ev WHERE event_type IN ('view', 'purchase')")


def _has(word: str) -> str:
    return f"contains(lower(text), '{word}')"


def _count_words(words: tuple[str, ...]) -> str:
    return " + ".join(f"CAST({_has(w)} AS INTEGER)" for w in words)


LEX = samples.LEXICON
DOCS = f"""
docs AS (
  SELECT doc_id AS review_id, source AS product_id, CAST(1 + doc_id % 5 AS INTEGER) AS rating, text,
    length(text) AS text_length, doc_id % 4 = 0 AS has_images,
    DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS created_date,
    {_count_words(LEX.positive)} AS p, {_count_words(LEX.negative)} AS n
  FROM documents),
tagged AS (
  SELECT *, CASE WHEN p + n = 0 THEN 0.0 ELSE CAST(CAST(CAST(p - n AS DOUBLE) / (p + n) AS FLOAT) AS DOUBLE)
    END AS sentiment
  FROM docs)
"""
WORD_LIST = "concat_ws(',', " + ", ".join(f"CASE WHEN {_has(w)} THEN '{w}' END" for w in LEX.words) + ")"
ASPECT_HIT = {a: "(" + " OR ".join(_has(w) for w in words) + ")" for a, words in samples.ASPECTS.items()}
ASPECT_LIST = (
    "concat_ws(',', " + ", ".join(f"CASE WHEN {hit} THEN '{a}' END" for a, hit in ASPECT_HIT.items()) + ")"
)
WORD_ROWS = " UNION ALL ".join(
    f"SELECT created_date, product_id, rating, '{w}' AS keyword, "
    f"'{'positive' if w in LEX.positive else 'negative'}' AS keyword_type FROM tagged WHERE {_has(w)}"
    for w in LEX.words
)
ASPECT_ROWS = " UNION ALL ".join(
    f"SELECT created_date, sentiment, '{a}' AS aspect FROM tagged WHERE {hit}" for a, hit in ASPECT_HIT.items()
)


def _percent_text(part: str, whole: str, digits: int) -> str:
    """100 * part / whole with halves rounded up, in whole-number arithmetic."""
    scale = 10**digits
    unit = f"{1 / scale:.{digits}f}"
    whole_number = f"sign({part}) * ((abs({part}) * {200 * scale} + {whole}) // (2 * {whole}))"
    return f"CAST(CAST({whole_number} AS DECIMAL(15,0)) * CAST({unit} AS DECIMAL(3,{digits})) AS VARCHAR) || '%'"


def _half_up(part: str, whole: str, digits: int) -> str:
    scale = 10**digits
    return f"CAST(sign({part}) * ((abs({part}) * {200 * scale} + {whole}) // (2 * {whole})) AS DOUBLE) / {scale}"


REQUIRED = ("event_id", "event_type", "user_id", "product_id", "event_timestamp")
PROFILE = ENR + ",\nprofile AS (SELECT event_date, count(*) AS n, " + ", ".join(
    f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in REQUIRED
) + f""", min(price) AS min_price,
    count(*) FILTER (event_type NOT IN ('signup', 'view', 'click', 'purchase')) AS invalid_types,
    count(*) FILTER (CAST(event_timestamp AS DATE) <> event_date) AS out_of_range,
    {BUY} AS purchases,
    count(*) FILTER (event_type = 'purchase' AND total_amount IS NULL) AS purchases_without_amount,
    count(*) - count(DISTINCT event_id) - CAST(count(*) FILTER (event_id IS NULL) > 0 AS INTEGER) AS duplicates
  FROM enr WHERE event_date IS NOT NULL GROUP BY 1)
"""


def _check_rows() -> str:
    def row(name, family, status, expected, actual, details, where):
        return f"""
          SELECT check_date, 'events' AS table_name, '{name}' AS check_name, '{family}' AS check_type,
            {status} AS status, '{expected}' AS expected_value, CAST({actual} AS VARCHAR) AS actual_value,
            {details} AS details
          FROM judged WHERE {where}"""

    def graded(part, first, second):
        rate = f"100.0 * {part} / n"
        return f"CASE WHEN {rate} < {first} THEN 'PASS' WHEN {rate} < {second} THEN 'WARN' ELSE 'FAIL' END"

    rows = [row(
        "has_data", "completeness", "CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END", "> 0", "n",
        "CASE WHEN n > 0 THEN 'Found ' || n || ' records' ELSE 'No data found for ' || check_date END", "true",
    )]
    rows += [row(
        f"{c}_null_rate", "completeness", graded(f"null_{c}", 1, 5), "< 1%",
        _percent_text(f"null_{c}", "n", 2), f"null_{c} || ' nulls out of ' || n", "n > 0",
    ) for c in REQUIRED]
    rows += [
        row("price_positive", "accuracy", "CASE WHEN min_price >= 0 THEN 'PASS' ELSE 'FAIL' END", ">= 0",
            "min_price", "'Min price: ' || min_price", "min_price IS NOT NULL"),
        row("valid_event_types", "accuracy", "CASE WHEN invalid_types = 0 THEN 'PASS' ELSE 'FAIL' END",
            "0 invalid", "invalid_types", "invalid_types || ' records with invalid event_type'", "n > 0"),
        row("timestamp_in_range", "accuracy", "CASE WHEN out_of_range = 0 THEN 'PASS' ELSE 'WARN' END",
            "0 out of range", "out_of_range", "out_of_range || ' records outside target date'", "n > 0"),
        row("duplicate_events", "consistency", graded("duplicates", 0.1, 1), "< 0.1%",
            _percent_text("duplicates", "n", 2), "duplicates || ' duplicate event_ids'", "n > 0"),
        row("purchase_has_amount", "consistency",
            "CASE WHEN purchases_without_amount = 0 THEN 'PASS' ELSE 'FAIL' END", "0 missing",
            "purchases_without_amount", "purchases_without_amount || '/' || purchases || ' purchases missing amount'",
            "purchases > 0"),
        row("volume_change", "freshness",
            "CASE WHEN abs(100.0 * (n - previous_n) / previous_n) < 50 THEN 'PASS' ELSE 'WARN' END",
            "< 50% change", _percent_text("(n - previous_n)", "previous_n", 1),
            "'Today: ' || n || ', Yesterday: ' || previous_n", "previous_n > 0"),
    ]
    return " UNION ALL ".join(rows)


CHECKS = PROFILE + f""",
days AS (
  SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL '1 day')) AS DATE) AS check_date
  FROM profile),
judged AS (
  SELECT check_date, profile.* REPLACE (coalesce(profile.n, 0) AS n), before.n AS previous_n
  FROM days LEFT JOIN profile ON profile.event_date = check_date
    LEFT JOIN profile AS before ON before.event_date = check_date - 1),
checks AS ({_check_rows()})
"""

# The faults that the samples carry: times lost, users lost, amounts lost, ids repeated, late arrivals.
FAULTY = ENR.replace("enr AS (", "clean AS (") + """,
enr AS (
  SELECT * REPLACE (
      CASE WHEN event_id % 73 = 0 THEN event_id - 1 ELSE event_id END AS event_id,
      CASE WHEN event_id % 79 <> 0 THEN user_id END AS user_id,
      CASE WHEN event_id % 83 <> 0 THEN event_timestamp END AS event_timestamp,
      CASE WHEN event_id % 71 <> 0 THEN total_amount END AS total_amount,
      event_date + CAST(event_id % 83 = 0 AND event_id % 67 = 0 AS INTEGER) AS event_date),
    event_date + CAST(event_id % 67 = 0 AS INTEGER) AS arrival_date
  FROM clean)
"""
FAULTY_CHECKS = CHECKS.replace(ENR, FAULTY).replace(
    "CAST(event_timestamp AS DATE) <> event_date", "CAST(event_timestamp AS DATE) <> arrival_date"
)

# Products 3, 32, 61, ... are not listed.
ORPHAN = "product_id IS NOT NULL AND (product_id % 29 = 3 OR product_id NOT IN (SELECT p_partkey FROM part))"
FAULTY_CHECKS += f""",
orphaned AS (
  SELECT event_date AS check_date, count(*) AS n, count(*) FILTER ({ORPHAN}) AS orphans,
    count(DISTINCT CASE WHEN {ORPHAN} THEN product_id END) AS unknown
  FROM enr WHERE event_date IS NOT NULL GROUP BY 1),
all_checks AS (
  SELECT * FROM checks UNION ALL
  SELECT check_date, 'events', 'known_products', 'consistency',
    CASE WHEN 100.0 * orphans / n < 0.1 THEN 'PASS' WHEN 100.0 * orphans / n < 1 THEN 'WARN' ELSE 'FAIL' END, '< 0.1%',
    {_percent_text("orphans", "n", 2)}, orphans || ' events of ' || unknown || ' unknown products'
  FROM orphaned)
"""

SESS = """
sess AS (
  SELECT o_orderkey AS k, 'sess_' || o_orderkey AS session_id, 'u_' || o_custkey AS user_id,
    o_orderdate AS started_at, o_totalprice, o_orderkey % 1000 AS seen, o_orderkey % 999 AS bagged,
    o_orderkey % 4 = 0 AS searched, o_orderpriority IN ('1-URGENT', '2-HIGH') AS carted,
    o_orderstatus = 'F' AS bought
  FROM orders),
summed AS (
  SELECT *, 1 + CAST(searched AS INTEGER) + CAST(carted AS INTEGER) + CAST(bought AS INTEGER) AS total FROM sess)
"""
SUMMARY = """CAST(total AS INTEGER) AS total_events,
  CAST(1 + CAST((carted OR bought) AND seen <> bagged AS INTEGER) AS INTEGER) AS unique_products_viewed,
  CAST(searched AS INTEGER) AS searches_count, 1 AS views_count,
  CAST(carted AS INTEGER) AS add_cart_count, CAST(bought AS INTEGER) AS purchase_count,
  bought AS converted, total = 1 AS bounce"""


def _session_event(index: int, kind: str, page: str, where: str, product: str = "", search: bool = False,
                   deal: bool = False) -> str:
    some = bool(product)
    return f"""
      SELECT session_id, user_id, {index} AS event_index, '{kind}' AS event_type,
        started_at + INTERVAL '{index} seconds' AS event_timestamp, '{page}' AS page,
        CAST(k % 50 AS INTEGER) AS duration_on_page,
        {f"'pd_' || {product}" if some else "CAST(NULL AS VARCHAR)"} AS product_id,
        {f"'category ' || {product} % 5" if some else "CAST(NULL AS VARCHAR)"} AS product_category,
        {f"CAST({product} * 100 AS INTEGER)" if some else "CAST(NULL AS INTEGER)"} AS product_price,
        {"'query ' || k % 7" if search else "CAST(NULL AS VARCHAR)"} AS search_query,
        {"CAST(k % 90 AS INTEGER)" if search else "CAST(NULL AS INTEGER)"} AS search_result_count,
        {"'tx_' || k" if deal else "CAST(NULL AS VARCHAR)"} AS transaction_id,
        {"CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS INTEGER)" if deal else "CAST(NULL AS INTEGER)"}
          AS transaction_amount,
        CAST(started_at AS DATE) AS event_date
      FROM summed WHERE {where}"""


SESSION_EVENTS = " UNION ALL ".join([
    _session_event(0, "search", "search_results", "searched", search=True),
    _session_event(1, "view", "product_detail", "true", product="seen"),
    _session_event(2, "add_cart", "cart", "carted", product="bagged"),
    _session_event(3, "purchase", "checkout", "bought", product="bagged", deal=True),
])
SESSIONS = f"""
SELECT session_id, user_id, started_at, started_at + to_seconds(60 + k % 600) AS ended_at,
  CAST(60 + k % 600 AS INTEGER) AS duration_seconds, CAST(total AS INTEGER) AS event_count,
  CASE k % 3 WHEN 0 THEN 'tablet' WHEN 1 THEN 'mobile' ELSE 'desktop' END AS device_type,
  'os ' || k % 4 AS device_os, 'model ' || k % 5 AS device_model, 'direct' AS referrer,
  CASE WHEN k % 5 = 0 THEN 'newsletter' END AS utm_source, CASE WHEN k % 5 = 0 THEN 'email' END AS utm_medium,
  'region ' || k % 8 AS region, 'city ' || k % 80 AS city, k % 6 = 0 AS is_first_visit,
  {SUMMARY}, CAST(started_at AS DATE) AS session_date
FROM summed
"""

INGESTED_EVENTS = """
msg AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, event_type = 'purchase' AS bought
  FROM events),
ingested AS (
  SELECT 'ev_' || event_id AS event_id, event_type, 'u_' || user_id AS user_id,
    'pd_' || lpad(CAST(k AS VARCHAR), 6, '0') AS product_id, CAST(NULL AS VARCHAR) AS product_name,
    'category ' || k % 5 AS category, CAST(NULL AS VARCHAR) AS brand, CAST(k * 1000 AS INTEGER) AS price,
    ts AS event_timestamp, CAST(NULL AS VARCHAR) AS session_id,
    CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type, 'os ' || k % 3 AS device_os,
    '1.0' AS device_app_version, 'direct' AS referrer,
    CASE WHEN k % 3 = 0 THEN 'camp_' || k % 4 END AS campaign_id,
    CASE WHEN k % 3 = 0 THEN 'campaign ' || k % 4 END AS campaign_name,
    CASE WHEN bought THEN CAST(1 + k % 3 AS INTEGER) END AS quantity,
    CASE WHEN bought THEN CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INTEGER) END AS total_amount,
    CASE WHEN bought THEN 'card' END AS payment_method,
    CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
  FROM msg)
"""
INGESTED_REVIEWS = f"""
SELECT 'rv_' || doc_id AS review_id, source AS product_id, 'u_' || doc_id % 97 AS user_id,
  CAST(1 + doc_id % 5 AS INTEGER) AS rating, text AS review_text, CAST(length(text) AS INTEGER) AS text_length,
  CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 0 END AS image_count, doc_id % 4 = 0 AS has_images,
  CAST(doc_id % 11 AS INTEGER) AS helpful_count, doc_id % 2 = 0 AS verified_purchase,
  CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) AS created_at,
  DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS created_date, {WORD_LIST} AS sentiment_keywords
FROM documents
"""

VOCAB = ", ".join(f"'{w}'" for w in samples.VOCABULARY)
SEARCH = EV + f""",
named AS (SELECT ev.*, coalesce(p_name, '') AS name FROM ev LEFT JOIN part ON p_partkey = product_id),
spelt AS (
  SELECT *, CASE event_id % 30
    WHEN 0 THEN name || right(name, 1)
    WHEN 10 THEN left(name, 1) || substring(name, 3)
    WHEN 20 THEN left(name, length(name) - 2) || right(name, 1) || substring(name, length(name) - 1, 1)
    ELSE name END AS written
  FROM named),
asked AS (
  SELECT *, CASE event_id % 5 WHEN 1 THEN 'Best ' || written WHEN 2 THEN 'gift for ' || written
      WHEN 3 THEN written || '  free shipping' WHEN 4 THEN written || ' vs old rod' ELSE written END AS query,
    CASE event_id % 5 WHEN 1 THEN 'recommendation' WHEN 2 THEN 'natural' WHEN 3 THEN 'specific'
      WHEN 4 THEN 'comparison' ELSE 'structured' END AS pattern_type,
    event_id % 10 < 7 AS clicked
  FROM spelt),
split AS (
  SELECT query, string_split(regexp_replace(trim(lower(query)), '\\s+', ' ', 'g'), ' ') AS words
  FROM (SELECT DISTINCT query FROM asked)),
word AS (SELECT query, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM split),
term AS (SELECT t, unnest(generate_series(1, length(t))) AS i FROM (SELECT unnest([{VOCAB}]) AS t)),
spelling AS (
  SELECT left(t, i - 1) || substring(t, i + 1) AS w, t FROM term
  UNION ALL SELECT left(t, i) || substring(t, i), t FROM term
  UNION ALL SELECT left(t, i - 1) || substring(t, i + 1, 1) || substring(t, i, 1) || substring(t, i + 2), t FROM term),
nearest AS (SELECT w, min(t) AS term FROM spelling GROUP BY w),
fixed AS (
  SELECT query, string_agg(
    CASE WHEN length(word.w) >= 3 AND word.w NOT IN ({VOCAB}) THEN coalesce(term, word.w) ELSE word.w END,
    ' ' ORDER BY place) AS query_norm
  FROM word LEFT JOIN nearest ON nearest.w = word.w GROUP BY query),
searches AS (
  SELECT 'sq_' || event_id AS search_id, 'u_' || user_id AS user_id, query, query_norm,
    CASE WHEN regexp_matches(query_norm, 'gift') THEN 'natural'
      WHEN regexp_matches(query_norm, ' vs |review') THEN 'comparison'
      WHEN regexp_matches(query_norm, 'sale|free shipping') THEN 'specific'
      WHEN regexp_matches(query_norm, 'best |top ') THEN 'recommendation' ELSE 'structured' END AS pattern,
    pattern_type, event_timestamp AS searched_at, CAST(product_id * 10 AS INTEGER) AS result_count, clicked,
    CASE WHEN clicked AND product_id > 0 THEN CAST(1 + event_id % 10 AS INTEGER) END AS clicked_position,
    'sess_' || event_id % 500 AS session_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS filter_count,
    event_date AS search_date
  FROM asked JOIN fixed USING (query))
"""

LINES = """
li AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, l_linestatus AS category, l_shipdate AS event_timestamp,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price
  FROM lineitem),
layouts AS (SELECT unnest(['events_unsorted', 'events_sorted_time', 'events_sorted_product']) AS table_name)
"""


def _layout(where: str = "true", by: str = "") -> str:
    return f"""WITH {LINES}
      SELECT * FROM (SELECT {by} count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM li WHERE {where}
      {"GROUP BY category" if by else ""}), layouts"""


IN_MARCH = "event_timestamp BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-31'"
IN_SPAN = "event_timestamp BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-30'"

PRODUCT_DAYS = ENR + f""",
pd AS (
  SELECT event_date AS report_date, product_id, product_name, category, count(*) AS events, {VIEW} AS views,
    {CART} AS cart_adds, {BUY} AS purchases, coalesce(sum(total_amount), 0) AS revenue
  FROM enr GROUP BY ALL)
"""
STREAM_METRICS = _windows("ingested", "5 minutes")


def _followed(source: str) -> str:
    return f"""
      SELECT v.user_id, v.product_id, v.event_id AS first_id, p.event_id AS then_id, v.event_timestamp AS first_at,
        p.event_timestamp AS then_at, epoch_us(p.event_timestamp) - epoch_us(v.event_timestamp) AS micros_between
      FROM {source} v JOIN {source} p ON v.user_id = p.user_id AND v.product_id = p.product_id
        AND v.event_type = 'view' AND p.event_type = 'purchase'
        AND p.event_timestamp BETWEEN v.event_timestamp AND v.event_timestamp + INTERVAL '7 days'"""


def _visits(source: str, revenue: str) -> str:
    return f"""
      marked AS (
        SELECT *, CASE WHEN event_timestamp < lag(event_timestamp) OVER w + INTERVAL '12 hours' THEN 0 ELSE 1 END AS starts
        FROM {source} WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)),
      visits AS (
        SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS visit FROM marked)
      SELECT user_id, min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL '12 hours' AS session_end,
        count(*) AS event_count, {VIEW} AS view_count, {CART} AS cart_count, {BUY} AS purchase_count, {revenue} AS revenue
      FROM visits GROUP BY user_id, visit"""


# Each distinct word with the nearest word of the product names.
REPAIRS = """
terms AS (
  SELECT term, count(*) AS weight FROM (SELECT unnest(regexp_split_to_array(lower(p_name), '[^\\pL\\pN]+')) AS term FROM part)
  WHERE term <> '' GROUP BY 1),
asked_words AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(query), '\\s+')) AS word FROM (SELECT DISTINCT query FROM asked)),
repairs AS (
  SELECT word, term, CAST(levenshtein(word, term) AS INTEGER) AS distance FROM asked_words, terms
  WHERE word <> '' AND levenshtein(word, term) <= CASE WHEN length(word) < 3 THEN 0 WHEN length(word) < 6 THEN 1 ELSE 2 END
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY levenshtein(word, term), weight DESC, term) = 1)
"""

SQL = {
    "ingest_events": f"WITH {INGESTED_EVENTS} SELECT * FROM ingested",
    "ingest_sessions": f"WITH {SESS} {SESSIONS}",
    "ingest_session_events": f"WITH {SESS} {SESSION_EVENTS}",
    "ingest_reviews": INGESTED_REVIEWS,
    "ingest_searches": f"WITH {SEARCH} SELECT * FROM searches",
    "daily_summary": f"WITH {EV}, {DAILY} SELECT * FROM summary",
    "hourly_metrics": f"""WITH {EV}
      SELECT event_date AS report_date, event_hour AS hour, count(*) AS events, {REVENUE} AS revenue,
        {BUY} AS orders, count(DISTINCT user_id) AS unique_users
      FROM ev GROUP BY ALL""",
    "category_daily": f"""WITH {PRODUCT_DAYS},
      ranked AS (
        SELECT report_date, category, product_id FROM pd WHERE product_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY report_date, category
          ORDER BY revenue DESC, events DESC, product_id) = 1)
      SELECT report_date, category, CAST(sum(events) AS BIGINT) AS events,
        CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(purchases) AS BIGINT) AS orders,
        count(DISTINCT pd.product_id) AS unique_products, any_value(ranked.product_id) AS top_product_id
      FROM pd LEFT JOIN ranked USING (report_date, category) GROUP BY ALL""",
    "product_daily": f"""WITH {PRODUCT_DAYS}
      SELECT report_date, product_id, product_name, category, views, cart_adds, purchases,
        CAST(revenue AS DOUBLE) AS revenue, {_half_up("purchases", "views", 2)} AS conversion_rate
      FROM pd WHERE views > 0""",
    "repurchase_rate": f"""WITH {EV},
      buyers AS (
        SELECT user_id, count(DISTINCT event_date) AS days FROM ev
        WHERE event_type = 'purchase' AND user_id IS NOT NULL GROUP BY 1)
      SELECT count(*) AS purchasers, count(*) FILTER (days > 1) AS repeat_purchasers,
        CAST(count(*) FILTER (days > 1) AS DOUBLE) / count(*) AS repurchase_rate FROM buyers""",
    "volume_change": f"""WITH {EV}, n AS (SELECT event_date AS d, count(*) AS n FROM ev GROUP BY 1)
      SELECT a.d AS report_date, a.n AS events, b.n AS previous_events,
        {_half_up("(a.n - b.n)", "b.n", 1)} AS change_pct
      FROM n a LEFT JOIN n b ON b.d = a.d - 1""",
    "hourly_moving_average": f"""WITH {ENR},
      h AS (SELECT category, date_trunc('hour', event_timestamp) AS hour_start, count(*) AS events
        FROM enr GROUP BY ALL)
      SELECT *, CAST(sum(events) OVER (PARTITION BY category ORDER BY hour_start
        RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) / 3 AS moving_avg FROM h""",
    "event_product_join": f"""WITH {ENR}
      SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM enr""",
    "event_product_join_salted": f"""WITH {ENR}
      SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM enr""",
    "event_product_join_bucketed": f"""WITH {ENR}
      SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM enr""",
    "revenue_rollup": f"""WITH {EV},
      counted AS (SELECT product_id, count(*) AS events, {BUY} AS purchases, coalesce(sum(total_amount), 0) AS revenue
        FROM ev GROUP BY 1),
      listed AS (SELECT p_partkey AS product_id, p_type AS category, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand
        FROM part WHERE p_partkey % 29 <> 3)
      SELECT category, brand, GROUPING_ID(category, brand) AS level, CAST(sum(events) AS BIGINT) AS events,
        CAST(sum(purchases) AS BIGINT) AS purchases, CAST(sum(revenue) AS DOUBLE) AS revenue
      FROM counted LEFT JOIN listed USING (product_id) GROUP BY ROLLUP (category, brand)""",
    "view_to_purchase": f"WITH {EV} {_followed('ev')}",
    "purchase_last_view": f"""WITH {EV},
      views AS (SELECT user_id, event_timestamp AS viewed_at, max(event_id) AS view_id, arg_max(product_id, event_id) AS viewed_product_id
        FROM ev WHERE event_type = 'view' GROUP BY ALL),
      bought AS (SELECT * FROM ev WHERE event_type = 'purchase')
      SELECT event_id, bought.user_id, product_id, event_timestamp, view_id, viewed_product_id, viewed_at
      FROM bought ASOF LEFT JOIN views ON bought.user_id = views.user_id AND bought.event_timestamp >= views.viewed_at""",
    "event_campaigns": f"""WITH {EV},
      begun AS (SELECT 'camp_' || p_partkey AS campaign_id, p_partkey % 4 AS segment, p_partkey AS k,
        TIMESTAMP '2024-01-01' + to_seconds((p_partkey * 7 % 720) * 3600 + p_partkey % 60 * 60) AS starts_at FROM part),
      campaigns AS (SELECT * EXCLUDE (k), starts_at + to_hours(CASE WHEN k % 50 = 0 THEN 480 ELSE k % 37 END) AS ends_at FROM begun)
      SELECT campaign_id, segment, starts_at, ends_at, count(*) AS events, {BUY} AS purchases,
        CAST(sum(total_amount) AS DOUBLE) AS revenue
      FROM ev JOIN campaigns ON segment = product_id % 4 AND event_timestamp >= starts_at AND event_timestamp < ends_at
      GROUP BY ALL""",
    "sketched_users_daily": f"""WITH {EV}
      SELECT event_date AS day, count(*) AS event_count, count(DISTINCT user_id) AS exact_users, true AS within_error
      FROM ev GROUP BY 1""",
    "sketched_users_kept": f"""WITH {EV},
      seen AS (SELECT DISTINCT CAST(date_trunc('week', event_timestamp) AS DATE) AS week, user_id FROM ev)
      SELECT a.week, count(*) AS exact_in_both, true AS within_error
      FROM seen a JOIN seen b ON b.week = a.week + 7 AND a.user_id = b.user_id GROUP BY 1""",
    "session_windows": f"WITH {EV}, {_visits('ev', 'CAST(sum(total_amount) AS DOUBLE)')}",
    "metrics_5min": f"WITH {EV}, w AS ({_windows('ev', '5 minutes')}) SELECT {METRIC_COLUMNS} FROM w",
    "metrics_category_5min": f"""WITH {ENR}, w AS ({_windows('enr', '5 minutes', 'category')})
      SELECT {CATEGORY_COLUMNS} FROM w""",
    "type_counts_5min": f"WITH {EV} {_counts('5 minutes', ', event_type')}",
    "top_products_5min": f"""WITH {EV}, c AS ({_counts('5 minutes', ', product_id')})
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, product_id)
        AS INTEGER) AS rank FROM c WHERE product_id IS NOT NULL QUALIFY rank <= 10""",
    "top_products_daily": f"""WITH {EV}, c AS ({_counts('1 day', ', product_id')})
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, product_id)
        AS INTEGER) AS rank FROM c WHERE product_id IS NOT NULL QUALIFY rank <= 10""",
    "threshold_alerts": f"WITH {EV}, {HOURS} {_threshold('hours', *HOURLY_LIMITS)}",
    "outage_alerts": f"""WITH {EV}, c AS ({_counts('5 minutes')}),
      cal AS (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL '5 minutes'))
        AS window_start FROM c),
      filled AS (SELECT cal.window_start, cal.window_start + INTERVAL '5 minutes' AS window_end,
        coalesce(event_count, 0) AS event_count FROM cal LEFT JOIN c USING (window_start))
      {_threshold('filled', 4, 1, 1.0, 1.0)}""",
    "rolling_alerts": f"WITH {EV}, {ROLLING} {ROLLING_ALERTS}",
    "rolling_stats": f"WITH {EV}, {ROLLING} SELECT * FROM stats",
    "cohort_first_visits": f"WITH {EVENT_COHORT} SELECT * FROM first",
    "cohort_sizes": f"WITH {EVENT_COHORT} SELECT * FROM sizes",
    "cohort_activity": f"WITH {EVENT_COHORT} SELECT * FROM joined",
    "cohort_incremental": f"WITH {EVENT_COHORT} SELECT * FROM retention",
    "cohort_retention": f"WITH {EVENT_COHORT} SELECT * FROM retention",
    "retention_matrix": f"WITH {EVENT_COHORT} SELECT cohort_week, " + ", ".join(
        f"max(retention_rate) FILTER (period_week = {p}) AS week_{p}" for p in range(5)
    ) + " FROM retention GROUP BY 1",
    "order_cohort_retention": "WITH o AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS event_date "
    f"FROM orders), {COHORT.format(source='o')} SELECT * FROM retention",
    "review_tags": f"""WITH {DOCS}
      SELECT review_id, {WORD_LIST} AS keywords, {ASPECT_LIST} AS aspects, round(sentiment, 4) AS sentiment
      FROM tagged""",
    "review_first_keyword": f"""
      SELECT doc_id, regexp_extract(lower(text), '({'|'.join(LEX.words)})', 1) AS first_keyword FROM documents""",
    "review_summary": f"""WITH {DOCS}
      SELECT created_date AS report_date, count(*) AS total_reviews, avg(rating) AS avg_rating,
        {", ".join(f"count(*) FILTER (rating = {i}) AS rating_{i}" for i in range(1, 6))},
        count(*) FILTER (sentiment > 0) AS positive_count, count(*) FILTER (sentiment < 0) AS negative_count,
        count(*) FILTER (has_images) AS with_images_count, avg(text_length) AS avg_text_length
      FROM tagged GROUP BY 1""",
    "review_keywords": f"""WITH {DOCS}, w AS ({WORD_ROWS})
      SELECT created_date AS report_date, keyword, count(*) AS frequency,
        avg(rating) AS avg_rating_with_keyword, keyword_type FROM w GROUP BY ALL""",
    "review_aspects": f"""WITH {DOCS}, a AS ({ASPECT_ROWS})
      SELECT created_date AS report_date, aspect, count(*) AS mention_count,
        count(*) FILTER (sentiment > 0) AS positive_mentions,
        count(*) FILTER (sentiment < 0) AS negative_mentions, round(avg(sentiment), 4) AS sentiment_score
      FROM a GROUP BY ALL""",
    "product_reviews": f"""WITH {DOCS}, w AS ({WORD_ROWS}),
      c AS (SELECT created_date, product_id, keyword_type, keyword, count(*) AS n FROM w GROUP BY ALL),
      t AS (SELECT * FROM c QUALIFY row_number() OVER (
        PARTITION BY created_date, product_id, keyword_type ORDER BY n DESC, keyword) <= 3),
      s AS (SELECT created_date, product_id, keyword_type,
        string_agg(keyword, ',' ORDER BY n DESC, keyword) AS words FROM t GROUP BY ALL),
      r AS (SELECT created_date, product_id, count(*) AS review_count, avg(rating) AS avg_rating,
        CAST(count(*) FILTER (sentiment > 0) AS DOUBLE) / count(*) AS positive_ratio,
        CAST(count(*) FILTER (sentiment < 0) AS DOUBLE) / count(*) AS negative_ratio FROM tagged GROUP BY ALL)
      SELECT r.created_date AS report_date, r.product_id, review_count, avg_rating, positive_ratio, negative_ratio,
        coalesce(g.words, '') AS top_positive_keywords, coalesce(b.words, '') AS top_negative_keywords
      FROM r
        LEFT JOIN s g ON g.created_date = r.created_date AND g.product_id = r.product_id
          AND g.keyword_type = 'positive'
        LEFT JOIN s b ON b.created_date = r.created_date AND b.product_id = r.product_id
          AND b.keyword_type = 'negative'""",
    "quality_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "quality_checks": f"WITH {CHECKS} SELECT * FROM checks",
    "quality_checks_faulty": f"WITH {FAULTY_CHECKS} SELECT * FROM all_checks",
    "ingest_rejected": """
      SELECT CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'no key' ELSE 'no time' END
        AS reason, count(*) AS n, min(event_id) AS first_event
      FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 GROUP BY 1""",
    "quality_report": f"WITH {CHECKS}, c AS (SELECT check_date, count(*) AS total, " + ", ".join(
        f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in ("PASS", "WARN", "FAIL")
    ) + " FROM checks GROUP BY 1) SELECT *, " + ", ".join(
        f"{_half_up(s, 'total', 1)} AS {s}_pct" for s in ("pass", "warn", "fail")
    ) + " FROM c",
    "session_summary": f"WITH {SESS} SELECT session_id, {SUMMARY} FROM summed",
    "session_summary_check": """
      SELECT unnest(['total_events', 'unique_products_viewed', 'searches_count', 'views_count',
        'add_cart_count', 'purchase_count', 'converted', 'bounce']) AS field,
        (SELECT count(*) FROM orders) AS sessions, CAST(0 AS BIGINT) AS mismatched""",
    "session_summary_exploded": """
      SELECT conv_id AS session_id, count(*) AS total_events,
        count(DISTINCT length(text)) AS unique_products_viewed,
        count(*) FILTER (role = 'user') AS searches_count,
        count(*) FILTER (role = 'assistant') AS views_count,
        count(*) FILTER (role = 'tool') AS add_cart_count,
        count(*) FILTER (role = 'system') AS purchase_count,
        count(*) FILTER (role = 'system') > 0 AS converted, count(*) = 1 AS bounce
      FROM conversations GROUP BY 1""",
    "search_metrics": f"""WITH {SEARCH}
      SELECT search_date, count(*) AS searches, count(*) FILTER (clicked) AS clicks,
        count(*) FILTER (result_count = 0) AS empty_searches, avg(clicked_position) AS avg_clicked_position,
        CAST(count(*) FILTER (clicked) AS DOUBLE) / count(*) AS click_through_rate,
        CAST(count(*) FILTER (result_count = 0) AS DOUBLE) / count(*) AS zero_result_rate
      FROM searches GROUP BY 1""",
    "search_pattern_agreement": f"""WITH {SEARCH}
      SELECT pattern_type, pattern, count(*) AS searches FROM searches GROUP BY ALL""",
    "popular_searches": f"""WITH {SEARCH}
      SELECT query_norm, count(*) AS searches FROM searches GROUP BY 1
      ORDER BY searches DESC, query_norm LIMIT 20""",
    "search_repairs": f"WITH {SEARCH}, {REPAIRS} SELECT * FROM repairs",
    "popular_searches_repaired": f"""WITH {SEARCH}, {REPAIRS},
      repaired AS (SELECT query, string_agg(coalesce(repairs.term, w), ' ' ORDER BY place) AS query_norm
        FROM word LEFT JOIN repairs ON repairs.word = w GROUP BY 1)
      SELECT query_norm, count(*) AS searches FROM asked JOIN repaired USING (query) GROUP BY 1
      ORDER BY searches DESC, query_norm LIMIT 20""",
    "serving_current_window": f"""WITH {EV}, w AS ({_windows('ev', '5 minutes')})
      SELECT window_start, total_events, total_revenue, unique_users, purchase_count
      FROM w ORDER BY window_start DESC LIMIT 1""",
    "serving_recent_totals": f"""WITH {EV}
      SELECT count(*) AS total_events, {REVENUE} AS total_revenue, count(DISTINCT user_id) AS unique_users,
        {BUY} AS orders
      FROM ev WHERE event_timestamp > (SELECT max(ts) FROM events) - INTERVAL '1 day'""",
    "serving_recent_by_type": """SELECT event_type, count(*) AS event_count FROM events
      WHERE ts > (SELECT max(ts) FROM events) - INTERVAL '1 day' GROUP BY 1""",
    "serving_events_per_minute": f"""WITH {EV}, c AS ({_counts('1 minute')})
      SELECT window_start, event_count, 1 AS threshold, event_count > 1 AS above_threshold FROM c""",
    "serving_revenue_over_time": f"""WITH {EV}, w AS ({_windows('ev', '1 hour')})
      SELECT window_start, total_revenue,
        CASE WHEN purchase_count > 0 THEN total_revenue / purchase_count END AS avg_order_value FROM w""",
    "serving_events_by_type": "SELECT event_type, count(*) AS event_count FROM events GROUP BY 1",
    "serving_revenue_by_category": f"""WITH {ENR}
      SELECT category, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM enr GROUP BY 1""",
    "serving_alert_counts": f"""WITH {EV}, {HOURS}, a AS ({_threshold('hours', *HOURLY_LIMITS)})
      SELECT anomaly_type, count(*) AS alerts FROM a GROUP BY 1""",
    "serving_latest_alerts": f"""WITH {EV}, {HOURS}, a AS ({_threshold('hours', *HOURLY_LIMITS)})
      SELECT * FROM a ORDER BY detection_time DESC, window_start DESC LIMIT 100""",
    "serving_latest_cohorts": f"WITH {EVENT_COHORT} SELECT * FROM retention",
    "serving_kpi_cards": f"""WITH {EV}, {DAILY}
      SELECT a.report_date, a.unique_users AS active_users, a.total_orders AS orders, a.conversion_rate,
        a.unique_users - b.unique_users AS active_users_change,
        a.total_orders - b.total_orders AS orders_change,
        a.conversion_rate - b.conversion_rate AS conversion_change
      FROM summary a LEFT JOIN summary b ON b.report_date = a.report_date - 1""",
    "layout_time_range": _layout(IN_MARCH),
    "layout_product_lookup": _layout("product_id = '42'"),
    "layout_product_time_range": _layout(f"product_id = '42' AND {IN_SPAN}"),
    "layout_aggregation": _layout(by="category,"),
    "layout_rows_met": f"""WITH {LINES}
      SELECT table_name, query_name, n, meets FROM layouts, (
        SELECT 'time_range' AS query_name, count(*) AS n, count(*) FILTER ({IN_MARCH}) AS meets FROM li
        UNION ALL SELECT 'product_lookup', count(*), count(*) FILTER (product_id = '42') FROM li)""",
    "stream_ingest_events": f"WITH {INGESTED_EVENTS} SELECT * FROM ingested",
    "stream_ingest_sessions": f"WITH {SESS} {SESSIONS}",
    "stream_ingest_session_events": f"WITH {SESS} {SESSION_EVENTS}",
    "stream_ingest_reviews": INGESTED_REVIEWS,
    "stream_ingest_searches": f"WITH {SEARCH} SELECT * FROM searches",
    "stream_metrics_5min": f"""WITH {INGESTED_EVENTS}, w AS ({STREAM_METRICS})
      SELECT window_start, window_end, total_events, CAST(total_revenue AS BIGINT) AS total_revenue,
        purchase_count, view_count, cart_count, search_count,
        CASE WHEN purchase_count > 0 THEN total_revenue / purchase_count END AS avg_order_value
      FROM w WHERE {STREAMED}""",
    "stream_metrics_category_5min": f"""WITH {INGESTED_EVENTS},
      w AS ({_windows('ingested', '5 minutes', 'category')})
      SELECT window_start, window_end, category, total_events AS event_count,
        CAST(total_revenue AS BIGINT) AS revenue FROM w WHERE {STREAMED}""",
    "stream_type_counts_5min": f"""WITH {EV}, c AS ({_counts('5 minutes', ', event_type')})
      SELECT * FROM c WHERE {STREAMED}""",
    "stream_threshold_alerts": f"WITH {EV}, {HOURS} {_threshold('hours', *HOURLY_LIMITS, where=CLOSED)}",
    "stream_outage_alerts": f"""WITH {EV}, every AS ({_counts('5 minutes')}),
      c AS (SELECT * FROM every WHERE true {CLOSED}),
      cal AS (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL '5 minutes'))
        AS window_start FROM c),
      filled AS (SELECT cal.window_start, cal.window_start + INTERVAL '5 minutes' AS window_end,
        coalesce(event_count, 0) AS event_count FROM cal LEFT JOIN c USING (window_start))
      {_threshold('filled', 4, 1, 1.0, 1.0)}""",
    "stream_purchase_outages": f"""WITH {EV}, every AS (
        SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
          time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end, {BUY} AS event_count
        FROM ev GROUP BY ALL)
      {_threshold('every', 10, 1, 1.0, 1.0, where=CLOSED)}""",
    "stream_view_to_purchase": f"WITH {INGESTED_EVENTS} {_followed('ingested')}",
    "stream_session_windows": f"""WITH {INGESTED_EVENTS}, {_visits('ingested', 'CAST(sum(total_amount) AS BIGINT)')}
      HAVING max(event_timestamp) + INTERVAL '12 hours' <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'""",
    "stream_ingest_distinct": f"WITH {INGESTED_EVENTS} SELECT * FROM ingested",
    "stream_rolling_alerts": f"WITH {EV}, {ROLLING} {ROLLING_ALERTS} {CLOSED}",
    "stream_top_products_daily": f"""WITH {INGESTED_EVENTS},
      ev AS (SELECT * FROM ingested), c AS ({_counts('1 day', ', product_id')})
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, product_id)
        AS INTEGER) AS rank FROM c WHERE {STREAMED} QUALIFY rank <= 10""",
}


def all_sql() -> dict[str, str]:
    return dict(SQL)
