"""The same results in plain SQL for DuckDB, written independently of the Spark plans.

Where the Spark side uses month changes, merged spans, radix selection or split windows,
the SQL uses the textbook form: range joins, generated months, quantile functions and
windows over whole keys.
"""

from __future__ import annotations

from tenure.sources.demo import BRONZE_CUSTOMERS, BRONZE_SUBSCRIPTIONS

AS_OF = "2001-08-01"

_NAMES = {name: name for name in ("orders", "customer", "nation")}
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _strip(column: str) -> str:
    return rf"regexp_replace({column}, '^[\s\x{{2028}}]+|[\s\x{{2028}}]+$', '', 'g')"


def _date(text: str) -> str:
    day = f"CAST(try_strptime({text}, '%Y-%m-%d') AS DATE)"
    return f"CASE WHEN {day} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {day} END"


def _price(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{_NUMBER}') THEN TRY_CAST({text} AS DECIMAL(28,6)) END"


_BASE = f"""
bronze_customers AS ({BRONZE_CUSTOMERS.format(**_NAMES)}),
bronze_subscriptions AS ({BRONZE_SUBSCRIPTIONS.format(**_NAMES)}),
cust AS (
  SELECT row_id, nullif({_strip('customer_id')}, '') AS customer_id,
         nullif({_strip('signup_date')}, '') AS signup_date_raw,
         {_date(_strip('signup_date'))} AS signup_date,
         nullif(upper({_strip('country')}), '') AS country
  FROM bronze_customers),
first_c AS (
  SELECT * FROM cust QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_id) = 1),
silver_c AS (
  SELECT row_id, customer_id, signup_date, country FROM first_c WHERE signup_date IS NOT NULL AND customer_id IS NOT NULL),
named AS (
  SELECT * FROM first_c WHERE customer_id IS NOT NULL UNION ALL SELECT * FROM cust WHERE customer_id IS NULL),
removed_c AS (
  SELECT customer_id, signup_date_raw FROM first_c WHERE signup_date IS NULL AND customer_id IS NOT NULL),
text_s AS (
  SELECT row_id, nullif({_strip('customer_id')}, '') AS customer_id,
         nullif({_strip('start_date')}, '') AS start_date_raw,
         nullif({_strip('end_date')}, '') AS end_date_raw,
         CASE WHEN {_strip('plan')} = 'baisc' THEN 'basic' ELSE {_strip('plan')} END AS plan,
         CASE WHEN {_strip('monthly_price')} = 'thirty' THEN '30' ELSE {_strip('monthly_price')} END AS monthly_price_raw
  FROM bronze_subscriptions),
subs AS (
  SELECT row_id, customer_id, start_date_raw, {_date('start_date_raw')} AS start_date,
         end_date_raw, {_date('end_date_raw')} AS end_date,
         (end_date_raw IS NOT NULL AND {_date('end_date_raw')} IS NULL) AS end_date_malformed,
         plan, monthly_price_raw, {_price('monthly_price_raw')} AS monthly_price
  FROM text_s),
stated AS (
  SELECT subs.*, f.signup_date,
         CASE WHEN f.customer_id IS NULL THEN 'unknown' WHEN f.signup_date IS NULL THEN 'excluded' ELSE 'known' END AS customer_state
  FROM subs LEFT JOIN first_c f ON f.customer_id = subs.customer_id),
known AS (SELECT * EXCLUDE (customer_state) FROM stated WHERE customer_state = 'known'),
valid AS (
  SELECT row_id, customer_id, start_date, end_date, lower(plan) AS plan, monthly_price FROM known
  WHERE start_date IS NOT NULL AND monthly_price >= 0 AND (end_date IS NULL OR end_date >= start_date)),
repaired AS (
  SELECT * REPLACE (CASE WHEN end_date < start_date THEN NULL ELSE end_date END AS end_date),
         coalesce(end_date < start_date, false) AS repaired
  FROM known WHERE start_date IS NOT NULL AND monthly_price IS NOT NULL),
bounds AS (
  SELECT least(min(start_date), min(end_date)) AS lo, greatest(max(start_date), max(end_date)) AS hi FROM valid),
months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS first_day
  FROM bounds),
mrr AS (
  SELECT strftime(first_day, '%Y-%m') AS month,
         CAST(round(coalesce(sum(monthly_price), 0), 2) AS DOUBLE) AS mrr,
         count(DISTINCT customer_id) AS active_customers
  FROM months LEFT JOIN valid ON start_date <= last_day(first_day) AND (end_date IS NULL OR end_date >= first_day)
  GROUP BY first_day),
chained AS (
  SELECT *, lead(start_date) OVER w AS next_start, lead(end_date) OVER w AS next_end
  FROM valid WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, row_id)),
churned AS (
  SELECT customer_id, start_date, end_date, next_start, strftime(end_date, '%Y-%m') AS month FROM chained
  WHERE end_date IS NOT NULL AND (next_start IS NULL OR date_diff('day', end_date, next_start) > 30)),
churn AS (
  SELECT strftime(first_day, '%Y-%m') AS month, count(c.month) AS churned_count
  FROM months LEFT JOIN churned c ON c.month = strftime(first_day, '%Y-%m') GROUP BY first_day),
targets AS (
  SELECT customer_id, signup_date, strftime(signup_date, '%Y-%m') AS cohort_month,
         CAST(signup_date + INTERVAL 3 MONTH AS DATE) AS target_date
  FROM silver_c),
gaps AS (
  SELECT row_id, customer_id, start_date, end_date, next_start,
         CAST(date_diff('day', end_date, next_start) AS INTEGER) AS gap_days
  FROM (SELECT *, lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, row_id) AS next_start FROM repaired)),
durations AS (
  SELECT row_id, customer_id, start_date, end_date,
         CAST(date_diff('day', start_date, coalesce(end_date, DATE '{AS_OF}')) AS INTEGER) AS duration_days
  FROM repaired),
running AS (
  SELECT row_id, customer_id, start_date, end_date,
         max(struct_pack(e := coalesce(end_date, DATE '9999-12-31'), nr := -rn, s := start_date)) OVER (
           PARTITION BY customer_id ORDER BY start_date, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS holder
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY start_date, row_id) AS rn
        FROM known WHERE start_date IS NOT NULL)),
overlaps_run AS (
  SELECT row_id, customer_id, holder.s AS previous_start,
         CASE WHEN holder.e < DATE '9999-12-31' THEN holder.e END AS previous_end,
         start_date AS current_start, end_date AS current_end
  FROM running WHERE start_date <= holder.e),
overlaps_adj AS (
  SELECT row_id, customer_id, start_date, end_date, next_start, next_end FROM chained
  WHERE end_date IS NOT NULL AND next_start <= end_date),
price_bounds AS (
  SELECT count(*) AS n, quantile_cont(CAST(monthly_price AS DOUBLE), 0.25) AS q1,
         quantile_cont(CAST(monthly_price AS DOUBLE), 0.75) AS q3
  FROM known WHERE monthly_price IS NOT NULL),
outliers AS (
  SELECT row_id, customer_id, plan, CAST(monthly_price AS DOUBLE) AS monthly_price,
         round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound
  FROM known, price_bounds
  WHERE n >= 4 AND q3 > q1 AND (CAST(monthly_price AS DOUBLE) < q1 - 1.5 * (q3 - q1)
        OR CAST(monthly_price AS DOUBLE) > q3 + 1.5 * (q3 - q1))),
spread AS (
  SELECT plan, count(*) AS rows, count(DISTINCT monthly_price) AS distinct_prices,
         CAST(min(monthly_price) AS DOUBLE) AS min_price, CAST(max(monthly_price) AS DOUBLE) AS max_price
  FROM known WHERE monthly_price IS NOT NULL AND plan IS NOT NULL GROUP BY plan
  HAVING count(*) >= 2 AND count(DISTINCT monthly_price) > 1),
rule_hits AS (
  SELECT * FROM (
    SELECT row_id, customer_id, 'excluded_customer' AS rule_id, 'dropped' AS severity, NULL AS detail,
           'customer was removed' AS message FROM stated WHERE customer_state = 'excluded'
    UNION ALL SELECT row_id, customer_id, 'empty_customer_id', 'dropped', NULL, 'customer_id is empty' FROM stated WHERE customer_id IS NULL
    UNION ALL SELECT row_id, customer_id, 'unknown_customer', 'dropped', NULL,
           'customer_id ''' || customer_id || ''' is not a known customer'
           FROM stated WHERE customer_state = 'unknown' AND customer_id IS NOT NULL
    UNION ALL SELECT row_id, customer_id, 'empty_start_date', 'dropped', start_date_raw, 'start_date is empty'
           FROM known WHERE start_date_raw IS NULL
    UNION ALL SELECT row_id, customer_id, 'malformed_start_date', 'dropped', start_date_raw,
           'start_date ''' || start_date_raw || ''' is not a date'
           FROM known WHERE start_date_raw IS NOT NULL AND start_date IS NULL
    UNION ALL SELECT row_id, customer_id, 'malformed_end_date', 'repaired', end_date_raw,
           'end_date ''' || end_date_raw || ''' is not a date - treated as open' FROM known WHERE end_date_malformed
    UNION ALL SELECT row_id, customer_id, 'non_numeric_price', 'dropped', monthly_price_raw,
           'monthly_price ''' || coalesce(monthly_price_raw, '') || ''' is not a number' FROM known WHERE monthly_price IS NULL
    UNION ALL SELECT row_id, customer_id, 'end_before_start', 'dropped',
           CAST(start_date AS VARCHAR) || ' to ' || CAST(end_date AS VARCHAR), 'end_date before start_date'
           FROM known WHERE end_date < start_date
    UNION ALL SELECT row_id, customer_id, 'start_before_signup', 'monitor',
           CAST(start_date AS VARCHAR) || ' before ' || CAST(signup_date AS VARCHAR), 'start_date before customer signup_date'
           FROM known WHERE start_date < signup_date)),
overlap_findings AS (
  SELECT 'overlaps' AS stage, 'overlap' AS rule_id, 'monitor' AS severity, row_id, customer_id,
         CAST(next_start AS VARCHAR) AS detail,
         'Customer ''' || customer_id || ''' has overlapping subscriptions: ' || CAST(start_date AS VARCHAR) || ' to '
         || CAST(end_date AS VARCHAR) || ' overlaps with ' || CAST(next_start AS VARCHAR) || ' to '
         || coalesce(CAST(next_end AS VARCHAR), 'active') AS message
  FROM overlaps_adj),
load_findings AS (
  SELECT 'load_customers' AS stage, 'missing_country' AS rule_id, 'monitor' AS severity, row_id, customer_id,
         NULL AS detail, 'Customer ''' || customer_id || ''' has missing country - keeping record' AS message
  FROM silver_c WHERE country IS NULL
  UNION ALL
  SELECT 'load_subscriptions', 'unknown_customer', 'dropped', row_id, customer_id, NULL,
         'Unknown customer_id ''' || coalesce(customer_id, '') || ''' at row ' || row_id || ' - skipping subscription'
  FROM stated WHERE customer_state <> 'known'
  UNION ALL
  SELECT 'load_subscriptions', 'invalid_start_date', 'dropped', row_id, customer_id, start_date_raw,
         'Invalid subscription at row ' || row_id || ': start_date ''' || coalesce(start_date_raw, '') || ''' is not a date - skipping'
  FROM known WHERE start_date IS NULL
  UNION ALL
  SELECT 'load_subscriptions', 'malformed_end_date', 'repaired', row_id, customer_id, end_date_raw,
         'Invalid end_date for subscription at row ' || row_id || ' - treating as active'
  FROM known WHERE start_date IS NOT NULL AND end_date_malformed
  UNION ALL
  SELECT 'load_subscriptions', 'non_numeric_price', 'dropped', row_id, customer_id, monthly_price_raw,
         'Invalid monthly_price ''' || coalesce(monthly_price_raw, '') || ''' at row ' || row_id || ' - skipping'
  FROM known WHERE start_date IS NOT NULL AND monthly_price IS NULL
  UNION ALL
  SELECT 'load_subscriptions', 'negative_price', 'dropped', row_id, customer_id, monthly_price_raw,
         'Invalid subscription at row ' || row_id || ': monthly_price is negative - skipping'
  FROM known WHERE start_date IS NOT NULL AND monthly_price < 0
  UNION ALL
  SELECT 'load_subscriptions', 'end_before_start', 'dropped', row_id, customer_id,
         CAST(start_date AS VARCHAR) || ' to ' || CAST(end_date AS VARCHAR),
         'Subscription for ''' || customer_id || ''' has end_date before start_date - skipping'
  FROM known WHERE monthly_price >= 0 AND end_date < start_date
  UNION ALL SELECT * FROM overlap_findings),
raw_c AS (
  SELECT row_id, customer_id, nullif({_strip('signup_date')}, '') AS signup_date_raw,
         {_date(_strip('signup_date'))} AS signup_date, coalesce(nullif(upper({_strip('country')}), ''), '') AS country,
         row_number() OVER (ORDER BY row_id) + 1 AS line_no
  FROM bronze_customers),
raw_first AS (
  SELECT * FROM raw_c WHERE signup_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_id) = 1),
raw_s AS (
  SELECT b.row_id, b.customer_id, nullif({_strip('b.start_date')}, '') AS start_date_raw,
         {_date(_strip('b.start_date'))} AS start_date, nullif({_strip('b.end_date')}, '') AS end_date_raw,
         {_date(_strip('b.end_date'))} AS end_date, lower({_strip('b.plan')}) AS plan,
         {_strip('b.monthly_price')} AS monthly_price_raw, {_price(_strip('b.monthly_price'))} AS monthly_price,
         f.customer_id IS NOT NULL AS known, row_number() OVER (ORDER BY b.row_id) + 1 AS line_no
  FROM bronze_subscriptions b LEFT JOIN raw_first f ON f.customer_id = b.customer_id)
"""


def _describe(source: str, value: str, by: str = "") -> str:
    v = f"CAST({value} AS DOUBLE)"
    head = f"{by}, " if by else ""
    return f"""SELECT {head}count({value}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std,
        min({v}) AS min, round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50,
        round(quantile_cont({v}, 0.75), 6) AS p75, max({v}) AS max
        FROM {source} WHERE {value} IS NOT NULL {"GROUP BY " + by if by else ""}"""


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""SELECT b.bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS lower,
        round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS upper, count(v) AS n
        FROM (SELECT min(CAST({value} AS DOUBLE)) AS lo, max(CAST({value} AS DOUBLE)) AS hi FROM {source}) e
        CROSS JOIN (SELECT unnest(range(0, {bins})) AS bin) b
        LEFT JOIN (SELECT CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL) x
          ON CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) = b.bin
        GROUP BY b.bin, lo, hi"""


def _count(rule: str, severity: str, condition: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule_id, '{severity}' AS severity, count(*) AS hits FROM {source} WHERE {condition}"


_PROFILED = (
    "customer_id start_date_raw start_date end_date_raw end_date end_date_malformed plan "
    "monthly_price_raw monthly_price signup_date"
).split()

_RETAINED = """EXISTS (SELECT 1 FROM {subs} s WHERE s.customer_id = t.customer_id
  AND s.start_date <= t.target_date AND (s.end_date IS NULL OR s.end_date >= t.target_date))"""

# A rule table of one's own: what each rule is and does, and the rows it hits.
_OWN_RULES = f"""own_stated AS (
  SELECT stated.*, {_strip('b.plan')} AS plan_before FROM stated JOIN bronze_subscriptions b USING (row_id)),
own_table AS (
  SELECT * FROM (VALUES (1, 'excluded_customer', 'dropped', 'drop'), (2, 'empty_customer_id', 'dropped', 'drop'),
    (3, 'unknown_customer', 'dropped', 'drop'), (4, 'empty_start_date', 'dropped', 'drop'),
    (5, 'malformed_start_date', 'dropped', 'drop'), (6, 'malformed_end_date', 'dropped', 'drop'),
    (7, 'non_numeric_price', 'monitor', 'keep'), (8, 'price_out_of_range', 'fatal', 'stop'),
    (9, 'end_before_start', 'monitor', 'keep'), (10, 'start_before_signup', 'dropped', 'drop'),
    (11, 'plan_typo', 'dropped', 'drop')) v(place, rule_id, severity, action)),
own_hits AS (
  SELECT row_id, rule_id FROM rule_hits
  UNION ALL SELECT row_id, 'plan_typo' FROM own_stated WHERE customer_state = 'known' AND plan_before = 'baisc')"""


_QUERIES: dict[str, str] = {
    "bronze_customers_scan": "SELECT * FROM bronze_customers",
    "bronze_subscriptions_scan": "SELECT * FROM bronze_subscriptions",
    "customer_reference": "SELECT customer_id, signup_date FROM silver_c",
    "clean_strip": "SELECT row_id, "
    + ", ".join(
        f"{_strip(c)} AS {c}" for c in ("customer_id", "start_date", "end_date", "plan", "monthly_price")
    )
    + " FROM bronze_subscriptions",
    "clean_country": "SELECT row_id, country FROM cust",
    "clean_plan": "SELECT row_id, plan, lower(plan) AS plan_lower FROM subs",
    "clean_price": "SELECT row_id, monthly_price_raw, CAST(monthly_price AS DOUBLE) AS monthly_price FROM subs",
    "clean_dates": """SELECT row_id, start_date, end_date, end_date_malformed,
        CAST(date_trunc('month', start_date) AS DATE) AS first_day, last_day(start_date) AS last_day,
        end_date IS NULL AS is_active, coalesce(CAST(end_date AS VARCHAR), 'active') AS shown_end FROM subs""",
    "target_date_3m": "SELECT * FROM targets",
    "dq_customer_rules": " UNION ALL ".join(
        [
            _count("empty_customer_id", "fatal", "customer_id IS NULL", "cust"),
            """SELECT 'duplicate_customer_id', 'dropped', count(*) - count(DISTINCT customer_id)
               FROM cust WHERE customer_id IS NOT NULL""",
            _count("empty_signup_date", "dropped", "signup_date_raw IS NULL AND customer_id IS NOT NULL", "first_c"),
            _count("malformed_signup_date", "dropped", "signup_date_raw IS NOT NULL AND signup_date IS NULL AND customer_id IS NOT NULL", "first_c"),
            _count("missing_country", "monitor", "signup_date IS NOT NULL AND country IS NULL AND customer_id IS NOT NULL", "first_c"),
        ]
    ),
    "customers_dedup": "SELECT row_id, customer_id, signup_date_raw, country FROM first_c",
    "customers_removed": "SELECT * FROM removed_c ORDER BY customer_id",
    "subscriptions_excluded": """SELECT customer_id, count(*) AS subscriptions FROM subs
        WHERE customer_id IN (SELECT customer_id FROM removed_c) GROUP BY customer_id""",
    "subscriptions_known": "SELECT row_id, customer_id FROM subs WHERE customer_id IN (SELECT customer_id FROM silver_c)",
    "subscriptions_orphans": """SELECT row_id, customer_id, start_date_raw, plan FROM subs
        WHERE NOT EXISTS (SELECT 1 FROM silver_c c WHERE c.customer_id = subs.customer_id)""",
    "dq_subscription_rules": " UNION ALL ".join(
        [
            _count("excluded_customer", "dropped", "customer_state = 'excluded'", "stated"),
            _count("empty_customer_id", "fatal", "customer_id IS NULL", "stated"),
            _count("unknown_customer", "dropped", "customer_state = 'unknown' AND customer_id IS NOT NULL", "stated"),
            _count("empty_start_date", "fatal", "start_date_raw IS NULL", "known"),
            _count("malformed_start_date", "fatal", "start_date_raw IS NOT NULL AND start_date IS NULL", "known"),
            _count("malformed_end_date", "repaired", "end_date_raw IS NOT NULL AND end_date IS NULL", "known"),
            _count("non_numeric_price", "fatal", "monthly_price IS NULL", "known"),
            _count("price_out_of_range", "fatal", "false", "known"),
            _count("end_before_start", "fatal", "end_date < start_date", "known"),
            _count("start_before_signup", "fatal", "start_date < signup_date", "known"),
        ]
    ),
    "end_date_malformed": "SELECT row_id, customer_id, end_date_raw FROM known WHERE end_date_raw IS NOT NULL AND end_date IS NULL",
    "invalid_date_ranges": "SELECT row_id, customer_id, start_date, end_date, plan FROM known WHERE end_date < start_date",
    "start_before_signup": "SELECT row_id, customer_id, signup_date, start_date, plan FROM known WHERE start_date < signup_date",
    "negative_prices": "SELECT row_id, customer_id, plan, CAST(monthly_price AS DOUBLE) AS monthly_price FROM known WHERE monthly_price < 0",
    "zero_prices": "SELECT row_id, customer_id, plan, CAST(monthly_price AS DOUBLE) AS monthly_price FROM known WHERE monthly_price = 0",
    "overlaps_running_max": "SELECT * FROM overlaps_run",
    "overlaps_adjacent": "SELECT * FROM overlaps_adj",
    "price_outliers_iqr": "SELECT * FROM outliers",
    "plan_price_spread": "SELECT * FROM spread",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS rows FROM known" for c in _PROFILED
    ),
    "repair_date_ranges": "SELECT row_id, customer_id, start_date, end_date, repaired FROM repaired",
    "dq_examples": """SELECT rule_id, CAST(rank AS INTEGER) AS rank, row_id, customer_id, detail FROM (
        SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY row_id) AS rank FROM rule_hits)
        WHERE rank <= CASE WHEN rule_id = 'unknown_customer' THEN 10 ELSE 5 END""",
    "dq_warnings": """
        SELECT 'clean_customers' AS stage, 'empty_customer_id' AS rule_id, 'fatal' AS severity, row_id, customer_id,
               NULL AS detail, 'customer_id is empty' AS message FROM named WHERE customer_id IS NULL
        UNION ALL SELECT 'clean_customers', 'empty_signup_date', 'dropped', row_id, customer_id, signup_date_raw,
               'signup_date is empty - customer removed' FROM named WHERE signup_date_raw IS NULL
        UNION ALL SELECT 'clean_customers', 'malformed_signup_date', 'dropped', row_id, customer_id, signup_date_raw,
               'signup_date ''' || signup_date_raw || ''' is not a date - customer removed'
               FROM named WHERE signup_date_raw IS NOT NULL AND signup_date IS NULL
        UNION ALL SELECT 'clean_customers', 'missing_country', 'monitor', row_id, customer_id, NULL,
               'Customer ''' || coalesce(customer_id, '') || ''' has missing country - keeping record'
               FROM named WHERE signup_date IS NOT NULL AND country IS NULL
        UNION ALL SELECT 'clean_customers', 'duplicate_customer_id', 'dropped', row_id, customer_id, signup_date_raw,
               'customer_id ''' || customer_id || ''' occurs again - first row kept'
               FROM cust WHERE customer_id IS NOT NULL AND row_id NOT IN (SELECT row_id FROM first_c)
        UNION ALL SELECT 'clean_subscriptions', rule_id, severity, row_id, customer_id, detail, message FROM rule_hits
        UNION ALL SELECT 'clean_subscriptions', 'overlap', 'monitor', row_id, customer_id, CAST(current_start AS VARCHAR),
               'Customer ''' || customer_id || ''' has overlapping subscriptions: ' || CAST(previous_start AS VARCHAR) || ' to '
               || coalesce(CAST(previous_end AS VARCHAR), 'active') || ' overlaps with ' || CAST(current_start AS VARCHAR)
               || ' to ' || coalesce(CAST(current_end AS VARCHAR), 'active') FROM overlaps_run
        UNION ALL SELECT 'clean_subscriptions', 'price_outlier', 'monitor', row_id, customer_id, CAST(monthly_price AS VARCHAR),
               printf('monthly_price of plan ''%s'' outside [%.2f, %.2f]', plan, lower_bound, upper_bound) FROM outliers
        UNION ALL SELECT 'clean_subscriptions', 'plan_price_spread', 'monitor', NULL, NULL, plan,
               printf('plan ''%s'' has %d distinct prices (%.2f to %.2f)', plan, distinct_prices, min_price, max_price) FROM spread
        UNION ALL SELECT * FROM overlap_findings""",
    "report_messages": """SELECT row_number() OVER (ORDER BY
        CASE stage WHEN 'load_customers' THEN 1 WHEN 'load_subscriptions' THEN 2 ELSE 3 END,
        CASE WHEN stage = 'overlaps' THEN customer_id ELSE '' END, row_id, rule_id, message) - 1 AS position, message
        FROM load_findings""",
    "first_warnings": """SELECT *, (SELECT greatest(count(*) - 10, 0) FROM load_findings) AS more FROM load_findings ORDER BY
        CASE stage WHEN 'load_customers' THEN 1 WHEN 'load_subscriptions' THEN 2 ELSE 3 END,
        CASE WHEN stage = 'overlaps' THEN customer_id ELSE '' END, row_id, rule_id LIMIT 10""",
    "silver_customers": "SELECT * FROM silver_c",
    "silver_subscriptions_standalone": """SELECT s.row_id, s.customer_id, start_date, end_date, end_date_raw, end_date_malformed, plan,
        CAST(monthly_price AS DOUBLE) AS monthly_price FROM subs s JOIN first_c f ON f.customer_id = s.customer_id
        WHERE start_date IS NOT NULL AND monthly_price IS NOT NULL AND (end_date IS NULL OR end_date >= start_date)""",
    "silver_subscriptions": """SELECT row_id, customer_id, start_date, end_date, end_date_raw, end_date_malformed, plan,
        CAST(monthly_price AS DOUBLE) AS monthly_price FROM known
        WHERE start_date IS NOT NULL AND monthly_price IS NOT NULL AND (end_date IS NULL OR end_date >= start_date)""",
    "load_customers": "SELECT row_id, customer_id, signup_date, country FROM raw_first",
    "load_customers_warnings": """
        SELECT 'load_customers' AS stage, 'duplicate_customer_id' AS rule_id, 'dropped' AS severity, r.row_id, r.customer_id,
               r.signup_date_raw AS detail,
               'Duplicate customer_id ''' || r.customer_id || ''' at row ' || r.line_no || ' - skipping' AS message
        FROM raw_c r JOIN raw_first f ON f.customer_id = r.customer_id WHERE r.row_id > f.row_id
        UNION ALL
        SELECT 'load_customers', 'invalid_customer', 'dropped', r.row_id, r.customer_id, r.signup_date_raw,
               'Invalid customer at row ' || r.line_no || ': signup_date ''' || coalesce(r.signup_date_raw, '')
               || ''' is not a date - skipping'
        FROM raw_c r LEFT JOIN raw_first f ON f.customer_id = r.customer_id
        WHERE r.signup_date IS NULL AND (f.row_id IS NULL OR r.row_id < f.row_id)
        UNION ALL
        SELECT 'load_customers', 'missing_country', 'monitor', row_id, customer_id, NULL,
               'Customer ''' || customer_id || ''' has missing country - keeping record' FROM raw_first WHERE country = ''""",
    "load_subscriptions": """SELECT row_id, customer_id, start_date, end_date, plan, CAST(monthly_price AS DOUBLE) AS monthly_price
        FROM raw_s WHERE known AND start_date IS NOT NULL AND monthly_price >= 0 AND (end_date IS NULL OR end_date >= start_date)""",
    "load_subscriptions_warnings": """
        SELECT 'load_subscriptions' AS stage, 'unknown_customer' AS rule_id, 'dropped' AS severity, row_id, customer_id, NULL AS detail,
               'Unknown customer_id ''' || customer_id || ''' at row ' || line_no || ' - skipping subscription' AS message
        FROM raw_s WHERE NOT known
        UNION ALL SELECT 'load_subscriptions', 'invalid_start_date', 'dropped', row_id, customer_id, start_date_raw,
               'Invalid subscription at row ' || line_no || ': start_date ''' || coalesce(start_date_raw, '') || ''' is not a date - skipping'
        FROM raw_s WHERE known AND start_date IS NULL
        UNION ALL SELECT 'load_subscriptions', 'malformed_end_date', 'repaired', row_id, customer_id, end_date_raw,
               'Invalid end_date for subscription at row ' || line_no || ' - treating as active'
        FROM raw_s WHERE known AND start_date IS NOT NULL AND end_date_raw IS NOT NULL AND end_date IS NULL
        UNION ALL SELECT 'load_subscriptions', 'non_numeric_price', 'dropped', row_id, customer_id, monthly_price_raw,
               'Invalid monthly_price ''' || monthly_price_raw || ''' at row ' || line_no || ' - skipping'
        FROM raw_s WHERE known AND start_date IS NOT NULL AND monthly_price IS NULL
        UNION ALL SELECT 'load_subscriptions', 'negative_price', 'dropped', row_id, customer_id, monthly_price_raw,
               'Invalid subscription at row ' || line_no || ': monthly_price is negative - skipping'
        FROM raw_s WHERE known AND start_date IS NOT NULL AND monthly_price < 0
        UNION ALL SELECT 'load_subscriptions', 'end_before_start', 'dropped', row_id, customer_id,
               CAST(start_date AS VARCHAR) || ' to ' || CAST(end_date AS VARCHAR),
               'Subscription for ''' || customer_id || ''' has end_date before start_date - skipping'
        FROM raw_s WHERE known AND monthly_price >= 0 AND end_date < start_date""",
    "subscriptions_quarantine": """SELECT row_id, customer_id, start_date_raw, end_date_raw, plan, monthly_price_raw, rule_id,
        customer_state <> 'known' AS is_customer_missing FROM (
          SELECT *, CASE WHEN customer_state = 'excluded' THEN 'excluded_customer'
            WHEN customer_id IS NULL THEN 'empty_customer_id'
            WHEN customer_state = 'unknown' THEN 'unknown_customer'
            WHEN start_date_raw IS NULL THEN 'empty_start_date'
            WHEN start_date IS NULL THEN 'malformed_start_date'
            WHEN monthly_price IS NULL THEN 'non_numeric_price'
            WHEN end_date < start_date THEN 'end_before_start'
            WHEN monthly_price < 0 THEN 'negative_price' END AS rule_id FROM stated)
        WHERE rule_id IS NOT NULL""",
    "stored_gaps": "SELECT row_id, customer_id, start_date, end_date, next_start, gap_days FROM gaps",
    "stored_overlaps_adjacent": "SELECT * FROM overlaps_adj",
    "stored_churn": "SELECT * FROM churn",
    "stored_retention": f"""SELECT cohort_month, count(*) AS cohort_size, count(*) FILTER (WHERE kept) AS active_after_3_months,
        round(count(*) FILTER (WHERE kept) / CAST(count(*) AS DOUBLE), 4) AS retention_rate_3m
        FROM (SELECT cohort_month, {_RETAINED.format(subs='valid')} AS kept FROM targets t) GROUP BY cohort_month""",
    "prefiltered_known": "SELECT row_id, customer_id FROM subs WHERE customer_id IN (SELECT customer_id FROM silver_c)",
    "prefiltered_orphans": """SELECT row_id, customer_id, start_date_raw, plan FROM subs
        WHERE NOT EXISTS (SELECT 1 FROM silver_c c WHERE c.customer_id = subs.customer_id)""",
    "rule_table": f""", {_OWN_RULES} SELECT rule_id, severity, action, count(row_id) AS hits FROM own_table LEFT JOIN own_hits USING (rule_id)
        GROUP BY rule_id, severity, action""",
    "row_fates": f""", {_OWN_RULES}, fates AS (
        SELECT row_id, max(CASE action WHEN 'drop' THEN 2 WHEN 'repair' THEN 1 ELSE 0 END) AS grade
        FROM own_hits JOIN own_table USING (rule_id) GROUP BY row_id)
        SELECT CASE coalesce(grade, 0) WHEN 2 THEN 'drop' WHEN 1 THEN 'repair' ELSE 'keep' END AS fate, count(*) AS rows
        FROM own_stated LEFT JOIN fates USING (row_id) GROUP BY 1""",
    "silver_by_rule_table": f""", {_OWN_RULES}
        SELECT row_id, customer_id, start_date, end_date, end_date_raw, end_date_malformed, plan,
        CAST(monthly_price AS DOUBLE) AS monthly_price FROM own_stated WHERE row_id NOT IN (
          SELECT row_id FROM own_hits JOIN own_table USING (rule_id) WHERE action = 'drop')""",
    "quarantine_by_rule_table": f""", {_OWN_RULES}, firsts AS (
        SELECT row_id, arg_min(rule_id, place) AS rule_id FROM own_hits JOIN own_table USING (rule_id) WHERE action = 'drop' GROUP BY row_id)
        SELECT * FROM (SELECT row_id, customer_id, start_date_raw, end_date_raw, plan, monthly_price_raw,
        coalesce(rule_id, CASE WHEN monthly_price < 0 THEN 'negative_price' END) AS rule_id,
        customer_state <> 'known' AS is_customer_missing FROM own_stated LEFT JOIN firsts USING (row_id)) WHERE rule_id IS NOT NULL""",
    "metric_month_range": "SELECT * FROM bounds",
    "monthly_mrr": "SELECT month, mrr FROM mrr",
    "churn_events": "SELECT * FROM churned",
    "monthly_churn": "SELECT * FROM churn",
    "cohort_retention": f"""SELECT cohort_month, count(*) AS cohort_size, count(*) FILTER (WHERE kept) AS active_after_3_months,
        round(count(*) FILTER (WHERE kept) / CAST(count(*) AS DOUBLE), 4) AS retention_rate_3m
        FROM (SELECT cohort_month, {_RETAINED.format(subs='valid')} AS kept FROM targets t) GROUP BY cohort_month""",
    "report_summary": """SELECT (SELECT count(*) FROM silver_c) AS total_customers,
        (SELECT count(*) FROM valid) AS total_subscriptions, (SELECT count(*) FROM load_findings) AS warning_count""",
    "open_subscriptions": """SELECT row_id, customer_id, start_date, plan, CAST(monthly_price AS DOUBLE) AS monthly_price
        FROM repaired WHERE end_date IS NULL""",
    "multi_active_customers": f"""SELECT customer_id, count(*) AS active_subscriptions FROM repaired
        WHERE end_date IS NULL OR end_date >= DATE '{AS_OF}' GROUP BY customer_id HAVING count(*) > 1""",
    "multi_active_details": f"""SELECT row_id, customer_id, start_date, end_date, plan, CAST(monthly_price AS DOUBLE) AS monthly_price
        FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS n FROM repaired
              WHERE end_date IS NULL OR end_date >= DATE '{AS_OF}') WHERE n > 1""",
    "subscription_gaps": "SELECT * FROM gaps",
    "gaps_exactly_30": "SELECT * FROM gaps WHERE gap_days = 30",
    "gap_stats": _describe("gaps", "gap_days"),
    "gap_histogram": _histogram("gaps", "gap_days", 30),
    "resubscription_shares": """SELECT count(*) FILTER (WHERE gap_days <= 30) AS within_grace, count(gap_days) AS gaps,
        round(100.0 * count(*) FILTER (WHERE gap_days <= 30) / CAST(count(gap_days) AS DOUBLE), 4) AS within_grace_pct,
        count(*) FILTER (WHERE end_date IS NULL) AS open_ends,
        round(100.0 * count(*) FILTER (WHERE end_date IS NULL) / CAST(count(*) AS DOUBLE), 4) AS open_ends_pct FROM gaps""",
    "cohort_sizes": "SELECT cohort_month, count(*) AS cohort_size FROM targets GROUP BY cohort_month",
    "tiny_cohorts": "SELECT cohort_month, count(*) AS cohort_size FROM targets GROUP BY cohort_month HAVING count(*) < 5",
    "cohort_retention_exploratory": f"""SELECT cohort_month, avg(CASE WHEN kept THEN 1 ELSE 0 END) AS retention_rate
        FROM (SELECT cohort_month, {_RETAINED.format(subs='repaired')} AS kept FROM targets t) GROUP BY cohort_month""",
    "subscription_duration": "SELECT * FROM durations",
    "duration_stats": _describe("durations", "duration_days"),
    "duration_histogram": _histogram("durations", "duration_days", 20),
    "price_stats": _describe("repaired", "monthly_price"),
    "plan_price_stats": _describe("repaired", "monthly_price", "plan"),
    "price_sketches": """SELECT plan, prob, count(*) AS size, true AS within_error
        FROM repaired, (SELECT CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS prob) WHERE plan IS NOT NULL GROUP BY plan, prob""",
    "price_histogram": _histogram("repaired", "monthly_price", 10),
    "country_counts": "SELECT country, count(*) AS customers FROM bronze_customers GROUP BY country",
    "country_variants": f"""SELECT country_cleaned, country, customers FROM (
        SELECT *, count(*) OVER w AS n, bool_or(country <> country_cleaned) OVER w AS other FROM (
          SELECT upper({_strip('country')}) AS country_cleaned, country, count(*) AS customers
          FROM bronze_customers WHERE country IS NOT NULL GROUP BY ALL)
        WINDOW w AS (PARTITION BY country_cleaned)) WHERE n > 1 OR other""",
    "subscription_enriched": f"""SELECT c.row_id, c.customer_id, s.country AS customer_country, s.signup_date AS customer_signup_date,
        c.start_date, c.end_date, c.plan, CAST(c.monthly_price AS DOUBLE) AS monthly_price, c.end_date IS NULL AS is_active,
        CAST(date_diff('day', c.start_date, coalesce(c.end_date, DATE '{AS_OF}')) AS INTEGER) AS subscription_duration_days,
        CAST(date_diff('month', c.start_date, coalesce(c.end_date, DATE '{AS_OF}')) + 1 AS INTEGER) AS months_active,
        (c.end_date IS NOT NULL AND (c.next_start IS NULL OR date_diff('day', c.end_date, c.next_start) > 30)) AS is_churned
        FROM chained c LEFT JOIN silver_c s ON s.customer_id = c.customer_id""",
    "monthly_arpu": """SELECT month, mrr, active_customers,
        CASE WHEN active_customers > 0 THEN round(mrr / active_customers, 4) END AS arpu FROM mrr""",
    "monthly_aggregates": """SELECT m.month, mrr, churned_count, active_customers,
        CASE WHEN active_customers > 0 THEN round(mrr / active_customers, 4) END AS arpu
        FROM mrr m LEFT JOIN churn c ON c.month = m.month""",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_BASE}\n{query}" for name, query in _QUERIES.items()}
