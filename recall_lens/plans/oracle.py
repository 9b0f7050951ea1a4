"""SQL twins of the registered queries, written against the given tables alone."""

from __future__ import annotations

# Derived feeds ---------------------------------------------------------------------------------------------------

FEEDS = """
parts AS (
  SELECT *, p_size % 10 AS band, p_brand || '-' || p_type || '-' || (p_size % 10) AS code,
         (CASE WHEN p_partkey % 2 = 0 THEN 'K' ELSE 'P' END) || printf('%06d', p_partkey) AS id
  FROM part
),
pma AS (
  SELECT id AS number, code, p_brand AS applicant, p_name AS generic_name,
         CASE WHEN p_size % 4 = 0 THEN '  ' ELSE p_name END AS trade_name
  FROM parts WHERE p_partkey % 2 <> 0
),
k510 AS (
  SELECT id AS number, code, p_brand AS applicant,
         CASE WHEN p_size % 5 = 0 THEN '  ' ELSE p_name END AS device_name, p_type AS k_type
  FROM parts WHERE p_partkey % 2 = 0
),
pcode AS (
  SELECT code, p_type AS medical_specialty, min(p_name) AS device_name,
         CASE WHEN band <= 2 THEN '1' WHEN band <= 5 THEN '2' WHEN band <= 7 THEN '3' ELSE 'U' END AS device_class
  FROM parts WHERE band <> 9 GROUP BY code, p_type, band
),
maude AS (
  SELECT l_orderkey || '-' || l_linenumber AS report,
         CASE WHEN l_linenumber <> 7 THEN id END AS number,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS adverse,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS problem,
         CAST(l_shipdate AS DATE) AS event_date,
         s_name AS maker, CASE WHEN l_linenumber % 2 = 1 THEN s_name END AS distributor
  FROM lineitem JOIN parts ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
recall AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, id AS number, CAST(l_orderkey AS VARCHAR) AS res_event_number,
         o_orderstatus AS recall_status, CAST(o_orderdate AS DATE) AS event_date_initiated,
         o_orderpriority AS reason_for_recall,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Software design' WHEN '2' THEN 'Device Design'
              WHEN '3' THEN 'Process control' WHEN '5' THEN 'Labeling' END AS root_cause_description
  FROM lineitem JOIN parts ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' AND l_discount >= 0.09
)"""

VIEW = (
    FEEDS
    + """,
p AS (SELECT number, code, applicant, generic_name, trade_name, count(*) AS n FROM pma GROUP BY ALL),
k AS (SELECT number, code, applicant, device_name, k_type, count(*) AS n FROM k510 GROUP BY ALL),
base AS MATERIALIZED (
  SELECT row_number() OVER () AS b, p.number AS p_number, p.code AS p_code, p.applicant AS p_applicant,
         p.generic_name, p.trade_name, k.number AS k_number, k.code AS k_code, k.applicant AS k_applicant,
         k.device_name AS k_name, k.k_type, coalesce(p.n, 1) * coalesce(k.n, 1) AS nb
  FROM p FULL JOIN k ON p.code = k.code
),
ids AS (
  SELECT b, p_number AS number FROM base WHERE p_number IS NOT NULL
  UNION SELECT b, k_number FROM base WHERE k_number IS NOT NULL
),
ev AS (
  SELECT b, count(DISTINCT report) AS reports, count(DISTINCT maker) AS makers,
         count(DISTINCT distributor) AS distributors, sum(adverse) AS adverse, sum(problem) AS problem,
         min(event_date) AS first_date, max(event_date) AS last_date
  FROM ids JOIN maude USING (number) GROUP BY b
),
codes AS (SELECT code, device_name, device_class, medical_specialty, count(*) AS n FROM pcode GROUP BY ALL),
rc AS (
  SELECT b, res_event_number, recall_status, event_date_initiated, reason_for_recall, root_cause_description,
         count(DISTINCT rid) AS n
  FROM ids JOIN recall USING (number) GROUP BY ALL
),
dev_view AS (
  SELECT coalesce(p_number, k_number) AS PMA_PMN_NUM, p_number AS pma_number, p_code AS pma_product_code,
         p_applicant AS pma_applicant, generic_name AS GENERICNAME, trade_name AS TRADENAME, k_number,
         k_code AS k_product_code, k_applicant, k_name AS k_devicename, k_type,
         CAST(coalesce(max(reports), 0) AS BIGINT) AS adverse_event_count,
         CAST(coalesce(sum(adverse * nb * coalesce(codes.n, 1) * coalesce(rc.n, 1)), 0) AS BIGINT)
           AS total_adverse_flag,
         CAST(coalesce(sum(problem * nb * coalesce(codes.n, 1) * coalesce(rc.n, 1)), 0) AS BIGINT)
           AS total_product_problem_flag,
         min(first_date) AS first_event_date, max(last_date) AS last_event_date,
         CAST(coalesce(max(makers), 0) AS BIGINT) AS unique_manufacturers,
         CAST(coalesce(max(distributors), 0) AS BIGINT) AS unique_distributors,
         codes.device_name AS pc_devicename, device_class AS DEVICECLASS, medical_specialty AS MEDICALSPECIALTY,
         res_event_number AS cfres_id, recall_status, event_date_initiated, reason_for_recall,
         root_cause_description
  FROM base LEFT JOIN ev USING (b) LEFT JOIN codes ON codes.code = coalesce(p_code, k_code)
       LEFT JOIN rc USING (b)
  GROUP BY p_number, p_code, p_applicant, generic_name, trade_name, k_number, k_code, k_applicant, k_name, k_type,
           codes.device_name, device_class, medical_specialty, res_event_number, recall_status,
           event_date_initiated, reason_for_recall, root_cause_description
)"""
)

FIRST_CAUSE = """
coalesce(arg_min(root_cause_description, struct_pack(d := event_date_initiated, e := {event},
  r := root_cause_description)) FILTER (WHERE root_cause_description IS NOT NULL), 'Other')"""

ROLLUP = (
    VIEW
    + f""",
rollup_rows AS (
  SELECT PMA_PMN_NUM, count(DISTINCT cfres_id) AS recall_count,
         CAST(sum(adverse_event_count) AS BIGINT) AS total_adverse_events,
         CAST(sum(unique_manufacturers) AS BIGINT) AS unique_manufacturers,
         max(TRY_CAST(DEVICECLASS AS DOUBLE)) AS device_class,
         min(first_event_date) AS first_event_date, max(last_event_date) AS last_event_date,
         {FIRST_CAUSE.format(event="cfres_id")} AS root_cause_description
  FROM dev_view WHERE PMA_PMN_NUM IS NOT NULL GROUP BY PMA_PMN_NUM
)"""
)

EXACT = (
    FEEDS
    + f""",
devices AS (SELECT number, code FROM pma UNION SELECT number, code FROM k510),
ev AS (
  SELECT number, count(DISTINCT report) AS reports, count(DISTINCT maker) AS makers,
         min(event_date) AS first_date, max(event_date) AS last_date
  FROM maude GROUP BY number
),
rc AS (
  SELECT number, count(DISTINCT res_event_number) AS recalls,
         {FIRST_CAUSE.format(event="res_event_number")} AS cause
  FROM recall GROUP BY number
),
classes AS (SELECT code, max(TRY_CAST(device_class AS DOUBLE)) AS device_class FROM pcode GROUP BY code),
rollup_exact AS (
  SELECT number AS PMA_PMN_NUM, coalesce(max(recalls), 0) AS recall_count,
         coalesce(max(reports), 0) AS total_adverse_events, coalesce(max(makers), 0) AS unique_manufacturers,
         max(device_class) AS device_class, min(first_date) AS first_event_date, max(last_date) AS last_event_date,
         coalesce(max(cause), 'Other') AS root_cause_description
  FROM devices LEFT JOIN ev USING (number) LEFT JOIN rc USING (number) LEFT JOIN classes USING (code)
  GROUP BY number
)"""
)


def _scoring(rollup: str, name: str) -> str:
    """Feature, limit, component and score steps over a rollup."""
    features = ("recurrence", "severity", "density", "recency", "class")
    limits = ", ".join(f"min({f}_raw) AS {f}_min, max({f}_raw) AS {f}_max" for f in features)
    scaled = ", ".join(
        f"CASE WHEN {f}_min = {f}_max THEN 0.0::DOUBLE "
        f"ELSE ({f}_raw - {f}_min) / ({f}_max - {f}_min + 1e-9) END AS {f}_score"
        for f in features
    )
    return f"""
{name}_raw AS MATERIALIZED (
  SELECT *, CAST(recall_count AS DOUBLE) AS recurrence_raw,
    CAST(CASE
      WHEN lower(root_cause_description) LIKE '%software design%' THEN 0.95
      WHEN lower(root_cause_description) LIKE '%software%' THEN 0.95
      WHEN lower(root_cause_description) LIKE '%design%' THEN 0.90
      WHEN lower(root_cause_description) LIKE '%process control%' THEN 0.80
      WHEN lower(root_cause_description) LIKE '%manufacturing%' THEN 0.80
      WHEN lower(root_cause_description) LIKE '%nonconforming material/component%' THEN 0.75
      WHEN lower(root_cause_description) LIKE '%packaging%' THEN 0.60
      WHEN lower(root_cause_description) LIKE '%labeling%' THEN 0.45
      WHEN lower(root_cause_description) LIKE '%mixed-up of materials/components%' THEN 0.40
      WHEN lower(root_cause_description) LIKE '%equipment maintenance%' THEN 0.40
      WHEN lower(root_cause_description) LIKE '%other%' THEN 0.50
      WHEN lower(root_cause_description) LIKE '%under investigation by firm%' THEN 0.55
      ELSE 0.50 END AS DOUBLE) AS severity_raw,
    CAST(total_adverse_events AS DOUBLE) / greatest(unique_manufacturers, 1) AS density_raw,
    coalesce(date_diff('day', first_event_date, last_event_date), 0) AS span,
    CASE WHEN coalesce(date_diff('day', first_event_date, last_event_date), 0) <= 0 THEN 0.0::DOUBLE
         ELSE 1.0::DOUBLE / date_diff('day', first_event_date, last_event_date) END AS recency_raw,
    CAST(CASE trunc(device_class) WHEN 3 THEN 1.0 WHEN 2 THEN 0.7 WHEN 1 THEN 0.4 ELSE 0.5 END AS DOUBLE)
      AS class_raw
  FROM {rollup}
),
{name}_limits AS (SELECT {limits} FROM {name}_raw),
{name}_parts AS (SELECT r.*, {scaled} FROM {name}_raw r, {name}_limits),
{name}_total AS (
  SELECT *, least(greatest(recurrence_score * 0.30::DOUBLE + severity_score * 0.30::DOUBLE
    + density_score * 0.20::DOUBLE + recency_score * 0.10::DOUBLE + class_score * 0.10::DOUBLE, 0), 1) AS rpss
  FROM {name}_parts
),
{name} AS MATERIALIZED (
  SELECT PMA_PMN_NUM, recall_count, total_adverse_events, unique_manufacturers, device_class,
         root_cause_description, rpss,
         CASE WHEN rpss <= 0.25 THEN 'Low' WHEN rpss <= 0.50 THEN 'Medium' WHEN rpss <= 0.75 THEN 'High'
              ELSE 'Critical' END AS rpss_category
  FROM {name}_total
)"""


SCORED = ROLLUP + "," + _scoring("rollup_rows", "scored")
SCORED_EXACT = EXACT + "," + _scoring("rollup_exact", "scored_exact")
# Both: the exact steps follow without their own feeds and with their own names for events and recalls.
BOTH = (
    SCORED
    + ","
    + EXACT[len(FEEDS) + 1 :]
    .replace("ev AS (", "ev1 AS (")
    .replace("JOIN ev USING", "JOIN ev1 USING")
    .replace("rc AS (", "rc1 AS (")
    .replace("JOIN rc USING", "JOIN rc1 USING")
    + ","
    + _scoring("rollup_exact", "scored_exact")
)

NAMES = """
names AS (
  SELECT PMA_PMN_NUM, max(coalesce(nullif(rtrim(k_devicename), ''), nullif(rtrim(pc_devicename), ''),
         nullif(rtrim(GENERICNAME), ''), nullif(rtrim(TRADENAME), ''))) AS device_name
  FROM dev_view WHERE PMA_PMN_NUM IS NOT NULL GROUP BY PMA_PMN_NUM
)"""

SNAPSHOT = """
snapshot AS (
  SELECT s.PMA_PMN_NUM, rpss, rpss_category, recall_count, total_adverse_events,
         unique_manufacturers AS "unique-manufacturers", device_class, root_cause_description,
         TIMESTAMP '2025-01-01 00:00:00' AS last_scored, coalesce(device_name, '—') AS device_name
  FROM (SELECT * FROM scored ORDER BY rpss DESC, PMA_PMN_NUM LIMIT 50000) s LEFT JOIN names USING (PMA_PMN_NUM)
)"""

CHOSEN = """rpss BETWEEN 0.2 AND 0.9 AND coalesce(recall_count, 0) >= 1
  AND rpss_category IN ('Medium', 'High', 'Critical') AND device_class IN (1, 2, 3)"""


def _select(ctes: str, body: str, doubles: tuple[str, ...] = ()) -> str:
    """A query over the steps, its double columns rounded to six digits."""
    if not doubles:
        return f"WITH {ctes.strip()}\n{body}"
    replaced = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return f"WITH {ctes.strip()}\nSELECT * REPLACE ({replaced}) FROM (\n{body}\n)"


# Series and forecasts --------------------------------------------------------------------------------------------

DATED = (
    SCORED
    + """,
dated AS (
  SELECT PMA_PMN_NUM, rpss_category, recall_count,
         CAST(DATE '2023-01-01' + to_months(CAST(CASE WHEN recall_count > 0
             THEN least(greatest(trunc(12 * (1 - recall_count::DOUBLE / (recall_count + 20))), 0), 11)
             ELSE 12 + ('0x' || substr(md5(PMA_PMN_NUM), 1, 8))::BIGINT % 12 END AS INTEGER)) AS DATE)
           + CAST(1 + ('0x' || substr(md5(PMA_PMN_NUM), 9, 8))::BIGINT % 27 AS INTEGER) AS last_scored
  FROM scored
)"""
)

SERIES = (
    DATED
    + """,
sized AS (SELECT *, greatest(least(recall_count, 12), 3) AS n FROM dated),
dealt AS (
  SELECT CAST(date_trunc('month', last_scored) - to_months(CAST(m AS INTEGER)) AS DATE) AS period,
         rpss_category AS category,
         CASE WHEN recall_count > 0 THEN (recall_count::DOUBLE / n) * ((n - m)::DOUBLE / n) ELSE 0 END AS recalls,
         CASE WHEN m = 0 THEN 1 ELSE 0 END AS devices
  FROM (SELECT *, unnest(range(CASE WHEN recall_count > 0 THEN n ELSE 1 END)) AS m FROM sized)
),
series AS MATERIALIZED (
  SELECT strftime(period, '%Y-%m') AS period,
         CASE WHEN GROUPING(category) = 1 THEN 'All' ELSE category END AS category,
         CAST(sum(recalls) AS DOUBLE) AS total_recalls, CAST(sum(devices) AS BIGINT) AS device_count,
         dealt.period AS date
  FROM dealt GROUP BY GROUPING SETS ((dealt.period), (dealt.period, category))
  HAVING GROUPING(category) = 1 OR category IS NOT NULL
)"""
)


def _plain(unit: str, label: str) -> str:
    return (
        DATED
        + f""",
plain AS MATERIALIZED (
  SELECT {label} AS period, CASE WHEN GROUPING(rpss_category) = 1 THEN 'All' ELSE rpss_category END AS category,
         CAST(sum(recall_count) AS DOUBLE) AS total_recalls, count(PMA_PMN_NUM) AS device_count, d AS date
  FROM (SELECT *, CAST(date_trunc('{unit}', last_scored) AS DATE) AS d FROM dated)
  GROUP BY GROUPING SETS ((d), (d, rpss_category)) HAVING GROUPING(rpss_category) = 1 OR rpss_category IS NOT NULL
)"""
    )


def _forecast(method: str, alignment: str = "month_start") -> str:
    last = "max(date)" if alignment == "month_start" else "CAST(max(date) - INTERVAL 1 MONTH AS DATE)"
    value = "coalesce(o.observed, 0)" if alignment == "month_start" else "0.0"
    step_value = {
        "moving_average": "CASE WHEN recent_mean = 0 THEN mean ELSE recent_mean END",
        "last_value": "last_value",
        "smoothed": "smoothed",
        "linear_trend": "greatest(intercept + slope * (length + step - 1), 0, recent_mean * 0.5)",
    }[method]
    return (
        SERIES
        + f""",
ranges AS (
  SELECT category, avg(total_recalls) AS baseline,
         CASE WHEN date_diff('day', min(date), max(date)) < 60 THEN CAST(max(date) - INTERVAL 2 MONTH AS DATE)
              ELSE min(date) END AS first, {last} AS last
  FROM series GROUP BY category HAVING count(*) >= 2
),
months AS (
  SELECT category, baseline,
         CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
           AS month
  FROM ranges
),
spine AS (
  SELECT m.category, m.baseline, m.month, CAST({value} AS DOUBLE) AS value
  FROM months m LEFT JOIN (SELECT category, date AS month, sum(total_recalls) AS observed FROM series GROUP BY ALL) o
    ON o.category = m.category AND o.month = m.month
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS from_end,
         count(*) OVER (PARTITION BY category) AS length, sum(value) OVER (PARTITION BY category) AS total
  FROM spine
),
rescued AS (
  SELECT category, month, from_end, length,
         CASE WHEN total <> 0 THEN value
              WHEN baseline > 0 THEN CASE WHEN from_end <= least(length, 3)
                   THEN baseline * power(0.9::DOUBLE, from_end - 1) / least(length, 3) ELSE 0 END
              WHEN from_end = 1 THEN 1 ELSE 0 END AS value
  FROM placed
),
shape AS (
  SELECT category, count(*) AS length, max(month) AS last_month, sum(value) AS total, avg(value) AS mean,
         avg(value) FILTER (WHERE from_end <= 3) AS recent_mean,
         max(value) FILTER (WHERE from_end = 1) AS last_value,
         sum(value * power(0.7::DOUBLE, from_end - 1) * CASE WHEN from_end = length THEN 1 ELSE 0.3::DOUBLE END) AS smoothed,
         regr_slope(value, length - from_end) FILTER (WHERE from_end <= 3) AS slope,
         regr_intercept(value, length - from_end) FILTER (WHERE from_end <= 3) AS intercept
  FROM rescued GROUP BY category
),
stepped AS (SELECT *, unnest(range(1, 7)) AS step FROM shape),
valued AS (
  SELECT category, recent_mean, total, last_day(CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE)) AS date,
         CASE WHEN length = 1 THEN last_value ELSE {step_value} END AS v
  FROM stepped
),
forecasts AS MATERIALIZED (
  SELECT date, category, forecasted_recalls, forecasted_recalls * 0.7::DOUBLE AS lower_bound,
         forecasted_recalls * 1.3::DOUBLE AS upper_bound
  FROM (SELECT *, greatest(coalesce(CASE WHEN v = 0 AND total > 0 AND recent_mean > 0 THEN recent_mean ELSE v END,
               0), 0) AS forecasted_recalls FROM valued)
)"""
    )


FORECAST_DOUBLES = ("forecasted_recalls", "lower_bound", "upper_bound")
FORECAST_BODY = "SELECT date, category, forecasted_recalls, lower_bound, upper_bound FROM forecasts"
SERIES_BODY = "SELECT period, category, total_recalls, device_count, date FROM {}"


def _forecast_query(method: str, alignment: str = "month_start") -> str:
    return _select(_forecast(method, alignment), FORECAST_BODY, FORECAST_DOUBLES)


TREND = """
SELECT category, total_periods, CAST(trunc(round(total, 9)) AS BIGINT) AS total_recalls, avg_per_period,
       (last - first) / total_periods AS trend_slope,
       CASE WHEN total_periods >= 3 THEN (last - third) / 3 ELSE (last - first) / total_periods END AS recent_trend,
       volatility, CAST(trunc(round(high, 9)) AS BIGINT) AS peak, CAST(trunc(round(low, 9)) AS BIGINT) AS trough,
       CASE WHEN total_periods >= 3 THEN (last - third) / 3 ELSE (last - first) / total_periods END > 0
         AS is_increasing
FROM (
  SELECT category, count(*) AS total_periods, sum(total_recalls) AS total, avg(total_recalls) AS avg_per_period,
         max(total_recalls) FILTER (WHERE a = 1) AS first, max(total_recalls) FILTER (WHERE z = 1) AS last,
         max(total_recalls) FILTER (WHERE z = 3) AS third, stddev_pop(total_recalls) AS volatility,
         max(total_recalls) AS high, min(total_recalls) AS low
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY date, total_recalls) AS a,
               row_number() OVER (PARTITION BY category ORDER BY date DESC, total_recalls DESC) AS z FROM series)
  GROUP BY category HAVING count(*) >= 2
)"""

PADDED = """
SELECT strftime(d, '%Y') AS period, category, total_recalls * power(0.8::DOUBLE, shift) AS total_recalls,
       device_count, d AS date
FROM (
  SELECT *, CAST(date - CAST(30 * shift AS INTEGER) AS DATE) AS d
  FROM (SELECT *, unnest(range(1 + greatest(3 - (SELECT count(DISTINCT period) FROM plain), 0))) AS shift FROM plain)
)"""

KPIS = """
SELECT matching AS devices_matching, matching - devices AS devices_delta, {mean} AS avg_rpss,
       {mean} - baseline AS avg_rpss_delta, critical_count,
       coalesce(critical_count::DOUBLE / nullif(matching, 0), 0) * 100 AS critical_pct, total_recalls,
       coalesce(total_recalls::DOUBLE / nullif(matching, 0), 0) AS avg_recalls, total_adverse,
       coalesce(total_adverse::DOUBLE / nullif(matching, 0), 0) AS avg_adverse,
       CASE WHEN total_adverse > 1000000000 THEN printf('%.2fB', total_adverse / 1e9)
            WHEN total_adverse > 1000000 THEN printf('%.2fM', total_adverse / 1e6)
            ELSE format('{{:,}}', total_adverse) END AS adverse_text
FROM (
  SELECT count(*) AS devices, avg(rpss) AS baseline, count(*) FILTER (WHERE hit) AS matching,
         coalesce(avg(rpss) FILTER (WHERE hit), 0) AS mean,
         count(*) FILTER (WHERE hit AND rpss_category = 'Critical') AS critical_count,
         CAST(coalesce(sum(recall_count) FILTER (WHERE hit), 0) AS BIGINT) AS total_recalls,
         CAST(coalesce(sum(total_adverse_events) FILTER (WHERE hit), 0) AS BIGINT) AS total_adverse
  FROM (SELECT *, coalesce({chosen}, FALSE) AS hit FROM scored)
)"""
LIMITED_MEAN = f"""(SELECT coalesce(avg(rpss), 0) FROM (SELECT rpss FROM scored WHERE {CHOSEN}
  ORDER BY rpss DESC, PMA_PMN_NUM LIMIT 100))"""
KPI_DOUBLES = ("avg_rpss", "avg_rpss_delta", "critical_pct", "avg_recalls", "avg_adverse")


def _causes(condition: str, devices: str, least: int) -> str:
    return f"""
SELECT root_cause_description, avg(rpss) AS avg_rpss, {devices} AS device_count,
       CAST(sum(recall_count) AS BIGINT) AS total_recalls, CAST(sum(total_adverse_events) AS BIGINT) AS total_adverse
FROM scored WHERE {condition} AND root_cause_description <> 'Other'
GROUP BY root_cause_description HAVING {devices} >= {least}
ORDER BY avg_rpss DESC, root_cause_description LIMIT 10"""


SCORED_COLUMNS = """PMA_PMN_NUM, recall_count, total_adverse_events, unique_manufacturers, device_class,
       root_cause_description, rpss, rpss_category"""

COMPONENTS = """
SELECT PMA_PMN_NUM, recall_count, total_adverse_events, unique_manufacturers, device_class, recurrence_raw,
       severity_raw AS root_cause_raw, density_raw, CAST(span AS INTEGER) AS timespan_days, recency_raw,
       class_raw AS device_class_raw, recurrence_score, severity_score AS reason_severity_score,
       density_score AS adverse_density_score, recency_score, class_score AS device_class_score
FROM scored_parts"""

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
NA_LIST = """'#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>',
  'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"""


def _clean(c: str) -> str:
    return f"CASE WHEN {c} IN ({NA_LIST}) THEN NULL ELSE nullif(trim({c}, {BLANKS}), '') END AS {c}"


ORACLE: dict[str, str] = {
    "integrated_view": _select(VIEW, "SELECT * FROM dev_view"),
    "device_rollup": _select(ROLLUP, "SELECT * FROM rollup_rows"),
    "device_rollup_exact": _select(EXACT, "SELECT * FROM rollup_exact"),
    "rpss_components": _select(
        SCORED,
        COMPONENTS,
        (
            "recurrence_score", "reason_severity_score", "adverse_density_score", "recency_score",
            "device_class_score",
        ),
    ),
    "rpss_scores": _select(SCORED, "SELECT * FROM scored", ("rpss",)),
    "rpss_scores_exact": _select(SCORED_EXACT, "SELECT * FROM scored_exact", ("rpss",)),
    "dedup_staging": _select(
        BOTH,
        f"""SELECT {SCORED_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY PMA_PMN_NUM ORDER BY rpss DESC, recall_count DESC,
    total_adverse_events DESC, unique_manufacturers DESC, device_class DESC NULLS LAST,
    root_cause_description DESC) AS rn
  FROM (SELECT * FROM scored UNION ALL SELECT * FROM scored_exact)) WHERE rn = 1""",
        ("rpss",),
    ),
    "upsert_scores": _select(
        BOTH,
        f"""SELECT {SCORED_COLUMNS}, TIMESTAMP '2024-01-01 00:00:00' AS last_scored
FROM scored_exact t WHERE total_adverse_events > 0
  AND NOT EXISTS (SELECT 1 FROM scored s WHERE s.recall_count > 0 AND s.PMA_PMN_NUM = t.PMA_PMN_NUM)
UNION ALL SELECT {SCORED_COLUMNS}, TIMESTAMP '2025-01-01 00:00:00' FROM scored WHERE recall_count > 0""",
        ("rpss",),
    ),
    "scored_view": _select(
        SCORED, "SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS last_scored FROM scored", ("rpss",)
    ),
    "device_names": _select(
        VIEW + "," + NAMES, "SELECT PMA_PMN_NUM, coalesce(device_name, '—') AS device_name FROM names"
    ),
    "export_snapshot": _select(SCORED + "," + NAMES + "," + SNAPSHOT, "SELECT * FROM snapshot", ("rpss",)),
    "name_coverage": _select(
        SCORED + "," + NAMES + "," + SNAPSHOT,
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE trim(device_name) <> '—') AS named_rows FROM snapshot",
    ),
    "summary_stats": _select(
        SCORED,
        """SELECT count(*) AS total_devices, avg(rpss) AS avg_rpss, CAST(sum(recall_count) AS BIGINT) AS total_recalls,
  CAST(sum(total_adverse_events) AS BIGINT) AS total_adverse,
  count(*) FILTER (WHERE rpss_category = 'Critical') AS critical_count,
  count(*) FILTER (WHERE rpss_category = 'High') AS high_count,
  count(*) FILTER (WHERE rpss_category = 'Medium') AS medium_count,
  count(*) FILTER (WHERE rpss_category = 'Low') AS low_count,
  max(total_adverse_events) AS max_adverse_single_device FROM scored""",
        ("avg_rpss",),
    ),
    "filter_options": _select(
        SCORED,
        """SELECT DISTINCT rpss_category, device_class, root_cause_description
FROM scored WHERE rpss_category IS NOT NULL""",
    ),
    "filtered_devices": _select(
        SCORED,
        f"SELECT {SCORED_COLUMNS} FROM scored WHERE {CHOSEN} ORDER BY rpss DESC, PMA_PMN_NUM LIMIT 1000",
        ("rpss",),
    ),
    "filtered_count": _select(SCORED, f"SELECT count(*) AS cnt FROM scored WHERE {CHOSEN}"),
    "risk_distribution": _select(
        SCORED,
        f"""SELECT rpss_category, count(*) AS count, CAST(sum(recall_count) AS BIGINT) AS total_recalls,
  CAST(sum(total_adverse_events) AS BIGINT) AS total_adverse FROM scored WHERE {CHOSEN} GROUP BY rpss_category""",
    ),
    "risk_share": _select(
        SCORED,
        """SELECT position, d.rpss_category, count, share, printf('%.1f%%', share * 100) AS share_text FROM (
  SELECT d.position, d.rpss_category, count(s.PMA_PMN_NUM) AS count,
         coalesce(count(s.PMA_PMN_NUM)::DOUBLE / nullif((SELECT count(*) FROM scored), 0), 0) AS share
  FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High'), (3, 'Critical')) d(position, rpss_category)
  LEFT JOIN scored s ON s.rpss_category = d.rpss_category GROUP BY ALL) d""",
        ("share",),
    ),
    "root_cause_impact": _select(SCORED, _causes(CHOSEN, "count(DISTINCT PMA_PMN_NUM)", 5), ("avg_rpss",)),
    "root_cause_impact_rows": _select(
        SCORED, _causes("rpss BETWEEN 0 AND 1", "count(PMA_PMN_NUM)", 0), ("avg_rpss",)
    ),
    "kpis": _select(SCORED, KPIS.format(mean="mean", chosen=CHOSEN), KPI_DOUBLES),
    "kpis_limited_mean": _select(SCORED, KPIS.format(mean=LIMITED_MEAN, chosen=CHOSEN), KPI_DOUBLES),
    "score_bands": _select(
        SCORED,
        """SELECT CASE WHEN rpss <= 0 OR rpss > 1 THEN NULL ELSE rpss_category END AS band, count(*) AS devices,
  min(rpss) AS lowest, max(rpss) AS highest FROM scored GROUP BY ALL""",
        ("lowest", "highest"),
    ),
    "assign_dates": _select(DATED, "SELECT PMA_PMN_NUM, recall_count, last_scored FROM dated"),
    "synthetic_dates": _select(
        SCORED,
        """SELECT PMA_PMN_NUM, DATE '2025-01-01' - CAST(count(*) OVER ()
  - row_number() OVER (ORDER BY md5(PMA_PMN_NUM), PMA_PMN_NUM) AS INTEGER) AS synthetic_date FROM scored""",
    ),
    "ts_distributed": _select(SERIES, SERIES_BODY.format("series"), ("total_recalls",)),
    "ts_plain": _select(_plain("month", "strftime(d, '%Y-%m')"), SERIES_BODY.format("plain"), ("total_recalls",)),
    "ts_text_dates": _select(
        _plain("month", "strftime(d, '%Y-%m')").replace("FROM dated", "FROM dated WHERE recall_count > 0"),
        SERIES_BODY.format("plain"),
        ("total_recalls",),
    ),
    "ts_quarterly": _select(
        _plain("quarter", "strftime(d, '%Y') || 'Q' || quarter(d)"), SERIES_BODY.format("plain"), ("total_recalls",)
    ),
    "ts_padded": _select(_plain("year", "strftime(d, '%Y')"), PADDED, ("total_recalls",)),
    "trailing_mean": _select(
        SERIES,
        """SELECT period, category, total_recalls, device_count, date, avg(total_recalls) OVER (PARTITION BY category
  ORDER BY date, total_recalls ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS trailing_mean FROM series""",
        ("total_recalls", "trailing_mean"),
    ),
    "trend_analysis": _select(SERIES, TREND, ("avg_per_period", "trend_slope", "recent_trend", "volatility")),
    "monthly_spine": _select(
        _forecast("moving_average"), "SELECT category, baseline, month, value FROM spine", ("baseline", "value")
    ),
    "forecast_moving_average": _forecast_query("moving_average"),
    "forecast_last_value": _forecast_query("last_value"),
    "forecast_exponential_smoothing": _forecast_query("last_value"),
    "forecast_smoothed": _forecast_query("smoothed"),
    "forecast_linear_trend": _forecast_query("linear_trend"),
    "forecast_month_end_parity": _forecast_query("moving_average", "month_end"),
    "forecast_linear_month_end_parity": _forecast_query("linear_trend", "month_end"),
    "forecast_summary": _select(
        _forecast("moving_average")
        + """,
totals AS (SELECT category, CAST(round_even(round(sum(forecasted_recalls), 9), 0) AS BIGINT) AS total
           FROM forecasts GROUP BY category)""",
        """SELECT category, total AS total_forecasted_recalls,
  CAST((SELECT sum(total) FROM totals) AS BIGINT) AS grand_total,
  category = (SELECT category FROM totals WHERE category <> 'All' ORDER BY total DESC, category DESC LIMIT 1)
    AS is_leader
FROM totals ORDER BY total DESC, category""",
    ),
    "history_and_forecast": _select(
        _forecast("moving_average"),
        """SELECT 'history' AS kind, category, date, total_recalls AS recalls, CAST(NULL AS DOUBLE) AS lower_bound,
  CAST(NULL AS DOUBLE) AS upper_bound FROM series WHERE category IN (SELECT category FROM forecasts)
UNION ALL SELECT 'forecast', category, date, forecasted_recalls, lower_bound, upper_bound FROM forecasts""",
        ("recalls", "lower_bound", "upper_bound"),
    ),
    "clean_text": f"SELECT doc_id, {_clean('text')}, {_clean('source')} FROM documents",
    "ingest_delimited": """SELECT 'K' || p_partkey AS KNUMBER, p_name AS DEVICENAME, upper(p_brand) AS PRODUCTCODE,
  p_type AS APPLICANT, CAST(DATE '2020-01-01' + CAST(p_size AS INTEGER) AS DATE) AS DECISIONDATE FROM part""",
    "ingest_encodings": """SELECT doc_id, CAST(length(name) AS INTEGER) AS chars, md5(name) AS digest FROM (
  SELECT doc_id, 'a' || regexp_replace(coalesce(text, ''), '[^\\x20-\\x7e\\xa0-\\xff]', ' ', 'g') || 'z'
    || CASE ((doc_id % 3) + 3) % 3 WHEN 0 THEN '日€' WHEN 1 THEN '€œ' ELSE chr(129) END AS name FROM documents)""",
    "ingest_recalls": """SELECT CAST(o_orderkey AS VARCHAR) AS cfres_id,
  'K' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ',K' || (o_custkey + 1) ELSE '' END AS k_numbers,
  CAST(o_orderdate AS DATE) AS event_date_initiated FROM orders""",
    "ingest_document": """SELECT CAST(o_orderkey AS VARCHAR) AS cfres_id,
  '} ], "results": [{ \\ ' || o_orderpriority || chr(10) || '"{' AS action, 'K' || o_custkey AS k_numbers,
  '{"results":[{"status":"' || o_orderstatus || '"}]}' AS openfda, CAST(o_orderdate AS DATE) AS event_date_initiated FROM orders""",
    "eval_confusion": """SELECT a AS actual, p AS predicted,
  (SELECT count(*) FROM labels WHERE quality = a AND toxic = p) AS rows
  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS cells(a, p)""",
    "eval_report": """WITH c AS (
  SELECT CAST(count(*) FILTER (quality = 0 AND toxic = 0) AS DOUBLE) AS n00,
         CAST(count(*) FILTER (quality = 0 AND toxic = 1) AS DOUBLE) AS n01,
         CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) AS n10,
         CAST(count(*) FILTER (quality = 1 AND toxic = 1) AS DOUBLE) AS n11 FROM labels
), r AS (
  SELECT 'No Recall' AS metric, n00 / (n00 + n10) AS precision, n00 / (n00 + n01) AS recall, n00 + n01 AS support FROM c
  UNION ALL SELECT 'Has Recall', n11 / (n11 + n01), n11 / (n11 + n10), n10 + n11 FROM c
), f AS (SELECT *, 2 * precision * recall / (precision + recall) AS value FROM r)
SELECT metric, round(precision, 6) AS precision, round(recall, 6) AS recall, round(value, 6) AS value,
       CAST(support AS BIGINT) AS support FROM (
  SELECT metric, precision, recall, value, support FROM f
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(value), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(value * support) / sum(support), sum(support) FROM f
  UNION ALL SELECT 'accuracy', NULL, NULL, (n00 + n11) / (n00 + n01 + n10 + n11), n00 + n01 + n10 + n11 FROM c
  UNION ALL SELECT 'auc', NULL, NULL,
                   (n11 * n00 + (n11 * n01 + n10 * n00) / 2) / ((n10 + n11) * (n00 + n01)), n00 + n01 + n10 + n11 FROM c
)""",
    "clean_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 16 <> 15
  THEN CAST(o_orderdate AS DATE) END AS order_day FROM orders""",
    "truncate_columns": """SELECT doc_id, substr(concat_ws('/', source, lang, md5(text)), 1, 20) AS KNUMBER,
  substr(text, 1, 1000) AS DEVICENAME, text AS STATEORSUMM FROM documents""",
    "numeric_coerce": """SELECT event_id, TRY_CAST(props ->> '$.k' AS DOUBLE) AS k,
  TRY_CAST(event_type AS DOUBLE) AS not_a_number FROM events""",
    "clean_json": """SELECT event_id, '{"k":' || CAST((props ->> '$.k')::BIGINT AS VARCHAR) || '}' AS props,
  CASE WHEN event_type IN ('', ' ') THEN NULL ELSE trim(event_type) END AS event_type FROM events""",
    "flat_recalls": _select(
        FEEDS,
        """SELECT res_event_number AS cfres_id, res_event_number, '["' || number || '"]' AS k_numbers,
  CAST(event_date_initiated AS VARCHAR) AS event_date_initiated, recall_status, reason_for_recall,
  root_cause_description FROM recall""",
    ),
    "ml_features": _select(
        SCORED,
        """SELECT PMA_PMN_NUM, coalesce(rpss, 0) AS rpss, coalesce(device_class, 0) AS device_class,
  CAST(dense_rank() OVER (ORDER BY coalesce(root_cause_description, 'Other')) - 1 AS DOUBLE) AS root_cause_encoded,
  ln(1 + coalesce(total_adverse_events, 0)::DOUBLE) AS log_adverse_events,
  ln(1 + coalesce(unique_manufacturers, 0)::DOUBLE) AS log_manufacturers,
  CASE WHEN coalesce(recall_count, 0) > 0 THEN 1 ELSE 0 END AS has_recall FROM scored""",
        ("rpss", "log_adverse_events", "log_manufacturers"),
    ),
    "ml_split": _select(
        SCORED,
        """SELECT PMA_PMN_NUM, has_recall, rn > round(n * 0.8) AS is_test FROM (
  SELECT *, row_number() OVER (PARTITION BY has_recall ORDER BY md5(PMA_PMN_NUM), PMA_PMN_NUM) AS rn,
         count(*) OVER (PARTITION BY has_recall) AS n
  FROM (SELECT PMA_PMN_NUM, CASE WHEN recall_count > 0 THEN 1 ELSE 0 END AS has_recall FROM scored))""",
    ),
}

ORACLE |= {
    "upsert_bucketed": ORACLE["upsert_scores"],
    "names_lookup": _select(
        SCORED + "," + NAMES,
        """SELECT t.PMA_PMN_NUM, n.device_name FROM ((SELECT PMA_PMN_NUM FROM scored ORDER BY rpss DESC, PMA_PMN_NUM LIMIT 20)
  UNION ALL SELECT 'no such device') t LEFT JOIN names n USING (PMA_PMN_NUM)""",
    ),
    "rollup_incremental": ORACLE["device_rollup"],
    "rollup_exact_incremental": ORACLE["device_rollup_exact"],
    "ingest_adverse_events": """SELECT CAST(event_id AS VARCHAR) AS MDR_REPORT_KEY, 'K' || user_id AS PMA_PMN_NUM,
  CAST(ts AS DATE) AS DATE_OF_EVENT, '"Gerät" é " ' || event_type AS MANUFACTURER_NAME,
  CASE WHEN event_type <> 'error' THEN props END AS DISTRIBUTOR_NAME FROM events""",
    "snapshot_file": """SELECT 'K' || c_custkey AS PMA_PMN_NUM, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS rpss,
  c_mktsegment AS rpss_category, CAST(c_nationkey AS DOUBLE) AS recall_count, TIMESTAMP '2024-05-01' AS last_scored,
  0 AS unique_manufacturers, 'K' || c_custkey AS device_name FROM customer""",
    "chosen_columns": """SELECT 'K' || c_custkey AS PMA_PMN_NUM, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS rpss,
  c_nationkey AS events FROM customer""",
    "appended_and_refreshed": """SELECT *, 'appended' AS kind FROM nation UNION ALL SELECT *, 'appended' FROM nation
  UNION ALL SELECT *, 'refreshed' FROM nation""",
    "contract_report": """SELECT 'extra' AS finding, unnest(['text', 'lang', 'n_chars']) AS column_name
UNION ALL SELECT 'wrong_type', 'KNUMBER'
UNION ALL SELECT 'missing', unnest(['CONTACT', 'STREET1', 'STREET2', 'CITY', 'STATE', 'COUNTRY_CODE', 'ZIP', 'POSTAL_CODE',
  'DATERECEIVED', 'DECISIONDATE', 'DECISION', 'REVIEWADVISECOMM', 'PRODUCTCODE', 'STATEORSUMM', 'CLASSADVISECOMM',
  'SSPINDICATOR', 'TYPE', 'THIRDPARTY', 'EXPEDITEDREVIEW', 'DEVICENAME'])""",
    "load_ledger": """WITH n AS (SELECT count(*) FILTER (event_id % 2 = 0) AS even, count(*) FILTER (event_id % 2 = 1) AS odd FROM events)
SELECT 'even' AS load_id, 'loaded' AS status, 1 AS attempts, even AS rows FROM n UNION ALL SELECT 'even', 'replayed', 1, NULL FROM n
UNION ALL SELECT 'odd', 'failed', 1, NULL FROM n UNION ALL SELECT 'odd', 'loaded', 1, odd FROM n
UNION ALL SELECT 'all', 'in the table', NULL, even + odd FROM n""",
    "ingest_set": """SELECT 'pma' AS feed, 'P' || p_partkey AS number FROM part
UNION ALL SELECT 'premarket_510k', 'K' || p_partkey FROM part
UNION ALL SELECT DISTINCT 'product_code', upper(p_brand) FROM part
UNION ALL SELECT 'maude', CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT 'recall', CAST(o_orderkey AS VARCHAR) FROM orders""",
}
