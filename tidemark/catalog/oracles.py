"""The registered queries written a second time, in DuckDB SQL."""

from __future__ import annotations

from tidemark.catalog.bindings import BOUNDS, EVENT_VALUE
from tidemark.catalog.settings import (
    CURVE_POINTS,
    FIXED_INTERCEPT,
    FIXED_WEIGHTS,
    PRIOR_WEIGHTS,
    TEST_THRESHOLD,
    TOP_ERRORS,
)
from tidemark.spec import (
    CATEGORICAL_FEATURES,
    CLASS_NAMES,
    ENTITIES,
    FIELD_HEADERS,
    NUMERIC_FEATURES,
    PREDICTION_COLUMNS,
    ModelGrid,
)

THRESHOLDS = ModelGrid().thresholds

RAW = """
line AS (
  SELECT l_orderkey, l_partkey AS pk, l_linenumber AS ln, CAST(l_quantity AS BIGINT) AS q,
         CAST(l_shipdate AS DATE) AS d, sn.n_nationkey AS nk, sn.n_name AS sn, cn.n_name AS cn
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation AS sn ON s_nationkey = sn.n_nationkey
  JOIN nation AS cn ON c_nationkey = cn.n_nationkey),
shifted AS (
  SELECT *, 0 AS shift FROM line UNION ALL SELECT *, 1 AS shift FROM line WHERE ln = 1),
raw AS (
  SELECT
    CASE WHEN pk % 97 = 0 THEN 'not-a-date'
         WHEN ln % 3 = 0 THEN strftime(d, '%Y-%m-%d')
         WHEN ln % 3 = 1 THEN strftime(d, '%-m/%-d/%Y')
         ELSE strftime(d, '%Y%m%d') END AS flight_date_raw,
    CASE WHEN pk % 89 = 0 THEN '  ' ELSE ' ' || lower(sn) || ' ' END AS carrier,
    CAST(l_orderkey AS VARCHAR) AS flight_number,
    lower(sn) AS origin,
    cn AS dest,
    CASE WHEN pk % 83 = 0 THEN '2560' WHEN pk % 79 = 0 THEN '2400' WHEN pk % 73 = 0 THEN '900.0'
         WHEN pk % 43 = 0 THEN chr(9) || CAST((pk % 24) * 100 AS VARCHAR) || chr(9) || ' '
         WHEN pk % 41 = 0 THEN '.5'
         ELSE CAST((pk % 24) * 100 + q % 60 AS VARCHAR) END AS crs_dep_time_raw,
    CAST(((pk + 3) % 24) * 100 + ln AS VARCHAR) AS crs_arr_time_raw,
    CASE WHEN pk % 71 = 0 THEN '0' ELSE CAST(60 + 5 * q AS VARCHAR) END AS crs_elapsed_time_raw,
    CASE WHEN pk % 67 = 0 THEN '' ELSE CAST(100 + pk % 2000 AS VARCHAR) END AS distance_raw,
    CASE WHEN pk % 61 = 0 THEN '' ELSE CAST(q + 2 * (nk % 7) - 30 + shift AS VARCHAR) END
      AS arr_delay_raw,
    CASE WHEN pk % 47 = 0 THEN '' WHEN pk % 59 = 0 THEN '1' ELSE '0' END AS cancelled_raw,
    CASE WHEN pk % 53 = 0 THEN '1.0' ELSE '0' END AS diverted_raw
  FROM shifted)"""

STAGED = (
    RAW
    + f""",
typed AS (
  SELECT
    CAST(coalesce(try_strptime(flight_date_raw, '%Y-%m-%d'),
                  try_strptime(flight_date_raw, '%m/%d/%Y'),
                  try_strptime(flight_date_raw, '%Y%m%d')) AS DATE) AS flight_date,
    upper(trim(carrier)) AS carrier, trim(flight_number) AS flight_number,
    upper(trim(origin)) AS origin, upper(trim(dest)) AS dest,
    CAST(trunc(TRY_CAST(trim(crs_dep_time_raw, ' ' || chr(9)) AS DOUBLE)) AS INTEGER) AS crs_dep_time,
    CAST(trunc(TRY_CAST(trim(crs_arr_time_raw, ' ' || chr(9)) AS DOUBLE)) AS INTEGER) AS crs_arr_time,
    TRY_CAST(trim(crs_elapsed_time_raw) AS DOUBLE) AS crs_elapsed_time,
    TRY_CAST(trim(distance_raw) AS DOUBLE) AS distance,
    TRY_CAST(trim(arr_delay_raw) AS DOUBLE) AS arr_delay,
    TRY_CAST(trim(cancelled_raw) AS DOUBLE) AS cancelled,
    TRY_CAST(trim(diverted_raw) AS DOUBLE) AS diverted
  FROM raw),
staged AS (
  SELECT *, CASE
    WHEN flight_date IS NULL THEN 'INVALID_FLIGHT_DATE'
    WHEN flight_date < DATE '{BOUNDS.start}' OR flight_date > DATE '{BOUNDS.test_end}'
      THEN 'OUTSIDE_PROJECT_DATE_RANGE'
    WHEN cancelled = 1 THEN 'CANCELLED'
    WHEN diverted = 1 THEN 'DIVERTED'
    WHEN coalesce(carrier, '') = '' OR coalesce(flight_number, '') = ''
      OR coalesce(origin, '') = '' OR coalesce(dest, '') = '' THEN 'MISSING_IDENTIFIER'
    WHEN crs_dep_time IS NULL OR crs_arr_time IS NULL
      OR crs_dep_time NOT BETWEEN 0 AND 2400 OR crs_arr_time NOT BETWEEN 0 AND 2400
      OR crs_dep_time % 100 >= 60 OR crs_arr_time % 100 >= 60 THEN 'INVALID_SCHEDULED_TIME'
    WHEN crs_elapsed_time IS NULL OR crs_elapsed_time <= 0 THEN 'INVALID_SCHEDULED_DURATION'
    WHEN distance IS NULL OR distance <= 0 THEN 'INVALID_DISTANCE'
    WHEN arr_delay IS NULL THEN 'MISSING_ARRIVAL_DELAY'
    WHEN cancelled IS NULL OR diverted IS NULL THEN 'MISSING_STATUS_FLAG'
    ELSE 'ACCEPTED' END AS rejection_reason
  FROM typed)"""
)

ACCEPTED = (
    STAGED
    + f""",
accepted AS (
  SELECT
    sha256(concat_ws('|', CAST(flight_date AS VARCHAR), carrier, flight_number, origin, dest,
                     CAST(crs_dep_time AS VARCHAR))) AS flight_key,
    flight_date, carrier, flight_number, origin, dest, origin || '_' || dest AS route,
    crs_dep_time, crs_arr_time,
    CAST(((crs_dep_time // 100) * 60 + crs_dep_time % 100) % 1440 AS DOUBLE) AS crs_dep_minutes,
    CAST(((crs_arr_time // 100) * 60 + crs_arr_time % 100) % 1440 AS DOUBLE) AS crs_arr_minutes,
    crs_elapsed_time, distance,
    CAST(month(flight_date) AS INTEGER) AS month,
    CAST(isodow(flight_date) AS INTEGER) AS day_of_week,
    arr_delay,
    CASE WHEN arr_delay >= 15 THEN 1e0 ELSE 0e0 END AS label,
    CASE WHEN flight_date <= DATE '{BOUNDS.train_end}' THEN 'train'
         WHEN flight_date <= DATE '{BOUNDS.validation_end}' THEN 'validation'
         ELSE 'test' END AS split
  FROM staged WHERE rejection_reason = 'ACCEPTED'
  QUALIFY row_number() OVER (
    PARTITION BY flight_date, carrier, flight_number, origin, dest, crs_dep_time
    ORDER BY arr_delay, crs_arr_time, crs_elapsed_time, distance) = 1)"""
)

GLOBAL = """,
days AS (
  SELECT flight_date, CAST(sum(label) AS BIGINT) AS positives, count(*) AS rows
  FROM accepted GROUP BY flight_date),
prior AS (
  SELECT flight_date,
    CAST(coalesce(sum(rows) OVER w, 0) AS BIGINT) AS hist_global_count,
    coalesce(CAST(sum(positives) OVER w AS DOUBLE) / CAST(sum(rows) OVER w AS DOUBLE), 2e-1)
      AS hist_global_delay_rate
  FROM days
  WINDOW w AS (ORDER BY flight_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def entity_ctes(name: str) -> str:
    """Day totals ``days_<name>`` and histories ``hist_<name>`` of one entity."""
    return f""",
days_{name} AS (
  SELECT {name}, flight_date, CAST(sum(label) AS BIGINT) AS positives, count(*) AS rows
  FROM accepted GROUP BY {name}, flight_date),
hist_{name} AS (
  SELECT t.*, hist_global_count, hist_global_delay_rate,
    CAST(coalesce(sum(rows) OVER w, 0) AS BIGINT) AS hist_{name}_count,
    CAST(coalesce(sum(positives) OVER w, 0) AS BIGINT) AS hist_{name}_positives,
    (CAST(hist_{name}_positives AS DOUBLE) + 2e1 * hist_global_delay_rate)
      / (CAST(hist_{name}_count AS DOUBLE) + 2e1) AS hist_{name}_delay_rate
  FROM days_{name} AS t JOIN prior USING (flight_date)
  WINDOW w AS (PARTITION BY {name} ORDER BY flight_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


FEATURED = (
    ACCEPTED
    + GLOBAL
    + "".join(entity_ctes(name) for name in ENTITIES)
    + """,
featured AS (
  SELECT a.*,
    hist_carrier.hist_global_count, hist_carrier.hist_global_delay_rate,
    hist_carrier_count, hist_carrier_delay_rate, hist_route_count, hist_route_delay_rate,
    hist_origin_count, hist_origin_delay_rate, hist_dest_count, hist_dest_delay_rate,
    CAST(day_of_week AS VARCHAR) AS day_of_week_cat, CAST(month AS VARCHAR) AS month_cat,
    sin(2 * pi() * crs_dep_minutes / 1440) AS sched_dep_time_sin,
    cos(2 * pi() * crs_dep_minutes / 1440) AS sched_dep_time_cos,
    sin(2 * pi() * crs_arr_minutes / 1440) AS sched_arr_time_sin,
    cos(2 * pi() * crs_arr_minutes / 1440) AS sched_arr_time_cos
  FROM accepted AS a
  JOIN hist_carrier USING (carrier, flight_date)
  JOIN hist_route USING (route, flight_date)
  JOIN hist_origin USING (origin, flight_date)
  JOIN hist_dest USING (dest, flight_date))"""
)

SCORED = (
    ACCEPTED
    + GLOBAL
    + entity_ctes("route")
    + """,
scored AS (
  SELECT a.*, hist_route_delay_rate AS probability_score
  FROM accepted AS a JOIN hist_route USING (route, flight_date))"""
)

# Scores under several prior weights stand in for a grid of models.
GRID_SCORED = (
    ACCEPTED
    + GLOBAL
    + entity_ctes("route")
    + f""",
weights AS (
  SELECT unnest([{", ".join(f"{w:e}" for w in PRIOR_WEIGHTS)}]) AS reg_param,
         unnest([{", ".join(str(i) for i in range(len(PRIOR_WEIGHTS)))}]) AS outer_position),
grid_scored AS (
  SELECT a.label, a.split, reg_param, outer_position,
    (CAST(hist_route_positives AS DOUBLE) + reg_param * hist_global_delay_rate)
      / (CAST(hist_route_count AS DOUBLE) + reg_param) AS probability_score
  FROM accepted AS a JOIN hist_route USING (route, flight_date), weights)"""
)

RATIOS = """
  round(CASE WHEN n > 0 THEN CAST(tp + tn AS DOUBLE) / n ELSE 0 END, 6) AS accuracy,
  round(p, 6) AS precision,
  round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1,
  round(CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0 END, 6) AS specificity,
  tp AS true_positive, fp AS false_positive, tn AS true_negative, fn AS false_negative,
  n AS row_count"""


def sweep_ctes(source: str, thresholds, by: str = "") -> str:
    """``sweep``: counts, precision ``p`` and recall ``r`` at every threshold."""
    points = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(thresholds))
    keys = f"{by}, " if by else ""
    return f""",
points(position, threshold) AS (VALUES {points}),
counted AS (
  SELECT {keys}position, threshold,
    CAST(count(*) FILTER (probability_score >= threshold AND label = 1) AS BIGINT) AS tp,
    CAST(count(*) FILTER (probability_score >= threshold AND label = 0) AS BIGINT) AS fp,
    CAST(count(*) FILTER (probability_score < threshold AND label = 0) AS BIGINT) AS tn,
    CAST(count(*) FILTER (probability_score < threshold AND label = 1) AS BIGINT) AS fn
  FROM (SELECT * FROM {source}), points GROUP BY ALL),
sweep AS (
  SELECT *, tp + fp + tn + fn AS n,
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS p,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS r
  FROM counted)"""


def auc_ctes(source: str, by: str = "") -> str:
    """``auc``: the rank-sum form of the area, with mid-ranks for equal scores."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    same = f"PARTITION BY {keys}probability_score"
    return f""",
ranked AS (
  SELECT {keys}label,
    rank() OVER ({part} ORDER BY probability_score)
      + (count(*) OVER ({same}) - 1) / 2e0 AS mid_rank
  FROM {source}),
auc AS (
  SELECT {keys}round((sum(mid_rank) FILTER (label = 1)
      - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0)
    / (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)), 6) AS roc_auc
  FROM ranked GROUP BY ALL)"""


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes.lstrip()}\n{body.strip()}"


BASELINE = """,
majority AS (
  SELECT CASE WHEN sum(label) * 2 > count(*) THEN 1 ELSE 0 END AS predicted_class
  FROM accepted WHERE split = 'train'),
baseline AS (
  SELECT *, tp + fp + tn + fn AS n,
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS p,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS r
  FROM (
    SELECT predicted_class,
      count(*) FILTER (label = 1 AND predicted_class = 1) AS tp,
      count(*) FILTER (label = 0 AND predicted_class = 1) AS fp,
      count(*) FILTER (label = 0 AND predicted_class = 0) AS tn,
      count(*) FILTER (label = 1 AND predicted_class = 0) AS fn
    FROM accepted, majority WHERE split = 'test' GROUP BY predicted_class))"""

TEST = "(SELECT * FROM scored WHERE split = 'test')"
VALIDATION = "(SELECT * FROM scored WHERE split = 'validation')"
VALIDATION_GRID = "(SELECT * FROM grid_scored WHERE split = 'validation')"
CURVE = [i / (CURVE_POINTS - 1) for i in range(CURVE_POINTS)]

SUMMARY = """,
summary AS (
  SELECT split, min(flight_date) AS minimum_date, max(flight_date) AS maximum_date,
    count(*) AS row_count, CAST(sum(label) AS BIGINT) AS delayed_count,
    count(*) - CAST(sum(label) AS BIGINT) AS on_time_count,
    round(CAST(sum(label) AS DOUBLE) / count(*), 6) AS delay_rate
  FROM accepted GROUP BY split)"""

GRID = (
    GRID_SCORED
    + sweep_ctes(VALIDATION_GRID, THRESHOLDS, "reg_param, outer_position")
    + auc_ctes(VALIDATION_GRID, "reg_param")
    + f""",
grid AS (
  SELECT reg_param, CAST(outer_position * {len(THRESHOLDS)} + position AS INTEGER) AS position,
    threshold, {RATIOS}, roc_auc
  FROM sweep JOIN auc USING (reg_param))"""
)

EVENTS = f"""
ev AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
    CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS second_of_day,
    CASE WHEN value >= {EVENT_VALUE!r}::DOUBLE THEN 1 ELSE 0 END AS label
  FROM events),
ev_days AS (SELECT day, sum(label) AS k, count(*) AS n FROM ev GROUP BY day),
ev_prior AS (
  SELECT d.day, CAST(coalesce(sum(e.n), 0) AS BIGINT) AS hist_global_count,
    coalesce(CAST(sum(e.k) AS DOUBLE) / CAST(sum(e.n) AS DOUBLE), 2e-1) AS hist_global_rate
  FROM ev_days AS d LEFT JOIN ev_days AS e ON e.day < d.day GROUP BY d.day)"""


def event_entity(name: str) -> str:
    return f""",
{name}_days AS (
  SELECT {name}, day, sum(label) AS k, count(*) AS n FROM ev GROUP BY {name}, day),
{name}_prior AS (
  SELECT d.{name}, d.day,
    CAST(coalesce(sum(e.n), 0) AS BIGINT) AS hist_{name}_count,
    coalesce(sum(e.k), 0) AS hist_{name}_k
  FROM {name}_days AS d LEFT JOIN {name}_days AS e ON e.{name} = d.{name} AND e.day < d.day
  GROUP BY d.{name}, d.day)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["resolve_columns"] = _select(RAW, "SELECT * FROM raw")
    sql["stage_types"] = _select(STAGED, "SELECT * FROM typed")
    sql["reject_reasons"] = _select(
        STAGED,
        "SELECT rejection_reason, count(*) AS row_count FROM staged GROUP BY rejection_reason",
    )
    sql["narrow_source"] = sql["resolve_columns"]
    # A CSV file does not tell an empty text from a missing one.
    sql["csv_scan"] = _select(
        RAW, "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in FIELD_HEADERS) + " FROM raw"
    )
    folder = "CASE WHEN CAST(flight_number AS BIGINT) % 2 = 1 THEN 'new' ELSE 'old' END"
    sql["header_check"] = _select(
        RAW,
        f"""
SELECT {folder} AS folder, 12 AS column_count, 0 AS n_missing, '' AS first_missing,
  count(*) AS row_count FROM raw GROUP BY folder
UNION ALL
SELECT 'short', 11, 1, 'distance', count(*) FROM raw""",
    )
    sql["file_manifest"] = _select(
        RAW,
        f"""
SELECT {folder} AS folder, 12 AS column_count, count(*) AS row_count, TRUE AS listed_once,
  TRUE AS filled FROM raw GROUP BY folder""",
    )
    sql["quality_report"] = _select(
        ACCEPTED,
        """
SELECT 'input' AS stage, 'ALL_ROWS' AS reason, count(*) AS row_count FROM staged
UNION ALL
SELECT 'cleaning', rejection_reason, count(*) FROM staged GROUP BY rejection_reason
UNION ALL
SELECT 'deduplication', 'DUPLICATE_ROWS_REMOVED',
  (SELECT count(*) FROM staged WHERE rejection_reason = 'ACCEPTED') - count(*) FROM accepted
UNION ALL
SELECT 'final_clean_data', 'ACCEPTED_UNIQUE_FLIGHTS', count(*) FROM accepted""",
    )
    sql["accepted_rows"] = _select(ACCEPTED, "SELECT * EXCLUDE (split) FROM accepted")
    sql["surrogate_key"] = _select(
        ACCEPTED,
        "SELECT flight_key, flight_date, carrier, flight_number, origin, dest, crs_dep_time"
        " FROM accepted",
    )
    sql["daily_totals"] = _select(ACCEPTED + GLOBAL, "SELECT * FROM days")
    sql["global_prior"] = _select(
        ACCEPTED + GLOBAL,
        "SELECT flight_date, hist_global_count, round(hist_global_delay_rate, 6)"
        " AS hist_global_delay_rate FROM prior",
    )
    sql["entity_daily"] = _select(
        ACCEPTED,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS entity, {name} AS key, flight_date,"
            " CAST(sum(label) AS BIGINT) AS positives, count(*) AS rows"
            f" FROM accepted GROUP BY {name}, flight_date"
            for name in ENTITIES
        ),
    )
    for name in ENTITIES:
        sql[f"history_{name}"] = _select(
            ACCEPTED + GLOBAL + entity_ctes(name),
            f"""
SELECT {name}, flight_date, positives, rows, hist_global_count,
  round(hist_global_delay_rate, 6) AS hist_global_delay_rate, hist_{name}_count,
  round(hist_{name}_delay_rate, 6) AS hist_{name}_delay_rate
FROM hist_{name}""",
        )
    sql["history_range_frame"] = _select(
        ACCEPTED,
        """
SELECT route, flight_date,
  CAST(coalesce(sum(label) OVER w, 0) AS BIGINT) AS hist_route_positives,
  count(*) OVER w AS hist_route_count
FROM accepted
WINDOW w AS (PARTITION BY route ORDER BY flight_date
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)
QUALIFY row_number() OVER (PARTITION BY route, flight_date) = 1""",
    )
    sql["history_range_rows"] = _select(
        ACCEPTED,
        """
SELECT flight_key, route, flight_date,
  CAST(coalesce(sum(label) OVER w, 0) AS BIGINT) AS hist_route_positives,
  count(*) OVER w AS hist_route_count
FROM accepted
WINDOW w AS (PARTITION BY route ORDER BY flight_date
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    )
    rates = ", ".join(
        f"hist_{n}_count, round(hist_{n}_delay_rate, 6) AS hist_{n}_delay_rate"
        for n in ("global", *ENTITIES)
    )
    sql["smoothed_rates"] = _select(FEATURED, f"SELECT flight_key, {rates} FROM featured")
    waves = [f"sched_{t}_time_{w}" for t in ("dep", "arr") for w in ("sin", "cos")]
    waves_sql = ", ".join(f"round({w}, 6) + 0 AS {w}" for w in waves)
    sql["cyclical_time"] = _select(
        FEATURED, f"SELECT flight_key, crs_dep_minutes, crs_arr_minutes, {waves_sql} FROM featured"
    )
    sql["calendar_fields"] = _select(
        FEATURED,
        "SELECT flight_key, month, day_of_week, month_cat, day_of_week_cat FROM featured",
    )
    sql["featured_rows"] = _select(
        FEATURED,
        f"""
SELECT flight_key, flight_date, carrier, origin, dest, route, crs_elapsed_time, distance,
  day_of_week_cat, month_cat, label, split, {rates}, {waves_sql}
FROM featured""",
    )
    sql["chrono_split"] = _select(ACCEPTED, "SELECT flight_key, flight_date, split FROM accepted")
    sql["split_summary"] = _select(ACCEPTED + SUMMARY, "SELECT * FROM summary")
    sql["class_distribution"] = _select(
        ACCEPTED,
        f"""
SELECT split, CAST(label AS INTEGER) AS class_label,
  CASE WHEN label = 0 THEN '{CLASS_NAMES[0]}' ELSE '{CLASS_NAMES[1]}' END AS class_name,
  count(*) AS row_count,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM accepted GROUP BY split, label""",
    )
    sql["history_coverage"] = _select(
        FEATURED,
        "\nUNION ALL\n".join(
            f"SELECT split, '{name}' AS history_entity,"
            f" round(avg(hist_{name}_count), 6) AS mean_prior_flight_count,"
            f" round(avg(CASE WHEN hist_{name}_count = 0 THEN 1e0 ELSE 0e0 END), 6)"
            " AS share_with_no_entity_history FROM featured GROUP BY split"
            for name in ENTITIES
        ),
    )
    sweep = SCORED + sweep_ctes(TEST, THRESHOLDS)
    sql["threshold_sweep"] = _select(
        sweep, f"SELECT CAST(position AS INTEGER) AS position, threshold, {RATIOS} FROM sweep"
    )
    at_one = SCORED + sweep_ctes(TEST, [TEST_THRESHOLD]) + auc_ctes(TEST)
    sql["threshold_eval"] = _select(
        at_one, f"SELECT threshold, {RATIOS}, roc_auc FROM sweep, auc"
    )
    sql["apply_threshold"] = _select(
        SCORED,
        f"""
SELECT flight_key, label, round(probability_score, 6) AS probability_score,
  CASE WHEN probability_score >= {TEST_THRESHOLD!r}::DOUBLE THEN 1e0 ELSE 0e0 END AS prediction
FROM scored WHERE split = 'test'""",
    )
    sql["prediction_sink"] = _select(
        SCORED,
        f"""
SELECT flight_key, flight_date, carrier, flight_number, origin, dest, crs_dep_time, crs_arr_time,
  label, round(probability_score, 6) AS probability_score,
  CASE WHEN probability_score >= {TEST_THRESHOLD!r}::DOUBLE THEN 1e0 ELSE 0e0 END AS prediction
FROM scored WHERE split = 'test'""",
    )
    sql["roc_auc_exact"] = _select(SCORED + auc_ctes(TEST), "SELECT roc_auc FROM auc")
    # The distinct scores, highest first, in groups that leave at least a thousand points.
    sql["roc_auc_binned"] = _select(
        SCORED + """,
placed AS (
  SELECT split, pos, neg, row_number() OVER (PARTITION BY split ORDER BY score DESC) - 1 AS place,
    count(*) OVER (PARTITION BY split) AS scores
  FROM (SELECT split, probability_score AS score, sum(label) AS pos, sum(1 - label) AS neg
        FROM scored GROUP BY split, probability_score)),
bins AS (
  SELECT split, place // greatest(scores // 1000, 1) AS bin, sum(pos) AS pos, sum(neg) AS neg
  FROM placed GROUP BY ALL),
curve AS (
  SELECT split, pos, neg, coalesce(sum(pos) OVER (
    PARTITION BY split ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM bins)""",
        """
SELECT split, round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM curve GROUP BY split""",
    )
    curve = SCORED + sweep_ctes(TEST, CURVE)
    sql["roc_curve"] = _select(
        curve,
        """
SELECT threshold,
  round(CASE WHEN fp + tn > 0 THEN CAST(fp AS DOUBLE) / (fp + tn) ELSE 0 END, 6)
    AS false_positive_rate,
  round(r, 6) AS true_positive_rate
FROM sweep""",
    )
    sql["pr_curve"] = _select(
        curve,
        """
SELECT threshold, round(r, 6) AS recall, round(p, 6) AS precision,
  (SELECT round(avg(label), 6) FROM accepted WHERE split = 'test') AS prevalence
FROM sweep""",
    )
    sql["majority_class"] = _select(
        ACCEPTED + BASELINE, "SELECT CAST(predicted_class AS INTEGER) AS predicted_class"
        " FROM majority"
    )
    null_settings = "CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS roc_auc"
    sql["constant_baseline"] = _select(
        ACCEPTED + BASELINE,
        f"SELECT CAST(predicted_class AS INTEGER) AS predicted_class, {RATIOS}, {null_settings}"
        " FROM baseline",
    )
    sql["confusion_matrix"] = _select(
        SCORED + sweep_ctes(TEST, [TEST_THRESHOLD]),
        f"""
SELECT '{CLASS_NAMES[0]}' AS actual_class, tn AS predicted_on_time, fp AS predicted_delayed
FROM sweep
UNION ALL SELECT '{CLASS_NAMES[1]}', fn, tp FROM sweep""",
    )
    sql["metric_comparison"] = _select(
        at_one + BASELINE,
        f"""
SELECT 'logistic_regression' AS model, 'test' AS split, threshold, {RATIOS}, roc_auc,
  CAST(NULL AS INTEGER) AS predicted_class FROM sweep, auc
UNION ALL
SELECT 'majority_class_baseline' AS model, 'test' AS split, CAST(NULL AS DOUBLE) AS threshold,
  {RATIOS}, CAST(NULL AS DOUBLE) AS roc_auc, CAST(predicted_class AS INTEGER)
FROM baseline""",
    )
    sql["grid_metrics"] = _select(GRID, "SELECT * FROM grid")
    sql["best_by_group"] = _select(
        GRID,
        """
SELECT * FROM grid
QUALIFY row_number() OVER (PARTITION BY reg_param ORDER BY f1 DESC, position) = 1""",
    )
    sql["select_best"] = _select(
        GRID,
        f"""
SELECT *, threshold IN ({min(THRESHOLDS)!r}::DOUBLE, {max(THRESHOLDS)!r}::DOUBLE)
  AS threshold_at_grid_edge
FROM grid
ORDER BY f1 DESC, precision DESC, recall DESC, roc_auc DESC, abs(threshold - 0.5::DOUBLE),
  reg_param, position LIMIT 1""",
    )
    sql["top_errors"] = _select(
        SCORED,
        f"""
SELECT * REPLACE (round(probability_score, 6) AS probability_score,
                  round(error_confidence, 6) AS error_confidence)
FROM (
  SELECT flight_key, flight_date, carrier, flight_number, origin, dest, crs_dep_time,
    crs_arr_time, label, probability_score, 1 - label AS prediction,
    CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type,
    CASE WHEN label = 0 THEN probability_score ELSE 1 - probability_score END
      AS error_confidence
  FROM scored
  WHERE split = 'test' AND (label = 1) <> (probability_score >= {TEST_THRESHOLD!r}::DOUBLE)
  QUALIFY row_number() OVER (
    PARTITION BY label ORDER BY error_confidence DESC, flight_key) <= {TOP_ERRORS})""",
    )
    sql["refit_union"] = _select(
        ACCEPTED,
        "SELECT flight_key, flight_date, label, split FROM accepted"
        " WHERE split IN ('train', 'validation')",
    )
    given = ", ".join(
        f"CASE WHEN split = 'test' THEN {name} || '?' ELSE {name} END AS {name}"
        for name in CATEGORICAL_FEATURES
    )
    learned = "".join(
        f""",
known_{name} AS (
  SELECT {name} AS value, row_number() OVER (ORDER BY count(*) DESC, {name}) - 1 AS slot
  FROM featured WHERE split = 'train' GROUP BY {name})"""
        for name in CATEGORICAL_FEATURES
    )
    categories = FEATURED + f""",
given AS (SELECT {given} FROM featured)""" + learned
    sql["label_index"] = _select(
        categories,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS feature, {name} AS value,"
            f" CAST(coalesce(slot, (SELECT count(*) FROM known_{name})) AS DOUBLE) AS slot,"
            f" count(*) AS row_count FROM given LEFT JOIN known_{name} ON {name} = value"
            f" GROUP BY {name}, slot"
            for name in CATEGORICAL_FEATURES
        ),
    )
    sql["one_hot_slots"] = _select(
        categories,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS feature, {name} AS value,"
            f" CAST(coalesce(slot, (SELECT count(*) FROM known_{name})) AS INTEGER) AS slot,"
            f" CAST((SELECT count(*) + 1 FROM known_{name}) AS INTEGER) AS width,"
            f" count(*) AS row_count FROM given LEFT JOIN known_{name} ON {name} = value"
            f" GROUP BY {name}, slot"
            for name in CATEGORICAL_FEATURES
        ),
    )
    sql["rank_slots"] = sql["label_index"]
    odd = "split = 'test' AND day(flight_date) % 2 = 1"
    sql["median_impute"] = _select(
        FEATURED,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS feature,"
            f" round(quantile_disc({name}, 0.5) FILTER (split = 'train'), 6) + 0 AS least_fill,"
            f" round(quantile_disc({name}, 0.5) FILTER (split = 'train'), 6) + 0 AS most_fill,"
            f" count(*) FILTER ({odd}) AS n_filled, count(*) FILTER (NOT ({odd})) AS n_kept"
            " FROM featured"
            for name in NUMERIC_FEATURES
        ),
    )
    deviations = ", ".join(f"stddev_samp({name}) AS sd_{name}" for name in NUMERIC_FEATURES)
    scaled = ", ".join(
        f"round({name} / sd_{name}, 6) + 0 AS {name}_scaled" for name in NUMERIC_FEATURES
    )
    sql["std_scale"] = _select(
        FEATURED + f""",
deviations AS (SELECT {deviations} FROM featured WHERE split = 'train')""",
        f"SELECT flight_key, {scaled} FROM featured, deviations WHERE NOT ({odd})",
    )
    tried = ", ".join(f"({i}, {r!r}::DOUBLE)" for i, r in enumerate(ModelGrid().reg_params))
    points = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(THRESHOLDS))
    sql["fit_select"] = _select(
        ACCEPTED,
        f"""
SELECT CAST(r.i * {len(THRESHOLDS)} + t.i AS INTEGER) AS position, reg_param, threshold,
  {ModelGrid().max_iterations} AS max_iterations, count(*) AS row_count,
  CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
  TRUE AS in_range, TRUE AS is_flat
FROM accepted, (VALUES {tried}) AS r(i, reg_param), (VALUES {points}) AS t(i, threshold)
WHERE split = 'validation' GROUP BY ALL""",
    )
    sql["score_model"] = _select(
        ACCEPTED,
        f"SELECT {', '.join(PREDICTION_COLUMNS[:-2])}, TRUE AS is_explained, TRUE AS is_class"
        " FROM accepted WHERE split = 'test'",
    )
    slots = "\nUNION ALL\n".join(
        f"SELECT {i} AS part, row_number() OVER (ORDER BY count(*) DESC, {name}) AS place,"
        f" '{name}__one_hot_' || {name} AS feature_name FROM featured WHERE split <> 'test'"
        f" GROUP BY {name} UNION ALL SELECT {i}, 1000000000, '{name}__one_hot___unknown'"
        for i, name in enumerate(CATEGORICAL_FEATURES)
    )
    numbers = "\nUNION ALL\n".join(
        f"SELECT 100, {i}, 'numeric__{name}'" for i, name in enumerate(NUMERIC_FEATURES)
    )
    sql["coefficients"] = _select(
        FEATURED,
        f"""
SELECT CAST(row_number() OVER (ORDER BY part, place) - 1 AS INTEGER) AS feature_index,
  feature_name, TRUE AS agrees, TRUE AS is_flat
FROM ({slots}
UNION ALL
{numbers})""",
    )
    means = "\nUNION ALL\n".join(
        f"SELECT {i} AS part, row_number() OVER (ORDER BY count(*) DESC, {name}) AS place,"
        f" CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train) AS weight FROM train"
        f" GROUP BY {name} UNION ALL SELECT {i}, 1000000000, 0"
        for i, name in enumerate(CATEGORICAL_FEATURES)
    )
    number_means = "\nUNION ALL\n".join(
        f"SELECT 100, {i}, avg({name}) / stddev_samp({name}) FROM train"
        for i, name in enumerate(NUMERIC_FEATURES)
    )
    sql["fit_gradients"] = _select(
        FEATURED + """,
train AS (SELECT * FROM featured WHERE split = 'train')""",
        f"""
SELECT reg_param, CAST(slot AS INTEGER) AS slot, round(weight, 6) + 0 AS weight, TRUE AS is_flat
FROM (SELECT row_number() OVER (ORDER BY part, place) - 2 AS slot, weight
      FROM (SELECT -1 AS part, 0 AS place, 1e0 AS weight
UNION ALL
{means}
UNION ALL
{number_means})), (VALUES {tried}) AS r(i, reg_param)""",
    )
    sql["top_coefficients"] = "SELECT TRUE AS none_left_out, TRUE AS enough"
    sql["calibration"] = _select(
        ACCEPTED,
        "SELECT count(*) AS row_count, TRUE AS calibrated FROM accepted WHERE split = 'train'",
    )
    sql["saved_models"] = _select(
        ACCEPTED,
        "SELECT count(*) AS row_count, TRUE AS any_same, TRUE AS all_same, TRUE AS saved"
        " FROM accepted WHERE split = 'test'",
    )
    at_validation = (
        SCORED + sweep_ctes(VALIDATION, [TEST_THRESHOLD]) + auc_ctes(VALIDATION)
        + BASELINE.replace("split = 'test'", "split = 'validation'")
    )
    sql["validation_comparison"] = _select(
        at_validation,
        f"""
SELECT 'logistic_regression' AS model, 'validation' AS split, threshold, {RATIOS}, roc_auc,
  CAST(NULL AS INTEGER) AS predicted_class FROM sweep, auc
UNION ALL
SELECT 'majority_class_baseline', 'validation', CAST(NULL AS DOUBLE),
  {RATIOS}, CAST(NULL AS DOUBLE), CAST(predicted_class AS INTEGER)
FROM baseline""",
    )
    sql["csv_sink"] = sql["reject_reasons"]
    sql["json_sink"] = _select(
        ACCEPTED + SUMMARY,
        """
SELECT '{"minimum_date":"' || minimum_date || '","row_count":' || row_count || ',"split":"'
  || split || '"}' AS value FROM summary""",
    )
    margin = " + ".join(f"{w!r}::DOUBLE * {c}" for c, w in FIXED_WEIGHTS.items())
    sql["score_fixed"] = _select(
        FEATURED,
        f"SELECT flight_key, round(1 / (1 + exp(-({FIXED_INTERCEPT!r}::DOUBLE + {margin}))), 6)"
        " AS probability_score FROM featured",
    )
    sql["month_calendar"] = _select(
        ACCEPTED,
        f"""
SELECT CAST(m AS DATE) AS month_start, count(flight_date) AS row_count,
  count(flight_date) > 0 AS present
FROM generate_series(DATE '{BOUNDS.start.replace(day=1)}', DATE '2001-12-31', INTERVAL 1 MONTH)
  AS g(m)
LEFT JOIN accepted ON date_trunc('month', flight_date) = m GROUP BY m""",
    )
    sql["events_global_prior"] = _select(
        EVENTS,
        "SELECT day, hist_global_count, round(hist_global_rate, 6) AS hist_global_rate"
        " FROM ev_prior",
    )
    sql["events_history"] = _select(
        EVENTS + event_entity("user_id") + event_entity("event_type"),
        """
SELECT event_id, hist_user_id_count, hist_event_type_count,
  round((hist_user_id_k + 2e1 * hist_global_rate) / (hist_user_id_count + 2e1), 6)
    AS hist_user_id_rate,
  round((hist_event_type_k + 2e1 * hist_global_rate) / (hist_event_type_count + 2e1), 6)
    AS hist_event_type_rate
FROM ev JOIN ev_prior USING (day)
JOIN user_id_prior USING (user_id, day) JOIN event_type_prior USING (event_type, day)""",
    )
    sql["events_cycle"] = _select(
        EVENTS,
        "SELECT event_id, round(sin(2 * pi() * second_of_day / 86400e0), 6) + 0 AS time_sin,"
        " round(cos(2 * pi() * second_of_day / 86400e0), 6) + 0 AS time_cos FROM ev",
    )
    return sql
