"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The CTEs rebuild the adapter's outage shape from the driver tables with the
same expressions, then run the operator in plain SQL (window functions,
GROUP BY, joins).  Column names equal the Spark query's.
"""

from __future__ import annotations

KEYS = "state, report_date, county"
ORDER = "ts, emc, source_file, row_id"

BASE = f"""
reports AS (
  SELECT 's' || CAST(user_id % 2 AS VARCHAR) AS state,
         CAST(ts AS DATE) AS report_date,
         'c' || CAST(user_id % 50 AS VARCHAR) AS county,
         event_type AS emc,
         CAST(ts AS TIMESTAMP) AS ts,
         CAST(floor(value) AS DOUBLE) AS affected,
         CAST(1000 + 10 * (user_id % 50) + length(event_type) AS DOUBLE) AS customers_served,
         'events' AS source_file,
         CAST(event_id AS BIGINT) AS row_id
  FROM events),
mnum AS (
  SELECT n_nationkey, CAST(n_nationkey + 25 * j AS BIGINT) AS k
  FROM nation, (SELECT unnest(range(0, 3)) AS j) jj),
master AS (
  SELECT 's' || CAST(k % 2 AS VARCHAR) AS state, 'c' || CAST(k AS VARCHAR) AS county
  FROM mnum WHERE k % 23 <> 22),
run_keys AS (SELECT DISTINCT state, report_date FROM reports),
spine AS (
  SELECT m.state, r.report_date, m.county FROM master m JOIN run_keys r ON m.state = r.state),
hist AS (
  SELECT 's' || CAST((user_id % 50 + 25) % 2 AS VARCHAR) AS state,
         'c' || CAST(user_id % 50 + 25 AS VARCHAR) AS county,
         CAST(floor(value) AS DOUBLE) + 0.25 AS customers_served
  FROM events),
hist_tot AS (
  SELECT state, county, CAST(trunc(sum(customers_served)) AS BIGINT) AS hist_served
  FROM hist GROUP BY state, county),
fips AS (
  SELECT upper('s' || CAST(k % 2 AS VARCHAR)) AS state_abbr, lower(r_name) AS state_name,
         ' C' || CAST(k AS VARCHAR) || ' ' AS county_name, lpad(CAST(k AS VARCHAR), 5, '0') AS fips
  FROM mnum JOIN region ON k % 2 = r_regionkey WHERE k % 17 <> 5),
mreports AS (
  SELECT r.* FROM reports r
  WHERE EXISTS (SELECT 1 FROM master m WHERE m.state = r.state AND m.county = r.county)),
sreports AS (
  SELECT r.* FROM mreports r
  WHERE EXISTS (SELECT 1 FROM spine s WHERE s.state = r.state AND s.report_date = r.report_date AND s.county = r.county)),
sess1 AS (
  SELECT r.*, lag(ts) OVER w AS prev_ts, lag(affected) OVER w AS prev_v
  FROM sreports r
  WINDOW w AS (PARTITION BY {KEYS} ORDER BY {ORDER})),
sess2 AS (
  SELECT *, (prev_ts IS NULL OR ts - prev_ts > INTERVAL 59 MINUTE) AS is_new FROM sess1),
sess AS (
  SELECT *,
         CAST(sum(CAST(is_new AS BIGINT)) OVER (PARTITION BY {KEYS} ORDER BY {ORDER}
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS event_id,
         CASE WHEN is_new THEN 0.0 ELSE prev_v END AS prev_affected,
         greatest(affected - CASE WHEN is_new THEN 0.0 ELSE prev_v END, 0.0) AS delta
  FROM sess2),
events_ AS (
  SELECT state, report_date, county, event_id,
         max(affected) AS lower,
         (max(affected) + sum(delta)) / 2.0 AS middle,
         sum(delta) AS upper,
         max(customers_served) AS customers_served,
         min(ts) AS start_time, max(ts) AS end_time,
         first(emc ORDER BY {ORDER}) FILTER (WHERE emc IS NOT NULL) AS emc,
         FALSE AS is_filler
  FROM sess GROUP BY state, report_date, county, event_id),
fillers AS (
  SELECT s.state, s.report_date, s.county, CAST(1 AS BIGINT) AS event_id,
         0.0 AS lower, 0.0 AS middle, 0.0 AS upper,
         CAST(coalesce(h.hist_served, -1) AS DOUBLE) AS customers_served,
         CAST(NULL AS TIMESTAMP) AS start_time, CAST(NULL AS TIMESTAMP) AS end_time,
         '' AS emc, TRUE AS is_filler
  FROM spine s LEFT JOIN hist_tot h ON s.state = h.state AND s.county = h.county
  WHERE NOT EXISTS (SELECT 1 FROM events_ e
                    WHERE e.state = s.state AND e.report_date = s.report_date AND e.county = s.county)),
all_events AS (
  SELECT * FROM events_ UNION ALL SELECT * FROM fillers),
served_tot AS (
  SELECT state, report_date, county, CAST(sum(emc_served) AS BIGINT) AS served_total
  FROM (SELECT state, report_date, county, emc,
               max(coalesce(TRY_CAST(trunc(customers_served) AS BIGINT), 0)) AS emc_served
        FROM all_events WHERE emc IS NOT NULL
        GROUP BY state, report_date, county, emc)
  GROUP BY state, report_date, county),
saidi AS (
  SELECT state, report_date, county,
         sum(affected) * CAST(0.25 AS DOUBLE) / max(customers_served) AS saidi
  FROM sreports GROUP BY state, report_date, county),
saifi AS (
  SELECT a.state, a.report_date, a.county,
         CASE WHEN t.served_total > 0 THEN coalesce(a.sl, 0.0) / CAST(t.served_total AS DOUBLE) END AS lower_saifi,
         CASE WHEN t.served_total > 0 THEN coalesce(a.sm, 0.0) / CAST(t.served_total AS DOUBLE) END AS middle_saifi,
         CASE WHEN t.served_total > 0 THEN coalesce(a.su, 0.0) / CAST(t.served_total AS DOUBLE) END AS upper_saifi
  FROM (SELECT state, report_date, county, sum(lower) AS sl, sum(middle) AS sm, sum(upper) AS su
        FROM all_events GROUP BY state, report_date, county) a
  LEFT JOIN served_tot t ON a.state = t.state AND a.report_date = t.report_date AND a.county = t.county),
metrics AS (
  SELECT s.state, s.report_date, s.county, d.saidi, f.lower_saifi, f.middle_saifi, f.upper_saifi
  FROM spine s
  LEFT JOIN saidi d ON s.state = d.state AND s.report_date = d.report_date AND s.county = d.county
  LEFT JOIN saifi f ON s.state = f.state AND s.report_date = f.report_date AND s.county = f.county)
"""


def rnd(x: str) -> str:
    return f"(round_even({x} * 10000.0, 0) / 10000.0)"


def disp(x: str) -> str:
    r = rnd(x)
    return (
        f"(CASE WHEN {x} IS NULL THEN '0.0' WHEN abs({r}) < 0.0001 THEN '<0.0001' "
        f"ELSE regexp_replace(regexp_replace(CAST(CAST({r} AS DECIMAL(38,4)) AS VARCHAR), '0+$', ''), '\\.$', '.0') END)"
    )


def title(x: str) -> str:
    """Python str.title() for ASCII text, character by character."""
    s = f"lower({x})"
    return (
        f"array_to_string(list_transform(range(1, length({s}) + 1), lambda i: "
        f"CASE WHEN i = 1 OR NOT regexp_matches(substr({s}, i - 1, 1), '[a-z]') "
        f"THEN upper(substr({s}, i, 1)) ELSE substr({s}, i, 1) END), '')"
    )


def with_base(select: str) -> str:
    return f"WITH {BASE.strip()}\n{select}"


MINUTES = "(CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 60000000.0)"
EVENT_OUT = f"""state, report_date, county, event_id, lower, middle, upper,
  CAST(customers_served AS DOUBLE) AS customers_served, start_time, end_time,
  {MINUTES} AS duration_minutes, emc, is_filler"""

METRICS = "saidi, lower_saifi, middle_saifi, upper_saifi"

ENRICHED = """
  SELECT m.*, f.fips, f.state_name FROM {src} m
  LEFT JOIN fips f ON lower(trim(m.state)) = lower(trim(f.state_abbr))
                  AND lower(trim(m.county)) = lower(trim(f.county_name))
"""

ORACLE: dict[str, str] = {
    "metric_daily": with_base(f"SELECT state, report_date, county, {METRICS} FROM metrics"),
    "win_time_gap": with_base(
        f"SELECT state, report_date, county, row_id, "
        f"CAST(epoch_us(ts) - epoch_us(prev_ts) AS DOUBLE) / 60000000.0 AS gap_minutes FROM sess1"
    ),
    "win_session_flag": with_base("SELECT state, report_date, county, row_id, is_new FROM sess"),
    "win_session_id": with_base("SELECT state, report_date, county, row_id, event_id FROM sess"),
    "win_prev_in_session": with_base("SELECT state, report_date, county, row_id, CAST(prev_affected AS DOUBLE) AS prev_affected FROM sess"),
    "win_positive_delta": with_base("SELECT state, report_date, county, row_id, CAST(delta AS DOUBLE) AS delta FROM sess"),
    "agg_outage_events": with_base(f"SELECT {EVENT_OUT} FROM events_"),
    "agg_event_middle": with_base(f"SELECT state, report_date, county, event_id, middle, {MINUTES} AS duration_minutes FROM events_"),
    "agg_customers_served": with_base("SELECT state, report_date, county, served_total FROM served_tot"),
    "agg_served_history": with_base("SELECT state, county, hist_served FROM hist_tot"),
    "agg_saidi": with_base("SELECT state, report_date, county, saidi FROM saidi"),
    "agg_saifi": with_base("SELECT state, report_date, county, lower_saifi, middle_saifi, upper_saifi FROM saifi"),
    "join_county_restrict": with_base("SELECT state, report_date, county, row_id FROM mreports"),
    "join_missing_counties": with_base(
        "SELECT s.state, s.report_date, s.county FROM spine s WHERE NOT EXISTS (SELECT 1 FROM events_ e "
        "WHERE e.state = s.state AND e.report_date = s.report_date AND e.county = s.county)"
    ),
    "join_served_history": with_base("SELECT state, report_date, county, customers_served FROM fillers"),
    "join_county_spine": with_base(f"SELECT state, report_date, county, {METRICS} FROM metrics"),
    "join_fips": with_base(
        "SELECT state, report_date, county, fips, state_name FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
    "fill_counties": with_base(f"SELECT {EVENT_OUT} FROM fillers"),
    "set_union_counties": with_base(f"SELECT {EVENT_OUT} FROM all_events"),
    "set_union_providers": with_base(
        "SELECT state, emc, count(*) AS n_reports, sum(affected) AS sum_affected FROM reports "
        "WHERE emc IS NOT NULL GROUP BY state, emc"
    ),
    "metric_round": with_base(
        f"SELECT state, report_date, county, {rnd('saidi')} AS saidi, {rnd('lower_saifi')} AS lower_saifi, "
        f"{rnd('middle_saifi')} AS middle_saifi, {rnd('upper_saifi')} AS upper_saifi FROM metrics"
    ),
    "metric_format_small": with_base(
        f"SELECT state, report_date, county, {disp('saidi')} AS saidi, {disp('lower_saifi')} AS lower_saifi, "
        f"{disp('middle_saifi')} AS middle_saifi, {disp('upper_saifi')} AS upper_saifi FROM metrics"
    ),
    "metric_add_date": with_base(
        f"SELECT state, county, {disp('saidi')} AS saidi, {disp('lower_saifi')} AS lower_saifi, "
        f"{disp('middle_saifi')} AS middle_saifi, {disp('upper_saifi')} AS upper_saifi, "
        f"strftime(report_date, '%Y-%m-%d') AS date FROM metrics"
    ),
    "sort_counties": with_base(
        "SELECT state, report_date, county, row_number() OVER (PARTITION BY state, report_date ORDER BY county) AS place "
        "FROM metrics"
    ),
    "final_projection": with_base(
        f"SELECT {title('county')} AS County, fips AS FIPS, {disp('saidi')} AS SAIDI, "
        f"{disp('lower_saifi')} AS LOWER_SAIFI, {disp('middle_saifi')} AS SAIFI, {disp('upper_saifi')} AS UPPER_SAIFI, "
        f"{title('state_name')} AS State, report_date AS Date FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
    "history_projection": with_base(
        f"SELECT {title('state_name')} AS State, {title('county')} AS County, fips AS FIPS, saidi AS SAIDI, "
        f"middle_saifi AS SAIFI, report_date AS Date FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
    "sort_history": with_base(
        f"SELECT {title('state_name')} AS State, {title('county')} AS County, fips AS FIPS, saidi AS SAIDI, "
        f"middle_saifi AS SAIFI, report_date AS Date, row_number() OVER (PARTITION BY {title('state_name')}, report_date "
        f"ORDER BY {title('county')}) AS place FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)


# ------------------------------------------------------- standardization --
RAW = """
raw AS (
  SELECT *, CAST(1000 + 10 * (user_id % 50) + length(event_type) AS VARCHAR) AS served_n,
         'c' || CAST(user_id % 50 AS VARCHAR) AS cname
  FROM events),
feed AS (
  SELECT 's' || CAST(user_id % 2 AS VARCHAR) AS state,
         'feed_' || event_type || '_per_county.csv' AS source_file,
         CAST(event_id AS BIGINT) AS row_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS emc,
         CASE event_id % 8 WHEN 0 THEN upper(cname) WHEN 1 THEN '  ' || cname || '  '
              WHEN 2 THEN 'xx-' || cname WHEN 3 THEN NULL WHEN 4 THEN '   '
              WHEN 5 THEN 'Unknown' WHEN 6 THEN cname || ' county' ELSE cname END AS county_a,
         cname AS county_b,
         CASE event_id % 6
              WHEN 0 THEN '"' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '"'
              WHEN 1 THEN 'abc' WHEN 2 THEN NULL
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS affected_raw,
         CASE WHEN event_id % 11 = 0 THEN '0'
              WHEN event_id % 11 = 1 THEN '"' || substr(served_n, 1, 1) || ',' || substr(served_n, 2, 3) || '"'
              ELSE served_n END AS served_raw,
         CASE event_id % 5 WHEN 0 THEN '0%' WHEN 1 THEN '<' || CAST(event_id % 9 + 1 AS VARCHAR) || '%'
              WHEN 2 THEN NULL ELSE CAST(event_id % 40 + 1 AS VARCHAR) || '.5%' END AS pct_out,
         CASE event_id % 11 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
              WHEN 2 THEN strftime(ts, '%m-%d-%Y %H:%M:%S') WHEN 3 THEN 'not a time' WHEN 4 THEN strftime(ts, '%-m/%-d/%Y %-I:%M %p')
              WHEN 5 THEN strftime(ts, '%b %-d, %Y %-H:%M') WHEN 6 THEN strftime(ts, '%-m/%-d/%y %H:%M')
              WHEN 7 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') WHEN 8 THEN strftime(ts, '%Y%m%d %H:%M:%S')
              WHEN 9 THEN strftime(ts, '%-d %B %Y') ELSE strftime(ts, '%Y-%m-%d') END AS ts_raw,
         CASE event_id % 10 WHEN 7 THEN ' MUNI ' WHEN 8 THEN 'county' END AS key_raw
  FROM raw),
canon AS (
  SELECT state, source_file, row_id, emc,
         coalesce(CASE WHEN trim(county_a) <> '' THEN county_a END,
                  CASE WHEN trim(county_b) <> '' THEN county_b END) AS county,
         affected_raw AS aff, served_raw AS srv, pct_out, ts_raw
  FROM feed),
cmap AS (
  SELECT DISTINCT 's' || CAST(k % 2 AS VARCHAR) AS map_state, raw AS map_raw, 'c' || CAST(k AS VARCHAR) AS map_std
  FROM mnum, (SELECT unnest([0, 1]) AS v) vv,
       LATERAL (SELECT CASE WHEN v = 0 THEN 'c' || CAST(k AS VARCHAR) ELSE 'xx - c' || CAST(k AS VARCHAR) END AS raw)),
typed AS (
  SELECT c.*, {ts} AS ts, {aff} AS affected, {srv} AS customers_served
  FROM canon c),
typed2 AS (SELECT *, CAST(ts AS DATE) AS report_date FROM typed),
good AS (
  SELECT * FROM canon WHERE county IS NOT NULL AND county NOT IN ('unknown', 'Unknown', 'UNKNOWN', ''))
"""


def clean(x: str) -> str:
    return f"coalesce(TRY_CAST(regexp_replace(CAST({x} AS VARCHAR), '[\",]', '', 'g') AS DOUBLE), 0.0)"


TS_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f", "%m-%d-%Y %H:%M:%S", "%m/%d/%Y %I:%M %p", "%b %d, %Y %H:%M",
              "%m/%d/%y %H:%M", "%Y/%m/%d %H:%M:%S", "%Y%m%d %H:%M:%S", "%d %B %Y")


def parse_ts(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return "coalesce(" + ", ".join(f"try_strptime({t}, '{f}')" for f in TS_FORMATS) + f", TRY_CAST({t} AS TIMESTAMP))"


def pct_frac(x: str) -> str:
    return f"(TRY_CAST(regexp_replace(rtrim(replace(CAST({x} AS VARCHAR), '<', '')), '%+$', '') AS DOUBLE) / 100.0)"


def norm_county(x: str) -> str:
    return f"regexp_replace(lower(trim({x})), '^([a-z]{{2}})-', '\\1 - ')"


RAW_FILLED = RAW.format(ts=parse_ts("ts_raw"), aff=clean("aff"), srv=clean("srv"))


def with_raw(select: str) -> str:
    return f"WITH {BASE.strip()},\n{RAW_FILLED.strip()}\n{select}"


ORACLE.update({
    "fn_title": with_raw(
        "SELECT state, row_id, county_a AS raw, " + title("county_a") + " AS title FROM feed"
    ),
    "std_coalesce_duplicates": with_raw("SELECT state, row_id, county FROM canon"),
    "std_drop_bad_county": with_raw("SELECT state, row_id, county FROM good"),
    "std_impute_served": with_raw(
        f"SELECT state, row_id, {clean('aff')} AS affected, {pct_frac('pct_out')} AS pct, "
        f"CAST(CAST(round_even({clean('aff')} / nullif({pct_frac('pct_out')}, 0.0), 0) AS BIGINT) AS DOUBLE) AS customers_served "
        f"FROM canon"
    ),
    "std_parse_timestamp": with_raw("SELECT state, row_id, ts FROM typed"),
    "std_clean_numeric": with_raw("SELECT state, row_id, affected, customers_served FROM typed"),
    "std_filter_date": with_raw("SELECT state, row_id, ts FROM typed2 WHERE report_date = DATE '2024-01-15'"),
    "std_filter_date_range": with_raw(
        "SELECT state, row_id, ts, report_date FROM typed2 "
        "WHERE report_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
    ),
    "std_drop_zero_served": with_raw("SELECT state, row_id, customers_served FROM typed2 WHERE customers_served <> 0"),
    "std_normalize_county": with_raw(f"SELECT state, row_id, {norm_county('county')} AS county_key FROM good"),
    "std_map_county": with_raw(
        f"SELECT g.state, g.row_id, m.map_std AS county FROM good g JOIN cmap m "
        f"ON lower(trim(g.state)) = m.map_state AND {norm_county('g.county')} = m.map_raw"
    ),
    "join_county_map": with_raw(
        f"SELECT g.state, g.row_id, g.county AS raw_county, m.map_std AS county FROM good g JOIN cmap m "
        f"ON lower(trim(g.state)) = m.map_state AND {norm_county('g.county')} = m.map_raw"
    ),
    "std_pick_larger_column": with_raw(
        f"SELECT state, row_id, CASE WHEN t.ta >= t.tb THEN {clean('aff')} ELSE {clean('alt')} END AS affected "
        f"FROM (SELECT *, '\"' || CAST(row_id % 7 AS VARCHAR) || '\"' AS alt FROM canon) c, "
        f"(SELECT sum({clean('aff')}) AS ta, sum({clean('alt')}) AS tb "
        f"FROM (SELECT *, '\"' || CAST(row_id % 7 AS VARCHAR) || '\"' AS alt FROM canon)) t"
    ),
    "std_standardize": with_raw(
        f"SELECT t.state, t.report_date, m.map_std AS county, t.emc, t.ts, t.affected, t.customers_served, "
        f"t.source_file, t.row_id FROM typed2 t JOIN cmap m "
        f"ON lower(trim(t.state)) = m.map_state AND {norm_county('t.county')} = m.map_raw "
        f"WHERE t.emc IS NOT NULL AND t.county IS NOT NULL AND t.county NOT IN ('unknown', 'Unknown', 'UNKNOWN', '') "
        f"AND t.ts IS NOT NULL AND t.customers_served <> 0"
    ),
})


# ------------------------------------------------- mapping, quality, sets --
def lcs(x: str, y: str) -> str:
    """Longest common subsequence, row by row of the usual table."""
    rows = f"list_transform(string_split({x}, ''), lambda cx: list_prepend(0, list_transform(string_split({y}, ''), lambda cy: CASE WHEN cx = cy THEN 1 ELSE 0 END)))"
    first = f"list_transform(range(0, length({y}) + 1), lambda z: CAST(0 AS INTEGER))"
    step = ("list_reduce(list_prepend([CAST(0 AS INTEGER)], list_transform(range(2, len(r) + 1), lambda j: [CAST(j AS INTEGER)])), "
            "lambda t, j: list_append(t, greatest(t[-1], acc[j[1]], acc[j[1] - 1] + r[j[1]])))")
    return f"(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 ELSE list_reduce(list_prepend({first}, {rows}), lambda acc, r: {step})[-1] END)"


def ratio(x: str, y: str) -> str:
    return f"(CASE WHEN length({x}) + length({y}) = 0 THEN CAST(100 AS DOUBLE) ELSE CAST(200 AS DOUBLE) * {lcs(x, y)} / (length({x}) + length({y})) END)"


def part_ratio(x: str, y: str) -> str:
    def windows(short: str, long: str) -> str:
        window = f"substr({long}, greatest(0, i) + 1, i + length({short}) - greatest(0, i))"
        return f"list_max(list_transform(range(1 - length({short}), length({long})), lambda i: {ratio(short, window)}))"

    return (
        f"(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN CASE WHEN {x} = {y} THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
        f"WHEN length({x}) < length({y}) THEN {windows(x, y)} WHEN length({x}) > length({y}) THEN {windows(y, x)} "
        f"ELSE greatest({windows(x, y)}, {windows(y, x)}) END)"
    )


def fuzzy_ctes(names: str) -> str:
    """fz: (state, raw, standard, score) of every raw name of ``names`` and master county of its state."""
    words = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> '')"
    only = "list_sort(list_distinct(list_filter({0}, lambda x: NOT list_contains({1}, x))))"
    d = "CAST({0} AS DOUBLE)"
    apart = f"(length(own) + length(other) - 2 * {lcs('own', 'other')})"
    sets = (
        f"CASE WHEN n_common > 0 AND (own = '' OR other = '') THEN {d.format(100)} ELSE greatest("
        f"CASE WHEN lft + rgt > 0 THEN 100 - {d.format(100)} * {apart} / (lft + rgt) ELSE {d.format(0)} END, "
        f"CASE WHEN n > 0 THEN greatest(100 - {d.format(100)} * (1 + length(own)) / (n + lft), 100 - {d.format(100)} * (1 + length(other)) / (n + rgt)) ELSE {d.format(0)} END) END"
    )
    return f"""fp AS (SELECT r.state, r.raw, m.county AS standard, {words.format('r.raw')} AS wa, {words.format('m.county')} AS wb
  FROM {names} r JOIN master m ON r.state = m.state),
fq AS (SELECT *, array_to_string(list_sort(wa), ' ') AS sa, array_to_string(list_sort(wb), ' ') AS sb,
  array_to_string({only.format('wa', 'wb')}, ' ') AS own, array_to_string({only.format('wb', 'wa')}, ' ') AS other,
  list_sort(list_distinct(list_filter(wa, lambda x: list_contains(wb, x)))) AS common FROM fp),
fl AS (SELECT *, len(common) AS n_common, length(array_to_string(common, ' ')) AS n FROM fq),
fg AS (SELECT *, n + CASE WHEN n > 0 THEN 1 ELSE 0 END + length(own) AS lft, n + CASE WHEN n > 0 THEN 1 ELSE 0 END + length(other) AS rgt,
  CAST(greatest(length(raw), length(standard)) AS DOUBLE) / least(length(raw), length(standard)) AS factor FROM fl),
fz AS (SELECT state, raw, standard, CASE
    WHEN factor < 1.5 THEN greatest({ratio('raw', 'standard')}, {d.format(0.95)} * greatest({ratio('sa', 'sb')}, {sets}))
    ELSE greatest({ratio('raw', 'standard')}, CASE WHEN factor < 8 THEN {d.format(0.9)} ELSE {d.format(0.6)} END * {part_ratio('raw', 'standard')},
      {d.format(0.95)} * CASE WHEN factor < 8 THEN {d.format(0.9)} ELSE {d.format(0.6)} END
      * CASE WHEN n_common > 0 THEN {d.format(100)} ELSE greatest({part_ratio('sa', 'sb')}, {part_ratio('own', 'other')}) END) END AS score
  FROM fg)"""


EXTRA = f"""
rc AS (
  SELECT DISTINCT state, trim(replace(lower(v), 'county', '')) AS raw
  FROM (SELECT state, unnest([county_a, county_b]) AS v FROM feed
        WHERE key_raw IS NULL OR lower(trim(key_raw)) <> 'muni') u
  WHERE v IS NOT NULL),
rcf AS (SELECT * FROM rc WHERE raw <> ''),
{fuzzy_ctes("rcf")},
saidi26 AS (
  SELECT state, report_date, county, sum(affected) * CAST(0.26 AS DOUBLE) / max(customers_served) AS saidi
  FROM sreports GROUP BY state, report_date, county),
metrics26 AS (
  SELECT s.state, s.report_date, s.county, d.saidi, m.lower_saifi, m.middle_saifi, m.upper_saifi
  FROM metrics m JOIN spine s ON m.state = s.state AND m.report_date = s.report_date AND m.county = s.county
  LEFT JOIN saidi26 d ON s.state = d.state AND s.report_date = d.report_date AND s.county = d.county),
disp_base AS (
  SELECT state AS state_code, report_date AS Date, {title('county')} AS County,
         {disp('saidi')} AS SAIDI, {disp('middle_saifi')} AS SAIFI,
         {disp('lower_saifi')} AS LOWER_SAIFI, {disp('upper_saifi')} AS UPPER_SAIFI FROM metrics),
disp_cand AS (
  SELECT state AS state_code, report_date AS Date, {title('county')} AS County,
         {disp('saidi')} AS SAIDI, {disp('middle_saifi')} AS SAIFI,
         {disp('lower_saifi')} AS LOWER_SAIFI, {disp('upper_saifi')} AS UPPER_SAIFI FROM metrics26),
histx AS (
  SELECT {title('state_name')} AS State, {title('county')} AS County, fips AS FIPS, saidi AS SAIDI,
         middle_saifi AS SAIFI, report_date AS Date, state AS state_code
  FROM ({ENRICHED.format(src="metrics")}) e)
"""


def with_extra(select: str) -> str:
    return f"WITH {BASE.strip()},\n{RAW_FILLED.strip()},\n{EXTRA.strip()}\n{select}"


def _match(b: str, o: str) -> str:
    nb, no = f"TRY_CAST({b} AS DOUBLE)", f"TRY_CAST({o} AS DOUBLE)"
    return (
        f"(CASE WHEN {b} LIKE '<%' AND {o} LIKE '<%' THEN {b} = {o} "
        f"WHEN {b} LIKE '<%' OR {o} LIKE '<%' THEN FALSE "
        f"WHEN {nb} IS NULL AND {no} IS NULL THEN TRUE "
        f"ELSE coalesce(abs({nb} - {no}) <= 0.0001, FALSE) END)"
    )


_CMP_COLS = ("SAIDI", "SAIFI", "LOWER_SAIFI", "UPPER_SAIFI")
_CMP = " UNION ALL ".join(
    f"SELECT b.state_code, b.Date, b.County, '{c}' AS \"Column\", b.{c} AS Baseline, o.{c} AS Optimized "
    f"FROM disp_base b JOIN disp_cand o ON b.state_code = o.state_code AND b.Date = o.Date AND b.County = o.County "
    f"WHERE NOT {_match('b.' + c, 'o.' + c)}"
    for c in _CMP_COLS
)

ORACLE.update({
    "agg_distinct_counties": with_extra("SELECT state, raw FROM rcf ORDER BY state, raw"),
    "join_fuzzy_top1": with_extra(
        "SELECT state, raw, standard, score FROM (SELECT *, row_number() OVER "
        "(PARTITION BY state, raw ORDER BY score DESC, standard ASC) AS rn FROM fz WHERE score >= 85.0) WHERE rn = 1"
    ),
    "win_best_match": with_extra(
        "SELECT state, raw, standard, score, CAST(row_number() OVER (PARTITION BY state, raw ORDER BY score DESC, standard ASC) AS INTEGER) AS place "
        "FROM fz WHERE score >= 85.0"
    ),
    "qa_mapping_coverage": with_extra(
        "SELECT state, 'raw_unmapped' AS issue, raw AS name FROM rcf r WHERE NOT EXISTS "
        "(SELECT 1 FROM cmap m WHERE m.map_state = r.state AND m.map_raw = r.raw) "
        "UNION ALL SELECT DISTINCT map_state AS state, 'mapped_not_master' AS issue, map_std AS name FROM cmap c "
        "WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.state = c.map_state AND m.county = c.map_std) "
        "UNION ALL SELECT state, 'master_never_hit' AS issue, county AS name FROM master m WHERE NOT EXISTS "
        "(SELECT 1 FROM rcf r JOIN cmap c ON c.map_state = r.state AND c.map_raw = r.raw "
        "WHERE r.state = m.state AND c.map_std = m.county) "
        "UNION ALL SELECT state, 'percent_mapped_to_count' AS issue, raw || ' -> ' || standard AS name FROM ("
        "SELECT 's' || CAST(k % 2 AS VARCHAR) AS state, CASE k % 3 WHEN 0 THEN '% out ' WHEN 1 THEN 'percent ' ELSE 'out ' END || CAST(k AS VARCHAR) AS raw, "
        "CASE WHEN k % 2 = 0 THEN 'per_outage_customers_affected' WHEN k % 5 = 0 THEN 'customers_served' ELSE 'county' END AS standard FROM mnum) "
        "WHERE standard <> 'county' AND (raw LIKE '%|%%' ESCAPE '|' OR raw LIKE 'percent%')"
    ),
    "agg_null_profile": with_extra(
        "SELECT provider, sample_source, \"column\", total_rows, null_count FROM ("
        "SELECT emc AS provider, min(source_file) AS sample_source, count(*) AS total_rows, "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
                    ("county_a", "county_b", "affected_raw", "served_raw", "pct_out", "ts_raw", "key_raw"))
        + " FROM feed GROUP BY emc) "
        "UNPIVOT (null_count FOR \"column\" IN (county_a, county_b, affected_raw, served_raw, pct_out, ts_raw, key_raw)) "
        "WHERE null_count > 0"
    ),
    "join_compare": with_extra(
        "SELECT b.state_code, b.Date, b.County, "
        + ", ".join(f"b.{c} AS {c}_base, o.{c} AS {c}_opt" for c in ("SAIDI", "LOWER_SAIFI", "SAIFI", "UPPER_SAIFI"))
        + " FROM disp_base b JOIN disp_cand o "
        "ON b.state_code = o.state_code AND b.Date = o.Date AND b.County = o.County"
    ),
    "qa_compare_tolerance": with_extra(_CMP),
    "set_replace_date": with_extra(
        "SELECT State, County, FIPS, SAIDI, SAIFI, Date, state_code FROM histx WHERE Date <> DATE '2024-01-15' "
        "UNION ALL SELECT State, County, FIPS, SAIDI * 2.0 AS SAIDI, SAIFI, Date, state_code FROM histx "
        "WHERE Date = DATE '2024-01-15'"
    ),
})


# ------------------------------------------------------------ sinks, files --
HISTORY = (
    f"SELECT {title('state_name')} AS State, {title('county')} AS County, fips AS FIPS, saidi AS SAIDI, "
    f"middle_saifi AS SAIFI, report_date AS Date, state AS state_code FROM (" + ENRICHED.format(src="metrics") + ")"
)
ORACLE.update({
    "sink_dashboard_csv": with_base(
        f"SELECT {title('county')} AS County, fips AS FIPS, {disp('saidi')} AS SAIDI, "
        f"{disp('lower_saifi')} AS LOWER_SAIFI, {disp('middle_saifi')} AS SAIFI, {disp('upper_saifi')} AS UPPER_SAIFI, "
        f"{title('state_name')} AS State, strftime(report_date, '%Y-%m-%d') AS Date, state AS state_code "
        f"FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
    "agg_write_summary": with_base(
        "SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_columns, TRUE AS success FROM (" + ENRICHED.format(src="metrics") + ")"
    ),
    "sink_history_upsert": with_base(
        f"SELECT *, CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month, Date AS report_date FROM ({HISTORY})"
    ),
})

# The feed files that ``sources.fixtures`` writes, as the reader should see them.
FILES = """
ev AS (
  SELECT *, 's' || CAST(user_id % 2 AS VARCHAR) AS state, 'c' || CAST(user_id % 50 AS VARCHAR) AS c,
         CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup', 'error') THEN event_type ELSE 'other' END AS layout
  FROM events),
headers AS (
  SELECT * FROM (VALUES
    ('click', 'timestamp,EMC,Place,out_now,meters,out_alt'), ('other', 'timestamp,EMC,Place,out_now,meters,out_alt'),
    ('view', 'timestamp,EMC,Place_Name,OutCount,MeterCount'),
    ('purchase', 'timestamp,EMC,Area,Out Total,Meter Total,% Out'), ('signup', 'timestamp,EMC,county,out,% out'),
    ('error', 'updated,EMC,zone,people out')) AS h(layout, header)),
colmap AS (
  SELECT * FROM (VALUES
    ('place', 'county'), ('place_name', 'county'), ('area', 'county'), ('county', 'county'), ('zone', 'county'),
    ('out_now', 'per_outage_customers_affected'), ('out_alt', 'per_outage_customers_affected'),
    ('outcount', 'per_outage_customers_affected'), ('out total', 'per_outage_customers_affected'),
    ('out', 'per_outage_customers_affected'), ('people out', 'per_outage_customers_affected'),
    ('meters', 'customers_served'), ('metercount', 'customers_served'), ('meter total', 'customers_served'),
    ('timestamp', 'timestamp'), ('updated', 'timestamp')) AS m(normalized, standard)),
last_day AS (SELECT max(CAST(ts AS DATE)) AS d FROM ev),
files AS (
  SELECT ev.*, header,
         CASE event_id % 9 WHEN 0 THEN upper(c) WHEN 1 THEN c || '   ' WHEN 2 THEN 'xx-' || c
              WHEN 3 THEN 'Unknown' WHEN 4 THEN 'NA' ELSE c END AS county_raw,
         CASE WHEN event_id % 7 = 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')
              WHEN event_id % 7 = 1 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS affected,
         CASE WHEN event_id % 5 = 0 THEN '<1%' ELSE CAST(event_id % 30 + 1 AS VARCHAR) || '.25%' END AS pct_text,
         CASE WHEN event_id % 13 = 0 THEN '0' ELSE format('{:,}', 1000 + 10 * (user_id % 50) + length(event_type)) END AS served_text
  FROM ev JOIN headers USING (layout)),
lines AS (
  SELECT *, CAST(ts AS DATE) = (SELECT d FROM last_day) AS late,
         CASE layout WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') WHEN 'purchase' THEN strftime(ts, '%m-%d-%Y %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END || ',' || event_type || ',' || rtrim(county_raw) || ',' || (CASE WHEN affected LIKE '%,%' THEN '"' || affected || '"' ELSE affected END)
         || CASE layout WHEN 'view' THEN ',' || (CASE WHEN served_text LIKE '%,%' THEN '"' || served_text || '"' ELSE served_text END) WHEN 'purchase' THEN ',' || (CASE WHEN served_text LIKE '%,%' THEN '"' || served_text || '"' ELSE served_text END) || ',' || pct_text
              WHEN 'signup' THEN ',' || pct_text WHEN 'error' THEN ''
              ELSE ',' || (CASE WHEN served_text LIKE '%,%' THEN '"' || served_text || '"' ELSE served_text END) || ',' || CASE WHEN event_id % 3 = 0 THEN (CASE WHEN affected LIKE '%,%' THEN '"' || affected || '"' ELSE affected END) ELSE '' END END AS line
  FROM files),
seen AS (
  SELECT *, CASE WHEN county_raw <> 'NA' THEN rtrim(county_raw) END AS county_read,
         CASE WHEN affected <> 'n/a' THEN affected END AS affected_read,
         CASE WHEN layout <> 'signup' THEN served_text END AS served_read,
         CASE WHEN layout = 'signup' THEN pct_text END AS pct_read,
         CASE layout WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') WHEN 'purchase' THEN strftime(ts, '%m-%d-%Y %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_read,
         CASE layout WHEN 'view' THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS ts_parsed
  FROM files WHERE layout <> 'error'),
kmap AS (
  SELECT DISTINCT 's' || CAST(k % 2 AS VARCHAR) AS map_state, raw, 'c' || CAST(k AS VARCHAR) AS standard
  FROM mnum, (SELECT unnest([0, 1]) AS v) vv,
       LATERAL (SELECT CASE WHEN v = 0 THEN 'c' || CAST(k AS VARCHAR) ELSE 'xx - c' || CAST(k AS VARCHAR) END AS raw))
"""


def with_files(select: str) -> str:
    return f"WITH {BASE.strip()},\n{FILES.strip()}\n{select}"


ORACLE.update({
    "scan_csv_dynamic": with_files("SELECT state, header, count(*) AS n_rows FROM seen GROUP BY state, header"),
    "scan_provider_key": with_files("SELECT state, event_type AS emc, count(*) AS n_rows FROM seen GROUP BY state, event_type"),
    "scan_source_lineage": with_files("SELECT state, layout, count(*) AS n_rows FROM seen GROUP BY state, layout"),
    "lookup_raw_counties": with_files(
        "SELECT DISTINCT state, lower(trim(county_raw)) AS raw FROM files WHERE trim(county_raw) <> ''"
    ),
    "lookup_master_counties": with_files("SELECT DISTINCT state, county FROM master"),
    "lookup_fips": with_files(
        "SELECT lower(trim(state_abbr)) AS _fips_state, lower(trim(county_name)) AS _fips_county, fips, state_name FROM fips"
    ),
    "lookup_county_map": with_files(
        f"SELECT s.state, s.raw, s.n_reports, m.standard FROM (SELECT state, {norm_county('county_read')} AS raw, count(*) AS n_reports "
        "FROM seen WHERE county_read IS NOT NULL GROUP BY ALL) s LEFT JOIN kmap m ON s.state = m.map_state AND s.raw = m.raw"
    ),
    "agg_distinct_columns": with_files(
        "SELECT DISTINCT state, lower(trim(unnest(string_split(header, ',')))) AS column_name FROM files"
    ),
})


# The same metrics over the reports that the files hold once standardized.
FILE_REPORTS = f"""
{FILES.strip()},
reports AS (
  SELECT s.state, CAST(s.ts_parsed AS DATE) AS report_date, m.standard AS county, s.event_type AS emc,
         CAST(s.ts_parsed AS TIMESTAMP) AS ts, {clean('s.affected_read')} AS affected,
         {clean('s.served_read')} AS customers_served, s.layout AS source_file, CAST(s.event_id AS BIGINT) AS row_id
  FROM seen s JOIN kmap m ON s.state = m.map_state AND {norm_county('s.county_read')} = m.raw
  WHERE s.county_read NOT IN ('unknown', 'Unknown', 'UNKNOWN', '') AND {clean('s.served_read')} <> 0),
"""


def with_jobs(select: str, run_keys: str) -> str:
    """BASE over the files' reports: mnum moves to the front, as the files' county map needs it."""
    base = BASE.strip()
    rest = base[base.index("mnum AS (") :]
    mnum, rest = rest[: rest.index("master AS (")], rest[rest.index("master AS (") :]
    rest = rest.replace("run_keys AS (SELECT DISTINCT state, report_date FROM reports)", f"run_keys AS ({run_keys})")
    return f"WITH {mnum.strip()}\n{FILE_REPORTS.strip()}\n{rest}\n{select}"


ALL_DAYS = "SELECT DISTINCT state, CAST(ts AS DATE) AS report_date FROM ev"
REPORTED_DAYS = "SELECT DISTINCT state, report_date FROM reports"
JOB_HISTORY = (
    f"SELECT *, CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month, Date AS report_date FROM ({HISTORY})"
)
ORACLE.update({
    "scan_union_by_name": with_files(
        'SELECT state, ts_read AS "timestamp", event_type AS emc, county_read AS county, '
        'affected_read AS per_outage_customers_affected, served_read AS customers_served, pct_read AS "% out", '
        "FALSE AS _impute FROM seen"
    ),
    "scan_null_literals": with_files(
        "SELECT state, CAST(0 AS BIGINT) AS null_timestamp, CAST(0 AS BIGINT) AS null_emc, count(*) FILTER (county_read IS NULL) AS null_county, "
        "count(*) FILTER (affected_read IS NULL) AS null_per_outage_customers_affected, "
        "count(*) FILTER (served_read IS NULL) AS null_customers_served, "
        'count(*) FILTER (pct_read IS NULL) AS "null_% out", CAST(0 AS BIGINT) AS null__impute FROM seen GROUP BY state'
    ),
    "job_daily": with_jobs(
        f"SELECT {title('county')} AS County, fips AS FIPS, {disp('saidi')} AS SAIDI, "
        f"{disp('lower_saifi')} AS LOWER_SAIFI, {disp('middle_saifi')} AS SAIFI, {disp('upper_saifi')} AS UPPER_SAIFI, "
        f"{title('state_name')} AS State, report_date AS Date FROM (" + ENRICHED.format(src="metrics") + ")",
        ALL_DAYS,
    ),
    "job_backfill": with_jobs(JOB_HISTORY, REPORTED_DAYS),
    "sink_history_backfill": with_jobs(
        f"SELECT h.state_code, year, month, n_rows, n_days, n_skipped AS n_skipped_days FROM "
        f"(SELECT state_code, year, month, count(*) AS n_rows, count(DISTINCT report_date) AS n_days FROM ({JOB_HISTORY}) "
        f"GROUP BY state_code, year, month) h JOIN "
        f"(SELECT state AS state_code, (SELECT date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 2 FROM ev) "
        f"- count(*) AS n_skipped FROM run_keys GROUP BY state) k ON h.state_code = k.state_code",
        REPORTED_DAYS,
    ),
})


# ------------------------------------------------ landing, layouts, settings --
LAYOUTS = """
lay AS (SELECT DISTINCT state, header FROM files),
cols AS (SELECT state, header, CAST(unnest(range(len(names))) AS INTEGER) AS position, unnest(names) AS raw
         FROM (SELECT *, string_split(header, ',') AS names FROM lay)),
named AS (SELECT *, lower(trim(raw)) AS normalized FROM cols),
renamed AS (SELECT n.*, m.standard, coalesce(m.standard, n.normalized) AS renamed FROM named n LEFT JOIN colmap m USING (normalized)),
kept AS (SELECT * FROM renamed r WHERE (standard IS NOT NULL OR renamed IN ('% out', 'emc'))
           AND (renamed <> '% out' OR NOT EXISTS (SELECT 1 FROM renamed s
                WHERE s.state = r.state AND s.header = r.header AND s.renamed = 'customers_served'))),
missing AS (
  SELECT state, header, missing_column FROM lay, (SELECT unnest(['county', 'per_outage_customers_affected', 'customers_served', 'timestamp']) AS missing_column) w
  WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.state = lay.state AND k.header = lay.header
                    AND CASE WHEN k.renamed = '% out' THEN 'customers_served' ELSE k.renamed END = missing_column)),
report AS (
  SELECT l.state, l.header, coalesce(string_agg(missing_column, ',' ORDER BY missing_column), '') AS missing,
         CASE WHEN NOT list_contains(string_split(l.header, ','), 'timestamp') THEN 'no timestamp column' END AS skipped_reason
  FROM lay l LEFT JOIN missing m ON l.state = m.state AND l.header = m.header GROUP BY l.state, l.header)
"""


def with_layouts(select: str) -> str:
    return f"WITH {BASE.strip()},\n{FILES.strip()},\n{LAYOUTS.strip()}\n{select}"


_N = "CAST(count(*) AS BIGINT)"
_BYTES = "CAST(sum(strlen(line) + 1) AS BIGINT)"
ORACLE.update({
    "scan_file_manifest": with_files(
        f"SELECT state, layout, CASE WHEN late THEN 'new' ELSE 'same' END AS change, {_N} AS n_records FROM lines GROUP BY ALL"
    ),
    "scan_stale_filter": with_files(f"SELECT state, layout, {_N} AS n_records FROM lines WHERE late GROUP BY ALL"),
    "scan_recent_slice": with_files(
        'SELECT state, ts_read AS "timestamp", event_type AS emc, county_read AS county, '
        'affected_read AS per_outage_customers_affected, served_read AS customers_served, pct_read AS "% out", '
        "FALSE AS _impute, CAST(ts_parsed AS DATE) AS report_date FROM seen "
        "WHERE CAST(ts_parsed AS DATE) IN (SELECT DISTINCT CAST(ts_parsed AS DATE) FROM seen ORDER BY 1 DESC LIMIT 2)"
    ),
    "scan_full_history": with_jobs(
        "SELECT state, report_date, county, emc, ts, affected, customers_served FROM reports", REPORTED_DAYS
    ),
    "agg_bytes_summary": with_files(
        f"SELECT state, {_BYTES} AS bytes_available, CAST(coalesce(sum(strlen(line) + 1) FILTER (WHERE late), 0) AS BIGINT) AS bytes_read, "
        "100.0 - CAST(coalesce(sum(strlen(line) + 1) FILTER (WHERE late), 0) AS DOUBLE) / CAST(sum(strlen(line) + 1) AS DOUBLE) * 100.0 AS reduction_pct "
        "FROM lines GROUP BY state"
    ),
    "agg_file_utilization": with_files(
        "SELECT state, layout, bytes, n_rows, n_target_rows, CAST(0 AS BIGINT) AS n_unparsed, row_utilization, "
        "coalesce(row_utilization * bytes, 0.0) AS est_target_bytes, "
        "CASE WHEN row_utilization >= 0.8 THEN 'high' WHEN row_utilization <= CASE WHEN state = 's1' THEN 0.02 ELSE 0.3 END THEN 'low' ELSE '' END AS note "
        f"FROM (SELECT state, layout, {_BYTES} AS bytes, CAST(count(*) FILTER (WHERE layout <> 'error') AS BIGINT) AS n_rows, "
        "CAST(count(*) FILTER (WHERE late AND layout <> 'error') AS BIGINT) AS n_target_rows, "
        "CASE WHEN layout <> 'error' THEN CAST(count(*) FILTER (WHERE late) AS DOUBLE) / CAST(count(*) AS DOUBLE) END AS row_utilization "
        "FROM lines GROUP BY state, layout)"
    ),
    "lookup_settings": with_files(
        f"SELECT l.state, data_bytes, CAST(500 AS BIGINT) AS head_bytes, "
        "CAST(CASE WHEN l.state = 's1' THEN n * 1000 ELSE 524288 END AS BIGINT) AS tail_bytes, "
        "CAST(CASE WHEN l.state = 's1' THEN n * 100 ELSE 2097152 END AS BIGINT) AS threshold_bytes, "
        "CAST(2 AS BIGINT) AS stale_threshold_days, TRUE AS use_optimization, CAST(0.8 AS DOUBLE) AS utilization_threshold_high, "
        "CAST(CASE WHEN l.state = 's1' THEN 0.02 ELSE 0.3 END AS DOUBLE) AS utilization_log_low, "
        "data_bytes > CASE WHEN l.state = 's1' THEN n * 100 ELSE 2097152 END AS above_threshold "
        f"FROM (SELECT state, {_BYTES} AS data_bytes FROM lines GROUP BY state) l "
        "JOIN (SELECT state, count(*) AS n FROM master GROUP BY state) m ON l.state = m.state"
    ),
    "scan_require_timestamp": with_layouts("SELECT state, header, skipped_reason FROM report"),
    "lookup_col_map": with_layouts("SELECT state, header, position, normalized, standard FROM renamed"),
    "lookup_col_lists": with_layouts("SELECT DISTINCT state, standard AS canonical, normalized AS raw FROM renamed WHERE standard IS NOT NULL"),
    "std_normalize_names": with_layouts("SELECT state, header, position, raw, normalized FROM named"),
    "std_rename_columns": with_layouts("SELECT state, header, position, normalized, renamed FROM renamed"),
    "std_prune_columns": with_layouts("SELECT state, header, position, renamed FROM kept"),
    "std_required_columns": with_layouts("SELECT state, header, missing, skipped_reason FROM report"),
    "set_missing_columns": with_layouts("SELECT state, header, missing_column FROM missing"),
})

# The names of the files, as the mapping build sees them, against the master list.
FILE_NAMES = f"""
raw_names AS (SELECT DISTINCT state, trim(replace(lower(county_read), 'county', '')) AS raw FROM seen WHERE county_read IS NOT NULL),
file_names AS (SELECT * FROM raw_names WHERE raw <> ''),
{fuzzy_ctes("file_names")}
"""
ORACLE["job_mapping_build"] = (
    f"WITH {BASE.strip()},\n{FILES.strip()},\n{FILE_NAMES.strip()}\n"
    "SELECT state, raw, standard, score FROM (SELECT *, row_number() OVER (PARTITION BY state, raw ORDER BY score DESC, standard ASC) AS rn "
    "FROM fz WHERE score >= 85.0) WHERE rn = 1"
)
