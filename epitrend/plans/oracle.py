"""DuckDB SQL equal in result to each registered query (the driver runs it on
the same Parquet tables, registered as views). Fixtures are CTEs."""

from __future__ import annotations

from epitrend.config import CLEAN_COLUMNS, band_column
from epitrend.operators.geo import listed_aliases
from epitrend.plans import params as P

_REPORTS = """
fx_daily AS (
  SELECT CAST(o.o_orderdate AS DATE) AS Date, n.n_name AS Country,
         count(*) AS c,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS d,
         count(*) FILTER (WHERE o.o_orderstatus = 'O') AS r
  FROM orders o
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation n ON cu.c_nationkey = n.n_nationkey
  GROUP BY 1, 2),
fx_span AS (
  SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
  FROM orders),
fx_grid AS (
  SELECT Country, CAST(ts AS DATE) AS Date
  FROM (SELECT n.n_name AS Country, unnest(generate_series(s.lo, s.hi, INTERVAL 1 DAY)) AS ts
        FROM nation n CROSS JOIN fx_span s)),
fx_cum AS (
  SELECT g.Date, g.Country,
         CAST(sum(coalesce(x.c, 0)) OVER w AS DOUBLE) AS Confirmed,
         CAST(sum(coalesce(x.d, 0)) OVER w AS DOUBLE) AS Deaths,
         CAST(sum(coalesce(x.r, 0)) OVER w AS DOUBLE) AS Recovered
  FROM fx_grid g LEFT JOIN fx_daily x ON g.Country = x.Country AND g.Date = x.Date
  WINDOW w AS (PARTITION BY g.Country ORDER BY g.Date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rpt AS (
  SELECT Date, Country, Confirmed, Deaths, Recovered,
         Confirmed - (Deaths + Recovered) AS Active
  FROM fx_cum)"""

_CUSTOMERS = """
fx_daily AS (
  SELECT CAST(l.l_shipdate AS DATE) AS Date, o.o_custkey, sum(l.l_quantity) AS c,
         sum(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END) AS d,
         sum(CASE WHEN l.l_returnflag = 'A' THEN l.l_quantity ELSE 0 END) AS r
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2),
fx_cum AS (
  SELECT Date, 'CUSTOMER_' || o_custkey AS Country, CAST(sum(c) OVER w AS DOUBLE) AS Confirmed,
         CAST(sum(d) OVER w AS DOUBLE) AS Deaths, CAST(sum(r) OVER w AS DOUBLE) AS Recovered
  FROM fx_daily
  WINDOW w AS (PARTITION BY o_custkey ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rpt AS (
  SELECT Date, Country, Confirmed, Deaths, Recovered, Confirmed - (Deaths + Recovered) AS Active
  FROM fx_cum)"""

_LATEST = """,
latest AS (SELECT * FROM rpt WHERE Date = (SELECT max(Date) FROM rpt))"""

# The last row of every entity up to a day.
_LAST = f""",
latest AS (
  SELECT r.* FROM (SELECT DISTINCT Country, DATE '{P.AS_OF_LATE}' AS day FROM rpt) e
  ASOF JOIN rpt r ON e.Country = r.Country AND e.day >= r.Date)"""


def _band_sql(lo, up):
    return (f"CAST(abs(min(rn) FILTER (WHERE Confirmed >= {lo} AND Confirmed < {up})"
            f" - min(rn) FILTER (WHERE Confirmed >= {up})) + 1 AS BIGINT)"
            f" AS {band_column(lo, up)}")


def _bands(bands) -> str:
    """``bands`` and ``feats`` over ``rpt``."""
    cols = [band_column(lo, up) for lo, up in bands]
    return """,
fx_pos AS (
  SELECT *, row_number() OVER (PARTITION BY Country ORDER BY Date) AS rn
  FROM rpt WHERE Confirmed > 0),
bands AS (
  SELECT Country, min(Date) AS FirstDay,
         """ + ",\n         ".join(_band_sql(lo, up) for lo, up in bands) + """
  FROM fx_pos GROUP BY Country),
feats AS (
  SELECT * FROM bands
  WHERE FirstDay IS NOT NULL AND """ + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")"


_BAND_COLS = [band_column(lo, up) for lo, up in P.CUSTOMER_BANDS]
_NATION_COLS = [band_column(lo, up) for lo, up in P.NATION_BANDS]
_BANDS = _bands(P.CUSTOMER_BANDS)

_DIFFS = """,
base AS (SELECT * FROM feats WHERE Country = '""" + P.BASELINE + """'),
diffs AS (
  SELECT f.Country, '""" + P.BASELINE + """' AS baseline,
         CAST(""" + " + ".join(f"abs(f.{c} - b.{c})" for c in _BAND_COLS) + """ AS DOUBLE)
           AS abs_total_diff,
         CAST(""" + " + ".join(f"(f.{c} - b.{c})" for c in _BAND_COLS) + """ AS DOUBLE)
           AS rel_total_diff
  FROM feats f CROSS JOIN base b
  WHERE f.Country <> '""" + P.BASELINE + "')"

# The split as hash_split computes it: 32 bits of md5 against 0.8 x 2^32.
_SPLIT = f""",
split AS (
  SELECT Country, CASE WHEN ('0x' || substr(md5('42' || Country), 1, 8))::BIGINT < {round(0.8 * 2 ** 32)}
                       THEN 'train' ELSE 'test' END AS split
  FROM feats)"""

_RAW = """
fx_raw AS (
  SELECT event_id, user_id % 4 AS file,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS Country,
         CASE user_id % 4
           WHEN 0 THEN strftime(ts, '%-m/%-d/%Y %-H:%M')
           WHEN 1 THEN strftime(ts, '%-m/%-d/%y %-H:%M')
           WHEN 2 THEN CASE WHEN event_id % 101 = 0 THEN 'unknown'
                            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END
           ELSE CASE WHEN event_id % 10 = 0 THEN strftime(ts, '%-m/%-d/%Y %-H:%M')
                     ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
         END AS last_update,
         CASE WHEN event_id % 89 = 0 OR event_id % 7 = 0 THEN NULL
              WHEN event_id % 11 = 0 THEN ''
              WHEN event_id % 13 = 0 THEN 'junk'
              ELSE CAST(event_id % 50 AS VARCHAR) END AS Confirmed,
         CASE WHEN event_id % 89 = 0 OR event_id % 17 = 0 THEN NULL
              ELSE CAST(event_id % 5 AS VARCHAR) END AS Deaths,
         CASE WHEN event_id % 89 = 0 OR event_id % 19 = 0 THEN NULL
              ELSE CAST(event_id % 9 AS VARCHAR) END AS Recovered
  FROM events)"""

_DATED = """,
fx_text AS (
  SELECT *, split_part(split_part(replace(last_update, '/', '-'), ' ', 1), 'T', 1) AS dtext
  FROM fx_raw),
fx_parsed AS (
  SELECT *,
         CAST(try_strptime(dtext, '%m-%d-%Y') AS DATE) AS d1,
         CAST(try_strptime(dtext, '%m-%d-%y') AS DATE) AS d2,
         CAST(try_strptime(dtext, '%Y-%m-%d') AS DATE) AS d3
  FROM fx_text),
fx_ok AS (
  SELECT *,
         coalesce(CAST(d1 AS VARCHAR) LIKE '2%', false) AS ok1,
         coalesce(CAST(d2 AS VARCHAR) LIKE '2%', false) AS ok2
  FROM fx_parsed),
fx_flags AS (SELECT file, bool_or(ok1) AS any1, bool_or(ok2) AS any2 FROM fx_ok GROUP BY file),
dated AS (
  SELECT r.event_id, r.file, r.Country, r.last_update, r.Confirmed, r.Deaths, r.Recovered,
         CASE WHEN f.any1 THEN r.d1 WHEN f.any2 THEN r.d2 ELSE r.d3 END AS Date
  FROM fx_ok r JOIN fx_flags f ON r.file = f.file
  WHERE CASE WHEN f.any1 THEN r.ok1 WHEN f.any2 THEN r.ok2 ELSE true END)"""

_COERCED = """,
typed AS (
  SELECT event_id, file, Date, Country,
         TRY_CAST(Confirmed AS DOUBLE) AS Confirmed,
         TRY_CAST(Deaths AS DOUBLE) AS Deaths,
         TRY_CAST(Recovered AS DOUBLE) AS Recovered
  FROM dated),
coerced AS (
  SELECT Date, Country,
         coalesce(Confirmed, 0.0) AS Confirmed, coalesce(Deaths, 0.0) AS Deaths,
         coalesce(Recovered, 0.0) AS Recovered,
         coalesce(Confirmed, 0.0) - (coalesce(Deaths, 0.0) + coalesce(Recovered, 0.0)) AS Active,
         event_id, file
  FROM typed
  WHERE Country IS NOT NULL
    AND NOT (Confirmed IS NULL AND Deaths IS NULL AND Recovered IS NULL))"""


def _with(*ctes: str) -> str:
    return "WITH " + "".join(ctes) + "\n"


def _top_bottom(measure: str) -> str:
    return _with(_CUSTOMERS, _LAST) + f"""
(SELECT 'top' AS side, Country, {measure} FROM latest
 ORDER BY {measure} DESC NULLS LAST, Country ASC NULLS FIRST LIMIT 5)
UNION ALL
(SELECT 'bottom' AS side, Country, {measure} FROM latest
 ORDER BY {measure} ASC NULLS FIRST, Country ASC NULLS FIRST LIMIT 5)"""


def _similar(key: str) -> str:
    return _with(_CUSTOMERS, _BANDS, _DIFFS) + f"""
(SELECT 'most_similar' AS category, Country, abs_total_diff, rel_total_diff FROM diffs
 ORDER BY {key} ASC NULLS FIRST, Country ASC NULLS FIRST LIMIT 5)
UNION ALL
(SELECT 'most_different' AS category, Country, abs_total_diff, rel_total_diff FROM diffs
 ORDER BY {key} DESC NULLS LAST, Country ASC NULLS FIRST LIMIT 5)"""


_FEATURE_LIST = ", ".join(f"'{c}'" for c in _BAND_COLS)

_LABELS = """SELECT Country, true AS label_ok, true AS nearest_ok, {n} AS n_centers, {n} AS used, true AS means_ok
FROM feats"""

_COUNTRIES = "[" + ", ".join(f"'{n}'" for n in P.COUNTRY_NAMES) + "]"
_SPELLED = f"""
named AS (SELECT c_custkey, {_COUNTRIES}[c_nationkey + 1] AS name FROM customer),
spelled AS (
  SELECT c_custkey, CASE c_custkey % 8
           WHEN 0 THEN name
           WHEN 1 THEN upper(name) || '*'
           WHEN 2 THEN substr(name, 1, 1) || substr(name, 3)
           WHEN 3 THEN substr(name, 1, 3) || substr(name, 3)
           WHEN 4 THEN name || 'x'
           WHEN 5 THEN substr(name, 1, 1) || substr(name, 3) || 'x'
           WHEN 6 THEN 'zzzz' || name
           ELSE substr(name, 1, 5) || substr(name, 7) END AS Country
  FROM named)"""


def _key_sql(text: str) -> str:
    return f"trim(lower(regexp_replace({text}, '[^[:alnum:]]+', ' ', 'g')))"


# The nearest listed names of each spelling, all pairs compared.
_MATCHED = _SPELLED + """,
listed AS (
  SELECT """ + _key_sql("a") + """ AS alias, min(c) AS code FROM (VALUES
    """ + ", ".join("('" + a.replace("'", "''") + f"', '{c}')" for a, c in listed_aliases()) + """) t(a, c) GROUP BY 1),
key AS (SELECT DISTINCT Country, """ + _key_sql("Country") + """ AS k FROM spelled),
near AS (
  SELECT k.Country, l.code, levenshtein(k.k, l.alias) AS distance
  FROM key k JOIN listed l ON levenshtein(k.k, l.alias) <= least(3, length(k.k) // 4)),
least_off AS (SELECT Country, min(distance) AS distance FROM near GROUP BY 1),
best AS (
  SELECT n.Country, n.distance, list_sort(list_distinct(list(n.code))) AS codes
  FROM near n JOIN least_off m ON n.Country = m.Country AND n.distance = m.distance GROUP BY 1, 2),
matched AS (
  SELECT k.Country, CASE WHEN len(b.codes) = 1 THEN b.codes[1] END AS code,
         CASE WHEN b.distance = 0 THEN 'exact' WHEN len(b.codes) = 1 THEN 'approximate'
              WHEN len(b.codes) > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status,
         CAST(b.distance AS INTEGER) AS distance, array_to_string(b.codes, ',') AS candidates
  FROM key k LEFT JOIN best b ON b.Country = k.Country)"""

ORACLE_SQL: dict[str, str] = {
    "daily_rollup": """
WITH rows AS (
  SELECT CAST(o.o_orderdate AS DATE) AS Date, n.n_name AS Country, o.o_orderpriority,
         CAST(count(*) AS DOUBLE) AS Confirmed,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE) AS Deaths,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'O') AS DOUBLE) AS Recovered
  FROM orders o
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation n ON cu.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3)
SELECT Date, Country, sum(Confirmed) AS Confirmed, sum(Deaths) AS Deaths,
       sum(Recovered) AS Recovered, sum(Confirmed - (Deaths + Recovered)) AS Active
FROM rows GROUP BY Date, Country""",
    "qualify_entities": _with(_CUSTOMERS) + f"""
SELECT * FROM rpt WHERE Country IN (
  SELECT Country FROM rpt GROUP BY Country
  HAVING count(*) >= {P.QUALIFY['min_rows']}
     AND bool_or(Date = DATE '{P.QUALIFY['on']}' AND Confirmed > {P.QUALIFY['gt']}))""",
    "latest_snapshot": _with(_CUSTOMERS, _LATEST) + "SELECT * FROM latest",
    "as_of_snapshot": _with(_CUSTOMERS) + f"SELECT * FROM rpt WHERE Date = DATE '{P.AS_OF}'",
    "top_bottom_confirmed": _top_bottom("Confirmed"),
    "top_bottom_deaths": _top_bottom("Deaths"),
    "top_bottom_recovered": _top_bottom("Recovered"),
    "top_bottom_active": _top_bottom("Active"),
    "country_codes": _with(_REPORTS, _LATEST) + """,
aliases AS (
  SELECT trim(lower(regexp_replace(lower(replace(n.n_name, '_', ' ')), '[^[:alnum:]]+', ' ', 'g')))
           AS k,
         min(upper(substr(r.r_name, 1, 2)) || chr(CAST(n.n_nationkey + 65 AS INTEGER))) AS code
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name <> 'MIDDLE EAST'
  GROUP BY 1)
SELECT l.Date, l.Country, CAST(l.Confirmed AS BIGINT) AS Confirmed,
       CAST(l.Deaths AS BIGINT) AS Deaths, CAST(l.Recovered AS BIGINT) AS Recovered,
       CAST(l.Active AS BIGINT) AS Active, a.code AS Country_clean
FROM latest l
LEFT JOIN aliases a
  ON trim(lower(regexp_replace(l.Country, '[^[:alnum:]]+', ' ', 'g'))) = a.k""",
    "parquet_roundtrip": _with(_REPORTS) + "SELECT * FROM rpt",
    "register_view": _with(_CUSTOMERS, _LATEST) + "SELECT * FROM latest",
    "first_day": _with(_CUSTOMERS) + """
SELECT Country, min(Date) AS FirstDay FROM rpt WHERE Confirmed > 0 GROUP BY Country""",
    "next_value": _with(_CUSTOMERS) + """
SELECT Date, Country, Confirmed,
       lead(Confirmed, 1) OVER (PARTITION BY Country ORDER BY Date) AS next_Confirmed
FROM rpt""",
    "first_crossing": _with(_CUSTOMERS) + f""",
pos AS (SELECT *, row_number() OVER (PARTITION BY Country ORDER BY Date) AS rn
        FROM rpt WHERE Confirmed > 0)
SELECT Country,
       CAST(min(rn) FILTER (WHERE Confirmed >= 1 AND Confirmed < {P.THRESHOLD}) AS BIGINT)
         AS below_index,
       min(Date) FILTER (WHERE Confirmed >= 1 AND Confirmed < {P.THRESHOLD}) AS below_date,
       CAST(min(rn) FILTER (WHERE Confirmed >= {P.THRESHOLD}) AS BIGINT) AS above_index,
       min(Date) FILTER (WHERE Confirmed >= {P.THRESHOLD}) AS above_date
FROM pos GROUP BY Country""",
    "series_list": _with(_CUSTOMERS) + """
SELECT Country, CAST(count(*) AS BIGINT) AS length,
       string_agg(CAST(CAST(Confirmed AS BIGINT) AS VARCHAR), ',' ORDER BY Date) AS series
FROM rpt WHERE Confirmed > 0 GROUP BY Country""",
    "array_index": _with(_CUSTOMERS) + f""",
pos AS (SELECT *, row_number() OVER (PARTITION BY Country ORDER BY Date) AS rn
        FROM rpt WHERE Confirmed > 0),
hit AS (SELECT Country, arg_min(Confirmed, rn) FILTER (WHERE Confirmed >= {P.THRESHOLD}) AS value
        FROM pos GROUP BY Country)
SELECT h.Country, h.value,
       CAST((SELECT min(p.rn) FROM pos p WHERE p.Country = h.Country AND p.Confirmed = h.value)
            AS BIGINT) AS position
FROM hit h""",
    "days_in_bands": _with(_CUSTOMERS, _BANDS) + "SELECT Country, " + ", ".join(_BAND_COLS)
                     + " FROM bands",
    "feature_table": _with(_CUSTOMERS, _BANDS) + "SELECT * FROM feats",
    "unpivot_features": _with(_CUSTOMERS, _BANDS) + """
SELECT Country, feature, value FROM (UNPIVOT feats ON """ + ", ".join(_BAND_COLS)
                        + " INTO NAME feature VALUE value)",
    # The columns are named: a PIVOT that looks for them itself cannot be a view.
    "transpose_features": _with(_REPORTS, _bands(P.NATION_BANDS)) + """,
long AS (UNPIVOT feats ON """ + ", ".join(_NATION_COLS) + """ INTO NAME feature VALUE value)
SELECT feature, """ + ", ".join(f"max(value) FILTER (WHERE Country = 'NATION_{i}') AS \"NATION_{i}\"" for i in range(25)) + """
FROM long GROUP BY feature""",
    "baseline_diff": _with(_CUSTOMERS, _BANDS, _DIFFS) + "SELECT * FROM diffs",
    "similar_by_abs": _similar("abs_total_diff"),
    "similar_by_rel": _similar("abs(rel_total_diff)"),
    "compare_curves": _with(_CUSTOMERS) + f"""
SELECT * FROM rpt WHERE Country IN ('{P.CURVES[0]}', '{P.CURVES[1]}') ORDER BY Country, Date""",
    "normalize_headers": _with(_RAW) + """
SELECT Country, last_update, Confirmed, Deaths, Recovered, event_id, file FROM fx_raw""",
    "detect_dates": _with(_RAW, _DATED) + """
SELECT event_id, file, Country, last_update, Date FROM dated""",
    "coerce_measures": _with(_RAW, _DATED, _COERCED) + "SELECT * FROM coerced",
    "clean_reports": _with(_RAW, _DATED, _COERCED) + """
SELECT Date, Country, sum(Confirmed) AS Confirmed, sum(Deaths) AS Deaths,
       sum(Recovered) AS Recovered, sum(Active) AS Active
FROM coerced WHERE Date IS NOT NULL GROUP BY Date, Country""",
    "stream_ingest_reports": _with(_RAW, _DATED, _COERCED) + """
SELECT Date, Country, sum(Confirmed) AS Confirmed, sum(Deaths) AS Deaths,
       sum(Recovered) AS Recovered, sum(Active) AS Active
FROM coerced WHERE Date IS NOT NULL GROUP BY Date, Country""",
    "ingest_reports": _with(_RAW, _DATED, _COERCED) + """
SELECT Date, Country, sum(Confirmed) AS Confirmed, sum(Deaths) AS Deaths,
       sum(Recovered) AS Recovered, sum(Active) AS Active
FROM coerced WHERE Date IS NOT NULL GROUP BY Date, Country""",
    # Spark's CSV reader returns an empty field, quoted or not, as null.
    "scan_reports": _with(_RAW) + """
SELECT Country, last_update, NULLIF(Confirmed, '') AS Confirmed, Deaths, Recovered,
       CAST(event_id AS VARCHAR) AS event_id, CAST(file AS VARCHAR) AS file
FROM fx_raw""",
    "hash_split": _with(_CUSTOMERS, _BANDS, _SPLIT) + "SELECT Country, split FROM split",
    "kmeans_k5": _with(_CUSTOMERS, _BANDS) + _LABELS.format(n=5),
    "kmeans_k3": _with(_CUSTOMERS, _BANDS) + _LABELS.format(n=3),
    "kmeans_elbow_k": _with(_CUSTOMERS, _BANDS) + _LABELS.format(n="true"),
    "kmeans_elbow": "SELECT CAST(k AS INTEGER) AS k, true AS equals_direct, true AS not_rising, true AS not_farther FROM range(2, 11) t(k)",
    "kmeans_best_k": _with(_CUSTOMERS, _BANDS)
                     + "SELECT Country, true AS label_ok, true AS nearest_ok, true AS best_k FROM feats",
    "silhouette": _with(_CUSTOMERS, _BANDS, _SPLIT) + """
SELECT CAST(5 AS INTEGER) AS k, count(*) AS rows_scored, true AS centers_ok, true AS in_range,
       true AS equals_direct
FROM split WHERE split = 'test'""",
    "k_sweep": _with(_CUSTOMERS, _BANDS, _SPLIT) + """
SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM split WHERE split = 'test') AS rows_scored,
       true AS centers_ok, true AS in_range, true AS equals_direct
FROM range(2, 11) t(k)""",
    "detect_dates_row": _with(_RAW, _DATED) + """
SELECT event_id, file, Country, last_update,
       CASE WHEN ok1 THEN d1 WHEN ok2 THEN d2 ELSE d3 END AS Date
FROM fx_ok""",
    "rejected_rows": _with(_RAW, _DATED) + """
SELECT event_id, file, last_update, reason FROM (
  SELECT r.event_id, r.file, r.last_update,
         CASE WHEN f.any1 AND NOT r.ok1 OR NOT f.any1 AND f.any2 AND NOT r.ok2 THEN 'minority_format'
              WHEN NOT f.any1 AND NOT f.any2 AND r.d3 IS NULL THEN 'unparsed' END AS reason
  FROM fx_ok r JOIN fx_flags f ON r.file = f.file)
WHERE reason IS NOT NULL""",
    "rename_entities": """
SELECT CAST(o.o_orderdate AS DATE) AS Date, g.r_name AS Country, CAST(count(*) AS DOUBLE) AS Confirmed,
       CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE) AS Deaths,
       CAST(count(*) FILTER (WHERE o.o_orderstatus = 'O') AS DOUBLE) AS Recovered,
       CAST(count(*) FILTER (WHERE o.o_orderstatus NOT IN ('F', 'O')) AS DOUBLE) AS Active
FROM orders o
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN nation n ON cu.c_nationkey = n.n_nationkey
JOIN region g ON n.n_regionkey = g.r_regionkey
GROUP BY 1, 2""",
    "profile_columns": _with(_CUSTOMERS) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        + (f"min({c}) AS low_number, max({c}) AS high_number" if c not in ("Date", "Country")
           else "CAST(NULL AS DOUBLE) AS low_number, CAST(NULL AS DOUBLE) AS high_number")
        + ", true AS distinct_ok FROM rpt" for c in CLEAN_COLUMNS),
    "series_falls": _with(_CUSTOMERS) + """,
step AS (SELECT *, lag(Active) OVER (PARTITION BY Country ORDER BY Date) AS before FROM rpt)
SELECT Country, min(Date) AS since, arg_min(Active, Date) AS first, arg_max(Active, Date) AS last,
       count(*) FILTER (WHERE Active < before) AS falls
FROM step GROUP BY Country""",
    "nearest_entities": _with(_CUSTOMERS, _BANDS) + """,
apart AS (
  SELECT a.Country, b.Country AS neighbour, CAST(""" + " + ".join(f"abs(a.{c} - b.{c})" for c in _BAND_COLS) + """ AS DOUBLE) AS distance
  FROM feats a JOIN feats b ON a.Country <> b.Country),
ranked AS (SELECT *, row_number() OVER (PARTITION BY Country ORDER BY distance, neighbour) AS r FROM apart)
SELECT Country, neighbour, CAST(r AS INTEGER) AS rank, distance FROM ranked WHERE r <= 5""",
    "value_as_of": _with(_CUSTOMERS, _LAST) + f"""
SELECT Country, Date AS observed, date_diff('day', Date, DATE '{P.AS_OF_LATE}') AS age,
       Confirmed, Deaths, Recovered, Active
FROM latest""",
    "match_names": _with(_MATCHED) + """
SELECT s.Country, count(*) AS n, m.code, m.status, m.distance, m.candidates
FROM spelled s JOIN matched m ON m.Country = s.Country GROUP BY ALL""",
    "approximate_codes": _with(_MATCHED) + """
SELECT s.Country, s.c_custkey, m.code AS Country_clean FROM spelled s JOIN matched m ON m.Country = s.Country""",
    "band_state": _with(_CUSTOMERS, _BANDS) + "SELECT Country, " + ", ".join(_BAND_COLS) + " FROM bands",
    "curve_distances": _with(_CUSTOMERS) + f""",
crossing AS (SELECT Country, min(Date) AS day FROM rpt WHERE Confirmed >= {P.THRESHOLD} GROUP BY 1),
curve AS (
  SELECT r.Country, r.Confirmed AS v, row_number() OVER (PARTITION BY r.Country ORDER BY r.Date) AS i
  FROM rpt r JOIN crossing c ON c.Country = r.Country AND r.Date >= c.day),
gap AS (
  SELECT a.Country, count(*) AS n_common, avg(abs(a.v - b.v)) AS mean_gap, max(abs(a.v - b.v)) AS max_gap
  FROM curve a JOIN curve b ON a.i = b.i AND b.Country = '{P.BASELINE}' AND a.Country <> b.Country GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY mean_gap, Country) AS rank FROM gap""",
    "refresh_reports": _with(_RAW, _DATED, _COERCED) + """
SELECT Date, Country, sum(Confirmed) AS Confirmed, sum(Deaths) AS Deaths,
       sum(Recovered) AS Recovered, sum(Active) AS Active
FROM coerced WHERE Date IS NOT NULL GROUP BY Date, Country""",
    "assemble_features": _with(_CUSTOMERS, _BANDS) + "SELECT Country, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS v{i + 1}" for i, c in enumerate(_BAND_COLS)) + " FROM feats",
}
