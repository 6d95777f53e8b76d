"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written directly in SQL with window functions over whole series, so it checks the
bucketed Spark scans, joins and rollups against a plain formulation.  Doubles are rounded
to 6 places and integers widened to BIGINT, as ``queries.finish`` does.
"""

from __future__ import annotations

from sensorflow.sources import demo, rules

ORACLE: dict[str, str] = {}


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(float(v)) if isinstance(v, float) else str(v)
    if hasattr(v, "isoformat"):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols, types) -> str:
    body = ", ".join("(" + ", ".join(f"CAST({_lit(v)} AS {t})" for v, t in zip(r, types))
                     + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


def _dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


OXY, CHLA, QTY = _dbl(demo.OXYGEN_SCALE), _dbl(demo.CHLA_SCALE), _dbl(demo.QUANTITY_SCALE)
VAL, PRICE = _dbl(demo.VALUE_SCALE), _dbl(demo.PRICE_SCALE)

SITE_LIST = "[" + ", ".join(_lit(s) for s in demo.SITES) + "]"


def site_of(expr: str) -> str:
    return f"list_extract({SITE_LIST}, CAST(({expr}) % 12 AS INTEGER) + 1)"


SITES = _values(demo.SITE_DIMENSION, ["field_site_id", "field_site_subtype", "aquatics"],
                ["VARCHAR", "VARCHAR", "INTEGER"])
LOOKUP = _values(rules.THERMISTOR_DEPTHS, ["siteName", "verticalIndex", "thermistorDepth"],
                 ["VARCHAR", "VARCHAR", "DOUBLE"])
CORR = _values(rules.DEPTH_CORRECTIONS,
               ["site_id", "vertical_position", "valid_from", "valid_to", "depth"],
               ["VARCHAR", "INTEGER", "DATE", "DATE", "DOUBLE"])
RANGES = _values(rules.RANGES, ["variable", "lo", "hi"], ["VARCHAR", "DOUBLE", "DOUBLE"])
MASKS = _values(rules.MASKS, ["site_id", "variable", "date_from", "date_to", "bad_below",
                              "bad_above"],
                ["VARCHAR", "VARCHAR", "DATE", "DATE", "DOUBLE", "DOUBLE"])

EVENTS_K = ("(SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k "
            "FROM events)")
HPOS = ("CASE k % 4 WHEN 0 THEN '101' WHEN 1 THEN '102' WHEN 2 THEN '103' "
        "ELSE '111' END")

ARCHIVED = ("ts - to_days(CAST(CASE WHEN (user_id % 12) % 4 = 0 THEN 31 "
            "WHEN (user_id % 12) % 4 = 2 THEN 1826 ELSE 0 END AS INTEGER))")

ARCHIVE_WQ = f"""(SELECT event_id, {site_of('user_id')} AS siteID, {ARCHIVED} AS startDateTime,
  CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 12 AS DOUBLE) / 8 END AS sensorDepth,
  value * {OXY} AS dissolvedOxygen, value / 100 AS dissolvedOxygenExpUncert,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 7 = 0 THEN 1 ELSE 0 END AS dissolvedOxygenFinalQF,
  value * {CHLA} AS chlorophyll, value / 200 AS chlorophyllExpUncert,
  CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS chlorophyllFinalQF
  FROM {EVENTS_K})"""

ARCHIVE_TSD = f"""(SELECT l_orderkey, l_linenumber, {site_of('l_suppkey')} AS siteID,
  l_shipdate + to_years({demo.TSD_YEARS}) + to_minutes(CAST((l_orderkey % 48) * 30 AS BIGINT)) AS startDateTime,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_linenumber + 501 END AS verticalPosition,
  CAST(l_linenumber AS DOUBLE) / 4 AS thermistorDepth,
  l_quantity * {QTY} - 2 AS tsdWaterTempMean, l_tax AS tsdWaterTempExpUncert,
  CASE WHEN l_discount > 0.085 THEN 1 ELSE 0 END AS tsdWaterTempFinalQF
  FROM lineitem)"""

ARCHIVE_TSW = f"""(SELECT event_id, {site_of('user_id')} AS siteID, {ARCHIVED} AS startDateTime,
  {HPOS} AS horizontalPosition, value * {VAL} - 5 AS surfWaterTempMean,
  value / 100 AS surfWaterTempExpUncert, CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS finalQF
  FROM {EVENTS_K})"""


def provisional(product: str) -> str:
    cases = " ".join(f"WHEN {_lit(a)} THEN {_lit(b)}"
                     for a, b in demo.TERM_MAP[product].items())
    return f"""(SELECT {site_of('user_id')} AS siteName, term AS termName,
  date_trunc('hour', ts) AS startDate,
  CASE WHEN term LIKE '%QF' THEN NULL ELSE value * {VAL} END AS doubleValue,
  CASE WHEN term LIKE '%QF' THEN CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END END AS intValue,
  CAST(k % 8 + 501 AS VARCHAR) AS verticalIndex, {HPOS} AS horizontalIndex,
  CASE WHEN k % 9 = 0 THEN '001' ELSE '030' END AS temporalIndex, '{product}' AS product
  FROM (SELECT *, CASE event_type {cases} END AS term FROM {EVENTS_K}))"""


CURATED = f"""(SELECT {site_of('user_id')} AS siteID, ts AS startDate,
  CAST(k % 12 AS DOUBLE) / 8 AS sensorDepth,
  CASE WHEN k % 11 = 0 THEN NULL ELSE value * {VAL} - 5 END AS waterTemp FROM {EVENTS_K})"""

DAILY = f"""(SELECT time, site_id, variable, CASE WHEN day(time) = 1 THEN 15.0::DOUBLE
  WHEN day(time) IN (2, 3) THEN 5.0::DOUBLE ELSE avg(observed) END AS observed FROM (
  SELECT CAST(o_orderdate AS DATE) AS time, {site_of('o_custkey')} AS site_id,
    CASE WHEN o_orderstatus = 'F' THEN 'temperature' WHEN o_orderstatus = 'O' THEN 'oxygen'
         ELSE 'chla' END AS variable,
    o_totalprice * {PRICE} AS observed FROM orders) GROUP BY time, site_id, variable)"""


def r6(x: str) -> str:
    return f"(floor(({x}) * 1000000.0 + 0.5) / 1000000.0)"


def reg(name: str, sql: str) -> None:
    ORACLE[name] = sql


def site_class(subtype: str) -> str:
    return f"(SELECT field_site_id FROM {SITES} s WHERE field_site_subtype = '{subtype}')"


def qc_case(value: str, prev: str, lo: float, hi: float, spike: float, mode: str) -> str:
    flag = (f"(abs({value} - {prev}) > {spike} OR NOT ({value} BETWEEN {lo} AND {hi}) "
            f"OR round({value}, 9) - round({prev}, 9) = 0)")
    if mode == "keep":
        return f"CASE WHEN {flag} IS TRUE THEN NULL ELSE {value} END"
    return f"CASE WHEN {flag} IS FALSE THEN {value} END"


# --- scans, projections, filters --------------------------------------------------------

WQ_SCAN = f"""(SELECT siteID AS site_id, startDateTime, sensorDepth, dissolvedOxygen,
  chlorophyll AS chla, dissolvedOxygenFinalQF, chlorophyllFinalQF FROM {ARCHIVE_WQ} w
  WHERE siteID IN (SELECT field_site_id FROM {SITES} s)
    AND ((sensorDepth > 0 AND sensorDepth < 1) OR sensorDepth IS NULL))"""

reg("scan_project_filter", f"""SELECT site_id, startDateTime, {r6('sensorDepth')} AS sensorDepth,
  {r6('dissolvedOxygen')} AS dissolvedOxygen, {r6('chla')} AS chla,
  CAST(dissolvedOxygenFinalQF AS BIGINT) AS dissolvedOxygenFinalQF,
  CAST(chlorophyllFinalQF AS BIGINT) AS chlorophyllFinalQF FROM {WQ_SCAN} x""")

reg("filter_by_dimension", f"""SELECT siteID AS site_id, count(*) AS n,
  {r6('avg(tsdWaterTempMean)')} AS mean_temp FROM {ARCHIVE_TSD} t
  WHERE siteID IN (SELECT field_site_id FROM {SITES} s
                   WHERE aquatics = 1 AND field_site_subtype = 'Lake')
  GROUP BY siteID""")

WQ_DAILY_WIDE = f"""(SELECT CAST(startDateTime AS DATE) AS time, site_id,
  avg(CASE WHEN dissolvedOxygenFinalQF = 0 THEN dissolvedOxygen END) AS oxygen,
  avg(CASE WHEN chlorophyllFinalQF = 0 THEN chla END) AS chla
  FROM {WQ_SCAN} x GROUP BY 1, 2)"""

WQ_DAILY_LONG = f"""(SELECT time, site_id, variable, observed FROM {WQ_DAILY_WIDE} w
  UNPIVOT INCLUDE NULLS (observed FOR variable IN (oxygen, chla)))"""

WQ_DAILY = f"""(SELECT * FROM {WQ_DAILY_LONG} l
  WHERE NOT (variable = 'chla' AND site_id IN {site_class('Wadeable Stream')}))"""

reg("drop_variable_for_class", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {WQ_DAILY} x""")

reg("qf_mask_daily", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {WQ_DAILY_LONG} x""")

FAILED_CUTOFF = "2020-07-01"
reg("qf_or_after_date", f"""SELECT siteID AS site_id, CAST(year(startDateTime) AS BIGINT) AS year,
  CAST(tsdWaterTempFinalQF AS BIGINT) AS qf, count(*) AS n FROM {ARCHIVE_TSD} t
  WHERE tsdWaterTempFinalQF = 0
     OR (tsdWaterTempFinalQF = 1 AND CAST(startDateTime AS DATE) > DATE '{FAILED_CUTOFF}')
  GROUP BY 1, 2, 3""")

reg("value_coalesce", f"""SELECT siteName, termName, startDate, verticalIndex,
  {r6('coalesce(doubleValue, CAST(intValue AS DOUBLE))')} AS Value FROM {provisional('20288')} p""")

reg("nan_to_null", f"""SELECT site_id, count(*) AS n, count(v) AS n_known, {r6('avg(v)')} AS mean_v
  FROM (SELECT siteID AS site_id,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE dissolvedOxygen END AS v
        FROM {ARCHIVE_WQ} w) x GROUP BY site_id""")

reg("parse_timestamps", """SELECT event_id,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END
    AS parsed,
  date_trunc('hour', ts) AS hour FROM events""")

reg("parse_forecast_name", f"""SELECT site_id,
  'aquatics-' || strftime(first, '%Y-%m-%d') || '-' || lower(site_id) || '.csv.gz' AS file,
  'aquatics' AS theme, first AS issue_date, lower(site_id) AS team
  FROM (SELECT site_id, min(time) AS first FROM {DAILY} d GROUP BY site_id) x""")

reg("file_subset_by_site", """SELECT 'customer.parquet' AS source_file, count(*) AS n FROM customer
  UNION ALL SELECT 'nation.parquet', count(*) FROM nation
  UNION ALL SELECT 'supplier.parquet', count(*) FROM supplier""")

# --- reshape ----------------------------------------------------------------------------

reg("unpivot_measures", f"""SELECT event_id, site_id, variable, {r6('observed')} AS observed FROM (
  SELECT event_id, siteID AS site_id,
    CASE WHEN dissolvedOxygenFinalQF = 0 THEN dissolvedOxygen END AS oxygen,
    CASE WHEN chlorophyllFinalQF = 0 THEN chlorophyll END AS chla FROM {ARCHIVE_WQ} w) x
  UNPIVOT INCLUDE NULLS (observed FOR variable IN (oxygen, chla))""")


def _wide_sql(product: str, ids: list[str], source: str) -> str:
    cols = []
    for t in rules.PRODUCTS[product]:
        if t in ids:
            continue
        v = f"CASE WHEN termName = '{t}' THEN coalesce(doubleValue, CAST(intValue AS DOUBLE)) END"
        agg = "max" if t.endswith("QF") else "avg"
        cols.append(f"{agg}({v}) AS {t}")
    return f"SELECT {', '.join(ids)}, {', '.join(cols)} FROM {source} GROUP BY {', '.join(ids)}"


WQ_WIDE = f"({_wide_sql('20288', ['siteName', 'startDate'], provisional('20288') + ' p')})"
_WQ_COLS = ", ".join(r6(t) + f" AS {t}" for t in rules.PRODUCTS["20288"])

reg("pivot_terms", f"SELECT siteName, startDate, {_WQ_COLS} FROM {WQ_WIDE} w")
reg("any_flag_passes", f"""SELECT siteName, startDate, {_WQ_COLS} FROM {WQ_WIDE} w
  WHERE dissolvedOxygenFinalQF <> 1 OR chlorophyllFinalQF <> 1""")

reg("union_by_name", f"""SELECT time, site_id, variable, {r6('observed')} AS observed,
  CAST(NULL AS VARCHAR) AS source FROM {WQ_DAILY} a
  UNION ALL SELECT time, site_id, variable, {r6('observed')}, 'orders' FROM {DAILY} b""")

reg("empty_source_union", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {WQ_DAILY} x""")

# --- rollups ----------------------------------------------------------------------------

LAKE_TSD = f"""(SELECT t.siteID AS site_id, t.startDateTime, t.verticalPosition,
  coalesce(c.depth, t.thermistorDepth) AS depth, t.tsdWaterTempMean, t.tsdWaterTempFinalQF
  FROM {ARCHIVE_TSD} t LEFT JOIN {CORR} c
    ON t.siteID = c.site_id AND t.verticalPosition = c.vertical_position
   AND (c.valid_from IS NULL OR CAST(t.startDateTime AS DATE) >= c.valid_from)
   AND (c.valid_to IS NULL OR CAST(t.startDateTime AS DATE) <= c.valid_to)
  WHERE t.siteID IN {site_class('Lake')})"""

LAKE_HOURLY_RAW = f"""(SELECT site_id, ROUND(depth, 1) AS depth,
  date_trunc('hour', startDateTime) AS time, avg(tsdWaterTempMean) AS observed
  FROM {LAKE_TSD} x
  WHERE tsdWaterTempFinalQF = 0
     OR (tsdWaterTempFinalQF = 1 AND CAST(startDateTime AS DATE) > DATE '2020-07-01')
  GROUP BY 1, 2, 3)"""


def qc_sql(source: str, keys: list[str], time: str, value: str, lo, hi, spike, mode,
           cols: list[str]) -> str:
    part = ", ".join(keys)
    return f"""(SELECT {', '.join(cols)}, {qc_case(value, '__prev', lo, hi, spike, mode)} AS {value}
  FROM (SELECT *, lag({value}) OVER (PARTITION BY {part} ORDER BY {time}) AS __prev
        FROM {source} s0) s1)"""


LAKE_HOURLY = qc_sql(LAKE_HOURLY_RAW, ["site_id", "depth"], "time", "observed",
                     -5.0, 40.0, 5.0, "keep", ["time", "site_id", "depth"])

reg("hourly_profile", f"""SELECT time, site_id, {r6('depth')} AS depth, {r6('observed')} AS observed,
  'temperature' AS variable FROM {LAKE_HOURLY} h""")

CUR_LAKE_RAW = f"""(SELECT siteID AS site_id, ROUND(sensorDepth, 1) AS depth,
  date_trunc('hour', startDate) AS time,
  CASE WHEN count(waterTemp) = count(*) THEN avg(waterTemp) END AS observed
  FROM {CURATED} c WHERE siteID IN {site_class('Lake')} GROUP BY 1, 2, 3)"""
CUR_LAKE = qc_sql(CUR_LAKE_RAW, ["site_id", "depth"], "time", "observed", -5.0, 40.0, 5.0,
                  "keep", ["time", "site_id", "depth"])

reg("curated_hourly_strict", f"""SELECT time, site_id, {r6('depth')} AS depth,
  {r6('observed')} AS observed, 'temperature' AS variable FROM {CUR_LAKE} h""")


def not_held(rows: str, archive: str, time: str, same: str) -> str:
    """Rows ``p`` whose month no known row ``a`` of the archive with the same key has."""
    return f"""(SELECT p.* FROM {rows} p WHERE NOT EXISTS (SELECT 1 FROM {archive} a WHERE {same}
  AND a.observed IS NOT NULL AND date_trunc('month', a.time) = date_trunc('month', p.{time})))"""


def fresh(product: str) -> str:
    """Provisional records of the months that the site's archive does not fill."""
    archive = {"20264": f"(SELECT site_id, time, observed FROM {LAKE_HOURLY_RAW} x "
                        f"UNION ALL SELECT site_id, time, observed FROM {RIVER_RAW} y)",
               "20053": STREAM_RAW}[product]
    return not_held(provisional(product), archive, "startDate", "a.site_id = p.siteName")


def _prov_selected(product: str, thirty: bool, is_fresh: bool = False) -> str:
    terms = ", ".join(_lit(t) for t in rules.PRODUCTS[product])
    cond = f"termName IN ({terms}) AND horizontalIndex IN ('101', '111', '103')"
    if thirty:
        cond += " AND temporalIndex = '030'"
    src = fresh(product) if is_fresh else provisional(product)
    return f"(SELECT * FROM {src} p WHERE {cond})"


def _any_flag(product: str, alias: str = "w") -> str:
    flags = [t for t in rules.PRODUCTS[product] if t.endswith("QF")]
    return " OR ".join(f"{alias}.{f} <> 1" for f in flags)


def tsd_wide(is_fresh: bool = False) -> str:
    joined = f"""(SELECT p.*, l.thermistorDepth FROM {_prov_selected('20264', True, is_fresh)} p
  JOIN {LOOKUP} l ON p.siteName = l.siteName AND p.verticalIndex = l.verticalIndex)"""
    return f"""(SELECT * FROM ({_wide_sql('20264', ['siteName', 'startDate', 'verticalIndex',
  'thermistorDepth'], joined + ' j')}) w WHERE {_any_flag('20264')})"""


def prov_lake(is_fresh: bool = False) -> str:
    raw = f"""(SELECT siteName AS site_id, thermistorDepth AS depth,
  date_trunc('hour', startDate) AS time, avg(tsdWaterTempMean) AS observed
  FROM {tsd_wide(is_fresh)} w WHERE siteName IN {site_class('Lake')} GROUP BY 1, 2, 3)"""
    return qc_sql(raw, ["site_id", "depth"], "time", "observed", -5.0, 40.0, 5.0, "keep",
                  ["time", "site_id", "depth"])


def profile(is_fresh: bool = False) -> str:
    return f"""(SELECT time, site_id, depth, avg(observed) AS observed FROM (
  SELECT time, site_id, depth, observed FROM {LAKE_HOURLY} a
  UNION ALL SELECT time, site_id, depth, observed FROM {CUR_LAKE} b
  UNION ALL SELECT time, site_id, depth, observed FROM {prov_lake(is_fresh)} c) u
  GROUP BY time, site_id, depth)"""


def surface(is_fresh: bool = False) -> str:
    return f"""(SELECT CAST(time AS DATE) AS time, site_id, avg(observed) AS observed
  FROM {profile(is_fresh)} p WHERE depth <= 1 GROUP BY 1, 2)"""


PROV_TSD_WIDE = tsd_wide()
PROFILE = profile()
SURFACE = surface()

reg("surface_daily", f"""SELECT time, site_id, 'temperature' AS variable,
  {r6('observed')} AS observed FROM {SURFACE} s""")

STREAM_RAW = f"""(SELECT CAST(startDateTime AS DATE) AS time, siteID AS site_id,
  avg(surfWaterTempMean) AS observed FROM {ARCHIVE_TSW} t
  WHERE horizontalPosition IN ('101', '111') AND finalQF = 0 GROUP BY 1, 2)"""
STREAM = qc_sql(STREAM_RAW, ["site_id"], "time", "observed", -5.0, 40.0, 7.0, "reject",
                ["time", "site_id"])

reg("stream_daily", f"""SELECT time, site_id, {r6('observed')} AS observed,
  'temperature' AS variable FROM {STREAM} s""")

RIVER_RAW = f"""(SELECT CAST(startDateTime AS DATE) AS time, siteID AS site_id,
  avg(tsdWaterTempMean) AS observed FROM {ARCHIVE_TSD} t
  WHERE siteID IN {site_class('Non-wadeable River')} AND tsdWaterTempFinalQF = 0
  GROUP BY 1, 2)"""
RIVER = qc_sql(RIVER_RAW, ["site_id"], "time", "observed", -5.0, 40.0, 7.0, "reject",
               ["time", "site_id"])

reg("river_daily", f"""SELECT time, site_id, {r6('observed')} AS observed,
  'temperature' AS variable FROM {RIVER} s""")

reg("standard_error", f"""SELECT siteID AS site_id, CAST(startDateTime AS DATE) AS time,
  {r6('stddev_samp(dissolvedOxygen) / sqrt(count(dissolvedOxygen))')} AS se,
  count(dissolvedOxygen) AS n FROM {ARCHIVE_WQ} w GROUP BY 1, 2""")

# --- depth ------------------------------------------------------------------------------

reg("depth_lookup_join", f"""SELECT p.siteName, p.verticalIndex, {r6('l.thermistorDepth')} AS thermistorDepth,
  count(*) AS n, {r6('avg(p.doubleValue)')} AS mean_value
  FROM {provisional('20264')} p JOIN {LOOKUP} l
    ON p.siteName = l.siteName AND p.verticalIndex = l.verticalIndex
  GROUP BY 1, 2, 3""")

reg("depth_correction", f"""SELECT t.l_orderkey, CAST(t.l_linenumber AS BIGINT) AS l_linenumber,
  t.siteID, CAST(t.verticalPosition AS BIGINT) AS verticalPosition, t.startDateTime,
  {r6('coalesce(c.depth, t.thermistorDepth)')} AS depth
  FROM {ARCHIVE_TSD} t LEFT JOIN {CORR} c
    ON t.siteID = c.site_id AND t.verticalPosition = c.vertical_position
   AND (c.valid_from IS NULL OR CAST(t.startDateTime AS DATE) >= c.valid_from)
   AND (c.valid_to IS NULL OR CAST(t.startDateTime AS DATE) <= c.valid_to)""")

# --- quality control --------------------------------------------------------------------

reg("rate_of_change", f"""SELECT time, site_id, variable, {r6('observed')} AS observed,
  {r6('observed - lag(observed) OVER (PARTITION BY site_id, variable ORDER BY time)')} AS change
  FROM {DAILY} d""")

QBD_RAW = f"""(SELECT siteID AS site_id, thermistorDepth, date_trunc('hour', startDateTime) AS time,
  avg(tsdWaterTempMean) AS observed FROM {ARCHIVE_TSD} t GROUP BY 1, 2, 3)"""
reg("qc_by_depth", f"""SELECT site_id, {r6('thermistorDepth')} AS thermistorDepth, time,
  {r6('observed')} AS observed FROM {qc_sql(QBD_RAW, ['site_id', 'thermistorDepth'], 'time',
                                           'observed', -5.0, 40.0, 5.0, 'keep',
                                           ['site_id', 'thermistorDepth', 'time'])} q""")

QS_RAW = """(SELECT l_suppkey % 10 AS series, l_linenumber, l_shipdate, l_orderkey, l_partkey,
  l_suppkey, l_quantity AS observed FROM lineitem)"""
reg("qc_strict", f"""SELECT series, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_orderkey,
  {r6('observed')} AS observed FROM {qc_sql(QS_RAW, ['series', 'l_linenumber'],
  'l_shipdate, l_orderkey, l_partkey, l_suppkey, observed', 'observed', 2.0, 45.0, 30.0,
  'reject', ['series', 'l_linenumber', 'l_orderkey'])} q""")

reg("gross_range", f"""SELECT d.time, d.site_id, d.variable,
  {r6('CASE WHEN d.observed BETWEEN r.lo AND r.hi THEN d.observed END')} AS observed
  FROM {DAILY} d LEFT JOIN {RANGES} r ON d.variable = r.variable""")

MOVED = f"(SELECT CAST(time + INTERVAL 20 YEAR AS DATE) AS time, site_id, variable, observed FROM {DAILY} m)"
reg("mask_rules", f"""SELECT d.time, d.site_id, d.variable,
  {r6('''CASE WHEN EXISTS (SELECT 1 FROM ''' + MASKS + ''' m
          WHERE m.site_id = d.site_id AND m.variable = d.variable
            AND (m.date_from IS NULL OR d.time >= m.date_from)
            AND (m.date_to IS NULL OR d.time <= m.date_to)
            AND ((m.bad_below IS NULL AND m.bad_above IS NULL)
                 OR d.observed < m.bad_below OR d.observed > m.bad_above))
        THEN NULL ELSE d.observed END''')} AS observed FROM {MOVED} d""")

# --- provisional chains -----------------------------------------------------------------

def wq_prov(is_fresh: bool = False) -> str:
    wide = f"""(SELECT * FROM ({_wide_sql('20288', ['siteName', 'startDate'],
  _prov_selected('20288', False) + ' p')}) w WHERE {_any_flag('20288')})"""
    long = f"""(SELECT time, site_id, variable, observed FROM (
  SELECT CAST(startDate AS DATE) AS time, siteName AS site_id,
         avg(dissolvedOxygen) AS oxygen, avg(chlorophyll) AS chla
  FROM {wide} w GROUP BY 1, 2) x
  UNPIVOT INCLUDE NULLS (observed FOR variable IN (oxygen, chla)))"""
    rows = f"""(SELECT * FROM {long} l
  WHERE NOT (variable = 'chla' AND site_id IN {site_class('Wadeable Stream')}))"""
    if not is_fresh:
        return rows
    return not_held(rows, WQ_DAILY, "time", "a.site_id = p.site_id AND a.variable = p.variable")


WQ_PROV = wq_prov()

reg("provisional_daily", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {WQ_PROV} x""")

PROV_SURFACE_RAW = f"""(SELECT CAST(startDate AS DATE) AS time, siteName AS site_id,
  'temperature' AS variable, avg(tsdWaterTempMean) AS observed FROM {PROV_TSD_WIDE} w
  WHERE thermistorDepth <= 1 GROUP BY 1, 2)"""

reg("provisional_surface_daily", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {PROV_SURFACE_RAW} x""")

reg("provisional_profile_hourly", f"""SELECT date_trunc('hour', startDate) AS time,
  siteName AS site_id, {r6('thermistorDepth')} AS depth, 'temperature' AS variable,
  {r6('avg(tsdWaterTempMean)')} AS observed FROM {PROV_TSD_WIDE} w GROUP BY 1, 2, 3""")

def prt_raw(is_fresh: bool = False) -> str:
    wide = f"""(SELECT * FROM ({_wide_sql('20053', ['siteName', 'startDate'],
  _prov_selected('20053', True, is_fresh) + ' p')}) w WHERE {_any_flag('20053')})"""
    return f"""(SELECT CAST(startDate AS DATE) AS time, siteName AS site_id,
  'temperature' AS variable, avg(surfWaterTempMean) AS observed FROM {wide} w GROUP BY 1, 2)"""


PRT_RAW = prt_raw()

reg("provisional_point_daily", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {PRT_RAW} x""")

reg("provisional_dispatch", f"""
  SELECT time, site_id, variable, {r6('observed')} AS observed, '20288' AS product FROM {WQ_PROV} a
  UNION ALL
  SELECT time, site_id, variable, {r6('observed')}, '20264' FROM {PROV_SURFACE_RAW} b
  UNION ALL
  SELECT time, site_id, variable, {r6('observed')}, '20053' FROM {PRT_RAW} c""")

# --- merges and targets -----------------------------------------------------------------

reg("profile_merge", f"""SELECT time, site_id, {r6('depth')} AS depth, 'temperature' AS variable,
  {r6('observed')} AS observed FROM {profile(True)} p""")

PRT_QC = qc_sql(prt_raw(True), ["site_id"], "time", "observed", -5.0, 40.0, 7.0, "reject",
                ["time", "site_id"])
CUR_RIVER_RAW = f"""(SELECT CAST(startDate AS DATE) AS time, siteID AS site_id,
  CASE WHEN count(waterTemp) = count(*) THEN avg(waterTemp) END AS observed
  FROM {CURATED} c WHERE siteID IN {site_class('Non-wadeable River')} GROUP BY 1, 2)"""
CUR_RIVER = qc_sql(CUR_RIVER_RAW, ["site_id"], "time", "observed", -5.0, 40.0, 5.0, "reject",
                   ["time", "site_id"])
PROV_RIVER_RAW = f"""(SELECT CAST(startDate AS DATE) AS time, siteName AS site_id,
  avg(tsdWaterTempMean) AS observed FROM {tsd_wide(True)} w
  WHERE thermistorDepth <= 1 AND siteName IN {site_class('Non-wadeable River')} GROUP BY 1, 2)"""
PROV_RIVER = qc_sql(PROV_RIVER_RAW, ["site_id"], "time", "observed", -5.0, 40.0, 5.0,
                    "reject", ["time", "site_id"])


def mask_sql(site: str, variable: str, time: str, value: str) -> str:
    return f"""CASE WHEN EXISTS (SELECT 1 FROM {MASKS} m
          WHERE m.site_id = {site} AND m.variable = {variable}
            AND (m.date_from IS NULL OR {time} >= m.date_from)
            AND (m.date_to IS NULL OR {time} <= m.date_to)
            AND ((m.bad_below IS NULL AND m.bad_above IS NULL)
                 OR {value} < m.bad_below OR {value} > m.bad_above))
        THEN NULL ELSE {value} END"""


TEMP_MERGED = f"""(SELECT site_id, time, avg(observed) AS observed FROM (
  SELECT site_id, time, observed FROM {surface(True)} a
  UNION ALL SELECT site_id, time, observed FROM {STREAM} b
  UNION ALL SELECT site_id, time, observed FROM {PRT_QC} c
  UNION ALL SELECT site_id, time, observed FROM {RIVER} d
  UNION ALL SELECT site_id, time, observed FROM {CUR_RIVER} e
  UNION ALL SELECT site_id, time, observed FROM {PROV_RIVER} f) u GROUP BY site_id, time)"""
TEMP_RANGED = f"""(SELECT t.time, t.site_id, 'temperature' AS variable,
  CASE WHEN t.observed BETWEEN r.lo AND r.hi THEN t.observed END AS observed
  FROM {TEMP_MERGED} t LEFT JOIN {RANGES} r ON r.variable = 'temperature')"""
TEMP = f"""(SELECT time, site_id, variable,
  {mask_sql('g.site_id', 'g.variable', 'g.time', 'g.observed')} AS observed
  FROM {TEMP_RANGED} g)"""

reg("surface_merge", f"""SELECT time, site_id, variable, {r6('observed')} AS observed FROM {TEMP} t""")

WQ_UNION = f"""(SELECT time, site_id, variable, observed FROM {WQ_DAILY} a
  UNION ALL SELECT time, site_id, variable, observed FROM {wq_prov(True)} b)"""
WQ_RANGED = f"""(SELECT u.time, u.site_id, u.variable,
  CASE WHEN u.observed BETWEEN r.lo AND r.hi THEN u.observed END AS observed
  FROM {WQ_UNION} u LEFT JOIN {RANGES} r ON u.variable = r.variable)"""
WQ_CLEAN = f"""(SELECT time, site_id, variable,
  {mask_sql('g.site_id', 'g.variable', 'g.time', 'g.observed')} AS observed FROM {WQ_RANGED} g)"""

reg("targets_long", f"""SELECT time, site_id, variable, {r6('observed')} AS observed FROM (
  SELECT * FROM {WQ_CLEAN} a UNION ALL SELECT * FROM {TEMP} b) t""")

# --- incremental refresh ----------------------------------------------------------------

reg("month_plan", f"""SELECT DISTINCT site_id, strftime(mx, '%Y-%m') AS latest_month, fetch_month
  FROM (SELECT site_id, max(time) AS mx FROM {RIVER} r GROUP BY site_id) m,
  LATERAL (SELECT strftime(CAST(m.mx + INTERVAL 1 MONTH AS DATE), '%Y-%m') AS fetch_month
           UNION ALL SELECT strftime(DATE '2022-12-15' - INTERVAL 2 DAY, '%Y-%m')) f""")

reg("supersede_provisional", f"""SELECT p.site_id, count(*) AS n, min(p.time) AS first_time,
  {r6('avg(p.observed)')} AS mean_observed
  FROM {not_held(f"""(SELECT CAST(startDateTime AS DATE) AS time, siteID AS site_id,
               avg(tsdWaterTempMean) AS observed FROM {ARCHIVE_TSD} t GROUP BY 1, 2)""",
                 f"(SELECT site_id, time + to_years({demo.TSD_YEARS}) AS time, observed FROM {DAILY} d)",
                 "time", "a.site_id = p.site_id")} p GROUP BY p.site_id""")

# the archive lacks every third month, another one for each variable, and knows no value in June
reg("supersede_by_month", f"""SELECT p.time, p.site_id, p.variable, {r6('p.observed')} AS observed
  FROM {not_held(DAILY, f"""(SELECT time, site_id, variable,
    CASE WHEN month(time) <> 6 THEN observed END AS observed FROM {DAILY} d
    WHERE (month(time) + ascii(variable)) % 3 <> 0)""", "time",
                 "a.site_id = p.site_id AND a.variable = p.variable")} p""")

reg("stream_ingest_daily", f"""SELECT {site_of('user_id')} AS site_id, CAST(ts AS DATE) AS time,
  {r6('avg(value * ' + OXY + ')')} AS observed FROM events GROUP BY 1, 2""")

# --- series -----------------------------------------------------------------------------

SERIES_END = "DATE '2001-08-01'"
SITE_START = f"(SELECT site_id, min(time) AS start FROM {DAILY} d GROUP BY site_id)"
SERIES_START = f"(SELECT site_id, variable, min(time) AS start FROM {DAILY} d GROUP BY 1, 2)"
SERIES_KEYS = f"(SELECT DISTINCT site_id, variable FROM {DAILY} d)"

reg("date_spine", f"""SELECT s.site_id, s.variable,
  CAST(date_diff('day', st.start, {SERIES_END}) + 1 AS BIGINT) AS n_days,
  st.start AS first, {SERIES_END} AS last
  FROM {SERIES_KEYS} s JOIN {SITE_START} st ON s.site_id = st.site_id
  WHERE st.start <= {SERIES_END}""")

reg("series_with_data", f"""SELECT site_id, variable, count(v) AS n_obs, count(*) AS n_rows
  FROM (SELECT site_id, variable, CASE WHEN observed < 2.0 THEN NULL ELSE observed END AS v
        FROM {DAILY} d) x GROUP BY 1, 2 HAVING count(v) > 0""")


def spine_sql(starts: str, keys_sql: str, join_on: str) -> str:
    return f"""(SELECT k.site_id, k.variable, CAST(g.t AS DATE) AS time
  FROM {keys_sql} k JOIN {starts} st ON {join_on},
  LATERAL (SELECT unnest(generate_series(CAST(st.start AS TIMESTAMP),
                                         CAST({SERIES_END} AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS t) g
  WHERE st.start <= {SERIES_END})"""


# The end lies inside the data: later rows stay, without a spine under them.
DENSE_END = "DATE '2000-03-15'"
DENSE_SITE = f"""(SELECT s.site_id, s.variable, s.time, d.observed
  FROM {spine_sql(SITE_START, SERIES_KEYS, 'k.site_id = st.site_id').replace(SERIES_END, DENSE_END)} s
  LEFT JOIN {DAILY} d ON d.site_id = s.site_id AND d.variable = s.variable AND d.time = s.time
  UNION ALL SELECT site_id, variable, time, observed FROM {DAILY} l WHERE time > {DENSE_END})"""
DENSE_SERIES = f"""(SELECT s.site_id, s.variable, s.time, d.observed
  FROM {spine_sql(SERIES_START, SERIES_KEYS,
                  'k.site_id = st.site_id AND k.variable = st.variable')} s
  LEFT JOIN {DAILY} d ON d.site_id = s.site_id AND d.variable = s.variable AND d.time = s.time)"""

reg("densify_series", f"""SELECT site_id, variable, time, {r6('observed')} AS observed
  FROM {DENSE_SITE} x""")


def interp_sql(source: str, keys: list[str], time: str, value: str, x: str, out: str,
               cols: list[str]) -> str:
    part = ", ".join(keys)
    w_prev = f"PARTITION BY {part} ORDER BY {time} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    w_next = f"PARTITION BY {part} ORDER BY {time} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""(SELECT {', '.join(cols)},
  CASE WHEN {value} IS NOT NULL THEN {value}
       WHEN pv IS NOT NULL AND nv IS NOT NULL AND nx <> px
         THEN pv + (nv - pv) * CAST(__x - px AS DOUBLE) / CAST(nx - px AS DOUBLE)
       WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv
       ELSE coalesce(pv, nv) END AS {out}
  FROM (SELECT *,
    last_value({value} IGNORE NULLS) OVER ({w_prev}) AS pv,
    last_value(CASE WHEN {value} IS NOT NULL THEN __x END IGNORE NULLS) OVER ({w_prev}) AS px,
    first_value({value} IGNORE NULLS) OVER ({w_next}) AS nv,
    first_value(CASE WHEN {value} IS NOT NULL THEN __x END IGNORE NULLS) OVER ({w_next}) AS nx
    FROM (SELECT *, {x} AS __x FROM {source} s0) s1) s2)"""


reg("interpolate_by_index", f"""SELECT site_id, variable, time, {r6('observed')} AS observed,
  {r6('filled')} AS filled FROM {interp_sql(DENSE_SERIES, ['site_id', 'variable'], 'time',
  'observed', 'row_number() OVER (PARTITION BY site_id, variable ORDER BY time)', 'filled',
  ['site_id', 'variable', 'time', 'observed'])} i""")

SUNDAY_GAPS = f"""(SELECT time, site_id, variable,
  CASE WHEN dayofweek(time) = 0 THEN NULL ELSE observed END AS observed FROM {DAILY} d)"""
reg("interpolate_by_time", f"""SELECT site_id, variable, time, {r6('observed')} AS observed,
  {r6('filled')} AS filled FROM {interp_sql(SUNDAY_GAPS, ['site_id', 'variable'], 'time',
  'observed', "date_diff('day', DATE '1970-01-01', time)", 'filled',
  ['site_id', 'variable', 'time', 'observed'])} i""")

reg("diff_sd", f"""SELECT site_id, variable, {r6('stddev_samp(dv)')} AS diff_sd, count(dv) AS n_diff
  FROM (SELECT site_id, variable,
          observed - lag(observed) OVER (PARTITION BY site_id, variable ORDER BY time) AS dv
        FROM {DAILY} d WHERE observed IS NOT NULL) x GROUP BY 1, 2""")

OBS_SD = f"""(SELECT event_id, siteID AS site_id,
  CASE WHEN dissolvedOxygenFinalQF IS NULL THEN NULL WHEN dissolvedOxygenFinalQF = 1 THEN 0.0
       ELSE dissolvedOxygenExpUncert END AS p_sd FROM {ARCHIVE_WQ} w)"""
reg("obs_error_fill", f"""SELECT o.event_id, o.site_id, {r6('''CASE
    WHEN coalesce(o.p_sd, s.m) = 0 THEN
      CASE WHEN s.has_na AND s.m <> 0 THEN least(s.mn0, s.m) ELSE s.mn0 END
    ELSE coalesce(o.p_sd, s.m) END''')} AS p_sd
  FROM {OBS_SD} o JOIN (SELECT site_id, avg(p_sd) AS m,
      min(CASE WHEN p_sd <> 0 THEN p_sd END) AS mn0, bool_or(p_sd IS NULL) AS has_na
    FROM {OBS_SD} x GROUP BY site_id) s ON o.site_id = s.site_id""")

# --- climatology ------------------------------------------------------------------------

CLIM = f"""(SELECT dayofyear(time) AS doy, site_id, variable, avg(observed) AS mean,
  stddev_samp(observed) AS sd FROM {DAILY} d GROUP BY 1, 2, 3)"""
reg("climatology_doy", f"""SELECT CAST(doy AS BIGINT) AS doy, site_id, variable,
  {r6('mean')} AS mean, {r6('sd')} AS sd FROM {CLIM} c""")

CLIM_DAYS = "(SELECT DATE '2000-12-15' + CAST(i AS INTEGER) AS time FROM range(1, 36) r(i))"
CLIM_HIST = f"""(SELECT dayofyear(time) AS doy, site_id, variable, avg(observed) AS mean,
  stddev_samp(observed) AS sd FROM {DAILY} d WHERE time <= DATE '2000-12-15' GROUP BY 1, 2, 3)"""
CLIM_WIN = f"""(SELECT d.time, c.site_id, c.variable, c.mean, c.sd
  FROM {CLIM_DAYS} d JOIN {CLIM_HIST} c ON c.doy = dayofyear(d.time))"""
VARS = "(SELECT * FROM (VALUES ('temperature'), ('oxygen'), ('chla')) v(variable))"
GRID = f"""(SELECT s.site_id, v.variable, d.time FROM (SELECT DISTINCT site_id FROM {CLIM_WIN} w) s
  CROSS JOIN {VARS} v CROSS JOIN {CLIM_DAYS} d)"""

reg("forecast_grid", f"SELECT site_id, variable, time FROM {GRID} g")

DENSE_FC = f"""(SELECT g.time, g.site_id, g.variable, w.mean, w.sd FROM {GRID} g
  LEFT JOIN {CLIM_WIN} w ON g.time = w.time AND g.site_id = w.site_id AND g.variable = w.variable)"""
reg("densify_forecast", f"""SELECT time, site_id, variable, {r6('mean')} AS mean, {r6('sd')} AS sd
  FROM {DENSE_FC} x""")


def clim_fc(source: str) -> str:
    interp = interp_sql(source, ["site_id", "variable"], "time", "mean",
                        "row_number() OVER (PARTITION BY site_id, variable ORDER BY time)", "mu",
                        ["time", "site_id", "variable", "sd"])
    return f"""(SELECT time, start_time, site_id, variable, 'normal' AS family, parameter, predicted
  FROM (SELECT i.time, i.site_id, i.variable, i.mu, s.sigma, s.start_time FROM {interp} i
        JOIN (SELECT site_id, variable, median(sd) AS sigma,
                     CAST(min(time) - INTERVAL 1 DAY AS DATE) AS start_time
              FROM {source} x GROUP BY 1, 2) s
          ON i.site_id = s.site_id AND i.variable = s.variable) y
  UNPIVOT INCLUDE NULLS (predicted FOR parameter IN (mu, sigma)))"""


reg("climatology_forecast", f"""SELECT time, start_time, site_id, variable, family, parameter,
  {r6('predicted')} AS predicted FROM {clim_fc(CLIM_WIN)} f""")
reg("climatology_forecast_dense", f"""SELECT time, start_time, site_id, variable, family,
  parameter, {r6('predicted')} AS predicted FROM {clim_fc(DENSE_FC)} f""")
reg("forecast_band", f"""SELECT time, site_id, variable, {r6('mu')} AS mu, {r6('sigma')} AS sigma,
  {r6('mu - 1.96 * sigma')} AS lower, {r6('mu + 1.96 * sigma')} AS upper FROM (
  SELECT time, site_id, variable,
    max(CASE WHEN parameter = 'mu' THEN predicted END) AS mu,
    max(CASE WHEN parameter = 'sigma' THEN predicted END) AS sigma
  FROM {clim_fc(CLIM_WIN)} f GROUP BY 1, 2, 3) b""")

# --- random walk ------------------------------------------------------------------------

HIST = f"(SELECT * FROM {DAILY} d WHERE time <= {SERIES_END})"
reg("rw_analytic", f"""SELECT time, start_time, site_id, variable, family, parameter,
  {r6('predicted')} AS predicted FROM (
  SELECT CAST(g.t AS DATE) AS time, {SERIES_END} AS start_time, b.site_id, b.variable,
    'normal' AS family, b.v AS mu,
    b.diff_sd * sqrt(CAST(date_diff('day', b.t_last, CAST(g.t AS DATE)) AS DOUBLE)) AS sigma
  FROM (SELECT l.site_id, l.variable, l.t_last, l.v, s.diff_sd FROM
          (SELECT site_id, variable, max(time) AS t_last, arg_max(observed, time) AS v
           FROM {HIST} h WHERE observed IS NOT NULL GROUP BY 1, 2) l
          LEFT JOIN (SELECT site_id, variable, stddev_samp(dv) AS diff_sd FROM (
            SELECT site_id, variable,
              observed - lag(observed) OVER (PARTITION BY site_id, variable ORDER BY time) AS dv
            FROM {HIST} h WHERE observed IS NOT NULL) q GROUP BY 1, 2) s
          ON l.site_id = s.site_id AND l.variable = s.variable) b,
    LATERAL (SELECT unnest(generate_series(CAST({SERIES_END} + 1 AS TIMESTAMP),
                                           CAST({SERIES_END} + 35 AS TIMESTAMP),
                                           INTERVAL 1 DAY)) AS t) g) y
  UNPIVOT INCLUDE NULLS (predicted FOR parameter IN (mu, sigma))""")

reg("ensemble_summary", f"""SELECT time, site_id, variable, {r6('avg(predicted)')} AS mean,
  {r6('quantile_cont(predicted, 0.975)')} AS upper,
  {r6('quantile_cont(predicted, 0.025)')} AS lower FROM (
  SELECT CAST(startDateTime AS DATE) AS time, siteID AS site_id, 'temperature' AS variable,
    event_id % 2000 + 1 AS ensemble, avg(surfWaterTempMean) AS predicted
  FROM {ARCHIVE_TSW} t GROUP BY 1, 2, 3, 4) e GROUP BY 1, 2, 3""")

# --- coverage ---------------------------------------------------------------------------

reg("coverage_summary", f"""SELECT variable, min(time) AS begin_date, max(time) AS end_date,
  count(*) AS n FROM {DAILY} d GROUP BY variable""")

reg("coverage_geo", f"""SELECT n.n_name AS id, n.n_name || ', ' || r.r_name AS geographicDescription,
  {r6('n.n_nationkey * 7.3 - 90')} AS west, {r6('n.n_nationkey * 7.3 - 90')} AS east,
  {r6('n.n_nationkey * 2.9 - 30')} AS north, {r6('n.n_nationkey * 2.9 - 30')} AS south,
  {r6('n.n_regionkey * 100.0')} AS altitude_min, {r6('n.n_regionkey * 100.0 + 50')} AS altitude_max,
  'meter' AS altitude_units
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_name IN (SELECT n2.n_name FROM supplier s JOIN nation n2
                     ON s.s_nationkey = n2.n_nationkey)""")

reg("refresh_landing", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {PRT_RAW} x WHERE site_id IN ('BARC', 'MAYF', 'TOMB')""")

# New rows lie between old ones and after them; each series is retested from its first new row.
NEW_ROWS = f"""(SELECT * FROM {DAILY} n WHERE time >= DATE '2000-01-01'
  OR (time >= DATE '1999-03-01' AND dayofyear(time) % 7 = 0))"""
reg("qc_incremental", f"""SELECT q.time, q.site_id, q.variable, {r6('q.observed')} AS observed FROM
  {qc_sql(DAILY, ['site_id', 'variable'], 'time', 'observed', 0.5, 40.0, 20.0, 'keep',
          ['time', 'site_id', 'variable'])} q
  JOIN (SELECT site_id, variable, min(time) AS first FROM {NEW_ROWS} n GROUP BY 1, 2) f
    ON q.site_id = f.site_id AND q.variable = f.variable AND q.time >= f.first""")

# --- files and column choice --------------------------------------------------------------

reg("keep_existing_columns", f"""SELECT {r6('chlorophyll')} AS chlorophyll, siteID, startDateTime
  FROM {ARCHIVE_WQ} w""")
reg("drop_matching_columns", f"""SELECT event_id, siteID, startDateTime,
  {r6('sensorDepth')} AS sensorDepth, {r6('dissolvedOxygen')} AS dissolvedOxygen,
  {r6('chlorophyll')} AS chlorophyll FROM {ARCHIVE_WQ} w""")
reg("curated_csv_hourly", ORACLE["curated_hourly_strict"])
reg("targets_csv_roundtrip", f"""SELECT time, site_id, variable, {r6('observed')} AS observed
  FROM {DAILY} d""")
reg("forecast_file_roundtrip", ORACLE["rw_analytic"])

_KEY = "siteName, termName, verticalIndex, horizontalIndex, temporalIndex, startDate"
reg("latest_records", f"""SELECT {_KEY}, {r6('doubleValue')} AS doubleValue, CAST(intValue AS BIGINT) AS intValue
  FROM (SELECT *, rank() OVER (PARTITION BY {_KEY} ORDER BY issue DESC) AS r FROM (
    SELECT *, 1 AS issue FROM {provisional('20053')} a
    UNION ALL SELECT * REPLACE (doubleValue + 1 AS doubleValue), 2 AS issue FROM {provisional('20053')} b
    WHERE hour(startDate) % 3 = 0) u) v WHERE r = 1""")
reg("compacted_landing", ORACLE["latest_records"])
reg("refreshed_targets", ORACLE["targets_long"])

reg("climatology_kept_moments", ORACLE["climatology_doy"])
reg("climatology_forecast_kept_moments", ORACLE["climatology_forecast"])
reg("diff_sd_kept_differences", ORACLE["diff_sd"])
reg("rw_kept_differences", ORACLE["rw_analytic"])
reg("archive_releases", f"""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
  {r6("CASE WHEN event_type IN ('view', 'click') THEN floor(value) ELSE value END")} AS value,
  CASE WHEN event_type IN ('view', 'click', 'error') THEN NULL ELSE props END AS props FROM events""")

_RULES = f"""(SELECT {site_of('o_custkey')} AS site_id, o_custkey % 97 AS position, o_orderkey,
  CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderkey % 50 <> 0 THEN
  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS DATE) END AS valid_to FROM orders)"""
reg("overlapping_rules", f"""SELECT a.site_id, CAST(a.position AS BIGINT) AS position, a.valid_from, a.o_orderkey, a.valid_to
  FROM {_RULES} a WHERE EXISTS (SELECT 1 FROM {_RULES} b
  WHERE b.site_id = a.site_id AND b.position = a.position AND b.o_orderkey <> a.o_orderkey
  AND (b.valid_from, coalesce(b.valid_to, DATE '9999-12-31'), b.o_orderkey)
    < (a.valid_from, coalesce(a.valid_to, DATE '9999-12-31'), a.o_orderkey)
  AND coalesce(b.valid_to, DATE '9999-12-31') >= a.valid_from)""")

# of the rules that cover a day: the last start, the last end (an open one first), the greatest order
_RULE_ORDER = "r.valid_from DESC NULLS LAST, r.valid_to DESC NULLS LAST, r.o_orderkey DESC"
_OPENS = f"""(SELECT site_id, position, day, coalesce(lead(day) OVER (PARTITION BY site_id, position ORDER BY day) - 1,
    DATE '9999-12-31') AS day_to FROM (
  SELECT site_id, position, valid_from AS day FROM {_RULES} a UNION
  SELECT site_id, position, CAST(valid_to + 1 AS DATE) FROM {_RULES} b WHERE valid_to IS NOT NULL) u)"""
reg("rule_segments", f"""SELECT site_id, CAST(position AS BIGINT) AS position, segment_from, segment_to, o_orderkey FROM (
  SELECT o.site_id, o.position, o.day AS segment_from, CAST(o.day_to AS DATE) AS segment_to, r.o_orderkey,
    row_number() OVER (PARTITION BY o.site_id, o.position, o.day ORDER BY {_RULE_ORDER}) AS n
  FROM {_OPENS} o JOIN {_RULES} r ON r.site_id = o.site_id AND r.position = o.position
    AND r.valid_from <= o.day AND coalesce(r.valid_to, DATE '9999-12-31') >= o.day) x WHERE n = 1""")
reg("depth_correction_segments", f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, day, place, site,
  {r6('coalesce(o_orderkey % 1000 / 100.0, depth)')} AS depth FROM (
  SELECT l.*, r.o_orderkey, row_number() OVER (PARTITION BY line ORDER BY {_RULE_ORDER}) AS n
  FROM (SELECT row_number() OVER () AS line, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day, l_partkey % 97 AS place,
          {site_of('l_suppkey')} AS site, CAST(l_quantity AS DOUBLE) AS depth FROM lineitem) l
  LEFT JOIN {_RULES} r ON r.site_id = l.site AND r.position = l.place
    AND r.valid_from <= l.day AND coalesce(r.valid_to, DATE '9999-12-31') >= l.day) x WHERE n = 1""")

reg("exact_quantiles", " UNION ALL ".join(
    f"SELECT l_returnflag, {r6(_dbl(p))} AS prob, {r6(f'quantile_cont(l_extendedprice, {p})')} AS quantile "
    "FROM lineitem GROUP BY l_returnflag" for p in (0.025, 0.5, 0.975)))

reg("site_dimension_csv", """SELECT c_name AS field_site_id, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END
  AS field_site_subtype, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 2 AS BIGINT) END AS aquatics FROM customer""")
reg("rule_table_csv", f"""SELECT site_id, CAST(position AS BIGINT) AS position, valid_from, valid_to, o_orderkey,
  {r6('o_orderkey % 1000 / 100.0')} AS depth FROM {_RULES} r""")
reg("geo_json", ORACLE["coverage_geo"].split("WHERE")[0])
reg("forecast_contract", f"""SELECT site_id, variable, parameter, min(time) AS begin_date, max(time) AS end_date,
  count(*) AS n FROM ({ORACLE["rw_analytic"]}) f GROUP BY 1, 2, 3""")
