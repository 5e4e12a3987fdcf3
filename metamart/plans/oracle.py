"""DuckDB SQL for every registered query (the correctness oracle).

Each statement starts with the same CTEs: the binding's metadata as
VALUES, bronze computed straight in long form from lineitem x supplier (no
pivot and unpivot, so the Spark ingest path is checked independently),
then silver, the star schema and the events-derived log.
"""

from __future__ import annotations

from metamart.plans import binding as B


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


_DIM_TYPE = """SELECT CAST(k AS BIGINT) AS IncidentTypeKey, Classification, CodeGroup,
                    CASE WHEN Classification = 'Internal' THEN 'Int' ELSE 'Ext' END || ' ' || CodeGroup AS IncidentTypeName,
                    CAST(k AS BIGINT) AS SortOrder
             FROM (SELECT Classification, CodeGroup,
                          ROW_NUMBER() OVER (ORDER BY CASE WHEN Classification = 'Internal' THEN 1 ELSE 2 END,
                                             CodeGroup, Classification) AS k
                   FROM (SELECT DISTINCT Classification, CodeGroup FROM mapping WHERE IsActive))"""


def _prefix() -> str:
    src = [(sid, *info) for sid, info in B.SOURCES.items()]
    src_cols = ["SourceId", "SourceName", "FilePath", "SheetName", "PlantHeader", "MonthHeader",
                "IntPrefix", "ExtPrefix", "IsActive"]
    rules = B.RULES
    return f"""
WITH src_info AS (SELECT CAST(SourceId AS INTEGER) AS SourceId, SourceName, FilePath, SheetName,
                         PlantHeader, MonthHeader, IntPrefix, ExtPrefix, IsActive
                  FROM {_values(src, src_cols)}),
mapping AS (SELECT CAST(MappingId AS INTEGER) AS MappingId, CAST(SourceId AS INTEGER) AS SourceId,
                   SourceColumn, Classification, CodeGroup, IsActive
            FROM {_values(B.mapping_rows(), ["MappingId", "SourceId", "SourceColumn", "Classification", "CodeGroup", "IsActive"])}),
rules AS (SELECT CAST(RuleId AS INTEGER) AS RuleId, CAST(SourceId AS INTEGER) AS SourceId, RuleName,
                 RuleType, CAST(TargetColumn AS VARCHAR) AS TargetColumn, RuleParameters, Severity, IsActive
          FROM {_values(rules, ["RuleId", "SourceId", "RuleName", "RuleType", "TargetColumn", "RuleParameters", "Severity", "IsActive"])}),
key_map AS (SELECT CAST(SourceId AS INTEGER) AS SourceId, SourceColumn, TargetColumn, DataType
            FROM {_values(B.key_rows() + B.LEFTOVER_KEY_ROWS, ["SourceId", "SourceColumn", "TargetColumn", "DataType"])}),
mx AS (SELECT CAST(MappingId AS INTEGER) AS MappingId, CAST(SourceId AS INTEGER) AS SourceId,
              SourceColumn, Classification, CodeGroup, IsActive
       FROM {_values(B.mapping_rows() + B.EXTRA_MAPPING_ROWS, ["MappingId", "SourceId", "SourceColumn", "Classification", "CodeGroup", "IsActive"])}),
run_sources AS (SELECT CAST(SourceId AS INTEGER) AS SourceId FROM {_values([(s,) for s in B.LANDED_SOURCES], ["SourceId"])}),
li AS (SELECT CAST(l.l_suppkey % 3 + 1 AS BIGINT) AS SourceID, s.s_name AS Plant,
              CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS Month,
              l.l_linestatus, l.l_returnflag, l.l_quantity
       FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
bronze AS (SELECT li.SourceID, li.Plant, li.Month,
                  CASE WHEN li.l_linestatus = 'O' THEN i.IntPrefix ELSE i.ExtPrefix END || li.l_returnflag AS SourceColumn,
                  CAST(SUM(li.l_quantity) AS BIGINT) AS Value
           FROM li JOIN src_info i ON i.SourceId = li.SourceID
           GROUP BY ALL),
silver AS (SELECT b.Plant, b.Month, m.Classification, m.CodeGroup, b.Value AS Incidents
           FROM bronze b JOIN mapping m
             ON m.IsActive AND m.SourceId = b.SourceID AND m.SourceColumn = b.SourceColumn),
dim_plant AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Plant NULLS FIRST) AS BIGINT) AS PlantKey, Plant AS PlantCode
              FROM (SELECT DISTINCT Plant FROM silver)),
dim_type AS ({_DIM_TYPE}),
years AS (SELECT CAST(year(Month) AS INTEGER) AS Yr, MIN(Month) AS FirstMonth, MAX(Month) AS LastMonth
          FROM silver WHERE Month IS NOT NULL GROUP BY 1),
periods AS (SELECT Yr, strftime(FirstMonth, '%b') || '–' || strftime(LastMonth, '%b') || ' ' || CAST(Yr AS VARCHAR) AS Period
            FROM years),
days AS (SELECT CAST(unnest(generate_series(make_date(MIN(Yr), 1, 1), make_date(MAX(Yr), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
         FROM years),
dim_date AS (SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DateKey, d AS Date,
                    CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS MonthNumber,
                    strftime(d, '%b') AS MonthShort, p.Period
             FROM days JOIN periods p ON p.Yr = year(d)),
fact AS (SELECT p.PlantKey, d.DateKey, t.IncidentTypeKey, CAST(s.Incidents AS INTEGER) AS Incidents
         FROM silver s JOIN dim_plant p ON p.PlantCode = s.Plant
                       JOIN dim_date d ON d.Date = s.Month
                       JOIN dim_type t ON t.Classification = s.Classification AND t.CodeGroup = s.CodeGroup),
star AS (SELECT f.Incidents, f.DateKey, p.PlantCode, t.Classification, t.IncidentTypeName,
                d.Date, d.Year, d.MonthNumber, d.MonthShort, d.Period
         FROM fact f JOIN dim_plant p USING (PlantKey) JOIN dim_type t USING (IncidentTypeKey)
                     JOIN dim_date d USING (DateKey)),
hist AS (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '-' || CAST(user_id % 3 + 1 AS VARCHAR) AS RunId,
                date_trunc('hour', ts) AS RunTimestamp,
                CAST(user_id % 3 + 1 AS INTEGER) AS SourceId,
                CAST(event_id % 6 + 1 AS INTEGER) AS RuleId,
                event_type AS RuleName,
                CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Warning' END AS Severity,
                value >= CAST(json_extract_string(props, '$.k') AS INTEGER) AS Passed,
                'value: ' || printf('%.2f', value) AS Details
         FROM events),
prop_raw AS (SELECT CAST(user_id % 3 + 1 AS INTEGER) AS SourceId,
                    event_type || ' ' || CAST(user_id % 40 AS VARCHAR) AS SourceColumn,
                    ['Internal', 'External', 'Other'][CAST(event_id % 3 + 1 AS INTEGER)] AS Classification,
                    ['A', 'N', 'R', 'Z'][CAST(event_id % 4 + 1 AS INTEGER)] AS CodeGroup,
                    CAST(json_extract_string(props, '$.k') AS INTEGER) / 100 AS Confidence,
                    'event ' || CAST(event_id AS VARCHAR) AS Rationale,
                    'fixture-model' AS ModelName,
                    CAST(ts AS TIMESTAMP) AS ProposedAt,
                    event_id
             FROM events),
queue AS (SELECT SourceId, SourceColumn, Classification, CodeGroup, Confidence, Rationale, ModelName, ProposedAt
          FROM prop_raw
          WHERE Classification IN (SELECT Classification FROM mx WHERE IsActive)
            AND CodeGroup IN (SELECT CodeGroup FROM mx WHERE IsActive)),
approved AS (SELECT CAST((SELECT MAX(MappingId) FROM mx) + ROW_NUMBER() OVER (ORDER BY SourceId, SourceColumn) AS INTEGER) AS MappingId,
                    SourceId, SourceColumn, Classification, CodeGroup, TRUE AS IsActive
             FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY SourceId, SourceColumn
                                                ORDER BY ProposedAt DESC, Confidence DESC) AS rn FROM queue) l
             WHERE rn = 1 AND Confidence >= 0.90
               AND NOT EXISTS (SELECT 1 FROM mx m WHERE m.SourceId = l.SourceId AND m.SourceColumn = l.SourceColumn))
"""


PREFIX = _prefix()

# --- measure helpers --------------------------------------------------------
_SPLITS = "SUM(Incidents) AS v, SUM(CASE WHEN Classification = 'Internal' THEN Incidents END) AS vi, " \
          "SUM(CASE WHEN Classification = 'External' THEN Incidents END) AS ve"


def _yoy_cols(c: str, p: str) -> str:
    out = []
    for name, col in (("Incidents", "v"), ("Internal", "vi"), ("External", "ve")):
        chg = f"CASE WHEN {p}.{col} IS NOT NULL THEN COALESCE({c}.{col}, 0) - {p}.{col} END"
        out.append(f"CAST({c}.{col} AS BIGINT) AS {name}, CAST({p}.{col} AS BIGINT) AS {name}_PY, "
                   f"CAST({chg} AS BIGINT) AS {name}_Chg, "
                   f"CAST({chg} AS DOUBLE) / CAST(NULLIF({p}.{col}, 0) AS DOUBLE) AS {name}_Pct_Chg")
    return ", ".join(out)


_ANY = "COALESCE(c.v, c.vi, c.ve, p.v, p.vi, p.ve) IS NOT NULL"

_LATEST_COLS = """lm.LatestMonth,
  CAST(a.v AS BIGINT) AS Incidents_Latest_Month, CAST(pm.v AS BIGINT) AS Incidents_Previous_Month,
  CAST(CASE WHEN pm.v IS NOT NULL THEN COALESCE(a.v, 0) - pm.v END AS BIGINT) AS Latest_Month_Chg,
  CAST(CASE WHEN pm.v IS NOT NULL THEN COALESCE(a.v, 0) - pm.v END AS DOUBLE) / CAST(NULLIF(pm.v, 0) AS DOUBLE) AS Pct_Latest_Month_Chg,
  upper(strftime(lm.LatestMonth, '%b')) AS Latest_Month_Label,
  'LATEST MONTH • ' || upper(strftime(lm.LatestMonth, '%b')) AS Latest_Month_Label2"""


def _latest(keys: list[str], where: str = "TRUE") -> str:
    """SELECT list + FROM for latest-month measures grouped by ``keys``
    (keys other than Year are matched in the month lookups)."""
    g = ", ".join(keys)
    sel = ", ".join(f"lm.{k}" for k in keys)
    other = [k for k in keys if k != "Year"]
    on_a = " AND ".join([f"a.{k} = lm.{k}" for k in other] + ["a.Date = lm.LatestMonth"])
    on_p = " AND ".join([f"pm.{k} = lm.{k}" for k in other] + ["pm.Date = CAST(lm.LatestMonth - INTERVAL 1 MONTH AS DATE)"])
    by_date = f"(SELECT {', '.join(other + ['Date'])}, SUM(Incidents) AS v FROM star GROUP BY ALL)"
    head = f"SELECT {g + ', ' if g else ''}MAX(Date) AS LatestMonth FROM star WHERE {where}" + (f" GROUP BY {g}" if g else "")
    return (f"SELECT {sel + ', ' if sel else ''}{_LATEST_COLS} FROM ({head}) lm "
            f"LEFT JOIN {by_date} a ON {on_a} LEFT JOIN {by_date} pm ON {on_p}")


def _yoy_by_year() -> str:
    return (f"SELECT y.Year, {_yoy_cols('c', 'p')} FROM (SELECT DISTINCT Year FROM dim_date) y "
            f"LEFT JOIN (SELECT Year, {_SPLITS} FROM star GROUP BY Year) c ON c.Year = y.Year "
            f"LEFT JOIN (SELECT Year, {_SPLITS} FROM star GROUP BY Year) p ON p.Year = y.Year - 1 "
            f"WHERE {_ANY}")


def _signal(pct: str, mpct: str, lm: str) -> str:
    mval = f"COALESCE({mpct}, 0.0)"
    return (f"CASE WHEN {pct} IS NULL THEN 'No prior-year data available for the selected period.' ELSE "
            f"'Total incidents are ' || printf('%.1f%%', abs({pct}) * 100.0) || ' ' || "
            f"CASE WHEN {pct} >= 0 THEN 'higher' ELSE 'lower' END || ' than PY, while ' || "
            f"strftime({lm}, '%B') || ' ' || CASE WHEN {mval} >= 0 THEN 'increased' ELSE 'decreased' END || ' ' || "
            f"printf('%.1f%%', abs({mval}) * 100.0) || ' versus ' || "
            f"strftime(CAST({lm} - INTERVAL 1 MONTH AS DATE), '%B') || "
            f"CASE WHEN {mval} > 0 THEN ' and should be monitored' ELSE '' END || '.' END")


def _labels(year: str) -> str:
    sel = f"CAST({year} AS VARCHAR)"
    return (f"{sel} AS Selected_Year, 'TOTAL INCIDENTS • ' || {sel} AS Incidents_Label, "
            f"'INTERNAL • ' || {sel} AS Internal_Label, 'EXTERNAL • ' || {sel} AS External_Label, "
            f"'PY ' || CAST({year} - 1 AS VARCHAR) AS PY_Label")


def _arrow(x: str) -> str:
    r = f"round(CAST({x} AS DOUBLE))"
    return (f"CASE WHEN {r} > 0 THEN '▲ ' || format('{{:,}}', CAST({r} AS BIGINT)) "
            f"WHEN {r} < 0 THEN '▼ ' || format('{{:,}}', CAST(abs({r}) AS BIGINT)) WHEN {r} = 0 THEN '0' END")


def _signed(x: str) -> str:
    r = f"round(CAST({x} AS DOUBLE) * 100.0, 1)"
    return (f"CASE WHEN {r} > 0 THEN printf('+%.1f%%', {r}) WHEN {r} < 0 THEN printf('-%.1f%%', abs({r})) "
            f"WHEN {r} = 0 THEN '0.0%' END")


def _display() -> str:
    cols = [f"{_arrow(n + '_Chg')} AS {n}_Chg_Display" for n in ("Incidents", "Internal", "External")]
    cols += [f"{_signed(n + '_Pct_Chg')} AS {n}_Pct_Chg_Display" for n in ("Incidents", "Internal", "External")]
    cols += [f"{_arrow('Latest_Month_Chg')} AS Latest_Month_Chg_Display",
             f"{_signed('Pct_Latest_Month_Chg')} AS Pct_Latest_Month_Chg_Display"]
    return ", ".join(cols)


def _dq(run: str, now: str) -> str:
    """CTEs from bronze, mapping, rules and run_sources to the log of one run."""
    return f"""
, prof AS (SELECT SourceID, COUNT(*) AS Rows, MIN(Value) AS MinValue,
                  COUNT(*) FILTER (WHERE Plant IS NULL OR trim(Plant) = '') AS bad_Plant,
                  COUNT(*) FILTER (WHERE SourceColumn IS NULL OR trim(SourceColumn) = '') AS bad_SourceColumn,
                  COUNT(*) FILTER (WHERE Month IS NULL) AS bad_Month,
                  COUNT(*) FILTER (WHERE Value IS NULL) AS bad_Value
           FROM bronze WHERE SourceID IN (SELECT SourceId FROM run_sources) GROUP BY SourceID),
unm AS (SELECT SourceID, COUNT(*) AS n, string_agg(SourceColumn, ', ' ORDER BY SourceColumn) AS lst
        FROM (SELECT DISTINCT b.SourceID, b.SourceColumn FROM bronze b
              WHERE b.SourceID IN (SELECT SourceId FROM run_sources)
                AND NOT EXISTS (SELECT 1 FROM mapping m WHERE m.IsActive AND m.SourceId = b.SourceID
                                AND m.SourceColumn = b.SourceColumn))
        GROUP BY SourceID),
mis AS (SELECT m.SourceId AS SourceID, COUNT(*) AS n, string_agg(m.SourceColumn, ', ' ORDER BY m.SourceColumn) AS lst
        FROM mapping m WHERE m.IsActive AND m.SourceId IN (SELECT SourceId FROM run_sources)
          AND NOT EXISTS (SELECT 1 FROM bronze b WHERE b.SourceID = m.SourceId AND b.SourceColumn = m.SourceColumn)
        GROUP BY m.SourceId),
dup AS (SELECT COUNT(*) AS Dupes FROM (SELECT 1 FROM silver GROUP BY Plant, Month, Classification, CodeGroup
                                       HAVING COUNT(*) > 1)),
meas AS (SELECT r.SourceId, COALESCE(p.Rows, 0) AS Rows, p.MinValue,
                COALESCE(p.bad_Plant, 0) AS bad_Plant, COALESCE(p.bad_SourceColumn, 0) AS bad_SourceColumn,
                COALESCE(p.bad_Month, 0) AS bad_Month, COALESCE(p.bad_Value, 0) AS bad_Value,
                COALESCE(u.n, 0) AS Unmapped, u.lst AS UnmappedList, COALESCE(m.n, 0) AS Missing, m.lst AS MissingList
         FROM run_sources r LEFT JOIN prof p ON p.SourceID = r.SourceId LEFT JOIN unm u ON u.SourceID = r.SourceId
              LEFT JOIN mis m ON m.SourceID = r.SourceId),
app AS (SELECT s.SourceId AS RunSourceId, r.* FROM rules r JOIN run_sources s
          ON r.SourceId IS NULL OR r.SourceId = s.SourceId
        WHERE r.IsActive AND r.RuleType IN ('SchemaDrift', 'MissingColumn', 'RowCount', 'NotNull', 'Range', 'Unique')),
ev AS (SELECT a.*, m.*, dup.Dupes,
              CASE a.TargetColumn WHEN 'Plant' THEN m.bad_Plant WHEN 'SourceColumn' THEN m.bad_SourceColumn
                   WHEN 'Month' THEN m.bad_Month WHEN 'Value' THEN m.bad_Value END AS bad,
              CAST(json_extract_string(a.RuleParameters, '$.min') AS INTEGER) AS pmin
       FROM app a JOIN meas m ON m.SourceId = a.RunSourceId CROSS JOIN dup),
vlog AS (SELECT '{run}-' || CAST(RunSourceId AS VARCHAR) AS RunId, TIMESTAMP '{now}' AS RunTimestamp,
                RunSourceId AS SourceId, RuleId, RuleName, Severity,
                CASE RuleType WHEN 'SchemaDrift' THEN Unmapped = 0 WHEN 'MissingColumn' THEN Missing = 0
                     WHEN 'RowCount' THEN COALESCE(Rows >= pmin, FALSE) WHEN 'NotNull' THEN COALESCE(bad = 0, FALSE)
                     WHEN 'Range' THEN COALESCE(MinValue >= pmin, FALSE) WHEN 'Unique' THEN Dupes = 0 END AS Passed,
                CASE RuleType
                  WHEN 'SchemaDrift' THEN 'unmapped columns: ' || CAST(Unmapped AS VARCHAR) || COALESCE('; ' || UnmappedList, '')
                  WHEN 'MissingColumn' THEN 'missing columns: ' || CAST(Missing AS VARCHAR) || COALESCE('; ' || MissingList, '')
                  WHEN 'RowCount' THEN 'rows: ' || CAST(Rows AS VARCHAR)
                  WHEN 'NotNull' THEN CASE WHEN bad IS NULL THEN 'column unknown to the engine: ' || COALESCE(TargetColumn, '')
                                           ELSE 'missing values in ' || COALESCE(TargetColumn, '') || ': ' || CAST(bad AS VARCHAR) END
                  WHEN 'Range' THEN 'minimum value: ' || COALESCE(CAST(MinValue AS VARCHAR), '')
                  WHEN 'Unique' THEN 'duplicate combinations: ' || CAST(Dupes AS VARCHAR) END AS Details
         FROM ev)
"""

_LOG_REPORT = """
, g AS (SELECT RunTimestamp, RuleName, Severity, Details, Passed, COUNT(SourceId) AS SourceIds FROM hist GROUP BY ALL),
f AS (SELECT RunTimestamp, RuleName, Severity, Details, COUNT(*) AS FailedRules FROM hist WHERE NOT Passed GROUP BY ALL),
rep AS (SELECT g.*, f.FailedRules FROM g LEFT JOIN f
          ON g.RunTimestamp IS NOT DISTINCT FROM f.RunTimestamp AND g.RuleName IS NOT DISTINCT FROM f.RuleName
         AND g.Severity IS NOT DISTINCT FROM f.Severity AND g.Details IS NOT DISTINCT FROM f.Details)
SELECT rep.RunTimestamp, rep.RuleName, rep.Severity, rep.Passed, rep.Details, rep.SourceIds, rep.FailedRules,
       COALESCE(rep.FailedRules >= b.mn + 0.01 * (b.mx - b.mn), FALSE) AS Highlight
FROM rep, (SELECT MIN(FailedRules) AS mn, MAX(FailedRules) AS mx FROM rep) b
"""

_SOURCE_STATS = """
SELECT CAST(r.SourceId AS BIGINT) AS SourceID, {cols}
FROM run_sources r LEFT JOIN (SELECT SourceID, COUNT(*) AS Rows, MIN(Value) AS MinValue,
     COUNT(*) FILTER (WHERE Plant IS NULL OR trim(Plant) = '') AS NullPlant,
     COUNT(*) FILTER (WHERE SourceColumn IS NULL OR trim(SourceColumn) = '') AS NullSourceColumn,
     COUNT(*) FILTER (WHERE Month IS NULL) AS NullMonth, COUNT(*) FILTER (WHERE Value IS NULL) AS NullValue
     FROM bronze GROUP BY SourceID) p ON p.SourceID = r.SourceId
"""

_Y98 = "Year = 1998"

SQL: dict[str, str] = {
    "active_sources": """
SELECT i.SourceId, i.SourceName, i.FilePath, i.SheetName, CAST(COALESCE(w.n, 0) AS BIGINT) AS LandingRows
FROM src_info i LEFT JOIN (SELECT SourceID, COUNT(*) AS n FROM (SELECT DISTINCT SourceID, Plant, Month FROM li)
                           GROUP BY SourceID) w ON w.SourceID = i.SourceId
WHERE i.IsActive""",
    "bronze_unpivot": "SELECT * FROM bronze",
    "bronze_landing": "SELECT * FROM bronze",
    "bronze_replace": "SELECT * FROM bronze WHERE SourceID <> 3",
    "silver": "SELECT * FROM silver",
    "unmapped_columns": """
SELECT DISTINCT b.SourceID, b.SourceColumn FROM bronze b
WHERE b.SourceID IN (SELECT SourceId FROM run_sources)
  AND NOT EXISTS (SELECT 1 FROM mapping m WHERE m.IsActive AND m.SourceId = b.SourceID AND m.SourceColumn = b.SourceColumn)""",
    "missing_columns": """
SELECT CAST(m.SourceId AS BIGINT) AS SourceID, m.SourceColumn FROM mapping m
WHERE m.IsActive AND m.SourceId IN (SELECT SourceId FROM run_sources)
  AND NOT EXISTS (SELECT 1 FROM bronze b WHERE b.SourceID = m.SourceId AND b.SourceColumn = m.SourceColumn)""",
    "null_counts": _SOURCE_STATS.format(cols=", ".join(
        f"CAST(COALESCE(p.Null{c}, 0) AS BIGINT) AS Null{c}" for c in ("Plant", "SourceColumn", "Month", "Value"))),
    "row_counts": _SOURCE_STATS.format(cols="CAST(COALESCE(p.Rows, 0) AS BIGINT) AS Rows"),
    "min_value": _SOURCE_STATS.format(cols="p.MinValue"),
    "duplicate_grain": """
SELECT CAST(COUNT(*) AS BIGINT) AS Dupes FROM (SELECT 1 FROM silver GROUP BY Plant, Month, Classification, CodeGroup
                                              HAVING COUNT(*) > 1)""",
    "validation_log": _dq(B.RUN_NOW.strftime("%Y-%m-%dT%H:%M:%S"), B.RUN_NOW.strftime("%Y-%m-%d %H:%M:%S")) + "SELECT * FROM vlog",
    "failed_rules": """
SELECT CAST(COUNT(*) FILTER (WHERE NOT Passed) AS BIGINT) AS FailedRules,
       CAST(COUNT(*) FILTER (WHERE NOT Passed AND RunTimestamp = (SELECT MAX(RunTimestamp) FROM hist)) AS BIGINT)
         AS FailedRulesLatestRun
FROM hist""",
    "latest_run": "SELECT * FROM hist WHERE RunTimestamp = (SELECT MAX(RunTimestamp) FROM hist)",
    "latest_run_per_source": """
SELECT h.* FROM hist h
WHERE h.RunTimestamp = (SELECT MAX(x.RunTimestamp) FROM hist x WHERE x.SourceId = h.SourceId)""",
    "log_report": _LOG_REPORT,
    "rule_history": "SELECT * FROM hist WHERE RuleName = 'error'",
    "dim_plant": "SELECT * FROM dim_plant",
    "dim_type": "SELECT * FROM dim_type",
    "dim_date": "SELECT * FROM dim_date",
    "periods": "SELECT * FROM periods",
    "fact": "SELECT * FROM fact",
    "gold_counts": """
SELECT 'FactIncidents' AS TableName, CAST(COUNT(*) AS BIGINT) AS RowCount FROM fact
UNION ALL SELECT 'DimPlant', COUNT(*) FROM dim_plant
UNION ALL SELECT 'DimIncidentType', COUNT(*) FROM dim_type""",
    "measure_totals": f"SELECT CAST(v AS BIGINT) AS Incidents, CAST(vi AS BIGINT) AS Internal, CAST(ve AS BIGINT) AS External FROM (SELECT {_SPLITS} FROM star)",
    "measure_split": f"SELECT Year, CAST(v AS BIGINT) AS Incidents, CAST(vi AS BIGINT) AS Internal, CAST(ve AS BIGINT) AS External FROM (SELECT Year, {_SPLITS} FROM star GROUP BY Year)",
    "yoy_by_year": _yoy_by_year(),
    "yoy_total": f"""
SELECT {_yoy_cols('c', 'p')} FROM (SELECT {_SPLITS} FROM star) c,
  (SELECT {_SPLITS} FROM star WHERE CAST(Date + INTERVAL 12 MONTH AS DATE) IN (SELECT Date FROM dim_date)) p""",
    "yoy_by_plant": f"""
SELECT k.PlantCode, CAST(c.v AS BIGINT) AS Incidents, CAST(p.v AS BIGINT) AS Incidents_PY,
       CAST(CASE WHEN p.v IS NOT NULL THEN COALESCE(c.v, 0) - p.v END AS BIGINT) AS Incidents_Chg,
       CAST(CASE WHEN p.v IS NOT NULL THEN COALESCE(c.v, 0) - p.v END AS DOUBLE) / CAST(NULLIF(p.v, 0) AS DOUBLE) AS Incidents_Pct_Chg
FROM (SELECT DISTINCT PlantCode FROM star) k
LEFT JOIN (SELECT PlantCode, {_SPLITS} FROM star WHERE {_Y98} GROUP BY PlantCode) c ON c.PlantCode = k.PlantCode
LEFT JOIN (SELECT PlantCode, {_SPLITS} FROM star WHERE Year = 1997 AND 1998 IN (SELECT Year FROM dim_date)
           GROUP BY PlantCode) p ON p.PlantCode = k.PlantCode
WHERE {_ANY}""",
    "yoy_split": f"""
SELECT {_yoy_cols('c', 'p')} FROM (SELECT {_SPLITS} FROM star WHERE {_Y98}) c,
  (SELECT {_SPLITS} FROM star WHERE Year = 1997 AND 1998 IN (SELECT Year FROM dim_date)) p""",
    "latest_month": _latest([]),
    "latest_month_year": _latest(["Year"]),
    "mom_by_plant": _latest(["PlantCode"]),
    "kpi_labels": f"""
SELECT y.Year, {_labels('y.Year')}, l.Latest_Month_Label2
FROM (SELECT DISTINCT Year FROM dim_date) y LEFT JOIN ({_latest(['Year'])}) l ON l.Year = y.Year""",
    "overview_signal": f"""
SELECT yy.Year, {_signal('yy.Incidents_Pct_Chg', 'l.Pct_Latest_Month_Chg', 'l.LatestMonth')} AS Overview_Signal
FROM ({_yoy_by_year()}) yy LEFT JOIN ({_latest(['Year'])}) l ON l.Year = yy.Year""",
    "yoy_daily": f"""
, daily AS (SELECT CAST(l_shipdate AS DATE) AS d, CASE WHEN l_linestatus = 'O' THEN 'Internal' ELSE 'External' END AS Classification,
                   CAST(l_quantity AS BIGINT) AS Incidents FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT k.MonthShort, {_yoy_cols('c', 'p')}
FROM (SELECT DISTINCT strftime(d, '%b') AS MonthShort FROM daily) k
LEFT JOIN (SELECT strftime(d, '%b') AS MonthShort, {_SPLITS} FROM daily WHERE year(d) = 1997 GROUP BY 1) c ON c.MonthShort = k.MonthShort
LEFT JOIN (SELECT strftime(d, '%b') AS MonthShort, {_SPLITS} FROM daily WHERE year(d) = 1996 GROUP BY 1) p ON p.MonthShort = k.MonthShort
WHERE {_ANY}""",
    "trend_month_class": """
SELECT MonthShort, MonthNumber, Classification, CAST(SUM(Incidents) AS BIGINT) AS Incidents
FROM star GROUP BY ALL""",
    "plant_class": """
SELECT PlantCode, Classification, CAST(SUM(Incidents) AS BIGINT) AS Incidents,
       CAST(SUM(SUM(Incidents)) OVER (PARTITION BY PlantCode) AS BIGINT) AS PlantTotal
FROM star GROUP BY PlantCode, Classification""",
    "incident_mix": "SELECT IncidentTypeName, CAST(SUM(Incidents) AS BIGINT) AS Incidents FROM star GROUP BY ALL",
    "plant_class_1998": """
SELECT PlantCode, Classification, CAST(SUM(Incidents) AS BIGINT) AS Incidents,
       CAST(SUM(SUM(Incidents)) OVER (PARTITION BY PlantCode) AS BIGINT) AS PlantTotal
FROM star WHERE Year = 1998 GROUP BY PlantCode, Classification""",
    "yoy_by_plant_internal": f"""
SELECT k.PlantCode, CAST(c.v AS BIGINT) AS Incidents, CAST(p.v AS BIGINT) AS Incidents_PY,
       CAST(c.vi AS BIGINT) AS Internal, CAST(p.vi AS BIGINT) AS Internal_PY,
       CAST(CASE WHEN p.vi IS NOT NULL THEN COALESCE(c.vi, 0) - p.vi END AS BIGINT) AS Internal_Chg,
       CAST(c.ve AS BIGINT) AS External, CAST(p.ve AS BIGINT) AS External_PY
FROM (SELECT DISTINCT PlantCode FROM star) k
LEFT JOIN (SELECT PlantCode, {_SPLITS} FROM star WHERE Year = 1998 AND Classification = 'Internal'
           GROUP BY PlantCode) c ON c.PlantCode = k.PlantCode
LEFT JOIN (SELECT PlantCode, {_SPLITS} FROM star WHERE Year = 1997 AND Classification = 'Internal'
           GROUP BY PlantCode) p ON p.PlantCode = k.PlantCode
WHERE {_ANY}""",
    "kpi_status": f"""
SELECT Year, Incidents_Chg,
       CASE WHEN Incidents_Chg >= 1 THEN 'worse' WHEN Incidents_Chg < 0 THEN 'better' END AS Chg_Status,
       Incidents_Pct_Chg,
       CASE WHEN Incidents_Pct_Chg >= 0 THEN 'worse' WHEN Incidents_Pct_Chg < 0 THEN 'better' END AS Pct_Status
FROM ({_yoy_by_year()})""",
    "kpi_cards": f"""
SELECT *, {_display()} FROM (
SELECT {_yoy_cols('c', 'p')}, l.*, {_labels('1998')}
FROM (SELECT {_SPLITS} FROM star WHERE {_Y98}) c,
     (SELECT {_SPLITS} FROM star WHERE Year = 1997) p,
     ({_latest([], _Y98)}) l)""",
    "slicer_options": """
SELECT DISTINCT 'Period' AS Slicer, Period AS Value FROM dim_date
UNION ALL SELECT DISTINCT 'Classification', Classification FROM star
UNION ALL SELECT DISTINCT 'Plant', PlantCode FROM star WHERE PlantCode IS NOT NULL""",
    "end_to_end_totals": """
SELECT 'bronze' AS Stage, CAST(COUNT(*) AS BIGINT) AS Rows, CAST(SUM(Value) AS BIGINT) AS ValueSum FROM bronze
UNION ALL SELECT 'silver', COUNT(*), CAST(SUM(Incidents) AS BIGINT) FROM silver
UNION ALL SELECT 'fact', COUNT(*), CAST(SUM(Incidents) AS BIGINT) FROM fact""",
}


SQL.update({
    "register_sources": """
, req AS (SELECT s_suppkey AS RequestId, 'Incidents ' || s_name AS SourceName,
                 CASE WHEN s_suppkey % 10 = 0 THEN 'Files/landing/source_' || CAST(s_suppkey % 3 + 1 AS VARCHAR) || '.xlsx'
                      ELSE 'Files/landing/nation_' || CAST(s_nationkey AS VARCHAR) || '.xlsx' END AS FilePath,
                 'Sheet1' AS SheetName, 'Plant' AS PlantColumn, 'Month' AS MonthColumn
          FROM supplier),
flagged AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY FilePath ORDER BY RequestId) = 1 AS first_,
                   FilePath IN (SELECT FilePath FROM src_info) AS known
            FROM req),
ok AS (SELECT RequestId, (SELECT MAX(SourceId) FROM src_info) + ROW_NUMBER() OVER (ORDER BY RequestId) AS NewId
       FROM flagged WHERE first_ AND NOT known),
st AS (SELECT f.*, ok.NewId,
              CASE WHEN f.known OR NOT f.first_ THEN 'path already registered'
                   WHEN ok.NewId IN (SELECT SourceId FROM key_map) THEN 'key columns already exist for this id'
                   ELSE 'registered' END AS Status
       FROM flagged f LEFT JOIN ok USING (RequestId))
SELECT RequestId, SourceName, FilePath, SheetName, PlantColumn, MonthColumn, Status,
       CASE WHEN Status = 'registered' THEN CAST(NewId AS INTEGER) END AS SourceId
FROM st""",
    "approve_proposals": "SELECT * FROM approved",
    "pending_proposals": """
SELECT * FROM queue q WHERE NOT EXISTS (SELECT 1 FROM mx m WHERE m.SourceId = q.SourceId AND m.SourceColumn = q.SourceColumn)""",
    "mapping_changes": """
, deact AS (SELECT m.MappingId FROM mx m WHERE m.IsActive AND m.SourceId IN (SELECT SourceId FROM run_sources)
              AND NOT EXISTS (SELECT 1 FROM bronze b WHERE b.SourceID = m.SourceId AND b.SourceColumn = m.SourceColumn)),
act AS (SELECT m.MappingId FROM mx m WHERE NOT m.IsActive
          AND EXISTS (SELECT 1 FROM bronze b WHERE b.SourceID = m.SourceId AND b.SourceColumn = m.SourceColumn))
SELECT MappingId, SourceId, SourceColumn, Classification, CodeGroup,
       CASE WHEN MappingId IN (SELECT MappingId FROM act) THEN TRUE
            WHEN MappingId IN (SELECT MappingId FROM deact) THEN FALSE ELSE IsActive END AS IsActive
FROM mx
UNION ALL SELECT * FROM approved""",
    "set_active": """
SELECT SourceId, SourceName, FilePath, SheetName,
       CASE WHEN SourceId IN (SELECT DISTINCT CAST(SourceID AS INTEGER) FROM li) THEN FALSE ELSE IsActive END AS IsActive
FROM src_info""",
    "meta_counts": """
SELECT 'SourceRegistry' AS TableName, CAST(COUNT(*) AS BIGINT) AS Rows FROM src_info
UNION ALL SELECT 'KeyColumnMapping', COUNT(*) FROM key_map WHERE SourceId IN (SELECT SourceId FROM src_info)
UNION ALL SELECT 'ColumnMapping', (SELECT COUNT(*) FROM mx) + (SELECT COUNT(*) FROM approved)
UNION ALL SELECT 'DQRules', COUNT(*) FROM rules
UNION ALL SELECT 'ValidationLog', COUNT(*) FROM hist""",
    "vocabulary": """
, allm AS (SELECT * FROM mx UNION ALL SELECT * FROM approved)
SELECT DISTINCT 'Classification' AS Kind, Classification AS Value FROM allm WHERE IsActive
UNION ALL SELECT DISTINCT 'CodeGroup', CodeGroup FROM allm WHERE IsActive""",
    "parse_proposals": """
SELECT SourceId, ModelName, SourceColumn, Classification, CodeGroup, Confidence, Rationale
FROM prop_raw WHERE (event_id // 16) % 7 <> 6""",
    "valid_proposals": "SELECT * FROM queue",
    "proposal_stats": """
SELECT SourceId, CAST(COUNT(*) AS BIGINT) AS Proposed,
       CAST(COUNT(*) FILTER (WHERE ok) AS BIGINT) AS Valid, CAST(COUNT(*) FILTER (WHERE NOT ok) AS BIGINT) AS Rejected,
       CAST(COUNT(*) FILTER (WHERE ok AND SourceColumn IS NULL) AS BIGINT) AS NoColumn
FROM (SELECT *, Classification IN (SELECT Classification FROM mx WHERE IsActive)
                AND CodeGroup IN (SELECT CodeGroup FROM mx WHERE IsActive) AS ok FROM prop_raw)
GROUP BY SourceId""",
})


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + v for k, v in SQL.items()}
