"""DuckDB SQL of the queries on the untidy binding."""

from __future__ import annotations

from datetime import datetime

from metamart.plans import binding as B, dirty as D
from metamart.plans.oracle import _DIM_TYPE, PREFIX as CLEAN, _dq, _values


def _prefix(reloaded: bool) -> str:
    heads = [(s, B.SOURCES[s][5], B.SOURCES[s][6]) for s in (1, 2, 3, 4)]
    held = (f"SELECT * FROM arrived WHERE SourceID = 4 OR (SourceID = 1 AND (Month IS NULL OR Month >= DATE '{D.RELOAD_FROM}'))"
            if reloaded else "SELECT * FROM arrived")
    return f"""
WITH heads AS (SELECT CAST(s AS INTEGER) AS s, i, e FROM {_values(heads, ["s", "i", "e"])}),
rules AS (SELECT CAST(RuleId AS INTEGER) AS RuleId, CAST(SourceId AS INTEGER) AS SourceId, RuleName, RuleType,
                 CAST(TargetColumn AS VARCHAR) AS TargetColumn, RuleParameters, Severity, IsActive
          FROM {_values(D.RULES, ["RuleId", "SourceId", "RuleName", "RuleType", "TargetColumn", "RuleParameters", "Severity", "IsActive"])}),
run_sources AS (SELECT CAST(SourceId AS INTEGER) AS SourceId
                FROM {_values([(s,) for s in (D.SECOND_RUN if reloaded else D.FIRST_RUN)], ["SourceId"])}),
line AS (SELECT l.*, s.s_name, CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS m
         FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
untidy AS (SELECT CAST(l_suppkey % 3 + 1 AS BIGINT) AS SourceID,
                  CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 11 = 1 THEN ''
                       WHEN l_suppkey % 11 = 2 THEN s_name || chr(10) || 'Annex "B"' ELSE s_name END AS Plant,
                  CASE WHEN NOT (l_suppkey % 7 = 3 AND month(m) = 12) THEN m END AS Month,
                  l_linestatus, l_returnflag, l_quantity, l_linenumber FROM line),
sums AS (SELECT SourceID, Plant, Month, l_linestatus, l_returnflag, SUM(l_quantity) AS v FROM untidy GROUP BY ALL),
arrived AS (
  SELECT SourceID, Plant, Month, CASE WHEN l_linestatus = 'O' THEN i ELSE e END || l_returnflag AS SourceColumn,
         CAST(round_even(CASE WHEN month(Month) = 3 THEN v + 0.5 WHEN month(Month) = 6 THEN -v ELSE v END, 0) AS BIGINT) AS Value
  FROM sums JOIN heads ON s = SourceID
  UNION ALL
  SELECT SourceID, Plant, Month, 'Column9', CAST(SUM(l_linenumber) AS BIGINT) FROM untidy GROUP BY SourceID, Plant, Month
  UNION ALL
  SELECT 4, s_name, m, CASE WHEN l_linestatus = 'O' THEN i ELSE e END || l_returnflag, CAST(round_even(SUM(l_quantity), 0) AS BIGINT)
  FROM line JOIN heads ON s = 4 WHERE l_suppkey % 10 = 3 GROUP BY s_name, m, l_linestatus, l_returnflag, i, e),
bronze AS ({held}),
kinds AS (SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem),
mapping AS (
  SELECT CAST(s * 1000 + ROW_NUMBER() OVER (PARTITION BY s ORDER BY l_linestatus, l_returnflag) AS INTEGER) AS MappingId, s AS SourceId,
         CASE WHEN l_linestatus = 'O' THEN i ELSE e END || l_returnflag AS SourceColumn,
         CASE WHEN l_linestatus = 'O' THEN 'Internal' ELSE 'External' END AS Classification, l_returnflag AS CodeGroup,
         NOT (s = 3 AND l_returnflag = 'R') AS IsActive FROM heads, kinds
  UNION ALL
  SELECT n_nationkey, 1, 'Nation ' || n_name, 'External', 'X' || n_regionkey, n_nationkey % 2 = 0 FROM nation),
silver AS (SELECT b.Plant, b.Month, m.Classification, m.CodeGroup, b.Value AS Incidents
           FROM bronze b JOIN mapping m ON m.IsActive AND m.SourceId = b.SourceID AND m.SourceColumn = b.SourceColumn)
"""


FIRST, SECOND = _prefix(False), _prefix(True)


def _run(now: datetime) -> str:
    return _dq(now.strftime("%Y-%m-%dT%H:%M:%S"), now.strftime("%Y-%m-%d %H:%M:%S"))


SQL = {
    "dirty_landing": FIRST + "SELECT * FROM bronze",
    "dirty_reloaded": SECOND + "SELECT * FROM bronze",
    "dirty_null_counts": SECOND + _run(D.SECOND_NOW) + """
SELECT CAST(SourceId AS BIGINT) AS SourceID, CAST(Rows AS BIGINT) AS Rows, MinValue, CAST(bad_Plant AS BIGINT) AS NullPlant,
       CAST(bad_SourceColumn AS BIGINT) AS NullSourceColumn, CAST(bad_Month AS BIGINT) AS NullMonth, CAST(bad_Value AS BIGINT) AS NullValue
FROM meas""",
    "dirty_duplicate_grain": SECOND + _run(D.SECOND_NOW) + "SELECT Dupes FROM dup",
    "dirty_log": FIRST + _run(B.RUN_NOW) + "SELECT * FROM vlog",
    "dirty_log_reloaded": SECOND + _run(D.SECOND_NOW) + "SELECT * FROM vlog",
    "dirty_verdicts": SECOND + _run(D.SECOND_NOW) + """
SELECT RunId, RunTimestamp, SourceId, COUNT(*) AS Rules, COUNT(*) FILTER (WHERE NOT Passed) AS Failed,
       COUNT(*) FILTER (WHERE NOT Passed AND Severity = 'Error') AS FailedErrors,
       COUNT(*) FILTER (WHERE NOT Passed AND Severity = 'Error') = 0 AS MayPublish
FROM vlog GROUP BY ALL""",
    "dirty_dim_type": SECOND + ", dim_type AS (" + _DIM_TYPE + ") SELECT * FROM dim_type",
    "queue_after_retry": CLEAN + f"""
SELECT SourceId, SourceColumn, Classification, CodeGroup, Confidence, Rationale, ModelName,
       TIMESTAMP '{D.QUEUE_NOW.strftime("%Y-%m-%d %H:%M:%S")}' AS ProposedAt
FROM prop_raw
WHERE (event_id // 16) % 7 <> 6 AND Classification IN (SELECT Classification FROM mx WHERE IsActive)
  AND CodeGroup IN (SELECT CodeGroup FROM mx WHERE IsActive)""",
}
