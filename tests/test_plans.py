"""Plan properties that matter at scale, checked on the executed plans."""

import re

from metamart.operators import keys, meta
from metamart.plans import binding as B, catalog
from tests.conftest import SF0001


def executed(df):
    """Run the frame's own plan and return the final adaptive plan."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_no_cartesian_or_nested_loop_joins(spark):
    catalog.loaded(spark, SF0001)
    bad = {}
    for name, q in catalog.QUERIES.items():
        plan = executed(q(spark, SF0001))
        hits = re.findall(r"\b(CartesianProduct|BroadcastNestedLoopJoin)\b", plan)
        if hits:
            bad[name] = hits
    assert bad == {}


def test_year_filtered_measure_reads_fact_once_with_pruning(spark):
    plan = executed(catalog.QUERIES["yoy_by_plant"](spark, SF0001))
    assert "isFinalPlan=true" in plan
    fact_scans = [line for line in plan.split("\n") if "FileScan" in line and "Incidents" in line]
    assert len(fact_scans) == 1
    assert "dynamicpruningexpression" in fact_scans[0]
    assert "SortMergeJoin" not in plan


def _bracket_groups(text: str) -> list[str]:
    groups, depth, start = [], 0, None
    for i, ch in enumerate(text):
        if ch == "[":
            if depth == 0:
                start = i
            depth += 1
        elif ch == "]":
            depth -= 1
            if depth == 0:
                groups.append(text[start + 1:i])
    return groups


def unpartitioned_windows(plan: str) -> list[str]:
    """Order specs of Window nodes without PARTITION BY.  The node prints
    [expressions], [partition keys]?, [order]?; a second group holding
    ASC/DESC entries is an order with no partition keys."""
    out = []
    for line in plan.split("\n"):
        i = line.find("Window [")
        if i >= 0:
            g = _bracket_groups(line[i + len("Window "):])
            if len(g) == 2 and re.search(r"\b(ASC|DESC)\b", g[1]):
                out.append(g[1])
    return out


def test_sources_share_one_lineitem_scan(spark):
    plan = executed(catalog.QUERIES["bronze_unpivot"](spark, SF0001))
    assert plan.count("ReusedExchange") >= 2


def test_windows_only_over_bounded_frames(spark, monkeypatch):
    # a window without PARTITION BY moves its rows to one task: allowed only
    # over the sizes of the ranges of dense_keys (one row per range) and
    # over the incident types (bounded by the mapping metadata)
    monkeypatch.setattr(keys, "RANGE_ROWS", 5)      # several ranges at this size
    catalog.loaded(spark, SF0001)
    seen = set()
    for name, q in catalog.QUERIES.items():
        for order in unpartitioned_windows(executed(q(spark, SF0001))):
            assert "_part" in order or "Classification" in order, (name, order[:120])
            seen.add("_part" if "_part" in order else "types")
    assert "_part" in seen        # the parser does see the dense-key offsets


def test_slicers_read_the_fact_once(spark):
    plan = executed(catalog.QUERIES["slicer_options"](spark, SF0001))
    assert len([line for line in plan.split("\n") if "FileScan" in line and "Incidents" in line or "IncidentTypeKey" in line and "FileScan" in line
                and "PlantKey" in line]) == 1


def test_validation_reads_bronze_for_the_uniqueness_rule_only(spark):
    def scans(name):
        return [line for line in executed(catalog.QUERIES[name](spark, SF0001)).split("\n") if "FileScan" in line]

    assert scans("null_counts") and all("bad_Plant" in line for line in scans("null_counts"))     # the kept profile
    assert all("n#" in line and "Plant#" not in line for line in scans("row_counts"))
    assert len([line for line in scans("validation_log") if "bad_Plant" not in line]) <= 2         # the rule's two phases


def test_the_queue_is_read_once(spark):
    """Approval: one scan of the events before the key step, none after it."""
    mx = B.mapping_with_extras(spark)
    before = executed(meta.approvable(catalog._queue(spark, SF0001), mx))
    assert before.count("FileScan parquet") == 1
    assert "FileScan" not in executed(catalog.QUERIES["approve_proposals"](spark, SF0001))
