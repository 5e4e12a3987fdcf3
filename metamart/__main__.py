"""Command line for spark-submit:  python -m metamart <job> --warehouse ROOT [...]

jobs: init (layers and metadata tables from --tables, a folder of JSON-lines
      files named after them), register (--input: requests), load (scheduled
      load of all active sources), gold (reload gold only), propose (--input:
      model answers), pending (show the review queue), approve (promote
      proposals), activate / deactivate (--sources), change (--input: mapping
      changes)
Inputs are JSON lines with the columns of the job's table.
"""

from __future__ import annotations

import argparse

from metamart.plans import jobs
from metamart.session import get_spark
from metamart.sources.warehouse import META_SCHEMAS, Warehouse

REQUESTS = ("RequestId long, SourceName string, FilePath string, SheetName string, PlantColumn string, "
            "MonthColumn string")
ANSWERS = "SourceId int, ModelName string, RespondedAt timestamp, ResponseText string"
CHANGES = ("MappingId int, Action string, SourceId int, SourceColumn string, Classification string, "
           "CodeGroup string")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="metamart")
    ap.add_argument("job", choices=["init", "register", "load", "gold", "propose", "pending", "approve",
                                    "activate", "deactivate", "change"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--landing", default="")
    ap.add_argument("--tables", default="", help="folder of metadata tables as JSON lines (init)")
    ap.add_argument("--input", default="", help="JSON lines (register, propose, change)")
    ap.add_argument("--sources", default="", help="comma-separated source ids (approve, activate, deactivate)")
    ap.add_argument("--min-confidence", type=float, default=0.90)
    ap.add_argument("--no-gate", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark(app=f"metamart-{a.job}")
    wh = Warehouse(spark, a.warehouse)
    ids = [int(x) for x in a.sources.split(",") if x]

    def rows(schema):
        return spark.read.schema(schema).json(a.input)

    if a.job == "init":
        tables = [spark.read.schema(META_SCHEMAS[t]).json(f"{a.tables}/{t}.jsonl")
                  for t in ("source_registry", "key_column_mapping", "column_mapping", "dq_rules")]
        jobs.init_warehouse(spark, a.warehouse, *tables)
        print(f"warehouse {a.warehouse} initialised")
    elif a.job == "register":
        jobs.register(wh, rows(REQUESTS)).select("RequestId", "Status", "SourceId").show(truncate=False)
    elif a.job == "propose":
        jobs.propose(wh, rows(ANSWERS)).show(truncate=False)
    elif a.job in ("activate", "deactivate"):
        jobs.set_active(wh, ids, a.job == "activate")
        print(f"sources {ids}: {a.job}d")
    elif a.job == "change":
        jobs.change_mappings(wh, rows(CHANGES))
        print("mapping changes applied")
    elif a.job == "load":
        r = jobs.load(wh, a.landing, use_gate=not a.no_gate)
        print(f"sources {list(r.source_ids)} loaded, gold version {r.version}")
    elif a.job == "gold":
        version, _ = jobs.reload_gold(wh)
        print(f"gold version {version}")
    elif a.job == "approve":
        print(f"{jobs.approve(wh, ids or None, a.min_confidence).count()} mappings added")
    else:
        jobs.pending(wh).show(truncate=False)


if __name__ == "__main__":
    main()
