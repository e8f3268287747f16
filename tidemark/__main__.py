"""Run a subject from a JSON settings file.

    python -m tidemark leadtime settings.json
    python -m tidemark items settings.json

Settings: ``lake`` (root path); for lead time ``fetch`` (list of {folder, keyword}),
``phases`` (CSV path) and optionally ``skipped`` (table names); for items ``company``,
``export_folders`` and either ``erp_parquet`` (root path) or ``erp_jdbc`` (fields of
:class:`tidemark.sources.erp.JdbcErp`; the password may come from the ERP_PASSWORD
environment variable).
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from tidemark.plans.items import item_reports, run_item_master
from tidemark.plans.leadtime import SILVER, FetchTask, included_sources, run_leadtime, silver_reports
from tidemark.session import build_session
from tidemark.sources.erp import JdbcErp, ParquetErp
from tidemark.sources.lake import Lake


def erp_source(settings: dict) -> ParquetErp | JdbcErp:
    if "erp_parquet" in settings:
        return ParquetErp(settings["erp_parquet"])
    fields = dict(settings["erp_jdbc"])
    fields.setdefault("password", os.environ.get("ERP_PASSWORD", ""))
    return JdbcErp(**fields)


def show(reports: dict[str, DataFrame]) -> None:
    for name, report in reports.items():
        print(f"\n{name}")
        report.show(100, truncate=False)


def main(arguments: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("subject", choices=["leadtime", "items"])
    parser.add_argument("settings")
    chosen = parser.parse_args(arguments)
    with open(chosen.settings, encoding="utf-8") as stream:
        settings = json.load(stream)

    lake = Lake(build_session(), settings["lake"])
    run_ts = datetime.now(timezone.utc)
    if chosen.subject == "leadtime":
        tasks = [FetchTask(**task) for task in settings["fetch"]]
        skipped = settings.get("skipped", [])
        counts = run_leadtime(lake, tasks, settings["phases"], run_ts, skipped)
        reports = {"sources": included_sources(lake, skipped)}
        show(reports | silver_reports(lake.read("silver", SILVER)))
    else:
        folders = settings.get("export_folders", [])
        counts = run_item_master(lake, erp_source(settings), settings["company"], run_ts, folders)
        show(item_reports(lake))
    for table, rows in counts.items():
        print(f"{table}: {rows:,} rows")
    return counts


if __name__ == "__main__":
    main()
