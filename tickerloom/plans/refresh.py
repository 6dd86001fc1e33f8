"""The scheduled jobs, from input folders to output folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tickerloom.functions.timeline import at
from tickerloom.operators.collector import fetch_plan
from tickerloom.operators.membership import latest_company, new_members, previous_members
from tickerloom.plans.publish import publish_report
from tickerloom.schemas import SNAPSHOT
from tickerloom.settings import AnalysisSettings
from tickerloom.sources.curated import curate
from tickerloom.sources.delimited import read_snapshots, read_tape
from tickerloom.sources.documents import write_worklist
from tickerloom.sources.ledger import read_current
from tickerloom.sources.routing import ACCEPTED, read_route, route, write_routed
from tickerloom.sources.workspace import materialise, shared_folder
from tickerloom.streaming.curate import start_curation


def membership_job(spark: SparkSession, snapshot_folder: str, worklist_path: str,
                   run_time: datetime, source_file: str) -> DataFrame:
    """Compare the last two snapshots until `run_time`, write the worklist, return the
    fetch plan. A run repeated later, with more snapshots there, does the same."""
    snapshots = read_snapshots(spark, snapshot_folder)
    new = materialise(new_members(snapshots, run_time), shared_folder(spark, "new-members"))
    old = materialise(previous_members(snapshots, run_time),
                      shared_folder(spark, "previous-members"))
    write_worklist(new, old, worklist_path)
    return fetch_plan(new, old, run_time, source_file)


def analysis_job(spark: SparkSession, tape_folder: str, snapshot_folder: str,
                 routed_folder: str, curated_folder: str, document_path: str,
                 settings: AnalysisSettings, run_time: datetime) -> DataFrame:
    """Route raw price files, curate the good rows, publish the document.

    Every run reads all of `tape_folder` and replaces what an earlier run wrote. Refused
    rows stay in `routed_folder` with their reason. Companies are those known at
    `settings.as_of`. Returns the report table.
    """
    write_routed(route(read_tape(spark, tape_folder)), routed_folder, "overwrite")
    tape = curate(read_route(spark, routed_folder, ACCEPTED), curated_folder, "overwrite")
    companies = latest_company(read_snapshots(spark, snapshot_folder), as_of=settings.as_of)
    stamp = at(run_time, SNAPSHOT["updated_at"].dataType)
    return publish_report(tape, companies, settings, document_path, stamp)


def incremental_job(spark: SparkSession, tape_folder: str, snapshot_folder: str,
                    routed_folder: str, curated_folder: str, checkpoint: str,
                    document_path: str, settings: AnalysisSettings,
                    run_time: datetime) -> DataFrame:
    """As `analysis_job`, but reads only price files that are new since the last run and
    adds their rows to the ledger at `curated_folder`. Returns the report table."""
    start_curation(spark, tape_folder, routed_folder, curated_folder,
                   checkpoint).awaitTermination()
    companies = latest_company(read_snapshots(spark, snapshot_folder), as_of=settings.as_of)
    stamp = at(run_time, SNAPSHOT["updated_at"].dataType)
    return publish_report(read_current(spark, curated_folder), companies, settings,
                          document_path, stamp)
