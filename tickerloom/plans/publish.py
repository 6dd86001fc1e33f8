"""Write the report as the published document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tickerloom.operators.benchmarks import benchmark_rates
from tickerloom.plans.report import company_report
from tickerloom.settings import AnalysisSettings
from tickerloom.sources.documents import publish_document
from tickerloom.sources.workspace import materialise, shared_folder


def publish_report(tape: DataFrame, companies: DataFrame, settings: AnalysisSettings,
                   path: str, updated_at: Column, keep_nulls: bool = False) -> DataFrame:
    """Store the report as a table, publish the document at `path`, return the table.

    Sorting the document's lines reads their sources more than once, hence the stored
    report and rates.
    """
    spark = tape.sparkSession
    report = materialise(
        company_report(tape, companies, settings),
        shared_folder(spark, "report"),
    )
    rates = materialise(
        benchmark_rates(
            tape, settings.market, settings.risk_free, settings.as_of, settings.growth_days
        ),
        shared_folder(spark, "rates"),
    )
    publish_document(report, rates, path, updated_at, keep_nulls)
    return report
