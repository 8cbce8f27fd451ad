"""Persistent tables -> Consumption tables by SQL."""

from __future__ import annotations

from typing import TYPE_CHECKING

from oreflow.contracts import ConsumptionSpec, Contract
from oreflow.plans.lake import Lake

if TYPE_CHECKING:
    from oreflow.plans.pipeline import Context


def publish_sources(lake: Lake, contract: Contract, context: Context) -> None:
    """Persistent tables (and their quarantines) as ``source.<table>``."""
    tables = [name for spec in contract.persistent for name in (spec.target_table, spec.rejects_table)]
    lake.publish(context.source_database, "persistent", *tables)


def refresh(lake: Lake, item: ConsumptionSpec, contract: Contract, context: Context) -> None:
    """Run one consumption item.

    ``mapping`` is a query whose result replaces the table; ``sql`` and
    ``query_file`` are statements run with the Consumption database current.
    """
    publish_sources(lake, contract, context)
    database = context.consumption_database
    lake.create_database(database)
    if item.mapping:
        result = lake.spark.sql(_statement(item.mapping))
        commit = lake.write_snapshot("consumption", item.table, context.run_id, result)
        lake.record([commit])
        lake.publish(database, "consumption", item.table)
        return
    text = item.sql
    if item.query_file:
        text = read_text(lake, item.query_file)
    previous = lake.spark.catalog.currentDatabase()
    lake.spark.catalog.setCurrentDatabase(database)
    try:
        run_statements(lake, text)
    finally:
        lake.spark.catalog.setCurrentDatabase(previous)


def read_text(lake: Lake, path: str) -> str:
    """A SQL file, from any file system Spark reads."""
    return lake.spark.read.text(path, wholetext=True).first()["value"]


def run_statements(lake: Lake, text: str) -> None:
    """One statement, or several as a Spark SQL script."""
    body = _statement(text)
    if ";" in body:
        body = f"BEGIN\n{body}\n;\nEND"
    lake.spark.sql(body)


def _statement(text: str) -> str:
    return text.strip().rstrip(";").rstrip()
