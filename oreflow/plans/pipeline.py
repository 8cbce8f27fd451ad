"""The three layer steps and the ways to run them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from oreflow.contracts import Contract, selected
from oreflow.plans.consumption import refresh
from oreflow.plans.control import utc_now
from oreflow.plans.ingest import land
from oreflow.plans.lake import Lake
from oreflow.plans.refine import load_table

Transform = Callable[[DataFrame, "Context"], DataFrame]


@dataclass
class Context:
    """What one run knows: where data is, who it is, and what day it is."""

    run_id: str
    landing: str
    lake_root: str
    environment: str = "local"
    process_date: str | None = None
    previous_success: datetime | None = None
    quarantine: str | None = None
    source_database: str = "source"
    consumption_database: str = "consumption"
    keep_snapshots: int | None = None
    moment: datetime = field(default_factory=utc_now)
    parameters: Mapping[str, Any] = field(default_factory=dict)
    source_tables: Sequence[str] = ()
    target_tables: Sequence[str] = ()
    values: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # The run id becomes a folder name.
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.run_id):
            raise ValueError(f"run id {self.run_id!r}: use letters, digits, '.', '_' and '-'")
        self.landing = str(self.landing)
        self.lake_root = str(self.lake_root)

    @staticmethod
    def new_run_id() -> str:
        return str(uuid.uuid4())

    @property
    def arrival_date(self) -> str:
        return (self.process_date or self.moment.isoformat())[:10]

    @property
    def quarantine_folder(self) -> str:
        return self.quarantine or f"{self.landing.rstrip('/')}/quarantine"


class Pipeline:
    """A contract, a context and the lake they work on."""

    def __init__(self, spark: SparkSession, contract: Contract, context: Context):
        self.spark = spark
        self.contract = contract
        self.context = context
        self.lake = Lake(spark, context.lake_root)
        self.control = self.lake.control

    @contextmanager
    def processor(self, name: str):
        """Record the start and the end of one step."""
        run_id, started = self.context.run_id, utc_now()
        self.control.processor(run_id, name, "RUNNING", started)
        try:
            yield
        except Exception as error:
            self.control.processor(run_id, name, "FAILED", started, utc_now(), str(error))
            raise
        self.control.processor(run_id, name, "SUCCEEDED", started, utc_now())

    def landing_to_raw(self) -> int:
        run_id = self.context.run_id
        with self.processor("landing_to_raw"):
            counts = land(self.lake, self.contract, self.context)
        nothing = {self.contract.landing.raw_table or "raw": (0, 0)}
        for table, (inserted, rejected) in (counts or nothing).items():
            self.control.rows(run_id, "landing_to_raw", "raw", table, inserted, rejected)
        return sum(inserted for inserted, _ in counts.values())

    def raw_to_persistent(
        self,
        only: Sequence[str] | None = None,
        transforms: Mapping[str, Transform] | None = None,
    ) -> dict[str, tuple[int, int]]:
        counts = {}
        for spec in selected(self.contract.persistent, only, lambda s: s.target_table):
            step = (transforms or {}).get(spec.target_table)
            with self.processor(f"raw_to_persistent:{spec.name}"):
                inserted, rejected = load_table(self.lake, self.contract, spec, self.context, step)
            self.control.rows(
                self.context.run_id,
                "raw_to_persistent",
                "persistent",
                spec.target_table,
                inserted,
                rejected,
            )
            counts[spec.target_table] = (inserted, rejected)
        return counts

    def persistent_to_consumption(self, only: Sequence[str] | None = None) -> list[str]:
        done = []
        for item in selected(self.contract.consumption, only, lambda i: i.name):
            with self.processor(f"persistent_to_consumption:{item.name}"):
                refresh(self.lake, item, self.contract, self.context)
            done.append(item.name)
        return done

    @contextmanager
    def audited_run(self):
        """Record the run as RUNNING, then SUCCEEDED or FAILED."""
        context, started = self.context, utc_now()
        context.process_date = context.process_date or started.isoformat()
        context.previous_success = context.previous_success or self.control.previous_success()
        self.control.run(context.run_id, context.environment, "RUNNING", started)
        try:
            yield
        except Exception as error:
            self.control.run(
                context.run_id, context.environment, "FAILED", started, utc_now(), str(error)
            )
            raise
        self.control.run(context.run_id, context.environment, "SUCCEEDED", started, utc_now())


def landing_to_raw(spark: SparkSession, contract: Contract, context: Context) -> int:
    return Pipeline(spark, contract, context).landing_to_raw()


def raw_to_persistent(
    spark: SparkSession,
    contract: Contract,
    context: Context,
    only: Sequence[str] | None = None,
    transforms: Mapping[str, Transform] | None = None,
) -> dict[str, tuple[int, int]]:
    return Pipeline(spark, contract, context).raw_to_persistent(only, transforms)


def persistent_to_consumption(
    spark: SparkSession, contract: Contract, context: Context, only: Sequence[str] | None = None
) -> list[str]:
    return Pipeline(spark, contract, context).persistent_to_consumption(only)


def run_pipeline(
    spark: SparkSession,
    contract: Contract,
    context: Context,
    transforms: Mapping[str, Transform] | None = None,
) -> Pipeline:
    """All three layers in order, audited as one run."""
    pipeline = Pipeline(spark, contract, context)
    with pipeline.audited_run():
        pipeline.landing_to_raw()
        pipeline.raw_to_persistent(transforms=transforms)
        pipeline.persistent_to_consumption()
    return pipeline


@dataclass(frozen=True)
class Step:
    """One named step of a workflow: a function of the pipeline, with its tables."""

    name: str
    function: Callable[[Pipeline], Any]
    parameters: Mapping[str, Any] = field(default_factory=dict)
    source_tables: Sequence[str] = ()
    target_tables: Sequence[str] = ()
    depends_on: Sequence[str] = ()


# The layer steps a workflow file may name by the last part of their path.
LAYER_STEPS: dict[str, Callable[[Pipeline], Any]] = {
    "landing_to_raw": lambda p: p.landing_to_raw(),
    "raw_to_persistent": lambda p: p.raw_to_persistent(p.context.target_tables),
    "persistent_to_consumption": lambda p: p.persistent_to_consumption(p.context.target_tables),
}


def read_steps(
    path: str | Path, functions: Mapping[str, Callable[[Pipeline], Any]] | None = None
) -> list[Step]:
    """Steps of a workflow YAML, in file order.

    ``functions`` supplies custom steps by name, next to the three layer steps.
    """
    import yaml

    known = {**LAYER_STEPS, **(functions or {})}
    document = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    listed = document.get("data_processors") or document.get("processors") or document.get("steps")
    steps = []
    for item in listed or []:
        name = item.get("processor_name") or item.get("process_name") or item["name"]
        entry = item.get("notebook") or item.get("path") or item.get("processor") or ""
        short = re.split(r"[./:]", entry)[-1]
        function = known.get(entry) or known.get(short)
        if function is None:
            raise ValueError(f"step {name!r}: no function for {entry!r}")
        steps.append(
            Step(
                name=name,
                function=function,
                parameters=item.get("parameters") or {},
                source_tables=tuple(item.get("source_tables") or ()),
                target_tables=tuple(item.get("target_tables") or ()),
                depends_on=tuple(item.get("depends_on") or ()),
            )
        )
    return steps


def run_steps(
    spark: SparkSession, contract: Contract, context: Context, steps: Sequence[Step]
) -> Pipeline:
    """Run steps in the given order, audited as one run.

    A step must come after the steps it depends on.
    """
    done: set[str] = set()
    for step in steps:
        late = [name for name in step.depends_on if name not in done]
        if late:
            raise ValueError(f"step {step.name!r} comes before or without {late}")
        done.add(step.name)
    pipeline = Pipeline(spark, contract, context)
    with pipeline.audited_run():
        for step in steps:
            context.parameters = {"processor_name": step.name, **step.parameters}
            context.source_tables = step.source_tables
            context.target_tables = step.target_tables
            with pipeline.processor(step.name):
                step.function(pipeline)
    return pipeline
