"""Contract-driven landing -> raw -> persistent -> consumption pipelines on Spark."""

from oreflow.contracts import Contract, load_contract, parse_contract
from oreflow.plans.pipeline import (
    Context,
    Pipeline,
    Step,
    landing_to_raw,
    persistent_to_consumption,
    raw_to_persistent,
    read_steps,
    run_pipeline,
    run_steps,
)

__all__ = [
    "Context",
    "Contract",
    "Pipeline",
    "Step",
    "landing_to_raw",
    "load_contract",
    "parse_contract",
    "persistent_to_consumption",
    "raw_to_persistent",
    "read_steps",
    "run_pipeline",
    "run_steps",
]
