"""Metadata-driven bronze and silver tables on Spark."""

from .functions.rules import Rules
from .operators.cdc import ChangeSpec, apply_changes
from .operators.snapshot import SnapshotSpec
from .plans.onboard import onboard
from .sources import register_source
from .streaming.flows import Flow, run_flow, run_flows
from .streaming.pipeline import Pipeline, run
from .streaming.tables import Target

__all__ = [
    "ChangeSpec",
    "Flow",
    "Pipeline",
    "Rules",
    "SnapshotSpec",
    "Target",
    "apply_changes",
    "onboard",
    "register_source",
    "run",
    "run_flow",
    "run_flows",
]
