"""Role-table readers and the demo mapping onto the public test tables."""

from covtab.sources.demo import DEMO_ASOF, demo_inputs
from covtab.sources.tables import SCHEMAS, conform, load, read_inputs, read_role

__all__ = ["DEMO_ASOF", "demo_inputs", "SCHEMAS", "conform", "load", "read_inputs", "read_role"]
