"""Imports every module that registers queries."""

from buyerlens.registry import data, features, fits, flows, gate_runs, models  # noqa: F401
