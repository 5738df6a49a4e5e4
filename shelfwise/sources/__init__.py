"""Inputs and state: domain table readers, the state store, the test mapping."""

from shelfwise.sources.tables import Tables, read_tables  # noqa: F401
