"""Source tables: the ``Sources`` mapping, catalog loaders and test fixtures."""

from .catalog import Sources, load_table_sources
from .fixtures import load_fixture_sources

__all__ = ["Sources", "load_table_sources", "load_fixture_sources"]
