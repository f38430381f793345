"""Every operator bound to the test tables, with DuckDB SQL for comparison."""

from statlake.bindings import articles, chain, core, models, registry, stats  # noqa: F401
from statlake.bindings.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
