"""Every operator bound to the given tables, next to the SQL that must give the same rows."""

from hourline.catalog.common import REGISTRY
from hourline.catalog import cleaning, drift, intake, learning, series, summaries  # noqa: F401  (fill the registry)

__all__ = ["REGISTRY"]
