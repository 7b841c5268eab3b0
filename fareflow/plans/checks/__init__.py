"""Every operator run on the driver's tables, next to the SQL that must agree.

Each module registers Spark queries with :func:`registry.query`; ``sql`` is an
independent statement of the same result.
"""

from . import (  # noqa: F401
    calendar,
    encoding,
    enrichment,
    forecasts,
    labelling,
    lifecycle,
    models,
    price_ranges,
    readers,
    rows,
)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
