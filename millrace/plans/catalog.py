"""Every query of the package and its SQL counterpart."""

from millrace.plans import (  # noqa: F401
    aggregates, features, forecast, models, relational, scalars, sources, streaming, text, windows,
)
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
