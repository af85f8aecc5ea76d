"""The registered queries: every operator run over the given tables, with the SQL it must equal."""

from dimsmith.plans.catalog import (  # noqa: F401
    aggregates,
    dimensions,
    facts,
    feeds,
    relational,
    scalars,
    storage,
    views,
    windows,
)
from dimsmith.plans.catalog.registry import oracles, registered

__all__ = ["oracles", "registered"]
