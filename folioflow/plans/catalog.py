"""All registered queries."""

from folioflow.plans import aggregate_queries, landing_queries, scalar_queries  # noqa: F401
from folioflow.plans.landing_queries import vectorize_traces as flagship  # noqa: F401
from folioflow.plans.registry import ORACLES, QUERIES  # noqa: F401
