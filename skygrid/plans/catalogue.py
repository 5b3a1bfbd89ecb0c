"""All registered queries."""

from skygrid.plans import (  # noqa: F401
    aggregate_queries,
    feature_queries,
    job_queries,
    model_queries,
    scalar_queries,
    source_queries,
    space_queries,
    stream_queries,
)
from skygrid.plans.registry import QUERIES

__all__ = ["QUERIES"]
