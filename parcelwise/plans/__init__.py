"""Registered queries. Importing the modules fills the catalog."""

from parcelwise.plans import (  # noqa: F401
    aggregates,
    features,
    flagship,
    modeling,
    quality,
    scans,
    solvable,
    streams,
)
from parcelwise.plans.catalog import QUERIES, SQL  # noqa: F401
