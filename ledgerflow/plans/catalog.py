"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from ledgerflow.plans import (agg_queries, io_queries, model_queries, profile_queries, quality_queries,  # noqa: F401
                             series_queries, window_queries)
from ledgerflow.plans.registry import CHECK, ORACLE, QUERIES  # noqa: F401
from ledgerflow.session import prepare  # noqa: F401
