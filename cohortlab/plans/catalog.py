"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from cohortlab.plans import (q_audit, q_clean, q_eval, q_features, q_merge, q_models, q_prep,  # noqa: F401
                             q_scoring, q_sources, q_stats)
from cohortlab.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
