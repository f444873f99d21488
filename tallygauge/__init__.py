"""Data-quality metrics over many files and tables, computed in a few shared Spark passes."""

from tallygauge.plans.profile import Profile, profile
from tallygauge.spec import (
    Metric,
    approx_quantile,
    compliance,
    from_parameters,
    on,
    pairs,
    pattern_match,
    size,
)

__all__ = [
    "Metric",
    "Profile",
    "approx_quantile",
    "compliance",
    "from_parameters",
    "on",
    "pairs",
    "pattern_match",
    "profile",
    "size",
]
