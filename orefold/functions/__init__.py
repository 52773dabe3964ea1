"""Column expressions; none of them needs a Python UDF."""

from .derive import band, flag, safe_ratio, weighted_blend
from .numeric import round_mean, round_value
from .text import normalized, unmasked

__all__ = [
    "band",
    "flag",
    "normalized",
    "round_mean",
    "round_value",
    "safe_ratio",
    "unmasked",
    "weighted_blend",
]
