"""rowproof: check a delivered table against a reference table by key, on Spark."""

from rowproof.plans.compare import Comparison, compare
from rowproof.spec import CompareSpec, MissingKeys

__all__ = ["Comparison", "CompareSpec", "MissingKeys", "compare"]
