"""Column expressions and fixed parameters."""

from fundtrail.functions import columns, params

__all__ = ["columns", "params"]
