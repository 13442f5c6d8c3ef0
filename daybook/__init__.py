"""Daily commerce profit-and-loss on Spark.

Raw order and ad-spend exports go in; a gap-free daily table of revenue, spend,
estimated cost, contribution margin and ratios comes out. Everything between is
DataFrame code that Catalyst plans; nothing runs row by row in Python.
"""

from daybook.errors import CurrencyError, DataQualityError, DaybookError, ParamError, SchemaError
from daybook.params import Params

__all__ = [
    "CurrencyError",
    "DataQualityError",
    "DaybookError",
    "ParamError",
    "Params",
    "SchemaError",
]
