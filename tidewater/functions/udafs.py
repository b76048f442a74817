"""Pandas (Arrow-batched) aggregates usable as ``hourly_2_daily(agg=...)``.

Kept in a module without postponed annotations: pandas UDF type inference
reads the real ``pd.Series`` hints.
"""

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


# a type object, not a DDL string: defining the UDF needs no running JVM
@pandas_udf(DoubleType())
def spread(v: pd.Series) -> float:
    """Range of the values of a group (max - min)."""
    return float(v.max() - v.min())
