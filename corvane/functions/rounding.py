"""Rounding as Python does it (half to even on the binary value), where parity with Python is asked for."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def py_round(x: Column, digits: int) -> Column:
    @F.pandas_udf("double")
    def rounded(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if pd.isna(v) else round(float(v), digits))

    return rounded(x)
