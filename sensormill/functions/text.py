"""Number formatting for reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def format_number(value: Column, spec: str, suffix: str = "") -> Column:
    """Format doubles such as ``+.2f`` or ``.6%``, rounding the exact binary value; NULL stays NULL.

    ``format_string`` rounds the shortest decimal text instead, which differs on apparent ties. Reports hold one row
    per log or sensor, so this runs on aggregated rows only.
    """

    @F.pandas_udf(T.StringType())
    def render(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda x: None if pd.isna(x) else format(x, spec) + suffix)

    return render(value)
