"""Arrow-batched wrappers for text rules that recurse or rewrite inside a match."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from paperloom.session import ship_package


def text_udf(rule: Callable[[str], object], returns: str = "string") -> Callable[[Column], Column]:
    """A vectorised column function of one string column; null stays null.

    The function is registered when it is first applied, since that needs a session.
    """

    def on_column(col: Column) -> Column:
        if (spark := SparkSession.getActiveSession()) is not None:
            ship_package(spark)

        @F.pandas_udf(returns)
        def apply(values: pd.Series) -> pd.Series:
            return values.map(lambda v: None if v is None or v != v else rule(v))

        return apply(col)

    return on_column


def rule_udf(rule: Callable, returns: str) -> Callable[..., Column]:
    """A vectorised column function of several columns, each row's values given to ``rule``; nulls come as None."""

    def on_columns(*cols: Column) -> Column:
        if (spark := SparkSession.getActiveSession()) is not None:
            ship_package(spark)

        @F.pandas_udf(returns)
        def apply(*values: pd.Series) -> pd.Series:
            return pd.Series([rule(*row) for row in zip(*values)], dtype=object)

        return apply(*cols)

    return on_columns
