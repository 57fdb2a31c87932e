"""Integers beside nulls, carried exactly through pandas batches.

pandas gives an integer column with a null as floats, which lose digits beyond 2^53.  Integral columns
are therefore sent as two columns without nulls, the value (0 for a null) and a flag, and joined to
a nullable integer array in the processor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

_FLAG = "rv_set_"  # Spark renames columns that begin with an underscore on their way to pandas


def integral(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, IntegralType)]


def split(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns, integral ones as value and flag."""
    whole = integral(df, columns)
    out = [F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in whole else F.col(c) for c in columns]
    return out + [F.col(c).isNotNull().alias(_FLAG + c) for c in whole]


def joined(batch, columns: Sequence[str], whole: Sequence[str]):
    """A pandas frame of ``columns``: objects, integral columns as nullable integers."""
    import numpy as np
    import pandas as pd

    out = batch[list(columns)].astype(object)
    for c in whole:
        values = batch[c].to_numpy(dtype=np.int64)
        out[c] = pd.array(pd.arrays.IntegerArray(values, ~batch[_FLAG + c].to_numpy(dtype=bool)))
    return out
