"""Checks and shapes that the vector operators share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, not zero, and every component present and finite."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(rows: pd.Series) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in rows])
