"""What the vector operators share: whole-number components, and numpy views of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this every product sum of whole numbers is exact in doubles.
EXACT = float(1 << 53)
# Components beyond this are refused, as sums of their products would not fit in a long.
LARGEST = 1 << 27


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none of them null, NaN or infinite; never null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """Every component as ``floor(scale * x)``, with x as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def largest(df: DataFrame, vector_col: str) -> int:
    """The largest absolute component of a table of whole-number vectors."""
    size = F.max(F.greatest(F.array_max(vector_col), -F.array_min(vector_col)))
    found = df.agg(size.alias("m")).first()["m"] or 0
    if found > LARGEST:
        raise ValueError(f"a scaled component of {found} is beyond {LARGEST}")
    return found


def number_type(size: int, dims: int) -> type:
    """Doubles where every sum of products stays exact in them, else 64-bit integers."""
    return np.float64 if 4.0 * dims * (size + 1.0) ** 2 < EXACT else np.int64


def matrix(column: pa.Array, dims: int, kind: type = np.int64) -> np.ndarray:
    """A list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(kind)
