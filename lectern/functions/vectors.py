"""Vector expressions on ``array<float|double>`` columns.

Whole Arrow batches go through NumPy: element-wise lambdas would be interpreted per
element on the JVM side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def l2_norm(vector) -> Column:
    return F.sqrt(F.aggregate(_col(vector), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def rows_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Non-null, equally long list rows as a float64 matrix, without a Python loop."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = len(column) - column.null_count
    if filled == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(filled, -1)


def list_rows(matrix: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Matrix rows as lists; a row of ``valid`` without a matrix row is null."""
    if not valid.any():
        return pa.nulls(len(valid), pa.list_(pa.float64()))
    width = matrix.shape[1]
    offsets = np.r_[0, np.cumsum(valid)].astype(np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()), mask=pa.array(~valid))


def unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows at unit length, which rows have one): zero and infinite rows do not."""
    with np.errstate(all="ignore"):
        norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
        usable = np.isfinite(norms) & (norms > 0)
        return matrix / np.where(usable, norms, 1.0)[:, None], usable


@F.arrow_udf(ArrayType(DoubleType()))
def _unit(vector: pa.Array) -> pa.Array:
    valid = vector.is_valid().to_numpy(zero_copy_only=False)
    units, usable = unit_rows(rows_of(vector)) if valid.any() else (np.zeros((0, 0)), np.zeros(0, bool))
    valid[valid] = usable
    return list_rows(units[usable], valid)


def l2_normalize(vector) -> Column:
    """Unit vector; null for a zero, infinite or missing vector."""
    return _unit(_col(vector))


def concat_scaled(left, left_scale: float, right, right_scale: float) -> Column:
    """L2 of [a * left ; b * right], both sides brought to unit length first.

    A zero side stays zero; a missing side gives null.
    """

    @F.arrow_udf(ArrayType(DoubleType()))
    def joined(a: pa.Array, b: pa.Array) -> pa.Array:
        both = pc.and_(a.is_valid(), b.is_valid())
        valid = both.to_numpy(zero_copy_only=False)
        if not valid.any():
            return pa.nulls(len(valid), pa.list_(pa.float64()))
        sides = []
        for column, scale in ((a, left_scale), (b, right_scale)):
            units, usable = unit_rows(rows_of(column.filter(both)))
            sides.append(np.where(usable[:, None], units, 0.0) * scale)
        whole = np.hstack(sides)
        units, usable = unit_rows(whole)
        return list_rows(np.where(usable[:, None], units, 0.0), valid)

    return joined(_col(left), _col(right))


@F.arrow_udf(DoubleType())
def dot(left: pa.Array, right: pa.Array) -> pa.Array:
    """Row-wise dot product of two vector columns of equal length; null where one is missing."""
    both = pc.and_(left.is_valid(), right.is_valid())
    valid = both.to_numpy(zero_copy_only=False)
    out = np.zeros(len(valid))
    if valid.any():
        out[valid] = np.einsum("ij,ij->i", rows_of(left.filter(both)), rows_of(right.filter(both)))
    return pa.array(out, mask=~valid)
