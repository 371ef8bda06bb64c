"""Functions on `array<double>` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column, floor: float = NORM_FLOOR) -> Column:
    """Divide by the norm, which is taken as at least `floor`; a zero vector stays zero."""
    unit = F.struct(vector.alias("v"), F.greatest(l2_norm(vector), F.lit(floor)).alias("n"))
    # The one-element array binds the norm once, instead of once per component.
    return F.element_at(
        F.transform(F.array(unit), lambda u: F.transform(u["v"], lambda x: x / u["n"])), 1
    )


def first_nan_index(vector: Column) -> Column:
    """Zero-based index of the first NaN, -1 when there is none."""
    return (F.array_position(vector, F.lit(float("nan")).cast("double")) - 1).cast("int")
