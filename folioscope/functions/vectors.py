"""Vector arithmetic in double precision on float arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, b_norm: Column | None = None) -> Column:
    """Cosine similarity; NULL for a zero vector or vectors of different size.

    Pass ``b_norm`` where it is known. Each product is named once, as array functions are not
    shared between the places that name them.
    """
    length = norm(a) * (norm(b) if b_norm is None else b_norm)
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), length))
