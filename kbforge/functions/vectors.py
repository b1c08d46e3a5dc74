"""Vector arithmetic as column expressions, in double. Null vectors give null; a zero vector has no cosine (null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT_8BIT, LIMIT_4BIT = 0.3, 0.18
#: Dimensions to which a vector may be cut.
MRL_DIMS, MRL_DEFAULT = (128, 256), 128


def _double(x: Column) -> Column:
    return x.cast("double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: _double(x) * _double(y)), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + _double(x) * _double(x)))


def cosine(a: Column, b: Column) -> Column:
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, in 0..2."""
    return F.lit(1.0) - cosine(a, b)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(_double(x) - _double(y), 2)), F.lit(0.0), lambda s, x: s + x))


def distance_similarity(distance: Column) -> Column:
    """(2 - distance) / 2."""
    return (F.lit(2.0) - distance) / 2


def inverse_similarity(distance: Column) -> Column:
    """1 / (1 + distance)."""
    return F.lit(1.0) / (F.lit(1.0) + distance)


def normalise(v: Column, eps: float = 1e-12) -> Column:
    """Unit length; a vector shorter than ``eps`` is divided by ``eps``. The norm is computed once per row."""
    size = F.greatest(norm(v), F.lit(eps))
    return F.element_at(F.transform(F.array(F.struct(v.alias("v"), size.alias("s"))), lambda p: F.transform(p["v"], lambda x: _double(x) / p["s"])), 1)


def mrl(v: Column, dims: int | None) -> Column:
    """The first ``dims`` elements, at unit length. None leaves the vector as it is; other sizes mean the default."""
    if dims is None:
        return v
    return normalise(F.slice(v, 1, dims if dims in MRL_DIMS else MRL_DEFAULT))


def _codes(v: Column, limit: float, top: int) -> Column:
    width = 2 * limit / top
    return F.transform(v, lambda x: F.rint(F.greatest(F.lit(0.0), F.least(F.lit(2 * limit), _double(x) + limit)) / width).cast("int"))


def quantise8(v: Column, limit: float = LIMIT_8BIT) -> Column:
    """Codes 0..255 over -limit..limit, halves to even."""
    return _codes(v, limit, 255)


def quantise4(v: Column, limit: float = LIMIT_4BIT) -> Column:
    """Codes 0..15 packed in pairs, the earlier element in the high half. An odd number of elements is an error."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(v).cast("int"), F.lit(2)), lambda i: i)
    codes = _codes(v, limit, 15)
    packed = F.element_at(F.transform(F.array(F.struct(codes.alias("c"), pairs.alias("p"))), lambda s: F.transform(s["p"], lambda i: F.shiftleft(F.element_at(s["c"], i), 4).bitwiseOR(F.element_at(s["c"], i + 1)))), 1)
    even = F.when(F.size(v) % 2 == 0, packed).otherwise(F.raise_error(F.lit("an even number of elements is needed")).cast("array<int>"))
    return F.when(v.isNotNull(), F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(even))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)
