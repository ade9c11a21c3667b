"""Vector arithmetic on ``array<float>`` columns, folded in double precision."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, words


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    diff = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diff, F.lit(0.0), lambda acc, d: acc + d * d)


def has_non_zero(vec: Column) -> Column:
    return F.exists(vec, lambda x: x != 0)


def token_buckets(text: Column, dim: int) -> Column:
    """One bucket per word: seven hex digits of its MD5, modulo ``dim``."""
    return F.transform(
        words(F.lower(text)), lambda w: (F.conv(F.left(F.md5(w), F.lit(7)), 16, 10).cast("int") % dim)
    )


def bucket_counts(buckets: Column, dim: int) -> Column:
    """How often each of ``0 .. dim-1`` occurs, without a group-by.

    Words get odd numbers and an even marker is put before each bucket and at the end. Sorted, the distance between
    two markers is the count of one bucket.
    """
    marked = F.concat(F.transform(buckets, lambda b: b * 2 + 1), F.sequence(F.lit(0), F.lit(2 * dim), F.lit(2)))
    places = F.transform(F.sort_array(marked), lambda x, i: F.when(x % 2 == 0, i))
    markers = F.filter(places, lambda i: i.isNotNull())
    return let(markers, lambda m: F.zip_with(F.slice(m, 1, dim), F.slice(m, 2, dim), lambda lo, hi: hi - lo - 1))


def unit_norm(values: Column) -> Column:
    """Scale to length one; a zero vector stays zero."""
    doubles = F.transform(values, lambda x: x.cast("double"))

    def scale(v: Column) -> Column:
        length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return let(length, lambda n: F.transform(v, lambda x: F.coalesce(F.try_divide(x, n), F.lit(0.0)).cast("float")))

    return let(doubles, scale)


def hashed_embedding(text: Column, dim: int) -> Column:
    """Hashed bag of words of unit length. Text without words gives the zero vector."""
    return unit_norm(bucket_counts(token_buckets(text, dim), dim))
