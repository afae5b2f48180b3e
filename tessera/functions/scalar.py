"""Scalar column helpers that are not text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(col: Column | str, n: int) -> Column:
    """``int(md5(str(x)), 16) % n`` without 128-bit integers.

    The digest is read as four 32-bit words and folded modulo ``n`` with plain
    long arithmetic (Horner's rule; ``acc < n < 2^31`` so ``acc * 2^32 + w``
    fits in a long), which stays inside whole-stage codegen.
    """
    if not 0 < n < (1 << 31):
        raise ValueError("n must be in [1, 2^31)")
    c = F.col(col) if isinstance(col, str) else col
    h = F.md5(c.cast("string"))
    acc = F.lit(0).cast("long")
    for k in range(4):
        word = F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long")
        acc = (acc * F.lit(1 << 32) + word) % F.lit(n)
    return acc


def pick_by_index(names: list[str], idx: Column) -> Column:
    """Element ``idx`` (0-based) of a literal list."""
    return F.element_at(F.array(*[F.lit(x) for x in names]), (idx + 1).cast("int"))


def clip_affine(col: Column | str, lo: float = 0.0, hi: float = 1.0,
                a: float = 1.0, b: float = 4.0) -> Column:
    """``a + b * clip(x, lo, hi)`` (content score → 1..5 rating)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lit(a) + F.lit(b) * F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def round_half_away(col: Column | str, digits: int) -> Column:
    """Round the binary value half away from zero (``round(x * 10^d) / 10^d``).

    Spark's ``round`` rounds the shortest decimal text of a double HALF_UP, so
    ``2.425`` becomes 2.43 although the double is just below 2.425; this form
    rounds the binary value, as Python and most SQL engines do.
    """
    c = F.col(col) if isinstance(col, str) else col
    k = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(k) + F.lit(0.5)) / F.lit(k)


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row. Catalyst may put a column's expression where the
    column is read, also inside a lambda, where it would be computed for every
    element; a lambda's own variable can't be replaced so."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
