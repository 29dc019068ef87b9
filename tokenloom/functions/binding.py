"""Evaluate an expression once and use it inside lambdas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column named inside a lambda is replaced by its defining expression when projections are
    merged, and would then be computed again for every array element. A lambda variable is not.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def let_all(body: Callable[..., Column], **values: Column) -> Column:
    """Like :func:`let` for several named values."""
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    return let(packed, lambda s: body(**{n: s[n] for n in values}))
