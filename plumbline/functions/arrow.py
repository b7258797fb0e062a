"""Vectorised functions declared at module level: the UDF is built when it is applied, as types are parsed by the session."""

from __future__ import annotations

from pyspark.sql import functions as F


def vectorized(kind: str):
    """Decorates a function over pandas Series; calling it with Columns gives a Column of the type."""

    def wrap(f):
        def apply(*columns):
            return F.pandas_udf(f, kind)(*columns)

        apply.__doc__, apply.__name__ = f.__doc__, f.__name__
        return apply

    return wrap
