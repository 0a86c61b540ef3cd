"""Small Column helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_string(s: str) -> str:
    """A Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: dict[str, str]) -> Column:
    """A literal ``map<string,string>``, built from one SQL expression (one
    call to the JVM instead of two per entry); Catalyst folds it to a
    constant."""
    if not mapping:
        return F.expr("map()").cast("map<string,string>")
    return F.expr("map(" + ", ".join(f"{sql_string(k)}, {sql_string(v)}" for k, v in mapping.items()) + ")")


def fail_with(message: Column) -> Column:
    """``raise_error`` typed as string so it composes in when/otherwise."""
    return F.raise_error(message).cast("string")
