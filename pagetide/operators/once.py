"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def once(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Add a column that is computed once per row, whatever is filtered above.

    The optimizer pushes filters below projections by repeating the projected
    expression, but never below a generator, and the generated code of one
    operator repeats an expression for each use inside conditions. Naming a
    costly intermediate result this way avoids both.
    """
    return df.selectExpr("*", f"explode(array({sql})) AS {name}")
