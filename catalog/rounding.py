"""Both sides of a comparison rounded alike, where summation order may change the last bit."""

from __future__ import annotations

from pyspark.sql import functions as F


def near(query, sql: str | None, *columns: str, digits: int = 8):
    """The pair (query, sql) with the named columns rounded; without names, all doubles of the query."""

    def rounded(spark, folder):
        df = query(spark, folder)
        names = columns or [c for c, t in df.dtypes if t == "double"]
        return df.withColumns({c: F.round(c, digits) for c in names})

    if sql is None:
        return rounded, None
    fixes = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)
    return rounded, f"SELECT * REPLACE ({fixes}) FROM ({sql})"
