"""Latest version per key (AGG-5); ``keyed`` stores a table that is read by it (SNK-5).

A keyed table that receives repeated versions of a row keeps, per key, the
row with the highest version; ties go to the row inserted last, so an
explicit insertion sequence is part of the ordering. ``max_by`` over a
struct is an ordinary aggregate: it combines partially before the shuffle,
so a key with a huge number of versions never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest ``version`` tuple."""
    rest = [c for c in df.columns if c not in key]
    q = lambda c: "`" + c.replace("`", "``") + "`"
    packed = df.groupBy(*key).agg(F.expr(
        f"max_by(struct({', '.join(q(c) for c in rest)}), struct({', '.join(q(c) for c in version)}))"
    ).alias("_latest"))
    return packed.selectExpr(*[q(c) for c in key], *[f"_latest.{q(c)} AS {q(c)}" for c in rest])
