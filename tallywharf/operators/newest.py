"""One row per key out of many versions."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def first_row(rows, keys, order):
    """Per key the first row in ``order``.

    Spark turns the rank filter into a group limit that also runs before the shuffle, so each task sends at most one
    row per key, and a key that owns a large part of the input stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_by_key(rows, keys, version):
    """Per key the row with the greatest ``version`` columns, ties settled by the remaining columns."""
    rest = [c for c in rows.columns if c not in keys and c not in version]
    return first_row(rows, keys, [F.desc(c) for c in [*version, *rest]])


def newest_version_rows(rows, keys, version):
    """All rows that carry the greatest ``version`` of their key (a key may own several rows per version)."""
    top = rows.groupBy(*keys).agg(F.max(version).alias("_top"))
    same = F.col(f"r.{version}") == F.col("t._top")
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"t.{key}"))
    return rows.alias("r").join(top.alias("t"), same, "left_semi")
