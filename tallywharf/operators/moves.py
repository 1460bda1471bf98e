"""Rows that may change the day they are kept under.

A table that is read by day must hold a key under one day only.  When a version with another day takes over, a row marked
``gone`` is written under the old day, so reading a single day stays exact.
"""

from pyspark.sql import functions as F

GONE = "gone"


def relocated(rows, live, key, day, takes_over):
    """What to write for ``rows``, one for each key: those that take over, and a row marked gone for each day left.

    ``live`` holds what is stored for these keys now, one row each.  ``takes_over`` is a condition on the columns of a
    row (``r``) and of what is stored for its key (``s``).
    """
    new = F.col(f"s.{key}").isNull()
    met = rows.alias("r").join(live.alias("s"), F.col(f"r.{key}") == F.col(f"s.{key}"), "left").where(new | takes_over)

    def place(column, gone):
        return F.struct(F.col(column).alias("day"), F.lit(gone).alias("gone"))

    here, there = place(f"r.{day}", False), place(f"s.{day}", True)
    moved = F.coalesce(F.col(f"s.{day}") != F.col(f"r.{day}"), F.lit(False))
    places = F.explode(F.when(moved, F.array(here, there)).otherwise(F.array(here))).alias("_place")
    return met.select("r.*", places).withColumns({day: F.col("_place.day"), GONE: F.col("_place.gone")}).drop("_place")


def staying(rows):
    """Rows that are not marked gone."""
    return rows.where(~F.coalesce(GONE, F.lit(False)))
