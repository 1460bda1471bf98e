"""Daily active devices."""

from pyspark.sql import functions as F

from .newest import first_row

KEYS = ("log_date", "mid")


def first_per_day(logs, order_by=("ts",), keep=None):
    """The first log of each device on each day.

    ``order_by`` decides which log is first; equal ones are told apart by the remaining columns, so the result does
    not depend on arrival order.  ``keep`` names the columns to carry along.  When that is only the leading order
    column the whole step is a primitive ``min`` and stays in hash aggregation.
    """
    keep = [c for c in (logs.columns if keep is None else keep) if c not in KEYS]
    lead = order_by[0]
    if set(keep) <= {lead}:
        return logs.groupBy(*KEYS).agg(F.min(lead).alias(lead))
    rest = [c for c in keep if c not in order_by]
    rows = logs.select(*KEYS, *order_by, *rest)
    return first_row(rows, KEYS, [F.asc(c) for c in [*order_by, *rest]]).select(*KEYS, *keep)


def unseen(firsts, seen):
    """Rows of ``firsts`` whose (day, device) is not in ``seen``; the unknown device counts as one device."""
    same = F.col("f.log_date").eqNullSafe(F.col("s.log_date")) & F.col("f.mid").eqNullSafe(F.col("s.mid"))
    return firsts.alias("f").join(seen.select(*KEYS).alias("s"), same, "left_anti")


def seen_among(firsts, history, broadcast_keys):
    """The (day, device) keys of ``history`` that also occur in ``firsts``.

    With ``broadcast_keys`` the batch's keys travel to the history, which is then filtered where it lies instead of
    being shuffled; the caller has counted the batch and vouches for its size.
    """
    keys = firsts.select(*KEYS)
    keys = F.broadcast(keys) if broadcast_keys else keys
    same = F.col("h.log_date").eqNullSafe(F.col("k.log_date")) & F.col("h.mid").eqNullSafe(F.col("k.mid"))
    return history.select(*KEYS).alias("h").join(keys.alias("k"), same, "left_semi")
