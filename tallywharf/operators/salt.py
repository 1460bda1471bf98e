"""Spreading the rows of one join key over several tasks."""

from pyspark.sql import functions as F

SALT = "_salt"


def spread(rows, by, salts):
    """Gives each row of the large side a salt that depends on ``by``."""
    return rows.withColumn(SALT, F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def copied(rows, salts):
    """One copy of each row of the small side for every salt."""
    return rows.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
