"""Percentages and the bands they are reported for."""

from pyspark.sql import functions as F

# Labels of the share report.
AGE_TITLE = "用户年龄占比"
GENDER_TITLE = "用户性别占比"
UNDER_20 = "20岁以下"
FROM_20_TO_29 = "20岁到30岁"
FROM_30 = "30岁及30岁以上"
MALE = "男"
FEMALE = "女"


def percent(part, total):
    """``part`` of ``total`` in percent, two decimals, half-even; NULL when there is nothing to divide."""
    return F.bround(F.try_divide(part * F.lit(100.0), total), 2)


def remainder(*others):
    """What the other percentages leave of 100."""
    left = F.lit(100.0)
    for other in others:
        left = left - other
    return F.bround(left, 2)


def age_band(age):
    return F.when(age < 20, UNDER_20).when(age >= 30, FROM_30).when(age.isNotNull(), FROM_20_TO_29)


def gender_band(gender):
    """"F" is female and any other known value male; an unknown gender has no band."""
    return F.when(gender == "F", FEMALE).when(gender.isNotNull(), MALE)
