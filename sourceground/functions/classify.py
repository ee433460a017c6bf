"""Category, quality and task columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookups import CATEGORY_LEVEL1, CATEGORY_NONE, CATEGORY_OTHER, CATEGORY_TASKS, DEFAULT_TASKS, FORMAL_TIER
from .text import WS, strip


def _map(pairs: dict) -> Column:
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v))])


def category_level_1(raw: Column) -> Column:
    s = strip(F.coalesce(raw, F.lit("")))
    first = F.element_at(F.split(s, rf"[{WS}]+", 2), 1)
    return F.when(s == "", CATEGORY_NONE).otherwise(F.coalesce(F.try_element_at(_map(CATEGORY_LEVEL1), first), F.lit(CATEGORY_OTHER)))


def category_level_2(raw: Column) -> Column:
    return strip(F.coalesce(raw, F.lit("")))


def quality_percent(raw: Column) -> Column:
    """Whole percent of ``NN%``; null for what is no number."""
    value = strip(F.regexp_replace(strip(raw), "%+$", "")).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < 2147483648.0), value.try_cast("int"))


def quality_tier(raw: Column) -> Column:
    q = quality_percent(raw)
    return F.when(q.isNull() | (q == 0), "unscored").when(q >= 80, "test").when(q >= 50, "candidate").otherwise("explore")


def eligible_for_test(tier: Column) -> Column:
    return tier == FORMAL_TIER


def candidate_tasks(level1: Column) -> Column:
    extra = F.coalesce(F.try_element_at(_map(CATEGORY_TASKS), level1), F.array(*map(F.lit, DEFAULT_TASKS)))
    return F.concat(F.array(F.lit("T1")), extra)
