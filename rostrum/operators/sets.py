"""Set operators and the writes that come from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def anti_join_load(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose keys are not stored."""
    return new.join(stored.select(*keys), keys, "left_anti")


def replace_by_key(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """stored without the keys of new, and new."""
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def keyed_update(stored: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """stored with the columns of updates where its key is there, also where the new value is null."""
    new = updates.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = stored.join(new, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns))


def guarded_update(stored: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """updates (key, before, after): set only where the stored value still is `before`, null included; adds `applied`."""
    new = updates.select(key, F.col("before").alias("_before"), F.col("after").alias("_after"), F.lit(True).alias("_hit"))
    joined = stored.join(new, key, "left")
    ok = F.coalesce(F.col("_hit") & F.col(column).eqNullSafe(F.col("_before")), F.lit(False))
    return joined.select(*(F.when(ok, F.col("_after")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in stored.columns), ok.alias("applied"))


def state_update(stored: DataFrame, updates: DataFrame, key: str, state: str, expected: str, columns: list[str]) -> DataFrame:
    """keyed_update of the rows that are in the expected state only."""
    ready = updates.join(stored.where(F.col(state) == expected).select(key), key, "left_semi")
    return keyed_update(stored, ready, key, columns)


def coalesce_fill(rows: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fills nulls from another table."""
    more = other.select(key, *(F.col(c).alias(f"_o_{c}") for c in columns))
    return rows.join(more, key, "left").select(*(F.coalesce(c, f"_o_{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))


def plan_diff(stored: DataFrame, planned: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, action): ADD, DELETE, UPDATE or KEEP for each key of either side."""
    a = stored.select(*keys, F.struct(*values).alias("_s"), F.lit(True).alias("_in_s"))
    b = planned.select(*keys, F.struct(*values).alias("_p"), F.lit(True).alias("_in_p"))
    joined = a.join(b, keys, "full_outer")
    action = F.when(F.col("_in_s").isNull(), "ADD").when(F.col("_in_p").isNull(), "DELETE").when(F.col("_s").eqNullSafe(F.col("_p")), "KEEP").otherwise("UPDATE")
    return joined.select(*keys, action.alias("action"))


def intersection(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct rows of these columns that both sides have, nulls equal."""
    return left.select(*columns).intersect(right.select(*columns))


def order_violations(rows: DataFrame, by: list[str], order: str, key: str) -> DataFrame:
    """Rows whose key is not above that of the row before them in their group; none if keys strictly increase."""
    w = W.partitionBy(*by).orderBy(order)
    return rows.withColumn("previous", F.lag(key).over(w)).where(F.col("previous") >= F.col(key))


def table_diff(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, left, right, verdict): SAME, DIFFERENT, ONLY_LEFT or ONLY_RIGHT."""
    joined = left.select(key, F.col(value).alias("left_value")).join(right.select(key, F.col(value).alias("right_value")), key, "full_outer")
    verdict = F.when(F.col("right_value").isNull(), "ONLY_LEFT").when(F.col("left_value").isNull(), "ONLY_RIGHT").when(F.col("left_value") == F.col("right_value"), "SAME").otherwise("DIFFERENT")
    return joined.withColumn("verdict", verdict)


def check_equal(stored: DataFrame, planned: DataFrame) -> None:
    """Raises if the two hold different rows, repeats counted."""
    for a, b, what in ((stored, planned, "stored rows are not planned"), (planned, stored, "planned rows are not stored")):
        n = a.exceptAll(b.select(a.columns)).count()
        if n:
            raise ValueError(f"{n} {what}")


def check_unique(rows: DataFrame, keys: list[str]) -> None:
    twice = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the key {dict(zip(keys, twice[0], strict=False))} is there {twice[0]['count']} times")


def include_exclude(text: Column, include: str, exclude: list[str]) -> Column:
    """Matches one pattern and none of the others."""
    return reduce(lambda a, pattern: a & ~text.rlike(pattern), exclude, text.rlike(include))


def ilike_any(text: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.ilike(p) for p in patterns))


def extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def pass_coalesce(rows: DataFrame, passes: list[tuple[str, Column]], name: str = "linked") -> DataFrame:
    """Passes in order, each on what is still unlinked, with the pass that linked it."""
    value, by = F.lit(None), F.lit(None).cast("string")
    for label, result in passes:
        by = F.coalesce(by, F.when(value.isNull() & result.isNotNull(), F.lit(label)))
        value = F.coalesce(value, result)
    return rows.withColumns({name: value, f"{name}_by": by})
