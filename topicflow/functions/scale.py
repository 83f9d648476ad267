"""Skew-safe row selection.

A group (channel, topic, stratum) may hold a third of all rows, so no helper here sorts a
whole group in one task: hash slots or key ranges split it first, and the only data kept per
group in one place is a table of slot counts with a fixed upper bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RANDOM_SEED
from ..session import materialize

_SLOT_DIGITS = 3  # 16**3 = 4096 hash slots per group


def hash_key(id_col: str, seed: int = RANDOM_SEED) -> Column:
    """A repeatable pseudo-random order of rows that other engines can reproduce."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def explode_once(df: DataFrame, keep: Sequence[str], values: Column, name: str) -> DataFrame:
    """One row per element of a computed array.

    For a plain ``explode`` Spark infers a filter on the array's size and pushes it to the scan,
    where the whole expression is computed a second time, and inside lambdas once per element. The
    outer form infers nothing; rows of empty arrays are dropped afterwards.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def sample_per_group(
    df: DataFrame,
    group: Sequence[str],
    id_col: str,
    quota: Column | Callable[[Column], Column],
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Keep the ``quota`` rows of each group that come first in hash order.

    ``quota`` may be computed from the size of the group. Counting per hash slot finds the one
    slot in which each group's quota ends. Slots beyond it never leave their map task, slots before it pass
    whole, and only the rows of that one slot are ranked.
    """
    group = list(group)
    hashed = df.withColumn("__h", hash_key(id_col, seed)).withColumn("__slot", F.substring("__h", 1, _SLOT_DIGITS))
    slots = hashed.groupBy(*group, "__slot").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum("__n").over(whole)
    room = (quota(size) if callable(quota) else quota) - F.coalesce(F.sum("__n").over(before), F.lit(0))
    open_slots = slots.withColumn("__room", room).where("__room > 0")
    open_slots = materialize(open_slots.withColumn("__cut", F.col("__room") < F.col("__n")).drop("__n"), "slots")

    def of(wanted: DataFrame) -> DataFrame:
        # null-safe: a null stratum is a stratum too
        keys = [hashed[c].eqNullSafe(wanted[c]) for c in group] + [hashed["__slot"] == wanted["__slot"]]
        return hashed.join(wanted, keys).select(hashed["*"], wanted["__room"])

    rank = F.row_number().over(Window.partitionBy(*group, "__slot").orderBy("__h", id_col))
    cut = of(open_slots.where("__cut")).withColumn("__rn", rank).where("__rn <= __room").drop("__rn")
    return of(open_slots.where("not __cut")).unionByName(cut).drop("__h", "__slot", "__room")


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    id_col: str,
    rank_name: str | None = None,
    salts: int = 64,
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark limits every group to ``k`` rows on the map side, so a small ``k`` needs one pass; for
    a large ``k`` a salted pass first cuts hot groups to ``k`` rows per salt.
    """
    group = list(group)
    if group and k > 100:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
        first = Window.partitionBy(*group, "__salt").orderBy(*order)
        df = salted.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") <= k).drop("__rn", "__salt")
    name = rank_name or "__rn"
    if not group:
        df = df.orderBy(*order).limit(k)  # the window below numbers these k rows only
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)
    return ranked if rank_name else ranked.drop(name)


def _ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned by ``keys`` and written, with the number of each row's range.

    Spark samples the keys, so ranges hold about equally many rows however skewed the groups are;
    writing them once fixes the numbers for all later reads, also after the loss of an executor.
    """
    return materialize(df.repartitionByRange(*keys).withColumn("__slot", F.spark_partition_id()), "ranged")


def dense_index(df: DataFrame, key: str, name: str) -> DataFrame:
    """Dense 0-based position of each row in ``key`` order, without a single-task sort."""
    slotted = _ranged(df, [key])
    counts = slotted.groupBy("__slot").agg(F.count("*").alias("__n"))  # one row per range
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.row_number().over(Window.partitionBy("__slot").orderBy(key)) - 1
    return slotted.join(offsets, "__slot").withColumn(name, F.col("__off") + local).drop("__slot", "__off")


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """The smallest value that at least the share ``q`` of all values does not exceed, exact at every size; None without values.

    Values are counted per range of their order; the driver sees one number per range and picks the range that
    holds the wanted rank.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__v")).agg(F.count("*").alias("__n"))
    slotted = _ranged(counts, ["__v"])
    totals = {r["__slot"]: r["n"] for r in slotted.groupBy("__slot").agg(F.sum("__n").alias("n")).collect()}
    rank = max(1, math.ceil(round(q * sum(totals.values()), 9)))
    for slot in sorted(totals):
        if rank <= totals[slot]:
            upto = F.sum("__n").over(Window.orderBy("__v"))
            inside = slotted.where(F.col("__slot") == slot).withColumn("__upto", upto)
            return inside.where(F.col("__upto") >= rank).agg(F.min("__v").alias("v")).first()["v"]
        rank -= totals[slot]
    return None


def next_in_group(df: DataFrame, group: Sequence[str], key: str, value: str, name: str) -> DataFrame:
    """``lead(value)`` by ``key`` within each group, with hot groups split by key range.

    The last row of a group in a range looks up the first row of the next range the group has; that
    lookup table holds one row per group and range.
    """
    group = list(group)
    slotted = _ranged(df, [*group, key])
    window = Window.partitionBy(*group, "__slot").orderBy(key)
    local = slotted.withColumn(name, F.lead(value).over(window)).withColumn("__last", F.lead(key).over(window).isNull())
    firsts = slotted.groupBy(*group, "__slot").agg(F.min_by(value, key).alias("__first"))
    follow = F.lead("__first").over(Window.partitionBy(*group).orderBy("__slot"))
    bridge = firsts.select(*group, "__slot", follow.alias("__next"))
    joined = local.join(bridge, [*group, "__slot"], "left")
    return joined.withColumn(
        name, F.when(F.col("__last"), F.col("__next")).otherwise(F.col(name))
    ).drop("__slot", "__last", "__next")


def running_max(df: DataFrame, group: Sequence[str], key: str, value: str, name: str) -> DataFrame:
    """Maximum of ``value`` up to and including each row in ``key`` order, hot groups split by range.

    A range starts from the maximum of the group's ranges before it.
    """
    group = list(group)
    slotted = _ranged(df, [*group, key])
    peaks = slotted.groupBy(*group, "__slot").agg(F.max(value).alias("__peak"))
    before = Window.partitionBy(*group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = peaks.select(*group, "__slot", F.max("__peak").over(before).alias("__carried"))
    local = Window.partitionBy(*group, "__slot").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    joined = slotted.join(carried, [*group, "__slot"])
    return joined.withColumn(name, F.greatest(F.max(value).over(local), F.col("__carried"))).drop("__slot", "__carried")


def side_by_side(parts: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One-row tables (one row per ``by``) as one row with all their columns, without a join."""
    by = list(by)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in columns])
