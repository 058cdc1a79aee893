"""Choosing rows in key order up to a budget, without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowhaul.llm.frames import written

#: Parts a group's keys are cut into; only rows of the one part in which a budget ends are ordered.
BINS = 4096


def within_budget(df: DataFrame, budgets: DataFrame, group: str, key: str, amount: str, tie: list[str], budget: str = "budget", bins: int = BINS, part: float = 0.5) -> DataFrame:
    """Add ``picked``: rows of each group in order of ``key`` (0 up to 1, then ``tie``) of which ``part`` lies within the group's budget.

    The amounts of a group's rows add up in key order up to the first row that
    does not fit; nothing behind it is picked. Parts of the key range are summed first, combined before the
    shuffle; parts that lie wholly below or above the budget are decided as a
    whole. ``budgets`` has one row for each group (null matches null).
    """
    rows = df.withColumn("_bin", F.least(F.floor(F.col(key) * bins), F.lit(bins - 1)).cast("int"))
    sums = rows.groupBy(group, "_bin").agg(F.sum(amount).alias("_sum"), F.max(amount).alias("_largest"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    limits = budgets.select(F.col(group).alias("_group"), F.col(budget).alias("_budget"))
    parts = sums.withColumn("_before", before).join(limits, F.col(group).eqNullSafe(F.col("_group"))).select(
        F.col("_group"), F.col("_bin").alias("_part"), "_before", "_budget",
        F.when(F.col("_before") + F.col("_sum") <= F.col("_budget"), F.lit(1)).when(F.col("_before") > F.col("_budget"), F.lit(-1)).otherwise(F.lit(0)).alias("_side"),
    )
    marked = rows.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bin") == F.col("_part")))
    whole = marked.where("_side != 0").withColumn("picked", F.col("_side") > 0)
    order = Window.partitionBy(group, "_bin").orderBy(F.col(key), *(F.col(t) for t in tie)).rowsBetween(Window.unboundedPreceding, -1)
    running = F.col("_before") + F.coalesce(F.sum(amount).over(order), F.lit(0))
    cut = marked.where("_side = 0").withColumn("picked", running + F.col(amount) * F.lit(part) <= F.col("_budget"))
    return whole.select(*df.columns, "picked").unionByName(cut.select(*df.columns, "picked"))


#: A budget counts as filled when less than this share of it is left.
NEAR = 0.001


def fill_budget(df: DataFrame, budgets: DataFrame, group: str, key: str, amount: str, tie: list[str], row: str, near: float = NEAR) -> DataFrame:
    """Add ``picked``: rows of each group in key order, passing over those larger than what is left of the group's budget.

    Each round takes rows that fit what is left, up to the first that does not;
    the next goes on behind it. Rows that do not fit are out for good, as less is
    left each time, so rounds soon look at few rows. In the end, if that comes
    nearer, the least row that was left out is taken too: what is picked is off by
    half of it at most, or by the share ``near``. ``row`` is a unique number of
    each row, ``budgets`` has one row for each group (null matches null).
    """
    columns, of = df.columns, lambda frame: frame.select(F.col(group).alias("_g"), "_left", "_all")
    same = F.col(group).eqNullSafe(F.col("_g"))
    left = written(budgets.select(group, F.col("budget").cast("double").alias("_left"), F.col("budget").cast("double").alias("_all")), "left")
    rest, taken = df, []
    while True:
        fitting = rest.join(of(left), same).where(f"{amount} <= _left AND _left > {near} * _all").select(*columns)
        marked = written(within_budget(fitting, left, group, key, amount, tie, "_left", part=1.0), "picked")
        picked = marked.where("picked").select(*columns)
        if picked.isEmpty():
            break
        taken.append(picked)
        sums = picked.groupBy(F.col(group).alias("_s")).agg(F.sum(amount).alias("_sum"))
        left = written(left.join(sums, F.col(group).eqNullSafe(F.col("_s")), "left").select(group, (F.col("_left") - F.coalesce("_sum", F.lit(0))).alias("_left"), "_all"), "left")
        rest = marked.where("NOT picked").select(*columns)
    rows = df.select(row).limit(0)
    for part in taken:
        rows = rows.unionByName(part.select(row))
    # what is larger than all that is left, but not twice as large
    over = df.join(of(left), same).where(f"{amount} > _left AND {amount} < 2 * _left AND _left > {near} * _all").join(rows, row, "left_anti")
    last = over.groupBy(group).agg(F.min(F.struct(*dict.fromkeys([amount, key, *tie, row]))).alias("_least")).select(F.col(f"_least.{row}").alias(row))
    chosen = rows.unionByName(last).select(F.col(row).alias("_row"))
    return df.join(chosen, F.col(row) == F.col("_row"), "left").select(*columns, F.col("_row").isNotNull().alias("picked"))
