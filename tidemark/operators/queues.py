"""Registrations of changed objects: how many wait, and which move on to an output queue.

A registration is a row (object, ref): one object of that name has changed and waits in an accumulator or a queue.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OBJECT, REF = "object", "ref"


def sizes(registrations: DataFrame) -> DataFrame:
    """(object, n): how many wait of each."""
    return registrations.groupBy(OBJECT).agg(F.count(F.lit(1)).alias("n"))


def at_least(registrations: DataFrame, most: int) -> DataFrame:
    """(n): how many wait, counted no further than ``most``: tasks stop reading there."""
    return registrations.limit(most).agg(F.count(F.lit(1)).alias("n"))


def next_portion(accumulator: DataFrame, others: list[DataFrame], order: list[str], start: int, room: int) -> DataFrame:
    """Registrations that fill one queue up to ``room``: objects in turn from place ``start`` of ``order``, what the other queues hold left out.

    Within an object the lowest refs go first. No task orders more than one object's registrations, and none that all fit.
    """
    held = reduce(DataFrame.unionByName, (o.select(OBJECT, REF) for o in others)) if others else None
    free = accumulator.select(OBJECT, REF).distinct()
    free = free.join(held, [OBJECT, REF], "left_anti") if held is not None else free
    turn = {name: (k - start) % len(order) for k, name in enumerate(order)}
    table = accumulator.sparkSession.createDataFrame(list(turn.items()), f"{OBJECT} string, turn int")  # one row per object
    waiting = free.groupBy(OBJECT).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(table), OBJECT)
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = waiting.withColumn("take", F.least("n", F.greatest(F.lit(0), F.lit(room) - before))).where("take > 0").select(OBJECT, "n", "take")
    rows = free.join(F.broadcast(taken), OBJECT)
    whole = rows.where("take = n").select(OBJECT, REF)
    part = rows.where("take < n").withColumn("place", F.row_number().over(Window.partitionBy(OBJECT).orderBy(REF))).where("place <= take").select(OBJECT, REF)
    return whole.unionByName(part)


def next_start(portion: DataFrame, order: list[str], start: int) -> int:
    """Where the next portion begins: after the last object in turn that gave something; unmoved if none did."""
    gave = {r[OBJECT] for r in portion.select(OBJECT).distinct().collect()}  # one row per object
    return max(((start + k + 1) % len(order) for k in range(len(order)) if order[(start + k) % len(order)] in gave), key=lambda p: (p - start - 1) % len(order), default=start)
