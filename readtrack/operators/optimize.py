"""Minimising a sum over all rows: values and gradients summed on the workers, limited-memory quasi-Newton steps on the driver.

Only the parameters and one gradient are on the driver; rows never are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 16
SUMS = "task long, sums binary"


def _add(t: pa.Table) -> pa.Table:
    t = t.sort_by("task")
    total = sum(np.frombuffer(x) for x in t.column("sums").to_pylist())
    return pa.table({"task": t.column("task").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def summed(rows: DataFrame, part: Callable[[Iterable[pa.RecordBatch]], np.ndarray], tasks: int) -> np.ndarray:
    """The sum of `part` over the partitions of `rows`: FAN_IN tasks' vectors meet at a time until few are left, always in the same order."""

    def run(batches):
        from pyspark import TaskContext

        total = part(batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], ["task", "sums"])

    found = rows.mapInArrow(run, SUMS)
    while tasks > FAN_IN:
        found = found.groupBy(F.floor(F.col("task") / FAN_IN).alias("group")).applyInArrow(_add, SUMS)
        found = found.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("long"))
        tasks = -(-tasks // FAN_IN)
    got = sorted((r["task"], bytes(r["sums"])) for r in found.collect())
    return sum(np.frombuffer(x) for _, x in got)


def minimise(
    value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, l1: np.ndarray | float = 0.0, steps: int = 60, memory: int = 8, tolerance: float = 1e-6
) -> tuple[np.ndarray, list[float]]:
    """The least of value(x) + sum(l1 * |x|), and the values on the way. `value` gives a smooth function's value and gradient.

    Two-loop recursion over the last `memory` steps. With L1, directions and steps keep to the orthant that the pseudo-gradient points
    into, so that weights become exactly 0. A step is halved until the value falls enough.
    """
    x, l1 = start.astype(float), np.broadcast_to(np.asarray(l1, float), start.shape)
    f, g = value(x)
    f += float((l1 * np.abs(x)).sum())
    seen, moves, turns = [f], [], []
    for _ in range(steps):
        slope = np.where(x > 0, g + l1, np.where(x < 0, g - l1, np.where(g + l1 < 0, g + l1, np.where(g - l1 > 0, g - l1, 0.0))))
        if not np.abs(slope).max(initial=0) > tolerance:
            break
        d, back = -slope, []
        for s, y in zip(reversed(moves), reversed(turns), strict=True):
            a = s @ d / (s @ y)
            back.append(a)
            d = d - a * y
        if moves:
            d = d * (moves[-1] @ turns[-1] / (turns[-1] @ turns[-1]))
        for (s, y), a in zip(zip(moves, turns, strict=True), reversed(back), strict=True):
            d = d + s * (a - y @ d / (s @ y))
        d = np.where((d * slope < 0) | (l1 == 0), d, 0.0)
        if not d @ slope < 0:
            d, moves, turns = -slope, [], []
        orthant = np.where(x != 0, np.sign(x), np.sign(-slope))
        step = 1.0 if moves else min(1.0, 1.0 / np.abs(slope).sum())
        for _ in range(30):
            new = x + step * d
            new = np.where((l1 > 0) & (new * orthant < 0), 0.0, new)
            f_new, g_new = value(new)
            f_new += float((l1 * np.abs(new)).sum())
            if f_new <= f + 1e-4 * (slope @ (new - x)):
                break
            step *= 0.5
        else:
            break
        s, y = new - x, g_new - g
        if s @ y > 1e-12 * (y @ y):
            moves, turns = [*moves, s][-memory:], [*turns, y][-memory:]
        gained, x, f, g = f - f_new, new, f_new, g_new
        seen.append(f)
        if gained <= tolerance * max(1.0, abs(f)):
            break
    return x, seen
