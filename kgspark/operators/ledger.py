"""A ledger of finished calls (M2, M11): a service is asked once for each different input.

Calls are made in slices; a slice's answers are appended to the ledger table as one committed version when the slice
ends. A run that is killed half-way repeats no call of a finished slice, a rerun of a step calls only what has no
usable answer yet, and nothing is called at all when there is nothing to ask. A slice has as many tasks as may call
at once, so that limit does not depend on how the input is partitioned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.tables import TableStore

#: Calls of one task of a slice, about: what a lost run repeats at most, per task.
CALLS_PER_TASK = 2000


def called_once(store: TableStore, ledger: str, inputs: DataFrame, key: str, failed: Column,
                call: Callable[[DataFrame], DataFrame], at_once: int, calls_per_task: int = CALLS_PER_TASK) -> DataFrame:
    """One answer per ``key`` of ``inputs``: ``call`` gets rows of ``inputs`` and returns rows with ``key``.

    An answer for which ``failed`` holds stays in the ledger as the last word of this run and is asked for again by
    the next one; a usable answer wins over a failed one.
    """
    usable = ~F.coalesce(failed, F.lit(False))
    pending = inputs.dropDuplicates([key])
    if store.exists(ledger):
        pending = pending.join(store.read(ledger).where(usable).select(key), key, "left_anti")
    seen, waiting = Observation(), f"{ledger}__pending"
    store.write(pending.observe(seen, F.count(F.lit(1)).alias("n")), waiting)
    slices = -(-seen.get["n"] // (at_once * calls_per_task))
    for i in range(slices):
        part = store.read(waiting).where(F.pmod(F.xxhash64(key), F.lit(slices)) == i)
        store.append(call(part.repartition(at_once)), ledger)
    store.drop(waiting)
    if not store.exists(ledger):  # nothing was ever asked: an empty answer of the right columns
        return call(inputs.limit(0))
    answers = store.read(ledger)
    rest = [c for c in answers.columns if c != key]
    best = answers.withColumn("_ok", usable.cast("int")).groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct("_ok", F.xxhash64(*rest))).alias("a"))
    return best.select(key, "a.*")
