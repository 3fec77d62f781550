"""Running balances of movements, and the moments at which more went out than there was."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.quality import Rule
from assayline.operators.ranged import PART, carried, inside, ranged, with_carried


def running_balance(
    movements: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, out: str = "balance"
) -> DataFrame:
    """``movements`` with the sum of ``amount`` over all rows of the key up to and with this one.

    ``order`` must tell the rows of a key apart. A prefix sum in two levels: sums within
    range partitions, and for a key that goes on from one into the next the sum of what
    came before. No key is one task. NULL amounts count as 0, NULL keys are one key.
    Use whole numbers or decimals where the order of additions must not matter.
    """
    columns = movements.columns
    value = F.ifnull(F.col(amount), F.lit(0).cast(movements.schema[amount].dataType))
    placed = ranged(movements.withColumn("__amount", value), keys, order, "movements")
    before = carried(placed, keys, F.sum("__amount"), F.sum, "__before")
    here = F.sum("__amount").over(inside(keys, order))
    rows = with_carried(placed, before, keys).withColumn("__here", here)
    total = F.col("__here") + F.ifnull(F.col("__before"), F.lit(0).cast(before.schema["__before"].dataType))
    return rows.withColumn(out, total).drop("__amount", "__before", "__here", PART).select(*columns, out)


def oversell_rule(balance: str = "balance", amount: str = "quantity") -> Rule:
    """Something went out that was not there: the balance is below zero after an outgoing movement."""
    return Rule((F.col(balance) < 0) & (F.col(amount) < 0), "OVERSELL", certainty="ESTIMATED")
