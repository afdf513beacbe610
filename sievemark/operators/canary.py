"""Traffic arms of a progressive release and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash60

# Canary share and acceptance bounds.
CANARY_PERCENT = 10
MAX_RELATIVE_ERROR = 1.2
MIN_ERROR_BOUND = 0.01


def arm(user: Column, percent: int = CANARY_PERCENT, seed: int = 42) -> Column:
    """Stable arm of a user: ``candidate`` for ``percent`` of the users."""
    if not 0 <= percent <= 100:
        raise ValueError(f"percent must be in [0, 100], got {percent}")
    slot = F.pmod(hash60(F.concat(F.lit(f"{seed}:"), user.cast("string"))), F.lit(100))
    return F.when(slot < percent, "candidate").otherwise("champion")


def arm_totals(requests: DataFrame, arm_column: str, error: Column) -> DataFrame:
    return requests.groupBy(arm_column).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(error).alias("errors")
    )


def compare(requests: DataFrame, arm_column: str, error: Column) -> DataFrame:
    """Candidate is accepted when its error rate ≤ max(1.2 × champion, 0.01); an arm without
    requests has rate 0."""
    def rate(name: str) -> Column:
        n = F.count_if(F.col(arm_column) == name)
        return F.when(n > 0, F.count_if((F.col(arm_column) == name) & error) / n).otherwise(0.0)

    rates = requests.agg(rate("candidate").alias("candidate_rate"), rate("champion").alias("champion_rate"))
    bound = F.greatest(F.col("champion_rate") * MAX_RELATIVE_ERROR, F.lit(MIN_ERROR_BOUND))
    return rates.withColumn("accepted", F.col("candidate_rate") <= bound)
