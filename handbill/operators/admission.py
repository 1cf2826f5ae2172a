"""Which fetches a run may make under its budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from handbill.operators.rank import top_per_group


def budget_admission(outcomes: DataFrame, run: str, order: list[str], metered: Column,
                     empty: Column, fallback: Column, budget: int) -> DataFrame:
    """Mark each source of each run: wants a paid fetch, may have it, resulting outcome.

    A metered source wants one; another one only when its own attempt failed or was empty
    and it has a fallback. Fetches cost 1 and are granted in registry order, so those
    granted are the first ``budget`` that want one. Only wanting rows are
    numbered, and no run's rows meet in one task whatever the budget; the run's last granted
    place then comes back over a join.
    """
    place = F.struct(*order)
    wanting = outcomes.withColumn("wants", F.coalesce(metered | (empty & fallback), F.lit(False)))
    if budget <= 0:
        return _decide(wanting.withColumn("granted", F.lit(False)), metered)
    cut = (
        top_per_group(wanting.where("wants").select(run, *order), F.col(run), run,
                      [F.col(c).asc() for c in order], budget, "_n")
        .groupBy(run)
        .agg(F.max(place).alias("_last"))
    )
    decided = wanting.join(cut, run, "left").withColumn(
        "granted", F.col("wants") & F.coalesce(place <= F.col("_last"), F.lit(False))
    )
    return _decide(decided.drop("_last"), metered)


def _decide(df: DataFrame, metered: Column) -> DataFrame:
    """``method`` that supplies the records and ``error`` of a refused metered source."""
    refused = F.col("wants") & ~F.col("granted")
    return df.withColumns(
        {
            "method": F.when(metered | F.col("granted"), F.lit("metered")).otherwise(
                F.lit("direct")
            ),
            "error": F.when(refused & metered, F.lit("budget_exceeded")),
        }
    )
