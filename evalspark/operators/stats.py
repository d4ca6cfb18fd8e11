"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Groups up to this size are sorted whole; in larger ones a bracket of about 4 / ACCURACY of the rows is.
WHOLE, ACCURACY = 200_000, 50_000


def exact_quantiles(df: DataFrame, group: str, value: str, quantiles: dict[str, float], whole: int = WHOLE, accuracy: int = ACCURACY) -> DataFrame:
    """(group, n, one column per quantile): linear interpolation between order statistics, nulls left out.

    Spark's ``percentile`` keeps a counter for each distinct value of a group in
    one buffer. Here a sketch of bounded size brackets each quantile, the rows
    below a bracket are counted, and only those inside it are ranked, so that no
    task holds a group. ``df`` is read three times: persist it if it is dear.
    """
    names = list(quantiles)
    rows = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
    margin = 2 / accuracy  # twice the sketch's error in rank
    around = [min(1.0, max(0.0, q + d)) for q in quantiles.values() for d in (-margin, margin)]
    sketch = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", around, accuracy).alias("_p"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    small = F.col("_n") <= whole
    bounds = sketch.select(
        "_g",
        "_n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("q"),
                        ((F.col("_n") - 1) * quantiles[n]).alias("at"),
                        F.when(small, F.col("_min")).otherwise(F.col("_p")[2 * i]).alias("lo"),
                        F.when(small, F.col("_max")).otherwise(F.col("_p")[2 * i + 1]).alias("hi"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        ).alias("b"),
    ).select("_g", "_n", "b.*")
    joined = rows.join(bounds, "_g")
    below = joined.where("_v < lo").groupBy("_g", "q").agg(F.count(F.lit(1)).alias("_below"))
    inside = joined.where("_v >= lo AND _v <= hi").withColumn("_r", F.row_number().over(Window.partitionBy("_g", "q").orderBy("_v")) - 1)
    ranked = inside.join(below, ["_g", "q"], "left").withColumn("_r", F.col("_r") + F.coalesce("_below", F.lit(0)))
    near = ranked.where((F.col("_r") == F.floor("at")) | (F.col("_r") == F.ceil("at")))
    found = near.groupBy("_g", "_n", "q", "at").agg(F.min_by("_v", "_r").alias("a"), F.max_by("_v", "_r").alias("b"))
    point = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    return found.groupBy(F.col("_g").alias(group), F.col("_n").alias("n")).agg(*[F.max(F.when(F.col("q") == n, point)).alias(n) for n in names])


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` and an observation whose ``get`` has ``n``, its rows, once an action has run: counts without a job of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen
