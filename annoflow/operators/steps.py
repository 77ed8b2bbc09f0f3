"""Rows after every step of a chain (A27), observed while the chain runs: no job of its own for a count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from annoflow.session import stage

_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
#: Drops the plan beside an empty join side, observed steps included.
_DROPS_STEPS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


class Steps:
    """Marks the steps of a chain.  ``df = steps(df, name)`` where a step ends; ``run`` computes the chain once; ``report`` then has the
    figures."""

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def __call__(self, df: DataFrame, name: str, rows: Column | None = None) -> DataFrame:
        """``rows``: what counts as the number of rows, if the frame's own do not."""
        o = Observation()
        self._seen.append((name, o))
        return df.observe(o, (F.count(F.lit(1)) if rows is None else F.coalesce(rows, F.lit(0))).cast("bigint").alias("n"))

    def run(self, df: DataFrame, label: str) -> DataFrame:
        """``df``, computed and stored."""
        conf = df.sparkSession.conf
        before = conf.get(_EXCLUDED, None)
        conf.set(_EXCLUDED, ",".join(filter(None, (before, _DROPS_STEPS))))
        try:
            return stage(df, label)
        finally:
            conf.unset(_EXCLUDED) if before is None else conf.set(_EXCLUDED, before)

    def report(self, spark: SparkSession) -> DataFrame:
        """step, n_rows, and pct_removed of the step before (null at the start and after an empty step)."""
        rows = [(i, name, o.get["n"]) for i, (name, o) in enumerate(self._seen)]
        df = spark.createDataFrame(rows, "o int, step string, n_rows bigint")
        before = F.lag("n_rows").over(Window.partitionBy(F.lit(0)).orderBy("o"))  # a row for each step
        return df.select("step", "n_rows", F.round(F.try_divide(100.0 * (before - F.col("n_rows")), before), 9).alias("pct_removed"))
