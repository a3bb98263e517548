"""column summary with and without median standardisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh
from ..spec import PanelSpec
from . import outlier
from .groupstats import group_percentiles

KINDS = ("absolute", "median_standardization")


def column_summary(df: DataFrame, spec: PanelSpec, col: str, absolute: bool = True,
                   standardized: bool = True) -> DataFrame:
    """Tall summary ``(kind, min_value, lower, upper, max_value, max_mad)``:
    IQR fences of the raw column (``absolute``) and of its robust z
    (``median_standardization``), with the column's largest group MAD.

    The group statistics are written once (:class:`outlier.Deviations`); one
    aggregate over that table gives both summaries. A column beyond the
    policy's bound takes its quantiles from radix selection instead."""
    dev = outlier.Deviations.of(df, spec, col)
    kinds = [k for k, on in zip(KINDS, (absolute, standardized)) if on]
    z, most = fresh(dev.rows, "_z", "_most")
    wide = dev.with_z(z, keep_max=most).select(dev.x.alias(KINDS[0]), F.col(z).alias(KINDS[1]), most)
    if dev.rows.count() <= spec.skew.hot_rows:      # from the files' footers
        r = wide.agg(*[f(k).alias(f"{k}:{n}") for k in kinds for n, f in (
            ("min", F.min), ("max", F.max), ("q", lambda c: F.percentile(c, [0.25, 0.75])))], F.max(most).alias("max_mad"))
        found = r.select(F.explode(F.array(*[F.struct(
            F.lit(k).alias("kind"), F.col(f"`{k}:min`").alias("min_value"), F.col(f"`{k}:q`")[0].alias("q1"),
            F.col(f"`{k}:q`")[1].alias("q3"), F.col(f"`{k}:max`").alias("max_value"), "max_mad") for k in kinds])).alias("s")).select("s.*")
    else:
        tall = wide.unpivot([most], kinds, "kind", "value")
        q = group_percentiles(tall, PanelSpec(("kind",), skew=spec.skew), "value", [0.25, 0.75], ["q1", "q3"])
        found = q.join(tall.groupBy("kind").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                                                F.max(most).alias("max_mad")), "kind")
    iqr = F.col("q3") - F.col("q1")
    return found.select("kind", "min_value", (F.col("q1") - 1.5 * iqr).alias("lower"), (F.col("q3") + 1.5 * iqr).alias("upper"),
                        "max_value", "max_mad")
