"""Panel recipes as data: a list of steps compiled into shared group passes.

A :class:`Step` names a column, the condition under which its value is a
mistake, the rule that fills it from its group and its final type. All null
rules are one projection; all medians, all fills in panel order, all modes and
all counters are one level each (:mod:`panel_levels`), whatever the number of
columns, for bounded and hot groups alike. Columns derived from the cleaned
ones come last.

Rows without a key keep their values; a group without any value of a column
stays NULL there.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec
from .panel_levels import placed, union

# How a step fills its column from the group.
FILL = "ffill_bfill"                # G1
MEDIAN, SET_MEDIAN = "median", "set_median"                                  # G4, G5
MODE_MEDIAN_INT, MODE_MEAN, SMALLEST_MODE = "mode_median_int", "mode_mean", "smallest_mode"   # G6, G7, G8
MODE_OR_FILL = "mode_or_fill"       # G9
COUNTER = "counter"                 # G15
RULES = (FILL, MEDIAN, SET_MEDIAN, MODE_MEDIAN_INT, MODE_MEAN, SMALLEST_MODE, MODE_OR_FILL, COUNTER)


@dataclass(frozen=True)
class Step:
    column: str
    null: str | None = None     # SQL condition: the value is set NULL
    fill: str | None = None     # one of RULES
    type: str | None = None     # cast at the end


def run(df: DataFrame, steps: list[Step], spec: PanelSpec, derive: dict[str, str] | None = None,
        columns: list[str] | None = None) -> DataFrame:
    """``df`` with every step applied; ``derive`` gives further columns as SQL
    over the cleaned ones, ``columns`` the result's columns."""
    for s in steps:
        if s.fill is not None and s.fill not in RULES:
            raise ValueError(f"{s.column}: unknown rule {s.fill}")
        if s.column in (*spec.group, *spec.order):
            raise ValueError(f"{s.column} places the rows of a group and cannot be a step")
    names = [s.column for s in steps]
    if len(set(names)) < len(names):
        raise ValueError("a column has more than one step")
    own = list(df.columns)
    df = df.withColumn("_iso", spec.isolating())
    spec = replace(spec, iso="_iso")
    null = {s.column: F.when(F.expr(s.null), F.lit(None)).otherwise(F.col(s.column)) for s in steps if s.null}
    df = df.withColumns(null) if null else df

    def by(*rules: str) -> list[str]:
        return [s.column for s in steps if s.fill in rules]
    medians, fills = by(MEDIAN, SET_MEDIAN), by(FILL, MODE_OR_FILL)
    modes, counters = by(MODE_MEDIAN_INT, MODE_MEAN, SMALLEST_MODE, MODE_OR_FILL), by(COUNTER)
    spread = set(by(MODE_MEDIAN_INT))
    hot = bool(steps) and spec.hot_keys(df).any
    done = []
    for lv, src in placed(df, spec, hot):
        d = lv.deviations(src, medians, []) if medians else src
        if fills or counters:
            d = lv.fills(d, {f"_ff_{c}": c for c in fills})
        if modes:
            d = lv.modes(d, modes, spread, src)
        for c in counters:
            d = lv.anchor(d, c, src, f"_anc_{c}")
        new = {}
        for s in steps:
            c, x = F.col(s.column), F.col(s.column).cast("double")
            n, first = F.col(f"_n_{s.column}"), F.col(f"_min_{s.column}")
            out = {
                None: lambda: c, FILL: lambda: F.col(f"_ff_{s.column}"),
                MEDIAN: lambda: F.coalesce(x, F.col(f"_med_{s.column}")), SET_MEDIAN: lambda: F.col(f"_med_{s.column}"),
                MODE_MEDIAN_INT: lambda: F.coalesce(x, F.when(n == 1, first.cast("double")).otherwise(
                    F.col(f"_median_{s.column}").cast("long").cast("double"))),
                MODE_MEAN: lambda: F.coalesce(x, F.when(n == 1, first.cast("double")).otherwise(F.col(f"_mean_{s.column}"))),
                SMALLEST_MODE: lambda: F.coalesce(c, first),
                MODE_OR_FILL: lambda: F.when(n == 1, first).otherwise(F.col(f"_ff_{s.column}")),
                COUNTER: lambda: F.col(f"_anc_{s.column}.v") + (F.col("_pos") - F.col(f"_anc_{s.column}.p")),
            }[s.fill]()
            keep = F.when(spec.null_key(), c).otherwise(out) if s.fill else out
            new[s.column] = keep.cast(s.type) if s.type else keep
        d = d.withColumns(new).select(*own)
        d = d.withColumns({c: F.expr(e) for c, e in (derive or {}).items()})
        done.append(d.select(*columns) if columns else d)
    return union(done)


# Caps of the modelling variant of the credit recipe, its derived
# feature and the columns its model takes.
MODELLING = [
    Step("Age", "Age > 100 OR Age <= 0", FILL, "int"),
    Step("Occupation", None, FILL),
    Step("Annual_Income", "Annual_Income > 180000", FILL),
    Step("Monthly_Inhand_Salary", None, FILL),
    Step("Num_Credit_Card", "Num_Credit_Card > 11", FILL),
    Step("Interest_Rate", "Interest_Rate > 34", SET_MEDIAN),
    Step("Credit_Mix", None, FILL),
]
MODELLING_DERIVED = {"EMI_Salary_Ratio": "Total_EMI_per_month / (Monthly_Inhand_Salary + 1)"}
MODELLING_COLUMNS = ["ID", "Customer_ID", *[s.column for s in MODELLING], "Credit_Utilization_Ratio", "EMI_Salary_Ratio", "Credit_Score"]


def modelling_panel(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    """The modelling variant: value caps in place of fences, forward and
    backward fills within the customer, the median interest rate for every
    row, and the ratio of instalments to salary."""
    from .credit_panel import type_repair
    return run(type_repair(raw), MODELLING, spec, MODELLING_DERIVED, MODELLING_COLUMNS)
