"""List-in-a-string columns.

'A, B, and C' style strings become arrays; the last K items are spread into
right-aligned columns ``<prefix>_K .. <prefix>_1`` (``_1`` = last item), short
lists padded with a filler on the left. Each element is left-stripped of a
character *set* (pandas ``lstrip`` semantics), which removes the 'and '.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

# List separator, filler for missing items, stripped character set.
SEP = ", "
FILLER = "No Loan"
STRIP = "and "


def items(col: str, sep: str = SEP, filler: str = FILLER, strip: str = STRIP) -> Column:
    """Array of cleaned items; a NULL list is one filler item."""
    arr = F.split(F.coalesce(F.col(col), F.lit(filler)), sep, -1)
    return F.transform(arr, lambda x: F.ltrim(x, F.lit(strip)))


def list_width(df: DataFrame, col: str, sep: str = SEP) -> int:
    """K: the longest list (one aggregate; a NULL list counts as 1)."""
    k = df.agg(F.max(F.coalesce(F.size(F.split(F.col(col), sep, -1)), F.lit(1)))).first()[0]
    return int(k or 1)


def expand(df: DataFrame, col: str, k: int | None = None, prefix: str = "Last_Loan",
           sep: str = SEP, filler: str = FILLER, strip: str = STRIP, drop: bool = True) -> DataFrame:
    """S9 + S10: ``prefix_K .. prefix_1`` columns, right-aligned. ``k``
    defaults to the longest list (a one-number pre-pass). A list longer than
    a given ``k`` is an error: no item is dropped."""
    arr = items(col, sep, filler, strip)
    if k:
        arr = F.when(F.size(arr) > k, F.raise_error(F.concat(
            F.lit(f"{col} has more than {k} items: "), F.size(arr).cast("string")))).otherwise(arr)
    k = k or list_width(df, col, sep)
    out = df.withColumn("_items", arr)
    cols = {f"{prefix}_{i}": F.coalesce(F.try_element_at(F.col("_items"), F.lit(-i)), F.lit(filler))
            for i in range(k, 0, -1)}
    out = out.withColumns(cols).drop("_items")
    return out.drop(col) if drop else out


def count_items(col: str, sep: str = SEP) -> Column:
    """S7 + C10: number of items, 0 for a NULL list."""
    return F.coalesce(F.size(F.split(F.col(col), sep, -1)), F.lit(0))


def vocabulary(df: DataFrame, col: str, sep: str = SEP, filler: str = FILLER, strip: str = STRIP) -> DataFrame:
    """Distinct cells of the expanded lists: every cleaned item, and
    the filler as soon as one list is NULL or shorter than the longest."""
    arr = items(col, sep, filler, strip)
    cells = df.select(F.explode(arr).alias("item")).distinct()
    n = F.size(arr)
    padded = (df.agg(F.min(n).alias("a"), F.max(n).alias("b")).where("a < b")
              .select(F.lit(filler).alias("item")))
    return cells.unionByName(padded).distinct()
