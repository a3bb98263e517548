"""Panel description: which columns form a group, which order its rows.

Every group-aware operator takes a :class:`PanelSpec`; nothing is wired to a
particular column name.

Skew: a panel group is normally small (a customer has a handful of months),
but one key may hold a large share of all rows. :class:`SkewPolicy` names the
size above which a group is *hot*. Operators run bounded groups through plain
window functions (one exchange on the group key) and hot groups through
split plans (chunked scans, exact quantiles by radix selection) whose every task
is bounded. Hot keys are found once per panel with a partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPolicy:
    # A group with more rows than this is processed by the split plans.
    hot_rows: int = 2_000_000
    # Target rows per chunk of a hot group in ordered scans.
    chunk_rows: int = 1_000_000
    # Hot-key tables up to this many rows are broadcast (size checked by count).
    broadcast_keys: int = 200_000


@dataclass
class PanelSpec:
    group: tuple[str, ...]
    order: tuple[str, ...] = ()
    id: str | None = None
    skew: SkewPolicy = field(default_factory=SkewPolicy)
    # column that already holds the isolating key of :meth:`window_cols`
    iso: str | None = None
    # hot keys already computed, for as long as the frame is alive
    _hot_cache: WeakKeyDictionary = field(default_factory=WeakKeyDictionary, repr=False, compare=False)

    def __post_init__(self):
        if isinstance(self.group, str):
            self.group = (self.group,)
        if isinstance(self.order, str):
            self.order = (self.order,)
        self.group = tuple(self.group)
        self.order = tuple(self.order)

    # -- helpers ---------------------------------------------------------
    def with_group(self, *group: str) -> "PanelSpec":
        return PanelSpec(tuple(group), self.order, self.id, self.skew,
                         self.iso if set(self.group) <= set(group) else None)

    def order_cols(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in self.order]

    def reverse_order_cols(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() for c in self.order]

    def order_struct(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def null_key(self) -> Column:
        """True when any group key is NULL (pandas drops such rows from groups)."""
        cond = F.lit(False)
        for g in self.group:
            cond = cond | F.col(g).isNull()
        return cond

    def window_cols(self) -> list[Column]:
        """Partition columns of a group window."""
        return [F.col(c) for c in (*self.group, *([self.iso] if self.iso else []))]

    def isolating(self) -> Column:
        """0 for a row with a full key, else a hash of the row: partitioned by
        the group and this, rows of no group are spread instead of meeting."""
        own = [*self.order, *([self.id] if self.id else [])]
        return F.coalesce(F.when(self.null_key(), F.xxhash64(*[F.col(c) for c in own or self.group])), F.lit(0).cast("long"))

    # -- hot groups ------------------------------------------------------
    def hot_keys(self, df: DataFrame) -> "HotKeys":
        """Group keys with more than ``skew.hot_rows`` rows (one small job).

        Row-preserving operators keep group sizes, so callers may pass the
        result along instead of recomputing it.
        """
        key = (self.group, self.skew.hot_rows)
        found = self._hot_cache.setdefault(df, {})
        if key in found:
            return found[key]
        sizes = (df.groupBy(*self.group).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") > self.skew.hot_rows))
        # a partial aggregate over the key columns only: cheap
        r = sizes.agg(F.count_if(~self.null_key()).alias("hot"), F.count_if(self.null_key()).alias("null")).first()
        hk = HotKeys(sizes.where(~self.null_key()), r["hot"], self, r["null"] > 0)
        found[key] = hk
        return hk


@dataclass
class HotKeys:
    table: DataFrame | None   # group keys + _n, one row per hot group
    count: int
    spec: PanelSpec
    # more rows without a full key than a hot group has: they are routed
    # around the windows instead of meeting in one task
    null_hot: bool = False

    @staticmethod
    def none(spec: PanelSpec) -> "HotKeys":
        """Known to have no hot group (e.g. a finer grouping of a panel whose
        coarser groups are all bounded): no job needed."""
        return HotKeys(None, 0, spec)

    def without_nulls(self) -> "HotKeys":
        return HotKeys(self.table, self.count, self.spec)

    def refine(self, finer: PanelSpec) -> "HotKeys | None":
        """Hot keys of a grouping that adds columns to this one: none if this
        one has none (a sub-group is never larger than its group); otherwise
        unknown (``None``), to be computed."""
        if not self.any and not self.null_hot and set(self.spec.group) <= set(finer.group) and finer.iso == self.spec.iso:
            return HotKeys.none(finer)
        return None

    @property
    def any(self) -> bool:
        return self.count > 0

    def side(self) -> DataFrame:
        """The hot-key table as a join side; broadcast only when its row count
        was checked to be within the policy bound."""
        if self.count <= self.spec.skew.broadcast_keys:
            return F.broadcast(self.table)
        return self.table

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of bounded groups, rows of hot groups)."""
        keys = list(self.spec.group)
        side = self.side().select(*keys)
        return df.join(side, keys, "left_anti"), df.join(side, keys, "left_semi")
