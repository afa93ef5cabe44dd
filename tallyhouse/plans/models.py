"""The model graph (D-3): raw -> staging -> intermediate -> marts -> reconciliation.

Every model is a lazy DataFrame built on first access.  The four
intermediates are read by several marts and checks; ``materialize`` decides
what happens to them:

* ``"none"``: each output is one Catalyst plan from the raw scans (what a
  single ad-hoc query wants);
* ``"persist"``: cached on the executors (MEMORY_AND_DISK) for the duration of
  a build, released by :meth:`Models.release`;
* ``"table"``: written once as Parquet under the shared checkpoint folder
  (``spark.checkpoint.dir``) and read back -- computed once (an RDD
  ``checkpoint()`` of an uncached DataFrame computes it twice), and the lineage
  is cut, so a lost executor does not trigger recomputation from the raw scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tallyhouse.operators import bank as bank_ops
from tallyhouse.operators import clean, marts, recon, staging
from tallyhouse.sources.tables import RawTables

MODEL_NAMES = (
    "stg_orders", "stg_settlements", "stg_pos", "stg_products",
    "orders_deduplicated", "settlements_usd", "pos_classified", "products_resolved",
    "dim_date", "dim_product", "dim_store", "fact_order_lines", "fact_settlements",
    "revenue_reconciliation",
)


class Models:
    """Lazily built models over one :class:`RawTables`."""

    def __init__(self, raw: RawTables, persist: bool = False, bank: DataFrame | None = None,
                 materialize: str | None = None):
        self.raw = raw
        self.materialize = materialize or ("persist" if persist else "none")
        self._bank = bank
        self._cached: list[DataFrame] = []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if self.materialize == "persist":
            df = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            self._cached.append(df)
        elif self.materialize == "table":
            from tallyhouse.session import scratch_path
            path = scratch_path(df.sparkSession, f"model-{name}")
            df.write.parquet(path)
            df = df.sparkSession.read.parquet(path)
        return df

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()

    # staging ---------------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.shopify_orders)

    @cached_property
    def stg_settlements(self) -> DataFrame:
        return staging.stg_settlements(self.raw.amazon_settlements)

    @cached_property
    def stg_pos(self) -> DataFrame:
        return staging.stg_pos(self.raw.pos_transactions)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.product_master)

    # intermediate ----------------------------------------------------------
    @cached_property
    def orders_deduplicated(self) -> DataFrame:
        return self._keep(clean.orders_deduplicated(self.stg_orders), "orders_deduplicated")

    @cached_property
    def shopify_refunds(self) -> DataFrame:
        return clean.shopify_refunds(self.stg_orders)

    @cached_property
    def settlements_usd(self) -> DataFrame:
        return self._keep(clean.settlements_usd(self.stg_settlements), "settlements_usd")

    @cached_property
    def pos_classified(self) -> DataFrame:
        return self._keep(clean.pos_classified(self.stg_pos), "pos_classified")

    @cached_property
    def products_resolved(self) -> DataFrame:
        return self._keep(clean.products_resolved(self.stg_products), "products_resolved")

    # marts -----------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.orders_deduplicated, self.pos_classified,
                              self.settlements_usd)

    @cached_property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.products_resolved)

    @cached_property
    def dim_store(self) -> DataFrame:
        return marts.dim_store(self.pos_classified)

    @cached_property
    def order_lines(self) -> DataFrame:
        return marts.order_lines(self.orders_deduplicated, self.pos_classified)

    @cached_property
    def settlement_lines(self) -> DataFrame:
        return marts.settlement_lines(self.settlements_usd)

    @cached_property
    def fact_order_lines(self) -> DataFrame:
        return marts.fact_order_lines(self.orders_deduplicated, self.pos_classified)

    @cached_property
    def fact_settlements(self) -> DataFrame:
        return marts.fact_settlements(self.settlements_usd)

    # bank control ----------------------------------------------------------
    @cached_property
    def truth_lines(self) -> DataFrame | None:
        t = self.raw.truth_lines
        if t is not None and "okey" in t.columns:
            t = bank_ops.truth_from_fixture(t)
        return t

    @cached_property
    def bank_deposits(self) -> DataFrame:
        if self.raw.bank_deposits is not None:
            return self.raw.bank_deposits
        if self.truth_lines is None:
            raise ValueError("no bank feed: give bank_deposits or truth_lines")
        return bank_ops.bank_by_channel_day(self.truth_lines)

    @cached_property
    def bank(self) -> DataFrame:
        if self._bank is not None:
            return self._bank
        return bank_ops.bank_by_channel(self.bank_deposits)

    # reconciliation --------------------------------------------------------
    @cached_property
    def channel_nets(self) -> DataFrame:
        return recon.channel_nets(self.orders_deduplicated, self.shopify_refunds,
                                  self.pos_classified, self.settlements_usd)

    @cached_property
    def revenue_reconciliation(self) -> DataFrame:
        return recon.reconcile(self.channel_nets, self.bank)

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return recon.daily_revenue(self.orders_deduplicated, self.shopify_refunds,
                                   self.pos_classified, self.settlements_usd)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
