"""Raw relations over the driver tables.

The engine's models read five raw relations -- order rows, settlement rows,
point-of-sale rows, product master rows and the bank deposit feed -- plus the
ground-truth order lines the bank feed is computed from.  In production the
first four are landed from files (:mod:`tallyhouse.sources.files`,
:mod:`tallyhouse.sources.manifest`).  Here they are *derived* from the driver's
``orders``/``lineitem``/``part`` tables with the fixture definition of
FIXTURES.md section 3, so that the work grows with the tables and DuckDB can run
the identical text as the oracle.

The fixture text is a fixed definition (it must stay byte-for-byte what was
proven identical on both engines), so it is kept here as SQL and run through
``spark.sql`` with DataFrame parameters; Catalyst prunes the scans to the
columns each view uses and pushes the channel filters into the join input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import ensure_conf, scratch_path

# Driver tables used by the fixture, with the columns each one contributes.
DRIVER_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                 "l_quantity", "l_returnflag"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "part": ["p_partkey", "p_name", "p_type", "p_retailprice"],
}

# ---------------------------------------------------------------------------
# The fixture definition of FIXTURES.md section 3, one SELECT per
# view, in dependency order.  Placeholders in braces name the inputs.
# ---------------------------------------------------------------------------
FIXTURE_VIEWS: list[tuple[str, str]] = [
    ("fx_lines", """
select l_orderkey as okey, l_linenumber as lno, l_suppkey as supp, l_partkey as pkey,
  cast(o_orderdate as date) as odate, cast(l_quantity as int) as qty,
  cast(p_retailprice as decimal(12,2)) as price,
  cast(cast(l_quantity as int) * cast(p_retailprice as decimal(12,2)) as decimal(12,2)) as gross,
  'BB-' || upper(substring(p_type,1,3)) || '-' || lpad(cast(l_partkey as string),6,'0') as sku,
  case when l_orderkey % 20 < 9 then 'shopify' when l_orderkey % 20 < 16 then 'amazon' else 'pos' end as channel,
  'store_' || lpad(cast(1 + o_custkey % 12 as string),2,'0') as store,
  l_returnflag = 'R' and l_linenumber = 1 as refunded, cast(3 + l_orderkey % 42 as int) as lag_days
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey
"""),
    ("raw_shopify_orders", """
with o as (select 'SHOP-' || cast(okey as string) as order_id, cast(odate as timestamp) as created_at, sku, qty as quantity, price,
   'order' as record_type, cast(null as decimal(12,2)) as refund_amount,
   'orders_page_' || lpad(cast(okey % 500 as string),3,'0') || '.json' as source_file, okey from {fx_lines} where channel='shopify')
select order_id, created_at, sku, quantity, price, record_type, refund_amount, source_file from o
union all select order_id, created_at, sku, quantity, price, record_type, refund_amount, 'orders_page_999.json' from o where okey % 50 = 1
union all select 'SHOP-' || cast(okey as string), cast(max(odate) + max(lag_days) * interval '1' day as timestamp), null, null, null, 'refund', cast(sum(gross) as decimal(12,2)), 'orders_page_998.json'
  from {fx_lines} where channel='shopify' and refunded group by okey
"""),
    ("raw_amazon_settlements", """
select 'AMZ-' || cast(okey as string) as amazon_order_id, sku, qty as quantity, gross as gross_amount,
  cast(round(gross * 0.15, 2) as decimal(12,2)) as fee_amount, cast(gross - round(gross * 0.15, 2) as decimal(12,2)) as net_amount,
  case when supp % 33 = 0 then 'CAD' when supp % 33 = 1 then null when supp % 33 = 2 then 'usd' else 'USD' end as currency,
  cast(date_trunc('week', cast(odate + interval '14' day as timestamp)) as date) as settlement_date, 'settlement_' || cast(odate as string) || '.csv' as source_file
from {fx_lines} where channel='amazon'
"""),
    ("raw_pos_transactions", """
with p as (select *, store || '_' || cast(odate as string) || '.csv' as source_file from {fx_lines} where channel='pos' and not (store in ('store_04','store_09') and okey % 12 = 7))
select store as store_id, case when store='store_07' then cast(odate as timestamp) + interval '40' minute else cast(odate as timestamp) end as txn_timestamp, sku, qty as quantity, gross as amount, 'sale' as txn_type, source_file from p
union all select store, cast(odate + lag_days * interval '1' day as timestamp), sku, -qty, cast(-gross as decimal(12,2)), 'sale', source_file from p where refunded
union all select store, cast(odate as timestamp), sku, -1, cast(-price as decimal(12,2)), 'training', source_file from p where store='store_11' and lno = 2
"""),
    ("raw_product_master", """
with c as (select p_partkey as k, 'BB-' || upper(substring(p_type,1,3)) || '-' || lpad(cast(p_partkey as string),6,'0') as sku, p_name as product_name, p_type as category,
  cast(round(cast(p_retailprice as decimal(12,2)) * 0.40, 2) as decimal(12,2)) as unit_cost, cast(p_retailprice as decimal(12,2)) as unit_price from {part})
select case when k % 7 = 0 then replace(sku,'BB-','BLB') else sku end as sku, product_name, category, unit_cost, unit_price, 'product_master.xlsx' as source_file from c
union all select sku, product_name, category, cast(round(unit_cost * 1.2, 2) as decimal(12,2)), unit_price, 'product_master.xlsx' from c where k % 250 = 0
"""),
    ("bank_deposits", """
select deposit_date, channel, cast(sum(amount) as decimal(38,2)) as net_deposit from (
  select odate as deposit_date, channel, cast(round(case when channel='amazon' then gross * 0.85 else gross * 1.00 end, 2) as decimal(14,2)) as amount from {fx_lines}
  union all select cast(odate + lag_days * interval '1' day as date), channel, cast(round(case when channel='amazon' then -gross * 0.85 else -gross * 1.00 end, 2) as decimal(14,2)) from {fx_lines} where refunded) t
group by deposit_date, channel
"""),
]

RAW_NAMES = ("raw_shopify_orders", "raw_amazon_settlements", "raw_pos_transactions",
             "raw_product_master")


@dataclass(frozen=True)
class RawTables:
    """The raw layer the models read (one DataFrame per landed source)."""

    shopify_orders: DataFrame
    amazon_settlements: DataFrame
    pos_transactions: DataFrame
    product_master: DataFrame
    bank_deposits: DataFrame | None = None   # channel-day bank feed (control)
    truth_lines: DataFrame | None = None     # ground-truth order lines

    def replace(self, **kw) -> "RawTables":
        d = {k: getattr(self, k) for k in self.__dataclass_fields__}
        d.update(kw)
        return RawTables(**d)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table, selecting only the columns the fixture uses."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cols = DRIVER_COLUMNS.get(name)
    return df.select(*cols) if cols else df


CHANNELS = ("shopify", "amazon", "pos")


def _stored_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The order lines, written in a folder a channel: a channel's rows are joined once,
    however many views read them."""
    path = scratch_path(spark, "fixture-lines")
    for channel in CHANNELS:
        lines.where(F.col("channel") == channel).drop("channel").write.option("compression", "zstd") \
            .parquet(f"{path}/channel={channel}")
    return spark.read.schema(lines.schema).parquet(path).select(lines.columns)


def fixture_views(spark: SparkSession, sf_dir: str, stored: bool = False) -> dict[str, DataFrame]:
    """All fixture views as lazy DataFrames, keyed by view name.

    With ``stored`` the order lines, which all of them but the products read, are
    written first and read back.
    """
    ensure_conf(spark)
    frames: dict[str, DataFrame] = {
        name: read_driver_table(spark, sf_dir, name) for name in DRIVER_COLUMNS
    }
    for name, body in FIXTURE_VIEWS:
        frames[name] = spark.sql(body, **frames)
        if stored and name == "fx_lines":
            frames[name] = _stored_lines(spark, frames[name])
    return frames


def adapter_raw(spark: SparkSession, sf_dir: str, stored: bool = False) -> RawTables:
    """The raw layer derived from the driver tables (lazy, unless the lines are
    ``stored``; nothing collected)."""
    v = fixture_views(spark, sf_dir, stored)
    return RawTables(
        shopify_orders=v["raw_shopify_orders"],
        amazon_settlements=v["raw_amazon_settlements"],
        pos_transactions=v["raw_pos_transactions"],
        product_master=v["raw_product_master"],
        bank_deposits=v["bank_deposits"],
        truth_lines=v["fx_lines"],
    )


def fixture_cte_sql() -> str:
    """The fixture as a DuckDB/ANSI ``WITH`` list (no trailing SELECT).

    The oracle queries append their own CTEs and final SELECT to this.
    """
    names = {n: n for n in DRIVER_COLUMNS}
    names.update({n: n for n, _ in FIXTURE_VIEWS})
    parts = [f"{name} as ({body.strip().format(**names)})" for name, body in FIXTURE_VIEWS]
    return "with " + ",\n".join(parts)
