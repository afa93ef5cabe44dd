"""Data-quality checks (C-1..C-14): each check is a DataFrame of failing rows
(zero rows = pass), counted in one distributed aggregation per check.

Generic checks follow the usual semantics: ``unique``, ``accepted_values`` and
``relationships`` ignore NULLs; ``not_null`` fails on each NULL row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.recon import GUARDRAIL

# The category list the product dimension is checked against by
# default.  The driver data has its own list, passed as a parameter by the callers.
DEFAULT_CATEGORIES = ("Bedding", "Kitchen", "Decor", "Bath", "Outdoor", "Lighting")
CURRENCIES = ("USD", "CAD")


def unique(df: DataFrame, col: str) -> DataFrame:
    """C-1: values (non-NULL) that occur more than once, with their count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """C-2: rows where the column is NULL."""
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """C-3: distinct out-of-list values (NULL passes) with their row counts."""
    return (df.where(~F.col(col).isin(list(values))).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")))


def value_checks(df: DataFrame, model: str, allowed: dict[str, Iterable[str]]) -> DataFrame:
    """C-3 for several columns in one pass: per column the number of out-of-list
    values.  The rows are first reduced to the combinations that occur."""
    seen = df.groupBy(*allowed).agg(F.count(F.lit(1)).alias("n"))
    counts = seen.agg(*[F.count_distinct(F.when(~F.col(c).isin(list(v)), F.col(c))).alias(c)
                        for c, v in allowed.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f"accepted_values:{model}.{c}").alias("check_name"),
                 F.col(c).cast("bigint").alias("failing_rows")) for c in allowed])).alias("c")).select("c.*")


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """C-4 / J-3: child keys (non-NULL) missing from the parent, with line counts.

    The child is reduced to its distinct keys before the anti join, so the join
    input is bounded by the key count, not by the fact size.
    """
    keys = (child.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")))
    return keys.join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")


@dataclass(frozen=True)
class Check:
    name: str
    failing: DataFrame
    weight: str | None = None   # column holding a row multiplicity, if any


def _count(check: Check) -> DataFrame:
    n = F.sum(check.weight) if check.weight else F.count(F.lit(1))
    return check.failing.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failing_rows")) \
        .select(F.lit(check.name).alias("check_name"), "failing_rows")


def key_checks(df: DataFrame, model: str, col: str) -> DataFrame:
    """C-1 + C-2 in one pass: ``unique`` (duplicated non-NULL values) and
    ``not_null`` (NULL rows) from a single group-by on the key."""
    per_key = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.count_if(F.col(col).isNotNull() & (F.col("n") > 1)).cast("bigint").alias("u"),
        F.coalesce(F.sum(F.when(F.col(col).isNull(), F.col("n"))), F.lit(0))
        .cast("bigint").alias("nn"))
    return totals.select(F.explode(F.array(
        F.struct(F.lit(f"unique:{model}.{col}").alias("check_name"),
                 F.col("u").alias("failing_rows")),
        F.struct(F.lit(f"not_null:{model}.{col}").alias("check_name"),
                 F.col("nn").alias("failing_rows")))).alias("c")).select("c.*")


# What a build counts of a table while it writes it, by name: rows that break a rule,
# and rows of a kind.  So these need no scan of what was written.
def table_metrics() -> dict[str, dict[str, Column]]:
    def outside(col: str, values) -> Column:
        return F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))

    return {
        "settlements_usd": {"original_currency": outside("original_currency", CURRENCIES),
                            "cad": F.count_if(F.col("original_currency") == "CAD")},
        "pos_classified": {"line_type": outside("line_type", ("sale", "return")),
                           "returns": F.count_if(F.col("line_type") == "return")},
        "fact_order_lines": {"channel": outside("channel", ("shopify", "pos")),
                             "amazon": F.count_if(F.col("channel") == "amazon")},
        "fact_settlements": {"channel": outside("channel", ("amazon",)),
                             "original_currency": outside("original_currency", CURRENCIES)},
    }


def known_zero(m, model: str, *names: str) -> bool:
    """Whether the build of ``m`` has counted no such rows."""
    counted = getattr(m, "metrics", {}).get(model, {})
    return all(counted.get(n) == 0 for n in names)


def _passed(names: list[str], like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([(n, 0) for n in names], "check_name string, failing_rows bigint")


def gate_checks(m, categories: Iterable[str] = DEFAULT_CATEGORIES) -> list[Check | DataFrame]:
    """C-1..C-6: the checks that gate publishing, over a :class:`Models` (or
    the written tables).  Key checks are one pass per key; value checks on the
    facts read the fact rows without their surrogate key (same rows), so the
    key assignment is not recomputed for them."""
    cats = list(categories)
    keys = [("products_resolved", m.products_resolved, "sku"),
            ("dim_date", m.dim_date, "date_key"),
            ("dim_product", m.dim_product, "product_key"),
            ("dim_store", m.dim_store, "store_key"),
            ("fact_order_lines", m.fact_order_lines, "order_line_key"),
            ("fact_settlements", m.fact_settlements, "settlement_key")]
    checks: list[Check | DataFrame] = [key_checks(df, model, col) for model, df, col in keys]
    # A value check whose rows were counted as none while the table was written is settled.
    settled: list[str] = []
    for model, df, allowed in (
            ("settlements_usd", m.settlements_usd, {"original_currency": CURRENCIES}),
            ("pos_classified", m.pos_classified, {"line_type": ("sale", "return")}),
            ("dim_product", m.dim_product, {"category": cats}),
            ("fact_order_lines", m.order_lines, {"channel": ("shopify", "pos")}),
            ("fact_settlements", m.settlement_lines, {"channel": ("amazon",), "original_currency": CURRENCIES})):
        if known_zero(m, model, *allowed):
            settled += [f"accepted_values:{model}.{c}" for c in allowed]
        else:
            checks.append(value_checks(df, model, allowed))
    if settled:
        checks.append(_passed(settled, m.dim_product))
    checks += [
        Check("relationships:fact_order_lines.product_key",
              relationships(m.order_lines, "product_key", m.dim_product, "product_key"),
              weight="n_records"),
    ]
    r = m.revenue_reconciliation
    checks += [
        Check("assert_shopify_reconciles",
              r.where((F.col("channel") == "shopify") & (F.col("status") != "RECONCILED"))),
        Check("assert_no_channel_wildly_off", r.where(F.col("gap_pct") > F.lit(GUARDRAIL))),
    ]
    return checks


def check_results(checks: list[Check | DataFrame]) -> DataFrame:
    """One row per check: (check_name, failing_rows)."""
    return reduce(DataFrame.unionByName,
                  [c if isinstance(c, DataFrame) else _count(c) for c in checks])


def uncovered_dates(dim_date: DataFrame, *facts: DataFrame) -> DataFrame:
    """C-14 / J-4: fact activity dates with no row in the date dimension."""
    dates = (reduce(DataFrame.union, [f.select("activity_date") for f in facts])
             .where(F.col("activity_date").isNotNull()).distinct())
    return dates.join(dim_date.select(F.col("date_key").alias("activity_date")),
                      "activity_date", "left_anti")


def model_assertions(m) -> DataFrame:
    """C-7..C-14: the model-level assertions as (check_name, observed, passed)."""
    def one(name: str, df: DataFrame, observed, passed) -> DataFrame:
        return df.agg(observed.cast("bigint").alias("observed")).select(
            F.lit(name).alias("check_name"), "observed", passed(F.col("observed")).alias("passed"))

    zero = lambda c: c == 0          # noqa: E731
    positive = lambda c: c > 0       # noqa: E731
    cnt = F.count(F.lit(1))
    counted = getattr(m, "metrics", {})

    def rows(model: str, metric: str) -> Column | None:
        """A count that the build has made already."""
        n = counted.get(model, {}).get(metric)
        return None if n is None else F.lit(n)

    def of(name: str, df: DataFrame, condition: Column, known: Column | None, passed) -> DataFrame:
        if known is None:
            return one(name, df.where(condition), cnt, passed)
        return df.sparkSession.range(1).select(F.lit(name).alias("check_name"), known.cast("bigint").alias("observed"),
                                               passed(known).alias("passed"))

    # Both questions about staged point-of-sale rows are asked in one pass.
    staged = m.stg_pos.agg(F.count_if(F.col("txn_type") == "sale").alias("sales"),
                           F.count_if(F.col("txn_type") == "training").alias("training"))
    kept = rows("pos_classified", "rows")
    if kept is None:
        staged = staged.withColumn("k", F.lit(0)).join(m.pos_classified.agg(cnt.alias("kept"), F.lit(0).alias("k")), "k")
    else:
        staged = staged.withColumn("kept", kept)
    two = staged.select(F.explode(F.array(
        F.struct(F.lit("classified_minus_staging_sales").alias("check_name"),
                 (F.col("sales") - F.col("kept")).cast("bigint").alias("observed"),
                 (F.col("sales") == F.col("kept")).alias("passed")),
        F.struct(F.lit("training_rows_in_staging").alias("check_name"), F.col("training").cast("bigint").alias("observed"),
                 (F.col("training") > 0).alias("passed")))).alias("c")).select("c.*")
    parts = [
        one("duplicate_deduped_lines",
            unique(m.orders_deduplicated.select(
                F.struct("order_id", "sku", "quantity", "unit_price").alias("k")), "k"),
            cnt, zero),
        two,
        of("returns_identified", m.pos_classified, F.col("line_type") == "return", rows("pos_classified", "returns"), positive),
        of("cad_rows", m.settlements_usd, F.col("original_currency") == "CAD", rows("settlements_usd", "cad"), positive),
        one("duplicate_product_skus", unique(m.products_resolved, "sku"), cnt, zero),
        one("settlement_rows_without_order_id",
            m.stg_settlements.where(F.col("order_id").isNull()), cnt, zero),
        of("amazon_in_order_fact", m.order_lines, F.col("channel") == "amazon", rows("fact_order_lines", "amazon"), zero),
        one("residual_without_reason",
            m.revenue_reconciliation.where((F.col("status") == "RESIDUAL")
                                           & F.col("residual_reason").isNull()), cnt, zero),
        one("control_missing_or_not_positive",
            m.revenue_reconciliation.where(F.col("bank_net_revenue").isNull()
                                           | (F.col("bank_net_revenue") <= 0)), cnt, zero),
        one("fact_dates_missing_from_dim_date",
            uncovered_dates(m.dim_date, m.order_lines, m.settlement_lines), cnt, zero),
    ]
    return reduce(DataFrame.unionByName, parts)
