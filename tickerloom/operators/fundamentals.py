"""Fundamentals: canonical names, derived items, section merge and failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.panel import keep_newest

#: Raw line items and their canonical names; a leading underscore marks helpers that are dropped.
CANONICAL = {
    "sales": "total_revenue",
    "revenue": "total_revenue",
    "expenses": "operating_expenses",
    "other_income": "other_income",
    "operating_profit": "ebitda",
    "depreciation": "depreciation",
    "interest": "interest_expense",
    "profit_before_tax": "pbt",
    "net_profit": "net_profit",
    "eps_in_rs": "eps",
    "equity_capital": "_share_capital",
    "share_capital": "_share_capital",
    "reserves": "_reserves",
    "reserves_surplus": "_reserves",
    "borrowings": "total_debt",
    "borrowing": "total_debt",
    "other_liabilities": "other_liabilities",
    "total_assets": "total_assets",
    "fixed_assets": "fixed_assets",
    "cwip": "cwip",
    "investments": "investments",
    "other_assets": "other_assets",
    "cash_from_operating_activity": "cfo",
    "cash_from_investing_activity": "cfi",
    "cash_from_financing_activity": "cff",
    "net_cash_flow": "net_cash_flow",
    "free_cash_flow": "fcf",
}
#: Raw items that are ratios or are computed anew.
DROPPED = ("total_liabilities", "opm", "tax", "cfo_op", "dividend_payout")


def _names(spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(CANONICAL.items()), "line_item string, canonical string"))


def canonical(raw: DataFrame) -> DataFrame:
    """(symbol, date, parameter, value) of raw items (symbol, date, line_item, value): known names are mapped, artefacts dropped, unknown names kept. Of several raw names of one parameter in a period the largest value counts."""
    own = raw.where(~F.col("line_item").isin(*DROPPED) & F.col("value").isNotNull())
    named = own.join(_names(raw.sparkSession), "line_item", "left")
    return named.groupBy("symbol", "date", F.coalesce("canonical", "line_item").alias("parameter")).agg(F.max("value").alias("value"))


def _pair(panel: DataFrame, out: str, a: str, b: str, sign: int) -> DataFrame:
    """The sum or difference of two parameters where both exist."""
    value = lambda n: F.max(F.when(F.col("parameter") == n, F.col("value")))
    both = panel.where(F.col("parameter").isin(a, b)).groupBy("symbol", "date").agg(value(a).alias("a"), value(b).alias("b"))
    return both.where("a is not null and b is not null").select("symbol", "date", F.lit(out).alias("parameter"), (F.col("a") + sign * F.col("b")).alias("value"))


def derived(panel: DataFrame, annual: bool = False) -> DataFrame:
    """panel with ebit and tax_implied; annual ones also with net_equity, total_liabilities, and fcf for symbols that have none at all. Helpers are dropped."""
    out = panel.unionByName(_pair(panel, "ebit", "ebitda", "depreciation", -1)).unionByName(_pair(panel, "tax_implied", "pbt", "net_profit", -1))
    if annual:
        equity = _pair(panel, "net_equity", "_share_capital", "_reserves", 1)
        debts = _pair(panel.unionByName(equity), "total_liabilities", "total_assets", "net_equity", -1)
        have = panel.where("parameter = 'fcf'").select("symbol").distinct()
        flow = _pair(panel, "fcf", "cfo", "cfi", 1).join(have, "symbol", "left_anti")
        out = out.unionByName(equity).unionByName(debts).unionByName(flow.select(out.columns))
    return out.where(~F.col("parameter").startswith("_"))


def merge_sections(items: DataFrame) -> DataFrame:
    """items (symbol, section_order, line_item, date, value) with each line item only from the first section of its symbol that has it."""
    first = F.min("section_order").over(Window.partitionBy("symbol", "line_item"))
    own = items.withColumn("_first", first).where("section_order = _first").drop("_first")
    return keep_newest(own, ["symbol", "line_item", "date"], [F.desc_nulls_last("value")])


def failures(symbols: DataFrame, pages: DataFrame, parsed: DataFrame, recent) -> DataFrame:
    """(symbol, reason) of symbols without usable figures: no page, nothing parsed, no quarterly rows, or none of them since `recent`. parsed is (symbol, period, date)."""
    have = pages.select("symbol").distinct().withColumn("_page", F.lit(True))
    seen = parsed.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("period") == "quarterly", F.col("date"))).alias("_last"), F.count_if(F.col("period") == "quarterly").alias("_q"))
    out = symbols.select("symbol").distinct().join(have, "symbol", "left").join(seen, "symbol", "left")
    old = F.col("_last").isNull() | (F.col("_last") < F.lit(recent).cast("date"))
    reason = F.when(F.col("_page").isNull(), "PageFetchFailed").when(F.col("_n").isNull(), "ParseFailed").when(F.col("_q") == 0, "NoQuarterlyData").when(old, "NoRecentData")
    return out.select("symbol", reason.alias("reason")).where("reason is not null")
