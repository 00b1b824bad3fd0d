"""Symbol history, the point-in-time universe and its metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import asof_join
from tickerloom.operators.panel import keep_newest
from tickerloom.operators.timeline import calendar_asof


def symbol_history(daily: DataFrame, listed: DataFrame) -> DataFrame:
    """(symbol, first_seen_date, last_seen_date, status, isin, source): first and last day in the daily files; no last day for symbols of the global last day."""
    seen = daily.groupBy("symbol").agg(F.min("date").alias("first_seen_date"), F.max("date").alias("last"))
    end = F.broadcast(daily.agg(F.max("date").alias("_end")))
    own = seen.join(end, F.lit(True)).join(listed.select("symbol", "isin", F.lit(True).alias("_listed")), "symbol", "left")
    return own.select("symbol", "first_seen_date", F.when(F.col("last") < F.col("_end"), F.col("last")).alias("last_seen_date"),
                      F.when(F.col("_listed"), "active").otherwise("delisted").alias("status"), "isin", F.lit("daily").alias("source"))


def raw_universe(live: DataFrame, existing: DataFrame, supplement: DataFrame, history: DataFrame) -> DataFrame:
    """Symbols of all sources, the first source winning whole; status and ISIN anew from the live list. No symbol is ever lost."""
    columns = ["symbol", "isin", "company_name", "listing_date", "delisting_date", "status"]
    parts = None
    for i, df in enumerate((live, existing, supplement, history)):
        have = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("date" if c.endswith("date") else "string").alias(c) for c in columns)).withColumn("_p", F.lit(i))
        parts = have if parts is None else parts.unionByName(have)
    one = keep_newest(parts.where("symbol is not null"), ["symbol"], [F.asc("_p"), *(F.col(c).desc_nulls_last() for c in columns[1:])]).drop("_p")
    now = live.groupBy("symbol").agg(F.max("isin").alias("_isin")).withColumn("_live", F.lit(True))
    one = one.join(now, "symbol", "left")
    return one.select("symbol", F.coalesce("_isin", "isin").alias("isin"), "company_name", "listing_date", "delisting_date", F.when(F.col("_live"), "active").otherwise("delisted").alias("status"))


def pit_universe(quotes: DataFrame, cal: DataFrame, quarters: DataFrame, shares: DataFrame, top_n: int = 500, tolerance_days: int = 7) -> DataFrame:
    """The top_n symbols by market capitalisation of each quarter: close of the last trading day within the tolerance, shares of the last filing not after the quarter's end."""
    days = calendar_asof(quarters, cal, "quarter_end_date", tolerance_days).select("quarter_end_date", F.col("snap_date").alias("date"))
    # Spark takes the semi-join down to the rows that quotes are made of, if they are a view
    closes = quotes.join(F.broadcast(days.select("date").distinct()), "date", "left_semi").join(F.broadcast(days), "date").where("close is not null").select("quarter_end_date", "symbol", F.col("close").alias("close_inr"))
    filed = shares.select("symbol", F.col("date").alias("filing_date"), F.col("total_shares").cast("double").alias("shares_outstanding"), F.col("free_float_shares").cast("double").alias("free_float_shares"))
    sized = asof_join(closes, filed, ["symbol"], "quarter_end_date", "filing_date", how="inner")
    sized = sized.withColumns({"market_cap_inr": F.col("close_inr") * F.col("shares_outstanding"), "free_float_market_cap_inr": F.col("close_inr") * F.col("free_float_shares")})
    rank = F.row_number().over(Window.partitionBy("quarter_end_date").orderBy(F.desc("market_cap_inr"), "symbol"))
    ranked = sized.where("market_cap_inr > 0").withColumn("rank", rank).where(F.col("rank") <= top_n)
    return ranked.select("quarter_end_date", "rank", "symbol", "market_cap_inr", "free_float_market_cap_inr", "close_inr", "shares_outstanding", "free_float_shares")


def metadata(universe: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Every symbol that was ever in the universe, its first and last quarter, and what the raw universe knows of it."""
    spans = universe.groupBy("symbol").agg(F.min("quarter_end_date").alias("first_in_universe_date"), F.max("quarter_end_date").alias("last_in_universe_date"))
    names = ["isin", "company_name", "sector", "industry", "status"]
    if raw is None:
        known = spans
    else:
        known = spans.join(keep_newest(raw, ["symbol"], [F.col(c).desc_nulls_last() for c in raw.columns if c != "symbol"]), "symbol", "left")
    padded = known.withColumns({c: F.lit(None).cast("string") for c in names if c not in known.columns})
    return padded.select("symbol", "isin", "company_name", "sector", "industry", "first_in_universe_date", "last_in_universe_date", "status")


def prune(panel: DataFrame, meta: DataFrame) -> DataFrame:
    """Rows of symbols in the metadata."""
    return panel.join(meta.select("symbol").distinct(), "symbol", "left_semi")


def resolve_classification(symbols: DataFrame, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """(symbol, macro_sector, sector, industry, basic_industry, source): the first source with a record wins whole; blanks become UNKNOWN."""
    levels = ["macro_sector", "sector", "industry", "basic_industry"]
    parts = None
    for i, (name, df) in enumerate(sources):
        have = df.select("symbol", *levels, F.lit(name).alias("source"), F.lit(i).alias("_p"))
        parts = have if parts is None else parts.unionByName(have)
    one = keep_newest(parts, ["symbol"], [F.asc("_p"), *(F.col(c).desc_nulls_last() for c in levels)]).drop("_p")
    out = symbols.select("symbol").distinct().join(one, "symbol", "left")
    return out.select("symbol", *(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("UNKNOWN")).alias(c) for c in levels), F.coalesce("source", F.lit("none")).alias("source"))


def sector_disagreements(ours: DataFrame, published: DataFrame) -> DataFrame:
    """(symbol, ours, published) where both name a sector and they differ."""
    both = ours.select("symbol", F.col("sector").alias("ours")).join(published.select("symbol", F.col("sector").alias("published")), "symbol")
    return both.where("ours <> published")


def security_lookup(master: DataFrame, order: list[str]) -> DataFrame:
    """(key, row): each ISIN and each ticker in capitals of a security master (isin, ticker, ...) with the first row that has it, by the columns of order. Blank keys are left out; a row's ISIN comes before its ticker."""
    keys = F.array(F.struct(F.trim("isin").alias("key"), F.lit(0).alias("slot")), F.struct(F.upper(F.trim("ticker")).alias("key"), F.lit(1).alias("slot")))
    rows = master.select(F.struct("*").alias("row"), F.explode(keys).alias("k")).where("k.key <> ''")
    return rows.groupBy("k.key").agg(F.min_by("row", F.struct(*(F.col("row")[c] for c in order), F.col("k.slot"))).alias("row"))


def lookup_by_isin_or_ticker(rows: DataFrame, master: DataFrame, value: str, order: list[str] | None = None) -> DataFrame:
    """rows (isin, ticker) with a value of the security master, by ISIN or else by ticker; of repeated keys the first row by order, or else the one of the least value, counts."""
    found = security_lookup(master, order or [value]).select("key", F.col("row")[value].alias("_v"))
    by_isin = found.select(F.col("key").alias("_i"), F.col("_v").alias("_a"))
    by_ticker = found.select(F.col("key").alias("_t"), F.col("_v").alias("_b"))
    own = rows.withColumns({"_isin": F.trim("isin"), "_ticker": F.upper(F.trim("ticker"))})
    out = own.join(by_isin, own["_isin"] == by_isin["_i"], "left").join(by_ticker, own["_ticker"] == by_ticker["_t"], "left")
    return out.withColumn(value, F.when(F.col("_i").isNotNull(), F.col("_a")).otherwise(F.col("_b"))).drop("_a", "_b", "_i", "_t", "_isin", "_ticker")


def source_counts(resolved: DataFrame) -> DataFrame:
    """(source, n): how many symbols each source classified."""
    return resolved.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
