"""Data-quality checks: one row a check (name, status, metric, detail).

Every check is an aggregate that ends in one number; a condition on it gives PASS, another WARN, else FAIL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom import schemas
from tickerloom.operators.corpact import exploded_events
from tickerloom.operators.panel import KEYS, pivot_panel
from tickerloom.schemas import PRICE_FIELDS

#: Known top levels of the taxonomy.
KNOWN_MACRO = (
    "Commodities", "Consumer Discretionary", "Diversified", "Energy", "Fast Moving Consumer Goods", "Financial Services", "Healthcare",
    "Industrials", "Information Technology", "Services", "Telecommunication", "Utilities",
)
KNOWN_SECTORS = (
    "Automobile and Auto Components", "Capital Goods", "Chemicals", "Construction", "Construction Materials", "Consumer Durables", "Consumer Services",
    "Diversified", "Fast Moving Consumer Goods", "Financial Services", "Forest Materials", "Healthcare", "Information Technology",
    "Media, Entertainment & Publication", "Metals & Mining", "Oil, Gas & Consumable Fuels", "Power", "Realty", "Services", "Telecommunication", "Textiles", "Utilities",
)
#: Line items that every symbol should have (by prefix), and one of which it should have.
CORE_ITEMS = ("total_revenue", "net_profit", "eps")
CORE_EITHER = ("ebitda", "pbt")


def check(name: str, found: DataFrame, passes: Column, warns: Column | None = None) -> DataFrame:
    """One check from a one-row table (metric) and optionally detail."""
    status = F.when(passes, "PASS").when(warns if warns is not None else F.lit(False), "WARN").otherwise("FAIL")
    detail = F.col("detail") if "detail" in found.columns else F.lit(None).cast("string")
    return found.select(F.lit(name).alias("name"), status.alias("status"), F.col("metric").cast("double").alias("metric"), detail.alias("detail"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("metric"))


def _few(name: str, bad: DataFrame, warn: int | None) -> DataFrame:
    """None is right; up to warn are a warning; without warn any number is one."""
    m = F.col("metric")
    return check(name, _count(bad), m == 0, F.lit(True) if warn is None else m <= warn)


def _share(name: str, found: DataFrame, passes: float, warns: float) -> DataFrame:
    m = F.col("metric")
    return check(name, found, m >= passes, m >= warns)


def _symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def _covered(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """The share of wanted symbols that another table has, as metric."""
    mark = _symbols(have).withColumn("_have", F.lit(1.0))
    return _symbols(wanted).join(mark, "symbol", "left").agg(F.coalesce(F.avg(F.coalesce("_have", F.lit(0.0))), F.lit(0.0)).alias("metric"))


@dataclass
class Tables:
    """Inputs of the checks; those that are None skip their checks but for one that says so."""

    prices: DataFrame | None = None
    shares: DataFrame | None = None
    universe: DataFrame | None = None
    metadata: DataFrame | None = None
    financials: DataFrame | None = None
    classification: DataFrame | None = None
    published: DataFrame | None = None
    history: DataFrame | None = None
    actions: DataFrame | None = None
    ledger: DataFrame | None = None
    fallback: DataFrame | None = None
    gaps: DataFrame | None = None


def shares_checks(t: Tables) -> list[DataFrame]:
    s = t.shares
    off = F.abs(F.col("promoter_shares") + F.coalesce("public_shares", F.lit(0)) + F.coalesce("non_pub_nonp_shares", F.lit(0)) - F.col("total_shares"))
    return [
        _few("shares_parts_add_up", s.where(off > 1), 5),
        _few("shares_in_range", s.where("free_float_shares <= 0 or free_float_shares > total_shares or promoter_shares < 0"), 5),
        _few("metadata_without_filings", _symbols(t.metadata).join(_symbols(s), "symbol", "left_anti"), None),
    ]


def universe_checks(t: Tables) -> list[DataFrame]:
    u, m = t.universe, F.col("metric")
    sizes = u.groupBy("quarter_end_date").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.min("n"), F.lit(0)).alias("metric"), F.concat_ws("-", F.min("n").cast("string"), F.max("n").cast("string")).alias("detail"))
    repeats = u.groupBy("quarter_end_date", "symbol").agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("metric"))
    return [
        check("universe_quarters", u.agg(F.count_distinct("quarter_end_date").alias("metric")), m >= 28, m >= 20),
        check("universe_size", sizes, m >= 490, m >= 480),
        check("universe_no_repeats", repeats, m == 0),
        check("metadata_size", _count(t.metadata), m.between(500, 1500), m > 0),
        _few("universe_in_metadata", _symbols(u).join(_symbols(t.metadata), "symbol", "left_anti"), 10),
    ]


def membership_changes(universe: DataFrame) -> DataFrame:
    """(symbol, first_quarter, last_quarter, exited, late): symbols that left before the last quarter, or came after the first."""
    ends = F.broadcast(universe.agg(F.min("quarter_end_date").alias("_a"), F.max("quarter_end_date").alias("_z")))
    spans = universe.groupBy("symbol").agg(F.min("quarter_end_date").alias("first_quarter"), F.max("quarter_end_date").alias("last_quarter"))
    return spans.join(ends, F.lit(True)).select("symbol", "first_quarter", "last_quarter", (F.col("last_quarter") < F.col("_z")).alias("exited"), (F.col("first_quarter") > F.col("_a")).alias("late"))


def unexplained_changes(universe: DataFrame, actions: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exits without an event of 12 months around the last quarter or a last sighting within a year; entries without an event around the first quarter or a first sighting within a year."""
    moved = membership_changes(universe)
    pairs = exploded_events(actions)

    def around(df: DataFrame, date: str, symbol: str) -> DataFrame:
        events = pairs.where(f"{symbol} is not null").select(F.col(symbol).alias("symbol"), "event_date").distinct()
        near = df.join(events, "symbol").where(F.col("event_date").between(F.add_months(date, -12), F.add_months(date, 12)))
        return df.join(_symbols(near), "symbol", "left_anti")

    seen = history.select("symbol", "first_seen_date", "last_seen_date")
    exits = around(moved.where("exited"), "last_quarter", "predecessor").join(seen, "symbol", "left").where("last_seen_date is null or abs(datediff(last_seen_date, last_quarter)) > 365")
    entries = around(moved.where("late"), "first_quarter", "successor").join(seen, "symbol", "left").where("first_seen_date is null or abs(datediff(first_seen_date, first_quarter)) > 365")
    return exits.select("symbol", "last_quarter"), entries.select("symbol", "first_quarter")


def change_checks(t: Tables) -> list[DataFrame]:
    exits, entries = unexplained_changes(t.universe, t.actions, t.history)
    return [_few("unexplained_exits", exits, 10), _few("unexplained_entries", entries, None)]


def outliers(prices: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(symbol, date, close, change): moves of the close beyond the threshold between a symbol's consecutive rows."""
    w = Window.partitionBy("symbol").orderBy("date")
    own = prices.where("parameter = 'close' and value is not null").select("symbol", "date", F.col("value").alias("close"))
    moved = own.withColumn("change", F.round(F.try_divide("close", F.lag("close").over(w)) - 1, 4))
    return moved.where(F.abs("change") > threshold)


def close_coverage(prices: DataFrame, metadata: DataFrame) -> DataFrame:
    """(symbol, coverage): closes within the symbol's span in the universe over its weekdays; symbols without a row are left out, as zero_row_symbols has them."""
    spans = metadata.select("symbol", "first_in_universe_date", "last_in_universe_date")
    rows = prices.where("parameter = 'close'").join(spans, "symbol").where("date between first_in_universe_date and last_in_universe_date")
    days = F.greatest(F.lit(1.0), (F.datediff("last_in_universe_date", "first_in_universe_date") + 1) * 5 / 7)
    return rows.groupBy("symbol", days.alias("_d")).agg(F.count(F.lit(1)).alias("n")).select("symbol", (F.col("n") / F.col("_d")).alias("coverage"))


def zero_row_symbols(prices: DataFrame, metadata: DataFrame) -> DataFrame:
    return _symbols(metadata).join(_symbols(prices.where("parameter = 'close'")), "symbol", "left_anti")


def price_checks(t: Tables, as_of, outlier_threshold: float = 0.5) -> list[DataFrame]:
    p, m = t.prices, F.col("metric")
    fields = p.groupBy("symbol").agg(F.count_distinct("parameter").alias("n")).where(F.col("n") != len(PRICE_FIELDS))
    repeats = p.groupBy(*KEYS).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("metric"))
    wide = pivot_panel(p)
    broken = wide.where("high < low or high < open or high < close or low > open or low > close")
    stale = p.agg(F.datediff(F.lit(as_of).cast("date"), F.max("date")).alias("metric"))
    out = [
        _share("price_symbol_coverage", _covered(t.metadata, p), 0.95, 0.80),
        _few("price_fields", fields, 5),
        check("price_no_repeats", repeats, m == 0, m <= 10),
        _few("close_coverage", close_coverage(p, t.metadata).where("coverage < 0.8"), 5),
        _few("no_negative_prices", p.where(F.col("parameter").isin("open", "high", "low", "close") & (F.col("value") < 0)), 5),
        _few("ohlc_order", broken, 10),
        _few("large_moves", outliers(p, outlier_threshold), None),
        check("price_staleness", stale, m <= 5, m <= 14),
    ]
    if t.fallback is not None:
        missing = _symbols(t.gaps.where("script = 'prices'"))
        out.append(_share("fallback_coverage", _covered(missing, t.fallback), 0.8, 0.5))
    if t.ledger is not None:
        out.append(_few("action_types", t.ledger.where(~F.col("action_type").isin("split", "bonus", "dividend")), 0))
        out.append(_few("action_symbols", _symbols(t.ledger).join(_symbols(p), "symbol", "left_anti"), 2))
    return out


def financial_checks(t: Tables, as_of, long_tenure_days: int = 3650) -> list[DataFrame]:
    f = t.financials
    logged = _symbols(t.gaps.where("script = 'financials'"))
    silent = _symbols(t.metadata).join(_symbols(f), "symbol", "left_anti").join(logged, "symbol", "left_anti")
    aligned = f.agg(F.coalesce(F.avg((F.month("date") % 3 == 0).cast("double")), F.lit(0.0)).alias("metric"))
    items = f.groupBy("symbol").agg(F.collect_set("parameter").alias("items"))  # as many as there are line items
    has = lambda prefix: F.exists("items", lambda x: x.startswith(prefix))
    lacking = items.where(~(reduce(lambda a, b: a & b, map(has, CORE_ITEMS)) & reduce(lambda a, b: a | b, map(has, CORE_EITHER))))
    quarters = f.groupBy("symbol").agg(F.count_distinct("date").alias("n"))
    long = t.metadata.where(F.datediff("last_in_universe_date", "first_in_universe_date") >= long_tenure_days)
    depth = long.join(quarters, "symbol", "left").agg(F.coalesce(F.avg((F.coalesce("n", F.lit(0)) >= 40).cast("double")), F.lit(1.0)).alias("metric"))
    return [
        _few("financials_or_logged", silent, 10),
        _share("quarter_alignment", aligned, 0.90, 0.75),
        _few("core_line_items", lacking, 10),
        _few("no_future_periods", f.where(F.col("date") > F.lit(as_of).cast("date")), 5),
        _share("financial_depth", depth, 0.80, 0.60),
    ]


def classification_checks(t: Tables, macro: tuple = KNOWN_MACRO, sectors: tuple = KNOWN_SECTORS) -> list[DataFrame]:
    c, m = t.classification, F.col("metric")
    unknown = c.agg(F.coalesce(F.avg((F.col("sector") == "UNKNOWN").cast("double")), F.lit(0.0)).alias("metric"))
    named = lambda col: c.where((F.col(col) != "UNKNOWN") & F.col(col).isNotNull()).select(col).distinct()
    out = [
        _few("classification_coverage", _symbols(t.metadata).join(_symbols(c), "symbol", "left_anti"), 10),
        check("classification_unknown", unknown, m <= 0.05, m <= 0.10),
        _few("new_macro_sectors", named("macro_sector").where(~F.col("macro_sector").isin(*macro)), None),
        _few("new_sectors", named("sector").where(~F.col("sector").isin(*sectors)), None),
    ]
    if t.published is not None:
        both = c.select("symbol", "sector").join(t.published.select("symbol", F.col("sector").alias("_p")), "symbol")
        out.append(_few("sector_agreement", both.where("sector <> _p"), None))
    return out


def cross_checks(t: Tables) -> list[DataFrame]:
    meta, m = _symbols(t.metadata), F.col("metric")
    neither = _symbols(t.universe).join(_symbols(t.prices), "symbol", "left_anti").join(_symbols(t.financials), "symbol", "left_anti")
    failed = F.broadcast(t.gaps.agg(F.count_distinct("symbol").alias("_f")))
    ratio = _count(meta).join(failed, F.lit(True)).select(F.coalesce(F.try_divide("_f", "metric"), F.lit(0.0)).alias("metric"))
    return [
        _few("prices_in_metadata", _symbols(t.prices).join(meta, "symbol", "left_anti"), 5),
        _few("financials_in_metadata", _symbols(t.financials).join(meta, "symbol", "left_anti"), 5),
        _few("universe_in_a_panel", neither, 10),
        check("failure_ratio", ratio, m < 0.15, m < 0.30),
    ]


#: The layouts that inputs must have; further columns are allowed.
LAYOUTS = {
    "prices": schemas.PANEL, "shares": "symbol STRING, date DATE, total_shares BIGINT, promoter_shares BIGINT, free_float_shares BIGINT", "universe": "quarter_end_date DATE, symbol STRING, rank INT",
    "metadata": "symbol STRING, first_in_universe_date DATE, last_in_universe_date DATE", "financials": schemas.PANEL, "classification": "symbol STRING, macro_sector STRING, sector STRING, industry STRING, basic_industry STRING",
}


def column_table(schema: StructType, spark) -> DataFrame:
    """(column, type) of a schema."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "column string, type string")


def schema_check(name: str, df: DataFrame | None, layout: str, spark) -> DataFrame:
    """One check: the table is there and has the layout's columns in their types; detail names the missing and the retyped ones."""
    if df is None:
        return spark.createDataFrame([(name, "FAIL", None, "no table")], "name string, status string, metric double, detail string")
    want = column_table(StructType.fromDDL(layout), spark)
    both = want.join(column_table(df.schema, spark).withColumnRenamed("type", "found"), "column", "full").where("type is not null")
    off = both.where("found is null or found <> type").select(F.concat_ws(" ", "column", F.coalesce("found", F.lit("missing"))).alias("d"))
    found = off.agg(F.count(F.lit(1)).alias("metric"), F.nullif(F.array_join(F.array_sort(F.collect_list("d")), ", "), F.lit("")).alias("detail"))  # a few columns
    return check(name, found, F.col("metric") == 0)


def exists_checks(t: Tables, spark) -> list[DataFrame]:
    """One check a table: it is there, with the columns and types that the other checks read."""
    return [schema_check(f"{n}_exists", getattr(t, n), layout, spark) for n, layout in LAYOUTS.items()]


def validate(t: Tables, spark, as_of, outlier_threshold: float = 0.5) -> DataFrame:
    """All checks whose tables are there and have their layout; a table that lacks columns has its own check fail and skips the others."""
    parts = exists_checks(t, spark)
    sound = lambda n: getattr(t, n) is not None and (n not in LAYOUTS or all(f in set(getattr(t, n).columns) for f in StructType.fromDDL(LAYOUTS[n]).names))
    have = lambda *names: all(map(sound, names))
    if have("shares", "metadata"):
        parts += shares_checks(t)
    if have("universe", "metadata"):
        parts += universe_checks(t)
    if have("universe", "actions", "history"):
        parts += change_checks(t)
    if have("prices", "metadata"):
        parts += price_checks(t, as_of, outlier_threshold)
    if have("financials", "metadata", "gaps"):
        parts += financial_checks(t, as_of)
    if have("classification", "metadata"):
        parts += classification_checks(t)
    if have("universe", "prices", "financials", "metadata", "gaps"):
        parts += cross_checks(t)
    return reduce(DataFrame.unionByName, parts)


def overall(checks: DataFrame) -> DataFrame:
    """(status, passed, warned, failed): FAIL if any check fails."""
    n = lambda s: F.count_if(F.col("status") == s)
    return checks.agg(F.when(n("FAIL") > 0, "FAIL").otherwise("PASS").alias("status"), n("PASS").alias("passed"), n("WARN").alias("warned"), n("FAIL").alias("failed"))
