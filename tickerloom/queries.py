"""Registered queries of the panel library and their SQL.

The SQL is a chain of named steps over the tables; a query is one more select over them. Doubles are rounded at the
end on both sides, as engines add in different orders.
"""

from __future__ import annotations

import dataclasses
import datetime
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom import fixtures
from tickerloom.functions import scalars
from tickerloom.operators import asof, attribution, corpact, fundamentals, holdings, metrics, panel, quality, reports, select, signals, timeline, universe, weights
from tickerloom.plans.runs import Config, Market, Result, configs_table, run_bounds, run_strategies, targets
from tickerloom.sources import readers
from tickerloom.sources.staging import shared_folder, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TOP_N = 50
START = datetime.date(1995, 6, 30)
BUCKETS = {"large": (1, 10), "mid": (11, 25), "small": (26, None)}

#: Steps of the SQL, each over the ones before.
STEPS: dict[str, str] = {name: fixtures.duckdb(name) for name in fixtures.PANELS}


def step(name: str, sql: str) -> None:
    STEPS[name] = sql


def _needed(sql: str) -> list[str]:
    """The steps that the SQL reads, itself or through others, in order."""
    found, todo = set(), [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = {k for k in STEPS if k in words} - found
        found |= new
        todo += [STEPS[k] for k in new]
    return [k for k in STEPS if k in found]


def query(columns: str, sql: str | None = None):
    """Register a query with its columns; `~n` marks a double that is rounded to n places (8 without n)."""
    spec = [(c.partition("~")[0], (int(c.partition("~")[2] or 8) if "~" in c else None)) for c in columns.split()]

    def add(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).select(*(F.col(c) if n is None else (F.round(F.col(c).cast("double"), n) + 0.0).alias(c) for c, n in spec))

        name = f.__name__
        QUERIES[name] = run
        if sql:
            out = ", ".join(c if n is None else f"round(cast({c} as double), {n}) + 0.0 as {c}" for c, n in spec)
            chain = ",\n".join(f"{k} as materialized ({STEPS[k]})" for k in _needed(sql))
            ORACLE_SQL[name] = f"{f'with {chain}' if chain else ''}\nselect {out} from ({sql})"
        return f

    return add


def quotes(spark, sf_dir):
    return fixtures.panel(spark, sf_dir, "fx_quotes")


def fx(name):
    return lambda spark, sf_dir: fixtures.panel(spark, sf_dir, f"fx_{name}")


def pit(spark, sf_dir, q=None, cal=None) -> DataFrame:
    q = q if q is not None else quotes(spark, sf_dir)
    cal = cal if cal is not None else timeline.calendar(q)
    return universe.pit_universe(q, cal, timeline.quarter_ends(cal), fx("shares")(spark, sf_dir), TOP_N)


def financial_panel(spark, sf_dir, names: DataFrame | None = None) -> DataFrame:
    """The figures of all symbols, or of those in names."""
    raw = fixtures.panel(spark, sf_dir, "fx_fin_raw")
    raw = raw if names is None else raw.join(names.select("symbol").distinct(), "symbol", "left_semi").select(*raw.columns)
    # the derived items read the canonical ones again
    return fundamentals.derived(staged(fundamentals.canonical(raw)))


_built: dict[tuple, object] = {}


def once(f):
    """The panels and the base run are tables that several queries read: each is built once an application and folder."""

    def run(spark, sf_dir):
        key = f.__name__, spark.sparkContext.applicationId, sf_dir
        if key not in _built:
            _built[key] = f(spark, sf_dir)
        return _built[key]

    return run


@once
def staged_quotes(spark, sf_dir) -> DataFrame:
    return staged(quotes(spark, sf_dir))


@once
def staged_financials(spark, sf_dir) -> DataFrame:
    return staged(financial_panel(spark, sf_dir))


@once
def market(spark, sf_dir) -> Market:
    # quotes stay a view: only those of the snapshot days and of the universe's names are made
    q = quotes(spark, sf_dir)
    cal = staged(timeline.calendar(q))
    names = staged(pit(spark, sf_dir, q, cal))
    return Market.build(q, names, fx("sector")(spark, sf_dir), financial_panel(spark, sf_dir, names), fx("tri")(spark, sf_dir), cal)


def base_config(**changes) -> Config:
    return Config(**({"run_id": "base", "start": START} | changes))


@once
def result(spark, sf_dir) -> tuple[Market, Result]:
    m = market(spark, sf_dir)
    return m, run_strategies(m, configs_table(spark, [base_config()]), buckets=BUCKETS)


# ---- calendar, as-of joins, panels -------------------------------------------------------------------------------

step("calendar", "select date, row_number() over (order by date) - 1 as cal_idx from (select distinct date from fx_quotes)")
step("dense", """
select s.symbol, c.date, c.cal_idx, q.close as close_raw, q.volume, last_value(q.close ignore nulls) over (partition by s.symbol order by c.cal_idx rows unbounded preceding) as close,
       max(case when q.close is not null then c.date end) over (partition by s.symbol) as last_valid, arg_min(q.close, c.cal_idx) over (partition by s.symbol) as first_close
from (select distinct symbol from fx_quotes) s cross join calendar c left join fx_quotes q on q.symbol = s.symbol and q.date = c.date""")
step("dense_ret", "select *, coalesce(close / lag(close) over (partition by symbol order by cal_idx) - 1, 0) as ret from dense")
step("adv30", """
select symbol, date, cal_idx, case when count(close_raw * volume) over w >= 10 then median(close_raw * volume) over w end as adv
from dense window w as (partition by symbol order by cal_idx rows between 29 preceding and current row)""")
step("qends", """
select distinct last_day(date_trunc('quarter', date) + interval 2 month) as quarter_end_date from calendar
where last_day(date_trunc('quarter', date) + interval 2 month) <= (select max(date) from calendar)""")
step("snapmap", "select quarter_end_date, max(date) as date from qends join calendar on date <= quarter_end_date and date >= quarter_end_date - 7 group by 1")
step("universe_all", """
select m.quarter_end_date, q.symbol, q.close as close_inr, s.date as filing_date, s.total_shares as shares_outstanding, s.free_float_shares,
       q.close * s.total_shares as market_cap_inr, q.close * s.free_float_shares as free_float_market_cap_inr
from snapmap m join fx_quotes q on q.date = m.date asof join fx_shares s on s.symbol = q.symbol and s.date <= m.quarter_end_date""")
step("universe", f"select * from (select *, row_number() over (partition by quarter_end_date order by market_cap_inr desc, symbol) as rank from universe_all where market_cap_inr > 0) where rank <= {TOP_N}")


@query("date cal_idx", "select * from calendar")
def trading_calendar(spark, sf_dir):
    return timeline.calendar(quotes(spark, sf_dir))


@query("symbol date cal_idx close_raw~ close~ ret~ first_close~ last_valid", "select * from dense_ret")
def dense_returns(spark, sf_dir):
    return panel.dense_returns(quotes(spark, sf_dir))


@query("symbol date cal_idx adv~", "select * from adv30")
def rolling_median_adv(spark, sf_dir):
    return panel.adv(panel.dense_returns(quotes(spark, sf_dir)))


@query("date symbol parameter value~", "select date, symbol, parameter, value from (unpivot fx_quotes on open, high, low, close, volume into name parameter value value) where value is not null")
def melt_panel(spark, sf_dir):
    return panel.melt_panel(quotes(spark, sf_dir))


@query("date symbol open~ high~ low~ close~ volume~", "select * from fx_quotes")
def pivot_panel(spark, sf_dir):
    return panel.pivot_panel(panel.melt_panel(quotes(spark, sf_dir)))


@query("date symbol parameter value~", """
select date, symbol, 'close' as parameter, case when date >= date '1998-01-01' and symbol like '%1' then close * 2 else close end as value from fx_quotes
union all select date + 10000, symbol, 'close', close * 2 from fx_quotes where date >= date '1998-01-01' and symbol like '%1'""")
def upsert_panel(spark, sf_dir):
    old = panel.melt_panel(quotes(spark, sf_dir), ["close"])
    new = old.where("date >= date'1998-01-01' and symbol like '%1'").withColumn("value", F.col("value") * 2)
    return panel.upsert(old, new.unionByName(new.withColumn("date", F.date_add("date", 10000))))


@query("symbol date close~ filing_date total_shares free_float_shares", """
select q.symbol, q.date, q.close, s.date as filing_date, s.total_shares, s.free_float_shares from fx_quotes q asof left join fx_shares s on s.symbol = q.symbol and s.date <= q.date""")
def asof_latest_filing(spark, sf_dir):
    shares = fx("shares")(spark, sf_dir).withColumnRenamed("date", "filing_date")
    return asof.asof_join(quotes(spark, sf_dir), shares, ["symbol"], "date", "filing_date")


@query("symbol date filing_date total_shares", """
select q.symbol, q.date, case when q.date - s.date <= 30 then s.date end as filing_date, case when q.date - s.date <= 30 then s.total_shares end as total_shares
from fx_quotes q asof left join fx_shares s on s.symbol = q.symbol and s.date <= q.date""")
def asof_with_tolerance(spark, sf_dir):
    shares = fx("shares")(spark, sf_dir).withColumnRenamed("date", "filing_date")
    return asof.asof_join(quotes(spark, sf_dir), shares, ["symbol"], "date", "filing_date", tolerance_days=30)


@query("quarter_end_date rank symbol market_cap_inr~4 free_float_market_cap_inr~4 close_inr~ shares_outstanding~ free_float_shares~", "select * from universe")
def pit_universe(spark, sf_dir):
    return pit(spark, sf_dir)


@query("date quarter_end_date", "select c.date, max(u.quarter_end_date) as quarter_end_date from calendar c join (select distinct quarter_end_date from universe) u on u.quarter_end_date <= c.date group by 1")
def snapshot_asof(spark, sf_dir):
    q = quotes(spark, sf_dir)
    return asof.snapshot_asof(timeline.calendar(q).select("date"), pit(spark, sf_dir, q), "date")


@query("symbol date value~", """
select q.symbol, d.quarter_end_date as date, q.close as value from dense q join (select quarter_end_date, max(date) as date from qends join calendar on date <= quarter_end_date group by 1) d on d.date = q.date where q.close is not null""")
def panel_row_asof(spark, sf_dir):
    q = quotes(spark, sf_dir)
    cal = timeline.calendar(q)
    wanted = q.select("symbol").distinct().join(F.broadcast(timeline.quarter_ends(cal)), F.lit(True))
    return panel.value_asof(wanted, panel.dense_returns(q, cal), cal, "quarter_end_date", ["close"]).where("close is not null").select("symbol", F.col("quarter_end_date").alias("date"), F.col("close").alias("value"))


# ---- history, universe, metadata ---------------------------------------------------------------------------------

step("part_history", """
select symbol, min(date) as first_seen_date, case when max(date) < (select max(date) from fx_part_quotes) then max(date) end as last_seen_date from fx_part_quotes group by 1""")
step("part_listed", "select concat('P', cast(p_partkey as string)) as symbol, concat('IN', cast(p_partkey as string)) as isin, p_name as company_name from part where p_partkey % 3 <> 0")


def part_listed(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey % 3 <> 0").selectExpr("concat('P', p_partkey) as symbol", "concat('IN', p_partkey) as isin", "p_name as company_name")


def part_history(spark, sf_dir):
    return universe.symbol_history(fx("part_quotes")(spark, sf_dir), part_listed(spark, sf_dir))


@query("symbol first_seen_date last_seen_date status isin", "select h.*, case when l.symbol is null then 'delisted' else 'active' end as status, l.isin from part_history h left join part_listed l using (symbol)")
def symbol_history(spark, sf_dir):
    return part_history(spark, sf_dir)


@query("symbol isin company_name status", """
select symbol, isin, company_name, 'active' as status from part_listed union all
select symbol, null, null, 'delisted' from part_history where symbol not in (select symbol from part_listed)""")
def raw_universe(spark, sf_dir):
    live = part_listed(spark, sf_dir)
    return universe.raw_universe(live, live.where("symbol like '%7'"), live.where("symbol like '%5'"), part_history(spark, sf_dir))


@query("symbol first_in_universe_date last_in_universe_date sector", """
select u.symbol, min(quarter_end_date) as first_in_universe_date, max(quarter_end_date) as last_in_universe_date, any_value(s.sector) as sector from universe u left join fx_sector s using (symbol) group by 1""")
def universe_metadata(spark, sf_dir):
    return universe.metadata(pit(spark, sf_dir), fx("sector")(spark, sf_dir))


@query("symbol n", "select symbol, count(*) as n from fx_quotes where symbol in (select symbol from universe where rank <= 5) group by 1")
def prune_panel(spark, sf_dir):
    q = quotes(spark, sf_dir)
    return universe.prune(q, pit(spark, sf_dir, q).where("rank <= 5")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("symbol first last n", """
select w.symbol, w.first, w.last, count(*) as n from (
  select symbol, greatest(date '1996-01-01', first_seen_date - 30) as first, least(date '2001-06-30', coalesce(last_seen_date, date '2001-06-30')) as last from part_history) w
join fx_part_quotes q on q.symbol = w.symbol and q.date between w.first and w.last group by 1, 2, 3""")
def life_window_backfill(spark, sf_dir):
    w = panel.life_windows(part_history(spark, sf_dir), "1996-01-01", "2001-06-30", 30)
    rows = panel.backfill_from_daily(fx("part_quotes")(spark, sf_dir), w)
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).join(w, "symbol")


@query("symbol n filled", """
with p as (select * from fx_quotes where symbol not like '%3')
select symbol, count(*) as n, false as filled from p group by 1 union all select symbol, count(*), true from fx_quotes where symbol like '%3' group by 1""")
def primary_else_fallback(spark, sf_dir):
    q = quotes(spark, sf_dir)
    both, _ = panel.primary_else_fallback(q, q.where("symbol not like '%3'"), q)
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).withColumn("filled", F.col("symbol").like("%3"))


@query("symbol macro_sector sector industry basic_industry source", """
select symbol, macro_sector, case when symbol like '%2' then 'OVERRIDE' else sector end as sector, industry, basic_industry,
       case when symbol like '%2' then 'override' when symbol like '%4' then 'second' else 'page' end as source from fx_sector where symbol not like '%9'
union all select symbol, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'none' from fx_sector where symbol like '%9'""")
def resolve_classification(spark, sf_dir):
    s = fx("sector")(spark, sf_dir)
    page = s.where("symbol not like '%4' and symbol not like '%9'")
    return universe.resolve_classification(s, [("override", s.where("symbol like '%2'").withColumn("sector", F.lit("OVERRIDE"))), ("page", page), ("second", s.where("symbol not like '%9'"))])


@query("symbol ours published", "select symbol, sector as ours, macro_sector as published from fx_sector where sector <> macro_sector")
def sector_disagreements(spark, sf_dir):
    s = fx("sector")(spark, sf_dir)
    return universe.sector_disagreements(s, s.select("symbol", F.col("macro_sector").alias("sector")))


# ---- corporate actions -------------------------------------------------------------------------------------------

step("factors", """
select symbol, ex_date, product(pf) as price_factor, product(vf) as volume_factor from (
  select a.symbol, a.ex_date,
    case action_type when 'split' then case when ratio_denom > 0 and ratio_num > ratio_denom then ratio_denom / ratio_num end
      when 'bonus' then case when ratio_num > 0 and ratio_denom > 0 then ratio_denom / (ratio_num + ratio_denom) end
      else case when amount > 0 and q.close > 0 then case when amount >= q.close then 0.01 else (q.close - amount) / q.close end end end as pf,
    case action_type when 'split' then ratio_num / ratio_denom when 'bonus' then (ratio_num + ratio_denom) / ratio_denom else 1 end as vf
  from fx_actions a asof left join fx_quotes q on q.symbol = a.symbol and q.date < a.ex_date) where pf is not null group by 1, 2""")


@query("symbol ex_date price_factor~ volume_factor~", "select * from factors")
def action_factors(spark, sf_dir):
    return corpact.action_factors(fx("actions")(spark, sf_dir), quotes(spark, sf_dir))


@query("date symbol close~ volume~6", """
select q.date, q.symbol, q.close * coalesce(product(f.price_factor), 1) as close, q.volume * coalesce(product(f.volume_factor), 1) as volume
from fx_quotes q left join factors f on f.symbol = q.symbol and f.ex_date > q.date group by q.date, q.symbol, q.close, q.volume""")
def back_adjust(spark, sf_dir):
    return corpact.back_adjust(quotes(spark, sf_dir), fx("actions")(spark, sf_dir))


SUBJECT = "concat(case o_orderkey % 6 when 0 then 'Stock Split From Rs.10/- To Rs.' when 1 then 'Bonus issue ' when 2 then 'Interim Dividend - Rs ' when 3 then 'Annual General Meeting ' when 4 then 'Sub-division 10:' else 'Scheme of arrangement ' end, cast(o_orderkey % 7 + 1 as string), case o_orderkey % 6 when 0 then '/-' when 1 then ':1' else '' end)"


@query("o_orderkey action_type ratio_num~ ratio_denom~ amount~", """
select o_orderkey, case o_orderkey % 6 when 0 then 'split' when 1 then 'bonus' when 2 then 'dividend' when 4 then 'split' end as action_type,
  case o_orderkey % 6 when 0 then 10 when 1 then o_orderkey % 7 + 1 when 4 then 10 end as ratio_num, case o_orderkey % 6 when 0 then o_orderkey % 7 + 1 when 1 then 1 when 4 then o_orderkey % 7 + 1 end as ratio_denom,
  case o_orderkey % 6 when 2 then o_orderkey % 7 + 1 end as amount from orders""")
def classify_subject(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", f"{SUBJECT} as subject")
    return corpact.classify_subject(o)


@query("symbol direction other event_date event_type other_status", """
with e as (select cast(o_orderdate as date) as event_date, case when o_orderkey % 3 = 0 then 'merger' else 'rename' end as event_type, concat('P', cast(o_custkey as string)) as p, concat('P', cast(o_custkey + 1 as string)) as s from orders)
select distinct x.*, case when h.symbol is null then null when l.symbol is null then 'delisted' else 'active' end as other_status from (
  select s as symbol, 'in' as direction, p as other, event_date, event_type from e union all select p, 'out', s, event_date, event_type from e) x
left join part_history h on h.symbol = x.other left join part_listed l on l.symbol = x.other""")
def action_lineage(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "cast(o_orderdate as date) as event_date", "if(o_orderkey % 3 = 0, 'merger', 'rename') as event_type", "concat('P', o_custkey) as predecessor_symbols", "concat(' P', o_custkey + 1, ' ') as successor_symbols")
    return corpact.lineage(e, part_history(spark, sf_dir))


# ---- fundamentals ------------------------------------------------------------------------------------------------

step("fin", """
select symbol, date, case line_item when 'sales' then 'total_revenue' when 'expenses' then 'operating_expenses' when 'operating_profit' then 'ebitda' when 'profit_before_tax' then 'pbt' else line_item end as parameter, value from fx_fin_raw""")
step("fin_derived", """
select * from fin union all select symbol, date, 'ebit', max(value) filter (parameter = 'ebitda') - max(value) filter (parameter = 'depreciation') from fin group by 1, 2
union all select symbol, date, 'tax_implied', max(value) filter (parameter = 'pbt') - max(value) filter (parameter = 'net_profit') from fin group by 1, 2""")


@query("symbol date parameter value~", "select * from fin")
def canonical_parameters(spark, sf_dir):
    return fundamentals.canonical(fx("fin_raw")(spark, sf_dir))


@query("symbol date parameter value~", "select * from fin_derived")
def derived_fundamentals(spark, sf_dir):
    return financial_panel(spark, sf_dir)


@query("symbol line_item n", """
select symbol, line_item, count(*) as n from fx_fin_raw group by 1, 2""")
def merge_sections(spark, sf_dir):
    raw = fx("fin_raw")(spark, sf_dir)
    items = raw.withColumn("section_order", F.lit(0)).unionByName(raw.withColumns({"section_order": F.lit(1), "date": F.date_add("date", 7)}))
    return fundamentals.merge_sections(items).groupBy("symbol", "line_item").agg(F.count(F.lit(1)).alias("n"))


@query("symbol reason", """
select concat('S', cast(s_suppkey as string)) as symbol, case when s_suppkey % 5 = 0 then 'PageFetchFailed' when s_suppkey % 5 = 1 then 'ParseFailed' when s_suppkey % 5 = 2 then 'NoQuarterlyData' end as reason from supplier where s_suppkey % 5 < 3""")
def fundamentals_failures(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("concat('S', s_suppkey) as symbol", "s_suppkey as k")
    parsed = s.where("k % 5 >= 2").selectExpr("symbol", "if(k % 5 = 2, 'annual', 'quarterly') as period", "date'2001-03-31' as date")
    return fundamentals.failures(s, s.where("k % 5 > 0"), parsed, "2000-01-01")


# ---- schedule and signals ----------------------------------------------------------------------------------------

step("sched", """
select distinct case when back is null or back < first then coalesce(ahead, back) else back end as rebal_date from (
  select q.quarter_end_date, (select min(quarter_end_date) from universe) as first, (select max(date) from calendar where date <= q.quarter_end_date) as back, (select min(date) from calendar where date >= q.quarter_end_date) as ahead
  from qends q where q.quarter_end_date >= date '1995-06-30')""")
step("trade", """
select max(s.rebal_date) as rebal_date, t.cal_idx as trade_idx, t.date as trade_date
from sched s join calendar c on c.date = s.rebal_date join calendar t on t.cal_idx = least(c.cal_idx + 1, (select max(cal_idx) from calendar)) group by 2, 3""")
step("pool", """
select s.rebal_date, c.cal_idx, u.*, d.close, a.adv, coalesce(f.sector, 'UNCLASSIFIED') as sector
from (select rebal_date, (select max(quarter_end_date) from universe where quarter_end_date <= rebal_date) as q from sched) s
join universe u on u.quarter_end_date = s.q join calendar c on c.date = s.rebal_date
left join dense d on d.symbol = u.symbol and d.cal_idx = c.cal_idx left join adv30 a on a.symbol = u.symbol and a.cal_idx = c.cal_idx left join fx_sector f on f.symbol = u.symbol""")
step("mom", """
select p.rebal_date, p.symbol, n.close / f.close - 1 as raw from pool p join dense n on n.symbol = p.symbol and n.cal_idx = p.cal_idx - 21 join dense f on f.symbol = p.symbol and f.cal_idx = p.cal_idx - 251
where p.cal_idx >= 251 and n.close / f.close is not null""")
step("vol", """
select p.rebal_date, p.symbol, 1 / v.vol as raw from pool p join (
  select symbol, cal_idx, stddev_samp(ret) over (partition by symbol order by cal_idx rows between 251 preceding and current row) as vol from dense_ret) v on v.symbol = p.symbol and v.cal_idx = p.cal_idx
where p.cal_idx >= 59 and v.vol > 0""")
step("growth", """
select a.rebal_date, a.symbol, (a.value - b.value) / abs(b.value) as raw from
 (select p.rebal_date, p.symbol, f.value from pool p asof join (select * from fin where parameter = 'net_profit') f on f.symbol = p.symbol and f.date <= p.rebal_date - 60) a join
 (select p.rebal_date, p.symbol, f.value from pool p asof join (select * from fin where parameter = 'net_profit') f on f.symbol = p.symbol and f.date <= p.rebal_date - 60 - 365) b
 on a.rebal_date = b.rebal_date and a.symbol = b.symbol where b.value <> 0""")


def z_sql(source: str, sigma: float = 3.0) -> str:
    """Standardised raw values of a step."""
    return f"""
select rebal_date, symbol, case when s2 is null or s2 = 0 then 0 else (c - m2) / s2 end as score from (
  select *, avg(c) over (partition by rebal_date) as m2, stddev_samp(c) over (partition by rebal_date) as s2 from (
    select *, greatest(-{sigma}, least({sigma}, case when s1 is null or s1 = 0 then 0 else (raw - m1) / s1 end)) as c from (
      select *, avg(raw) over (partition by rebal_date) as m1, stddev_samp(raw) over (partition by rebal_date) as s1 from {source})))"""


step("mom_z", z_sql("mom"))
step("vol_z", z_sql("vol"))
step("mom_lvol", "select rebal_date, symbol, sum(x) as raw from (select rebal_date, symbol, 0.5 * score as x from mom_z union all select rebal_date, symbol, 0.5 * score from vol_z) group by 1, 2")
step("mom_lvol_z", z_sql("mom_lvol"))


def signal_rows(spark, sf_dir, name):
    m = market(spark, sf_dir)
    configs = configs_table(spark, [base_config(weighting="ffmcap", signal=name)])
    names = select.pool(m, timeline.schedule(configs, m.cal, m.universe), configs)
    return m, names


@query("rebal_date trade_date trade_idx", "select * from trade")
def rebalance_schedule(spark, sf_dir):
    q = quotes(spark, sf_dir)
    cal = timeline.calendar(q)
    s = timeline.schedule(configs_table(spark, [base_config()]), cal, pit(spark, sf_dir, q, cal))
    return timeline.trade_dates(s.withColumn("rebal_offset", F.lit(1)), cal)


@query("rebal_date symbol raw~", "select * from mom")
def momentum_signal(spark, sf_dir):
    return signals.momentum_12_1(*signal_rows(spark, sf_dir, "momentum_12_1"))


@query("rebal_date symbol raw~4", "select * from vol")
def inverse_volatility_signal(spark, sf_dir):
    return signals.vol_inverse(*signal_rows(spark, sf_dir, "vol_inverse"))


@query("rebal_date symbol raw~", "select * from growth")
def earnings_growth_signal(spark, sf_dir):
    return signals.earnings_growth_yoy(*signal_rows(spark, sf_dir, "earnings_growth_yoy"))


@query("rebal_date symbol score~", "select * from mom_lvol_z")
def composed_signal(spark, sf_dir):
    return signals.scores(*signal_rows(spark, sf_dir, "mom_lvol"))


# ---- selection and weights ---------------------------------------------------------------------------------------

step("first_idx", "select symbol, min(cal_idx) as first_idx from dense where close_raw is not null group by 1")


@query("rebal_date symbol rank", """
select p.rebal_date, p.symbol, p.rank from pool p join first_idx f using (symbol) where p.rank <= 40 and p.symbol not in ('S3', 'S7') and p.free_float_shares / p.shares_outstanding >= 0.5
and p.cal_idx - f.first_idx + 1 >= 200 and p.close >= 102 and p.adv >= 1000""")
def eligible_names(spark, sf_dir):
    m = market(spark, sf_dir)
    configs = configs_table(spark, [base_config(max_universe_rank=40, exclude_symbols=["S3", "S7"], min_free_float_pct=0.5, min_history_days=200, min_price=102.0, min_adv_inr=1000.0)])
    return select.eligible(select.pool(m, timeline.schedule(configs, m.cal, m.universe), configs))


def selected_names(spark, sf_dir, **changes):
    m = market(spark, sf_dir)
    configs = configs_table(spark, [base_config(signal="momentum_12_1", **changes)])
    names = select.pool(m, timeline.schedule(configs, m.cal, m.universe), configs)
    return select.selected(names, signals.scores(m, names))


@query("rebal_date symbol score~", """
select rebal_date, symbol, score from (select p.rebal_date, p.symbol, z.score, count(z.score) over (partition by p.rebal_date) as n, row_number() over (partition by p.rebal_date order by z.score desc nulls last, p.rank) as i
from pool p left join mom_z z using (rebal_date, symbol)) where n = 0 or (i <= 10 and score is not null)""")
def top_n_by_signal(spark, sf_dir):
    return selected_names(spark, sf_dir, signal_top_n=10)


@query("rebal_date symbol score~", """
select p.rebal_date, p.symbol, z.score from pool p left join mom_z z using (rebal_date, symbol) left join (select rebal_date, quantile_cont(score, 0.7) as edge from mom_z group by 1) e using (rebal_date)
where e.edge is null or z.score >= e.edge - 1e-12""")
def top_quantile_by_signal(spark, sf_dir):
    return selected_names(spark, sf_dir, signal_top_quantile=0.3)


step("ff", "select rebal_date, symbol, sector, rank, free_float_market_cap_inr / sum(free_float_market_cap_inr) over (partition by rebal_date) as raw_weight from pool where free_float_market_cap_inr > 0 and close >= 1")


def capped_sql(source: str, group: str, cap: float, weight: str) -> str:
    """One cap over the groups of a step, in closed form."""
    return f"""
select s.*, s.{weight} * case when g.capped then {cap} / g.w else coalesce(g.rest, {cap} / g.w) end as weight from {source} s join (
  select *, min(case when not capped then scale end) over (partition by rebal_date) as any_rest, first_value(case when not capped then scale end ignore nulls) over (partition by rebal_date order by r rows between unbounded preceding and unbounded following) as rest from (
    select *, w * scale > {cap} * (1 + 1e-15) as capped from (
      select *, (1 - r * {cap}) / tail as scale from (
        select rebal_date, {group}, w, row_number() over (partition by rebal_date order by w desc, {group}) - 1 as r, sum(w) over (partition by rebal_date order by w desc, {group} rows between current row and unbounded following) as tail
        from (select rebal_date, {group}, sum({weight}) as w from {source} group by 1, 2))))) g on g.rebal_date = s.rebal_date and g.{group} = s.{group}"""


step("target", capped_sql("ff", "symbol", 0.2, "raw_weight"))


def target_rows(spark, sf_dir, **changes):
    m = market(spark, sf_dir)
    return targets(m, configs_table(spark, [base_config(**changes)]), buckets=BUCKETS)


@query("rebal_date symbol raw_weight~ weight~", "select * from target")
def capped_stock_targets(spark, sf_dir):
    return target_rows(spark, sf_dir)


@query("rebal_date symbol weight~", f"select rebal_date, symbol, weight from ({capped_sql('ff', 'sector', 0.25, 'raw_weight')})")
def capped_sector_targets(spark, sf_dir):
    return target_rows(spark, sf_dir, max_stock_wt=None, max_sector_wt=0.25)


@query("rebal_date symbol weight~", """
select rebal_date, symbol, raw_weight * case when own > 0.05 then case when rank >= 26 then 0.05 / own else 0.95 / (1 - own) end else 1 end as weight
from (select *, sum(case when rank >= 26 then raw_weight else 0 end) over (partition by rebal_date) as own from ff)""")
def capped_size_bucket_targets(spark, sf_dir):
    return target_rows(spark, sf_dir, max_stock_wt=None, max_size_bucket_wt={"small": 0.05})


@query("rebal_date symbol weight~", """
select rebal_date, symbol, 0.9 / count(*) over (partition by rebal_date) as weight from pool where close >= 1 union all select distinct rebal_date, 'CASH', 0.1 from pool""")
def equal_targets_with_cash(spark, sf_dir):
    return target_rows(spark, sf_dir, weighting="equal", max_stock_wt=None, cash_buffer=0.1)


@query("rebal_date symbol weight~", """
select rebal_date, symbol, x / sum(x) over (partition by rebal_date) as weight from (select p.rebal_date, p.symbol, p.free_float_market_cap_inr * exp(0.5 * coalesce(z.score, 0)) as x
from pool p left join mom_z z using (rebal_date, symbol) where p.free_float_market_cap_inr > 0 and p.rebal_date >= date '1996-03-31')""")
def tilted_targets(spark, sf_dir):
    return target_rows(spark, sf_dir, weighting="ffmcap_tilt", signal="momentum_12_1", max_stock_wt=None, start=datetime.date(1996, 3, 31))


@query("rebal_date symbol weight~", "select rebal_date, symbol, score / sum(score) over (partition by rebal_date) as weight from mom_z where score > 0 and rebal_date >= date '1996-03-31'")
def score_weighted_targets(spark, sf_dir):
    return target_rows(spark, sf_dir, weighting="score_weighted", signal="momentum_12_1", max_stock_wt=None, start=datetime.date(1996, 3, 31))


# ---- holdings, costs, returns ------------------------------------------------------------------------------------

step("seg", "select *, coalesce(lead(trade_idx) over (order by trade_idx) - 1, (select max(cal_idx) from calendar)) as end_idx from trade")
step("val", """
select g.trade_idx, g.trade_date, c.cal_idx, c.date, t.symbol, p.last_valid, t.weight * coalesce(coalesce(p.close, p.first_close) / coalesce(b.close, b.first_close), 1) as value,
       case when c.date > g.trade_date and (p.last_valid is null or p.last_valid < c.date) then 'CASH' else t.symbol end as label
from target t join seg g on g.rebal_date = t.rebal_date join calendar c on c.cal_idx between g.trade_idx - 1 and g.end_idx
left join dense p on p.symbol = t.symbol and p.cal_idx = c.cal_idx left join dense b on b.symbol = t.symbol and b.cal_idx = g.trade_idx - 1""")
step("gross", """
select cal_idx, date, gross from (select *, v / lag(v) over (partition by trade_idx order by cal_idx) - 1 as gross from (select trade_idx, cal_idx, date, sum(value) as v from val group by 1, 2, 3)) where cal_idx >= trade_idx""")
step("held", "select cal_idx, date, symbol, v / sum(v) over (partition by cal_idx) as weight from (select cal_idx, date, label as symbol, sum(value) as v from val where cal_idx >= trade_idx group by 1, 2, 3)")
step("idle", "select cal_idx, date from calendar where date >= date '1995-06-30' and cal_idx < (select min(trade_idx) from trade)")
step("before_trade", """
select next_idx as trade_idx, symbol, v / sum(v) over (partition by next_idx) as drift_weight from (
  select n.trade_idx as next_idx, case when v.last_valid is null or v.last_valid < n.trade_date then 'CASH' else v.symbol end as symbol, sum(v.value) as v
  from val v join seg g on g.trade_idx = v.trade_idx and v.cal_idx = g.end_idx join seg n on n.trade_idx = g.end_idx + 1 group by 1, 2)
union all select min(trade_idx), 'CASH', 1.0 from seg""")
step("blotter", """
select s.rebal_date, s.trade_date, s.trade_idx, x.symbol, coalesce(x.t, 0) as target_weight, coalesce(x.d, 0) as drift_weight, coalesce(x.t, 0) - coalesce(x.d, 0) as delta_weight
from (select coalesce(b.trade_idx, a.trade_idx) as trade_idx, coalesce(b.symbol, a.symbol) as symbol, a.weight as t, b.drift_weight as d
      from before_trade b full join (select s.trade_idx, t.symbol, t.weight from target t join seg s using (rebal_date)) a on a.trade_idx = b.trade_idx and a.symbol = b.symbol) x join seg s using (trade_idx)""")
step("cost_raw", """
select b.*, case when u.market_cap_inr > 0 then -log10(u.market_cap_inr) end as a1, case when d.adv > 0 then -log10(d.adv) end as a2, -u.free_float_shares / u.shares_outstanding as a3
from (select *, (select max(quarter_end_date) from universe where quarter_end_date <= trade_date) as q from blotter where symbol <> 'CASH' and abs(delta_weight) > 1e-9) b
left join universe u on u.quarter_end_date = b.q and u.symbol = b.symbol left join adv30 d on d.symbol = b.symbol and d.cal_idx = b.trade_idx""")


def z5(c: str) -> str:
    """A clipped z-score of c within a trade, not yet standardised again."""
    return f"greatest(-5, least(5, case when stddev_samp({c}) over w is null or stddev_samp({c}) over w = 0 then 0 else ({c} - avg({c}) over w) / stddev_samp({c}) over w end))"


def again(c: str) -> str:
    return f"case when {c} is null then 0 when stddev_samp({c}) over w is null or stddev_samp({c}) over w = 0 then 0 else ({c} - avg({c}) over w) / stddev_samp({c}) over w end"


step("cost_z", f"select *, {' + '.join(again(f'c{i}') for i in (1, 2, 3))} as r from (select *, {', '.join(f'case when a{i} is not null then {z5(f'a{i}')} end as c{i}' for i in (1, 2, 3))} from cost_raw window w as (partition by trade_idx)) window w as (partition by trade_idx)")
step("costed", f"select *, least(150, greatest(10, 15 + 8 * greatest(0, {again('c')}))) as cost_bps from (select *, {z5('r')} as c from cost_z window w as (partition by trade_idx)) window w as (partition by trade_idx)")
step("turn", """
select b.rebal_date, b.trade_date, b.trade_idx, b.one_way_turnover, coalesce(c.drag, 0) as drag_decimal, coalesce(c.drag, 0) * 10000 as drag_bps, product(1 - coalesce(c.drag, 0)) over (order by b.trade_idx) as drag_nav
from (select rebal_date, trade_date, trade_idx, sum(abs(delta_weight)) / 2 as one_way_turnover from blotter group by 1, 2, 3) b
left join (select trade_idx, sum(abs(delta_weight) * cost_bps) / 10000 as drag from costed group by 1) c using (trade_idx)""")
step("bench", """
select cal_idx, date, coalesce(l / lag(l) over (order by cal_idx) - 1, 0) as benchmark from (select c.*, last_value(t.close ignore nulls) over (order by c.cal_idx rows unbounded preceding) as l from calendar c left join fx_tri t using (date))""")
step("returns", """
select r.cal_idx, r.date, r.gross, (1 + r.gross) * (1 - coalesce(t.drag_decimal, 0)) - 1 as net, b.benchmark, (1 + r.gross) * (1 - coalesce(t.drag_decimal, 0)) - 1 - b.benchmark as active
from (select * from gross union all select cal_idx, date, 0 from idle) r left join turn t on t.trade_idx = r.cal_idx join bench b on b.cal_idx = r.cal_idx""")
step("weights_all", "select * from held union all select cal_idx, date, 'CASH', 1.0 from idle")


def slice_returns(spark, sf_dir, config: Config) -> DataFrame:
    """(date, gross): from quotes, filings and the schedule to capped targets and their daily gross returns."""
    m = market(spark, sf_dir)
    configs = configs_table(spark, [config])
    wanted = targets(m, configs)
    trade = timeline.trade_dates(wanted.select("run_id", "rebal_date").distinct().withColumn("rebal_offset", F.lit(1)), m.cal)
    return holdings.gross_returns(holdings.values(wanted, holdings.segments(trade, run_bounds(configs, m.cal)), m)).select("date", "gross")


@query("date gross~", "select date, gross from gross")
def minimum_slice(spark, sf_dir):
    """Daily gross returns of the quarterly free-float-capitalisation portfolio."""
    return slice_returns(spark, sf_dir, base_config())


def flagship(spark, sf_dir) -> DataFrame:
    """The same without the stock cap, which tables of a few names can't meet."""
    return slice_returns(spark, sf_dir, base_config(max_stock_wt=None))


@query("date symbol weight~", "select * from weights_all")
def daily_weights(spark, sf_dir):
    return result(spark, sf_dir)[1].weights


@query("rebal_date trade_date symbol target_weight~ drift_weight~ delta_weight~", "select * from blotter")
def trade_blotter(spark, sf_dir):
    return result(spark, sf_dir)[1].trades


@query("trade_date symbol cost_bps~6", "select * from costed")
def illiquidity_costs(spark, sf_dir):
    return result(spark, sf_dir)[1].costed


@query("rebal_date trade_date one_way_turnover~ drag_decimal~ drag_bps~6 drag_nav~", "select * from turn")
def turnover_and_cost(spark, sf_dir):
    return result(spark, sf_dir)[1].turnover


@query("date benchmark~", "select date, benchmark from bench")
def benchmark_returns(spark, sf_dir):
    return holdings.benchmark_returns(fx("tri")(spark, sf_dir), timeline.calendar(quotes(spark, sf_dir)))


@query("date gross~ net~ benchmark~ active~", "select * from returns")
def portfolio_returns(spark, sf_dir):
    return result(spark, sf_dir)[1].returns


# ---- performance -------------------------------------------------------------------------------------------------

step("series", "select date, 'gross' as series, gross as r from returns union all select date, 'net', net from returns union all select date, 'benchmark', benchmark from returns")
step("curve", """
select date, series, equity, equity / max(equity) over (partition by series order by date) - 1 as drawdown from (
  select date, series, product(1 + r) over (partition by series order by date) as equity from series
  union all select date, 'active', product(1 + net) over (order by date) / product(1 + benchmark) over (order by date) from returns)""")


@query("series days cagr~ annual_vol~ sharpe~ sortino~ total_return~", """
select *, case when annual_vol > 0 then cagr / annual_vol end as sharpe, case when down > 0 then cagr / down end as sortino from (
  select series, count(r) as days, case when product(1 + r) <= 0 then 0 else pow(product(1 + r), 252.0 / count(r)) - 1 end as cagr, stddev_samp(r) * sqrt(252) as annual_vol,
         stddev_samp(r) filter (r < 0) * sqrt(252) as down, product(1 + r) - 1 as total_return from series group by 1)""")
def series_statistics(spark, sf_dir):
    return metrics.series_statistics(result(spark, sf_dir)[1].returns)


@query("hit_rate~ tracking_error~ information_ratio~", "select avg(cast(active > 0 as int)) as hit_rate, stddev_samp(active) * sqrt(252) as tracking_error, avg(active) * 252 / (stddev_samp(active) * sqrt(252)) as information_ratio from returns")
def relative_statistics(spark, sf_dir):
    return metrics.relative_statistics(result(spark, sf_dir)[1].returns)


@query("date series equity~ drawdown~", "select * from curve")
def equity_and_drawdown(spark, sf_dir):
    return metrics.curves(result(spark, sf_dir)[1].returns)


@query("series max_drawdown~ start_date trough_date recovery_date recovery_days", """
select series, max_drawdown, start_date, trough_date, recovery_date, recovery_date - trough_date as recovery_days from (
  select c.series, t.max_drawdown, t.trough_date, coalesce(max(c.date) filter (c.drawdown >= 0 and c.date <= t.trough_date), min(t.first)) as start_date, min(c.date) filter (c.drawdown >= 0 and c.date > t.trough_date) as recovery_date
  from curve c join (select series, min(drawdown) as max_drawdown, min(date) as first, arg_min(date, (drawdown, date)) as trough_date from curve where series <> 'active' group by 1) t on t.series = c.series group by 1, 2, 3)""")
def max_drawdowns(spark, sf_dir):
    return metrics.max_drawdown(result(spark, sf_dir)[1].returns)


@query("year gross~ net~ benchmark~ active~", """
select *, net - benchmark as active from (select year(date) as year, product(1 + gross) - 1 as gross, product(1 + net) - 1 as net, product(1 + benchmark) - 1 as benchmark from returns group by 1)""")
def calendar_years(spark, sf_dir):
    return metrics.calendar_years(result(spark, sf_dir)[1].returns)


@query("date annual_return~ annual_vol~ sharpe~ information_ratio~", """
select date, a as annual_return, v as annual_vol, a / nullif(v, 0) as sharpe, i as information_ratio from (
  select date, count(*) over w as n, pow(product(1 + net) over w, 1) - 1 as a, stddev_samp(net) over w * sqrt(252) as v, avg(active) over w * 252 / nullif(stddev_samp(active) over w * sqrt(252), 0) as i
  from returns window w as (order by date rows between 251 preceding and current row)) where n = 252""")
def rolling_statistics(spark, sf_dir):
    return metrics.rolling_statistics(result(spark, sf_dir)[1].returns)


@query("avg_positions~ mean_turnover~ annual_turnover~ mean_cost_bps~6 annual_cost_bps~6", """
select (select count(*) from weights_all where symbol <> 'CASH' and weight > 1e-9) / n as avg_positions, mt as mean_turnover, st / (n / 252) as annual_turnover, mc as mean_cost_bps, sc / (n / 252) as annual_cost_bps
from (select count(*) as n from returns), (select avg(one_way_turnover) as mt, sum(one_way_turnover) as st, avg(drag_bps) as mc, sum(drag_bps) as sc from turn)""")
def portfolio_averages(spark, sf_dir):
    r = result(spark, sf_dir)[1]
    return metrics.portfolio_averages(r.weights, r.turnover, r.returns)


SUMMARY = [f"{x}_{c}" for x in ("gross", "net", "benchmark") for c in ("cagr", "annual_vol", "sharpe", "sortino", "total_return")]
SUMMARY_SQL = f"""
select a.*, f.*, r.*, p.* from (select max(days) as days, {', '.join(f"max(case when series = '{c.partition('_')[0]}' then {c.partition('_')[2]} end) as {c}" for c in SUMMARY)} from ({ORACLE_SQL['series_statistics']})) a,
  (select {', '.join(f"max(case when series = '{x}' then max_drawdown end) as {x}_max_drawdown" for x in ('gross', 'net', 'benchmark'))} from ({ORACLE_SQL['max_drawdowns']})) f, ({ORACLE_SQL['relative_statistics']}) r, ({ORACLE_SQL['portfolio_averages']}) p"""


@query(f"days {' '.join(c + '~7' for c in SUMMARY)} gross_max_drawdown~7 net_max_drawdown~7 benchmark_max_drawdown~7 hit_rate~7 tracking_error~7 information_ratio~7 avg_positions~7 mean_turnover~7 annual_turnover~7 mean_cost_bps~5 annual_cost_bps~5", SUMMARY_SQL)
def base_summary(spark, sf_dir):
    """The summary row of the base run, whole."""
    return result(spark, sf_dir)[1].summary()


@query("run_id days net_cagr~ net_max_drawdown~ hit_rate~ mean_turnover~")
def strategy_summaries(spark, sf_dir):
    """Several runs at once over shared panels, with signals, joint caps and cash."""
    configs = [base_config(), base_config(run_id="equal", weighting="equal", cash_buffer=0.05), base_config(run_id="joint", max_stock_wt=0.15, max_sector_wt=0.4),
                  base_config(run_id="momentum", signal="mom_lvol", signal_top_n=15, start=datetime.date(1996, 12, 31)), base_config(run_id="monthly", rebal_freq="M")]
    return run_strategies(market(spark, sf_dir), configs_table(spark, configs), buckets=BUCKETS).summary()


# ---- attribution and reports -------------------------------------------------------------------------------------

step("sector_of", "select symbol, sector from fx_sector union all select 'CASH', 'CASH'")
step("sector_w", "select w.cal_idx, w.date, coalesce(s.sector, 'UNCLASSIFIED') as sector, sum(w.weight) as weight from weights_all w left join sector_of s using (symbol) group by 1, 2, 3")
step("earning", """
select w.cal_idx + 1 as cal_idx, w.symbol, w.weight as earning from weights_all w where w.cal_idx + 1 not in (select trade_idx from trade) and w.cal_idx < (select max(cal_idx) from calendar)
union all select trade_idx, symbol, target_weight from blotter""")
step("sector_gross", "select e.cal_idx, coalesce(s.sector, 'UNCLASSIFIED') as sector, sum(case when e.symbol = 'CASH' then 0 else e.earning * coalesce(d.ret, 0) end) as g from earning e left join dense_ret d using (symbol, cal_idx) left join sector_of s using (symbol) group by 1, 2")
step("sector_cost", "select c.trade_idx as cal_idx, coalesce(s.sector, 'UNCLASSIFIED') as sector, sum(abs(delta_weight) * cost_bps / 10000) as c from costed c left join sector_of s using (symbol) group by 1, 2")
step("contribution", """
select *, sum(contrib_net * nav) over (partition by sector order by cal_idx) * 100 as cum_contrib_net_pct from (
  select r.cal_idx, r.date, x.sector, coalesce(w.weight, 0) as weight, coalesce(g.g, 0) as contrib_gross, coalesce(c.c, 0) as contrib_tcost, coalesce(g.g, 0) * (1 - coalesce(d.d, 0)) - coalesce(c.c, 0) as contrib_net,
         coalesce(product(1 + r.net) over (partition by x.sector order by r.cal_idx rows between unbounded preceding and 1 preceding), 1) as nav
  from returns r cross join (select distinct sector from sector_gross union select distinct sector from sector_w) x
  left join sector_gross g on g.cal_idx = r.cal_idx and g.sector = x.sector left join sector_cost c on c.cal_idx = r.cal_idx and c.sector = x.sector
  left join sector_w w on w.cal_idx = r.cal_idx and w.sector = x.sector left join (select cal_idx, sum(c) as d from sector_cost group by 1) d on d.cal_idx = r.cal_idx)""")
step("bench_sector", "select quarter_end_date, sector, f / sum(f) over (partition by quarter_end_date) as benchmark_wt from (select u.quarter_end_date, coalesce(s.sector, 'UNCLASSIFIED') as sector, sum(free_float_market_cap_inr) as f from universe u left join sector_of s using (symbol) where free_float_market_cap_inr > 0 group by 1, 2)")
step("active_sector", """
select coalesce(p.date, b.date) as date, coalesce(p.sector, b.sector) as sector, coalesce(p.weight, 0) as portfolio_wt, coalesce(b.benchmark_wt, 0) as benchmark_wt, coalesce(p.weight, 0) - coalesce(b.benchmark_wt, 0) as active_wt
from sector_w p full join (select d.date, s.sector, s.benchmark_wt from (select date, (select max(quarter_end_date) from universe u where u.quarter_end_date <= r.date) as q from returns r) d join bench_sector s on s.quarter_end_date = d.q) b on b.date = p.date and b.sector = p.sector""")


@query("date sector weight~ contrib_gross~ contrib_tcost~ contrib_net~ cum_contrib_net_pct~6", "select * from contribution")
def sector_contribution(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return r.contribution(m)


@query("date sector portfolio_wt~ benchmark_wt~ active_wt~", "select * from active_sector")
def active_sector_weights(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return r.active_sectors(m)


@query("gross_ok net_ok weight_ok", """
select max(abs(x.g - r.gross)) < 1e-9 as gross_ok, max(abs(x.n - r.net)) < 1e-9 as net_ok, max(abs(x.w - 1)) < 1e-9 as weight_ok
from (select cal_idx, sum(contrib_gross) as g, sum(contrib_net) as n, sum(weight) as w from contribution group by 1) x join returns r using (cal_idx)""")
def identity_residuals(spark, sf_dir):
    m, r = result(spark, sf_dir)
    found = attribution.identity_residuals(r.contribution(m), r.returns, r.weights)
    return found.select(*((F.col(f"{c}_residual") < 1e-9).alias(f"{c}_ok") for c in ("gross", "net", "weight")))


@query("sector cum_contrib_net_pct~6 active_wt~", "select c.sector, c.cum_contrib_net_pct, a.active_wt from contribution c left join active_sector a on a.date = c.date and a.sector = c.sector where c.date = (select max(date) from returns)")
def headline_attribution(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return attribution.headline(r.contribution(m), r.active_sectors(m))


@query("date positions", "select date, count(*) filter (symbol <> 'CASH' and weight > 1e-9) as positions from weights_all group by 1")
def position_count(spark, sf_dir):
    return reports.position_count(result(spark, sf_dir)[1].weights)


step("last_held", "select * from weights_all where date = (select max(date) from returns) and symbol <> 'CASH' and weight > 1e-9")


@query("symbol weight~ place", "select * from (select symbol, weight, row_number() over (order by weight desc, symbol) as place from last_held) where place <= 20")
def top_holdings(spark, sf_dir):
    return reports.top_holdings(result(spark, sf_dir)[1].weights)


@query("place symbol cumulative_weight~ hhi~", "select row_number() over w as place, symbol, sum(weight) over w as cumulative_weight, (select sum(weight * weight) from last_held) as hhi from last_held window w as (order by weight desc, symbol rows unbounded preceding)")
def concentration_curve(spark, sf_dir):
    return reports.concentration(result(spark, sf_dir)[1].weights)


@query("symbol active_weight~ side place", """
with b as (select symbol, free_float_market_cap_inr / sum(free_float_market_cap_inr) over () as b from universe where quarter_end_date = (select max(quarter_end_date) from universe)),
x as (select coalesce(h.symbol, b.symbol) as symbol, coalesce(h.weight, 0) - coalesce(b.b, 0) as active_weight from last_held h full join b on b.symbol = h.symbol where abs(coalesce(h.weight, 0) - coalesce(b.b, 0)) > 1e-9)
select * from (select symbol, active_weight, 'over' as side, row_number() over (order by active_weight desc, symbol) as place from x) where place <= 10
union all select * from (select symbol, active_weight, 'under', row_number() over (order by active_weight, symbol) as place from x) where place <= 10""")
def active_positions(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return reports.active_positions(r.weights, m.universe)


@query("date grp weight~", """
select date, grp, sum(weight) as weight from (
  select w.date, w.weight, case when w.symbol = 'CASH' then 'CASH' when u.rank is null then 'unclassified' when u.rank <= 10 then 'large' when u.rank <= 25 then 'mid' else 'small' end as grp
  from weights_all w asof left join universe u on u.symbol = w.symbol and u.quarter_end_date <= w.date) group by 1, 2 having abs(sum(weight)) > 1e-9""")
def size_bucket_weights(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return reports.size_bucket_weights(r.weights, m.universe, BUCKETS)


@query("sector mean_weight~", "select sector, avg(weight) as mean_weight from sector_w group by 1")
def sectors_by_mean_weight(spark, sf_dir):
    m, r = result(spark, sf_dir)
    own = attribution.sector_weights(r.weights, m.sectors).withColumnRenamed("sector", "grp")
    return reports.groups_by_mean_weight(own).withColumnRenamed("grp", "sector")


@query("sector cum_contrib_net_pct~6", "select sector, cum_contrib_net_pct from contribution where date = (select max(date) from returns) and abs(cum_contrib_net_pct) > 1e-9")
def end_contribution(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return reports.end_contribution(r.contribution(m))


@query("sector active_wt~", "select sector, active_wt from active_sector where date = (select max(date) from returns) and abs(active_wt) > 1e-9")
def end_tilt(spark, sf_dir):
    m, r = result(spark, sf_dir)
    return reports.end_tilt(r.active_sectors(m))


@query("trade_date one_way_turnover~ drag_bps~6", "select * from turn")
def trade_bars(spark, sf_dir):
    return reports.trade_bars(result(spark, sf_dir)[1].turnover)


# ---- quality checks ----------------------------------------------------------------------------------------------

AS_OF = "2001-11-10"
step("meta", "select symbol, min(quarter_end_date) as first_in_universe_date, max(quarter_end_date) as last_in_universe_date from universe group by 1")


def checks_sql(*rows: tuple[str, str, str, str]) -> str:
    """(name, metric, condition that passes, condition that warns) to one table."""
    return " union all ".join(f"select '{n}' as name, case when {p} then 'PASS' when {w} then 'WARN' else 'FAIL' end as status, cast(metric as double) as metric from (select {m} as metric)" for n, m, p, w in rows)


def few(name: str, bad: str, warn: int | None) -> tuple[str, str, str, str]:
    return name, f"(select count(*) from ({bad}))", "metric = 0", "true" if warn is None else f"metric <= {warn}"


def quality_tables(spark, sf_dir) -> quality.Tables:
    m = market(spark, sf_dir)
    q = staged_quotes(spark, sf_dir)
    gaps = spark.createDataFrame([("prices", "S1", "x"), ("prices", "S2", "x"), ("financials", "S3", "x")], "script string, symbol string, reason string")
    return quality.Tables(
        prices=panel.melt_panel(q), shares=fx("shares")(spark, sf_dir), universe=m.universe, metadata=staged(universe.metadata(m.universe)), financials=staged_financials(spark, sf_dir), classification=m.sectors,
        published=m.sectors.select("symbol", F.col("macro_sector").alias("sector")), ledger=fx("actions")(spark, sf_dir), fallback=q.where("symbol <> 'S1'"), gaps=gaps)


def all_of(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("name status metric~", checks_sql(
    few("shares_parts_add_up", "select 1 from fx_shares where abs(promoter_shares + public_shares + non_pub_nonp_shares - total_shares) > 1", 5),
    few("shares_in_range", "select 1 from fx_shares where free_float_shares <= 0 or free_float_shares > total_shares or promoter_shares < 0", 5),
    few("metadata_without_filings", "select symbol from meta where symbol not in (select symbol from fx_shares)", None)))
def shares_checks(spark, sf_dir):
    return all_of(quality.shares_checks(quality_tables(spark, sf_dir)))


@query("name status metric~", checks_sql(
    ("universe_quarters", "(select count(distinct quarter_end_date) from universe)", "metric >= 28", "metric >= 20"),
    ("universe_size", "(select min(n) from (select count(*) as n from universe group by quarter_end_date))", "metric >= 490", "metric >= 480"),
    ("universe_no_repeats", "(select sum(n - 1) from (select count(*) as n from universe group by quarter_end_date, symbol))", "metric = 0", "false"),
    ("metadata_size", "(select count(*) from meta)", "metric between 500 and 1500", "metric > 0"),
    few("universe_in_metadata", "select 1 from universe where symbol not in (select symbol from meta)", 10)))
def universe_checks(spark, sf_dir):
    return all_of(quality.universe_checks(quality_tables(spark, sf_dir)))


step("long_panel", " union all ".join(f"select date, symbol, '{c}' as parameter, {c} as value from fx_quotes where {c} is not null" for c in ("open", "high", "low", "close", "volume")))
#: A panel with every fault: names without volume, repeated rows, negative lows, highs below lows and closes that are missing.
step("bad_panel", """
select date, symbol, parameter, case when parameter = 'low' and symbol like '%3' and day(date) = 1 then -value when parameter = 'high' and symbol like '%4' and day(date) = 2 then value * 0.5 else value end as value
from long_panel where not (parameter = 'volume' and symbol like '%7') and not (parameter = 'close' and symbol like '%8' and year(date) < 2000) and symbol not like '%9'
union all select * from long_panel where symbol like '%5' and parameter = 'open' and day(date) = 3""")
#: Symbols whose prices failed, by panel.
step("good_gaps", "select 'prices' as script, 'S1' as symbol union all select 'prices', 'S2' union all select 'financials', 'S3'")
step("bad_gaps", "select 'prices' as script, symbol from fx_sector where symbol like '%1' or symbol like '%2' union all select 'financials', symbol from fx_sector where symbol like '%4'")
step("bad_ledger", "select case when symbol like '%6' then concat('X', symbol) else symbol end as symbol, case when symbol like '%5' then 'merger' else action_type end as action_type from fx_actions")


def cover_sql(panel_step: str) -> str:
    return f"""
select m.symbol, count(*) / greatest(1.0, (m.last_in_universe_date - m.first_in_universe_date + 1) * 5.0 / 7) as coverage from meta m
join {panel_step} q on q.symbol = m.symbol and q.date between m.first_in_universe_date and m.last_in_universe_date and q.parameter = 'close' group by m.symbol, m.first_in_universe_date, m.last_in_universe_date"""


step("cover", cover_sql("long_panel"))
step("moves", "select * from (select symbol, date, close, round(close / lag(close) over (partition by symbol order by date) - 1, 4) as change from fx_quotes) where abs(change) > 0.05")


def price_checks_sql(p: str, gaps: str, fallback: str, ledger: str, as_of: str) -> str:
    wide = f"select date, symbol, {', '.join(f'max(case when parameter = {c!r} then value end) as {c}' for c in ('open', 'high', 'low', 'close'))} from {p} group by 1, 2"
    moved = f"select * from (select round(value / lag(value) over (partition by symbol order by date) - 1, 4) as change from {p} where parameter = 'close') where abs(change) > 0.05"
    return checks_sql(
        ("price_symbol_coverage", f"(select avg(case when symbol in (select symbol from {p}) then 1.0 else 0 end) from meta)", "metric >= 0.95", "metric >= 0.8"),
        few("price_fields", f"select symbol from {p} group by symbol having count(distinct parameter) <> 5", 5),
        ("price_no_repeats", f"(select coalesce(sum(n - 1), 0) from (select count(*) as n from {p} group by date, symbol, parameter))", "metric = 0", "metric <= 10"),
        few("close_coverage", f"select 1 from ({cover_sql(p)}) where coverage < 0.8", 5),
        few("no_negative_prices", f"select 1 from {p} where parameter in ('open', 'high', 'low', 'close') and value < 0", 5),
        few("ohlc_order", f"select 1 from ({wide}) where high < low or high < open or high < close or low > open or low > close", 10),
        few("large_moves", moved, None),
        ("price_staleness", f"(select date '{as_of}' - max(date) from {p})", "metric <= 5", "metric <= 14"),
        ("fallback_coverage", f"(select avg(case when symbol in ({fallback}) then 1.0 else 0 end) from (select distinct symbol from {gaps} where script = 'prices'))", "metric >= 0.8", "metric >= 0.5"),
        few("action_types", f"select 1 from {ledger} where action_type not in ('split', 'bonus', 'dividend')", 0),
        few("action_symbols", f"select distinct symbol from {ledger} where symbol not in (select symbol from {p})", 2))


def bad_price_tables(spark, sf_dir) -> quality.Tables:
    t = quality_tables(spark, sf_dir)
    p = t.prices
    value = F.expr("case when parameter = 'low' and symbol like '%3' and day(date) = 1 then -value when parameter = 'high' and symbol like '%4' and day(date) = 2 then value * 0.5 else value end")
    bad = p.where("not (parameter = 'volume' and symbol like '%7') and not (parameter = 'close' and symbol like '%8' and year(date) < 2000) and symbol not like '%9'").withColumn("value", value)
    gaps = t.classification.selectExpr("symbol", "case when symbol like '%1' or symbol like '%2' then 'prices' when symbol like '%4' then 'financials' end as script", "'x' as reason").where("script is not null")
    ledger = t.ledger.withColumns({"symbol": F.expr("if(symbol like '%6', concat('X', symbol), symbol)"), "action_type": F.expr("if(symbol like '%5', 'merger', action_type)")})
    return dataclasses.replace(t, prices=staged(bad.unionByName(p.where("symbol like '%5' and parameter = 'open' and day(date) = 3"))), gaps=gaps, ledger=ledger, fallback=t.fallback.where("symbol like '%1'"))


@query("name status metric~", price_checks_sql("long_panel", "good_gaps", "select symbol from fx_quotes where symbol <> 'S1'", "fx_actions", AS_OF))
def price_checks(spark, sf_dir):
    return all_of(quality.price_checks(quality_tables(spark, sf_dir), AS_OF, 0.05))


@query("name status metric~", price_checks_sql("bad_panel", "bad_gaps", "select symbol from fx_quotes where symbol like '%1' and symbol <> 'S1'", "bad_ledger", "2001-11-20"))
def price_checks_of_faults(spark, sf_dir):
    """The checks of prices where each has something to find."""
    return all_of(quality.price_checks(bad_price_tables(spark, sf_dir), "2001-11-20", 0.05))


@query("symbol date close~ change~4", "select * from moves")
def price_outliers(spark, sf_dir):
    return quality.outliers(panel.melt_panel(quotes(spark, sf_dir)), 0.05)


@query("symbol coverage~", "select * from cover")
def close_coverage(spark, sf_dir):
    t = quality_tables(spark, sf_dir)
    return quality.close_coverage(t.prices, t.metadata)


step("bad_fin", """
select symbol, case when symbol like '%8' and parameter = 'ebitda' then cast(date + interval 1 month as date) when symbol like '%9' then cast(date + interval 24 month as date) else date end as date, parameter, value
from fin_derived where not (symbol like '%6' and parameter = 'net_profit') and symbol not like '%5' and not (symbol like '%7' and year(date) < 1999)
union all select symbol, date, 'eps', 1.0 from fin_derived where parameter = 'pbt' and symbol not like '%4' and symbol not like '%5' and not (symbol like '%7' and year(date) < 1999)""")
step("bad_sector", """
select symbol, case when symbol like '%1' then 'UNKNOWN' when symbol like '%2' then 'Energy' else macro_sector end as macro_sector, case when symbol like '%1' or symbol like '%3' then 'UNKNOWN' when symbol like '%2' then 'Power' else sector end as sector from fx_sector where symbol not like '%4'""")
CORE_SQL = "count(distinct case when parameter like 'total_revenue%' then 1 when parameter like 'net_profit%' then 2 when parameter like 'eps%' then 3 when parameter like 'ebitda%' or parameter like 'pbt%' then 4 end)"


def financial_checks_sql(f: str, gaps: str, tenure: int) -> str:
    depth = f"select coalesce(avg(case when coalesce(n, 0) >= 40 then 1.0 else 0 end), 1.0) from meta left join (select symbol, count(distinct date) as n from {f} group by 1) using (symbol) where last_in_universe_date - first_in_universe_date >= {tenure}"
    return checks_sql(
        few("financials_or_logged", f"select 1 from meta where symbol not in (select symbol from {f}) and symbol not in (select symbol from {gaps} where script = 'financials')", 10),
        ("quarter_alignment", f"(select avg(case when month(date) % 3 = 0 then 1.0 else 0 end) from {f})", "metric >= 0.9", "metric >= 0.75"),
        few("core_line_items", f"select symbol from {f} group by symbol having {CORE_SQL} < 4", 10),
        few("no_future_periods", f"select 1 from {f} where date > date '{AS_OF}'", 5),
        ("financial_depth", f"({depth})", "metric >= 0.8", "metric >= 0.6"))


def sectors_in(names: tuple, column: str, c: str) -> str:
    return f"select distinct {column} from {c} where {column} <> 'UNKNOWN' and {column} not in ({', '.join(chr(39) + n.replace(chr(39), chr(39) * 2) + chr(39) for n in names)})"


def classification_checks_sql(c: str) -> str:
    return checks_sql(
        few("classification_coverage", f"select 1 from meta where symbol not in (select symbol from {c})", 10),
        ("classification_unknown", f"(select avg(case when sector = 'UNKNOWN' then 1.0 else 0 end) from {c})", "metric <= 0.05", "metric <= 0.1"),
        few("new_macro_sectors", sectors_in(quality.KNOWN_MACRO, "macro_sector", c), None),
        few("new_sectors", sectors_in(quality.KNOWN_SECTORS, "sector", c), None),
        few("sector_agreement", f"select 1 from {c} join fx_sector p using (symbol) where {c}.sector <> p.macro_sector", None))


def cross_checks_sql(p: str, f: str, gaps: str) -> str:
    return checks_sql(
        few("prices_in_metadata", f"select distinct symbol from {p} where symbol not in (select symbol from meta)", 5),
        few("financials_in_metadata", f"select distinct symbol from {f} where symbol not in (select symbol from meta)", 5),
        few("universe_in_a_panel", f"select distinct symbol from universe where symbol not in (select symbol from {p}) and symbol not in (select symbol from {f})", 10),
        ("failure_ratio", f"(select (select count(distinct symbol) from {gaps}) * 1.0 / count(*) from meta)", "metric < 0.15", "metric < 0.3"))


def bad_tables(spark, sf_dir) -> quality.Tables:
    t = bad_price_tables(spark, sf_dir)
    f = t.financials
    date = F.expr("case when symbol like '%8' and parameter = 'ebitda' then add_months(date, 1) when symbol like '%9' then add_months(date, 24) else date end")
    own = f.where("not (symbol like '%6' and parameter = 'net_profit') and symbol not like '%5' and not (symbol like '%7' and year(date) < 1999)").withColumn("date", date)
    eps = f.where("parameter = 'pbt' and symbol not like '%4' and symbol not like '%5' and not (symbol like '%7' and year(date) < 1999)").withColumns({"parameter": F.lit("eps"), "value": F.lit(1.0)})
    c = t.classification.where("symbol not like '%4'").withColumns({
        "macro_sector": F.expr("case when symbol like '%1' then 'UNKNOWN' when symbol like '%2' then 'Energy' else macro_sector end"),
        "sector": F.expr("case when symbol like '%1' or symbol like '%3' then 'UNKNOWN' when symbol like '%2' then 'Power' else sector end")})
    return dataclasses.replace(t, financials=staged(own.unionByName(eps)), classification=staged(c))


@query("name status metric~", financial_checks_sql("fin_derived", "good_gaps", 3650))
def financial_checks(spark, sf_dir):
    return all_of(quality.financial_checks(quality_tables(spark, sf_dir), AS_OF))


@query("name status metric~", financial_checks_sql("bad_fin", "bad_gaps", 1000))
def financial_checks_of_faults(spark, sf_dir):
    return all_of(quality.financial_checks(bad_tables(spark, sf_dir), AS_OF, 1000))


@query("name status metric~", classification_checks_sql("fx_sector"))
def classification_checks(spark, sf_dir):
    return all_of(quality.classification_checks(quality_tables(spark, sf_dir)))


@query("name status metric~", classification_checks_sql("bad_sector"))
def classification_checks_of_faults(spark, sf_dir):
    return all_of(quality.classification_checks(bad_tables(spark, sf_dir)))


@query("name status metric~", cross_checks_sql("long_panel", "fin_derived", "good_gaps"))
def cross_checks(spark, sf_dir):
    return all_of(quality.cross_checks(quality_tables(spark, sf_dir)))


@query("name status metric~", cross_checks_sql("bad_panel", "bad_fin", "bad_gaps"))
def cross_checks_of_faults(spark, sf_dir):
    return all_of(quality.cross_checks(bad_tables(spark, sf_dir)))


step("part_universe", """
select symbol, quarter_end_date from (select symbol, last_day(date_trunc('quarter', date) + interval 2 month) as quarter_end_date, row_number() over (partition by last_day(date_trunc('quarter', date) + interval 2 month) order by max(close) desc, symbol) as r
from fx_part_quotes group by 1, 2) where r <= 100""")
step("part_events", "select cast(o_orderdate as date) as event_date, concat('P', cast(o_custkey as string)) as p, concat('P', cast(o_custkey + 1 as string)) as s from orders")
step("part_spans", "select symbol, min(quarter_end_date) as a, max(quarter_end_date) as z from part_universe group by 1")


def part_tables(spark, sf_dir) -> quality.Tables:
    q = fx("part_quotes")(spark, sf_dir)
    u = q.groupBy("symbol", F.last_day(F.add_months(F.trunc("date", "quarter"), 2)).alias("quarter_end_date")).agg(F.max("close").alias("c"))
    u = u.withColumn("r", F.row_number().over(Window.partitionBy("quarter_end_date").orderBy(F.desc("c"), "symbol"))).where("r <= 100")
    events = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("cast(o_orderdate as date) as event_date", "'merger' as event_type", "concat('P', o_custkey) as predecessor_symbols", "concat('P', o_custkey + 1) as successor_symbols")
    return quality.Tables(universe=u, actions=events, history=part_history(spark, sf_dir))


def part_changes(spark, sf_dir):
    t = part_tables(spark, sf_dir)
    return quality.unexplained_changes(t.universe, t.actions, t.history)


@query("symbol last_quarter", """
select x.symbol, x.z as last_quarter from part_spans x join part_history h using (symbol) where x.z < (select max(quarter_end_date) from part_universe)
and not exists (select 1 from part_events e where e.p = x.symbol and e.event_date between x.z - interval 12 month and x.z + interval 12 month) and (h.last_seen_date is null or abs(h.last_seen_date - x.z) > 365)""")
def unexplained_exits(spark, sf_dir):
    return part_changes(spark, sf_dir)[0]


@query("symbol first_quarter", """
select x.symbol, x.a as first_quarter from part_spans x join part_history h using (symbol) where x.a > (select min(quarter_end_date) from part_universe)
and not exists (select 1 from part_events e where e.s = x.symbol and e.event_date between x.a - interval 12 month and x.a + interval 12 month) and (h.first_seen_date is null or abs(h.first_seen_date - x.a) > 365)""")
def unexplained_entries(spark, sf_dir):
    return part_changes(spark, sf_dir)[1]


@query("name status metric~", checks_sql(few("unexplained_exits", ORACLE_SQL["unexplained_exits"], 10), few("unexplained_entries", ORACLE_SQL["unexplained_entries"], None)))
def change_checks(spark, sf_dir):
    return all_of(quality.change_checks(part_tables(spark, sf_dir)))


CHECK_GROUPS = ("shares_checks", "universe_checks", "price_checks", "financial_checks", "classification_checks", "cross_checks")
EVERY_CHECK = " union all ".join([f"select name, status from ({ORACLE_SQL[g]})" for g in CHECK_GROUPS] + ["select 'exists', 'PASS' from range(6)"])


@query("status passed warned failed", f"select case when count(*) filter (status = 'FAIL') > 0 then 'FAIL' else 'PASS' end as status, count(*) filter (status = 'PASS') as passed, count(*) filter (status = 'WARN') as warned, count(*) filter (status = 'FAIL') as failed from ({EVERY_CHECK})")
def overall_quality(spark, sf_dir):
    return quality.overall(quality.validate(quality_tables(spark, sf_dir), spark, AS_OF, 0.05))


# ---- remaining panel and lookup operators ------------------------------------------------------------------------


@query("symbol missing n", """
select symbol, false as missing, count(close) as n from fx_quotes where symbol not like '%6' group by 1 union all select distinct symbol, true, 0 from fx_quotes where symbol like '%6'""")
def vendor_frame(spark, sf_dir):
    q = quotes(spark, sf_dir)
    frame = q.where("symbol not like '%6'").withColumn("date", F.col("date").cast("timestamp"))
    long, missing = panel.vendor_long(frame, q)
    have = long.where("parameter = 'close'").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(False))
    return have.unionByName(missing.withColumns({"n": F.lit(0).cast("long"), "missing": F.lit(True)}))


@query("script symbol reason", "select distinct 'prices' as script, symbol, 'UnadjustedFallback' as reason from fx_quotes where symbol not in (select symbol from fx_actions where action_type = 'split')")
def fallback_gaps(spark, sf_dir):
    return corpact.adjusted_fallback(quotes(spark, sf_dir), fx("actions")(spark, sf_dir).where("action_type = 'split'"))[1]


@query("source n", "select case when symbol like '%2' then 'override' when symbol like '%9' then 'none' else 'page' end as source, count(*) as n from fx_sector group by 1")
def classification_sources(spark, sf_dir):
    s = fx("sector")(spark, sf_dir)
    return universe.source_counts(universe.resolve_classification(s, [("override", s.where("symbol like '%2'")), ("page", s.where("symbol not like '%9'"))]))


@query("ticker sector", """
select concat('S', cast(s_suppkey as string)) as ticker, case when s_suppkey % 4 = 0 then concat('by isin ', cast(s_suppkey as string)) when s_suppkey % 3 = 0 then concat('by ticker ', cast(s_suppkey as string)) end as sector from supplier""")
def two_key_lookup(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    rows = s.selectExpr("if(s_suppkey % 2 = 0, concat('I', s_suppkey), null) as isin", "concat('S', s_suppkey) as ticker")
    master = s.where("s_suppkey % 4 = 0").selectExpr("concat('I', s_suppkey) as isin", "cast(null as string) as ticker", "concat('by isin ', s_suppkey) as sector").unionByName(
        s.where("s_suppkey % 3 = 0").selectExpr("cast(null as string) as isin", "concat('S', s_suppkey) as ticker", "concat('by ticker ', s_suppkey) as sector"))
    return universe.lookup_by_isin_or_ticker(rows, master, "sector")


# ---- landed files and texts --------------------------------------------------------------------------------------


def landed(spark, name: str) -> str:
    """A new folder for files of a query."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("date symbol parameter value~", "select date, symbol, 'close' as parameter, close as value from fx_quotes union all select date, symbol, 'volume', volume from fx_quotes")
def landed_panel(spark, sf_dir):
    path = landed(spark, "panel")
    readers.write_long_panel(panel.melt_panel(quotes(spark, sf_dir), ["close", "volume"]), path)
    return readers.read_long_panel(spark, path)


@query("symbol date", "select symbol, date from fx_quotes")
def landed_daily_symbols(spark, sf_dir):
    path = landed(spark, "daily")
    quotes(spark, sf_dir).write.parquet(path)
    return readers.daily_symbols(spark, path)


@query("symbol isin company_name listing_date", "select concat('P', cast(p_partkey as string)) as symbol, concat('IN', cast(p_partkey as string)) as isin, p_name as company_name, date '2001-03-31' as listing_date from part where p_partkey % 3 <> 0")
def landed_listed(spark, sf_dir):
    """Listed equities of the main board among those of other series, from CSV with the exchange's headers."""
    path = landed(spark, "listed")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "concat('P', p_partkey) as SYMBOL", "p_name as `NAME OF COMPANY`", "if(p_partkey % 3 <> 0, 'EQ', 'BE') as ` SERIES`", "'31-MAR-2001' as ` DATE OF LISTING`", "concat('IN', p_partkey) as ` ISIN NUMBER`")
    rows.write.option("header", True).csv(path)
    return readers.read_listed(spark, path)


@query("date close~", "select date, close from fx_tri")
def landed_levels(spark, sf_dir):
    """A benchmark's history in two overlapping chunks of CSV, of which the later one counts."""
    tri = fx("tri")(spark, sf_dir)
    paths = {"old": landed(spark, "old"), "new": landed(spark, "new")}
    tri.where("date < date'1997-01-01'").withColumn("close", F.when(F.col("date") >= "1996-01-01", 0.0).otherwise(F.col("close"))).write.option("header", True).csv(paths["old"])
    tri.where("date >= date'1996-01-01'").write.option("header", True).csv(paths["new"])
    return readers.consolidate_levels([readers.benchmark_level(spark, paths, k) for k in ("old", "new")])


@query("o_orderkey filed quarter_end year_end name amount~ record growth~", """
select o_orderkey, cast(o_orderdate as date) as filed, last_day(o_orderdate) as quarter_end, make_date(year(o_orderdate), 3, 31) as year_end,
  trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') as name, 1000 + o_orderkey % 1000 as amount, o_orderkey as record, (o_totalprice - o_orderkey) / nullif(o_orderkey, 0) as growth from orders""")
def parsed_texts(spark, sf_dir):
    """Dates, periods, names, numbers and ids as filings and pages spell them."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    period = F.concat(F.date_format("o_orderdate", "MMM yyyy"), F.expr("case o_orderkey % 3 when 0 then ' TTM' when 1 then 'ttm' else '' end"))
    filed = F.expr("date_format(o_orderdate, case o_orderkey % 3 when 0 then 'dd-MMM-yyyy' when 1 then 'dd-MM-yyyy' else 'yyyy-MM-dd' end)")
    return o.select(
        "o_orderkey", scalars.parse_date(filed).alias("filed"), scalars.period_end(period).alias("quarter_end"), scalars.period_end(period, True).alias("year_end"), scalars.snake_case(F.concat(F.lit(" "), "o_orderpriority", F.lit(" %"))).alias("name"),
        scalars.parse_number(F.expr("concat('1,', lpad(o_orderkey % 1000, 3, '0'), '%')")).alias("amount"), scalars.record_id(F.col("o_orderkey").cast("string")).alias("record"), scalars.sign_safe_growth(F.col("o_totalprice"), F.col("o_orderkey")).alias("growth"),
    )


from tickerloom import landed_queries  # noqa: E402, F401  registers its queries
