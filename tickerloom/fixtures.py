"""Panels that Spark derives from the test tables, as SQL that both engines run; {table} stands for a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTES = """
with x as (
  select cast(l_shipdate as date) as date, concat('S', cast(l_suppkey as string)) as symbol, 100 + l_extendedprice/10000 as px, l_quantity as qty,
         row_number() over (partition by l_suppkey, cast(l_shipdate as date) order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) as i,
         count(*) over (partition by l_suppkey, cast(l_shipdate as date)) as n
  from {lineitem})
select date, symbol, max(case when i=1 then px end) as open, max(px) as high, min(px) as low, max(case when i=n then px end) as close, cast(sum(qty) as double) as volume
from x group by date, symbol"""

#: The same for Spark, with the keys named first, so that a choice of days or symbols is made on the rows of lineitem and both steps take one shuffle.
QUOTES_BY_KEY = """
with y as (
  select cast(l_shipdate as date) as date, concat('S', cast(l_suppkey as string)) as symbol, 100 + l_extendedprice/10000 as px, l_quantity as qty, l_orderkey, l_linenumber, l_partkey, l_extendedprice
  from {lineitem}),
x as (
  select date, symbol, px, qty, row_number() over (partition by date, symbol order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, qty) as i, count(*) over (partition by date, symbol) as n from y)
select date, symbol, max(case when i=1 then px end) as open, max(px) as high, min(px) as low, max(case when i=n then px end) as close, cast(sum(qty) as double) as volume
from x group by date, symbol"""

QUARTER_END = "cast(last_day(date_trunc('quarter', l_shipdate) + interval '2' month) as date)"

SHARES = """
with x as (
  select concat('S', cast(l_suppkey as string)) as symbol, cast(last_day(date_trunc('quarter', l_shipdate) + interval '2' month) as date) as date,
         l_returnflag as f, l_suppkey as k, extract(quarter from l_shipdate) as q
  from {lineitem})
select symbol, date, 1000*count(*) as total_shares, 1000*count(case when f='A' then 1 end) as promoter_shares, 1000*count(case when f='N' then 1 end) as public_shares,
       1000*count(case when f='R' then 1 end) as non_pub_nonp_shares, 1000*count(case when f<>'A' then 1 end) as free_float_shares
from x where (k+q)%4<>0 group by symbol, date"""

FIN_SUMS = """select concat('S', cast(l_suppkey as string)) as symbol, cast(last_day(date_trunc('quarter', l_shipdate) + interval '2' month) as date) as date,
         sum(l_extendedprice) as s, sum(l_extendedprice*(1-l_discount)) as e, sum(l_extendedprice*l_tax/4) as d
  from {lineitem} group by 1,2"""
FIN_ITEMS = {"sales": "s", "expenses": "e", "operating_profit": "s-e", "depreciation": "d", "profit_before_tax": "s-e-d", "net_profit": "(s-e-d)*0.75 - s*0.02"}
FIN_RAW = f"""
with x as (
  {FIN_SUMS})
""" + "\nunion all ".join(f"select symbol, date, '{k}'{' as line_item' if k == 'sales' else ''}, {v}{' as value' if k == 'sales' else ''} from x" for k, v in FIN_ITEMS.items())

SECTORS = """
select concat('S', cast(s_suppkey as string)) as symbol, r_name as macro_sector, n_name as sector, concat(n_name,'/',cast(s_suppkey%3 as string)) as industry,
       concat(n_name,'/',cast(s_suppkey%6 as string)) as basic_industry
from {supplier} join {nation} on s_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey"""

TRI = """select cast(o_orderdate as date) as date, 1000 + sum(o_totalprice)/count(*)/1000 as close from {orders} group by 1"""

#: Every order is an action. Their effects are small, as a symbol has a hundred and more; symbols that end in 7 have no splits.
ACTIONS = """
select symbol, ex_date, case when p='1-URGENT' and symbol not like '%7' then 'split' when p='2-HIGH' then 'bonus' else 'dividend' end as action_type,
       case when p='1-URGENT' and symbol not like '%7' then 98.0e0 + k % 5 when p='2-HIGH' then 1.0e0 end as ratio_num,
       case when p='1-URGENT' and symbol not like '%7' then 97.0e0 when p='2-HIGH' then 51.0e0 + 6 * (k % 10) end as ratio_denom,
       case when p='2-HIGH' or (p='1-URGENT' and symbol not like '%7') then null else cast(0.01e0 * (1 + k % 50) as double) end as amount
from (select o_orderkey as k, o_orderpriority as p, cast(o_orderdate as date) as ex_date, concat('S', cast(o_custkey % (select count(*) from {supplier}) as string)) as symbol from {orders})"""

PART_QUOTES = """select cast(l_shipdate as date) as date, concat('P', cast(l_partkey as string)) as symbol, max(l_extendedprice) as close, cast(sum(l_quantity) as double) as volume from {lineitem} group by 1, 2"""

PANELS = {"fx_quotes": QUOTES, "fx_shares": SHARES, "fx_fin_raw": FIN_RAW, "fx_sector": SECTORS, "fx_tri": TRI, "fx_actions": ACTIONS, "fx_part_quotes": PART_QUOTES}
TABLES = ("lineitem", "orders", "supplier", "nation", "region", "part", "customer", "events")


def panel(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "fx_fin_raw":  # one pass over the sums, where Spark takes one for each item of the SQL
        sums = _read(spark, sf_dir, FIN_SUMS)
        items = F.array(*(F.struct(F.lit(k).alias("line_item"), F.expr(v).cast("double").alias("value")) for k, v in FIN_ITEMS.items()))
        return sums.select("symbol", "date", F.inline(items))
    return _read(spark, sf_dir, QUOTES_BY_KEY if name == "fx_quotes" else PANELS[name])


def _read(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    sql = sql.replace(QUARTER_END, "last_day(add_months(trunc(cast(l_shipdate as date), 'QUARTER'), 2))")  # the same days, without times and intervals
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def duckdb(name: str) -> str:
    """The same panel's SQL over tables of the plain names."""
    sql = PANELS[name]
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql
