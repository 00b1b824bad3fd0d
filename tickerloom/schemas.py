"""Table schemas and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CASH = "CASH"
UNCLASSIFIED = "UNCLASSIFIED"
PRICE_FIELDS = ["open", "high", "low", "close", "volume"]

PANEL = "date DATE, symbol STRING, parameter STRING, value DOUBLE"
SHARES = "symbol STRING, date DATE, total_shares BIGINT, promoter_shares BIGINT, public_shares BIGINT, non_pub_nonp_shares BIGINT, free_float_shares BIGINT, source STRING"
UNIVERSE = "quarter_end_date DATE, rank INT, symbol STRING, isin STRING, market_cap_inr DOUBLE, free_float_market_cap_inr DOUBLE, close_inr DOUBLE, shares_outstanding DOUBLE, free_float_shares DOUBLE"
METADATA = "symbol STRING, isin STRING, company_name STRING, sector STRING, industry STRING, first_in_universe_date DATE, last_in_universe_date DATE, status STRING"
SYMBOL_HISTORY = "symbol STRING, first_seen_date DATE, last_seen_date DATE, status STRING, isin STRING, source STRING"
CORPORATE_ACTIONS = "event_date DATE, event_type STRING, predecessor_symbols STRING, successor_symbols STRING, ratio STRING, source_url STRING"
ADJUSTMENTS = "symbol STRING, ex_date DATE, action_type STRING, ratio_num DOUBLE, ratio_denom DOUBLE, amount DOUBLE, source STRING, raw_subject STRING"
CLASSIFICATION = "symbol STRING, isin STRING, macro_sector STRING, sector STRING, industry STRING, basic_industry STRING, macro_code STRING, sector_code STRING, industry_code STRING, basic_industry_code STRING, source STRING, as_of DATE"
OVERRIDES = "symbol STRING, macro_sector STRING, sector STRING, industry STRING, basic_industry STRING, note STRING"
BENCHMARK = "date DATE, close DOUBLE"
GAPS = "script STRING, symbol STRING, reason STRING, error_msg STRING, recorded_date DATE"


def require_columns(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """df, or an error that names the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def no_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL: Spark orders NaN above all numbers, the panels treat both as missing."""
    return df.withColumns({f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType)) for f in df.schema if isinstance(f.dataType, T.DoubleType | T.FloatType)})
