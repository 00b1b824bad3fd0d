"""Readers and writers of landed files. Downloads are out of scope: files are on storage that Spark reads."""

from __future__ import annotations

import calendar
import dataclasses
import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tickerloom import schemas
from tickerloom.functions.scalars import clean_label, parse_date, record_id
from tickerloom.operators.panel import keep_newest
from tickerloom.schemas import no_nan, require_columns

#: Headers of the two layouts of daily quote files and their columns.
DAILY_LAYOUTS = {
    "classic": {"SYMBOL": "symbol", "SERIES": "series", "OPEN": "open", "HIGH": "high", "LOW": "low", "CLOSE": "close", "PREVCLOSE": "prev_close", "TOTTRDQTY": "volume", "TOTTRDVAL": "turnover_lacs"},
    "full": {"SYMBOL": "symbol", "SERIES": "series", "OPEN_PRICE": "open", "HIGH_PRICE": "high", "LOW_PRICE": "low", "CLOSE_PRICE": "close", "PREV_CLOSE": "prev_close", "TTL_TRD_QNTY": "volume", "TURNOVER_LACS": "turnover_lacs"},
}
DAILY_COLUMNS = ["symbol", "series", "date", "open", "high", "low", "close", "prev_close", "volume", "turnover_lacs"]
LEVELS = ("macro_sector", "sector", "industry", "basic_industry")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return no_nan(spark.read.schema(schema).option("header", True).csv(path))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The CSV, or an empty table of its schema if there is none."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_long_panel(spark: SparkSession, path: str) -> DataFrame:
    """A long panel from Parquet partitioned by parameter."""
    return spark.read.schema(schemas.PANEL).parquet(path).select("date", "symbol", "parameter", "value")


def write_long_panel(panel: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by parameter; a filter on it reads only its folder."""
    own = no_nan(panel.select("date", "symbol", "parameter", F.col("value").cast("double").alias("value")))
    own.repartition("parameter", F.year("date")).sortWithinPartitions("parameter", "date", "symbol").write.mode(mode).partitionBy("parameter").parquet(path)


def daily_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, date) of all daily snapshots: two columns of the files."""
    return spark.read.parquet(path).select("symbol", "date")


def normalise_daily(raw: DataFrame, layout: str) -> DataFrame:
    """Daily quotes of one layout: trimmed headers, main-board series only, missing columns null; date from raw's own column or its file's name (yyyyMMdd)."""
    trimmed = raw.toDF(*(c.strip() for c in raw.columns))
    names = {k: v for k, v in DAILY_LAYOUTS[layout].items() if k in trimmed.columns}
    own = trimmed.withColumnsRenamed(names)
    if "date" not in own.columns:
        own = own.withColumn("date", F.try_to_date(F.regexp_extract("_file", r"(\d{8})", 1), "yyyyMMdd")) if "_file" in own.columns else own.withColumn("date", F.lit(None).cast("date"))
    kind = lambda c: "string" if c in ("symbol", "series") else "date" if c == "date" else "double"
    cast = lambda c: F.trim(c) if kind(c) == "string" else F.col(c) if kind(c) == "date" else F.trim(F.col(c).cast("string")).try_cast("double")
    own = own.select(*((cast(c) if c in own.columns else F.lit(None).cast(kind(c))).alias(c) for c in DAILY_COLUMNS))
    return own.where("series = 'EQ'")


def read_daily(spark: SparkSession, path: str, layout: str) -> DataFrame:
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    # the day is in the file's name, or in the name of the folder it lies in
    return normalise_daily(raw.withColumn("_file", F.substring_index("_metadata.file_path", "/", -2)), layout)


def read_listed(spark: SparkSession, path: str) -> DataFrame:
    """The listed equities: snake_case headers, main-board series, one row a symbol."""
    raw = spark.read.option("header", True).csv(path)
    own = raw.toDF(*("_".join(c.strip().lower().split()) for c in raw.columns))
    require_columns(own, ["symbol", "name_of_company", "series", "date_of_listing", "isin_number"], "listed equities")
    rows = own.where(F.trim("series") == "EQ").select(F.trim("symbol").alias("symbol"), F.trim("isin_number").alias("isin"), F.trim("name_of_company").alias("company_name"), parse_date(F.col("date_of_listing")).alias("listing_date"))
    return keep_newest(rows, ["symbol"], [F.asc_nulls_last("listing_date"), F.asc("isin"), F.asc("company_name")])


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the typed tables (SHARES, UNIVERSE, METADATA, ...) from Parquet."""
    return no_nan(spark.read.schema(getattr(schemas, table)).parquet(path))


def taxonomy(classification: DataFrame | None, level: str = "sector") -> DataFrame | None:
    """(symbol, sector) at a level of the taxonomy; a table with no such level but a sector gives that, as older ones of two columns do; None stays None."""
    if level not in LEVELS:
        raise ValueError(f"no level {level}; there are {', '.join(LEVELS)}")
    if classification is None:
        return None
    require_columns(classification, ["symbol"], "classification")
    own = level if level in classification.columns else "sector"
    require_columns(classification, [own], "classification")
    return classification.select("symbol", F.col(own).alias("sector"))


def read_taxonomy(spark: SparkSession, path: str | None, level: str = "sector", default: str | None = None) -> DataFrame | None:
    """taxonomy of a CSV with headers. A path that isn't there is an error; without a path the default one counts, which may be missing (None)."""
    taxonomy(None, level)
    if path is None and default is None:
        return None
    try:
        return taxonomy(spark.read.option("header", True).csv(path or default), level)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        if path is not None:
            raise FileNotFoundError(f"no classification at {path}") from e
        return None


#: Benchmarks by key: the index' name and its file, below the folder of benchmarks.
BENCHMARKS: dict[str, tuple[str, str]] = {}


def register_benchmark(key: str, name: str, file: str) -> None:
    """Make a benchmark known by its key; a second one of a key is an error unless it is the same."""
    if BENCHMARKS.get(key, (name, file)) != (name, file):
        raise ValueError(f"benchmark {key} is {BENCHMARKS[key][0]} already")
    BENCHMARKS[key] = name, file


def benchmark_level(spark: SparkSession, registry: dict[str, str], key: str, path: str | None = None) -> DataFrame:
    """(date, close) of a registered benchmark, or of an explicit file, sorted by date."""
    if path is None and key not in registry:
        raise ValueError(f"no benchmark {key}; there are {', '.join(sorted(registry))}")
    return read_csv(spark, path or registry[key], schemas.BENCHMARK).orderBy("date")


def registered_level(spark: SparkSession, folder: str, key: str, path: str | None = None) -> DataFrame:
    """(date, close, benchmark) of a benchmark of the registry, or of an explicit file under its name, sorted by date."""
    files = {k: f"{folder}/{file}" for k, (_, file) in BENCHMARKS.items()}
    return benchmark_level(spark, files, key, path).withColumn("benchmark", F.lit(BENCHMARKS[key][0] if key in BENCHMARKS else key))


def consolidate_levels(chunks: Iterable[DataFrame]) -> DataFrame:
    """Chunks of one index' history as one series; of days in several chunks the later chunk counts."""
    rows = None
    for i, c in enumerate(chunks):
        own = c.select("date", "close", F.lit(i).alias("_i"))
        rows = own if rows is None else rows.unionByName(own)
    return keep_newest(rows, ["date"], [F.desc("_i"), F.desc("close")]).drop("_i")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    own = read_optional(spark, path, schemas.OVERRIDES)
    return own.select(F.upper(F.trim("symbol")).alias("symbol"), *(clean_label(F.col(c)).alias(c) for c in LEVELS), "note")


def published_sectors(raw: DataFrame) -> DataFrame:
    """(symbol, sector) of a published constituent list with the headers Symbol and Industry."""
    require_columns(raw, ["Symbol", "Industry"], "constituents")
    return raw.select(F.upper(F.trim("Symbol")).alias("symbol"), clean_label(F.col("Industry")).alias("sector"))


def json_entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, entry VARIANT): the entries of JSON files in their order; each file is a list of entries, or an object with a list under data. Files of other shapes have none."""
    texts = read_documents(spark, path)
    doc = F.try_parse_json("content")
    listed = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.try_variant_get(doc, "$.data", "array<variant>"))
    return texts.select("file", F.posexplode(listed).alias("place", "entry"))


def entry_fields(entries: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(file, place, ...): fields of the entries as text by name; null where an entry lacks one."""
    return entries.select("file", "place", *(F.try_variant_get("entry", f"$.{field}", "string").alias(name) for name, field in fields.items()))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, ex_date, subject) of one JSON file of events a symbol."""
    own = entry_fields(json_entries(spark, path), {"ex_date": "exDate", "subject": "subject"})
    return own.select(F.regexp_extract("file", r"^(.*)\.json$", 1).alias("symbol"), "ex_date", "subject")


def security_master(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, isin, ticker, sector, industry) of a security master in JSON, with the order of its rows."""
    return entry_fields(json_entries(spark, path), {c: c for c in ("isin", "ticker", "sector", "industry")})


def read_documents(spark: SparkSession, path: str, least_chars: int = 0) -> DataFrame:
    """(file, content) of whole text files, such as filings and pages; shorter ones are left out. In a folder partitioned by file that names them."""
    raw = spark.read.text(path, wholetext=True)
    name = F.col("file").cast("string") if "file" in raw.columns else F.col("_metadata.file_name")
    return raw.select(name.alias("file"), F.col("value").alias("content")).where(F.length("content") >= least_chars)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, html) of company pages named SYMBOL.html."""
    own = read_documents(spark, path).select(F.regexp_extract("file", r"^(.+)\.html?$", 1).alias("symbol"), F.col("content").alias("html"))
    return own.where("symbol <> ''")


def store_pages(pages: DataFrame, path: str) -> None:
    """Company pages (symbol, html) as a table, many in a file: with a file a page the listing of files takes longer than their work."""
    pages.select("symbol", "html").write.parquet(path)


def read_stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, html) as store_pages has written them."""
    return spark.read.schema("symbol string, html string").parquet(path)


def read_filings(spark: SparkSession, path: str, least_chars: int = 5000) -> DataFrame:
    """(symbol, date, record_id, content) of filings named SYMBOL_yyyy-MM-dd_ID.xml."""
    name = r"^(.+)_(\d{4}-\d{2}-\d{2})_([^_]*)\.xml$"
    part = lambda i: F.regexp_extract("file", name, i)
    return read_documents(spark, path, least_chars).select(part(1).alias("symbol"), F.try_to_date(part(2), "yyyy-MM-dd").alias("date"), part(3).alias("record_id"), "content").where("symbol <> ''")


def filings_index(raw: DataFrame) -> DataFrame:
    """(symbol, date, url, record_id) of index entries (symbol, date, xbrl, recordId); placeholders and unreadable dates are left out."""
    tail = F.substring_index(F.coalesce("xbrl", F.lit("")), "/", -1)
    own = raw.withColumn("_d", parse_date(F.col("date"))).where(~tail.isin("", "-", "null") & F.col("_d").isNotNull())
    return own.select("symbol", F.col("_d").alias("date"), F.col("xbrl").alias("url"), record_id(F.col("recordId").cast("string")).alias("record_id"))


def read_filings_index(spark: SparkSession, path: str) -> DataFrame:
    """An index in JSON: lists of entries, or objects with a list under data."""
    return filings_index(entry_fields(json_entries(spark, path), {c: c for c in ("symbol", "date", "xbrl", "recordId")}))


def append_gaps(gaps: DataFrame, path: str, recorded) -> None:
    """Append failures (script, symbol, reason, error_msg) to the gap log."""
    gaps.withColumn("recorded_date", F.lit(recorded).cast("date")).select("script", "symbol", "reason", "error_msg", "recorded_date").write.mode("append").parquet(path)


def write_result(result, path: str) -> None:
    """Every table of a run bundle as Parquet by run_id, and the summary as one JSON row a run."""
    for f in dataclasses.fields(result):
        getattr(result, f.name).write.mode("overwrite").partitionBy("run_id").parquet(f"{path}/{f.name}")
    result.summary().select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{path}/summary")


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, file_modification_time) of the files below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("file_modification_time"))


def symbols_from_list(df: DataFrame, text: str | None) -> DataFrame:
    """Rows of the symbols in a comma-separated list; all rows without one."""
    wanted = [s.strip().upper() for s in (text or "").split(",") if s.strip()]
    return df.where(F.col("symbol").isin(wanted)) if wanted else df


def history_floors(project_floor, lookback_days: int = 365, financial_quarters: int = 8, **overrides) -> dict:
    """The first dates kept: of the project, of prices (days before it) and of financials (quarters before it), as literal columns.

    overrides give later floors by name; one that is earlier than its floor is an error, as nothing before it is kept.
    """
    floor = datetime.date.fromisoformat(str(project_floor))
    month = floor.year * 12 + floor.month - 1 - 3 * financial_quarters
    last = calendar.monthrange(month // 12, month % 12 + 1)[1]
    own = {"project": floor, "prices": floor - datetime.timedelta(days=lookback_days), "financials": datetime.date(month // 12, month % 12 + 1, min(floor.day, last))}
    for name, value in overrides.items():
        if name not in own:
            raise ValueError(f"no floor {name}; there are {', '.join(own)}")
        if value is not None:
            wanted = datetime.date.fromisoformat(str(value))
            if wanted < own[name]:
                raise ValueError(f"the floor of {name} is {own[name]}; {wanted} is earlier")
            own[name] = wanted
    return {k: F.lit(v).cast(T.DateType()) for k, v in own.items()}
