"""Seed datasets as JSON files, ranking pages, and captured pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import payloads as J
from tidewire.functions.staging import compute_once
from tidewire.functions.times import trade_date
from tidewire.schemas import RANKING, RAW_PAGES, STOCK_UNIVERSE

# Markers around the ranking page's payload.
PAGE_START = "var pagedata="
PAGE_END = "};\n</script>"


def json_records(spark: SparkSession, path: str, wrapper: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """Records of JSON files, in the columns of `schema`, and `error`: null, or why one cannot be used.

    Files hold a bare list of records or an object wrapping one; such a file is one JSON document,
    so the file is the unit of parallelism. With `lines` every line is a record, and Spark splits
    files. Records that cannot be read come as rows with their `error` and no values: no JSON, no
    object, unknown or missing fields, values of another type. They end no job.
    """
    document = F.try_parse_json("value")
    if lines:
        rows = spark.read.text(path).where(F.trim("value") != "").select(document.alias("record"))
    else:
        listed = F.coalesce(
            F.try_variant_get(document, "$", "array<variant>"),
            F.try_variant_get(document, f"$.{wrapper}", "array<variant>"),
            # An object without the list has no records; anything else is one that cannot be used.
            F.when(J.is_object(document), F.array().cast("array<variant>")).otherwise(F.array(F.lit(None).cast("variant"))),
        )
        rows = spark.read.text(path, wholetext=True).select(F.explode(listed).alias("record"))
    record = F.col("record")
    names = F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))
    unknown = F.array_except(names, F.array(*[F.lit(f.name) for f in schema]))
    said = {f.name: F.try_variant_get(record, f"$.{f.name}", "variant") for f in schema}
    given = {n: v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False)) for n, v in said.items()}
    values = {f.name: F.try_variant_get(record, f"$.{f.name}", f.dataType.simpleString()) for f in schema}
    missing = F.array_compact(F.array(*[F.when(~given[f.name], F.lit(f.name)) for f in schema if not f.nullable]))
    unfit = F.array_compact(F.array(*[F.when(given[n] & values[n].isNull(), F.lit(n)) for n in values]))

    def listed_names(what: str, found: Column) -> Column:
        return F.when(F.size(found) > 0, F.concat(F.lit(f"{what}: "), F.array_join(found, ", ")))

    error = F.when(record.isNull(), F.lit("no JSON record")).when(~J.is_object(record), F.lit("no JSON object"))
    error = F.coalesce(
        error, listed_names("unknown fields", unknown), listed_names("missing fields", missing), listed_names("unfit values", unfit)
    )
    checked = compute_once(rows, {"error": error})
    return checked.select(*[F.when(F.col("error").isNull(), values[f.name]).alias(f.name) for f in schema], "error")


def _strict(records: DataFrame) -> DataFrame:
    """The records without `error`; reading one that has an error is one."""
    return records.select(*[
        F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col(c)).alias(c) for c in records.columns if c != "error"
    ])


def stock_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Stock universe files, a list, `{"stocks": [...]}` or one record a line, with bad records as rows with `error`."""
    rows = json_records(spark, path, "stocks", STOCK_UNIVERSE, lines)
    return rows.withColumn("tags", F.when(F.col("error").isNull(), F.coalesce("tags", F.array().cast("array<string>"))))


def ranking_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ranking files, a list, `{"entries": [...]}` or one record a line, with bad records as rows with `error`."""
    return json_records(spark, path, "entries", RANKING, lines)


def read_stock_dataset(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Stock universe files; a bad record is an error."""
    return _strict(stock_records(spark, path, lines))


def read_ranking_dataset(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ranking files; a bad record is an error."""
    return _strict(ranking_records(spark, path, lines))


def read_pages(spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Captured pages and payloads, which stand in for live fetching; optionally of a span of capture
    times, which prunes the scan."""
    pages = spark.read.schema(RAW_PAGES).parquet(path)
    if since is not None:
        pages = pages.where(F.col("fetched_at") >= F.lit(since).cast("timestamp"))
    if until is not None:
        pages = pages.where(F.col("fetched_at") <= F.lit(until).cast("timestamp"))
    return pages


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RAW_PAGES).parquet(path)


def ranking_payload(html: Column) -> Column:
    """JSON text from the first start marker to the first end marker after it; null without either."""
    start = F.locate(PAGE_START, html)
    rest = F.substr(html, start + len(PAGE_START))
    end = F.locate(PAGE_END, rest)
    return F.when((start > 0) & (end > 0), F.left(rest, end))


# The part of the ranking payload that is read.
_RANKING_PAYLOAD = (
    "sbgg_all struct<result:struct<data:array<struct<"
    "SECURITY_CODE:string,MARKET_SUFFIX:string,TRADE_DATE:string,BILLBOARD_NET_AMT:double>>>>, _bad string"
)


def ranking_pages(pages: DataFrame, html: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Ranking entries of captured pages, and `error`: one row says why a page cannot be used.

    The rank counts skipped rows too. A page without the payload, with a malformed one or with a
    malformed date has an error and no entries; it ends no job.
    """
    payload = F.col("_payload")
    # Staged, so that each page is searched and parsed once.
    texts = compute_once(pages.select(*keep, F.col(html).alias("_html")), {"_payload": ranking_payload(F.col("_html"))})
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    parsed = texts.select(*keep, "_payload", F.from_json(payload, _RANKING_PAYLOAD, options).alias("_json"))
    data = F.coalesce(F.col("_json.sbgg_all.result.data"), F.array().cast(parsed.select("_json.sbgg_all.result.data").schema[0].dataType))

    def complete(row: Column) -> Column:
        return F.coalesce((row["SECURITY_CODE"] != "") & (row["MARKET_SUFFIX"] != "") & (row["TRADE_DATE"] != ""), F.lit(False))

    def undated(row: Column) -> Column:
        return complete(row) & F.try_to_timestamp(row["TRADE_DATE"], F.lit("yyyy-MM-dd HH:mm:ss")).isNull()

    error = (
        F.when(payload.isNull(), F.lit("ranking page without payload or terminator"))
        .when(F.col("_json._bad").isNotNull(), F.lit("ranking page with a malformed payload"))
        .when(F.exists(data, undated), F.lit("ranking page with a malformed date"))
    )
    nothing = F.array(F.lit(None).cast(parsed.select(data.alias("d")).schema[0].dataType.elementType))
    judged = compute_once(parsed, {"error": error})
    rows = judged.select(*keep, "error", F.posexplode(F.when(F.col("error").isNull(), data).otherwise(nothing)).alias("_pos", "_row"))
    kept = rows.where(F.col("error").isNotNull() | complete(F.col("_row")))
    code, market, day = (F.col(f"_row.{c}") for c in ("SECURITY_CODE", "MARKET_SUFFIX", "TRADE_DATE"))
    good = F.col("error").isNull()
    return kept.select(
        *keep,
        F.when(good, F.concat(market, code)).alias("stock_id"),
        F.when(good, trade_date(day)).alias("trade_date"),
        F.when(good, market).alias("market"),
        F.when(good, F.when(F.col("_row.BILLBOARD_NET_AMT") >= 0, "net_buy").otherwise("net_sell")).alias("ranking_mode"),
        F.when(good, F.col("_pos") + 1).alias("rank"),
        "error",
    )


def ranking_rows(pages: DataFrame, html: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Ranking entries of captured pages; a page that cannot be used is an error."""
    return _strict(ranking_pages(pages, html, keep))
