"""Seed generators, compilation and catalog checks over the test tables."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import seeds as S
from tidewire.operators.upsert import touch_seed_items
from tidewire.plans.refresh import refresh_seeds
from tidewire.session import run_dir
from tidewire.sources.datasets import ranking_pages, ranking_records, stock_records
from tidewire.sources.registry import GENERATORS
from tidewire.sources.tables import LogTable
from tidewire.workload import views as V
from tidewire.workload.registry import Tables, query


@query(
    "stock_universe",
    f"""WITH u AS ({V.UNIVERSE_SQL}) SELECT 'stock_id' AS kind, stock_id AS value FROM u
WHERE market IN ('ECONOMY', 'STANDARD', 'PROMO') AND board IN ('Brand#1', 'Brand#2', 'Brand#12', 'Brand#17')
  AND (starts_with(stock_id, 'Brand1') OR starts_with(stock_id, 'Brand2-'))
  AND NOT list_has_any(tags, ['red', 'small']) ORDER BY stock_id LIMIT 50""",
)
def stock_universe(t: Tables) -> DataFrame:
    return S.stock_universe_items(
        V.universe(t),
        markets=("ECONOMY", "STANDARD", "PROMO"),
        boards=("Brand#1", "Brand#2", "Brand#12", "Brand#17"),
        prefixes=("Brand1", "Brand2-"),
        exclude_tags=("red", "small"),
        limit=50,
    )


@query(
    "stock_universe_tagged",
    f"""WITH u AS ({V.UNIVERSE_SQL}) SELECT 'stock_id' AS kind, stock_id AS value FROM u
WHERE list_has_any(tags, ['red', 'ring'])""",
)
def stock_universe_tagged(t: Tables) -> DataFrame:
    return S.stock_universe_items(V.universe(t), include_tags=("red", "ring"))


@query(
    "ranking_top_n",
    f"""WITH r AS ({V.RANKING_SQL}), kept AS (
SELECT stock_id, trade_date, coalesce(rank, 999999) AS r FROM r
WHERE trade_date >= DATE '1996-01-01' AND trade_date >= DATE '2001-07-31' - 29 AND market IN ('A', 'R') AND ranking_mode = 'O'),
best AS (SELECT stock_id, min((-(trade_date - DATE '1970-01-01'), r)) AS k FROM kept GROUP BY stock_id)
SELECT 'stock_id' AS kind, stock_id AS value FROM best ORDER BY k, stock_id LIMIT 50""",
)
def ranking_top_n(t: Tables) -> DataFrame:
    return S.ranking_items(
        V.ranking(t),
        as_of=datetime(2001, 7, 31, 12),
        since_date=date(1996, 1, 1),
        days_window=30,
        markets=("A", "R"),
        ranking_modes=("O",),
        top_n=50,
    )


# Pages that cannot be used, by order key.
_BAD_PAGE = "CASE l_orderkey % 50 WHEN 7 THEN 'without payload or terminator' WHEN 11 THEN 'with a malformed payload' WHEN 13 THEN 'with a malformed date' END"


@query(
    "ranking_page_parse",
    f"""WITH i AS (SELECT *, l_orderkey || '/' || l_linenumber || '/' || l_partkey AS page, {_BAD_PAGE} AS bad FROM lineitem)
SELECT page, 'SH' || l_partkey AS stock_id, CAST(l_shipdate AS DATE) AS trade_date,
  'SH' AS market, CASE WHEN l_tax > 0.04 THEN 'net_sell' ELSE 'net_buy' END AS ranking_mode, 1 AS rank, NULL AS error FROM i WHERE bad IS NULL
UNION ALL SELECT page, 'SZ' || l_suppkey, CAST(l_shipdate AS DATE), 'SZ', 'net_sell', 3, NULL FROM i WHERE bad IS NULL
UNION ALL SELECT page, NULL, NULL, NULL, NULL, NULL, 'ranking page ' || bad FROM i WHERE bad IS NOT NULL""",
)
def ranking_page_parse(t: Tables) -> DataFrame:
    """One ranking page per line item: a row, a row without code (skipped), a row without amount.
    Some pages lack their end, break off inside the payload, or hold a date that is none."""
    items = t.lineitem.withColumns({"_day": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), "_bad": F.col("l_orderkey") % 50})
    bad = F.col("_bad")
    day = F.when(bad == 13, "14.04.2026").otherwise(F.col("_day"))

    def row(code, suffix: str, amount):
        return F.struct(
            code.cast("string").alias("SECURITY_CODE"),
            F.lit(suffix).alias("MARKET_SUFFIX"),
            day.alias("TRADE_DATE"),
            amount.cast("double").alias("BILLBOARD_NET_AMT"),
        )

    amount = F.when(F.col("l_tax") > 0.04, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    data = F.array(
        row(F.col("l_partkey"), "SH", amount),
        row(F.lit(""), "SH", amount),
        row(F.col("l_suppkey"), "SZ", F.lit(None)),
    )
    payload = F.to_json(F.struct(F.struct(F.struct(data.alias("data")).alias("result")).alias("sbgg_all")))
    whole = F.when(bad == 11, F.concat(F.left(payload, F.length(payload) - 9), F.lit("}"))).otherwise(payload)
    pages = items.select(
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("page"),
        F.concat(F.lit("<script>var pagedata="), whole, F.when(bad == 7, "</script>").otherwise(";\n</script>")).alias("text"),
    )
    return ranking_pages(pages, keep=("page",))


_STOCK_ERROR = "CASE p_partkey % 20 WHEN 3 THEN 'no JSON record' WHEN 4 THEN 'unknown fields: colour' WHEN 5 THEN 'missing fields: stock_id' WHEN 6 THEN 'unfit values: tags' END"


def _stock_lines(t: Tables) -> DataFrame:
    """A JSON record per part; some break off, have an unknown field, no id, or tags that are no list."""
    shape = F.col("p_partkey") % 20
    stock = F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("-"), F.col("p_partkey").cast("string"))
    record = F.to_json(F.struct(
        F.when(shape != 5, stock).alias("stock_id"), F.col("p_type").alias("market"), F.col("p_brand").alias("board"),
        F.when(shape != 6, F.split("p_name", " ")).alias("tags"), F.when(shape == 4, "red").alias("colour"),
    ))
    line = F.when(shape == 3, F.left(record, F.lit(20))).when(shape == 6, F.replace(record, F.lit("}"), F.lit(',"tags":"one"}'))).otherwise(record)
    return t.part.select("p_brand", "p_partkey", line.alias("value"))


_STOCKS_SQL = f"""WITH u AS (SELECT *, {_STOCK_ERROR} AS error FROM (SELECT p_partkey, replace(p_brand, '#', '') || '-' || p_partkey AS stock_id, p_type AS market,
  p_brand AS board, replace(p_name, ' ', ',') AS tags FROM part)), r AS (
SELECT p_partkey, CASE WHEN error IS NULL THEN stock_id END AS stock_id, CASE WHEN error IS NULL THEN market END AS market,
  CASE WHEN error IS NULL THEN board END AS board, CASE WHEN error IS NULL THEN tags END AS tags, error FROM u)
SELECT 'lines' AS form, stock_id, market, board, tags, error FROM r
UNION ALL SELECT 'files', stock_id, market, board, tags, error FROM r WHERE p_partkey % 20 <> 3"""


@query("stock_dataset", _STOCKS_SQL)
def stock_dataset(t: Tables) -> DataFrame:
    """Stock records as JSON lines, and as files of one list each, bare or wrapped, by brand."""
    home = run_dir(t.spark, "stocks")
    lines = _stock_lines(t)
    lines.select("value").write.text(f"{home}/lines")
    listed = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]"))
    files = lines.where("p_partkey % 20 <> 3").groupBy("p_brand").agg(listed.alias("value"))
    wrapped = F.when(F.col("p_brand").endswith("1"), F.concat(F.lit('{"stocks": '), F.col("value"), F.lit("}"))).otherwise(F.col("value"))
    files.select("p_brand", wrapped.alias("value")).write.partitionBy("p_brand").text(f"{home}/files")
    tags = F.array_join("tags", ",").alias("tags")

    def form(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("form"), "stock_id", "market", "board", tags, "error")

    return form("lines", stock_records(t.spark, f"{home}/lines", lines=True)).unionByName(form("files", stock_records(t.spark, f"{home}/files")))


@query(
    "ranking_dataset",
    f"""WITH r AS ({V.RANKING_SQL.replace('FROM lineitem', ', l_linenumber FROM lineitem')})
SELECT CASE WHEN ok THEN stock_id END AS stock_id, CASE WHEN ok THEN trade_date END AS trade_date, CASE WHEN ok THEN market END AS market,
  CASE WHEN ok THEN ranking_mode END AS ranking_mode, CASE WHEN ok THEN rank END AS rank, CASE WHEN NOT ok THEN 'unfit values: trade_date' END AS error
FROM (SELECT *, l_linenumber <> 6 AS ok FROM r)""",
)
def ranking_dataset(t: Tables) -> DataFrame:
    """Ranking records as JSON lines; sixth line items hold a date that is none."""
    home = run_dir(t.spark, "rankings")
    day = F.when(F.col("l_linenumber") == 6, "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    record = F.struct(
        F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("stock_id"), day.alias("trade_date"), F.col("l_returnflag").alias("market"),
        F.col("l_linestatus").alias("ranking_mode"), F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("rank"),
    )
    t.lineitem.select(F.to_json(record).alias("value")).write.text(home)
    return ranking_records(t.spark, home, lines=True)


_REFRESHED_AT = datetime(2024, 1, 31, tzinfo=timezone.utc)
_GENERATED_SQL = f"""WITH u AS ({V.UNIVERSE_SQL}), g AS (
SELECT 'economy' AS g, 'stock_id' AS kind, stock_id AS value FROM u WHERE market IN ('ECONOMY', 'PROMO')
UNION ALL SELECT 'red', 'stock_id', stock_id FROM u WHERE list_has_any(tags, ['red', 'ring'])
UNION ALL SELECT DISTINCT 'brands', 'topic_id', board FROM u),
n AS (SELECT g, count(*) AS n FROM g GROUP BY g),
s AS (SELECT DISTINCT s.name AS set_name, kind, value FROM (VALUES ('a', 'economy'), ('a', 'red'), ('b', 'red'), ('b', 'brands'), ('c', 'brands')) s(name, g) JOIN g USING (g))"""


def _refreshed(t: Tables, resumed: bool) -> DataFrame:
    """Three sets, the first naming a generator twice, the second with one that fails; then, if
    resumed, the rest of the refresh with that one mended. Snapshots, items and the run log."""
    root = run_dir(t.spark, "seed-refresh")
    V.universe(t).write.json(f"{root}/stocks")
    stocks = {"type": "stock_universe", "dataset_path": f"{root}/stocks", "lines": True}

    def brands(spark, definition, as_of) -> DataFrame:
        if not definition.get("works"):
            raise ValueError("no brands today")
        return t.part.select(F.lit("topic_id").alias("kind"), F.col("p_brand").alias("value")).distinct()

    def catalog(works: bool) -> dict:
        return {
            "logical_sets": [{"name": "a", "generators": ["economy", "economy", "red"]}, {"name": "b", "generators": ["red", "brands"]}, {"name": "c", "generators": ["brands"]}],
            "generators": [
                {"name": "economy", **stocks, "markets": ("ECONOMY", "PROMO")}, {"name": "red", **stocks, "include_tags": ("red", "ring")},
                {"name": "brands", "type": "brands", "works": works},
            ],
        }

    generators = {**GENERATORS, "brands": brands}
    try:
        refresh_seeds(t.spark, root, catalog(False), now=_REFRESHED_AT, batch_id=1, generators=generators)
    except ValueError as exc:
        if str(exc) != "no brands today":
            raise
    if resumed:
        refresh_seeds(t.spark, root, catalog(True), now=_REFRESHED_AT, batch_id=2, generators=generators, resume=True)

    def stored(name: str) -> DataFrame:
        return LogTable.named(t.spark, root, name).read()

    none = F.lit(None).cast("string")
    snapshots = S.definition_items(S.read_documents(stored("compiled_seed_sets")))
    runs, items = stored("generated_seed_runs"), stored("generated_seed_items")
    parts = [
        snapshots.select(F.lit("snapshot").alias("what"), F.col("seed_set_name").alias("set_name"), "kind", "value", F.lit(1).cast("bigint").alias("n")),
        runs.select(F.lit("run").alias("what"), F.col("logical_set_name").alias("set_name"), F.col("status").alias("kind"),
                    F.concat_ws(": ", "generator_name", "error_message").alias("value"), F.col("item_count").alias("n")),
        items.groupBy(F.col("logical_set_name").alias("set_name"), F.col("generator_name").alias("value")).agg(F.count("*").alias("n")).select(
            F.lit("items").alias("what"), "set_name", none.alias("kind"), "value", "n"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "seed_refresh_partial",
    f"""{_GENERATED_SQL}
SELECT 'snapshot' AS what, set_name, kind, value, 1 AS n FROM s WHERE set_name = 'a'
UNION ALL SELECT 'run', r.name, r.status, r.g || coalesce(': ' || r.error, ''), CASE WHEN r.error IS NULL THEN coalesce(n, 0) ELSE 0 END
  FROM (VALUES ('a', 'economy', 'succeeded', NULL), ('a', 'economy', 'succeeded', NULL), ('a', 'red', 'succeeded', NULL), ('b', 'red', 'succeeded', NULL),
    ('b', 'brands', 'failed', 'no brands today')) r(name, g, status, error) LEFT JOIN n USING (g)
UNION ALL SELECT 'items', i.name, NULL, g, n FROM (VALUES ('a', 'economy'), ('a', 'red'), ('b', 'red')) i(name, g) JOIN n USING (g)""",
)
def seed_refresh_partial(t: Tables) -> DataFrame:
    """A refresh that fails in its second set: the first has its snapshot, the third was not begun."""
    return _refreshed(t, resumed=False)


@query(
    "seed_run_log",
    f"""{_GENERATED_SQL}
SELECT 'snapshot' AS what, set_name, kind, value, 1 AS n FROM s
UNION ALL SELECT 'run', r.name, r.status, r.g || coalesce(': ' || r.error, ''), CASE WHEN r.error IS NULL THEN coalesce(n, 0) ELSE 0 END
  FROM (VALUES ('a', 'economy', 'succeeded', NULL), ('a', 'economy', 'succeeded', NULL), ('a', 'red', 'succeeded', NULL), ('b', 'red', 'succeeded', NULL),
    ('b', 'brands', 'failed', 'no brands today'), ('b', 'red', 'succeeded', NULL), ('b', 'brands', 'succeeded', NULL), ('c', 'brands', 'succeeded', NULL)) r(name, g, status, error)
  LEFT JOIN n USING (g)
UNION ALL SELECT 'items', i.name, NULL, g, n FROM (VALUES ('a', 'economy'), ('a', 'red'), ('b', 'red'), ('b', 'brands'), ('c', 'brands')) i(name, g) JOIN n USING (g)""",
)
def seed_run_log(t: Tables) -> DataFrame:
    """The same refresh resumed: the first set is not run again, the others are whole."""
    return _refreshed(t, resumed=True)


_COMPILED_SQL = """SELECT DISTINCT logical_set_name AS seed_set_name, item_kind AS kind,
  CASE WHEN item_kind = 'discover_homepage' THEN 'true' ELSE item_value END AS value
FROM {items} WHERE item_kind <> 'discover_homepage' OR lower(item_value) = 'true'"""


@query("seed_compile", f"WITH i AS ({V.SEED_ITEMS_SQL}) {_COMPILED_SQL.format(items='i')}")
def seed_compile(t: Tables) -> DataFrame:
    return S.compile_items(V.seed_items(t))


def _documents(t: Tables, chunk_items: int = S.CHUNK_ITEMS) -> DataFrame:
    items = V.seed_items(t)
    names = items.select(F.col("logical_set_name").alias("name")).distinct()
    return S.seed_documents(names, S.compile_items(items), V.as_of(), chunk_items)


@query(
    "seed_documents",
    f"WITH i AS ({V.SEED_ITEMS_SQL}), c AS ({_COMPILED_SQL.format(items='i')}) "
    "SELECT seed_set_name, kind, value FROM c WHERE kind <> 'discover_homepage'",
)
def seed_documents(t: Tables) -> DataFrame:
    """Items to JSON documents of about 20 values each, and back to items."""
    return S.definition_items(S.read_documents(_documents(t, chunk_items=20)))


@query(
    "seed_inventory",
    f"""WITH i AS ({V.SEED_ITEMS_SQL}), c AS ({_COMPILED_SQL.format(items='i')})
SELECT seed_set_name AS name, {V.AS_OF_SQL} AS refreshed_at, count(*) FILTER (kind = 'stock_id') AS stock_count,
  count(*) FILTER (kind = 'topic_id') AS topic_count, count(*) FILTER (kind = 'user_id') AS user_count,
  count(*) FILTER (kind = 'bilibili_video_target') AS bilibili_video_count,
  count(*) FILTER (kind = 'bilibili_space_url') AS bilibili_space_count,
  count(*) FILTER (kind = 'post_url') AS post_url_count FROM c GROUP BY seed_set_name""",
)
def seed_inventory(t: Tables) -> DataFrame:
    return S.seed_inventory(S.read_documents(_documents(t)))


@query(
    "seed_active_ttl",
    f"""WITH i AS ({V.SEED_ITEMS_SQL}) SELECT logical_set_name, generator_name, item_kind, item_value FROM i
WHERE last_seen_at >= {V.AS_OF_SQL} - INTERVAL 1440 MINUTE""",
)
def seed_active_ttl(t: Tables) -> DataFrame:
    kept = S.active_items(V.seed_items(t), as_of=V.as_of(), ttl_minutes=1440)
    return kept.drop("first_seen_at", "last_seen_at")


def _snapshots(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return t.events.groupBy(F.col("user_id").cast("string").alias("seed_set_name")).agg(F.max(ts).alias("refreshed_at"))


@query(
    "seed_needs_refresh",
    f"""WITH s AS (SELECT user_id AS name, max(ts) AS at FROM events GROUP BY user_id)
SELECT coalesce(bool_or(s.at IS NULL OR s.at <= {V.AS_OF_SQL} - INTERVAL 60 MINUTE), FALSE) AS needs_refresh
FROM (SELECT DISTINCT o_custkey FROM orders) o LEFT JOIN s ON s.name = o.o_custkey""",
)
def seed_needs_refresh(t: Tables) -> DataFrame:
    targets = t.orders.select(F.col("o_custkey").cast("string").alias("name"))
    return S.needs_refresh(targets, _snapshots(t), as_of=V.as_of(), refresh_minutes=60)


@query(
    "seed_item_upsert",
    f"""WITH i AS ({V.SEED_ITEMS_SQL}), b AS (SELECT DISTINCT event_type AS logical_set_name, 'gen1' AS generator_name,
  'user_id' AS item_kind, 'v' || user_id AS item_value FROM events)
SELECT logical_set_name, generator_name, item_kind, item_value, coalesce(i.first_seen_at, {V.AS_OF_SQL}) AS first_seen_at,
  CASE WHEN b.item_kind IS NULL THEN i.last_seen_at ELSE {V.AS_OF_SQL} END AS last_seen_at
FROM i FULL JOIN b USING (logical_set_name, generator_name, item_kind, item_value)""",
)
def seed_item_upsert(t: Tables) -> DataFrame:
    batch = t.events.select(
        F.col("event_type").alias("logical_set_name"),
        F.lit("gen1").alias("generator_name"),
        F.lit("user_id").alias("item_kind"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("item_value"),
    )
    return touch_seed_items(V.seed_items(t), batch, V.as_of())


@query(
    "seed_manual_union",
    """SELECT name, kind, value FROM (
SELECT 'part' || p_partkey AS name, 'discover_homepage' AS kind, 'true' AS value FROM part WHERE p_size > 25
UNION ALL SELECT 'part' || p_partkey, 'post_url', 'https://xueqiu.com/' || p_size || '/' || p_partkey FROM part
UNION ALL SELECT 'part' || p_partkey, 'stock_id', unnest(string_split(p_name, ' ')) FROM part
UNION ALL SELECT 'part' || p_partkey, 'user_id', p_brand FROM part)""",
)
def seed_manual_union(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    none = F.array().cast("array<string>")
    definitions = t.part.select(
        F.concat(F.lit("part"), key).alias("name"),
        (F.col("p_size") > 25).alias("discover_homepage"),
        F.array(F.concat(F.lit("https://xueqiu.com/"), F.col("p_size").cast("string"), F.lit("/"), key)).alias("post_urls"),
        F.lit(None).cast("array<string>").alias("bilibili_video_targets"),
        none.alias("bilibili_space_urls"),
        F.split("p_name", " ").alias("stock_ids"),
        none.alias("topic_ids"),
        F.array("p_brand").alias("user_ids"),
    )
    return S.manual_items(definitions)


@query(
    "seed_refresh_totals",
    """SELECT count(*) AS generator_runs, coalesce(sum(user_id), 0)::BIGINT AS generated_items FROM events WHERE event_type <> 'error'""",
)
def seed_refresh_totals(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").otherwise("succeeded")
    return S.refresh_totals(t.events.select(status.alias("status"), F.col("user_id").alias("item_count")))


@query(
    "catalog_reference_check",
    """WITH refs AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS name, CAST(unnest([l_partkey, l_suppkey * 400]) AS VARCHAR) AS reference FROM lineitem)
SELECT 'duplicate set' AS problem, CAST(l_orderkey AS VARCHAR) AS name, NULL AS reference FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL SELECT 'unknown generator', name, reference FROM refs WHERE reference NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)""",
)
def catalog_reference_check(t: Tables) -> DataFrame:
    sets = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("name"),
        F.array(F.col("l_partkey").cast("string"), (F.col("l_suppkey") * 400).cast("string")).alias("generators"),
    )
    return S.catalog_problems(sets, t.part.select(F.col("p_partkey").cast("string").alias("name")))
