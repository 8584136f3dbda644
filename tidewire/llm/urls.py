"""URL filters: explicit host and path rules, then mined association rules.

A short list of explicit rules is tested in place, so no host is moved, however hot; a long one is
joined by host suffix: each host meets the rules of its own suffixes once. A page picks the
longest whose path fits.

For the other pages a URL is a set of tokens (scheme, host labels, the host, path parts, query
names and values, ending). Spark's FP-growth mines token sets of labelled URLs together with the
label; sets found in MIN_ROWS labelled URLs or more, and nearly always with `block`, become rules.
Tokens that always occur together count as one, and a token that is blocked wherever it occurs is a
rule that no longer one can better. FP-growth sees at most MAX_TOKENS of a URL, so a long spam
template costs no more than a short one; sets of tokens of the URLs this cuts are found level by
level, whatever their length (see `_within_long`), so no rule is lost. Rules match by an inverted
index from token to rule: a rule fires when all its tokens are found. Only distinct sets of rule
tokens are matched, so a pattern shared by very many pages is judged once.

Nulls: a null URL, or one without `://`, has empty host and path, no tokens, and is allowed. Null
labels do not train. No labels, or labels of one kind: no mined rules, all remaining pages are
allowed. Repeated rows are judged each. Very long URLs have a token per part. Of equally good rules the
longer fires, then the one with the larger number. An empty table gives an empty result. Other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, named

#: (verdict, host, path): fixed values of the query.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
BLOCK = "label=block"
# A rule must cover this many labelled URLs, however many there are, and block this share of them.
MIN_ROWS, MIN_CONFIDENCE = 20, 0.8
# Tokens of a labelled URL that FP-growth sees, those in front that are blocked most; others are searched level by level.
MAX_TOKENS = 10
# Explicit rules that are tested in place; more of them are joined by host suffix.
INLINE_RULES = 100
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """Between the first :// and /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, each marked by its place."""
    lower = F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)
    h = host(lower)

    def parts(text: Column, split: str, mark: str) -> Column:
        return F.transform(F.filter(F.split(text, split), lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    query = F.regexp_extract(lower, r"(?s)\A[^?#]*\?([^#]*)", 1)
    scheme = F.regexp_extract(lower, r"\A([a-z][a-z0-9+.-]*)://", 1)
    ending = F.regexp_extract(path(lower), r"\.([a-z0-9]{1,5})\z", 1)
    one = F.filter(F.array(
        F.concat(F.lit("scheme="), scheme), F.concat(F.lit("site="), h), F.concat(F.lit("end="), ending),
    ), lambda t: ~F.endswith(t, F.lit("=")))
    every = F.concat(one, parts(h, r"\.", "host="), parts(path(lower), "/", "path="), parts(query, "[&;]", "query="))
    return F.when(h != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _frequent(rows: DataFrame, min_rows: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """(token, n, bad) of the tokens fit for rules, and (row, blocked, token, n, bad) of those fit for longer ones.

    Tokens found in exactly the same URLs stand for one another, so of each such class only one is
    kept; without that a template of k tokens would have 2**k equal itemsets. A token blocked too
    seldom is in no rule; one that is always blocked is a rule, and longer ones are no more confident.
    """
    each = rows.select("row", "blocked", F.explode("tokens").alias("token"))
    marks = [F.bit_xor(F.xxhash64("row", F.lit(i))).alias(f"x{i}") for i in range(2)]
    found = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("bad"), *marks)
    found = found.where((F.col("n") >= min_rows) & (F.col("bad") >= _least_bad(min_rows, min_confidence)))
    chosen = cut_lineage(found.groupBy("n", "bad", "x0", "x1").agg(F.min("token").alias("token")).select("token", "n", "bad"))
    return chosen, cut_lineage(each.join(chosen.where("bad < n"), "token"))


def _least_bad(min_rows: int, min_confidence: float) -> float:
    """Blocked URLs that any rule covers; less a little, so that rounding loses none."""
    return min_rows * min_confidence - 1e-6


def _transactions(each: DataFrame, max_tokens: int) -> DataFrame:
    """(row, items, cut): of each URL of `each` the tokens for FP-growth, at most `max_tokens`, and BLOCK
    if blocked. Where `cut` is true it has more tokens, which are for `_within_long`."""
    order = [F.desc(F.col("bad") / F.col("n")), F.desc("n"), F.col("token")]
    nth = F.row_number().over(Window.partitionBy("row").orderBy(*order))
    kept = each.withColumn("nth", nth).where(F.col("nth") <= max_tokens + 1)
    label = F.when(F.first("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    items = F.collect_list(F.when(F.col("nth") <= max_tokens, F.col("token")))
    return kept.groupBy("row").agg(F.concat(items, label).alias("items"), (F.max("nth") > max_tokens).alias("cut"))


def _within_long(each: DataFrame, cut: DataFrame, fine: int, min_rows: int, min_confidence: float) -> DataFrame:
    """(items): candidates for rules among the tokens of the URLs `cut`(row), counted in all URLs of `each`.

    `fine` is the number of labelled URLs that are not blocked. Sets grow by a token a level, and a set
    grows only while each of its tokens leaves out a URL that is not blocked and that the others let
    in: without such a token the set covers as many of those, and at least as many blocked ones, so
    the shorter set is at least as confident. Every part of a set that passes has passed, so no
    rule is lost, and templates whose parts nearly always occur together end at once. URLs with the
    same tokens are one row with their numbers.
    """
    seen = each.join(cut, "row", "left_semi").select("token").distinct()
    rows = each.join(seen, "token").groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("rest"), F.first("blocked").alias("blocked"))
    rows = rows.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("bad"))
    rows = cut_lineage(rows.select(F.array().cast("array<string>").alias("items"), "rest", "n", "bad"))
    level = each.sparkSession.range(1).select(F.array().cast("array<string>").alias("part"), F.lit(fine).alias("fine"))
    found = rows.select("items").limit(0)
    while True:
        grown = rows.select("items", "n", "bad", F.col("rest").alias("_rest"), F.posexplode("rest").alias("_at", "_token"))
        grown = grown.select(
            F.concat("items", F.array("_token")).alias("items"), F.slice("_rest", F.col("_at") + 2, F.size("_rest")).alias("rest"), "n", "bad"
        )
        counted = grown.groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        counted = counted.where((F.col("n") >= min_rows) & (F.col("bad") >= _least_bad(min_rows, min_confidence)))
        each_part = F.explode(F.transform("items", lambda _, i: F.filter("items", lambda _, j: j != i))).alias("part")
        parts = counted.select("items", "n", "bad", each_part).join(level, "part").where("n - bad < fine")
        sets = parts.groupBy("items", "n", "bad").agg(F.count(F.lit(1)).alias("parts")).where(F.col("parts") == F.size("items"))
        sets = cut_lineage(sets.select("items", "n", "bad"))
        if sets.isEmpty():
            return found
        found = found.unionByName(sets.where(F.col("bad") / F.col("n") >= min_confidence).select("items"))
        # A set that covers blocked URLs only has nothing left to leave out.
        open_ = sets.where("bad < n")
        level = open_.select(F.col("items").alias("part"), (F.col("n") - F.col("bad")).alias("fine"))
        rows = grown.where(F.size("rest") > 0).join(open_.select("items"), "items")
        rows = cut_lineage(rows.groupBy("items", "rest").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))


def mined_rules(labelled: DataFrame, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(rule_id, items, confidence, support) from rows (url, blocked boolean); support is a number of rows.

    A rule stays only if no shorter rule among its tokens is at least as confident. Figures of
    the rules found are counted again on whole URLs, for pruning. `max_tokens` changes how rules are
    found, not which.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule_id long, items array<string>, confidence double, support long")
    rows = labelled.where("blocked IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "blocked", tokens(F.col("url")).alias("tokens"))
    rows = cut_lineage(rows)
    single, each = _frequent(rows, min_rows, min_confidence)
    found = single.where(F.col("bad") / F.col("n") >= min_confidence).select(F.array("token").alias("items"))
    baskets = cut_lineage(_transactions(each, max_tokens))
    total = baskets.count()
    if total >= min_rows:
        # Half a row below the bound, so that rounding of the share cannot lift it.
        model = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / total, minConfidence=min_confidence).fit(baskets)
        found = found.unionByName(model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK))).select(F.array_sort("antecedent").alias("items")))
        cut = baskets.where("cut").select("row")
        if not cut.isEmpty():
            found = found.unionByName(_within_long(each, cut, rows.where("NOT blocked").count(), min_rows, min_confidence))
    found = cut_lineage(found.distinct().withColumn("rule_id", F.xxhash64("items")))
    if found.isEmpty():
        return empty
    index = found.select("rule_id", F.size("items").alias("n"), F.explode("items").alias("token"))
    fired = rows.select("row", "blocked", F.explode("tokens").alias("token")).join(index, "token").groupBy("row", "blocked", "rule_id", "n").count().where("count = n")
    figures = fired.groupBy("rule_id").agg(F.count(F.lit(1)).alias("support"), (F.count_if("blocked") / F.count(F.lit(1))).alias("confidence"))
    items = found.join(figures.where((F.col("support") >= min_rows) & (F.col("confidence") >= min_confidence)), "rule_id")
    items = cut_lineage(items.select("rule_id", "items", "confidence", "support"))
    # Shorter rules sit inside longer ones: look them up through the same inverted index.
    short = items.select(F.col("rule_id").alias("_s"), F.size("items").alias("_n"), F.col("confidence").alias("_c"), F.explode("items").alias("item"))
    long_ = items.select("rule_id", F.size("items").alias("n"), "confidence", F.explode("items").alias("item"))
    inside = long_.join(short, "item").where("_n < n AND _c >= confidence").groupBy("rule_id", "_s", "_n").count().where("count = _n")
    return cut_lineage(items.join(inside.select("rule_id").distinct(), "rule_id", "left_anti"))


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(have, rule_items, confidence): the best rule of each token set that fires one: the most
    confident, then the longest, then by its number.

    `token_sets` has a column `have`, distinct sets; the index is the rules' items, exploded.
    """
    index = rules.select("rule_id", "items", "confidence", F.size("items").alias("n"), F.explode("items").alias("item"))
    hits = token_sets.select("have", F.explode("have").alias("item")).join(index, "item")
    full = hits.groupBy("have", "rule_id", "n", "confidence", "items").count().where("count = n")
    best = F.max_by(F.struct(F.col("items").alias("rule_items"), "confidence"), F.struct("confidence", "n", "rule_id"))
    return full.groupBy("have").agg(best.alias("b")).select("have", "b.rule_items", "b.confidence")


def _fits(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of a bounded list of explicit rules that fits, as a struct; null if none does."""
    def one(verdict: str, of_host: str, of_path: str) -> Column:
        fits = ((host_ == of_host) | F.endswith(host_, F.lit(f".{of_host}"))) & F.startswith(path_, F.lit(of_path))
        rule = of_host + of_path
        return F.when(fits, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(of_path).alias("prefix"), F.lit(verdict).alias("verdict")))

    return F.array_max(F.array(*[one(*r) for r in rules]))


def explicit(hosts: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(host, fits): for each host with any, its rules as (length, rule, path, verdict)."""
    spark = hosts.sparkSession
    listed = spark.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = hosts.select("host", F.explode(suffix).alias("rule_host")).join(listed, "rule_host")
    rule = F.concat("rule_host", "rule_path")
    return each.groupBy("host").agg(F.collect_set(F.struct(F.char_length(rule).alias("length"), rule.alias("rule"), F.col("rule_path").alias("prefix"), "verdict")).alias("fits"))


def _with_explicit(rows: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds `best`: few rules are tested in place, many are joined by host suffix."""
    if not rules:
        return rows.withColumn("best", F.lit(None).cast("struct<length:int,rule:string,prefix:string,verdict:string>"))
    if len(rules) <= INLINE_RULES:
        return rows.withColumn("best", _fits(F.col("host"), F.col("path"), rules))
    fits = explicit(rows.select("host").where("host <> ''").distinct(), rules)
    fitting = F.filter("fits", lambda r: F.startswith(F.col("path"), r["prefix"]))
    return rows.join(fits, "host", "left").withColumn("best", F.array_max(fitting)).drop("fits")


def judged(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, reason for every row of (page_id, url)."""
    mined = mined_rules(labelled)
    url = F.col("url")
    rows = named(pages, "page_id", "url").select("page_id", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("_tokens"))
    rows = _with_explicit(rows, rules).withColumn("_row", F.monotonically_increasing_id())
    if mined.isEmpty():
        rows = rows.withColumn("rule_items", F.lit(None).cast("array<string>"))
    else:
        rows = cut_lineage(rows)
        words = mined.select(F.explode("items").alias("token")).distinct()
        have = rows.where("best IS NULL").select("_row", F.explode("_tokens").alias("token")).join(words, "token")
        have = cut_lineage(have.groupBy("_row").agg(F.array_sort(F.collect_set("token")).alias("have")))
        fired = have.join(matched(have.select("have").distinct(), mined), "have").select("_row", "rule_items")
        rows = rows.join(fired, "_row", "left")
    best = F.col("best")
    return rows.select(
        "page_id", "host", "path", best["rule"].alias("rule"),
        F.coalesce(best["verdict"], F.when(F.col("rule_items").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.when(best.isNull(), F.array_join("rule_items", " & ")).alias("reason"),
    )
