"""JSON values: variant access with Python-like truthiness, topic lists, embedded blocks."""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.urls import FORUM_BASE, POST_URL

# The walk below is shipped by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# JSON texts that count as "no value" when the first usable field is wanted.
_EMPTY = ("null", "false", "0", "0.0", '""', "[]", "{}")


def parse(text: Column) -> Column:
    return F.try_parse_json(text)


def field(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def usable(v: Column) -> Column:
    """The variant itself, or null when it is absent, null, zero, false or empty."""
    return F.when(~F.to_json(v).isin(*_EMPTY), v)


def first_usable(v: Column, *paths: str) -> Column:
    """First field with a usable value, as variant."""
    return F.coalesce(*[usable(field(v, p, "variant")) for p in paths])


def first_text(v: Column, *paths: str) -> Column:
    return F.try_variant_get(first_usable(v, *paths), "$", "string")


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT<")), F.lit(False))


def whole(v: Column) -> Column:
    """A JSON value as an integer: numbers lose their fraction, true is 1, text must be an integer; else null."""
    kind = F.schema_of_variant(v)
    exact = F.try_variant_get(v, "$", "decimal(38,10)").try_cast("bigint")
    rounded = F.try_variant_get(v, "$", "double")
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .when(kind == "STRING", F.trim(F.try_variant_get(v, "$", "string")).try_cast("bigint"))
        .when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint"))
        .when(F.startswith(kind, F.lit("DECIMAL")), exact)
        .when(kind.isin("DOUBLE", "FLOAT"), rounded.try_cast("bigint"))
    )


def elements(v: Column, path: str) -> Column:
    """Elements of the array at path, or null when it is missing or not an array."""
    return field(v, path, "array<variant>")


def topic_ids(c: Column) -> Column:
    """JSON text array to array<string>; anything else to an empty array."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.try_variant_get(F.try_parse_json(c), "$", "array<string>"), none)


# --- post links inside arbitrarily nested timeline payloads -------------------------------

# Fields holding a link, and fields holding an embedded status.
_LINK_FIELDS = ("target", "url", "canonical_url", "share_url")
_STATUS_FIELDS = ("status", "retweeted_status", "retweet_status", "original_status")


def _status_links(status: dict, base: str) -> list[str]:
    """Link texts of a status record and of the statuses embedded in it."""
    links: list[str] = []
    chain: list[object] = [status]
    while chain:
        record = chain.pop()
        if not isinstance(record, dict):
            continue
        links += [record[k] for k in _LINK_FIELDS if isinstance(record.get(k), str)]
        post, author = record.get("id") or record.get("status_id"), record.get("user_id")
        if author is None and isinstance(record.get("user"), dict):
            author = record["user"].get("id")
        if post is not None and author is not None:
            links.append(f"{base}/{author}/{post}")
        chain += [record[k] for k in _STATUS_FIELDS if k in record]
    return links


def _timeline_links(payload: object, base: str, is_post) -> list[str]:
    """Every object that is an element of some list, at any depth, is a status record."""
    links: list[str] = []
    containers = [payload] if isinstance(payload, (dict, list)) else []
    while containers:
        node = containers.pop()
        children = node
        if isinstance(node, dict):
            children = node.values()
        else:
            for item in node:
                if isinstance(item, dict):
                    links += _status_links(item, base)
        containers += [c for c in children if isinstance(c, (dict, list))]
    return sorted({u for u in (link.rstrip("/") for link in links) if is_post(u)})


def timeline_links(text: Column, base_url: str = FORUM_BASE, pattern: str = POST_URL) -> Column:
    """Distinct sorted post URLs of a JSON payload of unknown depth; null when it cannot be
    read as JSON.

    The nesting is unbounded, which no built-in expression can walk, so this is an Arrow UDF
    over one payload at a time.
    """
    base = base_url.rstrip("/")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def walk(texts: pd.Series) -> pd.Series:
        is_post = re.compile(f"(?:{pattern})").fullmatch

        def one(payload: str | None) -> list[str] | None:
            if payload is None:
                return None
            try:
                return _timeline_links(json.loads(payload), base, is_post)
            except (ValueError, RecursionError):  # no JSON, a number too long, or nested too deep
                return None

        return texts.map(one)

    return walk(text)
