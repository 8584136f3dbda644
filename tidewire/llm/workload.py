"""Registered queries of this subpackage, over whole tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import chat, codebooks, dedup, langid, licenses, mixing, packing, pieces, simhash, topk, toxicity, tries, urls
from tidewire.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _escaped_sql(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for control in chat.CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


_OP4 = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), parts AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text,
    length('{chat.START}') + length('{chat.SEP}') + length('{chat.END[:-1]}') + 1
      + length({_escaped_sql('role')}) + length({_escaped_sql('text')}) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)) AS turns_sha256,
  CAST(sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id
"""


@query(_OP4)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema))
    back = chat.read_back(chat.formatted(chat.branches(chat.linear(rows))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", "blocked")
    return urls.judged(pages, labelled)


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


_OP8 = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


@query(_OP8)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(table(spark, sf_dir, "documents"))


_OP9 = """
WITH v AS (
  SELECT vec_id, [floor(CAST(x AS DOUBLE) * 64) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query(_OP9)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query()
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


@query()
def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_ = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces_.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# crc32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, i: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

_OP12 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT conv_id, {_CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos > c.h
  UNION ALL SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 WHERE t.pos <= c.h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
    string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '' ) OVER w AS way
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (SELECT depth, way, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY depth, way),
up AS (
  SELECT n.depth, n.way, n.conv_id, n.n_convs, n.bytes, a.way AS above, a.conv_id AS parent_conv_id
  FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n a ON a.depth = p.depth AND a.way = p.way
), k AS (SELECT depth - 1 AS depth, above AS way, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
s AS (
  SELECT p.depth, p.way, CAST(sum(CASE WHEN k.way IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.bytes) AS BIGINT) AS saved_tokens
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN k ON k.depth = n.depth AND k.way = n.way GROUP BY p.depth, p.way
), e AS (
  SELECT depth, way, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY depth, way
)
SELECT up.conv_id, up.depth, up.parent_conv_id, up.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM up JOIN s USING (depth, way) LEFT JOIN k USING (depth, way) LEFT JOIN e USING (depth, way)
"""


@query(_OP12)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(tries.shared_starts(tries.sequences(table(spark, sf_dir, "conversations"))))


def _assign_sql(book: str) -> str:
    """Nearest entries by exact inner products; ties to the lower entry."""
    return f"""SELECT x.row, x.part, min_by(b.entry, (b.sq - 2 * list_dot_product(x.v, b.v), b.entry)) AS entry,
      min(b.sq - 2 * list_dot_product(x.v, b.v)) + any_value(list_dot_product(x.v, x.v)) AS error, any_value(x.v) AS v
    FROM x JOIN {book} b ON x.part = b.part GROUP BY x.row, x.part"""


def _op13() -> str:
    steps = ["""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, [floor(CAST(x AS DOUBLE) * 1024) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), x AS MATERIALIZED (
  SELECT row, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS v FROM v, range(4) r(part)
), b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v, list_dot_product(v, v) AS sq FROM x WHERE row <= 256)"""]
    for i in range(4):
        steps.append(f"""a{i} AS MATERIALIZED ({_assign_sql(f"b{i}")}),
m{i} AS (SELECT part, entry, place, floor(sum(y) / count(*)) AS y FROM (SELECT part, entry, unnest(v) AS y, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY ALL),
n{i} AS (SELECT part, entry, list(y ORDER BY place) AS v FROM m{i} GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, entry, v, list_dot_product(v, v) AS sq FROM (SELECT b.part, b.entry, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN n{i} n USING (part, entry)))""")
    steps.append(f"""a4 AS MATERIALIZED ({_assign_sql("b4")}),
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error FROM a4 GROUP BY row),
digest AS (SELECT sha256(string_agg(array_to_string([CAST(y AS BIGINT) for y in v], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4)""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (row), digest"""


@query(_op13())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codebooks.compressed(table(spark, sf_dir, "embeddings"))
    return codebooks.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks.digest(books)).alias("codebooks_sha256"))
