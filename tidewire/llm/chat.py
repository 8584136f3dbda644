"""Chat formatting over reply trees.

Messages point to the message they answer. Iterative self-joins list, for every leaf, the nodes
on its way to the root: the known ancestors double each round, so a tree of depth d takes log2(d)
rounds, and only ids move. Branches of a tree are ranked by the score of their path, the wanted
ones keep their text, and each becomes one conversation.

Format: `<|im_start|>role<|im_sep|>text<|im_end|>` and a newline per turn. Inside roles and texts
a backslash is doubled, and every control string of CONTROL gets a backslash after its first
character, so none survives; `unescaped` undoes both. The loss mask is a list of character spans
of the formatted text that cover the assistant texts.

Nulls: null texts and roles are empty, null scores count 0. A message whose parent is unknown, or
null, is a root; messages on a cycle reach no root and are left out. Rows with a null
conversation form one conversation of their own. Repeated turns are ordered by role and text.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage

# The control strings of this and other common chat templates.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
_TURN = r"(?s)<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    """A doubled backslash becomes one, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every node on the way from each leaf to its root, `up` steps above it.

    `nodes` has (tree, node, parent), node unique in its tree and never null. Leaves that never
    reach a root (cycles have no leaf of their own, but may carry one) are left out.
    """
    def named(rows: DataFrame, node: str, *more) -> DataFrame:
        return rows.select(F.col("tree").alias("_t"), F.col(node).alias("_n"), *more)

    def at(node: str) -> Column:
        return F.col("tree").eqNullSafe(F.col("_t")) & (F.col(node) == F.col("_n"))

    known = named(nodes, "node", F.lit(True).alias("_known"))
    jump = nodes.join(known, at("parent"), "left").select("tree", "node", F.when(F.col("_known"), F.col("parent")).alias("to"))
    jump = cut_lineage(jump)
    leaves = jump.join(named(jump.where("to IS NOT NULL"), "to").distinct(), at("node"), "left_anti")
    found = cut_lineage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    roots = named(jump.where("to IS NULL"), "node")
    hop, limit = 1, jump.count()
    jump = jump.where("to IS NOT NULL")
    while hop <= max(limit, 1):
        # Every known ancestor is followed by as many again.
        above = found.join(named(jump, "node", "to"), at("node"))
        found = cut_lineage(found.unionByName(above.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + hop).alias("up"))))
        twice = jump.join(named(jump, "node", F.col("to").alias("_to")), at("to"))
        jump = cut_lineage(twice.select("tree", "node", F.col("_to").alias("to")))
        hop *= 2
        if jump.isEmpty():
            return found
    # A jump longer than the table: some nodes lie on a cycle. Keep the leaves that reach a root.
    whole = named(found.join(roots, at("node")).select("tree", "leaf"), "leaf")
    return found.join(whole, at("leaf"), "left_semi")


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """Chosen paths with their texts: (tree, leaf, rank, depth, role, text), depth 0 at the root.

    `messages` has (tree, node, parent, role, text, score). Paths of a tree are ranked by the sum
    of their scores, then by leaf; `best` keeps that many per tree (all by default).
    """
    messages = messages.withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    way = paths(messages.select("tree", "node", "parent"))
    def named(rows: DataFrame, node: str, *more) -> DataFrame:
        return rows.select(F.col("tree").alias("_t"), F.col(node).alias("_n"), *more)

    def at(node: str) -> Column:
        return F.col("tree").eqNullSafe(F.col("_t")) & (F.col(node) == F.col("_n"))

    scored = way.join(named(messages, "node", "score"), at("node"))
    totals = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("total"), F.max("up").alias("top"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    chosen = way.join(named(ranked, "leaf", "rank", "top"), at("leaf")).select("tree", "leaf", "node", "rank", (F.col("top") - F.col("up")).alias("depth"))
    return chosen.join(named(messages, "node", "role", "text"), at("node")).select("tree", "leaf", "rank", "depth", "role", "text")


def formatted(turns: DataFrame) -> DataFrame:
    """One row per path: tree, leaf, rank, formatted, loss (spans start, length), n_turns.

    Offsets come from a running sum of turn lengths; a path is gathered once, as its text must be.
    """
    role, text = escaped(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    rows = turns.select(
        "tree", "leaf", "rank", "depth", (F.coalesce("role", F.lit("")) == LOSS_ROLE).alias("_loss"),
        F.concat(F.lit(START), role, F.lit(SEP)).alias("_head"), text.alias("_text"),
    )
    size = F.char_length("_head") + F.char_length("_text") + len(END)
    before = F.sum(size).over(Window.partitionBy("tree", "leaf").orderBy("depth")) - size
    rows = rows.select(
        "tree", "leaf", "rank", "depth", F.concat("_head", "_text", F.lit(END)).alias("turn"),
        F.when(F.col("_loss"), F.struct((before + F.char_length("_head") + 1).cast("int").alias("start"), F.char_length("_text").alias("length"))).alias("span"),
    )
    path = rows.groupBy("tree", "leaf").agg(
        F.min("rank").alias("rank"), F.array_sort(F.collect_list(F.struct("depth", "turn", "span"))).alias("_turns")
    )
    return path.select(
        "tree", "leaf", "rank", F.array_join(F.col("_turns.turn"), "").alias("formatted"),
        F.filter(F.col("_turns.span"), lambda s: s.isNotNull()).alias("loss"), F.size("_turns").cast("long").alias("n_turns"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds `turns` (role, text) and `loss_text`, both from the formatted text alone and its mask."""
    heads = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(2))
    turn = F.zip_with(heads, texts, lambda r, t: F.struct(unescaped(r).alias("role"), unescaped(t).alias("text")))
    spans = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"], s["length"])))
    return conversations.withColumns({"turns": turn, "loss_text": F.array_join(spans, "")})


def linear(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees without branches: each turn answers the one before."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return rows.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
