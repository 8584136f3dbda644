"""Posts with comments, owner-only comments, and comment trees."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import non_empty
from tidewire.session import cut_lineage

_POST_KEY = ["source", "post_entity_id"]


def with_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Every post with each of its comments, flat; a post without comments has one row.

    Written as inner join plus the lonely posts instead of a left join: Spark can split a
    skewed comment partition of an inner join, but not the right side of a left join. Comments
    are not nested into an array, since one post may hold a third of them.
    """
    keyed = posts.select(
        F.col("source"), F.col("source_entity_id").alias("post_entity_id"), F.col("title").alias("post_title")
    )
    replies = comments.select(
        *_POST_KEY,
        F.col("source_entity_id").alias("comment_id"),
        F.col("author_entity_id").alias("comment_author"),
        F.coalesce("published_at", "fetched_at").alias("comment_time"),
        F.col("content_text").alias("comment_text"),
    )
    matched = replies.join(keyed, _POST_KEY)
    lonely = keyed.join(replies.select(*_POST_KEY).distinct(), _POST_KEY, "left_anti")
    return matched.select(
        *_POST_KEY, "post_title", "comment_id", "comment_author", "comment_time", "comment_text"
    ).unionByName(lonely, allowMissingColumns=True)


def owner_comments(comments: DataFrame, posts: DataFrame, source: str = "bilibili") -> DataFrame:
    """Drop other people's comments where the post's owner is known; other sources pass.

    Comments are the left side, the one a skewed post makes large.
    """
    owners = posts.where(F.col("source") == source).select(
        "source", F.col("source_entity_id").alias("post_entity_id"), F.col("author_entity_id").alias("_owner")
    )
    owner = F.col("_owner")
    mine = F.coalesce(F.col("author_entity_id") == owner, F.lit(False))
    return comments.join(owners, _POST_KEY, "left").where(owner.isNull() | mine).drop("_owner")


def pointed_at(rows: DataFrame, pending: DataFrame) -> DataFrame:
    """The rows that pending comments point at, kept for the next round."""
    anchors = pending.select(*_POST_KEY, F.col("anchor").alias("source_entity_id")).distinct()
    return cut_lineage(rows.join(anchors, [*_POST_KEY, "source_entity_id"], "left_semi"))


def comment_tree(comments: DataFrame, *, strict: bool = False, paths: bool = False) -> DataFrame:
    """Depth and root of every comment within its post.

    Adds `root_id`, `depth`, `is_orphan` (the parent is not among the post's comments) and
    `in_cycle`. An orphan is a depth-0 root that keeps its descendants; `strict` keeps the
    orphan itself but drops its descendants, and everything in or under a cycle. `paths` adds
    the sort path (time, id) from the root, whose order is the pre-order walk; it is as long
    as the comment is deep.

    Ancestors are found by pointer doubling: a thread of depth d needs about log2(d) joins, and
    resolved comments leave the working set. What pending comments are joined with shrinks too: a
    node that some comment points at after a round was already pointed at before it, so each round
    looks up only among the rows the round before looked at. Rounds are checkpointed. A round
    without progress leaves only cycles.
    """
    key = [*_POST_KEY, "source_entity_id"]
    place = F.struct(F.coalesce("published_at", "fetched_at").alias("at"), F.col("source_entity_id").alias("id"))
    nodes = comments.select(
        *key, non_empty(F.col("parent_comment_entity_id")).alias("parent"), place.alias("_place")
    )
    ids = nodes.select(*_POST_KEY, F.col("source_entity_id").alias("parent"), F.lit(True).alias("_known"))
    linked = nodes.join(ids, [*_POST_KEY, "parent"], "left")
    is_root = F.col("_known").isNull()
    path = F.array("_place") if paths else F.array().cast("array<struct<at:timestamp,id:string>>")
    state = linked.select(
        *key,
        (F.col("parent").isNotNull() & is_root).alias("is_orphan"),
        is_root.alias("done"),
        F.when(is_root, F.col("source_entity_id")).otherwise(F.col("parent")).alias("anchor"),
        F.when(is_root, 0).otherwise(1).cast("bigint").alias("depth"),
        (path if paths else F.lit(None).cast("string")).alias("path"),
    )
    state = cut_lineage(state)
    total = max(state.count(), 2)
    pending = state.where(~F.col("done"))
    resolved = [state.where("done")]
    lookup = pointed_at(state, pending)
    for _ in range(math.ceil(math.log2(total)) + 2):
        ahead = lookup.select(
            *_POST_KEY,
            F.col("source_entity_id").alias("anchor"),
            F.col("anchor").alias("_anchor"),
            F.col("depth").alias("_depth"),
            F.col("done").alias("_done"),
            F.col("path").alias("_path"),
        )
        moved = pending.join(ahead, [*_POST_KEY, "anchor"])
        stepped = moved.select(
            *key,
            "is_orphan",
            F.col("_done").alias("done"),
            F.col("_anchor").alias("anchor"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.concat("_path", "path") if paths else F.col("path")).alias("path"),
        )
        stepped = cut_lineage(stepped)
        resolved.append(stepped.where("done"))
        pending = stepped.where(~F.col("done"))
        if pending.isEmpty():
            break
        lookup = pointed_at(lookup.where("done").unionByName(stepped), pending)
    tree = resolved[0]
    for part in resolved[1:]:
        tree = tree.unionByName(part)
    tree = tree.withColumn("in_cycle", F.lit(False)).unionByName(
        pending.withColumns(
            {
                "in_cycle": F.lit(True),
                "anchor": F.lit(None).cast("string"),
                "depth": F.lit(None).cast("bigint"),
            }
        )
    )
    if strict:
        orphan_roots = tree.where("is_orphan").select(*_POST_KEY, F.col("source_entity_id").alias("anchor"))
        below = tree.where("depth > 0").join(orphan_roots, [*_POST_KEY, "anchor"], "left_anti")
        tree = tree.where("depth = 0").unionByName(below)
    columns = [*key, F.col("anchor").alias("root_id"), "depth", "is_orphan", "in_cycle"]
    return tree.select(*columns, *(["path"] if paths else []))
