"""Hierarchical path tables ``nodes(ns, path, node_type)``: lookup, listing and bulk changes as joins.

Paths start with ``/``, have no empty parts and no trailing slash; the root is not stored. Every
stored node's parent is the root or a stored directory (``tree_violations`` lists exceptions).
Bulk changes take requests ``(ns, seq, ...)``, ``seq`` being unique and ordering them within ``ns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

FILE, DIRECTORY = "f", "d"


def normalize_path(path: Column) -> Column:
    """One leading slash, single slashes inside, none at the end; the root becomes ``''``."""
    return F.regexp_replace(F.regexp_replace(F.concat(F.lit("/"), path), "/+", "/"), "/$", "")


def parent_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def depth_of(path: Column) -> Column:
    return F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit("")))


def prefixes_of(path: Column) -> Column:
    """The path's ancestors and itself, without the root."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))),
                       lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def split_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``parent`` and ``name``."""
    clean = normalize_path(F.col(path))
    return df.withColumns({"parent": parent_of(clean), "name": name_of(clean)})


def lookup(nodes: DataFrame, requests: DataFrame) -> DataFrame:
    """Add ``found`` and ``node_type`` to requests ``(ns, path)``; '' and '/' are the root, which always exists."""
    asked = requests.withColumn("_path", normalize_path(F.col("path")))
    known = nodes.select(F.col("ns").alias("_ns"), F.col("path").alias("_node"), "node_type")
    hit = asked.join(known, (F.col("ns") == F.col("_ns")) & (F.col("_path") == F.col("_node")), "left")
    root = F.col("_path") == ""
    return hit.select(*requests.columns, (root | F.col("_node").isNotNull()).alias("found"),
                      F.when(root, DIRECTORY).otherwise(F.col("node_type")).alias("node_type"))


def list_subtree(nodes: DataFrame, prefix: str = "/", order: bool = True) -> DataFrame:
    """The node at ``prefix`` and all below it, pre-order with siblings by name; the root is an empty line."""
    top = prefix.strip("/")
    base = nodes.select("ns", "path")
    if top:
        at = "/" + top
        found = base.where((F.col("path") == at) | F.col("path").startswith(at + "/"))
    else:
        found = base.unionByName(nodes.select("ns").distinct().withColumn("path", F.lit("")))
    return found.orderBy("ns", F.split("path", "/")) if order else found


# Places that a bin of labels holds, by which intervals meet the nodes inside them.
BIN = 4096


def label_subtrees(nodes: DataFrame) -> DataFrame:
    """(ns, path, node_type, first, last): the pre-order place of every node, roots included, and of the last node below it.

    Nodes are dealt into ranges of (ns, path) and numbered there, then shifted by the counts of the lower ranges. A
    subtree is as long as the number of paths that pass through its top, counted where the paths lie.
    """
    roots = nodes.select("ns").distinct().select("ns", F.lit("").alias("path"), F.lit(DIRECTORY).alias("node_type"))
    whole = nodes.select("ns", "path", "node_type").unionByName(roots).withColumn("_parts", F.split("path", "/"))
    dealt = staged(whole.repartitionByRange("ns", "_parts").withColumn("_part", F.spark_partition_id()), "labels")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    below = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_below"))  # a row per range
    inner = F.row_number().over(Window.partitionBy("_part").orderBy("ns", "_parts"))
    numbered = dealt.withColumn("_inner", inner).join(F.broadcast(below), "_part").withColumn("first", F.col("_below") + F.col("_inner") - 1)
    tops = F.when(F.col("path") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), prefixes_of(F.col("path"))))
    sizes = dealt.select("ns", F.explode(tops).alias("path")).groupBy("ns", "path").agg(F.count(F.lit(1)).alias("_size"))
    return numbered.join(sizes, ["ns", "path"]).select("ns", "path", "node_type", "first", (F.col("first") + F.col("_size") - 1).alias("last"))


def list_subtrees(labels: DataFrame, requests: DataFrame) -> DataFrame:
    """(ns, top, path, node_type, place): what lies at and below every asked (ns, path), many at once; '' and '/' are the root.

    A request becomes the bins that its interval touches and meets the nodes of these bins. ``labels`` is the written
    result of ``label_subtrees``; ``place`` counts from 0 in pre-order. Unknown paths have no rows.
    """
    asked = requests.select("ns", normalize_path(F.col("path")).alias("path")).distinct()
    spans = labels.join(asked, ["ns", "path"], "left_semi").select(F.col("path").alias("top"), F.col("first").alias("_lo"), F.col("last").alias("_hi"))
    binned = spans.withColumn("_bin", F.explode(F.sequence(F.expr(f"_lo div {BIN}"), F.expr(f"_hi div {BIN}"))))
    met = labels.withColumn("_bin", F.expr(f"first div {BIN}")).join(binned, "_bin").where("first BETWEEN _lo AND _hi")
    return met.select("ns", "top", "path", "node_type", (F.col("first") - F.col("_lo")).alias("place"))


def directory_emptiness(nodes: DataFrame) -> DataFrame:
    """Every directory with ``is_empty``. Parents are made distinct per partition first."""
    parents = nodes.select("ns", parent_of(F.col("path")).alias("path")).distinct().withColumn("_used", F.lit(True))
    return (nodes.where(F.col("node_type") == DIRECTORY).join(parents, ["ns", "path"], "left")
            .select("ns", "path", F.col("_used").isNull().alias("is_empty")))


def tree_violations(nodes: DataFrame) -> DataFrame:
    """Nodes stored twice, below a file or below nothing."""
    directories = nodes.where(F.col("node_type") == DIRECTORY).select("ns", F.col("path").alias("_parent")).distinct()
    loose = (nodes.withColumn("_parent", parent_of(F.col("path"))).where(F.col("_parent") != "")
             .join(directories, ["ns", "_parent"], "left_anti")
             .select("ns", "path", F.lit("no_parent_directory").alias("reason")))
    twice = (nodes.groupBy("ns", "path").count().where("count > 1")
             .select("ns", "path", F.lit("duplicate").alias("reason")))
    return loose.unionByName(twice)


def capacity_report(nodes: DataFrame, max_entries: int = 20, max_nodes: int = 50, max_name: int = 99) -> DataFrame:
    """Directories, namespaces and names over the given sizes: (ns, kind, path, size)."""
    entries = (nodes.groupBy("ns", parent_of(F.col("path")).alias("path")).agg(F.count("*").alias("size"))
               .where(F.col("size") > max_entries).select("ns", F.lit("entries").alias("kind"), "path", "size"))
    # The root is a node too.
    totals = (nodes.groupBy("ns").agg((F.count("*") + 1).alias("size")).where(F.col("size") > max_nodes)
              .select("ns", F.lit("nodes").alias("kind"), F.lit("").alias("path"), "size"))
    names = (nodes.withColumn("size", F.char_length(name_of(F.col("path"))).cast("long"))
             .where(F.col("size") > max_name).select("ns", F.lit("name").alias("kind"), "path", "size"))
    return entries.unionByName(totals).unionByName(names)


# Bulk changes -------------------------------------------------------------------------------------

def _levels(requests: DataFrame) -> list[int]:
    """The depths that are asked for, ascending; one number per depth."""
    return sorted(r["_depth"] for r in requests.where(F.col("_path") != "").select("_depth").distinct().collect())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _touched(nodes: DataFrame, paths: list[DataFrame]) -> DataFrame:
    """The nodes at any of the given ``(ns, path)``, written once so that later steps skip the whole table."""
    return staged(nodes.join(_union(paths).distinct(), ["ns", "path"], "left_semi"), "touched")


def bulk_create(nodes: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Create nodes from requests ``(ns, seq, path, node_type)``: (outcomes with ``ok``, created nodes).

    A request succeeds if its parent is a directory at that moment, stored or created by a lower
    seq, nothing has the path yet and the name is not empty; of contested requests the lowest seq
    wins. Levels are decided from the root down, each reading only its own depth, and a level's
    winners are written before the next one uses them.
    """
    asked = staged(requests.withColumn("_path", normalize_path(F.col("path")))
                   .withColumn("_depth", depth_of(F.col("_path"))), "create")
    nodes = _touched(nodes, [asked.select("ns", F.col("_path").alias("path")),
                             asked.select("ns", parent_of(F.col("_path")).alias("path"))])
    before = F.lit(None).cast(requests.schema["seq"].dataType)
    none = asked.select("ns", "_path", "seq", "node_type").limit(0)
    created: list[DataFrame] = []
    above, last = none, None
    for depth in _levels(asked):
        if last is not None and depth != last + 1:
            above = none  # what was made lies too high to be a parent here
        last = depth
        level = asked.where(F.col("_depth") == depth).withColumn("_parent", parent_of(F.col("_path")))
        fresh = level.join(nodes.select("ns", F.col("path").alias("_path")), ["ns", "_path"], "left_anti")
        if depth == 1:
            timely = fresh
        else:
            stored = (nodes.where((F.col("node_type") == DIRECTORY) & (depth_of(F.col("path")) == depth - 1))
                      .select("ns", F.col("path").alias("_parent"), before.alias("_since")))
            made = above.where(F.col("node_type") == DIRECTORY).select(
                "ns", F.col("_path").alias("_parent"), F.col("seq").alias("_since"))
            timely = (fresh.join(stored.unionByName(made), ["ns", "_parent"])
                      .where(F.col("_since").isNull() | (F.col("seq") > F.col("_since"))))
        winners = timely.groupBy("ns", "_path").agg(F.min(F.struct("seq", "node_type")).alias("w"))
        above = staged(winners.select("ns", "_path", "w.seq", "w.node_type"), "created")
        created.append(above)
    made = _union(created) if created else none
    ok = made.select("ns", "seq", F.lit(True).alias("_ok"))
    outcomes = (asked.join(ok, ["ns", "seq"], "left")
                .select(*requests.columns, F.coalesce("_ok", F.lit(False)).alias("ok")))
    return outcomes, made.select("ns", F.col("_path").alias("path"), "node_type")


def bulk_delete(nodes: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete nodes from requests ``(ns, seq, path)``: (outcomes with ``ok``, remaining nodes).

    A file goes with its first request, a directory with the first after the last of its children
    went. Levels are decided from the deepest up. Children are counted before they meet their
    parents, so a directory with a third of all nodes is one row per partition there.
    """
    asked = staged(requests.withColumn("_path", normalize_path(F.col("path")))
                   .withColumn("_depth", depth_of(F.col("_path"))), "delete")
    none = asked.select("ns", "_path", "seq").limit(0)
    wanted = asked.select("ns", "_path").distinct()
    present = _touched(nodes, [wanted.select("ns", F.col("_path").alias("path"))])
    children = staged(nodes.groupBy("ns", parent_of(F.col("path")).alias("_path")).agg(F.count("*").alias("_children"))
                      .join(wanted, ["ns", "_path"], "left_semi"), "children")
    deleted: list[DataFrame] = []
    below, last = none, None
    for depth in reversed(_levels(asked)):
        if last is not None and depth != last - 1:
            below = none
        last = depth
        level = asked.where(F.col("_depth") == depth)
        stored = present.where(depth_of(F.col("path")) == depth).select("ns", F.col("path").alias("_path"))
        gone = below.groupBy("ns", parent_of(F.col("_path")).alias("_path")).agg(
            F.count("*").alias("_gone"), F.max("seq").alias("_last"))
        free = (level.join(stored, ["ns", "_path"], "left_semi")
                .join(children, ["ns", "_path"], "left").join(gone, ["ns", "_path"], "left")
                .where((F.coalesce("_children", F.lit(0)) == F.coalesce("_gone", F.lit(0)))
                       & (F.col("_last").isNull() | (F.col("seq") > F.col("_last")))))
        below = staged(free.groupBy("ns", "_path").agg(F.min("seq").alias("seq")), "deleted")
        deleted.append(below)
    removed = _union(deleted) if deleted else none
    ok = removed.select("ns", "seq", F.lit(True).alias("_ok"))
    outcomes = (asked.join(ok, ["ns", "seq"], "left")
                .select(*requests.columns, F.coalesce("_ok", F.lit(False)).alias("ok")))
    left = nodes.join(removed.select("ns", F.col("_path").alias("path")), ["ns", "path"], "left_anti")
    return outcomes, left.select(*nodes.columns)


def bulk_move(nodes: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move subtrees from requests ``(ns, seq, source, target)``: (outcomes with ``outcome``, nodes after).

    Outcomes are ``ok``, ``failed`` or ``deferred``. Every request is judged against the given
    nodes: the source exists, the target's parent is a directory, the target does not exist and
    does not lie below the source. A request one of whose paths equals, contains or lies below a
    path of an earlier request is deferred; submit it again on the result.
    """
    asked = (requests.withColumn("_from", normalize_path(F.col("source")))
             .withColumn("_to", normalize_path(F.col("target"))))
    below_itself = F.col("_to").startswith(F.concat("_from", F.lit("/")))
    sane = (F.col("_from") != "") & (F.col("_to") != "") & ~below_itself
    asked = staged(asked.withColumn("_sane", sane), "move")

    # The earliest request touching each path, and the earliest with a path at or below it.
    ends = asked.where("_sane").select("ns", "seq", F.explode(F.array("_from", "_to")).alias("end"))
    at = ends.groupBy("ns", "end").agg(F.min("seq").alias("_at"))
    reach = ends.select("ns", "seq", "end", F.explode(prefixes_of(F.col("end"))).alias("prefix"))
    under = reach.groupBy("ns", "prefix").agg(F.min("seq").alias("_under"))
    from_above = (reach.join(at.withColumnRenamed("end", "prefix"), ["ns", "prefix"])
                  .groupBy("ns", "seq").agg(F.min("_at").alias("_first")))
    from_below = (ends.join(under.withColumnRenamed("prefix", "end"), ["ns", "end"])
                  .groupBy("ns", "seq").agg(F.min("_under").alias("_first")))
    first = from_above.unionByName(from_below).groupBy("ns", "seq").agg(F.min("_first").alias("_first"))

    target_parent = parent_of(F.col("_to"))
    known = _touched(nodes, [asked.select("ns", c.alias("path")) for c in (F.col("_from"), F.col("_to"), target_parent)])

    def node(alias: str, path: str) -> DataFrame:
        return known.select("ns", F.col("path").alias(path), F.col("node_type").alias(alias))

    judged = (asked.withColumn("_target_parent", target_parent)
              .join(first, ["ns", "seq"], "left")
              .join(node("_source_type", "_from"), ["ns", "_from"], "left")
              .join(node("_target_type", "_to"), ["ns", "_to"], "left")
              .join(node("_parent_type", "_target_parent"), ["ns", "_target_parent"], "left"))
    possible = (F.col("_sane") & F.col("_source_type").isNotNull() & F.col("_target_type").isNull()
                & ((F.col("_target_parent") == "") | (F.col("_parent_type") == DIRECTORY)))
    verdict = (F.when(F.col("_first") < F.col("seq"), "deferred").when(possible, "ok").otherwise("failed"))
    outcomes = staged(judged.select(*requests.columns, "_from", "_to", verdict.alias("outcome")), "moved")

    # A node moves with the one moved path among itself and its ancestors; only the depths that
    # occur among the moved paths are looked at.
    moves = outcomes.where(F.col("outcome") == "ok").select("ns", F.col("_from").alias("_prefix"), "_to")
    # Bounded: one number per depth of the tree.
    depths = [r[0] for r in moves.select(depth_of(F.col("_prefix"))).distinct().collect()]
    after = nodes
    if depths:
        parts = F.split("path", "/")
        heads = F.array(*[F.when(F.size(parts) > d, F.array_join(F.slice(parts, 1, d + 1), "/")) for d in sorted(depths)])
        heads = F.array_compact(heads)
        # Nodes too shallow to be moved skip the join.
        reach = nodes.withColumn("_heads", heads)
        hit = (reach.where(F.size("_heads") > 0).select("ns", "path", F.explode("_heads").alias("_prefix"))
               .join(moves, ["ns", "_prefix"])
               .select("ns", "path", F.concat("_to", F.expr("substring(path, char_length(_prefix) + 1)")).alias("_new")))
        after = (nodes.join(hit, ["ns", "path"], "left")
                 .withColumn("path", F.coalesce("_new", "path")).select(*nodes.columns))
    return outcomes.drop("_from", "_to"), after
