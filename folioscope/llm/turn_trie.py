"""Prefix trie of conversations by bursting: containers of suffixes under trie heads, large ones split by their next turn.

Equal conversations are one sequence with a count. All sequences begin in the root's container; in each round every
container of several sequences with more than ``LIMIT`` turns becomes a trie head, and its sequences go on to a
container per next turn. What remains is small: a task sorts a container's suffixes and sweeps them into nodes. A single
long sequence is never split; its nodes follow from running sums over its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import BLANK

EVERY, SPREAD = 20, 4
# Turns of a container that a task sweeps; places of a running sum that are summed at once; ids written into one text.
LIMIT, SLICE, IDS_IN_TEXT = 1 << 13, 1 << 12, 1 << 12
_NODE = "box binary, up binary, top boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends long"
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def placed_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, pos, id, w): every turn's place from 1 in its conversation, a 128-bit name of (role, text) and the words of its text.

    Rows are dealt into ranges of (conversation, turn) and numbered within a range, then shifted by the counts of the
    lower ranges, so that a conversation of any length is numbered by many tasks. Texts stay where they are.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    name = F.unhex(F.md5(F.concat(F.char_length(said[0]).cast("string"), F.lit(":"), *said)))
    rows = conversations.select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), name.alias("id"),
                                F.regexp_count(said[1], F.lit(f"[^{BLANK}]+")).cast("long").alias("w")).where("c IS NOT NULL")
    dealt = staged(rows.repartitionByRange("c", F.asc_nulls_first("turn"), "id").withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    below = counts.select("c", "part", (F.sum("n").over(Window.partitionBy("c").orderBy("part")) - F.col("n")).alias("below"))
    inner = F.row_number().over(Window.partitionBy("c", "part").orderBy(F.asc_nulls_first("turn"), "id"))
    return dealt.withColumn("inner", inner).join(below, ["c", "part"]).select("c", (F.col("below") + F.col("inner")).alias("pos"), "id", "w")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c) of all conversations, and (c, pos, id, w) of the rebuilt ones: the first h turns of conversation c - c % 20, then
    the own turns after the first h, with h = crc32(c) % 4. ``placed`` is a written table."""
    lengths = placed.groupBy("c").agg(F.max("pos").alias("len"))
    convs = staged(lengths.withColumns({"h": F.crc32(F.col("c").cast("string").cast("binary")) % SPREAD, "base": F.col("c") - F.col("c") % EVERY}), "convs")
    heads = placed.where(F.col("pos") < SPREAD).select(F.col("c").alias("base"), "pos", "id", "w")
    first = convs.where("h > 0").select("c", "h", "base").join(heads, "base").where("pos <= h").select("c", "pos", "id", "w")
    bases = convs.select(F.col("c").alias("base"), F.col("len").alias("base_len"))
    taken = convs.join(bases, "base", "left").select("c", "h", F.coalesce(F.least("h", "base_len"), F.lit(0)).alias("k"))
    own = placed.join(taken, "c").where("pos > h").select("c", (F.col("k") + F.col("pos") - F.col("h")).alias("pos"), "id", "w")
    return convs.select("c"), first.unionByName(own)


def sequences(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, n, len) of each distinct sequence, c the smallest of its n conversations; and (c, member) of all conversations.

    A conversation is named by sums of two hashes over its (place, turn), summed where the rows lie.
    """
    sums = [F.sum(F.xxhash64(*x).cast("decimal(38,0)")).alias(a) for a, x in (("s1", ("pos", "id")), ("s2", ("id", "pos")))]
    named = convs.join(turns.groupBy("c").agg(F.max("pos").alias("len"), *sums), "c", "left").na.fill(0, ["len"])
    named = staged(named.withColumns({s: F.coalesce(s, F.lit(0).cast("decimal(38,0)")) for s in ("s1", "s2")}), "named")
    same = ["len", "s1", "s2"]
    groups = staged(named.groupBy(*same).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("n")), "sequences")
    return groups.select(F.col("rep").alias("c"), "n", "len"), named.join(groups, same).select(F.col("rep").alias("c"), F.col("c").alias("member"))


def ends_hashes(members: DataFrame) -> DataFrame:
    """(c, ends_sha256): SHA-256 of each sequence's members, rising and comma-joined.

    Members are sorted in ranges and written into texts there. The hash itself has to follow the texts one after the
    other, which a task does with one text in memory.
    """
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], names=["c", "least", "ids"])

        for batch in batches:
            for c, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (c != of or len(held) == IDS_IN_TEXT):
                    yield out()
                    held = []
                of = c
                held.append(member)
        if held:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state = None, None
        for batch in batches:
            done = []
            for c, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c != of:
                    if state:
                        done.append((of, state.hexdigest()))
                    of, state = c, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], names=["c", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([state.hexdigest()])], names=["c", "ends_sha256"])

    # Most sequences have one member and need neither.
    alone = members.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    counted = staged(members.join(alone, "c"), "members")
    single = counted.where("n = 1").select("c", F.sha2(F.col("member").cast("string").cast("binary"), 256).alias("ends_sha256"))
    ranges = counted.where("n > 1").select("c", "member").repartitionByRange("c", "member").sortWithinPartitions("c", "member")
    texts = ranges.mapInArrow(written, "c long, least long, ids string")
    several = texts.repartition("c").sortWithinPartitions("c", "least").select("c", "ids").mapInArrow(hashed, "c long, ends_sha256 string")
    return single.unionByName(several)


def _burst(reps: DataFrame, bodies: DataFrame, limit: int) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """The resting containers' sequences (c, n, len, box, up, w, depth), and per depth the heads (box, up, w) and the
    sequences that end at one (box, c, n). ``box`` names a container's common prefix, ``up`` that of one turn less, ``w`` its last turn's words."""
    state = staged(reps.select("c", "n", "len", F.lit(b"").alias("box"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("w"), F.lit(0).cast("long").alias("depth")), "state")
    resting, heads = None, []
    while True:
        depth = len(heads)
        sizes = state.groupBy("box").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("len") - depth).alias("turns"))
        large = staged(sizes.where((F.col("k") > 1) & (F.col("turns") > limit)).select("box"), "large")
        if large.isEmpty():
            return state if resting is None else resting.unionByName(state), heads
        calm = state.join(large, "box", "left_anti").select(state.columns)
        resting = calm if resting is None else resting.unionByName(calm)
        after = bodies.where(F.col("pos") == depth + 1).select("c", "id", F.col("w").alias("next_w"))
        moved = staged(state.join(large, "box", "left_semi").join(after, "c", "left"), "moved")
        heads.append((moved.groupBy("box").agg(F.first("up").alias("up"), F.first("w").alias("w")), moved.where("id IS NULL").select("box", "c", "n")))
        state = staged(moved.where("id IS NOT NULL").select("c", "n", "len", F.unhex(F.md5(F.concat("box", "id"))).alias("box"), F.col("box").alias("up"),
                                                            F.col("next_w").alias("w"), F.lit(depth + 1).cast("long").alias("depth")), "state")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose suffixes come in order: an open node per depth, closed when a suffix leaves it."""
    def nodes(rows: list[tuple]) -> list[list]:
        box, up, depth, top_w = rows[0][:4]
        # conv_id, depth, parent's place, n_convs, n_children, n_leaves, saved, ends, words
        found = [[rows[0][4], depth, None, 0, 0, 0, 0, None, top_w]]
        path, before = [0], []
        for *_, c, n, ids, words in rows:
            shared = 0
            for a, b in zip(before, ids):
                if a != b:
                    break
                shared += 1
            del path[shared + 1:]
            for i in range(shared, len(ids)):
                found[path[-1]][4] += 1
                found.append([c, depth + 1 + i, path[-1], 0, 0, 0, 0, None, words[i]])
                path.append(len(found) - 1)
            last = found[path[-1]]
            last[3] += n
            last[7], last[0], before = c, min(last[0], c), ids
        for node in reversed(found):  # children come after their parent
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * node[8]
            if node[2] is not None:
                above = found[node[2]]
                above[0], above[3], above[5], above[6] = min(above[0], node[0]), above[3] + node[3], above[5] + node[5], above[6] + node[6]
        return [[box, up, i == 0, x[0], x[1], None if i == 0 else found[x[2]][0], *x[3:8]] for i, x in enumerate(found)]

    def out(found: list[list]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 8]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], names=_COLUMNS)

    held: list[tuple] = []
    for batch in batches:
        found = []
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and held[0][0] != row[0]:
                found += nodes(held)
                held = []
            held.append(row)
        if found:
            yield out(found)
    if held:
        yield out(nodes(held))


def _chains(alone: DataFrame, bodies: DataFrame) -> DataFrame:
    """Nodes of containers of one long sequence: a node per turn, with the words from there on."""
    rows = bodies.join(alone.select("c", "n", "len", "box", "up", "depth", F.col("w").alias("top_w")), "c").where("pos > depth").withColumn("slice", F.expr(f"pos div {SLICE}"))
    sums = rows.groupBy("c", "slice").agg(F.sum("w").alias("s"))
    later = sums.select("c", "slice", (F.sum("s").over(Window.partitionBy("c").orderBy(F.desc("slice"))) - F.col("s")).alias("later"))
    inner = F.sum("w").over(Window.partitionBy("c", "slice").orderBy(F.desc("pos")))
    each = rows.withColumn("inner", inner).join(later, ["c", "slice"]).withColumn("rest", F.col("inner") + F.col("later"))
    below = each.select("box", "up", F.lit(False).alias("top"), F.col("c").alias("conv_id"), F.col("pos").alias("depth"), F.col("c").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                        (F.col("pos") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("rest")).alias("saved_tokens"),
                        F.when(F.col("pos") == F.col("len"), F.col("c")).alias("ends"))
    # The top stands above the first of them.
    top = each.where("pos = depth + 1").select(
        "box", "up", F.lit(True).alias("top"), F.col("c").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.lit(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * (F.col("rest") + F.col("top_w"))).alias("saved_tokens"), F.lit(None).cast("long").alias("ends"))
    return below.unionByName(top)


def _heads_over(tops: DataFrame, heads: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Nodes of all heads, from the deepest up, each from the tops and heads one turn below it. ``tops`` is a written table."""
    everything, level = tops, tops
    for depth in range(len(heads) - 1, -1, -1):
        own, ending = heads[depth]
        below = level.where(F.col("depth") == depth + 1).groupBy(F.col("up").alias("box")).agg(
            F.min("conv_id").alias("c1"), F.sum("n_convs").alias("n1"), F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("s1"))
        n_convs = F.col("n1") + F.coalesce("n", F.lit(0))
        level = staged(own.join(below, "box").join(ending, "box", "left").select(
            "box", "up", F.lit(True).alias("top"), F.least("c1", "c").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            n_convs.alias("n_convs"), "n_children", "n_leaves", (F.col("s1") + (n_convs - 1) * F.col("w")).alias("saved_tokens"), F.col("c").alias("ends")), "heads")
        everything = everything.unionByName(level)
        level = level.unionByName(tops.where(F.col("depth") <= depth))
    return everything


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, as ``op12`` has them.

    Turns are ordered by ``turn``, NULL first, equal ones by a hash of role and text; NULL roles and texts count as
    empty; repeated rows are turns of their own. Rows without a conversation are left out. c % 20 has the sign of c. A
    conversation left without turns ends at the root. An empty table gives no node; other columns are not read. The
    rounds of bursting are as many as turns are shared by all of a large container.
    """
    convs, turns = rebuilt(staged(placed_turns(conversations, conv, turn, role, text), "placed"))
    turns = staged(turns, "rebuilt")
    reps, members = sequences(convs, turns)
    bodies = staged(turns.join(reps.select("c"), "c", "left_semi"), "bodies")
    resting, heads = _burst(reps, bodies, limit)
    resting = staged(resting, "resting")
    boxes = resting.groupBy("box").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("len") - F.col("depth")).alias("turns"))
    long = staged(boxes.where((F.col("k") == 1) & (F.col("turns") > limit)).select("box"), "long")
    small = resting.join(long, "box", "left_anti")
    # At most ``limit`` turns a container come together.
    rest = bodies.join(small.select("c", "depth"), "c").where("pos > depth").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "w"))).alias("x"))
    suffix = lambda f: F.coalesce(F.transform("x", lambda t: t[f]), F.array())
    rows = small.join(rest, "c", "left").select("box", "up", "depth", "w", "c", "n", suffix("id").cast("array<binary>").alias("ids"), suffix("w").cast("array<long>").alias("words"))
    found = rows.repartition("box").sortWithinPartitions("box", "ids").mapInArrow(_sweep, _NODE)
    if not long.isEmpty():
        found = found.unionByName(_chains(resting.join(long, "box", "left_semi"), bodies))
    nodes = staged(found, "swept")
    tops = _heads_over(nodes.where("top"), heads)
    if heads:
        above = tops.select(F.col("box").alias("up"), F.col("conv_id").alias("above"))
        tops = tops.join(above, "up", "left").withColumn("parent_conv_id", F.col("above")).select(*_COLUMNS)
    every = staged(nodes.where("NOT top").unionByName(tops), "nodes")
    columns = [c for c in _COLUMNS if c not in ("box", "up", "top", "ends")]
    none = hashlib.sha256(b"").hexdigest()
    ended = every.where("ends IS NOT NULL").join(ends_hashes(members).withColumnRenamed("c", "ends"), "ends")
    return every.where("ends IS NULL").select(*columns, F.lit(none).alias("ends_sha256")).unionByName(ended.select(*columns, "ends_sha256"))
