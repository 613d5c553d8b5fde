import random

import pytest
from pyspark.sql import functions as F

from folioscope.operators import paths
from folioscope.sources.commands import parse_commands, read_commands

NODE, CREATE, DELETE, MOVE = ("ns string, path string, node_type string", "ns string, seq long, path string, node_type string",
                              "ns string, seq long, path string", "ns string, seq long, source string, target string")


def clean(path):
    parts = [p for p in path.split("/") if p]
    return "".join("/" + p for p in parts)


def parent(path):
    return path.rsplit("/", 1)[0]


class Tree:
    """One namespace, changed one command at a time."""

    def __init__(self, nodes=()):
        self.kind = {"": "d", **dict(nodes)}

    def create(self, path, kind):
        p = clean(path)
        if not p or p in self.kind or self.kind.get(parent(p)) != "d":
            return False
        self.kind[p] = kind
        return True

    def delete(self, path):
        p = clean(path)
        if not p or p not in self.kind or any(parent(q) == p for q in self.kind if q):
            return False
        del self.kind[p]
        return True


def nodes_of(spark, tree, ns="n"):
    return spark.createDataFrame([(ns, p, k) for p, k in tree.items() if p], NODE)


def result(df, name="ok"):
    return {r["seq"]: r[name] for r in df.collect()}


def replay(spark, script):
    """Outcomes of a command script, evaluated in batches of equal commands."""
    lines = spark.createDataFrame(list(enumerate(script)), "seq long, value string")
    commands = parse_commands(lines.withColumn("ns", F.lit("n"))).orderBy("seq").collect()
    nodes, out, i = spark.createDataFrame([], NODE), [], 0
    while i < len(commands):
        op, batch = commands[i].op, []
        while i < len(commands) and commands[i].op == op:
            batch.append(commands[i])
            i += 1
        rows = [("n", c.seq, c.arg1, c.arg2) for c in batch]
        if op == "l":
            found = paths.lookup(nodes, spark.createDataFrame([r[:3] for r in rows], DELETE))
            out += [v for _, v in sorted(result(found, "found").items())]
            continue
        if op == "c":
            done, made = paths.bulk_create(nodes, spark.createDataFrame(rows, CREATE))
            nodes = nodes.unionByName(made)
        elif op == "d":
            done, nodes = paths.bulk_delete(nodes, spark.createDataFrame([r[:3] for r in rows], DELETE))
        else:
            done, nodes = paths.bulk_move(nodes, spark.createDataFrame(rows, MOVE))
            done = done.withColumn("ok", F.col("outcome") == "ok")
        out += [v for _, v in sorted(result(done).items())]
        nodes = spark.createDataFrame(nodes.collect(), NODE)
    return out


@pytest.mark.parametrize("script, expected", [
    (["c /file1 f", "c /dir1 d", "l /file1", "l /dir1", "l /nonexistent"], [1, 1, 1, 1, 0]),
    (["c /dir1 d", "c /dir1/dir2 d", "c /dir1/dir2/file1 f", "l /dir1/dir2/file1"], [1, 1, 1, 1]),
    (["c /dir1 d", "c /dir1/file1 f", "d /dir1/file1", "l /dir1/file1", "d /dir1", "l /dir1"], [1, 1, 1, 0, 1, 0]),
    (["c /dir1 d", "c /dir2 d", "c /dir1/file1 f", "l /dir1/file1", "m /dir1/file1 /dir2/file1", "l /dir1/file1", "l /dir2/file1"],
     [1, 1, 1, 1, 1, 0, 1]),
    (["c /nonexistent/file1 f", "d /nonexistent", "l /nonexistent", "c /file1 f", "c /file1 f"], [0, 0, 0, 1, 0]),
    (["c /race/contested f", "c /race d"] + ["c /race/contested f"] * 4 + ["l /race/contested"], [0, 1, 1, 0, 0, 0, 1]),
])
def test_scenarios(spark, script, expected):
    assert replay(spark, script) == [bool(x) for x in expected]


def test_split_and_normalize(spark):
    df = spark.createDataFrame([("/a/b",), ("a",), ("//a//b/",), ("/",), ("",)], "path string")
    assert [tuple(r[1:]) for r in paths.split_path(df).collect()] == [("/a", "b"), ("", "a"), ("/a", "b"), ("", ""), ("", "")]


def test_lookup_root_and_types(spark):
    nodes = nodes_of(spark, {"/d": "d", "/d/f": "f"})
    asked = spark.createDataFrame([("n", 1, ""), ("n", 2, "/"), ("n", 3, "d//f/"), ("n", 4, "/d/f/x"), ("m", 5, "/d")], DELETE)
    assert {r.seq: (r.found, r.node_type) for r in paths.lookup(nodes, asked).collect()} == {
        1: (True, "d"), 2: (True, "d"), 3: (True, "f"), 4: (False, None), 5: (False, None)}


def test_listing_is_pre_order(spark):
    nodes = nodes_of(spark, {"/b": "d", "/b/x": "f", "/b-c": "f", "/a": "f", "/b/x2": "f"})
    assert [r.path for r in paths.list_subtree(nodes).collect()] == ["", "/a", "/b", "/b/x", "/b/x2", "/b-c"]
    assert [r.path for r in paths.list_subtree(nodes, "/b/").collect()] == ["/b", "/b/x", "/b/x2"]


def test_emptiness_capacity_violations(spark):
    nodes = nodes_of(spark, {"/a": "d", "/b": "d", "/b/x": "f", "/long-name": "f"})
    assert {r.path: r.is_empty for r in paths.directory_emptiness(nodes).collect()} == {"/a": True, "/b": False}
    report = {(r.kind, r.path, r["size"]) for r in paths.capacity_report(nodes, 2, 4, 8).collect()}
    assert report == {("entries", "", 3), ("nodes", "", 5), ("name", "/long-name", 9)}
    bad = nodes_of(spark, {"/f": "f", "/f/x": "f", "/q/y": "f"}).unionByName(nodes_of(spark, {"/f": "f"}))
    assert {(r.path, r.reason) for r in paths.tree_violations(bad).collect()} == {
        ("/f", "duplicate"), ("/f/x", "no_parent_directory"), ("/q/y", "no_parent_directory")}


def random_paths(rng, n):
    return ["/" + "/".join(rng.choice("ab") for _ in range(rng.randint(0, 4))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_create_and_delete_match_one_by_one(spark, seed):
    rng = random.Random(seed)
    stored = {"/a": "d", "/a/b": "f", "/b": rng.choice("df")}
    requests = [("n", i * 3, p, rng.choice("ddf")) for i, p in enumerate(random_paths(rng, 60))]
    rng.shuffle(requests)
    done, made = paths.bulk_create(nodes_of(spark, stored), spark.createDataFrame(requests, CREATE))
    tree = Tree(stored)
    assert result(done) == {s: tree.create(p, k) for _, s, p, k in sorted(requests, key=lambda r: r[1])}
    assert {r.path: r.node_type for r in made.collect()} == {p: k for p, k in tree.kind.items() if p and p not in stored}

    gone = [("n", i, p) for i, p in enumerate(random_paths(rng, 120))]
    full = dict(tree.kind)
    done, left = paths.bulk_delete(nodes_of(spark, full), spark.createDataFrame(gone, DELETE))
    tree = Tree(full)
    assert result(done) == {s: tree.delete(p) for _, s, p in gone}
    assert {r.path: r.node_type for r in left.collect()} == {p: k for p, k in tree.kind.items() if p}


def test_move_outcomes(spark):
    tree = {"/a": "d", "/a/x": "d", "/a/x/f": "f", "/b": "d", "/f": "f", "/ab": "f"}
    requests = [("n", 1, "/a/x", "/b/y"), ("n", 2, "/a", "/c"), ("n", 3, "/b/y/f", "/z"), ("n", 4, "/f", "/g/h"), ("n", 5, "/none", "/q"),
                ("n", 6, "/ab", "/ab/in"), ("n", 7, "/", "/r"), ("n", 8, "/ab", "/b2"), ("m", 1, "/a", "/c")]
    done, after = paths.bulk_move(nodes_of(spark, tree), spark.createDataFrame(requests, MOVE))
    assert {(r.ns, r.seq): r.outcome for r in done.collect()} == {
        ("n", 1): "ok", ("n", 2): "deferred", ("n", 3): "deferred", ("n", 4): "failed", ("n", 5): "failed", ("n", 6): "failed",
        ("n", 7): "failed", ("n", 8): "ok", ("m", 1): "failed"}
    assert {r.path for r in after.collect()} == {"/a", "/b", "/b/y", "/b/y/f", "/f", "/b2"}


@pytest.mark.parametrize("source, target, outcome", [
    ("/d/f", "/d/g", "ok"), ("/d", "/e", "ok"), ("/d/f", "/x", "failed"), ("/d/f", "/no/x", "failed"), ("/d/f", "/x/y", "failed"),
    ("/d", "/d/sub/y", "failed"), ("/d", "/d", "failed"), ("/d/", "//e", "ok")])
def test_single_moves(spark, source, target, outcome):
    nodes = nodes_of(spark, {"/d": "d", "/d/f": "f", "/d/sub": "d", "/x": "f"})
    done, _ = paths.bulk_move(nodes, spark.createDataFrame([("n", 1, source, target)], MOVE))
    assert done.first().outcome == outcome


def test_command_log(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# note\n\nc /a f\nc /b x\nl /a\nl\nm /a\n  d   /a  \np out.txt\nz /q\nc /d directory\n" + "l /pad\n" * 2000)
    rows = read_commands(spark, str(tmp_path), ns="n").orderBy("seq").collect()
    assert [(r.op, r.arg1, r.arg2, r.error) for r in rows[:9]] == [
        ("c", "/a", "f", None), ("c", "/b", "x", "invalid_node_type"), ("l", "/a", None, None), ("l", None, None, "wrong_arguments"),
        ("m", "/a", None, "wrong_arguments"), ("d", "/a", None, None), ("p", "out.txt", None, None), ("z", "/q", None, "unknown_command"),
        ("c", "/d", "d", None)]
    assert len(rows) == 2009 and len({r.seq for r in rows}) == 2009


def test_command_order_over_splits(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"l /{i}\n" for i in range(60_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        commands = read_commands(spark, str(tmp_path))
        assert commands.rdd.getNumPartitions() > 3
        assert [r.arg1 for r in commands.orderBy("ns", "seq").collect()] == [f"/{i}" for i in range(60_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
