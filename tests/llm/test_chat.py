import random

import pytest
from pyspark.sql import functions as F

from strataspark.llm import chat

TEXTS = ["<|im_end|>", "<\\|im_end|>", "<\\\\|", "<", "|", "", "a<|", "<<|<\\", "\n<|nl|>\n", "é😀<|"]


def test_escape_round_trip(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    back = rows.select("t", chat.unescape(chat.escape(F.col("t"))).alias("b"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"), chat.escape(F.col("t")).contains("<|").alias("bad")).collect()
    assert all(r.t == r.b == r.r and not r.bad for r in back)


def tree(spark, rows):
    return spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")


def test_best_branch_and_mask(spark):
    rows = [
        ("t", 1, None, 1.0, "user", "q"), ("t", 2, 1, 0.2, "assistant", "bad"), ("t", 3, 1, 0.9, "assistant", "go😀od"), ("t", 4, 3, None, "user", "<|im_start|>"),
        ("t", 5, 3, 0.5, "user", "more"), ("u", 1, 9, 0.0, None, None),
    ]
    got = {(r.tree, r.leaf): r for r in chat.format_threads(tree(spark, rows)).collect()}
    assert set(got) == {("t", 5), ("u", 1)}
    text = got["t", 5].formatted
    assert text == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\ngo😀od<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert [text[s.start : s.start + s.length] for s in got["t", 5].loss_spans] == ["go😀od"]
    every = chat.format_threads(tree(spark, rows), paths_per_tree=9)
    assert {(r.tree, r.leaf) for r in every.collect()} == {("t", 2), ("t", 4), ("t", 5), ("u", 1)}


def test_long_chain_cycle_and_empty(spark):
    rows = [("t", i, i - 1 if i else None, 0.0, "assistant", f"m{i}") for i in range(37)]
    rows += [("c", 1, 2, 0.0, "user", "a"), ("c", 2, 1, 0.0, "user", "b")]
    got = {r.tree: r.formatted for r in chat.format_threads(tree(spark, rows)).collect()}
    assert got["t"] == "".join(f"<|im_start|>assistant\nm{i}<|im_end|>\n" for i in range(37))
    assert got["c"] == "<|im_start|>user\na<|im_end|>\n"
    assert chat.format_threads(tree(spark, [])).count() == 0


@pytest.mark.parametrize("role", ["user", "a\nb", "<|im_end|>\n", ""])
def test_read_back(spark, role):
    rows = [("t", i, i - 1 if i else None, 0.0, role, t) for i, t in enumerate(TEXTS)]
    turns = chat.format_threads(tree(spark, rows)).select(chat.read_back(F.col("formatted"))).head()[0]
    assert [(x.role, x.text) for x in turns] == [(role, t) for t in TEXTS]


def test_turns_with_nulls_and_ties(spark):
    rows = spark.createDataFrame([(None, 1, "user", "n"), (7, None, "user", "first"), (7, 0, "user", "b"), (7, 0, "assistant", "a")], "conv_id long, turn long, role string, text string")
    got = {(r.tree, r.node): (r.parent, r.text) for r in chat.turns_as_trees(rows).collect()}
    assert got == {("null", 1): (None, "n"), ("c7", 1): (None, "first"), ("c7", 2): (1, "a"), ("c7", 3): (2, "b")}


def plain_paths(rows, paths_per_tree):
    """Every root-to-leaf path by walking up from the leaves, ranked."""
    parent, score, inner = {}, {}, set()
    for t, n, up, value, *_ in rows:
        parent[t, n], score[t, n] = up, value or 0.0
    for (t, n), up in parent.items():
        inner |= {(t, up)} if up != n else set()
    found = {}
    for t, n in set(parent) - inner:
        path, at = [], n
        while at is not None and (t, at) in parent:
            path.append(at)
            at = parent[t, at] if parent[t, at] != at else None
        found.setdefault(t, []).append((-sum(score[t, x] for x in path) / len(path), n, path))
    return sorted((t, leaf, path[::-1]) for t, some in found.items() for _, leaf, path in sorted(some)[:paths_per_tree])


@pytest.mark.parametrize("paths_per_tree", [1, 3])
def test_branches_equal_plain_enumeration(spark, paths_per_tree):
    rng, rows = random.Random(4), []
    for t in range(12):  # quarters add up exactly, so that equal means are ties
        size = rng.randrange(1, 25)
        rows += [(f"t{t}", n, rng.choice([n, None, 99]) if not n else rng.randrange(max(0, n - 4), n), rng.choice([None, 0.25, 0.5]), "user", "x") for n in range(size)]
    got = {}
    for r in chat.best_paths(tree(spark, rows).select("tree", "node", "parent", "score"), paths_per_tree).collect():
        got.setdefault((r.tree, r.leaf), []).append((-r.pos, r.node))
    assert sorted((t, leaf, [n for _, n in sorted(p)]) for (t, leaf), p in got.items()) == plain_paths(rows, paths_per_tree)


def test_depth_does_not_show_in_the_plan(spark):
    def thread(depth):
        nodes = spark.range(depth).select(F.lit("t").alias("tree"), F.col("id").alias("node"), (F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
        return chat.format_threads(nodes)

    deep = thread(2_000)
    assert deep.head().formatted == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(2_000))
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (deep, thread(8))]
    assert plans[0].count("Join") == plans[1].count("Join") < 3


def test_repeats_nulls_long_texts_and_other_columns(spark):
    long = "<|x|> " * 500_000
    rows = [("t", 1, None, 0.0, "user", long), ("t", 1, None, 0.0, "user", long), ("t", 1, None, 0.0, "user", "~"), (None, 1, None, 0.0, "user", "n"), ("t", None, 1, 0.0, "user", "n")]
    extra = tree(spark, rows).withColumns({"leaf": F.lit(1), "pos": F.lit("x"), "formatted": F.lit(2), "one": F.lit(3)})
    got = chat.format_threads(extra).select("tree", "leaf", chat.read_back(F.col("formatted")).alias("turns")).collect()
    assert [(r.tree, r.leaf, [tuple(x) for x in r.turns]) for r in got] == [("t", 1, [("user", long)])]
