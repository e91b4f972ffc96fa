"""Trees in Newick files as rows of nodes with the interval of their tips; pruned to kept features and written again."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaflow.session import checkpointed

NODES = "node int, parent int, label string, length double, first int, last int, tip boolean"
BLOCK = 10_000  # tips whose running counts are made side by side
_TOKENS = re.compile(r"\[[^\]]*\]|'(?:[^']|'')*'|[(),:;]|[^\s(),:;\[']+")


def parse_newick(text: str) -> list[tuple]:
    """(node, parent, label, length, first, last, tip) of a tree's nodes, parents before children; first and last number the
    tips below a node from 0 on. Labels may be quoted, comments in brackets are skipped; what follows the semicolon is not read."""
    nodes: list[list] = [[0, None, None, None, None, None, True]]
    at, tips, expect = 0, 0, "label"

    def close(i: int) -> None:
        nonlocal tips
        if nodes[i][6]:
            nodes[i][4] = tips
            tips += 1
        nodes[i][5] = tips - 1

    for token in _TOKENS.findall(text):
        if token[0] == "[":
            continue
        if token in "(,":
            if token == "(":
                nodes[at][4], nodes[at][6], parent = tips, False, at
            else:
                close(at)
                parent = nodes[at][1]
            if parent is None:
                raise ValueError("a comma outside all brackets")
            at = len(nodes)
            nodes.append([at, parent, None, None, None, None, True])
            expect = "label"
        elif token == ")":
            close(at)
            at = nodes[at][1]
            if at is None:
                raise ValueError("a bracket too many is closed")
            expect = "label"
        elif token == ":":
            expect = "length"
        elif token == ";":
            break
        elif expect == "length":
            nodes[at][3] = float(token)
        else:
            nodes[at][2] = token[1:-1].replace("''", "'") if token[0] == "'" else token
    if at:
        raise ValueError("a bracket is not closed")
    close(0)
    return [tuple(n) for n in nodes]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [c.split() for c in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def read_newick(spark: SparkSession, path: str) -> DataFrame:
    """node, parent (null: the root), label, length, first, last, tip of the tree in a file."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch["value"]:
                rows = parse_newick(text.as_py())
                for i in range(0, len(rows), 10_000):
                    yield _batch(rows[i : i + 10_000])

    return spark.read.text(path, wholetext=True).mapInArrow(parse, NODES)


def pruned(tree: DataFrame, kept: DataFrame) -> DataFrame:
    """The tree of the tips whose label is a feature_id of ``kept``: branches without one go, and nodes with one branch left are
    taken out, their lengths added. Node numbers stay; tips are numbered anew."""
    tree = checkpointed(tree)
    names = kept.select(F.col("feature_id").cast("string").alias("label")).distinct().withColumn("kept", F.lit(1))
    tips = tree.where("tip").join(names, "label", "left").select("first", F.coalesce("kept", F.lit(0)).alias("kept"), F.floor(F.col("first") / BLOCK).alias("block"))
    sums = tips.groupBy("block").agg(F.sum("kept").alias("n"))
    before = sums.select("block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a block
    running = tips.withColumn("upto", F.sum("kept").over(Window.partitionBy("block").orderBy("first"))).join(before, "block")
    running = checkpointed(running.select(F.col("first").alias("place"), "kept", (F.col("upto") + F.col("before")).alias("upto")))
    low = running.select(F.col("place").alias("first"), (F.col("upto") - F.col("kept")).alias("low"))
    high = running.select(F.col("place").alias("last"), F.col("upto").alias("high"))
    alive = checkpointed(tree.join(low, "first").join(high, "last").where("high > low").select("node", "parent", "label", "length", F.col("low").cast("int").alias("first"), (F.col("high") - 1).cast("int").alias("last"), "tip"))
    children = alive.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    single = alive.where("NOT tip").join(children.where("children = 1"), "node", "left_semi")
    # up: the first node above that stays, length: of the branches to it. Doubling shortens chains of single nodes.
    jumps = checkpointed(single.select("node", F.col("parent").alias("up"), F.coalesce("length", F.lit(0.0)).alias("length")))
    while True:
        next_ = jumps.select(F.col("node").alias("up"), F.col("up").alias("far"), F.col("length").alias("more"), F.lit(True).alias("again"))
        longer = checkpointed(jumps.join(next_, "up", "left").select("node", F.when(F.col("again"), F.col("far")).otherwise(F.col("up")).alias("up"), (F.col("length") + F.coalesce("more", F.lit(0.0))).alias("length"), "again"))
        jumps = longer.drop("again")
        if longer.where("again").isEmpty():
            break
    over = jumps.select(F.col("node").alias("parent"), "up", F.col("length").alias("more"), F.lit(True).alias("over"))
    stay = alive.join(jumps.select("node"), "node", "left_anti").join(over, "parent", "left")
    parent = F.when(F.col("over"), F.col("up")).otherwise(F.col("parent"))
    length = F.when(F.col("over"), F.coalesce("length", F.lit(0.0)) + F.col("more")).otherwise(F.col("length"))
    return stay.select("node", parent.alias("parent"), "label", F.when(parent.isNotNull(), length).alias("length"), "first", "last", "tip")


def write_newick(tree: DataFrame, path: str) -> None:
    """The tree as one line of text, children in the order of their tips; one task writes it, as such a file is one expression."""

    def text(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["first"], -r["last"], r["tip"]))
        below: dict = {}
        for r in rows:
            below.setdefault(r["parent"], []).append(r)
        out, todo = [], [("", below.get(None, [None])[0])] if rows else []
        while todo:
            lead, r = todo.pop()
            out.append(lead)
            if r is None:
                continue
            label = r["label"] or ""
            label = "'" + label.replace("'", "''") + "'" if re.search(r"[\s(),:;\[\]']", label) else label
            end = label + ("" if r["length"] is None else f":{r['length']!r}")
            own = below.get(r["node"], [])
            if own:
                todo.append((")" + end, None))
                todo += [("," if i else "(", c) for i, c in reversed(list(enumerate(own)))]
            else:
                out.append(end)
        return pa.table({"value": ["".join(out) + ";"]})

    tree.withColumn("whole", F.lit(True)).groupBy("whole").applyInArrow(text, "value string").write.text(path)
