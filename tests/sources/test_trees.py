"""Newick trees against nested lists that plain recursion makes and prunes."""

import random

import pytest

from taxaflow.sources import sinks, trees
from taxaflow.sources.trees import parse_newick, pruned, read_newick, write_newick


def grown(rng, n, names):
    """(label, length, children) with n tips."""
    if n == 1:
        return (names.pop(), rng.choice([None, rng.randrange(1, 90) / 8]), [])
    k = min(n, rng.choice([1, 2, 2, 3]))
    cuts = sorted(rng.sample(range(1, n), k - 1))
    sizes = [b - a for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
    return (rng.choice(["", "inner"]), rng.randrange(1, 90) / 8, [grown(rng, s, names) for s in sizes])


def text_of(tree):
    label, length, children = tree
    label = "'" + label.replace("'", "''") + "'" if any(c in label for c in " '(") else label
    return ("(" + ",".join(map(text_of, children)) + ")" if children else "") + label + ("" if length is None else f":{length}")


def slow_pruned(tree, kept):
    label, length, children = tree
    if not children:
        return tree if label in kept else None
    own = [c for c in (slow_pruned(c, kept) for c in children) if c]
    if not own:
        return None
    if len(own) == 1:
        return (own[0][0], (length or 0) + (own[0][1] or 0), own[0][2])
    return (label, length, own)


def nested(rows):
    below, top = {}, None
    for r in sorted(rows, key=lambda r: (r.first, r.last)):
        below.setdefault(r.parent, []).append(r)
        top = r if r.parent is None else top

    def go(r):
        return (r.label or "", r.length, [go(c) for c in below.get(r.node, [])])

    return go(top) if top else None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK", 7)
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(38)] + ["with space", "it's"]
    rng.shuffle(names)
    tree = grown(rng, 40, list(names))
    (tmp_path / "a.nwk").write_text(f"[a comment]\n {text_of(tree)};\nmore")
    rows = read_newick(spark, str(tmp_path / "a.nwk"))
    found = rows.collect()
    assert nested(found)[2] == tree[2]
    tips = sorted((r.first, r.label) for r in found if r.tip)
    assert [i for i, _ in tips] == list(range(40)) and all(r.first <= r.last for r in found)
    kept = set(rng.sample(names, 13))
    frame = spark.createDataFrame([(n,) for n in [*kept, "none"]], "feature_id string")
    got = pruned(rows, frame)
    want = slow_pruned(tree, kept)
    assert nested(got.collect())[2] == want[2]
    assert {r.label for r in got.where("tip").collect()} == kept
    write_newick(got, str(tmp_path / "out"))
    (line,) = spark.read.text(str(tmp_path / "out")).collect()
    again = parse_newick(line.value)
    assert sorted(str(n[2]) for n in again if n[6]) == sorted(kept)
    assert text_of((want[0], None, want[2])) + ";" == line.value


def test_odd_trees(spark, tmp_path):
    assert parse_newick("A;") == [(0, None, "A", None, 0, 0, True)]
    assert [n[2:4] for n in parse_newick("(a:1,b:2e-1)r:3;")] == [("r", 3.0), ("a", 1.0), ("b", 0.2)]
    for bad in ("(a,b;", "a,b;", "a);"):
        with pytest.raises(ValueError):
            parse_newick(bad)
    deep = "(" * 5000 + "x" + ")" * 5000 + ";"
    assert len(parse_newick(deep)) == 5001
    (tmp_path / "d.nwk").write_text("((((a:1):2,(b:1,c:1):1):1):5,d:1);")
    rows = read_newick(spark, str(tmp_path / "d.nwk"))
    kept = spark.createDataFrame([("a",)], "feature_id string")
    assert [(r.label, r.parent, r.length) for r in pruned(rows, kept).collect()] == [("a", None, None)]
    assert pruned(rows, kept.limit(0)).count() == 0
    counts = spark.createDataFrame([("a", "s", 1), ("c", "s", 1)], "feature_id string, sample_id string, count long")
    tax = spark.createDataFrame([("a", ["B"] + ["?"] * 6)], "feature_id string, ranks array<string>")
    sinks.write_bundle(counts, tax, counts.select("sample_id").distinct(), f"{tmp_path}/bundle", tree=rows)
    assert spark.read.text(f"{tmp_path}/bundle/newick").first().value == "(a:3.0,c:2.0);"
    assert spark.read.parquet(f"{tmp_path}/bundle/tree").count() == 3
