import random
from itertools import combinations

import numpy as np
import xxhash

from taxaflow.llm import simhash
from taxaflow.llm.components import connected_components
from taxaflow.llm.simhash import bucket_keys, fingerprint, forest, near_duplicates


def slow_print(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ")
    w = [x for x in w.replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def slow_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def test_keys_meet_for_every_four_bits():
    rng = random.Random(5)
    base = np.array([rng.getrandbits(64) for _ in range(1500)], np.uint64)
    masks = [sum(1 << p for p in rng.sample(range(64), k)) for k in (1, 2, 3, 4) for _ in range(375)]
    other = base ^ np.array(masks, np.uint64)
    of = [dict() for _ in range(2)]
    for side, prints in enumerate((base, other)):
        for r, k in zip(*bucket_keys(prints), strict=True):
            of[side].setdefault(int(r), set()).add(int(k))
        assert max(map(len, of[side].values())) <= 33
    assert all(of[0][i] & of[1][i] for i in range(1500))


def test_forest_connects():
    rng = random.Random(2)
    c = rng.getrandbits(64)
    m = np.array(list({c ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 6))) for _ in range(300)}), np.uint64)
    roots = slow_components(list(range(len(m))), [int(x) for x in m])
    got = {i: {i} for i in range(len(m))}
    for i, j in forest(m, 4):
        if got[i] is not got[j]:
            got[i] |= got[j]
            for x in got[j]:
                got[x] = got[i]
    assert [min(got[i]) for i in range(len(m))] == roots


def corpus():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for g in range(12):
        base = rng.choices(vocab, k=rng.choice([3, 30, 300]))
        for _ in range(rng.choice([1, 3, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            docs.append(" ".join(w).title() if g % 2 else "\n".join(w))
    docs += ["", None, " \t\n", "one", "ONE", "É é", "x " * 30_000]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_against_brute_force(spark, monkeypatch):
    docs = corpus() + [(3, "one")]
    prints = [slow_print(t) for _, t in docs]
    assert [fingerprint(t or "") for _, t in docs] == prints
    want = sorted((d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, slow_components([d for d, _ in docs], prints), strict=True))
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, fp string, key int")
    assert sorted(map(tuple, near_duplicates(frame).drop("text_hash").collect())) == want
    monkeypatch.setattr(simhash, "CELL", 3)  # buckets of more are split
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 2)
    assert sorted(map(tuple, near_duplicates(frame).drop("text_hash").collect())) == want


def test_edges(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = near_duplicates(spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(None, None)] * 2


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i * 7 % 101, (i + 1) * 7 % 101) for i in range(100)] + [(200, 201), (5, 5)], "x long, y long")
    got = dict(map(tuple, connected_components(path, "x", "y").collect()))
    assert got == dict.fromkeys(range(101), 0) | {200: 200, 201: 200}
