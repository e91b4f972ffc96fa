import random
from itertools import combinations

from taxaflow.llm import stages
from taxaflow.llm.near_copies import near_copies
from taxaflow.llm.simhash import fingerprint

VOCAB = [f"w{i}" for i in range(400)]


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    return a == b or len(a & b) / len(a | b) >= 0.8


def slow_groups(rows):
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if similar(sets[i], sets[j]) and root[i] != root[j]:
            root = [root[i] if r == root[j] else r for r in root]
    return root


def corpus():
    """Families of copies with up to 5 words changed in 250, most of them with a tail of their own."""
    rng = random.Random(4)
    rows = []
    for g in range(10):
        base = rng.choices(VOCAB, k=rng.choice([6, 60, 250]))
        for i in range(12):
            w = list(base)
            for _ in range(rng.randrange(1 + len(base) // 50)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            rows.append((100 * g + i, " ".join(w + rng.choices(VOCAB, k=len(base) * (i % 4) // 24))))
    rng.shuffle(rows)
    return rows + [(5000, None), (5001, " \n"), (5002, "one"), (5003, "ONE")]


def test_stage_against_brute_force(spark):
    rows = corpus()
    groups = slow_groups(rows)
    far = [(s, t) for (_, s), (_, t) in combinations(rows, 2) if s and t and similar(grams(s), grams(t)) and (fingerprint(s) ^ fingerprint(t)).bit_count() > 4]
    assert len(far) > 20  # pairs that links of four bits do not reach
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    least = {g: min(d for (d, _), h in zip(rows, groups, strict=True) if h == g) for g in groups}
    assert sorted(r.doc_id for r in stages.drop_near_duplicates(frame).collect()) == sorted(least.values())
    assert len({r.root for r in near_copies(frame).collect()}) == len(least)


def test_alike_by_repeats_only(spark):
    line = " ".join(VOCAB[:7]) + " "
    rows = [(1, line * 300 + " ".join(VOCAB[100:150])), (2, line * 300 + " ".join(VOCAB[200:250]))]
    assert fingerprint(rows[0][1]) == fingerprint(rows[1][1])
    assert stages.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2


def test_rows_without_id(spark):
    rng = random.Random(8)
    base = rng.choices(VOCAB, k=100)
    rows = [(None, " ".join(base)), (None, " ".join([*base[:-1], "end"])), (None, " ".join(rng.choices(VOCAB, k=100)))]
    kept = stages.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 2
    assert stages.drop_near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_copies_cost_few_pairs(spark, monkeypatch):
    """Long copies are compared by samples: of n of them few more than n - 1 pairs are verified (some bands part them), and all links are found where some are refused."""
    from taxaflow.llm import near_copies as N

    rng = random.Random(5)
    wide = [f"v{i}" for i in range(4000)]
    base = rng.choices(wide, k=900)
    copies = [list(base) for _ in range(40)]
    for i, w in enumerate(copies):
        w[20 * i + 5] = "x"
    edge = [base[: 900 - 14 * i] + rng.choices(wide, k=14 * i) for i in range(1, 12)]  # similarities around the limit
    seen, verified = [], N._verified
    monkeypatch.setattr(N, "_verified", lambda pairs, *more: seen.append(pairs.count()) or verified(pairs, *more))
    for words, most in ((copies, 2 * 39), (copies[:8] + edge, 19 * 18 // 2)):
        seen.clear()
        rows = [(i, " ".join(w)) for i, w in enumerate(words)]
        found = near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        groups = slow_groups(rows)
        assert len({(r.root, groups[r.doc_id]) for r in found}) == len(set(groups)) == len({r.root for r in found})
        assert 0 < sum(seen) <= most
