import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.llm.decontaminate import contaminated, find_contamination
from taxaflow.llm.fm_index import FMIndex, suffix_order

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for p, owners in wins.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found |= owners
        out.append((doc_id, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_suffix_order_and_search():
    rng = np.random.default_rng(1)
    for sigma in (1, 2, 5):
        runs = [rng.integers(1, sigma + 1, rng.integers(1, 40)) for _ in range(12)]
        runs += runs[:3]
        text = np.concatenate([np.r_[r, 0] for r in runs])
        gaps = int((text == 0).sum())
        keyed = text + gaps
        keyed[text == 0] = np.arange(gaps)
        assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: keyed[i:].tolist())
        index = FMIndex(text, sigma)
        phrases = np.zeros((20, 4), np.int64)
        lengths = rng.integers(1, 5, 20)
        for row, n in zip(phrases, lengths, strict=True):
            row[4 - n :] = rng.integers(1, sigma + 1, n)
        got = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(*index.search(phrases, lengths), strict=True)}
        for k, (row, n) in enumerate(zip(phrases, lengths, strict=True)):
            want = [i for i in range(len(text) - n + 1) if text[i : i + n].tolist() == row[4 - n :].tolist()]
            assert got.get(k, []) == want


def corpus():
    rng = random.Random(3)
    vocab = ["a", "b", "Éa", "x1", "c", "d", "zz"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 3, 12, 13, 14, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (None, "null named item here"), (90, None), (91, "...")]
    docs = []
    for i in range(80):
        parts = [" ".join(rng.choices([*vocab, "Other,", "more"], k=rng.choice([0, 1, 5, 40]))) for _ in range(3)]
        parts.insert(1, (rng.choice(items)[1] or "").upper().replace("É", "É").replace(" ", rng.choice([" ", ", ", "\n"])))
        docs.append((i, " ".join(parts)))
    docs += [(None, "x"), (7, docs[7][1]), (200, None), (201, ""), (202, "word " * 30_000 + (items[5][1] or "b"))]
    return docs, items


@pytest.mark.parametrize("block", [4_000_000, 200])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr("taxaflow.llm.decontaminate.BLOCK_BYTES", block)
    docs, items = corpus()
    d = spark.createDataFrame([(a, b, 1, "q") for a, b in docs], "doc_id long, text string, n_hit int, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(d, b).withColumn("contaminated", contaminated(F.col("n_words"), F.col("n_hit"))).collect()
    got = sorted([(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in found], key=repr)
    assert got == brute(docs, items)
    texts = {a: t for a, t in docs}
    for r in found:
        assert sum(len(words(texts[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(d, b).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert find_contamination(one, b).first().n_hit == 0
