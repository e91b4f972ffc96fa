"""Registered queries of the training-data operators on small written tables, all columns, against slow versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import corpus_pipeline
from taxaflow.llm import quality, stages
from taxaflow.llm.queries import QUERIES

VOCAB = [a + b for a in ("mo", "Ta", "ri", "ke", "su", "né") for b in ("lan", "ber", "tio", "sch", "ven", "qu")]
ITEMS = [(i, " ".join(random.Random(100 + i).choices(VOCAB, k=30))) for i in range(4)] + [(9, "Zwei worte"), (10, "")]


def documents():
    rng = random.Random(6)
    rows = []
    for i in range(120):
        kind, n = i % 8, rng.randrange(1, 120)
        text = " ".join(rng.choices(VOCAB, k=n)) + rng.choice(["", ".", "!\n", "  end"])
        if kind == 1:
            text = text.upper()
        if kind == 2:
            text += " " + ITEMS[i % 4][1] + "; " + " ".join(rng.choices(VOCAB, k=40))
        if kind == 3:
            text = (rng.choice(VOCAB) + " ") * n
        rows.append((i * 7 % 120, text))
    rows += [(200, rows[5][1]), (201, rows[5][1].upper()), (202, rows[5][1] + " tail"), (203, None), (204, ""), (205, " \n"), (206, "eins zwei worte drei"), (207, "wort " * 3000), (208, "é" * 2000)]
    rows += [(300 + i, "the same copy of all " * 9) for i in range(40)]
    rng.shuffle(rows)
    return rows


DOCS = documents()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "web", len(t or ""), "clash") for i, t in DOCS], "doc_id long, text string, lang string, source string, n_chars long, ids string").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, int(t is not None and t.count(t.split(" ")[0]) < 6), 0) for i, t in DOCS if t and i < 110]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    pages = [(i, f"https://h{i % 3}.org/{i}", f"<body><nav><a href=/>Home</a></nav><div class=ad>Buy {i}</div><article><h1>T{i} &amp; co</h1><p>one\n two {i}<p>three</article><footer>&copy; {i}</footer></body>") for i in range(12)]
    spark.createDataFrame([*pages, (50, None, None)], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


@pytest.fixture
def result(spark, folder):
    return lambda name: QUERIES[name](spark, folder).collect()


def ids_crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(result):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got, at = {r.doc_id: r for r in result("op1_token_frames")}, 0
    for doc_id, text in sorted(DOCS):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(got[doc_id]) == (doc_id, at, len(ids), ids_crc(ids))
        at += len(ids)
    assert len(got) == len(DOCS)


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        able = [r for r in rooms if r >= n]
        if able:
            rooms.remove(min(able))
            rooms.append(min(able) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_op2(result):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in result("op2_best_fit_packing"):
        pieces[r.doc_id].append(r)
    sequences = defaultdict(list)
    for doc_id, text in DOCS:
        ids, own = [*t.encode(text or "", add_special_tokens=False).ids, 2], sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == ids_crc(ids[r.start : r.start + r.length])
            sequences[r.sequence_id].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 1024
    assert len(sequences) == best_fit([r.length for own in sequences.values() for r in own], 1024)


def test_op4(result):
    rows = result("op4_histogram_sharding")
    of = dict(DOCS)
    total = sum(r.size for r in rows)
    for r in rows:
        data = (of[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
    assert sorted(r.doc_id for r in rows) == sorted(of)
    # Shards are runs of the rows in order of (hash of the text, doc_id): prefix sums end near equal shares.
    order = sorted(rows, key=lambda r: (np.uint64(xxhash.xxh64_intdigest((of[r.doc_id] or "").encode(), 42)).astype(np.int64), r.doc_id))
    assert [r.shard for r in order] == sorted(r.shard for r in rows)
    at, shard = 0, 0
    for i, r in enumerate(order):
        if r.shard != shard:
            edge = r.shard * total / 40
            assert min(abs(at - edge), abs(at + r.size - edge), abs(at - order[i - 1].size - edge)) <= abs(at - edge) + 1e-9
            assert abs(at - edge) <= max(r.size, order[i - 1].size)
            shard = r.shard
        at += r.size
    for s in range(40):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def slow_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_op5(result):
    prints = {d: slow_fingerprint(t) for d, t in DOCS}
    root = {d: d for d in prints}
    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
    assert {tuple(r) for r in result("op5_simhash_near_dedup")} == {(d, f"{p:016x}", root[d]) for d, p in prints.items()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_op6(result):
    groups = defaultdict(list)
    for d, t in DOCS:
        groups[lower(t)].append(d)
    want = {(d, max(groups[lower(t)]), len(groups[lower(t)]), d == max(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for d, t in DOCS}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in result("op6_exact_dedup")} == want


def test_op7(spark, folder, result):
    rows = result("op7_quality_classifier")
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in DOCS)
    model = quality.train_quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    of = dict(DOCS)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.score == pytest.approx(slow_score(of[r.doc_id] or "", model), abs=1e-9)
        assert r.predicted == int(r.score >= 0.7)


def slow_score(text, model):
    n = quality.DIMENSIONS
    at = quality.features(text).tolist()
    length = sum(model[i] ** 2 for i in at) ** 0.5
    margin = sum(model[i] * model[n + i] for i in at) / max(1e-9, length) + model[2 * n]
    return 1 / (1 + np.exp(-np.clip(model[-2] * margin + model[-1], -30, 30)))


def test_descent_against_a_plain_solver():
    """The dual's optimum by many small projected gradient steps over all rows at once."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(60, 8, replace=False)).astype(np.int32) for _ in range(50)]
    y = np.where([(r < 30).sum() + rng.normal() > 4 for r in rows], 1.0, -1.0)
    at, values = quality._scaled(rows, rng.normal(size=quality.DIMENSIONS))
    cost = np.where(y > 0, 1.0, 2.0)
    w = quality._descend(at, values, y, cost, 3000)
    x = np.zeros((50, 61))
    for i, (a, v) in enumerate(zip(at, values, strict=True)):
        x[i, np.where(a == quality.DIMENSIONS, 60, a)] = v
    gram, alpha = (x @ x.T) * np.outer(y, y), np.zeros(50)
    for _ in range(60_000):
        alpha = np.clip(alpha - 0.02 * (gram @ alpha - 1), 0, cost)
    plain = (alpha * y) @ x
    loss = lambda v: v @ v / 2 + cost @ np.maximum(0, 1 - y * (x @ v))
    own = np.append(w[:60], w[quality.DIMENSIONS])
    assert loss(own) == pytest.approx(loss(plain), rel=1e-3)


def test_op8(result):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for item, text in ITEMS:
        w = words(text)
        windows[str(item)] = {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    want = set()
    for d, text in DOCS:
        w, hit, items = words(text), set(), set()
        for item, own in windows.items():
            for g in own:
                for i in range(len(w) - len(g) + 1):
                    if tuple(w[i : i + len(g)]) == g:
                        hit |= set(range(i, i + len(g)))
                        items.add(item)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want.add((d, len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w)))
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in result("op8_benchmark_decontamination")}
    assert got == want
    assert sum(x[5] for x in want) > 5


def test_op9(result):
    library = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {(d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for d, t in DOCS}
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in result("op9_token_counts")} == want


def test_op10(result):
    text = lambda i: f"T{i} & co\n\none two {i}\n\nthree"
    want = {(i, f"https://h{i % 3}.org/{i}", text(i), len(text(i))) for i in range(12)} | {(50, None, "", 0)}
    assert {(r.page_id, r.url, r.text, r.n_chars) for r in result("op10_html_extraction")} == want


def test_op3(result):
    assert result("op3_license_scan") == []  # no document has a license


def test_stages_on_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    labels, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    for out in (stages.keep_quality(docs, labels), stages.drop_exact_duplicates(docs), stages.drop_near_duplicates(docs), stages.drop_contaminated(docs, benchmark)):
        assert (out.columns, out.count()) == (docs.columns, 0)
    assert stages.pack(docs, P.path("byte_bpe_50k.json")).count() == 0
    some = spark.read.parquet(f"{folder}/documents.parquet")
    assert stages.drop_contaminated(some, benchmark.limit(0)).count() == len(DOCS)


def test_keep_quality_keeps_what_the_score_says(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in QUERIES["op7_quality_classifier"](spark, folder).collect() if r.predicted}
    assert {r.doc_id for r in stages.keep_quality(docs, labels).collect()} == good


def test_pipeline_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_counts_of_copies(result):
    """Forty equal rows are one group everywhere."""
    assert Counter(r.keep_id for r in result("op6_exact_dedup"))[339] == 40
