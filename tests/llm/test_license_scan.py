import random

from taxaflow.llm.decontaminate import words_of
from taxaflow.llm.license_scan import Templates, scan_licenses, shingles
from taxaflow.llm.license_templates import TEMPLATES


def brute(docs, texts):
    out = []
    for doc_id, text in docs:
        w = words_of(text or "")
        for name, (_, t) in texts.items():
            tw = words_of(t)
            n, size = len(tw), min(5, len(tw))
            step, want = max(1, n // 4), shingles(tw, min(5, len(tw)))
            best = max((len(want & shingles(w[i : i + n + step], size)) / len(want) for i in range(0, len(w), step)), default=0)
            if best >= 0.8:
                out.append((doc_id, name, best))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(4)
    vocab = [w.decode() for _, t in TEMPLATES.values() for w in words_of(t)] + ["été", "lorem", "ipsum"]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(3)]
        t = list(rng.choice(list(TEMPLATES.values()))[1].split())
        for _ in range(rng.choice([0, 0, 1, 3])):
            t[rng.randrange(len(t))] = "changed"
        parts.insert(1, rng.choice([str.upper, str])(rng.choice([" ", "\n"]).join(t)))
        docs.append((i, " ".join(parts)))
    return docs + [(None, "All rights reserved."), (7, docs[7][1]), (300, None), (301, ""), (302, "word " * 30_000 + "Licensed under CC BY-NC 4.0")]


def test_against_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, license string, start int").repartition(3)
    rows = scan_licenses(frame).collect()
    assert sorted([(r.doc_id, r.template, r.containment) for r in rows], key=repr) == brute(docs, TEMPLATES)
    texts = dict(docs)
    for r in rows:
        part = words_of(texts[r.doc_id][r.start : r.end])
        want = words_of(TEMPLATES[r.template][1])
        size = min(5, len(want))
        assert len(shingles(want, size) & shingles(part, size)) / len(shingles(want, size)) == r.containment


def test_empty_and_own_templates(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    frame = spark.createDataFrame([(1, "b c"), (2, "B, C d")], "doc_id long, text string")
    assert sorted(r.doc_id for r in scan_licenses(frame, {"own": ("own", "b c"), "none": ("none", "...")}).collect()) == [1, 2]
    assert Templates({}).classes == []


def word_by_word(text, template, more):
    """The largest share of the template's shingles in a stretch of its length, and of a part ``more`` of it in addition, at any word."""
    w, t = words_of(text or ""), words_of(template)
    n, size = len(t), min(5, len(t))
    want = shingles(t, size)
    return max((len(want & shingles(w[i : i + n + int(n * more)], size)) / len(want) for i in range(max(1, len(w) - n + 1))), default=0)


def test_registered_query_against_stretches_at_every_word(spark, tmp_path):
    """All licenses are found that a stretch of their length holds at any word, and none that no stretch of a quarter more holds."""
    from taxaflow.llm.queries import QUERIES

    docs = [(i, t) for i, t in corpus()[:60]] + [(500, "x " * 13 + TEMPLATES["mit-grant"][1] + " y"), (501, " ".join(f"{w} extra" for w in TEMPLATES["isc-grant"][1].split())), (502, None)]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.template) for r in QUERIES["op3_license_scan"](spark, str(tmp_path)).collect()}
    sure = {(i, name) for i, t in docs for name, (_, template) in TEMPLATES.items() if word_by_word(t, template, 0) >= 0.8}
    able = {(i, name) for i, t in docs for name, (_, template) in TEMPLATES.items() if word_by_word(t, template, 0.25) >= 0.8}
    assert sure <= got <= able and len(sure) > 30 and (500, "mit-grant") in got and (501, "isc-grant") not in got
