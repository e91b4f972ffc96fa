"""Hand-worked cases and invariants of the amplicon operators."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions import sequences as S
from taxaflow.operators import chimera, classify, cluster, curate, matrix, similarity
from taxaflow.operators import taxonomy as T
from taxaflow.operators.components import connected_components
from taxaflow.operators.dereplicate import dereplicate, meets_minimum, representatives
from taxaflow.operators.read_filters import PRESETS, ReadOptions, demultiplex, read_options, read_tiers, strip_pair_primers, strip_primers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_reverse_complement_and_names(spark):
    assert one(spark, S.reverse_complement(F.lit("ACGTRYKMBDHVN"))) == "NBDHVKMRYACGT"
    assert one(spark, S.reverse_complement(S.reverse_complement(F.lit("ACGTacgtNRYswKMBDHV")))) == "ACGTacgtNRYswKMBDHV"
    assert one(spark, S.size_tag(F.lit("a;size=12;"))) == 12
    assert one(spark, S.size_tag(F.lit("a_7"))) == 7
    assert one(spark, S.strip_header(F.lit("a;size=12; more"))) == "a"
    assert one(spark, S.with_size(F.lit("a;size=1;"), F.lit(5))) == "a;size=5;"
    assert one(spark, S.sample_of_read(F.lit("s1___r2"))) == "s1"
    assert one(spark, S.clock(F.lit(3725))) == "01:02:05"
    assert one(spark, S.numeric_prefix(F.lit("9a"))) == "S_9a"
    assert one(spark, S.cut_from_motif(F.lit("AAGATCTT"), ["GATC", "TTTT"])) == "AA"


def test_expected_errors(spark):
    q = F.array(*(F.lit(x) for x in (40, 40, 20, 10, 2)))
    assert one(spark, S.expected_errors(q)) == pytest.approx(0.7411573444801932)
    assert one(spark, S.accumulated_error_cut(q, 0.95)) == 5
    assert one(spark, S.accumulated_error_cut(q, 0.5)) == 4
    assert one(spark, S.first_bad_window(q, 2, 16)) == 3
    assert one(spark, S.first_bad_window(q, 9, 16)) == 0


def test_minimum_rule(spark):
    rows = [(1, {"a": 8, "b": 0, "c": 0}), (2, {"a": 4, "b": 4}), (3, {"a": 7, "b": 3}), (4, {"a": 3, "b": 3, "c": 3}), (5, {"a": 2, "b": 2, "c": 2})]
    frame = spark.createDataFrame(rows, "id int, m map<string,int>")
    kept = {r.id for r in frame.where(meets_minimum(F.col("m"), "8:1,4:2,3:3")).collect()}
    assert kept == {1, 2, 4}


def test_lca(spark):
    a, a2, c, dd = ("B;Fi;Ba;La;Lc;Lb;s1", "B;Fi;Ba;La;Lc;Lb;s2", "B;Fi;Ba;La;St;Sp;s3", "B;Pr;Ga;En;?;?;?")
    tax = spark.createDataFrame([("A", a.split(";")), ("A2", a2.split(";")), ("C", c.split(";")), ("D", dd.split(";"))], "ref_id string, ranks array<string>")
    hits = {
        "q1": [(99.0, 250, "A"), (98.8, 250, "A"), (98.7, 250, "A2"), (90.0, 250, "C")],
        "q2": [(96.0, 240, "D")],
        "q3": [(97.5, 200, "A"), (96.5, 200, "A"), (96.4, 200, "A"), (96.3, 200, "C")],
        "q4": [(85.0, 200, "C"), (84.0, 200, "A"), (84.2, 150, "A")],
    }
    rows = [(q, t, p, n, i) for q, h in hits.items() for i, (p, n, t) in enumerate(h)]
    frame = spark.createDataFrame(rows, "query string, target string, pident double, alnlen int, position int")
    queries = spark.createDataFrame([(q,) for q in [*hits, "none"]], "query string")
    got = {r.query: ";".join(r.ranks) for r in T.assign_by_similarity(queries, frame, tax).collect()}
    assert got == {"q1": a, "q2": dd, "q3": "B;Fi;Ba;La;Lc;Lb;?", "q4": "B;Fi;Ba;La;?;?;?", "none": "?;?;?;?;?;?;?"}
    assert T.missing_references(frame, tax).count() == 0
    both = T.assign_by_databases(queries, [(frame.where("query = 'q2'"), tax), (frame, tax)]).collect()
    assert {r.query: r.db_rank for r in both} == {"q1": 1, "q2": 0, "q3": 1, "q4": 1, "none": None}


def test_curation_by_cooccurrence(spark):
    cells = {"o1": (10, 20, 30, 0), "o2": (5, 4, 3, 0), "o3": (1, 0, 2, 0), "o4": (0, 0, 0, 9), "o5": (0, 3, 40, 0)}
    counts = spark.createDataFrame([(f, i, n) for f, row in cells.items() for i, n in enumerate(row) if n], "feature_id string, sample_id int, count long")
    match = spark.createDataFrame([("o2", "o1", 96.0), ("o3", "o2", 95.0), ("o5", "o1", 90.0), ("o4", "o1", 84.0), ("o1", "o1", 100.0)], "otu string, hit string, match double")
    curated, gone = curate.curate_by_cooccurrence(counts, match)
    got = {}
    for r in curated.collect():
        got.setdefault(r.feature_id, [0] * 4)[r.sample_id] = r["count"]
    assert got == {"o1": [16, 24, 35, 0], "o5": [0, 3, 40, 0], "o4": [0, 0, 0, 9]}
    assert {r[0] for r in gone.collect()} == {"o2", "o3"}


def test_matrix_cleaning(spark):
    counts = spark.createDataFrame([("f1", "s", 5), ("f2", "s", 9), ("f3", "s", 7), ("f5", "s", 2)], "feature_id string, sample_id string, count long")
    fasta = spark.createDataFrame([("f1",), ("f2",), ("f3",), ("f4",)], "feature_id string")
    flags = spark.createDataFrame([("f3", "offTarget.0")], "feature_id string, filter string")
    none = spark.createDataFrame([], "feature_id string")
    named = lambda rescued: {r.feature_id: r.new_id for r in matrix.clean_matrix(counts, fasta, flags, rescued).collect()}
    assert named(none) == {"f2": "OTU1", "f1": "OTU2", "f3": "OTU.offTarget.0.1", "f4": None, "f5": "Chim.1"}
    assert named(flags.select("feature_id")) == {"f2": "OTU1", "f3": "OTU2", "f1": "OTU3", "f4": None, "f5": "Chim.1"}


def test_rollup(spark):
    counts = spark.createDataFrame([("f1", "s", 3), ("f2", "s", 4), ("f3", "s", 5)], "feature_id string, sample_id string, count long")
    unknown = ["?"] * 5
    tax = spark.createDataFrame([("f1", ["B", "Fi", *unknown]), ("f2", ["B", "?", *unknown])], "feature_id string, ranks array<string>")
    rolled = matrix.rank_rollup(counts, tax)
    assert {r.path: r["count"] for r in rolled.where("rank = 2").collect()} == {"B;Fi": 3, "B;?": 4, "noHit;": 5}
    assert {(r["rank"], r["sum(count)"]) for r in rolled.groupBy("rank").sum("count").collect()} == {(i, 12) for i in range(2, 8)}
    assert [(r.reads_pct, r.taxa_pct) for r in matrix.assigned_percent(rolled).where("rank = 2").collect()] == [(25, 50)]
    wide = matrix.to_wide(counts)
    assert sorted(map(tuple, matrix.from_wide(wide).collect())) == sorted(map(tuple, counts.collect()))


def test_numbered_is_gapless(spark):
    frame = spark.createDataFrame([(i * 37 % 101, i % 3) for i in range(101)], "v int, g int").repartition(5)
    got = [(r.v, r.n) for r in matrix.numbered(frame, [F.col("v")], "n", parts=7).collect()]
    assert sorted(got) == [(i, i + 1) for i in range(101)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
def test_components(spark, links):
    root = list(range(13))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()}
    assert got == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_reads_to_tiers(spark):
    o = ReadOptions(min_length=5, max_length=50, min_mean_quality=30, mid_min_length=5, mid_min_mean_quality=20, truncate=8, max_homopolymer=3, window=3, window_threshold=10, trim_window=3, trim_threshold=12, max_accumulated_error=-1, max_expected_error=-1)
    rows = [("a", "ACGTACGTAC", "I" * 10), ("b", "ACGTACGTAC", "7" * 10), ("c", "AAAAACGT", "I" * 8), ("d", "ACGTNCGT", "I" * 8), ("e", "ACGTACGT", "IIIII!!!"), ("f", "", "")]
    got = {r.read_id: (r.tier, r.seq) for r in read_tiers(spark.createDataFrame(rows, "read_id string, seq string, qual string"), o).collect()}
    assert got["a"] == ("high", "ACGTACGT")
    assert got["b"][0] == "mid"
    assert got["c"][0] == "rejected"
    assert got["d"][0] == "mid"
    assert got["e"] == ("high", "ACGTA")
    assert got["f"][0] == "rejected"


def test_option_files():
    lines = ["#comment", "minSeqLength\t100", "*minSeqLength\t90", "RejectSeqWithoutFwdPrim\tF", "fastqVersion\t2", "unknown\t1"]
    o = read_options(lines)
    assert (o.min_length, o.mid_min_length, o.require_forward, o.phred_offset) == (100, 90, False, 64)
    assert len(PRESETS) == 14
    with pytest.raises(ValueError, match="below"):
        ReadOptions(min_length=10, max_length=5)


def test_barcodes_and_primers(spark):
    codes = spark.createDataFrame([("s1", "AAAA"), ("s2", "CCCC")], "sample_id string, barcode string")
    reads = spark.createDataFrame([("r1", "AAAAGT", "IIIIII"), ("r2", "CCCAGT", "IIIIII"), ("r3", "AACCGT", "IIIIII")], "read_id string, seq string, qual string")
    assert {(r.read_id, r.sample_id, r.seq) for r in demultiplex(reads, codes).collect()} == {("r1", "s1", "GT")}
    assert {(r.read_id, r.sample_id) for r in demultiplex(reads, codes, most=1).collect()} == {("r1", "s1"), ("r2", "s2")}
    assert {(r.read_id) for r in demultiplex(reads, codes, most=2).collect()} == {"r1", "r2"}
    primed = spark.createDataFrame([("f", "ACRTTTTGGCC".replace("R", "G"), "I" * 11), ("t", "GGCCAAAACGT", "I" * 11), ("n", "TTTTTTTTTTT", "I" * 11)], "read_id string, seq string, qual string")
    got = {r.read_id: (r.seq, len(r.qual)) for r in strip_primers(primed, "ACR", "GGCC").collect()}
    assert got == {"f": ("TTTT", 4), "t": ("TTTT", 4)}


def test_dereplicate(spark):
    reads = spark.createDataFrame([("a", "ACGT")] * 3 + [("b", "ACGT"), ("b", "AC"), ("b", "")], "sample_id string, seq string")
    got = {r.seq: (r["size"], r.sample_counts) for r in dereplicate(reads).collect()}
    assert got == {"ACGT": (4, {"a": 3, "b": 1}), "AC": (1, {"b": 1})}
    members = spark.createDataFrame([("x", "CEN", "r1", "AAA", 30.0), ("x", "CEN", "r2", "AAT", 35.0), ("y", "CEN2", None, None, None)], "feature_id string, centroid string, read_id string, seq string, mean_quality double")
    assert {r.feature_id: r.seq for r in representatives(members).collect()} == {"x": "AAT", "y": "CEN2"}


def sequences(spark, n=30):
    rng = random.Random(6)
    rows = []
    for g in range(4):
        base = "".join(rng.choices("ACGT", k=80))
        for i in range(n // 4):
            s = list(base)
            for _ in range(i % 3):
                s[rng.randrange(80)] = rng.choice("ACGT")
            rows.append((f"u{g}_{i}", "".join(s), 100 - i, g))
    return rows, spark.createDataFrame(rows, "unique_id string, seq string, size long, g int")


def test_similarity_and_clusters(spark):
    rows, frame = sequences(spark)
    assert similarity.align_pair("ACGTACGT", "ACGTACGT")[:3] == (100.0, 8, 0)
    assert similarity.align_pair("ACGTTACGT", "ACGTACGT")[3] == 1
    families = {u: g for u, _, _, g in rows}
    got = {r.unique_id: r.centroid for r in cluster.cluster_by_identity(frame, 0.93, 0.9, k=8).collect()}
    assert got == {u: f"u{g}_0" for u, g in families.items()}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    sizes = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 6)], "unique_id string, size int")
    assert {r.unique_id: r.centroid for r in cluster.greedy_centroids(sizes, links).collect()} == {"a": "a", "b": "a", "c": "c", "d": "c"}
    near = spark.createDataFrame([("a", "ACGTACGT", 9), ("b", "ACGAACGT", 3), ("c", "ACGAACG", 2), ("d", "TTTTTTTT", 1)], "unique_id string, seq string, size int")
    assert {r.unique_id: r.centroid for r in cluster.swarms(near).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d"}


def test_repeats_find_their_like(spark):
    seqs = ["ACGT" * 50, "ACGT" * 30 + "ACGA" + "ACGT" * 19, "AC" * 100, "A" * 200, "ACGTTGCA" * 25]
    frame = spark.createDataFrame([(str(i), s) for i, s in enumerate(seqs)], "id string, seq string")
    got = similarity.similarity_hits(frame.select(F.col("id").alias("query"), "seq"), frame.select(F.col("id").alias("target"), "seq")).collect()
    found = {(a, b): similarity.align_pair(seqs[a], seqs[b]) for a in range(5) for b in range(5)}
    want = {(str(a), str(b)) for (a, b), h in found.items() if h and h[0] >= 97 and h[5] - h[4] + 1 >= 160}
    assert {(r.query, r.target) for r in got} == want
    assert {("0", "0"), ("0", "1"), ("3", "3")} <= want


def test_frequent_kmers_lose_no_pair(spark):
    rows, frame = sequences(spark)
    q, t = (frame.select(F.col("unique_id").alias(c), "seq") for c in ("query", "target"))
    want = {tuple(r) for r in similarity.candidate_pairs(q, t, 8, 0.93, 0.9).collect()}
    got = {tuple(r) for r in similarity.candidate_pairs(q, t, 8, 0.93, 0.9, common=1).collect()}
    assert {(u, u) for u, *_ in rows} <= want <= got


def test_merged_pairs(spark):
    r1, r2 = "ACGTACGTTTGGAACC", "GGTTCCAAACGT"  # the second, turned round, is ACGTTTGGAACC
    frame = spark.createDataFrame([(r1, r2), (r1, "A" * 12)], "r1 string, r2 string")
    assert [r.merged for r in similarity.merge_pairs(frame, max_mismatch=0.0).collect()] == [r1, None]


def test_bimeras(spark):
    rng = random.Random(3)
    a, b = ("".join(rng.choices("ACGT", k=60)) for _ in range(2))
    rows = [("a", a, 100), ("b", b, 90), ("c", a[:30] + b[30:], 5), ("d", a[:29] + "N" + b[30:], 5)]
    frame = spark.createDataFrame(rows, "unique_id string, seq string, size long")
    assert {r.unique_id for r in chimera.exact_bimeras(frame).where("bimera").collect()} == {"c"}
    found = chimera.denovo_chimeras(frame, min_cover=0.7).collect()
    assert {(r.query, r.left_parent, r.right_parent) for r in found} >= {("c", "a", "b")}


def test_classifiers(spark):
    rows, frame = sequences(spark)
    refs = frame.select(F.concat(F.lit("t"), F.col("g").cast("string")).alias("taxon"), "seq", F.col("unique_id").alias("ref_id"))
    queries = frame.select(F.col("unique_id").alias("query"), "seq")
    got = {r.query: r.taxon for r in classify.classify_words(queries, refs).collect()}
    assert got == {u: f"t{g}" for u, _, _, g in rows}
    tax = refs.select("ref_id", F.concat(F.array(F.lit("B")), F.array_repeat("taxon", 6)).alias("ranks"))
    conf = classify.bootstrap_confidence(queries, refs, tax, rounds=20, share=4).collect()
    assert {r.query: r.ranks[1] for r in conf} == got
    assert all(0.9 <= r.confidence[6] <= 1 for r in conf)


def test_lineage_functions(spark):
    assert one(spark, L.parse_lineage(F.lit("k__B; p__'Fi'; c__; o__unidentified"))) == ["B", "Fi", "?", "?", "?", "?", "?"]
    assert one(spark, L.known_depth(F.array(F.lit("a"), F.lit("?")))) == 1
    assert one(spark, L.longest_common_prefix(F.array(F.lit("/a/b/c"), F.lit("/a/b/d"), F.lit("/a/b/c/e")))) == "/a/b"
    assert one(spark, F.size(L.prefix_paths(L.no_lineage()))) == 6


def test_primers_with_errors_and_mates(spark):
    reads = spark.createDataFrame([("a", "ACGTTTTTGGCAAA", "I" * 14, 1), ("b", "ACCTTTTTGGCCAA", "I" * 14, 2), ("c", "TTTTTTTTTTTTTT", "I" * 14, 3)], "read_id string, seq string, qual string, _cut int")
    o = ReadOptions(max_primer_errors=1, check_reversed=False)
    got = {r.read_id: (r.seq, len(r.qual), r._cut) for r in strip_primers(reads, "ACG", "GGCC", o).collect()}
    assert got == {"a": ("TTTTT", 5, 1), "b": ("TTTTT", 5, 2)}
    long = spark.createDataFrame([("x", "TTACGCCCCGGCCTTACGAAAAGGCCTT", "I" * 28)], "read_id string, seq string, qual string")
    assert strip_primers(long, "ACG", "GGCC", ReadOptions(extensive_primers=True)).first().seq == "CCCC"
    pairs = spark.createDataFrame([("p", "ACGAAAACCCC", "I" * 11, "GGTTTTTT", "F" * 8), ("q", "GGTTTTTT", "F" * 8, "ACGAAAACCCC", "I" * 11), ("r", "TTTTTTTT", "I" * 8, "TTTTTTTT", "I" * 8)], "read_id string, r1 string, q1 string, r2 string, q2 string")
    got = {r.read_id: (r.r1, r.q1, r.r2) for r in strip_pair_primers(pairs, "ACG", "GG").collect()}
    assert got == {"p": ("AAAACCCC", "I" * 8, "TTTTTT"), "q": ("AAAACCCC", "I" * 8, "TTTTTT")}
    short = strip_pair_primers(pairs.where("read_id = 'p'"), "ACG", "GG", ReadOptions(short_amplicon=True)).first()
    assert short.r1 == "AAAA"  # what follows the reverse primer's complement goes


def test_demultiplexed_reads_may_have_samples_already(spark):
    reads = spark.createDataFrame([("r1", "AAGT", "IIII", "old", "code"), ("r1", "CCGT", "IIII", "old", "code")], "read_id string, seq string, qual string, sample_id string, barcode string")
    codes = spark.createDataFrame([("s1", "AA"), ("s2", "CC")], "sample_id string, barcode string")
    assert {(r.sample_id, r.seq, r.barcode) for r in demultiplex(reads, codes).collect()} == {("s1", "GT", "code"), ("s2", "GT", "code")}
    assert demultiplex(reads, codes.limit(0)).count() == 0


def test_offsets_by_file_and_unknown_options(spark):
    reads = spark.createDataFrame([("a", "ACGT", "IIII", "x"), ("b", "ACGT", "hhhh", "y"), ("c", "", "", "z")], "read_id string, seq string, qual string, file string")
    o = ReadOptions(min_length=2, mid_min_length=2, truncate=-1, window=2, trim_window=2)
    assert {r.read_id: r.quals for r in read_tiers(reads, o).collect()} == {"a": [40] * 4, "b": [40] * 4, "c": []}
    with pytest.warns(UserWarning, match="noSuchKey"):
        made = read_options(["noSuchKey\t1", "ExtensivePrimerChecks\tT", "CheckForMixedPairs\tF", "AmpliconShortPE\tT", "PEheaderPairFmt\t2", "*RejectSeqWithoutFwdPrim\tF"])
    assert (made.extensive_primers, made.check_mates, made.short_amplicon, made.pair_header, made.mid_require_forward, made.max_expected_error) == (True, False, True, 2, False, -1)


def test_primer_with_differences_is_one_pattern(spark):
    """Places are those of a count of differences at every place, and the search is one regular expression."""
    from pyspark.sql import functions as F

    from taxaflow.operators.read_filters import find_primer, primer_errors

    rng = random.Random(8)
    seqs = ["".join(rng.choice("ACGTN") for _ in range(rng.randrange(60))) for _ in range(200)] + [None, "", "GATTA", "AGATTAC\n", "GA\nTAC"]
    rows = spark.createDataFrame([(s,) for s in seqs], "seq string")
    for primer, most in (("GATTAC", 1), ("GAYTRCN", 2)):
        found = find_primer(F.col("seq"), primer, most)
        assert "regexp_instr" in str(found)
        slow = F.array(*(F.when(primer_errors(F.col("seq"), primer, i) <= most, i) for i in range(1, 61)))
        fits = F.coalesce(F.array_min(F.filter(slow, lambda i: i <= F.length("seq") - len(primer) + 1)), F.lit(0))
        assert rows.where(~found.eqNullSafe(fits)).count() == 0
