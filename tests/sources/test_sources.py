import gzip
import random

import pytest
from pyspark.sql import functions as F

from taxaflow.plans.amplicon import RunOptions, run
from taxaflow.operators.read_filters import ReadOptions
from taxaflow.sources import reference_databases as R
from taxaflow.sources import sequences as S
from taxaflow.sources import sinks
from taxaflow.sources import tables as T
from taxaflow.streaming.arriving_reads import arrived_uniques, count_arriving_reads


def file(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_fasta_and_qual(spark, tmp_path):
    path = file(tmp_path, "a.fa", ">s1;size=3; note\r\nACGT\nAC\n>s2\nTTTT\n")
    assert {(r.id, r.seq) for r in S.read_fasta(spark, path).collect()} == {("s1", "ACGTAC"), ("s2", "TTTT")}
    assert [(r.unique_id, r.size) for r in S.read_uniques(spark, path).collect()] == [("s1", 3), ("s2", 1)]
    q = S.read_qual(spark, file(tmp_path, "a.qual", ">s1\n40 40 30\n20\n>s2\n1 2\n"))
    assert {(r.id, tuple(r.quals)) for r in q.collect()} == {("s1", (40, 40, 30, 20)), ("s2", (1, 2))}


def test_fastq(spark, tmp_path):
    text = "@r1 1:N\nACGT\n+\nIIII\n@r2 1:N\nGG\n+\nI@\n"
    plain = file(tmp_path, "x_R1.fastq", text)
    with gzip.open(tmp_path / "x_R2.fastq.gz", "wt") as f:
        f.write(text.replace(" 1:N", " 2:N").replace("ACGT", "TTTT"))
    assert {(r.read_id, r.seq, r.qual) for r in S.read_fastq(spark, plain).collect()} == {("r1 1:N", "ACGT", "IIII"), ("r2 1:N", "GG", "I@")}
    pairs = S.read_pairs(spark, plain, str(tmp_path / "x_R2.fastq.gz")).collect()
    assert {(r.read_id, r.r1, r.r2) for r in pairs} == {("r1", "ACGT", "TTTT"), ("r2", "GG", "GG")}
    assert S.read_fastq(spark, str(tmp_path)).count() == 4
    with pytest.raises(Exception, match="not a FASTQ record"):
        S.read_fastq(spark, file(tmp_path, "bad.fq", "@r\nAC\n+\nI\n")).count()


def test_sample_sheet(spark, tmp_path):
    good = file(tmp_path, "m.tsv", '#SampleID\tfastqFile\tSequencingRun\tSite\nA1\ta_1.fq,a_2.fq\tC\t"x"\nA2\tb_1.fq,b_2.fq\n\t\n')
    rows = {r.sample_id: r for r in T.checked_sheet(T.read_sample_sheet(spark, good)).collect()}
    assert set(rows) == {"A1", "A2"}
    assert rows["A1"].attrs == {"Site": "x"} and rows["A1"].violations == ["quote"]
    assert rows["A2"].sequencing_run == ""
    for bad in ("Sample\tx\nA\t1\n", "#SampleID\t\tx\nA\t1\t2\n"):
        with pytest.raises(ValueError, match="sample sheet"):
            T.read_sample_sheet(spark, file(tmp_path, "bad.tsv", bad))
    with pytest.raises(ValueError, match="dash"):
        T.checked_sheet(T.read_sample_sheet(spark, file(tmp_path, "d.tsv", "#SampleID\tfastqFile\nA-1\tx\n")))
    with pytest.raises(ValueError, match="mixed"):
        T.checked_sheet(T.read_sample_sheet(spark, file(tmp_path, "e.tsv", "#SampleID\tfastqFile\nA1\tx\nA2\tx,y\n")))
    names = spark.createDataFrame([("s_R1.fastq.gz",), ("s_R2.fastq.gz",), ("t.fq",), ("note.txt",)], "file string")
    assert {(r.sample_id, r.fastq_file) for r in T.sheet_of_files(names).collect()} == {("SMPL0", "s_R1.fastq.gz,s_R2.fastq.gz"), ("SMPL1", "t.fq")}


def test_tables(spark, tmp_path):
    m = T.read_matrix(spark, file(tmp_path, "m.txt", "OTU\ts1\ts2\nf1\t3\t0\nf2\t1\t2\n"))
    assert {tuple(r) for r in m.collect()} == {("f1", "s1", 3), ("f2", "s1", 1), ("f2", "s2", 2)}
    paf = T.read_paf(spark, file(tmp_path, "x.paf", "q\t10\t0\t10\t+\tt\t20\t0\t10\t9\t10\t60\n"))
    assert tuple(paf.first()) == ("q", 10, "t", 20, 9, 10)
    uc = file(tmp_path, "x.uc", "S\t0\t5\t*\t*\t*\t*\t*\ta;size=2;\t*\nH\t0\t5\t98.0\t+\t0\t0\t=\tb;size=3;\ta;size=2;\nC\t0\t3\t*\t*\t*\t*\t*\ta\t*\n")
    assert {(r.query, r.feature_id, r.size) for r in T.read_uc(spark, uc).collect()} == {("a", "a", 2), ("b", "a", 3)}
    assert T.uc_size_errors(spark, uc).count() == 1
    cl = T.read_clstr(spark, file(tmp_path, "x.clstr", ">Cluster 0\n0\t9nt, >a;size=2;... *\n1\t9nt, >b... at +/98%\n>Cluster 1\n0\t9nt, >c... *\n"))
    assert {tuple(r) for r in cl.collect()} == {("a", "a"), ("b", "a"), ("c", "c")}
    rdp = T.read_rdp(spark, file(tmp_path, "r.txt", 'f1\t\t"Bacteria"\tdomain\t1.0\tFirmicutes\tphylum\t0.7\n'))
    assert (rdp.first().ranks[:3], rdp.first().confidence[:3]) == (["Bacteria", "Firmicutes", "?"], [1.0, 0.7, 0.0])
    sx = T.read_sintax(spark, file(tmp_path, "s.txt", "f1;size=4;\td:B(1.0),p:Fi(0.9)\t+\n")).first()
    assert (sx.feature_id, sx.ranks[:2], sx.confidence[:2]) == ("f1", ["B", "Fi"], [1.0, 0.9])
    tax = T.read_taxonomy(spark, file(tmp_path, "t.txt", "r1\tk__B; p__Fi; c__\n")).first()
    assert tax.ranks == ["B", "Fi"] + ["?"] * 5
    h = T.read_hierarchy(spark, file(tmp_path, "h.txt", "OTU\tD\tP\nf1\tB\t\n")).first()
    assert (h.feature_id, h.ranks[:2]) == ("f1", ["B", "?"])


def test_reference_databases(spark):
    rec = lambda *x: spark.createDataFrame(list(x), "id string, header string, seq string")
    assert R.from_pr2(rec(("x", "x|a|b|c|d|e|f|g|h", "ACUX"))).first()[1:] == ("ACTN", ["a", "b", "d", "e", "f", "g", "h"])
    assert R.from_unite(rec(("x", "x|SH|k__Fungi;p__Asco", "AC"))).first().ranks[:2] == ["Fungi", "Asco"]
    assert [r.ranks[0] for r in R.from_hitdb(rec(("x", "x Euryarchaeota;M", "A"), ("y", "y Firmicutes", "A"))).collect()] == ["Archaea", "Bacteria"]
    guide = spark.createDataFrame([("Eukaryota;Op", "phylum"), ("Eukaryota;Op;Hid;Ge", "genus")], "path string, rank string")
    got = {r.ref_id: r.ranks for r in R.from_silva(rec(("b", "b Bacteria;Fi;Ba", "AU"), ("e", "e Eukaryota;Op;Hid;Ge;Ge sp", "A")), guide).collect()}
    assert got["b"][:3] == ["Bacteria", "Fi", "Ba"]
    assert got["e"] == ["Eukaryota", "Op", "?", "?", "?", "Ge", "Ge sp"]


def test_sinks(spark, tmp_path):
    counts = spark.createDataFrame([("f1", "1s", 3), ("f2", "t", 1)], "feature_id string, sample_id string, count long")
    tax = spark.createDataFrame([("f1", ["B", "Fi"] + ["?"] * 5)], "feature_id string, ranks array<string>")
    sinks.write_rank_tables(counts, tax, f"{tmp_path}/ranks")
    assert spark.read.csv(f"{tmp_path}/ranks/Phylum", sep="\t", header=True).where("Phylum = 'B;Fi'").first()[1] == "3"
    sinks.write_bundle(counts, tax, counts.select("sample_id").distinct(), f"{tmp_path}/bundle")
    assert {r.sample_id for r in spark.read.parquet(f"{tmp_path}/bundle/otu").collect()} == {"S_1s", "t"}
    sinks.write_biom_parts(counts, tax, counts.select("sample_id").distinct(), f"{tmp_path}/biom")
    assert '"data":[3,0]' in "".join(r.value for r in spark.read.text(f"{tmp_path}/biom/rows").collect())
    sinks.write_fasta(spark.createDataFrame([("f1", "ACGT", 3)], "feature_id string, seq string, size long"), f"{tmp_path}/fa", sized=True)
    assert [(r.id, r.seq) for r in S.read_fasta(spark, f"{tmp_path}/fa").collect()] == [("f1", "ACGT")]
    sinks.write_fastq(spark.createDataFrame([("s", "r", "AC", "II")], "sample_id string, read_id string, seq string, qual string"), f"{tmp_path}/fq", by_sample=False)
    sinks.write_uc(spark.createDataFrame([("a", "a"), ("b", "a")], "unique_id string, centroid string"), f"{tmp_path}/uc")
    assert {(r.query, r.feature_id) for r in T.read_uc(spark, f"{tmp_path}/uc").collect()} == {("a", "a"), ("b", "a")}


def test_stream(spark, tmp_path):
    one = spark.createDataFrame([("s", "ACGT"), ("s", "ACGT"), ("t", "")], "sample_id string, seq string")
    one.write.parquet(f"{tmp_path}/in/a")
    for _ in range(2):  # nothing is counted twice
        reads = spark.readStream.schema(one.schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        count_arriving_reads(reads, f"{tmp_path}/counts", f"{tmp_path}/state").awaitTermination()
    one.write.parquet(f"{tmp_path}/in/b")
    count_arriving_reads(reads, f"{tmp_path}/counts", f"{tmp_path}/state").awaitTermination()
    assert [(r.seq, r.size, r.sample_counts) for r in arrived_uniques(spark, f"{tmp_path}/counts").collect()] == [("ACGT", 4, {"s": 4})]


def test_whole_run(spark):
    rng = random.Random(2)
    species = ["".join(rng.choices("ACGT", k=120)) for _ in range(3)]
    reads = []
    for i in range(150):
        s = list(species[i % 3])
        if i % 10 == 0:
            s[60] = "A"
        reads.append((f"s{i % 2}", f"r{i}", "".join(s), "I" * 120))
    refs = spark.createDataFrame([(f"ref{i}", s) for i, s in enumerate(species)], "ref_id string, seq string")
    tax = spark.createDataFrame([(f"ref{i}", ["B", f"p{i}", "c", "o", "f", "g", f"s{i}"]) for i in range(3)], "ref_id string, ranks array<string>")
    options = RunOptions(reads=ReadOptions(min_length=50, mid_min_length=50, truncate=-1, max_homopolymer=20))
    out = run(spark.createDataFrame(reads, "sample_id string, read_id string, seq string, qual string"), refs, tax, options)
    assert out["features"].count() == 3
    assert out["counts"].agg(F.sum("count")).first()[0] == 150
    assert {";".join(r.ranks) for r in out["taxonomy"].collect()} == {f"B;p{i};c;o;f;g;s{i}" for i in range(3)}
    with pytest.raises(ValueError, match="clusterer"):
        RunOptions(clusterer="other")


def test_fastq_splits_and_globs(spark, tmp_path, monkeypatch):
    """Records are read once wherever splits fall, also where qualities begin with @."""
    import random

    rng = random.Random(1)
    records = []
    for i in range(200):
        n = rng.randrange(1, 30)
        records.append((f"r{i}", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@+I#", k=n))))
    text = "".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in records)
    path = file(tmp_path, "a.fastq", text)
    for size in (1, 7, 64, 1000, 10**6):
        reader = S.FastqReader([(path, len(text))])
        monkeypatch.setattr(S, "SPLIT_BYTES", size)
        found = [tuple(r.values())[:3] for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
        assert sorted(found) == sorted(records)
    file(tmp_path, "b.fastq", "@x\nAC\n+\nII\n")
    assert S.read_fastq(spark, f"{tmp_path}/*.fastq").count() == 201
    assert {r.file for r in S.listed_files(spark, str(tmp_path)).collect()} == {"a.fastq", "b.fastq"}
    with pytest.raises(FileNotFoundError):
        S.read_fastq(spark, f"{tmp_path}/none*.fq")


def test_a_run_from_sheet_and_files(spark, tmp_path):
    """Two features and a contaminant, in mates behind primers, from written files to counts and lineages."""
    import random

    from taxaflow.operators.read_filters import ReadOptions
    from taxaflow.plans.amplicon import read_runs

    rng = random.Random(7)
    forward, reverse = "ACGTAC", "GGATTC"
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    genes = ["".join(rng.choices("ACGT", k=120)) for _ in range(3)]
    for sample in ("A1", "A2"):
        one, two = [], []
        for g, gene in enumerate(genes):
            for i in range(10 + 5 * g):
                name = f"{sample}_{g}_{i}"
                whole = forward + gene + turn(reverse)
                one.append(f"@{name}/1\n{whole[:90]}\n+\n{'I' * 90}\n")
                two.append(f"@{name}/2\n{turn(whole)[:90]}\n+\n{'I' * 90}\n")
        file(tmp_path, f"{sample}_1.fq", "".join(one))
        file(tmp_path, f"{sample}_2.fq", "".join(two))
    sheet = file(tmp_path, "map.tsv", "#SampleID\tfastqFile\nA1\tA1_1.fq,A1_2.fq\nA2\tA2_1.fq,A2_2.fq\n")
    with pytest.raises(ValueError, match="in the call"):
        T.read_sample_sheet(spark, file(tmp_path, "both.tsv", "#SampleID\tfastqFile\tReversePrimer\nA\tx\tAC\n"), reverse_primer="AC")
    own = ReadOptions(min_length=50, mid_min_length=50, truncate=-1, window=20)
    reads = read_runs(spark, T.checked_sheet(T.read_sample_sheet(spark, sheet, forward, reverse)), str(tmp_path), own)
    assert reads.count() == 90 and reads.where(f"seq LIKE '{forward}%'").count() == 0
    refs = spark.createDataFrame([("r0", genes[0]), ("r1", genes[1])], "ref_id string, seq string")
    tax = spark.createDataFrame([(f"r{i}", ["B", f"P{i}", "c", "o", "f", "g", "s"]) for i in range(2)], "ref_id string, ranks array<string>")
    phix = spark.createDataFrame([("x", genes[2])], "ref_id string, seq string")
    for classifier in ("similarity", "bayes", "vote"):
        out = run(reads, refs, tax, RunOptions(reads=own, classifier=classifier, chimeras=("exact", "denovo", "reference"), crosstalk=0.001), phix=phix, more_databases=[(refs, tax)])
        assert sorted((r.sample_id, r["count"]) for r in out["counts"].collect()) == [("A1", 10), ("A1", 15), ("A2", 10), ("A2", 15)]
        assert sorted(r.ranks[1] for r in out["taxonomy"].collect()) == ["P0", "P1"]
        assert {r.status for r in out["cleaned"].collect()} == {"kept", "contaminant"}
    assert {r.seq for r in out["representatives"].collect()} == {genes[0], genes[1]}


def test_settings(spark, tmp_path):
    path = file(tmp_path, "names.cfg", '# places\nrefs\t"/data/refs.parquet"\n\nlonely\ntax /data/old  # first\ntax /data/tax\n')
    assert R.read_settings(spark, path) == {"refs": "/data/refs.parquet", "tax": "/data/tax"}


def test_what_is_left_out_is_written(spark, tmp_path):
    counts = spark.createDataFrame([("f2", "b", 2), ("f2", "a", 1), ("f1", "a", 5), ("f3", "a", 4)], "feature_id string, sample_id string, count long")
    cleaned = spark.createDataFrame([("f1", "chimera", "Chim.1"), ("f2", "contaminant", "OTU.phiX.1"), ("f3", "kept", "OTU1")], "feature_id string, status string, new_id string")
    features = spark.createDataFrame([("f2", "ACGT"), ("f3", "GG")], "feature_id string, seq string")
    out = str(tmp_path / "out")
    sinks.write_left_out(counts, cleaned, features, out)
    assert [tuple(r) for r in spark.read.csv(f"{out}/chimeras", sep="\t", header=True).collect()] == [("Chim.1", "5")]
    assert [r.asDict() for r in spark.read.csv(f"{out}/contaminants", sep="\t", header=True).collect()] == [{"feature_id": "OTU.phiX.1", "a": "1", "b": "2"}]
    assert {(r.id, r.seq) for r in S.read_fasta(spark, f"{out}/contaminants.fasta").collect()} == {("OTU.phiX.1", "ACGT")}
    sinks.write_curated(counts.where("feature_id <> 'f3'"), features.where("feature_id = 'f3'"), f"{out}/curated")
    assert [r.feature_id for r in spark.read.csv(f"{out}/curated/curated", sep="\t", header=True).collect()] == ["f1", "f2"]
    assert [r.value for r in spark.read.text(f"{out}/curated/removed").collect()] == ["f3"]
    sinks.write_fasta(spark.range(40).selectExpr("CAST(id AS STRING) AS feature_id", "'ACGT' AS seq"), f"{out}/chunks", chunks=4)
    assert len(list((tmp_path / "out" / "chunks").glob("part-*"))) == 4
    assert S.read_fasta(spark, f"{out}/chunks").count() == 40


def test_one_biom_file(spark, tmp_path):
    import json

    counts = spark.createDataFrame([(f"f{i:03}", f"s{i % 3}", i + 1) for i in range(40)], "feature_id string, sample_id string, count long")
    tax = spark.createDataFrame([("f001", ["B", 'Fi "x"'] + ["?"] * 5)], "feature_id string, ranks array<string>")
    sinks.write_biom(counts, tax, counts.select("sample_id").distinct(), f"{tmp_path}/table.biom")
    table = json.loads((tmp_path / "table.biom").read_text())
    assert table["shape"] == [40, 3] and [c["id"] for c in table["columns"]] == ["s0", "s1", "s2"]
    assert [r["id"] for r in table["rows"]] == [f"f{i:03}" for i in range(40)]
    assert table["data"] == [[i + 1 if i % 3 == s else 0 for s in range(3)] for i in range(40)]
    assert table["rows"][1]["metadata"]["taxonomy"][1].endswith('Fi "x"')


def test_first_records_and_mate_marks(spark, tmp_path):
    path = file(tmp_path, "x.fasta", "".join(f">r{i}\nAC\nGT\n" for i in range(50)))
    assert [r.id for r in S.first_records(S.read_fasta(spark, path), 7).collect()] == [f"r{i}" for i in range(7)]
    reads = spark.createDataFrame([("a/2", "AC", "II"), ("b 2:N:0", "GT", "II")], "read_id string, seq string, qual string")
    for fmt, names in ((1, ["@a/1", "@b/1"]), (2, ["@a 1:0:", "@b 1:0:"])):
        sinks.write_fastq(reads, f"{tmp_path}/fq{fmt}", by_sample=False, compression="none", mate=1, pair_header=fmt)
        assert sorted(r.value for r in spark.read.text(f"{tmp_path}/fq{fmt}").where("value LIKE '@%'").collect()) == names


def test_wide_matrix_of_very_many_samples(spark):
    from taxaflow.operators.matrix import to_wide

    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        counts = spark.createDataFrame([("f", f"s{i}", i + 1) for i in range(12)], "feature_id string, sample_id string, count long")
        assert to_wide(counts).columns == ["feature_id", *sorted(f"s{i}" for i in range(12))]
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_common_folders(spark):
    rows = [("a", "/x/y/z"), ("a", "/x/y-1"), ("a", "/x/y"), ("b", "/x/y/z"), ("b", "/x/y"), ("c", "/only/one")]
    from taxaflow.functions import lineages as L
    from pyspark.sql import functions as F

    got = spark.createDataFrame(rows, "g string, p string").groupBy("g").agg(L.common_folder(F.col("p")).alias("f")).collect()
    assert {r.g: r.f for r in got} == {"a": "/x", "b": "/x/y", "c": "/only/one"}


def test_totals_in_a_log(spark, tmp_path):
    path = file(tmp_path, "run.log", "start\nReads processed: 12,345\n7 files\nread 12\n")
    assert sorted(r.number for r in T.read_totals(spark, path).collect()) == [12, 12345]
