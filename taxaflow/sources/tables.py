"""Tab-separated tables of the amplicon world as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions.sequences import size_tag, strip_header

#: Columns of a sample sheet that have a meaning (fixed values).
SHEET_COLUMNS = {
    "#SampleID": "sample_id", "fastqFile": "fastq_file", "fnaFile": "fna_file", "CombineSamples": "combine_samples", "BarcodeSequence": "barcode_sequence",
    "ForwardPrimer": "forward_primer", "LinkerPrimerSequence": "linker_primer", "ReversePrimer": "reverse_primer", "SequencingRun": "sequencing_run", "MIDfqFile": "mid_file",
}
HIT_COLUMNS = "query string, target string, pident double, alnlen int, mism int, gapopen int, qstart int, qend int, tstart int, tend int, qlen int"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "\r", "").alias("value"))


def read_sample_sheet(spark: SparkSession, path: str, forward_primer: str = "", reverse_primer: str = "") -> DataFrame:
    """Named columns of a sample sheet, other ones in ``attrs``, and ``violations`` of each row. Primers of the call stand in
    for columns that the sheet lacks; to give them in both is an error.

    The header decides the columns, so it is read first; short rows are padded, quotes removed, rows without an id
    and comments left out. A sheet has thousands of rows at most.
    """
    lines = _lines(spark, path).where(F.trim("value") != "")
    head = lines.where(F.col("value").startswith("#")).first()
    if head is None or not head.value.startswith("#SampleID"):
        raise ValueError("the sample sheet must begin with #SampleID")
    names = head.value.split("\t")
    if any(not n.strip() for n in names):
        raise ValueError("the sample sheet has a column without a name")
    cells = F.split(F.regexp_replace("value", "[\"']", ""), "\t")
    rows = lines.where(~F.col("value").startswith("#")).withColumn("cells", cells)
    rows = rows.withColumn("cells", F.concat("cells", F.array(*(F.lit("") for _ in names))))
    known = [F.col("cells")[i].alias(SHEET_COLUMNS[n]) for i, n in enumerate(names) if n in SHEET_COLUMNS]
    other = [x for i, n in enumerate(names) if n not in SHEET_COLUMNS for x in (F.lit(n), F.col("cells")[i])]
    attrs = F.create_map(*other) if other else F.create_map().cast("map<string,string>")
    sheet = rows.select(*known, attrs.alias("attrs"), F.col("value").alias("line")).where(F.trim("sample_id") != "")
    for column, primer in (("forward_primer", forward_primer), ("reverse_primer", reverse_primer)):
        if primer and column in sheet.columns:
            raise ValueError(f"{column} is in the sample sheet and in the call")
        sheet = sheet.withColumn(column, F.lit(primer)) if primer else sheet
    return sheet.withColumn("violations", sheet_violations(F.col("sample_id"), F.col("line"))).drop("line")


def sheet_violations(sample_id: Column, line: Column) -> Column:
    """Codes of what is wrong with a row; those that begin with ``fatal`` must stop a run."""
    rules = [
        (sample_id.rlike(r"^\s|\s$"), "fatal: space at the edge of an id"),
        (sample_id.contains("-"), "fatal: dash in an id"),
        (line.contains(" "), "space"),
        (line.rlike(r"[^\x00-\x7F]"), "not ASCII"),
        (line.rlike("[\"']"), "quote"),
    ]
    return F.filter(F.array(*(F.when(test, F.lit(code)) for test, code in rules)), lambda c: c.isNotNull())


def mixed_pairing(sheet: DataFrame) -> bool:
    """Whether some samples have paired files and others not."""
    return sheet.agg(F.countDistinct(F.size(F.split("fastq_file", ",")))).first()[0] > 1


def checked_sheet(sheet: DataFrame) -> DataFrame:
    bad = sheet.select("sample_id", F.explode("violations").alias("v")).where(F.col("v").startswith("fatal")).limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r.sample_id}: {r.v}" for r in bad))
    if "fastq_file" in sheet.columns and mixed_pairing(sheet):
        raise ValueError("paired and single files are mixed")
    return sheet


def sequencing_runs(sheet: DataFrame, batch: int = 100) -> DataFrame:
    """Adds run: the sheet's sequencing run, or where none is given a batch of ``batch`` samples (half of all
    if there are 51 to 189) in order of their ids."""
    n = sheet.count()
    size = (n + 1) // 2 if 51 <= n <= 189 else batch
    number = F.floor((F.row_number().over(Window.orderBy("sample_id")) - 1) / size).cast("string")
    given = F.nullif(F.trim(F.coalesce("sequencing_run", F.lit(""))), F.lit("")) if "sequencing_run" in sheet.columns else F.lit(None).cast("string")
    return sheet.withColumn("run", F.coalesce(given, F.concat(F.lit("batch"), number)))


def sheet_of_files(files: DataFrame, first: str = r"^(.*?)[_.]R?1(_001)?\.f(ast)?q(\.gz)?$", second: str = r"^(.*?)[_.]R?2(_001)?\.f(ast)?q(\.gz)?$") -> DataFrame:
    """A sample sheet of file names (column ``file``): mates are paired by their common part, others stand alone; ids count from SMPL0."""
    one = files.where(F.col("file").rlike(first)).select(F.regexp_extract("file", first, 1).alias("part"), F.col("file").alias("f1"))
    two = files.where(F.col("file").rlike(second)).select(F.regexp_extract("file", second, 1).alias("part"), F.col("file").alias("f2"))
    paired = one.join(two, "part").select(F.concat_ws(",", "f1", "f2").alias("fastq_file"), "f1", "f2")
    used = paired.select(F.explode(F.array("f1", "f2")).alias("file"))
    single = files.join(used, "file", "left_anti").where(F.col("file").rlike(r"\.f(ast)?q(\.gz)?$")).select(F.col("file").alias("fastq_file"))
    rows = paired.select("fastq_file").unionByName(single)
    return rows.select(F.concat(F.lit("SMPL"), (F.row_number().over(Window.orderBy("fastq_file")) - 1).cast("string")).alias("sample_id"), "fastq_file")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Long counts of a wide matrix; the first column holds the features."""
    wide = spark.read.csv(path, sep="\t", header=True)
    first = wide.columns[0]
    long = wide.unpivot([first], wide.columns[1:], "sample_id", "count")
    return long.select(F.col(first).alias("feature_id"), "sample_id", F.col("count").cast("bigint").alias("count")).where("count > 0")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HIT_COLUMNS).csv(path, sep="\t").withColumn("position", F.monotonically_increasing_id())


def read_match_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("otu string, hit string, match double").csv(path, sep="\t")


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    cells = F.split("value", "\t")
    pick = {"query": (0, "string"), "query_len": (1, "int"), "target": (5, "string"), "target_len": (6, "int"), "matches": (9, "int"), "alnlen": (10, "int")}
    return _lines(spark, path).select(*(cells[i].try_cast(kind).alias(name) for name, (i, kind) in pick.items()))


def read_uc(spark: SparkSession, path: str, swap: bool = False) -> DataFrame:
    """query, feature_id, kind, pident, strand of seeds and hits of a cluster file; ``swap``: query and target change places."""
    cells = F.split("value", "\t")
    rows = _lines(spark, path).select(cells[0].alias("kind"), cells[3].try_cast("double").alias("pident"), cells[4].alias("strand"), cells[8].alias("query"), cells[9].alias("target"))
    rows = rows.where(F.col("kind").isin("S", "H"))
    target = F.when(F.col("kind") == "S", F.col("query")).otherwise(F.col("target"))
    a, b = (target, F.col("query")) if swap else (F.col("query"), target)
    return rows.select(strip_header(a).alias("query"), strip_header(b).alias("feature_id"), "kind", "pident", "strand", size_tag(F.col("query")).alias("size"))


def uc_size_errors(spark: SparkSession, path: str) -> DataFrame:
    """Clusters whose summary row says another size than their members make up."""
    cells = F.split("value", "\t")
    rows = _lines(spark, path).select(cells[0].alias("kind"), cells[1].alias("cluster"), cells[2].try_cast("bigint").alias("size"))
    said = rows.where("kind = 'C'").select("cluster", "size")
    found = rows.where(F.col("kind").isin("S", "H")).groupBy("cluster").agg(F.count("*").alias("members"))
    return said.join(found, "cluster", "full").where(~F.col("size").eqNullSafe(F.col("members")))


def read_clstr(spark: SparkSession, path: str) -> DataFrame:
    """query, feature_id of a .clstr file; the member marked with * represents its cluster."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    members = F.regexp_extract_all("value", F.lit(r">([^\n]+?)\.\.\. (?:\*|at)"), F.lit(1))
    head = F.regexp_extract("value", r">([^\n]+?)\.\.\. \*", 1)
    return raw.select(F.explode(members).alias("query"), head.alias("head")).select(strip_header(F.col("query")).alias("query"), strip_header(F.col("head")).alias("feature_id"))


def read_cluster_lines(spark: SparkSession, path: str) -> DataFrame:
    """query, feature_id, size of files with one cluster a line, centre first."""
    cells = F.split(F.trim("value"), r"\s+")
    rows = _lines(spark, path).where(F.trim("value") != "").select(cells[0].alias("c"), F.explode(cells).alias("q"))
    return rows.select(strip_header(F.col("q")).alias("query"), strip_header(F.col("c")).alias("feature_id"), size_tag(F.col("q")).alias("size"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("old string, new string").csv(path, sep="\t")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """ref_id, ranks of lines: id, tab, tagged lineage."""
    cells = F.split("value", "\t", 2)
    return _lines(spark, path).where("value <> ''").select(cells[0].alias("ref_id"), L.parse_lineage(cells[1]).alias("ranks"))


def read_hierarchy(spark: SparkSession, path: str, id_last: bool = False) -> DataFrame:
    """feature_id, ranks of a table with a header and a column a rank; ``id_last``: the id stands last."""
    lines = _lines(spark, path)
    header = lines.first()
    cells = F.split("value", "\t")
    rows = lines.where(F.col("value") != (header.value if header else ""))
    ranks = F.slice(cells, 1, 7) if id_last else F.slice(cells, 2, 7)
    named = F.transform(F.slice(F.concat(ranks, L.no_lineage()), 1, 7), L.clean_rank)
    return rows.select((F.element_at(cells, -1) if id_last else cells[0]).alias("feature_id"), named.alias("ranks"))


def read_rdp(spark: SparkSession, path: str) -> DataFrame:
    """feature_id, ranks, confidence of fixed-rank lines: id, strand, then name, rank, confidence from the domain on."""
    cells = F.split("value", "\t")
    at = F.array_position(F.transform("c", F.lower), "domain")  # 1-based place of the word after the domain's name
    rows = _lines(spark, path).select(cells.alias("c")).withColumn("at", at.cast("int")).where("at > 0")
    count = F.greatest(F.lit(0), F.floor((F.size("c") - F.col("at") + 2) / 3)).cast("int")
    steps = F.when(count > 0, F.sequence(F.lit(0), F.least(count, F.lit(7)) - 1)).otherwise(F.array().cast("array<int>"))
    name = F.transform(steps, lambda i: F.regexp_replace(F.get("c", F.col("at") - 2 + 3 * i), "\"", ""))
    conf = F.transform(steps, lambda i: F.get("c", F.col("at") + 3 * i).try_cast("double"))
    pad = F.array(*(F.lit(0.0) for _ in L.RANKS))
    return rows.select(strip_header(F.col("c")[0]).alias("feature_id"), F.slice(F.concat(name, L.no_lineage()), 1, 7).alias("ranks"), F.slice(F.concat(conf, pad), 1, 7).alias("confidence"))


def read_sintax(spark: SparkSession, path: str) -> DataFrame:
    """feature_id, ranks, confidence of lines like ``id<TAB>d:Name(0.9),p:Name(0.8)``."""
    cells = F.split("value", "\t")
    names = F.regexp_extract_all(cells[1], F.lit(r"[a-z]:([^(,]*)\("), F.lit(1))
    conf = F.regexp_extract_all(cells[1], F.lit(r"\(([0-9.]+)\)"), F.lit(1)).cast("array<double>")
    pad = F.array(*(F.lit(0.0) for _ in L.RANKS))
    return _lines(spark, path).where("value <> ''").select(strip_header(cells[0]).alias("feature_id"), F.slice(F.concat(names, L.no_lineage()), 1, 7).alias("ranks"), F.slice(F.concat(conf, pad), 1, 7).alias("confidence"))


def read_totals(spark: SparkSession, path: str, pattern: str = r"(?i)reads?\D*?(\d[\d,]*)") -> DataFrame:
    """Numbers that a pattern finds in the lines of a log."""
    found = F.regexp_extract("value", pattern, 1)
    return _lines(spark, path).where(found != "").select("value", F.regexp_replace(found, ",", "").cast("bigint").alias("number"))
