"""Queries of barcodes, primers, errors, names and small table steps, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions import sequences as S
from taxaflow.operators import matrix
from taxaflow.operators import read_filters as R
from taxaflow.operators import taxonomy as T
from taxaflow.operators.dereplicate import later_wins, representatives, seed_sequences, with_references
from taxaflow.operators.similarity import merge_pairs
from taxaflow.plans import bindings as B
from taxaflow.plans.registry import query

_ACGT = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
_CODES = f"codes AS (SELECT n_name AS sample_id, substr(translate(sha1(n_name), {_ACGT}), 1, 6) AS barcode FROM nation)"
_PLAIN = R.ReadOptions(truncate=-1, trim_threshold=-1, max_accumulated_error=-1, max_expected_error=-1, window_threshold=-1)


def _codes(spark, d):
    letters = F.translate(F.sha1("n_name"), "0123456789abcdef", "ACGTACGTACGTACGT")
    return B.table(spark, d, "nation").select(F.col("n_name").alias("sample_id"), F.substring(letters, 1, 6).alias("barcode"))


_BEGUN = """d AS (SELECT sample_id, barcode, row_number() OVER (ORDER BY sample_id) - 1 AS i FROM codes),
    begun AS (SELECT read_id, CASE WHEN CAST(read_id AS BIGINT) % 3 = 0 THEN seq ELSE d.barcode || seq END AS seq FROM reads JOIN d ON d.i = CAST(read_id AS BIGINT) % (SELECT count(*) FROM codes))"""


def _begun(spark, d):
    """Reads of documents, two thirds of them behind a barcode."""
    codes = _codes(spark, d)
    n = codes.count()  # nations
    numbered = matrix.numbered(codes, [F.asc("sample_id")], "i").select((F.col("i") - 1).alias("i"), "barcode")
    rows = B.reads(spark, d).select("read_id", "seq", (F.col("read_id").cast("bigint") % n).alias("i")).join(numbered, "i")
    return rows.select("read_id", F.when(F.col("read_id").cast("bigint") % 3 == 0, F.col("seq")).otherwise(F.concat("barcode", "seq")).alias("seq"))


@query(f"""WITH {B.READS}, {_CODES}, {_BEGUN}, near AS (SELECT read_id, sample_id, seq, hamming(left(seq, 6), barcode) AS e FROM begun, codes WHERE length(seq) >= 6),
    best AS (SELECT read_id, min(e) AS e FROM near WHERE e <= 1 GROUP BY 1)
    SELECT near.read_id, any_value(sample_id) AS sample_id, any_value(substr(seq, 7)) AS seq FROM near JOIN best ON near.read_id = best.read_id AND near.e = best.e GROUP BY 1 HAVING count(*) = 1""")
def demultiplexed_reads(spark, d):
    return R.demultiplex(_begun(spark, d), _codes(spark, d), most=1).select("read_id", "sample_id", "seq")


_PRIMED = f"""WITH {B.READS}, t AS (SELECT read_id, seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM reads),
    f AS (SELECT read_id, CASE WHEN regexp_matches(seq, '^A[AG][ACGTUN]') THEN substr(seq, 4) WHEN regexp_matches(rc, '^A[AG][ACGTUN]') THEN substr(rc, 4) END AS seq FROM t)"""


@query(_PRIMED + " SELECT read_id, regexp_replace(seq, 'GA[ACT]TC.*$', '') AS seq, regexp_matches(seq, 'GA[ACT]TC') AS reverse_found FROM f WHERE seq IS NOT NULL")
def primer_strip(spark, d):
    """Forward primer ARN, reverse primer GADTC, which reads have as GA[ACT]TC; reads may lie the other way round."""
    reads = B.reads(spark, d).withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))
    options = R.ReadOptions(require_reverse=False)
    return R.strip_primers(reads, "ARN", "GADTC", options).select("read_id", "seq", "reverse_found")


@query(f"""WITH {B.READS}, e AS (SELECT read_id, seq, list_filter(range(1, length(seq) - 4), lambda i: hamming(substr(seq, i, 6), 'GATTAC') <= 1) AS places FROM reads)
    SELECT read_id, CAST(coalesce(places[1], 0) AS INT) AS place FROM e""")
def primer_with_errors(spark, d):
    return B.reads(spark, d).select("read_id", R.find_primer(F.col("seq"), "GATTAC", 1).cast("int").alias("place"))


@query(f"""WITH {B.READS}, c AS (SELECT read_id, substr(seq, 4 + CASE WHEN starts_with(seq, 'AA') THEN 2 ELSE 0 END) AS seq FROM reads) SELECT read_id, seq, CAST(length(seq) * 40 AS BIGINT) AS quality FROM c""")
def adapter_trim(spark, d):
    """An adapter AA and three bases are cut off the beginning, with their qualities."""
    reads = B.reads(spark, d).select("read_id", "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))
    cut = R.trimmed(reads, R.replace(_PLAIN, adapter="AA", trim_start=3))
    return cut.select("read_id", "seq", F.aggregate("quals", F.lit(0).cast("bigint"), lambda a, q: a + q).alias("quality"))


@query(f"""WITH {B.QUALITIES}, p AS (SELECT user_id, list_transform(quals, lambda q: pow(CAST(10 AS DOUBLE), -(q + 3) / CAST(10 AS DOUBLE))) AS p FROM quals),
    s AS (SELECT user_id, list_product(list_transform(p, lambda x: 1 - x)) AS none, list_sum(list_transform(p, lambda x: x / (1 - x))) AS a, list_sum(list_transform(p, lambda x: (x / (1 - x)) * (x / (1 - x)))) AS b FROM p)
    SELECT user_id, 1 - none * (1 + a + (a * a - b) / 2) > CAST(0.6 AS DOUBLE) AS unlikely FROM s""")
def binomial_errors(spark, d):
    """Whether more than two errors have a chance of over 0.6: a Poisson binomial by base."""
    rows = B.qualities(spark, d).select("user_id", F.transform("quals", lambda q: q + 3).alias("quals"))
    return rows.select("user_id", R.unlikely_errors(F.col("quals"), 2.0, 0.6).alias("unlikely"))


@query("""WITH q AS (SELECT user_id, event_type AS file, least(40, floor(value)) AS q FROM events), s AS (SELECT file, min(q) + 33 + CASE WHEN file = 'click' THEN 31 ELSE 0 END AS low, max(q) + 33 + CASE WHEN file = 'click' THEN 31 ELSE 0 END AS high FROM q GROUP BY 1)
    SELECT file, CASE WHEN low >= 59 AND high > 75 THEN 64 ELSE 33 END AS offset FROM s""")
def phred_offset_by_file(spark, d):
    """Events' values as qualities of a read each; those of clicks are written with an offset of 64."""
    shift = F.when(F.col("event_type") == "click", 64).otherwise(33)
    reads = B.table(spark, d, "events").select(F.col("event_type").alias("file"), F.char(F.least(F.lit(40), F.floor("value")) + shift).alias("qual"))
    return R.phred_offsets(reads).select("file", "offset")


@query("SELECT doc_id AS read_id, regexp_replace(translate(text, 'Uuacgt', 'TTACGT'), '[^ACGT]', 'N', 'g') AS seq FROM documents WHERE text IS NOT NULL")
def reference_bases(spark, d):
    rows = B.table(spark, d, "documents").where("text IS NOT NULL")
    return rows.select(F.col("doc_id").alias("read_id"), S.mask_non_acgt(S.rna_to_dna(F.col("text"))).alias("seq"))


_PATHS = "paths AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*)', 1) AS p, regexp_extract(url, '^([a-z]+)://', 1) AS scheme FROM pages)"


@query(f"""WITH {_PATHS}, parts AS (SELECT scheme, string_split(regexp_replace(url_, '^[a-z]+://', '/'), '/') AS w FROM (SELECT scheme, '/srv/data/' || regexp_extract(p, '^[a-z]*') || '/' || p AS url_ FROM paths)),
    n AS (SELECT scheme, count(*) AS n FROM parts GROUP BY 1), heads AS (SELECT scheme, i, array_to_string(list_slice(w, 1, i), '/') AS head, count(*) AS c FROM parts, (SELECT unnest(range(1, 12)) AS i) WHERE i <= len(w) GROUP BY 1, 2, 3)
    SELECT scheme, arg_max(head, i) AS folder FROM heads JOIN n USING (scheme) WHERE c = n GROUP BY 1""")
def common_folder(spark, d):
    """The longest folder that the paths of each scheme's pages have in common."""
    path = F.regexp_extract("url", "^[a-z]+://[^/]*/([^?#]*)", 1)
    rows = B.table(spark, d, "pages").select(F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"), F.concat(F.lit("/srv/data/"), F.regexp_extract(path, "^[a-z]*", 0), F.lit("/"), path).alias("path"))
    return rows.groupBy("scheme").agg(L.common_folder(F.col("path")).alias("folder"))


@query("SELECT l_orderkey AS query, l_partkey AS target, round(avg(l_discount), 6) AS pident, CAST(sum(l_quantity) AS BIGINT) AS alnlen, round(sum(l_extendedprice), 2) AS bits FROM lineitem GROUP BY 1, 2")
def merged_hits(spark, d):
    li = B.table(spark, d, "lineitem")
    hits = li.select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("target"), F.col("l_discount").alias("pident"), F.col("l_quantity").alias("alnlen"), F.col("l_extendedprice").alias("bits"))
    return T.merge_same_target(hits).select("query", "target", F.round("pident", 6).alias("pident"), F.col("alnlen").cast("bigint").alias("alnlen"), F.round("bits", 2).alias("bits"))


@query("SELECT l_orderkey AS query, l_linenumber AS line, CASE WHEN l_quantity * 5 >= 120 AND pow(CAST(10 AS DOUBLE), -l_quantity) <= pow(CAST(10 AS DOUBLE), -14) THEN l_discount ELSE 0 END AS pident FROM lineitem")
def significant_hits(spark, d):
    evalue = F.pow(F.lit(10.0), -F.col("l_quantity"))
    return B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_linenumber").alias("line"), T.significant_identity(F.col("l_discount"), F.col("l_quantity") * 5, evalue).alias("pident"))


@query("""WITH v AS (SELECT l_suppkey % 4 AS part, count(*) FILTER ((l_partkey < l_orderkey) = (l_linenumber <= 6)) AS plus, count(*) FILTER ((l_partkey < l_orderkey) <> (l_linenumber <= 6)) AS minus FROM lineitem GROUP BY 1)
    SELECT part, plus, minus, CASE WHEN plus + minus > 20 AND plus / CAST(plus + minus AS DOUBLE) > 0.9 THEN 'plus' WHEN plus + minus > 20 AND plus / CAST(plus + minus AS DOUBLE) < 0.1 THEN 'minus' ELSE 'both' END AS strand FROM v""")
def strand_vote(spark, d):
    """Strand of four sets of hits."""
    hits = B.table(spark, d, "lineitem").select(
        (F.col("l_suppkey") % 4).alias("part"), F.col("l_partkey").alias("qstart"), F.col("l_orderkey").alias("qend"), F.col("l_linenumber").alias("tstart"), F.lit(6).alias("tend")
    )
    sets = [T.strand_votes(hits.where(F.col("part") == i)).select(F.lit(i).cast("bigint").alias("part"), "plus", "minus", "strand") for i in range(4)]
    return sets[0].unionByName(sets[1]).unionByName(sets[2]).unionByName(sets[3])


@query("""WITH t AS (SELECT l_returnflag AS tier, l_partkey AS feature_id, l_suppkey AS sample_id, CAST(l_quantity AS BIGINT) AS count FROM lineitem)
    SELECT feature_id, sample_id, CAST(sum(count) AS BIGINT) AS count FROM t GROUP BY 1, 2""")
def tier_matrix(spark, d):
    """Members of three tiers (return flags) counted together."""
    li = B.table(spark, d, "lineitem").select("l_returnflag", F.col("l_partkey").alias("feature_id"), F.col("l_suppkey").alias("sample_id"), F.col("l_quantity").cast("bigint").alias("count"))
    return matrix.build_counts([li.where(F.col("l_returnflag") == x).drop("l_returnflag") for x in ("A", "N", "R")])


_RUN_ROWS = "t AS (SELECT o_orderpriority AS run, CAST(o_custkey % 500 AS VARCHAR) AS seq, CAST(o_custkey % 12 AS VARCHAR) AS sample_id, CAST(floor(o_totalprice) AS BIGINT) AS count FROM orders)"


@query(f"WITH {_RUN_ROWS}, s AS (SELECT seq, sum(count) AS total, count(DISTINCT sample_id) FILTER (WHERE count > 0) AS samples FROM (SELECT seq, sample_id, sum(count) AS count FROM t GROUP BY 1, 2) GROUP BY 1) SELECT 'ASV' || row_number() OVER (ORDER BY total DESC, seq) AS feature_id, seq, CAST(total AS BIGINT) AS total, samples FROM s")
def runs_by_sequence(spark, d):
    """Tables of sequencing runs combined on the sequence; features in order of their totals."""
    rows = B.table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("run"), (F.col("o_custkey") % 500).cast("string").alias("seq"), (F.col("o_custkey") % 12).cast("string").alias("sample_id"), F.floor("o_totalprice").alias("count")
    )
    return matrix.combine_runs(rows)[0]


@query("""WITH r AS (SELECT doc_id, doc_id % 50 AS feature_id, source, text, n_chars % 41 AS q FROM documents WHERE text IS NOT NULL)
    SELECT feature_id, arg_max(sha1(text), [CAST(q AS BIGINT), CAST(length(text) AS BIGINT), doc_id]) AS seq FROM r GROUP BY 1""")
def representative_reads(spark, d):
    """The read of each feature with the best quality, then length, then id."""
    docs = B.table(spark, d, "documents").where("text IS NOT NULL")
    members = docs.select((F.col("doc_id") % 50).alias("feature_id"), F.lit("centroid").alias("centroid"), F.col("doc_id").alias("read_id"), F.col("text").alias("seq"), (F.col("n_chars") % 41).alias("mean_quality"))
    return representatives(members).select("feature_id", F.sha1("seq").alias("seq"))


@query("SELECT p_partkey AS feature_id, CASE WHEN p_size > 20 THEN p_brand ELSE p_type END AS seq FROM part WHERE p_size > 20 OR p_size < 35")
def later_region_wins(spark, d):
    """Two regions' sequences; where both have a feature the second one's stays."""
    p = B.table(spark, d, "part")
    return later_wins(p.where("p_size < 35").select(F.col("p_partkey").alias("feature_id"), F.col("p_type").alias("seq")), p.where("p_size > 20").select(F.col("p_partkey").alias("feature_id"), F.col("p_brand").alias("seq")))


@query(f"WITH {B.TAXONOMY}, refs AS (SELECT n_nationkey AS ref_id, n_name FROM nation) SELECT feature_id, CASE WHEN feature_id % 10 = 0 THEN 'Life;' || n_name || ';?;?;?;?;?' ELSE array_to_string(ranks, ';') END AS lineage FROM tax LEFT JOIN refs ON ref_id = feature_id % 25")
def reference_lineages(spark, d):
    """Every tenth feature stands for a reference and takes its lineage."""
    refs = B.table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("ref_id"), F.array(F.lit("Life"), F.col("n_name"), *(F.lit("?") for _ in range(5))).alias("ranks"))
    tax = B.taxonomy(spark, d)
    links = tax.where("feature_id % 10 = 0").select("feature_id", (F.col("feature_id") % 25).alias("ref_id"))
    return T.with_reference_lineages(tax, links, refs).select("feature_id", F.concat_ws(";", "ranks").alias("lineage"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS feature_id, p_name AS seq FROM part UNION ALL SELECT 'ref' || n_nationkey, n_name FROM nation")
def features_and_references(spark, d):
    features = B.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("feature_id"), F.col("p_name").alias("seq"))
    refs = B.table(spark, d, "nation").select(F.concat(F.lit("ref"), F.col("n_nationkey").cast("string")).alias("ref_id"), F.col("n_name").alias("seq"))
    return with_references(features, refs)


@query("SELECT 'OTU_' || c_custkey AS feature_id, regexp_replace(c_name, '(0007|0005).*$', '') AS seq FROM customer WHERE c_nationkey < 20 UNION ALL SELECT 'OTU_' || c_custkey, c_name FROM customer WHERE c_nationkey >= 20")
def seed_records(spark, d):
    """Merged pairs, first mates and single reads as one set of named sequences; motifs are cut from the first two."""
    c = B.table(spark, d, "customer").select(F.concat(F.lit("OTU_"), F.col("c_custkey").cast("string"), F.lit(".1")).alias("read_id"), F.col("c_name").alias("seq"), "c_nationkey")
    return seed_sequences(c.where("c_nationkey < 10"), c.where("c_nationkey BETWEEN 10 AND 19"), c.where("c_nationkey >= 20"), ["0007", "0005"])


@query("SELECT CASE WHEN c_custkey % 2 = 0 THEN 'OTU_' || c_custkey ELSE 'ITS' || c_custkey || '|F|x' END AS feature_id FROM customer")
def region_ids(spark, d):
    key = F.col("c_custkey").cast("string")
    name = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("OTU_"), key, F.lit(";size=3|F|ITS1"))).when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("OTU_"), key, F.lit("|F|ITS1"))).otherwise(F.concat(F.lit("ITS"), key, F.lit("|F|x")))
    return B.table(spark, d, "customer").select(S.feature_of_region(name).alias("feature_id"))


@query("""WITH p AS (SELECT p_partkey AS id, translate(sha256(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s FROM part)
    SELECT id, s AS merged FROM p""")
def merged_pairs(spark, d):
    """Mates of 40 bases of amplicons of 64, which overlap by 16."""
    s = F.translate(F.sha2(F.col("p_partkey").cast("string"), 256), "0123456789abcdef", "ACGTACGTACGTACGT")
    rows = B.table(spark, d, "part").select(F.col("p_partkey").alias("id"), s.alias("s"))
    pairs = rows.select("id", F.substring("s", 1, 40).alias("r1"), S.reverse_complement(F.expr("substring(s, 25, 40)")).alias("r2"))
    return merge_pairs(pairs, max_mismatch=0.1).select("id", "merged")
