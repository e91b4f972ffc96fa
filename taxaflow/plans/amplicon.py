"""A whole run: sample sheet and files to reads, features, counts, lineages and rank tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions import sequences as S
from taxaflow.operators import chimera, classify, cluster, curate, error_partition, local_search, matrix, ranked_search, similarity
from taxaflow.operators import taxonomy as T
from taxaflow.operators.dereplicate import dereplicate, meets_minimum, unique_ids
from taxaflow.operators.read_filters import ReadOptions, demultiplex, read_tiers, strip_pair_primers, strip_primers
from taxaflow.session import checkpointed
from taxaflow.sources.sequences import read_fastq


@dataclass(frozen=True)
class RunOptions:
    reads: ReadOptions = ReadOptions()
    clusterer: str = "size"  # size, length, swarm, denoise or dada (error rates learned per run)
    identity: float = 0.97
    backmap_identity: float | None = None  # None: 0.99 after denoising, else the identity
    backmap_coverage: float = 0.8
    minimum: str = "8:1,4:2,3:3"
    chimera_skew: float = 2.0
    check_chimeras: bool = True
    chimeras: tuple[str, ...] = ("exact",)  # exact, denovo and, with reference sequences, reference
    curate: bool = False
    merge_variants: bool = False
    crosstalk: float = 0.0  # most a sample may have of a feature's other counts; 0: not looked for
    classifier: str = "similarity"  # similarity, bayes or vote
    confidence: float = 0.8
    lca_share: float = 0.8
    lca_cover: float = 0.5  # of a feature that a hit must cover
    identity_steps: tuple[float, ...] = T.IDENTITY_STEPS  # percent that species, genus and so on ask of a hit
    keep_offtargets: bool = False  # features that hit off_target stay
    best_hit_only: bool = False
    exclude_taxa: str = ""
    prefix: str = "OTU"
    kmer: int = 11

    def __post_init__(self) -> None:
        if self.clusterer not in ("size", "length", "swarm", "denoise", "dada"):
            raise ValueError(f"no clusterer {self.clusterer}")
        if self.classifier not in ("similarity", "bayes", "vote"):
            raise ValueError(f"no classifier {self.classifier}")
        if not set(self.chimeras) <= {"exact", "denovo", "reference"}:
            raise ValueError(f"no such check for chimeras among {self.chimeras}")
        if not (0 < self.identity <= 1 and 0 <= self.lca_share <= 1 and 0 <= self.lca_cover <= 1 and 0 < self.backmap_coverage <= 1 and 0 <= self.confidence <= 1 and 0 <= self.crosstalk < 1):
            raise ValueError("identities, coverage, confidence and shares lie between 0 and 1")
        if self.chimera_skew < 1 or self.kmer < 1:
            raise ValueError("the skew and k are at least 1")
        if self.backmap_identity is not None and self.backmap_identity < self.identity:
            raise ValueError("reads are mapped back at the clusters' identity at least")


def find_features(uniques: DataFrame, options: RunOptions) -> DataFrame:
    """feature_id, seq, size of the centroids of sequences that meet the minimum."""
    able = uniques.where(meets_minimum(F.col("sample_counts"), options.minimum))
    if options.clusterer == "swarm":
        found = cluster.swarms(able)
    elif options.clusterer == "denoise":
        found = cluster.denoise(able, k=options.kmer)
    else:
        found = cluster.cluster_by_identity(able, options.identity, 0.9, options.clusterer, options.kmer)
    centroids = found.select(F.col("centroid").alias("unique_id")).distinct()
    return able.join(centroids, "unique_id").select(F.col("unique_id").alias("feature_id"), "seq", "size")


def denoise_by_errors(reads: DataFrame, options: RunOptions) -> DataFrame:
    """feature_id, seq, size of the variants of reads (run, read_id, seq, quals): rates are learned and uniques parted for each run, bimeras of a
    run are left out, and runs meet on the sequence."""
    rates = checkpointed(error_partition.run_rates(reads))
    parts = checkpointed(error_partition.denoised_runs(error_partition.quality_uniques(reads), rates))
    sizes = parts.where("corrected").groupBy("run", "center").agg(F.sum("size").alias("size"))
    variants = checkpointed(sizes.join(parts.select("run", F.col("unique_id").alias("center"), "seq"), ["run", "center"]).withColumnRenamed("center", "unique_id"))
    runs = [r.run for r in variants.select("run").distinct().collect()]  # sequencing runs of a study
    kept = []
    for run in runs if options.check_chimeras else []:
        own = variants.where(F.col("run") == run)
        found = chimera.exact_bimeras(own, options.chimera_skew).where("bimera").select("unique_id")
        kept.append(own.join(found, "unique_id", "left_anti"))
    rows = reduce(DataFrame.unionByName, kept) if kept else variants
    return rows.groupBy("seq").agg(F.sum("size").alias("size")).select(F.sha1("seq").alias("feature_id"), "seq", "size")


def count_features(uniques: DataFrame, features: DataFrame, options: RunOptions) -> DataFrame:
    identity = options.backmap_identity or (0.99 if options.clusterer in ("denoise", "dada") else options.identity)
    return similarity.map_back(uniques, features, identity, options.backmap_coverage, options.kmer)


def assign_lineages(features: DataFrame, databases: list[tuple[DataFrame, DataFrame]], options: RunOptions) -> DataFrame:
    """feature_id, ranks. databases: (references: ref_id, seq; taxonomy: ref_id, ranks) in order of priority.

    By similarity and lowest common ancestor in each database, the first that knows the domain counting; or by the words
    of the first database's references, ranks below the confidence being unknown.
    """
    queries = features.select(F.col("feature_id").alias("query"), "seq")
    references, taxonomy = databases[0]
    if options.classifier == "similarity":
        found = []
        for refs, tax in databases:
            hits = ranked_search.ranked_hits(queries, refs.select(F.col("ref_id").alias("target"), "seq"), 0.75, options.lca_cover, accepts=100, rejects=200)
            best = checkpointed(T.top_hits(hits, 200))
            found.append(T.assign_by_similarity(queries, best, tax, options.lca_share, options.best_hit_only, options.identity_steps).withColumn("db_rank", F.lit(len(found))))
        named = T.first_database(reduce(DataFrame.unionByName, found)).select(F.col("query").alias("feature_id"), "ranks")
    else:
        if options.classifier == "bayes":
            lineage = F.concat_ws(";", F.slice("ranks", 1, 6))
            taxa = references.join(taxonomy, "ref_id").select(lineage.alias("taxon"), "seq")
            sure = classify.bayes_confidence(queries, taxa)
            pad = F.concat("confidence", F.array(F.lit(0.0)))  # the species
            found = T.mask_confidence(sure.select("query", L.parse_lineage(F.col("taxon")).alias("ranks"), pad.alias("confidence")), options.confidence)
        else:
            voted = classify.bootstrap_confidence(queries, references, taxonomy)
            found = T.mask_confidence(voted, options.confidence)
        named = found.select(F.col("query").alias("feature_id"), "ranks")
        named = features.select("feature_id").join(named, "feature_id", "left").select("feature_id", F.coalesce("ranks", L.no_lineage()).alias("ranks"))
    return T.exclude_taxa(named, options.exclude_taxa) if options.exclude_taxa else named


def chimeric(features: DataFrame, references: DataFrame, options: RunOptions) -> DataFrame:
    """feature_id of features that one of the checks takes for chimeras."""
    rows = features.select(F.col("feature_id").alias("unique_id"), "seq", "size")
    found = []
    if "exact" in options.chimeras:
        found.append(chimera.exact_bimeras(rows, options.chimera_skew).where("bimera").select(F.col("unique_id").alias("feature_id")))
    if "denovo" in options.chimeras:
        found.append(chimera.voted_chimeras(rows).select(F.col("query").alias("feature_id")))
    if "reference" in options.chimeras:
        found.append(chimera.voted_reference_chimeras(rows, references).select(F.col("query").alias("feature_id")))
    return reduce(DataFrame.unionByName, found).distinct() if found else features.select("feature_id").limit(0)


def alike(features: DataFrame, references: DataFrame) -> DataFrame:
    """feature_id of features of which a reference (ref_id, seq; of any length, on either strand) holds half, or a part at over 90 %."""
    hits = local_search.local_hits(features.select(F.col("feature_id").alias("query"), "seq"), references.select(F.col("ref_id").alias("target"), "seq"))
    return T.contaminated_queries(hits, by_query=True).select(F.col("query").alias("feature_id"))


def read_runs(spark: SparkSession, sheet: DataFrame, folder: str, options: ReadOptions = ReadOptions()) -> DataFrame:
    """sample_id, read_id, seq, qual, file, and r2, q2 of paired files, of a checked sample sheet's files in ``folder``.

    Samples are told by their files or, where the sheet has barcodes, by what reads begin with. Primers of the sheet, a few
    different ones, are checked and cut.
    """
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    columns = [c for c in ("barcode_sequence", "forward_primer", "reverse_primer", "linker_primer") if c in sheet.columns]
    rows = sheet.select("sample_id", F.split("fastq_file", ",").alias("files"), *columns)
    paired = bool(rows.agg(F.max(F.size("files"))).first()[0] == 2)
    names = sorted({f for r in rows.select("files").distinct().collect() for f in r.files})  # a sheet has thousands of rows at most
    reads = read_fastq(spark, ",".join(f"{folder.rstrip('/')}/{f}" for f in names)).withColumn("name", last(F.col("file")))
    mark = r"(/[12]|[ _][12](:.*)?)$"
    if paired:
        firsts, seconds = (rows.select(last(F.trim(F.col("files")[i])).alias("name"), last(F.trim(F.col("files")[0])).alias("pair")).distinct() for i in (0, 1))
        read = F.regexp_replace("read_id", mark, "")
        one = reads.join(firsts, "name").select("pair", read.alias("read_id"), F.col("seq").alias("r1"), F.col("qual").alias("q1"), "file")
        two = reads.join(seconds, "name").select("pair", read.alias("read_id"), F.col("seq").alias("r2"), F.col("qual").alias("q2"))
        reads = one.join(two, ["pair", "read_id"])
    else:
        reads = reads.select(F.col("name").alias("pair"), "read_id", F.col("seq").alias("r1"), F.col("qual").alias("q1"), "file")
    own = rows.select("sample_id", last(F.trim(F.col("files")[0])).alias("pair"), *columns)
    if "barcode_sequence" in columns:
        begun = reads.withColumnsRenamed({"r1": "seq", "q1": "qual"})
        codes = own.select("sample_id", F.upper("barcode_sequence").alias("barcode"))
        reads = demultiplex(begun, codes, options.max_barcode_errors, options.keep_barcode).withColumnsRenamed({"seq": "r1", "qual": "q1"}).join(own.drop("pair"), "sample_id")
    else:
        reads = reads.join(own, "pair")
    forward = next((c for c in ("forward_primer", "linker_primer") if c in columns), None)
    used = [c for c in (forward, "reverse_primer") if c in columns]
    out = []
    for row in own.select(*used).distinct().collect() if used else [None]:  # as many as primer pairs
        some = reads
        for c in used:
            some = some.where(F.col(c).eqNullSafe(row[c]))
        primers = [(row[c] or "").strip() if row and c in used else "" for c in (forward, "reverse_primer")]
        if paired:
            some = strip_pair_primers(some, *primers, options).withColumnsRenamed({"r1": "seq", "q1": "qual"})
        else:
            some = strip_primers(some.withColumnsRenamed({"r1": "seq", "q1": "qual"}), *primers, options)
        out.append(some.select("sample_id", F.concat_ws("___", "sample_id", "read_id").alias("read_id"), "seq", "qual", "file", *(["r2", "q2"] if paired else [])))
    return reduce(DataFrame.unionByName, out)


def representative_sequences(reads: DataFrame, uniques: DataFrame, features: DataFrame, options: RunOptions) -> DataFrame:
    """feature_id, seq: the merged pair, or first mate, of the best read of each feature; the centroid without one.

    reads: tiered ones with unique seq, read_id, quals and r2; with qual and q2 pairs are merged by their qualities.
    """
    identity = options.backmap_identity or (0.99 if options.clusterer in ("denoise", "dada") else options.identity)
    hits = similarity.similarity_hits(uniques.select(F.col("unique_id").alias("query"), "seq"), features.select(F.col("feature_id").alias("target"), "seq"), identity, options.backmap_coverage, options.kmer)
    of = T.top_hits(hits, 1).select(F.col("query").alias("unique_id"), F.col("target").alias("feature_id")).join(uniques.select("unique_id", "seq"), "unique_id")
    scored = reads.withColumn("mean_quality", S.array_mean(F.col("quals"))).join(of.select("seq", "feature_id"), "seq")
    order, by_quality = F.struct("mean_quality", F.length("seq"), "read_id"), {"qual", "q2"} <= set(reads.columns)
    best = scored.groupBy("feature_id").agg(F.max_by(F.struct(F.col("seq").alias("r1"), "r2", *([F.col("qual").alias("q1"), "q2"] if by_quality else [])), order).alias("best"))
    merged = (similarity.merge_pairs_by_quality if by_quality else similarity.merge_pairs)(best.select("feature_id", "best.*"))
    found = features.select("feature_id", F.col("seq").alias("centroid")).join(merged, "feature_id", "left")
    return found.select("feature_id", F.coalesce("merged", "r1", "centroid").alias("seq"))


def run(
    reads: DataFrame,
    references: DataFrame,
    taxonomy: DataFrame,
    options: RunOptions = RunOptions(),
    off_target: DataFrame | None = None,
    phix: DataFrame | None = None,
    in_target: DataFrame | None = None,
    more_databases: list[tuple[DataFrame, DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """reads: sample_id, read_id, seq, qual (r2 of pairs, run of several sequencing runs). Returns uniques, features, counts, cleaned, taxonomy, ranks.

    Contaminants are features like a reference of ``off_target`` or ``phix`` (ref_id, seq), but for those like one of
    ``in_target``. With pairs, ``representatives`` are the merged reads that stand for the features.
    """
    own = [c for c in ("sample_id", "read_id", "seq", "qual", "tier", "quals", "r2", "q2", "run") if c in reads.columns or c in ("tier", "quals")]
    tiers = checkpointed(read_tiers(reads, options.reads).where("tier <> 'rejected'").select(*own))
    uniques = checkpointed(unique_ids(dereplicate(tiers)))
    high = unique_ids(dereplicate(tiers.where("tier = 'high'")))
    if options.clusterer == "dada":
        run_of = F.col("run") if "run" in reads.columns else F.lit("")
        features = checkpointed(denoise_by_errors(tiers.where("tier = 'high'").select(run_of.alias("run"), "read_id", "seq", "quals"), options))
    else:
        features = checkpointed(find_features(high, options))
    counts = checkpointed(count_features(uniques, features, options))
    if options.crosstalk:
        counts = checkpointed(matrix.without_crosstalk(counts, options.crosstalk))
    kept = features
    if options.check_chimeras and options.clusterer not in ("denoise", "dada"):
        kept = checkpointed(features.join(chimeric(features, references, options), "feature_id", "left_anti"))
    if options.curate:
        counts, merged = curate.curate_by_cooccurrence(counts, similarity.self_matches(kept, k=8))
        kept = kept.join(merged, "feature_id", "left_anti")
    none = features.select("feature_id").limit(0)
    flags = [none.withColumn("filter", F.lit("offTarget"))]
    for name, known in (("offTarget", off_target), ("phiX", phix)):
        if known is not None and not (name == "offTarget" and options.keep_offtargets):
            flags.append(alike(kept, known).withColumn("filter", F.lit(name)))
    rescued = alike(kept, in_target) if in_target is not None else none
    cleaned = checkpointed(matrix.clean_matrix(counts, kept, reduce(DataFrame.unionByName, flags), rescued, options.prefix))
    good = cleaned.where("status = 'kept'").select("feature_id", "new_id")
    final = counts.join(good, "feature_id").select(F.col("new_id").alias("feature_id"), "sample_id", "count")
    named = kept.join(good, "feature_id").select(F.col("new_id").alias("feature_id"), "seq", "size")
    lineages = checkpointed(assign_lineages(named, [(references, taxonomy), *(more_databases or [])], options))
    if options.merge_variants:
        final, _ = curate.merge_alike_variants(final, lineages, similarity.self_matches(named, identity=0.97, k=options.kmer))
        named = named.join(final.select("feature_id").distinct(), "feature_id", "left_semi")
    out = {"uniques": uniques, "features": named, "counts": final, "cleaned": cleaned, "taxonomy": lineages, "ranks": matrix.rank_rollup(final, lineages)}
    if "r2" in reads.columns:
        out["representatives"] = representative_sequences(tiers, uniques, kept.join(good, "feature_id").select(F.col("new_id").alias("feature_id"), "seq"), options)
    return out
