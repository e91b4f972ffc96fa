"""Results written in the forms that other programs of the field read."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions.sequences import numeric_prefix, with_size
from taxaflow.operators.matrix import numbered, rank_rollup, to_wide
from taxaflow.session import checkpointed
from taxaflow.sources.trees import pruned, write_newick


def write_fasta(features: DataFrame, path: str, sized: bool = False, chunks: int | None = None) -> None:
    """Records as text; ``chunks``: so many files of about one size."""
    features = features.repartition(chunks) if chunks else features
    name = with_size(F.col("feature_id"), F.col("size")) if sized else F.col("feature_id")
    features.select(F.concat(F.lit(">"), name, F.lit("\n"), F.col("seq")).alias("value")).write.text(path)


def write_fastq(reads: DataFrame, path: str, by_sample: bool = True, compression: str = "gzip", mate: int | None = None, pair_header: int = 1) -> None:
    """Four-line records, gathered by sample. ``mate``: names get its mark anew, as ``/1`` or, with ``pair_header`` 2, as `` 1:0:``."""
    mark = "" if mate is None else f"/{mate}" if pair_header == 1 else f" {mate}:0:"
    name = F.col("read_id") if mate is None else F.concat(F.regexp_replace("read_id", r"(/[12]|[ _][12](:.*)?)$", ""), F.lit(mark))
    record = F.concat(F.lit("@"), name, F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    columns = [record.alias("value"), *(["sample_id"] if by_sample else [])]
    writer = reads.select(*columns).write.option("compression", compression)
    (writer.partitionBy("sample_id") if by_sample else writer).text(path)


def write_sheet(sheet: DataFrame, path: str) -> None:
    flat = sheet.drop("attrs", "violations").withColumnRenamed("sample_id", "#SampleID")
    order = [c for c in ("sequencing_run", "#SampleID") if c in flat.columns]
    flat.orderBy(*order).write.csv(path, sep="\t", header=True)


def write_matrix(counts: DataFrame, path: str, samples: list[str] | None = None) -> None:
    """Features in order of their names over the files, samples in order over the columns."""
    to_wide(counts, samples).orderBy("feature_id").write.csv(path, sep="\t", header=True)


def write_rank_tables(counts: DataFrame, taxonomy: DataFrame, path: str) -> None:
    rolled = rank_rollup(counts, taxonomy)
    for i, rank in enumerate(L.RANKS[1:], 2):
        own = rolled.where(F.col("rank") == i).groupBy(F.col("path").alias(rank.capitalize())).pivot("sample_id").agg(F.sum("count")).na.fill(0)
        own.orderBy(rank.capitalize()).write.csv(f"{path}/{rank.capitalize()}", sep="\t", header=True)


def write_left_out(counts: DataFrame, cleaned: DataFrame, features: DataFrame, path: str) -> None:
    """Matrices of chimeras and of contaminants under their new names, and the contaminants' sequences.

    cleaned: feature_id, status, new_id of ``clean_matrix``; features: feature_id, seq.
    """
    for status in ("chimera", "contaminant"):
        own = cleaned.where(F.col("status") == status).select("feature_id", "new_id")
        write_matrix(counts.join(own, "feature_id").select(F.col("new_id").alias("feature_id"), "sample_id", "count"), f"{path}/{status}s")
    named = features.join(cleaned.where("status = 'contaminant'").select("feature_id", "new_id"), "feature_id")
    write_fasta(named.select(F.col("new_id").alias("feature_id"), "seq"), f"{path}/contaminants.fasta")


def write_curated(curated: DataFrame, removed: DataFrame, path: str) -> None:
    """The curated matrix and the list of features that were merged away."""
    write_matrix(curated, f"{path}/curated")
    removed.select(F.col("feature_id").cast("string").alias("value")).orderBy("value").write.text(f"{path}/removed")


def write_hierarchy(taxonomy: DataFrame, path: str) -> None:
    named = [F.col("ranks")[i].alias(r.capitalize()) for i, r in enumerate(L.RANKS)]
    taxonomy.select(F.col("feature_id").alias("OTU"), *named).write.csv(path, sep="\t", header=True)


def write_uc(clusters: DataFrame, path: str) -> None:
    """Seeds and hits of (unique_id, centroid) in the ten columns of a cluster file."""
    seed = F.col("unique_id") == F.col("centroid")
    cells = [F.when(seed, "S").otherwise("H"), F.col("centroid"), F.lit("*"), F.lit("*"), F.lit("+"), F.lit("*"), F.lit("*"), F.lit("*"), F.col("unique_id"), F.when(seed, "*").otherwise(F.col("centroid"))]
    clusters.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)


def biom_rows(counts: DataFrame, taxonomy: DataFrame, samples: DataFrame) -> DataFrame:
    """feature_id, json: one row object of a BIOM table with its dense counts in order of sample ids.

    samples: sample_id. A sheet has thousands of samples at most, so a row of counts is small; rows are
    made by tasks and never gathered.
    """
    order = samples.select("sample_id").distinct().agg(F.array_sort(F.collect_set("sample_id")).alias("samples"))  # one row
    cells = counts.groupBy("feature_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", "count"))).alias("of")).crossJoin(F.broadcast(order))
    dense = F.transform("samples", lambda s: F.coalesce(F.element_at("of", s), F.lit(0).cast("bigint")))
    named = cells.join(taxonomy.select("feature_id", "ranks"), "feature_id", "left").withColumn("ranks", F.coalesce("ranks", L.no_lineage()))
    tagged = F.zip_with(F.array(*(F.lit(t) for t in L.TAGS)), F.col("ranks"), lambda t, r: F.concat(t, r))
    row = F.struct(F.col("feature_id").cast("string").alias("id"), F.struct(tagged.alias("taxonomy")).alias("metadata"), dense.alias("data"))
    return named.select("feature_id", F.to_json(row).alias("json"))


def write_biom_parts(counts: DataFrame, taxonomy: DataFrame, samples: DataFrame, path: str) -> None:
    """Row objects as JSON lines and, beside them, the table's head: columns, shape and time."""
    rows = biom_rows(counts, taxonomy, samples)
    rows.select(F.col("json").alias("value")).write.text(f"{path}/rows")
    head = F.struct(
        F.lit("Biological Observation Matrix 1.0.0").alias("format"), F.lit("OTU table").alias("type"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.lit("dense").alias("matrix_type"), F.lit("int").alias("matrix_element_type"), F.col("columns"),
    )
    columns = samples.agg(F.array_sort(F.collect_set(F.struct(F.col("sample_id").cast("string").alias("id")))).alias("columns"))
    columns.select(F.to_json(head).alias("value")).write.text(f"{path}/head")


def write_bundle(counts: DataFrame, taxonomy: DataFrame, samples: DataFrame, path: str, known_domain_only: bool = False, tree: DataFrame | None = None) -> None:
    """Counts, lineages and samples as three Parquet tables; ids that begin with a digit get ``S_``. A tree (of ``read_newick``) is pruned to
    the features that are counted and written as a fourth, and as text."""
    tax = taxonomy.where(F.col("ranks")[0] != L.UNKNOWN) if known_domain_only else taxonomy
    kept = counts.join(tax.select("feature_id"), "feature_id", "left_semi") if known_domain_only else counts
    kept.withColumn("sample_id", numeric_prefix(F.col("sample_id").cast("string"))).write.parquet(f"{path}/otu")
    tax.select("feature_id", *(F.col("ranks")[i].alias(r) for i, r in enumerate(L.RANKS))).write.parquet(f"{path}/tax")
    samples.withColumn("sample_id", numeric_prefix(F.col("sample_id").cast("string"))).write.parquet(f"{path}/samples")
    if tree is not None:
        own = checkpointed(pruned(tree, kept))
        own.write.parquet(f"{path}/tree")
        write_newick(own, f"{path}/newick")


def write_biom(counts: DataFrame, taxonomy: DataFrame, samples: DataFrame, path: str) -> None:
    """One BIOM 1.0 file of all features in order of their names. Tasks write its lines in order, and one task puts the files together, a few
    megabytes at a time, as such a file can't be written otherwise."""
    spark = counts.sparkSession
    rows = biom_rows(counts, taxonomy, samples).select("feature_id", F.from_json("json", "id string, metadata struct<taxonomy:array<string>>, data array<bigint>").alias("r"))
    rows = numbered(rows, [F.col("feature_id")], "n")
    comma = F.when(F.col("n") > 1, ",").otherwise("")
    lines = rows.select("n", F.concat(comma, F.to_json(F.struct("r.id", "r.metadata"))).alias("row"), F.concat(comma, F.to_json("r.data")).alias("data"))
    columns = samples.agg(F.to_json(F.array_sort(F.collect_set(F.struct(F.col("sample_id").cast("string").alias("id"), F.lit(None).cast("string").alias("metadata")))), {"ignoreNullFields": "false"}).alias("c"), F.count_distinct("sample_id").alias("w"))
    shape = lines.agg(F.count("*").alias("h")).crossJoin(columns)  # one row each
    head = F.concat(
        F.lit('{"id":null,"format":"Biological Observation Matrix 1.0.0","format_url":"http://biom-format.org","type":"OTU table","generated_by":"taxaflow","date":"'),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"), F.lit('","matrix_type":"dense","matrix_element_type":"int","shape":['), F.col("h").cast("string"), F.lit(","), F.col("w").cast("string"), F.lit('],"columns":'), F.col("c"), F.lit(',"rows":['),
    )
    part = lambda frame, section, n, value: frame.select(F.lit(section).alias("section"), n.cast("bigint").alias("n"), value.alias("value"))
    text = part(shape, 0, F.lit(0), head).unionByName(part(lines, 1, F.col("n"), F.col("row"))).unionByName(part(spark.range(1), 2, F.lit(0), F.lit('],"data":[')))
    text = text.unionByName(part(lines, 3, F.col("n"), F.col("data"))).unionByName(part(spark.range(1), 4, F.lit(0), F.lit("]}")))
    pieces = f"{path}.parts"
    text.repartitionByRange("section", "n").sortWithinPartitions("section", "n").select("value").write.text(pieces)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    target = str(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString())

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            files, place = fs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", target))
            names = sorted(f.path for f in files.get_file_info(fs.FileSelector(f"{place}.parts")) if f.base_name.startswith("part-"))
            own = f"{place}.{uuid.uuid4().hex}"
            with files.open_output_stream(own) as out:
                for name in names:
                    with files.open_input_stream(name) as lines:
                        while data := lines.read(4_000_000):
                            out.write(data)
            files.move(own, place)
            yield batch

    spark.range(1, numPartitions=1).mapInArrow(put_together, "id long").count()
