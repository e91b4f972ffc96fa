"""Reference databases brought to one form: ref_id, seq, ranks. Input: the records of ``read_fasta``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.functions.sequences import mask_non_acgt, rna_to_dna


def _padded(ranks):
    return F.slice(F.concat(F.transform(ranks, L.clean_rank), L.no_lineage()), 1, 7)


def from_pr2(records: DataFrame) -> DataFrame:
    """Header fields by bars; ranks are fields 2, 3, 5, 6, 7, 8, 9 (counted from 1)."""
    f = F.split("header", r"\|")
    return records.select(f[0].alias("ref_id"), mask_non_acgt(rna_to_dna(F.col("seq"))).alias("seq"), _padded(F.array(*(F.get(f, F.lit(i)) for i in (1, 2, 4, 5, 6, 7, 8)))).alias("ranks"))


def from_unite(records: DataFrame) -> DataFrame:
    """The lineage is the header's last field by bars."""
    f = F.split("header", r"\|")
    return records.select(f[0].alias("ref_id"), "seq", L.parse_lineage(F.element_at(f, -1)).alias("ranks"))


def from_hitdb(records: DataFrame) -> DataFrame:
    """Lineages without a domain: two phyla are Archaea, all others Bacteria."""
    line = F.regexp_extract("header", r"^\S+\s+(.*)$", 1)
    domain = F.when(line.rlike("Euryarchaeota|Crenarchaeota"), "Archaea").otherwise("Bacteria")
    return records.select("id", "seq", _padded(F.concat(F.array(domain), F.split(line, ";"))).alias("ranks")).withColumnRenamed("id", "ref_id")


def from_silva(records: DataFrame, guide: DataFrame) -> DataFrame:
    """Bacteria and Archaea by position; Eukaryota by a guide (path, rank) that says which rank a prefix of the lineage is.

    Where the guide skips ranks they stay unknown; a species is imputed from the last name if a genus is known.
    """
    line = F.regexp_extract("header", r"^\S+\s+(.*)$", 1)
    rows = records.select(F.col("id").alias("ref_id"), mask_non_acgt(rna_to_dna(F.col("seq"))).alias("seq"), F.split(line, ";").alias("names"))
    by_place = rows.where(F.col("names")[0] != "Eukaryota").select("ref_id", "seq", _padded(F.col("names")).alias("ranks"))
    eukaryota = rows.where(F.col("names")[0] == "Eukaryota")
    prefixes = eukaryota.select("ref_id", F.posexplode("names").alias("i", "name"), "names").withColumn("path", F.concat_ws(";", F.slice("names", 1, F.col("i") + 1)))
    named = prefixes.join(guide.select("path", F.lower("rank").alias("rank")), "path").where(F.col("rank").isin(*L.RANKS))
    found = named.groupBy("ref_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("rank", "name")))).alias("of"))
    joined = eukaryota.join(found, "ref_id", "left")
    ranks = [F.coalesce(F.col("of")[r], F.lit(L.UNKNOWN)) for r in L.RANKS[1:-1]]
    species = F.when((ranks[-1] != L.UNKNOWN) & (F.element_at("names", -1) != ranks[-1]), F.element_at("names", -1)).otherwise(F.lit(L.UNKNOWN))
    return by_place.unionByName(joined.select("ref_id", "seq", _padded(F.array(F.lit("Eukaryota"), *ranks, species)).alias("ranks")))


def read_settings(spark, path: str) -> dict[str, str]:
    """Names and places (of reference tables, say) in a settings file: a word, white space, a value; ``#`` begins a comment.

    A file of a few hundred lines, which the driver reads; quotes are removed and the last value of a name counts.
    """
    lines = [r.value.split("#")[0].replace('"', "").split(None, 1) for r in spark.read.text(path).collect()]
    return {x[0]: x[1].strip() for x in lines if len(x) == 2}
