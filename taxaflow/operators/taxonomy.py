"""Taxonomy from similarity hits: filters, lowest common ancestor, several databases, confidence masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L

#: Identity, in percent, from which species, genus ... domain may be named (fixed values).
IDENTITY_STEPS = (97.0, 95.0, 88.0, 83.0, 81.0, 78.0, 0.0)
MIN_BITS, MAX_EVALUE = 120.0, 1e-14
MIN_LENGTH_SHARE = 0.85
HITS_A_TASK = 500_000


def tasks_for(hits: DataFrame) -> int:
    """Tasks over which hits are dealt by query: short rows become long ones and tables of counts, so a task takes a bounded number of them,
    however many there are. Spark's own partitions hold a number of bytes, or grow where their number is fixed."""
    return max(int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-hits.count() // HITS_A_TASK))


def _dealt(rows: DataFrame, tasks: int | None) -> DataFrame:
    return rows if tasks is None else rows.repartition(tasks, "query")


def significant_identity(pident: Column, bits: Column, evalue: Column) -> Column:
    return F.when((bits >= MIN_BITS) & (evalue <= MAX_EVALUE), pident).otherwise(0.0)


def tolerance(best: Column) -> Column:
    """Percent of identity by which a hit may be below the best one (fixed values)."""
    steps = ((100.0, 0.1), (99.5, 0.25), (99.0, 0.5), (98.0, 1.0), (97.0, 1.25))
    out = F.when(best >= steps[0][0], F.lit(steps[0][1]))
    for at, value in steps[1:]:
        out = out.when(best >= at, F.lit(value))
    return out.otherwise(F.lit(1.5))


def best_by_fold(hits: DataFrame) -> DataFrame:
    """query, best_pident, best_alnlen by the running rule over hits in order of ``position``.

    A hit replaces the best one if it is better in identity and in length, or if it is over 1.4 times as long
    and over 0.9 times as alike. The order matters, so a query's hits (a few hundred at most) are folded in it.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", F.col("pident").cast("double").alias("p"), F.col("alnlen").cast("double").alias("n"))))

    def step(best: Column, hit: Column) -> Column:
        better = (hit["p"] > best["p"]) & (hit["n"] > best["n"])
        once = F.when(better, F.struct(hit["p"].alias("p"), hit["n"].alias("n"))).otherwise(best)
        longer = (hit["n"] > 1.4 * once["n"]) & (hit["p"] > 0.9 * once["p"])
        return F.when(longer, F.struct(hit["p"].alias("p"), hit["n"].alias("n"))).otherwise(once)

    start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("n"))
    best = hits.groupBy("query").agg(F.aggregate(ordered, start, step).alias("best"))
    return best.select("query", F.col("best.p").alias("best_pident"), F.col("best.n").alias("best_alnlen"))


def depth_by_identity(pident: Column, steps: tuple[float, ...] = IDENTITY_STEPS) -> Column:
    missed = F.size(F.filter(F.array(*(F.lit(s) for s in steps)), lambda t: pident < t))
    return (F.lit(len(steps)) - missed).cast("int")


def usable_hits(hits: DataFrame, taxonomy: DataFrame, best: DataFrame | None = None, best_only: bool = False, steps: tuple[float, ...] = IDENTITY_STEPS, tasks: int | None = None) -> DataFrame:
    """Hits near the best one in identity and length, with the ranks of their reference and how many of them count.

    best: query, best_pident, best_alnlen; without it the hit with most identity, then length, found as hits pass by query.
    ``tasks`` (``tasks_for``): hits are dealt over so many by query.
    """
    hits = _dealt(hits, tasks)
    if best is None:
        own = Window.partitionBy("query")
        most = hits.withColumn("best_pident", F.max(F.col("pident").cast("double")).over(own))
        among = most.withColumn("best_alnlen", F.max(F.when(F.col("pident") == F.col("best_pident"), F.col("alnlen").cast("double"))).over(own))
    else:
        among = hits.join(best, "query")
    allowed = F.lit(0.0) if best_only else tolerance(F.col("best_pident"))
    near = among.where((F.col("pident") >= F.col("best_pident") - allowed) & (F.col("alnlen") >= F.lit(MIN_LENGTH_SHARE) * F.col("best_alnlen")))
    named = near.join(taxonomy.select(F.col("ref_id").alias("target"), "ranks"), "target")
    return named.withColumn("depth", F.least(depth_by_identity(F.col("pident"), steps), L.known_depth(F.col("ranks"))))


def missing_references(hits: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Targets without a lineage; there must be none."""
    return hits.select("target").distinct().join(taxonomy.select(F.col("ref_id").alias("target")), "target", "left_anti")


def prefix_votes(usable: DataFrame, tasks: int | None = None) -> DataFrame:
    """query, level (1: domain), path, votes; hits without a domain don't vote. They travel by query as they are, not as up to seven paths each."""
    voters = _dealt(usable.select("query", "ranks", "depth").where((F.col("ranks")[0] != L.UNKNOWN) & (F.col("depth") > 0)), tasks)
    levels = F.explode(F.transform(F.sequence(F.lit(1), F.col("depth")), lambda i: F.struct(i.alias("level"), F.concat_ws(";", F.slice("ranks", 1, i)).alias("path"))))
    return voters.select("query", levels.alias("v")).groupBy("query", F.col("v.level").alias("level"), F.col("v.path").alias("path")).agg(F.count("*").alias("votes"))


def lowest_common_ancestor(usable: DataFrame, share: float = 0.8, tasks: int | None = None) -> DataFrame:
    """query, ranks: one hit gives its own ranks; of several, rank by rank the prefix with enough votes.

    Enough: int(share x n), n is one more than the hits at first, then the votes of the accepted prefix. A
    prefix must extend the accepted one; of two that qualify the one with more votes, then the smaller path, counts.
    Queries are taken whole (a few hundred hits each): those that agree with the accepted prefix vote on its next rank.
    """
    let = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  a value that is computed once

    def go(state: Column, level: Column) -> Column:
        able = F.filter(state["pool"], lambda v: v["depth"] >= level)

        def choose(able: Column) -> Column:
            names = F.transform(able, lambda v: v["ranks"][level - 1])
            tally = let(names, lambda names: F.array_min(F.transform(F.array_distinct(names), lambda x: F.struct((-F.size(F.filter(names, lambda y: y == x))).alias("v"), x.alias("name")))))

            def end(best: Column) -> Column:
                ok = state["open"] & F.coalesce(-best["v"] >= F.floor(F.lit(float(share)) * state["n"]), F.lit(False))
                pool = F.when(ok, F.filter(able, lambda v: v["ranks"][level - 1] == best["name"])).otherwise(state["pool"])
                return F.struct(pool.alias("pool"), F.when(ok, -best["v"]).otherwise(state["n"]).alias("n"), F.when(ok, level).otherwise(state["depth"]).alias("depth"), ok.alias("open"))

            return let(tally, end)

        return let(able, choose)

    rows = _dealt(usable.select("query", "depth", "ranks"), tasks).groupBy("query").agg(F.collect_list(F.struct("depth", "ranks")).alias("found"))
    voters = F.filter("found", lambda v: (v["ranks"][0] != L.UNKNOWN) & (v["depth"] > 0))
    start = F.struct(voters.alias("pool"), (F.size("found") + 1).alias("n"), F.lit(0).alias("depth"), F.lit(True).alias("open"))
    walked = rows.withColumn("end", F.aggregate(F.array(*(F.lit(i) for i in range(1, 8))), start, go))
    several = F.when(F.col("end.depth") == 0, L.no_lineage()).otherwise(L.masked_from(F.col("end.pool")[0]["ranks"], F.col("end.depth")))
    single = L.masked_from(F.col("found")[0]["ranks"], F.col("found")[0]["depth"])
    return walked.select("query", F.when(F.size("found") == 1, single).otherwise(several).alias("ranks"))


def assign_by_similarity(queries: DataFrame, hits: DataFrame, taxonomy: DataFrame, share: float = 0.8, best_only: bool = False, steps: tuple[float, ...] = IDENTITY_STEPS, tasks: int | None = None) -> DataFrame:
    """query, ranks of every query; those without a usable hit are unknown. hits need ``position`` (file order)."""
    usable = usable_hits(hits, taxonomy, best_by_fold(_dealt(hits, tasks)), best_only, steps, tasks)
    return queries.select("query").distinct().join(lowest_common_ancestor(usable, share, tasks), "query", "left").withColumn("ranks", F.coalesce("ranks", L.no_lineage()))


def first_database(assigned: DataFrame) -> DataFrame:
    """Of several databases' assignments (query, db_rank, ranks) the first one with a known domain; else unknown."""
    known = F.min(F.when(F.col("ranks")[0] != L.UNKNOWN, F.struct("db_rank", "ranks")))
    best = assigned.groupBy("query").agg(known.alias("b"))
    return best.select("query", F.col("b.db_rank").alias("db_rank"), F.coalesce("b.ranks", L.no_lineage()).alias("ranks"))


def assign_by_databases(queries: DataFrame, databases: list[tuple[DataFrame, DataFrame]], share: float = 0.8) -> DataFrame:
    """Databases (hits, taxonomy) in order of priority; all are one plan, and the first that knows the domain counts."""
    parts = [assign_by_similarity(queries, hits, tax, share).withColumn("db_rank", F.lit(i)) for i, (hits, tax) in enumerate(databases)]
    return first_database(reduce(DataFrame.unionByName, parts))


def mask_confidence(classified: DataFrame, threshold: float = 0.8, species: bool = False) -> DataFrame:
    """Ranks below the threshold become unknown, each by itself; the species always, unless ``species``."""
    ranks = L.mask_by_confidence(F.col("ranks"), F.col("confidence"), threshold)
    if not species:
        ranks = L.masked_from(ranks, F.lit(6))
    return classified.withColumn("ranks", ranks)


def failed_classifications(classified: DataFrame, threshold: float = 0.8, rank: int = 2, in_target: DataFrame | None = None) -> DataFrame:
    """Features whose confidence at a rank (2: phylum) is too low, but for those found in target."""
    failed = classified.where(F.col("confidence")[rank - 1] < F.lit(threshold).cast("double")).select("feature_id")
    return failed if in_target is None else failed.join(in_target.select("feature_id"), "feature_id", "left_anti")


def exclude_taxa(taxonomy: DataFrame, pattern: str, in_target: DataFrame | None = None) -> DataFrame:
    """Lineages that match the pattern become unknown, but for features found in target."""
    hit = F.concat_ws(";", "ranks").rlike(pattern)
    if in_target is None:
        return taxonomy.withColumn("ranks", F.when(hit, L.no_lineage()).otherwise(F.col("ranks")))
    marked = taxonomy.join(in_target.select("feature_id").distinct().withColumn("_in", F.lit(True)), "feature_id", "left")
    return marked.withColumn("ranks", F.when(hit & F.col("_in").isNull(), L.no_lineage()).otherwise(F.col("ranks"))).drop("_in")


def top_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query: identity, alignment length, target. Ties end in the target's order."""
    order = Window.partitionBy("query").orderBy(F.desc("pident"), F.desc("alnlen"), "target")
    return hits.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def merge_same_target(hits: DataFrame) -> DataFrame:
    """Hits of one query on one target as one: lengths and bits summed, identity averaged."""
    return hits.groupBy("query", "target").agg(F.avg("pident").alias("pident"), F.sum("alnlen").alias("alnlen"), F.sum("bits").alias("bits"))


def contaminated_queries(paf: DataFrame, by_query: bool = False) -> DataFrame:
    """Queries with an alignment of over half the target's length (``by_query``: the query's) or over 90 % identity."""
    length = "query_len" if by_query else "target_len"
    return paf.where((F.col("matches") > 0.5 * F.col(length)) | (F.col("matches") / F.col("alnlen") > 0.9)).select("query").distinct()


def strand_votes(hits: DataFrame, least: int = 20, share: float = 0.9) -> DataFrame:
    """plus, minus, strand: of over ``least`` hits the strand that more than ``share`` of them have, else both."""
    forward = (F.col("qstart") < F.col("qend")) == (F.col("tstart") <= F.col("tend"))
    n = hits.agg(F.count_if(forward).alias("plus"), F.count_if(~forward).alias("minus"))
    part = F.col("plus") / (F.col("plus") + F.col("minus"))
    enough = F.col("plus") + F.col("minus") > least
    return n.withColumn("strand", F.when(enough & (part > share), "plus").when(enough & (part < 1 - F.lit(share)), "minus").otherwise("both"))


def with_reference_lineages(assigned: DataFrame, links: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """feature_id, ranks: features linked to a reference (feature_id, ref_id) take its lineage, whatever was found for them."""
    of = links.join(taxonomy.select("ref_id", F.col("ranks").alias("own")), "ref_id").select("feature_id", "own")
    return assigned.select("feature_id", "ranks").join(of, "feature_id", "full").select("feature_id", F.coalesce("own", "ranks").alias("ranks"))
