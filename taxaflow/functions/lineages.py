"""Column expressions on lineages: arrays of seven ranks, ``?`` where a rank is unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")
TAGS = ("k__", "p__", "c__", "o__", "f__", "g__", "s__")
UNKNOWN = "?"


def no_lineage() -> Column:
    return F.array(*(F.lit(UNKNOWN) for _ in RANKS))


def known_depth(ranks: Column) -> Column:
    """Ranks before the first unknown one."""
    at = F.array_position(ranks, UNKNOWN)
    return F.when(at == 0, F.size(ranks)).otherwise(at - 1).cast("int")


def masked_from(ranks: Column, depth: Column) -> Column:
    """Ranks from ``depth`` (0-based) on become unknown."""
    return F.transform(ranks, lambda x, i: F.when(i < depth, x).otherwise(F.lit(UNKNOWN)))


def mask_by_confidence(ranks: Column, confidence: Column, threshold: float) -> Column:
    """Each rank below the threshold becomes unknown, whatever the others are."""
    return F.zip_with(ranks, confidence, lambda r, c: F.when(c < F.lit(threshold).cast("double"), F.lit(UNKNOWN)).otherwise(r))


def prefix_paths(ranks: Column, first: int = 2) -> Column:
    """(rank number, path) for ranks ``first`` to 7; a path joins all ranks down to its own."""
    return F.transform(F.sequence(F.lit(first), F.lit(len(RANKS))), lambda i: F.struct(i.alias("rank"), F.concat_ws(";", F.slice(ranks, 1, i)).alias("path")))


def unassigned(path: Column) -> Column:
    return path.endswith(UNKNOWN)


def clean_rank(rank: Column) -> Column:
    """Without rank tag, quotes and brackets; empty and unidentified become unknown."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(rank), r"^[dkpcofgs]__", ""), r"[\"'\[\]]", "")
    return F.when((bare == "") | bare.rlike("^unidentified"), F.lit(UNKNOWN)).otherwise(bare)


def parse_lineage(line: Column, separator: str = ";") -> Column:
    """Seven cleaned ranks of a joined lineage; missing ones are unknown."""
    parts = F.transform(F.split(F.coalesce(line, F.lit("")), separator), clean_rank)
    return F.slice(F.concat(parts, no_lineage()), 1, len(RANKS))


def tagged(ranks: Column) -> Column:
    tags = F.array(*(F.lit(t) for t in TAGS))
    return F.concat_ws(";", F.zip_with(tags, ranks, lambda t, r: F.concat(t, r)))


def longest_common_prefix(paths: Column) -> Column:
    """Longest common directory of an array of paths."""
    split = F.transform(paths, lambda p: F.split(p, "/"))
    same = lambda a, b: F.size(F.filter(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda i: F.slice(a, 1, i) == F.slice(b, 1, i)))
    return F.concat_ws("/", F.aggregate(split, F.element_at(split, 1), lambda a, b: F.slice(a, 1, same(a, b))))


def common_folder(path: Column) -> Column:
    """Aggregate: the longest folder that all paths of a group have in common. It is that of the first and the last path in an
    order in which the separator comes before all other characters, so no group is gathered."""
    ordered = F.translate(path, "/", "\x01")
    return longest_common_prefix(F.transform(F.array(F.min(ordered), F.max(ordered)), lambda p: F.translate(p, "\x01", "/")))
