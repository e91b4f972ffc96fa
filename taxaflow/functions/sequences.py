"""Column expressions on nucleotide strings and quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements (fixed values).
IUPAC = "ACGTURYKMBDHVSWNacgturykmbdhvswn"
COMPLEMENT = "TGCAAYRMKVHDBSWNtgcaayrmkvhdbswn"
#: Bases that an IUPAC code stands for, as regular-expression classes.
IUPAC_CLASS = {
    "A": "A", "C": "C", "G": "G", "T": "[TU]", "U": "[TU]", "R": "[AG]", "Y": "[CTU]", "K": "[GTU]", "M": "[AC]", "S": "[CG]", "W": "[ATU]",
    "B": "[CGTU]", "D": "[AGTU]", "H": "[ACTU]", "V": "[ACG]", "N": "[ACGTUN]",
}


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def dna_letters(text: Column) -> Column:
    """Upper-cased A, C, G and T of any text."""
    return F.upper(F.regexp_replace(text, "[^acgtACGT]+", ""))


def rna_to_dna(seq: Column) -> Column:
    return F.translate(seq, "Uu", "Tt")


def mask_non_acgt(seq: Column) -> Column:
    return F.regexp_replace(F.translate(seq, "acgt", "ACGT"), "[^ACGT]", "N")


def ambiguous_bases(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[ACGT]", ""))


def has_homopolymer_over(seq: Column, longest: int) -> Column:
    """A run of one base longer than ``longest``."""
    return seq.rlike("|".join(f"{b}{{{longest + 1},}}" for b in "ACGT"))


def cut_from_motif(seq: Column, motifs: list[str]) -> Column:
    """Everything from the first occurrence of any motif on goes."""
    return F.regexp_replace(seq, "(?s)(" + "|".join(motifs) + ").*$", "")


def primer_pattern(primer: str) -> str:
    return "".join(IUPAC_CLASS[b] for b in primer.upper())


def phred(quality: Column, offset: int | Column = 33) -> Column:
    """Quality string as an array of integers."""
    return F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset)


def error_probabilities(quals: Column) -> Column:
    return F.transform(quals, lambda q: F.pow(F.lit(10.0), -q.cast("double") / 10.0))


def expected_errors(quals: Column) -> Column:
    return F.aggregate(error_probabilities(quals), F.lit(0.0), lambda a, p: a + p)


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0).cast("bigint"), lambda a, q: a + q)
    return F.try_divide(total.cast("double"), F.size(values))


def window_sums(quals: Column, width: int) -> Column:
    """Sums of all windows of ``width`` neighbours; [] if there is none."""
    places = F.when(F.size(quals) >= width, F.sequence(F.lit(1), F.size(quals) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.aggregate(F.slice(quals, i, width), F.lit(0).cast("bigint"), lambda a, q: a + q))


def first_bad_window(quals: Column, width: int, threshold: float) -> Column:
    """1-based start of the first window whose mean is below the threshold; 0 if there is none."""
    return F.coalesce(F.array_position(F.transform(window_sums(quals, width), lambda s: s < threshold * width), True), F.lit(0)).cast("int")


def accumulated_error_cut(quals: Column, most: float) -> Column:
    """Length of the longest prefix whose summed error probability is ``most`` at most."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(a: Column, p: Column) -> Column:
        total = a["sum"] + p
        ok = a["open"] & (total <= most)
        return F.struct(total.alias("sum"), F.when(ok, a["n"] + 1).otherwise(a["n"]).alias("n"), ok.alias("open"))

    return F.aggregate(error_probabilities(quals), start, step, lambda a: a["n"])


def strip_header(name: Column) -> Column:
    """An id without its size tag and without what follows white space."""
    return F.regexp_replace(F.regexp_replace(name, r"\s.*$", ""), r";size=\d+;?.*$", "")


def size_tag(name: Column) -> Column:
    """Number in ``;size=N`` or in ``_N`` at the end; 1 if there is neither."""
    tagged, tail = F.regexp_extract(name, r";size=(\d+)", 1), F.regexp_extract(name, r"_(\d+)$", 1)
    return F.coalesce(F.nullif(tagged, F.lit("")), F.nullif(tail, F.lit("")), F.lit("1")).cast("bigint")


def with_size(name: Column, size: Column) -> Column:
    return F.concat(strip_header(name), F.lit(";size="), size.cast("string"), F.lit(";"))


def sample_of_read(name: Column, separator: str = "___") -> Column:
    return F.substring_index(name, separator, 1)


def numeric_prefix(name: Column) -> Column:
    """``S_`` before names that begin with a digit."""
    return F.when(name.rlike(r"^\d"), F.concat(F.lit("S_"), name)).otherwise(name)


def feature_of_region(name: Column) -> Column:
    """The feature in an id that a region extractor wrote: what stands before a bar or a size tag, if it is a feature's name."""
    found = F.regexp_extract(name, r"^((?:ASV|z?OTU)_?\d*)(?:;size=\d+)?\|", 1)
    return F.when(found != "", found).otherwise(name)


def clock(seconds: Column) -> Column:
    """Seconds as HH:MM:SS."""
    s = seconds.cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
