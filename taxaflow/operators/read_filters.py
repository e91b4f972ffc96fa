"""Quality filters on reads: tiers by options, trimming, primers, barcodes."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, fields, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import sequences as S


#: Names for steps on the way, that no table of reads has.
CUT, START, TURN, FACTS, FILE, OFFSET, SETTLED = (f"read filter {x}" for x in ("cut", "start", "turn", "facts", "file", "offset", "settled"))


@dataclass(frozen=True)
class ReadOptions:
    """Filter options; a negative number or None switches a filter off. ``mid_``: for the middle tier."""

    min_length: int = 200
    max_length: int = 1000
    min_mean_quality: float = 27
    mid_min_length: int = 200
    mid_min_mean_quality: float = 20
    truncate: int = 200
    max_ambiguous: int = 0
    mid_max_ambiguous: int = 1
    max_homopolymer: int = 8
    window: int = 50
    window_threshold: float = 25
    trim_window: int = 20
    trim_threshold: float = 25
    max_accumulated_error: float = 0.95
    mid_max_accumulated_error: float = -1
    max_expected_error: float = 2.7
    alpha: float = 0.005
    max_barcode_errors: int = 0
    max_primer_errors: int = 0
    keep_barcode: bool = False
    keep_primer: bool = False
    adapter: str = ""
    trim_start: int = 0
    phred_offset: int | None = None  # None: found from the data
    require_forward: bool = True
    require_reverse: bool = True
    check_reversed: bool = True
    check_mates: bool = True
    short_amplicon: bool = False
    extensive_primers: bool = False
    pair_header: int = 1
    mid_require_forward: bool | None = None  # None: as for the high tier
    mid_require_reverse: bool | None = None

    def __post_init__(self) -> None:
        if self.window < 1 or self.trim_window < 1 or self.trim_start < 0:
            raise ValueError("windows are at least 1, trim_start at least 0")
        if self.max_length < self.min_length:
            raise ValueError("max_length is below min_length")


#: Presets by platform, as differences from the first (fixed values).
_DEFAULT = ReadOptions()
PRESETS: dict[str, ReadOptions] = {
    "miSeq": _DEFAULT,
    "AVITI": _DEFAULT,
    "miSeq2": replace(_DEFAULT, min_length=100, mid_min_length=170, truncate=170, max_accumulated_error=3.75, max_expected_error=2.5, trim_start=5, require_reverse=False),
    "miSeq_170": replace(_DEFAULT, min_length=170, mid_min_length=170, truncate=170, max_accumulated_error=0.75, max_expected_error=2.5, require_reverse=False, require_forward=False, check_reversed=False),
    "miSeq_ITS": replace(_DEFAULT, min_length=110, mid_min_length=110, truncate=-1, max_accumulated_error=0.75, max_expected_error=2.5),
    "miSeq_cdhit": replace(_DEFAULT, min_length=150, min_mean_quality=28, truncate=-1, max_accumulated_error=1.5, max_expected_error=2.5, require_reverse=False),
    "miSeq_moh": replace(_DEFAULT, min_length=170, min_mean_quality=28, truncate=170, max_accumulated_error=1, max_expected_error=2.5, alpha=0.01, max_barcode_errors=1, max_primer_errors=1, phred_offset=33, require_forward=False),
    "wetland": replace(_DEFAULT, min_length=170, min_mean_quality=28, truncate=170, max_accumulated_error=1, max_expected_error=2.5, alpha=0.01, max_barcode_errors=1, max_primer_errors=1, phred_offset=33, require_reverse=False, require_forward=False),
    "hiSeq": replace(_DEFAULT, min_length=90, max_length=200, min_mean_quality=25, mid_min_length=80, mid_min_mean_quality=18, truncate=90, trim_threshold=0, max_accumulated_error=0.5, max_expected_error=2.5, require_reverse=False, require_forward=False),
    "454": replace(_DEFAULT, min_length=220, mid_min_length=170, truncate=250, mid_max_ambiguous=2, trim_window=25, trim_threshold=23, max_accumulated_error=2.5, max_expected_error=2.5, alpha=-1, adapter="TCAG", phred_offset=33, require_reverse=False, require_forward=False),
    "454_cdhit": replace(_DEFAULT, min_mean_quality=28, truncate=-1, max_accumulated_error=1.2, max_expected_error=2.5, adapter="TCAG", phred_offset=33, require_reverse=False),
    "PacBio_LSSU": replace(_DEFAULT, min_length=900, max_length=2300, mid_min_length=500, truncate=-1, max_ambiguous=2, mid_max_ambiguous=3, max_homopolymer=16, window_threshold=-1, trim_threshold=-1, max_accumulated_error=-1, max_expected_error=-1, phred_offset=33),
    "PacBio_ITS": replace(_DEFAULT, min_length=300, max_length=2000, mid_min_length=300, mid_min_mean_quality=25, truncate=-1, max_ambiguous=2, mid_max_ambiguous=3, max_homopolymer=16, window_threshold=-1, trim_threshold=-1, max_accumulated_error=-1, max_expected_error=-1, phred_offset=33),
    "ONT_LSSU": replace(_DEFAULT, min_length=700, max_length=2000, mid_min_length=500, truncate=-1, max_ambiguous=10, mid_max_ambiguous=15, max_homopolymer=22, window=150, window_threshold=18, trim_window=100, trim_threshold=-1, max_accumulated_error=-1, max_expected_error=-1, max_barcode_errors=1, max_primer_errors=2, phred_offset=33),
}

#: Keys of option files and the fields they set; ``*`` before a key: the middle tier.
OPTION_KEYS = {
    "minSeqLength": "min_length", "maxSeqLength": "max_length", "minAvgQuality": "min_mean_quality", "*minSeqLength": "mid_min_length",
    "*minAvgQuality": "mid_min_mean_quality", "TruncateSequenceLength": "truncate", "maxAmbiguousNT": "max_ambiguous", "*maxAmbiguousNT": "mid_max_ambiguous",
    "maxHomonucleotide": "max_homopolymer", "QualWindowWidth": "window", "QualWindowThreshhold": "window_threshold", "TrimWindowWidth": "trim_window",
    "TrimWindowThreshhold": "trim_threshold", "maxAccumulatedError": "max_accumulated_error", "*maxAccumulatedError": "mid_max_accumulated_error",
    "BinErrorModelMaxExpError": "max_expected_error", "BinErrorModelAlpha": "alpha", "maxBarcodeErrs": "max_barcode_errors", "maxPrimerErrs": "max_primer_errors",
    "keepBarcodeSeq": "keep_barcode", "keepPrimerSeq": "keep_primer", "TechnicalAdapter": "adapter", "TrimStartNTs": "trim_start", "fastqVersion": "phred_offset",
    "RejectSeqWithoutFwdPrim": "require_forward", "RejectSeqWithoutRevPrim": "require_reverse", "CheckForReversedSeqs": "check_reversed",
    "CheckForMixedPairs": "check_mates", "AmpliconShortPE": "short_amplicon", "ExtensivePrimerChecks": "extensive_primers", "PEheaderPairFmt": "pair_header",
    "*RejectSeqWithoutFwdPrim": "mid_require_forward", "*RejectSeqWithoutRevPrim": "mid_require_reverse",
}


#: What a file that does not name the error model has: no such test.
_UNNAMED = replace(_DEFAULT, max_expected_error=-1)


def read_options(lines: list[str], base: ReadOptions = _UNNAMED) -> ReadOptions:
    """Options of a file's lines: key, tab, value; ``#`` begins a comment. Keys without a value keep what ``base`` says;
    unknown keys are named in a warning."""
    kinds = {f.name: f.type for f in fields(ReadOptions)}
    found: dict[str, object] = {}
    for line in lines:
        key, _, value = line.split("#")[0].strip().partition("\t")
        key, value = key.strip(), value.strip()
        if key and key not in OPTION_KEYS:
            warnings.warn(f"unknown option {key}", stacklevel=2)
        name = OPTION_KEYS.get(key)
        if not name or not value and kinds[name] != "str":
            continue
        if name == "phred_offset":
            found[name] = {"1": 33, "2": 64}.get(value)
        elif kinds[name].startswith("bool"):
            found[name] = value in ("T", "1")
        elif kinds[name] == "str":
            found[name] = value
        else:
            found[name] = float(value) if kinds[name] == "float" else int(float(value))
    return replace(base, **found)


def _offset(low: Column, high: Column) -> Column:
    """64 if no quality character is below ``;`` (59) and some are above ``K`` (75), else 33."""
    return F.when((low >= 59) & (high > 75), 64).otherwise(33)


def phred_offset(reads: DataFrame) -> int:
    """The offset of all reads together; 33 without qualities."""
    codes = S.phred(F.col("qual"), 0)
    r = reads.where(F.length("qual") > 0).agg(F.min(F.array_min(codes)).alias("low"), F.max(F.array_max(codes)).alias("high"))
    return r.select(_offset(F.col("low"), F.col("high"))).first()[0]


def phred_offsets(reads: DataFrame) -> DataFrame:
    """file, offset: of each file that reads came from."""
    codes = S.phred(F.col("qual"), 0)
    r = reads.where(F.length("qual") > 0).groupBy("file").agg(F.min(F.array_min(codes)).alias("low"), F.max(F.array_max(codes)).alias("high"))
    return r.select("file", _offset(F.col("low"), F.col("high")).alias("offset"))


def unlikely_errors(quals: Column, most: float, alpha: float) -> Column:
    """Whether the chance of more than ``most`` errors (Poisson-binomial, by base) is over ``alpha``."""

    @F.arrow_udf("boolean")
    def over(values: pa.Array) -> pa.Array:
        out = np.zeros(len(values), bool)
        sizes = np.array([len(v.as_py() or ()) for v in values], np.int64)
        order = np.argsort(sizes, kind="stable")
        for part in np.array_split(order, max(1, int(sizes.sum()) // 2_000_000 + 1)):
            p = np.zeros((len(part), sizes[part].max(initial=0)))  # places after a read's end have no errors
            for row, i in zip(p, part, strict=True):
                row[: sizes[i]] = 10.0 ** (-np.array(values[int(i)].as_py() or (), float) / 10)
            chance = np.zeros((len(part), int(most) + 1))
            chance[:, 0] = 1.0
            for x in p.T[:, :, None]:
                chance[:, 1:] = chance[:, 1:] * (1 - x) + chance[:, :-1] * x
                chance[:, :1] *= 1 - x
            out[part] = 1 - chance.sum(axis=1) > alpha
        return pa.array(out)

    return over(quals)


def _settled(frame: DataFrame, names: list[str]) -> DataFrame:
    """Computes columns once: what follows refers to them instead of repeating their expressions, as a generator is
    neither merged with other projections nor passed by filters."""
    others = [c for c in frame.columns if c not in names]
    return frame.select(*others, F.explode(F.array(F.struct(*names))).alias(SETTLED)).select(*others, f"`{SETTLED}`.*")


def _from(name: str, at: Column) -> Column:
    """A string from a 1-based place on."""
    return F.substring(F.col(name), at, F.length(name))


def trimmed(reads: DataFrame, options: ReadOptions, offset: int | Column = 33) -> DataFrame:
    """Adapter, first bases, the end from the first bad window or over the summed error on, and length are cut. Adds
    ``quals``, the qualities as numbers."""
    seq = F.upper("seq")
    cut = F.lit(options.trim_start) + (F.when(seq.startswith(options.adapter), F.lit(len(options.adapter))).otherwise(0) if options.adapter else F.lit(0))
    others = [c for c in reads.columns if c not in ("seq", "qual", "quals")]
    out = _settled(reads.withColumn("seq", seq).withColumn(CUT, cut), ["seq", CUT])
    out = out.withColumn("seq", _from("seq", F.col(CUT) + 1)).withColumn("qual", _from("qual", F.col(CUT) + 1))
    out = out.withColumn("quals", F.when(F.length("qual") > 0, S.phred(F.col("qual"), offset)).otherwise(F.array().cast("array<int>")))
    out = _settled(out.select(*others, "seq", "qual", "quals"), ["seq", "qual", "quals"])
    keep = F.length("seq")
    if options.trim_threshold > 0:
        bad = S.first_bad_window(F.col("quals"), options.trim_window, options.trim_threshold)
        keep = F.when(bad > 0, F.least(keep, bad - 1)).otherwise(keep)
    if options.max_accumulated_error > 0:
        keep = F.least(keep, S.accumulated_error_cut(F.col("quals"), options.max_accumulated_error))
    if options.truncate > 0:
        keep = F.least(keep, F.lit(options.truncate))
    out = _settled(out.withColumn(CUT, keep), [CUT])
    return out.select(*others, F.substring("seq", F.lit(1), F.col(CUT)).alias("seq"), F.substring("qual", F.lit(1), F.col(CUT)).alias("qual"), F.slice("quals", F.lit(1), F.col(CUT)).alias("quals"))


def read_tiers(reads: DataFrame, options: ReadOptions = _DEFAULT, offset: int | None = None) -> DataFrame:
    """Trims reads and adds ``quals`` and ``tier``: high, mid (relaxed limits), rest (only windows or errors fail) or rejected.

    An offset that neither is given is found from the data, for each ``file`` if reads have one. Columns ``forward_found`` and
    ``reverse_found`` of ``strip_primers`` are asked for where the options require primers. Other columns stay.
    """
    given = offset or options.phred_offset
    columns = [c for c in reads.columns if c not in ("seq", "qual", "quals", "tier")]
    if given or "file" not in reads.columns:
        out = trimmed(reads, options, given or phred_offset(reads))
    else:
        found = phred_offsets(reads).select(F.col("file").alias(FILE), F.col("offset").alias(OFFSET))
        joined = reads.join(found, reads["file"].eqNullSafe(F.col(FILE)), "left").drop(FILE)
        out = trimmed(joined, options, F.coalesce(OFFSET, F.lit(33)))
    out = _settled(out, ["seq", "qual", "quals"])
    sound = F.lit(True) if options.max_homopolymer < 0 else ~S.has_homopolymer_over(F.col("seq"), options.max_homopolymer)
    windows = F.lit(True)
    if options.window_threshold > 0:
        windows = ~F.exists(S.window_sums(F.col("quals"), options.window), lambda s: s < options.window_threshold * options.window)
    if options.max_expected_error > 0 and options.alpha > 0:
        windows = windows & ~unlikely_errors(F.col("quals"), options.max_expected_error, options.alpha)
    facts = F.struct(F.length("seq").alias("n"), S.array_mean(F.col("quals")).alias("mean"), S.ambiguous_bases(F.col("seq")).alias("ambiguous"), sound.alias("sound"), windows.alias("windows"))
    out = _settled(out.withColumn(FACTS, facts), [FACTS])
    n, mean, ambiguous, sound, windows = (F.col(FACTS)[x] for x in ("n", "mean", "ambiguous", "sound", "windows"))
    high = (n >= options.min_length) & (n <= options.max_length) & (mean >= options.min_mean_quality) & (ambiguous <= options.max_ambiguous)
    mid = (n >= options.mid_min_length) & (n <= options.max_length) & (mean >= options.mid_min_mean_quality) & (ambiguous <= options.mid_max_ambiguous)
    for name, strict, relaxed in (("forward_found", options.require_forward, options.mid_require_forward), ("reverse_found", options.require_reverse, options.mid_require_reverse)):
        if name in columns:
            high = high & F.col(name) if strict else high
            mid = mid & F.col(name) if (strict if relaxed is None else relaxed) else mid
    tier = F.when(n.isNull() | (n == 0) | ~sound, "rejected").when(high & windows, "high").when(mid & windows, "mid").when(mid, "rest").otherwise("rejected")
    return _settled(out.withColumn("tier", tier), ["tier"]).select(*columns, "seq", "qual", "quals", "tier")


def mismatches(a: Column, b: Column) -> Column:
    """Places in which two strings of one length differ; null if the lengths differ."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def demultiplex(reads: DataFrame, barcodes: DataFrame, most: int = 0, keep: bool = False) -> DataFrame:
    """Gives reads the sample whose barcode begins them, with at most ``most`` differences (the fewest; ties: none).

    barcodes: sample_id, barcode. What reads begin with is looked up once for all reads that begin alike: two strings with at
    most ``most`` differences agree in one of most + 1 blocks, so barcodes meet them by an equi-join. Reads
    without a sample go; a ``sample_id`` that reads have is replaced, other columns stay.
    """
    named = barcodes.select("sample_id", "barcode").where(F.length("barcode") > 0)
    lengths = [r[0] for r in named.select(F.length("barcode")).distinct().collect()]  # a few
    longest = max(lengths, default=0)
    columns = [c for c in reads.columns if c != "sample_id"]
    if not longest:
        return reads.limit(0).select(*columns, F.lit(None).cast("string").alias("sample_id"))
    starts = reads.select(F.substring("seq", 1, longest).alias("start")).where("start <> ''").distinct()
    begun = starts.withColumn("n", F.explode(F.lit(lengths))).where(F.length("start") >= F.col("n")).withColumn("begin", F.substring("start", F.lit(1), F.col("n")))
    edge = lambda n, i: F.floor(i * n / (most + 1)).cast("int")
    blocks = lambda c, n: F.explode(F.transform(F.sequence(F.lit(0), F.lit(most)), lambda i: F.struct(n.alias("n"), i.alias("i"), F.substring(c, edge(n, i) + 1, edge(n, i + 1) - edge(n, i)).alias("s"))))
    left = begun.select("start", "begin", blocks(F.col("begin"), F.col("n")).alias("block"))
    right = named.select("sample_id", "barcode", blocks(F.col("barcode"), F.length("barcode")).alias("block"))
    near = left.join(right, "block").withColumn("errors", mismatches(F.col("begin"), F.col("barcode"))).where(F.col("errors") <= most)
    best = near.select("start", "sample_id", "barcode", "errors").distinct().groupBy("start").agg(F.min("errors").alias("least"), F.collect_set(F.struct("errors", "sample_id", F.length("barcode").alias("n"))).alias("all"))
    of = best.withColumn("all", F.filter("all", lambda x: x["errors"] == F.col("least"))).where(F.size("all") == 1)
    sure = of.select(F.col("start").alias(START), F.col("all")[0]["sample_id"].alias("sample_id"), F.col("all")[0]["n"].alias(CUT))
    out = reads.select(*columns).join(sure, F.substring("seq", 1, longest) == F.col(START))
    if not keep:
        out = out.withColumn("seq", _from("seq", F.col(CUT) + 1))
        out = out.withColumn("qual", _from("qual", F.col(CUT) + 1)) if "qual" in columns else out
    return out.select(*columns, "sample_id")


def primer_errors(seq: Column, primer: str, at: Column | int = 1) -> Column:
    """Differences of a read from a primer with IUPAC codes, from a 1-based place on; places after its end differ."""
    place = at if isinstance(at, Column) else F.lit(at)
    total = F.lit(0)
    for i, code in enumerate(primer.upper()):
        base = F.substring(seq, place + i, F.lit(1))
        total = total + F.when((base != "") & F.lit(S.IUPAC_CLASS[code].strip("[]")).contains(base), 0).otherwise(1)
    return total


OPEN_PATTERNS = 400  # of a regular expression for a primer with differences


def find_primer(seq: Column, primer: str, most: int = 0) -> Column:
    """First 1-based place where a primer stands with at most ``most`` differences; 0 if there is none. Up to ``OPEN_PATTERNS`` choices of
    the places that may differ are one regular expression, in which these are open."""
    if most == 0:
        return F.regexp_instr(seq, F.lit(S.primer_pattern(primer)))
    if 0 < most < len(primer) and math.comb(len(primer), most) <= OPEN_PATTERNS:
        classes = [S.IUPAC_CLASS[code] for code in primer.upper()]
        opened = ("".join("." if i in places else c for i, c in enumerate(classes)) for places in combinations(range(len(primer)), most))
        return F.coalesce(F.regexp_instr(seq, F.lit(f"(?s)(?:{'|'.join(opened)})")), F.lit(0))
    last = F.length(seq) - len(primer) + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.get(F.filter(places, lambda i: primer_errors(seq, primer, i) <= most), F.lit(0)), F.lit(0))


def turned_primer(primer: str) -> str:
    """The reverse complement of a primer."""
    return "".join(dict(zip(S.IUPAC, S.COMPLEMENT, strict=True))[b] for b in reversed(primer.upper()))


def _turn(frame: DataFrame, seq: str, qual: str, test: Column) -> DataFrame:
    """Reads that pass a test become their reverse complements."""
    out = frame.withColumn(TURN, test)
    out = out.withColumn(seq, F.when(F.col(TURN), S.reverse_complement(F.col(seq))).otherwise(F.col(seq)))
    return out.withColumn(qual, F.when(F.col(TURN), F.reverse(qual)).otherwise(F.col(qual))).drop(TURN)


def strip_primers(reads: DataFrame, forward: str = "", reverse: str = "", options: ReadOptions = _DEFAULT) -> DataFrame:
    """Checks and removes primers; turns reads round whose reverse complement has the forward primer.

    The forward primer begins a read; with ``extensive_primers`` it may stand anywhere, and what is before it goes. A
    reverse primer is looked for, reverse-complemented, in the read; its first place and what follows go. Both may have
    ``max_primer_errors`` differences. Adds ``forward_found`` and ``reverse_found``; reads without a required primer
    are dropped unless the mid tier accepts them.
    """
    most, out = options.max_primer_errors, reads.withColumn("seq", F.upper("seq"))
    if forward:
        place = (lambda seq: find_primer(seq, forward, most)) if options.extensive_primers else (lambda seq: F.when(primer_errors(seq, forward) <= most, 1).otherwise(0))
        here, turned = place(F.col("seq")), place(S.reverse_complement(F.col("seq")))
        out = _settled(out.withColumn(CUT, here).withColumn(START, turned if options.check_reversed else F.lit(0)), [CUT, START])
        turn = (F.col(CUT) == 0) & (F.col(START) > 0)
        out = _turn(out, "seq", "qual", turn).withColumn(CUT, F.greatest(CUT, START)).withColumn("forward_found", F.col(CUT) > 0)
        after = F.when(F.col("forward_found"), F.col(CUT) + (0 if options.keep_primer else len(forward))).otherwise(1)
        out = _settled(out.withColumn(CUT, after), [CUT])
        out = out.withColumn("seq", _from("seq", F.col(CUT))).withColumn("qual", _from("qual", F.col(CUT))).drop(CUT, START)
        if options.require_forward and options.mid_require_forward is not False:
            out = out.where("forward_found")
    if reverse:
        out = _settled(out.withColumn(CUT, find_primer(F.col("seq"), turned_primer(reverse), most)), [CUT])
        out = out.withColumn("reverse_found", F.col(CUT) > 0)
        keep = F.when(F.col("reverse_found"), F.col(CUT) - 1 + (len(reverse) if options.keep_primer else 0)).otherwise(F.length("seq"))
        out = out.withColumn(CUT, keep).withColumn("seq", F.substring("seq", F.lit(1), F.col(CUT))).withColumn("qual", F.substring("qual", F.lit(1), F.col(CUT))).drop(CUT)
        if options.require_reverse and options.mid_require_reverse is not False:
            out = out.where("reverse_found")
    return out


def strip_pair_primers(pairs: DataFrame, forward: str, reverse: str, options: ReadOptions = _DEFAULT) -> DataFrame:
    """Primers of mates (r1, q1, r2, q2): the forward one begins r1, the reverse one r2, each with ``max_primer_errors``
    differences at most.

    With ``check_mates`` mates that were switched change places; with ``short_amplicon`` what follows the other
    mate's primer, where a read runs through the whole amplicon, goes. Adds ``forward_found`` and ``reverse_found``.
    """
    most = options.max_primer_errors
    begins = lambda read, primer: primer_errors(F.upper(read), primer) <= most if primer else F.lit(False)
    out = pairs
    if options.check_mates:
        score = lambda a, b: begins(a, forward).cast("int") + begins(b, reverse).cast("int")
        out = _settled(out.withColumn(TURN, score("r2", "r1") > score("r1", "r2")), [TURN])
        swap = lambda a, b: F.when(F.col(TURN), F.col(b)).otherwise(F.col(a))
        mates = {"r1": swap("r1", "r2"), "q1": swap("q1", "q2"), "r2": swap("r2", "r1"), "q2": swap("q2", "q1")}
        out = out.withColumns(mates).drop(TURN)
    out = _settled(out.withColumn("forward_found", begins("r1", forward)).withColumn("reverse_found", begins("r2", reverse)), ["forward_found", "reverse_found"])
    for read, qual, found, own, other in (("r1", "q1", "forward_found", forward, reverse), ("r2", "q2", "reverse_found", reverse, forward)):
        if options.short_amplicon and other:
            place = find_primer(F.upper(read), turned_primer(other), most)
            out = _settled(out.withColumn(CUT, F.when(place > 0, place - 1).otherwise(F.length(read))), [CUT])
            out = out.withColumn(read, F.substring(read, F.lit(1), F.col(CUT))).withColumn(qual, F.substring(qual, F.lit(1), F.col(CUT))).drop(CUT)
        if not options.keep_primer:
            begin = F.when(F.col(found), len(own)).otherwise(0) + 1
            out = out.withColumn(read, _from(read, begin)).withColumn(qual, _from(qual, begin))
    if options.require_forward and forward:
        out = out.where("forward_found")
    return out.where("reverse_found") if options.require_reverse and reverse else out
