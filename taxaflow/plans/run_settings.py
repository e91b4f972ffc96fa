"""Options of a run from the names and values that users of its command line know, or from a settings file."""

from __future__ import annotations

import warnings
from dataclasses import replace

from taxaflow.operators.taxonomy import IDENTITY_STEPS
from taxaflow.plans.amplicon import RunOptions

#: Words and numbers for ways to cluster and to assign lineages (fixed values).
CLUSTERERS = {"1": "size", "uparse": "size", "8": "size", "vsearch": "size", "2": "swarm", "swarm": "swarm", "3": "length", "cdhit": "length", "cd-hit": "length", "6": "denoise", "unoise": "denoise", "unoise3": "denoise", "7": "dada", "dada2": "dada"}
CLASSIFIERS = {"0": "bayes", "rdp": "bayes", "utax": "vote", "sintax": "vote", **dict.fromkeys(("1", "2", "4", "5", "blast", "lambda", "usearch", "vsearch"), "similarity")}
#: What a number says of chimera checks: both, none, by references only, de novo only (fixed values).
CHIMERAS = {"0": ("exact", "denovo", "reference"), "1": (), "2": ("exact", "reference"), "3": ("exact", "denovo")}
#: Names that say how programs run and where files lie, which a cluster's own settings do here (fixed values).
ELSEWHERE = {
    "i", "o", "m", "map", "q", "qual", "barcode", "s", "sdmopt", "t", "thr", "threads", "sdmthreads", "tmp", "tmpdir", "c", "config", "exe", "executionmode", "keeptmpfiles", "extendedlogs",
    "verbosity", "highmem", "usevsearch", "usemini4map", "dada2seed", "toleratecorruptfq", "refdb", "tax4refdb", "offtargetdb", "intargetdb", "recalctaxdb", "savedemultiplex",
}


def _flag(value: str) -> bool:
    if value.strip().lower() not in ("0", "1", "t", "f", "true", "false"):
        raise ValueError(f"{value} is neither yes nor no")
    return value.strip().lower() in ("1", "t", "true")


def _steps(value: str) -> tuple[float, ...]:
    numbers = tuple(float(x) for x in value.split(","))
    if len(numbers) not in (6, 7) or not all(0 <= x < 100 for x in numbers):
        raise ValueError("six or seven percentages from species to phylum, or domain, are parted by commas")
    return numbers if len(numbers) == 7 else (*numbers, IDENTITY_STEPS[-1])


def run_options(settings: dict[str, str], start: RunOptions = RunOptions()) -> RunOptions:
    """``start`` with what ``settings`` say; names are read without leading dashes and in any case. Unknown names are warned of, and so is a threshold of
    a classifier that is not chosen; ``read_settings`` makes such settings of a file."""
    given = {k.lstrip("-").lower(): str(v) for k, v in settings.items()}
    new: dict = {}

    def take(names: tuple[str, ...], field: str, how) -> None:
        for name in names:
            if (value := given.pop(name, None)) is not None:
                new[field] = how(value)

    def word(table: dict):
        def look(value: str):
            if value.lower() not in table:
                raise ValueError(f"{value} is none of {', '.join(table)}")
            return table[value.lower()]

        return look

    take(("cl", "clustering", "uparse"), "clusterer", word(CLUSTERERS))
    take(("doblast", "simbasedtaxo", "taxaligner"), "classifier", word(CLASSIFIERS))
    take(("id",), "identity", float)
    take(("backmap_id",), "backmap_identity", float)
    take(("derepmin",), "minimum", str)
    take(("chim_skew",), "chimera_skew", float)
    take(("deactivatechimeracheck",), "chimeras", word(CHIMERAS))
    take(("lulu",), "curate", _flag)
    take(("asvpostclust",), "merge_variants", _flag)
    take(("xtalk",), "crosstalk", lambda v: 0.01 if _flag(v) else 0.0)
    take(("lca_frac",), "lca_share", float)
    take(("lca_cover",), "lca_cover", float)
    take(("lca_idthresh",), "identity_steps", _steps)
    take(("usebestblasthitonly",), "best_hit_only", _flag)
    take(("taxexcludegrep",), "exclude_taxa", str)
    take(("keepofftargets",), "keep_offtargets", _flag)
    if "chimeras" in new:
        new["check_chimeras"] = bool(new["chimeras"])
    if new.get("clusterer", start.clusterer) in ("denoise", "dada"):
        new.setdefault("prefix", "ASV" if new.get("clusterer") == "dada" else "zOTU")
    classifier = new.get("classifier", start.classifier)
    for names, of in ((("rdp_thr",), "bayes"), (("utax_thr", "sintax"), "vote")):
        for name in names:
            if (value := given.pop(name, None)) is not None:
                if classifier == of:
                    new["confidence"] = float(value)
                else:
                    warnings.warn(f"{name} is not used by the classifier {classifier}", stacklevel=2)
    for name in sorted(set(given) - ELSEWHERE):
        warnings.warn(f"unknown setting {name}", stacklevel=2)
    return replace(start, **new)
