import pytest

from taxaflow.plans.amplicon import RunOptions
from taxaflow.plans.run_settings import run_options
from taxaflow.sources.reference_databases import read_settings


def test_settings_become_options(spark, tmp_path):
    (tmp_path / "run.cfg").write_text("CL dada2\n-id 0.98\ntaxAligner 0\nrdp_thr 0.7\nLCA_idthresh 98,96,94,92,90,80\ndeactivateChimeraCheck 2\nlulu 1  # yes\nkeepOfftargets 1\nthreads 12\nderepMin 8:1,4:2\n")
    got = run_options(read_settings(spark, str(tmp_path / "run.cfg")))
    assert (got.clusterer, got.identity, got.classifier, got.confidence, got.prefix) == ("dada", 0.98, "bayes", 0.7, "ASV")
    assert got.identity_steps == (98, 96, 94, 92, 90, 80, 0) and got.chimeras == ("exact", "reference") and got.check_chimeras
    assert got.curate and got.keep_offtargets and got.minimum == "8:1,4:2"


def test_what_is_not_said_stays():
    start = RunOptions(lca_share=0.6)
    assert run_options({}, start) == start
    assert not run_options({"deactivateChimeraCheck": "1"}).check_chimeras


def test_odd_settings():
    with pytest.warns(UserWarning, match="unknown setting nonsense"):
        run_options({"nonsense": "1"})
    with pytest.warns(UserWarning, match="not used"):
        assert run_options({"utax_thr": "0.5"}).confidence == RunOptions().confidence
    for bad in ({"CL": "none"}, {"lulu": "maybe"}, {"LCA_idthresh": "97,95"}, {"id": "1.5"}, {"taxAligner": "9"}):
        with pytest.raises(ValueError):
            run_options(bad)
