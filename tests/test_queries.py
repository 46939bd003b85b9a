"""Every registered query of the library against its DuckDB twin on the smallest tables."""

import pytest
from oracle import compare, connect

from larkspur.plans import catalogue


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_duckdb(spark, small_dir, con, name):
    compare(catalogue.QUERIES[name](spark, small_dir), con, catalogue.ORACLES[name])


def test_queries_without_twin(spark, small_dir):
    scored = catalogue.fit_classifier(spark, small_dir).collect()
    assert scored and all(0 <= r.score <= 1 for r in scored)
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"fit_classifier", "rolling_evaluation"}


def test_classifier_scores_claims_without_timestamp(spark, small_dir):
    claims = catalogue.views.claims(spark, small_dir)
    assert claims.where("timestamp is null").count() > 0
    scored = catalogue.fit_classifier(spark, small_dir)
    assert scored.count() == claims.count() and scored.where("score is null").count() == 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_optional_parts():
    """The entry module imports and keeps its queries if the optional modules are gone."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['larkspur.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50 and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


def test_only_absence_of_the_optional_parts_is_forgiven(tmp_path):
    """A broken dependency of them is an error."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__"
    root = Path(__file__).resolve().parents[1]
    if not (root / "corpus_pipeline.py").exists():
        pytest.skip("the optional parts are gone")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode and "tokenizers" in done.stderr
