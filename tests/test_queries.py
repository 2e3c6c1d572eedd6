"""Every registered query against its SQL on the smallest driver tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES
from conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("left_behind", [(), ("planledger/llm/__pycache__",), ("planledger/llm/__pycache__", "corpus_pipeline.py")])
def test_the_entry_works_without_the_training_data_operators(tmp_path, left_behind):
    """Also where an empty folder stays behind, or the pipeline without its operators."""
    root = Path(entry.__file__).parent
    for name in ("planledger", "checks"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    for name in left_behind:
        (tmp_path / name).mkdir(parents=True) if "." not in name else (tmp_path / name).write_text(
            "from planledger.llm.line_templates import dedup_lines\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
