"""Every registered query beside its SQL in DuckDB."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import ROOT, compare, duck

FOLDER = f"{ROOT}/{os.environ.get('TEST_SF', 'sf0.001')}"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_every_query_of_the_core_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {n for n in entry.queries() if n.startswith("q_")} == {n for n in entry.oracle_sql() if n.startswith("q_")}


@pytest.mark.parametrize("broken", ["folder without modules", "missing package"])
def test_core_registers_without_the_subpackage(tmp_path, broken):
    """What is left when the subpackage is taken out, or when a package it needs is missing."""
    root = Path(entry.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "claimbrook", tmp_path / "claimbrook", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "claimbrook" / "llm").mkdir()
    if broken == "missing package":
        (tmp_path / "claimbrook" / "llm" / "queries.py").write_text("import a_package_that_is_missing\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    core = sum(n.startswith("q_") for n in entry.queries())
    assert told.split() == [str(core), str(core)]
