"""The entry point with and without the folders that may go."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"


def run(folder, code=COUNT):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})


@pytest.fixture
def bare(tmp_path):
    """The repository without the folders and the pipeline."""
    shutil.copytree(f"{ROOT}/lexiforge", tmp_path / "lexiforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def test_without_the_folders(bare):
    out = run(bare)
    assert out.returncode == 0 and out.stdout.split()[1:] == ["False", "True"], out.stderr


def test_a_missing_library_leaves_the_rest(bare):
    (bare / "lexiforge/llm").mkdir()
    (bare / "lexiforge/llm/__init__.py").write_text("")
    (bare / "lexiforge/llm/queries.py").write_text("import a_library_that_is_not_there\n")
    (bare / "corpus_pipeline.py").write_text("")
    assert run(bare).stdout.split()[1:] == ["False", "True"]


@pytest.mark.parametrize("broken", ["from lexiforge.storage import no_such_name\n", "import lexiforge.no_such_module\n"])
def test_errors_inside_are_not_swallowed(bare, broken):
    (bare / "lexiforge/llm").mkdir()
    (bare / "lexiforge/llm/__init__.py").write_text("")
    (bare / "lexiforge/llm/queries.py").write_text(broken)
    (bare / "corpus_pipeline.py").write_text("")
    assert run(bare).returncode != 0


def test_intermediate_tables_are_released(spark):
    from lexiforge import storage

    made = storage.materialize(spark.range(3), "kept")
    assert made.count() == 3 and storage.release(spark) >= 1 and not storage._made
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(made.inputFiles()[0])
