"""The entry module with and without its optional parts, in copies of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def _copy(to: Path, *without: str) -> set[str]:
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in without:
        path = to / name
        shutil.rmtree(path, ignore_errors=True) if path.is_dir() else path.unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", LIST], cwd=to, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin:/usr/local/bin"})
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


@pytest.mark.parametrize("gone", [("strutwise/llm", "tests/llm"), ("strutwise/llm", "tests/llm", "corpus_pipeline.py")])
def test_core_queries_stay(tmp_path, gone):
    from strutwise.plans.registry import QUERIES

    assert _copy(tmp_path / "repo", *gone) == set(QUERIES)


def test_operators_stay_without_the_pipeline(tmp_path):
    from strutwise.plans.registry import QUERIES

    found = _copy(tmp_path / "repo", "corpus_pipeline.py")
    assert "pipeline" not in found and set(QUERIES) <= found
    if (ROOT / "strutwise" / "llm").is_dir():
        assert len(found) == len(QUERIES) + 13
