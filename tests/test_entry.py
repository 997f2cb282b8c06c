"""The entry module with and without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import __spark_entry__ as e; print(sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("left_out", [("tabularium/llm", "tests/llm"), ("tabularium/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_optional_parts(tmp_path, left_out):
    for part in ("tabularium", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=lambda folder, names: [
                n for n in names if n == "__pycache__" or str((Path(folder) / n).relative_to(ROOT)) in left_out])
        elif source.exists() and part not in left_out:
            shutil.copy(source, tmp_path / part)
    assert not (tmp_path / "tabularium/llm").exists()
    run = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["0", "True"], run.stderr
