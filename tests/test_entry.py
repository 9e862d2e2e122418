"""The entry point without the optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(folder: Path) -> set[str]:
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True)
    return set(out.stdout.split())


def test_entry_without_optional_part(tmp_path):
    """Without the pipeline's file or the operators' folder the other queries are all there."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    for package in ("lakemill", "workloads"):
        shutil.copytree(ROOT / package, tmp_path / package, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    core = names(tmp_path)
    assert {"items_silver", "silver_incremental"} <= core and not any(n.startswith("op") and n[2].isdigit() for n in core)
    shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    assert names(tmp_path) == core
