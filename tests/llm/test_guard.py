"""The folders of the corpus operators can go; everything else stays importable."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_entry_without_the_corpus_operators(tmp_path):
    for name in ("ebbline", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import importlib.util as u, __spark_entry__ as e; find = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n in ('ebbline.llm', 'corpus_pipeline') else find(n, *a)\n"
        "q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op') for n in q) and len(q) > 60\n"
        "assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_nothing_else_imports_them():
    for path in (ROOT / "ebbline").rglob("*.py"):
        if "llm" not in path.parts:
            assert "ebbline.llm" not in path.read_text()
