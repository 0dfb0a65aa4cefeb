import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_queries_can_be_listed_without_a_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and o.keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_core_does_not_import_the_llm_package():
    for f in (ROOT / "marketloom").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT / "marketloom").parts:
            assert "marketloom.llm" not in f.read_text(), f
