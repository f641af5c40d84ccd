import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_queries_and_sql_have_the_same_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.oracle_sql()) > 60


def test_imports_without_the_operators_that_may_go(tmp_path):
    for name in ("__spark_entry__.py", "tracemill"):
        (tmp_path / name).symlink_to(REPO / name)
    code = "import sys; sys.modules['tracemill.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 60 and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0]["total_us"] >= rows[-1]["total_us"]
