import os
import shutil
import subprocess
import sys

from __spark_entry__ import entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["title", "count", "rank"]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def listed(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": folder})
    assert done.returncode == 0, done.stderr
    return [set(line.split()) for line in done.stdout.splitlines()[-2:]]


def test_queries_without_the_training_data_operators(tmp_path):
    from tastemap.plans import ORACLES, QUERIES
    own = set(ORACLES) & set(QUERIES)
    for keep_pipeline in (True, False):
        folder = tmp_path / str(keep_pipeline)
        shutil.copytree(os.path.join(ROOT, "tastemap"), folder / "tastemap", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if keep_pipeline else [])):
            if os.path.exists(os.path.join(ROOT, name)):
                shutil.copy(os.path.join(ROOT, name), folder)
        assert listed(str(folder)) == [set(QUERIES), own]
    assert all(a >= b for a, b in zip(listed(ROOT), [set(QUERIES), own]))
