import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def run_elsewhere(folder, code, *repo):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, *map(str, repo)], cwd=folder, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


NAMES = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(*sorted(e.queries()))
"""


def test_entry_points_without_the_optional_packages(tmp_path):
    skip = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "metastore_db")
    shutil.copytree(REPO, tmp_path / "whole", ignore=skip)
    plain = tmp_path / "plain"
    plain.mkdir()
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(REPO / name, plain / name)
    shutil.copytree(REPO / "catalog", plain / "catalog", ignore=skip)
    shutil.copytree(REPO / "millrace", plain / "millrace", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    without = run_elsewhere(tmp_path, NAMES, plain)
    assert len(without) >= 109 and "pipeline" not in without
    assert not [n for n in without if n.startswith("op")]
    # The pipeline's file alone, without the package that it builds on.
    (plain / "corpus_pipeline.py").write_text("from millrace.llm import toxicity\n")
    assert run_elsewhere(tmp_path, NAMES, plain) == without
    # Where the package is there, what it cannot import is an error and not an absence.
    if (REPO / "millrace/llm").exists():
        (tmp_path / "whole/corpus_pipeline.py").write_text("import no_such_module\n")
        code = NAMES.replace("import __spark_entry__ as e", """
try:
    import __spark_entry__
except ModuleNotFoundError as missing:
    print(missing.name)
    sys.exit(0)
""")
        assert run_elsewhere(tmp_path, code, tmp_path / "whole") == ["no_such_module"]


def test_python_tasks_run_from_any_folder(tmp_path):
    # The driver's session, made without the library's help, in a folder of its own.
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", e.queries()["forest_anomalies"](spark, "/root/testdata/sf0.001").count())
"""
    assert run_elsewhere(tmp_path, code, REPO)[-2] == "rows"
