"""The entry file works with and without the optional text package."""
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["starforge", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), any(n.startswith("op") for n in e.queries()), set(e.oracle_sql()) == set(e.queries()))
"""


def test_entry_without_the_text_package():
    out = subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, capture_output=True, text=True, check=True)
    n, has_text_queries, all_have_sql = out.stdout.split()
    assert int(n) >= 42 and has_text_queries == "False" and all_have_sql == "True"


def test_library_does_not_import_the_text_package():
    for path in (ROOT / "starforge").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "starforge.llm" not in path.read_text()


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
print("rows", e.queries()["parse_skill_list"](spark, "/root/testdata/sf0.001").count())
extra = [n for n in e.queries() if n.startswith("op11")]
print("extra", [e.queries()[n](spark, "/root/testdata/sf0.001").count() > 0 for n in extra])
"""


def test_workers_find_the_package_from_any_folder(tmp_path):
    """Queries with Python workers run from a folder where the package cannot be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", ELSEWHERE, str(ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows " in out.stdout and "False" not in out.stdout
