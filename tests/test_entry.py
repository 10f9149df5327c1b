import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    import __spark_entry__

    assert len(__spark_entry__.entry(spark).collect()) == 8
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_works_without_llm(tmp_path):
    """The rest imports and answers with the subpackage and its pipeline gone, from another folder."""
    top = tmp_path / "repo"
    shutil.copytree(f"{REPO}/scriptorium", top / "scriptorium", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", top)
    code = f"""
import sys
sys.path.insert(0, {str(top)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
names = e.queries()
assert names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert names["html_to_markdown"](spark, "/root/testdata/sf0.001").count() == 50
"""
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
