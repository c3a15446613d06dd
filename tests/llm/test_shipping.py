"""Tasks find the package although neither the folder nor the path of the driver leads there."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
from tenderlake.llm import licenses
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
docs = spark.createDataFrame([(1, "The MIT License"), (2, None)], "doc_id long, text string")
print("LABELS", sorted((r.doc_id, r.base_labels) for r in licenses.scan_licenses(docs).collect()))
"""


def test_tasks_import_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_")}
    env |= {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    got = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=180)
    assert "LABELS [(1, 'mit'), (2, '')]" in got.stdout, got.stderr[-2000:]
