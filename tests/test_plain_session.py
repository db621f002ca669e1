"""Queries run under somebody else's session, from another folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import __spark_entry__ as entry
queries = entry.queries()
print("ROWS", queries["write_kml"](spark, {sf!r}).count(), queries["write_geoparquet"](spark, {sf!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_workers_find_the_package_and_tables_go_to_the_shared_folder(tmp_path):
    shared = tmp_path / "shared"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith(("PYSPARK_", "SPARK_"))}
    script = SCRIPT.format(root=str(ROOT), shared=str(shared), sf=SF)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240
    )
    assert "ROWS 1500 1500" in done.stdout, done.stderr[-2000:]
    assert {p.name.split("-")[0] for p in (shared / "cartoweave").iterdir()} == {"kml", "geoparquet"}
