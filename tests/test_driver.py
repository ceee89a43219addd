"""The registered streams in a plain session started somewhere else, where Python workers
cannot import this package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "America/New_York").getOrCreate())
for name in ("stream_home_detail_uv", "stream_log_split", "stream_province_order", "dictionary_words"):
    print("ROWS", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_streams_run_outside_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=300)
    found = [l.split("ROWS ")[1] for l in done.stdout.splitlines() if "ROWS " in l]
    assert found == ["stream_home_detail_uv 252", "stream_log_split 2504",
                     "stream_province_order 1451", "dictionary_words 38"], done.stderr[-2000:]
