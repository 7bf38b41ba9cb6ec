import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
from pyspark.sql import SparkSession
from ledgerline.llm import exact_dedup, simhash
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x")], "doc_id long, text string")
assert exact_dedup.groups(docs, block_bytes=1).count() == 3 and simhash.near_groups(docs, words=3, radius=3).count() == 3
spark.stop()
"""


def test_nothing_is_left_in_the_checkpoint_folder(tmp_path):
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [f for _, _, names in os.walk(tmp_path) for f in names] == []
