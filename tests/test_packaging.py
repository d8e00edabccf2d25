"""Functions sent to executors need no copy of the package on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from legworks.operators import ml as M
from legworks.session import get_session
spark = get_session(master="local[2]", shuffle_partitions=2)
df = spark.range(200).selectExpr("id", "double(id % 17) AS a", "double(id % 5) AS b")
out = M.anomaly_scores(df, df, ["a", "b"], ["id"], num_trees=5, max_samples=32)
assert out.where("anomaly_score > 0 AND anomaly_score <= 1").count() == 200
print("scored")
"""


def test_udfs_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert "scored" in done.stdout, done.stderr[-2000:]
