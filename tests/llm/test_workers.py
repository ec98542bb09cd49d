"""The operators run where the workers cannot import this package."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from fundtrail.llm import registry
from fundtrail.session import build_session, ensure_checkpoint_dir

def importable(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("fundtrail") is None
        yield batch

spark = build_session("local[4]", conf={"spark.sql.shuffle.partitions": "4"})
spark.sparkContext.setLogLevel("ERROR")
ensure_checkpoint_dir(spark, sys.argv[3])
spark.range(4).mapInArrow(importable, "id long").count()
for name, query in registry.queries().items():
    query(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name)
spark.stop()
"""


def test_every_query_runs_without_the_package_on_the_workers(tmp_path):
    from fundtrail.llm import registry

    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run(
        [sys.executable, str(script), ROOT, SF_SMALL, str(tmp_path / "checkpoint")],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("ran ") == len(registry.queries())
