"""Queries whose workers cannot import the package: it has to travel inside the tasks."""

import os
import pathlib
import subprocess
import sys

REPO = pathlib.Path(__file__).parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as registry
from folioscope.session import build_session
from pyspark.sql import functions as F

spark = build_session("shipping", "local[2]", spark_sql_shuffle_partitions="2", spark_checkpoint_dir={shared!r}, spark_ui_showConsoleProgress="false")

@F.udf("boolean")
def seen(x):
    import importlib.util
    return importlib.util.find_spec("folioscope") is not None

assert not spark.range(1).select(seen("id")).first()[0]
for name in {names!r}:
    assert registry.queries()[name](spark, {sf!r}).count() > 0, name
print("travelled")
"""


def run_elsewhere(names, folder, sf):
    """Run queries in a session of its own, from a folder and with a path that don't hold the package."""
    script = SCRIPT.format(repo=str(REPO), shared=str(folder / "shared"), names=names, sf=sf)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", script], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("travelled"), done.stderr[-3000:]


def test_language_models_travel(tmp_path, sf_dir):
    run_elsewhere(["language_detection", "parse_stage"], tmp_path, sf_dir)
