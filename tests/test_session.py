"""The folder for intermediate data."""

import subprocess
import sys
from pathlib import Path

import pytest

from parcelwise.session import cut_lineage, shared_dir


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, master, **values):
        self.conf = Conf(**values)
        self.sparkContext = type("Context", (), {"master": master})


def test_the_named_folder_is_used():
    assert shared_dir(Session("spark://host", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(master))


def test_a_plain_local_session_works(tmp_path):
    code = (
        "from pyspark.sql import SparkSession; from parcelwise.session import cut_lineage;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate();"
        "print(cut_lineage(s.range(3), 't').count())"
    )
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={**__import__("os").environ, "PYTHONPATH": str(root)},
        capture_output=True, text=True, timeout=180,
    )
    assert done.stdout.strip() == "3", done.stderr[-500:]


def test_written_tables_are_read_back(spark):
    assert cut_lineage(spark.range(5), "t").count() == 5
