"""Sessions whose Spark defaults name no shared folder."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from gaugeworks import session

ROOT = str(Path(__file__).resolve().parent.parent)


def run(code, tmp_path):
    """Run Python without any Spark defaults."""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)


def test_local_session_gets_a_folder(tmp_path):
    done = run(
        "from gaugeworks.session import clear_scratch, local_session, scratch_folder, written\n"
        "from pathlib import Path\n"
        "spark = local_session(1, 1)\n"
        "print('rows', written(spark.range(3), 'test').count(), Path(scratch_folder(spark)).exists())\n"
        "clear_scratch(spark)\n"
        "print('left', Path(scratch_folder(spark)).exists())\n", tmp_path)
    assert "rows 3 True" in done.stdout and "left False" in done.stdout, done.stderr[-2000:]


def test_other_sessions_must_name_one(tmp_path):
    done = run(
        "from pyspark.sql import SparkSession\n"
        "from gaugeworks.session import shared_folder\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "shared_folder(spark)\n", tmp_path)
    assert "ValueError: start the session with spark.checkpoint.dir" in done.stderr


def test_what_is_written_leaves_no_shuffle_files(spark):
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before, given = held(), spark.conf.get(session.CLEANUP)
    grouped = session.written(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "grouped")
    assert grouped.count() == 10
    kept = held()
    for _ in range(3):
        session.written(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "grouped")
    assert held() <= kept <= before + 1 and spark.conf.get(session.CLEANUP) == given


def test_passing_copies_are_removed(spark, tmp_path, monkeypatch):
    from gaugeworks import session

    monkeypatch.setattr(session, "scratch_folder", lambda spark: str(tmp_path))
    with session.passing(spark):
        with session.passing(spark):
            first = session.written(spark.range(5), "first")
            inner = session.written(first.where("id > 1"), "inner")
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["inner"]
        outer = session.written(inner.where("id > 2"), "outer")
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["outer"] and outer.count() == 2
    try:
        with session.passing(spark):
            session.written(spark.range(5), "broken")
            raise ValueError("stop")
    except ValueError:
        pass
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["outer"]
