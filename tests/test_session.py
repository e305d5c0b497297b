import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import models


def _fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_named_folder_is_used():
    assert session.shared_folder(_fake("hdfs://shared/tmp/", "yarn")) == "hdfs://shared/tmp"
    assert session.scratch_path(_fake("s3a://b/t", "yarn"), "x").startswith("s3a://b/t/millrace-x-")


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_fake(None, "spark://host:7077"))


def test_a_local_session_makes_one_folder():
    fake = _fake(None, "local[2]")
    assert session.shared_folder(fake) == session.shared_folder(fake) and os.path.isdir(session.shared_folder(fake))


def test_frozen_row_ids_never_change(spark):
    df = session.freeze(spark.range(1000).repartition(7).withColumn("row", F.monotonically_increasing_id()))
    first = {r.id: r.row for r in df.collect()}
    assert {r.id: r.row for r in df.repartition(3).collect()} == first
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_a_forest_does_not_depend_on_the_layout_of_its_input(spark):
    base = spark.range(3000).select(
        "id", (F.xxhash64("id") % 100).cast("double").alias("a"), (F.xxhash64("id", "id") % 50).cast("double").alias("b")
    ).withColumn("label", ((F.col("a") + F.col("b") > 30) != (F.col("id") % 7 == 0)).cast("int"))
    found = []
    for layout in (base.repartition(1), base.repartition(13).orderBy(F.desc("b"))):
        rows = session.dealt(session.freeze(layout), ["id"], 6)
        model = models.fit_forest(rows, ["a", "b"], trees=5)
        found.append({r.id: r.prediction for r in models.score(model, base, ["a", "b"]).collect()})
    assert found[0] == found[1]
    assert session.dealt(base, ["id"], None) is base


def test_tasks_need_no_installed_package(tmp_path):
    """Executors get the code with the job: the package is importable in the driver only."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "driver.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from millrace.session import local_session\n"
        "from millrace.operators import logistic, profile\n"
        "spark = local_session('t', 2, '1g')\n"
        "df = spark.createDataFrame([(float(i), float(i * i), i % 2) for i in range(20)], 'a double, b double, y int')\n"
        "assert logistic.train(df, ['a', 'b'], 'y', max_iter=3, wide=True).history\n"
        "assert profile.correlation_matrix(df.replace(0.0, None), ['a', 'b']).count() == 4\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_spread_deals_stored_rows_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    stored = session.freeze(spark.range(1000).coalesce(1))
    sizes = [r["count"] for r in session.spread(stored).groupBy(F.spark_partition_id()).count().collect()]
    assert stored.rdd.getNumPartitions() < cores <= len(sizes) and max(sizes) < 2 * min(sizes) and sum(sizes) == 1000
