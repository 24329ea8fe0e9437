"""Lost tasks: a load whose first task attempt dies must still write every row once
and report the right row count. Runs in its own process because task retries need
a ``local[N,maxFailures]`` master."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

import pytest

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, sys.argv[1])
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from ledgerlake.session import local_session
    from ledgerlake.sinks import warehouse as W

    spark = local_session("4,3", 4, app="resilience")

    @F.udf(T.LongType())
    def fail_first_attempt(x):
        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        return x

    # clustered: the failing task is in the map stage before the layout shuffle;
    # unclustered (names outside the clustering list): it is in the writing stage itself,
    # together with the observe() metric.
    cols = {"clustered": ("order_id", "customer_id"), "unclustered": ("k", "v")}[sys.argv[3]]
    df = spark.range(0, 10000, numPartitions=4).select(
        fail_first_attempt(F.col("id")).alias(cols[0]), (F.col("id") % 7).alias(cols[1]))
    name = "resilient_" + sys.argv[3]
    out = W.load_table(spark, df, name, sys.argv[2] + "/" + name)
    back = W.read_table(spark, name)
    print(json.dumps({"rows_loaded": out["rows_loaded"], "rows": back.count(),
                      "distinct": back.select(cols[0]).distinct().count()}))
""")


@pytest.mark.parametrize("layout", ["clustered", "unclustered"])
def test_load_survives_a_failed_task(tmp_path, layout):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    res = subprocess.run([sys.executable, str(script), repo, str(tmp_path), layout], capture_output=True,
                         text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "simulated executor loss" in res.stderr  # the failure did happen
    got = json.loads(res.stdout.strip().splitlines()[-1])
    assert got == {"rows_loaded": 10000, "rows": 10000, "distinct": 10000}


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from ledgerlake.session import ensure_checkpoint_dir
    for master, given in (("spark://host:7077", None), ("local-cluster[2,1,1024]", None), ("yarn", "hdfs:///shared")):
        said = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: said[-1] if said else None, setCheckpointDir=said.append,
                             getConf=lambda: SimpleNamespace(get=lambda key, other: given))
        if given is None:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))
        else:
            assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc)) == given
