import os
import subprocess
import sys
import textwrap
from pathlib import Path

from daytally.session import SHUFFLE_CLEANUP_KEY, shuffles_dropped


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY)
    with shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == before


def test_a_write_leaves_no_shuffle_files(tmp_path):
    """In a session of its own, so that its block folders are known."""
    script = textwrap.dedent(
        f"""
        import time
        from pathlib import Path
        from daytally.session import local_session, shuffles_dropped
        spark = local_session(2, 4, **{{"spark.local.dir": "{tmp_path}/local"}})
        def files():
            return sum(1 for p in Path("{tmp_path}/local").rglob("shuffle_*.data"))
        rows = spark.range(100000).selectExpr("id % 1000 AS k").groupBy("k").count()
        rows.write.parquet("{tmp_path}/kept")
        assert files() > 0
        held = files()
        with shuffles_dropped(spark):
            rows.write.parquet("{tmp_path}/dropped")
        until = time.time() + 20
        while files() > held and time.time() < until:  # they are removed in the background
            time.sleep(0.2)
        assert files() == held, (files(), held)
        assert spark.read.parquet("{tmp_path}/dropped").count() == 1000
        """
    )
    done = subprocess.run(
        [sys.executable, "-c", script],
        cwd=Path(__file__).resolve().parent.parent,
        env=os.environ | {"SPARK_LOCAL_DIRS": f"{tmp_path}/local"},  # where it is set, it goes before spark.local.dir
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert done.returncode == 0, done.stderr[-2000:]
