import subprocess
import sys
import time
from pathlib import Path

import pytest

from remitlake.sources import shared

ROOT = Path(__file__).resolve().parents[2]


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_the_folder_the_session_names_is_used(spark):
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared.fresh_path(spark, "x") != shared.fresh_path(spark, "x")


def test_without_a_named_folder_the_warehouse_is_used_whatever_the_master():
    assert shared.shared_folder(_Session(spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    assert shared.shared_folder(_Session(spark_sql_warehouse_dir="hdfs:///house")) == "hdfs:///house/_intermediate"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(_Session())


def test_stored_rows_are_the_same_rows_until_they_are_discarded(spark):
    df = shared.stored(spark.range(1000).withColumnRenamed("id", "n"))
    assert sorted(r.n for r in df.collect()) == list(range(1000))
    path = shared.fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    shared.discard(spark, path)
    assert not Path(path).exists()
    shared.dropped(df)
    assert not Path(df.stored_at).exists()


def test_the_folder_is_gone_after_the_session(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from remitlake.sources.shared import stored\n"
        f"s = SparkSession.builder.master('local[1]').config('spark.checkpoint.dir', '{tmp_path}/shared')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', stored(s.range(7)).count())\n"
        "import os; print('DURING', sum(f.startswith('remitlake-') for f in os.listdir(s.conf.get('spark.checkpoint.dir'))))\n"
        "s.stop()\n"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120).stdout
    assert "ROWS 7" in said and "DURING 1" in said
    assert not list((tmp_path / "shared").glob("remitlake-*"))


def _shuffle_files(spark):
    """Files of shuffles in the folders of this JVM's only executor."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*")}


def _released(spark, before):
    """No shuffle file is there that was not before; files are removed a moment after the job."""
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_what_a_step_has_shuffled_is_gone_when_it_ends(spark, tmp_path):
    rows = lambda: spark.range(1000).repartition(4, "id")
    before = _shuffle_files(spark)
    rows().write.parquet(str(tmp_path / "kept"))
    kept = _shuffle_files(spark) - before
    assert kept
    with shared.shuffles_released(spark):
        rows().write.parquet(str(tmp_path / "released"))
    assert _released(spark, before | kept)
    assert spark.read.parquet(str(tmp_path / "released")).count() == 1000


def test_settings_are_as_they_were_after_a_step_even_one_that_fails(spark):
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes")
    usual = [spark.conf.get(n) for n in names]
    with pytest.raises(ZeroDivisionError), shared.small_splits(spark), shared.shuffles_released(spark), shared.few_folders_at_once(spark):
        assert [spark.conf.get(n) for n in names] == ["true", str(shared.OPEN_FILES), str(shared.SPLIT_BYTES)]
        1 / 0
    assert [spark.conf.get(n) for n in names] == usual
