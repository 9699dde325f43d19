"""Tables whose rows are stored by a key, so that groupings and joins by that key shuffle nothing.

The rows are dealt to a fixed number of buckets by the hash that Spark itself shuffles by, each bucket sorted by the key.
Beside the data lies a description of that, from which any session can declare the table and read it as it is stored.

A bucket is read by one task, so a key's rows must fit one, as must those of any plan that needs them together; rows that
are only counted or added up, as in the gold tables, stream through it. Where one key holds a great part of all rows, the
plain table with its two-step aggregation is the better one.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from remitlake.sources.shared import _hadoop

#: Hidden from readers by its first letter.
_DESCRIPTION = "_clustering.json"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Write rows by ``key`` to a new folder, one file a bucket; returns them as stored.

    ``then`` makes what is written of the rows, each by itself and with its key as it is, after they have been dealt out.
    The write sorts each bucket.
    """
    spark = df.sparkSession
    files, description = _hadoop(spark, f"{path}/{_DESCRIPTION}")
    if files.exists(description.getParent()):
        raise FileExistsError(path)
    rows = then(df.repartition(buckets, key))
    said = {"key": key, "buckets": buckets, "schema": rows.schema.json()}
    table = _declared(spark, path, said)
    rows.write.insertInto(table)
    out = files.create(description, False)
    try:
        out.write(bytearray(json.dumps(said).encode()))
    finally:
        out.close()
    return spark.table(table)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_clustered`` wrote, in this session or another."""
    files, description = _hadoop(spark, f"{path}/{_DESCRIPTION}")
    source = files.open(description)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()
    return spark.table(_declared(spark, path, said))


def _declared(spark: SparkSession, path: str, said: dict) -> str:
    """The name of a table at a path, declared in this session's catalogue if it is not yet."""
    name, key = f"clustered_{md5(path.encode()).hexdigest()}", f"`{said['key']}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(said["schema"])))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {said['buckets']} BUCKETS LOCATION {_quoted(path)}"
    )
    return name
