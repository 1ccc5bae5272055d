"""Work folders, staged tables and files that all executors and the driver can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`.

    Where the setting is missing, a local session gets a temporary folder; on a cluster this is an
    error, because a folder of one machine would lose the rows of all others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="opsloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from it: cuts the lineage, survives lost executors."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session: how finely work is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    store, path = _opened(uri)
    store.create_dir(path, recursive=True)


def open_output(uri: str):
    store, path = _opened(uri)
    return store.open_output_stream(path, compression=None)  # names may end in .zst


def open_input(uri: str):
    """A seekable file."""
    store, path = _opened(uri)
    return store.open_input_file(path)


LOWEST = -(2**63)


def in_order(docs: DataFrame, id_col: str, columns: list) -> tuple[DataFrame, int]:
    """Deal rows into buckets of ascending id, one partition each, without sampling the wide columns.

    Returns (bucket, place, *columns) sorted by (bucket, place, columns); place is the
    id, or the lowest long for a null id. The cuts are approximate quantiles of the id column, so
    buckets hold about equally many rows; the driver sees one number per bucket.
    """
    n = tasks(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("place"), *columns)
    shares = [k / n for k in range(1, n)] or [0.5]
    cuts = sorted(set(rows.agg(F.percentile_approx("place", shares, 20 * n)).first()[0] or []))
    listed = F.array(*[F.lit(c) for c in cuts]) if cuts else None
    bucket = F.size(F.filter(listed, lambda c: c < F.col("place"))) if cuts else F.lit(0)
    dealt = rows.withColumn("bucket", bucket).repartitionById(len(cuts) + 1, F.col("bucket"))
    names = [c for c in rows.columns if c != "place"]
    return dealt.select("bucket", "place", *names).sortWithinPartitions("bucket", "place", *names), len(cuts) + 1
