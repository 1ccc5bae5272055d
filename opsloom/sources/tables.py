"""Readers and sinks: raw text extracts, parquet tables, table replacement."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, below the shared folder of the cluster.

    Without `spark.checkpoint.dir` a local session gets a temporary folder; on a cluster this is an
    error, because a folder of one machine loses the rows of all others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='opsloom-')).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a stage of a longer job to the shared folder and go on from the table.

    Training reads its rows many times; from a table each pass is a short scan, and a lost
    executor never has to run the feature job again.
    """
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def normal_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def read_raw_csv(spark: SparkSession, path: str, header: Sequence[str], source: str, encoding: str = "UTF-8",
                 quoted_breaks: bool = True) -> DataFrame:
    """Delimited file as an all-text table with normal headers and a provenance column.

    The header is given, so the file is read once and never sampled for types. A quoted field may hold line
    breaks, which makes a file one task; without `quoted_breaks` every line is a row and tasks share a file.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.csv(path, header=True, schema=schema, encoding=encoding, multiLine=quoted_breaks, escape='"',
                         enforceSchema=True)
    return raw.toDF(*[normal_header(c) for c in header]).withColumn("source_file", F.lit(source))


def read_raw_json(spark: SparkSession, path: str, fields: Sequence[str], whole_files: bool = False) -> DataFrame:
    """JSON records as texts; "nan" becomes null. One record per line, or with `whole_files` one array per file."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    raw = spark.read.schema(schema).option("multiLine", whole_files).json(path)
    return raw.select(*[F.nullif(F.col(c), F.lit("nan")).alias(c) for c in fields])


def conform_headers(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename a differently headed extract to the common layout and drop empty rows."""
    return df.withColumnsRenamed(dict(names)).na.drop("all")


def union_years(*extracts: DataFrame) -> DataFrame:
    out = extracts[0]
    for other in extracts[1:]:
        out = out.unionByName(other)
    return out


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def overwrite_sink(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the target; with a partition column only the partitions that occur are replaced.

    Rows of a partition value meet in a task, so that not every task writes a file for every value; adaptive
    execution splits a hot value over several tasks and joins small ones, by the advisory partition size.
    """
    writer = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)


def truncate_append_sink(df: DataFrame, table: str) -> None:
    """Empty a table and fill it again; its schema and column order stay."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def catalogue_to_docs(products: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One labelled sentence per product; a missing field is empty."""
    parts = [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("")))
             for label, c in columns.items()]
    return products.withColumn("content", F.concat_ws(" | ", *parts))


# Named character references.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def page_text(html: str | Column) -> Column:
    """Visible text of a page: no comments, scripts, styles or tags; references resolved; blanks merged."""
    out = F.col(html) if isinstance(html, str) else html
    for block in (r"(?is)<!--.*?-->", r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<[^>]*>"):
        out = F.regexp_replace(out, block, " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def extract_page_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", page_text("html").alias("text"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A folder of HTML or text files as (path, text), one row per file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", page_text(F.decode("content", "UTF-8")).alias("text"))
