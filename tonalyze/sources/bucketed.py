"""Bucketed copies of the join inputs, for a shuffle-free corpus join.

``documents JOIN labels`` on ``doc_id`` is the one join here.  When
``labels`` is too large to broadcast, a sort-merge join would shuffle every
document's text.  Writing both tables once, bucketed and sorted by
``doc_id`` with the same bucket count, lets every later join (training,
the predictions reads) run bucket against bucket with no exchange on
either side.  The tables are catalog tables whose files live at the given
path (on a cluster: shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonalyze.sources import tables as T


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    (df.write.mode("overwrite").format("parquet")
       .bucketBy(buckets, key).sortBy(key)
       .option("path", path)
       .saveAsTable(name))


def bucket_inputs(spark: SparkSession, sf_dir: str, buckets: int, root: str,
                  prefix: str = "tonalyze") -> tuple[str, str]:
    """Bucketed ``documents`` and ``labels``; returns their table names."""
    docs, labels = f"{prefix}_documents", f"{prefix}_labels"
    save_bucketed(T.table(spark, sf_dir, "documents"), docs, "doc_id", buckets, f"{root}/documents")
    save_bucketed(T.table(spark, sf_dir, "labels"), labels, "doc_id", buckets, f"{root}/labels")
    return docs, labels
