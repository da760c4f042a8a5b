"""Joins and layouts by a key of which a few values hold many rows.

``heavy_keys`` measures them: the values with more than a given share of all
rows, which can be no more than 1 / share values. ``salted_join`` cuts each
heavy value of the fact side into parts of about that share, by a hash of
row columns (never a random number, which a recomputed task would draw anew),
and repeats the other side's rows of the value for each part. AQE can't do this
where an aggregate follows the join, and splits only partitions of some size.

``write_by_key`` stores a table in buckets of the key, each sorted by it, so joins and
aggregates on the key read it without an exchange. Heavy values would each make one
bucket as large as themselves, so their rows are stored beside the buckets, spread
evenly, and go through a partial aggregate or a salted join instead. The two parts
share no key, so results by key are the union of both parts' results.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators.tables import read_if_exists
from sitelens.session import dropping_shuffles, materialize, shared_table_path

_PARTS, _SALT = "_parts", "_salt"
#: Spark's own limit (spark.sql.sources.bucketing.maxBuckets).
MOST_BUCKETS = 100_000
#: Passes that write the buckets, each of at least so many rows.
PASSES, PASS_ROWS = 4, 500_000


def default_share(spark: SparkSession) -> float:
    """An eighth of what a shuffle partition holds on average, so that the parts of
    heavy values, which a hash deals out, fill the partitions evenly."""
    return 1 / (8 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def heavy_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """(key, _parts): the values of ``key`` with more than ``share`` of all rows,
    and into how many parts of that size each is cut. At most 1 / share rows,
    written so that all uses see the same. One map-side combined count."""
    return _heavy(*_key_counts(df, key), key, default_share(df.sparkSession) if share is None else share)


def _key_counts(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows of each value, and of all."""
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    return counts, counts.agg(F.sum("_n")).first()[0] or 0


def _heavy(counts: DataFrame, rows: int, key: str, share: float) -> DataFrame:
    least = rows * share
    return counts.filter((F.col("_n") > F.lit(least)) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("_n") / F.lit(max(least, 1.0))).cast("int").alias(_PARTS))


def _salted(big: DataFrame, key: str, heavy: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col(_PARTS), F.lit(1))).cast("int")
    return big.join(F.broadcast(heavy), key, "left").withColumn(_SALT, part).drop(_PARTS)


def _repeated(small: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    every = F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)
    return small.join(F.broadcast(heavy), key, "left").withColumn(_SALT, F.explode(every)).drop(_PARTS)


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner",
                heavy: DataFrame | None = None) -> DataFrame:
    """``big.join(small, key, how)`` (inner, left, left_semi or left_anti) with the
    heavy values of ``key`` in ``big`` dealt to several tasks."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: rows of the repeated side would come several times")
    heavy = heavy_keys(big, key) if heavy is None else heavy
    return _salted(big, key, heavy, spread_by).join(_repeated(small, key, heavy), [key, _SALT], how).drop(_SALT)


@dataclass
class ByKey:
    """A table stored by a key: ``cold`` in sorted buckets (or something joined to
    them), ``hot`` spread evenly, ``heavy`` the keys of ``hot``; ``name`` is the
    catalog's table of the buckets."""

    key: str
    cold: DataFrame
    hot: DataFrame
    heavy: DataFrame
    name: str
    buckets: int

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def aggregate(self, by_key: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``by_key`` gives results by the key, for either part."""
        return by_key(self.cold).unionByName(by_key(self.hot))

    def forget(self) -> None:
        """Drop the catalog's entry; the files stay."""
        self.hot.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")

    def joined(self, small: DataFrame, spread_by: Sequence[str], how: str = "inner") -> ByKey:
        """Both parts joined with ``small`` on the key; only ``small`` is exchanged for
        the buckets (to as many partitions, or Spark would deal the buckets out again)."""
        cold = self.cold.join(small.repartition(self.buckets, self.key), self.key, how)
        return replace(self, cold=cold, hot=salted_join(self.hot, small, self.key, spread_by, how, self.heavy))


def by_key(table: DataFrame | ByKey, results: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results by key of a plain table or of one stored by key."""
    return table.aggregate(results) if isinstance(table, ByKey) else results(table)


def write_by_key(df: DataFrame, key: str, buckets: int, path: str | None = None, share: float | None = None) -> ByKey:
    """Store ``df`` by ``key`` below ``path`` (a folder of the shared storage). Each
    bucket is written by one task; no task gets more than a bucket's average and a heavy value's share.
    Many rows go in several passes, each over its own buckets, so that the shuffle of
    one pass is on disk at a time; ``df`` is read by each."""
    spark = df.sparkSession
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"{buckets} buckets; Spark takes 1 to {MOST_BUCKETS}")
    path = (path or shared_table_path(spark, "by_key")).rstrip("/")
    counts, rows = _key_counts(df, key)
    found = _heavy(counts, rows, key, 1 / buckets if share is None else share)
    found.write.mode("overwrite").parquet(f"{path}/heavy")
    heavy = spark.read.schema(found.schema).parquet(f"{path}/heavy")
    name = f"by_key_{uuid.uuid4().hex[:12]}"
    cold = df.join(F.broadcast(heavy), key, "left_anti")
    passes = max(1, min(PASSES, buckets, -(-rows // PASS_ROWS)))
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # as Spark deals rows to tasks and to buckets: one file a bucket
    with dropping_shuffles(spark):
        for i in range(passes):
            writer = (cold.filter(bucket % passes == i).repartition(buckets, key).write.option("compression", "zstd")
                      .bucketBy(buckets, key).sortBy(key))
            (writer.mode("append") if i else writer.mode("overwrite").option("path", f"{path}/cold")).saveAsTable(name)
    df.join(F.broadcast(heavy), key, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    note = [(key, buckets, df.schema.json())]
    spark.createDataFrame(note, "key string, buckets int, schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return ByKey(key, spark.table(name), spark.read.schema(df.schema).parquet(f"{path}/hot"), heavy, name, buckets)


def read_by_key(spark: SparkSession, path: str) -> ByKey | None:
    """What ``write_by_key`` stored at ``path``, also in another application (the
    catalog may have forgotten its table); None if nothing complete is there."""
    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    note = read_if_exists(spark, f"{path}/layout", "key string, buckets int, schema string")
    row = None if note is None else note.first()
    if row is None:
        return None
    schema = StructType.fromJson(json.loads(row["schema"]))
    name = f"by_key_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{row['key']}`) SORTED BY (`{row['key']}`) "
              f"INTO {row['buckets']} BUCKETS LOCATION '{path}/cold'")
    return ByKey(row["key"], spark.table(name), spark.read.schema(schema).parquet(f"{path}/hot"),
                 spark.read.parquet(f"{path}/heavy"), name, row["buckets"])

