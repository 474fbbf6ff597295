"""Size checks, shared-folder tables and null-safe key joins used by the operators.

Two bounds decide between a simple plan and a split one. They are arguments everywhere, so a
cluster with larger executors can raise them and a test can lower them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)

MAX_GROUP_ROWS = 2_000_000
"""Rows one task may sort or buffer as a single group."""

MAX_SMALL_ROWS = 100_000
"""Rows a lookup side may have to be broadcast."""

MAX_SMALL_BYTES = 64 * 1024**2
"""Bytes of values a lookup side may have to be broadcast."""

_local_root: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, named by spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    return _local_root.setdefault(context.applicationId, tempfile.mkdtemp(prefix="parcelwise-"))


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` once to the shared folder and continue from the files.

    Later passes see the same rows in the same split, whatever executors are lost meanwhile."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: text and binary as they are, nested ones as JSON, 8 for all others."""
    sizes = [F.lit(0).cast("long")]
    for field in schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(col), F.lit(0)).cast("long"))
        elif isinstance(field.dataType, NESTED):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("long"))
        else:
            sizes.append(F.lit(8).cast("long"))
    return reduce(add, sizes)


def _measured(df: DataFrame, max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(`df` read back from a written copy, the same as a local frame if it is within both bounds).

    Rows and bytes are counted where they are; nothing is fetched before the counts are known, and a
    large frame is not computed a second time."""
    stored = written(df, "lookup")
    rows, size = stored.agg(F.count(F.lit(1)), F.sum(_row_bytes(df.schema))).first()
    if rows > max_rows or (size or 0) > max_bytes:
        return stored, None
    # Arrow refuses a null struct whose fields are declared non-null, so nested rows come as objects.
    nested = any(isinstance(f.dataType, NESTED) for f in df.schema.fields)
    fetched = stored.collect() if nested else stored.toArrow()
    return stored, df.sparkSession.createDataFrame(fetched, schema=_nullable(df.schema))


def small_rows(
    df: DataFrame, max_rows: int = MAX_SMALL_ROWS, max_bytes: int = MAX_SMALL_BYTES
) -> DataFrame | None:
    """`df` as a local frame if it has at most `max_rows` rows and `max_bytes` bytes, else None."""
    return _measured(df, max_rows, max_bytes)[1]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def lookup_side(df: DataFrame, max_rows: int = MAX_SMALL_ROWS, max_bytes: int = MAX_SMALL_BYTES) -> DataFrame:
    """Join side that is broadcast when its rows and bytes were counted and are few.

    Beyond the bounds the written copy is returned: Spark then shuffles both sides and the adaptive
    skew join splits hot keys."""
    stored, local = _measured(df, max_rows, max_bytes)
    return stored if local is None else F.broadcast(local)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other and key columns appear once."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"__r_{key}")
    condition: Column = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{key}" for key in keys])


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group; the whole frame is one group without keys."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.agg(F.max("__n")).first()[0] or 0
