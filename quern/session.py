"""What a session needs before tasks can import this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an Arrow batch that a Python worker gets, unless the session sets its own bound.
BATCH_BYTES = 2 << 20
#: Bytes of a table that may be sent to every executor.
SMALL_BYTES = 24 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's source to the executors, once for each application, so that
    Python functions in tasks can import it wherever the driver was started; and bounds Arrow
    batches by bytes, as rows of long texts differ a thousandfold in size."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH, None) in (None, "67108864b", "64m", "64MB"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if not getattr(context, "_quern_shipped", False):
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="quern-src-"), "quern.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.join("quern", os.path.relpath(full, root)))
        context.addPyFile(path)
        context._quern_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only where it is unset and everything runs in one
    process (tests) an own one; on a cluster a local folder would lose tables, so that is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not jsc.isLocal():
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quern-checkpoint-"))
        folder = jsc.getCheckpointDir().get()
    return folder


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to more tasks where its scan has fewer than twice the cores, as a single file has; else as it is.

    So only inputs that are small for the cluster are shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    The copy survives lost executors, cuts the lineage, and is removed when the
    application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quern-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def _width(c: Column, kind: T.DataType) -> Column:
    """About the bytes of a value in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in kind), F.lit(8).cast("bigint"))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
            each = F.transform(c, lambda x: _width(x, kind.elementType))
            return F.coalesce(F.aggregate(each, F.lit(0).cast("bigint"), lambda s, x: s + x), F.lit(0).cast("bigint")) + 16
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("bigint") * 8 + 16
    return F.lit(8).cast("bigint")


def small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df``, marked for broadcast only if its values have at most ``limit`` bytes; adds them up, so
    ``df`` should be durable. A larger one is joined by a shuffle, whose large keys Spark splits."""
    size = sum((_width(df[f.name], f.dataType) for f in df.schema), F.lit(16).cast("bigint"))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df
