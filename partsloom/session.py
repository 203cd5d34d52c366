"""Session helpers: table access, stages, size-checked broadcasts and joins on hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as JSON) up to which a lookup table may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16_000_000
#: A key with more than one in HOT of all rows is salted; there are fewer than HOT such keys.
HOT = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folder of this application's stages, by application.
_folders: dict[str, str] = {}


def stage_folder(spark: SparkSession) -> str:
    """The application's folder for stages, below the shared folder the cluster names; only where none
    is set, in local mode, a temporary one. It is deleted when the program ends."""
    sc = spark.sparkContext
    if sc.applicationId not in _folders:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        current = sc._jsc.sc().getCheckpointDir()
        if not shared and current.isDefined():
            shared = current.get()
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = shared or tempfile.mkdtemp(prefix="partsloom-stages-")
        _folders[sc.applicationId] = f"{shared.rstrip('/')}/partsloom-{sc.applicationId}"
        atexit.register(drop_stages, spark)
    return _folders[sc.applicationId]


def drop_stages(spark: SparkSession) -> None:
    """Deletes the application's stages; frames that read them can't be used afterwards."""
    try:
        folder = _folders.pop(spark.sparkContext.applicationId, None)
        if folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a Parquet stage to the shared folder and read it back: later branches share one
    evaluation, read only the columns they need, and find the rows again when an executor is lost."""
    path = f"{stage_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes as JSON) of a frame that is cheap to read."""
    rows, width = df.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return rows, width or 0


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when `df` has been measured to be within `max_rows` and `max_bytes`.

    `df` should be cheap to read (a stage). Above the bounds no hint is given, and
    the join that follows shuffles both sides under adaptive execution.
    """
    rows, width = measured(df)
    return F.broadcast(df) if rows <= max_rows and width <= max_bytes else df


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], hot: int = HOT) -> DataFrame:
    """Inner join of two stages in which a key may hold a large part of `left`.

    Keys with more than one in `hot` of all rows of `left` are salted by the hash of the columns
    `spread`; `right`'s rows of such keys are copied to every salt. The table of hot keys has
    fewer than `hot` rows, so it is broadcast.
    """
    n, salts, salt = fresh_names(left.join(right.limit(0), keys), "_n", "_salts", "_salt")
    counts = left.groupBy(*keys).agg(F.count("*").alias(n))
    rows = left.agg(F.count("*")).first()[0]
    heavy = counts.where(F.col(n) * hot > rows).select(*keys, F.ceil(F.col(n) * hot / F.lit(max(rows, 1))).cast("int").alias(salts))
    heavy = cut_lineage(heavy)
    if heavy.isEmpty():
        return left.join(right, keys)
    heavy = F.broadcast(heavy)
    a = left.join(heavy, keys, "left").withColumn(salt, F.pmod(F.xxhash64(*spread), F.coalesce(salts, F.lit(1))).cast("int")).drop(salts)
    b = right.join(heavy, keys, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1))).drop(salts)
    return a.join(b, [*keys, salt]).drop(salt)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that `df` doesn't use."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
