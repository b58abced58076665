"""Session settings shared by every job: checkpoints, scans and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A lookup side is broadcast only when it is counted and found at or below this.
BROADCAST_ROWS = 200_000
SALTS = 64
# Keys with more rows than this are salted, the most frequent ones first.
HOT_ROWS = 1_000_000
# Inputs below this per core are spread by a shuffle.
SPREAD_BYTES = 64_000_000
HOT_KEYS = 1000


def local_session(cpus: int | str = "*", app: str = "sparkcurate", partitions: int = 8) -> SparkSession:
    """A session for tests and for the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Test tables are small: keep all cores busy on row-heavy steps.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a local master gets a temporary folder; a cluster must
    name a shared one, because executor-local files do not survive a lost node.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="sparkcurate-ckpt-")
    sc.setCheckpointDir(named)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialize into the reliable checkpoint folder and cut the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back.

    For loops: unlike a checkpoint, the table carries no constraints of earlier rounds, which
    would make planning slower with every round.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when the table has at most ``max_rows`` rows; stops counting beyond it."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str] | str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table to a table with unique keys, safe for hot keys.

    The key table is broadcast when its counted size allows. Otherwise the hottest keys of
    the large side are counted (combined map-side): at most ``HOT_KEYS`` of them are spread
    over ``salts`` tasks each, with their one key row repeated per salt, and all other keys,
    none of which can hold more than one part in ``HOT_KEYS`` of the rows, join plainly.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), keys, how)
    hot = (
        big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > HOT_ROWS)
        .orderBy(F.desc("_c"), *keys).limit(HOT_KEYS).select(*keys, F.lit(salts).alias("_n"))
    )
    found = hot.collect()  # at most HOT_KEYS rows
    if not found:
        return big.join(small, keys, how)
    hot = F.broadcast(big.sparkSession.createDataFrame(found, hot.schema))
    hashed = [c for c, t in big.dtypes if not t.startswith(("map", "variant"))]
    salt = F.when(F.col("_n").isNotNull(), F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    spread = big.join(hot, keys, "left").withColumn("_salt", salt).drop("_n")
    every = F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1)
    salted = small.join(hot, keys, "left").withColumn("_salt", F.explode(every)).drop("_n")
    return spread.join(salted, keys + ["_salt"], how).drop("_salt")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def balanced(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Spread rows over the cores when the input is small. ``source`` tells the size, where joins in ``df`` hide it.

    The row groups of a file bound its parallelism, however many splits there are, so a small file is
    one task however heavy the work per row is. Large inputs are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str((source or df)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key in one partition, in enough partitions for heavy work per row.

    Adaptive execution joins small partitions by bytes, which puts many groups into one task where
    the bytes are few and the work on them is not. A given number is left as it is.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)
