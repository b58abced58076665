"""Writers: batches, rejects, frame text, reports and run records."""

from __future__ import annotations

import json
import os
import platform
import subprocess
import sys
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

# Tag order of reject records, marker files of stages with rejects.
REJECT_TAGS = [
    "SourceID", "SMILES", "Energy_Ha", "FormalCharge", "Multiplicity", "HOMO_Ha", "LUMO_Ha",
    "HL_Gap_Ha", "PartialCharges", "num_atoms", "num_bonds", "energy_status",
]
MARKERS = {"failed": ".FAILED", "flagged": ".FLAGGED", "rejected": ".REJECTED", "invalid": ".INVALID", "removed": ".REMOVED"}


def write_batches(df: DataFrame, path: str, batch: str = "batch_file") -> None:
    """One folder per batch, rows in order, zstd. Needs the columns of ``split_batches``."""
    (
        df.repartition(batch).sortWithinPartitions(batch, "row_index")
        .write.mode("overwrite").option("compression", "zstd").partitionBy(batch).parquet(path)
    )


def write_rejects(df: DataFrame, path: str, stage: str) -> None:
    """Append the rejects of a stage to one table partitioned by stage."""
    df.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage").parquet(path)


def sdf_text(df: DataFrame, reason: Column | str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """One SDF record per row as ``value``: block, known tags first, other columns, reason.

    Nulls are left out; a row without a block is left out.
    """
    names = [t for t in REJECT_TAGS if t in df.columns]
    scalar = {c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))}
    names += [c for c in df.columns if c in scalar and c not in (*REJECT_TAGS, "mol_block", *skip)]
    values = [(n, F.col(f"`{n}`").cast("string")) for n in names]
    if reason is not None:
        values.append(("reject_reason", F.lit(reason) if isinstance(reason, str) else reason))
    tags = F.array_join(
        F.array_compact(F.array(*[F.concat(F.lit(f">  <{n}>\n"), v, F.lit("\n")) for n, v in values])), "\n"
    )
    return df.where("mol_block is not null").select(F.concat("mol_block", F.lit("\n"), tags, F.lit("\n")).alias("value"))


def write_sdf(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").option("lineSep", "$$$$\n").text(path)


def write_frames(df: DataFrame, path: str, text: str = "frame", batch: str = "batch_file", order: str = "row_index") -> None:
    """Frame texts into one folder per batch; a batch without frames has no folder."""
    rows = df.where(F.col(text).isNotNull())
    (
        rows.repartition(batch).sortWithinPartitions(batch, order)
        .select(F.col(text).alias("value"), batch)
        .write.mode("overwrite").partitionBy(batch).text(path)
    )


def write_report(df: DataFrame, path: str) -> None:
    """A report with one row per key as headed CSV parts; a small one is one part by itself."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def stats_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "mol_block" and not c.startswith("_")]


def write_stats(df: DataFrame, path: str) -> None:
    """Per-row statistics as CSV parts; blocks and underscore columns stay out."""
    df.select(*stats_columns(df)).write.mode("overwrite").option("header", "true").csv(path)


def write_json(spark, values: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def mark(spark, path: str, kind: str, count: int) -> bool:
    """Leave a marker folder beside a stage's rejects when it had any."""
    if count <= 0:
        return False
    spark.createDataFrame([(str(count),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{MARKERS[kind]}")
    return True


# Scheduler and thread variables that a run record keeps where they are set.
RUN_VARIABLES = ("SLURM_JOB_ID", "SLURM_JOB_NAME", "SLURM_NTASKS", "SLURM_CPUS_PER_TASK", "OMP_NUM_THREADS", "CUDA_VISIBLE_DEVICES")


def record_run(spark, path: str, pipeline: str, stage: str, params: dict, counts: dict) -> None:
    """Append one stage record; readers take the metadata of a pipeline from its first record."""
    def git(*args: str) -> str | None:
        try:
            return subprocess.run(["git", *args], capture_output=True, text=True, timeout=5, check=True).stdout.strip()
        except (OSError, subprocess.SubprocessError):
            return None

    status = git("status", "--porcelain")
    row = (
        pipeline, stage, json.dumps(params, default=str), json.dumps(counts, default=str),
        datetime.now(timezone.utc).isoformat(), platform.node(), git("rev-parse", "HEAD"),
        None if status is None else bool(status), json.dumps({"python": platform.python_version(), "spark": spark.version}),
        json.dumps({k: os.environ[k] for k in RUN_VARIABLES if os.environ.get(k)}), json.dumps(sys.argv), os.getcwd(),
    )
    schema = (
        "pipeline string, stage string, params string, counts string, started_at string, "
        "hostname string, git_commit string, git_dirty boolean, versions string, environment string, argv string, cwd string"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)
