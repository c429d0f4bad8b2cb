"""Reading and writing named tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import NULL_MARKERS, blank_to_null

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: read_table(spark, folder, n) for n in names}


def register_tables(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """Load tables and expose each as a temporary view of the same name."""
    frames = load_tables(spark, folder, names)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    markers: Sequence[str] = NULL_MARKERS,
) -> DataFrame:
    """CSV scan with a given schema in which every marker is read as NULL.

    The reader itself knows a single marker, so fields are scanned as text,
    normalised, and cast; a field that does not fit its type becomes NULL.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(as_text).option("header", True).csv(path)
    return raw.select(
        *[blank_to_null(f.name, markers).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def clean_markers(df: DataFrame, cols: Sequence[str] | None = None, markers: Sequence[str] = NULL_MARKERS) -> DataFrame:
    """Null markers to NULL in text columns (all of them by default)."""
    wanted = set(cols) if cols is not None else {c for c, t in df.dtypes if t == "string"}
    return df.select(*[blank_to_null(c, markers).alias(c) if c in wanted else F.col(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_versioned(df: DataFrame, path: str, version: str) -> str:
    """Write one version of a table under ``v=<version>`` and return its folder."""
    target = f"{path}/v={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def write_metrics_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Final metrics as JSON lines (one row per model)."""
    df.write.mode(mode).json(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string")).write.mode(mode).text(path)


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def input_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: number of rows, number of columns, and whether it has any row."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
            (F.col("rows") > 0).alias("ok"),
        )
        for name, df in sorted(frames.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_inputs(frames: Mapping[str, DataFrame], required: int = 1) -> None:
    """Fail when fewer than ``required`` tables are there or one of them is empty."""
    if len(frames) < required:
        raise ValueError(f"{len(frames)} tables found, {required} needed")
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"tables without rows: {', '.join(sorted(empty))}")


class StepCounts:
    """Rows and columns after each step of a flow, counted by the job that writes its result.

    ``watch`` returns the step's DataFrame with an observation on it; later steps build on
    what it returns. Nothing is read twice for the report, and a step whose rows never
    flow (another branch, an empty plan) counts 0.
    """

    def __init__(self) -> None:
        self.steps: list[tuple[str, Observation, int]] = []

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"step-{len(self.steps)}-{step}")
        self.steps.append((step, seen, len(df.columns)))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per step; call it after the flow's job."""
        rows = [(step, int(seen.get.get("rows", 0)), columns) for step, seen, columns in self.steps]
        return spark.createDataFrame(rows, "step string, rows bigint, columns bigint")
