"""Writers: artifacts that never change once they are there, canonical CSV, and typed empty tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.functions.hashes import canonical, table_digest
from waymark.operators.relational import ContractError


def stamped(df: DataFrame, **digests: str) -> DataFrame:
    """df with the digests that it was made from on every row."""
    return df.withColumns({k: F.lit(v) for k, v in digests.items()})


def write_once(df: DataFrame, path: str) -> str:
    """Writes parquet where nothing is, accepts the same content, refuses another; returns the content's digest."""
    spark = df.sparkSession
    digest = df.agg(table_digest(df, sorted(df.columns)).alias("digest")).first()["digest"]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        there = spark.read.parquet(path)
        old = there.agg(table_digest(there, sorted(there.columns)).alias("digest")).first()["digest"]
        if old != digest:
            raise FileExistsError(f"{path} holds something else")
        return digest
    df.write.mode("errorifexists").parquet(path)
    return digest


def canonical_csv(df: DataFrame, key: str, path: str | Path, encoding: str = "utf-8") -> None:
    """A report for people: rows by key, floats with 17 digits, empty nulls, line feeds; streamed through the driver."""
    show = lambda v: "" if v is None else format(v, ".17g") if isinstance(v, float) else str(v)
    with open(path, "w", encoding=encoding, newline="") as file:
        file.write(",".join(df.columns) + "\n")
        for row in df.orderBy(key).toLocalIterator():
            file.write(",".join(show(v) for v in row) + "\n")


def write_manifest(path: str | Path, content: dict) -> None:
    """JSON that is the same for the same content; a file that says something else is an error."""
    text = json.dumps(json.loads(canonical(content)), indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    file = Path(path)
    if file.exists() and file.read_text(encoding="utf-8") != text:
        raise FileExistsError(f"{path} holds something else")
    file.write_text(text, encoding="utf-8")


def publish(df: DataFrame, folder: str | Path, name: str, key: str, inputs: dict[str, str] | None = None) -> dict:
    """A result as three files: Parquet, a CSV that spreadsheets read as UTF-8, and a manifest with the number of rows,
    the columns, the content's digest and those of its inputs.  The manifest comes last: where it is, all is.

    What is there already stays if it is the same and is an error otherwise."""
    folder = Path(folder)
    digest = write_once(df, str(folder / f"{name}.parquet"))
    written = df.sparkSession.read.parquet(str(folder / f"{name}.parquet")).select(df.columns)
    canonical_csv(written, key, folder / f"{name}.csv", "utf-8-sig")
    manifest = {"name": name, "rows": written.count(), "columns": dict(df.dtypes), "sha256": digest, "inputs": inputs or {}}
    write_manifest(folder / f"{name}.json", manifest)
    return manifest


def verify_inputs(manifest: str | Path, inputs: dict[str, str]) -> None:
    """Refuses a result that wasn't made from inputs of these digests."""
    held = json.loads(Path(manifest).read_text(encoding="utf-8"))["inputs"]
    if wrong := sorted(k for k, v in inputs.items() if held.get(k) != v):
        raise ContractError(f"{manifest} was made from another {', '.join(wrong)}")


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A table without rows, with its types."""
    return spark.createDataFrame([], schema)
