"""Tables from parquet, CSV of unknown dialect, and ZIP archives; and an inventory of source files."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
SEPARATORS = (";", ",", "\t", "|")
#: The reader doesn't take Windows-1252; it differs from Latin-1 in these bytes only.
WINDOWS = {bytes([b]).decode("latin-1"): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


class SourceError(ValueError):
    """A source is missing, ambiguous or not what it must be."""


def unique_file(folder: str | Path, pattern: str) -> Path:
    """The one file that matches; none and several are errors."""
    found = sorted(Path(folder).glob(pattern))
    if len(found) != 1:
        raise SourceError(f"{len(found)} files match {pattern} in {folder}; one is needed")
    return found[0]


def dialect(head: bytes, least_columns: int = 2) -> tuple[str, str]:
    """Encoding and separator by which the first lines fall into most columns."""
    for encoding in ENCODINGS:
        try:
            lines = head.decode(encoding).splitlines()
        except UnicodeDecodeError:
            continue
        widths = {s: [len(r) for r in csv.reader(lines[:20], delimiter=s)] for s in SEPARATORS}
        best = max(SEPARATORS, key=lambda s: (widths[s][0] if widths[s] and len(set(widths[s])) == 1 else 0))
        if widths[best] and widths[best][0] >= least_columns:
            return encoding, best
    raise SourceError("no encoding and separator fit")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV as text columns; its dialect comes from the first lines, which Spark's own reader fetches."""
    encoding, separator = dialect(first_lines(spark, path))
    name = "UTF-8" if encoding.startswith("utf") else "ISO-8859-1"
    df = spark.read.options(header=True, sep=separator, encoding=name, mode="FAILFAST").csv(path)
    if encoding != "cp1252":
        return df
    plain = str.maketrans(WINDOWS)
    return df.select(*[F.translate(F.col(f"`{c}`"), "".join(WINDOWS), "".join(WINDOWS.values())).alias(c.translate(plain)) for c in df.columns])


def first_lines(spark: SparkSession, path: str, lines: int = 20) -> bytes:
    """The first lines of a file as they are: read as Latin-1, which any byte survives."""
    return "\n".join(r["value"] for r in spark.read.options(sep="\0", quote="", encoding="ISO-8859-1", header=False, inferSchema=False).schema("value string").csv(path).limit(lines).collect() if r["value"]).encode("latin-1")


def read_table(spark: SparkSession, path: str, text_columns: tuple[str, ...] = ()) -> DataFrame:
    """By suffix; columns of a CSV get the types that fit, but `text_columns` (codes with leading zeros) stay text."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        typed = spark.read.options(header=True, inferSchema=True, mode="FAILFAST").csv(path)
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType) for f in typed.schema])
        return spark.read.options(header=True, mode="FAILFAST").schema(schema).csv(path)
    raise SourceError(f"no reader for {path}")


def zipped_rows(spark: SparkSession, path: str, columns: tuple[str, ...], separator: str = ";") -> DataFrame:
    """The one CSV at the root of a ZIP, checked for its header; every malformed row is an error."""

    def rows(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    members = [n for n in archive.namelist() if n.lower().endswith(".csv") and "/" not in n]
                    if len(members) != 1:
                        raise SourceError(f"{len(members)} CSV files in the archive; one is needed")
                    with archive.open(members[0]) as raw:
                        reader = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""), delimiter=separator)
                        if tuple(next(reader, ())) != columns:
                            raise SourceError("the header isn't the agreed one")
                        held = []
                        for row in reader:
                            if len(row) != len(columns):
                                raise SourceError(f"a row has {len(row)} fields")
                            held.append(row)
                            if len(held) == 10_000:
                                yield pd.DataFrame(held, columns=list(columns))
                                held = []
                        yield pd.DataFrame(held, columns=list(columns), dtype=str)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, ", ".join(f"{c} string" for c in columns))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, length, sha256."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def source_states(spark: SparkSession, folder: str, wanted: dict[str, str]) -> DataFrame:
    """One row per wanted source (its name, and a regular expression that its file's whole name matches): state, path,
    length, sha256.  A source is ready if one file matches, missing if none does, ambiguous if several do."""
    name = F.element_at(F.split("path", "/"), -1)
    files = inventory(spark, folder).withColumn("found", F.array_compact(F.array(*[F.when(name.rlike(f"^(?:{p})$"), F.lit(s)) for s, p in sorted(wanted.items())])))
    one = files.select(F.explode("found").alias("source"), "path", "length", "sha256").groupBy("source").agg(F.count("*").alias("n"), F.min(F.struct("path", "length", "sha256")).alias("file"))
    names = spark.createDataFrame([(s,) for s in sorted(wanted)], "source string")
    state = F.when(F.col("n") == 1, "ready").when(F.col("n") > 1, "ambiguous").otherwise("missing")
    shown = [F.when(F.col("n") == 1, F.col(f"file.{c}")).alias(c) for c in ("path", "length", "sha256")]
    return names.join(one, "source", "left").select("source", state.alias("state"), *shown)


def all_ready(states: DataFrame) -> bool:
    return states.where("state <> 'ready'").isEmpty()


def latest_snapshot(folder: str | Path, prefix: str, suffix: str = ".parquet") -> Path:
    """The file or folder whose name has the latest timestamp (digits, T and Z after the prefix) of all."""
    stamped = [p for p in Path(folder).glob(f"{prefix}*{suffix}") if re.fullmatch(r"[0-9][0-9TZ_-]*", p.name[len(prefix) : len(p.name) - len(suffix)])]
    if not stamped:
        raise SourceError(f"no {prefix}<time>{suffix} in {folder}")
    return max(stamped, key=lambda p: re.sub(r"\D", "", p.name[len(prefix) :]))
