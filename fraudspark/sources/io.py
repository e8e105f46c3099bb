"""Sources and sinks: typed CSV scan, Parquet writers, JSON request records,
one-row manifests."""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared types of the transaction / identity columns the library reads.
DECLARED_TYPES: dict[str, T.DataType] = {
    "TransactionID": T.LongType(), "isFraud": T.IntegerType(), "TransactionDT": T.LongType(),
    "TransactionAmt": T.DoubleType(), "ProductCD": T.StringType(), "card1": T.LongType(),
    "card2": T.DoubleType(), "card3": T.DoubleType(), "card4": T.StringType(), "card5": T.DoubleType(),
    "card6": T.StringType(), "addr1": T.DoubleType(), "addr2": T.DoubleType(), "dist1": T.DoubleType(),
    "dist2": T.DoubleType(), "P_emaildomain": T.StringType(), "R_emaildomain": T.StringType(),
    "C1": T.DoubleType(), "C2": T.DoubleType(), "C3": T.DoubleType(), "C4": T.DoubleType(),
    "M1": T.StringType(), "M2": T.StringType(), "M3": T.StringType(), "M4": T.StringType(),
    "DeviceType": T.StringType(), "DeviceInfo": T.StringType(),
}

# Fields of a scoring request and their types (all optional
# except the amount, which the contract check enforces).
REQUEST_FIELDS: list[tuple[str, T.DataType]] = [
    ("TransactionAmt", T.DoubleType()), ("ProductCD", T.StringType()), ("TransactionDT", T.LongType()),
    ("card1", T.LongType()), ("card2", T.DoubleType()), ("card3", T.DoubleType()),
    ("card4", T.StringType()), ("card5", T.DoubleType()), ("card6", T.StringType()),
    ("addr1", T.DoubleType()), ("addr2", T.DoubleType()), ("dist1", T.DoubleType()), ("dist2", T.DoubleType()),
    ("P_emaildomain", T.StringType()), ("R_emaildomain", T.StringType()),
    ("C1", T.DoubleType()), ("C2", T.DoubleType()), ("C3", T.DoubleType()), ("C4", T.DoubleType()),
    ("M1", T.StringType()), ("M2", T.StringType()), ("M3", T.StringType()),
    ("DeviceType", T.StringType()), ("DeviceInfo", T.StringType()),
]


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def _typed(raw: DataFrame, declared: dict[str, T.DataType]) -> dict[str, Column]:
    """The typed value of every declared column that is not text already."""
    return {c: F.col(f"`{c}`").try_cast(declared[c]) for c in raw.columns
            if c in declared and declared[c] != T.StringType()}


def read_csv(spark: SparkSession, path: str, declared: dict[str, T.DataType] = DECLARED_TYPES) -> DataFrame:
    """CSV scan with a header: declared columns are cast to their type
    (``try_cast``: unparsable -> null, counted by ``csv_type_findings``),
    undeclared columns stay strings and are coerced later by the numeric step.
    No schema-inference pass over the data."""
    raw = _csv_text(spark, path)
    typed = _typed(raw, declared)
    return raw.select(*[typed[c].alias(c) if c in typed else F.col(f"`{c}`") for c in raw.columns])


def csv_type_findings(spark: SparkSession, path: str,
                      declared: dict[str, T.DataType] = DECLARED_TYPES) -> DataFrame:
    """Per declared column of the file: values that are there, values that do not
    read as the declared type, and whether the column passes, in one pass."""
    raw = _csv_text(spark, path)
    found = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("n_values"),
                      F.count_if(F.col(f"`{c}`").isNotNull() & v.isNull()).alias("n_bad"))
             for c, v in _typed(raw, declared).items()]
    kind = "array<struct<column_name:string,n_values:bigint,n_bad:bigint>>"
    rows = F.array(*found) if found else F.array().cast(kind)
    return (raw.agg(rows.alias("f")).select(F.explode("f").alias("f")).select("f.*")
            .withColumn("passed", F.col("n_bad") == 0))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet sink; optionally Hive-partitioned for partition pruning."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def request_json(df: DataFrame, id_field: str = "TransactionID") -> DataFrame:
    """Serialise request fields of each row (and its id, when present) as one
    JSON text; null fields are omitted."""
    names = [n for n, _ in REQUEST_FIELDS if n in df.columns]
    ident = [id_field] if id_field in df.columns else []
    return df.select(*ident, F.to_json(F.struct(*ident, *names)).alias("value"))


def parse_requests(df: DataFrame, text_col: str = "value", id_field: str = "TransactionID") -> DataFrame:
    """Parse JSON request records: unknown fields are ignored, numbers sent as
    strings are coerced, and each field that was sent but does not parse gets
    a ``_bad_<field>`` marker for the contract check.  The optional id field
    is carried through (taken from the record unless the frame already has it)."""
    as_text = T.StructType([T.StructField(n, T.StringType()) for n, _ in [(id_field, None)] + REQUEST_FIELDS])
    parsed = df.select("*", F.from_json(F.col(text_col), as_text, {"mode": "PERMISSIVE"}).alias("_r"))
    cols, bad = [], []
    for n, t in REQUEST_FIELDS:
        raw = F.col(f"_r.{n}")
        if isinstance(t, T.StringType):
            cols.append(raw.alias(n))
        else:
            typed = raw.try_cast("double") if isinstance(t, T.LongType) else raw.try_cast(t)
            # ids: a fraction or a number out of range does not parse
            val = F.when(F.rint(typed) == typed, typed.try_cast(t)) if isinstance(t, T.LongType) else typed
            cols.append(val.alias(n))
            bad.append((raw.isNotNull() & val.isNull()).alias(f"_bad_{n}"))
    keep = [c for c in df.columns if c != text_col]
    ident = [] if id_field in keep else [F.col(f"_r.{id_field}").try_cast("bigint").alias(id_field)]
    return parsed.select(*keep, *ident, *cols, *bad)


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """One-row JSON manifest (list values stay JSON arrays)."""
    row = {k: (json.dumps(v) if isinstance(v, (list, dict)) else v) for k, v in manifest.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    r = spark.read.json(path).first()
    if r is None:
        raise FileNotFoundError(f"No manifest at {path}; train a model first")
    out = r.asDict()
    for k, v in list(out.items()):
        if isinstance(v, str) and v[:1] in "[{":
            try:
                out[k] = json.loads(v)
            except ValueError:
                pass
    return out


# ------------------------------------------------------------ malformed lines

_QUOTED = r'"(?:[^"]|"")*"'


def csv_lines(spark: SparkSession, path: str, declared: dict[str, T.DataType] = DECLARED_TYPES) -> tuple[DataFrame, DataFrame]:
    """CSV read line by line: ``(rows, bad lines)``.

    ``rows`` has the typed columns of the well-formed lines, as ``read_csv`` gives them.  A line is malformed
    when a quote is never closed, or when it has fewer or more fields than the header; the second table
    gives each with its file, text and reason.  The first line of every file is the header, which all files
    share; records do not span lines.
    """
    text = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    first = text.where(F.length("line") > 0).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    header = first["line"]
    names = next(csv.reader([header]))
    # commas and quotes that count are those outside of quoted fields
    bare = F.regexp_replace("line", _QUOTED, "")
    fields = F.length(bare) - F.length(F.translate(bare, ",", "")) + 1
    reason = (F.when(F.contains(bare, F.lit('"')), "unclosed quote")
              .when(fields < len(names), F.concat(F.lit("too few fields: "), fields.cast("string")))
              .when(fields > len(names), F.concat(F.lit("too many fields: "), fields.cast("string"))))
    marked = text.where((F.col("line") != header) & (F.length("line") > 0)).withColumn("reason", reason)
    parsed = marked.where("reason is null").select(
        F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(names))), {"quote": '"', "escape": '"'}).alias("r"))
    raw = parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
    typed = _typed(raw, declared)
    rows = raw.select(*[typed[c].alias(c) if c in typed else F.col(f"`{c}`") for c in raw.columns])
    return rows, marked.where("reason is not null").select("file", "line", "reason")


def quarantine_csv(spark: SparkSession, path: str, out: str, quarantine: str, declared: dict[str, T.DataType] = DECLARED_TYPES) -> DataFrame:
    """Write the well-formed rows to ``out`` and the malformed lines to ``quarantine`` (Parquet); returns the
    number of lines by reason, well-formed ones as null."""
    rows, bad = csv_lines(spark, path, declared)
    write_parquet(rows, out)
    write_parquet(bad, quarantine)
    found = spark.read.parquet(quarantine).groupBy(F.regexp_extract("reason", "^[^:]*", 0).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return found.unionByName(spark.read.parquet(out).agg(F.lit(None).cast("string").alias("reason"), F.count(F.lit(1)).alias("n")))
