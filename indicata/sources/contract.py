"""Declared file contracts and the reader that enforces them.

Schemas are fixed, never inferred: raw encounter files arrive as text
(dates and ids included); only the diagnosis rank is typed at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.sources.sinks import materialize

_S = T.StringType()

PATIENT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", _S),
        T.StructField("drg", _S),
        T.StructField("birth_date", _S),
        T.StructField("admission_date", _S),
        T.StructField("discharge_date", _S),
        T.StructField("admission_type", _S),
    ]
)

PROCEDURE_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", _S),
        T.StructField("procedure_code", _S),
    ]
)

DIAGNOSIS_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", _S),
        T.StructField("diag_code", _S),
        T.StructField("diag_rank_num", T.LongType()),
        T.StructField("present_on_admission_ind", _S),
    ]
)

CODE_LIST_SCHEMA = T.StructType(
    [
        T.StructField("code", _S),
        T.StructField("code_description", _S),
        T.StructField("code_type", _S),
        T.StructField("identifier", _S),
    ]
)

# The five code-list files of one reference year.
CODE_LIST_NAMES = ("appendix_a", "appendix_e", "appendix_f", "appendix_o", "sepsis_codes")


def read_contract(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    multiline: bool = True,
) -> DataFrame:
    """Read headered CSV under a declared schema, failing fast on violations.

    * one header row, checked against the schema names (``enforceSchema=False``)
    * comma separator, ``"`` quote, quoted newlines allowed (``multiLine``)
    * a short or malformed row raises (``FAILFAST``); empty fields are NULL

    ``multiLine`` makes each file a single split, so large inputs should be
    delivered as many files; pass ``multiline=False`` when the producer
    guarantees no embedded newlines and files should be split by size.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_code_lists(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """One contract read per code-list file, all of the same shape."""
    return {name: read_contract(spark, p, CODE_LIST_SCHEMA) for name, p in paths.items()}


#: Why a record was not loaded.
WRONG_HEADER, WRONG_WIDTH, WRONG_TYPE = "header", "tokens", "cast"


def read_quarantined(spark: SparkSession, paths: str | list[str], schema: T.StructType, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read like ``read_contract``, but keep bad records apart instead of failing.

    Returns the typed rows and the quarantine: (file, reason, detail, record,
    and the declared columns as text, as far as they were there). A record is
    quarantined if its file has no row with the declared header (``header``),
    if it has more or fewer fields than declared (``tokens``), or if a present
    value does not parse as its column's type (``cast``; ``detail`` names the
    columns). The files are read and parsed once, into a written table that
    both results read; files are split between tasks unless ``multiline``.
    """
    names, record = schema.names, "_corrupt_record"
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, record]])
    read = (
        spark.read.schema(text)
        .option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", record)
        .csv(paths)
    )
    rows = read.select("*", F.col("_metadata.file_path").alias("_file"))
    header = F.col(record).isNull()
    for n in names:
        header = header & F.col(n).eqNullSafe(F.lit(n))
    staged = materialize(rows.withColumn("_header", header), "quarantine-read")
    # One row per file at most.
    headed = staged.filter("_header").select("_file").distinct().withColumn("_headed", F.lit(True))
    failed = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name) for f in schema.fields if f.dataType != T.StringType()]
    detail = F.concat_ws(",", *failed) if failed else F.lit("")
    reason = (
        F.when(F.col("_headed").isNull(), WRONG_HEADER)
        .when(F.col(record).isNotNull(), WRONG_WIDTH)
        .when(detail != "", WRONG_TYPE)
    )
    judged = staged.filter("NOT _header").join(headed, "_file", "left").select("*", reason.alias("_reason"), detail.alias("_detail"))
    good = judged.filter(F.col("_reason").isNull()).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    # A record that was split into fields is put together again for the quarantine.
    whole = F.coalesce(record, F.to_csv(F.struct(*names)))
    bad = judged.filter(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.when(F.col("_reason") == WRONG_TYPE, F.col("_detail")).alias("detail"), whole.alias("record"), *names
    )
    return good, bad
