"""Flat-file (CSV) export and typed read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import stored

# The flat-file layout (separator, header, timestamp text form).
CSV_SEP = ";"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CSV_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# A NUL character never appears in a field, so only truly empty fields read as NULL.
NULL_SENTINEL = "\u0000"


# The same with all digits of a timestamp.
EXACT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
EXACT_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _options(exact: bool) -> dict[str, str]:
    if not exact:
        return {"timestampFormat": CSV_TIMESTAMP_FORMAT,
                "timestampNTZFormat": CSV_TIMESTAMP_NTZ_FORMAT}
    return {"timestampFormat": EXACT_TIMESTAMP_FORMAT,
            "timestampNTZFormat": EXACT_TIMESTAMP_NTZ_FORMAT,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "escape": '"'}


def export_csv(df: DataFrame, path: str, sep: str = CSV_SEP, header: bool = True,
               single_file: bool = False, mode: str = "overwrite",
               exact: bool = False) -> None:
    """Write ``df`` as delimited text: NULL is an empty field, '' is ``""``.

    By default blanks around a value are trimmed and timestamps have milliseconds
    (the flat file's layout). With ``exact=True`` blanks, microseconds and quotes
    stay as they are, and ``read_csv(..., exact=True)`` returns what was written.

    ``single_file=True`` funnels every row through one task (the original's
    ``coalesce(1)``); keep it for small extracts only. The default writes one
    file per partition in parallel.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", str(header).lower()).option("sep", sep)
     .options(**_options(exact)).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             sep: str = CSV_SEP, header: bool = True, exact: bool = False) -> DataFrame:
    """Read an export back with an explicit schema (no inference pass over the files).

    An unquoted empty field reads as NULL and a quoted ``""`` as the empty
    string, mirroring how ``export_csv`` wrote them. Fields may hold line breaks
    (a file is then one task's work; ``export_csv`` writes many files).
    """
    return (spark.read.schema(schema).option("header", str(header).lower())
            .option("nullValue", NULL_SENTINEL).option("emptyValue", "")
            .option("sep", sep).option("multiLine", "true")
            .options(**_options(exact)).csv(path))


REJECTED = "rejected_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str,
                     sep: str = CSV_SEP, header: bool = True,
                     exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): a line with too few or too many fields, or a value its column's type
    cannot hold, goes to ``rejects`` with its text (``rejected_line``) and its file. The lines are
    parsed once, into a scratch table that both frames read.

    With ``header`` every file's header must name the schema's columns in order, or the
    read fails. Lines end at line breaks here: fields that hold some
    (``read_csv`` reads those) would be rejected.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    read = (spark.read.schema(T.StructType([*kind.fields, T.StructField(REJECTED, T.StringType())]))
            .option("header", str(header).lower()).option("enforceSchema", "false")
            .option("columnPruning", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", REJECTED).option("nullValue", NULL_SENTINEL)
            .option("emptyValue", "").option("sep", sep).options(**_options(exact)).csv(path)
            .select("*", F.col("_metadata.file_name").alias("file")))
    read = stored(read, "parsed")
    good = read.where(F.col(REJECTED).isNull()).select(*kind.fieldNames())
    return good, read.where(F.col(REJECTED).isNotNull()).select(REJECTED, "file")


def rejects_report(good: DataFrame, rejects: DataFrame, most: float) -> DataFrame:
    """One row for ``gate``: ``rows``, ``rejected`` and whether their share is ``most`` at most."""
    both = good.select(F.lit(0).alias("r")).unionByName(rejects.select(F.lit(1).alias("r")))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("rejected")
                    ).withColumn("passed", F.col("rejected") <= F.lit(most) * F.col("rows"))
