"""Readers for the `::`-separated rating, movie and user files.

The CSV reader splits lines in parallel across file splits and accepts a
multi-character separator; schemas are explicit so nothing is inferred.  The
format knows no quoting: quotes are part of the text.  The movie file is
latin-1 encoded.  A line whose typed fields don't parse is no row of the
table; ``corrupt_lines`` returns such lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# Fixed values of the file format: field separator and the movie file's charset.
SEP = "::"
MOVIES_ENCODING = "ISO-8859-1"



def _fields(spark: SparkSession, path: str, schema, encoding: str) -> DataFrame:
    """All lines with their fields as text; ``_bad`` if the key is missing or a typed field doesn't parse."""
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(plain)
           .option("sep", SEP).option("header", "false").option("encoding", encoding)
           .option("quote", "").option("escape", "")
           .csv(path))
    bad = F.col(schema.fieldNames()[0]).isNull()
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return raw.withColumn("_bad", bad)


def _read(spark: SparkSession, path: str, schema, encoding: str = "UTF-8") -> DataFrame:
    rows = _fields(spark, path, schema, encoding).where("not _bad")
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def corrupt_lines(spark: SparkSession, path: str, schema, encoding: str = "UTF-8") -> DataFrame:
    """(line): what the reader of ``schema`` leaves out, its fields joined again."""
    rows = _fields(spark, path, schema, encoding).where("_bad")
    return rows.select(F.concat_ws(SEP, *schema.fieldNames()).alias("line"))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.RATINGS)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.MOVIES_RAW, encoding=MOVIES_ENCODING)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.USERS)


def write_dat(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write a table back in the `::` layout (used to round-trip the readers)."""
    (df.write.mode("overwrite").option("sep", SEP).option("header", "false")
     .option("quote", "").option("escape", "").option("escapeQuotes", "false")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("encoding", encoding).csv(path))


def write_movies_dat(df: DataFrame, path: str) -> None:
    """Movies in the `::` layout and the latin-1 encoding the reader expects."""
    write_dat(df, path, MOVIES_ENCODING)
