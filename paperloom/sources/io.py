"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions.labels import in_domain
from .schemas import CSV_NULLS, TABLES

# One dialect for reading and writing: doubled quotes, line breaks allowed in quoted fields.
# CSV has one empty cell for both null and ""; it is read as null. Parquet keeps them apart.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table under its known schema, so no job runs to read file footers."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def load_csv(spark: SparkSession, path: str, schema: str, *, missing_words: bool = True,
             split_files: bool = False) -> DataFrame:
    """Read CSV under an explicit schema; a missing path raises.

    ``split_files`` lets Spark cut one large file into many tasks, which is only right when no
    quoted field holds a line break.
    """
    options = {**CSV_OPTIONS, "multiLine": str(not split_files).lower()}
    df = spark.read.schema(schema).options(**options).csv(path)
    if not missing_words:
        return df
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*CSV_NULLS), F.col(c)) for c in strings})


def save_csv(df: DataFrame, path: str) -> None:
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "lineSep")}
    df.write.mode("overwrite").options(**options).option("emptyValue", "").csv(path)


def load_json(spark: SparkSession, path: str, schema: str, *, document: bool = False) -> DataFrame:
    """One record per line, or with ``document`` one object or array per file, indented or not.

    What cannot be read in the chosen form raises, so an indented file never becomes null rows.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("multiLine", str(document).lower()).json(path)


def save_json(df: DataFrame, path: str) -> None:
    """One document per line, UTF-8, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_features(df: DataFrame, path: str, split: str = "split") -> None:
    """Feature rows as Parquet, one folder per split, so a reader prunes to the one it needs."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def load_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def submission(df: DataFrame, prediction: Column | str, id_col: str = "id") -> DataFrame:
    """``id, Label`` rows; a label outside the domain fails the job that writes them."""
    label = F.col(prediction) if isinstance(prediction, str) else prediction
    label = label.cast("int")
    checked = F.when(
        F.coalesce(in_domain(label), F.lit(False)), label
    ).otherwise(F.raise_error(F.lit("label outside the domain")).cast("int"))
    return df.select(F.col(id_col).alias("id"), checked.alias("Label"))


def save_submission(df: DataFrame, prediction: Column | str, path: str) -> None:
    save_csv(submission(df, prediction), path)
