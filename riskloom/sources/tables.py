"""Reading and writing: source tables, layers, views, named queries, records, models."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.contracts import failures, raw_contract, require, summary
from riskloom.roles import DEFAULT_ROLES, Roles

# --------------------------------------------------------------------------- headers


def header_name(text: str) -> str:
    """Accents off, lower case, every run of other characters becomes one underscore."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return "_".join(re.findall("[a-z0-9]+", plain))


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename all columns; only metadata changes. Two headers may not meet in one name."""
    names = [header_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers collapse to the same name: {clashes}")
    return df.toDF(*names)


# --------------------------------------------------------------------------- sources


def open_source(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """All columns of a source, with normalised headers."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return normalise_headers(reader.load(path))
    except AnalysisException as error:
        raise _absent(error, path) from error


def read_source(
    spark: SparkSession,
    path: str,
    roles: Roles = DEFAULT_ROLES,
    fmt: str = "parquet",
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Read, normalise headers, and project: the unit id if the source has one, ``keep``, the canonical columns."""
    return project_source(open_source(spark, path, fmt, **options), roles, keep)


def source_id(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> str | None:
    """The unit id column, if there is one."""
    return roles.unit_id if roles.unit_id in df.columns else None


def project_source(df: DataFrame, roles: Roles = DEFAULT_ROLES, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns in order, after ``keep`` and the unit id: dropping the id would make different units equal."""
    named = source_id(df, roles)
    wanted = list(dict.fromkeys([*([named] if named else []), *keep, *roles.canonical]))
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"the source lacks {', '.join(absent)}; its columns are {', '.join(df.columns)}")
    return df.select(*wanted)


def load_source(
    spark: SparkSession,
    path: str,
    roles: Roles = DEFAULT_ROLES,
    strict: bool = False,
    keep: Sequence[str] = (),
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, one-row summary, failures). Strict mode raises on any violation.

    Failures carry the unit id, if the source has one. Columns in ``keep`` are outside the contract.
    """
    df = read_source(spark, path, roles, keep=keep, **options)
    contract, named = raw_contract(roles), source_id(df, roles)
    checked = df.drop(*[c for c in keep if c != named and c not in roles.canonical])
    if strict:
        require(checked, contract, named)
    return df, summary(checked, contract, named), failures(checked, contract, named)


def _absent(error: AnalysisException, path: str) -> Exception:
    if "PATH_NOT_FOUND" in str(error):
        return FileNotFoundError(f"{path} does not exist; run the step that writes it first")
    return error


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer, or an error that says what is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise _absent(error, path) from error


def read_aggregate(spark: SparkSession, folder: str, name: str, known: Sequence[str]) -> DataFrame:
    if name not in known:
        raise KeyError(f"unknown aggregate {name!r}; options: {sorted(known)}")
    return read_layer(spark, f"{folder}/{name}")


def missing_layers(spark: SparkSession, folder: str, names: Sequence[str]) -> list[str]:
    """Tables a consumer needs and that are not there yet."""
    absent = []
    for name in names:
        try:
            read_layer(spark, f"{folder}/{name}")
        except FileNotFoundError:
            absent.append(name)
    return absent


def read_predictions(spark: SparkSession, path: str, model: str, feature_set: str) -> DataFrame:
    """Out-of-fold predictions of one model; both filters prune partitions."""
    return select_predictions(read_layer(spark, path), model, feature_set)


def select_predictions(oof: DataFrame, model: str, feature_set: str) -> DataFrame:
    chosen = oof.filter((F.col("model") == model) & (F.col("feature_set") == feature_set))
    if chosen.isEmpty():
        raise ValueError(f"no out-of-fold predictions for {model}/{feature_set}")
    return chosen


# --------------------------------------------------------------------------- views and queries


def canonical_view(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Same columns with the label as boolean, whichever way it arrives."""
    if dict(df.dtypes)[roles.label] == "boolean":
        return df
    return df.withColumn(roles.label, F.col(roles.label) == roles.positive_text)


def register_parquet(spark: SparkSession, path: str, view: str) -> DataFrame:
    df = read_layer(spark, path)
    df.createOrReplaceTempView(view)
    return df


def sql(df: DataFrame, text: str, roles: Roles = DEFAULT_ROLES, **parameters) -> DataFrame:
    """SQL over the canonical view, written as ``{units}``, with ``:name`` parameters."""
    return df.sparkSession.sql(text, args=parameters, units=canonical_view(df, roles))


# --------------------------------------------------------------------------- sinks


def write_layer(df: DataFrame, path: str, *partition_by: str) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON object as a one-line text dataset."""
    line = json.dumps(record, ensure_ascii=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_record(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(spark.read.text(path).first()[0])
    except AnalysisException as error:
        raise _absent(error, path) from error


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
