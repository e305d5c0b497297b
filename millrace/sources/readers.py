"""Table sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import number

# Texts that stand for a missing number in CSV input.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Columns of the health survey tables, in file order.
SURVEY_FEATURES = (
    "HighBP", "HighChol", "CholCheck", "BMI", "Smoker", "Stroke", "HeartDiseaseorAttack",
    "PhysActivity", "Fruits", "Veggies", "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost",
    "GenHlth", "MentHlth", "PhysHlth", "DiffWalk", "Sex", "Age", "Education", "Income",
)
SURVEY_FEATURES_NO_STATUS = SURVEY_FEATURES[:19]
SURVEY_LABEL = "Diabetes_binary"
SURVEY_LABEL_3 = "Diabetes_012"
SURVEY_SCALED = ("BMI", "MentHlth", "PhysHlth")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    missing: Sequence[str] = MISSING_TEXTS,
    malformed: str = "error",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header: doubles, or what ``types`` says of a column (``double``, ``long`` or ``string``).

    With ``columns`` the names are known up front, no job runs before the scan, and a header
    that differs is an error. Texts in ``missing`` become NULL. Any other text that is no number
    fails the query, or becomes NULL with ``malformed="null"``. A line with more or fewer values
    than the header fails it too; with ``malformed="null"`` what is missing is NULL and what is
    over is left out. Keys beyond 2 ** 53 need ``long`` or ``string``.
    """
    if malformed not in ("error", "null"):
        raise ValueError("malformed must be 'error' or 'null'")
    types = dict(types or {})
    if wrong := {t for t in types.values() if t not in ("double", "long", "string")}:
        raise ValueError(f"unknown types {sorted(wrong)}")
    # all values of a line are parsed, or a ragged line would pass where few columns are used
    reader = spark.read.option("header", True).option("columnPruning", malformed == "null")
    reader = reader.option("mode", "FAILFAST" if malformed == "error" else "PERMISSIVE")
    if columns is not None:
        fields = [T.StructField(c, T.StringType()) for c in columns]
        reader = reader.schema(T.StructType(fields)).option("enforceSchema", False)
    raw = reader.csv(path)
    return raw.select(*[_parsed(raw[c], c, missing, malformed, types.get(c, "double")).alias(c) for c in raw.columns])


def _parsed(text: Column, name: str, missing: Sequence[str], malformed: str, kind: str) -> Column:
    present = F.when(~F.trim(text).isin(*missing), text if kind == "string" else F.trim(text))
    if kind == "string":
        return present
    parsed = present.try_cast("bigint" if kind == "long" else "double")
    value = parsed if kind == "long" else number(parsed)
    if malformed == "null":
        return value
    complaint = F.concat(F.lit(f"column {name}: not a number: "), present)
    bad = present.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(complaint).cast("bigint" if kind == "long" else "double")).otherwise(value)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV whose types are inferred, at the price of one more pass over the files."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_parquet(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns is not None else df


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """Label and feature vector; the feature count saves the pass that would infer it."""
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def read_split(
    spark: SparkSession, path: str, part: str, columns: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Columns of one part written by ``write_splits``; other parts' files are not opened. Parts written
    as CSV need the ``schema`` of the written columns."""
    splits = spark.read.parquet(path) if schema is None else read_splits(spark, path, schema, "csv")
    return splits.filter(F.col("part") == part).select(*columns)


def read_splits(spark: SparkSession, path: str, schema: T.StructType | str, form: str = "parquet") -> DataFrame:
    """All parts written by ``write_splits``, with their part."""
    return spark.read.format(form).schema(schema).options(header=True, mode="FAILFAST").load(path)


def feature_names(df: DataFrame, label: str, *others: str) -> list[str]:
    """All columns but the label and the named others, in table order."""
    return [c for c in df.columns if c != label and c not in others]


def features_only(df: DataFrame, label: str) -> DataFrame:
    return df.drop(label)


def labels_only(df: DataFrame, label: str, *keys: str) -> DataFrame:
    return df.select(*keys, label)


def labelled_arrays(
    df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str] = (), bias: bool = False
) -> DataFrame:
    """``label`` (float) and ``features`` (array of float, no missing entries), chosen by name."""
    entries = [F.col(c).cast("float") for c in features]
    if bias:
        entries = [F.lit(1.0).cast("float"), *entries]
    return df.select(*keys, F.col(label).cast("float").alias("label"), F.array(*entries).alias("features"))


# The one nested schema: label and feature array.
LABELLED_ARRAY = T.StructType(
    [
        T.StructField("label", T.FloatType(), True),
        T.StructField("features", T.ArrayType(T.FloatType(), containsNull=False), True),
    ]
)


def from_local(spark: SparkSession, rows, schema: T.StructType = LABELLED_ARRAY) -> DataFrame:
    """A small local collection with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even out a table over ``partitions`` (round robin, so no key can be hot)."""
    return df.repartition(partitions)
