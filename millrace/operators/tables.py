"""Row-local table operators: design matrices, engineered features, hash splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT_SLOTS = 10_000


def design_matrix(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """A constant column first, then the features, then the target, all double."""
    return df.select(
        F.lit(1.0).alias("constant"), *[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double")
    )


def square(a: str) -> Column:
    return F.col(a) * F.col(a)


def product_of(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def sum_of(a: str, b: str) -> Column:
    return F.col(a) + F.col(b)


def natural_log(a: str) -> Column:
    return F.ln(F.col(a))


def with_house_features(df: DataFrame, rooms: str, baths: str, area: str, lat: str, long: str) -> DataFrame:
    """The four engineered columns of the house-price models."""
    return df.withColumns(
        {
            "rooms_squared": square(rooms),
            "rooms_by_baths": product_of(rooms, baths),
            "log_area": natural_log(area),
            "lat_plus_long": sum_of(lat, long),
        }
    )


def with_powers(df: DataFrame, column: str, degree: int, lowest: int = 0, prefix: str = "power_") -> DataFrame:
    """Append ``power_lowest .. power_degree`` of a column in one projection."""
    powers = [F.pow(F.col(column), F.lit(float(p))).alias(f"{prefix}{p}") for p in range(lowest, degree + 1)]
    return df.select("*", *powers)


def with_vectors(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Append one ML vector per named set of columns."""
    for output, columns in sets.items():
        df = VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)
    return df


def split_slot(key: Column | str, seed: int = 0) -> Column:
    """A number in 0..9999 that depends on the key and the seed only, never on the partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("#", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT_SLOTS


def with_split(
    df: DataFrame, key: str, weights: Mapping[str, float], seed: int = 0, output: str = "split"
) -> DataFrame:
    """Assign each row to a named part; the weights are shares of the whole."""
    whole = sum(weights.values())
    slot = split_slot(key, seed)
    bound, label = 0.0, None
    names = list(weights)
    for name in names[:-1]:
        bound += weights[name] / whole
        test = slot < round(bound * SPLIT_SLOTS)
        label = F.when(test, name) if label is None else label.when(test, name)
    label = F.lit(names[-1]) if label is None else label.otherwise(names[-1])
    return df.withColumn(output, label)


def split_frames(df: DataFrame, key: str, weights: Mapping[str, float], seed: int = 0) -> dict[str, DataFrame]:
    marked = with_split(df, key, weights, seed, "_split")
    return {name: marked.where(F.col("_split") == name).drop("_split") for name in weights}


QUARTERS = {"set_1": 0.25, "set_2": 0.25, "set_3": 0.25, "set_4": 0.25}
TRAIN_VALIDATE_TEST = {"train": 0.45, "validation": 0.45, "test": 0.10}
