"""Yearly exchange rates, USD per EUR."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom import fixed_values as fixed
from ledgerloom.operators.dims import code_dim

SERIES_KEY = "0:0:0:0:0"

RATE_DOCUMENT = T.StructType([
    T.StructField("dataSets", T.ArrayType(T.StructType([
        T.StructField("series", T.MapType(T.StringType(), T.StructType([
            T.StructField("observations", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
        ]))),
    ]))),
    T.StructField("structure", T.StructType([
        T.StructField("dimensions", T.StructType([
            T.StructField("observation", T.ArrayType(T.StructType([
                T.StructField("values", T.ArrayType(T.StructType([
                    T.StructField("id", T.StringType()),
                ]))),
            ]))),
        ])),
    ])),
])


def rates_of(documents: DataFrame, doc: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``annee, taux`` of rate documents.

    Periods are a list, observations a map from the position in that list to an array
    whose first value is the rate. Periods without a value are left out.
    """
    at = f"{doc}." if doc else ""
    observations = F.try_element_at(
        F.get(F.col(f"{at}dataSets"), F.lit(0)).getField("series"), F.lit(SERIES_KEY)
    ).getField("observations")
    periods = F.get(F.col(f"{at}structure.dimensions.observation"), F.lit(0)).getField("values")
    exploded = documents.select(
        *keep, observations.alias("_obs"), F.posexplode(periods).alias("_at", "_period")
    )
    rate = F.get(F.try_element_at("_obs", F.col("_at").cast("string")), F.lit(0))
    return exploded.select(
        *keep, F.col("_period.id").try_cast("int").alias("annee"), rate.alias("taux")
    ).where("taux IS NOT NULL")


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    documents = spark.read.schema(RATE_DOCUMENT).json(path, multiLine=True, mode="PERMISSIVE")
    return rates_of(documents)


def fallback_rates(spark: SparkSession) -> DataFrame:
    dim = code_dim(spark, fixed.FALLBACK_RATES)
    return dim.select(F.col("code").cast("int").alias("annee"), F.col("label").cast("double").alias("taux"))


def rates_or_fallback(live: DataFrame, fallback: DataFrame) -> DataFrame:
    """The live rates as a whole, or the built-in ones as a whole.

    Single years are never filled in: the built-in rates count only when the live series
    is empty or holds a period that is not a year.
    """
    usable = live.exists() & ~live.where("annee IS NULL").exists()
    return live.where(usable).unionByName(fallback.where(~usable))
