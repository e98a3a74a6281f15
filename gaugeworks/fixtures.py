"""Station, daily and hourly tables derived from the general-purpose test tables.

Suppliers play the stations and shipments their daily precipitation; events play hourly
temperatures. Coordinates and availability are made up from the keys, the same way in the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and ship date; returned goods count as missing values."""
    shipped = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("datetime"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("amount"),
    )
    per_day = shipped.groupBy("l_suppkey", "datetime").agg(F.max("amount").alias("total_precip"))
    per_day = per_day.withColumn("ec_station_id", F.col("l_suppkey").cast("string"))
    return per_day.select(
        "ec_station_id",
        F.concat(F.lit("C"), "ec_station_id").alias("climate_id"),
        F.concat(F.lit("Station "), "ec_station_id").alias("station_name"),
        "datetime",
        F.year("datetime").alias("year"), F.month("datetime").alias("month"), F.day("datetime").alias("day"),
        "total_precip",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier, placed on a lattice, with the columns of the station list in use."""
    key = F.col("s_suppkey")
    letter = lambda n: F.chr(F.lit(65) + n)
    airport = F.when(key % 4 == 0, F.concat(letter(key % 26), letter(F.floor(key / 26) % 26), letter(key % 7)))
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("string").alias("station_id"),
            F.concat(F.lit("C"), key.cast("string")).alias("climate_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("province"),
            airport.alias("tc_id"),
            (F.lit(48) + (key * 53 % 120) / F.lit(10.0)).cast("double").alias("lat"),
            (F.lit(-139) + (key * 37 % 250) / F.lit(10.0)).cast("double").alias("lon"),
            (F.lit(1995) + key % 3).cast("int").alias("dly_first_year"),
            (F.lit(2001) - key % 2).cast("int").alias("dly_last_year"),
            F.when(key % 5 > 0, F.lit(1998) + key % 2).cast("int").alias("hly_first_year"),
            F.when(key % 5 > 0, F.lit(2000)).cast("int").alias("hly_last_year"),
            F.when(key % 3 > 0, F.lit(1990) + key % 7).cast("int").alias("mly_first_year"),
            F.when(key % 3 > 0, F.lit(1999)).cast("int").alias("mly_last_year"),
        )
    )


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-letter codes for the nations."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.chr(F.lit(65) + key), F.chr(F.lit(65) + key % 5)).alias("code"),
        F.col("n_name").alias("province"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per user and hour."""
    return hourly_of(table(spark, sf_dir, "events"))


def hourly_of(events: DataFrame) -> DataFrame:
    ts = F.col("ts")
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.lit(0), F.lit(0))
    events = events.select(
        F.col("user_id").cast("string").alias("ec_station_id"), hour.alias("datetime"), "value"
    )
    per_hour = events.groupBy("ec_station_id", "datetime").agg(F.avg("value").alias("temp"))
    return per_hour.select(
        "ec_station_id", F.concat(F.lit("C"), "ec_station_id").alias("climate_id"), "datetime",
        F.date_format("datetime", "HH:mm").alias("time"),
        F.year("datetime").alias("year"), F.month("datetime").alias("month"), F.day("datetime").alias("day"),
        "temp",
    )
