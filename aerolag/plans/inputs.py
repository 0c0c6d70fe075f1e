"""Flight-shaped inputs derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolag.functions.scalar import hour_block


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 2, "0"))


def _ntz(col: str) -> Column:
    return F.col(col).cast("timestamp_ntz")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per event: dense in time, some without times or label."""
    e, ts = F.col("event_id"), F.col("DEP_TS")
    dropped = e % 53 == 0
    late = F.floor("value").cast("double")
    return (
        table(spark, sf_dir, "events")
        .withColumn("DEP_TS", _ntz("ts"))
        .select(
            e.alias("FLIGHT_ID"),
            F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("TAIL_NUM"),
            ts.alias("DEP_TS"),
            ts.cast("date").cast("string").alias("FL_DATE"),
            (F.hour(ts) * 100 + F.minute(ts)).cast("int").alias("CRS_DEP_TIME"),
            F.year(ts).alias("YEAR"),
            F.quarter(ts).alias("QUARTER"),
            F.month(ts).alias("MONTH"),
            F.dayofmonth(ts).alias("DAY_OF_MONTH"),
            (F.weekday(ts) + 1).alias("DAY_OF_WEEK"),
            hour_block(F.hour(ts)).alias("DEP_TIME_BLK"),
            hour_block((F.hour(ts) + 2) % 24).alias("ARR_TIME_BLK"),
            F.concat(F.lit("C"), (e % 12).cast("string")).alias("OP_UNIQUE_CARRIER"),
            _code("A", F.col("user_id") % 25).alias("ORIGIN"),
            _code("A", (e * 7 + 3) % 25).alias("DEST"),
            (F.col("user_id") % 25).cast("int").alias("ORIGIN_AIRPORT_ID"),
            F.when(~dropped, late - 5).alias("DEP_DELAY"),
            F.when(~dropped, late - 8).alias("ARR_DELAY"),
            (30 + e % 300).cast("double").alias("ACTUAL_ELAPSED_TIME"),
            (25 + e % 310).cast("double").alias("CRS_ELAPSED_TIME"),
            (100 + (e * 31) % 2500).cast("double").alias("DISTANCE"),
            F.when(~dropped, F.when(late - 5 >= 15, 1.0).otherwise(0.0)).alias("DEP_DEL15"),
            F.when(dropped, 1.0).otherwise(0.0).alias("CANCELLED"),
            F.col("value"),
        )
    )


def with_weather(df: DataFrame) -> DataFrame:
    """Packed weather strings with missing codes, blanks, nulls and short text."""
    e = F.col("FLIGHT_ID")

    def pad(x: Column, n: int) -> Column:
        return F.lpad(x.cast("string"), n, "0")

    none = F.lit(None).cast("string")
    return df.withColumns({
        "WND": F.when(e % 17 == 0, "999,9,V,9999,9").when(e % 41 == 0, "").when(e % 43 == 0, none)
        .when(e % 47 == 0, "120,1")
        .otherwise(F.concat(pad(e * 10 % 360, 3), F.lit(",1,N,"), pad(e % 200, 4), F.lit(",1"))),
        "CIG": F.when(e % 19 == 0, "99999,9,9,N").otherwise(F.concat(pad(e * 37 % 25000, 5), F.lit(",5,M,N"))),
        "VIS": F.when(e % 23 == 0, "999999,9,N,9").otherwise(F.concat(pad(e * 13 % 16093, 6), F.lit(",5,N,1"))),
        "TMP": F.when(e % 29 == 0, "+9999,9").otherwise(
            F.concat(F.when(e % 5 == 0, "-").otherwise("+"), pad(e % 400, 4), F.lit(",1"))),
        "DEW": F.when(e % 31 == 0, "+9999,9").otherwise(
            F.concat(F.when(e % 6 == 0, "-").otherwise("+"), pad(e % 250, 4), F.lit(",1"))),
        "SLP": F.when(e % 13 == 0, "99999,9").otherwise(F.concat(pad(9800 + e % 600, 5), F.lit(",1"))),
        "AW1": F.when(e % 7 == 0, "RA").when(e % 11 == 0, ""),
        "AW2": F.when(e % 14 == 0, "TS"),
        **{f"AW{i}": none for i in range(3, 8)},
        "MW1": F.when(e % 9 == 0, "FG"),
        **{f"MW{i}": none for i in range(2, 7)},
    })


def weather_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_weather(flights(spark, sf_dir))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item, over many seasons."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    shipped = _ntz("l_shipdate")
    return (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.year(shipped).alias("YEAR"),
            F.quarter(shipped).alias("QUARTER"),
            F.month(shipped).alias("MONTH"),
            shipped.cast("date").cast("string").alias("FL_DATE"),
            _code("A", F.col("s_nationkey")).alias("ORIGIN"),
            _code("A", F.col("c_nationkey")).alias("DEST"),
            F.col("l_extendedprice").alias("DISTANCE"),
            F.col("l_quantity").alias("CRS_ELAPSED_TIME"),
            F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("DEP_DEL15"),
        )
    )


def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line item a whole number above 2**53 and a decimal with ten places."""
    big = (F.lit(9007199254740993) + F.col("l_orderkey") * 1000003 + F.col("l_linenumber")).cast("bigint")
    factor = F.lit("1.0000000001").cast("decimal(11,10)")
    return table(spark, sf_dir, "lineitem").select(big.alias("big"), (big.cast("decimal(25,0)") * factor).alias("precise"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates that fall on a calendar holiday, per region of the customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", _ntz("o_orderdate").alias("date"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    month_day = F.date_format("date", "MM-dd")
    paid = F.when(month_day.isin("01-01", "07-04", "11-11", "12-25"), True).when(
        month_day.isin("02-14", "10-31"), False
    )
    return (
        orders.filter(month_day.isin("01-01", "02-14", "03-17", "07-04", "10-31", "11-11", "12-25"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "date",
            F.when(F.col("r_name") == "AMERICA", "United States").otherwise(F.col("r_name")).alias("countryOrRegion"),
            paid.alias("isPaidTimeOff"),
        )
        .distinct()
    )


def flight_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight dates that fall on a holiday of the period."""
    day = _ntz("ts").cast("date")
    return table(spark, sf_dir, "events").select(day.alias("date")).filter(
        F.date_format("date", "MM-dd").isin("01-01", "01-15")
    ).distinct()


def order_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per order, dated by the order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("FLIGHT_ID"),
        _ntz("o_orderdate").cast("date").cast("string").alias("FL_DATE"),
        F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0).alias("DEP_DEL15"),
    )


def utc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to add to local time, per airport."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        k.alias("ORIGIN_AIRPORT_ID"), F.col("n_name").alias("ORIGIN_CITY_NAME"),
        F.when(k % 8 == 0, 5.5).otherwise((5 + k % 4).cast("double")).alias("UTC_offset_hours"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        _code("A", k).alias("airport"),
        ((k * 37) % 160 - 80 + 0.5).cast("double").alias("lat"),
        ((k * 71) % 340 - 170 + 0.25).cast("double").alias("lon"),
    )


def customer_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per customer, so that the number of places grows with the data."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("airport"),
        (((k * 7919) % 16000).cast("double") / 100 - 80).alias("lat"),
        (((k * 10007) % 35900).cast("double") / 100 - 179.5).alias("lon"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("station"),
        (((k * 53) % 170).cast("double") - 85 + 0.1).alias("lat"),
        (((k * 97) % 350).cast("double") - 175 + 0.7).alias("lon"),
    )


def _crowded(table_: DataFrame, key: str, name: str) -> DataFrame:
    """Places within three hundredths of a degree, from a table's key."""
    k = F.col(key)
    return table_.select(
        k.alias(name),
        (F.lit(10.005) + ((k * 7919) % 10007).cast("double") * 3e-6).alias("lat"),
        (F.lit(20.005) + ((k * 104729) % 10009).cast("double") * 3e-6).alias("lon"),
    )


def crowded_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per order, all in one town."""
    return _crowded(table(spark, sf_dir, "orders"), "o_orderkey", "airport")


def crowded_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station per part, all in the same town."""
    return _crowded(table(spark, sf_dir, "part"), "p_partkey", "station")


# Zones with and without clock changes.
ZONES = ("America/New_York", "America/Chicago", "America/Phoenix", "Asia/Kolkata", "America/Los_Angeles")


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone name per airport; some airports have none."""
    k = F.col("n_nationkey")
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (k % len(ZONES)).cast("int") + 1)
    return table(spark, sf_dir, "nation").select(k.alias("ORIGIN_AIRPORT_ID"), F.when(k != 24, zone).alias("UTC_zone"))


def dated_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item at any minute of the day, over seven years of clock changes."""
    minute = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 1440
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("FLIGHT_ID"),
        (F.col("l_suppkey") % 25).cast("int").alias("ORIGIN_AIRPORT_ID"),
        _ntz("l_shipdate").cast("date").cast("string").alias("FL_DATE"),
        (F.floor(minute / 60) * 100 + minute % 60).cast("int").alias("CRS_DEP_TIME"),
        F.col("l_quantity").alias("DEP_DELAY"),
        F.lit(60.0).alias("ACTUAL_ELAPSED_TIME"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather rows as observations of five stations, several per hour."""
    e = F.col("FLIGHT_ID")
    return weather_flights(spark, sf_dir).select(
        e.alias("obs_id"),
        (e % 5).alias("station"),
        F.col("DEP_TS").alias("obs_ts"),
        F.when(e % 10 == 3, "FM-12").when(e % 2 == 0, "FM-15").otherwise("SOA").alias("REPORT_TYPE"),
        "WND", "CIG", "VIS", "TMP", "DEW", "SLP",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled flights with a made-up but repeatable prediction."""
    digit = F.substring(F.md5(F.col("FLIGHT_ID").cast("string")), 1, 1)
    return flights(spark, sf_dir).select(
        "FLIGHT_ID", "DEP_TS", "DEP_DEL15",
        F.when(digit < "8", 1.0).otherwise(0.0).alias("prediction"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("p1"),
    )
