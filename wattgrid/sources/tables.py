"""Adapters from the shared parquet tables to this library's inputs.

The mapping (fixed here, used by the driver queries and the bench):
* ``events``  -> long readings: ``home_id = user_id div 10`` (homes grow with
  the table), ``channel = event_type`` (every type), ``watts = value``, ``seq =
  event_id``; the ``view`` rows also serve as an outside-temperature feed.
* ``events``  -> combined long file rows: ``TimeSeriesVariable<user_id % 12>``.
* ``part``    -> flexible appliances: three parts per home
  (``home_id = p_partkey div 3``), runtime, window and power by arithmetic on
  ``p_size`` / ``p_partkey``; each home gets a tariff and a cap.
* ``lineitem``-> predictions: truth = price * (1 - discount), prediction =
  price * 0.95.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..constants import LONG_ID_COL, LONG_TIME_COL, LONG_VALUE_COL, TARIFFS, VARIABLE_PREFIX
from ..util import nan_to_null

EVENT_CHANNELS = ["click", "error", "purchase", "signup", "view"]
WEATHER_EVENT = "view"
USERS_PER_HOME = 10
VARIABLE_MODULUS = 12
APPLIANCES_PER_HOME = 3
TARIFF_ORDER = ["default", "flat", "steep"]


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``.  One lazy DataFrame per (session, path):
    it holds the file listing and schema, not data, so repeated queries skip
    re-listing files and re-reading footers on the driver."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def readings_from_events(events: DataFrame) -> DataFrame:
    """Long readings ``(home_id, channel, ts, watts, seq)``."""
    return (events.filter(F.col("event_type").isin(EVENT_CHANNELS))
            .select(F.expr(f"user_id div {USERS_PER_HOME}").alias("home_id"),
                    F.col("event_type").alias("channel"),
                    F.col("ts"),
                    nan_to_null(F.col("value")).alias("watts"),
                    F.col("event_id").alias("seq")))


def weather_from_events(events: DataFrame) -> DataFrame:
    """Weather feed ``(ts, temperature, weather_seq)`` from the ``view`` rows."""
    return (events.filter(F.col("event_type") == WEATHER_EVENT)
            .select("ts", nan_to_null(F.col("value")).alias("temperature"),
                    F.col("event_id").alias("weather_seq")))


def combined_rows_from_events(events: DataFrame) -> DataFrame:
    """Rows shaped like the combined long CSV (plus ``seq``)."""
    vid = F.concat(F.lit(VARIABLE_PREFIX), (F.col("user_id") % VARIABLE_MODULUS).cast("string"))
    return events.select(vid.alias(LONG_ID_COL), F.col("ts").alias(LONG_TIME_COL),
                         nan_to_null(F.col("value")).alias(LONG_VALUE_COL),
                         F.col("event_id").alias("seq"))


def appliances_from_part(part: DataFrame) -> DataFrame:
    """Appliance table ``(home_id, appliance, slot, runtime_hours,
    earliest_start, latest_finish, power_rating)``; some rows fail validation
    on purpose.  Homes grow with the table; each has at most three appliances
    with windows of at most five hours."""
    size = F.col("p_size")
    earliest = (size * 7) % 24
    return part.select(
        (F.col("p_partkey") / APPLIANCES_PER_HOME).cast("long").alias("home_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("appliance"),
        (F.col("p_partkey") % APPLIANCES_PER_HOME).cast("int").alias("slot"),
        (F.lit(1.0) + (size % 3).cast("double") * 0.5).alias("runtime_hours"),
        earliest.cast("int").alias("earliest_start"),
        (earliest + 1 + size % 5).cast("int").alias("latest_finish"),
        (F.lit(500.0) + (F.col("p_partkey") % 8).cast("double") * 250.0).alias("power_rating"))


def faulty_appliances_from_part(part: DataFrame) -> DataFrame:
    """As :func:`appliances_from_part`, with powers that are no number, infinite,
    negative or missing in some rows."""
    key, power = F.col("p_partkey"), F.lit(500.0) + (F.col("p_partkey") % 8).cast("double") * 250.0
    bad = (F.when(key % 17 == 0, F.lit(float("nan"))).when(key % 19 == 0, F.lit(float("inf")))
           .when(key % 23 == 0, F.lit(-100.0)).when(key % 29 != 0, power))
    ids = part.select("p_partkey", "p_name").select(
        F.concat(F.col("p_name"), F.lit(" #"), key.cast("string")).alias("appliance"), bad.alias("_power"))
    return appliances_from_part(part).join(ids, "appliance").withColumn("power_rating", F.col("_power")).drop("_power")


def faulty_plans(appliances: DataFrame) -> DataFrame:
    """As :func:`plans_from_appliances`, but some homes have no plan, a plan
    without a cap, two plans, or a tariff that is not there."""
    home = F.col("home_id")
    plans = plans_from_appliances(appliances).where(home % 7 != 0)
    plans = plans.withColumns({"max_simultaneous": F.when(home % 11 != 0, F.col("max_simultaneous")),
                               "tariff_id": F.when(home % 13 != 0, F.col("tariff_id")).otherwise(F.lit("unknown"))})
    return plans.unionByName(plans.where(home % 5 == 0))


BIG_HOME = 12


def big_home_appliances(part: DataFrame) -> DataFrame:
    """Twelve appliances per home with windows of ten to twelve hours."""
    size = F.col("p_size")
    return part.select(
        F.expr(f"p_partkey div {BIG_HOME}").alias("home_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("appliance"),
        (F.lit(1.0) + (size % 6).cast("double") * 0.5).alias("runtime_hours"),
        ((size * 7) % 12).cast("int").alias("earliest_start"),
        ((size * 7) % 12 + 10 + size % 3).cast("int").alias("latest_finish"),
        (F.lit(500.0) + (F.col("p_partkey") % 8).cast("double") * 250.0).alias("power_rating"))


def big_home_plans(appliances: DataFrame) -> DataFrame:
    """Caps of three to five."""
    return plans_from_appliances(appliances).withColumn("max_simultaneous", (F.lit(3) + F.col("home_id") % 3).cast("int"))


def plans_from_appliances(appliances: DataFrame) -> DataFrame:
    """One plan per home: ``(home_id, tariff_id, allow_simultaneous, max_simultaneous)``."""
    tariff = F.element_at(F.array(*[F.lit(t) for t in TARIFF_ORDER]),
                          (F.col("home_id") % len(TARIFF_ORDER) + 1).cast("int"))
    return (appliances.select("home_id").distinct()
            .select("home_id", tariff.alias("tariff_id"), F.lit(True).alias("allow_simultaneous"),
                    (F.lit(1) + F.col("home_id") % 2).cast("int").alias("max_simultaneous")))


def tariff_table(spark: SparkSession, names=None) -> DataFrame:
    """The reference's tariffs as ``(tariff_id, hour, price)`` - a local
    relation (its rows sit on the driver, so its size is known)."""
    import pandas as pd

    names = list(names or TARIFFS)
    pdf = pd.DataFrame({"tariff_id": [n for n in names for _ in TARIFFS[n]],
                        "hour": pd.array([h for n in names for h in range(len(TARIFFS[n]))], dtype="int32"),
                        "price": [float(p) for n in names for p in TARIFFS[n]]})
    schema = StructType([StructField("tariff_id", StringType(), False),
                         StructField("hour", IntegerType(), False),
                         StructField("price", DoubleType(), False)])
    return spark.createDataFrame(pdf, schema)


def tariffs_from_events(events: DataFrame) -> DataFrame:
    """Observed tariffs: one per event type, price = mean value per hour / 1000."""
    return (events.groupBy(F.col("event_type").alias("tariff_id"), F.hour("ts").alias("hour"))
            .agg((F.avg("value") / 1000.0).alias("price")))


def predictions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``(l_orderkey, l_linenumber, split, y_true, y_pred)``, split = return flag."""
    price = F.col("l_extendedprice")
    return lineitem.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("split"),
                           (price * (1 - F.col("l_discount"))).alias("y_true"),
                           (price * 0.95).alias("y_pred"))
