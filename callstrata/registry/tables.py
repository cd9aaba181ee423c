"""The given tables dressed as contact-centre tables.

Each function has a twin of the same name in ``oracle.py`` written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.operators.joins import map_values
from callstrata.schemas import SERVICE, SUBSIDIARY, UNKNOWN_QUEUE
from callstrata.settings import Settings

SETTINGS = Settings(
    queue_to_service={"0": "Kundtjänst", "1": "Teknisk Support", "2": "Personal"},
    customer_categories={
        "Metall": ["bolt", "gear"], "Färgad": ["red", "blue", "green"], "Liten": ["^small"],
    },
    exclude_queue_ids=("3", "17"),
    exclude_customer_ids=(5, 11),
    redial_threshold_sec=3600,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def call_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one-leg calls."""
    k = F.col("k")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    talk = F.floor(F.col("value") * 10).cast("bigint")
    number = (
        F.when(k == 99, F.lit(" "))
        .when(kind.isin("view", "click"), F.concat(F.lit("08"), user))
        .when(kind == "error", F.concat(F.lit(" 031"), user))
        .when(kind == "purchase", F.concat(F.lit("0771"), F.floor(k / 4).cast("string")))
    )
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    return events.select(
        F.col("event_id").cast("string").alias("CallId"),
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("CaseId"),
        F.col("ts").alias("Created"),
        F.when(kind == "error", "CallAbandoned").otherwise("CallAnswered").alias("Status"),
        (talk + k - 20).cast("bigint").alias("Duration"),
        talk.alias("TalkTimeInSec"),
        F.when(kind == "signup", "email").otherwise("call").alias("ChannelType"),
        number.alias("LandingNumber"),
        F.when(k < 5, "anonym")
        .otherwise(F.concat(F.lit("+46 70-"), F.lpad(user, 6, "0"))).alias("CallerNr"),
        F.floor(k / 25).cast("string").alias("QueueId"),
        "user_id",
    )


def silver_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls with a service and, unless the caller is anonymous, a customer."""
    legs = call_legs(spark, sf_dir)
    user = F.col("user_id").cast("string")
    anonymous = F.col("CallerNr") == "anonym"
    return map_values(
        legs.withColumns({
            "CustomerKey": F.when(~anonymous, F.concat(F.lit("CUSTID_"), user)),
            "Name": F.when(~anonymous, F.concat(F.lit("Kund "), user)),
            SUBSIDIARY: F.lit(0),
        }),
        "QueueId", SETTINGS.queue_to_service, SERVICE, UNKNOWN_QUEUE,
    ).drop("user_id")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a parent, organisation numbers of varying quality and number lists."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    segment = F.col("c_mktsegment")
    org = (
        F.when(segment == "BUILDING", F.lit(None).cast("string"))
        .when(segment == "HOUSEHOLD", F.lit("Okänt"))
        .when(segment == "MACHINERY", F.concat(F.lit("5560"), F.lpad(key, 6, "0"), F.lit("-1 AB")))
        .otherwise(F.concat(F.lit("5566"), F.lpad(nation, 2, "0"), F.lit("-1234")))
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerId"),
        F.floor(F.col("c_custkey") / 10).cast("bigint").alias("ParentId"),
        F.col("c_name").alias("Name"),
        org.alias("OrganisationNumber"),
        F.concat(F.lit(" 08"), key, F.lit(" ,,031"), key, F.lit(",0771"), nation)
        .alias("LandingNumber"),
        segment.alias("BillingType"),
    )


def lineitem_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the legs of a call: several per call id, with equal times."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("CallId"),
        F.col("l_returnflag").alias("Status"),
        F.col("l_shipdate").alias("Created"),
        F.col("l_linenumber").cast("string").alias("LandingNumber"),
        F.col("l_linestatus").alias("ChannelType"),
        F.col("l_suppkey").cast("string").alias("QueueId"),
        F.col("l_partkey").cast("string").alias("callerNr"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("TalkTimeInSec"),
        F.col("l_quantity").cast("bigint").alias("Duration"),
        F.lit(None).cast("string").alias("CaseId"),
    )


def order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases handled by the customer's number."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("CaseId"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderdate").alias("Created"),
        F.when(F.col("o_orderstatus") == "P", "email").otherwise("call").alias("InternalType"),
        F.col("o_custkey").alias("UserId"),
        F.substring("o_orderpriority", 1, 1).alias("GroupId"),
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day and priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("ds"), F.col("o_orderpriority").alias("priority"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def order_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two forecast runs for order volumes: orders of the week before, and of the day before."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    runs = F.array(
        F.struct(F.lit(7).alias("ahead"), F.lit("2001-01-01").cast("date").alias("run")),
        F.struct(F.lit(1).alias("ahead"), F.lit("2001-02-01").cast("date").alias("run")),
    )
    shifted = days.select("d", "n", F.explode(runs).alias("r"))
    return shifted.select(
        F.date_add("d", F.col("r.ahead")).cast("timestamp_ntz").alias("DatumTid"),
        F.col("n").alias("Prognos_Antal_Samtal"),
        F.col("r.run").alias("ForecastRunDate"),
    )


def order_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual order volumes in the shape of the hourly history."""
    return (
        table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("ds"))
        .agg(F.count(F.lit(1)).alias("Antal_Samtal"))
    )
