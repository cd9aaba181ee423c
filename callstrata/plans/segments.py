"""Customer behaviour: profiles, segments, peak times and call length classes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.functions.calendar import month_name, weekday_name
from callstrata.functions.numbers import whole_average
from callstrata.functions.text import contains_any, trim_blanks
from callstrata.operators.aggregates import exact_quantiles
from callstrata.operators.joins import lookup_join
from callstrata.operators.windows import share, top_per_group
from callstrata.schemas import (
    BEHAVIOR_COLUMNS, SEGMENT, SERVICE, UNCLEAR_PEAK, UNKNOWN_SERVICE_TYPE,
)
from callstrata.session import cut_lineage
from callstrata.settings import Settings

SICK_LEAVE_KEY = "INTERNAL_SICK"
SICK_LEAVE_SEGMENT = "Segment_Sjukanmälan"


def customer_profiles(calls: DataFrame) -> DataFrame:
    """Calls, talk time, name and most frequent service of every customer key.

    The raw calls are reduced once, by (customer, name, service), with a plain hash aggregate.
    Everything else works on that small result: the most frequent service is the one with the
    highest summed count (the smallest one among equals), the name that of the earliest call.
    """
    reduced = (
        calls.where(F.col("CustomerKey").isNotNull())
        .groupBy("CustomerKey", "Name", SERVICE)
        .agg(
            F.count("CallId").alias("n"),
            F.sum("TalkTimeInSec").alias("talk"),
            F.min("Created").alias("since"),
            F.count(SERVICE).alias("served"),
        )
    )
    per_service = reduced.groupBy("CustomerKey", SERVICE).agg(
        F.sum("n").alias("n"),
        F.sum("talk").alias("talk"),
        F.sum("served").alias("served"),
        F.min(F.when(F.col("Name").isNotNull(), F.struct("since", "Name"))).alias("first"),
    )
    # Smallest struct = highest count, then smallest service; null services never compete.
    vote = F.when(F.col(SERVICE).isNotNull(), F.struct((-F.col("served")).alias("v"), SERVICE))
    per_customer = per_service.groupBy("CustomerKey").agg(
        F.sum("n").cast("bigint").alias("Total_Samtal"),
        F.coalesce(F.sum("talk"), F.lit(0)).cast("bigint").alias("Total_Samtalstid_Sek"),
        F.min("first").alias("first"),
        F.min(vote).alias("vote"),
    )
    return per_customer.select(
        "CustomerKey",
        F.col("first.Name").alias("Name"),
        F.coalesce(F.col(f"vote.{SERVICE}"), F.lit(UNKNOWN_SERVICE_TYPE)).alias(SERVICE),
        "Total_Samtal",
        "Total_Samtalstid_Sek",
        whole_average(F.col("Total_Samtalstid_Sek"), F.col("Total_Samtal"))
        .alias("Genomsnittlig_AHT_Sek"),
    )


def customer_segments(
    calls: DataFrame, volume_quantile: float = 0.80, handling_quantile: float = 0.50
) -> DataFrame:
    """One behaviour segment per customer: sick-leave lines by name, the others by whether they
    exceed the volume and handling-time limits taken over all customers."""
    profiles = cut_lineage(customer_profiles(calls))  # read three times, so built only once
    limits = exact_quantiles(profiles, {
        "volume": ("Total_Samtal", volume_quantile),
        "handling": ("Genomsnittlig_AHT_Sek", handling_quantile),
    }).first()  # two figures
    sick = (
        (F.upper(trim_blanks(F.col("CustomerKey"))) == SICK_LEAVE_KEY)
        | contains_any(F.col("Name"), ["sjukanmälan"])
        | contains_any(F.col(SERVICE), ["personal", "sjuk"])
    )
    many = F.col("Total_Samtal") > F.lit(limits["volume"])
    long = F.col("Genomsnittlig_AHT_Sek") > F.lit(limits["handling"])
    label = F.concat_ws(
        "_",
        F.when(many, "Hög-Volym").otherwise("Låg-Volym"),
        F.when(long, "Långa-Ärenden").otherwise("Korta-Ärenden"),
    )
    segmented = profiles.withColumn(SEGMENT, F.when(sick, SICK_LEAVE_SEGMENT).otherwise(label))
    return segmented.select(*BEHAVIOR_COLUMNS)


def segment_histogram(segments: DataFrame) -> DataFrame:
    counted = segments.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("Antal"))
    return counted.orderBy(F.desc("Antal"), SEGMENT)


def peak_pattern(calls: DataFrame) -> DataFrame:
    """Busiest weekday and hour of every customer, like ``Mån-9``."""
    busy = (
        calls.where(F.col("CustomerKey").isNotNull())
        .groupBy(
            "CustomerKey", F.weekday("Created").alias("veckodag"), F.hour("Created").alias("timme")
        )
        .agg(F.count("CallId").alias("n"))
    )
    key = F.struct((-F.col("n")).alias("n"), "veckodag", "timme")
    top = busy.groupBy("CustomerKey").agg(F.min(key).alias("top"))
    label = F.concat_ws("-", weekday_name(F.col("top.veckodag")), F.col("top.timme"))
    known = F.col("top.veckodag").isNotNull() & F.col("top.timme").isNotNull()
    return top.select(
        "CustomerKey", F.when(known, label).otherwise(UNCLEAR_PEAK).alias("Peak_Pattern")
    )


def profiles_with_peaks(calls: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Profiles with the peak label attached, ``Oklart`` where a customer has none."""
    joined = lookup_join(
        customer_profiles(calls), peak_pattern(calls), "CustomerKey", settings=settings
    )
    return joined.withColumn("Peak_Pattern", F.coalesce("Peak_Pattern", F.lit(UNCLEAR_PEAK)))


def call_length_class(calls: DataFrame, lower: float = 0.33, upper: float = 0.66) -> DataFrame:
    """Calls with talk time, classed by the quantiles of all of them."""
    talked = calls.where(F.col("TalkTimeInSec") > 0)
    quantiles = exact_quantiles(
        talked, {"lo": ("TalkTimeInSec", lower), "hi": ("TalkTimeInSec", upper)}
    )
    lo = F.when(F.col("lo") == 0, F.lit(1.0)).otherwise(F.col("lo"))
    limits = quantiles.select(lo.alias("lo"), "hi").select(
        F.struct(
            "lo", F.when(F.col("hi") <= F.col("lo"), F.col("lo") + 60).otherwise(F.col("hi"))
            .alias("hi"),
        )
    ).scalar()
    talk = F.col("TalkTimeInSec")
    return talked.withColumn("_limits", limits).withColumn(
        "Samtalstyp",
        F.when(talk < F.col("_limits.lo"), "Kort")
        .when(talk > F.col("_limits.hi"), "Långt").otherwise("Normal"),
    ).drop("_limits")


def monthly_peaks(calls: DataFrame, k: int = 3) -> DataFrame:
    """The k busiest weekday-hours per customer, calendar month and call length class.

    Equal counts are ranked by name, weekday name and hour, the order of the grouped table.
    """
    month, weekday = F.month("Created"), F.weekday("Created")
    keys = ["CustomerKey", "Name", "månad_namn", "månad", "veckodag_namn", "veckodag", "timme",
            "Samtalstyp"]
    timed = call_length_class(calls).withColumns({
        "månad": month, "månad_namn": month_name(month),
        "veckodag": weekday, "veckodag_namn": weekday_name(weekday),
        "timme": F.hour("Created"),
    })
    known = timed.where(
        F.col("CustomerKey").isNotNull() & F.col("Name").isNotNull()
        & F.col("Created").isNotNull()
    )
    counted = known.groupBy(*keys).agg(F.count("CallId").alias("Antal_Samtal_Denna_Timme"))
    group = ["CustomerKey", "månad_namn", "Samtalstyp"]
    shared = counted.withColumn(
        "Procent_Av_Manad_Typ", share(F.col("Antal_Samtal_Denna_Timme"), group)
    )
    order = [F.desc("Antal_Samtal_Denna_Timme"), F.asc("Name"), F.asc("veckodag_namn"),
             F.asc("timme")]
    return top_per_group(shared, group, order, k, "Peak_Rank")


def kmeans_model(profiles: DataFrame, k: int = 4, seed: int = 42) -> PipelineModel:
    return Pipeline(stages=[
        VectorAssembler(inputCols=["Total_Samtal", "Genomsnittlig_AHT_Sek"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        KMeans(featuresCol="scaled", predictionCol="Kluster", k=k, seed=seed, maxIter=100, tol=1e-6),
    ]).fit(profiles)


def kmeans_segments(profiles: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """Clusters of customers on call intensity and handling time."""
    return kmeans_model(profiles, k, seed).transform(profiles).drop("raw", "scaled")


def kmeans_faults(profiles: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """One row: customers, clusters, customers nearer to another centre than to their own, and
    clusters whose centre is not the mean of their members."""
    model = kmeans_model(profiles, k, seed)
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    points = model.transform(profiles).select("Kluster", vector_to_array("scaled").alias("at"))
    gaps = F.array(*[
        sum(((F.col("at")[j] - x) * (F.col("at")[j] - x) for j, x in enumerate(c)), F.lit(0.0)) for c in centres])
    placed = points.select(
        "Kluster", "at", (F.array_min(gaps) < F.get(gaps, F.col("Kluster")) - 1e-9).alias("astray"))
    clusters = placed.groupBy("Kluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("astray").cast("int")).alias("astray"),
        *[F.avg(F.col("at")[j]).alias(f"mean{j}") for j in range(len(centres[0]))])
    known = F.array(*[F.array(*[F.lit(x) for x in c]) for c in centres])
    off = F.lit(False)
    for j in range(len(centres[0])):
        off = off | (F.abs(F.col(f"mean{j}") - F.get(F.get(known, F.col("Kluster")), F.lit(j))) > 1e-6)
    return clusters.agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("clusters"),
        F.sum("astray").alias("astray"), F.sum(off.cast("int")).cast("bigint").alias("off_centre"))
