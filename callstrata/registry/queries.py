"""Registered queries: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.functions import calendar as cal
from callstrata.functions import numbers as num
from callstrata.functions import text as txt
from callstrata.operators import aggregates as agg
from callstrata.operators import columns as cols
from callstrata.operators import filters as flt
from callstrata.operators.grid import fill_grid
from callstrata.operators.joins import lookup_join
from callstrata.operators.windows import lag_days
from callstrata.plans import calls as C
from callstrata.plans import customers as D
from callstrata.plans import evaluate as E
from callstrata.plans import forecast as P
from callstrata.plans import history as H
from callstrata.plans import models as M
from callstrata.plans import run_window as R
from callstrata.plans import segments as S
from callstrata.plans.cases import fact_cases
from callstrata.registry import tables as t
from callstrata.schemas import FOLDED_SERVICE, FORECAST_COLUMNS, SEGMENT, SERVICE
from callstrata.session import cut_lineage, use_checkpoint_dir
from callstrata.settings import Settings
from callstrata.sources import ingest
from callstrata.sources.readers import parquet_source, read_exclusion_list
from callstrata.sources.warehouse import Warehouse

RUN_DATE = date(2024, 2, 1)
FIRST_DAY, LAST_DAY = date(1999, 1, 4), date(2001, 6, 30)
# Read the whole table: the tables span more months than a run normally looks back.
WHOLE = Settings(operational_months_ago=1200)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def _warehouse(spark, name: str) -> Warehouse:
    """A database of its own below the shared checkpoint folder."""
    return Warehouse(spark, f"{use_checkpoint_dir(spark).rstrip('/')}/{name}", name)


# ---- sources, run window -------------------------------------------------------------------

def run_window(spark, sf):
    """The run's period from the latest call, and the calls that fall into it."""
    cases = t.order_cases(spark, sf)
    window = R.run_window(cases, t.SETTINGS)
    return R.within(cases, "Created", window).agg(
        F.count(F.lit(1)).alias("calls"),
        F.max(window.select("start").scalar()).alias("start"),
        F.max(window.select("today").scalar()).alias("today"),
    )


def incremental_load(spark, sf):
    """Rows a load would append to a target that was last loaded in the middle of the month."""
    events = t.table(spark, sf, "events")
    loaded = events.where(F.col("ts") <= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return ingest.new_rows(events, loaded, "ts", ["event_id"])


def incremental_load_ties(spark, sf):
    """Order dates repeat, so the target's last instant is only partly loaded."""
    orders = t.table(spark, sf, "orders")
    at = F.lit("1999-06-01").cast("timestamp_ntz")
    loaded = orders.where(
        (F.col("o_orderdate") < at) | ((F.col("o_orderdate") == at) & (F.col("o_orderstatus") == "F"))
    )
    return ingest.new_rows(orders, loaded, "o_orderdate")


def bronze_load(spark, sf):
    """Status of loading four tables twice, and of one source that does not exist."""
    tag = uuid.uuid4().hex[:8]
    warehouse = _warehouse(spark, f"bronze_{tag}")

    nothing = f"{use_checkpoint_dir(spark)}/nothing-{tag}"
    t.table(spark, sf, "supplier").limit(0).write.parquet(nothing)

    def spec(name, kind, time_col=None, keys=()):
        return ingest.IngestSpec(
            parquet_source(f"{sf}/{name}.parquet"), f"{name}_{tag}", kind, time_col, keys
        )

    specs = [
        spec("events", ingest.INCREMENTAL, "ts", ("event_id",)),
        spec("orders", ingest.INCREMENTAL, "o_orderdate"),
        spec("customer", ingest.FULL), spec("supplier", ingest.FULL), spec("absent", ingest.FULL),
        ingest.IngestSpec(parquet_source(nothing), f"nothing_{tag}", ingest.FULL),
    ]
    runs = [
        ingest.load_all(spark, warehouse, specs).withColumn("run", F.lit(i)) for i in (1, 2)
    ]
    spark.sql(f"DROP DATABASE {warehouse.database} CASCADE")
    return runs[0].unionByName(runs[1]).select(
        "run", F.regexp_replace("target", f"_{tag}$", "").alias("target"), "load_type", "status",
        "written",
    )


def forecast_archive(spark, sf):
    """Two runs archived one after the other, the second one twice: each is kept once."""
    tag = uuid.uuid4().hex[:8]
    warehouse = _warehouse(spark, f"archive_{tag}")
    forecasts = t.order_forecasts(spark, sf)
    first, second = date(2001, 1, 1), date(2001, 2, 1)
    for run in (first, second, second):
        warehouse.archive(
            forecasts.where(F.col("ForecastRunDate") == F.lit(run)), f"archive_{tag}",
            "ForecastRunDate",
        )
    return warehouse.read(f"archive_{tag}").groupBy("ForecastRunDate").agg(
        F.count(F.lit(1)).alias("days"), F.sum("Prognos_Antal_Samtal").alias("volume")
    )


def changed_rows_load(spark, sf):
    """Events loaded twice: in between values change, times move (some beyond the last day) and rows join.

    The second load starts from what the first stored and rewrites the days concerned.
    """
    warehouse = _warehouse(spark, f"changes_{uuid.uuid4().hex[:8]}")
    events = t.table(spark, sf, "events")
    first = events.where(F.col("event_id") % 500 != 3)
    second = events.withColumn(
        "value", F.when(F.col("event_id") % 1000 == 7, F.col("value") + 1).otherwise(F.col("value"))
    ).withColumn("ts", F.when(
        F.col("event_id") % 1500 == 11, F.col("ts") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts")))
    written = [ingest.merge_changes(warehouse, rows, "events", ["event_id"], "ts") for rows in (first, second, second)]
    return warehouse.read("events").select(
        "*", *[F.lit(n).cast("bigint").alias(f"load_{i}") for i, n in enumerate(written, 1)])


# ---- calls and dimensions ------------------------------------------------------------------

def collapse_calls(spark, sf):
    return C.collapse_calls(t.lineitem_legs(spark, sf), t.SETTINGS.exclude_queue_ids)


def customer_mapping(spark, sf):
    return D.customer_mapping(t.customers(spark, sf), t.SETTINGS)


def number_owner(spark, sf):
    return D.one_row_per_number(customer_mapping(spark, sf))


def _enriched(spark, sf):
    excluded = (
        t.table(spark, sf, "supplier").where(F.col("s_acctbal") < 0)
        .select(F.concat(F.lit("031"), F.col("s_suppkey").cast("string")).alias("LandingNumber"))
    )
    legs = t.call_legs(spark, sf).drop("user_id")
    # stored, as it is measured and then joined
    return C.enrich_calls(legs, cut_lineage(number_owner(spark, sf)), t.SETTINGS, excluded)


def enrich_calls(spark, sf):
    return _enriched(spark, sf)


def flag_redials(spark, sf):
    calls = t.call_legs(spark, sf)
    return C.flag_redials(calls, t.SETTINGS.redial_threshold_sec).select(
        "CallId", "CallerNr", "Created", "QueueId", "is_redial"
    )


def training_data(spark, sf):
    return C.training_data(C.flag_redials(_enriched(spark, sf), t.SETTINGS.redial_threshold_sec))


def abandoned_report(spark, sf):
    return C.abandoned_report(_enriched(spark, sf)).select(
        "CallId", "CustomerKey", "Created", "Datum", "LandingNumber", "Name", "QueueId", "Status",
        SERVICE,
    )


def call_measures(spark, sf):
    measured = C.call_measures(t.call_legs(spark, sf))
    return C.with_date(measured).groupBy("Datum", "ChannelType").agg(
        F.sum("is_abandoned").alias("abandoned"), F.sum("is_answered").alias("answered"),
        F.sum("WaitTime").alias("wait"), F.max("WaitTime").alias("longest_wait"),
    )


def dim_customer(spark, sf):
    return D.dim_customer(_enriched(spark, sf))


def dim_phone_lookup(spark, sf):
    return D.dim_phone_lookup(_enriched(spark, sf))


def explode_numbers(spark, sf):
    return D.dim_phone_lookup(
        t.customers(spark, sf).withColumn("CustomerKey", F.col("BillingType"))
    )


def exclusion_list(spark, sf):
    """Landing numbers read back from a file with blanks and repeats; a missing file is empty."""
    folder = f"{use_checkpoint_dir(spark)}/numbers-{uuid.uuid4().hex}"
    numbers = t.table(spark, sf, "supplier").select(
        F.concat(F.lit(" 031"), F.pmod("s_nationkey", F.lit(10)).cast("string"), F.lit(" ")).alias("LandingNumber"))
    numbers.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return read_exclusion_list(spark, folder).unionByName(read_exclusion_list(spark, f"{folder}-absent"))


def dim_queue(spark, sf):
    groups = t.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ID"), F.col("s_name").alias("Name")
    )
    return D.dim_queue(groups)


def anti_semi_filters(spark, sf):
    """Orders of customers that are not listed as overdrawn but belong to an active segment."""
    orders = t.table(spark, sf, "orders")
    customer = t.table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    listed = customer.where(F.col("c_acctbal") < 0).select("o_custkey")
    active = customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("o_custkey")
    kept = lookup_join(orders, listed, "o_custkey", "left_anti", ["o_orderkey"])
    kept = lookup_join(kept, active, "o_custkey", "left_semi", ["o_orderkey"])
    return kept.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_order")
    )


def row_filters(spark, sf):
    """NOT IN with nulls, a period in days and a positive measure."""
    legs = t.call_legs(spark, sf)
    queue = F.when(F.col("ChannelType") == "call", F.col("QueueId"))
    first, last = F.lit(date(2024, 1, 3)), F.lit(date(2024, 1, 20))
    return legs.where(
        flt.not_listed(queue, ["3"])
        & flt.not_listed_if_any(F.col("CallId"), [])
        & flt.on_days(F.col("Created"), first, last)
        & (F.col("TalkTimeInSec") > 0)
    ).select("CallId", "QueueId", "TalkTimeInSec")


def keyword_category(spark, sf):
    parts = t.table(spark, sf, "part").select(F.initcap("p_name").alias("Name"), "p_size")
    return txt.keyword_category(parts, t.SETTINGS.customer_categories).groupBy("kategori").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
    )


def subsidiary_flag(spark, sf):
    customer = t.customers(spark, sf)
    parent = F.when(F.col("BillingType") != "BUILDING", F.col("ParentId").cast("string"))
    return customer.select("CustomerId", txt.has_parent(parent).alias("subsidiary"))


def string_cleaning(spark, sf):
    c_name, c_key = F.col("c_name"), F.col("c_custkey").cast("string")
    padded = F.concat(F.lit(" \t"), c_name, F.lit(" \n"))
    dirty = F.concat(F.lit("55-"), c_key, F.lit("-7 AB"))
    return t.table(spark, sf, "customer").select(
        "c_custkey",
        txt.trim_blanks(padded).alias("trimmed"),
        txt.digits_only(c_name).alias("digits"),
        F.length(txt.digits_only(c_name)).alias("n_digits"),
        txt.alnum_only(c_name).alias("alnum"),
        txt.clean_org_number(dirty).alias("org"),
        txt.clean_org_number(c_name).alias("no_org"),
        txt.contains_any(F.col("c_mktsegment"), ["build", "auto"]).alias("has_word"),
        F.concat_ws("_", F.upper("c_mktsegment"), c_key).alias("label"),
    )


def number_rounding(spark, sf):
    half = F.col("l_quantity") * 0.5
    low, high = num.band(F.col("l_quantity").cast("bigint"))
    return t.table(spark, sf, "lineitem").groupBy(
        num.round_half_even(half).alias("half_even"),
        low.alias("low"), high.alias("high"),
        num.at_least_zero(F.col("l_quantity").cast("bigint") - 20).alias("clipped"),
        F.round(num.ratio(F.col("l_discount"), F.col("l_tax")), 6).alias("ratio"),
    ).agg(F.count(F.lit(1)).alias("n"))


def wall_time(spark, sf):
    """Times written with a zone offset keep the time on the clock."""
    texts = t.table(spark, sf, "events").select(
        "event_id", F.concat(F.col("ts").cast("string"), F.lit("+05:30")).alias("written"),
        "ts",
    )
    return cols.wall_time(texts, "written", "ts")


def column_projection(spark, sf):
    """Rename, default, keep existing columns and fold names."""
    customer = t.customers(spark, sf)
    renamed = cols.rename(customer, {"Name": "Kundens namn", "BillingType": "är_typ"})
    filled = cols.fill_defaults(renamed, {"OrganisationNumber": "Oklart"})
    kept = cols.keep_existing(
        filled, ["CustomerId", "Kundens namn", "är_typ", "OrganisationNumber", "Saknas"]
    )
    return cols.fold_names(kept)


# ---- segments ------------------------------------------------------------------------------

def customer_profiles(spark, sf):
    return S.customer_profiles(t.silver_calls(spark, sf))


def customer_segments(spark, sf):
    return S.customer_segments(t.silver_calls(spark, sf))


def segment_histogram(spark, sf):
    return S.segment_histogram(customer_segments(spark, sf))


def peak_pattern(spark, sf):
    return S.profiles_with_peaks(t.silver_calls(spark, sf)).select(
        "CustomerKey", "Total_Samtal", "Peak_Pattern"
    )


def exact_quantiles(spark, sf):
    return _rounded(agg.exact_quantiles(t.table(spark, sf, "orders"), {
        "p33": ("o_totalprice", 0.33), "p50": ("o_totalprice", 0.50),
        "p66": ("o_totalprice", 0.66), "p80": ("o_totalprice", 0.80),
        "key_p10": ("o_custkey", 0.10),
    }), 4)


def call_length_class(spark, sf):
    return S.call_length_class(t.silver_calls(spark, sf)).groupBy("Samtalstyp").agg(
        F.count(F.lit(1)).alias("n"), F.min("TalkTimeInSec").alias("shortest"),
        F.max("TalkTimeInSec").alias("longest"),
    )


def monthly_peaks(spark, sf):
    return _rounded(S.monthly_peaks(t.silver_calls(spark, sf)))


def kmeans_check(spark, sf):
    """Customers, clusters, and what would be wrong with them."""
    return S.kmeans_faults(cut_lineage(S.customer_profiles(t.silver_calls(spark, sf))))


def kmeans_segments(spark, sf):
    return S.kmeans_segments(S.customer_profiles(t.silver_calls(spark, sf)))


# ---- calendar, history ---------------------------------------------------------------------

def calendar_features(spark, sf):
    days = t.table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("ds")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return _rounded(cal.calendar_features(days))


def day_parts(spark, sf):
    events = cal.calendar_features(t.table(spark, sf, "events"), "ts")
    return events.groupBy(
        "timme", "veckodag_namn", "ar_tidig_morgon", "ar_formiddag", "ar_lunchtid",
        "ar_eftermiddag",
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("minut").alias("minutes"))


def holiday_orders(spark, sf):
    """Every holiday of the years that have orders, with its number of orders."""
    orders = t.table(spark, sf, "orders")
    holidays = cal.holiday_dim(orders.select(F.year("o_orderdate").alias("year")))
    days = orders.groupBy(F.to_date("o_orderdate").alias("ds")).agg(F.count(F.lit(1)).alias("n"))
    return holidays.join(days, "ds", "left").select(
        "ds", "holiday", "is_eve", F.coalesce("n", F.lit(0)).alias("n")
    )


def daily_lags(spark, sf):
    days = cut_lineage(t.order_days(spark, sf))
    bounds = days.agg(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    grid = fill_grid(
        days, ["priority"], "ds", ["n"], bounds.getField("lo"), bounds.getField("hi"), "day"
    )
    return lag_days(grid, ["priority"], "ds", "n", H.LAG_DAYS, rows_per_day=1)


def _history(spark, sf):
    calls = t.silver_calls(spark, sf)
    return H.hourly_history(calls, S.customer_segments(calls), t.SETTINGS)


def hourly_history(spark, sf):
    """Flagship: gap-free hourly history by service and segment with features and lags."""
    return _rounded(_history(spark, sf))


def _hours(spark, sf):
    """The hourly history as stored between two jobs."""
    return cut_lineage(
        _history(spark, sf).select("ds", FOLDED_SERVICE, SEGMENT, *H.MEASURES)
    )


def volume_training_set(spark, sf):
    return _rounded(H.volume_training_set(_hours(spark, sf)))


def aht_training_set(spark, sf):
    return _rounded(H.aht_training_set(_hours(spark, sf)))


# ---- forecast ------------------------------------------------------------------------------

def _start(hours):
    return F.date_add(F.to_date(hours.agg(F.max("ds")).scalar()), 1)


def weekday_average(spark, sf):
    hours = _hours(spark, sf)
    return _rounded(P.weekday_average(P.daily_history(hours, _start(hours)), _start(hours)))


def weekday_average_orders(spark, sf):
    """Years of orders, of which the look-back and the statistic's weeks leave out most."""
    hours = t.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("ds"), F.col("o_orderpriority").alias(FOLDED_SERVICE), F.lit(1).alias("Antal_Samtal"))
    start = _start(hours)
    return _rounded(P.weekday_average(P.daily_history(hours, start), start))


def recursive_forecast(spark, sf):
    hours = _hours(spark, sf)
    start = _start(hours)
    return P.recursive_forecast(P.daily_history(hours, start), start, t.SETTINGS.horizon_days)


def history_and_forecast(spark, sf):
    """History and forecast in one series; columns one side lacks are null there."""
    hours = _hours(spark, sf)
    start = _start(hours)
    daily = P.daily_history(hours, start)
    forecast = P.recursive_forecast(daily, start, t.SETTINGS.horizon_days)
    return daily.unionByName(
        forecast.withColumnRenamed("Prognos_Volym", "Antal_Samtal"), allowMissingColumns=True
    )


def hourly_shape(spark, sf):
    hours = _hours(spark, sf)
    return _rounded(P.hourly_shape(hours, hours, t.SETTINGS))


def _forecast(spark, sf):
    hours = _hours(spark, sf)
    return P.create_forecast(hours, _start(hours), RUN_DATE, t.SETTINGS)


def allocate_hours(spark, sf):
    return _forecast(spark, sf).select(*FORECAST_COLUMNS)


def allocate_whole(spark, sf):
    """The hourly forecast with every day's total kept."""
    hours = _hours(spark, sf)
    return P.create_forecast(hours, _start(hours), RUN_DATE, t.SETTINGS, keep_totals=True).select(*FORECAST_COLUMNS)


def spread_checksum(spark, sf):
    hours = _hours(spark, sf)
    start = _start(hours)
    daily = cut_lineage(
        P.recursive_forecast(P.daily_history(hours, start), start, t.SETTINGS.horizon_days)
    )
    spread = P.allocate_hours(
        daily, P.service_segments(hours), P.hourly_shape(hours, daily, t.SETTINGS), RUN_DATE,
        t.SETTINGS,
    )
    return P.spread_checksum(daily, spread)


# ---- models --------------------------------------------------------------------------------

def train_volume(spark, sf):
    training = _hours_days(spark, sf)
    return M.predict_volume(M.train_volume(training), training).select("ds", FOLDED_SERVICE, "Antal_Samtal", "prediction")


def volume_model_check(spark, sf):
    """Rows, whether the score equation of the linear model's intercept holds, and whether it errs less than
    last week's value does."""
    training = _hours_days(spark, sf)
    scored = M.predict_volume(M.train_volume(training, learner="linear"), training)
    y, mu, last = F.col("Antal_Samtal").cast("double"), F.col("prediction"), F.col("Antal_Samtal_lag_7d")
    weight = F.pow(mu, -0.5)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.abs(F.sum((y - mu) * weight)) <= 1e-3 * F.sum(y * weight)).alias("balanced"),
        (F.sum(F.when(last.isNotNull(), F.abs(y - mu))) < F.sum(F.abs(y - last))).alias("better"),
    )


def _deviance(y, mu):
    """Tweedie deviance of variance power 1.5, without the factor 2."""
    mu = F.greatest(mu, F.lit(1e-9))
    return y / F.sqrt(mu) * 2 + F.sqrt(mu) * 2 - F.sqrt(y) * 4


def boosted_volume_check(spark, sf):
    """Rows, and whether the boosted Tweedie model deviates less than last week's value does."""
    training = _hours_days(spark, sf)
    scored = M.predict_volume(M.train_volume(training), training)
    y, last = F.col("Antal_Samtal").cast("double"), F.col("Antal_Samtal_lag_7d").cast("double")
    own = F.sum(F.when(last.isNotNull(), _deviance(y, F.col("prediction"))))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.col("prediction") > 0).alias("positive"),
        (own < F.sum(_deviance(y, last))).alias("better"))


def _shipping_days(spark, sf):
    """Years of shipped lines as a daily volume training set."""
    lines = t.table(spark, sf, "lineitem").where("l_shipdate IS NOT NULL").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("ds"), F.lit("all").alias(FOLDED_SERVICE), F.lit(1).alias("Antal_Samtal"))
    return cut_lineage(H.volume_training_set(lines))


def volume_band_check(spark, sf):
    """Rows, the last half year's rows, which no model has seen, and whether 70 to 90 % of them lie in the band."""
    training = _shipping_days(spark, sf)
    late = F.col("ds") > F.date_sub(training.agg(F.max("ds")).scalar(), 182)
    band = M.train_volume_band(training.where(~late), holdout_days=182)
    inside = F.col("Antal_Samtal").between(F.col("low"), F.col("high")).cast("int")
    return band.predict(training).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(late.cast("int")).cast("bigint").alias("unseen"),
        F.avg(F.when(late, inside)).between(0.7, 0.9).alias("covered"))


def volume_band_residuals(spark, sf):
    """The bounds' residual quantiles, of last week's value as the predictor."""
    training = _hours_days(spark, sf).where(F.col("Antal_Samtal_lag_7d").isNotNull())
    error = (F.col("Antal_Samtal") - F.col("Antal_Samtal_lag_7d")).cast("double")
    return _rounded(M.residual_quantiles(training, error))


def _hours_days(spark, sf):
    return cut_lineage(H.volume_training_set(_hours(spark, sf)))


def model_inputs(spark, sf):
    """What the volume models are fed, one row per service and day."""
    fed = M.volume_features(_hours_days(spark, sf))
    switches = [f"weekday_{k}_x" for k in (1, 6)] + [f"month_{k}_x" for k in (2, 12)]
    return _rounded(fed.select("ds", FOLDED_SERVICE, *[f"{c}_x" for c in M.lag_columns()], *switches))


def saved_model(spark, sf):
    """Rows, and rows whose prediction changes when the models are saved and loaded."""
    training = _hours_days(spark, sf)
    both = training.select("ds", FOLDED_SERVICE)
    changed = F.lit(False)
    for learner in ("linear", "boosted"):
        model, path = M.train_volume(training, learner=learner), f"{use_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
        M.save_volume(model, path)
        for name, of in (("own", model), ("kept", M.load_volume(spark, path))):
            scored = M.predict_volume(of, training).select("ds", FOLDED_SERVICE, F.col("prediction").alias(f"{learner}_{name}"))
            both = both.join(scored, ["ds", FOLDED_SERVICE])
        changed = changed | (F.col(f"{learner}_own") != F.col(f"{learner}_kept"))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sum(changed.cast("int")).cast("bigint").alias("changed"))


def train_volume_band(spark, sf):
    training = _hours_days(spark, sf)
    return M.train_volume_band(training, holdout_days=7).predict(training).select(
        "ds", FOLDED_SERVICE, "Antal_Samtal", "low", "median", "high")


def _handling(spark, sf):
    training = cut_lineage(H.aht_training_set(_hours(spark, sf)))
    return M.train_handling(training).with_scores(training, **{f"{c}_modell": c for c in M.HANDLING})


def train_handling(spark, sf):
    return _handling(spark, sf).select(
        "ds", SEGMENT, *[name for c in M.HANDLING for name in (c, f"{c}_modell")])


def handling_check(spark, sf):
    """Rows, and whether each handling model errs less than the mean does."""
    scored = _handling(spark, sf)
    off = {c: F.sum(F.pow(F.col(c) - F.col(f"{c}_modell"), 2)) for c in M.HANDLING}
    return scored.agg(F.count(F.lit(1)).alias("rows"), *[
        (off[c] < F.var_pop(c) * F.count(F.lit(1))).alias(f"{name}_better") for name, c in zip(("talk", "wait"), M.HANDLING, strict=True)])


def model_forecast(spark, sf):
    """The recursive forecast driven by the trained volume model."""
    hours = _hours(spark, sf)
    start = _start(hours)
    model = M.train_volume(cut_lineage(H.volume_training_set(hours)))
    return P.recursive_forecast(P.daily_history(hours, start), start, t.SETTINGS.horizon_days, model)


def model_forecast_check(spark, sf):
    """The forecast driven by each learner: services, days, and days without a volume of 0 or more."""
    hours = _hours(spark, sf)
    start, daily = _start(hours), P.daily_history(hours, _start(hours))
    training, out = cut_lineage(H.volume_training_set(hours)), None
    for learner in ("linear", "boosted"):
        made = P.recursive_forecast(daily, start, t.SETTINGS.horizon_days, M.train_volume(training, learner=learner))
        row = made.agg(
            F.lit(learner).alias("learner"), F.count_distinct(FOLDED_SERVICE).alias("services"), F.count_distinct("ds").alias("days"),
            F.count(F.lit(1)).alias("rows"), F.count(F.when(~F.coalesce(F.col("Prognos_Volym") >= 0, F.lit(False)), 1)).alias("wrong"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- evaluation, cases ---------------------------------------------------------------------

def latest_run(spark, sf):
    return E.latest_run(t.order_forecasts(spark, sf), FIRST_DAY, LAST_DAY)


def evaluation_days(spark, sf):
    return E.evaluation_days(
        t.order_forecasts(spark, sf), t.order_volumes(spark, sf), FIRST_DAY, LAST_DAY
    )


def evaluate_forecast(spark, sf):
    return _rounded(E.evaluate_forecast(evaluation_days(spark, sf)))


def trend_series(spark, sf):
    return E.trend_series(evaluation_days(spark, sf))


def total_series(spark, sf):
    return _rounded(E.total_series(E.evaluate_forecast(evaluation_days(spark, sf))))


def fact_cases_query(spark, sf):
    cases = t.order_cases(spark, sf)
    users = t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("UserId"), F.col("c_name").alias("Name")
    )
    return fact_cases(cases, users, R.run_window(cases, WHOLE), t.SETTINGS)


def all_queries() -> dict:
    found = [
        run_window, incremental_load, incremental_load_ties, changed_rows_load, bronze_load, forecast_archive,
        collapse_calls, customer_mapping, number_owner, enrich_calls, flag_redials,
        training_data, abandoned_report, call_measures, dim_customer, dim_phone_lookup,
        explode_numbers, dim_queue, exclusion_list, anti_semi_filters, row_filters, keyword_category,
        subsidiary_flag, string_cleaning, number_rounding, column_projection, wall_time,
        customer_profiles, customer_segments, segment_histogram, peak_pattern, exact_quantiles,
        call_length_class, monthly_peaks, kmeans_segments, kmeans_check,
        calendar_features, day_parts, holiday_orders, daily_lags, hourly_history,
        volume_training_set, aht_training_set,
        weekday_average, weekday_average_orders, recursive_forecast, history_and_forecast, hourly_shape, allocate_hours,
        allocate_whole, spread_checksum,
        volume_model_check, volume_band_residuals, model_inputs, saved_model,
        train_volume, train_volume_band, train_handling, model_forecast,
        boosted_volume_check, volume_band_check, handling_check, model_forecast_check,
        latest_run, evaluation_days, evaluate_forecast, trend_series, total_series,
    ]
    return {f.__name__: f for f in found} | {"fact_cases": fact_cases_query}
