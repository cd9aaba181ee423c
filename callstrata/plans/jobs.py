"""The jobs of a full run, each reading and publishing warehouse tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.plans import calls as C
from callstrata.plans import customers as D
from callstrata.plans import evaluate as E
from callstrata.plans import history as H
from callstrata.plans import models as M
from callstrata.plans import segments as S
from callstrata.plans.boosting import Growth, load_boosted
from callstrata.plans.cases import fact_cases
from callstrata.plans.forecast import create_forecast
from callstrata.plans.run_window import RunWindow, window_of, within
from callstrata.session import cut_lineage, shared_path
from callstrata.settings import Settings
from callstrata.sources.ingest import bronze_specs, load_all
from callstrata.sources.readers import SourceSpec, read_exclusion_list
from callstrata.sources.warehouse import Warehouse


class Jobs:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark = spark
        self.settings = settings
        self.warehouse = Warehouse(spark, settings.warehouse_dir, settings.database)
        self.model_dir = shared_path(spark, settings.model_dir)

    def _bronze(self, table: str) -> DataFrame:
        return self.warehouse.read(self.settings.bronze_tables[table])

    def _window(self) -> RunWindow:
        latest = self.warehouse.latest(self.settings.bronze_tables["cdr"], "Created")
        return window_of(self.spark, latest, self.settings)

    def _period(self, table: str, window: RunWindow) -> DataFrame:
        return self.warehouse.read_days(self.settings.bronze_tables[table], window.start, window.today)

    def _table(self, table: str) -> DataFrame:
        return self.warehouse.read(self.settings.table_names[table])

    def _publish(self, df: DataFrame, table: str, **options) -> int:
        return self.warehouse.publish(df, self.settings.table_names[table], **options)

    def load_bronze(self, sources: dict[str, SourceSpec]) -> DataFrame:
        return load_all(self.spark, self.warehouse, bronze_specs(sources, self.settings))

    def extract(self) -> dict[str, int]:
        """Silver calls, the abandoned report and the three dimensions."""
        settings = self.settings
        window = self._window()
        legs = self._period("cdr", window)
        collapsed = C.collapse_calls(within(legs, "Created", window), settings.exclude_queue_ids)
        mapping = cut_lineage(  # read twice: measured, then joined
            D.one_row_per_number(D.customer_mapping(self._bronze("customers"), settings))
        )
        excluded = read_exclusion_list(self.spark, settings.exclude_numbers_file)
        enriched = C.flag_redials(
            C.enrich_calls(collapsed, mapping, settings, excluded), settings.redial_threshold_sec
        )
        # Written once. The training data is a projection of it, the rest reads it back.
        silver, training = "Silver_Enriched_Calls", "Operative_Training_Data"
        dated = C.with_date(enriched)
        rows = {silver: self.warehouse.publish(
            dated, silver, partition_by=["Datum"],
            projections={settings.table_names[training]: C.training_data(enriched).columns},
        )}
        rows[training] = rows[silver]
        stored = self.warehouse.read(silver)
        marts = {
            "Abandoned_Calls_Report": (C.abandoned_report(stored), ["Datum"]),
            "Customer_Dimension": (D.dim_customer(stored), []),
            "Phone_Lookup_Dimension": (D.dim_phone_lookup(stored), []),
            "Queue_Dimension": (D.dim_queue(self._bronze("groups")), []),
        }
        for table, (df, partitions) in marts.items():
            rows[table] = self._publish(df, table, partition_by=partitions)
        return rows

    def segment(self) -> dict[str, int]:
        calls = self._table("Operative_Training_Data")
        return {
            "Customer_Behavior_Dimension": self._publish(
                S.customer_segments(calls), "Customer_Behavior_Dimension"
            ),
            "Monthly_Peak_Analysis": self._publish(
                S.monthly_peaks(calls), "Monthly_Peak_Analysis"
            ),
        }

    def train(self, learner: str = "boosted", growth: Growth = Growth()) -> dict[str, int]:
        """Publish the hourly history and save the volume, talk-time and wait-time models.

        A validation run learns from days before the forecast only, so that it is scored on days
        no model has seen.
        """
        settings = self.settings
        segments = self.warehouse.read_or_none(settings.table_names["Customer_Behavior_Dimension"])
        history = H.hourly_history(self._table("Operative_Training_Data"), segments, settings)
        rows = {"Hourly_Aggregated_History": self._publish(history, "Hourly_Aggregated_History")}
        stored = self._table("Hourly_Aggregated_History")
        if settings.is_validation:
            stored = stored.where(F.col("ds") < F.lit(self.forecast_start()).cast("timestamp_ntz"))
        daily = H.volume_training_set(stored).persist()
        handling = H.aht_training_set(stored).persist()
        M.save_volume(M.train_volume(daily, learner=learner, growth=growth), self._model("volume_operative"))
        bounds = M.train_volume_band(daily, growth=growth)
        bounds.models.save(self._model("volume_band"))
        bounds.residuals.write.mode("overwrite").parquet(self._model("volume_residuals"))
        M.train_handling(handling, growth).save(self._model("handling"))
        daily.unpersist()
        handling.unpersist()
        return rows

    def _model(self, name: str) -> str:
        return f"{self.model_dir}/{name}"

    def forecast_start(self) -> date:
        """The day after the history ends, or after the training period when validating."""
        settings = self.settings
        if settings.is_validation and settings.validation is not None:
            return date.fromordinal(settings.validation.training_end.toordinal() + 1)
        last = self._table("Hourly_Aggregated_History").agg(
            F.date_add(F.to_date(F.max("ds")), 1).alias("d")
        ).first()["d"]
        return last or settings.fallback_today

    def forecast(
        self, run_date: date, modelled: bool = False, close_holidays: bool = False
    ) -> dict[str, int]:
        """Publish the live forecast and add the run to the archive.

        ``modelled`` takes bounds and talk times from the trained models instead of constants.
        """
        settings = self.settings
        model = M.load_volume(self.spark, self._model("volume_operative"))
        handling = residuals = None
        if modelled:
            handling = load_boosted(self.spark, self._model("handling"))
            residuals = self.spark.read.parquet(self._model("volume_residuals"))
        hourly = self._table("Hourly_Aggregated_History")
        forecast = create_forecast(
            hourly, self.forecast_start(), run_date, settings, model, handling, residuals,
            close_holidays,
        )
        rows = {"Operative_Forecast": self._publish(forecast, "Operative_Forecast")}
        rows["Forecast_Archive"] = self.warehouse.archive(
            self._table("Operative_Forecast"), settings.table_names["Forecast_Archive"],
            "ForecastRunDate",
        )
        return rows

    def evaluate(self, first: date | None = None, last: date | None = None) -> tuple[DataFrame, DataFrame]:
        """(compared days, one summary row) of a period, by default the validation period."""
        period = self.settings.validation
        first = first or period.evaluation_start
        last = last or period.evaluation_end
        days = E.evaluation_days(
            self._table("Forecast_Archive"), self._table("Hourly_Aggregated_History"), first, last
        )
        return days, E.evaluate_forecast(days)

    def sync_cases(self) -> dict[str, int]:
        window = self._window()
        facts = fact_cases(
            self._period("cases", window), self._bronze("users"), window, self.settings)
        return {"Raw_Cases": self._publish(facts, "Raw_Cases")}
