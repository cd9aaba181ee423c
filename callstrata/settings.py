"""One immutable settings object shared by every job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

LIVE = "LIVE"
VALIDATION = "VALIDATION"


@dataclass(frozen=True)
class ValidationPeriod:
    """Dates used when a run is scored against a known period."""

    training_end: date
    evaluation_start: date
    evaluation_end: date
    forecast_run_date: date


@dataclass(frozen=True)
class Settings:
    # logical table -> physical name
    bronze_tables: Mapping[str, str] = field(
        default_factory=lambda: {
            "cdr": "Bronze_Queue_CDR",
            "cases": "Bronze_Cases",
            "customers": "Bronze_Billing_Customers",
            "groups": "Bronze_Queue_Groups",
            "users": "Bronze_Case_Users",
        }
    )
    table_names: Mapping[str, str] = field(
        default_factory=lambda: {
            "Operative_Training_Data": "Operative_Training_Data",
            "Abandoned_Calls_Report": "Abandoned_Calls_Report",
            "Customer_Dimension": "Customer_Dimension",
            "Phone_Lookup_Dimension": "Phone_Lookup_Dimension",
            "Queue_Dimension": "Queue_Dimension",
            "Customer_Behavior_Dimension": "Customer_Behavior_Dimension",
            "Monthly_Peak_Analysis": "Dim_Customer_Monthly_Peaks",
            "Hourly_Aggregated_History": "Hourly_Aggregated_History",
            "Operative_Forecast": "Operative_Forecast",
            "Forecast_Archive": "Forecast_Archive",
            "Raw_Cases": "Fact_Cases",
        }
    )
    run_mode: str = LIVE
    validation: ValidationPeriod | None = None
    operational_months_ago: int = 16
    forecast_horizon_days: int = 14
    holdout_period_days: int = 14
    fallback_today: date = date(2025, 10, 10)

    exclude_queue_ids: Sequence[str] = ()
    exclude_customer_ids: Sequence[int] = ()
    exclude_numbers_file: str | None = None
    queue_to_service: Mapping[str, str] = field(default_factory=dict)
    customer_categories: Mapping[str, Sequence[str]] = field(default_factory=dict)
    redial_threshold_sec: int = 300
    call_channel_name: str = "call"
    project_timezone: str = "Europe/Stockholm"

    warehouse_dir: str = "warehouse"
    database: str = "callstrata"
    model_dir: str = "models"

    # physical limits
    broadcast_bytes: int = 64 * 1024 * 1024
    join_salts: int = 32

    @property
    def is_validation(self) -> bool:
        return self.run_mode == VALIDATION

    @property
    def horizon_days(self) -> int:
        return self.holdout_period_days if self.is_validation else self.forecast_horizon_days

    @property
    def pinned_today(self) -> date | None:
        """Day after the last day a validation run may read; None when live."""
        if not self.is_validation or self.validation is None:
            return None
        last = self.validation.evaluation_end or self.validation.training_end
        return date.fromordinal(last.toordinal() + 1)
