"""Case facts for reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.operators.filters import not_listed
from callstrata.operators.joins import lookup_join
from callstrata.plans.run_window import RunWindow, within
from callstrata.settings import Settings


def fact_cases(
    cases: DataFrame, users: DataFrame, window: RunWindow | DataFrame, settings: Settings
) -> DataFrame:
    """Call cases of the period with the agent's name; excluded and missing groups are dropped."""
    wanted = within(cases, "Created", window).where(
        (F.col("InternalType") == settings.call_channel_name)
        & not_listed(F.col("GroupId"), settings.exclude_queue_ids)
    )
    agents = users.select("UserId", F.col("Name").alias("AgentName"))
    return lookup_join(
        wanted, agents, "UserId", "left", spread_by=["CaseId"], settings=settings
    ).select(
        "CaseId", "Status", "Created", "InternalType", "UserId", "AgentName",
        F.col("GroupId").alias("QueueId"),
    )
