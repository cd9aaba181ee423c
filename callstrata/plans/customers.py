"""Customer mapping and the dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.functions.text import customer_key, explode_list, is_blank
from callstrata.operators.aggregates import first_rows
from callstrata.operators.columns import keep_existing, rename
from callstrata.operators.filters import not_listed_if_any
from callstrata.operators.joins import lookup_join
from callstrata.schemas import CUSTOMER_DIM_COLUMNS, PHONE_DIM_COLUMNS
from callstrata.settings import Settings


def customer_mapping(
    customers: DataFrame, settings: Settings | None = None,
    exclude_ids: Sequence[int] | None = None,
) -> DataFrame:
    """One row per (customer, landing number) with its key and its parent's name."""
    settings = settings or Settings()
    exclude_ids = settings.exclude_customer_ids if exclude_ids is None else exclude_ids
    parents = customers.select(
        F.col("CustomerId").alias("ParentId"),
        F.col("Name").alias("ParentName"),
        F.col("OrganisationNumber").alias("ParentOrganisationNumber"),
    )
    wanted = customers.where(
        ~is_blank(F.col("LandingNumber"))
        & not_listed_if_any(F.col("CustomerId"), list(exclude_ids))
    )
    joined = lookup_join(
        wanted, parents, "ParentId", "left", spread_by=["CustomerId"], settings=settings
    )
    keyed = joined.withColumn(
        "CustomerKey",
        customer_key(
            F.col("OrganisationNumber"), F.col("ParentOrganisationNumber"),
            F.col("CustomerId"), F.col("Name"),
        ),
    )
    return explode_list(keyed, "LandingNumber").select(
        "LandingNumber", "CustomerKey", "CustomerId", "Name", "ParentId", "ParentName",
        "BillingType",
    )


def one_row_per_number(mapping: DataFrame) -> DataFrame:
    """Keep the smallest customer key of a shared number, so no call is counted twice."""
    return first_rows(mapping, ["LandingNumber"], ["CustomerKey", "CustomerId"])


def dim_customer(enriched: DataFrame) -> DataFrame:
    """The attributes of each customer key as seen on its earliest call."""
    columns = keep_existing(enriched, [*CUSTOMER_DIM_COLUMNS, "Created", "CallId"])
    first = first_rows(columns, ["CustomerKey"], ["Created", "CallId"])
    return keep_existing(first, CUSTOMER_DIM_COLUMNS)


def dim_phone_lookup(enriched: DataFrame) -> DataFrame:
    numbers = keep_existing(enriched, PHONE_DIM_COLUMNS).where(F.col("LandingNumber").isNotNull())
    return explode_list(numbers, "LandingNumber").distinct()


def dim_queue(groups: DataFrame) -> DataFrame:
    return rename(groups.select("ID", "Name"), {"ID": "QueueId", "Name": "QueueName"})
