"""Explicit schemas (as DDL) and published column names of every table."""

from __future__ import annotations

# Published column names that are not plain ASCII.
SERVICE = "TjänstTyp"
SUBSIDIARY = "är_dotterbolag"
FORECAST_LOW = "Prognos_Låg"
FORECAST_HIGH = "Prognos_Hög"

SEGMENT = "Behavior_Segment"
# The hourly history is published with ASCII-folded names.
FOLDED_SERVICE = "Tj_nstTyp"

# Defaults written where a lookup finds nothing (fixed values).
UNKNOWN_CUSTOMER_NAME = "Okänd Kund"
UNKNOWN_CUSTOMER_KEY = "Okänd"
UNKNOWN_QUEUE = "Okänd Kö"
UNKNOWN_SERVICE_TYPE = "Okänd Typ"
UNKNOWN_SEGMENT = "Okänt"
UNKNOWN_CATEGORY = "Okänd"
OTHER_CATEGORY = "Övrigt"
UNCLEAR_PEAK = "Oklart"

ABANDONED = "callabandoned"


BRONZE = {
    "cdr": (
        "CallId STRING, Status STRING, Created TIMESTAMP_NTZ, LandingNumber STRING, "
        "ChannelType STRING, QueueId STRING, callerNr STRING, TalkTimeInSec BIGINT, "
        "Duration BIGINT, CaseId STRING"
    ),
    "cases": (
        "CaseId STRING, Status STRING, Created TIMESTAMP_NTZ, InternalType STRING, "
        "UserId BIGINT, GroupId STRING"
    ),
    "customers": (
        "CustomerId BIGINT, ParentId BIGINT, Name STRING, OrganisationNumber STRING, "
        "LandingNumber STRING, BillingType STRING"
    ),
    "groups": "ID STRING, Name STRING",
    "users": "UserId BIGINT, Name STRING",
}

EXCLUDED_NUMBERS = "LandingNumber STRING"

TRAINING_COLUMNS = [
    "CallId", "CaseId", "Created", "Status", "Duration", "TalkTimeInSec", "ChannelType",
    "LandingNumber", "CallerNr", "QueueId", "Name", "CustomerKey", SUBSIDIARY, SERVICE,
    "is_redial",
]

CUSTOMER_DIM_COLUMNS = [
    "CustomerId", "Name", "CustomerKey", "ParentId", "ParentName", "BillingType",
    SUBSIDIARY, "LandingNumber",
]

PHONE_DIM_COLUMNS = ["CustomerId", "LandingNumber", "CustomerKey"]

BEHAVIOR_COLUMNS = [
    "CustomerKey", "Name", SERVICE, "Total_Samtal", "Genomsnittlig_AHT_Sek", SEGMENT,
]

FORECAST_COLUMNS = [
    "DatumTid", SERVICE, SEGMENT, "Prognos_Antal_Samtal", FORECAST_LOW, FORECAST_HIGH,
    "Prognos_Snitt_Taltid_Sek", "ForecastRunDate",
]
