from datetime import date, datetime

from callstrata.schemas import BRONZE

SILVER = (
    "CallId STRING, CaseId STRING, Created TIMESTAMP_NTZ, Status STRING, Duration BIGINT, "
    "TalkTimeInSec BIGINT, ChannelType STRING, LandingNumber STRING, CallerNr STRING, "
    "QueueId STRING, Name STRING, CustomerKey STRING, `är_dotterbolag` INT, `TjänstTyp` STRING"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def frame(spark, ddl, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], ddl)


def records(spark, ddl, *rows):
    """Rows given as dicts; absent columns are null."""
    empty = spark.createDataFrame([], ddl)
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in rows], empty.schema)


def bronze(spark, table, *rows):
    return records(spark, BRONZE[table], *rows)


def silver(spark, *rows):
    base = {"Status": "CallAnswered", "ChannelType": "call", "Duration": 100, "TalkTimeInSec": 60,
            "TjänstTyp": "Support", "CustomerKey": "A", "Name": "Alfa", "är_dotterbolag": 0}
    return records(
        spark, SILVER,
        *[{**base, "CallId": str(i), **row} for i, row in enumerate(rows)],
    )


def dicts(df):
    return [r.asDict() for r in df.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
