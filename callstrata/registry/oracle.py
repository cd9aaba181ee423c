"""The registered queries in SQL, written independently of the DataFrame plans."""

from __future__ import annotations

# ---- the given tables dressed as contact-centre tables --------------------------------------

CALL_LEGS = """call_legs AS (
  SELECT CAST(event_id AS VARCHAR) AS "CallId",
         'C' || CAST(event_id AS VARCHAR) AS "CaseId",
         ts AS "Created",
         CASE WHEN event_type = 'error' THEN 'CallAbandoned' ELSE 'CallAnswered' END AS "Status",
         CAST(floor(value * 10) AS BIGINT) + k - 20 AS "Duration",
         CAST(floor(value * 10) AS BIGINT) AS "TalkTimeInSec",
         CASE WHEN event_type = 'signup' THEN 'email' ELSE 'call' END AS "ChannelType",
         CASE WHEN k = 99 THEN ' '
              WHEN event_type IN ('view', 'click') THEN '08' || user_id
              WHEN event_type = 'error' THEN ' 031' || user_id
              WHEN event_type = 'purchase' THEN '0771' || (k // 4) END AS "LandingNumber",
         CASE WHEN k < 5 THEN 'anonym'
              ELSE '+46 70-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS "CallerNr",
         CAST(k // 25 AS VARCHAR) AS "QueueId",
         user_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

_SERVICE = """CASE "QueueId" WHEN '0' THEN 'Kundtjänst' WHEN '1' THEN 'Teknisk Support'
         WHEN '2' THEN 'Personal' ELSE 'Okänd Kö' END"""

SILVER_CALLS = CALL_LEGS + f""", silver AS (
  SELECT * EXCLUDE (user_id),
         CASE WHEN "CallerNr" <> 'anonym' THEN 'CUSTID_' || user_id END AS "CustomerKey",
         CASE WHEN "CallerNr" <> 'anonym' THEN 'Kund ' || user_id END AS "Name",
         {_SERVICE} AS "TjänstTyp"
  FROM call_legs
)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS "CustomerId", c_custkey // 10 AS "ParentId", c_name AS "Name",
         CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'HOUSEHOLD' THEN 'Okänt'
              WHEN 'MACHINERY' THEN '5560' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '-1 AB'
              ELSE '5566' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-1234' END
           AS "OrganisationNumber",
         ' 08' || c_custkey || ' ,,031' || c_custkey || ',0771' || c_nationkey AS "LandingNumber",
         c_mktsegment AS "BillingType"
  FROM customer
)"""

_ORG = "nullif(replace(regexp_extract({}, '^([0-9-]+)', 1), '-', ''), '')"

MAPPING = CUSTOMERS + f""", mapping AS (
  SELECT * FROM (
    SELECT trim(unnest(string_split(c."LandingNumber", ','))) AS "LandingNumber",
           coalesce({_ORG.format('c."OrganisationNumber"')},
                    {_ORG.format('p."OrganisationNumber"')},
                    'CUSTID_' || c."CustomerId") AS "CustomerKey",
           c."CustomerId", c."Name", c."ParentId", p."Name" AS "ParentName", c."BillingType"
    FROM customers c LEFT JOIN customers p ON c."ParentId" = p."CustomerId"
    WHERE c."CustomerId" NOT IN (5, 11)
  ) WHERE "LandingNumber" <> ''
), number_owner AS (
  SELECT * FROM mapping
  QUALIFY row_number() OVER (PARTITION BY "LandingNumber" ORDER BY "CustomerKey", "CustomerId") = 1
)"""

ENRICHED = CALL_LEGS + ", " + MAPPING + f""", enriched AS (
  SELECT c."LandingNumber", c."CallId", c."CaseId", c."Created", c."Status", c."Duration",
         c."TalkTimeInSec", c."ChannelType", c."CallerNr", c."QueueId",
         coalesce(m."CustomerKey", 'Okänd') AS "CustomerKey", m."CustomerId",
         coalesce(m."Name", 'Okänd Kund') AS "Name", m."ParentId", m."ParentName", m."BillingType",
         CASE WHEN m."ParentId" <> 0 THEN 1 ELSE 0 END AS "är_dotterbolag",
         {_SERVICE} AS "TjänstTyp"
  FROM (SELECT * REPLACE (trim("LandingNumber") AS "LandingNumber") FROM call_legs) c
  LEFT JOIN number_owner m ON c."LandingNumber" = m."LandingNumber"
  WHERE coalesce(c."LandingNumber", '-') <> ''
    AND NOT EXISTS (SELECT 1 FROM supplier
                    WHERE s_acctbal < 0 AND '031' || s_suppkey = c."LandingNumber")
)"""


def _redial(source: str) -> str:
    """Redial flag over a table of calls, by the previous call of the same digits."""
    return f"""SELECT *, CASE
      WHEN length(digits) >= 7 AND lower(prev_status) = 'callabandoned'
       AND "QueueId" = prev_queue AND "Created" > prev_created
       AND "Created" <= prev_created + INTERVAL 3600 SECOND THEN 1 ELSE 0 END AS is_redial
    FROM (SELECT *, lag("Created") OVER w AS prev_created, lag("Status") OVER w AS prev_status,
                 lag("QueueId") OVER w AS prev_queue
          FROM (SELECT *, regexp_replace("CallerNr", '[^0-9]', '', 'g') AS digits FROM {source})
          WINDOW w AS (PARTITION BY digits ORDER BY "Created", "CallId"))"""


# ---- customer behaviour ---------------------------------------------------------------------

PROFILES = SILVER_CALLS + """, votes AS (
  SELECT "CustomerKey", "TjänstTyp",
         row_number() OVER (PARTITION BY "CustomerKey" ORDER BY count(*) DESC, "TjänstTyp") AS r
  FROM silver WHERE "CustomerKey" IS NOT NULL GROUP BY 1, 2
), profiles AS (
  SELECT s."CustomerKey", min(s."Name") AS "Name", min(v."TjänstTyp") AS "TjänstTyp",
         count(s."CallId") AS "Total_Samtal",
         CAST(sum(s."TalkTimeInSec") AS BIGINT) AS "Total_Samtalstid_Sek",
         CAST(trunc(sum(s."TalkTimeInSec") / count(s."CallId")) AS BIGINT)
           AS "Genomsnittlig_AHT_Sek"
  FROM silver s JOIN votes v ON v."CustomerKey" = s."CustomerKey" AND v.r = 1
  GROUP BY 1
)"""

SEGMENTS = PROFILES + """, segments AS (
  SELECT "CustomerKey", "Name", "TjänstTyp", "Total_Samtal", "Genomsnittlig_AHT_Sek",
    CASE WHEN upper("CustomerKey") = 'INTERNAL_SICK' OR lower("Name") LIKE '%sjukanmälan%'
           OR lower("TjänstTyp") LIKE '%personal%' OR lower("TjänstTyp") LIKE '%sjuk%'
         THEN 'Segment_Sjukanmälan'
         ELSE CASE WHEN "Total_Samtal" > (SELECT quantile_cont("Total_Samtal", 0.8) FROM profiles)
                   THEN 'Hög-Volym' ELSE 'Låg-Volym' END || '_' ||
              CASE WHEN "Genomsnittlig_AHT_Sek" >
                        (SELECT quantile_cont("Genomsnittlig_AHT_Sek", 0.5) FROM profiles)
                   THEN 'Långa-Ärenden' ELSE 'Korta-Ärenden' END
    END AS "Behavior_Segment"
  FROM profiles
)"""

CLASSED = SILVER_CALLS + """, limits0 AS (
  SELECT quantile_cont("TalkTimeInSec", 0.33) AS lo, quantile_cont("TalkTimeInSec", 0.66) AS hi
  FROM silver WHERE "TalkTimeInSec" > 0
), limits1 AS (SELECT CASE WHEN lo = 0 THEN 1 ELSE lo END AS lo, hi FROM limits0
), limits AS (SELECT lo, CASE WHEN hi <= lo THEN lo + 60 ELSE hi END AS hi FROM limits1
), classed AS (
  SELECT s.*, CASE WHEN "TalkTimeInSec" < lo THEN 'Kort' WHEN "TalkTimeInSec" > hi THEN 'Långt'
                   ELSE 'Normal' END AS "Samtalstyp"
  FROM silver s, limits WHERE "TalkTimeInSec" > 0
)"""

# ---- calendar -------------------------------------------------------------------------------

_WEEKDAY = "['Mån','Tis','Ons','Tor','Fre','Lör','Sön'][isodow({0})]"
_MONTH = ("['Jan','Feb','Mar','Apr','Maj','Jun','Jul','Aug','Sep','Okt','Nov','Dec']"
          "[month({0})]")


def _holidays(years: str) -> str:
    """Swedish holidays of the selected years, Easter by the Meeus/Jones/Butcher rule."""
    return f"""yrs AS ({years}
), e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs
), e2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM e1
), e3 AS (SELECT *, (19 * a + b - d - (b - f + 1) // 3 + 15) % 30 AS h FROM e2
), e4 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e3
), e5 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e4
), easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31,
                                  (h + l - 7 * m + 114) % 31 + 1) AS d FROM e5
), days AS (SELECT y, CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31),
                                                  INTERVAL 1 DAY)) AS DATE) AS ds FROM yrs
), holidays AS (
  SELECT * FROM (
    SELECT days.ds, CASE
      WHEN strftime(days.ds, '%m%d') = '0101' THEN 'New Year''s Day'
      WHEN strftime(days.ds, '%m%d') = '0106' THEN 'Epiphany'
      WHEN strftime(days.ds, '%m%d') = '0501' THEN 'Labour Day'
      WHEN strftime(days.ds, '%m%d') = '0606' THEN 'National Day'
      WHEN strftime(days.ds, '%m%d') = '1225' THEN 'Christmas Day'
      WHEN strftime(days.ds, '%m%d') = '1226' THEN 'Second Day of Christmas'
      WHEN strftime(days.ds, '%m%d') = '1224' THEN 'Christmas Eve'
      WHEN strftime(days.ds, '%m%d') = '1231' THEN 'New Year''s Eve'
      WHEN days.ds - easter.d = -2 THEN 'Good Friday'
      WHEN days.ds - easter.d = 0 THEN 'Easter Sunday'
      WHEN days.ds - easter.d = 1 THEN 'Easter Monday'
      WHEN days.ds - easter.d = 39 THEN 'Ascension Day'
      WHEN days.ds - easter.d = 49 THEN 'Whit Sunday'
      WHEN isodow(days.ds) = 5 AND strftime(days.ds, '%m%d') BETWEEN '0619' AND '0625'
        THEN 'Midsummer Eve'
      WHEN isodow(days.ds) = 6 AND strftime(days.ds, '%m%d') BETWEEN '0620' AND '0626'
        THEN 'Midsummer Day'
      WHEN isodow(days.ds) = 6 AND strftime(days.ds, '%m%d') BETWEEN '1031' AND '1106'
        THEN 'All Saints'' Day' END AS holiday
    FROM days JOIN easter USING (y)
  ) WHERE holiday IS NOT NULL
)"""


def _calendar(ds: str, names: dict[str, str] | None = None) -> str:
    """Calendar columns as a select list, optionally under other names."""
    day, clock = f"CAST({ds} AS DATE)", f"(hour({ds}) + minute({ds}) / 60.0)"
    work = (f"isodow({ds}) < 6 AND {day} NOT IN (SELECT ds FROM holidays)")
    cols = {
        "timme": f"CAST(hour({ds}) AS INTEGER)",
        "minut": f"CAST(minute({ds}) AS INTEGER)",
        "veckodag": f"CAST(isodow({ds}) - 1 AS INTEGER)",
        "dag_pa_aret": f"CAST(dayofyear({ds}) AS INTEGER)",
        "vecka_nr": f"CAST(week({ds}) AS INTEGER)",
        "manad": f"CAST(month({ds}) AS INTEGER)",
        "kvartal": f"CAST(quarter({ds}) AS INTEGER)",
        "ar": f"CAST(year({ds}) AS INTEGER)",
        "datum": day,
        "veckodag_namn": _WEEKDAY.format(ds),
        "manad_namn": _MONTH.format(ds),
        "ar_arbetsdag": f"CAST({work} AS INTEGER)",
        "ar_dagen_efter_stangt": f"CAST((isodow({ds}) = 1 OR {day} - 1 IN "
                                 f"(SELECT ds FROM holidays)) AND {work} AS INTEGER)",
        "ar_tidig_morgon": f"CAST({clock} >= 6.5 AND {clock} < 8 AS INTEGER)",
        "ar_formiddag": f"CAST({clock} >= 8 AND {clock} < 11 AS INTEGER)",
        "ar_lunchtid": f"CAST({clock} >= 11 AND {clock} < 13 AS INTEGER)",
        "ar_eftermiddag": f"CAST({clock} >= 13 AND {clock} < 17.5 AS INTEGER)",
        "year_sin": f"round(sin(2 * pi() * dayofyear({ds}) / 365.25), 6)",
        "year_cos": f"round(cos(2 * pi() * dayofyear({ds}) / 365.25), 6)",
    }
    names = names or {}
    return ", ".join(f'{sql} AS "{names.get(c, c)}"' for c, sql in cols.items())


# Published, ASCII-folded names of the calendar columns in the hourly history.
_FOLDED = {
    "dag_pa_aret": "dag_p___ret", "manad": "m_nad", "ar": "_r", "manad_namn": "m_nad_namn",
    "ar_arbetsdag": "_r_arbetsdag", "ar_dagen_efter_stangt": "_r_dagen_efter_st_ngt",
    "ar_tidig_morgon": "_r_tidig_morgon", "ar_formiddag": "_r_f_rmiddag",
    "ar_lunchtid": "_r_lunchtid", "ar_eftermiddag": "_r_eftermiddag",
}


def _lags(column: str, partition: str, per_day: int) -> str:
    return ", ".join(
        f'lag("{column}", {k * per_day}) OVER (PARTITION BY {partition} ORDER BY ds) '
        f'AS "{column}_lag_{k}d"'
        for k in (1, 7, 14, 28, 364)
    )


# ---- hourly history and forecast ------------------------------------------------------------

HOURS = SEGMENTS + """, volumes AS (
  SELECT date_trunc('hour', s."Created") AS ds, s."TjänstTyp" AS "Tj_nstTyp",
         coalesce(g."Behavior_Segment", 'Okänt') AS "Behavior_Segment",
         count(*) AS "Antal_Samtal", CAST(sum(s."TalkTimeInSec") AS BIGINT) AS talk,
         CAST(sum(greatest(s."Duration" - s."TalkTimeInSec", 0)) AS BIGINT) AS wait,
         CAST(sum(CASE WHEN s."Status" = 'CallAbandoned' THEN 0 ELSE 1 END) AS BIGINT) AS answered
  FROM silver s LEFT JOIN segments g USING ("CustomerKey")
  WHERE s."ChannelType" = 'call' GROUP BY 1, 2, 3
), grid AS (
  SELECT unnest(generate_series((SELECT min(ds) FROM volumes), (SELECT max(ds) FROM volumes),
                                INTERVAL 1 HOUR)) AS ds, "Tj_nstTyp", "Behavior_Segment"
  FROM (SELECT DISTINCT "Tj_nstTyp", "Behavior_Segment" FROM volumes)
), hours AS (
  SELECT ds, "Tj_nstTyp", "Behavior_Segment",
         coalesce(v."Antal_Samtal", 0) AS "Antal_Samtal",
         coalesce(v.talk, 0) AS "Total_Samtalstid_Sek",
         coalesce(v.wait, 0) AS "Total_V_ntetid_Sek",
         coalesce(v.answered, 0) AS "Antal_Besvarade_Samtal"
  FROM grid LEFT JOIN volumes v USING (ds, "Tj_nstTyp", "Behavior_Segment")
)"""

# The years on both sides as well: the day before 1 January is in another year.
_HOUR_YEARS = "SELECT unnest(range(min(year(ds)) - 1, max(year(ds)) + 2)) AS y FROM hours"

DAYS = HOURS + """, daily AS (
  SELECT CAST(ds AS DATE) AS ds, "Tj_nstTyp", CAST(sum("Antal_Samtal") AS BIGINT) AS "Antal_Samtal"
  FROM hours GROUP BY 1, 2
), start AS (SELECT max(ds) + 1 AS d FROM daily
), stat AS (
  SELECT "Tj_nstTyp", isodow(ds) - 1 AS veckodag, avg("Antal_Samtal") AS "Stat_Avg"
  FROM daily, start WHERE ds >= d - 35 GROUP BY 1, 2
)"""


def _week(lag7: str) -> str:
    """Seven forecast days given the volume of the same weekday one week earlier."""
    return f"""SELECT f.ds, f."Tj_nstTyp",
        CAST(round_even(CASE WHEN coalesce(stat."Stat_Avg", 0) < l.v * 0.5 AND l.v > 10 THEN l.v
                             ELSE coalesce(stat."Stat_Avg", 0) END, 0) AS BIGINT) AS v
      FROM f LEFT JOIN stat ON stat."Tj_nstTyp" = f."Tj_nstTyp"
                           AND stat.veckodag = isodow(f.ds) - 1
             LEFT JOIN ({lag7}) l ON l."Tj_nstTyp" = f."Tj_nstTyp" AND l.ds = f.ds - 7"""


FORECAST = DAYS + f""", future AS (
  SELECT CAST(unnest(generate_series(d, d + 13, INTERVAL 1 DAY)) AS DATE) AS ds, d FROM start
), f0 AS (SELECT ds, d, "Tj_nstTyp" FROM future, (SELECT DISTINCT "Tj_nstTyp" FROM daily)
), week1 AS (WITH f AS (SELECT * FROM f0 WHERE ds < d + 7)
  {_week('SELECT ds, "Tj_nstTyp", "Antal_Samtal" AS v FROM daily')}
), week2 AS (WITH f AS (SELECT * FROM f0 WHERE ds >= d + 7)
  {_week('SELECT ds, "Tj_nstTyp", v FROM week1')}
), forecast AS (
  SELECT ds, "Tj_nstTyp", v AS "Prognos_Volym", CAST(trunc(v * 0.8::DOUBLE) AS BIGINT) AS "Prognos_Låg",
         CAST(trunc(v * 1.2::DOUBLE) AS BIGINT) AS "Prognos_Hög"
  FROM (SELECT * FROM week1 UNION ALL SELECT * FROM week2)
)"""

SHAPE = """shares AS (
  SELECT ds, "Tj_nstTyp",
         "Antal_Samtal" / sum("Antal_Samtal") OVER (PARTITION BY CAST(ds AS DATE), "Tj_nstTyp") AS s
  FROM hours WHERE "Antal_Samtal" > 0
), mean_share AS (
  SELECT CAST(isodow(ds) - 1 AS INTEGER) AS veckodag, CAST(hour(ds) AS INTEGER) AS timme,
         "Tj_nstTyp", avg(s) AS s
  FROM shares GROUP BY 1, 2, 3
), shape AS (
  SELECT veckodag, timme, "Tj_nstTyp",
         s / sum(s) OVER (PARTITION BY veckodag, "Tj_nstTyp") AS "Avg_Hourly_Proportion"
  FROM mean_share
)"""

SPREAD = FORECAST + ", " + SHAPE + """, expanded AS (
  SELECT f.ds AS datum, f.ds + INTERVAL 1 HOUR * h.h AS t, f."Tj_nstTyp", g."Behavior_Segment",
         f."Prognos_Volym" AS v, f."Prognos_Låg" AS lo, f."Prognos_Hög" AS hi,
         CASE WHEN isodow(f.ds) >= 6 OR h.h < 6 OR h.h >= 18 THEN 0
              ELSE coalesce(s."Avg_Hourly_Proportion", 0) END AS w
  FROM forecast f
  JOIN (SELECT DISTINCT "Tj_nstTyp", "Behavior_Segment" FROM hours) g USING ("Tj_nstTyp")
  CROSS JOIN (SELECT unnest(range(24)) AS h) h
  LEFT JOIN shape s ON s.veckodag = isodow(f.ds) - 1 AND s.timme = h.h
                   AND s."Tj_nstTyp" = f."Tj_nstTyp"
), normal AS (
  SELECT *, CASE WHEN sum(w) OVER g > 0 THEN w / sum(w) OVER g ELSE 0 END AS n
  FROM expanded WINDOW g AS (PARTITION BY datum, "Tj_nstTyp")
), parts AS (
  SELECT *, v * n AS pv, lo * n AS pl, hi * n AS ph FROM normal
), spread AS (
  SELECT t AS "DatumTid", "Tj_nstTyp" AS "TjänstTyp", "Behavior_Segment",
    CAST(round_even(round(CASE WHEN sum(pv) OVER g > 0 THEN pv * (v / sum(pv) OVER g) ELSE 0 END, 9), 0) AS BIGINT)
      AS "Prognos_Antal_Samtal",
    CAST(round_even(round(CASE WHEN sum(pl) OVER g > 0 THEN pl * (lo / sum(pl) OVER g) ELSE 0 END, 9), 0) AS BIGINT)
      AS "Prognos_Låg",
    CAST(round_even(round(CASE WHEN sum(ph) OVER g > 0 THEN ph * (hi / sum(ph) OVER g) ELSE 0 END, 9), 0) AS BIGINT)
      AS "Prognos_Hög",
    CAST(180 AS INTEGER) AS "Prognos_Snitt_Taltid_Sek", DATE '2024-02-01' AS "ForecastRunDate"
  FROM parts WINDOW g AS (PARTITION BY datum, "Tj_nstTyp")
)"""

# ---- evaluation -----------------------------------------------------------------------------

EVALUATION = """per_day AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1
), archive AS (
  SELECT d + 7 AS "Datum", n, DATE '2001-01-01' AS run FROM per_day
  UNION ALL SELECT d + 1, n, DATE '2001-02-01' FROM per_day
), latest AS (
  SELECT max(run) AS run FROM archive WHERE "Datum" BETWEEN DATE '1999-01-04' AND DATE '2001-06-30'
), compared AS (
  SELECT coalesce(a.d, f."Datum") AS "Datum", CAST(coalesce(a.n, 0) AS BIGINT) AS "Actual_Volym",
         CAST(coalesce(f.n, 0) AS BIGINT) AS "Forecast_Volym"
  FROM (SELECT * FROM per_day WHERE d BETWEEN DATE '1999-01-04' AND DATE '2001-06-30') a
  FULL JOIN (SELECT * FROM archive, latest WHERE archive.run = latest.run
               AND "Datum" BETWEEN DATE '1999-01-04' AND DATE '2001-06-30') f ON a.d = f."Datum"
), summary AS (
  SELECT CAST(sum("Actual_Volym") AS BIGINT) AS a, CAST(sum("Forecast_Volym") AS BIGINT) AS f,
         sum(abs("Actual_Volym" - "Forecast_Volym")) AS e FROM compared
)"""

_CASES = """cases AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "CaseId", o_orderstatus AS "Status",
         o_orderdate AS "Created",
         CASE WHEN o_orderstatus = 'P' THEN 'email' ELSE 'call' END AS "InternalType",
         o_custkey AS "UserId", substr(o_orderpriority, 1, 1) AS "GroupId"
  FROM orders
)"""


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["run_window"] = """WITH w AS (
      SELECT CAST(max(o_orderdate) AS DATE) + 1 AS today FROM orders
    ), b AS (SELECT today, CAST(date_trunc('month', today - INTERVAL 16 MONTH) AS DATE) AS start FROM w)
    SELECT count(*) AS calls, min(b.start) AS start, min(b.today) AS today
    FROM orders, b WHERE o_orderdate >= b.start AND o_orderdate < b.today"""

    sql["incremental_load"] = "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'"

    sql["incremental_load_ties"] = """SELECT * FROM orders
      WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1999-06-01'
                           OR (o_orderdate = DATE '1999-06-01' AND o_orderstatus = 'F'))
         OR (o_orderdate = DATE '1999-06-01' AND o_orderstatus <> 'F')"""

    sql["changed_rows_load"] = """
      WITH n AS (SELECT count(*) FILTER (event_id % 500 <> 3) AS load_1,
                        count(*) FILTER (event_id % 500 = 3 OR event_id % 1000 = 7 OR event_id % 1500 = 11) AS load_2
                 FROM events)
      SELECT event_id, CASE WHEN event_id % 1500 = 11 THEN ts + INTERVAL 2 DAY ELSE ts END AS ts, user_id, event_type,
             CASE WHEN event_id % 1000 = 7 THEN value + 1 ELSE value END AS value, props,
             load_1, load_2, CAST(0 AS BIGINT) AS load_3
      FROM events, n"""

    sql["bronze_load"] = """
      SELECT 1 AS run, 'events' AS target, 'INCREMENTAL' AS load_type, 'LOADED' AS status,
             (SELECT count(*) FROM events) AS written
      UNION ALL SELECT 1, 'orders', 'INCREMENTAL', 'LOADED', (SELECT count(*) FROM orders)
      UNION ALL SELECT 2, 'events', 'INCREMENTAL', 'EMPTY', 0
      UNION ALL SELECT 2, 'orders', 'INCREMENTAL', 'EMPTY', 0
      UNION ALL SELECT r, 'customer', 'FULL', 'LOADED', (SELECT count(*) FROM customer)
                FROM (VALUES (1), (2)) v(r)
      UNION ALL SELECT r, 'supplier', 'FULL', 'LOADED', (SELECT count(*) FROM supplier)
                FROM (VALUES (1), (2)) v(r)
      UNION ALL SELECT r, 'absent', 'FULL', 'FAILED', 0 FROM (VALUES (1), (2)) v(r)
      UNION ALL SELECT r, 'nothing', 'FULL', 'EMPTY', 0 FROM (VALUES (1), (2)) v(r)"""

    sql["exclusion_list"] = """
      SELECT DISTINCT '031' || CAST(s_nationkey % 10 AS VARCHAR) AS "LandingNumber" FROM supplier"""

    sql["forecast_archive"] = """SELECT run AS "ForecastRunDate",
        count(DISTINCT CAST(o_orderdate AS DATE)) AS days, count(*) AS volume
      FROM orders, (VALUES (DATE '2001-01-01'), (DATE '2001-02-01')) v(run) GROUP BY run"""

    sql["collapse_calls"] = """WITH legs AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS "CallId", l_returnflag AS "Status",
             l_shipdate AS "Created", CAST(l_linenumber AS VARCHAR) AS "LandingNumber",
             l_linestatus AS "ChannelType", CAST(l_suppkey AS VARCHAR) AS "QueueId",
             CAST(l_partkey AS VARCHAR) AS "CallerNr",
             CAST(round(l_extendedprice * 100) AS BIGINT) AS "TalkTimeInSec",
             CAST(l_quantity AS BIGINT) AS "Duration", CAST(NULL AS VARCHAR) AS "CaseId"
      FROM lineitem
    ), placed AS (
      SELECT *, row_number() OVER w AS r,
             last_value("Status") OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
               AS last_status
      FROM legs
      WINDOW w AS (PARTITION BY "CallId" ORDER BY "Created", "LandingNumber", "CallerNr",
                   "ChannelType", "QueueId", "Duration", "TalkTimeInSec", "Status")
    )
    SELECT "CallId", "Created", "LandingNumber", "CallerNr", "ChannelType", "QueueId", "CaseId",
           last_status AS "Status", "Duration", "TalkTimeInSec"
    FROM placed WHERE r = 1 AND "QueueId" NOT IN ('3', '17')"""

    sql["customer_mapping"] = f"WITH {MAPPING} SELECT * FROM mapping"
    sql["number_owner"] = f"WITH {MAPPING} SELECT * FROM number_owner"
    sql["enrich_calls"] = f"WITH {ENRICHED} SELECT * FROM enriched"

    sql["flag_redials"] = f"""WITH {CALL_LEGS}
      SELECT "CallId", "CallerNr", "Created", "QueueId", is_redial FROM ({_redial('call_legs')})"""

    sql["training_data"] = f"""WITH {ENRICHED}
      SELECT "CallId", "CaseId", "Created", "Status", "Duration", "TalkTimeInSec", "ChannelType",
             "LandingNumber", "CallerNr", "QueueId", "Name", "CustomerKey", "är_dotterbolag",
             "TjänstTyp", is_redial, CAST("Created" AS DATE) AS "Datum"
      FROM ({_redial('enriched')})"""

    sql["abandoned_report"] = f"""WITH {ENRICHED}
      SELECT "CallId", "CustomerKey", "Created", CAST("Created" AS DATE) AS "Datum",
             "LandingNumber", "Name", "QueueId", "Status", "TjänstTyp"
      FROM enriched WHERE lower("Status") = 'callabandoned'"""

    sql["call_measures"] = f"""WITH {CALL_LEGS}
      SELECT CAST("Created" AS DATE) AS "Datum", "ChannelType",
             CAST(count(*) FILTER ("Status" = 'CallAbandoned') AS BIGINT) AS abandoned,
             CAST(count(*) FILTER ("Status" <> 'CallAbandoned') AS BIGINT) AS answered,
             CAST(sum(greatest("Duration" - "TalkTimeInSec", 0)) AS BIGINT) AS wait,
             max(greatest("Duration" - "TalkTimeInSec", 0)) AS longest_wait
      FROM call_legs GROUP BY 1, 2"""

    sql["dim_customer"] = f"""WITH {ENRICHED}
      SELECT "CustomerId", "Name", "CustomerKey", "ParentId", "ParentName", "BillingType",
             "är_dotterbolag", "LandingNumber"
      FROM enriched
      QUALIFY row_number() OVER (PARTITION BY "CustomerKey" ORDER BY "Created", "CallId") = 1"""

    sql["dim_phone_lookup"] = f"""WITH {ENRICHED}
      SELECT DISTINCT "CustomerId", "LandingNumber", "CustomerKey" FROM enriched
      WHERE "LandingNumber" IS NOT NULL"""

    sql["explode_numbers"] = f"""WITH {CUSTOMERS}
      SELECT DISTINCT * FROM (
        SELECT "CustomerId", trim(unnest(string_split("LandingNumber", ','))) AS "LandingNumber",
               "BillingType" AS "CustomerKey" FROM customers)
      WHERE "LandingNumber" <> ''"""

    sql["dim_queue"] = """SELECT CAST(s_suppkey AS VARCHAR) AS "QueueId", s_name AS "QueueName"
      FROM supplier"""

    sql["anti_semi_filters"] = """SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_order
      FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
        AND o_custkey IN (SELECT c_custkey FROM customer
                          WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
      GROUP BY 1"""

    sql["row_filters"] = f"""WITH {CALL_LEGS}
      SELECT "CallId", "QueueId", "TalkTimeInSec" FROM call_legs
      WHERE CASE WHEN "ChannelType" = 'call' THEN "QueueId" END NOT IN ('3')
        AND CAST("Created" AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'
        AND "TalkTimeInSec" > 0"""

    sql["keyword_category"] = """SELECT CASE
          WHEN lower(p_name) LIKE 'small%' THEN 'Liten'
          WHEN lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%blue%'
            OR lower(p_name) LIKE '%green%' THEN 'Färgad'
          WHEN lower(p_name) LIKE '%bolt%' OR lower(p_name) LIKE '%gear%' THEN 'Metall'
          ELSE 'Övrigt' END AS kategori,
        count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size
      FROM part GROUP BY 1"""

    sql["subsidiary_flag"] = """SELECT c_custkey AS "CustomerId",
        CASE WHEN c_mktsegment <> 'BUILDING' AND c_custkey // 10 <> 0 THEN 1 ELSE 0 END AS subsidiary
      FROM customer"""

    sql["string_cleaning"] = """SELECT c_custkey, c_name AS trimmed,
        regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
        CAST(length(regexp_replace(c_name, '[^0-9]', '', 'g')) AS INTEGER) AS n_digits,
        regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g') AS alnum,
        '55' || c_custkey || '7' AS org, CAST(NULL AS VARCHAR) AS no_org,
        c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AS has_word,
        upper(c_mktsegment) || '_' || c_custkey AS label
      FROM customer"""

    sql["number_rounding"] = """SELECT
        CAST(round_even(l_quantity * 0.5, 0) AS BIGINT) AS half_even,
        CAST(trunc(l_quantity * 0.8::DOUBLE) AS BIGINT) AS low,
        CAST(trunc(l_quantity * 1.2::DOUBLE) AS BIGINT) AS high,
        greatest(CAST(l_quantity AS BIGINT) - 20, 0) AS clipped,
        round(CASE WHEN l_tax > 0 THEN l_discount / l_tax ELSE 0 END, 6) AS ratio,
        count(*) AS n
      FROM lineitem GROUP BY ALL"""

    sql["wall_time"] = "SELECT event_id, ts AS written, ts FROM events"

    sql["column_projection"] = f"""WITH {CUSTOMERS}
      SELECT "CustomerId", "Name" AS "Kundens_namn", "BillingType" AS "_r_typ",
             coalesce("OrganisationNumber", 'Oklart') AS "OrganisationNumber"
      FROM customers"""

    sql["customer_profiles"] = f"WITH {PROFILES} SELECT * FROM profiles"
    sql["customer_segments"] = f"WITH {SEGMENTS} SELECT * FROM segments"
    sql["segment_histogram"] = f"""WITH {SEGMENTS}
      SELECT "Behavior_Segment", count(*) AS "Antal" FROM segments GROUP BY 1"""

    sql["peak_pattern"] = f"""WITH {PROFILES}, busy AS (
        SELECT "CustomerKey", isodow("Created") AS wd, hour("Created") AS h, count(*) AS n
        FROM silver WHERE "CustomerKey" IS NOT NULL GROUP BY 1, 2, 3
      ), top AS (
        SELECT * FROM busy
        QUALIFY row_number() OVER (PARTITION BY "CustomerKey" ORDER BY n DESC, wd, h) = 1)
      SELECT p."CustomerKey", p."Total_Samtal",
             ['Mån','Tis','Ons','Tor','Fre','Lör','Sön'][wd] || '-' || h AS "Peak_Pattern"
      FROM profiles p LEFT JOIN top USING ("CustomerKey")"""

    sql["exact_quantiles"] = """SELECT
        round(quantile_cont(o_totalprice, 0.33), 4) AS p33,
        round(quantile_cont(o_totalprice, 0.50), 4) AS p50,
        round(quantile_cont(o_totalprice, 0.66), 4) AS p66,
        round(quantile_cont(o_totalprice, 0.80), 4) AS p80,
        round(quantile_cont(o_custkey, 0.10), 4) AS key_p10
      FROM orders"""

    sql["call_length_class"] = f"""WITH {CLASSED}
      SELECT "Samtalstyp", count(*) AS n, min("TalkTimeInSec") AS shortest,
             max("TalkTimeInSec") AS longest
      FROM classed GROUP BY 1"""

    sql["monthly_peaks"] = f"""WITH {CLASSED}, counted AS (
        SELECT "CustomerKey", "Name", {_MONTH.format('"Created"')} AS "månad_namn",
               CAST(month("Created") AS INTEGER) AS "månad",
               {_WEEKDAY.format('"Created"')} AS "veckodag_namn",
               CAST(isodow("Created") - 1 AS INTEGER) AS "veckodag",
               CAST(hour("Created") AS INTEGER) AS "timme", "Samtalstyp",
               count(*) AS "Antal_Samtal_Denna_Timme"
        FROM classed WHERE "CustomerKey" IS NOT NULL AND "Name" IS NOT NULL GROUP BY ALL)
      SELECT * FROM (
        SELECT *, round("Antal_Samtal_Denna_Timme" / sum("Antal_Samtal_Denna_Timme") OVER g, 6)
                    AS "Procent_Av_Manad_Typ",
               CAST(row_number() OVER (g ORDER BY "Antal_Samtal_Denna_Timme" DESC, "Name",
                                       "veckodag_namn", "timme") AS INTEGER) AS "Peak_Rank"
        FROM counted WINDOW g AS (PARTITION BY "CustomerKey", "månad_namn", "Samtalstyp"))
      WHERE "Peak_Rank" <= 3"""

    order_years = ("SELECT unnest(range(min(year(o_orderdate)) - 1, max(year(o_orderdate)) + 1)) "
                   "AS y FROM orders")
    sql["calendar_features"] = f"""WITH {_holidays(order_years)}, d AS (
        SELECT o_orderdate AS ds, count(*) AS n FROM orders GROUP BY 1)
      SELECT ds, n, {_calendar('ds')} FROM d"""

    sql["day_parts"] = """SELECT CAST(hour(ts) AS INTEGER) AS timme,
        ['Mån','Tis','Ons','Tor','Fre','Lör','Sön'][isodow(ts)] AS veckodag_namn,
        CAST(CAST(ts AS TIME) >= TIME '06:30' AND CAST(ts AS TIME) < TIME '08:00' AS INTEGER)
          AS ar_tidig_morgon,
        CAST(hour(ts) BETWEEN 8 AND 10 AS INTEGER) AS ar_formiddag,
        CAST(hour(ts) BETWEEN 11 AND 12 AS INTEGER) AS ar_lunchtid,
        CAST(CAST(ts AS TIME) >= TIME '13:00' AND CAST(ts AS TIME) < TIME '17:30' AS INTEGER)
          AS ar_eftermiddag,
        count(*) AS n, CAST(sum(minute(ts)) AS BIGINT) AS minutes
      FROM events GROUP BY ALL"""

    sql["holiday_orders"] = f"""WITH {_holidays('SELECT DISTINCT year(o_orderdate) AS y FROM orders')}
      SELECT h.ds, h.holiday, h.holiday LIKE '% Eve' AS is_eve, count(o.o_orderkey) AS n
      FROM holidays h LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = h.ds
      GROUP BY 1, 2, 3"""

    sql["daily_lags"] = f"""WITH d AS (
        SELECT CAST(o_orderdate AS DATE) AS ds, o_orderpriority AS priority, count(*) AS n
        FROM orders GROUP BY 1, 2
      ), grid AS (
        SELECT CAST(unnest(generate_series((SELECT min(ds) FROM d), (SELECT max(ds) FROM d),
                                           INTERVAL 1 DAY)) AS DATE) AS ds, priority
        FROM (SELECT DISTINCT priority FROM d)
      ), filled AS (
        SELECT ds, priority, coalesce(d.n, 0) AS n FROM grid LEFT JOIN d USING (ds, priority))
      SELECT ds, priority, n, {_lags('n', 'priority', 1)} FROM filled"""

    sql["hourly_history"] = f"""WITH {HOURS}, {_holidays(_HOUR_YEARS)}
      SELECT *, {_lags('Antal_Samtal', '"Tj_nstTyp", "Behavior_Segment"', 24)},
             {_calendar('ds', _FOLDED)}
      FROM hours"""

    sql["volume_training_set"] = f"""WITH {DAYS}, {_holidays(_HOUR_YEARS)}, lagged AS (
        SELECT *, {_lags('Antal_Samtal', '"Tj_nstTyp"', 1)} FROM daily)
      SELECT *, {_calendar('ds::TIMESTAMP')} FROM lagged WHERE "Antal_Samtal_lag_1d" IS NOT NULL"""

    trained = f"SELECT * FROM ({sql['volume_training_set']})"
    log = 'round(ln(1 + coalesce("Antal_Samtal_lag_{0}d", "Antal_Samtal_lag_7d", "Antal_Samtal_lag_1d", 0)), 6) AS "Antal_Samtal_lag_{0}d_x"'
    logs = ", ".join(log.format(k) for k in (1, 7, 14, 28, 364))
    sql["model_inputs"] = f"""SELECT ds, "Tj_nstTyp", {logs},
        CAST(veckodag = 1 AS DOUBLE) AS weekday_1_x, CAST(veckodag = 6 AS DOUBLE) AS weekday_6_x,
        CAST(manad = 2 AS DOUBLE) AS month_2_x, CAST(manad = 12 AS DOUBLE) AS month_12_x
      FROM ({trained})"""
    sql["saved_model"] = f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM ({trained})"
    sql["volume_model_check"] = f"""
      SELECT count(*) AS rows, true AS balanced, true AS better FROM ({trained})"""
    sql["boosted_volume_check"] = f"""
      SELECT count(*) AS rows, true AS positive, true AS better FROM ({trained})"""
    sql["volume_band_residuals"] = f"""SELECT "Tj_nstTyp",
        round(quantile_cont(CAST("Antal_Samtal" - "Antal_Samtal_lag_7d" AS DOUBLE), 0.1), 6) AS residual_low,
        round(quantile_cont(CAST("Antal_Samtal" - "Antal_Samtal_lag_7d" AS DOUBLE), 0.9), 6) AS residual_high
      FROM ({trained}) WHERE "Antal_Samtal_lag_7d" IS NOT NULL GROUP BY 1"""
    sql["kmeans_check"] = f"""WITH {PROFILES}
      SELECT count(*) AS customers, CAST(4 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS astray,
             CAST(0 AS BIGINT) AS off_centre FROM profiles"""

    sql["volume_band_check"] = """
      WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ds FROM lineitem WHERE l_shipdate IS NOT NULL),
      ends AS (SELECT min(ds) AS first, max(ds) AS last FROM days)
      SELECT count(*) FILTER (ds > first) AS rows, count(*) FILTER (ds > last - 182) AS unseen, true AS covered
      FROM days, ends"""
    sql["aht_training_set"] = f"""WITH {HOURS}, {_holidays(_HOUR_YEARS)}, summed AS (
        SELECT CAST(ds AS DATE) AS ds, "Behavior_Segment",
               CAST(sum("Antal_Samtal") AS BIGINT) AS "Antal_Samtal",
               CAST(sum("Total_Samtalstid_Sek") AS BIGINT) AS "Total_Samtalstid_Sek",
               CAST(sum("Total_V_ntetid_Sek") AS BIGINT) AS "Total_V_ntetid_Sek",
               CAST(sum("Antal_Besvarade_Samtal") AS BIGINT) AS "Antal_Besvarade_Samtal"
        FROM hours GROUP BY 1, 2 HAVING sum("Antal_Samtal") > 0)
      SELECT *, round(CASE WHEN "Antal_Besvarade_Samtal" > 0
                           THEN "Total_Samtalstid_Sek" / "Antal_Besvarade_Samtal" ELSE 0 END, 6)
                  AS "Snitt_Taltid",
             round("Total_V_ntetid_Sek" / "Antal_Samtal", 6) AS "Snitt_Vantetid",
             {_calendar('ds::TIMESTAMP')}
      FROM summed"""

    sql["handling_check"] = f"""
      SELECT count(*) AS rows, true AS talk_better, true AS wait_better FROM ({sql['aht_training_set']})"""
    sql["model_forecast_check"] = f"""WITH {DAYS}, services AS (
        SELECT count(DISTINCT "Tj_nstTyp") AS n FROM daily, start WHERE ds >= d - 370)
      SELECT unnest(['linear', 'boosted']) AS learner, n AS services, CAST(14 AS BIGINT) AS days, n * 14 AS rows,
             CAST(0 AS BIGINT) AS wrong FROM services"""

    sql["weekday_average"] = f"""WITH {DAYS}
      SELECT "Tj_nstTyp", CAST(veckodag AS INTEGER) AS veckodag, round("Stat_Avg", 6) AS "Stat_Avg"
      FROM stat"""
    orders = """orders_of AS (
      SELECT CAST(o_orderdate AS DATE) AS ds, o_orderpriority AS s, count(*) AS n FROM orders GROUP BY 1, 2
    ), top AS (SELECT max(ds) + 1 AS start FROM orders_of)"""
    sql["weekday_average_orders"] = f"""WITH {orders}
      SELECT s AS "Tj_nstTyp", CAST(isodow(ds) - 1 AS INTEGER) AS veckodag, round(avg(n), 6) AS "Stat_Avg"
      FROM orders_of, top WHERE ds >= start - 35 GROUP BY 1, 2"""
    sql["recursive_forecast"] = f"WITH {FORECAST} SELECT * FROM forecast"
    sql["history_and_forecast"] = f"""WITH {FORECAST}
      SELECT ds, "Tj_nstTyp", "Antal_Samtal", CAST(NULL AS BIGINT) AS "Prognos_Låg",
             CAST(NULL AS BIGINT) AS "Prognos_Hög" FROM daily
      UNION ALL
      SELECT ds, "Tj_nstTyp", "Prognos_Volym", "Prognos_Låg", "Prognos_Hög" FROM forecast"""
    sql["hourly_shape"] = f"""WITH {HOURS}, {SHAPE}
      SELECT veckodag, timme, "Tj_nstTyp",
             round("Avg_Hourly_Proportion", 6) AS "Avg_Hourly_Proportion" FROM shape"""
    sql["allocate_hours"] = f"WITH {SPREAD} SELECT * FROM spread"
    def whole(part: str, total: str, name: str) -> str:
        x = f"round(CASE WHEN sum({part}) OVER g > 0 THEN {part} * ({total} / sum({part}) OVER g) ELSE 0 END, 9)"
        return f"{x} AS {name}"

    def raised(x: str, name: str) -> str:
        return f"""CAST(floor({x}) + CASE WHEN row_number() OVER (
            PARTITION BY datum, s ORDER BY round({x} - floor({x}), 9) DESC, t, "Behavior_Segment")
          <= round(sum({x}) OVER g, 0) - sum(floor({x})) OVER g THEN 1 ELSE 0 END AS BIGINT) AS "{name}\""""

    sql["allocate_whole"] = f"""WITH {SPREAD}, fine AS (
        SELECT datum, t, "Tj_nstTyp" AS s, "Behavior_Segment", {whole('pv', 'v', 'xv')}, {whole('pl', 'lo', 'xl')}, {whole('ph', 'hi', 'xh')}
        FROM parts WINDOW g AS (PARTITION BY datum, "Tj_nstTyp"))
      SELECT t AS "DatumTid", s AS "TjänstTyp", "Behavior_Segment", {raised('xv', 'Prognos_Antal_Samtal')},
             {raised('xl', 'Prognos_Låg')}, {raised('xh', 'Prognos_Hög')},
             CAST(180 AS INTEGER) AS "Prognos_Snitt_Taltid_Sek", DATE '2024-02-01' AS "ForecastRunDate"
      FROM fine WINDOW g AS (PARTITION BY datum, s)"""
    sql["spread_checksum"] = f"""WITH {SPREAD}
      SELECT CAST((SELECT sum("Prognos_Volym") FROM forecast) AS BIGINT) AS "Mal_Volym",
             CAST(sum("Prognos_Antal_Samtal") AS BIGINT) AS "Slut_Volym" FROM spread"""

    sql["latest_run"] = f'WITH {EVALUATION} SELECT run AS "ForecastRunDate" FROM latest'
    sql["evaluation_days"] = f"""WITH {EVALUATION}
      SELECT *, abs("Actual_Volym" - "Forecast_Volym") AS "AbsError" FROM compared"""
    sql["evaluate_forecast"] = f"""WITH {EVALUATION}
      SELECT a AS "Actual_Total", f AS "Forecast_Total", f - a AS "Diff",
             round((f - a) / a, 6) AS "Diff_Ratio", round(e / a * 100, 6) AS "wMAPE",
             round(100 - e / a * 100, 6) AS "Accuracy" FROM summary"""
    sql["trend_series"] = f"WITH {EVALUATION} SELECT * FROM compared"
    sql["total_series"] = f"""WITH {EVALUATION}
      SELECT 'Actuals' AS "Serie", a AS "Volym", CAST(NULL AS DOUBLE) AS "Diff_Ratio" FROM summary
      UNION ALL SELECT 'Forecast', f, round((f - a) / a, 6) FROM summary"""

    sql["fact_cases"] = f"""WITH {_CASES}
      SELECT c."CaseId", c."Status", c."Created", c."InternalType", c."UserId",
             u.c_name AS "AgentName", c."GroupId" AS "QueueId"
      FROM cases c LEFT JOIN customer u ON u.c_custkey = c."UserId"
      WHERE c."InternalType" = 'call' AND c."GroupId" NOT IN ('3', '17')"""

    return sql
