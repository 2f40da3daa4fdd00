"""Text cleaning and matching on the given tables.

Where the tables hold no dirty values, noise is written around a known value, and the SQL side states
that known value.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import arrays, dates, text
from docketry.plans.registry import query
from docketry.sources.files import table

# Place names and words looked for in texts.
NAMES = [
    "Germany", "France", "Spain", "Kenya", "Nigeria", "Pakistan", "India", "China", "Brazil", "Turkey",
    "Taco", "Hant", "Verst", "Eation", "Ouque", "Rado", "Envi", "Apache", "Esar", "Beren",
]
_IN_NAMES = ", ".join(f"'{n.lower()}'" for n in NAMES)
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_MARKS = "'" + string.punctuation.replace("'", "''") + "'"


def variant(key: Column, *options: Column) -> Column:
    """One of several forms, by key."""
    return F.element_at(F.array(*options), (key % len(options) + 1).cast("int"))


@query(
    "clean_email",
    """SELECT c_custkey, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' AS email FROM customer""",
)
def clean_email(spark: SparkSession, sf: str) -> DataFrame:
    plain = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    dirty = variant(
        F.col("c_custkey"),
        plain,
        F.concat(F.lit(" ."), plain, F.lit(", ")),
        F.concat(F.lit("("), plain, F.lit(")")),
        F.replace(plain, F.lit("@"), F.lit(" @ \t")),
        F.concat(F.lit(".,:*;?"), plain, F.lit("?;*:).")),
    )
    return table(spark, sf, "customer").select("c_custkey", text.clean_email(dirty).alias("email"))


@query(
    "clean_phone",
    """WITH t AS (SELECT c_custkey, '7' || lpad(CAST(c_custkey AS VARCHAR), 9, '3') AS n FROM customer)
       SELECT c_custkey,
              CASE c_custkey % 5 WHEN 0 THEN '+44' || n WHEN 1 THEN '+44' || n WHEN 2 THEN '0' || n WHEN 3 THEN '+44' || n
                                 ELSE '020' || n END AS phone,
              CASE c_custkey % 5 WHEN 2 THEN '0' || n WHEN 4 THEN NULL ELSE '+44' || n END AS mobile
       FROM t""",
)
def clean_phone(spark: SparkSession, sf: str) -> DataFrame:
    n = F.concat(F.lit("7"), F.lpad(F.col("c_custkey").cast("string"), 9, "3"))
    dirty = variant(
        F.col("c_custkey"),
        F.concat(F.lit("0044 (0)"), n, F.lit(".")),
        F.concat(F.lit("44 "), n, F.lit(";")),
        F.concat(F.lit("(0"), F.regexp_replace(n, "^(.{4})", "$1-")),
        F.concat(F.lit(" +44(0)"), n),
        F.concat(F.lit("020 "), n),
    )
    return table(spark, sf, "customer").select(
        "c_custkey", text.clean_phone(dirty).alias("phone"), text.mobile_only(dirty).alias("mobile")
    )


@query(
    "normalise_reference",
    """WITH t AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS n FROM orders)
       SELECT o_orderkey, CASE o_orderkey % 8 WHEN 1 THEN 'GWF' || n WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE n END AS reference
       FROM t""",
)
def normalise_reference(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    n = key.cast("string")
    dirty = variant(
        key,
        n,
        F.concat(F.lit(" GWF"), n),
        F.concat(F.lit("CROYDON/00"), n),
        F.lit("XXXXXX"),
        F.lit(" null "),
        F.concat(F.lit("SHEFFIELD OFFICE/"), F.lpad(n, 7, "0")),
        F.concat(F.lit("UKVS PRIORITY DESK/"), F.lpad(n, 7, "0")),
        F.concat(n, F.lit(": number of this record")),
    )
    return table(spark, sf, "orders").select("o_orderkey", text.normalise_reference(dirty).alias("reference"))


@query(
    "full_address",
    """SELECT c_custkey, concat_ws(', ', c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END, n_name) AS address,
              c_name || ', ' || CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'None' END || ', ' || n_name AS address_shown
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def full_address(spark: SparkSession, sf: str) -> DataFrame:
    lines = [F.col("c_name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.col("n_name")]
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        "c_custkey",
        text.full_address(*lines).alias("address"),
        text.full_address(*lines, null_text="None").alias("address_shown"),
    )


def _postcode(key: Column) -> Column:
    digit = (key % 9).cast("string")
    return variant(
        key,
        F.concat(F.lit("M"), digit, F.lit(" "), digit, F.lit("AB")),
        F.concat(F.lit("ls1"), digit, digit, F.lit("xy")),
        F.concat(F.lit("B"), digit, F.lit(" OAB")),
        F.lit("NOT A CODE"),
        F.lit(None).cast("string"),
        F.lit(" EC1A 1BB "),
        F.concat(F.lit("1234"), digit),
        F.concat(F.lit("W1 1I"), F.lit("0")),
    )


@query(
    "postcode_valid",
    "SELECT c_custkey, c_custkey % 8 NOT IN (3, 4, 6) AS valid FROM customer",
)
def postcode_valid(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", text.postcode_valid(_postcode(F.col("c_custkey"))).alias("valid"))


@query(
    "country_from_text",
    f"""WITH t AS (SELECT doc_id, lower(text) AS low FROM documents),
             f AS (SELECT doc_id, coalesce(
                 trim([w FOR w IN string_split(low, ' ') IF trim(w, {_BLANKS}) IN ({_IN_NAMES})][-1], {_BLANKS}),
                 [w FOR w IN [trim(translate(v, {_MARKS}, ''), {_BLANKS}) FOR v IN string_split(low, ' ')] IF w IN ({_IN_NAMES})][-1],
                 [w FOR w IN [trim(translate(v, {_MARKS}, ''), {_BLANKS}) FOR v IN regexp_split_to_array(low, '[,.\\s]+')]
                    IF w IN ({_IN_NAMES})][1], '') AS found FROM t)
        SELECT doc_id, upper(substr(found, 1, 1)) || substr(found, 2) AS country FROM f""",
)
def country_from_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.name_in_text(F.col("text"), NAMES).alias("country"))


@query(
    "contains_any",
    f"""SELECT doc_id, CASE """
    + " ".join(f"WHEN contains(clean, '{n.lower()}') THEN '{n}'" for n in NAMES)
    + f""" ELSE '' END AS name FROM (SELECT doc_id, translate(lower(text), {_MARKS}, '') AS clean FROM documents)""",
)
def contains_any(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.first_contained(F.col("text"), NAMES).alias("name"))


@query(
    "resolve_country",
    """SELECT c_custkey,
              CASE WHEN c_custkey % 3 = 0 THEN n_name
                   WHEN c_custkey % 3 = 2 THEN 'NO MAPPING REQUIRED'
                   WHEN c_custkey % 8 NOT IN (3, 4, 6) THEN 'GB'
                   WHEN c_mktsegment = 'BUILDING' THEN 'GB'
                   WHEN c_mktsegment = 'MACHINERY' THEN 'Kenya' ELSE '' END AS country,
              (c_custkey % 3 = 2 AND c_custkey % 2 = 0) OR c_custkey % 8 NOT IN (3, 4, 6) OR c_mktsegment = 'BUILDING' AS in_country
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def resolve_country(spark: SparkSession, sf: str) -> DataFrame:
    """Looked-up country, else home by postcode or address line, else a name in the address."""
    key = F.col("c_custkey")
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    looked_up = F.when(key % 3 == 0, F.col("n_name"))
    country_id = F.when(key % 3 == 1, 0).when(key % 3 == 2, F.when(key % 2 == 0, 188).otherwise(7))
    place = F.when(F.col("c_mktsegment") == "BUILDING", "United Kingdom").when(F.col("c_mktsegment") == "MACHINERY", "Nairobi, Kenya.")
    lines = [F.col("c_name"), place]
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        "c_custkey",
        text.resolve_country(country_id, looked_up, _postcode(key), lines, NAMES).alias("country"),
        text.in_country(country_id, 188, _postcode(key), lines, looked_up).alias("in_country"),
    )


# Postcode areas and the office that serves them.
AREAS = {"B": "Birmingham", "BA": "Newport", "BB": "Manchester", "M": "Manchester", "ME": "Taylor House", "L": "Manchester", "LS": "Bradford"}


@query(
    "area_lookup",
    """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Newport' WHEN 1 THEN 'Birmingham' WHEN 2 THEN 'Bradford' WHEN 3 THEN 'Manchester'
                              ELSE 'Newport' END AS centre FROM customer""",
)
def area_lookup(spark: SparkSession, sf: str) -> DataFrame:
    code = variant(
        F.col("c_custkey"), F.lit("BA1 1AA"), F.lit("b1 1AA"), F.lit("LS1 4AP"), F.lit("M1 1AA"), F.lit("ZZ1 1AA"),
        F.lit(None).cast("string"),
    )
    return table(spark, sf, "customer").select("c_custkey", text.area_lookup(code, AREAS, F.lit("Newport")).alias("centre"))


@query(
    "squeeze_text",
    r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents",
)
def squeeze_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.squeeze(F.col("text")).alias("text"))


@query("pad_code", "SELECT o_orderkey, CASE WHEN o_orderkey < 1000 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS code FROM orders")
def pad_code(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text.pad_code(F.col("o_orderkey").cast("string"), 4).alias("code"))


@query(
    "duration_forms",
    """WITH t AS (SELECT p_partkey, p_size * 7 - 7 AS m FROM part)
       SELECT p_partkey, (m // 60) || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS clock,
              CAST(m // 60 AS VARCHAR) AS hours, CAST(m % 60 AS VARCHAR) AS minutes,
              CAST(CASE WHEN m = 0 THEN 0 WHEN m % 60 >= 45 THEN m // 60 + 1 ELSE m // 60 END AS BIGINT) AS half_hours,
              CAST(CASE WHEN m = 0 THEN 30 WHEN m % 60 = 0 THEN 0 WHEN m % 60 < 45 THEN 30 ELSE 0 END AS BIGINT) AS half_minutes
       FROM t""",
)
def duration_forms(spark: SparkSession, sf: str) -> DataFrame:
    minutes = F.col("p_size") * 7 - 7
    parts = table(spark, sf, "part").select(
        "p_partkey",
        dates.hours_minutes(minutes).alias("clock"),
        dates.duration_map(minutes).alias("d"),
        dates.half_hours(minutes).alias("h"),
    )
    return parts.select(
        "p_partkey", "clock", F.col("d")["hours"].alias("hours"), F.col("d")["minutes"].alias("minutes"),
        F.col("h.hours").alias("half_hours"), F.col("h.minutes").alias("half_minutes"),
    )


@query(
    "is_minor",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2015-06-01') / 365.25 < 18 AS minor FROM orders""",
)
def is_minor(spark: SparkSession, sf: str) -> DataFrame:
    at = F.lit("2015-06-01").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", dates.is_minor(F.to_date("o_orderdate"), at).alias("minor"))


@query(
    "deadline",
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'O' THEN 14 ELSE 28 END, '%Y-%m-%d') AS deadline
       FROM orders""",
)
def deadline(spark: SparkSession, sf: str) -> DataFrame:
    due = dates.deadline(F.col("o_orderdate"), F.col("o_orderstatus") == "O")
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(due, "yyyy-MM-dd").alias("deadline"))


_SEATS_SQL = """string_split(repeat('Upper Trib Judge,', CAST(p_size % 3 AS INT)) || repeat('Des Judge First Tier,', CAST(p_size % 2 AS INT))
                || repeat('Judge First Tier,', CAST(p_partkey % 3 AS INT)) || repeat('Non-Legal Member,', CAST(p_partkey % 2 AS INT)), ',')"""


@query(
    "panel_labels",
    f"""SELECT p_partkey, nullif({_SEATS_SQL}[1], '') AS seat_1, nullif({_SEATS_SQL}[2], '') AS seat_2, nullif({_SEATS_SQL}[3], '') AS seat_3
        FROM part""",
)
def panel_labels(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        ("Upper Trib Judge", F.col("p_size") % 3),
        ("Des Judge First Tier", F.col("p_size") % 2),
        ("Judge First Tier", F.col("p_partkey") % 3),
        ("Non-Legal Member", F.col("p_partkey") % 2),
    ]
    return table(spark, sf, "part").select("p_partkey", *[arrays.seats(counts, i).alias(f"seat_{i}") for i in (1, 2, 3)])


DATE_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss'Z'", "dd/MM/yyyy"]


@query(
    "parse_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate")
    written = variant(
        F.col("o_orderkey"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(date, "dd/MM/yyyy"),
        F.lit("soon"),
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(dates.parse_any(written, DATE_PATTERNS), "yyyy-MM-dd").alias("parsed")
    )
