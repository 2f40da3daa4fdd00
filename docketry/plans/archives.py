"""Archive segments, retention metadata and validated payloads on the derived case tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.cases import archive, codes, fields, links, payloads
from docketry.cases.base import KEY, case_base
from docketry.operators import documents, joins, linking, projection, quality, skew
from docketry.plans import case_oracles
from docketry.plans.casework import (
    _CATS,
    _CLEANED,
    _FIRST_GWF,
    _GWF,
    _IN_UK_HELD,
    _OK,
    NAMES,
    SYSTEM,
    _any,
    _has,
    _language_sql,
    _last,
)
from docketry.plans.casework_tables import DERIVED, case_no, case_tables, ctes, derive, lookup
from docketry.plans.registry import ORACLES, query
from docketry.sources.files import read_lookup, table
from docketry.sources.scratch import scratch_path

AS_OF = "1998-12-01"
LABELS = {"first": "FTX", "upper": "UTX", "preserved": "FPX"}

_T = "(Outcome IS NULL OR Outcome NOT IN (38, 111)) AND (CaseStatus IS NULL OR CaseStatus <> 17)"
_ROWS = (
    ctes("header", "statuses", "locations")
    + f""", {case_oracles.CODES}, {_last(_T, 't')}, {_last("CaseStatus IS NULL OR CaseStatus NOT IN (52, 36)", 'st')},
      {_last("CaseStatus IN (40, 41, 42, 43, 44, 45, 53, 27, 28, 29, 34, 32, 33)", 'us')},
      marks AS (SELECT CaseNo, max(StatusId) AS mark FROM statuses WHERE CaseStatus = 46 GROUP BY 1),
      sa AS (SELECT statuses.* FROM statuses JOIN marks USING (CaseNo) WHERE StatusId < mark AND (CaseStatus IS NULL OR CaseStatus <> 46)
             QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY StatusId DESC) = 1)"""
)
_FROM = """FROM header ac LEFT JOIN locations fl ON fl.CaseNo = ac.CaseNo LEFT JOIN t ON t.CaseNo = ac.CaseNo LEFT JOIN st ON st.CaseNo = ac.CaseNo
   LEFT JOIN us ON us.CaseNo = ac.CaseNo LEFT JOIN sa ON sa.CaseNo = ac.CaseNo """ + case_oracles.JOIN_CODES


_CATEGORY = case_oracles.category(AS_OF)


@query("case_archive_categories", f"{_ROWS} SELECT ac.CaseNo, {_CATEGORY} AS category {_FROM} WHERE ac.CaseType = 1 AND DeptId NOT IN (519, 520)")
def case_archive_categories(spark: SparkSession, sf: str) -> DataFrame:
    rows = archive.wide_rows(case_tables(spark, sf, "statuses"), derive(spark, sf, "locations"))
    return archive.categories(rows, AS_OF)


@query(
    "case_archive_segments",
    f"""{_ROWS}, c AS (SELECT ac.CaseNo, {_CATEGORY} AS category, DeptId, CasePrefix, HOANRef, us.CaseNo AS upper, t.DecisionDate {_FROM} WHERE ac.CaseType = 1)
        SELECT CaseNo, 'FTX' AS Segment FROM c WHERE category = 'FT' AND DeptId NOT IN (519, 520)
        UNION SELECT CaseNo, 'FTX' FROM c WHERE CasePrefix IN ('IA', 'LD', 'LE', 'LH', 'LP', 'LR') AND HOANRef IS NOT NULL AND upper IS NULL
           AND (CAST(DecisionDate AS DATE) + INTERVAL 24 MONTH >= DATE '{AS_OF}' OR DecisionDate IS NULL) AND DeptId NOT IN (519, 520)
        UNION SELECT CaseNo, 'UTX' FROM c WHERE category IN ('UT Retained', 'UT Overdue') AND DeptId NOT IN (519, 520)
        UNION SELECT CaseNo, 'FPX' FROM c WHERE DeptId = 520""",
)
def case_archive_segments(spark: SparkSession, sf: str) -> DataFrame:
    return archive.segments(case_tables(spark, sf, "statuses"), derive(spark, sf, "locations"), AS_OF, LABELS)


_KIND = case_oracles.decision_kind(AS_OF)


@query("case_decision_list", f"{_ROWS} SELECT ac.CaseNo {_FROM} WHERE ac.CaseType = 1 AND {_KIND} = 'Decision'")
def case_decision_list(spark: SparkSession, sf: str) -> DataFrame:
    return archive.decision_list(case_tables(spark, sf, "statuses"), derive(spark, sf, "locations"), AS_OF)


BAIL_NOTE = "CASE o_custkey % 6 WHEN 0 THEN 'file destroyed' WHEN 1 THEN NULL WHEN 2 THEN 'distroyed 2001' ELSE 'on shelf' END"
BAIL_COMMENT = "CASE WHEN l_suppkey % 9 = 0 THEN 'for indefinite retention' WHEN l_suppkey % 11 = 0 THEN 'indefinate retention' ELSE 'moved' END"


@query(
    "case_bail_segments",
    ctes("statuses", "locations")
    + f""", fl AS (SELECT {case_no('o_orderkey')} AS CaseNo, CAST(515 + o_custkey % 8 AS INT) AS DeptId, {BAIL_NOTE} AS Note FROM orders),
       h AS (SELECT {case_no('l_orderkey')} AS CaseNo, {BAIL_COMMENT} AS Comment FROM lineitem),
       {_last("coalesce(CaseStatus, -1) <> 17", 't')},
       x AS (SELECT fl.CaseNo, Note, Comment, t.DecisionDate, coalesce(Comment LIKE '%indefinite retention%' OR Comment LIKE '%indefinate retention%', false) AS hold
             FROM fl LEFT JOIN h ON h.CaseNo = fl.CaseNo LEFT JOIN t ON t.CaseNo = fl.CaseNo WHERE DeptId <> 519)
       SELECT DISTINCT CaseNo, 'Normal Bail' AS BaseBailType FROM x
       WHERE (Note IS NULL OR Note NOT IN ('file destroyed', 'distroyed 2001')) AND NOT hold
         AND NOT coalesce(CAST(DecisionDate AS DATE) + INTERVAL 24 MONTH < DATE '{AS_OF}', false)
       UNION ALL SELECT DISTINCT CaseNo, 'BailLegalHold' FROM x WHERE hold""",
)
def case_bail_segments(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    cases = orders.select(F.expr(case_no("o_orderkey")).alias(KEY))
    locations = orders.select(
        F.expr(case_no("o_orderkey")).alias(KEY), F.expr("CAST(515 + o_custkey % 8 AS INT)").alias("DeptId"), F.expr(BAIL_NOTE).alias("Note")
    )
    history = table(spark, sf, "lineitem").select(
        F.expr(case_no("l_orderkey")).alias(KEY), F.expr(BAIL_COMMENT).alias("Comment")
    )
    return archive.bail_segments(cases, derive(spark, sf, "statuses"), locations, history, AS_OF)


_BAIL_CASE = {
    KEY: case_no("o_orderkey"),
    "CourtPreference": "CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 END",
    "Interpreter": "CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END",
    "AppellantDetained": "CAST(o_custkey % 6 AS INT)",
}
_BAIL_PLACE = {
    KEY: case_no("o_orderkey"),
    "centre": "CASE WHEN o_custkey % 3 > 0 THEN 'Centre ' || CAST(o_custkey % 3 AS STRING) END",
    "department": "CASE WHEN o_custkey % 2 = 0 THEN 'Store' END",
    "note": "CASE WHEN o_orderkey % 5 = 0 THEN 'shelf ' || CAST(o_orderkey % 7 AS STRING) END",
}


def _picked(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


@query(
    "case_bail_details",
    f"""WITH c AS (SELECT {', '.join(_picked(_BAIL_CASE))}, o_orderkey FROM orders), p AS (SELECT {', '.join(_picked(_BAIL_PLACE))} FROM orders),
          s AS (SELECT CaseNo, 'ScottishBailsFunds' AS BaseBailType FROM c WHERE o_orderkey % 3 <> 0 UNION ALL SELECT CaseNo, 'Normal Bail' FROM c WHERE o_orderkey % 2 = 0),
          d AS (SELECT {case_no('l_orderkey')} AS CaseNo, bool_or(l_returnflag <> 'N' AND l_linestatus = 'O') AS open FROM lineitem GROUP BY 1)
        SELECT s.CaseNo, s.BaseBailType, CASE s.BaseBailType WHEN 'Normal Bail' THEN 'Bail' ELSE 'Scottish Bail' END AS BailTypeDesc,
          CASE CourtPreference WHEN 1 THEN 'All Male,' WHEN 2 THEN 'All Female,' ELSE '' END AS CourtPreferenceDesc,
          CASE Interpreter WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' ELSE 'Unknown' END AS InterpreterDesc,
          CASE AppellantDetained WHEN 1 THEN 'HMP' WHEN 2 THEN 'IRC' WHEN 3 THEN 'No' WHEN 4 THEN 'Other' ELSE 'Unknown' END AS AppellantDetainedDesc,
          concat_ws(', ', centre, department, note) AS FileLocation, CASE WHEN d.open THEN 'B/F entries exist' ELSE '' END AS BFEntry
        FROM s JOIN c ON c.CaseNo = s.CaseNo LEFT JOIN p ON p.CaseNo = s.CaseNo LEFT JOIN d ON d.CaseNo = s.CaseNo""",
)
def case_bail_details(spark: SparkSession, sf: str) -> DataFrame:
    """Bail records of two lists, one of them from an external file with gaps and repeated rows."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "funds")
    listed = orders.select(F.expr(f"CASE WHEN o_orderkey % 3 <> 0 THEN {case_no('o_orderkey')} || ' ' END").alias(KEY))
    listed.unionAll(listed).write.option("header", True).csv(path)
    funds = archive.scottish_funds(read_lookup(spark, path, f"{KEY} string"))
    normal = orders.filter("o_orderkey % 2 = 0").select(F.expr(case_no("o_orderkey")).alias(KEY), F.lit("Normal Bail").alias("BaseBailType"))
    diary = table(spark, sf, "lineitem").select(
        F.expr(case_no("l_orderkey")).alias(KEY), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Entry"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("DateCompleted"),
    )
    made = archive.bail_details(orders.selectExpr(*_picked(_BAIL_CASE)), funds.unionByName(normal), orders.selectExpr(*_picked(_BAIL_PLACE)), diary)
    return made.select(KEY, "BaseBailType", "BailTypeDesc", "CourtPreferenceDesc", "InterpreterDesc", "AppellantDetainedDesc", "FileLocation", "BFEntry")


@query(
    "case_officers",
    """SELECT DISTINCT s_suppkey AS AdjudicatorId FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey
       WHERE CASE WHEN l_linenumber < 7 THEN 5 + l_linenumber % 4 END NOT IN (7, 8) OR CASE WHEN l_linenumber < 7 THEN 5 + l_linenumber % 4 END IS NULL""",
)
def case_officers(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("AdjudicatorId"))
    roles = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("AdjudicatorId"), F.when(F.col("l_linenumber") < 7, 5 + F.col("l_linenumber") % 4).alias("Role")
    ).distinct()
    return archive.officers(people, roles)


FINAL_PAIRS = [(10, 80), (26, 1), (37, 1), (37, 2), (38, 2), (39, 30), (46, 86), (46, 86)]


@query(
    "case_retention_metadata",
    ctes("header", "people", "statuses")
    + f""", r AS (SELECT *, row_number() OVER (PARTITION BY CaseNo ORDER BY StatusId DESC) AS rn FROM statuses),
       p AS (SELECT CaseNo, max(DecisionDate) FILTER (rn = 1) AS latest, max(CaseStatus) FILTER (rn = 1) AS CaseStatus, max(Outcome) FILTER (rn = 1) AS Outcome
             FROM r WHERE rn <= 2 GROUP BY 1)
       SELECT header.CaseNo AS client_identifier, 'GBR' AS region, 'LEGACY' AS publisher, CasePrefix AS record_class,
         strftime(CASE WHEN (CaseStatus, Outcome) IN ((10,80),(26,1),(37,1),(37,2),(38,2),(39,30),(46,86)) THEN coalesce(latest, TIMESTAMP '{AS_OF}')
              ELSE TIMESTAMP '{AS_OF}' END, '%Y-%m-%dT%H:%M:%SZ') AS event_date,
         '{AS_OF}T00:00:00Z' AS "recordDate", 'Records' AS entitlement_tag, HORef AS bf_001, Appellant_Forenames AS bf_002, Appellant_Name AS bf_003,
         strftime(BirthDate, '%Y-%m-%dT%H:%M:%SZ') AS bf_004, Appellant_Postcode AS bf_006
       FROM header LEFT JOIN people USING (CaseNo) LEFT JOIN p USING (CaseNo)""",
)
def case_retention_metadata(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spark.createDataFrame(FINAL_PAIRS, "status int, outcome int")
    header = derive(spark, sf, "header")
    return archive.retention_metadata(
        header.select(KEY, "HORef"),
        derive(spark, sf, "people").select(KEY, "Appellant_Forenames", "Appellant_Name", "BirthDate", "Appellant_Postcode"),
        derive(spark, sf, "statuses"),
        pairs,
        header.select(KEY, F.col("CasePrefix").alias("Segment")),
        AS_OF, SYSTEM, "GBR", "Records",
    )


_KEPT = "kept AS (SELECT CaseNo, CasePrefix AS Segment, HORef FROM header WHERE CaseType = 1)"


def _kept_cases(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "header").filter("CaseType = 1").select(KEY, F.col("CasePrefix").alias("Segment"), "HORef")


@query(
    "case_archive_documents",
    ctes("header", "statuses")
    + f""", {_KEPT}, p AS (SELECT CaseNo, (rn - 1) // 3 AS part,
         string_agg('<tr><td>' || strftime(DateReceived, '%Y-%m-%d') || '</td><td>' || CaseStatus || '</td><td>' || coalesce(CAST(Outcome AS VARCHAR), '') || '</td></tr>', ''
                    ORDER BY DateReceived, StatusId) AS rows,
         string_agg('{{"StatusId":' || StatusId || ',"status":' || CaseStatus || CASE WHEN Outcome IS NULL THEN '' ELSE ',"outcome":' || Outcome END
                    || ',"received":"' || strftime(DateReceived, '%Y-%m-%d') || '"}}', ',' ORDER BY DateReceived, StatusId) AS entries
         FROM (SELECT *, row_number() OVER (PARTITION BY CaseNo ORDER BY DateReceived, StatusId) AS rn FROM statuses) GROUP BY 1, 2),
       x AS (SELECT kept.*, part, rows, entries, part IS NOT DISTINCT FROM min(part) OVER w AS first, part IS NOT DISTINCT FROM max(part) OVER w AS last
             FROM kept LEFT JOIN p USING (CaseNo) WINDOW w AS (PARTITION BY CaseNo))
       SELECT CaseNo, coalesce(part, 0) AS part,
         CASE WHEN first THEN '<html><h1>' || CaseNo || '</h1><p>' || Segment || ' ' || coalesce(HORef, '') || '</p><table>' ELSE '' END || coalesce(rows, '')
           || CASE WHEN last THEN '</table></html>' ELSE '' END AS html,
         CASE WHEN first THEN '{{"CaseNo":"' || CaseNo || '","Segment":"' || Segment || '"' || CASE WHEN HORef IS NULL THEN '' ELSE ',"HORef":"' || HORef || '"' END || ',"statuses":['
           ELSE ',' END || coalesce(entries, '') || CASE WHEN last THEN ']}}' ELSE '' END AS json
       FROM x""",
)
def case_archive_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Pages and nested records of the archived cases, in parts of three status rows."""
    return archive.case_documents(_kept_cases(spark, sf), derive(spark, sf, "statuses"), 3)


@query(
    "case_archive_manifests",
    ctes("header")
    + f""", {_KEPT}, n AS (SELECT *, (row_number() OVER (ORDER BY CaseNo) - 1) // 250 + 1 AS batch_id, replace(CaseNo, '/', '_') AS file FROM kept)
       SELECT batch_id, count(*) AS records, string_agg(
         '{{"operation":"create_record","relation_id":"' || CaseNo || '","record_metadata":{{"publisher":"Records","record_class":"' || Segment || '","bf_001":"' || coalesce(HORef, '') || '"}}}}'
         || chr(10) || '{{"operation":"upload_new_file","relation_id":"' || CaseNo || '","file_metadata":{{"publisher":"Records","dz_file_name":"case_' || file || '.html","file_tag":"html"}}}}'
         || chr(10) || '{{"operation":"upload_new_file","relation_id":"' || CaseNo || '","file_metadata":{{"publisher":"Records","dz_file_name":"case_' || file || '.json","file_tag":"json"}}}}',
         chr(10) ORDER BY CaseNo) AS manifest
       FROM n GROUP BY 1""",
)
def case_archive_manifests(spark: SparkSession, sf: str) -> DataFrame:
    return archive.manifests(_kept_cases(spark, sf), "Records", "case_")


# ---------------------------------------------------------------- combined records

# family -> (table, columns in the order of the struct, order), for the SQL side.
_FAMILIES = {
    "statuses": ("statuses", ["StatusId", "CaseStatus", "Outcome", "DecisionDate", "HearingCentre", "Party"], "DateReceived, StatusId"),
    "hearings": ("(SELECT * FROM statuses WHERE HearingDate IS NOT NULL)", ["StatusId", "HearingDate", "ListTypeId", "TimeEstimate", "CourtName"], "StatusId"),
    "transactions": ("transactions", ["TransactionId", "TransactionTypeId", "Amount", "Status"], "TransactionId, TransactionTypeId, Amount, Status"),
    "judges": ("judges", ["Judge_Surname", "Judge_Forenames", "Judge_Title", "Required"], "Judge_Surname, Judge_Forenames, Judge_Title NULLS FIRST, Required NULLS FIRST"),
    "categories": ("(SELECT DISTINCT * FROM categories)", ["CategoryId"], "CategoryId"),
    "history": ("history", ["HistoryId", "HistType", "Comment"], "HistoryId"),
    "documents": ("documents_received", ["ReceivedDocumentId", "DateReceived"], "DateReceived NULLS FIRST, ReceivedDocumentId NULLS FIRST"),
    "links": ("linked", ["LinkNo", "position", "peers"], "LinkNo"),
}


def _family_sql(name: str, key: str, source: str, columns: list[str], order: str, size: int) -> str:
    shown = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return (
        f"f_{name} AS (SELECT {key}, (rn - 1) // {size} AS part, string_agg({shown}, ';' ORDER BY rn) AS shown, count(*) AS n "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) GROUP BY 1, 2)"
    )


def _row_text(columns: list[str]):
    return lambda c: F.concat_ws("|", *[F.coalesce(c[k].cast("string"), F.lit("")) for k in columns])


def _shown(df: DataFrame, names: dict[str, list[str]]) -> list:
    """Each family as text and its length; timestamps and decimals as both engines write them."""
    out = []
    for name, columns in names.items():
        rows = F.transform(name, _row_text(columns))
        out += [F.nullif(F.array_join(rows, ";"), F.lit("")).alias(name), F.size(name).cast("long").alias(f"n_{name}")]
    return out


def _combined_sql(families: dict, key: str, heads: str, columns: list[str], size: int) -> str:
    parts = " UNION ".join([f"SELECT {key}, 0 AS part FROM {heads}", *[f"SELECT {key}, part FROM f_{n}" for n in families]])
    joined = " ".join(f"LEFT JOIN f_{n} ON f_{n}.{key} = p.{key} AND f_{n}.part = p.part" for n in families)
    shown = ", ".join(f"f_{n}.shown AS {n}, coalesce(f_{n}.n, 0) AS n_{n}" for n in families)
    own = ", ".join(f"h.{c}" for c in columns)
    return f"p AS ({parts}) SELECT p.{key}, p.part, {own}, {shown} FROM p LEFT JOIN {heads} h ON h.{key} = p.{key} AND p.part = 0 {joined}"


_LINKED = f"""linked AS (SELECT {case_no('o_orderkey')} AS CaseNo, o_custkey AS LinkNo, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, {case_no('o_orderkey')}) AS position,
   count(*) OVER (PARTITION BY o_custkey) - 1 AS peers FROM orders QUALIFY peers > 0)"""


@query(
    "case_combined",
    ctes("header", "statuses", "transactions", "judges", "categories", "history", "documents_received")
    + f""", {_LINKED}, {", ".join(_family_sql(n, "CaseNo", *f, 3) for n, f in _FAMILIES.items())},
       {_combined_sql(_FAMILIES, "CaseNo", "header", ["CasePrefix", "HORef", "lu_appealType"], 3)}""",
)
def case_combined(spark: SparkSession, sf: str) -> DataFrame:
    """The combined archive record with eight child families, three children of each to a part."""
    tables = case_tables(spark, sf, "statuses", "transactions", "judges", "categories", "history")
    linkable = table(spark, sf, "orders").select(F.expr(case_no("o_orderkey")).alias(KEY), F.col("o_custkey").alias("LinkNo"), "o_orderdate")
    linked = linking.membership(linkable, "LinkNo", ["o_orderdate", KEY], F.year("o_orderdate"))
    cases = tables.header.select(KEY, "CasePrefix", "HORef", "lu_appealType")
    made = archive.combined_cases(cases, tables, derive(spark, sf, "documents_received"), linked, 3, weighed=linkable)
    return made.select(KEY, "part", "CasePrefix", "HORef", "lu_appealType", *_shown(made, {n: f[1] for n, f in _FAMILIES.items()}))


_OFFICER_FAMILIES = {
    "OtherCentres": ("centres", ["OtherCentre"], "OtherCentre"),
    "Roles": ("roles", ["Role", "DateOfAppointment", "EndDateOfAppointment"], "DateOfAppointment, Role, EndDateOfAppointment NULLS FIRST"),
    "History": ("moves", ["HistDate", "HistType", "UserName", "Comment"], "HistDate, HistType, UserName, Comment"),
}
_CENTRE = "'Centre ' || CAST(l_partkey % 40 AS STRING)"
_ROLE = {"Role": "CAST(l_linenumber AS INT)", "DateOfAppointment": "l_shipdate", "EndDateOfAppointment": "CASE WHEN l_partkey % 3 = 0 THEN l_shipdate + INTERVAL '1' YEAR END"}
_MOVE = {"HistDate": "l_shipdate", "HistType": "CAST(l_linenumber AS INT)", "UserName": "'user' || CAST(l_partkey % 9 AS STRING)", "Comment": "'order ' || CAST(l_orderkey AS STRING)"}


@query(
    "case_officer_records",
    f"""WITH centres AS (SELECT DISTINCT l_suppkey AS AdjudicatorId, {_CENTRE} AS OtherCentre FROM lineitem WHERE l_linenumber = 1),
       roles AS (SELECT l_suppkey AS AdjudicatorId, {', '.join(f'{e} AS {c}' for c, e in _ROLE.items())} FROM lineitem WHERE l_linenumber > 5),
       moves AS (SELECT l_suppkey AS AdjudicatorId, {', '.join(f'{e} AS {c}' for c, e in _MOVE.items())} FROM lineitem),
       people AS (SELECT s_suppkey AS AdjudicatorId, s_name AS Surname FROM supplier),
       {", ".join(_family_sql(n, "AdjudicatorId", *f, 20) for n, f in _OFFICER_FAMILIES.items())},
       {_combined_sql(_OFFICER_FAMILIES, "AdjudicatorId", "people", ["Surname"], 20)}""",
)
def case_officer_records(spark: SparkSession, sf: str) -> DataFrame:
    """Officers with their other centres, appointments and history, twenty of each to a part."""
    lines = table(spark, sf, "lineitem")
    key = "l_suppkey AS AdjudicatorId"
    centres = lines.filter("l_linenumber = 1").selectExpr(key, f"{_CENTRE} AS OtherCentre")
    roles = lines.filter("l_linenumber > 5").selectExpr(key, *[f"{e} AS {c}" for c, e in _ROLE.items()])
    moves = lines.selectExpr(key, *[f"{e} AS {c}" for c, e in _MOVE.items()])
    people = table(spark, sf, "supplier").selectExpr("s_suppkey AS AdjudicatorId", "s_name AS Surname")
    made = archive.combined_officers(people, centres, roles, moves, size=20)
    return made.select("AdjudicatorId", "part", "Surname", *_shown(made, {n: f[1] for n, f in _OFFICER_FAMILIES.items()}))


_SEAT = "CASE {0} % 5 WHEN 0 THEN 10 WHEN 1 THEN 11 WHEN 2 THEN 12 WHEN 3 THEN 3 ELSE 99 END"
_SITTING = [("l_suppkey", "'Judge ' || CAST(l_suppkey % 50 AS STRING)"), ("l_partkey", "'Member ' || CAST(l_partkey % 50 AS STRING)")]
_STATUS_ID = DERIVED["statuses"][0]["StatusId"]
# A status row with a note puts off the one before it; the two rows of a few cases put off each other.
_PARENT = "CASE WHEN AdditionalLanguageId IN (1, 2, 3) THEN lag(StatusId) OVER w WHEN AdditionalLanguageId = 6 THEN lead(StatusId) OVER w END"


@query(
    "case_hearing_texts",
    ctes("statuses")
    + f""", sittings AS ({" UNION ALL ".join(f"SELECT {case_no('l_orderkey')} AS CaseNo, {_STATUS_ID} AS StatusId, {_SEAT.format(c)} AS Position, {n} AS FullName FROM lineitem" for c, n in _SITTING)}),
       bench AS (SELECT CaseNo, StatusId, min(FullName) FILTER (Position = 10) AS chair, min(FullName) FILTER (Position = 11) AS second, min(FullName) FILTER (Position = 12) AS third,
                 min(FullName) FILTER (Position = 3) AS clerk FROM sittings GROUP BY 1, 2),
       x AS (SELECT CaseNo, StatusId, DateReceived, {_PARENT} AS parent, last_value(HearingCentre IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS centre,
               last_value(CourtName IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS court, row_number() OVER w AS rn
             FROM statuses WINDOW w AS (PARTITION BY CaseNo ORDER BY DateReceived, StatusId)),
       r AS (WITH RECURSIVE f AS (SELECT CaseNo, StatusId, DateReceived AS since, 0 AS depth FROM x WHERE parent IS NULL
             UNION ALL SELECT x.CaseNo, x.StatusId, f.since, f.depth + 1 FROM x JOIN f ON f.CaseNo = x.CaseNo AND f.StatusId = x.parent) SELECT * FROM f)
       SELECT x.CaseNo, (rn - 1) // 4 AS part, string_agg(strftime(DateReceived, '%Y-%m-%d') || coalesce(' at ' || centre, '') || coalesce(', ' || court, '')
         || coalesce(' before ' || nullif(concat_ws(', ', chair, second, third), ''), '') || coalesce(' (clerk ' || clerk || ')', '')
         || CASE WHEN r.depth > 0 THEN ' put off ' || r.depth || ' times since ' || strftime(since, '%Y-%m-%d') WHEN r.depth IS NULL THEN ' put off in a loop' ELSE '' END, chr(10) ORDER BY rn) AS text
       FROM x LEFT JOIN bench USING (CaseNo, StatusId) LEFT JOIN r ON r.CaseNo = x.CaseNo AND r.StatusId = x.StatusId GROUP BY 1, 2""",
)
def case_hearing_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Hearings as text with their bench, the place carried along and adjournments followed, four lines to a part."""
    w = Window.partitionBy(KEY).orderBy("DateReceived", "StatusId")
    language = F.col("AdditionalLanguageId")
    parent = F.when(language.isin(1, 2, 3), F.lag("StatusId").over(w)).when(language == 6, F.lead("StatusId").over(w))
    lines = table(spark, sf, "lineitem")
    sittings = [lines.selectExpr(f"{case_no('l_orderkey')} AS {KEY}", f"{_STATUS_ID} AS StatusId", f"{_SEAT.format(c)} AS Position", f"{n} AS FullName") for c, n in _SITTING]
    seated = sittings[0].unionAll(sittings[1])
    statuses = derive(spark, sf, "statuses").select(KEY, "StatusId", "DateReceived", "HearingCentre", "CourtName", "AdditionalLanguageId")
    tasks = skew.width(statuses, seated)
    # Shuffled here by the case, the rows stay where they are for all that follows.
    placed = (statuses.repartition(tasks, KEY) if tasks else statuses).withColumn("ParentStatusId", parent)
    return archive.hearing_texts(placed, seated, 4, tasks, weighed=[statuses, seated])


# ---------------------------------------------------------------- payloads

JUDGE_STATES = ["caseUnderReview", "reasonsForAppealSubmitted", "prepareForHearing", "decided(b)"]
CONTEXT = payloads.Context(SYSTEM, "LIVE", AS_OF, NAMES)
_LOOKED_UP = {
    "listing": lambda b, s: fields.with_languages(b, lookup(s, "languages")),
    "prepareForHearing": lambda b, s: fields.with_location(b, lookup(s, "listing_locations")),
    "ended": lambda b, s: fields.with_reached(fields.with_end_states(b, lookup(s, "end_states"))),
}


# What the lookups of a state are joined by.
_READ = [
    "CentreId", "prev_location", "Rep_Postcode", "CaseRep_Postcode", "Appellant_Postcode", "DetentionCentreId", "PaymentRemissionReason",
    "PaymentRemissionRequested", "LanguageId", "s_listing", "s_listed", "s_ended", "s_reached",
]


def state_base(
    spark: SparkSession, sf: str, state: str, whole: bool = False, read: Mapping[str, Sequence[str]] | None = None, settle: payloads.Settle = lambda df: df
) -> DataFrame:
    """The base of a state: its status rows and the lookups of the states it builds on.

    A case has some 150 columns and passes up to fifteen joins. ``whole`` is for content that uses nearly all of them: they travel
    as one value. Without it the planner drops the columns that are not asked for, which is better where many are not.
    ``read`` and ``settle`` are those of ``status_summary`` and ``rule_results``.
    """
    path = quality.state_path(state, payloads.PREVIOUS)
    needed = ["people", "statuses", "categories", "refs", "history"]
    needed += ["transactions"] if "appealSubmitted" in path else []
    needed += ["judges"] if any(s in path for s in JUDGE_STATES) else []
    tables = case_tables(spark, sf, *needed)
    header = settle(fields.with_rep_place(tables.header, NAMES))
    if whole:
        header = joins.pack(header, [KEY, "HORef", *_READ], "_header")
    base = settle(fields.with_reference(fields.with_place(case_base(replace(tables, header=header), payloads.variants(state), read))))
    if whole:
        base = joins.pack(base, [KEY, *_READ], "_case")
    base = fields.with_centres(base, lookup(spark, "centres"), lookup(spark, "area_centres"), lookup(spark, "detention_centres"))
    # The lookup holds one row per reason, so a case stays one row.
    base = settle(fields.with_remission(base, lookup(spark, "remissions"), lenient="appealSubmitted" in path))
    for name, join in _LOOKED_UP.items():
        if name in path:
            base = join(base, spark)
    return joins.unpack(joins.unpack(base, "_case"), "_header") if whole else base


def state_payloads(spark: SparkSession, sf: str, state: str) -> DataFrame:
    return payloads.payloads(state_base(spark, sf, state, whole=True), state, CONTEXT, f"out/{state}")


_UNMAPPED = [
    "valid_appealReferenceNumber_not_null", "valid_appealType_in_allowed_values", "valid_appealSubmissionDate_format",
    "valid_tribunalReceivedDate_format", "valid_appellantsRepresentation_yes_no", "valid_submissionOutOfTime_yes_no",
    "+valid_legalRepGivenName", "+valid_legalRepFamilyNamePaperJ", "valid_appellantFamilyName_not_null", "valid_appellantGivenNames_not_null",
    "valid_appellantDateOfBirth_format", "valid_isAppellantMinor_yes_no", "valid_appellantInUk_opposite", "valid_appellantStateless",
    "valid_deportationOrderOptions_yes_no",
]
_FAILED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN lu_appealType IS NULL{' AND dv_representation = ' + repr('LR') if n.startswith('+') else ''} THEN '{n.lstrip('+')}' END" for n in _UNMAPPED
) + ", CASE WHEN plain IS NOT NULL AND NOT regexp_matches(plain, '^[0-9]{9}$') THEN 'valid_homeOfficeReferenceNumber_format' END)"


@query(
    "case_payloads",
    ctes("header", "people", "categories", "refs")
    + f""", {_CATS}, x AS (SELECT h.*, CASE WHEN {_IN_UK_HELD} OR NOT {_FIRST_GWF} THEN coalesce({_CLEANED}, '999999999') END AS plain0,
             CASE WHEN NOT {_IN_UK_HELD} AND {_GWF} THEN {_CLEANED} END AS g
             FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo)
             LEFT JOIN (SELECT CaseNo, coalesce(CleanHORef, CleanFCONumber) AS lu_HORef FROM refs) USING (CaseNo)),
       y AS (SELECT *, CASE WHEN plain0 IS NULL AND g IS NULL THEN '999999999' ELSE plain0 END AS plain FROM x),
       z AS (SELECT *, {_FAILED} AS failed FROM y)
       SELECT CaseNo, 'out/paymentPending/' || CASE WHEN failed = '' THEN 'JSON' ELSE 'INVALID_JSON' END || '/APPEALS_' || replace(CaseNo, '/', '_') || '.json' AS file_name,
         failed = '' AS is_valid, failed AS failed_rules, lu_appealType AS json_type, 'pendingPayment' AS json_state, 'Yes' AS json_default, plain AS json_reference
       FROM z""",
)
def case_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """JSON payloads with their rule checks; the columns shown are read back from the JSON."""
    df = state_payloads(spark, sf, "paymentPending")
    read = documents.read_back(F.col("content"), "appealType string, legacyDesiredState string, isIntegrated string, homeOfficeReferenceNumber string")
    return df.withColumn("c", read).select(
        KEY, "file_name", "is_valid", F.array_join("failed_rules", ",").alias("failed_rules"), F.col("c.appealType").alias("json_type"),
        F.col("c.legacyDesiredState").alias("json_state"), F.col("c.isIntegrated").alias("json_default"),
        F.col("c.homeOfficeReferenceNumber").alias("json_reference"),
    )


_UNMAPPED_LR = [n.lstrip("+") for n in _UNMAPPED if n.startswith("+")]
_REACHED = "CASE z.CaseStatus WHEN 26 THEN 2 WHEN 37 THEN 3 WHEN 38 THEN 3 WHEN 39 THEN 4 ELSE 0 END"


def _rules_sql(state: str) -> str:
    """Which cases fail which rules, said in terms of the case tables; rules that are not named here hold for every case.

    Nothing of the rules' own conditions is used, only their names: a case without a mapped appeal type lacks the fields
    that depend on it, a reference may have another form, an interpreter may be asked for without a known language, and a
    case may not have ended at all.
    """
    fails = {n.lstrip("+"): "unmapped" for n in _UNMAPPED} | dict.fromkeys(_UNMAPPED_LR, "unmapped AND dv_representation = 'LR'")
    fails["valid_homeOfficeReferenceNumber_format"] = "plain IS NOT NULL AND NOT regexp_matches(plain, '^[0-9]{9}$')"
    if state != "paymentPending":
        fails["valid_interpreter_language"] = "Interpreter = 1 AND spoken IS NULL AND sign IS NULL" + (" AND reached >= 3" if state == "ended" else "")
    if state == "ended":
        fails |= {"valid_endAppealOutcome_not_null": "endAppealOutcome IS NULL", "valid_endAppealApproverType": "endAppealApproverType IS NULL", "valid_stateBeforeEndAppeal_not_null": "stateBeforeEndAppeal IS NULL"}
    names = list(payloads.rules(state, SYSTEM))
    missing = set(fails) - set(names)
    assert not missing, missing
    cases = " ".join(f"WHEN '{n}' THEN {c}" for n, c in fails.items())
    return (
        ctes("header", "people", "categories", "refs", "statuses")
        + f""", {_CATS}, li AS ({ORACLES["case_interpreter"]}), en AS ({ORACLES["case_ended"]}),
           {_last("(CaseStatus = 26 AND Outcome IN (13, 25, 80)) OR (CaseStatus IN (37, 38) AND Outcome IN (13, 25, 80)) OR (CaseStatus = 38 AND Outcome = 72) OR (CaseStatus = 39 AND Outcome = 25)", "z")},
           x AS (SELECT h.*, CASE WHEN {_IN_UK_HELD} OR NOT {_FIRST_GWF} THEN coalesce({_CLEANED}, '999999999') END AS plain0, CASE WHEN NOT {_IN_UK_HELD} AND {_GWF} THEN {_CLEANED} END AS g
                 FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo)
                 LEFT JOIN (SELECT CaseNo, coalesce(CleanHORef, CleanFCONumber) AS lu_HORef FROM refs) USING (CaseNo)),
           y AS (SELECT x.*, lu_appealType IS NULL AS unmapped, CASE WHEN plain0 IS NULL AND g IS NULL THEN '999999999' ELSE plain0 END AS plain, spoken, sign, {_REACHED} AS reached,
                   endAppealOutcome, endAppealApproverType, stateBeforeEndAppeal
                 FROM x LEFT JOIN li USING (CaseNo) LEFT JOIN en USING (CaseNo) LEFT JOIN z ON z.CaseNo = x.CaseNo),
           r(rule) AS (VALUES {", ".join(f"('{n}')" for n in names)}),
           f AS (SELECT rule, coalesce(CASE rule {cases} ELSE false END, false) AS bad FROM y CROSS JOIN r)
           SELECT rule, count(*) FILTER (NOT bad) AS passed, count(*) FILTER (bad) AS failed FROM f GROUP BY 1"""
    )


def rules_query(state: str):
    @query(f"case_rules_{state}", _rules_sql(state))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        """Passed and failed cases per rule of a state: its own rules and all that it inherits."""
        return payloads.rule_results(lambda read, settle: state_base(spark, sf, state, read=read, settle=settle), state, CONTEXT)

    return run


for _state in ("paymentPending", "listing", "prepareForHearing", "ended"):
    rules_query(_state)


@query(
    "case_payload_ended",
    ctes("header", "people", "categories", "statuses", "languages")
    + f""", {_CATS}, {_last("(CaseStatus = 26 AND Outcome IN (13, 25, 80)) OR (CaseStatus IN (37, 38) AND Outcome IN (13, 25, 80)) OR (CaseStatus = 38 AND Outcome = 72) OR (CaseStatus = 39 AND Outcome = 25)", "z")},
       {_last("(CaseStatus IN (37, 38) AND Outcome IN (0, 27, 37, 39, 40, 50)) OR (CaseStatus = 26 AND Outcome IN (40, 52))")},
       x AS (SELECT h.CaseNo, {_OK} AS ok, ids, Detained, CASE z.CaseStatus WHEN 26 THEN 2 WHEN 37 THEN 3 WHEN 38 THEN 3 WHEN 39 THEN 4 ELSE 0 END AS reached,
               {_language_sql('spokenLanguageInterpreter')} AS spoken, {_language_sql('signLanguageInterpreter')} AS sign
             FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats ON cats.CaseNo = h.CaseNo LEFT JOIN z ON z.CaseNo = h.CaseNo LEFT JOIN m3 ON m3.CaseNo = h.CaseNo
             LEFT JOIN languages il ON il.LanguageId = h.LanguageId
             LEFT JOIN languages ail ON ail.LanguageId = m3.AdditionalLanguageId AND h.LanguageId IS DISTINCT FROM m3.AdditionalLanguageId)
       SELECT CaseNo, CASE WHEN reached >= 2 THEN 'Yes' END AS bundle, CASE WHEN reached >= 2 THEN 0 END AS respondent, CASE WHEN reached >= 3 THEN 'No' END AS witnesses,
         CASE WHEN reached >= 3 THEN 'decisionMaintained' END AS review, CASE WHEN reached >= 4 THEN 'No' END AS remote, CASE WHEN reached >= 4 THEN 'DONE' END AS stitching,
         'Yes' AS direction,
         nullif(concat_ws(',', CASE WHEN ok AND {_any(17, 29, 30, 39, 40, 48, 19)} THEN 'PF0012' END, CASE WHEN ok AND {_has(9)} THEN 'PF0013' END,
           CASE WHEN ok AND Detained IN (1, 2, 4) THEN 'PF0019' END, CASE WHEN reached >= 3 THEN 'RA0019,RA0043,PF0014' END,
           CASE WHEN reached >= 3 AND spoken IS NOT NULL THEN 'PF0015' END, CASE WHEN reached >= 3 AND sign IS NOT NULL THEN 'RA0042' END), '') AS flags
       FROM x""",
)
def case_payload_ended(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of ended cases read back from their payloads: what a case has depends on how far it had come."""
    df = state_payloads(spark, sf, "ended")
    read = documents.read_back(
        F.col("content"),
        "uploadHomeOfficeBundleAvailable string, respondentDocuments array<string>, isWitnessesAttending string, appealReviewOutcome string, "
        "isRemoteHearing string, stitchingStatus string, changeDirectionDueDateActionAvailable string, "
        "appellantLevelFlags struct<details: array<struct<value: struct<flagCode: string>>>>",
    )
    c = df.select(KEY, read.alias("c"))
    codes_of = F.array_join(F.transform("c.appellantLevelFlags.details", lambda x: x["value"]["flagCode"]), ",")
    return c.select(
        KEY, F.col("c.uploadHomeOfficeBundleAvailable").alias("bundle"), F.when(F.col("c.respondentDocuments").isNotNull(), F.size("c.respondentDocuments")).alias("respondent"),
        F.col("c.isWitnessesAttending").alias("witnesses"), F.col("c.appealReviewOutcome").alias("review"), F.col("c.isRemoteHearing").alias("remote"),
        F.col("c.stitchingStatus").alias("stitching"), F.col("c.changeDirectionDueDateActionAvailable").alias("direction"), codes_of.alias("flags"),
    )


# Link reasons of the old system by the key of the new one.
REASON_KEYS = {**dict.fromkeys(range(2, 23), "CLRC005"), 23: "CLRC006", 24: "CLRC008", 25: "CLRC010", 26: "CLRC014", 27: "CLRC014"}


@query(
    "case_link_entries",
    f"""SELECT {case_no('o_orderkey')} AS "CaseNo", o_custkey AS "LinkNo", 2 + o_orderkey % 26 AS "ReasonLinkId",
               CASE WHEN 2 + o_orderkey % 26 <= 22 THEN 'CLRC005' WHEN 2 + o_orderkey % 26 = 23 THEN 'CLRC006' WHEN 2 + o_orderkey % 26 = 24 THEN 'CLRC008'
                    WHEN 2 + o_orderkey % 26 = 25 THEN 'CLRC010' ELSE 'CLRC014' END AS key,
               row_number() OVER w AS position, count(*) OVER (PARTITION BY o_custkey) - 1 AS peers
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, {case_no('o_orderkey')})
        QUALIFY peers > 0""",
)
def case_link_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Cases of a link group in birth-date order with the mapped reason: one row per case, not per pair."""
    reason = (F.col("o_orderkey") % 26 + 2).cast("int")
    cases = table(spark, sf, "orders").select(
        F.expr(case_no("o_orderkey")).alias(KEY), F.col("o_custkey").alias("LinkNo"), F.col("o_orderdate").alias("BirthDate"),
        reason.alias("ReasonLinkId"), projection.map_lookup(reason, REASON_KEYS).alias("key"),
    )
    members = linking.membership(cases, "LinkNo", ["BirthDate", KEY], F.year("BirthDate"))
    return members.select(KEY, "LinkNo", F.col("ReasonLinkId").cast("long").alias("ReasonLinkId"), "key", "position", "peers")


_ENTRY_SQL = """'{"id":"' || CaseNo || '","value":{"CaseType":"Asylum","CaseReference":"' || CaseNo || '","ReasonForLink":[{"id":"' || sha256(CaseNo || '|' || key)
   || '","value":{"Reason":"' || key || '"}}]}}'"""


@query(
    "case_link_payloads",
    f"""WITH c AS (SELECT {case_no('o_orderkey')} AS CaseNo, o_custkey AS LinkNo, o_orderkey,
               CASE WHEN o_orderkey % 26 <= 20 THEN 'CLRC005' WHEN o_orderkey % 26 = 21 THEN 'CLRC006' WHEN o_orderkey % 26 = 22 THEN 'CLRC008'
                    WHEN o_orderkey % 26 = 23 THEN 'CLRC010' ELSE 'CLRC014' END AS key FROM orders)
        SELECT LinkNo, (rn - 1) // 5 AS part, count(*) AS members, '[' || string_agg({_ENTRY_SQL}, ',' ORDER BY CaseNo) || ']' AS payload
        FROM (SELECT *, row_number() OVER (PARTITION BY LinkNo ORDER BY CaseNo) AS rn FROM c) GROUP BY 1, 2""",
)
def case_link_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the cases of a group, five to a payload."""
    reason = projection.map_lookup((F.col("o_orderkey") % 26 + 2).cast("int"), REASON_KEYS)
    cases = table(spark, sf, "orders").select(F.expr(case_no("o_orderkey")).alias(KEY), F.col("o_custkey").alias("LinkNo"), reason.alias("key"))
    made = links.payloads(cases.withColumn("entry", links.entry(F.col("key"), "Asylum")), "LinkNo", F.substring(KEY, 1, 9), 5)
    return made.withColumn("members", F.col("members").cast("long"))


@query(
    "case_lineage",
    ctes("header")
    + """ SELECT CaseNo, 'appealType' AS field, 'dv_representation,lu_appealType' AS input_fields,
         '{"dv_representation":"' || dv_representation || '"' || CASE WHEN lu_appealType IS NOT NULL THEN ',"lu_appealType":"' || lu_appealType || '"' ELSE '' END || '}' AS input_values,
         lu_appealType AS value, 'yes' AS transformation FROM header
       UNION ALL SELECT CaseNo, 'feeAmountGbp', 'dv_appealTypeCode,VisitVisaType',
         '{' || concat_ws(',', CASE WHEN dv_appealTypeCode IS NOT NULL THEN '"dv_appealTypeCode":"' || dv_appealTypeCode || '"' END,
                CASE WHEN VisitVisaType IS NOT NULL THEN '"VisitVisaType":"' || VisitVisaType || '"' END) || '}',
         CASE WHEN dv_appealTypeCode IN ('EA', 'EU', 'HU', 'PA') THEN CASE VisitVisaType WHEN 1 THEN '8000' WHEN 2 THEN '14000' END END, 'yes' FROM header""",
)
def case_lineage(spark: SparkSession, sf: str) -> DataFrame:
    header = derive(spark, sf, "header")
    content = header.select("*", fields.appeal_type()["appealType"].alias("appealType"), fields.payment()["feeAmountGbp"].alias("feeAmountGbp"))
    return documents.lineage(
        content, KEY,
        {"appealType": (["dv_representation", "lu_appealType"], True), "feeAmountGbp": (["dv_appealTypeCode", "VisitVisaType"], True)},
    )


@query(
    "case_codes",
    """SELECT l_linenumber % 5 AS code, CASE l_linenumber % 5 WHEN 0 THEN '' WHEN 1 THEN 'Appellant' WHEN 2 THEN 'Respondent' END AS party,
              CASE l_linenumber % 5 WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' ELSE '' END AS sent,
              CASE l_linenumber % 5 WHEN 0 THEN '' WHEN 1 THEN 'IA typed' WHEN 2 THEN 'Self typed' WHEN 3 THEN '3rd party typed' WHEN 4 THEN 'Unknown' END AS typing,
              count(*) AS n
       FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def case_codes(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("l_linenumber") % 5
    coded = table(spark, sf, "lineitem").select(
        code.cast("long").alias("code"), code.alias("Party"), code.alias("DecisionSentToHO"), code.alias("ExtemporeMethodOfTyping")
    )
    labels = codes.decode(coded, "archive_status").select(
        "code", F.col("Party").alias("party"), F.col("DecisionSentToHO").alias("sent"), F.col("ExtemporeMethodOfTyping").alias("typing")
    )
    return labels.groupBy("code", "party", "sent", "typing").agg(F.count(F.lit(1)).alias("n"))
