"""Case tables derived from the given tables.

Orders stand for cases, customers for people, lines for status rows and transactions. Every column is
written once as an expression that both engines read, so that the SQL side starts from the same tables
and differs only in the logic under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.cases.base import CaseTables
from docketry.sources.files import table


def _case(key: str, modulus: int, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {key} % {modulus} {whens} ELSE {values[-1]} END"


def prefix(key: str) -> str:
    return _case(key, 10, *[f"'{p}'" for p in ("EA", "HU", "PA", "DC", "RP", "DA", "IA", "LP", "VA", "EA")])


def case_no(key: str) -> str:
    return f"{prefix(key)} || '/' || lpad(CAST({key} AS STRING), 9, '0')"


_O = "o_orderkey"

HEADER = {
    "CaseNo": case_no(_O),
    "CaseType": "1",
    "CasePrefix": prefix(_O),
    "dv_appealTypeCode": _case(_O, 10, "'EA'", "'HU'", "'PA'", "'DC'", "'RP'", "'DA'", "'EU'", "'PA'", "NULL", "'EA'"),
    "lu_appealType": _case(
        _O, 10, "'refusalOfEu'", "'refusalOfHumanRights'", "'protection'", "'deprivation'", "'revocationOfProtection'",
        "'refusalOfHumanRights'", "'euSettlementScheme'", "'protection'", "NULL", "'refusalOfEu'",
    ),
    "dv_representation": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'AIP' ELSE 'LR' END",
    "dv_TargetState": _case(_O, 4, "'paymentPending'", "'appealSubmitted'", "'listing'", "'ended'"),
    "VisitVisaType": _case(_O, 3, "NULL", "1", "2"),
    "DateLodged": "o_orderdate",
    "DateAppealReceived": "o_orderdate",
    "DateOfApplicationDecision": "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END",
    "DateCorrectFeeReceived": "o_orderdate",
    "OutOfTimeIssue": "o_orderstatus = 'F'",
    "HOANRef": "CASE WHEN o_orderkey % 11 = 0 THEN 'D' || CAST(o_orderkey AS STRING) END",
    "HORef": _case(_O, 4, "'GWF' || CAST(o_orderkey AS STRING)", "CAST(o_orderkey AS STRING)", "'XXXX'", "NULL"),
    "Contact": "CASE WHEN o_custkey % 4 = 0 THEN 'Contact ' || CAST(o_custkey AS STRING) END",
    "Rep_Name": "CASE WHEN o_custkey % 3 <> 0 THEN 'Rep ' || CAST(o_custkey AS STRING) END",
    "CaseRep_Name": "'Case rep ' || CAST(o_custkey AS STRING)",
    "RepresentativeId": "CAST(o_custkey % 3 AS INT)",
    "Rep_Address1": "CASE WHEN o_orderkey % 5 <> 0 THEN '1 High Street' END",
    "Rep_Address2": "CASE WHEN o_orderkey % 3 <> 0 THEN 'Old Quarter' END",
    "Rep_Address3": "CASE WHEN o_orderkey % 2 = 0 THEN 'Leeds' END",
    "Rep_Address4": "CASE WHEN o_orderkey % 7 = 0 THEN 'Yorkshire' END",
    "Rep_Address5": "CASE WHEN o_orderkey % 13 = 0 THEN 'England' END",
    "Rep_Postcode": _case(_O, 4, "'LS1 4AP'", "NULL", "'b1 1AA'", "NULL"),
    "CaseRep_Address1": "CASE WHEN o_orderkey % 6 <> 0 THEN '2 Low Road' END",
    "CaseRep_Address2": "CASE WHEN o_orderkey % 4 <> 0 THEN 'Harbour' END",
    "CaseRep_Address3": "CASE WHEN o_orderkey % 2 = 1 THEN ' Nairobi ' END",
    "CaseRep_Address4": "CASE WHEN o_orderkey % 3 = 1 THEN 'Kenya' END",
    "CaseRep_Address5": "CASE WHEN o_orderkey % 8 = 0 THEN 'Spain' END",
    "CaseRep_Postcode": _case(_O, 5, "'SW1A 1AA'", "'m1 1aa'", "'nowhere'", "NULL", "''"),
    "Rep_Email": "CASE WHEN o_custkey % 3 <> 0 THEN ' .Rep' || CAST(o_custkey AS STRING) || ' @law.example, ' END",
    "CaseRep_Email": "CASE WHEN o_custkey % 2 = 0 THEN 'case' || CAST(o_custkey AS STRING) || '@law.example' END",
    "CaseRep_FileSpecific_Email": "'(file@law.example)'",
    "CentreId": "CAST(o_custkey % 30 AS INT)",
    "DetentionCentreId": "CASE WHEN o_orderkey % 3 <> 1 THEN CAST(o_custkey % 4 AS INT) END",
    "PaymentRemissionRequested": _case(_O, 4, "0", "1", "2", "NULL"),
    "PaymentRemissionReason": "CAST(o_custkey % 4 AS INT)",
    "PaymentRemissionGranted": _case(_O, 4, "0", "1", "2", "NULL"),
    "LSCReference": "CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS STRING) END",
    "ASFReferenceNo": "CASE WHEN o_custkey % 7 <> 0 THEN 'ASF' || CAST(o_custkey AS STRING) END",
    "PaymentRemissionReasonNote": "CASE WHEN o_custkey % 9 <> 0 THEN 'HWF-' || CAST(o_custkey AS STRING) END",
    "InCamera": "CASE WHEN o_orderkey % 5 <> 4 THEN o_orderkey % 5 = 0 END",
    "CourtPreference": _case(_O, 4, "0", "1", "2", "NULL"),
    "Interpreter": _case(_O, 3, "1", "2", "0"),
    "LanguageId": "CAST(o_custkey % 7 AS INT)",
    "Sponsor_Name": "CASE WHEN o_custkey % 2 = 0 THEN 'Sponsor' || CAST(o_custkey AS STRING) END",
    "Sponsor_Forenames": "'Sam'",
    "Sponsor_Authorisation": "CASE WHEN o_custkey % 3 <> 2 THEN o_custkey % 3 = 1 END",
    "Sponsor_Address1": "CASE WHEN o_orderkey % 2 = 0 THEN '3 Park Lane' END",
    "Sponsor_Address2": "CASE WHEN o_orderkey % 3 = 0 THEN 'Mill Hill' END",
    "Sponsor_Address3": "'Derby'",
    "Sponsor_Address4": "CASE WHEN o_orderkey % 5 = 0 THEN 'Derbyshire' END",
    "Sponsor_Address5": "CAST(NULL AS STRING)",
    "Sponsor_Postcode": "'DE1 2AB'",
    "Sponsor_Email": "'sam' || CAST(o_custkey AS STRING) || ' @home.example;'",
    "Sponsor_Telephone": "'0044 (0)7' || lpad(CAST(o_custkey AS STRING), 9, '1')",
}

PEOPLE = {
    "CaseNo": case_no(_O),
    "Relationship": "CAST(NULL AS STRING)",
    "Appellant_Name": "c_name",
    "Appellant_Forenames": "lower(c_mktsegment)",
    "BirthDate": "o_orderdate - " + _case(_O, 2, "INTERVAL '17' YEAR", "INTERVAL '30' YEAR"),
    "Detained": "CAST(o_custkey % 6 AS INT)",
    "AppellantCountryId": _case(_O, 5, "0", "188", "7", "NULL", "0"),
    "lu_countryGovUkOocAdminJ": "CASE WHEN o_orderkey % 5 = 2 THEN 'KE' END",
    "NationalityId": "CASE WHEN o_custkey % 20 = 0 THEN 211 ELSE 5 END",
    "Appellant_Address1": "CASE WHEN o_orderkey % 7 <> 0 THEN '9 Hill Street' END",
    "Appellant_Address2": "CASE WHEN o_orderkey % 2 = 0 THEN '9 Hill Street' WHEN o_orderkey % 3 = 0 THEN 'Upper Town' END",
    "Appellant_Address3": "CASE WHEN o_orderkey % 4 = 1 THEN 'Nairobi' END",
    "Appellant_Address4": "CASE WHEN o_orderkey % 6 = 1 THEN 'Kenya.' END",
    "Appellant_Address5": "CASE WHEN o_orderkey % 12 = 1 THEN 'United Kingdom' END",
    "Appellant_Postcode": _case(_O, 6, "'G1 1AA'", "'ZZ99'", "NULL", "'cf10 1ep'", "NULL", "'12345'"),
    "Appellant_Email": "CASE WHEN o_custkey % 4 <> 0 THEN '*' || lower(c_mktsegment) || ' @mail.example.' END",
    "Appellant_Telephone": "CASE WHEN o_custkey % 2 = 0 THEN '07' || lpad(CAST(o_custkey AS STRING), 9, '2') ELSE '020 7946 0000' END",
    "FCONumber": "CASE WHEN o_orderkey % 10 = 3 THEN 'GWF' || CAST(o_custkey AS STRING) END",
    "PrisonRef": "CASE WHEN o_orderkey % 2 = 0 THEN 'A' || CAST(o_custkey AS STRING) END",
    "RemovalDate": "CASE WHEN o_orderkey % 15 = 0 THEN o_orderdate END",
    "DeportationDate": "CASE WHEN o_orderkey % 25 = 0 THEN o_orderdate END",
}

_Q = "CAST(l_quantity AS INT)"
# Unique per case: part, line and day.
_LINE_ID = "(l_partkey * 10 + l_linenumber) * 10000 + (year(l_shipdate) - 1990) * 400 + month(l_shipdate) * 31 + day(l_shipdate)"

STATUSES = {
    "CaseNo": case_no("l_orderkey"),
    "StatusId": _LINE_ID,
    "CaseStatus": "CASE l_linenumber WHEN 1 THEN 10 WHEN 2 THEN 26 WHEN 3 THEN 37 WHEN 4 THEN 38 WHEN 5 THEN 39 WHEN 6 THEN 46 ELSE "
    "CASE WHEN l_returnflag = 'R' THEN 50 WHEN l_returnflag = 'A' THEN 52 WHEN l_linestatus = 'F' THEN 43 ELSE 51 END END",
    "Outcome": "CASE l_linenumber "
    f"WHEN 1 THEN {_case(_Q, 5, '0', '109', '80', '105', '121')} WHEN 2 THEN {_case(_Q, 6, '0', '40', '1', '80', '27', '13')} "
    f"WHEN 3 THEN {_case(_Q, 6, '0', '1', '2', '39', '125', 'NULL')} WHEN 4 THEN {_case(_Q, 5, '0', '2', '1', '72', '40')} "
    f"WHEN 5 THEN {_case(_Q, 6, '0', '30', '31', '86', '25', '14')} WHEN 6 THEN {_case(_Q, 3, '1', '31', '86')} "
    f"ELSE {_case(_Q, 3, '0', '86', '91')} END",
    "KeyDate": "CASE WHEN l_partkey % 3 <> 0 THEN l_shipdate END",
    "DecisionReserved": "CAST(l_suppkey % 2 AS INT)",
    "AdjudicatorId": "CAST(l_suppkey % 3 AS INT)",
    "DecisionDate": "CASE WHEN l_partkey % 5 <> 0 THEN l_shipdate END",
    "DateReceived": "l_shipdate",
    "HearingCentre": _case("l_suppkey", 3, "'Taylor House'", "'Bradford'", "NULL"),
    "HearingDate": "CASE WHEN l_suppkey % 4 <> 0 THEN l_shipdate END",
    "StartTime": "CASE WHEN l_suppkey % 2 = 0 THEN l_shipdate + INTERVAL '10' HOUR END",
    "HearingType": "'Substantive'",
    "CourtName": "CASE WHEN l_partkey % 2 = 0 THEN 'Court ' || CAST(l_suppkey AS STRING) END",
    "ListType": "'Standard'",
    "ListTypeId": "CAST(l_partkey % 6 AS INT)",
    "TimeEstimate": f"CASE WHEN l_partkey % 8 <> 0 THEN {_Q} * 7 END",
    "HearingDuration": f"CASE WHEN l_partkey % 8 <> 1 THEN {_Q} * 5 END",
    "Notes": "CASE WHEN l_partkey % 4 = 0 THEN 'Note ' || CAST(l_partkey AS STRING) END",
    "Party": _case("l_suppkey", 3, "1", "2", "NULL"),
    "OutOfTime": "CAST(l_partkey % 2 AS INT)",
    "AdditionalLanguageId": "CAST(l_partkey % 7 AS INT)",
    "Judge1FT_Surname": "CASE WHEN l_partkey % 2 = 0 THEN 'Stone' END",
    "Judge1FT_Forenames": "'Ada'",
    "Judge1FT_Title": "CASE WHEN l_partkey % 4 = 0 THEN 'Ms' END",
    "Judge2FT_Surname": "CASE WHEN l_partkey % 3 = 0 THEN 'Reed' END",
    "Judge2FT_Forenames": "'Ben'",
    "Judge2FT_Title": "'Mr'",
    "Judge3FT_Surname": "CAST(NULL AS STRING)",
    "Judge3FT_Forenames": "CAST(NULL AS STRING)",
    "Judge3FT_Title": "CAST(NULL AS STRING)",
    "CourtClerk_Surname": _case("l_suppkey", 3, "'Clark'", "''", "NULL"),
    "CourtClerk_Forenames": "'Cy'",
    "CourtClerk_Title": "CASE WHEN l_suppkey % 2 = 0 THEN 'Dr' END",
    "Adj_Determination_Surname": "'Judge' || CAST(l_suppkey AS STRING)",
    "Adj_Determination_Forenames": "'Jo'",
    "Adj_Determination_Title": "'Mx'",
    "Adj_Surname": "'Alloc' || CAST(l_suppkey AS STRING)",
    "Adj_Forenames": "'Al'",
    "Adj_Title": "'Sir'",
}

_TYPE = "CASE l_linenumber WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 6 WHEN 4 THEN 19 WHEN 5 THEN 1 WHEN 6 THEN 17 ELSE 2 END"

TRANSACTIONS = {
    "CaseNo": case_no("l_orderkey"),
    "TransactionId": "l_orderkey * 10 + l_linenumber",
    "TransactionTypeId": _TYPE,
    "Amount": "CAST(CASE WHEN l_linenumber IN (1, 2) THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2))",
    "ReferringTransactionId": "CASE WHEN l_linenumber IN (3, 4, 7) THEN l_orderkey * 10 + l_linenumber - 2 END",
    "Status": "CAST(l_suppkey % 4 AS INT)",
    "SumBalance": "l_linenumber <> 6",
    "SumTotalPay": "l_linenumber IN (1, 5)",
    "SumTotalFee": "l_linenumber IN (4, 5, 6)",
}

CATEGORIES = {
    "CaseNo": case_no("l_orderkey"),
    "CategoryId": _case("l_partkey", 16, "7", "41", "8", "24", "25", "9", "17", "37", "38", "37", "38", "0", "19", "31", "50", "51"),
}

JUDGES = {
    "CaseNo": case_no("l_orderkey"),
    "Judge_Surname": "'Bench' || CAST(l_suppkey % 9 AS STRING)",
    "Judge_Forenames": "'Kim'",
    "Judge_Title": "CASE WHEN l_suppkey % 4 <> 0 THEN 'Mr' END",
    "Required": "CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey % 2 = 0 END",
}

HISTORY = {
    "CaseNo": case_no("l_orderkey"),
    "HistoryId": _LINE_ID,
    "HistType": "CASE WHEN l_linenumber <= 5 THEN 6 ELSE 1 END",
    "Comment": _case(
        "l_suppkey", 6, "'Place1, shelf 2'", "'Loughborough, room 3'", "'Castle Park Storage, A'", "'Place3'", "'Field House'", "'UT (IAC) Cardiff'"
    ),
}

REFERENCES = {
    "CaseNo": case_no(_O),
    "CleanHORef": "CASE WHEN o_orderkey % 17 = 0 THEN 'GWF' || CAST(o_custkey AS STRING) END",
    "CleanFCONumber": "CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_custkey AS STRING) END",
}

DOCUMENTS = {
    "CaseNo": case_no(_O),
    # Every fourth case has a row that names no document.
    "ReceivedDocumentId": f"CASE WHEN o_orderkey % 4 <> 1 THEN {_case('o_custkey', 5, '1', '2', '3', '3', '3')} END",
    "DateReceived": "CASE WHEN o_orderkey % 4 <> 1 AND o_custkey % 5 <> 4 THEN o_orderdate END",
}

# Some files are in no department.
LOCATIONS = {"CaseNo": case_no(_O), "DeptId": "CASE WHEN o_orderkey % 23 <> 0 THEN CAST(515 + o_custkey % 8 AS INT) END"}

REPRESENTATIVES = {
    "CaseNo": case_no(_O),
    "RepresentativeId": _case("o_custkey", 4, "957", "12", "NULL", "13"),
    "Name": _case("o_custkey", 7, "'Acme LLP'", "'no rep'", "'-'", "NULL", "'Smith'", "'his sponsor'", "'NO REP LISTED'"),
}

# name -> (columns, given tables, join)
DERIVED = {
    "header": (HEADER, ["orders", "customer"], "o_custkey = c_custkey"),
    "people": (PEOPLE, ["orders", "customer"], "o_custkey = c_custkey"),
    "statuses": (STATUSES, ["lineitem"], None),
    "transactions": (TRANSACTIONS, ["lineitem"], None),
    "categories": (CATEGORIES, ["lineitem"], None),
    "judges": (JUDGES, ["lineitem"], None),
    "history": (HISTORY, ["lineitem"], None),
    "refs": (REFERENCES, ["orders"], None),
    "documents_received": (DOCUMENTS, ["orders"], None),
    "locations": (LOCATIONS, ["orders"], None),
    "representatives": (REPRESENTATIVES, ["orders"], None),
}

# Lookups: rows of fixed values.
CENTRES = [
    (0, "Place1", None, "bradford", "Bradford", "698118", "Bradford Tribunal Hearing Centre", "bradford"),
    (1, "Place2", "NO MAPPING REQUIRED", "newcastle", "Newcastle", "366796", None, "newcastle"),
    (13, "Place3", "by history", "taylorHouse", "Taylor House", "765324", "Taylor House Tribunal Hearing Centre", "taylorHouse"),
    (2, None, None, "glasgow", "Glasgow", "366559", "Atlantic Quay - Glasgow", None),
]
CENTRE_COLUMNS = (
    "CentreId int, prevFileLocation string, Conditions string, hearingCentre string, staffLocation string, locationCode string, "
    "locationLabel string, applicationChangeDesignatedHearingCentre string"
)
AREA_CENTRES = [
    ("bradford", "Bradford", "698118", "Bradford Tribunal Hearing Centre", "bradford"),
    ("manchester", "Manchester", "512401", "Manchester Tribunal Hearing Centre - Piccadilly Exchange", "manchester"),
    ("newport", "Newport", "227101", "Newport Tribunal Centre - Columbus House", "newport"),
    ("taylorHouse", "Taylor House", "765324", "Taylor House Tribunal Hearing Centre", "taylorHouse"),
    ("newcastle", "Newcastle", None, "Newcastle Civil And Family Courts And Tribunals Centre", "newcastle"),
    ("birmingham", "Birmingham", "231596", "Birmingham Civil And Family Justice Centre", "birmingham"),
    ("hattonCross", "Hatton Cross", "386417", "Hatton Cross Tribunal Hearing Centre", "hattonCross"),
]
AREA_CENTRE_COLUMNS = "hearingCentre string, staffLocation string, locationCode string, locationLabel string, applicationChangeDesignatedHearingCentre string"
DETENTION_CENTRES = [
    (0, "harmondsworth", "North House", "1 Lane, West Town", "UB7 0HB"),
    (1, "yarlsWood", "South House", None, "MK44 1FD"),
    (2, None, None, "3 Road, East Town", None),
]
DETENTION_COLUMNS = (
    "DetentionCentreId int, applicationChangeDesignatedHearingCentre string, detentionBuilding string, detentionAddressLines string, detentionPostcode string"
)
LANGUAGES = [
    (1, "spokenLanguageInterpreter", "fra", "French", None, None), (2, "spokenLanguageInterpreter", "deu", "German", None, None),
    (3, "signLanguageInterpreter", "bfi", "British Sign", None, None), (4, "spokenLanguageInterpreter", None, None, "Yes", "Dialect"),
    (5, "signLanguageInterpreter", None, None, "Yes", "Home signs"), (6, "signLanguageInterpreter", "sgn", "Makaton", None, None),
]
LANGUAGE_COLUMNS = "LanguageId int, category string, languageCode string, languageLabel string, manualEntry string, manualEntryDescription string"
LISTING_LOCATIONS = [("Taylor House", "765324", "Taylor House Tribunal Hearing Centre", "taylorHouse", "88 Rosebery Avenue"), ("Bradford", "698118", "Bradford Tribunal Hearing Centre", "bradford", "Phoenix House")]
LISTING_COLUMNS = "ListedCentre string, locationCode string, locationLabel string, listCaseHearingCentre string, listCaseHearingCentreAddress string"
REMISSIONS = [
    (0, 0, "noRemission", "OMIT", "OMIT", "OMIT", "OMIT", "OMIT", "OMIT"),
    (1, 1, "hoWaiverRemission", "asylumSupport", "Asylum Support", "OMIT", "OMIT", "M1.ASFReferenceNo ELSE IF NULL 'Unknown'", "OMIT"),
    (1, 2, "hoWaiverRemission", "legalAid", "Legal Aid", "OMIT", "M1.LSCReference; ELSE IF NULL 'Unknown'", "OMIT", "NO MAPPING REQUIRED"),
    (1, 3, "helpWithFees", "OMIT", "NO MAPPING REQUIRED", "This is a migrated case.", "OMIT", "OMIT", "M1.PaymentRemissionReasonNote; ELSE IF NULL 'Unknown'"),
]
REMISSION_COLUMNS = (
    "PaymentRemissionRequested int, PaymentRemissionReason int, remissionType string, remissionClaim string, feeRemissionType string, "
    "exceptionalCircumstances string, legalAidAccountNumber string, asylumSupportReference string, helpWithFeesReferenceNumber string"
)
END_STATES = [
    (37, 80, "Abandoned", "First Tier - Hearing | Abandoned", "listing"), (10, 80, "Abandoned", "Preliminary Issue | Abandoned", "appealSubmitted"),
    (38, 72, "Struck Out", "First Tier - Paper | Struck Out", "prepareForHearing"), (46, 31, "No Valid Appeal", "Set Aside | Refused", "decided"),
    (52, 91, "Withdrawn", "Case closed fee outstanding", "appealSubmitted"), (39, 25, "Withdrawn", "First Tier Permission | Withdrawn", "ftpaSubmitted"),
]
END_COLUMNS = "CaseStatus int, Outcome int, endAppealOutcome string, endAppealOutcomeReason string, stateBeforeEndAppeal string"

LOOKUPS = {
    "centres": (CENTRES, CENTRE_COLUMNS),
    "area_centres": (AREA_CENTRES, AREA_CENTRE_COLUMNS),
    "detention_centres": (DETENTION_CENTRES, DETENTION_COLUMNS),
    "languages": (LANGUAGES, LANGUAGE_COLUMNS),
    "listing_locations": (LISTING_LOCATIONS, LISTING_COLUMNS),
    "remissions": (REMISSIONS, REMISSION_COLUMNS),
    "end_states": (END_STATES, END_COLUMNS),
}


def derive(spark: SparkSession, sf: str, name: str) -> DataFrame:
    columns, sources, on = DERIVED[name]
    df = table(spark, sf, sources[0])
    for other in sources[1:]:
        df = df.join(table(spark, sf, other), F.expr(on))
    return df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def lookup(spark: SparkSession, name: str) -> DataFrame:
    """A lookup of fixed rows. Their size is not known to the planner, which without a hint shuffles whole cases by the few keys of a lookup."""
    rows, columns = LOOKUPS[name]
    return F.broadcast(spark.createDataFrame(rows, columns))


def case_tables(spark: SparkSession, sf: str, *names: str) -> CaseTables:
    """The header and the derived tables a query needs."""
    return CaseTables(derive(spark, sf, "header"), **{("references" if n == "refs" else n): derive(spark, sf, n) for n in names})


def _literal(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def ctes(*names: str) -> str:
    """The same tables as a WITH clause."""
    parts = []
    for name in names:
        if name in LOOKUPS:
            rows, columns = LOOKUPS[name]
            heads = ", ".join(c.split()[0] for c in columns.split(","))
            parts.append(f"{name}({heads}) AS (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)})")
            continue
        columns, sources, on = DERIVED[name]
        source = sources[0] if on is None else f"{sources[0]} JOIN {sources[1]} ON {on}"
        picked = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        parts.append(f"{name} AS (SELECT {picked} FROM {source})")
    return "WITH " + ",\n".join(parts)
