"""Case states, content fields and payloads on the derived case tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.cases import dependencies, fields, states
from docketry.cases.base import ENDED, KEY, case_base, pair
from docketry.cases.rules import DEPENDENCIES
from docketry.operators.resolve import named_columns
from docketry.plans import case_oracles
from docketry.plans.casework_tables import case_tables, ctes, derive, lookup
from docketry.plans.registry import query

SYSTEM = "LEGACY"
AS_OF = "1998-12-01"
NAMES = ["Kenya", "Spain", "Yorkshire", "England"]


def _last(where: str, name: str = "m3") -> str:
    """The latest status row under a condition."""
    return f"{name} AS (SELECT * FROM statuses WHERE {where} QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY StatusId DESC) = 1)"


_OK = "(dv_representation IN ('LR', 'AIP') AND lu_appealType IS NOT NULL)"
_CATS = "cats AS (SELECT CaseNo, list(DISTINCT CategoryId) AS ids FROM categories GROUP BY 1)"


def _has(category: int) -> str:
    return f"coalesce(list_contains(ids, {category}), false)"


def _any(*ids: int) -> str:
    return f"coalesce(list_has_any(ids, [{', '.join(map(str, ids))}]), false)"


def _d(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


# ---------------------------------------------------------------- states

_PICK = {
    "t": "Outcome NOT IN (38, 111) AND CaseStatus NOT IN (17)",
    "st": "CaseStatus IS NULL OR CaseStatus NOT IN (50, 52, 36)",
    "us": "CaseStatus IN (40, 41, 42, 43, 44, 45, 53, 27, 28, 29, 34, 32, 33)",
    "sa": "CaseStatus IS NULL OR CaseStatus <> 46",
}
_REPRESENTED = """represented AS (SELECT CaseNo, CASE WHEN RepresentativeId = 957 OR RepresentativeId IS NULL
   OR coalesce(Name IN ('no rep', '-', 'his sponsor', 'NO REP LISTED'), false) THEN 'AIP' ELSE 'LR' END AS Representation FROM representatives)"""
_BALANCE = """bd AS (SELECT CaseNo, sum(Amount) AS balance FROM transactions WHERE SumBalance AND TransactionId NOT IN
   (SELECT ReferringTransactionId FROM transactions WHERE TransactionTypeId IN (6, 19) AND ReferringTransactionId IS NOT NULL) GROUP BY 1)"""
_SEGMENT_SQL = (
    ctes("header", "statuses", "transactions", "documents_received", "locations", "representatives")
    + f", {_REPRESENTED}, {_BALANCE}, {case_oracles.CODES}, "
    + ", ".join(_last(w, n) for n, w in _PICK.items())
    + f""", dr AS (SELECT * FROM documents_received)
       SELECT ac.CaseNo, {case_oracles.STATE} AS TargetState, {case_oracles.segment(AS_OF, 'Live')} AS HighLevelSegment
       FROM header ac LEFT JOIN t ON t.CaseNo = ac.CaseNo LEFT JOIN st ON st.CaseNo = ac.CaseNo LEFT JOIN us ON us.CaseNo = ac.CaseNo
       LEFT JOIN sa ON sa.CaseNo = ac.CaseNo {case_oracles.JOIN_CODES} LEFT JOIN dr ON dr.CaseNo = ac.CaseNo LEFT JOIN bd ON bd.CaseNo = ac.CaseNo
       LEFT JOIN represented r ON r.CaseNo = ac.CaseNo
       JOIN locations fl ON fl.CaseNo = ac.CaseNo
       WHERE ac.CaseType = 1 AND fl.DeptId NOT IN (519, 520)"""
)


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return states.segmentation(
        case_tables(spark, sf, "statuses", "transactions"),
        derive(spark, sf, "documents_received"),
        derive(spark, sf, "locations"),
        states.representation(derive(spark, sf, "representatives")),
        AS_OF,
    )


@query("case_segmentation", _SEGMENT_SQL)
def case_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(spark, sf)


@query(
    "case_live_states",
    f"SELECT TargetState, count(*) AS n FROM ({_SEGMENT_SQL}) WHERE HighLevelSegment = 'Live' GROUP BY 1",
)
def case_live_states(spark: SparkSession, sf: str) -> DataFrame:
    return states.live_cases(_segments(spark, sf)).groupBy("TargetState").agg(F.count(F.lit(1)).alias("n"))


@query(
    "case_representation",
    ctes("representatives") + f", {_REPRESENTED} SELECT * FROM represented",
)
def case_representation(spark: SparkSession, sf: str) -> DataFrame:
    return states.representation(derive(spark, sf, "representatives"))


# ---------------------------------------------------------------- header content


@query(
    "case_appeal_type",
    ctes("header")
    + f""" SELECT CaseNo, CASE WHEN {_OK} THEN lu_appealType END AS appealType, CASE WHEN {_OK} THEN CaseNo END AS appealReferenceNumber,
       CASE WHEN {_OK} AND dv_representation = 'AIP' THEN 'Yes' END AS isAppealReferenceNumberAvailable FROM header""",
)
def case_appeal_type(spark: SparkSession, sf: str) -> DataFrame:
    return fields.content(derive(spark, sf, "header"), fields.appeal_type())


@query(
    "case_data",
    ctes("header", "statuses")
    + ", "
    + _last("Outcome IS NOT NULL")
    + f""" SELECT h.CaseNo, CASE WHEN NOT {_OK} THEN NULL WHEN dv_representation = 'LR' THEN 'No' ELSE 'Yes' END AS appellantsRepresentation,
       CASE WHEN {_OK} THEN CASE WHEN OutOfTimeIssue THEN 'Yes' ELSE 'No' END END AS submissionOutOfTime,
       CASE WHEN {_OK} AND OutOfTimeIssue THEN 'This is a migrated {SYSTEM} case. Please refer to the documents.' END AS applicationOutOfTimeExplanation,
       CASE WHEN {_OK} AND dv_representation = 'LR' THEN 'This is an {SYSTEM} Migrated Case.' END AS appealWasNotSubmittedReason,
       CASE WHEN {_OK} THEN {_d('DateLodged')} END AS appealSubmissionDate, CASE WHEN {_OK} THEN {_d('DateAppealReceived')} END AS tribunalReceivedDate,
       CASE WHEN {_OK} THEN 'NotSure' END AS hasOtherAppeals,
       CASE WHEN NOT OutOfTimeIssue THEN NULL WHEN dv_TargetState NOT IN ('paymentPending', 'appealSubmitted') THEN 'Yes'
            WHEN m3.Outcome IS NOT NULL AND m3.Outcome <> 0 THEN 'Yes' ELSE 'No' END AS recordedOutOfTimeDecision,
       CASE WHEN OutOfTimeIssue AND m3.Outcome <> 0 THEN 'approved' END AS outOfTimeDecisionType,
       CASE WHEN OutOfTimeIssue AND m3.Outcome <> 0 THEN 'Tribunal Caseworker' END AS outOfTimeDecisionMaker
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo""",
)
def case_data(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "statuses"), {"with_outcome": ["Outcome"]})
    return fields.content(base, fields.case_data(SYSTEM))


# Written out again here, so that a wrong area in the library shows.
_AREA_SQL = """CASE
    WHEN substr(pc, 1, 2) IN ('BD', 'DN', 'HD', 'HG', 'HU', 'HX', 'LS', 'WF', 'YO') THEN 'bradford'
    WHEN substr(pc, 1, 2) IN ('BB', 'BL', 'CH', 'CW', 'FY', 'LL', 'ST', 'LA', 'OL', 'PR', 'SK', 'WA', 'WN') THEN 'manchester'
    WHEN substr(pc, 1, 2) IN ('BA', 'BS', 'CF', 'DT', 'EX', 'HR', 'LD', 'NP', 'PL', 'SA', 'SN', 'SP', 'TA', 'TQ', 'TR') THEN 'newport'
    WHEN substr(pc, 1, 2) IN ('AL', 'BN', 'BR', 'CB', 'CM', 'CO', 'CR', 'CT', 'DA', 'EC', 'EN', 'IG', 'IP', 'ME', 'NR',
         'NW', 'RH', 'RM', 'SE', 'SG', 'SS', 'TN', 'WC') THEN 'taylorHouse'
    WHEN substr(pc, 1, 2) IN ('CA', 'DH', 'DL', 'NE', 'SR', 'TS') THEN 'newcastle'
    WHEN substr(pc, 1, 2) IN ('CV', 'DE', 'DY', 'GL', 'HP', 'LE', 'LN', 'LU', 'MK', 'NG', 'NN', 'OX', 'PE', 'RG', 'SY',
         'TF', 'WD', 'WR', 'WS', 'WV') THEN 'birmingham'
    WHEN substr(pc, 1, 2) IN ('BH', 'GU', 'HA', 'KT', 'PO', 'SL', 'SM', 'SO', 'SW', 'TW', 'UB') THEN 'hattonCross'
    WHEN substr(pc, 1, 2) IN ('AB', 'DD', 'DG', 'EH', 'FK', 'HS', 'IV', 'KA', 'KW', 'KY', 'ML', 'PA', 'PH', 'TD', 'ZE', 'BT') THEN 'glasgow'
    WHEN substr(pc, 1, 1) IN ('S') THEN 'bradford'
    WHEN substr(pc, 1, 1) IN ('L', 'M') THEN 'manchester'
    WHEN substr(pc, 1, 1) IN ('E', 'N', 'W') THEN 'taylorHouse'
    WHEN substr(pc, 1, 1) IN ('B') THEN 'birmingham'
    WHEN substr(pc, 1, 1) IN ('G') THEN 'glasgow'
    ELSE 'newport' END"""


@query(
    "case_hearing_centre",
    ctes("header", "people", "history", "centres")
    + f""", h AS (SELECT CaseNo, split_part(Comment, ',', 1) AS prev FROM history WHERE HistType = 6 AND Comment NOT LIKE '%Castle Park Storage%'
              AND Comment NOT LIKE '%Field House%' AND Comment NOT LIKE '%UT (IAC)%'
              QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY HistoryId DESC) = 1),
       x AS (SELECT header.CaseNo, a.CentreId AS aid, a.Conditions, a.hearingCentre AS a_centre, a.staffLocation AS a_staff,
                    b.hearingCentre AS b_centre, b.staffLocation AS b_staff, CASE WHEN header.CentreId IN (77,476,101,55,296,13,79,522,406,517,37) THEN prev END AS prev,
                    upper(replace(coalesce(Rep_Postcode, CaseRep_Postcode, Appellant_Postcode), ' ', '')) AS pc
             FROM header LEFT JOIN people USING (CaseNo) LEFT JOIN h USING (CaseNo) LEFT JOIN centres a ON a.CentreId = header.CentreId
             LEFT JOIN centres b ON b.prevFileLocation = CASE WHEN header.CentreId IN (77,476,101,55,296,13,79,522,406,517,37) THEN prev END)
       SELECT CaseNo,
         CASE WHEN Conditions IS NULL OR Conditions = 'NO MAPPING REQUIRED' THEN a_centre
              WHEN prev IS NULL OR prev IN ('Loughborough') THEN {_AREA_SQL} ELSE b_centre END AS hearingCentre,
         CASE WHEN Conditions IS NULL OR Conditions = 'NO MAPPING REQUIRED' THEN a_staff
              WHEN prev IS NULL OR prev IN ('Loughborough') THEN NULL ELSE b_staff END AS staffLocation
       FROM x""",
)
def case_hearing_centre(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "people", "history"))
    placed = fields.hearing_centre(base, lookup(spark, "centres"), ["hearingCentre", "staffLocation"])
    return placed.select(KEY, "hearingCentre", "staffLocation")


_PREV = "CASE WHEN header.CentreId IN (77,476,101,55,296,13,79,522,406,517,37) THEN prev END"


@query(
    "case_general",
    ctes("header", "people", "history", "centres", "area_centres", "detention_centres")
    + f""", h AS (SELECT CaseNo, split_part(Comment, ',', 1) AS prev FROM history WHERE HistType = 6 AND Comment NOT LIKE '%Castle Park Storage%'
              AND Comment NOT LIKE '%Field House%' AND Comment NOT LIKE '%UT (IAC)%'
              QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY HistoryId DESC) = 1),
       x AS (SELECT header.CaseNo, dv_representation, lu_appealType, Detained, DetentionCentreId, a.Conditions IS NULL OR a.Conditions = 'NO MAPPING REQUIRED' AS direct,
                    a, b, {_PREV} AS prev, upper(replace(coalesce(Rep_Postcode, CaseRep_Postcode, Appellant_Postcode), ' ', '')) AS pc
             FROM header LEFT JOIN people USING (CaseNo) LEFT JOIN h USING (CaseNo) LEFT JOIN centres a ON a.CentreId = header.CentreId
             LEFT JOIN centres b ON b.prevFileLocation = {_PREV}),
       y AS (SELECT x.*, prev IS NULL OR prev = 'Loughborough' AS unknown, {_AREA_SQL} AS area FROM x),
       z AS (SELECT y.*, c, d.applicationChangeDesignatedHearingCentre AS held, d.detentionBuilding AS building, d.detentionAddressLines AS lines,
                    d.detentionPostcode AS code FROM y LEFT JOIN area_centres c ON c.hearingCentre = area
             LEFT JOIN detention_centres d USING (DetentionCentreId)),
       w AS (SELECT z.*, {_OK} AS ok, CASE WHEN direct THEN a.hearingCentre WHEN unknown THEN area ELSE b.hearingCentre END AS centre,
               CASE WHEN direct THEN a.staffLocation WHEN unknown THEN c.staffLocation ELSE b.staffLocation END AS staff,
               CASE WHEN direct THEN a.locationCode WHEN unknown THEN c.locationCode ELSE b.locationCode END AS code0,
               CASE WHEN direct THEN a.locationLabel WHEN unknown THEN c.locationLabel ELSE b.locationLabel END AS label0,
               CASE WHEN direct THEN a.applicationChangeDesignatedHearingCentre WHEN unknown THEN c.applicationChangeDesignatedHearingCentre
                    ELSE b.applicationChangeDesignatedHearingCentre END AS des
             FROM z)
       SELECT CaseNo, CASE WHEN ok THEN centre END AS hearingCentre, CASE WHEN ok THEN staff END AS staffLocation, CASE WHEN ok THEN label0 END AS selected,
         CASE WHEN ok AND code0 IS NOT NULL AND label0 IS NOT NULL THEN code0 || ' ' || label0 || ' of 10 first 227101' END AS list,
         CASE WHEN ok AND code0 IS NOT NULL AND label0 IS NOT NULL THEN '1 ' || code0 END AS managed,
         CASE WHEN ok THEN des END AS designated, CASE WHEN Detained IN (1, 2) THEN held WHEN ok THEN des END AS designated_held,
         CASE WHEN Detained IN (1, 2) THEN building END AS detentionBuilding, CASE WHEN Detained IN (1, 2) THEN lines END AS detentionAddressLines,
         CASE WHEN Detained IN (1, 2) THEN code END AS detentionPostcode
       FROM w""",
)
def case_general(spark: SparkSession, sf: str) -> DataFrame:
    """The centre fields of a case, with and without the place of detention."""
    base = case_base(case_tables(spark, sf, "people", "history"))
    base = fields.with_centres(base, lookup(spark, "centres"), lookup(spark, "area_centres"), lookup(spark, "detention_centres"))
    made = base.select(
        KEY,
        *[c.alias(n) for n, c in {**fields.general(), **fields.detention_place()}.items()],
        fields.general(detained_counts=True)["applicationChangeDesignatedHearingCentre"].alias("designated_held"),
    )
    choices = F.col("hearingCentreDynamicList.list_items")
    shown = F.concat_ws(" ", "hearingCentreDynamicList.value.code", "hearingCentreDynamicList.value.label", F.lit("of"), F.size(choices).cast("string"), F.lit("first"), choices[0]["code"])
    return made.select(
        KEY, "hearingCentre", "staffLocation", F.col("selectedHearingCentreRefData").alias("selected"),
        F.when(F.col("hearingCentreDynamicList").isNotNull(), shown).alias("list"),
        F.when(
            F.col("caseManagementLocationRefData").isNotNull(),
            F.concat_ws(" ", "caseManagementLocationRefData.region", "caseManagementLocationRefData.baseLocation.value.code"),
        ).alias("managed"),
        F.col("applicationChangeDesignatedHearingCentre").alias("designated"), "designated_held", *fields.DETENTION_PLACE,
    )


@query(
    "case_flags",
    ctes("header", "people", "categories")
    + f""", {_CATS} SELECT h.CaseNo,
       CASE WHEN {_OK} THEN nullif(concat_ws(',',
         CASE WHEN HOANRef IS NOT NULL OR {_any(41, 31, 32, 8, 24)} THEN 'OT0001:' || CASE WHEN HOANRef IS NOT NULL THEN 'Dropped Case'
              WHEN {_has(8)} THEN 'Reclassified RFT' WHEN {_has(24)} THEN 'EEA Family Permit' ELSE 'Expedite' END END,
         CASE WHEN {_has(7)} THEN 'CF0007' END, CASE WHEN {_has(25)} THEN 'CF0012' END), '') END AS case_flags,
       CASE WHEN {_OK} THEN nullif(concat_ws(',', CASE WHEN {_any(17, 29, 30, 39, 40, 48, 19)} THEN 'PF0012' END,
         CASE WHEN {_has(9)} THEN 'PF0013' END, CASE WHEN Detained IN (1, 2, 4) THEN 'PF0019' END), '') END AS party_flags,
       CASE WHEN {_OK} AND ({_any(17, 29, 30, 39, 40, 48, 19)} OR {_has(9)} OR Detained IN (1, 2, 4)) THEN Appellant_Forenames || ' ' || Appellant_Name END AS party_name,
       CASE WHEN {_OK} THEN CASE WHEN CasePrefix = 'DA' THEN 'Yes' ELSE 'No' END END AS fee_exemption
       FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo)""",
)
def case_flags(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "people", "categories"))
    df = fields.content(base, fields.flags(SYSTEM, AS_OF))

    def codes(flags: Column) -> Column:
        return F.array_join(
            F.transform(flags, lambda f: F.concat_ws(":", f["value"]["flagCode"], f["value"]["flagComment"])), ","
        )

    return df.select(
        KEY, codes(F.col("caseFlags")).alias("case_flags"), codes(F.col("appellantLevelFlags.details")).alias("party_flags"),
        F.col("appellantLevelFlags.partyName").alias("party_name"), F.col("isLegacyMigratedFeeExemption").alias("fee_exemption"),
    )


# A postcode is valid when it has one of the valid forms the derived tables use.
def _uk(column: str, *valid: str) -> str:
    return f"coalesce({column} IN ({', '.join(repr(v) for v in valid)}), false)"


_REP_HOME = f"(RepresentativeId > 0 OR (RepresentativeId = 0 AND {_uk('CaseRep_Postcode', 'SW1A 1AA', 'm1 1aa')}))"
_LR = "(dv_representation = 'LR' AND lu_appealType IS NOT NULL)"


@query(
    "case_legal_rep",
    ctes("header")
    + f""" SELECT CaseNo, CASE WHEN {_LR} THEN coalesce(Contact, Rep_Name, CaseRep_Name) END AS legalRepGivenName,
       CASE WHEN {_LR} THEN coalesce(Rep_Name, CaseRep_Name) END AS legalRepFamilyNamePaperJ,
       CASE WHEN {_LR} THEN coalesce('Rep' || nullif(split_part(Rep_Name, ' ', 2), '') || '@law.example',
            'case' || split_part(split_part(CaseRep_Email, '@', 1), 'case', 2) || '@law.example', 'file@law.example') END AS legalRepEmail,
       CASE WHEN {_LR} THEN CASE WHEN {_REP_HOME} THEN 'Yes' ELSE 'No' END END AS legalRepHasAddress,
       CASE WHEN {_LR} AND NOT {_REP_HOME} THEN coalesce(CaseRep_Address1, CaseRep_Address2, CaseRep_Address3, CaseRep_Address4, CaseRep_Address5) END AS oocAddressLine1,
       CASE WHEN {_LR} AND NOT {_REP_HOME} THEN coalesce(CaseRep_Address2, CaseRep_Address3, CaseRep_Address4, CaseRep_Address5) END AS oocAddressLine2,
       CASE WHEN {_LR} AND NOT {_REP_HOME} THEN nullif(concat_ws(', ', trim(CaseRep_Address3), CaseRep_Address4), '') END AS oocAddressLine3,
       CASE WHEN {_LR} AND NOT {_REP_HOME} THEN nullif(concat_ws(', ', CaseRep_Address5, nullif(CaseRep_Postcode, '')), '') END AS oocAddressLine4,
       CASE WHEN {_LR} AND NOT {_REP_HOME} THEN CASE WHEN CaseRep_Address4 = 'Kenya' THEN 'Kenya' WHEN CaseRep_Address5 = 'Spain' THEN 'Spain' ELSE '' END END AS oocCountryName,
       CASE WHEN {_LR} AND {_REP_HOME} THEN CASE WHEN RepresentativeId = 0
            THEN CASE WHEN CaseRep_Address3 IS NULL AND CaseRep_Address4 IS NULL AND CaseRep_Address5 IS NULL THEN coalesce(CaseRep_Address2, CaseRep_Postcode, '')
                      ELSE coalesce(CaseRep_Address3, CaseRep_Address4, CaseRep_Address5, CaseRep_Postcode, '') END
            ELSE CASE WHEN Rep_Address3 IS NULL AND Rep_Address4 IS NULL AND Rep_Address5 IS NULL THEN Rep_Address2
                      ELSE coalesce(Rep_Address3, Rep_Address4, Rep_Address5, '') END END END AS post_town,
       CASE WHEN {_LR} AND {_REP_HOME} THEN CASE WHEN RepresentativeId = 0
            THEN CASE WHEN CaseRep_Address5 IS NULL THEN coalesce(CaseRep_Address4, '') ELSE CaseRep_Address5 END
            ELSE CASE WHEN Rep_Address5 IS NULL THEN coalesce(Rep_Address4, '') ELSE Rep_Address5 END END END AS country
       FROM header""",
)
def case_legal_rep(spark: SparkSession, sf: str) -> DataFrame:
    df = fields.content(fields.with_rep_place(derive(spark, sf, "header"), NAMES), fields.legal_rep(NAMES))
    return df.select(
        KEY, "legalRepGivenName", "legalRepFamilyNamePaperJ", "legalRepEmail", "legalRepHasAddress",
        *[f"oocAddressLine{i}" for i in range(1, 5)], "oocCountryName",
        F.col("legalRepAddressUK.PostTown").alias("post_town"), F.col("legalRepAddressUK.Country").alias("country"),
    )


def _placed(base: DataFrame) -> DataFrame:
    return fields.with_reference(fields.with_place(base))


_HOME_LINE = "coalesce(Appellant_Address5 = 'United Kingdom', false)"
_APP_UK = _uk("Appellant_Postcode", "G1 1AA", "cf10 1ep")
_IN_UK = f"(CASE WHEN {_has(37)} THEN true WHEN {_has(38)} THEN false ELSE coalesce(AppellantCountryId = 188, false) OR {_APP_UK} OR {_HOME_LINE} END)"
_IN_UK_HELD = f"(coalesce(Detained IN (1, 2, 4), false) OR {_IN_UK})"
_GWF = "(coalesce(lu_HORef LIKE '%GWF%', false) OR coalesce(HORef LIKE '%GWF%', false) OR coalesce(FCONumber LIKE '%GWF%', false))"
_BASE_JOIN = "FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo) LEFT JOIN (SELECT CaseNo, coalesce(CleanHORef, CleanFCONumber) AS lu_HORef FROM refs) USING (CaseNo)"
_LINE1 = "coalesce(Appellant_Address1, Appellant_Address2, Appellant_Address3, Appellant_Address4, Appellant_Address5, Appellant_Postcode)"
_LINES = "[x FOR x IN [Appellant_Address1, Appellant_Address2, Appellant_Address3, Appellant_Address4, Appellant_Address5, Appellant_Postcode] IF x IS NOT NULL]"
# In these tables only the first two lines can be equal, so the second line is the first later line that differs.
_LINE2 = f"(CASE WHEN len({_LINES}) >= 2 AND {_LINES}[2] <> {_LINES}[1] THEN {_LINES}[2] ELSE {_LINES}[3] END)"
_ABROAD = f"({_OK} AND {_has(38)})"


@query(
    "case_appellant",
    ctes("header", "people", "categories", "refs")
    + f""", {_CATS} SELECT h.CaseNo, CASE WHEN {_OK} THEN Appellant_Forenames || ' ' || Appellant_Name END AS name,
       CASE WHEN {_OK} THEN {_d('BirthDate')} END AS birth,
       CASE WHEN {_OK} THEN CASE WHEN date_diff('day', BirthDate, DateLodged) / 365.25 < 18 THEN 'Yes' ELSE 'No' END END AS minor,
       CASE WHEN {_OK} AND Appellant_Email IS NOT NULL THEN Appellant_Forenames || '@mail.example' END AS email,
       CASE WHEN {_OK} AND Appellant_Telephone LIKE '07_________' AND Appellant_Telephone SIMILAR TO '07[0-9]{{9}}' THEN Appellant_Telephone END AS mobile,
       CASE WHEN {_OK} THEN CASE WHEN {_IN_UK} THEN 'Yes' ELSE 'No' END END AS in_uk,
       CASE WHEN {_ABROAD} THEN CASE WHEN {_GWF} THEN 'entryClearanceDecision' ELSE 'none' END END AS ooc,
       CASE WHEN {_OK} AND {_has(37)} THEN 'Yes' END AS fixed,
       CASE WHEN {_OK} AND {_has(37)} AND {_LINE1} IS NOT NULL THEN coalesce(Appellant_Address3, '') || '|' || coalesce(Appellant_Postcode, '') END AS town,
       CASE WHEN {_ABROAD} THEN {_LINE1} END AS line1, CASE WHEN {_ABROAD} THEN {_LINE2} END AS line2,
       CASE WHEN {_ABROAD} THEN nullif(concat_ws(', ', Appellant_Address3, Appellant_Address4), '') END AS line3,
       CASE WHEN {_ABROAD} THEN nullif(concat_ws(',', Appellant_Address5, Appellant_Postcode), '') END AS line4,
       CASE WHEN {_ABROAD} THEN CASE WHEN lu_countryGovUkOocAdminJ IS NOT NULL THEN 'KE' WHEN AppellantCountryId = 0
            THEN CASE WHEN {_APP_UK} OR {_HOME_LINE} THEN 'GB' WHEN Appellant_Address4 = 'Kenya.' THEN 'Kenya' ELSE '' END END END AS country,
       CASE WHEN {_OK} THEN CASE WHEN NationalityId = 211 THEN 'isStateless' ELSE 'hasNationality' END END AS stateless,
       CASE WHEN {_OK} THEN CASE WHEN {_any(17, 19, 29, 30, 31, 32, 41, 48)} OR dv_appealTypeCode = 'DA' OR DeportationDate IS NOT NULL OR RemovalDate IS NOT NULL
            THEN 'Yes' ELSE 'No' END END AS deport
       {_BASE_JOIN}""",
)
def case_appellant(spark: SparkSession, sf: str) -> DataFrame:
    base = _placed(case_base(case_tables(spark, sf, "people", "categories", "refs")))
    df = fields.content(base, fields.appellant(NAMES))
    shown = {
        "name": "appellantNameForDisplay", "birth": "appellantDateOfBirth", "minor": "isAppellantMinor", "email": "internalAppellantEmail",
        "mobile": "internalAppellantMobileNumber", "in_uk": "appellantInUk", "ooc": "oocAppealAdminJ", "fixed": "appellantHasFixedAddress",
        "line1": "addressLine1AdminJ", "line2": "addressLine2AdminJ", "line3": "addressLine3AdminJ", "line4": "addressLine4AdminJ",
        "country": "countryGovUkOocAdminJ", "stateless": "appellantStateless", "deport": "deportationOrderOptions",
    }
    town = F.concat(F.col("appellantAddress.PostTown"), F.lit("|"), F.col("appellantAddress.PostCode"))
    return df.select(KEY, town.alias("town"), *[F.col(c).alias(n) for n, c in shown.items()])


def _clean(column: str) -> str:
    """What the written forms in these tables come out as."""
    return (
        f"CASE WHEN {column} IS NULL OR {column} = 'XXXX' THEN NULL WHEN {column} LIKE 'GWF%' THEN 'GWF' || lpad(substr({column}, 4), 9, '0') "
        f"ELSE lpad({column}, 9, '0') END"
    )


_CLEANED = f"coalesce({_clean('lu_HORef')}, {_clean('HORef')}, {_clean('FCONumber')})"
_FIRST_GWF = "coalesce(coalesce(lu_HORef, HORef, FCONumber) LIKE '%GWF%', false)"


def _home_office_sql(inside: str) -> str:
    return (
        ctes("header", "people", "categories", "refs")
        + f""", {_CATS}, x AS (SELECT h.CaseNo, {inside} AS inside, {_GWF} AS gwf, {_FIRST_GWF} AS first_gwf, {_CLEANED} AS clean,
              {_d('DateOfApplicationDecision')} AS decided, dv_appealTypeCode {_BASE_JOIN}),
           y AS (SELECT *, CASE WHEN inside OR NOT first_gwf THEN coalesce(clean, '999999999') END AS plain, CASE WHEN NOT inside AND gwf THEN clean END AS g FROM x)
           SELECT CaseNo, CASE WHEN inside THEN decided END AS homeOfficeDecisionDate,
             CASE WHEN NOT inside AND NOT first_gwf THEN decided END AS decisionLetterReceivedDate,
             CASE WHEN NOT inside AND gwf THEN decided END AS dateEntryClearanceDecision,
             CASE WHEN plain IS NULL AND g IS NULL THEN '999999999' ELSE plain END AS homeOfficeReferenceNumber, g AS gwfReferenceNumber,
             CASE WHEN dv_appealTypeCode IN ('RP', 'PA') THEN 'Yes' END AS isHomeOfficeIntegrationEnabled, 'Yes' AS homeOfficeNotificationsEligible
           FROM y"""
    )


@query("case_home_office", _home_office_sql(_IN_UK))
def case_home_office(spark: SparkSession, sf: str) -> DataFrame:
    base = _placed(case_base(case_tables(spark, sf, "people", "categories", "refs")))
    return fields.content(base, fields.home_office())


@query(
    "case_dq_enrich",
    ctes("header", "people", "categories")
    + f""", {_CATS} SELECT h.CaseNo, dv_representation, lu_appealType, OutOfTimeIssue, PaymentRemissionRequested, Interpreter, CourtPreference, InCamera,
       Sponsor_Name, Detained, {_IN_UK_HELD} AS dv_inCountryOrHeld, strftime(DateLodged, '%Y-%m-%d') AS lodged
       FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo)""",
)
def case_dq_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """The case columns that the rules of a state compare the content with."""
    base = fields.with_place(case_base(case_tables(spark, sf, "people", "categories")))
    return base.select(KEY, *[c for c in DEPENDENCIES if c not in ("DateLodged", "dv_reached")], F.date_format("DateLodged", "yyyy-MM-dd").alias("lodged"))


@query("case_home_office_detained", _home_office_sql(_IN_UK_HELD))
def case_home_office_detained(spark: SparkSession, sf: str) -> DataFrame:
    base = _placed(case_base(case_tables(spark, sf, "people", "categories", "refs")))
    return fields.content(base, fields.home_office(detained_counts=True))


# ---------------------------------------------------------------- money

_FEE = "coalesce(dv_appealTypeCode IN ('EA', 'EU', 'HU', 'PA'), false)"
_MONEY = """rev AS (SELECT DISTINCT ReferringTransactionId AS id FROM transactions WHERE TransactionTypeId IN (6, 19) AND ReferringTransactionId IS NOT NULL),
   rep AS (SELECT DISTINCT ReferringTransactionId AS id FROM transactions WHERE TransactionTypeId NOT IN (6, 19) AND ReferringTransactionId IS NOT NULL),
   bal AS (SELECT CaseNo, sum(Amount) AS balance, arg_max(TransactionTypeId, TransactionId) AS last_type FROM transactions
           WHERE SumBalance AND TransactionId NOT IN (SELECT id FROM rev) GROUP BY 1),
   kept AS (SELECT * FROM transactions WHERE TransactionId NOT IN (SELECT id FROM rep)),
   paid AS (SELECT CaseNo, abs(sum(Amount) FILTER (SumTotalPay)) AS paid, bool_or(TransactionTypeId = 3) AS has_payment FROM kept GROUP BY 1),
   rem AS (SELECT CaseNo, abs(sum(Amount) FILTER (Status <> 3)) AS remitted FROM transactions WHERE TransactionTypeId = 5 GROUP BY 1),
   due AS (SELECT CaseNo, sum(Amount) AS left_to_pay FROM transactions WHERE SumTotalFee AND TransactionId NOT IN (SELECT id FROM rev) GROUP BY 1)"""


@query(
    "case_payment",
    ctes("header")
    + f""" SELECT CaseNo, CASE WHEN {_FEE} THEN CASE VisitVisaType WHEN 1 THEN '8000' WHEN 2 THEN '14000' END END AS feeAmountGbp,
       CASE WHEN {_FEE} AND VisitVisaType = 2 THEN '140' END AS feeWithHearing, CASE WHEN {_FEE} AND VisitVisaType = 1 THEN '80' END AS feeWithoutHearing,
       CASE WHEN {_FEE} THEN 'Payment pending' END AS paymentStatus,
       CASE WHEN {_FEE} THEN CASE VisitVisaType WHEN 1 THEN 'decisionWithoutHearing' WHEN 2 THEN 'decisionWithHearing' END END AS decisionHearingFeeOption
       FROM header""",
)
def case_payment(spark: SparkSession, sf: str) -> DataFrame:
    df = fields.content(derive(spark, sf, "header"), fields.payment())
    return df.select(KEY, "feeAmountGbp", "feeWithHearing", "feeWithoutHearing", "paymentStatus", "decisionHearingFeeOption")


@query(
    "case_payment_made",
    ctes("header", "transactions")
    + f""", {_MONEY} SELECT h.CaseNo,
       CASE WHEN {_FEE} THEN CASE WHEN balance > 0 OR (balance = 0 AND last_type = 19) THEN 'Payment pending' ELSE 'Paid' END END AS paymentStatus,
       CASE WHEN {_FEE} AND has_payment THEN {_d('DateCorrectFeeReceived')} END AS paidDate,
       CASE WHEN {_FEE} AND has_payment THEN coalesce(CAST(CAST(trunc(paid) AS BIGINT) AS STRING), '0') END AS paidAmount,
       CASE WHEN dv_appealTypeCode = 'PA' AND dv_representation = 'LR' THEN 'payLater' END AS paAppealTypePaymentOption,
       CASE WHEN dv_appealTypeCode IN ('DC', 'RP') THEN CASE VisitVisaType WHEN 1 THEN 'decisionWithoutHearing' WHEN 2 THEN 'decisionWithHearing' END END AS rpDcAppealHearingOption
       FROM header h LEFT JOIN bal USING (CaseNo) LEFT JOIN paid USING (CaseNo)""",
)
def case_payment_made(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "transactions"))
    df = fields.content(base, fields.payment_made(SYSTEM))
    return df.select(KEY, "paymentStatus", "paidDate", "paidAmount", "paAppealTypePaymentOption", "rpDcAppealHearingOption")


_REMIT_OK = f"({_FEE} AND {_OK})"


def _cell(column: str) -> str:
    return f"CASE WHEN {_REMIT_OK} AND r.{column} NOT IN ('OMIT', 'NO MAPPING REQUIRED') THEN r.{column} END AS {column}"


@query(
    "case_remission",
    ctes("header", "transactions", "remissions")
    + f""", {_MONEY}, x AS (SELECT *, coalesce(TransactionFlag, false) AS has5 FROM header LEFT JOIN
              (SELECT CaseNo, true AS TransactionFlag FROM transactions WHERE TransactionTypeId = 5 GROUP BY 1) USING (CaseNo))
       SELECT x.CaseNo, {_cell('remissionType')}, {_cell('remissionClaim')}, {_cell('feeRemissionType')},
       CASE WHEN {_REMIT_OK} AND r.legalAidAccountNumber NOT IN ('OMIT', 'NO MAPPING REQUIRED') THEN
            CASE WHEN LSCReference IS NULL THEN 'Unknown' WHEN length(LSCReference) IN (4, 5) THEN lpad(LSCReference, 6, '0')
                 WHEN length(LSCReference) = 3 THEN '000' || LSCReference ELSE LSCReference END END AS legalAidAccountNumber,
       CASE WHEN {_REMIT_OK} AND r.asylumSupportReference <> 'OMIT' THEN coalesce(ASFReferenceNo, 'Unknown') END AS asylumSupportReference,
       CASE WHEN {_REMIT_OK} AND r.helpWithFeesReferenceNumber NOT IN ('OMIT', 'NO MAPPING REQUIRED') THEN coalesce(PaymentRemissionReasonNote, 'Unknown') END AS helpWithFeesReferenceNumber,
       CASE WHEN NOT {_FEE} THEN NULL WHEN PaymentRemissionGranted = 1 OR (coalesce(PaymentRemissionGranted, 0) = 0 AND has5) THEN 'approved'
            WHEN PaymentRemissionGranted = 2 OR (dv_appealTypeCode <> 'PA' AND coalesce(PaymentRemissionGranted, 0) = 0 AND NOT has5) THEN 'rejected' END AS remissionDecision,
       CASE WHEN {_FEE} AND PaymentRemissionGranted = 1 THEN CAST(CAST(trunc(remitted * 100) AS BIGINT) AS STRING) END AS amountRemitted,
       CASE WHEN {_FEE} AND PaymentRemissionGranted = 1 THEN CAST(CAST(trunc(left_to_pay) AS BIGINT) AS STRING) END AS amountLeftToPay
       FROM x LEFT JOIN rem USING (CaseNo) LEFT JOIN due USING (CaseNo)
       LEFT JOIN remissions r ON (x.PaymentRemissionReason = r.PaymentRemissionReason AND x.PaymentRemissionRequested = r.PaymentRemissionRequested)
         OR (x.PaymentRemissionReason > 0 AND x.PaymentRemissionReason = r.PaymentRemissionReason AND coalesce(x.PaymentRemissionRequested, 0) = 0)""",
)
def case_remission(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "transactions"))
    joined = fields.with_remission(base, lookup(spark, "remissions"), lenient=True)
    df = fields.content(joined, {**fields.remission(), **fields.remission_decision()})
    return df.drop("exceptionalCircumstances", "remissionDecisionReason")


# ---------------------------------------------------------------- parties


@query(
    "case_party_ids",
    ctes("header")
    + """ SELECT CaseNo, sha256(CaseNo || '|appellant') AS appellantPartyId,
       CASE WHEN lu_appealType IS NOT NULL AND dv_representation = 'LR' THEN sha256(CaseNo || '|legalRepIndividual') END AS legalRepIndividualPartyId,
       CASE WHEN lu_appealType IS NOT NULL AND dv_representation = 'LR' THEN sha256(CaseNo || '|legalRepOrganisation') END AS legalRepOrganisationPartyId,
       CASE WHEN lu_appealType IS NOT NULL AND Sponsor_Name IS NOT NULL THEN sha256(CaseNo || '|sponsor') END AS sponsorPartyId FROM header""",
)
def case_party_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fields.content(derive(spark, sf, "header"), fields.party_ids())


_S_ABROAD = _has(38)


@query(
    "case_sponsor",
    ctes("header", "categories")
    + f""", {_CATS} SELECT h.CaseNo, CASE WHEN {_S_ABROAD} THEN CASE WHEN Sponsor_Name IS NOT NULL THEN 'Yes' ELSE 'No' END END AS hasSponsor,
       CASE WHEN {_S_ABROAD} THEN Sponsor_Name END AS sponsorFamilyName,
       CASE WHEN {_S_ABROAD} AND Sponsor_Name IS NOT NULL THEN CASE WHEN Sponsor_Authorisation THEN 'Yes' ELSE 'No' END END AS sponsorAuthorisation,
       CASE WHEN {_S_ABROAD} THEN replace(split_part(Sponsor_Email, ' ', 1), ';', '') || '@home.example' END AS sponsorEmailAdminJ,
       CASE WHEN {_S_ABROAD} THEN '+447' || substr(Sponsor_Telephone, 10) END AS sponsorMobileNumberAdminJ,
       CASE WHEN Sponsor_Name IS NOT NULL THEN 'Sam ' || Sponsor_Name END AS sponsorNameForDisplay,
       CASE WHEN Sponsor_Name IS NOT NULL THEN concat_ws(chr(13) || chr(10), Sponsor_Address1, Sponsor_Address2, Sponsor_Address3, Sponsor_Address4, Sponsor_Postcode) END AS sponsorAddressForDisplay,
       CASE WHEN {_S_ABROAD} AND Sponsor_Name IS NOT NULL THEN coalesce(Sponsor_Address1, Sponsor_Address2, Sponsor_Address3) END AS first_line
       FROM header h LEFT JOIN cats USING (CaseNo)""",
)
def case_sponsor(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "categories"))
    df = fields.content(base, fields.sponsor())
    return df.select(
        KEY, "hasSponsor", "sponsorFamilyName", "sponsorAuthorisation", "sponsorEmailAdminJ", "sponsorMobileNumberAdminJ",
        "sponsorNameForDisplay", "sponsorAddressForDisplay", F.col("sponsorAddress.AddressLine1").alias("first_line"),
    )


@query(
    "case_detention",
    ctes("header", "people")
    + f""" SELECT h.CaseNo, CASE WHEN Detained IN (1, 2, 4) THEN 'Yes' ELSE 'No' END AS appellantInDetention,
       CASE Detained WHEN 1 THEN 'prison' WHEN 2 THEN 'immigrationRemovalCentre' WHEN 4 THEN 'other' END AS detentionFacility,
       CASE WHEN Detained = 1 THEN PrisonRef END AS prison_number, CASE WHEN Detained IN (1, 4) THEN 'Yes' END AS releaseDateProvided,
       CASE WHEN RemovalDate IS NOT NULL THEN 'Yes' ELSE 'No' END AS removalOrderOptions,
       strftime(RemovalDate, '%Y-%m-%dT%H:%M:%S.000') AS removalOrderDate,
       strftime(CAST(DateLodged AS DATE) + 36524, '%Y-%m-%d') AS delete_after
       FROM header h LEFT JOIN people USING (CaseNo)""",
)
def case_detention(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "people"))
    df = fields.content(base, {**fields.detention(), **fields.time_to_live(F.col("DateLodged"), 36524)})
    return df.select(
        KEY, "appellantInDetention", "detentionFacility", F.col("prisonNOMSNumber.prison").alias("prison_number"), "releaseDateProvided",
        "removalOrderOptions", "removalOrderDate", F.col("TTL.SystemTTL").alias("delete_after"),
    )


# ---------------------------------------------------------------- hearings

_JUDGE_CTE = """jl AS (SELECT CaseNo, string_agg(DISTINCT line, chr(10) ORDER BY line) AS judge_lines,
    nullif(string_agg(DISTINCT excluded, chr(10) ORDER BY excluded), '') AS excluded_judges FROM (
    SELECT CaseNo, concat_ws(' ', Judge_Surname, 'Kim', CASE WHEN Judge_Title IS NOT NULL THEN '( Mr )' END,
           CASE WHEN Required THEN ': Required' WHEN NOT Required THEN ': Not Required' END) AS line,
           CASE WHEN NOT Required AND Judge_Title IS NOT NULL THEN Judge_Surname || ', Kim (Mr)' END AS excluded FROM judges) GROUP BY 1)"""


def _note_sql(row: str) -> str:
    r = f"{row}."
    judge1 = f"CASE WHEN {r}Judge1FT_Surname IS NOT NULL THEN 'Stone Ada ' || CASE WHEN {r}Judge1FT_Title IS NOT NULL THEN '(Ms)' ELSE '' END ELSE '' END"
    judge2 = f"CASE WHEN {r}Judge2FT_Surname IS NOT NULL THEN 'Reed Ben (Mr)' ELSE '' END"
    clerk = f"CASE WHEN {r}CourtClerk_Surname = 'Clark' THEN 'Clark Cy' || CASE WHEN {r}CourtClerk_Title IS NOT NULL THEN ' (Dr)' ELSE '' END END"
    start = f"coalesce(strftime({r}StartTime, '%H:%M:%S'), 'N/A')"
    pieces = [
        ("Hearing Centre", f"coalesce({r}HearingCentre, 'N/A')"), ("Hearing Date", f"coalesce({_d(r + 'HearingDate')}, 'N/A')"),
        ("Hearing Type", f"coalesce({r}HearingType, 'N/A')"), ("Court", f"coalesce({r}CourtName, 'N/A')"),
        ("List Type", f"coalesce({r}ListType, 'N/A')"), ("List Start Time", start), ("Judge First Tier", f"trim({judge1} || ' ' || {judge2})"),
        ("Court Clerk / Usher", f"coalesce({clerk}, 'N/A')"), ("Start Time", start), ("Estimated Duration", f"coalesce(CAST({r}TimeEstimate AS STRING), 'N/A')"),
        ("Required/Incompatible Judicial Officers", "coalesce(chr(10) || judge_lines, '')"), ("Notes", f"coalesce({r}Notes, 'N/A')"),
    ]
    return f"'Listed details from {SYSTEM}: ' || " + " || ".join(f"chr(10) || '{n}: ' || {v}" for n, v in pieces)


@query(
    "case_hearing_response",
    ctes("header", "statuses", "judges")
    + f", {_JUDGE_CTE}, {_last('CaseStatus IN (37, 38)')}"
    + f""" SELECT h.CaseNo, CASE WHEN m3.CaseNo IS NOT NULL THEN CASE WHEN m3.ListTypeId = 5 THEN 'Yes' ELSE 'No' END END AS isAppealSuitableToFloat,
       CASE WHEN InCamera THEN 'Granted' END AS isInCameraCourtAllowed,
       CASE WHEN CourtPreference IN (1, 2) THEN 'Granted - This is a migrated {SYSTEM} case. Please refer to the documents.' END AS singleSexCourtDecisionForDisplay,
       {_note_sql('m3')} AS additionalInstructionsTribunalResponse
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN jl ON jl.CaseNo = h.CaseNo""",
)
def case_hearing_response(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "statuses", "judges"), {"listed": fields.NOTE_FIELDS})
    df = fields.content(base, fields.hearing_response(SYSTEM))
    return df.select(
        KEY, "isAppealSuitableToFloat", "isInCameraCourtAllowed", "singleSexCourtDecisionForDisplay", "additionalInstructionsTribunalResponse"
    )


@query(
    "case_review_response",
    ctes("header", "statuses", "judges")
    + f", {_JUDGE_CTE}, {_last('CaseStatus IN (37, 38) OR (CaseStatus = 26 AND Outcome = 0)')}"
    + f""" SELECT h.CaseNo, CASE WHEN dv_representation = 'LR' AND m3.CaseStatus = 26 THEN {_note_sql('m3')} END AS lr_note,
       CASE WHEN dv_representation = 'AIP' AND m3.CaseStatus = 26 THEN {_note_sql('m3')} END AS aip_note
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN jl ON jl.CaseNo = h.CaseNo""",
)
def case_review_response(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "statuses", "judges"), {"reviewed": fields.NOTE_FIELDS})
    note = "additionalInstructionsTribunalResponse"
    return fields.content(
        base, {"lr_note": fields.review_response(SYSTEM, "LR")[note], "aip_note": fields.review_response(SYSTEM, "AIP")[note]}
    )


@query(
    "case_hearing_requirements",
    ctes("header", "people", "categories")
    + f""", {_CATS} SELECT h.CaseNo, CASE WHEN NOT {_IN_UK_HELD} AND Sponsor_Name IS NOT NULL THEN 'Yes' ELSE 'No' END AS isEvidenceFromOutsideUkOoc,
       CASE WHEN {_IN_UK_HELD} AND Sponsor_Name IS NOT NULL THEN 'Yes' ELSE 'No' END AS isEvidenceFromOutsideUkInCountry,
       CASE WHEN Interpreter = 1 THEN 'Yes' ELSE 'No' END AS isInterpreterServicesNeeded,
       CASE WHEN CourtPreference IN (1, 2) THEN 'Yes' ELSE 'No' END AS singleSexCourt,
       CASE CourtPreference WHEN 1 THEN 'All male' WHEN 2 THEN 'All female' END AS singleSexCourtType,
       CASE WHEN InCamera THEN 'Yes' ELSE 'No' END AS inCameraCourt,
       'This is an {SYSTEM} Migrated Case. Please refer to the hearing requirements in the appeal form.' AS pastExperiencesDescription
       FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo)""",
)
def case_hearing_requirements(spark: SparkSession, sf: str) -> DataFrame:
    base = fields.with_place(case_base(case_tables(spark, sf, "people", "categories")))
    df = fields.content(base, fields.hearing_requirements(SYSTEM))
    return df.select(
        KEY, "isEvidenceFromOutsideUkOoc", "isEvidenceFromOutsideUkInCountry", "isInterpreterServicesNeeded", "singleSexCourt",
        "singleSexCourtType", "inCameraCourt", "pastExperiencesDescription",
    )


def _language_sql(kind: str) -> str:
    a, b = f"coalesce(il.category = '{kind}', false)", f"coalesce(ail.category = '{kind}', false)"
    at, bt = f"({a} AND coalesce(il.manualEntry = 'Yes', false))", f"({b} AND coalesce(ail.manualEntry = 'Yes', false))"
    return f"""CASE WHEN Interpreter = 1 AND ({a} OR {b}) THEN
        CASE WHEN {at} OR {bt} OR ({a} AND {b}) THEN 'typed:' || concat_ws(', ',
               CASE WHEN {at} THEN il.manualEntryDescription WHEN {a} AND {b} THEN il.languageLabel END,
               CASE WHEN {bt} THEN ail.manualEntryDescription WHEN {a} AND {b} THEN ail.languageLabel END)
             ELSE 'listed:' || CASE WHEN {a} THEN il.languageCode ELSE ail.languageCode END END END"""


@query(
    "case_interpreter",
    ctes("header", "statuses", "languages")
    + f""", {_last("(CaseStatus IN (37, 38) AND Outcome IN (0, 27, 37, 39, 40, 50)) OR (CaseStatus = 26 AND Outcome IN (40, 52))")}
       SELECT h.CaseNo, {_language_sql('spokenLanguageInterpreter')} AS spoken, {_language_sql('signLanguageInterpreter')} AS sign
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN languages il ON il.LanguageId = h.LanguageId
       LEFT JOIN languages ail ON ail.LanguageId = m3.AdditionalLanguageId AND h.LanguageId IS DISTINCT FROM m3.AdditionalLanguageId""",
)
def case_interpreter(spark: SparkSession, sf: str) -> DataFrame:
    base = fields.with_languages(case_base(case_tables(spark, sf, "statuses"), {"listing": ["AdditionalLanguageId"]}), lookup(spark, "languages"))
    df = fields.content(base, fields.interpreter())

    def shown(name: str) -> Column:
        c = F.col(name)
        typed = F.concat(F.lit("typed:"), c["languageManualEntryDescription"])
        return F.when(F.size(c["languageManualEntry"]) > 0, typed).otherwise(F.concat(F.lit("listed:"), c["languageRefData"]["code"]))

    return df.select(
        KEY, shown("appellantInterpreterSpokenLanguage").alias("spoken"), shown("appellantInterpreterSignLanguage").alias("sign")
    )


@query(
    "case_listing_flags",
    ctes("header", "people", "categories", "statuses", "languages")
    + f""", {_CATS}, {_last("(CaseStatus IN (37, 38) AND Outcome IN (0, 27, 37, 39, 40, 50)) OR (CaseStatus = 26 AND Outcome IN (40, 52))")},
       x AS (SELECT h.CaseNo, {_OK} AS ok, ids, Detained, Appellant_Forenames || ' ' || Appellant_Name AS party,
               {_language_sql('spokenLanguageInterpreter')} AS spoken, {_language_sql('signLanguageInterpreter')} AS sign
             FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats ON cats.CaseNo = h.CaseNo LEFT JOIN m3 ON m3.CaseNo = h.CaseNo
             LEFT JOIN languages il ON il.LanguageId = h.LanguageId
             LEFT JOIN languages ail ON ail.LanguageId = m3.AdditionalLanguageId AND h.LanguageId IS DISTINCT FROM m3.AdditionalLanguageId)
       SELECT CaseNo, party, concat_ws(',', CASE WHEN ok AND {_any(17, 29, 30, 39, 40, 48, 19)} THEN 'PF0012' END, CASE WHEN ok AND {_has(9)} THEN 'PF0013' END,
         CASE WHEN ok AND Detained IN (1, 2, 4) THEN 'PF0019' END, 'RA0019,RA0043,PF0014', 'PF0015 ' || spoken, 'RA0042 ' || sign) AS flags
       FROM x""",
)
def case_listing_flags(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "people", "categories", "statuses"), {"listing": ["AdditionalLanguageId"]})
    df = fields.content(fields.with_languages(base, lookup(spark, "languages")), fields.listing_flags(AS_OF))

    def shown(f: Column) -> Column:
        v = f["value"]
        kind = F.coalesce(F.concat(F.lit("listed:"), v["subTypeKey"]), F.concat(F.lit("typed:"), v["subTypeValue"]))
        return F.concat_ws(" ", v["flagCode"], kind)

    flags = F.col("appellantLevelFlags")
    return df.select(KEY, flags["partyName"].alias("party"), F.array_join(F.transform(flags["details"], shown), ",").alias("flags"))


@query(
    "case_hearing_details",
    ctes("header", "statuses", "listing_locations")
    + f""", {_last('CaseStatus IN (37, 38)')} SELECT h.CaseNo,
       CASE WHEN m3.CaseNo IS NOT NULL THEN coalesce((SELECT CAST(min_by(b, abs(b - m3.TimeEstimate) * 1000 + b) AS STRING) FROM (SELECT unnest(range(30, 361, 30)) AS b)), '30') END AS listCaseHearingLength,
       {_d('HearingDate')} || 'T' || coalesce(strftime(StartTime, '%H:%M:%S.000'), '00:00:00.000') AS listCaseHearingDate,
       listCaseHearingCentre, listCaseHearingCentreAddress,
       CASE WHEN m3.CaseNo IS NOT NULL THEN CASE WHEN coalesce(TimeEstimate, 0) = 0 THEN '0h30' ELSE
            CASE WHEN TimeEstimate % 60 >= 45 THEN (TimeEstimate // 60 + 1) || 'h0' WHEN TimeEstimate % 60 = 0 THEN (TimeEstimate // 60) || 'h0'
                 ELSE (TimeEstimate // 60) || 'h30' END END END AS listingLength,
       locationCode, CASE VisitVisaType WHEN 1 THEN 'ONPPRS' WHEN 2 THEN 'INTER' END AS channel
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN listing_locations ON ListedCentre = HearingCentre""",
)
def case_hearing_details(spark: SparkSession, sf: str) -> DataFrame:
    base = fields.with_location(case_base(case_tables(spark, sf, "statuses"), {"listed": fields.DETAIL_FIELDS}), lookup(spark, "listing_locations"))
    df = fields.content(base, fields.hearing_details())
    length = F.col("listingLength")
    return df.select(
        KEY, "listCaseHearingLength", "listCaseHearingDate", "listCaseHearingCentre", "listCaseHearingCentreAddress",
        F.concat(length["hours"].cast("string"), F.lit("h"), length["minutes"].cast("string")).alias("listingLength"),
        F.col("listingLocation.code").alias("locationCode"), F.col("hearingChannel.code").alias("channel"),
    )


# ---------------------------------------------------------------- decisions


@query(
    "case_decision",
    ctes("header", "statuses")
    + f""", {_last('CaseStatus IN (37, 38, 26) AND Outcome IN (1, 2)')} SELECT h.CaseNo, {_d('m3.DecisionDate')} AS appealDate,
       CASE m3.Outcome WHEN 1 THEN 'Allowed' WHEN 2 THEN 'Dismissed' END AS appealDecision,
       CASE m3.Outcome WHEN 1 THEN 'allowed' WHEN 2 THEN 'dismissed' END AS isDecisionAllowed,
       CAST(HearingDuration // 60 AS STRING) AS hours, CAST(HearingDuration % 60 AS STRING) AS minutes,
       CASE WHEN m3.CaseNo IS NOT NULL THEN 'Mx Jo ' || Adj_Determination_Surname END AS attendingJudge
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo""",
)
def case_decision(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "statuses"), {"decided": fields.DECIDED_FIELDS})
    df = fields.content(base, {**fields.substantive_decision(SYSTEM), **fields.hearing_actuals()})
    length = F.col("actualCaseHearingLength")
    return df.select(
        KEY, "appealDate", "appealDecision", "isDecisionAllowed", length["hours"].alias("hours"), length["minutes"].alias("minutes"), "attendingJudge"
    )


@query(
    "case_permission",
    ctes("header", "people", "statuses", "categories")
    + f""", {_CATS}, {_last('CaseStatus = 39')}, {_last('CaseStatus IN (37, 38, 26) AND Outcome IN (1, 2)', 'dec')},
       {_last('CaseStatus = 39 AND Outcome IN (30, 31, 14)', 'pd')}, {_last('(CaseStatus = 39 AND Outcome IN (30, 31, 14)) OR (CaseStatus = 46 AND Outcome = 31)', 'fin')}
       SELECT h.CaseNo, strftime(CAST(dec.DecisionDate AS DATE) + CASE WHEN {_IN_UK_HELD} THEN 14 ELSE 28 END, '%Y-%m-%d') AS ftpaApplicationDeadline,
       CASE WHEN m3.Party = 1 THEN {_d('m3.DateReceived')} END AS ftpaAppellantApplicationDate,
       CASE WHEN m3.Party = 2 THEN CASE WHEN m3.OutOfTime = 1 THEN 'Yes' ELSE 'No' END END AS ftpaRespondentSubmissionOutOfTime,
       CASE m3.Party WHEN 1 THEN 'appellant' WHEN 2 THEN 'respondent' END AS list_applicant,
       CASE WHEN m3.Party = 1 AND m3.OutOfTime = 1 THEN 'No' END AS isFtpaAppellantOotDocsVisibleInDecided,
       CASE WHEN m3.Party = 2 THEN 'Yes' END AS isFtpaRespondentGroundsDocsVisibleInSubmitted,
       CASE WHEN m3.CaseNo IS NOT NULL THEN 'Sir Al ' || m3.Adj_Surname END AS allocatedJudge,
       CASE pd.Outcome WHEN 30 THEN 'granted' WHEN 31 THEN 'refused' WHEN 14 THEN 'notAdmitted' END AS ftpaFirstDecision,
       CASE fin.Outcome WHEN 30 THEN 'granted' WHEN 31 THEN 'refused' WHEN 14 THEN 'notAdmitted' END AS ftpaFinalDecisionForDisplay,
       CASE WHEN pd.Party = 2 THEN {_d('pd.DecisionDate')} END AS ftpaRespondentDecisionDate,
       CASE WHEN m3.Party = 1 THEN 'No' END AS isFtpaAppellantNoticeOfDecisionSetAside
       FROM header h LEFT JOIN people USING (CaseNo) LEFT JOIN cats USING (CaseNo) LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN dec ON dec.CaseNo = h.CaseNo
       LEFT JOIN pd ON pd.CaseNo = h.CaseNo LEFT JOIN fin ON fin.CaseNo = h.CaseNo""",
)
def case_permission(spark: SparkSession, sf: str) -> DataFrame:
    """Application for permission: deadline, application, visibility, judge and decision from one base."""
    base = case_base(
        case_tables(spark, sf, "people", "statuses", "categories"),
        {
            "decided": ["DecisionDate"], "permission": fields.PERMISSION_FIELDS,
            "permission_decided": ["Outcome", "Party", "DecisionDate"], "permission_final": ["Outcome"],
        },
    )
    base = fields.with_place(base)
    df = fields.content(
        base,
        {
            **fields.permission_deadline(), **fields.permission_application(SYSTEM), **fields.permission_visibility(),
            **fields.allocated_judge(), **fields.permission_decision(),
        },
    )
    return df.select(
        KEY, "ftpaApplicationDeadline", "ftpaAppellantApplicationDate", "ftpaRespondentSubmissionOutOfTime",
        F.col("ftpaList")[0]["value"]["ftpaApplicant"].alias("list_applicant"), "isFtpaAppellantOotDocsVisibleInDecided",
        "isFtpaRespondentGroundsDocsVisibleInSubmitted", "allocatedJudge", "ftpaFirstDecision", "ftpaFinalDecisionForDisplay",
        "ftpaRespondentDecisionDate", "isFtpaAppellantNoticeOfDecisionSetAside",
    )


@query(
    "case_set_aside",
    ctes("header", "statuses", "judges")
    + f""", {_JUDGE_CTE}, {_last('CaseStatus = 39')}, {_last('true', 'latest')} SELECT h.CaseNo, excluded_judges AS judgesNamesToExclude,
       CASE WHEN m3.CaseNo IS NOT NULL THEN {_d('latest.DecisionDate')} END AS updateTribunalDecisionDateRule32,
       CASE WHEN m3.Party = 2 THEN 'This is an {SYSTEM} Migrated case. Please refer to the documents for the notice to set aside.' END AS ftpaRespondentDecisionRemadeRule32Text,
       CASE WHEN m3.Party = 1 THEN 'remadeRule32' END AS ftpaAppellantRjDecisionOutcomeType, CASE WHEN m3.Party = 1 THEN {_d('m3.DecisionDate')} END AS ftpaAppellantDecisionDate
       FROM header h LEFT JOIN jl ON jl.CaseNo = h.CaseNo LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN latest ON latest.CaseNo = h.CaseNo""",
)
def case_set_aside(spark: SparkSession, sf: str) -> DataFrame:
    base = case_base(case_tables(spark, sf, "statuses", "judges"), {"permission": ["Party", "DecisionDate"], "any": ["DecisionDate"]})
    df = fields.content(base, {**fields.set_aside(SYSTEM), **fields.permission_set_aside()})
    return df.select(
        KEY, "judgesNamesToExclude", "updateTribunalDecisionDateRule32", "ftpaRespondentDecisionRemadeRule32Text",
        "ftpaAppellantRjDecisionOutcomeType", "ftpaAppellantDecisionDate",
    )


_ENDED_SQL = f"({pair('', ENDED)} OR (CaseStatus = 46 AND Outcome = 31 AND CaseNo IN (SELECT CaseNo FROM statuses WHERE CaseStatus IN (10, 51, 52))))"
_OVERRIDE = " ".join(
    f"WHEN m3.CaseStatus = {s} AND m3.Outcome = {o} THEN '{{{i}}}'" for i, (s, o) in enumerate(fields.END_OVERRIDES)
)


def _override_sql(place: int, before: str = "", after: str = "") -> str:
    return "CASE " + _OVERRIDE.format(*[before + v[place].format(target='LIVE') + after for v in fields.END_OVERRIDES.values()])


@query(
    "case_ended",
    ctes("header", "statuses", "end_states")
    + f""", {_last(_ENDED_SQL)} SELECT h.CaseNo,
       {_override_sql(0)} WHEN endAppealOutcome = 'Struck Out' THEN 'Struck out' WHEN endAppealOutcome = 'No Valid Appeal' THEN 'No valid appeal' ELSE endAppealOutcome END AS endAppealOutcome,
       {_override_sql(1, 'This is a migrated case. The final outcome was ', '.')} ELSE endAppealOutcomeReason END AS endAppealOutcomeReason,
       CASE WHEN m3.CaseStatus = 46 THEN 'Judge' WHEN m3.CaseNo IS NOT NULL THEN 'Case Worker' END AS endAppealApproverType,
       CASE WHEN m3.CaseStatus = 46 THEN Adj_Determination_Surname || ', Jo (Mx)' WHEN m3.CaseNo IS NOT NULL THEN 'This is a migrated {SYSTEM} case' END AS endAppealApproverName,
       {_d('m3.DecisionDate')} AS endAppealDate,
       CASE WHEN m3.CaseStatus = 26 AND m3.Outcome IN (13, 80, 25) THEN CASE dv_representation WHEN 'LR' THEN 'caseUnderReview' ELSE 'reasonsForAppealSubmitted' END
            ELSE {_override_sql(2)} ELSE e.stateBeforeEndAppeal END END AS stateBeforeEndAppeal
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo LEFT JOIN end_states e ON e.CaseStatus = m3.CaseStatus AND e.Outcome = m3.Outcome""",
)
def case_ended(spark: SparkSession, sf: str) -> DataFrame:
    base = fields.with_end_states(case_base(case_tables(spark, sf, "statuses"), {"ended": fields.ENDED_FIELDS}), lookup(spark, "end_states"))
    return fields.content(base, fields.ended(SYSTEM, "LIVE"))


@query(
    "case_remittal",
    ctes("header", "statuses")
    + f""", {_last('CaseStatus IN (42, 43, 44) AND Outcome = 86')} SELECT h.CaseNo, 'Remitted' AS rehearingReason, 'Upper Tribunal' AS sourceOfRemittal,
       {_d('m3.DecisionDate')} AS appealRemittedDate, 'This is a migrated {SYSTEM} case. Please refer to the documents.' AS courtReferenceNumber
       FROM header h LEFT JOIN m3 ON m3.CaseNo = h.CaseNo""",
)
def case_remittal(spark: SparkSession, sf: str) -> DataFrame:
    return fields.content(case_base(case_tables(spark, sf, "statuses"), {"remitted": ["DecisionDate"]}), fields.remittal(SYSTEM))


# ---------------------------------------------------------------- columns on demand

#: Rules that name columns of ten sources, some of them through others.
DEMANDING = {
    "reference_known": "dv_reference IS NOT NULL AND dv_reference NOT IN ('XXXX', 'history')",
    "centre_known": "hearingCentre IS NOT NULL OR last_move LIKE 'Place%'",
    "ended_known": "t_Outcome IS NULL OR endAppealOutcome IS NOT NULL",
    "detained_place": "NOT is_detained OR detentionBuilding IS NOT NULL",
    "category": "in_category_37_38 OR remissionType <> 'noRemission'",
    "language": "Interpreter <> 1 OR languageLabel IS NOT NULL",
}


def _dependency_sources(spark: SparkSession, sf: str) -> dict:
    tables = {n: (lambda n=n: derive(spark, sf, n)) for n in ("header", "people", "statuses", "categories", "transactions", "judges", "history", "refs")}
    return tables | {n: (lambda n=n: lookup(spark, n)) for n in ("centres", "detention_centres", "languages", "remissions", "end_states")}


@query(
    "case_dependencies",
    ctes("header", "people", "statuses", "categories", "history", "refs", "centres", "detention_centres", "languages", "remissions", "end_states")
    + """, c AS (SELECT CaseNo, list_has_any(list(DISTINCT CategoryId), [37, 38]) AS hit FROM categories GROUP BY 1),
         t AS (SELECT * FROM statuses WHERE Outcome NOT IN (38, 111) AND CaseStatus <> 17 QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY StatusId DESC) = 1),
         m AS (SELECT CaseNo, Comment FROM history QUALIFY row_number() OVER (PARTITION BY CaseNo ORDER BY HistoryId DESC) = 1)
       SELECT h.CaseNo, coalesce(CleanHORef, CleanFCONumber, HORef) AS dv_reference, ce.hearingCentre, m.Comment AS last_move, t.Outcome AS t_Outcome, endAppealOutcome,
         p.Detained IN (1, 2, 4) AS is_detained, detentionBuilding, coalesce(c.hit, false) AS in_category_37_38, remissionType, Interpreter, languageLabel
       FROM header h LEFT JOIN refs USING (CaseNo) LEFT JOIN centres ce ON ce.CentreId = h.CentreId LEFT JOIN m ON m.CaseNo = h.CaseNo LEFT JOIN t ON t.CaseNo = h.CaseNo
       LEFT JOIN end_states e ON e.CaseStatus = t.CaseStatus AND e.Outcome = t.Outcome LEFT JOIN people p ON p.CaseNo = h.CaseNo
       LEFT JOIN detention_centres d ON d.DetentionCentreId = h.DetentionCentreId LEFT JOIN c ON c.CaseNo = h.CaseNo
       LEFT JOIN remissions r ON r.PaymentRemissionRequested = h.PaymentRemissionRequested AND r.PaymentRemissionReason = h.PaymentRemissionReason
       LEFT JOIN languages l ON l.LanguageId = h.LanguageId""",
)
def case_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    """The columns that a rule set names, each source read once and unused ones not at all."""
    made = dependencies.resolver(_dependency_sources(spark, sf))
    wanted = named_columns(DEMANDING.values(), made.known)
    cases = derive(spark, sf, "header").select(KEY)
    shown = ["dv_reference", "hearingCentre", "last_move", "t_Outcome", "endAppealOutcome", "is_detained", "detentionBuilding", "in_category_37_38", "remissionType", "Interpreter", "languageLabel"]
    return made.resolve(cases, wanted).select(KEY, *shown)
