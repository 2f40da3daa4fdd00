"""Named data-quality rules per state, over the content fields and the case columns they depend on (Spark SQL).

A state is checked by its own rules and those of the states before it, and by one rule for each of its constant
fields and empty document lists.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

# Columns of the case that rules compare the content with.
DEPENDENCIES = [
    "dv_representation", "lu_appealType", "OutOfTimeIssue", "PaymentRemissionRequested", "Interpreter", "CourtPreference", "InCamera",
    "Sponsor_Name", "Detained", "dv_inCountryOrHeld", "DateLodged", "dv_reached",
]
_ACCEPTED = "(dv_representation IN ('LR', 'AIP') AND lu_appealType IS NOT NULL)"
_DAY = r"RLIKE '^\\d{4}-\\d{2}-\\d{2}$'"


def _day(name: str) -> str:
    return f"{name} IS NOT NULL AND {name} {_DAY}"


def _day_or_null(name: str) -> str:
    return f"{name} IS NULL OR {name} {_DAY}"


def _yes_no(name: str) -> str:
    return f"{name} IN ('Yes', 'No')"


def _yes_no_or_null(name: str) -> str:
    return f"{name} IS NULL OR {_yes_no(name)}"


def _only_represented(name: str) -> str:
    """Present for represented cases, absent otherwise."""
    return f"(dv_representation <=> 'LR' AND {name} IS NOT NULL) OR (NOT dv_representation <=> 'LR' AND {name} IS NULL)"


def _fixed(name: str, value: str) -> str:
    return f"{name} <=> '{value}'"


def _one_of_or_null(name: str, *values: str) -> str:
    return f"{name} IS NULL OR {name} IN ({', '.join(repr(v) for v in values)})"


def _follows(name: str, condition: str, yes: str = "Yes", no: str = "No") -> str:
    """The field says whether the condition on the case holds."""
    return f"{name} <=> IF(COALESCE({condition}, FALSE), '{yes}', '{no}')"


def _only_if(name: str, condition: str) -> str:
    """Present exactly where the condition on the case holds."""
    return f"({name} IS NOT NULL) = COALESCE({condition}, FALSE)"


def _together(*names: str) -> str:
    """All present or all absent."""
    return " AND ".join(f"({n} IS NULL) = ({names[0]} IS NULL)" for n in names[1:])


def constant_rules(defaults: Mapping[str, object]) -> dict[str, str]:
    """A rule per constant field: the text it has, or an empty list."""
    return {
        f"valid_{n}_default": f"SIZE({n}) = 0" if isinstance(v, list) else f"{n} <=> '{str(v).replace(chr(39), chr(39) * 2)}'"
        for n, v in defaults.items()
    }


def document_rules(names: Iterable[str]) -> dict[str, str]:
    """A rule per document list that starts out empty."""
    return {f"valid_{n}_empty": f"{n} IS NULL OR SIZE({n}) = 0" for n in names}


_TOPICS = ("remoteVideoCall", "physicalOrMentalHealthIssues", "pastExperiences", "multimediaEvidence", "additionalRequests")
_GRANTED = ("isMultimediaAllowed", "isVulnerabilitiesAllowed", "isRemoteHearingAllowed", "isAdditionalAdjustmentsAllowed")

STATE_RULES_BY_NAME: dict[str, dict[str, str]] = {
    "paymentPending": {
        "valid_appealReferenceNumber_not_null": "appealReferenceNumber IS NOT NULL",
        "valid_appealType_in_allowed_values": (
            "appealType IN ('refusalOfHumanRights', 'refusalOfEu', 'deprivation', 'protection', 'revocationOfProtection', 'euSettlementScheme')"
        ),
        "valid_appealSubmissionDate_format": _day("appealSubmissionDate"),
        "valid_tribunalReceivedDate_format": _day("tribunalReceivedDate"),
        "valid_appellantsRepresentation_yes_no": _yes_no("appellantsRepresentation"),
        "valid_submissionOutOfTime_yes_no": _yes_no("submissionOutOfTime"),
        "valid_recordedOutOfTimeDecision_yes_no_or_null": _yes_no_or_null("recordedOutOfTimeDecision"),
        "valid_legalRepGivenName": _only_represented("legalRepGivenName"),
        "valid_legalRepFamilyNamePaperJ": _only_represented("legalRepFamilyNamePaperJ"),
        "valid_legalRepEmail_format": "legalRepEmail IS NULL OR legalRepEmail RLIKE '^[^@ ]+@[^@ ]+$'",
        "valid_appellantFamilyName_not_null": "appellantFamilyName IS NOT NULL",
        "valid_appellantGivenNames_not_null": "appellantGivenNames IS NOT NULL",
        "valid_appellantDateOfBirth_format": _day("appellantDateOfBirth"),
        "valid_isAppellantMinor_yes_no": _yes_no("isAppellantMinor"),
        "valid_appellantInUk_opposite": "(appellantInUk = 'Yes' AND appealOutOfCountry = 'No') OR (appellantInUk = 'No' AND appealOutOfCountry = 'Yes')",
        "valid_appellantStateless": "appellantStateless IN ('isStateless', 'hasNationality')",
        "valid_deportationOrderOptions_yes_no": _yes_no("deportationOrderOptions"),
        "valid_homeOfficeReferenceNumber_format": "homeOfficeReferenceNumber IS NULL OR homeOfficeReferenceNumber RLIKE '^[0-9]{9}$'",
        "valid_home_or_gwf_reference": "homeOfficeReferenceNumber IS NOT NULL OR gwfReferenceNumber IS NOT NULL",
        "valid_appellantPartyId_not_null": "appellantPartyId IS NOT NULL",
        "valid_feeAmountGbp": "feeAmountGbp IS NULL OR feeAmountGbp IN ('8000', '14000')",
        "valid_one_fee": "feeWithHearing IS NULL OR feeWithoutHearing IS NULL",
        "valid_hasSponsor_name": "hasSponsor IS NULL OR hasSponsor = 'No' OR sponsorFamilyName IS NOT NULL",
        "valid_flags_not_empty": "caseFlags IS NULL OR SIZE(caseFlags) > 0",
        "valid_submissionOutOfTime_follows_issue": f"NOT {_ACCEPTED} OR " + _follows("submissionOutOfTime", "OutOfTimeIssue"),
        "valid_applicationOutOfTimeExplanation": _only_if("applicationOutOfTimeExplanation", f"{_ACCEPTED} AND OutOfTimeIssue"),
        "valid_outOfTimeDecisionType": _one_of_or_null("outOfTimeDecisionType", "approved"),
        "valid_outOfTimeDecision_whole": _together("outOfTimeDecisionType", "outOfTimeDecisionMaker"),
        "valid_appealWasNotSubmittedReason": _only_if("appealWasNotSubmittedReason", f"{_ACCEPTED} AND dv_representation = 'LR'"),
        "valid_hasOtherAppeals": _one_of_or_null("hasOtherAppeals", "NotSure"),
        "valid_hearingCentre_known": _one_of_or_null(
            "hearingCentre", "bradford", "manchester", "newport", "taylorHouse", "newcastle", "birmingham", "hattonCross", "glasgow"
        ),
        "valid_hearingCentreDynamicList_code": (
            "hearingCentreDynamicList IS NULL OR "
            "ARRAY_CONTAINS(TRANSFORM(hearingCentreDynamicList.list_items, x -> x.code), hearingCentreDynamicList.value.code)"
        ),
        "valid_hearingCentreDynamicList_label": (
            "hearingCentreDynamicList IS NULL OR "
            "ARRAY_CONTAINS(TRANSFORM(hearingCentreDynamicList.list_items, x -> x.label), hearingCentreDynamicList.value.label)"
        ),
        "valid_caseManagementLocation_region": "caseManagementLocationRefData IS NULL OR caseManagementLocationRefData.region = '1'",
        "valid_caseManagementLocation_same": "caseManagementLocationRefData.baseLocation.value.code <=> hearingCentreDynamicList.value.code",
        "valid_serviceRequestTab": _follows(
            "isServiceRequestTabVisibleConsideringRemissions", "PaymentRemissionRequested IS NULL OR PaymentRemissionRequested = 2"
        ),
        "valid_hasSponsor_follows_name": "hasSponsor IS NULL OR " + _follows("hasSponsor", "Sponsor_Name IS NOT NULL"),
        "valid_TTL_lodged": "TTL.Suspended <=> 'No' AND TTL.SystemTTL <=> DATE_FORMAT(DATE_ADD(DateLodged, 36524), 'yyyy-MM-dd')",
    },
    "paymentPendingDetained": {
        "valid_detentionFacility": (
            "(appellantInDetention = 'Yes' AND detentionFacility IN ('prison', 'immigrationRemovalCentre', 'other')) "
            "OR (appellantInDetention = 'No' AND detentionFacility IS NULL)"
        ),
        "valid_detention_place": "Detained IN (1, 2) OR (detentionBuilding IS NULL AND detentionAddressLines IS NULL AND detentionPostcode IS NULL)",
        "valid_removalOrder": "(removalOrderOptions = 'Yes') = (removalOrderDate IS NOT NULL)",
    },
    "appealSubmitted": {
        "valid_paymentStatus": "paymentStatus IS NULL OR paymentStatus IN ('Paid', 'Payment pending')",
        "valid_paidDate_with_amount": "(paidDate IS NULL) = (paidAmount IS NULL)",
        "valid_remissionDecision": "remissionDecision IS NULL OR remissionDecision IN ('approved', 'rejected')",
    },
    "listing": {
        "valid_singleSexCourtType": "(singleSexCourt = 'No' AND singleSexCourtType IS NULL) OR singleSexCourtType IN ('All male', 'All female')",
        "valid_appellantLevelFlags_listed": (
            "SIZE(ARRAY_INTERSECT(TRANSFORM(appellantLevelFlags.details, x -> x.value.flagCode), ARRAY('RA0019', 'RA0043', 'PF0014'))) = 3"
        ),
        "valid_flag_PF0015": (
            "ARRAY_CONTAINS(TRANSFORM(appellantLevelFlags.details, x -> x.value.flagCode), 'PF0015') = (appellantInterpreterSpokenLanguage IS NOT NULL)"
        ),
        "valid_flag_RA0042": (
            "ARRAY_CONTAINS(TRANSFORM(appellantLevelFlags.details, x -> x.value.flagCode), 'RA0042') = (appellantInterpreterSignLanguage IS NOT NULL)"
        ),
        "valid_interpreter_language": "isInterpreterServicesNeeded = 'No' OR SIZE(appellantInterpreterLanguageCategory) > 0",
        "valid_isAppellantAttendingTheHearing": _fixed("isAppellantAttendingTheHearing", "Yes"),
        "valid_isAppellantGivingOralEvidence": _fixed("isAppellantGivingOralEvidence", "Yes"),
        "valid_isWitnessesAttending": _fixed("isWitnessesAttending", "No"),
        "valid_isHearingRoomNeeded": _fixed("isHearingRoomNeeded", "Yes"),
        "valid_isHearingLoopNeeded": _fixed("isHearingLoopNeeded", "Yes"),
        "valid_datesToAvoidYesNo": _fixed("datesToAvoidYesNo", "No"),
        "valid_isInterpreterServicesNeeded": _follows("isInterpreterServicesNeeded", "Interpreter = 1"),
        "valid_singleSexCourt": _follows("singleSexCourt", "CourtPreference IN (1, 2)"),
        "valid_singleSexCourtTypeDescription": _only_if("singleSexCourtTypeDescription", "CourtPreference IN (1, 2)"),
        "valid_inCameraCourt": _follows("inCameraCourt", "InCamera"),
        "valid_inCameraCourtDescription": _only_if("inCameraCourtDescription", "InCamera"),
        "valid_evidence_from_one_side": "NOT (isEvidenceFromOutsideUkOoc <=> 'Yes' AND isEvidenceFromOutsideUkInCountry <=> 'Yes')",
        "valid_isEvidenceFromOutsideUkOoc": _one_of_or_null("isEvidenceFromOutsideUkOoc", "Yes", "No"),
        "valid_evidence_needs_sponsor": "Sponsor_Name IS NOT NULL OR NOT (isEvidenceFromOutsideUkOoc <=> 'Yes' OR isEvidenceFromOutsideUkInCountry <=> 'Yes')",
        **{f"valid_{t}": _fixed(t, "Yes") for t in _TOPICS},
        **{f"valid_{t}Description": f"{t}Description IS NOT NULL" for t in _TOPICS},
    },
    "prepareForHearing": {
        "valid_listCaseHearingLength": "listCaseHearingLength IS NULL OR CAST(listCaseHearingLength AS INT) % 30 = 0",
        "valid_listingLength": "listingLength IS NULL OR ELEMENT_AT(listingLength, 'minutes') IN (0, 30)",
        "valid_witnessDetails": "SIZE(witnessDetails) = 0",
        **{f"valid_witness{i}_{kind}": f"SIZE(witness{i}Interpreter{kind}Language) = 0" for kind in ("Sign", "Spoken") for i in range(1, 11)},
        "valid_isRemoteHearing": _fixed("isRemoteHearing", "No"),
        "valid_isAdditionalInstructionAllowed": _fixed("isAdditionalInstructionAllowed", "Yes"),
        "valid_isAppealSuitableToFloat": _one_of_or_null("isAppealSuitableToFloat", "Yes", "No"),
        **{f"valid_{t}": _fixed(t, "Granted") for t in _GRANTED},
        "valid_isInCameraCourtAllowed": _only_if("isInCameraCourtAllowed", "InCamera"),
        "valid_inCamera_whole": _together("isInCameraCourtAllowed", "inCameraCourtTribunalResponse", "inCameraCourtDecisionForDisplay"),
        "valid_isSingleSexCourtAllowed": _only_if("isSingleSexCourtAllowed", "CourtPreference IN (1, 2)"),
        "valid_singleSex_whole": _together("isSingleSexCourtAllowed", "singleSexCourtTribunalResponse", "singleSexCourtDecisionForDisplay"),
    },
    "decided(a)": {
        "valid_appealDecision": "appealDecision IS NULL OR LOWER(appealDecision) = isDecisionAllowed",
        "valid_ftpaApplicationDeadline": _day_or_null("ftpaApplicationDeadline"),
    },
    "ftpaSubmitted(a)": {
        "valid_one_applicant": "ftpaAppellantApplicationDate IS NULL OR ftpaRespondentApplicationDate IS NULL",
        "valid_ftpaList_applicant": "ftpaList IS NULL OR EXISTS(ftpaList, x -> x.value.ftpaApplicant IN ('appellant', 'respondent'))",
    },
    "ftpaDecided": {"valid_ftpaFirstDecision": "ftpaFirstDecision IS NULL OR ftpaFirstDecision IN ('granted', 'refused', 'notAdmitted')"},
    "decided(b)": {"valid_ftpaFirstDecision": "ftpaFirstDecision = 'remadeRule32'"},
    "remitted": {"valid_appealRemittedDate": _day_or_null("appealRemittedDate")},
    "ended": {
        "valid_endAppealOutcome_not_null": "endAppealOutcome IS NOT NULL",
        "valid_endAppealApproverType": "endAppealApproverType IN ('Judge', 'Case Worker')",
        "valid_stateBeforeEndAppeal_not_null": "stateBeforeEndAppeal IS NOT NULL",
        "valid_endAppealDate": _day_or_null("endAppealDate"),
        "valid_end_whole": _together("endAppealOutcome", "endAppealOutcomeReason"),
    },
}
