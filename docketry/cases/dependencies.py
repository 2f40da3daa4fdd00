"""Where the case columns come from that rules compare the content with."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.cases.base import KEY, STATUS_VARIANTS
from docketry.operators.resolve import Derived, Resolver, Source

Read = Mapping[str, Callable[[], DataFrame]]

_HEADER = [
    "CaseType", "CasePrefix", "dv_representation", "lu_appealType", "OutOfTimeIssue", "PaymentRemissionRequested", "PaymentRemissionReason", "Interpreter",
    "LanguageId", "CourtPreference", "InCamera", "Sponsor_Name", "Sponsor_Authorisation", "DateLodged", "HORef", "HOANRef", "CentreId", "DetentionCentreId", "VisitVisaType",
]
_PERSON = ["Detained", "AppellantCountryId", "Appellant_Postcode", "Appellant_Name", "Appellant_Forenames", "BirthDate", "NationalityId", "RemovalDate", "DeportationDate"]


def _latest(name: str, fields: list[str]) -> dict:
    """Aggregates for fields of the latest status row of a variant."""
    row = F.max(F.when(F.expr(STATUS_VARIANTS[name]), F.struct("StatusId", *fields)))
    return {f"{name}_{c}": row[c] for c in fields}


def resolver(read: Read) -> Resolver:
    """A resolver over the case tables in ``read``: each is a function, called only when the table is needed."""
    statuses = {**_latest("t", ["CaseStatus", "Outcome", "DecisionDate"]), **_latest("listing", ["HearingCentre", "AdditionalLanguageId", "TimeEstimate"]), **_latest("decided", ["Outcome", "DecisionDate"]), **_latest("permission", ["Party", "OutOfTime"])}
    money = {
        "n_payments": F.count_if(F.col("TransactionTypeId").isin(3, 5)),
        "last_type": F.max(F.struct("TransactionId", "TransactionTypeId"))["TransactionTypeId"],
        "has_fee": F.bool_or("SumTotalFee"),
    }
    sources = [
        Source("header", read["header"], _HEADER),
        Source("person", lambda: read["people"]().filter(F.col("Relationship").isNull()), _PERSON, order=["Appellant_Name"]),
        Source("statuses", read["statuses"], list(statuses), pick=statuses),
        Source("categories", read["categories"], ["category_ids"], pick={"category_ids": F.sort_array(F.collect_set("CategoryId"))}),
        Source("transactions", read["transactions"], list(money), pick=money),
        Source("judges", read["judges"], ["n_judges"], pick={"n_judges": F.count_distinct("Judge_Surname")}),
        Source("history", read["history"], ["last_move"], pick={"last_move": F.max_by("Comment", "HistoryId")}),
        Source("references", read["refs"], ["CleanHORef", "CleanFCONumber"], order=["CleanHORef"]),
        Source("centre", read["centres"], ["hearingCentre", "staffLocation"], on={"CentreId": "CentreId"}, order=["hearingCentre"]),
        Source("detention_centre", read["detention_centres"], ["detentionBuilding", "detentionPostcode"], on={"DetentionCentreId": "DetentionCentreId"}, order=["detentionBuilding"]),
        Source("language", read["languages"], ["languageCode", "languageLabel"], on={"LanguageId": "LanguageId"}, order=["languageCode"]),
        Source("remission", read["remissions"], ["remissionType"], on={"PaymentRemissionRequested": "PaymentRemissionRequested", "PaymentRemissionReason": "PaymentRemissionReason"}, order=["remissionType"]),
        Source(
            "end_state", read["end_states"], ["endAppealOutcome", "stateBeforeEndAppeal"], on={"CaseStatus": "t_CaseStatus", "Outcome": "t_Outcome"}, order=["endAppealOutcome"]
        ),
    ]
    derived = [
        Derived("lu_HORef", ["CleanHORef", "CleanFCONumber"], F.coalesce("CleanHORef", "CleanFCONumber")),
        Derived("dv_reference", ["lu_HORef", "HORef"], F.coalesce("lu_HORef", "HORef")),
        Derived("in_category_37_38", ["category_ids"], F.coalesce(F.arrays_overlap("category_ids", F.array(F.lit(37), F.lit(38))), F.lit(False))),
        Derived("is_detained", ["Detained"], F.col("Detained").isin(1, 2, 4)),
    ]
    return Resolver(KEY, sources, derived)
