"""Target state and retention segment of a case, as rule tables.

``t`` is the current status row, ``st`` the one before a cost or review status, ``us`` the last upper
tribunal status, ``sa`` the last status that is no set-aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.cases.base import KEY, CaseTables, money_summary, pair, status_summary
from docketry.operators import joins, projection, ranking

# Status -> outcomes.
EARLY = {10: [0, 109, 99, 104, 82, 121]}
REVIEW = {26: [0, 27, 39, 50, 89]}
LISTING = {26: [40, 52], 37: [39, 40, 37, 50, 27, 5], 38: [39, 40, 37, 50, 27, 5]}
DECIDED = {26: [1, 2], 37: [1, 2], 38: [1, 2], 39: [25, 80]}
PERMISSION_DECIDED = {39: [30, 31, 14]}
ENDED_EARLY = {10: [80, 122, 25, 120, 2, 105, 13, 119], 26: [80, 13, 25], 37: [80, 13, 25, 72, 125], 38: [80, 13, 25, 72, 125]}
COST = {52: [91, 95], 36: [1, 2, 25]}
CLOSED_51 = {51: [94, 93]}
UPPER = (40, 41, 42, 43, 44, 45, 53, 27, 28, 29, 34, 32, 33)
OPEN_STATUSES = {10: [0, 109, 104, 82, 99, 121, 27, 39], 46: [1, 86], 26: [0, 27, 39, 50, 40, 52, 89], 37: [39, 40, 37, 50, 27, 0, 5, 52], 38: [39, 40, 37, 50, 27, 0, 5, 52], 39: [0, 86], 50: [0]}
PAID_PREFIXES = ("EA", "HU")
OTHER_PREFIXES = ("PA", "DC", "RP", "DA", "IA", "LE", "LP", "LR", "LD", "LH")
MAIN_PREFIXES = ("DA", "DC", "EA", "HU", "PA", "RP")
DROPPED_PREFIXES = ("LP", "LR", "LD", "LH", "LE", "IA")
OVERDUE_PREFIXES = ("VA", "AA", "AS", "CC", "HR", "HX", "IM", "NS", "OA", "OC", "RD", "TH", "XX")
UNASSIGNED = "Not Sure"
STATE_FIELDS = ["CaseStatus", "Outcome", "KeyDate", "DecisionReserved", "AdjudicatorId", "DecisionDate"]


def one_of(column: str, values: Sequence) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


HELD = "(t.CaseStatus IN (50, 52, 36) AND t.Outcome = 0)"
SHUT = f"({HELD} OR {pair('t.', COST)})"
SET_ASIDE_EARLY = "({r}.CaseStatus = 46 AND {r}.Outcome = 1 AND sa.CaseStatus = 10)"


def _now_or_held(cond: str, held: str = HELD) -> str:
    """The condition on the current row, or on the row before a status that only holds the case."""
    return f"({cond.replace('{r}', 't')} OR ({held} AND {cond.replace('{r}', 'st')}))"


def _codes(codes: dict) -> str:
    return pair("{r}.", codes)


_early = "({r}.CaseStatus IS NULL OR " + _codes(EARLY) + " OR " + SET_ASIDE_EARLY + ")"
_early_open = "({r}.CaseStatus IS NULL OR " + _codes({10: [0]}) + " OR " + SET_ASIDE_EARLY + ")"
_few_documents = "(dr.ReceivedDocumentId <= 2 OR dr.ReceivedDocumentId IS NULL)"
_evidence_due = "(dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NULL)"
_evidence_in = "(dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NOT NULL)"
_no_fee_due = f"(({one_of('ac.CasePrefix', PAID_PREFIXES)} AND (bd.balance <= 0 OR bd.balance IS NULL)) OR {one_of('ac.CasePrefix', OTHER_PREFIXES)})"
_under_review = (
    f"((({pair('t.', {10: [121, 109, 99, 82, 104]})} AND {_evidence_in}) OR {pair('t.', REVIEW)})"
    f" OR ({HELD} AND {pair('st.', REVIEW)} AND {_evidence_in}))"
)
_listing = "(" + _codes(LISTING) + " OR (" + _codes({37: [0], 38: [0]}) + " AND {r}.KeyDate IS NULL))"
_to_hear = "(" + _codes({37: [0], 38: [0]}) + " AND {r}.KeyDate IS NOT NULL AND {r}.DecisionReserved <> 1)"
_to_decide = "(" + _codes({37: [0], 38: [0]}) + " AND {r}.KeyDate IS NOT NULL AND {r}.DecisionReserved = 1)"
_reheard = "(" + _codes({46: [86], 39: [86]}) + " OR ({r}.CaseStatus = 46 AND {r}.Outcome = 1 AND sa.CaseStatus <> 10))"
_decided = "(" + _codes(DECIDED) + " OR ({r}.CaseStatus = 46 AND {r}.Outcome = 31 AND sa.CaseStatus IN (37, 38)))"
_permission = "(" + _codes(PERMISSION_DECIDED) + " OR ({r}.CaseStatus = 46 AND {r}.Outcome = 31 AND sa.CaseStatus = 39))"
_ended = "(" + _codes(ENDED_EARLY) + " OR ({r}.CaseStatus = 46 AND {r}.Outcome = 31 AND sa.CaseStatus IN (10, 51, 52)))"

STATE_RULES: list[tuple[str, str]] = [
    ("paymentPending", f"{one_of('ac.CasePrefix', PAID_PREFIXES)} AND {_now_or_held(_early)} AND {_few_documents} AND bd.balance > 0"),
    ("appealSubmitted", f"{_no_fee_due} AND {_now_or_held(_early)} AND {_few_documents}"),
    ("awaitingRespondentEvidence(a)", f"{_now_or_held(_early)} AND {_evidence_due}"),
    ("awaitingRespondentEvidence(b)", f"{_now_or_held(_early_open)} AND {_evidence_in}"),
    ("caseUnderReview", f"{_under_review} AND r.Representation = 'LR'"),
    ("reasonsForAppealSubmitted", f"{_under_review} AND r.Representation = 'AIP'"),
    ("listing", _now_or_held(_listing)),
    ("prepareForHearing", _now_or_held(_to_hear)),
    ("decision", _now_or_held(_to_decide)),
    ("decided(b)", _now_or_held(_reheard)),
    ("ftpaSubmitted(a)", _now_or_held("({r}.CaseStatus = 39 AND {r}.Outcome = 0 AND {r}.AdjudicatorId = 0)")),
    ("ftpaSubmitted(b)", _now_or_held("({r}.CaseStatus = 39 AND {r}.Outcome = 0 AND {r}.AdjudicatorId <> 0)")),
    ("decided(a)", f"({_decided.replace('{r}', 't')} OR ({SHUT} AND ({_decided.replace('{r}', 'st')} OR st.CaseStatus = 17)))"),
    ("ftpaDecided", _now_or_held(_permission, SHUT)),
    ("ended", f"({_ended.replace('{r}', 't')} OR {pair('t.', CLOSED_51)} OR {pair('t.', COST)} OR ({HELD} AND ({_ended.replace('{r}', 'st')} OR st.CaseStatus = 51)))"),
    ("remitted", "t.CaseStatus IN (40, 41, 42, 43, 44, 53) AND t.Outcome = 86"),
]

UPPER_NOW = f"t.CaseStatus IN {UPPER}"
MAIN_OR_DROPPED = f"({one_of('ac.CasePrefix', MAIN_PREFIXES)} OR ({one_of('ac.CasePrefix', DROPPED_PREFIXES)} AND ac.HOANRef IS NULL))"
DROPPED = one_of("ac.CasePrefix", DROPPED_PREFIXES)
DROPPED_RECENT = (
    f"({one_of('ac.CasePrefix', DROPPED_PREFIXES)} AND ac.HOANRef IS NOT NULL AND us.CaseStatus IS NOT NULL AND "
    "CAST(us.DecisionDate AS DATE) + INTERVAL 60 MONTH < CAST(t.DecisionDate AS DATE) + INTERVAL 24 MONTH)"
)
OPEN = f"(t.CaseStatus IS NULL OR {pair('t.', OPEN_STATUSES)} OR (t.CaseStatus IN (52, 36) AND t.Outcome = 0 AND st.DecisionDate IS NULL))"
FINISHED = f"({_decided.replace('{r}', 't')} OR {_permission.replace('{r}', 't')} OR {_ended.replace('{r}', 't')} OR {pair('t.', CLOSED_51)} OR {pair('t.', COST)})"
FINISHED_BEFORE = (
    f"({_decided.replace('{r}', 'st')} OR {_permission.replace('{r}', 'st')} OR {_ended.replace('{r}', 'st')} OR st.CaseStatus IN (17, 51))"
)


LIVE = "Live"


def segment_rules(as_of: str, live: str = LIVE) -> list[tuple[str, str]]:
    """Retention segments; decided cases stay live for six months after the decision.

    ``live`` is the label of the cases that move to the live case system.
    """
    recent = "CAST({r}.DecisionDate AS DATE) + INTERVAL 6 MONTH >= DATE '" + as_of + "'"
    main_first = f"(({one_of('ac.CasePrefix', MAIN_PREFIXES)} AND us.CaseStatus IS NULL) OR ({one_of('ac.CasePrefix', DROPPED_PREFIXES)} AND ac.HOANRef IS NULL) OR {DROPPED_RECENT})"
    return [
        (live, f"{UPPER_NOW} AND t.Outcome = 86"),
        ("UT Active", f"{UPPER_NOW} AND t.Outcome = 0"),
        ("UT Overdue", f"{one_of('ac.CasePrefix', OVERDUE_PREFIXES)} AND {UPPER_NOW}"),
        ("FT Overdue", one_of("ac.CasePrefix", OVERDUE_PREFIXES)),
        (live, f"(us.CaseStatus IS NOT NULL OR {MAIN_OR_DROPPED}) AND {OPEN}"),
        (live, f"({MAIN_OR_DROPPED} OR {DROPPED_RECENT}) AND {FINISHED} AND {recent.replace('{r}', 't')}"),
        (live, f"{main_first} AND {SHUT} AND {FINISHED_BEFORE} AND {recent.replace('{r}', 'st')}"),
    ]


# Names under which a party counts as unrepresented (fixed values).
UNREPRESENTED = [
    "%no rep%", "%no  rep%", "%No rep%", "%No Rep%", "%NO REP%", "none", "%unrepresented%", "%self%",
    "%not rep%", "%not  rep%", "-", "%(spo%", "%spons%",
]
UNREPRESENTED_ID = 957


def representation(representatives: DataFrame) -> DataFrame:
    """AIP without a representative, else LR."""
    alone = (
        (F.col("RepresentativeId") == UNREPRESENTED_ID)
        | F.col("RepresentativeId").isNull()
        | projection.match_any(F.col("Name"), UNREPRESENTED)
    )
    return representatives.select(KEY, F.when(alone, "AIP").otherwise("LR").alias("Representation"))


def last_document(documents: DataFrame) -> DataFrame:
    return ranking.latest(documents, [KEY], ["ReceivedDocumentId", "DateReceived"])


def segmentation(
    tables: CaseTables, documents: DataFrame, locations: DataFrame, represented: DataFrame, as_of: str
) -> DataFrame:
    """Target state and segment per case.

    The four status rows come from one aggregate. A case without a file location is left out, as is one
    in the two archive departments (519, 520).
    """
    as_struct = lambda df, name: df.select(KEY, F.struct(*[c for c in df.columns if c != KEY]).alias(name))
    rows = status_summary(tables.statuses, {v: STATE_FIELDS for v in ("t", "st", "us", "sa")})
    rows = rows.select(KEY, *[F.col(f"s_{v}").alias(v) for v in ("t", "st", "us", "sa")])
    cases = tables.header.filter(F.col("CaseType") == 1).select(KEY, F.struct("CasePrefix", "HOANRef").alias("ac"))
    wide = joins.assemble(
        cases,
        [
            rows,
            as_struct(last_document(documents), "dr"),
            as_struct(money_summary(tables.transactions).select(KEY, "balance"), "bd"),
            as_struct(represented, "r"),
        ],
        KEY,
    )
    live = locations.filter(~F.col("DeptId").isin(519, 520)).select(KEY)
    wide = joins.restrict(wide, live, KEY)
    return projection.classify_many(
        wide,
        {
            "TargetState": ([(n, F.expr(c)) for n, c in STATE_RULES], UNASSIGNED),
            "HighLevelSegment": ([(n, F.expr(c)) for n, c in segment_rules(as_of)], "Other"),
        },
    ).select(KEY, "TargetState", "HighLevelSegment")


def live_cases(segments: DataFrame, live: str = LIVE) -> DataFrame:
    return segments.filter(F.col("HighLevelSegment") == live)
