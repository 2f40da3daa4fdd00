"""SQL for states, segments, archive categories and kinds of decision, written apart from the rules they check.

Codes are a table of (kind, status, outcome); ``ct`` and ``cs`` are its entries for the current and the earlier
status row. Nothing here is taken from ``docketry.cases``.
"""

from __future__ import annotations

# Outcomes by kind and status.
CODES = """codes AS (SELECT status, outcome, list(kind) AS kinds FROM (
      SELECT 'held' AS kind, unnest([50, 52, 36]) AS status, 0 AS outcome
      UNION ALL SELECT 'early', 10, unnest([0, 82, 99, 104, 109, 121])
      UNION ALL SELECT 'first', 10, 0
      UNION ALL SELECT 'due', 10, unnest([82, 99, 104, 109, 121])
      UNION ALL SELECT 'review', 26, unnest([0, 27, 39, 50, 89])
      UNION ALL SELECT 'list', 26, unnest([40, 52])
      UNION ALL SELECT 'list', 37, unnest([5, 27, 37, 39, 40, 50])
      UNION ALL SELECT 'list', 38, unnest([5, 27, 37, 39, 40, 50])
      UNION ALL SELECT 'hear', unnest([37, 38]), 0
      UNION ALL SELECT 'rehear', unnest([39, 46]), 86
      UNION ALL SELECT 'apply', 39, 0
      UNION ALL SELECT 'decide', unnest([26, 37, 38]), 1
      UNION ALL SELECT 'decide', unnest([26, 37, 38]), 2
      UNION ALL SELECT 'decide', 39, unnest([25, 80])
      UNION ALL SELECT 'permit', 39, unnest([14, 30, 31])
      UNION ALL SELECT 'end', 10, unnest([2, 13, 25, 80, 105, 119, 120, 122])
      UNION ALL SELECT 'end', 26, unnest([13, 25, 80])
      UNION ALL SELECT 'end', 37, unnest([13, 25, 72, 80, 125])
      UNION ALL SELECT 'end', 38, unnest([13, 25, 72, 80, 125])
      UNION ALL SELECT 'close', 51, unnest([93, 94])
      UNION ALL SELECT 'cost', 52, unnest([91, 95])
      UNION ALL SELECT 'cost', 36, unnest([1, 2, 25])
      UNION ALL SELECT 'set aside', 46, 1
      UNION ALL SELECT 'refuse set aside', 46, 31
      UNION ALL SELECT 'open', 10, unnest([0, 27, 39, 82, 99, 104, 109, 121])
      UNION ALL SELECT 'open', 46, unnest([1, 86])
      UNION ALL SELECT 'open', 26, unnest([0, 27, 39, 40, 50, 52, 89])
      UNION ALL SELECT 'open', 37, unnest([0, 5, 27, 37, 39, 40, 50, 52])
      UNION ALL SELECT 'open', 38, unnest([0, 5, 27, 37, 39, 40, 50, 52])
      UNION ALL SELECT 'open', 39, unnest([0, 86])
      UNION ALL SELECT 'open', 50, 0
    ) GROUP BY 1, 2)"""
JOIN_CODES = """LEFT JOIN codes ct ON ct.status = t.CaseStatus AND ct.outcome = t.Outcome
   LEFT JOIN codes cs ON cs.status = st.CaseStatus AND cs.outcome = st.Outcome"""


def now(kind: str) -> str:
    return f"coalesce(list_contains(ct.kinds, '{kind}'), false)"


def before(kind: str) -> str:
    return f"coalesce(list_contains(cs.kinds, '{kind}'), false)"


_MAIN = "CasePrefix IN ('DA', 'DC', 'EA', 'HU', 'PA', 'RP')"
_SMALL = "CasePrefix IN ('IA', 'LD', 'LE', 'LH', 'LP', 'LR')"
_OLD = "CasePrefix IN ('AA', 'AS', 'CC', 'HR', 'HX', 'IM', 'NS', 'OA', 'OC', 'RD', 'TH', 'VA', 'XX')"
_UPPER = "t.CaseStatus IN (27, 28, 29, 32, 33, 34, 40, 41, 42, 43, 44, 45, 53)"
_FEE = "CasePrefix IN ('EA', 'HU')"
_NO_FEE = "CasePrefix IN ('DA', 'DC', 'IA', 'LD', 'LE', 'LH', 'LP', 'LR', 'PA', 'RP')"
_SHUT = f"({now('held')} OR {now('cost')})"

# Whether the case waits at its first status, now or behind a row that only holds it.
_STARTING = f"""(t.CaseStatus IS NULL OR {now('early')} OR ({now('set aside')} AND sa.CaseStatus = 10)
    OR ({now('held')} AND (st.CaseStatus IS NULL OR {before('early')} OR ({before('set aside')} AND sa.CaseStatus = 10))))"""
_STARTED = f"""(t.CaseStatus IS NULL OR {now('first')} OR ({now('set aside')} AND sa.CaseStatus = 10)
    OR ({now('held')} AND (st.CaseStatus IS NULL OR {before('first')} OR ({before('set aside')} AND sa.CaseStatus = 10))))"""
_REVIEWED = f"""(({now('due')} AND dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NOT NULL) OR {now('review')}
    OR ({now('held')} AND {before('review')} AND dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NOT NULL))"""


def _both(condition: str, gate: str = now("held")) -> str:
    """A condition with ``@`` for the row and ``#kind#`` for its codes, on the current row or the one before."""
    out = []
    for row, find in (("t", now), ("st", before)):
        pieces = condition.split("#")
        out.append("".join(find(p) if i % 2 else p.replace("@", row) for i, p in enumerate(pieces)))
    return f"(({out[0]}) OR ({gate} AND ({out[1]})))"


_DECIDED = "#decide# OR (#refuse set aside# AND sa.CaseStatus IN (37, 38))"
_PERMITTED = "#permit# OR (#refuse set aside# AND sa.CaseStatus = 39)"
_ENDED = "#end# OR (#refuse set aside# AND sa.CaseStatus IN (10, 51, 52))"


def _one(condition: str, row: str) -> str:
    find = now if row == "t" else before
    return "(" + "".join(find(p) if i % 2 else p for i, p in enumerate(condition.split("#"))) + ")"


STATE = f"""CASE
    WHEN {_FEE} AND {_STARTING} AND (dr.ReceivedDocumentId <= 2 OR dr.ReceivedDocumentId IS NULL) AND bd.balance > 0 THEN 'paymentPending'
    WHEN (({_FEE} AND coalesce(bd.balance, 0) <= 0) OR {_NO_FEE}) AND {_STARTING} AND (dr.ReceivedDocumentId <= 2 OR dr.ReceivedDocumentId IS NULL) THEN 'appealSubmitted'
    WHEN {_STARTING} AND dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NULL THEN 'awaitingRespondentEvidence(a)'
    WHEN {_STARTED} AND dr.ReceivedDocumentId = 3 AND dr.DateReceived IS NOT NULL THEN 'awaitingRespondentEvidence(b)'
    WHEN {_REVIEWED} AND r.Representation = 'LR' THEN 'caseUnderReview'
    WHEN {_REVIEWED} AND r.Representation = 'AIP' THEN 'reasonsForAppealSubmitted'
    WHEN {_both('#list# OR (#hear# AND @.KeyDate IS NULL)')} THEN 'listing'
    WHEN {_both('#hear# AND @.KeyDate IS NOT NULL AND @.DecisionReserved <> 1')} THEN 'prepareForHearing'
    WHEN {_both('#hear# AND @.KeyDate IS NOT NULL AND @.DecisionReserved = 1')} THEN 'decision'
    WHEN {_both('#rehear# OR (#set aside# AND sa.CaseStatus <> 10)')} THEN 'decided(b)'
    WHEN {_both('#apply# AND @.AdjudicatorId = 0')} THEN 'ftpaSubmitted(a)'
    WHEN {_both('#apply# AND @.AdjudicatorId <> 0')} THEN 'ftpaSubmitted(b)'
    WHEN {_one(_DECIDED, 't')} OR ({_SHUT} AND ({_one(_DECIDED, 'st')} OR st.CaseStatus = 17)) THEN 'decided(a)'
    WHEN {_both(_PERMITTED, _SHUT)} THEN 'ftpaDecided'
    WHEN {_one(_ENDED, 't')} OR {now('close')} OR {now('cost')} OR ({now('held')} AND ({_one(_ENDED, 'st')} OR st.CaseStatus = 51)) THEN 'ended'
    WHEN t.CaseStatus IN (40, 41, 42, 43, 44, 53) AND t.Outcome = 86 THEN 'remitted'
    ELSE 'Not Sure' END"""

_RECENT_SMALL = f"""({_SMALL} AND HOANRef IS NOT NULL AND us.CaseStatus IS NOT NULL
    AND CAST(us.DecisionDate AS DATE) + INTERVAL 60 MONTH < CAST(t.DecisionDate AS DATE) + INTERVAL 24 MONTH)"""
_KEEP = f"({_MAIN} OR ({_SMALL} AND HOANRef IS NULL))"
_IS_OPEN = f"(t.CaseStatus IS NULL OR {now('open')} OR (t.CaseStatus IN (36, 52) AND t.Outcome = 0 AND st.DecisionDate IS NULL))"
_DONE = f"({_one(_DECIDED, 't')} OR {_one(_PERMITTED, 't')} OR {_one(_ENDED, 't')} OR {now('close')} OR {now('cost')})"
_DONE_BEFORE = f"({_one(_DECIDED, 'st')} OR {_one(_PERMITTED, 'st')} OR {_one(_ENDED, 'st')} OR st.CaseStatus IN (17, 51))"
_MAIN_FIRST = f"(({_MAIN} AND us.CaseStatus IS NULL) OR ({_SMALL} AND HOANRef IS NULL) OR {_RECENT_SMALL})"


def _within(row: str, months: int, as_of: str, sign: str = ">=") -> str:
    return f"CAST({row}.DecisionDate AS DATE) + INTERVAL {months} MONTH {sign} DATE '{as_of}'"


def segment(as_of: str, live: str) -> str:
    return f"""CASE
    WHEN {_UPPER} AND t.Outcome = 86 THEN '{live}'
    WHEN {_UPPER} AND t.Outcome = 0 THEN 'UT Active'
    WHEN {_OLD} AND {_UPPER} THEN 'UT Overdue'
    WHEN {_OLD} THEN 'FT Overdue'
    WHEN (us.CaseStatus IS NOT NULL OR {_KEEP}) AND {_IS_OPEN} THEN '{live}'
    WHEN ({_KEEP} OR {_RECENT_SMALL}) AND {_DONE} AND {_within('t', 6, as_of)} THEN '{live}'
    WHEN {_MAIN_FIRST} AND {_SHUT} AND {_DONE_BEFORE} AND {_within('st', 6, as_of)} THEN '{live}'
    ELSE 'Other' END"""


def category(as_of: str) -> str:
    later = "CAST(us.DecisionDate AS DATE) + INTERVAL 60 MONTH >= CAST({r}.DecisionDate AS DATE) + INTERVAL 24 MONTH"
    upper = (
        f"us.CaseStatus IS NOT NULL AND ((t.CaseStatus NOT IN (36, 52) AND {later.format(r='t')})"
        f" OR (t.CaseStatus IN (36, 52) AND {later.format(r='st')}))"
    )
    first = f"""({_MAIN_FIRST} OR ({_MAIN} AND us.CaseStatus IS NOT NULL
        AND CAST(us.DecisionDate AS DATE) + INTERVAL 60 MONTH < CAST(t.DecisionDate AS DATE) + INTERVAL 24 MONTH))"""
    return f"""CASE
    WHEN {_UPPER} AND t.Outcome = 86 THEN 'UT Remitted'
    WHEN {_UPPER} AND t.Outcome = 0 THEN 'UT Active'
    WHEN {_OLD} AND {_UPPER} THEN 'UT Overdue'
    WHEN {_OLD} THEN 'FT'
    WHEN {upper} AND {_within('us', 60, as_of)} THEN 'UT Retained'
    WHEN {upper} AND {_within('us', 60, as_of, '<')} THEN 'UT Overdue'
    WHEN (us.CaseStatus IS NOT NULL OR {_KEEP}) AND {_IS_OPEN} THEN 'FT Active'
    WHEN ({_KEEP} OR {_RECENT_SMALL}) AND {_DONE} AND {_within('t', 6, as_of)} THEN 'FT Live'
    WHEN ({_KEEP} OR {_RECENT_SMALL}) AND {_SHUT} AND {_DONE_BEFORE} AND {_within('st', 6, as_of)} THEN 'FT Live'
    WHEN {first} AND {_DONE} AND t.DecisionDate IS NOT NULL THEN 'FT'
    WHEN {first} AND {_SHUT} AND {_DONE_BEFORE} AND st.DecisionDate IS NOT NULL THEN 'FT'
    WHEN CasePrefix = 'IA' AND t.CaseStatus IN (30, 31) THEN 'FT'
    WHEN {_SMALL} AND HOANRef IS NOT NULL AND us.CaseStatus IS NULL THEN 'FT'
    ELSE 'Not sure?' END"""


def decision_kind(as_of: str) -> str:
    return f"""CASE
    WHEN {_UPPER} AND t.Outcome IN (0, 86) THEN 'UT Active'
    WHEN DeptId IN (519, 520) OR {_OLD} THEN 'Decision'
    WHEN (us.CaseStatus IS NOT NULL OR {_KEEP}) AND {_IS_OPEN} THEN 'FT Active'
    WHEN ({_KEEP} OR {_RECENT_SMALL}) AND {_DONE} AND {_within('t', 6, as_of)} THEN 'FT Live'
    WHEN {_MAIN_FIRST} AND {_SHUT} AND {_DONE_BEFORE} AND {_within('st', 6, as_of)} THEN 'FT Live'
    WHEN {_SMALL} AND (HOANRef IS NULL OR us.CaseStatus IS NOT NULL) THEN 'Decision'
    WHEN {_SMALL} THEN 'Skeleton'
    ELSE 'Decision' END"""
