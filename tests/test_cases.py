"""Case base, state rules, content and payloads on hand-made and derived cases."""

from __future__ import annotations

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketry.cases import archive, base, fields, payloads, states, wide
from docketry.functions import arrays
from docketry.operators import documents, joins, quality
from docketry.plans import archives
from docketry.plans.casework_tables import case_tables
from docketry.sources import scratch

SF = "/root/testdata/sf0.001"
STATUS = "CaseNo string, StatusId long, CaseStatus int, Outcome int, KeyDate timestamp, DecisionReserved int, AdjudicatorId int, DecisionDate timestamp"
DAY = datetime(2024, 1, 1)


def state_of(spark, rows, prefix="PA", balance=None, document=None, received=None, representation="LR"):
    """The target state of one case with the given (status id, status, outcome) rows."""
    full = [("C/1", i, s, o, DAY, 0, 0, DAY) if len(r) == 3 else ("C/1", *r) for r in rows for i, s, o in [r[:3]]]
    header = spark.createDataFrame([("C/1", 1, prefix, None)], "CaseNo string, CaseType int, CasePrefix string, HOANRef string")
    amount = [("C/1", 1, 1, balance, None, True, False, False, 0)] if balance is not None else []
    money = spark.createDataFrame(
        amount,
        "CaseNo string, TransactionId long, TransactionTypeId int, Amount double, ReferringTransactionId long, "
        "SumBalance boolean, SumTotalPay boolean, SumTotalFee boolean, Status int",
    )
    docs = spark.createDataFrame(
        [("C/1", document, received)] if document else [], "CaseNo string, ReceivedDocumentId int, DateReceived timestamp"
    )
    places = spark.createDataFrame([("C/1", 1)], "CaseNo string, DeptId int")
    rep = spark.createDataFrame([("C/1", representation)], "CaseNo string, Representation string")
    tables = base.CaseTables(header, statuses=spark.createDataFrame(full, STATUS), transactions=money)
    out = states.segmentation(tables, docs, places, rep, "2024-02-01").collect()
    assert len(out) == 1
    return out[0]["TargetState"], out[0]["HighLevelSegment"]


@pytest.mark.parametrize(
    ("rows", "options", "state"),
    [
        ([(1, 10, 0)], {"prefix": "EA", "balance": 5.0}, "paymentPending"),
        ([], {"prefix": "EA", "balance": 5.0}, "paymentPending"),
        ([(1, 10, 0)], {"prefix": "EA", "balance": 0.0}, "appealSubmitted"),
        ([(1, 10, 109)], {}, "appealSubmitted"),
        ([(1, 10, 0), (2, 50, 0)], {}, "appealSubmitted"),
        ([(1, 10, 0)], {"document": 3}, "awaitingRespondentEvidence(a)"),
        ([(1, 10, 0)], {"document": 3, "received": DAY}, "awaitingRespondentEvidence(b)"),
        ([(1, 10, 121)], {"document": 3, "received": DAY}, "caseUnderReview"),
        ([(1, 26, 0)], {}, "caseUnderReview"),
        ([(1, 26, 0)], {"representation": "AIP"}, "reasonsForAppealSubmitted"),
        ([(1, 26, 40)], {}, "listing"),
        ([(1, 37, 0)], {}, "prepareForHearing"),
        ([(1, 37, 0, DAY, 1, 0, DAY)], {}, "decision"),
        ([(1, 37, 0, None, 1, 0, DAY)], {}, "listing"),
        ([(1, 37, 1)], {}, "decided(a)"),
        ([(1, 37, 1), (2, 46, 86)], {}, "decided(b)"),
        ([(1, 39, 0)], {}, "ftpaSubmitted(a)"),
        ([(1, 39, 0, DAY, 0, 7, DAY)], {}, "ftpaSubmitted(b)"),
        ([(1, 39, 30)], {}, "ftpaDecided"),
        ([(1, 39, 30), (2, 52, 91)], {}, "ftpaDecided"),
        ([(1, 10, 80)], {}, "ended"),
        ([(1, 52, 91)], {}, "ended"),
        ([(1, 43, 86)], {}, "remitted"),
        ([(1, 37, 1), (2, 17, 0), (3, 38, 111)], {}, "decided(a)"),
        ([(1, 99, 5)], {}, "Not Sure"),
    ],
)
def test_target_state(spark, rows, options, state):
    assert state_of(spark, rows, **options)[0] == state


def test_segment_follows_the_date(spark):
    assert state_of(spark, [(1, 37, 1)])[1] == "Live"
    old = datetime(2020, 1, 1)
    assert state_of(spark, [(1, 37, 1, DAY, 0, 0, old)])[1] == "Other"
    assert state_of(spark, [(1, 43, 86)])[1] == "Live"
    assert state_of(spark, [(1, 43, 0)])[1] == "UT Active"
    assert state_of(spark, [(1, 10, 80)], prefix="VA")[1] == "FT Overdue"


def test_money_summary(spark):
    schema = (
        "CaseNo string, TransactionId long, TransactionTypeId int, Amount double, ReferringTransactionId long, "
        "SumBalance boolean, SumTotalPay boolean, SumTotalFee boolean, Status int"
    )
    rows = [
        ("a", 1, 1, 140.0, None, True, False, True, 0),
        ("a", 2, 3, -140.0, None, True, True, False, 0),
        ("a", 3, 6, 140.0, 2, True, False, False, 0),
        ("a", 4, 5, -80.0, None, False, False, False, 0),
        ("a", 5, 5, -10.0, None, False, False, False, 3),
    ]
    row = base.money_summary(spark.createDataFrame(rows, schema)).first()
    # The reversed payment 2 does not count for the balance, its reversal does.
    assert float(row["balance"]) == 280.0 and row["last_counted"]["TransactionTypeId"] == 6
    assert float(row["paid"]) == 140.0 and row["has_payment"] is True
    assert float(row["remitted"]) == 80.0 and float(row["left_to_pay"]) == 140.0


def test_ended_needs_an_early_status_for_a_refused_set_aside(spark):
    rows = [("a", 1, 37, 80), ("a", 2, 46, 31), ("b", 1, 10, 0), ("b", 2, 46, 31), ("c", 1, 37, 1)]
    df = spark.createDataFrame(rows, "CaseNo string, StatusId long, CaseStatus int, Outcome int")
    got = {r["CaseNo"]: r["s_ended"] and r["s_ended"]["CaseStatus"] for r in base.status_summary(df, {"ended": ["CaseStatus", "Outcome"]}).collect()}
    # A case without any row of interest is left to the outer join.
    assert got == {"a": 37, "b": 46}


def test_main_party_is_one_row(spark):
    df = spark.createDataFrame([("a", None, "B"), ("a", None, "A"), ("a", "Child", "C")], "CaseNo string, Relationship string, Appellant_Name string")
    assert [tuple(r) for r in base.main_party(df).collect()] == [("a", "A")]


def test_hearing_centre_order(spark):
    centres = spark.createDataFrame(
        [(1, "P1", None, "direct"), (13, "P2", "by history", "x"), (77, "Place", "by history", "byPlace")],
        "CentreId int, prevFileLocation string, Conditions string, hearingCentre string",
    )
    rows = [
        ("a", 1, None, None, None, None), ("b", 13, "Place", None, None, None), ("c", 13, None, "M1 1AA", None, None),
        ("d", 13, "Loughborough", None, None, "zz1"), ("e", 13, "Field House", "M1 1AA", None, None),
    ]
    df = spark.createDataFrame(rows, "CaseNo string, CentreId int, prev_location string, Rep_Postcode string, CaseRep_Postcode string, Appellant_Postcode string")
    got = {r["CaseNo"]: r["hearingCentre"] for r in fields.hearing_centre(df, centres, ["hearingCentre"]).collect()}
    assert got == {"a": "direct", "b": "byPlace", "c": "manchester", "d": "newport", "e": None}


def test_state_tables_are_complete(spark):
    for state in [*payloads.PREVIOUS, "paymentPending"]:
        assert payloads.rules(state)
        assert len(payloads.defaults(state, "X")) >= 26
    assert set(payloads.rules("paymentPending")) < set(payloads.rules("ended"))
    assert len(fields.AREA_TO_CENTRE) == sum(len(a) for a in fields.CENTRE_AREAS.values())


BROKEN = {
    "isAppellantAttendingTheHearing": ("'No'", "valid_isAppellantAttendingTheHearing"),
    "isInterpreterServicesNeeded": ("IF(Interpreter = 1, 'No', 'Yes')", "valid_isInterpreterServicesNeeded"),
    "singleSexCourtTypeDescription": ("IF(CourtPreference IN (1, 2), NULL, 'x')", "valid_singleSexCourtTypeDescription"),
    "inCameraCourt": ("NULL", "valid_inCameraCourt"),
    "pastExperiencesDescription": ("NULL", "valid_pastExperiencesDescription"),
    "hearingCentre": ("'elsewhere'", "valid_hearingCentre_known"),
    "applicationOutOfTimeExplanation": ("IF(applicationOutOfTimeExplanation IS NULL, 'x', NULL)", "valid_applicationOutOfTimeExplanation"),
    "isServiceRequestTabVisibleConsideringRemissions": ("NULL", "valid_serviceRequestTab"),
    "amendResponseActionAvailable": ("'No'", "valid_amendResponseActionAvailable_default"),
    "hearingRequirements": ("ARRAY('x')", "valid_hearingRequirements_empty"),
    "outOfTimeDecisionMaker": ("IF(outOfTimeDecisionMaker IS NULL, 'x', NULL)", "valid_outOfTimeDecision_whole"),
}


def test_rules_notice_broken_fields(spark):
    good = payloads.checked(archives.state_base(spark, SF, "listing"), "listing", archives.CONTEXT).cache()
    rules = payloads.rules("listing", archives.CONTEXT.system)
    total = good.count()
    before = {r["rule"]: r["failed"] for r in quality.rule_counts(good, rules).collect()}
    bad = good.withColumns({name: F.expr(value) for name, (value, _) in BROKEN.items()})
    after = {r["rule"]: r["failed"] for r in quality.rule_counts(bad, rules).collect()}
    for _, rule in BROKEN.values():
        assert before[rule] == 0 and after[rule] == total, rule
    assert set(before) == set(rules) and sum(before[r] for r in rules if r.endswith(("_default", "_empty"))) == 0
    good.unpersist()


@pytest.mark.parametrize("state", ["paymentPending", "caseUnderReview", "reasonsForAppealSubmitted", "decided(b)", "remitted", "ended"])
def test_payload_of_every_state(spark, state):
    rows = archives.state_payloads(spark, SF, state).orderBy("CaseNo").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/orders.parquet").count()
    for row in rows[:20]:
        content = json.loads(row["content"])
        assert content["isIntegrated"] == "Yes"
        assert content["legacyMigrationTaskDueDays"] == "14"
        folder = "/JSON/" if row["is_valid"] else "/INVALID_JSON/"
        assert folder in row["file_name"] and bool(row["failed_rules"]) != row["is_valid"]
    assert any(r["is_valid"] for r in rows) or state in ("ended",)


def test_bail_lists(spark):
    cases = spark.createDataFrame([(c,) for c in "abcd"], "CaseNo string")
    statuses = spark.createDataFrame(
        [("a", 1, 4, datetime(2024, 1, 1)), ("b", 1, 4, datetime(2000, 1, 1)), ("b", 2, 17, DAY)],
        "CaseNo string, StatusId long, CaseStatus int, DecisionDate timestamp",
    )
    places = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, "was destroyed"), ("d", 519, None)], "CaseNo string, DeptId int, Note string")
    history = spark.createDataFrame([("a", "for indefinite retention"), ("a", "moved"), ("c", "x")], "CaseNo string, Comment string")
    got = sorted(tuple(r) for r in archive.bail_segments(cases, statuses, places, history, "2024-02-01").collect())
    assert got == [("a", "BailLegalHold"), ("a", "Normal Bail")]


def test_case_base_has_one_row_per_case(spark):
    tables = case_tables(spark, SF, "people", "statuses", "categories", "transactions", "judges", "history", "refs")
    df = base.case_base(tables, {"any": ["Outcome"]})
    assert df.groupBy("CaseNo").count().filter("count > 1").count() == 0
    assert df.count() == tables.header.count()


def test_set_aside_names_only_excluded_judges(spark):
    rows = [("a", "Low", "Al", "Mr", False), ("a", "Hay", "Bo", "Ms", True), ("a", "Low", "Al", "Mr", False), ("b", "Kay", "Cy", None, None)]
    df = spark.createDataFrame(rows, "CaseNo string, Judge_Surname string, Judge_Forenames string, Judge_Title string, Required boolean")
    got = {r["CaseNo"]: (r["judge_lines"], r["excluded_judges"]) for r in base.judge_texts(df).collect()}
    assert got["a"] == ("Hay Bo ( Ms ) : Required\nLow Al ( Mr ) : Not Required", "Low, Al (Mr)")
    assert got["b"] == ("Kay Cy", None)


def test_retention_of_an_adjourned_case(spark):
    cases = spark.createDataFrame([("a", "R1")], "CaseNo string, HORef string")
    people = spark.createDataFrame(
        [("a", "Jo", "Doe", datetime(1990, 1, 1), "M1")], "CaseNo string, Appellant_Forenames string, Appellant_Name string, BirthDate timestamp, Appellant_Postcode string"
    )
    statuses = spark.createDataFrame(
        [("a", 1, datetime(2020, 5, 1), 10, 80), ("a", 2, None, 4, 38)], "CaseNo string, StatusId long, DecisionDate timestamp, CaseStatus int, Outcome int"
    )
    pairs = spark.createDataFrame([(10, 80)], "s int, o int")
    segment = spark.createDataFrame([("a", "S")], "CaseNo string, Segment string")
    row = archive.retention_metadata(cases, people, statuses.withColumn("DecisionDate", F.col("DecisionDate").cast("timestamp_ntz")), pairs, segment, "2024-01-31", "P", "GBR", "T").first()
    assert row["event_date"] == "2020-05-01T00:00:00Z" and row["record_class"] == "S"


def test_hearings_do_not_fan_out(spark):
    rows = {
        "statuses": ("StatusId int, CaseNo string, AdjudicatorId int, DeterminationBy int", [(1, "a", 5, 6), (2, "a", None, None)]),
        "placements": ("StatusId int, ListId int, TimeEstimate int", [(1, 10, 30)]),
        "lists": ("ListId int, ListTypeId int, CourtId int", [(10, 1, 1)]),
        "courts": ("CourtId int, CourtName string", [(1, "One")]),
        "sittings": ("ListId int, Position int, Cancelled int, AdjudicatorId int", [(10, 10, 0, 7), (10, 10, 0, 6), (10, 11, 1, 5), (10, 3, 0, 5)]),
        "officers": ("AdjudicatorId int, Surname string", [(5, "Five"), (6, "Six"), (7, "Seven")]),
    }
    df = wide.hearings(**{n: spark.createDataFrame(r, s) for n, (s, r) in rows.items()})
    got = df.select("StatusId", "court", "allocated", "chair", "second", "clerk", "decided_by").collect()
    assert sorted(tuple(r) for r in got) == [(1, "One", "Five", "Six", None, "Five", "Six"), (2, None, None, None, None, None, None)]


def test_rows_without_a_reference_are_spread(spark):
    """Rows that refer to nothing do not meet in one task, and are all kept beside those with and without a partner."""
    rows = spark.range(4000).selectExpr("id", "IF(id % 4 = 0, id % 40, NULL) AS ref")
    side = spark.range(0, 40, 8).selectExpr("id AS k", "concat('n', id) AS n")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = [tuple(r) for r in wide.follow(rows, "ref", side, "k", {"n": "name"}).withColumn("task", F.spark_partition_id()).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r[0] for r in got) == list(range(4000)) and all(r[2] == (f"n{r[1]}" if r[1] is not None and r[1] % 8 == 0 else None) for r in got)
    assert len({r[3] for r in got if r[1] is None}) > 2


def test_bench_leaves_out_barred_officers(spark):
    assigned = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "CaseNo string, AdjudicatorId int")
    officers = spark.createDataFrame([(1, "One", 0), (2, "Two", 1)], "AdjudicatorId int, Surname string, DoNotList int")
    assert [(r["CaseNo"], r["judge"]) for r in wide.bench(assigned, officers).collect()] == [("a", "One")]


def _hearings(spark):
    """Status rows and sittings: a chain, a loop, a parent that is not there, a repeated and a missing id, no number, and many rows."""
    rows = [
        ("a", 1, "2020-01-01", "X", None, None), ("a", 2, "2020-01-02", None, "C", 1), ("a", 3, "2020-01-03", None, None, 2), ("a", 4, None, "Y", None, 99),
        ("loop", 1, "2020-02-01", "X", None, 2), ("loop", 2, "2020-02-02", None, None, 1), ("loop", 3, "2020-02-03", None, None, 2),
        ("twice", 1, "2020-03-01", "X", None, None), ("twice", 2, "2020-03-02", None, "D", 1), ("twice", 2, "2020-03-02", None, "D", 1),
        ("hole", None, "2020-04-01", "X", None, None), ("hole", 5, "2020-04-02", None, None, None), (None, 7, "2020-05-01", "X", None, None),
        ("benches", 1, "2020-06-01", "X", None, None),
        *[("long", i, f"2021-01-{1 + i % 28:02d}", "L" if i % 9 == 0 else None, None, i - 1 if i else None) for i in range(archive.SHORT + 20)],
    ]
    statuses = spark.createDataFrame(rows, "CaseNo string, StatusId long, DateReceived string, HearingCentre string, CourtName string, ParentStatusId long")
    sat = [("a", 2, 10, "J1"), ("a", 2, 10, "J0"), ("a", 2, 3, "K"), ("a", 3, 99, "none"), ("twice", 2, 11, "J2"), ("hole", None, 10, "J3"), (None, 7, 10, "J4"), ("long", 60, 12, "J5")]
    sat += [("benches", i, 10, f"J{i}") for i in range(archive.SHORT + 5)]
    return statuses.withColumn("DateReceived", F.col("DateReceived").cast("timestamp_ntz")), spark.createDataFrame(sat, "CaseNo string, StatusId long, Position int, FullName string")


def test_hearing_texts_are_the_same_by_either_path(spark):
    statuses, sittings = _hearings(spark)
    short, rounds = (sorted(map(str, archive.hearing_texts(statuses, sittings, 4, light=n).collect())) for n in (None, 0))
    assert short == rounds
    texts = {(r["CaseNo"], r["part"]): r["text"] for r in archive.hearing_texts(statuses, sittings, 4).collect()}
    assert texts[("a", 0)] == (
        "undated at Y\n2020-01-01 at X\n2020-01-02 at X, C before J0 (clerk K) put off 1 times since 2020-01-01\n2020-01-03 at X, C put off 2 times since 2020-01-01"
    )
    assert texts[("loop", 0)].count("in a loop") == 3 and "before J0" not in texts[("loop", 0)]
    assert "before J1" in texts[("benches", 0)]
    assert sum(f"put off {archive.SHORT + 19} times since 2021-01-01" in t for (c, _), t in texts.items() if c == "long") == 1


def test_short_cases_write_no_rounds(spark):
    """Chains of short cases are followed where their rows meet; only the texts are written, and each side is shuffled once."""
    statuses, sittings = _hearings(spark)
    begun = scratch.mark()
    found = archive.hearing_texts(statuses.filter("CaseNo IN ('a', 'loop')"), sittings, 4)
    assert found.count() == 2
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in scratch._written[begun:]] == ["hearings"]
    rows = archive._short_cases(statuses, sittings, 4, None)._jdf.queryExecution().executedPlan().toString()
    assert rows.count("Exchange hashpartitioning(CaseNo") == 2, rows


def test_archive_parts_join_to_one_record(spark):
    days = [None, "2020-01-05", "2021-02-06", "2021-02-06", "2023-03-07"]
    rows = [("a/1", i, 10 + i, i if i != 2 else None, d) for i, d in enumerate(days)] + [("b/2", 1, 26, 1, "2020-01-01")]
    statuses = spark.createDataFrame(rows, "CaseNo string, StatusId int, CaseStatus int, Outcome int, DateReceived string").withColumn("DateReceived", F.col("DateReceived").cast("timestamp_ntz"))
    cases = spark.createDataFrame([("a/1", "FT", None), ("b/2", "UT", 'x"y'), ("c/3", "FT", "z")], "CaseNo string, Segment string, HORef string")
    parts = archive.case_documents(cases, statuses).orderBy("CaseNo", "part").collect()
    assert [r["part"] for r in parts if r["CaseNo"] == "a/1"] == [0, 2020, 2021, 2023]
    whole = {c: ("".join(r["html"] for r in parts if r["CaseNo"] == c), json.loads("".join(r["json"] for r in parts if r["CaseNo"] == c))) for c in ("a/1", "b/2", "c/3")}
    assert [s["StatusId"] for s in whole["a/1"][1]["statuses"]] == [0, 1, 2, 3, 4] and "outcome" not in whole["a/1"][1]["statuses"][2]
    assert whole["b/2"][1]["HORef"] == 'x"y' and whole["c/3"][1] == {"CaseNo": "c/3", "Segment": "FT", "HORef": "z", "statuses": []}
    for page, record in whole.values():
        assert page.startswith("<html><h1>") and page.endswith("</table></html>") and page.count("<html>") == 1 and page.count("<tr>") == len(record["statuses"])


def _optimized(df):
    """The text of an optimized plan."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_failed_rules_and_flags_stay_in_generated_code(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = {"some": "v IS NOT NULL", "positive": "v > 0", "known": "id IN (1, 2)"}
    marked = quality.mark(df, rules)
    assert {r["id"]: (r["failed_rules"], r["is_valid"]) for r in marked.collect()} == {
        1: ([], True), 2: (["some", "positive"], False), 3: (["positive", "known"], False),
    }
    assert quality.mark(df, {}).filter("is_valid").count() == 3
    flag = lambda n: F.struct(F.lit(n).alias("name"))
    pairs = [(F.col("v") > 0, flag("a")), (F.col("id") < 3, flag("b")), (F.col("id") < 2, flag("b")), (F.lit(True), F.when(F.col("id") == 2, flag("c")))]
    flagged = df.select("id", arrays.flag_array(pairs).alias("flags"))
    got = {r["id"]: r["flags"] and [x["name"] for x in r["flags"]] for r in flagged.collect()}
    assert got == {1: ["a", "b", "b"], 2: ["b", "c"], 3: None}
    # A function over elements would have its conditions interpreted.
    assert "lambda" not in _optimized(marked) + _optimized(flagged)


def test_read_back_parses_a_document_that_is_written_before(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, t string").withColumn("content", F.to_json(F.struct("id", "t")))
    read = df.select("id", documents.read_back(F.col("content"), "t string").alias("c")).select("id", "c.t")
    assert {r["id"]: r["t"] for r in read.collect()} == {1: "x", 2: None}
    # Planned into the parser, the whole document would be interpreted.
    assert not re.search(r"from_json\([^\n]*to_json", _optimized(read))


def test_packed_columns_come_back_with_their_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), (None, 2, None)], "k string, n int, t string")
    lookup = spark.createDataFrame([(1, "one")], "m int, name string")
    packed = joins.pack(df, ["n"], "_rest")
    assert packed.columns == ["n", "_rest"]
    got = joins.unpack(packed.join(lookup, F.col("n") == F.col("m"), "left"), "_rest").select("k", "n", "t", "name")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1, "x", "one")] * 2 + [(None, 2, None, None)], key=str)


def test_lookups_are_broadcast(spark):
    from docketry.plans.casework_tables import lookup

    cases = spark.range(3).withColumn("CentreId", F.col("id").cast("int"))
    assert "strategy=broadcast" in _optimized(cases.join(lookup(spark, "centres"), "CentreId", "left"))


def test_rules_are_settled_where_their_columns_are_known(spark):
    """A rule that needs no lookup is settled before any join, and the columns that only it reads stay behind."""
    stages = []

    def made(read, settle):
        def noted(df):
            stages.append(settle(df))
            return stages[-1]

        return archives.state_base(spark, SF, "ended", read=read, settle=noted)

    found = payloads.rule_results(made, "ended", archives.CONTEXT)
    rules = payloads.rules("ended", archives.CONTEXT.system)
    plain = quality.rule_counts(payloads.checked(archives.state_base(spark, SF, "ended"), "ended", archives.CONTEXT), rules)
    counts = {tuple(r) for r in found.collect()}
    assert counts == {tuple(r) for r in plain.collect()} and {r[0] for r in counts} == set(rules)
    # The base is made once for the names of its columns, and once with its rules.
    assert len(stages) == 6 and {"_settled_0", "_settled_1", "_settled_2"} <= set(stages[-1].columns)
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        above = _optimized(payloads.rule_results(made, "ended", archives.CONTEXT)).split("Join LeftOuter")[0]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "s_permission" in above and "DateAppealReceived" not in above and "Rep_Email" not in above


def test_status_fields_that_are_not_read_are_not_carried(spark):
    rows = [("a", 1, 37, 1, "x", "p"), ("a", 1, 37, 1, "y", "o"), ("a", None, 37, 3, "z", "z"), ("b", 2, 50, None, "w", "q"), (None, 3, 37, 2, "v", "r")]
    df = spark.createDataFrame(rows, "CaseNo string, StatusId int, CaseStatus int, Outcome int, Notes string, CourtName string")
    variants = {"any": ["Outcome", "Notes", "CourtName"], "listed": ["Notes"]}
    whole, part = base.status_summary(df, variants), base.status_summary(df, variants, read={"any": ["Notes"]})
    # Of two rows with one id, the earlier fields decide as before.
    assert {r["CaseNo"]: r["s_any"]["Notes"] for r in part.collect()} == {r["CaseNo"]: r["s_any"]["Notes"] for r in whole.collect()}
    assert {r["CaseNo"]: r["s_listed"] is None for r in part.collect()} == {"a": False, "b": True, None: False}
    grouped = next(line for line in _optimized(part.select("CaseNo", "s_any.Notes")).split("\n") if "Aggregate" in line)
    assert part.schema["s_any"].dataType.names == ["Notes"] and "Outcome" in grouped and "CourtName" not in grouped


def test_rules_are_counted_by_what_fails_together(spark):
    rules = {"some": "v IS NOT NULL", "positive": "v > 0", "known": "id IN (1, 2)", "all": "TRUE"}
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (3, -1), (None, None)], "id int, v int")
    expected = {"some": (3, 2), "positive": (1, 4), "known": (2, 3), "all": (5, 0)}
    got = quality.rule_counts(df, rules)
    assert {r["rule"]: (r["passed"], r["failed"]) for r in got.collect()} == expected
    # One key and one count for a row, however many rules there are.
    assert "count_if" not in _optimized(got) and _optimized(got).count("count(1)") == 1
    early = df.select("id", "v", quality.failing({"positive": rules["positive"], "some": rules["some"]}, quality.numbered(rules)).alias("early"))
    assert {r["rule"]: (r["passed"], r["failed"]) for r in quality.rule_counts(early, rules, {"early": ["positive", "some"]}).collect()} == expected
    empty = {r["rule"]: (r["passed"], r["failed"]) for r in quality.rule_counts(df.limit(0), rules).collect()}
    assert empty == dict.fromkeys(rules, (0, 0)) and quality.rule_counts(df, {}).collect() == []
