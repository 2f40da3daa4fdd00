"""Ranks, sizes, fragments and pages when one key owns a large share of the rows, against plain windows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docketry.operators import aggregates, combine, documents, linking, ranking, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; key 0 holds a third, key NULL a tenth, the rest is spread; some orders and buckets are NULL."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50 + 1)
    return spark.range(3000).select(
        key.cast("long").alias("k"), F.when(F.col("id") != 7, (F.col("id") * 7919) % 3001).alias("o"), F.col("id").alias("v")
    ).repartition(7, "v")


def pairs(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_global_rank_is_the_total_order(skewed):
    ranked = skew.global_rank(skewed, ["o"], F.floor(F.col("o") / 100), "rn")
    assert [r["rn"] for r in ranked.orderBy("o").collect()] == list(range(1, 3001))


@pytest.mark.parametrize("width", [1, 64, 5000])
def test_rank_within_matches_a_window(skewed, width):
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("long")).withColumn(
        "n", F.count("*").over(Window.partitionBy("k"))
    )
    got = skew.rank_within(skewed, ["k"], ["o"], f"floor(o / {width})", "rn", "n")
    assert pairs(got, "k", "o", "rn", "n") == pairs(want, "k", "o", "rn", "n")


def test_group_size_keeps_null_groups(skewed):
    want = skewed.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    assert pairs(skew.group_size(skewed, ["k"], F.col("v") % 5, "n"), "v", "n") == pairs(want, "v", "n")


def test_nest_fragments_hold_a_hot_key(skewed):
    rows = aggregates.nest(skewed, ["k"], ["v"], "items", ["o"], F.floor(F.col("o") / 100), 64).collect()
    assert max(len(r["items"]) for r in rows) == 64
    got = [i["v"] for r in sorted((r for r in rows if r["k"] == 0), key=lambda r: r["part"]) for i in r["items"]]
    assert got == [r["v"] for r in skewed.filter("k = 0").orderBy("o").collect()]
    assert sum(len(r["items"]) for r in rows) == 3000


def test_concat_agg_fragments(skewed):
    joined = aggregates.concat_agg(skewed, ["k"], F.col("v").cast("string"), ",", "t", ["o"], F.floor(F.col("o") / 500), 37)
    text = ",".join(r["t"] for r in joined.filter("k = 0").orderBy("part").collect())
    assert text == ",".join(str(r["v"]) for r in skewed.filter("k = 0").orderBy("o").collect())


@pytest.mark.parametrize("width", [10, 5000])
def test_fragments_join_to_one_page(spark, skewed, width):
    """A record's parts join to the same page whatever their number."""
    rows = documents.render_children(skewed.filter("k IS NOT NULL"), ["k"], "<r>{{v}}</r>", {"v": F.col("v")}, "rows", ["o"], F.floor(F.col("o") / 300), size=width)
    records = spark.range(60).select(F.col("id").alias("r"))
    page = documents.fragment_page(F.concat(F.lit("<"), F.col("r").cast("string"), F.lit(">")), F.col("rows"), F.lit("</>"))
    parts = records.join(rows, F.col("r") == F.col("k"), "left").select("r", "part", page.alias("page"))
    got = {}
    for r in parts.orderBy("r", F.col("part").asc_nulls_first()).collect():
        got[r["r"]] = got.get(r["r"], "") + r["page"]
    children = {}
    for r in skewed.filter("k IS NOT NULL").orderBy(F.col("o").asc_nulls_first()).collect():
        children.setdefault(r["k"], []).append(r["v"])
    assert got == {k: f"<{k}>" + "".join(f"<r>{v}</r>" for v in children.get(k, [])) + "</>" for k in range(60)}


def test_chain_and_members_hold_a_hot_group(skewed):
    width = F.floor(F.col("o") / 100)
    assert linking.chain(skewed, "k", "v", ["o"], width).filter("k = 0").count() == 999
    parts = linking.group_members(skewed, "k", F.col("v").cast("string"), ["o"], width, size=90)
    assert parts.filter("k = 0").agg(F.sum(F.size("members"))).first()[0] == 1000
    assert parts.agg(F.max(F.size("members"))).first()[0] == 90


@pytest.mark.parametrize("times", [1, 10])
def test_parts_stay_as_large_when_a_key_grows(spark, times):
    """Ten times the rows of a key, most of them in one bucket, make ten times as many parts of the same size."""
    rows = spark.range(700 * times).select(F.floor(F.col("id") % 7 / 5).alias("k"), F.least(F.col("id") % 50, F.lit(5)).alias("day"), "id").repartition(9)
    parts = aggregates.nest(rows, ["k"], ["id"], "items", ["day", "id"], F.col("day"), 50).select("k", "part", F.size("items").alias("n"), "items").collect()
    assert max(r["n"] for r in parts) == 50
    for k, size in ((0, 500 * times), (1, 200 * times)):
        own = sorted((r for r in parts if r["k"] == k), key=lambda r: r["part"])
        assert [r["part"] for r in own] == list(range(size // 50)) and all(r["n"] == 50 for r in own)
        ids = [i["id"] for r in own for i in r["items"]]
        assert ids == sorted(ids, key=lambda i: (min(i % 50, 5), i)) and len(ids) == size


def test_no_job_runs_while_plans_are_built(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no action yet")
    try:
        skew.rank_within(skewed, ["k"], ["o"], "floor(o / 100)")
        ranking.batch(skewed, ["o"], "floor(o / 100)")
        aggregates.nest(skewed, ["k"], ["v"], "items", ["o"], F.col("o"))
        linking.chain(skewed, "k", "v", ["o"], "floor(o / 100)")
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_latest_reduces_before_the_shuffle(skewed):
    plan = ranking.latest(skewed, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_batch_sizes(skewed):
    sizes = [r["n"] for r in ranking.batch(skewed, ["o"], "floor(o / 100)", 250).groupBy("batch_id").agg(F.count("*").alias("n")).collect()]
    assert sizes == [250] * 12


def _families(spark, times: int, n: int):
    """Children of 40 records, a third of them of record 0, in ``n`` families; some of a record that is not there."""
    rows = spark.range(300 * times).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 1, 99).otherwise(F.col("id") % 40).cast("long").alias("k"),
        (F.col("id") * 7919 % 30011).alias("o"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
    ).repartition(6)
    return [combine.Family(f"f{i}", rows.filter(F.col("o") % (i + 1) == 0), ["v", "o"], ["o"], F.floor(F.col("o") / 5000)) for i in range(n)]


@pytest.mark.parametrize("times", [1, 10])
def test_combined_records_hold_every_child_in_order(spark, times):
    families = _families(spark, times, 3)
    records = spark.range(41).select(F.col("id").alias("k"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("title"))
    rows = combine.combine(records, families, "k", 25).collect()
    assert max(len(r[f.name]) for r in rows for f in families) == 25
    titles = {(r["k"], r["part"]): r["title"] for r in rows}
    assert len(titles) == len(rows) and all((v == f"r{k}") if p == 0 and k < 41 else v is None for (k, p), v in titles.items())
    # Record 40 has no children, key 99 no record.
    assert [(r["part"], r["f0"]) for r in rows if r["k"] == 40] == [(0, [])] and any(r["k"] == 99 for r in rows)
    for f in families:
        want = {}
        for r in f.rows.orderBy("o", "v").collect():
            want.setdefault(r["k"], []).append((r["v"], r["o"]))
        got = {}
        for r in sorted(rows, key=lambda r: r["part"]):
            got.setdefault(r["k"], []).extend(tuple(c) for c in r[f.name])
        assert {k: v for k, v in got.items() if v} == want


def test_families_add_no_shuffle(spark):
    """One aggregate by record and part, whether there are two families or nine."""
    records = spark.range(41).select(F.col("id").alias("k"))
    exchanges = [combine.combine(records, _families(spark, 1, n), "k", 25)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for n in (2, 9)]
    assert exchanges[0] == exchanges[1]


@pytest.mark.parametrize("light", [0, None])
def test_families_of_one_table_share_its_rows(spark, light):
    """Two families of a table, one of some of its rows, and a family whose repeated children are one: a row is shuffled once for all."""
    rows = spark.createDataFrame([(k % 3, i, i if i % 2 else None, f"v{i % 4}") for k in range(6) for i in range(12)] + [(7, 1, None, None)], "k long, o long, seen long, v string")
    records = spark.range(4).select(F.col("id").alias("k"))
    shared = [
        combine.Family("all", rows, ["v"], ["o", "v"], F.col("o")), combine.Family("seen", rows, ["seen"], ["seen", "o"], F.col("seen"), where=F.col("seen").isNotNull()),
        combine.Family("kinds", rows.select("k", "v"), ["v"], ["v"], F.lit(0), distinct=True),
    ]
    apart = [
        combine.Family("all", rows.select("*"), ["v"], ["o", "v"], F.col("o")), combine.Family("seen", rows.filter("seen IS NOT NULL"), ["seen"], ["seen", "o"], F.col("seen")),
        combine.Family("kinds", rows.select("k", "v").distinct(), ["v"], ["v"], F.lit(0)),
    ]
    got, want = (sorted(map(str, combine.combine(records, f, "k", 5, light=light).collect())) for f in (shared, apart))
    assert got == want and len(got) > 10
    assert combine._tagged(shared, "k").count() == 2 * rows.count() and combine._tagged(apart, "k").columns[3:] == ["_source_0", "_source_1", "_source_2"]
    assert len(combine._tagged(shared, "k").columns) == 5


def test_tasks_follow_the_size_of_the_tables(spark, monkeypatch):
    """A shuffle of more than a task can sort goes to more tasks than the session has; tables of unknown size do not count."""
    small = spark.range(1000)
    assert skew.width(small, small) is None and skew.width(spark.createDataFrame([(1,)], "id long")) is None
    monkeypatch.setattr(skew, "TASK_BYTES", 400)
    assert skew.width(small, small.select((F.col("id") * 2).alias("id"))) == 40
    made = combine.combine(small.withColumnRenamed("id", "k"), _families(spark, 1, 2), "k", 25)
    assert "REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString() and made.count() > 1000
    monkeypatch.setattr(skew, "MOST_TASKS", 16)
    assert skew.width(small, small) == 16


def test_record_json_leaves_out_what_is_empty(spark):
    made = combine.combine(spark.range(41).withColumnRenamed("id", "k"), _families(spark, 1, 2), "k", 25)
    shown = {(r["k"], r["part"]): r["j"] for r in made.select("k", "part", combine.record_json(made).alias("j")).collect()}
    assert shown[(40, 0)] == '{"k":40}' and '"f0":[{"v":' in shown[(0, 0)]


@pytest.mark.parametrize("light", [0, 30, 10_000])
def test_records_are_the_same_by_either_path(spark, light):
    """All keys ranked by buckets, some, or none: the parts are those of the plain order."""
    families = _families(spark, 2, 3)
    records = spark.range(41).select(F.col("id").alias("k"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("title"))
    shown = lambda limit: sorted(str(r) for r in combine.combine(records, families, "k", 25, light=limit).collect())
    assert shown(light) == shown(None)
    texts = {"t": (F.col("v"), ",")}
    joined = lambda limit: sorted(str(r) for r in documents.joined_parts(families[0].rows, ["k"], texts, ["o"], F.floor(F.col("o") / 5000), 25, light=limit).collect())
    assert joined(light) == joined(None)
    lines = lambda limit: sorted(str(r) for r in aggregates.concat_agg(families[0].rows, ["k"], F.col("v"), ",", "t", ["o"], F.floor(F.col("o") / 5000), 25, light=limit).collect())
    assert lines(light) == lines(None)


def test_rows_of_plain_keys_are_shuffled_once(spark):
    """A child row moves to its key and is ranked and gathered there; the path of hot keys has the other shuffles."""
    near, _ = skew.by_weight(_families(spark, 1, 1)[0].rows, ["k"], 1_000_000)
    gather = lambda df, apart: df.groupBy("k", F.floor(F.col("_rn") / 25).alias("part")).agg(F.count("*").alias("n"))
    window = near.repartition("k").withColumn("_rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert gather(window, False)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k") == 1
    sources = combine.combine(spark.range(41).withColumnRenamed("id", "k"), _families(spark, 1, 2), "k", 25)._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in sources and "REPARTITION_BY_COL" in sources
