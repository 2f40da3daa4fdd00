"""Chains, OR joins, carried values, sketches and columns on demand, against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docketry.operators import aggregates, chains, joins, skew
from docketry.operators.resolve import Derived, Resolver, Source, named_columns


# ---- chains ------------------------------------------------------------------------------------------------


def plain_ancestry(parent: dict) -> dict:
    out = {}
    for k in parent:
        at, depth, seen = k, 0, set()
        while at not in seen and parent.get(at) is not None and parent[at] in parent:
            seen.add(at)
            at, depth = parent[at], depth + 1
        out[k] = (None, None, True) if at in seen else (at, depth, False)
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_ancestry_of_any_shape(spark, seed):
    """A long chain, a hot parent, loops with tails, parents that are not there, rows that are their own parent."""
    r = random.Random(seed)
    parent = {i: i - 1 for i in range(1, 200)} | {0: None}
    parent |= {i: 5 for i in range(1000, 1400)} | {i: 1000 + r.randrange(i - 1300) for i in range(1400, 1500)}
    parent |= {2000: 2002, 2001: 2000, 2002: 2001, 2003: 2002, 2004: 2003, 2010: 2010, 2011: 2010, 2020: 9999, 2021: 2020}
    rows = list(parent.items())
    r.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, 5)], "id long, up long").repartition(6)
    got = {x["id"]: (x["root"], x["depth"], x["in_loop"]) for x in chains.ancestry(df, "id", "up").collect()}
    assert got == plain_ancestry(parent)


def test_root_fields(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "a", 2), ("c", "b", 3), ("x", "y", 4), ("y", "x", 5)], "k string, p string, v int")
    got = {r["k"]: (r["depth"], r["in_loop"], r["root_v"]) for r in chains.with_root(df, "k", "p", ["v"]).collect()}
    assert got == {"a": (0, False, 1), "b": (1, False, 1), "c": (2, False, 1), "x": (None, True, None), "y": (None, True, None)}
    assert chains.ancestry(df.limit(0), "k", "p").count() == 0


def test_join_unique_with_hot_and_missing_values(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 3000).alias("r"), "id")
    keyed = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = skew.join_unique(rows, "r", keyed, "k", 5000)
    want = rows.join(keyed, F.col("r") == F.col("k"), "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# ---- OR joins ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_match_any_gives_each_pair_once(spark, how):
    r = random.Random(3)
    some = lambda n: r.choice([None, *range(n)])
    left = spark.createDataFrame([(i, some(8), some(12), some(30)) for i in range(150)], "id int, a int, b int, c int")
    right = spark.createDataFrame([(i, some(8), some(12), some(30)) for i in range(40)], "rid int, x int, y int, z int")
    either = [(F.col("a"), F.col("x")), (F.col("b"), F.col("y")), (F.col("c"), F.col("z"))]
    got = joins.match_any(left, right, either, how)
    want = left.join(right, (F.col("a") == F.col("x")) | (F.col("b") == F.col("y")) | (F.col("c") == F.col("z")), how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("pairs", [1, 50])
def test_pairs_of_a_hot_key_are_made_by_several_tasks(spark, pairs):
    """A key with many pairs is cut into shares; no pair is lost or made twice, repeated rows included."""
    left = spark.range(300).selectExpr("id % 150 AS id", "IF(id % 10 = 0, id, 7) AS a", "id % 11 AS b")
    right = spark.range(60).selectExpr("id % 50 AS rid", "IF(id % 3 = 0, id, 7) AS x", "id % 17 AS y")
    either = [(F.col("a"), F.col("x")), (F.col("b"), F.col("y"))]
    want = left.join(right, (F.col("a") == F.col("x")) | (F.col("b") == F.col("y")), "left")
    got = joins.match_any(left, right, either, "left", pairs)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = joins.match_any(left.filter("a = 7"), right, either[:1], "inner", 500).withColumn("task", F.spark_partition_id())
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert one.select("task").distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_match_any_is_no_nested_loop(spark):
    left, right = spark.range(1000).selectExpr("id", "id % 7 AS a", "id % 11 AS b"), spark.range(1000).selectExpr("id AS rid", "id % 7 AS x", "id % 11 AS y")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = joins.match_any(left, right, [(F.col("a"), F.col("x")), (F.col("b"), F.col("y"))], "left")._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ---- carried values ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 40, 10_000])
def test_carry_forward_over_buckets(spark, width):
    """The last value of a bucket seeds the ones after it, also over buckets without any."""
    r = random.Random(width)
    rows = [(k, o, r.choice([None, None, None, f"v{o}"]), r.choice([None] * 30 + [o])) for k in (None, 0, 1, 2) for o in r.sample(range(5000), 900 if k == 0 else 60)]
    df = spark.createDataFrame(rows, "k int, o int, a string, b int").repartition(5)
    got = {(x["k"], x["o"]): (x["a"], x["b"]) for x in skew.carry_forward(df, ["k"], ["o"], F.floor(F.col("o") / width), ["a", "b"]).collect()}
    want, last = {}, {}
    for k, o, a, b in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        kept = last.get(k, (None, None))
        last[k] = want[(k, o)] = (a if a is not None else kept[0], b if b is not None else kept[1])
    assert got == want


# ---- sketches ----------------------------------------------------------------------------------------------


def test_merged_rates_stay_within_their_rank_error(spark):
    """30 days of minutes with very different traffic; merging days gives the ranks of all minutes together."""
    minutes = spark.range(30 * 1440).select(F.timestamp_seconds(F.col("id") * 60).alias("minute"), (F.pmod(F.xxhash64("id"), F.lit(40)) + F.floor(F.col("id") / 4000)).alias("n"))
    events = minutes.filter("n > 0").select(F.col("minute").alias("ts"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    ranks = {"low": 0.1, "median": 0.5, "high": 0.95}
    sketches = aggregates.rate_sketches(events, "ts", "1 minute")
    assert sketches.count() == 30 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    merged = aggregates.merged_rates(sketches, ranks=ranks).first()
    counts = sorted(r["n"] for r in minutes.filter("n > 0").collect())
    assert merged["windows"] == len(counts) and merged["peak_rate"] == counts[-1] and abs(merged["mean_rate"] - sum(counts) / len(counts)) < 1e-3
    for name, rank in ranks.items():
        below = sum(c < merged[name] for c in counts) / len(counts)
        upto = sum(c <= merged[name] for c in counts) / len(counts)
        assert below <= rank + aggregates.RANK_ERROR and upto >= rank - aggregates.RANK_ERROR


# ---- columns on demand -------------------------------------------------------------------------------------


def sources(spark, read):
    def table(name, rows, schema):
        def get():
            read.append(name)
            return spark.createDataFrame(rows, schema)

        return get

    return [
        Source("people", table("people", [(1, "Ann", 9), (1, "Abe", 8), (2, "Bo", None)], "k int, name string, town int"), ["name", "town"], order=["name"]),
        Source("towns", table("towns", [(8, "Ely"), (9, "Rye"), (8, "Ely")], "town int, title string"), ["title"], on={"town": "town"}, order=["title"]),
        Source("bills", table("bills", [(1, 5), (1, 7), (3, 1)], "k int, amount int"), ["total", "n"], pick={"total": F.sum("amount"), "n": F.count(F.lit(1))}),
        Source("unused", table("unused", [(1, 0)], "k int, x int"), ["x"]),
    ]


def derived():
    return [Derived("label", ["title", "total"], F.concat_ws("-", "title", F.col("total").cast("string"))), Derived("twice", ["label"], F.concat("label", "label"))]


def test_resolver_reads_each_needed_source_once(spark):
    read = []
    resolver = Resolver("k", sources(spark, read), derived())
    records = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (4, "d"), (None, "e")], "k int, own string")
    wanted = named_columns(["twice IS NOT NULL AND own <> 'x name'", "n > 0 OR total = 1"], resolver.known)
    assert wanted == ["total", "n", "twice"]
    out = resolver.resolve(records, wanted)
    assert read == ["bills", "people", "towns"] and out.columns == ["k", "own", "total", "n", "twice"]
    got = {r["own"]: (r["total"], r["n"], r["twice"]) for r in out.collect()}
    assert got == {"a": (12, 2, "Ely-12Ely-12"), "b": (12, 2, "Ely-12Ely-12"), "c": (None, None, ""), "d": (None, None, ""), "e": (None, None, "")}
    assert "unused" not in read and resolver.resolve(records, []).columns == ["k", "own"]
    # What the records have already is taken from them.
    read.clear()
    own = resolver.resolve(records.withColumn("town", F.lit(9)), ["title"])
    assert read == ["towns"] and {r["title"] for r in own.collect()} == {"Rye"}


def test_resolver_refuses_what_it_cannot_order(spark):
    with pytest.raises(KeyError, match="no source provides other"):
        Resolver("k", sources(spark, []), derived()).steps(["other"], ["k"])
    with pytest.raises(ValueError, match="a needs b needs a"):
        Resolver("k", [], [Derived("a", ["b"], F.col("b")), Derived("b", ["a"], F.col("a"))]).steps(["a"], ["k"])
    with pytest.raises(ValueError, match="provided twice"):
        Resolver("k", [*sources(spark, []), Source("more", lambda: None, ["name"])])


def test_case_dependencies_leave_unused_tables_out(spark):
    from docketry.cases import dependencies
    from docketry.cases.base import KEY
    from docketry.plans.casework import _dependency_sources
    from docketry.plans.casework_tables import derive

    sf, read = "/root/testdata/sf0.001", []
    tables = {n: (lambda n=n, get=get: (read.append(n), get())[1]) for n, get in _dependency_sources(spark, sf).items()}
    cases = derive(spark, sf, "header").select(KEY)
    made = dependencies.resolver(tables).resolve(cases, ["endAppealOutcome", "is_detained"])
    assert sorted(read) == ["end_states", "people", "statuses"] and made.count() == cases.count()
