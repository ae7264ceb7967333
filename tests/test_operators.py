import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from estrato.operators import profiling as P
from estrato.operators import quality as Q
from estrato.operators import relational as J
from estrato.operators.metrics import Metric, distinct_count, row_count, summarize, total
from estrato.operators.modeling import calendar
from estrato.operators.skew import salted_join, with_group_count


@pytest.fixture(scope="module")
def skewed():
    """One key holds more than a third of the rows; some keys are NULL."""
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        key = 1 if i % 5 < 2 else (None if i % 31 == 0 else rnd.randrange(60))
        rows.append((i, key, rnd.choice(["a", "b", None]), rnd.choice(["x", "y"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, k int, v string, w string")


def test_group_count_equals_window(spark, skewed):
    counts = Counter(r[1] for r in skewed)
    got = with_group_count(frame(spark, skewed), ["k"], "n").collect()
    assert len(got) == len(skewed)
    assert all(r["n"] == counts[r["k"]] for r in got)


def test_group_count_is_left_out_where_it_is_not_asked_for(spark, skewed):
    counted = with_group_count(frame(spark, skewed), ["k", "v"], "n")
    assert "Join" in counted._jdf.queryExecution().optimizedPlan().toString()
    plan = counted.groupBy("id").agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_mapping_audit_works_out_once_what_both_sides_are_made_of(spark, skewed):
    rows = frame(spark, skewed).select("k", "v", "w").distinct()
    stored = rows.select("k", F.upper("v").alias("x"))
    audit = lambda: J.mapping_audit(rows, stored, "k", {"x": F.upper("v")})
    differing = {k for k in range(60) if len({r[2] for r in skewed if r[1] == k}) > 1} | {None}
    expected = len({r[1:] for r in skewed if r[1] in differing})
    assert [(r["checked_rows"], r["n_different"]) for r in audit().collect()] == [(len({r[1:] for r in skewed}), expected)]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = audit()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    left = frame(spark, skewed)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 60, 2)] + [(1, "hot"), (1, "hot2")], "k int, name string")
    plain = sorted(map(str, left.join(right, "k", how).collect()))
    salted = sorted(map(str, salted_join(left, right, "k", "id", how, salts=5, top=3).collect()))
    assert plain == salted


def brute_dependency(rows, key, attribute, null_is_value):
    seen = defaultdict(set)
    for r in rows:
        if r[key] is not None:
            seen[r[key]].add(r[attribute])
    sizes = [len(v if null_is_value else v - {None}) for v in seen.values()]
    return len(sizes), sum(s > 1 for s in sizes), max(sizes)


@pytest.mark.parametrize("null_is_value", [True, False])
def test_dependency_matches_brute_force(spark, skewed, null_is_value):
    rows = skewed + [(1000 + i, 500 + i, None, "x") for i in range(4)]
    got = {r["column_name"]: r for r in P.dependency(frame(spark, rows), ["k"], ["v", "w"], null_is_value).collect()}
    for i, name in ((2, "v"), (3, "w")):
        total_keys, multiple, most = brute_dependency(rows, 1, i, null_is_value)
        assert (got[name]["total_keys"], got[name]["multiple_keys"], got[name]["max_values"]) == (total_keys, multiple, most)
    only_null = frame(spark, [(1, 1, None, "x"), (2, 2, None, "x")])
    empty = P.dependency(only_null, ["k"], ["v"], null_is_value).first()
    assert empty["max_values"] == (1 if null_is_value else 0)


def test_column_profile(spark):
    df = spark.createDataFrame([("a",), ("",), ("  ",), (None,), ("abc",), ("a",)], "c string")
    r = P.column_profile(df).first()
    assert (r["total_rows"], r["null_count"], r["empty_count"], r["blank_count"], r["distinct_count"]) == (6, 1, 2, 1, 4)
    assert (r["min_length"], r["max_length"]) == (0, 3)
    top = [(x["value"], x["n"]) for x in P.top_values(df, ["c"]).orderBy("rank").collect()]
    assert top[0] == ("a", 2) and ("<NULL>", 1) in top


def test_pair_differences(spark):
    df = spark.createDataFrame([("1", "x", None), ("1", "y", None), ("2", "x", "p"), ("2", "x", None), ("3", "x", "p")], "k string, a string, b string")
    got = {(r["k"], r["column_name"], r["value_low"], r["value_high"]) for r in P.pair_differences(df, "k", ["a", "b"]).collect()}
    assert got == {("1", "a", "x", "y"), ("2", "b", None, "p")}


def test_label_conflicts_counts_without_building_pairs(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, None)], "c int, l string")
    b = spark.createDataFrame([(1, "x"), (1, "w"), (2, "z"), (4, "q")], "c int, l string")
    got = J.label_conflicts({"a": (a, "c", "l"), "b": (b, "c", "l")}, [("a", "b")]).collect()
    assert [(r["code"], r["n_conflicts"]) for r in got] == [(1, 3)]  # x-w, y-x, y-w


def test_known_exceptions_keep_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted(map(str, (r["k"] for r in J.without(df, "k", [1]).collect()))) == ["2", "None"]


def test_multiplied_totals_equal_the_join(spark, skewed):
    left = frame(spark, skewed).withColumn("m", (F.col("id") / 4).cast("decimal(17,2)"))
    links = frame(spark, skewed[:300]).select("k")
    joined = left.join(links, "k").agg(F.count("*"), F.sum("m")).first()
    got = J.multiplied_totals(left, "k", F.col("m"), J.link_multiplicity(links, "k")).first()
    assert (got["n_rows"], got["total"]) == (joined[0], joined[1])


def test_gates(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (None, 5)], "k int, v int")
    contract = Q.Contract(not_null=("k", "v"), unique=("k",), accepted={"v": (1, 2)}, references=(("k", "p", "k"),))
    found = {(r["rule"], r["target"]): r["violations"] for r in Q.check_contract(
        {"t": df, "p": df.filter("k is null")}, "t", contract).collect()}
    assert found == {("not_null", "k"): 1, ("not_null", "v"): 1, ("accepted_values", "v"): 2, ("unique", "k"): 1, ("references", "k->p.k"): 2}
    passed, rows = Q.run_gates(spark, {
        "good": lambda: Q.must_be("good", Q.measures(df, {"rows": F.count("*")}), 3),
        "null side": lambda: Q.must_be("null side", Q.measures(df.filter("false"), {"sum": F.sum("v")})),
        "boom": lambda: df.select("missing"),
    })
    assert not passed
    assert {r["gate"]: r["status"] for r in Q.gate_verdicts(rows).collect()} == {"good": "PASS", "null side": "FAIL", "boom": "FAIL"}


def test_bridge_refuses_sums(spark):
    df = spark.createDataFrame([(1, 10)], "id int, v int")
    assert summarize(df, [distinct_count("n", "id")], through_bridge=True).first()["n"] == 1
    for unsafe in (row_count("n"), total("s", "v")):
        assert isinstance(unsafe, Metric)
        with pytest.raises(ValueError):
            summarize(df, [unsafe], through_bridge=True)


def test_calendar(spark):
    r = Q.calendar_structure(calendar(spark)).first()
    assert (r["total_rows"], r["missing_rows"], r["outside_rows"], r["civil_days"], r["distinct_days"]) == (22282, 1, 1, 22280, 22280)


def test_cube_answers_from_the_smallest_set_and_refuses_the_rest(spark):
    from estrato.operators import metrics as M

    rows = [(k % 3 if k % 7 else None, f"b{k % 5}", f"c{k % 11}", k if k % 4 else None, k * 1.5) for k in range(500)]
    table = spark.createDataFrame(rows, "a int, b string, c string, n long, v double")
    chosen = [M.row_count("rows_"), M.present_count("present", "n"), M.total("sum_", "v"), M.ratio("pct", M.present_count("x", "n"), M.row_count("y"))]
    sums = M.cube(table, [["a"], ["a", "b"], ["c"], []], chosen)
    assert min(sums.sizes.values()) == 1 and sums.sizes[frozenset(["a", "b"])] == 20
    for dims, filters, not_null in ((["a"], {}, []), (["a"], {"b": ["b1", "b2"]}, ["a"]), ([], {"c": ["c3"]}, []), ([], {"c": ["none"]}, []), (["b"], {}, []), ([], {}, [])):
        direct = M.summarize(table, chosen, dims, filters, not_null)
        assert sorted(map(tuple, sums.answer(chosen, dims, filters, not_null).collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)
    for metrics, dims in (([M.distinct_count("d", "n")], ["a"]), (chosen, ["b", "c"]), ([M.total("t", "n")], ["a"])):
        with pytest.raises(M.NotAdditive):
            sums.answer(metrics, dims)
    with pytest.raises(M.NotAdditive):
        M.cube(table, [["a"]], [M.distinct_count("d", "n")])


def test_a_hot_body_found_while_writing_is_dealt_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from estrato.operators import modeling as MOD
    from estrato.operators import skew as K
    from estrato.sources import snapshots as S

    body = F.when(F.col("id") % 3 == 0, "B0").when(F.col("id") % 10 == 7, F.lit(None)).otherwise(F.concat(F.lit("B"), (F.col("id") % 97).cast("string")))
    seen = {}
    S.overwrite_snapshot(spark, spark.range(60_000).select("id", body.alias("body")), f"{tmp_path}/fact", metrics={"body": K.heavy_hitters("body")}, check=seen.update)
    found = K.hot_keys(seen["body"], seen["rows"], 16)
    assert list(found) == ["B0"] and 5 <= found["B0"] <= 7
    fact = S.read_snapshot(spark, f"{tmp_path}/fact")
    names = spark.range(97).select(F.concat(F.lit("B"), F.col("id").cast("string")).alias("code"), F.col("id").alias("name"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        loads = []
        for hot in (None, found):
            role = MOD.Role(lambda: names, "body", "code", {"name": "name"}, proven=True, spread_by="id" if hot else None, hot=hot)
            view = MOD.star_view(fact, {"id": "id", "body": "body"}, [("body", role)], ["id", "body", "name"])
            loads.append(max(r["count"] for r in view.groupBy(F.spark_partition_id()).count().collect()))
            assert view.count() == 60_000 and view.filter("name IS NULL AND body IS NOT NULL OR name IS NOT NULL AND concat('B', name) <> body").isEmpty()
        assert loads[0] > 20_000 and loads[1] < 2.5 * 60_000 / 16, loads
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_census_works_a_table_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(k):
        seen.add(1)
        return k

    rows = spark.range(50).select("id", F.udf(mark, "long")(F.col("id") % 10).alias("k"))
    contracts = {"t": Q.Contract(not_null=("id", "k"), unique=("id", "k"), references=(("k", "t", "id"),))}
    got = {(r["rule"], r["target"]): r["violations"] for r in Q.check_contracts({"t": rows}, contracts).collect()}
    assert got == {("not_null", "id"): 0, ("not_null", "k"): 0, ("unique", "id"): 0, ("unique", "k"): 10, ("references", "k->t.id"): 0}
    assert seen.value == 50


def test_given_tables_are_read_in_small_partitions_unless_the_session_says_otherwise(spark):
    from suite.raw_tables import table

    key, number = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for k in (key, number):
        spark.conf.unset(k)
    table(spark, "/root/testdata/sf0.001", "nation")
    assert spark.conf.get(key) == "8m" and int(spark.conf.get(number)) >= 200
    spark.conf.set(key, "32m")
    table(spark, "/root/testdata/sf0.001", "nation")
    assert spark.conf.get(key) == "32m"
    spark.conf.unset(key)


def test_joins_of_given_tables_hash_a_side_of_small_partitions_and_sort_large_ones(spark):
    from estrato.session import ADAPTIVE_SETTINGS, small_partitions

    own = spark.newSession()
    for k, v in {**ADAPTIVE_SETTINGS, "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        own.conf.set(k, v)
    own.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    small_partitions(own)

    def plan(rows):
        left = own.range(rows).select("id", F.sha2(F.col("id").cast("string"), 512).alias("a"))
        right = own.range(rows).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("b"))
        joined = left.repartition(1, "id").join(right.repartition(1, "k"), F.col("id") == F.col("k"), "left").select(F.max("a"), F.max("b"))
        joined.collect()
        return joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    small, large = plan(1000), plan(150000)
    assert "ShuffledHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "ShuffledHashJoin" not in large
