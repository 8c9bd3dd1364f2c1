"""One result under every strategy, and the physical plan each strategy promises."""

import math

import pytest
from pyspark.sql import functions as F

from lakeops.operators import skew
from lakeops.operators.hierarchy import closure, walk
from lakeops.operators.joins import Dim, broadcast_checked, bucketed_join, exists_in, fan_out, join_as, measured_bytes, not_exists_in, star_join
from lakeops.operators.layout import write_bucketed
from lakeops.session import skew_session
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def fact(spark):
    """Key 1 holds 40 % of the rows, key 2 a tenth, some keys are null and some unmatched."""
    i = F.col("id")
    key = F.when(i % 10 < 4, F.lit(1)).when(i % 10 == 4, F.lit(2)).when(i % 10 == 5, F.lit(None)).otherwise(i % 300)
    return spark.range(5000).select("id", key.cast("long").alias("k"), (i % 100).cast("double").alias("amount"))


@pytest.fixture(scope="module")
def dim(spark):
    rows_ = spark.range(250).select(F.col("id").alias("k"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("seg"))
    return rows_.unionAll(spark.createDataFrame([(None, "never")], "k long, seg string"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_under_every_strategy(fact, dim, how):
    plain = rows(fact.join(dim, "k", how).select("id", "k", "seg"))
    for strategy in ("auto", "broadcast", "merge", "shuffle_hash"):
        assert rows(join_as(fact, dim, "k", how, strategy).select("id", "k", "seg")) == plain, strategy
    salted = [
        skew.salted_join(fact, dim, "k", ["id"], 8, how),
        skew.concat_salted_join(fact, dim, "k", ["id"], 8, how),
        skew.partial_salted_join(fact, dim, "k", ["id"], n=8, how=how),
        skew.partial_salted_join(fact.filter("k > 2 or k is null").unionAll(fact.filter("k <= 2")), dim, "k", ["id"], share=0.9, how=how),
    ]
    for df in salted:
        assert rows(df.select("id", "k", "seg")) == plain


def test_salting_refuses_types_it_would_break(fact, dim):
    with pytest.raises(ValueError):
        skew.salted_join(fact, dim, "k", ["id"], 8, "right")


def test_plans(fact, dim):
    for strategy, node in (("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")):
        assert node in plan(join_as(fact, dim, "k", "left", strategy))


def test_broadcast_only_within_the_limit(spark, fact, dim):
    size = measured_bytes(dim)
    assert size > 250 * 16
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" in plan(fact.join(broadcast_checked(dim, size), "k"))
        assert "BroadcastHashJoin" not in plan(fact.join(broadcast_checked(dim, size - 1), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_star_join_keeps_fact_rows(fact, dim):
    out = star_join(fact, [Dim(dim, "k", "k", ["seg"], "a_"), Dim(dim, "k", "k", ["seg"], "b_")])
    assert out.columns == ["id", "k", "amount", "a_seg", "b_seg"]
    assert out.count() == fact.count()


def test_bucketed_join_has_no_exchange(spark, fact, dim, folder):
    a, b = folder(), folder()
    left, right = write_bucketed(fact, "tb_" + a[-32:], ["k"], 4, a), write_bucketed(dim, "tb_" + b[-32:], ["k"], 4, b)
    joined = join_as(spark.table(left), spark.table(right), "k", "left", "merge")
    assert "Exchange" not in plan(joined)
    guarded = bucketed_join(spark, left, right, "k", 8)
    assert "Exchange" in plan(guarded)  # key 1 exceeds a bucket
    even = fact.filter("k > 2")
    c = folder()
    calm = bucketed_join(spark, write_bucketed(even, "tb_" + c[-32:], ["k"], 4, c), right, "k", 4)
    assert "Exchange" not in plan(calm)
    assert rows(guarded) == rows(joined) and joined.count() == 5000 and calm.count() == even.count()


def test_semi_and_anti_with_null_keys(fact, dim):
    inside, outside = exists_in(fact, dim, "k"), not_exists_in(fact, dim, "k")
    assert inside.count() + outside.count() == 5000
    assert outside.filter("k is null").count() == fact.filter("k is null").count() and inside.filter("k >= 250").isEmpty()


def test_fan_out_without_join(dim):
    out = fan_out(dim, 4)
    assert out.count() == 4 * dim.count() and "Join" not in plan(out)


def test_hot_keys_against_counting(fact):
    for share in (0.3, 0.05, 0.003):
        exact = {r["k"] for r in fact.groupBy("k").count().filter(F.col("count") > share * 5000).collect()} - {None}
        assert {r["k"] for r in skew.hot_keys(fact.repartition(6), "k", share).collect()} == exact


def test_salted_totals(fact):
    plain = rows(fact.groupBy("k").agg(F.count("*"), F.sum("amount"), F.avg("amount")))
    assert rows(skew.salted_totals(fact, ["k"], "amount", ["id"])) == plain
    assert rows(skew.salted_totals(fact, ["k"], "amount", ["id"], hot=skew.hot_keys(fact, "k"))) == plain
    assert rows(skew.salted_totals(fact, ["k"], "amount", ["id"], hot=skew.hot_keys(fact, "k", 0.9))) == plain


def test_adaptive_skew_join_splits(spark):
    tuned = skew_session(spark, "16KB", 2.0, "8KB")
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    fact = tuned.range(0, 60000, 1, 8).select("id", key.alias("k"))
    dim = tuned.range(0, 60000, 1, 8).select(F.col("id").alias("k"), (F.col("id") % 5).alias("seg"))
    joined = join_as(fact, dim, "k", "left", "merge")
    assert len(joined.collect()) == 60000
    assert "skew=true" in plan(joined)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes") != "16KB"


def test_walk_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (2, 4), (5, 3)], "id int, parent_id int")
    out = walk(edges, spark.createDataFrame([(1,)], "id int"))
    assert sorted(r["path"] for r in out.collect()) == ["1", "1/2", "1/2/3", "1/2/3/4", "1/2/3/5"]


def test_walk_never_shortens(spark):
    edges = spark.range(1, 8).select((F.col("id") + 1).alias("id"), F.col("id").alias("parent_id"))
    roots = spark.createDataFrame([(1,)], "id long")
    assert walk(edges, roots).count() == 8


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "s string, t string")
    out = {(r["source"], r["target"]): r["hops"] for r in closure(edges, "s", "t").collect()}
    named = {(r["source"], r["target"]) for r in closure(edges, "s", "t", ["b"]).collect()}
    assert named == {("b", x) for x in "abcd"}
    assert out[("a", "d")] == 3 and out[("a", "a")] == 3 and ("d", "a") not in out and len(out) == 12


def test_salts_follow_from_the_share(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert skew.salts_for(df, "k") == tasks // 2
    assert skew.salts_for(df.filter("k > 0"), "k") == 1


def test_any_aggregate_in_two_stages(spark, fact):
    aggs = {"n": ("count", "*"), "a": ("count", "amount"), "s": ("sum", "id"), "lo": ("min", "amount"), "hi": ("max", "amount"), "m": ("avg", "id")}
    plain = fact.groupBy("k").agg(F.count(F.lit(1)), F.count("amount"), F.sum("id"), F.min("amount"), F.max("amount"), F.avg("id"))
    assert rows(skew.salted_agg(fact, ["k"], aggs, ["id"], 8)) == rows(plain)
    with pytest.raises(ValueError):
        skew.salted_agg(fact, ["k"], {"x": ("median", "id")}, ["id"])


def test_many_hot_keys_given_by_the_caller(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    fact = spark.range(500).select("id", (F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    hot = dim.select("k").filter("k < 40")
    assert rows(skew.partial_salted_join(fact, dim, "k", ["id"], hot, 4)) == rows(fact.join(dim, "k", "left"))


def test_one_exchange_spares_keys_above_an_average_task(spark):
    from lakeops.operators.aggregate import one_exchange

    small = spark.range(1000).select((F.col("id") % 500).alias("k"))
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    assert "Exchange" in plan(one_exchange(small, "k")) and "Exchange" not in plan(one_exchange(hot, "k"))
    four_percent = spark.range(1000).select(F.when(F.col("id") < 45, 0).otherwise(F.col("id")).alias("k"))
    assert "Exchange" not in plan(one_exchange(four_percent, "k", 0.04))


def test_walk_without_a_depth_cap(spark):
    from lakeops.operators.hierarchy import walk

    chain = spark.range(1, 105).select("id", (F.col("id") - 1).alias("parent_id")).coalesce(1)
    got = walk(chain, spark.range(1).select(F.col("id").alias("root")))
    assert got.agg(F.max("level")).first()[0] == 105 and got.count() == 105


def test_salt_plan_gives_each_hot_key_its_own_salts(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 1000 * tasks
    # Half of the rows on key 0, three tenths on key 1, some without a key, the rest apart.
    key = F.when(F.col("id") % 10 < 5, 0).when(F.col("id") % 10 < 8, 1).when(F.col("id") % 100 == 99, None).otherwise(F.col("id"))
    fact = spark.range(n).withColumn("k", key.cast("long"))
    dim = spark.range(-5, n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan_ = skew.salt_plan(fact, "k")
    assert plan_.salts == {0: math.ceil(tasks / 2), 1: math.ceil(tasks * 0.3)} and plan_.total == n
    # The dimension grows by the hot keys' rows only.
    assert plan_.copied(dim).count() == dim.count() + sum(s - 1 for s in plan_.salts.values())
    spread = {r["k"]: r["n"] for r in plan_.spread(fact, ["id"]).groupBy("k").agg(F.countDistinct(skew.SALT).alias("n")).filter("n > 1").collect()}
    assert spread == {**{k: s for k, s in plan_.salts.items() if s > 1}, None: tasks}
    for how in ("left", "inner"):
        want = rows(fact.join(dim, "k", how).select("id", "k", "v"))
        assert rows(skew.salted_join(fact, dim, "k", ["id"], how=how).select("id", "k", "v")) == want
        assert rows(skew.concat_salted_join(fact, dim, "k", ["id"], how=how).select("id", "v")) == sorted(((i, v) for i, _, v in want), key=repr)
        assert rows(skew.partial_salted_join(fact, dim, "k", ["id"], how=how).select("id", "k", "v")) == want


def test_salt_plan_reads_the_fact_once_and_the_join_once_more(spark, folder):
    path = folder("fact")
    spark.range(8000).select("id", (F.col("id") % 2 * F.col("id")).alias("k")).write.parquet(path)
    fact, dim = spark.read.parquet(path), spark.range(8000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert plan(skew.salted_join(fact, dim, "k", ["id"])).count("Location: InMemoryFileIndex") == 1


def test_salt_plan_without_hot_keys_or_rows(spark):
    dim = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    apart = spark.range(4000).withColumn("k", F.col("id"))
    assert skew.salt_plan(apart, "k").salts == {}
    assert skew.salted_join(apart, dim, "k", ["id"], how="inner").count() == 5
    none = apart.limit(0)
    assert skew.salt_plan(none, "k").salts == {} and skew.salted_join(none, dim, "k", ["id"]).count() == 0
    text = apart.select("id", F.concat(F.lit("é"), F.col("id") % 2).alias("k"))
    assert skew.salt_plan(text, "k").salts.keys() == {"é0", "é1"}


def test_totals_without_salts_need_one_exchange(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"), F.lit(0.25).alias("x"))
    text = plan(skew.salted_totals(df, ["k"], "x", ["id"]))
    assert text.count("hashpartitioning") == 1


def test_forest_doubles_its_pointers(spark, monkeypatch):
    from lakeops.operators import hierarchy

    rounds = []

    def counted(*args, **kwargs):
        rounds.append(1)
        return skew.partial_salted_join(*args, **kwargs)

    monkeypatch.setattr(hierarchy, "partial_salted_join", counted)
    n = 4_000
    chain = spark.range(1, n).select("id", (F.col("id") - 1).alias("parent_id"))
    got = hierarchy.forest(chain, paths=False)
    assert got.agg(F.count(F.lit(1)), F.max("level"), F.max("root"), F.count_if(F.col("level") != F.col("node") + 1)).first() == (n, n, 0, 0)
    # Round k ends the nodes up to 2^k - 1 steps below a root; the last round finds that none is left.
    assert len(rounds) == 13


def test_forest_of_roots_stars_cycles_and_repeated_rows(spark):
    from lakeops.operators.hierarchy import forest

    edges = [("b", "a"), ("b", "a"), ("c", "b"), ("r", None), ("s", "s"), ("t", "s"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), (None, "a"), ("b", None)]
    edges += [(f"leaf{i}", "c") for i in range(300)]
    got = {r["node"]: tuple(r)[1:] for r in forest(spark.createDataFrame(edges, "id string, parent_id string")).collect()}
    want = {"a": ("a", 1, "a"), "b": ("a", 2, "a/b"), "c": ("a", 3, "a/b/c"), "r": ("r", 1, "r"), "s": ("s", 1, "s"), "t": ("s", 2, "s/t")}
    want |= {k: (None, None, None) for k in "wxyz"} | {f"leaf{i}": ("a", 4, f"a/b/c/leaf{i}") for i in range(300)}
    assert got == want
    assert forest(spark.createDataFrame([], "id string, parent_id string")).count() == 0
    with pytest.raises(ValueError, match="more than one parent"):
        forest(spark.createDataFrame([("b", "a"), ("b", "c")], "id string, parent_id string"))


def test_closure_from_named_nodes_with_a_hot_one(spark):
    edges = [(f"s{i}", "hub") for i in range(400)] + [("hub", f"t{i}") for i in range(5)] + [("t0", "s0"), ("s0", "hub")]
    got = rows(closure(spark.createDataFrame(edges, "a string, b string"), "a", "b", ["s0", "s1", "none"]))
    want = {("s0", "hub", 1), ("s1", "hub", 1), ("s0", "s0", 3), ("s1", "s0", 3)}
    want |= {(s, f"t{i}", 2) for s in ("s0", "s1") for i in range(5)}
    assert got == sorted(want, key=repr)


def test_forest_reads_each_round_with_the_sizes_of_its_files(spark, monkeypatch):
    """Estimates of one round must not be factors of the next one's: they had twice the digits every round."""
    from lakeops.operators import hierarchy

    seen = []

    def measured(fact, dim, *args, **kwargs):
        seen.append([(q.stats().sizeInBytes().bit_length(), q.collectLeaves().size()) for q in (x._jdf.queryExecution().optimizedPlan() for x in (fact, dim))])
        return skew.partial_salted_join(fact, dim, *args, **kwargs)

    monkeypatch.setattr(hierarchy, "partial_salted_join", measured)
    chain = spark.range(1, 600).select("id", (F.col("id") - 1).alias("parent_id"))
    got = hierarchy.forest(chain)
    assert got.filter("level = node + 1 AND root = 0 AND size(split(path, '/')) = level").count() == 600
    assert len(seen) == 11 and all(bits < 64 and leaves == 1 for round_ in seen for bits, leaves in round_)
    assert got.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
