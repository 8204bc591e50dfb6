from functools import partial

import pytest
from pyspark.sql import functions as F

from rankmatch.operators import joins
from rankmatch.session import store
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a third has none."""
    n = 3000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def table(spark):
    names = [("hot", 1), *[(f"k{i}", i) for i in range(0, 60, 2)]]
    return spark.createDataFrame(names, "k string, v long")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("spread", [False, True])
def test_lookup_equals_plain_join(skewed, table, how, spread):
    hot = joins.hot_keys(skewed, ["k"], min_rows=500) if spread else None
    plain = skewed.join(table, "k", how)
    got = joins.lookup(skewed, table, ["k"], how, hot=hot)
    assert rows(got) == rows(plain.select(*got.columns))


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach_below_and_beyond_the_broadcast_limit(monkeypatch, skewed, table, how, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    got = joins.attach(skewed, table, ["k"], how)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("__salt" in plan) == (limit == 0)
    assert rows(got) == rows(skewed.join(table, "k", how).select(*got.columns))


@pytest.mark.parametrize("by", [(), ("k",)])
def test_hot_rows_are_spread(spark, skewed, table, by):
    """No partition of the join holds much more than its share, even if the rows already lie by their key."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        source = skewed.repartition(16, *by)
        hot = joins.hot_keys(source, ["k"], min_rows=10)
        joined = joins.lookup(source, table, ["k"], "left", hot=hot)
        parts = joined.withColumn("p", F.spark_partition_id())
        for rows_of in (F.col("k") == "hot", F.col("k").isNull()):
            found = parts.where(rows_of).groupBy("p").count().agg(F.max("count"), F.sum("count")).first()
            assert found[0] <= 2 * found[1] / 16 + 10
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_have_parts_by_their_rows(skewed):
    assert rows(joins.hot_keys(skewed, ["k"], min_rows=300)) == [("hot", 4)]
    every = joins.hot_keys(skewed, ["k"], min_rows=1)
    assert every.count() == skewed.where("k IS NOT NULL").select("k").distinct().count()
    assert joins.hot_keys(skewed, ["k"]).count() == 0


def test_size_counts_the_width_of_rows(monkeypatch, spark, skewed):
    wide = spark.range(60).select(
        F.concat(F.lit("k"), "id").alias("k"), *[F.lit(None).cast("long").alias(f"n{i}") for i in range(40)]
    )
    assert joins.table_bytes(wide) > 60 * 40 * 8
    assert joins.table_bytes(wide.limit(0)) == 0
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 60 * 100)
    plan = joins.attach(skewed, wide, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_name_clash_is_refused(skewed, table):
    with pytest.raises(ValueError, match="both sides"):
        joins.lookup(skewed, table.withColumnRenamed("v", "id"), ["k"])


def test_keep_and_drop_keys(skewed, table):
    kept, dropped = joins.keep_keys(skewed, table, ["k"]), joins.drop_keys(skewed, table, ["k"])
    assert kept.count() + dropped.count() == skewed.count()
    assert dropped.where("k IS NULL").count() == skewed.where("k IS NULL").count()


def test_repeated_ids_count_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("", 6)], "id string, n long")
    single, repeated = joins.split_repeated(df, "id")
    assert rows(single) == [("", 6), ("b", 3)]
    assert rows(repeated) == sorted([("a", 1), ("a", 2), (None, 4), (None, 5)], key=repr)
    assert rows(joins.split_repeated(df.where("n <> 5"), "id")[0]) == sorted([("", 6), ("b", 3), (None, 4)], key=repr)
    longs = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert rows(joins.split_repeated(longs, "id")[0]) == [(2,)]


@pytest.fixture(scope="module")
def both_hot(spark):
    """A key with a third of the rows on either side, others with few, some without."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 40))
    left = spark.range(900).select("id", key.alias("k"))
    table = spark.range(240).select(F.col("id").alias("v"), key.alias("k"))
    return left, table.where("k IS NULL OR k <> 'k5'")


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("cell_pairs", [1, 50, 700, None])
def test_pairs_of_keys_hot_on_both_sides(monkeypatch, both_hot, how, cell_pairs, limit):
    left, table = both_hot
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    if how in ("left_semi", "left_anti"):
        table = table.select("k").distinct()
    got = joins.attach_pairs(left, table, ["k"], how, cell_pairs=cell_pairs)
    assert rows(got) == rows(left.join(table, "k", how).select(*got.columns))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("__grid_row" in plan) == (cell_pairs is not None and how in ("inner", "left"))


def test_cells_of_the_grid_are_bounded_and_full(both_hot):
    left, table = both_hot
    for most in (50, 700, 5000):
        cut = {r["k"]: (r["__grid_row"], r["__grid_column"]) for r in joins.grid(left, table, ["k"], most).collect()}
        n, m = (dict(df.where("k IS NOT NULL").groupBy("k").count().collect()) for df in (left, table))
        assert set(cut) == {k for k in n if n[k] * m.get(k, 0) > most}
        for k, (a, b) in cut.items():
            # As few copies as a grid of this many cells can have, give or take the rounding.
            assert (n[k] / a) * (m[k] / b) <= most and a <= n[k] and b <= 2 * m[k]
            assert n[k] * b + m[k] * a <= 3 * (n[k] * m[k] / most * n[k] * m[k]) ** 0.5 + n[k] + m[k]


def test_pairs_of_one_hot_key_lie_in_many_tasks(spark, both_hot):
    left, table = both_hot
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = joins.attach_pairs(left, table, ["k"], cell_pairs=500).where("k = 'hot'")
        tasks = got.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
        assert tasks[1] == 300 * 80 and tasks[0] <= tasks[1] / 4 and tasks[2] > 12
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_list_of_hot_keys_fits_a_broadcast(monkeypatch, spark, skewed):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 60)
    kept = joins._hot_list(skewed, ["k"])
    assert rows(kept.select("k")) == [("hot",)]


def test_key_filter_misses_no_key(spark, skewed, table):
    for bits in (64, 1 << 12, 1 << 20):
        words = joins.key_filter(table, ["k"], bits)
        assert words.count() <= bits // 64
        kept = joins.maybe_in(skewed, words, ["k"], bits)
        assert rows(kept.join(table, "k", "left_semi")) == rows(skewed.join(table, "k", "left_semi"))
        passed = kept.where("k IS NULL OR k NOT IN ('hot') AND pmod(cast(substring(k, 2, 9) as int), 2) = 1").count()
        assert bits < 1 << 20 or passed == 0
    assert joins.key_filter(table.where("false"), ["k"]).count() == 0


def test_filter_goes_ahead_of_the_shuffle(monkeypatch, skewed, table):
    for how in ("inner", "left_semi", "left", "left_anti"):
        got = joins.attach(skewed, table, ["k"], how, limit=0)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("__bits" in plan) == (how in ("inner", "left_semi"))
        assert rows(got) == rows(skewed.join(table, "k", how).select(*got.columns))
    monkeypatch.setattr(joins, "FILTER_BITS", 64)
    full = joins.attach(skewed, skewed.select("k").distinct(), ["k"], "left_semi", limit=0)
    assert "__bits" not in full._jdf.queryExecution().optimizedPlan().toString()
    assert full.count() == skewed.where("k IS NOT NULL").count()


@pytest.mark.parametrize("apart", ["null", "filter"])
@pytest.mark.parametrize("join", [joins.lookup, partial(joins.attach, limit=0)])
def test_rows_without_a_match_are_read_apart(skewed, table, join, apart):
    for how in ("left", "left_anti", "inner", "left_semi"):
        got = join(skewed, table, ["k"], how, apart=apart)
        assert rows(got) == rows(skewed.join(table, "k", how).select(*got.columns))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("Union" in plan) == (how in ("left", "left_anti"))


def test_unique_ids_are_not_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 900).cast("string").alias("id"), F.col("id").alias("n"))
    plan = joins.flag_repeated(df, "id", join=partial(joins.attach, limit=0))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "__bits" in plan
    got = joins.flag_repeated(df, "id", join=partial(joins.attach, limit=0))
    assert got.columns == ["id", "n", "is_repeated"]
    assert rows(got.where("is_repeated")) == rows(df.where("n < 100 OR n >= 900").withColumn("is_repeated", F.lit(True)))
    assert got.count() == 1000


def test_a_filter_that_is_too_full_sets_nothing_apart(monkeypatch, spark, skewed):
    monkeypatch.setattr(joins, "FILTER_BITS", 64)
    monkeypatch.setattr(joins, "MOST_FILTER_BITS", 64)
    keys = store(skewed.select("k").distinct(), "keys")
    assert joins._apart(skewed, keys, ["k"]) is None
    got = joins.attach(skewed, keys, ["k"], "left_anti", limit=0, apart="filter")
    assert rows(got) == rows(skewed.where("k IS NULL"))
