import pytest
from pyspark.sql import functions as F

from rapproche.operators.matching import id_pairs, link_by_id, unmatched
from rapproche.operators.numbering import number_rows, part_number
from rapproche.operators.skew import SkewLimits, fits_broadcast, hot_keys, lookup_join, salted_join

LOW = SkewLimits(task_rows=20)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of each side under one key."""
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").alias("l"))
    right = spark.range(150).select(F.when(F.col("id") % 3 == 0, F.lit("")).otherwise((F.col("id") * 2).cast("string"))
                                    .alias("k2"), F.col("id").alias("r"))
    return left, right


def test_hot_keys_are_found(sides):
    assert [tuple(r) for r in hot_keys(sides[0], "k", LOW).collect()] == [("", 100)]
    assert hot_keys(sides[0].where("false"), "k", LOW).count() == 0


def test_any_number_of_hot_keys_is_split(spark):
    left = spark.range(9000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("l"))
    right = spark.range(6000).select((F.col("id") % 3000).alias("k2"), F.col("id").alias("r"))
    limits = SkewLimits(task_rows=1)
    assert hot_keys(left, "k", limits).count() == 3000
    split = salted_join(left, right, "k", "k2", "inner", limits)
    assert split.count() == 18_000 and split.distinct().count() == 18_000


def test_hot_keys_beyond_the_broadcast_bound_are_left_whole(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 10 + 1).alias("k"))
    assert hot_keys(rows, "k", SkewLimits(task_rows=2)).count() == 11
    assert [tuple(r) for r in hot_keys(rows, "k", SkewLimits(task_rows=2, broadcast_bytes=256)).collect()] == [(0, 60)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(sides, how):
    left, right = sides
    expected = left.join(right, F.col("k") == F.col("k2"), how).collect()
    split = salted_join(left, right, "k", "k2", how, LOW)
    assert split.columns == left.join(right, F.col("k") == F.col("k2"), how).columns
    if how in ("inner", "left_anti", "left_semi"):
        assert sorted(map(str, split.collect())) == sorted(map(str, expected))
    else:
        assert sorted(map(str, split.distinct().collect())) == sorted(map(str, set(expected)))
        assert split.count() == len(expected)


def test_hot_key_is_dealt_to_many_parts(sides):
    left, right = sides
    plan = salted_join(left, right, "k", "k2", "inner", LOW)._jdf.queryExecution().toString()
    assert "xxhash64" in plan and "sequence" in plan


def test_keys_are_split_by_pairs(spark, sides):
    """A key of few rows but many pairs is cut on both sides; no side of the join goes through the driver."""
    left, right = sides
    limits = SkewLimits(task_pairs=500)
    split = salted_join(left, right, "k", "k2", "inner", limits)
    expected = left.join(right, F.col("k") == F.col("k2"))
    assert sorted(map(str, split.collect())) == sorted(map(str, expected.collect()))
    plan = split._jdf.queryExecution().toString()
    assert "xxhash64" in plan and "sequence" in plan
    whole = salted_join(left, right, "k", "k2", "inner")
    assert "BroadcastHashJoin" not in whole._jdf.queryExecution().executedPlan().toString()
    least = SkewLimits(task_pairs=1, broadcast_bytes=256)  # more split keys than may be broadcast: the blank one stays
    assert sorted(map(str, salted_join(left, right, "k", "k2", "inner", least).collect())) == sorted(map(str, expected.collect()))


def test_lookup_join_both_ways(spark, sides):
    left = sides[0]
    table = left.select(F.col("k").alias("t")).distinct().withColumn("v", F.length("t"))
    wide = lookup_join(left, table, "k", "t", 16)
    narrow = lookup_join(left, table, "k", "t", 16, limits=SkewLimits(task_rows=20, broadcast_bytes=1))
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    assert fits_broadcast(table, 16) and not fits_broadcast(table, 16, SkewLimits(broadcast_bytes=160))


def test_numbers_are_consecutive_in_order(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x"), F.lit("y").alias("y")).repartition(7)
    numbered = number_rows(rows, ["x"], "n").orderBy("n").collect()
    assert [(r["n"], r["x"]) for r in numbered] == [(i + 1, i) for i in range(1000)]
    assert number_rows(rows.where("false"), ["x"], "n").count() == 0
    assert part_number("part-99999-a.parquet") < part_number("part-100000-a.parquet")


def _entries(spark, rows):
    schema = "id long, rawid string, name string"
    frame = spark.createDataFrame(rows, schema)
    return frame.select("*", *[F.lit("").alias(c) for c in ("street_number", "address", "postal_code", "city", "extra")])


def test_blank_ids_join_each_other_unless_skipped(spark):
    t1 = _entries(spark, [(1, "", "a"), (2, "", "b"), (3, "x", "c"), (4, "y", "d")])
    t2 = _entries(spark, [(1, "", "e"), (2, "x", "f"), (3, "", "g"), (4, "z", "h")])
    assert link_by_id(t1, t2).count() == 5
    assert link_by_id(t1, t2, limits=SkewLimits(task_rows=1)).count() == 5
    assert link_by_id(t1, t2, skip_blank_ids=True).count() == 1
    assert [r["id"] for r in unmatched(t1, t2).collect()] == [4]
    assert sorted(r["id"] for r in unmatched(t1, t2, skip_blank_ids=True).collect()) == [1, 2, 4]
    assert sorted(r["id"] for r in unmatched(t2, t1, limits=SkewLimits(task_rows=1)).collect()) == [4]


def test_id_pairs_are_those_of_the_join(spark):
    rows = lambda ids: spark.createDataFrame([(i,) for i in ids], "rawid string")
    one, two = rows(["", "", "", "a", "a", "b", None]), rows(["", "", "a", "a", "a", "c", None])
    found = {r["kind"]: (r["ids"], int(r["pairs"])) for r in id_pairs(one, two).collect()}
    assert found == {"blank": (1, 6), "other": (1, 6)}
    assert {r["kind"]: int(r["pairs"]) for r in id_pairs(one, rows([])).collect()} == {"blank": 0, "other": 0}
    many = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "").otherwise(F.col("id").cast("string")).alias("rawid"))
    assert {r["kind"]: int(r["pairs"]) for r in id_pairs(many, many).collect()} == {"blank": 10**10, "other": 10**5}
