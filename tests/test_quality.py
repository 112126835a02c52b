from conftest import plan_of
from pyspark.sql import functions as F

from vaultline.operators import quality as q

SCHEMA = "k string, m string, v double, flag boolean, reason string"
ROWS = [
    ("a", "x@y", 1.0, True, "r"),
    ("a", "xy", 0.0, False, None),
    ("b", None, -1.0, None, "r"),
    (None, "@", None, False, "odd"),
    (None, "z@", 5.0, True, None),
]


def outcome(df, checks):
    return {r.check_name: (r.total, r.failed, r.passed) for r in q.report(df, checks).collect()}


def test_every_kind_of_check(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    flag = F.col("flag")
    checks = [
        q.row_count(5), q.row_count(4), q.row_count_at_least(5), q.row_count_at_least(6),
        q.unique("k"), q.unique("k", "m"), q.not_null("k"), q.accepted("k", ["a"]), q.contains("m", "@"),
        q.is_false("flag"), q.at_least("v", 0), q.above("v", 0),
        q.rate_between("rate in", flag, 0.3, 0.5), q.rate_between("rate out", flag, 0.5, 0.6),
        q.implies("flag has reason", flag, F.col("reason").isin("r")),
        q.implies("no reason otherwise", ~flag, F.col("reason").isNull()),
    ]
    assert outcome(df, checks) == {
        "row count = 5": (5, 0, True),
        "row count = 4": (5, 1, False),
        "row count >= 5": (5, 0, True),
        "row count >= 6": (5, 1, False),
        "k unique": (5, 2, False),
        "k, m unique": (5, 0, True),
        "k not null": (5, 2, False),
        "k accepted": (5, 3, False),
        "m contains @": (5, 2, False),
        "flag is false": (5, 3, False),
        "v >= 0": (5, 2, False),
        "v > 0": (5, 3, False),
        "rate in": (5, 0, True),
        "rate out": (5, 1, False),
        "flag has reason": (5, 1, False),
        "no reason otherwise": (5, 1, False),
    }


def test_checks_without_a_key_and_on_an_empty_table(spark):
    assert outcome(spark.createDataFrame(ROWS, SCHEMA), [q.not_null("m")]) == {"m not null": (5, 1, False)}
    empty = spark.createDataFrame([], SCHEMA)
    assert outcome(empty, [q.unique("k"), q.not_null("k"), q.row_count_at_least(1)]) == {
        "k unique": (0, 0, True),
        "k not null": (0, 0, True),
        "row count >= 1": (0, 1, False),
    }


def test_orphans_count_null_and_unknown_keys_whatever_their_frequency(spark):
    child = spark.createDataFrame([("a",)] * 7 + [("ghost",)] * 50 + [(None,)] * 30, "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(q.orphans(child, "k", parent).first()) == (87, 80)
    assert tuple(q.orphans(child.limit(0), "k", parent).first()) == (0, 0)


def test_only_the_key_is_shuffled(spark, scratch, static_plans):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(scratch)
    plan = plan_of(q.report(spark.read.parquet(scratch), [q.unique("k"), q.contains("m", "@"), q.above("v", 0)]))
    assert plan.count("FileScan") == 2 and plan.count("hashpartitioning") == 1
    assert "ReadSchema: struct<k:string>" in plan and "ReadSchema: struct<m:string,v:double>" in plan
