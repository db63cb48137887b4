import datetime as dt
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierflow.operators.cleanse import (
    EntityRules, Rule, apply_rules, check_balance, clean_entity, fill, keep_valid, rejected, require, unreadable,
)
from tierflow.operators.dedup import keep_latest
from tierflow.operators.lookup import keep_or_default, with_group_count
from tierflow.operators.nested import flatten

D = decimal.Decimal


def test_rules_trim_upper_cast_and_rename(spark):
    df = spark.createDataFrame([(" 7 ", " verified ", "4/1/2010", "x")], "a string, b string, c string, d string")
    got = apply_rules(df, [
        Rule("key", "int", trim=True, source="a"), Rule("kyc", "string", trim=True, upper=True, source="b"),
        Rule("opened", "date", formats=("yyyy-MM-dd", "M/d/yyyy"), source="c"), Rule("d", "decimal(5,2)"),
        Rule("key", "string", source="b"),
    ])
    assert got.dtypes == [("key", "int"), ("kyc", "string"), ("opened", "date"), ("d", "decimal(5,2)")]
    assert tuple(got.first()) == (7, "VERIFIED", dt.date(2010, 4, 1), None)


def test_strict_rules_fail_on_unreadable_values(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(PySparkException):
        apply_rules(df, [Rule("a", "int")], strict=True).collect()


def test_unreadable_names_the_lost_columns(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "y"), (None, ""), ("3", "z")], "a string, b string")
    got = unreadable(df, [Rule("a", "int"), Rule("n", "int", source="b")])
    assert sorted((r["a"], r["_unreadable"]) for r in got.collect()) == [("3", ["n"]), ("x", ["a", "n"])]


def test_fill_uses_the_type_of_the_column(spark):
    df = spark.createDataFrame([(None, None, 1)], "s string, d decimal(5,2), i int")
    got = fill(df, {"s": "UNKNOWN", "d": "0.00", "i": 9})
    assert got.dtypes == df.dtypes
    assert tuple(got.first()) == ("UNKNOWN", D("0.00"), 1)


def test_require_drops_when_any_is_null(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert [tuple(r) for r in require(df, ["a", "b"]).collect()] == [(3, 4)]


def test_entity_is_cast_deduplicated_checked_and_filled_in_this_order(spark, rows):
    entity = EntityRules("k", (Rule("k", "int"), Rule("name", "string", trim=True), Rule("x", "string")),
                         required=("name",), defaults={"x": "U"})
    raw = spark.createDataFrame(
        [("1", " b ", None), ("1", "a", None), ("2", None, "v"), ("3", "c", "w")], "k string, name string, x string")
    assert rows(clean_entity(raw, entity)) == [(1, "a", "U"), (3, "c", "w")]


def test_balances_are_checked_in_decimals(spark):
    # 0.1 + 0.2 is not 0.3 in doubles
    df = spark.createDataFrame([(0.1, 0.2, 0.0, 0.3), (1.0, 1.0, 0.0, 2.01), (1.0, None, 0.0, 1.0)],
                               "opening_balance double, credit_amount double, debit_amount double, closing_balance double")
    assert [r[0] for r in check_balance(df).select("is_balance_valid").collect()] == [True, False, None]


def test_keep_valid_needs_all_keys_and_a_true_flag(spark, rows):
    df = spark.createDataFrame([(1, 1, True), (None, 1, True), (1, 2, False), (1, 3, None)], "a int, b int, ok boolean")
    assert rows(keep_valid(df, ["a", "b"], "ok")) == [(1, 1, True)]


def test_latest_row_wins_with_a_defined_tie(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "x"), (2, 1, "y"), (None, 1, "n")], "k int, t int, v string")
    assert rows(keep_latest(df, ["k"], ["t"])) == [(1, 5, "a"), (2, 1, "y"), (None, 1, "n")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("abc")),
                     min_size=1, max_size=30), parts=st.integers(1, 7))
def test_survivor_does_not_depend_on_order_or_partitions(spark, data, parts):
    def latest(items, n):
        df = spark.createDataFrame(items, "k int, t int, v string").repartition(n)
        return sorted(tuple(r) for r in keep_latest(df, ["k"], ["t"]).collect())

    expected = {}
    for k, t, v in data:
        best = (-(t if t is not None else -1), v)
        if k not in expected or best < expected[k][0]:
            expected[k] = (best, (k, t, v))
    want = sorted(row for _, row in expected.values())
    assert [repr(x) for x in latest(data, parts)] == [repr(x) for x in want]
    assert [repr(x) for x in latest(list(reversed(data)), 1)] == [repr(x) for x in want]


def test_one_key_with_all_rows_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") < 0).alias("k"), "id")
    plan = keep_latest(df, ["k"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in text
    assert plan.first()["id"] == 999


def test_orphan_and_null_keys_get_the_default(spark, rows):
    fact = spark.createDataFrame([(1, 10, "a"), (2, 99, "b"), (None, 10, "c")], "p int, q int, v string")
    dims = {"p": spark.createDataFrame([(1,)], "p int"), "q": spark.createDataFrame([(10,)], "q int")}
    for sent_keys in (100, 0):
        got = keep_or_default(fact, dims, F.lit(-1), sent_keys)
        assert rows(got) == [(-1, -1, "b"), (-1, 10, "c"), (1, 10, "a")] and got.dtypes == fact.dtypes
    assert keep_or_default(fact, {}, F.lit(-1)) is fact


def test_keys_are_compared_in_the_type_of_the_dimension(spark, rows):
    fact = spark.createDataFrame([("07", "a"), ("8", "b"), ("x", "c"), (None, "d")], "k string, v string")
    dims = {"k": spark.createDataFrame([(7,), (9,), (None,)], "k int")}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        keep_or_default(fact, dims, F.lit(-1))  # a key that is no number is an error, as in any comparison
    assert rows(keep_or_default(fact.where("v <> 'c'"), dims, F.lit(-1))) == [(-1, "b"), (-1, "d"), (7, "a")]


def test_group_counts_include_the_null_group(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "i int, z string")
    assert rows(with_group_count(df, "z", "n"), "i", "n") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 1)]


def test_flatten_skips_repeated_paths_and_names(spark):
    df = spark.sql("select named_struct('b', named_struct('c', 1, 'd', 2)) a")
    got = flatten(df, [("a.b.c", "c"), ("a.b.d", "c"), ("a.b.c", "again"), ("a.b.d", "d")])
    assert got.columns == ["c", "d"] and tuple(got.first()) == (1, 2)


@pytest.mark.parametrize("value", ["named_struct('a', {0}, 'b', 'x')", "array({0}, 2)", "map('k', {0}, 'j', 1)", "array(map('k', {0}))",
                                   "named_struct('m', map('k', {0}))"])
def test_nested_columns_decide_ties(spark, value):
    rows = " union all ".join(f"select {k} k, {value.format(v)} v" for k, v in [(1, 5), (1, 3), (1, 4), (2, 9)])
    for partitions in (1, 3):
        got = keep_latest(spark.sql(rows).repartition(partitions), ["k"])
        assert sorted(r.s for r in got.select(F.to_json(F.struct("v")).alias("s")).collect()) == sorted(
            r.s for r in spark.sql(f"select to_json(struct({value.format(3)} v)) s union all select to_json(struct({value.format(9)} v)) s").collect())


def test_unreadable_values_get_no_default(spark, rows):
    entity = EntityRules("k", (Rule("k", "int"), Rule("x", "decimal(5,2)"), Rule("n", "string")), required=("n",), defaults={"x": "0.00"})
    raw = spark.createDataFrame([("1", "abc", "a"), ("2", " ", "a"), ("3", None, "a"), ("4", "1234.5", "a"), ("5", "2", None), ("z", "1", "a")],
                                "k string, x string, n string")
    assert rows(clean_entity(raw, entity), "k", "x") == sorted([(1, None), (2, D("0.00")), (3, D("0.00")), (4, None), (None, D("1.00"))], key=repr)
    assert rows(rejected(raw, entity)) == [("k", "unreadable", 1), ("n", "missing", 1), ("x", "unreadable", 2)]


def test_balances_are_not_rounded_before_the_comparison(spark):
    df = spark.createDataFrame([("100.0", "0", "0", "100.004"), ("100.001", "0.003", "0", "100.004")],
                               "opening_balance string, credit_amount string, debit_amount string, closing_balance string")
    assert [r.is_balance_valid for r in check_balance(df).collect()] == [False, True]
