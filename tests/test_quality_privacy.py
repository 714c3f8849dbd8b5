"""Masks, policies, encryption, findings and profiles."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import privacy as pv, quality as q


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet=st.characters(codec="ascii", exclude_characters="X\x00"), min_size=1, max_size=12), min_size=1, max_size=20))
@pytest.mark.parametrize("kind", ["LAST_FOUR", "FIRST_FOUR", "SHA256", "EMAIL_MASK", "ALWAYS_NULL", "DEFAULT"])
def test_mask_never_returns_its_input(spark, kind, values):
    df = spark.createDataFrame([(x,) for x in values], "s string")
    assert df.filter(pv.mask(F.col("s"), kind).eqNullSafe(F.col("s"))).count() == 0


def test_denied_columns_cannot_be_read(spark, t):
    view = pv.role_view(t.customer, {"c_acctbal": {"manager": "CLEAR"}}, "employee")
    with pytest.raises(PySparkException):
        view.select("c_acctbal")
    assert "c_acctbal" in pv.role_view(t.customer, {"c_acctbal": {"manager": "CLEAR"}}, "manager").columns


def test_no_grant_no_rows(spark, t):
    assert pv.row_access(t.orders, [({"anna"}, F.lit(True))], "bob").count() == 0


def test_cipher_is_bound_to_its_entity(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string")
    keys = pv.make_keys(df, "id", "k")
    sealed = pv.encrypt(df, keys, "id", ["s"])
    swapped = sealed.withColumn("id", 3 - F.col("id"))
    with pytest.raises(PySparkException):
        pv.decrypt(swapped, keys, "id", ["s"]).collect()
    left = pv.shred(keys, "id", df.filter("id = 1"))
    assert [tuple(r) for r in pv.decrypt(sealed, left, "id", ["s"]).collect()] == [(2, "y")]


def test_encryption_never_loses_a_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, s string")
    keys = pv.make_keys(df.filter("id IS NOT NULL"), "id", "secret")
    assert pv.encrypt(df.filter("id IS NOT NULL"), keys, "id", ["s"]).count() == 2
    for rows in (df, df.limit(2)):
        known = keys if rows is df else pv.shred(keys, "id", df.filter("id = 2"))
        with pytest.raises(PySparkException, match="no enabled key"):
            pv.encrypt(rows, known, "id", ["s"]).collect()
    assert pv.shred(keys, "id", df.filter("id = 2")).filter("disabled AND data_key IS NULL").count() == 1


def test_findings(spark):
    text = "Mail a.b@example.com or 10.0.0.255, card 4539 1488 0343 6467 not 4539 1488 0343 6468, born 1990-01-31, 999.1.1.1"
    df = spark.createDataFrame([(1, text), (2, None)], "id int, s string")
    found = {(r.info_type, r.quote) for r in q.scan_sensitive(df, "id", ["s"], list(q.SENSITIVE)).collect()}
    assert found == {("EMAIL_ADDRESS", "a.b@example.com"), ("IP_ADDRESS", "10.0.0.255"),
                     ("CREDIT_CARD_NUMBER", "4539 1488 0343 6467"), ("DATE", "1990-01-31"), ("DATE_OF_BIRTH", "born 1990-01-31")}


def test_rule_counts_add_up(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (-3, "b"), (None, "c")], "x int, s string")
    rules = {"pos": ("d", "$column >= 0"), "set": ("d", "$column IN ('a')"), "present": ("d", "$column IS NOT NULL", True)}
    res = q.run_rules(df, rules, [("pos", "x", "ALL"), ("set", "s", "ALL"), ("present", "s", "ALL")], {"ALL": "true"})
    rows = {r.rule_id: (r.success_count, r.failed_count, r.null_count) for r in res.collect()}
    assert rows == {"pos": (2, 1, 1), "set": (1, 2, 1), "present": (3, 1, 0)}
    assert res.filter("success_count + failed_count + null_count <> rows_validated").count() == 0


def test_profile_estimates_are_close(spark, t):
    prof = {r.column_name: r for r in q.profile(t.lineitem).collect()}
    exact = t.lineitem.select("l_partkey").distinct().count()
    assert abs(prof["l_partkey"].distinct_estimate - exact) / exact < 0.15
    true = t.lineitem.agg(F.percentile("l_quantity", 0.5)).first()[0]
    assert abs(prof["l_quantity"].quartiles[1] - true) <= 1


def test_profiles_add_up(spark, t):
    parts = q.sketch_profile(t.lineitem.withColumn("month", F.trunc("l_shipdate", "month")), ["month"])
    merged = {r.column_name: r for r in q.read_profile(q.merge_profiles(parts)).collect()}
    whole = {r.column_name: r for r in q.read_profile(q.sketch_profile(t.lineitem)).collect()}
    assert merged.keys() == whole.keys() and q.read_profile(parts, ["month"]).filter("month IS NULL").count() == 0
    for c, w in whole.items():
        m = merged[c]
        assert (m.row_count, m.null_count, m.min_value, m.max_value) == (w.row_count, w.null_count, w.min_value, w.max_value)
        assert m.distinct_estimate == pytest.approx(w.distinct_estimate, rel=0.03)
        assert m["mean"] == (pytest.approx(w["mean"]) if w["mean"] is not None else None)
        assert m["std"] == (pytest.approx(w["std"]) if w["std"] is not None else None)


def test_estimates_keep_their_bounds(spark):
    """A column of far more values than are tracked, some of them frequent, and one number per row."""
    rows = 60_000
    df = spark.range(rows, numPartitions=7).select(
        F.when(F.col("id") % 10 < 3, F.concat(F.lit("hot"), (F.col("id") % 3).cast("string"))).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("name"),
        F.pow(F.col("id"), 2.0).alias("x"), F.when(F.col("id") % 4 == 0, F.col("id") % 5).alias("few"))
    prof = {r.column_name: r for r in q.read_profile(q.sketch_profile(df)).collect()}
    true = {r["name"]: r["count"] for r in df.groupBy("name").count().collect()}
    bound = prof["name"].top_error
    found = {v.value: v.n for v in prof["name"].top}
    assert 0 < bound < rows / 100
    assert {v for v, n in true.items() if n > bound} <= set(found)
    assert all(abs(n - true[v]) <= bound for v, n in found.items())
    assert abs(prof["name"].distinct_estimate / len(true) - 1) < 0.06
    assert [(v.value, v.n) for v in sorted(prof["few"].top, key=lambda v: v.value)] == [(str(k), 3000) for k in range(5)] and prof["few"].top_error == 0
    for share, value in zip((0.25, 0.5, 0.75), prof["x"].quartiles):
        assert abs(df.filter(F.col("x") <= value).count() / rows - share) < 0.017
    assert prof["few"].null_count == 45_000 and prof["x"].min_value == "0.0"


def test_exact_profile(spark, t):
    prof = {r.column_name: r for r in q.profile(t.lineitem, exact=True).collect()}
    for c in ("l_partkey", "l_shipdate", "l_extendedprice"):
        assert prof[c].distinct_estimate == t.lineitem.select(c).distinct().count()
    want = t.lineitem.agg(F.percentile("l_extendedprice", [0.25, 0.5, 0.75])).first()[0]
    assert prof["l_extendedprice"].quartiles == pytest.approx(want) and prof["l_returnflag"].quartiles is None


def test_profile_of_nothing(spark):
    schema = "a int, b string, c double, d array<int>"
    for df in (spark.createDataFrame([], schema), spark.createDataFrame([(None, None, None, None)], schema)):
        rows = q.profile(df).collect()
        n = df.count()
        assert sorted(r.column_name for r in rows) == (["a", "b", "c"] if n else [])
        assert all((r.row_count, r.null_count, r.min_value, r["mean"], r.quartiles) == (n, n, None, None, None) for r in rows)


def test_typed_rules(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None), (None, "a"), (float("nan"), "c")], "x double, s string")
    rules = [
        q.range_rule("closed", "x", 1, 3), q.range_rule("strict", "x", 1, 3, strict_low=True, strict_high=True, threshold=0.2), q.range_rule("ignored", "x", 1, 3, ignore_null=True, threshold=0.75),
        q.range_rule("open", "x"), q.set_rule("listed", "s", ["a", "b"], 0.7, ignore_null=True), q.set_rule("null fails", "s", ["a", "b"], 0.7), q.not_null_rule("there", "s", 0.8),
    ]
    got = {r.rule: (r.evaluated, r.passed_count, r.null_count, r.passed) for r in q.check_rows(df, rules).collect()}
    assert got == {
        "closed": (5, 3, 1, False), "strict": (5, 1, 1, True), "ignored": (4, 3, 1, True), "open": (5, 5, 1, True), "listed": (4, 3, 1, True), "null fails": (5, 3, 1, False), "there": (5, 4, 1, True)
    }
    none = q.check_rows(df.limit(0), rules[:1]).first()
    assert (none.evaluated, none.ratio, none.passed) == (0, None, True)


def test_recommended_rules(spark, t):
    rules = {r.rule for r in q.recommend_rules(t.orders, q.profile(t.orders)).collect()}
    assert {"o_orderkey IS NOT NULL", "unique(o_orderkey)"} <= rules
    assert "unique(o_orderstatus)" not in rules and "unique(o_custkey)" not in rules
    assert "o_orderstatus IN ('F', 'O', 'P')" in rules


def test_quarantine_parts_the_table(spark, t):
    good, bad = q.quarantine(t.events, {"low": "value < 50", "click": "event_type = 'click'"})
    assert good.count() + bad.count() == t.events.count()
    assert bad.filter("size(failed_rules) = 0").count() == 0


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert [r.k for r in q.orphans(child, parent, "k", "p").collect()] == [9]
