"""Every kind of check, once passing and once failing."""

import datetime as dt

import pytest

from inboxlens.operators import quality as q

AS_OF = dt.datetime(2026, 3, 10, tzinfo=dt.timezone.utc)


def hours_ago(n):
    return AS_OF - dt.timedelta(hours=n)


@pytest.fixture(scope="module")
def table(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "k string, v string, at timestamp")

    return build


def status(df, rule):
    row = q.check(df, [rule], as_of=AS_OF).first()
    return row.failures, row.status


def test_not_null(table):
    assert status(table(("a", "x", None)), q.NotNull("k")) == (0, "pass")
    assert status(table((None, "x", None), (None, "y", None)), q.NotNull("k")) == (2, "error")


def test_unique_ignores_nulls_and_counts_values(table):
    assert status(table(("a", "", None), ("b", "", None), (None, "", None), (None, "", None)), q.Unique("k")) == (0, "pass")
    hot = [("hot", "", None)] * 50 + [("b", "", None), ("c", "", None), ("c", "", None)]
    assert status(table(*hot), q.Unique("k")) == (2, "error")


def test_accepted_values_let_null_pass(table):
    rule = q.Accepted("v", ("ok", "error"))
    assert status(table(("a", "ok", None), ("b", None, None)), rule) == (0, "pass")
    assert status(table(("a", "odd", None), ("b", "odd", None)), rule) == (2, "error")


@pytest.mark.parametrize(
    ("age", "expected"),
    [(24, (0, "pass")), (25, (1, "warn")), (72, (1, "warn")), (73, (1, "error")), (None, (1, "error"))],
)
def test_freshness(table, age, expected):
    rows = [("a", "", hours_ago(500)), ("b", "", hours_ago(age))] if age else []
    assert status(table(*rows), q.Fresh("at")) == expected


@pytest.mark.parametrize(("age", "expected"), [(72, (0, "pass")), (73, (1, "error")), (None, (0, "pass"))])
def test_recency(table, age, expected):
    rows = [("a", "", hours_ago(age))] if age else []
    assert status(table(*rows), q.Recent("at")) == expected


def test_references_count_rows(table):
    parent = table(("a", "", None), ("a", "", None))
    rule = q.References("k", parent, "k")
    assert status(table(("a", "", None), (None, "", None)), rule) == (0, "pass")
    assert status(table(("z", "", None), ("z", "", None), ("a", "", None)), rule) == (2, "error")


def test_gate(table):
    good = q.check(table(("a", "", AS_OF)), [q.NotNull("k"), q.Fresh("at"), q.Unique("k")], as_of=AS_OF, table="t")
    assert {r.check for r in good.collect()} == {"t.not_null:k", "t.freshness:at", "t.unique:k"}
    q.gate(good)
    q.gate(q.check(table(("a", "", hours_ago(30))), [q.Fresh("at")], as_of=AS_OF))
    with pytest.raises(ValueError, match=r"not_null:k \(1\)"):
        q.gate(q.check(table((None, "", AS_OF)), [q.NotNull("k")], as_of=AS_OF))


def test_declared_checks_are_complete():
    declared = q.RAW_MESSAGES + q.RUN_LEDGER + q.STAGING + q.EMAIL_MART + q.APPLICATIONS + q.META
    kinds = [type(r).__name__ for r in declared]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "NotNull": 26, "Unique": 4, "Accepted": 3, "Fresh": 2, "Recent": 1,
    }


def test_observed_checks_equal_checks(spark, table, tmp_path):
    rules = [q.NotNull("k"), q.Accepted("v", ("x",)), q.Recent("at"), q.Fresh("at"), q.Unique("k")]
    for n, rows in enumerate(
        ([("a", "x", hours_ago(1)), (None, "y", None), ("b", "y", hours_ago(90)), ("b", "x", None)],
         [("a", "x", hours_ago(100))], [(None, "y", None)], [])
    ):
        df = table(*rows) if rows else table(("a", "x", None)).sparkSession.createDataFrame([], "k string, v string, at timestamp")
        watched, report = q.observed(df, rules, as_of=AS_OF, table="t")
        path = str(tmp_path / str(n))
        watched.write.parquet(path)
        got = report(spark.read.schema(df.schema).parquet(path))
        expected = q.check(df, rules, as_of=AS_OF, table="t")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
