import pytest
from pyspark.sql import functions as F

from riskloom.operators.contracts import (
    ContractError,
    clean_contract,
    failures,
    feature_contract,
    raw_contract,
    require,
    risk_contract,
    summary,
)
from riskloom.operators.features import add_features
from riskloom.roles import Roles

ROLES = Roles(groups=("A", "B"))
SCHEMA = "grp string, age bigint, usage_km bigint, events bigint, label string"
VALID = [("A", 0, 1000, 0, "Não"), ("B", 3, 55000, 3, "Sim"), ("A", 30, 500000, 100, "Sim")]


def raw(spark, rows=VALID, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def found(df, contract):
    return {(r["column"], r["check"]) for r in failures(df, contract).collect()}


def test_boundary_values_conform(spark):
    row = summary(raw(spark), raw_contract(ROLES)).first()
    assert (row.conforming, row.n_rows, row.n_columns, row.n_failures, row.failed_checks) == (
        True, 3, 5, 0, "",
    )
    assert require(raw(spark), raw_contract(ROLES)) is not None


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (("Z", 0, 0, 0, "Sim"), ("grp", "isin")),
        (("A", 0, -1, 0, "Sim"), ("usage_km", "greater_than_or_equal_to(0)")),
        (("A", 31, 0, 0, "Sim"), ("age", "less_than_or_equal_to(30)")),
        (("A", 0, 0, 0, "Nao"), ("label", "isin")),
        (("A", 0, 0, None, "Sim"), ("events", "not_nullable")),
    ],
)
def test_each_violation_is_named(spark, row, expected):
    assert found(raw(spark, [*VALID, row]), raw_contract(ROLES)) == {expected}


def test_all_violations_of_a_row_are_reported_at_once(spark):
    df = raw(spark, [("Z", 31, -5, None, "Nao")])
    assert found(df, raw_contract(ROLES)) == {
        ("grp", "isin"),
        ("age", "less_than_or_equal_to(30)"),
        ("usage_km", "greater_than_or_equal_to(0)"),
        ("events", "not_nullable"),
        ("label", "isin"),
    }
    with pytest.raises(ContractError, match="events: not_nullable x 1"):
        require(df, raw_contract(ROLES))


def test_raw_coerces_numbers_but_not_fractions_or_words(spark):
    rows = [("A", "3", 1.0, 0, "Sim"), ("A", "3.7", 2.5, 0, "Sim"), ("A", "x", 1.0, 0, "Sim")]
    df = raw(spark, rows, "grp string, age string, usage_km double, events int, label string")
    cases = [(r["column"], r["failure_case"]) for r in failures(df, raw_contract(ROLES)).collect()]
    assert sorted(cases) == [("age", "3.7"), ("age", "x"), ("usage_km", "2.5")]


def test_clean_contract_refuses_text_labels(spark):
    assert found(raw(spark), clean_contract(ROLES)) == {("label", "dtype('boolean')")}


def test_unknown_and_missing_columns(spark):
    df = raw(spark).withColumnRenamed("events", "extra")
    assert found(df, raw_contract(ROLES)) == {
        (None, "column_in_dataframe"), ("extra", "column_in_schema"),
    }


def test_column_order_is_free(spark):
    df = raw(spark).select("label", "events", "grp", "usage_km", "age")
    assert found(df, raw_contract(ROLES)) == set()


def test_duplicate_names_are_reported_by_the_clean_contract(spark):
    from riskloom.operators.contracts import schema_failures

    df = raw(spark).select("*", F.col("age"))
    checks = {f[2] for f in schema_failures(df, clean_contract(ROLES))}
    assert "unique_column_name" in checks


def test_features_must_be_present_and_finite(spark):
    clean = raw(spark, [("A", 0, 0, 1, "Sim"), ("B", 1, 10, 0, "Não")]).withColumn(
        "label", F.col("label") == "Sim"
    )
    assert found(add_features(clean, ROLES), feature_contract(ROLES)) == {
        ("usage_per_year", "greater_than(0)"),
        ("events_per_10k", "not_nullable"),
    }
    infinite = add_features(clean, ROLES).withColumn("events_per_10k", F.lit(float("inf")))
    assert ("events_per_10k", "finite") in found(infinite, feature_contract(ROLES))


def test_risk_contract_row_checks(spark):
    rows = [(10, 5, 0.5, 0.2, 0.8, "fine"), (10, 11, 0.9, 0.1, 0.5, "bad"), (0, 0, 0.5, 0.5, 0.5, "empty")]
    df = spark.createDataFrame(
        rows, "n_units int, n_positive int, rate double, ci_low double, ci_high double, extra string"
    )
    assert found(df, risk_contract()) == {
        (None, "interval_contains_estimate"),
        (None, "positives_within_total"),
        ("n_units", "greater_than(0)"),
    }


def test_failures_carry_row_ids(spark):
    df = raw(spark, [("Z", 0, 0, 0, "Sim")]).withColumn("unit_id", F.lit(77))
    row = failures(df, raw_contract(ROLES), "unit_id").first()
    assert (row.schema_context, row.failure_case, row.row_id) == ("Column", "Z", "77")
