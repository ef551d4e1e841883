import pytest
from pyspark.sql import functions as F

from riskloom.operators import contracts
from riskloom.operators.cleaning import binarise_label, clean, drop_duplicate_rows, label_as_text
from riskloom.operators.contracts import ContractError, raw_contract
from riskloom.plans import mart
from riskloom.roles import Roles
from riskloom.sources import tables

ROLES = Roles(groups=("A", "B"))
SCHEMA = "grp string, age bigint, usage_km bigint, events bigint, label string"
ROWS = [
    ("A", 0, 1000, 0, "Não"),
    ("A", 0, 1000, 0, "Não"),
    ("B", 3, 55000, 3, "Sim"),
    ("A", 5, 90000, 6, "Sim"),
    ("B", 8, 140000, 11, "Sim"),
]


@pytest.fixture
def source(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_one_of_equal_rows_is_kept(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    assert sorted(map(tuple, drop_duplicate_rows(df).collect())) == [(1, "x"), (2, "y")]


def test_cleaning_is_idempotent(source):
    once = clean(source, ROLES)
    twice = clean(once, ROLES)
    assert once.count() == 4
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert dict(once.dtypes)["label"] == "boolean"


def test_label_round_trip(source):
    back = label_as_text(binarise_label(source, ROLES), ROLES)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_unknown_label_is_an_error(spark):
    df = spark.createDataFrame([("Sim",), ("Nao",)], "label string")
    with pytest.raises(ValueError, match="Nao"):
        binarise_label(df, ROLES)


def test_report_counts_are_texts(source):
    cleaned = mart.clean_step(source, ROLES)
    report = {r["check"]: r["value"] for r in cleaned.report.collect()}
    assert report["duplicates removed"] == "1"
    assert report["target rate"] == "0.7500"
    assert report["null values"] == "0"
    assert set(dict(cleaned.report.dtypes).values()) == {"string"}


def test_strict_cleaning_refuses_bad_rows(spark):
    bad = spark.createDataFrame([*ROWS, ("Z", 1, 1, 1, "Sim")], SCHEMA)
    with pytest.raises(ContractError, match="grp: isin x 1"):
        mart.clean_step(bad, ROLES)


def test_chain_writes_and_reads_back(spark, source, tmp_path):
    target = str(tmp_path / "mart")
    source.write.parquet(str(tmp_path / "source"))
    cleaned, built = mart.run(spark, str(tmp_path / "source"), target, ROLES)
    assert mart.run_counts(cleaned, built) == {
        "clean_rows": 4, "duplicates_removed": 1, "feature_columns": 11, "aggregates": 4,
    }
    names = ["clean", "features", *mart.AGGREGATES]
    assert tables.missing_layers(spark, target, [*names, "absent"]) == ["absent"]
    ranking = tables.read_aggregate(spark, target, "risk_ranking", list(mart.AGGREGATES))
    assert [r["grp"] for r in ranking.orderBy("position").collect()] == ["B", "A"]
    with pytest.raises(KeyError, match="options"):
        tables.read_aggregate(spark, target, "other", list(mart.AGGREGATES))
    with pytest.raises(FileNotFoundError, match="run the step"):
        tables.read_layer(spark, str(tmp_path / "nothing"))
    view = tables.register_parquet(spark, f"{target}/clean", "clean_units")
    assert spark.sql("select count(*) from clean_units").first()[0] == view.count()


def test_headers(spark):
    assert tables.header_name("Reclamações") == "reclamacoes"
    assert tables.header_name("  Idade  Veículo (anos) ") == "idade_veiculo_anos"
    clash = spark.createDataFrame([(1, 2)], ["Âge", "age "])
    with pytest.raises(ValueError, match="same name"):
        tables.normalise_headers(clash)


def test_csv_source_with_strange_headers(spark, tmp_path):
    path = tmp_path / "units.csv"
    path.write_text("GRP,Âge,Usage km,Events,LABEL\nA,3,1000,2,Sim\nB,4,2000,1,Não\n", encoding="utf-8")
    df, report, failed = tables.load_source(spark, str(path), ROLES, fmt="csv")
    assert df.columns == ["grp", "age", "usage_km", "events", "label"]
    assert report.first().conforming and failed.count() == 0
    assert mart.clean_step(df, ROLES).table.filter("label").count() == 1
    path.write_text("grp,age,usage_km,events\nA,3,1000,2\n")
    with pytest.raises(ValueError, match=r"lacks label"):
        tables.read_source(spark, str(path), ROLES, fmt="csv")


def test_records_round_trip(spark, tmp_path):
    record = {"model": "logistic", "columns": ["a", "ção"], "value": 0.79}
    tables.write_record(spark, record, str(tmp_path / "r"))
    assert tables.read_record(spark, str(tmp_path / "r")) == record


def test_canonical_view_serves_text_and_boolean(source):
    text = mart.query(source, "risk_ranking", ROLES).collect()
    boolean = mart.query(source.withColumn("label", F.col("label") == "Sim"), "risk_ranking", ROLES)
    assert text == boolean.collect()
    with pytest.raises(KeyError, match="unknown query"):
        mart.query(source, "nothing", ROLES)


def test_units_that_differ_only_in_their_id_stay(spark, tmp_path):
    rows = [(u, "A", 3, 1_000, 2, "Sim") for u in range(30)] + [(0, "A", 3, 1_000, 2, "Sim")]
    df = spark.createDataFrame(rows, "unit_id long, grp string, age long, usage_km long, events long, label string")
    df.write.parquet(str(tmp_path / "source"))
    cleaned, _ = mart.run(spark, str(tmp_path / "source"), roles=ROLES)
    assert cleaned.table.count() == 30 and "unit_id" in cleaned.table.columns
    report = {r["check"]: r for r in cleaned.report.collect()}
    assert report["duplicates removed"]["value"] == "1" and "no unit id" not in report["duplicates removed"]["detail"]
    # A further column of the source counts when rows are compared, and is then left out.
    df.withColumn("seen_at", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "wide"))
    wide, _ = mart.run(spark, str(tmp_path / "wide"), roles=ROLES)
    assert wide.table.count() == 31 and "seen_at" not in wide.table.columns


def test_failures_carry_the_unit_id(spark, tmp_path):
    rows = [(7, "A", 3, -5, 2, "Sim"), (8, "B", 3, 10, 2, "Sim")]
    df = spark.createDataFrame(rows, "unit_id long, grp string, age long, usage_km long, events long, label string")
    df.write.parquet(str(tmp_path / "s"))
    table, report, failed = tables.load_source(spark, str(tmp_path / "s"), ROLES, keep=["unit_id"])
    assert {r.row_id for r in failed.collect()} == {"7"} and not report.first().conforming
    with pytest.raises(ValueError):
        tables.load_source(spark, str(tmp_path / "s"), ROLES, strict=True)
    df.filter("unit_id = 8").write.parquet(str(tmp_path / "good"))
    tables.load_source(spark, str(tmp_path / "good"), ROLES, strict=True, keep=["unit_id"])


def test_all_unknown_labels_are_counted(spark):
    df = spark.createDataFrame([("A", 1, 1, 1, f"x{i}") for i in range(25)], "grp string, age int, usage_km int, events int, label string")
    with pytest.raises(ValueError, match=r"and 5 more, 25 rows in all"):
        binarise_label(df, ROLES)


# ------------------------------------------------------------------ checks that ride on a write


def test_observed_check_raises_like_require(spark):
    contract = raw_contract(ROLES)
    rows = [("A", 3, 100, 0, "Sim"), ("Z", 3, -1, 0, "Sim")]
    df = spark.createDataFrame(rows, "grp string, age bigint, usage_km bigint, events bigint, label string")
    counted, holds = contracts.observed(df, contract)
    counted.write.format("noop").mode("overwrite").save()
    with pytest.raises(contracts.ContractError) as error:
        holds()
    with pytest.raises(contracts.ContractError) as direct:
        contracts.require(df, contract)
    assert str(error.value) == str(direct.value)
    good, holds = contracts.observed(df.filter("grp = 'A'"), contract)
    assert good.count() == 1
    holds()
    with pytest.raises(contracts.ContractError):
        contracts.observed(df.drop("age"), contract)


def test_cleaning_reads_the_source_once(spark):
    """The table is written by the pass that checks source and result; only the row count reads the source again."""
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("A", 3, 100, 0, "Sim"), ("B", 4, 200, 1, "Não"), ("B", 4, 200, 1, "Não")]
    df = spark.createDataFrame(rows, "grp string, age bigint, usage_km bigint, events bigint, label string")
    source = df.mapInArrow(noted, df.schema)
    cleaned = mart.clean_step(source, ROLES)
    assert seen.value == 3
    assert cleaned.table.count() == 2
    assert {r["check"]: r["value"] for r in cleaned.report.collect()}["duplicates removed"] == "1"
