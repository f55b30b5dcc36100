import pytest

from tessella.operators import inspection, quality
from tessella.sinks.tables import write_csv
from tessella.sources.customers import CUSTOMER_SCHEMA, read_customers_csv

HEADER = ",".join(f.name for f in CUSTOMER_SCHEMA)


@pytest.fixture
def customers_csv(tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(
        f"{HEADER}\n"
        "1,619,France,Female,42,2,0.0,1,1,1,101348.88,1\n"
        "2,608,,Female,41,1,83807.86,1,0,1,112542.58,0\n"
        "3,502,Spain,Male,,8,159660.8,3,1,0,,1\n"
    )
    return str(path)


def test_csv_with_declared_schema(spark, customers_csv):
    df = read_customers_csv(spark, customers_csv)
    assert df.schema == CUSTOMER_SCHEMA
    rows = {r["customer_id"]: r for r in df.collect()}
    assert rows[1]["balance"] == 0.0
    assert rows[2]["country"] is None
    assert rows[3]["age"] is None and rows[3]["estimated_salary"] is None


def test_csv_with_inferred_schema(spark, customers_csv):
    df = read_customers_csv(spark, customers_csv, schema=None)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types["customer_id"] == "int" and types["age"] == "int"
    assert types["balance"] == "double" and types["country"] == "string"
    assert df.filter("country IS NULL").count() == 1


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text(HEADER.replace("age,tenure", "tenure,age") + "\n1,2,a,b,3,4,5,6,7,8,9,0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_customers_csv(spark, str(path)).collect()


def test_csv_round_trip(spark, customers_csv, tmp_path):
    df = read_customers_csv(spark, customers_csv)
    write_csv(df, str(tmp_path / "out"))
    back = read_customers_csv(spark, str(tmp_path / "out"))
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_schema_report(spark, customers_csv):
    rows = inspection.schema_report(read_customers_csv(spark, customers_csv)).collect()
    assert [r["column_name"] for r in rows] == [f.name for f in CUSTOMER_SCHEMA]
    assert {(r["n_columns"], r["n_rows"]) for r in rows} == {(12, 3)}


def test_missing_values(spark, customers_csv):
    rows = quality.missing_columns(read_customers_csv(spark, customers_csv)).collect()
    assert {(r["column_name"], r["missing"], r["missing_percent"]) for r in rows} == {
        ("country", 1, 33.33),
        ("age", 1, 33.33),
        ("estimated_salary", 1, 33.33),
    }


def test_nan_is_a_value_and_an_empty_table_is_no_error(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    assert quality.missing_values(df).first()["missing"] == 1
    row = quality.missing_values(df.limit(0)).first()
    assert (row["missing"], row["missing_percent"]) == (0, None)


def test_missing_values_is_one_aggregate(spark, customers_csv):
    df = quality.missing_values(read_customers_csv(spark, customers_csv))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1 and plan.count("Exchange") == 1
