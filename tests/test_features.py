from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keeprate.functions import columns as C
from keeprate.operators import encode, project
from keeprate.plans.models import stratified_folds
from keeprate.schema import FEATURES, file_schema
from keeprate.sources import files

# An invented record under file names, with values worked out by hand below.
SAMPLE = {
    "State": "ZZ", "Account length": 200, "Area code": 700, "International plan": "Yes", "Voice mail plan": "No",
    "Number vmail messages": 0, "Total day minutes": 150.5, "Total day calls": 60, "Total day charge": 31.25,
    "Total eve minutes": 88.0, "Total eve calls": 40, "Total eve charge": 9.5, "Total night minutes": 61.5,
    "Total night calls": 25, "Total night charge": 4.75, "Total intl minutes": 20.0, "Total intl calls": 8,
    "Total intl charge": 6.5, "Customer service calls": 4,
}


def test_engineered_values_of_the_sample(spark):
    row = encode.engineered(files.customers_from_records(spark, [SAMPLE])).first()
    assert row.total_calls == 133
    assert row.total_charge == pytest.approx(52.0)
    assert row.cs_rate == pytest.approx(4 / 201)
    other = encode.engineered(files.customers_from_records(spark, [SAMPLE]), offset=0).first()
    assert other.cs_rate == pytest.approx(0.02)


def test_rate_of_age_zero_is_null_without_offset(spark):
    df = files.customers_from_records(spark, [SAMPLE | {"Account length": 0}])
    assert encode.engineered(df, offset=0).first().cs_rate is None
    assert encode.engineered(df).first().cs_rate == 4.0


@pytest.mark.parametrize("p, confidence, risk", [
    (0.0, 1.0, "Low"), (0.29999, 0.40002, "Low"), (0.3, 0.4, "Medium"), (0.5, 0.0, "Medium"),
    (0.59999, 0.19998, "Medium"), (0.6, 0.2, "High"), (1.0, 1.0, "High"),
])
def test_confidence_and_risk(spark, p, confidence, risk):
    row = spark.range(1).select(
        C.confidence(F.lit(p)).alias("c"), C.risk_level(F.lit(p)).alias("r")
    ).first()
    assert row.c == pytest.approx(confidence, abs=1e-12) and row.r == risk


def test_flags_map_unknown_to_null(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (None,)], "p string")
    assert [r[0] for r in df.select(C.yes_no_flag("p")).collect()] == [1, 0, None, None]


def test_versions_as_numbers(spark):
    df = spark.createDataFrame([("1.10",), ("1.2",), ("2.0",), ("x",)], "v string")
    assert [r.v for r in df.orderBy(C.version_number("v")).collect()] == ["x", "1.2", "1.10", "2.0"]
    assert {r.v: r.n for r in df.select("v", C.next_version("v").alias("n")).collect()} == {
        "1.10": "1.11", "1.2": "1.3", "2.0": "2.1", "x": "1.1",
    }


def test_display_formats(spark):
    row = spark.range(1).select(C.fixed_digits(F.lit(0.86046)).alias("a"), C.as_percent(F.lit(0.1234)).alias("b")).first()
    assert (row.a, row.b) == ("0.8605", "12.34%")


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, None, 3)], "a int, b int, c int")
    out = project.align(df, ["c", "State_TX", "b"], 0)
    assert out.columns == ["c", "State_TX", "b"] and tuple(out.first()) == (3, 0, None)


def test_label_codes_reject_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    coded = {r.t: r.t_code for r in encode.label_codes(train, "t").collect()}
    assert coded == {"a": 0, "b": 1, None: 2}
    with pytest.raises(Exception, match="unseen label"):
        encode.label_codes(train, "t", spark.createDataFrame([("zz",)], "t string")).collect()


def test_one_hot_stage_gives_zeros_for_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    model = Pipeline(stages=encode.one_hot_stages(["t"])).fit(train)
    rows = model.transform(spark.createDataFrame([("a",), ("zz",), (None,)], "t string"))
    assert [r[0] for r in rows.select(vector_to_array("t_hot")).collect()] == [[1, 0, 0], [0, 0, 0], [0, 0, 0]]


def test_scaler_uses_population_deviation_and_zero_for_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    raw = encode.assembler(["a", "b"], "raw").transform(df)
    for stage in encode.fit_scaler(raw, "raw", "scaled"):
        raw = stage.transform(raw)
    got = [r[0] for r in raw.select(vector_to_array("scaled")).collect()]
    deviation = (((1 - 3) ** 2 + (2 - 3) ** 2 + (6 - 3) ** 2) / 3) ** 0.5
    assert [g[0] for g in got] == pytest.approx([(x - 3) / deviation for x in (1, 2, 6)])
    assert [g[1] for g in got] == [0, 0, 0]
    columns = encode.standard_scaled(df, ["a", "b"]).collect()
    assert [r.a for r in columns] == pytest.approx([g[0] for g in got]) and [r.b for r in columns] == [0, 0, 0]


def test_validation_sends_faults_to_quarantine(spark):
    names = [f.name for f in file_schema(with_label=False).fields]
    good = [str(SAMPLE[n]) for n in names]
    bad = ["oops" if n == "Area code" else None if n == "State" else str(SAMPLE[n]) for n in names]
    raw = spark.createDataFrame([good, bad], ", ".join(f"`{n}` string" for n in names))
    accepted, rejected = files.validate(raw)
    assert accepted.columns == FEATURES and accepted.count() == 1
    assert accepted.first().day_charge == 31.25
    assert rejected.first().faults == ["State", "Area code"] and rejected.first()["Area code"] == "oops"


def test_folds_deal_the_surplus_onward(spark):
    df = spark.createDataFrame([(i, int(i >= 7)) for i in range(12)], "customer_id long, label int")
    rows = stratified_folds(df).collect()
    sizes = [[sum(r.label == label and r.fold == f for r in rows) for f in range(5)] for label in (0, 1)]
    assert sizes == [[2, 2, 1, 1, 1], [1, 1, 1, 1, 1]]
    rows = stratified_folds(df.withColumn("label", (F.col("customer_id") >= 6).cast("int")), folds=4).collect()
    assert [[sum(r.label == label and r.fold == f for r in rows) for f in range(4)] for label in (0, 1)] == [[2, 2, 1, 1], [1, 1, 2, 2]]


def test_folds_are_contiguous_and_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 7 == 3).cast("int").alias("label"))
    rows = stratified_folds(df).orderBy("customer_id").collect()
    for label in (0, 1):
        folds = [r.fold for r in rows if r.label == label]
        assert folds == sorted(folds) and set(folds) == set(range(5))
        sizes = [folds.count(f) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
