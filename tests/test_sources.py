import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.functions.expressions import coefficient_line
from millrace.operators import logistic
from millrace.session import scratch_path
from millrace.sources import readers, writers


def _text_file(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_missing_texts_become_null(spark, tmp_path):
    cells = ["NA", "", "NaN", "null", "N/A", " nan ", "1.5", "-2e3"]
    path = _text_file(tmp_path, "a,b\n" + "".join(f"{c},1\n" for c in cells))
    rows = readers.read_csv(spark, path).collect()
    assert sorted((r.a for r in rows), key=str) == sorted([None] * 6 + [1.5, -2000.0], key=str)
    assert dict(readers.read_csv(spark, path).dtypes) == {"a": "double", "b": "double"}


def test_malformed_number(spark, tmp_path):
    path = _text_file(tmp_path, "a,b\n1,x7\n2,3\n")
    with pytest.raises(Exception, match="not a number: x7"):
        readers.read_csv(spark, path).collect()
    rows = readers.read_csv(spark, path, malformed="null").orderBy("a").collect()
    assert [r.b for r in rows] == [None, 3.0]
    assert readers.read_csv(spark, path).agg(F.sum("a")).first()[0] == 3.0  # b is not even read
    with pytest.raises(ValueError):
        readers.read_csv(spark, path, malformed="skip")


def test_known_columns_must_match_header(spark, tmp_path):
    path = _text_file(tmp_path, "a,b\n1,2\n")
    assert readers.read_csv(spark, path, ["a", "b"]).collect() == [Row(a=1.0, b=2.0)]
    with pytest.raises(Exception, match="CSV header"):
        readers.read_csv(spark, path, ["b", "a"]).collect()


def test_csv_round_trip_is_exact(spark, tmp_path):
    values = [0.1, 1 / 3, 1e-300, 1.7976931348623157e308, -0.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v double")
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    back = {int(r.k): r.v for r in readers.read_csv(spark, path, ["k", "v"]).collect()}
    assert back == dict(enumerate(values))
    with pytest.raises(Exception, match="already exists"):
        writers.write_csv(df, path)


def test_inferred_types(spark, tmp_path):
    path = _text_file(tmp_path, "a,b\n1,2.5\n")
    assert dict(readers.read_csv_inferred(spark, path).dtypes) == {"a": "int", "b": "double"}


def test_split_files_are_tied_by_key(spark):
    df = spark.range(20).select("id", (F.col("id") * 2).alias("x"), (F.col("id") % 2).alias("y"),
                                F.when(F.col("id") < 15, "train").otherwise("test").alias("part"))
    path = scratch_path(spark, "splits")
    writers.write_splits(df, path, ["id", "x", "y"])
    x = readers.read_split(spark, path, "test", ["id", "x"])
    y = readers.read_split(spark, path, "test", ["id", "y"])
    assert sorted(map(tuple, x.join(y, "id").collect())) == [(i, 2 * i, i % 2) for i in range(15, 20)]
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "y" not in plan.split("ReadSchema")[1].split(">")[0]


def test_labelled_arrays_match_the_fixed_schema(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (0.0, 5.0, 6.0)], "label double, a double, b double")
    arrays = readers.labelled_arrays(df, "label", ["b", "a"])
    assert [(r.label, r.features) for r in arrays.collect()] == [(1.0, [3.0, 2.0]), (0.0, [6.0, 5.0])]
    local = readers.from_local(spark, [(1.0, [3.0, 2.0]), (0.0, [6.0, 5.0])])
    assert local.collect() == arrays.collect()
    assert local.schema["features"].dataType.elementType == arrays.schema["features"].dataType.elementType


def test_libsvm_round_trip(spark):
    df = spark.createDataFrame([(1, 0.5, 0.0), (0, 0.0, 2.0)], "label int, a double, b double")
    path = scratch_path(spark, "libsvm")
    writers.write_libsvm(df, path, "label", ["a", "b"])
    rows = readers.read_libsvm(spark, path, 2).collect()
    assert sorted((r.label, tuple(r.features.toArray())) for r in rows) == [(0.0, (0.0, 2.0)), (1.0, (0.5, 0.0))]


def test_libsvm_refuses_missing_values(spark):
    df = spark.createDataFrame([(1, None)], "label int, a double")
    with pytest.raises(Exception):
        writers.write_libsvm(df, scratch_path(spark, "libsvm"), "label", ["a"])


def test_coefficient_file_names_every_weight(spark):
    path = scratch_path(spark, "beta")
    writers.write_coefficients(logistic.vector_frame(spark, ["HighBP", "HighChol"], [-0.346595, 0.6288791, 0.5]), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["(intercept,-0.346595)", "(HighBP,0.628879)", "(HighChol,0.500000)"]
    with pytest.raises(ValueError):
        logistic.vector_frame(spark, ["HighBP"], [1.0, 2.0, 3.0])


def test_survey_columns():
    assert len(readers.SURVEY_FEATURES) == 21 and len(set(readers.SURVEY_FEATURES)) == 21
    assert readers.SURVEY_FEATURES_NO_STATUS[-1] == "Age"
    assert set(readers.SURVEY_SCALED) <= set(readers.SURVEY_FEATURES)


def test_names_labels_and_spread(spark):
    df = spark.createDataFrame([(1, 0, 2.0)], "k int, label int, a double")
    assert readers.feature_names(df, "label") == ["k", "a"]
    assert readers.feature_names(df, "label", "k") == ["a"]
    assert readers.features_only(df, "label").columns == ["k", "a"]
    assert readers.labels_only(df, "label", "k").columns == ["k", "label"]
    many = readers.spread(spark.range(1000), 20)
    assert many.rdd.getNumPartitions() == 20 and many.count() == 1000


def test_coefficient_line_text(spark):
    assert spark.range(1).select(coefficient_line(F.lit("x"), F.lit(1.5))).first()[0] == "(x,1.500000)"


def test_ragged_lines_are_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    for line in ("4,5", "6,7,8,9"):
        path = tmp_path / f"{len(line)}.csv"
        path.write_text(f"a,b,c\n1,2,3\n{line}\n")
        for columns in (None, ["a", "b", "c"]):
            df = readers.read_csv(spark, str(path), columns)
            for wanted in (df, df.select("a")):
                with pytest.raises(Exception, match="(?i)malformed"):
                    wanted.collect()
    rows = readers.read_csv(spark, str(tmp_path / "t.csv"), malformed="null").collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0, 3.0), (4.0, 5.0, None), (6.0, 7.0, 8.0)]


def test_column_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,name,x\n9007199254740993, one ,1\n9007199254740992,NA,2.5\n")
    df = readers.read_csv(spark, str(tmp_path), types={"k": "long", "name": "string"})
    assert sorted(map(tuple, df.collect())) == [(9007199254740992, None, 2.5), (9007199254740993, " one ", 1.0)]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path), types={"k": "int"})


def test_splits_as_csv(spark, tmp_path):
    df = spark.range(9).select("id", F.when(F.col("id") < 6, "train").otherwise("test").alias("part"))
    path = str(tmp_path / "out")
    writers.write_splits(df, path, ["id"], form="csv")
    assert readers.read_csv(spark, f"{path}/part=test", ["id"]).count() == 3
    with pytest.raises(ValueError):
        writers.write_splits(df, path, ["id"], form="orc")
