"""Writers."""

import os

import pytest
from shop import event, frame, random_events, rows_of

from pyspark.sql import functions as F

from sessionloom import sinks
from sessionloom.plans import feature_table


def parts(path):
    return [name for name in os.listdir(path) if name.startswith("part-")]


def test_round_trip_keeps_nulls_and_types(spark, tmp_path):
    features = feature_table(frame(spark, random_events(7)))
    path = str(tmp_path / "out")
    report = sinks.write_verified(features, path)
    again = sinks.read_features(spark, path)
    assert rows_of(again) == rows_of(features)
    assert any(row["brand"] is None for row in rows_of(again))
    assert report["rows"] == again.count() and report["files"] == len(parts(path))


def test_overwrite_and_compression(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.range(50), path)
    sinks.write_csv(spark.range(3), path, compression="gzip")
    assert spark.read.csv(path, header=True).count() == 3
    assert all(name.endswith(".csv.gz") for name in parts(path))


def test_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.range(0, 100, 1, 1), path, rows_per_file=30)
    assert len(parts(path)) == 4


@pytest.mark.parametrize("rows, partitions", [(0, 10), (1_999_999, 10), (2_200_000, 11), (60_000_000, 300)])
def test_optimal_partitions(rows, partitions):
    assert sinks.optimal_partitions(rows) == partitions


def test_repartitioned(spark, tmp_path):
    path = str(tmp_path / "out")
    assert sinks.write_repartitioned(spark.range(1000), path) == 10
    assert len(parts(path)) == 10


VALUES = [
    "plain", "", None, " b ", "line\nbreak", "cr\r\nlf", 'quo"te', '"', "back\\slash\\", ",", "\t", "null",
    "\\N", "é", '\\"',
]


@pytest.mark.parametrize("rows_per_file", [None, 2])
def test_every_text_survives(spark, tmp_path, rows_per_file):
    path = str(tmp_path / "out")
    table = spark.createDataFrame(list(enumerate(VALUES)), "n int, v string").repartition(3)
    assert sinks.write_verified(table, path, rows_per_file=rows_per_file)["rows"] == len(VALUES)
    found = {r.n: r.v for r in sinks.read_written(spark, table.schema).csv(path).collect()}
    assert [found[n] for n in range(len(VALUES))] == VALUES


def test_changed_values_are_an_error(spark, tmp_path, monkeypatch):
    write = sinks.csv.write_csv
    monkeypatch.setattr(sinks.csv, "write_csv", lambda df, *rest: write(df.withColumn("v", F.trim("v")), *rest))
    table = spark.createDataFrame([(" b ",), ("c",)], "v string")
    with pytest.raises(sinks.LoadVerificationError, match="values"):
        sinks.write_verified(table, str(tmp_path / "out"))


def test_incomplete_output_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")

    write = sinks.csv.write_csv

    def but_remove(choose):
        def wrapped(df, target, *options):
            write(df, target, *options)
            os.remove(os.path.join(target, choose(target)))

        monkeypatch.setattr(sinks.csv, "write_csv", wrapped)

    but_remove(lambda target: parts(target)[0])
    with pytest.raises(sinks.LoadVerificationError, match="found"):
        sinks.write_verified(spark.range(0, 100, 1, 4), path)

    but_remove(lambda target: "_SUCCESS")
    with pytest.raises(sinks.LoadVerificationError, match="marker"):
        sinks.write_verified(spark.range(10), path)


def test_empty_output_is_verified(spark, tmp_path):
    report = sinks.write_verified(feature_table(frame(spark, [event("07:00:00", "cart")])), str(tmp_path / "out"))
    assert report["rows"] == 0


def test_balanced_files(spark, tmp_path):
    """Nearly all rows in one partition, none in most, and one job from there."""
    path = str(tmp_path / "out")
    skewed = spark.range(20_000).repartition(8, F.when(F.col("id") < 19_900, 0).otherwise(F.col("id")))
    sinks.write_balanced(skewed, path, rows_per_file=1500)
    sizes = [row["count"] for row in spark.read.csv(path, header=True).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1500 and len(sizes) < 22
    plan = skewed.hint("rebalance")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan


def listed_output(spark, tmp_path):
    path = str(tmp_path / "out")
    features = feature_table(frame(spark, random_events(7))).repartition(3, "product_id")
    return path, features, sinks.write_listed(features, path, rows_per_file=20)


def test_files_that_are_whole(spark, tmp_path):
    path, features, listed = listed_output(spark, tmp_path)
    assert sinks.check_files(listed, path, features.schema) == {"rows": features.count(), "files": len(parts(path))}
    assert len(parts(path)) > 3 and max(row["rows"] for row in listed.collect()) <= 20


@pytest.mark.parametrize("damage", ["value", "row", "file", "more"])
def test_a_damaged_file_is_named(spark, tmp_path, damage):
    path, features, listed = listed_output(spark, tmp_path)
    name = sorted(parts(path))[1]
    lines = open(f"{path}/{name}").read().split("\n")
    os.remove(f"{path}/.{name}.crc")
    if damage == "value":
        lines[2] = lines[2].replace(",", "x,", 1)
    elif damage == "row":
        del lines[2]
    if damage == "file":
        os.remove(f"{path}/{name}")
    else:
        open(f"{path}/{name}", "w").write("\n".join(lines))
    if damage == "more":
        open(f"{path}/part-00999-x-c000.csv", "w").write("\n".join(lines))
    with pytest.raises(sinks.LoadVerificationError) as error:
        sinks.check_files(listed, path, features.schema)
    expected = {"file": name[:10], "more": "part-00999-x-c000.csv"}.get(damage, name)
    assert expected in str(error.value)
    assert sum(part in str(error.value) for part in parts(path)) == (damage != "file")


def test_line_breaks_and_splits(spark, tmp_path):
    broken = spark.createDataFrame([("a\nb", 1), (None, 2), ("", 3), ('q"\r\n', 4)], "text string, n int")
    assert sinks.write_verified(broken, str(tmp_path / "broken"))["rows"] == 4
    listed = sinks.write_listed(broken, str(tmp_path / "listed"))
    assert sinks.check_files(listed, str(tmp_path / "listed"), broken.schema)["rows"] == 4
    plain = spark.range(0, 30_000, 1, 1).select("id", F.lit("text").alias("text"))
    assert sinks.write_verified(plain, str(tmp_path / "plain")) == {"rows": 30_000, "files": 1}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        read = lambda breaks: sinks.read_written(spark, plain.schema, breaks).csv(str(tmp_path / "plain"))
        assert read(False).rdd.getNumPartitions() > 5 and read(True).rdd.getNumPartitions() == 1
        assert sinks.write_verified(plain, str(tmp_path / "again"))["rows"] == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_listed_output_without_rows(spark, tmp_path):
    none = spark.range(0).select("id", F.lit("x").alias("text"))
    listed = sinks.write_listed(none, str(tmp_path / "none"))
    assert sinks.check_files(listed, str(tmp_path / "none"), none.schema) == {"rows": 0, "files": 0}
