"""Sources and sinks on CSV fixtures written to a temp folder."""

import os

import pytest

from wattgrid.functions.channels import choose_target, detect_channels, feature_channels
from wattgrid.sources.readings import load_readings, read_wide_csv, select_channels
from wattgrid.sources.sinks import write_csv
from wattgrid.sources.weather import find_time_column, load_weather


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


COMBINED = """TimeSeriesVariable/@id,dateTime,data
TimeSeriesVariable1,2024-01-01 00:00:00,100
TimeSeriesVariable1,2024-01-01 00:00:00,150
TimeSeriesVariable2,2024-01-01 00:00:00,NaN
TimeSeriesVariable2,2024-01-01 00:00:00,7
TimeSeriesVariable10,2024-01-01 00:00:08,9
TimeSeriesVariable11,2024-01-01 00:00:08,99
TimeSeriesVariable0,2024-01-01 00:00:08,98
TimeSeriesVariable3,2024-01-01 00:00:16,NaN
"""


def test_combined_file_filter_rename_pivot(spark, tmp_dir):
    write(f"{tmp_dir}/REFIT_TIME_SERIES_VALUES/REFIT_TIME_SERIES_VALUES.csv", COMBINED)
    df = load_readings(spark, tmp_dir, home_id=1)
    assert df.columns[:5] == ["home_id", "ts", "Aggregate", "Appliance9", "Appliance1"]
    rows = df.orderBy("ts").collect()
    assert len(rows) == 2  # the NaN-only time is dropped
    assert (rows[0]["Aggregate"], rows[0]["Appliance1"]) == (100.0, 7.0)
    assert rows[1]["Appliance9"] == 9.0
    assert "Appliance10" not in df.columns


def test_wide_file_is_preferred_and_read(spark, tmp_dir):
    write(f"{tmp_dir}/REFIT_TIME_SERIES_VALUES/REFIT_TIME_SERIES_VALUES.csv", COMBINED)
    write(f"{tmp_dir}/REFIT_TIME_SERIES_VALUES/CLEAN_House3.csv",
          "timestamp,Aggregate,Appliance1\n2024-01-01 00:00:00,1.5,NaN\n2024-01-01 00:00:08,2.5,3\n")
    df = load_readings(spark, tmp_dir, home_id=3)
    rows = df.orderBy("ts").collect()
    assert [r["home_id"] for r in rows] == [3, 3]
    assert rows[0]["Appliance1"] is None and rows[1]["Appliance1"] == 3.0
    glob = read_wide_csv(spark, f"{tmp_dir}/REFIT_TIME_SERIES_VALUES/CLEAN_House*.csv")
    assert {r["home_id"] for r in glob.collect()} == {3}


def test_missing_input_lists_tried_paths(spark, tmp_dir):
    with pytest.raises(FileNotFoundError) as e:
        load_readings(spark, tmp_dir, home_id=5)
    assert "CLEAN_House5.csv" in str(e.value) and "REFIT_TIME_SERIES_VALUES.csv" in str(e.value)


def test_weather_source(spark, tmp_dir):
    assert load_weather(spark, f"{tmp_dir}/none.csv") is None
    write(f"{tmp_dir}/w.csv", "datetime,temperature,station\n2024-01-01 00:00:00,4.5,a\n2024-01-01 01:00:00,NaN,a\n")
    w = load_weather(spark, f"{tmp_dir}/w.csv")
    assert w.columns == ["ts", "temperature"]
    assert [r["temperature"] for r in w.orderBy("ts").collect()] == [4.5, None]
    assert find_time_column(["x", "obs_Time"]) == "obs_Time"
    with pytest.raises(ValueError):
        find_time_column(["x", "y"])


def test_channel_subset_and_detection(spark):
    df = spark.createDataFrame([(1, None, 1.0, 2.0)], "home_id long, ts timestamp_ntz, Aggregate double, A double")
    assert select_channels(df, ["Aggregate", "Nope"]).columns == ["home_id", "ts", "Aggregate"]
    with pytest.raises(ValueError):
        select_channels(df, ["Nope"])
    cols = ["Aggregate", "Appliance9", "Appliance1", "Aggregate_lag_1", "hour", "Appliance1_rolling_mean_4"]
    chans = detect_channels(cols)
    assert chans == ["Aggregate", "Appliance9", "Appliance1"]
    assert choose_target(chans) == "Aggregate" and choose_target(["Appliance2"]) == "Appliance2"
    assert feature_channels(chans, 2) == ["Aggregate", "Appliance9"]


def test_csv_sink(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    write_csv(df, f"{tmp_dir}/out", single_file=True)
    back = spark.read.option("header", True).csv(f"{tmp_dir}/out").collect()
    assert [(r["x"], r["y"]) for r in back] == [("1", "a")]


def test_load_and_prepare_with_weather(spark, tmp_dir):
    from wattgrid.sources.readings import load_and_prepare

    write(f"{tmp_dir}/CLEAN_House1.csv",
          "timestamp,Aggregate,Appliance1\n2024-01-01 00:00:00,1,2\n2024-01-01 02:00:00,3,4\n")
    write(f"{tmp_dir}/weather.csv", "timestamp,temperature\n2024-01-01 00:40:00,5.0\n2024-01-01 00:20:00,6.0\n")
    df = load_and_prepare(spark, tmp_dir, 1, f"{tmp_dir}/weather.csv", ["Aggregate"])
    assert df.columns == ["home_id", "ts", "Aggregate"]
    full = load_and_prepare(spark, tmp_dir, 1, f"{tmp_dir}/weather.csv")
    temps = [r["temperature"] for r in full.orderBy("ts").collect()]
    assert temps == [6.0, None]


def test_wide_files_are_read_by_name(spark, tmp_dir):
    write(f"{tmp_dir}/CLEAN_House1.csv", "timestamp,Aggregate,Appliance1\n2024-01-01 00:00:00,100,1\n")
    write(f"{tmp_dir}/CLEAN_House2.csv", "timestamp,Appliance1,Aggregate\n2024-01-01 00:00:00,2,200\n")
    write(f"{tmp_dir}/CLEAN_House3.csv", 'Appliance7,"timestamp"\n7,2024-01-01 00:00:00\n')
    rows = {r["home_id"]: r for r in load_readings(spark, tmp_dir, [1, 2, 3]).collect()}
    assert (rows[1]["Aggregate"], rows[2]["Aggregate"], rows[2]["Appliance1"]) == (100.0, 200.0, 2.0)
    assert rows[3]["Aggregate"] is None and rows[3]["Appliance7"] == 7.0
    write(f"{tmp_dir}/CLEAN_House4.csv", "time,Aggregate\n2024-01-01 00:00:00,1\n")
    with pytest.raises(ValueError):
        read_wide_csv(spark, f"{tmp_dir}/CLEAN_House*.csv")


def test_combined_file_by_name_and_by_dimension(spark, tmp_dir):
    write(f"{tmp_dir}/REFIT_TIME_SERIES_VALUES/REFIT_TIME_SERIES_VALUES.csv",
          "note,data,dateTime,TimeSeriesVariable/@id\nx,5,2024-01-01 00:00:00,TimeSeriesVariable11\n"
          "y,6,2024-01-01 00:00:00,TimeSeriesVariable1\n")
    dim = spark.createDataFrame([("TimeSeriesVariable11", 2, "Aggregate"), ("TimeSeriesVariable1", 1, "Aggregate")],
                                "variable_id string, home_id bigint, channel string")
    got = {r["home_id"]: r["Aggregate"] for r in load_readings(spark, tmp_dir, [1, 2], dim).collect()}
    assert got == {1: 6.0, 2: 5.0}
    assert [r["Aggregate"] for r in load_readings(spark, tmp_dir, 2, dim).collect()] == [5.0]
    with pytest.raises(ValueError):
        load_readings(spark, tmp_dir, 7)
    with pytest.raises(ValueError):
        load_readings(spark, tmp_dir, [1, 9], dim)


def test_headers_are_read_from_the_first_lines_only(spark, tmp_dir):
    """What is read for headers does not grow with the files."""
    from wattgrid.sources.readings import headers

    def bytes_read():
        stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getStatistics("file", spark._jvm.org.apache.hadoop.fs.RawLocalFileSystem().getClass())
        return stats.getBytesRead()

    read = {}
    for name, rows in (("small", 100), ("large", 400_000)):
        for k in range(3):
            order = ["timestamp", "Aggregate", f"Appliance{k}"]
            write(f"{tmp_dir}/{name}/CLEAN_House{k}.csv", ",".join(order) + "\n" + "2024-01-01 00:00:00,1.0,2.0\n" * rows)
        before = bytes_read()
        found = headers(spark, f"{tmp_dir}/{name}", "timestamp")
        read[name] = bytes_read() - before
        assert sorted(found) == [("timestamp", "Aggregate", f"Appliance{k}") for k in range(3)]
        assert all(len(files) == 1 for files in found.values())
    size = os.path.getsize(f"{tmp_dir}/large/CLEAN_House0.csv")
    assert read["large"] < 3 * size / 4, (read, size)
    with pytest.raises(ValueError, match="no column 'when'"):
        headers(spark, f"{tmp_dir}/small", "when")


def test_first_lines_come_from_the_first_block(spark, tmp_dir):
    """A file read in many blocks: no other block's lines take the header's place."""
    from wattgrid.sources.readings import header_lines, headers

    lines = ["dateTime,data", *(f"2024-01-01 00:00:00,{k}" for k in range(5000))]
    write(f"{tmp_dir}/long.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(f"{tmp_dir}/long.csv").rdd.getNumPartitions() > 20
        assert header_lines(spark, f"file:{tmp_dir}/long.csv") == lines[:20]
        assert list(headers(spark, f"{tmp_dir}/long.csv", "dateTime")) == [("dateTime", "data")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bad_lines_go_to_the_reject_table(spark, tmp_dir):
    from wattgrid.sources.readings import read_combined_csv, reject_counts, rejected_lines

    text = ("TimeSeriesVariable/@id,dateTime,data\nTimeSeriesVariable1,2024-01-01 00:00:00,1.5\n"
            "TimeSeriesVariable1,yesterday,2\nTimeSeriesVariable2,2024-01-01 00:01:00,many\n"
            "TimeSeriesVariable2,2024-01-01 00:02:00,\nTimeSeriesVariable2,2024-01-01 00:03:00,NaN\nTimeSeriesVariable3,,7\nshort\n")
    write(f"{tmp_dir}/long.csv", text)
    good = read_combined_csv(spark, f"{tmp_dir}/long.csv").collect()
    assert sorted((r["variable_id"], r["watts"]) for r in good if r["watts"]) == [("TimeSeriesVariable1", 1.5)]
    assert len(good) == 3
    rejects = rejected_lines(spark, f"{tmp_dir}/long.csv")
    assert {r["reason"]: r["n_lines"] for r in reject_counts(rejects).collect()} == {"time not readable": 3, "value not readable": 1}
    assert any('"yesterday"' in r["line"] for r in rejects.collect())
    write(f"{tmp_dir}/CLEAN_House4.csv", "timestamp,Aggregate,Appliance1\n2024-01-01 00:00:00,1,2\nbad,1,2\n2024-01-01 01:00:00,x,2\n")
    assert [r["Aggregate"] for r in read_wide_csv(spark, f"{tmp_dir}/CLEAN_House4.csv").collect()] == [1.0]
    wide = rejected_lines(spark, f"{tmp_dir}/CLEAN_House4.csv", "timestamp")
    assert sorted(r["reason"] for r in wide.collect()) == ["time not readable", "value not readable"]
