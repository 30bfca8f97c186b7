import pytest
from helpers import series, values
from pyspark.sql import functions as F

from meterloom.catalog.adapters import load_table, weather_readings
from meterloom.plans.prepare import clean_weather, prepare
from meterloom.session import shared_folder, stage
from meterloom.sources import readers, writers

SF_DIR = "/root/testdata/sf0.001"


def test_load_file(spark, tmp_path):
    path = tmp_path / "load.csv"
    path.write_text(
        "Start der Messung;Start der Messung (Text);Stromverbrauch;Grundversorgte Kunden;Jahr;Wochentag\n"
        "2024-03-31T01:45:00+01:00;x;10.5;;2024;6\n"
        "2024-03-31T03:00:00+02:00;x;abc;7;2024;6\n"
        "kaputt;x;3;1;2024;6\n"
    )
    df = readers.read_load_csv(spark, str(path))
    rows = df.where("ts is not null").orderBy("ts").collect()
    assert [(str(r.ts_text), r.load_kwh, r.base_customers) for r in rows] == [("x", 10.5, None), ("x", None, 7.0)]
    assert values(df.where("ts is not null"), F.date_format("ts", "HH:mm").alias("t")) == ["00:45", "01:00"]
    assert df.where("ts is null").count() == 1
    with pytest.raises(FileNotFoundError):
        readers.read_load_csv(spark, str(tmp_path / "absent.csv"))


def test_weather_files(spark, tmp_path):
    header = '"station_abbr";" Date and Time ";"Lufttemperatur 2 m ü. Boden";"Globalstrahlung; Zehnminutenmittel"\n'
    one, two = tmp_path / "1.csv", tmp_path / "2.csv"
    one.write_text(header + "XYZ;01.02.2020 00:00;1,5;3\nXYZ;01.02.2020 00:10;-0,25;-\n", encoding="latin1")
    two.write_text(header + "XYZ;01.02.2020 00:10;9,0;4\n", encoding="latin1")
    df = clean_weather(readers.read_weather_csv(spark, [str(one), str(two)]))
    assert values(df, "temp_2m", "global_rad") == [(1.5, 3.0), (9.0, 4.0)]


def test_bad_stamp_is_strict_by_default(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("Date and Time;relative Luftfeuchtigkeit\n31.02.2020 00:00;5\n", encoding="latin1")
    with pytest.raises(Exception):
        readers.read_weather_csv(spark, [str(path)]).collect()
    assert readers.read_weather_csv(spark, [str(path)], strict=False).where("ts is null").count() == 1
    path.write_text("Zeit;x\n1;2\n")
    with pytest.raises(ValueError):
        readers.read_weather_csv(spark, [str(path)])


def test_report_is_one_file(spark, tmp_path):
    writers.write_report(spark.range(5).repartition(4), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def test_shared_folder_is_the_named_one(spark):
    before = shared_folder(spark)
    assert before.endswith(shared_folder(spark).rsplit("/", 1)[-1])
    df = series(spark, [(0, 1.0)], ["v double"])
    assert values(stage(df), "v") == [1.0]


@pytest.fixture(scope="module")
def feature_plan(spark):
    load = stage(load_table(spark, SF_DIR))
    weather = stage(clean_weather(weather_readings(spark, SF_DIR)))
    return prepare(load, weather)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_feature_plan_has_no_single_partition_and_no_python(feature_plan):
    assert "SinglePartition" not in feature_plan and "Python" not in feature_plan
    assert "CartesianProduct" not in feature_plan and "NestedLoop" not in feature_plan


def test_feature_plan_reads_only_what_it_needs(feature_plan):
    assert "ReadSchema: struct<series_id:string,ts:timestamp>" in feature_plan


def test_windows_reuse_the_chunk_layout(feature_plan):
    by_chunk = [l for l in feature_plan.splitlines() if "hashpartitioning(series_id" in l and "_chunk" in l]
    # Besides the layouts asked for, only the chunk summary moves to join its rows.
    assert sum("ENSURE_REQUIREMENTS" in l for l in by_chunk) == 1
    assert sum("REPARTITION_BY_COL" in l for l in by_chunk) >= 3


def test_period_filter_reaches_the_scan(spark, tmp_path):
    from meterloom.config import DatasetConfig
    from meterloom.plans.dataset import load_and_split

    writers.write_features(prepare(load_table(spark, SF_DIR)), str(tmp_path / "f"))
    cfg = DatasetConfig(period=("2024-01-10 00:00:00", "2024-01-11 00:00:00"))
    data = load_and_split(spark, str(tmp_path / "f"), cfg)
    plan = data.rows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ts_month" in plan.split("PartitionFilters")[1].splitlines()[0]


def test_one_day_reads_its_month_only(spark, tmp_path):
    """Three months are stored; the files that hold rows of the day belong to one of them, and rows are right."""
    from meterloom.plans.dataset import in_period
    from meterloom.sources.readers import read_features

    load = load_table(spark, SF_DIR)
    shifted = [load.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(31 * k))) for k in (1, 2)]
    features = prepare(stage(load.union(shifted[0]).union(shifted[1])))
    writers.write_features(features, str(tmp_path / "f"))
    assert len(list((tmp_path / "f").glob("ts_month=*"))) > 2
    stored = read_features(spark, str(tmp_path / "f"))
    day = in_period(stored, "2024-02-10 00:00:00", "2024-02-10 23:45:00")
    assert {r[0] for r in day.select("ts_month").distinct().collect()} == {"2024-02"}
    plan = day._jdf.queryExecution().executedPlan()
    day.collect()
    scan = plan.collectLeaves().apply(0)
    read = scan.metrics().get("numFiles").get().value() if scan.metrics().contains("numFiles") else None
    files = len(list((tmp_path / "f").glob("ts_month=2024-02/*.parquet")))
    assert read in (None, 0, files)
    want = features.where("ts between timestamp '2024-02-10 00:00:00' and timestamp '2024-02-10 23:45:00'").count()
    assert day.count() == want > 0


def test_swapped_columns_of_a_second_file_fail_loudly(spark, tmp_path):
    from meterloom.sources.headers import LOAD_HEADERS
    from meterloom.sources.readers import read_load_csv

    back = {name: header for header, name in LOAD_HEADERS.items()}
    load_name, base_name, stamp = back["load_kwh"], back["base_customers"], back["ts"]
    folder = tmp_path / "load"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{stamp};{load_name};{base_name}\n2024-01-01T00:00:00+00:00;5;1\n")
    (folder / "b.csv").write_text(f"{stamp};{load_name};{base_name}\n2024-01-01T00:15:00+00:00;6;2\n")
    got = sorted((r.load_kwh, r.base_customers) for r in read_load_csv(spark, str(folder)).collect())
    assert got == [(5.0, 1.0), (6.0, 2.0)]
    (folder / "c.csv").write_text(f"{stamp};{base_name};{load_name}\n2024-01-01T00:30:00+00:00;3;7\n")
    with pytest.raises(Exception, match="CSV header"):
        read_load_csv(spark, str(folder)).collect()


def test_whole_numbers_from_text(spark):
    from meterloom.functions.numeric import try_long

    df = spark.createDataFrame([("1",), ("1.0",), ("-3.00",), ("12.7",), ("x",), (None,), ("9007199254740993",)], "c string")
    assert [r[0] for r in df.select(try_long("c")).collect()] == [1, 1, -3, None, None, None, 9007199254740993]


def test_strict_stamps_fail_without_ansi(spark):
    from meterloom.sources.readers import parse_stamp

    df = spark.createDataFrame([("01.02.2024 03:04",), (None,)], "s string")
    bad = spark.createDataFrame([("2024-02-01",)], "s string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [str(r[0]) for r in df.select(parse_stamp("s")).collect()] == ["2024-02-01 03:04:00", "None"]
        with pytest.raises(Exception, match="not a stamp"):
            bad.select(parse_stamp("s")).collect()
        assert bad.select(parse_stamp("s", strict=False)).first()[0] is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_repeated_load_keys_fail(spark):
    load = load_table(spark, SF_DIR)
    with pytest.raises(Exception, match="repeated load key"):
        prepare(stage(load.union(load.limit(1)))).collect()


def test_staged_tables_can_be_cleared(spark):
    from pathlib import Path

    from meterloom.session import stage_folder

    own = spark.newSession()
    table = stage(own.range(3))
    folder = Path(stage_folder(own).removeprefix("file:"))
    assert table.count() == 3 and folder.is_dir()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from meterloom.session import shared_folder

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared_folder(session)


def test_small_side_is_broadcast_only_when_its_measured_size_allows(spark):
    from meterloom.operators.ordering import salted_join

    big = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = salted_join(big, small, ["k"], ["id"])
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    want = joined.agg(F.sum("n"), F.count("id")).first()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(big, small, ["k"], ["id"])
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.sum("n"), F.count("id")).first() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert want[1] == 5000


def test_feature_plan_gives_the_same_rows_without_broadcasts(spark):
    def total():
        load = stage(load_table(spark, SF_DIR))
        weather = stage(clean_weather(weather_readings(spark, SF_DIR)))
        return prepare(load, weather).agg(
            F.count(F.lit(1)), F.round(F.sum("temp_2m_lag15"), 4), F.round(F.sum("lag_24h"), 4),
            F.sum(F.hash("note").cast("long")),
        ).first()

    want = total()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert total() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_daily_sink_holds_every_block_once(spark, tmp_path):
    path = str(tmp_path / "forecasts")

    def block(series_id, day, value, steps=3):
        return [(series_id, f"2024-01-{day:02d} 23:00:00", h, float(value + h)) for h in range(steps)]

    def run(*blocks):
        rows = [row for b in blocks for row in b]
        df = spark.createDataFrame(rows, "series_id string, origin string, h int, yhat double")
        writers.store_forecasts(df.withColumn("origin", F.to_timestamp("origin")), path, parts=2)

    def stored():
        rows = writers.read_forecasts(spark, path).collect()
        return sorted((r.series_id, r.origin_day, r.h, r.yhat) for r in rows)

    names = "abcdefgh"
    run(*[block(k, 1, 0) for k in names])
    run(*[block(k, 2, 10) for k in names])
    once = stored()
    assert len(once) == 48 and {r[1] for r in once} == {"2024-01-02", "2024-01-03"}
    run(*[block(k, 2, 10) for k in names])
    assert stored() == once
    # A run for one series replaces its block, a shorter one too, and leaves the others.
    run(block("c", 2, 50, steps=2))
    assert stored() == sorted([r for r in once if r[:2] != ("c", "2024-01-03")] + [("c", "2024-01-03", h, 50.0 + h) for h in (0, 1)])
    before = stored()
    run()
    assert stored() == before
