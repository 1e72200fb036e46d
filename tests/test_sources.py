import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.functions.payload import nan_to_null
from pitchvault.operators.quality import Contract
from pitchvault.operators.vault import load_hub
from pitchvault.sources import jdbc, snapshots, tables
from pitchvault.streaming.vault_stream import read_new_files, stream_load

ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.DoubleType())])


def put(root, text, **levels):
    folder = root
    for k, v in levels.items():
        folder = folder / f"{k}={v}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "items.json").write_text(text)


def test_snapshot_path():
    assert snapshots.snapshot_path("s", "e", "2024-01-02", "epl", 2024, "f.json") == (
        "source=s/endpoint=e/league_id=epl/season=2024/dt=2024-01-02/f.json")
    assert snapshots.snapshot_path("s", "e", date(2024, 1, 2)) == "source=s/endpoint=e/dt=2024-01-02"


def test_read_snapshot_picks_day_and_season(spark, rows, tmp_path):
    base = {"source": "s", "endpoint": "e"}
    put(tmp_path, '[{"id": "1", "x": NaN}, {"id": "2", "x": 2.5}]', **base, league_id="epl", season=2024, dt="2024-01-02")
    put(tmp_path, '[{"id": "3", "x": 1}]', **base, league_id="epl", season=2023, dt="2024-01-02")
    put(tmp_path, '[{"id": "4", "x": 1}]', **base, league_id="epl", season=2024, dt="2024-01-01")
    put(tmp_path, '[{"id": "5", "x": 1}]', **base, league_id="la_liga", season="current", dt="2024-01-02")
    put(tmp_path, '[{"id": "6", "x": 1}]', source="s", endpoint="other", dt="2024-01-02")
    day = snapshots.read_snapshot(spark, str(tmp_path), "s", "e", ITEM, date(2024, 1, 2))
    assert rows(day, "id", "league_id", "season") == [("1", "epl", 2024), ("2", "epl", 2024), ("3", "epl", 2023)]
    assert day.filter(F.col("source_file").contains("dt=2024-01-02")).count() == 3
    one = snapshots.read_snapshot(spark, str(tmp_path), "s", "e", ITEM, "2024-01-02", season=2024)
    assert rows(nan_to_null(one), "id", "x") == [("1", None), ("2", 2.5)]
    flat = snapshots.read_snapshot(spark, str(tmp_path), "s", "other", ITEM, "2024-01-02")
    assert rows(flat, "id", "league_id", "season", "dt") == [("6", None, None, date(2024, 1, 2))]


def test_season_filter_prunes_files(spark, tmp_path):
    for season in (2023, 2024):
        put(tmp_path, "[]", source="s", endpoint="e", league_id="epl", season=season, dt="2024-01-02")
    df = snapshots.read_snapshot(spark, str(tmp_path), "s", "e", ITEM, "2024-01-02", season=2024)
    assert [f for f in df.inputFiles() if "season=2024" not in f] == [] and len(df.inputFiles()) == 1


def test_missing_snapshot_gives_no_rows(spark, tmp_path):
    df = snapshots.read_snapshot(spark, str(tmp_path), "s", "none", ITEM, "2024-01-02")
    assert df.count() == 0 and df.columns == ["id", "x", "league_id", "season", "dt", "source_file", "item_no"]


def test_snapshot_rerun_replaces_its_partition(spark, frame, rows, tmp_path):
    root, keys = str(tmp_path / "lake"), ["source", "endpoint", "league_id", "season", "dt"]
    schema = "id string, x double, source string, endpoint string, league_id string, season int, dt string"
    where = ("s", "e", "epl", 2024)
    snapshots.write_snapshot(frame(schema, ("1", 1.0, *where, "2024-01-01"), ("2", 2.0, *where, "2024-01-02")), root, keys)
    snapshots.write_snapshot(frame(schema, ("9", None, *where, "2024-01-02")), root, keys)
    read = lambda dt: rows(snapshots.read_snapshot(spark, root, "s", "e", ITEM, dt), "id", "x")
    assert read("2024-01-01") == [("1", 1.0)] and read("2024-01-02") == [("9", None)]


def test_snapshot_layout_follows_the_file(spark, frame, rows, tmp_path):
    """What the writer wrote and files that hold one array, read with no options, in one folder."""
    root, keys = str(tmp_path / "lake"), ["source", "endpoint", "league_id", "season", "dt"]
    schema = "id string, x double, source string, endpoint string, league_id string, season int, dt string"
    written = [(str(i), float(i), "s", "e", "epl", 2024, "2024-01-01") for i in range(1000)]
    snapshots.write_snapshot(frame(schema, *written), root, keys)
    day = tmp_path / "lake/source=s/endpoint=e/league_id=epl/season=2024/dt=2024-01-01"
    for i, name in enumerate(("players.json", "p", "a.json", "party.json")):
        (day / name).write_text(f'[{{"id": "a{i}", "x": 1}}, {{"id": "b{i}", "x": 2}}]')
    df = snapshots.read_snapshot(spark, root, "s", "e", ITEM, "2024-01-01")
    assert len(rows(df, "id")) == 1008 and len(set(rows(df, "id"))) == 1008
    first = df.filter("source_file LIKE '%/a.json'").orderBy("item_no").select("id").collect()
    assert [r.id for r in first] == ["a2", "b2"]


def test_snapshot_lists_one_day(spark, frame, tmp_path):
    root, keys = str(tmp_path / "lake"), ["source", "endpoint", "league_id", "season", "dt"]
    schema = "id string, x double, source string, endpoint string, league_id string, season int, dt string"
    days = [("1", 1.0, "s", "e", "epl", 2024, f"2024-01-{d:02}") for d in range(1, 29)]
    snapshots.write_snapshot(frame(schema, *days), root, keys)
    df = snapshots.read_snapshot(spark, root, "s", "e", ITEM, "2024-01-03")
    assert df.count() == 1 and len(df.inputFiles()) == 1


def test_jdbc_options():
    o = jdbc.read_options("jdbc:x", " SELECT a FROM t WHERE b IS NOT NULL", {"user": "u"}, jdbc.Slices("a", 0, 100, 4))
    assert o == {
        "url": "jdbc:x", "dbtable": "(SELECT a FROM t WHERE b IS NOT NULL) src", "user": "u",
        "partitionColumn": "a", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    assert jdbc.read_options("jdbc:x", "s.t")["dbtable"] == "s.t"
    w = jdbc.write_options("jdbc:x", "s.t", {"a": "VARCHAR(5)", "b": "VARCHAR(9)"}, connections=8)
    assert w["createTableColumnTypes"] == "a VARCHAR(5), b VARCHAR(9)" and w["numPartitions"] == "8"


def test_export_and_publish(spark, frame, tmp_path):
    good = frame("a int, b string", (2, "x"), (1, None))
    total = tables.export_marts({"m": good, "n": good.limit(1)}, str(tmp_path))
    assert total == 3
    contract = Contract({"a": "UInt8", "b": "String?"}, ["a"])
    serving = str(tmp_path / "serving")
    assert tables.publish_mart(spark, str(tmp_path / "m"), serving, contract) == 2
    with pytest.raises(FileNotFoundError):
        tables.publish_mart(spark, str(tmp_path / "nothing"), serving, contract)
    tables.export_mart(frame("a int, b string", (300, "x")), str(tmp_path / "m"))
    with pytest.raises(ValueError):
        tables.publish_mart(spark, str(tmp_path / "m"), serving, contract)
    tables.export_mart(frame("b string, a int", ("x", 3)), str(tmp_path / "m"))
    with pytest.raises(ValueError):
        tables.publish_mart(spark, str(tmp_path / "m"), serving, contract)
    assert spark.read.parquet(serving).count() == 2


def test_replace_partitions_while_reading_them(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame("k int, v int, p string", (1, 1, "a"), (2, 1, "b")), path, ["p"])
    changed = spark.read.parquet(path).filter("p = 'a'").withColumn("v", F.col("v") + 1)
    assert tables.replace_partitions(changed, path, ["p"]) == 1
    assert rows(spark.read.parquet(path), "k", "v", "p") == [(1, 2, "a"), (2, 1, "b")]
    assert tables.read_table(spark, str(tmp_path / "none")) is None


def test_stream_load_adds_new_keys_once(spark, frame, tmp_path):
    schema = T.StructType([
        T.StructField("hk", T.StringType()), T.StructField("bk", T.StringType()),
        T.StructField("ldts", T.TimestampNTZType()), T.StructField("rsrc", T.StringType())])
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    t = datetime(2024, 1, 1)

    def arrive(*keys):
        tables.append_table(spark.createDataFrame([(k, k, t, "s") for k in keys], schema), src)
        load = lambda batch, existing: load_hub([batch], "hk", ["bk"], existing)
        query = stream_load(read_new_files(spark, src, schema), load, out, ck)
        assert query.awaitTermination(120)
        return sorted(r.hk for r in spark.read.parquet(out).collect())

    assert arrive("a", "b", "a") == ["a", "b"]
    assert arrive("b", "c") == ["a", "b", "c"]


def rows_read(df):
    """The rows of the answer, and those that the scan took out of the files."""
    answer = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return answer, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_laid_out_marts_skip_row_groups(spark, tmp_path):
    n, path = 200_000, str(tmp_path / "laid")
    df = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("l"), F.col("id") % 10).alias("league_id"), (F.col("id") % 7).alias("season_year"),
        F.sha2(F.pmod(F.xxhash64("id"), F.lit(n // 4)).cast("string"), 256).alias("player_bk"), F.col("id").alias("v"),
    )
    # A third of all rows is of one league.
    df = df.withColumn("league_id", F.when(F.col("v") % 3 == 0, "l0").otherwise(F.col("league_id")))
    spark.conf.set("parquet.block.size", str(256 << 10))
    try:
        assert tables.export_laid_out(df, path, ["league_id", "season_year", "v"], ["player_bk", "no such column"]) == n
    finally:
        spark.conf.unset("parquet.block.size")
    written = spark.read.parquet(path)
    assert sorted(written.columns) == sorted(df.columns) and written.count() == n
    of_league = written.filter("league_id = 'l4' AND season_year = 3").select("v")
    answer, read = rows_read(of_league)
    assert sorted(r["v"] for r in answer) == sorted(r["v"] for r in df.filter("league_id = 'l4' AND season_year = 3").collect())
    assert read < n / 10
    someone = df.filter("v = 4321").first()["player_bk"]
    answer, read = rows_read(written.filter(F.col("player_bk") == someone).select("v"))
    assert 4321 in {r["v"] for r in answer}
    assert sorted(r["v"] for r in answer) == sorted(r["v"] for r in df.filter(F.col("player_bk") == someone).collect())
    assert read < n / 3
    answer, read = rows_read(written.filter("player_bk = 'nobody'"))
    assert answer == [] and read < n / 10


def test_laid_out_nulls_and_empty_tables(spark, frame, tmp_path):
    odd = frame("a int, b string", (None, "x"), (1, None), (None, None), (1, None))
    assert tables.export_laid_out(odd, str(tmp_path / "odd"), ["a", "b"], ["b"]) == 4
    back = spark.read.parquet(str(tmp_path / "odd"))
    assert sorted(map(str, back.collect())) == sorted(map(str, odd.collect()))
    assert back.filter("b = 'x'").count() == 1
    assert tables.export_laid_out(odd.limit(0), str(tmp_path / "none"), ["a"], ["b"]) == 0
    assert spark.read.parquet(str(tmp_path / "none")).columns == ["a", "b"]
