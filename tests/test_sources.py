import datetime
import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import scalars
from millrace.operators import stats, tables
from millrace.operators.smoothing import with_changes
from millrace.sources import files, generated

# A ragged quoted CSV file and its three rows.
RAGGED = """year,make,model,comment,blank
"2012","Tesla","S","No comment",

1997,Ford,E350,"Go get one now they are going fast",
2015,Chevy,Volt
"""
RAGGED_ROWS = [
    (1997, "Ford", "E350", "Go get one now they are going fast", None),
    (2012, "Tesla", "S", "No comment", None),
    (2015, "Chevy", "Volt", None, None),
]


@pytest.fixture
def ragged(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text(RAGGED)
    return files.read_csv(spark, str(path), "year int, make string, model string, comment string, blank string")


def test_ragged_csv(ragged):
    assert sorted(tuple(r) for r in ragged.collect()) == RAGGED_ROWS


def test_every_part_has_a_header(spark, ragged, tmp_path):
    out = files.write_csv(ragged.repartition(2), str(tmp_path / "out"), ["year", "model"])
    parts = [p.read_text().splitlines() for p in Path(out).glob("part-*")]
    assert len(parts) == 2 and all(lines[0] == "year,model" for lines in parts)
    back = files.read_csv(spark, out, "year int, model string")
    assert sorted(tuple(r) for r in back.collect()) == [(1997, "E350"), (2012, "S"), (2015, "Volt")]


def test_house_sales_schema(spark, tmp_path):
    values = ["7", "20141013T000000", "221900", "3", "1", "1180", "5650", "1", "0", "0", "3", "7", "1180", "0", "1955", "0", "98178", "47.5112", "-122.257", "1340", "5650"]
    path = tmp_path / "house.csv"
    probe = files.read_house_sales(spark, str(tmp_path))
    path.write_text(",".join(probe.columns) + "\n" + ",".join(values) + "\n")
    row = files.read_house_sales(spark, str(path)).first()
    assert len(row) == 21 and row.id == "7" and row.price == 221900.0 and row.sqft_lot == 5650 and row.long == -122.257
    built = tables.with_house_features(files.read_house_sales(spark, str(path)), "bedrooms", "bathrooms", "sqft_living", "lat", "long")
    row = built.first()
    assert (row.rooms_squared, row.rooms_by_baths) == (9.0, 3.0)
    assert row.log_area == pytest.approx(7.07326971745971) and row.lat_plus_long == pytest.approx(47.5112 - 122.257)


def test_first_ticks(spark, tmp_path):
    path = tmp_path / "ticks.csv"
    path.write_text("30,2.5,x\n10,1.5,y\n20,3.5,z\n")
    rows = files.read_ticks(spark, str(path), first=2).orderBy("ts").collect()
    assert [(r.ts, r.price) for r in rows] == [
        (datetime.datetime(1970, 1, 1, 0, 0, 10), 1.5),
        (datetime.datetime(1970, 1, 1, 0, 0, 20), 3.5),
    ]


def test_tokens(spark, tmp_path):
    path = tmp_path / "items.txt"
    path.write_text(" 3 2\n3 2 \n")
    assert [r["items"] for r in files.read_tokens(spark, str(path)).collect()] == [["3", "2"], ["3", "2"]]


def test_libsvm_with_missing_slots(spark, tmp_path):
    path = tmp_path / "points.txt"
    path.write_text("1 1:-0.5 3:0.25 4:0.5\n0 2:1\n")
    rows = {r.label: r.features.toArray().tolist() for r in files.read_libsvm(spark, str(path), 4).collect()}
    assert rows == {1.0: [-0.5, 0.0, 0.25, 0.5], 0.0: [0.0, 1.0, 0.0, 0.0]}
    out = files.write_libsvm(files.read_libsvm(spark, str(path), 4), str(tmp_path / "out"), "label", "features")
    assert {r.label: r.features.toArray().tolist() for r in files.read_libsvm(spark, out, 4).collect()} == rows


def test_literal_rows(spark):
    df = generated.literal_rows(spark, [(1, "a"), (2, "b")], "n int, s string")
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (2, "b")]


def test_day_ticks(spark):
    rows = [("20151201 000000100", 1.0), ("20151201 000159099", 2.0), ("20151201 000200100", 3.0), ("20151202 120000000", 4.0)]
    df = spark.createDataFrame(rows, "date string, label double")
    out = stats.minutes_since_open(df, "date", "yyyyMMdd HHmmssSSS").orderBy("date")
    assert [r.minutes for r in out.collect()] == [0, 1, 2, 0]
    assert df.where(scalars.starts_with_day("date", "20151202")).count() == 1


def test_text_times(spark):
    df = spark.createDataFrame([("2016-08-04 10:00:01",), ("no time",)], "t string")
    assert [r[0] for r in df.select(scalars.parse_millis("t")).collect()] == [1470304801000, None]


def test_span(spark):
    df = spark.range(0, 60 * 24 * 2 + 30).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    assert tuple(stats.span_in_days(df.union(df), "ts").first()) == (2910, 2)


def test_rises_without_falls_are_null(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 2.0), (1, 4.0)], "h int, change double")
    row = stats.rises_and_falls(df, F.col("h"), "change").first()
    assert (row.mean_rise, row.mean_fall) == (3.0, None)


def test_exact_decimals(spark):
    df = spark.createDataFrame([(0.1, 0.2)], "a double, b double")
    assert str(df.select(scalars.exact_weighted_sum({"a": "3", "b": "0.5"})).first()[0]) == "0.4000000000"


def test_powers(spark):
    out = tables.with_powers(spark.createDataFrame([(2.0,)], "x double"), "x", 3)
    assert out.columns == ["x", "power_0", "power_1", "power_2", "power_3"] and tuple(out.first()) == (2, 1, 2, 4, 8)


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = session.shared_dir(spark)
    assert folder == session.shared_dir(spark) and spark.sparkContext.getCheckpointDir() == folder
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
    staged = session.stage(spark.range(5))
    assert staged.count() == 5


def test_scratch_tables_go_with_their_scope(spark):
    from millrace.session import kept, scratch_scope, stage_table

    with scratch_scope(spark):
        staged = stage_table(spark.range(5))
        (path,) = {f.rsplit("/", 1)[0] for f in staged.inputFiles()}
        with kept(staged) as held:
            assert held.count() == 5 and held.is_cached
        assert not staged.storageLevel.useMemory
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_separators_are_literal(spark):
    from millrace.functions.scalars import tokens

    frame = spark.createDataFrame([("\t 1|2.5|3 \t",), ("a",), (None,)], "v string")
    assert [r[0] for r in frame.select(tokens("v", "|")).collect()] == [["1", "2.5", "3"], ["a"], None]
    assert [r[0] for r in frame.select(tokens("v", ".")).collect()] == [["1|2", "5|3"], ["a"], None]


def test_texts_that_are_no_times_keep_their_rows(spark):
    from millrace.operators.stats import minutes_since_open

    frame = spark.createDataFrame([("20240102 000300000",), (None,), ("20240102 000000000",), ("junk",)], "t string")
    got = minutes_since_open(frame, "t", "yyyyMMdd HHmmssSSS").collect()
    assert sorted((str(r.t), r.minutes) for r in got) == [("20240102 000000000", 0), ("20240102 000300000", 3), ("None", None), ("junk", None)]


def test_few_days_are_broadcast_and_many_are_not(spark, monkeypatch):
    from millrace.operators import series, stats

    frame = spark.range(1000).select(F.concat(F.lit("202401"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(" 000000000")).alias("t"))
    plan = lambda: stats.minutes_since_open(frame, "t", "yyyyMMdd HHmmssSSS")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(series, "BROADCAST_ROWS", 3)
    assert "broadcast" not in plan()


@pytest.fixture
def splits(spark):
    """Set the size of splits; the setting is taken back afterwards."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


@pytest.mark.parametrize("size", ["64", "1k", "128m"])
def test_lines_are_numbered_as_they_stand_however_files_are_cut(spark, tmp_path, splits, size):
    rng = random.Random(6)
    texts = {"b.csv": 700, "a.csv": 1, "c.csv": 333, "d.csv": 0}
    lines = {f: [f"{rng.randrange(10**6)},{k}.5" for k in range(n)] for f, n in texts.items()}
    for f, rows in lines.items():
        (tmp_path / f).write_text("".join(r + "\n" for r in rows))
    splits(size)
    want = [tuple(r.split(",")) for f in sorted(lines) for r in lines[f]]
    read = files.read_csv(spark, str(tmp_path), files.TICKS, header=False)
    got = sorted((r.line, str(r.epoch_seconds), str(r.price)) for r in files.with_line_numbers(read).collect())
    assert got == [(n, *w) for n, w in enumerate(want)]
    first = sorted((r.line, str(r.epoch_seconds), str(r.price)) for r in files.with_line_numbers(read, first=500).collect())
    assert first == got[:500]


def test_first_lines_are_not_the_earliest(spark, tmp_path):
    (tmp_path / "t.csv").write_text("30,1.0\n10,2.0\n20,3.0\n")
    got = [r.price for r in files.read_tick_lines(spark, str(tmp_path / "t.csv"), first=2).orderBy("line").collect()]
    assert got == [1.0, 2.0]
    assert [r.price for r in files.read_ticks(spark, str(tmp_path / "t.csv"), first=2).collect()] == [2.0, 3.0]


def test_numbered_lines_are_a_series(spark, tmp_path):
    (tmp_path / "t.csv").write_text("30,1.0\n10,2.0\n20,4.0\n")
    lines = files.read_tick_lines(spark, str(tmp_path / "t.csv"))
    assert [r.change for r in with_changes(lines, "price", idx="line").orderBy("line").collect()] == [0.0, 1.0, 2.0]
    (tmp_path / "none.csv").write_text("")
    assert files.read_tick_lines(spark, str(tmp_path / "none.csv")).count() == 0


def test_rejected_records_have_reasons(spark, tmp_path):
    lines = ["1,a,2.5", "2,b", "x,c,1.0", "4,d,q", "5,e,1.0,more,and", '6,"f,1.0', '7,"g, h",3.0', "", "8,,", '"9,i,2.0', "z,j,q"]
    (tmp_path / "r.csv").write_text("".join(x + "\n" for x in lines))
    got = [tuple(r) for r in files.read_csv_rejects(spark, str(tmp_path / "r.csv"), "key int, name string, price double").collect()]
    assert got == [
        (1, "a", 2.5, None, None, 0),
        (2, "b", None, "2,b", "short", 1),
        (None, "c", 1.0, "x,c,1.0", "type", 1),
        (4, "d", None, "4,d,q", "type", 1),
        (5, "e", 1.0, "5,e,1.0,more,and", "long", 2),
        (6, None, None, '6,"f,1.0', "quotes", 2),
        (7, "g, h", 3.0, None, None, 0),
        (8, None, None, None, None, 0),
        (None, None, None, '"9,i,2.0', "quotes", 3),
        (None, "j", None, "z,j,q", "type", 2),
    ]


def test_noise_does_not_depend_on_the_plan(spark):
    columns = generated.polynomial_columns("id", noise=0.1, seed=3)
    rows = spark.range(1, 400)
    one = sorted(tuple(r) for r in rows.select(*columns).collect())
    assert one == sorted(tuple(r) for r in rows.repartition(13).orderBy(F.desc("id")).select(*columns).collect())
    assert one != sorted(tuple(r) for r in rows.select(*generated.polynomial_columns("id", noise=0.1, seed=4)).collect())
    plain = sorted(tuple(r) for r in rows.select(*generated.polynomial_columns("id")).collect())
    shares = [(a[-1] - generated.EXAMPLE_LEVEL) / (b[-1] - generated.EXAMPLE_LEVEL) - 1 for a, b in zip(one, plain)]
    assert 0 <= min(shares) < 0.01 and 0.09 < max(shares) < 0.1


def test_random_numbers_have_their_distributions(spark):
    rows = spark.range(20_000).select(generated.uniform("id", 1).alias("u"), generated.uniform("id", 1, 7).alias("v"), generated.normal("id", 1).alias("z"), generated.whole_noise("id", -50, 100).alias("w"))
    got = rows.selectExpr("avg(u)", "var_pop(u)", "corr(u, v)", "avg(z)", "var_pop(z)", "skewness(z)", "kurtosis(z)", "min(w)", "max(w)", "count(distinct w)").first()
    assert [round(x, 1) for x in got[:7]] == [0.5, 0.1, 0.0, 0.0, 1.0, 0.0, 0.0] and tuple(got[7:]) == (-50, 49, 100)


def test_sine_series(spark):
    rows = generated.sine_series(spark, 10, 300, seed=2).collect()
    rest = [r.y - math.sin(r.x) - r.x**2 / 100 for r in rows]
    assert len(rows) == 291 and all(abs(x - round(x)) < 1e-6 and -50 <= round(x) < 50 for x in rest) and len({round(x) for x in rest}) > 80
