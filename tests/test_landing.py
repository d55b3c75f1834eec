"""Text source shapes: written as tiny fixture files, landed as bronze."""
import json

from pyspark.sql import functions as F

from aurum.plans import dims, feeds
from aurum.session import scratch_path
from aurum.sources import landing as L

COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]
REGIONS = ["AMERICA", "ASIA", "EUROPE"]


def _line(*cells: str) -> str:
    return ",".join(cells)


def messy_nations() -> dict[str, str]:
    """One line per defect class of a nation list kept in a spreadsheet."""
    return {
        "clean": _line("24", "AMERICA", "UNITED STATES", "1"),
        "blank line": "",
        "sentinel in the last cell": _line("12", "ASIA", "JAPAN", "NULL"),
        "sentinel region": _line("4", "N/A", "EGYPT", "4"),
        "region out of the domain": _line("20", "ANTARCTICA", "ROSS ISLAND", "9"),
        "id turned into a date": _line("2024-02-01", "EUROPE", "FRANCE", "3"),
        "separator splits the id": _line("2", "500", "ASIA", "CHINA", "2"),
        "cell missing": _line("7", "EUROPE", "GERMANY"),
        "quoted comma": _line("3", "AMERICA", '"CANADA, DOMINION OF"', "1"),
        "quoted line feed": _line("21", "ASIA", '"VIET\nNAM"', "2"),
        "typographic quote": _line("6", "EUROPE", "L\u2019HEXAGONE", "3"),
    }


def test_csv_landing_all_strings_and_messy_rows(spark, tmp_path):
    p = tmp_path / "nations.csv"
    p.write_bytes("\n".join([_line(*COLUMNS), *messy_nations().values()]).encode("cp1252"))
    raw = L.read_csv_strings(spark, str(p), COLUMNS, multiline=True, encoding="ISO-8859-1")
    assert all(t == "string" for _, t in raw.dtypes)
    by_id = {r.LocationID: r for r in raw.collect()}
    assert by_id["21"].Zone == "VIET\nNAM" and by_id["3"].Zone == "CANADA, DOMINION OF"
    assert by_id["7"].service_zone is None                       # padded
    assert by_id["2"]._corrupt_record == "2,500,ASIA,CHINA,2"    # the landed line is kept
    silver = {r.location_id: r for r in dims.zone_silver(raw, REGIONS, repair_quote=True).collect()}
    assert sorted(silver) == [3, 6, 7, 12, 21, 24]
    assert silver[6].zone == "L'HEXAGONE" and silver[12].service_zone is None
    why = {r.LocationID: r._reject_reason for r in dims.zone_quarantine(raw, REGIONS).collect()}
    assert why == {"2024-02-01": dims.R_LOCATION, "20": dims.R_BOROUGH, "2": dims.R_BOROUGH, "4": dims.R_BOROUGH_NULL}
    assert len(silver) + len(why) == raw.count()                 # nothing vanishes


def test_headerless_csv_with_declared_schema(spark, tmp_path):
    p = tmp_path / "station.csv"
    rows = [("HUB", "19970615", "HIGH", "231", "", "", "n", "0600"), ("HUB", "19970615", "RAIN", "47", "", "", "n", "0600"),
            ("HUB", "19970615", "HIGH", "5000", "", "X", "n", "0600"), ("HUB", "19960615", "SNOW", "3", "", "", "n", "")]
    p.write_text("\n".join(_line(*r) for r in rows) + "\n")
    cols = ["station_id", "ymd", "element", "value", "m_flag", "q_flag", "s_flag", "obs_time"]
    raw = L.read_csv_strings(spark, str(p), cols, header=False)
    landed = L.year_filter(raw, "ymd", ["1997"])
    assert (raw.count(), landed.count()) == (4, 3)
    daily = dims.daily_wide(landed, {"tmax": "HIGH", "tmin": "LOW", "prcp": "RAIN", "snow": "SNOW", "awnd": "WIND"})
    r = daily.first()
    assert (r.tmax_c, r.precip_mm, r.snow_mm, r.is_wet_day, r.is_snow_day) == (23.1, 4.7, 0.0, 1, 0)
    assert dims.qc_quarantine(landed).first()._reject_reason == "failed source quality control (q_flag=X)"


def test_raw_lines_and_json_split(spark, tmp_path):
    event = lambda **k: json.dumps({"ts": "1998-03-01T10:20:30Z", "level": "view"} | k)
    lines = [event(user=81, ctx={"k": 9}), event(user="17", level="signup"),     # the type of user drifts
             event(user=5)[:-9],                                                  # cut while being written
             "Traceback of another process",
             event() + event(), "1, 2", '1],["2', "[1],[2]", ""]                   # not one value
    p = tmp_path / "app.jsonl"
    p.write_text("\n".join(lines))
    raw = L.read_lines(spark, str(p)).select(F.lit("app").alias("_file"),
                                             F.monotonically_increasing_id().alias("_line_no"), "_raw")
    ev = feeds.app_events(raw).orderBy("user_id").collect()
    assert [(e.level, e.user_id, e.ctx_k) for e in ev] == [("signup", 17, None), ("view", 81, 9)]
    assert str(ev[0].event_at) == "1998-03-01 10:20:30"
    assert feeds.app_log_quarantine(raw).count() == raw.count() - 2 == 6


def test_json_array_document(spark, tmp_path):
    recs = [{"doc": 31, "grade": None, "text": "two words"}, {"doc": 30, "grade": 1, "text": ""}]
    p = tmp_path / "documents.json"
    p.write_text(json.dumps(recs, indent=1))
    raw = L.read_json_array(spark, str(p))
    got = raw.select(F.get_json_object("_raw", "$.doc").cast("int").alias("id"),
                     F.get_json_object("_raw", "$.text").alias("text")).orderBy("id").collect()
    assert [(r.id, r.text) for r in got] == [(30, ""), (31, "two words")]


def test_provenance_and_union_by_name(spark, tmp_path):
    a = spark.createDataFrame([(1, 2.0)], "id int, fare double")
    b = spark.createDataFrame([(2, 3.0, 0.75)], "id bigint, fare double, fee double")
    a.write.parquet(str(tmp_path / "m1.parquet"))
    b.write.parquet(str(tmp_path / "m2.parquet"))
    u = L.read_parquet_files(spark, [str(tmp_path / "m1.parquet"), str(tmp_path / "m2.parquet")])
    assert dict(u.dtypes)["id"] == "bigint"
    assert sorted((r.id, r.fee) for r in u.collect()) == [(1, None), (2, 0.75)]
    p = L.with_provenance(spark.read.parquet(str(tmp_path / "m2.parquet")), "trips",
                          record_no=F.col("_metadata.row_index"))
    assert p.columns[:4] == L.PROVENANCE
    r = p.first()
    assert r._source == "trips" and r._source_file.endswith(".parquet") and r._record_no == 0


def test_landed_file_names_take_no_pattern(spark):
    paths = ["file:///a/b/c.parquet", "hdfs://h:9000/x y/part-0.parquet", "/t/one/two/three"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [tuple(r) for r in df.select(L.folder_and_file("p"), F.regexp_extract("p", r"[^/]+/[^/]+$", 0)).collect()]
    assert got == [("b/c.parquet",) * 2, ("x y/part-0.parquet",) * 2, ("two/three",) * 2]
    path = scratch_path(spark, "landing") + "/first.parquet"
    spark.range(3).write.parquet(path)
    landed = L.land_parquet_files(spark, [path], "ids")
    assert "regexp" not in landed._jdf.queryExecution().toString().lower()
    assert landed.filter(F.col("_source_file").startswith("first.parquet/part-")).count() == 3


def test_task_sizes_are_lowered_and_never_raised(spark):
    from aurum.session import TASK_BYTES, bound_tasks
    old = {k: spark.conf.get(k) for k in TASK_BYTES}
    try:
        for given, kept in (("128m", None), ("1g", None), ("134217728b", None), ("8m", "8m"), ("1024", "1024")):
            for k in TASK_BYTES:
                spark.conf.set(k, given)
            bound_tasks(spark)
            for k, most in TASK_BYTES.items():
                assert spark.conf.get(k).removesuffix("b") == (kept or str(most))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
