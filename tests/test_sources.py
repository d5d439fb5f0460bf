"""Readers on hand-written files."""

import io
import re
import zipfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from heliogrid.columns import RAW_SCHEMA
from heliogrid.functions import text
from heliogrid.operators import quality
from heliogrid.queries import files
from heliogrid.sinks import tables as sink
from heliogrid.sources import catalog, registry, station, tables
from heliogrid.streaming import exactly_once, incremental

HEADERS = RAW_SCHEMA.names
RADIATION = HEADERS[6]


def preamble(name, lat="-16,64", lon="-49,22"):
    return ["REGIAO:;CO", f"ESTACAO:;{name}", "UF:;GO", "CODIGO:;A002", f"LATITUDE:;{lat}", f"LONGITUDE:;{lon}", "ALTITUDE:;770", "FUNDACAO:;2001/05/29"]


def reading(day, hour, rain, radiation, wind="90"):
    cells = [day, hour, rain, "", "", "", radiation] + [""] * 9 + [wind, "", ""]
    return ";".join(cells) + ";"


@pytest.fixture
def folder(tmp_path):
    """Two years; one file with CRLF ends and dashed dates, one that is not a station file."""
    (tmp_path / "2021").mkdir()
    (tmp_path / "2022").mkdir()
    a = preamble("GOIÂNIA") + [";".join(HEADERS) + ";", reading("2021/01/01", "0000 UTC", ",4", "12,7"), reading("2021/01/02", "1300 UTC", "", "NaN")]
    (tmp_path / "2021" / "a.CSV").write_bytes("\n".join(a).encode("latin-1"))
    b = preamble("ANÁPOLIS", "-16,3") + [";".join(HEADERS) + ";", reading("2022-02-01", "01:00", "1", "100", "x")]
    (tmp_path / "2022" / "b.CSV").write_bytes("\r\n".join(b).encode("latin-1"))
    return tmp_path


def test_raw_and_typed(spark, folder):
    raw = station.scan_raw(spark, station.year_paths(str(folder) + "/{year}", [2021, 2022]), with_file=True)
    assert raw.columns == [*HEADERS, "file"] and raw.count() == 3
    rows = station.typed(raw, "double").orderBy("data").collect()
    assert [(r.data, r.precipitacao_mm, r.radiacao_global_kj_m2, r.vento_direcao_gr) for r in rows] == [
        ("2021/01/01", 0.4, 12.7, 90), ("2021/01/02", None, None, 90), ("2022-02-01", 1.0, 100.0, None),
    ]
    staged = station.staging(raw).orderBy("DATA_OBSERVACAO").collect()
    assert [str(r.DATA_OBSERVACAO) for r in staged] == ["2021-01-01", "2021-01-02", "2022-02-01"]
    assert [r.HORA_OBSERVACAO for r in staged] == ["00:00:00", "13:00:00", "01:00:00"]
    assert str(staged[0].RADIACAO_GLOBAL_KJ_M2) == "12.700"
    whole = station.staging(raw, "decimal(38,0)").orderBy("DATA_OBSERVACAO").first()
    assert int(whole.RADIACAO_GLOBAL_KJ_M2) == 13 and int(whole.PRECIPITACAO_MM) == 0


def test_abort_on_bad_text(spark, folder):
    good = station.typed(station.scan_raw(spark, str(folder / "2021")), on_error="abort")
    assert [r.radiacao_global_kj_m2 for r in good.orderBy("data").collect()] == [pytest.approx(12.7), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        station.typed(station.scan_raw(spark, str(folder / "2022")), on_error="abort").collect()


def test_header_order_and_spelling(spark, folder, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    names = ["hora_utc", "DATA", "Radiacao Global (Kj/m²)"]
    (other / "c.CSV").write_bytes("\n".join(preamble("X") + [";".join(names), "x"] ).encode("latin-1"))
    names = ["Data", "radiacao_global_kj_m2", "unknown", "hora_utc"]
    (other / "d.CSV").write_bytes("\n".join(preamble("X") + [";".join(names), "2021/01/01;5,5;?;0100 UTC"]).encode("latin-1"))
    rows = station.scan_by_header(spark, [str(folder / "2021"), str(other)]).orderBy("data", "hora_utc").collect()
    assert [(r.data, r.hora_utc, r.radiacao_global_kj_m2) for r in rows] == [
        ("2021/01/01", "0000 UTC", "12,7"), ("2021/01/01", "0100 UTC", "5,5"), ("2021/01/02", "1300 UTC", "NaN"),
    ]


def test_preamble(spark, folder):
    want = [("ANÁPOLIS", "-16.3", "-49.22"), ("GOIÂNIA", "-16.64", "-49.22")]
    by_line = station.preamble_by_position(spark, str(folder)).orderBy("nome")
    assert [(r.nome, r.latitude, r.longitude) for r in by_line.collect()] == want
    labels = {"nome": "ESTACAO", "latitude": "LATITUDE", "longitude": "LONGITUDE"}
    by_label = station.preamble_by_label(spark, str(folder), labels).orderBy("nome")
    assert [(r.nome, r.latitude, r.longitude) for r in by_label.collect()] == want
    rows = station.typed(station.scan_raw(spark, str(folder), with_file=True))
    tagged = station.tag_station(rows, by_line)
    assert {(r.estacao, r.n) for r in tagged.groupBy("estacao").agg(F.count("*").alias("n")).collect()} == {("GOIÂNIA", 2), ("ANÁPOLIS", 1)}


def test_single_pass_equals_two_scans(spark, folder):
    plain = station.scan_raw(spark, str(folder), with_file=True)
    single = station.scan_with_station(spark, str(folder))
    assert {(r.estacao, r.longitude) for r in single.collect()} == {("GOIÂNIA", "-49.22"), ("ANÁPOLIS", "-49.22")}
    assert sorted(map(str, single.select(*[f"`{h}`" for h in HEADERS]).collect())) == sorted(map(str, plain.select(*[f"`{h}`" for h in HEADERS]).collect()))


def test_no_row_holds_its_file(spark, tmp_path):
    """A file of 100 000 lines: the generator hands on no array of lines, and every line finds its station."""
    head = ["REGIAO:;CO", "ESTACAO:;LONGA", "UF:;GO", "CODIGO:;A001", "LATITUDE:;-16,5", "LONGITUDE:;-49,25", "ALTITUDE:;1", "DATA DE FUNDACAO:;2001/05/29"]
    (tmp_path / "long.csv").write_text("\n".join([*head, "Data;Hora UTC;x", *(f"2024/01/01;{i};,5" for i in range(100_000)), ";;", ""]), encoding="latin-1")
    rows = station.scan_with_station(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # Generate needs no other output of its child, and the file is decoded once.
    generate = plan[plan.index("Generate inline(") :].split("\n")[0]
    assert re.search(r"\), (\[\], )?true, \[line#\d+, station#\d+\]$", generate), generate
    assert len(re.findall(r"\bdecode\(", plan)) == 1
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("`" + rows.columns[1] + "`").alias("hours"), F.min("estacao").alias("e"), F.max("latitude").alias("y")).first()
    assert tuple(got) == (100_000, 100_000, "LONGA", "-16.5")


def test_column_choices(spark):
    df = spark.createDataFrame([("x", None, "2021/01/01", "1"), ("y", None, None, "2")], "a string, `Unnamed: 9` string, c string, `RADIACAO Z` string")
    assert station.detect_date_column(df) == "c"
    assert station.detect_date_column(df.drop("c")) == "a"
    assert station.detect_date_column(df.drop("c").withColumnRenamed("RADIACAO Z", "DATA (YYYY-MM-DD)")) == "DATA (YYYY-MM-DD)"
    assert station.drop_empty_columns(df).columns == ["a", "c", "RADIACAO Z"]
    assert station.drop_prefixed(df).columns == ["a", "c", "RADIACAO Z"]
    assert [r[0] for r in df.select(station.pick_column(df, "radiacao")).collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        station.pick_column(df, "none")


def test_plants(spark, tmp_path):
    head = "IdeNucleoCEG;SigUFPrincipal;DscFaseUsina;SigTipoGeracao;NumCoordNEmpreendimento;NumCoordEEmpreendimento;MdaPotenciaFiscalizadaKw"
    lines = [head, "1;GO;Operação;UFV;-16,5;-49,1;1000", "2;GO;Operação;EOL;-16,5;-49,1;250,5", "3;MT;Operação;UFV;-16,5;-49,1;1", "4;GO;Construção;UFV;-16,5;-49,1;1", "5;GO;Operação;PCH;;-49,1;1"]
    (tmp_path / "p.csv").write_bytes("\n".join(lines).encode("latin-1"))
    df = registry.scan_plants(spark, str(tmp_path))
    assert [(r.IdeNucleoCEG, r.potencia_kw) for r in registry.operating_plants(df).orderBy("IdeNucleoCEG").collect()] == [("1", 1000.0), ("2", 250.5)]
    assert registry.operating_plants(df, power_decimal=".").count() == 1


def test_listing(spark):
    files = spark.createDataFrame([("a/x.csv",), ("b/x.csv",), ("b/y.csv",)], "path string")
    listing = spark.createDataFrame([("x.csv",), ("z.csv",)], "name string")
    got = catalog.match_listing(listing, files).orderBy("path").collect()
    assert [(r.name, r.n_matches, r.path) for r in got] == [("x.csv", 2, "a/x.csv"), ("x.csv", 2, "b/x.csv")]
    assert [r.name for r in catalog.missing_from(listing, files).collect()] == ["z.csv"]


def test_catalog_and_metrics(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n3")
    (tmp_path / "b.TXT").write_text("1\r\n2\r\n")
    df = catalog.file_catalog(spark, str(tmp_path))
    assert catalog.catalog_totals(df).first().asDict() == {"objects": 2, "bytes": 11}
    assert catalog.filter_files(df, suffix=".txt").count() == 2
    assert catalog.filter_files(df, suffix=".txt", ignore_case=False).count() == 1
    got = {r.path.rsplit("/", 1)[1]: (r.size_bytes, r.n_lines) for r in catalog.file_metrics(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": (5, 3), "b.TXT": (6, 2)}


def test_key_collisions(spark):
    files = spark.createDataFrame([("d/a b.csv",), ("d/a_b.csv",), ("d/c (1).csv",), ("d/plain",)], "path string")
    got = {r.path: (r.new_key, r.status) for r in catalog.key_changes(files).collect()}
    assert got == {
        "d/a b.csv": ("d/a_b.csv", "collision"), "d/a_b.csv": ("d/a_b.csv", "skipped"),
        "d/c (1).csv": ("d/c_1.csv", "renamed"), "d/plain": ("d/plain", "skipped"),
    }


def test_zip(spark):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("2021/", "")
        z.writestr("2021/A.CSV", "é".encode("latin-1"))
        z.writestr("2021/readme.txt", "hello")
    df = spark.createDataFrame([(1, blob.getvalue())], "id int, content binary")
    assert {(r.id, r.entry, r.size) for r in catalog.zip_entries(df).collect()} == {(1, "2021/A.CSV", 1), (1, "2021/readme.txt", 5)}
    only = catalog.zip_entries(df, suffix=".csv").select("entry", text.latin1(F.col("body"))).collect()
    assert [tuple(r) for r in only] == [("2021/A.CSV", "é")]


def test_models_and_tests(spark):
    models = tables.Models(spark)
    models.source("raw", spark.sql("SELECT 1 AS id UNION ALL SELECT NULL"))

    @models.model("child")
    def child(m):
        return m.ref("raw").filter("id = 1")

    assert models.ref("child").count() == 1
    report = {(r.test): (r.failures, r.passed) for r in quality.test_report(models.ref("raw"), {"id": ["unique", "not_null"]}).collect()}
    assert report == {"unique": (0, True), "not_null": (1, False)}
    doubled = models.ref("raw").unionAll(models.ref("raw"))
    assert [tuple(r) for r in quality.not_unique(doubled, "id").collect()] == [(1, 2)]


def test_incremental_load_takes_each_file_once(spark, folder, tmp_path):
    target, ledger = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = incremental.clean_readings(incremental.station_stream(spark, str(folder / "20*")))
        incremental.run_once(stream.select("file", "observed_at", "radiacao_global_kj_m2", "year"), target, ledger, ["year"])
        return spark.read.parquet(target).count()

    assert run() == 3 and run() == 3
    extra = preamble("NOVA") + [";".join(HEADERS), reading("2022/03/01", "0100 UTC", "1", "5")]
    (folder / "2022" / "c.CSV").write_bytes("\n".join(extra).encode("latin-1"))
    assert run() == 4


def test_a_batch_that_fails_half_way_adds_nothing(spark, folder, tmp_path):
    """Fails once before a batch is written and once before it is published; then a file comes and a run has no news."""
    target, ledger, checkpoint = (str(tmp_path / n) for n in ("out", "ledger", "ck"))
    tries = []

    def fail(batch):
        tries.append(batch)
        if len(tries) == 2:
            raise RuntimeError("stopped")

    def run(**more):
        stream = incremental.station_stream(spark, str(folder / "20*"), files_per_batch=1).withColumn("bytes", F.col("_metadata.file_size"))
        exactly_once.load_exactly_once(incremental.clean_readings(stream).select("file", "bytes", "observed_at"), target, ledger, checkpoint, size="bytes", **more)

    rows = lambda: exactly_once.published(spark, target, ledger, "file string, bytes long, observed_at timestamp")
    with pytest.raises(StreamingQueryException):
        run(before_publish=fail)
    once = rows().count()
    assert 0 < once < 3 and spark.read.parquet(target).count() == 3
    run(before_publish=fail)
    assert tries == [0, 1, 1] and rows().count() == 3
    run()
    extra = preamble("NOVA") + [";".join(HEADERS), reading("2022/03/01", "0100 UTC", "1", "5")]
    (folder / "2022" / "c.CSV").write_bytes("\n".join(extra).encode("latin-1"))
    run()
    assert rows().count() == 4
    report = exactly_once.load_report(spark, ledger, spark.createDataFrame([("x/2023/none.csv",)], "file string")).collect()
    assert sorted((r.file.split("/")[-1], r.n_rows, r.year, r.status) for r in report if r.status == "empty") == [("none.csv", 0, 2023, "empty")]
    done = [r for r in report if r.status == "success"]
    assert sum(r.n_rows for r in done) == 4 and len({r.file for r in done}) == len(done)
    assert all(r.seconds > 0 and r.bytes > 100 and r.loaded_at for r in done)


def test_many_files_with_differing_headers(spark, tmp_path):
    """The plan has one scan whatever the number of files, and grows with the different names only."""

    def put(n, names):
        for i in range(n):
            body = [";".join(names), ";".join(f"{names[0][:1]}{i}" if k == 0 else f"{name}-{i}" for k, name in enumerate(names))]
            (tmp_path / f"{names[-1]}-{i}.csv").write_text("\n".join(body) + "\n", encoding="latin-1")

    put(300, ["Data", "Hora UTC", "extra one"])
    put(200, ["DATA", "other", "Hora UTC"])
    put(100, ["Data", "RADIACAO GLOBAL (Kj/m²)", "file"])
    rows = station.scan_by_header(spark, str(tmp_path), others=True)
    assert rows.columns[-2:] == ["extra one", "other"]
    got = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in ("data", "hora_utc", "extra one", "other", "radiacao_global_kj_m2")]).first()
    assert tuple(got) == (600, 500, 300, 200, 100)
    assert rows.filter("other = 'other-7'").select("data", "hora_utc").first() == ("D7", "Hora UTC-7")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2


def test_one_metrics_object_for_each_file(spark, tmp_path):
    metrics = spark.createDataFrame([("in/a (1).csv", 3), ("in/b.csv", None), (None, 1)], "path string, size_bytes long")
    for _ in range(2):
        sink.write_metric_objects(metrics, str(tmp_path / "m"))
    found = spark.read.json(str(tmp_path / "m"))
    assert {(r.object, r.size_bytes) for r in found.collect()} == {("a_1", 3), ("b", None), (None, 1)}
    assert found.filter("uploaded_at IS NULL").count() == 0
    assert len(list((tmp_path / "m").glob("object=a_1/*.json"))) == 2
    sink.write_metric_objects(metrics.limit(0), str(tmp_path / "n"))


def test_many_metrics_objects_are_written_by_many_tasks(spark, tmp_path):
    metrics = spark.range(400).selectExpr("concat('in/', id, '.csv') AS path", "id AS size_bytes")
    sink.write_metric_objects(metrics, str(tmp_path / "m"))
    files = list((tmp_path / "m").glob("object=*/*.json"))
    assert len(files) == 400 and len({f.name.split("-")[1] for f in files}) > 2


def test_archives_are_packed_a_few_at_a_time(spark, tmp_path):
    """No Arrow batch of ten thousand texts in a Python worker."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, f"á{i}", "pt", "s", 2) for i in range(300)], schema).write.parquet(str(tmp_path / "documents.parquet"))
    rows = files.zip_entries_csv(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "InPandas" not in plan and "ArrowEvalPython" not in plan and "InArrow" not in plan
    assert {tuple(r) for r in rows.collect()} == {(i, f"2024/doc_{i}.CSV", f"n;{len(str(i)) + 1}") for i in range(300)}


def test_batch_ledger(spark):
    rows = spark.range(30_000).selectExpr("concat('file', id) AS file", "id")
    done = rows.filter("id = 7").select("file")
    assert incremental.load_new_files(rows, done).count() == 29_999
    assert incremental.load_new_files(rows, rows.select("file")).count() == 0


def test_odd_dates_stay_and_abort_raises(spark, tmp_path):
    days = ["2021/01/01", "31/01/2021", "", "2021/01/02"]
    lines = preamble("ODD") + [";".join(HEADERS)] + [reading(d, "0100 UTC", "1", "5") for d in days]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "odd.CSV").write_bytes("\n".join(lines).encode("latin-1"))
    path = str(tmp_path / "in")
    raw = station.scan_raw(spark, path)
    assert raw.count() == station.scan_by_header(spark, path).count() == station.scan_with_station(spark, path).count() == 4
    assert [r.rejected for r in station.rejects(raw).collect()] == [["data"]]
    with pytest.raises(Exception, match="not a date"):
        station.typed(raw, on_error="abort").collect()


def test_strict_numbers_refuse_suffixes(spark):
    rows = spark.createDataFrame([("1,5",), ("NaN",), ("",)], "v string")
    assert [r.v for r in rows.select(text.strict_number(F.col("v")).alias("v")).collect()] == [1.5, None, None]
    for bad in ("1d", "2f", "Infinity"):
        with pytest.raises(Exception, match="not a number"):
            spark.createDataFrame([(bad,)], "v string").select(text.strict_number(F.col("v"))).collect()


def test_stream_dedup(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00', 1), (1, TIMESTAMP '2024-01-01 00:00:00', 2), (2, TIMESTAMP '2024-01-01 00:00:00', 3) AS t(station, ts, v)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = incremental.dedup_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ["station", "ts"], "ts")
    incremental.run_once(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert quality.dedup_observations(rows, ["station", "ts"], ["v"]).orderBy("station").collect()[0].v == 1


def test_bad_row_fails_a_strict_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1;2\nx;3\n")
    df = spark.read.schema("a int, b int").options(sep=";", mode="FAILFAST").csv(str(tmp_path / "in"))
    with pytest.raises(Exception):
        sink.append_chunked(df, str(tmp_path / "out"))


def test_variant(spark):
    df = spark.createDataFrame([('{"k": 5, "s": "a"}',), ("not json",), (None,)], "raw string")
    got = sink.extract_variant(sink.to_variant(df, "raw"), "RAW_DATA", {"k": ("$.k", "int"), "s": ("$.s", "int")}).select("k", "s").collect()
    assert [tuple(r) for r in got] == [(5, None), (None, None), (None, None)]


def test_chunks_and_load_report(spark, tmp_path):
    sink.append_chunked(spark.range(100).coalesce(1), str(tmp_path / "c"), 30)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 4
    rows = spark.createDataFrame([("a",), ("a",)], "file string")
    report = sink.load_report(rows, expected=spark.createDataFrame([("a",), ("b",)], "file string"))
    assert {tuple(r) for r in report.collect()} == {("a", 2, "success"), ("b", 0, "empty")}
    with pytest.raises(ValueError):
        sink.require_loaded(report)
