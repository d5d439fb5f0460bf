"""Station files: scans, typing, preambles and incremental loads, on files made from the events."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from heliogrid.columns import DDL_SCHEMA, RAW_SCHEMA, STATION_COLUMNS
from heliogrid.functions import dates, text
from heliogrid.operators import mart, quality
from heliogrid.operators.project import conform
from heliogrid.plans.energy import station_climate as climate_of
from heliogrid.queries.base import (
    READINGS_PER_FILE,
    VALUE_SQL,
    VALUE_TEXT_SQL,
    once,
    query,
    raw_readings,
    rounded,
    station_files,
    table,
)
from heliogrid.session import new_folder
from heliogrid.sinks import tables as sink
from heliogrid.sources import station
from heliogrid.sources.catalog import file_catalog
from heliogrid.streaming import exactly_once, incremental

DATE, HOUR, RAIN, RADIATION, WIND_DIRECTION = (
    RAW_SCHEMA.names[0],
    RAW_SCHEMA.names[1],
    "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)",
    "RADIACAO GLOBAL (Kj/m²)",
    "VENTO, DIREÇÃO HORARIA (gr) (° (gr))",
)


@query(
    "scan_station_raw",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS data, strftime(ts, '%H%M') || ' UTC' AS hora_utc, user_id || ',5' AS precipitacao_mm,
               nullif({VALUE_TEXT_SQL}, '') AS radiacao_global_kj_m2, CAST(event_id % 360 AS VARCHAR) AS vento_direcao_gr FROM events""",
)
def scan_station_raw(spark, sf_dir):
    rows = station.friendly(station.scan_raw(spark, station_files(spark, sf_dir)))
    return rows.select("data", "hora_utc", "precipitacao_mm", "radiacao_global_kj_m2", "vento_direcao_gr")


@query(
    "scan_by_header",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS data, user_id || ',5' AS precipitacao_mm, {VALUE_TEXT_SQL} AS radiacao_global_kj_m2,
               '-' || event_id % 10 || ',25' AS vento_velocidade_ms FROM events""",
)
def scan_by_header(spark, sf_dir):
    rows = station.scan_by_header(spark, station_files(spark, sf_dir))
    return rows.select("data", "precipitacao_mm", "radiacao_global_kj_m2", "vento_velocidade_ms")


@query(
    "scan_station_typed",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS data, strftime(ts, '%H%M') || ' UTC' AS hora_utc, round(user_id + 0.5, 4)::DOUBLE AS precipitacao_mm,
               round({VALUE_SQL}, 3) AS radiacao_global_kj_m2, round((event_id % 100) / 100.0, 3)::DOUBLE AS temperatura_ar_c,
               CAST(event_id % 360 AS INTEGER) AS vento_direcao_gr, -(event_id % 10) - 0.25::DOUBLE AS vento_velocidade_ms FROM events""",
)
def scan_station_typed(spark, sf_dir):
    rows = station.typed(station.scan_raw(spark, station_files(spark, sf_dir)))
    return rounded(rows, 3).select(
        "data", "hora_utc", "precipitacao_mm", "radiacao_global_kj_m2", "temperatura_ar_c", "vento_direcao_gr", "vento_velocidade_ms"
    )


@query(
    "scan_positional",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS "Data", strftime(ts, '%H%M') || ' UTC' AS hora_utc,
               CASE WHEN {VALUE_TEXT_SQL} NOT IN ('', 'NaN', 'NULL') THEN {VALUE_TEXT_SQL} END AS radiacao,
               CAST(NULL AS VARCHAR) AS rajada FROM events""",
)
def scan_positional(spark, sf_dir):
    rows = station.positional(station.scan_raw(spark, station_files(spark, sf_dir)))
    return rows.select("Data", "hora_utc", F.col("`radiacao_global_(kj/m²)`").alias("radiacao"), F.col("`vento_rajada_maxima_(m/s)`").alias("rajada"))


@query(
    "decimal_comma_scan",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS "DATA", user_id + 0.5::DOUBLE AS chuva, {VALUE_SQL} AS radiacao,
               CAST(event_id % 101 AS DOUBLE) AS umidade FROM events""",
)
def decimal_comma_scan(spark, sf_dir):
    rows = station.decimal_comma(station.scan_raw(spark, station_files(spark, sf_dir)))
    return rows.select(
        "DATA",
        F.col("`PRECIPITAÇÃO_TOTAL,_HORÁRIO_(MM)`").alias("chuva"),
        F.col("`RADIACAO_GLOBAL_(KJ/M²)`").alias("radiacao"),
        F.col("`UMIDADE_RELATIVA_DO_AR,_HORARIA_(%)`").alias("umidade"),
    )


@query(
    "project_typed",
    """SELECT CAST(ts AS DATE) AS date, strftime(ts, '%H%M') || ' UTC' AS hour, user_id + 0.5::DOUBLE AS precipitacao,
              round((event_id % 100) / 100.0, 3)::DOUBLE AS temperatura, CAST(event_id % 101 AS DOUBLE) AS umidade,
              -(event_id % 10) - 0.25::DOUBLE AS vento FROM events""",
)
def project_typed(spark, sf_dir):
    return rounded(station.short_model(station.scan_raw(spark, station_files(spark, sf_dir))), 3)


@query(
    "staging_view",
    f"""SELECT CAST(ts AS DATE) AS "DATA_OBSERVACAO", strftime(ts, '%H:%M:00') AS "HORA_OBSERVACAO", user_id + 0.5::DOUBLE AS "PRECIPITACAO_MM",
               {VALUE_SQL} AS "RADIACAO_GLOBAL_KJ_M2", CAST(event_id % 101 AS DOUBLE) AS "UMIDADE_REL_HORARIA_PCT",
               CAST(NULL AS DOUBLE) AS "VENTO_RAJADA_MAX_MS" FROM events""",
)
def staging_view(spark, sf_dir):
    rows = station.staging(station.scan_raw(spark, station_files(spark, sf_dir)), "double")
    return rows.select("DATA_OBSERVACAO", "HORA_OBSERVACAO", "PRECIPITACAO_MM", "RADIACAO_GLOBAL_KJ_M2", "UMIDADE_REL_HORARIA_PCT", "VENTO_RAJADA_MAX_MS")


@query("rename_friendly", f"SELECT event_id, strftime(ts, '%Y/%m/%d') AS data, user_id || ',5' AS precipitacao_mm, {VALUE_TEXT_SQL} AS radiacao_global_kj_m2 FROM events")
def rename_friendly(spark, sf_dir):
    return station.friendly(raw_readings(spark, sf_dir)).select("event_id", "data", "precipitacao_mm", "radiacao_global_kj_m2")


@query("null_tokens", f"SELECT event_id, CASE WHEN {VALUE_TEXT_SQL} NOT IN ('', 'NaN', 'NULL') THEN {VALUE_TEXT_SQL} END AS radiacao FROM events")
def null_tokens(spark, sf_dir):
    return raw_readings(spark, sf_dir).select("event_id", text.null_tokens(F.col(f"`{RADIATION}`")).alias("radiacao"))


@query("decimal_comma", f"SELECT event_id, {VALUE_SQL} AS radiacao, user_id + 0.5::DOUBLE AS chuva FROM events")
def decimal_comma(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    return raw.select("event_id", text.try_number(F.col(f"`{RADIATION}`")).alias("radiacao"), text.try_number(F.col(f"`{RAIN}`")).alias("chuva"))


@query(
    "numeric_scale0",
    f"SELECT event_id, CAST(round(CAST({VALUE_SQL} AS DECIMAL(18,2))) AS BIGINT) AS radiacao, CAST(user_id + 1 AS BIGINT) AS chuva FROM events",
)
def numeric_scale0(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    whole = {n: text.try_whole_number(F.col(f"`{c}`")).cast("long").alias(n) for n, c in (("radiacao", RADIATION), ("chuva", RAIN))}
    return raw.select("event_id", *whole.values())


@query(
    "try_date_mixed",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS dia FROM events""",
)
def try_date_mixed(spark, sf_dir):
    """Two layouts that parse and one (day first) that does not."""
    layout = F.when(F.col("event_type") == "error", F.date_format("ts", "dd/MM/yyyy"))
    layout = layout.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy/MM/dd"))
    return table(spark, sf_dir, "events").select("event_id", dates.try_date(layout).alias("dia"))


@query(
    "try_time_utc",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%H:%M:00') END AS hora FROM events",
)
def try_time_utc(spark, sf_dir):
    layout = F.when(F.col("event_type") == "error", F.concat(F.date_format("ts", "mm"), F.lit("h")))
    layout = layout.when(F.col("event_type") == "click", F.date_format("ts", "HH:mm")).otherwise(F.concat(F.date_format("ts", "HHmm"), F.lit(" UTC")))
    return table(spark, sf_dir, "events").select("event_id", dates.try_time(layout).alias("hora"))


@query("obs_timestamp", "SELECT event_id, date_trunc('minute', ts) AS observed_at FROM events")
def obs_timestamp(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    return raw.select("event_id", dates.observation_timestamp(dates.try_date(F.col(DATE)), F.col(f"`{HOUR}`")).alias("observed_at"))


@query(
    "conform_schema",
    f"""SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "DATA", strftime(ts, '%H%M') || ' UTC' AS "HORA_UTC", user_id + 0.5::DOUBLE AS "PRECIPITACAO_TOTAL_HORARIA_MMB",
               {VALUE_SQL} AS "RADIACAO_GLOBAL_KJ_MF", CAST(event_id % 360 AS DOUBLE) AS "VENTO_DIRECAO_HORARIA_GRAUS",
               CAST(NULL AS DOUBLE) AS "TEMPERATURA_MAXIMA_NA_HORA_ANT_AUT_C" FROM events""",
)
def conform_schema(spark, sf_dir):
    """Typed readings brought to the declared 19-column table; columns not at hand become null."""
    kept = ["data", "hora_utc", "precipitacao_mm", "radiacao_global_kj_m2", "vento_direcao_gr"]
    rows = incremental.clean_readings(raw_readings(spark, sf_dir)).select(*kept)
    names = {c.friendly: c.ddl for c in STATION_COLUMNS}
    wide = conform(rows.withColumnsRenamed({k: names[k] for k in kept}), DDL_SCHEMA)
    return wide.select(
        "DATA", "HORA_UTC", "PRECIPITACAO_TOTAL_HORARIA_MMB", "RADIACAO_GLOBAL_KJ_MF", "VENTO_DIRECAO_HORARIA_GRAUS", "TEMPERATURA_MAXIMA_NA_HORA_ANT_AUT_C"
    )


@query(
    "preamble_station",
    f"""SELECT DISTINCT 'ESTAÇÃO ' || e AS nome, '-16.' || e AS latitude, '-49.' || e AS longitude
        FROM (SELECT event_id // {READINGS_PER_FILE} AS e FROM events)""",
)
def preamble_station(spark, sf_dir):
    return station.preamble_by_position(spark, station_files(spark, sf_dir)).select("nome", "latitude", "longitude").distinct()


@query(
    "preamble_by_label",
    f"""SELECT DISTINCT 'ESTAÇÃO ' || e AS nome, '-16.' || e AS latitude, '-49.' || e AS longitude, '770.5' AS altitude
        FROM (SELECT event_id // {READINGS_PER_FILE} AS e FROM events)""",
)
def preamble_by_label(spark, sf_dir):
    labels = {"nome": "ESTACAO", "latitude": "LATITUDE", "longitude": "LONGITUDE", "altitude": "ALTITUDE"}
    return station.preamble_by_label(spark, station_files(spark, sf_dir), labels).drop("file").distinct()


@query(
    "tag_station",
    f"""SELECT 'ESTAÇÃO ' || event_id // {READINGS_PER_FILE} AS estacao, count(*) AS n, round(avg({VALUE_SQL}), 4) AS radiacao_media_anual
        FROM events GROUP BY 1""",
)
def tag_station(spark, sf_dir):
    """Readings with the station name of their file, then the mean per station."""
    files = station_files(spark, sf_dir)
    rows = station.typed(station.scan_raw(spark, files, with_file=True), "double").select("file", "radiacao_global_kj_m2")
    tagged = station.tag_station(rows, station.preamble_by_position(spark, files))
    return rounded(tagged.groupBy("estacao").agg(F.count(F.lit(1)).alias("n"), F.avg("radiacao_global_kj_m2").alias("radiacao_media_anual")))


@query(
    "scan_with_station",
    f"""SELECT 'ESTAÇÃO ' || event_id // {READINGS_PER_FILE} AS estacao, '-16.' || event_id // {READINGS_PER_FILE} AS latitude, strftime(ts, '%Y/%m/%d') AS data,
               {VALUE_SQL} AS radiacao_global_kj_m2, CAST(event_id % 360 AS INTEGER) AS vento_direcao_gr FROM events""",
)
def scan_with_station(spark, sf_dir):
    """Readings and their station from one pass over the files."""
    rows = station.typed(station.scan_with_station(spark, station_files(spark, sf_dir)), "double")
    return rows.select("estacao", "latitude", "data", "radiacao_global_kj_m2", "vento_direcao_gr")


@query(
    "station_climate",
    f"""SELECT 'ESTAÇÃO ' || e AS nome, CAST('-16.' || e AS DOUBLE) AS latitude, CAST('-49.' || e AS DOUBLE) AS longitude, round(avg(v), 4) AS radiacao_media_anual
        FROM (SELECT event_id // {READINGS_PER_FILE} AS e, {VALUE_SQL} AS v FROM events) GROUP BY 1, 2, 3""",
)
def station_climate(spark, sf_dir):
    """From files to stations with position and mean radiation."""
    return rounded(climate_of(spark, station_files(spark, sf_dir)))


@query(
    "monthly_from_files",
    f"""SELECT CAST(month(ts) AS INTEGER) AS mes, round(avg({VALUE_SQL}), 4) AS radiacao_media, round(sum(user_id + 0.5::DOUBLE), 4) AS chuva_total FROM events GROUP BY 1""",
)
def monthly_from_files(spark, sf_dir):
    """From files to the seasonal table."""
    rows = incremental.clean_readings(station.scan_raw(spark, station_files(spark, sf_dir)))
    return rounded(mart.monthly_season(rows, "data", "radiacao_global_kj_m2", "precipitacao_mm"))


@query(
    "detect_date_column",
    """SELECT event_id, strftime(ts, '%Y/%m/%d') AS "Data", event_type FROM events""",
)
def detect_date_column(spark, sf_dir):
    """The date column is found by its contents and given its fixed name."""
    df = table(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyy/MM/dd").alias("coluna"))
    return df.withColumnRenamed(station.detect_date_column(df), "Data").select("event_id", "Data", "event_type")


@query("drop_empty_columns", f"SELECT event_id, event_type, strftime(ts, '%Y/%m/%d') AS data, {VALUE_TEXT_SQL} AS radiacao FROM events")
def drop_empty_columns(spark, sf_dir):
    """Columns of a file that never hold a value, such as one after a last semicolon, go."""
    raw = raw_readings(spark, sf_dir)
    df = raw.select(
        "event_id",
        "event_type",
        F.col(DATE).alias("data"),
        F.col(f"`{RADIATION}`").alias("radiacao"),
        text.null_tokens(F.col("`VENTO, RAJADA MAXIMA (m/s)`")).alias("rajada"),
        F.lit(None).cast("string").alias("Unnamed: 19"),
    )
    return station.drop_empty_columns(df)


@query("drop_prefixed", f"SELECT event_id, {VALUE_TEXT_SQL} AS radiacao FROM events")
def drop_prefixed(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    df = raw.select("event_id", F.col(f"`{RADIATION}`").alias("radiacao"), F.lit("x").alias("Unnamed: 19"), F.col("event_type").alias("Unnamed: 20"))
    return station.drop_prefixed(df)


@query("pick_column", "SELECT event_id, CASE WHEN event_type = 'click' THEN value ELSE user_id + 0.0::DOUBLE END AS radiacao FROM events")
def pick_column(spark, sf_dir):
    """Two spellings of one column, each filled in some files: the first value present."""
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.col("value")).alias("Radiacao Global (KJ/m²)"),
        F.col("user_id").cast("double").alias("RADIACAO GLOBAL (Kj/m²)2"),
    )
    return df.select("event_id", station.pick_column(df, "RADIACAO").alias("radiacao"))


@query(
    "union_by_name",
    """SELECT strftime(ts, '%Y/%m/%d') AS data, value AS radiacao_global_kj_m2, CAST(NULL AS DOUBLE) AS precipitacao_mm FROM events
       UNION ALL SELECT strftime(l_shipdate, '%Y/%m/%d'), l_extendedprice, l_quantity FROM lineitem""",
)
def union_by_name(spark, sf_dir):
    """Two layouts with other spellings and a missing column, brought together by canonical name."""
    a = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy/MM/dd").alias("DATA"), F.col("value").alias("RADIACAO_GLOBAL_KJ_MF"))
    b = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias(RAIN), F.date_format("l_shipdate", "yyyy/MM/dd").alias(DATE), F.col("l_extendedprice").alias(RADIATION)
    )
    return station.union_by_name([a, b])


@query(
    "concat_files",
    """SELECT strftime(ts, '%Y/%m/%d') AS data, CAST(event_id AS VARCHAR) AS radiacao_global_kj_m2, NULL AS precipitacao_mm, event_type, NULL AS l_returnflag FROM events
       UNION ALL SELECT strftime(l_shipdate, '%Y/%m/%d'), CAST(l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR), NULL, l_returnflag FROM lineitem""",
)
def concat_files(spark, sf_dir):
    """Files of two layouts, each with columns that the other lacks, brought together by name in one scan."""

    def write(path):
        day = lambda c: F.date_format(c, "yyyy/MM/dd")
        a = table(spark, sf_dir, "events").select(day("ts").alias("DATA"), "event_type", F.col("event_id").alias("RADIACAO_GLOBAL_KJ_MF"))
        b = table(spark, sf_dir, "lineitem").select(day("l_shipdate").alias(DATE), F.col("l_linenumber").alias(RADIATION), F.col("l_orderkey").alias(RAIN), "l_returnflag")
        for name, rows in (("a", a), ("b", b)):
            rows.write.options(header="true", sep=";", encoding="ISO-8859-1", quote="\u0000").csv(f"{path}/{name}")

    rows = station.scan_by_header(spark, once(spark, sf_dir, "two-layouts", write), others=True)
    return rows.select("data", "radiacao_global_kj_m2", "precipitacao_mm", "event_type", "l_returnflag")


@query("dedup_observations", "SELECT user_id, h AS hora, CAST(min(event_id) AS BIGINT) AS event_id, arg_min(value, event_id) AS value FROM (SELECT *, date_trunc('hour', ts) AS h FROM events) GROUP BY 1, 2")
def dedup_observations(spark, sf_dir):
    """One reading per station and hour: the first."""
    e = table(spark, sf_dir, "events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora"), "event_id", "value")
    return quality.dedup_observations(e, ["user_id", "hora"], ["event_id"])


@query(
    "incremental_files",
    f"""SELECT CAST(ts AS DATE) AS data, count(*) AS n, count({VALUE_SQL}) AS n_radiacao FROM events GROUP BY 1""",
)
def incremental_files(spark, sf_dir):
    """Two waves of files and a third run without news; every reading is stored once."""
    source, target, ledger = (new_folder(spark, n) for n in ("wave", "loaded", "ledger"))
    raw = raw_readings(spark, sf_dir)
    headers = [F.col(f"`{h}`") for h in RAW_SCHEMA.names]
    for wave in (F.col("event_type") == "click", F.col("event_type") != "click"):
        raw.filter(wave).select(*headers).write.mode("append").options(sep=";", encoding="ISO-8859-1").csv(source)
        stream = incremental.clean_readings(incremental.station_stream(spark, source))
        incremental.run_once(stream.select("data", "observed_at", "radiacao_global_kj_m2", "year"), target, ledger)
    stream = incremental.clean_readings(incremental.station_stream(spark, source))
    incremental.run_once(stream.select("data", "observed_at", "radiacao_global_kj_m2", "year"), target, ledger)
    loaded = spark.read.parquet(target)
    return loaded.groupBy("data").agg(F.count(F.lit(1)).alias("n"), F.count("radiacao_global_kj_m2").alias("n_radiacao"))


EXACT_SQL = f"SELECT CAST(ts AS DATE) AS data, count(*) AS n, count({VALUE_SQL}) AS n_radiacao FROM events GROUP BY 1"


def loaded_once(spark, sf_dir):
    """Station files loaded in batches, of which one fails before it is published and is run again; a third run has no news."""
    files, target, ledger, checkpoint = station_files(spark, sf_dir), *(new_folder(spark, n) for n in ("exact", "ledger", "checkpoint"))
    failed = []

    def fail_once(batch):
        if batch == 0 and not failed:
            failed.append(batch)
            raise RuntimeError("stopped before the batch is published")

    def run():
        stream = incremental.station_stream(spark, f"{files}/*/*", files_per_batch=8).withColumn("file_bytes", F.col("_metadata.file_size"))
        rows = incremental.clean_readings(stream).select("file", "file_bytes", "data", "radiacao_global_kj_m2")
        exactly_once.load_exactly_once(rows, target, ledger, checkpoint, size="file_bytes", before_publish=fail_once)

    for _ in range(3):
        try:
            run()
        except StreamingQueryException:
            if len(failed) != 1:
                raise
    return target, ledger


@query("exactly_once_load", EXACT_SQL)
def exactly_once_load(spark, sf_dir):
    target, ledger = loaded_once(spark, sf_dir)
    rows = exactly_once.published(spark, target, ledger, "file string, file_bytes long, data date, radiacao_global_kj_m2 double")
    return rows.groupBy("data").agg(F.count(F.lit(1)).alias("n"), F.count("radiacao_global_kj_m2").alias("n_radiacao"))


@query(
    "timed_load_report",
    f"""SELECT 'station=' || event_id // {READINGS_PER_FILE} AS station, CAST(2024 AS INTEGER) AS year, count(*) AS n_rows, 'success' AS status, true AS timed, true AS has_bytes
        FROM events GROUP BY 1""",
)
def timed_load_report(spark, sf_dir):
    """Rows, year, status, seconds and bytes of every loaded file, each reported once."""
    _, ledger = loaded_once(spark, sf_dir)
    report = exactly_once.load_report(spark, ledger)
    timed = (F.col("seconds") > 0) & (F.col("loaded_at") <= F.current_timestamp())
    return report.select(F.regexp_extract("file", r"/(station=\d+)/", 1).alias("station"), "year", "n_rows", "status", timed.alias("timed"), (F.col("bytes") > F.col("n_rows")).alias("has_bytes"))


@query(
    "load_report",
    f"""SELECT 'station=' || event_id // {READINGS_PER_FILE} AS station, CAST(2024 AS INTEGER) AS year, count(*) AS n_rows, 'success' AS status
        FROM events GROUP BY 1""",
)
def load_report(spark, sf_dir):
    """Rows, year and status of every loaded file, from the readings and the file catalog."""
    files = station_files(spark, sf_dir)
    expected = file_catalog(spark, files, "*.csv").select(F.col("path").alias("file"))
    report = sink.load_report(station.scan_raw(spark, files, with_file=True).select("file"), expected=expected)
    return sink.with_year(report).select(F.regexp_extract("file", r"/(station=\d+)/", 1).alias("station"), "year", "n_rows", "status")


@query("latin1_decode", "SELECT doc_id, lang, regexp_replace(text, '[^\\x00-\\xFF]', '?', 'g') AS text FROM documents")
def latin1_decode(spark, sf_dir):
    """Document bodies as Latin-1 bytes (characters outside it replaced) and back to text."""
    body = F.encode(F.regexp_replace("text", r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", text.latin1(body).alias("text"))
