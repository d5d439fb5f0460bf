"""Hourly station files: Latin-1 text, semicolons, a short preamble, a header, then readings.

Lines are told apart by content, so files are split freely and nothing depends on line numbers:
a preamble line begins with a label and a colon, a header with the name of the date column, and
everything else is a reading, also where its date is empty or in an unknown layout. Only the preamble reader looks at whole files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliogrid.columns import MEASURES, RAW_SCHEMA, SHORT_MODEL, STATION_COLUMNS, canonical_name, header_to
from heliogrid.functions import dates, text
from heliogrid.session import broadcast_if_small, stage_table

# File format of the station readings.
STATION_FORMAT = {
    "sep": ";",
    "encoding": "ISO-8859-1",
    "header": "false",
    "mode": "PERMISSIVE",
    "recursiveFileLookup": "true",
}
# Preamble length and the lines that hold name, latitude and longitude (from 0).
PREAMBLE_LINES, NAME_LINE, LATITUDE_LINE, LONGITUDE_LINE = 8, 1, 4, 5

# First cell of a preamble line (a label) and of a header, which may also be the name of any column.
LABEL_PATTERN, HEADER_PATTERN = r":\s*$", r"^\s*(?i:data|date)\b"
COLUMN_NAMES = sorted({s.upper() for c in STATION_COLUMNS for s in (c.header, c.friendly, c.loaded, c.ddl)})


def is_header(first: Column) -> Column:
    return F.coalesce(first.rlike(HEADER_PATTERN) & ~first.rlike(LABEL_PATTERN) | F.upper(F.trim(first)).isin(COLUMN_NAMES), F.lit(False))


def is_reading(first: Column, has_cells: Column) -> Column:
    """Neither preamble nor header nor blank; ``has_cells`` tells whether any cell is filled."""
    return has_cells & ~is_header(first) & ~F.coalesce(first.rlike(LABEL_PATTERN), F.lit(False))


def only_readings(raw: DataFrame) -> DataFrame:
    """The readings among the rows of a station file, by :func:`is_reading`."""
    cells = [F.col(f"`{c}`") for c in RAW_SCHEMA.names]
    return raw.filter(is_reading(cells[0], F.coalesce(*cells).isNotNull()))


def year_paths(template: str, years: Iterable[int]) -> list[str]:
    """Paths of several years, to be read in one scan; ``{year}`` is filled in."""
    return [template.format(year=y) for y in years]


def scan_raw(spark: SparkSession, paths: str | list[str], with_file: bool = False, **options: str) -> DataFrame:
    """All 19 columns as text under the file headers; short rows are padded with null."""
    df = spark.read.schema(RAW_SCHEMA).options(**{**STATION_FORMAT, **options}).csv(paths)
    if with_file:
        df = df.withColumn("file", F.col("_metadata.file_path"))
    return only_readings(df)


def scan_by_header(spark: SparkSession, paths: str | list[str], others: bool = False) -> DataFrame:
    """Text columns under friendly names, matched by each file's own header line.

    For files whose columns stand in another order or are spelled in another way. The header
    lines (one per file) are joined back by file; unknown columns are left out. With ``others``
    they come behind the known ones under their own names (null in files without them), so that any
    number of files with differing columns is brought together by name in one scan; the plan grows
    with the number of different names only, which come back to the driver.
    """
    lines = (
        spark.read.options(recursiveFileLookup="true", encoding="ISO-8859-1", sep="\u0001", quote="")
        .schema("line string")
        .csv(paths)
        .select(F.col("_metadata.file_path").alias("file"), F.split("line", ";", -1).alias("cells"))
    )
    known = F.create_map(
        *[F.lit(v) for c in STATION_COLUMNS for s in {c.header, c.friendly, c.loaded, c.ddl} for v in (s.upper(), c.friendly)]
    )
    first, wide = F.col("cells")[0], F.size("cells") > 2
    headers = lines.filter(wide & is_header(first))
    headers = headers.groupBy("file").agg(
        F.max(F.transform("cells", lambda c: F.coalesce(known[F.upper(F.trim(c))], F.trim(c) if others else F.lit("")))).alias("names")
    )
    headers = stage_table(headers, "headers")
    names = [c.friendly for c in STATION_COLUMNS]
    if others:
        found = {r[0] for r in headers.select(F.explode("names")).distinct().collect()}
        names += sorted(found - set(names) - {"", "file"})
    headers, _ = broadcast_if_small(headers)
    rows = lines.filter(is_reading(first, wide & F.exists("cells", lambda c: c != ""))).join(headers, "file")
    cols = [F.get("cells", F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in names]
    return rows.select("file", *cols)


def with_null_tokens(df: DataFrame) -> DataFrame:
    return df.select(*[text.null_tokens(F.col(f"`{c}`")).alias(c) for c in df.columns])


def friendly(raw: DataFrame) -> DataFrame:
    """Friendly names for the file headers, nothing cast."""
    return raw.withColumnsRenamed(header_to("friendly"))


def typed(raw: DataFrame, scale: str = "float", on_error: str = "skip") -> DataFrame:
    """Friendly names with float measures and whole wind direction.

    Text that is not a number becomes null with ``on_error='skip'`` and stops the load with
    ``'abort'``, as does a date in an unknown layout; the null tokens are null in both.
    """
    abort = on_error == "abort"
    number = text.strict_number if abort else text.try_number
    cols = []
    for c in STATION_COLUMNS:
        if c.kind in ("date", "time"):
            value = F.col(f"`{c.header}`")
            if abort and c.kind == "date":
                message = F.concat(F.lit("not a date: "), value)
                value = F.when(text.null_tokens(F.trim(value)).isNotNull() & dates.try_date(value).isNull(), F.raise_error(message)).otherwise(value)
            cols.append(value.alias(c.friendly))
    for c in MEASURES:
        kind = "int" if c.kind == "int" else scale
        cols.append(number(F.col(f"`{c.header}`"), kind).alias(c.friendly))
    return raw.select(*cols, *[c for c in raw.columns if c not in RAW_SCHEMA.names])


def rejects(raw: DataFrame) -> DataFrame:
    """Rows with text that does not parse: all columns of ``raw`` and ``rejected``, the friendly names of these cells."""

    def bad(c) -> Column:
        value = text.null_tokens(F.trim(F.col(f"`{c.header}`")))
        if c.kind in ("date", "time"):
            parsed = dates.try_date(value).isNotNull() if c.kind == "date" else dates.try_time(value).isNotNull()
        else:
            parsed = text.try_number(value, "double").isNotNull()
        return F.when(value.isNotNull() & ~parsed, F.lit(c.friendly))

    return raw.withColumn("rejected", F.array_compact(F.array(*[bad(c) for c in STATION_COLUMNS]))).filter(F.size("rejected") > 0)


def short_model(raw: DataFrame) -> DataFrame:
    """The six-column model: date, hour and four measures."""
    df = typed(raw).withColumn("data", dates.try_date(F.col("data")))
    return df.select(*[F.col(k).alias(v) for k, v in SHORT_MODEL.items()])


def positional(raw: DataFrame) -> DataFrame:
    """The loaded table: columns by position under the loader's names, null tokens removed."""
    return with_null_tokens(raw.select(*[F.col(f"`{c.header}`").alias(c.loaded) for c in STATION_COLUMNS]))


def decimal_comma(raw: DataFrame) -> DataFrame:
    """Normalised headers, measures as double."""
    cols = []
    for c in STATION_COLUMNS:
        source = F.col(f"`{c.header}`")
        value = text.try_number(source) if c in MEASURES else source
        cols.append(value.alias(text.normalize_header(c.header)))
    return raw.select(*cols)


def staging(raw: DataFrame, scale: str = "decimal(18,3)", humidity_as_string: bool = False) -> DataFrame:
    """The staging view: date, time and the measures it keeps.

    ``scale='decimal(38,0)'`` gives whole numbers, the default scale of the source dialect.
    """
    cols: list[Column] = []
    for c in STATION_COLUMNS:
        if c.staging is None:
            continue
        source = F.col(f"`{c.header}`")
        if c.kind == "date":
            value = dates.try_date(source)
        elif c.kind == "time":
            value = dates.try_time(source)
        elif humidity_as_string and c.friendly == "umidade_rel_ar_pct":
            value = source
        else:
            value = text.try_number(source, scale)
        cols.append(value.alias(c.staging))
    return raw.select(*cols)


def _preamble_fields(lines: Column, name_line: int, lat_line: int, lon_line: int) -> list[Column]:
    def value(line: int) -> Column:
        return text.split_item(F.get(lines, line), ";", 1)

    return [
        value(name_line).alias("nome"),
        text.comma_to_point(value(lat_line)).alias("latitude"),
        text.comma_to_point(value(lon_line)).alias("longitude"),
    ]


def preamble_by_position(
    spark: SparkSession,
    paths: str | list[str],
    lines: int = PREAMBLE_LINES,
    name_line: int = NAME_LINE,
    lat_line: int = LATITUDE_LINE,
    lon_line: int = LONGITUDE_LINE,
) -> DataFrame:
    """Station name and position of each file from its first lines; one row per file, no shuffle."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    head = F.split(F.substring_index(text.latin1(F.col("content")), "\n", lines), "\r?\n")
    return files.select(F.col("path").alias("file"), *_preamble_fields(head, name_line, lat_line, lon_line))


def scan_with_station(
    spark: SparkSession, paths: str | list[str], name_line: int = NAME_LINE, lat_line: int = LATITUDE_LINE, lon_line: int = LONGITUDE_LINE
) -> DataFrame:
    """All text columns with the station name and position of the same file, in a single pass.

    A file is one input row here, which suits files of a station and year (about a megabyte) and
    saves the join of ``tag_station`` and a second read. For files near 2 GB use that instead.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    split = files.select(F.col("path").alias("file"), F.split(text.latin1(F.col("content")), "\r?\n").alias("lines"))
    station = F.struct("file", *_preamble_fields(F.col("lines"), name_line, lat_line, lon_line))
    # Readings are chosen and given their station before the lines become rows, so no row holds the file. The outer form
    # keeps the optimizer from asking first whether there are any lines, which would decode every file once more.
    cells = lambda line: F.split(line, ";", -1)
    chosen = F.filter("lines", lambda x: is_reading(cells(x)[0], (F.size(cells(x)) > 2) & x.rlike("[^;]")))
    rows = split.select(chosen.alias("chosen"), station.alias("station"))
    rows = rows.select(F.inline_outer(F.transform("chosen", lambda x: F.struct(x.alias("line"), F.col("station").alias("station")))))
    rows = rows.filter("line IS NOT NULL").select(F.split("line", ";", -1).alias("cells"), "station.*")
    cols = [F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(RAW_SCHEMA.names)]
    return rows.select(*cols, "file", F.col("nome").alias("estacao"), "latitude", "longitude")


def preamble_by_label(spark: SparkSession, paths: str | list[str], labels: dict[str, str]) -> DataFrame:
    """The same from labelled lines, for files of any size: ``labels`` maps output name to label.

    Files are split freely; only the labelled lines reach the grouping.
    """
    lines = (
        spark.read.options(recursiveFileLookup="true", encoding="ISO-8859-1", sep="\u0001", quote="")
        .schema("line string")
        .csv(paths)
        .select(F.col("_metadata.file_path").alias("file"), "line")
    )
    label = F.upper(F.trim(F.regexp_replace(text.split_item(F.col("line"), ";", 0), ":$", "")))
    value = text.split_item(F.col("line"), ";", 1)
    wanted = lines.select("file", label.alias("label"), value.alias("value")).filter(F.col("label").isin(*labels.values()))
    return wanted.groupBy("file").agg(
        *[F.max(F.when(F.col("label") == v, text.comma_to_point(F.col("value")))).alias(k) for k, v in labels.items()]
    )


def tag_station(rows: DataFrame, preamble: DataFrame, key: str = "file", name: str = "estacao") -> DataFrame:
    """Add the station name of the same file to every reading."""
    side, _ = broadcast_if_small(stage_table(preamble.select(key, F.col("nome").alias(name)), "preamble"))
    return rows.join(side, key, "left")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Leave out columns without any value (one aggregate, one row back)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def drop_prefixed(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)])


def detect_date_column(df: DataFrame) -> str:
    """First text column whose values all are dates; else by name; else the first column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    stats = []
    for i, c in enumerate(texts):
        col = F.col(f"`{c}`")
        stats.append(F.count(col).alias(f"n_{i}"))
        stats.append(F.count_if(col.isNotNull() & dates.try_date(col).isNull()).alias(f"bad_{i}"))
    if stats:
        found = df.agg(*stats).first()
        for i, c in enumerate(texts):
            if found[f"n_{i}"] > 0 and found[f"bad_{i}"] == 0:
                return c
    for c in df.columns:
        upper = c.upper()
        if "DATA" in upper and ("YYYY-MM-DD" in upper or "YYYY/MM/DD" in upper):
            return c
    return df.columns[0]


def pick_column(df: DataFrame, part: str) -> Column:
    """First non-null among the columns whose name holds ``part``."""
    names = [c for c in df.columns if part.upper() in c.upper()]
    if not names:
        raise ValueError(f"no column name holds {part!r}")
    return F.coalesce(*[F.col(f"`{c}`") for c in names])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name, after spellings are made canonical."""
    out = None
    for df in frames:
        df = df.select(*[F.col(f"`{c}`").alias(canonical_name(c) or c) for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
