"""Column functions for messy text: numbers, null tokens, headers, paths and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "missing" in the station files.
NULL_TOKENS = ("", "NULL", "NaN")

# Layout of a station file name, in order.
STATION_FILE_TEMPLATE = "INMET_%s_%s_%s_%s_01-01-%d_A_31-12-%d.CSV"
STATION_FILE_PATTERN = r"^INMET_([A-Z]+)_([A-Z]{2})_([A-Z]\d{3})_(.+)_(\d{2}-\d{2}-\d{4})_A_(\d{2}-\d{2}-\d{4})\.[Cc][Ss][Vv]$"

# A plain decimal number, so that suffixes such as 1d are refused.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def comma_to_point(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit("."))


def try_number(col: Column, kind: str = "double", decimal_sep: str = ",") -> Column:
    """Text to number; anything that is not a plain number becomes null (never NaN)."""
    text = comma_to_point(col) if decimal_sep == "," else col
    if kind == "int":
        value = F.round(text.try_cast("double")).try_cast("int")
    else:
        value = text.try_cast(kind)
    return F.when(text.rlike(NUMBER_PATTERN), value)


def strict_number(col: Column, kind: str = "double", decimal_sep: str = ",") -> Column:
    """Text to number; text that is neither a number nor a null token stops the query."""
    text = null_tokens(F.trim(col))
    text = comma_to_point(text) if decimal_sep == "," else text
    # A cast alone takes suffixes such as 1d, and words such as Infinity; the marked text makes it fail.
    marked = F.when(text.rlike(NUMBER_PATTERN), text).otherwise(F.concat(F.lit("not a number: "), text))
    return marked.cast(kind)


def try_whole_number(col: Column) -> Column:
    """Text to a whole number with rounding, the default scale of a NUMERIC cast."""
    return try_number(col, "decimal(38,0)")


def normalize_header(name: str) -> str:
    return name.strip().upper().replace(" ", "_")


def normalize_text(col: Column) -> Column:
    return F.replace(F.upper(F.trim(col)), F.lit(" "), F.lit("_"))


def latin1(col: Column) -> Column:
    """Bytes to text; every byte is a Latin-1 character, so no byte is refused."""
    return F.decode(col, "ISO-8859-1")


def split_item(col: Column, sep: str, index: int) -> Column:
    """The ``index``-th item (from 0) after splitting on ``sep``, trimmed; null if absent."""
    return F.trim(F.get(F.split(col, f"\\Q{sep}\\E", -1), index))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def strip_prefix(path: Column, length: int) -> Column:
    return F.substr(path, F.lit(length + 1))


def has_special_chars(path: Column) -> Column:
    """True where the last path part holds a space or a parenthesis."""
    return basename(path).rlike(r"[ ()]")


def safe_key(path: Column) -> Column:
    """Spaces to underscores and no parentheses, in the last path part only."""
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    return F.concat(folder, F.translate(basename(path), " ()", "_"))


def join_key(prefix: Column | str, path: Column, flatten: bool = False) -> Column:
    """Prefix and path joined by one slash; ``flatten`` keeps only the last path part."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    head = F.regexp_replace(head, r"^/+|/+$", "")
    tail = F.regexp_replace(basename(path) if flatten else path, r"^/+", "")
    return F.when(head == "", tail).otherwise(F.concat_ws("/", head, tail))


def tree_entry(line: Column) -> Column:
    """Name shown on one line of a tree listing, null when it is not a file.

    A name counts as a file when something follows a dot that is not the first character.
    """
    tail = F.regexp_extract(line, r"^(?:.*──)?(.*)$", 1)
    name = F.regexp_replace(F.regexp_replace(tail, "\u00a0", " "), r"^\s+|\s+$", "")
    is_file = basename(name).rlike(r"^\.*[^.].*\.") & ~line.startswith("``")
    return F.when(is_file, name)


def station_file_name(region: Column, state: Column, code: Column, name: Column, year: Column) -> Column:
    return F.format_string(STATION_FILE_TEMPLATE, region, state, code, name, year, year)


def parse_station_file_name(path: Column) -> Column:
    """Struct of region, state, code, name, start and end; null if the name has another form."""
    base = basename(path)

    def part(i: int) -> Column:
        return F.regexp_extract(base, STATION_FILE_PATTERN, i)

    fields = F.struct(
        part(1).alias("region"),
        part(2).alias("state"),
        part(3).alias("code"),
        part(4).alias("name"),
        F.try_to_date(part(5), "dd-MM-yyyy").alias("start"),
        F.try_to_date(part(6), "dd-MM-yyyy").alias("end"),
    )
    return F.when(base.rlike(STATION_FILE_PATTERN), fields)


def has_token(path: Column, token: str, substring: bool = False) -> Column:
    """``token`` as a part between underscores, or anywhere when ``substring``."""
    return basename(path).contains(token if substring else f"_{token}_")


def has_suffix(path: Column, suffix: str, ignore_case: bool = True) -> Column:
    if ignore_case:
        return F.lower(path).endswith(suffix.lower())
    return path.endswith(suffix)
