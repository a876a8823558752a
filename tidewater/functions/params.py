"""List, path and parameter helpers over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.names import py_strip_col

# --- fixed values (must equal the reference's rules) -------------------------
# Text that means "no list at all".
NONE_LIKE = ["", "''", '""', "None", "null", "NULL"]
# Supported raw file extensions and the format each one means.
EXTENSION_FORMATS = [(".csv", "csv"), (".json", "json"), (".xlsx", "excel")]
# Parameter names that carry the load window.
START_PARAM = "fecha_inicial"
END_PARAM = "fecha_final"
CUT_PARAM = "fecha_corte"
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_list(c: Column | str, sep: str = ",") -> Column:
    """Comma list text -> trimmed, non-blank ``array<string>``; none-like or empty -> NULL.

    Array input is cleaned the same way (elements trimmed, blanks dropped).
    """
    c = _c(c)
    items = F.split(c, F.lit(sep), -1)
    cleaned = F.filter(F.transform(items, lambda x: py_strip_col(x)), lambda x: x != F.lit(""))
    return F.when(c.isNull() | c.isin(NONE_LIKE), F.lit(None).cast("array<string>")) \
            .when(F.size(cleaned) > 0, cleaned)


def clean_list(c: Column | str) -> Column:
    """Array input variant of :func:`parse_list`."""
    c = _c(c)
    cleaned = F.filter(F.transform(c, lambda x: py_strip_col(x)), lambda x: x.isNotNull() & (x != F.lit("")))
    return F.when(F.size(cleaned) > 0, cleaned)


def strip_slashes(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), "^/+|/+$", "")


def rstrip_slashes(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), "/+$", "")


def format_of_path(c: Column | str) -> Column:
    """File format by (case-insensitive) extension; NULL when unsupported."""
    low = F.lower(_c(c))
    out = None
    for ext, fmt in EXTENSION_FORMATS:
        out = F.when(low.endswith(ext), F.lit(fmt)) if out is None else out.when(low.endswith(ext), F.lit(fmt))
    return out


def entity_from_path(c: Column | str) -> Column:
    """Entity name carried by a file path.

    Needs at least two '/'-separated segments (after stripping outer slashes).
    A file name containing '_' gives the text before its first '_'; otherwise the
    parent segment, taking the text after its first '=' when present; blank -> NULL.
    """
    parts = F.split(strip_slashes(c), "/", -1)
    last = F.element_at(parts, -1)
    parent = F.element_at(parts, -2)
    parent_val = F.when(parent.contains("="), F.regexp_replace(parent, "^[^=]*=", "")).otherwise(parent)
    return (F.when(F.size(parts) < 2, F.lit(None).cast("string"))
             .when(last.contains("_"), F.substring_index(last, "_", 1))
             .when(parent_val != "", parent_val))


def resolve_key(file_name: Column | str, key_raw: Column | str, bucket: Column | str,
                scheme: str = "s3://") -> Column:
    """Absolute path of a single raw file: absolute kept, key under ``key_raw`` kept, else prefixed."""
    f = py_strip_col(_c(file_name))
    key = F.regexp_replace(f, "^/+", "")
    kr = rstrip_slashes(key_raw)
    full = F.when(key.startswith(F.concat(kr, F.lit("/"))) | (key == kr), key) \
            .otherwise(F.concat(kr, F.lit("/"), key))
    return F.when(f.startswith(scheme), f).otherwise(F.concat(F.lit(scheme), _c(bucket), F.lit("/"), full))


def optional_arg(c: Column | str) -> Column:
    """Optional job argument: blank, '-' or a value starting '--' -> ''."""
    s = py_strip_col(_c(c))
    return F.when(s.isNull() | (s == "") | (s == "-") | s.startswith("--"), F.lit("")).otherwise(s)


def json_ascii(doc: Column | str) -> Column:
    """Escape every non-ASCII character of a JSON text as ``\\uXXXX`` (UTF-16 code
    units, surrogate pairs for characters beyond the BMP), the form Python's
    ``json.dumps`` produces by default. ASCII-only text is returned as is."""
    doc = _c(doc)

    def escape(ch: Column) -> Column:
        return F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(.{4})", "\\\\u$1")

    def whole(text: Column) -> Column:
        escaped = F.array_join(F.transform(F.split(text, ""),
                                           lambda ch: F.when(ch.rlike("^[\\x00-\\x7f]*$"), ch).otherwise(escape(ch))), "")
        return F.when(text.rlike("[^\\x00-\\x7f]"), escaped).otherwise(text)

    # as a lambda's variable the document is built once, though it is named three times
    return F.transform(F.array(doc), whole)[0]
