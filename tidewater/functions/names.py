"""Name and text normalisation.

Each rule exists twice: as a driver function on a column *name* (the schema has
at most a few thousand names, so plain Python is right there) and as a JVM-side
Column expression for the same rule applied to *values* at scale.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -------------------------
# snake_case: two substitutions, then lower-case.
SNAKE_STEP_1 = (r"(.)([A-Z][a-z]+)", r"\1_\2")
SNAKE_STEP_2 = (r"([a-z0-9])([A-Z])", r"\1_\2")
# Accent folding classes, each folded to the lower-case base letter.
ACCENT_CLASSES = {
    "a": "áÁàÀäÄ",
    "e": "éÉèÈëË",
    "i": "íÍìÌïÏ",
    "o": "óÓòÒöÖ",
    "u": "úÚùÙüÜ",
    "n": "ñÑ",
}
# The whole word "ano" (any case) becomes "anio".
ANIO_PATTERN = r"(?i)\bano\b"
ANIO_REPLACEMENT = "anio"
# The same word rule for Java's regex engine: Python's word characters are
# Unicode letters, numbers and '_' (Java's own \b differs next to marks and
# numeric symbols such as '²').
ANIO_PATTERN_JAVA = r"(?i)(?<![\p{L}\p{N}_])ano(?![\p{L}\p{N}_])"
# Characters kept in a normalised name; everything else becomes "_".
NAME_DISALLOWED = r"[^0-9a-zA-Z_]"
# Characters Python's str.split()/str.strip() treat as whitespace.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# -----------------------------------------------------------------------------

_FOLD_FROM = "".join(ACCENT_CLASSES.values())
_FOLD_TO = "".join(base * len(chars) for base, chars in ACCENT_CLASSES.items())
_WS_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE) + "]"


def snake_case(name: str) -> str:
    """CamelCase -> camel_case for one column name."""
    if not isinstance(name, str):
        raise RuntimeError(f"Error converting '{name}' to snake_case: not a string")
    name = re.sub(SNAKE_STEP_1[0], SNAKE_STEP_1[1], name)
    name = re.sub(SNAKE_STEP_2[0], SNAKE_STEP_2[1], name)
    return name.lower()


def snake_case_col(c: Column | str) -> Column:
    """snake_case over string values (Java regex; same patterns)."""
    c = F.col(c) if isinstance(c, str) else c
    # (?d): only '\n' ends a line for '.', as in Python's re
    step1 = F.regexp_replace(c, "(?d)" + SNAKE_STEP_1[0], "$1_$2")
    step2 = F.regexp_replace(step1, SNAKE_STEP_2[0], "$1_$2")
    return F.lower(step2)


def fold_accents(text: str) -> str:
    return text.translate(str.maketrans(_FOLD_FROM, _FOLD_TO))


def normalize_name(name: str) -> str:
    """Column-name clean-up: fold accents, año->anio, non-word -> '_', collapse, strip.

    Case is preserved (lower-casing comes from :func:`snake_case`).
    """
    out = fold_accents(name)
    out = re.sub(ANIO_PATTERN, ANIO_REPLACEMENT, out)
    out = re.sub(NAME_DISALLOWED, "_", out)
    return re.sub(r"_+", "_", out).strip("_")


def fold_accents_col(c: Column | str) -> Column:
    """Accent folding plus the año -> anio word rule, over values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(c, _FOLD_FROM, _FOLD_TO), ANIO_PATTERN_JAVA, ANIO_REPLACEMENT)


def slugify_col(c: Column | str) -> Column:
    """Non ``[0-9a-zA-Z_]`` -> '_', collapse runs, strip leading/trailing '_'."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.regexp_replace(F.regexp_replace(c, NAME_DISALLOWED, "_"), "_+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")


def normalize_name_col(c: Column | str) -> Column:
    """:func:`normalize_name` over values."""
    return slugify_col(fold_accents_col(c))


def sheet_key(sheet: str) -> str:
    """Sheet name -> schema folder key: split on whitespace, join with '_', lower."""
    return "_".join(sheet.strip().split()).lower()


def sheet_key_col(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    trimmed = F.regexp_replace(c, f"^{_WS_CLASS}+|{_WS_CLASS}+$", "")
    return F.lower(F.regexp_replace(trimmed, f"{_WS_CLASS}+", "_"))


def py_strip_col(c: Column | str) -> Column:
    """Python ``str.strip()`` semantics (Unicode whitespace) as a Column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{_WS_CLASS}+|{_WS_CLASS}+$", "")


def check_collisions(names: list[str]) -> None:
    """Raise if two output names are equal ignoring case (Spark resolves case-insensitively)."""
    seen: dict[str, str] = {}
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"Normalised column names collide: '{seen[k]}' and '{n}'")
        seen[k] = n
