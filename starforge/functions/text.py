"""Scalar text functions with Python/pandas/PostgreSQL semantics, as Spark expressions.

Everything here is built from ``pyspark.sql.functions`` and stays in the JVM, but for the
exact reading of unusual literals (``literals``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.functions.dates import mixed_timestamp
from starforge.functions.literals import exact_groups, exact_list

# Python's str.strip() removes every char with str.isspace(): Unicode
# White_Space plus the four information separators U+001C..U+001F.
_PY_WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{_PY_WS}+|{_PY_WS}+$"

# pandas.to_numeric accepts plain decimal / scientific text only; Spark's
# cast also accepts suffixes such as '1.0d', hence this guard.
_NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _printable_ascii(ch: Column) -> Column:
    code = F.ascii(ch)
    return (code >= 33) & (code <= 126)


def py_strip(c) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` keeps NBSP and U+3000).

    Text whose first and last characters are printable ASCII has nothing to
    strip and skips the regex (compiled fast path).
    """
    c = _c(c)
    plain = _printable_ascii(F.substring(c, 1, 1)) & _printable_ascii(F.substring(c, -1, 1))
    return F.when(plain, c).otherwise(F.regexp_replace(c, _STRIP_RE, ""))


def strict_true(c) -> Column:
    """True only when the stripped, lower-cased text is 'true'; NULL -> False."""
    c = _c(c)
    low = F.lower(c)
    # the two usual texts are compared as they are
    return (F.when(c == F.lit("False"), F.lit(False)).when(c == F.lit("True"), F.lit(True))
             .when(F.trim(low) == F.lit("true"), F.lit(True))
             .when(c.isNull() | ~low.contains("true"), F.lit(False))
             .otherwise(F.lower(py_strip(c)) == F.lit("true")))


def lenient_number(c) -> Column:
    """pandas ``to_numeric(errors='coerce')``: bad text, NaN, inf -> NULL."""
    c = _c(c)
    return F.when(c.rlike(_NUMBER_RE), c.try_cast("double"))


def lenient_timestamp(c) -> Column:
    """Mixed-format timestamp text -> TIMESTAMP_NTZ, month first, failure -> NULL (see ``dates``)."""
    return mixed_timestamp(_c(c), py_strip)


def city_of(raw_location) -> Column:
    """Text before the first comma, stripped."""
    return py_strip(F.substring_index(_c(raw_location), ",", 1))


# ---- list / dict literal text -> nested columns ----------------------------

# Plain literals: quoted strings without escapes or control characters, in lists, and lists in a dictionary.
# They are JSON but for the quotes.  Possessive patterns: no backtracking into a long text.
_STR = r"""(?:'[^'\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+")[ \t]*+"""
_LIST = rf"\[[ \t]*+(?:{_STR}(?:,[ \t]*+{_STR})*+)?\][ \t]*+"
_ENTRY = rf"{_STR}:[ \t]*+{_LIST}"
_LAST_COMMA = r",[ \t]*+\][ \t]*+$"
_LIST_RE = rf"^[ \t]*+{_LIST}$|^[ \t]*+\[[ \t]*+{_STR}(?:,[ \t]*+{_STR})*+{_LAST_COMMA}"
_DICT_RE = rf"^[ \t]*+\{{[ \t]*+(?:{_ENTRY}(?:,[ \t]*+{_ENTRY})*+)?\}}[ \t]*+$"

_GROUPS_TYPE = "array<struct<category:string,skills:array<string>>>"


def plain_list(c) -> Column:
    """``"['a', 'b']"`` -> array<string>; NULL for any text that is no plain list (a last comma is fine)."""
    c = _c(c)
    text = F.when(c.rlike(_LAST_COMMA), F.regexp_replace(c, _LAST_COMMA, "]")).otherwise(c)
    return F.when(c.rlike(_LIST_RE), F.from_json(text, "array<string>"))


def plain_groups(c) -> Column:
    """``"{'cat': ['a'], ...}"`` -> array<struct<category, skills>> in key order; NULL for any text that is no
    plain dictionary of lists, or repeats a key."""
    def entries(m: Column) -> Column:
        unique = F.size(F.array_distinct(F.map_keys(m))) == F.size(m)
        return F.when(unique, F.map_entries(m).cast(_GROUPS_TYPE))

    c = _c(c)
    m = F.from_json(F.when(c.rlike(_DICT_RE), c), "map<string,array<string>>")
    return F.element_at(F.transform(F.array(m), entries), 1)


def left_over(c, read: Column) -> Column:
    """The text ``c`` if it is not blank or ``nan`` and the built-in reading gave NULL; else NULL."""
    c = _c(c)
    return F.when(read.isNull() & ~c.rlike(r"^\s*(nan)?\s*$"), c)


def finished_list(read: Column, text: Column | None) -> Column:
    """``read``, or what the exact step makes of ``text``, or an empty list."""
    exact = [] if text is None else [exact_list()(text)]
    return F.coalesce(read, *exact, F.array().cast("array<string>"))


def finished_groups(read: Column, text: Column | None) -> Column:
    """``read``, or what the exact step makes of ``text``, or no groups."""
    exact = []
    if text is not None:
        pair = exact_groups()(text)
        exact = [F.arrays_zip(pair["category"], pair["skills"]).cast(_GROUPS_TYPE)]
    return F.coalesce(read, *exact, F.array().cast(_GROUPS_TYPE))


def with_literals(df: DataFrame, lists: dict | None = None, groups: dict | None = None, exact: bool = True) -> DataFrame:
    """Add parsed columns (new name -> text column).

    Lists: blank, ``nan``, malformed or other text gives [].  Groups: a repeated key keeps its first position and
    its last value; entries whose value is no list are skipped; malformed or other text gives [].  Plain texts are
    read by built-in functions; only the others reach the Python step, and none do without ``exact``, for tables known
    to hold none.
    """
    lists, groups = lists or {}, groups or {}
    read = df.withColumns({f"_plain_{new}": plain_list(old) for new, old in lists.items()}
                          | {f"_plain_{new}": plain_groups(old) for new, old in groups.items()})

    def finished(finish, new: str, old: str) -> Column:
        plain = F.col(f"_plain_{new}")
        return finish(plain, left_over(old, plain) if exact else None)

    return read.withColumns({new: finished(finished_list, new, old) for new, old in lists.items()}
                            | {new: finished(finished_groups, new, old) for new, old in groups.items()}) \
        .drop(*[f"_plain_{new}" for new in (*lists, *groups)])


# ---- CSV line encoding / decoding --------------------------------------------

def quote_field(c) -> Column:
    """CSV-quote a field when it holds a comma or a quote (quotes doubled)."""
    c = F.coalesce(_c(c), F.lit(""))
    needs = c.contains(",") | c.contains('"')
    return F.when(needs, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def excel_line(fields: list, wrap: bool = True, double_inner: bool = True) -> Column:
    """Encode fields as one CSV line, optionally wrapped Excel-style in outer quotes.

    With ``double_inner`` every quote of the inner line is doubled, as a
    spreadsheet does when it quotes the whole row; without it the inner line is
    wrapped as is.
    """
    inner = F.concat_ws(",", *[quote_field(f) for f in fields])
    if not wrap:
        return inner
    body = F.replace(inner, F.lit('"'), F.lit('""')) if double_inner else inner
    return F.concat(F.lit('"'), body, F.lit('"'))


def unwrap_excel(line) -> Column:
    """Drop one outer quote pair only if the line starts AND ends with a quote,
    then turn every doubled quote into one, left to right."""
    line = _c(line)
    n_bytes = F.octet_length(line)
    wrapped = line.startswith('"') & line.endswith('"') & (n_bytes >= 2)
    # cut by bytes (a quote is one byte), which does not count the characters of the line
    inner = F.when(wrapped, F.substring(line.cast("binary"), F.lit(2), n_bytes - 2).cast("string")).otherwise(line)
    # A lone '"' starts and ends with a quote: it unwraps to ''.
    inner = F.when(line == F.lit('"'), F.lit("")).otherwise(inner)
    # U+0001 is the placeholder of the original two-step replace.
    return F.replace(F.replace(inner, F.lit('""'), F.lit("\u0001")), F.lit("\u0001"), F.lit('"'))


# ---- report text -------------------------------------------------------------

def ratio_round(num, den, scale: int) -> Column:
    """round(num/den, scale) half away from zero, exact for integer inputs (NULL if den=0)."""
    num, den = _c(num).cast("long"), _c(den).cast("long")
    p = 10 ** scale
    sign = F.when((num < 0) != (den < 0), F.lit(-1)).otherwise(F.lit(1))
    a, b = F.abs(num), F.abs(den)
    units = F.when(b != 0, _idiv(a * (2 * p) + b, b * 2))
    return (sign * units).cast("double") / F.lit(float(p))


def _idiv(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative longs (the remainder is taken
    off first, so the decimal quotient is a whole number)."""
    return ((a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def percent_text(num, den, scale: int = 1) -> Column:
    """``ROUND(num*100.0/den, scale) || '%'`` as PostgreSQL prints it."""
    num, den = _c(num).cast("long"), _c(den).cast("long")
    p = 10 ** scale
    a, b = num * (100 * p * 2) + den, den * 2
    units = F.when(den > 0, _idiv(a, b).cast("long"))
    whole = _idiv(units, F.lit(p)).cast("long")
    frac = F.lpad(F.pmod(units, F.lit(p)).cast("string"), scale, "0")
    return F.concat(whole.cast("string"), F.lit("."), frac, F.lit("%"))


def money_text(x) -> Column:
    """``'$' || TO_CHAR(ROUND(x::NUMERIC, 0), 'FM999,999')``; NULL stays NULL.

    The value is rounded once, from its decimal expansion to 10 places.
    """
    d = F.round(_c(x).cast("decimal(38,10)"), 0)
    return F.concat(F.lit("$"), F.format_number(d, 0))
