"""Text clean-up and safe typing. Only built-in expressions, so all of it stays in codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space characters. SQL trim() removes blanks only.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_sql(c: str) -> str:
    """The text of ``strip``. Sources have dozens of such fields, and SQL text is one call into
    the JVM per field."""
    return f"btrim({c}, '{WHITE_SPACE}')"


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    if isinstance(c, str):
        return F.expr(strip_sql(c))
    return F.btrim(c, F.lit(WHITE_SPACE))


# Text that is a plain integer. Testing it first matters: a failed try_cast costs an exception
# per value, some fifty times a successful one.
INTEGER = "^[+-]?0*[0-9]{1,19}$"  # leading zeros don't count


def safe_int(c: Column | str, dtype: str = "bigint") -> Column:
    """Integer after stripping; whatever is not a plain integer of that width becomes null."""
    if isinstance(c, str):
        text = strip_sql(c)
        return F.expr(f"CASE WHEN {text} RLIKE '{INTEGER}' THEN try_cast({text} AS {dtype}) END")
    return plain_int(strip(c), dtype)


# Integer fields of a whole row, joined by semicolons, that need no clean-up: blanks around digits at
# most, and few enough of them for 64 bits.
PLAIN_ROW = r"^(?: *+[+-]?[0-9]{1,18}+ *+(?:;|\\z))*+\\z"


def plain_row(columns: list[str]) -> str:
    """Whether all fields of a row are plain integers or null: one pattern for the row."""
    return f"concat_ws(';', {', '.join(columns)}) RLIKE '{PLAIN_ROW}'"


def ascii_row(columns: list[str]) -> str:
    """Whether all fields of a row are printable ASCII, whose only white space is the blank."""
    return f"NOT concat_ws('', {', '.join(columns)}) RLIKE '[^ -~]'"


def row_int(c: str, dtype: str = "bigint", plain: str = "_plain") -> str:
    """``safe_int`` of a field of a row with its plain_row in a column: only rows that fail it are
    stripped and tested field by field."""
    text = strip_sql(c)
    return (f"CASE WHEN {plain} THEN try_cast({c} AS {dtype}) "
            f"WHEN {text} RLIKE '{INTEGER}' THEN try_cast({text} AS {dtype}) END")


def row_strip(c: str, ascii_: str = "_ascii") -> str:
    """``strip`` of a field of a row with its ascii_row in a column."""
    return f"CASE WHEN {ascii_} THEN trim({c}) ELSE {strip_sql(c)} END"


def plain_int(c: Column | str, dtype: str = "int") -> Column:
    """Integer of a text that may not contain blanks (a cast alone would ignore them)."""
    c = _col(c)
    return F.when(c.rlike(INTEGER), c.try_cast(dtype))


def without_prefix(c: str, prefix: str = "N") -> Column:
    """Strip, drop one leading prefix, strip again."""
    bare = strip_sql(c)
    rest = f"substr({bare}, {len(prefix) + 1})"
    return F.expr(strip_sql(f"CASE WHEN startswith({bare}, '{prefix}') THEN {rest} ELSE {bare} END"))


def strip_zeros(c: Column | str) -> Column:
    """Drop leading zeros; a text of zeros only becomes '0'; null stays null."""
    bare = F.ltrim(strip(c), F.lit("0"))
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def birth_year(c: Column | str) -> Column:
    """Year of a YYYYMM text."""
    return plain_int(F.substring(_col(c), 1, 4))


def birth_month(c: Column | str) -> Column:
    """Month of a YYYYMM text."""
    return plain_int(F.substring(_col(c), 5, 2))
