"""Text, number and path expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell texts that count as missing when a delimited file is read.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# How numbers and the true/false words look in a delimited file. The repeats are
# possessive, so that a date or a long text fails without trying shorter matches.
PLAIN_NUMBER_PATTERN = r"^[ \t]*+[+-]?(?:\d++(?:\.\d*+)?|\.\d++)[ \t]*+$"
POWER_NUMBER_PATTERN = r"^[ \t]*+[+-]?(?:\d++(?:\.\d*+)?|\.\d++)[eE][+-]?\d++[ \t]*+$"
INFINITY_PATTERN = r"(?i)^[ \t]*+[+-]?inf(?:inity)?[ \t]*+$"
BOOLEAN_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Expressions of many parts are SQL text over a column name: the driver builds one part at a time
# otherwise, which takes longer than small queries and adds up over wide tables.


def missing_to_null(name: str) -> Column:
    tokens = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
    return F.expr(f"CASE WHEN {quoted(name)} NOT IN ({tokens}) THEN {quoted(name)} END")


def clean_text(c: Column) -> Column:
    """Drop NUL characters; turn CRLF, LF, CR and tab into one space each.

    Literal byte searches are several times cheaper than a regular expression over long texts.
    """
    c = F.replace(c, F.lit("\x00"), F.lit(""))
    for mark in ("\r\n", "\n", "\r", "\t"):
        c = F.replace(c, F.lit(mark), F.lit(" "))
    return c


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def bool_text(c: Column) -> Column:
    return F.initcap(c.cast("string"))


def iso_text(c: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` without fraction, and without the time where it is midnight."""
    return F.replace(F.substring_index(c.cast("string"), ".", 1), F.lit(" 00:00:00"), F.lit(""))


def safe_number(c: Column, type_name: str = "double") -> Column:
    """A text cell as a number; null unless it is written as one.

    The pattern test comes first: a failed conversion is far dearer than a failed match.
    """
    number = c.rlike(PLAIN_NUMBER_PATTERN) | c.rlike(POWER_NUMBER_PATTERN) | c.rlike(INFINITY_PATTERN)
    return F.when(number, c.try_cast(type_name))


def float_text(name: str) -> Column:
    """A double column as plain digits between 1e-4 and 1e16, otherwise `1.5e-07` / `1e+20`.

    Texts with an exponent are few but take much code, which inlined for many columns makes a
    method too long for the JVM to compile. As a lambda it stays out of the generated code.
    """
    number = f"CAST({quoted(name)} AS DOUBLE)"
    raw = f"CAST({number} AS STRING)"
    power = "try_cast(substring_index(t, 'E', -1) AS INT)"
    return F.expr(rf"""
        CASE WHEN {number} IS NULL OR isnan({number}) THEN IF({number} IS NULL, NULL, '')
             WHEN contains({raw}, 'E') OR contains({raw}, 'y') THEN transform(array({raw}), t ->
                 CASE WHEN contains(t, 'y') THEN IF(contains(t, '-'), '-inf', 'inf')
                      WHEN {power} BETWEEN -4 AND 15
                          THEN regexp_replace(CAST(try_cast(t AS DECIMAL(38, 21)) AS STRING), r'(\.\d+?)0+$', '$1')
                      ELSE concat(regexp_replace(substring_index(t, 'E', 1), r'\.0$', ''),
                                  IF({power} < 0, 'e-', 'e+'), lpad(CAST(abs({power}) AS STRING), 2, '0'))
                 END)[0]
             ELSE {raw} END
    """)


def path_stem(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]+?)(?:\.[^./]+)?$", 1)


def path_extension(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"[^/](\.[^./]+)$", 1))


def table_name(c: Column) -> Column:
    """File path to table identifier: lower-case stem with `-`, `.` and space as underscores."""
    return F.translate(F.lower(path_stem(c)), "-. ", "___")


def size_mb(c: Column) -> Column:
    return F.round(c / F.lit(1048576.0), 2)
