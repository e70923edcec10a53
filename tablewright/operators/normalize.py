"""Normalize a table: one profiling aggregate decides the rules, one lazy projection applies them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import dates, names
from tablewright.functions import text as tx
from tablewright.operators import profile as pf


class Normalized(NamedTuple):
    data: DataFrame
    columns: list[str]
    rows: int | None  # known when the profile had to read the table

    @property
    def is_empty(self) -> bool:
        return not self.columns or (self.data.isEmpty() if self.rows is None else self.rows == 0)

    def report(self, table: str) -> DataFrame:
        """`(table, rows, cols, columns)`; the rows are counted when the report is read."""
        spark = self.data.sparkSession
        fixed = [
            F.lit(table).alias("table"),
            F.lit(len(self.columns)).alias("cols"),
            F.array(*[F.lit(c) for c in self.columns]).cast("array<string>").alias("columns"),
        ]
        if self.rows is None:
            counted = self.data.agg(F.count(F.lit(1)).alias("rows"))
        else:
            counted = spark.range(1).select(F.lit(self.rows).cast("bigint").alias("rows"))
        return counted.select(fixed[0], "rows", *fixed[1:])


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType))


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, pf.INTEGRAL + pf.FRACTIONAL)


def _needs_fraction_test(field: T.StructField) -> bool:
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale > 0 or kind.precision > 18
    return isinstance(kind, pf.FRACTIONAL)


def _typed_text(c: Column, marks: int | None) -> Column:
    """A text column in the type all its cells fit. No cell fails to convert."""
    kind = pf.text_kind(marks)
    if kind == pf.INTEGER:
        return c.try_cast("bigint") if not marks & pf.ROUND else c.try_cast("double").try_cast("bigint")
    if kind == pf.WIDE_INTEGER:
        return c.try_cast("decimal(20,0)")
    if kind in (pf.DOUBLE, pf.EMPTY):
        return c.try_cast("double")
    return c.try_cast("boolean") if kind == pf.BOOLEAN else c


def infer_types(df: DataFrame, keep_text: Iterable[str] = ()) -> DataFrame:
    """Type the text columns of a delimited file by all their values: bigint, double, boolean or text."""
    kept = set(keep_text)
    names_ = [f"c{i}" for i in range(len(df.columns))]
    cells, beginning = df.toDF(*names_), (pf.first_file(df) or df).toDF(*names_)
    texts = [c for c, f, n in zip(names_, df.schema.fields, df.columns) if _is_text(f) and n not in kept]
    marks, wanted = _text_marks(beginning, texts)
    _, facts = pf.gather(cells, wanted)
    marks |= {c: f["marks"] for c, f in facts.items()}
    return cells.select(*[
        (_typed_text(F.col(c), marks[c]) if c in marks else F.col(c)).alias(n) for c, n in zip(names_, df.columns)
    ])


def _text_marks(beginning: DataFrame, columns: list[str]) -> tuple[dict, dict[str, dict[str, Column]]]:
    """Marks of the columns the beginning shows to be text, and what the rest must be asked."""
    early = pf.early_marks(beginning, columns)
    settled = {c: m for c, m in early.items() if pf.is_surely_text(m)}
    open_ = {c: {"marks": pf.column_marks(c, early[c])} for c in columns if c not in settled}
    return settled, open_


def _without_nan(c: Column, data_type: T.DataType) -> Column:
    return F.nanvl(c, F.lit(None).cast("double")) if isinstance(data_type, (T.FloatType, T.DoubleType)) else c


def _whole(c: Column, target: str = "bigint") -> Column:
    return F.coalesce(c.try_cast(target), F.lit(0).cast(target))


def _double(c: Column) -> Column:
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def _text(c: Column) -> Column:
    return tx.empty_to_null(tx.clean_text(c))


def _date(c: Column, layout: dates.Layout | None, facts: dict) -> Column:
    if layout and layout.has_offset and facts["low_offset"] != facts["high_offset"]:
        return _text(c)  # several offsets: no common reading
    return dates.date_text(c, layout)


def _number(c: Column, fraction: bool, compat_date: bool) -> Column:
    if compat_date:
        return dates.epoch_date_text(c)
    return _double(c) if fraction else _whole(c)


def normalize(
    df: DataFrame,
    order_by: Iterable[str | Column] | None = None,
    untyped: bool = False,
    keep_text: Iterable[str] = (),
    drop_empty: bool = False,
    compat: bool = False,
) -> Normalized:
    """Clean names, types, dates, text and missing values.

    order_by    what "first value" means for unnamed and date columns; file order if not given
    untyped     text columns come from a delimited file: infer their types as well
    keep_text   source columns that stay text whatever they hold (leading zeros survive)
    drop_empty  drop all-null rows, then all-null columns (sheet tables)
    compat      numbers in date-named columns become dates counted in nanoseconds since 1970
    """
    kept = set(keep_text)
    headers = [names.clean_header(n) for n in df.columns]
    source = dict(zip((f"c{i}" for i in range(len(headers))), df.columns))
    header = dict(zip(source, headers))
    field = dict(zip(source, df.schema.fields))
    unnamed = [c for c in source if names.lacks_name(header[c])]
    texts = [c for c in source if _is_text(field[c])]
    inferred = [c for c in texts if untyped and source[c] not in kept]
    dated = [c for c in texts if c in unnamed or names.is_date_name(header[c])]

    def arrange(table: DataFrame) -> DataFrame:
        renamed = table.toDF(*source, *table.columns[len(source):])
        return renamed.na.drop(how="all", subset=list(source)) if drop_empty else renamed

    beginning = pf.first_file(df) if inferred or (order_by is None and (unnamed or dated)) else None
    samples: dict[str, Row] = {}
    first: dict[str, str] = {}
    if unnamed or dated:
        ordered, order = pf.with_order(df, order_by)
        ordered = arrange(ordered)
        head = arrange(pf.with_order(beginning, None)[0]) if beginning and order_by is None else None
        if unnamed:
            samples = pf.column_samples(ordered, head, unnamed, order)
            first = {c: row["first"] for c, row in samples.items()}
        only_dated = [c for c in dated if c not in unnamed]
        if only_dated:
            first |= pf.first_values(ordered, head, only_dated, order)
    layout = {c: dates.guess_layout(first[c]) for c in dated if c in first}

    cells = arrange(df)
    marks, asked = _text_marks(arrange(beginning or df), inferred)
    wanted: dict[str, dict[str, Column]] = {c: {} for c in source}
    for c, facts in wanted.items():
        value = _without_nan(F.col(c), field[c].dataType)
        facts |= asked.get(c, {})
        if drop_empty:
            facts["filled"] = F.count(value)
        if _needs_fraction_test(field[c]):
            facts["fraction"] = F.bool_or(pf.has_fraction(value))
        if layout.get(c) and layout[c].has_offset:
            facts |= pf.offset_facts(value)
        if c in unnamed and (_is_number(field[c]) or c in inferred):
            facts |= pf.amount_facts(tx.safe_number(value) if c in inferred else value)
    rows, known = pf.gather(cells, {c: f for c, f in wanted.items() if f})
    facts = {c: known.get(c, {}) for c in source}
    marks |= {c: facts[c]["marks"] for c in asked}

    columns = [c for c in source if not drop_empty or facts[c]["filled"] > 0]
    kind = {c: pf.text_kind(marks[c]) for c in inferred}
    number_kinds = (pf.INTEGER, pf.WIDE_INTEGER, pf.DOUBLE)
    numbers = {c for c in columns if _is_number(field[c]) or kind.get(c) in number_kinds}

    def label(c: str) -> str:
        if c not in samples:
            return "column"
        other = samples[c]["after"]
        if c in numbers:
            other = "amount" if pf.median_is_amount(facts[c]) else "value"
        return samples[c]["before"] or other

    final = [
        f"{label(c)}_{i}" if c in unnamed else names.identifier(header[c]) for i, c in enumerate(columns, 1)
    ]

    def rule(c: str, name: str) -> Column:
        value, known, data_type = F.col(c), facts[c], field[c].dataType
        is_date = names.is_date_name(name)
        if isinstance(data_type, pf.MOMENTS):
            return tx.empty_to_null(tx.iso_text(value))
        if _is_number(field[c]):
            plain = _without_nan(value, data_type)
            return _number(plain, bool(known.get("fraction")), compat and is_date)
        if isinstance(data_type, T.BooleanType):
            return tx.bool_text(value)
        if not _is_text(field[c]):
            return value
        text_kind = kind.get(c, pf.TEXT)
        if text_kind == pf.BOOLEAN:
            return tx.bool_text(value)
        if text_kind == pf.WIDE_INTEGER:
            return _whole(_typed_text(value, marks[c]), "decimal(20,0)")
        if text_kind in (pf.INTEGER, pf.DOUBLE):
            return _number(_typed_text(value, marks[c]), text_kind == pf.DOUBLE, compat and is_date)
        if is_date:
            return _date(value, layout.get(c), known)
        if text_kind == pf.EMPTY:
            return F.lit(0).cast("bigint")
        return _text(value)

    data = cells.select(*[
        rule(c, name).alias(unique) for c, name, unique in zip(columns, final, names.distinct_names(final))
    ])
    return Normalized(data, data.columns, rows)
