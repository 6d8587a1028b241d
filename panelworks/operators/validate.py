"""Rule checks on typed frames.  Every rule is a column expression.

``validate`` adds ``valid`` and ``errors``; nothing is shuffled and no row
leaves the JVM, so the cost is one projection over the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions import error_category, is_blank, is_finite, plain_number
from panelworks.schema import DEMOGRAPHIC_RULES, PanelSpec, RuleSet


@dataclass(frozen=True)
class Check:
    """Ordered (failed, text) pairs of one field; the first failure is reported.

    Flags and texts are kept apart: whether a row is valid is decided on the
    flags alone, and texts are built only for rows that fail.
    """

    steps: tuple[tuple[Column, Column], ...]

    @property
    def failed(self) -> Column:
        return reduce(lambda a, b: a | b, [f for f, _ in self.steps])

    @property
    def text(self) -> Column:
        (failed, text), *more = self.steps
        return reduce(lambda case, step: case.when(*step), more, F.when(failed, text))

    def after(self, *steps: tuple[Column, Column]) -> Check:
        """The same check with ``steps`` looked at first."""
        return Check((*steps, *self.steps))

    def unless(self, skipped: Column) -> Check:
        """The same check, passed where ``skipped`` is true."""
        return self.after((skipped, F.lit(None).cast("string")))


def _quoted_list(items: tuple[str, ...]) -> str:
    return "[" + ", ".join(f'"{i}"' for i in items) + "]"


def _text(prefix: str, middle: Column, suffix: str) -> Column:
    return F.concat(F.lit(prefix), middle, F.lit(suffix))


def _flag(x: Column) -> Column:
    """Null means not failed."""
    return F.coalesce(x, F.lit(False))


def region_check(name: Column, rules: RuleSet) -> Check:
    low, high = rules.name_length
    length = F.length(name)
    shown = _text("region: length ", length.cast("string"), f" not in [{low}, {high}]")
    return Check(
        (
            (_flag(is_blank(name)), F.lit("region: must be non-empty")),
            (_flag(~length.between(low, high)), shown),
        )
    )


def year_check(year: Column, rules: RuleSet) -> Check:
    low, high = rules.year_range
    shown = _text("year: ", year.cast("string"), f" not in [{low}, {high}]")
    return Check(((_flag(~year.between(low, high)), shown),))


def indicator_check(code: Column, rules: RuleSet) -> Check:
    shown = _text("indicator: '", code, f"' not in {_quoted_list(rules.indicators)}")
    return Check(
        (
            (_flag(code == ""), F.lit("indicator: must be non-empty")),
            (_flag(~code.isin(*rules.indicators)), shown),
        )
    )


def value_check(value: Column, code: Column, rules: RuleSet) -> Check:
    """Not finite, or outside the range of a known indicator."""
    steps = [(_flag(~is_finite(value)), F.lit("value: must be finite number (not NaN/Inf)"))]
    for name, limit in rules.ranges.items():
        shown = _text("value: ", plain_number(value), f" not in {limit.text} for {name}")
        steps.append((_flag((code == name) & ~value.between(limit.low, limit.high)), shown))
    return Check(tuple(steps))


def _typed_check(df: DataFrame, column: str, field: str, kinds: tuple, kind: str, check) -> Check:
    """Missing column, wrong column type or null first, then the field's own rule."""
    if column not in df.columns:
        return Check(((F.lit(True), F.lit(f"{field}: missing")),))
    mistyped = F.lit(f"{field}: must be {kind}")
    if not isinstance(df.schema[column].dataType, kinds):
        return Check(((F.lit(True), mistyped),))
    return check(F.col(column)).after((F.col(column).isNull(), mistyped))


_TEXT = (T.StringType,)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def field_checks(
    df: DataFrame, rules: RuleSet = DEMOGRAPHIC_RULES, spec: PanelSpec = PanelSpec()
) -> dict[str, Check]:
    """Checks per field, in report order.

    A null counts as a wrong type: a record of a table always has the field.
    """
    known = spec.indicator in df.columns and isinstance(
        df.schema[spec.indicator].dataType, T.StringType
    )
    code = F.col(spec.indicator) if known else F.lit(None).cast("string")
    return {
        "region": _typed_check(
            df, spec.entity, "region", _TEXT, "string", lambda x: region_check(x, rules)
        ),
        "year": _typed_check(
            df, spec.year, "year", _WHOLE, "integer", lambda x: year_check(x, rules)
        ),
        "indicator": _typed_check(
            df, spec.indicator, "indicator", _TEXT, "string", lambda x: indicator_check(x, rules)
        ),
        "value": _typed_check(
            df,
            spec.value,
            "value",
            _NUMBER,
            "number",
            lambda x: value_check(x.cast("double"), code, rules),
        ),
    }


def is_valid(checks: dict[str, Check]) -> Column:
    return ~reduce(lambda a, b: a | b, [c.failed for c in checks.values()])


def with_outcome(df: DataFrame, checks: dict[str, Check], columns: list[str]) -> DataFrame:
    """``columns`` plus ``valid`` and ``errors`` (texts of all failed fields, in order).

    Each field's text gets a column first, so that every rule is evaluated once;
    the list is only assembled for rows that fail.
    """
    texts = {f"_error_{name}": check.text for name, check in checks.items()}
    none = F.array().cast("array<string>")
    found = [F.when(F.col(t).isNotNull(), F.array(t)).otherwise(none) for t in texts]
    valid = reduce(lambda a, b: a & b, [F.col(t).isNull() for t in texts])
    return df.withColumns(texts).select(
        *columns,
        valid.alias("valid"),
        F.when(valid, none).otherwise(F.concat(*found)).alias("errors"),
    )


def validate(
    df: DataFrame, rules: RuleSet = DEMOGRAPHIC_RULES, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Add ``valid`` and ``errors``; rows, their number and their order are kept."""
    return with_outcome(df, field_checks(df, rules, spec), df.columns)


def valid_rows(
    df: DataFrame, rules: RuleSet = DEMOGRAPHIC_RULES, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Rows without errors, with the input's columns (also when none is left)."""
    return df.where(is_valid(field_checks(df, rules, spec)))


def rejected_rows(
    df: DataFrame, rules: RuleSet = DEMOGRAPHIC_RULES, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """(record struct, errors) for each row with errors."""
    checked = validate(df, rules, spec).where(~F.col("valid"))
    return checked.select(F.struct(*[F.col(c) for c in df.columns]).alias("record"), "errors")


def error_categories(checked: DataFrame, top: int = 5) -> DataFrame:
    """Most frequent error categories of a validated (or rejected) frame."""
    # the outer form, because the plain one adds a filter that evaluates all rules twice
    return (
        checked.select(F.explode_outer("errors").alias("error"))
        .where(F.col("error").isNotNull())
        .groupBy(error_category(F.col("error")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "category")
        .limit(top)
    )
