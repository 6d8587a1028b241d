"""Rule checks on raw JSON text, where absent, null and mistyped fields differ.

Each line is parsed once into a VARIANT; types are then read off the parsed
value instead of being forced into a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.operators.validate import (
    Check,
    indicator_check,
    region_check,
    value_check,
    with_outcome,
    year_check,
)
from panelworks.schema import DEMOGRAPHIC_RULES, RuleSet

_PARSED = "_parsed"
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _is(kind: Column, *names: str) -> Column:
    """Type test; DECIMAL(p,s) counts as DECIMAL."""
    return F.substring_index(kind, "(", 1).isin(*names)


def parsed_fields(lines: DataFrame, fields: list[str], text: str = "value") -> DataFrame:
    """Parse each line once and add, per field, the value and its type.

    ``_v_<field>`` is a VARIANT and ``_k_<field>`` its type: STRING, BIGINT,
    DECIMAL(..), DOUBLE, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>, or null if the field
    is absent.  ``_kind`` is OBJECT, VOID or OTHER for the whole line, told by its first
    character, and null if it is not JSON: rendering the line's type would cost as much as
    parsing it.  Blank lines are skipped.  Values and types are columns of their own so that
    the rules read them instead of parsing again.
    """
    kept = lines.where(F.trim(F.col(text)) != "")
    parsed = kept.withColumn(_PARSED, F.try_parse_json(F.col(text)))
    opens = F.substring(F.ltrim(F.col(text), F.lit(" \t\r\n")), 1, 1)
    kind = F.when(opens == "{", "OBJECT").when(opens == "n", "VOID").otherwise("OTHER")
    split = parsed.select(
        *lines.columns,
        F.when(F.col(_PARSED).isNotNull(), kind).alias("_kind"),
        *[F.variant_get(F.col(_PARSED), f"$.{f}", "variant").alias(f"_v_{f}") for f in fields],
    )
    return split.withColumns({f"_k_{f}": F.schema_of_variant(F.col(f"_v_{f}")) for f in fields})


def typed_value(field: str, as_type: str) -> Column:
    return F.try_variant_get(F.col(f"_v_{field}"), "$", as_type)


def kind_is(field: str, *names: str) -> Column:
    return _is(F.col(f"_k_{field}"), *names)


FIELDS = ["region", "year", "indicator", "value"]


def _typed(fields: DataFrame) -> DataFrame:
    """Native columns where the type fits, else null.  Booleans count as 0 and 1."""
    boolean = {f: kind_is(f, "BOOLEAN") for f in ("year", "value")}
    return fields.withColumns(
        {
            "_region": F.when(kind_is("region", "STRING"), typed_value("region", "string")),
            "_indicator": F.when(
                kind_is("indicator", "STRING"), typed_value("indicator", "string")
            ),
            "_year": F.when(kind_is("year", "BIGINT"), typed_value("year", "bigint")).when(
                boolean["year"], typed_value("year", "boolean").cast("bigint")
            ),
            "_value": F.when(kind_is("value", *_NUMBERS), typed_value("value", "double")).when(
                boolean["value"], typed_value("value", "boolean").cast("double")
            ),
        }
    )


def json_checks(rules: RuleSet = DEMOGRAPHIC_RULES) -> dict[str, Check]:
    """Checks per field over the columns of :func:`parsed_fields`."""

    def staged(field: str, wanted: str, check: Check) -> Check:
        return check.after(
            (F.col(f"_k_{field}").isNull(), F.lit(f"{field}: missing")),
            (F.col(f"_{field}").isNull(), F.lit(f"{field}: must be {wanted}")),
        )

    code = F.col("_indicator")
    return {
        "region": staged("region", "string", region_check(F.col("_region"), rules)),
        "year": staged("year", "integer", year_check(F.col("_year"), rules)),
        "indicator": staged("indicator", "string", indicator_check(code, rules)),
        "value": staged("value", "number", value_check(F.col("_value"), code, rules)),
    }


def validate_json(
    lines: DataFrame, rules: RuleSet = DEMOGRAPHIC_RULES, text: str = "value"
) -> DataFrame:
    """Add ``valid`` and ``errors`` to a frame of JSON lines.

    Text that is not a JSON object is kept and rejected as ``record: malformed``.
    """
    whole = F.when(
        ~F.coalesce(F.col("_kind") == "OBJECT", F.lit(False)),
        F.lit("record: malformed"),
    )
    checks = json_checks(rules)
    # a malformed line is one error of its own; its fields are not looked at
    checks = {
        "record": Check(((whole.isNotNull(), whole),)),
        **{name: check.unless(whole.isNotNull()) for name, check in checks.items()},
    }
    return with_outcome(_typed(parsed_fields(lines, FIELDS, text)), checks, lines.columns)
