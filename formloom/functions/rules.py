"""Validation rules as a table, and Columns made from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from formloom.functions.text import let, matches, strip


@dataclass(frozen=True)
class Rule:
    pattern: str | None = None
    required: bool = False
    kind: str = "string"
    least: float | None = None
    most: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed: tuple[str, ...] = ()
    example: str = ""


# The rules in the order in which types are inferred.
RULES = {
    "act_number": Rule(r"^\d+/\d+$", required=True, example="001/2025"),
    "date": Rule(r"^\d{1,2}\.\d{1,2}\.\d{4}$", required=True, example="15.10.2025"),
    "revision": Rule(r"^\d{2}$", example="01"),
    "quantity": Rule(r"^\d+$", kind="integer", least=0, example="10"),
    "measurement": Rule(r"^\d+\.?\d*$", kind="float", example="100.05"),
    "measurement_with_tolerance": Rule(r"^\d+\.?\d*[±]\d+\.?\d*$", example="100±0.1"),
    "status": Rule(allowed=("годен", "брак", "доработать", "утилизировать"), example="годен"),
    "defect_code": Rule(r"^[А-ЯA-Z]\d{3,}$", example="Д001"),
    "inspector": Rule(r"^[А-Яа-я\s]+\s+[А-Я]\.[А-Я]\.$", example="Иванов И.И."),
    "text": Rule(min_length=1, example="Описание дефекта"),
}

# Thresholds of confidence.
CONFIDENCE = {"high": 0.9, "medium": 0.7, "low": 0.5, "critical": 0.3}
REQUIRED = ("act_number", "date")


def infer_type(text: Column) -> Column:
    """The first rule whose pattern the stripped text has; ``text`` if none."""
    return _type(strip(text))


def _type(plain: Column) -> Column:
    out = F.lit("text")
    for name, rule in reversed(RULES.items()):
        if rule.pattern:
            out = F.when(matches(plain, rule.pattern), name).otherwise(out)
    return out


def of_filled(text: Column, body: Callable[[Column], Column]) -> Column:
    """body of the type of a text; null for null and blank texts. The text is stripped once and its type found once, however often body names it."""
    kind = lambda plain: F.when(F.coalesce(plain, F.lit("")) != "", _type(plain))
    return let(strip(text), lambda plain: let(kind(plain), lambda k: F.when(k.isNotNull(), body(k))))


def _message(value: Column, rule: Rule) -> Column:
    plain = strip(value)
    empty = value.isNull() | (value == "")
    out = F.when(empty, F.lit("Required field is missing") if rule.required else F.lit(None).cast("string"))
    if rule.allowed:
        out = out.when(~F.lower(plain).isin(*rule.allowed), f"Value must be one of: {', '.join(rule.allowed)}")
    if rule.pattern:
        out = out.when(~matches(plain, rule.pattern), f"Value does not match expected pattern. Example: {rule.example}")
    if rule.min_length:
        out = out.when(F.char_length(plain) < rule.min_length, f"Value too short (min length: {rule.min_length})")
    if rule.max_length:
        out = out.when(F.char_length(plain) > rule.max_length, f"Value too long (max length: {rule.max_length})")
    if rule.kind in ("integer", "float"):
        number = plain.try_cast("decimal(38,0)" if rule.kind == "integer" else "double")
        out = out.when(number.isNull(), "Value must be an integer" if rule.kind == "integer" else "Value must be a number")
        if rule.least is not None:
            out = out.when(number < rule.least, f"Value below minimum ({rule.least})")
        if rule.most is not None:
            out = out.when(number > rule.most, f"Value above maximum ({rule.most})")
    return out.otherwise(F.lit(None).cast("string"))


def violation(value: Column, field_type: Column) -> Column:
    """What is wrong with a value of a type, or null; types without a rule have nothing to violate."""
    out = F.lit(None).cast("string")
    for name, rule in RULES.items():
        out = F.when(field_type == name, _message(value, rule)).otherwise(out)
    return out


def confidence_check(confidence: Column, importance: str = "normal") -> Column:
    """(acceptable, message) by the importance of a field: critical, high, or any other."""
    level, label = {"critical": ("medium", "critical field"), "high": ("low", "important field")}.get(importance, ("critical", "field"))
    least, advised = CONFIDENCE[level], CONFIDENCE["low"]
    low = F.format_string(f"Low confidence for {label}: %.2f (threshold: {least:.2f})", confidence)
    below = F.format_string(f"Below recommended confidence for {label}: %.2f", confidence)
    return F.struct((confidence >= least).alias("acceptable"), F.when(confidence < least, low).when(confidence < advised, below).otherwise("").alias("message"))
