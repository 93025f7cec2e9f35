"""Row contracts: a list of rules that costs one projection, however many rules there are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.times import is_canonical_utc, parse_time

# Fixed value: integers that survive a round trip through a double.
SAFE_INTEGER = 2**53 - 1


@dataclass(frozen=True)
class Rule:
    """A row is wrong when ``bad`` is true; NULL is not a finding.

    ``messages``, when given, is an array of texts and yields one finding per element instead.
    """

    code: str
    field: str
    bad: Column | None = None
    message: Column | str = ""
    messages: Column | None = None
    severity: str = "error"
    stage: int = 0
    #: Names of the checks that this rule carries out, for a report of what ran.
    checks: tuple[str, ...] = ()

    def when(self, applies: Column) -> Rule:
        """The same rule, silent on rows where ``applies`` is not true."""
        if self.messages is not None:
            return replace(self, messages=F.when(applies, self.messages))
        return replace(self, bad=applies & self.bad)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _name(value: Column | str, field: str | None) -> str:
    return field if field is not None else value if isinstance(value, str) else str(value)


def require(*columns: str, code: str = "schema") -> list[Rule]:
    """Member is absent."""
    return [Rule(code, c, F.col(c).isNull(), f"{c}: required member is absent") for c in columns]


def require_members(raw: Column | str, required: Sequence[str], *, code: str = "schema") -> Rule:
    """Member name is absent from a JSON object; a member whose value is null is present."""
    names = F.json_object_keys(_column(raw))
    missing = F.array_except(F.array(*[F.lit(n) for n in required]), names)
    return Rule(code, _name(raw, "$"), messages=F.transform(missing, lambda n: F.concat(n, F.lit(": required member is absent"))))


def closed_fields(
    raw: Column | str, allowed: Sequence[str], *, exact: bool = False, code: str = "schema"
) -> list[Rule]:
    """Member name outside the closed set; with ``exact`` also a missing one."""
    permitted = F.array(*[F.lit(n) for n in allowed])
    unknown = F.array_except(F.json_object_keys(_column(raw)), permitted)
    message = F.transform(unknown, lambda n: F.concat(n, F.lit(": unknown member")))
    rules = [Rule(code, _name(raw, "$"), messages=message)]
    return [*rules, require_members(raw, allowed, code=code)] if exact else rules


def one_of(column: Column | str, vocabulary: Sequence[object], *, code: str = "schema", field: str | None = None) -> Rule:
    """Value outside a closed vocabulary."""
    name = _name(column, field)
    return Rule(code, name, ~_column(column).isin(list(vocabulary)), f"{name}: value is not in the vocabulary")


def matches(column: Column | str, pattern: str, *, code: str = "schema", field: str | None = None) -> Rule:
    """Text that does not match a pattern."""
    name = _name(column, field)
    return Rule(code, name, ~_column(column).rlike(pattern), f"{name}: text does not match the pattern")


def matches_by(
    column: Column | str, mode: Column | str, patterns: Mapping[str, str], *, code: str = "schema", field: str | None = None
) -> Rule:
    """The pattern depends on a mode; an unknown or absent mode or text is always invalid."""
    value, choice = _column(column), _column(mode)
    ok = F.lit(False)
    for name, pattern in patterns.items():
        ok = ok | ((choice == name) & value.rlike(pattern))
    name = _name(column, field)
    return Rule(code, name, ~F.coalesce(ok, F.lit(False)), f"{name}: text does not match its mode")


def parses_as_time(column: Column | str, *, canonical: bool = False, code: str = "schema", field: str | None = None) -> Rule:
    """Text that is not a date-time, or not the canonical UTC spelling of one."""
    value, name = _column(column), _name(column, field)
    ok = is_canonical_utc(value) if canonical else parse_time(value).isNotNull()
    kind = "a canonical UTC time" if canonical else "a date-time"
    return Rule(code, name, value.isNotNull() & ~ok, f"{name}: text is not {kind}")


def parses_as(column: Column | str, type_name: str, *, code: str = "schema", field: str | None = None) -> Rule:
    """Text that cannot be cast to a type."""
    value, name = _column(column), _name(column, field)
    bad = value.isNotNull() & value.try_cast(type_name).isNull()
    return Rule(code, name, bad, f"{name}: text is not of type {type_name}")


def array_shape(
    column: Column | str, *, at_least: int | None = None, at_most: int | None = None, unique: bool = False,
    code: str = "schema", field: str | None = None,
) -> list[Rule]:
    """Too few items, too many items, or a repeated item in a set-like array."""
    value, name = _column(column), _name(column, field)
    rules = []
    if at_least is not None:
        rules.append(Rule(code, name, F.size(value) < at_least, f"{name}: fewer than {at_least} items"))
    if at_most is not None:
        rules.append(Rule(code, name, F.size(value) > at_most, f"{name}: more than {at_most} items"))
    if unique:
        repeated = F.size(F.array_distinct(value)) < F.size(value)
        rules.append(Rule(code, name, value.isNotNull() & repeated, f"{name}: items are not unique"))
    return [replace(rule, bad=value.isNotNull() & rule.bad) for rule in rules]


def in_range(
    column: Column | str, low: object = None, high: object = None, *, code: str = "schema", field: str | None = None
) -> Rule:
    """Number outside inclusive bounds."""
    value, name = _column(column), _name(column, field)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return Rule(code, name, bad, f"{name}: value is out of range")


def text_length(column: Column | str, low: int | None = None, high: int | None = None, **names: str) -> Rule:
    """Text shorter or longer than its bounds, in characters."""
    return in_range(F.char_length(_column(column)), low, high, field=_name(column, names.pop("field", None)), **names)


def safe_integer(column: Column | str, *, code: str = "schema", field: str | None = None) -> Rule:
    """Integer a double cannot hold exactly."""
    return in_range(column, -SAFE_INTEGER, SAFE_INTEGER, code=code, field=field)


def finite(column: Column | str, *, code: str = "schema", field: str | None = None) -> Rule:
    """NaN, an infinity, or negative zero."""
    value, name = _column(column).cast("double"), _name(column, field)
    negative_zero = (value == 0.0) & value.cast("string").startswith("-")
    bad = F.isnan(value) | (F.abs(value) == float("inf")) | negative_zero
    return Rule(code, name, value.isNotNull() & bad, f"{name}: number is not finite")


def implies(
    if_: Column, then: Column | None = None, otherwise: Column | None = None, *, code: str, field: str, message: str
) -> Rule:
    """Conditional rule. A NULL condition is false; a NULL consequence is a violation."""
    condition = F.coalesce(if_, F.lit(False))
    bad = F.lit(False)
    if then is not None:
        bad = bad | (condition & ~F.coalesce(then, F.lit(False)))
    if otherwise is not None:
        bad = bad | (~condition & ~F.coalesce(otherwise, F.lit(False)))
    return Rule(code, field, bad, message)


def ordered(*columns: Column | str, strict: bool = False, code: str = "time-order", fields: Sequence[str] = ()) -> list[Rule]:
    """Each value is not before the one ahead of it. A NULL side silences its pair."""
    names = list(fields) or [_name(c, None) for c in columns]
    rules = []
    for (first, a), (second, b) in zip(zip(columns, names), zip(columns[1:], names[1:])):
        earlier, later = _column(first), _column(second)
        bad = later <= earlier if strict else later < earlier
        rules.append(Rule(code, b, bad, f"{b} must {'be after' if strict else 'not be before'} {a}"))
    return rules


def within(value: Column | str, bound: Column | str, *, code: str, field: str | None = None, bound_name: str | None = None) -> Rule:
    """A counter above its bound; silent when either side is NULL."""
    name = _name(value, field)
    return Rule(code, name, _column(value) > _column(bound), f"{name} must not exceed {_name(bound, bound_name)}")


def parameter_ranges(
    parameters: Column | str, *, kind: str = "integer-range", code: str = "parameter-range", field: str | None = None
) -> Rule:
    """Nested (name, kind, minimum, maximum) structs of one kind whose maximum is below the minimum."""
    wrong = F.filter(_column(parameters), lambda p: (p["kind"] == kind) & (p["maximum"] < p["minimum"]))
    message = F.transform(wrong, lambda p: F.concat(F.lit("parameter "), p["name"], F.lit(": maximum is below minimum")))
    return Rule(code, _name(parameters, field), messages=message)


def unique_names(items: Column | str, *, code: str = "duplicate-parameter", field: str | None = None) -> Rule:
    """Nested structs that share a name."""
    names = F.array_compact(F.transform(_column(items), lambda p: p["name"]))
    name = _name(items, field)
    return Rule(code, name, F.size(F.array_distinct(names)) < F.size(names), f"{name}: names must be unique")


def any_element(items: Column | str, predicate, *, when: Column, code: str, field: str | None = None) -> Rule:
    """At least one nested element must qualify on rows where ``when`` is true."""
    name = _name(items, field)
    qualifies = F.coalesce(F.exists(_column(items), predicate), F.lit(False))
    return Rule(code, name, F.coalesce(when, F.lit(False)) & _column(items).isNotNull() & ~qualifies, f"{name}: no element qualifies")


def all_elements(items: Column | str, predicate, *, when: Column | None = None, code: str, field: str | None = None) -> Rule:
    """Every nested element must qualify."""
    name = _name(items, field)
    applies = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    bad = applies & ~F.coalesce(F.forall(_column(items), predicate), F.lit(True))
    return Rule(code, name, bad, f"{name}: an element does not qualify")


def check(df: DataFrame, rules: Sequence[Rule], *, path: Column, key: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Findings of all rules over all rows: one scan, one projection, one generator."""
    return _explode(df, [_candidates(rule) for rule in rules], path, key, keep)


def check_by_type(
    df: DataFrame, record_type: Column, contracts: Mapping[str, Sequence[Rule]], *, path: Column, key: Column,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Each row is checked by the contract of its type, in one pass over mixed records.

    A type without a contract is one ``unknown-record-type`` finding and skips every other rule.
    """
    known = F.coalesce(record_type.isin(list(contracts)), F.lit(False))
    stray = Rule(
        "unknown-record-type", "record_type", ~known,
        F.concat(F.lit("unsupported record_type: "), F.coalesce(record_type, F.lit("null"))),
    )
    arrays = [_candidates(stray)]
    for name, rules in contracts.items():
        arrays += [_candidates(rule.when(record_type == name)) for rule in rules]
    return _explode(df, arrays, path, key, keep)


def expected_checks(
    common: Sequence[str], by_interface: Mapping[str, Sequence[str]], by_mode: Mapping[str, Sequence[str]],
    interface: Column, mode: Column,
) -> Column:
    """The exact set of checks a run context must report, sorted; empty for an unknown context."""
    empty = F.array().cast("array<string>")

    def choose(column: Column, options: Mapping[str, Sequence[str]]) -> Column:
        chosen = F.lit(None).cast("array<string>")
        for name, checks in options.items():
            values = F.array(*[F.lit(c) for c in checks]) if checks else empty
            chosen = F.when(column == name, values).otherwise(chosen)
        return chosen

    total = F.concat(F.array(*[F.lit(c) for c in common]), choose(interface, by_interface), choose(mode, by_mode))
    return F.coalesce(F.array_sort(F.array_distinct(total)), empty)


def reported_checks(actual: Column | str, expected: Column, *, code: str = "sanitization-checks") -> Rule:
    """The reported list must be the expected one; an empty expectation is itself a failure."""
    bad = (F.size(expected) == 0) | ~_column(actual).eqNullSafe(expected)
    return Rule(code, _name(actual, None), bad, "executed checks do not match the run context")


def _candidates(rule: Rule) -> Column:
    def finding(message: Column) -> Column:
        return F.struct(
            F.lit(rule.severity).alias("severity"), F.lit(rule.code).alias("code"),
            F.lit(rule.field).alias("field"), message.alias("message"), F.lit(rule.stage).alias("stage"),
        )

    if rule.messages is not None:
        return F.coalesce(F.transform(rule.messages, finding), F.array().cast(_ARRAY))
    message = F.lit(rule.message) if isinstance(rule.message, str) else rule.message
    return F.when(rule.bad, F.array(finding(message))).otherwise(F.array().cast(_ARRAY))


_ARRAY = "array<struct<severity:string,code:string,field:string,message:string,stage:int>>"


def _explode(df: DataFrame, arrays: list[Column], path: Column, key: Column, keep: Sequence[str]) -> DataFrame:
    # The generator takes the expression itself: over a named column Spark would also infer a filter
    # on it, push that below, and evaluate every rule twice.
    rows = df.select(
        path.cast("string").alias("path"), key.cast("string").alias("key"), *keep, F.explode(F.concat(*arrays)).alias("__f")
    )
    names = ("severity", "code", "field", "stage", "message")
    flat = rows.select("path", "key", *keep, *[F.col("__f")[n].alias(n) for n in names])
    return flat.select("severity", "code", "path", "message", "key", *keep, "field", "stage")
