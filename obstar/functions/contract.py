"""Expressions that check and coerce one JSON record against a field contract.

The text is read twice: as a VARIANT, which says whether it is JSON at all and
keeps every value as it was written, and as a struct of the contract's types,
which holds the values that need no conversion. A record with nothing but such
values is taken as it is; any other is looked into field by field.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from obstar.functions.measures import clamp, clamp_int, decimal_range
from obstar.schemas import Field

ERRORS = "errors"
_END = "end of record"
_ERRORS_TYPE = "array<struct<field:string,reason:string>>"


def record_type(contract: Sequence[Field]) -> str:
    """The nested struct type that holds every field of the contract."""
    tree: dict = {}
    for f in contract:
        *parents, leaf = _parts(f)
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = f.kind

    def ddl(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"{name}:{ddl(child)}" for name, child in node.items()) + ">"

    return ddl(tree)


def _parts(field: Field) -> list[str]:
    return field.path.removeprefix("$.").split(".")


def read_document(text: str) -> Column:
    """The text as the first element of an array that is closed by a mark.

    The JSON parser stops after the first value; only if the mark is found in
    second and last place was the text one value with nothing after it.
    """
    return F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{_END}"]')))


def read_plain(text: str, contract: Sequence[Field]) -> Column:
    """The record with each value that is written in its own type, else NULL."""
    return F.from_json(text, record_type(contract))


# The rules are written as SQL text: one expression of some hundred parts is parsed
# in one go, where building it from column objects would take seconds per plan.


def _is_complete(document: str) -> str:
    """True if the document held exactly one JSON value."""
    mark = f"try_variant_get({document}, '$[1]', 'string') = '{_END}'"
    return f"coalesce({mark} AND try_variant_get({document}, '$[2]', 'variant') IS NULL, false)"


def _get(document: str, field: Field, as_type: str) -> str:
    return f"try_variant_get({document}, '$[0]{field.path.removeprefix('$')}', '{as_type}')"


def _plain(record: str, field: Field) -> str:
    return record + field.path.removeprefix("$")


def _looks_nested(text: str) -> str:
    return f"(startswith({text}, '{{') OR startswith({text}, '['))"


def _value(document: str, record: str, field: Field) -> str:
    """The field coerced to its contract type; NULL if absent or not coercible.

    A text field takes scalars only: an object or array is not its own JSON text.
    """
    coerced = f"coalesce({_plain(record, field)}, {_get(document, field, field.kind)})"
    if field.kind != "string":
        return coerced
    nested = f"schema_of_variant({_get(document, field, 'variant')}) RLIKE '^(OBJECT|ARRAY)'"
    return f"CASE WHEN {_looks_nested(coerced)} AND {nested} THEN NULL ELSE {coerced} END"


def _unusable(got: str, field: Field, on_overflow: str) -> list[tuple[str, str]]:
    """Conditions under which a value of the right type cannot be staged."""
    rules = []
    if field.kind == "double":
        rules.append((f"(isnan({got}) OR abs({got}) = double('infinity'))", "not_finite"))
    if on_overflow == "reject":
        if field.sql_type.startswith("decimal"):
            rules.append((f"abs({got}) >= double('{decimal_range(field.sql_type)[1]}')", "out_of_range"))
        if field.max_length:
            rules.append((f"char_length({got}) > {field.max_length}", "too_long"))
    return rules


def _reason(document: str, got: str, field: Field, on_overflow: str) -> str:
    """Why the field is unacceptable, or NULL."""
    node = _get(document, field, "variant")
    absent = f"{got} IS NULL AND ({node} IS NULL OR is_variant_null({node}))"
    rules = [(absent, "missing"), (f"{got} IS NULL", "uncoercible"), *_unusable(got, field, on_overflow)]
    return "CASE " + " ".join(f"WHEN {rule} THEN '{reason}'" for rule, reason in rules) + " END"


def _needs_no_care(record: str, field: Field, on_overflow: str) -> str:
    got = _plain(record, field)
    rules = [f"{got} IS NOT NULL", *[f"NOT {rule}" for rule, _ in _unusable(got, field, on_overflow)]]
    if field.kind == "string":
        rules.append(f"NOT {_looks_nested(got)}")
    return " AND ".join(rules)


def _struct(columns: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in columns.items()) + ")"


def judged(document: str, plain: str, contract: Sequence[Field], on_overflow: str) -> Column:
    """STRUCT of the coerced fields and `errors`, an ARRAY<STRUCT<field, reason>>
    that is empty for an acceptable record."""
    none = f"cast(array() AS {_ERRORS_TYPE})"
    clean = " AND ".join(
        [_is_complete(document), *[_needs_no_care(plain, f, on_overflow) for f in contract]]
    )
    as_it_is = _struct({f.name: _plain(plain, f) for f in contract} | {ERRORS: none})

    # lambdas: evaluated for the records that need it, and kept out of generated code
    one = f"array({_struct({'doc': document, 'record': plain})})"
    values = {f.name: _value("x.doc", "x.record", f) for f in contract}
    coerced = f"transform({one}, x -> {_struct({'doc': 'x.doc'} | values)})"
    reasons = [
        _struct({"field": f"'{f.name}'", "reason": _reason("y.doc", f"y.{f.name}", f, on_overflow)})
        for f in contract
    ]
    wrong = f"filter(array({', '.join(reasons)}), e -> e.reason IS NOT NULL)"
    malformed = "array(named_struct('field', '$', 'reason', 'malformed'))"
    errors = f"CASE WHEN {_is_complete('y.doc')} THEN {wrong} ELSE {malformed} END"
    fields = {f.name: f"y.{f.name}" for f in contract}
    with_care = f"transform({coerced}, y -> {_struct(fields | {ERRORS: errors})})[0]"
    return F.expr(f"CASE WHEN {clean} THEN {as_it_is} ELSE {with_care} END")


def widened(contract: Sequence[Field]) -> list[Field]:
    """The contract with whole numbers read as BIGINT, to be clamped when staged."""
    return [replace(f, kind="bigint") if f.kind == "int" else f for f in contract]


def staged(field: Field, on_overflow: str = "reject") -> Column:
    """The parsed field under its staging name and type."""
    col = F.col(field.name)
    if on_overflow == "clamp":
        if field.max_length:
            col = F.left(col, F.lit(field.max_length))
        if field.sql_type.startswith("decimal"):
            col = clamp(col, field.sql_type)
        if field.kind == "int":
            col = clamp_int(col)
    return col.cast(field.sql_type).alias(field.column)
