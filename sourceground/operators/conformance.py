"""Schema documents compiled to column checks.

``violations`` walks a schema document (type, required, properties, items, enum, const) and a
column's type side by side and returns one expression that lists what a row breaks, at any
depth: ``missing:path``, ``type:path:found``, ``enum:path:value`` and ``constant:path``. Typed columns
are checked by their type; a VARIANT, such as a parsed JSON line, by what each row holds.
Elements of arrays have their place in the path (``options[1]``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegralType, NumericType, StringType, StructType, VariantType

from ..functions.documents import CORPUS_RECORD, ITEM
from ..functions.text import let

NONE = "array<string>"
#: JSON names of the kinds that ``schema_of_variant`` tells apart.
KINDS = {"STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "ARRAY": "array", "OBJECT": "object", "VOID": "null"}


def _kind(value: Column, type_: DataType) -> Column:
    if isinstance(type_, VariantType):
        name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), name), F.lower(name))
    for of, name in ((StringType, "string"), (BooleanType, "boolean"), (IntegralType, "integer"), (NumericType, "number"), (ArrayType, "array"), (StructType, "object")):
        if isinstance(type_, of):
            return F.lit(name)
    return F.lit(type_.simpleString())


def _child(value: Column, type_: DataType, name: str) -> tuple[Column, DataType] | None:
    if isinstance(type_, VariantType):
        return F.try_variant_get(value, f"$['{name}']", "variant"), type_
    if isinstance(type_, StructType) and name in type_.names:
        return value[name], type_[name].dataType
    return None


def _text(value: Column, type_: DataType) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)) if isinstance(type_, VariantType) else value.cast("string")


def _found(*checks: Column) -> Column:
    return F.array_compact(F.array(*checks)) if checks else F.array().cast(NONE)


def _node(schema: dict, value: Column, type_: DataType, path: Column) -> Column:
    """Violations at and below a value that is there."""
    kind = _kind(value, type_)
    return let(kind, lambda k: _checks(schema, value, type_, path, k)) if isinstance(type_, VariantType) else _checks(schema, value, type_, path, kind)


def _checks(schema: dict, value: Column, type_: DataType, path: Column, kind: Column) -> Column:
    named = lambda code: F.concat(F.lit(f"{code}:"), path)
    checks = []
    if (types := schema.get("type")) is not None:
        allowed = [types] if isinstance(types, str) else list(types)
        allowed += ["integer"] if "number" in allowed else []
        checks.append(F.when(~kind.isin(*allowed), F.concat(named("type"), F.lit(":"), kind)))
    if "enum" in schema:
        checks.append(F.when(~F.coalesce(_text(value, type_).isin(*schema["enum"]), F.lit(False)), F.concat(named("enum"), F.lit(":"), _text(value, type_))))
    if "const" in schema:
        checks.append(F.when(F.coalesce(_text(value, type_) != schema["const"], F.lit(True)), named("constant")))
    below = [_found(*checks)]
    for name, own in schema.get("properties", {}).items():
        at = F.concat(path, F.lit(f".{name}"))
        below.append(_field(own, _child(value, type_, name), at, name in schema.get("required", ()), F.coalesce(kind == "object", F.lit(False))))
    if "items" in schema:
        items = F.try_variant_get(value, "$", "array<variant>") if isinstance(type_, VariantType) else value
        inner = type_ if isinstance(type_, VariantType) else type_.elementType if isinstance(type_, ArrayType) else None
        if inner is not None:
            of = lambda x, i: _field(schema["items"], (x, inner), F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), False, F.lit(True))
            below.append(F.coalesce(F.flatten(F.transform(items, of)), F.array().cast(NONE)))
    return F.concat(*below)


def _field(schema: dict, child: tuple[Column, DataType] | None, path: Column, required: bool, inside: Column) -> Column:
    """Violations of one field; ``inside`` tells whether its parent is an object at all."""
    nullable = "type" not in schema and not required or "null" in schema.get("type", ())
    missing = F.when(inside, F.array(F.concat(F.lit("missing:"), path))).otherwise(F.array().cast(NONE)) if required and not nullable else F.array().cast(NONE)
    if child is None:
        return missing
    value, type_ = child
    if not isinstance(type_, VariantType):
        return F.when(value.isNull(), missing).otherwise(_node(schema, value, type_, path))
    null = missing if required or nullable else F.array(F.concat(F.lit("type:"), path, F.lit(":null")))
    return let(value, lambda v: F.when(v.isNull(), missing).when(F.is_variant_null(v), null).otherwise(_node(schema, v, type_, path)))  # read off its parent once


def violations(schema: dict, type_: StructType) -> Column:
    """What the row of a table of this type breaks of ``schema``, by the order of the schema's fields."""
    fields = [_field(own, (F.col(f"`{n}`"), type_[n].dataType) if n in type_.names else None, F.lit(n), n in schema.get("required", ()), F.lit(True)) for n, own in schema["properties"].items()]
    return F.concat(*fields)


def document_violations(schema: dict, document: Column) -> Column:
    """What a VARIANT document breaks of ``schema``; one that is no object is named ``$``."""
    found = let(document, lambda d: F.when(d.isNull(), F.array(F.lit("missing:$"))).otherwise(_node(schema, d, VariantType(), F.lit("$"))))
    return F.transform(found, lambda v: F.regexp_replace(v, r":\$\.", ":"))


def corpus_violations(corpus: DataFrame) -> DataFrame:
    """(passage_id, violations) of records that break their schema."""
    return corpus.select("passage_id", violations(CORPUS_RECORD, corpus.schema).alias("violations")).where(F.size("violations") > 0)


def item_violations(items: DataFrame) -> DataFrame:
    """(item_id, violations) of items that break their schema; the answer is whichever of its three columns is there."""
    answered = F.coalesce(F.when(F.col("answer_text").isNotNull(), F.lit("text")), F.when(F.col("answer_formula").isNotNull(), F.lit("formula")), F.when(F.trim("answer_json") != "null", F.lit("json")))
    items = items.withColumn("answer", answered)
    return items.select("item_id", violations(ITEM, items.schema).alias("violations")).where(F.size("violations") > 0)
