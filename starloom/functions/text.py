"""Text rewriting inside nested values, driven by the column's type or, in variants, the value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def holds_text(kind: T.DataType) -> bool:
    """Whether a value of this type can hold a string (map keys aside)."""
    if isinstance(kind, T.ArrayType):
        return holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return holds_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(holds_text(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType, T.VariantType))


def replace_text(value: Column, kind: T.DataType, keyword: str, replacement: str) -> Column:
    """``value`` with ``keyword`` replaced in every string it holds.

    Map keys and field names stay as they are, and so do subtrees without
    text. A NULL struct stays NULL instead of becoming a struct of NULLs.
    Variants are rewritten as :func:`replace_in_variant` says.
    """
    if not holds_text(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(
            value, lambda item: replace_text(item, kind.elementType, keyword, replacement)
        )
    if isinstance(kind, T.MapType):
        return F.transform_values(
            value, lambda _, item: replace_text(item, kind.valueType, keyword, replacement)
        )
    if isinstance(kind, T.VariantType):
        return replace_in_variant(value, keyword, replacement)
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(
            *[
                replace_text(
                    value.getField(field.name), field.dataType, keyword, replacement
                ).alias(field.name)
                for field in kind.fields
            ]
        )
        return F.when(value.isNotNull(), rebuilt)
    return F.replace(value, F.lit(keyword), F.lit(replacement))


def replace_in_variant(value: Column, keyword: str, replacement: str) -> Column:
    """An untyped tree with ``keyword`` replaced in every string it holds, keys aside.

    Works on the tree's JSON text, cut at its quotation marks: between the first
    two, the next two and so on stand strings, and those before a colon are keys.
    Strings are compared as they read without escapes. A variant without the
    keyword is left as it is. One that has it and holds what JSON has no type
    for (dates, times, binary, floats, NaN) fails the query, as those would turn to text;
    within arrays of mixed types they are not noticed.
    """
    # Without these two escapes, each quotation mark is a string's first or last.
    plain = F.replace(
        F.replace(F.to_json(value), F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022")
    )

    def replaced(before: Column, after: Column) -> Column:
        kinds = F.schema_of_variant(value)
        kept = kinds == F.schema_of_variant(F.parse_json(before))
        lost = F.raise_error(F.concat(F.lit("JSON has no type for a value in "), kinds)).cast("variant")
        changed = F.when(kept, F.parse_json(after)).otherwise(lost)
        return F.when(before.isNull() | (before == after), value).otherwise(changed)

    def joined(pieces: Column) -> Column:
        following = F.slice(pieces, F.lit(2), F.size(pieces))
        pairs = F.zip_with(
            pieces, following, lambda piece, after: F.struct(piece.alias("piece"), after.alias("after"))
        )
        return F.array_join(
            F.transform(pairs, lambda pair, place: _piece(pair, place, keyword, replacement)), '"'
        )

    return _once(
        plain,
        lambda before: _once(
            _once(F.split(before, '"'), joined), lambda after: replaced(before, after)
        ),
    )


def _piece(pair: Column, place: Column, keyword: str, replacement: str) -> Column:
    """A piece of JSON text between two quotation marks, rewritten if it is a string and no key."""
    piece, after = pair["piece"], pair["after"]
    is_value = (place % 2 == 1) & ~after.startswith(":")
    quoted = F.concat(F.lit('"'), piece, F.lit('"'))

    def rewritten(text: Column) -> Column:
        new = F.to_json(F.replace(text, F.lit(keyword), F.lit(replacement)).cast("variant"))
        return F.when(text.contains(keyword), F.substring(new, F.lit(2), F.length(new) - 2)).otherwise(piece)

    escaped = F.variant_get(F.parse_json(quoted), "$", "string")
    return F.when(
        is_value, _once(F.when(piece.contains("\\"), escaped).otherwise(piece), rewritten)
    ).otherwise(piece)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]
