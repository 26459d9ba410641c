"""Reading members out of a JSON reply body."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.schemas import ddl

JSON_OPTIONS = {"allowSingleQuotes": "false"}


def member(body: Column, path: Sequence[str], data_type: T.DataType) -> Column:
    """The member at ``path``; an empty path is the whole object.

    NULL if the body is not one JSON object, or if the member is missing or null.
    The body is parsed as the value of an outer object, so that text after its
    closing brace makes it unreadable instead of being ignored.
    """
    schema = data_type
    for name in reversed(("reply", *path)):
        schema = T.StructType().add(name, schema)
    value = F.from_json(F.concat(F.lit('{"reply":'), body, F.lit("}")), schema, JSON_OPTIONS)
    for name in ("reply", *path):
        value = value.getField(name)
    return value


def items(body: Column, path: Sequence[str], record: T.StructType) -> Column:
    """The array at ``path`` as records; an element that is not an object is NULL."""
    return or_single(member(body, path, T.ArrayType(record)), body, path, record)


def or_single(
    typed: Column, body: Column, path: Sequence[str], record: T.StructType
) -> Column:
    """``typed``, or the array read element by element where that is NULL.

    One odd element makes the typed parse give up the whole array. Only such
    bodies, and those without the array, are parsed a second time.
    """
    single = member(body, path, T.ArrayType(T.VariantType()))
    shape = ddl(record)
    return F.coalesce(typed, F.transform(single, lambda e: F.try_variant_get(e, "$", shape)))


def rescued(value: Column, typed: Column, record: T.StructType) -> Column:
    """What ``value``, a variant, has and ``typed`` lost: JSON text by path; NULL if nothing.

    A value of another type than the shape's is NULL in ``typed``. It is told from a JSON null
    and from a member that is not there, and found at every level: a scalar where there should
    be an object is kept as such, with the path of the object, and an array with an element of
    another type is kept as a whole.
    """
    text = T.StringType()
    found = []
    for path, data_type in _nodes(record):
        raw = F.variant_get(value, variant_path(*path), "variant")
        here = _inside(typed, path)
        lost = here.isNull()
        if isinstance(data_type, T.StructType):
            lost = F.try_variant_get(raw, "$", "struct<>").isNull()
        elif isinstance(data_type, T.ArrayType):
            odd = F.exists(here, lambda e: e.isNull()) & ~F.to_json(raw).eqNullSafe(F.to_json(here))
            lost |= F.coalesce(odd, F.lit(False))
        given = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(False))
        entry = F.struct(F.lit(".".join(path)).alias("key"), F.to_json(raw).cast(text).alias("value"))
        found.append(F.when(given & lost, entry))
    entries = F.filter(F.array(*found), lambda e: e.isNotNull())
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def _nodes(record: T.StructType) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """Paths of all fields, objects before what is in them."""
    for field in record.fields:
        yield (field.name,), field.dataType
        if isinstance(field.dataType, T.StructType):
            for path, data_type in _nodes(field.dataType):
                yield (field.name, *path), data_type


def _inside(root: Column, path: Sequence[str]) -> Column:
    for name in path:
        root = root.getField(name)
    return root


def rescued_items(body: Column, path: Sequence[str], record: T.StructType, name: str) -> Column:
    """``items`` whose records have a field ``name`` with what the shape has no place for.

    Bodies in which every record has a value for every field are parsed once, as by ``items``:
    nothing can be lost there. Only the others are read as variants too.
    """
    typed = items(body, path, record)
    leaves = [p for p, data_type in _nodes(record) if not isinstance(data_type, T.StructType)]

    def open_(row: Column) -> Column:
        return reduce(lambda a, b: a | b, [_unsure(_inside(row, p), record, p) for p in leaves], F.lit(False))

    def with_lost(row: Column, lost: Column) -> Column:
        fields = [row.getField(f.name).alias(f.name) for f in record.fields]
        return F.when(row.isNotNull(), F.struct(*fields, lost.alias(name)))

    none = F.lit(None).cast("map<string,string>")
    single = member(body, path, T.ArrayType(T.VariantType()))
    read_twice = F.exists(typed, lambda r: r.isNotNull() & open_(r))
    return F.when(
        read_twice, F.zip_with(typed, single, lambda r, v: with_lost(r, rescued(v, r, record)))
    ).otherwise(F.transform(typed, lambda r: with_lost(r, none)))


def _unsure(value: Column, record: T.StructType, path: Sequence[str]) -> Column:
    data_type: T.DataType = record
    for name in path:
        data_type = data_type[name].dataType
    if isinstance(data_type, T.ArrayType):
        return value.isNull() | F.coalesce(F.exists(value, lambda e: e.isNull()), F.lit(False))
    return value.isNull()


def variant_path(*names: str) -> str:
    return "$" + "".join("['{}']".format(n.replace("'", "\\'")) for n in names)


def has(value: Column, *names: str) -> Column:
    """Whether a variant has the member, JSON null included."""
    return F.variant_get(value, variant_path(*names), "variant").isNotNull()


def has_object(value: Column, *names: str) -> Column:
    return F.try_variant_get(value, variant_path(*names), "struct<>").isNotNull()


def infer_record(values: DataFrame, column: str) -> T.StructType:
    """Union of all fields seen in a variant column; one aggregation, one row back.

    Without any object there are no fields.
    """
    objects = values.where(has_object(F.col(column)))
    seen = objects.agg(F.schema_of_variant_agg(column)).first()[0]
    if not seen or not seen.startswith("OBJECT"):
        return T.StructType([])
    quoted = re.split(r"(`(?:[^`]|``)*`)", seen)
    quoted[::2] = [part.replace("OBJECT<", "STRUCT<") for part in quoted[::2]]
    return plain(T.DataType.fromDDL("".join(quoted)))


def plain(data_type: T.DataType) -> T.DataType:
    """An inferred type as one of columns; of what has no single type, as text."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in data_type])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(plain(data_type.elementType))
    if isinstance(data_type, T.DecimalType):
        return T.DecimalType(38, 0) if data_type.scale == 0 else T.DoubleType()
    if isinstance(data_type, (T.NullType, T.VariantType)):
        return T.StringType()
    return data_type
