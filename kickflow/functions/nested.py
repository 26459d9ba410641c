"""Nested structs to flat columns, and column-name helpers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`{}`".format(name.replace("`", "``"))


def leaves(record: T.StructType) -> Iterator[tuple[str, ...]]:
    """Paths of all fields that are not structs; arrays count as leaves."""
    for field in record.fields:
        if isinstance(field.dataType, T.StructType):
            for path in leaves(field.dataType):
                yield (field.name, *path)
        else:
            yield (field.name,)


def flat_name(path: Sequence[str]) -> str:
    return "_".join(path).replace(".", "_")


def at(root: Column, path: Sequence[str]) -> Column:
    for name in path:
        root = root.getField(name)
    return root


def check_names(paths: Sequence[Sequence[str]]) -> None:
    """Raise if two paths give one column name; Spark ignores case in names."""
    seen: dict[str, Sequence[str]] = {}
    for path in paths:
        name = flat_name(path).lower()
        if name in seen:
            raise ValueError(f"{'/'.join(seen[name])} and {'/'.join(path)} both give column {name}")
        seen[name] = path


def flatten(df: DataFrame) -> DataFrame:
    """Every nested field as a column of its own, named by its path."""
    paths = list(leaves(df.schema))
    check_names(paths)
    return df.select(
        *[at(F.col(quoted(p[0])), p[1:]).alias(flat_name(p)) for p in paths]
    )


def expand(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Flatten one struct column beside ``keep``, whose columns win over record fields."""
    paths = [p for p in leaves(df.schema[column].dataType) if p[0] not in keep]
    check_names([*paths, *[(name,) for name in keep]])
    return df.select(
        *[at(F.col(quoted(column)), p).alias(flat_name(p)) for p in paths],
        *[F.col(quoted(name)) for name in keep],
    )


def underscore_names(df: DataFrame) -> DataFrame:
    """Replace ``.`` by ``_`` in every column name."""
    check_names([(name,) for name in df.columns])
    return df.withColumnsRenamed({name: name.replace(".", "_") for name in df.columns})


def arrays_to_json(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, for sinks without array types."""
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({name: F.to_json(F.col(quoted(name))) for name in arrays})


def fill_text_nulls(df: DataFrame) -> DataFrame:
    """NULL to the text ``'null'`` in string columns, other columns untouched."""
    return df.na.fill("null")


def project_like(
    df: DataFrame, table: str, extra: str = "raise", residue: str | None = None
) -> DataFrame:
    """The target table's columns in its order; one that ``df`` lacks is NULL.

    Columns that the table lacks go into its VARIANT column ``residue`` if it has one, as
    members of an object. Else they are an error, or are left out with ``extra="drop"``.
    """
    if extra not in ("raise", "drop"):
        raise ValueError("extra must be 'raise' or 'drop'")
    return project_onto(df, df.sparkSession.table(table).schema, table, extra, residue)


def project_onto(
    df: DataFrame, schema: T.StructType, table: str, extra: str = "raise", residue: str | None = None
) -> DataFrame:
    """As ``project_like``, onto given columns; ``extra="add"`` puts new ones after them."""
    if extra not in ("raise", "drop", "add"):
        raise ValueError("extra must be 'raise', 'drop' or 'add'")
    held = {name.lower() for name in schema.names}
    own = {name.lower() for name in df.columns}
    new = [name for name in df.columns if name.lower() not in held]
    packed = residue is not None and residue in schema.names and residue not in df.columns
    if new and not packed and extra == "raise":
        raise ValueError(f"{table} has no column for {', '.join(new)}")

    def value(field: T.StructField) -> Column:
        if packed and new and field.name == residue:
            return F.to_variant_object(F.struct(*[F.col(quoted(name)) for name in new]))
        if field.name.lower() in own:
            return F.col(quoted(field.name))
        return F.lit(None).cast(field.dataType)

    added = [F.col(quoted(name)) for name in new] if extra == "add" and not packed else []
    return df.select(*[value(field).alias(field.name) for field in schema], *added)
