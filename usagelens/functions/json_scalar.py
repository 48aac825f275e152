"""Scalar values out of JSON documents, one parsing pass per document.

Expressions are written as SQL text: a projection of many columns then crosses to the JVM once,
instead of once per function call.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def scalar_text(value: str) -> str:
    """SQL for the text of a scalar variant; NULL for an object, an array or JSON null."""
    return f"IF(schema_of_variant({value}) RLIKE '^(OBJECT|ARRAY)', NULL, CAST({value} AS STRING))"


def json_text(df: DataFrame, column: str) -> str:
    """SQL for the column as JSON text, whether it rests as text, record or variant."""
    return column if isinstance(df.schema[column].dataType, T.StringType) else f"to_json({column})"


def json_scalars(
    df: DataFrame, document: str, paths: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Add one string column per entry of ``paths`` (name -> ``$.a.b[0].c``), keep ``keep``.

    A document that rests as a variant is not parsed: its paths go into the scan. Otherwise only the
    branches named by the paths are materialised: a schema pruned to them, with variant
    leaves, is handed to ``from_json``. The parsed record leaves through a generator, because
    Catalyst does not copy expressions across one; filters on the new columns therefore never make
    Spark parse the document a second time.
    """
    if isinstance(df.schema[document].dataType, T.VariantType):
        found = {name: scalar_text(f"try_variant_get({document}, '{path}', 'variant')") for name, path in paths.items()}
        return df.selectExpr(*keep, *[f"{value} AS {name}" for name, value in found.items()])
    splits = {name: _split(path) for name, path in paths.items()}
    roots: list[tuple[str, ...]] = []
    for keys, _ in sorted(splits.values(), key=lambda s: len(s[0])):
        if not any(keys[: len(root)] == root for root in roots):
            roots.append(keys)
    fields = _fields(roots)
    slots = {key: f"__doc_{i}" for i, key in enumerate(fields)}
    schema = _record(fields)
    parsed = df.selectExpr(
        *keep,
        f"inline(array(from_json({json_text(df, document)}, '{schema}'))) AS ({', '.join(slots.values())})",
    )

    def leaf(keys: tuple[str, ...], index: str) -> str:
        root = next(r for r in roots if keys[: len(r)] == r)
        value = ".".join([slots[root[0]], *(f"`{key}`" for key in root[1:])])
        rest = "".join(f".{key}" for key in keys[len(root) :]) + index
        return scalar_text(f"try_variant_get({value}, '${rest}', 'variant')" if rest else value)

    return parsed.selectExpr(*keep, *[f"{leaf(*splits[name])} AS {name}" for name in paths])


def _split(path: str) -> tuple[tuple[str, ...], str]:
    head, bracket, tail = path.removeprefix("$.").partition("[")
    return tuple(head.split(".")), bracket + tail


def _fields(roots: Sequence[tuple[str, ...]]) -> dict[str, list[tuple[str, ...]]]:
    fields: dict[str, list[tuple[str, ...]]] = {}
    for key, *rest in roots:
        fields.setdefault(key, []).append(tuple(rest))
    return fields


def _record(fields: Mapping[str, list[tuple[str, ...]]]) -> str:
    parts = [
        f"`{key}`: " + ("VARIANT" if below == [()] else _record(_fields(below)))
        for key, below in fields.items()
    ]
    return f"STRUCT<{', '.join(parts)}>"
