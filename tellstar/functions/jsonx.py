"""Schema-on-read JSON helpers over VARIANT.

A payload is parsed once per row with ``parse_json``; every field is then a cheap
binary lookup with ``variant_get``. JSON null and a missing key both read as SQL NULL.
Typed extraction goes through text and an ANSI cast, so malformed text fails the job
instead of silently turning into NULL (the original SQL casts text the same way).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parsed(payload: Column | str = "payload") -> Column:
    return F.parse_json(_col(payload))


def _path(key: str) -> str:
    if key.startswith("$"):
        return key
    return "$" + "".join(f"['{k}']" for k in key.split("."))


def jtext(v: Column, key: str) -> Column:
    """``payload ->> 'key'`` (dotted keys walk nested objects, ``#>>``)."""
    return F.variant_get(v, _path(key), "string")


jpath = jtext


def jsub(v: Column, key: str) -> Column:
    """``payload -> 'key'``: the sub-document, still a VARIANT."""
    return F.variant_get(v, _path(key), "variant")


def jtyped(v: Column, key: str, spark_type: str) -> Column:
    """Text extraction followed by a strict cast (error on bad text under ANSI)."""
    return jtext(v, key).cast(spark_type)


def is_json_array(sub: Column) -> Column:
    """``jsonb_typeof(x) = 'array'``."""
    return F.schema_of_variant(sub).startswith("ARRAY")


_EXPONENT = r"^-?\d+(\.\d+)?[eE][+-]?\d+$"
_STRING = r'("(?:[^"\\]|\\.)*")'


_MARK = "\ue000"  # a private-use character: stands before a number that was made a string


def _numbers_quoted(payload: Column) -> Column:
    """The JSON text with every number as a string behind _MARK, since readers of JSON text
    rewrite numbers (``3.10`` to ``3.1``) but leave strings alone."""
    fenced = F.regexp_replace(payload, _STRING + r"|(-?\d[0-9.eE+-]*)", f"$1{_MARK}$2{_MARK}")
    return F.regexp_replace(F.replace(fenced, F.lit(_MARK * 2), F.lit("")), f"{_MARK}([^{_MARK}]+){_MARK}", f'"{_MARK}$1"')


def value_text(quoted: Column) -> Column:
    """Text of a JSON value that is no string (from ``_numbers_quoted``), as a numeric JSON column
    shows it: numbers keep their digits (``3.10``) with exponents written out (``1e5``:
    ``100000``); arrays and objects have one blank behind each comma and colon (numbers inside
    them stay as written)."""
    raw = F.replace(F.regexp_replace(quoted, f'"{_MARK}([^"]*)"', "$1"), F.lit(_MARK), F.lit(""))
    digits = F.length(F.regexp_extract(raw, r"\.(\d+)", 1))
    scale = F.greatest(digits - F.regexp_extract(raw, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    exact = raw.try_cast("decimal(38,18)").cast("string")
    whole, part = F.substring_index(exact, ".", 1), F.substring_index(exact, ".", -1)
    number = F.when(exact.isNull() | (scale > 18), F.raise_error(F.concat(F.lit("number out of range: "), raw))).when(
        scale > 0, F.concat(whole, F.lit("."), part.substr(F.lit(1), scale))).otherwise(whole)
    tight = F.regexp_replace(raw, _STRING + r"|\s+", "$1")
    spaced = F.regexp_replace(F.regexp_replace(tight, _STRING + "|([,:])", "$1$2\x01"), "([,:])\x01", "$1 ")
    return F.when(raw.rlike(_EXPONENT), number).when(raw.rlike(r"^\s*[\[{]"), F.replace(spaced, F.lit("\x01"), F.lit(""))).otherwise(raw)


def ground_truth_text(v: Column, key: str = "ground_truth", sep: str = ", ", payload: Column | str = "payload") -> Column:
    """Readable ground truth: array elements joined in order (NULL elements skipped,
    NULL when nothing is left, as an aggregate over zero rows), else the scalar text.
    Numbers are read from the payload's text, where VARIANT would rewrite them."""
    sub = jsub(v, key)
    is_text = lambda x: F.schema_of_variant(x) == "STRING"
    quoted = _numbers_quoted(_col(payload))
    raws = F.from_json(quoted, f"`{key}` array<string>").getField(key)
    kinds = F.try_variant_get(v, _path(key), "array<variant>")
    arr = F.zip_with(raws, kinds, lambda t, x: F.when(is_text(x), t).otherwise(value_text(t)))
    non_null = F.size(F.filter(arr, lambda x: x.isNotNull()))
    return (
        F.when(is_json_array(sub), F.when(non_null > 0, F.array_join(arr, sep)))
        .when(is_text(sub), jtext(v, key))
        .otherwise(value_text(F.from_json(quoted, f"`{key}` string").getField(key)))
    )


def array_length_or_zero(v: Column, key: str) -> Column:
    """``jsonb_array_length(coalesce(x, '[]'))``: 0 when the key is absent, an error when the
    value is there and no array."""
    arr = F.variant_get(v, _path(key), "array<variant>")
    return F.coalesce(F.size(arr), F.lit(0)).cast("int")


# ---- typed struct extraction (the hot path of the answer grain)

def text_schema(paths: list[str]):
    """StructType with a STRING leaf for every dotted path (nested objects as structs).

    ``from_json`` with such a schema reads each selected key as its JSON text (numbers
    and booleans as written, objects/arrays as raw JSON) in one streaming pass, skipping
    every other key: the same text ``->>`` yields, without building a VARIANT."""
    from pyspark.sql import types as T

    tree: dict = {}
    for p in paths:
        node = tree
        parts = p.split(".")
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        node.setdefault(parts[-1], None)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, T.StringType() if v is None else build(v)) for k, v in node.items()
        ])

    return build(tree)


def parsed_struct(payload: Column | str, schema) -> Column:
    return F.from_json(_col(payload), schema)


def strict_struct(payload: Column | str, fields: str) -> Column:
    """Some fields (``"name: string, ..."``) of a text that must be one JSON object in strict
    syntax: no single quotes, nothing behind it. Else the job fails. The text is parsed as the
    only element of an array, which anything behind it would break or add to."""
    text = _col(payload)
    one = F.from_json(F.concat(F.lit("["), F.coalesce(text, F.lit("")), F.lit("]")), f"array<struct<{fields}>>", {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    # both uses of the array are unconditional, so the text is parsed once (the branch of a CASE would parse it again)
    return one[F.when(F.size(one) == 1, F.lit(0)).otherwise(F.raise_error(F.concat(F.lit("not one JSON document: "), F.substring(text, 1, 80))).cast("int"))]


def stext(j: Column, path: str) -> Column:
    """Text of a dotted path inside a ``parsed_struct`` column (NULL when absent)."""
    out = j
    for part in path.split("."):
        out = out.getField(part)
    return out


def styped(j: Column, path: str, spark_type: str) -> Column:
    """Strict (ANSI) cast of the path's text."""
    return stext(j, path).cast(spark_type)
