"""Payloads of any shape, stored whole, so that fields outside the declared schema survive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    """JSON text as a variant, which Parquet stores in binary; text that is no JSON is missing, as missing text is."""
    return F.try_parse_json(text)


def field(payload: Column, path: str, kind: str) -> Column:
    """The value at a path such as ``$.user.tags[0]``; missing where there is none or it is not of this kind."""
    return F.try_variant_get(payload, path, kind)


def undeclared(payload: Column, declared: Sequence[str]) -> Column:
    """The top-level fields that are not declared, as a map of variants; missing where the payload is no object."""
    fields = F.try_variant_get(payload, "$", "map<string, variant>")
    return F.map_filter(fields, lambda name, value: ~name.isin(*declared) if declared else F.lit(True))
