"""From the headers of an export to canonical columns.

Works on one header row, on the driver; the data is only ever renamed by a
projection.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.contracts import InputField
from daybook.errors import SchemaError


def normal_header(raw: str) -> str:
    """Comparable form of a header: lower case words joined by underscores."""
    return "_".join(re.findall("[a-z0-9]+", raw.lower()))


@dataclass(frozen=True)
class HeaderMatch:
    """How the headers of one input relate to the canonical columns."""

    #: final column names, by position: canonical where matched, raw elsewhere
    columns: tuple[str, ...]
    #: raw header -> canonical name, where the two differ
    renamed: dict[str, str]
    #: raw headers no canonical column claims; kept, never used
    unexpected: tuple[str, ...]
    #: optional canonical columns the input does not have
    absent: tuple[str, ...]


def match_header(headers: Sequence[str], wanted: Sequence[InputField]) -> HeaderMatch:
    """Match raw headers to canonical columns, or say what is wrong with them."""
    repeated = [h for h, n in Counter(headers).items() if n > 1]
    if repeated:
        raise SchemaError(f"the header names these columns twice or more: {repeated}")

    by_normal: dict[str, str] = {}
    for raw in headers:
        earlier = by_normal.setdefault(normal_header(raw), raw)
        if earlier != raw:
            raise SchemaError(f"headers {earlier!r} and {raw!r} cannot be told apart")

    canonical_of: dict[str, str] = {}
    missing: list[str] = []
    absent: list[str] = []
    for fld in wanted:
        claims = [by_normal[s] for s in fld.spellings if s in by_normal]
        if len(claims) > 1:
            raise SchemaError(f"columns {claims} all fit the field {fld.name}")
        if claims:
            canonical_of[claims[0]] = fld.name
        elif fld.required:
            missing.append(fld.name)
        else:
            absent.append(fld.name)
    if missing:
        error = SchemaError(f"no column fits {missing}; the header has {list(headers)}")
        error.missing = tuple(missing)
        raise error

    return HeaderMatch(
        columns=tuple(canonical_of.get(h, h) for h in headers),
        renamed={raw: name for raw, name in canonical_of.items() if raw != name},
        unexpected=tuple(h for h in headers if h not in canonical_of),
        absent=tuple(absent),
    )


def canonical_columns(
    df: DataFrame, wanted: Sequence[InputField]
) -> tuple[DataFrame, HeaderMatch]:
    """Rename the columns of a frame; optional ones it lacks become typed nulls."""
    match = match_header(df.columns, wanted)
    renamed = df.toDF(*match.columns)
    for name in match.absent:
        renamed = renamed.withColumn(name, F.lit(None).cast("string"))
    return renamed, match
