"""Binding logical fields to whatever headers a source carries. Runs at plan time only."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.spec import FIELD_HEADERS


def plain(header: str) -> str:
    """Lower case, letters a-z and digits only: ``FL_DATE`` and ``FlDate`` are the same header."""
    return re.sub("[^0-9a-z]+", "", header.lower())


def bind_headers(
    headers: Iterable[str], fields: Mapping[str, Sequence[str]] = FIELD_HEADERS
) -> dict[str, str]:
    """Logical field to source header, the first alias present winning."""
    headers = list(headers)
    clashes = sorted(name for name, n in Counter(map(plain, headers)).items() if n > 1)
    if clashes:
        raise ValueError(f"headers differ only in case or punctuation: {', '.join(clashes)}")
    present = {plain(header): header for header in headers}
    bound = {
        field: next((present[plain(a)] for a in aliases if plain(a) in present), None)
        for field, aliases in fields.items()
    }
    absent = [f"{f} (any of {', '.join(fields[f])})" for f, header in bound.items() if not header]
    if absent:
        raise ValueError("no source column for: " + "; ".join(absent))
    return bound


def resolve_fields(
    raw: DataFrame, fields: Mapping[str, Sequence[str]] = FIELD_HEADERS
) -> DataFrame:
    """The logical fields, in their fixed order, under their logical names."""
    bound = bind_headers(raw.columns, fields)
    quoted = {field: "`" + header.replace("`", "``") + "`" for field, header in bound.items()}
    return raw.select([F.col(quoted[field]).alias(field) for field in fields])
