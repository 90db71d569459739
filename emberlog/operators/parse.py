"""From raw lines to typed rows and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import columns as C
from emberlog.functions import fixed

FIELDS = (
    "timestamp", "level", "service", "message", "ip_address", "user", "response_time",
)


def parse_lines(lines: DataFrame, fields: Sequence[str] = FIELDS, keep_value: bool = False) -> DataFrame:
    """Typed fields of each line; other columns of ``lines`` are passed through.

    Each field is one regular expression, evaluated once per line.  Name only
    the fields the query needs: the rest is never matched.
    """
    exprs = C.parsed_columns()
    keep = [c for c in lines.columns if keep_value or c != "value"]
    return C.computed_once(lines, {f: exprs[f] for f in FIELDS if f in fields}, keep)


def valid_lines(parsed: DataFrame) -> DataFrame:
    """Rows with a level and a service."""
    return parsed.filter(C.is_valid())


def extract_features(parsed: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Add the numeric features, all ten or the named ones.

    Name them when ``parsed`` holds only some of the fields.
    """
    columns = C.feature_columns()
    return parsed.withColumns({n: columns[n] for n in (columns if names is None else names)})


def complete_rows(features: DataFrame, names: Sequence[str] = fixed.FEATURES_8) -> DataFrame:
    """Rows whose feature values are all present."""
    return features.dropna(subset=list(names))


def rejected_rows(features: DataFrame, names: Sequence[str] = fixed.FEATURES_8) -> DataFrame:
    """The complement of :func:`complete_rows`, for counting and a side table."""
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    return features.filter(missing)


def render_lines(parsed: DataFrame) -> DataFrame:
    """Canonical text of each parsed row (NULL when a field is missing)."""
    return parsed.withColumn("value", C.rendered_line())
