"""Result tables as JSON: one object per row (JSON Lines), NULL fields omitted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

JSON_OPTIONS = {
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


def _rounded(df: DataFrame, digits: int | None) -> list:
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if digits is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        cols.append(c.alias(field.name))
    return cols


def to_json_rows(df: DataFrame, digits: int | None = 4, column: str = "json", tz: str = "UTC") -> DataFrame:
    """One JSON text per row in column ``json``. Doubles are rounded to
    ``digits`` decimals (``None`` keeps full precision); dates print as
    ``yyyy-MM-dd``, instants as ``yyyy-MM-dd HH:mm:ss`` in zone ``tz``
    (whatever the session zone is)."""
    opts = {**JSON_OPTIONS, "timeZone": tz}
    return df.select(F.to_json(F.struct(*_rounded(df, digits)), opts).alias(column))


def write_json_rows(df: DataFrame, path: str, digits: int | None = 4, mode: str = "error",
                    compression: str | None = None, tz: str = "UTC") -> None:
    """Write JSON Lines files, one task per partition."""
    writer = df.select(*_rounded(df, digits)).write.mode(mode).options(**{**JSON_OPTIONS, "timeZone": tz})
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
