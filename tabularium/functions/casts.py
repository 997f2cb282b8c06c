"""Safe and strict typing of dirty text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe(c: Column | str, dtype: str) -> Column:
    """Cast that gives null where the text does not parse."""
    return _col(c).try_cast(dtype)


def strict(c: Column | str, dtype: str) -> Column:
    """Cast that fails the job where the text does not parse, also with ANSI mode off."""
    value = _col(c)
    tried = value.try_cast(dtype)
    bad = value.isNotNull() & tried.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"not a {dtype}: "), value.cast("string"))).cast(dtype)).otherwise(tried)


def safe_date(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date where the whole text has the pattern, else null."""
    return F.try_to_date(_col(c), pattern)


def date_prefix(c: Column | str) -> Column:
    """The ``yyyy-MM-dd`` part of a timestamp text."""
    return F.substring(_col(c), 1, 10)


def utc_timestamp(c: Column | str) -> Column:
    """Offset timestamp text as a UTC wall-clock value, whatever the session time zone."""
    micros = F.unix_micros(_col(c).try_cast("timestamp"))
    seconds = (micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def blank_to_null(c: Column | str) -> Column:
    """Empty text becomes null."""
    return F.nullif(_col(c), F.lit(""))


def trimmed(c: Column | str) -> Column:
    """Text without outer blanks; nothing left becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def tokens_to_null(c: Column | str, tokens: Iterable[str]) -> Column:
    """Null where the trimmed text is one of the null tokens."""
    value = _col(c)
    return F.when(F.trim(value).isin(*tokens), F.lit(None)).otherwise(value)


def null_tokens(df: DataFrame, tokens: Iterable[str], columns: Iterable[str] | None = None) -> DataFrame:
    """Null tokens in all string columns, or in the named ones, in one projection."""
    tokens = list(tokens)
    chosen = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[tokens_to_null(c, tokens).alias(c) if c in chosen else F.col(c) for c in df.columns])


def cast_present(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Safe casts for the named columns that exist; the others are skipped.

    ``date`` parses ISO text only. One projection, whatever the number of columns.
    """
    def typed(name: str) -> Column:
        if name not in types:
            return F.col(name)
        wanted = types[name]
        value = safe_date(name) if wanted == "date" else safe(name, wanted)
        return value.alias(name)

    return df.select(*[typed(c) for c in df.columns])


def yes_no(c: Column | str) -> Column:
    """``Y`` is true, other text false, null stays null."""
    return _col(c) == F.lit("Y")


def truthy_number(c: Column | str) -> Column:
    """True for a number other than zero; null counts as false."""
    return F.coalesce(_col(c) != F.lit(0), F.lit(False))


def in_range(c: Column | str, low: int, high: int) -> Column:
    """Whether a value fits a narrower (for example unsigned) type; null passes."""
    return F.coalesce(_col(c).between(low, high), F.lit(True))


def typed_null(dtype: str) -> Column:
    """Placeholder column."""
    return F.lit(None).cast(dtype)
