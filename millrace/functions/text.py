"""Text cleaning expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts a CSV load treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Fixed value: stands in for a missing text.
PLACEHOLDER = "-"

# Everything that is not a word character, whitespace or ASCII
# punctuation. Java's \w is ASCII only, so letters and numbers are named by class.
SYMBOLS = (
    r"[^\p{L}\p{N}_\s\x1C-\x1F\x85\p{Z}\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
)

# The characters a document-store trim removes.
TRIMMED = (
    "\u0000\u0009\u000a\u000b\u000c\u000d\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quoted(name: str) -> Column:
    """Column by exact name, also when it holds dots or dashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def strip_symbols(text: Column) -> Column:
    """Drop emoji, combining marks and other symbols outside ASCII punctuation."""
    return F.regexp_replace(text, SYMBOLS, "")


def comparison_key(text: Column) -> Column:
    """Trimmed, lower-case form under which equal comments meet."""
    return F.lower(F.btrim(text, F.lit(TRIMMED)))


def fill_text_nulls(df: DataFrame, fill: str = PLACEHOLDER) -> DataFrame:
    """Fill NULLs in the text columns only; numeric columns keep theirs."""
    columns = text_columns(df)
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(fill)) for c in columns}) if columns else df


def null_na_texts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL for every missing-value text in ``columns`` (default: all text columns)."""
    chosen = text_columns(df) if columns is None else columns
    return df.withColumns({c: na_to_null(quoted(c)) for c in chosen}) if chosen else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in the floating-point columns."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(quoted(c)), quoted(c)) for c in floats}) if floats else df
