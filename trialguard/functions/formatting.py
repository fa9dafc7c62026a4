"""Display formatting and transport-ready projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialguard.functions.parsing import col
from trialguard.terminology import LABELS


def fixed(x: Column | str, decimals: int) -> Column:
    """Fixed-point text of a double, half-even on the exact binary value (Python ``:.Nf``).

    ``format_number`` with a pattern string uses ``DecimalFormat``, which does
    not group digits and rounds like Python's formatter; NULL -> ``'nan'``.
    """
    pattern = "0" if decimals == 0 else "0." + "0" * decimals
    return F.coalesce(F.call_function("format_number", col(x).cast("double"), F.lit(pattern)), F.lit("nan"))


def n_pct(n: Column | str, denom: Column | str) -> Column:
    """``'n (x.x%)'``; a zero denominator gives ``'0'``."""
    n, d = col(n), col(denom)
    pct = F.lit(100.0) * n.cast("double") / d.cast("double")
    text = F.concat(n.cast("string"), F.lit(" ("), fixed(pct, 1), F.lit("%)"))
    return F.when(d == 0, F.lit("0")).otherwise(text)


SAS_EPOCH = "1960-01-01"


def for_transport(df: DataFrame) -> DataFrame:
    """SAS-v5-ready projection of a dataset.

    Dates -> days since 1960-01-01 as double with format DATE9; booleans -> Y/'';
    numbers -> double; NULL text -> ''. Each column carries its label (<= 40
    characters) and format as column metadata. Names pass unchanged; a name of
    more than eight characters does not fit the format and is an error.
    """
    long = [f.name for f in df.schema.fields if len(f.name) > 8]
    if long:
        raise ValueError(f"names longer than 8 characters: {', '.join(long)}")
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        meta = {"label": LABELS.get(f.name, f.name)[:40]}
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            e = F.datediff(c, F.lit(SAS_EPOCH).cast("date")).cast("double")
            meta["format"] = "DATE9"
        elif isinstance(f.dataType, T.BooleanType):
            e = F.when(c, F.lit("Y")).otherwise(F.lit(""))
        elif isinstance(f.dataType, T.NumericType):
            e = c.cast("double")
        else:
            e = F.coalesce(c.cast("string"), F.lit(""))
        out.append(e.alias(f.name, metadata=meta))
    return df.select(*out)
