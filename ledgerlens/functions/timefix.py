"""Timestamp text repair."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def fix_hour_24(text, fmt: str = DEFAULT_FORMAT, ntz: bool = True) -> Column:
    """'D 24:mm:ss' -> (D + 1 day) 00:mm:ss; other text parsed normally; unparsable text -> null (no ANSI error)."""
    s = text if isinstance(text, Column) else F.col(text)
    is24 = s.contains(" 24:")
    shifted = F.try_to_timestamp(F.regexp_replace(s, " 24:", " 00:"), F.lit(fmt)) + F.expr("INTERVAL 1 DAY")
    out = F.when(is24, shifted).otherwise(F.try_to_timestamp(s, F.lit(fmt)))
    return out.cast("timestamp_ntz") if ntz else out


def hour24_text(ts) -> Column:
    """Inverse used to derive edge rows: times in hour 0 written as the previous day's hour 24."""
    t = ts if isinstance(ts, Column) else F.col(ts)
    prev = F.date_format(F.date_sub(F.to_date(t), 1), "yyyy-MM-dd")
    return F.when(F.hour(t) == 0, F.concat(prev, F.lit(" 24:"), F.date_format(t, "mm:ss"))) \
            .otherwise(F.date_format(t, DEFAULT_FORMAT))


MS_PER_YEAR = 31536000000


def to_months_native(ms, integer: bool = True) -> Column:
    """ms // 31536000000 // 12 (floor form) or ms / 31536000000 / 12 (real division)."""
    c = ms if isinstance(ms, Column) else F.col(ms)
    if integer:
        return F.floor(F.floor(c / F.lit(MS_PER_YEAR)) / F.lit(12))
    return c / F.lit(MS_PER_YEAR) / F.lit(12)


def to_months_udf():
    """The same floor form as a vectorised pandas UDF (Arrow batches), for parity with the UDF variant."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def _to_months(ms: pd.Series) -> pd.Series:
        return (ms // MS_PER_YEAR // 12).astype("int64")

    return _to_months
