"""Column expressions: calendar parts, labels, buckets, hashes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts shown for coded columns, in two languages.
GENDER_LABELS = {
    "en": {-1: "unknown", 0: "female", 1: "male"},
    "zh": {-1: "未知", 0: "女性", 1: "男性"},
}
WEEKDAY_LABELS = {
    "en": {0: "Monday", 1: "Tuesday", 2: "Wednesday", 3: "Thursday", 4: "Friday", 5: "Saturday", 6: "Sunday"},
    "zh": {0: "周一", 1: "周二", 2: "周三", 3: "周四", 4: "周五", 5: "周六", 6: "周日"},
}
AGE_UNKNOWN = {"en": "unknown", "zh": "未知"}
AGE_PREFIX = {"en": "age group ", "zh": "年龄段"}
# Share-count buckets as (label, first count that belongs to the next one).
SHARE_BUCKETS = [("<10", 10), ("10-50", 50), ("50-100", 100), ("100-500", 500), (">500", None)]


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; text that is not a time is an error under ANSI mode."""
    return F.to_timestamp(text)


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``date, hour, day_of_week`` (Monday is 0), ``month`` and ``day``."""
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
        }
    )


def month_day_label(ts: Column) -> Column:
    """``MM-dd`` text; the same day of two years gets one label."""
    return F.date_format(ts, "MM-dd")


def _lookup(code: Column, labels: Mapping[int, str]) -> Column:
    label = F.lit(None).cast("string")
    for value, text in labels.items():
        label = F.when(code == value, text).otherwise(label)
    return label


def label_gender(code: Column, lang: str = "en") -> Column:
    return _lookup(code, GENDER_LABELS[lang])


def label_weekday(code: Column, lang: str = "en") -> Column:
    return _lookup(code, WEEKDAY_LABELS[lang])


def label_age(code: Column, lang: str = "en") -> Column:
    return F.when(code == -1, AGE_UNKNOWN[lang]).otherwise(
        F.concat(F.lit(AGE_PREFIX[lang]), code.cast("string"))
    )


def share_count_bucket(count: Column) -> Column:
    label = F.lit(SHARE_BUCKETS[-1][0])
    for text, end in reversed(SHARE_BUCKETS[:-1]):
        label = F.when(count < end, text).otherwise(label)
    return F.when(count.isNotNull(), label)


def share_bucket_rank(label: Column) -> Column:
    """Position of a bucket label, for ordering."""
    return _lookup(label, {text: str(i) for i, (text, _) in enumerate(SHARE_BUCKETS)}).cast("int")


def log1p_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Add ``log_<column>`` = ln(1 + x) for each count column."""
    return df.withColumns({f"log_{c}": F.log1p(F.col(c).cast("double")) for c in columns})


def limit_range(df: DataFrame, column: str = "invite_count", upper: int = 10000) -> DataFrame:
    return df.where(F.col(column) <= upper)


def hash_text(seed: int, *keys: str | Column) -> Column:
    """32 hex digits that fix a repeatable random order of rows."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_fraction(seed: int, *keys: str | Column) -> Column:
    """A repeatable number in [0, 1) per key."""
    digits = F.substring(hash_text(seed, *keys), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**8))
