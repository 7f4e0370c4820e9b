"""Parse ``id,ts,vc`` text lines into sensor readings (M1).

Rules (fixed by the reference's parser): split on ``,``; extra fields are
ignored; trailing empty fields are dropped before counting, so fewer than
three fields is an error; ts must be a 64-bit and vc a 32-bit decimal
integer with an optional sign and no surrounding spaces.  Bad lines are not
dropped: they go to a quarantine frame with a reason, or raise with
``strict=True``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INT_PATTERN = r"^[+-]?[0-9]+\z"
TRAILING_COMMAS = r",+\z"

REASON_FIELDS = "missing_fields"
REASON_TS = "bad_ts"
REASON_VC = "bad_vc"


def _annotate(lines: DataFrame, value_col: str) -> DataFrame:
    v = F.col(value_col)
    fields = F.split(v, ",")
    n_fields = F.size(F.split(F.regexp_replace(v, TRAILING_COMMAS, ""), ","))
    ts_s, vc_s = F.get(fields, 1), F.get(fields, 2)
    ts = F.when(ts_s.rlike(INT_PATTERN), ts_s.try_cast("bigint"))
    vc = F.when(vc_s.rlike(INT_PATTERN), vc_s.try_cast("int"))
    reason = (F.when(n_fields < 3, F.lit(REASON_FIELDS))
              .when(ts.isNull(), F.lit(REASON_TS))
              .when(vc.isNull(), F.lit(REASON_VC)))
    return lines.select("*", F.get(fields, 0).alias("_id"), ts.alias("_ts"),
                        vc.alias("_vc"), reason.alias("_reason"))


def parse_sensor_lines(lines: DataFrame, value_col: str = "value",
                       keep: list[str] | None = None,
                       strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(readings, rejects)``.

    readings: keep columns + id STRING, ts BIGINT, vc INT
    rejects:  keep columns + the raw value + reason STRING
    With ``strict`` the readings frame raises on the first bad line, by the same rules.
    """
    keep = keep or []
    a = _annotate(lines, value_col)
    if strict:
        wrong = F.raise_error(F.concat(F.col("_reason"), F.lit(": "), F.coalesce(value_col, F.lit("null"))))
        good = a.select(*keep, F.when(F.col("_reason").isNull(), F.col("_id")).otherwise(wrong.cast("string")).alias("id"),
                        F.when(F.col("_reason").isNull(), F.col("_ts")).otherwise(wrong.cast("bigint")).alias("ts"),
                        F.when(F.col("_reason").isNull(), F.col("_vc")).otherwise(wrong.cast("int")).alias("vc"))
        return good, a.where("_reason IS NOT NULL").select(*keep, value_col, F.col("_reason").alias("reason"))
    ok = a.where(F.col("_reason").isNull()).select(
        *keep, F.col("_id").alias("id"), F.col("_ts").alias("ts"), F.col("_vc").alias("vc"))
    bad = a.where(F.col("_reason").isNotNull()).select(
        *keep, F.col(value_col), F.col("_reason").alias("reason"))
    return ok, bad
