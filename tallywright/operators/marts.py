"""Cleaned and aggregated tables: dedupe, bars, returns, volatility, trend, as-of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions.money import exact_sum
from tallywright.operators.quality import has_key


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``latest_by``.

    The filter on ``row_number`` lets Spark keep one candidate per key and task
    before the shuffle, so a key with very many copies does not pile up.
    """
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    newest_first = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(newest_first))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def silver_refused(
    df: DataFrame, keys: Sequence[str], valid: Column | None = None
) -> DataFrame:
    """The rows that :func:`silver_clean` does not take, with the reason.

    ``reason`` is ``key`` where a part of the key is NULL, else ``invalid``, which a
    NULL condition counts as. Refused and taken rows are all rows; what the latest
    row of a key replaces is taken.
    """
    sound = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    reason = F.when(~has_key(keys), "key").when(~sound, "invalid")
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def silver_clean(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: str,
    valid: Column | None = None,
    codes: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep valid rows with a whole key, normalise codes and types, keep the latest.

    ``codes`` are trimmed and upper-cased; ``types`` gives target types by column.
    Ties on ``latest_by`` are broken by all other columns.
    """
    cleaned = df.filter(has_key(keys))
    if valid is not None:
        cleaned = cleaned.filter(valid)
    changed = {c: F.upper(F.trim(c)) for c in codes}
    changed.update({c: F.col(c).cast(t) for c, t in (types or {}).items()})
    cleaned = cleaned.withColumns(changed) if changed else cleaned
    others = [c for c in df.columns if c not in keys and c != latest_by]
    return keep_latest(cleaned, keys, [latest_by, *others])


def as_of(
    versions: DataFrame, key: str, at: str, moment: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest version of each key no later than ``moment``.

    The time bound is a plain comparison on the column and reaches the scan.
    """
    kind = versions.schema[at].dataType.simpleString()
    known = versions.filter(F.col(at) <= F.lit(moment).cast(kind))
    return keep_latest(known, [key], [at, *tie_break])


def period_of(at: str, grain: str) -> Column:
    """First day of the period; works on the date, so no time zone is involved."""
    day = F.to_date(F.col(at))
    return day if grain == "day" else F.trunc(day, grain)


def bars(
    ticks: DataFrame, symbol: str, price: str, at: str, tie_break: str, grain: str = "day"
) -> DataFrame:
    """Open, high, low, close, volume and tick count per period and symbol.

    Everything combines on the map side, so a busy symbol is not gathered. Instant
    and a whole-number id are packed into one decimal, which a hash aggregate can
    order by; text ids need a struct and a sort.
    """
    when = F.struct(at, tie_break)
    if isinstance(ticks.schema[tie_break].dataType, T.IntegralType):
        micros = F.unix_micros(F.col(at).cast("timestamp")).cast("decimal(19,0)")
        # Ids below zero stay in order once all are lifted by the range of a long.
        place = F.col(tie_break).cast("decimal(20,0)") + F.lit(Decimal(2**63))
        when = (micros * F.lit(Decimal(10**19)) + place).cast("decimal(38,0)")
    return ticks.groupBy(
        period_of(at, grain).alias("period"), F.col(symbol).alias("symbol")
    ).agg(
        F.min_by(price, when).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, when).alias("close"),
        F.round(exact_sum(price), 2).alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
    )


def sector_prices(
    rows: DataFrame, sector: str, price: str, at: str, grain: str = "day"
) -> DataFrame:
    """The price of a sector in a period: its summed amount."""
    return rows.groupBy(
        period_of(at, grain).alias("period"), F.col(sector).alias("sector")
    ).agg(F.round(exact_sum(price), 2).alias("close"))


def _by_sector() -> W:
    """Periods of a sector in order: one row each, so bounded by the calendar."""
    return W.partitionBy("sector").orderBy("period")


def period_returns(prices: DataFrame) -> DataFrame:
    """Relative change against the sector's previous period; NULL on the first."""
    previous = F.nullif(F.lag("close").over(_by_sector()), F.lit(0.0))
    return prices.withColumn("period_return", F.col("close") / previous - 1)


def volatility(returns: DataFrame, periods: int = 3) -> DataFrame:
    """Sample deviation of the last ``periods`` returns, this one included."""
    trailing = _by_sector().rowsBetween(-(periods - 1), W.currentRow)
    return returns.withColumn("volatility", F.stddev_samp("period_return").over(trailing))


def month_number(period: Column) -> Column:
    return (F.year(period) - 1970) * 12 + F.month(period) - 1


def day_number(period: Column) -> Column:
    return F.unix_date(period)


def trend_forecast(prices: DataFrame, grain: str = "month") -> DataFrame:
    """Least-squares line through a sector's periods, and its value one period on.

    Months are counted by their number, days by theirs, so months of other lengths
    are one step apart.
    """
    if grain not in ("month", "day"):
        raise ValueError(f"no trend by {grain!r}")
    number = month_number if grain == "month" else day_number
    last = F.max("period")
    x = number(F.col("period")).cast("double")
    y = F.col("close")
    return (
        prices.groupBy("sector")
        .agg(
            F.count(y).alias("periods"),
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            (F.add_months(last, 1) if grain == "month" else F.date_add(last, 1)).alias("next_period"),
        )
        .withColumn(
            "forecast",
            F.col("slope") * number(F.col("next_period")) + F.col("intercept"),
        )
    )


def walk_forward(prices: DataFrame, grain: str = "month") -> DataFrame:
    """Each period forecast by the line through the sector's earlier periods, and the error made.

    The line comes from running sums of moments, so a period costs no more than a row. Periods
    are counted from the sector's first one, which keeps the sums small. NULL before there
    are two earlier prices.
    """
    if grain not in ("month", "day"):
        raise ValueError(f"no trend by {grain!r}")
    number = month_number if grain == "month" else day_number
    whole = W.partitionBy("sector").orderBy("period").rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = _by_sector().rowsBetween(W.unboundedPreceding, -1)
    at = number(F.col("period")) - number(F.first("period").over(whole))
    rows = prices.withColumn("_x", at.cast("double"))
    x, y = F.when(F.col("close").isNotNull(), F.col("_x")), F.col("close")
    sums = {"_n": F.count(y), "_sx": F.sum(x), "_sy": F.sum(y), "_sxx": F.sum(x * x), "_sxy": F.sum(x * y)}
    rows = rows.withColumns({name: total.over(earlier) for name, total in sums.items()})
    n, sx, sy, sxx, sxy = (F.col(name) for name in sums)
    slope = (n * sxy - sx * sy) / F.nullif(n * sxx - sx * sx, F.lit(0.0))
    rows = rows.withColumn("forecast", F.when(n > 1, (sy + slope * (n * F.col("_x") - sx)) / n))
    return rows.withColumn("error", F.col("close") - F.col("forecast")).drop("_x", *sums)


def forecast_errors(walked: DataFrame) -> DataFrame:
    """How far off a sector's forecasts were: mean, mean absolute and root mean square error."""
    error = F.col("error")
    return walked.filter(error.isNotNull()).groupBy("sector").agg(
        F.count(error).alias("forecasts"),
        F.avg(error).alias("bias"),
        F.avg(F.abs(error)).alias("mean_absolute"),
        F.sqrt(F.avg(error * error)).alias("root_mean_square"),
    )
