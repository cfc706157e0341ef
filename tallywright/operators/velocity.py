"""Per-customer order: previous amounts and trailing-window totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.operators.skew import (
    DEFAULT_POLICY,
    OrderedRows,
    SkewPolicy,
    add_carry,
    lay_out,
    measured,
    same_key,
)
from tallywright.session import written

ORDER = ("timestamp", "transaction_id")
KEY = "customer_id"


def with_previous_amounts(
    df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, counts: DataFrame | None = None
) -> DataFrame:
    """The customer's last two amounts before each row, by time and then id."""
    laid = lay_out(df, KEY, ORDER, policy, counts)
    w = W.partitionBy(KEY, "_chunk").orderBy(*laid.order)
    rows = laid.rows.withColumn("prev_amount_1", F.lag("amount", 1).over(w)).withColumn(
        "prev_amount_2", F.lag("amount", 2).over(w)
    )
    if laid.split:
        rows = rows.withColumn("_nth", F.row_number().over(w))
        rows = add_carry(rows, _last_two_before(laid), KEY, ["_last_1", "_last_2"], policy)
        nth = F.col("_nth")
        rows = rows.withColumn(
            "prev_amount_2",
            F.when(nth == 1, F.col("_last_2"))
            .when(nth == 2, F.col("_last_1"))
            .otherwise(F.col("prev_amount_2")),
        ).withColumn(
            "prev_amount_1",
            F.when(nth == 1, F.col("_last_1")).otherwise(F.col("prev_amount_1")),
        )
    return rows.select(*df.columns, "prev_amount_1", "prev_amount_2")


def _last_two_before(laid: OrderedRows) -> DataFrame:
    """The last two amounts of a key before each of its chunks."""
    backwards = W.partitionBy(KEY, "_chunk").orderBy(*[F.desc(c) for c in laid.order])
    tails = (
        laid.hot.withColumn("_from_end", F.row_number().over(backwards))
        .filter(F.col("_from_end") <= 2)
        .groupBy(KEY, "_chunk")
        .agg(
            F.max("_from_end").alias("_tail_rows"),
            F.max(F.when(F.col("_from_end") == 1, F.col("amount"))).alias("_tail_1"),
            F.max(F.when(F.col("_from_end") == 2, F.col("amount"))).alias("_tail_2"),
        )
    )
    chunks = W.partitionBy(KEY).orderBy("_chunk")
    # A preceding chunk of one row leaves the second place to the chunk before it.
    return tails.select(
        KEY,
        "_chunk",
        F.lag("_tail_rows").over(chunks).alias("_rows_before"),
        F.lag("_tail_1").over(chunks).alias("_last_1"),
        F.when(F.lag("_tail_rows").over(chunks) > 1, F.lag("_tail_2").over(chunks))
        .otherwise(F.lag("_tail_1", 2).over(chunks))
        .alias("_last_2"),
    ).filter(F.col("_rows_before").isNotNull())


EXACT = T.DecimalType(28, 6)
LARGEST_EXACT = 1e15


def _is_floating(df: DataFrame) -> bool:
    return isinstance(df.schema["amount"].dataType, (T.DoubleType, T.FloatType))


def with_rolling_totals(
    df: DataFrame, window: str = "1 hour", policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows and amount of the customer in the trailing ``window``, both ends included.

    Equal to a RANGE frame from ``window`` before to the current row. Each row is
    read twice: it enters at its own time and leaves right after its time plus
    ``window``; what is inside at any moment is then a running total, so the work
    grows with the rows and not with rows times frame length.

    Leaving rows are subtracted, so amounts must be exact. Decimals keep their own
    scale. Floating amounts that whole millionths hold, as money does, are summed in
    these; NaN and infinities are counted beside them. A customer with any other
    amount is left to Spark's own frame, which only adds, in chunks if the customer is
    hot; whether there are such customers is counted first, which runs a job.
    """
    if not _is_floating(df):
        return _running(df, window, policy, amounts=True)
    amount = F.col("amount")
    finite = ~F.isnan(amount) & (F.abs(amount) != float("inf"))
    # Beyond the limit the cast would not fit, so it is not looked at.
    exact = (F.abs(amount) < LARGEST_EXACT) & (
        F.when(F.abs(amount) < LARGEST_EXACT, amount).cast(EXACT).cast("double") == amount
    )
    inexact = df.filter(finite & ~exact).select(F.col(KEY).alias("_inexact_key")).distinct()
    inexact = measured(inexact, "inexact-keys", policy)
    if inexact.isEmpty():
        return _running(df, window, policy, amounts=True)
    met = same_key(F.col(KEY), F.col("_inexact_key"))
    plain = _native(df.join(inexact, met, "left_semi"), window, policy)
    return _running(df.join(inexact, met, "left_anti"), window, policy, amounts=True).unionByName(plain)


def _native(df: DataFrame, window: str, policy: SkewPolicy) -> DataFrame:
    """Spark's own RANGE frame, in microseconds because frames take no intervals here.

    A hot customer is cut into chunks along time, and each chunk is given the rows of the
    others that its frames reach: those of one window before it, and those of its last
    instant. They are counted in and then left out.
    """
    moment = F.unix_micros(F.col("timestamp").cast("timestamp"))
    span = df.sparkSession.range(1).select(
        F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {window}"))
    )
    span = span.first()[0]
    laid = lay_out(df.withColumn("_micros", moment), KEY, ("_micros", "transaction_id"), policy)
    rows = laid.rows.withColumn("_guest", F.lit(False))
    if laid.split:
        rows = rows.unionByName(_guests(laid, span, policy).withColumn("_guest", F.lit(True)))
    w = W.partitionBy(KEY, "_chunk").orderBy("_micros").rangeBetween(-span, 0)
    counted = rows.withColumns(
        {"rolling_count": F.count(F.lit(1)).over(w), "rolling_amount": F.sum("amount").over(w)}
    )
    return counted.filter(~F.col("_guest")).select(*df.columns, "rolling_count", "rolling_amount")


def _guests(laid: OrderedRows, span: int, policy: SkewPolicy) -> DataFrame:
    """Rows of hot customers once more for each other chunk whose frames reach them."""
    at = F.col("_micros")
    bounds = written(
        laid.hot.groupBy(KEY, "_chunk").agg(
            F.min(at).alias("_first"), F.max(at).alias("_last"), F.count_if(at.isNull()).alias("_timeless")
        ),
        "frame-bounds",
    )
    by_chunk = W.partitionBy(KEY).orderBy("_chunk")
    later, earlier = by_chunk.rowsBetween(1, W.unboundedFollowing), by_chunk.rowsBetween(W.unboundedPreceding, -1)
    beside = bounds.select(
        KEY, "_chunk", F.min("_first").over(later).alias("_next"), F.max("_last").over(earlier).alias("_before")
    )
    # Few rows lie so near a border; only these are held against the other chunks.
    near = add_carry(laid.hot, beside, KEY, ["_next", "_before"], policy).filter(
        at.isNull() | (at + span >= F.col("_next")) | (at <= F.col("_before"))
    )
    hosts = measured(
        bounds.select(
            F.col(KEY).alias("_host_key"), F.col("_chunk").alias("_host"), "_first", "_last", "_timeless"
        ),
        "frame-hosts",
        policy,
    )
    reached = F.when(at.isNull(), F.col("_timeless") > 0).otherwise(
        (at + span >= F.col("_first")) & (at <= F.col("_last"))
    )
    met = same_key(F.col(KEY), F.col("_host_key")) & (F.col("_chunk") != F.col("_host")) & reached
    guests = near.join(hosts, met).withColumn("_chunk", F.col("_host"))
    return guests.select(*laid.hot.columns)


def _running(df: DataFrame, window: str, policy: SkewPolicy, amounts: bool) -> DataFrame:
    """``rolling_count`` and, if ``amounts``, ``rolling_amount`` from running totals."""
    floating = amounts and _is_floating(df)
    nan, inf = F.lit(False), F.lit(False)
    exact = F.lit(0)
    if amounts:
        amount = F.col("amount")
        exact = amount
        if floating:
            nan = F.coalesce(F.isnan(amount), F.lit(False))
            inf = F.coalesce(F.abs(amount) == float("inf"), F.lit(False))
            exact = F.when(~nan & ~inf, amount).cast(EXACT)
    payload = F.struct(*[F.col(c) for c in df.columns])
    enters = F.struct(
        F.col("timestamp").alias("_at"),
        F.lit(0).alias("_leaves"),
        F.lit(1).alias("_sign"),
        payload.alias("_row"),
    )
    leaves = F.struct(
        (F.col("timestamp") + F.expr(f"INTERVAL {window}")).alias("_at"),
        F.lit(1).alias("_leaves"),
        F.lit(-1).alias("_sign"),
        F.lit(None).cast(df.schema).alias("_row"),
    )
    carried = [F.col(KEY), F.col("transaction_id").alias("_id")]
    if amounts:
        carried += [exact.alias("_delta"), F.col("amount").isNotNull().alias("_valued")]
    if floating:
        carried += [
            nan.alias("_nan"),
            (inf & (F.col("amount") > 0)).alias("_up"),
            (inf & (F.col("amount") < 0)).alias("_down"),
        ]
    moves = df.select(*carried, F.inline(F.array(enters, leaves)))
    counts = df.groupBy(KEY).agg((F.count(F.lit(1)) * 2).alias("_rows"))
    laid = lay_out(moves, KEY, ("_at", "_leaves", "_id"), policy, counts)
    # Rows of one instant see each other, so the running frame is RANGE.
    w = (
        W.partitionBy(KEY, "_chunk")
        .orderBy("_at", "_leaves")
        .rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    measures = {"_in": F.col("_sign")}
    if amounts:
        measures["_sum"] = F.when(F.col("_leaves") == 0, F.col("_delta")).otherwise(-F.col("_delta"))
        measures["_valued_in"] = F.when(F.col("_valued"), F.col("_sign")).otherwise(0)
    if floating:
        # Only the inexact types can hold NaN and infinities.
        for name in ("_nan", "_up", "_down"):
            measures[f"{name}_in"] = F.when(F.col(name), F.col("_sign")).otherwise(0)
    rows = laid.rows.select(
        *["_chunk", KEY, "_at", "_leaves", "_row"],
        *[F.sum(measure).over(w).alias(name) for name, measure in measures.items()],
    )
    if laid.split:
        rows = _carry_totals(rows, laid, measures, policy)
    out = [F.col("_row.*"), F.col("_in").alias("rolling_count")]
    if amounts:
        total = F.col("_sum").cast("double") if floating else F.col("_sum")
        if floating:
            up, down = F.col("_up_in") > 0, F.col("_down_in") > 0
            total = (
                F.when((F.col("_nan_in") > 0) | (up & down), F.lit(float("nan")))
                .when(up, F.lit(float("inf")))
                .when(down, F.lit(float("-inf")))
                .otherwise(F.coalesce(total, F.lit(0.0)))
            )
        out.append(F.when(F.col("_valued_in") > 0, total).alias("rolling_amount"))
    return rows.filter(F.col("_leaves") == 0).select(*out)


def _carry_totals(
    rows: DataFrame, laid: OrderedRows, measures: dict[str, Column], policy: SkewPolicy
) -> DataFrame:
    """Add what earlier chunks hold, and the rest of an instant cut by a border.

    Per chunk and key there is one summary row: totals, first and last instant.
    The totals of the first instant are summed in a second look at the rows, which
    joins that short table and passes on only the rows it needs.
    """
    instant = F.struct("_at", "_leaves")
    names = list(measures)
    sums = [F.sum(m).alias(name) for name, m in measures.items()]
    bounds = written(
        laid.hot.groupBy(KEY, "_chunk").agg(
            *sums, F.min(instant).alias("_first"), F.max(instant).alias("_last")
        ),
        "bounds",
    )
    firsts = measured(
        bounds.select(
            F.col(KEY).alias("_first_key"), F.col("_chunk").alias("_first_chunk"), "_first"
        ),
        "firsts",
        policy,
    )
    first_totals = (
        laid.hot.join(
            firsts,
            same_key(F.col(KEY), F.col("_first_key"))
            & (F.col("_chunk") == F.col("_first_chunk"))
            & (instant == F.col("_first")),
        )
        .groupBy("_first_key", "_first_chunk")
        .agg(*sums)
        .select("_first_key", "_first_chunk", F.struct(*names).alias("_first_totals"))
    )
    summary = bounds.join(
        measured(first_totals, "first-totals", policy),
        same_key(F.col(KEY), F.col("_first_key")) & (F.col("_chunk") == F.col("_first_chunk")),
    )
    by_chunk = W.partitionBy(KEY).orderBy("_chunk")
    earlier = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    same_first = (
        W.partitionBy(KEY, "_first")
        .orderBy(F.desc("_chunk"))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    cut = F.lead("_first").over(by_chunk) == F.col("_last")
    carry = summary.select(
        KEY,
        "_chunk",
        "_first",
        "_last",
        *[F.sum(n).over(earlier).alias(f"_before{n}") for n in names],
        *[F.sum(f"_first_totals.{n}").over(same_first).alias(f"_from_here{n}") for n in names],
    ).select(
        KEY,
        "_chunk",
        "_last",
        *[f"_before{n}" for n in names],
        *[F.when(cut, F.lead(f"_from_here{n}").over(by_chunk)).alias(f"_after{n}") for n in names],
    )
    carried = [f"_before{n}" for n in names] + [f"_after{n}" for n in names]
    joined = add_carry(rows, carry, KEY, ["_last", *carried], policy)
    at_border = F.coalesce(instant == F.col("_last"), F.lit(False))
    zero = F.lit(0)

    def addend(value: Column, kind: T.DataType) -> Column:
        # One digit less than the widest decimal, so that adding keeps the scale.
        if isinstance(kind, T.DecimalType):
            value = value.cast(T.DecimalType(min(kind.precision, 37), kind.scale))
        return F.coalesce(value, zero.cast(kind))

    def whole(name: str) -> Column:
        kind = rows.schema[name].dataType
        if isinstance(kind, T.DecimalType):
            kind = T.DecimalType(min(kind.precision, 37), kind.scale)
        here = addend(F.col(name), kind)
        before = addend(F.col(f"_before{name}"), kind)
        after = addend(F.when(at_border, F.col(f"_after{name}")), kind)
        return ((here + before).cast(kind) + after).cast(kind).alias(name)

    return joined.select("_leaves", "_row", *[whole(name) for name in names])


def with_velocity_flag(
    df: DataFrame,
    window: str = "1 minute",
    limit: int = 5,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """True where the customer has ``limit`` or more rows in the trailing window.

    Only rows are counted; amounts are not looked at.
    """
    return _running(df, window, policy, amounts=False).withColumn(
        "is_high_velocity", F.col("rolling_count") >= limit
    )
