"""Features of many run dates in one pass over the facts.

A fact row counts for the run dates between two: those after its time whose
window still reaches back to it. Numbering the dates, that is a range of
numbers, so the row is turned into a plus where the range begins and a minus
where it ends instead of being repeated for every date; pluses and minuses are
summed per customer and number, and a running sum over the dates gives each
date's count. A customer has at most one row per date there, however many facts
it has. What cannot be subtracted is handled on its own: a product is counted
while its ranges overlap, a session's length is a whole number of microseconds
that changes at the dates its events pass, the last order is a running maximum,
and money is summed per range before it is laid out over its dates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.functions.columns import days_between, lenient_double, ts_literal
from featuremart.operators.constants import COUNTED_TYPES, DEFAULT_WINDOWS, LENGTH_WINDOW, ORDER_WINDOW
from featuremart.plans.batch_features import contracted, customer_spine
from featuremart.sources.tables import CleanSources


# A row of all outputs takes about 300 bytes in each of two hash tables.
ROWS_PER_TASK = 200_000


class Dates:
    """The run dates in order, with the numbers that facts refer to."""

    def __init__(self, run_dates: Sequence[dt.datetime]) -> None:
        self.all = sorted(set(run_dates))
        self.column = F.array(*[ts_literal(d) for d in self.all])

    def first_after(self, time: Column) -> Column:
        """Number of the first date that is later than ``time``."""
        return F.size(F.filter(self.column, lambda d: d <= time))

    def end_of_window(self, time: Column, days: int) -> Column:
        """Number of the first date whose window of ``days`` begins after ``time``."""
        return F.size(F.filter(self.column, lambda d: d <= F.timestamp_add("DAY", F.lit(days), time)))


def _steps(rows: DataFrame, keys: Sequence[str], ranges: Sequence[tuple[str, str, dict[str, Column]]]) -> DataFrame:
    """Pluses and minuses: for every range (first, end, {output: value}) with a date
    in it, its values at ``first`` and their negatives at ``end``; one column an output."""
    outputs = [c for _, _, values in ranges for c in values]
    steps = []
    for first, end, values in ranges:
        for at, sign in ((first, 1), (end, -1)):
            mine = {c: (v * sign).cast("long") for c, v in values.items()}
            cells = [mine.get(c, F.lit(0).cast("long")).alias(c) for c in outputs]
            step = F.struct(F.col(at).alias("idx"), *cells)
            steps.append(F.when(F.col(first) < F.col(end), step))
    exploded = rows.select(*keys, F.explode(F.filter(F.array(*steps), lambda s: s.isNotNull())).alias("_s"))
    return exploded.select(*keys, "_s.*").groupBy(*keys, "idx").agg(*[F.sum(c).alias(c) for c in outputs])


def _event_steps(clean: CleanSources, dates: Dates, windows: Sequence[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps of event counts and of distinct products, and session lengths by the
    dates at which they change."""
    ts = F.col("timestamp")
    numbered = clean.events.withColumn("i", dates.first_after(ts)).withColumns({f"j{n}": dates.end_of_window(ts, n) for n in windows})
    ends = [f"j{n}" for n in windows]
    counts = [F.count_if(F.col("event_type") == t).alias(t) for t in COUNTED_TYPES]
    rollup = numbered.groupBy("session_id", "product_id", "i", *ends).agg(*counts, F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    owners = clean.sessions.where(F.col("customer_id").isNotNull()).select(
        F.col("session_id").alias("_sid"), "customer_id", dates.first_after(F.col("start_time")).alias("_from")
    )
    owned = rollup.join(owners, rollup["session_id"].eqNullSafe(owners["_sid"]))
    # an event belongs to its customer from the date on that knows the session
    owned = owned.withColumn("i", F.greatest("i", "_from"))
    per_type = owned.groupBy("customer_id", "i", *ends).agg(*[F.sum(t).alias(t) for t in COUNTED_TYPES])
    event_steps = _steps(per_type, ["customer_id"], [("i", f"j{n}", {f"{t}_{n}": F.col(t) for t in COUNTED_TYPES}) for n in windows])

    seen = owned.select("customer_id", "product_id", "i", *ends).distinct()
    covered = _steps(seen, ["customer_id", "product_id"], [("i", f"j{n}", {f"u{n}": F.lit(1)}) for n in windows])
    along = Window.partitionBy("customer_id", "product_id").orderBy("idx")
    has = {f"h{n}": (F.sum(f"u{n}").over(along.rowsBetween(Window.unboundedPreceding, 0)) > 0).cast("long") for n in windows}
    changes = covered.withColumns(has).select(
        "customer_id", "idx", *[(F.col(f"h{n}") - F.coalesce(F.lag(f"h{n}").over(along), F.lit(0))).alias(f"unique_products_{n}") for n in windows]
    )
    product_steps = changes.groupBy("customer_id", "idx").agg(*[F.sum(f"unique_products_{n}").alias(f"unique_products_{n}") for n in windows])
    spans = rollup.groupBy("session_id", "i").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    return event_steps, product_steps, spans


def _session_steps(clean: CleanSources, spans: DataFrame, dates: Dates, windows: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    start = F.col("start_time")
    ends = sorted({*windows, LENGTH_WINDOW})
    sessions = clean.sessions.where(F.col("customer_id").isNotNull()).select(
        "session_id", "customer_id", dates.first_after(start).alias("s"), *[dates.end_of_window(start, n).alias(f"j{n}") for n in ends]
    )
    per_range = sessions.groupBy("customer_id", "s", *[f"j{n}" for n in ends]).agg(F.count(F.lit(1)).alias("n"))
    counted = [("s", f"j{n}", {f"sessions_{n}": F.col("n")}) for n in windows]
    counted.append(("s", f"j{LENGTH_WINDOW}", {"_lengths": F.col("n")}))
    session_steps = _steps(per_range, ["customer_id"], counted)

    # a session's length holds from one date that its events pass to the next
    along = Window.partitionBy("session_id").orderBy("i")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    grown = spans.where(F.col("session_id").isNotNull()).withColumns(
        {
            "micros": F.timestamp_diff("MICROSECOND", F.min("first_ts").over(so_far), F.max("last_ts").over(so_far)),
            "next": F.coalesce(F.lead("i").over(along), F.lit(len(dates.all))),
        }
    )
    lengths = sessions.join(grown, "session_id").select(
        "customer_id", F.greatest("s", "i").alias("a"), F.least(F.greatest("s", "next"), F.col(f"j{LENGTH_WINDOW}")).alias("b"), "micros"
    )
    per_span = lengths.where("a < b").groupBy("customer_id", "a", "b").agg(F.sum("micros").alias("micros"))
    return session_steps, _steps(per_span, ["customer_id"], [("a", "b", {"_micros": F.col("micros")})])


def _order_rows(clean: CleanSources, dates: Dates) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps of order counts; sums of money per date; last order per date that it precedes."""
    t = F.col("order_time")
    usd = lenient_double("total_usd", clean.orders.schema["total_usd"].dataType)
    orders = clean.orders.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "order_time", usd.alias("usd"), dates.first_after(t).alias("i"), dates.end_of_window(t, ORDER_WINDOW).alias("j")
    )
    per_range = orders.groupBy("customer_id", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("usd").alias("usd"), F.max("order_time").alias("_last"))
    steps = _steps(per_range, ["customer_id"], [("i", "j", {f"orders_{ORDER_WINDOW}": F.col("n")})])
    laid = per_range.where("i < j").select("customer_id", "usd", F.explode(F.sequence(F.col("i"), F.col("j") - 1)).alias("idx"))
    money = laid.groupBy("customer_id", "idx").agg(F.sum("usd").alias("_usd"))
    last = per_range.where(F.col("i") < len(dates.all)).groupBy("customer_id", F.col("i").alias("idx")).agg(F.max("_last").alias("_last"))
    return steps, money, last


def _tasks(customers: DataFrame, dates: Dates) -> int:
    """Tasks of about ``ROWS_PER_TASK`` customers and dates."""
    spark = customers.sparkSession
    return max(-(-customers.count() * len(dates.all) // ROWS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))


def build_many(
    clean: CleanSources, run_dates: Sequence[dt.datetime], windows: Sequence[int] = DEFAULT_WINDOWS, zero_fill_conversions: bool = False
) -> DataFrame:
    """One row per customer and run date, equal to a build of each date alone.
    ``clean``: clean tables as of the latest date (or later)."""
    dates = Dates(run_dates)
    event_steps, product_steps, spans = _event_steps(clean, dates, windows)
    session_steps, length_steps = _session_steps(clean, spans, dates, windows)
    order_steps, money, last = _order_rows(clean, dates)
    each = F.explode(F.array(*[F.lit(k) for k in range(len(dates.all))])).alias("idx")
    grid = customer_spine(clean.customers).select("customer_id", each).withColumn("_wanted", F.lit(1))

    frames = [grid, event_steps, product_steps, session_steps, length_steps, order_steps, money, last]
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame, allowMissingColumns=True)
    # wide rows that shuffle small: tasks are sized by rows, and the running sums stay in them
    every = every.repartition(_tasks(clean.customers, dates), "customer_id")
    summed = [c for f in (event_steps, product_steps, session_steps, length_steps, order_steps) for c in f.columns if c not in ("customer_id", "idx")]
    per_date = every.where(F.col("idx") < len(dates.all)).groupBy("customer_id", "idx").agg(
        *[F.sum(c).alias(c) for c in summed], F.max("_wanted").alias("_wanted"), F.sum("_usd").alias("_usd"), F.max("_last").alias("_last")
    )
    # at most one row per date for each customer
    so_far = Window.partitionBy("customer_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    counts = {c: F.sum(c).over(so_far) for c in summed}
    wide = per_date.withColumns({**counts, "_last": F.max("_last").over(so_far)}).where(F.col("_wanted") == 1)
    run_date = F.element_at(dates.column, F.col("idx") + 1)
    orders = F.col(f"orders_{ORDER_WINDOW}")
    wide = wide.withColumns(
        {
            "run_date": run_date,
            f"avg_session_length_{LENGTH_WINDOW}": F.when(F.col("_lengths") > 0, F.coalesce(F.col("_micros"), F.lit(0)) / F.lit(1_000_000.0) / F.col("_lengths")),
            "days_since_last_purchase": days_between("_last", run_date),
            f"sum_total_usd_{ORDER_WINDOW}": F.when(orders > 0, F.col("_usd")),
            f"avg_total_usd_{ORDER_WINDOW}": F.when(orders > 0, F.col("_usd") / orders),
        }
    )
    return contracted(wide, windows, zero_fill_conversions)
