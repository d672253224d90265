"""Labelling of periodic series.

Rules, per group of (account, counterparty cluster), rows in order of date and
transaction key:

* For each period in search order, and each row that is in no cycle yet, in row
  order, try a series that starts at that row.
* The series' next member is the free row dated within ``period +- error`` of
  the last member whose amount is nearest to the mean amount of the members so
  far; on equal distance the earlier row.  No such row ends the series.
* A series of three or more rows is a cycle; a shorter one is forgotten.
* Cycles are numbered in the order found.  A group with more than ``cap``
  cycles keeps none.

How it is spread: a group is searched inside one task only while it has at most
``group_limit`` rows.  Bigger groups, found by counting first, never travel as
one value; see :func:`_label_large`.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

from cadenza.fixed import MAX_CYCLES_PER_GROUP, MIN_CYCLE_LENGTH, PERIODS
from cadenza.functions.keys import cycle_key, same_key
from cadenza.session import cut, work_path

GROUP = ["user_account_id", "counterparty_cluster"]
ROW = "transaction_pending_id"
GROUP_LIMIT = 50_000

# Days are counted in halves so that 30.5 and 91.5 days are whole numbers.
_HALF_DAYS = [(round(2 * period), 2 * error) for period, error, _ in PERIODS]
_SHORTEST_GAP = min(p - e for p, e in _HALF_DAYS)


def find_cycles(days, amounts, cap=MAX_CYCLES_PER_GROUP, periods=_HALF_DAYS, min_length=MIN_CYCLE_LENGTH):
    """Label one group: ``number * len(periods) + period`` per row, -1 for none.

    ``days`` are half days in ascending order.  Every next member lies later
    than the whole window of the one before (the errors are far below half a
    period), so a member is found by looking at its own date window only.  The
    search ends with the first cycle beyond ``cap``: no cycle survives then.
    """
    size = len(days)
    labels = [-1] * size
    found = 0
    for which, (period, error) in enumerate(periods):
        for start in range(size):
            if labels[start] >= 0:
                continue
            members, total = [start], amounts[start]
            while True:
                target = days[members[-1]] + period
                low = bisect_left(days, target - error)
                high = bisect_right(days, target + error, low)
                mean = total / len(members)
                best, nearest = None, float("inf")
                for row in range(low, high):
                    if labels[row] < 0:
                        distance = abs(amounts[row] - mean)
                        if distance < nearest:
                            best, nearest = row, distance
                if best is None:
                    break
                members.append(best)
                total += amounts[best]
            if len(members) >= min_length:
                if found >= cap:
                    return [-1] * size
                for row in members:
                    labels[row] = found * len(periods) + which
                found += 1
    return labels


def _labeller(cap: int):
    @F.arrow_udf(ArrayType(IntegerType()))
    def label(days: pa.Array, amounts: pa.Array) -> pa.Array:
        all_days = days.values.to_numpy(zero_copy_only=False).tolist()
        all_amounts = amounts.values.to_numpy(zero_copy_only=False).astype(float).tolist()
        labels, ends = [], [0]
        for day_0, day_1, amount_0, amount_1 in zip(
            days.offsets.to_pylist(),
            days.offsets.to_pylist()[1:],
            amounts.offsets.to_pylist(),
            amounts.offsets.to_pylist()[1:],
        ):
            if day_1 > day_0:
                labels += find_cycles(all_days[day_0:day_1], all_amounts[amount_0:amount_1], cap)
            ends.append(len(labels))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(labels, pa.int32()))

    return label


def _certainly_beyond(cap: int):
    """Does a group surely hold more than ``cap`` cycles, judged by day counts?

    Call a day robust when it has more than ``cap`` rows.  As long as at most
    ``cap`` cycles were taken, each took at most one row of a day, so a robust
    day still has a free row.  Take a robust day whose window holds a robust
    day, and let every non-empty day of that window have a robust day in its own
    window: each row tried as a start there reaches length three whichever
    amounts decide, and there are enough rows to exceed the cap.
    """

    @F.arrow_udf(BooleanType())
    def judge(days: pa.Array, counts: pa.Array) -> pa.Array:
        out = []
        for group_days, group_counts in zip(days, counts):
            day = group_days.values.to_numpy(zero_copy_only=False)
            robust = np.concatenate([[0], np.cumsum(group_counts.values.to_numpy(zero_copy_only=False) > cap)])
            heavy = np.diff(robust) > 0
            sure = False
            for period, error in _HALF_DAYS:
                low = np.searchsorted(day, day + period - error, "left")
                high = np.searchsorted(day, day + period + error, "right")
                goes_on = robust[high] > robust[low]
                dead = np.concatenate([[0], np.cumsum(~goes_on)])
                if np.any(heavy & goes_on & (dead[high] == dead[low])):
                    sure = True
                    break
            out.append(sure)
        return pa.array(out, pa.bool_())

    return judge


_REACH = ArrayType(
    StructType().add("which", IntegerType()).add("day", LongType()).add("start", BooleanType()).add("next", ArrayType(LongType()))
)


@F.arrow_udf(_REACH)
def _reach(days: pa.Array) -> pa.Array:
    """The days of a group that a cycle could need, judged by dates alone: per period (``which``)
    those on which two further members may follow (``start``), the days of their windows, and
    the days of the windows of these.  ``next`` are the days in the window of a day.

    A member that has a next one after its next one is a possible start too, so the windows
    of all members of all cycles are whole.
    """
    ends = days.offsets.to_numpy()
    group = np.repeat(np.arange(len(days)), np.diff(ends))
    day = days.values.slice(ends[0], ends[-1] - ends[0])
    known = day.is_valid().to_numpy(zero_copy_only=False)
    group, day = group[known], day.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    # Groups lie one behind the other, further apart than any window reaches.
    apart = (day.max() - day.min() if len(day) else 0) + max(p + e for p, e in _HALF_DAYS) + 1
    line = group * apart + day
    found = []
    for which, (period, error) in enumerate(_HALF_DAYS):
        low = np.searchsorted(line, line + period - error, "left")
        high = np.searchsorted(line, line + period + error, "right")

        def into_windows(some):
            step = np.zeros(len(line) + 1, np.int64)
            np.add.at(step, low[some], 1)
            np.add.at(step, high[some], -1)
            return np.cumsum(step)[:-1] > 0

        goes_on = np.concatenate([[0], np.cumsum(high > low)])
        start = goes_on[high] > goes_on[low]
        second = into_windows(start)
        needed = np.flatnonzero(start | second | into_windows(second))
        sizes = (high - low)[needed]
        at = np.arange(sizes.sum()) + np.repeat(low[needed] - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
        found.append((group[needed], np.full(len(needed), which), day[needed], start[needed], sizes, day[at]))
    groups = np.concatenate([f[0] for f in found])
    order = np.argsort(groups, kind="stable")
    which, on, start, sizes = (np.concatenate([f[i] for f in found]) for i in range(1, 5))
    after = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate([f[5] for f in found]), pa.int64())
    )
    rows = pa.StructArray.from_arrays(
        [pa.array(which, pa.int32()), pa.array(on, pa.int64()), pa.array(start, pa.bool_()), after], ["which", "day", "start", "next"]
    ).take(pa.array(order))
    counts = np.bincount(groups, minlength=len(days))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), rows)


def _half_day(date: str = "date") -> Column:
    return 2 * F.unix_date(F.col(date))


def _decoded(df: DataFrame, code: str) -> DataFrame:
    """Turn a label code into ``cycle_id`` and ``cycle_period``."""
    number = F.floor(F.col(code) / len(PERIODS)).cast("int")
    period = F.element_at(
        F.array(*[F.lit(float(p)) for p, _, _ in PERIODS]),
        (F.pmod(F.col(code), F.lit(len(PERIODS))) + 1).cast("int"),
    )
    hit = F.col(code) >= 0
    return (
        df.withColumn("cycle_id", F.when(hit, cycle_key(F.col(GROUP[0]), F.col(GROUP[1]), number)))
        .withColumn("cycle_period", F.when(hit, period))
        .drop(code)
    )


def _label_bounded(df: DataFrame, cap: int, columns: list[str]) -> DataFrame:
    """Label groups known to be small: one shuffle, arrays in the JVM, and only
    days and amounts of groups that could hold a cycle cross into Python."""
    # The row's key comes first, as it orders the rows of a day.
    rest = [ROW, *(c for c in columns if c not in (*GROUP, ROW))]
    grouped = df.groupBy(*GROUP).agg(
        F.array_sort(F.collect_list(F.struct(_half_day().alias("_day"), F.struct(*rest).alias("_all")))).alias("_rows")
    )
    days = F.col("_rows._day")
    possible = (F.size(days) >= MIN_CYCLE_LENGTH) & (
        F.element_at(days, -1) - F.element_at(days, 1) >= (MIN_CYCLE_LENGTH - 1) * _SHORTEST_GAP
    )
    labelled = grouped.withColumn(
        "_codes",
        _labeller(cap)(F.when(possible, days), F.when(possible, F.col("_rows._all.signed_amount"))),
    )
    rows = labelled.select(*GROUP, F.posexplode("_rows._all").alias("_at", "_one"), "_codes").select(
        *GROUP, "_one.*", F.get("_codes", F.col("_at")).alias("_code")
    )
    return _decoded(rows, "_code").select(*columns, "cycle_id", "cycle_period")


def label_cycles(
    df: DataFrame,
    *,
    cap: int = MAX_CYCLES_PER_GROUP,
    search_noise: bool = True,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add ``cycle_id`` and ``cycle_period`` to every row, losing none.

    Needs ``user_account_id``, ``counterparty_cluster``,
    ``transaction_pending_id``, ``date`` and ``signed_amount``; all other columns
    pass through.  ``search_noise=False`` leaves cluster -1 unlabelled.
    """
    columns = df.columns
    searched, skipped = df, None
    if not search_noise:
        noise = F.coalesce(F.col(GROUP[1]), F.lit(0)) == -1
        searched, skipped = df.where(~noise), df.where(noise)

    # Counting is cheap (partial sums), and says which groups are too big.
    large = cut(searched.groupBy(*GROUP).count().where(F.col("count") > group_limit).select(*GROUP))
    if large.isEmpty():
        result = _label_bounded(searched, cap, columns)
    else:
        small_rows, large_rows = _apart(searched, large)
        result = _label_bounded(small_rows, cap, columns).unionByName(
            _label_large(large_rows, cap, group_limit, columns)
        )
    if skipped is not None:
        result = result.unionByName(
            skipped.withColumn("cycle_id", F.lit(None).cast("string")).withColumn(
                "cycle_period", F.lit(None).cast("double")
            )
        )
    return result


def _apart(df: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all groups but ``large``, and those of ``large``: made once, stored in two folders."""
    marked = df.alias("s").join(large.withColumn("_large", F.lit(1)).alias("l"), same_key("s", "l", GROUP), "left")
    marked = marked.select("s.*", F.coalesce("_large", F.lit(0)).alias("_large"))
    path = work_path(df.sparkSession, "groups")
    marked.write.partitionBy("_large").parquet(path)
    rows = df.sparkSession.read.schema(marked.schema).parquet(path)
    return tuple(rows.where(F.col("_large") == i).drop("_large") for i in (0, 1))


def _one_group() -> Column:
    """A group as one text, never null."""
    return F.concat_ws("\u0001", GROUP[0], F.coalesce(F.col(GROUP[1]).cast("string"), F.lit("\u0002")))


def _label_large(df: DataFrame, cap: int, group_limit: int, columns: list[str]) -> DataFrame:
    """Label groups of any size without bringing one together.

    Rows of equal key and date are told apart by a number, in the order that the
    search in one piece gives them.

    1. Of rows alike in group, day and amount only the first ``cap + 1`` can
       matter: they are interchangeable but for their order, at most ``cap``
       cycles take one of them each, and one more would exceed the cap.
    2. Day counts of the rows left prove most big groups to exceed the cap.
    3. Groups that became small enough are searched like any other.
    4. In the rest all starts of a period are judged at once
       (:func:`_search_in_rounds`).  Only rows of days that a cycle could need by
       its dates (:func:`_reach`) are brought there.

    The rows are shuffled twice: to fetch those of days that matter, and to put the labels on.
    """
    rest = [c for c in columns if c not in GROUP]
    df = df.withColumn("g", _one_group())
    # A row without an amount is never the nearest, and a series from it stops.
    given = F.col("signed_amount").isNotNull() & ~F.isnan("signed_amount")
    kinds = df.where(given).groupBy("g", _half_day().alias("_day"), "signed_amount").count()
    per_day = kinds.groupBy("g", "_day").agg(F.sum(F.least("count", F.lit(cap + 1))).alias("count"))
    histogram = per_day.groupBy("g").agg(
        F.array_sort(F.collect_list(F.struct("_day", "count"))).alias("_h"),
        F.sum("count").alias("_size"),
    )
    days = F.col("_h._day")
    is_open = histogram.select(
        "g", "_size", days.alias("_days"), _certainly_beyond(cap)(days, F.col("_h.count")).alias("_beyond")
    ).where(~F.col("_beyond"))
    small = F.col("_size") <= group_limit
    # The days of groups that fit are all needed, and stand for no period.
    whole = F.transform("_days", lambda d: F.struct(
        F.lit(-1).alias("which"), d.cast("bigint").alias("day"), F.lit(False).alias("start"), F.array().cast("array<bigint>").alias("next")
    ))
    # A udf in a branch would see all rows, so days are taken from those that need none.
    reach = _reach(F.when(~small, F.col("_days")).otherwise(F.array().cast("array<int>")))
    near = cut(is_open.select("g", F.inline(F.concat(F.when(small, whole).otherwise(F.array().cast(_REACH)), reach))))

    def numbered(rows: DataFrame) -> DataFrame:
        repeats = Window.partitionBy("g", "date", ROW).orderBy(F.struct(*rest))
        return rows.withColumn("_again", F.row_number().over(repeats))

    wanted = near.select("g", F.date_from_unix_date((F.col("day") / 2).cast("int")).alias("date")).distinct()
    slim = numbered(df.join(wanted, ["g", "date"], "left_semi")).where(given).select("g", *GROUP, ROW, "date", "signed_amount", "_again")
    alike = Window.partitionBy("g", "date", "signed_amount").orderBy(ROW, "_again")
    thin = cut(slim.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= cap + 1).drop("_n"))

    # Here the number of a repeat is part of the key, and orders like it.
    fits = thin.join(near.where("which = -1").select("g").distinct(), "g", "left_semi").select(
        *GROUP, F.struct(ROW, "_again").alias(ROW), "date", "signed_amount"
    )
    labels = _label_bounded(fits, cap, fits.columns).where(F.col("cycle_id").isNotNull())
    labels = labels.select(*GROUP, F.col(ROW).alias("_key"), "date", "cycle_id", "cycle_period")
    huge = near.where("which >= 0")
    if not huge.isEmpty():
        labels = labels.unionByName(_search_in_rounds(thin, cap, huge))

    # A cycle has one row of a day at most, so a key and date have few labels.  They are joined by
    # what the rows are numbered by, so the rows are shuffled once for both.
    one = F.struct(F.col("_key._again").alias("again"), "cycle_id", "cycle_period")
    labels = (
        labels.where(F.col(GROUP[0]).isNotNull())
        .select(_one_group().alias("g"), "date", F.col(f"_key.{ROW}").alias(ROW), one.alias("one"))
        .groupBy("g", "date", ROW)
        .agg(F.collect_list("one").alias("_labels"))
    )
    mine = F.get(F.filter("_labels", lambda label: label["again"] == F.col("_again")), F.lit(0))
    return (
        numbered(df)
        .join(labels, ["g", "date", ROW], "left")
        .withColumn("_mine", mine)
        .select(*columns, F.col("_mine.cycle_id").alias("cycle_id"), F.col("_mine.cycle_period").alias("cycle_period"))
    )


def _search_in_rounds(thin: DataFrame, cap: int, near: DataFrame | None = None) -> DataFrame:
    """The same greedy search over all groups at once, in a bounded number of rounds.

    A start that fails leaves no trace, so all free starts of a period are judged
    against the same used rows: its second member is the nearest amount in its
    window, and a third exists if any free row lies in the second's window.  The
    first start that reaches three opens the next cycle, those before it are done.
    A group finds ``cap + 1`` cycles at most, and the calendar bounds the members
    of each, so rounds do not grow with the rows.

    ``near`` names the days that each period needs of a group (:func:`_reach`); without it all
    rows are read in each period.
    """
    rows = thin.select(
        *GROUP,
        _half_day().cast("bigint").alias("day"),
        F.struct(ROW, "_again").alias("key"),
        F.col("signed_amount").alias("amount"),
        _one_group().alias("g"),
    )
    names = cut(rows.select("g", *GROUP).distinct())
    rows = rows.select("g", "day", "key", "amount")
    key = dict(rows.dtypes)["key"]
    used = cut(rows.limit(0).select("g", "day", "key", F.lit(0).alias("code")))
    found = cut(names.select("g", F.lit(0).alias("found")))

    for which, (period, error) in enumerate(_HALF_DAYS):
        after = found.select("g", F.lit(None).cast(f"struct<day:bigint,key:{key}>").alias("after"))
        open_groups = found.where(F.col("found") <= cap)
        if near is None:
            mine = rows.withColumns({"start": F.lit(True), "next": _window(F.col("day"), period, error)})
        else:
            mine = rows.join(near.where(F.col("which") == which).drop("which"), ["g", "day"])
        free = cut(mine.join(open_groups, "g", "left_semi").join(used, ["g", "day", "key"], "left_anti"))
        while True:
            first = cut(_first_start(free, after, period, error))
            if first.isEmpty():
                break
            # One cycle more than the cap: it need not be followed, none is kept.
            more = cut(first.join(found, "g").where(F.col("found") < cap).select("g", "start", "amount"))
            # A group without a start has none later in this period, so only these go on.
            free = cut(free.join(more, "g", "left_semi"))
            members = _followed(more, free, period, error)
            code = (F.col("found") * len(PERIODS) + which).cast("int").alias("code")
            used = cut(used.unionByName(members.join(found, "g").select("g", "day", "key", code)))
            found = cut(
                found.join(first.select("g", F.lit(1).alias("one")), "g", "left").select(
                    "g", (F.col("found") + F.coalesce("one", F.lit(0))).alias("found")
                )
            )
            after = more.select("g", F.col("start").alias("after"))
            free = cut(free.join(members, ["g", "day", "key"], "left_anti"))

    kept = used.join(found.where(F.col("found") <= cap), "g", "left_semi").join(names, "g")
    return _decoded(
        kept.select(
            *GROUP, F.col("key").alias("_key"), F.date_from_unix_date((F.col("day") / 2).cast("int")).alias("date"), "code"
        ),
        "code",
    )


def _window(day: Column, period: int, error: int) -> Column:
    """The days of a window in half days: whole days are the even ones."""
    low, high = period - error, period + error
    return F.sequence(day + (low + low % 2), day + high, F.lit(2).cast("bigint"))


def _first_start(free: DataFrame, after: DataFrame, period: int, error: int) -> DataFrame:
    """(g, start, amount): per group the first free row past ``after`` that begins a cycle."""
    kinds = free.groupBy("g", "day", "amount").agg(F.min(F.struct("key", "next")).alias("row"))
    kinds = kinds.select("g", "day", "amount", "row.key", "row.next")
    place = F.struct("day", "key")
    starts = free.where("start").join(after, "g").where(F.col("after").isNull() | (place > F.col("after")))
    starts = starts.groupBy("g", "day", "amount").agg(F.min(F.struct("key", "next")).alias("row"))
    # Stored, as few starts have a row in their window: rows of other days need not be sorted.
    asked = cut(
        starts.select(
            "g",
            F.struct("day", "row.key", "amount").alias("start"),
            F.explode("row.next").alias("day"),
            F.col("amount"),
        )
    )
    kinds = kinds.join(asked, ["g", "day"], "left_semi")
    none = F.lit(None)
    types = dict(kinds.dtypes)
    both = kinds.select("g", "day", "amount", "key", "next", none.cast(dict(asked.dtypes)["start"]).alias("start"), F.lit(0).alias("asks")).unionByName(
        asked.select("g", "day", "amount", *(none.cast(types[c]).alias(c) for c in ("key", "next")), "start", F.lit(1).alias("asks"))
    )
    row = F.when(F.col("asks") == 0, F.struct("amount", "key", "next"))
    up = Window.partitionBy("g", "day").orderBy("amount", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("g", "day").orderBy(F.desc("amount"), "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.select(
        "g", "day", "start", "amount", F.last(row, True).over(up).alias("below"), F.last(row, True).over(down).alias("above")
    ).where(F.col("start").isNotNull())
    second = (
        near.select("g", "day", "start", "amount", F.explode(F.array("below", "above")).alias("hit"))
        .where(F.col("hit").isNotNull())
        .groupBy("g", "start")
        .agg(F.min(F.struct(F.abs(F.col("hit.amount") - F.col("amount")).alias("d"), "day", "hit.key", "hit.next"))["next"].alias("then"))
    )
    # A third member may be any free row of the second one's window.
    third = second.select("g", "start", F.explode("then").alias("day")).join(
        free.select("g", "day").distinct(), ["g", "day"], "left_semi"
    )
    best = third.groupBy("g").agg(F.min("start").alias("s"))
    return best.select("g", F.struct("s.day", "s.key").alias("start"), F.col("s.amount").alias("amount"))


def _followed(first: DataFrame, free: DataFrame, period: int, error: int) -> DataFrame:
    """(g, day, key) of all members of the cycles that begin at ``first``."""
    ends = cut(first.select("g", F.col("start.day").alias("day"), F.col("start.key").alias("key"), F.col("amount").alias("total"), F.lit(1).alias("n")))
    members = ends.select("g", "day", "key")
    while not ends.isEmpty():
        windows = ends.select(
            "g", "total", "n", F.explode(_window(F.col("day"), period, error)).alias("day")
        )
        distance = F.abs(F.col("amount") - F.col("total") / F.col("n"))
        hits = free.join(windows, ["g", "day"]).groupBy("g", "total", "n")
        hits = hits.agg(F.min(F.struct(distance.alias("d"), "day", "key", "amount")).alias("hit"))
        ends = cut(hits.select("g", "hit.day", "hit.key", (F.col("total") + F.col("hit.amount")).alias("total"), (F.col("n") + 1).alias("n")))
        members = members.unionByName(ends.select("g", "day", "key"))
    return members


def cap_cycles(df: DataFrame, group: list[str], cycle: str = "cycle_id", cap: int = MAX_CYCLES_PER_GROUP) -> DataFrame:
    """A3 on given labels: null them in groups with more than ``cap`` cycles.

    Two partial aggregations find the groups (a hot group shrinks to its cycles
    before it is shuffled); only those few come back to the rows.
    """
    over = (
        df.where(F.col(cycle).isNotNull())
        .groupBy(*group, cycle)
        .agg(F.lit(1).alias("_one"))
        .groupBy(*group)
        .count()
        .where(F.col("count") > cap)
        .select(*group)
    )
    kept = F.when(F.col("o." + group[0]).isNull(), F.col("r." + cycle))
    return df.alias("r").join(over.alias("o"), same_key("r", "o", group), "left").select(
        *[kept.alias(c) if c == cycle else F.col("r." + c) for c in df.columns]
    )


def summarise_cycles(labelled: DataFrame) -> DataFrame:
    """One row per cycle: account, cluster, period, length, span, mean amount."""
    return (
        labelled.where(F.col("cycle_id").isNotNull())
        .groupBy(*GROUP, "cycle_id", "cycle_period")
        .agg(
            F.count("*").alias("n_transactions"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.round(F.avg("signed_amount"), 9).alias("mean_amount"),
        )
    )
