"""Runs of blocked and of workable operational hours.

A run never has to fit its series into one task. Every series is cut at UTC
month boundaries: runs are found inside each (site, month) piece, and only the
first and last run of a piece take part in joining the pieces up again.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from workwindow.functions.expr import flag, hours_between, present
from workwindow.operators.classify import VERDICTS, scenario_states
from workwindow.operators.counts import keys_of

GAP_FACTOR = 1.5
ONE_SITE = "single-site"
BASELINE = "baseline"
SERIES = ("site_id", "scenario_id")
PIECE = ("site_id", "scenario_id", "_month")


def _flag_columns(hourly: DataFrame, given: dict[str, str | None]) -> dict[str, str]:
    """Names of the flag columns; packed tables have their flags in the verdicts."""
    if VERDICTS in hourly.columns:
        return {}
    fallback = {"operational_col": "is_operational", "workable_col": "is_workable"}
    preferred = {"operational_col": "operational_flag", "workable_col": "workable_flag"}
    names = {}
    for role, name in given.items():
        choices = (name,) if name else (preferred[role], fallback[role])
        found = present(hourly, choices)
        if not found:
            raise ValueError(f"missing column {choices[0]!r}")
        names[role] = found[0]
    return names


def operational_steps(
    hourly: DataFrame,
    time_utc_col: str = "time_utc",
    operational_col: str | None = None,
    workable_col: str | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """Operational time steps, one ``step`` struct per row, by site and month.

    A step is a time with the states of its operational scenarios. Equal steps
    become one row with a count, combined on the map side, so repeats of one
    timestamp never pile up. The second exchange puts each (site, month) piece
    into one partition. Its readers use whole structs, hence the same columns,
    and the null tests that joins would infer on one side only are made here, so
    Spark runs it once for all of them. A row without site or time belongs to no
    series.
    """
    given = {"operational_col": operational_col, "workable_col": workable_col}
    states = scenario_states(hourly, **_flag_columns(hourly, given))
    named = F.transform(
        F.filter(states, lambda s: s.op),
        lambda s: F.struct(
            (s.scenario_id if _has_scenarios(hourly) else F.lit(BASELINE)).alias("scenario_id"),
            s.wk.alias("workable"),
        ),
    )
    placed = "_month" in hourly.columns
    site = F.col("site_id") if "site_id" in hourly.columns else F.lit(ONE_SITE)
    t = F.col(time_utc_col)
    # hours outside of the week have no states: told by the flag before any are made
    inside = hourly.filter("operational_flag") if VERDICTS in hourly.columns else hourly
    steps = (
        inside.select(
            site.alias("site_id"),
            (F.col("_month") if placed else F.year(t) * 12 + F.month(t)).alias("_month"),
            t.alias("time_utc"),
            named.alias("states"),
        )
        .filter(F.size("states") > 0)
        .withColumns({} if placed else {c: _never_null(c) for c in ("site_id", "time_utc")})
        # said here, so that both readers of these rows are planned alike and share them
        .filter("site_id IS NOT NULL AND _month IS NOT NULL AND time_utc IS NOT NULL")
        .groupBy("site_id", "_month", "time_utc", "states")
        .agg(F.count("*").alias("n_steps"))
    )
    if watch is not None:
        steps = steps.observe(watch, F.coalesce(F.sum(F.col("n_steps") - 1), F.lit(0)).alias("repeated"))
    step = F.struct("time_utc", "states", "n_steps").alias("step")
    steps = steps.select("site_id", "_month", step)
    return steps if placed else steps.repartition("site_id", "_month")


def _never_null(name: str) -> Column:
    return F.coalesce(name, F.raise_error(F.lit(f"{name} must not be null")))


def _has_scenarios(hourly: DataFrame) -> bool:
    return VERDICTS in hourly.columns or "scenario_id" in hourly.columns


def gap_histogram(steps: DataFrame) -> DataFrame:
    """How often each gap between neighbouring times occurs in a site: (site_id, gap, n) and
    the first and last month of those gaps.

    Gaps are counted inside each (site, month) piece first. The first step of a piece has
    none there; its gap leads from the last step of the months before. Scenarios that
    share a timestamp give gaps of 0, the first step of a site has none.
    """
    in_piece = Window.partitionBy("site_id", "_month").orderBy("step.time_utc")
    gap = hours_between(F.lag("step").over(in_piece).time_utc, F.col("step.time_utc"))
    counted = (
        steps.withColumn("gap", gap)
        .groupBy("site_id", "_month", "gap")
        .agg(F.count("*").alias("n"), F.min("step.time_utc").alias("first"), F.max("step.time_utc").alias("last"))
    )
    in_order = Window.partitionBy("site_id").orderBy("_month", "gap")
    before = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.coalesce("gap", hours_between(before, F.col("first")))
    return (
        counted.withColumn("gap", whole)
        .groupBy("site_id", "gap")
        .agg(F.sum("n").alias("n"), F.min("_month").alias("_from"), F.max("_month").alias("_to"))
    )


def _site_steps(histogram: DataFrame) -> DataFrame:
    """Time step of each site, the median of its positive gaps by prefix counts over the
    merged histogram, and the months it spans."""
    whole_site = Window.partitionBy("site_id")
    upto = whole_site.orderBy("gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = F.when(F.col("gap") > 0, F.col("n")).otherwise(0)
    ranked = histogram.withColumns(
        {"_upto": F.sum(counted).over(upto), "_middle": (F.sum(counted).over(whole_site) - 1) / 2}
    )
    lower = F.min(F.when(F.col("_upto") > F.floor("_middle"), F.col("gap")))
    upper = F.min(F.when(F.col("_upto") > F.ceil("_middle"), F.col("gap")))
    return ranked.groupBy("site_id").agg(
        F.coalesce((lower + upper) / 2, F.lit(1.0)).alias("step_hours"),
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
    )


def timestep_hours(hourly: DataFrame, **columns: str) -> DataFrame:
    """Median gap between distinct operational timestamps per site; 1.0 without any gap."""
    sites = _site_steps(gap_histogram(operational_steps(hourly, **columns)))
    out = sites.select("site_id", F.col("step_hours").alias("timestep_hours"))
    return out if "site_id" in hourly.columns else out.drop("site_id")


def _breaks(earlier: Column, later: Column, step: Column) -> Column:
    return hours_between(earlier, later) > step * GAP_FACTOR


def _piece_runs(steps: DataFrame) -> DataFrame:
    """Runs inside each piece, one ``run`` struct per row, numbered from 1."""
    # Hash joins on the piece keys: the big side stays where its exchange put it.
    sites = _site_steps(gap_histogram(steps))
    months = F.explode(F.sequence("_from", "_to")).alias("_month")
    pieces = sites.select("site_id", months, "step_hours").hint("shuffle_hash")
    timed = (
        steps.join(pieces, ["site_id", "_month"])
        .select("site_id", "_month", "step.*", "step_hours")
        .select("site_id", "_month", "time_utc", F.inline("states"), "n_steps", "step_hours")
        .withColumn("scenario_id", _never_null("scenario_id"))
    )
    in_order = Window.partitionBy(*PIECE).orderBy("time_utc", "workable")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("time_utc").over(in_order)
    starts = (
        before.isNull()
        | (F.lag("workable").over(in_order) != F.col("workable"))
        | _breaks(before, F.col("time_utc"), F.col("step_hours"))
    )
    runs = (
        timed.withColumn("_starts", starts.cast("bigint"))
        .withColumn("part", F.sum("_starts").over(so_far))
        .groupBy(*PIECE, "part")
        .agg(
            F.min("time_utc").alias("start_ts"),
            F.max("time_utc").alias("end_ts"),
            F.first("workable").alias("workable"),
            F.sum("n_steps").alias("n_steps"),
            F.first("step_hours").alias("step_hours"),
        )
    )
    run = F.struct("part", "start_ts", "end_ts", "workable", "n_steps", "step_hours").alias("run")
    return runs.select(*PIECE, run).repartition(*PIECE)


def runs_of(steps: DataFrame) -> DataFrame:
    """All runs of ``operational_steps`` with their id; ids count up per site in (scenario,
    time) order."""
    parts = _piece_runs(steps)
    edges = parts.groupBy(*PIECE).agg(
        F.count("*").alias("n_parts"), F.min("run").alias("first"), F.max("run").alias("last")
    )
    last = F.lag("last").over(Window.partitionBy(*SERIES).orderBy("_month"))
    continues = (last.workable == F.col("first.workable")) & ~_breaks(
        last.end_ts, F.col("first.start_ts"), F.col("first.step_hours")
    )
    earlier = (
        Window.partitionBy("site_id")
        .orderBy("scenario_id", "_month")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per piece: at most scenarios x months for a site.
    new_parts = F.sum(F.col("n_parts") - F.col("continues")).over(earlier)
    offsets = (
        edges.repartition("site_id")
        .withColumn("continues", flag(continues).cast("bigint"))
        .withColumn("offset", F.coalesce(new_parts, F.lit(0)) - F.col("continues"))
        .select(*PIECE, "offset")
    )
    return (
        parts.join(offsets.hint("shuffle_hash"), list(PIECE))
        .select(*SERIES, "run.*", "offset")
        .groupBy(*SERIES, (F.col("offset") + F.col("part")).alias("streak_id"))
        .agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            (F.sum("n_steps") * F.first("step_hours")).alias("duration_hours"),
            F.first("workable").alias("workable"),
        )
    )


def operational_runs(hourly: DataFrame, watch: Observation | None = None, **columns: str) -> DataFrame:
    """Every run of operational hours with the same workable flag.

    A run ends where the flag flips or where the gap to the next step exceeds
    1.5 time steps. Its length is steps x time step, and ``end_ts`` is the start
    of its last step. At equal times blocked steps come before workable ones.
    """
    runs = runs_of(operational_steps(hourly, watch=watch, **columns))
    return runs if "site_id" in hourly.columns else runs.drop("site_id")


def _streaks(runs: DataFrame, workable: bool) -> DataFrame:
    wanted = F.col("workable") if workable else ~F.col("workable")
    return runs.filter(wanted).select(
        *keys_of(runs), "streak_id", "start_ts", "end_ts", "duration_hours"
    )


def streaks_nonworkable(runs: DataFrame) -> DataFrame:
    return _streaks(runs, workable=False)


def streaks_workable(runs: DataFrame) -> DataFrame:
    return _streaks(runs, workable=True)


def streaks_summary(runs: DataFrame) -> DataFrame:
    """Counts and lengths per scenario; scenarios without a blocked run have no row."""
    blocked = F.when(~F.col("workable"), F.col("duration_hours"))
    workable = F.when(F.col("workable"), F.col("duration_hours"))
    figures: dict[str, Column] = {
        "n_blocked_streaks": F.count(blocked),
        "longest_blocked_hours": F.max(blocked),
        "p50_blocked_hours": F.percentile(blocked, 0.5),
        "p90_blocked_hours": F.percentile(blocked, 0.9),
    }
    for hours in (6, 12, 24):
        figures[f"count_blocked_ge_{hours}h"] = F.count_if(blocked >= hours)
    figures["n_workable_streaks"] = F.count(workable)
    lengths = {
        "longest_workable_hours": F.max(workable),
        "p50_workable_hours": F.percentile(workable, 0.5),
        "p90_workable_hours": F.percentile(workable, 0.9),
    }
    figures.update({name: F.coalesce(c, F.lit(0.0)) for name, c in lengths.items()})
    return (
        runs.groupBy(*keys_of(runs))
        .agg(*(c.alias(name) for name, c in figures.items()))
        .filter(F.col("n_blocked_streaks") > 0)
    )


def top_blocked_streaks(runs: DataFrame, n: int = 10) -> DataFrame:
    """The longest blocked runs, ties broken by site, scenario and id."""
    blocked = streaks_nonworkable(runs)
    return blocked.orderBy(F.desc("duration_hours"), *keys_of(runs), "streak_id").limit(n)
