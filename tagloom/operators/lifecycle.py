"""Customer lifecycle: operating codes 50100-50108, their change log, and daily and weekly steps."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS, NEVER
from tagloom.functions.columns import all_of, any_of, day, days_before, holds, tenant_date
from tagloom.operators.keyed import best_by_group, salted_join

WEEK = ["fin_year", "fin_month", "fin_week"]

def never() -> Column:
    return day(NEVER)


# -- activity -----------------------------------------------------------------
def activity_rows(login: DataFrame, deposits: DataFrame, bets: DataFrame) -> DataFrame:
    """Logins, deposits and bets as one list: one row per member and day."""
    nothing = {"login_date": F.lit(None).cast("date"), "activated": F.lit(None).cast("date"),
               "deposit_count": F.lit(0).cast("long"), "wagers_total": F.lit(0).cast("long")}

    def rows(df, **given):
        return df.select(*KEYS, "data_date", *[c.alias(n) for n, c in {**nothing, **given}.items()])

    paid = deposits.filter((F.col("deposit_count") != 0) | (F.col("deposit_amount") != 0))
    union = (
        rows(login, login_date=F.col("data_date"))
        .unionByName(rows(paid, activated=F.col("data_date"), deposit_count=F.col("deposit_count")))
        .unionByName(rows(bets, activated=F.col("data_date"), wagers_total=F.col("wagers_total")))
    )
    return union.groupBy(*KEYS, "data_date").agg(*_totals())


def _new_activity(
    login: DataFrame, deposits: DataFrame, bets: DataFrame, start: date, end: date, state: DataFrame | None
) -> DataFrame:
    """Activity up to ``end``; with the state of the days before ``start``, that of the range."""
    inside = F.col("data_date") <= day(end) if state is None else F.col("data_date").between(day(start), day(end))
    return activity_rows(*[df.filter(inside) for df in (login, deposits, bets)])


def _totals() -> list[Column]:
    return [
        F.max("login_date").alias("login_date"), F.max("activated").alias("activated"),
        F.sum("deposit_count").alias("deposit_count"), F.sum("wagers_total").alias("wagers_total"),
    ]


def user_operate(login: DataFrame, deposits: DataFrame, bets: DataFrame, start: date, end: date) -> DataFrame:
    """Last login, last active day, deposits and wagers per member in the range.

    One union and one grouping: a member without logins still gives one row.
    """
    def inside(df):
        return df.filter(F.col("data_date").between(day(start), day(end)))

    return (
        activity_rows(inside(login), inside(deposits), inside(bets))
        .groupBy(*KEYS).agg(*_totals())
        .select(
            *KEYS, F.coalesce("login_date", never()).alias("last_login_date"),
            F.coalesce("activated", never()).alias("activated_date"), "deposit_count", "wagers_total")
    )


def lifecycle_members(members: DataFrame, start: date, end: date) -> DataFrame:
    """Members by registration day as the tenants count it."""
    registered = tenant_date(F.col("register_date"))
    return members.select(*KEYS, "user_name", registered.alias("register_day")).filter(
        F.col("register_day").between(day(start), day(end)))


# -- codes --------------------------------------------------------------------
def lifecycle_code(on: Column, activated: Column, visited: Column, deposits: Column, wagers: Column) -> Column:
    """Operating code on a day, first match from the top."""
    idle = F.date_sub(on, 14)
    gone = F.date_sub(on, 60)
    regular = (deposits >= 3) & (wagers > 0)
    some = (deposits > 0) & (wagers > 0)
    return (
        F.when((activated == never()) & (visited < gone), C.DORMANT_VISITOR)
        .when((activated == never()) & (visited >= gone), C.VISITOR)
        .when((activated < gone) & ((deposits > 0) | (wagers > 0)), C.ARCHIVED)
        .when((activated < idle) & regular, C.POTENTIAL)
        .when((activated < idle) & some, C.LEAVING)
        .when(activated < idle, C.LOST)
        .when(regular, C.ACTIVE)
        .when(some, C.NEW)
        .otherwise(C.ADDICT)
    )


def lifecycle_tag(members: DataFrame, operate: DataFrame, as_of: date) -> DataFrame:
    """Code of every member on one day. ``members`` as from :func:`lifecycle_members`."""
    joined = members.join(operate, KEYS, "left").select(
        *KEYS, "user_name",
        F.greatest(F.col("register_day"), F.coalesce("last_login_date", never())).alias("visited_date"),
        F.coalesce("activated_date", never()).alias("activated_date"),
        F.coalesce("deposit_count", F.lit(0)).alias("deposit_count"),
        F.coalesce("wagers_total", F.lit(0)).alias("wagers_total"))
    return joined.withColumn("tag_code", lifecycle_code(
        day(as_of), F.col("activated_date"), F.col("visited_date"), F.col("deposit_count"), F.col("wagers_total")))


def lifecycle_changes(
    login: DataFrame, deposits: DataFrame, bets: DataFrame, members: DataFrame, start: date, end: date,
    floor: date = date(2021, 1, 1), previous: DataFrame | None = None, state: DataFrame | None = None, activity: DataFrame | None = None,
) -> DataFrame:
    """Members whose code differs from the day before, for every day of the range.

    Between two active days the code can change only when 14 or 60 days have
    passed since the last active day or visit. So instead of a member x day
    grid, each active day yields itself and those few crossing days.

    Members enter on the first day or when they register; activity dated before
    the entry counts only for members already registered on the first day.
    ``previous`` holds the codes known before the range (NULL otherwise). With a
    ``state`` (see :func:`lifecycle_state`) of the days before, which also holds
    the codes, only the activity of the range is read. ``activity`` is that of the
    range, if it is there already.
    """
    registered = lifecycle_members(members, date(1990, 1, 1), end).withColumn(
        "entry", F.greatest(F.col("register_day"), day(start)))
    who = [*KEYS, "user_name", "register_day", "entry"]
    sums = ["login_date", "activated", "deposit_count", "wagers_total"]
    if activity is None:
        activity = _new_activity(login, deposits, bets, start, end, state)
    active = (
        activity.join(registered, KEYS)
        .filter((F.col("data_date") >= F.col("register_day")) | (F.col("register_day") <= day(start)))
        .select(*who, F.greatest("data_date", "entry").alias("on"), *sums)
    )
    entering = registered.select(
        *who, F.col("entry").alias("on"), F.lit(None).cast("date").alias("login_date"),
        F.lit(None).cast("date").alias("activated"), F.lit(0).cast("long").alias("deposit_count"),
        F.lit(0).cast("long").alias("wagers_total"))
    rows = active.unionByName(entering)
    if state is not None:
        rows = rows.unionByName(state.join(registered, KEYS).select(*who, F.col("entry").alias("on"), *sums))
        previous = state
    daily = rows.groupBy(*who, "on").agg(*_totals())

    by_day = Window.partitionBy(*KEYS).orderBy("on")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = daily.select(
        *KEYS, "user_name", "on",
        F.coalesce(F.lead("on").over(by_day), day(end + timedelta(days=1))).alias("until"),
        F.coalesce(F.max("activated").over(so_far), never()).alias("activated_date"),
        F.greatest(F.col("register_day"), F.coalesce(F.max("login_date").over(so_far), never())).alias("visited_date"),
        F.sum("deposit_count").over(so_far).alias("deposit_count"),
        F.sum("wagers_total").over(so_far).alias("wagers_total"))

    crossings = F.array_distinct(F.array(
        F.col("on"), F.date_add("activated_date", 15), F.date_add("activated_date", 61), F.date_add("visited_date", 61)))
    dated = states.withColumn(
        "data_date", F.explode(F.filter(crossings, lambda d: (d >= F.col("on")) & (d < F.col("until"))))
    ).withColumn("tag_code", lifecycle_code(
        F.col("data_date"), F.col("activated_date"), F.col("visited_date"), F.col("deposit_count"), F.col("wagers_total")))

    known = F.lag("tag_code").over(Window.partitionBy(*KEYS).orderBy("data_date"))
    if previous is not None:
        dated = dated.join(previous.select(*KEYS, F.col("tag_code").alias("before")), KEYS, "left")
        known = F.coalesce(known, F.col("before"))
    return (
        dated.withColumn("known", known)
        .filter(~F.col("known").eqNullSafe(F.col("tag_code")))
        .filter((F.col("visited_date") >= day(floor)) | (F.col("activated_date") >= day(floor)))
        .select(*KEYS, "user_name", "data_date", "tag_code")
    )


def lifecycle_state(
    login: DataFrame, deposits: DataFrame, bets: DataFrame, members: DataFrame, start: date, end: date, state: DataFrame | None = None,
    activity: DataFrame | None = None,
) -> DataFrame:
    """What is carried per member after a range of days: last login and active day, sums, the code of the last day, and that day.

    With the ``state`` of the days before ``start`` only the range's activity is read.
    """
    registered = lifecycle_members(members, date(1990, 1, 1), end)
    if activity is None:
        activity = _new_activity(login, deposits, bets, start, end, state)
    counted = activity.join(registered, KEYS).filter(
        (F.col("data_date") >= F.col("register_day")) | (F.col("register_day") <= day(start)))
    sums = ["login_date", "activated", "deposit_count", "wagers_total"]
    rows = counted.select(*KEYS, *sums)
    if state is not None:
        rows = rows.unionByName(state.select(*KEYS, *sums))
    known = registered.join(rows.groupBy(*KEYS).agg(*_totals()), KEYS, "left").withColumns({
        "deposit_count": F.coalesce("deposit_count", F.lit(0)), "wagers_total": F.coalesce("wagers_total", F.lit(0))})
    code = lifecycle_code(
        day(end), F.coalesce("activated", never()), F.greatest(F.col("register_day"), F.coalesce("login_date", never())),
        F.col("deposit_count"), F.col("wagers_total"))
    return known.select(*KEYS, *sums, code.alias("tag_code"), day(end).alias("through"))


def advance_lifecycle(
    login: DataFrame, deposits: DataFrame, bets: DataFrame, members: DataFrame, start: date, end: date, state: DataFrame | None,
    materialise: Callable[[DataFrame], DataFrame], floor: date = date(2021, 1, 1),
) -> tuple[DataFrame | None, DataFrame]:
    """Change rows of the days up to ``end`` that are not done yet, and the state after them.

    The state's day says which days are done: they are not read or written again,
    and without new days there are no rows (None). ``start`` counts without a state.
    The facts are read once, reduced to members and days, for both.
    """
    if state is not None:
        through = state.agg(F.max("through")).first()[0]
        if through is not None:
            start = through + timedelta(days=1)
        if start > end:
            return None, state
    facts = (login, deposits, bets, members, start, end)
    activity = materialise(_new_activity(login, deposits, bets, start, end, state))
    changes = lifecycle_changes(*facts, floor=floor, state=state, activity=activity)
    return materialise(changes), materialise(lifecycle_state(*facts, state=state, activity=activity))


# -- steps --------------------------------------------------------------------
# (step, codes before, codes now); a later match overrides an earlier one
DAY_RULES = [
    (1, [50102], [50102]),
    (2, [None, 50107, 50108], [50100, 50101, 50102]),
    (2, [50100], [50101]),
    (3, [50100, 50101], [50102]),
    (4, [50103, 50104, 50105], [50100, 50101, 50102]),
    (5, [50105, 50106], [50100, 50101, 50102]),
    (6, [50100, 50101, 50102], [50103, 50104, 50105]),
    (7, [50103, 50104, 50105], [50106]),
]
WEEK_RULES = [
    (1, [None, 50102], [50102]),
    (2, [None, 50107, 50108], [50100, 50101, 50102]),
    (3, [None, 50100, 50101], [50102]),
    (4, [None, 50103, 50104, 50105], [50101, 50102]),
    (5, [None, 50105, 50106], [50101, 50102]),
    (6, [None, 50100, 50101, 50102], [50103, 50104, 50105]),
    (7, [None, 50103, 50104, 50105], [50106]),
]


def step_of(before: Column, now: Column, rules: list, first_match: bool = False) -> Column:
    step = F.lit(0)
    for number, earlier, current in reversed(rules) if first_match else rules:
        match = before.isin([c for c in earlier if c is not None])
        if None in earlier:
            match = match | before.isNull()
        step = F.when(holds(match & now.isin(current)), number).otherwise(step)
    return step


def lifecycle_step(before: Column, now: Column) -> Column:
    return step_of(before, now, DAY_RULES)


NAMES = ["this", "last", "last_two", "last_three"]


def change_intervals(log: DataFrame, end: date) -> DataFrame:
    """For each log row the days it is the latest one (``this_date`` to ``until``), with the codes of its run and the three before.

    A run is consecutive rows of one code; its date is that of its last row so
    far. Everything comes from one sort per member; of several rows of a day the
    largest code holds.
    """
    by_day = Window.partitionBy(*KEYS).orderBy("data_date", "tag_code")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = log.filter(F.col("data_date") <= day(end)).select(*KEYS, "user_name", "data_date", "tag_code").withColumns({
        "before": F.lag(F.struct("tag_code", "data_date")).over(by_day),
        "until": F.coalesce(F.date_sub(F.lead("data_date").over(by_day), 1), day(end)),
    })
    rows = rows.withColumn("opens", F.col("before").isNull() | ~F.col("before.tag_code").eqNullSafe(F.col("tag_code")))
    in_run = lambda column: F.last(F.when(F.col("opens"), F.col(column)), ignorenulls=True).over(so_far)
    rows = rows.withColumn("p1", in_run("before"))
    for n in (1, 2):
        rows = rows.withColumn("earlier", F.lag(f"p{n}").over(by_day)).withColumn(f"p{n + 1}", in_run("earlier"))
    return rows.select(
        *KEYS, "user_name", F.col("tag_code").alias("this_tag_code"), F.col("data_date").alias("this_date"), "until",
        *[F.col(f"p{n}.tag_code").alias(f"{NAMES[n]}_tag_code") for n in (1, 2, 3)],
        *[F.col(f"p{n}.data_date").alias(f"{NAMES[n]}_date") for n in (1, 2, 3)])


def lifecycle_day(log: DataFrame, members: DataFrame, calendar: DataFrame, on: date) -> DataFrame:
    return lifecycle_days(log, members, calendar, on, on)


def lifecycle_days(log: DataFrame, members: DataFrame, calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Steps of each day of the range from the change log, in one plan.

    History shorter than the three looked-at days is filled for active members,
    each line seeing the result of the line before. What a day's row says depends
    only on the change and on how many days ago it was: none, one, two or more.
    So each change gives four phases at most, and only the days of phases with a
    step are listed.
    """
    phased = change_intervals(log, end).withColumn("phase", F.explode(F.array(*[F.lit(n) for n in range(4)])))
    first, last_day = F.date_add("this_date", F.col("phase")), F.col("until")
    codes = phased.withColumns({
        "first": F.greatest(first, day(start)),
        "to": F.when(F.col("phase") < 3, F.least(first, last_day)).otherwise(last_day),
    }).filter(F.col("first") <= F.col("to"))
    this, last, two, three = (F.col(f"{n}_tag_code") for n in NAMES)
    changed = F.col("this_date")
    active = F.lit(C.ACTIVE)
    span_two = F.date_diff(changed, F.col("last_two_date"))
    span_three = F.date_diff(changed, F.col("last_three_date"))
    steady = lambda when: (when, this == C.ACTIVE)
    one_day, two_days, longer = F.col("phase") == 1, F.col("phase") == 2, F.col("phase") == 3
    fills = [
        ((last == C.ACTIVE, span_three > 3), "last_three_tag_code", active),
        ((last == C.ACTIVE, span_two > 2), "last_two_tag_code", active),
        ((two == C.ACTIVE, span_three > 3), "last_three_tag_code", active),
        ((last == C.ACTIVE, two.isNull()), "last_two_tag_code", active),
        ((two == C.ACTIVE, three.isNull()), "last_three_tag_code", active),
        (steady(one_day), "last_three_tag_code", two),
        (steady(one_day), "last_two_tag_code", last),
        (steady(one_day), "last_tag_code", active),
        (steady(two_days), "last_three_tag_code", last),
        (steady(two_days), "last_two_tag_code", this),
        (steady(two_days), "last_tag_code", active),
        (steady(longer), "last_three_tag_code", this),
        (steady(longer), "last_two_tag_code", active),
        (steady(longer), "last_tag_code", active),
    ]
    for conditions, column, value in fills:
        codes = codes.withColumn(column, F.when(holds(all_of(conditions)), value).otherwise(F.col(column)))
    stepped = codes.withColumns({
        "this_day_step": lifecycle_step(last, this),
        "last_day_step": lifecycle_step(two, last),
        "last_two_day_step": lifecycle_step(three, two),
    }).filter(F.col("this_day_step") != 0)
    started = (F.col("phase") == 0) | ((F.col("this_day_step") == 1) & (F.col("last_day_step") != 1))
    named = stepped.join(members.select(*KEYS, "ag_name"), KEYS).withColumn("on", F.explode(F.sequence("first", "to")))
    fiscal = calendar.groupBy(F.col("date").alias("on")).agg(F.max(F.struct(*WEEK)).alias("fiscal"))
    return salted_join(named, fiscal, ["on"], "left").select(
        *KEYS, "ag_name", "user_name", F.col("on").alias("data_date"),
        *[F.coalesce(c, F.lit(0)).alias(f"{n}_tag_code")
          for n, c in (("this", this), ("last", last), ("last_two", two), ("last_three", three))],
        "this_day_step", "last_day_step", "last_two_day_step", started.alias("init_flag"),
        *[F.col("fiscal")[c].alias(c) for c in WEEK])


def lifecycle_week_snapshot(log: DataFrame, calendar: DataFrame) -> DataFrame:
    """Latest code per member up to each fiscal week's end.

    A log row is the latest one from its own week to the week before the next
    row's, so rows are placed in their week and spread over the weeks they
    cover; the result size is the only blow-up. The list of fiscal weeks is a
    calendar (about 52 rows a year), hence ordered in one task.
    """
    week_order = Window.orderBy("fin_week_end")
    weeks = calendar.select(*WEEK, "fin_week_end").distinct().select(
        *WEEK, "fin_week_end", F.row_number().over(week_order).alias("week_no"),
        F.lag("fin_week_end").over(week_order).alias("previous_end"))
    bounds = weeks.agg(F.struct(F.min("fin_week_end").alias("first_end"), F.max("week_no").alias("last_no"))).scalar()
    first_day = F.coalesce(F.date_add("previous_end", 1), F.col("fin_week_end"))
    week_of_day = weeks.select("week_no", F.explode(F.sequence(first_day, F.col("fin_week_end"))).alias("in_day"))
    # days up to the end of the first week all belong to it
    placed = salted_join(log.withColumn("in_day", F.greatest(F.col("data_date"), bounds["first_end"])), week_of_day, ["in_day"])
    newest = best_by_group(placed, [*KEYS, "week_no"], [F.col("data_date"), F.col("tag_code")], ["user_name", "tag_code"])
    following = F.lead("week_no").over(Window.partitionBy(*KEYS).orderBy("week_no"))
    spread = newest.withColumn("until", F.coalesce(following - 1, bounds["last_no"])).select(
        *KEYS, "user_name", "tag_code", F.explode(F.sequence("week_no", "until")).alias("week_no"))
    return salted_join(spread, weeks.select("week_no", *WEEK), ["week_no"]).drop("week_no")


def lifecycle_week(
    ods_week: DataFrame, dw_previous: DataFrame, calendar: DataFrame, fin_year: int, fin_month: int, fin_week: int,
    first_match: bool = False,
) -> DataFrame:
    """Steps of a fiscal week against one and two weeks before, carried forward when nothing moved.

    Only the earliest created row of a member and week counts, with its name. A missing code
    before matches every rule; the last matching rule wins (``first_match``:
    the first).
    """
    target = calendar.filter(
        (F.col("fin_year") == fin_year) & (F.col("fin_month") == fin_month) & (F.col("fin_week") == fin_week))

    def in_week(back: int) -> Column:
        first_day = target.agg(F.date_sub(F.min("date"), back)).scalar()
        wanted = calendar.filter(F.col("date") == first_day).agg(F.max(F.struct(*WEEK))).scalar()
        return holds(all_of(F.col(c) == wanted[c] for c in WEEK))

    backs = {"week_tag_code": 0, "one_weeks_tag_code": 7, "two_weeks_tag_code": 14}
    carried = ["last_week_step", "this_week_step", "two_weeks_tag_code", "one_weeks_tag_code", "week_tag_code"]
    first_of = lambda back: F.min(F.when(in_week(back), F.struct("created_time", "tag_code", "user_name")))
    codes = (
        ods_week.filter(any_of(in_week(b) for b in backs.values())).groupBy(*KEYS)
        .agg(first_of(0)["user_name"].alias("user_name"),
             *[first_of(b)["tag_code"].alias(name) for name, b in backs.items()])
        .filter(F.col("week_tag_code").isNotNull())
    )
    previous = best_by_group(
        dw_previous.filter(in_week(7)), KEYS, [F.col("created_time")], carried, smallest=True
    ).withColumnsRenamed({c: f"dw_{c}" for c in carried})
    joined = codes.join(previous, KEYS, "left")
    now, one, two = (F.col(c) for c in ("week_tag_code", "one_weeks_tag_code", "two_weeks_tag_code"))
    stepped = joined.withColumns({
        "last_week_step": step_of(two, one, WEEK_RULES, first_match),
        "this_week_step": step_of(one, now, WEEK_RULES, first_match),
    })
    filled = stepped.select(*KEYS, "user_name", *[
        F.coalesce(c, F.lit(0)).alias(c) for c in [*carried, *[f"dw_{c}" for c in carried]]])
    moved = filled.filter(" OR ".join(
        f"{c} <> 0" for c in ("dw_last_week_step", "dw_this_week_step", "last_week_step", "this_week_step")))
    still = F.col("this_week_step") == 0
    restored = moved.withColumns({c: F.when(still, F.col(f"dw_{c}")).otherwise(F.col(c)) for c in carried})
    opened = (F.col("last_week_step") == 0) & (F.col("this_week_step") != 0)
    return restored.withColumns({
        "last_week_step": F.when(opened, F.col("dw_this_week_step")).otherwise(F.col("last_week_step")),
        "two_weeks_tag_code": F.when(opened, F.col("dw_one_weeks_tag_code")).otherwise(F.col("two_weeks_tag_code")),
    }).select(
        *KEYS, "user_name", *carried, F.lit(fin_year).alias("fin_year"), F.lit(fin_month).alias("fin_month"),
        F.lit(fin_week).alias("fin_week"))
