"""Length of stay (C11, C12): days in care net of foster days.

Each report month describes the month before it (Q26). Stays come from intakes
of that month and from the "inventory" (latest intake before the report date of
an animal with a status row in the last five years). Foster days are the day
counts from each location row to the next one inside the stay windows.

The reference's fan-out is kept by default (Q10): location rows are listed once
per stay row of the animal before the next-row difference, and, for animals that
left, the foster sum is joined to the stays again, which multiplies it by the
number of stay rows. Here the location rows are reduced to distinct rows and the
multiplicity is applied as a factor, which gives the same numbers without
materialising the copies (``per_stay`` leaves the factor out).

An animal's events are read as timelines. Past intake and last status of all report dates come
from one fold over (animal, month) (``latest_at_month_starts``). Foster days come from one timeline of
location rows and the ends of the stay windows (``_probes``): running foster days, read at a
window's start and end, so that a window costs two events however long it is. Open stays deal all of this once,
by animal, over tasks that their rows keep small; only a hot animal needs steps that spread it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, day_diff, last_month_start_before, lit_date, month_start
from shelterlens.functions.predicates import isin_or_null
from shelterlens.operators.joins import NARROW_ROWS, ROWS_A_TASK, crowded, deal, join_in_place, join_large
from shelterlens.operators.spine import MonthSpine, _add_months, months_between_cols
from shelterlens.operators.temporal import latest_at_month_starts
from shelterlens.operators.timeline import Timeline, islands
from shelterlens.session import materialize, materialize_dealt
from shelterlens.sources.model import Model

# Fixed values of the stay report.
INTAKE_TYPES = ("TransferIn", "OwnerSurrender", "[Return]", "Stray")
OUTCOME_TYPES = ("PreEuthanasia", "Adoption", "Died", "ReturnToOwner", "TransferOut")
SPECIES = ("Cat", "Dog")
FOSTER = "Fosters"
LOOKBACK_YEARS = 5
NO_OUTCOME = "No Outcome Yet"

OUT_COLUMNS = ["animalid", "name", "species", "intakedate", "outcomedate", "days_in_foster", "total_los",
               "days_in_shelter", "OutcomeType", "Reportdate", "Type"]


def _type_label(intake_date: Column, report: Column, same_year: bool = False) -> Column:
    """New intake when the intake month number equals the previous month's (year ignored, Q14;
    ``same_year`` repairs that)."""
    last = F.add_months(report, -1)
    new = (month_start(intake_date) == month_start(last)) if same_year else (F.month(intake_date) == F.month(last))
    return F.when(new, F.lit("New Intake")) \
        .otherwise(F.lit("Already in Shelter"))


def _month_before(spine: MonthSpine, ts: str) -> Column:
    """Time in the month before some report month, as literal bounds for the scan (null: no)."""
    return ((F.col(ts) >= as_timestamp(F.lit(_add_months(spine.first, -1)))) & (F.col(ts) < as_timestamp(F.lit(spine.last))))


def _recent_statuses(m: Model, spine: MonthSpine, status: str | None = None) -> DataFrame:
    """Status rows that any report date can see, stored: read more than once, and counted."""
    oldest = as_timestamp(F.lit(_add_months(spine.first, -12 * LOOKBACK_YEARS)))
    st = m["statuses"].where(F.col("AnimalID").isNotNull() & (F.col("LastUpdated") > oldest) & (F.col("LastUpdated") <= as_timestamp(F.lit(spine.last))))
    if status is not None:
        st = st.where(F.col("Status") == status)
    return materialize(st.select("AnimalID", "LastUpdated", "Status"))


def _last_status_and_intake(m: Model, st: DataFrame, asked: DataFrame, spine: MonthSpine, asked_months: int,
                            tasks: int | None = None) -> DataFrame:
    """Latest time of the status rows ``st`` at or before 00:00 of each month from ``reference_date`` to ``_to`` of an
    animal, where it is not older than five years, and the latest intake strictly before it (``_st``, ``_pi``)."""
    came = m["visits"].where(F.col("tin_DateCreated") < as_timestamp(F.lit(spine.last))).select("AnimalID", "tin_DateCreated")
    found = latest_at_month_starts(asked, ["AnimalID"], "reference_date", {
        "_st": (st.select("AnimalID", "LastUpdated"), "LastUpdated", False), "_pi": (came, "tin_DateCreated", True)},
        0 if tasks else st.count() + came.count(), "_to", asked_months, tasks)
    return found.where((F.col("_st") > as_timestamp(F.add_months("reference_date", -12 * LOOKBACK_YEARS)))
                       & F.col("_pi").isNotNull())


def _moves(m: Model, last_day: Column) -> DataFrame:
    """Location rows before ``last_day``, stored: counted before they are dealt."""
    return materialize(m["locations"].where(F.col("AnimalID").isNotNull() & (F.col("LastUpdated") < last_day))
                       .select("AnimalID", F.col("LastUpdated").alias("_t"), "Location"))


def _probes(moves: DataFrame, windows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per window (AnimalID, reference_date, _i, _o): ``_a``, the last location row at or before its start, and
    ``_b``, the last one before its end - structs of time, foster flag, next row's time and the foster
    days gathered up to the row (each foster row counts to the animal's next row). ``tasks``: the windows are dealt by
    animal over so many tasks, none of them crowded, and the location rows join them there."""
    held = moves.repartition(tasks, "AnimalID") if tasks else deal(moves, moves.columns, moves.count(), NARROW_ROWS)
    held = held.distinct().withColumn("_kind", F.lit(1))
    ends = windows.withColumn("_end", F.explode(F.array(
        F.struct(as_timestamp("_o").alias("_t"), F.lit(0).alias("_kind")), F.struct(as_timestamp("_i").alias("_t"), F.lit(2).alias("_kind")))))
    ends = ends.select("AnimalID", "reference_date", F.to_date("_i").alias("_i"), "_end._t", "_end._kind")
    # under a name of its own on both sides, so that the union of rows dealt by animal is known to be dealt by it
    held, ends = (df.withColumnRenamed("AnimalID", "_animal") for df in (held, ends))
    # at one time: ends of windows, location rows, starts of windows
    line = Timeline(held.unionByName(ends, allowMissingColumns=True), ["_animal"],
                    ["_t", "_kind", "Location", "reference_date", "_i"], dealt=tasks is not None)
    at = F.when(F.col("_kind") == 1, F.col("_t"))
    line = line.next("_next", at)
    foster = F.col("Location") == FOSTER
    days = F.when((F.col("_kind") == 1) & foster, F.coalesce(day_diff("_t", "_next"), F.lit(0))).otherwise(F.lit(0))
    line = line.total("_upto", days)
    row = F.when(F.col("_kind") == 1, F.struct(
        F.col("_t").alias("t"), foster.alias("foster"), F.col("_next").alias("next"), (F.col("_upto") - days).alias("sum")))
    found = line.last("_row", row).rows("_animal", "reference_date", "_i", "_kind", "_row").where(F.col("_kind") != 1)
    return found.withColumnRenamed("_animal", "AnimalID").groupBy("AnimalID", "reference_date", "_i").agg(
        F.max(F.when(F.col("_kind") == 2, F.col("_row"))).alias("_a"), F.max(F.when(F.col("_kind") == 0, F.col("_row"))).alias("_b"))


def _open_foster_days(moves: DataFrame, windows: DataFrame, tasks: int | None) -> DataFrame:
    """Foster days of one open window (intakedate, reference_date) per (animal, month).

    Foster days gathered up to the report date, less those gathered up to the intake. A row counts
    to the next one or to the report date, whichever is first; a row at or before the intake does
    not count, its days after the intake included.
    """
    report = as_timestamp("reference_date")
    w = _probes(moves, windows.select("AnimalID", "reference_date", F.col("intakedate").alias("_i"),
                                      F.col("reference_date").alias("_o")), tasks)
    upto = F.col("_b.sum") + F.when(F.col("_b.foster"), day_diff(F.col("_b.t"), report)).otherwise(0)
    before = F.col("_a.sum") + F.when(F.col("_a.foster"), day_diff(F.col("_a.t"), F.least(F.col("_a.next"), report))).otherwise(0)
    return w.select("AnimalID", "reference_date",
                    (F.coalesce(upto, F.lit(0)) - F.coalesce(before, F.lit(0))).alias("_foster"))


def _foster_days(m: Model, stays: DataFrame, spine: MonthSpine) -> DataFrame:
    """Sum of day counts from each Fosters row to the next location row, over the
    distinct location rows inside any stay window of the (animal, month).

    The windows are joined where they overlap. Inside one the days are those gathered between its first and
    last row; from the last row of one window the next row is the first one of the next window that
    holds any (the row after the last one at or before its start).
    """
    keys = ["AnimalID", "reference_date"]
    joined = islands(stays.select(*keys, F.col("intakedate").alias("_i"), F.col("_o").alias("_o")), keys, "_i", "_o")
    # a window ends in the month before its report date: no later location row matters
    w = _probes(_moves(m, as_timestamp(F.lit(spine.last))), joined)
    first_sum = F.coalesce(F.col("_a.sum") + F.when(F.col("_a.foster"), day_diff(F.col("_a.t"), F.col("_a.next"))).otherwise(0), F.lit(0))
    held = w.where(F.col("_b.t") > as_timestamp("_i")).withColumn("_inside", F.col("_b.sum") - first_sum)
    in_order = Window.partitionBy(*keys).orderBy("_i")
    before = F.lag("_b").over(in_order)
    gap = F.when(before["foster"], day_diff(before["t"], F.col("_a.next"))).otherwise(0)
    return (held.withColumn("_gap", F.coalesce(gap, F.lit(0))).groupBy(*keys)
            .agg(F.sum(F.col("_inside") + F.col("_gap")).alias("_foster")))


def los_outcomed(m: Model, spine: MonthSpine, same_year: bool = False, per_stay: bool = False) -> DataFrame:
    """C11: animals that left in the month before each report month.

    ``per_stay`` repairs Q10: the foster days of an animal count once, not once per stay row.
    """
    animals = m["animals"].where(F.col("Species").isin(list(SPECIES))).select("AnimalID", "Name", "Species")
    started = isin_or_null("IntakeType", INTAKE_TYPES) & _month_before(spine, "tin_DateCreated")
    ended = (F.col("OutComeType").isin(list(OUTCOME_TYPES)) & F.col("tOut_DateCreated").isNotNull()
             & _month_before(spine, "tOut_DateCreated"))
    vo = m["visits_out"]
    # stays that started and ended in the previous month
    flow = (vo.where(started)
            .withColumn("reference_date", F.add_months(month_start("tin_DateCreated"), 1))
            .where(spine.in_spine("reference_date"))
            .withColumn("intakedate", F.to_date("tin_DateCreated"))
            .withColumn("outcomedate", F.to_date("tOut_DateCreated"))
            .where(month_start("outcomedate") == month_start("intakedate"))
            .select("AnimalID", "reference_date", "intakedate", "outcomedate",
                    F.coalesce("OutComeType", F.lit(NO_OUTCOME)).alias("Outcome")))
    # outcomes of the previous month for animals with an inactive status in the last five years
    inv = (vo.where(ended).withColumn("outcomedate", F.to_date("tOut_DateCreated"))
           .withColumn("reference_date", F.add_months(month_start("outcomedate"), 1))
           .where(spine.in_spine("reference_date"))
           .select("AnimalID", "reference_date", "outcomedate", F.col("OutComeType").alias("Outcome")))
    asked = inv.select("AnimalID", "reference_date", F.col("reference_date").alias("_to"))
    keys = _last_status_and_intake(m, _recent_statuses(m, spine, "I"), asked, spine, 0)   # an asked month is a visit
    inv = (inv.join(keys.select("AnimalID", "reference_date", F.to_date("_pi").alias("intakedate")),
                    ["AnimalID", "reference_date"], "inner")
           .select("AnimalID", "reference_date", "intakedate", "outcomedate", "Outcome"))
    stays = (flow.unionByName(inv).where(F.col("outcomedate") >= F.col("intakedate"))
             .join(animals, "AnimalID", "inner")
             .groupBy("AnimalID", "Name", "Species", "intakedate", "Outcome", "reference_date")
             .agg(F.min("outcomedate").alias("outcomedate")))
    stays = materialize(stays.withColumn("_o", F.col("outcomedate")))
    k = stays.groupBy("AnimalID", "reference_date").agg(F.count(F.lit(1)).alias("_k"))
    foster = _foster_days(m, stays, spine)
    if not per_stay:
        foster = (foster.join(k, ["AnimalID", "reference_date"], "inner")
                  .select("AnimalID", "reference_date", (F.col("_foster") * F.col("_k")).alias("_foster")))
    return _finish(stays, foster, same_year, stays.count())


def los_not_outcomed(m: Model, spine: MonthSpine, same_year: bool = False, match_animal: bool = False,
                     open_stays: bool = False) -> DataFrame:
    """Animals still in care at each report date (open foster spell counted to it).

    ``match_animal`` repairs Q11: only an active status row of the animal itself qualifies its latest status
    time. ``open_stays`` repairs Q12: a visit without an out date lasts beyond every report date.
    """
    animals = m["animals"].where(F.col("Species").isin(list(SPECIES))).select("AnimalID", "Name", "Species")
    v = materialize(m["visits_out"].where(F.col("AnimalID").isNotNull()).select(
        "AnimalID", "tin_DateCreated", "tOut_DateCreated", isin_or_null("IntakeType", INTAKE_TYPES).alias("_listed")))
    flow = (v.where(F.col("_listed") & _month_before(spine, "tin_DateCreated"))
            .withColumn("reference_date", F.add_months(month_start("tin_DateCreated"), 1))
            .where(spine.in_spine("reference_date"))
            .where(F.col("tOut_DateCreated").isNull()
                   | (F.col("tOut_DateCreated") > as_timestamp("reference_date")))
            .select("AnimalID", "reference_date", F.to_date("tin_DateCreated").alias("intakedate")))
    # inventory: months where the animal has a visit ending later, a past intake and a recent status row
    out = F.col("tOut_DateCreated")
    if open_stays:
        out = F.coalesce(out, as_timestamp(F.lit(_add_months(spine.last, 1))))
    span = v.groupBy("AnimalID").agg(F.min("tin_DateCreated").alias("_tin_min"), F.max(out).alias("_tout_max"))
    span = materialize(span.where(F.col("_tout_max").isNotNull()).select(
        "AnimalID", F.greatest(F.add_months(month_start("_tin_min"), 1), lit_date(spine.first)).alias("reference_date"),
        F.least(last_month_start_before("_tout_max"), lit_date(spine.last)).alias("_to"))
        .where(F.col("reference_date") <= F.col("_to")))
    asked_months = span.agg(F.sum(F.size(months_between_cols("reference_date", "_to")))).first()[0] or 0
    st, moves = _recent_statuses(m, spine), _moves(m, as_timestamp(F.lit(spine.last)))
    most = asked_months + v.count()     # stays
    tasks = (2 * most + moves.count()) // NARROW_ROWS + 2     # of one task Spark does not know what deals it
    by = ["AnimalID"]
    if crowded([st, v, moves], by, tasks, NARROW_ROWS):
        tasks = None    # a hot animal: each step deals its rows so that they spread
    grid = _last_status_and_intake(m, st, span, spine, asked_months, tasks).where(spine.in_spine("reference_date"))
    same = ["AnimalID", "_st"] if match_animal else ["_st"]   # any animal's active row at that instant (Q11)
    active = materialize(st.where(F.col("Status") == "A").withColumnRenamed("LastUpdated", "_st").select(*same).distinct())
    if active.count() <= ROWS_A_TASK:
        grid = grid.join(F.broadcast(active), same, "left_semi")   # stored and counted: a proven bound
    else:
        grid = join_large(*[deal(x, same, asked_months, NARROW_ROWS) for x in (grid, active)], same, "left_semi")
        grid = grid.repartition(tasks, *by) if tasks else grid
    inv = grid.select("AnimalID", "reference_date", F.to_date("_pi").alias("intakedate"))
    if tasks:
        animals = animals.repartition(tasks, *by)
        stays = [join_large(x, animals, "AnimalID") for x in (inv, flow.repartition(tasks, *by))]
        stays = materialize_dealt(stays[0].unionByName(stays[1]), by, tasks)
    else:
        stays = materialize(inv.unionByName(flow))
        rows = stays.count()
        stays = join_large(*[deal(x, by, rows) for x in (stays, animals)], "AnimalID")
    # every stay window of an (animal, month) ends at the report date, so their union is
    # one window from the earliest intake
    windows = stays.groupBy("AnimalID", "reference_date").agg(F.min("intakedate").alias("intakedate"))
    foster = _open_foster_days(moves, windows, tasks)
    stays = stays.withColumn("outcomedate", F.col("reference_date"))
    if tasks:
        return _report(join_in_place(stays, foster, by, ["reference_date"], "left"), same_year)
    return _finish(stays, foster, same_year, rows)


def _finish(stays: DataFrame, foster: DataFrame, same_year: bool, rows: int) -> DataFrame:
    """The report rows of ``rows`` stays: what they are joined with and their distinct rows stay where an animal's month is dealt."""
    keys = ["AnimalID", "reference_date"]   # all of the join's: it would deal rows dealt by some of them once more
    return _report(join_large(*[deal(x, keys, rows) for x in (stays, foster)], keys, "left"), same_year)


def _report(out: DataFrame, same_year: bool) -> DataFrame:
    fd = F.coalesce(F.col("_foster"), F.lit(0)).cast("bigint")
    total = F.datediff("outcomedate", "intakedate").cast("bigint")
    return out.select(
        F.col("AnimalID").alias("animalid"), F.col("Name").alias("name"), F.col("Species").alias("species"),
        "intakedate", "outcomedate", fd.alias("days_in_foster"), total.alias("total_los"),
        (total - fd).alias("days_in_shelter"), F.lit("Outcomed").alias("OutcomeType"),
        F.col("reference_date").alias("Reportdate"),
        _type_label(F.col("intakedate"), F.col("reference_date"), same_year).alias("Type")).distinct()
