"""Repeat issues kept up day by day.

A folder holds four tables, each partitioned by run day:

* ``candidates``: the day's rows that may count as visits;
* ``last``: the last visit of every vehicle and part, as of the end of the day;
* ``repeats``: the repeat issues found on the day;
* ``reopened``: vehicles and parts whose history was worked through anew that day.

A run reads its day's job cards and the ``last`` table. Only where a visit came
late (not after the last one of its vehicle and part), or a job card that an
earlier day knows came again, is a history opened: that of these vehicles and
parts. What earlier days found for them is void then, and the day's
``repeats`` hold their whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.functions import dates
from wrenchlake.operators import visits
from wrenchlake.operators.skew import HOT_ROWS, bounded
from wrenchlake.sources import tables

_KEYS, _VISIT, _ORDER = visits.REPEAT_KEYS, visits.REPEAT_VISIT, visits.REPEAT_ORDER


class StaleDayError(ValueError):
    """A day was to be run though later ones rest on it."""


def _table(spark: SparkSession, folder: str, name: str, run_date: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}").withColumn(run_date, F.col(run_date).cast("date"))


def _stamped(df: DataFrame, day: str, run_date: str) -> DataFrame:
    return df.withColumn(run_date, dates.day(day))


def update_repeats(
    spark: SparkSession, jobcards: DataFrame, exclude: DataFrame, folder: str, day: str,
    run_date: str = schemas.RUN_DATE, hot_rows: int = HOT_ROWS,
) -> None:
    """Take one run day's job cards into the tables of ``folder``.

    ``jobcards`` are the day's rows; a first run may bring many days at once.
    Running the latest day again replaces it. An earlier day is refused, as
    later ones rest on it.
    """
    done = tables.run_days(spark, f"{folder}/last", run_date)
    if any(d > day for d in done):
        raise StaleDayError(f"{day} lies before {max(done)}, which rests on it")
    before = [d for d in done if d < day]
    own = visits.one_per_visit(visits.repeat_candidates(jobcards, exclude))
    tables.write_day(_stamped(own, day, run_date), f"{folder}/candidates", day, run_date)
    candidates = _table(spark, folder, "candidates", run_date)
    today = candidates.filter(F.col(run_date) == dates.day(day)).drop(run_date)
    if not before:
        rows, following = today, visits.after_previous(today, hot_rows)
        reopened, last = today.select(*_KEYS).limit(0), None
    else:
        known = candidates.filter(F.col(run_date) < dates.day(day)).drop(run_date)
        last = _table(spark, folder, "last", run_date).filter(F.col(run_date) == dates.day(before[-1])).drop(run_date)
        # Job cards that come again, under the vehicles of both days, and visits that come late.
        again = today.select(*_VISIT, *_KEYS[:1]).join(known.select(*_VISIT, F.col(_KEYS[0]).alias("_other")), _VISIT)
        again = again.select(F.explode(F.array(_KEYS[0], "_other")).alias(_KEYS[0]), _KEYS[1])
        newest = last.select(*_KEYS, F.struct(*_ORDER).alias("_newest"))
        late = today.join(newest, _KEYS).filter(F.struct(*_ORDER) <= F.col("_newest")).select(*_KEYS)
        tables.write_day(_stamped(again.unionByName(late).distinct(), day, run_date), f"{folder}/reopened", day, run_date)
        reopened = _table(spark, folder, "reopened", run_date).filter(F.col(run_date) == dates.day(day)).drop(run_date)
        reopened = bounded(reopened)
        fresh = today.join(reopened, _KEYS, "left_anti")
        carried = last.join(fresh.select(*_KEYS).distinct(), _KEYS, "left_semi").withColumn("_carried", F.lit(True))
        stream = fresh.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
        following = visits.after_previous(stream, hot_rows).filter(~F.col("_carried")).drop("_carried")
        rows = fresh
        if not reopened.isEmpty():
            # All visits of the reopened histories; a job card's rows compete with each other whatever vehicle they name.
            both = known.unionByName(today)
            theirs = both.join(reopened, _KEYS, "left_semi").select(*_VISIT).distinct()
            anew = visits.one_per_visit(both.join(bounded(theirs), _VISIT, "left_semi")).join(reopened, _KEYS, "left_semi")
            following = following.unionByName(visits.after_previous(anew, hot_rows))
            rows = rows.unionByName(anew)
    found = visits.close_repeats(following, day, run_date)
    tables.write_day(found, f"{folder}/repeats", day, run_date)
    ends = rows.select(*_KEYS, *_ORDER[:1], *_ORDER[1:])
    if last is not None:
        ends = ends.unionByName(last.join(reopened, _KEYS, "left_anti").select(*ends.columns))
    ends = ends.groupBy(*_KEYS).agg(F.max(F.struct(*_ORDER)).alias("_end")).select(*_KEYS, "_end.*")
    tables.write_day(_stamped(ends, day, run_date), f"{folder}/last", day, run_date)
    if before:  # the day before stays, for another run of this one
        tables.drop_days(spark, f"{folder}/last", before[-1], run_date)


def current_repeats(spark: SparkSession, folder: str, asof, run_date: str = schemas.RUN_DATE) -> DataFrame:
    """The repeat issues of all days taken in so far, as ``repeat_issues`` over all job cards would give them."""
    found = _table(spark, folder, "repeats", run_date)
    if tables.run_days(spark, f"{folder}/reopened", run_date):
        void = _table(spark, folder, "reopened", run_date).groupBy(*_KEYS).agg(F.max(run_date).alias("_void_before"))
        void = void.select(*[F.col(k).alias(f"_{k}") for k in _KEYS], "_void_before")
        on = [F.col(k) == F.col(f"_{k}") for k in _KEYS] + [F.col(run_date) < F.col("_void_before")]
        found = found.join(void, on, "left_anti")
    return found.withColumn(run_date, dates.day(asof))
