"""The batch jobs: ingest bars, build the tables, bring them up to date, check them, record outcomes, score outliers.

Dated tables are partitioned by month. An update rewrites only the months it
changes and replaces rows by key, so a job that is repeated changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import schemas
from tickloom.operators.asof import value_range
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.series import series_blocks
from tickloom.operators.upsert import recompute_touched, touched_since, upsert
from tickloom.plans import checks, decision, detectors, gold, silver
from tickloom.session import written
from tickloom.sources import tables
from tickloom.sources.bars import bars_from_wide
from tickloom.sources.deliveries import DELIVERED, Deliveries
from tickloom.sources.versions import VersionedTable, months_between, table_version

DAY = ("symbol", "date")


# When a row was written, by table.
STAMPS = {
    "gold_anomaly_flags": "detected_at", "gold_batch_anomalies": "detected_at",
    "decision_case_outcomes": "recorded_at",
}
STAMP_NAMES = {*STAMPS.values(), "updated_at"}
# The tables of the jobs, by month of their date or undivided.
DATED = (
    "bronze_daily_ohlcv", "silver_ohlcv", "gold_volatility_index", "gold_52w_levels", "gold_technical_rating",
    "gold_sector_performance", "gold_anomaly_flags", "gold_batch_anomalies", "decision_cf_engine", "decision_metarule_flags",
    "decision_signals", "decision_case_outcomes", "decision_case_totals", "decision_cbr_lookup", "silver_ticks", "gold_intraday_vwap",
)
# What the lookup's tables note: the version of the outcomes that they follow.
OUTCOMES = "outcomes"
WHOLE = ("silver_symbols", "knowledge_rules", "tick_symbols", "decision_validation")


@dataclass(frozen=True)
class Warehouse:
    """The tables under one folder, each a log of versions (``sources/versions.py``).

    Every write is one commit: a job that breaks off leaves each table as it was before or after it, readers
    meanwhile see the old state, and the job can be run again.
    """

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> VersionedTable:
        return table_version(self.spark, self.path(name)) or VersionedTable(self.spark, self.path(name))

    def exists(self, name: str) -> bool:
        return self.table(name).exists()

    def read(
        self, name: str, since: dt.date | None = None, until: dt.date | None = None, stamps: bool = False
    ) -> DataFrame:
        """A table, or its months from ``since`` to ``until``; only their folders are listed and opened."""
        table = self.table(name)
        df = table.read(wanted=months_between(since, until) if table.partition else None)
        if "month" in df.columns:
            df = tables.in_months(df, since, until).drop("month")
        return df if stamps else df.drop(*STAMP_NAMES)

    def note(self, name: str, key: str) -> str | None:
        """What the last commits have noted about a table."""
        version = self.table(name).version()
        return version.notes.get(key) if version else None

    def replace(self, name: str, df: DataFrame, date: str | None = "date", notes: dict[str, str] | None = None) -> None:
        tables.load_version(stamped(name, df), self.path(name), date, notes)

    def merge(
        self, name: str, rows: DataFrame, keys: Sequence[str], date: str = "date", notes: dict[str, str] | None = None,
    ) -> DataFrame:
        """Upsert into the months the rows fall into, in one commit; returns the stored rows."""
        fresh = written(tables.by_month(stamped(name, rows), date), name)
        table = VersionedTable(self.spark, self.path(name))
        base = table.version()
        # one row for each month
        months = {str(r.month) for r in fresh.select("month").distinct().collect()}
        if base is not None and not months and not notes:
            return fresh.drop("month", *STAMP_NAMES)
        merged = fresh if base is None else upsert(table.read(base.number, months.__contains__), fresh, keys)
        table.commit(merged, base=base, notes=notes)
        return fresh.drop("month", *STAMP_NAMES)

    def vacuum(self, keep: int = 2) -> None:
        """Remove older versions of all tables, and what jobs that broke off have left."""
        for name in sorted({*DATED, *WHOLE}):
            if self.exists(name):
                self.table(name).vacuum(keep)

    def with_history(self, name: str, first: dt.date, rows: int, days: int) -> DataFrame:
        """The rows from ``first`` on, and at least the ``rows`` before it of every symbol that has as many.

        ``days`` are enough for nearly every symbol; of those that need more, and only
        of those, the older months are read as well.
        """
        since = first - dt.timedelta(days=days)
        near = self.read(name, since)
        earlier = near.filter(F.col("date") < F.lit(first)).groupBy("symbol").count()
        short = near.select("symbol").distinct().join(
            earlier.filter(F.col("count") >= rows), "symbol", "left_anti")
        if short.isEmpty():
            return near
        before = since.replace(day=1) - dt.timedelta(days=1)
        return near.unionByName(self.read(name, until=before).join(short, "symbol", "left_semi"))


def stamped(name: str, df: DataFrame) -> DataFrame:
    return df.withColumn(STAMPS.get(name, "updated_at"), F.current_timestamp())


def bounds(df: DataFrame, date: str = "date") -> tuple[dt.date, dt.date] | None:
    """The first and the last date, None if there is no row."""
    first, last = df.agg(F.min(date).cast("date"), F.max(date).cast("date")).first()
    return (first, last) if first else None


@dataclass(frozen=True)
class SeriesModel:
    """A model over the bars of one symbol, and the rows it looks back on."""

    name: str
    build: Callable[..., DataFrame]
    lookback: int


SERIES_MODELS = (
    SeriesModel("gold_volatility_index", gold.volatility_index, max(gold.VOLATILITY_FRAMES)),
    SeriesModel("gold_52w_levels", gold.levels_52w, gold.YEAR_ROWS - 1),
    SeriesModel("gold_technical_rating", gold.technical_rating, max(gold.MEAN_FRAMES)),
)


def build_tables(house: Warehouse, bars: DataFrame, symbols: DataFrame, rules: DataFrame) -> None:
    """All tables from bronze bars, from nothing."""
    house.replace("silver_symbols", symbols, date=None)
    house.replace("knowledge_rules", rules, date=None)
    house.replace("silver_ohlcv", silver.silver_ohlcv(bars))
    clean = house.read("silver_ohlcv")
    blocks = series_blocks(clean)
    for model in SERIES_MODELS:
        house.replace(model.name, model.build(clean, symbols, **blocks))
    house.replace("gold_sector_performance", gold.sector_performance(gold.daily_return(clean, symbols, **blocks)))
    house.replace("gold_anomaly_flags", gold.anomaly_flags(house.read("gold_volatility_index"), **blocks))
    house.replace("decision_cf_engine", decision.cf_engine(house.read("gold_technical_rating"), rules))
    house.replace("decision_metarule_flags", decision.metarule_flags(
        house.read("gold_anomaly_flags"), house.read("gold_volatility_index"), **blocks))
    house.replace("decision_signals", _signals(house))


def deliver(house: Warehouse, name: str, rows: DataFrame) -> int:
    """Add rows to the change log of a bronze table, as the next delivery."""
    return Deliveries(house.spark, house.path(f"{name}_deliveries")).add(rows)


def take_in(
    house: Warehouse, bronze: str, target: str, clean: Callable[[DataFrame], DataFrame], keys: Sequence[str], date: str,
) -> DataFrame | None:
    """Bring the deliveries that ``target`` hasn't seen into it; returns the rows of the keys they touch.

    Only those deliveries are opened, and of the target only the months their rows fall into. Of a key's stored and
    arrived rows the one ingested last stays, so the order of deliveries plays no part. The mark moves in the same
    commit. None if nothing has arrived.
    """
    mark = int(house.note(target, DELIVERED) or 0)
    arrived, last = Deliveries(house.spark, house.path(f"{bronze}_deliveries")).after(mark)
    if arrived is None:
        return None
    fresh = written(clean(arrived), "arrived")
    span = bounds(fresh, date)
    if house.exists(target) and span is not None:
        stored = house.read(target, *span).join(fresh.select(*keys).distinct(), list(keys), "left_semi")
        fresh = latest_per_key(stored.unionByName(fresh), keys, "ingestion_time")
    return house.merge(target, fresh, keys, date, notes={DELIVERED: str(last)})


def ingest_bars(house: Warehouse, wide: DataFrame, symbols: Sequence[str] | DataFrame) -> None:
    """Wide bars, a column per symbol and field, into bronze and its change log; days delivered again are replaced."""
    if isinstance(symbols, DataFrame):
        symbols = [r.symbol for r in symbols.select("symbol").distinct().orderBy("symbol").collect()]
    bars = written(bars_from_wide(wide, symbols).withColumn("ingestion_time", F.current_timestamp()), "bars")
    # the log first: if this breaks off, the bars are delivered again and none is missed
    deliver(house, "bronze_daily_ohlcv", bars)
    house.merge("bronze_daily_ohlcv", bars, DAY)


def build_ticks(house: Warehouse, ticks: DataFrame, symbols: DataFrame) -> None:
    """The tables of the ticks from bronze, from nothing."""
    house.replace("tick_symbols", symbols, date=None)
    house.replace("silver_ticks", silver.silver_ticks(ticks), "event_date")
    house.replace("gold_intraday_vwap", gold.intraday_vwap(house.read("silver_ticks"), symbols), "session_date")


def refresh_ticks(house: Warehouse, ticks: DataFrame | None = None) -> None:
    """Take in the bronze ticks that arrived since the last run, late ones included.

    What a tick can change is its symbol's day. Those days are computed anew from all
    their ticks, so the tables end as a full build would leave them. Without ``ticks`` the deliveries that
    silver hasn't seen are taken in, and nothing else of bronze is read.
    """
    if ticks is None:
        touched = take_in(house, "bronze_ticks", "silver_ticks", silver.silver_ticks, ("symbol", "event_time"), "event_date")
        if touched is not None:
            _refresh_sessions(house, written(touched.select("symbol", "event_date").distinct(), "tick-days"))
        return
    arrived = touched_since(ticks, "ingestion_time", house.read("silver_ticks"))
    days = written(arrived.select("symbol", "event_date").distinct(), "tick-days")
    span = bounds(days, "event_date")
    if span is None:
        return
    inside = F.col("event_date").between(F.lit(span[0]), F.lit(span[1]))
    again = ticks.filter(inside).join(days, ["symbol", "event_date"], "left_semi")
    house.merge("silver_ticks", silver.silver_ticks(again), ("symbol", "event_time"), "event_date")
    _refresh_sessions(house, days)


def _refresh_sessions(house: Warehouse, days: DataFrame) -> None:
    span = bounds(days, "event_date")
    if span is None:
        return
    sessions = house.read("silver_ticks", *span).join(days, ["symbol", "event_date"], "left_semi")
    vwap = gold.intraday_vwap(sessions, house.read("tick_symbols"))
    house.merge("gold_intraday_vwap", vwap, ("symbol", "session_date"), "session_date")


def refresh_tables(house: Warehouse, bars: DataFrame | None = None) -> None:
    """Take in the bronze bars that arrived since the last run, late ones included.

    Ends with the tables a full build over the same bars would give. Reads the months
    from the first touched day on, and what the models look back on before it. Without ``bars`` the deliveries that
    silver hasn't seen are taken in, and nothing else of bronze is read.
    """
    symbols, rules = house.read("silver_symbols"), house.read("knowledge_rules")
    if bars is None:
        touched = take_in(house, "bronze_daily_ohlcv", "silver_ohlcv", silver.silver_ohlcv, DAY, "date")
        if touched is None:
            return
    else:
        arrived = touched_since(bars, "ingestion_time", house.read("silver_ohlcv"))
        touched = house.merge("silver_ohlcv", silver.silver_ohlcv(arrived), DAY)
    touched = touched.select(*DAY)
    span = bounds(touched)
    if span is None:
        return
    first = span[0]

    changed = {}
    for model in SERIES_MODELS:
        clean = house.with_history("silver_ohlcv", first, model.lookback, calendar_days(model.lookback))
        rows = recompute_touched(
            lambda b, m=model, s=series_blocks(clean): m.build(b, symbols, **s), clean, touched, lookback=model.lookback
        )
        changed[model.name] = house.merge(model.name, rows, DAY)
    volatility = house.with_history(
        "gold_volatility_index", first, gold.FENCE_ROWS, calendar_days(gold.FENCE_ROWS))
    flags = recompute_touched(gold.anomaly_flags, volatility, touched, lookback=gold.FENCE_ROWS)
    house.merge("gold_anomaly_flags", flags, (*DAY, "anomaly_type"))
    house.merge("decision_cf_engine",
                decision.cf_engine(changed["gold_technical_rating"], rules), DAY)

    # what spans symbols changes on every date on which some symbol has changed
    dates = written(changed["gold_volatility_index"].select("date").distinct(), "dates")
    span = bounds(dates)
    if span is None:
        return
    clean = house.with_history("silver_ohlcv", span[0], 1, calendar_days(1))
    returns = on(dates, gold.daily_return(clean, symbols))
    house.merge("gold_sector_performance", gold.sector_performance(returns), ("sector", "date"))
    volatility = house.with_history(
        "gold_volatility_index", span[0], decision.DOWN_ROWS, calendar_days(decision.DOWN_ROWS))
    metarules = decision.metarule_flags(on(dates, house.read("gold_anomaly_flags", *span)), volatility)
    house.merge("decision_metarule_flags", on(dates, metarules), DAY)
    house.merge("decision_signals", _signals(house, dates, span), DAY)


def calendar_days(rows: int) -> int:
    """Days that hold so many trading days of a symbol that is traded regularly."""
    return 2 * rows + 31


def on(dates: DataFrame | None, df: DataFrame) -> DataFrame:
    return df if dates is None else df.join(dates, "date", "left_semi")


def _signals(
    house: Warehouse, dates: DataFrame | None = None, span: tuple[dt.date, dt.date] = (None, None)
) -> DataFrame:
    names = (
        "gold_technical_rating", "gold_52w_levels", "gold_volatility_index", "gold_anomaly_flags",
        "gold_sector_performance", "decision_cf_engine", "decision_metarule_flags",
    )
    return decision.decision_signals(*[on(dates, house.read(name, *span)) for name in names])


def record_outcomes(house: Warehouse, today: dt.date, oldest: int | None = decision.OLDEST_PENDING_DAYS) -> None:
    """Add the outcomes that have become known, then bring lookup and validation up to date.

    Signals and prices are read from the months in play only. A new outcome counts for
    the signals from the day on which it is known, so only those and the signals not
    looked up yet are looked up.
    """
    since = None if oldest is None else today - dt.timedelta(days=oldest)
    signals = house.read("decision_signals", since, today)
    recorded = tables.read_if_present(
        house.spark, house.path("decision_case_outcomes"), schemas.CASE_OUTCOMES
    )
    pending = written(decision.pending_signals(signals, recorded, F.lit(today), oldest=oldest), "pending")
    span = value_range(pending, decision.LAST_DAY_AHEAD)
    known = house.table("decision_case_outcomes").version()
    added = None
    if span:
        prices = decision.prices_in_play(pending, house.read("silver_ohlcv", *span))
        outcomes = decision.case_outcomes(pending, prices)
        added = house.merge("decision_case_outcomes", outcomes, ("symbol", "signal_date"), date="signal_date")
    if not house.exists("decision_case_outcomes"):
        return
    _look_up(house, str(known.number) if known else None, added)
    library, signals = house.read("decision_case_outcomes"), house.read("decision_signals")
    house.replace("decision_validation", decision.validation(library, signals), date=None)


def _look_up(house: Warehouse, known: str | None, added: DataFrame | None) -> None:
    """Bring the lookup up to date after outcomes were ``added`` to their version ``known``.

    Stored totals hold what was known by month. Only the months from the first on in which something changes are counted
    anew, from the signals and outcomes that can become known in them, and the sums go on from the totals before. Both
    tables note the version of the outcomes they follow; where that is not ``known``, a run has broken off in between and
    they are made anew.
    """
    notes = {OUTCOMES: str(house.table("decision_case_outcomes").version().number)}
    followed = {house.note(name, OUTCOMES) for name in ("decision_case_totals", "decision_cbr_lookup")}
    if followed != {known} or known is None:
        library, signals = house.read("decision_case_outcomes"), house.read("decision_signals")
        house.replace("decision_case_totals", decision.case_totals(signals, library), "known_on", notes)
        house.replace("decision_cbr_lookup", decision.cbr_lookup(signals, library), notes=notes)
        return
    from_day = _first_changed(house, added)
    if from_day is None:
        return
    first = from_day.replace(day=1)
    # what becomes known from then on are outcomes of signals at most so long before
    in_play = first - dt.timedelta(days=decision.LAST_DAY_AHEAD)
    library, signals = house.read("decision_case_outcomes", in_play), house.read("decision_signals", in_play)
    totals = decision.case_totals(signals, library).filter(F.col("known_on") >= F.lit(first))
    months = [m for m in house.table("decision_case_totals").version().parts if int(m) >= first.year * 100 + first.month]
    house.table("decision_case_totals").commit(
        tables.by_month(stamped("decision_case_totals", totals), "known_on"), removed=months, notes=notes)
    before = house.read("decision_case_totals", until=first - dt.timedelta(days=1))
    asked = signals.filter(F.col("date") >= F.lit(from_day))
    found = decision.cbr_lookup(asked, library, features=signals, before=before, since=F.lit(first))
    house.merge("decision_cbr_lookup", found, DAY, notes=notes)


def _first_changed(house: Warehouse, added: DataFrame | None) -> dt.date | None:
    """The first day on which a signal's lookup may differ from the stored one."""
    month = max((int(m) for m in house.table("decision_cbr_lookup").version().parts), default=None)
    newest = dt.date(month // 100, month % 100, 1) if month else None
    last = house.read("decision_cbr_lookup", newest).agg(F.max("date")).first()[0]
    signals = house.read("decision_signals", last)
    unseen = signals.filter(F.col("date") > F.lit(last)).agg(F.min("date")).first()[0] if last else signals.agg(F.min("date")).first()[0]
    # an outcome that was open before counts anew from its first day
    known = added.agg(F.min("known_5d")).first()[0] if added is not None else None
    return min((d for d in (unseen, known) if d is not None), default=None)


def check_tables(
    house: Warehouse, since: dt.date | None = None, now: dt.datetime | None = None
) -> DataFrame:
    """Check every table that is there, add the report to ``quality_reports`` and return it.

    ``since`` restricts the checks to the months from that day on, as after a refresh. Nothing fails by
    itself: whoever runs the job decides by the report's ``status``. Ages are told against ``now``.
    """
    reports = [
        checks.table_report(name, house.read(name, since), contract, now and now.isoformat(" "))
        for name, contract in checks.CONTRACTS.items() if house.exists(name)
    ]
    report = written(reduce(DataFrame.union, reports).withColumn("checked_at", F.current_timestamp()), "report")
    tables.append(report, house.path("quality_reports"))
    return report


def score_outliers(house: Warehouse, start: str) -> None:
    """One half-yearly run of the batch detectors, kept apart from the stored flags."""
    first = dt.date.fromisoformat(start)
    since = first - dt.timedelta(days=31 * detectors.LOOKBACK_MONTHS)
    until = first + dt.timedelta(days=31 * detectors.RUN_MONTHS)
    volatility = house.read("gold_volatility_index", since, until)
    features = written(detectors.run_features(volatility, start), "run")
    verdicts = detectors.detect_all(features)
    house.merge("gold_batch_anomalies", verdicts, (*DAY, "anomaly_type"))
