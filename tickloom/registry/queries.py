"""The registered queries: one callable and, where SQL can say it, one statement per name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom import jobs, schemas
from tickloom.functions import dates, labels, numeric as n, text
from tickloom.jobs import Warehouse
from tickloom.operators import quality, upsert as up
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.series import with_series
from tickloom.plans import checks, decision, detectors, gold, readside, silver
from tickloom.registry.inputs import Inputs
from tickloom.registry.oracle import LIT, VOTES, fixed, forest_statement, frame, pct, rnd, statement
from tickloom.session import scratch_path, written
from tickloom.sources import bars as bar_source, seeds, tables
from tickloom.sources.ticks import decode_ticks
from tickloom.sources.versions import VersionedTable
from tickloom.streaming.ticks import bronze_stream, compact_days, distinct_writer, read_bronze

# Parameters of the queries that take one.
CUT_DATE = "1999-06-30"
RESUMED_FROM = "1998-01-01"
WINDOW_START, WINDOW_DAYS = "1998-03-01", 7
CHECK_TIME = "2024-01-31 12:00:00"
TRACED_SYMBOL = "NATION_1"


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Register the function under its own name."""

    def register(run: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """UTC times without a zone, as the checked tables hold them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# --- sources and sinks -------------------------------------------------------------------


@query("SELECT * FROM ticks_decoded")
def ticks_from_json(i: Inputs) -> DataFrame:
    return plain_times(decode_ticks(i.tick_messages))


def in_batches(df: DataFrame, name: str, files: int = 4) -> DataFrame:
    """The rows as a file stream that brings one file, in no order of time, per micro-batch."""
    path = scratch_path(df.sparkSession, name)
    df.repartition(files).write.parquet(path)
    return (
        df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    )


@query("SELECT symbol, event_time, price, volume, event_date FROM ticks_decoded")
def stream_ticks(i: Inputs) -> DataFrame:
    """The stream over the events in several micro-batches, run to its end, and the table it wrote."""
    path = scratch_path(i.spark, "bronze-ticks")
    checkpoint = scratch_path(i.spark, "bronze-ticks-state")
    messages = in_batches(i.tick_messages, "messages")
    bronze_stream(messages, path, checkpoint, interval=None).start().awaitTermination()
    # closed days are compacted, the last ones stay as the stream wrote them
    last = read_bronze(i.spark, path).agg(F.max("event_date")).first()[0]
    compact_days(i.spark, path, last)
    stored = read_bronze(i.spark, path)
    return plain_times(stored.select("symbol", "event_time", "price", "volume", "event_date"))


@query("""
SELECT symbol, date, close, volume, CAST(NULL AS VARCHAR) AS sector FROM silver WHERE date <= DATE '1999-06-30'
UNION ALL
SELECT symbol, date, close, CAST(NULL AS BIGINT), sector FROM known_bars WHERE date > DATE '1999-06-30'""")
def schema_sync(i: Inputs) -> DataFrame:
    """An append that brings a new column and lacks an old one, written and read back."""
    date, path = F.col("date"), scratch_path(i.spark, "synced")
    bars = i.stored.silver_bars
    old = bars.filter(date <= CUT_DATE).select("symbol", "date", "close", "volume")
    new = gold.with_dimension(bars.filter(date > CUT_DATE), i.symbols, "sector")
    tables.append(old, path)
    tables.append(new.select("symbol", "date", "close", "sector"), path)
    return tables.read_merged(i.spark, path)


@query(f"""
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close,
       CASE WHEN (date - DATE '1995-01-01') % 13 = 4 THEN 0 ELSE volume END AS volume,
       {rnd('((open + high + low + close) / 4)', 4)} AS vwap, 0::BIGINT AS transactions
FROM bars_raw WHERE (date - DATE '1995-01-01') % 17 <> 6""")
def bars_ingest(i: Inputs) -> DataFrame:
    """The raw bars as a wide frame, one column per symbol and field, and back to long rows."""
    day = F.datediff("date", F.lit("1995-01-01").cast("date"))
    gaps = i.bars_raw.withColumns({
        "open": F.when(day % 17 != 6, F.col("open")),
        "volume": F.when(day % 13 != 4, F.col("volume")),
    })
    # one column block per symbol of the dimension
    symbols = [r.symbol for r in i.symbols.select("symbol").orderBy("symbol").collect()]
    wide = gaps.groupBy(F.col("date").alias("Date")).pivot("symbol", symbols).agg(*[
        F.first(f.lower()).alias(f) for f in bar_source.BAR_FIELDS
    ])
    return bar_source.bars_from_wide(wide, symbols)


@query("SELECT * FROM symbols")
def dim_symbols(i: Inputs) -> DataFrame:
    return i.symbols


@query("""
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT min(date) AS lo, max(date) AS hi FROM silver)""")
def date_spine(i: Inputs) -> DataFrame:
    bounds = i.silver_bars.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return dates.date_spine(bounds)


@query("SELECT symbol, date, close FROM known_bars WHERE sector IN ('AFRICA', 'ASIA')")
def symbol_universe(i: Inputs) -> DataFrame:
    wanted = i.symbols.filter(F.col("sector").isin("AFRICA", "ASIA"))
    return bar_source.in_universe(i.silver_bars, wanted).select("symbol", "date", "close")


@query(f"""
SELECT symbol, date, {rnd('close', 4)} AS price, volume,
       {rnd(f'(close - close * 0.001{LIT} / 2)', 4)} AS bid, {rnd(f'(close + close * 0.001{LIT} / 2)', 4)} AS ask
FROM silver""")
def bar_to_quote(i: Inputs) -> DataFrame:
    return bar_source.quotes_from_bars(i.silver_bars)


@query("""
SELECT event_id, dayofweek(there) BETWEEN 0 AND 4
       AND CAST(there AS TIME) BETWEEN TIME '10:00:00' AND TIME '15:00:00' AS is_open
FROM (SELECT event_id, ts + INTERVAL 3 HOUR AS there FROM events)""")
def session_flag(i: Inputs) -> DataFrame:
    return i.table("events").select("event_id", dates.is_session_open(F.col("ts")).alias("is_open"))


@query("""
SELECT f.symbol, f.date, f.anomaly_type, f.score, f.threshold, f.is_anomaly, 'sql' AS detector FROM flags f
LEFT JOIN (SELECT DISTINCT date, anomaly_type FROM run_volume) r ON r.date = f.date AND r.anomaly_type = f.anomaly_type
WHERE r.date IS NULL
UNION ALL
SELECT symbol, date, anomaly_type, score, threshold, is_anomaly, 'batch' FROM run_volume""")
def upsert_keys(i: Inputs) -> DataFrame:
    """Batch verdicts take the place of the stored ones of the same date and type."""
    i = i.stored
    flags = i.flags.withColumn("detector", F.lit("sql"))
    batch = detectors.batch_volume_zscore(detectors.ml_features(i.volatility))
    return up.upsert(flags, batch.withColumn("detector", F.lit("batch")), ["date", "anomaly_type"])


@query("SELECT * FROM volatility")
def incremental_upsert(i: Inputs) -> DataFrame:
    """Volatility up to a cut, committed, then brought up to date by a second commit; equals the full run."""
    bars = i.stored.silver_bars
    house = Warehouse(i.spark, scratch_path(i.spark, "incremental"))
    model = lambda b: gold.volatility_index(b, i.symbols)
    house.replace("gold_volatility_index", model(bars.filter(F.col("date") <= CUT_DATE)))
    touched = up.newer_than(bars, "date", house.read("gold_volatility_index"))
    fresh = up.recompute_touched(model, bars, touched, lookback=max(gold.VOLATILITY_FRAMES))
    house.merge("gold_volatility_index", fresh, ["symbol", "date"])
    return house.read("gold_volatility_index")


@query("""
SELECT symbol, date, close FROM silver WHERE date >= DATE '1998-03-01' AND date < DATE '1998-03-08'
UNION ALL
SELECT symbol, date, close FROM bars_raw WHERE NOT (date >= DATE '1998-03-01' AND date < DATE '1998-03-08')""")
def publish_window(i: Inputs) -> DataFrame:
    """A week of an older serving copy replaced by the current bars, read back."""
    path = scratch_path(i.spark, "serving")
    old = i.bars_raw.select("symbol", "date", "close")
    new = i.silver_bars.select("symbol", "date", "close")
    tables.load_version(old, path, "date")
    tables.publish_window(new, path, "date", WINDOW_START, WINDOW_DAYS)
    return tables.read_version(i.spark, path)


@query("""
SELECT symbol, date, close FROM silver WHERE date >= DATE '1999-07-01'
UNION ALL SELECT symbol, date, close FROM bars_raw WHERE date < DATE '1999-07-01'""")
def write_partition_replace(i: Inputs) -> DataFrame:
    """A table by month in which the later months are committed a second time."""
    table = VersionedTable(i.spark, scratch_path(i.spark, "partitions"))
    old = i.bars_raw.select("symbol", "date", "close")
    new = i.silver_bars.filter(F.col("date") > CUT_DATE).select("symbol", "date", "close")
    table.commit(tables.by_month(old, "date"))
    table.commit(tables.by_month(new, "date"))
    return table.read().drop("month")


@query("SELECT symbol, date, close FROM silver")
def write_bulk(i: Inputs) -> DataFrame:
    """A table loaded whole and replaced whole by a second load."""
    path = scratch_path(i.spark, "bulk")
    tables.bulk_load(i.bars_raw.select("symbol", "date", "close"), path)
    tables.bulk_load(i.silver_bars.select("symbol", "date", "close"), path)
    return i.spark.read.parquet(path)


@query("""
SELECT 'silver_ohlcv' AS table_name, symbol, date, close, volume, (SELECT count(*) FROM silver) AS published FROM silver
UNION ALL SELECT 'silver_symbols', symbol, NULL, NULL, NULL, (SELECT count(*) FROM symbols) FROM symbols
UNION ALL SELECT 'gold_52w_levels', NULL, NULL, NULL, NULL, NULL""")
def publish_full(i: Inputs) -> DataFrame:
    """Two tables copied to a serving folder and read back, a third one absent from the source and skipped."""
    base = scratch_path(i.spark, "publish")
    i.silver_bars.write.parquet(f"{base}/in/silver_ohlcv")
    i.symbols.write.parquet(f"{base}/in/silver_symbols")
    counts = tables.publish_all(
        i.spark, f"{base}/in", f"{base}/out",
        only=["silver_ohlcv", "silver_symbols", "gold_52w_levels"],
    )
    told = i.spark.createDataFrame(list(counts.items()), "table_name string, published bigint")
    copies = [
        tables.read_version(i.spark, f"{base}/out/{name}").withColumn("table_name", F.lit(name))
        for name in ("silver_ohlcv", "silver_symbols")
    ]
    rows = copies[0].unionByName(copies[1], allowMissingColumns=True)
    return told.join(rows, "table_name", "left").select(
        "table_name", "symbol", "date", "close", "volume", "published")


@query("SELECT DISTINCT symbol, event_time FROM ticks")
def stream_dedup(i: Inputs) -> DataFrame:
    """The ticks and their repeats as a stream, each symbol and time stored once, however late it comes."""
    path = scratch_path(i.spark, "dedup")
    streamed = in_batches(i.ticks.select("symbol", "event_time", "event_date"), "ticks")
    (
        streamed.writeStream.foreachBatch(distinct_writer(path))
        .option("checkpointLocation", scratch_path(i.spark, "dedup-state"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return plain_times(i.spark.read.parquet(path).select("symbol", "event_time"))


@query("SELECT * FROM silver")
def late_bars(i: Inputs) -> DataFrame:
    """Silver from three deliveries: old days, then new ones, then late and corrected rows of old days."""
    house = Warehouse(i.spark, scratch_path(i.spark, "late-bars"))
    bars = written(i.bars, "bronze")
    late = F.pmod(F.xxhash64("symbol", "date", "ingestion_time"), F.lit(5)) == 0
    old = F.col("date") <= CUT_DATE
    for part in (old & ~late, ~old, old & late):
        jobs.deliver(house, "bronze_daily_ohlcv", bars.filter(part))
        jobs.take_in(house, "bronze_daily_ohlcv", "silver_ohlcv", silver.silver_ohlcv, jobs.DAY, "date")
    return plain_times(house.read("silver_ohlcv"))


@query("SELECT * FROM vwap")
def late_ticks(i: Inputs) -> DataFrame:
    """Sessions from two deliveries of ticks, the second of which brings late ones of all days."""
    house = Warehouse(i.spark, scratch_path(i.spark, "late-ticks"))
    house.replace("tick_symbols", i.tick_symbols, date=None)
    late = F.pmod(F.xxhash64("symbol", "event_time", "ingestion_time"), F.lit(4)) == 0
    for part in (~late, late):
        jobs.deliver(house, "bronze_ticks", i.ticks.filter(part))
        jobs.refresh_ticks(house)
    return plain_times(house.read("gold_intraday_vwap"))


_votes_long = " UNION ALL ".join(
    f"SELECT 'R0{k}' AS rule_id, {v} AS vote FROM ratings" for k, v in enumerate(VOTES, 1)
)


@query(f"""
SELECT r.*, coalesce(v.buy_votes, 0) AS buy_votes, coalesce(v.sell_votes, 0) AS sell_votes
FROM rules r LEFT JOIN (
  SELECT rule_id, count(*) FILTER (vote = 1) AS buy_votes, count(*) FILTER (vote = -1) AS sell_votes
  FROM ({_votes_long}) GROUP BY rule_id) v ON r.rule_id = v.rule_id""")
def seed_rules(i: Inputs) -> DataFrame:
    """All seeded rules with how often each has voted; those that do not vote have 0."""
    votes = i.ratings.agg(*[
        expr for v in gold.VOTES for expr in (
            F.count_if(F.col(v) == 1).alias(f"{v}__buy"), F.count_if(F.col(v) == -1).alias(f"{v}__sell")
        )
    ])
    counted = votes.select(F.inline(F.array(*[
        F.struct(F.lit(v).alias("indicator_column"), F.col(f"{v}__buy").alias("buy_votes"),
                 F.col(f"{v}__sell").alias("sell_votes"))
        for v in gold.VOTES
    ])))
    return i.rules.join(counted, "indicator_column", "left").fillna(0, ["buy_votes", "sell_votes"])


# --- silver and its operators ------------------------------------------------------------


@query("SELECT * FROM silver")
def silver_ohlcv(i: Inputs) -> DataFrame:
    return plain_times(i.silver_bars)


@query("SELECT * FROM silver_tick")
def silver_ticks(i: Inputs) -> DataFrame:
    return plain_times(silver.silver_ticks(i.ticks))


@query("""
SELECT * EXCLUDE rn FROM (
  SELECT symbol, event_time, price, ingestion_time,
         row_number() OVER (PARTITION BY symbol, event_time ORDER BY ingestion_time DESC) AS rn
  FROM ticks) WHERE rn = 1""")
def dedup_latest(i: Inputs) -> DataFrame:
    ticks = i.ticks.select("symbol", "event_time", "price", "ingestion_time")
    return plain_times(latest_per_key(ticks, ["symbol", "event_time"], "ingestion_time"))


@query("""
SELECT t.symbol, t.event_time, t.price, s.company_name, s.sector, s.market_cap_tier
FROM silver_tick t JOIN tick_symbols s ON t.symbol = s.symbol""")
def dim_enrich(i: Inputs) -> DataFrame:
    ticks = silver.silver_ticks(i.ticks).select("symbol", "event_time", "price")
    return plain_times(
        gold.with_dimension(ticks, i.tick_symbols, "company_name", "sector", "market_cap_tier")
    )


# --- gold --------------------------------------------------------------------------------


@query("SELECT * FROM vwap")
def intraday_vwap(i: Inputs) -> DataFrame:
    return plain_times(gold.intraday_vwap(silver.silver_ticks(i.ticks), i.tick_symbols))


@query("SELECT * FROM returns")
def daily_return(i: Inputs) -> DataFrame:
    return i.returns


@query("SELECT * FROM sectors")
def sector_performance(i: Inputs) -> DataFrame:
    return i.sectors


@query("SELECT * FROM volatility")
def volatility_index(i: Inputs) -> DataFrame:
    return i.volatility


@query("SELECT * FROM levels")
def levels_52w(i: Inputs) -> DataFrame:
    return i.levels


@query("SELECT * FROM ratings")
def technical_rating(i: Inputs) -> DataFrame:
    return i.ratings


_smas = {f"sma{rows}": rows for rows in gold.MEAN_FRAMES}


@query("SELECT symbol, date, " + ", ".join(
    f"{rnd(name, 2)} AS {name}" for name in _smas
) + " FROM (SELECT symbol, date, " + ", ".join(
    f"avg(close) {frame(rows)} AS {name}" for name, rows in _smas.items()
) + " FROM silver)")
def sma_set(i: Inputs) -> DataFrame:
    bars = i.silver_bars.select("symbol", "date", "close")
    means = with_series(bars, [lambda over: {
        name: F.avg("close").over(over(rows)) for name, rows in _smas.items()
    }])
    return means.withColumns(n.rounded(**dict.fromkeys(_smas, 2))).drop("close")


@query("SELECT symbol, date, rsi AS rsi14 FROM indicators")
def rsi(i: Inputs) -> DataFrame:
    return i.ratings.select("symbol", "date", "rsi14")


@query("SELECT * FROM flags_volume")
def volume_zscore(i: Inputs) -> DataFrame:
    return gold.volume_zscore(i.volatility)


@query("SELECT * FROM flags_price")
def price_iqr(i: Inputs) -> DataFrame:
    return gold.price_iqr(i.volatility)


@query("SELECT * FROM flags")
def anomaly_flags(i: Inputs) -> DataFrame:
    return i.flags


@query("SELECT * FROM flag_pivot")
def anomaly_pivot(i: Inputs) -> DataFrame:
    return gold.anomaly_pivot(i.flags)


# --- decision ----------------------------------------------------------------------------


@query("SELECT * FROM certainty")
def cf_engine(i: Inputs) -> DataFrame:
    return decision.cf_engine(i.ratings, i.rules)


@query("SELECT * FROM streak")
def down_streak(i: Inputs) -> DataFrame:
    return decision.down_streak(i.volatility)


@query("SELECT * FROM metarules")
def metarule_flags(i: Inputs) -> DataFrame:
    return decision.metarule_flags(i.stored.flags, i.stored.volatility)


def _signal_inputs(i: Inputs) -> DataFrame:
    i = i.stored
    return decision.signal_inputs(
        i.ratings, i.levels, i.volatility, gold.anomaly_pivot(i.flags), i.sectors,
        decision.cf_engine(i.ratings, i.rules), decision.metarule_flags(i.flags, i.volatility),
    )


@query("SELECT * FROM inputs")
def signal_inputs(i: Inputs) -> DataFrame:
    return _signal_inputs(i)


@query("SELECT * FROM signals")
def decision_signals(i: Inputs) -> DataFrame:
    return i.signals


@query("SELECT * FROM binned")
def feature_bins(i: Inputs) -> DataFrame:
    return decision.feature_bins(i.signals)


@query("""
SELECT symbol, date, signal, combined_cf, signal_score, sector, close AS close_at_signal FROM signals
WHERE date BETWEEN (SELECT max(date) FROM signals) - 30 AND (SELECT max(date) FROM signals) - 5
  AND NOT (EXISTS (SELECT 1 FROM outcomes o WHERE o.symbol = signals.symbol AND o.signal_date = signals.date
                   AND o.close_20d IS NOT NULL AND (o.signal_date - DATE '1995-01-01') % 2 = 0))""")
def pending_signals(i: Inputs) -> DataFrame:
    """Signals of the last weeks without an outcome, in a library that knows every other day."""
    day = F.datediff("signal_date", F.lit("1995-01-01").cast("date"))
    recorded = i.outcomes.filter(day % 2 == 0)
    return decision.pending_signals(i.stored_signals, recorded, i.last_date)


_pending = """
FROM signals WHERE date BETWEEN DATE '1999-06-30' - 30 AND DATE '1999-06-30' - 5
  AND sector IN ('AFRICA', 'ASIA')"""


@query(f"""
SELECT symbol, date, close FROM silver
WHERE symbol IN (SELECT symbol {_pending})
  AND date BETWEEN (SELECT min(date) {_pending}) AND (SELECT max(date) {_pending}) + 24""")
def prices_in_play(i: Inputs) -> DataFrame:
    """The prices that one day's pending signals of two regions need."""
    known = i.stored_signals.filter(F.col("sector").isin("AFRICA", "ASIA"))
    none_yet = seeds.empty_table(i.spark, schemas.CASE_OUTCOMES)
    pending = written(
        decision.pending_signals(known, none_yet, F.lit(CUT_DATE).cast("date")), "pending")
    return decision.prices_in_play(pending, i.silver_bars.select("symbol", "date", "close"))


@query("""
SELECT symbol, date, close, close_5d, close_20d FROM forward""")
def forward_close(i: Inputs) -> DataFrame:
    bars = i.silver_bars.select("symbol", "date", "close")
    return decision.forward_close(bars, bars)


@query("SELECT * FROM outcomes")
def case_outcomes(i: Inputs) -> DataFrame:
    """The library of the whole history."""
    return i.outcomes


@query("SELECT * FROM lookup_all")
def cbr_lookup(i: Inputs) -> DataFrame:
    return decision.cbr_lookup(i.stored_signals, i.stored_outcomes, known_only=False)


@query("SELECT * FROM lookup_known")
def cbr_lookup_known(i: Inputs) -> DataFrame:
    return decision.cbr_lookup(i.stored_signals, i.stored_outcomes)


@query("SELECT * FROM lookup_known")
def cbr_lookup_resumed(i: Inputs) -> DataFrame:
    """The lookup in two instalments: up to a month, then from the stored totals of the months before it on."""
    signals, outcomes = i.stored_signals, i.stored_outcomes
    first = F.lit(RESUMED_FROM).cast("date")
    early = F.col("date") < first
    totals = decision.case_totals(signals, outcomes).filter(F.col("known_on") < first)
    before = written(totals, "case-totals")
    in_play = F.date_sub(first, decision.LAST_DAY_AHEAD)
    recent = outcomes.filter(F.col("signal_date") >= in_play)
    resumed = decision.cbr_lookup(
        signals.filter(~early), recent, features=signals.filter(F.col("date") >= in_play), before=before, since=first)
    return decision.cbr_lookup(signals.filter(early), outcomes, features=signals).unionByName(resumed)


@query("SELECT * FROM valid")
def validation(i: Inputs) -> DataFrame:
    return decision.validation(i.stored_outcomes, i.stored_signals)


# --- batch detectors ---------------------------------------------------------------------


@query("SELECT * FROM run_rows")
def ml_features(i: Inputs) -> DataFrame:
    return detectors.ml_features(i.volatility)


@query("SELECT * FROM run_volume")
def batch_volume_zscore(i: Inputs) -> DataFrame:
    return detectors.batch_volume_zscore(detectors.ml_features(i.volatility))


@query("SELECT * FROM run_price")
def batch_price_iqr(i: Inputs) -> DataFrame:
    return detectors.batch_price_iqr(detectors.ml_features(i.volatility))


def _scaled(f: str) -> str:
    whole = "OVER (PARTITION BY window_start, symbol)"
    z = f"(({f} - avg({f}) {whole}) / nullif(stddev_pop({f}) {whole}, 0))"
    return f"coalesce(CASE WHEN stddev_pop({f}) {whole} > 1e-9 THEN {z} END, 0.0{LIT}) AS {f}_z"


@query("SELECT window_start, symbol, date, " + ", ".join(
    f"{rnd(f'{f}_z', 6)} AS {f}_scaled" for f in detectors.FOREST_FEATURES
) + f", {rnd('mm', 6)} AS volume_minmax FROM (SELECT window_start, symbol, date, " + ", ".join(
    _scaled(f) for f in detectors.FOREST_FEATURES
) + f""", coalesce((volume - min(volume) OVER (PARTITION BY window_start, symbol))::DOUBLE
  / nullif(max(volume) OVER (PARTITION BY window_start, symbol)
           - min(volume) OVER (PARTITION BY window_start, symbol), 0), 0.0{LIT}) AS mm
FROM run_rows WHERE vol_20d IS NOT NULL)""")
def zscore_scale(i: Inputs) -> DataFrame:
    return detectors.zscore_scale(detectors.ml_features(i.volatility))


@query(forest_statement("(SELECT *, abs(log_return) AS isolation FROM run_rows)"))
def forest_verdicts(i: Inputs) -> DataFrame:
    """What becomes of isolation scores, on scores that both engines know: the size of the move."""
    runs = detectors.ml_features(i.volatility)
    return detectors.forest_verdicts(runs.withColumn("isolation", F.abs("log_return")))


@query("""
SELECT symbol, date, FALSE AS by_forest, bool_or(anomaly_type = 'volume_zscore' AND is_anomaly) AS by_volume,
       bool_or(anomaly_type = 'price_iqr' AND is_anomaly) AS by_price, FALSE AS all_agree
FROM (SELECT * FROM run_volume UNION ALL SELECT * FROM run_price) GROUP BY symbol, date""")
def agreement_of_two(i: Inputs) -> DataFrame:
    """The agreement over the two detectors that SQL can express."""
    runs = written(detectors.ml_features(i.volatility), "runs")
    both = detectors.batch_volume_zscore(runs).unionByName(detectors.batch_price_iqr(runs))
    return detectors.triple_agreement(both)


@query()
def isolation_forest(i: Inputs) -> DataFrame:
    return detectors.isolation_forest(detectors.ml_features(i.volatility))


@query()
def triple_agreement(i: Inputs) -> DataFrame:
    runs = written(detectors.ml_features(i.volatility), "runs")  # read by three detectors
    return detectors.triple_agreement(detectors.detect_all(runs))


# --- scalar functions --------------------------------------------------------------------


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('ln(l_extendedprice)', 6)} AS ln_price,
       {rnd('sqrt(l_quantity)', 6)} AS sqrt_quantity, abs(l_discount - l_tax) AS abs_gap,
       greatest(l_discount, l_tax) AS larger, least(l_discount, l_tax) AS smaller,
       {rnd('(l_discount / nullif(l_tax, 0))', 6)} AS guarded,
       {rnd('((l_extendedprice - l_quantity) / l_quantity)', 4)} AS pct_change,
       coalesce(nullif(l_tax, 0), -1.0{LIT}) AS tax_or_default,
       CASE WHEN l_discount >= 0 AND NOT (l_tax > 0.04{LIT} OR l_quantity < 10) THEN 'plain' ELSE 'other' END AS kind
FROM lineitem""")
def scalar_math(i: Inputs) -> DataFrame:
    c = F.col
    plain = (c("l_discount") >= 0) & ~((c("l_tax") > 0.04) | (c("l_quantity") < 10))
    return i.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        n.round_half_up(F.ln("l_extendedprice"), 6).alias("ln_price"),
        n.round_half_up(F.sqrt("l_quantity"), 6).alias("sqrt_quantity"),
        F.abs(c("l_discount") - c("l_tax")).alias("abs_gap"),
        F.greatest("l_discount", "l_tax").alias("larger"),
        F.least("l_discount", "l_tax").alias("smaller"),
        n.round_half_up(n.ratio(c("l_discount"), c("l_tax")), 6).alias("guarded"),
        n.round_half_up(n.pct_change(c("l_extendedprice"), c("l_quantity")), 4).alias("pct_change"),
        F.coalesce(F.nullif(c("l_tax"), F.lit(0.0)), F.lit(-1.0)).alias("tax_or_default"),
        F.when(plain, F.lit("plain")).otherwise(F.lit("other")).alias("kind"),
    )


@query(f"""
SELECT c_custkey, c_name || '/' || c_mktsegment AS joined,
       c_name || CASE WHEN c_acctbal < 0 THEN NULL ELSE '+' END AS null_spreads,
       trim('  ' || c_mktsegment || ' ') AS trimmed, CAST(c_custkey AS VARCHAR) AS key_text,
       CAST(c_acctbal > 0 AS VARCHAR) AS flag_text, {fixed('c_acctbal', 2)} AS balance_text,
       {pct('(c_acctbal / 10000.0)', 1)} AS share_text,
       CASE WHEN c_acctbal < 0 THEN '; overdrawn' ELSE '' END AS note
FROM customer""")
def scalar_string(i: Inputs) -> DataFrame:
    c = F.col
    overdrawn = c("c_acctbal") < 0
    return i.table("customer").select(
        "c_custkey",
        text.sentence(c("c_name"), "/", c("c_mktsegment")).alias("joined"),
        F.concat("c_name", F.when(~overdrawn, F.lit("+"))).alias("null_spreads"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        c("c_custkey").cast("string").alias("key_text"),
        (c("c_acctbal") > 0).cast("string").alias("flag_text"),
        text.fixed(c("c_acctbal"), 2).alias("balance_text"),
        text.percent(c("c_acctbal") / 10000.0, 1).alias("share_text"),
        text.fragment(overdrawn, "; overdrawn").alias("note"),
    )


@query("""
SELECT o_orderkey, CAST(date_trunc('month', day) AS DATE) AS month, day + 20 AS plus_20,
       CAST(day + to_days(3 * 7) AS DATE) AS plus_weeks,
       datediff('day', DATE '1995-01-01', day) AS days_since, strftime(day, '%Y-%m-%d') AS iso_text,
       CAST(strftime(day, '%Y-%m-%d') AS DATE) AS back_to_date,
       CAST(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS back_to_time,
       CAST(day + INTERVAL 6 MONTH AS DATE) AS plus_6_months,
       len(generate_series(0, datediff('day', CAST(date_trunc('month', day) AS DATE), day))) AS day_of_spine
FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)""")
def scalar_date(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    iso = F.date_format(day, "yyyy-MM-dd")
    time_text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return plain_times(i.table("orders").select(
        "o_orderkey", dates.month_of(day).alias("month"), F.date_add(day, 20).alias("plus_20"),
        (day + F.make_interval(weeks=F.lit(3))).cast("date").alias("plus_weeks"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("days_since"),
        iso.alias("iso_text"), iso.cast("date").alias("back_to_date"),
        F.to_timestamp(time_text).alias("back_to_time"),
        F.add_months(day, 6).alias("plus_6_months"),
        F.size(F.sequence(F.lit(0), F.datediff(day, dates.month_of(day)))).cast("bigint")
        .alias("day_of_spine"),
    ))


# --- checks ------------------------------------------------------------------------------

_bar_columns = ["symbol", "date", "open", "high", "low", "close", "volume"]


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS failures FROM bars"
    for c in _bar_columns
))
def dq_not_null(i: Inputs) -> DataFrame:
    return quality.not_null(i.bars, _bar_columns)


@query("""
SELECT 'symbol,date' AS key, count(*) AS repeated_keys, CAST(sum(n) AS BIGINT) AS rows_involved
FROM (SELECT symbol, date, count(*) AS n FROM bars GROUP BY symbol, date HAVING count(*) > 1)""")
def dq_unique(i: Inputs) -> DataFrame:
    return quality.unique(i.bars, ["symbol", "date"])


@query("""
SELECT 'session_status' AS column_name, session_status AS value, count(*) AS failures FROM ticks
WHERE session_status NOT IN ('live', 'simulated', 'pre-market', 'post-market') GROUP BY session_status""")
def dq_accepted_values(i: Inputs) -> DataFrame:
    return quality.accepted_values(i.ticks, "session_status", checks.STATUSES)


@query(f"""
SELECT age AS age_hours, CASE WHEN age > 48 THEN 'error' WHEN age > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT (epoch_us(TIMESTAMP '{CHECK_TIME}') - epoch_us(max(ingestion_time))) / 3.6e9{LIT} AS age FROM ticks)""")
def dq_freshness(i: Inputs) -> DataFrame:
    return quality.freshness(i.ticks, "ingestion_time", CHECK_TIME, warn_hours=24, error_hours=48)


def _contract_sql(name: str, source: str) -> str:
    """The tests of a contract, one statement each."""
    contract = checks.CONTRACTS[name]
    keys = ", ".join(contract.key)
    tests = [
        ("not_null", c, f"SELECT count(*) FILTER ({c} IS NULL) AS failures FROM {source}")
        for c in (*contract.key, *contract.required)
    ] + [
        ("unique", ",".join(contract.key),
         f"SELECT coalesce(sum(n), 0) AS failures FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys}) WHERE n > 1")
    ] + [
        ("accepted_values", c, f"SELECT count(*) FILTER ({c} NOT IN {values}) AS failures FROM {source}")
        for c, values in contract.accepted.items()
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{test}' AS test, '{subject}' AS subject, CAST(failures AS BIGINT) AS failures, "
        f"CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status FROM ({counted})"
        for test, subject, counted in tests
    )


@query(" UNION ALL ".join(
    _contract_sql(name, source) for name, source in
    (("silver_ohlcv", "bars"), ("silver_ticks", "ticks"), ("decision_signals", "signals"))
))
def dq_contracts(i: Inputs) -> DataFrame:
    """The tests of three tables; bars and ticks as they arrive, so that some fail."""
    reports = [
        checks.table_report("silver_ohlcv", i.bars, checks.CONTRACTS["silver_ohlcv"]),
        checks.table_report("silver_ticks", i.ticks, checks.CONTRACTS["silver_ticks"]),
        checks.table_report("decision_signals", i.stored_signals, checks.CONTRACTS["decision_signals"]),
    ]
    return reports[0].union(reports[1]).union(reports[2])


_states = """
SELECT signal, lower(replace(rating, ' ', '_')) AS rating_category, has_price_anomaly AS anomaly,
       coalesce(sector_advance_ratio, 0.5) >= 0.5 AS advance, signal_score < 0 AS negative,
       m02_consecutive_down OR g03_extreme_volatility
         OR (m01_tighten_buy AND signal_score < required_score_for_buy) AS blocks
FROM classified"""
@query(f"""
SELECT state_id, s.signal AS given, expected_signal AS expected, count(*) AS cases,
       s.signal = expected_signal AS conforms
FROM ({_states}) s
LEFT JOIN decision_rows t
  ON s.rating_category = t.rating_category AND CAST(s.anomaly AS VARCHAR) = t.has_price_anomaly
 AND CAST(s.negative AS VARCHAR) = t.signal_score_negative
 AND CAST(s.blocks AS VARCHAR) = t.any_metarule_blocks_buy
 AND (t.sector_advance_gte_50pct = 'any' OR CAST(s.advance AS VARCHAR) = t.sector_advance_gte_50pct)
GROUP BY ALL""")
def dq_decision_table(i: Inputs) -> DataFrame:
    return decision.decision_table_report(_signal_inputs(i), i.decision_table)


# --- read side ---------------------------------------------------------------------------

_latest = "date = (SELECT max(date) FROM signals)"


@query(f"""
SELECT symbol, company_name, sector, close, combined_cf, why_signal FROM signals
WHERE {_latest} AND signal = 'BUY' AND confidence = 'HIGH'""")
def q_latest_buys(i: Inputs) -> DataFrame:
    return readside.latest_buys(i.stored_signals)


@query(f"""
SELECT symbol, signal_score, combined_cf, why_not_buy, active_metarules FROM signals
WHERE {_latest} AND signal = 'HOLD' AND rating IN ('Buy', 'Strong Buy')""")
def q_blocked_buys(i: Inputs) -> DataFrame:
    return readside.blocked_buys(i.stored_signals)


@query(f"""
SELECT date, signal, reasoning_trace, why_signal, why_not_buy FROM signals
WHERE symbol = '{TRACED_SYMBOL}' ORDER BY date DESC LIMIT 10""")
def q_symbol_trace(i: Inputs) -> DataFrame:
    return readside.symbol_trace(i.signals, TRACED_SYMBOL)


@query(f"""
SELECT symbol, close, high_52w, pct_from_high, why_signal, reasoning_trace FROM signals
WHERE {_latest} AND signal = 'SELL' AND at_52w_high""")
def q_sell_near_high(i: Inputs) -> DataFrame:
    return readside.sells_near_high(i.stored_signals)


@query("""
SELECT date, active_metarules, count(*) AS symbols_affected FROM metarules
WHERE date = (SELECT max(date) FROM metarules) AND active_metarules <> '' GROUP BY ALL""")
def q_metarules_today(i: Inputs) -> DataFrame:
    metarules = decision.metarule_flags(i.stored.flags, i.stored.volatility)
    return readside.metarules_on_latest_date(metarules)


@query(f"""
SELECT s.symbol, s.close, s.why_signal, c.cbr_win_rate, c.cbr_avg_return_5d, c.cbr_note
FROM signals s JOIN lookup_known c ON s.symbol = c.symbol AND s.date = c.date
WHERE s.{_latest} AND s.signal = 'BUY' AND c.cbr_win_rate >= 0.65""")
def q_backed_buys(i: Inputs) -> DataFrame:
    signals = i.stored_signals
    return readside.backed_buys(signals, decision.cbr_lookup(signals, i.stored_outcomes))


@query("""
SELECT month, signal, sector, total_signals, accuracy, reliability, avg_return_5d, threshold_sensitive_count
FROM valid""")
def q_accuracy_by_month(i: Inputs) -> DataFrame:
    return readside.accuracy_by_month(decision.validation(i.stored_outcomes, i.stored_signals))


_fired = {
    "G01": "has_price_anomaly", "G02": "coalesce(sector_advance_ratio, 0.5) < 0.5",
    "G03": "g03_extreme_volatility", "M01": "m01_tighten_buy", "M02": "m02_consecutive_down",
}


@query(f"""
SELECT r.rule_id, r.rule_name, r.category, r.certainty_factor, r.condition_description,
       coalesce(f.days, 0) AS days_fired
FROM rules r LEFT JOIN (
  SELECT rule_id, count(*) FILTER (vote <> 0) AS days FROM ({_votes_long}) GROUP BY rule_id
  UNION ALL {' UNION ALL '.join(
      f"SELECT '{rule}', count(*) FILTER ({sql}) FROM inputs" for rule, sql in _fired.items())}
) f ON r.rule_id = f.rule_id WHERE r.is_active""")
def q_active_rules(i: Inputs) -> DataFrame:
    """The active rules with the number of instrument days each took part in."""
    voted = i.stored.ratings.agg(*[
        F.count_if(F.col(v) != 0).alias(f"R0{k}") for k, v in enumerate(gold.VOTES, 1)
    ])
    gated = _signal_inputs(i).agg(*[F.count_if(F.expr(e)).alias(r) for r, e in _fired.items()])
    days = voted.unpivot([], voted.columns, "rule_id", "days_fired").unionByName(
        gated.unpivot([], gated.columns, "rule_id", "days_fired")
    )
    return readside.active_rules(i.rules).join(days, "rule_id", "left").fillna({"days_fired": 0})


@query("""
SELECT 'bronze' AS table_name, symbol, count(*) AS n FROM bars GROUP BY symbol
UNION ALL SELECT 'silver', symbol, count(*) FROM silver GROUP BY symbol
UNION ALL SELECT 'bronze_ticks', symbol, count(*) FROM ticks GROUP BY symbol""")
def q_counts(i: Inputs) -> DataFrame:
    return readside.rows_per_symbol(bronze=i.bars, silver=i.silver_bars, bronze_ticks=i.ticks)


@query(f"""
SELECT symbol, date, {rnd(f'(annualized_vol * 100.0{LIT})', 1)} AS vol_pct FROM volatility
ORDER BY date DESC, symbol LIMIT 10""")
def q_top_vol(i: Inputs) -> DataFrame:
    return readside.newest_volatility(i.volatility)


@query("""
SELECT symbol, date, anomaly_type, score, is_anomaly FROM flags WHERE is_anomaly
ORDER BY date DESC, symbol, anomaly_type LIMIT 10""")
def q_top_anomalies(i: Inputs) -> DataFrame:
    return readside.newest_anomalies(i.flags)


# --- what the driver sees ----------------------------------------------------------------


def _bind(run: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: run(Inputs(spark, str(folder).rstrip("/")))


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(q.run) for name, q in QUERIES.items()}


def statements() -> dict[str, str]:
    return {name: statement(q.sql) for name, q in QUERIES.items() if q.sql}


@query("SELECT * FROM halving_nodes")
def forest_nodes(i: Inputs) -> DataFrame:
    """The nodes of a forest that both engines can grow: first rows, features in turn, cuts in the middle."""
    nodes = detectors.halving_nodes(detectors.ml_features(i.volatility))
    return nodes.withColumns(n.rounded(value=9))


@query("SELECT * FROM run_forest")
def halving_forest(i: Inputs) -> DataFrame:
    """The forest from its rows to its verdicts, with such trees."""
    return detectors.halving_forest(detectors.ml_features(i.volatility))


@query("""
SELECT *, by_forest AND by_volume AND by_price AS all_agree
FROM (SELECT symbol, date, coalesce(bool_or(is_anomaly) FILTER (anomaly_type = 'isolation_forest'), FALSE) AS by_forest,
             coalesce(bool_or(is_anomaly) FILTER (anomaly_type = 'volume_zscore'), FALSE) AS by_volume,
             coalesce(bool_or(is_anomaly) FILTER (anomaly_type = 'price_iqr'), FALSE) AS by_price
      FROM (SELECT * FROM run_forest UNION ALL SELECT * FROM run_volume UNION ALL SELECT * FROM run_price)
      GROUP BY symbol, date)""")
def halving_agreement(i: Inputs) -> DataFrame:
    """The agreement of all three detectors, the forest with such trees."""
    runs = written(detectors.ml_features(i.volatility), "runs")
    return detectors.triple_agreement(detectors.detect_all(runs, detectors.halving_forest))
