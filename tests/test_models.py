import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, bars, plan_of, same_rows, symbols
from tickloom import schemas
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.upsert import newer_than, recompute_touched, replace_window, upsert
from tickloom.plans import decision, features, gold, readside, silver
from tickloom.sources import bars as bar_source, seeds


def rows(df, *order):
    return df.orderBy(*order).collect()


# --- silver ------------------------------------------------------------------------------


def test_silver_keeps_the_last_valid_bar(spark):
    stamp = dt.datetime(2024, 1, 2)
    raw = spark.createDataFrame([
        ("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 5, 1.0, 0, stamp),
        ("A", "2024-01-01", 1.0, 1.0, 1.0, 2.0, 5, 1.0, 0, stamp + dt.timedelta(hours=1)),
        ("A", "2024-01-01", 1.0, 1.0, 1.0, None, 5, 1.0, 0, stamp + dt.timedelta(hours=2)),
        ("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 0, 1.0, 0, stamp),
        ("A", "not a date", 1.0, 1.0, 1.0, 1.0, 5, 1.0, 0, stamp),
        (None, "2024-01-03", 1.0, 1.0, 1.0, 1.0, 5, 1.0, 0, stamp),
    ], schemas.BRONZE_BARS)
    kept = silver.silver_ohlcv(raw).collect()
    assert [(r.symbol, r.date, r.close) for r in kept] == [("A", DAY, 2.0)]


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    kept = latest_per_key(df, ["k"], "id")
    assert sorted(r.id for r in kept.collect()) == [997, 998, 999]
    assert plan_of(kept).count("WindowGroupLimit") >= 2


def test_dedup_does_not_depend_on_row_order(spark, inputs):
    keys = ["symbol", "date"]
    shuffled = inputs.bars.orderBy(F.rand(3))
    assert same_rows(silver.silver_ohlcv(shuffled), silver.silver_ohlcv(inputs.bars))
    tied = spark.createDataFrame([("A", 1, 5.0), ("A", 1, 7.0)], "symbol string, date int, x double")
    tied = tied.withColumn("t", F.lit(0))
    assert latest_per_key(tied, keys, "t").first().x == 7.0
    assert latest_per_key(tied.orderBy(F.desc("x")), keys, "t").first().x == 7.0


# --- gold --------------------------------------------------------------------------------


def test_single_bar(spark):
    b, s = bars(spark, [10]), symbols(spark, "A")
    v = gold.volatility_index(b, s).first()
    assert v.log_return is None and v.vol_20d is None and v.annualized_vol is None
    assert gold.daily_return(b, s).isEmpty()
    assert gold.anomaly_flags(gold.volatility_index(b, s)).isEmpty()
    rating = gold.technical_rating(b, s).first()
    assert (rating.rsi14, rating.sig_rsi, rating.signal_score) == (100.0, -1, -1)


def test_constant_price(spark):
    b, s = bars(spark, [10.1] * 120), symbols(spark, "A")
    last = rows(gold.technical_rating(b, s), "date")[-1]
    assert (last.rsi14, last.sig_rsi, last.signal_score, last.neutral_signals) == (100.0, -1, -1, 7)
    level = rows(gold.levels_52w(b, s), "date")[-1]
    assert level.at_52w_high and level.at_52w_low
    flags = gold.anomaly_flags(gold.volatility_index(b, s))
    price = flags.filter("anomaly_type = 'price_iqr'")
    assert price.filter("score IS NOT NULL OR is_anomaly").isEmpty() and not price.isEmpty()
    volume = flags.filter("anomaly_type = 'volume_zscore'")
    assert volume.filter("score <> 0 OR is_anomaly").isEmpty() and not volume.isEmpty()


def test_spikes_are_flagged(spark):
    closes = [100 + (k % 5) * 0.3 for k in range(100)]
    volumes = [100 + k % 7 for k in range(100)]
    closes[90], volumes[95] = 140, 5000
    v = gold.volatility_index(bars(spark, closes, volumes=volumes), symbols(spark, "A"))
    fired = {(r.anomaly_type, r.date) for r in gold.anomaly_flags(v).filter("is_anomaly").collect()}
    assert ("price_iqr", DAY + dt.timedelta(days=90)) in fired
    assert ("volume_zscore", DAY + dt.timedelta(days=95)) in fired


def test_unknown_symbols_are_dropped(spark):
    both = bars(spark, [1, 2, 3]).unionByName(bars(spark, [1, 2, 3], symbol="B"))
    assert gold.volatility_index(both, symbols(spark, "A")).select("symbol").distinct().count() == 1


def test_vwap_of_a_session(spark):
    at = dt.datetime(2024, 1, 1, 10)
    ticks = spark.createDataFrame(
        [("A", 10.0, 1, at), ("A", 20.0, 3, at + dt.timedelta(hours=1)), ("A", 5.0, 1, at + dt.timedelta(hours=2))],
        "symbol string, price double, volume bigint, event_time timestamp",
    ).withColumn("event_date", F.to_date("event_time"))
    r = gold.intraday_vwap(ticks, symbols(spark, "A")).first()
    assert (r.vwap, r.session_open, r.session_high, r.session_low, r.session_close) == (15.0, 10, 20, 5, 5)
    assert (r.total_volume, r.tick_count) == (5, 3)


@pytest.mark.parametrize("model", [
    gold.volatility_index, gold.levels_52w, gold.technical_rating, gold.daily_return,
])
def test_series_in_blocks_give_the_same(inputs, silver_bars, model):
    plain = model(silver_bars, inputs.symbols)
    assert same_rows(model(silver_bars, inputs.symbols, block_rows=260), plain)


def test_flags_in_blocks_give_the_same(inputs, silver_bars):
    volatility = gold.volatility_index(silver_bars, inputs.symbols)
    assert same_rows(gold.anomaly_flags(volatility, block_rows=100), gold.anomaly_flags(volatility))


def test_model_invariants(inputs):
    s = inputs.stored_signals
    assert s.filter("abs(combined_cf) > 1").isEmpty()
    assert s.filter("buy_signals + sell_signals + neutral_signals <> 8").isEmpty()
    assert s.filter("(why_not_buy IS NULL) <> (signal = 'BUY')").isEmpty()
    assert s.filter("(why_not_sell IS NULL) <> (signal = 'SELL')").isEmpty()
    levels = inputs.levels
    assert levels.filter("low_52w > low OR high > high_52w OR low > high").isEmpty()
    assert s.select("symbol", "date").distinct().count() == s.count()


# --- decision ----------------------------------------------------------------------------


def test_one_pass_equals_the_separate_tables(inputs, silver_bars):
    s = inputs.symbols
    ratings = gold.technical_rating(silver_bars, s)
    volatility = gold.volatility_index(silver_bars, s)
    flags = gold.anomaly_flags(volatility)
    stored = decision.decision_signals(
        ratings, gold.levels_52w(silver_bars, s), volatility, flags,
        gold.sector_performance(gold.daily_return(silver_bars, s)),
        decision.cf_engine(ratings, inputs.rules), decision.metarule_flags(flags, volatility),
    )
    assert same_rows(stored, inputs.stored_signals)


def inputs_row(spark, **changes):
    row = {
        "symbol": "A", "company_name": "A Co", "sector": "Energy", "market_cap_tier": "Large",
        "date": DAY, "close": 10.0, "sma50": 9.0, "sma200": 8.0, "rsi14": 55.0, "bb_lower": 7.0,
        "bb_upper": 12.0, "signal_score": 4, "buy_signals": 5, "sell_signals": 1,
        "neutral_signals": 2, "rating": "Buy", "high_52w": 11.0, "low_52w": 5.0,
        "pct_from_high": -0.09, "pct_from_low": 1.0, "at_52w_high": False, "at_52w_low": False,
        "annualized_vol": 0.2, "has_price_anomaly": False, "has_volume_anomaly": False,
        "sector_avg_return": 0.01, "sector_advance_ratio": 0.62, "combined_cf": 0.72,
        "cf_confidence": "HIGH", "cf_buy_strength": 0.72, "cf_sell_strength": 0.0,
        "active_metarules": "", "required_score_for_buy": 3, "m01_tighten_buy": False,
        "m02_consecutive_down": False, "g03_extreme_volatility": False, **changes,
    }
    fields = {"sector_advance_ratio": "double", "annualized_vol": "double"}
    columns = [F.lit(v).cast(fields[k]).alias(k) if k in fields else F.lit(v).alias(k) for k, v in row.items()]
    return spark.range(1).select(*columns)


def explained(spark, **changes):
    return decision.explain_signals(inputs_row(spark, **changes)).first()


def test_buy_texts(spark):
    r = explained(spark)
    assert r.signal == "BUY" and r.confidence == "HIGH" and r.why_not_buy is None
    assert r.why_signal == "BUY: Buy rating (CF=0.72, score=+4/8) + no price anomaly + sector advance=62%"
    assert r.why_not_sell == "SELL not triggered: rating is 'Buy' and no price anomaly"
    assert r.reasoning_trace == (
        "1. CF engine: combined_cf=0.72 → BUY direction. 2. Anomaly gate (G01): "
        "has_price_anomaly=false. 3. Sector gate (G02): advance_ratio=62% [passed]. "
        "4. Metarules: none. 5. Final: BUY (Buy)"
    )
    assert r.explanation == "Rating: Buy (score=4/8, buy=5, sell=1); RSI(14)=55.0; sector advance=62%"


@pytest.mark.parametrize("changes, reason", [
    ({"rating": "Neutral", "signal_score": 1},
     "BUY not triggered: rating is 'Neutral' (score=1/8, requires Buy or Strong Buy)"),
    ({"has_price_anomaly": True}, "BUY blocked by gate G01: price-IQR anomaly detected"),
    ({"sector_advance_ratio": 0.43}, "BUY blocked by gate G02: sector advance 43% < 50% threshold"),
    ({"required_score_for_buy": 6, "m01_tighten_buy": True},
     "BUY blocked by metarule M01: market-wide anomaly rate >30% requires score≥6, current score=4"),
    ({"g03_extreme_volatility": True, "annualized_vol": 0.832},
     "BUY blocked by gate G03: extreme volatility (83.2% ann.)"),
    ({"m02_consecutive_down": True},
     "BUY blocked by metarule M02: 3 consecutive down days (sustained selling pressure)"),
])
def test_each_gate_blocks_a_buy(spark, changes, reason):
    r = explained(spark, **changes)
    assert (r.signal, r.why_not_buy) == ("HOLD", reason)


def test_sell_paths(spark):
    r = explained(spark, rating="Strong Sell", signal_score=-6)
    assert (r.signal, r.why_signal) == ("SELL", "SELL: Strong Sell rating (score=-6/8)")
    r = explained(spark, rating="Neutral", signal_score=-2, has_price_anomaly=True)
    assert r.why_signal == "SELL: price-IQR anomaly with negative signal score (-2)"
    r = explained(spark, rating="Neutral", signal_score=1, has_price_anomaly=True)
    assert r.why_not_sell == (
        "SELL not triggered: price anomaly present but signal_score=1 is non-negative "
        "(anomaly SELL requires score < 0)"
    )


def test_unknown_sector_breadth_passes_the_gate(spark):
    r = explained(spark, sector_advance_ratio=None)
    assert r.signal == "BUY" and "sector advance" not in r.explanation
    assert "advance_ratio=0% [passed]" in r.reasoning_trace


def test_every_decision_table_row(spark, inputs):
    """Each row's conditions lead to the signal the row expects."""
    scores = {"strong_buy": 6, "buy": 4, "neutral": 1, "sell": -3, "strong_sell": -6}
    ratings = {"strong_buy": "Strong Buy", "buy": "Buy", "neutral": "Neutral", "sell": "Sell",
               "strong_sell": "Strong Sell"}
    wanted, cases = {}, None
    for row in inputs.decision_table.collect():
        score = scores[row.rating_category]
        if row.rating_category == "neutral" and row.signal_score_negative == "true":
            score = -2
        blocked = row.any_metarule_blocks_buy == "true"
        case = inputs_row(
            spark, symbol=row.state_id, rating=ratings[row.rating_category], signal_score=score,
            has_price_anomaly=row.has_price_anomaly == "true",
            sector_advance_ratio=0.4 if row.sector_advance_gte_50pct == "false" else 0.6,
            m02_consecutive_down=blocked,
        )
        cases = case if cases is None else cases.unionByName(case)
        wanted[row.state_id] = row.expected_signal
    got = {r.symbol: r.signal for r in decision.explain_signals(cases).collect()}
    assert got == wanted


def test_switched_off_rule_counts_nothing(spark, inputs):
    votes = spark.range(1).select(
        F.lit("A").alias("symbol"), F.lit(DAY).alias("date"),
        *[F.lit(1 if v == "sig_rsi" else 0).alias(v) for v in gold.VOTES],
    )
    off = inputs.rules.withColumn("is_active", F.col("rule_id") != "R06")
    assert decision.cf_engine(votes, inputs.rules).first().combined_cf == 0.7
    assert decision.cf_engine(votes, off).first().combined_cf == 0.0
    assert decision.cf_engine(votes, off, inactive="default").first().combined_cf == 0.7
    missing = inputs.rules.filter("rule_id <> 'R06'")
    assert decision.cf_engine(votes, missing).first().combined_cf == 0.7


def pending(spark, *signals):
    return spark.createDataFrame(
        [("A", DAY, s, 0.5, 3, "Energy", 100.0) for s in signals],
        "symbol string, date date, signal string, combined_cf double, signal_score int, "
        "sector string, close_at_signal double",
    )


def test_forward_close_takes_the_first_day_in_range(spark):
    prices = bars(spark, range(100, 140), skip=(5, 6, 20, 21, 22, 23, 24))
    r = decision.forward_close(pending(spark, "BUY"), prices).first()
    assert (r.close_5d, r.close_20d) == (107.0, None)


def test_outcomes(spark):
    prices = bars(spark, [100, 100, 100, 100, 100, 101])
    got = {r.signal: r for r in decision.case_outcomes(pending(spark, "BUY", "SELL", "HOLD"), prices).collect()}
    assert {k: v.outcome for k, v in got.items()} == {"BUY": "WIN", "SELL": "LOSS", "HOLD": "WIN"}
    assert got["BUY"].return_5d == 0.01 and got["BUY"].return_20d is None


def test_signal_before_a_long_gap_has_no_outcome(spark):
    prices = bars(spark, range(100, 140), skip=range(1, 12))
    assert decision.case_outcomes(pending(spark, "BUY"), prices).isEmpty()


def test_pending_window_and_recorded(spark):
    days = [DAY + dt.timedelta(days=k) for k in range(60)]
    signals = spark.createDataFrame(
        [("A", d, "BUY", 0.5, 3, "Energy", 100.0) for d in days],
        "symbol string, date date, signal string, combined_cf double, signal_score int, "
        "sector string, close double",
    )
    # an outcome without its 20-day price is open still
    recorded = spark.createDataFrame(
        [("A", str(days[40]), 1.0), ("A", str(days[41]), None)],
        "symbol string, signal_date string, close_20d double")
    today = F.lit(days[50])
    due = sorted(r.date for r in decision.pending_signals(signals, recorded, today).collect())
    assert due == [d for d in days[20:46] if d != days[40]]


def test_outcome_starts_from_the_price_of_the_day(spark):
    prices = bars(spark, [50, 50, 50, 50, 50, 55])
    signals = pending(spark, "BUY").withColumn("close_at_signal", F.lit(None).cast("double"))
    r = decision.case_outcomes(signals, prices).first()
    assert (r.close_at_signal, r.return_5d, r.outcome) == (50, 0.1, "WIN")
    assert (r.known_5d, r.known_20d) == (DAY + dt.timedelta(days=5), None)
    assert decision.case_outcomes(signals, bars(spark, [1] * 9, skip=(0,))).isEmpty()


def test_prices_in_play(spark):
    prices = bars(spark, range(100, 140)).unionByName(bars(spark, range(100, 140), symbol="B"))
    asked = pending(spark, "BUY").withColumn("date", F.lit(DAY + dt.timedelta(days=3)))
    near = decision.prices_in_play(asked, prices)
    assert {r.symbol for r in near.collect()} == {"A"}
    assert {r.date for r in near.collect()} == {DAY + dt.timedelta(days=k) for k in range(3, 28)}
    plain, few = (decision.case_outcomes(asked, p).collect() for p in (prices, near))
    assert plain == few and len(few) == 1
    assert decision.prices_in_play(asked.limit(0), prices).isEmpty()


def test_lookup_does_not_show_a_return_before_its_price(spark):
    """A case judged on day 5; its 20-day return is known on day 20, not before."""
    days = [DAY + dt.timedelta(days=k) for k in range(30)]
    signals = spark.createDataFrame(
        [("A", d, "BUY", 4, 0.2, 50.0, -0.1, 0.6) for d in days],
        "symbol string, date date, signal string, signal_score int, annualized_vol double, rsi14 double, "
        "pct_from_high double, sector_advance_ratio double")
    library = spark.createDataFrame(
        [("A", DAY, "BUY", 4, "WIN", 0.1, 0.5, days[5], days[20])],
        "symbol string, signal_date date, signal string, signal_score int, outcome string, return_5d double, "
        "return_20d double, known_5d date, known_20d date")
    got = {r.date: r for r in decision.cbr_lookup(signals, library).collect()}
    assert [d for d in days if got[d].similar_cases_count] == days[5:]
    assert [d for d in days if got[d].cbr_avg_return_20d] == days[20:]
    assert got[days[10]].cbr_avg_return_5d == 0.1 and got[days[10]].cbr_avg_return_20d == 0


@pytest.mark.parametrize("unknown", [{"signal_score": None}, {"rating": None}])
def test_a_gate_that_cannot_be_judged_stops_a_buy(spark, unknown):
    name = next(iter(unknown))
    kind = "int" if name == "signal_score" else "string"
    clean = inputs_row(spark)
    assert decision.explain_signals(clean).first().signal == "BUY"
    r = decision.explain_signals(clean.withColumn(name, F.lit(None).cast(kind))).first()
    assert r.signal == "HOLD" and r.why_not_buy == "BUY not triggered"


def test_sells_near_the_high_are_found(spark):
    rows = inputs_row(spark, rating="Strong Sell", signal_score=-6, at_52w_high=True).unionByName(
        inputs_row(spark, symbol="B", rating="Strong Sell", signal_score=-6))
    found = readside.sells_near_high(decision.explain_signals(rows)).collect()
    assert [r.symbol for r in found] == [rows.first().symbol]


# --- incremental -------------------------------------------------------------------------


@pytest.mark.parametrize("cut", ["1995-06-30", "1998-02-15", "2001-01-31"])
@pytest.mark.parametrize("model, lookback", [
    (gold.volatility_index, 20), (gold.technical_rating, 200), (gold.levels_52w, 251),
])
def test_incremental_equals_full(inputs, silver_bars, model, lookback, cut):
    build = lambda b: model(b, inputs.symbols)
    stored = build(silver_bars.filter(F.col("date") <= cut))
    touched = newer_than(silver_bars, "date", stored)
    fresh = recompute_touched(build, silver_bars, touched, lookback=lookback)
    assert same_rows(upsert(stored, fresh, ["symbol", "date"]), build(silver_bars))


def test_late_bar_is_taken_in(inputs, silver_bars):
    """A bar far below the high-water mark changes all later rows of its symbol."""
    build = lambda b: gold.technical_rating(b, inputs.symbols)
    first = silver_bars.agg(F.min("symbol")).first()[0]
    day = silver_bars.filter(F.col("symbol") == first).select(F.sort_array(F.collect_list("date"))[250]).first()[0]
    is_late = (F.col("symbol") == first) & (F.col("date") == day)
    stored = build(silver_bars.filter(~is_late))
    fresh = recompute_touched(build, silver_bars, silver_bars.filter(is_late), lookback=200)
    assert same_rows(upsert(stored, fresh, ["symbol", "date"]), build(silver_bars))


def test_replace_window_bounds(spark):
    old, new = bars(spark, [1] * 10), bars(spark, [2] * 10)
    got = [r.close for r in rows(replace_window(old, new, "date", "2024-01-03", 3), "date")]
    assert got == [1, 1, 2, 2, 2, 1, 1, 1, 1, 1]


def test_wide_bars(spark):
    wide = spark.sql("""
        SELECT DATE '2024-01-01' AS Date, 1.0D AS `A.X_Open`, 2.0D AS `A.X_High`, 1.0D AS `A.X_Low`,
               2.0D AS `A.X_Close`, CAST(NULL AS DOUBLE) AS `A.X_Volume`,
               double('NaN') AS `B.X_Open`, 1.0D AS `B.X_High`, 1.0D AS `B.X_Low`, 1.0D AS `B.X_Close`,
               5.0D AS `B.X_Volume`""")
    got = bar_source.bars_from_wide(wide, ["A", "B", "C"], suffix=".X").collect()
    assert [(r.symbol, r.date, r.volume, r.vwap) for r in got] == [("A", "2024-01-01", 0, 1.5)]


def test_seeds(spark):
    assert seeds.tracked_symbols(spark).count() == 10
    assert len(seeds.SYMBOL_UNIVERSE) == len(set(seeds.SYMBOL_UNIVERSE)) == 92
    assert bar_source.in_universe(bars(spark, [1]).withColumn("symbol", F.lit("2222"))).count() == 1
    assert bar_source.in_universe(bars(spark, [1])).count() == 0
    assert bar_source.in_universe(bars(spark, [1]), ["A"]).count() == 1
    rules = seeds.knowledge_rules(spark)
    assert rules.count() == 13 and rules.schema["is_active"].dataType.simpleString() == "boolean"
    assert seeds.decision_table(spark).count() == 20
    assert seeds.empty_table(spark, schemas.CASE_OUTCOMES).count() == 0


def test_plans_have_no_nested_loops(inputs, silver_bars):
    from tickloom.plans import detectors

    plans = [
        gold.technical_rating(silver_bars, inputs.symbols),
        decision.cbr_lookup(inputs.stored_signals, inputs.stored_outcomes),
        decision.cbr_lookup(inputs.stored_signals, inputs.stored_outcomes, known_only=False),
        decision.forward_close(silver_bars.select("symbol", "date", "close"), silver_bars),
        decision.validation(inputs.stored_outcomes, inputs.stored_signals),
        detectors.batch_price_iqr(detectors.ml_features(inputs.volatility)),
    ]
    for df in plans:
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_shuffle_for_all_features(inputs, silver_bars):
    """Silver is stored, the dimension small: the wide rows need one exchange by symbol."""
    plan = plan_of(features.daily_features(silver_bars, inputs.symbols))
    assert plan.count("Exchange hashpartitioning") == 1


def test_scan_reads_the_columns_it_needs(inputs):
    plan = plan_of(inputs.trades)
    assert "l_extendedprice" not in plan and "l_returnflag" not in plan
