"""Market inputs made from the test tables.

The test tables hold no market data, so bars come from ``lineitem`` (one trade
per line) and ticks from ``events``. The same mapping is written in SQL in
``oracle.py``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom import schemas
from tickloom.functions.numeric import round_half_up
from tickloom.plans import decision, features, gold, silver
from tickloom.session import apply_settings, written
from tickloom.sources import seeds
from tickloom.sources.bars import typical_price

DAY_ZERO = "1995-01-01"
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

SEQUENCE_STEP = 1 << 20
AMPLITUDES = [1, 2, 3, 5, 14]

SESSION_STATUS = {
    "click": "live", "view": "simulated", "signup": "pre-market", "purchase": "post-market",
}


def day_number(date: str) -> Column:
    return F.datediff(F.col(date).cast("date"), F.lit(DAY_ZERO).cast("date"))


@dataclass
class Inputs:
    """The tables of one folder and what is derived from them, built when asked for."""

    spark: SparkSession
    folder: str

    def __post_init__(self) -> None:
        apply_settings(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def symbols(self) -> DataFrame:
        tier = F.get(
            F.array(F.lit("Large"), F.lit("Mid"), F.lit("Small")), F.col("n_nationkey") % 3
        )
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(
            F.col("n_name").alias("symbol"),
            F.concat("n_name", F.lit(" Co")).alias("company_name"),
            F.col("r_name").alias("sector"),
            tier.alias("market_cap_tier"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
            F.col("l_shipdate").cast("date").alias("date"),
        )
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
        suppliers = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(F.col("s_suppkey").alias("l_suppkey"), "n_nationkey", "n_name")
        day = day_number("date")
        amplitude = F.get(F.array(*[F.lit(a) for a in AMPLITUDES]), F.col("n_nationkey") % 5)
        wave = F.abs((day + 37 * F.col("n_nationkey")) % 160 - 80) * 0.25
        noise = (F.col("p_size") - 25) * 0.02 * amplitude
        shock = F.when(day % 211 < 1, F.lit(9.0)).otherwise(F.lit(0.0))
        discount = 10.0 * F.col("l_discount") * amplitude / 5.0
        price = 100.0 + wave + noise - shock - discount
        return lines.join(parts, "l_partkey").join(suppliers, "l_suppkey").select(
            F.col("n_name").alias("symbol"), "date",
            round_half_up(price, 2).alias("price"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            # one whole number that orders the trades, so the bars stay a hash aggregate
            ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * SEQUENCE_STEP
             + F.col("l_partkey") % SEQUENCE_STEP).alias("sequence"),
        )

    @cached_property
    def bars_raw(self) -> DataFrame:
        return self.trades.groupBy("symbol", "date").agg(
            F.min_by("price", "sequence").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "sequence").alias("close"),
            F.sum("volume").alias("volume"),
        )

    @cached_property
    def bars(self) -> DataFrame:
        """Bronze bars: text dates, late corrections and invalid rows among the good ones."""
        day = day_number("date")
        kinds = F.array_compact(F.array(
            F.lit("good"),
            F.when(day % 19 == 3, F.lit("late")),
            F.when(day % 23 == 5, F.lit("no_close")),
            F.when(day % 29 == 7, F.lit("no_volume")),
            F.when(day % 31 == 11, F.lit("bad_low")),
        ))
        kind = F.col("kind")
        spread = self.bars_raw.select("*", F.explode(kinds).alias("kind"))
        corrected = F.col("close") + F.when(kind == "late", F.lit(0.25)).otherwise(F.lit(0.0))
        changed = spread.withColumns({
            "close": F.when(kind != "no_close", corrected),
            "high": F.greatest(F.col("high"), corrected),
            "low": F.when(kind == "bad_low", -F.col("low")).otherwise(F.col("low")),
            "volume": F.when(kind == "no_volume", F.lit(0).cast("bigint")).otherwise(F.col("volume")),
        })
        days_late = F.when(kind == "good", F.lit(1)).when(kind == "late", F.lit(2)).otherwise(F.lit(3))
        return changed.select(
            "symbol", F.date_format("date", "yyyy-MM-dd").alias("date"),
            "open", "high", "low", "close", "volume",
            typical_price(F.col("open"), F.col("high"), F.col("low"), F.col("close")).alias("vwap"),
            F.lit(0).cast("bigint").alias("transactions"),
            F.date_add("date", days_late).cast("timestamp").alias("ingestion_time"),
        )

    @cached_property
    def silver_bars(self) -> DataFrame:
        return silver.silver_ohlcv(self.bars)

    @cached_property
    def stored(self) -> Inputs:
        """The same inputs over a stored silver table, for queries that read the bars repeatedly."""
        copy = Inputs(self.spark, self.folder)
        copy.silver_bars = written(self.silver_bars, "silver")
        return copy

    @cached_property
    def ticks(self) -> DataFrame:
        """Bronze ticks, a tenth of them sent again a minute later with another price."""
        price = F.col("value")
        status = F.lit("halted")
        for event_type, label in SESSION_STATUS.items():
            status = F.when(F.col("event_type") == event_type, F.lit(label)).otherwise(status)
        copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        events = self.table("events").withColumn("moment", F.col("ts").cast("timestamp"))
        return events.select("*", F.explode(copies).alias("copy")).select(
            F.col("user_id").cast("string").alias("symbol"),
            (price + F.col("copy")).alias("price"),
            F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
            round_half_up(price - price * 0.0005, 4).alias("bid"),
            round_half_up(price + price * 0.0005, 4).alias("ask"),
            F.col("moment").alias("event_time"),
            F.to_date("moment").alias("event_date"),
            status.alias("session_status"),
            F.timestamp_add("SECOND", 5 + 60 * F.col("copy"), "moment").alias("ingestion_time"),
        )

    @cached_property
    def tick_messages(self) -> DataFrame:
        """Ticks as JSON bytes; some messages are cut off, some lack a price."""
        events = self.table("events")
        fields = F.struct(
            F.col("user_id").cast("string").alias("symbol"),
            F.when(F.col("event_id") % 89 != 2, F.col("value")).alias("price"),
            F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.col("event_type").alias("session_status"),
        )
        whole = F.to_json(fields)
        cut = F.col("event_id") % 97 == 3
        message = F.when(cut, F.substring(whole, 1, 20)).otherwise(whole)
        return events.select(message.cast("binary").alias("value"))

    @cached_property
    def tick_symbols(self) -> DataFrame:
        """The symbols' dimension; one in seven is unknown to it."""
        user = F.col("user_id")
        return self.table("events").select("user_id").distinct().filter(user % 7 != 3).select(
            user.cast("string").alias("symbol"),
            F.concat(F.lit("Issuer "), user.cast("string")).alias("company_name"),
            F.concat(F.lit("SECTOR_"), (user % 5).cast("string")).alias("sector"),
            F.when(user % 2 == 0, F.lit("Large")).otherwise(F.lit("Small")).alias("market_cap_tier"),
        )

    @cached_property
    def rules(self) -> DataFrame:
        return seeds.knowledge_rules(self.spark)

    @cached_property
    def decision_table(self) -> DataFrame:
        return seeds.decision_table(self.spark)

    # models

    @cached_property
    def volatility(self) -> DataFrame:
        return gold.volatility_index(self.silver_bars, self.symbols)

    @cached_property
    def ratings(self) -> DataFrame:
        return gold.technical_rating(self.silver_bars, self.symbols)

    @cached_property
    def levels(self) -> DataFrame:
        return gold.levels_52w(self.silver_bars, self.symbols)

    @cached_property
    def flags(self) -> DataFrame:
        return gold.anomaly_flags(self.volatility)

    @cached_property
    def returns(self) -> DataFrame:
        return gold.daily_return(self.silver_bars, self.symbols)

    @cached_property
    def sectors(self) -> DataFrame:
        return gold.sector_performance(self.returns)

    @cached_property
    def signals(self) -> DataFrame:
        return features.signals_from_bars(self.silver_bars, self.symbols, self.rules)

    @cached_property
    def stored_signals(self) -> DataFrame:
        """Signals as a stored table, for queries that read them more than once."""
        return written(self.signals, "signals")

    @cached_property
    def stored_outcomes(self) -> DataFrame:
        """The library of all cases whose 5-day price is known."""
        return written(self.outcomes, "outcomes")

    @cached_property
    def last_date(self) -> Column:
        return self.stored_signals.agg(F.max("date")).scalar()

    @cached_property
    def outcomes(self) -> DataFrame:
        signals = self.stored_signals
        none_yet = seeds.empty_table(self.spark, schemas.CASE_OUTCOMES)
        pending = decision.pending_signals(signals, none_yet, self.last_date, oldest=None)
        # some signals come without their close; the price of their day takes its place
        known = day_number("date") % 37 != 5
        pending = pending.withColumn("close_at_signal", F.when(known, F.col("close_at_signal")))
        return decision.case_outcomes(pending, signals.select("symbol", "date", "close"))
