"""Declared schemas. Nothing is inferred from data at run time."""

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_string, _double, _long, _int = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_bool, _date, _timestamp = T.BooleanType(), T.DateType(), T.TimestampType()

TICK_MESSAGE = _schema(
    symbol=_string, price=_double, volume=_long, bid=_double, ask=_double,
    timestamp=_string, session_status=_string,
)

BRONZE_TICKS = _schema(
    symbol=_string, price=_double, volume=_long, bid=_double, ask=_double,
    event_time=_timestamp, event_date=_date, session_status=_string, ingestion_time=_timestamp,
)

BRONZE_BARS = _schema(
    symbol=_string, date=_string, open=_double, high=_double, low=_double, close=_double,
    volume=_long, vwap=_double, transactions=_long, ingestion_time=_timestamp,
)

SYMBOLS = _schema(symbol=_string, company_name=_string, sector=_string, market_cap_tier=_string)

KNOWLEDGE_RULES = _schema(
    rule_id=_string, rule_name=_string, category=_string, indicator_column=_string,
    vote_direction=_string, condition_description=_string, certainty_factor=_double,
    is_active=_bool, source_reference=_string,
)

DECISION_TABLE = _schema(
    state_id=_string, rating_category=_string, has_price_anomaly=_string,
    sector_advance_gte_50pct=_string, signal_score_negative=_string,
    any_metarule_blocks_buy=_string, expected_signal=_string, confidence_direction=_string,
    notes=_string,
)

ANOMALY_FLAGS = _schema(
    symbol=_string, date=_date, anomaly_type=_string, score=_double, threshold=_double,
    is_anomaly=_bool, detected_at=_timestamp,
)

CASE_OUTCOMES = _schema(
    symbol=_string, signal_date=_date, signal=_string, combined_cf=_double, signal_score=_int,
    sector=_string, close_at_signal=_double, close_5d=_double, close_20d=_double,
    return_5d=_double, return_20d=_double, outcome=_string, known_5d=_date, known_20d=_date,
)
