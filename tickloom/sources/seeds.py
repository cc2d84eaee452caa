"""Small reference tables kept with the code."""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from tickloom import schemas

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

# The tracked instruments.
TRACKED_SYMBOLS = [
    ("2222", "Saudi Aramco", "Energy", "Large"),
    ("1010", "Al Rajhi Bank", "Banking", "Large"),
    ("2010", "SABIC", "Petrochemicals", "Large"),
    ("7010", "STC", "Telecom", "Large"),
    ("1120", "Al Jazira Bank", "Banking", "Mid"),
    ("4280", "Jarir Bookstore", "Retail", "Mid"),
    ("2380", "Petro Rabigh", "Petrochemicals", "Mid"),
    ("8010", "SABB", "Banking", "Large"),
    ("4003", "Bahri", "Transportation", "Mid"),
    ("2060", "Saudi Kayan", "Petrochemicals", "Mid"),
]

# The codes ingested unless the caller names others.
SYMBOL_UNIVERSE = """
2222 5110 5170 1211 2010 2030 2060 2080 2090 2160 2170 2180 2200 2210 2220 2240 2250 2290 2300
2310 2320 2330 2350 2380 1010 1020 1030 1050 1060 1080 1120 1140 1150 1180 4010 4020 4230 4240
3010 3020 3030 3040 3050 3060 3080 3090 4050 4160 4200 4210 4280 4001 4007 4002 4005 4013 4100
4130 6010 6020 6040 6050 6070 7010 7020 7030 7040 8010 8020 8050 8060 8070 8100 8150 8160 8180
8200 8230 8240 8260 8300 4003 4030 4031 4040 4150 4006 4190 4250 4300 4310 4320
""".split()


def _typed(value: str, kind: T.DataType) -> object:
    if value == "":
        return None
    if isinstance(kind, T.BooleanType):
        return value.lower() == "true"
    if isinstance(kind, T.DoubleType):
        return float(value)
    return value


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a relation of known size, so joins may broadcast it by that size."""
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(schema.fields)}
    return spark.createDataFrame(pa.table(columns), schema)


def load_seed(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A seed shipped with the package, typed by its declared schema.

    It is read where the session runs and travels with the plan, so executors
    need no access to the package folder.
    """
    with open(SEED_DIR / f"{name}.csv", encoding="utf-8", newline="") as handle:
        rows = [
            tuple(_typed(row[field.name], field.dataType) for field in schema.fields)
            for row in csv.DictReader(handle)
        ]
    return local_table(spark, rows, schema)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A caller's own CSV with a header, under a declared schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def knowledge_rules(spark: SparkSession) -> DataFrame:
    return load_seed(spark, "knowledge_rules", schemas.KNOWLEDGE_RULES)


def decision_table(spark: SparkSession) -> DataFrame:
    return load_seed(spark, "decision_table", schemas.DECISION_TABLE)


def tracked_symbols(spark: SparkSession) -> DataFrame:
    return local_table(spark, TRACKED_SYMBOLS, schemas.SYMBOLS)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
