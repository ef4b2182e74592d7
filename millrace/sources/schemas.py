"""Declared schemas of the tables the plans work on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableMapping:
    """A stored table: its name, columns and the key that identifies a row."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    kinds = {
        "int": T.IntegerType(),
        "long": T.LongType(),
        "string": T.StringType(),
        "amount": T.DecimalType(38, 6),
        "timestamp": T.TimestampNTZType(),
    }
    return T.StructType([T.StructField(n, kinds[k]) for n, k in columns])


# Table and column names, and the declared text lengths.
ROOMS = TableMapping("rooms", _struct([("id", "int"), ("name", "string")]), ("id",))
STUDENTS = TableMapping(
    "students",
    _struct([("id", "int"), ("name", "string"), ("birthday", "timestamp"), ("room", "int"), ("sex", "string")]),
    ("id",),
)
ROOM_LENGTHS = {"name": 50}
STUDENT_LENGTHS = {"name": 100, "sex": 1}

REVIEWS = _struct(
    [("reviewId", "string"), ("userName", "string"), ("content", "string"), ("score", "int"),
     ("thumbsUpCount", "int"), ("at", "string")]
)

BOM = _struct(
    [("year", "int"), ("month", "int"), ("produced_material", "long"),
     ("produced_material_production_type", "int"), ("produced_material_release_type", "string"),
     ("produced_material_quantity", "amount"), ("component_material", "long"),
     ("component_material_production_type", "int"), ("component_material_release_type", "string"),
     ("component_material_quantity", "amount"), ("plant_id", "string")]
)

CENSUS = _struct(
    [("age", "int"), ("workclass", "string"), ("fnlwgt", "long"), ("education", "string"),
     ("education-num", "int"), ("marital-status", "string"), ("occupation", "string"),
     ("relationship", "string"), ("race", "string"), ("sex", "string"), ("capital-gain", "long"),
     ("capital-loss", "long"), ("hours-per-week", "int"), ("native-country", "string"), ("salary", "string")]
)
