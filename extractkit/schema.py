"""The extraction record: field names, their two orders, the severity enum, Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

# Record fields in serialization order.
DAMAGE_FIELDS = (
    "broken_plaster",
    "mould",
    "floor_water_damage",
    "electrical_damage",
    "ceiling_damage",
    "structural_crack",
    "carpet_damage",
    "cabinet_damage",
    "appliance_damage",
    "odor_present",
)

# The same fields in the order a narrative mentions them.
NARRATIVE_FIELDS = (
    "floor_water_damage",
    "carpet_damage",
    "broken_plaster",
    "mould",
    "odor_present",
    "electrical_damage",
    "ceiling_damage",
    "cabinet_damage",
    "appliance_damage",
    "structural_crack",
)

# Severity enum, and the largest flag count of the two lower levels.
SEVERITIES = ("low", "moderate", "high")
LOW_MAX_FLAGS = 2
MODERATE_MAX_FLAGS = 5

SEVERITY_FIELD = "overall_severity"
REQUIRED_KEYS = ("prompt", "completion")
SPLITS = ("train", "valid", "test")

RECORD_TYPE = T.StructType(
    [
        T.StructField("damage", T.StructType([T.StructField(f, T.BooleanType()) for f in DAMAGE_FIELDS])),
        T.StructField(SEVERITY_FIELD, T.StringType()),
    ]
)
