"""The product-manual extraction schema: 14 fields with their rules, and the catalog DDL.

Field names, JSON types, the lb->kg factor and the catalog's
column types and comments are fixed values of the reference's data contract.
The label synonyms and value patterns are our own rules.
"""

from __future__ import annotations

from pyspark.sql import types as T

from quarry.functions.fieldspec import FieldSpec

# The 14 declared fields.
LB_TO_KG = 0.4536

PRODUCT_SPEC: list[FieldSpec] = [
    FieldSpec("manufacturer", "string", ("Manufacturer", "Brand")),
    FieldSpec("model_number", "string", ("Model", "Model number", "Model no"), value=r"(\S+)"),
    FieldSpec("product_name", "string", ("Product", "Product name")),
    FieldSpec("product_type", "string", ("Type", "Tool type", "Product type")),
    FieldSpec("rated_voltage_v", "number", ("Rated voltage", "Nominal voltage"), value=r"(\S+) ?V"),
    FieldSpec("max_torque_nm", "number",
              ("Max torque soft/hard", "Max torque hard/soft", "Max torque", "Maximum torque", "Tightening torque", "Fastening torque"),
              value=r"([\d./]+) ?Nm", prefer="hard"),
    FieldSpec("no_load_speed_low_rpm", "number", ("No-load speed 1", "Speed setting 1", "Low gear"),
              value=r"([\d.\- ]*[\d.]) ?(?:rpm|min-1|/min)", range="max"),
    FieldSpec("no_load_speed_high_rpm", "number", ("No-load speed 2", "Speed setting 2", "High gear"),
              value=r"([\d.\- ]*[\d.]) ?(?:rpm|min-1|/min)", range="max"),
    FieldSpec("chuck_capacity_mm", "string", ("Chuck capacity", "Chuck size", "Collet capacity", "Clamping range"),
              value=r"(.+?)(?: ?mm)?"),
    FieldSpec("max_drilling_diameter_wood_mm", "number",
              ("Drilling capacity in wood", "Drilling capacity wood", "Max bore diameter wood",
               "Max drilling diameter wood"), value=r"([\d.]+) ?mm"),
    FieldSpec("max_drilling_diameter_steel_mm", "number",
              ("Drilling capacity in steel", "Drilling capacity steel", "Max bore diameter steel",
               "Max drilling diameter steel"), value=r"([\d.]+) ?mm"),
    FieldSpec("weight_kg", "number", ("Weight", "Weight without battery", "Net weight"),
              value=r"([\d.\- ]*[\d.] ?(?:kg|lbs|lb))", range="min", units=(("kg", 1.0), ("lbs", LB_TO_KG), ("lb", LB_TO_KG)),
              round_to=6),
    FieldSpec("compatible_batteries", "string", ("Recommended battery", "Battery", "Compatible batteries",
                                                  "Battery pack"), value=r"(\S+)", pick="list"),
    FieldSpec("compatible_chargers", "string", ("Charger", "Recommended charger", "Compatible chargers"),
              value=r"(\S+)", pick="list"),
]

FIELD_NAMES = [s.name for s in PRODUCT_SPEC]

# The processed catalog's declared schema with column comments.
PROCESSED_COLUMNS: list[tuple[str, str, str]] = [
    ("file_name", "string", "Original PDF file name."),
    ("manufacturer", "string", "Brand or manufacturer name."),
    ("model_number", "string", "Product model number or identifier."),
    ("product_name", "string", "Full product name or description."),
    ("product_type", "string", "Type of tool (drill, drill/driver, hammer drill, etc.)."),
    ("rated_voltage_v", "double", "Rated voltage in volts."),
    ("max_torque_nm", "double", "Maximum torque in Newton-meters."),
    ("no_load_speed_low_rpm", "int", "No-load speed for low gear in RPM."),
    ("no_load_speed_high_rpm", "int", "No-load speed for high gear in RPM."),
    ("chuck_capacity_mm", "string", "Chuck capacity range in mm."),
    ("max_drilling_diameter_wood_mm", "double", "Maximum drilling diameter in wood in mm."),
    ("max_drilling_diameter_steel_mm", "double", "Maximum drilling diameter in steel in mm."),
    ("weight_kg", "double", "Weight of the tool in kg (without battery)."),
    ("compatible_batteries", "string", "Compatible battery packs."),
    ("compatible_chargers", "string", "Compatible chargers."),
]
_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}
PROCESSED_SCHEMA = T.StructType([T.StructField(n, _TYPES[t], True, {"comment": c}) for n, t, c in PROCESSED_COLUMNS])
PROCESSED_COMMENT = ("Processed product catalog from power tool manuals: structured specifications for cross-vendor "
                     "comparison, procurement intelligence, and product recommendation.")
PARSED_COMMENT = "Table containing parsed product manual data from PDF files, including file metadata"
EXTRACT_COMMENT = ("Extracted product specifications (manufacturer, model, voltage, torque, etc.) via AI from parsed "
                   "product manual PDFs")


def spec_subset(names: list[str]) -> list[FieldSpec]:
    by_name = {s.name: s for s in PRODUCT_SPEC}
    return [by_name[n] for n in names]
