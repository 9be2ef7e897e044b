"""Declarative specification that drives every operator.

A ``SurveySpec`` says which raw columns exist, what they are called after
cleaning, what kind they are and which values are valid.  A ``StarLayout``
says how the clean table splits into dimensions and a fact.  Operators read
only these objects, so they run on any coded table (see the ``labels`` spec at
the bottom, and the ``lineitem`` dimension in ``plans/catalog.py``), not just
the health survey.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the survey ETL being reproduced, so they are
# written out plainly, in their natural order.
# ---------------------------------------------------------------------------

# Raw columns kept by feature selection, target first, in selection order.
SELECTED_COLUMNS = [
    "DIABETE3", "_RFHYPE5", "_BMI5", "SMOKE100", "_TOTINDA", "GENHLTH", "SEX",
    "_AGEG5YR", "TOLDHI2", "_CHOLCHK", "CVDSTRK3", "_MICHD", "_FRTLT1",
    "_VEGLT1", "_RFDRHV5", "HLTHPLN1", "MEDCOST", "MENTHLTH", "PHYSHLTH",
    "DIFFWALK", "EDUCA", "INCOME2",
]
TARGET_COLUMN = "DIABETE3"
YEAR_COLUMN = "DATA_YEAR"

# Raw name -> clean name.
RENAME = {
    "DIABETE3": "diabetes_status", "_RFHYPE5": "HighBP", "TOLDHI2": "HighChol",
    "_CHOLCHK": "CholCheck", "_BMI5": "BMI", "SMOKE100": "Smoker",
    "CVDSTRK3": "Stroke", "_MICHD": "HeartDiseaseorAttack",
    "_TOTINDA": "PhysActivity", "_FRTLT1": "Fruits", "_VEGLT1": "Veggies",
    "_RFDRHV5": "HvyAlcoholConsump", "HLTHPLN1": "AnyHealthcare",
    "MEDCOST": "NoDocbcCost", "GENHLTH": "GenHlth", "MENTHLTH": "MentHlth",
    "PHYSHLTH": "PhysHlth", "DIFFWALK": "DiffWalk", "SEX": "Sex",
    "_AGEG5YR": "Age", "EDUCA": "Education", "INCOME2": "Income",
}

# Target code -> label.
TARGET_LABELS = {1: "Diabetic", 2: "Prediabetic", 3: "Healthy"}

# Yes/No columns, in the order the binary step visits them.
BINARY_COLUMNS = [
    "_RFHYPE5", "TOLDHI2", "_CHOLCHK", "SMOKE100", "CVDSTRK3", "_MICHD",
    "_TOTINDA", "_FRTLT1", "_VEGLT1", "_RFDRHV5", "HLTHPLN1", "MEDCOST",
    "DIFFWALK",
]
YES, NO = "Yes", "No"

# Ordinal columns and their valid codes, in the order they are filtered.
ORDINAL_DOMAINS = {
    "GENHLTH": list(range(1, 6)),
    "SEX": [1, 2],
    "_AGEG5YR": list(range(1, 14)),
    "EDUCA": list(range(1, 7)),
    "INCOME2": list(range(1, 9)),
    "MENTHLTH": list(range(0, 31)),
    "PHYSHLTH": list(range(0, 31)),
}

SEX_LABELS = {1: "Male", 2: "Female"}
BMI_SCALE = 100.0

# Final validation: clean column -> allowed values, in the order checked.
VALIDATION_DOMAINS = {
    "diabetes_status": ["Diabetic", "Healthy", "Prediabetic"],
    "HighBP": ["No", "Yes"], "HighChol": ["No", "Yes"],
    "CholCheck": ["No", "Yes"], "Smoker": ["No", "Yes"],
    "Stroke": ["No", "Yes"], "HeartDiseaseorAttack": ["No", "Yes"],
    "PhysActivity": ["No", "Yes"], "Fruits": ["No", "Yes"],
    "Veggies": ["No", "Yes"], "HvyAlcoholConsump": ["No", "Yes"],
    "AnyHealthcare": ["No", "Yes"], "NoDocbcCost": ["No", "Yes"],
    "DiffWalk": ["No", "Yes"],
    "GenHlth": list(range(1, 6)),
    "MentHlth": list(range(0, 31)),
    "PhysHlth": list(range(0, 31)),
    "Sex": ["Male", "Female"],
    "Age": list(range(1, 14)),
    "Education": list(range(1, 7)),
    "Income": list(range(1, 9)),
}

# Integer encoding used by the SQL schema and the analysis view.
STATUS_CODES = {"Healthy": 0, "Prediabetic": 1, "Diabetic": 2}
FLAG_CODES = {"No": 0, "Yes": 1}

# Analysis view labels: status code -> label (no ELSE), and for each flag the
# (label when 0, label otherwise) pair, keyed by the view's output column.
VIEW_STATUS_LABELS = {0: "No Diabetes", 1: "Prediabetes", 2: "Diabetes"}
VIEW_FLAG_LABELS = {
    # output column: (dimension, source column, label for 0, label otherwise)
    "smoker_status": ("lifestyle", "smoker_status", "No Fumador", "Fumador"),
    "physical_activity": ("lifestyle", "physical_activity", "No Activo", "Activo"),
    "fruits_consumption": ("lifestyle", "fruits_consumption", "No Consume", "Consume Frutas"),
    "vegetables_consumption": ("lifestyle", "vegetables_consumption", "No Consume", "Consume Verduras"),
    "alcohol_consumption": ("lifestyle", "heavy_alcohol_consumption", "No Excesivo", "Consumo Excesivo"),
    "blood_pressure": ("medical", "high_blood_pressure", "Normal", "Presión Alta"),
    "cholesterol": ("medical", "high_cholesterol", "Normal", "Colesterol Alto"),
    "stroke_history": ("medical", "stroke_history", "Sin Historia", "Con Historia"),
    "heart_disease": ("medical", "heart_disease_or_attack", "Sin Enfermedad", "Con Enfermedad"),
    "healthcare_coverage": ("healthcare", "any_healthcare_coverage", "Sin Cobertura", "Con Cobertura"),
    "no_doctor_cost": ("healthcare", "no_doctor_due_to_cost", "No", "Sí por Costo"),
}

# Stored-table column types (the loader's DDL).  Strings carry a max length.
LOAD_TYPES = {
    "dim_demographics": {"demographic_id": "int", "sex": "varchar(10)",
                         "age_group": "decimal(3,1)", "education_level": "decimal(3,1)",
                         "income_bracket": "decimal(3,1)"},
    "dim_lifestyle": {"lifestyle_id": "int", "smoker_status": "varchar(10)",
                      "physical_activity": "varchar(10)", "fruits_consumption": "varchar(10)",
                      "vegetables_consumption": "varchar(10)",
                      "heavy_alcohol_consumption": "varchar(10)"},
    "dim_medical_conditions": {"medical_conditions_id": "int",
                               "high_blood_pressure": "varchar(10)",
                               "high_cholesterol": "varchar(10)",
                               "cholesterol_check": "varchar(10)",
                               "stroke_history": "varchar(10)",
                               "heart_disease_or_attack": "varchar(10)",
                               "difficulty_walking": "varchar(10)"},
    "dim_healthcare_access": {"healthcare_access_id": "int",
                              "any_healthcare_coverage": "varchar(10)",
                              "no_doctor_due_to_cost": "varchar(10)"},
    "fact_health_records": {"record_id": "bigint", "diabetes_status": "varchar(20)",
                            "bmi_value": "decimal(5,2)", "mental_health_days": "decimal(3,1)",
                            "physical_health_days": "decimal(3,1)",
                            "general_health_score": "decimal(3,1)",
                            "demographic_id": "int", "lifestyle_id": "int",
                            "medical_conditions_id": "int", "healthcare_access_id": "int"},
}

# Range checks of the SQL schema (encoded form); a null passes a check.
# column -> (lower, lower inclusive, upper, upper inclusive)
RANGE_CHECKS = {
    "bmi_value": (0, False, 100, True),
    "mental_health_days": (0, True, 30, True),
    "physical_health_days": (0, True, 30, True),
    "general_health_score": (1, True, 5, True),
}
STATUS_CHECK_VALUES = [0, 1, 2]

# ---------------------------------------------------------------------------
# Spec objects
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SurveySpec:
    """What the cleaning operators need to know about a coded table."""

    selected: tuple[str, ...]
    target: str | None
    target_labels: dict
    binaries: tuple[str, ...]
    # declared encoding per binary column: "12" (1=Yes, 2=No) or "01" (0=No, 1=Yes)
    binary_encoding: dict
    ordinals: dict
    sex_column: str | None
    sex_labels: dict
    bmi_column: str | None
    rename: dict
    validation: dict
    year_column: str = YEAR_COLUMN

    def clean_name(self, raw: str) -> str:
        return self.rename.get(raw, raw)


SURVEY = SurveySpec(
    selected=tuple(SELECTED_COLUMNS),
    target=TARGET_COLUMN,
    target_labels=TARGET_LABELS,
    binaries=tuple(BINARY_COLUMNS),
    binary_encoding={c: "12" for c in BINARY_COLUMNS},
    ordinals=ORDINAL_DOMAINS,
    sex_column="SEX",
    sex_labels=SEX_LABELS,
    bmi_column="_BMI5",
    rename=RENAME,
    validation=VALIDATION_DOMAINS,
)


@dataclass(frozen=True)
class DimSpec:
    """One dimension: table name, surrogate key, (clean column, output column)."""

    table: str
    key: str
    columns: tuple[tuple[str, str], ...]

    @property
    def sources(self) -> list[str]:
        return [s for s, _ in self.columns]

    @property
    def outputs(self) -> list[str]:
        return [o for _, o in self.columns]


@dataclass(frozen=True)
class StarLayout:
    """Dimensions plus the fact's measures (clean column, output column, cast)."""

    name: str
    dims: tuple[DimSpec, ...]
    fact_table: str
    record_key: str
    measures: tuple[tuple[str, str, str | None], ...]
    null_safe_lookup: bool = True   # pandas merge matches null to null
    strict_lookup: bool = True      # a tuple missing from its dimension is an error

    @property
    def tables(self) -> list[str]:
        return [d.table for d in self.dims] + [self.fact_table]


MAIN_STAR = StarLayout(
    name="main",
    dims=(
        DimSpec("dim_demographics", "demographic_id", (
            ("Sex", "sex"), ("Age", "age_group"), ("Education", "education_level"),
            ("Income", "income_bracket"))),
        DimSpec("dim_lifestyle", "lifestyle_id", (
            ("Smoker", "smoker_status"), ("PhysActivity", "physical_activity"),
            ("Fruits", "fruits_consumption"), ("Veggies", "vegetables_consumption"),
            ("HvyAlcoholConsump", "heavy_alcohol_consumption"))),
        DimSpec("dim_medical_conditions", "medical_conditions_id", (
            ("HighBP", "high_blood_pressure"), ("HighChol", "high_cholesterol"),
            ("CholCheck", "cholesterol_check"), ("Stroke", "stroke_history"),
            ("HeartDiseaseorAttack", "heart_disease_or_attack"),
            ("DiffWalk", "difficulty_walking"))),
        DimSpec("dim_healthcare_access", "healthcare_access_id", (
            ("AnyHealthcare", "any_healthcare_coverage"),
            ("NoDocbcCost", "no_doctor_due_to_cost"))),
    ),
    fact_table="fact_health_records",
    record_key="record_id",
    measures=(
        ("diabetes_status", "diabetes_status", "string"),
        ("BMI", "bmi_value", "double"),
        ("MentHlth", "mental_health_days", "double"),
        ("PhysHlth", "physical_health_days", "double"),
        ("GenHlth", "general_health_score", "double"),
    ),
)

# Alternate layout: dimension columns keep their clean names, CholCheck sits in
# healthcare access, DiffWalk is a fact measure, lookups are left joins.
ALT_STAR = StarLayout(
    name="alternate",
    dims=(
        DimSpec("dim_demographics", "demographic_id", tuple(
            (c, c) for c in ("Sex", "Age", "Education", "Income"))),
        DimSpec("dim_lifestyle", "lifestyle_id", tuple(
            (c, c) for c in ("Smoker", "PhysActivity", "Fruits", "Veggies",
                             "HvyAlcoholConsump"))),
        DimSpec("dim_medical_conditions", "medical_conditions_id", tuple(
            (c, c) for c in ("HighBP", "HighChol", "Stroke", "HeartDiseaseorAttack"))),
        DimSpec("dim_healthcare_access", "healthcare_access_id", tuple(
            (c, c) for c in ("AnyHealthcare", "NoDocbcCost", "CholCheck"))),
    ),
    fact_table="fact_health_records",
    record_key="record_id",
    measures=(
        ("diabetes_status", "diabetes_status", None),
        ("BMI", "bmi_value", None),
        ("MentHlth", "mental_health_days", None),
        ("PhysHlth", "physical_health_days", None),
        ("GenHlth", "general_health_score", None),
        ("DiffWalk", "difficulty_walking", None),
    ),
    strict_lookup=False,
)


def domain_size(spec: SurveySpec, clean_col: str) -> int | None:
    """Number of valid values of a clean column, if its domain is closed."""
    dom = spec.validation.get(clean_col)
    return len(dom) if dom is not None else None


def dimension_bound(spec: SurveySpec, dim: DimSpec) -> int | None:
    """Proven upper bound on a dimension's rows after validation, else None."""
    sizes = [domain_size(spec, c) for c in dim.sources]
    if any(s is None for s in sizes):
        return None
    return prod(sizes)


# Largest dimension we broadcast on the strength of its domain bound alone.
BROADCAST_ROW_BOUND = 200_000


# ---------------------------------------------------------------------------
# Other coded tables the same operators run on
# ---------------------------------------------------------------------------

# labels(doc_id, quality, toxic): a natural 0/1 table, no target, no ordinals.
LABELS_SPEC = SurveySpec(
    selected=("quality", "toxic"),
    target=None,
    target_labels={},
    binaries=("quality", "toxic"),
    binary_encoding={"quality": "01", "toxic": "01"},
    ordinals={},
    sex_column=None,
    sex_labels={},
    bmi_column=None,
    rename={},
    validation={"quality": ["No", "Yes"], "toxic": ["No", "Yes"]},
)
