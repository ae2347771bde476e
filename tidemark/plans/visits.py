"""The visit tables, rules and jobs, ready to run under one root folder."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import guarded_ratio, hash_key, parse_timestamp
from tidemark.operators.quality import Rule, corrupt, in_range
from tidemark.plans.clean import ChildTable, CleanJob, run_clean
from tidemark.plans.curated import CuratedJob, run_curated
from tidemark.plans.mart import MONTH, compact_mart, read_mart, run_mart
from tidemark.plans.reference import load_reference
from tidemark.sinks.writers import QualityRecord
from tidemark.sources.readers import read_raw_json
from tidemark.sources.tables import Table
from tidemark.staging import scratch

# Rule codes, bounds and the allowed share of rejected rows.
CORRUPT_JSON = "Malformed JSON record could not be parsed"
INVALID_AGE = "INVALID_AGE"
INVALID_TEMPERATURE = "INVALID_TEMPERATURE"
AGES = (0, 120)
TEMPERATURES = (34.0, 43.0)
LIMIT_PERCENT = 5.0

# Declared columns of the tables.
RAW_VISITS = """
    id bigint, visit_date string, age int, gender_id int, profession_id int, doctor_id int,
    department_id int, snils string, height int, weight float, temperature float,
    bp_systolic int, bp_diastolic int, disease_code string, blood_type string,
    symptoms_code array<string>, chronic_diseases array<string>, lab_hemoglobin float,
    lab_leukocytes float, lab_glucose float, lab_cholesterol float, _corrupt_record string
"""
_MEASURES = """
    id string NOT NULL, visit_date timestamp_ntz, age int, gender_id int, profession_id int,
    doctor_id int, department_id int, snils string, height int, weight float, bmi float,
    temperature float, bp_systolic int, bp_diastolic int, disease_code string,
    blood_type string, lab_hemoglobin float, lab_leukocytes float, lab_glucose float,
    lab_cholesterol float
"""
_STAMPS = "created_at timestamp_ntz, updated_at timestamp_ntz"
CLEAN_VISITS = f"{_MEASURES}, {_STAMPS}"
CURATED_VISITS = f"""
    {_MEASURES}, symptoms_list array<string>, chronic_list array<string>,
    department_name string, profession_name string, {_STAMPS}
"""
SYMPTOMS = f"visit_id string NOT NULL, symptoms_code string, visit_date timestamp_ntz, {_STAMPS}"
CHRONIC = f"visit_id string NOT NULL, chronic_diseases string, visit_date timestamp_ntz, {_STAMPS}"
DIRECTORY = "id int NOT NULL, name string NOT NULL"
REQUIRED_IN_MART = ("id", "visit_date", "updated_at")


def visit_rules(ages: tuple = AGES, temperatures: tuple = TEMPERATURES) -> list[Rule]:
    return [
        corrupt(CORRUPT_JSON),
        in_range("age", *ages, INVALID_AGE),
        in_range("temperature", *temperatures, INVALID_TEMPERATURE),
    ]


def shape_visits(typed: DataFrame) -> DataFrame:
    """Visit date as a timestamp, hash of the natural key as id, body mass index."""
    dated = typed.withColumn("visit_date", parse_timestamp(F.col("visit_date")))
    person_and_reason = [F.col("visit_date"), F.col("snils"), F.col("disease_code")]
    return dated.withColumns(
        {
            "id": hash_key(*person_and_reason),
            "bmi": guarded_ratio(F.col("weight"), F.col("height")),
        }
    )


class Visits:
    """All layers of the visit tables below ``root``. Needs an active session."""

    def __init__(
        self, root: str, rules: list[Rule] | None = None, limit_percent: float = LIMIT_PERCENT
    ):
        schema = T.StructType.fromDDL
        self.mart = f"{root}/mart/visits"
        self.departments = Table(f"{root}/clean/departments", schema(DIRECTORY), ("id",))
        self.professions = Table(f"{root}/clean/professions", schema(DIRECTORY), ("id",))
        self.clean = Table(
            f"{root}/clean/visits",
            schema(CLEAN_VISITS),
            keys=("visit_date", "snils", "disease_code"),
            date="visit_date",
            cluster=("snils",),
        )
        self.symptoms = Table(
            f"{root}/clean/visits_symptoms", schema(SYMPTOMS), date="visit_date", grain="day", cluster=("visit_id",)
        )
        self.chronic = Table(
            f"{root}/clean/visits_chronic", schema(CHRONIC), date="visit_date", grain="day", cluster=("visit_id",)
        )
        self.curated = Table(
            f"{root}/curated/visits",
            schema(CURATED_VISITS),
            keys=("id", "visit_date"),
            date="visit_date",
            cluster=("id",),
        )
        parent = {"visit_id": "id", "visit_date": "visit_date"}
        self.clean_job = CleanJob(
            raw_schema=schema(RAW_VISITS),
            rules=visit_rules() if rules is None else rules,
            limit_percent=limit_percent,
            shape=shape_visits,
            clean=self.clean,
            children=[
                ChildTable(self.symptoms, parent, "symptoms_code", "symptoms_code"),
                ChildTable(self.chronic, parent, "chronic_diseases", "chronic_diseases"),
            ],
            quarantine=f"{root}/quarantine",
            metrics=f"{root}/metrics",
        )
        self.curated_job = CuratedJob(
            parents=self.clean,
            children=[
                (self.symptoms, parent, "symptoms_code", "symptoms_list"),
                (self.chronic, parent, "chronic_diseases", "chronic_list"),
            ],
            dimensions=[
                (self.departments, "department_id", "id", {"name": "department_name"}),
                (self.professions, "profession_id", "id", {"name": "profession_name"}),
            ],
            curated=self.curated,
        )

    def load_references(self, spark: SparkSession, departments: str, professions: str) -> None:
        load_reference(spark, departments, self.departments)
        load_reference(spark, professions, self.professions)

    def load_raw(
        self,
        spark: SparkSession,
        raw: str,
        ds: str,
        run_ts: datetime | None = None,
        multiline: bool = False,
    ) -> QualityRecord:
        """Raw files of a run date into the clean tables; ``raw`` has a folder per date.

        Records stand on lines of their own. ``multiline`` reads files that are one document
        each, large ones by many tasks.
        """
        with scratch(spark, "raw") as folder:
            batch = read_raw_json(spark, f"{raw}/{ds}/*", self.clean_job.raw_schema, multiline, folder=folder)
            return run_clean(batch, self.clean_job, ds, run_ts)

    def advance_curated(self, spark: SparkSession, run_ts: datetime | None = None) -> int:
        return run_curated(spark, self.curated_job, run_ts)

    def advance_mart(self, spark: SparkSession) -> int:
        return run_mart(
            self.curated, self.mart, "visit_date", ["id"], REQUIRED_IN_MART
        )

    def compact_mart(self, spark: SparkSession, share: float = 0.2) -> list[str]:
        return compact_mart(spark, self.mart, self._mart_schema(), [MONTH, "id"], share=share)

    def read_mart(self, spark: SparkSession) -> DataFrame:
        return read_mart(spark, self.mart, self._mart_schema(), [MONTH, "id"])

    def _mart_schema(self) -> T.StructType:
        month = T.StructField(MONTH, T.DateType())
        return T.StructType([*self.curated.file_schema().fields, month])
