"""Silver and gold tables of the hospital tier, and the insights on them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.functions.columns import age_group, age_in_years, birth_date, parse_timestamp, stay_days
from tierflow.operators.dedup import keep_latest
from tierflow.operators.lookup import with_group_count
from tierflow.sinks.files import write_parquet
from tierflow.sources.files import landing_path, read_csv_if_filled, text_schema


def _whole(name: str) -> Column:
    return F.col(f"`{name}`").try_cast("int")


def _real(name: str) -> Column:
    return F.col(f"`{name}`").try_cast("double")


def _text(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class SilverTable:
    """Source header, output columns in order, key and the column that decides between duplicates."""

    name: str
    header: tuple[str, ...]
    columns: Callable[[], dict[str, Column]]
    keys: tuple[str, ...]
    latest: tuple[str, ...] = ()
    folder: str = ""

    def clean(self, raw: DataFrame) -> DataFrame:
        """Named and typed columns, rows with a readable first key, one row per key."""
        return self._one_per_key(raw.select(*[c.alias(n) for n, c in self.columns().items()]))

    def _one_per_key(self, typed: DataFrame) -> DataFrame:
        return keep_latest(typed.filter(F.col(self.keys[0]).isNotNull()), list(self.keys), list(self.latest))

    def clean_counted(self, raw: DataFrame) -> tuple[DataFrame, Observation]:
        """``clean``, and what it refuses, known once the result is written: rows ``read``, with no text where the first
        key should be (``no_key``), and with one that cannot be read (``unreadable_key``)."""
        seen, given = Observation(), F.trim(F.col(f"`{self.header[0]}`"))
        typed = raw.select(*[c.alias(n) for n, c in self.columns().items()], (F.coalesce(given, F.lit("")) == "").alias("_blank"))
        typed = typed.observe(
            seen, F.count(F.lit(1)).alias("read"), F.count_if("_blank").alias("no_key"),
            F.count_if(~F.col("_blank") & F.col(self.keys[0]).isNull()).alias("unreadable_key"))
        return self._one_per_key(typed.drop("_blank")), seen


# Source headers and the snake_case names and types they become.
DEPARTMENTS = SilverTable(
    "departments",
    ("Department ID", "Department Name", "Hospital ID", "Specialty Description"),
    lambda: {
        "department_id": _whole("Department ID"),
        "department_name": _text("Department Name"),
        "hospital_id": _whole("Hospital ID"),
        "specialty_description": _text("Specialty Description"),
    },
    keys=("department_id", "hospital_id"),
    folder="Departments",
)
ENCOUNTERS = SilverTable(
    "encounters",
    ("Patient Encounter ID", "Master Patient ID", "Attending Provider ID", "Patient Admission Datetime",
     "Patient Discharge Datetime", "Patient LOS", "Patient LOS Bucket", "Patient LOS Bucket Sort",
     "Department ID", "Hospital Account ID", "Patient InICU Flag", "Patient Admitted Flag",
     "Patient Readmission Flag"),
    lambda: {
        "encounter_id": _whole("Patient Encounter ID"),
        "patient_id": _whole("Master Patient ID"),
        "provider_id": _whole("Attending Provider ID"),
        "admission_datetime": parse_timestamp(_text("Patient Admission Datetime"), fx.ADMISSION_FORMAT),
        "discharge_datetime": parse_timestamp(_text("Patient Discharge Datetime"), fx.DISCHARGE_FORMAT),
        "length_of_stay_days": _real("Patient LOS"),
        "los_bucket": _text("Patient LOS Bucket"),
        "department_id": _whole("Department ID"),
        "hospital_account_id": _whole("Hospital Account ID"),
        "in_icu_flag": _text("Patient InICU Flag"),
        "is_admitted_flag": _text("Patient Admitted Flag"),
        "is_readmission_flag": _text("Patient Readmission Flag"),
    },
    keys=("encounter_id",),
    latest=("admission_datetime",),
    folder="Encounters",
)
HOSPITALS = SilverTable(
    "hospitals",
    ("Hospital ID", "Hospital Name", "Hospital Address Full", "Hospital Address Number",
     "Hospital Address Street", "Hospital City", "Hospital Zip Code", "Hospital Latitude",
     "Hospital Longitude"),
    lambda: {
        "hospital_id": _whole("Hospital ID"),
        "hospital_name": _text("Hospital Name"),
        "address": _text("Hospital Address Full"),
        "city": _text("Hospital City"),
        "zip_code": _text("Hospital Zip Code"),
        "latitude": _real("Hospital Latitude"),
        "longitude": _real("Hospital Longitude"),
    },
    keys=("hospital_id",),
    folder="Hospitals",
)
PATIENTS = SilverTable(
    "patients",
    ("Master Patient ID", "Patient Name", "Patient DOB", "Patient Gender", "Patient Marital Status",
     "Patient LACE Score", "Patient City", "Patient State", "Patient Ethnicity"),
    lambda: {
        "patient_id": _whole("Master Patient ID"),
        "patient_name": _text("Patient Name"),
        "date_of_birth": birth_date(_text("Patient DOB")),
        "gender": _text("Patient Gender"),
        "marital_status": _text("Patient Marital Status"),
        "lace_score": _whole("Patient LACE Score"),
        "city": _text("Patient City"),
        "state": _text("Patient State"),
        "ethnicity": _text("Patient Ethnicity"),
    },
    keys=("patient_id",),
    folder="Patients",
)
PHYSICIANS = SilverTable(
    "physicians",
    ("Provider ID", "Provider First Name", "Provider Last Name", "Provider Full Name"),
    lambda: {
        "provider_id": _whole("Provider ID"),
        "first_name": _text("Provider First Name"),
        "last_name": _text("Provider Last Name"),
        "full_name": _text("Provider Full Name"),
    },
    keys=("provider_id",),
    folder="Physicians",
)
SILVER = {t.name: t for t in (DEPARTMENTS, ENCOUNTERS, HOSPITALS, PATIENTS, PHYSICIANS)}


def silver_outcome(
    spark: SparkSession, table: SilverTable, landing_root: str, slot: str, silver_root: str, now: datetime
) -> dict[str, int] | None:
    """Landed CSV of one slot to silver Parquet: rows ``read``, refused by reason (``no_key``, ``unreadable_key``),
    ``repeated`` and ``written``, which add up. None, and an untouched target, without input rows."""
    source = landing_path(landing_root, table.folder, slot, table.folder)
    raw = read_csv_if_filled(spark, source, text_schema(table.header))
    if raw is None:
        return None
    cleaned, seen = table.clean_counted(raw)
    written = write_parquet(cleaned.withColumn("silver_processed_at", F.lit(now)), f"{silver_root.rstrip('/')}/{table.name}")
    found = seen.get
    return {**found, "repeated": found["read"] - found["no_key"] - found["unreadable_key"] - written, "written": written}


def silver_job(
    spark: SparkSession, table: SilverTable, landing_root: str, slot: str, silver_root: str, now: datetime
) -> int | None:
    """Rows that ``silver_outcome`` wrote."""
    outcome = silver_outcome(spark, table, landing_root, slot, silver_root, now)
    return None if outcome is None else outcome["written"]


# --- gold ---------------------------------------------------------------------------------

def encounters_summary(encounters: DataFrame) -> DataFrame:
    """Stay length, charge and cost; one pass without a shuffle."""
    days = F.col("actual_stay_days")
    return encounters.withColumn(
        "actual_stay_days", stay_days(F.col("admission_datetime"), F.col("discharge_datetime"))
    ).withColumns({
        "total_charge": days * fx.CHARGE_PER_DAY,
        "operational_cost": days * fx.COST_PER_DAY + fx.COST_PER_STAY,
    })


def patients_demographics(patients: DataFrame, as_of: Column) -> DataFrame:
    return patients.withColumn("current_age", age_in_years(F.col("date_of_birth"), as_of)).withColumn(
        "age_group", age_group(F.col("current_age"))
    )


def departments_directory(departments: DataFrame) -> DataFrame:
    return departments.withColumn("is_active_clinical_unit", F.lit(True))


def hospitals_directory(hospitals: DataFrame) -> DataFrame:
    return with_group_count(hospitals, "zip_code", "zipcode_hospitals_total")


def physicians_directory(physicians: DataFrame, encounters: DataFrame) -> DataFrame:
    """Encounters are counted per provider before the join, so providers are never multiplied."""
    load = encounters.groupBy("provider_id").agg(F.count("encounter_id").alias("_encounters"))
    return (
        physicians.join(load, "provider_id", "left")
        .select("provider_id", "full_name",
                F.coalesce("_encounters", F.lit(0)).alias("provider_encounters_total"))
        .distinct()
    )


# --- insights -----------------------------------------------------------------------------

def longest_stay(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """The longest stay of any known patient; the lowest patient id wins a tie.

    Only the longest stay per patient can win, so encounters are reduced to one row per patient
    before the join.
    """
    per_patient = encounters.groupBy("patient_id").agg(F.max("actual_stay_days").alias("actual_stay_days"))
    return (
        per_patient.join(patients.select("patient_id", "patient_name"), "patient_id")
        .select("patient_id", "patient_name", "actual_stay_days")
        .orderBy(F.desc_nulls_last("actual_stay_days"), "patient_id", "patient_name").limit(1)
    )


def highest_spender(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    spend = encounters.groupBy("patient_id").agg(F.sum("total_charge").alias("cumulative_spend"))
    return (
        spend.join(patients.select("patient_id", "patient_name"), "patient_id")
        .select("patient_id", "patient_name", "cumulative_spend")
        .orderBy(F.desc_nulls_last("cumulative_spend"), "patient_id", "patient_name").limit(1)
    )


def busiest_provider(physicians: DataFrame) -> DataFrame:
    return (
        physicians.select("provider_id", "full_name", "provider_encounters_total")
        .orderBy(F.desc_nulls_last("provider_encounters_total"), "provider_id", "full_name").limit(1)
    )


def hospitals_by_city(hospitals: DataFrame) -> DataFrame:
    """Rows and distinct hospitals per city."""
    return hospitals.groupBy("city").agg(
        F.count("hospital_id").alias("hospital_count"),
        F.count_distinct("hospital_id").alias("distinct_hospitals"),
    )


def top_hospital_city(hospitals: DataFrame) -> DataFrame:
    return (
        hospitals.groupBy("city").agg(F.count("hospital_id").alias("hospital_count"))
        .orderBy(F.desc("hospital_count"), F.asc_nulls_last("city")).limit(1)
    )
