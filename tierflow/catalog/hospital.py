"""Hospital silver from landed CSV, gold tables and insights."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tierflow.catalog.registry import Tables, query
from tierflow.operators.lookup import with_group_count
from tierflow.plans import hospital
from tierflow.sinks.files import write_csv
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import landing_path

SLOT = "2026/06/19/18/44"
NOW = datetime(2026, 6, 19, 18, 50)

# Landed text of each table; the encounters repeat keys, some keys and dates cannot be read.
RAW = {
    "departments": """
        select p_partkey `Department ID`, p_name `Department Name`, p_size `Hospital ID`,
               p_type `Specialty Description` from {part}""",
    "encounters": """
        select l_orderkey * 100 + l_linenumber `Patient Encounter ID`, o_custkey `Master Patient ID`,
               l_suppkey `Attending Provider ID`,
               concat(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), '.1234567') `Patient Admission Datetime`,
               case when l_returnflag = 'R' then 'open' else
                 replace(date_format(l_shipdate + l_linenumber * interval '5' hour, 'MMM d yyyy h:mma'), ' ', '  ')
               end `Patient Discharge Datetime`,
               cast(l_quantity as string) `Patient LOS`, l_linestatus `Patient LOS Bucket`,
               1 `Patient LOS Bucket Sort`, l_partkey `Department ID`, l_orderkey `Hospital Account ID`,
               'N' `Patient InICU Flag`, 'Y' `Patient Admitted Flag`, l_returnflag `Patient Readmission Flag`
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "hospitals": """
        select s_suppkey `Hospital ID`, s_name `Hospital Name`, concat(s_suppkey, ' Main "Road", ', n_name)
               `Hospital Address Full`, s_suppkey `Hospital Address Number`, 'Main Road' `Hospital Address Street`,
               n_name `Hospital City`, cast(s_nationkey as string) `Hospital Zip Code`,
               cast(s_acctbal as string) `Hospital Latitude`, 'east' `Hospital Longitude`
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "patients": """
        select case when c_mktsegment = 'MACHINERY' then concat('X', c_custkey) else cast(c_custkey as string) end
                 `Master Patient ID`,
               c_name `Patient Name`,
               case when c_nationkey = 3 then 'unknown' else concat(date_format(
                 date '1930-01-01' + cast(c_custkey * 23 % 33000 as int), 'M/d/yyyy'), ' 0:00') end `Patient DOB`,
               'F' `Patient Gender`, 'Single' `Patient Marital Status`,
               case when c_nationkey < 10 then 'high' else cast(c_nationkey as string) end `Patient LACE Score`,
               c_mktsegment `Patient City`, 'ST' `Patient State`, c_mktsegment `Patient Ethnicity`
        from {customer}""",
    "physicians": """
        select s_suppkey `Provider ID`, 'Dr' `Provider First Name`, s_name `Provider Last Name`,
               concat('Dr ', s_name) `Provider Full Name` from {supplier}""",
}


def landed_silver(t: Tables, name: str):
    """Land the table as quoted CSV in its dated folder, run the silver job, read its Parquet."""
    table = hospital.SILVER[name]
    write_csv(t.sql(RAW[name]), landing_path(t.scratch, table.folder, SLOT, table.folder))
    hospital.silver_job(t.spark, table, t.scratch, SLOT, f"{t.scratch}/silver", NOW)
    return t.spark.read.parquet(f"{t.scratch}/silver/{name}").drop("silver_processed_at")


@query("silver_departments", """
    select p_partkey department_id, p_name department_name, cast(p_size as bigint) hospital_id,
           p_type specialty_description from part""")
def silver_departments(t: Tables):
    return landed_silver(t, "departments")


@query("silver_encounters", """
    select encounter_id, patient_id, provider_id, cast(admission_datetime + interval '123456' microsecond as varchar)
           admission_datetime, strftime(discharge_datetime, '%Y-%m-%d %H:%M:%S') discharge_datetime,
           l_quantity length_of_stay_days, l_linestatus los_bucket, l_partkey department_id,
           l_orderkey hospital_account_id, 'N' in_icu_flag, 'Y' is_admitted_flag, l_returnflag is_readmission_flag
    from (select *, row_number() over (partition by encounter_id order by admission_datetime desc nulls last,
                    patient_id, provider_id, discharge_datetime asc nulls last, l_quantity, l_linestatus,
                    l_partkey, l_orderkey, l_returnflag) rn
          from (select l_orderkey * 100 + l_linenumber encounter_id, o_custkey patient_id, l_suppkey provider_id,
                       o_orderdate admission_datetime, case when l_returnflag <> 'R' then
                       l_shipdate + l_linenumber * interval '5' hour end discharge_datetime, l_quantity,
                       l_linestatus, l_partkey, l_orderkey, l_returnflag
                from lineitem join orders on l_orderkey = o_orderkey) e) ranked
    where rn = 1""")
def silver_encounters(t: Tables):
    return landed_silver(t, "encounters")


@query("silver_hospitals", """
    select s_suppkey hospital_id, s_name hospital_name, s_suppkey || ' Main "Road", ' || n_name address,
           n_name city, cast(s_nationkey as varchar) zip_code, s_acctbal latitude, cast(null as double) longitude
    from supplier join nation on s_nationkey = n_nationkey""")
def silver_hospitals(t: Tables):
    return landed_silver(t, "hospitals")


@query("silver_patients", """
    select c_custkey patient_id, c_name patient_name, case when c_nationkey = 3 then '1900-01-01' else
           cast(date '1930-01-01' + cast(c_custkey * 23 % 33000 as int) as varchar) end date_of_birth, 'F' gender,
           'Single' marital_status, cast(case when c_nationkey >= 10 then c_nationkey end as bigint) lace_score,
           c_mktsegment city, 'ST' state, c_mktsegment ethnicity
    from customer where c_mktsegment <> 'MACHINERY'""")
def silver_patients(t: Tables):
    return landed_silver(t, "patients")


@query("silver_physicians", """
    select s_suppkey provider_id, 'Dr' first_name, s_name last_name, 'Dr ' || s_name full_name from supplier""")
def silver_physicians(t: Tables):
    return landed_silver(t, "physicians")


# --- gold ---------------------------------------------------------------------------------

@query("encounters_summary", """
    select encounter_id, patient_id, provider_id, actual_stay_days,
           cast(actual_stay_days * 1200 as double) total_charge,
           cast(actual_stay_days * 750 + 500 as double) operational_cost
    from x_encounters_summary""")
def encounters_summary(t: Tables):
    return hospital.encounters_summary(t.encounters).select(
        "encounter_id", "patient_id", "provider_id", "actual_stay_days", "total_charge", "operational_cost")


@query("patients_demographics", """
    select patient_id, cast(date_of_birth as varchar) date_of_birth, age current_age,
           case when age < 18 then 'Pediatric' when age < 65 then 'Adult' when age >= 65 then 'Geriatric'
                else 'Unknown' end age_group
    from (select *, case when date_of_birth <> date '1900-01-01' then 2026 - year(date_of_birth) end age
          from patients) p""")
def patients_demographics(t: Tables):
    gold = hospital.patients_demographics(t.patients, F.lit("2026-06-19").cast("date"))
    table = Snapshot(t.spark, f"{t.scratch}/patients_demographics", ["patient_id"], buckets=8)
    table.upsert(gold)
    table.upsert(gold)  # a second run of the same source changes nothing
    return table.read().select("patient_id", "date_of_birth", "current_age", "age_group")


@query("departments_directory", """
    select p_partkey department_id, p_name department_name, cast(p_size as bigint) hospital_id,
           p_type specialty_description, true is_active_clinical_unit from part""")
def departments_directory(t: Tables):
    table = Snapshot(t.spark, f"{t.scratch}/departments_directory", ["department_id", "hospital_id"], buckets=8)
    table.upsert(hospital.departments_directory(t.departments))
    return table.read()


@query("hospitals_directory", """
    select hospital_id, hospital_name, city, zip_code,
           count(*) over (partition by zip_code) zipcode_hospitals_total from hospitals""")
def hospitals_directory(t: Tables):
    return hospital.hospitals_directory(t.hospitals)


@query("zip_density_hot", """
    select l_orderkey, cast(l_linenumber as bigint) l_linenumber, l_returnflag,
           count(*) over (partition by l_returnflag) flag_total
    from lineitem""")
def zip_density_hot(t: Tables):
    """Three groups hold all rows."""
    return with_group_count(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag", "flag_total")


@query("physicians_directory", "select * from x_physicians_directory")
def physicians_directory(t: Tables):
    return hospital.physicians_directory(t.physicians, t.encounters)


@query("merged_physicians_directory", "select * from x_physicians_directory")
def merged_physicians_directory(t: Tables):
    table = Snapshot(t.spark, f"{t.scratch}/physicians_directory", ["provider_id"], buckets=8)
    table.upsert(hospital.physicians_directory(t.physicians, t.encounters))
    return table.read()


# --- insights -----------------------------------------------------------------------------

@query("insight_longest_stay", """
    select e.patient_id, p.patient_name, e.actual_stay_days
    from x_encounters_summary e join patients p on e.patient_id = p.patient_id
    order by e.actual_stay_days desc nulls last, e.patient_id limit 1""")
def insight_longest_stay(t: Tables):
    return hospital.longest_stay(hospital.encounters_summary(t.encounters), t.patients)


@query("insight_top_spender", """
    select e.patient_id, any_value(p.patient_name) patient_name,
           cast(sum(e.actual_stay_days * 1200) as double) cumulative_spend
    from x_encounters_summary e join patients p on e.patient_id = p.patient_id
    group by e.patient_id order by 3 desc nulls last, 1 limit 1""")
def insight_top_spender(t: Tables):
    return hospital.highest_spender(hospital.encounters_summary(t.encounters), t.patients)


@query("insight_top_provider", """
    select provider_id, full_name, provider_encounters_total from x_physicians_directory
    order by 3 desc, 1 limit 1""")
def insight_top_provider(t: Tables):
    return hospital.busiest_provider(physicians_directory(t))


@query("insight_top_city", """
    select city, count(hospital_id) hospital_count from hospitals group by city order by 2 desc, 1 limit 1""")
def insight_top_city(t: Tables):
    return hospital.top_hospital_city(t.hospitals)


@query("hospitals_by_city", """
    select city, count(hospital_id) hospital_count, count(distinct hospital_id) distinct_hospitals
    from hospitals group by city""")
def hospitals_by_city(t: Tables):
    return hospital.hospitals_by_city(t.hospitals)
