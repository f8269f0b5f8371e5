"""Data-repair jobs; each takes tables and returns tables, published by the caller."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, jsondoc, text
from ..operators.dedupe import dedupe_keep_first, duplicate_report, require_unique, tag_by_max
from ..operators.keys import assign_sequential_ids
from ..operators.merge import add_column, fill_from_map, fill_null_from_lookup, patch_non_null, update_where
from ..operators.repair import (
    ListedUpdate,
    Split,
    case_update,
    delete_cascade,
    delete_listed,
    delete_where,
    recode,
    update_listed,
)

# Income bands; each lists the spellings that become it, tried in this order.
INCOME_BANDS = {
    "Below or Equal to 3 lacs per year (INR)": [
        "Below 3 Lacs", "Less than 3 Lacs", "Below or Equal to 3 Lacs per year (INR)",
    ],
    "Above 5 lacs per year (INR)": ["Above 5 lacs", "Above 12 lacs", "Below 12 lacs"],
    "Between 3-5 lacs (INR) per year": ["Below 5 Lacs", "Above 3 lacs per year (INR)", "Less than 5 lacs"],
}

# Replacements of single values.
CASTE_NAMES = {"others": "Other"}
COLLEGE_IDS = {233: 243}
COLLEGE_NAMES = {
    "ACS Medical College & Hospital": "Narsee Monjee Institute of Management Studies (NMIMS)",
}
YEAR_KEY = "currently_pursuing_year"
YEAR_SPELLINGS = {"Persued": "Pursued"}
JSON_KEY_RENAMES = {
    "New_College_Name": "new_college_name",
    "Currently_Pursuing_Year": "currently_pursuing_year",
}

# Batches the geography repair trims.
GEOGRAPHY_BATCHES = ["Incubator 4.0", "TS/TT 1.0", "Incubator 6.0", "Incubator 7.0"]
STATE_NAMES = {"New Delhi": "Delhi"}

# District names, applied in this order.
DISTRICT_NAMES = {
    "Utnoor": "Adilabad",
    "Shadnagar": "Ranga Reddy",
    "Devarakonda": "Nalgonda",
    "Armoor": "Nizamabad",
    "Bhupalpally": "Jayashankar Bhupalapally",
    "Suryapeta": "Suryapet",
    "Asifabad": "Kumuram Bheem Asifabad",
    "Sircilla": "Rajanna Sircilla",
    "Kothagudem": "Bhadradri Kothagudem",
    "Janagaon": "Jangaon",
    "Jangoan": "Jangaon",
    "Dammapeta": "Khammam",
    "Mysuru": "Mysore",
    "Bengaluru Rural": "Bangalore Rural",
    "Bengaluru Urban": "Bangalore Urban",
    "Ahmednagar": "Ahilyanagar / Ahmednagar",
    "Kanchipuram": "Kancheepuram",
    "Shimoga": "Shivamogga",
    "Mumbai City": "Mumbai",
}

# States that follow from the district.
DISTRICT_STATES = {
    "Purba Medinipur": "West Bengal",
    "Agra": "Uttar Pradesh",
    "Thrissur": "Kerala",
    "Kannur": "Kerala",
    "Khagaria": "Bihar",
    "Thiruvananthapuram": "Kerala",
    "Bangalore Rural": "Karnataka",
    "New Delhi": "Delhi",
    "Bangalore Urban": "Karnataka",
}

# The malformed timestamp text, and the columns a cleaned sheet may patch.
MALFORMED_TIMESTAMP = r"T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}Z"
SHEET_PATCH_COLUMNS = [
    "Currently_Pursuing_Degree", "Currently_Pursuing_Year", "Subject_Area", "Name_of_College_University",
    "University", "Country", "State_Union_Territory", "District", "City_Category", "Caste_Category",
    "Annual_Family_Income", "Assigned_Through", "College_Category", "Student_Role",
    "College_State_Union_Territory", "Incubator_Batch",
]


def standardise_emails(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, text.normalised(F.col(column)))


def income_band(c: Column) -> Column:
    """The band of a known spelling, else the value as it is. No band is a spelling of a later one."""
    result = c
    for band, spellings in reversed(INCOME_BANDS.items()):
        hit = reduce(lambda a, b: a | b, [F.ilike(F.trim(c), F.lit(s)) for s in spellings])
        result = F.when(hit, band).otherwise(result)
    return result


def standardise_students(students: DataFrame) -> DataFrame:
    named = recode(students, "caste", CASTE_NAMES, normalise=text.normalised)
    return named.withColumn("annual_family_income_inr", income_band(F.col("annual_family_income_inr")))


def standardise_education(education: DataFrame) -> DataFrame:
    for old, new in COLLEGE_IDS.items():
        education = update_where(education, F.col("college_id") == old, {"college_id": F.lit(new)})
    return education


def standardise_colleges(colleges: DataFrame) -> DataFrame:
    return recode(colleges, "standard_college_names", COLLEGE_NAMES, normalise=lambda c: c)


def standardise_forms(registrations: DataFrame, column: str = "form_details") -> DataFrame:
    fixes = [jsondoc.value_replaced(YEAR_KEY, wrong, right) for wrong, right in YEAR_SPELLINGS.items()]
    return registrations.withColumn(column, jsondoc.edit(F.col(column), jsondoc.value_trimmed(YEAR_KEY), *fixes))


def rename_form_keys(registrations: DataFrame, column: str = "form_details") -> DataFrame:
    return registrations.withColumn(column, jsondoc.rename_keys(F.col(column), JSON_KEY_RENAMES))


def untrimmed_values(df: DataFrame, column: str, condition: Column | None = None) -> DataFrame:
    """Distinct dirty values beside their clean form."""
    rows = df if condition is None else df.filter(condition)
    clean = F.trim(F.col(column)).alias("cleaned")
    return rows.filter(text.is_untrimmed(F.col(column))).select(F.col(column).alias("original"), clean).distinct()


def repair_geography(sheet: DataFrame, batches: list[str] | None = None) -> DataFrame:
    """Trim in the given batches, rename states and districts, then derive states from districts."""
    state, district = "State_Union_Territory", "District"
    in_batch = F.col("Incubator_Batch").isin(*(GEOGRAPHY_BATCHES if batches is None else batches))
    trimmed = update_where(sheet, in_batch, {c: F.trim(F.col(c)) for c in (state, district)})
    named = recode(recode(trimmed, state, STATE_NAMES), district, DISTRICT_NAMES)
    return case_update(named, state, F.trim(F.col(district)), DISTRICT_STATES)


def purge_fractional_timestamps(assignments: DataFrame, cohort_codes: list[str]) -> Split:
    return delete_where(
        assignments, dates.has_fraction(F.col("submitted_at")) & F.col("cohort_code").isin(*cohort_codes)
    )


def purge_blank_timestamps(assignments: DataFrame, cohort_codes: list[str]) -> Split:
    return delete_where(
        assignments, text.is_blank(F.col("submitted_at")) & F.col("cohort_code").isin(*cohort_codes)
    )


def purge_malformed_feed(feed: DataFrame, sheet: DataFrame, batches: list[str]) -> Split:
    """Feed rows with the malformed form whose e-mail belongs to one of the batches."""
    members = sheet.filter(F.col("Incubator_Batch").isin(*batches))
    return delete_listed(feed, "Email", members, "Email", F.col("submitted_at").rlike(MALFORMED_TIMESTAMP))


@dataclass(frozen=True)
class DuplicateStudents:
    kept: DataFrame
    deleted: DataFrame
    skipped: DataFrame


def purge_duplicate_students(students: DataFrame, registrations: DataFrame, null_keys: str = "keep") -> DuplicateStudents:
    """Drop older rows of an e-mail unless a registration names them; those stay and are listed."""
    tagged = tag_by_max(students, "email", "id", registrations, "student_id", null_keys)

    def part(condition: Column) -> DataFrame:
        return tagged.filter(condition).drop("disposition")

    tag = F.col("disposition")
    return DuplicateStudents(part(tag != "unreferenced"), part(tag == "unreferenced"), part(tag == "referenced"))


def remove_students(
    ids: DataFrame,
    children: dict[str, DataFrame],
    students: DataFrame,
    sheet: DataFrame,
    new_emails: dict[int, str] | None = None,
) -> dict[str, Split]:
    """Correct some addresses, then delete the ids from children, parent and landing, in this order."""
    sheet_id = F.col("Student_id").cast("int")
    if new_emails:
        students = fill_from_map(students, "id", "email", new_emails)
        sheet = fill_from_map(sheet.withColumn("_id", sheet_id), "_id", "Email", new_emails).drop("_id")
    tables = {name: (df, "student_id") for name, df in children.items()}
    tables["student_details"] = (students, "id")
    tables["general_information_sheet"] = (sheet, "Student_id")
    return delete_cascade(tables, ids.select(F.col(ids.columns[0]).alias("_id")), "_id")


def assign_batch(sheet: DataFrame, emails: DataFrame, batch: str, course: str) -> ListedUpdate:
    values = {"Incubator_Batch": F.lit(batch), "Incubator_Course_Name": F.lit(course)}
    return update_listed(sheet, "Email", emails, "Email", values)


def roll_back_load(df: DataFrame, start, end, column: str = "inserted_at") -> Split:
    """Rows inserted from start up to, but not at, end."""
    return delete_where(df, dates.in_window(F.col(column), start, end))


@dataclass(frozen=True)
class GuardedTable:
    rows: DataFrame
    duplicates: DataFrame


def guard_table(df: DataFrame, keys: list[str], order_by: list[str], check: bool = True) -> GuardedTable:
    """Report duplicates, keep the first of each key (NULL keys count as equal) and check the result."""
    clean = dedupe_keep_first(df, keys, order_by)
    if check:
        require_unique(clean, keys, null_keys="equal")
    return GuardedTable(clean, duplicate_report(df, keys, "cnt"))


def patch_sheet(
    sheet: DataFrame, cleaned: DataFrame, batches: list[str], order_by: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Take over filled values of a cleaned sheet for some batches."""
    chosen = cleaned.filter(F.col("Incubator_Batch").isin(*batches))
    wanted = [c for c in (columns or SHEET_PATCH_COLUMNS) if c in sheet.columns and c in cleaned.columns]
    return patch_non_null(sheet, chosen, "Student_id", wanted, order_by)


def patch_course_names(sheet: DataFrame, cleaned: DataFrame, batch: str, order_by: list[str]) -> DataFrame:
    return patch_sheet(sheet, cleaned, [batch], order_by, ["Incubator_Course_Name"])


def fill_locations(students: DataFrame, sheet: DataFrame, locations: DataFrame) -> DataFrame:
    """Students without a location take the one whose state and district match their sheet row."""
    places = locations.select(
        text.normalised(F.col("state_union_territory")).alias("_s"),
        text.normalised(F.col("district")).alias("_d"),
        F.col("location_id").alias("_location"),
    ).groupBy("_s", "_d").agg(F.min("_location").alias("_location"))
    rows = sheet.select(
        F.col("Student_id").cast("int").alias("_id"),
        text.normalised(F.col("State_Union_Territory")).alias("_s"),
        text.normalised(F.col("District")).alias("_d"),
    )
    return fill_null_from_lookup(
        students, rows.join(places, ["_s", "_d"]), [(F.col("id"), F.col("_id"))], "location_id", "_location"
    )


def fill_missing_ids(sheet: DataFrame, order_by: list[str], id_col: str = "Student_id") -> DataFrame:
    return assign_sequential_ids(sheet, id_col, order_by)


def purge_addresses(sheet: DataFrame, addresses: DataFrame) -> Split:
    """Delete rows whose trimmed e-mail is listed."""
    return delete_listed(sheet, "Email", addresses, addresses.columns[0], normalise=F.trim)


def set_column(df: DataFrame, column: str, value, where_column: str, where_value) -> DataFrame:
    return update_where(df, F.col(where_column) == F.lit(where_value), {column: F.lit(value)})


def add_mapped_column(df: DataFrame, id_col: str, column: str, dtype: str, values: dict) -> DataFrame:
    return fill_from_map(add_column(df, column, dtype), id_col, column, values)

