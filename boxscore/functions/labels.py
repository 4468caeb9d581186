"""Derived labels and patient attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxscore.sources.lookups import ALL_SERVICE_LINES, NOT_SPECIFIED, OTHER, UNKNOWN


def age_years(birth: Column, at: Column) -> Column:
    """V6: whole years between two dates, floor(days / 365.25).
    ``at`` is a column or a literal as-of date; never the wall clock."""
    return F.floor(F.datediff(at, birth) / F.lit(365.25)).cast("bigint")


def peds_flag(age_answer: Column, limit: int = 18) -> Column:
    """V7: 1 when the self-reported age (text) is a number below ``limit``;
    non-numeric answers count as not paediatric."""
    return F.when(age_answer.try_cast("int") < limit, 1).otherwise(0)


def sex_label(sex: Column) -> Column:
    """V8: case-insensitive M/F, otherwise 'Not Specified'."""
    s = F.lower(sex)
    return F.when(s == "f", "Female").when(s == "m", "Male").otherwise(NOT_SPECIFIED)


THERAPIES = "Therapies"


def full_name(last: Column, first: Column) -> Column:
    """V9: 'Last, First'; NULL when either part is NULL."""
    return F.concat(last, F.lit(", "), first)


def clinic_label(name: Column, dept_id: Column) -> Column:
    """V10: 'name [id]', 'Unknown [id]' without a name, NULL without an id."""
    return F.concat(F.coalesce(name, F.lit(UNKNOWN)), F.lit(" ["), F.trim(dept_id), F.lit("]"))


def clinic_label_outpatient(master_name: Column, master_id: Column) -> Column:
    """V11, outpatient form: 'name [id]' of the location master, else plain 'Other'."""
    return F.when(master_name.isNull() | (master_name == UNKNOWN), F.lit(OTHER)).otherwise(
        F.concat(master_name, F.lit(" ["), master_id.cast("string"), F.lit("]")))


def clinic_label2(master_name: Column, master_id: Column, dept_name: Column, dept_id: Column) -> Column:
    """Location-master name first, then the department's own name, then 'Unknown'."""
    usable = master_name.isNotNull() & (master_name != UNKNOWN)
    return (F.when(usable, F.concat(master_name, F.lit(" ["), master_id.cast("string"), F.lit("]")))
            .when(dept_name.isNotNull(), F.concat(dept_name, F.lit(" ["), dept_id.cast("string"), F.lit("]")))
            .otherwise(F.concat(F.lit(UNKNOWN), F.lit(" ["), dept_id.cast("string"), F.lit("]"))))


def service_line(line: Column, operational_service: Column | None = None) -> Column:
    """NULL / 'Unknown' service lines fall back to 'Other'. The outpatient
    form gives the operational service: there 'Therapies' comes first."""
    cond = line.isNull() | (line == UNKNOWN)
    if operational_service is None:
        return F.when(cond, F.lit(OTHER)).otherwise(line)
    return (F.when(cond & (operational_service == THERAPIES), F.lit(THERAPIES))
            .when(cond, F.lit(OTHER)).otherwise(line))


def service_line_display(line: Column, sub_line: Column) -> Column:
    """V13: 'line - sub' except for the roll-up line or a missing sub line."""
    return (F.when(sub_line.isNull(), line)
            .when(line != ALL_SERVICE_LINES, F.concat(line, F.lit(" - "), sub_line))
            .otherwise(line))


def external_name(master: Column, master_external: Column, own_external: Column) -> Column:
    """The master's external name where the master knows the department, else the department's own."""
    return F.when(master.isNotNull() & (master != "Unknown"), master_external).otherwise(own_external)


def unit_or_other(unit: Column, special_units: list[str], special_line: str,
                  line: Column, missing_label: str = OTHER) -> Column:
    """Missing unit -> fixed label; listed (special) units -> a fixed
    service line; otherwise the row's own line. Case-insensitive compare,
    as the source collation was."""
    lowered = [u.lower() for u in special_units]
    return (F.when(unit.isNull(), F.lit(missing_label))
            .when(F.lower(unit).isin(*lowered), F.lit(special_line))
            .otherwise(line))


def with_constants(**kv) -> list[Column]:
    """Fixed constant columns."""
    return [F.lit(v).alias(k) for k, v in kv.items()]
