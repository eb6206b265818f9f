"""Column types of every source and stage table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "boolean": BooleanType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "string": StringType(),
}


def _schema(text: str) -> StructType:
    """Schema of 'name type, ...'; needs no running session."""
    out = StructType()
    for field in text.split(", "):
        name, kind = field.split(" ")
        out.add(name, _TYPES[kind])
    return out


GOVERNANCE = _schema("ticker string, spindex string, year int")
COMMITTEES = _schema("boardid long, committeename string, directorid long")
ORGS = _schema("boardid long, ticker string")
DIRECTORS = _schema(
    "ticker string, year double, director_detail_id long, female string, ethnicity string, "
    "attend_less75_pct string, meetingdate date"
)
ROLES = _schema(
    "companyid long, directorid long, directorname string, rolename string, "
    "datestartrole string, dateendrole string"
)
EDUCATION = _schema("directorid long, companyname string, qualification string")
RATIOS = _schema("ticker string, qdate date, roa double")
RANKINGS = _schema("rank string, name string, scores_overall string")

COMPANIES = _schema("ticker string, spindex string")
SP500 = _schema("ticker string, company_name string, GICS string")
UNIVERSITIES = _schema("name string, uniscoreavg double")
CEO = _schema(
    "ticker string, uniscoreavg double, bachelors boolean, masters boolean, mba boolean, "
    "phd boolean, internal_promotion boolean, tenure int, founder boolean, is_co_ceo boolean"
)
BOARD = _schema(
    "ticker string, spindex string, num_committees long, dirs long, over75_pct long, "
    "num_meetings long, avg_meetings double"
)
DIVERSITY = _schema(
    "ticker string, spindex string, female_pct double, diversity_board boolean, shannon double"
)
ROA = _schema("ticker string, roachange string")
RUNS = _schema("model string, run int, accuracy double")
