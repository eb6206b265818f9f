"""Stage tables: companies, universities, CEO, board, diversity, target and wide table.

Rows that a join would only repeat are aggregated before it: directors are not multiplied by
committees, roles not by degrees, roles not by roles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.functions.bins import label_bins
from boardlens.functions.dates import date_or, lenient_date, strict_date, tenure_years
from boardlens.functions.text import (
    DIVERSITY_PATTERN,
    RANK_SENTINEL,
    SCORE_SENTINELS,
    contains_ci,
    degree_flags,
    differs,
    matches_ci,
    score_midpoint,
    yes_no,
)
from boardlens.operators.aggregates import (
    any_true,
    distinct_counts,
    integer_share,
    last_non_null,
    shannon,
)
from boardlens.operators.fuzzy import best_match
from boardlens.operators.joins import keep_matching, null_safe_left, preceded_by_other
from boardlens.operators.rows import nan_to_null, overwrite_where
from boardlens.operators.windows import first_of_newest, row_lag
from boardlens.sources.html import first_table
from boardlens.sources.tables import snapshot

# Marker of joint chief executives and the year that sorts them first.
CO_CEO = {"directorname": "Co-CEO", "directorid": 12345, "rolename": "CO-CEO"}
CO_CEO_YEAR = 2030
YEAR = 2023
ROLE_KEYS = ["ticker", "directorid", "directorname", "rolename"]
DEGREES = ["bachelors", "masters", "mba", "phd"]


def companies(governance: DataFrame, year: int = YEAR) -> DataFrame:
    return governance.where(F.col("year") == year).select("ticker", "spindex")


def index_members(pages: DataFrame, html: str = "html") -> DataFrame:
    """(ticker, company_name, GICS) from the first table of a stored constituents page."""
    columns = {"Symbol": "ticker", "Security": "company_name", "GICS Sector": "GICS"}
    return first_table(pages, html, columns).drop("row")


def clean_scores(rankings: DataFrame) -> DataFrame:
    """Ranking rows without sentinels (null rank kept), scores as numbers."""
    score = F.col("scores_overall")
    rows = rankings.where(differs(F.col("rank"), RANK_SENTINEL))
    for sentinel in SCORE_SENTINELS:
        rows = rows.where(differs(score, sentinel))
    return rows.withColumn("scores_overall", score_midpoint(score))


def universities(rankings: DataFrame) -> DataFrame:
    """Mean score per university over all years."""
    return (
        clean_scores(rankings)
        .where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.avg(F.when(~F.isnan("scores_overall"), F.col("scores_overall"))).alias("uniscoreavg"))
    )


def is_ceo(role: Column) -> Column:
    """Chief-executive role of the whole firm; null role gives null."""
    return (
        contains_ci(role, "CEO") & ~contains_ci(role, "regional") & ~contains_ci(role, "division")
    )


def firm_roles(roles: DataFrame, orgs: DataFrame) -> DataFrame:
    """Roles with the ticker of their firm."""
    firms = orgs.where(F.col("ticker").isNotNull()).select("boardid", "ticker").distinct()
    return roles.join(firms, roles["companyid"] == firms["boardid"]).drop("companyid", "boardid")


def director_degrees(
    education: DataFrame, universities: DataFrame, directors: DataFrame, cutoff: int = 80
) -> DataFrame:
    """Per director: mean matched university score and degree-level flags."""
    degrees = (
        keep_matching(education, directors, ["directorid"])
        .select("directorid", F.col("companyname").alias("university"), "qualification")
        .distinct()
    )
    matched = best_match(
        degrees, "university", universities, "name", cutoff, carry=("uniscoreavg",)
    )
    return (
        degrees.join(matched.select("university", "uniscoreavg"), "university", "left")
        .withColumns(degree_flags(F.col("qualification")))
        .groupBy("directorid")
        .agg(
            F.avg("uniscoreavg").alias("uniscoreavg"),
            *[F.bool_or(c).alias(c) for c in DEGREES],
        )
    )


def telling_roles(roles: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The roles that tell who is chief executive and who held another role before, with dates.

    Other chief-executive titles (regional, division) and null titles tell neither. Of roles without
    such a title only firm, director and start count, so their names and titles are blanked and fall
    into one group. A chief executive's start that is no date stays as text in ``bad_start``.
    """
    role = F.col("rolename")
    ceo, other = is_ceo(role), ~contains_ci(role, "CEO")
    start = F.col("start")
    return (
        roles.withColumn("start", lenient_date(F.col("datestartrole")))
        .where(ceo | other)
        .select(
            "companyid",
            "directorid",
            F.when(ceo, F.col("directorname")).alias("directorname"),
            F.when(ceo, role).otherwise("").alias("rolename"),
            "start",
            F.when(ceo & start.isNull(), F.col("datestartrole")).alias("bad_start"),
            F.when(ceo, date_or(F.col("dateendrole"), as_of)).alias("end"),
        )
    )


def role_spans(held: DataFrame) -> DataFrame:
    """One row per (ticker, director, name, role): first and latest start and the latest end.

    The one pass over the ``telling_roles``; everything about chief executives follows from this
    table. A chief executive's start that is no date fails here under ANSI mode.
    """
    start = F.col("start")
    return held.groupBy(*ROLE_KEYS).agg(
        F.min(F.coalesce(start, strict_date(F.col("bad_start")))).alias("start"),
        F.max(start).alias("latest_start"),
        F.max("end").alias("end"),
    )


def ceo_spells(spans: DataFrame) -> DataFrame:
    """The chief-executive roles among ``role_spans``, with tenure and flags.

    ``_key`` keeps the keys as they were before joint chief executives get one marker.
    """
    role = F.col("rolename")
    spells = (
        spans.where(is_ceo(role))
        .dropna(subset=ROLE_KEYS)
        .drop("latest_start")
        .withColumns(
            {
                "_key": F.struct("directorid", "directorname", "rolename"),
                "validstart": F.year("start"),
                "tenure": tenure_years(F.col("start"), F.col("end")),
                "founder": contains_ci(role, "founder", null_as=False),
                "is_co_ceo": contains_ci(role, "co-ceo", null_as=False),
            }
        )
    )
    return overwrite_where(spells, F.col("is_co_ceo"), CO_CEO | {"validstart": CO_CEO_YEAR})


def promotions(spans: DataFrame) -> DataFrame:
    """(ticker, directorid, rolename) of chief-executive roles that another role came before.

    Roles of one director count together however the name is written.
    """
    role = F.col("rolename")
    return preceded_by_other(
        spans.withColumn("_start", F.when(contains_ci(role, "CEO"), F.col("latest_start")).otherwise(F.col("start"))),
        ["ticker", "directorid"],
        "rolename",
        contains_ci(role, "CEO"),
        F.col("_start"),
    )


def ceo_background(
    companies: DataFrame,
    roles: DataFrame,
    orgs: DataFrame,
    education: DataFrame,
    universities: DataFrame,
    as_of: dt.date | str,
    cutoff: int = 80,
) -> DataFrame:
    """One row per ticker about its current chief executive; open end dates mean ``as_of``.

    The current one is the first row, in key order, of the director who started last. Degrees
    and earlier roles are looked up for that row only. Roles are read once, into a stored table.
    """
    listed = companies.where(F.col("ticker").isNotNull()).select("ticker").distinct()
    held = keep_matching(firm_roles(telling_roles(roles, as_of), orgs), listed, ["ticker"])
    spans = snapshot(role_spans(held))
    newest = first_of_newest(ceo_spells(spans), "ticker", "directorid", "validstart", ["_key"])
    current = snapshot(
        newest.select("ticker", "_key.directorid", "_key.rolename", "tenure", "founder", "is_co_ceo")
    )
    degrees = director_degrees(education, universities, current.select("directorid").distinct(), cutoff)
    own = keep_matching(spans, current.select("ticker", "directorid"), ["ticker", "directorid"])
    promoted = promotions(own).withColumn("internal_promotion", F.lit(True))
    return (
        current.join(promoted, ["ticker", "directorid", "rolename"], "left")
        .join(degrees, "directorid", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ["internal_promotion", *DEGREES]})
        .select(
            "ticker", "uniscoreavg", *DEGREES, "internal_promotion", "tenure", "founder",
            "is_co_ceo",
        )
    )


def committee_counts(committees: DataFrame, orgs: DataFrame, approximate=False) -> DataFrame:
    """Distinct committees and directors per ticker; firms without a ticker share the null one."""
    firms = orgs.select("boardid", "ticker").distinct()
    counts = {"num_committees": "committeename", "dirs": "directorid"}
    return distinct_counts(committees.join(firms, "boardid", "left"), ["ticker"], counts, approximate)


def attendance(directors: DataFrame, year: int = YEAR, exact: bool = False) -> DataFrame:
    """Attendance share and number of rows with a meeting date, per ticker.

    The share is an integer division: 1 when nobody missed too much, else 0.
    """
    missed = F.col("attend_less75_pct").eqNullSafe("Yes")
    return (
        directors.where(F.col("year") == year)
        .withColumn("attend", F.when(missed, 0).otherwise(1))
        .groupBy("ticker")
        .agg(
            integer_share("attend", exact).alias("over75_pct"),
            F.count("meetingdate").alias("num_meetings"),
        )
    )


def board_structure(
    companies: DataFrame,
    committees: DataFrame,
    orgs: DataFrame,
    directors: DataFrame,
    year: int = YEAR,
    exact: bool = False,
) -> DataFrame:
    counted = null_safe_left(companies, committee_counts(committees, orgs), ["ticker"])
    return null_safe_left(counted, attendance(directors, year, exact), ["ticker"]).withColumn(
        "avg_meetings", F.try_divide("num_meetings", "num_committees")
    )


def director_diversity(
    companies: DataFrame,
    directors: DataFrame,
    orgs: DataFrame,
    committees: DataFrame,
    year: int = YEAR,
    keep_zero: bool = False,
) -> DataFrame:
    """Share of women, diversity committee and Shannon index of ethnicity per company.

    Every distinct director row of a firm would meet every committee of the firm equally often,
    so shares are taken over the directors and the committees are only asked for a keyword. Committees
    without it are dropped before any shuffle, as a firm that meets none with it counts as false.
    """
    people = (
        directors.where((F.col("year") == year) & F.col("ticker").isNotNull())
        .select("ticker", "director_detail_id", "female", "ethnicity")
        .distinct()
    )
    shares = (
        people.groupBy("ticker", "ethnicity")
        .agg(
            F.count("*").alias("_n"), F.count_if(yes_no(F.col("female")) == "Yes").alias("_women")
        )
        .groupBy("ticker")
        .agg(
            (F.sum("_women") / F.sum("_n")).alias("female_pct"),
            shannon("ethnicity", "_n").alias("shannon"),
        )
        .where(F.col("shannon").isNotNull())
    )
    if not keep_zero:
        shares = shares.where("female_pct > 0")
    telling = committees.where(matches_ci(F.col("committeename"), DIVERSITY_PATTERN))
    named = any_true(telling, "boardid", F.lit(True), "_named")
    named = any_true(orgs.join(named, "boardid"), "ticker", F.col("_named"), "_named")
    diversity = shares.join(named, "ticker", "left").select(
        "ticker",
        "female_pct",
        F.coalesce(F.col("_named"), F.lit(False)).alias("diversity_board"),
        "shannon",
    )
    return null_safe_left(companies, diversity, ["ticker"])


def last_change(
    series: DataFrame,
    key: str,
    order: list[str],
    value: str,
    lag: int = 4,
    out: str = "change",
) -> DataFrame:
    """Per key the last known change of ``value`` against ``lag`` distinct rows earlier."""
    rows = nan_to_null(series.select(*dict.fromkeys([key, *order, value])))
    lagged = row_lag(rows.distinct(), key, order, value, lag, "_prev", count_from=series)
    changed = lagged.dropna(subset=["_prev"]).withColumn("_change", F.col(value) - F.col("_prev"))
    return last_non_null(changed, key, "_change", order, out)


def roa_change(ratios: DataFrame, lag: int = 4) -> DataFrame:
    """(ticker, roachange) as a number; rows are lagged, not calendar quarters."""
    return last_change(ratios, "ticker", ["qdate", "roa"], "roa", lag, "roachange")


def roa_change_class(changes: DataFrame) -> DataFrame:
    """(ticker, roachange) with the change as one of seven labels."""
    return changes.withColumn("roachange", label_bins(F.col("roachange")))


def wide_table(ceo: DataFrame, div: DataFrame, board: DataFrame, roa: DataFrame) -> DataFrame:
    """Companies present in all four tables; the index name comes from ``board``."""
    return (
        ceo.join(div.drop("spindex"), "ticker").join(board, "ticker").join(roa, "ticker")
    )
