"""Stage functions on a small warehouse, against a wide table computed by hand."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from boardlens import schemas
from boardlens.plans import governance as gov

AS_OF = "2024-01-01"
DAY = dt.date(2023, 4, 1)


@pytest.fixture(scope="module")
def warehouse(spark):
    tables = {
        "governance": (
            [("AAA", "S&P 500", 2023), ("BBB", "S&P 600", 2023), ("CCC", "S&P 400", 2023),
             (None, None, 2023), ("OLD", "S&P 500", 2022)],
            schemas.GOVERNANCE,
        ),
        "orgs": ([(1, "AAA"), (1, "AAA"), (2, "BBB"), (3, "CCC"), (4, None), (5, "OLD")],
                 schemas.ORGS),
        "roles": (
            [
                # AAA: an old chief executive, then Ann, who came up from finance.
                (1, 10, "Old", "CEO", "2001-01-01", "2014-12-31"),
                (1, 11, "Ann", "CFO", "2010-01-01", "2014-12-31"),
                (1, 11, "Ann", "CEO", "2015-01-01", "N"),
                (1, 11, "Ann", "CEO/President", "2012-01-01", None),
                (1, 12, "Reg", "Regional CEO", "2020-01-01", None),
                # BBB: two joint chief executives, one later sole one.
                (2, 21, "Bea", "Co-CEO", "2005-01-01", "2010-01-01"),
                (2, 20, "Bob", "Founder/Co-CEO", "2003-06-01", "2011-01-01"),
                (2, 22, "Cat", "CEO", "2019-01-01", None),
                # CCC: nobody but a director; firm 4 has no ticker.
                (3, 30, "Dan", "Director", "2019-01-01", None),
                (4, 40, "Eve", "CEO", "2019-01-01", None),
                (5, 50, "Fay", "CEO", "2019-01-01", None),
            ],
            schemas.ROLES,
        ),
        "education": (
            [
                (11, "Oxford, University of", "MBA"), (11, "Harvrd University", "MSc"),
                (11, "INSEAD", "PhD"), (11, "INSEAD", "PhD"), (20, None, "Diploma"),
                (10, "Harvard University", "BSc"),
            ],
            schemas.EDUCATION,
        ),
        "rankings": (
            [("1", "University of Oxford", "90"), ("2", "University of Oxford", "92-96"),
             ("3", "Harvard University", "98"), ("Reporter", "Harvard University", "1")],
            schemas.RANKINGS,
        ),
        "committees": (
            [(1, "Audit", 1), (1, "Audit", 2), (1, "Sustainability", 1), (2, "Audit", 3),
             (4, "Pay", 4), (4, "Audit", 4)],
            schemas.COMMITTEES,
        ),
        "directors": (
            [
                ("AAA", 2023.0, 1, "Yes", "x", "No", DAY), ("AAA", 2023.0, 2, "No", "y", None, DAY),
                ("AAA", 2023.0, 2, "No", "y", None, None), ("AAA", 2022.0, 3, "Yes", "z", "Yes", DAY),
                ("BBB", 2023.0, 4, "No", "x", "Yes", DAY), ("BBB", 2023.0, 5, "Yes", None, "No", DAY),
                ("CCC", 2023.0, 6, None, "x", "No", None), (None, 2023.0, 7, "Yes", "x", "No", DAY),
            ],
            schemas.DIRECTORS,
        ),
        "ratios": (
            [("AAA", dt.date(2022 + q // 4, 3 * (q % 4) + 1, 1), 0.01 * q) for q in range(6)]
            + [("BBB", dt.date(2022 + q // 4, 3 * (q % 4) + 1, 1), -0.05 * q) for q in range(5)],
            schemas.RATIOS,
        ),
    }
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in tables.items()}


@pytest.fixture(scope="module")
def stages(warehouse):
    w = warehouse
    companies = gov.companies(w["governance"])
    universities = gov.universities(w["rankings"])
    return {
        "ceo": gov.ceo_background(
            companies, w["roles"], w["orgs"], w["education"], universities, AS_OF
        ),
        "board": gov.board_structure(companies, w["committees"], w["orgs"], w["directors"]),
        "div": gov.director_diversity(companies, w["directors"], w["orgs"], w["committees"]),
        "roa": gov.roa_change_class(gov.roa_change(w["ratios"])),
    }


def by_ticker(df):
    return {r["ticker"]: r.asDict() for r in df.collect()}


def test_ceo_background(stages):
    assert stages["ceo"].columns == schemas.CEO.names
    got = by_ticker(stages["ceo"])
    assert set(got) == {"AAA", "BBB"}
    # Ann's two titles: she started last in 2015, her first title in key order is 'CEO'.
    assert got["AAA"] == {
        "ticker": "AAA", "uniscoreavg": pytest.approx(95.0), "bachelors": True, "masters": True,
        "mba": True, "phd": True, "internal_promotion": True, "tenure": 9, "founder": False,
        "is_co_ceo": False,
    }
    # Joint chief executives sort before Cat; Bob's row comes first in key order.
    assert got["BBB"] == {
        "ticker": "BBB", "uniscoreavg": None, "bachelors": False, "masters": True, "mba": False,
        "phd": False, "internal_promotion": False, "tenure": 8, "founder": True, "is_co_ceo": True,
    }


def test_board_structure(stages):
    assert stages["board"].columns == schemas.BOARD.names
    got = {t: tuple(r.values())[1:] for t, r in by_ticker(stages["board"]).items()}
    assert got == {
        "AAA": ("S&P 500", 2, 2, 1, 2, 1.0),
        "BBB": ("S&P 600", 1, 1, 0, 2, 2.0),
        "CCC": ("S&P 400", None, None, 1, 0, None),
        None: (None, 2, 1, 1, 1, 0.5),
    }


def test_director_diversity(stages):
    assert stages["div"].columns == schemas.DIVERSITY.names
    got = {t: tuple(r.values())[1:] for t, r in by_ticker(stages["div"]).items()}
    assert got == {
        "AAA": ("S&P 500", 0.5, True, pytest.approx(0.693147, abs=1e-6)),
        "BBB": ("S&P 600", 0.5, False, pytest.approx(0.346574, abs=1e-6)),
        "CCC": ("S&P 400", None, None, None),
        None: (None, None, None, None),
    }


def test_keep_zero(warehouse):
    w = warehouse
    df = gov.director_diversity(
        gov.companies(w["governance"]), w["directors"], w["orgs"], w["committees"], keep_zero=True
    )
    assert by_ticker(df)["CCC"]["female_pct"] == 0.0


def test_wide_table(stages):
    df = gov.wide_table(stages["ceo"], stages["div"], stages["board"], stages["roa"])
    assert df.columns == [
        *schemas.CEO.names, "female_pct", "diversity_board", "shannon",
        *schemas.BOARD.names[1:], "roachange",
    ]
    assert len(df.columns) == 20
    got = by_ticker(df)
    assert {t: r["roachange"] for t, r in got.items()} == {
        "AAA": "Moderate Increase", "BBB": "Significant Decrease",
    }


def test_no_row_pairs_in_the_plans(stages):
    for name in ("ceo", "div", "board"):
        plan = stages[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Cross" not in plan and "CartesianProduct" not in plan


def test_director_written_two_ways(spark, warehouse):
    """An earlier role counts however the name is written, for the latest start of the title."""
    roles = spark.createDataFrame(
        [(1, 9, "Ann B Lee", "CEO", "2005-01-01", None), (1, 9, "Ann Lee", "CFO", "2010-01-01", None),
         (1, 9, "Ann Lee", "CEO", "2012-01-01", None)],
        schemas.ROLES,
    )
    w = warehouse
    out = gov.ceo_background(
        gov.companies(w["governance"]), roles, w["orgs"], w["education"], gov.universities(w["rankings"]), AS_OF
    )
    assert by_ticker(out)["AAA"]["internal_promotion"] is True


def test_only_telling_roles_are_stored(spark):
    """Other titles are one group per director, and titles that tell nothing are dropped before the join."""
    roles = spark.createDataFrame(
        [(1, 9, "Ann", "CEO", "2012-01-01", "N"), (1, 9, "Ann", "Regional CEO", "2001-01-01", None),
         (1, 9, "Ann", None, "2000-01-01", None), (1, 9, "Ann", "CFO", "2010-01-01", None),
         (1, 9, "A. Lee", "Director", "2008-01-01", None), (1, 9, "Ann", "Chair", "no date", None),
         (1, 9, "Ann", "CEO", None, "2015-05-05"), (1, 9, None, "CEO", "2013-01-01", None)],
        schemas.ROLES,
    )
    orgs = spark.createDataFrame([(1, "AAA"), (1, "AAA")], schemas.ORGS)
    spans = gov.role_spans(gov.firm_roles(gov.telling_roles(roles, AS_OF), orgs))
    day = dt.date
    assert {tuple(r) for r in spans.collect()} == {
        ("AAA", 9, "Ann", "CEO", day(2012, 1, 1), day(2012, 1, 1), day(2024, 1, 1)),
        ("AAA", 9, None, "CEO", day(2013, 1, 1), day(2013, 1, 1), day(2024, 1, 1)),
        ("AAA", 9, None, "", day(2008, 1, 1), day(2010, 1, 1), None),
    }
    assert {tuple(r) for r in gov.promotions(spans).collect()} == {("AAA", 9, "CEO")}


def test_bad_start_of_a_chief_executive_fails(spark, warehouse):
    """Text that is no date fails for a listed firm's chief executive only."""
    w = warehouse

    def background(firm, title):
        roles = spark.createDataFrame([(firm, 9, "Ann", title, "soon", None)], schemas.ROLES)
        return gov.ceo_background(
            gov.companies(w["governance"]), roles, w["orgs"], w["education"], gov.universities(w["rankings"]), AS_OF
        ).collect()

    assert background(1, "Regional CEO") == background(1, "CFO") == background(5, "CEO") == []
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        background(1, "CEO")


def test_committees_without_a_keyword_are_not_shuffled(stages):
    """The keyword is asked before the committees are grouped."""
    plan = stages["div"]._jdf.queryExecution().optimizedPlan().toString()
    assert any("Filter" in line and "divers|incl|sustai" in line for line in plan.splitlines())


def test_nan_is_a_missing_ratio(spark):
    table = [("A", dt.date(2020 + q // 4, 3 * (q % 4) + 1, 1), float(q)) for q in range(6)]
    table += [("A", dt.date(2022, 1, 1), float("nan")), ("B", dt.date(2022, 1, 1), float("nan"))]
    out = gov.roa_change(spark.createDataFrame(table, schemas.RATIOS)).collect()
    assert [(r["ticker"], r["roachange"]) for r in out] == [("A", 4.0)]


def test_pipeline_reads_what_it_wrote(spark, warehouse, stages, tmp_path):
    from boardlens.plans import pipeline

    root = str(tmp_path)
    extra = {n: df.withColumn("more", F.lit(1)) for n, df in warehouse.items()}
    out = pipeline.stage_tables(extra, root, AS_OF)
    for name, direct in [("ceo_v0", stages["ceo"]), ("board_v0", stages["board"]), ("div_v0", stages["div"]), ("roa_v0", stages["roa"])]:
        stored = spark.read.parquet(f"{root}/{name}")
        assert stored.columns == direct.columns and set(stored.collect()) == set(direct.collect())
    full = out["full_v0"].withColumn("uniscoreavg", F.coalesce("uniscoreavg", F.lit(50.0)))
    final = pipeline.predict(full, root, "cnn_model_3")
    stored = spark.read.parquet(f"{root}/final")
    assert final.columns == [*[c for c in full.columns if c != "roachange"], "roapredicted"]
    assert {r["ticker"] for r in stored.collect()} == {"AAA", "BBB"}


def test_independent_stages_are_written_together(spark, warehouse, tmp_path):
    """Each of the four waits for the others, which would never come one after another."""
    from boardlens.plans import pipeline

    four, written = threading.Barrier(4), []

    def store(df, path):
        name = path.rpartition("/")[2]
        if name in ("ceo_v0", "board_v0", "div_v0", "roa_v0"):
            four.wait(60)
        written.append(name)
        return df

    out = pipeline.stage_tables(warehouse, str(tmp_path), AS_OF, store=store)
    assert set(by_ticker(out["full_v0"])) == {"AAA", "BBB"}
    assert written[0] == "companies" and written[-1] == "full_v0" and set(written) == set(out)


def test_together_ends_all_before_a_failure(spark):
    from boardlens.sources.tables import together

    failed, ended = threading.Event(), []

    def bad():
        failed.set()
        raise ValueError("bad")

    def good():
        assert failed.wait(60)
        ended.append(spark.range(3).count())
        return spark.range(3)

    with pytest.raises(ValueError, match="bad"):
        together(spark, bad, good)
    assert ended == [3]
    first, second = together(spark, lambda: spark.range(2), lambda: spark.range(4))
    assert (first.count(), second.count()) == (2, 4)
