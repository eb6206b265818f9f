"""From source tables to predictions, each stage written below one shared root and read by the next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boardlens import schemas
from boardlens.operators.models import Size, registry
from boardlens.operators.rows import nan_to_null
from boardlens.plans import governance as gov
from boardlens.plans.experiments import BINARY, NUMERIC, prepare_features, score_all
from boardlens.sources.tables import snapshot, together

SOURCES = {
    "governance": schemas.GOVERNANCE,
    "committees": schemas.COMMITTEES,
    "orgs": schemas.ORGS,
    "directors": schemas.DIRECTORS,
    "roles": schemas.ROLES,
    "education": schemas.EDUCATION,
    "ratios": schemas.RATIOS,
    "rankings": schemas.RANKINGS,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, by name and with its types; NaN becomes null."""
    return nan_to_null(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]))


def stage_tables(
    sources: dict[str, DataFrame],
    root: str,
    as_of: dt.date | str,
    year: int = gov.YEAR,
    store: Callable[[DataFrame, str], DataFrame] = snapshot,
) -> dict[str, DataFrame]:
    """Writes companies, universities, ceo_v0, board_v0, div_v0, roa_v0 and full_v0 below ``root``.

    The four tables that full_v0 joins are independent and written at the same time. A failed run leaves
    the stages that it did not reach. Stages are plain folders; with ``store=write_stage`` jobs that read
    the version before can finish, and ``read_stage`` reads them.
    """
    t = {name: conform(sources[name], schema) for name, schema in SOURCES.items()}
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        out[name] = store(df, f"{root.rstrip('/')}/{name}")
        return out[name]

    def ceo() -> DataFrame:
        universities = keep("universities", gov.universities(t["rankings"]))
        background = gov.ceo_background(out["companies"], t["roles"], t["orgs"], t["education"], universities, as_of)
        return keep("ceo_v0", background)

    def board() -> DataFrame:
        return keep("board_v0", gov.board_structure(out["companies"], t["committees"], t["orgs"], t["directors"], year))

    def div() -> DataFrame:
        return keep("div_v0", gov.director_diversity(out["companies"], t["directors"], t["orgs"], t["committees"], year))

    def roa() -> DataFrame:
        return keep("roa_v0", gov.roa_change_class(gov.roa_change(t["ratios"])))

    companies = keep("companies", gov.companies(t["governance"], year))
    together(companies.sparkSession, ceo, board, div, roa)
    keep("full_v0", gov.wide_table(out["ceo_v0"], out["div_v0"], out["board_v0"], out["roa_v0"]))
    return out


def predict(full: DataFrame, root: str, model: str = "cnn_model_4") -> DataFrame:
    """Writes ``final`` below ``root``: complete companies with the predicted label of ``model``."""
    prepared = prepare_features(full)
    size = Size(features=len(NUMERIC) + len(BINARY), classes=len(prepared.labels.labels))
    final, _ = score_all(prepared, registry(size)[model])
    return snapshot(final, f"{root.rstrip('/')}/final")
