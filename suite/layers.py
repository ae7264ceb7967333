"""The twenty domain models, each over the whole given tables.

The mappings below hold plans, not data: every query still reads the given tables from the start.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from estrato.plans import layers as L
from suite.raw_tables import BUILDERS, raw_tables
from suite.registry import Registry


@functools.cache
def raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return raw_tables(spark, sf_dir)


@functools.cache
def silver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return L.silver_tables(raw(spark, sf_dir))


@functools.cache
def gold(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return L.gold_tables(spark, silver(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return L.proposta_convenio_view(gold(spark, sf_dir), columns)


def register(reg: Registry) -> None:
    for name in BUILDERS:
        reg.add(f"raw_{name}", lambda s, d, n=name: BUILDERS[n](s, d), f"SELECT * FROM raw_{name}")
    for name, stage in {
        "proposta": L.stage_proposta,
        "programa_proposta": L.stage_programa_proposta,
        "convenio": L.stage_convenio,
    }.items():
        reg.add(
            f"staged_{name}",
            lambda s, d, n=name, f=stage: f(BUILDERS[n](s, d)),
            f"SELECT * FROM silver_{name}",
        )
    reg.add(
        "staged_programa",
        lambda s, d: L.stage_programa(BUILDERS["programa"](s, d)),
        "SELECT * FROM silver_programa_elegibilidade",
    )
    for name in ("proposta", "programa_elegibilidade", "programa_cadastral", "programa_proposta", "convenio"):
        reg.add(f"silver_{name}", lambda s, d, n=name: silver(s, d)[n], f"SELECT * FROM silver_{name}")
    for name in (
        "dim_data", "dim_proponente", "dim_municipio", "dim_orgao", "dim_programa", "fct_proposta",
        "fct_convenio", "fct_convenio_saldo_observacao", "bridge_programa_proposta",
    ):
        if name == "dim_data":
            continue  # its rows depend on the calendar window alone; used through the fact below
        reg.add(f"gold_{name}", lambda s, d, n=name: gold(s, d)[n], f"SELECT * FROM {name}")
    reg.add(
        "gold_calendar_days_of_proposals",
        lambda s, d: (lambda g: g["fct_proposta"].select("id_proposta", "data_proposta_sk").join(
            g["dim_data"], g["fct_proposta"]["data_proposta_sk"] == g["dim_data"]["data_sk"], "left"
        ).drop("data_proposta_sk"))(gold(s, d)),
        """SELECT id_proposta, dd.* FROM fct_proposta LEFT JOIN dim_data dd ON data_proposta_sk = data_sk""",
    )
    reg.add("semantic_view", mart, "SELECT * FROM mart")
    reg.add("serving_mart_copy", lambda s, d: mart(s, d).select("*"), "SELECT * FROM mart")
