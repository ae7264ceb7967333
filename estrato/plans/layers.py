"""Typed tables, star schema and serving view of the transfer-agreements domain.

Every function is DataFrame -> DataFrame; nothing here runs a job or writes a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions import date_sk, hash_key
from estrato.operators.modeling import Role, calendar, canonical_rows, conformed_roles, distinct_rows, star_view
from estrato.operators.skew import with_group_count
from estrato.operators.typing import project_typed
from estrato.plans import records as R
from estrato.plans.lazy import LazyTables

Tables = Mapping[str, DataFrame]


# ---- typed staging -------------------------------------------------------------------------------

def stage_proposta(raw: DataFrame) -> DataFrame:
    return project_typed(raw, R.PROPOSTA, last=R.LINEAGE)


def stage_programa(raw: DataFrame) -> DataFrame:
    key = hash_key(*R.ELIGIBILITY_KEY).alias("id_programa_elegibilidade")
    return project_typed(raw, R.PROGRAMA, first=[key], last=R.LINEAGE)


def stage_programa_proposta(raw: DataFrame) -> DataFrame:
    return project_typed(raw, R.PROGRAMA_PROPOSTA, last=R.LINEAGE)


def stage_convenio(raw: DataFrame) -> DataFrame:
    """Observations are counted on the raw agreement number, before it is cleaned.

    Rows are typed and hashed before they meet their counts, so that the join moves the columns in use and no raw text.
    """
    key = hash_key(*[f.source for f in R.CONVENIO]).alias("id_convenio_observacao")
    typed = project_typed(raw, R.CONVENIO, first=[key], last=[F.col("NR_CONVENIO").alias("__number"), *R.LINEAGE])
    counted = with_group_count(typed, ["__number"], "source_conflict_count")
    conflict = (F.col("source_conflict_count") > 1).alias("has_source_conflict")
    return counted.select(
        "id_convenio_observacao", *[f.name for f in R.CONVENIO], "source_conflict_count", conflict, *R.LINEAGE
    )


# ---- silver --------------------------------------------------------------------------------------

def silver_proposta(staged: DataFrame) -> DataFrame:
    return staged


def silver_programa_elegibilidade(staged: DataFrame) -> DataFrame:
    return staged


def silver_programa_cadastral(staged: DataFrame) -> DataFrame:
    """Distinct program attributes. Lineage is part of the tuple, so one snapshot has one row per program."""
    return distinct_rows(staged, [*R.PROGRAM_ATTRIBUTES, *R.LINEAGE])


def silver_programa_proposta(staged: DataFrame) -> DataFrame:
    return staged


def silver_convenio(staged: DataFrame) -> DataFrame:
    return staged


def silver_tables(raw: Tables) -> Tables:
    return LazyTables({
        "proposta": lambda: silver_proposta(stage_proposta(raw["proposta"])),
        "programa_elegibilidade": lambda: silver_programa_elegibilidade(stage_programa(raw["programa"])),
        "programa_cadastral": lambda: silver_programa_cadastral(stage_programa(raw["programa"])),
        "programa_proposta": lambda: silver_programa_proposta(stage_programa_proposta(raw["programa_proposta"])),
        "convenio": lambda: silver_convenio(stage_convenio(raw["convenio"])),
    })


# ---- gold ----------------------------------------------------------------------------------------

def dim_data(spark: SparkSession) -> DataFrame:
    return calendar(spark)


def dim_proponente(proposta: DataFrame) -> DataFrame:
    return distinct_rows(proposta, R.PROPONENT_COLUMNS)


def dim_municipio(proposta: DataFrame) -> DataFrame:
    return distinct_rows(
        proposta,
        [
            F.col("codigo_municipio_ibge"),
            F.col("municipio_proponente").alias("nome_municipio"),
            F.col("uf_proponente").alias("sigla_uf"),
        ],
    )


def dim_orgao(proposta: DataFrame, cadastral: DataFrame) -> DataFrame:
    superior = {"is_orgao_superior": True, "is_orgao_concedente": False}
    granting = {"is_orgao_superior": False, "is_orgao_concedente": True}
    return conformed_roles(
        [
            (proposta, "codigo_orgao_superior", "descricao_orgao_superior", superior),
            (proposta, "codigo_orgao", "descricao_orgao", granting),
            (cadastral, "codigo_orgao_superior_programa", "descricao_orgao_superior_programa", superior),
        ],
        "codigo_orgao",
        "descricao_orgao",
    )


def dim_programa(cadastral: DataFrame) -> DataFrame:
    return cadastral.select(
        "id_programa", "codigo_programa", "nome_programa", "situacao_programa", "ano_disponibilizacao",
        "codigo_orgao_superior_programa",
        date_sk("data_disponibilizacao").alias("data_disponibilizacao_sk"),
    )


def fct_proposta(proposta: DataFrame) -> DataFrame:
    return proposta.select(
        "id_proposta", "identificacao_proponente", "codigo_municipio_ibge", "codigo_orgao_superior",
        "codigo_orgao",
        date_sk("data_proposta").alias("data_proposta_sk"),
        date_sk("data_inicio_vigencia_proposta").alias("data_inicio_vigencia_proposta_sk"),
        date_sk("data_fim_vigencia_proposta").alias("data_fim_vigencia_proposta_sk"),
        "numero_proposta", "modalidade", "situacao_proposta", "objeto_proposta",
        "nome_subtipo_proposta", "descricao_subtipo_proposta",
        F.lit(1).cast("int").alias("quantidade_propostas"),
        *R.PROPOSTA_MONEY,
    )


def fct_convenio(convenio: DataFrame) -> DataFrame:
    return canonical_rows(convenio, R.CONVENIO_STABLE).select(
        "numero_convenio", "id_proposta",
        date_sk("data_assinatura_convenio").alias("data_assinatura_sk"),
        date_sk("data_publicacao_convenio").alias("data_publicacao_sk"),
        date_sk("data_inicio_vigencia_convenio").alias("data_inicio_vigencia_sk"),
        date_sk("data_fim_vigencia_convenio").alias("data_fim_vigencia_sk"),
        date_sk("data_limite_prestacao_contas").alias("data_limite_prestacao_contas_sk"),
        "situacao_convenio", "subsituacao_convenio", "situacao_publicacao", "situacao_contratacao",
        "is_instrumento_ativo", "is_opera_obtv", "is_assinado", "numero_processo",
        "unidade_gestora_emitente",
        F.lit(1).cast("int").alias("quantidade_convenios"),
        "quantidade_termos_aditivos", "quantidade_prorrogacoes",
        *R.CONVENIO_MONEY,
    )


def fct_convenio_saldo_observacao(convenio: DataFrame) -> DataFrame:
    return convenio.select(
        "id_convenio_observacao", "numero_convenio", "valor_saldo_conta",
        "source_conflict_count", "has_source_conflict", *R.LINEAGE,
    )


def bridge_programa_proposta(programa_proposta: DataFrame) -> DataFrame:
    return programa_proposta.select("id_programa", "id_proposta")


def gold_tables(spark: SparkSession, silver: Tables) -> Tables:
    return LazyTables({
        "dim_data": lambda: dim_data(spark),
        "dim_proponente": lambda: dim_proponente(silver["proposta"]),
        "dim_municipio": lambda: dim_municipio(silver["proposta"]),
        "dim_orgao": lambda: dim_orgao(silver["proposta"], silver["programa_cadastral"]),
        "dim_programa": lambda: dim_programa(silver["programa_cadastral"]),
        "fct_proposta": lambda: fct_proposta(silver["proposta"]),
        "fct_convenio": lambda: fct_convenio(silver["convenio"]),
        "fct_convenio_saldo_observacao": lambda: fct_convenio_saldo_observacao(silver["convenio"]),
        "bridge_programa_proposta": lambda: bridge_programa_proposta(silver["programa_proposta"]),
    })


# ---- semantic view -------------------------------------------------------------------------------

# The columns of the serving view, in order.
VIEW_COLUMNS = (
    "id_proposta", "numero_proposta", "data_proposta", "ano_proposta", "mes_proposta",
    "identificacao_proponente", "nome_proponente", "codigo_municipio_ibge", "municipio", "uf",
    "codigo_orgao_superior", "orgao_superior", "codigo_orgao_concedente", "orgao_concedente",
    "modalidade", "situacao_proposta",
    "valor_global_proposta", "valor_repasse_proposta", "valor_contrapartida_proposta",
    "tem_convenio", "numero_convenio", "data_assinatura", "ano_assinatura", "situacao_convenio",
    "is_instrumento_ativo", "valor_global_convenio", "valor_repasse_convenio",
    "valor_empenhado_convenio", "valor_desembolsado_convenio",
)


def proposta_convenio_view(
    gold: Tables, columns: Sequence[str] | None = None, proven: bool = False, hot: Mapping[str, Mapping] | None = None
) -> DataFrame:
    """Proposals with their dimensions and their 0..1 agreement; only the joins ``columns`` need are made.

    ``proven`` says that the gold gates passed on these tables: their keys are unique. Otherwise that is
    checked as the joins run. ``hot`` holds, by column of the fact, the keys that its write found to be hot and
    their numbers of sub-keys; joins on such a column are salted.
    """
    same = lambda *names: {n: n for n in names}
    fact_columns = {
        **same("id_proposta", "numero_proposta", "identificacao_proponente", "codigo_municipio_ibge",
               "codigo_orgao_superior", "modalidade", "situacao_proposta", *R.PROPOSTA_MONEY),
        "codigo_orgao_concedente": "codigo_orgao",
    }
    agreement = same(
        "numero_convenio", "situacao_convenio", "is_instrumento_ativo", "valor_global_convenio",
        "valor_repasse_convenio", "valor_empenhado_convenio", "valor_desembolsado_convenio",
    )
    # large tables first: what small ones add does not travel through their shuffles
    roles = [
        ("proponent", Role(lambda: gold["dim_proponente"], "identificacao_proponente", "identificacao_proponente",
                           same("nome_proponente"))),
        ("agreement", Role(lambda: gold["fct_convenio"], "id_proposta", "id_proposta", agreement,
                           carries=("data_assinatura_sk",))),
        ("town", Role(lambda: gold["dim_municipio"], "codigo_municipio_ibge", "codigo_municipio_ibge",
                      {"municipio": "nome_municipio", "uf": "sigla_uf"})),
        ("superior_body", Role(lambda: gold["dim_orgao"], "codigo_orgao_superior", "codigo_orgao",
                               {"orgao_superior": "descricao_orgao"})),
        ("granting_body", Role(lambda: gold["dim_orgao"], "codigo_orgao_concedente", "codigo_orgao",
                               {"orgao_concedente": "descricao_orgao"})),
        ("proposal_day", Role(lambda: gold["dim_data"], "data_proposta_sk", "data_sk",
                              {"data_proposta": "data", "ano_proposta": "ano", "mes_proposta": "mes"},
                              bounded=True)),
        ("signing_day", Role(lambda: gold["dim_data"], "data_assinatura_sk", "data_sk",
                             {"data_assinatura": "data", "ano_assinatura": "ano"}, bounded=True)),
    ]
    derived = {"tem_convenio": ("agreement", F.col("numero_convenio").isNotNull())}
    roles = [(name, replace(role, proven=proven)) for name, role in roles]
    known = {left: (hot or {}).get(fact_columns.get(left, left)) for _, role in roles for left in [role.left_key]}
    roles = [(name, replace(role, spread_by="id_proposta", hot=known[role.left_key]) if known[role.left_key] and not role.bounded else role) for name, role in roles]
    return star_view(gold["fct_proposta"], fact_columns, roles, VIEW_COLUMNS, columns, derived)
