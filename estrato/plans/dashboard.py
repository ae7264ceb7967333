"""Metrics, charts, filters and benchmark queries of the overview dashboard."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.operators.metrics import (
    Cube,
    Metric,
    cube,
    distinct_count,
    present_count,
    ratio,
    row_count,
    summarize,
    total,
)
from estrato.session import kept

PROPOSALS = row_count("propostas")
AGREEMENTS = present_count("convenios_formalizados", "numero_convenio")
PROPOSALS_DISTINCT = distinct_count("propostas", "id_proposta")
AGREEMENTS_DISTINCT = distinct_count("convenios_formalizados", "numero_convenio")
FORMALIZED_DISTINCT = distinct_count("propostas_conveniadas", "id_proposta", when="numero_convenio")
TRANSFERRED = total("valor_repasse_conveniado", "valor_repasse_convenio")

METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        PROPOSALS,
        AGREEMENTS,
        ratio("propostas_com_convenio_pct", AGREEMENTS, PROPOSALS),
        total("valor_global_proposto", "valor_global_proposta"),
        total("valor_global_conveniado", "valor_global_convenio"),
        total("valor_empenhado", "valor_empenhado_convenio"),
        total("valor_desembolsado", "valor_desembolsado_convenio"),
        ratio("percentual_empenhado", total("e", "valor_empenhado_convenio"), TRANSFERRED),
        ratio("percentual_desembolsado", total("d", "valor_desembolsado_convenio"), TRANSFERRED),
        ratio("ticket_medio_proposta", total("p", "valor_global_proposta"), PROPOSALS, 1.0, 2),
        ratio("ticket_medio_convenio", total("c", "valor_global_convenio"), AGREEMENTS, 1.0, 2),
    )
}
DISTINCT_METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        PROPOSALS_DISTINCT,
        AGREEMENTS_DISTINCT,
        ratio("propostas_com_convenio_pct", FORMALIZED_DISTINCT, PROPOSALS_DISTINCT),
    )
}


def metric(name: str, keys_proven: bool = True) -> Metric:
    """The cheap form of a metric where key uniqueness was proven in this build, else its distinct form."""
    if not keys_proven and name in DISTINCT_METRICS:
        return DISTINCT_METRICS[name]
    return METRICS[name]


# Selector columns of the dashboard, in order.
FILTER_COLUMNS = (
    "ano_proposta", "ano_assinatura", "uf", "municipio", "orgao_concedente",
    "modalidade", "situacao_proposta", "situacao_convenio",
)
DETAIL_COLUMNS = (
    "numero_proposta", "nome_proponente", "uf", "municipio", "orgao_concedente", "modalidade",
    "situacao_proposta", "numero_convenio", "situacao_convenio", "valor_global_proposta",
    "valor_global_convenio", "valor_empenhado_convenio", "valor_desembolsado_convenio",
)
# The five filter scenarios the dashboard is validated with.
SCENARIOS: dict[str, dict[str, Sequence]] = {
    "all": {},
    "uf": {"uf": ["MG"]},
    "year": {"ano_proposta": [2020]},
    "modality": {"modalidade": ["CONVENIO"]},
    "agreement_status": {"situacao_convenio": ["Em execução"]},
}


@dataclass(frozen=True)
class Chart:
    """A grouped chart. ``top_by_metric`` sorts by the metric descending (ties by name), else by the axis."""

    metric: str
    dim: str | None = None
    top_by_metric: bool = False
    limit: int | None = None
    columns: tuple[str, ...] = field(default=())

    def run(
        self, table: DataFrame, filters: Mapping[str, Sequence] | None = None, keys_proven: bool = True
    ) -> DataFrame:
        chosen = metric(self.metric, keys_proven)
        return summarize(table, [chosen], **self._question(), filters=filters)

    def answer(self, sums: Cube, filters: Mapping[str, Sequence] | None = None) -> DataFrame:
        """The same from stored sums; the table is not read."""
        return sums.answer([METRICS[self.metric]], **self._question(), filters=filters)

    def _question(self) -> dict:
        if self.dim is None:
            return {}
        order: list[Column] = [F.desc(self.metric)] if self.top_by_metric else []
        return {"dims": [self.dim], "not_null": [self.dim], "order": [*order, F.asc(self.dim)], "limit": self.limit}


CHARTS: dict[str, Chart] = {
    "kpi_proposals": Chart("propostas"),
    "kpi_agreements": Chart("convenios_formalizados"),
    "kpi_formalized_share": Chart("propostas_com_convenio_pct"),
    "kpi_proposed_value": Chart("valor_global_proposto"),
    "kpi_agreed_value": Chart("valor_global_conveniado"),
    "kpi_committed_value": Chart("valor_empenhado"),
    "kpi_disbursed_value": Chart("valor_desembolsado"),
    "proposals_by_year": Chart("propostas", "ano_proposta", limit=100),
    "agreements_by_year": Chart("convenios_formalizados", "ano_assinatura", limit=100),
    "proposals_by_uf": Chart("propostas", "uf", top_by_metric=True, limit=30),
    "agreements_by_body": Chart("convenios_formalizados", "orgao_concedente", top_by_metric=True, limit=10),
}

# The six benchmark questions are charts without the chart row limits, except the top ten bodies.
BENCHMARK: dict[str, Chart] = {
    "q1_proposals": Chart("propostas"),
    "q2_agreements": Chart("convenios_formalizados"),
    "q3_proposals_by_year": Chart("propostas", "ano_proposta"),
    "q4_agreements_by_year": Chart("convenios_formalizados", "ano_assinatura"),
    "q5_proposals_by_uf": Chart("propostas", "uf", top_by_metric=True),
    "q6_agreements_by_body": Chart("convenios_formalizados", "orgao_concedente", top_by_metric=True, limit=10),
}


def chart_cube(table: DataFrame, charts: Mapping[str, Chart] | None = None, filters: Sequence[str] = ()) -> Cube:
    """The sums that the charts need, alone and with each of the filters, from one scan of the serving table."""
    charts = CHARTS if charts is None else charts
    dims = dict.fromkeys((c.dim,) if c.dim else () for c in charts.values())
    groupings = dict.fromkeys([*(tuple(d) for d in dims), *(tuple(dict.fromkeys((*d, f))) for d in dims for f in filters)])
    chosen = [METRICS[m] for m in dict.fromkeys(c.metric for c in charts.values())]
    return cube(table, list(groupings), chosen)


def chart_columns(chart: Chart, keys_proven: bool = True, filters: Mapping[str, Sequence] | None = None) -> list[str]:
    """Columns a chart reads: what the star view has to provide and nothing else."""
    columns = set(metric(chart.metric, keys_proven).columns) | set(filters or {})
    if chart.dim:
        columns.add(chart.dim)
    return sorted(columns) or ["id_proposta"]


def detail_table(
    table: DataFrame, filters: Mapping[str, Sequence] | None = None, limit: int = 1000
) -> DataFrame:
    """The detail listing. Sorted by every shown column so that the page is the same on each run."""
    from estrato.operators.metrics import where_any

    condition = where_any(filters)
    rows = table if condition is None else table.filter(condition)
    return rows.select(*DETAIL_COLUMNS).orderBy(*[F.asc_nulls_last(c) for c in DETAIL_COLUMNS]).limit(limit)


def detail_tables(
    table: DataFrame, filters: Mapping[str, Mapping[str, Sequence]], limit: int = 1000
) -> dict[str, DataFrame]:
    """The detail listing under several choices of filters, by name: the columns in use are worked out and stored once."""
    used = dict.fromkeys([*DETAIL_COLUMNS, *(c for chosen in filters.values() for c in chosen)])
    rows = kept(table.select(*used), "detail")
    return {name: detail_table(rows, chosen, limit) for name, chosen in filters.items()}


def top_rows(table: DataFrame, by: str, key: str, limit: int = 15) -> DataFrame:
    """Rows with the largest measure; ties broken by the key."""
    return table.orderBy(F.desc_nulls_last(by), F.asc(key)).limit(limit)


Questions = dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]


def questions(view: Callable[[Sequence[str]], DataFrame]) -> Questions:
    """The eight priority questions that are safe, as queries over the star schema.

    The two others (money per program, balance history) have no legitimate sum and are not offered.
    """
    m = METRICS

    def ask(names: Sequence[str], dims: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
        chosen = [m[n] for n in names]
        needed = {c for x in chosen for c in x.columns} | set(dims)
        return summarize(view(sorted(needed) or ["id_proposta"]), chosen, dims, not_null=not_null)

    return {
        "proposals_per_year": lambda g: ask(["propostas"], ["ano_proposta"], ["ano_proposta"]),
        "proposed_value_per_uf": lambda g: ask(["valor_global_proposto"], ["uf"]),
        "formalized_proposals": lambda g: ask(["propostas", "convenios_formalizados"], []),
        "agreed_value_per_signing_year": lambda g: ask(
            ["valor_global_conveniado"], ["ano_assinatura"], ["ano_assinatura"]
        ),
        "committed_and_disbursed_per_ministry": lambda g: ask(
            ["valor_empenhado", "valor_desembolsado"], ["orgao_superior"]
        ),
        "agreed_value_per_town": lambda g: ask(["valor_global_conveniado"], ["municipio", "uf"]),
        "agreements_per_status": lambda g: g["fct_convenio"].groupBy("situacao_convenio").agg(
            F.count("*").alias("convenios")
        ),
        "proposals_per_program": lambda g: g["bridge_programa_proposta"].groupBy("id_programa").agg(
            F.count_distinct("id_proposta").alias("propostas_vinculadas")
        ),
    }
