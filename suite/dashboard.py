"""Dashboard metrics, charts, filters and the three benchmark variants."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.operators.metrics import count_equivalence, filter_values, present_count, row_count, summarize
from estrato.operators import relational as J
from estrato.plans import dashboard as B
from estrato.session import shared_folder
from estrato.sources.snapshots import materialize
from suite.layers import gold, mart
from suite.registry import Registry

METRIC_SQL = {
    "propostas": "count(*)",
    "convenios_formalizados": "count(numero_convenio)",
    "propostas_com_convenio_pct": "round(CAST(count(numero_convenio) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) * 100.0, 6)",
    "valor_global_proposto": "CAST(sum(valor_global_proposta) AS DECIMAL(38,2))",
    "valor_global_conveniado": "CAST(sum(valor_global_convenio) AS DECIMAL(38,2))",
    "valor_empenhado": "CAST(sum(valor_empenhado_convenio) AS DECIMAL(38,2))",
    "valor_desembolsado": "CAST(sum(valor_desembolsado_convenio) AS DECIMAL(38,2))",
    "percentual_empenhado": "round(CAST(sum(valor_empenhado_convenio) AS DOUBLE) / nullif(CAST(sum(valor_repasse_convenio) AS DOUBLE), 0) * 100.0, 6)",
    "percentual_desembolsado": "round(CAST(sum(valor_desembolsado_convenio) AS DOUBLE) / nullif(CAST(sum(valor_repasse_convenio) AS DOUBLE), 0) * 100.0, 6)",
    "ticket_medio_proposta": "round(CAST(sum(valor_global_proposta) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2)",
    "ticket_medio_convenio": "round(CAST(sum(valor_global_convenio) AS DOUBLE) / nullif(CAST(count(numero_convenio) AS DOUBLE), 0), 2)",
}
DISTINCT_SQL = {
    "propostas": "count(DISTINCT id_proposta)",
    "convenios_formalizados": "count(DISTINCT numero_convenio)",
}


def chart_sql(chart: B.Chart, where: str = "", metric_sql: dict[str, str] = METRIC_SQL) -> str:
    expression = f"{metric_sql[chart.metric]} AS {chart.metric}"
    if chart.dim is None:
        return f"SELECT {expression} FROM mart {('WHERE ' + where) if where else ''}"
    conditions = " AND ".join(c for c in (where, f"{chart.dim} IS NOT NULL") if c)
    order = f"{chart.metric} DESC, {chart.dim}" if chart.top_by_metric else chart.dim
    limit = f" LIMIT {chart.limit}" if chart.limit else ""
    return (
        f"SELECT {chart.dim}, {expression} FROM mart WHERE {conditions} "
        f"GROUP BY {chart.dim} ORDER BY {order}{limit}"
    )


def register(reg: Registry) -> None:
    reg.add(
        "proposals_and_agreements_by_year",
        lambda s, d: summarize(
            mart(s, d, ["ano_proposta", "numero_convenio"]),
            [B.METRICS["propostas"], B.METRICS["convenios_formalizados"]],
            ["ano_proposta"],
            not_null=["ano_proposta"],
            order=[F.asc("ano_proposta")],
        ),
        f"""SELECT ano_proposta, {METRIC_SQL['propostas']} AS propostas,
        {METRIC_SQL['convenios_formalizados']} AS convenios_formalizados
        FROM mart WHERE ano_proposta IS NOT NULL GROUP BY ano_proposta""",
    )
    # every metric at once: overall, by UF, and with a selector
    all_sql = ", ".join(f"{sql} AS {name}" for name, sql in METRIC_SQL.items())
    metrics = list(B.METRICS.values())
    reg.add("metrics_overall", lambda s, d: summarize(mart(s, d), metrics), f"SELECT {all_sql} FROM mart")
    reg.add(
        "metrics_by_uf", lambda s, d: summarize(mart(s, d), metrics, ["uf"]),
        f"SELECT uf, {all_sql} FROM mart GROUP BY uf",
    )
    reg.add(
        "metrics_by_modality_and_status",
        lambda s, d: summarize(mart(s, d), metrics, ["modalidade", "situacao_convenio"]),
        f"SELECT modalidade, situacao_convenio, {all_sql} FROM mart GROUP BY ALL",
    )
    reg.add(
        "metrics_distinct_form",
        lambda s, d: summarize(
            mart(s, d, ["uf", "id_proposta", "numero_convenio"]), list(B.DISTINCT_METRICS.values()), ["uf"]
        ),
        """SELECT uf, count(DISTINCT id_proposta) AS propostas, count(DISTINCT numero_convenio) AS convenios_formalizados,
        round(CAST(count(DISTINCT CASE WHEN numero_convenio IS NOT NULL THEN id_proposta END) AS DOUBLE)
         / CAST(count(DISTINCT id_proposta) AS DOUBLE) * 100.0, 6) AS propostas_com_convenio_pct
        FROM mart GROUP BY uf""",
    )
    for name, chart in B.CHARTS.items():
        reg.add(
            f"chart_{name}",
            lambda s, d, c=chart: c.run(mart(s, d, B.chart_columns(c))),
            chart_sql(chart),
        )
    detail = ", ".join(B.DETAIL_COLUMNS)
    reg.add(
        "chart_detail_table",
        lambda s, d: B.detail_table(mart(s, d, B.DETAIL_COLUMNS)),
        f"SELECT {detail} FROM mart ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in B.DETAIL_COLUMNS)} LIMIT 1000",
    )
    reg.add(
        "top_proposals_by_value",
        lambda s, d: B.top_rows(
            mart(s, d, ["id_proposta", "numero_proposta", "uf", "valor_global_proposta"]),
            "valor_global_proposta", "id_proposta",
        ),
        """SELECT id_proposta, numero_proposta, uf, valor_global_proposta FROM mart
        ORDER BY valor_global_proposta DESC NULLS LAST, id_proposta LIMIT 15""",
    )
    # the five validation scenarios over all charts' metrics
    where = {
        "all": "", "uf": "uf IN ('MG')", "year": "ano_proposta IN (1998)", "modality": "modalidade IN ('CONVENIO')",
        "agreement_status": "situacao_convenio IN ('Em execução')",
    }
    scenarios = {**B.SCENARIOS, "year": {"ano_proposta": [1998]}}  # the given orders end in 2001
    for name, filters in scenarios.items():
        reg.add(
            f"scenario_{name}",
            lambda s, d, f=filters: summarize(mart(s, d), metrics, ["uf", "ano_proposta"], f),
            f"SELECT uf, ano_proposta, {all_sql} FROM mart {('WHERE ' + where[name]) if where[name] else ''} GROUP BY ALL",
        )
    many = {
        "ano_proposta": [1996, 1997, 1999], "uf": ["MG", "SP"], "municipio": [], "modalidade": ["CONVENIO", "TERMO DE FOMENTO"],
        "situacao_proposta": ["Plano de Trabalho Aprovado"], "situacao_convenio": ["Em execução", "Cancelado"],
    }
    many_sql = """ano_proposta IN (1996, 1997, 1999) AND uf IN ('MG', 'SP') AND modalidade IN ('CONVENIO', 'TERMO DE FOMENTO')
     AND situacao_proposta IN ('Plano de Trabalho Aprovado') AND situacao_convenio IN ('Em execução', 'Cancelado')"""
    reg.add(
        "filters_many_columns",
        lambda s, d: summarize(mart(s, d), metrics, ["orgao_concedente"], many),
        f"SELECT orgao_concedente, {all_sql} FROM mart WHERE {many_sql} GROUP BY ALL",
    )
    for name, chart in B.CHARTS.items():
        if chart.dim is None:
            continue
        reg.add(
            f"filtered_chart_{name}",
            lambda s, d, c=chart: c.run(mart(s, d), {"uf": ["RJ", "BA"], "modalidade": ["CONVENIO"]}),
            chart_sql(chart, "uf IN ('RJ', 'BA') AND modalidade IN ('CONVENIO')"),
        )
    # every selector over every chart; values that the derived tables hold
    chosen = {
        "ano_proposta": [1997, 1998], "ano_assinatura": [1999], "uf": ["RJ", "BA"], "municipio": ["NATION_7", "NATION_2"],
        "orgao_concedente": ["ORGAO 30001", "ORGAO 30005"], "modalidade": ["CONVENIO", "TERMO DE FOMENTO"],
        "situacao_proposta": ["Rejeitada"], "situacao_convenio": ["Em execução"],
    }
    def filtered(s, d, chart):
        """One scan makes the sums by axis and each selector; every selector is answered from them."""
        sums = B.chart_cube(mart(s, d, sorted({*B.chart_columns(chart), *chosen})), {"one": chart}, list(chosen))
        return reduce(DataFrame.unionByName, [chart.answer(sums, {f: v}).select(F.lit(f).alias("filter_name"), "*") for f, v in chosen.items()])

    def filter_sql(f: str) -> str:
        return f"{f} IN (" + ", ".join(repr(x) for x in chosen[f]) + ")"

    for name, chart in B.CHARTS.items():
        reg.add(f"all_filters_on_{name}", lambda s, d, c=chart: filtered(s, d, c),
                " UNION ALL ".join(f"SELECT '{f}' AS filter_name, * FROM ({chart_sql(chart, filter_sql(f))})" for f in chosen))
    shown = sorted({*B.DETAIL_COLUMNS, *B.FILTER_COLUMNS})
    reg.add("all_filters_on_detail_table",
            lambda s, d: J.named_rows(B.detail_tables(mart(s, d, shown), {f: {f: v} for f, v in chosen.items()}), "filter_name"),
            " UNION ALL ".join(f"SELECT '{f}' AS filter_name, * FROM (SELECT {detail} FROM mart WHERE {filter_sql(f)} ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in B.DETAIL_COLUMNS)} LIMIT 1000)" for f in chosen))

    def all_charts(s, d):
        """Every chart out of one set of sums: (chart, axis, value)."""
        sums = B.chart_cube(mart(s, d))
        return reduce(DataFrame.unionByName, [
            c.answer(sums).select(F.lit(n).alias("chart"), (F.col(c.dim).cast("string") if c.dim else F.lit(None).cast("string")).alias("axis"), F.col(c.metric).cast("double").alias("value"))
            for n, c in B.CHARTS.items()])

    reg.add("charts_from_one_aggregate", all_charts, " UNION ALL ".join(
        f"SELECT '{n}' AS chart, {f'CAST({c.dim} AS VARCHAR)' if c.dim else 'CAST(NULL AS VARCHAR)'} AS axis, CAST({c.metric} AS DOUBLE) AS value FROM ({chart_sql(c)})" for n, c in B.CHARTS.items()))
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM mart "
        f"WHERE {c} IS NOT NULL GROUP BY ALL" for c in B.FILTER_COLUMNS
    )
    reg.add("filter_selector_values", lambda s, d: filter_values(mart(s, d, B.FILTER_COLUMNS), B.FILTER_COLUMNS), values)

    # benchmark: whole view with distinct counts, pruned view with plain counts
    for name, chart in B.BENCHMARK.items():
        reg.add(
            f"benchmark_{name}_view_distinct",
            lambda s, d, c=chart: c.run(mart(s, d), keys_proven=False),
            chart_sql(chart, "", {**METRIC_SQL, **DISTINCT_SQL}),
        )
        reg.add(
            f"benchmark_{name}_view_plain",
            lambda s, d, c=chart: c.run(mart(s, d, B.chart_columns(c))),
            chart_sql(chart),
        )
        reg.add(  # the serving table, written by year and state, as the build writes it
            f"benchmark_{name}_mart_written",
            lambda s, d, c=chart: c.run(materialize(s, mart(s, d), f"{shared_folder(s)}/mart-{uuid.uuid4().hex}", cluster=("ano_proposta", "uf"))),
            chart_sql(chart),
        )
    ask_sql = {
        "proposals_per_year": "SELECT ano_proposta, count(*) AS propostas FROM mart WHERE ano_proposta IS NOT NULL GROUP BY ALL",
        "proposed_value_per_uf": f"SELECT uf, {METRIC_SQL['valor_global_proposto']} AS valor_global_proposto FROM mart GROUP BY ALL",
        "formalized_proposals": "SELECT count(*) AS propostas, count(numero_convenio) AS convenios_formalizados FROM mart",
        "agreed_value_per_signing_year": f"SELECT ano_assinatura, {METRIC_SQL['valor_global_conveniado']} AS valor_global_conveniado FROM mart WHERE ano_assinatura IS NOT NULL GROUP BY ALL",
        "committed_and_disbursed_per_ministry": f"SELECT orgao_superior, {METRIC_SQL['valor_empenhado']} AS valor_empenhado, {METRIC_SQL['valor_desembolsado']} AS valor_desembolsado FROM mart GROUP BY ALL",
        "agreed_value_per_town": f"SELECT municipio, uf, {METRIC_SQL['valor_global_conveniado']} AS valor_global_conveniado FROM mart GROUP BY ALL",
        "agreements_per_status": "SELECT situacao_convenio, count(*) AS convenios FROM fct_convenio GROUP BY ALL",
        "proposals_per_program": "SELECT id_programa, count(DISTINCT id_proposta) AS propostas_vinculadas FROM bridge_programa_proposta GROUP BY ALL",
    }
    for name, sql in ask_sql.items():
        def ask(s, d, n=name):
            from estrato.plans.layers import proposta_convenio_view

            g = gold(s, d)
            return B.questions(lambda columns: proposta_convenio_view(g, columns))[n](g)

        reg.add(f"question_{name}", ask, sql)

    # plain counts may stand in for distinct counts only where no group differs
    dims = ["ano_proposta", "ano_assinatura", "uf", "orgao_concedente"]
    for name, key, counted, sql in (
        ("proposals", "id_proposta", row_count("n"), "count(*)"),
        ("agreements", "numero_convenio", present_count("n", "numero_convenio"), "count(numero_convenio)"),
    ):
        parts = " UNION ALL ".join(
            f"SELECT '{x}' AS dimension, count(*) AS n_groups, count(*) FILTER (WHERE a <> b) AS n_different FROM "
            f"(SELECT {x}, {sql} AS a, count(DISTINCT {key}) AS b FROM mart GROUP BY {x})" for x in dims
        )
        reg.add(
            f"count_equivalence_{name}",
            lambda s, d, k=key, m=counted: count_equivalence(
                mart(s, d, [*dims, "id_proposta", "numero_convenio"]), dims, k, m
            ),
            parts,
        )
    reg.add(
        "formalized_share_equivalence",
        lambda s, d: summarize(
            mart(s, d, ["modalidade", "id_proposta", "numero_convenio"]),
            [B.METRICS["propostas_com_convenio_pct"],
             B.Metric("distinct_pct", B.DISTINCT_METRICS["propostas_com_convenio_pct"].build)],
            ["modalidade"], not_null=["modalidade"],
        ).withColumn("same", F.abs(F.col("distinct_pct") - F.col("propostas_com_convenio_pct")) <= 1e-5),
        f"""SELECT *, abs(distinct_pct - propostas_com_convenio_pct) <= 1e-5 AS same FROM (
        SELECT modalidade, {METRIC_SQL['propostas_com_convenio_pct']} AS propostas_com_convenio_pct,
        round(CAST(count(DISTINCT CASE WHEN numero_convenio IS NOT NULL THEN id_proposta END) AS DOUBLE)
         / CAST(count(DISTINCT id_proposta) AS DOUBLE) * 100.0, 6) AS distinct_pct
        FROM mart WHERE modalidade IS NOT NULL GROUP BY modalidade)""",
    )
