"""Sections of the transfer-agreements profile, each a DataFrame over the layers' tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.functions import exact_sum, money_from_text
from estrato.operators import profiling as P
from estrato.operators import quality as Q
from estrato.operators import relational as J
from estrato.plans import records as R

Tables = Mapping[str, DataFrame]


def column_profiles(raw: Tables) -> DataFrame:
    """NULLs, blanks, lengths and distinct values of every raw column but the lineage."""
    return J.named_rows({t: P.column_profile(raw[t], [c for c in raw[t].columns if c not in R.LINEAGE]) for t in raw}, "table_name")


def _chained_links(raw: Tables) -> DataFrame:
    """Program rules reached from a proposal, counted through its links."""
    rules = raw["programa"].groupBy("ID_PROGRAMA").agg(F.count("*").alias("n_rows"))
    return J.link_multiplicity(raw["programa_proposta"], "ID_PROPOSTA", weights=rules, weight_key="ID_PROGRAMA")


def financial_steps(raw: Tables, column: str = "VL_GLOBAL_CONV") -> DataFrame:
    """Agreement money alone, through the program links, and through the program rules: (step, n_rows, total)."""
    value = money_from_text(column)
    links = J.link_multiplicity(raw["programa_proposta"], "ID_PROPOSTA")
    return J.named_rows({
        "base": J.plain_totals(raw["convenio"], value),
        "after_links": J.multiplied_totals(raw["convenio"], "ID_PROPOSTA", value, links),
        "after_programs": J.multiplied_totals(raw["convenio"], "ID_PROPOSTA", value, _chained_links(raw)),
    }, "step")


def join_fan_out(raw: Tables) -> DataFrame:
    """Rows after each successive inner join agreement -> proposal -> link -> program rule: (step, n_rows)."""
    one = F.lit(1)
    proposals = J.link_multiplicity(raw["proposta"], "ID_PROPOSTA")
    kept = raw["convenio"].join(raw["proposta"].select("ID_PROPOSTA").distinct(), "ID_PROPOSTA", "left_semi")
    links = J.link_multiplicity(raw["programa_proposta"], "ID_PROPOSTA")
    return J.named_rows({
        "agreements": J.plain_totals(raw["convenio"], one),
        "with_proposals": J.multiplied_totals(raw["convenio"], "ID_PROPOSTA", one, proposals),
        "with_links": J.multiplied_totals(kept, "ID_PROPOSTA", one, links),
        "with_programs": J.multiplied_totals(kept, "ID_PROPOSTA", one, _chained_links(raw)),
    }, "step").select("step", "n_rows")


def base_measures(silver: Tables) -> DataFrame:
    """Counts and money of the snapshot, long form: (item, value)."""
    canonical = silver["convenio"].select("numero_convenio", *R.CONVENIO_MONEY).distinct()
    return Q.stack([
        Q.measures(silver["proposta"], {"propostas": F.count("*"), **{c: exact_sum(c) for c in R.PROPOSTA_MONEY}}),
        Q.measures(canonical, {"convenios": F.count("*"), **{c: exact_sum(c) for c in R.CONVENIO_MONEY}}),
        Q.measures(silver["convenio"], {"propostas_conveniadas": F.count_distinct("id_proposta")}),
    ])


def program_associations(gold: Tables) -> DataFrame:
    """Per program its proposals and their agreements.

    Links are brought to distinct pairs and agreements to one count per proposal before they meet. An
    agreement belongs to one proposal, so the counts of a program's proposals add up.
    """
    pairs = gold["bridge_programa_proposta"].select("id_programa", "id_proposta").distinct()
    agreements = gold["fct_convenio"].select("id_proposta", "numero_convenio").distinct().groupBy("id_proposta").agg(F.count("numero_convenio").alias("n"))
    return pairs.join(agreements, "id_proposta", "left").groupBy("id_programa").agg(
        F.count("id_proposta").alias("propostas"), F.coalesce(F.sum("n"), F.lit(0)).alias("convenios"))


def quality_indicators(silver: Tables, gold: Tables) -> DataFrame:
    """Known weak points of the data as numbers: (indicator, n, value)."""
    none = F.lit(None).cast("decimal(38,2)").alias("value")
    unlinked = J.unlinked_rows(gold["fct_proposta"], "id_proposta", gold["bridge_programa_proposta"], "id_proposta")
    return J.named_rows({
        "conflicting_agreements": silver["convenio"].filter("has_source_conflict").agg(F.count_distinct("numero_convenio").alias("n"), none),
        "proposals_without_program": unlinked.agg(F.count("*").alias("n"), exact_sum("valor_global_proposta").alias("value")),
        "dates_outside_window": gold["fct_proposta"].agg(F.count_if(F.col("data_fim_vigencia_proposta_sk") == -2).alias("n"), none),
    }, "indicator")
