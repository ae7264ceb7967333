"""Contracts and reconciliation gates of the domain."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions import money_as_written
from estrato.functions.numbers import SUM_TYPE
from estrato.operators import profiling as P
from estrato.operators import quality as Q
from estrato.operators import relational as J
from estrato.operators.quality import Contract
from estrato.operators.typing import Field
from estrato.plans import records as R
from estrato.session import kept

Tables = Mapping[str, DataFrame]

SILVER_CONTRACTS: dict[str, Contract] = {
    "proposta": Contract(
        not_null=("id_proposta", "uf_proponente", "valor_global_proposta", "valor_repasse_proposta", "enviada_mandataria"),
        unique=("id_proposta",),
        accepted={"uf_proponente": R.UF_CODES, "enviada_mandataria": R.MANDATARIA_VALUES},
    ),
    "programa_cadastral": Contract(
        not_null=("id_programa", "codigo_programa", "nome_programa"), unique=("id_programa",)
    ),
    "programa_elegibilidade": Contract(
        not_null=("id_programa_elegibilidade", "id_programa"),
        unique=("id_programa_elegibilidade",),
        composite_unique=(R.ELIGIBILITY_SUPERKEY,),
        references=(("id_programa", "programa_cadastral", "id_programa"),),
    ),
    "programa_proposta": Contract(
        not_null=("id_programa", "id_proposta"),
        composite_unique=(("id_programa", "id_proposta"),),
        references=(("id_programa", "programa_cadastral", "id_programa"),),
    ),
    "convenio": Contract(
        not_null=("id_convenio_observacao", "numero_convenio", "id_proposta", "is_instrumento_ativo",
                  "is_opera_obtv", "is_assinado", "is_foto"),
        unique=("id_convenio_observacao",),
        accepted={c: (True, False) for c in ("is_instrumento_ativo", "is_opera_obtv", "is_assinado", "is_foto")},
        references=(("id_proposta", "proposta", "id_proposta"),),
    ),
}

PROPOSAL_DATES = {
    "data_proposta_sk": "data_proposta",
    "data_inicio_vigencia_proposta_sk": "data_inicio_vigencia_proposta",
    "data_fim_vigencia_proposta_sk": "data_fim_vigencia_proposta",
}
AGREEMENT_DATES = {
    "data_assinatura_sk": "data_assinatura_convenio",
    "data_publicacao_sk": "data_publicacao_convenio",
    "data_inicio_vigencia_sk": "data_inicio_vigencia_convenio",
    "data_fim_vigencia_sk": "data_fim_vigencia_convenio",
    "data_limite_prestacao_contas_sk": "data_limite_prestacao_contas",
}
PROGRAM_DATES = {"data_disponibilizacao_sk": "data_disponibilizacao"}


def _calendar(columns) -> tuple[tuple[str, str, str], ...]:
    return tuple((c, "dim_data", "data_sk") for c in columns)


GOLD_CONTRACTS: dict[str, Contract] = {
    "dim_data": Contract(not_null=("data_sk",), unique=("data_sk",)),
    "dim_proponente": Contract(not_null=("identificacao_proponente",), unique=("identificacao_proponente",)),
    "dim_municipio": Contract(not_null=("codigo_municipio_ibge",), unique=("codigo_municipio_ibge",)),
    "dim_orgao": Contract(not_null=("codigo_orgao", "descricao_orgao"), unique=("codigo_orgao",)),
    "dim_programa": Contract(
        not_null=("id_programa",), unique=("id_programa",),
        references=(("codigo_orgao_superior_programa", "dim_orgao", "codigo_orgao"), *_calendar(PROGRAM_DATES)),
    ),
    "fct_proposta": Contract(
        not_null=("id_proposta", "identificacao_proponente", "codigo_municipio_ibge", "codigo_orgao_superior",
                  "codigo_orgao", *PROPOSAL_DATES, "quantidade_propostas", *R.PROPOSTA_MONEY),
        unique=("id_proposta",),
        references=(
            ("identificacao_proponente", "dim_proponente", "identificacao_proponente"),
            ("codigo_municipio_ibge", "dim_municipio", "codigo_municipio_ibge"),
            ("codigo_orgao_superior", "dim_orgao", "codigo_orgao"),
            ("codigo_orgao", "dim_orgao", "codigo_orgao"),
            *_calendar(PROPOSAL_DATES),
        ),
    ),
    "bridge_programa_proposta": Contract(
        not_null=("id_programa", "id_proposta"),
        composite_unique=(("id_programa", "id_proposta"),),
        references=(("id_programa", "dim_programa", "id_programa"),),
    ),
    "fct_convenio": Contract(
        not_null=("numero_convenio", "id_proposta", *AGREEMENT_DATES, "quantidade_convenios",
                  "valor_global_convenio", "valor_repasse_convenio", "valor_contrapartida_convenio"),
        unique=("numero_convenio", "id_proposta"),
        references=(("id_proposta", "fct_proposta", "id_proposta"), *_calendar(AGREEMENT_DATES)),
    ),
    "fct_convenio_saldo_observacao": Contract(
        not_null=("id_convenio_observacao", "numero_convenio"),
        unique=("id_convenio_observacao",),
        references=(("numero_convenio", "fct_convenio", "numero_convenio"),),
    ),
}
VIEW_CONTRACT = Contract(
    not_null=("id_proposta", "tem_convenio"), unique=("id_proposta",), accepted={"tem_convenio": (True, False)}
)

BODY_ROLES = (
    ("superior_proposta", "proposta", "codigo_orgao_superior", "descricao_orgao_superior"),
    ("concedente_proposta", "proposta", "codigo_orgao", "descricao_orgao"),
    ("superior_programa", "programa_cadastral", "codigo_orgao_superior_programa", "descricao_orgao_superior_programa"),
)
BODY_PAIRS = (
    ("superior_proposta", "concedente_proposta"),
    ("superior_proposta", "superior_programa"),
    ("concedente_proposta", "superior_programa"),
)


def body_conflicts(silver: Tables) -> DataFrame:
    roles = {n: (silver[t], code, label) for n, t, code, label in BODY_ROLES}
    return J.label_conflicts(roles, BODY_PAIRS)


def unexpected_orphans(links: DataFrame, proposals: DataFrame, known: Sequence[int]) -> DataFrame:
    return J.without(J.orphan_keys(links, "id_proposta", proposals, "id_proposta"), "id_proposta", known)


# ---- raw -> silver gates -----------------------------------------------------------------------------

RAW_MONEY = {
    "convenio": {
        "VL_GLOBAL_CONV": "valor_global_convenio", "VL_REPASSE_CONV": "valor_repasse_convenio",
        "VL_CONTRAPARTIDA_CONV": "valor_contrapartida_convenio", "VL_EMPENHADO_CONV": "valor_empenhado_convenio",
        "VL_DESEMBOLSADO_CONV": "valor_desembolsado_convenio",
    },
    "proposta": {
        "VL_GLOBAL_PROP": "valor_global_proposta", "VL_REPASSE_PROP": "valor_repasse_proposta",
        "VL_CONTRAPARTIDA_PROP": "valor_contrapartida_proposta",
    },
}


def raw_row_counts(raw: Tables, silver: Tables) -> DataFrame:
    gate = "row_counts"
    same = Q.row_parity(gate, {
        "proposta": (raw["proposta"], silver["proposta"]),
        "programa_proposta": (raw["programa_proposta"], silver["programa_proposta"]),
        "programa_elegibilidade": (raw["programa"], silver["programa_elegibilidade"]),
        "convenio": (raw["convenio"], silver["convenio"]),
    })
    return same.unionByName(
        Q.key_parity(gate, "programa_cadastral", raw["programa"], "ID_PROGRAMA", silver["programa_cadastral"])
    )


def key_gate(gate: str, found: DataFrame, keys: Sequence[tuple[str, str]], pairs: Mapping[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
    """Per key: rows equal distinct values, and its repeated rows and NULLs apart; repeated pairs by name."""
    expected = Q.counted(found, {f"{t}.{k}": (t, "distinct", k) for t, k in keys})
    actual = Q.counted(found, {f"{t}.{k}": (t, "rows", "*") for t, k in keys})
    none = Q.counted(found, {
        **{f"{t}.{k} repeated rows": (t, "repeated_rows", k) for t, k in keys}, **{f"{t}.{k} NULLs": (t, "nulls", k) for t, k in keys},
        **{item: (t, "unique", "+".join(columns)) for item, (t, columns) in pairs.items()}})
    return Q.compare(gate, expected, actual).unionByName(Q.must_be(gate, none))


def parts_of(contracts: Mapping[str, Contract], keys: bool = False, references: bool = False) -> dict[str, Contract]:
    """Only the keys or only the references (but those to the calendar) of contracts, for a gate that runs alone."""
    return {t: Contract(unique=c.unique if keys else (), composite_unique=c.composite_unique if keys else (),
                        references=tuple(r for r in c.references if references and r[1] != "dim_data")) for t, c in contracts.items()}


SILVER_KEYS = {"proposta": "id_proposta", "programa_cadastral": "id_programa",
               "programa_elegibilidade": "id_programa_elegibilidade", "convenio": "id_convenio_observacao"}


def silver_key_uniqueness(silver: Tables, found: DataFrame | None = None) -> DataFrame:
    """``found`` is the layer's census, where it has been taken."""
    found = Q.census(silver, parts_of(SILVER_CONTRACTS, keys=True)) if found is None else found
    return key_gate("key_uniqueness", found, list(SILVER_KEYS.items()), {
        "programa_proposta.pair": ("programa_proposta", ("id_programa", "id_proposta")),
        "programa_elegibilidade.superkey": ("programa_elegibilidade", tuple(R.ELIGIBILITY_SUPERKEY))})


def conflict_reconciliation(raw: Tables, silver: Tables) -> DataFrame:
    gate = "agreement_conflicts"
    from_raw = P.conflict_census(raw["convenio"], "NR_CONVENIO")
    stored = P.flagged_census(silver["convenio"], "numero_convenio", "source_conflict_count", "has_source_conflict")
    one = lambda c: F.max(c)  # noqa: E731  both censuses have one row
    expected = Q.measures(from_raw, {
        "distinct_keys": one("distinct_keys"), "conflict_keys": one("conflict_keys"),
        "conflict_rows": one("conflict_rows"), "flagged_rows": one("conflict_rows"),
        "clean_rows": one("clean_rows"), "inconsistent_rows": F.lit(0).cast("bigint") * F.count("*"),
    })
    names = ["distinct_keys", "conflict_keys", "conflict_rows", "flagged_rows", "clean_rows", "inconsistent_rows"]
    return Q.compare(gate, expected, Q.measures(stored, {n: one(n) for n in names}))


def conflict_listing(silver: Tables) -> DataFrame:
    return silver["convenio"].filter("has_source_conflict").select(
        "numero_convenio", "id_convenio_observacao", "valor_saldo_conta", "source_conflict_count"
    )


def silver_references(raw: Tables, silver: Tables, known: Sequence[int] = R.KNOWN_ORPHAN_PROPOSALS, found: DataFrame | None = None) -> DataFrame:
    """A NULL key has no parent either, so it is counted with the orphans of its relation."""
    gate = "references"
    found = Q.census(silver, parts_of(SILVER_CONTRACTS, references=True)) if found is None else found
    relations = [(c, k, p) for c, contract in SILVER_CONTRACTS.items() for k, p, _ in contract.references]
    orphans = Q.stack([
        Q.counted(found, {f"{c}->{p}": (c, "references", f"{k}->{p}.{k}") for c, k, p in relations}),
        Q.counted(found, {f"{c}->{p}": (c, "nulls", k) for c, k, p in relations}),
    ]).groupBy("item").agg(F.when(F.count("*") == F.count("value"), F.sum("value")).cast(SUM_TYPE).alias("value"))
    unexpected = Q.measures(
        unexpected_orphans(silver["programa_proposta"], silver["proposta"], known),
        {"programa_proposta->proposta unexpected": F.count("*")},
    )
    item = "proposta without programa"
    unlinked = Q.compare(
        gate,
        Q.measures(J.unlinked_rows(raw["proposta"], "ID_PROPOSTA", raw["programa_proposta"], "ID_PROPOSTA"),
                   {item: F.count("*")}),
        Q.measures(J.unlinked_rows(silver["proposta"], "id_proposta", silver["programa_proposta"], "id_proposta"),
                   {item: F.count("*")}),
    )
    return Q.must_be(gate, Q.stack([orphans, unexpected])).unionByName(unlinked)


def orphan_set_equality(silver: Tables, known: Sequence[int], spark: SparkSession) -> DataFrame:
    """Orphan proposals against a known list, both ways: (id_proposta, side). Empty when equal."""
    found = kept(J.orphan_keys(silver["programa_proposta"], "id_proposta", silver["proposta"], "id_proposta"), "orphans")
    listed = spark.createDataFrame([(k,) for k in known], "id_proposta bigint")
    extra = found.join(listed, "id_proposta", "left_anti").select("id_proposta", F.lit("unexpected").alias("side"))
    gone = listed.join(found, "id_proposta", "left_anti").select("id_proposta", F.lit("missing").alias("side"))
    return extra.unionByName(gone)


def orphan_set_gate(silver: Tables, known: Sequence[int], spark: SparkSession) -> DataFrame:
    """Orphan proposals are exactly the known ones: none more, none gone."""
    sides = orphan_set_equality(silver, known, spark)
    return Q.must_be("orphan_set", Q.measures(sides, {s: F.count_if(F.col("side") == s) for s in ("unexpected", "missing")}))


def raw_money(raw: Tables, silver: Tables) -> DataFrame:
    gate = "money"
    # the raw side has its own reading of the text: with the parser under test a lost amount is lost twice
    expected = [Q.money_measures(raw[t], {s: money_as_written(r) for r, s in cols.items()}) for t, cols in RAW_MONEY.items()]
    actual = [Q.money_measures(silver[t], {s: s for s in cols.values()}) for t, cols in RAW_MONEY.items()]
    return Q.compare(gate, Q.stack(expected), Q.stack(actual))


def lineage_completeness(silver: Tables) -> DataFrame:
    gate = "lineage"
    parts = [
        Q.measures(silver[t], {f"{t}.{c}": F.count_if(F.col(c).isNull()) for c in R.LINEAGE}) for t in silver
    ]
    return Q.must_be(gate, Q.stack(parts))


def parse_losses(raw: Tables) -> DataFrame:
    """Raw text that is present but typed to NULL, for every typed column of every raw table."""
    from estrato.operators.typing import parse_loss

    layouts: dict[str, Sequence[Field]] = {
        "proposta": R.PROPOSTA, "programa": R.PROGRAMA, "programa_proposta": R.PROGRAMA_PROPOSTA, "convenio": R.CONVENIO,
    }
    return J.named_rows({t: parse_loss(raw[t], layout) for t, layout in layouts.items()}, "table_name")


def parse_losses_gate(raw: Tables, allowed: Mapping[str, float] | None = None) -> DataFrame:
    """Raw text that no typed value stands for, per column, against the declared share of rows (0 if not declared).

    ``allowed`` maps "table.column" to a share from 0 to 1. expected is the number of rows allowed.
    """
    shares = F.create_map(*[F.lit(x) for pair in (allowed or {"": 0.0}).items() for x in (pair[0], float(pair[1]))])
    item = F.concat_ws(".", "table_name", "column_name")
    most = F.floor(F.coalesce(F.try_element_at(shares, item), F.lit(0.0)) * F.col("total_rows")).cast(SUM_TYPE)
    rows = parse_losses(raw).select(item.alias("item"), most.alias("expected"), F.col("lost_rows").cast(SUM_TYPE).alias("actual"))
    diff = (F.col("actual") - F.col("expected")).cast(SUM_TYPE)
    return rows.select(F.lit("parse_losses").alias("gate"), "item", "expected", "actual", diff.alias("diff"),
                       F.when(F.col("actual") <= F.col("expected"), Q.PASS).otherwise(Q.FAIL).alias("status"))


def contracts_gate(tables: Tables, contracts: Mapping[str, Contract], label: str, found: DataFrame | None = None) -> DataFrame:
    """The declared contracts of a layer as gate rows: violations per rule, none allowed."""
    found = Q.census(tables, contracts) if found is None else found
    return Q.must_be(f"{label}_contracts", Q.contract_rows(found, contracts).select(
        F.concat(F.col("table_name"), F.lit(" "), F.col("rule"), F.lit(" "), F.col("target")).alias("item"),
        F.col("violations").cast(SUM_TYPE).alias("value")))


def taken_once(tables: Tables, contracts: Mapping[str, Contract]) -> Callable[[], DataFrame]:
    """A layer's census as a small stored table, made when the first gate asks for it; gates run side by side."""
    lock, held = threading.Lock(), []

    def found() -> DataFrame:
        with lock:
            if not held:
                held.append(kept(Q.census(tables, contracts).coalesce(1), "census"))
            return held[0]

    return found


def raw_to_silver_gates(
    raw: Tables, silver: Tables, known=R.KNOWN_ORPHAN_PROPOSALS, allowed_losses: Mapping[str, float] | None = None
) -> dict[str, Callable[[], DataFrame]]:
    found = taken_once(silver, SILVER_CONTRACTS)
    return {
        "row_counts": lambda: raw_row_counts(raw, silver),
        "key_uniqueness": lambda: silver_key_uniqueness(silver, found()),
        "agreement_conflicts": lambda: conflict_reconciliation(raw, silver),
        "references": lambda: silver_references(raw, silver, known, found()),
        "money": lambda: raw_money(raw, silver),
        "parse_losses": lambda: parse_losses_gate(raw, allowed_losses),
        "lineage": lambda: lineage_completeness(silver),
        "silver_contracts": lambda: contracts_gate(silver, SILVER_CONTRACTS, "silver", found()),
    }


# ---- silver -> gold gates ----------------------------------------------------------------------------

def gold_row_counts(silver: Tables, gold: Tables, calendar_rows: int = 22282) -> DataFrame:
    gate = "gold_row_counts"
    s, g = silver, gold
    same = Q.row_parity(gate, {
        "dim_programa": (s["programa_cadastral"], g["dim_programa"]),
        "fct_proposta": (s["proposta"], g["fct_proposta"]),
        "bridge_programa_proposta": (s["programa_proposta"], g["bridge_programa_proposta"]),
        "fct_convenio_saldo_observacao": (s["convenio"], g["fct_convenio_saldo_observacao"]),
    })
    body_codes = Q.stack([s[t].select(F.col(code).alias("code")) for _, t, code, _ in BODY_ROLES])
    distinct = Q.stack([
        Q.measures(s["proposta"], {"dim_proponente": F.count_distinct("identificacao_proponente"),
                                   "dim_municipio": F.count_distinct("codigo_municipio_ibge")}),
        Q.measures(body_codes, {"dim_orgao": F.count_distinct("code")}),
        Q.measures(s["convenio"].select(*R.CONVENIO_STABLE).distinct(), {"fct_convenio": F.count("*")}),
    ])
    rows = Q.stack([Q.measures(g[t], {t: F.count("*")}) for t in ("dim_proponente", "dim_municipio", "dim_orgao", "fct_convenio")])
    calendar = Q.must_be(gate, Q.measures(g["dim_data"], {"dim_data": F.count("*")}), calendar_rows)
    return Q.stack([same, Q.compare(gate, distinct, rows), calendar])


GOLD_KEYS = {
    "dim_data": "data_sk", "dim_proponente": "identificacao_proponente", "dim_municipio": "codigo_municipio_ibge",
    "dim_orgao": "codigo_orgao", "dim_programa": "id_programa", "fct_proposta": "id_proposta",
    "fct_convenio": "numero_convenio", "fct_convenio_saldo_observacao": "id_convenio_observacao",
}


def gold_primary_keys(gold: Tables, found: DataFrame | None = None) -> DataFrame:
    """Per key four numbers: rows, distinct values, rows of repeated values, NULLs. ``found`` is the layer's census."""
    found = Q.census(gold, parts_of(GOLD_CONTRACTS, keys=True)) if found is None else found
    return key_gate("primary_keys", found, [*GOLD_KEYS.items(), ("fct_convenio", "id_proposta")],
                    {"bridge_programa_proposta.pair": ("bridge_programa_proposta", ("id_programa", "id_proposta"))})


def gold_references(gold: Tables, known: Sequence[int] = R.KNOWN_ORPHAN_PROPOSALS, found: DataFrame | None = None) -> DataFrame:
    gate = "gold_references"
    found = Q.census(gold, parts_of(GOLD_CONTRACTS, references=True)) if found is None else found
    orphans = Q.counted(found, {
        f"{t}.{c}->{o}": (t, "references", f"{c}->{o}.{oc}") for t, contract in GOLD_CONTRACTS.items() for c, o, oc in contract.references if o != "dim_data"})
    unexpected = Q.measures(
        unexpected_orphans(gold["bridge_programa_proposta"], gold["fct_proposta"], known),
        {"bridge_programa_proposta->fct_proposta unexpected": F.count("*")},
    )
    return Q.must_be(gate, orphans.unionByName(unexpected))


def calendar_keys(gold: Tables) -> DataFrame:
    """Per date key of the star: rows, orphans and sentinel rows."""
    audits = {
        t: J.sentinel_key_audit(gold[t], list(cols), gold["dim_data"], "data_sk")
        for t, cols in (("dim_programa", PROGRAM_DATES), ("fct_proposta", PROPOSAL_DATES), ("fct_convenio", AGREEMENT_DATES))
    }
    return J.named_rows(audits, "table_name")


def date_keys_gate(gold: Tables) -> DataFrame:
    gate = "date_keys"
    structure = Q.calendar_structure(gold["dim_data"])
    one = lambda c: F.max(c)
    days = lambda c: F.datediff(F.max(c), F.lit("1990-01-01").cast("date"))
    actual = Q.measures(structure, {
        "rows": one("total_rows"), "missing": one("missing_rows"), "outside": one("outside_rows"),
        "days": one("civil_days"), "distinct_days": one("distinct_days"),
        "first_day_offset": days("first_day"), "last_day_offset": days("last_day"),
    })
    # 1990-01-01..2050-12-31 is 22,280 days, plus two sentinels.
    wanted = {"rows": 22282, "missing": 1, "outside": 1, "days": 22280, "distinct_days": 22280,
              "first_day_offset": 0, "last_day_offset": 22279}
    expected = gold["dim_data"].sparkSession.createDataFrame(list(wanted.items()), "item string, value bigint").select(
        "item", F.col("value").cast(SUM_TYPE).alias("value"))
    orphans = calendar_keys(gold).select(
        F.concat_ws(".", "table_name", "column_name").alias("item"), F.col("orphan_rows").cast(SUM_TYPE).alias("value"))
    return Q.compare(gate, expected, actual).unionByName(Q.must_be(gate, orphans))


def _keys(mapping: Mapping[str, str]) -> dict[str, Column]:
    """The key rule written out again, apart from the function under test: its text and its bounds."""
    # First and last civil day of the calendar, sentinels for none and for outside.
    def key(day: str) -> Column:
        text = F.date_format(day, "yyyyMMdd")
        inside = (F.col(day) >= F.lit("1990-01-01").cast("date")) & (F.col(day) <= F.lit("2050-12-31").cast("date"))
        return F.when(F.col(day).isNull(), -1).when(inside, text.try_cast("int")).otherwise(-2).cast("int")

    return {target: key(source) for target, source in mapping.items()}


def date_mapping(silver: Tables, gold: Tables) -> DataFrame:
    """Date keys recomputed from silver and compared row by row, one join per table."""
    return J.named_rows({
        "dim_programa": J.mapping_audit(silver["programa_cadastral"], gold["dim_programa"], "id_programa", _keys(PROGRAM_DATES)),
        "fct_proposta": J.mapping_audit(silver["proposta"], gold["fct_proposta"], "id_proposta", _keys(PROPOSAL_DATES)),
        "fct_convenio": J.mapping_audit(silver["convenio"], gold["fct_convenio"], "numero_convenio", _keys(AGREEMENT_DATES)),
    }, "table_name")


def date_mapping_gate(silver: Tables, gold: Tables) -> DataFrame:
    return Q.must_be("date_mapping", date_mapping(silver, gold).select(
        F.concat_ws(".", "table_name", "column_name").alias("item"), F.col("n_different").cast(SUM_TYPE).alias("value")))


def body_conformance_gate(silver: Tables) -> DataFrame:
    conflicts = body_conflicts(silver)
    return Q.must_be("body_conformance", Q.measures(conflicts, {
        f"{a}_vs_{b}": F.coalesce(F.sum(F.when(F.col("pair") == f"{a}_vs_{b}", F.col("n_conflicts"))), F.lit(0))
        for a, b in BODY_PAIRS
    }))


def canonical_stability_gate(silver: Tables) -> DataFrame:
    unstable = Q.unstable_keys(silver["convenio"], "numero_convenio", R.CONVENIO_STABLE)
    return Q.must_be("canonical_stability", Q.measures(unstable, {"unstable agreements": F.count("*")}))


def proposal_money_gate(silver: Tables, target: DataFrame, gate: str = "proposal_money") -> DataFrame:
    columns = {c: c for c in R.PROPOSTA_MONEY}
    return Q.compare(gate, Q.money_measures(silver["proposta"], columns), Q.money_measures(target, columns))


def agreement_money_gate(silver: Tables, gold: Tables) -> DataFrame:
    columns = {c: c for c in R.CONVENIO_MONEY}
    canonical = silver["convenio"].select("numero_convenio", *R.CONVENIO_MONEY).distinct()
    return Q.compare("agreement_money", Q.money_measures(canonical, columns), Q.money_measures(gold["fct_convenio"], columns))


def balance_gate(silver: Tables, gold: Tables) -> DataFrame:
    def items(df: DataFrame) -> DataFrame:
        from estrato.functions import exact_sum

        return Q.measures(df, {
            "rows": F.count("*"), "distinct_ids": F.count_distinct("id_convenio_observacao"),
            "balance_checksum": exact_sum("valor_saldo_conta"),
            "conflict_rows": F.count_if(F.col("has_source_conflict")),
        })

    target = gold["fct_convenio_saldo_observacao"]
    own = Q.rows_equal_keys("balance_observations", target, {"rows = distinct ids": "id_convenio_observacao"})
    return Q.compare("balance_observations", items(silver["convenio"]), items(target)).unionByName(own)


def bridge_columns_gate(gold: Tables) -> DataFrame:
    bridge = gold["bridge_programa_proposta"]
    found = Q.forbidden_columns(bridge, R.BRIDGE_FORBIDDEN)
    rows = bridge.sparkSession.createDataFrame([("forbidden columns", len(found))], "item string, value bigint")
    return Q.must_be("bridge_columns", rows.select("item", F.col("value").cast(SUM_TYPE).alias("value")))


def location_gate(spark: SparkSession, schema: str, expected: str) -> DataFrame:
    from estrato.sources.catalog import schema_location, same_location

    equal = same_location(schema_location(spark, schema), expected)
    rows = spark.createDataFrame([(f"{schema} location differs", 0 if equal else 1)], "item string, value bigint")
    return Q.must_be("schema_location", rows.select("item", F.col("value").cast(SUM_TYPE).alias("value")))


def silver_to_gold_gates(silver: Tables, gold: Tables, known=R.KNOWN_ORPHAN_PROPOSALS) -> dict[str, Callable[[], DataFrame]]:
    found = taken_once(gold, GOLD_CONTRACTS)
    return {
        "gold_row_counts": lambda: gold_row_counts(silver, gold),
        "primary_keys": lambda: gold_primary_keys(gold, found()),
        "gold_references": lambda: gold_references(gold, known, found()),
        "date_keys": lambda: date_keys_gate(gold),
        "date_mapping": lambda: date_mapping_gate(silver, gold),
        "body_conformance": lambda: body_conformance_gate(silver),
        "canonical_stability": lambda: canonical_stability_gate(silver),
        "proposal_money": lambda: proposal_money_gate(silver, gold["fct_proposta"]),
        "agreement_money": lambda: agreement_money_gate(silver, gold),
        "balance_observations": lambda: balance_gate(silver, gold),
        "bridge_columns": lambda: bridge_columns_gate(gold),
        "gold_contracts": lambda: contracts_gate(gold, GOLD_CONTRACTS, "gold", found()),
    }


def view_gates(gold: Tables, view: DataFrame, label: str) -> dict[str, Callable[[], DataFrame]]:
    """Serving table against the facts: rows, distinct agreements, money, presence flag."""
    def counts() -> DataFrame:
        facts = Q.stack([
            Q.measures(gold["fct_proposta"], {"rows": F.count("*")}),
            Q.measures(gold["fct_convenio"], {"agreements": F.count("*"), "distinct agreements": F.count("*")}),
        ])
        return Q.compare(f"{label}_counts", facts, Q.measures(view, {
            "rows": F.count("*"), "agreements": F.count("numero_convenio"),
            "distinct agreements": F.count_distinct("numero_convenio"),
        }))

    def money() -> DataFrame:
        shown = ("valor_global_convenio", "valor_repasse_convenio", "valor_empenhado_convenio", "valor_desembolsado_convenio")
        facts = Q.stack([
            Q.money_measures(gold["fct_proposta"], {c: c for c in R.PROPOSTA_MONEY}),
            Q.money_measures(gold["fct_convenio"], {c: c for c in shown}),
        ])
        return Q.compare(f"{label}_money", facts, Q.money_measures(view, {c: c for c in (*R.PROPOSTA_MONEY, *shown)}))

    def presence() -> DataFrame:
        odd = Q.inconsistent_presence(view, "tem_convenio", "numero_convenio")
        return Q.must_be(f"{label}_presence", Q.measures(odd, {"inconsistent rows": F.count("*")}))

    return {f"{label}_counts": counts, f"{label}_money": money, f"{label}_presence": presence}


# Totals of the published snapshot, for the optional baseline mode.
BASELINE = {
    "row_counts": {
        "proposta": "1157619",
        "programa_proposta": "1158975",
        "programa_elegibilidade": "1257350",
        "programa_cadastral": "53018",
        "convenio": "287586",
    },
    "agreement_conflicts": {
        "distinct_keys": "287584",
        "conflict_keys": "2",
        "conflict_rows": "4",
        "clean_rows": "287582",
    },
    "references": {
        "proposta without programa": "78",
    },
    "money": {
        "valor_global_convenio": "356856636504.87",
        "valor_repasse_convenio": "331287339337.88",
        "valor_contrapartida_convenio": "23710083216.75",
        "valor_empenhado_convenio": "192071916388.96",
        "valor_desembolsado_convenio": "153212385725.46",
        "valor_global_proposta": "1495209875334.42",
        "valor_repasse_proposta": "1425758135735.63",
        "valor_contrapartida_proposta": "69451779598.79",
    },
    "gold_row_counts": {
        "dim_data": "22282",
        "dim_proponente": "29325",
        "dim_municipio": "5570",
        "dim_orgao": "184",
        "dim_programa": "53018",
        "fct_proposta": "1157619",
        "bridge_programa_proposta": "1158975",
        "fct_convenio": "287584",
        "fct_convenio_saldo_observacao": "287586",
    },
    "proposal_money": {
        "valor_global_proposta": "1495209875334.42",
        "valor_repasse_proposta": "1425758135735.63",
        "valor_contrapartida_proposta": "69451779598.79",
    },
    "agreement_money": {
        "valor_global_convenio": "356840744533.16",
        "valor_repasse_convenio": "331271766468.34",
        "valor_contrapartida_convenio": "23709764114.58",
        "valor_empenhado_convenio": "192064543060.79",
        "valor_desembolsado_convenio": "153205012397.29",
    },
    "balance_observations": {
        "balance_checksum": "18079072724.97",
    },
}


def published_baseline(spark: SparkSession) -> DataFrame:
    rows = [(gate, item, value) for gate, items in BASELINE.items() for item, value in items.items()]
    return spark.createDataFrame(rows, "gate string, item string, baseline string").withColumn(
        "baseline", F.col("baseline").cast(SUM_TYPE))


