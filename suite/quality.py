"""Constraints, comparisons and gates over the domain tables and over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.operators import quality as Q
from estrato.operators import relational as J
from estrato.operators.quality import Contract
from estrato.plans import checks as C
from estrato.plans import layers as L
from estrato.plans import records as R
from suite import oracle_tables as T
from suite.layers import gold, mart, raw, silver
from suite.raw_tables import table
from suite.registry import Registry

KNOWN = (900000000, 900000997)
KNOWN_SQL = "(900000000, 900000997)"


def _dec(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(38,2))"


def gate_sql(gate: str, items: list[tuple[str, str, str]]) -> str:
    """(item, expected scalar SQL, actual scalar SQL) rows as a gate result."""
    parts = " UNION ALL ".join(
        f"SELECT '{item}' AS item, {_dec(f'({e})')} AS expected, {_dec(f'({a})')} AS actual" for item, e, a in items
    )
    return (
        f"SELECT '{gate}' AS gate, item, expected, actual, {_dec('actual - expected')} AS diff, "
        f"CASE WHEN actual - expected = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({parts})"
    )


def key_items(keys: list[tuple[str, str]], prefix: str = "") -> list[tuple[str, str, str]]:
    """Rows against distinct values, and rows of repeated values and NULLs apart."""
    repeated = "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"
    return [item for t, k in keys for item in (
        (f"{t}.{k}", distinct(prefix + t, k), rows(prefix + t)), (f"{t}.{k} repeated rows", "0", repeated.format(t=prefix + t, k=k)),
        (f"{t}.{k} NULLs", "0", f"SELECT count(*) FROM {prefix}{t} WHERE {k} IS NULL"))]


def rows(t: str) -> str:
    return f"SELECT count(*) FROM {t}"


def distinct(t: str, c: str) -> str:
    return f"SELECT count(DISTINCT {c}) FROM {t}"


def money(t: str, c: str) -> str:
    return f"SELECT coalesce(sum(CAST({c} AS DECIMAL(38,2))), 0) FROM {t}"


def orphans(t: str, c: str, o: str, oc: str) -> str:
    return f"SELECT count(*) FROM {t} x LEFT JOIN (SELECT DISTINCT {oc} AS k FROM {o}) y ON x.{c} = y.k WHERE y.k IS NULL AND x.{c} IS NOT NULL"


def dups(t: str, cols: str, where: str = "") -> str:
    return f"SELECT count(*) FROM (SELECT {cols} FROM {t} {where} GROUP BY {cols} HAVING count(*) > 1)"


def contract_sql(name: str, prefix: str, c: Contract) -> list[str]:
    t = prefix + name
    out = []

    def add(rule: str, target: str, sql: str) -> None:
        out.append(f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{target}' AS target, CAST(({sql}) AS BIGINT) AS violations")

    for col in c.not_null:
        add("not_null", col, f"SELECT count(*) FROM {t} WHERE {col} IS NULL")
    for col, values in c.accepted.items():
        listed = ", ".join(str(v) if isinstance(v, bool) else f"'{v}'" for v in values)
        add("accepted_values", col, f"SELECT count(*) FROM {t} WHERE {col} NOT IN ({listed})")
    for col in c.unique:
        add("unique", col, dups(t, col, f"WHERE {col} IS NOT NULL"))
    for keys in c.composite_unique:
        add("unique", "+".join(keys), dups(t, ", ".join(keys)))
    for col, other, other_col in c.references:
        add("references", f"{col}->{other}.{other_col}", orphans(t, col, prefix + other, other_col))
    return out


STABLE_DISTINCT = f"(SELECT DISTINCT {T.STABLE} FROM silver_convenio)"
ROLES_SQL = {
    "superior_proposta": "SELECT codigo_orgao_superior AS c, descricao_orgao_superior AS l FROM silver_proposta",
    "concedente_proposta": "SELECT codigo_orgao AS c, descricao_orgao AS l FROM silver_proposta",
    "superior_programa": "SELECT codigo_orgao_superior_programa AS c, descricao_orgao_superior_programa AS l FROM silver_programa_cadastral",
}


def register(reg: Registry) -> None:
    # declared contracts, one query per layer
    for label, contracts, prefix, tables in (
        ("silver", C.SILVER_CONTRACTS, "silver_", silver), ("gold", C.GOLD_CONTRACTS, "", gold),
    ):
        for name, contract in contracts.items():
            if name == "dim_data":
                continue
            reg.add(
                f"contract_{label}_{name}",
                lambda s, d, n=name, c=contract, f=tables: Q.check_contract(f(s, d), n, c),
                " UNION ALL ".join(contract_sql(name, prefix, contract)),
            )
    reg.add(
        "contract_serving_mart",
        lambda s, d: Q.check_contract({"mart": mart(s, d)}, "mart", C.VIEW_CONTRACT),
        " UNION ALL ".join(contract_sql("mart", "", C.VIEW_CONTRACT)),
    )
    # the same rules where they are broken, on the given tables
    broken = Contract(
        not_null=("l_orderkey",), unique=("l_orderkey",), composite_unique=(("l_orderkey", "l_linenumber"),),
        accepted={"l_returnflag": ("A", "N")}, references=(("l_suppkey", "part", "p_partkey"),),
    )
    reg.add(
        "contract_on_line_items",
        lambda s, d: Q.check_contract(
            {"lineitem": table(s, d, "lineitem"), "part": table(s, d, "part").withColumn("p_partkey", F.col("p_partkey") + 5)}, "lineitem", broken),
        " UNION ALL ".join(contract_sql("lineitem", "", broken)).replace(
            "FROM part", "FROM (SELECT p_partkey + 5 AS p_partkey FROM part)").replace(
            "p_partkey AS k FROM part", "p_partkey AS k FROM (SELECT p_partkey + 5 AS p_partkey FROM part)"),
    )
    reg.add("rows_with_null", lambda s, d: Q.null_rows(silver(s, d)["proposta"], "modalidade").select("id_proposta", "numero_proposta"),
            "SELECT id_proposta, numero_proposta FROM silver_proposta WHERE modalidade IS NULL")
    reg.add("rows_not_accepted", lambda s, d: Q.unaccepted_rows(table(s, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus"),
            "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
    reg.add("duplicate_composite_keys", lambda s, d: Q.duplicate_keys(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
            "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
    reg.add("duplicate_program_links", lambda s, d: Q.duplicate_keys(gold(s, d)["bridge_programa_proposta"], ["id_programa", "id_proposta"]),
            "SELECT id_programa, id_proposta, count(*) AS n_rows FROM bridge_programa_proposta GROUP BY ALL HAVING count(*) > 1")
    reg.add("unexpected_orphan_proposals",
            lambda s, d: C.unexpected_orphans(silver(s, d)["programa_proposta"], silver(s, d)["proposta"], KNOWN),
            f"""SELECT pp.id_proposta, count(*) AS n_rows FROM silver_programa_proposta pp LEFT JOIN silver_proposta p
            ON pp.id_proposta = p.id_proposta WHERE p.id_proposta IS NULL AND pp.id_proposta NOT IN {KNOWN_SQL} GROUP BY ALL""")
    reg.add("orphan_set_difference", lambda s, d: C.orphan_set_equality(silver(s, d), (*KNOWN, 5), s),
            f"""SELECT DISTINCT pp.id_proposta, 'unexpected' AS side FROM silver_programa_proposta pp LEFT JOIN silver_proposta p ON pp.id_proposta = p.id_proposta
            WHERE p.id_proposta IS NULL AND pp.id_proposta NOT IN {KNOWN_SQL} UNION ALL
            SELECT k, 'missing' FROM (VALUES (900000000), (900000997), (5)) v(k) WHERE k NOT IN (SELECT pp.id_proposta FROM silver_programa_proposta pp
            LEFT JOIN silver_proposta p ON pp.id_proposta = p.id_proposta WHERE p.id_proposta IS NULL)""")
    reg.add("unstable_observations",
            lambda s, d: Q.unstable_keys(silver(s, d)["convenio"], "numero_convenio", ["numero_convenio", "valor_saldo_conta"]),
            """SELECT numero_convenio, count(*) AS n_tuples FROM (SELECT DISTINCT numero_convenio, valor_saldo_conta FROM silver_convenio)
            GROUP BY ALL HAVING count(*) > 1""")
    reg.add("conflict_flag_consistency",
            # the flags of one row in seven are turned round, so that there is something to find
            lambda s, d: Q.inconsistent_flags(silver(s, d)["convenio"].withColumn(
                "flag", F.col("has_source_conflict") != (F.col("id_proposta") % 7 == 0)), "source_conflict_count", "flag").groupBy("flag").agg(F.count("*").alias("n_odd")),
            """SELECT flag, count(*) AS n_odd FROM (SELECT *, has_source_conflict <> (id_proposta % 7 = 0) AS flag FROM silver_convenio)
            WHERE (source_conflict_count > 1) <> flag GROUP BY ALL""")
    reg.add("conflicting_observations", lambda s, d: C.conflict_listing(silver(s, d)),
            "SELECT numero_convenio, id_convenio_observacao, valor_saldo_conta, source_conflict_count FROM silver_convenio WHERE has_source_conflict")
    reg.add("presence_flag_of_mart",
            lambda s, d: Q.inconsistent_presence(mart(s, d, ["id_proposta", "tem_convenio", "numero_convenio"]).withColumn(
                "flag", F.col("tem_convenio") != (F.col("id_proposta") % 7 == 0)), "flag", "numero_convenio").groupBy("flag").agg(F.count("*").alias("n_odd")),
            """SELECT flag, count(*) AS n_odd FROM (SELECT *, tem_convenio <> (id_proposta % 7 = 0) AS flag FROM mart)
            WHERE flag <> (numero_convenio IS NOT NULL) GROUP BY ALL""")
    # conflicts on real name clashes: customers and suppliers described per nation
    roles = lambda s, d: {
        "customer": (table(s, d, "customer"), "c_nationkey", "c_mktsegment"),
        "part": (table(s, d, "part"), "p_size", "p_type"),
    }
    reg.add("label_conflicts_between_tables",
            lambda s, d: J.label_conflicts(roles(s, d), [("customer", "part")]),
            """WITH a AS (SELECT DISTINCT c_nationkey AS code, c_mktsegment AS l FROM customer),
            b AS (SELECT DISTINCT p_size AS code, p_type AS l FROM part),
            p AS (SELECT a.code, count(*) AS n_conflicts FROM a JOIN b ON a.code = b.code AND a.l <> b.l GROUP BY a.code)
            SELECT p.code, 'customer_vs_part' AS pair, n_conflicts,
            (SELECT count(*) FROM a WHERE a.code = p.code) AS n_labels_a, (SELECT count(*) FROM b WHERE b.code = p.code) AS n_labels_b FROM p""")
    pair_sql = " UNION ALL ".join(
        f"SELECT a.c AS code, '{x}_vs_{y}' AS pair, count(*) AS n_conflicts FROM (SELECT DISTINCT * FROM ({ROLES_SQL[x]})) a "
        f"JOIN (SELECT DISTINCT * FROM ({ROLES_SQL[y]})) b ON a.c = b.c AND a.l <> b.l GROUP BY ALL" for x, y in C.BODY_PAIRS
    )
    reg.add("body_label_conflicts", lambda s, d: C.body_conflicts(silver(s, d)).select("code", "pair", "n_conflicts"), pair_sql)

    # the same with names that do conflict: bodies of even codes have another name in the proposals
    other = "CASE WHEN CAST(right(codigo_orgao, 1) AS INTEGER) % 2 = 0 THEN descricao_orgao || ' X' ELSE descricao_orgao END"
    other_roles = {**ROLES_SQL, "concedente_proposta": f"SELECT codigo_orgao AS c, {other} AS l FROM silver_proposta"}

    def renamed(s, d):
        even = F.right(F.col("codigo_orgao"), F.lit(1)).cast("int") % 2 == 0
        own = silver(s, d)["proposta"].withColumn("descricao_orgao", F.when(even, F.concat("descricao_orgao", F.lit(" X"))).otherwise(F.col("descricao_orgao")))
        return {"proposta": own, "programa_cadastral": silver(s, d)["programa_cadastral"]}

    renamed_sql = " UNION ALL ".join(
        f"SELECT a.c AS code, '{x}_vs_{y}' AS pair, count(*) AS n_conflicts FROM (SELECT DISTINCT * FROM ({other_roles[x]})) a "
        f"JOIN (SELECT DISTINCT * FROM ({other_roles[y]})) b ON a.c = b.c AND a.l <> b.l GROUP BY ALL" for x, y in C.BODY_PAIRS)
    reg.add("body_label_conflicts_of_renamed_bodies", lambda s, d: C.body_conflicts(renamed(s, d)).select("code", "pair", "n_conflicts"), renamed_sql)

    # raw -> silver gates
    same = [("proposta", "proposta"), ("programa_proposta", "programa_proposta"), ("programa", "programa_elegibilidade"), ("convenio", "convenio")]
    reg.add("gate_row_counts", lambda s, d: C.raw_row_counts(raw(s, d), silver(s, d)), gate_sql("row_counts", [
        *[(t, rows(f"raw_{r}"), rows(f"silver_{t}")) for r, t in same],
        ("programa_cadastral", distinct("raw_programa", "ID_PROGRAMA"), rows("silver_programa_cadastral")),
    ]))
    keys = [("proposta", "id_proposta"), ("programa_cadastral", "id_programa"), ("programa_elegibilidade", "id_programa_elegibilidade"), ("convenio", "id_convenio_observacao")]
    reg.add("gate_key_uniqueness", lambda s, d: C.silver_key_uniqueness(silver(s, d)), gate_sql("key_uniqueness", [
        *key_items(keys, "silver_"),
        ("programa_proposta.pair", "0", dups("silver_programa_proposta", "id_programa, id_proposta")),
        ("programa_elegibilidade.superkey", "0", dups("silver_programa_elegibilidade", ", ".join(R.ELIGIBILITY_SUPERKEY))),
    ]))
    per_key = "(SELECT NR_CONVENIO AS k, count(*) AS n FROM raw_convenio GROUP BY ALL)"
    sc = "silver_convenio"
    reg.add("gate_agreement_conflicts", lambda s, d: C.conflict_reconciliation(raw(s, d), silver(s, d)), gate_sql("agreement_conflicts", [
        ("distinct_keys", f"SELECT count(k) FROM {per_key}", distinct(sc, "numero_convenio")),
        ("conflict_keys", f"SELECT count(*) FROM {per_key} WHERE n > 1", f"SELECT count(DISTINCT numero_convenio) FROM {sc} WHERE source_conflict_count > 1"),
        ("conflict_rows", f"SELECT sum(n) FROM {per_key} WHERE n > 1", f"SELECT count(*) FROM {sc} WHERE source_conflict_count > 1"),
        ("flagged_rows", f"SELECT sum(n) FROM {per_key} WHERE n > 1", f"SELECT count(*) FROM {sc} WHERE has_source_conflict"),
        ("clean_rows", f"SELECT count(*) FROM {per_key} WHERE n = 1", f"SELECT count(*) FROM {sc} WHERE NOT has_source_conflict"),
        ("inconsistent_rows", "0", f"SELECT count(*) FROM {sc} WHERE (source_conflict_count > 1) <> has_source_conflict"),
    ]))
    unlinked = lambda p, l, k: f"SELECT count(*) FROM {p} p LEFT JOIN (SELECT DISTINCT {k} FROM {l}) l ON p.{k} = l.{k} WHERE l.{k} IS NULL"  # noqa: E731,E741
    unexpected = lambda b, p: f"SELECT count(DISTINCT b.id_proposta) FROM {b} b LEFT JOIN {p} p ON b.id_proposta = p.id_proposta WHERE p.id_proposta IS NULL AND b.id_proposta NOT IN {KNOWN_SQL}"
    reg.add("gate_references", lambda s, d: C.silver_references(raw(s, d), silver(s, d), KNOWN), gate_sql("references", [
        *[(f"{c}->{p}", "0", f"SELECT count(*) FROM silver_{c} c LEFT JOIN silver_{p} p ON c.{k} = p.{k} WHERE p.{k} IS NULL") for c, k, p in (
            ("convenio", "id_proposta", "proposta"), ("programa_elegibilidade", "id_programa", "programa_cadastral"),
            ("programa_proposta", "id_programa", "programa_cadastral"))],
        ("programa_proposta->proposta unexpected", "0", unexpected("silver_programa_proposta", "silver_proposta")),
        ("proposta without programa", unlinked("raw_proposta", "raw_programa_proposta", "ID_PROPOSTA"), unlinked("silver_proposta", "silver_programa_proposta", "id_proposta")),
    ]))
    raw_money = lambda t, c: (
        f"SELECT coalesce(sum(TRY_CAST(CASE WHEN contains({c}, ',') THEN replace(replace({c}, '.', ''), ',', '.') ELSE {c} END AS DECIMAL(38,2))), 0) FROM raw_{t}")
    reg.add("gate_money", lambda s, d: C.raw_money(raw(s, d), silver(s, d)), gate_sql("money", [
        (sv, raw_money(t, rw), money(f"silver_{t}", sv)) for t, cols in C.RAW_MONEY.items() for rw, sv in cols.items()
    ]))
    reg.add("gate_lineage", lambda s, d: C.lineage_completeness(silver(s, d)), gate_sql("lineage", [
        (f"{t}.{c}", "0", f"SELECT count(*) FROM silver_{t} WHERE {c} IS NULL")
        for t in ("proposta", "programa_elegibilidade", "programa_cadastral", "programa_proposta", "convenio") for c in R.LINEAGE
    ]))
    layouts = {"proposta": (R.PROPOSTA, "silver_proposta"), "programa": (R.PROGRAMA, "silver_programa_elegibilidade"),
               "programa_proposta": (R.PROGRAMA_PROPOSTA, "silver_programa_proposta"), "convenio": (R.CONVENIO, "silver_convenio")}
    sql_kind = {"long": lambda c: T.whole(c, "BIGINT"), "short": lambda c: T.whole(c, "SMALLINT"), "int": lambda c: T.whole(c, "INTEGER"),
                "date": T.date, "money": T.money, "flag": T.flag}
    reg.add("parse_losses", lambda s, d: C.parse_losses(raw(s, d)), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) FILTER (WHERE {T.clean(f.source)} IS NOT NULL AND "
        f"{sql_kind[f.kind](f.source)} IS NULL) AS lost_rows, count(*) AS total_rows FROM raw_{t}"
        for t, (layout, _) in layouts.items() for f in layout if f.kind in sql_kind
    ))
    # one column within its allowance, one above it, the others without any
    allowed = {"proposta.ano_proposta": 0.05, "convenio.is_opera_obtv": 0.01}
    share = " ".join(f"WHEN '{k}' THEN {v}" for k, v in allowed.items())
    reg.add("gate_parse_losses", lambda s, d: C.parse_losses_gate(raw(s, d), allowed), "SELECT 'parse_losses' AS gate, item, expected, actual, "
            "CAST(actual - expected AS DECIMAL(38,2)) AS diff, CASE WHEN actual <= expected THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + " UNION ALL ".join(
                f"SELECT '{t}.{f.name}' AS item, CAST(floor(CASE '{t}.{f.name}' {share} ELSE 0 END * count(*)) AS DECIMAL(38,2)) AS expected, "
                f"CAST(count(*) FILTER (WHERE {T.clean(f.source)} IS NOT NULL AND {sql_kind[f.kind](f.source)} IS NULL) AS DECIMAL(38,2)) AS actual FROM raw_{t}"
                for t, (layout, _) in layouts.items() for f in layout if f.kind in sql_kind) + ")")
    # an amount written with a dot between thousands: the typed side drops it, the raw side does not
    def thousands(s, d):
        damaged = raw(s, d)["convenio"].withColumn("VL_GLOBAL_CONV", F.when(F.col("NR_CONVENIO").endswith("7"), "1.234,56").otherwise(F.col("VL_GLOBAL_CONV")))
        return C.raw_money({"convenio": damaged, "proposta": raw(s, d)["proposta"]}, {**silver(s, d), "convenio": L.silver_tables({**raw(s, d), "convenio": damaged})["convenio"]})

    spoiled = "CASE WHEN NR_CONVENIO LIKE '%7' THEN '1.234,56' ELSE VL_GLOBAL_CONV END"
    reg.add("gate_money_with_thousands", thousands, gate_sql("money", [
        ("valor_global_convenio",
         f"SELECT coalesce(sum(TRY_CAST(CASE WHEN contains(v, ',') THEN replace(replace(v, '.', ''), ',', '.') ELSE v END AS DECIMAL(38,2))), 0) FROM (SELECT {spoiled} AS v FROM raw_convenio)",
         f"SELECT coalesce(sum({T.money('v')}), 0) FROM (SELECT {spoiled} AS v FROM raw_convenio)"),
        *[(sv, raw_money(t, rw), money(f"silver_{t}", sv)) for t, cols in C.RAW_MONEY.items() for rw, sv in cols.items() if rw != "VL_GLOBAL_CONV"],
    ]))

    # silver -> gold gates
    codes = " UNION ".join(sql.replace(", descricao_orgao_superior_programa AS l", "").replace(", descricao_orgao_superior AS l", "").replace(", descricao_orgao AS l", "") for sql in ROLES_SQL.values())
    reg.add("gate_gold_row_counts", lambda s, d: C.gold_row_counts(silver(s, d), gold(s, d)), gate_sql("gold_row_counts", [
        ("dim_programa", rows("silver_programa_cadastral"), rows("dim_programa")),
        ("fct_proposta", rows("silver_proposta"), rows("fct_proposta")),
        ("bridge_programa_proposta", rows("silver_programa_proposta"), rows("bridge_programa_proposta")),
        ("fct_convenio_saldo_observacao", rows("silver_convenio"), rows("fct_convenio_saldo_observacao")),
        ("dim_proponente", distinct("silver_proposta", "identificacao_proponente"), rows("dim_proponente")),
        ("dim_municipio", distinct("silver_proposta", "codigo_municipio_ibge"), rows("dim_municipio")),
        ("dim_orgao", f"SELECT count(DISTINCT c) FROM ({codes})", rows("dim_orgao")),
        ("fct_convenio", f"SELECT count(*) FROM {STABLE_DISTINCT}", rows("fct_convenio")),
        ("dim_data", "22282", rows("dim_data")),
    ]))
    gold_keys = [*C.GOLD_KEYS.items(), ("fct_convenio", "id_proposta")]
    reg.add("gate_primary_keys", lambda s, d: C.gold_primary_keys(gold(s, d)), gate_sql("primary_keys", [
        *key_items(gold_keys),
        ("bridge_programa_proposta.pair", "0", dups("bridge_programa_proposta", "id_programa, id_proposta")),
    ]))
    reg.add("gate_gold_references", lambda s, d: C.gold_references(gold(s, d), KNOWN), gate_sql("gold_references", [
        *[(f"{t}.{c}->{o}", "0", orphans(t, c, o, oc)) for t, k in C.GOLD_CONTRACTS.items() for c, o, oc in k.references if o != "dim_data"],
        ("bridge_programa_proposta->fct_proposta unexpected", "0", unexpected("bridge_programa_proposta", "fct_proposta")),
    ]))
    date_tables = (("dim_programa", C.PROGRAM_DATES), ("fct_proposta", C.PROPOSAL_DATES), ("fct_convenio", C.AGREEMENT_DATES))
    reg.add("calendar_key_audit", lambda s, d: C.calendar_keys(gold(s, d)), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE dd.data_sk IS NULL) AS orphan_rows, "
        f"count(*) FILTER (WHERE f.{c} = -1) AS missing_rows, count(*) FILTER (WHERE f.{c} = -2) AS outside_rows "
        f"FROM {t} f LEFT JOIN dim_data dd ON f.{c} = dd.data_sk" for t, cols in date_tables for c in cols
    ))
    reg.add("gate_date_keys", lambda s, d: C.date_keys_gate(gold(s, d)), gate_sql("date_keys", [
        ("rows", "22282", rows("dim_data")), ("missing", "1", "SELECT count(*) FROM dim_data WHERE data_sk = -1"),
        ("outside", "1", "SELECT count(*) FROM dim_data WHERE data_sk = -2"), ("days", "22280", "SELECT count(*) FROM dim_data WHERE data_sk > 0"),
        ("distinct_days", "22280", distinct("dim_data", "data")),
        ("first_day_offset", "0", "SELECT min(data) - DATE '1990-01-01' FROM dim_data"),
        ("last_day_offset", "22279", "SELECT max(data) - DATE '1990-01-01' FROM dim_data"),
        *[(f"{t}.{c}", "0", f"SELECT count(*) FROM {t} f LEFT JOIN dim_data dd ON f.{c} = dd.data_sk WHERE dd.data_sk IS NULL") for t, cols in date_tables for c in cols],
    ]))
    sources = {"dim_programa": ("silver_programa_cadastral", "id_programa"), "fct_proposta": ("silver_proposta", "id_proposta"), "fct_convenio": ("silver_convenio", "numero_convenio")}
    reg.add("date_mapping_audit", lambda s, d: C.date_mapping(silver(s, d), gold(s, d)), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS checked_rows, count(*) FILTER (WHERE g.{c} IS DISTINCT FROM {T.sk('s.' + src)}) AS n_different "
        f"FROM {sources[t][0]} s JOIN {t} g ON s.{sources[t][1]} = g.{sources[t][1]}" for t, cols in date_tables for c, src in cols.items()
    ))
    reg.add("gate_date_mapping", lambda s, d: C.date_mapping_gate(silver(s, d), gold(s, d)), gate_sql("date_mapping", [
        (f"{t}.{c}", "0", f"SELECT count(*) FROM {sources[t][0]} s JOIN {t} g ON s.{sources[t][1]} = g.{sources[t][1]} WHERE g.{c} IS DISTINCT FROM {T.sk('s.' + src)}")
        for t, cols in date_tables for c, src in cols.items()
    ]))
    reg.add("gate_body_conformance", lambda s, d: C.body_conformance_gate(silver(s, d)), gate_sql("body_conformance", [
        (f"{x}_vs_{y}", "0", f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({ROLES_SQL[x]})) a JOIN (SELECT DISTINCT * FROM ({ROLES_SQL[y]})) b ON a.c = b.c AND a.l <> b.l")
        for x, y in C.BODY_PAIRS
    ]))
    reg.add("gate_canonical_stability", lambda s, d: C.canonical_stability_gate(silver(s, d)), gate_sql("canonical_stability", [
        ("unstable agreements", "0", f"SELECT count(*) FROM (SELECT numero_convenio FROM {STABLE_DISTINCT} GROUP BY ALL HAVING count(*) > 1)"),
    ]))
    reg.add("gate_proposal_money", lambda s, d: C.proposal_money_gate(silver(s, d), gold(s, d)["fct_proposta"]), gate_sql("proposal_money", [
        (c, money("silver_proposta", c), money("fct_proposta", c)) for c in R.PROPOSTA_MONEY
    ]))
    canonical = f"(SELECT DISTINCT numero_convenio, {', '.join(R.CONVENIO_MONEY)} FROM silver_convenio)"
    reg.add("gate_agreement_money", lambda s, d: C.agreement_money_gate(silver(s, d), gold(s, d)), gate_sql("agreement_money", [
        (c, money(canonical, c), money("fct_convenio", c)) for c in R.CONVENIO_MONEY
    ]))
    obs = "fct_convenio_saldo_observacao"
    conflict = "SELECT count(*) FROM {} WHERE has_source_conflict"
    reg.add("gate_balance_observations", lambda s, d: C.balance_gate(silver(s, d), gold(s, d)), gate_sql("balance_observations", [
        ("rows", rows(sc), rows(obs)), ("distinct_ids", distinct(sc, "id_convenio_observacao"), distinct(obs, "id_convenio_observacao")),
        ("balance_checksum", money(sc, "valor_saldo_conta"), money(obs, "valor_saldo_conta")),
        ("conflict_rows", conflict.format(sc), conflict.format(obs)),
        ("rows = distinct ids", distinct(obs, "id_convenio_observacao"), rows(obs)),
    ]))
    for label in ("counts", "money", "presence"):
        shown = ("valor_global_convenio", "valor_repasse_convenio", "valor_empenhado_convenio", "valor_desembolsado_convenio")
        sql = {
            "counts": [("rows", rows("fct_proposta"), rows("mart")), ("agreements", rows("fct_convenio"), "SELECT count(numero_convenio) FROM mart"),
                       ("distinct agreements", rows("fct_convenio"), distinct("mart", "numero_convenio"))],
            "money": [*[(c, money("fct_proposta", c), money("mart", c)) for c in R.PROPOSTA_MONEY], *[(c, money("fct_convenio", c), money("mart", c)) for c in shown]],
            "presence": [("inconsistent rows", "0", "SELECT count(*) FROM mart WHERE tem_convenio <> (numero_convenio IS NOT NULL)")],
        }[label]
        reg.add(f"gate_mart_{label}", lambda s, d, n=f"mart_{label}": C.view_gates(gold(s, d), mart(s, d), "mart")[n](), gate_sql(f"mart_{label}", sql))
    baseline = [("proposal_money", "valor_global_proposta", "1.00"), ("proposal_money", "valor_repasse_proposta", None)]
    reg.add(
        "gate_against_stored_baseline",
        lambda s, d: Q.with_baseline(
            C.proposal_money_gate(silver(s, d), gold(s, d)["fct_proposta"]),
            s.createDataFrame(baseline, "gate string, item string, baseline string").withColumn("baseline", F.col("baseline").cast("decimal(38,2)")),
        ),
        f"""SELECT g.gate, g.item, expected, actual, diff, b.baseline,
        CASE WHEN b.baseline IS NOT NULL AND actual IS DISTINCT FROM b.baseline THEN 'FAIL' ELSE status END AS status
        FROM ({gate_sql('proposal_money', [(c, money('silver_proposta', c), money('fct_proposta', c)) for c in R.PROPOSTA_MONEY])}) g
        LEFT JOIN (SELECT 'proposal_money' AS gate, 'valor_global_proposta' AS item, CAST('1.00' AS DECIMAL(38,2)) AS baseline) b
        ON g.gate = b.gate AND g.item = b.item""",
    )
    reg.add(
        "gate_verdicts",
        lambda s, d: Q.gate_verdicts(C.silver_key_uniqueness(silver(s, d)).unionByName(C.proposal_money_gate(silver(s, d), gold(s, d)["fct_proposta"]))),
        f"""SELECT gate, count(*) AS n_items, count(*) FILTER (WHERE status <> 'PASS') AS n_failed,
        CASE WHEN count(*) FILTER (WHERE status <> 'PASS') > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
        {gate_sql("key_uniqueness", [*key_items(keys, "silver_"),
        ("programa_proposta.pair", "0", dups("silver_programa_proposta", "id_programa, id_proposta")),
        ("programa_elegibilidade.superkey", "0", dups("silver_programa_elegibilidade", ", ".join(R.ELIGIBILITY_SUPERKEY)))])}
        UNION ALL {gate_sql('proposal_money', [(c, money('silver_proposta', c), money('fct_proposta', c)) for c in R.PROPOSTA_MONEY])}) GROUP BY gate""",
    )
