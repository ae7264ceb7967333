"""Functions, profiles and join analysis over the given tables and the domain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato import functions as X
from estrato.functions import clean_text, concat_key, date_sk, hash_key, money_from_text
from estrato.operators import profiling as P
from estrato.operators import relational as J
from estrato.operators.skew import salted_join, with_group_count
from estrato.plans import checks as C
from estrato.plans import profile as PROFILE
from estrato.plans import records as R
from suite import oracle_tables as T
from suite.layers import gold, mart, raw, silver
from suite.raw_tables import table
from suite.registry import Registry


def profile_sql(t: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE v IS NULL) AS null_count,
        count(*) FILTER (WHERE trim(v) = '') AS empty_count, count(*) FILTER (WHERE v <> '' AND trim(v) = '') AS blank_count,
        count(DISTINCT v) AS distinct_count, CAST(min(length(v)) AS INTEGER) AS min_length, CAST(max(length(v)) AS INTEGER) AS max_length,
        round(count(*) FILTER (WHERE v IS NULL) / count(*) * 100.0, 4) AS null_pct, round(count(DISTINCT v) / count(*) * 100.0, 4) AS distinct_pct
        FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {t})""" for c in columns
    )


def top_sql(t: str, columns: list[str], most: int = 35, top: int = 10) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, value, n, CAST(r AS INTEGER) AS rank FROM (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS r FROM
        (SELECT coalesce(v, '<NULL>') AS value, count(*) AS n FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {t}) GROUP BY 1))
        WHERE r <= {top} AND (SELECT count(DISTINCT {c}) FROM {t}) <= {most}""" for c in columns
    )


def dependency_sql(t: str, key: str, attributes: list[str], null_is_value: bool = True, null_keys: bool = False, digits: int = 4) -> str:
    where = "" if null_keys else f"WHERE {key} IS NOT NULL"
    extra = "+ max(CASE WHEN {a} IS NULL THEN 1 ELSE 0 END)" if null_is_value else ""
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS column_name, count(*) AS total_keys, count(*) FILTER (WHERE NOT v > 1) AS single_keys,
        count(*) FILTER (WHERE v > 1) AS multiple_keys, CAST(max(v) AS BIGINT) AS max_values,
        round(count(*) FILTER (WHERE v > 1) / count(*) * 100.0, {digits}) AS multiple_pct
        FROM (SELECT {key}, count(DISTINCT {a}) {extra.format(a=a)} AS v FROM {t} {where} GROUP BY {key})""" for a in attributes
    )


def tuple_sql(t: str, key: str, attributes: list[str]) -> str:
    return f"""SELECT count(*) AS total_keys, count(*) FILTER (WHERE n = 1) AS single_keys, count(*) FILTER (WHERE n > 1) AS multiple_keys,
    max(n) AS max_tuples, round(count(*) FILTER (WHERE n > 1) / count(*) * 100.0, 4) AS multiple_pct
    FROM (SELECT {key}, count(*) AS n FROM (SELECT DISTINCT {key}, {', '.join(attributes)} FROM {t} WHERE {key} IS NOT NULL) GROUP BY {key})"""


def collisions_sql(t: str, keys: str) -> str:
    return f"""SELECT count(*) AS collision_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS collision_rows, CAST(coalesce(max(n), 1) AS BIGINT) AS max_multiplicity,
    count(*) = 0 AS is_unique FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys} HAVING count(*) > 1)"""


def date_sql(t: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS null_count, min({c}) AS min_date, max({c}) AS max_date,
        count(DISTINCT year({c})) AS distinct_years, count(*) FILTER (WHERE year({c}) < 1990) AS before_window, count(*) FILTER (WHERE year({c}) > 2050) AS after_window,
        round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100.0, 4) AS null_pct FROM {t}""" for c in columns
    )


PROPONENT = [c for c in R.PROPONENT_COLUMNS if c != "identificacao_proponente"]
PROGRAM_RAW = ["COD_ORGAO_SUP_PROGRAMA", "DESC_ORGAO_SUP_PROGRAMA", "COD_PROGRAMA", "NOME_PROGRAMA", "SIT_PROGRAMA", "DATA_DISPONIBILIZACAO", "ANO_DISPONIBILIZACAO"]
AGREEMENT_COLUMNS = [f.name for f in R.CONVENIO if f.name != "numero_convenio"]
DATE_COLUMNS = {
    "proposta": ["data_proposta", "data_inicio_vigencia_proposta", "data_fim_vigencia_proposta"],
    "convenio": ["data_assinatura_convenio", "data_publicacao_convenio", "data_inicio_vigencia_convenio", "data_fim_vigencia_convenio",
                 "data_fim_vigencia_original", "data_limite_prestacao_contas", "data_suspensiva", "data_retirada_suspensiva"],
    "programa_cadastral": ["data_disponibilizacao"],
    "programa_elegibilidade": ["data_disponibilizacao", "data_inicio_recebimento_proposta", "data_fim_recebimento_proposta", "data_inicio_emenda_parlamentar",
                               "data_fim_emenda_parlamentar", "data_inicio_beneficiario_especifico", "data_fim_beneficiario_especifico"],
}


MONEY_RAW = "TRY_CAST(replace(VL_GLOBAL_CONV, ',', '.') AS DECIMAL(38,2))"
STEPS_SQL = f"""
SELECT 'base' AS step, count(*) AS n_rows, CAST(sum({MONEY_RAW}) AS DECIMAL(38,2)) AS total FROM raw_convenio
UNION ALL SELECT 'after_links', count(*), CAST(sum({MONEY_RAW}) AS DECIMAL(38,2)) FROM raw_convenio c JOIN raw_programa_proposta l ON c.ID_PROPOSTA = l.ID_PROPOSTA
UNION ALL SELECT 'after_programs', count(*), CAST(sum({MONEY_RAW}) AS DECIMAL(38,2)) FROM raw_convenio c
 JOIN raw_programa_proposta l ON c.ID_PROPOSTA = l.ID_PROPOSTA JOIN raw_programa p ON l.ID_PROGRAMA = p.ID_PROGRAMA"""


def histogram_sql(entities: str, value: str) -> str:
    return f"""SELECT n_members, count(*) AS n_entities, CAST(sum({value}) AS DECIMAL(38,2)) AS unique_total,
    CAST(sum(CAST({value} AS DECIMAL(38,2)) * n_members) AS DECIMAL(38,2)) AS inflated_total FROM (
    SELECT e.*, coalesce(n, 0) AS n_members FROM {entities} e LEFT JOIN
    (SELECT id_proposta AS k, count(DISTINCT id_programa) AS n FROM silver_programa_proposta GROUP BY ALL) c ON e.id_proposta = c.k) GROUP BY ALL"""


UNIQUE_AGREEMENTS = "(SELECT DISTINCT numero_convenio, id_proposta, valor_global_convenio FROM silver_convenio)"


def varied(df):
    """Lineage of several runs and files: the last character of the balance names the run; 0 has no file hash, no balance no run."""
    last = F.right(F.col("VL_SALDO_CONTA"), F.lit(1))
    return df.withColumn("__ingestion_run_id", F.nullif(last, F.lit(""))).withColumn("__source_sha256", F.when(last != "0", F.sha2(last, 256)))


def register(reg: Registry) -> None:
    # ---- functions over whole columns
    reg.add("fn_text", lambda s, d: raw(s, d)["proposta"].select(
        "ID_PROPOSTA", clean_text("NM_PROPONENTE").alias("cleaned"), X.clean_upper("UF_PROPONENTE").alias("upper_uf"),
        X.dash_to_null("OBJETO_PROPOSTA").alias("dash"), F.coalesce(X.is_blank_only("BAIRRO_PROPONENTE"), F.lit(False)).alias("blank"),
        X.parse_yes_no("ENVIADA_MANDATARIA").alias("yes_no"), X.is_safe_id("IDENTIF_PROPONENTE").alias("safe"), X.is_safe_id("NR_PROPOSTA").alias("unsafe"),
        concat_key("MODALIDADE", "NR_PROPOSTA").alias("joined"), X.json_list("ID_PROPOSTA", "MODALIDADE").alias("as_json"),
        X.normalize_location(F.concat(F.lit(" s3a://x/"), "ID_PROPOSTA", F.lit("// "))).alias("location")),
        f"""SELECT ID_PROPOSTA, {T.clean('NM_PROPONENTE')} AS cleaned, upper({T.clean('UF_PROPONENTE')}) AS upper_uf, {T.dash('OBJETO_PROPOSTA')} AS dash,
        BAIRRO_PROPONENTE <> '' AND trim(BAIRRO_PROPONENTE) = '' AS blank, {T.flag('ENVIADA_MANDATARIA')} AS yes_no,
        regexp_full_match(IDENTIF_PROPONENTE, '[A-Za-z0-9_.-]+') AS safe, regexp_full_match(NR_PROPOSTA, '[A-Za-z0-9_.-]+') AS unsafe,
        coalesce(MODALIDADE, '<NULL>') || '~' || NR_PROPOSTA AS joined,
        '["' || ID_PROPOSTA || '",' || CASE WHEN MODALIDADE IS NULL THEN 'null' ELSE '"' || MODALIDADE || '"' END || ']' AS as_json,
        's3a://x/' || ID_PROPOSTA AS location FROM raw_proposta""")
    reg.add("fn_numbers", lambda s, d: raw(s, d)["convenio"].select(
        "NR_CONVENIO", X.parse_decimal_br("VL_GLOBAL_CONV").alias("money"), X.parse_decimal_br("VL_SALDO_REMAN_CONVENENTE").alias("thousands"),
        X.parse_decimal_br("VL_GLOBAL_CONV", 12, 1).alias("one_digit"), F.col("DIAS_PREST_CONTAS").try_cast("int").alias("days"),
        F.col("QTD_TA").try_cast("smallint").alias("terms")),
        f"""SELECT NR_CONVENIO, {T.money('VL_GLOBAL_CONV')} AS money, {T.money('VL_SALDO_REMAN_CONVENENTE')} AS thousands,
        TRY_CAST(replace(VL_GLOBAL_CONV, ',', '.') AS DECIMAL(12,1)) AS one_digit, {T.whole('DIAS_PREST_CONTAS', 'INTEGER')} AS days,
        {T.whole('QTD_TA', 'SMALLINT')} AS terms FROM raw_convenio""")
    reg.add("fn_dates", lambda s, d: table(s, d, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in X.calendar_columns(F.to_date("o_orderdate")).items() if n != "data_sk"],
        date_sk(F.to_date("o_orderdate")).alias("sk"),
        date_sk(F.when(F.col("o_orderkey") % 5 > 0, F.date_add(F.to_date("o_orderdate"), ((F.col("o_orderkey") % 40) * 1000).cast("int")))).alias("moved_sk")),
        f"""SELECT o_orderkey, d AS data, CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, CAST(quarter(d) AS INTEGER) AS trimestre,
        CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre, CAST(dayofweek(d) + 1 AS INTEGER) AS dia_semana,
        ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro', 'Dezembro'][month(d)] AS nome_mes,
        dayofweek(d) IN (0, 6) AS is_fim_de_semana, {T.sk('d')} AS sk, {T.sk('m')} AS moved_sk FROM (SELECT *, CAST(o_orderdate AS DATE) AS d,
        CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 * 1000 AS INTEGER) END AS m FROM orders)""")
    reg.add("fn_control_timestamp", lambda s, d: table(s, d, "events").select(
        "event_id", X.parse_control_timestamp(F.when(F.col("event_id") % 7 == 0, F.lit("31/02/2026 10:00:00")).when(F.col("event_id") % 11 == 0, F.lit(" "))
                                              .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))).alias("at")),
        """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE date_trunc('second', ts) END AS at FROM events""")
    reg.add("fn_hash_key", lambda s, d: raw(s, d)["proposta"].select("ID_PROPOSTA", hash_key("MODALIDADE", "NM_PROPONENTE", "SIT_PROPOSTA").alias("k")),
            f"SELECT ID_PROPOSTA, {T.sha_key(['MODALIDADE', 'NM_PROPONENTE', 'SIT_PROPOSTA'])} AS k FROM raw_proposta")
    reg.add("fn_hash_in_path", lambda s, d: table(s, d, "documents").select(
        "doc_id", X.sha256_in_path(F.concat(F.lit("raw/x/"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("sha256="), F.sha2("text", 256))).otherwise(F.lit("none")), F.lit("/f.zip"))).alias("sha")),
        "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN sha256(text) END AS sha FROM documents")

    # ---- grouping helpers
    reg.add("group_count_per_row", lambda s, d: with_group_count(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey", "l_linenumber"], "n_same"),
            "SELECT l_orderkey, l_linenumber, l_extendedprice, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_same FROM lineitem")
    reg.add("group_count_with_null_keys", lambda s, d: with_group_count(raw(s, d)["proposta"].select("ID_PROPOSTA", "MODALIDADE"), ["MODALIDADE"], "n_same"),
            "SELECT ID_PROPOSTA, MODALIDADE, count(*) OVER (PARTITION BY MODALIDADE) AS n_same FROM raw_proposta")
    reg.add("salted_left_join", lambda s, d: salted_join(
        table(s, d, "events").select("event_id", F.col("user_id").alias("c_custkey")), table(s, d, "customer").select((F.col("c_custkey") * 2).alias("c_custkey"), "c_name"),
        "c_custkey", "event_id", "left", salts=8, top=16),
        "SELECT event_id, user_id AS c_custkey, c_name FROM events LEFT JOIN (SELECT c_custkey * 2 AS k, c_name FROM customer) ON user_id = k")

    # ---- column profiles
    for name, columns in {"proposta": [f.source for f in R.PROPOSTA], "programa": [f.source for f in R.PROGRAMA],
                          "programa_proposta": [f.source for f in R.PROGRAMA_PROPOSTA], "convenio": [f.source for f in R.CONVENIO]}.items():
        reg.add(f"profile_columns_{name}", lambda s, d, n=name, c=columns: P.column_profile(raw(s, d)[n], c), profile_sql(f"raw_{name}", columns))
        reg.add(f"profile_top_values_{name}", lambda s, d, n=name, c=columns: P.top_values(raw(s, d)[n], c), top_sql(f"raw_{name}", columns))
    reg.add("profile_columns_documents", lambda s, d: P.column_profile(table(s, d, "documents"), ["doc_id", "text", "lang", "source"]),
            profile_sql("documents", ["doc_id", "text", "lang", "source"]))

    # ---- candidate keys and dependencies
    five = ["ID_PROGRAMA", "MODALIDADE_PROGRAMA", "NATUREZA_JURIDICA_PROGRAMA", "UF_PROGRAMA", "ACAO_ORCAMENTARIA"]
    for n in (5, 4):
        reg.add(f"program_key_collisions_{n}_columns", lambda s, d, k=five[:n]: P.key_collisions(raw(s, d)["programa"], k), collisions_sql("raw_programa", ", ".join(five[:n])))
    reg.add("line_item_key_collisions", lambda s, d: P.key_collisions(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]), collisions_sql("lineitem", "l_orderkey, l_linenumber"))
    text = " || '~' || ".join(f"coalesce({c}, '<NULL>')" for c in five)
    reg.add("program_composite_uniqueness", lambda s, d: P.composite_uniqueness(raw(s, d)["programa"], five),
            f"SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(five)} FROM raw_programa)) AS distinct_tuples, count(DISTINCT {text}) AS distinct_texts FROM raw_programa")
    reg.add("program_dependencies", lambda s, d: P.dependency(raw(s, d)["programa"], ["ID_PROGRAMA"], PROGRAM_RAW, null_is_value=False, null_keys=True),
            dependency_sql("raw_programa", "ID_PROGRAMA", PROGRAM_RAW, False, True))
    reg.add("program_tuple_dependency", lambda s, d: P.tuple_dependency(raw(s, d)["programa"], ["ID_PROGRAMA"], PROGRAM_RAW), tuple_sql("raw_programa", "ID_PROGRAMA", PROGRAM_RAW))
    reg.add("proponent_dependencies", lambda s, d: P.dependency(silver(s, d)["proposta"], ["identificacao_proponente"], PROPONENT),
            dependency_sql("silver_proposta", "identificacao_proponente", PROPONENT))
    reg.add("proponent_tuple_dependency", lambda s, d: P.tuple_dependency(silver(s, d)["proposta"], ["identificacao_proponente"], PROPONENT),
            tuple_sql("silver_proposta", "identificacao_proponente", PROPONENT))
    reg.add("town_dependencies", lambda s, d: P.dependency(silver(s, d)["proposta"], ["codigo_municipio_ibge"], ["municipio_proponente", "uf_proponente"]),
            dependency_sql("silver_proposta", "codigo_municipio_ibge", ["municipio_proponente", "uf_proponente"]))
    reg.add("body_dependencies", lambda s, d: P.dependency(silver(s, d)["proposta"], ["codigo_orgao"], ["descricao_orgao", "codigo_orgao_superior"]),
            dependency_sql("silver_proposta", "codigo_orgao", ["descricao_orgao", "codigo_orgao_superior"]))
    reg.add("customer_order_dependencies", lambda s, d: P.dependency(silver(s, d)["proposta"], ["identificacao_proponente"], ["modalidade", "situacao_proposta", "municipio_proponente"]),
            dependency_sql("silver_proposta", "identificacao_proponente", ["modalidade", "situacao_proposta", "municipio_proponente"]))
    reg.add("modality_worst_offenders", lambda s, d: P.worst_offenders(silver(s, d)["proposta"], ["identificacao_proponente"], "objeto_proposta"),
            """SELECT identificacao_proponente, CAST(count(DISTINCT objeto_proposta) + max(CASE WHEN objeto_proposta IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_values
            FROM silver_proposta GROUP BY ALL HAVING distinct_values > 1 ORDER BY 2 DESC, 1 LIMIT 5""")
    stability = dependency_sql("silver_convenio", "numero_convenio", AGREEMENT_COLUMNS, True, True, 6)
    reg.add("agreement_column_stability", lambda s, d: P.column_stability(silver(s, d)["convenio"], ["numero_convenio"], AGREEMENT_COLUMNS, ["valor_saldo_conta"]),
            f"""SELECT column_name, multiple_keys, multiple_pct, max_values, CASE WHEN multiple_keys > 0 THEN 'VARIES' ELSE 'STABLE' END AS status,
            multiple_keys = 0 OR column_name = 'valor_saldo_conta' AS allowed FROM ({stability})""")
    reg.add("agreement_duplicate_census", lambda s, d: P.duplicate_census(silver(s, d)["convenio"], ["numero_convenio"]),
            "SELECT numero_convenio, count(*) AS n_rows FROM silver_convenio GROUP BY ALL HAVING count(*) > 1")
    reg.add("raw_conflict_census", lambda s, d: P.conflict_census(raw(s, d)["convenio"], "NR_CONVENIO"),
            """SELECT count(NR_CONVENIO) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS conflict_keys, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS conflict_rows,
            count(*) FILTER (WHERE n = 1) AS clean_rows FROM (SELECT NR_CONVENIO, count(*) AS n FROM raw_convenio GROUP BY ALL)""")
    pair_columns = [f.source for f in R.CONVENIO if f.source != "NR_CONVENIO"]
    pairs = f"(SELECT NR_CONVENIO, {{c}} AS v FROM raw_convenio WHERE NR_CONVENIO IN (SELECT NR_CONVENIO FROM raw_convenio GROUP BY ALL HAVING count(*) = 2))"  # noqa: F541
    pair_sql = " UNION ALL ".join(
        f"""SELECT NR_CONVENIO, '{c}' AS column_name, CASE WHEN count(v) = 1 THEN NULL ELSE min(v) END AS value_low, max(v) AS value_high FROM {pairs.format(c=c)}
        GROUP BY NR_CONVENIO HAVING count(v) = 1 OR min(v) <> max(v)""" for c in ["VL_SALDO_CONTA", "SIT_CONVENIO", "ID_PROPOSTA", "VL_SALDO_REMAN_TESOURO"]
    )
    reg.add("two_row_agreement_differences", lambda s, d: P.pair_differences(raw(s, d)["convenio"], "NR_CONVENIO", ["VL_SALDO_CONTA", "SIT_CONVENIO", "ID_PROPOSTA", "VL_SALDO_REMAN_TESOURO"]), pair_sql)
    reg.add("two_row_agreement_summary", lambda s, d: P.pair_summary(varied(raw(s, d)["convenio"]), "NR_CONVENIO", pair_columns, R.LINEAGE, "VL_SALDO_CONTA"),
            """SELECT NR_CONVENIO, CAST(count(DISTINCT VL_SALDO_CONTA) - 1 AS BIGINT) AS n_columns, count(DISTINCT VL_SALDO_CONTA) = 2 AS only_expected, count(DISTINCT coalesce(right(VL_SALDO_CONTA, 1), '')) = 1 AS same_lineage
            FROM raw_convenio GROUP BY NR_CONVENIO HAVING count(*) = 2""")

    # ---- dates, lineage
    for name, columns in DATE_COLUMNS.items():
        reg.add(f"date_profile_{name}", lambda s, d, n=name, c=columns: P.date_profile(silver(s, d)[n], c), date_sql(f"silver_{name}", columns))
    reg.add("date_anomalies", lambda s, d: P.date_anomalies(silver(s, d)["proposta"], DATE_COLUMNS["proposta"]), " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, v AS value, CAST(r AS INTEGER) AS rank FROM (SELECT v, row_number() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT {c} AS v FROM silver_proposta
        WHERE year({c}) < 1990 OR year({c}) > 2050)) WHERE r <= 5""" for c in DATE_COLUMNS["proposta"]))
    reg.add("lineage_profile", lambda s, d: J.named_rows({t: P.lineage_profile(silver(s, d)[t], "__ingestion_run_id", "__source_sha256", "__ingested_at_utc") for t in silver(s, d)}, "table_name"),
            " UNION ALL ".join(f"""SELECT '{t}' AS table_name, count(*) AS total_rows, count(DISTINCT __ingestion_run_id) AS distinct_runs, min(__ingestion_run_id) AS min_run, max(__ingestion_run_id) AS max_run,
            count(DISTINCT __source_sha256) AS distinct_sha256, min(__source_sha256) AS min_sha256, max(__source_sha256) AS max_sha256, min(__ingested_at_utc) AS min_ingested,
            max(__ingested_at_utc) AS max_ingested FROM silver_{t}""" for t in ("proposta", "programa_elegibilidade", "programa_cadastral", "programa_proposta", "convenio")))
    # lineage of several runs and files, with gaps: the last digit of a text stands for the run
    reg.add("lineage_profile_of_several_runs", lambda s, d: P.lineage_profile(varied(raw(s, d)["convenio"]), "__ingestion_run_id", "__source_sha256", "__ingested_at_utc"),
            """SELECT count(*) AS total_rows, count(DISTINCT r) AS distinct_runs, min(r) AS min_run, max(r) AS max_run, count(DISTINCT h) AS distinct_sha256, min(h) AS min_sha256, max(h) AS max_sha256,
            min(__ingested_at_utc) AS min_ingested, max(__ingested_at_utc) AS max_ingested
            FROM (SELECT *, nullif(right(VL_SALDO_CONTA, 1), '') AS r, CASE WHEN right(VL_SALDO_CONTA, 1) <> '0' THEN sha256(right(VL_SALDO_CONTA, 1)) END AS h FROM raw_convenio)""")
    reg.add("gate_lineage_with_gaps", lambda s, d: C.lineage_completeness({"convenio": varied(raw(s, d)["convenio"])}),
            """SELECT 'lineage' AS gate, 'convenio.' || c AS item, CAST(0 AS DECIMAL(38,2)) AS expected, CAST(n AS DECIMAL(38,2)) AS actual, CAST(n AS DECIMAL(38,2)) AS diff,
            CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT unnest(['__ingested_at_utc', '__ingestion_run_id', '__source_file', '__source_sha256']) AS c,
            unnest([0, (SELECT count(*) FROM raw_convenio WHERE coalesce(right(VL_SALDO_CONTA, 1), '') = ''), 0, (SELECT count(*) FROM raw_convenio WHERE coalesce(right(VL_SALDO_CONTA, 1), '0') IN ('0', ''))]) AS n)""")
    reg.add("null_counts", lambda s, d: P.null_counts(silver(s, d)["proposta"], ["modalidade", "data_proposta", "ano_proposta", "codigo_agencia"]), " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver_proposta" for c in ("modalidade", "data_proposta", "ano_proposta", "codigo_agencia")))

    # ---- join analysis
    reg.add("orphan_program_links", lambda s, d: J.orphan_keys(silver(s, d)["programa_proposta"], "id_proposta", silver(s, d)["proposta"], "id_proposta"),
            """SELECT l.id_proposta, count(*) AS n_rows FROM silver_programa_proposta l LEFT JOIN silver_proposta p ON l.id_proposta = p.id_proposta WHERE p.id_proposta IS NULL GROUP BY ALL""")
    reg.add("proposals_without_program", lambda s, d: J.unlinked_rows(silver(s, d)["proposta"], "id_proposta", silver(s, d)["programa_proposta"], "id_proposta").select("id_proposta", "valor_global_proposta"),
            "SELECT id_proposta, valor_global_proposta FROM silver_proposta WHERE id_proposta NOT IN (SELECT id_proposta FROM silver_programa_proposta)")
    coverage = [("agreements_in_proposals", "convenio", "ID_PROPOSTA", "proposta"), ("links_in_proposals", "programa_proposta", "ID_PROPOSTA", "proposta"),
                ("links_in_programs", "programa_proposta", "ID_PROGRAMA", "programa"), ("proposals_in_agreements", "proposta", "ID_PROPOSTA", "convenio")]
    reg.add("key_coverage", lambda s, d: J.named_rows({n: J.key_coverage(raw(s, d)[a], k, raw(s, d)[b], k) for n, a, k, b in coverage}, "relation"), " UNION ALL ".join(
        f"""SELECT '{n}' AS relation, count(DISTINCT a.{k}) AS total_keys, count(DISTINCT b.k) AS matched_keys, count(DISTINCT CASE WHEN b.k IS NULL THEN a.{k} END) AS unmatched_keys
        FROM raw_{a} a LEFT JOIN (SELECT DISTINCT {k} AS k FROM raw_{b}) b ON a.{k} = b.k""" for n, a, k, b in coverage))
    sets = {"superior": ("proposta", "codigo_orgao_superior"), "concedente": ("proposta", "codigo_orgao"), "programa": ("programa_cadastral", "codigo_orgao_superior_programa")}
    names = list(sets)
    reg.add("body_code_overlap", lambda s, d: J.key_overlap({n: (silver(s, d)[t], c) for n, (t, c) in sets.items()}), " UNION ALL ".join(
        f"SELECT '{a}' AS left_set, '{b}' AS right_set, count(*) AS n_common FROM (SELECT DISTINCT {sets[a][1]} AS k FROM silver_{sets[a][0]}) x JOIN (SELECT DISTINCT {sets[b][1]} AS k FROM silver_{sets[b][0]}) y ON x.k = y.k"
        for i, a in enumerate(names) for b in names[i:]))
    reg.add("join_fan_out", lambda s, d: PROFILE.join_fan_out(raw(s, d)), """SELECT 'agreements' AS step, count(*) AS n_rows FROM raw_convenio
        UNION ALL SELECT 'with_proposals', count(*) FROM raw_convenio c JOIN raw_proposta p ON c.ID_PROPOSTA = p.ID_PROPOSTA
        UNION ALL SELECT 'with_links', count(*) FROM raw_convenio c JOIN raw_proposta p ON c.ID_PROPOSTA = p.ID_PROPOSTA JOIN raw_programa_proposta l ON p.ID_PROPOSTA = l.ID_PROPOSTA
        UNION ALL SELECT 'with_programs', count(*) FROM raw_convenio c JOIN raw_proposta p ON c.ID_PROPOSTA = p.ID_PROPOSTA
         JOIN raw_programa_proposta l ON p.ID_PROPOSTA = l.ID_PROPOSTA JOIN raw_programa g ON l.ID_PROGRAMA = g.ID_PROGRAMA""")
    reg.add("money_after_joins", lambda s, d: PROFILE.financial_steps(raw(s, d)), STEPS_SQL)
    reg.add("money_inflation", lambda s, d: J.inflation(PROFILE.financial_steps(raw(s, d)), "base"),
            f"""SELECT step, n_rows, total, CAST(total - b AS DECIMAL(38,2)) AS difference, round(CAST(total AS DOUBLE) / CAST(b AS DOUBLE), 6) AS factor,
            round((CAST(total AS DOUBLE) / CAST(b AS DOUBLE) - 1) * 100, 6) AS pct_difference FROM (SELECT *, max(total) FILTER (WHERE step = 'base') OVER () AS b FROM ({STEPS_SQL}))""")
    unique = lambda s, d: silver(s, d)["convenio"].select("numero_convenio", "id_proposta", "valor_global_convenio").distinct()
    links = lambda s, d: silver(s, d)["programa_proposta"]
    hist = {
        "proposals": (lambda s, d: J.multiplicity_histogram(silver(s, d)["proposta"], "id_proposta", "valor_global_proposta", links(s, d), "id_proposta", "id_programa"), histogram_sql("silver_proposta", "valor_global_proposta")),
        "agreements": (lambda s, d: J.multiplicity_histogram(unique(s, d), "id_proposta", "valor_global_convenio", links(s, d), "id_proposta", "id_programa"), histogram_sql(UNIQUE_AGREEMENTS, "valor_global_convenio")),
    }
    for name, (query, sql) in hist.items():
        reg.add(f"program_multiplicity_{name}", query, sql)
        reg.add(f"program_multiplicity_summary_{name}", lambda s, d, q=query: J.histogram_summary(q(s, d)),
                f"""SELECT CAST(coalesce(sum(n_entities) FILTER (WHERE n_members = 0), 0) AS BIGINT) AS without_members, CAST(coalesce(sum(n_entities) FILTER (WHERE n_members = 1), 0) AS BIGINT) AS one_member,
                CAST(coalesce(sum(n_entities) FILTER (WHERE n_members > 1), 0) AS BIGINT) AS several_members, max(n_members) AS max_members,
                CAST(sum(unique_total) FILTER (WHERE n_members > 0) AS DECIMAL(38,2)) AS unique_total, CAST(sum(inflated_total) FILTER (WHERE n_members > 0) AS DECIMAL(38,2)) AS inflated_total,
                CAST(sum(inflated_total - unique_total) FILTER (WHERE n_members > 0) AS DECIMAL(38,2)) AS difference,
                round(CAST(sum(inflated_total) FILTER (WHERE n_members > 0) AS DOUBLE) / CAST(sum(unique_total) FILTER (WHERE n_members > 0) AS DOUBLE), 6) AS factor FROM ({sql})""")
    reg.add("program_associations", lambda s, d: PROFILE.program_associations(gold(s, d)),
        """SELECT id_programa, count(DISTINCT b.id_proposta) AS propostas, count(DISTINCT numero_convenio) AS convenios FROM bridge_programa_proposta b
        LEFT JOIN fct_convenio c ON b.id_proposta = c.id_proposta GROUP BY ALL""")
    reg.add("base_measures", lambda s, d: PROFILE.base_measures(silver(s, d)), " UNION ALL ".join([
        "SELECT 'propostas' AS item, CAST(count(*) AS DECIMAL(38,2)) AS value FROM silver_proposta",
        *[f"SELECT '{c}', CAST(sum({c}) AS DECIMAL(38,2)) FROM silver_proposta" for c in R.PROPOSTA_MONEY],
        "SELECT 'convenios', CAST(count(*) AS DECIMAL(38,2)) FROM (SELECT DISTINCT numero_convenio, " + ", ".join(R.CONVENIO_MONEY) + " FROM silver_convenio)",
        *[f"SELECT '{c}', CAST(coalesce(sum({c}), 0) AS DECIMAL(38,2)) FROM (SELECT DISTINCT numero_convenio, {', '.join(R.CONVENIO_MONEY)} FROM silver_convenio)" for c in R.CONVENIO_MONEY],
        "SELECT 'propostas_conveniadas', CAST(count(DISTINCT id_proposta) AS DECIMAL(38,2)) FROM silver_convenio"]))
    reg.add("quality_indicators", lambda s, d: PROFILE.quality_indicators(silver(s, d), gold(s, d)), """SELECT 'conflicting_agreements' AS indicator, count(DISTINCT numero_convenio) AS n, CAST(NULL AS DECIMAL(38,2)) AS value FROM silver_convenio WHERE has_source_conflict
        UNION ALL SELECT 'proposals_without_program', count(*), CAST(coalesce(sum(valor_global_proposta), 0) AS DECIMAL(38,2)) FROM fct_proposta WHERE id_proposta NOT IN (SELECT id_proposta FROM bridge_programa_proposta)
        UNION ALL SELECT 'dates_outside_window', count(*), NULL FROM fct_proposta WHERE data_fim_vigencia_proposta_sk = -2""")
    reg.add("describe_columns", lambda s, d: P.describe_columns(silver(s, d)["programa_proposta"], R.LINEAGE).join(
        P.null_counts(silver(s, d)["programa_proposta"], ["id_programa", "id_proposta", *R.LINEAGE]), F.col("name") == F.col("column_name")).select("position", "name", "type", "is_technical", "total_rows"),
        """SELECT CAST(i AS INTEGER) AS position, n AS name, t AS type, n LIKE '\\_\\_%' ESCAPE '\\' AS is_technical, (SELECT count(*) FROM silver_programa_proposta) AS total_rows
        FROM (VALUES (0, 'id_programa', 'bigint'), (1, 'id_proposta', 'bigint'), (2, '__ingested_at_utc', 'string'), (3, '__ingestion_run_id', 'string'),
        (4, '__source_file', 'string'), (5, '__source_sha256', 'string')) v(i, n, t)""")
