"""The domain tables again, in plain SQL for the checking engine. Written apart from the Spark code."""

from __future__ import annotations

import re

LINEAGE = """'2026-09-16T12:00:00+00:00' AS __ingested_at_utc, 'run_a' AS __ingestion_run_id,
 'snapshot.csv' AS __source_file, repeat('a', 64) AS __source_sha256"""
LINEAGE_NAMES = "__ingested_at_utc, __ingestion_run_id, __source_file, __source_sha256"


def _money(amount: str, sep: str) -> str:
    return (
        f"(CASE WHEN ({amount}) < 0 THEN '-' ELSE '' END || CAST(abs({amount}) // 100 AS VARCHAR) || {sep} "
        f"|| lpad(CAST(abs({amount}) % 100 AS VARCHAR), 2, '0'))"
    )


def _brd(expr: str) -> str:
    return f"strftime({expr}, '%d/%m/%Y')"


_P_SEP = "CASE WHEN o_orderkey % 2 = 0 THEN ',' ELSE '.' END"
_C_SEP = "CASE WHEN o_orderkey % 2 = 1 THEN ',' ELSE '.' END"

RAW_PROPOSTA = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ID_PROPOSTA,
 CASE WHEN o_orderkey % 3 = 0 THEN lower(uf) || ' ' ELSE uf END AS UF_PROPONENTE,
 n_name AS MUNIC_PROPONENTE,
 CAST(1100000 + n_nationkey AS VARCHAR) AS COD_MUNIC_IBGE,
 CAST(30000 + o_custkey % 8 AS VARCHAR) AS COD_ORGAO_SUP,
 'ORGAO ' || CAST(30000 + o_custkey % 8 AS VARCHAR) AS DESC_ORGAO_SUP,
 c_mktsegment AS NATUREZA_JURIDICA,
 lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '/' || CAST(year(d) AS VARCHAR) AS NR_PROPOSTA,
 CAST(day(d) AS VARCHAR) AS DIA_PROP, CAST(month(d) AS VARCHAR) AS MES_PROP,
 CASE WHEN o_orderkey % 71 = 0 THEN 'n/d' ELSE CAST(year(d) AS VARCHAR) END AS ANO_PROP,
 CASE WHEN o_orderkey % 97 = 0 THEN '15/03/0011' WHEN o_orderkey % 89 = 0 THEN ' '
  WHEN o_orderkey % 83 = 0 THEN '01/01/3012' WHEN o_orderkey % 79 = 0 THEN '31/02/2001'
  ELSE {_brd('d')} END AS DIA_PROPOSTA,
 CAST(30000 + o_custkey % 40 AS VARCHAR) AS COD_ORGAO,
 'ORGAO ' || CAST(30000 + o_custkey % 40 AS VARCHAR) AS DESC_ORGAO,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'CONVENIO' WHEN '2-HIGH' THEN 'CONTRATO DE REPASSE'
  WHEN '3-MEDIUM' THEN 'TERMO DE FOMENTO' WHEN '5-LOW' THEN 'TERMO DE COLABORACAO' END AS MODALIDADE,
 lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS IDENTIF_PROPONENTE,
 ' ' || c_name || '  ' AS NM_PROPONENTE,
 lpad(CAST(o_custkey * 37 % 100000000 AS VARCHAR), 8, '0') AS CEP_PROPONENTE,
 'RUA ' || CAST(o_custkey % 500 AS VARCHAR) AS ENDERECO_PROPONENTE,
 CASE WHEN o_custkey % 7 = 0 THEN '   ' ELSE 'BAIRRO ' || CAST(o_custkey % 50 AS VARCHAR) END AS BAIRRO_PROPONENTE,
 'BANCO ' || CAST(o_custkey % 5 AS VARCHAR) AS NM_BANCO,
 CASE WHEN o_orderstatus = 'F' THEN 'Regularizada' ELSE 'Pendente' END AS SITUACAO_CONTA,
 CAST(NULL AS VARCHAR) AS SITUACAO_PROJETO_BASICO,
 CASE o_orderstatus WHEN 'F' THEN 'Plano de Trabalho Aprovado' WHEN 'O' THEN 'Em Análise'
  ELSE 'Rejeitada' END AS SIT_PROPOSTA,
 {_brd('d + 30')} AS DIA_INIC_VIGENCIA_PROPOSTA,
 CASE WHEN o_orderkey % 61 = 0 THEN '31/12/5008' ELSE {_brd('d + 395')} END AS DIA_FIM_VIGENCIA_PROPOSTA,
 CASE WHEN o_orderkey % 10 = 0 THEN ' - ' WHEN o_orderkey % 11 = 0 THEN '  '
  ELSE ' Objeto ' || CAST(o_orderkey AS VARCHAR) END AS OBJETO_PROPOSTA,
 CAST(NULL AS VARCHAR) AS ITEM_INVESTIMENTO,
 CASE o_orderkey % 3 WHEN 0 THEN 'SIM' WHEN 1 THEN 'NÃO' ELSE 'NÃO APLICÁVEL' END AS ENVIADA_MANDATARIA,
 '' AS NOME_SUBTIPO_PROPOSTA,
 CASE WHEN o_orderkey % 4 = 0 THEN 'Subtipo' END AS DESCRICAO_SUBTIPO_PROPOSTA,
 {_money('t', _P_SEP)} AS VL_GLOBAL_PROP,
 {_money('t * 4 // 5', _P_SEP)} AS VL_REPASSE_PROP,
 {_money('CASE WHEN o_orderkey % 101 = 0 THEN -(t - t * 4 // 5) ELSE t - t * 4 // 5 END', _P_SEP)}
  AS VL_CONTRAPARTIDA_PROP,
 CASE WHEN o_orderkey % 5 = 0 THEN '-' ELSE lpad(CAST(o_orderkey % 9999 AS VARCHAR), 4, '0') END AS CD_AGENCIA,
 lpad(CAST(o_orderkey % 100000 AS VARCHAR), 8, '0') AS CD_CONTA,
 {LINEAGE}
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(round(o_totalprice * 100) AS BIGINT) AS t,
  ['SP', 'MG', 'RJ', 'BA', 'RS'][n_regionkey + 1] AS uf
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""

RAW_PROGRAMA = f"""
SELECT CAST(30000 + p_size AS VARCHAR) AS COD_ORGAO_SUP_PROGRAMA,
 'ORGAO ' || CAST(30000 + p_size AS VARCHAR) AS DESC_ORGAO_SUP_PROGRAMA,
 CAST(p_partkey AS VARCHAR) AS ID_PROGRAMA, lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS COD_PROGRAMA,
 p_name || ' ' AS NOME_PROGRAMA,
 CASE WHEN p_partkey % 2 = 0 THEN 'DISPONIBILIZADO' ELSE 'INATIVO' END AS SIT_PROGRAMA,
 CASE WHEN p_partkey % 53 = 0 THEN '' WHEN p_partkey % 59 = 0 THEN '01/07/1900' ELSE {_brd('d')} END
  AS DATA_DISPONIBILIZACAO,
 CAST(year(d) AS VARCHAR) AS ANO_DISPONIBILIZACAO,
 {_brd('d')} AS DT_PROG_INI_RECEB_PROP, {_brd('d + 90')} AS DT_PROG_FIM_RECEB_PROP,
 CASE WHEN p_partkey % 3 = 0 THEN {_brd('d + 10')} END AS DT_PROG_INI_EMENDA_PAR,
 CASE WHEN p_partkey % 3 = 0 THEN {_brd('d + 40')} END AS DT_PROG_FIM_EMENDA_PAR,
 CAST(NULL AS VARCHAR) AS DT_PROG_INI_BENEF_ESP,
 CASE WHEN p_partkey % 67 = 0 THEN '15/05/0001' END AS DT_PROG_FIM_BENEF_ESP,
 'MOD ' || l_returnflag AS MODALIDADE_PROGRAMA, 'NAT ' || l_linestatus AS NATUREZA_JURIDICA_PROGRAMA,
 lower(['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS','MT','PA','PB','PE','PI','PR','RJ','RN',
  'RO','RR','RS','SC','SE','SP','TO'][l_suppkey % 27 + 1]) AS UF_PROGRAMA,
 lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS ACAO_ORCAMENTARIA,
 CAST(NULL AS VARCHAR) AS NOME_SUBTIPO_PROGRAMA, ' ' AS DESCRICAO_SUBTIPO_PROGRAMA,
 {LINEAGE}
FROM (SELECT *, DATE '1995-01-01' + CAST(p_partkey % 3650 AS INT) AS d
 FROM (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem)
 JOIN part ON l_partkey = p_partkey)
"""

RAW_PROGRAMA_PROPOSTA = f"""
SELECT CAST(l_partkey AS VARCHAR) AS ID_PROGRAMA,
 CAST(CASE WHEN l_orderkey % 997 = 0 THEN l_orderkey + 900000000 ELSE l_orderkey END AS VARCHAR) AS ID_PROPOSTA,
 {LINEAGE}
FROM lineitem
"""

RAW_CONVENIO = f"""
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS NR_CONVENIO, CAST(o_orderkey AS VARCHAR) AS ID_PROPOSTA,
 CAST(day(s) AS VARCHAR) AS DIA, CAST(month(s) AS VARCHAR) AS MES, CAST(year(s) AS VARCHAR) AS ANO,
 CASE WHEN o_orderkey % 91 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN '10/10/1900' ELSE {_brd('s')} END
  AS DIA_ASSIN_CONV,
 ['Em execução', 'Prestação de Contas Concluída', 'Aguardando Prestação de Contas', 'Cancelado'][o_orderkey % 4 + 1]
  AS SIT_CONVENIO,
 CAST(NULL AS VARCHAR) AS SUBSITUACAO_CONV,
 CASE WHEN o_orderkey % 6 = 0 THEN ' Publicado' ELSE 'Transferido' END AS SITUACAO_PUBLICACAO,
 CASE o_orderkey % 3 WHEN 0 THEN 'SIM' WHEN 1 THEN ' não ' ELSE 'Sim' END AS INSTRUMENTO_ATIVO,
 CASE o_orderkey % 5 WHEN 0 THEN 'NAO' WHEN 1 THEN 'NÃO' ELSE 'SIM' END AS IND_OPERA_OBTV,
 lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '/0001' AS NR_PROCESSO,
 lpad(CAST(o_custkey % 300 AS VARCHAR), 6, '0') AS UG_EMITENTE,
 {_brd('s + 5')} AS DIA_PUBL_CONV, {_brd('s')} AS DIA_INIC_VIGENC_CONV,
 {_brd('s + 730')} AS DIA_FIM_VIGENC_CONV, {_brd('s + 365')} AS DIA_FIM_VIGENC_ORIGINAL_CONV,
 CASE WHEN o_orderkey % 9 = 0 THEN '12.7' ELSE '60' END AS DIAS_PREST_CONTAS,
 CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE {_brd('s + 790')} END AS DIA_LIMITE_PREST_CONTAS,
 CASE WHEN o_orderkey % 8 = 0 THEN {_brd('s + 20')} END AS DATA_SUSPENSIVA,
 CASE WHEN o_orderkey % 16 = 0 THEN {_brd('s + 50')} END AS DATA_RETIRADA_SUSPENSIVA,
 CASE WHEN o_orderkey % 8 = 0 THEN CAST(o_orderkey % 270 AS VARCHAR) END AS DIAS_CLAUSULA_SUSPENSIVA,
 CASE WHEN o_orderkey % 2 = 0 THEN 'Normal' ELSE 'Cláusula Suspensiva' END AS SITUACAO_CONTRATACAO,
 'SIM' AS IND_ASSINADO, '' AS MOTIVO_SUSPENSAO,
 CASE WHEN o_orderkey % 2 = 0 THEN 'SIM' ELSE 'NÃO' END AS IND_FOTO,
 '1' AS QTDE_CONVENIOS, CAST(o_orderkey % 5 AS VARCHAR) AS QTD_TA, CAST(o_orderkey % 3 AS VARCHAR) AS QTD_PRORROGA,
 {_money('t', _C_SEP)} AS VL_GLOBAL_CONV,
 {_money('t * 9 // 10', _C_SEP)} AS VL_REPASSE_CONV,
 {_money('t - t * 9 // 10', _C_SEP)} AS VL_CONTRAPARTIDA_CONV,
 {_money('CASE WHEN o_orderkey % 107 = 0 THEN -(t * 3 // 5) ELSE t * 3 // 5 END', _C_SEP)} AS VL_EMPENHADO_CONV,
 {_money('t // 2', _C_SEP)} AS VL_DESEMBOLSADO_CONV,
 CASE WHEN o_orderkey % 3 = 0 THEN {_money('t // 50', _C_SEP)} END AS VL_SALDO_REMAN_TESOURO,
 CASE WHEN o_orderkey % 113 = 0 THEN '1.234,56' ELSE '0' END AS VL_SALDO_REMAN_CONVENENTE,
 {_money('t // 100', _C_SEP)} AS VL_RENDIMENTO_APLICACAO,
 {_money('t // 20', _C_SEP)} AS VL_INGRESSO_CONTRAPARTIDA,
 {_money('b', _C_SEP)} AS VL_SALDO_CONTA,
 {_money('t', _C_SEP)} AS VALOR_GLOBAL_ORIGINAL_CONV,
 {LINEAGE}
FROM (SELECT *, CAST(o_orderdate AS DATE) + 60 AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS t,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS b
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')
"""


# ---- typed columns ---------------------------------------------------------------------------------

def clean(c: str) -> str:
    return f"nullif(trim({c}), '')"


def dash(c: str) -> str:
    return f"CASE WHEN trim({c}) IN ('', '-') THEN NULL ELSE trim({c}) END"


def date(c: str) -> str:
    return f"CAST(try_strptime({clean(c)}, '%d/%m/%Y') AS DATE)"


def money(c: str) -> str:
    return f"TRY_CAST(replace({clean(c)}, ',', '.') AS DECIMAL(17,2))"


def flag(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) = 'SIM' THEN TRUE WHEN upper(trim({c})) = 'NÃO' THEN FALSE ELSE NULL END"


def whole(c: str, kind: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS {kind}) END"


def sha_key(columns: list[str]) -> str:
    parts = " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-1:' ELSE CAST(length({c}) AS VARCHAR) || ':' || {c} END" for c in columns
    )
    return f"sha256({parts})"


SILVER_PROPOSTA = f"""
SELECT {whole('ID_PROPOSTA', 'BIGINT')} AS id_proposta,
 upper({clean('UF_PROPONENTE')}) AS uf_proponente, {clean('MUNIC_PROPONENTE')} AS municipio_proponente,
 {clean('COD_MUNIC_IBGE')} AS codigo_municipio_ibge, {clean('COD_ORGAO_SUP')} AS codigo_orgao_superior,
 {clean('DESC_ORGAO_SUP')} AS descricao_orgao_superior, {clean('NATUREZA_JURIDICA')} AS natureza_juridica,
 {clean('NR_PROPOSTA')} AS numero_proposta,
 {whole('DIA_PROP', 'SMALLINT')} AS dia_proposta, {whole('MES_PROP', 'SMALLINT')} AS mes_proposta,
 {whole('ANO_PROP', 'SMALLINT')} AS ano_proposta, {date('DIA_PROPOSTA')} AS data_proposta,
 {clean('COD_ORGAO')} AS codigo_orgao, {clean('DESC_ORGAO')} AS descricao_orgao, {clean('MODALIDADE')} AS modalidade,
 {clean('IDENTIF_PROPONENTE')} AS identificacao_proponente, {clean('NM_PROPONENTE')} AS nome_proponente,
 {clean('CEP_PROPONENTE')} AS cep_proponente, {clean('ENDERECO_PROPONENTE')} AS endereco_proponente,
 {clean('BAIRRO_PROPONENTE')} AS bairro_proponente, {clean('NM_BANCO')} AS nome_banco,
 {clean('SITUACAO_CONTA')} AS situacao_conta, {clean('SITUACAO_PROJETO_BASICO')} AS situacao_projeto_basico,
 {clean('SIT_PROPOSTA')} AS situacao_proposta,
 {date('DIA_INIC_VIGENCIA_PROPOSTA')} AS data_inicio_vigencia_proposta,
 {date('DIA_FIM_VIGENCIA_PROPOSTA')} AS data_fim_vigencia_proposta,
 {dash('OBJETO_PROPOSTA')} AS objeto_proposta, {clean('ITEM_INVESTIMENTO')} AS item_investimento,
 {clean('ENVIADA_MANDATARIA')} AS enviada_mandataria, {clean('NOME_SUBTIPO_PROPOSTA')} AS nome_subtipo_proposta,
 {clean('DESCRICAO_SUBTIPO_PROPOSTA')} AS descricao_subtipo_proposta,
 {money('VL_GLOBAL_PROP')} AS valor_global_proposta, {money('VL_REPASSE_PROP')} AS valor_repasse_proposta,
 {money('VL_CONTRAPARTIDA_PROP')} AS valor_contrapartida_proposta,
 {dash('CD_AGENCIA')} AS codigo_agencia, {clean('CD_CONTA')} AS codigo_conta, {LINEAGE_NAMES}
FROM raw_proposta
"""

SILVER_PROGRAMA_ELEGIBILIDADE = f"""
SELECT {sha_key(['ID_PROGRAMA', 'MODALIDADE_PROGRAMA', 'NATUREZA_JURIDICA_PROGRAMA', 'UF_PROGRAMA',
                 'ACAO_ORCAMENTARIA'])} AS id_programa_elegibilidade,
 {whole('ID_PROGRAMA', 'BIGINT')} AS id_programa,
 {clean('COD_ORGAO_SUP_PROGRAMA')} AS codigo_orgao_superior_programa,
 {clean('DESC_ORGAO_SUP_PROGRAMA')} AS descricao_orgao_superior_programa,
 {clean('COD_PROGRAMA')} AS codigo_programa, {clean('NOME_PROGRAMA')} AS nome_programa,
 {clean('SIT_PROGRAMA')} AS situacao_programa, {date('DATA_DISPONIBILIZACAO')} AS data_disponibilizacao,
 {whole('ANO_DISPONIBILIZACAO', 'SMALLINT')} AS ano_disponibilizacao,
 {date('DT_PROG_INI_RECEB_PROP')} AS data_inicio_recebimento_proposta,
 {date('DT_PROG_FIM_RECEB_PROP')} AS data_fim_recebimento_proposta,
 {date('DT_PROG_INI_EMENDA_PAR')} AS data_inicio_emenda_parlamentar,
 {date('DT_PROG_FIM_EMENDA_PAR')} AS data_fim_emenda_parlamentar,
 {date('DT_PROG_INI_BENEF_ESP')} AS data_inicio_beneficiario_especifico,
 {date('DT_PROG_FIM_BENEF_ESP')} AS data_fim_beneficiario_especifico,
 {clean('MODALIDADE_PROGRAMA')} AS modalidade_programa,
 {clean('NATUREZA_JURIDICA_PROGRAMA')} AS natureza_juridica_programa,
 upper({clean('UF_PROGRAMA')}) AS uf_programa, {clean('ACAO_ORCAMENTARIA')} AS acao_orcamentaria,
 {clean('NOME_SUBTIPO_PROGRAMA')} AS nome_subtipo_programa,
 {clean('DESCRICAO_SUBTIPO_PROGRAMA')} AS descricao_subtipo_programa, {LINEAGE_NAMES}
FROM raw_programa
"""

SILVER_PROGRAMA_CADASTRAL = f"""
SELECT DISTINCT id_programa, codigo_orgao_superior_programa, descricao_orgao_superior_programa, codigo_programa,
 nome_programa, situacao_programa, data_disponibilizacao, ano_disponibilizacao, {LINEAGE_NAMES}
FROM silver_programa_elegibilidade
"""

SILVER_PROGRAMA_PROPOSTA = f"""
SELECT {whole('ID_PROGRAMA', 'BIGINT')} AS id_programa, {whole('ID_PROPOSTA', 'BIGINT')} AS id_proposta,
 {LINEAGE_NAMES}
FROM raw_programa_proposta
"""

CONVENIO_RAW_COLUMNS = (
    "NR_CONVENIO ID_PROPOSTA DIA MES ANO DIA_ASSIN_CONV SIT_CONVENIO SUBSITUACAO_CONV SITUACAO_PUBLICACAO "
    "INSTRUMENTO_ATIVO IND_OPERA_OBTV NR_PROCESSO UG_EMITENTE DIA_PUBL_CONV DIA_INIC_VIGENC_CONV "
    "DIA_FIM_VIGENC_CONV DIA_FIM_VIGENC_ORIGINAL_CONV DIAS_PREST_CONTAS DIA_LIMITE_PREST_CONTAS DATA_SUSPENSIVA "
    "DATA_RETIRADA_SUSPENSIVA DIAS_CLAUSULA_SUSPENSIVA SITUACAO_CONTRATACAO IND_ASSINADO MOTIVO_SUSPENSAO IND_FOTO "
    "QTDE_CONVENIOS QTD_TA QTD_PRORROGA VL_GLOBAL_CONV VL_REPASSE_CONV VL_CONTRAPARTIDA_CONV VL_EMPENHADO_CONV "
    "VL_DESEMBOLSADO_CONV VL_SALDO_REMAN_TESOURO VL_SALDO_REMAN_CONVENENTE VL_RENDIMENTO_APLICACAO "
    "VL_INGRESSO_CONTRAPARTIDA VL_SALDO_CONTA VALOR_GLOBAL_ORIGINAL_CONV"
).split()

SILVER_CONVENIO = f"""
SELECT {sha_key(CONVENIO_RAW_COLUMNS)} AS id_convenio_observacao,
 {clean('NR_CONVENIO')} AS numero_convenio, {whole('ID_PROPOSTA', 'BIGINT')} AS id_proposta,
 {whole('DIA', 'SMALLINT')} AS dia_assinatura, {whole('MES', 'SMALLINT')} AS mes_assinatura,
 {whole('ANO', 'SMALLINT')} AS ano_assinatura, {date('DIA_ASSIN_CONV')} AS data_assinatura_convenio,
 {clean('SIT_CONVENIO')} AS situacao_convenio, {clean('SUBSITUACAO_CONV')} AS subsituacao_convenio,
 {clean('SITUACAO_PUBLICACAO')} AS situacao_publicacao,
 {flag('INSTRUMENTO_ATIVO')} AS is_instrumento_ativo, {flag('IND_OPERA_OBTV')} AS is_opera_obtv,
 {clean('NR_PROCESSO')} AS numero_processo, {clean('UG_EMITENTE')} AS unidade_gestora_emitente,
 {date('DIA_PUBL_CONV')} AS data_publicacao_convenio, {date('DIA_INIC_VIGENC_CONV')} AS data_inicio_vigencia_convenio,
 {date('DIA_FIM_VIGENC_CONV')} AS data_fim_vigencia_convenio,
 {date('DIA_FIM_VIGENC_ORIGINAL_CONV')} AS data_fim_vigencia_original,
 {whole('DIAS_PREST_CONTAS', 'INTEGER')} AS dias_prestacao_contas,
 {date('DIA_LIMITE_PREST_CONTAS')} AS data_limite_prestacao_contas, {date('DATA_SUSPENSIVA')} AS data_suspensiva,
 {date('DATA_RETIRADA_SUSPENSIVA')} AS data_retirada_suspensiva,
 {whole('DIAS_CLAUSULA_SUSPENSIVA', 'INTEGER')} AS dias_clausula_suspensiva,
 {clean('SITUACAO_CONTRATACAO')} AS situacao_contratacao, {flag('IND_ASSINADO')} AS is_assinado,
 {clean('MOTIVO_SUSPENSAO')} AS motivo_suspensao, {flag('IND_FOTO')} AS is_foto,
 {whole('QTDE_CONVENIOS', 'SMALLINT')} AS quantidade_convenios,
 {whole('QTD_TA', 'SMALLINT')} AS quantidade_termos_aditivos,
 {whole('QTD_PRORROGA', 'SMALLINT')} AS quantidade_prorrogacoes,
 {money('VL_GLOBAL_CONV')} AS valor_global_convenio, {money('VL_REPASSE_CONV')} AS valor_repasse_convenio,
 {money('VL_CONTRAPARTIDA_CONV')} AS valor_contrapartida_convenio,
 {money('VL_EMPENHADO_CONV')} AS valor_empenhado_convenio,
 {money('VL_DESEMBOLSADO_CONV')} AS valor_desembolsado_convenio,
 {money('VL_SALDO_REMAN_TESOURO')} AS valor_saldo_remanescente_tesouro,
 {money('VL_SALDO_REMAN_CONVENENTE')} AS valor_saldo_remanescente_convenente,
 {money('VL_RENDIMENTO_APLICACAO')} AS valor_rendimento_aplicacao,
 {money('VL_INGRESSO_CONTRAPARTIDA')} AS valor_ingresso_contrapartida,
 {money('VL_SALDO_CONTA')} AS valor_saldo_conta,
 {money('VALOR_GLOBAL_ORIGINAL_CONV')} AS valor_global_original_convenio,
 count(*) OVER (PARTITION BY NR_CONVENIO) AS source_conflict_count,
 count(*) OVER (PARTITION BY NR_CONVENIO) > 1 AS has_source_conflict, {LINEAGE_NAMES}
FROM raw_convenio
"""


# ---- star schema -----------------------------------------------------------------------------------

def sk(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN -1 WHEN {c} < DATE '1990-01-01' OR {c} > DATE '2050-12-31' THEN -2 "
        f"ELSE CAST(strftime({c}, '%Y%m%d') AS INTEGER) END"
    )


DIM_DATA = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS data_sk, d AS data, CAST(year(d) AS INTEGER) AS ano,
 CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, CAST(quarter(d) AS INTEGER) AS trimestre,
 CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre, CAST(dayofweek(d) + 1 AS INTEGER) AS dia_semana,
 ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro',
  'Novembro', 'Dezembro'][month(d)] AS nome_mes, dayofweek(d) IN (0, 6) AS is_fim_de_semana
FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2050-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Não Informado', NULL
UNION ALL SELECT -2, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Fora da Janela Analítica', NULL
"""
DIM_PROPONENTE = """
SELECT DISTINCT identificacao_proponente, nome_proponente, codigo_municipio_ibge, municipio_proponente,
 uf_proponente, cep_proponente, endereco_proponente, bairro_proponente, natureza_juridica FROM silver_proposta
"""
DIM_MUNICIPIO = """
SELECT DISTINCT codigo_municipio_ibge, municipio_proponente AS nome_municipio, uf_proponente AS sigla_uf
FROM silver_proposta
"""
DIM_ORGAO = """
SELECT codigo_orgao, descricao_orgao, bool_or(sup) AS is_orgao_superior, bool_or(conc) AS is_orgao_concedente
FROM (SELECT codigo_orgao_superior AS codigo_orgao, descricao_orgao_superior AS descricao_orgao, TRUE AS sup,
  FALSE AS conc FROM silver_proposta
 UNION ALL SELECT codigo_orgao, descricao_orgao, FALSE, TRUE FROM silver_proposta
 UNION ALL SELECT codigo_orgao_superior_programa, descricao_orgao_superior_programa, TRUE, FALSE
  FROM silver_programa_cadastral)
GROUP BY codigo_orgao, descricao_orgao
"""
DIM_PROGRAMA = f"""
SELECT id_programa, codigo_programa, nome_programa, situacao_programa, ano_disponibilizacao,
 codigo_orgao_superior_programa, {sk('data_disponibilizacao')} AS data_disponibilizacao_sk
FROM silver_programa_cadastral
"""
FCT_PROPOSTA = f"""
SELECT id_proposta, identificacao_proponente, codigo_municipio_ibge, codigo_orgao_superior, codigo_orgao,
 {sk('data_proposta')} AS data_proposta_sk,
 {sk('data_inicio_vigencia_proposta')} AS data_inicio_vigencia_proposta_sk,
 {sk('data_fim_vigencia_proposta')} AS data_fim_vigencia_proposta_sk,
 numero_proposta, modalidade, situacao_proposta, objeto_proposta, nome_subtipo_proposta,
 descricao_subtipo_proposta, CAST(1 AS INTEGER) AS quantidade_propostas,
 valor_global_proposta, valor_repasse_proposta, valor_contrapartida_proposta
FROM silver_proposta
"""
STABLE = """numero_convenio, id_proposta, data_assinatura_convenio, data_publicacao_convenio,
 data_inicio_vigencia_convenio, data_fim_vigencia_convenio, data_limite_prestacao_contas, situacao_convenio,
 subsituacao_convenio, situacao_publicacao, situacao_contratacao, is_instrumento_ativo, is_opera_obtv, is_assinado,
 numero_processo, unidade_gestora_emitente, quantidade_termos_aditivos, quantidade_prorrogacoes,
 valor_global_convenio, valor_repasse_convenio, valor_contrapartida_convenio, valor_empenhado_convenio,
 valor_desembolsado_convenio, valor_saldo_remanescente_tesouro, valor_saldo_remanescente_convenente,
 valor_rendimento_aplicacao, valor_ingresso_contrapartida, valor_global_original_convenio"""
FCT_CONVENIO = f"""
SELECT numero_convenio, id_proposta, {sk('data_assinatura_convenio')} AS data_assinatura_sk,
 {sk('data_publicacao_convenio')} AS data_publicacao_sk,
 {sk('data_inicio_vigencia_convenio')} AS data_inicio_vigencia_sk,
 {sk('data_fim_vigencia_convenio')} AS data_fim_vigencia_sk,
 {sk('data_limite_prestacao_contas')} AS data_limite_prestacao_contas_sk,
 situacao_convenio, subsituacao_convenio, situacao_publicacao, situacao_contratacao, is_instrumento_ativo,
 is_opera_obtv, is_assinado, numero_processo, unidade_gestora_emitente, CAST(1 AS INTEGER) AS quantidade_convenios,
 quantidade_termos_aditivos, quantidade_prorrogacoes, valor_global_convenio, valor_repasse_convenio,
 valor_contrapartida_convenio, valor_empenhado_convenio, valor_desembolsado_convenio,
 valor_saldo_remanescente_tesouro, valor_saldo_remanescente_convenente, valor_rendimento_aplicacao,
 valor_ingresso_contrapartida, valor_global_original_convenio
FROM (SELECT DISTINCT {STABLE} FROM silver_convenio)
"""
FCT_SALDO = f"""
SELECT id_convenio_observacao, numero_convenio, valor_saldo_conta, source_conflict_count, has_source_conflict,
 {LINEAGE_NAMES} FROM silver_convenio
"""
BRIDGE = "SELECT id_programa, id_proposta FROM silver_programa_proposta"
VIEW = """
SELECT p.id_proposta, p.numero_proposta, dp.data AS data_proposta, dp.ano AS ano_proposta, dp.mes AS mes_proposta,
 p.identificacao_proponente, pr.nome_proponente, p.codigo_municipio_ibge, m.nome_municipio AS municipio,
 m.sigla_uf AS uf, p.codigo_orgao_superior, os.descricao_orgao AS orgao_superior,
 p.codigo_orgao AS codigo_orgao_concedente, oc.descricao_orgao AS orgao_concedente, p.modalidade,
 p.situacao_proposta, p.valor_global_proposta, p.valor_repasse_proposta, p.valor_contrapartida_proposta,
 c.numero_convenio IS NOT NULL AS tem_convenio, c.numero_convenio, da.data AS data_assinatura,
 da.ano AS ano_assinatura, c.situacao_convenio, c.is_instrumento_ativo, c.valor_global_convenio,
 c.valor_repasse_convenio, c.valor_empenhado_convenio, c.valor_desembolsado_convenio
FROM fct_proposta p
LEFT JOIN dim_proponente pr ON p.identificacao_proponente = pr.identificacao_proponente
LEFT JOIN dim_municipio m ON p.codigo_municipio_ibge = m.codigo_municipio_ibge
LEFT JOIN dim_orgao os ON p.codigo_orgao_superior = os.codigo_orgao
LEFT JOIN dim_orgao oc ON p.codigo_orgao = oc.codigo_orgao
LEFT JOIN dim_data dp ON p.data_proposta_sk = dp.data_sk
LEFT JOIN fct_convenio c ON p.id_proposta = c.id_proposta
LEFT JOIN dim_data da ON c.data_assinatura_sk = da.data_sk
"""

TABLES = {
    "raw_proposta": RAW_PROPOSTA,
    "raw_programa": RAW_PROGRAMA,
    "raw_programa_proposta": RAW_PROGRAMA_PROPOSTA,
    "raw_convenio": RAW_CONVENIO,
    "silver_proposta": SILVER_PROPOSTA,
    "silver_programa_elegibilidade": SILVER_PROGRAMA_ELEGIBILIDADE,
    "silver_programa_cadastral": SILVER_PROGRAMA_CADASTRAL,
    "silver_programa_proposta": SILVER_PROGRAMA_PROPOSTA,
    "silver_convenio": SILVER_CONVENIO,
    "dim_data": DIM_DATA,
    "dim_proponente": DIM_PROPONENTE,
    "dim_municipio": DIM_MUNICIPIO,
    "dim_orgao": DIM_ORGAO,
    "dim_programa": DIM_PROGRAMA,
    "fct_proposta": FCT_PROPOSTA,
    "fct_convenio": FCT_CONVENIO,
    "fct_convenio_saldo_observacao": FCT_SALDO,
    "bridge_programa_proposta": BRIDGE,
    "mart": VIEW,
}


def with_tables(sql: str) -> str:
    """Prefixes a query with the tables it names, and those they name, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    # window counts and text keys are read several times, so the engine is told to keep them
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n].strip()})" for n in needed)
    rest = sql.strip()
    if rest[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{rest[5:]}"
    return f"WITH {ctes}\n{rest}"
