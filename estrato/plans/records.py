"""Raw record layouts and how each column is typed."""

from __future__ import annotations

from estrato.operators.typing import fields_from_text

# Lineage columns every raw and typed row carries.
LINEAGE = ("__ingested_at_utc", "__ingestion_run_id", "__source_file", "__source_sha256")

# Output column, raw column, kind, in record order.
PROPOSTA = fields_from_text("""
id_proposta                     ID_PROPOSTA                 long
uf_proponente                   UF_PROPONENTE               upper
municipio_proponente            MUNIC_PROPONENTE            text
codigo_municipio_ibge           COD_MUNIC_IBGE              text
codigo_orgao_superior           COD_ORGAO_SUP               text
descricao_orgao_superior        DESC_ORGAO_SUP              text
natureza_juridica               NATUREZA_JURIDICA           text
numero_proposta                 NR_PROPOSTA                 text
dia_proposta                    DIA_PROP                    short
mes_proposta                    MES_PROP                    short
ano_proposta                    ANO_PROP                    short
data_proposta                   DIA_PROPOSTA                date
codigo_orgao                    COD_ORGAO                   text
descricao_orgao                 DESC_ORGAO                  text
modalidade                      MODALIDADE                  text
identificacao_proponente        IDENTIF_PROPONENTE          text
nome_proponente                 NM_PROPONENTE               text
cep_proponente                  CEP_PROPONENTE              text
endereco_proponente             ENDERECO_PROPONENTE         text
bairro_proponente               BAIRRO_PROPONENTE           text
nome_banco                      NM_BANCO                    text
situacao_conta                  SITUACAO_CONTA              text
situacao_projeto_basico         SITUACAO_PROJETO_BASICO     text
situacao_proposta               SIT_PROPOSTA                text
data_inicio_vigencia_proposta   DIA_INIC_VIGENCIA_PROPOSTA  date
data_fim_vigencia_proposta      DIA_FIM_VIGENCIA_PROPOSTA   date
objeto_proposta                 OBJETO_PROPOSTA             dash
item_investimento               ITEM_INVESTIMENTO           text
enviada_mandataria              ENVIADA_MANDATARIA          text
nome_subtipo_proposta           NOME_SUBTIPO_PROPOSTA       text
descricao_subtipo_proposta      DESCRICAO_SUBTIPO_PROPOSTA  text
valor_global_proposta           VL_GLOBAL_PROP              money
valor_repasse_proposta          VL_REPASSE_PROP             money
valor_contrapartida_proposta    VL_CONTRAPARTIDA_PROP       money
codigo_agencia                  CD_AGENCIA                  dash
codigo_conta                    CD_CONTA                    text
""")

PROGRAMA = fields_from_text("""
id_programa                          ID_PROGRAMA                 long
codigo_orgao_superior_programa       COD_ORGAO_SUP_PROGRAMA      text
descricao_orgao_superior_programa    DESC_ORGAO_SUP_PROGRAMA     text
codigo_programa                      COD_PROGRAMA                text
nome_programa                        NOME_PROGRAMA               text
situacao_programa                    SIT_PROGRAMA                text
data_disponibilizacao                DATA_DISPONIBILIZACAO       date
ano_disponibilizacao                 ANO_DISPONIBILIZACAO        short
data_inicio_recebimento_proposta     DT_PROG_INI_RECEB_PROP      date
data_fim_recebimento_proposta        DT_PROG_FIM_RECEB_PROP      date
data_inicio_emenda_parlamentar       DT_PROG_INI_EMENDA_PAR      date
data_fim_emenda_parlamentar          DT_PROG_FIM_EMENDA_PAR      date
data_inicio_beneficiario_especifico  DT_PROG_INI_BENEF_ESP       date
data_fim_beneficiario_especifico     DT_PROG_FIM_BENEF_ESP       date
modalidade_programa                  MODALIDADE_PROGRAMA         text
natureza_juridica_programa           NATUREZA_JURIDICA_PROGRAMA  text
uf_programa                          UF_PROGRAMA                 upper
acao_orcamentaria                    ACAO_ORCAMENTARIA           text
nome_subtipo_programa                NOME_SUBTIPO_PROGRAMA       text
descricao_subtipo_programa           DESCRICAO_SUBTIPO_PROGRAMA  text
""")

PROGRAMA_PROPOSTA = fields_from_text("""
id_programa  ID_PROGRAMA  long
id_proposta  ID_PROPOSTA  long
""")

CONVENIO = fields_from_text("""
numero_convenio                      NR_CONVENIO                  text
id_proposta                          ID_PROPOSTA                  long
dia_assinatura                       DIA                          short
mes_assinatura                       MES                          short
ano_assinatura                       ANO                          short
data_assinatura_convenio             DIA_ASSIN_CONV               date
situacao_convenio                    SIT_CONVENIO                 text
subsituacao_convenio                 SUBSITUACAO_CONV             text
situacao_publicacao                  SITUACAO_PUBLICACAO          text
is_instrumento_ativo                 INSTRUMENTO_ATIVO            flag
is_opera_obtv                        IND_OPERA_OBTV               flag
numero_processo                      NR_PROCESSO                  text
unidade_gestora_emitente             UG_EMITENTE                  text
data_publicacao_convenio             DIA_PUBL_CONV                date
data_inicio_vigencia_convenio        DIA_INIC_VIGENC_CONV         date
data_fim_vigencia_convenio           DIA_FIM_VIGENC_CONV          date
data_fim_vigencia_original           DIA_FIM_VIGENC_ORIGINAL_CONV date
dias_prestacao_contas                DIAS_PREST_CONTAS            int
data_limite_prestacao_contas         DIA_LIMITE_PREST_CONTAS      date
data_suspensiva                      DATA_SUSPENSIVA              date
data_retirada_suspensiva             DATA_RETIRADA_SUSPENSIVA     date
dias_clausula_suspensiva             DIAS_CLAUSULA_SUSPENSIVA     int
situacao_contratacao                 SITUACAO_CONTRATACAO         text
is_assinado                          IND_ASSINADO                 flag
motivo_suspensao                     MOTIVO_SUSPENSAO             text
is_foto                              IND_FOTO                     flag
quantidade_convenios                 QTDE_CONVENIOS               short
quantidade_termos_aditivos           QTD_TA                       short
quantidade_prorrogacoes              QTD_PRORROGA                 short
valor_global_convenio                VL_GLOBAL_CONV               money
valor_repasse_convenio               VL_REPASSE_CONV              money
valor_contrapartida_convenio         VL_CONTRAPARTIDA_CONV        money
valor_empenhado_convenio             VL_EMPENHADO_CONV            money
valor_desembolsado_convenio          VL_DESEMBOLSADO_CONV         money
valor_saldo_remanescente_tesouro     VL_SALDO_REMAN_TESOURO       money
valor_saldo_remanescente_convenente  VL_SALDO_REMAN_CONVENENTE    money
valor_rendimento_aplicacao           VL_RENDIMENTO_APLICACAO      money
valor_ingresso_contrapartida         VL_INGRESSO_CONTRAPARTIDA    money
valor_saldo_conta                    VL_SALDO_CONTA               money
valor_global_original_convenio       VALOR_GLOBAL_ORIGINAL_CONV   money
""")

# The raw columns that identify one eligibility rule, in hash order.
ELIGIBILITY_KEY = (
    "ID_PROGRAMA", "MODALIDADE_PROGRAMA", "NATUREZA_JURIDICA_PROGRAMA", "UF_PROGRAMA", "ACAO_ORCAMENTARIA",
)
ELIGIBILITY_SUPERKEY = (
    "id_programa", "modalidade_programa", "natureza_juridica_programa", "uf_programa", "acao_orcamentaria",
)
PROGRAM_ATTRIBUTES = (
    "id_programa", "codigo_orgao_superior_programa", "descricao_orgao_superior_programa", "codigo_programa",
    "nome_programa", "situacao_programa", "data_disponibilizacao", "ano_disponibilizacao",
)
PROPONENT_COLUMNS = (
    "identificacao_proponente", "nome_proponente", "codigo_municipio_ibge", "municipio_proponente",
    "uf_proponente", "cep_proponente", "endereco_proponente", "bairro_proponente", "natureza_juridica",
)
# Agreement columns that must agree between observations of one agreement.
CONVENIO_STABLE = (
    "numero_convenio", "id_proposta",
    "data_assinatura_convenio", "data_publicacao_convenio", "data_inicio_vigencia_convenio",
    "data_fim_vigencia_convenio", "data_limite_prestacao_contas",
    "situacao_convenio", "subsituacao_convenio", "situacao_publicacao", "situacao_contratacao",
    "is_instrumento_ativo", "is_opera_obtv", "is_assinado", "numero_processo", "unidade_gestora_emitente",
    "quantidade_termos_aditivos", "quantidade_prorrogacoes",
    "valor_global_convenio", "valor_repasse_convenio", "valor_contrapartida_convenio",
    "valor_empenhado_convenio", "valor_desembolsado_convenio", "valor_saldo_remanescente_tesouro",
    "valor_saldo_remanescente_convenente", "valor_rendimento_aplicacao", "valor_ingresso_contrapartida",
    "valor_global_original_convenio",
)
PROPOSTA_MONEY = ("valor_global_proposta", "valor_repasse_proposta", "valor_contrapartida_proposta")
CONVENIO_MONEY = (
    "valor_global_convenio", "valor_repasse_convenio", "valor_contrapartida_convenio",
    "valor_empenhado_convenio", "valor_desembolsado_convenio", "valor_saldo_remanescente_tesouro",
    "valor_saldo_remanescente_convenente", "valor_rendimento_aplicacao", "valor_ingresso_contrapartida",
    "valor_global_original_convenio",
)
# Federation units, mandatory-agent answers, known bridge orphans.
UF_CODES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
MANDATARIA_VALUES = ("SIM", "NÃO", "NÃO APLICÁVEL")
KNOWN_ORPHAN_PROPOSALS = (321453, 1427146, 296629)
# Columns that may never appear on the program bridge.
BRIDGE_FORBIDDEN = (
    "valor_global_proposta", "valor_repasse_proposta", "valor_contrapartida_proposta",
    "valor_global_convenio", "valor_repasse_convenio", "valor_contrapartida_convenio",
    "valor_alocado", "valor_saldo_conta", "peso", "percentual", "rateio", "valor", "share",
)
