"""A cross-section of the registered queries against the checking engine, on the smallest tables."""

import math
import os

import duckdb
import pytest

from suite import all_queries

SF = "/root/testdata/sf0.001"
NAMES = [
    "proposals_and_agreements_by_year", "semantic_view", "silver_convenio", "gold_dim_orgao", "metrics_by_uf",
    "chart_agreements_by_body", "filter_selector_values", "all_filters_on_agreements_by_body", "all_filters_on_kpi_proposed_value",
    "benchmark_q3_proposals_by_year_mart_written", "ledger_change_decisions", "ledger_local_state", "strict_read_of_orders", "file_contract_findings", "gate_key_uniqueness", "gate_agreement_money",
    "contract_on_line_items", "profile_columns_convenio", "agreement_column_stability", "money_inflation",
    "two_row_agreement_differences", "gate_money", "gate_money_with_thousands", "gate_parse_losses", "gate_date_mapping", "conflict_flag_consistency",
    "presence_flag_of_mart", "ledger_active_snapshots", "ledger_retention_plan", "fn_dates", "salted_left_join",
]


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, engine, name):
    reg = all_queries()
    df = reg.queries[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    cursor = engine.execute(reg.sql[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=str)
    assert ours == theirs


def test_every_query_has_sql():
    reg = all_queries()
    assert set(reg.queries) == set(reg.sql)
