import pytest
from pyspark.sql import functions as F

from estrato.plans import build as BUILD
from estrato.plans import checks as C
from estrato.plans import dashboard as B
from estrato.plans import layers as L
from suite.raw_tables import raw_tables

SF = "/root/testdata/sf0.001"
# the derived raw tables hold impossible dates and broken numbers on purpose
ALLOWED = {"proposta.ano_proposta": 0.05, "proposta.data_proposta": 0.05,
           "convenio.dias_prestacao_contas": 0.2, "convenio.valor_saldo_remanescente_convenente": 0.05}


@pytest.fixture(scope="module")
def clean_raw(spark):
    """The derived raw tables with links that name existing proposals, each once."""
    raw = dict(raw_tables(spark, SF))
    raw["programa_proposta"] = raw["programa_proposta"].filter(F.col("ID_PROPOSTA").cast("bigint") < 900000000).distinct()
    # "NAO" is no flag value, and the silver contract wants one on every row
    raw["convenio"] = raw["convenio"].withColumn("IND_OPERA_OBTV", F.regexp_replace("IND_OPERA_OBTV", "^NAO$", "NÃO"))
    return raw


@pytest.fixture(scope="module")
def built(spark, clean_raw, tmp_path_factory):
    return BUILD.build_all(spark, clean_raw, str(tmp_path_factory.mktemp("layers")), allowed_losses=ALLOWED)


def test_all_gates_pass_and_a_second_build_is_the_same(spark, built, clean_raw, tmp_path):
    again = BUILD.build_all(spark, clean_raw, str(tmp_path), gates=False)
    for name in built["gold"]:
        a, b = built["gold"][name], again["gold"][name]
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_mart_and_pruned_view_answer_alike(built):
    for name, chart in B.BENCHMARK.items():
        mart = [tuple(r) for r in chart.run(built["mart"]).collect()]
        pruned = [tuple(r) for r in chart.run(L.proposta_convenio_view(built["gold"], B.chart_columns(chart))).collect()]
        distinct = [tuple(r) for r in chart.run(L.proposta_convenio_view(built["gold"]), keys_proven=False).collect()]
        assert mart == pruned == distinct, name


def test_pruned_view_makes_only_the_joins_it_needs(built):
    def joins(columns):
        plan = L.proposta_convenio_view(built["gold"], columns)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join ")

    assert joins(["id_proposta"]) == 0
    assert joins(["uf"]) == 1
    assert joins(["ano_assinatura"]) == 2
    assert joins(None) == 7


def test_a_lost_row_fails_the_gates(spark, clean_raw, built):
    damaged = {**built["silver"], "proposta": built["silver"]["proposta"].filter("id_proposta <> 3")}
    with pytest.raises(BUILD.GateFailure, match="row_counts: proposta"):
        BUILD.require(spark, C.raw_to_silver_gates(clean_raw, damaged))


def test_baseline_mode(spark, clean_raw, built):
    from estrato.operators import quality as Q

    rows = C.raw_row_counts(clean_raw, built["silver"])
    judged = Q.with_baseline(rows, C.published_baseline(spark))
    assert {r["status"] for r in judged.collect()} == {"FAIL"}
    assert {r["status"] for r in rows.collect()} == {"PASS"}


def test_orphan_set_equality(spark, built):
    silver = {**built["silver"], "programa_proposta": spark.createDataFrame([(1, -5), (1, -6), (1, 1)], "id_programa bigint, id_proposta bigint")}
    assert C.orphan_set_equality(silver, [-5, -6], spark).isEmpty()
    assert {(r["id_proposta"], r["side"]) for r in C.orphan_set_equality(silver, [-5, -7], spark).collect()} == {(-6, "unexpected"), (-7, "missing")}


def test_an_amount_that_the_parser_drops_fails_the_money_gate_and_the_loss_gate(spark, clean_raw, built):
    damaged = {**clean_raw, "convenio": clean_raw["convenio"].withColumn(
        "VL_GLOBAL_CONV", F.when(F.col("NR_CONVENIO") == F.lit(clean_raw["convenio"].first()["NR_CONVENIO"]), "1.234,56").otherwise(F.col("VL_GLOBAL_CONV")))}
    silver = {**built["silver"], "convenio": L.silver_tables(damaged)["convenio"]}
    failed = {r["item"] for r in C.raw_money(damaged, silver).collect() if r["status"] == "FAIL"}
    assert failed == {"valor_global_convenio"}
    lost = {r["item"] for r in C.parse_losses_gate(damaged, ALLOWED).collect() if r["status"] == "FAIL"}
    assert lost == {"convenio.valor_global_convenio"}
    assert {r["status"] for r in C.parse_losses_gate(clean_raw, ALLOWED).collect()} == {"PASS"}
    with pytest.raises(BUILD.GateFailure, match="parse_losses: convenio.dias_prestacao_contas"):
        BUILD.require(spark, C.raw_to_silver_gates(clean_raw, built["silver"]))


def test_a_wrong_or_missing_date_key_fails_the_mapping_gate(built):
    fact = built["gold"]["fct_proposta"]
    wrong = fact.withColumn("data_proposta_sk", F.when(F.col("id_proposta") == 3, F.lit(20000101)).otherwise(F.col("data_proposta_sk")))
    for broken in (wrong, fact.filter("id_proposta <> 3"), fact.union(wrong.filter("id_proposta = 3"))):
        rows = C.date_mapping_gate(built["silver"], {**built["gold"], "fct_proposta": broken}).collect()
        assert "fct_proposta.data_proposta_sk" in {r["item"] for r in rows if r["status"] == "FAIL"}
    assert {r["status"] for r in C.date_mapping_gate(built["silver"], built["gold"]).collect()} == {"PASS"}


def test_a_broken_contract_fails_the_build_gates(spark, built):
    doubled = built["gold"]["dim_proponente"].union(built["gold"]["dim_proponente"].limit(1))
    with pytest.raises(BUILD.GateFailure, match="gold_contracts: dim_proponente unique"):
        BUILD.require(spark, {"c": lambda: C.contracts_gate({**built["gold"], "dim_proponente": doubled}, C.GOLD_CONTRACTS, "gold")})


def test_baseline_mode_of_the_build(spark, clean_raw, tmp_path):
    with pytest.raises(BUILD.GateFailure, match="row_counts: proposta"):
        BUILD.build_all(spark, clean_raw, str(tmp_path), allowed_losses=ALLOWED, baseline=C.published_baseline(spark))


def test_schema_location_gate(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS placed")
    from estrato.sources.catalog import schema_location

    place = schema_location(spark, "placed")
    assert [r["status"] for r in C.location_gate(spark, "placed", place).collect()] == ["PASS"]
    assert [r["status"] for r in C.location_gate(spark, "placed", place + "/elsewhere").collect()] == ["FAIL"]
    spark.sql("DROP SCHEMA placed")


def test_a_repeated_dimension_key_raises_unless_its_role_is_not_needed(built):
    doubled = {**built["gold"], "dim_municipio": built["gold"]["dim_municipio"].unionByName(built["gold"]["dim_municipio"])}
    with pytest.raises(Exception, match="town: repeated key"):
        L.proposta_convenio_view(doubled, ["id_proposta", "uf"]).collect()
    plain = L.proposta_convenio_view(built["gold"], ["id_proposta", "nome_proponente"])
    assert plain.exceptAll(L.proposta_convenio_view(doubled, ["id_proposta", "nome_proponente"])).isEmpty()
    assert plain.exceptAll(L.proposta_convenio_view(built["gold"], ["id_proposta", "nome_proponente"], proven=True)).isEmpty()


def test_observations_meet_their_counts_after_they_are_typed(spark, clean_raw, capsys):
    L.stage_convenio(clean_raw["convenio"]).select("id_convenio_observacao", "source_conflict_count").explain(True)
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.index("sha2(") > plan.index("Join LeftOuter")  # below the join, so it moves the hash alone


def test_names_of_small_dimensions_join_after_the_large_tables(built):
    plan = L.proposta_convenio_view(built["gold"])._jdf.queryExecution().analyzed().toString()
    outermost = [plan.index(f"__{name}_key") for name in ("signing_day", "proposal_day", "granting_body", "superior_body", "town", "agreement", "proponent")]
    assert outermost == sorted(outermost)  # the first line of a plan is its last join


def test_raw_texts_are_made_once_per_order_and_rules_dealt_once_by_part(spark):
    raw = raw_tables(spark, SF)
    plan = raw["convenio"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lpad(cast(o_orderkey") > plan.index("Join Inner")  # below the join, so not once per line
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = raw_tables(spark, SF)["programa"]._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(l_partkey") == 1 and plan.count("Exchange") == 2


def test_detail_tables_answer_alike_from_one_stored_table(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(v):
        seen.add(1)
        return v

    columns = dict.fromkeys([*B.DETAIL_COLUMNS, *B.FILTER_COLUMNS])
    plain = spark.range(30).select(*[(F.col("id") % 7).cast("string").alias(c) for c in columns])
    marked = plain.withColumn("municipio", F.udf(mark, "string")("municipio"))
    filters = {"uf": {"uf": ["1"]}, "modality": {"modalidade": ["2", "3"]}, "none": {}}
    got = {n: [tuple(r) for r in x.collect()] for n, x in B.detail_tables(marked, filters).items()}
    assert got == {n: [tuple(r) for r in B.detail_table(plain, f).collect()] for n, f in filters.items()}
    assert seen.value == 30


def test_orphans_are_found_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(v):
        seen.add(1)
        return v

    links = spark.range(20).select(F.udf(mark, "long")("id").alias("id_proposta"))
    silver = {"programa_proposta": links, "proposta": spark.range(18).select(F.col("id").alias("id_proposta"))}
    got = {tuple(r) for r in C.orphan_set_equality(silver, [18, 30], spark).collect()}
    assert got == {(19, "unexpected"), (30, "missing")} and seen.value <= 40
