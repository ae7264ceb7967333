"""Times the layer builds and the dashboard questions; prints one JSON line.

The layers are written once to a new folder, as in production, and the questions run on the
written tables: view with distinct counts, view with plain counts and pruned joins, serving mart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from estrato.operators import profiling as P  # noqa: E402
from estrato.operators import quality as Q  # noqa: E402
from estrato.operators.metrics import summarize  # noqa: E402
from estrato.plans import build as BUILD  # noqa: E402
from estrato.plans import checks as C  # noqa: E402
from estrato.plans import dashboard as B  # noqa: E402
from estrato.plans import ingest as INGEST  # noqa: E402
from estrato.plans import layers as L  # noqa: E402
from estrato.plans import profile as PROFILE  # noqa: E402
from estrato.plans import records as R  # noqa: E402
from estrato.session import local_session, shared_folder  # noqa: E402
from suite.raw_tables import raw_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench", "16g")
    folder = f"{shared_folder(spark)}/bench-{int(time.time())}"
    times: dict[str, float] = {}

    def timed(name: str, work, repeat: int = 1):
        runs = []
        for _ in range(repeat):
            started = time.perf_counter()
            result = work()
            runs.append(time.perf_counter() - started)
        times[name] = round(statistics.median(runs), 3)
        return result

    raw_plan = raw_tables(spark, sf_dir)
    raw = timed("write_raw_text_tables", lambda: {
        # raw text arrives as many files; the given tables are one file each, so spread them here
        n: BUILD.materialize(spark, raw_plan[n].repartition(cpus), f"{folder}/raw/{n}") for n in raw_plan})
    # the ingest as it runs in production: text files to a checked version with lineage, then a run without change
    text = f"{folder}/text"
    for name in raw:
        timed(f"write_text_{name}", lambda n=name: raw[n].drop(*R.LINEAGE).write.csv(f"{text}/{n}", sep=";", header=True, quote='"', escape='"', emptyValue=""))
    spark.createDataFrame([("data_carga",), ("16/09/2026 06:32:11",)], "value string").coalesce(1).write.text(f"{text}/control")
    ledger = INGEST.Ledger(spark, f"{folder}/ledger")
    datasets = [INGEST.Dataset(n, f"{text}/{n}", f"{n}.csv", f"{folder}/bronze/{n}", n, multiline=False) for n in raw]
    for run_id, step in (("r1", "ingest_four_datasets"), ("r2", "ingest_without_change")):
        times[f"{step}_ends"] = timed(step, lambda r=run_id: INGEST.run(spark, ledger, datasets, f"{text}/control", r, f"2026-{r}"))
    outcome = [times.pop(f"{step}_ends") for step in ("ingest_four_datasets", "ingest_without_change")]
    if outcome != ["SUCCESS", "NO_CHANGE"]:
        raise RuntimeError(f"ingest ended with {outcome}")

    silver = timed("build_silver", lambda: BUILD.build_silver(spark, raw, folder))
    # the derived links hold real duplicates, so these gates report failures; their cost is what is timed
    timed("gates_raw_to_silver", lambda: Q.run_gates(spark, C.raw_to_silver_gates(raw, silver)))
    gold = timed("build_gold", lambda: BUILD.build_gold(spark, silver, folder))
    timed("gates_silver_to_gold", lambda: Q.run_gates(spark, C.silver_to_gold_gates(silver, gold)))
    mart = timed("build_mart", lambda: BUILD.build_mart(spark, gold, folder, proven=True))
    timed("gates_mart", lambda: Q.run_gates(spark, C.view_gates(gold, mart, "mart")))
    timed("contracts_gold", lambda: Q.check_contracts(gold, C.GOLD_CONTRACTS).collect())

    for name, chart in B.BENCHMARK.items():
        view = lambda c=chart: L.proposta_convenio_view(gold, B.chart_columns(c), proven=True)
        timed(f"{name}_view_distinct", lambda: chart.run(L.proposta_convenio_view(gold, proven=True), keys_proven=False).collect(), 3)
        timed(f"{name}_view_plain", lambda: chart.run(view()).collect(), 3)
        timed(f"{name}_mart", lambda: chart.run(mart).collect(), 3)

    def dashboard() -> None:
        queries = [lambda c=c: c.run(mart).collect() for c in B.CHARTS.values()] + [lambda: B.detail_table(mart).collect()]
        with ThreadPoolExecutor(max_workers=6) as pool:
            list(pool.map(lambda q: q(), queries))

    timed("dashboard_12_concurrent", dashboard, 3)
    for name, filters in B.SCENARIOS.items():
        timed(f"scenario_{name}", lambda f=filters: summarize(mart, list(B.METRICS.values()), ["uf"], f).collect(), 3)
    timed("multiplicity_money", lambda: PROFILE.financial_steps(raw).collect())
    timed("profile_raw_columns", lambda: [P.column_profile(raw[n], [c for c in raw[n].columns if c not in R.LINEAGE]).collect() for n in raw])
    timed("agreement_column_stability", lambda: P.column_stability(
        silver["convenio"], ["numero_convenio"], [f.name for f in R.CONVENIO if f.name != "numero_convenio"], ["valor_saldo_conta"]).collect())
    timed("date_profile", lambda: P.date_profile(silver["convenio"], [f.name for f in R.CONVENIO if f.kind == "date"]).collect())

    rows = {n: t.count() for n, t in (("proposta", gold["fct_proposta"]), ("convenio", gold["fct_convenio"]), ("links", gold["bridge_programa_proposta"]))}
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "layer_builds_and_dashboard_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""), "rows": rows,
        "rows_per_core_second": {"build_silver": round(sum(rows.values()) / times["build_silver"] / cpus), "build_gold": round(sum(rows.values()) / times["build_gold"] / cpus)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
