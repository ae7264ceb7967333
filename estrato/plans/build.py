"""Builds the layers as written tables, with their gates in between."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from estrato.operators import quality as Q
from estrato.operators.skew import heavy_hitters, hot_keys
from estrato.plans import checks as C
from estrato.plans import layers as L
from estrato.plans import records as R
from estrato.session import shared_folder
from estrato.sources.snapshots import materialize, overwrite_snapshot, read_snapshot

Tables = Mapping[str, DataFrame]


class GateFailure(RuntimeError):
    """A layer did not reconcile; what was built stays for inspection."""


def _write_all(spark: SparkSession, plans: Tables, names: Sequence[str], folder: str, parallel: int, watched: Mapping | None = None) -> dict[str, DataFrame]:
    """Writes independent tables side by side, so that one table's last tasks do not idle the cluster.

    ``watched`` has, by table, aggregates to observe while it is written, and what takes their values.
    """
    ready = {name: plans[name] for name in names}  # plans are put together here, jobs run in the pool

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        metrics, take = (watched or {}).get(item[0], (None, None))
        overwrite_snapshot(spark, item[1], f"{folder}/{item[0]}", metrics=metrics, check=take)
        return item[0], read_snapshot(spark, f"{folder}/{item[0]}")

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        done = pool.map(write, ready.items())
        return dict(done)


def build_silver(spark: SparkSession, raw: Tables, folder: str, parallel: int = 4) -> dict[str, DataFrame]:
    place = f"{folder}/silver"
    names = ("proposta", "programa_elegibilidade", "programa_proposta", "convenio")
    built = _write_all(spark, L.silver_tables(raw), names, place, parallel)
    # programs come from the table just written instead of typing the raw rows a second time
    cadastral = L.silver_programa_cadastral(built["programa_elegibilidade"])
    built["programa_cadastral"] = materialize(spark, cadastral, f"{place}/programa_cadastral")
    return built


def build_gold(spark: SparkSession, silver: Tables, folder: str, parallel: int = 4, seen: dict | None = None) -> dict[str, DataFrame]:
    """``seen`` takes what the write of the proposal fact observed: its rows and heavy hitters by column."""
    plans = L.gold_tables(spark, silver)
    watched = {"fct_proposta": ({c: heavy_hitters(c) for c in STAR_KEYS}, (seen if seen is not None else {}).update)}
    return _write_all(spark, plans, list(plans), f"{folder}/gold", parallel, watched)


def build_mart(spark: SparkSession, gold: Tables, folder: str, proven: bool = False, hot: Mapping[str, Mapping] | None = None) -> DataFrame:
    """The serving table, its rows kept together by year and state, ordered in each file, so that their filters skip files."""
    return materialize(spark, L.proposta_convenio_view(gold, proven=proven, hot=hot), f"{folder}/gold/mart_proposta_convenio", cluster=("ano_proposta", "uf"))


STAR_KEYS = ("identificacao_proponente", "codigo_municipio_ibge", "codigo_orgao_superior", "codigo_orgao")
"""Columns of the proposal fact that its view joins on; their heavy hitters are observed as the fact is written."""


def observed_keys(spark: SparkSession, seen: Mapping) -> dict[str, dict]:
    """By column of the fact, the hot keys among what its write has observed."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {c: found for c in STAR_KEYS if (found := hot_keys(seen[c], seen["rows"], tasks))}


def require(spark: SparkSession, gates: Mapping, parallel: int = 4) -> DataFrame:
    passed, rows = Q.run_gates(spark, gates, parallel)
    if not passed:
        failed = [f"{r['gate']}: {r['item']}" for r in rows.filter(rows["status"] != Q.PASS).collect()]
        raise GateFailure("; ".join(failed))
    return rows


def build_all(
    spark: SparkSession, raw: Tables, folder: str | None = None, known=R.KNOWN_ORPHAN_PROPOSALS, gates: bool = True,
    allowed_losses: Mapping[str, float] | None = None, baseline: DataFrame | None = None,
    schema_locations: Mapping[str, str] | None = None,
) -> dict:
    """raw -> silver -> gates -> gold -> gates -> mart -> gates. Each layer is written before the next reads it.

    Gates hold the reconciliations and the declared contracts of each layer. ``allowed_losses`` maps
    "table.column" to the share of rows whose raw text may be typed to NULL. With a ``baseline``
    (gate, item, baseline) items that have a stored total must also equal it, and the orphan
    proposals must be exactly the known ones. ``schema_locations`` maps schemas to where they must lie.
    Without a folder the layers go to the shared folder the cluster names in ``spark.checkpoint.dir``.
    """
    folder = folder or f"{shared_folder(spark)}/layers"

    def passed(checks: Mapping) -> None:
        if not gates:
            return
        if baseline is not None:
            checks = {n: (lambda g=g: Q.with_baseline(g(), baseline)) for n, g in checks.items()}
        require(spark, checks)

    silver = build_silver(spark, raw, folder)
    first = C.raw_to_silver_gates(raw, silver, known, allowed_losses)
    if baseline is not None:
        first["orphan_set"] = lambda: C.orphan_set_gate(silver, known, spark)
    passed(first)
    seen: dict = {}
    gold = build_gold(spark, silver, folder, seen=seen)
    second = C.silver_to_gold_gates(silver, gold, known)
    for schema, place in (schema_locations or {}).items():
        second[f"location_{schema}"] = lambda schema=schema, place=place: C.location_gate(spark, schema, place)
    passed(second)
    mart = build_mart(spark, gold, folder, proven=gates, hot=observed_keys(spark, seen))
    passed(C.view_gates(gold, mart, "mart"))
    return {"silver": silver, "gold": gold, "mart": mart}
