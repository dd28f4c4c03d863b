"""Report mart (K1-K7) and its sink.

All report queries are unpivoted into one long ``report_cells`` table:

    report_date, section, section_order, block, block_order, block_title,
    row_key, row_order, column, column_order, raw_value, display, status

``display`` and ``status`` follow the report's formats (I12-I17); the
"current" column is labelled ``Atual 00-08 (dd/MM)`` of the following day.
The sink writes each run into a folder of its own, partitioned by
``report_date``, and publishes it by a new manifest (``publish``): re-running a
date replaces only that date, and a run that breaks off changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.config import (
    CAL_INDICATORS, CAL_SHIFT_LABELS, DAY_SHIFT_LABELS, DEFAULT_CONFIG, IND_IDLE, IND_OEE, IND_OFF,
    PRODUCT_TOTAL_LABEL, PRODUCTS, VAPEX_GRINDING, VAPEX_TOTAL_LABEL, VAPEX_VINC, VINC_SILOS, Config,
)
from shiftmetrics.functions.formatting import (
    cycles_status, hhmmss, idle_status, kg_text, oee_status, pct_text,
)
from shiftmetrics.plans import calibration, disinfection, grinding
from shiftmetrics.plans.facts import FactStore, shared_facts
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources import versions
from shiftmetrics.sources.tables import SensorTables

CELL_COLUMNS = ("report_date", "section", "section_order", "block", "block_order", "block_title",
                "row_key", "row_order", "column", "column_order", "raw_value", "display", "status")

CELL_SCHEMA = ("report_date date, section string, section_order int, block string, block_order int, block_title string, "
               "row_key string, row_order int, column string, column_order int, raw_value double, display string, status string")
EXPECTED_BLOCKS = 12

# Fixed value: section titles in report order.
SECTIONS = ("Trituração", "Desinfeção Trituração", "Calibração", "Desinfeção VINC")


def current_label() -> Column:
    return F.concat(F.lit("Atual 00-08 ("), F.date_format(F.date_add("report_date", 1), "dd/MM"), F.lit(")"))


def snapshot_label() -> Column:
    return F.date_format(F.date_add("report_date", 1), "dd/MM/yyyy")


Cell = tuple[Column | str, Column, Column, Column | None]   # label, raw, display, status


def cells(df: DataFrame, section: int, block: str, block_order: int, title: Column | str,
          row_key: Column | str, row_order: Column | int, spec: list[Cell]) -> DataFrame:
    """Unpivot the columns in ``spec`` of ``df`` into cell rows (K1)."""
    def lit(x):
        return F.lit(x) if not isinstance(x, Column) else x

    arr = F.array(*[F.struct(lit(label).alias("column"), F.lit(i).alias("column_order"),
                             raw.cast("double").alias("raw_value"), disp.alias("display"),
                             (status if status is not None else F.lit(None)).cast("string").alias("status"))
                    for i, (label, raw, disp, status) in enumerate(spec, start=1)])
    return df.select("report_date", F.lit(SECTIONS[section - 1]).alias("section"),
                     F.lit(section).alias("section_order"), F.lit(block).alias("block"),
                     F.lit(block_order).alias("block_order"), lit(title).alias("block_title"),
                     lit(row_key).cast("string").alias("row_key"), lit(row_order).cast("int").alias("row_order"),
                     F.inline(arr))


def _standard(std: DataFrame, cur: DataFrame, section: int, block: str, order: int, title: str,
              fmt: Callable[[Column], Column] | None = None, status=None) -> DataFrame:
    """T1/T2/T3/TOTAL cards plus the current card (K2)."""
    df = std.join(cur, "report_date", "left") if cur is not None else std
    cols = list(grinding.DAY_COLS) + ["total"]
    labels = list(DAY_SHIFT_LABELS) + ["TOTAL"]
    spec: list[Cell] = []
    for c, label in zip(cols, labels):
        v = F.col(c)
        if fmt is None:
            spec.append((label, F.lit(None), v.cast("string"), None))
        else:
            spec.append((label, v, fmt(c), status(c) if status else None))
    if cur is not None:
        c = grinding.CURRENT_COL
        v = F.col(c)
        spec.append((current_label(), F.lit(None) if fmt is None else v,
                     v.cast("string") if fmt is None else fmt(c), None))
    return cells(df, section, block, order, title, "", 1, spec)


def _single_total(df: DataFrame, section: int, block: str, order: int, title: str) -> DataFrame:
    t = F.concat(F.lit(title + " ("), snapshot_label(), F.lit(")"))
    return cells(df, section, block, order, t, "", 1, [("TOTAL", F.col("total"), kg_text("total"), None)])


def _disinfection_table(day: DataFrame, cur: DataFrame, ids: tuple[int, ...], section: int,
                        block: str, order: int, title: str, cfg: Config) -> DataFrame:
    """VAPEX rows with counts and the ok/bad class except on TOTAL."""
    df = day.join(cur, ["report_date", "vapex"], "left")
    order_map = {f"VAPEX {i}": k for k, i in enumerate(ids, start=1)}
    order_map[VAPEX_TOTAL_LABEL] = len(ids) + 1
    row_order = F.create_map(*[x for kv in order_map.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[F.col("vapex")]
    is_total = F.col("vapex") == VAPEX_TOTAL_LABEL

    def st(v: str) -> Column:
        return F.when(~is_total, cycles_status(v, cfg.cycles_ok))

    cur_sql = f"coalesce({disinfection.CURRENT_COL}, 0L)"
    cur_v = F.expr(cur_sql)
    spec: list[Cell] = [(label, F.col(c), F.col(c).cast("string"), st(c))
                        for c, label in zip(disinfection.COLS, DAY_SHIFT_LABELS)]
    spec.append(("Total", F.col("total"), F.col("total").cast("string"), None))
    spec.append((current_label(), cur_v, cur_v.cast("string"), st(cur_sql)))
    return cells(df, section, block, order, title, F.col("vapex"), row_order, spec)


MART_INPUTS = {
    "md_runtime": grinding.md_runtime, "md_runtime_current": grinding.md_runtime_current,
    "mill_hours": grinding.mill_hours, "mill_hours_current": grinding.mill_hours_current,
    "silo_kg_grinding": grinding.silo_kg_grinding,
    "silo_kg_grinding_current": grinding.silo_kg_grinding_current,
    "grinding_oee": grinding.grinding_oee,
    "silo_total_8h_grinding": grinding.silo_total_8h_grinding,
    "silo_kg_disinfection": grinding.silo_kg_disinfection,
    "silo_kg_disinfection_current": grinding.silo_kg_disinfection_current,
    "silo_total_8h_disinfection": grinding.silo_total_8h_disinfection,
    "disinfections_grinding": disinfection.disinfections_grinding,
    "disinfections_grinding_current": disinfection.disinfections_grinding_current,
    "granulate_by_product": calibration.granulate_by_product,
    "granulate_current": calibration.granulate_current,
    "calibration_oee": calibration.calibration_oee,
    "calibration_oee_current": calibration.calibration_oee_current,
    "disinfections_vinc": disinfection.disinfections_vinc,
    "disinfections_vinc_current": disinfection.disinfections_vinc_current,
    "silo_snapshot_vinc": grinding.silo_snapshot_vinc,
}


def materialize(results: dict[str, DataFrame], parallel: int = 8) -> dict[str, DataFrame]:
    """Checkpoint every (small, per-date) metric result, several jobs at once.

    Reliable ``checkpoint()`` writes into the session's checkpoint folder
    (``spark.checkpoint.dir``), so the mart is planned over tiny inputs and
    a lost executor only recomputes the metric it was working on.
    """
    if not results:
        return {}
    from shiftmetrics.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(next(iter(results.values())).sparkSession)
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(results)))) as pool:
        futures = {k: pool.submit(lambda df: df.checkpoint(eager=True), v) for k, v in results.items()}
        return {k: f.result() for k, f in futures.items()}


def mart_inputs(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG,
                names=None, materialized: bool = True) -> dict[str, DataFrame]:
    """The report queries the mart is built from.

    For the whole mart over a literal scope, shared per-shift facts are
    computed once (each sensor table processed once where the queries
    allow it) and materialised; the queries are derived from them.
    Otherwise each query is planned on its own.
    """
    if names is None and scope.first is not None and materialized:
        return derived_inputs(materialize(shared_facts(t, scope, cfg)), scope, cfg)
    res = {n: MART_INPUTS[n](t, scope, cfg) for n in (names or MART_INPUTS)}
    return materialize(res) if materialized else res


def derived_inputs(f: dict[str, DataFrame], scope: Scope, cfg: Config = DEFAULT_CONFIG) -> dict[str, DataFrame]:
    g, c, d = grinding, calibration, disinfection
    silo_a = f["silo_a"].groupBy("report_date", "shift").agg(
        F.sum("kg").alias("kg"), F.sum("kg_eff").alias("kg_eff"))
    silo_b = f["silo_b_ext"].groupBy("report_date", "shift").agg(F.sum("kg").alias("kg"))
    silo_b_ids = (f["silo_b_ext"].filter(F.col("silo_id").between(*cfg.disinfection_silos))
                  .groupBy("report_date", "shift").agg(F.sum("kg").alias("kg")))
    return {
        "md_runtime": g.md_runtime_from(f["md_ext"], scope),
        "md_runtime_current": g.md_current_from(f["md_ext"], scope),
        "mill_hours": g.mill_hours_from(f["mill_ext"], scope),
        "mill_hours_current": g.mill_current_from(f["mill_ext"], scope),
        "silo_kg_grinding": g.kg_wide_from(silo_a, scope),
        "silo_kg_grinding_current": f["silo_kg_grinding_current"],
        "grinding_oee": g.grinding_oee_from(silo_a, f["mill_ext"], scope, cfg, kg_col="kg_eff"),
        "silo_total_8h_grinding": f["silo_total_8h_grinding"],
        "silo_kg_disinfection": g.kg_wide_from(silo_b, scope),
        "silo_kg_disinfection_current": g.kg_current_from(silo_b_ids, scope),
        "silo_total_8h_disinfection": f["silo_total_8h_disinfection"],
        "disinfections_grinding": d.disinfections_from(f["cycles_day"], scope, VAPEX_GRINDING, cfg),
        "disinfections_grinding_current": d.current_from(f["cycles_cur"], scope, VAPEX_GRINDING, cfg),
        "granulate_by_product": c.granulate_from(f["counters_cal"], scope),
        "granulate_current": c.granulate_current_from(f["counters_next"], scope),
        "calibration_oee": c.calibration_oee_from(f["sieves"], f["counters_cal"], scope, cfg),
        "calibration_oee_current": c.calibration_oee_current_from(f["sieves"], f["counters_next"], scope, cfg),
        "disinfections_vinc": d.disinfections_from(f["cycles_day"], scope, VAPEX_VINC, cfg),
        "disinfections_vinc_current": d.current_from(f["cycles_cur"], scope, VAPEX_VINC, cfg),
        "silo_snapshot_vinc": f["silo_snapshot_vinc"],
    }


def report_cells(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG,
                 materialized: bool = True, store: FactStore | None = None) -> DataFrame:
    """All report blocks of every report date as one long table (K1-K7).

    With a ``store``, facts are computed for the dates it does not hold and kept there.
    """
    if store is not None:
        return cells_from(derived_inputs(store.facts(t, scope), scope, cfg), cfg)
    m = mart_inputs(t, scope, cfg, materialized=materialized)
    return cells_from(m, cfg)


def cells_from(m: dict[str, DataFrame], cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    # Block names, their order and titles.
    parts = [
        _standard(m["md_runtime"], m["md_runtime_current"], 1, "tempo_producao_md", 1, "Tempo Produção MD"),
        _standard(m["mill_hours"], m["mill_hours_current"], 1, "horas_moinhos", 2,
                  "Nº Horas Trabalhadas (Moinhos)"),
        _standard(m["silo_kg_grinding"], m["silo_kg_grinding_current"], 1, "kgs_silos", 3,
                  "Kgs Produzidos (Silos 1 a 5)", fmt=kg_text),
        _standard(m["grinding_oee"], None, 1, "oee_trituracao", 4,
                  "Dia Anterior - Cálculo OEE", fmt=lambda v: pct_text(f"coalesce({v}, 0D)"),
                  status=lambda v: oee_status(v, cfg.oee_ok, cfg.oee_warning)),
        _single_total(m["silo_total_8h_grinding"], 1, "trit_total_silos_8h", 5, "Total Silos AD 1 a 5 às 8h"),
        _standard(m["silo_kg_disinfection"], m["silo_kg_disinfection_current"], 2, "desinf_kgs_silos", 1,
                  "Kgs Produzidos (Silos 6 a 10)", fmt=kg_text),
        _single_total(m["silo_total_8h_disinfection"], 2, "desinf_total_silos_8h", 2,
                      "Total Silos PD 6 a 10 às 8h"),
        _disinfection_table(m["disinfections_grinding"], m["disinfections_grinding_current"], VAPEX_GRINDING,
                            2, "desinf_trit_desinfecoes_dia_anterior", 3, "Nº Desinfeções", cfg),
        _granulate(m["granulate_by_product"], m["granulate_current"]),
        _calibration_oee(m["calibration_oee"], m["calibration_oee_current"], cfg),
        _disinfection_table(m["disinfections_vinc"], m["disinfections_vinc_current"], VAPEX_VINC,
                            4, "desinf_vinc_desinfecoes_dia_anterior", 1, "Dia Anterior - Nº Desinfeções", cfg),
        _vinc_silos(m["silo_snapshot_vinc"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*CELL_COLUMNS)


def granulate_cells(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Granulate table with the current column and blank share on Total (K3)."""
    m = mart_inputs(t, scope, cfg, ("granulate_by_product", "granulate_current"), materialized=False)
    return _granulate(m["granulate_by_product"], m["granulate_current"])


def _granulate(day: DataFrame, cur: DataFrame) -> DataFrame:
    df = day.join(cur, ["report_date", "produto"], "left")
    order = {label: k for k, (label, _) in enumerate(PRODUCTS, start=1)}
    order[PRODUCT_TOTAL_LABEL] = len(PRODUCTS) + 1
    row_order = F.create_map(*[x for kv in order.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[F.col("produto")]
    is_total = F.col("produto") == PRODUCT_TOTAL_LABEL
    cur_sql = f"coalesce({calibration.CURRENT_COL}, 0L)"
    spec: list[Cell] = [(label, F.col(c), kg_text(c), None)
                        for c, label in zip(calibration.CAL_COLS, CAL_SHIFT_LABELS)]
    spec.append(("Total (Kg)", F.col("total_kg"), kg_text("total_kg"), None))
    spec.append(("%", F.col("percentagem"),
                 F.when(is_total, F.lit("")).otherwise(pct_text("percentagem")), None))
    spec.append((current_label(), F.expr(cur_sql), kg_text(cur_sql), None))
    return cells(df, 3, "calibracao_granulado_dia_anterior", 1,
                 "Total de Granulado Produzido - Dia Anterior", F.col("produto"), row_order, spec)


def calibration_oee_cells(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Calibration OEE table: % or HH:MM:SS per indicator, status classes (K4)."""
    records = calibration.sieve_time(t, scope, cfg)         # one sweep for both tables
    day = calibration.calibration_oee_from(records, calibration.calibration_counter_gain(t, scope), scope, cfg)
    cur = calibration.calibration_oee_current_from(records, calibration.next_day_counter_gain(t, scope), scope, cfg)
    return _calibration_oee(day, cur, cfg)


def _calibration_oee(day: DataFrame, cur: DataFrame, cfg: Config) -> DataFrame:
    df = day.join(cur, ["report_date", "indicador"], "left")
    order = {label: k for k, label in enumerate(CAL_INDICATORS, start=1)}
    row_order = F.create_map(*[x for kv in order.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[F.col("indicador")]
    is_time = F.col("indicador").isin(IND_IDLE, IND_OFF)
    is_oee = F.col("indicador") == IND_OEE

    def cell(label, c: str) -> Cell:
        v = f"coalesce({c}, 0D)"
        disp = F.when(is_time, hhmmss(v)).otherwise(pct_text(v))
        st = (F.when(is_time, idle_status(v, cfg.idle_bad_s, cfg.idle_warning_s))
              .when(is_oee, oee_status(v, cfg.oee_ok, cfg.oee_warning)))
        return (label, F.expr(v), disp, st)

    spec = [cell(label, c) for c, label in zip(calibration.CAL_COLS, CAL_SHIFT_LABELS)]
    spec.append(cell("Dia", "dia"))
    spec.append(cell(current_label(), calibration.CURRENT_COL))
    return cells(df, 3, "calibracao_oee_dia_anterior", 2, "Cálculo OEE", F.col("indicador"), row_order, spec)


def _vinc_silos(df: DataFrame) -> DataFrame:
    spec: list[Cell] = [(label, F.col(c), kg_text(c), None)
                        for (_, label), c in zip(VINC_SILOS, grinding.VINC_COLS)]
    title = F.concat(F.lit("Peso Silos Desinfeção VINC às 8h ("), snapshot_label(), F.lit(")"))
    return cells(df, 4, "desinf_vinc_silos_8h", 2, title, "", 1, spec)


def missing_blocks(report: DataFrame, expected_blocks: int = EXPECTED_BLOCKS) -> DataFrame:
    """Row-shape contract (K7): report dates with fewer blocks than expected."""
    n = report.groupBy("report_date").agg(F.countDistinct("block").alias("n_blocks"))
    return n.filter(F.col("n_blocks") < expected_blocks)


# --- the sink (A6) ------------------------------------------------------------------
#
# ``<path>/runs/n=<k>/report_date=<d>``: what a run wrote; ``<path>/manifest/n=<m>``: which
# run's folder holds the report of each date.  The last ready manifest is the published state.

def write_run(cells: DataFrame, path: str, dates: list[date]) -> tuple[int, list[date]]:
    """Write the cells of ``dates`` as a run that is not published yet: its number, and the dates that lack blocks (K7).

    The blocks of each date are counted by the write itself (one bit a block, so repeated tasks change nothing).
    """
    spark = cells.sparkSession
    seen = Observation()
    block = F.expr("shiftleft(1L, section_order * 8 + block_order)")
    metrics = [F.bit_or(F.when(F.col("report_date") == F.lit(d), block)).alias(f"d{k}") for k, d in enumerate(dates)]
    n = versions.begin(spark, f"{path}/runs")
    cells.observe(seen, *metrics).repartition("report_date").write.partitionBy("report_date").parquet(
        versions.folder(f"{path}/runs", n))
    missing = [d for k, d in enumerate(dates) if (seen.get[f"d{k}"] or 0).bit_count() < EXPECTED_BLOCKS]
    versions.finish(spark, f"{path}/runs", n)
    return n, missing


def published(spark: SparkSession, path: str) -> dict[date, int]:
    """The run that holds the report of each date."""
    ready = versions.ready(spark, f"{path}/manifest")
    if not ready:
        return {}
    rows = spark.read.schema("report_date date, run int").parquet(f"{versions.folder(f'{path}/manifest', ready[-1])}/dates").collect()
    return {r["report_date"]: r["run"] for r in rows}


def publish(spark: SparkSession, path: str, runs: dict[date, int], dropped: list[date]) -> None:
    """Make the reports of ``runs`` visible and those of ``dropped`` invisible, in one step (one row a date)."""
    state = {d: n for d, n in published(spark, path).items() if d not in set(dropped)} | runs
    n = versions.begin(spark, f"{path}/manifest")
    spark.createDataFrame(sorted(state.items()), "report_date date, run int").coalesce(1).write.parquet(
        f"{versions.folder(f'{path}/manifest', n)}/dates")
    versions.finish(spark, f"{path}/manifest", n)


def read_runs(spark: SparkSession, path: str, runs: dict[date, int]) -> DataFrame:
    folders = [f"{versions.folder(f'{path}/runs', n)}/report_date={d.isoformat()}" for d, n in sorted(runs.items())]
    if not folders:
        return spark.createDataFrame([], CELL_SCHEMA)
    return spark.read.schema(CELL_SCHEMA).option("basePath", f"{path}/runs").parquet(*folders).select(*CELL_COLUMNS)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The published report cells."""
    return read_runs(spark, path, published(spark, path))


def drop_unpublished(spark: SparkSession, path: str) -> None:
    """Remove the folders of runs and manifests that the published state does not refer to (nobody may be reading them)."""
    kept = set(published(spark, path).values())
    versions.drop(spark, f"{path}/runs", [n for n in versions.ready(spark, f"{path}/runs") if n not in kept])
    versions.drop(spark, f"{path}/manifest", versions.ready(spark, f"{path}/manifest")[:-1])
