"""Oracle SQL for the report mart: each query's oracle statement is nested
as a CTE and unpivoted with UNION ALL; formats are written in DuckDB terms
(``format('{:,}')``, ``printf``, ``round_even``)."""

from __future__ import annotations

# Section and shift labels; the block names and titles below are fixed values too.
SECTIONS = ("Trituração", "Desinfeção Trituração", "Calibração", "Desinfeção VINC")
DAY_LABELS = ("T1(00-08)", "T2(08-16)", "T3(16-24)")
CAL_LABELS = ("T1(22-06)", "T2(06-14)", "T3(14-22)")
CUR = "('Atual 00-08 (' || strftime(report_date + INTERVAL 1 DAY, '%d/%m') || ')')"
SNAP = "strftime(report_date + INTERVAL 1 DAY, '%d/%m/%Y')"


def kg_text(x: str) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN '0 kg' ELSE replace(format('{{:,}}', "
            f"CAST(round_even(CAST({x} AS DOUBLE), 0) AS BIGINT)), ',', ' ') || ' kg' END")


def pct_text(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN '0 %' ELSE printf('%.1f %%', CAST({x} AS DOUBLE)) END"


def hhmmss(x: str) -> str:
    s = f"CAST(round_even(COALESCE(CAST({x} AS DOUBLE), 0), 0) AS BIGINT)"
    return f"printf('%02d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60)"


def oee_status(x: str) -> str:
    v = f"COALESCE(CAST({x} AS DOUBLE), 0)"
    return f"CASE WHEN {v} >= 80 THEN 'ok' WHEN {v} >= 70 THEN 'warning' ELSE 'bad' END"


def idle_status(x: str) -> str:
    v = f"COALESCE(CAST({x} AS DOUBLE), 0)"
    return f"CASE WHEN {v} >= 5400 THEN 'bad' WHEN {v} >= 3600 THEN 'warning' ELSE 'ok' END"


def cycles_status(x: str) -> str:
    return f"CASE WHEN COALESCE({x}, 0) >= 4 THEN 'ok' ELSE 'bad' END"


def cells(src: str, section: int, block: str, block_order: int, title: str, row_key: str,
          row_order: str, spec: list[tuple[str, str, str, str]]) -> str:
    parts = []
    for i, (label, raw, disp, status) in enumerate(spec, start=1):
        parts.append(
            f"SELECT report_date, '{SECTIONS[section - 1]}' AS section, {section} AS section_order, "
            f"'{block}' AS block, {block_order} AS block_order, {title} AS block_title, "
            f"CAST({row_key} AS VARCHAR) AS row_key, CAST({row_order} AS INTEGER) AS row_order, "
            f"{label} AS \"column\", {i} AS column_order, CAST({raw} AS DOUBLE) AS raw_value, "
            f"{disp} AS display, CAST({status} AS VARCHAR) AS status FROM {src}")
    return "\nUNION ALL\n".join(parts)


def standard(day: str, cur: str | None, section: int, block: str, order: int, title: str,
             fmt=None, status=None) -> tuple[str, str]:
    src = f"{block}_src"
    if cur:
        body = f"SELECT d.*, c.atual_00_08 FROM ({day}) d LEFT JOIN ({cur}) c ON c.report_date = d.report_date"
    else:
        body = day
    spec = []
    for c, label in zip(("t1_00_08", "t2_08_16", "t3_16_24", "total"), (*DAY_LABELS, "TOTAL")):
        if fmt is None:
            spec.append((f"'{label}'", "NULL", f"CAST({c} AS VARCHAR)", "NULL"))
        else:
            spec.append((f"'{label}'", c, fmt(c), status(c) if status else "NULL"))
    if cur:
        c = "atual_00_08"
        spec.append((CUR, "NULL" if fmt is None else c, f"CAST({c} AS VARCHAR)" if fmt is None else fmt(c), "NULL"))
    return f"{src} AS ({body})", cells(src, section, block, order, f"'{title}'", "''", "1", spec)


def single_total(day: str, section: int, block: str, order: int, title: str) -> tuple[str, str]:
    src = f"{block}_src"
    return f"{src} AS ({day})", cells(src, section, block, order, f"('{title} (' || {SNAP} || ')')",
                                        "''", "1", [("'TOTAL'", "total", kg_text("total"), "NULL")])


def disinfection(day: str, cur: str, ids: tuple[int, ...], section: int, block: str, order: int,
                 title: str) -> tuple[str, str]:
    src = f"{block}_src"
    body = (f"SELECT d.*, COALESCE(c.atual_00_08, 0) AS cur FROM ({day}) d LEFT JOIN ({cur}) c "
            f"ON c.report_date = d.report_date AND c.vapex = d.vapex")
    ro = "CASE vapex " + " ".join(f"WHEN 'VAPEX {i}' THEN {k}" for k, i in enumerate(ids, 1)) + \
         f" WHEN 'TOTAL' THEN {len(ids) + 1} END"

    def st(x: str) -> str:
        return f"CASE WHEN vapex <> 'TOTAL' THEN {cycles_status(x)} END"

    spec = [(f"'{label}'", c, f"CAST({c} AS VARCHAR)", st(c)) for c, label in zip(("t1", "t2", "t3"), DAY_LABELS)]
    spec.append(("'Total'", "total", "CAST(total AS VARCHAR)", "NULL"))
    spec.append((CUR, "cur", "CAST(cur AS VARCHAR)", st("cur")))
    return f"{src} AS ({body})", cells(src, section, block, order, f"'{title}'", "vapex", ro, spec)


def granulate(day: str, cur: str) -> tuple[str, str]:
    src = "granulate_src"
    body = (f"SELECT d.*, COALESCE(c.atual_00_08, 0) AS cur FROM ({day}) d LEFT JOIN ({cur}) c "
            f"ON c.report_date = d.report_date AND c.produto = d.produto")
    ro = "CASE produto WHEN '05A1' THEN 1 WHEN '1A2' THEN 2 WHEN '2A3' THEN 3 WHEN '3A7' THEN 4 WHEN 'Total' THEN 5 END"
    spec = [(f"'{label}'", c, kg_text(c), "NULL") for c, label in zip(("t1_22_06", "t2_06_14", "t3_14_22"), CAL_LABELS)]
    spec.append(("'Total (Kg)'", "total_kg", kg_text("total_kg"), "NULL"))
    spec.append(("'%'", "percentagem", f"CASE WHEN produto = 'Total' THEN '' ELSE {pct_text('percentagem')} END", "NULL"))
    spec.append((CUR, "cur", kg_text("cur"), "NULL"))
    return f"{src} AS ({body})", cells(src, 3, "calibracao_granulado_dia_anterior", 1,
                                        "'Total de Granulado Produzido - Dia Anterior'", "produto", ro, spec)


def calibration_oee(day: str, cur: str) -> tuple[str, str]:
    src = "cal_oee_src"
    body = (f"SELECT d.*, c.atual_00_08 FROM ({day}) d LEFT JOIN ({cur}) c "
            f"ON c.report_date = d.report_date AND c.indicador = d.indicador")
    inds = ("Performance", "Disponibilidade", "OEE", "Tempo Trabalho sem granulado", "Tempo Secção Desligada")
    ro = "CASE indicador " + " ".join(f"WHEN '{x}' THEN {k}" for k, x in enumerate(inds, 1)) + " END"
    is_time = "indicador IN ('Tempo Trabalho sem granulado', 'Tempo Secção Desligada')"

    def cell(label: str, c: str):
        v = f"COALESCE({c}, 0)"
        disp = f"CASE WHEN {is_time} THEN {hhmmss(v)} ELSE {pct_text(v)} END"
        st = f"CASE WHEN {is_time} THEN {idle_status(v)} WHEN indicador = 'OEE' THEN {oee_status(v)} END"
        return (label, v, disp, st)

    spec = [cell(f"'{label}'", c) for c, label in zip(("t1_22_06", "t2_06_14", "t3_14_22"), CAL_LABELS)]
    spec.append(cell("'Dia'", "dia"))
    spec.append(cell(CUR, "atual_00_08"))
    return f"{src} AS ({body})", cells(src, 3, "calibracao_oee_dia_anterior", 2, "'Cálculo OEE'",
                                        "indicador", ro, spec)


def vinc_silos(day: str) -> tuple[str, str]:
    from oracle.sql import VINC_COLS
    labels = ("SILO 1: 3A7 CS", "SILO 2: 2A3 CS", "SILO 3: 1A2 CS", "SILO 4: 05A1 CS",
              "SILO 5: 1A2 VINC", "SILO 6: 05A1 VINC")
    spec = [(f"'{label}'", c, kg_text(c), "NULL") for c, label in zip(VINC_COLS, labels)]
    return "vinc_src AS (" + day + ")", cells(
        "vinc_src", 4, "desinf_vinc_silos_8h", 2,
        f"('Peso Silos Desinfeção VINC às 8h (' || {SNAP} || ')')", "''", "1", spec)


def build(sql: dict[str, str]) -> dict[str, str]:
    oee = lambda c: pct_text(f"COALESCE({c}, 0)")
    blocks = [
        standard(sql["md_runtime"], sql["md_runtime_current"], 1, "tempo_producao_md", 1, "Tempo Produção MD"),
        standard(sql["mill_hours"], sql["mill_hours_current"], 1, "horas_moinhos", 2,
                 "Nº Horas Trabalhadas (Moinhos)"),
        standard(sql["silo_kg_grinding"], sql["silo_kg_grinding_current"], 1, "kgs_silos", 3,
                 "Kgs Produzidos (Silos 1 a 5)", fmt=kg_text),
        standard(sql["grinding_oee"], None, 1, "oee_trituracao", 4, "Dia Anterior - Cálculo OEE",
                 fmt=oee, status=oee_status),
        single_total(sql["silo_total_8h_grinding"], 1, "trit_total_silos_8h", 5, "Total Silos AD 1 a 5 às 8h"),
        standard(sql["silo_kg_disinfection"], sql["silo_kg_disinfection_current"], 2, "desinf_kgs_silos", 1,
                 "Kgs Produzidos (Silos 6 a 10)", fmt=kg_text),
        single_total(sql["silo_total_8h_disinfection"], 2, "desinf_total_silos_8h", 2,
                     "Total Silos PD 6 a 10 às 8h"),
        disinfection(sql["disinfections_grinding"], sql["disinfections_grinding_current"], (5, 6, 7, 8, 9),
                     2, "desinf_trit_desinfecoes_dia_anterior", 3, "Nº Desinfeções"),
        granulate(sql["granulate_by_product"], sql["granulate_current"]),
        calibration_oee(sql["calibration_oee"], sql["calibration_oee_current"]),
        disinfection(sql["disinfections_vinc"], sql["disinfections_vinc_current"], (1, 2, 3, 4),
                     4, "desinf_vinc_desinfecoes_dia_anterior", 1, "Dia Anterior - Nº Desinfeções"),
        vinc_silos(sql["silo_snapshot_vinc"]),
    ]

    def stmt(bs) -> str:
        return "WITH " + ",\n".join(c for c, _ in bs) + "\n" + "\nUNION ALL\n".join(s for _, s in bs)

    return {
        "report_cells": stmt(blocks),
        "format_values": stmt([blocks[8]]),
        "status_thresholds": stmt([blocks[9]]),
    }
