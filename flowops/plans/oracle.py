"""The same reports as SQL for an independent engine, over the same Parquet tables."""

from __future__ import annotations

from flowops.operators.deriving import DEFINITIONS, PREVIEW_ROWS
from flowops.operators.profiling import METRICS
from flowops.plans.flow_view import flows_sql
from flowops.spec import FLOW, LABEL_FAMILY, PROTOCOL_NAMES

SEED = 42
PERCENTS = (50, 75, 90, 95, 99)
NOT_FINITE = "isinf({0}) OR isnan({0})"


def q(name: str) -> str:
    return '"' + name + '"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rounded(c: str) -> str:
    return f"CASE WHEN abs({c}) < 9000000000.0 THEN round_even({c} * 1000000.0, 0) / 1000000.0 ELSE {c} END"


def pct(part: str, total: str) -> str:
    return f"round(CASE WHEN {total} <> 0 THEN CAST({part} AS DOUBLE) / {total} * 100.0 ELSE 0.0 END, 6)"


FLOWS = flows_sql()
FINITE_ROW = " AND ".join(
    f"{q(c)} IS NOT NULL" + (f" AND isfinite({q(c)})" if c in FLOW.floats else "") for c in FLOW.columns
)
ROUNDED = "rounded AS (SELECT " + ", ".join(
    f"{rounded(q(c))} AS {q(c)}" if c in FLOW.floats else q(c) for c in FLOW.columns
) + " FROM flows)"
CLEAN = f"clean AS (SELECT * FROM rounded WHERE {FINITE_ROW})"
FAMILIES = "families AS (SELECT * FROM (VALUES " + ", ".join(
    f"({text(k)}, {text(v)})" for k, v in LABEL_FAMILY.items()
) + ') AS d("Label", "Attack_Family"))'
PROTOCOLS = "protocols AS (SELECT * FROM (VALUES " + ", ".join(
    f"({k}, {text(v)})" for k, v in PROTOCOL_NAMES.items()
) + ') AS d("Protocol Type", protocolo))'


def _threshold_row(c: str) -> str:
    quantiles = ", ".join(f"coalesce(quantile_disc({q(c)}, {p / 100}), 0) AS p{p}" for p in PERCENTS)
    return (
        f"SELECT {text(c)} AS columna, count({q(c)}) AS conteo, count(*) - count({q(c)}) AS nulos,"
        f" min({q(c)}) AS \"min\", max({q(c)}) AS \"max\", avg({q(c)}) AS media, {quantiles} FROM rounded"
    )


LIMITS = "limits AS (" + " UNION ALL ".join(_threshold_row(c) for c in (FLOW.rate, FLOW.size, FLOW.iat)) + ")"


def limit(c: str, p: int) -> str:
    return f"(SELECT p{p} FROM limits WHERE columna = {text(c)})"


DERIVED = f"""derived AS (SELECT *,
    "Tot size" / 1024.0 AS size_kb,
    "Rate" / 1000000.0 AS rate_mbps,
    CASE WHEN "AVG" > 0 THEN "Std" / "AVG" END AS coef_variacion,
    {' + '.join(q(c) for c in FLOW.flags)} AS total_flags,
    CASE {' '.join(f"WHEN {q(c)} > 0 THEN {text(c)}" for c in FLOW.onehot)} ELSE 'otro' END AS protocolo_principal,
    CASE WHEN "IAT" <= {limit(FLOW.iat, 50)} THEN 'bajo' WHEN "IAT" <= {limit(FLOW.iat, 95)} THEN 'medio' ELSE 'alto' END AS rango_iat
  FROM clean)"""


def flows(sql: str, *more: str) -> str:
    return "WITH " + ",\n".join([FLOWS, *more]) + "\n" + sql


def cleaned(sql: str, *more: str) -> str:
    return flows(sql, ROUNDED, CLEAN, *more)


def derived(sql: str) -> str:
    return cleaned(sql, LIMITS, DERIVED)


MAPPED = 'mapped AS (SELECT f.*, m."Attack_Family" FROM flows f LEFT JOIN families m ON f."Label" = m."Label")'
FINITE_RATE = 'CASE WHEN isfinite("Rate") THEN "Rate" END'
TRAFFIC = "CASE WHEN \"Label\" = 'Benign' THEN 'Benign' ELSE 'Malicious' END"
ALL_COLUMNS = ", ".join(q(c) for c in FLOW.columns)


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def _profile_row(c: str, source: str, texts, floats, distincts) -> str:
    name = q(c)
    is_text, floating = c in texts, c in floats
    kind = "texto" if is_text else "decimal" if floating else "entero"
    bad = f"{name} IS NULL" + (f" OR NOT isfinite({name})" if floating else "")
    distinct = f"count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END)" if c in distincts else "NULL"
    low, high = (
        ("NULL", "NULL") if is_text
        else (f"min({name}) FILTER (NOT ({bad}))", f"max({name}) FILTER (NOT ({bad}))")
    )
    return (
        f"SELECT {text(c)} AS columna, {text(kind)} AS tipo, count(*) FILTER ({bad}) AS celdas_no_validas,"
        f" {pct(f'count(*) FILTER ({bad})', 'count(*)')} AS pct_no_validas,"
        f" CAST({distinct} AS BIGINT) AS distintos, CAST({low} AS DOUBLE) AS minimo_valido,"
        f" CAST({high} AS DOUBLE) AS maximo_valido FROM {source}"
    )


def _metric_rows(c: str) -> str:
    v = f"CAST({q(c)} AS DOUBLE)"
    formulas = {
        "conteo": f"CAST(count({v}) AS DOUBLE)", "suma": f"sum({v})", "media": f"avg({v})",
        "mediana": f"median({v})", "minimo": f"min({v})", "maximo": f"max({v})",
        "desviacion_estandar": f"stddev_samp({v})",
    }
    return " UNION ALL ".join(
        f"SELECT {text(c)} AS columna, {text(m)} AS metrica, {r6(formulas[m], 'valor')} FROM clean" for m in METRICS
    )


def _clean_row(c: str) -> str:
    bad = f"{q(c)} IS NULL" + (f" OR NOT isfinite({q(c)})" if c in FLOW.floats else "")
    return (
        f"SELECT {text(c)} AS columna, count(*) FILTER ({bad}) AS valores_no_validos_antes,"
        f" count(*) FILTER (({bad}) AND {FINITE_ROW}) AS valores_no_validos_despues,"
        f" count(*) FILTER (NOT ({FINITE_ROW})) AS filas_eliminadas FROM flows"
    )


def _derived_profile_row(c: str) -> str:
    if c in ("protocolo_principal", "rango_iat"):
        stats = f"'texto' AS tipo, count(*) - count({c}) AS nulos, CAST(NULL AS DOUBLE) AS minimo, CAST(NULL AS DOUBLE) AS maximo, CAST(NULL AS DOUBLE) AS media, count(DISTINCT {c}) AS distintos"
    else:
        stats = (
            f"'decimal' AS tipo, count(*) - count({c}) AS nulos, {r6(f'min({c})', 'minimo')}, {r6(f'max({c})', 'maximo')},"
            f" {r6(f'avg({c})', 'media')}, CAST(NULL AS BIGINT) AS distintos"
        )
    return f"SELECT {text(c)} AS columna, {stats}, {text(DEFINITIONS[c])} AS definicion FROM derived"


DERIVED_NAMES = ", ".join(q(c) for c in (FLOW.label, FLOW.protocol, FLOW.rate, FLOW.size, FLOW.iat, *DEFINITIONS))
INTENSE = f'"Rate" >= {limit(FLOW.rate, 95)} AND "Tot size" >= {limit(FLOW.size, 50)}'


def _filter_row(name: str, condition: str, threshold: str, test: str) -> str:
    return (
        f"SELECT {text(name)} AS filtro, {condition} AS condicion, {threshold} AS umbral,"
        f" count(*) FILTER ({test}) AS filas_encontradas,"
        f" {pct(f'count(*) FILTER ({test})', 'count(*)')} AS pct_del_total FROM clean"
    )


def _filters() -> str:
    rate95, size95 = limit(FLOW.rate, 95), limit(FLOW.size, 95)
    size50, iat95 = limit(FLOW.size, 50), limit(FLOW.iat, 95)
    return " UNION ALL ".join([
        _filter_row("trafico_alto", f"printf('Rate >= p95 (%.6f)', {rate95})", rate95, f'"Rate" >= {rate95}'),
        _filter_row("paquetes_grandes", f"printf('Tot size >= p95 (%.6f)', {size95})", size95, f'"Tot size" >= {size95}'),
        _filter_row("trafico_intenso", f"printf('Rate >= p95 (%.6f) y Tot size >= p50 (%.6f)', {rate95}, {size50})", rate95, INTENSE),
        _filter_row("iat_reducido", f"printf('0 < IAT <= p95 (%.6f)', {iat95})", iat95, f'"IAT" > 0 AND "IAT" <= {iat95}'),
    ])


def _indicator_rows() -> str:
    def row(category: str, name: str, number: str, words: str = "CAST(NULL AS VARCHAR)") -> str:
        return f"SELECT {text(category)} AS categoria, {text(name)} AS metrica, round(CAST({number} AS DOUBLE), 6) AS valor_num, {words} AS valor_txt FROM t"

    return " UNION ALL ".join([
        row("poblacion", "total_registros", "total"),
        row("poblacion", "total_clases", "clases"),
        row("poblacion", "clases_de_ataque", "ataques"),
        row("poblacion", "registros_benignos", "benignos"),
        row("poblacion", "registros_de_ataque", "total - benignos"),
        row("poblacion", "pct_registros_benignos", pct("benignos", "total")),
        row("poblacion", "pct_registros_ataque", pct("total - benignos", "total").replace("CAST(total - benignos AS DOUBLE)", "CAST((total - benignos) AS DOUBLE)")),
        row("volumen", "volumen_total_bytes", "volumen"),
        row("volumen", "volumen_total_mb", "volumen / (1024.0 * 1024.0)"),
        row("volumen", "paquetes_totales", "paquetes"),
        row("volumen", "tamano_medio_paquete_bytes", "CASE WHEN paquetes <> 0 THEN volumen / paquetes ELSE 0 END"),
        row("volumen", "tasa_media", "rate"),
        row("comportamiento", "media_syn_flag", "syn"),
        row("comportamiento", "media_ack_flag", "ack"),
        row("comportamiento", "media_rst_flag", "rst"),
        row("comportamiento", "media_fin_flag", "fin"),
        row("comportamiento", "ratio_syn_ack", "CASE WHEN ack <> 0 THEN syn / ack ELSE 0 END"),
        row("comportamiento", "iat_medio", "iat"),
        row("concentracion", "clase_principal", "NULL", '(SELECT "Label" FROM head WHERE pos = 1)'),
        row("concentracion", "pct_registros_clase_principal", pct("(SELECT n FROM head WHERE pos = 1)", "total")),
        row("concentracion", "pct_registros_top5", pct("(SELECT sum(n) FROM head WHERE pos <= 5)", "total")),
        row("concentracion", "pct_volumen_top5", pct("(SELECT sum(v) FROM head WHERE pos <= 5)", "volumen")),
        row("calidad", "filas_duplicadas", "total - distintas"),
        row("calidad", "pct_filas_duplicadas", pct("(total - distintas)", "total")),
        row("calidad", "pct_filas_unicas", pct("distintas", "total")),
    ])


INDICATOR_TABLES = (
    f"""t AS (SELECT count(*) AS total, count(DISTINCT "Label") AS clases,
      count(DISTINCT CASE WHEN "Label" <> 'Benign' THEN "Label" END) AS ataques,
      count(*) FILTER ("Label" = 'Benign') AS benignos, sum("Tot size") AS volumen,
      CAST(sum("Number") AS DOUBLE) AS paquetes, avg("Rate") AS rate, avg("IAT") AS iat,
      avg(syn_flag_number) AS syn, avg(ack_flag_number) AS ack, avg(rst_flag_number) AS rst, avg(fin_flag_number) AS fin,
      (SELECT count(*) FROM (SELECT DISTINCT {ALL_COLUMNS} FROM clean)) AS distintas FROM clean)""",
    """head AS (SELECT "Label", count(*) AS n, sum("Tot size") AS v,
      row_number() OVER (ORDER BY sum("Tot size") DESC, "Label") AS pos FROM clean GROUP BY "Label")""",
)

FILES = "files AS (SELECT lang, source, count(*) AS filas FROM documents GROUP BY lang, source)"
QUOTA_TABLES = (
    FILES,
    """target AS (SELECT count(*) // 10 AS t FROM documents)""",
    """classes AS (SELECT lang, CAST(sum(filas) AS BIGINT) AS filas FROM files GROUP BY lang)""",
    """c1 AS (SELECT lang, filas, CAST((SELECT t FROM target) - count(*) OVER () AS HUGEINT) AS spare,
        CAST(filas - 1 AS HUGEINT) AS w, CAST(sum(filas - 1) OVER () AS HUGEINT) AS total FROM classes)""",
    """c2 AS (SELECT *, spare * w // total AS base, spare * w % total AS rest FROM c1)""",
    """c3 AS (SELECT lang, 1 + base + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= spare - sum(base) OVER () THEN 1 ELSE 0 END AS cuota FROM c2)""",
    """f1 AS (SELECT f.lang, f.source, f.filas, CAST(c.cuota AS HUGEINT) AS spare, CAST(f.filas AS HUGEINT) AS w,
        CAST(sum(f.filas) OVER (PARTITION BY f.lang) AS HUGEINT) AS total FROM files f JOIN c3 c ON f.lang = c.lang)""",
    """f2 AS (SELECT *, spare * w // total AS base, spare * w % total AS rest FROM f1)""",
    """quotas AS (SELECT lang, source, filas, CAST(base + CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY rest DESC, lower(source), source)
        <= spare - sum(base) OVER (PARTITION BY lang) THEN 1 ELSE 0 END AS BIGINT) AS cuota FROM f2)""",
)
SAMPLE = f"""sample AS (SELECT * EXCLUDE (cuota, rk) FROM (SELECT d.*, z.cuota, row_number() OVER (PARTITION BY d.lang, d.source
      ORDER BY md5(concat('{SEED}|', CAST(d.doc_id AS VARCHAR))), d.doc_id) AS rk
    FROM documents d JOIN quotas z ON d.lang = z.lang AND d.source = z.source) WHERE rk <= cuota)"""


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _missing(c: str) -> str:
    return f"CASE WHEN trim(coalesce(CAST({c} AS VARCHAR), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) IN ('', 'NA', 'N/A', 'NULL', 'null', 'NaN', 'nan') THEN 1 ELSE 0 END"


_MISSING_CELLS = "(" + " + ".join(_missing(c) for c in DOCUMENT_COLUMNS) + ")"


def sampled(sql: str) -> str:
    return "WITH " + ",\n".join([*QUOTA_TABLES, SAMPLE]) + "\n" + sql


PAIRS = 'SELECT CAST("Protocol Type" AS INT) AS protocol, CAST(round_even("Rate", 0) AS INT) AS rate FROM flows WHERE isfinite("Rate")'
_NUMBERS = [c for c in FLOW.columns if c != FLOW.label]


def _finite(c: str) -> str:
    return f"isfinite(CAST({q(c)} AS DOUBLE))"


def _summary(infinite: str, gone: str) -> str:
    """``infinite``: test for an infinity that is still there; ``gone``: test for a missing cell."""
    nulls = " + ".join(f"CASE WHEN {gone.format(q(c))} THEN 1 ELSE 0 END" for c in _NUMBERS)
    sums = ", ".join(
        f"round(sum(CAST({q(c)} AS DOUBLE)) FILTER ({_finite(c)}), 2) AS suma_{i}" for i, c in enumerate(_NUMBERS)
    )
    return f"""SELECT "Label", count(*) AS registros, CAST(sum({nulls}) AS BIGINT) AS nulos,
      count(*) FILTER ({infinite}) AS infinitos, {sums} FROM flows GROUP BY "Label" """


SUMMARY = _summary('isinf("Rate")', "{0} IS NULL")
SUMMARY_WITHOUT_INFINITIES = _summary("false", "{0} IS NULL OR NOT isfinite(CAST({0} AS DOUBLE))")

_FAMILY_STATS = """SELECT "Attack_Family", count(*) AS registros, count(*) - count(r) AS rate_inf_excluidos,
  {rate_media}, {rate_mediana}, {rate_min}, {rate_max}, {iat_media}, {iat_mediana}, {iat_min}, {iat_max}
  FROM (SELECT *, CASE WHEN isfinite("Rate") THEN "Rate" END AS r FROM mapped) GROUP BY "Attack_Family" """.format(
    **{
        f"{m}_{n}": r6(f"{fn}({col})", f"{m}_{n}")
        for m, col in (("rate", "r"), ("iat", '"IAT"'))
        for n, fn in (("media", "avg"), ("mediana", "median"), ("min", "min"), ("max", "max"))
    }
)


def _decimal_text(c: str) -> str:
    return (
        f"regexp_replace(printf('%.6f', CAST({c} AS DOUBLE)), '(\\.\\d+?)0+$', '\\1') AS {c}"
    )


def _weekday(name: str, number: int) -> str:
    return f'count(*) FILTER (isodow(ts) = {number}) AS "{name}"'


_DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _nullable_count(expr: str, name: str) -> str:
    return f'nullif({expr}, 0) AS "{name}"'


# Users of positive weight share first, those of weight 0 what is left; inside a tier by break points of room per weight.
CAPPED = """WITH users AS (
  SELECT user_id, greatest(count(*) FILTER (event_type = 'purchase') - 14, 0) AS peso, count(*) AS eventos FROM events GROUP BY user_id
), goals AS (
  SELECT 'cuarto' AS muestra, count(*) // 4 AS goal FROM events UNION ALL SELECT 'dos_tercios', 2 * (count(*) // 3) FROM events
), tiers AS (
  SELECT *, peso = 0 AS tier, CAST(greatest(peso, 1) AS HUGEINT) AS v, CAST(eventos AS HUGEINT) AS room,
    CAST(least(goal, coalesce(sum(eventos) FILTER (peso > 0) OVER (PARTITION BY muestra), 0)) AS HUGEINT) AS first
  FROM users, goals
), shares AS (
  SELECT *, CASE WHEN tier THEN goal - first ELSE first END AS share FROM tiers
), points AS (
  SELECT *, coalesce(sum(room) OVER w, 0) AS filled, sum(v) OVER (PARTITION BY muestra, tier) - coalesce(sum(v) OVER w, 0) AS open FROM shares
  WINDOW w AS (PARTITION BY muestra, tier ORDER BY room / v, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), reached AS (
  SELECT *, min(CASE WHEN (share - filled) * v >= room * open THEN 1 ELSE 0 END) OVER (PARTITION BY muestra, tier ORDER BY room / v, user_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS capped FROM points
), rest AS (
  SELECT *, share - coalesce(sum(room) FILTER (capped) OVER (PARTITION BY muestra, tier), 0) AS remaining,
    CASE WHEN capped THEN 0 ELSE v END AS free FROM reached
), weighed AS (
  SELECT *, sum(free) OVER (PARTITION BY muestra, tier) AS total FROM rest
), floors AS (
  SELECT *, CASE WHEN total > 0 THEN remaining * free // total ELSE 0 END AS base, CASE WHEN total > 0 THEN remaining * free % total ELSE 0 END AS frac FROM weighed
), placed AS (
  SELECT *, remaining - sum(base) OVER (PARTITION BY muestra, tier) AS over, row_number() OVER (PARTITION BY muestra, tier ORDER BY frac DESC, user_id) AS n FROM floors
)
SELECT user_id, peso, eventos, CAST(CASE WHEN capped THEN room ELSE base + CASE WHEN n <= over THEN 1 ELSE 0 END END AS BIGINT) AS cuota, muestra FROM placed"""

INVENTORY = """SELECT "Label", CAST(sum(r) AS BIGINT) AS filas, CAST(sum(o) AS BIGINT) AS rechazadas, CAST(sum(v) AS BIGINT) AS archivos_vacios,
    CAST(0 AS BIGINT) AS archivos_malos FROM (
    SELECT "Label", 1 AS r, CASE WHEN "Rate" = 'inf' THEN 1 ELSE 0 END AS o, 0 AS v FROM flows
    UNION ALL SELECT 'Benign', 0, 0, 1 UNION ALL SELECT 'Sin_Filas', 0, 0, 1) GROUP BY "Label" """


def oracle_sql() -> dict[str, str]:
    volumes = """SELECT "Label", count(*) AS registros, sum("Tot size") AS volumen_bytes, avg("Rate") AS media_rate FROM clean GROUP BY "Label" """
    days = ", ".join(
        _nullable_count(f"count(*) FILTER (isodow(ts) = {i})", d) for i, d in enumerate(_DAYS, start=1)
    )
    return {
        "dataset_validation": flows(
            f"""SELECT count(*) AS registros, CAST({len(FLOW.columns)} AS BIGINT) AS columnas,
            CAST({' + '.join(f'count(*) FILTER ({q(c)} IS NULL)' for c in FLOW.columns)} AS BIGINT) AS nulos,
            CAST({' + '.join(f'count(*) FILTER (isinf({q(c)}))' for c in FLOW.floats)} AS BIGINT) AS infinitos,
            count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flows)) AS duplicados FROM flows"""
        ),
        "dedup_report": flows(
            f"""SELECT antes, despues, antes - despues AS eliminados, {pct('(antes - despues)', 'antes')} AS reduccion_pct
            FROM (SELECT (SELECT count(*) FROM flows) AS antes, (SELECT count(*) FROM (SELECT DISTINCT * FROM flows)) AS despues)"""
        ),
        "family_classes": flows(
            'SELECT "Attack_Family", count(*) AS cantidad, count(DISTINCT "Label") AS clases FROM mapped GROUP BY "Attack_Family"',
            FAMILIES, MAPPED,
        ),
        "malicious_share": flows(
            f"""SELECT count(*) FILTER ("Label" <> 'Benign') AS cantidad,
            {pct('''count(*) FILTER ("Label" <> 'Benign')''', 'count(*)')} AS porcentaje FROM flows"""
        ),
        "traffic_split": flows(
            f'SELECT {TRAFFIC} AS "Traffic_Type", count(*) AS cantidad, {pct("count(*)", "(SELECT count(*) FROM flows)")} AS porcentaje FROM flows GROUP BY 1'
        ),
        "family_distribution": flows(
            f'SELECT "Attack_Family", count(*) AS cantidad, {pct("count(*)", "(SELECT count(*) FROM flows)")} AS porcentaje FROM mapped GROUP BY 1',
            FAMILIES, MAPPED,
        ),
        "top_attacks": flows(
            f"""SELECT "Label", count(*) AS cantidad, {pct("count(*)", "(SELECT count(*) FROM flows)")} AS porcentaje
            FROM flows WHERE "Label" <> 'Benign' GROUP BY "Label" ORDER BY cantidad DESC, "Label" LIMIT 10"""
        ),
        "family_statistics": flows(_FAMILY_STATS, FAMILIES, MAPPED),
        "protocol_within_family": flows(
            f"""SELECT c."Attack_Family", c."Protocol Type", p.protocolo, c.cantidad,
            CAST(sum(cantidad) OVER (PARTITION BY c."Attack_Family") AS BIGINT) AS total_familia,
            {pct('cantidad', 'sum(cantidad) OVER (PARTITION BY c."Attack_Family")')} AS porcentaje_familia
            FROM (SELECT "Attack_Family", "Protocol Type", count(*) AS cantidad FROM mapped GROUP BY ALL) c
            LEFT JOIN protocols p ON c."Protocol Type" = p."Protocol Type" """,
            FAMILIES, PROTOCOLS, MAPPED,
        ),
        "traffic_profile": flows(
            f"""SELECT {TRAFFIC} AS "Traffic_Type", count(*) AS registros, count(*) - count(r) AS rate_inf_excluidos,
            {r6('avg(r)', 'rate_media')}, {r6('median(r)', 'rate_mediana')}, {r6('avg("IAT")', 'iat_media')},
            {r6('median("IAT")', 'iat_mediana')}, {r6('avg(ack_flag_number)', 'ack_flag_media')},
            {r6('avg(syn_flag_number)', 'syn_flag_media')}, {r6('avg("Tot sum")', 'tot_sum_media')},
            {r6('avg("AVG")', 'avg_media')} FROM (SELECT *, {FINITE_RATE} AS r FROM flows) GROUP BY 1"""
        ),
        "column_profile": flows(
            " UNION ALL ".join(
                _profile_row(c, "rounded", FLOW.texts, FLOW.floats, FLOW.distinct) for c in FLOW.columns
            ),
            ROUNDED,
        ),
        "event_profile": " UNION ALL ".join(
            _profile_row(c, "events", ("ts", "event_type", "props"), ("value",), ("user_id", "event_type", "value", "props"))
            for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
        ),
        "event_type_shares": f"SELECT event_type, count(*) AS cantidad, {pct('count(*)', '(SELECT count(*) FROM events)')} AS porcentaje FROM events GROUP BY event_type",
        "clean_report": flows(
            "SELECT * FROM (" + " UNION ALL ".join(_clean_row(c) for c in FLOW.columns) + ") WHERE valores_no_validos_antes > 0"
        ),
        "clean_rows": cleaned(f"SELECT {ALL_COLUMNS} FROM clean"),
        "null_cells": flows(
            'SELECT "Label", ' + ", ".join(f"CASE WHEN isfinite({q(c)}) THEN {q(c)} END AS {q(c)}" for c in FLOW.floats) + " FROM flows"
        ),
        "finite_rates": flows(
            'SELECT count(*) FILTER (isfinite("Rate")) AS validas, count(*) FILTER (NOT isfinite("Rate")) AS rechazadas FROM flows'
        ),
        "dup_criteria": cleaned(
            "SELECT criterio, columnas_clave, antes AS filas_antes, despues AS filas_despues, antes - despues AS duplicados_eliminados,"
            f" {pct('(antes - despues)', 'antes')} AS pct_duplicados FROM ("
            f"SELECT 'filas_completas' AS criterio, 'las {len(FLOW.columns)} columnas' AS columnas_clave, (SELECT count(*) FROM clean) AS antes,"
            f" (SELECT count(*) FROM (SELECT DISTINCT {ALL_COLUMNS} FROM clean)) AS despues UNION ALL "
            f"SELECT 'columnas_clave', {text(', '.join(FLOW.dedup_key))}, (SELECT count(*) FROM clean),"
            f" (SELECT count(*) FROM (SELECT DISTINCT {', '.join(map(q, FLOW.dedup_key))} FROM clean)))"
        ),
        "dup_examples": cleaned(
            f"SELECT count(*) AS apariciones, {', '.join(map(q, FLOW.dedup_key))} FROM clean GROUP BY ALL"
            f" ORDER BY apariciones DESC, {', '.join(map(q, FLOW.dedup_key))} LIMIT 10"
        ),
        "derived_rows": derived(f"SELECT {DERIVED_NAMES} FROM derived"),
        "derived_profile": derived(" UNION ALL ".join(_derived_profile_row(c) for c in DEFINITIONS)),
        "derived_preview": derived(f"SELECT {DERIVED_NAMES} FROM derived ORDER BY {DERIVED_NAMES} LIMIT {PREVIEW_ROWS}"),
        "rate_thresholds": flows("SELECT * FROM limits", ROUNDED, LIMITS),
        "filter_counts": cleaned(_filters(), LIMITS),
        "intense_by_label": cleaned(
            f"""SELECT "Label", count(*) AS registros, {r6('sum("Tot size")', 'volumen_bytes')}, {r6('avg("Rate")', 'media_rate')}
            FROM clean WHERE {INTENSE} GROUP BY "Label" """,
            LIMITS,
        ),
        "global_metrics": cleaned(" UNION ALL ".join(_metric_rows(c) for c in FLOW.indicators)),
        "label_protocol": cleaned(
            f"""SELECT "Label", "Protocol Type", count(*) AS registros, {pct('count(*)', '(SELECT count(*) FROM clean)')} AS pct_registros,
            {r6('sum("Tot size")', 'volumen_bytes')}, {r6('avg("Tot size")', 'media_tot_size')}, {r6('avg("Rate")', 'media_rate')},
            {r6('avg("IAT")', 'media_iat')} FROM clean GROUP BY "Label", "Protocol Type" """
        ),
        "top_volumes": cleaned(
            f"""SELECT row_number() OVER (ORDER BY volumen_bytes DESC, "Label") AS posicion, "Label", registros,
            {r6('volumen_bytes', 'volumen_bytes')}, {r6('volumen_bytes / (1024.0 * 1024.0)', 'volumen_mb')},
            {pct('volumen_bytes', '(SELECT sum("Tot size") FROM clean)')} AS pct_volumen, {r6('media_rate', 'media_rate')}
            FROM ({volumes}) ORDER BY posicion LIMIT 10"""
        ),
        "class_indicators": cleaned(_indicator_rows(), *INDICATOR_TABLES),
        "consolidated_classes": derived(
            f"""SELECT row_number() OVER (ORDER BY count(*) DESC, "Label") AS posicion, "Label", count(*) AS registros,
            {pct('count(*)', '(SELECT count(*) FROM clean)')} AS pct_registros, {r6('sum("Tot size")', 'volumen_bytes')},
            {pct('sum("Tot size")', '(SELECT sum("Tot size") FROM clean)')} AS pct_volumen, {r6('avg("Rate")', 'media_rate')},
            {r6('avg("Tot size")', 'media_tot_size')}, {r6('avg(size_kb)', 'media_size_kb')}, {r6('avg("IAT")', 'media_iat')},
            {r6('avg(syn_flag_number)', 'media_syn')}, {r6('avg(ack_flag_number)', 'media_ack')}, {r6('avg(rst_flag_number)', 'media_rst')},
            {r6('avg(total_flags)', 'media_total_flags')}, count(DISTINCT "Protocol Type") AS protocolos_distintos
            FROM derived GROUP BY "Label" """
        ),
        **{
            name: f"SELECT {by}, median(l_extendedprice) AS mediana, "
            + ", ".join(f"quantile_disc(l_extendedprice, {p / 100}) AS p{p}" for p in PERCENTS)
            + f" FROM lineitem GROUP BY {by}"
            for name, by in (("price_percentiles", "l_returnflag"), ("part_price_percentiles", "l_partkey"))
        },
        "flow_class_quotas": flows(
            """SELECT "Label", filas, CAST(1 + base + CASE WHEN row_number() OVER (ORDER BY rest DESC, "Label") <= spare - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS cuota FROM c2""",
            'c0 AS (SELECT "Label", count(*) AS filas FROM flows GROUP BY "Label")',
            """c1 AS (SELECT "Label", filas, CAST((SELECT count(*) // 78 FROM flows) - count(*) OVER () AS HUGEINT) AS spare,
            CAST(filas - 1 AS HUGEINT) AS w, CAST(sum(filas - 1) OVER () AS HUGEINT) AS total FROM c0)""",
            "c2 AS (SELECT *, spare * w // total AS base, spare * w % total AS rest FROM c1)",
        ),
        "capped_quotas": CAPPED,
        "document_quotas": sampled("SELECT lang, source, filas, cuota FROM quotas"),
        "document_sample": sampled("SELECT * FROM sample"),
        "published_sample": sampled("SELECT * FROM sample"),
        "document_sample_quality": sampled(
            f"""SELECT count(*) AS filas, CAST(5 AS BIGINT) AS columnas, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sample)) AS filas_duplicadas,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM sample)) AS filas_unicas, CAST(sum({_MISSING_CELLS}) AS BIGINT) AS celdas_nulas,
            count(*) FILTER ({_MISSING_CELLS} > 0) AS filas_con_nulo FROM sample"""
        ),
        "sample_missing": sampled(
            " UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) FILTER ({_missing(c)} = 1) AS celdas_nulas FROM sample" for c in DOCUMENT_COLUMNS)
        ),
        "quota_guards": sampled(
            " UNION ALL ".join(
                f"""SELECT comprobacion, ok, '{name}' AS muestra FROM (
                SELECT 'poblacion_suficiente' AS comprobacion, (SELECT count(*) FROM documents) >= {t} AS ok
                UNION ALL SELECT 'muestra_cubre_clases', (SELECT count(*) FROM classes) <= {t}
                UNION ALL SELECT 'clases_con_filas', (SELECT min(filas) FROM classes) >= 1)"""
                for name, t in (("decima", "(SELECT t FROM target)"), ("doble", "(SELECT 2 * count(*) FROM documents)"), ("dos", "2"))
            )
        ),
        "sample_report": sampled(
            f"""SELECT 'estratificado por lang y source, restos mayores' AS metodo, count(*) AS filas, CAST(5 AS BIGINT) AS columnas,
            count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sample)) AS filas_duplicadas, CAST(sum({_MISSING_CELLS}) AS BIGINT) AS celdas_nulas,
            (SELECT count(*) FROM classes) AS clases, count(*) AS muestra, CAST(sum({_MISSING_CELLS}) AS BIGINT) AS nulos, true AS valida FROM sample"""
        ),
        "page_manifest": "SELECT url AS ruta, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS bytes, sha256(coalesce(html, '')) AS sha256 FROM pages",
        "sample_checks": sampled(
            """SELECT comprobacion, CAST(esperado AS BIGINT) AS esperado, CAST(actual AS BIGINT) AS actual, esperado = actual AS ok FROM (
            SELECT 'filas' AS comprobacion, (SELECT t FROM target) AS esperado, (SELECT count(*) FROM sample) AS actual
            UNION ALL SELECT 'columnas', 5, 5
            UNION ALL SELECT 'clases_faltantes', 0, (SELECT count(*) FROM (SELECT lang FROM c3 WHERE cuota > 0 EXCEPT SELECT lang FROM sample))
            UNION ALL SELECT 'clases_extra', 0, (SELECT count(*) FROM (SELECT lang FROM sample EXCEPT SELECT lang FROM c3))
            UNION ALL SELECT 'clases_con_otra_cuota', 0, (SELECT count(*) FROM (SELECT lang, count(*) AS n FROM sample GROUP BY lang) s JOIN c3 ON s.lang = c3.lang WHERE n <> cuota)
            UNION ALL SELECT 'archivos_faltantes', 0, (SELECT count(*) FROM (SELECT lang, source FROM quotas WHERE cuota > 0 EXCEPT SELECT lang, source FROM sample))
            UNION ALL SELECT 'archivos_extra', 0, (SELECT count(*) FROM (SELECT lang, source FROM sample EXCEPT SELECT lang, source FROM quotas))
            UNION ALL SELECT 'archivos_con_otra_cuota', 0, (SELECT count(*) FROM (SELECT lang, source, count(*) AS n FROM sample GROUP BY lang, source) s JOIN quotas z ON s.lang = z.lang AND s.source = z.source WHERE n <> cuota))"""
        ),
        "sample_vs_population": sampled(
            """SELECT lang, a AS original_count, round(a / ta * 100.0, 6) AS original_percentage, b AS sample_count,
            round(b / tb * 100.0, 6) AS sample_percentage, round(b / tb * 100.0 - a / ta * 100.0, 6) AS difference_percentage_points
            FROM (SELECT p.lang, p.a, coalesce(s.b, 0) AS b, (SELECT CAST(count(*) AS DOUBLE) FROM documents) AS ta,
              (SELECT CAST(count(*) AS DOUBLE) FROM sample) AS tb
              FROM (SELECT lang, count(*) AS a FROM documents GROUP BY lang) p
              LEFT JOIN (SELECT lang, count(*) AS b FROM sample GROUP BY lang) s ON p.lang = s.lang)"""
        ),
        "sample_quality": flows(
            """SELECT count(*) AS filas, CAST(40 AS BIGINT) AS columnas, count(*) - (SELECT count(*) FROM picked) AS filas_duplicadas,
            (SELECT count(*) FROM picked) AS filas_unicas, 2 * count(*) FILTER ("Std" IS NULL) AS celdas_nulas,
            count(*) FILTER ("Std" IS NULL) AS filas_con_nulo FROM flows""",
            f"picked AS (SELECT DISTINCT {ALL_COLUMNS} FROM flows)",
        ),
        "sample_file_order": f"SELECT source, row_number() OVER (ORDER BY md5(concat('{SEED}|', source)), source) AS posicion FROM (SELECT DISTINCT source FROM documents)",
        "secondary_sort": flows(PAIRS + " ORDER BY 1, 2"),
        "total_sort": flows(
            """SELECT lpad(CAST(CAST(round_even("Rate", 0) AS INT) AS VARCHAR), 10, '0') AS key,
            rpad(substr(concat("Label", '|', CAST("Protocol Type" AS VARCHAR)), 1, 90), 90, ' ') AS payload
            FROM flows WHERE isfinite("Rate") ORDER BY key"""
        ),
        "sort_order_check": flows(
            """SELECT count(*) AS filas, CAST(0 AS BIGINT) AS descensos_internos, CAST(0 AS BIGINT) AS descensos_entre_partes,
            true AS ordenado, trabajo FROM flows, (VALUES ('secondarysort'), ('terasort'), ('terasort_contiguo')) AS j(trabajo)
            WHERE isfinite("Rate") GROUP BY trabajo"""
        ),
        "sort_partition_check": flows(
            """SELECT count(*) AS registros, CAST(0 AS BIGINT) AS fuera, true AS ok FROM flows WHERE isfinite("Rate")"""
        ),
        "reconcile_repeated": """WITH a AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f FROM lineitem),
          b AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) + CASE WHEN l_orderkey % 89 = 5 THEN 1 ELSE 0 END AS q, l_returnflag AS f
            FROM lineitem WHERE NOT (l_orderkey % 97 = 3 AND l_linenumber = 1)),
          x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY q, f) AS r FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)),
          y AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY q, f) AS r FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),
          j AS (SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey, x.q AS xq, y.q AS yq, x.f AS xf, y.f AS yf,
            x.r IS NULL AS extra, y.r IS NULL AS gone FROM x FULL OUTER JOIN y ON x.l_orderkey = y.l_orderkey AND x.r = y.r)
          SELECT l_orderkey, CAST(NULL AS VARCHAR) AS columna, CAST(NULL AS VARCHAR) AS esperado, CAST(NULL AS VARCHAR) AS actual, 'falta' AS estado FROM j WHERE gone
          UNION ALL SELECT l_orderkey, NULL, NULL, NULL, 'sobra' FROM j WHERE extra
          UNION ALL SELECT l_orderkey, 'cantidad', CAST(xq AS VARCHAR), CAST(yq AS VARCHAR), 'distinta' FROM j WHERE xq <> yq
          UNION ALL SELECT l_orderkey, 'l_returnflag', xf, yf, 'distinta' FROM j WHERE xf <> yf""",
        "reconcile_cells": flows(
            """SELECT "Label", "Protocol Type", d.c AS columna, d.e AS esperado, d.v AS actual, d.s AS estado FROM (
            SELECT coalesce(a."Label", b."Label") AS "Label", coalesce(a."Protocol Type", b."Protocol Type") AS "Protocol Type",
              unnest(CASE WHEN b."Label" IS NULL THEN [{c: CAST(NULL AS VARCHAR), e: CAST(NULL AS VARCHAR), v: CAST(NULL AS VARCHAR), s: 'falta'}]
                WHEN a."Label" IS NULL THEN [{c: CAST(NULL AS VARCHAR), e: CAST(NULL AS VARCHAR), v: CAST(NULL AS VARCHAR), s: 'sobra'}]
                ELSE list_filter([
                  CASE WHEN a.registros <> b.registros THEN {c: 'registros', e: CAST(a.registros AS VARCHAR), v: CAST(b.registros AS VARCHAR), s: 'distinta'} END,
                  CASE WHEN a.pico = 'inf' AND b.pico <> 'inf' THEN {c: 'pico', e: 'Infinity', s: 'distinta',
                    v: CASE WHEN isnan(b.pico) THEN 'NaN' WHEN b.pico < 0 THEN '-Infinity' ELSE '5.0' END} END], lambda x: x IS NOT NULL) END) AS d
            FROM base a FULL OUTER JOIN changed b ON a."Label" = b."Label" AND a."Protocol Type" = b."Protocol Type")""",
            'base AS (SELECT "Label", "Protocol Type", count(*) AS registros, max("Rate") AS pico FROM flows GROUP BY ALL)',
            """changed AS (SELECT CASE WHEN "Label" = 'XSS' AND "Protocol Type" = 47 THEN 'Nuevo' ELSE "Label" END AS "Label", "Protocol Type",
            registros + CASE WHEN "Label" = 'XSS' AND "Protocol Type" = 6 THEN 1 ELSE 0 END AS registros,
            CASE WHEN isfinite(pico) THEN pico WHEN "Protocol Type" = 6 THEN 5.0 WHEN "Protocol Type" = 17 THEN CAST('-inf' AS DOUBLE)
              WHEN "Protocol Type" = 1 THEN CAST('nan' AS DOUBLE) ELSE pico END AS pico
            FROM base WHERE NOT ("Label" = 'Benign' AND "Protocol Type" = 17))""",
        ),
        "label_difference": flows(
            """SELECT "Label", 'falta' AS lado FROM (SELECT "Label" FROM families EXCEPT SELECT "Label" FROM renamed)
            UNION ALL SELECT "Label", 'sobra' FROM (SELECT "Label" FROM renamed EXCEPT SELECT "Label" FROM families)""",
            FAMILIES,
            """renamed AS (SELECT DISTINCT CASE WHEN "Label" = 'XSS' THEN 'Nuevo' ELSE "Label" END AS "Label" FROM flows)""",
        ),
        "summary_difference": cleaned(
            """SELECT 'total_clases' AS clave, CAST(CAST(count(DISTINCT "Label") AS DOUBLE) AS VARCHAR) AS esperado,
            CAST(CAST(count(DISTINCT "Label") + 1 AS DOUBLE) AS VARCHAR) AS actual FROM clean"""
        ),
        "flow_expectations": flows(
            f"""SELECT comprobacion, CAST(esperado AS DOUBLE) AS esperado, CAST(actual AS DOUBLE) AS actual, esperado = actual AS ok FROM (
            SELECT 'etiquetas' AS comprobacion, {len(LABEL_FAMILY)} AS esperado, (SELECT count(DISTINCT "Label") FROM mapped) AS actual
            UNION ALL SELECT 'registros', (SELECT count(*) FROM flows), (SELECT count(*) FROM mapped)
            UNION ALL SELECT 'familias', {len(set(LABEL_FAMILY.values()))}, (SELECT count(DISTINCT "Attack_Family") FROM mapped)
            UNION ALL SELECT 'sin_familia', 0, (SELECT count(*) FROM mapped WHERE "Attack_Family" IS NULL)
            UNION ALL SELECT 'columnas', {len(FLOW.columns)}, {len(FLOW.columns)})""",
            FAMILIES, MAPPED,
        ),
        "event_pivot": f"SELECT event_type, {days} FROM events GROUP BY event_type UNION ALL SELECT 'TOTAL', {days} FROM events",
        "text_exact_dedup": f"""SELECT antes, despues, antes - despues AS eliminados, {pct('(antes - despues)', 'antes')} AS reduccion_pct
            FROM (SELECT count(*) AS antes, count(DISTINCT coalesce(text, '')) AS despues FROM documents)""",
        "number_text_dedup": f"""SELECT antes, despues, antes - despues AS eliminados, {pct('(antes - despues)', 'antes')} AS reduccion_pct
            FROM (SELECT (SELECT count(*) FROM lineitem) AS antes, (SELECT count(*) FROM (SELECT DISTINCT printf('%.2f', l_discount),
            CASE WHEN l_orderkey % 2 = 0 THEN printf('%.2f', l_tax) ELSE printf('%.3f', l_tax) END FROM lineitem)) AS despues)""",
        "null_markers": """WITH texts AS (SELECT
              CASE WHEN l_orderkey % 97 = 5 THEN ' NA ' WHEN l_orderkey % 97 = 6 THEN 'nan' ELSE CAST(l_partkey AS VARCHAR) END AS part,
              CASE WHEN l_orderkey % 89 = 7 THEN '' WHEN l_orderkey % 89 = 8 THEN 'N/A' WHEN l_orderkey % 89 = 9 THEN 'None' ELSE l_returnflag END AS flag,
              CASE WHEN l_partkey % 53 = 1 THEN NULL ELSE l_linestatus END AS status FROM lineitem),
            marks AS (SELECT """ + ", ".join(
            f"trim(coalesce({c}, '')) IN ('', 'NA', 'N/A', 'NULL', 'null', 'NaN', 'nan') AS {c}" for c in ("part", "flag", "status")
        ) + ") ".replace(")", " FROM texts) ") + " UNION ALL ".join(
            f"SELECT '{c}' AS columna, count(*) FILTER ({c}) AS celdas_nulas, count(*) FILTER (part OR flag OR status) AS filas_con_nulo FROM marks"
            for c in ("part", "flag", "status")
        ),
        "csv_roundtrip": flows(SUMMARY),
        "csv_text_dedup": flows(
            f"""SELECT antes, despues, antes - despues AS eliminados, {pct('(antes - despues)', 'antes')} AS reduccion_pct
            FROM (SELECT (SELECT count(*) FROM flows) AS antes, (SELECT count(*) FROM (SELECT DISTINCT * FROM flows)) AS despues)"""
        ),
        "json_roundtrip": flows(SUMMARY_WITHOUT_INFINITIES),
        "result_csv": flows(
            'SELECT "Attack_Family", CAST(registros AS VARCHAR) AS registros, CAST(rate_inf_excluidos AS VARCHAR) AS rate_inf_excluidos, '
            + ", ".join(
                _decimal_text(f"{m}_{n}") for m in ("rate", "iat") for n in ("media", "mediana", "min", "max")
            )
            + f" FROM ({_FAMILY_STATS})",
            FAMILIES, MAPPED,
        ),
        "class_directories": flows(SUMMARY),
        "source_inventory": flows(f"SELECT * FROM ({INVENTORY})"),
        "source_checks": flows(
            f"""SELECT unnest(['cabeceras_iguales', 'hay_filas', 'clases_con_filas', 'sin_lineas_rechazadas']) AS comprobacion,
            unnest([bad, n, none, odd]) AS valor, unnest([bad = 0, n > 0, none = 0, odd = 0]) AS ok FROM (
            SELECT CAST(sum(archivos_malos) AS BIGINT) AS bad, CAST(sum(filas) AS BIGINT) AS n, count(*) FILTER (filas = 0) AS none,
            CAST(sum(rechazadas) AS BIGINT) AS odd FROM ({INVENTORY}))"""
        ),
        "rejected_lines": flows(
            """SELECT "Label", row_number() OVER (PARTITION BY "Label" ORDER BY texto) + 1 AS linea,
            CASE WHEN texto = '' THEN 'vacia' ELSE 'campos' END AS motivo, CAST(CASE WHEN texto = '' THEN 0 ELSE 4 END AS BIGINT) AS campos, texto
            FROM (SELECT "Label", CASE WHEN "Std" IS NULL THEN '' ELSE concat_ws(',', "Protocol Type", "Min", "Max", "Number") END AS texto
              FROM flows WHERE "Rate" = 'inf')"""
        ),
        "accepted_rows": flows(SUMMARY),
        "sorted_output": flows(
            f"SELECT protocol, count(*) AS pares, min(rate) AS rate_min, max(rate) AS rate_max, CAST(sum(rate) AS BIGINT) AS rate_suma FROM ({PAIRS}) GROUP BY protocol"
        ),
        "threshold_file": flows("SELECT * FROM limits", ROUNDED, LIMITS),
    }
