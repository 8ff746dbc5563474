"""Counts, shares, filters and per-group statistics.

Counting by a class hierarchy first counts by the finest key and maps the few counts afterwards, so
rows are never joined to a dimension only to be counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowops.functions.columns import null_non_finite, pct, qcol, ratio, to_mb, traffic_type
from flowops.operators.deriving import lookup
from flowops.operators.duplicates import distinct_rows
from flowops.operators.percentiles import Limits, group_summary, median
from flowops.spec import Spec

FAMILY = "Attack_Family"
TRAFFIC = "Traffic_Type"
TOP = 10
HEAD_CLASSES = 5


def _total(name: str) -> Column:
    """Grand total as a window over the grouped rows, one per class or pair: no second scan."""
    return F.sum(name).over(Window.partitionBy())


def class_counts(df: DataFrame, spec: Spec) -> DataFrame:
    return df.groupBy(qcol(spec.label)).agg(F.count(F.lit(1)).alias("cantidad"))


def with_share(groups: DataFrame, part: str = "cantidad", name: str = "porcentaje") -> DataFrame:
    return groups.withColumn(name, pct(F.col(part), _total(part)))


def family_classes(df: DataFrame, spec: Spec, families: DataFrame) -> DataFrame:
    """Rows and distinct labels per family."""
    mapped = lookup(class_counts(df, spec), families, spec.label)
    return (
        mapped.groupBy(FAMILY)
        .agg(F.sum("cantidad").alias("cantidad"), F.count(qcol(spec.label)).alias("clases"))
        .orderBy(FAMILY)
    )


def malicious_share(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows whose label is not the benign one, and their share of all rows."""
    counts = df.agg(
        F.count_if(qcol(spec.label) != spec.benign).alias("cantidad"), F.count(F.lit(1)).alias("_all")
    )
    return counts.select("cantidad", pct(F.col("cantidad"), F.col("_all")).alias("porcentaje"))


def traffic_split(df: DataFrame, spec: Spec) -> DataFrame:
    """Benign against malicious with shares."""
    counts = class_counts(df, spec)
    split = counts.groupBy(traffic_type(qcol(spec.label), spec.benign).alias(TRAFFIC)).agg(
        F.sum("cantidad").alias("cantidad")
    )
    return with_share(split).orderBy(TRAFFIC)


def family_distribution(df: DataFrame, spec: Spec, families: DataFrame) -> DataFrame:
    """Families by size with shares; ties by name."""
    mapped = lookup(class_counts(df, spec), families, spec.label)
    sizes = mapped.groupBy(FAMILY).agg(F.sum("cantidad").alias("cantidad"))
    return with_share(sizes).orderBy(F.desc("cantidad"), FAMILY)


def top_attacks(df: DataFrame, spec: Spec, rows: int = TOP) -> DataFrame:
    """The largest labels other than the benign one, with their share of all rows."""
    shares = with_share(class_counts(df, spec))
    attacks = shares.where(qcol(spec.label) != spec.benign)
    return attacks.orderBy(F.desc("cantidad"), qcol(spec.label)).limit(rows)


def _finite_rate(df: DataFrame, spec: Spec) -> DataFrame:
    return df.withColumn(spec.rate, null_non_finite(qcol(spec.rate)))


def _excluded(spec: Spec) -> Column:
    return F.count(F.lit(1)) - F.count(qcol(spec.rate))


def _rounded(df: DataFrame, spec: Spec, names) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), spec.decimals) for n in names})


def family_statistics(
    df: DataFrame, spec: Spec, families: DataFrame
) -> DataFrame:
    """Per family: rows, rows without a finite rate, mean, exact median and range of rate and IAT."""
    rate, iat = qcol(spec.rate), qcol(spec.iat)
    mapped = lookup(
        _finite_rate(df.select(*map(qcol, (spec.label, spec.rate, spec.iat))), spec), families, spec.label
    )
    stats = group_summary(
        mapped,
        [FAMILY],
        [
            F.count(F.lit(1)).alias("registros"),
            _excluded(spec).alias("rate_inf_excluidos"),
            F.avg(rate).alias("rate_media"),
            F.min(rate).alias("rate_min"),
            F.max(rate).alias("rate_max"),
            F.avg(iat).alias("iat_media"),
            F.min(iat).alias("iat_min"),
            F.max(iat).alias("iat_max"),
        ],
        {"rate_mediana": median(spec.rate), "iat_mediana": median(spec.iat)},
    )
    names = [
        f"{m}_{s}" for m in ("rate", "iat") for s in ("media", "mediana", "min", "max")
    ]
    return _rounded(stats, spec, names).select(
        FAMILY, "registros", "rate_inf_excluidos", *names
    ).orderBy(FAMILY)


def protocol_within_family(
    df: DataFrame, spec: Spec, families: DataFrame, protocols: DataFrame
) -> DataFrame:
    """Protocols of each family with their share of the family.

    The family totals are a window over the counted pairs, at most one row per family and protocol.
    """
    pairs = df.groupBy(qcol(spec.label), qcol(spec.protocol)).agg(F.count(F.lit(1)).alias("_rows"))
    counted = (
        lookup(pairs, families, spec.label)
        .groupBy(FAMILY, qcol(spec.protocol))
        .agg(F.sum("_rows").alias("cantidad"))
    )
    shared = counted.withColumn(
        "total_familia", F.sum("cantidad").over(Window.partitionBy(FAMILY))
    ).withColumn("porcentaje_familia", pct(F.col("cantidad"), F.col("total_familia")))
    return lookup(shared, protocols, spec.protocol).select(
        FAMILY, qcol(spec.protocol), "protocolo", "cantidad", "total_familia", "porcentaje_familia"
    ).orderBy(FAMILY, qcol(spec.protocol))


def traffic_profile(df: DataFrame, spec: Spec) -> DataFrame:
    """Benign against malicious: rate, IAT, acknowledgement and opening flags, sizes."""
    typed = _finite_rate(df, spec).withColumn(TRAFFIC, traffic_type(qcol(spec.label), spec.benign))
    means = {
        "rate_media": spec.rate,
        "iat_media": spec.iat,
        "ack_flag_media": spec.ack,
        "syn_flag_media": spec.syn,
        "tot_sum_media": spec.total,
        "avg_media": spec.mean,
    }
    stats = group_summary(
        typed,
        [TRAFFIC],
        [
            F.count(F.lit(1)).alias("registros"),
            _excluded(spec).alias("rate_inf_excluidos"),
            *[F.avg(qcol(c)).alias(n) for n, c in means.items()],
        ],
        {"rate_mediana": median(spec.rate), "iat_mediana": median(spec.iat)},
    )
    names = [
        "rate_media", "rate_mediana", "iat_media", "iat_mediana",
        "ack_flag_media", "syn_flag_media", "tot_sum_media", "avg_media",
    ]
    return _rounded(stats, spec, names).select(
        TRAFFIC, "registros", "rate_inf_excluidos", *names
    ).orderBy(TRAFFIC)


def traffic_filters(spec: Spec, limits: Limits) -> Mapping[str, tuple[Column, Column, Column]]:
    """Named filters as (test, threshold, text); limits are scalar subqueries."""
    rate95, size95 = limits.at(spec.rate, 95), limits.at(spec.size, 95)
    size50, iat95 = limits.at(spec.size, 50), limits.at(spec.iat, 95)
    rate, size, iat = qcol(spec.rate), qcol(spec.size), qcol(spec.iat)
    fast = rate >= rate95
    return {
        "trafico_alto": (
            fast, rate95, F.format_string(f"{spec.rate} >= p95 (%.6f)", rate95)
        ),
        "paquetes_grandes": (
            size >= size95, size95, F.format_string(f"{spec.size} >= p95 (%.6f)", size95)
        ),
        "trafico_intenso": (
            fast & (size >= size50),
            rate95,
            F.format_string(
                f"{spec.rate} >= p95 (%.6f) y {spec.size} >= p50 (%.6f)", rate95, size50
            ),
        ),
        "iat_reducido": (
            (iat > 0) & (iat <= iat95), iat95, F.format_string(f"0 < {spec.iat} <= p95 (%.6f)", iat95)
        ),
    }


def filter_counts(df: DataFrame, spec: Spec, limits: Limits) -> DataFrame:
    """Rows passing each filter and their share; all filters in one scan."""
    filters = traffic_filters(spec, limits)
    wide = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(test).alias(f"n_{name}") for name, (test, _, _) in filters.items()],
    )
    rows = [
        F.struct(
            F.lit(name).alias("filtro"),
            text.alias("condicion"),
            limit.alias("umbral"),
            F.col(f"n_{name}").alias("filas_encontradas"),
            pct(F.col(f"n_{name}"), F.col("_all")).alias("pct_del_total"),
        )
        for name, (_, limit, text) in filters.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def intense_by_label(df: DataFrame, spec: Spec, limits: Limits) -> DataFrame:
    """Labels of the rows that are both fast and large."""
    test, _, _ = traffic_filters(spec, limits)["trafico_intenso"]
    grouped = df.where(test).groupBy(qcol(spec.label)).agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum(qcol(spec.size)).alias("volumen_bytes"),
        F.avg(qcol(spec.rate)).alias("media_rate"),
    )
    return _rounded(grouped, spec, ["volumen_bytes", "media_rate"]).orderBy(
        F.desc("registros"), qcol(spec.label)
    )


def label_protocol(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows, volume and means per label and protocol."""
    grouped = df.groupBy(qcol(spec.label), qcol(spec.protocol)).agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum(qcol(spec.size)).alias("volumen_bytes"),
        F.avg(qcol(spec.size)).alias("media_tot_size"),
        F.avg(qcol(spec.rate)).alias("media_rate"),
        F.avg(qcol(spec.iat)).alias("media_iat"),
    )
    shared = with_share(grouped, "registros", "pct_registros")
    means = ["volumen_bytes", "media_tot_size", "media_rate", "media_iat"]
    return _rounded(shared, spec, means).select(
        qcol(spec.label), qcol(spec.protocol), "registros", "pct_registros", *means
    ).orderBy(qcol(spec.label), qcol(spec.protocol))


def class_volumes(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows, volume and mean rate per class."""
    return df.groupBy(qcol(spec.label)).agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum(qcol(spec.size)).alias("volumen_bytes"),
        F.avg(qcol(spec.rate)).alias("media_rate"),
    )


def _position(*order: Column) -> Column:
    return F.row_number().over(Window.orderBy(*order))


def top_volumes(df: DataFrame, spec: Spec, rows: int = TOP) -> DataFrame:
    """The classes with most volume; the position is numbered on the few rows kept."""
    volumes = class_volumes(df, spec)
    order = (F.desc("volumen_bytes"), qcol(spec.label).asc())
    shared = volumes.withColumn(
        "pct_volumen", pct(F.col("volumen_bytes"), _total("volumen_bytes"))
    )
    head = shared.orderBy(*order).limit(rows)
    placed = head.withColumn("posicion", _position(*order).cast("bigint")).withColumn(
        "volumen_mb", to_mb(F.col("volumen_bytes"))
    )
    return _rounded(placed, spec, ["volumen_bytes", "volumen_mb", "media_rate"]).select(
        "posicion", qcol(spec.label), "registros", "volumen_bytes", "volumen_mb", "pct_volumen",
        "media_rate",
    ).orderBy("posicion")


def consolidated(df: DataFrame, spec: Spec) -> DataFrame:
    """One row per class: size, shares, means of the measures and derived variables, protocols.

    Grouped by class and protocol first, so the distinct protocols are a plain count of the few
    second-level rows. The position is numbered over one row per class.
    """
    means = {
        "media_rate": spec.rate,
        "media_tot_size": spec.size,
        "media_size_kb": "size_kb",
        "media_iat": spec.iat,
        "media_syn": spec.syn,
        "media_ack": spec.ack,
        "media_rst": spec.rst,
        "media_total_flags": "total_flags",
    }
    partial = df.groupBy(qcol(spec.label), qcol(spec.protocol)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(qcol(c)).alias(f"{n}_sum") for n, c in means.items()],
        *[F.count(qcol(c)).alias(f"{n}_count") for n, c in means.items()],
    )
    grouped = partial.groupBy(qcol(spec.label)).agg(
        F.sum("_rows").alias("registros"),
        F.sum("media_tot_size_sum").alias("volumen_bytes"),
        *[(F.sum(f"{n}_sum") / F.nullif(F.sum(f"{n}_count"), F.lit(0))).alias(n) for n in means],
        F.count(qcol(spec.protocol)).alias("protocolos_distintos"),
    )
    shared = grouped.withColumns(
        {
            "pct_registros": pct(F.col("registros"), _total("registros")),
            "pct_volumen": pct(F.col("volumen_bytes"), _total("volumen_bytes")),
            "posicion": _position(F.desc("registros"), qcol(spec.label).asc()).cast("bigint"),
        }
    )
    return _rounded(shared, spec, ["volumen_bytes", *means]).select(
        "posicion", qcol(spec.label), "registros", "pct_registros", "volumen_bytes", "pct_volumen",
        *means, "protocolos_distintos",
    ).orderBy("posicion")


def indicators(df: DataFrame, spec: Spec) -> DataFrame:
    """25 indicators in five categories (categoria, metrica, valor_num, valor_txt).

    One scan of the measures gives the classes, and the classes the totals; repeated rows are counted by
    digest. The leading classes come from a bounded top-n of the class rows.
    """
    flag_means = (spec.syn, spec.ack, spec.rst, spec.fin)
    summed = {
        "volumen": spec.size, "paquetes": spec.packets, "iat": spec.iat, "rate": spec.rate,
        **{f: f for f in flag_means},
    }
    classes = df.groupBy(qcol(spec.label)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(qcol(c).cast("double")).alias(f"_{n}") for n, c in summed.items()],
        *[F.count(qcol(c)).alias(f"_{n}_n") for n, c in summed.items()],
    )
    distinct = distinct_rows(df).select("distinct")
    label, rows = qcol(spec.label), F.col("_rows")
    totals = classes.agg(
        F.sum(rows).alias("total"),
        F.count(label).alias("clases"),
        F.count_if(label != spec.benign).alias("ataques"),
        F.coalesce(F.sum(F.when(label == spec.benign, rows)), F.lit(0)).alias("benignos"),
        *[F.sum(f"_{n}").alias(n) for n in summed],
        *[F.sum(f"_{n}_n").alias(f"{n}_n") for n in summed],
    )
    # The leader is the class with most volume; its share is a share of rows.
    head = (
        classes.select(label.alias("_label"), "_rows", "_volumen")
        .orderBy(F.desc("_volumen"), F.col("_label").asc())
        .limit(HEAD_CLASSES)
        .agg(
            F.sum("_rows").alias("rows"),
            F.sum("_volumen").alias("volume"),
            F.min(F.struct(-F.col("_volumen"), F.col("_label"), F.col("_rows").alias("n"))).alias("first"),
        )
        .select(F.struct("rows", "volume", F.col("first._label").alias("label"), F.col("first.n").alias("n")).alias("h"))
    )
    t = totals.withColumn("h", head.scalar()).withColumn("distintas", distinct.scalar())
    total, benign = F.col("total"), F.col("benignos")
    repeated = total - F.col("distintas")
    volume, packets = F.col("volumen"), F.col("paquetes")

    def mean(name: str) -> Column:
        """Mean of the cells that are there."""
        return F.col(name) / F.nullif(F.col(f"{name}_n"), F.lit(0))

    syn, ack, rst, fin = map(mean, flag_means)
    # Categories and names of the indicators.
    numbers = [
        ("poblacion", "total_registros", total),
        ("poblacion", "total_clases", F.col("clases")),
        ("poblacion", "clases_de_ataque", F.col("ataques")),
        ("poblacion", "registros_benignos", benign),
        ("poblacion", "registros_de_ataque", total - benign),
        ("poblacion", "pct_registros_benignos", pct(benign, total)),
        ("poblacion", "pct_registros_ataque", pct(total - benign, total)),
        ("volumen", "volumen_total_bytes", volume),
        ("volumen", "volumen_total_mb", to_mb(volume)),
        ("volumen", "paquetes_totales", packets),
        ("volumen", "tamano_medio_paquete_bytes", ratio(volume, packets)),
        ("volumen", "tasa_media", mean("rate")),
        ("comportamiento", "media_syn_flag", syn),
        ("comportamiento", "media_ack_flag", ack),
        ("comportamiento", "media_rst_flag", rst),
        ("comportamiento", "media_fin_flag", fin),
        ("comportamiento", "ratio_syn_ack", ratio(syn, ack)),
        ("comportamiento", "iat_medio", mean("iat")),
        ("concentracion", "clase_principal", None),
        ("concentracion", "pct_registros_clase_principal", pct(F.col("h.n"), total)),
        ("concentracion", "pct_registros_top5", pct(F.col("h.rows"), total)),
        ("concentracion", "pct_volumen_top5", pct(F.col("h.volume"), volume)),
        ("calidad", "filas_duplicadas", repeated),
        ("calidad", "pct_filas_duplicadas", pct(repeated, total)),
        ("calidad", "pct_filas_unicas", pct(F.col("distintas"), total)),
    ]
    rows_out = [
        F.struct(
            F.lit(category).alias("categoria"),
            F.lit(name).alias("metrica"),
            (F.lit(None) if value is None else F.round(value.cast("double"), spec.decimals))
            .cast("double").alias("valor_num"),
            (F.col("h.label") if value is None else F.lit(None)).cast("string").alias("valor_txt"),
        )
        for category, name, value in numbers
    ]
    return t.where(total > 0).select(F.inline(F.array(*rows_out)))
