"""Every report by name: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowops.functions.columns import qcol
from flowops.operators import (
    cleaning, deriving, duplicates, groups, ordering, percentiles, profiling, reconcile, sampling,
)
from flowops.plans.flow_view import THRESHOLD_COLUMNS, kept, read_clean, read_clean_counts, read_flows, read_limits
from flowops.session import scratch_path, tune
from flowops.sources import checked, files, records, sinks
from flowops.spec import FLOW, LABEL_FAMILY, Spec, family_dimension, protocol_dimension

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
EVENTS = Spec(
    columns=("event_id", "ts", "user_id", "event_type", "value", "props"),
    integers=("event_id", "user_id"),
    texts=("ts", "event_type", "props"),
    label="event_type",
    distinct=("user_id", "event_type", "value", "props"),
)
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = read_limits(spark, sf_dir)
    return deriving.with_derived(
        read_clean(spark, sf_dir), FLOW, limits.at(FLOW.iat, 50), limits.at(FLOW.iat, 95)
    )


def _on_flows(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(read_flows(spark, sf_dir), FLOW)


def _on_clean(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(read_clean(spark, sf_dir), FLOW)


def _with_families(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(read_flows(spark, sf_dir), FLOW, family_dimension(spark))


# --- rows that reports are made of --------------------------------------------------------------


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup_report(read_flows(spark, sf_dir))


def protocol_within_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.protocol_within_family(
        read_flows(spark, sf_dir), FLOW, family_dimension(spark), protocol_dimension(spark)
    )


def dup_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup_criteria_report(read_clean(spark, sf_dir), FLOW.dedup_key)


def dup_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.most_repeated(read_clean(spark, sf_dir), FLOW.dedup_key)


def rate_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = cleaning.round_floats(read_flows(spark, sf_dir), FLOW)
    return percentiles.Limits.of(rounded, THRESHOLD_COLUMNS).table()


def derived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [FLOW.label, FLOW.protocol, FLOW.rate, FLOW.size, FLOW.iat, *deriving.DEFINITIONS]
    return _derived(spark, sf_dir).select(*map(qcol, names))


def derived_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deriving.derived_profile(_derived(spark, sf_dir), FLOW)


def derived_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deriving.derived_preview(_derived(spark, sf_dir), FLOW)


def event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column profile of a whole table with other roles."""
    return profiling.column_profile(_table(spark, sf_dir, "events"), EVENTS)


def event_type_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts with shares on another table."""
    events = _table(spark, sf_dir, "events")
    return groups.with_share(groups.class_counts(events, EVENTS))


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaning found."""
    return cleaning.clean_summary(read_clean_counts(spark, sf_dir), FLOW)


def finite_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.finite_summary(read_clean_counts(spark, sf_dir))


def null_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-finite cells become NULL in every float column; all rows stay."""
    nullified = cleaning.nullify(read_flows(spark, sf_dir), FLOW.floats)
    return nullified.select(qcol(FLOW.label), *[qcol(c) for c in FLOW.floats])


def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.filter_counts(read_clean(spark, sf_dir), FLOW, read_limits(spark, sf_dir))


def intense_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.intense_by_label(read_clean(spark, sf_dir), FLOW, read_limits(spark, sf_dir))


def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.global_metrics(read_clean(spark, sf_dir), FLOW.indicators)


def consolidated_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.consolidated(_derived(spark, sf_dir), FLOW)


def _price_percentiles(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    prices = _table(spark, sf_dir, "lineitem").select(by, "l_extendedprice")
    wanted = {"mediana": percentiles.median("l_extendedprice")}
    wanted |= {
        f"p{p}": percentiles.nearest_rank("l_extendedprice", p / 100.0)
        for p in percentiles.THRESHOLD_PERCENTS
    }
    return percentiles.select_percentiles(prices, [by], wanted)


def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of a high-cardinality measure by the selection meant for large inputs."""
    return _price_percentiles(spark, sf_dir, "l_returnflag")


def part_price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same percentiles for groups that grow with the table."""
    return _price_percentiles(spark, sf_dir, "l_partkey")


# --- sampling ------------------------------------------------------------------------------------


def _tenth(df: DataFrame, divisor: int = 10) -> Column:
    return df.agg(F.expr(f"count(*) div {divisor}").alias("n")).scalar()


def flow_class_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = read_flows(spark, sf_dir)
    counts = sampling.strata_counts(flows, [FLOW.label])
    return sampling.class_quotas(counts, _tenth(flows, 78), FLOW.label)


def document_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return sampling.two_level_quotas(documents, _tenth(documents), "lang", "source")


def capped_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter and two thirds of the events, shared by users in proportion to their purchases beyond fourteen.

    No user gives more events than there are; users without such purchases give theirs last.
    """
    events = _table(spark, sf_dir, "events")
    users = events.groupBy("user_id").agg(
        F.greatest(F.count_if(F.col("event_type") == "purchase") - 14, F.lit(0)).alias("peso"), F.count(F.lit(1)).alias("eventos")
    )
    targets = {"cuarto": _tenth(events, 4), "dos_tercios": F.lit(2) * _tenth(events, 3)}
    found = [
        sampling.capped_quotas(users, target, "peso", "eventos", ["user_id"]).withColumn("muestra", F.lit(name))
        for name, target in targets.items()
    ]
    return found[0].unionByName(found[1])


def _document_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return sampling.stratified_sample(
        documents, ["lang", "source"], document_quotas(spark, sf_dir), ["doc_id"], SEED
    )


def document_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_sample(spark, sf_dir)


def sample_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return sampling.sample_checks(
        _document_sample(spark, sf_dir),
        document_quotas(spark, sf_dir),
        "lang",
        _tenth(documents),
        len(documents.columns),
        "source",
    )


def sample_vs_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_distribution(
        _table(spark, sf_dir, "documents"), _document_sample(spark, sf_dir), "lang"
    )


def sample_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality record of a whole table whose rows repeat and whose cells go missing."""
    return sampling.sample_quality(read_flows(spark, sf_dir))


def document_sample_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality record of the sample itself."""
    return sampling.sample_quality(_document_sample(spark, sf_dir))


def sample_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells per column of the sample."""
    return sampling.missing_cells(_document_sample(spark, sf_dir))


def quota_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether samples of a tenth, of twice the table and of two rows can be drawn."""
    documents = _table(spark, sf_dir, "documents")
    counts = sampling.strata_counts(documents, ["lang"])
    targets = {"decima": _tenth(documents), "doble": F.lit(2) * _tenth(documents, 1), "dos": F.lit(2)}
    found = [
        sampling.quota_guards(counts, target, "lang").withColumn("muestra", F.lit(name)) for name, target in targets.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _stored_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample written once: checks, report and publication then read a tenth of the table."""
    path = scratch_path(spark, "sample")
    _document_sample(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution, validation and method of the sample, written once as JSON and read back."""
    documents, sample = _table(spark, sf_dir, "documents"), _stored_sample(spark, sf_dir)
    quotas = document_quotas(spark, sf_dir)
    checks = sampling.sample_checks(sample, quotas, "lang", _tenth(documents), len(documents.columns), "source")
    report = sampling.quality_report(
        sampling.sample_distribution(documents, sample, "lang"),
        sampling.sample_quality(sample),
        sampling.missing_cells(sample),
        checks,
        "lang",
        "estratificado por lang y source, restos mayores",
    )
    path = scratch_path(spark, "report")
    sinks.write_json(report.coalesce(1), path)
    read = spark.read.schema(report.schema).json(path)
    return read.select(
        "metodo",
        "filas",
        "columnas",
        "filas_duplicadas",
        "celdas_nulas",
        F.size("distribucion").cast("bigint").alias("clases"),
        F.aggregate("distribucion", F.lit(0).cast("bigint"), lambda n, d: n + d["sample_count"]).alias("muestra"),
        F.aggregate("nulos", F.lit(0).cast("bigint"), lambda n, d: n + d["celdas_nulas"]).alias("nulos"),
        F.forall("comprobaciones", lambda c: c["ok"]).alias("valida"),
    )


def published_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample published after its checks hold, and read back."""
    documents, sample = _table(spark, sf_dir, "documents"), _stored_sample(spark, sf_dir)
    checks = sampling.sample_checks(
        sample, document_quotas(spark, sf_dir), "lang", _tenth(documents), len(documents.columns), "source"
    )
    path = scratch_path(spark, "published")
    sinks.publish(sample, checks, path)
    return sinks.read_published(spark, path)


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, size and SHA-256 of stored contents."""
    return files.content_manifest(_table(spark, sf_dir, "pages"), "url", "html")


def sample_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files in a seeded order."""
    sources = _table(spark, sf_dir, "documents").select("source").distinct()
    return sampling.seeded_order(sources, "source", SEED)


# --- sorts ---------------------------------------------------------------------------------------


def secondary_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.secondary_sort(ordering.sort_pairs(read_flows(spark, sf_dir), FLOW))


def total_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.total_sort(ordering.fixed_width_records(read_flows(spark, sf_dir), FLOW))


def _contiguous(spark: SparkSession, sf_dir: str) -> str:
    return kept(spark, sf_dir, "contiguous", lambda path: records.write_contiguous(total_sort(spark, sf_dir), path))


def sort_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorts written as lines and as contiguous records, read back and checked file by file."""
    pair_path, record_path = scratch_path(spark, "sorted"), scratch_path(spark, "records")
    sinks.write_lines(secondary_sort(spark, sf_dir), pair_path)
    sinks.write_records(total_sort(spark, sf_dir), record_path)
    outputs = {
        "secondarysort": (files.read_sorted_pairs(spark, pair_path, True), ["protocol", "rate"]),
        "terasort": (files.read_record_lines(spark, record_path, True), ["key"]),
        "terasort_contiguo": (records.read_contiguous(spark, _contiguous(spark, sf_dir)), ["key"]),
    }
    found = [
        ordering.order_check(df, by, files.PLACE).withColumn("trabajo", F.lit(name)) for name, (df, by) in outputs.items()
    ]
    return reduce(DataFrame.unionByName, found)


def sort_partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of the contiguous sort against the cut points stored beside it."""
    path = _contiguous(spark, sf_dir)
    return records.partition_check(records.read_contiguous(spark, path), path)


# --- comparing results ---------------------------------------------------------------------------


def reconcile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grouped result against a copy with small, large, non-finite and row-level differences."""
    flows = read_flows(spark, sf_dir)
    base = flows.groupBy(FLOW.label, qcol(FLOW.protocol)).agg(
        F.count(F.lit(1)).alias("registros"),
        F.avg(qcol(FLOW.size)).alias("media_tot_size"),
        F.max(qcol(FLOW.rate)).alias("pico"),
    )
    label, protocol = qcol(FLOW.label), qcol(FLOW.protocol)
    changed = base.where(~((label == "Benign") & (protocol == 17))).withColumns(
        {
            "registros": F.col("registros") + F.when((label == "XSS") & (protocol == 6), 1).otherwise(0),
            "media_tot_size": F.col("media_tot_size") + F.when(protocol == 1, 1e-7).otherwise(0.0),
            "pico": F.when(F.col("pico") < float("inf"), F.col("pico"))
            .when(protocol == 6, 5.0)
            .when(protocol == 17, float("-inf"))
            .when(protocol == 1, float("nan"))
            .otherwise(F.col("pico")),
            FLOW.label: F.when((label == "XSS") & (protocol == 47), F.lit("Nuevo")).otherwise(label),
        }
    )
    return reconcile.reconcile(base, changed, [FLOW.label, FLOW.protocol])


def reconcile_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without their number, so keys and whole rows repeat, against a copy that lacks and changes some."""
    lines = _table(spark, sf_dir, "lineitem")
    order, amount = F.col("l_orderkey"), F.col("l_quantity").cast("bigint")
    base = lines.select("l_orderkey", amount.alias("cantidad"), "l_returnflag")
    changed = lines.where(~((order % 97 == 3) & (F.col("l_linenumber") == 1))).select(
        "l_orderkey", (amount + F.when(order % 89 == 5, 1).otherwise(0)).alias("cantidad"), "l_returnflag"
    )
    return reconcile.reconcile(base, changed, ["l_orderkey"])


def label_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the dimension against the labels found, one of each renamed."""
    found = read_flows(spark, sf_dir).select(FLOW.label).distinct()
    renamed = found.select(
        F.when(F.col(FLOW.label) == "XSS", F.lit("Nuevo")).otherwise(F.col(FLOW.label)).alias(FLOW.label)
    )
    return reconcile.set_difference(family_dimension(spark).select(FLOW.label), renamed, FLOW.label)


def summary_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key/value summaries of which three values differ: one truly, one within tolerance, one ignored."""
    numbers = groups.indicators(read_clean(spark, sf_dir), FLOW).where(F.col("valor_num").isNotNull())
    base = numbers.select(F.col("metrica").alias("clave"), F.col("valor_num").alias("valor"))
    shift = (
        F.when(F.col("clave") == "total_clases", 1.0)
        .when(F.col("clave") == "tasa_media", 1e-8)
        .when(F.col("clave") == "total_registros", 5.0)
        .otherwise(0.0)
    )
    other = base.withColumn("valor", F.col("valor") + shift)
    return reconcile.reconcile_summaries(base, other, ignore=["total_registros"])


def flow_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of labels, conservation of counts and unmapped labels."""
    flows = read_flows(spark, sf_dir)
    families = groups.family_classes(flows, FLOW, family_dimension(spark))
    rows = flows.agg(F.count(F.lit(1))).scalar()
    wide = families.agg(
        F.sum("clases").alias("etiquetas"),
        F.sum("cantidad").alias("registros"),
        F.count(groups.FAMILY).alias("familias"),
        F.coalesce(F.sum(F.when(F.col(groups.FAMILY).isNull(), F.col("cantidad"))), F.lit(0)).alias("sin_familia"),
    ).withColumn("columnas", F.lit(len(flows.columns)))
    return reconcile.expectations(
        wide,
        {
            "etiquetas": len(LABEL_FAMILY),
            "registros": rows,
            "familias": len(set(LABEL_FAMILY.values())),
            "sin_familia": 0,
            "columnas": len(FLOW.columns),
        },
    )


def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records pivoted to one column per weekday, with a total row."""
    events = _table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "E").alias("dia"))
    return reconcile.pivot_with_total(
        events, "event_type", "dia", WEEKDAYS, F.count(F.lit(1)), "TOTAL"
    )


# --- text ----------------------------------------------------------------------------------------


def text_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.text_dedup_report(_table(spark, sf_dir, "documents"), ["text"])


def number_text_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers written in two ways are different texts."""
    written = _table(spark, sf_dir, "lineitem").select(
        F.format_string("%.2f", "l_discount").alias("plain"),
        F.when(F.col("l_orderkey") % 2 == 0, F.format_string("%.2f", "l_tax"))
        .otherwise(F.format_string("%.3f", "l_tax")).alias("mixed"),
    )
    return duplicates.text_dedup_report(written, ["plain", "mixed"])


def null_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-value spellings in text columns."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    texts = _table(spark, sf_dir, "lineitem").select(
        F.when(order % 97 == 5, " NA ").when(order % 97 == 6, "nan").otherwise(part.cast("string")).alias("part"),
        F.when(order % 89 == 7, "").when(order % 89 == 8, "N/A").when(order % 89 == 9, "None")
        .otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(part % 53 == 1, F.lit(None)).otherwise(F.col("l_linestatus")).alias("status"),
    )
    return cleaning.null_marker_report(texts, texts.columns)


# --- files ---------------------------------------------------------------------------------------


def _summary(df: DataFrame, texts: bool = False) -> DataFrame:
    """Per label: rows, and of every other column its missing cells, infinities and rounded sum."""
    numbers = [c for c in FLOW.columns if c != FLOW.label]
    # Numbers first: each text is read once, however often its number is used below.
    typed = df.select(
        qcol(FLOW.label), *[(qcol(c).try_cast("double") if texts else qcol(c).cast("double")).alias(c) for c in numbers]
    )
    missing = reduce(lambda a, b: a + b, [F.when(qcol(c).isNull(), 1).otherwise(0) for c in numbers])
    return typed.groupBy(qcol(FLOW.label)).agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum(F.lit(0).cast("bigint") + missing).alias("nulos"),
        F.count_if(F.abs(qcol(FLOW.rate)) == float("inf")).alias("infinitos"),
        *[
            F.round(F.sum(F.when(F.abs(qcol(c)) < float("inf"), qcol(c))), 2).alias(f"suma_{i}")
            for i, c in enumerate(numbers)
        ],
    )


def _written_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv")
    sinks.write_raw_csv(read_flows(spark, sf_dir), path, compression=sinks.CSV_CODEC)
    return path


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table written as CSV and read back with its declared schema."""
    return _summary(files.read_csv(spark, _written_csv(spark, sf_dir), FLOW))


def csv_text_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates of the raw CSV fields."""
    rows = files.read_text_csv(spark, _written_csv(spark, sf_dir), FLOW)
    return duplicates.text_dedup_report(rows, FLOW.columns)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as compressed JSON, where infinities become null, and read back."""
    path = scratch_path(spark, "json")
    flows = read_flows(spark, sf_dir)
    sinks.write_json(flows, path, compression=sinks.JSON_CODEC)
    return _summary(spark.read.schema(flows.schema).json(path))


def result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table in its normalised CSV text, read back as text."""
    path = scratch_path(spark, "result")
    report = groups.family_statistics(read_flows(spark, sf_dir), FLOW, family_dimension(spark))
    sinks.write_csv(report, path, single_file=True)
    return spark.read.options(header=True).csv(path)


def _class_directories(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        flows = read_flows(spark, sf_dir)
        folder = F.when(qcol(FLOW.label) == FLOW.benign, files.BENIGN_DIRECTORY).otherwise(qcol(FLOW.label))
        sinks.write_raw_csv(flows.withColumn("clase", folder).drop(FLOW.label), path, "clase")

    return kept(spark, sf_dir, "classes", write)


def class_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in one directory per class, labelled by their directory, all columns compared."""
    path = _class_directories(spark, sf_dir)
    files.source_header(spark, path, FLOW.label)
    return _summary(files.read_class_directories(spark, path, FLOW), texts=True)


SOURCE_COLUMNS = [c for c in FLOW.columns if c != FLOW.label]
EMPTY_CLASS = "Sin_Filas"


def _odd_directories(spark: SparkSession, sf_dir: str) -> str:
    """Class directories of the flows, with what real sources hold besides rows.

    Every flow of infinite rate leaves a line that is no row, blank where the deviation is missing and short
    elsewhere, in a file of its class; the benign class and a class of its own get a file of a header alone.
    """
    def write(path: str) -> None:
        flows = read_flows(spark, sf_dir)
        folder = F.when(qcol(FLOW.label) == FLOW.benign, files.BENIGN_DIRECTORY).otherwise(qcol(FLOW.label))
        sinks.write_raw_csv(flows.withColumn("clase", folder).drop(FLOW.label), path, "clase")
        short = F.concat_ws(",", *[qcol(c).cast("string") for c in (FLOW.protocol, "Min", "Max", FLOW.packets)])
        lines = flows.where(qcol(FLOW.rate) == float("inf")).select(
            folder.alias("clase"), F.lit(1).alias("orden"), F.when(qcol(FLOW.deviation).isNotNull(), short).otherwise("").alias("value")
        )
        headers = lines.select("clase").distinct().select("clase", F.lit(0), F.lit(",".join(SOURCE_COLUMNS)))
        placed = lines.union(headers).repartition("clase").sortWithinPartitions("clase", "orden", "value")
        placed.drop("orden").write.mode("append").partitionBy("clase").text(path)
        header = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS)).coalesce(1)
        for name in (files.BENIGN_DIRECTORY, EMPTY_CLASS):
            header.write.mode("append").option("header", True).csv(f"{path}/clase={name}")

    return kept(spark, sf_dir, "odd-classes", write)


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked.scan(spark, _odd_directories(spark, sf_dir), SOURCE_COLUMNS, FLOW.label, suffix="")


def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rejected lines, files without rows and files with another header, of every class that has a file."""
    per_file = checked.file_inventory(_scanned(spark, sf_dir))
    named = files.with_class(per_file, FLOW.label)
    return named.groupBy(qcol(FLOW.label)).agg(
        F.sum("filas").alias("filas"),
        F.sum("rechazadas").alias("rechazadas"),
        F.count_if(F.col("lineas") == 0).alias("archivos_vacios"),
        F.count_if(F.col("estado") != checked.OK).alias("archivos_malos"),
    )


def source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the class directories can be sampled: headers agree, every class has rows, no line is rejected."""
    return checked.source_checks(source_inventory(spark, sf_dir))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no rows, with their place in the file and the reason."""
    found = files.with_class(checked.rejected(_scanned(spark, sf_dir)), FLOW.label)
    return found.select(qcol(FLOW.label), "linea", "motivo", "campos", "texto")


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows between the rejected lines, labelled by their directory, all columns compared."""
    rows = checked.read_rows(spark, _odd_directories(spark, sf_dir), SOURCE_COLUMNS, FLOW.label, suffix="", mode="drop")
    return _summary(files.with_class(rows, FLOW.label), texts=True)


def sorted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secondary sort written as lines and read back."""
    path = scratch_path(spark, "sorted")
    sinks.write_lines(secondary_sort(spark, sf_dir), path)
    pairs = files.read_sorted_pairs(spark, path)
    return pairs.groupBy("protocol").agg(
        F.count(F.lit(1)).alias("pares"), F.min("rate").alias("rate_min"), F.max("rate").alias("rate_max"),
        F.sum(F.col("rate").cast("bigint")).alias("rate_suma"),
    )


def threshold_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds written as one JSON object and read back."""
    path = scratch_path(spark, "thresholds")
    sinks.write_thresholds(read_limits(spark, sf_dir).table(), path)
    return files.read_thresholds(spark, path, THRESHOLD_COLUMNS)


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, size and SHA-256 of the source files."""
    return files.manifest(spark, sf_dir, "*.parquet")


QUERIES: dict[str, Query] = {
    "dataset_validation": partial(_on_flows, profiling.validation),
    "dedup_report": dedup_report,
    "family_classes": partial(_with_families, groups.family_classes),
    "malicious_share": partial(_on_flows, groups.malicious_share),
    "traffic_split": partial(_on_flows, groups.traffic_split),
    "family_distribution": partial(_with_families, groups.family_distribution),
    "top_attacks": partial(_on_flows, groups.top_attacks),
    "family_statistics": partial(_with_families, groups.family_statistics),
    "protocol_within_family": protocol_within_family,
    "traffic_profile": partial(_on_flows, groups.traffic_profile),
    "column_profile": lambda spark, sf_dir: profiling.column_profile(
        cleaning.round_floats(read_flows(spark, sf_dir), FLOW), FLOW
    ),
    "event_profile": event_profile,
    "event_type_shares": event_type_shares,
    "clean_report": clean_report,
    "clean_rows": partial(_on_flows, cleaning.clean_and_round),
    "null_cells": null_cells,
    "finite_rates": finite_rates,
    "dup_criteria": dup_criteria,
    "dup_examples": dup_examples,
    "derived_rows": derived_rows,
    "derived_profile": derived_profile,
    "derived_preview": derived_preview,
    "rate_thresholds": rate_thresholds,
    "filter_counts": filter_counts,
    "intense_by_label": intense_by_label,
    "global_metrics": global_metrics,
    "label_protocol": partial(_on_clean, groups.label_protocol),
    "top_volumes": partial(_on_clean, groups.top_volumes),
    "class_indicators": partial(_on_clean, groups.indicators),
    "consolidated_classes": consolidated_classes,
    "price_percentiles": price_percentiles,
    "part_price_percentiles": part_price_percentiles,
    "flow_class_quotas": flow_class_quotas,
    "document_quotas": document_quotas,
    "capped_quotas": capped_quotas,
    "document_sample": document_sample,
    "sample_checks": sample_checks,
    "sample_vs_population": sample_vs_population,
    "sample_quality": sample_quality,
    "document_sample_quality": document_sample_quality,
    "sample_missing": sample_missing,
    "quota_guards": quota_guards,
    "sample_report": sample_report,
    "published_sample": published_sample,
    "sample_file_order": sample_file_order,
    "secondary_sort": secondary_sort,
    "total_sort": total_sort,
    "sort_order_check": sort_order_check,
    "sort_partition_check": sort_partition_check,
    "reconcile_cells": reconcile_cells,
    "reconcile_repeated": reconcile_repeated,
    "label_difference": label_difference,
    "summary_difference": summary_difference,
    "flow_expectations": flow_expectations,
    "event_pivot": event_pivot,
    "text_exact_dedup": text_exact_dedup,
    "number_text_dedup": number_text_dedup,
    "null_markers": null_markers,
    "csv_roundtrip": csv_roundtrip,
    "csv_text_dedup": csv_text_dedup,
    "json_roundtrip": json_roundtrip,
    "result_csv": result_csv,
    "class_directories": class_directories,
    "source_inventory": source_inventory,
    "source_checks": source_checks,
    "rejected_lines": rejected_lines,
    "accepted_rows": accepted_rows,
    "sorted_output": sorted_output,
    "threshold_file": threshold_file,
    "file_manifest": file_manifest,
    "page_manifest": page_manifest,
}


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _tuned(query) for name, query in QUERIES.items()}
