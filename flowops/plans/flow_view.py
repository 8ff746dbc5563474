"""A flow-shaped table derived row by row from ``lineitem``.

The 40 columns carry the names and types of the flow contract. Measures are multiples of 1/64, so
sums are exact in any order of addition; only ``Time_To_Live`` has a non-terminating fraction, to
exercise rounding. A third of the rows share one label. Non-finite and missing cells are placed by
arithmetic on the keys. The expressions are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from flowops.operators.cleaning import clean_and_round, clean_counts, round_floats, with_kept
from flowops.operators.percentiles import Limits
from flowops.session import scratch_path
from flowops.spec import FLOW, FLOW_COLUMNS, LABEL_FAMILY

THRESHOLD_COLUMNS = (FLOW.rate, FLOW.size, FLOW.iat)

HOT_LABEL = "DDoS-ICMP_Flood"
OTHER_LABELS = sorted(label for label in LABEL_FAMILY if label != HOT_LABEL)

# One integer ingredient per source attribute.
INGREDIENTS = {
    "q": "CAST(l_quantity AS INT)",
    "d": "CAST(floor(l_discount * 100 + 0.5) AS INT)",
    "t": "CAST(floor(l_tax * 100 + 0.5) AS INT)",
    "n": "CAST(l_linenumber AS INT)",
    "s": "CAST(l_suppkey % 5 AS INT)",
    "c": "CAST((l_orderkey * 7 + l_linenumber * 13) % 100 AS INT)",
    "i": "l_orderkey * 7 + l_linenumber",
}

_ONE = {
    "HTTP": "s = 2 AND d = 1",
    "HTTPS": "s = 2 AND d IN (2, 3)",
    "DNS": "s = 3 AND d = 4",
    "Telnet": "s = 2 AND d = 5 AND t = 0",
    "SMTP": "s = 2 AND d = 6 AND t = 1",
    "SSH": "s = 2 AND d = 7",
    "IRC": "s = 2 AND d = 8 AND t = 2",
    "TCP": "s = 2",
    "UDP": "s = 3",
    "DHCP": "s = 3 AND d = 9 AND t = 3",
    "ARP": "s = 0 AND d = 0",
    "ICMP": "s = 1",
    "IGMP": "s = 1 AND d = 10",
    "IPv": "NOT (s IN (0, 4) AND d = 5)",
    "LLC": "NOT (s IN (0, 4) AND d = 5)",
}

FLOW_EXPRESSIONS = {
    "Header_Length": "CAST(20 + t * 5 AS DOUBLE)",
    "Protocol Type": "CAST(CASE s WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 6 WHEN 3 THEN 17 ELSE 47 END AS BIGINT)",
    "Time_To_Live": "CAST(64 AS DOUBLE) + CAST(q AS DOUBLE) / 7",
    "Rate": (
        "CASE WHEN i % 997 = 0 THEN CAST('Infinity' AS DOUBLE)"
        " ELSE CAST(q * q * 97 + t * 1031 + d * 17 AS DOUBLE) / 64 END"
    ),
    "fin_flag_number": "CAST(q % 4 AS DOUBLE) / 4",
    "syn_flag_number": "CASE WHEN d >= 5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "rst_flag_number": "CAST(t % 3 AS DOUBLE) / 2",
    "psh_flag_number": "CAST(q % 2 AS DOUBLE)",
    "ack_flag_number": "CASE WHEN t >= 4 THEN CAST(1 AS DOUBLE) ELSE CAST(t AS DOUBLE) / 8 END",
    "ece_flag_number": "CASE WHEN n = 7 THEN CAST(1 AS DOUBLE) / 2 ELSE CAST(0 AS DOUBLE) END",
    "cwr_flag_number": "CASE WHEN n = 6 THEN CAST(1 AS DOUBLE) / 4 ELSE CAST(0 AS DOUBLE) END",
    "ack_count": "CAST(t * 10 AS BIGINT)",
    "syn_count": "CAST(d * 10 AS BIGINT)",
    "fin_count": "CAST(q % 4 * 25 AS BIGINT)",
    "rst_count": "CAST(t % 3 * 50 AS BIGINT)",
    **{
        name: f"CASE WHEN {test} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        for name, test in _ONE.items()
    },
    "Tot sum": "CAST(60 + q * 211 + d * 5 AS BIGINT)",
    "Min": "CAST(42 + n % 2 AS BIGINT)",
    "Max": "CAST(46 + q * 20 AS BIGINT)",
    "AVG": "CASE WHEN q = 1 AND d = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(46 + q * 11 AS DOUBLE) + CAST(d AS DOUBLE) / 4 END",
    "Std": "CASE WHEN i % 1994 = 0 THEN NULL ELSE CAST(t * q AS DOUBLE) / 8 END",
    "Tot size": "CAST(46 + q * 11 AS DOUBLE) + CAST(d AS DOUBLE) / 4",
    "IAT": "CAST((d * 9 + t) * (d * 9 + t) AS DOUBLE) / 64",
    "Number": "CAST(CASE WHEN q * 3 > 100 THEN 100 ELSE q * 3 END AS BIGINT)",
    "Variance": "CASE WHEN i % 1994 = 0 THEN NULL ELSE CAST(t * q AS DOUBLE) * CAST(t * q AS DOUBLE) / 64 END",
}


def _label(lookup: str, opening: str, closing: str) -> str:
    listed = ", ".join(f"'{label}'" for label in OTHER_LABELS)
    other = f"{lookup}({opening}{listed}{closing}, (c - 34) % {len(OTHER_LABELS)} + 1)"
    return f"CASE WHEN c < 34 THEN '{HOT_LABEL}' ELSE {other} END"


def flows_from(lineitem: DataFrame) -> DataFrame:
    expressions = {**FLOW_EXPRESSIONS, "Label": _label("element_at", "array(", ")")}
    return (
        lineitem.selectExpr(*[f"{e} AS {name}" for name, e in INGREDIENTS.items()])
        .selectExpr(*[f"{expressions[name]} AS `{name}`" for name in FLOW_COLUMNS])
    )


# Session settings. A source of fewer row groups than cores is spread over so many partitions when it is
# read; flows are kept as a stage of their own, a copy of the table, where many small reports share them.
# Unset, the file splits decide and flows are derived anew by every report, from the columns it needs.
SOURCE_PARTITIONS = "flowops.sourcePartitions"
STAGED_FLOWS = "flowops.stagedFlows"

_stored: dict[tuple, tuple[str, T.StructType | None]] = {}
_counted: dict[tuple, dict[str, int]] = {}


def _identity(spark: SparkSession, path: str) -> tuple:
    """Files, bytes and time of the last change of a source, from its listing alone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)


def _source_key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    source = f"{sf_dir}/lineitem.parquet"
    return (spark.sparkContext.applicationId, name, source, _identity(spark, source))


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage kept as columnar files in the shared folder, written once per session and source.

    Reports start from such a stage instead of repeating its work, read only the columns they need,
    and lose nothing with an executor. A source that has changed is read again.
    """
    key = _source_key(spark, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        stage = build()
        stage.write.parquet(path)
        _stored[key] = (path, stage.schema)
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def kept(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder below the shared one that ``write`` has filled, once per session and source."""
    key = _source_key(spark, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        write(path)
        _stored[key] = (path, None)
    return _stored[key][0]


def read_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow table, a projection of the source rows, or its stage where the session asks for one."""
    def build() -> DataFrame:
        source = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        parts = spark.conf.get(SOURCE_PARTITIONS, None)
        return flows_from(source.repartition(int(parts)) if parts else source)

    staged = spark.conf.get(STAGED_FLOWS, "false") == "true"
    return stored(spark, sf_dir, "flows", build) if staged else build()


def read_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, rounded rows: the check of all 40 columns is paid once, not by every later report."""
    return stored(spark, sf_dir, "clean", lambda: clean_and_round(read_flows(spark, sf_dir), FLOW))


def read_clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of ``clean_counts``, from one scan a session and source.

    Some 80 counts a row cost more than the clean rows themselves, so only the reports that show them pay for them.
    """
    key = _source_key(spark, sf_dir, "clean")
    if key not in _counted:
        _counted[key] = with_kept(read_flows(spark, sf_dir), FLOW).agg(*clean_counts(FLOW)).first().asDict()
    found = _counted[key]
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"`{n}` bigint" for n in found))


def read_limits(spark: SparkSession, sf_dir: str) -> Limits:
    """Thresholds of the raw rounded rows, infinities included; the stored table has one row."""
    def build() -> DataFrame:
        return Limits.of(round_floats(read_flows(spark, sf_dir), FLOW), THRESHOLD_COLUMNS).wide

    return Limits(stored(spark, sf_dir, "limits", build), THRESHOLD_COLUMNS)


def flows_sql() -> str:
    """The same table as a common table expression named ``flows``."""
    expressions = {**FLOW_EXPRESSIONS, "Label": _label("list_extract", "[", "]")}
    inner = ", ".join(f"{e} AS {name}" for name, e in INGREDIENTS.items())
    outer = ",\n    ".join(f'{expressions[name]} AS "{name}"' for name in FLOW_COLUMNS)
    return f"flows AS (SELECT\n    {outer}\n  FROM (SELECT {inner} FROM lineitem) AS ingredients)"
