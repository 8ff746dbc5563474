"""Column roles of a labelled record table.

Operators never name columns themselves: they ask a ``Spec`` which column is the label, which are
the measures and so on, so one operator serves any table that has those roles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

# --- Fixed values: the flow table contract ------------------------------------------------------

FLAG_COLUMNS = (
    "fin_flag_number", "syn_flag_number", "rst_flag_number", "psh_flag_number",
    "ack_flag_number", "ece_flag_number", "cwr_flag_number",
)
COUNTER_COLUMNS = ("ack_count", "syn_count", "fin_count", "rst_count")
APPLICATION_COLUMNS = (
    "HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC", "TCP", "UDP", "DHCP",
    "ARP", "ICMP", "IGMP", "IPv", "LLC",
)
INDICATOR_COLUMNS = (
    "Rate", "Tot size", "Tot sum", "IAT", "Number", "Variance", "AVG", "Std", "Min", "Max",
)
FLOW_COLUMNS = (
    "Header_Length", "Protocol Type", "Time_To_Live", "Rate",
    *FLAG_COLUMNS, *COUNTER_COLUMNS, *APPLICATION_COLUMNS,
    "Tot sum", "Min", "Max", "AVG", "Std", "Tot size", "IAT", "Number", "Variance", "Label",
)
FLOW_INTEGERS = ("Protocol Type", *COUNTER_COLUMNS, "Tot sum", "Min", "Max", "Number")

FAMILY_LABELS = {
    "Benign": ("Benign",),
    "BruteForce": ("DictionaryBruteForce",),
    "DDoS": (
        "DDoS-ACK_Fragmentation", "DDoS-HTTP_Flood", "DDoS-ICMP_Flood", "DDoS-ICMP_Fragmentation",
        "DDoS-PSHACK_FLOOD", "DDoS-RSTFINFLOOD", "DDoS-SYN_Flood", "DDoS-SlowLoris",
        "DDoS-SynonymousIP_Flood", "DDoS-TCP_Flood", "DDoS-UDP_Flood", "DDoS-UDP_Fragmentation",
    ),
    "DoS": ("DoS-HTTP_Flood", "DoS-SYN_Flood", "DoS-TCP_Flood", "DoS-UDP_Flood"),
    "Mirai": ("Mirai-greeth_flood", "Mirai-greip_flood", "Mirai-udpplain"),
    "Recon": (
        "Recon-HostDiscovery", "Recon-OSScan", "Recon-PingSweep", "Recon-PortScan",
        "VulnerabilityScan",
    ),
    "Spoofing": ("DNS_Spoofing", "MITM-ArpSpoofing"),
    "Web-based": (
        "Backdoor_Malware", "BrowserHijacking", "CommandInjection", "SqlInjection",
        "Uploading_Attack", "XSS",
    ),
}
LABEL_FAMILY = {label: family for family, labels in FAMILY_LABELS.items() for label in labels}
PROTOCOL_NAMES = {0: "HOPOPT", 1: "ICMP", 6: "TCP", 17: "UDP", 47: "GRE"}

# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    """Which column plays which role. A table needs only the roles its reports use."""

    columns: tuple[str, ...]
    integers: tuple[str, ...]
    texts: tuple[str, ...]
    label: str
    distinct: tuple[str, ...] = ()
    dedup_key: tuple[str, ...] = ()
    protocol: str = ""
    rate: str = ""
    size: str = ""
    iat: str = ""
    packets: str = ""
    syn: str = ""
    ack: str = ""
    rst: str = ""
    fin: str = ""
    mean: str = ""
    deviation: str = ""
    total: str = ""
    flags: tuple[str, ...] = ()
    onehot: tuple[str, ...] = ()
    indicators: tuple[str, ...] = ()
    benign: str = "Benign"
    decimals: int = 6

    @property
    def floats(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.integers and c not in self.texts)

    @property
    def schema(self) -> T.StructType:
        def dtype(name: str) -> T.DataType:
            if name in self.texts:
                return T.StringType()
            return T.LongType() if name in self.integers else T.DoubleType()

        return T.StructType([T.StructField(c, dtype(c), True) for c in self.columns])

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


FLOW = Spec(
    columns=FLOW_COLUMNS,
    integers=FLOW_INTEGERS,
    texts=("Label",),
    label="Label",
    protocol="Protocol Type",
    rate="Rate",
    size="Tot size",
    iat="IAT",
    packets="Number",
    syn="syn_flag_number",
    ack="ack_flag_number",
    rst="rst_flag_number",
    fin="fin_flag_number",
    mean="AVG",
    deviation="Std",
    total="Tot sum",
    flags=FLAG_COLUMNS,
    onehot=APPLICATION_COLUMNS,
    indicators=INDICATOR_COLUMNS,
    dedup_key=("Label", "Protocol Type", "Tot size", "IAT", "Rate", "Number"),
    distinct=(
        "Label", "Protocol Type", *APPLICATION_COLUMNS, *FLAG_COLUMNS,
        "Rate", "Tot size", "Number", "Variance",
    ),
)


def _values(spark: SparkSession, rows: dict, key: str, value: str) -> DataFrame:
    # A VALUES list has exact statistics, so Catalyst itself decides to broadcast it.
    def literal(v: object) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "\\'") + "'"

    tuples = ", ".join(f"({literal(k)}, {literal(v)})" for k, v in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {tuples} AS d(`{key}`, `{value}`)")


def family_dimension(spark: SparkSession, key: str = "Label", value: str = "Attack_Family") -> DataFrame:
    return _values(spark, LABEL_FAMILY, key, value)


def protocol_dimension(spark: SparkSession, key: str = "Protocol Type", value: str = "protocolo") -> DataFrame:
    return _values(spark, PROTOCOL_NAMES, key, value)
