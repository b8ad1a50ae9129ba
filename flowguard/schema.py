"""Column roles of a flow table and how they are found.

Role resolution only looks at ``df.columns`` (metadata), never at rows, so it costs nothing
at any scale.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import DataFrame

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference tool's lists for the same results.
# ---------------------------------------------------------------------------
# Label column candidates, in priority order.
LABEL_CANDIDATES = ("Label", "label", "Class", "class", "Attack", "attack", "target", "Target")
# Identity and time columns that are never features (dropped by exact name).
NON_FEATURE_COLUMNS = ("Flow ID", "Source IP", "Destination IP", "Src IP", "Dst IP", "Timestamp", "Time")
# Network role candidates, in priority order.
SOURCE_IP_COLUMNS = ("Source IP", "Src IP", "src_ip", "source_ip", "SourceIP")
DESTINATION_IP_COLUMNS = ("Destination IP", "Dst IP", "dst_ip", "destination_ip", "DestinationIP")
SOURCE_PORT_COLUMNS = ("Source Port", "Src Port", "src_port", "source_port", "SrcPort")
DESTINATION_PORT_COLUMNS = ("Destination Port", "Dst Port", "dst_port", "destination_port", "DstPort")
# Upper-cased trimmed label texts that mean "benign"; everything else is an attack.
BENIGN_VALUES = ("BENIGN", "NORMAL")
# Texts the CSV reader turns into a missing value (pandas' default NA list).
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Graph feature names, in output order.
GRAPH_FEATURES = (
    "graph_src_out_count",
    "graph_dst_in_count",
    "graph_edge_count",
    "graph_src_unique_dst",
    "graph_dst_unique_src",
    "graph_dst_port_count",
    "graph_src_dst_port_count",
    "graph_src_port_count",
)
# Text used for a missing network key.
UNKNOWN_KEY = "unknown"
# Name of the per-file tag column added by the multi-file loader.
SOURCE_FILE_COLUMN = "__source_csv"


def dedup_names(raw_names) -> list[str]:
    """Trim header names; later repeats of a name become ``name.1``, ``name.2``, ..."""
    seen: dict[str, int] = {}
    names = []
    for raw in raw_names:
        name = ("" if raw is None else str(raw)).strip()
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        names.append(name)
    return names


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip spaces around header names; later repeats of one name become ``name.1``, ..."""
    names = dedup_names(df.columns)
    return df.toDF(*names) if names != list(df.columns) else df


def first_existing(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """Of the candidates, in their order, the first that is a (trimmed) column name."""
    names = frozenset(str(c).strip() for c in columns)
    return next((c for c in candidates if c in names), None)


def detect_label_column(columns: Iterable[str]) -> str:
    """The label column, or an error naming the candidates."""
    found = first_existing(columns, LABEL_CANDIDATES)
    if found is None:
        raise ValueError(f"no label column found; candidates: {', '.join(LABEL_CANDIDATES)}")
    return found


@dataclass(frozen=True)
class FlowSchema:
    """Resolved roles of one flow table."""

    label: str
    src_ip: str | None
    dst_ip: str | None
    src_port: str | None
    dst_port: str | None

    @classmethod
    def resolve(cls, columns: Iterable[str]) -> "FlowSchema":
        cols = [str(c).strip() for c in columns]
        return cls(
            label=detect_label_column(cols),
            src_ip=first_existing(cols, SOURCE_IP_COLUMNS),
            dst_ip=first_existing(cols, DESTINATION_IP_COLUMNS),
            src_port=first_existing(cols, SOURCE_PORT_COLUMNS),
            dst_port=first_existing(cols, DESTINATION_PORT_COLUMNS),
        )

    @property
    def graph_feature_names(self) -> list[str]:
        """Q23: graph columns in fixed order; a group appears only if its roles exist."""
        names: list[str] = []
        if self.src_ip and self.dst_ip:
            names += list(GRAPH_FEATURES[:5])
        if self.dst_port:
            names.append(GRAPH_FEATURES[5])
        if self.src_ip and self.dst_port:
            names.append(GRAPH_FEATURES[6])
        if self.src_port:
            names.append(GRAPH_FEATURES[7])
        return names

    def feature_candidates(self, columns: Iterable[str], extra_drop: Iterable[str] = ()) -> list[str]:
        """Every column except the label, the identity/time columns and ``extra_drop``."""
        drop = {self.label, *NON_FEATURE_COLUMNS, *extra_drop}
        return [c for c in columns if c not in drop]
