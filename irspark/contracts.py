"""Input contracts shared by all operators: column checks, id casts, size-checked broadcast."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of rows we allow into a broadcast hash table when a side is only
# "usually small" (query terms, qrels, grids).  Above it the join falls back to a shuffle.
BROADCAST_MAX_ROWS_CONF = "irspark.broadcast.maxRows"
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
# The same in bytes of the rows' values (texts and vectors may be long).
BROADCAST_MAX_BYTES_CONF = "irspark.broadcast.maxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 128 << 20

RUN_COLUMNS = ("query_id", "doc_id", "score")


def require_columns(df: DataFrame, required, name: str) -> None:
    missing = set(required) - set(df.columns)
    if missing:
        # fixed value: callers expect this message
        raise ValueError(f"{name} is missing required columns: " + ", ".join(sorted(missing)))


def id_str(c) -> Column:
    """Ids are strings at every boundary (an int query id must still match a string one)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def text_or_empty(c) -> Column:
    """NULL text becomes '' (never the literal tokens 'none' / 'nan')."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def round6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def broadcast_max_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_ROWS


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes the values of a row take: texts and arrays by their length, others 16."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = F.octet_length(c) + 16
        elif kind == "array<string>":
            size = F.octet_length(F.array_join(c, "")) + 24 * F.size(c)
        elif kind.startswith(("array", "map")):
            size = 32 * F.size(c)
        else:
            size = F.lit(16)
        total = total + F.coalesce(size.cast("bigint"), F.lit(16))
    return total


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether rows and bytes of ``df`` are within the broadcast bounds; reads at most ``max_rows + 1`` rows."""
    bound = broadcast_max_rows(df) if max_rows is None else max_rows
    most = int(df.sparkSession.conf.get(BROADCAST_MAX_BYTES_CONF, None) or DEFAULT_BROADCAST_MAX_BYTES)
    seen = df.select(row_bytes(df).alias("b")).limit(bound + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return seen[0] <= bound and seen[1] <= most


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, checkpoint: bool = False) -> DataFrame:
    """Broadcast ``df`` only when it is proven small; otherwise leave the join to a shuffle.

    Both rows and bytes are bounded.  Only the row sizes are read, and of those at most
    ``max_rows + 1``.  With ``checkpoint`` the side is first written to the checkpoint folder
    (reliable checkpoint), so the check and every later use read it instead of recomputing it.
    """
    if checkpoint:
        df = df.checkpoint(eager=True)
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def spread(df: DataFrame) -> DataFrame:
    """Make sure per-row work (tokenising long texts) has at least one partition per core.

    A large table on a cluster is already split into many scan tasks and is returned as is;
    a file stored as one row group (as the test tables are) is round-robin repartitioned.
    """
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast for frames built from a driver-side literal (grid, word list): size known."""
    return F.broadcast(df)


# ---------------------------------------------------------------- metric specs

@dataclass(frozen=True)
class Measure:
    kind: str            # 'P', 'AP', 'nDCG', 'R', 'RR'
    cutoff: int | None   # None = uncut

    @property
    def name(self) -> str:
        return self.kind if self.cutoff is None else f"{self.kind}@{self.cutoff}"


DEFAULT_METRICS = ("P@1", "P@10", "P@20", "AP@20", "nDCG@20")
_MEASURE_RE = re.compile(r"^\s*(P|MAP|AP|nDCG|NDCG|ndcg|R|RR|MRR)\s*(?:@\s*(\d+))?\s*$")


def parse_measure(spec) -> Measure:
    if isinstance(spec, Measure):
        return spec
    m = _MEASURE_RE.match(str(spec))
    if not m:
        raise ValueError(f"unknown measure: {spec!r}")
    kind, cut = m.group(1), m.group(2)
    kind = {"MAP": "AP", "NDCG": "nDCG", "ndcg": "nDCG", "MRR": "RR"}.get(kind, kind)
    return Measure(kind, int(cut) if cut is not None else None)


def measures_at(metrics, ks) -> list[Measure]:
    """The measures of a list of specs; a bare ``P`` or ``nDCG`` stands for one per positive depth in
    ``ks`` (ascending).  Repeated measures count once, in their first place."""
    depths = [k for k in dict.fromkeys(sorted(map(int, ks))) if k >= 1]
    out: dict[Measure, None] = {}
    for m in map(parse_measure, metrics or DEFAULT_METRICS):
        for cut in depths if m.kind in ("P", "nDCG") and m.cutoff is None else (m.cutoff,):
            out[Measure(m.kind, cut)] = None
    return list(out)
