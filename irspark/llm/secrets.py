"""Secret scans with multipart credential linking, in DataFrame functions only.

Three kinds of match are reported wherever they stand: assignments, access identifiers and long hex
strings.  Other parts of a credential are weak on their own: a bare 40-character secret, a short
access identifier, an endpoint.  A weak part is reported only when complementary parts stand within
its scope, a window of characters around it.  The parts of all documents are joined on document and
window cell with an interval condition; it is a semi-join, so no pair is ever put out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut

# The patterns of the base kinds, in the order in which they are listed.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
# Weak parts: a run of a secret key's alphabet (kept at exactly 40 characters), an identifier that is
# short or of a temporary credential (8 to 40 characters), and the address of a service.
WEAK_SECRET = r"[A-Za-z0-9/+]{40,}"
WEAK_ACCESS = r"A[KS]IA[A-Z0-9]+"
ENDPOINT = r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("weak_secret", "weak_access", "endpoint")
KINDS = BASE_KINDS + WEAK_KINDS

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
TURN = "array<struct<gap:int,n:int,v:int>>"


def _turns(text: Column, pattern: str, group: int = 0) -> Column:
    """For each leftmost non-overlapping match of a pattern, in order, the code points between it and the
    match before (``gap``), of the match (``n``) and of a group of it (``v``).  Texts without a match skip the passes."""
    rest, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.char_length
    turns = F.zip_with(F.slice(rest, 1, F.size(hits)), hits, lambda gap, hit: F.struct(size(gap).alias("gap"), size(hit).alias("n")))
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits, size)
    both = F.zip_with(turns, values, lambda t, v: F.struct(t["gap"].alias("gap"), t["n"].alias("n"), v.alias("v")))
    return F.when(text.rlike(pattern), both).otherwise(F.array().cast(TURN))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id and the turns of each kind for every document.  ``row`` names a row of this frame only."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    patterns = (ASSIGN, ACCESS, HEX, WEAK_SECRET, WEAK_ACCESS, ENDPOINT)
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       *[_turns(F.col("text"), p, 1 if k == "assign" else 0).alias(k) for p, k in zip(patterns, KINDS)])


def place_matches(matches: DataFrame) -> DataFrame:
    """(row, rank, kind, base, start, end) of the matches that count: each kind's lengths add up to places, one
    running sum a document and kind.  Weak matches that lie inside a base one are left out, as are base
    parts of documents without weak ones when it comes to linking (``alone``)."""
    def ranked(r: int):
        return lambda t, i: F.struct(F.lit(r).alias("rank"), i.alias("pos"), t["gap"].alias("gap"), t["n"].alias("n"), t["v"].alias("v"))

    each = F.concat(*[F.transform(k, ranked(r)) for r, k in enumerate(KINDS)])
    line = Window.partitionBy("row", "rank").orderBy("pos")
    spans = matches.select("row", F.inline(each)).withColumn("end", F.sum(F.col("gap") + F.col("n")).over(line).cast("int"))
    n, rank = F.col("n"), F.col("rank")
    counts = (F.when(rank == KINDS.index("assign"), F.col("v") >= 8).when(rank == KINDS.index("access"), n >= 16)
              .when(rank == KINDS.index("weak_secret"), n == 40).when(rank == KINDS.index("weak_access"), n.between(8, 40)).otherwise(True))
    base = rank < len(BASE_KINDS)
    spans = spans.where(counts).select("row", "rank", F.get(F.array(*[F.lit(k) for k in KINDS]), rank).alias("kind"),
                                       base.alias("base"), (F.col("end") - n).alias("start"), "end")
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    spans = spans.withColumn("inside", ~F.col("base") & F.coalesce(reach >= F.col("end"), F.lit(False))).where("NOT inside").drop("inside")
    return spans.withColumn("alone", F.min("base").over(Window.partitionBy("row")))


def link_parts(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts (row, start, rank, end, kind) that complementary parts support within ``scope``.

    An identifier and a secret support each other.  An endpoint needs both within its scope; with an
    endpoint near, nothing else is asked of an identifier and a secret that already stand together.
    ``parts`` has row, role (id, secret, endpoint), base, start, rank, end and kind.
    """
    cell = lambda c: F.floor(F.col(c) / scope)
    def near(left: DataFrame, role: str) -> DataFrame:
        """Rows of left whose span comes within ``scope`` characters of a part of that role."""
        # a span is in every cell that it touches, widened by the scope, so that near spans share one
        cells = left.withColumn("cell", F.explode(F.sequence(cell("start") - 1, cell("end") + 1)))
        other = parts.where(F.col("role") == role).select(
            F.col("row").alias("row2"), F.col("start").alias("start2"), F.col("end").alias("end2"))
        other = other.withColumn("cell2", F.explode(F.sequence(cell("start2"), cell("end2"))))
        return (cells.join(other, (F.col("row") == F.col("row2")) & (F.col("cell") == F.col("cell2"))
                           & (F.col("start2") <= F.col("end") + scope) & (F.col("end2") >= F.col("start") - scope), "left_semi")
                .drop("cell").distinct())
    weak = parts.where("NOT base")
    ids, secrets = weak.where("role = 'id'"), weak.where("role = 'secret'")
    ends = weak.where("role = 'endpoint'")
    linked = near(ids, "secret").unionByName(near(secrets, "id")).unionByName(near(near(ends, "id"), "secret"))
    return linked.select("row", "start", "rank", "end", "kind")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Base spans are found wherever they stand; ``n_linked`` counts the weak parts that complementary
    parts support within ``scope`` characters, and ``spans`` lists both.  Places are in code points,
    the end exclusive, ordered by start, then by kind as listed, then by end.  A hex string or the
    value of an assignment counts as a secret; a weak part that lies inside a base span is that
    span's own text and is not reported again.

    Null text counts as empty and has no spans (the empty text's SHA-256).  Every row is scanned whole
    and on its own, with null or repeated ids too.  Other columns are ignored.
    """
    found = cut(find_matches(docs, id_col, text_col))
    spans = cut(place_matches(found))
    role = (F.when(F.col("kind").isin("access", "weak_access"), "id").when(F.col("kind") == "endpoint", "endpoint")
            .otherwise("secret"))
    parts = spans.where("NOT alone").select("row", role.alias("role"), "base", "start", "rank", "end", "kind")
    span = F.struct("start", "rank", "end", "kind")
    # all spans of one document only, bounded by its text
    listed = (spans.where("base").select("row", span.alias("s")).unionByName(link_parts(cut(parts), scope).select("row", span.alias("s")))
              .groupBy("row").agg(F.collect_list("s").alias("spans")).withColumnRenamed("row", "row2"))
    whole = found.select("row", "doc_id").join(listed, F.col("row") == F.col("row2"), "left").select(
        "doc_id", F.coalesce(F.col("spans").cast(SPAN), F.array().cast(SPAN)).alias("spans"))
    whole = whole.select("doc_id", "spans", F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS)).alias("base"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return whole.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("bigint").alias("n_linked"))
