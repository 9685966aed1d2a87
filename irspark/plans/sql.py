"""DuckDB SQL fragments shared by the oracle queries (CTE text)."""

ALNUM = "regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')"


def docs_tokens(tok: str = ALNUM) -> str:
    return f"d AS (SELECT CAST(doc_id AS VARCHAR) doc_id, {tok.format(c='text')} toks FROM documents)"


def query_tokens(tok: str = ALNUM) -> str:
    return f"qt AS (SELECT CAST(item_id AS VARCHAR) query_id, {tok.format(c='text')} toks FROM benchmark)"


QUERIES_FIX = ("qs AS (SELECT CAST(item_id AS VARCHAR) query_id, text, CASE WHEN item_id % 10 < 6 THEN 'train' "
               "WHEN item_id % 10 < 8 THEN 'validation' ELSE 'test' END split FROM benchmark)")
QRELS_FIX = ("qrels AS (SELECT CAST(b.item_id AS VARCHAR) query_id, CAST(d.doc_id AS VARCHAR) doc_id, 1 relevance "
             "FROM benchmark b JOIN documents d ON contains(d.text, b.text))")

# index: postings p(doc_id, term, tf), lengths dl(doc_id, dl), stats st(n, avgdl), df(term, df)
INDEX = """
dl AS (SELECT doc_id, len(toks) dl FROM d),
p AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM d) GROUP BY ALL),
st AS (SELECT count(*)::DOUBLE n, sum(dl)::DOUBLE / count(*) avgdl FROM dl),
df AS (SELECT term, count(*) df FROM p GROUP BY ALL)"""

QTERMS = "q AS (SELECT query_id, term, count(*) qtf FROM (SELECT query_id, unnest(toks) term FROM qt) GROUP BY ALL)"


def bm25_scores(k1: float = 1.2, b: float = 0.75, eps: float = 0.25) -> str:
    return f"""
idf0 AS (SELECT term, ln(st.n - df + 0.5) - ln(df + 0.5) raw FROM df, st),
mi AS (SELECT avg(raw) m FROM idf0),
idf AS (SELECT term, CASE WHEN raw < 0 THEN {eps}::DOUBLE * m ELSE raw END idf FROM idf0, mi),
s AS (SELECT q.query_id, p.doc_id, sum(q.qtf * idf.idf * p.tf * ({k1}::DOUBLE + 1)
        / (p.tf + {k1}::DOUBLE * (1 - {b}::DOUBLE + {b}::DOUBLE * dl.dl / st.avgdl))) score
      FROM q JOIN p USING (term) JOIN idf USING (term) JOIN dl USING (doc_id), st GROUP BY ALL)"""


def topk(src: str, k: int, name: str = "run", tie: str = "ASC") -> str:
    return f"""{name} AS (SELECT query_id, doc_id, score FROM (SELECT query_id, doc_id, round(score, 6) score,
        row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id {tie}) rk FROM {src})
      WHERE rk <= {k})"""


def eval_metrics(run: str = "run", qrels: str = "qrels", ks_p=(1, 10, 20), k_ap: int = 20, k_ndcg: int = 20,
                 group: str = "") -> str:
    """CTE text producing pq(group..., query_id, metric columns) then the caller averages."""
    gsel = f"{group}, " if group else ""
    gpart = f"PARTITION BY {group}, query_id" if group else "PARTITION BY query_id"
    p_cols = ", ".join(f"sum(CASE WHEN rk <= {k} THEN isrel ELSE 0 END)::DOUBLE / {k} AS \"P@{k}\"" for k in ks_p)
    return f"""
jr AS (SELECT {gsel}r.query_id, r.doc_id, r.score, coalesce(q.relevance, 0) rel,
        CASE WHEN coalesce(q.relevance, 0) >= 1 THEN 1 ELSE 0 END isrel
       FROM {run} r JOIN (SELECT DISTINCT query_id FROM {qrels}) jq USING (query_id)
       LEFT JOIN {qrels} q USING (query_id, doc_id)),
rr AS (SELECT *, row_number() OVER ({gpart} ORDER BY score DESC, doc_id DESC) rk,
        sum(isrel) OVER ({gpart} ORDER BY score DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) cumrel
       FROM jr),
rq AS (SELECT {gsel}query_id, {p_cols},
        sum(CASE WHEN rk <= {k_ap} AND isrel = 1 THEN cumrel::DOUBLE / rk ELSE 0 END) ap_num,
        sum(CASE WHEN rk <= {k_ndcg} THEN greatest(rel, 0)::DOUBLE / log2(rk + 1) ELSE 0 END) dcg
       FROM rr GROUP BY ALL),
iq AS (SELECT query_id, sum(CASE WHEN relevance >= 1 THEN 1 ELSE 0 END) nrel,
        sum(CASE WHEN irk <= {k_ndcg} THEN greatest(relevance, 0)::DOUBLE / log2(irk + 1) ELSE 0 END) idcg
       FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) irk FROM {qrels}) GROUP BY ALL)"""
