"""Shared pieces of the comparison SQL."""

from __future__ import annotations

PAPERS = """papers AS (
  SELECT doc_id AS paper_id, split_part(text, chr(10), 1) AS title, text AS abstract,
         source || ' (' || lang || ')' AS primary_subject,
         source || ' (' || lang || '); ' || lang AS joined_subjects, source, lang
  FROM documents)"""

VECTORS = """papers AS (
  SELECT vec_id AS paper_id, embedding::DOUBLE[] AS embedding, label::VARCHAR AS primary_subject, label
  FROM embeddings)"""

LOG = """log AS (
  SELECT event_id AS request_id, ts, event_type AS endpoint, 'POST' AS method,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
         value AS latency, event_type <> 'error' AS success
  FROM events)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def h48(*parts: str) -> str:
    """The keyed draw; each part is a SQL expression."""
    key = ", ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5(concat_ws(':', {key})), 1, 12))::BIGINT"


def ranked(name: str, source: str, seed: int, tag: str, where: str = "true", partition: str = "") -> str:
    """The rows of ``source`` with their rank ``rk`` by draw and the row count ``n``."""
    over = f"PARTITION BY {partition} " if partition else ""
    order = h48(str(seed), f"'{tag}'", "paper_id")
    return f"""{name} AS (
  SELECT *, row_number() OVER ({over}ORDER BY {order}, paper_id) AS rk, count(*) OVER ({over}) AS n
  FROM {source} WHERE {where})"""


NESTED = f"""{ranked("by_test", "papers", 42, "test")},
marked AS (SELECT * EXCLUDE (rk, n), rk <= ceil(n * 0.2::DOUBLE) AS is_test FROM by_test),
{ranked("by_eval", "marked", 42, "eval", "NOT is_test")},
splits AS (
  SELECT paper_id, 'test' AS split FROM marked WHERE is_test
  UNION ALL
  SELECT paper_id, CASE WHEN rk <= ceil(n * 0.2::DOUBLE) THEN 'eval' ELSE 'train' END FROM by_eval)"""


def sample_roles(size: int, query_count: str) -> str:
    base = str(size) if query_count == "requested" else f"least({size}, n)"
    return f"""{ranked("by_ir", "papers", 42, "ir")},
roles AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk <= {base} // 5 THEN 'query' ELSE 'corpus' END AS role
  FROM by_ir WHERE rk <= {size})"""


def request_roles() -> str:
    """A fifth of the table are queries; every other row is the corpus."""
    return f"""{ranked("by_ir", "papers", 42, "ir")},
roles AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk <= n // 5 THEN 'query' ELSE 'corpus' END AS role FROM by_ir)"""


def stratified_sample(size: int) -> str:
    return f"""{ranked("by_strata", "papers", 42, "strata", partition="primary_subject")},
drawn AS (
  SELECT * EXCLUDE (rk, n) FROM by_strata
  WHERE rk <= least(n, greatest(1, floor({size} * (n::DOUBLE / (SELECT count(*) FROM papers)))))),
{ranked("by_trim", "drawn", 42, "trim")},
sampled AS (SELECT * EXCLUDE (rk, n) FROM by_trim WHERE rk <= {size})"""


def capped_roles(cap: int) -> str:
    return f"""{ranked("by_cap", "papers", 42, "cap", partition="primary_subject")},
roles AS (
  SELECT * EXCLUDE (rk, n),
         CASE WHEN rk <= greatest(1, floor(least(n, {cap}) * 0.2::DOUBLE)) THEN 'query' ELSE 'corpus' END AS role
  FROM by_cap WHERE n >= 2 AND rk <= {cap})"""


SUBJECT_INDEX = f"""subjects AS (
  SELECT primary_subject AS subject, count(*) AS n FROM papers GROUP BY 1 HAVING count(*) >= 2),
numbered AS (
  SELECT subject, n,
         row_number() OVER (ORDER BY {h48("'subject'", "subject")}, subject) - 1 AS ix,
         coalesce(sum(n) OVER (ORDER BY {h48("'subject'", "subject")}, subject
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo
  FROM subjects),
totals AS (SELECT count(*) AS s, sum(n)::BIGINT AS total_rows FROM numbered),
positions AS (
  SELECT p.*, s.lo + row_number() OVER (PARTITION BY subject ORDER BY {h48("42", "'pos'", "paper_id")}, paper_id) - 1 AS pos
  FROM papers p JOIN numbered s ON p.primary_subject = s.subject)"""


def _same_subject(last: str, balanced: bool, key: str = "'42.0'") -> str:
    draw = h48(key, "'s'", "pair_id")
    hit = f"{draw} % s = ix" if balanced else f"{draw} % total_rows >= lo AND {draw} % total_rows < lo + n"
    return f"""same_draws AS (
  SELECT pair_id, subject, n, lo, {h48(key, "'a'", "pair_id")} % n AS i1
  FROM (SELECT unnest(range({last})) AS pair_id) CROSS JOIN totals JOIN numbered ON {hit}),
same AS (
  SELECT pair_id, subject, lo + i1 AS pos1, lo + (i1 + 1 + {h48(key, "'b'", "pair_id")} % (n - 1)) % n AS pos2
  FROM same_draws)"""


COUNT = "(SELECT count(*) FROM papers)"


def positive_ids(balanced: bool, epoch: int = 0) -> str:
    key = f"'42.{epoch}'"
    return f"{SUBJECT_INDEX},\n{_same_subject(COUNT, balanced, key)}"


def contrastive_ids() -> str:
    """``both_ids(pair_id, id1, id2, label)`` with as many pairs as papers."""
    k1, k2 = h48("'42.0'", "'n1'", "pair_id"), h48("'42.0'", "'n2'", "pair_id")
    return f"""{SUBJECT_INDEX},
{_same_subject(f"{COUNT} // 2", True)},
other_draws AS (
  SELECT pair_id, {k1} % s AS ix1, ({k1} % s + 1 + {k2} % (s - 1)) % s AS ix2
  FROM (SELECT unnest(range({COUNT} // 2, {COUNT})) AS pair_id) CROSS JOIN totals),
other AS (
  SELECT pair_id, x.lo + {h48("'42.0'", "'a'", "pair_id")} % x.n AS pos1, y.lo + {h48("'42.0'", "'b'", "pair_id")} % y.n AS pos2
  FROM other_draws JOIN numbered x ON x.ix = ix1 JOIN numbered y ON y.ix = ix2),
both_ids AS (
  SELECT pair_id, p.paper_id AS id1, q.paper_id AS id2, drawn.label
  FROM (SELECT pair_id, pos1, pos2, 1.0::DOUBLE AS label FROM same
        UNION ALL SELECT pair_id, pos1, pos2, 0.0::DOUBLE FROM other) drawn
  JOIN positions p ON p.pos = pos1 JOIN positions q ON q.pos = pos2)"""


def centroids(source: str, label: str) -> str:
    """``cent(list_id, centroid)``: unit mean per label, to eight decimals."""
    return f"""comp AS (
  SELECT list_id, pos, avg(x) AS m
  FROM (SELECT {label} AS list_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM {source})
  GROUP BY ALL),
lens AS (SELECT list_id, sqrt(sum(m * m)) AS len FROM comp GROUP BY list_id),
cent AS (
  SELECT list_id, list(round(m / len, 8) ORDER BY pos) AS centroid
  FROM comp JOIN lens USING (list_id) GROUP BY list_id)"""


def assigned(source: str) -> str:
    return f"""assigned AS (
  SELECT * EXCLUDE (best) FROM (
    SELECT p.paper_id, p.embedding, c.list_id,
           row_number() OVER (PARTITION BY p.paper_id
             ORDER BY round(list_inner_product(p.embedding, c.centroid), 6) DESC, c.list_id) AS best
    FROM {source} p CROSS JOIN cent c) WHERE best = 1)"""


def ivf_hits(queries: str, k: str = "10", nprobe: str = "3") -> str:
    """``hits`` of ``queries(query_id, embedding, ...)``; k and nprobe may name its columns."""
    return f"""probed AS (
  SELECT * FROM (
    SELECT q.*, c.list_id, row_number() OVER (PARTITION BY q.query_id
             ORDER BY round(list_inner_product(q.embedding, c.centroid), 6) DESC, c.list_id) AS nth
    FROM {queries} q CROSS JOIN cent c) WHERE nth <= {nprobe}),
hits AS (
  SELECT query_id, rank, score, paper_id FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, paper_id)::INTEGER AS rank FROM (
      SELECT p.* EXCLUDE (embedding), a.paper_id, round(list_cosine_similarity(p.embedding, a.embedding), 6) AS score
      FROM probed p JOIN assigned a USING (list_id))) WHERE rank <= {k})"""


def exact_hits(k: int = 10) -> str:
    """``hits`` of the query rows of ``roles`` among its corpus rows."""
    return f"""hits AS (
  SELECT query_id, rank, score, paper_id FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, paper_id)::INTEGER AS rank FROM (
      SELECT q.paper_id AS query_id, c.paper_id, round(list_cosine_similarity(q.embedding, c.embedding), 6) AS score
      FROM roles q CROSS JOIN roles c WHERE q.role = 'query' AND c.role = 'corpus')) WHERE rank <= {k})"""


QRELS = """qrels AS (
  SELECT q.paper_id AS query_id, q.primary_subject AS subject, c.n_rel
  FROM roles q JOIN (SELECT primary_subject, count(*) AS n_rel FROM roles WHERE role = 'corpus' GROUP BY 1) c
    USING (primary_subject) WHERE q.role = 'query')"""


def query_metrics(hits: str = "hits", name: str = "per_query") -> str:
    def at(k):
        return f"count(*) FILTER (rel AND rank <= {k})"

    columns = [f"CASE WHEN {at(k)} > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS \"accuracy@{k}\"" for k in (1, 3, 5, 10)]
    columns += [f"{at(k)} / {k}::DOUBLE AS \"precision@{k}\"" for k in (1, 5, 10)]
    columns += [f"{at(k)} / n_rel::DOUBLE AS \"recall@{k}\"" for k in (1, 5, 10)]
    columns += [
        "coalesce(1.0::DOUBLE / min(rank) FILTER (rel AND rank <= 10), 0) AS \"mrr@10\"",
        "coalesce(sum(1.0::DOUBLE / log2(rank + 1)) FILTER (rel AND rank <= 10), 0) / "
        "list_sum([1.0::DOUBLE / log2(r + 1) FOR r IN range(1, least(n_rel, 10) + 1)]) AS \"ndcg@10\"",
        "coalesce(sum(nth_rel / rank::DOUBLE) FILTER (rel AND rank <= 100), 0) / least(n_rel, 100) AS \"map@100\"",
    ]
    return f"""{name}_rel AS (
  SELECT q.*, h.rank, coalesce(c.primary_subject = q.subject, false) AS rel,
         count(*) FILTER (c.primary_subject = q.subject) OVER (PARTITION BY q.query_id ORDER BY h.rank) AS nth_rel
  FROM qrels q LEFT JOIN {hits} h USING (query_id) LEFT JOIN roles c ON c.paper_id = h.paper_id),
{name} AS (
  SELECT query_id, subject, n_rel, {", ".join(columns)}
  FROM {name}_rel GROUP BY query_id, subject, n_rel)"""


METRICS = [
    "accuracy@1", "accuracy@3", "accuracy@5", "accuracy@10", "precision@1", "precision@5", "precision@10",
    "recall@1", "recall@5", "recall@10", "mrr@10", "ndcg@10", "map@100",
]


def metric_rows(source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, avg(\"{m}\") AS value FROM {source}" for m in METRICS)


def encoded(name: str, source: str, id_col: str, text_col: str, dim: int = 64) -> str:
    """``name(id_col, embedding)``: the signed word hashing of whole texts, at unit length."""
    n = name
    return f"""{n}_words AS (
  SELECT {id_col}, unnest(regexp_extract_all(lower({text_col}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}),
{n}_sums AS (
  SELECT {id_col}, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS slot,
         sum(CASE WHEN ('0x' || substr(md5(w), 9, 1))::BIGINT % 2 = 1 THEN -1 ELSE 1 END)::DOUBLE AS v
  FROM {n}_words GROUP BY ALL),
{n}_lens AS (SELECT {id_col}, sqrt(sum(v * v)) AS len FROM {n}_sums GROUP BY 1 HAVING sum(v * v) > 0),
{n} AS (
  SELECT {id_col}, list((coalesce(v, 0) / len)::FLOAT::DOUBLE ORDER BY slot) AS embedding
  FROM (SELECT {id_col}, len, unnest(range({dim})) AS slot FROM {n}_lens) LEFT JOIN {n}_sums USING ({id_col}, slot)
  GROUP BY {id_col})"""
