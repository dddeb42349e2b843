"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, decontaminate, embeddings, hmm, minhash, pii, quality, sharding, urls

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_hmm": hmm.op1,
        "op2_private_data": pii.op2,
        "op3_url_filters": urls.op3,
        "op4_bpe": bpe.op4,
        "op5_chat": chat.op5,
        "op6_minhash": minhash.op6,
        "op7_embeddings": embeddings.op7,
        "op8_sharding": sharding.op8,
        "op9_quality": quality.op9,
        "op10_decontamination": decontaminate.op10,
        "pipeline": pipeline,
    }


def _op10_sql() -> str:
    words = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT doc_id, {words} AS w FROM documents),
    b AS (SELECT item_id, {words} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS k FROM (
        SELECT item_id, w[i:i + 9] AS x FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0))),
    pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
    occ AS (SELECT doc_id, i, item_id, n FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM pos, (SELECT DISTINCT n FROM win) WHERE i + n - 1 <= len(w)) JOIN win USING (n, k)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _components_sql(nodes: str, pairs: str) -> str:
    """CTEs comp(id, component) for nodes(id) and pairs(a, b)."""
    return f"""both_ways AS (SELECT a, b FROM {pairs} UNION SELECT b, a FROM {pairs}),
    reach(id, r) AS (SELECT id, id FROM {nodes} UNION SELECT e.b, r FROM reach JOIN both_ways e ON e.a = reach.id WHERE r < e.b),
    comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id)"""


def _op6_sql() -> str:
    words = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    nodes AS (SELECT doc_id AS id FROM w),
    p AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
    {_components_sql("nodes", "p")}
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component AS component_id, component = doc_id AS kept FROM w LEFT JOIN n USING (doc_id) JOIN comp ON comp.id = doc_id"""


def _op7_sql() -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    ok AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    nodes AS (SELECT vec_id AS id FROM v),
    p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id < y.vec_id WHERE len(x.e) = len(y.e) AND list_inner_product(x.e, y.e) / (x.n * y.n) >= 0.9),
    {_components_sql("nodes", "p")},
    links AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id, component = vec_id AS kept FROM v JOIN comp ON comp.id = vec_id LEFT JOIN links ON links.id = vec_id"""


def oracle_sql() -> dict[str, str]:
    return {"op6_minhash": _op6_sql(), "op7_embeddings": _op7_sql(), "op3_url_filters": urls.op3_sql(), "op10_decontamination": _op10_sql()}
