"""Common table expressions that give the SQL side the same roles as ``bindings``."""

CTES = {
    "obs": "obs AS (SELECT doc_id AS ord, doc_id, md5(text) AS item, source AS species, lang, "
           "CAST(n_chars AS DOUBLE) AS confidence, n_chars FROM documents)",
    "reference": "reference AS (SELECT DISTINCT source AS species FROM documents WHERE source NOT IN ('src0','src1'))",
    "log": "log AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id, ts, event_type AS predicted_class, "
           "50.0::DOUBLE / (50.0::DOUBLE + value) AS confidence, value AS latency_ms, user_id, props FROM events)",
    "ref_log": "ref_log AS (SELECT * FROM log WHERE ts < TIMESTAMP '2024-01-16')",
    "cur_log": "cur_log AS (SELECT * FROM log WHERE ts >= TIMESTAMP '2024-01-16')",
    "shift_log": "shift_log AS (SELECT * FROM cur_log WHERE latency_ms >= 30)",
    "unit": "unit AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS vec "
            "FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings))",
    "scores": "scores AS (SELECT coalesce(d.doc_id, s.vec_id) AS doc_id, CAST(coalesce(d.doc_id, s.vec_id) AS VARCHAR) AS item, d.source AS species, s.sp AS score_positive, "
              "s.sn AS score_negative, s.sp - s.sn AS score_final FROM documents d FULL JOIN ("
              "SELECT u.vec_id, max(CASE WHEN p.vec_id <= 2 THEN list_dot_product(u.vec, p.vec) END) AS sp, "
              "max(CASE WHEN p.vec_id >= 3 THEN list_dot_product(u.vec, p.vec) END) AS sn "
              "FROM unit u, unit p WHERE p.vec_id <= 6 AND u.vec_id > 6 GROUP BY u.vec_id) s ON s.vec_id = d.doc_id)",
    "logits": "logits AS (SELECT e.vec_id, e.label, list(list_dot_product(e.embedding::DOUBLE[], c.c) * 10.0 ORDER BY c.label) AS logits FROM embeddings e, "
              "(SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, "
              "generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1) c GROUP BY e.vec_id, e.label, e.embedding)",
    "probs": "probs AS (SELECT vec_id, label, list_transform(e, lambda x: x / list_sum(e)) AS p FROM ("
             "SELECT vec_id, label, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM logits))",
    "pairs": "pairs AS (SELECT d.doc_id, l.quality AS y_true, CAST(d.n_chars >= 1000 AS INTEGER) AS y_pred "
             "FROM documents d JOIN labels l USING (doc_id))",
    "history": "history AS (SELECT event_type AS run_id, CAST(day(ts) AS BIGINT) AS step, round(avg(value), 6) AS value "
               "FROM events GROUP BY 1, 2)",
    "runs": "runs AS (SELECT run_name || '-' || d AS run_id, run_name, d AS day, n, start, last, day(start) % 5 <> 0 AS finished, "
            "CASE WHEN day(start) % 5 <> 0 THEN acc END AS test_accuracy, acc AS val_acc, "
            "CASE WHEN day(start) % 5 <> 0 THEN low END AS test_f1, low AS val_f1 FROM ("
            "SELECT predicted_class AS run_name, strftime(ts, '%Y-%m-%d') AS d, count(*) AS n, min(ts) AS start, "
            "max(ts) AS last, round(avg(confidence), 6) AS acc, round(min(confidence), 6) AS low FROM log GROUP BY 1, 2))",
    # stratified split of documents by lang: exact quotas, md5 order
    "sizes": "sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)",
    "quota1": "quota1 AS (SELECT lang, n, sum(n) OVER () AS total, "
              "ceil(CAST(sum(n) OVER () AS DOUBLE) * (0.15::DOUBLE + (1.0::DOUBLE - 0.70::DOUBLE - 0.15::DOUBLE))) AS held FROM sizes)",
    "quota2": "quota2 AS (SELECT *, ceil(held * (1.0::DOUBLE - 0.15::DOUBLE / (0.15::DOUBLE + (1.0::DOUBLE - 0.70::DOUBLE - 0.15::DOUBLE)))) AS n_test, "
              "CAST(n AS DOUBLE) * (total - held) / total AS ex FROM quota1)",
    "quota3": "quota3 AS (SELECT *, floor(ex) + CASE WHEN row_number() OVER (ORDER BY ex - floor(ex) DESC, lang) "
              "<= (total - held) - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS train FROM quota2)",
    "quota4": "quota4 AS (SELECT *, (n - train) * (held - n_test) / sum(n - train) OVER () AS ex2 FROM quota3)",
    "quotas": "quotas AS (SELECT lang, n, CAST(train AS BIGINT) AS train, CAST(floor(ex2) + CASE WHEN row_number() OVER "
              "(ORDER BY ex2 - floor(ex2) DESC, lang) <= (held - n_test) - sum(floor(ex2)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS val FROM quota4)",
    "split": "split AS (SELECT doc_id, lang, CASE WHEN r <= train THEN 'train' WHEN r <= train + val THEN 'val' ELSE 'test' END AS split "
             "FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents) "
             "JOIN quotas USING (lang))",
    # group split: group = lang::md5(text), class seed = 42 + class index
    "grp": "grp AS (SELECT doc_id, lang, lang || '::' || md5(text) AS group_id FROM documents)",
    "grank": "grank AS (SELECT lang, group_id, row_number() OVER (PARTITION BY lang ORDER BY md5((41 + dense_rank) || ':' || group_id), group_id) AS r, "
             "count(*) OVER (PARTITION BY lang) AS n FROM (SELECT *, dense_rank() OVER (ORDER BY lang) AS dense_rank FROM "
             "(SELECT DISTINCT lang, group_id FROM grp)))",
    "gsplit": "gsplit AS (SELECT g.doc_id, g.lang, g.group_id, CASE WHEN r <= floor(n * 0.70::DOUBLE) THEN 'train' "
              "WHEN r <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split "
              "FROM grp g JOIN grank USING (lang, group_id))",
}

# Names a table needs before it.
NEEDS = {
    "ref_log": ["log"], "cur_log": ["log"], "shift_log": ["log", "cur_log"], "scores": ["unit"], "probs": ["logits"], "runs": ["log"],
    "quota1": ["sizes"], "quota2": ["sizes", "quota1"], "quota3": ["sizes", "quota1", "quota2"],
    "quota4": ["sizes", "quota1", "quota2", "quota3"],
    "quotas": ["sizes", "quota1", "quota2", "quota3", "quota4"],
    "split": ["sizes", "quota1", "quota2", "quota3", "quota4", "quotas"],
    "grank": ["grp"], "gsplit": ["grp", "grank"],
}


def sql(tables: str, body: str, extra: str = "") -> str:
    """``WITH`` the named tables (and literal extra ones) in front of a query."""
    names: list[str] = []
    for table in tables.split():
        for name in [*NEEDS.get(table, []), table]:
            if name not in names:
                names.append(name)
    parts = [CTES[n] for n in names] + ([extra] if extra else [])
    recursive = "RECURSIVE " if "UNION ALL" in extra else ""
    return f"WITH {recursive}{', '.join(parts)} {body}" if parts else body
