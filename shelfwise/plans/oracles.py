"""SQL twins of the registered queries, for DuckDB over the same parquet tables."""

from __future__ import annotations

# Value i of an embedding, from 0, is added into component i mod 5.
_FOLDED = ", ".join(" + ".join(f"e[{i + 1}]" for i in range(r, 64, 5)) for r in range(5))

# Building blocks, combined into WITH clauses below.
_PARTS = {
    "ratings": """
        SELECT CAST(o_custkey AS INT) AS userId, CAST(l_partkey AS INT) AS productId,
               CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS score,
               CAST(epoch(o_orderdate) AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT CAST(p_partkey AS INT) AS productId, p_name AS name, '' AS imageUrl,
               p_type AS categories,
               concat_ws('|', p_brand, p_type, replace(p_name, ' ', '|')) AS tags
        FROM part""",
    "means": "SELECT productId, avg(score) AS mean FROM ratings GROUP BY productId",
    "shop": """
        SELECT productId, name, categories, round(coalesce(mean, 0.0), 6) AS avgScore
        FROM products LEFT JOIN means USING (productId)""",
    "encoded": """
        SELECT 'PRODUCT_RATING_PREFIX:' || userId || '|' || productId || '|' || score || '|'
               || timestamp AS value
        FROM ratings""",
    "log": """
        SELECT 'INFO --- [exec] rest.ProductApi : ' || value AS value FROM encoded
        UNION ALL
        SELECT 'INFO --- [exec] user ' || user_id || ' ' || event_type FROM events""",
    "vectors": f"""
        SELECT CAST(vec_id AS INT) AS id, [{_FOLDED}] AS v
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""",
    "sim": """
        SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 9) AS sim
        FROM vectors a JOIN vectors b ON a.id <> b.id
        WHERE list_cosine_similarity(a.v, b.v) > 0.4""",
    "simranks": """
        SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank
        FROM sim""",
    "users": """
        SELECT userId, [avg(score * v[1]), avg(score * v[2]), avg(score * v[3]),
                        avg(score * v[4]), avg(score * v[5])] AS u
        FROM ratings JOIN vectors ON productId = id GROUP BY userId""",
    "scored": """
        SELECT userId, id AS productId, round(list_dot_product(u, v), 9) AS score
        FROM users CROSS JOIN vectors""",
    "userlists": """
        SELECT userId, productId, score,
               row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS rank
        FROM scored WHERE score > 0
        QUALIFY rank <= 20""",
    "upserted": """
        SELECT userId, productId, max_by(score, timestamp * 100 + score) AS score,
               min(timestamp) AS timestamp
        FROM ratings GROUP BY userId, productId""",
    "recent": """
        SELECT *, row_number() OVER (
            PARTITION BY userId ORDER BY timestamp DESC, productId, score DESC) AS rank
        FROM ratings""",
    "candidates": """
        SELECT e.userId, s.b AS productId, s.sim,
               row_number() OVER (PARTITION BY e.userId ORDER BY s.sim DESC, s.b) AS rank
        FROM recent e JOIN sim s ON s.a = e.productId
        WHERE e.rank = 1 AND NOT EXISTS (
            SELECT 1 FROM ratings r WHERE r.userId = e.userId AND r.productId = s.b)
        QUALIFY row_number() OVER (PARTITION BY e.userId ORDER BY s.sim DESC, s.b) <= 20""",
    "priority": """
        SELECT c.userId, c.productId,
               floor((sum(s.sim * r.score ORDER BY r.rank) / count(*)
                      + log10(greatest(count(*) FILTER (r.score > 3), 1))
                      - log10(greatest(count(*) FILTER (r.score <= 3), 1)))
                     * 1e9::DOUBLE + 0.5::DOUBLE) / 1e9::DOUBLE AS score
        FROM candidates c
        JOIN recent r ON r.userId = c.userId AND r.rank <= 20
        JOIN sim s ON s.a = c.productId AND s.b = r.productId AND s.sim > 0.6
        GROUP BY c.userId, c.productId""",
    "streamlists": """
        SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS rank
        FROM priority""",
    "rated": "SELECT DISTINCT userId, productId FROM ratings",
    "raters": "SELECT productId, count(*) AS n FROM rated GROUP BY productId",
    "shared": """
        SELECT x.productId AS a, y.productId AS b, count(*) AS c
        FROM rated x JOIN rated y ON x.userId = y.userId AND x.productId <> y.productId
        GROUP BY 1, 2""",
    "itemcf": """
        SELECT a, b, c / sqrt(ra.n * rb.n) AS score,
               row_number() OVER (PARTITION BY a ORDER BY c / sqrt(ra.n * rb.n) DESC, b) AS rank
        FROM shared JOIN raters ra ON ra.productId = a JOIN raters rb ON rb.productId = b
        QUALIFY rank <= 20""",
    "tags": """
        SELECT productId, unnest(string_split(tags, '|')) AS tag FROM products""",
    "tf": "SELECT productId, tag, count(*) AS tf FROM tags WHERE tag <> '' GROUP BY 1, 2",
    "idf": """
        SELECT tag, ln(((SELECT count(*) FROM products) + 1) / (count(*) + 1)) AS idf
        FROM tf GROUP BY tag""",
    "weights": """
        SELECT productId, tag,
               tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY productId)) AS w
        FROM tf JOIN idf USING (tag) WHERE idf > 0""",
    "tagsim": """
        SELECT x.productId AS a, y.productId AS b, round(sum(x.w * y.w), 9) AS score
        FROM weights x JOIN weights y ON x.tag = y.tag AND x.productId <> y.productId
        GROUP BY 1, 2""",
    "content": """
        SELECT a, b, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank
        FROM tagsim WHERE score > 0
        QUALIFY rank <= 20""",
    "split": """
        SELECT *, ((((CAST(userId AS BIGINT) * 7919 + CAST(productId AS BIGINT) * 104729) % 2147483648
                        * 1103515245 + 12345) % 2147483648 * 1103515245 + 12345) % 2147483648
                      // 1024) % 1000 < 200 AS isTest
        FROM ratings""",
    "held": """
        SELECT count(*) AS n FROM (SELECT DISTINCT userId, productId FROM split WHERE isTest)
        WHERE userId IN (SELECT userId FROM split WHERE NOT isTest)
          AND productId IN (SELECT productId FROM split WHERE NOT isTest)""",
    "customers": "SELECT CAST(c_custkey AS INT) AS userId FROM customer",
}


def _with(names: str, body: str) -> str:
    clauses = ", ".join(f"{n} AS ({_PARTS[n]})" for n in names.split())
    return f"WITH {clauses} {body}"


_RATED = "ratings "
_SHOP = "ratings products means shop "
_SIM = "vectors sim "
_STREAM = "ratings vectors sim recent candidates priority streamlists "
_USER_LISTS = "ratings vectors users scored userlists "
_CONTENT = "products tags tf idf weights tagsim content "
_MONTH = "CAST(strftime(to_timestamp({}) AT TIME ZONE 'UTC', '%Y%m') AS INT)"
_MONTHLY = _MONTH.format("timestamp")
_SHOWN = "productId, name, categories, avgScore"
_PARSED = "SELECT userId, productId, score, timestamp FROM ratings"


def _served(parts: str, keys: str, key: str, lists: str) -> str:
    """All keys, each with the first six entries of its list or one empty row."""
    return _with(
        parts,
        f"""SELECT k.{key} AS {key}, l.rank, l.productId, l.name, l.categories, l.avgScore
        FROM ({keys}) k LEFT JOIN (
            SELECT {key}, rank, {_SHOWN} FROM ({lists}) JOIN shop USING (productId)
            WHERE rank <= 6) l ON l.{key} = k.{key}""",
    )


ORACLES: dict[str, str] = {
    "parse_products": _with("products", "SELECT * FROM products"),
    "parse_ratings_csv": _with(_RATED, _PARSED),
    "sink_overwrite_roundtrip": _with(
        "ratings means", "SELECT productId, round(mean, 6) AS avg FROM means"
    ),
    "sink_nested_roundtrip": _with(
        _SIM + "simranks",
        "SELECT a AS productId, rank, b AS otherId, sim AS score FROM simranks",
    ),
    "keyed_replace": _with(
        _RATED,
        """SELECT userId, CASE WHEN avg(score) > 2.75 THEN count(*) * 10 ELSE count(*) END AS n,
                  CASE WHEN avg(score) > 2.75 THEN 'new' ELSE 'old' END AS state
        FROM ratings GROUP BY userId""",
    ),
    "replaced_rows": _with(
        _RATED,
        """SELECT productId, CASE WHEN avg(score) > 2.75 THEN 0 ELSE count(*) END AS count
        FROM ratings GROUP BY productId""",
    ),
    "encode_rating_events": _with("ratings encoded", "SELECT value FROM encoded"),
    "log_collect_lines": _with(
        "ratings encoded log",
        "SELECT value FROM log WHERE regexp_matches(value, '.+PRODUCT_RATING_PREFIX.+')",
    ),
    "log_extract_ratings": _with(
        "ratings encoded log",
        """SELECT trim(string_split(value, 'PRODUCT_RATING_PREFIX:')[2]) AS payload
        FROM log WHERE contains(value, 'PRODUCT_RATING_PREFIX:')""",
    ),
    "parse_rating_payload": _with(_RATED, _PARSED),
    "normalised_epochs": f"""
        SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS from_seconds,
               CAST(epoch(o_orderdate) AS BIGINT) AS from_millis,
               {_MONTH.format("epoch(o_orderdate)")} AS yearmonth
        FROM orders""",
    "half_star_score": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               round(CAST(ceil(l_quantity / 5) AS DOUBLE) / 2, 2) AS score
        FROM lineitem""",
    "product_tags": _with("products tags", "SELECT productId, tag FROM tags WHERE tag <> ''"),
    "rate_more_products": _with(
        _RATED, "SELECT productId, count(*) AS count FROM ratings GROUP BY productId"
    ),
    "rate_more_recently_products": _with(
        _RATED,
        f"""SELECT productId, count(*) AS count, {_MONTHLY} AS yearmonth
        FROM ratings GROUP BY productId, {_MONTHLY}""",
    ),
    "average_products": _with(
        "ratings means", "SELECT productId, round(mean, 6) AS avg FROM means"
    ),
    "average_products_ranked": _with(
        "ratings means",
        "SELECT productId, round(mean, 6) AS avg FROM means ORDER BY mean DESC, productId",
    ),
    "sql_month_view": _with(
        _RATED,
        f"""SELECT {_MONTHLY} AS yearmonth, count(*) AS n, round(avg(score), 6) AS mean,
                   (SELECT max({_MONTHLY}) FROM ratings) AS last
        FROM ratings GROUP BY 1""",
    ),
    "rating_upsert": _with("ratings upserted", "SELECT * FROM upserted"),
    "recent_ratings": _with("ratings recent", "SELECT * FROM recent WHERE rank <= 20"),
    "train_test_split": _with("ratings split", "SELECT * FROM split"),
    "item_cosine_similarity": _with(_SIM, "SELECT a, b, sim FROM sim"),
    "item_cosine_ranked": _with(
        _SIM + "simranks", "SELECT a, rank, b, sim FROM simranks"
    ),
    "similarity_long_form": _with(
        _SIM + "simranks",
        "SELECT a, rank, b, sim AS score FROM simranks WHERE rank <= 20",
    ),
    "item_cf_similarity": _with(
        "ratings rated raters shared itemcf",
        "SELECT a, b, round(score, 6) AS score FROM itemcf",
    ),
    "content_tfidf_similarity": _with(
        _CONTENT, "SELECT a, b, score FROM content"
    ),
    "user_item_pairs": _with(
        "ratings vectors users scored",
        """SELECT userId, count(*) AS pairs, count(*) FILTER (score > 0) AS positive
        FROM scored GROUP BY userId""",
    ),
    "als_factors": _with(
        _RATED,
        """SELECT DISTINCT 'user' AS kind, userId AS id, 5 AS dims FROM ratings
        UNION ALL SELECT DISTINCT 'item', productId, 5 FROM ratings""",
    ),
    "als_user_recs": _with(
        _RATED,
        """SELECT DISTINCT userId, true AS sized, true AS positive, true AS falling FROM ratings""",
    ),
    "als_product_recs": _with(
        _RATED,
        """SELECT DISTINCT productId, true AS inside, true AS symmetric, true AS whole
        FROM ratings""",
    ),
    "als_grid_rmse": _with(
        "ratings split held",
        """SELECT CAST(rank AS INT) AS rank, CAST(reg AS DOUBLE) AS lambda, n, true AS finite
        FROM (SELECT unnest([5, 10, 20, 50]) AS rank), (SELECT unnest([1.0, 0.1, 0.01]) AS reg),
             held""",
    ),
    "als_grid_best": _with(
        _RATED,
        """SELECT true AS "isLeast", true AS "sameApart", true AS "sameRows",
                  CAST(12 AS BIGINT) AS cells
        FROM ratings LIMIT 1""",
    ),
    "distinct_users": _with(_RATED, "SELECT DISTINCT userId FROM ratings"),
    "distinct_products": _with(_RATED, "SELECT DISTINCT productId FROM ratings"),
    "topn_user_recs": _with(
        _USER_LISTS, "SELECT userId, rank, productId, score FROM userlists"
    ),
    "rmse_join": _with(
        "ratings vectors users upserted",
        """SELECT round(sqrt(avg((score - p) * (score - p))), 6) AS rmse, count(*) AS n
        FROM (SELECT score, list_dot_product(u, v) AS p
              FROM upserted JOIN users USING (userId) JOIN vectors ON id = productId)""",
    ),
    "candidate_products": _with(
        "ratings vectors sim recent candidates",
        "SELECT userId, rank, productId, sim FROM candidates",
    ),
    "realtime_scores": _with(
        _STREAM, "SELECT userId, rank, productId, score FROM streamlists"
    ),
    "stream_log_to_ratings": _with(_RATED, _PARSED),
    "stream_recent_ratings": _with(
        "ratings recent",
        "SELECT userId, rank, productId, score, timestamp FROM recent WHERE rank <= 40",
    ),
    "stream_rating_upsert": _with("ratings upserted", "SELECT * FROM upserted"),
    "stream_log_to_topic": _with(
        "ratings encoded",
        "SELECT string_split(value, 'PRODUCT_RATING_PREFIX:')[2] AS payload FROM encoded",
    ),
    "rejected_payloads": """
        SELECT CASE l_linenumber % 4
            WHEN 0 THEN 'u|' || l_partkey || '|4.5|1000'
            WHEN 1 THEN l_orderkey || '|' || l_partkey || '|NaN|1000'
            ELSE l_orderkey || '|' || l_partkey || '|4.5' END AS payload
        FROM lineitem WHERE l_orderkey % 7 = 0 AND l_linenumber % 4 < 3""",
    "stream_recs": _with(
        _STREAM, "SELECT userId, rank, productId, score FROM streamlists"
    ),
    "serve_hot": _with(
        _SHOP,
        f"""SELECT rank, {_SHOWN} FROM (
            SELECT productId, row_number() OVER (ORDER BY m DESC, c DESC, productId) AS rank
            FROM (SELECT productId, max(m) AS m, max_by(c, m) AS c FROM (
                SELECT productId, {_MONTHLY} AS m, count(*) AS c FROM ratings GROUP BY 1, 2)
                GROUP BY productId)
            QUALIFY rank <= 20) JOIN shop USING (productId)""",
    ),
    "serve_rate_more": _with(
        _SHOP,
        f"""SELECT rank, {_SHOWN} FROM (
            SELECT productId, row_number() OVER (ORDER BY count(*) DESC, productId) AS rank
            FROM ratings GROUP BY productId
            QUALIFY rank <= 20) JOIN shop USING (productId)""",
    ),
    "serve_item_cf": _served(
        _SHOP + "rated raters shared itemcf",
        "SELECT productId AS sourceId FROM products",
        "sourceId",
        "SELECT a AS sourceId, b AS productId, rank FROM itemcf",
    ),
    "serve_content_based": _served(
        "ratings means " + _CONTENT + "shop",
        "SELECT productId AS sourceId FROM products",
        "sourceId",
        "SELECT a AS sourceId, b AS productId, rank FROM content",
    ),
    "serve_product_info": _with(
        _SHOP,
        f"SELECT {_SHOWN} FROM shop WHERE productId IN (SELECT productId FROM ratings)",
    ),
    "serve_search": _with(
        _SHOP, f"SELECT {_SHOWN} FROM shop WHERE regexp_matches(name, '[rb]ing')"
    ),
    "serve_user_recs": _served(
        _SHOP + "vectors users scored userlists customers",
        "SELECT userId FROM customers",
        "userId",
        "SELECT userId, productId, rank FROM userlists",
    ),
    "serve_rec_products": _served(
        _SHOP + "vectors users scored userlists customers",
        "SELECT userId FROM customers",
        "userId",
        "SELECT userId, productId, rank FROM userlists",
    ),
    "serve_stream_recs": _served(
        _SHOP + "vectors sim recent candidates priority streamlists customers",
        "SELECT userId FROM customers",
        "userId",
        "SELECT userId, productId, rank FROM streamlists",
    ),
    "blended_recs": _with(
        "ratings vectors sim recent candidates priority streamlists users scored userlists "
        + _CONTENT,
        """SELECT userId, productId, source, sourceRank,
                  row_number() OVER (PARTITION BY userId
                                     ORDER BY source, sourceRank, productId) AS rank
        FROM (SELECT userId, productId, min(s) AS source, arg_min(r, s * 1000 + r) AS sourceRank
              FROM (SELECT userId, productId, 0 AS s, rank AS r FROM streamlists
                    UNION ALL SELECT userId, productId, 1, rank FROM userlists
                    UNION ALL SELECT e.userId, c.b, 2, c.rank
                    FROM recent e JOIN content c ON c.a = e.productId WHERE e.rank = 1)
              GROUP BY userId, productId)
        QUALIFY rank <= 20""",
    ),
}
