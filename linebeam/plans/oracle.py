"""Equivalent SQL for every registered query, written for DuckDB over the
same parquet tables (views ``customer``, ``events``, ``documents`` ...).

Bindings are repeated here as SQL from their definitions in ``tables.py``;
Bloom-filter queries rebuild the filter from the same md5 double hashing, so
even approximate results are compared row for row.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see functions/ and plans/tables.py).
TOK = "[ \\t\\n\\r\\f]+"
LINE_BREAK = "\\r\\n|\\r|\\n"
INT_LIST_HASH = "[+-]?[0-9]+(#[+-]?[0-9]+)*"
BLOCK_BITS = 1048576

USERS = ("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS raw, "
         "CAST(floor(c_acctbal) AS INTEGER) AS reputation FROM customer")
REP = f"SELECT id, raw FROM ({USERS}) WHERE reputation > 1500"
COMMENTS = ("SELECT CASE WHEN event_type <> 'signup' THEN CAST(user_id * 11 AS VARCHAR) END AS user_id, "
            "CAST(event_id AS VARCHAR) AS raw FROM events")
COMMENTS_KEYED = f"SELECT * FROM ({COMMENTS}) WHERE user_id IS NOT NULL"


def _xml_escape(x: str) -> str:
    return (f"replace(replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), chr(10), '&#10;'), chr(13), '&#13;')")


# Attribute values come from the table columns, not from parsing rendered rows.
COMMENT_TEXT = _xml_escape("concat_ws(' ', event_type, props)")
COMMENT_USER = "CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END"
COMMENT_ATTRS = (f"SELECT CAST(event_id AS VARCHAR) AS id, unnest(['Id', 'Note', 'Text', 'CreationDate', 'UserId']) AS name, "
                 f"unnest([CAST(event_id AS VARCHAR), 'see Text=', {COMMENT_TEXT}, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), "
                 f"{COMMENT_USER}]) AS value FROM events")

BY_YEAR = ("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, '  <row Id=\"' || CAST(o_orderkey AS VARCHAR) || "
           "'\" Note=\"at CreationDate=\" CreationDate=\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || "
           "'\" OwnerId=\"' || CAST(o_custkey AS VARCHAR) || '\" />' AS raw FROM orders WHERE o_orderdate IS NOT NULL")

WORDS = (f"SELECT doc_id, source AS file, w FROM (SELECT doc_id, source, "
         f"unnest(regexp_split_to_array(text, '{TOK}')) AS w FROM documents) WHERE w <> ''")
FIRST_CHAR = (f"SELECT lower(substr(w, 1, 1)) AS letter, count(*) AS n FROM ({WORDS}) "
              f"WHERE regexp_matches(w, '^\\p{{L}}') GROUP BY 1")
INDEX = (f"SELECT word, bucket, string_agg(file, ' ' ORDER BY file) AS files FROM (SELECT DISTINCT lower(w) AS word, "
         f"CAST(('0x' || substr(md5(file), 1, 4))::INTEGER % 16 AS INTEGER) AS bucket, file FROM ({WORDS})) GROUP BY word, bucket")
HOT = (f"SELECT DISTINCT w AS key FROM (SELECT unnest(regexp_split_to_array(text, '{TOK}')) AS w FROM benchmark) "
       f"WHERE w <> ''")
DOC_TOKENS = ("SELECT doc_id, regexp_replace(regexp_replace(w, '''', '', 'g'), '[^a-zA-Z]', ' ', 'g') AS t "
              f"FROM ({WORDS})")

SPACE = ("SELECT l_orderkey AS orderkey, sum(CAST(l_quantity AS INTEGER)) AS s, count(*) AS c "
         "FROM lineitem GROUP BY 1")

HASH = ("SELECT CAST(event_id AS VARCHAR) || '#' || CASE WHEN event_type = 'error' THEN '' "
        "ELSE CAST(user_id AS VARCHAR) END || '#' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || "
        "CASE WHEN event_type = 'click' THEN '#' ELSE '' END AS value FROM events")
HASH_BAD = (f"SELECT value, NOT coalesce(regexp_full_match(value, '{INT_LIST_HASH}') AND "
            "list_bool_and(list_transform(string_split(value, '#'), lambda x: TRY_CAST(x AS INTEGER) IS NOT NULL)), "
            f"false) AS bad FROM ({HASH})")
MIN_MAX = ("SELECT min(list_min(list_transform(string_split(value, '#'), lambda x: TRY_CAST(x AS INTEGER)))) "
           "FILTER (WHERE NOT bad) AS min, "
           "max(list_max(list_transform(string_split(value, '#'), lambda x: TRY_CAST(x AS INTEGER)))) "
           f"FILTER (WHERE NOT bad) AS max, count(*) FILTER (WHERE bad) AS malformed FROM ({HASH_BAD})")

PTS = "SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings"
INSIDE = "coalesce(x * x + y * y < CAST(0.1 AS DOUBLE) * CAST(0.1 AS DOUBLE), false)"
LABELS = (f"SELECT CASE WHEN {INSIDE} THEN 'Inside' ELSE 'Outside' END AS label, count(*) AS n "
          f"FROM ({PTS}) GROUP BY 1")


def bloom_ctes(members: str, block_bits: int = BLOCK_BITS) -> str:
    """CTEs ``prm(n, m, k, w, nb)`` and ``bitpos(block, q)`` of the filter over ``members(key)``:
    w bits a block, nb blocks."""
    return (
        f"mem AS (SELECT DISTINCT key FROM ({members}) WHERE key IS NOT NULL), "
        "sz AS (SELECT count(*) AS n, CAST(floor(-count(*) * ln(0.01) / (ln(2) * ln(2))) AS BIGINT) AS m FROM mem), "
        "prm AS (SELECT n, m, CAST(floor(m / n * ln(2) + 0.5) AS BIGINT) AS k, "
        f"least(m, {block_bits}) AS w, (m + {block_bits - 1}) // {block_bits} AS nb FROM sz), "
        f"mh AS (SELECT {_HASHES} FROM mem), "
        f"bitpos AS (SELECT DISTINCT {_PLACE} AS block, {_POSITION} AS q FROM mh, prm, range(0, 64) r(i) WHERE i < k)")


_HASHES = "('0x' || substr(md5(key), 1, 15))::BIGINT AS h1, ('0x' || substr(md5(key), 16, 15))::BIGINT AS h2"
_PLACE, _POSITION = "CAST((h1 // w) % nb AS INTEGER)", "(h1 % w + i * (h2 % w)) % w"


def bloom_hits(keys: str) -> str:
    """Keys of ``keys(key)`` whose k positions are all set in their block."""
    return (f"SELECT key FROM (SELECT DISTINCT key, {_HASHES} FROM ({keys}) WHERE key IS NOT NULL) kh, prm, "
            f"range(0, 64) r(i) WHERE i < k AND ({_PLACE}, {_POSITION}) IN (SELECT block, q FROM bitpos) "
            "GROUP BY key, k HAVING count(*) = k")


def _join(how: str, a: str = USERS, b: str = COMMENTS) -> str:
    if how == "inner":
        return f"SELECT u.raw AS user_raw, c.raw AS comment_raw FROM ({a}) u JOIN ({b}) c ON u.id = c.user_id"
    if how == "leftouter":
        return (f"SELECT u.raw AS user_raw, coalesce(c.raw, '') AS comment_raw FROM ({a}) u "
                f"LEFT JOIN (SELECT * FROM ({b}) WHERE user_id IS NOT NULL) c ON u.id = c.user_id")
    if how == "rightouter":
        return (f"SELECT coalesce(u.raw, '') AS user_raw, c.raw AS comment_raw FROM ({a}) u "
                f"RIGHT JOIN (SELECT * FROM ({b}) WHERE user_id IS NOT NULL) c ON u.id = c.user_id")
    full = (f"SELECT CASE WHEN u.id IS NULL THEN '' ELSE u.raw END AS user_raw, "
            f"CASE WHEN c.user_id IS NULL THEN '' ELSE c.raw END AS comment_raw, u.id AS ka, c.user_id AS kb "
            f"FROM (SELECT * FROM ({a}) WHERE id IS NOT NULL) u "
            f"FULL JOIN (SELECT * FROM ({b}) WHERE user_id IS NOT NULL) c ON u.id = c.user_id")
    if how == "fullouter":
        return f"SELECT user_raw, comment_raw FROM ({full})"
    return f"SELECT user_raw, comment_raw FROM ({full}) WHERE ka IS NULL OR kb IS NULL"


_BLOOM_EXACT = {"inner": "inner", "leftouter": "leftouter", "rightouter": "inner",
                "fullouter": "leftouter"}


def _bloom_join(how: str) -> str:
    if how == "anti":
        return (f"SELECT u.raw AS user_raw, '' AS comment_raw FROM ({REP}) u "
                f"WHERE u.id NOT IN (SELECT user_id FROM ({COMMENTS_KEYED}))")
    return _join(_BLOOM_EXACT[how], REP, COMMENTS)


FILTER_BITS = ("SELECT n, m, CAST(k AS INTEGER) AS k, CAST(0.01 AS DOUBLE) AS p, block, q FROM prm, bitpos")
REP_CTES = bloom_ctes(f"SELECT id AS key FROM ({REP})")
LET_THROUGH = f"hit AS ({bloom_hits(f'SELECT user_id AS key FROM ({COMMENTS})')})"
PASSED = f"SELECT * FROM ({COMMENTS}) WHERE user_id IN (SELECT key FROM hit)"

SQL: dict[str, str] = {
    "first_char_count": FIRST_CHAR,
    "xml_word_count": (f"SELECT lower(w) AS word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array("
                       f"{COMMENT_TEXT}, '{TOK}')) AS w FROM events) WHERE w <> '' GROUP BY 1"),
    "inverted_index": INDEX,
    "inverted_index_report": f"SELECT word, bucket, '{{ ' || files || ' }}' AS files FROM ({INDEX})",
    "inverted_index_sorted": f"SELECT word, bucket, files FROM ({INDEX}) ORDER BY word, bucket",
    "posting_counts": f"SELECT lower(w) AS word, file, count(*) AS tf FROM ({WORDS}) GROUP BY 1, 2",
    "posting_maps": ("SELECT word, bucket, '{' || string_agg(file || '=' || CAST(tf AS VARCHAR), ', ' ORDER BY file) || '}' AS tf FROM ("
                     "SELECT word, CAST(('0x' || substr(md5(file), 1, 4))::INTEGER % 16 AS INTEGER) AS bucket, file, count(*) AS tf "
                     f"FROM (SELECT lower(w) AS word, file FROM ({WORDS})) GROUP BY ALL) GROUP BY word, bucket"),
    "hotlist_filter": (f"SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM ({DOC_TOKENS}) "
                       f"WHERE length(t) > 0 AND t IN (SELECT key FROM ({HOT})))"),
    "hotlist_filter_bloom": (f"WITH {bloom_ctes(HOT)}, "
                             f"hit AS ({bloom_hits(f'SELECT t AS key FROM ({DOC_TOKENS}) WHERE length(t) > 0')}) "
                             f"SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM ({DOC_TOKENS}) "
                             "WHERE t IN (SELECT key FROM hit))"),
    "join_inner": _join("inner"),
    "join_leftouter": _join("leftouter"),
    "join_rightouter": _join("rightouter"),
    "join_fullouter": _join("fullouter"),
    "join_anti": _join("anti"),
    "bloom_join_inner": _bloom_join("inner"),
    "bloom_join_leftouter": _bloom_join("leftouter"),
    "bloom_join_rightouter": _bloom_join("rightouter"),
    "bloom_join_fullouter": _bloom_join("fullouter"),
    "bloom_join_anti": _bloom_join("anti"),
    **{f"bloom_join_{how}_raw": f"WITH {REP_CTES}, {LET_THROUGH} " + _join(how, REP, PASSED)
       for how in ("rightouter", "fullouter", "anti")},
    "bloom_semi_filter": (f"WITH {bloom_ctes(f'SELECT id AS key FROM ({REP})')}, "
                          f"hit AS ({bloom_hits(f'SELECT user_id AS key FROM ({COMMENTS})')}) "
                          f"SELECT user_id, raw FROM ({COMMENTS}) WHERE user_id IN (SELECT key FROM hit)"),
    "bloom_build": f"WITH {bloom_ctes(f'SELECT id AS key FROM ({REP})')} {FILTER_BITS}",
    "bloom_save_load": f"WITH {bloom_ctes(f'SELECT id AS key FROM ({REP})')} {FILTER_BITS}",
    "reputable_users": f"SELECT id FROM ({REP})",
    "circle_label_count": LABELS,
    "circle_area_ratio": (f"SELECT round(CAST(4.0 AS DOUBLE) * count(*) FILTER (WHERE {INSIDE}) / "
                          f"nullif(count(*), 0), 6) AS ratio FROM ({PTS})"),
    "line_mean": f"SELECT orderkey, round(s / c, 6) AS mean FROM ({SPACE})",
    "mean_of_line_means": f"SELECT round(avg(s / c), 6) AS mean FROM ({SPACE})",
    "global_mean": f"SELECT round(sum(s) / sum(c), 6) AS mean FROM ({SPACE})",
    "min_max": MIN_MAX,
    "min_max_counter": MIN_MAX,
    "malformed_count": f"SELECT count(*) FILTER (WHERE bad) AS malformed FROM ({HASH_BAD})",
    "malformed_lines": f"SELECT value AS line FROM ({HASH_BAD}) WHERE bad",
    "minmax_report": ("SELECT 'Minimum: ' || coalesce(CAST(min AS VARCHAR), 'null') || chr(9) || 'Maximum: ' || "
                      "coalesce(CAST(max AS VARCHAR), 'null') || chr(9) || 'malformed: ' || CAST(malformed AS VARCHAR) "
                      f"AS report FROM ({MIN_MAX})"),
    "xml_attr_map": f"SELECT id, name, value FROM ({COMMENT_ATTRS}) WHERE value IS NOT NULL",
    "xml_attr_project": (f"SELECT id, user_id FROM (SELECT CAST(event_id AS VARCHAR) AS id, {COMMENT_USER} AS user_id "
                         "FROM events) WHERE user_id IS NOT NULL"),
    "xml_attr_typed": ("SELECT event_id AS id, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id, "
                       "concat_ws(' ', event_type, props) AS text FROM events"),
    "users_by_year": BY_YEAR,
    "users_by_year_grouped": BY_YEAR,
    "users_by_year_range": (f"SELECT year, year - 1995 AS part, raw FROM ({BY_YEAR}) "
                            "WHERE year BETWEEN 1995 AND 2000"),
    "src_text_lines": f"SELECT unnest(regexp_split_to_array(text, '{LINE_BREAK}')) AS value FROM documents",
    "src_multi_path": f"SELECT unnest(regexp_split_to_array(text, '{LINE_BREAK}')) AS value FROM documents",
    "src_tagged_union": (f"SELECT id AS key, 'A' AS tag, raw FROM ({USERS}) WHERE id IS NOT NULL "
                         f"UNION ALL SELECT user_id AS key, 'B' AS tag, raw FROM ({COMMENTS_KEYED})"),
    "src_gzip_text": f"SELECT key AS value FROM ({HOT})",
    "src_xml_rows": (f"SELECT CAST(event_id AS VARCHAR) AS id, {COMMENT_USER} AS user_id, {COMMENT_TEXT} AS text "
                     "FROM events"),
    "src_file_name": INDEX,
    "src_points": f"SELECT x, y, {INSIDE} AS inside FROM ({PTS})",
    "src_hash_numbers": HASH_BAD,
    "src_space_numbers": f"SELECT round(s / c, 6) AS mean FROM ({SPACE})",
    "sink_tsv": f"SELECT letter || chr(9) || CAST(n AS VARCHAR) AS value FROM ({FIRST_CHAR})",
    "sink_lines": "SELECT CAST(event_id AS VARCHAR) AS value FROM events",
    "sink_partition_by_year": BY_YEAR,
    "sink_years_placed": f"SELECT year - 1995 AS part, raw FROM ({BY_YEAR}) WHERE year BETWEEN 1995 AND 2000",
    "sink_overwrite": f"SELECT id AS value FROM ({REP})",
}
