"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

from workloads.views import with_clause

ORACLE: dict[str, str] = {}

# Unicode white space and letter classes as the check engine spells them.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def norm_sql(t: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({t}, '')), '{WS}+', ' ', 'g'))"


def check(name: str, body: str, *views: str, ctes: str = "") -> None:
    parts = [p for p in (with_clause(*views) if views else "", ctes) if p]
    head = "WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else ""
    ORACLE[name] = head + body


check(
    "valid_items",
    """SELECT coalesce(nullif(id, ''), nullif(item_id, '')) AS id, coalesce(title, '') AS title, coalesce(subtitle, '') AS subtitle, pos
       FROM raw_items WHERE coalesce(nullif(id, ''), nullif(item_id, '')) IS NOT NULL""",
    "raw_items",
)

BLOCKED = f"""blocked AS (
    SELECT *, coalesce(nullif(regexp_extract(norm, '[a-z0-9]+', 0), ''), '__empty__') AS token, length(norm) // 8 AS band
    FROM (SELECT *, {norm_sql('title')} AS norm FROM items))"""

check("normalized_titles", "SELECT id, norm, token, band FROM blocked", "items", ctes=BLOCKED)

LOW = "[lower(x) FOR x IN regexp_extract_all({0}, '[A-Za-z]+')]"
check(
    "item_tokens",
    f"""SELECT id, array_to_string(regexp_extract_all(title, '[A-Za-z]+'), ' ') AS tokens,
        array_to_string(list_sort(list_distinct({LOW.format('subtitle')})), ' ') AS subtitle_set,
        array_to_string(list_sort(list_distinct([y FOR y IN {LOW.format('title')} IF length(y) >= 4])), ' ') AS keywords,
        length(regexp_replace(title || ' ' || subtitle, '^{WS}+|{WS}+$', '', 'g')) AS text_length
        FROM items""",
    "items",
)

KEYWORDS = f"""kw_raw AS (
    SELECT 'title' AS side, unnest(list_distinct([y FOR y IN {LOW.format('title')} IF length(y) >= 4])) AS word FROM items
    UNION ALL SELECT 'subtitle', unnest(list_distinct([y FOR y IN {LOW.format('subtitle')} IF length(y) >= 4])) FROM items),
keywords AS (SELECT side, word, count(*) AS item_count FROM kw_raw GROUP BY side, word HAVING count(*) >= 3)"""
check(
    "keyword_df",
    "SELECT side, word, item_count, row_number() OVER (PARTITION BY side ORDER BY item_count DESC, word) AS rank FROM keywords",
    "items",
    ctes=KEYWORDS,
)

LAST_RULES = """last_rules AS (
    SELECT coalesce(depth, 10000) AS phase, side, arg_max({'w1': w1, 'w2': w2, 'c': category_slug, 'f': confidence}, seq) AS r
    FROM rules GROUP BY 1, 2, least(w1, w2), greatest(w1, w2)),
uniq AS (SELECT phase, side, r.w1 AS w1, r.w2 AS w2, r.c AS category_slug, r.f AS confidence FROM last_rules)"""
ONE_SET = LAST_RULES.replace("coalesce(depth, 10000)", "1")
check("rule_last_wins", "SELECT * FROM uniq", "rules", ctes=LAST_RULES)


def trig_sql(cross: bool) -> str:
    if cross:
        src = "SELECT pos, id, 'cross' AS source, regexp_extract_all(title || ' ' || subtitle, '[A-Za-z]+') AS toks FROM items"
        side = ""
    else:
        src = """SELECT pos, id, 'title' AS source, regexp_extract_all(title, '[A-Za-z]+') AS toks FROM items
                 UNION ALL SELECT pos, id, 'subtitle', regexp_extract_all(subtitle, '[A-Za-z]+') FROM items"""
        side = "AND r.side = a.source"
    return f"""views AS ({src}),
    tok AS (SELECT pos, id, source, unnest(toks) AS t, generate_subscripts(toks, 1) AS ix FROM views),
    seen AS (SELECT pos, id, source, lower(t) AS w, arg_min(t, ix) AS cased FROM tok GROUP BY 1, 2, 3, 4),
    trig AS (SELECT a.pos, a.id, r.phase, r.category_slug, a.cased AS w1, b.cased AS w2, r.confidence, a.source
             FROM seen a JOIN uniq r ON r.w1 = a.w {side} JOIN seen b ON b.pos = a.pos AND b.source = a.source AND b.w = r.w2)"""


RANKED = """cats AS (
    SELECT pos, id, phase, category_slug, category_slug NOT IN ('other', 'miscellaneous') AS real,
           count(*) AS matched_bigram_count, max(confidence) AS max_confidence,
           string_agg(w1 || ':' || w2 || ':' || printf('%.2f', confidence) || ':' || source, '|' ORDER BY confidence DESC, w1, w2, source) AS triggers
    FROM (SELECT DISTINCT * FROM trig) GROUP BY 1, 2, 3, 4),
low AS (SELECT * FROM cats QUALIFY phase = min(phase) OVER (PARTITION BY pos)),
ranked AS (SELECT pos, id, phase, category_slug, matched_bigram_count, max_confidence, triggers,
    CASE WHEN real THEN row_number() OVER (PARTITION BY pos ORDER BY real DESC, matched_bigram_count DESC, max_confidence DESC, category_slug) END AS rank
    FROM low),
totals AS (SELECT pos, id, coalesce(sum(matched_bigram_count) FILTER (rank IS NOT NULL), 0)::BIGINT AS total_triggered_bigrams,
    coalesce(max(max_confidence) FILTER (rank IS NOT NULL), 0.0) AS max_confidence,
    max(category_slug) FILTER (rank = 1) AS top_category FROM ranked GROUP BY pos, id)"""

STRICT = [LAST_RULES, trig_sql(False)]
CROSS = [LAST_RULES, trig_sql(True)]
for name, cross in (("match_strict", False), ("match_cross", True)):
    check(
        name,
        "SELECT id, category_slug, matched_bigram_count, max_confidence, triggers, rank FROM ranked",
        "items", "rules",
        ctes=",\n".join([ONE_SET, trig_sql(cross), RANKED]),
    )
check(
    "cascade_files",
    "SELECT id, phase, category_slug, matched_bigram_count FROM ranked WHERE rank = 1",
    "items", "rules",
    ctes=",\n".join([LAST_RULES.replace("coalesce(depth, 10000)", "coalesce(depth, 10000)::BIGINT * 1048576 + CASE side WHEN 'title' THEN 0 ELSE 1 END"), trig_sql(True), RANKED]),
)
check(
    "top_category",
    "SELECT id, category_slug, matched_bigram_count, max_confidence FROM ranked WHERE rank = 1",
    "items", "rules", ctes=",\n".join([*STRICT, RANKED]),
)
check(
    "match_totals",
    "SELECT id, total_triggered_bigrams, max_confidence, top_category FROM totals",
    "items", "rules", ctes=",\n".join([*CROSS, RANKED]),
)

NODES = """nodes_raw AS (
    SELECT node_key, slug AS path, slug, coalesce(nullif(display_name, ''), slug) AS display_name, NULL::VARCHAR AS parent_path, 0 AS depth, sib AS ord
    FROM tree WHERE parent_key IS NULL
    UNION ALL
    SELECT t.node_key, n.path || '/' || t.slug, t.slug, coalesce(nullif(t.display_name, ''), t.slug), n.path, n.depth + 1, n.ord || chr(1) || t.sib
    FROM tree t JOIN nodes_raw n ON t.parent_key = n.node_key),
nodes AS (SELECT path, slug, display_name, parent_path, depth, ord,
    path NOT IN (SELECT parent_path FROM nodes_raw WHERE parent_path IS NOT NULL) AS is_leaf,
    slug IN ('other', 'miscellaneous') AS is_catch_all FROM nodes_raw)"""
SLUG_PATHS = "slug_paths AS (SELECT slug, arg_min(path, ord) AS path FROM nodes WHERE NOT is_catch_all GROUP BY slug)"
check(
    "cascade_match",
    """SELECT id, phase, category_slug, matched_bigram_count, max_confidence,
        CASE WHEN rank IS NOT NULL THEN row_number() OVER (PARTITION BY pos ORDER BY rank IS NULL, path IS NULL, length(path) DESC, rank) END AS rank
       FROM placed p WHERE NOT EXISTS (SELECT 1 FROM placed q WHERE q.pos = p.pos AND starts_with(q.path, p.path || '/'))""",
    "items", "rules", "tree",
    ctes=",\n".join([*CROSS, RANKED, NODES, SLUG_PATHS, "placed AS (SELECT r.*, s.path FROM ranked r LEFT JOIN slug_paths s ON s.slug = r.category_slug)"]),
)
check(
    "trigger_stats",
    """SELECT least(lower(w1), lower(w2)) AS w_low, greatest(lower(w1), lower(w2)) AS w_high, count(*) AS trigger_count,
        count(DISTINCT id) AS matched_item_count, max(confidence) AS max_confidence,
        array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
        arg_min(w1 || ' ' || w2, {'a': -tot, 'b': -best, 'i': id, 'r': rank, 'c': -confidence, 'x': w1, 'y': w2, 's': source}) AS display
       FROM (SELECT DISTINCT t.id, t.w1, t.w2, t.confidence, t.source, r.rank, m.total_triggered_bigrams AS tot, m.max_confidence AS best, t.pos, t.category_slug
             FROM trig t JOIN ranked r ON r.pos = t.pos AND r.phase = t.phase AND r.category_slug = t.category_slug AND r.rank IS NOT NULL
             JOIN totals m ON m.pos = t.pos)
       GROUP BY 1, 2""",
    "items", "rules", ctes=",\n".join([*CROSS, RANKED]),
)
UNMATCHED = "unmatched AS (SELECT * FROM items WHERE pos NOT IN (SELECT pos FROM trig))"
UNMATCHED_WORDS = """un_tok AS (SELECT pos, unnest(regexp_extract_all(lower(title || ' ' || subtitle), '[a-z]+')) AS word FROM
      (SELECT pos, title, subtitle FROM unmatched)),
un_words AS (SELECT word, count(DISTINCT pos) AS unmatched_item_count, count(*) AS token_count FROM un_tok
    WHERE length(word) >= 5 GROUP BY word HAVING count(DISTINCT pos) >= 4)"""
UNMATCHED_WORDS = UNMATCHED_WORDS.replace("regexp_extract_all(lower(title || ' ' || subtitle), '[a-z]+')", LOW.format("title || ' ' || subtitle"))
check("unmatched_words", "SELECT * FROM un_words", "items", "rules", ctes=",\n".join([*STRICT, UNMATCHED, UNMATCHED_WORDS]))

# ---------------------------------------------------------------- taxonomy
check("taxonomy_nodes", "SELECT path, slug, display_name, parent_path, depth, is_leaf, is_catch_all FROM nodes", "tree", ctes=NODES)
check(
    "taxonomy_leaves",
    "SELECT path AS leaf_path, slug AS leaf_slug, display_name, depth > 0 AND NOT is_catch_all AS for_model FROM nodes WHERE is_leaf",
    "tree", ctes=NODES,
)
check(
    "taxonomy_depths",
    """SELECT depth, count(*) AS n_nodes, count(*) FILTER (is_leaf) AS n_leaves, count(*) FILTER (is_catch_all) AS n_catch_all,
       depth = (SELECT max(depth) FROM nodes) AS deepest FROM nodes GROUP BY depth""",
    "tree", ctes=NODES,
)
check("top_level_categories", "SELECT slug, display_name, split_part(path, '/', 1) AS root FROM nodes WHERE depth = 1 AND NOT is_catch_all", "tree", ctes=NODES)
check("slug_paths", "SELECT * FROM slug_paths", "tree", ctes=f"{NODES},\n{SLUG_PATHS}")
check(
    "slug_duplicates",
    "SELECT slug, arg_min(path, ord) AS kept_path, count(DISTINCT path) AS n_paths FROM nodes WHERE NOT is_catch_all GROUP BY slug HAVING count(DISTINCT path) > 1",
    "tree", ctes=NODES,
)
ANCHORS = r"""node_words AS (
    SELECT path, unnest(regexp_extract_all(lower(replace(CASE WHEN depth = 0 THEN display_name ELSE slug || ' ' || display_name END, '_', ' ')), '\p{L}+')) AS token FROM nodes),
chosen AS (SELECT depth, slug AS anchor, arg_max(path, ord) AS a_path FROM nodes WHERE NOT is_catch_all GROUP BY depth, slug),
anchors AS (SELECT DISTINCT c.depth, c.anchor, w.token FROM chosen c JOIN node_words w ON w.path = c.a_path OR starts_with(w.path, c.a_path || '/'))"""
check("anchor_tokens", "SELECT * FROM anchors", "tree", ctes=f"{NODES},\n{ANCHORS}")
check("catch_all_leaves", "SELECT path AS leaf_path, slug AS leaf_slug, display_name FROM nodes WHERE is_leaf AND is_catch_all AND depth > 0", "tree", ctes=NODES)
check(
    "leaf_search",
    """SELECT query, narrow, path AS leaf_path, slug AS leaf_slug, display_name
       FROM (SELECT * FROM (VALUES (' RING ', 'small'), ('nation_1', ''), ('', 'bolt'), ('façon', ' '), ('supplier', 'europe')) t(query, narrow))
       JOIN nodes ON is_leaf AND depth > 0 AND trim(query) <> ''
        AND contains(lower(path || ' ' || slug || ' ' || display_name), lower(trim(query)))
        AND contains(lower(path || ' ' || slug || ' ' || display_name), lower(trim(narrow)))""",
    "tree", ctes=NODES,
)
check(
    "maximal_paths",
    """SELECT owner, path FROM paths p WHERE NOT EXISTS (SELECT 1 FROM paths q WHERE q.owner = p.owner AND starts_with(q.path, p.path || '/'))""",
    "part_words",
    ctes="""paths AS (SELECT DISTINCT p_brand AS owner, root || '/' || noun || '/' || adj || '_' || noun AS path FROM part_words WHERE p_size > 40
            UNION SELECT DISTINCT p_brand, root || '/' || noun FROM part_words)""",
)
check(
    "taxonomy_insert",
    """SELECT r.parent_path || '/' || r.slug AS path, r.slug, arg_min(r.display_name, seq) AS display_name, r.parent_path, any_value(n.depth) + 1 AS depth
       FROM (SELECT parent_path, trim(display_name) AS display_name, seq, trim(regexp_replace(lower(trim(display_name)), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM proposals) r
       JOIN nodes n ON n.path = r.parent_path AND n.depth >= 1
       WHERE r.slug <> '' AND r.parent_path || '/' || r.slug NOT IN (SELECT path FROM nodes)
       GROUP BY r.parent_path, r.slug""",
    "tree",
    ctes=f"""{NODES},
proposals AS (SELECT 'services/' || replace(lower(r_name), ' ', '_') || CASE WHEN s_acctbal > 0 THEN '/' || lower(n_name) ELSE '' END AS parent_path,
    CASE WHEN s_acctbal > 5000 THEN s_name WHEN s_acctbal > 2000 THEN ' New shop! ' || n_name ELSE '--' END AS display_name, s_suppkey AS seq
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
)

# ---------------------------------------------------------------- rule generation
# Ratio by repeated longest common blocks (leftmost first), as a recursive query over sub-strings.
PARENTS = f"""{KEYWORDS},
words AS (SELECT DISTINCT word FROM keywords),
tokens AS (SELECT DISTINCT token FROM anchors WHERE depth IN (1, 2)),
cand AS (SELECT word AS w, token AS t FROM words JOIN tokens ON left(word, 3) = left(token, 3) OR length(token) < 3
    WHERE word <> token AND 2.0 * least(length(word), length(token)) / (length(word) + length(token)) >= 0.58),
ro AS (
    SELECT w, t, '' AS side, w AS a, t AS b, 0 AS m FROM cand
    UNION ALL
    SELECT w, t, side || s.z, CASE s.z WHEN 'L' THEN substr(a, 1, best.i - 1) ELSE substr(a, best.i + best.k) END,
           CASE s.z WHEN 'L' THEN substr(b, 1, best.j - 1) ELSE substr(b, best.j + best.k) END, CASE s.z WHEN 'L' THEN best.k ELSE 0 END
    FROM (SELECT w, t, side, a, b, arg_max({{'i': i, 'j': j, 'k': k}}, k * 1000000 - i * 1000 - j) AS best
          FROM (SELECT w, t, side, a, b, i, j, k FROM (SELECT w, t, side, a, b, unnest(range(1, length(a) + 1)) AS i FROM ro WHERE a <> '' AND b <> ''),
                LATERAL (SELECT unnest(range(1, length(b) + 1)) AS j), LATERAL (SELECT unnest(range(1, least(length(a), length(b)) + 1)) AS k)
                WHERE i + k - 1 <= length(a) AND j + k - 1 <= length(b) AND substr(a, i::BIGINT, k::BIGINT) = substr(b, j::BIGINT, k::BIGINT))
          GROUP BY w, t, side, a, b), (VALUES ('L'), ('R')) s(z)),
near AS (SELECT w AS word, t AS token FROM ro GROUP BY w, t HAVING 2.0 * sum(m) / (length(w) + length(t)) >= 0.58),
parents AS (SELECT DISTINCT a.depth, h.word, a.anchor AS parent
    FROM (SELECT * FROM near UNION ALL SELECT word, word FROM words) h JOIN anchors a ON a.token = h.token WHERE a.depth IN (1, 2))"""
check("word_parents", "SELECT * FROM parents", "items", "tree", ctes=f"{NODES},\n{ANCHORS},\n{PARENTS}")
RULES_MADE = """made AS (
    SELECT a.depth, ka.side, ka.word AS w1, kb.word AS w2, any_value(a.parent) AS category_slug,
           CASE WHEN any_value(a.n) = 1 AND any_value(b.n) = 1 THEN 1.0::DOUBLE WHEN any_value(a.n) = 1 OR any_value(b.n) = 1 THEN 0.85::DOUBLE ELSE 0.7::DOUBLE END AS confidence
    FROM (SELECT *, count(*) OVER (PARTITION BY depth, word) AS n FROM parents) a
    JOIN (SELECT *, count(*) OVER (PARTITION BY depth, word) AS n FROM parents) b ON a.depth = b.depth AND a.parent = b.parent
    JOIN keywords ka ON ka.word = a.word JOIN keywords kb ON kb.word = b.word AND kb.side = ka.side
    WHERE ka.item_count > kb.item_count OR (ka.item_count = kb.item_count AND ka.word < kb.word)
    GROUP BY 1, 2, 3, 4 HAVING count(*) = 1)"""
for name, least_conf in (("pair_rules", 0.85), ("pair_rules_all_tiers", 0.7)):
    check(
        name, f"SELECT *, 'taxonomy_based' AS source FROM made WHERE confidence >= {least_conf}", "items", "tree",
        ctes=f"{NODES},\n{ANCHORS},\n{PARENTS},\n{RULES_MADE}",
    )

# ---------------------------------------------------------------- frequent pairs
check(
    "vocabulary",
    """SELECT lower(word) AS word_low, arg_min(word, seq) AS display, min(seq) AS seq
       FROM (SELECT unnest([p_type, upper(left(p_type, 1)) || lower(substr(p_type, 2)), p_brand, p_name]) AS word,
             p_partkey * 4 + unnest([0, 1, 2, 3]) AS seq FROM part) GROUP BY 1""",
)
PAIRS = UNMATCHED_WORDS.replace("FROM unmatched", "FROM items") + f""",
post AS (SELECT DISTINCT pos, f, w FROM (
    SELECT pos, 0 AS f, unnest({LOW.format('title')}) AS w FROM items UNION ALL SELECT pos, 1, unnest({LOW.format('subtitle')}) FROM items)
    WHERE w IN (SELECT word FROM un_words)),
freq AS (SELECT w1, w2, count(*) AS unmatched_item_count FROM (
    SELECT DISTINCT a.pos, a.w AS w1, b.w AS w2 FROM post a JOIN post b ON a.pos = b.pos AND a.f = b.f AND a.w < b.w) GROUP BY 1, 2 HAVING count(*) >= 10)"""
check("frequent_pairs", "SELECT w1, w2, w1 AS display1, w2 AS display2, unmatched_item_count FROM freq", "items", ctes=PAIRS)
PAIR_STATE = PAIRS + f""",
ranked_pairs AS (SELECT *, row_number() OVER (ORDER BY unmatched_item_count DESC, w1, w2) AS rank FROM freq),
pair_latest AS (SELECT rank, arg_max(kind, {{'t': decided_at, 's': seq}}) AS kind, arg_max(leaf_path, {{'t': decided_at, 's': seq}}) AS leaf_path FROM pair_log GROUP BY rank),
decided AS (SELECT r.*, l.kind, l.leaf_path FROM ranked_pairs r JOIN pair_latest l ON l.rank = r.rank WHERE l.kind <> 'cleared'),
all_words AS (SELECT DISTINCT pos, f, w FROM (
    SELECT pos, 0 AS f, unnest({LOW.format('title')}) AS w FROM items UNION ALL SELECT pos, 1, unnest({LOW.format('subtitle')}) FROM items)),
hits AS (SELECT DISTINCT a.pos, d.rank, d.kind FROM decided d JOIN all_words a ON a.w = d.w1 JOIN all_words b ON b.w = d.w2 AND b.pos = a.pos AND b.f = a.f),
claims AS (SELECT pos, min(rank) AS rank FROM hits WHERE kind = 'assign' GROUP BY pos)"""
check(
    "pair_claims",
    """SELECT i.id, d.leaf_path, split_part(d.leaf_path, '/', -1) AS leaf_slug, 'manual_bigram_1_3' AS source
       FROM claims c JOIN decided d ON d.rank = c.rank JOIN items i ON i.pos = c.pos""",
    "items", "pair_log", ctes=PAIR_STATE,
)
# pair by pair in order of rank, with the list of items taken so far
check(
    "pair_claims_min",
    """SELECT i.id, t.rank FROM (SELECT rank, unnest(won) AS pos FROM turns) t JOIN items i ON i.pos = t.pos""",
    "items", "pair_log", ctes=PAIR_STATE + """,
wanted AS (SELECT rank, list(pos ORDER BY pos) AS mine, row_number() OVER (ORDER BY rank) AS turn FROM hits WHERE kind = 'assign' GROUP BY rank),
turns AS (
    SELECT 0::BIGINT AS turn, 0::BIGINT AS rank, []::BIGINT[] AS won, []::BIGINT[] AS taken
    UNION ALL
    SELECT turn, rank, CASE WHEN len(open) >= 10 THEN open ELSE [] END, CASE WHEN len(open) >= 10 THEN list_concat(taken, open) ELSE taken END
    FROM (SELECT w.turn, w.rank, t.taken, [x FOR x IN w.mine IF NOT list_contains(t.taken, x)] AS open FROM turns t JOIN wanted w ON w.turn = t.turn + 1))""",
)
check(
    "pair_work_remaining",
    """SELECT (SELECT count(*) FROM items WHERE pos NOT IN (SELECT pos FROM claims)) AS uncategorized,
       (SELECT count(DISTINCT r.rank) FROM ranked_pairs r JOIN all_words a ON a.w = r.w1 JOIN all_words b ON b.w = r.w2 AND b.pos = a.pos AND b.f = a.f
        WHERE r.rank NOT IN (SELECT rank FROM decided) AND a.pos NOT IN (SELECT pos FROM claims)) AS pairs_open""",
    "items", "pair_log", ctes=PAIR_STATE,
)

# ---------------------------------------------------------------- similar titles
check(
    "block_sizes",
    "SELECT token, band, count(*) AS n_items, count(DISTINCT norm) AS n_titles, count(*) * (count(*) - 1) // 2 AS n_pairs FROM blocked GROUP BY token, band",
    "items", ctes=BLOCKED,
)
EQUAL = BLOCKED + """,
sized AS (SELECT *, count(*) OVER (PARTITION BY token, band) AS k FROM blocked),
heads AS (SELECT token, band, norm, k, count(*) AS item_count, min(pos) AS first_pos FROM sized GROUP BY ALL HAVING count(*) >= 5),
numbered AS (SELECT *, 'g_' || lpad((row_number() OVER (ORDER BY token, band, first_pos) - 1)::VARCHAR, 6, '0') AS group_id,
    'component' AS method FROM heads),
members AS (SELECT b.*, n.group_id, n.method FROM blocked b JOIN numbered n ON n.token = b.token AND n.band = b.band AND n.norm = b.norm)"""
check("equal_groups", "SELECT group_id, method, id FROM members", "items", ctes=EQUAL)
# Every pair of distinct titles of a block, by the definition of the ratio: the longest common part (first in the left title,
# then in the right) counts, then what is left and right of it is matched in the same way. Titles of 200 characters or more
# would need the matcher's rule on frequent characters; no block of five holds two of them.
GROUPS = BLOCKED + """,
sized AS (SELECT *, count(*) OVER (PARTITION BY token, band) AS k FROM blocked),
titles AS (SELECT token, band, norm, min(pos) AS p, max(pos) AS q FROM sized WHERE k >= 5 GROUP BY 1, 2, 3),
parts AS (
    SELECT a.p AS u, b.p AS v, a.norm AS x, b.norm AS y, 0::BIGINT AS m, length(a.norm) + length(b.norm) AS total
    FROM titles a JOIN titles b ON a.token = b.token AND a.band = b.band AND a.p <> b.p AND a.p < b.q
    UNION ALL
    SELECT u, v, unnest([x[:i - 1], x[i + z:]]), unnest([y[:j - 1], y[j + z:]]), unnest([z, 0]), total
    FROM (SELECT *, strpos(y, x[i:i + z - 1]) AS j FROM (
        SELECT *, list_position([contains(y, x[s:s + z - 1]) FOR s IN range(1, length(x) - z + 2)], true) AS i FROM (
            SELECT *, list_max([coalesce(list_max([w FOR w IN range(1, length(x) - s + 2) IF contains(y, x[s:s + w - 1])]), 0) FOR s IN range(1, length(x) + 1)]) AS z
            FROM parts WHERE length(x) > 0 AND length(y) > 0) WHERE z > 0))),
edges AS (SELECT u, v FROM parts GROUP BY u, v HAVING 2.0 * sum(m) / any_value(total) >= 0.7),
both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
near AS (SELECT t.p, least(t.p, coalesce(min(e.v), t.p)) AS c FROM titles t LEFT JOIN both_ways e ON e.u = t.p GROUP BY t.p),
links AS (SELECT DISTINCT a.c AS u, b.c AS v FROM both_ways e JOIN near a ON a.p = e.u JOIN near b ON b.p = e.v),
reach AS (SELECT DISTINCT c AS c, c AS r FROM near UNION SELECT w.c, l.v FROM reach w JOIN links l ON l.u = w.r),
component AS (SELECT n.p, min(w.r) AS first_pos FROM near n JOIN reach w ON w.c = n.c GROUP BY n.p),
linked AS (SELECT s.*, c.first_pos FROM sized s JOIN titles t ON t.token = s.token AND t.band = s.band AND t.norm = s.norm JOIN component c ON c.p = t.p),
heads AS (SELECT token, band, first_pos, count(*) AS item_count FROM linked GROUP BY ALL HAVING count(*) >= 5),
numbered AS (SELECT *, 'g_' || lpad((row_number() OVER (ORDER BY token, band, first_pos) - 1)::VARCHAR, 6, '0') AS group_id,
    'component' AS method FROM heads),
members AS (SELECT l.*, n.group_id, n.method FROM linked l JOIN numbered n ON n.token = l.token AND n.band = l.band AND n.first_pos = l.first_pos),
common AS (SELECT group_id, min(norm) AS lo, max(norm) AS hi, arg_min(title, {'l': length(title), 'p': pos}) AS shortest FROM members GROUP BY group_id),
labels AS (SELECT group_id, trim(lo[:list_max([0] || [z FOR z IN range(1, least(length(lo), length(hi)) + 1) IF lo[:z] = hi[:z]])]) AS prefix, shortest FROM common)"""
check("similar_groups", "SELECT group_id, method, id FROM members", "items", ctes=GROUPS)
check(
    "group_labels",
    """SELECT n.group_id, n.method, n.item_count,
        CASE WHEN length(l.prefix) >= 4 THEN l.prefix ELSE coalesce(nullif(trim(l.shortest), ''), l.prefix) END AS master_title
        FROM numbered n JOIN labels l ON l.group_id = n.group_id""",
    "items", ctes=GROUPS,
)
check(
    "group_stats",
    """SELECT (SELECT count(*) FROM items) AS items_in, 0 AS clique_blocks,
       (SELECT count(DISTINCT (token, band)) FROM sized WHERE k >= 5) AS component_blocks, (SELECT count(*) FROM numbered) AS groups_emitted,
       (SELECT count(*) FROM members) AS items_in_groups, (SELECT count(*) FROM items) - (SELECT count(*) FROM members) AS items_ungrouped""",
    "items", ctes=GROUPS,
)
check("ungrouped_items", "SELECT id, title FROM items WHERE pos NOT IN (SELECT pos FROM members)", "items", ctes=GROUPS)
LATEST = """latest AS (SELECT key, arg_max(kind, {'t': decided_at, 's': seq}) AS kind, arg_max(leaf_path, {'t': decided_at, 's': seq}) AS leaf_path
    FROM decision_log GROUP BY key HAVING arg_max(kind, {'t': decided_at, 's': seq}) <> 'cleared')"""
check("latest_decisions", "SELECT * FROM latest", "decision_log", ctes=LATEST)
ASSIGNED = f"""{NODES},
{GROUPS},
{LATEST},
assigned AS (SELECT m.pos, m.id, m.title, m.subtitle, l.leaf_path, split_part(l.leaf_path, '/', -1) AS leaf_slug, coalesce(n.display_name, '') AS leaf_display_name,
    'similar_title_group_1_6' AS method, 'manual_similar_title_1_6' AS source
    FROM members m JOIN latest l ON l.key = m.group_id AND l.kind = 'assign' LEFT JOIN nodes n ON n.path = l.leaf_path AND n.is_leaf)"""
GV = ("items", "tree", "decision_log")
check("group_decisions", "SELECT id, leaf_path, leaf_slug, leaf_display_name, method, source FROM assigned", *GV, ctes=ASSIGNED)
check(
    "decision_counts",
    "SELECT coalesce(l.kind, 'undecided') AS kind, count(*) AS n_groups FROM numbered n LEFT JOIN latest l ON l.key = n.group_id GROUP BY 1",
    *GV, ctes=ASSIGNED,
)
check(
    "remaining_status",
    """SELECT i.id, m.group_id, CASE WHEN m.group_id IS NULL THEN 'not_in_similar_title_group' WHEN l.kind = 'unknown' THEN 'unknown_1_6'
        WHEN l.kind = 'assign' THEN 'in_assigned_group_but_not_in_item_matches' ELSE 'not_decided_in_1_6' END AS status
       FROM items i LEFT JOIN members m ON m.pos = i.pos LEFT JOIN latest l ON l.key = m.group_id WHERE i.id NOT IN (SELECT id FROM assigned)""",
    *GV, ctes=ASSIGNED,
)
check(
    "merge_newest",
    """SELECT id, arg_max(leaf_path, {'n': new, 'p': pos}) AS leaf_path, arg_max(method, {'n': new, 'p': pos}) AS method FROM (
        SELECT id, pos, leaf_path, 'prior' AS method, 0 AS new FROM matched UNION ALL SELECT id, pos, leaf_path, method, 1 FROM assigned) GROUP BY id""",
    *GV, "matched", ctes=ASSIGNED,
)

# ---------------------------------------------------------------- merging
MERGED = f"""{ASSIGNED},
{LAST_RULES},
{trig_sql(False)},
{RANKED},
{SLUG_PATHS},
by_rule AS (SELECT i.pos, i.id, i.title, i.subtitle, coalesce(s.path, t.top_category, '') AS leaf_path FROM totals t JOIN items i ON i.pos = t.pos
    LEFT JOIN slug_paths s ON s.slug = t.top_category),
pair_latest AS (SELECT rank, arg_max(kind, {{'t': decided_at, 's': seq}}) AS kind, arg_max(leaf_path, {{'t': decided_at, 's': seq}}) AS leaf_path FROM pair_log GROUP BY rank),
decided AS (SELECT r.*, l.leaf_path FROM (SELECT w1, w2, row_number() OVER (ORDER BY w1, w2) AS rank FROM (SELECT DISTINCT least(w1, w2) AS w1, greatest(w1, w2) AS w2 FROM uniq)) r
    JOIN pair_latest l ON l.rank = r.rank WHERE l.kind = 'assign'),
all_words AS (SELECT DISTINCT pos, f, w FROM (
    SELECT pos, 0 AS f, unnest({LOW.format('title')}) AS w FROM items UNION ALL SELECT pos, 1, unnest({LOW.format('subtitle')}) FROM items)),
by_pair AS (SELECT i.pos, i.id, i.title, i.subtitle, d.leaf_path FROM (
    SELECT a.pos, min(d.rank) AS rank FROM decided d JOIN all_words a ON a.w = d.w1 JOIN all_words b ON b.w = d.w2 AND b.pos = a.pos AND b.f = a.f GROUP BY a.pos) c
    JOIN decided d ON d.rank = c.rank JOIN items i ON i.pos = c.pos),
by_model AS (SELECT i.pos, i.id, i.title, i.subtitle, p.leaf_path FROM predictions p JOIN items i ON i.id = p.id WHERE p.confidence >= 0.9 AND p.confidence <= 1.0),
every AS (
    SELECT id, title, subtitle, leaf_path, leaf_display_name, 4 AS tier, pos FROM assigned
    UNION ALL SELECT id, title, subtitle, leaf_path, '', 1, pos FROM by_rule
    UNION ALL SELECT id, title, subtitle, leaf_path, '', 3, pos FROM by_pair
    UNION ALL SELECT id, title, subtitle, leaf_path, '', 2, pos FROM by_model),
best AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY id ORDER BY tier DESC, pos) = 1)"""
MV = ("items", "tree", "decision_log", "rules", "pair_log", "predictions")
check(
    "merge_sources",
    """SELECT id, title, subtitle, leaf_path, split_part(leaf_path, '/', -1) AS leaf_slug, leaf_display_name,
        CASE tier WHEN 4 THEN 'interactive_similar_title_group' WHEN 3 THEN 'interactive_manual_bigram_match' WHEN 2 THEN 'llm_match'
             ELSE CASE WHEN contains(leaf_path, '/') THEN 'cascading_bigram' ELSE 't1_bigram' END END AS method FROM best""",
    *MV, ctes=MERGED,
)
check("unmatched_final", "SELECT id, title FROM items WHERE id NOT IN (SELECT id FROM every WHERE tier > 1)", *MV, ctes=MERGED)
check(
    "dedupe_accounting",
    """SELECT matched_in, matched_out, matched_in - matched_out AS matched_removed, n AS unmatched_in, 0 AS unmatched_duplicates,
        matched_out AS unmatched_already_matched, n - matched_out AS unmatched_out
       FROM (SELECT count(*) AS matched_in, count(DISTINCT id) AS matched_out FROM every WHERE tier > 1), (SELECT count(*) AS n FROM items)""",
    *MV, ctes=MERGED,
)
check(
    "unmatched_report",
    """SELECT id, title, subtitle, n_items - n_out AS total_unmatched_items, n_in AS matched_in, n_out AS matched_out, n_in - n_out AS matched_removed,
        n_items AS unmatched_in, 0 AS unmatched_duplicates, n_out AS unmatched_already_matched, n_items - n_out AS unmatched_out
       FROM items, (SELECT count(*) AS n_in, count(DISTINCT id) AS n_out FROM every WHERE tier IN (2, 4)), (SELECT count(*) AS n_items FROM items)
       WHERE id NOT IN (SELECT id FROM every WHERE tier IN (2, 4))""",
    *MV, ctes=MERGED,
)
check(
    "run_funnel",
    """SELECT stage, n AS n_items, round(100.0 * n / (SELECT count(*) FROM items), 1) AS percent FROM (
        SELECT 'all items' AS stage, count(*) AS n FROM items UNION ALL SELECT 'groups', count(*) FROM assigned UNION ALL SELECT 'rules', count(*) FROM by_rule
        UNION ALL SELECT 'pairs', count(*) FROM by_pair UNION ALL SELECT 'model', count(*) FROM by_model UNION ALL SELECT 'merged', count(*) FROM best)""",
    *MV, ctes=MERGED,
)
check(
    "summary_levels",
    """SELECT 'master' AS level, m AS key, CASE m WHEN '(empty)' THEN '(empty path)' WHEN '_unmapped' THEN 'Unmapped (path does not start with a master category)'
          ELSE (SELECT display_name FROM nodes WHERE path = m) END AS display_name, count(*) AS count
       FROM (SELECT CASE WHEN p = '' THEN '(empty)' WHEN known THEN m0 ELSE '_unmapped' END AS m FROM parts) GROUP BY m
       UNION ALL
       SELECT 'parent', k, coalesce((SELECT display_name FROM nodes WHERE path = k), split_part(k, '/', -1)), count(*)
       FROM (SELECT m0 || '/' || split_part(p, '/', 2) AS k FROM parts WHERE known AND contains(p, '/')) GROUP BY k
       UNION ALL SELECT 'leaf', CASE WHEN p = '' THEN '(empty)' ELSE p END, NULL, count(*) FROM parts GROUP BY 2""",
    "matched", "tree", "part_words",
    ctes=f"""{NODES},
parts AS (SELECT p, split_part(p, '/', 1) AS m0, split_part(p, '/', 1) IN (SELECT path FROM nodes WHERE depth = 0) AS known FROM (
    SELECT trim(leaf_path) AS p FROM matched UNION ALL SELECT CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END FROM customer UNION ALL SELECT root FROM part_words))""",
)
check(
    "validate_rows",
    """SELECT pos, id, 'missing id' AS issue FROM rows WHERE id = ''
       UNION ALL SELECT pos, id, 'missing leaf_path' FROM rows WHERE id <> '' AND leaf_path = ''
       UNION ALL SELECT pos, id, 'duplicate id' FROM (SELECT * FROM full_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) > 1)
       UNION ALL SELECT pos, id, 'leaf_path not in taxonomy' FROM full_rows WHERE leaf_path NOT IN (SELECT path FROM nodes)
       UNION ALL SELECT pos, id, 'leaf_path is not a leaf' FROM full_rows WHERE leaf_path IN (SELECT path FROM nodes WHERE NOT is_leaf)""",
    "matched", "tree", "part_words",
    ctes=f"""{NODES},
rows AS (SELECT pos, id, trim(leaf_path) AS leaf_path FROM matched UNION ALL
    SELECT p_partkey + 1000000000000, CASE WHEN p_size < 5 THEN '' ELSE 'itm_' || lpad(p_partkey::VARCHAR, 12, '0') END,
    CASE WHEN p_size > 45 THEN '' WHEN p_size > 40 THEN 'nowhere' ELSE root || '/' || noun END FROM part_words),
full_rows AS (SELECT * FROM rows WHERE id <> '' AND leaf_path <> '')""",
)

# ---------------------------------------------------------------- templates
# The check engine has no look-behind: a bare decimal is found with its left neighbour.
TEMPLATE = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(title,
    '\b\d+\s*/\s*\d+\b', '{{FRAC}}', 'g'), '\b\d+\.\d+\b', '{{NUM}}', 'g'), '(^|[^.\d])\.\d+\b', '\1{{NUM}}', 'g'), '\b\d+\b', '{{NUM}}', 'g'), '{WS}+', ' ', 'g'))"""
ROWS = f"""{NODES},
rows AS (SELECT m.pos, m.id, m.title, m.leaf_path, {TEMPLATE} AS template FROM matched m WHERE leaf_path IN (SELECT path FROM nodes WHERE is_leaf AND depth > 0)),
clustered AS (SELECT *, count(*) OVER (PARTITION BY leaf_path, template) AS n FROM rows),
med AS (SELECT leaf_path, template, list_sort(list(length(title)))[count(*) // 2 + 1] AS median_len, count(*) AS item_count, min(pos) AS first_pos
    FROM clustered WHERE n >= 3 GROUP BY ALL),
reps AS (SELECT m.*, arg_min(c.title, {{'d': abs(length(c.title) - m.median_len), 'p': c.pos}}) AS representative,
    arg_min(c.id, {{'d': abs(length(c.title) - m.median_len), 'p': c.pos}}) AS representative_id
    FROM med m JOIN rows c ON c.leaf_path = m.leaf_path AND c.template = m.template GROUP BY ALL),
sizes AS (SELECT leaf_path, template, count(*) AS n FROM rows GROUP BY ALL),
manifest AS (SELECT leaf_path, sum(n)::BIGINT AS total_items, count(*) FILTER (n >= 3) AS cluster_count, coalesce(sum(n) FILTER (n < 3), 0)::BIGINT AS misc_item_count,
    coalesce(sum(n) FILTER (n < 3), 0) / sum(n) >= 0.6 AS is_low_structure, replace(leaf_path, '/', '__') || '.json' AS file FROM sizes GROUP BY leaf_path)"""
TV = ("matched", "tree")
check("title_templates", "SELECT id, leaf_path, template FROM rows", *TV, ctes=ROWS)
check("template_reps", "SELECT leaf_path, template, item_count, median_len, representative, representative_id FROM reps", *TV, ctes=ROWS)
check("template_members", "SELECT leaf_path, CASE WHEN n >= 3 THEN template END AS template, id FROM clustered", *TV, ctes=ROWS)
check(
    "top_templates",
    f"""SELECT leaf_path, template, item_count, row_number() OVER (PARTITION BY leaf_path ORDER BY item_count DESC, first_pos) AS rank FROM (
        SELECT split_part(leaf_path, '/', 1) AS leaf_path, {TEMPLATE} AS template, count(*) AS item_count, min(pos) AS first_pos FROM matched
        WHERE leaf_path IN (SELECT leaf_path FROM part_leaf) GROUP BY 1, 2 HAVING count(*) >= 3)
       QUALIFY row_number() OVER (PARTITION BY leaf_path ORDER BY item_count DESC, first_pos) <= 5""",
    "matched", "part_leaf",
)
check("template_manifest", "SELECT * FROM manifest", *TV, ctes=ROWS)
check(
    "template_totals",
    "SELECT count(*) AS total_categories, sum(total_items)::BIGINT AS total_items, count(*) FILTER (is_low_structure) AS low_structure_count FROM manifest",
    *TV, ctes=ROWS,
)

# ---------------------------------------------------------------- attributes
SCHEMA = """answered AS (SELECT *, (dense_rank() OVER (ORDER BY round, leaf_path) - 1) AS place FROM attr_rows),
current AS (SELECT * FROM answered QUALIFY round = max(round) OVER (PARTITION BY leaf_path))"""
AV = ("attr_rows",)
check(
    "attribute_schema",
    """SELECT leaf_path, attr_seq, key, label, '' AS description, vtype AS value_type, symbol IS NOT NULL AS unit_required, symbol AS unit FROM current""",
    *AV, ctes=SCHEMA,
)
check("attribute_units", "SELECT symbol, 'unit of ' || arg_min(leaf_path, place) AS name, '' AS description, 'number' AS value_type FROM answered WHERE symbol IS NOT NULL GROUP BY symbol", *AV, ctes=SCHEMA)
check("attribute_patterns", "SELECT leaf_path, key, 0 AS seq, template, regex, hint AS value_normalize FROM current", *AV, ctes=SCHEMA)
check(
    "schema_coverage",
    """SELECT (SELECT count(DISTINCT leaf_path) FROM current) AS leaves_with_attributes, (SELECT count(DISTINCT leaf_path) FROM current) AS leaves_with_patterns,
       (SELECT count(*) FILTER (is_low_structure) FROM manifest) AS low_structure_leaves, (SELECT count(DISTINCT symbol) FROM answered) AS units""",
    "matched", "tree", "attr_rows", ctes=f"{ROWS},\n{SCHEMA}",
)
GOOD = f"""{ROWS},
{SCHEMA},
good AS (SELECT c.leaf_path, key, template, regex, hint FROM current c WHERE key <> 'broken'
    AND (key <> 'finish' OR NOT EXISTS (SELECT 1 FROM reps r WHERE r.leaf_path = c.leaf_path AND r.template = c.template AND NOT contains(r.representative, 'zinc')))),
raw_values AS (SELECT r.pos, r.id AS item_id, r.leaf_path, g.key AS attribute_key,
    CASE g.key WHEN 'size' THEN trim(replace(regexp_extract(r.title, '([0-9]+/16")', 1), '"', '')) WHEN 'brand' THEN lower(regexp_extract(r.title, '(Brand#[0-9]+)', 1))
      ELSE regexp_extract(r.title, '(zinc)', 1) END AS value, CASE g.key WHEN 'size' THEN 'in' END AS unit
    FROM rows r JOIN good g ON g.leaf_path = r.leaf_path AND g.template = r.template
    WHERE EXISTS (SELECT 1 FROM reps p WHERE p.leaf_path = r.leaf_path AND p.template = r.template)),
vals AS (SELECT * FROM raw_values WHERE value <> ''),
routed AS (SELECT r.*, r.pos IN (SELECT pos FROM vals) AS found FROM rows r WHERE r.leaf_path IN (SELECT leaf_path FROM current))"""
XV = ("matched", "tree", "attr_rows")
check("pattern_smoke", "SELECT leaf_path, key, 0 AS seq, template, regex, hint AS value_normalize FROM good", *XV, ctes=GOOD)
check("regex_values", "SELECT item_id, leaf_path, attribute_key, value, unit, 'regex' AS extraction_confidence FROM vals", *XV, ctes=GOOD)
check("extraction_routing", "SELECT id AS item_id, leaf_path FROM routed WHERE NOT found", *XV, ctes=GOOD)
ANSWERS = """answers AS (SELECT item_id, leaf_path, attribute_key, value,
    CASE WHEN value = '' OR conf IN ('none', 'true') THEN 'llm_none' WHEN starts_with(conf, 'llm_') THEN conf ELSE 'llm_' || lower(trim(conf)) END AS extraction_confidence
    FROM value_answers)"""
check(
    "model_values",
    "SELECT *, extraction_confidence IN ('llm_high', 'llm_medium') AS accepted, count(*) AS n FROM answers GROUP BY ALL",
    "value_answers", ctes=ANSWERS,
)
check(
    "extraction_stats",
    """SELECT (SELECT count(*) FROM matched) AS total_items, (SELECT count(*) FROM routed WHERE found) AS regex_matched_items,
        (SELECT count(*) FROM routed WHERE NOT found) AS llm_fallback_items, (SELECT count(*) FROM vals) AS regex_value_rows,
        count(*) FILTER (extraction_confidence IN ('llm_high', 'llm_medium')) AS llm_accepted_rows,
        count(*) FILTER (extraction_confidence NOT IN ('llm_high', 'llm_medium')) AS llm_rejected_rows,
        count(*) FILTER (extraction_confidence = 'llm_high') AS llm_high, count(*) FILTER (extraction_confidence = 'llm_medium') AS llm_medium,
        count(*) FILTER (extraction_confidence = 'llm_low') AS llm_low, count(*) FILTER (extraction_confidence = 'llm_none') AS llm_none,
        (SELECT count(*) FROM vals) + count(*) FILTER (extraction_confidence IN ('llm_high', 'llm_medium')) AS total_value_rows FROM answers""",
    *XV, "value_answers", ctes=f"{GOOD},\n{ANSWERS}",
)
check(
    "all_values",
    """SELECT extraction_confidence, count(*) AS n_values FROM (SELECT 'regex' AS extraction_confidence FROM vals
       UNION ALL SELECT extraction_confidence FROM answers WHERE extraction_confidence IN ('llm_high', 'llm_medium')) GROUP BY 1""",
    *XV, "value_answers", ctes=f"{GOOD},\n{ANSWERS}",
)

# ---------------------------------------------------------------- model tables
CHOICES_ID = """SELECT 'choices_' || count(*) || '_' || coalesce(sum(('0x' || left(md5(slot || ':' || line), 8))::BIGINT), 0) || '_' || coalesce(sum(('0x' || md5(slot || ':' || line)[9:16])::BIGINT), 0) AS choices_id"""
LEAF_CHOICES = NODES + """,
choices AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS slot, to_json({'leaf_path': path, 'display_name': display_name})::VARCHAR AS line
    FROM nodes WHERE is_leaf AND depth > 0 AND NOT is_catch_all)"""
check(
    "model_requests_leaf",
    f"""SELECT 'items' AS part, n // 25 AS batch_no, count(*) AS n_rows, string_agg(to_json({{'id': id, 'title': title, 'subtitle': subtitle}})::VARCHAR, chr(10) ORDER BY n) AS lines, any_value(choices_id) AS choices_id
       FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS n FROM items), ({CHOICES_ID} FROM choices) GROUP BY 2
       UNION ALL
       SELECT 'choices', slot // 100, count(*), string_agg(line, chr(10) ORDER BY slot), any_value(choices_id)
       FROM choices, ({CHOICES_ID} FROM choices) GROUP BY 2""",
    "items", "tree", ctes=LEAF_CHOICES,
)
check("model_choices_leaf", f"SELECT choices_id, slot, line FROM choices, ({CHOICES_ID} FROM choices)", "tree", ctes=LEAF_CHOICES)
check(
    "model_offers",
    f"""SELECT i.id, b.branch, count(*) AS n_words FROM (
        SELECT DISTINCT pos, id, unnest({LOW.format('title')} || {LOW.format('subtitle')}) AS word FROM items) i
       JOIN (SELECT DISTINCT array_to_string(string_split(path, '/')[:2], '/') AS branch, w AS word FROM (
        SELECT path, unnest({LOW.format("path || ' ' || display_name")}) AS w FROM nodes WHERE is_leaf AND depth > 0 AND NOT is_catch_all) WHERE length(w) >= 4) b ON b.word = i.word
       GROUP BY i.pos, i.id, b.branch""",
    "items", "tree", ctes=NODES,
)
check(
    "model_requests_pairs",
    f"""SELECT n // 100 AS batch_no, count(*) AS n_rows, string_agg(to_json([w1, w2])::VARCHAR, chr(10) ORDER BY n) AS lines, any_value(choices_id) AS choices_id FROM (
        SELECT w1, w2, rank - 1 AS n FROM ranked_pairs), ({CHOICES_ID} FROM (
        SELECT row_number() OVER (ORDER BY ord) - 1 AS slot, to_json({{'slug': slug, 'display_name': display_name, 'root': split_part(path, '/', 1)}})::VARCHAR AS line
        FROM nodes WHERE depth = 1 AND NOT is_catch_all)) GROUP BY 1""",
    "items", "pair_log", "tree", ctes=PAIR_STATE + ",\n" + NODES,
)
check(
    "model_requests_attrs",
    """SELECT n // 3 AS batch_no, count(*) AS n_rows, string_agg(line, chr(10) ORDER BY n) AS lines FROM (
        SELECT row_number() OVER (ORDER BY l.path) - 1 AS n,
         concat_ws(chr(10), 'category ' || l.path || ' (' || l.display_name || ')' || CASE WHEN coalesce(m.is_low_structure, true) THEN ' [low-structure]' ELSE '' END,
          t.lines, CASE WHEN m.misc_item_count > 0 THEN 'other titles: ' || m.misc_item_count END) AS line
        FROM nodes l LEFT JOIN manifest m ON m.leaf_path = l.path
        LEFT JOIN (SELECT leaf_path, string_agg('template x' || item_count || ': ' || template || chr(10) || 'example: ' || representative, chr(10) ORDER BY item_count DESC, first_pos) AS lines
             FROM (SELECT * FROM reps QUALIFY row_number() OVER (PARTITION BY leaf_path ORDER BY item_count DESC, first_pos) <= 5) GROUP BY leaf_path) t ON t.leaf_path = l.path
        WHERE l.is_leaf AND l.depth > 0) GROUP BY 1""",
    *TV, ctes=ROWS,
)
check(
    "model_requests_values",
    """SELECT r.leaf_path, n // 20 AS batch_no, count(*) AS n_rows, any_value(s.schema_lines) AS schema_lines, string_agg(to_json({'item_id': id, 'title': title})::VARCHAR, chr(10) ORDER BY n) AS lines
       FROM (SELECT *, row_number() OVER (PARTITION BY leaf_path ORDER BY pos) - 1 AS n FROM routed WHERE NOT found) r
       JOIN (SELECT leaf_path, string_agg(to_json({'key': key, 'label': label, 'unit': coalesce(symbol, ''), 'value_type': vtype})::VARCHAR, chr(10) ORDER BY attr_seq) AS schema_lines
             FROM current GROUP BY leaf_path) s ON s.leaf_path = r.leaf_path GROUP BY 1, 2""",
    *XV, ctes=GOOD,
)
LEAF_ANSWERS = f"""{NODES},
ok AS (SELECT batch_no, doc_id, id, leaf_path, confidence FROM predictions WHERE lang <> 'es' AND confidence <= 1.0
    AND leaf_path IN (SELECT path FROM nodes WHERE is_leaf AND depth > 0 AND NOT is_catch_all)),
kept AS (SELECT id, arg_max(leaf_path, doc_id) AS leaf_path, arg_max(confidence, doc_id) AS confidence FROM ok WHERE confidence >= 0.9 GROUP BY id)"""
check("model_responses_leaf", "SELECT batch_no, id, leaf_path, confidence FROM ok", "predictions", "tree", ctes=LEAF_ANSWERS)
check(
    "model_batches",
    """SELECT p.batch_no, count(*) AS sent, count(*) FILTER (o.confidence >= 0.9) AS kept, count(*) FILTER (o.confidence < 0.9) AS low_confidence,
       count(*) FILTER (o.id IS NULL) AS missing FROM predictions p LEFT JOIN ok o ON o.id = p.id AND o.batch_no = p.batch_no GROUP BY 1""",
    "predictions", "tree", ctes=LEAF_ANSWERS,
)
check(
    "model_responses_pairs",
    """SELECT seq // 100 AS batch_no, w1, w2, category_slug, confidence, 'openai_llm' AS source FROM rules
       WHERE confidence >= 0.85 AND category_slug IN (SELECT slug FROM nodes WHERE depth = 1 AND NOT is_catch_all)""",
    "rules", "tree", ctes=NODES,
)
check(
    "model_merge",
    """SELECT i.id, k.leaf_path, split_part(k.leaf_path, '/', -1) AS leaf_slug, k.confidence, 'llm_1_4' AS source FROM items i JOIN kept k ON k.id = i.id
       WHERE i.id NOT IN (SELECT id FROM trig WHERE phase = 2)""",
    "items", "rules", "predictions", "tree", ctes=",\n".join([LEAF_ANSWERS, *STRICT]),
)
check(
    "model_unmatched",
    "SELECT id FROM items WHERE id NOT IN (SELECT id FROM trig WHERE phase = 2) AND id NOT IN (SELECT id FROM kept)",
    "items", "rules", "predictions", "tree", ctes=",\n".join([LEAF_ANSWERS, *STRICT]),
)

# ---------------------------------------------------------------- publishing
check(
    "first_store",
    """SELECT i.id, i.title, min(s.name) AS store_name FROM shop_items i JOIN store_items x ON x.items_id = i.id JOIN stores s ON s.id = x.store_id
       WHERE i.deleted_at IS NULL GROUP BY i.id, i.title""",
    "shop_items", "store_items", "stores",
)
check("live_categories", "SELECT id, parent_id, name, slug FROM shop_categories WHERE deleted_at IS NULL", "shop_categories")
PUB = f"""{NODES},
stored AS (SELECT substr(id, 3) AS path, id FROM shop_categories WHERE deleted_at IS NULL),
ids AS (SELECT n.path, coalesce(s.id, 'cat_' || left(sha256(n.path), 16)) AS id, s.id IS NULL AS fresh FROM nodes n LEFT JOIN stored s ON s.path = n.path),
linked AS (SELECT m.id AS item_id, m.leaf_path, i.id AS category_id FROM matched m JOIN shop_items s ON s.id = m.id AND s.deleted_at IS NULL LEFT JOIN ids i ON i.path = m.leaf_path),
new_links AS (SELECT DISTINCT item_id, category_id FROM linked WHERE category_id IS NOT NULL AND (item_id, category_id) NOT IN (SELECT (item_id, category_id) FROM shop_links)),
rejects AS (SELECT item_id, leaf_path FROM linked WHERE category_id IS NULL),
new_cats AS (SELECT i.id, n.display_name AS name, n.slug, p.id AS parent_id, n.depth FROM nodes n JOIN ids i ON i.path = n.path AND i.fresh LEFT JOIN ids p ON p.path = n.parent_path)"""
PV = ("tree", "shop_categories", "shop_items", "shop_links", "matched")
check("publish_categories", "SELECT * FROM new_cats", *PV, ctes=PUB)
check("publish_links", "SELECT * FROM new_links", *PV, ctes=PUB)
check("rejected_links", "SELECT * FROM rejects", *PV, ctes=PUB)
check(
    "publish_dry_run",
    "SELECT 'categories' AS sink, count(*) AS n_rows FROM new_cats UNION ALL SELECT 'links', count(*) FROM new_links UNION ALL SELECT 'rejected', count(*) FROM rejects",
    *PV, ctes=PUB,
)
ATTR = SCHEMA + """,
wide AS (SELECT *, split_part(leaf_path, '/', 1) || '/' || split_part(leaf_path, '/', 2) AS wide_path FROM current),
by_slug AS (SELECT slug, max(id) AS category_id FROM shop_categories WHERE deleted_at IS NULL GROUP BY slug),
new_attrs AS (SELECT DISTINCT b.category_id, w.key, w.label, w.vtype, w.symbol, w.wide_path FROM wide w JOIN by_slug b ON b.slug = split_part(w.wide_path, '/', -1))"""
check(
    "publish_units", "SELECT 'unit_' || left(sha256(symbol), 16) AS id, symbol, 'number' AS value_type FROM answered WHERE symbol IS NOT NULL GROUP BY symbol", *AV, ctes=SCHEMA
)
check(
    "publish_attributes",
    """SELECT 'attr_' || left(sha256(category_id || chr(1) || key), 16) AS id, category_id, key, label, '' AS description, vtype AS value_type,
       CASE WHEN symbol IS NOT NULL THEN 'unit_' || left(sha256(symbol), 16) END AS unit_id FROM new_attrs""",
    "attr_rows", "shop_categories", ctes=ATTR,
)
check(
    "attributes_without_category",
    "SELECT DISTINCT leaf_path FROM current WHERE split_part(leaf_path, '/', -1) NOT IN (SELECT slug FROM by_slug)",
    "attr_rows", "shop_categories", ctes=ATTR,
)
check(
    "publish_values",
    """SELECT DISTINCT v.item_id, 'attr_' || left(sha256(a.category_id || chr(1) || a.key), 16) AS attribute_id,
        CASE WHEN v.unit IS NOT NULL THEN 'unit_' || left(sha256(v.unit), 16) END AS attribute_unit_id, v.value
       FROM vals v JOIN new_attrs a ON a.key = v.attribute_key AND a.wide_path = split_part(v.leaf_path, '/', 1) || '/' || split_part(v.leaf_path, '/', 2)""",
    *XV, "shop_categories", ctes=f"{GOOD},\n" + ATTR[len(SCHEMA) + 2 :],
)
check(
    "skipped_values",
    """SELECT v.item_id, NULL::VARCHAR AS attribute_id, v.value, 'attribute' AS missing
       FROM vals v LEFT JOIN new_attrs a ON a.key = v.attribute_key AND a.wide_path = split_part(v.leaf_path, '/', 1) || '/' || split_part(v.leaf_path, '/', 2)
       WHERE a.key IS NULL""",
    *XV, "shop_categories", ctes=f"{GOOD},\n" + ATTR[len(SCHEMA) + 2 :],
)
check(
    "gap_report",
    """SELECT (SELECT count(*) FROM shop_items WHERE deleted_at IS NULL) AS total,
       (SELECT count(*) FROM shop_items i WHERE deleted_at IS NULL AND NOT EXISTS (SELECT 1 FROM shop_links l WHERE l.item_id = i.id AND l.deleted_at IS NULL)) AS uncategorized,
       (SELECT count(DISTINCT item_id) FROM shop_links l WHERE deleted_at IS NULL AND NOT EXISTS (SELECT 1 FROM shop_values v WHERE v.item_id = l.item_id AND v.deleted_at IS NULL)) AS missing_attrs""",
    "shop_items", "shop_links", "shop_values",
)
check("taxonomy_gaps", "SELECT slug FROM nodes EXCEPT SELECT slug FROM shop_categories WHERE deleted_at IS NULL", "tree", "shop_categories", ctes=NODES)

# ---------------------------------------------------------------- runs
NEWEST = "{'t': run_ts, 'r': run_id}"
check(
    "latest_run",
    f"""SELECT step, e AS env, coalesce(arg_max(run_id, {NEWEST}) FILTER (env = e), arg_max(run_id, {NEWEST})) AS run_id
       FROM runs, (VALUES ('prod'), ('dev'), ('staging')) t(e) GROUP BY step, e
       UNION ALL SELECT step, '', arg_max(run_id, {NEWEST}) FROM runs GROUP BY step""",
    "runs",
)
check("latest_run_of_source", f"SELECT step, source_run_id, arg_max(run_id, {NEWEST}) AS run_id FROM runs GROUP BY ALL", "runs")
check(
    "latest_run_pair",
    f"""SELECT source_run_id, first_run, second_run FROM (SELECT source_run_id, arg_max(run_id, {NEWEST}) FILTER (step = 'URGENT') AS first_run,
        arg_max(run_id, {NEWEST}) FILTER (step = 'HIGH') AS second_run, max(run_ts) AS ts FROM runs WHERE step IN ('URGENT', 'HIGH') GROUP BY source_run_id)
       WHERE first_run IS NOT NULL AND second_run IS NOT NULL ORDER BY ts DESC, source_run_id DESC LIMIT 1""",
    "runs",
)
check(
    "run_list",
    f"""SELECT r.run_id, env, run_ts, coalesce(n, 0) AS n_items, r.run_id = (SELECT arg_max(run_id, {NEWEST}) FROM runs) AS is_default
       FROM runs r LEFT JOIN (SELECT 'run_' || lpad(l_orderkey::VARCHAR, 12, '0') AS run_id, count(*) AS n FROM lineitem GROUP BY 1) c ON c.run_id = r.run_id""",
    "runs",
)
check("run_labels", "SELECT run_id, strftime(run_ts, '%Y%m%d_%H%M%S') || CASE WHEN env <> '' THEN '-' || env ELSE '' END AS label FROM runs", "runs")
check("run_taxonomy", "SELECT run_id, coalesce(taxonomy_version, 'categories_default') AS taxonomy_version FROM runs", "runs")

# ---------------------------------------------------------------- documents and previews
check(
    "match_document",
    """SELECT t.id, t.total_triggered_bigrams, t.max_confidence, (SELECT count(*) FROM ranked r WHERE r.pos = t.pos AND r.rank IS NOT NULL) AS n_categories,
       f.category_slug AS first_category, split_part(f.triggers, ':', 1) || ' ' || split_part(f.triggers, ':', 2) AS first_bigram
       FROM totals t LEFT JOIN ranked f ON f.pos = t.pos AND f.rank = 1""",
    "items", "rules", ctes=",\n".join([*CROSS, RANKED]),
)
check(
    "group_preview",
    "SELECT group_id, row_number() OVER (PARTITION BY group_id ORDER BY pos) AS rank, id FROM members QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY pos) <= 12",
    "items", ctes=GROUPS,
)
check("handover_items", "SELECT id, title, subtitle FROM items WHERE id NOT IN (SELECT id FROM assigned)", *GV, ctes=ASSIGNED)
check(
    "row_paths",
    """SELECT t.id, coalesce(nullif(trim(CASE WHEN p.confidence < 0.3 THEN ' ' WHEN p.confidence > 0.5 THEN p.leaf_path END), ''), t.top_category, '') AS path
       FROM totals t LEFT JOIN predictions p ON p.id = t.id""",
    "items", "rules", "predictions", ctes=",\n".join([*STRICT, RANKED]),
)
