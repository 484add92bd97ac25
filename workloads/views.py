"""Catalog views over the given tables; one SQL text serves Spark and the DuckDB check.

Items come from all parts and all documents, the category tree from parts, regions, nations and
suppliers, the decision log from events. ``{name}`` stands for a table or an earlier view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()

VIEWS: dict[str, str] = {
    # every part and every document as an item; the rest of a document is its subtitle
    "items": """
        SELECT 'itm_' || lpad(CAST(p_partkey AS STRING), 12, '0') AS id,
               p_name || ' ' || CAST(p_size AS STRING) || '/16" ' || p_brand AS title,
               lower(p_type) || ' ' || p_name AS subtitle,
               CAST(p_partkey * 2 AS BIGINT) AS pos
        FROM {part}
        UNION ALL
        SELECT 'doc_' || CAST(doc_id AS STRING) AS id,
               split_part(text, chr(10), 1) AS title,
               substr(text, length(split_part(text, chr(10), 1)) + 2) AS subtitle,
               CAST(doc_id * 2 + 1 AS BIGINT) AS pos
        FROM {documents}""",
    # raw rows as a catalog file has them: id or item_id, some without any
    "raw_items": """
        SELECT 'itm_' || CAST(p_partkey AS STRING) AS id, CAST(NULL AS STRING) AS item_id,
               p_name AS title, CASE WHEN p_size > 10 THEN p_type END AS subtitle, CAST(p_partkey * 3 AS BIGINT) AS pos
        FROM {part}
        UNION ALL
        SELECT CASE WHEN lang = 'en' THEN '' END, CASE WHEN lang = 'de' THEN '' ELSE 'doc_' || CAST(doc_id AS STRING) END,
               split_part(text, chr(10), 1), text, CAST(doc_id * 3 + 1 AS BIGINT)
        FROM {documents}
        UNION ALL
        SELECT CAST(NULL AS STRING), CASE WHEN s_acctbal > 0 THEN s_name END, CAST(NULL AS STRING), s_name,
               CAST(s_suppkey * 3 + 2 AS BIGINT)
        FROM {supplier}""",
    "part_words": """
        SELECT p_partkey, p_size, p_brand, lower(p_type) AS kind,
               split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun,
               CASE WHEN split_part(p_name, ' ', 2) IN ('bolt', 'ring', 'rod', 'plate')
                    THEN 'materials' ELSE 'tools_and_gear' END AS root
        FROM {part}""",
    "part_leaf": """
        SELECT p_partkey, root || '/' || noun || '/' || adj || '_' || noun || '/' || kind AS leaf_path
        FROM {part_words}""",
    # adjacency rows of the category tree
    "tree": """
        SELECT 'materials' AS node_key, CAST(NULL AS STRING) AS parent_key, 'materials' AS slug,
               'Materials' AS display_name, '0' AS sib
        UNION ALL SELECT 'tools_and_gear', NULL, 'tools_and_gear', 'Tools & Gear', '1'
        UNION ALL SELECT 'services', NULL, 'services', 'Services', '2'
        UNION ALL SELECT 'materials/miscellaneous', 'materials', 'miscellaneous', 'Miscellaneous', '~'
        UNION ALL SELECT 'services/crafts', 'services', 'crafts', 'Pièces à façon', 'crafts'
        UNION ALL
        SELECT DISTINCT root || '/' || noun, root, noun, upper(substr(noun, 1, 1)) || substr(noun, 2) || 's', noun
        FROM {part_words}
        UNION ALL
        SELECT DISTINCT root || '/' || noun || '/other', root || '/' || noun, 'other', 'Other ' || noun, '~'
        FROM {part_words}
        UNION ALL
        SELECT DISTINCT root || '/' || noun || '/' || adj || '_' || noun, root || '/' || noun, adj || '_' || noun,
               upper(substr(adj, 1, 1)) || substr(adj, 2) || ' ' || noun, adj
        FROM {part_words}
        UNION ALL
        SELECT DISTINCT root || '/' || noun || '/' || adj || '_' || noun || '/' || kind, root || '/' || noun || '/' || adj || '_' || noun,
               kind, kind || ' grade', kind
        FROM {part_words}
        UNION ALL
        SELECT DISTINCT 'services/' || replace(lower(r_name), ' ', '_'), 'services', replace(lower(r_name), ' ', '_'), r_name,
               replace(lower(r_name), ' ', '_')
        FROM {region}
        UNION ALL
        SELECT 'services/' || replace(lower(r_name), ' ', '_') || '/' || lower(n_name), 'services/' || replace(lower(r_name), ' ', '_'),
               lower(n_name), n_name, lower(n_name)
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT 'services/' || replace(lower(r_name), ' ', '_') || '/' || lower(n_name) || '/' || replace(lower(s_name), '#', '_'),
               'services/' || replace(lower(r_name), ' ', '_') || '/' || lower(n_name), replace(lower(s_name), '#', '_'), s_name,
               replace(lower(s_name), '#', '_')
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # word-pair rules: two part words each, and the first two words of every document
    "doc_words": """
        SELECT doc_id, lang, regexp_extract(text, '^[^A-Za-z]*([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 1) AS f1,
               regexp_extract(text, '^[^A-Za-z]*([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 2) AS f2
        FROM {documents}""",
    "rules": """
        SELECT 2 AS depth, 'title' AS side, adj AS w1, noun AS w2, adj || '_' || noun AS category_slug,
               CASE WHEN length(noun) = 4 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.85 AS DOUBLE) END AS confidence,
               'fixture' AS source, CAST(min(p_partkey) AS BIGINT) AS seq
        FROM {part_words} GROUP BY adj, noun
        UNION ALL
        SELECT 2, 'title', noun, adj, noun, CAST(0.7 AS DOUBLE), 'fixture', CAST(10000000000 + min(p_partkey) AS BIGINT)
        FROM {part_words} WHERE adj IN ('small', 'red') GROUP BY adj, noun
        UNION ALL
        SELECT 1, 'subtitle', kind, noun, noun, CAST(0.85 AS DOUBLE), 'fixture', CAST(20000000000 + min(p_partkey) AS BIGINT)
        FROM {part_words} WHERE kind <> 'promo' GROUP BY kind, noun
        UNION ALL
        SELECT CASE WHEN lang = 'es' THEN NULL ELSE 1 END, 'title', lower(f1), lower(f2),
               CASE lang WHEN 'en' THEN 'america' WHEN 'de' THEN 'other' WHEN 'fr' THEN 'europe' ELSE 'nowhere' END,
               CAST(0.9 AS DOUBLE), 'fixture', CAST(30000000000 + doc_id AS BIGINT)
        FROM {doc_words} WHERE f1 <> ''
        UNION ALL
        SELECT 2, 'subtitle', lower(f2), lower(f1), 'nation_1', CAST(0.95 AS DOUBLE), 'fixture', CAST(40000000000 + doc_id AS BIGINT)
        FROM {doc_words} WHERE f1 <> '' AND lang = 'en'""",
    # decision log: one entry per event, on the group or pair numbered by the user
    "decision_log": """
        SELECT 'g_' || lpad(CAST(user_id AS STRING), 6, '0') AS key, user_id AS no,
               CASE event_type WHEN 'error' THEN 'unknown' WHEN 'click' THEN 'cleared' ELSE 'assign' END AS kind,
               leaf_path, ts AS decided_at, event_id AS seq
        FROM {events} JOIN {part_leaf} ON CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) = p_partkey""",
    # decisions on word pairs, by the rank of the pair
    "pair_log": """
        SELECT CAST(user_id + 1 AS BIGINT) AS rank, CASE event_type WHEN 'error' THEN 'unknown' WHEN 'click' THEN 'cleared' ELSE 'assign' END AS kind,
               leaf_path, ts AS decided_at, event_id AS seq
        FROM {events} JOIN {part_leaf} ON CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) = p_partkey""",
    # what a leaf model answered for each document
    "predictions": """
        SELECT CAST(floor(doc_id / 25) AS BIGINT) AS batch_no, doc_id, 'doc_' || CAST(doc_id AS STRING) AS id, lang,
               CASE WHEN lang = 'fr' AND n_chars % 12 = 10 THEN 'no/such/leaf' ELSE coalesce(leaf_path, 'no/such/leaf') END AS leaf_path,
               CAST(n_chars % 12 AS DOUBLE) / 10 AS confidence
        FROM {documents} LEFT JOIN {part_leaf} ON doc_id = p_partkey""",
    # final rows: parts on their own leaf, documents on the predicted one
    "matched": """
        SELECT i.pos, i.id, i.title, i.subtitle, l.leaf_path, CAST(NULL AS STRING) AS leaf_slug
        FROM {items} i JOIN {part_leaf} l ON i.id = 'itm_' || lpad(CAST(l.p_partkey AS STRING), 12, '0')
        UNION ALL
        SELECT i.pos, i.id, i.title, i.subtitle, p.leaf_path, ''
        FROM {items} i JOIN {predictions} p ON i.id = p.id""",
    # attribute definitions a model proposed, in answer order; promo leaves are answered twice
    "attr_defs": """
        SELECT DISTINCT root || '/' || noun || '/' || adj || '_' || noun || '/' || kind AS leaf_path, adj || ' ' || noun || ' {{FRAC}}" Brand#{{NUM}}' AS template,
               0 AS round, kind FROM {part_words}
        UNION ALL
        SELECT DISTINCT root || '/' || noun || '/' || adj || '_' || noun || '/' || kind, adj || ' ' || noun || ' {{FRAC}}" Brand#{{NUM}}', 1, kind
        FROM {part_words} WHERE kind = 'promo'""",
    "attr_rows": """
        SELECT leaf_path, template, round, 0 AS attr_seq, 'size' AS key, 'Size' AS label, 'number' AS vtype,
               '(?P<val>[0-9]+/16")' AS regex, 'measurement_inches' AS hint, 'in' AS symbol FROM {attr_defs}
        UNION ALL
        SELECT leaf_path, template, round, 1, 'brand', 'Brand', 'text', '(?P<val>Brand#[0-9]+)', 'text_lower', NULL FROM {attr_defs} WHERE round = 0
        UNION ALL
        SELECT leaf_path, template, round, 2, 'finish', 'Finish', 'text', '(?P<val>zinc)', 'text_raw', NULL FROM {attr_defs} WHERE round = 0
        UNION ALL
        SELECT leaf_path, template, round, 3, 'broken', 'Broken', 'text', '(?P<val>[', 'text_raw', NULL FROM {attr_defs} WHERE round = 0""",
    # fallback answers of a value model, one per order line
    "value_answers": """
        SELECT 'itm_' || lpad(CAST(l_partkey AS STRING), 12, '0') AS item_id, leaf_path, l_returnflag AS attribute_key,
               CASE WHEN l_discount = 0.1 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS value,
               CASE WHEN l_tax < 0.02 THEN 'high' WHEN l_tax < 0.04 THEN ' Medium ' WHEN l_tax < 0.06 THEN 'llm_low' WHEN l_tax < 0.07 THEN 'none' ELSE 'true' END AS conf,
               l_orderkey, l_linenumber
        FROM {lineitem} JOIN {part_leaf} ON l_partkey = p_partkey""",
    # marketplace tables
    "shop_items": """
        SELECT id, title, subtitle, CASE WHEN length(title) > 300 OR title LIKE '%13/16%' THEN 'x' END AS deleted_at FROM {items}""",
    "shop_categories": """
        SELECT 'c:' || node_key AS id, 'c:' || parent_key AS parent_id, display_name AS name, slug,
               CASE WHEN slug = 'crafts' THEN 'x' END AS deleted_at
        FROM {tree} WHERE length(node_key) - length(replace(node_key, '/', '')) < 2 OR node_key LIKE 'services/%'""",
    "shop_links": """
        SELECT 'itm_' || lpad(CAST(p_partkey AS STRING), 12, '0') AS item_id, 'c:' || root || '/' || noun AS category_id,
               CASE WHEN p_size = 7 THEN 'x' END AS deleted_at
        FROM {part_words} WHERE p_size < 20""",
    "shop_values": """
        SELECT DISTINCT 'itm_' || lpad(CAST(l_partkey AS STRING), 12, '0') AS item_id, l_returnflag AS attribute_id, CAST(CAST(l_quantity AS INT) AS STRING) AS value,
               CASE WHEN l_linestatus = 'F' THEN 'x' END AS deleted_at
        FROM {lineitem} WHERE l_tax < 0.01 AND l_quantity < 20""",
    # a run registry: every order is a run
    "runs": """
        SELECT 'run_' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS run_id,
               CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'dev' ELSE '' END AS env,
               o_orderdate AS run_ts, 'src_' || CAST(o_custkey AS STRING) AS source_run_id,
               substr(o_orderpriority, 3) AS step, CASE WHEN o_orderstatus = 'F' THEN 'tax_' || CAST(o_custkey AS STRING) END AS taxonomy_version
        FROM {orders}""",
    "stores": "SELECT s_suppkey AS id, s_name AS name FROM {supplier}",
    "store_items": "SELECT DISTINCT 'itm_' || lpad(CAST(l_partkey AS STRING), 12, '0') AS items_id, l_suppkey AS store_id FROM {lineitem}",
}


def needs(name: str) -> list[str]:
    """Views and tables a view is built from."""
    text = VIEWS[name]
    return [n for n in [*TABLES, *VIEWS] if "{" + n + "}" in text]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a view over the given tables."""
    if name not in VIEWS:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        tasks = spark.sparkContext.defaultParallelism
        if name == "documents" and table.rdd.getNumPartitions() < tasks:
            # one row group of long texts would keep all but one core idle; large tables skip this
            table = table.repartition(tasks, "doc_id")
        return table
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in needs(name)})


def with_clause(*names: str) -> str:
    """DuckDB CTEs for the named views and all they need, in order."""
    wanted: set[str] = set()

    def add(n: str) -> None:
        for m in needs(n):
            if m in VIEWS and m not in wanted:
                add(m)
        wanted.add(n)

    for n in names:
        add(n)
    bodies = []
    for n in VIEWS:
        if n in wanted:
            body = VIEWS[n].replace("{{", "{").replace("}}", "}")
            for m in [*TABLES, *VIEWS]:
                body = body.replace("{" + m + "}", m)
            bodies.append(f"{n} AS ({body})")
    return ",\n".join(bodies)
