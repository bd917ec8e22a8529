"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from namekin.llm import (
    decontaminate, html_extract, license_scan, near_dedup, packing, piece_scan, prefix_trie, quality_model,
    quality_rules, ranked_search, substring_dedup, token_counts, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    rows = quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "failed_rules", "kept",
    )


def op2_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.fit(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"), "n_segments",
    )


def op4_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_scan.encode(docs)
    decoded = piece_scan.decode(encoded)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("text_sha256"),
    )


def op5_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_decontamination(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_token_counts(spark, sf_dir):
    return token_counts.length_table(token_counts.histogram(table(spark, sf_dir, "documents")))


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark, sf_dir):
    held_out = F.coalesce(quality_model.fold(F.col("doc_id")) == quality_model.HELD_OUT, F.lit(False))
    rows = quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    predicted = F.when(F.col("score") >= quality_model.THRESHOLD, 1).otherwise(0)
    return rows.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op13_conversation_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_html_extraction": op2_html_extraction,
        "op3_toxicity": op3_toxicity,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_near_dedup": op5_near_dedup,
        "op6_packing": op6_packing,
        "op7_license_scan": op7_license_scan,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_token_counts": op10_token_counts,
        "op11_ranked_search": op11_ranked_search,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_conversation_trie": op13_conversation_trie,
    }


SPACE = "[\\x20\\x09-\\x0D]+"
OUTSIDE = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _spaced(text: str = "text") -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{SPACE}'), lambda w: w <> '')"


def _plain(text: str = "text") -> str:
    lowered = (f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return f"list_filter(regexp_split_to_array({lowered}, '{OUTSIDE}'), lambda w: w <> '')"


def _rule_sql(rule: quality_rules.Rule) -> str:
    part, of = quality_rules.MEASURES[rule.measure]
    value = f"CASE WHEN {of} > 0 THEN {part} / {of} ELSE 0 END"
    tests = [f"{value} < {rule.low}"] * (rule.low is not None) + [f"{value} > {rule.high}"] * (rule.high is not None)
    return f"CASE WHEN ({' OR '.join(tests)}) AND n_words >= {rule.min_words} THEN '{rule.name}' END"


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    rules = ", ".join(_rule_sql(r) for r in quality_rules.RULES)
    return f"""
    WITH body AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_spaced()} AS w FROM documents),
    placed AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM body),
    grams AS (SELECT rid, pos, word || chr(10) || lead(word, 1) OVER o || chr(10) || lead(word, 2) OVER o || chr(10)
        || lead(word, 3) OVER o || chr(10) || lead(word, 4) OVER o AS gram
        FROM placed WINDOW o AS (PARTITION BY rid ORDER BY pos)),
    twice AS (SELECT rid, pos FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams WHERE gram IS NOT NULL) WHERE n > 1),
    covered AS (SELECT rid, count(DISTINCT pos + k) AS n FROM twice, range(5) AS r(k) GROUP BY rid),
    counted AS (SELECT rid, doc_id, t, len(w) AS n_words,
        length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_upper,
        len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
        list_filter(string_split(t, chr(10)), lambda l: regexp_replace(l, '{SPACE}', '', 'g') <> '') AS lines FROM body),
    measured AS (SELECT c.* EXCLUDE (lines), len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(v.n, 0) AS n_repeat_words FROM counted c LEFT JOIN covered v USING (rid)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        concat_ws(',', {rules}) AS failed_rules FROM measured)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
        CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, failed_rules,
        NOT base_failed AND failed_rules = '' AS kept FROM judged"""


def _contamination_sql() -> str:
    size = decontaminate.WINDOW
    return f"""
    WITH items AS (SELECT item_id, {_plain()} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, len AS n, array_to_string(w[s + 1 : s + len], ' ') AS gram FROM (
        SELECT item_id, w, least(len(w), {size}) AS len, unnest(range(greatest(len(w) - {size} + 1, 1))) AS s
        FROM items WHERE len(w) > 0)),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, {_plain()} AS w FROM documents),
    grams AS (SELECT rid, s, n, array_to_string(w[s + 1 : s + n], ' ') AS gram FROM (
        SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS s FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT rid, s, g.n, item_id FROM grams g JOIN windows v ON g.n = v.n AND g.gram = v.gram),
    places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
    ids AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(joined, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN places USING (rid) LEFT JOIN ids USING (rid)"""


def _near_sql() -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH RECURSIVE docs AS (SELECT doc_id, {_spaced(lowered)} AS w FROM documents),
    sets AS (SELECT DISTINCT doc_id, gram FROM (
        SELECT doc_id, array_to_string(w[s + 1 : s + 2], ' ') AS gram FROM (
            SELECT doc_id, w, unnest(range(greatest(len(w) - 1, 1))) AS s FROM docs WHERE len(w) > 0))),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM sets a JOIN sets b
        ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(node, low) AS (SELECT doc_id, doc_id FROM docs
        UNION SELECT y, low FROM reach JOIN ways ON x = node WHERE low < y),
    final AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM docs JOIN final ON node = doc_id LEFT JOIN sizes USING (doc_id)"""


def _repeats_sql() -> str:
    run = substring_dedup.RUN
    return f"""
    WITH docs AS (SELECT doc_id, {_spaced()} AS w FROM documents),
    grams AS (SELECT doc_id, s, array_to_string(w[s + 1 : s + {run}], ' ') AS gram FROM (
        SELECT doc_id, w, unnest(range(len(w) - {run - 1})) AS s FROM docs WHERE len(w) >= {run})),
    later AS (SELECT doc_id, s FROM (
        SELECT *, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS nth FROM grams) WHERE nth > 1),
    gone AS (SELECT DISTINCT doc_id, s + k AS pos FROM later, range({run}) AS r(k)),
    placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs),
    left_over AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS kept, count(*) AS n
        FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN left_over USING (doc_id)"""


def _search_sql() -> str:
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_plain()} AS w FROM documents),
    corpus AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs),
    asked AS (SELECT row_number() OVER () AS qid, item_id, {_plain()} AS w FROM benchmark),
    wanted AS (SELECT qid, item_id, term, count(*) AS n FROM (SELECT qid, item_id, unnest(w) AS term FROM asked) GROUP BY ALL),
    freq AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM docs)
        WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
        FROM (SELECT term, count(*) AS df FROM freq GROUP BY term), corpus),
    sizes AS (SELECT rid, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM docs, corpus WHERE len(w) > 0),
    scores AS (SELECT qid, item_id, rid, doc_id,
        CAST(sum(n * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
        FROM wanted JOIN weights USING (term) JOIN freq USING (term) JOIN sizes USING (rid) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS nth
        FROM scores WHERE score > 0)
    SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= {ranked_search.TOP}"""


def _trie_sql() -> str:
    content = "md5(CAST(length(r) AS VARCHAR) || ':' || r || t)"
    return f"""
    WITH named AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT conv_id, {content} AS what, length(t) AS points,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {content}) AS pos FROM named),
    ids AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS lead FROM placed GROUP BY conv_id),
    crc AS (SELECT conv_id, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM ids),
    about AS (SELECT i.conv_id, i.lead, h, least(h, coalesce(b.n, 0)) AS taken FROM ids i JOIN crc USING (conv_id)
        LEFT JOIN ids b ON b.conv_id = i.lead),
    turns AS (SELECT a.conv_id, p.pos AS d, what, points FROM about a JOIN placed p ON p.conv_id = a.lead AND p.pos <= a.taken
        UNION ALL SELECT a.conv_id, p.pos - h + taken, what, points FROM about a JOIN placed p ON p.conv_id = a.conv_id AND p.pos > h),
    lengths AS (SELECT a.conv_id, count(t.d) AS len FROM about a LEFT JOIN turns t USING (conv_id) GROUP BY a.conv_id),
    steps AS (SELECT conv_id, d, points, string_agg(what, '/') OVER (PARTITION BY conv_id ORDER BY d) AS node FROM turns
        UNION ALL SELECT conv_id, 0, 0, '' FROM about),
    nodes AS (SELECT node, d, min(conv_id) AS own, count(*) AS n_convs, max(points) AS points,
        string_agg(CASE WHEN d = len THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
        FROM steps JOIN lengths USING (conv_id) GROUP BY node, d),
    parents AS (SELECT n.node, p.node AS parent, p.own AS parent_own FROM nodes n JOIN steps s ON s.conv_id = n.own AND s.d = n.d - 1
        JOIN nodes p ON p.node = s.node AND p.d = s.d),
    children AS (SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent),
    filled AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)),
    sums AS (SELECT s.node, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.points) AS saved
        FROM filled u JOIN steps s ON s.conv_id = u.own AND s.d <= u.d GROUP BY s.node)
    SELECT own AS conv_id, CAST(d AS BIGINT) AS depth, parent_own AS parent_conv_id, n_convs, n_children,
        CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
    FROM filled JOIN sums USING (node) LEFT JOIN parents USING (node)"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    step = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    eight = "list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, y: " + step + ")"
    codes = f"[CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {eight}), 4294967295)"


def oracle_sql() -> dict[str, str]:
    return {
        "op5_near_dedup": _near_sql(),
        "op8_substring_dedup": _repeats_sql(),
        "op1_quality_rules": _quality_sql(),
        "op9_decontamination": _contamination_sql(),
        "op11_ranked_search": _search_sql(),
        "op13_conversation_trie": _trie_sql(),
    }
