"""DuckDB SQL that restates the registered queries, built from the same reference lists."""

from __future__ import annotations

from namekin import lists

WORD_JUNK = "[^a-zA-Z0-9 \\n\\t\\r]"

RECORDS = """SELECT CAST(o_orderkey AS VARCHAR) AS record_id, c_name AS raw_name,
    c_mktsegment AS market, o_orderdate AS as_of FROM orders JOIN customer ON o_custkey = c_custkey"""

SENTENCES = """SELECT record_id, raw_name, market FROM (
    SELECT CAST(doc_id AS VARCHAR) AS record_id, lang AS market,
        trim(unnest(string_split_regex(text, '[\\n.]'))) AS raw_name FROM documents)
    WHERE raw_name <> ''"""

WORDS = f"""SELECT market, word FROM (
    SELECT lang AS market, unnest(string_split_regex(
        lower(regexp_replace(text, '{WORD_JUNK}', '', 'g')), '[ \\n\\t\\r]+')) AS word FROM documents)
    WHERE word <> ''"""

WORD_NAMES = f"SELECT word AS name, market, count(*) AS freq FROM ({WORDS}) GROUP BY ALL"


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def clean(source: str, raw: str = "raw_name", keep: str = "record_id, raw_name, market") -> str:
    """``keep`` columns and the cleaned name of every row of ``source``."""
    return f"""SELECT {keep}, coalesce({_map(lists.NAME_ALIASES)}[s8], s8) AS name_clean FROM (
      SELECT *, coalesce(array_to_string(list_transform(s7,
          lambda t: coalesce({_map(lists.TOKEN_EXPANSIONS)}[t], t)), ' '), '') AS s8 FROM (
      SELECT *, list_filter(string_split(lower(s5), ' '),
          lambda t: t <> '' AND NOT list_contains({_list(lists.STOP_TOKENS)}, t)) AS s7 FROM (
      SELECT *, coalesce({_map(lists.NUMBER_ALIASES)}[s4], s4) AS s5 FROM (
      SELECT *, replace(replace(replace(regexp_replace(s2, '^\\s*$', ''),
          '  ', ' '), '   ', ' '), '    ', ' ') AS s4 FROM (
      SELECT *, regexp_replace(split_part({raw}, '/', 1), '[^a-zA-Z0-9 ]', '', 'g') AS s2
      FROM ({source}))))))"""


def vocabulary(source: str, name: str) -> str:
    return f"""SELECT word, count(*) AS counts FROM (
        SELECT unnest(string_split({name}, ' ')) AS word FROM ({source})) WHERE word <> '' GROUP BY word"""


def standard_score(a: str, b: str) -> str:
    return f"""CASE WHEN {a} = '' OR {b} = '' THEN 0
        WHEN least(length({a}), length({b})) > 3 THEN jaro_winkler_similarity({a}, {b})
        ELSE jaro_similarity({a}, {b}) END"""


def spelling(vocab: str, minimum: int = 100) -> str:
    score = standard_score("f.word", "i.word")
    return f"""SELECT old_word, new_word, score FROM (
        SELECT i.word AS old_word, f.word AS new_word, {score} AS score, f.counts AS counts
        FROM {vocab} f JOIN {vocab} i ON substr(f.word, 1, 3) = substr(i.word, 1, 3)
        WHERE f.counts >= {minimum} AND i.counts < {minimum})
        WHERE round(score, 9) >= 0.95
        QUALIFY row_number() OVER (
            PARTITION BY old_word ORDER BY round(score, 9) DESC, counts DESC, new_word) = 1"""


def corrected(names: str, table: str) -> str:
    """Distinct ``name_clean`` of ``names`` with ``name_corrected``."""
    return f"""SELECT name_clean, string_agg(coalesce(new_word, word), ' ' ORDER BY spot) AS name_corrected
        FROM (SELECT name_clean, unnest(string_split(name_clean, ' ')) AS word,
                  generate_subscripts(string_split(name_clean, ' '), 1) AS spot
              FROM (SELECT DISTINCT name_clean FROM {names}))
        LEFT JOIN {table} ON old_word = word GROUP BY name_clean"""


def positions(names: str) -> str:
    return f"""SELECT market, name, freq,
        row_number() OVER (PARTITION BY market ORDER BY name) - 1 AS pos,
        count(*) OVER (PARTITION BY market) AS n FROM {names} WHERE name <> ''"""


def frames(pos: str, rng: int) -> str:
    return f"""SELECT a.market, a.pos, a.n, a.name, a.freq,
        c.pos AS other_pos, c.name AS other_name, c.freq AS other_freq
        FROM (SELECT *, pos + unnest(range(-{rng}, {rng} + 1)) AS want FROM {pos}) a
        JOIN {pos} c ON c.market = a.market AND c.pos = a.want WHERE c.pos <> a.pos"""


def best(frame: str, rng: int, threshold: float, score: str, edge: str = "skip") -> str:
    inside = f"pos BETWEEN {rng} AND n - {rng} - 2" if edge == "skip" else "true"
    return f"""SELECT market, pos, name, freq, arg_max(other_pos, other_freq) AS target_pos,
        arg_max(other_name, other_freq) AS target_name, max(other_freq) AS target_freq
        FROM (SELECT * FROM (SELECT *,
            row_number() OVER (PARTITION BY market, pos, other_freq ORDER BY other_pos) AS nth,
            rank() OVER (PARTITION BY market, pos ORDER BY other_freq DESC) AS place
            FROM {frame} WHERE {inside})
        WHERE nth = 1 AND place <= {rng} AND other_freq > freq)
        WHERE round({score}, 9) >= {threshold} GROUP BY ALL"""


def parents_ctes(names: str, rng=20, threshold=0.90, edge="skip", score=None) -> str:
    """CTEs ``pos, frame, best, chain, parents``; needs WITH RECURSIVE."""
    score = score or standard_score("name", "other_name")
    return f"""pos AS ({positions(names)}),
      frame AS ({frames("pos", rng)}),
      best AS ({best("frame", rng, threshold, score, edge)}),
      chain(market, pos, target_pos, target_name, hop, ended) AS (
        SELECT market, pos, target_pos, target_name, 1, target_pos > pos FROM best
        UNION ALL
        SELECT c.market, c.pos, b.target_pos, b.target_name, c.hop + 1, b.target_pos > b.pos
        FROM chain c JOIN best b ON b.market = c.market AND b.pos = c.target_pos WHERE NOT c.ended),
      parents AS (
        SELECT n.name, n.market, n.freq, coalesce(l.target_name, n.name) AS parent_name
        FROM {names} n
        LEFT JOIN pos p ON p.market = n.market AND p.name = n.name
        LEFT JOIN (SELECT market, pos, arg_max(target_name, hop) AS target_name
                   FROM chain GROUP BY ALL) l ON l.market = p.market AND l.pos = p.pos)"""


def matched_ctes(source: str) -> str:
    """The whole job as CTEs; ``final`` is keyed by name and market."""
    return f"""cleaned AS ({clean(source)}),
      vocab AS ({vocabulary("SELECT * FROM cleaned", "name_clean")}),
      fixes AS ({spelling("vocab")}),
      renamed AS ({corrected("cleaned", "fixes")}),
      rows AS (SELECT record_id, raw_name, market, name_corrected AS name_clean
               FROM cleaned JOIN renamed USING (name_clean)),
      names AS (SELECT name_clean AS name, market, count(*) AS freq FROM rows GROUP BY ALL),
      {parents_ctes("names")},
      final AS (SELECT DISTINCT record_id, raw_name, r.name_clean, parent_name, r.market, 1 AS score
                FROM rows r JOIN parents p ON p.name = r.name_clean AND p.market = r.market),
      final_by_name AS (
                SELECT DISTINCT record_id, raw_name, r.name_clean, parent_name, r.market, 1 AS score
                FROM rows r JOIN parents p ON p.name = r.name_clean)"""


def bands(names: str, column: str) -> str:
    counted = f"(SELECT {column}, count(*) AS freq FROM {names} GROUP BY ALL)"
    rows = [(">=1000", "freq >= 1000"), (">=100", "freq >= 100"), (">=10", "freq >= 10"), ("<10", "freq < 10")]
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS band, count(*) AS names,
        CAST(coalesce(sum(freq), 0) AS BIGINT) AS total_freq FROM {counted} WHERE {test}"""
        for label, test in rows
    )


def detailed_score(pairs: str, a: str, b: str, variant: str) -> str:
    """``pairs`` with ``score`` worked out match by match, for the variants DuckDB has no function for."""
    matching = f"""list_reduce(
        list_transform(range(length({a})), lambda i: {{'i': i, 'l': []::BIGINT[], 'r': []::BIGINT[]}}),
        lambda acc, x: list_transform(
            [list_filter(range(greatest(0, x.i - reach), least(length({b}), x.i + reach + 1)),
                lambda j: {b}[j + 1] = {a}[x.i + 1] AND NOT list_contains(acc.r, j))[1]],
            lambda j: CASE WHEN j IS NULL THEN acc ELSE
                {{'i': x.i, 'l': list_append(acc.l, x.i), 'r': list_append(acc.r, j)}} END)[1],
        {{'i': -1::BIGINT, 'l': []::BIGINT[], 'r': []::BIGINT[]}})"""
    base = f"""SELECT *, CASE WHEN m = 0 THEN 0 ELSE
            (m / length({a}) + m / length({b}) + (m - t) / m) / 3.0 END AS jaro FROM (
        SELECT *, CAST(len(wrong) AS DOUBLE) AS n_wrong, CAST(len(at_left) AS DOUBLE) AS m,
            {"coalesce(list_sum(list_transform(wrong, lambda i: power(0.5, length(" + a + ") - i))), 0)"
             if variant == "notebook" else "CAST(len(wrong) // 2 AS DOUBLE)"} AS t FROM (
        SELECT *, list_transform(list_filter(list_zip(at_left, at_right),
            lambda z: {a}[z[1] + 1] <> {b}[z[2] + 1]), lambda z: z[1]) AS wrong FROM (
        SELECT *, found.l AS at_left, list_sort(found.r) AS at_right FROM (
        SELECT *, {matching} AS found FROM (
        SELECT *, greatest(greatest(length({a}), length({b})) // 2 - 1, 0) AS reach,
            CASE WHEN {a}[1] <> {b}[1] THEN 0 WHEN {a}[1:2] <> {b}[1:2] THEN 1
                WHEN {a}[1:3] <> {b}[1:3] THEN 2 WHEN {a}[1:4] <> {b}[1:4] THEN 3 ELSE 4 END AS first4,
            least(first4, length({a}), length({b})) AS p,
            greatest(length({a}), length({b})) AS longest
        FROM ({pairs}))))))"""
    if variant == "notebook":
        score = f"CASE WHEN {a} = {b} THEN 1 ELSE jaro + 0.1 * p * (1 - jaro) END"
    else:
        score = f"""CASE WHEN NOT (jaro > 0.7 AND length({a}) > 3 AND length({b}) > 3) THEN jaro
            WHEN longest > 4 AND m > p + 1 AND 2 * m >= longest + p
            THEN jw + (1 - jw) * (m - p - 1) / (length({a}) + length({b}) - 2 * p + 2) ELSE jw END"""
        base = f"SELECT *, jaro + 0.1 * p * (1 - jaro) AS jw FROM ({base})"
    return f"SELECT *, {score} AS score FROM ({base})"
