"""Registered queries over the given tables, and the SQL each must agree with."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracles as sql  # noqa: E402
from namekin.functions import text  # noqa: E402
from namekin.functions.similarity import Similarity  # noqa: E402
from namekin.operators import attach, blocking, cleaning, moving_window, parents, spelling, vocabulary  # noqa: E402
from namekin.operators.positions import neighbour_frames, with_positions  # noqa: E402
from namekin.plans.matching import Settings, match_parents  # noqa: E402
from namekin.sources import tables  # noqa: E402
from namekin.sources.scratch import scratch_path, written  # noqa: E402

HERE = os.path.dirname(os.path.abspath(__file__))
corpus = corpus_pipeline = None
# The corpus operators may be left out of an installation; if they are there, they must import.
if all(os.path.exists(os.path.join(HERE, *p.split("/"))) for p in ("corpus_pipeline.py", "namekin/llm/queries.py")):
    import corpus_pipeline  # noqa: E402
    from namekin.llm import queries as corpus  # noqa: E402

DAY = "2001-08-01"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NOTEBOOK = Similarity(variant="notebook")


# Inputs: records, sentences and words derived from the given tables.

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


ACCOUNT_COLUMNS = {
    "record_id": "o_orderkey", "raw_name": "c_name", "market": "c_mktsegment", "as_of": "o_orderdate",
}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read_records(accounts(spark, sf_dir), ACCOUNT_COLUMNS)
    return rows.withColumn("record_id", F.col("record_id").cast("string"))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut at line ends and full stops; a sentence serves as a name of several words."""
    pieces = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.explode(F.split("text", "[\n.]")).alias("raw_name"),
        F.col("lang").alias("market"),
    )
    return pieces.withColumn("raw_name", F.trim("raw_name")).filter(F.col("raw_name") != "")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.lower(F.regexp_replace("text", "[^a-zA-Z0-9 \n\t\r]", ""))
    found = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("market"), F.explode(F.split(plain, "[ \n\t\r]+")).alias("word")
    )
    return found.filter(F.col("word") != "")


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.build_vocabulary(words(spark, sf_dir), "word")


def record_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.name_frequency(cleaning.clean_names(records(spark, sf_dir)))


def word_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.name_frequency(words(spark, sf_dir), "word")


def close_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the three words after it in name order, per market."""
    placed = parents.sorted_names(word_names(spark, sf_dir))
    near = neighbour_frames(placed, ["market"], ["name"], 3)
    pairs = near.select("market", F.col("name").alias("left_word"), "pos", F.inline("neighbours").alias("at", "right_word"))
    return pairs.filter(F.col("at") > F.col("pos")).select("market", "left_word", "right_word")


def nine_digits(df: DataFrame) -> DataFrame:
    """Scores to 9 digits, halves decided in floating point as SQL engines do."""
    return df.withColumn("score", F.floor(F.col("score") * 1e9 + 0.5) / 1e9)


def scored(similarity: Similarity):
    def query(spark, sf_dir):
        pairs = close_words(spark, sf_dir)
        return nine_digits(spelling.scored_pairs(pairs, "left_word", "right_word", similarity))
    return query


def pair_scores_sentences(spark, sf_dir):
    """Scores of whole sentences, many of them longer than 64 characters, with the next in order.

    Characters beyond ASCII become a question mark, as the SQL function compares bytes.
    """
    rows = sentences(spark, sf_dir).withColumn("raw_name", F.regexp_replace("raw_name", "[^\\x00-\\x7F]", "?"))
    names = vocabulary.name_frequency(rows, "raw_name")
    near = neighbour_frames(parents.sorted_names(names), ["market"], ["name"], 1)
    pairs = near.select("market", F.col("name").alias("left_text"), "pos", F.inline("neighbours").alias("at", "right_text"))
    pairs = pairs.filter(F.col("at") > F.col("pos")).select("market", "left_text", "right_text")
    return nine_digits(spelling.scored_pairs(pairs, "left_text", "right_text", Similarity()))


# Queries.

def trailing_window_records(spark, sf_dir):
    rows = tables.read_records(
        accounts(spark, sf_dir), ACCOUNT_COLUMNS, markets=SEGMENTS[:3], as_of=DAY
    )
    return rows.withColumn("as_of", F.col("as_of").cast("date"))


def clean_names_orders(spark, sf_dir):
    rows = cleaning.clean_names(records(spark, sf_dir))
    return rows.select("record_id", "raw_name", "market", "name_clean")


def clean_names_sentences(spark, sf_dir):
    return cleaning.clean_names(sentences(spark, sf_dir))


def path_prefix_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.before_slash(F.col("url")).alias("before_slash"),
        cleaning.clean_name(F.col("url")).alias("name_clean"),
    )


def cleaning_steps(spark, sf_dir):
    c = F.col("text")
    stripped = text.strip_symbols(c)
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        text.before_slash(c).alias("before_slash"),
        stripped.alias("stripped"),
        text.squeeze_spaces(text.blank_to_empty(stripped)).alias("squeezed"),
        text.join_tokens(text.tokens(stripped)).alias("lowered"),
        text.join_tokens(text.drop_tokens(text.tokens(stripped), cleaning.lists.STOP_TOKENS)).alias("kept"),
        text.join_tokens(text.expand_tokens(text.tokens(stripped), cleaning.lists.TOKEN_EXPANSIONS)).alias("expanded"),
        text.prefix_key(stripped).alias("prefix"),
        text.null_safe_length(c).alias("n_chars"),
    )


def vocabulary_query(spark, sf_dir):
    counted = word_counts(spark, sf_dir)
    return vocabulary.sort_by_count(counted, "counts", "word")


def frequent_words(spark, sf_dir):
    return vocabulary.frequent(word_counts(spark, sf_dir))


def infrequent_words(spark, sf_dir):
    return vocabulary.infrequent(word_counts(spark, sf_dir))


def word_lookup(spark, sf_dir):
    return vocabulary.find_words(word_counts(spark, sf_dir), ["the", "and", "amazing"])


def blocked_pairs(spark, sf_dir):
    counted = word_counts(spark, sf_dir)
    return blocking.block_sizes(vocabulary.frequent(counted), vocabulary.infrequent(counted))


def spelling_table(spark, sf_dir):
    return nine_digits(spelling.build_spelling(word_counts(spark, sf_dir)))


def corrected_names(spark, sf_dir):
    rows = cleaning.clean_names(sentences(spark, sf_dir))
    table_ = spelling.build_spelling(vocabulary.build_vocabulary(rows))
    fixed = spelling.apply_spelling(rows, written(table_, "spelling"), output="name_corrected")
    return fixed.select("record_id", "market", "name_clean", "name_corrected")


def name_frequency(spark, sf_dir):
    return vocabulary.name_frequency(cleaning.clean_names(sentences(spark, sf_dir)))


def name_frequency_global(spark, sf_dir):
    rows = cleaning.clean_names(sentences(spark, sf_dir))
    counted = vocabulary.name_frequency(rows, market=None)
    return vocabulary.sort_by_count(counted, "freq", "name")


def sorted_positions(spark, sf_dir):
    placed = with_positions(word_names(spark, sf_dir), ["market"], ["name"])
    return placed.select("market", "name", "freq", "pos", "n")


def neighbour_frames_query(spark, sf_dir):
    placed = parents.sorted_names(record_names(spark, sf_dir))
    near = neighbour_frames(placed, ["market", "blank"], ["name", "freq"], 20)
    return near.select(
        "market", "name", "pos",
        F.inline("neighbours").alias("other_pos", "other_name", "other_freq"),
    )


def best_neighbour(spark, sf_dir):
    placed = parents.sorted_names(word_names(spark, sf_dir))
    found = parents.best_neighbours(placed)
    return found.select("market", "name", "freq", "target_name", "target_freq")


def parents_by_market(spark, sf_dir):
    return parents.assign_parents(record_names(spark, sf_dir))


def parents_by_lang(spark, sf_dir):
    return parents.assign_parents(word_names(spark, sf_dir))


def parents_to_the_edge(spark, sf_dir):
    return parents.assign_parents(record_names(spark, sf_dir), edge="partial")


def parents_global_notebook(spark, sf_dir):
    counted = vocabulary.name_frequency(words(spark, sf_dir), "word", market=None)
    return parents.assign_parents(counted, 20, 0.95, NOTEBOOK, per_market=False)


def with_parents(key: str):
    def query(spark, sf_dir):
        rows = cleaning.clean_names(records(spark, sf_dir))
        return counted_with_parents(rows, key)
    return query


def counted_with_parents(rows: DataFrame, key: str) -> DataFrame:
    """Names are counted once, for the parents and for the heavy keys of the attach step."""
    names = written(vocabulary.name_frequency(rows), "names")
    counts = names.select(F.col("name").alias("name_clean"), "market", F.col("freq").alias("n"))
    return attach.attach_parents(rows, parents.assign_parents(names), key, counts=counts)


def sentences_with_parents_name_only(spark, sf_dir):
    return counted_with_parents(cleaning.clean_names(sentences(spark, sf_dir)), "name")


def frequency_bands_before(spark, sf_dir):
    return vocabulary.profile_frequencies(words(spark, sf_dir), "word")


def frequency_bands_after(spark, sf_dir):
    found = parents.assign_parents(word_names(spark, sf_dir))
    return vocabulary.profile_frequencies(found, "parent_name", weight="freq")


def frequency_bands_parts(spark, sf_dir):
    rows = cleaning.clean_names(table(spark, sf_dir, "part"), raw="p_name")
    return vocabulary.profile_frequencies(rows, "name_clean")


def distinct_rows(spark, sf_dir):
    return attach.distinct_rows(sentences(spark, sf_dir))


def top_names(spark, sf_dir):
    rows = cleaning.clean_names(sentences(spark, sf_dir))
    return vocabulary.top_names(vocabulary.name_frequency(rows, market=None), 20)


def market_names(spark, sf_dir):
    counted = record_names(spark, sf_dir)
    one = counted.filter(F.col("market") == SEGMENTS[1])
    other = counted.filter(F.col("market") == SEGMENTS[4])
    return one.unionByName(other)


def customers_with_orders(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left"
    ).select("c_name", "c_mktsegment", "o_orderkey", "o_orderpriority")


def incomplete_rows_dropped(spark, sf_dir):
    return cleaning.drop_incomplete(customers_with_orders(spark, sf_dir))


def nulls_blanked(spark, sf_dir):
    return cleaning.blank_nulls(customers_with_orders(spark, sf_dir), ["o_orderpriority"])


def nullability(spark, sf_dir):
    strict = cleaning.set_nullability(records(spark, sf_dir), ["record_id", "raw_name"], False)
    return cleaning.set_nullability(strict, ["raw_name"], True)


def table_shape(spark, sf_dir):
    return vocabulary.table_shape(sentences(spark, sf_dir))


def renamed_columns(spark, sf_dir):
    return record_names(spark, sf_dir).withColumns({
        "parent_name": F.col("name"), "score": F.lit(1),
    }).withColumnRenamed("name", "name_clean")


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "documents")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


def delimited_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    rows = table(spark, sf_dir, "conversations")
    tables.write_delimited(rows, path)
    return tables.read_delimited(spark, path, rows.schema)


def single_file_roundtrip(spark, sf_dir):
    """One file from many tasks, read again; the parts keep their order."""
    path = scratch_path(spark, "single")
    rows = table(spark, sf_dir, "conversations").repartitionByRange(7, "conv_id")
    tables.write_delimited(rows, path, single_file=True)
    return tables.read_delimited(spark, path, rows.schema)


def quoted_line_breaks(spark, sf_dir):
    """Texts with line breaks, quotes and separators, written by other rules than ours, in several splits."""
    path = scratch_path(spark, "quoted")
    rows = table(spark, sf_dir, "documents")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.concat(F.lit('C:\\new\\road "'), "text", F.lit('",\r\n'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quote(text), F.coalesce("lang", F.lit("")))
    rows.select(line.alias("value")).write.text(path)
    read = tables.read_delimited(spark, path, "doc_id long, text string, lang string", separator=",")
    return read.select("doc_id", "lang", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def rejected_rows(spark, sf_dir):
    """Rows with too few or too many fields, or a value of the wrong kind, are told apart and counted."""
    path = scratch_path(spark, "foreign")
    key = F.col("o_orderkey")
    fields = [
        F.when(key % 31 == 0, "none").otherwise(key.cast("string")), F.concat(F.lit('"'), F.col("o_custkey").cast("string")),
        F.when(key % 17 == 0, F.lit(None)).otherwise("x"), F.when(key % 23 == 0, "more"),
    ]
    table(spark, sf_dir, "orders").select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    read = tables.read_delimited(spark, path, "id long, name string, mark string", quote=None, bad_rows="column")
    good, bad = tables.good_rows(read), tables.rejected(read)
    return good.agg(
        F.count(F.lit(1)).alias("n_good"), F.sum("id").alias("sum_id"), F.sum(F.length("name")).alias("name_chars")
    ).crossJoin(bad.agg(F.count(F.lit(1)).alias("n_bad"), F.sum(F.length("record")).alias("bad_chars")))


WINDOWS = [("2000-02-01", "2001-02-01"), ("2000-08-01", "2001-08-01")]


def moving_window_counts(spark, sf_dir):
    """Counts of a later window from those of an earlier one and the days in one of the two."""
    state = scratch_path(spark, "days")
    rows = records(spark, sf_dir).withColumnRenamed("raw_name", "name")
    for first, end in (("1990-01-01", "2000-10-01"), ("2000-10-01", "2010-01-01")):  # two runs, each with its new days
        new = rows.filter((F.col("as_of") >= F.lit(first).cast("date")) & (F.col("as_of") < F.lit(end).cast("date")))
        moving_window.store_days(moving_window.daily_counts(new, ["name", "market"]), state)
    before = moving_window.window_counts(moving_window.stored_days(spark, state, *WINDOWS[0]))
    return moving_window.move(spark, before, state, *WINDOWS)


def table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    rows = clean_names_orders(spark, sf_dir)
    tables.save_table(rows, "clean_records", ["record_id", "market", "raw_name", "name_clean"], "namekin", path)
    spark.table("namekin.clean_records").createOrReplaceTempView("clean_records")
    return spark.sql("SELECT record_id, market, raw_name, name_clean FROM clean_records")


def corrections_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "corrections")
    tables.save_corrections(spelling.build_spelling(word_counts(spark, sf_dir)), path)
    return nine_digits(tables.load_corrections(spark, path))


def matched_records(spark, sf_dir):
    return match_parents(records(spark, sf_dir))


def matched_sentences(spark, sf_dir):
    return match_parents(sentences(spark, sf_dir))


def matched_sentences_name_only(spark, sf_dir):
    return match_parents(sentences(spark, sf_dir), Settings(join_key="name"))


def matched_split(key: str):
    """The whole job with a row limit low enough to split many keys."""
    def query(spark, sf_dir):
        return match_parents(records(spark, sf_dir), Settings(join_key=key, max_rows_per_key=4))
    return query


def matched_records_notebook(spark, sf_dir):
    """All markets together, sample aliases, one pass over double spaces, blanks and null ids kept."""
    options = {
        "token_expansions": cleaning.lists.TOKEN_EXPANSIONS, "name_aliases": cleaning.lists.SAMPLE_NAME_ALIASES,
        "squeeze_runs": (2,),
    }
    orders = customers_with_orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("record_id"), F.col("c_name").alias("raw_name"),
        F.col("c_mktsegment").alias("market"),
    )
    return match_parents(orders, Settings(
        per_market=False, join_key="name", nulls="blank", parent_threshold=0.95,
        parent_similarity=NOTEBOOK, cleaning=options,
    ))


def matched_with_saved_corrections(spark, sf_dir):
    path = scratch_path(spark, "corrections")
    rows = cleaning.clean_names(sentences(spark, sf_dir))
    tables.save_corrections(spelling.build_spelling(vocabulary.build_vocabulary(rows)), path)
    return match_parents(sentences(spark, sf_dir), corrections=tables.load_corrections(spark, path))


def parents_with_null_market(spark, sf_dir):
    """Names of priorities and customers; customers without orders have no market."""
    rows = customers_with_orders(spark, sf_dir).select(
        F.col("c_name").alias("name_clean"), F.col("o_orderpriority").alias("market")
    )
    return parents.assign_parents(vocabulary.name_frequency(rows))


def catalog_to_file(spark, sf_dir):
    """A catalog table in, market list and window applied, the delimited final file out and read again."""
    path = scratch_path(spark, "accounts")
    columns = ["o_orderkey", "c_name", "c_mktsegment", "o_orderdate"]
    tables.save_table(accounts(spark, sf_dir), "accounts", columns, "namekin", path)
    rows = tables.read_records(spark.table("namekin.accounts"), ACCOUNT_COLUMNS, markets=SEGMENTS[:3], as_of=DAY)
    final = match_parents(rows.withColumn("record_id", F.col("record_id").cast("string")))
    out = scratch_path(spark, "final")
    tables.write_delimited(final, out)
    return tables.read_delimited(spark, out, final.schema)


def entry(spark: SparkSession) -> DataFrame:
    """The whole job on the smallest tables."""
    return matched_sentences(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {}
    return _name_queries() | more


def oracle_sql() -> dict[str, str]:
    return _name_sql() | (corpus.oracle_sql() if corpus else {})


def _name_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "trailing_window_records": trailing_window_records,
        "clean_names_orders": clean_names_orders,
        "clean_names_sentences": clean_names_sentences,
        "path_prefix_clean": path_prefix_clean,
        "cleaning_steps": cleaning_steps,
        "vocabulary": vocabulary_query,
        "frequent_words": frequent_words,
        "infrequent_words": infrequent_words,
        "word_lookup": word_lookup,
        "blocked_pairs": blocked_pairs,
        "pair_scores": scored(Similarity()),
        "jaro_scores": scored(Similarity(winkler=False)),
        "pair_scores_long": scored(Similarity(long_tolerance=True)),
        "pair_scores_notebook": scored(NOTEBOOK),
        "spelling_table": spelling_table,
        "corrected_names": corrected_names,
        "name_frequency": name_frequency,
        "name_frequency_global": name_frequency_global,
        "sorted_positions": sorted_positions,
        "neighbour_frames": neighbour_frames_query,
        "best_neighbour": best_neighbour,
        "parents_by_market": parents_by_market,
        "parents_by_lang": parents_by_lang,
        "parents_to_the_edge": parents_to_the_edge,
        "parents_global_notebook": parents_global_notebook,
        "records_with_parents": with_parents("name_market"),
        "records_with_parents_name_only": with_parents("name"),
        "sentences_with_parents_name_only": sentences_with_parents_name_only,
        "frequency_bands_before": frequency_bands_before,
        "frequency_bands_after": frequency_bands_after,
        "frequency_bands_parts": frequency_bands_parts,
        "distinct_rows": distinct_rows,
        "top_names": top_names,
        "market_names": market_names,
        "incomplete_rows_dropped": incomplete_rows_dropped,
        "nulls_blanked": nulls_blanked,
        "nullability": nullability,
        "table_shape": table_shape,
        "renamed_columns": renamed_columns,
        "csv_roundtrip": csv_roundtrip,
        "delimited_roundtrip": delimited_roundtrip,
        "single_file_roundtrip": single_file_roundtrip,
        "quoted_line_breaks": quoted_line_breaks,
        "rejected_rows": rejected_rows,
        "moving_window_counts": moving_window_counts,
        "table_roundtrip": table_roundtrip,
        "corrections_roundtrip": corrections_roundtrip,
        "matched_records": matched_records,
        "matched_sentences": matched_sentences,
        "matched_sentences_name_only": matched_sentences_name_only,
        "matched_records_split": matched_split("name_market"),
        "matched_records_split_name_only": matched_split("name"),
        "matched_records_notebook": matched_records_notebook,
        "matched_with_saved_corrections": matched_with_saved_corrections,
        "parents_with_null_market": parents_with_null_market,
        "catalog_to_file": catalog_to_file,
        "pair_scores_sentences": pair_scores_sentences,
    }


def _name_sql() -> dict[str, str]:
    clean_records = sql.clean(sql.RECORDS)
    clean_sentences = sql.clean(sql.SENTENCES)
    words_ = f"words AS ({sql.WORDS})"
    vocab = f"vocab AS ({sql.vocabulary(sql.WORDS, 'word')})"
    word_names_ = f"names AS ({sql.WORD_NAMES})"
    record_names_ = (
        f"names AS (SELECT name_clean AS name, market, count(*) AS freq FROM ({clean_records}) GROUP BY ALL)"
    )
    sentence_names_ = (
        f"names AS (SELECT name_clean AS name, market, count(*) AS freq FROM ({clean_sentences}) GROUP BY ALL)"
    )
    close = f"""WITH {word_names_}, pos AS ({sql.positions("names")}),
        close AS (SELECT l.market, l.name AS left_word, r.name AS right_word
            FROM (SELECT *, pos + unnest([1, 2, 3]) AS want FROM pos) l
            JOIN pos r ON r.market = l.market AND r.pos = l.want)"""

    def close_scores(score):
        return f"{close} SELECT market, left_word, right_word, round({score}, 9) AS score FROM close"

    def detailed(variant):
        rows = sql.detailed_score("SELECT * FROM close", "left_word", "right_word", variant)
        return f"{close} SELECT market, left_word, right_word, round(score, 9) AS score FROM ({rows})"

    def parents_sql(names, **options):
        return f"""WITH RECURSIVE {names}, {sql.parents_ctes("names", **options)}
            SELECT name, market, CAST(freq AS BIGINT) AS freq, parent_name FROM parents"""

    def attached(names, rows, key):
        on = "p.name = r.name_clean" + (" AND p.market = r.market" if key == "name_market" else "")
        return f"""WITH RECURSIVE {names}, {sql.parents_ctes("names")}, rows AS ({rows})
            SELECT DISTINCT record_id, raw_name, name_clean, parent_name, r.market, 1 AS score
            FROM rows r JOIN parents p ON {on}"""

    stripped = "regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')"
    tokens = f"list_filter(string_split(lower({stripped}), ' '), lambda t: t <> '')"
    stop = sql._list(cleaning.lists.STOP_TOKENS)
    expansions = sql._map(cleaning.lists.TOKEN_EXPANSIONS)
    global_names = "names AS (SELECT word AS name, '' AS market, count(*) AS freq FROM words GROUP BY word)"
    notebook_rows = sql.detailed_score(
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market, pos, other_freq ORDER BY other_pos) AS nth,
            rank() OVER (PARTITION BY market, pos ORDER BY other_freq DESC) AS place FROM frame
            WHERE pos BETWEEN 20 AND n - 22)
        WHERE nth = 1 AND place <= 20 AND other_freq > freq
            AND least(length(name), length(other_name)) >= 0.74 * greatest(length(name), length(other_name))""",
        "name", "other_name", "notebook",
    )
    left_customers = """SELECT c_name, c_mktsegment, o_orderkey, o_orderpriority
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey"""
    recent = f"""{sql.RECORDS} WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
        AND o_orderdate >= DATE '{DAY}' - INTERVAL 12 MONTH"""
    notebook_chain = f"""pos AS ({sql.positions("names")}), frame AS ({sql.frames("pos", 20)}),
            best AS (SELECT market, pos, arg_max(other_pos, other_freq) AS target_pos,
                arg_max(other_name, other_freq) AS target_name
                FROM ({notebook_rows}) WHERE round(score, 9) >= 0.95 GROUP BY ALL),
            chain(pos, target_pos, target_name, hop, ended) AS (
                SELECT pos, target_pos, target_name, 1, target_pos > pos FROM best
                UNION ALL
                SELECT c.pos, b.target_pos, b.target_name, c.hop + 1, b.target_pos > b.pos
                FROM chain c JOIN best b ON b.pos = c.target_pos WHERE NOT c.ended),
            final_targets AS (SELECT pos, arg_max(target_name, hop) AS target_name FROM chain GROUP BY ALL)"""
    fixes = f"{vocab}, fixes AS ({sql.spelling('vocab')})"

    return {
        "trailing_window_records": f"""SELECT o_orderkey AS record_id, c_name AS raw_name,
            c_mktsegment AS market, CAST(o_orderdate AS DATE) AS as_of
            FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
            AND o_orderdate >= DATE '{DAY}' - INTERVAL 12 MONTH""",
        "single_file_roundtrip": "SELECT * FROM conversations",
        "quoted_line_breaks": """WITH t AS (SELECT doc_id, lang, 'C:\\new\\road "' || text || '",' || chr(13) || chr(10) AS text FROM documents)
            SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS digest FROM t""",
        "rejected_rows": """WITH fields AS (SELECT o_orderkey AS k, '"' || CAST(o_custkey AS VARCHAR) AS name,
                CASE WHEN o_orderkey % 31 = 0 THEN 'none' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
                CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'x' END AS mark,
                CASE WHEN o_orderkey % 23 = 0 THEN 'more' END AS more FROM orders),
            rows_ AS (SELECT k, name, concat_ws(chr(9), id, name, mark, more) AS line, k % 31 <> 0 AND
                (mark IS NULL) = (more IS NOT NULL) AS good FROM fields)
            SELECT count(*) FILTER (good) AS n_good, sum(k) FILTER (good) AS sum_id, sum(length(name)) FILTER (good) AS name_chars,
                count(*) FILTER (NOT good) AS n_bad, sum(length(line)) FILTER (NOT good) AS bad_chars FROM rows_""",
        "moving_window_counts": f"""SELECT c_name AS name, c_mktsegment AS market, count(*) AS freq
            FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE o_orderdate >= DATE '{WINDOWS[1][0]}' AND o_orderdate < DATE '{WINDOWS[1][1]}' GROUP BY ALL""",
        "clean_names_orders": clean_records,
        "clean_names_sentences": clean_sentences,
        "path_prefix_clean": f"""SELECT page_id, split_part(url, '/', 1) AS before_slash, name_clean
            FROM ({sql.clean("SELECT page_id, url FROM pages", "url", "page_id, url")})""",
        "cleaning_steps": f"""SELECT conv_id, turn, split_part(text, '/', 1) AS before_slash,
            {stripped} AS stripped,
            replace(replace(replace(regexp_replace({stripped}, '^\\s*$', ''), '  ', ' '), '   ', ' '), '    ', ' ') AS squeezed,
            coalesce(array_to_string({tokens}, ' '), '') AS lowered,
            coalesce(array_to_string(list_filter({tokens}, lambda t: NOT list_contains({stop}, t)), ' '), '') AS kept,
            coalesce(array_to_string(list_transform({tokens}, lambda t: coalesce({expansions}[t], t)), ' '), '') AS expanded,
            substr({stripped}, 1, 3) AS prefix, coalesce(length(text), 0) AS n_chars FROM conversations""",
        "vocabulary": f"WITH {vocab} SELECT * FROM vocab",
        "frequent_words": f"WITH {vocab} SELECT * FROM vocab WHERE counts >= 100",
        "infrequent_words": f"WITH {vocab} SELECT * FROM vocab WHERE counts < 100",
        "word_lookup": f"WITH {vocab} SELECT * FROM vocab WHERE word IN ('the', 'and', 'amazing')",
        "blocked_pairs": f"""WITH {vocab}, sides AS (SELECT substr(word, 1, 3) AS prefix,
                count(*) FILTER (counts >= 100) AS n_left, count(*) FILTER (counts < 100) AS n_right
                FROM vocab GROUP BY 1)
            SELECT prefix, n_left, n_right, n_left * n_right AS n_pairs FROM sides
            WHERE n_left > 0 AND n_right > 0""",
        "pair_scores": close_scores(sql.standard_score("left_word", "right_word")),
        "jaro_scores": close_scores("jaro_similarity(left_word, right_word)"),
        "pair_scores_long": detailed("standard"),
        "pair_scores_notebook": detailed("notebook"),
        "spelling_table": f"WITH {fixes} SELECT old_word, new_word, round(score, 9) AS score FROM fixes",
        "corrected_names": f"""WITH cleaned AS ({clean_sentences}),
            vocab AS ({sql.vocabulary("SELECT * FROM cleaned", "name_clean")}),
            fixes AS ({sql.spelling("vocab")}), renamed AS ({sql.corrected("cleaned", "fixes")})
            SELECT record_id, market, name_clean, name_corrected FROM cleaned JOIN renamed USING (name_clean)""",
        "name_frequency": f"WITH {sentence_names_} SELECT * FROM names",
        "name_frequency_global": f"SELECT name_clean AS name, count(*) AS freq FROM ({clean_sentences}) GROUP BY ALL",
        "sorted_positions": f"WITH {word_names_} SELECT market, name, freq, pos, n FROM ({sql.positions('names')})",
        "neighbour_frames": f"""WITH {record_names_}, pos AS ({sql.positions("names")})
            SELECT market, name, pos, other_pos, other_name, other_freq FROM ({sql.frames("pos", 20)})""",
        "best_neighbour": f"""WITH {word_names_}, pos AS ({sql.positions("names")}),
            frame AS ({sql.frames("pos", 20)})
            SELECT market, name, freq, target_name, target_freq
            FROM ({sql.best("frame", 20, 0.90, sql.standard_score("name", "other_name"))})""",
        "parents_by_market": parents_sql(record_names_),
        "parents_by_lang": parents_sql(word_names_),
        "parents_to_the_edge": parents_sql(record_names_, edge="partial"),
        "parents_global_notebook": f"""WITH RECURSIVE {words_}, {global_names}, {notebook_chain}
            SELECT p.name, p.freq, coalesce(l.target_name, p.name) AS parent_name FROM pos p
            LEFT JOIN final_targets l ON l.pos = p.pos""",
        "matched_records_notebook": f"""WITH RECURSIVE rows AS ({sql.clean(f"""SELECT
                CAST(o_orderkey AS VARCHAR) AS record_id, c_name AS raw_name, c_mktsegment AS market FROM ({left_customers})""")}),
            names AS (SELECT name_clean AS name, '' AS market, count(*) AS freq FROM rows GROUP BY name_clean), {notebook_chain}
            SELECT DISTINCT record_id, raw_name, name_clean, coalesce(l.target_name, name_clean) AS parent_name,
                r.market, 1 AS score FROM rows r LEFT JOIN pos p ON p.name = name_clean LEFT JOIN final_targets l ON l.pos = p.pos""",
        "records_with_parents": attached(record_names_, clean_records, "name_market"),
        "records_with_parents_name_only": attached(record_names_, clean_records, "name"),
        "sentences_with_parents_name_only": attached(sentence_names_, clean_sentences, "name"),
        "frequency_bands_before": f"WITH {words_} {sql.bands('words', 'word')}",
        "frequency_bands_after": f"""WITH RECURSIVE {word_names_}, {sql.parents_ctes("names")},
            found AS (SELECT parent_name, unnest(range(freq)) AS copy FROM parents)
            {sql.bands("found", "parent_name")}""",
        "frequency_bands_parts": f"""WITH parts AS (
            {sql.clean("SELECT p_partkey, p_name FROM part", "p_name", "p_partkey")})
            {sql.bands("parts", "name_clean")}""",
        "distinct_rows": f"SELECT DISTINCT record_id, raw_name, market FROM ({sql.SENTENCES})",
        "top_names": f"""SELECT name_clean AS name, count(*) AS freq FROM ({clean_sentences})
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "market_names": f"WITH {record_names_} SELECT * FROM names WHERE market IN ('BUILDING', 'MACHINERY')",
        "incomplete_rows_dropped": f"SELECT * FROM ({left_customers}) WHERE o_orderkey IS NOT NULL AND o_orderpriority IS NOT NULL",
        "nulls_blanked": f"SELECT * REPLACE (coalesce(o_orderpriority, '') AS o_orderpriority) FROM ({left_customers})",
        "nullability": sql.RECORDS,
        "table_shape": f"SELECT count(*) AS n_rows, 3 AS n_columns FROM ({sql.SENTENCES})",
        "renamed_columns": f"""WITH {record_names_}
            SELECT name AS name_clean, market, freq, name AS parent_name, 1 AS score FROM names""",
        "csv_roundtrip": "SELECT * FROM documents",
        "delimited_roundtrip": "SELECT * FROM conversations",
        "table_roundtrip": f"SELECT record_id, market, raw_name, name_clean FROM ({clean_records})",
        "corrections_roundtrip": f"WITH {fixes} SELECT old_word, new_word, round(score, 9) AS score FROM fixes",
        "matched_records": f"WITH RECURSIVE {sql.matched_ctes(sql.RECORDS)} SELECT * FROM final",
        "matched_sentences": f"WITH RECURSIVE {sql.matched_ctes(sql.SENTENCES)} SELECT * FROM final",
        "matched_sentences_name_only":
            f"WITH RECURSIVE {sql.matched_ctes(sql.SENTENCES)} SELECT * FROM final_by_name",
        "matched_records_split": f"WITH RECURSIVE {sql.matched_ctes(sql.RECORDS)} SELECT * FROM final",
        "matched_records_split_name_only": f"WITH RECURSIVE {sql.matched_ctes(sql.RECORDS)} SELECT * FROM final_by_name",
        "matched_with_saved_corrections": f"WITH RECURSIVE {sql.matched_ctes(sql.SENTENCES)} SELECT * FROM final",
        "parents_with_null_market": f"""WITH RECURSIVE orig AS (
                SELECT c_name AS name, o_orderpriority AS real, count(*) AS freq FROM ({left_customers}) GROUP BY ALL),
            names AS (SELECT name, coalesce(real, '<null>') AS market, freq FROM orig), {sql.parents_ctes("names")}
            SELECT name, nullif(market, '<null>') AS market, CAST(freq AS BIGINT) AS freq, parent_name FROM parents""",
        "catalog_to_file": f"""WITH RECURSIVE {sql.matched_ctes(recent)} SELECT * FROM final""",
        "pair_scores_sentences": f"""WITH names AS (SELECT regexp_replace(raw_name, '[^\\x00-\\x7F]', '?', 'g') AS name, market,
                count(*) AS freq FROM ({sql.SENTENCES}) GROUP BY ALL),
            pos AS ({sql.positions("names")})
            SELECT l.market, l.name AS left_text, r.name AS right_text, round({sql.standard_score("l.name", "r.name")}, 9) AS score
            FROM pos l JOIN pos r ON r.market = l.market AND r.pos = l.pos + 1""",
    }
