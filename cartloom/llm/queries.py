"""Queries of the training-data operators, one ``opN_<name>`` each, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import chat, collocations, decontam, extraction, langid, linefreq, mixing, neardup, pii, ranking, resampling, sharding, tokens
from cartloom.session import written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of all documents over a public byte-level vocabulary."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.rank_file_pieces(VOCABULARY))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of near equal bytes, equal texts together."""
    return sharding.lpt_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the verdict of the line frequencies."""
    return linefreq.quality_verdict(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaks of benchmark items into documents."""
    return decontam.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "at"
    )


def op6_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base spans and those the trained classifier adds."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find_private_spans(docs, pii.train(docs))
    base = F.concat(*pii.KINDS)
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.concat(base, pii.ADDED)).alias("spans"),
    )


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weighed towards good ones; the sample is as large as the share of quality 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    ratio = resampling.fit_ratio(docs, labels.where(good))
    weighed = written(resampling.log_weights(docs.select("doc_id", "text"), ratio, F.col("text")).drop("text"), "weights")
    share = labels.agg(F.avg("quality")).first()[0] or 0.0
    return resampling.gumbel_top_k(weighed, round(share * weighed.count()), F.col("doc_id"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train_filter(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict_language(rows, model, F.col("text")).drop("text")


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix of the sources, weights tempered by the power 0.7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.pfair_mix(docs, mixing.tempered_weights(docs), F.col("doc_id"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, expanded, formatted, and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], rows.schema)
    return chat.conversation_digest(chat.prefix_target_examples(rows.unionByName(extra)))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words of each language of all documents."""
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROL_STRINGS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def _op10_sql() -> str:
    marks = len(chat.TURN_START + chat.TEXT_START + chat.TURN_END)
    turn_order = "conv_id ORDER BY turn NULLS FIRST, role, text"
    return f"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY {turn_order}) AS k, count(*) OVER (PARTITION BY conv_id) AS n,
                   {marks} + length({_escaped('role')}) + length({_escaped('text')}) AS chars
            FROM given
        ), summed AS (
            SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM placed
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(upto) FILTER (WHERE role = 'assistant' OR k = n)::BIGINT AS formatted_chars
        FROM summed GROUP BY conv_id
    """


_SPLIT = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _op4_sql() -> str:
    blanks = "repeat('0', 10) || '    '"
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS row_no, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                   {_SPLIT.format("coalesce(text, '')")} AS w
            FROM documents
        ), windows AS (
            SELECT row_no, i, count(*) OVER (PARTITION BY row_no, a, b, c) AS n
            FROM (SELECT row_no, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c FROM d)
            WHERE c IS NOT NULL
        ), repeats AS (
            SELECT row_no, count(DISTINCT i + k) AS n_repeat_words
            FROM (SELECT row_no, i, unnest([0, 1, 2]) AS k FROM windows WHERE n > 1) GROUP BY row_no
        ), raw_lines AS (
            SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT row_no, unnest(string_split(t, chr(10))) AS line FROM d)
            WHERE translate(line, {_WHITE}, '') <> '' GROUP BY row_no
        ), lines AS (
            SELECT row_no, host, t, trim(line) AS line, length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 AS words
            FROM (SELECT row_no, host, t, unnest(string_split_regex(regexp_replace(
                translate(lower(t), '0123456789' || chr(9) || chr(11) || chr(12) || chr(13), {blanks}), ' {{2,}}', ' ', 'g'
            ), ' ?\n ?')) AS line FROM d) WHERE trim(line) <> ''
        ), frequent AS (
            SELECT host, line FROM lines GROUP BY host, line
            HAVING count(DISTINCT t) > greatest(10, least(100, 0.01 * (SELECT count(DISTINCT x.t) FROM d x WHERE x.host = lines.host)))
        ), removed AS (
            SELECT row_no, sum(words) AS removed_words FROM lines JOIN frequent USING (host, line) GROUP BY row_no
        ), counted AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {_WHITE}, ''))::BIGINT AS word_chars,
                   (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
                   coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                   coalesce(removed_words, 0)::BIGINT AS removed_words
            FROM d LEFT JOIN repeats USING (row_no) LEFT JOIN raw_lines USING (row_no) LEFT JOIN removed USING (row_no)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.7 * n_words AS kept
        FROM counted
    """


def _op5_sql() -> str:
    plain = "list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '')"
    grams = "SELECT *, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM (SELECT *, unnest(range(0, greatest(len(w) - 4, 1))) AS p FROM {})"
    return f"""
        WITH d AS (SELECT doc_id, {plain} AS w FROM documents), b AS (SELECT item_id, {plain} AS w FROM benchmark),
        ds AS MATERIALIZED (SELECT doc_id, p, s FROM ({grams.format('d')})),
        bs AS MATERIALIZED (SELECT item_id, len(w) AS n, p, s FROM ({grams.format('b')})),
        met AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, n, ds.p - bs.p AS a FROM ds JOIN bs USING (s)),
        own AS (
            SELECT doc_id, item_id, a, greatest(a, 0) AS low, least(a + n, len(w)) - 5 AS high, n - 4 AS item_size
            FROM met JOIN d USING (doc_id)
        ), counts AS (
            SELECT own.*, s, count(*) AS times FROM own JOIN ds USING (doc_id) WHERE p BETWEEN low AND high
            GROUP BY ALL
        ), item_counts AS (SELECT item_id, s, count(*) AS item_times FROM bs GROUP BY ALL),
        scored AS (
            SELECT doc_id, item_id, low, sum(least(times, item_times)) AS c, any_value(high - low + 1 + item_size) AS total
            FROM counts JOIN item_counts USING (item_id, s) GROUP BY doc_id, item_id, a, low
        )
        SELECT doc_id, item_id, round(max(c / (total - c)), 6) AS similarity,
               arg_min(low, (-c / (total - c), low))::INTEGER AS at
        FROM scored WHERE c / (total - c) >= 0.8 GROUP BY doc_id, item_id
    """


_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op11_sql() -> str:
    text = _SMALL.format("coalesce(text, '')")
    return f"""
        WITH p AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({text}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
        ), g AS (
            SELECT lang, 1 AS words, unnest(w) AS phrase FROM p
            UNION ALL
            SELECT lang, 2, a || ' ' || b FROM (SELECT lang, unnest(w) AS a, unnest(w[2:]) AS b FROM p) WHERE b IS NOT NULL
            UNION ALL
            SELECT lang, 3, a || ' ' || b || ' ' || c
            FROM (SELECT lang, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c FROM p) WHERE c IS NOT NULL
        ), f AS MATERIALIZED (SELECT lang, words, phrase, string_split(phrase, ' ') AS w, count(*) AS n FROM g GROUP BY lang, words, phrase),
        c AS MATERIALIZED (SELECT * FROM f WHERE words > 1 AND n >= 10),
        cuts AS MATERIALIZED (
            SELECT lang || ' ' || array_to_string(w[1:k], ' ') AS first, lang || ' ' || array_to_string(w[k + 1:], ' ') AS rest, lang, phrase, n, k
            FROM (SELECT *, unnest(range(1, words)) AS k FROM c)
        ), named AS MATERIALIZED (SELECT lang || ' ' || phrase AS name, n FROM f WHERE n >= 10),
        firsts AS MATERIALIZED (SELECT cuts.*, named.n AS l FROM cuts JOIN named ON name = first),
        scored AS (
            SELECT firsts.*, named.n AS r, (1000000::HUGEINT * firsts.n * firsts.n) // (l::HUGEINT * named.n) AS score
            FROM firsts JOIN named ON name = rest
        ), best AS (
            SELECT lang, phrase, n AS a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_parts AS (
            SELECT lang, phrase, max(n) AS f
            FROM (SELECT lang, n, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE words = 3) GROUP BY lang, phrase
        ), total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, total.n AS n, score::BIGINT AS score
        FROM best JOIN total USING (lang) LEFT JOIN inner_parts USING (lang, phrase)
        WHERE f IS NULL OR 100 * f < 50 * a QUALIFY rank <= 2000
    """


def _op12_sql() -> str:
    terms = "regexp_extract_all(" + _SMALL.format("text") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {terms} AS t FROM documents),
        sized AS (SELECT row_no, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
        whole AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sized),
        tf AS MATERIALIZED (SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(t) AS term FROM d) GROUP BY ALL),
        wanted AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
        weight AS (
            SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole
        ), scored AS (
            SELECT item_id, row_no, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
            FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN sized USING (row_no), whole GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored JOIN sized USING (row_no) WHERE score > 0 QUALIFY rank <= 10
    """


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_lpt_sharding": op3_lpt_sharding,
    "op4_line_frequency_rules": op4_line_frequency_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_private_spans": op6_private_spans,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_language_id": op8_language_id,
    "op9_pfair_mixing": op9_pfair_mixing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_collocations": op11_collocations,
    "op12_reversed_search": op12_reversed_search,
    "op13_html_extraction": op13_html_extraction,
}

# The others fit models, cut with vocabularies, follow links or schedule; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_line_frequency_rules": _op4_sql(),
    "op5_benchmark_decontamination": _op5_sql(),
    "op10_chat_formatting": _op10_sql(),
    "op11_collocations": _op11_sql(),
    "op12_reversed_search": _op12_sql(),
}
