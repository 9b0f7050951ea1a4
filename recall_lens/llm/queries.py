"""The registered queries of this subpackage: each operator over its whole table, and SQL twins where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.llm import chat, collocations, language, lm_scores, near_duplicates, neighbours, packing, periodic, quality, repeats, sentencepieces, token_counts, toxicity


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.remove_repeats(documents(spark, folder))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo `divisor`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    scored = lm_scores.score(docs, remainder(7) != 2)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(documents(spark, folder))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept")
    )


def op7_sentencepieces(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document, and the digest of the text that they decode to."""
    decoded = sentencepieces.decode(sentencepieces.encode(documents(spark, folder)))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.group(documents(spark, folder))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.grade(docs, model)


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op11_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    said = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = f"{chat.END}{chat.START}assistant ok"
    more = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    return chat.digests(said.unionByName(more))


def _planted(docs: DataFrame) -> DataFrame:
    """The documents; where h = crc32(doc_id) ends in 0, the words from a on repeat the first p of them (a and p by h)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    a = F.pmod(g, n)
    rows = rows.withColumn("a", F.when(n > 0, a.cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))
    repeated = F.array_join(F.transform("words", lambda _, i: F.get("words", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(_planted(documents(spark, folder)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumns({"longest": longest, "lines": F.array_join(lines, "")})
    length, period = F.col("longest.length"), -F.col("longest.short")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.early")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * longest.length div -longest.short").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_repeats": op2_repeats,
    "op3_language": op3_language,
    "op4_lm_scores": op4_lm_scores,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepieces": op7_sentencepieces,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_toxicity": op9_toxicity,
    "op10_neighbours": op10_neighbours,
    "op11_chat": op11_chat,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op2_repeats": r"""
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
spans AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM texts WHERE len(w) >= 50),
hashed AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM spans),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM hashed) WHERE first < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
marked AS (
    SELECT p.doc_id, p.i, p.word, max(CASE WHEN l.i IS NULL THEN 0 ELSE 1 END) OVER
        (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM placed AS p LEFT JOIN later AS l ON l.doc_id = p.doc_id AND l.i = p.i),
kept AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS text FROM marked GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts AS t LEFT JOIN kept AS k ON k.doc_id = t.doc_id""",
    "op6_quality_rules": r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
spans AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM texts WHERE len(w) >= 8),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) > 1 AS again FROM spans),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice WHERE again) GROUP BY doc_id),
measured AS (
    SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        length(text) - length(replace(text, chr(10), '')) AS feeds, length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) AS letters
    FROM texts AS t LEFT JOIN covered AS c ON c.doc_id = t.doc_id),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * n_symbols <= 10 * word_chars AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND 2 * n_dup_lines <= 1 + feeds AND 2 * letters >= word_chars AS kept
FROM judged""",
    "op8_near_duplicates": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT c.a, c.b FROM common AS c JOIN sizes AS x ON x.doc_id = c.a JOIN sizes AS y ON y.doc_id = c.b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT r.a, l.b FROM reached AS r JOIN links AS l ON l.a = r.b),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM roots LEFT JOIN sizes USING (doc_id)""",
    "op11_chat": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
sized AS (
    SELECT *, length('<|im_start|>' || '<|im_sep|>' || '<|im_end|>')
        + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op13_collocations": """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) AS sizes WHERE len(w) >= k),
total AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, (2000000 * c.a::HUGEINT) // (l.f + r.f) AS score
    FROM cuts AS c
    JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.cut], ' ')
    JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, f, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS size FROM f WHERE k >= 3),
inner_ AS (SELECT lang, f, size, w, unnest(range(1, len(w) - size + 2)) AS place FROM longer),
around AS (SELECT lang, array_to_string(w[place:place + size - 1], ' ') AS phrase, max(f) AS f FROM inner_ GROUP BY ALL),
kept AS (
    SELECT s.* FROM weakest AS s LEFT JOIN around AS o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE o.f IS NULL OR 100 * o.f::HUGEINT < 80 * s.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
