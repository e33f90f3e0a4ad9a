"""TF-IDF, token ids and purchase sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import TX, ctes, days_sql, register, stored_transactions, texts, transactions
from trolley.functions import text as X
from trolley.functions.dates import reference_date
from trolley.operators import sequences as Q
from trolley.operators import text as T

WORDS2 = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
WORDS1 = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def tfidf_ctes(counts: str, documents: str, min_df: int = 1) -> list[str]:
    """counts(doc, term, tf) -> vocab(term, df, idf) and weights(doc, term, weight)."""
    return [f"counts AS ({counts})",
            f"vocab AS (SELECT term, count(*) AS df, ln((1 + ({documents})) / (1.0 + count(*))) + 1 AS idf FROM counts GROUP BY term HAVING count(*) >= {min_df})",
            "raw AS (SELECT doc, term, tf * idf AS r FROM counts JOIN vocab USING (term))",
            "weights AS (SELECT doc, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc)) AS weight FROM raw)"]


DOC_TERMS = f"SELECT doc_id AS doc, term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS2}) AS term FROM documents) GROUP BY ALL"


@register("tfidf_fit", ctes(*tfidf_ctes(DOC_TERMS, "SELECT count(*) FROM documents")) + "SELECT * FROM vocab", ["idf"], 6)
def tfidf_fit(spark, d):
    documents = texts(spark, d)
    return T.tfidf_fit(T.term_counts(documents, ["doc_id"], "text", single=True), documents.count()).vocabulary


@register("tfidf_transform", ctes(*tfidf_ctes(DOC_TERMS, "SELECT count(*) FROM documents")) + "SELECT doc AS doc_id, term, weight FROM weights", ["weight"], 6)
def tfidf_transform(spark, d):
    documents = texts(spark, d)
    counts = T.term_counts(documents, ["doc_id"], "text", single=True)
    return T.tfidf_transform(T.tfidf_fit(counts, documents.count()), counts, ["doc_id"])


NEW_TERMS = f"SELECT conv_id, turn, term, count(*) AS tf FROM (SELECT conv_id, turn, unnest({WORDS2}) AS term FROM conversations) GROUP BY ALL"


@register("tfidf_apply", ctes(*tfidf_ctes(DOC_TERMS, "SELECT count(*) FROM documents")) + f"""SELECT conv_id, turn, term, r / sqrt(sum(r * r) OVER (PARTITION BY conv_id, turn)) AS weight
 FROM (SELECT conv_id, turn, term, tf * idf AS r FROM ({NEW_TERMS}) JOIN vocab USING (term))""", ["weight"], 6)
def tfidf_apply(spark, d):
    """A vocabulary fitted on one table applied to another; unseen terms are ignored."""
    documents = texts(spark, d)
    model = T.tfidf_fit(T.term_counts(documents, ["doc_id"], "text", single=True), documents.count())
    return T.tfidf_transform(model, T.term_counts(texts(spark, d, "conversations"), ["conv_id", "turn"], "text"), ["conv_id", "turn"])


def _grams(tokens: str) -> str:
    """One row per n-gram, n = 1..3, from a table (doc, w) of token lists."""
    return " UNION ALL ".join(
        f"SELECT doc, array_to_string(w[i:i + {n - 1}], ' ') AS term FROM (SELECT doc, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM ({tokens}))"
        for n in (1, 2, 3))


GRAMS = f"SELECT doc, term, count(*) AS tf FROM ({_grams(f'SELECT doc_id AS doc, {WORDS1} AS w FROM documents')}) GROUP BY ALL"


def _gram_counts(documents):
    return T.term_counts(documents, ["doc_id"], "text", lambda t: X.words(t, X.WORDS_1PLUS), (1, 2, 3), single=True)


@register("tfidf_fit_ngrams", ctes(*tfidf_ctes(GRAMS, "SELECT count(*) FROM documents", 2)) + "SELECT * FROM vocab", ["idf"], 6)
def tfidf_fit_ngrams(spark, d):
    documents = texts(spark, d)
    return T.tfidf_fit(_gram_counts(documents), documents.count(), 2).vocabulary


@register("tfidf_ngrams", ctes(*tfidf_ctes(GRAMS, "SELECT count(*) FROM documents", 2)) + """SELECT doc AS doc_id, count(*) AS terms, sum(weight) AS total,
 max(weight) AS strongest FROM weights GROUP BY doc""", ["total", "strongest"], 6)
def tfidf_ngrams(spark, d):
    documents = texts(spark, d)
    counts = _gram_counts(documents)
    weights = T.tfidf_transform(T.tfidf_fit(counts, documents.count(), 2), counts, ["doc_id"])
    return weights.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.sum("weight").alias("total"), F.max("weight").alias("strongest"))


ITEM_TERMS = r"""SELECT customer_id AS doc, term, count(*) AS tf FROM (SELECT customer_id, unnest(regexp_extract_all(lower('ITEM_' || item_id), '[\p{L}\p{N}_]{2,}')) AS term FROM tx) GROUP BY ALL"""
ITEM_WORDS = ["item_brand", *[str(i) for i in range(10, 26)]]


@register("tfidf_wide", ctes(TX, *tfidf_ctes(ITEM_TERMS, "SELECT count(DISTINCT customer_id) FROM tx")) + "SELECT doc AS customer_id, " + ", ".join(
    f"""coalesce(max(weight) FILTER (WHERE term = '{w}'), 0) AS "tfidf_{w}" """ for w in ITEM_WORDS) + " FROM weights GROUP BY doc",
    [f"tfidf_{w}" for w in ITEM_WORDS], 6)
def tfidf_wide(spark, d):
    items = transactions(spark, d).select("customer_id", X.tag("ITEM_", F.col("item_id")).alias("item"))
    counts = T.term_counts(items, ["customer_id"], "item")
    model = T.tfidf_fit(counts, items.select("customer_id").distinct().count())
    return T.tfidf_wide(T.tfidf_transform(model, counts, ["customer_id"]), ["customer_id"], ITEM_WORDS)


TOKENS = r"""list_filter(string_split(translate(lower(text), '!"#$%&()*+,-./:;<=>?@[\]^_`{|}~' || chr(9) || chr(10), repeat(' ', 34)), ' '), lambda t: t <> '')"""
VOCAB = f"vocab AS (SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) AS id FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY token)"


@register("fit_vocab", ctes(VOCAB) + "SELECT * FROM vocab")
def fit_vocab(spark, d):
    return T.fit_vocab(texts(spark, d), "text")


@register("max_len", f"SELECT max(len({TOKENS})) AS max_len FROM documents")
def max_len(spark, d):
    return T.max_len(texts(spark, d), "text")


@register("to_padded_ids", ctes(VOCAB, f"flat AS (SELECT conv_id, turn, unnest({TOKENS}) AS token, generate_subscripts({TOKENS}, 1) AS pos FROM conversations)") + """
SELECT conv_id, turn, array_to_string(list_concat(coalesce(ids, []), list_resize([]::BIGINT[], CAST(60 - len(coalesce(ids, [])) AS BIGINT), 0)), ' ') AS ids
FROM conversations LEFT JOIN (SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM (SELECT conv_id, turn, pos, id,
 row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos DESC) AS back FROM flat JOIN vocab USING (token)) WHERE back <= 60 GROUP BY ALL) USING (conv_id, turn)""")
def to_padded_ids(spark, d):
    documents, conversations = texts(spark, d), texts(spark, d, "conversations")
    length = T.padding_length(documents, "text")
    ids = T.to_padded_ids(conversations, ["conv_id", "turn"], "text", T.fit_vocab(documents, "text"), length)
    return ids.select("conv_id", "turn", F.array_join("ids", " ").alias("ids"))


CHUNK = 20
SEQ = ("seq AS (SELECT customer_id, item_id, item_qty, item_amt, " + days_sql('"InvoiceDate"', '(SELECT max("InvoiceDate") FROM tx)') + """ AS days,
 row_number() OVER (PARTITION BY customer_id ORDER BY "InvoiceDate" DESC, item_id, item_qty, item_amt) AS position FROM tx)""")


@register("sequence_steps", ctes(TX, SEQ) + "SELECT * FROM seq")
def sequence_steps(spark, d):
    df = stored_transactions(spark, d)
    return Q.sequence_steps(df, reference_date(df)).drop("InvoiceDate")


@register("sequence", ctes(TX, SEQ) + f"""SELECT customer_id, (position - 1) // {CHUNK} AS part, count(*) AS steps,
 string_agg(item_id, ', ' ORDER BY position) AS categorical_sequence_items, string_agg(CAST(item_qty AS VARCHAR), ', ' ORDER BY position) AS continuous_sequence_qty,
 string_agg(CAST(item_amt AS VARCHAR), ', ' ORDER BY position) AS continuous_sequence_amt, string_agg(CAST(days AS VARCHAR), ', ' ORDER BY position) AS continuous_sequence_days
 FROM seq GROUP BY ALL""")
def sequence(spark, d):
    df = stored_transactions(spark, d)
    return Q.sequence(Q.sequence_steps(df, reference_date(df)), steps_per_row=CHUNK)


@register("first_steps", ctes(TX, SEQ) + "SELECT customer_id, position, item_id, item_amt, days FROM seq WHERE position <= 60")
def first_steps(spark, d):
    df = stored_transactions(spark, d)
    return Q.first_steps(Q.sequence_steps(df, reference_date(df)), T.MAX_STEPS).select("customer_id", "position", "item_id", "item_amt", "days")


@register("to_numeric_seq", ctes(TX, SEQ) + """SELECT customer_id, array_to_string(list_concat(q, list_resize([]::DOUBLE[], CAST(60 - len(q) AS BIGINT), 0)), ' ') AS qty,
 array_to_string(list_concat(g, list_resize([]::DOUBLE[], CAST(60 - len(g) AS BIGINT), 0)), ' ') AS days FROM
 (SELECT customer_id, list(item_qty ORDER BY position) AS q, list(CAST(days AS DOUBLE) ORDER BY position) AS g FROM seq WHERE position <= 60 GROUP BY customer_id)""")
def to_numeric_seq(spark, d):
    df = stored_transactions(spark, d)
    texts = Q.sequence(Q.first_steps(Q.sequence_steps(df, reference_date(df)), T.MAX_STEPS))
    steps = T.to_numeric_seq(texts, ["customer_id"], ["continuous_sequence_qty", "continuous_sequence_days"])
    return steps.select("customer_id", F.array_join(F.col("steps.continuous_sequence_qty").cast("array<string>"), " ").alias("qty"),
                        F.array_join(F.col("steps.continuous_sequence_days").cast("array<string>"), " ").alias("days"))
