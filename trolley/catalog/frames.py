"""Training universes with their TF-IDF columns, and scoring frames replayed from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import (TARGET_LIST, TARGETS, TX, block_sql, ctes, filled_sql, gap_names, gaps_sql, register, stored_transactions, table,
                                  widen_sql)
from trolley.catalog.texts import tfidf_ctes
from trolley.catalog.universes import (CUST, KINDS, LABELS, LAST_CTES, NEAR, O_CUST, PAIR, POPULAR, ROLL_CDOUBLES, ROLL_CNAMES, ROLL_CTES, ROLL_CUST, ROLL_DOUBLES,
                                       ROLL_NAMES, ROLL_PAIR, ROLL_TERMS, _cells, labels_sql, origin_ctes)
from trolley.operators import rfm
from trolley.plans import frames as P
from trolley.session import scratch_path

TERMS = ["10", "item_brand"]  # the words of two letters and more in the tagged targets
TERM_COLUMNS = [f"tfidf_{t}" for t in TERMS]
SCORE_TERMS = r"""SELECT customer_id AS doc, term, count(*) AS tf FROM (SELECT customer_id, unnest(regexp_extract_all(lower({tag} || item_id), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {source}) GROUP BY ALL"""


def template(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))


def score_ctes(source: str, tag: str = "'ITEM_'") -> list[str]:
    """Weights of new lists under the fitted vocabulary: sweights(doc, term, weight)."""
    return [f"scounts AS ({SCORE_TERMS.format(tag=tag, source=source)})", "sraw AS (SELECT doc, term, tf * idf AS r FROM scounts JOIN vocab USING (term))",
            "sweights AS (SELECT doc, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc)) AS weight FROM sraw)"]


def term_columns(weights: str) -> str:
    return "SELECT doc, " + ", ".join(f"""max(weight) FILTER (WHERE term = '{t}') AS "tfidf_{t}" """ for t in TERMS) + f" FROM {weights} GROUP BY doc"


ROLL_VOCAB = tfidf_ctes(ROLL_TERMS, "SELECT count(*) FROM (SELECT DISTINCT origin, customer_id FROM after)")


@register("universe_rolling_wide", ctes(*ROLL_CTES, *ROLL_VOCAB, f"terms AS ({term_columns('weights')})", f"pairs AS ({ROLL_PAIR})", f"wide AS ({widen_sql('pairs', O_CUST, TARGETS, ROLL_NAMES)})",
                                        f"cust AS ({ROLL_CUST})", f"lab AS ({labels_sql('after', O_CUST)})")
          + f"SELECT origin, customer_id, {filled_sql([*_cells(ROLL_NAMES), *ROLL_CNAMES])}, {', '.join(chr(34) + c + chr(34) for c in LABELS)}, {filled_sql(TERM_COLUMNS, '0')} "
          "FROM lab LEFT JOIN wide USING (origin, customer_id) LEFT JOIN cust USING (origin, customer_id) LEFT JOIN terms ON doc = (lab.origin, lab.customer_id)",
          [*_cells(ROLL_DOUBLES), *ROLL_CDOUBLES, *TERM_COLUMNS])
def universe_rolling_wide(spark, d):
    """The rolling training universe with its TF-IDF columns joined to the rows."""
    return P.fit_rolling(stored_transactions(spark, d), TARGETS)[0]


def _scored_sql(before: list[str], source: str, pair, names, cust, cnames) -> str:
    return (ctes(*before, source, *score_ctes("spast"), f"terms AS ({term_columns('sweights')})", f"pairs AS ({pair})", f"wide AS ({widen_sql('pairs', CUST, TARGETS, names)})", f"cust AS ({cust})")
            + f"SELECT c_custkey AS customer_id, {filled_sql([*_cells(names), *cnames])}, {filled_sql(TERM_COLUMNS, '0')} FROM customer LEFT JOIN wide ON wide.customer_id = c_custkey "
            "LEFT JOIN cust ON cust.customer_id = c_custkey LEFT JOIN terms ON doc = c_custkey")


S_PAIR, S_NAMES, S_DOUBLES = block_sql("spast", PAIR, "rd", rfm.WINDOWS_LONG, letter="R", amount=KINDS, quantity=KINDS)
S_CUST, S_CNAMES, S_CDOUBLES = block_sql("spast", CUST, "rd", rfm.WINDOWS_LONG, "C", letter="T", amount=KINDS, quantity=KINDS, sep="_")


@register("score_universe_rolling", _scored_sql([*ROLL_CTES, *ROLL_VOCAB], 'spast AS (SELECT w.*, r.rd FROM wanted w, (SELECT max("InvoiceDate") AS rd FROM tx) r)', S_PAIR, S_NAMES, S_CUST, S_CNAMES),
          [*_cells(S_DOUBLES), *S_CDOUBLES, *TERM_COLUMNS])
def score_universe_rolling(spark, d):
    """The rolling universe's columns as of the last date; its description is stored and read back first."""
    tx = stored_transactions(spark, d)
    path = scratch_path(spark, "frame")
    P.fit_rolling(tx, TARGETS)[1].save(spark, path)
    return P.score(P.load_frame(spark, path), tx, template(spark, d))


V_PAIR, V_NAMES, V_DOUBLES = block_sql("spast", PAIR, "rd", rfm.WINDOWS_LONG, span="R_F", amount=("mean",))
V_CUST, V_CNAMES, V_CDOUBLES = block_sql("spast", CUST, "rd", rfm.WINDOWS_LONG, "C", span="T_F", amount=("mean",))
LAST_VOCAB = tfidf_ctes(ROLL_TERMS.replace(" SEMI JOIN after USING (origin, customer_id)", ""), "SELECT count(*) FROM (SELECT DISTINCT origin, customer_id FROM ranked WHERE rank = 1)")


@register("score_universe_last_visit", _scored_sql([*LAST_CTES, *LAST_VOCAB], 'spast AS (SELECT *, max("InvoiceDate") OVER (PARTITION BY customer_id) AS rd FROM wanted)', V_PAIR, V_NAMES, V_CUST, V_CNAMES),
          [*_cells(V_DOUBLES), *V_CDOUBLES, *TERM_COLUMNS])
def score_universe_last_visit(spark, d):
    """The last-visit universe's columns, dated back from each customer's newest target purchase."""
    tx = stored_transactions(spark, d)
    return P.score(P.fit_last_visit(tx, TARGETS)[1], tx, template(spark, d))


GAP_TERMS = r"""SELECT (origin, customer_id) AS doc, term, count(*) AS tf FROM (SELECT origin, customer_id, unnest(regexp_extract_all(lower(item_id), '[\p{L}\p{N}_]{2,}')) AS term FROM past SEMI JOIN lab USING (origin, customer_id)) GROUP BY ALL"""
GAPS = gap_names()


@register("score_universe_gaps", ctes(
    TX, *origin_ctes(6, 30), NEAR, f"listed AS (SELECT * FROM popular UNION SELECT origin, unnest([{TARGET_LIST}]) FROM origins)",
    "common AS (SELECT item_id FROM listed GROUP BY item_id HAVING count(*) = (SELECT count(*) FROM origins))",
    'past AS (SELECT tx.*, origin, rd FROM tx JOIN origins ON "InvoiceDate" <= rd SEMI JOIN listed ON listed.origin = origins.origin AND listed.item_id = tx.item_id)',
    f'lab AS (SELECT DISTINCT origin, customer_id FROM tx JOIN origins ON "InvoiceDate" > rd AND "InvoiceDate" <= "end" WHERE item_id IN ({TARGET_LIST}))',
    *tfidf_ctes(GAP_TERMS, "SELECT count(*) FROM (SELECT DISTINCT origin, customer_id FROM past SEMI JOIN lab USING (origin, customer_id))"),
    f"now AS (SELECT item_id FROM tx GROUP BY item_id QUALIFY row_number() OVER (ORDER BY count(*) DESC, item_id) <= {POPULAR} UNION SELECT unnest([{TARGET_LIST}]))",
    "spast AS (SELECT * FROM tx SEMI JOIN now USING (item_id))", *score_ctes("spast", "''"), f"g AS ({gaps_sql('(SELECT * FROM tx SEMI JOIN common USING (item_id))', PAIR)})")
    + f"""SELECT c_custkey AS customer_id, unnest([{', '.join(f"'{m}_'" for m in GAPS)}]) || c.item_id AS feature, coalesce(unnest([{', '.join(f'"{m}"' for m in GAPS)}]), 999) AS value
 FROM customer CROSS JOIN common c LEFT JOIN g ON g.customer_id = c_custkey AND g.item_id = c.item_id
 UNION ALL SELECT c_custkey, 'tfidf_' || v.term, coalesce(weight, 0) FROM customer CROSS JOIN vocab v LEFT JOIN sweights s ON s.doc = c_custkey AND s.term = v.term""", ["value"])
def score_universe_gaps(spark, d):
    """The gap universe's columns on the newest data; which columns depends on popularity, so in the long form."""
    tx = stored_transactions(spark, d)
    frame = P.fit_gaps(tx, TARGETS, popular=POPULAR)[1]
    rows = P.score(frame, tx, template(spark, d))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in frame.columns])
    return rows.select("customer_id", F.explode(cells).alias("c")).select("customer_id", "c.*")
