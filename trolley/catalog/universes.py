"""Training and scoring universes."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import (TARGET_LIST, TARGETS, TX, block_sql, ctes, days_sql, event_purchases, filled_sql, gap_names, gaps_sql, labels_sql,
                                  register, stored_transactions, table, widen_sql)
from trolley.catalog.texts import tfidf_ctes
from trolley.functions import text as X
from trolley.functions.dates import micros
from trolley.operators import rfm
from trolley.operators import text as T
from trolley.plans import universe as U

KINDS = ("sum", "min", "max")
CUST, PAIR = ["customer_id"], ["customer_id", "item_id"]
O_CUST, O_PAIR = ["origin", *CUST], ["origin", *PAIR]
WANTED = f"wanted AS (SELECT * FROM tx WHERE item_id IN ({TARGET_LIST}))"
LABELS = [f"Target_{t}" for t in TARGETS]


def _cells(measures):
    return [f"{m}_{t}" for m in measures for t in TARGETS]


FIXED, FIXED_NAMES, FIXED_DOUBLES = block_sql("past", PAIR, "rd", rfm.WINDOWS, fill_before=True, letter="R")
TENURE = f"""tenure AS (SELECT customer_id, {days_sql('max(rd)', 'max("InvoiceDate")')} AS "T_L", {days_sql('max(rd)', 'min("InvoiceDate")')} AS "T_F" FROM past GROUP BY customer_id)"""


@register("universe_fixed", ctes(
    TX, WANTED, 'r AS (SELECT max("InvoiceDate") - INTERVAL 60 DAY AS rd FROM tx)', 'past AS (SELECT * FROM wanted, r WHERE "InvoiceDate" <= rd)',
    f"pairs AS ({FIXED})", f"wide AS ({widen_sql('pairs', CUST, TARGETS, FIXED_NAMES)})", TENURE,
    f"""lab AS ({labels_sql('(SELECT * FROM wanted, r WHERE "InvoiceDate" > rd)', CUST)})""")
    + f"SELECT customer_id, {filled_sql([*_cells(FIXED_NAMES), 'T_L', 'T_F'])}, {', '.join(chr(34) + c + chr(34) for c in LABELS)} FROM lab LEFT JOIN wide USING (customer_id) LEFT JOIN tenure USING (customer_id)",
    _cells(FIXED_DOUBLES))
def universe_fixed(spark, d):
    return U.universe_fixed(stored_transactions(spark, d), TARGETS).rows


@register("universe_fixed_items", ctes(TX) + f"""SELECT customer_id, item_id, item_qty, item_amt, {days_sql('"InvoiceDate"', 'rd')} AS days,
 row_number() OVER (PARTITION BY customer_id ORDER BY "InvoiceDate" DESC, item_id, item_qty, item_amt) AS position
 FROM tx, (SELECT max("InvoiceDate") - INTERVAL 60 DAY AS rd FROM tx) WHERE "InvoiceDate" <= rd AND customer_id IN
 (SELECT customer_id FROM tx WHERE "InvoiceDate" > (SELECT max("InvoiceDate") - INTERVAL 60 DAY FROM tx) AND item_id IN (""" + TARGET_LIST + "))")
def universe_fixed_items(spark, d):
    return U.universe_fixed(stored_transactions(spark, d), TARGETS).items.drop("InvoiceDate")


@register("score_universe_wide", ctes(
    TX, WANTED, 'r AS (SELECT max("InvoiceDate") AS rd FROM tx)', "past AS (SELECT * FROM wanted, r)",
    f"pairs AS ({FIXED})", f"wide AS ({widen_sql('pairs', CUST, TARGETS, FIXED_NAMES)})", TENURE)
    + f"SELECT c_custkey AS customer_id, {filled_sql([*_cells(FIXED_NAMES), 'T_L', 'T_F'])} FROM customer LEFT JOIN wide ON wide.customer_id = c_custkey LEFT JOIN tenure ON tenure.customer_id = c_custkey",
    _cells(FIXED_DOUBLES))
def score_universe_wide(spark, d):
    template = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    return U.score_universe_wide(stored_transactions(spark, d), TARGETS, template).rows


def origin_ctes(n: int, step: int) -> list[str]:
    """One row per universe: its end (latest purchase up to the reference date before) and reference date."""
    parts = [f"""o1 AS (SELECT 1 AS origin, max("InvoiceDate") AS "end", max("InvoiceDate") - INTERVAL {step} DAY AS rd FROM tx)"""]
    for i in range(2, n + 1):
        parts.append(f"""o{i} AS (SELECT {i} AS origin, max("InvoiceDate") AS "end", max("InvoiceDate") - INTERVAL {step} DAY AS rd FROM tx WHERE "InvoiceDate" <= (SELECT rd FROM o{i - 1}))""")
    return [*parts, "origins AS (" + " UNION ALL ".join(f"SELECT CAST(origin AS BIGINT) AS origin, \"end\", rd FROM o{i}" for i in range(1, n + 1)) + ")"]


@register("origins", ctes(TX, *origin_ctes(6, 30)) + 'SELECT origin, CAST(CAST(rd AS DATE) AS VARCHAR) AS rd, CAST(CAST("end" AS DATE) AS VARCHAR) AS "end" FROM origins')
def origins(spark, d):
    rows = [(o, str(rd.date()), str(end.date())) for o, rd, end in U.origins(stored_transactions(spark, d), 6, 30)]
    return spark.createDataFrame(rows, "origin long, rd string, `end` string")


EVENT_TX = """tx AS (SELECT user_id AS customer_id, event_type AS item_id, event_id AS transaction_id, ts AS "InvoiceDate", value AS item_qty, value AS item_amt FROM events)"""


@register("origins_events", ctes(EVENT_TX, *origin_ctes(6, 3)) + 'SELECT origin, epoch_us(rd) AS rd, epoch_us("end") AS "end" FROM origins')
def origins_events(spark, d):
    """Origins whose reference dates fall inside a day."""
    rows = [(o, str(rd), str(end)) for o, rd, end in U.origins(event_purchases(spark, d), 6, 3)]
    named = spark.createDataFrame(rows, "origin long, rd string, `end` string")
    return named.select("origin", *[micros(F.col(c).cast("timestamp_ntz")).alias(c) for c in ("rd", "end")])


ROLL_PAIR, ROLL_NAMES, ROLL_DOUBLES = block_sql("past", O_PAIR, "rd", rfm.WINDOWS_LONG, letter="R", amount=KINDS, quantity=KINDS)
ROLL_CUST, ROLL_CNAMES, ROLL_CDOUBLES = block_sql("past", O_CUST, "rd", rfm.WINDOWS_LONG, "C", letter="T", amount=KINDS, quantity=KINDS, sep="_")
ROLL_CTES = [TX, WANTED, *origin_ctes(6, 30), 'past AS (SELECT * FROM wanted JOIN origins ON "InvoiceDate" <= rd)',
             'after AS (SELECT * FROM wanted JOIN origins ON "InvoiceDate" > rd AND "InvoiceDate" <= "end")']


def _stacked_sql(pair, names, cust, cnames, label_source):
    return (f", pairs AS ({pair}), wide AS ({widen_sql('pairs', O_CUST, TARGETS, names)}), cust AS ({cust}), lab AS ({labels_sql(label_source, O_CUST)}) "
            f"SELECT origin, customer_id, {filled_sql([*_cells(names), *cnames])}, {', '.join(chr(34) + c + chr(34) for c in LABELS)} "
            "FROM lab LEFT JOIN wide USING (origin, customer_id) LEFT JOIN cust USING (origin, customer_id)")


@register("universe_rolling", ctes(*ROLL_CTES).rstrip() + _stacked_sql(ROLL_PAIR, ROLL_NAMES, ROLL_CUST, ROLL_CNAMES, "after"), [*_cells(ROLL_DOUBLES), *ROLL_CDOUBLES])
def universe_rolling(spark, d):
    return U.universe_rolling(stored_transactions(spark, d), TARGETS).rows


ROLL_TERMS = r"""SELECT (origin, customer_id) AS doc, term, count(*) AS tf FROM (SELECT origin, customer_id, unnest(regexp_extract_all(lower('ITEM_' || item_id), '[\p{L}\p{N}_]{2,}')) AS term FROM past SEMI JOIN after USING (origin, customer_id)) GROUP BY ALL"""


@register("universe_rolling_tfidf", ctes(*ROLL_CTES, *tfidf_ctes(ROLL_TERMS, "SELECT count(*) FROM (SELECT DISTINCT origin, customer_id FROM after)"))
          + "SELECT doc[1] AS origin, doc[2] AS customer_id, term, weight FROM weights", ["weight"], 6)
def universe_rolling_tfidf(spark, d):
    universe = U.universe_rolling(stored_transactions(spark, d), TARGETS)
    counts = T.term_counts(universe.items, O_CUST, "item")
    return T.tfidf_transform(T.tfidf_fit(counts, universe.labelled.count()), counts, O_CUST)


POPULAR = 5
NEAR = f"""popular AS (SELECT origin, item_id FROM tx JOIN origins ON "InvoiceDate" <= "end" GROUP BY origin, item_id QUALIFY row_number() OVER (PARTITION BY origin ORDER BY count(*) DESC, item_id) <= {POPULAR})"""


def _gap_universe_sql():
    """Gap columns depend on the data's popular items, so the check is in the long form."""
    return (ctes(TX, *origin_ctes(6, 30), NEAR, f"listed AS (SELECT * FROM popular UNION SELECT origin, unnest([{TARGET_LIST}]) FROM origins)",
                 "common AS (SELECT item_id FROM listed GROUP BY item_id HAVING count(*) = (SELECT count(*) FROM origins))",
                 'past AS (SELECT tx.*, origin, rd FROM tx JOIN origins ON "InvoiceDate" <= rd SEMI JOIN listed ON listed.origin = origins.origin AND listed.item_id = tx.item_id)',
                 f'lab AS (SELECT DISTINCT origin, customer_id FROM tx JOIN origins ON "InvoiceDate" > rd AND "InvoiceDate" <= "end" WHERE item_id IN ({TARGET_LIST}))',
                 f"g AS ({gaps_sql('past', O_PAIR)})", "base AS (SELECT DISTINCT origin, customer_id FROM past SEMI JOIN lab USING (origin, customer_id))")
            + f"SELECT origin, customer_id, c.item_id, {filled_sql(gap_names())} FROM base CROSS JOIN common c LEFT JOIN g USING (origin, customer_id, item_id)")


@register("universe_gaps", _gap_universe_sql(), gap_names())
def universe_gaps(spark, d):
    rows = U.universe_gaps(stored_transactions(spark, d), TARGETS, popular=POPULAR).rows
    items = [c[len("DayDiffMean_"):] for c in rows.columns if c.startswith("DayDiffMean_")]
    cells = F.array(*[F.struct(F.lit(i).alias("item_id"), *[F.col(f"`{m}_{i}`").alias(m) for m in gap_names()]) for i in items])
    return rows.select(*O_CUST, F.explode(cells).alias("c")).select(*O_CUST, "c.*")


VISITS = """visits AS (SELECT customer_id, "InvoiceDate" AS day, row_number() OVER (PARTITION BY customer_id ORDER BY "InvoiceDate" DESC) AS k FROM (SELECT DISTINCT customer_id, "InvoiceDate" FROM tx))"""
LAST_PAIR, LAST_NAMES, LAST_DOUBLES = block_sql("past", O_PAIR, "rd", rfm.WINDOWS_LONG, span="R_F", amount=("mean",))
LAST_CUST, LAST_CNAMES, LAST_CDOUBLES = block_sql("past", O_CUST, "rd", rfm.WINDOWS_LONG, "C", span="T_F", amount=("mean",))
LAST_CTES = [TX, WANTED, VISITS, "peeled AS (SELECT w.*, p.origin FROM wanted w CROSS JOIN (SELECT unnest([1, 2, 3, 4])::BIGINT AS origin) p LEFT JOIN visits v ON v.customer_id = w.customer_id AND v.k = p.origin - 1"
             ' WHERE p.origin = 1 OR w."InvoiceDate" < v.day)',
             'ranked AS (SELECT *, dense_rank() OVER (PARTITION BY origin, customer_id ORDER BY "InvoiceDate" DESC) AS rank FROM peeled)',
             'past AS (SELECT *, max("InvoiceDate") OVER (PARTITION BY origin, customer_id) AS rd FROM ranked WHERE rank > 1)']


@register("universe_last_visit", ctes(*LAST_CTES).rstrip() + _stacked_sql(LAST_PAIR, LAST_NAMES, LAST_CUST, LAST_CNAMES, "(SELECT * FROM ranked WHERE rank = 1)"),
          [*_cells(LAST_DOUBLES), *LAST_CDOUBLES])
def universe_last_visit(spark, d):
    return U.universe_last_visit(stored_transactions(spark, d), TARGETS).rows


def _long_sql(keys, feature_rows, base):
    """Pair and customer blocks of ``feature_rows`` (with rd) onto the base pairs."""
    pair = [*keys, "item_id"]
    by = ", ".join(keys)
    pairs, names, doubles = block_sql("target_past", pair, "rd", rfm.WINDOWS_LONG, span="R_F", net=True)
    cust, cnames, cdoubles = block_sql("past", keys, "rd", rfm.WINDOWS_LONG, "C", amount=("mean",), net=True)
    text = (f""", past AS ({feature_rows}), target_past AS (SELECT * EXCLUDE (rd), max("InvoiceDate") OVER (PARTITION BY {by}) AS rd FROM past WHERE item_id IN ({TARGET_LIST})),
 pairs AS ({pairs}), cust AS ({cust}), span AS (SELECT {by}, {days_sql('max("InvoiceDate")', 'min("InvoiceDate")')} AS "T_F" FROM target_past GROUP BY {by}),
 impp AS (SELECT {by}, item_id AS "IMPP", count(*) AS "IMPP_count" FROM past GROUP BY {by}, item_id QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, item_id) = 1),
 base AS ({base}) SELECT base.*, {filled_sql([*names, *cnames, 'T_F', 'IMPP_count'])}, coalesce("IMPP", '999') AS "IMPP" FROM base LEFT JOIN pairs USING ({', '.join(pair)})
 LEFT JOIN cust USING ({by}) LEFT JOIN span USING ({by}) LEFT JOIN impp USING ({by})""")
    return text, [*doubles, *cdoubles]


LONG_PAST = """SELECT tx.*, p.k AS origin, max("InvoiceDate") OVER (PARTITION BY p.k, tx.customer_id) AS rd FROM tx JOIN visits p ON p.customer_id = tx.customer_id AND "InvoiceDate" < p.day WHERE p.k <= 6"""
LONG_BASE = f"""SELECT origin, customer_id, i.item_id, CASE WHEN y.item_id IS NULL THEN 0 ELSE 1 END AS "Target" FROM (SELECT DISTINCT origin, customer_id FROM bought) c
 CROSS JOIN (SELECT unnest([{TARGET_LIST}]) AS item_id) i LEFT JOIN (SELECT DISTINCT origin, customer_id, item_id FROM bought) y USING (origin, customer_id, item_id)"""
LONG, LONG_DOUBLES = _long_sql(O_CUST, LONG_PAST, LONG_BASE)
BOUGHT = f"""bought AS (SELECT tx.*, p.k AS origin FROM tx JOIN visits p ON p.customer_id = tx.customer_id AND "InvoiceDate" = p.day WHERE p.k <= 6 AND item_id IN ({TARGET_LIST}) AND item_qty > 0)"""


@register("universe_long", ctes(TX, VISITS, BOUGHT).rstrip() + LONG, LONG_DOUBLES)
def universe_long(spark, d):
    return U.universe_long(stored_transactions(spark, d), TARGETS).rows


LONG_TERMS = r"""SELECT (origin, customer_id) AS doc, term, count(*) AS tf FROM (SELECT origin, customer_id, unnest(regexp_extract_all(lower('ITEM_' || item_id), '[\p{L}\p{N}_]{2,}')) AS term
 FROM past SEMI JOIN bought USING (origin, customer_id) WHERE item_id IN (""" + TARGET_LIST + ")) GROUP BY ALL"


@register("universe_long_tfidf", ctes(TX, VISITS, BOUGHT, f"past AS ({LONG_PAST})", f"counts AS ({LONG_TERMS})", "n AS (SELECT count(*) * 10 AS n FROM (SELECT DISTINCT origin, customer_id FROM bought))",
          "vocab AS (SELECT term, ln((1 + (SELECT n FROM n)) / (1.0 + 10 * count(*))) + 1 AS idf FROM counts GROUP BY term)") + """SELECT doc[1] AS origin, doc[2] AS customer_id, term,
 tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc)) AS weight FROM counts JOIN vocab USING (term)""", ["weight"], 6)
def universe_long_tfidf(spark, d):
    """Item-list weights of the long universe, whose rows repeat each customer once per target."""
    universe = U.universe_long(stored_transactions(spark, d), TARGETS)
    items = universe.items.filter(F.col("item_id").isin(*TARGETS)).select(*O_CUST, X.tag("ITEM_", F.col("item_id")).alias("item"))
    counts = T.term_counts(items, O_CUST, "item")
    documents = universe.labelled.count()
    return T.tfidf_transform(T.tfidf_fit(counts, documents, copies=len(TARGETS)), counts, O_CUST)


SCORE_BASE = f"""SELECT customer_id, item_id FROM (SELECT DISTINCT customer_id FROM target_past) CROSS JOIN (SELECT DISTINCT item_id FROM target_past)"""
SCORE, SCORE_DOUBLES = _long_sql(CUST, 'SELECT tx.*, max("InvoiceDate") OVER (PARTITION BY customer_id) AS rd FROM tx', SCORE_BASE)


@register("score_universe", ctes(TX).rstrip() + SCORE, SCORE_DOUBLES)
def score_universe(spark, d):
    return U.score_universe(stored_transactions(spark, d), TARGETS).rows
