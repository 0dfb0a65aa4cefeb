"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.scalar import clean_label, clean_name
from marketloom.llm import contamination, cooccurrence, mixing, spam, tokens, topn
from marketloom.plans.registry import Registry
from marketloom.session import cut_lineage
from marketloom.sources.tables import Tables

REGISTRY = Registry()
query = REGISTRY.query

PAIR_SQL = """
    WITH d AS (SELECT DISTINCT user_id AS u, item_id AS i FROM {table} WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
         c AS (SELECT i, count(*) AS n FROM d GROUP BY 1 HAVING count(*) >= 5),
         k AS (SELECT u, i FROM d SEMI JOIN c USING (i)),
         p AS (SELECT a.i AS item_a, b.i AS item_b, count(*) AS n_ab FROM k a JOIN k b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2 HAVING count(*) >= 5),
         t AS (SELECT count(DISTINCT u) AS n_baskets FROM d),
         r AS (SELECT item_a, item_b, x.n AS n_a, y.n AS n_b, n_ab, n_baskets FROM p JOIN c x ON x.i = item_a JOIN c y ON y.i = item_b, t)
"""
MIN_COMMON, MIN_LIFT = 5, 10


@query("p3_found", PAIR_SQL.format(table="contact_pairs") + "SELECT item_a, item_b FROM r WHERE n_ab * n_baskets >= 10 * n_a * n_b")
def p3_found(t: Tables) -> DataFrame:
    return cooccurrence.item_pairs(t.contact_pairs, "user_id", "item_id", MIN_COMMON, MIN_LIFT).select("item_a", "item_b")


def with_lift(pairs: DataFrame) -> DataFrame:
    return pairs.select("item_a", "item_b", "n_a", "n_b", "n_ab", F.round(F.col("n_ab") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b")), 6).alias("lift"))


LIFT_SQL = "SELECT item_a, item_b, n_a, n_b, n_ab, round(n_ab * n_baskets / CAST(n_a * n_b AS DOUBLE), 6) AS lift FROM r"


@query("p3_contact_pairs", PAIR_SQL.format(table="contact_pairs") + LIFT_SQL)
def p3_contact_pairs(t: Tables) -> DataFrame:
    """All pairs of items contacted by at least five common users, with their lift."""
    return with_lift(cooccurrence.item_pairs(t.contact_pairs, "user_id", "item_id", MIN_COMMON))


@query("p3_event_pairs", PAIR_SQL.format(table="fact_user_events") + LIFT_SQL)
def p3_event_pairs(t: Tables) -> DataFrame:
    """The same by user over all events."""
    return with_lift(cooccurrence.item_pairs(t.events, "user_id", "item_id", MIN_COMMON))


TOP_SQL = """
    WITH d AS (SELECT DISTINCT * FROM contact_pairs),
         s AS (SELECT lower(trim(city_name)) AS city_name, category, item_id, CAST(sum(count) AS BIGINT) AS contacts FROM d WHERE city_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3),
         r AS (SELECT *, row_number() OVER (PARTITION BY city_name, category ORDER BY contacts DESC NULLS LAST, item_id) AS rank FROM s)
"""


def top_items(t: Tables) -> DataFrame:
    rows = t.contact_pairs.distinct().filter("city_name is not null and category is not null")
    scored = rows.groupBy(clean_name(F.col("city_name")).alias("city_name"), "category", "item_id").agg(F.sum("count").alias("contacts"))
    return topn.top_n(scored, ["city_name", "category"], "item_id", "contacts", 5)


@query("p7_found", TOP_SQL + "SELECT city_name, category, item_id FROM r WHERE rank <= 5")
def p7_found(t: Tables) -> DataFrame:
    return top_items(t).select("city_name", "category", "item_id")


@query("p7_top_items", TOP_SQL + "SELECT city_name, category, item_id, contacts, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5")
def p7_top_items(t: Tables) -> DataFrame:
    """The same with contacts and rank."""
    return top_items(t)


RUN_SQL = """
    WITH n AS (SELECT doc_id AS id, 0 AS kind, text FROM documents UNION ALL SELECT eval_id, 1, text FROM eval_items),
         w AS (SELECT id, kind, string_split(trim(regexp_replace(replace(strip_accents(lower(nfc_normalize(text))), 'đ', 'd'), '[^\\p{L}\\p{Nd}]+', ' ', 'g')), ' ') AS w FROM n WHERE text IS NOT NULL),
         p AS (SELECT id, kind, w, unnest(generate_series(1, len(w) - 11)) AS x FROM w WHERE len(w) >= 12),
         g AS (SELECT id, kind, x, array_to_string(w[x:x + 11], ' ') AS g FROM p),
         m AS (SELECT DISTINCT d.id AS doc_id, e.id AS eval_id, d.x FROM g d JOIN g e ON d.g = e.g WHERE d.kind = 0 AND e.kind = 1)
"""


@query("p8_found", RUN_SQL + "SELECT DISTINCT doc_id, eval_id FROM m")
def p8_found(t: Tables) -> DataFrame:
    return contamination.find_leaks(t.documents, "doc_id", "text", t.eval_items, "eval_id", "text")


@query(
    "p8_runs",
    RUN_SQL
    + """, i AS (SELECT *, x - lag(x, 1, -99) OVER (PARTITION BY doc_id, eval_id ORDER BY x) > 12 AS begins FROM m),
         s AS (SELECT *, sum(begins::INT) OVER (PARTITION BY doc_id, eval_id ORDER BY x) AS run FROM i)
         SELECT doc_id, eval_id, min(x) - 1 AS first_word, max(x) - min(x) + 12 AS n_words FROM s GROUP BY doc_id, eval_id, run""",
)
def p8_runs(t: Tables) -> DataFrame:
    """Which words of the document each leaked stretch holds."""
    return contamination.find_leaks(t.documents, "doc_id", "text", t.eval_items, "eval_id", "text", spans=True).select("doc_id", "eval_id", "first_word", "n_words")


@query("p8_spans")
def p8_spans(t: Tables) -> DataFrame:
    """Where in the document each leaked stretch stands."""
    return contamination.find_leaks(t.documents, "doc_id", "text", t.eval_items, "eval_id", "text", spans=True)


#: Long-form and checked sources come later in training. Weights at the start, middle and end.
SCHEDULE = {"listing_desc": (1.5, 1.0, 0.5), "qa_thread": (1.2, 1.0, 0.8), "legal_faq": (0.5, 1.0, 1.5), "glossary": (0.5, 1.0, 1.5), "area_guide": (0.8, 1.0, 1.2)}


#: Beyond what small sources can give within their repeats.
LARGE_TOTAL = 2.0


def labelled(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text", clean_label(F.col("source")).alias("source"))


def counted(t: Tables) -> DataFrame:
    """Stored once, so that no text is tokenised twice."""
    return cut_lineage(tokens.count_tokens(labelled(t), "text", ["doc_id", "source"]))


def mixture(t: Tables) -> DataFrame:
    return mixing.mix(counted(t), "doc_id", "source", "n_tokens", t.source_weights, SCHEDULE)


@query("p9_mixture")
def p9_mixture(t: Tables) -> DataFrame:
    """Which document stands where in training, as often as its source may be repeated."""
    return mixture(t)


@query("p9_shares")
def p9_shares(t: Tables) -> DataFrame:
    """The shares of all tokens that the mixture reaches."""
    records = counted(t)
    mixed = mixing.mix(records, "doc_id", "source", "n_tokens", t.source_weights, SCHEDULE)
    return mixing.report(mixed, records, "source", "n_tokens", t.source_weights)


@query("p9_training_order")
def p9_training_order(t: Tables) -> DataFrame:
    """The texts themselves, as often and in the order as they stand in training."""
    return mixing.records_in_order(mixture(t), labelled(t), "doc_id")


def by_length(t: Tables) -> tuple[DataFrame, int]:
    """Characters as sizes, which SQL can count, and a total of twice all of them."""
    records = labelled(t).select("doc_id", "source", F.length("text").cast("bigint").alias("size"))
    total = records.filter("source is not null").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return records, int(LARGE_TOTAL * total)


def segment_sql() -> str:
    """Rows (source, start, weight, slope, before, after) of the integrated schedule."""
    rows = [(s, *x) for s in SCHEDULE for x in mixing.integrated(SCHEDULE, s, mixing.KNOTS)]
    return ", ".join(f"('{s}', " + ", ".join(f"{v!r}::DOUBLE" for v in x) + ")" for s, *x in rows)


MIX_SQL = f"""
    WITH RECURSIVE r AS (SELECT doc_id, regexp_replace(lower(trim(source)), '[ \\-]+', '_', 'g') AS source, length(text) AS size FROM documents WHERE source IS NOT NULL AND length(text) > 0),
         s AS (SELECT source, sum(size)::DOUBLE AS supply FROM r GROUP BY 1),
         k AS (SELECT s.source, supply, max_repeats, target_share / sum(target_share) OVER () AS share, supply * max_repeats AS cap FROM s JOIN source_weights w ON w.source = s.source WHERE target_share > 0 AND max_repeats > 0),
         z AS (SELECT floor({LARGE_TOTAL} * sum(size)) AS total FROM r),
         -- levels are tried by halving: the volume at a level is what all sources give
         h AS (SELECT 0 AS turn, 0::DOUBLE AS low, (SELECT max(cap / share) FROM k) AS high
               UNION ALL SELECT turn + 1, CASE WHEN v < total THEN m ELSE low END, CASE WHEN v < total THEN high ELSE m END
               FROM (SELECT turn, low, high, (low + high) / 2 AS m, (SELECT sum(least(cap, share * (low + high) / 2)) FROM k) AS v, (SELECT total FROM z) AS total FROM h WHERE turn < 200)),
         l AS (SELECT high AS level FROM h WHERE turn = 200),
         p AS (SELECT source, supply, share, share * (SELECT total FROM z) AS wanted, least(cap, share * (SELECT level FROM l)) AS demand, max_repeats FROM k),
         a AS (SELECT r.*, p.supply, p.demand, unnest(generate_series(0, least(max_repeats, ceil(demand / supply)::BIGINT) - 1)) AS repeat FROM r JOIN p USING (source)),
         m AS (SELECT *, repeat * supply + sum(size) OVER (PARTITION BY source, repeat ORDER BY ('0x' || substr(md5(doc_id || '/' || repeat || '/0'), 1, {mixing.KEY_DIGITS}))::BIGINT, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS middle FROM a),
         c AS (SELECT * FROM m WHERE middle <= demand)
"""


@query(
    "p9_positions_by_length",
    MIX_SQL
    + f""", g(source, start, weight, slope, before, after) AS (VALUES {segment_sql()}),
         n AS (SELECT c.*, middle / demand AS done, g.*, row_number() OVER (PARTITION BY doc_id, repeat ORDER BY after) AS first FROM c LEFT JOIN g ON g.source = c.source AND middle / demand <= after)
         SELECT doc_id, source, repeat, size, round(CASE WHEN start IS NULL THEN done ELSE start + CASE WHEN weight + sqrt(greatest(weight * weight + 2 * slope * (done - before), 0)) = 0 THEN 0 ELSE 2 * (done - before) / (weight + sqrt(greatest(weight * weight + 2 * slope * (done - before), 0))) END END, 5) AS position FROM n WHERE first = 1""",
)
def p9_positions_by_length(t: Tables) -> DataFrame:
    """A mixture of twice all characters: sources that run out leave their part to the others."""
    records, total = by_length(t)
    return mixing.mix(records, "doc_id", "source", "size", t.source_weights, SCHEDULE, total=total, fill=True).withColumn("position", F.round("position", 5))


@query(
    "p9_shares_by_length",
    MIX_SQL
    + """, o AS (SELECT source, sum(size)::BIGINT AS size, count(*) AS n_records, max(repeat) + 1 AS most_repeats FROM c GROUP BY 1)
         SELECT w.source, w.target_share, coalesce(o.size, 0) AS size, round(coalesce(o.size / sum(o.size::DOUBLE) OVER (), 0), 6) AS share, coalesce(n_records, 0) AS n_records, coalesce(most_repeats, 0) AS most_repeats,
                coalesce(supply, 0)::BIGINT AS supply, coalesce(round(wanted), 0)::BIGINT AS wanted, coalesce(round(greatest(wanted - demand, 0)), 0)::BIGINT AS missing
         FROM source_weights w LEFT JOIN o USING (source) LEFT JOIN p USING (source)""",
)
def p9_shares_by_length(t: Tables) -> DataFrame:
    """What each source gives to that mixture, and how much it lacks."""
    records, total = by_length(t)
    mixed = mixing.mix(records, "doc_id", "source", "size", t.source_weights, SCHEDULE, total=total, fill=True)
    return mixing.report(mixed, records, "source", "size", t.source_weights, total, fill=True).withColumn("share", F.round("share", 6))


@query("p10_found")
def p10_found(t: Tables) -> DataFrame:
    return spam.text_scores(t.documents, "doc_id", "text").filter(spam.is_stuffed()).select("doc_id")


@query("p10_scores")
def p10_scores(t: Tables) -> DataFrame:
    """Mean mutual information of neighbouring words and the shares that p10_found is decided by, for every document."""
    scores = spam.text_scores(t.documents, "doc_id", "text")
    kind = F.when(spam.is_stuffed(), "stuffed").when(spam.is_salad(), "salad").otherwise("sentences")
    return scores.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("mean_pmi", "excessive", "flagged")], kind.alias("kind"))
