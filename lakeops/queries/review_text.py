"""2.15 review text. Rule scorers stand in for hosted models."""

from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions.columns import to_score
from lakeops.operators import text as X
from lakeops.plans import text_labels as LB
from lakeops.plans.summaries import ranked_summaries
from lakeops.queries.registry import query
from lakeops.queries.table_functions import mirror_scorer
from lakeops.session import work_dir
from lakeops.sources.writers import write_table

TOPICS = L.REVIEW_TOPICS
TEMPLATE = "[review]{text}\n[topic]{topic} ({polarity})"
_TOPIC_ROWS = ("(VALUES ('食事と飲み物'), ('機内エンターテイメント'), ('機内Wi-Fiと接続性'), ('価格に対する価値'), "
               "('地上サービス'), ('機内スタッフのサービス品質'), ('座席の快適さ')) tt(topic)")


@query("tx1_prompts", f"""
    SELECT doc_id, polarity, topic, '[review]' || text || chr(10) || '[topic]' || topic || ' (' || polarity || ')' AS prompt
    FROM documents, (VALUES ('positive'), ('negative')) pp(polarity), {_TOPIC_ROWS}""")
def tx1(t):
    return X.prompts(t.documents.select("doc_id", "text"), "text", TOPICS, ["positive", "negative"], TEMPLATE).drop("text")


@query("tx2_text_model", "SELECT doc_id, CASE WHEN contains(text, 'é') THEN NULL ELSE CAST(len(text) AS BIGINT) END AS n FROM documents")
def tx2(t):
    return X.map_text(t.documents.select("doc_id", "text"), "text", mirror_scorer).select(
        "doc_id", F.length("result").cast("bigint").alias("n"))


@query("tx3_sentiment_score", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN CAST(quality * 4 + 1 AS DOUBLE) * 0.75 END AS positive_score
    FROM documents JOIN labels USING (doc_id)""")
def tx3(t):
    emotion = F.when(F.col("lang") == "en", F.concat((F.col("quality") * 4 + 1).cast("string"), F.lit(" stars"))).otherwise("unknown")
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", X.positive_score(emotion, F.lit(0.75)).alias("positive_score"))


_HELD = "('0x' || substr(md5(concat_ws('#', doc_id, 'held')), 1, 8))::BIGINT % 5 = 0"


def _learned(t, label):
    """Labels of all documents, learned from the labelled rows outside the held-out bucket."""
    truth = t.documents.join(t.labels, "doc_id", "left")
    model = LB.learn_labels(truth.filter(~LB.held_out("doc_id")), "text", label)
    # The labels are used twice, for the accuracy and as the result.
    found = write_table(LB.label_texts(model, t.documents, "doc_id", "text"), work_dir(t.spark, "labelled"))
    rows = truth.withColumn("_held", LB.held_out("doc_id"))
    told = LB.accuracy(found, rows, "doc_id", label, F.col("_held"))
    known = rows.filter(F.col("_held") & F.col(label).isNotNull()).groupBy(label).count().agg(F.max("count") / F.sum("count")).first()[0]
    return found, told, known


@query("tx3_learned_sentiment", f"""
    SELECT doc_id, {_HELD} AS held_out, TRUE AS is_stars_times_probability, TRUE AS as_good_as_the_larger_class FROM documents""")
def tx3_learned(t):
    # Sentiment from the words: quality 1 as five stars, 0 as one.
    found, told, larger = _learned(t, "quality")
    rated = LB.stars(found, {"0": 1, "1": 5}, "doc_id").withColumn("score", X.positive_score(F.col("emotion"), F.col("probability")))
    right = (F.col("score") > 0.49) & (F.col("score") <= 5) & F.col("emotion").isin("1 star", "5 stars")
    return rated.select("doc_id", LB.held_out("doc_id").alias("held_out"), right.alias("is_stars_times_probability"),
                        F.lit(told >= larger).alias("as_good_as_the_larger_class"))


@query("tx4_learned_category", f"""
    SELECT doc_id, {_HELD} AS held_out, CASE WHEN NOT {_HELD} THEN lang END AS category, TRUE AS held_out_98_percent_right FROM documents""")
def tx4_learned(t):
    # A fixed set of categories, here the languages; held-out rows are checked by their accuracy.
    found, told, _ = _learned(t, "lang")
    held = LB.held_out("doc_id")
    return found.select("doc_id", held.alias("held_out"), F.when(~held, F.col("label")).alias("category"),
                        F.lit(told >= 0.98).alias("held_out_98_percent_right"))


# Keyword rules of the check, first match wins.
RULES = {"品質": "licen[sc]e", "接客・サービス": "(^| )the ", "コスパ・お得感": "(^| )que "}


@query("tx4_classify", """
    SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'licen[sc]e') THEN '品質' WHEN regexp_matches(lower(text), '(^| )the ') THEN '接客・サービス'
                        WHEN regexp_matches(lower(text), '(^| )que ') THEN 'コスパ・お得感' ELSE 'その他' END AS category FROM documents""")
def tx4(t):
    return t.documents.select("doc_id", X.classify("text", RULES, L.FEEDBACK_CLASSES[-1]).alias("category"))


@query("tx5_summarise", """
    SELECT doc_id, substr(trim(regexp_extract(text, '^[^.!?。！？\\n]*')), 1, 30) AS summary FROM documents""")
def tx5(t):
    return t.documents.select("doc_id", X.summarise("text", 30).alias("summary"))


@query("tx5_ranked_summary", """
    SELECT doc_id, CAST(len(list_distinct(list_filter(list_transform(regexp_split_to_array(text, '[.!?。！？\n]+'), lambda x: trim(x, ' ')), lambda x: x <> ''))) AS BIGINT)
      AS n_sentences, TRUE AS from_the_text FROM documents""")
def tx5_ranked(t):
    # The most central sentence of each document.
    out = ranked_summaries(t.documents, ["doc_id"], "text", n=1, rounds=4)
    return out.join(t.documents, "doc_id").select("doc_id", "n_sentences", F.contains(F.col("text"), F.col("summary")).alias("from_the_text"))


@query("tx6_text_to_score", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE least(greatest(value / 10, 0), 1) END AS score FROM events""")
def tx6(t):
    raw = F.when(F.col("event_type") == "error", "about 0.5").otherwise((F.col("value") / 10).cast("string"))
    return t.events.select("event_id", to_score(raw).alias("score"))


_SIDES = ("pos", "neg")
_RESULT_COLS = [f"{side}_{n}" for side in _SIDES for n in range(len(TOPICS))]
# Result n of a side: the text, its source, or nothing, by the document and the topic.
_WIDE = "SELECT doc_id, lang, " + ", ".join(
    f"CASE WHEN (doc_id + {n}) % 5 = 0 THEN NULL WHEN (doc_id + {n}) % 5 = 1 THEN '-' WHEN lang = 'fr' THEN source || ' -' "
    f"WHEN coalesce({'quality' if side == 'pos' else 'toxic'}, 0) = 1 THEN text ELSE source || ' {side}{n}' END AS {side}_{n}"
    for side in _SIDES for n in range(7)) + " FROM documents LEFT JOIN labels USING (doc_id)"


def _wide(t):
    def result(side, n):
        case = F.pmod(F.col("doc_id") + n, F.lit(5))
        mark = F.coalesce("quality" if side == "pos" else "toxic", F.lit(0))
        return (F.when(case == 0, None).when(case == 1, "-").when(F.col("lang") == "fr", F.concat("source", F.lit(" -")))
                .when(mark == 1, F.col("text")).otherwise(F.concat("source", F.lit(f" {side}{n}"))))
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "lang", *[result(side, n).alias(f"{side}_{n}") for side in _SIDES for n in range(len(TOPICS))])


_CLEAN = "SELECT doc_id, lang, " + ", ".join(
    f"coalesce(CASE WHEN contains({c}, ' -') THEN '-' ELSE {c} END, '-') AS {c}" for c in _RESULT_COLS) + f" FROM ({_WIDE})"


@query("tx7_clean_results", _CLEAN)
def tx7(t):
    return X.clean_results(_wide(t), _RESULT_COLS)


_LONG = f"WITH c AS ({_CLEAN}) SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, lang, '{topic}' AS review_category, {side}_{n} AS review_details, '{name}' AS sentiment FROM c"
    for side, name in (("pos", "positive"), ("neg", "negative"))
    for n, topic in enumerate(("食事と飲み物", "機内エンターテイメント", "機内Wi-Fiと接続性", "価格に対する価値", "地上サービス",
                               "機内スタッフのサービス品質", "座席の快適さ"))) + ") WHERE review_details <> '-'"


def _long(t):
    return X.unpivot_topics(X.clean_results(_wide(t), _RESULT_COLS), ["doc_id", "lang"], {
        name: {topic: f"{side}_{n}" for n, topic in enumerate(TOPICS)}
        for side, name in (("pos", "positive"), ("neg", "negative"))})


@query("tx8_topics_to_rows", _LONG)
def tx8(t):
    return _long(t)


@query("tx9_restartable_batches", """
    SELECT doc_id, CAST(floor(doc_id / 50) AS INTEGER) AS batch_id, CAST(len(text) AS INTEGER) AS n FROM documents""")
def tx9(t):
    out = work_dir(t.spark, "tx9")

    def work(df):
        return df.select("batch_id", "doc_id", F.length("text").alias("n"))

    docs = t.documents.select("doc_id", "text")
    done = docs.agg(F.floor(F.max("doc_id") / 100).cast("bigint") * 50).scalar()
    X.process_in_batches(docs.filter(F.col("doc_id") < done), "doc_id", 50, work, out)
    return X.process_in_batches(docs, "doc_id", 50, work, out).withColumn("batch_id", F.col("batch_id").cast("int"))


@query("tx10_voc_mart", f"SELECT 'shop.example' AS host, 'main' AS catalog, * FROM ({_LONG})")
def tx10(t):
    return X.voc_mart(_long(t), {"host": "shop.example", "catalog": "main"})


def translate_scorer():
    """Word-by-word stand-in for a translation model."""
    words = {"the": "der", "of": "von", "and": "und"}
    return lambda texts: [" ".join(words.get(w, w) for w in s.split(" ")) for s in texts]


@query("tx11_translate", """
    SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w:
             CASE w WHEN 'the' THEN 'der' WHEN 'of' THEN 'von' WHEN 'and' THEN 'und' ELSE w END), ' ') AS translated FROM documents""")
def tx11(t):
    docs = t.documents.select("doc_id", "text")
    return X.map_text(docs, "text", translate_scorer, "translated").drop("text")


@query("tx12_group_texts", """
    WITH n AS (SELECT item, text, r, (row_number() OVER (ORDER BY md5(item::VARCHAR), item) - 1) AS rn
               FROM (SELECT doc_id AS item, text, toxic AS r FROM documents LEFT JOIN labels USING (doc_id)))
    SELECT rn // 3 + 1 AS id, max(CASE WHEN rn % 3 = 0 THEN text END) AS original_1, max(CASE WHEN rn % 3 = 1 THEN text END) AS original_2,
           max(CASE WHEN rn % 3 = 2 THEN text END) AS original_3, CAST(coalesce(arg_min(r, rn) FILTER (r IS NOT NULL), 3) AS INTEGER) AS r
    FROM n GROUP BY rn // 3""")
def tx12(t):
    docs = t.documents.join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("item"), "text", F.col("toxic").alias("r"), F.md5(F.col("doc_id").cast("string")).alias("h"))
    return X.group_texts(docs, ["h", "item"], "text", ["r"])
