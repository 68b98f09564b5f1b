"""Text cleaning, tokens, term weights and word-vector features."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions import text as tx
from graniteflow.functions.hashing import hash_int
from graniteflow.operators import ordering, split, vectorize
from graniteflow.plans.catalog import query
from graniteflow.session import partitions_for, spread
from graniteflow.plans.views import (
    HASHTAGS, LEGAL, TOKENS, doc_tokens, hashtag_rows, legal_tokens, sql_hash, sql_unit, sql_word_vectors,
    with_sql, word_vectors,
)

SQL_CLEAN = r"""
regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(
replace(replace(replace(replace(regexp_replace({c}, '(?m)^https?://.*[\r\n]*', '', 'g'),
 '<br />', ' '), '&quot;', '"'), '&#39;', '"'), chr(10), ' '), ' u ', ' you '), '`', ''),
 ' +', ' ', 'g'), '!{{2,}}', '!', 'g'), '\?{{2,}}', '?', 'g'), '&amp;', 'and'), chr(13), ' '),
 '[^\x00-\x7F]', '', 'g'), '<.*?>', '', 'g')"""


@query("clean_pages", f"SELECT page_id, md5(c) AS clean_md5, length(c) AS n_chars FROM (SELECT page_id, {SQL_CLEAN.format(c='html')} AS c FROM pages)")
def clean_pages(t):
    out = spread(t.pages.select("page_id", "html")).select("page_id", tx.clean_text("html").alias("c"))
    return out.select("page_id", F.md5("c").alias("clean_md5"), F.length("c").cast("bigint").alias("n_chars"))


@query("clean_documents", f"SELECT doc_id, {SQL_CLEAN.format(c='text')} AS clean FROM documents")
def clean_documents(t):
    return spread(t.documents.select("doc_id", "text")).select("doc_id", tx.clean_text("text").alias("clean"))


@query("optional_cleaner", f"""
SELECT doc_id, true AS cleaned, length({SQL_CLEAN.format(c='text')}) AS n_chars FROM documents
UNION ALL SELECT doc_id, false, length(text) FROM documents""")
def optional_cleaner(t):
    from graniteflow.operators.classify import Cleaner

    rows = spread(t.documents.select("doc_id", "text"))
    both = [
        Cleaner(inputCol="text", outputCol="out", enabled=flag).transform(rows).select(
            "doc_id", F.lit(flag).alias("cleaned"), F.length("out").cast("bigint").alias("n_chars")
        )
        for flag in (True, False)
    ]
    return both[0].unionByName(both[1])


@query("tokenize", with_sql(TOKENS, "SELECT doc_id, token, count(*) AS n FROM tokens GROUP BY ALL"))
def tokenize(t):
    return doc_tokens(t).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("sentences", r"""
SELECT doc_id, count(*) AS n_sentences, CAST(max(length(s)) AS BIGINT) AS longest
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?]\s+')) AS s FROM documents) GROUP BY 1""")
def sentences(t):
    return tx.sentences(spread(t.documents.select("doc_id", "text")), "text").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.max(F.length("sentence")).cast("bigint").alias("longest")
    )


@query("legal_words", with_sql(LEGAL, "SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM legal GROUP BY 1"))
def legal_words(t):
    counts = vectorize.count_terms(legal_tokens(t))
    return counts.groupBy(F.col("term").alias("token")).agg(
        F.sum("tf").alias("n"), F.count(F.lit(1)).alias("n_docs")
    )


@query("stem_vocabulary")
def stem_vocabulary(t):
    words = legal_tokens(t).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return words.select("token", tx.stem("token").alias("stem"), "n")


def plural_lemmas(t):
    """A lemma table of the words that end in s."""
    plural = F.col("token").endswith("s") & (F.length("token") > 3)
    return legal_tokens(t).where(plural).select(
        F.col("token").alias("form"), F.lit("n").alias("pos"),
        F.substring(F.col("token"), F.lit(1), F.length("token") - 1).alias("lemma"),
    ).distinct()


@query("lemmatize", with_sql(LEGAL, """lemmas AS (
  SELECT DISTINCT token AS form, 'n' AS pos, substr(token, 1, length(token)-1) AS lemma
  FROM legal WHERE token LIKE '%s' AND length(token) > 3)""", """
SELECT coalesce(lemma, token) AS lemma, count(*) AS n, count(DISTINCT token) AS n_forms
FROM legal LEFT JOIN lemmas ON token = form GROUP BY 1"""))
def lemmatize(t):
    words, table = legal_tokens(t), plural_lemmas(t)
    forms = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return tx.lemmatize(forms, table).groupBy("lemma").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_forms")
    )


@query("strip_hashtags", with_sql(HASHTAGS, r"""
rounds(doc_id, txt, names, i) AS (
  SELECT doc_id, marked, names, 0 FROM hashtags
  UNION ALL SELECT doc_id, replace(txt, '#'||names[i+1], ''), names, i+1 FROM rounds WHERE i < len(names))""",
  "SELECT doc_id, md5(trim(txt, ' ')) AS stripped_md5, length(trim(txt, ' ')) AS n_chars FROM rounds WHERE i = len(names)"))
def strip_hashtags(t):
    out = hashtag_rows(t).select("doc_id", tx.strip_hashtags("marked", "names").alias("s"))
    return out.select("doc_id", F.md5("s").alias("stripped_md5"), F.length("s").cast("bigint").alias("n_chars"))


@query("split_words", r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(trim(text, ' '), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS n_words FROM documents""")
def split_words(t):
    return t.documents.select("doc_id", F.size(tx.split_words("text")).cast("bigint").alias("n_words"))


@query("parse_list", with_sql(LEGAL, "SELECT doc_id, count(DISTINCT token) AS n_keywords, max(token) AS last_keyword FROM legal WHERE length(token) >= 8 GROUP BY 1"))
def parse_list(t):
    long_words = F.array_distinct(F.filter(tx.legal_words(tx.tokens("text")), lambda w: F.length(w) >= 8))
    literal = F.concat(F.lit("['"), F.array_join(long_words, "', '"), F.lit("']"))
    rows = t.documents.select("doc_id", F.when(F.size(long_words) > 0, literal).otherwise("[]").alias("keywords"))
    parsed = rows.select("doc_id", tx.parse_list("keywords").alias("k")).where(F.size("k") > 0)
    return parsed.select("doc_id", F.size("k").cast("bigint").alias("n_keywords"), F.array_max("k").alias("last_keyword"))


@query("distinct_genres", r"""
SELECT count(DISTINCT g) AS n_values
FROM (SELECT unnest(string_split(p_type||'|'||replace(p_name,' ','|'), '|')) AS g FROM part)""")
def distinct_genres(t):
    genres = F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|")))
    return tx.distinct_values(t.part.select(genres.alias("genres")), "genres", "|")


COUNTS = LEGAL + """,
counts AS (SELECT doc_id, token AS term, count(*) AS tf FROM legal GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df FROM counts GROUP BY 1 HAVING count(*) >= 3)"""


@query("count_terms", with_sql(COUNTS, "SELECT doc_id, term, tf, df FROM counts JOIN vocab USING (term)"))
def count_terms(t):
    return vectorize.count_terms(legal_tokens(t), min_df=3)


WEIGHTS = COUNTS + """,
raw AS (SELECT doc_id, term, tf, tf*(ln((1.0+(SELECT count(*) FROM documents))/(1.0+df))+1) AS raw
        FROM counts JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, tf, raw/sqrt(sum(raw*raw) OVER (PARTITION BY doc_id)) AS w FROM raw)"""


@query("tfidf", with_sql(WEIGHTS, "SELECT doc_id, term, round(w, 6) AS w FROM weights"))
def tfidf(t):
    rows = vectorize.tfidf(legal_tokens(t, together=True), t.documents, min_df=3)
    return rows.select("doc_id", "term", F.round("w", 6).alias("w"))


@query("top_terms", with_sql(WEIGHTS, """
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, w FROM (
  SELECT doc_id, term, round(w, 6) AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 6) DESC, term) AS rank FROM weights)
WHERE rank <= 5"""))
def top_terms(t):
    return ordering.top_per_group(tfidf(t), ["doc_id"], ["-w", "term"], 5).select("doc_id", "rank", "term", "w")


@query("tfidf_frozen", with_sql(TOKENS, f"""
docs AS (SELECT doc_id, {sql_unit(11, 'doc_id')} < 0.2 AS is_test FROM documents)""", """
counts AS (SELECT doc_id, is_test, token AS term, count(*) AS tf FROM tokens JOIN docs USING (doc_id) GROUP BY ALL)""", """
vocab AS (SELECT term, ln((1.0+(SELECT count(*) FROM docs WHERE NOT is_test))/(1.0+count(*)))+1 AS idf
          FROM counts WHERE NOT is_test GROUP BY 1 HAVING count(*) >= 5)""", """
raw AS (SELECT doc_id, term, tf*idf AS raw FROM counts JOIN vocab USING (term) WHERE is_test)""", """
SELECT doc_id, term, round(raw/sqrt(sum(raw*raw) OVER (PARTITION BY doc_id)), 6) AS w FROM raw"""))
def tfidf_frozen(t):
    texts = t.documents.select("doc_id", "text")
    docs = split.with_test_flag(texts.repartition(partitions_for(texts), "doc_id"), "doc_id", 0.2, seed=11)
    words = lambda d: d.select("doc_id", F.explode(tx.tokens("text")).alias("token"))
    train, test = docs.where(~F.col("is_test")), docs.where("is_test")
    model = vectorize.TfidfModel.fit(words(train), train, min_df=5)
    return model.transform(words(test)).select("doc_id", "term", F.round("w", 6).alias("w"))


KEYWORDS = TOKENS + """,
keywords AS (SELECT DISTINCT doc_id, token AS word FROM tokens WHERE length(token) >= 6)"""
VECS = sql_word_vectors("keywords", "word")


def _keywords(t):
    return doc_tokens(t).where(F.length("token") >= 6).select("doc_id", F.col("token").alias("word")).distinct()


def _rounded(df, dim, digits=6):
    return df.select("doc_id", "n_known", *[F.round(f"f{j}", digits).alias(f"f{j}") for j in range(dim)])


def _sql_embed(fold):
    cells = ", ".join(f"round(coalesce({fold}(v{j}), 0.0), 6) AS f{j}" for j in range(8))
    return with_sql(KEYWORDS, VECS, f"""
SELECT d.doc_id, count(known.word) AS n_known, {cells}
FROM documents d LEFT JOIN keywords k ON d.doc_id = k.doc_id LEFT JOIN known ON k.word = known.word GROUP BY 1""")


@query("embed_keywords", _sql_embed("sum"))
def embed_keywords(t):
    words = _keywords(t)
    return _rounded(vectorize.embed_keywords(words, t.documents, word_vectors(words, "word"), "doc_id", 8), 8)


@query("embed_average", _sql_embed("avg"))
def embed_average(t):
    words = _keywords(t)
    out = vectorize.embed_keywords(words, t.documents, word_vectors(words, "word"), "doc_id", 8, mean=True)
    return _rounded(out, 8)


@query("embedding_dim_sweep", with_sql(KEYWORDS, VECS, "sums AS (SELECT d.doc_id, " + ", ".join(
    f"coalesce(sum(v{j}), 0.0) AS f{j}" for j in range(8)) + """
FROM documents d LEFT JOIN keywords k ON d.doc_id = k.doc_id LEFT JOIN known ON k.word = known.word GROUP BY 1)""",
    " UNION ALL ".join(f"SELECT CAST({d} AS INTEGER) AS dim, round(avg(sqrt("
                       + "+".join(f"f{j}*f{j}" for j in range(d)) + f")), 6) AS mean_norm FROM sums" for d in (2, 4, 8))))
def embedding_dim_sweep(t):
    words = _keywords(t)
    long = vectorize.embedding_dim_sweep(words, t.documents, word_vectors(words, "word"), "doc_id", [2, 4, 8])
    norms = long.groupBy("doc_id", "dim").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    return norms.groupBy("dim").agg(F.round(F.avg("norm"), 6).alias("mean_norm"))


@query("shuffle_documents", f"SELECT doc_id, {sql_hash(4, 'doc_id')} AS place FROM documents")
def shuffle_documents(t):
    return split.shuffle(t.documents, "doc_id", 4).select("doc_id", hash_int("doc_id", seed=4).alias("place"))
