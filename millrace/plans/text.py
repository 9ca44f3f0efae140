"""Text jobs on documents, pages and part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import text as X
from millrace.plans.registry import Tables, query
from millrace.session import materialise

_STOP_SQL = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
_WORDS_SQL = "SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents"


@query(
    "txt_word_count",
    f"""SELECT 'whitespace' AS splitter, lower(word) AS word, count(*) AS n FROM ({_WORDS_SQL}) WHERE word <> '' GROUP BY 2
        UNION ALL
        SELECT 'blank', lower(word), count(*) FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 2""",
)
def _(t: Tables):
    kinds = [X.word_count(t.documents, "text", s).withColumn("splitter", F.lit(s)) for s in ("whitespace", "blank")]
    return kinds[0].unionByName(kinds[1])


@query(
    "txt_word_count_stop",
    f"""SELECT lower(word) AS word, count(*) AS n FROM ({_WORDS_SQL}) WHERE word <> '' AND lower(word) NOT IN ({_STOP_SQL})
        GROUP BY 1 ORDER BY n DESC, 1 LIMIT 50""",
)
def _(t: Tables):
    return X.word_count_without(t.documents, "text", X.STOP_WORDS, 50)


@query(
    "txt_char_count",
    f"""SELECT letter, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT unnest(regexp_extract_all(lower(word), '(?s).')) AS letter FROM ({_WORDS_SQL})) GROUP BY 1""",
)
def _(t: Tables):
    return X.char_count(t.documents, "text")


@query(
    "txt_word_lengths",
    f"""SELECT length(word)::INTEGER AS length, count(*) AS n, CAST(sum(length(word)) AS BIGINT) AS letters
        FROM ({_WORDS_SQL}) WHERE word <> '' GROUP BY 1""",
)
def _(t: Tables):
    return X.word_lengths(t.documents, "text")


@query(
    "txt_strip_html",
    """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '<.*?>', ' ', 'g'), '[^\\x00-\\x7F]+', ' ', 'g'), '\\s+', ' ', 'g') AS url,
              regexp_replace(regexp_replace(regexp_replace(html, '<.*?>', ' ', 'g'), '[^\\x00-\\x7F]+', ' ', 'g'), '\\s+', ' ', 'g') AS html
       FROM pages""",
)
def _(t: Tables):
    return X.strip_html(t.pages, ["url", "html"])


def _listed(t: Tables):
    """Part names as bracketed quoted lists, the shape list columns have in exported files."""
    quoted = F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("']"))
    return t.part.select("p_partkey", quoted.alias("listed"))


@query(
    "txt_list_parse",
    """SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS items, len(string_split(p_name, ' '))::INTEGER AS n FROM part""",
)
def _(t: Tables):
    parsed = _listed(t).withColumn("items", X.parse_list("listed"))
    return parsed.select("p_partkey", F.concat_ws("|", "items").alias("items"), F.size("items").alias("n"))


@query(
    "txt_multi_hot",
    """WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
       SELECT DISTINCT p_partkey, word FROM w WHERE word <> ''""",
)
def _(t: Tables):
    return X.multi_hot(_listed(t).withColumn("items", X.parse_list("listed")), ["p_partkey"], "items", "word")


@query(
    "txt_topk_encode",
    """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part),
            top AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS k FROM w GROUP BY word),
            best AS (SELECT word, k FROM top WHERE k <= 5)
       SELECT p_partkey, string_agg(list_contains(string_split(p_name, ' '), word)::INTEGER::VARCHAR, ',' ORDER BY k) AS code
       FROM part, best GROUP BY p_partkey""",
)
def _(t: Tables):
    split = t.part.select("p_partkey", F.split("p_name", " ").alias("items"))
    code = X.presence("items", X.top_elements(split, "items", 5))
    return split.select("p_partkey", F.concat_ws(",", code.cast("array<string>")).alias("code"))


_TOKENS_SQL = """SELECT doc_id, unnest(string_split_regex(lower(text), '\\W')) AS term FROM documents"""
_KEPT_SQL = f"SELECT doc_id, term FROM ({_TOKENS_SQL}) WHERE length(term) >= 4 AND term NOT IN ('from', 'subject')"


@query(
    "txt_tokenize_filter",
    f"SELECT doc_id, count(*) AS n, min(term) AS lowest, max(term) AS highest FROM ({_KEPT_SQL}) GROUP BY doc_id",
)
def _(t: Tables):
    found = t.documents.select("doc_id", X.tokens("text").alias("w")).where("size(w) > 0")
    return found.select(
        "doc_id", F.size("w").cast("long").alias("n"), F.array_min("w").alias("lowest"), F.array_max("w").alias("highest")
    )


@query(
    "txt_count_tfidf",
    f"""WITH c AS (SELECT doc_id, term, count(*) AS tf FROM ({_KEPT_SQL}) GROUP BY 1, 2),
             total AS (SELECT count(*) AS n FROM documents),
             v AS (SELECT term, count(*) AS df, sum(tf) AS total, count(CASE WHEN tf >= 2 THEN 1 END) AS kept FROM c GROUP BY term),
             kept AS (SELECT term, kept FROM v, total WHERE df BETWEEN 0.05 * n AND 0.7 * n ORDER BY v.total DESC, term LIMIT 2048),
             w AS (SELECT term, CASE WHEN kept >= 20 THEN ln((n + 1.0::DOUBLE) / (kept + 1.0::DOUBLE)) ELSE 0.0 END AS idf FROM kept, total)
        SELECT doc_id, term, tf, round(tf * idf, 6) AS tfidf FROM c JOIN w USING (term) WHERE tf >= 2""",
)
def _(t: Tables):
    docs = t.documents.select("doc_id", X.tokens("text").alias("w"))
    found = X.tfidf(docs, "doc_id", "w", min_tf=2, min_df=0.05, max_df=0.7, vocabulary_size=2048, min_doc_freq=20)
    return found.withColumn("tfidf", F.round("tfidf", 6))


# Label descriptions: common words of the four languages the documents are written in.
LANGUAGES = {
    "english": "the and of that with this for have",
    "french": "le la les des que une avec pour",
    "german": "der die und das ist nicht mit den",
    "spanish": "el los que una por con para del",
}


def _zero_shot_sql() -> str:
    space = sorted({w for d in LANGUAGES.values() for w in d.split()})
    listed = ", ".join(f"'{w}'" for w in space)
    pairs = ", ".join(f"('{n}', '{w}')" for n, d in LANGUAGES.items() for w in sorted(set(d.split())))
    return f"""WITH lab(label, word) AS (VALUES {pairs}),
        c AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '\\s+')) AS word FROM documents)
              WHERE word IN ({listed}) GROUP BY 1, 2),
        i AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf FROM c GROUP BY word),
        w AS (SELECT doc_id, word, tf * idf AS w, idf FROM c JOIN i USING (word)),
        dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1),
        ln_ AS (SELECT label, sqrt(sum(idf * idf)) AS norm FROM lab JOIN i USING (word) GROUP BY 1),
        dot AS (SELECT doc_id, label, sum(w * idf) AS dot FROM w JOIN lab USING (word) GROUP BY 1, 2),
        s AS (SELECT d.doc_id, ln_.label, coalesce(dot.dot / nullif(dn.norm * ln_.norm, 0), 0) AS s
              FROM documents d CROSS JOIN ln_ LEFT JOIN dn ON dn.doc_id = d.doc_id
              LEFT JOIN dot ON dot.doc_id = d.doc_id AND dot.label = ln_.label),
        t AS (SELECT doc_id, label, round(CASE WHEN sum(s) OVER (PARTITION BY doc_id) > 0 THEN s / sum(s) OVER (PARTITION BY doc_id)
                     ELSE 1.0::DOUBLE / 4 END, 6) AS score FROM s)
        SELECT doc_id, label, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label)::INTEGER AS rank FROM t"""


@query("txt_zero_shot", _zero_shot_sql())
def _(t: Tables):
    return X.zero_shot(t.documents, "doc_id", "text", LANGUAGES)


def _labelled(t: Tables):
    return t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


_EXAMPLES_SQL = """j AS (SELECT d.doc_id, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
    ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS k FROM j WHERE quality IS NOT NULL) WHERE k <= 2)"""


@query(
    "txt_few_shot_prompt",
    f"""WITH {_EXAMPLES_SQL},
        head AS (SELECT 'For each text, describe its quality:' || chr(10) ||
                 string_agg('[Text]: "' || text || '"' || chr(10) || '[Quality]: ' || quality || chr(10) || '###' || chr(10), ''
                            ORDER BY quality, doc_id) AS h FROM ex)
        SELECT doc_id, h || '[Text]: "' || text || '"' || chr(10) || '[Quality]:' AS prompt FROM j, head WHERE quality IS NULL""",
)
def _(t: Tables):
    rows = _labelled(t)
    examples = X.few_shot_examples(rows, "doc_id", "text", "quality", 2)
    prompt = X.few_shot_prompt(rows, "text", examples, "For each text, describe its quality:", "Text", "Quality")
    return rows.where("quality IS NULL").select("doc_id", prompt.alias("prompt"))


@query(
    "txt_few_shot_knn",
    f"""WITH {_EXAMPLES_SQL},
        c AS (SELECT doc_id, quality, word, count(*) AS tf
              FROM (SELECT doc_id, quality, unnest(string_split_regex(lower(text), '\\s+')) AS word FROM j) WHERE word <> '' GROUP BY 1, 2, 3),
        n AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM c GROUP BY 1),
        e AS (SELECT doc_id AS ex_id, CAST(quality AS VARCHAR) AS label, row_number() OVER (ORDER BY quality, doc_id) AS num FROM ex),
        s AS (SELECT c.doc_id, e.num, e.label, round(sum(c.tf * x.tf) / (any_value(n.norm) * any_value(m.norm)), 9) AS sim
              FROM c JOIN c x ON c.word = x.word JOIN e ON x.doc_id = e.ex_id JOIN n ON n.doc_id = c.doc_id JOIN n m ON m.doc_id = e.ex_id
              WHERE c.quality IS NULL GROUP BY 1, 2, 3),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, num) AS k FROM s),
        v AS (SELECT doc_id, label, round(sum(sim), 6) AS score FROM k WHERE k <= 3 GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM v)
        SELECT doc_id, label, score FROM r WHERE r = 1""",
)
def _(t: Tables):
    rows = _labelled(t)
    examples = X.few_shot_examples(rows, "doc_id", "text", "quality", 2)
    return X.few_shot_knn(rows.where("quality IS NULL"), "doc_id", "text", examples, 3)


# Fixed value: the cut of the encoder.
_CUT = 1024


@query(
    "txt_token_ids",
    f"""WITH w AS (SELECT word, count(*) AS n, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM ({_WORDS_SQL}) WHERE word <> '' GROUP BY word),
        v AS (SELECT word, row_number() OVER (ORDER BY n DESC, h, word) AS id FROM w),
        d AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS words FROM documents),
        p AS (SELECT doc_id, unnest(words[1:{_CUT}]) AS word, unnest(generate_series(1, least({_CUT}, len(words)))) AS pos FROM d),
        g AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
              FROM p JOIN v USING (word) GROUP BY 1),
        m AS (SELECT max(n) AS longest FROM g)
        SELECT doc_id, concat_ws(' ', ids, nullif(repeat('0 ', longest - n)[:-2], '')) AS ids,
               repeat('1', n) || repeat('0', longest - n) AS mask, text FROM g, m""",
)
def _(t: Tables):
    vocab = materialise(X.vocabulary(t.documents, "text"), "numbered")
    return X.encode_and_back(t.documents, "doc_id", "text", vocab, _CUT).select(
        "doc_id",
        F.concat_ws(" ", F.col("ids").cast("array<string>")).alias("ids"),
        F.concat_ws("", F.col("mask").cast("array<string>")).alias("mask"),
        "text",
    )


@query(
    "txt_extract_summary",
    """WITH sp AS (SELECT doc_id, string_split_regex(text, '[.!?\\n]+\\s*') AS l FROM documents),
        s AS (SELECT * FROM (SELECT doc_id, unnest(l) AS sentence, unnest(generate_series(0, len(l) - 1)) AS s FROM sp) WHERE trim(sentence) <> ''),
        c AS (SELECT doc_id, s, word, count(*) AS c FROM (SELECT doc_id, s, unnest(string_split_regex(lower(sentence), '\\s+')) AS word FROM s)
              WHERE word <> '' GROUP BY 1, 2, 3),
        tf AS (SELECT doc_id, word, sum(c) AS tf FROM c GROUP BY 1, 2),
        i AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf FROM tf GROUP BY 1),
        sc AS (SELECT doc_id, s, round(sum(c * tf * idf) / sum(c), 6) AS score, sum(c) AS len FROM c JOIN tf USING (doc_id, word) JOIN i USING (word) GROUP BY 1, 2),
        r AS (SELECT *, sum(len) OVER (PARTITION BY doc_id ORDER BY score DESC, s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM sc)
        SELECT doc_id, string_agg(sentence, '. ' ORDER BY s) AS summary, count(*)::INTEGER AS sentences
        FROM r JOIN s USING (doc_id, s) WHERE upto - len < 20 OR upto <= 40 GROUP BY doc_id""",
)
def _(t: Tables):
    return X.extract_summary(t.documents, "doc_id", "text", 20, 40)


@query(
    "txt_next_token",
    """WITH l AS (SELECT list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT unnest(w[1:len(w) - 1]) AS word, unnest(w[2:]) AS next FROM l WHERE len(w) > 1),
        c AS (SELECT word, next, count(*) AS n FROM p GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, next) AS rank, sum(n) OVER (PARTITION BY word) AS total FROM c),
        k AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY word ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r WHERE rank <= 10)
        SELECT word, next, n, rank::INTEGER AS rank, round(n / total, 8) AS p FROM k WHERE before < total * 0.8::DOUBLE""",
)
def _(t: Tables):
    return X.next_token(t.documents, "text", 10, 0.8).withColumn("p", F.round("p", 8))
