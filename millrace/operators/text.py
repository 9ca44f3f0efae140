"""Text jobs over a text column: counting, cleaning, term weights, similarity labels, prompts, tokens.

Words are exploded and counted with a combine before each shuffle. Word keys are skewed by nature, so
joins on a word carry no hint: adaptive execution broadcasts the smaller side when its measured size
allows and splits the hot words otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import dictionaries
from millrace.operators.ordered import join_groups, running
from millrace.session import materialise

# English function words dropped by the stop-word count.
STOP_WORDS = (
    "a about after all an and any are as at be been but by can could did do does for from had has have he her "
    "him his how i if in into is it its may me more my no not of on one or our out she so some such than that the "
    "their them then there these they this to up was we were what when which who will with would you your"
).split()

# Words dropped by the token filter.
HEADER_WORDS = ["from", "subject"]

# The characters the pattern class for white space holds.
WHITE = " \t\n\x0b\f\r"



def words(df: DataFrame, text: str, splitter: str = "whitespace", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word. ``blank`` splits on single blanks and keeps empty words; ``whitespace`` splits
    on any run of white space and drops them."""
    pattern = {"blank": " ", "whitespace": "\\s+"}[splitter]
    # The outer form: for the plain one, the optimiser adds a filter that splits every text twice.
    split = df.select(*keep, F.explode_outer(F.split(text, pattern)).alias("word"))
    return split.where("word IS NOT NULL" if splitter == "blank" else "word <> ''")


def word_count(df: DataFrame, text: str, splitter: str = "whitespace", lower: bool = True) -> DataFrame:
    found = words(df, text, splitter)
    key = F.lower("word") if lower else F.col("word")
    return found.groupBy(key.alias("word")).agg(F.count(F.lit(1)).alias("n"))


def word_count_without(df: DataFrame, text: str, stop_words: Sequence[str], top: int) -> DataFrame:
    """Most frequent words that are not on the stop list."""
    counts = word_count(df, text).where(~F.col("word").isin(list(stop_words)))
    return counts.orderBy(F.col("n").desc(), "word").limit(top)


def char_count(df: DataFrame, text: str) -> DataFrame:
    """Characters (lower case, white space left out) by frequency. Words are counted first and only the
    distinct ones are taken apart, so far fewer rows are exploded than the text has characters."""
    counts = word_count(df, text)
    chars = counts.select(F.explode(F.split("word", "")).alias("letter"), "n")
    return chars.groupBy("letter").agg(F.sum("n").alias("n"))


def word_lengths(df: DataFrame, text: str) -> DataFrame:
    """Words per length, with the letters they add up to."""
    return (
        words(df, text)
        .groupBy(F.length("word").alias("length"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("word")).alias("letters"))
    )


def strip_html(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tags and runs of non-ASCII characters become a blank, then white space collapses."""

    def clean(name: str) -> Column:
        no_tags = F.regexp_replace(name, "<.*?>", " ")
        return F.regexp_replace(F.regexp_replace(no_tags, "[^\\x00-\\x7F]+", " "), "\\s+", " ")

    return df.withColumns({name: clean(name) for name in columns})


def parse_list(column: str | Column) -> Column:
    """``"['a', 'b']"`` to an array; an empty list gives one empty element, as split does."""
    return F.split(F.regexp_replace(column, "[\\[\\]'\" ]", ""), ",")


def multi_hot(df: DataFrame, keep: Sequence[str], array: str, element: str = "element") -> DataFrame:
    """The ones of a multi-hot encoding, one row for each distinct non-empty element of a row.

    Long form, so that neither the schema nor the output grows with the number of distinct elements.
    """
    return df.select(*keep, F.explode(F.array_distinct(array)).alias(element)).where(F.col(element) != "")


def top_elements(df: DataFrame, array: str, k: int) -> list[str]:
    """The k most frequent elements (k is a parameter, so the list is small)."""
    counts = df.select(F.explode(array).alias("x")).groupBy("x").count()
    return [row["x"] for row in counts.orderBy(F.col("count").desc(), "x").limit(k).collect()]


def presence(array: str, values: Sequence[str]) -> Column:
    """0/1 array telling which of the values the array holds."""
    return F.array(*[F.array_contains(array, v).cast("int") for v in values])


def tokens(text: str | Column, min_length: int = 4, drop: Sequence[str] = HEADER_WORDS) -> Column:
    """Lower-case runs of word characters of at least ``min_length``, minus a drop list."""
    split = F.split(F.lower(text), "\\W")
    dropped = [F.lit(w) for w in drop]
    return F.filter(split, lambda w: (F.length(w) >= min_length) & ~w.isin(*dropped) if dropped else F.length(w) >= min_length)


def term_counts(df: DataFrame, doc: str, token_array: str) -> DataFrame:
    """Long form ``(doc, term, tf)``."""
    return (
        df.select(doc, F.explode_outer(token_array).alias("term"))
        .where("term IS NOT NULL")
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def tfidf(
    df: DataFrame,
    doc: str,
    token_array: str,
    min_tf: int = 1,
    min_df: float = 0.0,
    max_df: float = 1.0,
    vocabulary_size: int | None = None,
    min_doc_freq: int = 0,
) -> DataFrame:
    """Long form ``(doc, term, tf, tfidf)`` of a count vectoriser followed by inverse document weights.

    The vocabulary holds terms found in a share of the documents between ``min_df`` and ``max_df``, the
    most frequent ones if a size is given. Counts below ``min_tf`` are dropped from a document. The
    weight is ln((N + 1) / (df + 1)) over what is left, and 0 below ``min_doc_freq`` documents.
    """
    documents = df.count()
    counts = term_counts(df, doc, token_array)
    kept_tf = F.when(F.col("tf") >= min_tf, 1)
    vocabulary = (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"), F.count(kept_tf).alias("kept_df"))
        .where(F.col("df").between(min_df * documents, max_df * documents))
    )
    if vocabulary_size is not None:
        vocabulary = vocabulary.orderBy(F.col("total").desc(), "term").limit(vocabulary_size)
    weight = F.when(
        F.col("kept_df") >= min_doc_freq, F.log((F.lit(documents) + 1.0) / (F.col("kept_df") + 1.0))
    ).otherwise(0.0)
    weights = vocabulary.select("term", weight.alias("idf"))
    if vocabulary_size is None:
        # Of unknown size: written first, so that hot words can be split in the join (see ordered.attach).
        weights = materialise(weights, "weights")
    return (
        counts.where(F.col("tf") >= min_tf)
        .join(weights, "term")
        .select(doc, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )


def zero_shot(df: DataFrame, doc: str, text: str, labels: Mapping[str, str]) -> DataFrame:
    """Score each document against label descriptions; one row per document and label.

    Cosine of term weights in the space of the words the descriptions use, so all other words are
    dropped before the first shuffle. Scores of a document add up to 1; one without any such word
    scores all labels alike.
    """
    terms = {name: sorted(set(description.lower().split())) for name, description in labels.items()}
    space = sorted({w for ws in terms.values() for w in ws})
    rows = df.count()
    found = words(df.select(doc, F.lower(text).alias(text)), text, keep=[doc]).where(F.col("word").isin(space))
    # A few rows per document, read three times below; the texts are read once.
    counts = materialise(found.groupBy(doc, "word").agg(F.count(F.lit(1)).alias("tf")), "label-words")
    idf = counts.groupBy("word").agg(F.log((F.lit(rows) + 1.0) / (F.count(F.lit(1)) + 1.0)).alias("idf"))
    weights = counts.join(idf, "word").withColumn("w", F.col("tf") * F.col("idf"))
    names = list(labels)
    # Weights of a description: idf of its words, so its norm needs the idf table: one row.
    norms = idf.agg(
        *[
            F.sqrt(F.sum(F.when(F.col("word").isin(terms[n]), F.col("idf") * F.col("idf")))).alias(f"__norm{i}")
            for i, n in enumerate(names)
        ]
    ).first()
    per_doc = weights.groupBy(doc).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__norm"),
        *[
            F.sum(F.when(F.col("word").isin(terms[n]), F.col("w") * F.col("idf")).otherwise(0.0)).alias(f"__dot{i}")
            for i, n in enumerate(names)
        ],
    )

    def cosine(i: int) -> Column:
        length = F.col("__norm") * F.lit(norms[i] or 0.0)
        return F.coalesce(F.when(length > 0, F.col(f"__dot{i}") / F.nullif(length, F.lit(0.0))), F.lit(0.0))

    scored = df.select(doc).join(per_doc, doc, "left").select(doc, *[cosine(i).alias(f"__s{i}") for i in range(len(names))])
    total = sum((F.col(f"__s{i}") for i in range(1, len(names))), F.col("__s0"))
    entries = F.array(
        *[
            F.struct(
                (-F.round(F.when(total > 0, F.col(f"__s{i}") / F.nullif(total, F.lit(0.0))).otherwise(1.0 / len(names)), 6)).alias("m"),
                F.lit(n).alias("label"),
            )
            for i, n in enumerate(names)
        ]
    )
    # Ranking a handful of labels inside the row needs no shuffle.
    ranked = scored.select(doc, F.posexplode(F.sort_array(entries)).alias("rank", "e"))
    return ranked.select(doc, F.col("e.label").alias("label"), (-F.col("e.m")).alias("score"), (F.col("rank") + 1).alias("rank"))


def few_shot_examples(df: DataFrame, doc: str, text: str, label: str, per_label: int) -> list[tuple]:
    """The first ``per_label`` documents of each label, as ``(doc, text, label)``; small by definition."""
    window = Window.partitionBy(label).orderBy(doc)
    ranked = df.where(F.col(label).isNotNull()).withColumn("__k", F.row_number().over(window))
    rows = ranked.where(F.col("__k") <= per_label).select(doc, text, label).orderBy(label, doc).collect()
    return [tuple(r) for r in rows]


def few_shot_prompt(
    df: DataFrame, text: str, examples: Sequence[tuple], instruction: str, text_tag: str, label_tag: str
) -> Column:
    """Instruction, solved examples and the open question, separated by ``###`` lines."""
    solved = [f'[{text_tag}]: "{body}"\n[{label_tag}]: {label}' for _, body, label in examples]
    head = instruction + "\n" + "".join(block + "\n###\n" for block in solved)
    return F.concat(F.lit(f'{head}[{text_tag}]: "'), F.col(text), F.lit(f'"\n[{label_tag}]:'))


def few_shot_knn(df: DataFrame, doc: str, text: str, examples: Sequence[tuple], k: int) -> DataFrame:
    """Label of each document by the k most similar examples: cosine of word counts, summed per label.

    The examples are a handful of texts given by the caller, so their word table is a literal that is
    broadcast, a document needs one column per example, and the vote happens inside its row.
    """
    bags = [_counts(body) for _, body, _ in examples]
    labels = [str(label) for _, _, label in examples]
    lengths = [sum(c * c for c in bag.values()) ** 0.5 for bag in bags]
    table = [(w, [bag.get(w) for bag in bags]) for w in sorted({w for bag in bags for w in bag})]
    shots = df.sparkSession.createDataFrame(table, "word string, c array<long>")
    found = words(df.select(doc, F.lower(text).alias(text)), text, keep=[doc])
    counts = found.groupBy(doc, "word").agg(F.count(F.lit(1)).alias("tf"))
    tf = F.col("tf")
    per_doc = (
        counts.join(shots, "word", "left")
        .groupBy(doc)
        .agg(
            F.sqrt(F.sum(tf * tf)).alias("norm"),
            *[F.sum(tf * F.get("c", F.lit(i))).alias(f"dot{i}") for i in range(len(bags))],
        )
    )
    entries = F.array(
        *[
            F.struct(
                (-F.round(F.col(f"dot{i}") / (F.col("norm") * length), 9)).alias("m"), F.lit(i).alias("i"),
                F.lit(labels[i]).alias("label"),
            )
            for i, length in enumerate(lengths)
        ]
    )
    nearest = F.slice(F.sort_array(F.filter(entries, lambda e: e["m"].isNotNull())), 1, k)
    near = per_doc.select(doc, nearest.alias("near")).where(F.size("near") > 0)

    def vote(label: str) -> Column:
        own = F.filter("near", lambda e: e["label"] == label)
        total = F.aggregate(own, F.lit(0.0), lambda total, e: total + e["m"])
        return F.when(F.size(own) > 0, F.struct(F.round(total, 6).alias("m"), F.lit(label).alias("label")))

    votes = F.array_compact(F.array(*[vote(label) for label in sorted(set(labels))]))
    best = near.select(doc, F.array_min(votes).alias("b"))
    return best.select(doc, F.col("b.label").alias("label"), (-F.col("b.m")).alias("score"))


def _counts(body: str) -> dict[str, int]:
    import re
    from collections import Counter

    return Counter(w for w in re.split("[ \\t\\n\\x0b\\f\\r]+", body.lower()) if w)


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """All words numbered from 1, most frequent first; words of equal count are ordered by a hash.

    The numbering is a running count over one global order, cut into chunks when the vocabulary is
    large; the many words of the same small count are cut along the hash.
    """
    # Written once: the numbering reads it several times and the caller usually twice more.
    counts = materialise(word_count(df, text, lower=False), "vocabulary")
    digits = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("double")
    numbered = running(counts.withColumn("h", digits), [], ["-n", "h", "word"], {"id": F.lit(1)})
    return numbered.select("word", "id", "n")


def _first_words(text: Column, max_length: int) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    # The split stops after the words that are kept; a blank text has none.
    first = F.slice(F.split(bare, "\\s+", max_length + 1), 1, max_length)
    return F.coalesce(F.when(bare != "", first), F.array().cast("array<string>"))


def pad(rows: DataFrame, ids: str) -> DataFrame:
    """Ids filled up with 0 to the longest row, and a ``mask`` of 1 for words and 0 for padding. ``rows`` is read
    twice: give a stored table."""
    longest = rows.agg(F.max(F.size(ids))).first()[0] or 0
    padding = F.lit(longest) - F.size(ids)
    mask = F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), padding))
    return rows.withColumns({ids: F.concat(ids, F.array_repeat(F.lit(0).cast("long"), padding)), "mask": mask})


def _coded(df: DataFrame, doc: str, texts: str, words: Column, table: DataFrame, found: str, kind: str) -> DataFrame:
    """(doc, column of the table for each word in turn, the words that have one): by a dictionary of each block."""
    rows = dictionaries.placed(df, [doc, texts])

    def fn(block: pa.Table, known: pa.Table) -> pa.Table:
        lists = block["words"].combine_chunks()
        at = pc.index_in(lists.flatten(), value_set=known["word"].combine_chunks())
        hit = at.is_valid()
        ends = np.concatenate([[0], np.cumsum(hit.to_numpy(zero_copy_only=False))])[lists.offsets.to_numpy() - lists.offsets[0].as_py()].astype(np.int32)
        values = known[found].combine_chunks().take(at.filter(hit))
        coded = pa.ListArray.from_arrays(pa.array(ends), values)
        back = pa.ListArray.from_arrays(pa.array(ends), known["word"].combine_chunks().take(at.filter(hit)))
        return pa.table({doc: block[doc], "found": coded, "words": back})

    schema = f"`{doc}` {df.schema[doc].dataType.simpleString()}, found array<{kind}>, words array<string>"
    return dictionaries.look_up(rows, dictionaries.block_words(rows, words), table, {"words": words}, fn, schema)


def encode(df: DataFrame, doc: str, text: str, vocab: DataFrame, max_length: int) -> DataFrame:
    """Word ids of each document, cut at ``max_length`` words, padded, with their mask. ``vocab`` should be a stored table."""
    coded = _coded(df, doc, text, _first_words(F.col(text), max_length), vocab, "id", "bigint")
    return pad(materialise(coded.select(doc, F.col("found").alias("ids")), "coded"), "ids")


def decode(df: DataFrame, doc: str, ids: str, vocab: DataFrame) -> DataFrame:
    """Ids back to text, padding skipped."""
    table = vocab.select(F.col("id").cast("string").alias("id"), "word").toDF("word", "found")
    shown = F.transform(F.filter(ids, lambda i: i > 0), lambda i: i.cast("string"))
    return _coded(df, doc, ids, shown, table, "found", "string").select(doc, F.concat_ws(" ", "found").alias("text"))


def encode_and_back(df: DataFrame, doc: str, text: str, vocab: DataFrame, max_length: int) -> DataFrame:
    """Ids, mask and the text that the ids give back. One dictionary takes both ways."""
    coded = _coded(df, doc, text, _first_words(F.col(text), max_length), vocab, "id", "bigint")
    known = coded.select(doc, F.col("found").alias("ids"), F.concat_ws(" ", "words").alias("text"))
    return pad(materialise(known, "coded"), "ids")


def _best_sentences(block: pa.Table, known: pa.Table, doc: str, min_words: int, max_words: int) -> pa.Table:
    """The chosen sentences of each document of a block, given the weight of every word."""
    by_sentence = block["words"].combine_chunks()
    inner = by_sentence.flatten()
    at = pc.index_in(inner.flatten(), value_set=known["word"].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
    # Of each word: its sentence, its document, and how often the document has it.
    sizes = np.diff(inner.offsets.to_numpy())
    per_doc = np.diff(by_sentence.offsets.to_numpy())
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    owner = np.repeat(np.arange(len(per_doc)), per_doc)
    _, same, times = np.unique(owner[sentence] * (len(known) + 1) + at, return_inverse=True, return_counts=True)
    weight = times[same] * known["idf"].to_numpy()[at] if len(at) else np.zeros(0)
    sums = np.bincount(sentence, weight, len(sizes))
    first, out = np.concatenate([[0], np.cumsum(per_doc)]), {doc: [], "summary": [], "sentences": []}
    for i, (name, texts) in enumerate(zip(block[doc].to_pylist(), block["split"].to_pylist(), strict=True)):
        own = range(first[i], first[i + 1])
        ranked = sorted((-round(float(sums[s] / sizes[s]), 6), s - first[i], int(sizes[s])) for s in own if sizes[s])
        chosen, upto = [], 0
        for _, place, length in ranked:
            if upto < min_words or upto + length <= max_words:
                chosen.append(place)
            upto += length
        if chosen:
            out[doc].append(name)
            out["summary"].append(". ".join(texts[s] for s in sorted(chosen)))
            out["sentences"].append(len(chosen))
    return pa.table([pa.array(out[doc], block[doc].type), pa.array(out["summary"], pa.string()), pa.array(out["sentences"], pa.int32())], names=list(out))


def extract_summary(df: DataFrame, doc: str, text: str, min_words: int, max_words: int) -> DataFrame:
    """The best sentences of each document in their original order.

    A sentence scores the mean over its words of count in the document times ln((N + 1) / (df + 1)).
    Sentences are taken from the best down while the summary has fewer than ``min_words`` words or the
    next one still ends within ``max_words``.

    The texts are read twice, once for the words of blocks of documents, and once, with a shuffle, to be scored whole
    in their block. Of words, only counts by block leave the rows.
    """
    rows = dictionaries.placed(df.where(F.col(text).isNotNull()), [doc, text])
    split = F.split(text, "[.!?\\n]+\\s*")
    listed = F.transform(split, lambda s: F.filter(F.split(F.lower(s), "\\s+"), lambda w: w != ""))
    # Read for the weights and for the blocks' dictionaries.
    asked = materialise(dictionaries.block_words(rows, F.flatten(listed)), "block-words")
    weights = asked.groupBy("word").agg(F.log((F.lit(df.count()) + 1.0) / (F.sum("n") + 1.0)).alias("idf"))
    schema = f"`{doc}` {df.schema[doc].dataType.simpleString()}, summary string, sentences int"

    def fn(block: pa.Table, known: pa.Table) -> pa.Table:
        return _best_sentences(block, known, doc, min_words, max_words)

    # Stored, so that a word that every block has is split in the join (see ordered.attach).
    stored = materialise(weights, "weights")
    return dictionaries.look_up(rows, asked, stored, {"split": split, "words": listed}, fn, schema)


def next_token(df: DataFrame, text: str, top_k: int, top_p: float) -> DataFrame:
    """Bigram table cut to the ``top_k`` likeliest followers of a word, and of those to the first ones
    that together reach probability ``top_p``.

    Pairs are formed inside the row. The rank filter runs before the shuffle of the window too, so a
    frequent word with millions of followers sends only ``top_k`` rows per partition.
    """
    bare = F.btrim(F.lower(text), F.lit(WHITE))
    listed = df.select(F.split(bare, "\\s+").alias("w"))
    zipped = F.arrays_zip(
        F.slice("w", F.lit(1), F.size("w") - 1).alias("a"), F.slice("w", F.lit(2), F.size("w") - 1).alias("b")
    )
    exploded = listed.select(F.explode_outer(zipped).alias("p")).where("p IS NOT NULL")
    pairs = exploded.select(F.col("p.a").alias("word"), F.col("p.b").alias("next"))
    counts = pairs.groupBy("word", "next").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("word").agg(F.sum("n").alias("total"))
    window = Window.partitionBy("word").orderBy(F.col("n").desc(), "next")
    ranked = counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_k)
    whole = join_groups(ranked, totals, ["word"])
    upto = Window.partitionBy("word").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(upto), F.lit(0))
    return (
        whole.withColumn("before", before)
        .where(F.col("before") < F.col("total") * top_p)
        .select("word", "next", "n", "rank", (F.col("n") / F.col("total")).alias("p"))
    )
