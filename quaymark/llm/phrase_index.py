"""Benchmark decontamination with a distributed positional inverted index, in DataFrame expressions only.

Method.  Every document's words become postings ``(term, row, pos)``, stored once for the
terms that occur in some test item; each file is a segment in term order.  For each window
of an item the ``RAREST`` words with the fewest postings are chosen.  Their lists are
adjusted by offset (``pos`` less the place in the item), so words of one occurrence of
the item meet at one ``(row, item, shift)``; only where the chosen lists intersect are the
lists of all other words of the item intersected too.  Runs of enough consecutive item
words at one shift are the matches.  With ``slop`` a word may stand so many places away
from its place in the phrase (proximity); 0 asks for exact phrases.

Sizes.  Common words cost a posting each but never meet other common words: rows after the
first intersection follow the occurrences of the chosen words.  The test vocabulary, the
chosen words and the rows with candidates are broadcast only up to ``MOST_BROADCAST``
rows; beyond it the same joins shuffle.  Nothing is collected to the driver but two counts.

Defined results: null or wordless documents have no words and no hits; null or wordless
items and items without an id match nothing; items of one text share their matches; an id
given to several texts counts once; a document row that repeats an id has a row of its
own, and a null id is kept; other columns are ignored, whatever their names; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of each window whose lists are intersected first.
RAREST = 2
#: Most rows of a table that is sent to every task.
MOST_BROADCAST = 1 << 20
#: The term of the posting that ends every document; its place is the number of words.
END = -1


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _small(df: DataFrame, most: int) -> DataFrame:
    """``df`` (a written table), marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.count() <= most else df


def sequences(items: DataFrame) -> DataFrame:
    """``(seq, w, ids)``: the distinct word sequences of ``items (item_id, text)`` and the ids that have them."""
    rows = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("id"), words_of(F.col("text")).alias("w"))
    known = rows.where(F.size("w") > 0).groupBy("w").agg(F.collect_set("id").alias("ids"))
    return materialize(known.select(F.monotonically_increasing_id().alias("seq"), "w", "ids"), "sequences")


def vocabulary(known: DataFrame) -> DataFrame:
    """``(word, term)`` of every word of the sequences, and the empty word that stands for the end of a text."""
    distinct = known.select(F.explode("w").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id())
    end = known.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term"))
    return materialize(distinct.union(end), "vocabulary")


def build(docs: DataFrame, words: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """Postings ``(term, row, doc_id, pos)`` of ``docs (doc_id, text)`` for the terms of a vocabulary, written as segments in term order."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(words_of(F.col("text")), F.array(F.lit(""))).alias("w"))
    placed = rows.select("row", "doc_id", F.posexplode("w").alias("pos", "word"))
    postings = placed.join(_small(words, most), "word").select("term", "row", "doc_id", "pos")
    return materialize(postings.sortWithinPartitions("term"), "postings")


def rarest_words(places: DataFrame, index: DataFrame, words: int) -> DataFrame:
    """``(seq, need, p, term)``: the words of each window with the fewest postings, unless one of the window's words has none.

    ``need`` is how many of them an occurrence of a window has to have.
    """
    counts = index.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("n"))
    size = F.least(F.lit(words), F.col("len"))
    start = F.sequence(F.greatest(F.lit(0), F.col("p") - size + 1), F.least(F.col("p"), F.col("len") - size))
    rows = places.join(counts, "term", "left").select("seq", "p", "term", size.alias("size"), F.coalesce("n", F.lit(0)).alias("n"), F.explode(start).alias("start"))
    window = Window.partitionBy("seq", "start")
    ranked = rows.withColumn("least", F.min("n").over(window)).withColumn("k", F.row_number().over(window.orderBy("n", "p")))
    chosen = ranked.where((F.col("k") <= RAREST) & (F.col("least") > 0))
    return materialize(chosen.select("seq", F.least(F.lit(RAREST), F.col("size")).alias("need"), "p", "term").distinct(), "rarest")


def occurrences(index: DataFrame, known: DataFrame, words_table: DataFrame, words: int = 10, slop: int = 0, most: int = MOST_BROADCAST) -> DataFrame:
    """``(row, seq, first, last)``: document words from ``first`` to ``last`` match at least one window of a sequence."""
    split = known.select("seq", F.size("w").alias("len"), F.posexplode("w").alias("p", "word"))
    places = materialize(split.join(words_table, "word").select("seq", "len", "p", "term"), "places")
    chosen = rarest_words(places, index, words)
    drift = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    lists = index.join(_small(chosen, most), "term").select("row", "seq", "need", (F.col("pos") - F.col("p")).alias("shift"), "p")
    if slop:
        lists = lists.withColumn("d", drift).withColumn("shift", F.col("shift") + F.col("d")).drop("d").distinct()
    met = lists.groupBy("row", "seq", "shift").agg(F.count("*").alias("n"), F.first("need").alias("need"))
    met = materialize(met.where("n >= need").select("row", "seq", "shift"), "met")
    rows = materialize(met.select("row").distinct(), "met_rows")
    probes = met.join(places, "seq").withColumn("pos", F.col("shift") + F.col("p"))
    if slop:
        probes = probes.withColumn("d", drift).withColumn("pos", F.col("pos") + F.col("d")).drop("d")
    near = index.join(_small(rows, most), "row", "left_semi").select("row", "pos", "term")
    hits = probes.join(near, ["row", "pos", "term"]).groupBy("row", "seq", "shift", "len", "p").agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    place = F.row_number().over(Window.partitionBy("row", "seq", "shift").orderBy("p"))
    runs = hits.withColumn("run", F.col("p") - place).groupBy("row", "seq", "shift", "run")
    runs = runs.agg(F.count("*").alias("n"), F.first("len").alias("len"), F.min("low").alias("first"), F.max("high").alias("last"))
    return materialize(runs.where(F.col("n") >= F.least(F.lit(words), F.col("len"))).select("row", "seq", "first", "last").distinct(), "occurrences")


def matches(docs: DataFrame, items: DataFrame, words: int = 10, slop: int = 0, most: int = MOST_BROADCAST) -> tuple[DataFrame, DataFrame]:
    """Documents and what they share with the items.

    The first table has ``(row, doc_id, n_words)`` of every row of ``docs``, the second
    ``(row, first, last, item_ids)`` of every occurrence of windows of ``words`` words.
    """
    known = sequences(items)
    table = vocabulary(known)
    index = build(docs, table, most)
    found = occurrences(index, known, table, words, slop, most)
    named = found.join(known.select("seq", F.col("ids").alias("item_ids")), "seq").select("row", "first", "last", "item_ids")
    ends = index.where(F.col("term") == END).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return ends, named


def contamination(docs: DataFrame, items: DataFrame, words: int = 10, slop: int = 0, most: int = MOST_BROADCAST) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids, contaminated)`` of each row of ``docs``; ``item_ids`` are strings in order."""
    ends, named = matches(docs, items, words, slop, most)
    before = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = named.select("row", "first", "last").distinct().withColumn("reached", F.coalesce(F.max("last").over(before), F.lit(-1)))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, F.col("reached")))
    hit = spans.groupBy("row").agg(F.sum(new).cast("long").alias("n_hit"))
    ids = named.select("row", "item_ids").distinct().groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    result = ends.join(hit.join(ids, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return result.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (n_hit > 0).alias("contaminated"))


def digest(found: DataFrame) -> DataFrame:
    """The contamination table with its ids as a count and a digest."""
    ids = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


def oracle(words: int = 10) -> str:
    """The digest as DuckDB SQL over ``documents`` and ``benchmark``, window by window."""
    split = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, w FROM (SELECT doc_id, {split} AS w FROM documents)),
items AS (SELECT item_id, w, least({words}, len(w)) AS k FROM (SELECT item_id, {split} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
windows AS (SELECT item_id, k, list_slice(w, s, s + k - 1) AS v FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM items)),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM docs),
hits AS (
  SELECT DISTINCT r, item_id, p, k FROM places JOIN windows ON w[p] = v[1]
  WHERE list_slice(w, p, p + k - 1) = v),
hit AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hits) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)"""
