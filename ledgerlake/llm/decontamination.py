"""Benchmark decontamination by a distributed positional inverted index, with DataFrame and SQL functions only.

The index is a written table of postings: a row (term, row, position) for each token of the training texts, in the order
of the texts, so building it shuffles nothing and a frequent term is spread over all files as its texts are. A row with
the term END closes each text; it holds the text's id and, as its position, the number of words. Postings of words that
no test term equals cannot answer any query of a test set, so :func:`build_index` leaves them out where it is given the
test words, and keeps all of them where it is not.

A phrase is found from its rarest terms: their posting lists, shifted by their offsets in the phrase to where the phrase
would start, are intersected (a group by start, partly aggregated before it moves). Each start that survives asks for
the postings of the other terms at their offsets; a start with all its terms is an occurrence. Of the index only
postings of texts with such a start move there, selected by a broadcast set of at most SLOTS numbers (beyond some
SLOTS texts with a start it selects less, and more postings move; results are the same). :func:`proximity` finds all
terms of an item within a span of words in the same order.

Broadcasts are checked: tables by test term or phrase are broadcast up to MAX_TERMS rows. Of larger ones only the rows
of keys with more than a thousandth of the rows to match are (fewer than a thousand keys, by counting), and the other
keys meet in a shuffle.

Defined results: a null text has no words; neither has one of separators alone. Null ids and repeated rows of texts give
a row each. A test item without words matches nothing; one with a null id marks hit words but is not listed; rows that
repeat an item's id are one item with the windows of all its texts. An empty table of texts gives an empty table;
without test items no text is hit. Texts are taken whole, whatever their length. Extra columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import HOT_PARTS, durable

WINDOW = 10
#: Lists that are intersected first, from the rarest term on.
RAREST = 2
#: Most rows of a table by test term that is broadcast whole.
MAX_TERMS = 1 << 20
#: Numbers that texts with a possible occurrence are folded to.
SLOTS = 1 << 18
#: The term of the row that closes a text.
END = -1
#: What separates words after A-Z are lower case, and what words are: fixed values.
SEPARATORS, WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS, -1), ""), F.array().cast("array<string>"))


class Index(NamedTuple):
    """Written tables: postings (term long, row long, position int, doc_id; with the END rows), and the words that have
    any (word string, term long, n long: its postings)."""
    postings: DataFrame
    terms: DataFrame


def _match(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (written; any number of rows a key), without a hot key in a shuffle."""
    if keyed.count() <= MAX_TERMS:
        return rows.join(F.broadcast(keyed), key)
    counts = durable(rows.join(keyed.select(key).distinct(), key, "left_semi").groupBy(key).count(), "match-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("count") > F.lit(total // HOT_PARTS)).select(key))
    often = keyed.join(hot, key, "left_semi")
    stay = rows.join(hot, key, "left_semi")
    few = often.limit(MAX_TERMS + 1).count() <= MAX_TERMS
    stay = stay.join(F.broadcast(often), key) if few else stay.join(often, key)
    move = rows.join(hot, key, "left_anti").join(keyed.join(hot, key, "left_anti"), key)
    return stay.unionByName(move)


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> Index:
    """The positional index of ``docs``; ``vocabulary`` (word) limits it to these words' postings."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"),
                       docs[text_col].alias("text"))
    given = None if vocabulary is None else durable(
        vocabulary.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "words")
    small = given is not None and given.count() <= MAX_TERMS
    if not small:
        slim = durable(slim, "texts")  # is read more than once: row numbers must stay
    closed = F.concat(words(F.col("text")), F.array(F.lit(None).cast("string")))
    tokens = slim.select("row", F.col("doc_id").alias("id"),
                         F.posexplode(closed).alias("position", "word"))
    ids = F.when(F.col("word").isNull(), F.col("id")).alias("doc_id")
    if small:
        found = tokens.join(F.broadcast(given), "word", "left").filter("term IS NOT NULL OR word IS NULL")
        postings = found.select(F.coalesce("term", F.lit(END)).alias("term"), "row", "position", ids)
    else:
        if given is None:
            given = durable(tokens.filter("word IS NOT NULL").select("word").distinct()
                            .withColumn("term", F.monotonically_increasing_id()), "words")
        ends = tokens.filter("word IS NULL").select(F.lit(END).alias("term"), "row", "position", ids)
        postings = ends.unionByName(_match(tokens.filter("word IS NOT NULL"), given, "word")
                                    .select("term", "row", "position", ids))
    postings = durable(postings, "postings")
    counts = postings.filter(F.col("term") != END).groupBy("term").agg(F.count("*").alias("n"))
    return Index(postings, durable(given.join(counts, "term").select("word", "term", "n"), "terms"))


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window): each ``size`` consecutive words of an item; an item of fewer words, but not none, is one."""
    found = items.select(items[id_col].alias("item_id"), words(items[text_col]).alias("words")).filter("size(words) > 0")
    starts = F.expr(f"sequence(1, greatest(size(words) - {size - 1}, 1))")
    return found.select("item_id", "words", F.explode(starts).alias("at")).select(
        "item_id", F.expr(f"slice(words, at, {size})").alias("window"))


def _lists(phrases: DataFrame, index: Index) -> DataFrame:
    """(phrase, length, term, place, rank) of the ``phrases`` (phrase, terms: array of words) whose words all have
    postings: a row a word with its place in the phrase, the rarest word first."""
    placed = phrases.select("phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("place", "word"))
    listed = (placed.join(index.terms, "word")
              .groupBy("phrase", "length").agg(F.array_sort(F.collect_list(F.struct("n", "place", "term"))).alias("all"))
              .filter(F.size("all") == F.col("length")))
    return listed.select("phrase", "length", F.posexplode("all").alias("rank", "x")).select(
        "phrase", "length", "rank", "x.place", "x.term")


def _within(index: Index, rows: DataFrame) -> DataFrame:
    """The postings of texts that ``rows`` (row) has, and some of other texts."""
    slot = F.pmod(F.xxhash64("row"), F.lit(SLOTS))
    slots = rows.select(slot.alias("slot")).distinct()  # at most SLOTS numbers
    return index.postings.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot", "doc_id")


def occurrences(phrases: DataFrame, index: Index) -> DataFrame:
    """(row, start, phrase, length): where the ``phrases`` (phrase, terms: array of words) occur in the texts."""
    lists = durable(_lists(phrases, index), "lists")
    at = ["row", "start", "phrase", "length"]
    rarest = durable(lists.filter(F.col("rank") < RAREST).drop("rank"), "rarest-lists")
    shifted = _match(index.postings.drop("doc_id"), rarest, "term").select(
        "row", (F.col("position") - F.col("place")).alias("start"), "phrase", "length")
    both = F.col("count") == F.least(F.col("length"), F.lit(RAREST))
    starts = durable(shifted.filter("start >= 0").groupBy(*at).count().filter(both).drop("count"), "starts")
    others = durable(lists.filter(F.col("rank") >= RAREST).select("phrase", "place", "term"), "other-lists")
    asked = _match(starts, others, "phrase").withColumn("position", F.col("start") + F.col("place"))
    there = asked.join(_within(index, starts), ["row", "position", "term"]).groupBy(*at).count()
    whole = there.filter(F.col("count") == F.col("length") - RAREST).drop("count")
    return starts.filter(F.col("length") <= RAREST).unionByName(whole)


def proximity(items: DataFrame, index: Index, span: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(row, item_id, start, end): where all different words of an item stand within ``span`` words of a text, in any
    order. ``start`` is the place of one of the words, ``end`` the first place by which all have come, counted from 0.

    Postings meet in blocks of ``span`` words, each with the next one, so that a group holds at most twice that many.
    """
    asked = items.select(items[id_col].alias("item_id"), F.array_distinct(words(items[text_col])).alias("terms"))
    phrases = durable(asked.filter("size(terms) > 0").withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    lists = durable(_lists(phrases.select("phrase", "terms"), index).drop("place"), "lists")

    def blocks(postings: DataFrame, wanted: DataFrame) -> DataFrame:
        block = F.floor(F.col("position") / span)
        return _match(postings, wanted, "term").withColumn("block", F.explode(F.array(block, block - 1)))

    group = ["row", "phrase", "length", "block"]
    rarest = durable(lists.filter(F.col("rank") < RAREST).drop("rank"), "rarest-lists")
    near = (blocks(index.postings.drop("doc_id"), rarest).groupBy(*group).agg(F.count_distinct("term").alias("terms"))
            .filter(F.col("terms") == F.least(F.col("length"), F.lit(RAREST))).select(*group))
    near = durable(near, "near")
    held = (blocks(_within(index, near), lists.drop("rank")).join(near, group, "left_semi").groupBy(*group)
            .agg(F.array_sort(F.collect_list(F.struct("position", "term"))).alias("all")))
    ahead = f"filter(all, y -> y.position >= x.position AND y.position < x.position + {span})"
    found = held.select(*group, F.explode(F.expr(f"transform(all, x -> named_struct('x', x, 'ahead', {ahead}))")).alias("e"))
    first = "transform(array_distinct(e.ahead.term), t -> array_min(filter(e.ahead, y -> y.term = t).position))"
    found = found.filter(f"floor(e.x.position / {span}) = block AND size(array_distinct(e.ahead.term)) = length").select(
        "row", "phrase", F.col("e.x.position").alias("start"), F.expr(f"array_max({first})").alias("end"))
    return _match(found, phrases.select("phrase", "item_id"), "phrase").select("row", "item_id", "start", "end")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """A row a text: doc_id, n_words, n_hit (words inside an occurrence of an item's window), the items found (sorted
    as strings)."""
    found = durable(windows(items, size), "windows")
    phrases = durable(found.select(F.col("window").alias("terms")).distinct()
                      .withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    members = durable(found.join(phrases, found["window"] == phrases["terms"])
                      .select("phrase", F.col("item_id").cast("string").alias("item")).distinct(), "members")
    index = build_index(docs, phrases.select(F.explode("terms").alias("word")))
    hits = durable(occurrences(phrases, index), "occurrences")

    by_text = Window.partitionBy("row").orderBy("start")
    before = F.max(F.col("start") + F.col("length")).over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.groupBy("row", "start").agg(F.max("length").alias("length"))
    new = F.col("start") + F.col("length") - F.greatest("start", F.coalesce(before, F.lit(0)))
    covered = spans.select("row", new.alias("new")).groupBy("row").agg(F.sum(F.greatest("new", F.lit(0))).alias("n_hit"))
    listed = (_match(hits.select("row", "phrase").distinct(), members, "phrase").select("row", "item")
              .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))  # a null id is no member
    texts = index.postings.filter(F.col("term") == END).select(
        "row", "doc_id", F.col("position").cast("long").alias("n_words"))
    return texts.join(covered, "row", "left").join(listed, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """The rows of :func:`decontaminate` in numbers and a checksum."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def digest_sql(size: int = WINDOW) -> str:
    """The SQL twin of the digest over ``documents`` and ``benchmark``."""
    def words_of(table: str) -> str:
        listed = f"regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
        return f"{listed} AS w FROM {table}"

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words_of('documents')}),
i AS (SELECT item_id, {words_of('benchmark')}),
iw AS (SELECT DISTINCT item_id, least(len(w), {size}) AS n, array_to_string(w[k:k + {size - 1}], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, k, n, item_id FROM dw JOIN iw USING (n, g)),
word AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit) GROUP BY r),
item AS (SELECT r, COUNT(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
         ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)"""
