"""Benchmark decontamination over a positional inverted index of the training tokens.

A test item is a list of words, and its windows are its runs of ``window`` words. Of every
window the two rarest terms are taken, by their counts in the whole corpus, and the index
holds the postings (term, document, position) of those terms alone. A posting and a place in
an item give an offset; places of one item that meet at one offset in one document are a
possible copy, whatever number of windows it spans. Each is then compared word by word, so
only exact phrases count.

Only DataFrame functions are used. Test items may be many, and so may candidates. Tokens and
documents that belong to none are told by a bitmap of fixed size before anything is shuffled;
what passes meets its true partners in a join that nothing forces. Terms are written first,
so that Spark knows their true size when it chooses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import ascii_lower, named, written

WINDOW = 10
BITMAP_BITS = 1 << 24  # 262,144 rows of 64 bits, whatever the number of keys
# What separates words: ASCII other than letters and digits.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as they are written; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def test_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, words`` of the items with words; equal texts of one id count once."""
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), ascii_lower(F.col("text")).alias("text"))
        .distinct()
        .select(F.xxhash64("item_id", "text").alias("item"), "item_id", words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
    )


def places(items: DataFrame) -> DataFrame:
    """``item, at, term`` of every word of the items. Terms are in lower case throughout, which
    never separates words that the exact comparison would match."""
    return items.select("item", F.posexplode("words").alias("at", "term")).withColumn("term", F.lower("term"))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed here, once: Catalyst copies no expression over a
    one-row explode into the filters and lambdas that use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def may_be_among(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows whose ``key``, a hash, may be among the hashes in ``keys``' only column. The
    bitmap that tells is broadcast; its size is fixed."""
    bit = F.pmod(F.col(keys.columns[0]), F.lit(BITMAP_BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, int(bit & 63)))").alias("bits"))
    own = F.pmod(key, F.lit(BITMAP_BITS))
    met = df.withColumn("bit", own).join(F.broadcast(words), F.shiftright("bit", 6) == F.col("word"))
    return met.where(F.expr("shiftright(bits, int(bit & 63)) & 1 = 1")).select(*df.columns)


def tokens_among(docs: DataFrame, terms: DataFrame, position: bool = False) -> DataFrame:
    """The tokens of ``docs`` that may be among ``terms``, in lower case, with what else ``docs`` has."""
    words = words_of(F.col("text"))
    kept = [c for c in docs.columns if c != "text"]
    tokens = docs.select(*kept, F.posexplode(words).alias("position", "term") if position else F.explode(words).alias("term"))
    tokens = tokens.withColumn("term", F.lower("term"))
    return may_be_among(tokens, F.xxhash64("term"), terms.select(F.xxhash64("term").alias("key")))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` occurs in the corpus; terms that never do are left out."""
    counted = tokens_among(docs.select("text"), terms).groupBy("term").agg(F.count("*").alias("n"))
    return counted.join(terms, "term", "left_semi")


def rare_places(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """``item, at, term``: the places of the two rarest terms of each window that can occur."""
    size = F.least(F.lit(window), F.size("words"))
    starts = items.select("item", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    inside = starts.select("item", "start", "size", F.explode(F.expr("sequence(start, start + size - 1)")).alias("at"))
    rarest = Window.partitionBy("item", "start").orderBy("n", "at")
    whole = Window.partitionBy("item", "start")
    return (
        inside.join(places(items), ["item", "at"])
        .join(counts, "term")
        .withColumns({"rank": F.row_number().over(rarest), "known": F.count("*").over(whole)})
        .where((F.col("rank") <= 2) & (F.col("known") == F.col("size")))
        .select("item", "at", "term")
        .distinct()
    )


def near_places(items: DataFrame, counts: DataFrame, window: int, least: int) -> DataFrame:
    """``item, at, term``: places to look for changed copies by, whether or not all words of
    their windows occur: the two rarest of each window and two more than ``least`` of each item,
    among the words that do."""
    known = places(items).join(counts, "term")
    size = F.least(F.lit(window), F.size("words"))
    starts = items.select("item", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    inside = starts.select("item", "start", F.explode(F.expr("sequence(start, start + size - 1)")).alias("at"))
    of_window = Window.partitionBy("item", "start").orderBy("n", "at")
    of_item = Window.partitionBy("item").orderBy("n", "at")
    chosen = [
        inside.join(known, ["item", "at"]).withColumn("rank", F.row_number().over(of_window)).where("rank <= 2"),
        known.withColumn("rank", F.row_number().over(of_item)).where(F.col("rank") <= least + 2),
    ]
    return chosen[0].select("item", "at", "term").unionByName(chosen[1].select("item", "at", "term")).distinct()


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``term, doc_id, tie, position`` of the given terms. Documents are told apart by
    id and a hash of their text, so repeated rows share their postings."""
    own = docs.select("doc_id", text_hash(F.col("text")).alias("tie"), "text")
    return tokens_among(own, terms, position=True).join(terms, "term").select("term", "doc_id", "tie", "position")


def offsets(docs: DataFrame, items: DataFrame, choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``doc_id, tie, item, at, offset``: rare terms of items met in documents. ``choose`` gives
    their places, ``item, at, term``, from the counts of terms."""
    terms = written(places(items).select("term").distinct(), "terms")
    counts = written(term_counts(docs, terms), "counts")
    rare = written(choose(counts), "rare")
    postings = written(index(docs, written(rare.select("term").distinct(), "rare-terms")), "postings")
    return postings.join(rare, "term").select("doc_id", "tie", "item", "at", (F.col("position") - F.col("at")).alias("offset"))


def candidates(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Per document the items it may hold, with the offsets to compare them at.

    A window that occurs brings both of its rarest places to one offset, so one alone is only
    enough for windows of a single word.
    """
    found = offsets(docs, items, lambda counts: rare_places(items, counts, window))
    met = found.groupBy("doc_id", "tie", "item", "offset").agg(F.countDistinct("at").alias("n"))
    return (
        met.join(items, "item")
        .where((F.col("n") >= 2) | (F.least(F.lit(window), F.size("words")) == 1))
        .groupBy("doc_id", "tie")
        .agg(F.collect_list(F.struct("item_id", "offset", "words")).alias("tests"))
    )


def _occurrences(window: int) -> Column:
    """Spans ``start, stop, item_id`` of the windows of ``tests`` that ``words`` holds."""
    return F.expr(
        f"""flatten(transform(tests, t -> transform(
          filter(
            sequence(0, size(t.words) - least({window}, size(t.words))),
            i -> t.offset + i >= 0
              and t.offset + i + least({window}, size(t.words)) <= size(words)
              and slice(words, t.offset + i + 1, least({window}, size(t.words)))
                = slice(t.words, i + 1, least({window}, size(t.words)))),
          i -> struct(t.offset + i as start, t.offset + i + least({window}, size(t.words)) as stop, t.item_id as item_id))))"""
    )


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, tie, spans``: the documents that hold windows, with the exact phrase matches."""
    items = written(test_items(benchmark), "items")
    found = written(candidates(docs.select("doc_id", "text"), items, window), "candidates")
    own = docs.select("doc_id", text_hash(F.col("text")).alias("tie"), "text")
    own = may_be_among(own, F.xxhash64("doc_id", "tie"), found.select(F.xxhash64("doc_id", "tie").alias("key")))
    same = own["doc_id"].eqNullSafe(found["doc_id"]) & (own["tie"] == found["tie"])
    met = own.join(found, same).select(own["doc_id"], own["tie"], "text", "tests")
    met = once(met, "words", words_of(ascii_lower(F.col("text"))))
    spans = once(met, "spans", _occurrences(window)).select("doc_id", "tie", "spans")
    return spans.where(F.size("spans") > 0).groupBy("doc_id", "tie").agg(F.any_value("spans").alias("spans"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 5, least: int = 3) -> DataFrame:
    """``doc_id, item_id, n_near``: items at least ``least`` of whose rare terms stand in a
    document in places that differ from the item's by at most ``slop`` words from each other.

    Finds copies with words put in, left out or moved, which no exact window matches. Words
    that the corpus lacks count for nothing; an item of fewer than ``least`` words needs all of
    them. A word of the document stands for one
    place of the item at a time. Texts are compared as in ``report``; repeated rows are
    answered once, and texts that share an id each for itself. Null and empty texts and items
    match nothing, a null id stays null, and empty tables on either side give no rows.
    """
    items = written(test_items(benchmark), "items")
    found = offsets(docs, items, lambda counts: near_places(items, counts, window, least))
    # In the order of offsets, those within the slop of one are among the next few.
    near = f"""array_max(transform(
        transform(met, (m, i) -> filter(slice(met, i + 1, n_places * {int(slop) + 1}), o -> o.offset <= m.offset + {int(slop)})),
        s -> least(size(array_distinct(transform(s, o -> o.at))), size(array_distinct(transform(s, o -> o.offset + o.at))))))"""
    return (
        found.groupBy("doc_id", "tie", "item")
        .agg(F.array_sort(F.collect_set(F.struct("offset", "at"))).alias("met"))
        .join(items.select("item", "item_id", F.least(F.lit(least), F.size("words")).alias("need")), "item")
        .where(F.size("met") >= F.col("need"))
        .withColumn("n_places", F.size(F.array_distinct("met.at")))
        .select("doc_id", "item_id", "need", F.expr(near).alias("n_near"))
        .where(F.col("n_near") >= F.col("need"))
        .select("doc_id", "item_id", "n_near")
    )


# Words that spans cover: each span adds what lies behind all spans before it.
_COVERED = """aggregate(
  array_sort(transform(spans, s -> struct(s.start as start, s.stop as stop))),
  struct(0 as seen, 0 as total),
  (a, s) -> struct(greatest(a.seen, s.stop) as seen, a.total + greatest(0, s.stop - greatest(a.seen, s.start)) as total),
  a -> a.total)"""


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Every row of ``docs`` is answered, repeated rows alike and as often as they occur. Null
    and empty texts have no words and are clean. Items without words have no windows, items
    shorter than a window are one; items that share an id count as one item, and a null item
    id counts as empty text. Empty tables give no rows, or clean ones.
    """
    items = F.expr("array_sort(array_distinct(transform(spans, s -> coalesce(s.item_id, ''))))")
    found = matches(docs, benchmark, window).select(
        F.col("doc_id").alias("__id"),
        F.col("tie").alias("__tie"),
        F.expr(_COVERED).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    )
    own = docs.select("doc_id", text_hash(F.col("text")).alias("tie"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return own.join(found, own["doc_id"].eqNullSafe(F.col("__id")) & (own["tie"] == F.col("__tie")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark.

    Rows with null and empty texts stay, repeated rows stay or go together, and of texts that
    share an id, or lack one, each is judged for itself. Columns stay as they are, whatever
    their names. An empty benchmark drops nothing; no rows give no rows.
    """
    hit = written(matches(docs, benchmark, window).select("doc_id", "tie"), "contaminated")
    own = docs.select(F.struct(*map(named, docs.columns)).alias("whole"), F.col("doc_id").alias("id"), text_hash(docs["text"]).alias("hash"))
    return own.join(hit, own["id"].eqNullSafe(hit["doc_id"]) & (own["hash"] == hit["tie"]), "left_anti").select("whole.*")
