"""Benchmark decontamination over a positional inverted index; DataFrame functions only.

Every window of an item names its rarest terms, by counts over the corpus. The index holds the postings (term, doc, pos)
of those terms alone, one segment a task of the input, sorted by term, without a shuffle. The postings of each window's
rarest term, moved back by their offset in the item, are the first alignments of the item with documents; those of the
second and third rarest are intersected with what is left, one after the other; the words of what remains are compared
exactly. Windows with a term that no document has are given up at once.

Words: A-Z lower-cased, then runs of digits, a-z and everything beyond ASCII. Null and empty texts have none and give
a row with zeros. An item of fewer words than a window is one window; one without words is none. Items are told apart by
their words: all ids of one text are found, an id with several texts is found by each, and rows without an id hit but
have no name to list. A document is a key and its text, and a null key is one like any other, so repeated rows give
repeated, equal results. An empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, concluded, document, join_texts, small, split_words, stored, without

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def terms(text: Column) -> Column:
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, key: Column | str = "doc_id", text: str = "text") -> DataFrame:
    """Stored postings: term, doc, pos, and one row a document with term '' and its length as pos.

    vocabulary: distinct ``term`` rows to index; all terms when None. key: the column that names a document.
    """
    name = F.col(key) if isinstance(key, str) else key
    rows = docs.select(name.alias("doc"), F.posexplode(F.concat(terms(F.col(text)), F.array(F.lit("")))).alias("pos", "term"))
    if vocabulary is not None:
        wanted = vocabulary.select("term").unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
        rows = rows.join(small(wanted), "term")
    return stored(rows.select("term", "doc", "pos").sortWithinPartitions("term"), "postings")


def term_counts(docs: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """term, n: how often each of the vocabulary's terms stands in the documents."""
    return docs.select(F.explode(terms(F.col(text))).alias("term")).join(small(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def phrase_matches(index: DataFrame, phrase: list[str]) -> DataFrame:
    """doc, start of every occurrence of the phrase: posting lists are intersected, moved by their offset, rarest first."""
    counts = {r["term"]: r["n"] for r in index.where(F.col("term").isin(phrase)).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(phrase)), key=lambda k: counts.get(phrase[k], 0))
    at = lambda k: index.where(F.col("term") == phrase[k]).select("doc", (F.col("pos") - k).alias("start"))
    found = at(order[0])
    for k in order[1:]:
        found = found.join(at(k), ["doc", "start"], "left_semi")
    return found


def proximity_matches(index: DataFrame, words: list[str], slop: int) -> DataFrame:
    """doc, start of every window of len(words) + slop words that begins with one of the words and holds all of them, in any order."""
    wanted = sorted(set(words))
    width = len(wanted) + slop
    rows = index.where(F.col("term").isin(wanted)).select("term", "doc", "pos", F.floor(F.col("pos") / width).alias("block"))
    starts = rows.select("doc", F.col("pos").alias("start"), "block").distinct()
    around = rows.select("term", "doc", "pos", F.explode(F.array("block", F.col("block") - 1)).alias("block"))
    inside = starts.join(around, ["doc", "block"]).where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + width))
    return inside.groupBy("doc", "start").agg(F.countDistinct("term").alias("n")).where(F.col("n") == len(wanted)).select("doc", "start")


def items_of(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item (a number), words, names (ids) of the distinct word sequences of items."""
    rows = benchmark.select(F.col(key).alias("name"), terms(F.col(text)).alias("words")).where(F.size("words") > 0)
    return rows.groupBy("words").agg(F.collect_set("name").alias("names")).select(F.monotonically_increasing_id().alias("item"), "words", "names")


def rarest_anchors(counts: DataFrame, items: DataFrame, window: int, rarest: int) -> DataFrame:
    """item, start, size, anchors (term and place of its rarest words, rarest first) of every window whose terms all occur. counts: term, n."""
    sized = items.select("item", "words", F.least(F.size("words"), F.lit(window)).alias("size"))
    starts = sized.select("item", "size", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("start"), "words")
    places = starts.select("item", "start", "size", F.posexplode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("k", "term"))
    ranked = F.sort_array(F.collect_list(F.struct("n", (F.col("start") + F.col("k")).alias("place"), "term")))
    known = places.join(small(counts), "term").groupBy("item", "start", "size").agg(ranked.alias("ranked")).where(F.size("ranked") == F.col("size"))
    return known.select("item", "start", "size", F.transform(F.slice("ranked", 1, rarest), lambda r: F.struct(r["term"].alias("term"), r["place"].alias("place"))).alias("anchors"))


def alignments(index: DataFrame, anchored: DataFrame, rarest: int) -> DataFrame:
    """doc, item, delta, start, size: windows all of whose rarest terms stand in the document at item offset + delta."""
    first = anchored.select(F.get("anchors", F.lit(0))["term"].alias("term"), F.get("anchors", F.lit(0))["place"].alias("place"), "item", "start", "size", F.slice("anchors", 2, rarest).alias("rest"))
    met = index.join(small(stored(first, "rarest")), "term").select("doc", "item", (F.col("pos") - F.col("place")).alias("delta"), "start", "size", "rest")
    met = met.where(F.col("delta") + F.col("start") >= 0)
    for k in range(rarest - 1):
        met = stored(met, "alignments")
        term = F.get("rest", F.lit(k))
        lacking = met.where(F.size("rest") > k).withColumn("at", F.struct("doc", term["term"].alias("term"), (F.col("delta") + term["place"]).alias("pos")))
        found = join_texts(index.select(F.struct("doc", "term", "pos").alias("at")), lacking, "at").select(met.columns)
        met = found.unionByName(met.where(F.size("rest") <= k))
    return met.select("doc", "item", "delta", "start", "size").distinct()


def hits_of(docs: DataFrame, items: DataFrame, met: DataFrame, key: str, text: str) -> DataFrame:
    """doc, n_hit, items of the documents with alignments whose words are all equal."""
    wins = met.groupBy("doc", "item", "delta").agg(F.collect_list(F.struct("start", "size")).alias("wins")).groupBy("doc", "item").agg(F.collect_list(F.struct("delta", "wins")).alias("at"))
    by_doc = stored(wins.join(small(items), "item").groupBy("doc").agg(F.collect_list(F.struct("names", "words", "at")).alias("met")), "alignments-by-document")
    both = join_texts(docs.select(document(key, text).alias("doc"), F.col(text).alias("own")), by_doc, "doc").select("doc", terms(F.col("own")).alias("own"), "met")
    same = lambda m, a, w: F.slice(F.col("own"), a["delta"] + w["start"] + 1, w["size"]) == F.slice(m["words"], w["start"] + 1, w["size"])
    covered = lambda m: F.flatten(F.flatten(F.transform(m["at"], lambda a: F.transform(F.filter(a["wins"], lambda w: same(m, a, w)), lambda w: F.sequence(a["delta"] + w["start"], a["delta"] + w["start"] + w["size"] - 1)))))
    exact = F.filter(F.transform("met", lambda m: F.struct(m["names"].alias("names"), covered(m).alias("places"))), lambda m: F.size(m["places"]) > 0)
    hits = both.select("doc", F.inline_outer(F.array(F.struct(exact.alias("hits"))))).where(F.size("hits") > 0)  # a generator: lambdas below read it as a value
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda m: m["places"])))).cast("long")
    return hits.select("doc", n_hit.alias("n_hit"), F.array_distinct(F.flatten(F.transform("hits", lambda m: m["names"]))).alias("items")).dropDuplicates(["doc"])  # repeated rows have equal hits


def search(docs: DataFrame, benchmark: DataFrame, window: int, rarest: int, key: str, text: str, item_key: str) -> tuple[DataFrame, DataFrame]:
    """The index, and doc, n_hit, items of the documents that hold a window; both stored."""
    items = stored(items_of(benchmark, item_key), "items")
    counts = stored(term_counts(docs, items.select(F.explode("words").alias("term")).distinct(), text), "term-counts")
    anchored = stored(rarest_anchors(counts, items, window, rarest), "anchors")
    index = build_index(docs, anchored.select(F.explode("anchors.term").alias("term")).distinct(), document(key, text), text)
    met = concluded(lambda: alignments(index, anchored, rarest), "aligned")
    return index, concluded(lambda: hits_of(docs, items, met, key, text), "hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, rarest: int = 3, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """Per row: key, n_words, n_hit (words inside any occurrence of a window) and items (ids of the items with occurrences)."""
    index, found = search(docs, benchmark, window, rarest, key, text, item_key)
    lengths = index.where("term = ''").select("doc", F.col("pos").cast("long").alias("n_words"))
    empty = F.array().cast(found.schema["items"].dataType)
    return lengths.join(small(found), "doc", "left").select(F.col("doc.key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty).alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, rarest: int = 3, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The documents without a hit, with their own columns."""
    _, found = search(docs, benchmark, window, rarest, key, text, item_key)
    return without(docs, found.select("doc"), document(key, text))
