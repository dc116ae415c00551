"""Near-duplicate lines by a deletion-neighbourhood join; DataFrame functions only.

Lines are the \\n-split pieces of a text, compared as sequences of words; those without a word are never touched. A
line goes when an earlier one (smaller key, then smaller line number) is equal to it or, both having ``min_words`` words
or more, within one edit: one word put in, left out or replaced. Whether that earlier line itself goes doesn't matter,
so the earliest of a group always stays.

1. equal lines meet on one hash of their words; each distinct line goes on once;
2. one edit leaves the first or the last half of the words as it is, so only lines that share a half can be close
   (halves are cut at multiples of two words; lines at a cut are filed under both);
3. those emit the hash of each variant with one word left out, and their own. Equal variants join: lines that lack
   the same place differ in that word only, and a variant equal to a whole line is one word longer;
4. each group of equal variants yields its earliest line, never its pairs; the edit distance to it is verified.

Null and empty texts have no lines and stay as they are. A document is a key and its text: rows that repeat both lose
the same lines, and rows that share a key but not the text are documents of their own, ordered by a hash of the text.
A null key is one like any other and comes last. An empty table gives an empty result. Other columns pass through
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import concluded, document, forget, join_texts, small, split_words, stored


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, line, w (words) of every line that has any."""
    split = docs.select(document(key, text).alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line", "t"))
    return split.select("doc", "line", split_words(F.col("t")).alias("w")).where(F.size("w") > 0)


def word_hashes(w: str) -> Column:
    """Variants and halves are hashed over these, which takes a fraction of the time of hashing text again and again."""
    return F.transform(w, lambda x: F.xxhash64(x))


def half_keys(w: str) -> Column:
    """Hashes of the first and last halves of a line's word hashes, under each cut that it shares with lines one word longer or shorter."""
    n = F.size(w)
    cut = F.floor(n / 4).cast("int") * 2
    cuts = F.when(n % 4 == 0, F.array(cut, cut - 2)).otherwise(F.array(cut))
    keys = lambda q: F.array(F.xxhash64(F.lit("first"), q, F.slice(w, F.lit(1), q)), F.xxhash64(F.lit("last"), q, F.slice(w, n - q + 1, q)))
    return F.flatten(F.transform(cuts, keys))


def edits_at_most_one(a: str, b: str) -> Column:
    """Whether two word arrays are within one edit: common beginning and end leave at most one word of the longer."""
    alike = lambda x, y: F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    run = lambda at: F.when(at == 0, shorter.cast("long")).otherwise(F.least(at - 1, shorter.cast("long")))
    return (longer - shorter <= 1) & (run(alike(F.col(a), F.col(b))) + run(alike(F.reverse(a), F.reverse(b))) >= longer - 1)


def near_lines(firsts: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """h of the distinct lines that have an earlier one within one edit. firsts: h, at (doc, line) of the lines to try."""
    wanted = stored(firsts.groupBy(F.col("at.doc").alias("doc")).agg(F.collect_list(F.struct(F.col("at.line").alias("line"), "h")).alias("wanted")), "lines-to-try")
    texts = join_texts(docs.select(document(key, text).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t")), wanted, "doc")
    lines = texts.select("doc", F.split("t", "\n").alias("t"), "wanted").select("doc", "t", F.inline("wanted"))
    found = lines.select("h", F.struct("doc", "line").alias("at"), split_words(F.get("t", F.col("line"))).alias("w")).dropDuplicates(["h"])
    found = stored(found.withColumn("hashes", word_hashes("w")), "near-lines")
    whole = F.struct(F.lit(-1).alias("place"), F.xxhash64("hashes").alias("rest"))
    lacking = F.transform(F.sequence(F.lit(1), F.size("hashes")), lambda i: F.struct(i.alias("place"), F.xxhash64(F.concat(F.slice("hashes", F.lit(1), i - 1), F.slice("hashes", i + 1, F.size("hashes")))).alias("rest")))
    every = stored(found.select("h", "at", F.inline(F.concat(F.array(whole), lacking))), "variants")
    met = stored(every.groupBy("rest").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").select("rest"), "met-variants")
    variants = stored(every.join(small(met), "rest", "left_semi"), "variants")
    forget(every)
    same_place = variants.where("place > 0").groupBy("rest", "place").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last").select("rest", "place", "first")
    same_place = stored(same_place, "same-place")  # stored, so that the join below can split a variant that is everywhere
    replaced = variants.join(small(same_place), ["rest", "place"]).where(F.col("at") > F.col("first")).select("h", F.col("first").alias("earlier"))
    both = variants.groupBy("rest").agg(F.min(F.when(F.col("place") < 0, F.col("at"))).alias("whole"), F.min(F.when(F.col("place") > 0, F.col("at"))).alias("lacking")).where("whole IS NOT NULL AND lacking IS NOT NULL")
    both = stored(both, "left-out")
    moved = variants.join(small(both), "rest").select("h", "at", F.when(F.col("place") < 0, F.col("lacking")).otherwise(F.col("whole")).alias("earlier")).where(F.col("at") > F.col("earlier")).select("h", "earlier")
    pairs = replaced.unionByName(moved).distinct()
    own, other = found.select("h", F.col("w").alias("a")), found.select(F.col("at").alias("earlier"), F.col("w").alias("b"))
    return pairs.join(own, "h").join(other, "earlier").where(edits_at_most_one("a", "b")).select("h").distinct()


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """doc, line of every line that goes."""
    hashed = lines_of(docs, key, text).select("doc", "line", word_hashes("w").alias("w"))
    filed = stored(hashed.select("doc", "line", F.xxhash64("w").alias("h"), F.when(F.size("w") >= min_words, half_keys("w")).alias("keys")), "lines")
    firsts = stored(filed.groupBy("h").agg(F.min(F.struct("doc", "line")).alias("at"), F.count(F.lit(1)).alias("n")), "first-lines")
    halves = filed.select("h", F.explode("keys").alias("k"))
    shared = stored(halves.groupBy("k").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").select("k"), "shared-halves")
    close = stored(halves.join(small(shared), "k", "left_semi").select("h").distinct(), "close-lines")
    near = stored(near_lines(firsts.join(small(close), "h", "left_semi"), docs, key, text).withColumn("near", F.lit(True)), "near")
    judged = firsts.join(small(near), "h", "left").select("h", "at", "n", F.coalesce("near", F.lit(False)).alias("near")).where("near OR n > 1")
    # stored, so that the join below is of two shuffled sides, and a line that is everywhere can be split
    judged = stored(judged.select("h", "at", "near"), "judged-lines")
    return filed.select("h", "doc", "line").join(small(judged), "h").where(F.col("near") | (F.struct("doc", "line") != F.col("at"))).select("doc", "line")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """The input rows and columns with duplicate lines taken out of text, and n_lines_removed."""
    listed = lambda: removed_lines(docs, key, text, min_words).distinct().groupBy(F.col("doc").alias("row_key")).agg(F.sort_array(F.collect_list("line")).alias("gone"))
    gone = concluded(listed, "removed-lines")
    # for each line up to the last that goes: whether it stays
    stays = F.flatten(F.transform("gone", lambda x, k: F.concat(F.array_repeat(F.lit(True), x - F.coalesce(F.get("gone", k - 1), F.lit(-1)) - 1), F.array(F.lit(False)))))
    rows = join_texts(docs.select(F.struct(*docs.columns).alias("row"), document(key, text).alias("row_key"), F.col(text).alias("t")), gone, "row_key", "left")
    rows = rows.withColumn("stays", stays)
    kept = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.filter(F.split("t", "\n"), lambda line, i: F.coalesce(F.get("stays", i), F.lit(True))), "\n"))
    made = F.struct(kept.alias("kept"), F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0)).alias("n_lines_removed"))
    # a generator, since a filter on the new text would be pushed below and evaluate its parts again inside the lambda
    rows = rows.select("row", F.inline_outer(F.array(made)))
    return rows.select(*[(F.col("kept") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != "n_lines_removed"], "n_lines_removed")
