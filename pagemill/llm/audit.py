"""How filters interact: what each removes in every order, alone, and in vain.

Words are rows: they are exploded, grouped by (document, word) and then by document for totals and distinct
words. The other flags are joined to these, and one grouping per part counts documents by which of the five filters
they fail: 32 conditional counts, and as many of good and of toxic documents. All orders of the filters follow from them.

Texts are dealt out once, by document, which holds for both groupings of words; a word row is never shuffled.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filters, the spaces between words, and the limits.
FILTERS, SPACES = "ABCDE", r"[\x20\x09-\x0D]+"
WORDS, DISTINCT_SHARE, CAPITAL_SHARE, SYMBOLS = 200, 50, 2, "[#$%&*|]"
MASKS = 1 << len(FILTERS)


def word_flags(texts: DataFrame) -> DataFrame:
    """(id, h, short, repetitive) of texts (id, h, text), for each text that has a word."""
    words = texts.select("id", "h", F.explode(F.split("text", SPACES)).alias("word")).where("word <> ''")
    each = words.groupBy("id", "h", "word").agg(F.count("*").alias("n"))
    total, distinct = F.sum("n"), F.count("*")
    return each.groupBy("id", "h").agg((total < WORDS).alias("short"), (100 * distinct < DISTINCT_SHARE * total).alias("repetitive"))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per document row: (id, part, mask), bit k of ``mask`` for a failed filter k of ``FILTERS``.

    A null text is empty: it fails A alone, and E where a smaller id has an empty text too. A null id has no smaller ids and is none.
    A null part is the empty one. Equal rows are judged alike; rows of one id with different texts are judged text by text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    digest = F.sha2(text.cast("binary"), 256)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.xxhash64(text).alias("h"), digest.alias("digest"),
        (100 * capitals > CAPITAL_SHARE * F.length(text)).alias("capital"), text.rlike(SYMBOLS).alias("symbols"),
    )
    # Equal texts of an id are one text from here on, before they are dealt out.
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).groupBy("id", "h").agg(F.any_value("text").alias("text"))
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("last > first")
    # The digest in two parts: else the groups would share the join's stage, and a hot digest could not be split.
    first = first.select(F.concat(F.substring("digest", 1, 32), F.substring("digest", 33, 32)).alias("digest"), "first")
    rows = rows.join(first, "digest", "left").select("id", "part", "h", "capital", "symbols", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("copy"))
    words = word_flags(texts)
    same = rows["id"].eqNullSafe(words["id"]) & (rows["h"] == words["h"])
    # The outer join: texts without words have no row there.
    flags = rows.join(words, same, "left").select(rows["id"], "part", F.coalesce("short", F.lit(True)).alias("a"), F.coalesce("repetitive", F.lit(False)).alias("b"), F.col("capital").alias("c"), F.col("symbols").alias("d"), F.col("copy").alias("e"))
    return flags.select("id", "part", sum((F.col(f).cast("int") * (1 << k) for k, f in enumerate("abcde")), F.lit(0)).alias("mask"))


def mask_counts(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per part: arrays ``n``, ``good`` and ``toxic`` of document counts by mask. Repeated labels of an id count once, where any says so."""
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failed.join(marks, "id", "left")
    kinds = {"n": F.lit(True), "good": F.col("good") == 1, "toxic": F.col("toxic") == 1}
    counts = rows.groupBy("part").agg(*(F.count_if((F.col("mask") == m) & of).alias(f"{kind}{m}") for kind, of in kinds.items() for m in range(MASKS)))
    return counts.select("part", *(F.array(*(F.col(f"{kind}{m}") for m in range(MASKS))).alias(kind) for kind in kinds))


def _total(counts: str, wanted) -> Column:
    """The documents whose mask is wanted: ``wanted`` maps a mask column to a condition."""
    return F.aggregate(F.transform(F.col(counts), lambda x, m: F.when(wanted(m), x).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter removes and leaves there.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), counts of documents of the
    part, zeros included; see ``failures`` for nulls and repeated rows. An empty table has no part and gives no rows. ``labels``
    may be empty.
    """
    counts = mask_counts(failures(docs, id_col, text_col, part_col), labels, id_col)
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    rows = counts.select("*", F.explode(F.array(*map(F.lit, orders))).alias("filter_order")).select("*", F.explode(steps).alias("step"))

    def bits(letters: Column) -> Column:
        return sum((F.when(letters.contains(f), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))

    rows = rows.withColumns({"before": bits(F.expr("substring(filter_order, 1, step - 1)")), "own": bits(F.expr("substring(filter_order, step, 1)"))})
    before, own = F.col("before"), F.col("own")

    def lost(m: Column) -> Column:
        return (m.bitwiseAND(own) > 0) & (m.bitwiseAND(before) == 0)

    # A document is removed by the first of its failed filters: each is the first in an equal share of all orders.
    shares = F.array(*(F.lit(len(orders) // max(1, m.bit_count())).cast("long") for m in range(MASKS)))
    each = F.transform(F.col("n"), lambda x, m: F.when(m.bitwiseAND(own) > 0, x * F.get(shares, m)).otherwise(F.lit(0).cast("long")))
    return rows.select(
        "part", "filter_order", "step", _total("n", lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"), _total("n", lost).alias("removed"),
        _total("n", lambda m: (m.bitwiseAND(own) > 0) & (m.bitwiseAND(before) > 0)).alias("redundant"), F.get("n", own).alias("unique_fails"),
        _total("good", lost).alias("good_lost"), _total("toxic", lost).alias("toxic_lost"), F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"),
    )
