"""Joins and set operations between tables: coverage, reconciliation, aliases, quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X

#: Characters of texts looked for in others that go to all tasks at once; more are looked for in further passes.
NEEDLE_CHARS, NEEDLES = 8_000_000, 5000


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of `left` that `right` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def mismatched_counts(parents: DataFrame, children: DataFrame, key: str, declared: str) -> DataFrame:
    """Parents whose declared number of children is not the number there: (key, declared, found)."""
    counts = children.groupBy(key).agg(F.count("*").alias("found"))
    rows = parents.select(key, F.col(declared).cast("long").alias("declared")).join(counts, key, "left")
    return rows.withColumn("found", F.coalesce("found", F.lit(0))).where("declared <> found")


def resolve_aliases(rows: DataFrame, surface: str, aliases: DataFrame) -> DataFrame:
    """Adds `canonical`: the alias table's name for the surface, or the surface itself without white space around. Of several names the least counts."""
    names = aliases.groupBy(F.col("alias").alias("_alias")).agg(F.min("canonical").alias("_canonical"))
    return rows.join(names, F.col(surface) == F.col("_alias"), "left").withColumn("canonical", F.coalesce("_canonical", X.strip(F.col(surface)))).drop("_alias", "_canonical")


def quotes_in(texts: DataFrame, quotes: DataFrame, text: str = "text", quote: str = "quote") -> DataFrame:
    """Pairs of a text and a quote that stands in it word for word.

    A word inside a quote, with borders on both sides, is a word of every text that holds the quote: so quotes meet
    texts by their longest such word, and only those pairs are compared. Quotes without one are compared with every
    text. Quotes go to the tasks in blocks of at most NEEDLE_CHARS characters and NEEDLES quotes, with one scan of the
    texts for each; texts are never shuffled.
    """
    words = lambda c: F.regexp_extract_all(c, F.lit(r"(?U)\w+"), F.lit(0))
    inner = F.transform(F.slice(words(F.col(quote)), 2, F.greatest(F.size(words(F.col(quote))) - 2, F.lit(0))), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    wanted = quotes.where(F.length(quote) > 0).withColumn("_word", F.array_max(inner)["w"])
    size = wanted.agg(F.coalesce(F.sum(F.length(quote)), F.lit(0)).alias("chars"), F.count("*").alias("n")).first()
    blocks = max(1, -(-int(size["chars"]) // NEEDLE_CHARS), -(-int(size["n"]) // NEEDLES))
    holds, out = F.contains(F.col(text), F.col(quote)), None
    for k in range(blocks):
        part = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64(quote), F.lit(blocks)) == k)
        keys = [r["_word"] for r in part.where("_word is not null").select("_word").distinct().collect()]
        found = texts.join(F.broadcast(part.where("_word is null").drop("_word")), holds)  # a bounded block
        if keys:
            met = texts.withColumn("_word", F.explode(F.array_intersect(words(F.col(text)), F.array(*map(F.lit, keys)))))
            found = found.unionByName(met.join(F.broadcast(part.where("_word is not null")), "_word").where(holds).drop("_word"))
        out = found if out is None else out.unionByName(found)
    return out


def tag_documents(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """(canonical, doc_id): which documents speak of a tag, with the best score."""
    named = resolve_aliases(candidates, "normalized_surface", aliases)
    return named.groupBy("canonical", "doc_id").agg(F.max("score").alias("score"))


def co_occurrence(links: DataFrame) -> DataFrame:
    """Edges of the tag graph: pairs of tags of one document, weighted by documents. A document gives a pair for each two of its different tags."""
    tags = links.groupBy("doc_id").agg(F.array_sort(F.collect_set("canonical")).alias("tags"))
    pairs = F.flatten(F.transform("tags", lambda a, i: F.transform(F.slice("tags", i + 2, F.size("tags")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return tags.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("weight"))
