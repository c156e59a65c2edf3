"""Benchmark decontamination [native]: size-partitioned MinHash containment search, verified by exact shingle containment.

Words are maximal runs of letters and digits, lower case; a shingle is five consecutive words, known by a 64-bit hash. An item is contained in
a document if at least `threshold` of its distinct shingles are among the document's.

Items are partitioned by size (powers of two of their shingle count). A MinHash signature of a long document says next to nothing about a short
item (their Jaccard similarity is about the ratio of their sizes), so, as in containment MinHash (Koslicki and Zabeti 2019), the item is
sketched by its least hashes and those are looked up among all shingles of the document. The sketch size follows from the partition: of n
shingles at most (1 - threshold) * n are missing from a containing document, so that many plus one sketch hashes can't all be missing. The
search therefore loses nothing. What it finds is verified on the full shingle sets: documents with a hit are read again and shingles shared are
counted for each document and item. Sides that are looked up are broadcast while they have few rows (of numbers); beyond that hashes meet by
shuffle, by the same plan.

Items under five words have no shingle and match nothing; null and empty texts likewise. Rows are told apart by id and text, so rows of an id with
different texts are searched one by one, null ids too, and repeated rows give one match; of several matches of a doc_id and item_id the one that
shares most is returned. Other columns of docs and items are not read. An empty table gives no match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, fresh, small, stored

WORDS, THRESHOLD = 5, 0.8


def shingled(rows: DataFrame, key: str, n: int = WORDS) -> DataFrame:
    """The id as `key`, `of` (hash of the text), h: a row for each shingle of a text, repeated ones included."""
    words = F.expr("split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\\\p{L}\\\\p{N}]+', ' ')), ' ')")
    run = ", ".join(f"_w[i + {k}]" for k in range(n))
    hashes = F.expr(f"case when size(_w) >= {n} then transform(sequence(0, size(_w) - {n}), i -> xxhash64({run})) end")
    some = rows.select(F.col(key), F.xxhash64("text").alias("of"), F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    # an outer explode: for the inner one the optimizer would add a filter that hashes all shingles once more
    return some.select(key, "of", F.explode_outer(hashes).alias("h")).where("h is not null")


def sketches(items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """item_id, of, n_item, needed, h: a row for each distinct shingle hash of an item; and those in its sketch."""
    each = Window.partitionBy("item_id", "of")
    sets = shingled(items, "item_id", n).distinct().withColumn("n_item", F.count("*").over(each)).withColumn("rank", F.row_number().over(each.orderBy("h")))
    sets = stored(sets.withColumn("needed", F.ceil(F.col("n_item") * F.lit(threshold) - 1e-9)))
    partition = F.pow(F.lit(2), F.ceil(F.log2("n_item")))
    return sets, sets.where(F.col("rank") <= F.floor(partition * F.lit(1 - threshold) + 1e-9) + 1)


def found(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """doc_id, of, item_id, n_item, n_shared: for each pair of a document's text and an item's that contain each other to the threshold."""
    sets, sketch = sketches(items, threshold, n)
    hits = shingled(docs, "doc_id", n).join(small(sketch.select("h").distinct(), BROADCAST_ROWS), "h").select(F.col("doc_id").alias("_id"), F.col("of").alias("_of"))
    hits = small(stored(hits.distinct()), BROADCAST_ROWS)
    some = docs.select("doc_id", "text").join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_of")), "left_semi")
    theirs = small(sets.select("item_id", F.col("of").alias("item_of"), "n_item", "needed", "h"), BROADCAST_ROWS)
    shared = shingled(some, "doc_id", n).distinct().join(theirs, "h").groupBy("doc_id", "of", "item_id", "item_of", "n_item", "needed").agg(F.count("*").alias("n_shared"))
    return shared.where("n_shared >= needed").select("doc_id", "of", "item_id", F.col("n_item").cast("int").alias("n_item"), F.col("n_shared").cast("int").alias("n_shared"))


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """doc_id, item_id, n_item, n_shared: every pair with n_shared / n_item >= threshold, once."""
    best = found(docs, items, threshold, n).groupBy("doc_id", "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_item", "best.n_shared")


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that contain an item, all columns kept."""
    id_, of = fresh(docs, "id"), fresh(docs, "of")
    bad = small(stored(found(docs, items, threshold).select(F.col("doc_id").alias(id_), F.col("of").alias(of)).distinct()))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(of)), "left_anti")


def oracle(threshold: float = THRESHOLD, n: int = WORDS) -> str:
    def sh(table: str, key: str) -> str:
        return f"""(select distinct {key}, list_slice(w, i, i + {n - 1}) as g from (
  select {key}, w, unnest(generate_series(1, len(w) - {n - 1})) as i from (
    select {key}, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as w from {table}) where len(w) >= {n}))"""

    return f"""
with b as {sh("benchmark", "item_id")}, d as {sh("documents", "doc_id")},
n as (select item_id, count(*) as n_item from b group by 1),
s as (select doc_id, item_id, count(*) as n_shared from d join b using (g) group by 1, 2)
select doc_id, item_id, n_item::int as n_item, n_shared::int as n_shared from s join n using (item_id) where n_shared >= ceil(n_item * {threshold} - 1e-9)
"""
