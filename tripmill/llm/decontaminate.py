"""Operator 2, benchmark decontamination: test items inside documents, found by containment.

A document has an item if it holds at least 75 percent of the distinct five-word
shingles of the item's lower-cased text (items of fewer words are one shingle,
which only a text of just these words has). Candidates come from the MinHash
search of ``containment``, which splits the documents by how many shingles they
share with items of a size; the containment is then computed on whole sets.

Null or empty texts share nothing. Rows of equal id, null included, count as one
document or item. Empty tables give no rows. Other columns are ignored. Everything
is built of SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored
from tripmill.llm.containment import hits, matches, short_sets, shingled


def contained_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) for every item that a document contains."""
    items, named_items = short_sets(shingled(benchmark, "item_id", "text"), "item_id")
    found = hits(shingled(docs, "doc_id", "text"), "doc_id", items)
    domains = found.groupBy("doc_id", "class").agg(
        F.array_sort(F.collect_set("shingle")).alias("members")
    )
    domains = domains.select("doc_id", "class", F.xxhash64("class", "members").alias("domain_id"), "members")
    domains = stored(domains, "leak-domains")
    distinct = domains.groupBy("domain_id").agg(
        F.first("class").alias("class"), F.first("members").alias("members")
    )
    pairs = stored(matches(distinct, items), "leak-pairs")
    named = pairs.join(named_items, "set_id")
    return named.join(domains.select("domain_id", "doc_id"), "domain_id").select(
        "doc_id", "item_id", F.col("n_set").alias("n_item_shingles"), "n_shared"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    bad = stored(contained_items(docs, benchmark).select("doc_id").distinct(), "leaking-documents")
    bad = bad.withColumnRenamed("doc_id", "leaking_id")
    same = docs["doc_id"].eqNullSafe(bad["leaking_id"])
    return docs.join(F.broadcast(bad) if bad.count() <= broadcast_rows else bad, same, "left_anti")
