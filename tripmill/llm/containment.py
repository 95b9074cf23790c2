"""MinHash search for the containment of small shingle sets, with SQL functions only.

Short sets (test items, license notices) are sought in many long texts. Only
shingles of some short set can count, so every text is first reduced to those.
What is left of a text, its domain, is split by the size class of the sets that
its shingles belong to; domains and sets of one class are matched by MinHash with
one value a band. From the largest domain size of a class and its smallest set
follows the least Jaccard similarity of a pair above the containment threshold,
and from that the number of bands that misses a pair with probability ``MISS`` at
most. Matches are then verified on the whole sets. Equal domains, as copies of
texts have them, are searched once.

Domains that would need more than ``MAX_BANDS`` are matched by the inverted lists
of the sets instead, which is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, words

SHINGLE = 5
MIN_PCT = 75
MISS = 1e-9
MAX_BANDS = 1024
#: Tables of up to so many rows of 16 bytes are broadcast.
BROADCAST_ROWS = 1_000_000

#: Hashes of all runs of five words; a shorter text is one shingle, an empty one has none.
SHINGLES = f"""CASE WHEN size(words) = 0 THEN CAST(array() AS ARRAY<BIGINT>)
    WHEN size(words) < {SHINGLE} THEN array(xxhash64(concat_ws(' ', words)))
    ELSE transform(sequence(0, size(words) - {SHINGLE}),
        i -> xxhash64({", ".join(f"words[i + {k}]" for k in range(SHINGLE))})) END"""


def shingled(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles): the hashes in text order, as a column named like ``id_col``."""
    split = texts.select(id_col, words(F.lower(F.coalesce(text_col, F.lit("")))).alias("words"))
    return split.select(id_col, F.expr(SHINGLES).alias("shingles"))


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def short_sets(shingles: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (set_id, members, class), and who has them (set_id, id), both stored.

    Rows of one id count as one text. The class is the base-2 logarithm of the size.
    """
    members = shingles.select(id_col, F.explode_outer("shingles").alias("shingle"))
    sets = members.where("shingle IS NOT NULL").groupBy(id_col).agg(F.array_sort(F.collect_set("shingle")).alias("members"))
    sets = stored(sets.select(id_col, "members", F.xxhash64("members").alias("set_id")), "short-sets")
    distinct = sets.groupBy("set_id").agg(F.first("members").alias("members"))
    size_class = F.floor(F.log2(F.size("members"))).cast("int")
    distinct = distinct.select("set_id", "members", size_class.alias("class"))
    return stored(distinct, "distinct-sets"), sets.select("set_id", id_col)


def hits(shingles: DataFrame, id_col: str, sets: DataFrame) -> DataFrame:
    """(id, position, shingle, class) wherever a text has a shingle of a set of that class."""
    wanted = sets.select(F.explode("members").alias("shingle"), "class").distinct()
    wanted = small(stored(wanted, "wanted-shingles"))
    # For an inner explode Spark would first filter on the array's size, computing it twice.
    each = shingles.select(id_col, F.posexplode_outer("shingles").alias("position", "shingle"))
    return each.join(wanted, "shingle").select(id_col, "position", "shingle", "class")


def bands(domain_class: int, set_class: int) -> int:
    """How many MinHash values find a pair in these classes but for ``MISS``."""
    share = MIN_PCT / 100
    smallest, largest = 2**set_class, 2 ** (domain_class + 1) - 1
    similarity = share * smallest / (max(largest, share * smallest) + (1 - share) * smallest)
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(similarity, 1 - 1e-12))))


def band_count(domain_class: str, set_class: str) -> str:
    """``bands`` as SQL over the two classes: the sizes of a pair only enter by their ratio."""
    cases = [f"WHEN {domain_class} - {set_class} <= {d} THEN {most_bands(d)}" for d in range(-1, 12)]
    return f"CASE {' '.join(cases)} ELSE {MAX_BANDS + 1} END"


def most_bands(ratio: int) -> int:
    return max(bands(c + ratio, c) for c in range(0, 41) if c + ratio >= 0)


def matches(domains: DataFrame, sets: DataFrame) -> DataFrame:
    """(domain_id, set_id, n_shared) of pairs whose set lies in the domain to ``MIN_PCT`` percent.

    ``domains`` has distinct (domain_id, class, members). Sets of a class are only
    sought in domains of that class.
    """
    sized = domains.withColumn("domain_class", F.floor(F.log2(F.size("members"))).cast("int"))
    sized = sized.withColumn("bands", F.expr(band_count("domain_class", "class")))
    value = "array_min(transform(members, m -> xxhash64(m, j)))"
    values = f"transform(sequence(1, bands), j -> {value})"

    def signed(df: DataFrame, key: str) -> DataFrame:
        return df.select(key, "class", F.expr(f"posexplode({values}) AS (band, value)"))

    sought = small(sets.select("set_id", "class", "members"))
    fits = sized.where(F.col("bands") <= MAX_BANDS)
    # As many values of a set as any domain of its class has: one row per class.
    most = fits.groupBy("class").agg(F.max("bands").alias("bands"))
    by_band = signed(fits, "domain_id").join(
        signed(sets.join(F.broadcast(most), "class"), "set_id"), ["class", "band", "value"]
    )
    rest = sized.where(F.col("bands") > MAX_BANDS)
    by_list = rest.select("domain_id", "class", F.explode("members").alias("shingle")).join(
        sets.select("set_id", "class", F.explode("members").alias("shingle")), ["class", "shingle"]
    )
    found = by_band.select("domain_id", "set_id").unionByName(by_list.select("domain_id", "set_id"))
    pairs = found.distinct()
    members = domains.select("domain_id", F.col("members").alias("domain_members"))
    verified = pairs.join(members, "domain_id").join(sought, "set_id").select(
        "domain_id", "set_id", F.size(F.array_intersect("domain_members", "members")).alias("n_shared"),
        F.size("members").alias("n_set"),
    )
    return verified.where(F.col("n_shared") * 100 >= F.col("n_set") * MIN_PCT).select(
        "domain_id", "set_id", F.col("n_shared").cast("bigint"), F.col("n_set").cast("bigint")
    )
