"""Near duplicates with MinHash and banded LSH.

Copies are removed first (one row per distinct text), so what reaches the bands are distinct texts.  A bucket is never
turned into all its pairs: each member is linked to the smallest id of the bucket.  The links connect exactly the items the
pairs would connect, and grow with the members instead of their square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.lineage import cut, stored
from querylode.operators.ordering import first_per_key, top_k
from querylode.sizing import fits, salted_join, sided, weighted_join

# Permutations, threshold and shingle size of the statement comparison.
NUM_PERM, THRESHOLD, SHINGLE = 128, 0.5, 3
PRIME = (1 << 31) - 1


def permutations(num_perm: int = NUM_PERM) -> tuple[list[int], list[int]]:
    """Coefficients of the hash family ``(a * h + b) % PRIME``: two linear congruential sequences."""
    a, b, x, y = [], [], 12345, 67890
    for _ in range(num_perm):
        x = (x * 48271) % PRIME
        y = (y * 69621) % PRIME
        a.append(x)
        b.append(y)
    return a, b


def bands_and_rows(threshold: float = THRESHOLD, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """Split of the signature that minimises the summed areas of false positives and false negatives."""
    below = (np.arange(200) + 0.5) / 200 * threshold
    above = threshold + (np.arange(200) + 0.5) / 200 * (1 - threshold)
    best = None
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            false_positive = (1 - (1 - below ** r) ** b).mean() * threshold
            false_negative = ((1 - above ** r) ** b).mean() * (1 - threshold)
            error = false_positive + false_negative
            if best is None or error < best[0]:
                best = (error, b, r)
    return best[1], best[2]


def signature_udf(num_perm: int = NUM_PERM):
    """``array<long>`` of shingle hashes to its MinHash signature; empty in, empty out."""
    a, b = (np.array(c, dtype=np.int64)[:, None] for c in permutations(num_perm))

    @F.pandas_udf("array<bigint>")
    def signature(hashes: pd.Series) -> pd.Series:
        def one(h):
            h = np.asarray(h, dtype=np.int64)
            if not len(h):
                return []
            low = None
            for start in range(0, len(h), 1 << 15):
                part = ((a * h[None, start:start + (1 << 15)] + b) % PRIME).min(axis=1)
                low = part if low is None else np.minimum(low, part)
            return low

        return hashes.map(one)

    return signature


def statements(logs: DataFrame) -> DataFrame:
    """Distinct canonical statements: ``id`` (smallest sql_id), ``text``, ``copies``, ``exec_count``."""
    return logs.groupBy(S.canonical(F.col("sql_text")).alias("text")).agg(
        F.min("sql_id").alias("id"), F.count("*").alias("copies"), F.sum("exec_count").alias("exec_count"))


def distinct_texts(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Distinct texts: ``id`` (smallest), ``text``, ``copies``.  Grouped by hash, so long texts are shuffled once."""
    rows = docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).withColumn("key", F.sha2("text", 256))
    groups = rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    return rows.join(groups.drop("key"), "id").select("id", "text", "copies")


def signatures(items: DataFrame, shingles: Column, num_perm: int = NUM_PERM) -> DataFrame:
    """``items`` with ``shingle_hashes`` and ``signature``."""
    hashed = items.withColumn("shingle_hashes", F.transform(shingles, lambda s: K.hash28(s)))
    return hashed.withColumn("signature", signature_udf(num_perm)("shingle_hashes"))


def bands(signed: DataFrame, n_bands: int, n_rows: int) -> DataFrame:
    """``id, band, bucket``: one row per band of each non-empty signature."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.md5(F.concat_ws(",", F.slice(
        "signature", i * n_rows + 1, F.lit(n_rows)).cast("array<string>"))))
    # The outer form keeps the emptiness test from being pushed down through the signature function.
    parts = F.when(F.size("signature") > 0, parts)
    return signed.select("id", F.posexplode_outer(parts).alias("band", "bucket")).filter("bucket IS NOT NULL")


def bucket_links(banded: DataFrame) -> DataFrame:
    """``id, leader``: each member of a shared bucket with the smallest id in it (distinct, leaders left out)."""
    banded = stored(banded, "bands")
    leaders = banded.groupBy("band", "bucket").agg(F.min("id").alias("leader"), F.count("*").alias("members"))
    shared = stored(leaders.filter("members > 1"), "shared-buckets")
    return weighted_join(banded, shared, ["band", "bucket"], F.col("id"), "members").filter("id <> leader").select("id", "leader").distinct()


def links(items: DataFrame, shingles: Column, threshold: float = THRESHOLD, num_perm: int = NUM_PERM) -> DataFrame:
    return bucket_links(bands(signatures(items, shingles, num_perm), *bands_and_rows(threshold, num_perm)))


def estimated_jaccard(a: Column, b: Column) -> Column:
    """Share of equal signature slots."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(F.size(a) > 0, same / F.size(a)).otherwise(0.0)


def exact_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two distinct-element arrays."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(0.0)


def link_similarity(signed: DataFrame, link: DataFrame) -> DataFrame:
    """``id, leader, estimated, jaccard`` of each link.  A leader's sets are salted: it may lead many members."""
    own = signed.select("id", "shingle_hashes", "signature")
    lead = own.toDF("leader", "lead_hashes", "lead_signature")
    rows = salted_join(link.join(own, "id"), lead, ["leader"], F.col("id"), salts=8)
    return rows.select("id", "leader", estimated_jaccard(F.col("signature"), F.col("lead_signature")).alias("estimated"),
                       exact_jaccard(F.col("shingle_hashes"), F.col("lead_hashes")).alias("jaccard"))


def group_quality(signed: DataFrame, group: str, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(per group, summary)`` of the estimated similarities inside and between groups, over all pairs.

    The mean over pairs is a sum of coinciding slots, so it follows from how often each value occurs per slot and
    group: ``C(n, 2)`` pairs coincide inside a group, ``p1 * p2`` is the coinciding share between two groups.
    No pair is ever formed.
    """
    signed = stored(signed.select(F.col(group).alias("grp"), "signature"), "signatures").filter(F.size("signature") > 0)
    slots = signed.select("grp", F.posexplode("signature").alias("slot", "value"))
    counts = slots.groupBy("grp", "slot", "value").agg(F.count("*").alias("n"))
    sizes = signed.groupBy("grp").agg(F.count("*").alias("members"), F.max(F.size("signature")).alias("slots"))
    pairs = F.col("members") * (F.col("members") - 1) / 2
    same = counts.groupBy("grp").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same"))
    per = sizes.join(same, "grp").withColumn("pairs", pairs)
    intra = F.when(F.col("pairs") > 0, F.col("same") / F.col("slots") / F.col("pairs"))
    per = per.withColumn("intra", intra).withColumn("similar", F.col("intra") >= threshold)
    # Sum over group pairs of p1 * p2 is ((sum p)^2 - sum p^2) / 2 for every slot value.
    share = counts.join(sizes, "grp").withColumn("p", F.col("n") / F.col("members"))
    cross = share.groupBy("slot", "value").agg(((F.sum("p") * F.sum("p") - F.sum(F.col("p") * F.col("p"))) / 2).alias("c"))
    between = cross.agg(F.sum("c").alias("c")).scalar()
    summary = per.agg(
        F.count("*").alias("groups"),
        (F.sum(F.when(F.col("pairs") > 0, F.col("same") / F.col("slots"))) / F.sum("pairs")).alias("avg_intra"),
        F.max("slots").alias("slots"))
    inter = F.when(F.col("groups") > 1, between / F.col("slots") / (F.col("groups") * (F.col("groups") - 1) / 2))
    summary = summary.withColumn("avg_inter", inter).withColumn("separation", F.col("avg_intra") - F.col("avg_inter"))
    return per.select("grp", "members", "intra", "similar"), summary.drop("slots")


def components(nodes: DataFrame, link: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable): alternating neighbour minimum and pointer jumping until stable.

    Both steps are equi-joins with partially aggregated minima; a node with very many links is salted. Unless nodes and links are few,
    no join may send a side to every task (see ``sizing.sided``).
    """
    edges = stored(link.select("id", "leader").union(link.select("leader", "id")).toDF("src", "dst"), "edges")
    labels = cut(nodes.select("id", F.col("id").alias("component")))
    few = fits(labels) and fits(edges)

    def side(df: DataFrame) -> DataFrame:
        return df if few else df.hint("merge")

    while True:
        offered = salted_join(edges, side(labels.toDF("src", "component")), ["src"], F.col("dst"), salts=8)
        best = offered.groupBy(F.col("dst").alias("id")).agg(F.min("component").alias("offer"))
        lowered = labels.join(side(best), "id", "left").select("id", F.col("component").alias("old"), F.least("component", "offer").alias("component"))
        roots = labels.select(F.col("id").alias("component"), F.col("component").alias("root"))
        step = salted_join(lowered, side(roots), ["component"], F.col("id"), salts=8).select("id", "old", F.least("component", "root").alias("component"))
        step = cut(step)
        labels = step.select("id", "component")
        if step.filter("old <> component").isEmpty():
            return labels


def keep_representatives(items: DataFrame, labels: DataFrame) -> DataFrame:
    """Stage one: the smallest id of each cluster stays."""
    return items.join(sided(labels.filter("id = component").select("id")), "id", "left_semi")


def representatives(items: DataFrame, labels: DataFrame) -> DataFrame:
    """Most executed member of each cluster with the cluster size."""
    rows = items.join(sided(labels), "id")
    best = first_per_key(rows.select("component", "id", "exec_count"), ["component"],
                         F.struct(-F.col("exec_count"), F.col("id")))
    sizes = rows.groupBy("component").agg(F.count("*").alias("members"), F.sum("exec_count").alias("total_exec_count"))
    return best.join(sizes, "component").select("component", F.col("id").alias("representative"), "members", "total_exec_count")


# Token shingles, permutations and threshold of the search before insert.
STAGE2_TOKENS, STAGE2_PERM, STAGE2_THRESHOLD = 3, 256, 0.95


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(1.0)


def search_before_insert(new: DataFrame, existing: DataFrame, threshold: float = STAGE2_THRESHOLD,
                         num_perm: int = STAGE2_PERM) -> DataFrame:
    """``id, match, similarity``: the most similar existing template at or above the threshold, else null (insert).

    ``new`` and ``existing`` are ``id, text`` and each free of copies and near copies (stage one and earlier batches),
    so a bucket at this threshold holds few of either side and their pairs are candidates, not a product.
    """
    split = bands_and_rows(threshold, num_perm)

    def banded(df: DataFrame) -> DataFrame:
        toks = df.withColumn("_t", K.search_tokens(F.col("text")))
        return bands(signatures(toks, K.token_shingles(F.col("_t"), STAGE2_TOKENS), num_perm), *split)

    new, existing = stored(new, "new"), stored(existing, "existing")
    left = banded(new)
    right = banded(existing).withColumnRenamed("id", "match")
    pairs = left.join(right, ["band", "bucket"]).select("id", "match").distinct()
    scored = pairs.join(new.select("id", "text"), "id").join(existing.select(F.col("id").alias("match"), F.col("text").alias("known")), "match")
    scored = scored.withColumn("similarity", levenshtein_ratio(F.col("text"), F.col("known"))).filter(F.col("similarity") >= threshold)
    best = top_k(scored, ["id"], [F.desc("similarity"), F.asc("match")], 1).select("id", "match", "similarity")
    return new.select("id").join(best, "id", "left")
