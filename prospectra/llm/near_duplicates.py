"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document's set is its distinct shingles of consecutive words (ASCII lower case), as 64-bit hashes. Two permutations make the whole
signature: the first spreads hashes over the slots, the second, circularly shifted by k, orders the slots for coordinate k, so
a shingle's share of all coordinates is one contiguous slice of a fixed table. Bands of coordinates give buckets; rows and bands follow
from the threshold so that a pair at the threshold escapes every bucket with a probability of 1e-8 at most.

Documents with equal sets form a class, and only classes are compared. Within a bucket no pairs are listed: every class is verified
against the bucket's pivot, components are built, and only classes outside their pivot's component still need a partner. They meet
those that the triangle inequality (Jaccard distance is a metric) and the sizes allow and that share
enough of what sets them apart from the pivot, found by a prefix-filtered join on those differences. This is exact at every bucket size, links are
confirmed on the full sets, and no link between different texts that share a bucket is lost.

Rows: null and blank texts have empty sets and are linked with nothing; repeated rows and ids each keep a row, and ids are
compared, not rows, so rows that share an id share the verdict; null ids come after all others; other columns pass through; an empty table
gives an empty result; long texts are hashed whole, in blocks. Texts of more than about a million different shingles fill all slots of the first
permutation and meet in one bucket; they are verified against its pivot like all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import materialised, text_or_empty

SLOT_BITS, SEED, MISS, MOST_BANDS = 20, 20240607, 1e-8, 48
#: Ids that are sent to every executor at most, as a hash table (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Parts over which the classes of one component are dealt where they are joined by their label.
SALTS = 16
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CACHE_WORDS = 500_000


def bands_for(threshold: float) -> tuple[int, int]:
    """(rows, bands): the most rows for which MOST_BANDS or fewer bands miss a pair at the threshold with probability MISS at most."""
    fits = [(r, b) for r in range(1, 20) if (b := math.ceil(math.log(MISS) / math.log1p(-(threshold**r)))) <= MOST_BANDS]
    return fits[-1] if fits else (1, MOST_BANDS)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P1
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of k words; a shorter text's whole sequence is its one shingle."""
    words = text.encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width, out = min(k, len(h)), _mix(np.full(max(len(h) - k + 1, min(len(h), 1)), min(k, len(h)), np.uint64))
    for j in range(width):
        out = _mix(out * _P2 + h[j : j + len(out)])
    return np.unique(out)


@cache
def _table(coordinates: int) -> np.ndarray:
    """Row s: the slot s's rank under the second permutation at every shift."""
    ranks = np.random.default_rng(SEED).permutation(1 << SLOT_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:coordinates]]), coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    slots = (_mix(shingles ^ _P2) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)  # the first permutation
    table = _table(coordinates)
    out = table[slots[:512]].min(axis=0)
    for i in range(512, len(slots), 512):
        np.minimum(out, table[slots[i : i + 512]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit key for each band; a band's coordinates lie far apart."""
    grid, key = sig.reshape(rows, bands).astype(np.uint64), _mix(np.arange(1, bands + 1, dtype=np.uint64))
    for row in grid:
        key = _mix(key * _P2 + row)
    return key.view(np.int64)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(text_key, text) -> class_id, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), k).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([pa.array([_class_id(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["class_id", "shingles"])

    return docs.select("text_key", "text").mapInArrow(run, "class_id long, shingles array<long>").filter("class_id IS NOT NULL").dropDuplicates(["class_id"])


def _class_id(shingles: np.ndarray) -> int | None:
    import xxhash

    return int(np.array(xxhash.xxh64_intdigest(shingles.tobytes()), np.uint64).view(np.int64)) if len(shingles) else None


def _fingerprints(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """(id, doc_key, text_key, text) -> id, doc_key, text_key, class_id, n_shingles and the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                sets = [shingle_set(t.as_py(), k) for t in part.column(3)]
                keys = [band_keys(signature(s, rows * bands), rows, bands) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([_class_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "doc_key", "text_key", "class_id", "n_shingles", "keys"],
                )

    return docs.mapInArrow(run, "id long, doc_key long, text_key long, class_id long, n_shingles long, keys array<long>")


def with_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """A semi or anti join whose small side is broadcast only if it was counted and is within BROADCAST_IDS."""
    few = keys.count() <= BROADCAST_IDS
    return df.join(F.broadcast(keys) if few else keys, key, how)


def _by_label(rows: DataFrame, labels: DataFrame, spread: str) -> DataFrame:
    """rows joined with labels, which has one row for a label; each label's rows are dealt out over SALTS parts by spread."""
    dealt = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(spread, F.lit(SALTS)).cast("int")).join(dealt, ["label", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> node, label: the smallest node that can be reached. Labels go to neighbours and along labels until nothing changes."""
    both = materialised(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialised(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        following = materialised(step.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("far", "new")).alias("new")), "labels")
        changed = following.filter("label <> new").limit(1).count()
        labels = following.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) with distance and linked, from the full sets."""
    with_a = pairs.join(sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = with_a.join(sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("sb")), "b")
    counted = both.select("a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"), F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))
    union = F.col("na") + F.col("nb") - F.col("common")
    return counted.select("a", "b", (1 - F.col("common") / union).alias("distance"), (100 * F.col("common") >= percent * union).alias("linked"))


def _differences(around: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, class_id, n, label_class_id, outside) with the pivot's size, how many shingles are gone and come, and all of those as elements."""
    with_pivot = around.join(sets.select(F.col("class_id").alias("pivot"), F.col("shingles").alias("sp")), "pivot")
    both = with_pivot.join(sets.select("class_id", "shingles"), "class_id")
    cut = both.select("pivot", "class_id", "n", "label_class_id", "outside", F.size("sp").alias("p"), F.array_except("sp", "shingles").alias("gone"), F.array_except("shingles", "sp").alias("come"))
    marked = F.transform("gone", lambda v: v.bitwiseXOR(F.lit(0x5555555555555555)))  # a shingle that went is another element than one that came
    return cut.select("pivot", "class_id", "n", "label_class_id", "outside", "p", F.size("gone").alias("gone"), F.size("come").alias("come"), F.concat(marked, "come").alias("elements"))


def _sharing(differences: DataFrame, threshold: float) -> DataFrame:
    """differences with the elements by which links of outsiders are found, rarest first.

    x and y with the same pivot of p shingles share p - gone(x) - gone(y) + c, c being the number of their common elements, so they are linked iff
    c >= w(x) + w(y) - slack, with t = threshold / (1 + threshold), w = (1 - t) gone + t come and slack = (1 - 2 t) p. An outsider has w > slack.
    Hence c > w(y), and c >= w(x) - slack + t. Two sets with c common elements share one among the first size - c + 1 of either in any
    common order.
    """
    t = threshold / (1 + threshold)
    cells = differences.select("pivot", "class_id", F.explode("elements").alias("element"))
    often = cells.groupBy("pivot", "element").agg(F.count("*").alias("times")).filter("times > 1")
    ranked = cells.join(often, ["pivot", "element"]).groupBy("pivot", "class_id").agg(F.sort_array(F.collect_list(F.struct("times", "element")))["element"].alias("ranked"))
    size, w = F.col("gone") + F.col("come"), (1 - t) * F.col("gone") + t * F.col("come")
    # what occurs once stands first and meets nothing
    prefix = lambda least: F.slice("ranked", 1, F.greatest(size - F.greatest(F.ceil(least - 1e-6), F.lit(1)) + 1 - (size - F.size("ranked")), F.lit(0)).cast("int"))
    slack = (1 - 2 * t) * F.col("p")
    return differences.join(ranked, ["pivot", "class_id"]).select("pivot", "class_id", "n", "label_class_id", "outside", "gone", "come", F.size("ranked").alias("ranked_size"), w.alias("w"), slack.alias("slack"), prefix(w - slack + t).alias("as_outsider"), prefix(w).alias("as_any"))


def _more_links(members: DataFrame, checked: DataFrame, found: DataFrame, needed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of classes outside their pivot's component with others of their bucket.

    Buckets of a pivot and one more hold no further pair. Elsewhere, an outsider and a partner must lie within the linked distance of each
    other by the triangle inequality; a pivot's classes that no outsider of it can reach so are left out before their differences are taken.
    """
    threshold, far = percent / 100, 1 - percent / 100
    distances = checked.select(F.col("a").alias("pivot"), F.col("b").alias("class_id"), "distance")
    wide = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 2").select("key")
    around = members.filter("class_id <> pivot").join(wide, "key", "left_semi").select("pivot", "class_id").distinct().join(distances, ["pivot", "class_id"])
    around = around.join(needed.select("class_id", "n"), "class_id").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    around = around.select("pivot", "class_id", "n", "distance", F.coalesce("label", "class_id").alias("label_class_id")).join(found.withColumnRenamed("node", "pivot"), "pivot", "left")
    around = around.withColumn("outside", F.col("label_class_id") != F.coalesce("label", "pivot")).drop("label")
    around = materialised(around, "around")
    nearest = around.filter("outside").groupBy("pivot").agg(F.min("distance").alias("nearest"))
    perhaps = around.join(nearest, "pivot").filter(F.col("distance") >= F.col("nearest") - far - 1e-9)
    sharing = materialised(_sharing(materialised(_differences(perhaps.select(*around.columns), sets), "differences"), threshold), "sharing")
    x, y = (
        d.select("*", F.posexplode(prefix).alias("at", "element")).drop("as_outsider", "as_any").alias(name)
        for d, prefix, name in ((sharing.filter("outside"), "as_outsider", "x"), (sharing, "as_any", "y"))
    )
    apart = (F.col("x.label_class_id") != F.col("y.label_class_id")) & (F.least("x.n", "y.n") >= threshold * F.greatest("x.n", "y.n") - 1e-9)
    needed_common = F.col("x.w") + F.col("y.w") - F.col("x.slack") - 1e-6
    most = F.least("x.gone", "y.gone") + F.least("x.come", "y.come")
    left = lambda d: F.col(f"{d}.ranked_size") - F.col(f"{d}.at")
    same = (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.element") == F.col("y.element"))
    # if this is the first element in common, no more than what follows can be
    pairs = x.join(y, same & apart & (most >= needed_common) & (F.least(left("x"), left("y")) >= needed_common))
    pairs = pairs.select(F.least("x.class_id", "y.class_id").alias("a"), F.greatest("x.class_id", "y.class_id").alias("b")).distinct()
    return materialised(_links(pairs, sets, percent).filter("linked").select("a", "b"), "more-links")


def classes_and_components(docs: DataFrame, k: int, percent: int, id: str, text: str) -> DataFrame:
    """id, doc_key (of id and text), class_id, n_shingles, label and component_id for every row of docs. label: a number of the component,
    null for empty sets, which are linked with nothing.
    """
    rows, bands = bands_for(percent / 100)
    own_text = text_or_empty(text)
    keyed = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.col(id).cast("long"), own_text).alias("doc_key"), F.xxhash64(own_text).alias("text_key"), own_text.alias("text"))
    prints = materialised(_fingerprints(keyed, k, rows, bands), "fingerprints")
    full = prints.filter("n_shingles > 0")
    classes = full.groupBy("class_id").agg(F.min("id").alias("first_id"), F.min("text_key").alias("text_key"), F.max("n_shingles").alias("n"))

    spread = full.select("class_id", F.explode("keys").alias("key"))
    shared = spread.groupBy("key").agg(F.min("class_id").alias("least"), F.max("class_id").alias("last")).filter("least <> last").select("key")
    inside = materialised(spread.join(shared, "key").groupBy("key", "class_id").agg(F.lit(1).alias("one")).drop("one"), "buckets")
    # a bucket's pivot is the class that shares most keys with most others: copies are nearer to what they were copied from than to each other
    central = inside.join(inside.groupBy("key").agg(F.count("*").alias("size")), "key").groupBy("class_id").agg(F.sum("size").alias("weight"))
    pivots = inside.join(central, "class_id").groupBy("key").agg(F.max(F.struct("weight", "class_id"))["class_id"].alias("pivot"))
    members = materialised(inside.join(pivots, "key").select("key", "pivot", "class_id"), "members")
    stars = members.filter("class_id <> pivot").select(F.col("pivot").alias("a"), F.col("class_id").alias("b")).distinct()
    needed = materialised(members.select("class_id").distinct().join(classes, "class_id").select("class_id", "text_key", "n"), "needed")
    texts = with_keys(keyed.select("text_key", "text"), needed.select("text_key"), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    sets = materialised(_sets(texts, k), "sets")
    checked = materialised(_links(stars, sets, percent), "stars")
    found = components(checked.filter("linked"))
    more = _more_links(members, checked, found, needed, sets, percent)
    if more.limit(1).count():
        found = components(checked.filter("linked").select("a", "b").union(more))

    # classes without a link stand alone: only the others are joined by label
    linked = found.withColumnRenamed("node", "class_id").join(classes.select("class_id", "first_id"), "class_id")
    least = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = _by_label(linked, least, "class_id").select("class_id", "label", "component_id")
    home = classes.select("class_id", "first_id").join(of_class, "class_id", "left")
    home = home.select("class_id", F.coalesce("label", "class_id").alias("label"), F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    placed = full.select("id", "doc_key", "class_id", "n_shingles").join(home, "class_id").select("id", "doc_key", "class_id", "n_shingles", "label", "component_id")
    empty = prints.filter("n_shingles = 0").select("id", "doc_key", "class_id", "n_shingles", F.lit(None).cast("long").alias("label"), F.col("id").alias("component_id"))
    return placed.unionByName(empty)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of docs: its id, class_id, n_shingles, component_id and kept (it bears its component's smallest id)."""
    out = classes_and_components(docs, k, percent, id, text).drop("doc_key", "label")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id)


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest id (null ids last), then of the least text hash, once if it is repeated.

    An id that stands for several texts loses only those rows whose component has a smaller one. Rows with empty sets all stay.
    """
    rows = materialised(classes_and_components(docs, k, percent, id, text).filter("label IS NOT NULL").select("id", "doc_key", "label"), "placed")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "doc_key")
    several = rows.groupBy("label").agg(F.count("*").alias("size"), F.min(rank)["doc_key"].alias("best")).filter("size > 1").drop("size")
    member = _by_label(rows, several, "doc_key")
    gone = materialised(member.filter("doc_key <> best").select("doc_key").distinct(), "near-copies")
    again = materialised(member.filter("doc_key = best").groupBy("doc_key").agg(F.count("*").alias("times")).filter("times > 1").select("doc_key"), "repeated-rows")
    keyed = docs.withColumn("_doc_key", F.xxhash64(F.col(id).cast("long"), text_or_empty(text)))
    stay = with_keys(keyed, gone.withColumnRenamed("doc_key", "_doc_key"), "_doc_key", "left_anti")
    if not again.limit(1).count():
        return stay.select(*docs.columns)
    again = again.withColumnRenamed("doc_key", "_doc_key")
    once = with_keys(stay, again, "_doc_key", "left_semi").dropDuplicates(["_doc_key"])
    return with_keys(stay, again, "_doc_key", "left_anti").unionByName(once).select(*docs.columns)
