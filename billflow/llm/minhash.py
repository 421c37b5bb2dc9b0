"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

Words are lower-cased (A-Z) runs of anything but ASCII white space; a document's
set holds its distinct shingles (so many words in a row; with fewer words, the
whole sequence as one; none without words). Two documents are linked when
100 * |intersection| >= percent * |union| over the full sets.

1. One pass over the texts makes, per document, the size of its set, a 128-bit
   class (equal sets, equal class) and the band hashes of a SuperMinHash
   signature. Texts do not leave the pass.
2. Documents of one class collapse into its smallest id, so copies cost one row
   each however many they are.
3. Representatives that share a band hash share a bucket. Each is verified
   against the smallest member of its buckets (a star, not all pairs) and groups
   are formed. Members of buckets that still hold different groups are compared
   through an exact prefix and position filter over their full sets, so no link
   between groups is lost and no bucket is expanded into its pairs.
4. Groups are contracted by distributed union-find: every root hooks to its
   smallest neighbour, paths are halved by joins, edges are rewritten, until none
   is left. Nothing is collected to the driver.

With 40 bands of 5 slots a pair at the threshold is missed with probability
(1 - 0.8 ** 5) ** 40, about 1e-7, and only if no third document links the two.

Defined results: a document without words or text (null or empty) has an empty
set and is linked with nothing; rows that share an id count as one document; a
null id has a null component unless a copy has an id, and is kept if it has
none; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.operators.joins import maybe_broadcast

from .common import cut, map_batches, mix64, with_code

_U = np.uint64
BANDS, ROWS = 40, 5
CHUNK = 1 << 18  # shingles whose permutations are held at once
BROADCAST_IDS = 2_000_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_STEP = _U(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one text."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, _U)
    h = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words)))
    if len(h) <= k:
        out = np.array([len(h)], _U)
        for i in range(len(h)):
            out = mix64(out * _STEP + h[i:i + 1])
        return out
    n = len(h) - k + 1
    out = np.full(n, k, _U)
    for i in range(k):
        out = mix64(out * _STEP + h[i:i + n])
    return np.unique(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0 ** -53


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (documents x m) of non-empty sets.

    At level j every element draws the j-th place of its own random permutation
    of the m slots and offers j + (a uniform number) there; a slot keeps the
    smallest offer. Offers of later levels are larger than all of earlier ones,
    so a document stops at the level that fills its last slot.
    """
    el = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sig = np.full(len(sets) * m, np.inf)
    perm = swapped = None
    for j in range(m):
        seed = mix64(np.array([2 * j + 1, 2 * j + 2], _U) * _STEP)
        u = _unit(mix64(el ^ seed[0]))
        slot = j + (_unit(mix64(el ^ seed[1])) * (m - j)).astype(np.int64)
        if j == 0:
            swapped = slot
        else:
            row = np.arange(len(el))
            was = perm[row, slot]
            perm[row, slot] = perm[:, j]
            perm[:, j] = was
            slot = was.astype(np.int64)
        np.minimum.at(sig, doc * m + slot, j + u)
        left = np.isinf(sig.reshape(-1, m)).any(axis=1)
        if not left.any():
            break
        stay = left[doc]
        if j == 0 or stay.sum() < 0.7 * len(stay):
            el, doc = el[stay], doc[stay]
            if j == 0:
                perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(el), 1))
                swapped = swapped[stay]
                perm[np.arange(len(el)), swapped] = 0
                perm[:, 0] = swapped
            else:
                perm = perm[stay]
    return sig.reshape(-1, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = np.ascontiguousarray(sig).view(_U).reshape(len(sig), bands, rows)
    h = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=_U) * _STEP), (len(sig), bands))
    for i in range(rows):
        h = mix64(h * _STEP + cells[:, :, i])
    return h.view(np.int64)


def _sketch(texts: list, k: int, bands: int, rows: int) -> dict:
    sets = [shingle_set(t, k) for t in texts]
    size = np.array([len(s) for s in sets], np.int64)
    keys = np.zeros((2, len(sets)), _U)
    out: list = [[] for _ in sets]
    for i, s in enumerate(sets):
        keys[0, i] = np.sum(mix64(s), dtype=_U)
        keys[1, i] = np.sum(mix64(s ^ _STEP), dtype=_U)
    order = [i for i in np.argsort(size, kind="stable").tolist() if size[i]]  # alike sizes stop alike
    lo = 0
    while lo < len(order):
        hi, total = lo, 0
        while hi < len(order) and (hi == lo or total + size[order[hi]] <= CHUNK):
            total += size[order[hi]]
            hi += 1
        hashes = band_hashes(super_minhash([sets[i] for i in order[lo:hi]], bands * rows), bands, rows)
        for i, h in zip(order[lo:hi], hashes):
            out[i] = h
        lo = hi
    return {"n": size, "c1": keys[0].view(np.int64), "c2": keys[1].view(np.int64), "bands": out}


def sketches(df: DataFrame, id_col: str, text_col: str, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: id, n (set size), c1 and c2 (class of equal sets), bands (band hashes)."""
    t = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col),
                       lambda cols: [{"id": cols[0], **_sketch(cols[1], k, bands, rows)}],
                       f"id {t}, n bigint, c1 bigint, c2 bigint, bands array<bigint>")


def shingle_sets(df: DataFrame, k: int) -> DataFrame:
    """(id, text) -> (id, hashes): the full sets, as 64-bit hashes."""
    return map_batches(df.select("id", "text"),
                       lambda cols: [{"id": cols[0], "hashes": [shingle_set(t, k).view(np.int64) for t in cols[1]]}],
                       f"id {dict(df.dtypes)['id']}, hashes array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as alike as ``percent`` asks."""
    t = dict(pairs.dtypes)["a"]
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            xv, yv = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
            xo, yo = x.offsets.to_numpy(), y.offsets.to_numpy()
            keep = []
            for i in range(batch.num_rows):
                p, q = xv[xo[i]:xo[i + 1]], yv[yo[i]:yo[i + 1]]
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                if 100 * len(small) < percent * len(large):
                    continue
                same = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * same >= percent * (len(p) + len(q) - same):
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep)) for c in (0, 1)],
                                                 names=["a", "b"])

    return with_code(both).mapInArrow(run, f"a {t}, b {t}")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, root): the smallest node of each connected group, for every node of an edge."""
    edges = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                 .select("node", F.col("node").alias("root")))
    while not edges.isEmpty():
        # every larger root hooks to its smallest neighbour ...
        up = cut(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")))
        while True:  # ... and paths are halved until all point at a top
            far = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            nxt = cut(up.join(far, "up", "left").select("node", F.coalesce("top", "up").alias("up"),
                                                        F.col("top").isNotNull().alias("moved")))
            up = nxt.select("node", "up")
            if nxt.filter("moved").isEmpty():
                break
        to = lambda name: up.select(F.col("node").alias(name), F.col("up").alias(f"{name}_up"))
        labels = cut(labels.join(to("root"), "root", "left")
                     .select("node", F.coalesce("root_up", "root").alias("root")))
        edges = cut(edges.join(to("a"), "a", "left").join(to("b"), "b", "left")
                    .select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))
                    .filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def prefix_pairs(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of different roots among ``docs`` (id, root) that can be as alike as ``percent`` asks.

    Prefix and position filter: shingles are ordered by how many of these
    documents hold them, rarest first. Two sets that are alike enough share a
    shingle among the first n - ceil(percent * n / 100) + 1 of each, and the first they
    share leaves enough of both for the overlap they need. A document with many
    shingles of its own thus meets nobody, however large the bucket it came from.
    """
    mine = docs.join(sets, "id").select("id", F.explode("hashes").alias("token"))
    often = mine.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
    placed = (mine.join(often, "token").groupBy("id")
              .agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("t")))  # of one document's own set
    placed = placed.join(docs.join(sets.select("id", F.size("hashes").alias("n")), "id"), "id")
    alone = F.col("n") - F.size("t")  # shingles that no other holds come first
    prefix = F.col("n") - F.ceil(F.lit(int(percent)) * F.col("n") / 100) + 1
    first = placed.select("id", "root", "n", alone.alias("alone"),
                          F.posexplode(F.slice("t", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))))
    first = cut(first.select("id", "root", "n", (F.col("alone") + F.col("pos")).alias("at"), F.col("col.token").alias("token")))
    x = first.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "root", "n", "at")])
    y = first.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "root", "n", "at")])
    need = f"{int(percent)} * (n_a + n_b) <= {100 + int(percent)} * least(n_a - at_a, n_b - at_b)"
    return (x.join(y, (x["token"] == y["token"]) & F.expr("id_a < id_b and root_a <> root_b") & F.expr(need))
            .select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())


def links(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links that connect whatever all links would connect.

    ``shared`` (band, hub, id): the members of every bucket of two or more, with
    the bucket's smallest member as hub.
    """
    star = cut(shared.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    found = cut(verified(star, sets, percent))
    # members of buckets that still hold different groups
    tagged = (shared.select("band", "id").join(components(found).withColumnRenamed("node", "id"), "id", "left")
              .select("band", "id", F.coalesce("root", "id").alias("root")))
    split = (tagged.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                        F.count("*").alias("members"))
             .filter("lo <> hi and members > 2").select("band"))
    rest = cut(tagged.join(split, "band").select("id", "root").distinct())
    pairs = cut(prefix_pairs(rest, sets, percent).join(star, ["a", "b"], "left_anti"))
    return found.unionByName(verified(pairs, sets, percent))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row: id, n_shingles, component_id (smallest id of its group), kept (it is that id)."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    done = cut(sketches(docs, "id", "text", shingle, bands, rows))
    classes = cut(done.filter("n > 0").groupBy("c1", "c2")
                  .agg(F.min("id").alias("id"), F.first("bands").alias("bands")))
    members = classes.filter("id is not null").select(F.explode("bands").alias("band"), "id")
    hubs = cut(members.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("members"))
               .filter("members > 1").select("band", "hub"))
    shared = cut(members.join(hubs, "band").select("band", "hub", "id"))
    needed = cut(shared.select("id").distinct())
    # up to a counted bound the ids go to the texts; beyond it both are shuffled
    sets = cut(shingle_sets(docs.join(maybe_broadcast(needed, BROADCAST_IDS), "id", "left_semi"), shingle))
    groups = components(links(shared, sets, percent))
    rooted = cut(classes.select("c1", "c2", "id").join(groups.withColumnRenamed("node", "id"), "id", "left")
                 .select("c1", "c2", F.coalesce("root", "id").alias("component_id")))
    out = done.select("id", "n", "c1", "c2").join(rooted, ["c1", "c2"], "left")
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, comp.isNull()).alias("kept"))


def _one_of_each(rows: DataFrame, again: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """``rows`` (columns ``keep``) with one row of each key that ``again`` (a column _again) names."""
    again = maybe_broadcast(again, BROADCAST_IDS)
    match = rows[key] == again["_again"]
    packed = rows.join(again, match, "left_semi").select(F.col(key).alias("_id"), F.struct(*keep).alias("row"))
    one = packed.groupBy("_id").agg(F.first("row").alias("row")).select("row.*")
    return rows.join(again, match, "left_anti").select(*keep).unionByName(one)


def _without_copies(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    found = near_duplicates(df, id_col, text_col, shingle, percent)
    gone = cut(found.filter("not kept").select(F.col(id_col).alias("_gone")).distinct())
    gone = maybe_broadcast(gone, BROADCAST_IDS)
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``df``, all columns, one document of each group (rows of one id and text count as one document).

    What goes is few beside what stays, so the ids that go meet the rows (sent to
    them up to a counted bound); only rows that share an id are shuffled. Where an
    id is null or stands on unlike texts, id and text together name a document: a
    text stays unless a copy of it is kept, with an id before one without. Texts
    without words are no copies; those without an id all stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = cut(df.groupBy(F.col(id_col).alias("_again"))
              .agg(F.count("*").alias("n"), (F.min(F.xxhash64(text)) != F.max(F.xxhash64(text))).alias("unlike"))
              .filter("n > 1 or _again is null"))
    if ids.filter("unlike or _again is null").isEmpty():
        left = _without_copies(df, id_col, text_col, shingle, percent)
        again = ids.select("_again")
        return left if again.isEmpty() else _one_of_each(left, again, id_col, df.columns)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   F.xxhash64(text).alias("a"), F.xxhash64(F.lit(17), text).alias("b"))
    keyed = df.select(key.alias("_key"), text.alias("_text"), F.struct(*df.columns).alias("_row"))
    again = cut(keyed.filter(~F.col("_key.none") | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
                .groupBy(F.col("_key").alias("_again")).agg(F.count("*").alias("n")).filter("n > 1").select("_again"))
    left = _without_copies(keyed, "_key", "_text", shingle, percent)
    return _one_of_each(left, again, "_key", ["_row"]).select("_row.*")
