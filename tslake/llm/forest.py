"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

Each text has a signature of minima over its five-word shingles, laid out as paths of eight levels in several tries.
Matching starts with whole paths and shortens them, for each text, until the tries together find any partner that a
text of its size can have with the target recall; sizes of sets allow few similarities where sets are small, so short
texts keep long prefixes. Texts that share a prefix are a bucket. Buckets of the same texts are one, and the buckets
that overlaps connect are compared as one group where that is less work than each by itself; else, as where passages
chain many unlike texts together, each bucket is compared alone, and a pair in the first bucket that it shares. Large groups are cut into
chunks by texts and by bytes, each pair of chunks is a task of bounded size, and what leaves it is a row for each text,
not for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.blocks import folded_rows
from tslake.llm.common import checkpointed, slices, utf8
from tslake.llm.components import connected, looked_up
from tslake.llm.words import BLANK_SEPARATED, U, mix, runs, sequences, words

SHINGLE, THRESHOLD_FIFTHS = 5, 4  # Jaccard of 4/5
TRIES, DEEPEST, RECALL = 24, 8, 0.9999
#: Most texts of a chunk, and about the text bytes of one (a longer text is a chunk by itself).
CHUNK, CHUNK_BYTES = 1024, 8 << 20
_RNG = np.random.Generator(np.random.PCG64(99))
_XOR = _RNG.integers(0, 2**32, TRIES * DEEPEST, dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**31, TRIES * DEEPEST, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def depth(similarity: float, tries: int = TRIES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """Length of the prefixes to match: shortened from the deepest until a pair of this similarity is found with the target recall."""
    for k in range(deepest, 0, -1):
        if 1 - (1 - similarity**k) ** tries >= recall:
            return k
    return 1


def least_similarity(n: int) -> float:
    """The least Jaccard at the threshold that a set of ``n`` elements can have with any other."""
    found = [1.0]
    for m in range(-(-n * THRESHOLD_FIFTHS // 5), n * 5 // THRESHOLD_FIFTHS + 1):
        both = -(-THRESHOLD_FIFTHS * (n + m) // (5 + THRESHOLD_FIFTHS))  # the least that reaches 4/5 of the union
        if 0 < both <= min(n, m):
            found.append(both / (n + m - both))
    return min(found)


#: Sets of this size and more all need the depth of the threshold.
SMALL = 64


def levels_of(n: int) -> list[int]:
    """Levels at which a set of ``n`` elements is listed: its own depth and those of the sizes that its partners can have."""
    sizes = range(max(1, -(-n * THRESHOLD_FIFTHS // 5)), n * 5 // THRESHOLD_FIFTHS + 1)
    return sorted({depth(least_similarity(m)) if m < SMALL else depth(THRESHOLD_FIFTHS / 5) for m in sizes})


_LEVELS = [levels_of(n) if n else [] for n in range(SMALL * 5 // 4 + 1)]


def shingled(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: word hashes (two lanes), words of each text, shingle hashes, shingles of each text.

    A text of fewer than five words, but not none, is one shingle.
    """
    for part in slices(texts):
        data, off, _ = utf8(part)
        *_, counts, h = words(data, off, BLANK_SEPARATED)
        n = h.shape[1]
        first = np.cumsum(counts) - counts
        grams = np.zeros(n, np.uint64)
        full = runs(h[0], SHINGLE)
        grams[: len(full)] = full
        place = np.arange(n) - np.repeat(first, counts)
        left = np.repeat(counts, counts) - place
        keep = left >= SHINGLE
        short = first[(counts > 0) & (counts < SHINGLE)]
        for i in short.tolist():
            grams[i] = runs(h[0, i : i + int(left[i])], int(left[i]))[0]
        keep[short] = True
        yield h, counts, grams[keep], np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))


def text_hashes(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's sequence of words."""
    return sequences(h[0], counts, 0), sequences(h[1], counts, 1)


def trie_keys(grams: np.ndarray, sizes: np.ndarray, tries: int = TRIES) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the prefixes by which texts are listed, how many each text has): a text's levels in each trie."""
    some = np.flatnonzero(sizes)
    step = 1 << 15  # shingles at once, so that they stay near the processor
    at = 0
    begin = np.cumsum(sizes) - sizes
    x32 = (grams >> U(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    listed = np.zeros((len(sizes), DEEPEST + 1), bool)
    for n in np.unique(np.minimum(sizes[some], len(_LEVELS) - 1)).tolist():
        listed[np.flatnonzero(np.minimum(sizes, len(_LEVELS) - 1) == n)[:, None], _LEVELS[n]] = True
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    while at < len(some):
        hi = max(at + 1, int(np.searchsorted(begin[some], begin[some[at]] + step)))
        own = some[at:hi]
        a, b = int(begin[own[0]]), int(begin[own[-1]] + sizes[own[-1]])
        x, cut = x32[a:b], begin[own] - a
        last = int(np.flatnonzero(listed[own].any(axis=0))[-1])
        for t in range(tries):
            key = np.full(len(own), t + 1, np.uint64)
            for k in range(last):
                f = t * DEEPEST + k
                y = (x ^ _XOR[f]) * _TIMES[f]
                key = mix(key * U(0x9E3779B97F4A7C15) + np.minimum.reduceat(y ^ (y >> np.uint32(15)), cut).astype(np.uint64))
                here = listed[own, k + 1]
                keys.append(key[here])
                owners.append(own[here])
        at = hi
    owner = np.concatenate(owners)
    return np.concatenate(keys)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, a, b, n, bytes, keys): two hashes of the words, numbers of shingles and bytes, keys of prefixes (none without shingles)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, keys, many = [], [], [], [], []
            size_of = pc.binary_length(batch.column(1)).cast(pa.int64())
            for h, counts, grams, sizes in shingled(batch.column(1)):
                one, two = text_hashes(h, counts)
                a.append(one)
                b.append(two)
                n.append(sizes)
                own, size = trie_keys(grams, sizes)
                keys.append(own)
                many.append(size)
            if not a:
                continue
            n = np.concatenate(n)
            edges = np.concatenate([[0], np.cumsum(np.concatenate(many))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(keys).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64)), pa.array(n.astype(np.int64)), size_of, listed], ["_id", "a", "b", "n", "bytes", "keys"])

    plain = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return plain.mapInArrow(run, f"_id {kind}, a bigint, b bigint, n bigint, bytes bigint, keys array<bigint>")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (sorted distinct hashes)."""
    n = len(sets)
    value = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(value)))
    out = np.zeros(n * n)
    for g in np.unique(size[size > 1]).tolist():
        own = begin[size == g]
        if g > 64:  # frequent shingles: products of incidence rows
            for lo in range(0, len(own), 2048):
                some = own[lo : lo + 2048]
                rows = np.zeros((len(some), n), np.float32)
                rows[np.repeat(np.arange(len(some)), g), owner[(some[:, None] + np.arange(g)).ravel()]] = 1
                out += (rows.T @ rows).ravel()
        else:
            i, j = np.triu_indices(g, 1)
            for lo in range(0, len(own), max(1, (1 << 21) // len(i))):
                members = owner[own[lo : lo + max(1, (1 << 21) // len(i))][:, None] + np.arange(g)]
                out += np.bincount((members[:, i] * n + members[:, j]).ravel(), minlength=n * n)
    out = out.reshape(n, n)
    return np.maximum(out, out.T)  # either sum fills the upper half; products fill both


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Boolean matrix: Jaccard of at least 4/5; False on the diagonal and for empty sets."""
    sizes = np.array([len(s) for s in sets], float)
    both = overlaps(sets)
    union = sizes[:, None] + sizes[None, :] - both
    out = (5 * both >= THRESHOLD_FIFTHS * union) & (both > 0)
    np.fill_diagonal(out, False)
    return out


def least_connected(nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each node the least node that its links lead to."""
    label = nodes.copy()
    while True:
        new = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            return label
        label = new


def first_shared(buckets: list[np.ndarray], group: int) -> np.ndarray:
    """Boolean matrix: the least bucket that two texts share is ``group``; each text's buckets are sorted and hold it."""
    n = len(buckets)
    earlier = [b[b < group] for b in buckets]
    value, owner = np.concatenate(earlier), np.repeat(np.arange(n), [len(b) for b in earlier])
    out = np.ones((n, n), bool)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else []
    for lo, hi in zip(at, [*at[1:], len(value)]):
        if hi - lo > 1:
            out[np.ix_(owner[lo:hi], owner[lo:hi])] = False
    return out


def _compare(key: tuple, t: pa.Table) -> pa.Table:
    """Links within a chunk, or between two chunks: (node, links, hub)."""
    group, first, second = (k.as_py() for k in key)
    nodes, chunks, sets, buckets = [], [], [], []
    seen = set()
    want, place, shared = (t.column(c).to_pylist() for c in ("node", "chunk", "buckets"))
    at = 0
    for h, counts, grams, sizes in shingled(t.column("_text").combine_chunks()):
        own, _ = text_hashes(h, counts)
        begin = np.cumsum(sizes) - sizes
        for i, (hash_, lo, size) in enumerate(zip(own.view(np.int64).tolist(), begin.tolist(), sizes.tolist())):
            if hash_ == want[at + i] and hash_ not in seen:  # an id may have come with another text
                seen.add(hash_)
                nodes.append(hash_)
                chunks.append(place[at + i])
                sets.append(np.unique(grams[lo : lo + size]))
                buckets.append(shared[at + i])
        at += len(sizes)
    nodes, chunks = np.array(nodes, np.int64), np.array(chunks, np.int64)
    near = similar(sets) if len(sets) else np.zeros((0, 0), bool)
    if first != second:
        near &= chunks[:, None] != chunks[None, :]
    if len(sets) and buckets[0] is not None:
        near &= first_shared([np.sort(np.array(b, np.int64)) for b in buckets], group)
    links = near.sum(axis=1)
    hub = least_connected(nodes, near)
    some = links > 0
    return pa.table([pa.array(nodes[some]), pa.array(links[some].astype(np.int64)), pa.array(hub[some])], ["node", "links", "hub"])


def groups(classes: DataFrame) -> DataFrame:
    """(group, node, size, buckets) of the texts to compare, from ``classes`` (node, keys).

    A group is a set of buckets that overlaps connect, with no ``buckets``, or one bucket, with all of each text's.
    """
    keyed = classes.select("node", F.explode("keys").alias("key"))
    same = [F.count("*"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64(F.lit(1), "node"))]
    buckets = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("_most"), same[0].alias("size"), F.xxhash64(*same).alias("bucket"))
    buckets = buckets.filter("hub < _most").select("key", "hub", "size", "bucket")
    members = checkpointed(keyed.join(buckets, "key").select("bucket", "node", "hub", "size").distinct())
    least = members.groupBy("node").agg(F.min("hub").alias("least"))  # one link of each text, and those of the hubs it ties together
    tied = members.select("node", "hub").join(least, "node").select(F.col("hub").alias("src"), F.col("least").alias("dst"))
    component = connected(least.select(F.col("node").alias("src"), F.col("least").alias("dst")).unionByName(tied).distinct())
    alone = members.select("bucket", "hub", "size").distinct().join(component, F.col("hub") == F.col("node")).groupBy("component").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("_alone"))
    whole = component.groupBy("component").agg(F.count("*").alias("size")).join(alone, "component")
    whole = whole.select("component", "size", (F.col("size").cast("double") * F.col("size") <= F.col("_alone")).alias("_whole"))
    judged = looked_up(component, "component", whole.select(F.col("component").alias("node"), F.struct("size", "_whole").alias("_of")), "_of", "inner").select("*", "_of.*").drop("_of")
    none = F.lit(None).cast("array<bigint>")
    together = judged.filter("_whole").select(F.col("component").alias("group"), "node", "size", none.alias("buckets"))
    apart = members.join(judged.filter("not _whole").select("node"), "node", "left_semi")
    listed = apart.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))  # at most two levels of each trie
    return together.unionByName(apart.join(listed, "node").select(F.col("bucket").alias("group"), "node", "size", "buckets"))


def in_chunks(placed: DataFrame, chunk: int = CHUNK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``placed`` (group, node, size, bytes and others) once for each pair of chunks (first, second) that its chunk is in.

    A group has as many chunks as its texts or their bytes want, whichever is more; its texts are dealt by hash.
    """
    total = placed.groupBy("group").agg(F.sum("bytes").alias("_total")).withColumnRenamed("group", "node")
    placed = looked_up(placed, "group", total, "_total", "inner")
    heavy = F.col("_total") > chunk_bytes
    many = F.greatest(F.ceil(F.sqrt("size") / 2), F.ceil(F.col("size") / chunk), F.ceil(F.col("_total") / chunk_bytes))
    many = F.least(many, F.col("size")).cast("int")  # no more chunks than texts
    placed = placed.withColumn("_chunks", F.when((F.col("size") <= min(chunk, SMALL)) & ~heavy, 1).otherwise(many))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return placed.withColumns({"first": F.least("chunk", "_other"), "second": F.greatest("chunk", "_other")}).drop("_other", "_chunks", "_total", "size", "bytes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, n_copies.

    Shingles are five words (runs without white space). ``class_id`` is the least id of the documents that links of
    Jaccard 0.8 or more connect with this one; ``n_links`` is the number of other texts that it is linked with, and
    ``n_copies`` the number of documents with its very words, itself included. Texts of fewer than five words are one
    shingle. Null, empty and blank texts have none: they are linked with nothing and each is its own class. A row with
    a null id takes no part and gets nulls; repeated rows are copies; an empty table gives none; other columns are
    ignored. Groups of copies are folded before anything is compared, and rows that repeat id and text where texts are
    read. ``chunk`` bounds the texts of a chunk and ``chunk_bytes`` their bytes, so a task holds two chunks however long
    the texts are; a text longer than that is held whole, with those that its chunk's hash deals to it.
    """
    sig = checkpointed(signatures(docs, id_col, text_col))
    real = sig.filter(F.col("_id").isNotNull() & (F.col("n") > 0))
    classes = checkpointed(real.groupBy("a", "b").agg(F.min("_id").alias("rep"), F.count("*").alias("copies"), F.max("bytes").alias("bytes"), F.first("keys").alias("keys")))
    placed = groups(classes.select(F.col("a").alias("node"), "keys")).join(classes.select(F.col("a").alias("node"), "rep", "bytes"), "node")
    placed = in_chunks(placed, chunk, chunk_bytes)
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_id is not null and _text is not null").withColumn("_same", F.xxhash64("_text", "_id"))
    kind = docs.schema[id_col].dataType.simpleString()
    plain = plain.mapInArrow(folded_rows, f"_id {kind}, _text string, _same bigint, _copies int").select(F.col("_id").alias("rep"), "_text")
    texts = plain.join(placed, "rep").select("group", "first", "second", "node", "chunk", "buckets", "_text")
    linked = checkpointed(texts.groupBy("group", "first", "second").applyInArrow(_compare, "node bigint, links bigint, hub bigint"))
    found = connected(linked.select(F.col("node").alias("src"), F.col("hub").alias("dst")))
    links = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    named = classes.select("a", "b", "rep", "copies").join(found, F.col("a") == F.col("node"), "left").drop("node")
    least = named.filter("component is not null").groupBy("component").agg(F.min("rep").alias("_least"))
    named = looked_up(named, "component", least.withColumnRenamed("component", "node"), "_least", "left").join(links, F.col("a") == F.col("node"), "left")
    named = named.select("a", "b", F.coalesce("_least", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("copies").alias("n_copies"))
    own = sig.select("_id", F.when(F.col("_id").isNotNull() & (F.col("n") > 0), F.col("a")).alias("a"), F.when(F.col("n") > 0, F.col("b")).alias("b"))
    alone = F.col("_id").isNotNull()
    return own.join(named, ["a", "b"], "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("n_links", F.when(alone, F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.when(alone, F.lit(1))).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the least id (and of one id the least hash of the text); all columns stay.

    Rows are judged, not ids: where an id comes with several texts, each is kept or dropped by its own class, and of
    near-equal texts under one id one stays. Documents without words, which are like none, and rows with a null id
    stay; rows that repeat id and text become one.
    """
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    found = near_duplicates(docs.select(F.when(F.col(id_col).isNotNull(), row).alias(id_col), text_col), id_col, text_col)
    gone = found.filter(F.col("class_id") != F.col(id_col)).select(F.col(id_col)["id"].alias("_gone"), F.col(id_col)["hash"].alias("_gone_hash")).distinct()
    same = (docs[id_col] == gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti").dropDuplicates([id_col, text_col])
