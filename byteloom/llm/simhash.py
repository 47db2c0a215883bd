"""SimHash near-duplicates over pigeonhole blocks.

A fingerprint is cut into blocks.  Fingerprints that differ in few bits leave
some blocks whole, so they meet in a bucket of those blocks; only rows of one
bucket are compared.  Equal fingerprints are one node throughout, so copies
never make pairs.  In the stage of the pipeline wider fingerprints meet by their
blocks first.  What their sets link is one component from then on; components
meet by a prefix of each set, which finds whatever differs in every block.  Rows
whose fingerprints are close are compared by their sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

SEED = 42
#: Buckets up to this size compare all their pairs; larger ones link by stars, those of the stage in cells.
SMALL_BUCKET = 16

#: The stage: rows of a block of a large bucket, and shingles that a cell compares at a time.
CELL, SLAB = 256, 4096

#: The contract's form: 3-word shingles, 64 bits, links at 2 bits; 2 of 4 blocks stay whole.
BLOCKS, WHOLE = 4, 2

#: The near-duplicate stage: 5-word shingles, similarity 0.8; counters that order shingles.
STAGE_SHINGLE, COUNTERS = 5, 1 << 18
#: Its fingerprints have so many 64-bit words.  Sets that share 0.8 differ in 39 of 256 bits on average with a
#: deviation of 6, so 88 is over 8 deviations away; sets below SMALL_SET are compared whatever their fingerprints.
SKETCH_WORDS, SKETCH_BITS, SMALL_SET = 4, 88, 64
#: Fingerprints that differ in less bits than this have one of so many blocks in common.
SKETCH_BLOCKS = 8
#: Texts are picked by a broadcast of up to this many keys.  Of more keys one bit of a map of up to so many 64-bit words
#: each is broadcast, and texts whose bit is set are joined by a shuffle; so the driver holds some MB whatever the corpus.
BROADCAST_NODES, MAP_WORDS = 50_000, 1 << 17
#: Links that a task of `components` collects before it connects them.
MOST_WAITING = 1 << 20

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256)[None, :]


def shingles(text: str, k: int) -> list[bytes]:
    """Runs of k words, A-Z lower-cased, repeats included; fewer words give one run of them all."""
    words = text.encode().lower().split()
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items, repeat(SEED)), np.uint64, len(items))


def majority(h: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the hashes; 0 for none."""
    lanes = np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048)
    set_in = lanes.reshape(8, 256) @ _BITS
    return np.packbits((2 * set_in > len(h)).ravel(), bitorder="little").view(np.uint64)[0]


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Another hash of each hash (the finaliser of a published generator, SplitMix64)."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def fingerprints(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.array([majority(hashes(shingles(t.as_py(), k))) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("body")).mapInArrow(
        run, f"id {kind}, fingerprint bigint"
    )


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def sorted_links(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def close_links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """(u, v) links that connect all distinct fingerprints at most 2 bits apart.

    `prints` has distinct `fingerprint`s.  A bucket holds the fingerprints that
    agree on two of the four 16-bit blocks.  Small buckets give their pairs
    after a check of the distance.  In a larger bucket every fingerprint is put
    beside each value one bit away outside the agreed blocks: two fingerprints
    are within 2 bits exactly if they share such a value, those at one value
    are all within 2 bits, and there are at most 33 of them.  So no bucket
    makes more than 33 rows for each member, and no link is lost.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("blocks and stars are laid out for up to 2 bits")
    width = 64 // BLOCKS
    masks = [sum(((1 << width) - 1) << (width * b) for b in some) for some in combinations(range(BLOCKS), WHOLE)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select(
        F.col("fingerprint").alias("p"),
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m).cast("bigint")) for m in signed])).alias("t", "block"),
    )
    sizes = keyed.groupBy("t", "block").agg(F.count("*").alias("n")).where("n > 1")
    met = common.checkpointed(keyed.join(sizes, ["t", "block"]))
    small, large = met.where(F.col("n") <= SMALL_BUCKET), met.where(F.col("n") > SMALL_BUCKET)
    other = small.select("t", "block", F.col("p").alias("q"))
    pairs = (
        small.join(other, ["t", "block"])
        .where((F.col("p") < F.col("q")) & (distance(F.col("p"), F.col("q")) <= max_distance))
        .select(*sorted_links(F.col("p"), F.col("q")))
    )
    # Values one bit away; with max_distance below 2 the pairs are checked again below.
    free = [[1 << b for b in range(64) if not m >> b & 1] for m in masks]
    flips = F.array(
        *[F.array(F.lit(0).cast("bigint"), *[F.lit(f - (1 << 64) if f >> 63 else f).cast("bigint") for f in bits]) for bits in free]
    )
    beside = large.select(
        "t", "p", F.explode(F.transform(F.element_at(flips, F.col("t") + 1), lambda f: F.col("p").bitwiseXOR(f))).alias("value")
    )
    stars = (
        beside.groupBy("t", "value")
        .agg(F.collect_list("p").alias("near"))
        .where(F.size("near") > 1)
        .select(F.array_min("near").alias("hub"), F.explode("near").alias("p"))
        .where(F.col("p") != F.col("hub"))
    )
    if max_distance < 2:
        stars = stars.where(distance(F.col("p"), F.col("hub")) <= max_distance)
    return pairs.union(stars.select(*sorted_links(F.col("p"), F.col("hub")))).distinct()


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the least node that the links (u, v) connect it with."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    least = np.arange(len(nodes))
    while len(a):
        a, b = least[a], least[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (further := least[least]).tobytes() != least.tobytes():
            least = further
    lower = np.nonzero(least < np.arange(len(nodes)))[0]
    return nodes[lower], nodes[least[lower]]


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for nodes of links (u, v).

    Alternates the large-star and small-star steps of Kiveris et al. until the
    links are stars.  The links of a node to lesser ones are in one task, which
    connects all that it has (the small star and more); then links follow the
    least link of their lesser end (the large star).  Each round is an exchange
    and a join, cut by a checkpoint; every change of a link lowers an end of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            waiting += [batch] if batch else []
            if batch is None or sum(b.num_rows for b in waiting) > max(MOST_WAITING, len(u)):
                ends = [np.concatenate([x, *(b.column(i).to_numpy() for b in waiting)]) for i, x in enumerate((u, v))]
                (u, v), waiting = contracted(*ends), []
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def small_stars(edges: DataFrame) -> DataFrame:
        return common.checkpointed(edges.repartition("u").mapInArrow(run, "u bigint, v bigint"))

    edges = small_stars(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v"))
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(state)
        least = edges.groupBy(F.col("u").alias("its")).agg(F.min("v").alias("m"))
        large = edges.join(least, F.col("v") == F.col("its"), "left").select("u", F.coalesce("m", "v").alias("v"))
        edges = small_stars(large)


def near_duplicates(
    docs: DataFrame, k: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, `fingerprint` (16 hex digits), `component_id` (least id reachable), per row.

    NULL is the empty text; a text without words has fingerprint zero and is
    linked like any other.  Repeated rows share fingerprint and component.  A
    NULL id is never the component's id unless it has no other.  An empty
    table gives an empty result.
    """
    rows = common.checkpointed(fingerprints(docs, k, id_col, text_col))
    nodes = common.checkpointed(rows.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = components(close_links(nodes.select("fingerprint"), max_distance))
    rooted = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 bits."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))


# --- the stage: 5-word shingles, similarity 0.8 --------------------------------


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of 5 words; fewer words give one run of them all."""
    words = hashes(text.encode().lower().split())
    if not len(words):
        return words
    k = min(STAGE_SHINGLE, len(words))
    n = len(words) - k + 1
    runs = np.full(n, k, np.uint64)
    for i in range(k):
        runs = mixed(runs ^ words[i : i + n], i)
    return np.unique(runs)


def counters(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many shingles of the texts fall on each of COUNTERS; they only order shingles, rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                sets = [shingle_set(t.as_py()) for t in batch.column(0)[start : start + 256]]
                total += np.bincount((np.concatenate(sets) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["counter", "n"])

    # At most COUNTERS rows, whatever the corpus.
    rows = docs.select(common.text_of(text_col).alias("body")).mapInArrow(run, "counter bigint, n bigint")
    rows = rows.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows["counter"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefix(grams: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first shingles in the order of all texts; two sets of share 0.8 or more have one of them in common.

    A set of n has at least 4n/5 members in common with any such other set, so
    the first of the common ones is among the first n - ceil(4n/5) + 1 of both.
    """
    n = len(grams)
    order = np.lexsort((grams, count[(grams % np.uint64(COUNTERS)).astype(np.int64)]))
    return grams[order[: n - (4 * n + 4) // 5 + 1]]


def sketch(grams: np.ndarray) -> np.ndarray:
    """The SimHash of a shingle set in SKETCH_WORDS words."""
    return np.array([majority(mixed(grams, 64 + i)) for i in range(SKETCH_WORDS)], np.uint64).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, body_a, body_b, node, size, tokens, sketch) of every row.

    `node` is a hash of the set of 5-word shingles, `size` their number,
    `tokens` the prefix of the set by which it meets others and `sketch` its
    fingerprint.
    """
    count = docs.sparkSession.sparkContext.broadcast(counters(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, tokens, sketches = [], [], [], []
            for t in batch.column(3):
                grams = shingle_set(t.as_py())
                nodes.append(xxhash.xxh64_intdigest(grams.tobytes(), SEED))
                sizes.append(len(grams))
                tokens.append(prefix(grams, count.value).view(np.int64))
                sketches.append(sketch(grams))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)), pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()), *(pa.array(a, pa.list_(pa.int64())) for a in (tokens, sketches)),
                ],
                ["id", "body_a", "body_b", "node", "size", "tokens", "sketch"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    body = common.text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"), *body_keys(body), body.alias("body")
    ).mapInArrow(run, f"id {kind}, body_a bigint, body_b bigint, node bigint, size bigint, tokens array<bigint>, sketch array<bigint>")


def body_keys(body: Column) -> list[Column]:
    return [F.xxhash64(body).alias("body_a"), F.xxhash64(F.lit(1), body).alias("body_b")]


def picked(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The `texts` (body_a, ...) that may have one of the `keys` (body_a); few others pass.  No text is moved for it."""
    # About 16 bits for each key, as far as MAP_WORDS goes.
    words = min(MAP_WORDS, 1 << max(keys.count() // 4, 1).bit_length())

    def word(key: str) -> Column:
        return F.shiftright(key, 6).bitwiseAND(F.lit(words - 1).cast("bigint"))

    def bit(key: str) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(key).bitwiseAND(F.lit(63).cast("bigint")).cast("int"))

    bits = keys.groupBy(word("body_a").alias("word")).agg(F.bit_or(bit("body_a")).alias("bits"))
    return texts.join(F.broadcast(bits), word("body_a") == F.col("word")).where(F.col("bits").bitwiseAND(bit("body_a")) != 0).drop("word", "bits")


def sets_of(docs: DataFrame, some: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, grams): the shingle sets of the nodes of `some` (node, id, body_a, body_b), one row for each; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingle_set(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.list_(pa.int64()))], ["node", "grams"])

    some = common.stored(some, "some")
    few = some.count() <= BROADCAST_NODES
    body = common.text_of(text_col)
    texts = docs.select(F.col(id_col).alias("id"), body.alias("body"), *body_keys(body))
    keys = some.toDF("node", "its_id", "its_a", "its_b")
    texts = (
        (texts if few else picked(texts, some.select("body_a")))
        .join(
            F.broadcast(keys) if few else keys,
            (F.col("body_a") == F.col("its_a")) & (F.col("body_b") == F.col("its_b")) & F.col("id").eqNullSafe(F.col("its_id")),
        )
        .select("node", "body")
    )
    grams = common.stored(texts.mapInArrow(run, "node bigint, grams array<bigint>").dropDuplicates(["node"]), "grams")
    common.forget(some)
    return grams


def close(size: Column, its_size: Column, words: Column, its_words: Column) -> Column:
    """Whether two sets can share 0.8 by their sizes and fingerprints."""
    bits = sum((distance(F.get(words, F.lit(i)), F.get(its_words, F.lit(i))) for i in range(SKETCH_WORDS)), F.lit(0))
    alike = 5 * F.least(size, its_size) >= 4 * F.greatest(size, its_size)
    return alike & ((bits <= SKETCH_BITS) | (F.least(size, its_size) < SMALL_SET))


def spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the pairs of a symmetric matrix connect."""
    links, fresh = [], near.any(axis=1)
    for first in np.nonzero(fresh)[0].tolist():
        if not fresh[first]:
            continue
        fresh[first], open_ = False, [first]
        while open_:
            at = open_.pop()
            met = np.nonzero(near[at] & fresh)[0].tolist()
            fresh[met] = False
            open_ += met
            links += [(at, other) for other in met]
    return links


def linked(nodes: np.ndarray, links: list[tuple[int, int]]) -> pa.Table:
    u, v = nodes[[a for a, _ in links]], nodes[[b for _, b in links]]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def close_forest(met: DataFrame) -> DataFrame:
    """(u, v) links that connect all close rows (cell, node, root, size, sketch) of a cell with different roots.

    This is the Hamming check.  Cells go by a hash; two that share one are compared together.
    """

    def run(rows: pa.Table) -> pa.Table:
        size, root = rows["size"].to_numpy(), rows["root"].to_numpy()
        words = pa.concat_arrays(rows["sketch"].chunks).flatten().to_numpy().view(np.uint64).reshape(len(size), SKETCH_WORDS)
        bits = sum(np.bitwise_count(words[:, None, i] ^ words[None, :, i]).astype(np.int16) for i in range(SKETCH_WORDS))
        least, most = np.minimum(size[:, None], size[None, :]), np.maximum(size[:, None], size[None, :])
        near = (5 * least >= 4 * most) & ((bits <= SKETCH_BITS) | (least < SMALL_SET)) & (root[:, None] != root[None, :])
        return linked(rows["node"].to_numpy(), spanning(near))

    met = met.select(F.xxhash64("cell").alias("cell"), "node", "root", "size", "sketch")
    return met.groupBy("cell").applyInArrow(run, "u bigint, v bigint")


def clumps(links: DataFrame) -> DataFrame:
    """(token, node, n): the nodes of links, by the least node reachable, and their number."""
    stars = components(links)
    rows = stars.select(F.col("root").alias("token"), "node").union(stars.select("root", "root").distinct())
    return common.stored(rows.join(rows.groupBy("token").agg(F.count("*").alias("n")), "token"), "clumps")


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what the pairs of share 0.8 or more connect; all pairs are compared."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), size)
    shared = np.bincount(place, minlength=len(values)) > 1
    keep = shared[place]
    row, place = row[keep], (np.cumsum(shared) - 1)[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    both = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), SLAB):
        lo, hi = np.searchsorted(place, [start, start + SLAB])
        here = np.zeros((n, min(SLAB, int(place[hi - 1]) - start + 1)), np.float32)
        here[row[lo:hi], place[lo:hi] - start] = 1
        both += here @ here.T
    near = 9 * both.astype(np.int64) >= 4 * (size[:, None] + size[None, :])
    return spanning(near)


def cell_links(cells: DataFrame, grams: DataFrame) -> DataFrame:
    """(u, v) links of the cells (cell, node); each compares all its pairs and has some hundred rows."""

    def run(rows: pa.Table) -> pa.Table:
        nodes = rows["node"].to_numpy()
        links = forest([g.values.to_numpy() for g in rows["grams"]]) if len(nodes) > 1 else []
        return linked(nodes, links)

    return cells.join(grams, "node").select("cell", "node", "grams").groupBy("cell").applyInArrow(run, "u bigint, v bigint")


def with_roots(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component, with `root`."""
    rooted = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    return common.stored(rooted.join(several, "token"), "rooted")


def block_cells(nodes: DataFrame) -> DataFrame:
    """(cell, node, root, size, sketch): the nodes that have a block of their fingerprint in common, in cells of CELL."""
    halves = [
        half
        for i in range(SKETCH_WORDS)
        for half in (F.get("sketch", F.lit(i)).bitwiseAND(F.lit((1 << 32) - 1).cast("bigint")), F.shiftrightunsigned(F.get("sketch", F.lit(i)), 32))
    ]
    keyed = nodes.select("node", "size", "sketch", F.posexplode(F.array(*halves)).alias("t", "block"))
    sizes = keyed.groupBy("t", "block").agg(F.count("*").alias("n")).where("n > 1")
    part = F.pmod(F.xxhash64("node", "t"), F.ceil(F.col("n") / CELL))
    return keyed.join(sizes, ["t", "block"]).select(
        F.struct("t", "block", part.alias("part")).alias("cell"), "node", F.col("node").alias("root"), "size", "sketch"
    )


def cross_cells(rest: DataFrame) -> DataFrame:
    """(cell, node, root) of buckets (token, node, root, n): rows of different roots meet in a cell of two blocks of CELL.

    One of the blocks at least is outside the largest component of the bucket.
    """
    main = (
        rest.groupBy("token", "root").agg(F.count("*").alias("of_root"))
        .groupBy("token").agg(F.max(F.struct("of_root", "root")).alias("main"))
        .select("token", F.col("main.root").alias("main"), F.col("main.of_root").alias("of_main"))
    )
    outside, inside = F.ceil((F.col("n") - F.col("of_main")) / CELL), F.ceil(F.col("of_main") / CELL)
    is_main = F.col("root") == F.col("main")
    own = F.when(is_main, F.col("outside") + F.pmod(F.xxhash64("node"), "inside")).otherwise(F.pmod(F.xxhash64("node"), "outside"))
    against = F.when(is_main, F.col("outside")).otherwise(F.col("outside") + F.col("inside"))
    return (
        rest.join(main, "token").withColumn("outside", outside).withColumn("inside", inside)
        .select("node", "root", "token", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), against - 1)).alias("its"))
        .select(F.struct("token", F.least("own", "its").alias("a"), F.greatest("own", "its").alias("b")).alias("cell"), "node", "root")
    )


def similar_links(nodes: DataFrame, grams_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(u, v) links that connect all nodes (node, size, tokens, sketch) whose shingle sets share 0.8 or more.

    First nodes meet by pigeonhole blocks: fingerprints that differ in less than
    SKETCH_BLOCKS bits have a block in common, and many others do.  Those that
    pass the Hamming check are clumps; the sets of a clump are compared in
    cells of CELL rows, twice dealt, and the links found are made components.

    Sets that share 0.8 may differ in every block, so then nodes meet in a
    bucket of each of their tokens.  A bucket of several components compares all
    pairs of different ones that pass the Hamming check: small buckets as
    pairs, large ones in cells of two blocks, of which one at least is outside
    the largest component.  What large buckets leave is made clumps first, so
    that a set is fetched once for its clump and not for each of its tokens.
    Only pairs that are connected already are not compared, so no link is lost
    whatever the size of a bucket.
    """

    def links_of(cells: DataFrame) -> DataFrame:
        cells = common.stored(cells, "cells")
        grams = grams_of(cells.select("node").distinct())
        links = common.checkpointed(cell_links(cells, grams))
        common.forget(cells, grams)
        return links

    close_by_blocks = clumps(close_forest(block_cells(nodes)))
    salts = F.sequence(F.lit(0), F.when(F.col("n") > CELL, 1).otherwise(0))
    dealt = F.pmod(F.xxhash64("node", "salt"), F.ceil(F.col("n") / CELL))
    cells = close_by_blocks.select("node", "token", "n", F.explode(salts).alias("salt")).select(
        "node", F.struct("token", "salt", dealt.alias("block")).alias("cell")
    )
    found = links_of(cells)
    common.forget(close_by_blocks)

    keyed = nodes.select("node", "size", F.posexplode("tokens").alias("place", "token"))
    member = F.xxhash64("node")
    sizes = common.checkpointed(
        keyed.groupBy("token").agg(
            F.count("*").alias("n"), F.bit_xor(member).alias("x"), F.sum(F.shiftright(member, 20)).alias("s")
        ).where("n > 1")
    )
    # Of large buckets of the same nodes one is enough; small ones keep their places for the bound below.
    large_sizes = sizes.where(F.col("n") > SMALL_BUCKET).groupBy("n", "x", "s").agg(F.min("token").alias("token"))
    sizes = sizes.where(F.col("n") <= SMALL_BUCKET).select("token", "n").union(large_sizes.select("token", "n"))
    met = common.stored(keyed.join(sizes, "token"), "met")
    prints = common.stored(nodes.select("node", "size", "sketch").join(met.select("node").distinct(), "node"), "prints")
    rest = with_roots(met, components(found))

    small = rest.where(F.col("n") <= SMALL_BUCKET)
    other = small.select("token", *(F.col(c).alias(f"its_{c}") for c in ("node", "size", "place", "root")))
    # The first token that two sets have in common leaves room for the share that is asked for.
    room = F.least(F.col("size") - F.col("place"), F.col("its_size") - F.col("its_place"))
    pairs = (
        small.join(other, "token")
        .where((F.col("node") > F.col("its_node")) & (F.col("root") != F.col("its_root")))
        .where(9 * room >= 4 * (F.col("size") + F.col("its_size")))
        .select(F.col("node").alias("u"), F.col("its_node").alias("v")).distinct()
        .join(prints.toDF("u", "size", "sketch"), "u")
        .join(prints.toDF("v", "its_size", "its_sketch"), "v")
        .where(close(F.col("size"), F.col("its_size"), F.col("sketch"), F.col("its_sketch")))
        .select("u", "v")
    )
    pairs = common.stored(pairs, "pairs")
    grams = grams_of(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    links = (
        pairs.join(grams.toDF("u", "a"), "u")
        .join(grams.toDF("v", "b"), "v")
        .where(9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b")))
        .select("u", "v")
    )
    found = common.checkpointed(found.union(links))
    common.forget(pairs, grams, rest)

    roots = components(found)
    rest = with_roots(met.where(F.col("n") > SMALL_BUCKET), roots)
    close_by_tokens = clumps(close_forest(cross_cells(rest).join(prints, "node")))
    common.forget(rest, met, prints)
    rest = with_roots(close_by_tokens, roots)
    found = common.checkpointed(found.union(links_of(cross_cells(rest).select("cell", "node"))))
    common.forget(rest, close_by_tokens)
    return found


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near duplicates: the least id of each group stays.

    Near means that the sets of 5-word shingles share 0.8 or more of their
    union; groups are what such links connect.  NULL is the empty text; texts
    without words are one group.  Of repeated rows one stays; a NULL id stays
    only where a group has no other.
    """
    signed = common.stored(signatures(docs, id_col, text_col), "signatures")
    nodes = common.stored(signed.groupBy("node").agg(*(F.first(c).alias(c) for c in ("size", "tokens", "sketch"))), "nodes")
    rows = common.stored(signed.select("id", "body_a", "body_b", "node"), "rows")
    common.forget(signed)

    def grams_of(some: DataFrame) -> DataFrame:
        one = F.min(F.struct("id", "body_a", "body_b")).alias("one")
        return sets_of(docs, rows.join(some, "node").groupBy("node").agg(one).select("node", "one.*"), id_col, text_col)

    roots = components(similar_links(nodes, grams_of))
    common.forget(nodes)
    rank = F.struct(F.col("id").isNull().alias("null_id"), F.col("id"), F.col("body_a"), F.col("body_b"))
    best = rows.groupBy("node").agg(F.min(rank).alias("best")).join(
        roots.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left"
    )
    stay = (
        best.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
        .select("best.id", "best.body_a", "best.body_b")
    )
    repeats = rows.groupBy("id", "body_a", "body_b").agg(F.count("*").alias("times"))
    stay = stay.alias("s").join(
        repeats.alias("r"),
        F.col("s.id").eqNullSafe(F.col("r.id")) & (F.col("s.body_a") == F.col("r.body_a")) & (F.col("s.body_b") == F.col("r.body_b")),
    ).select(F.col("s.id").alias("stay_id"), F.col("s.body_a").alias("stay_a"), F.col("s.body_b").alias("stay_b"), "times")
    stay = common.checkpointed(stay)
    common.forget(rows)
    body = common.text_of(F.col("row")[text_col])
    kept = (
        common.wrapped(docs)
        .withColumn("a", F.xxhash64(body))
        .withColumn("b", F.xxhash64(F.lit(1), body))
        .join(stay, (F.col("a") == F.col("stay_a")) & (F.col("b") == F.col("stay_b")) & F.col("row")[id_col].eqNullSafe(F.col("stay_id")))
    )
    once = kept.where("times = 1").select("row.*")
    again = kept.where("times > 1").dropDuplicates(["a", "b", "stay_id"]).select("row.*")
    return once.union(again)
