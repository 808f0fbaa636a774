"""Near-duplicates by b-bit MinHash: bands of minima give candidates, packed low bits estimate, full shingle sets confirm."""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import mix, word_hashes

ROWS, HASHES, BITS, WIDTH = 8, 1024, 2, 5
#: A pair at the threshold misses all bands with this chance at most.
MISS = 3.5e-6
#: What small sets add to the square of the margin, times the size of the smaller one: the functions leave low bits tied to the element, so few elements give fewer independent bits.
SMALL = 0.4
LONGS = HASHES // 64
SKETCH = "doc_id long, tag long, n_shingles long, set_a long, set_b long, bands array<long>, low array<long>"
_RNG = np.random.default_rng(20240607)
_TIMES = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_PLACES = _RNG.integers(0, 1 << 63, WIDTH + 1, dtype=np.uint64) | np.uint64(1)
_ROWS = _RNG.integers(0, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's WIDTH-word shingles; with fewer words, the whole sequence as one; without words none."""
    words, counts = word_hashes(texts)
    if not len(words):
        return [np.zeros(0, np.uint64)] * len(counts)
    whole = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
    for k in range(WIDTH):
        whole += words[k : k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WIDTH:
            s = np.sort(whole[at : at + n - WIDTH + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif n:
            out.append(mix((words[at : at + n] * _PLACES[:n]).sum(keepdims=True) + np.full(1, n, np.uint64) * _PLACES[WIDTH]))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def minima(shingles: np.ndarray, block: int = 64) -> np.ndarray:
    """The least value of each hash function over a set; by blocks that stay in cache."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_TIMES), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), block):
        m = x[i : i + block, None] * _TIMES
        m ^= _PLUS
        np.minimum(out, m.min(axis=0), out=out)
    return out


def band_count(percent: int) -> int:
    """Bands of ROWS minima that a threshold needs: 40 at 85, 69 at 80."""
    return math.ceil(math.log(MISS) / math.log(1 - (min(percent, 85) / 100) ** ROWS))


def _sketch(bands: int):
    return lambda batches: _sketches(batches, bands)


def _sketches(batches: Iterator, n_bands: int) -> Iterator:
    import pyarrow as pa

    for whole in batches:
        for b in common.slices(whole, 1, 1 << 20):
            sets = shingle_sets(b.column(1))
            full = [i for i, s in enumerate(sets) if len(s)]
            low = np.zeros((len(sets), len(_TIMES)), np.uint32)
            for i in full:
                low[i] = minima(sets[i])
            bands = (low[:, : n_bands * ROWS].reshape(len(sets), n_bands, ROWS).astype(np.uint64) * _ROWS).sum(axis=2) + np.arange(n_bands, dtype=np.uint64) * _PLACES[0]
            bands = mix(bands).view(np.int64)
            planes = np.concatenate([np.packbits((low >> np.uint32(k)) & np.uint32(1), axis=1).view(np.int64) for k in range(BITS)], axis=1)
            a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            c = np.array([mix(s ^ _PLACES[1]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(a), pa.array(c), lists(bands), lists(planes)], ["doc_id", "tag", "n_shingles", "set_a", "set_b", "bands", "low"])


def estimate(x: Column, y: Column) -> Column:
    """Similarity estimated from packed low bits, corrected for collisions: unequal minima agree in BITS bits by chance."""
    differ = F.lit(0)
    for i in range(LONGS):
        d = F.lit(0).cast("long")
        for k in range(BITS):
            d = d.bitwiseOR(x[i + k * LONGS].bitwiseXOR(y[i + k * LONGS]))
        differ = differ + F.bit_count(d)
    chance = 2.0**-BITS
    return (1 - differ / HASHES - chance) / (1 - chance)


def plausible(x: str, y: str, percent: int, margin: float) -> Column:
    """Whether rows x and y, each with n_shingles and low, may reach the threshold: by their sizes, and by the estimate less a margin that grows as sets shrink."""
    m, n = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    least = percent / 100 - F.sqrt(margin * margin + SMALL / F.least(m, n))
    return (F.least(m, n) * 100 >= F.greatest(m, n) * percent) & (estimate(F.col(f"{x}.low"), F.col(f"{y}.low")) >= least)


def _pair_of(rep) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of a column of class names."""
    rep = rep.combine_chunks() if hasattr(rep, "combine_chunks") else rep
    return rep.field("set_a").to_numpy(zero_copy_only=False), rep.field("set_b").to_numpy(zero_copy_only=False)


def _confirm(percent: int):
    """Of a block's pairs (block, a, b) and the texts (block, rep, text) of the classes in it: the pairs that reach the threshold."""

    def confirm(pairs, texts):
        import pyarrow as pa

        own = dict(zip(zip(*(x.tolist() for x in _pair_of(texts.column("rep"))), strict=True), shingle_sets(texts.column("text")), strict=True))
        keep = []
        for a, b in zip(zip(*(x.tolist() for x in _pair_of(pairs.column("a"))), strict=True), zip(*(x.tolist() for x in _pair_of(pairs.column("b"))), strict=True), strict=True):
            x, y, both = own[a], own[b], 0
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


NODE = "struct<set_a: long, set_b: long>"
#: Members of a bucket or star that are compared at a time: what bounds a task's groups.
BLOCK = 128


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (block, a, b) of classes whose full sets reach the threshold, as (a, b). A class's text goes once to each block that needs it, and gives its set there once."""
    held = common.materialize(pairs.select("block", F.explode(F.array("a", "b")).alias("rep")).distinct(), "blocks")
    nodes = common.materialize(held.select("rep").distinct().join(classes.select("rep", "doc_id", "tag"), "rep"), "nodes")
    texts = docs.where(common.flagged(F.col("tag"), nodes, "tag")).join(nodes, ["doc_id", "tag"]).select("rep", "text").dropDuplicates(["rep"])
    texts = common.materialize(texts, "texts")
    near = pairs.groupBy("block").cogroup(held.join(texts, "rep").groupBy("block")).applyInArrow(_confirm(percent), f"a {NODE}, b {NODE}")
    return common.materialize(near.distinct(), "links")


def _plausible(table, percent: int, margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """Of the members of a block, or of two blocks, of a bucket: each member with those of other components that it may reach the threshold with, as `plausible` has it, by rows.

    A pair that shares several buckets counts in that of its first band in common alone: `heads` has the low 32 bits of each band's key.
    """
    sub, band = table.column("sub").to_numpy(), table.column("band")[0].as_py()
    rows = lambda c: np.stack([x.values.to_numpy() for x in table.column(c).combine_chunks()])
    low, heads = rows("low").view(np.uint64), rows("heads")[:, :band]
    n, part = table.column("n_shingles").to_numpy(), [table.column("component").combine_chunks().field(c).to_numpy() for c in ("set_a", "set_b")]
    i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
    one, two = (np.flatnonzero(sub == i), np.flatnonzero(sub == j))
    for x in one:
        y = two[two > x] if i == j else two
        y = y[(part[0][y] != part[0][x]) | (part[1][y] != part[1][x])]
        y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
        y = y[~(heads[y] == heads[x]).any(axis=1)]
        if not len(y):
            continue
        differ = low[y] ^ low[x]
        differ = functools.reduce(np.bitwise_or, [differ[:, k * LONGS : (k + 1) * LONGS] for k in range(BITS)])
        chance = 2.0**-BITS
        like = (1 - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) / HASHES - chance) / (1 - chance)
        y = y[like >= percent / 100 - np.sqrt(margin * margin + SMALL / np.minimum(n[y], n[x]))]
        if len(y):
            yield x, y


def _wanted_members(percent: int, margin: float):
    """The rows (key, i, j, rep) of a block's members that are in a plausible pair: those whose texts are needed."""

    def wanted(table):
        held = np.zeros(table.num_rows, bool)
        for x, y in _plausible(table, percent, margin):
            held[x] = True
            held[y] = True
        return table.filter(held).select(["key", "i", "j", "rep"])

    return wanted


def _confirmed_in_block(percent: int, margin: float):
    """Links (a, b) of a block's members, with their texts, that reach the threshold: of those that are already linked through others of the block none, so fewer than members."""

    def confirm(table):
        import pyarrow as pa

        sets = shingle_sets(table.column("text").combine_chunks())
        part = table.column("component").combine_chunks()
        first: dict = {}
        # members of one component are one from the start
        root = [first.setdefault(p, k) for k, p in enumerate(zip(*(part.field(c).to_pylist() for c in ("set_a", "set_b")), strict=True))]

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        xs, ys = [], []
        for x, others in _plausible(table, percent, margin):
            for y in others.tolist():
                p, q = find(int(x)), find(y)
                if p == q:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    root[p] = q
                    xs.append(int(x))
                    ys.append(y)
        rep = table.column("rep").combine_chunks()
        return pa.table({"a": rep.take(pa.array(xs, pa.int64())), "b": rep.take(pa.array(ys, pa.int64()))})

    return confirm


def near_duplicates(docs: DataFrame, percent: int = 85, margin: float = 0.07) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of doc_id, text: documents linked where 100 * intersection >= percent * union of
    their shingle sets; component_id is the smallest doc_id reachable, kept is doc_id = component_id.

    1. One pass sketches each text: set size, a 128-bit set hash, band keys of ROWS minima, the minima's low BITS.
       At the threshold a pair misses all bands with a chance of 3e-6: 40 bands at 85, 69 at 80.
    2. Equal sets become one class, named by the set hash, through a grouped minimum, so copies cost one row each.
    3. Star: every member of a band's bucket is compared with one only, the member with most neighbours over all its buckets; the low bits discard pairs
       estimated under the threshold less `margin`, widened for small sets (over five standard deviations at any size),
       full sets confirm the rest.
    4. Where a bucket still holds several components, its members are compared in blocks of BLOCK: those of two blocks meet in a task,
       but for two blocks of the largest component, and it compares members of different components by their packed bits, each pair in the bucket of its
       first common band alone. A group of copies of any size, once joined, costs nothing here.
    Plausible pairs are never written: a first pass names the members that have one, a second gets these with their texts, finds the pairs again
    and confirms those not yet linked within the block, so it gives fewer links than members. (Sets of hashes would spare computing, but don't compress: 4.81 x input on disk.)
    No cap on buckets or partners. Nothing but counts and a bitmap of bounded size goes to the driver.
    Null text or no words: an empty set, linked with nothing. Null doc_id: never linked, component_id and kept null.
    Rows that share a doc_id but not a text are linked apart, each by its own set; `kept` is then of the row, not of the
    id. Repeated rows are returned each. No rows: no rows. Other columns are ignored, whatever their names.
    """
    return _judged(docs, percent, margin).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, margin: float = 0.07) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns; rows without a doc_id or without words stay.

    A row goes for its own text alone: another one that shares its doc_id is judged apart. Repeated rows of a kept text stay each.
    """
    row, key, tag = (f"_{n}_{uuid.uuid4().hex}" for n in ("row", "key", "tag"))
    gone = _judged(docs, percent, margin).where("not kept").select(F.col("doc_id").alias(key), F.col("tag").alias(tag)).distinct()
    mine = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    on = (F.col(f"{row}.doc_id").cast("long") == F.col(key)) & (F.xxhash64(F.col(f"{row}.text").cast("string")) == F.col(tag))
    return mine.join(gone, on, "left_anti").select(f"{row}.*")


def _judged(docs: DataFrame, percent: int, margin: float) -> DataFrame:
    """doc_id, tag (a hash of the text), n_shingles, component_id, kept of each row."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100")
    common.ship(docs.sparkSession)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("tag"))
    with common.scratch(docs.sparkSession) as keep:
        sketch, classes, found = _components(docs, percent, margin)
        linked = found.withColumnRenamed("node", "rep").join(classes.select("rep", "doc_id"), "rep")
        least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        named = common.materialize(linked.join(least, "component").select("rep.*", "component_id"), "named")
        keep += [sketch, classes, named]
    sets = ["set_a", "set_b"]
    full = sketch.where("n_shingles > 0 and doc_id is not null").select("doc_id", "tag", "n_shingles", *sets)
    of = classes.select("rep.*", "doc_id").join(named, sets, "left").select(*sets, F.coalesce("component_id", "doc_id").alias("component_id"))
    linked = full.join(of, sets).select("doc_id", "tag", "n_shingles", "component_id")
    alone = sketch.where("n_shingles = 0 or doc_id is null").select("doc_id", "tag", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _components(docs: DataFrame, percent: int, margin: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketch of each row, the classes of equal sets by their hash `rep` with their least doc_id, and (node, component) of linked classes."""
    sketch = common.materialize(docs.mapInArrow(_sketch(band_count(percent)), SKETCH), "sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    one = full.groupBy("n_shingles", "set_a", "set_b").agg(F.min_by(F.struct("doc_id", "tag", "bands", "low"), "doc_id").alias("s"))
    classes = common.materialize(one.select(F.struct("set_a", "set_b").alias("rep"), "n_shingles", "s.*"), "classes")
    rows = classes.select(F.explode("bands").alias("key"), "rep")
    shared = common.materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = common.materialize(rows.where(common.flagged(F.col("key"), shared, "key")).join(shared, "key"), "members")
    # the member with the most neighbours over all its buckets is likeliest to be near all others
    weight = common.materialize(members.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    heads = members.join(weight, "rep").groupBy("key").agg(F.max(F.struct("weight", "rep")).alias("h")).select("key", F.col("h.rep").alias("leader"))
    members = common.materialize(members.join(heads, "key").select("key", "rep", "leader"), "starred")
    low = classes.where(common.flagged(F.col("rep.set_a"), weight.select("rep.set_a"), "set_a")).select("rep", F.struct("n_shingles", "low").alias("s"))
    star = members.where("rep <> leader").select("leader", F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).dropDuplicates(["a", "b"])
    x, y = low.select(F.col("rep").alias("a"), F.col("s").alias("x")), low.select(F.col("rep").alias("b"), F.col("s").alias("y"))
    star = star.join(x, "a").join(y, "b").where(plausible("x", "y", percent, margin)).select("leader", "a", "b")
    star = common.materialize(star, "star")
    share = F.pmod(F.xxhash64("a", "b"), F.ceil(F.col("n") / BLOCK))
    blocks = star.join(star.groupBy("leader").agg(F.count("*").alias("n")), "leader").select(F.xxhash64("leader", share).alias("block"), "a", "b")
    links = _links(common.materialize(blocks, "starblocks"), docs, classes, percent)
    found = common.connected_components(links)

    # buckets that still hold several components
    placed = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    placed = common.materialize(placed, "placed")
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.max("n").alias("inside"), F.sum("n").alias("n"), F.count("*").alias("parts")).where("parts > 1")
    # members outside the largest component meet all blocks; those inside meet only blocks of members outside
    mixed = most.select("key", "most", F.ceil((F.col("n") - F.col("inside")) / BLOCK).cast("int").alias("outer"), F.ceil(F.col("inside") / BLOCK).cast("int").alias("inner"))
    rest = common.materialize(placed.join(mixed, "key"), "mixed")
    heads = F.transform("bands", lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))
    compared = classes.where(common.flagged(F.col("rep.set_a"), rest.select("rep.set_a"), "set_a")).select("rep", "n_shingles", "low", "bands", heads.alias("heads"))
    rest = rest.join(compared, "rep").withColumn("band", (F.array_position("bands", F.col("key")) - 1).cast("int")).drop("bands")
    place, out = F.xxhash64("rep", "key"), F.col("component") != F.col("most")
    rest = rest.withColumn("sub", F.when(out, F.pmod(place, F.col("outer"))).otherwise(F.col("outer") + F.pmod(place, F.col("inner"))).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(out, F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1)))
    rest = rest.withColumns({"i": F.least("sub", "other"), "j": F.greatest("sub", "other")}).drop("most", "outer", "inner", "other")
    # texts go only to blocks where a plausible pair needs them; pairs are found there again and never written
    wanted = common.materialize(rest.groupBy("key", "i", "j").applyInArrow(_wanted_members(percent, margin), f"key long, i int, j int, rep {NODE}"), "wanted")
    if not wanted.isEmpty():
        nodes = common.materialize(wanted.select("rep").distinct().join(classes.select("rep", "doc_id", "tag"), "rep"), "nodes")
        texts = docs.where(common.flagged(F.col("tag"), nodes, "tag")).join(nodes, ["doc_id", "tag"]).select("rep", "text").dropDuplicates(["rep"])
        texts = common.materialize(texts, "texts")
        held = rest.join(wanted, ["key", "i", "j", "rep"], "left_semi").join(texts, "rep")
        more = held.groupBy("key", "i", "j").applyInArrow(_confirmed_in_block(percent, margin), f"a {NODE}, b {NODE}")
        links = links.union(common.materialize(more.distinct(), "links"))
        found = common.connected_components(links)
    return sketch, classes, found
