"""N-gram Jaccard join with PartEnum signatures.

A text's set holds the hashes of its distinct word n-grams. Two sets with Jaccard
similarity of at least num/den have similar sizes and a bounded difference: if the
smaller has a elements, they differ in at most k = floor(a (den - num) / num).
Sizes are cut into bands whose ends are in that ratio or more, so a pair lies in one
band or in two neighbours, and each band has one k for all pairs whose smaller set it
holds. The domain of hashes is cut at two levels, for every k in the same way: into
n1 = floor(k / 2) + 1 + e partitions, and each of these into three parts. Two sets
within k differ by two elements or more in floor(k / 2) partitions at most, so e + 1 of
their partitions differ by one element or none, and of such a partition two parts agree
in both. The signatures are the contents of all subsets of two parts of a partition,
3 n1 of them, each over two thirds of a partition's elements.

Subsets without an element would make unrelated sets meet. A set in which at most e
partitions have such a subset leaves them out (one of the agreeing partitions has none
then); e is chosen per band so that few sets have more.

Equal sets share all signatures and are merged first. Sets that share a signature
are verified on their whole sets, so every reported link is exact, and none is
lost. Not all pairs of a group are verified. First each member is compared with the
one of its groups' members that has the most company, and the links found are
joined to components. Members
of groups that still hold several components are then compared across components,
but only where two of them can still be similar enough given their rarest n-grams:
with both sets in one order, rare n-grams first, the first n-gram in common must
come early enough in both for the rest to suffice (prefix and position bounds,
which hold for every similar pair). Edits make n-grams that others lack, so
the members of a large family of loose copies don't meet each other in pairs. The
order comes from a table of 2^SKETCH_BITS counts; any order gives the same links.

Hashes are 64 bits wide (words, n-grams, sets), as everything here is equal up to
collisions of those. Where signatures meet, they and the names of their sets travel
packed, with KEY_BITS of their hashes: what agrees in those by chance is verified on
whole sets like the rest, and two sets that do and share a signature are taken for one there.

Defined results: null or empty text, or text without words, has an empty set and
links with nothing; a text of fewer words than n has one n-gram, all its words;
rows that repeat an id count as copies or near copies of that id; null ids belong
to the component of their copies with an id, if any; extra columns are ignored; an
empty table gives an empty result. Whole texts are read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import BROADCAST_IDS, WordHashes, by_ids, mix, release_shuffles, scan, words_of
from stratum.llm.pitman_yor import gaps, hand_back, keys_of, pack, small_batches, unpack

#: Parts of a partition, and the subsets of them: all pairs.
PARTS, SUBSETS = 3, ((0, 1), (0, 2), (1, 2))
#: Ends of a band, as a power of den / num (1 or more); at this one sets have fewest signatures.
BAND = 1.25
#: Bits of a signature's and a set's hash that travel. Signatures or sets that agree in them
#: by chance are candidates more, which are verified like the others.
KEY_BITS = 48
#: Signatures that a task gathers before it deals them out.
BATCH_ROWS = 1_000_000
#: Bytes of a batch of packed signatures, about.
ROWS_BYTES = 1 << 20
#: N-grams to a cell where signatures meet, on average: about as many signatures.
CELL_GRAMS = 1_250_000
#: Rows that fill a partition of a table of links or nodes (two or three numbers each).
PART_ROWS = 100_000
#: Bits of the table of n-gram frequencies that orders sets rare-first (its size is fixed).
SKETCH_BITS = 22


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a sequence of word hashes."""
    if not len(h):
        return h
    m = min(n, len(h))
    total = np.full(len(h) - m + 1, np.uint64(m), np.uint64)
    for k in range(m):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix(h[k : len(h) - m + 1 + k])
    return np.unique(mix(total))


def set_id(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


class Signatures:
    """Signatures for one similarity num/den; bands are made as sizes need them."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low: list[int] = [1]
        self.high: list[int] = [den // num]
        self.spare: dict[int, int] = {}
        self.starts: dict[int, np.ndarray] = {}

    def band(self, size: int) -> int:
        while self.high[-1] < size:
            self.low.append(self.high[-1] + 1)
            self.high.append(max(self.low[-1] * self.den // self.num, int(self.low[-1] * (self.den / self.num) ** BAND)))
        return bisect_left(self.high, size)

    def difference(self, band: int) -> int:
        return self.high[band] * (self.den - self.num) // self.num

    def partitions(self, band: int, k: int) -> int:
        """floor(k / 2) + 1 + e, with e beyond the usual number of partitions in which
        two parts are empty."""
        if band not in self.spare:
            e = 0
            while True:
                n = k // 2 + 1 + e
                empty = np.exp(-self.low[band] / (PARTS * n))
                usual = n * (3 * empty**2 - 2 * empty**3)
                if e >= usual + 2 * np.sqrt(usual) or e > k + 1:
                    break
                e += 1
            self.spare[band] = e
        return k // 2 + 1 + self.spare[band]

    def of(self, s: np.ndarray) -> np.ndarray:
        """All signatures of a sorted set, as signed numbers."""
        if not len(s):
            return np.empty(0, np.int64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        own = self.band(len(s))
        out = [self.within(s, sums, own)]
        if own and len(s) * self.num <= self.high[own - 1] * self.den:
            out.append(self.within(s, sums, own - 1))
        return np.concatenate(out)

    def within(self, s: np.ndarray, sums: np.ndarray, band: int) -> np.ndarray:
        k = self.difference(band)
        if not k:  # only equal sets, which are merged already
            return np.empty(0, np.int64)
        n = self.partitions(band, k)
        # parts are equal ranges of the hash, so their elements are neighbours in s
        if n not in self.starts:
            self.starts[n] = np.array([-(-p * 2**32 // (PARTS * n)) << 32 for p in range(PARTS * n)], np.uint64)
        edges = np.append(np.searchsorted(s, self.starts[n]), len(s))
        content = (sums[edges[1:]] - sums[edges[:-1]]).reshape(n, PARTS)
        filled = (edges[1:] > edges[:-1]).reshape(n, PARTS)
        left, right = map(list, zip(*SUBSETS))
        value, full = content[:, left] + content[:, right], filled[:, left] | filled[:, right]
        if (~full.all(1)).sum() > self.spare[band]:
            full[:] = True
        which = np.flatnonzero(full)
        place = mix((which + (band + 1 << 32)).astype(np.uint64))
        return mix(value.ravel()[which] ^ place).view(np.int64)


def each_set(batches, n: int):
    """(id, set) of every row."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                yield doc, shingles(hashes.of(words_of(text)), n)
    del hashes
    hand_back()


def in_chunks(rows, schema: pa.Schema, size: int = 20_000):
    """Record batches of rows from an iterator."""
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def set_table(docs: DataFrame, n: int) -> DataFrame:
    """``id, set_id, n_shingles`` of every row (``set_id`` null for an empty set)."""
    schema = pa.schema([("id", pa.int64()), ("set_id", pa.int64()), ("n_shingles", pa.int64())])

    def step(batches):
        yield from in_chunks(((d, set_id(s) if len(s) else None, len(s)) for d, s in each_set(batches, n)), schema)

    return scan(docs, ["id", "text"], step, "id long, set_id long, n_shingles long")


def listed(marks: np.ndarray, keys: np.ndarray) -> bytes:
    """Rows of (mark, key), sorted by both, as one value: each mark once, as a difference."""
    starts = np.flatnonzero(np.diff(marks, prepend=~marks[:1]))
    return pack(np.diff(starts, append=len(marks)), gaps(marks[starts]), keys)


def unlisted(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Marks and keys of several such lists."""
    marks, keys = [], []
    for value in values:
        counts, steps, key = unpack(value)
        marks.append(np.repeat(keys_of(steps), counts))
        keys.append(key.astype(np.uint64))
    none = [np.empty(0, np.uint64)]
    return np.concatenate(marks or none), np.concatenate(keys or none)


def low_ends(cells: int) -> np.ndarray:
    """The smallest key of each cell: cells are equal ranges of keys."""
    return np.array([-(-(c << KEY_BITS) // cells) for c in range(cells)], np.uint64)


def distinct_rows(marks: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, sorted by key and mark."""
    order = np.lexsort((marks, keys))
    marks, keys = marks[order], keys[order]
    own = np.ones(len(keys), bool)
    own[1:] = (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])
    return marks[own], keys[own]


def signature_table(docs: DataFrame, n: int, num: int, den: int, cells: int) -> DataFrame:
    """``cell, known, rows``: the signatures of the distinct sets of each batch, dealt to
    cells and packed. A row is a set's mark and a signature's key, KEY_BITS of either's hash.

    Of the sets of a batch with one signature two speak for them, in the signature's
    cell. The rows of the others are known to be shared, so they are spread over the cells
    by their sets: a signature that very many sets have takes two rows a batch in any one place.
    """
    schema = pa.schema([("cell", pa.int32()), ("known", pa.bool_()), ("rows", pa.binary())])
    cut = np.uint64(64 - KEY_BITS)

    def dealt(sigs: list[np.ndarray], owners: list[int]):
        key = np.concatenate(sigs).view(np.uint64) >> cut
        mark = np.repeat(np.array(owners, np.int64).view(np.uint64) >> cut, [len(x) for x in sigs])
        order = np.argsort(key, kind="stable")
        third = np.zeros(len(key), bool)
        third[order[2:]] = key[order[2:]] == key[order[:-2]]
        low = low_ends(cells)
        own = (np.searchsorted(low, key, "right") - 1).astype(np.int32)
        own[third] = mix(mark[third]) % np.uint64(cells)
        order = np.lexsort((key, mark, own, third))
        key, mark, own, third = (x[order] for x in (key, mark, own, third))
        starts = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(third, prepend=third[:1])))
        rows, size = [], 0
        for at, end in zip(starts, np.append(starts[1:], len(own))):
            rows.append((own[at], third[at], listed(mark[at:end], key[at:end] - (np.uint64(0) if third[at] else low[own[at]]))))
            size += len(rows[-1][2])
            if size > ROWS_BYTES or end == len(own):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0

    def step(batches):
        signatures = Signatures(num, den)
        sigs, owners, rows, seen = [], [], 0, set()
        for _, s in each_set(batches, n):
            own = set_id(s) if len(s) else None
            if own is None or own in seen or not len(found := signatures.of(s)):
                continue
            seen.add(own)
            sigs.append(found)
            owners.append(own)
            rows += len(found)
            if rows > BATCH_ROWS:
                yield from dealt(sigs, owners)
                sigs, owners, rows, seen = [], [], 0, set()
        if rows:
            yield from dealt(sigs, owners)
            sigs, owners, seen = [], [], set()
        hand_back()

    return scan(docs, ["id", "text"], step, "cell int, known boolean, rows binary")


def whole_sets(docs: DataFrame, nodes: DataFrame, n: int, repeated: DataFrame | None = None) -> DataFrame:
    """``node, members``: the sets of the documents named in ``nodes``.

    Of equal rows of an id in ``repeated`` one is taken; an id with several texts has
    several sets, and a link of any is its link.
    """
    schema = pa.schema([("node", pa.int64()), ("members", pa.binary())])

    def step(batches):
        yield from in_chunks(((d, s.tobytes()) for d, s in each_set(batches, n)), schema, 500)

    chosen = by_ids(docs, nodes, "id", "left_semi", stored=True).select("id", "text")
    if repeated is not None:
        several = by_ids(chosen, repeated, "id", "left_semi", stored=True).dropDuplicates()
        chosen = by_ids(chosen, repeated, "id", "left_anti", stored=True).unionByName(several)
    return scan(chosen, ["id", "text"], step, "node long, members binary")


def where_few(sets: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The sets joined to the stored rows of links or nodes with their key. The rows go to the
    sets as long as they are half as many as ids may be, which are half as wide."""
    few = rows.limit(BROADCAST_IDS // 2 + 1).count() <= BROADCAST_IDS // 2
    return (sets if few else by_ids(sets, rows.select(key), key, "left_semi", stored=True)).join(F.broadcast(rows) if few else rows, key)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those pairs (a, b) whose sets have den * intersection >= num * union."""
    # only the sets that a side needs are shuffled, those of a once: few pairs go to where they lie
    a = where_few(sets.toDF("a", "in_a"), pairs, "a").select("a", "b", "in_a")
    b = by_ids(sets, pairs.select("b"), "node", "left_semi", stored=True).toDF("b", "in_b")

    def step(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = np.intersect1d(s, t, assume_unique=True).size
                linked.append(den * shared >= num * (len(s) + len(t) - shared))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return scan(a.join(b, "b"), ["a", "b", "in_a", "in_b"], step, "a long, b long")


def filled(rows: DataFrame) -> int:
    """Partitions that a table with as many rows fills: each is a file of a checkpoint."""
    return 1 + rows.count() // PART_ROWS


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of a link.

    Alternating large and small stars: each step ties a node's neighbours to the
    smallest of them by one grouped minimum and one join, no list is gathered. A step
    never adds links, so none of its tables has more partitions than the links fill.
    """
    parts = filled(links)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().coalesce(parts).checkpoint()
    while not only_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(parts).checkpoint()
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct().coalesce(parts)
    )


def only_stars(edges: DataFrame) -> bool:
    """Whether each node is either tied to one smaller node or has larger ones tied to
    it: then the smaller node of an edge is its component's smallest."""
    ends = edges.select("u", F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up")))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")).where("up > 0 AND n > 1").isEmpty()


def rarity(sets: DataFrame) -> np.ndarray:
    """Counts of n-grams by the first bits of their hash, over as many sets (chosen by
    a hash of their node) as hold about 2^SKETCH_BITS n-grams: a bounded table."""
    size = (sets.agg(F.sum(F.octet_length("members"))).first()[0] or 0) / 8
    share = int(min(1.0, 2**SKETCH_BITS / max(size, 1)) * (1 << 30))

    def step(batches):
        for batch in batches:
            every = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in batch.column(0)])
            slots, times = np.unique(every >> np.uint64(64 - SKETCH_BITS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(times)], names=["slot", "n"])

    def packed(batches):
        for batch in batches:
            slots, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([slots.astype(np.int32).tobytes()], pa.binary()), pa.array([n.astype(np.int64).tobytes()], pa.binary())], names=["slots", "n"]
            )

    sample = sets.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share)
    # at least 3 in a slot, so a third of the sampled n-grams' number of slots at most
    common = scan(sample, ["members"], step, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n >= 3")
    out = np.zeros(1 << SKETCH_BITS, np.int32)
    for row in scan(common, ["slot", "n"], packed, "slots binary, n binary").collect():
        out[np.frombuffer(row.slots, np.int32)] = np.minimum(np.frombuffer(row.n, np.int64), 2**31 - 1)
    return out


def prefixes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``node, label, size, gram, place, short``: the rarest n-grams of each set (``node,
    label, members``), as many as a longer partner's bound needs; ``short`` marks those a
    shorter partner's needs."""
    spark = sets.sparkSession
    counts = spark.sparkContext.broadcast(rarity(sets))
    release_shuffles(spark)  # the sets were shuffled to be counted
    schema = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("size", pa.int64()), ("gram", pa.int64()), ("place", pa.int64()), ("short", pa.bool_())])

    def rows(batch):
        for node, label, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            s = np.frombuffer(x.as_py(), np.uint64)
            size = len(s)
            rare = counts.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            long = size - -(-num * size // den) + 1
            short = size - -(-2 * num * size // (num + den)) + 1
            first = s[np.lexsort((s, rare))[:long]].view(np.int64)
            place = np.arange(1, len(first) + 1)
            yield np.full(len(first), node), np.full(len(first), label), np.full(len(first), size), first, place, place <= short

    def step(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                if found := list(rows(batch.slice(at, 1000))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)

    return scan(sets, ["node", "label", "members"], step, "node long, label long, size long, gram long, place long, short boolean")


def linked_components(hits: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``node, label`` of the verified links among nodes that share a signature.

    ``hits`` (sig, node) holds the groups; nodes without a link have no row.
    """
    parts = filled(hits)  # enough for tables of a row a node
    company = hits.groupBy("sig").agg(F.count(F.lit(1)).alias("company"))
    popular = hits.join(company, "sig").groupBy("node").agg(F.sum("company").alias("popular"))
    turn = F.struct("popular", (-F.col("node")).alias("last"))
    centre = hits.join(popular, "node").groupBy("sig").agg(F.max(turn).alias("c"))
    # of the centres of its groups each node is compared with the most popular one
    stars = (
        hits.join(centre, "sig").groupBy("node").agg(F.max("c").alias("c"))
        .select(F.col("node").alias("a"), (-F.col("c.last")).alias("b")).where("a <> b").coalesce(parts).checkpoint()
    )
    del company, popular, centre
    # each step's result is a table of its own, so its shuffle files can go
    spark = hits.sparkSession
    release_shuffles(spark)
    links = verified(stars, sets, num, den).checkpoint()
    release_shuffles(spark)
    labels = components(links).checkpoint()

    known = hits.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_groups = known.groupBy("sig").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    open_nodes = known.join(open_groups, "sig", "left_semi").select("node", "label").distinct().coalesce(parts).checkpoint()
    del known, open_groups
    release_shuffles(spark)
    rows = prefixes(where_few(sets, open_nodes, "node"), num, den)
    x, y = rows.where("short").alias("x"), rows.alias("y")
    shorter_first = "(x.size < y.size OR x.size = y.size AND x.node < y.node)"
    enough = f"{num + den} * (least(x.size - x.place, y.size - y.place) + 1) >= {num} * (x.size + y.size)"
    pairs = (
        x.join(y, F.expr(f"x.gram = y.gram AND x.label <> y.label AND {shorter_first} AND {enough}"))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
        .join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti").checkpoint()
    )
    del rows, x, y
    release_shuffles(spark)
    more = verified(pairs, sets, num, den).checkpoint()
    return labels if more.isEmpty() else components(links.unionByName(more))


def shared_signatures(docs: DataFrame, sets: DataFrame, n: int, num: int, den: int, grams: int) -> DataFrame:
    """``sig, node`` of the signatures that several sets have. ``grams`` is the number of
    n-grams of all sets, of which a cell gets CELL_GRAMS at most."""
    spark = docs.sparkSession
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-grams // CELL_GRAMS))

    def met(key, table):
        at, known, rows = key[0].as_py(), table.column("known").to_pylist(), table.column("rows").to_pylist()
        del table
        marks, keys = distinct_rows(*unlisted([x for x, k in zip(rows, known) if not k]))
        sure = distinct_rows(*unlisted([x for x, k in zip(rows, known) if k]))
        del rows
        starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        several = np.repeat(np.diff(starts, append=len(keys)) > 1, np.diff(starts, append=len(keys)))
        marks = np.concatenate([marks[several], sure[0]]).view(np.int64)
        keys = np.concatenate([keys[several] + low_ends(cells)[at], sure[1]]).view(np.int64)
        hand_back()
        return pa.table({"sig": keys, "mark": marks})

    shared = signature_table(docs, n, num, den, cells).groupBy("cell").applyInArrow(met, "sig long, mark long")
    # sets of one mark, if there are any, are candidates like others
    named = sets.where("node IS NOT NULL").select(F.shiftrightunsigned("set_id", 64 - KEY_BITS).alias("mark"), "node")
    return shared.join(named, "mark").select("sig", "node").checkpoint()


def similar_groups(
    docs: DataFrame,
    n: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    unique_ids: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the smallest id reachable
    over links of Jaccard similarity num/den or more between sets of word n-grams.

    ``unique_ids`` says that no id repeats, which spares a look for those that do.
    """
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    with small_batches(docs.sparkSession):  # large ones leave an executor with memory that is filled once
        rows = set_table(docs, n).checkpoint()
        sets = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("id").alias("node"))
        grams = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
        hits = shared_signatures(docs, sets, n, num, den, grams)
        release_shuffles(docs.sparkSession)  # the signatures are the largest shuffle by far
        repeated = None if unique_ids else rows.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id")
        members = whole_sets(docs, hits.select("node"), n, repeated).checkpoint()
        release_shuffles(docs.sparkSession)
        labels = linked_components(hits, members, num, den)
    known = sets.join(labels, "node", "left").select("set_id", F.coalesce("label", "node").alias("component_id"))
    return rows.join(known, "set_id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents whose id is their component's smallest (null ids stay), with
    all their columns."""
    groups = similar_groups(docs, id_col=id_col, **options)
    return by_ids(docs, groups.where("doc_id <> component_id").select("doc_id"), id_col, "left_anti")


def one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, with all its columns: the smallest id, null ids
    last, any of rows with equal id and text. Each row is a document of its own, also
    where an id repeats or is null: rows are told apart by a hash of id and text.
    Rows without words are linked with nothing and all stay."""
    key = "row_key"
    while key.lower() in map(str.lower, docs.columns):
        key += "_"
    own_id, text = docs[id_col].cast("long"), docs[text_col]
    rows = docs.withColumn(key, F.xxhash64(F.coalesce(own_id, F.lit(0)), own_id.isNull(), F.coalesce(text, F.lit("")), text.isNull()))
    groups = similar_groups(rows, id_col=key, text_col=text_col, **options).where("n_shingles > 0")
    groups = groups.groupBy(F.col("doc_id").alias("k")).agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("times"))
    ids = rows.select(F.col(key).alias("k"), own_id.alias("id")).distinct()
    named = groups.join(ids, "k").checkpoint()
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("first"))
    first = first.join(named.select("k", "times"), F.col("first.k") == F.col("k")).select("k", "times").coalesce(filled(named)).checkpoint()
    others = named.join(first, "k", "left_anti").select("k")
    several = first.where("times > 1").select("k")
    alone = by_ids(rows, others.unionByName(several), key, "left_anti", stored=True)
    return alone.unionByName(by_ids(rows, several, key, "left_semi", stored=True).dropDuplicates([key])).select(*docs.columns)
