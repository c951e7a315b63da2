"""Operator 3: near-duplicate groups by b-bit MinHash.

1. Each text becomes its set of word shingles, a 128-bit key of that set, and
   MinHash minima that make band keys. Texts with equal sets are one node from
   here on, named by the smallest id.
2. Nodes that share a band key share a bucket. A bucket's smallest node is its
   hub; the nodes of a hub's buckets are that hub's group, so that two nodes of
   one bucket are in one group at least. Nodes of groups get their signature,
   the low bits of all minima packed into a few words, and their full set.
3. Each node is held against the hub with which it shares the most bands: the
   share of equal packed fields, counted in bits and corrected for chance
   collisions, estimates the similarity, and what the estimate lets pass is
   confirmed on the full sets. So a group of copies costs a star.
4. Groups that are then still of several labels are searched inside. A task has
   a tile of one group, of bounded bytes, and holds the nodes outside the
   group's main label against it. Two sets can reach the threshold only if
   their prefixes, the rarest few of their shingles, meet, so an index of
   prefixes gives the pairs that are estimated and confirmed, and a spanning
   forest of the links goes out: texts of one template that don't link have no
   pairs. Where a group has several tiles, a node is sent to those tiles alone
   in which its prefix meets another label's.

The estimate lets pass what is within five standard deviations of the
threshold. Bands are as long as ``shape`` allows for the threshold: 28 of 5
minima miss a pair at a similarity of 0.85 once in ten million, 28 of 4 one at
0.8 four times in ten million. Every link is confirmed exactly.

What is stored in the shared folder: keys and bands, hubs, group members, and
the sets of nodes that have a group. Labels are found by pointer jumping and by
rounds of minima over tables; nothing of the corpus is collected.

Defined results: null texts and texts without words have no shingles, are
their own component and are linked with nothing; rows with the same id and
different texts belong together, and so does what is linked with any of them; a
null id is kept, unlinked, with a null component; ties are impossible, since a
component is named by its smallest id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles
from .common import chunks, out_batch, prepare, scratch, stored, table, texts_of

BANDS, ROWS, BITS = 28, 5, 4
HASHES = 144
#: Share of the pairs at the threshold that all bands may miss.
MISSED = 1e-6
#: Bytes of the sets of a group that a task holds at once; one set of more is a tile of its own.
TILE_BYTES = 16 << 20
#: Sets of a tile up to which all are compared without an index, and candidates of one set from which all common shingles are counted at once.
FEW_SETS, MANY = 16, 64
#: Rows of a few numbers each that may be broadcast: 20 MB. More are joined by a shuffle.
FEW_IDS = 500_000

_RANDOM = np.random.default_rng(577)
_A = _RANDOM.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_LOW = np.uint64(0x1111111111111111)


def shape(threshold: float) -> tuple[int, int]:
    """Bands and minima a band: the longest bands, of ``ROWS`` at most, that miss few enough pairs; more than ``BANDS`` of one where none do."""
    for rows in range(ROWS, 0, -1):
        if (1 - threshold**rows) ** BANDS <= MISSED:
            return BANDS, rows
    return next((n for n in range(BANDS, HASHES) if (1 - threshold) ** n <= MISSED), HASHES), 1


def signatures(values: np.ndarray, begins: np.ndarray, bands_of: tuple[int, int] = (BANDS, ROWS)) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits of the minima and band keys of each set; sets must not be empty."""
    half = (values >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((HASHES, len(begins) - 1), np.uint32)
    for k in range(HASHES):
        minima[k] = np.minimum.reduceat((half * _A[k]) ^ _B[k], begins[:-1])
    minima = minima.T
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    packed = np.ascontiguousarray(low[:, 0::2] << 4 | low[:, 1::2])
    many, rows = bands_of
    bands = np.zeros((len(minima), many), np.uint64) + np.arange(many, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for r in range(rows):
        bands = shingles.mix(bands + minima[:, r : many * rows : rows] + np.uint64(r + 1))
    return packed.view("<u8"), bands


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures, corrected for fields that agree by chance; broadcasts over leading axes."""
    x = a ^ b
    x = x | x >> np.uint64(1)
    x = (x | x >> np.uint64(2)) & _LOW
    same = 1 - np.bitwise_count(x).sum(-1, dtype=np.int64) / HASHES
    chance = 1 / (1 << BITS)
    return (same - chance) / (1 - chance)


def passing(threshold: float) -> float:
    """The least estimate of a pair that is confirmed: five standard deviations below the threshold."""
    chance = 1 / (1 << BITS)
    p = threshold + (1 - threshold) * chance
    return threshold - 5 * np.sqrt(p * (1 - p) / HASHES) / (1 - chance)


def sign(docs: DataFrame, size: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, bands``; keys and bands are null for empty sets."""
    prepare(docs.sparkSession)
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    bands_of = shape(threshold / 100)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "text"):
                values, begins = shingles.sets(texts_of(batch, "text", a, b), size)
                n = np.diff(begins)
                there = np.flatnonzero(n)
                k1, k2, bands = ([None] * len(n) for _ in range(3))
                if len(there):
                    own = np.append(begins[there], len(values))
                    keys = signatures(values, own, bands_of)[1].view(np.int64)
                    one = np.add.reduceat(shingles.mix(values + np.uint64(1)), own[:-1]).view(np.int64).tolist()
                    two = np.add.reduceat(shingles.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), own[:-1]).view(np.int64).tolist()
                    for j, i in enumerate(there.tolist()):
                        k1[i], k2[i], bands[i] = one[j], two[j], keys[j]
                yield out_batch(schema, (batch.column("doc_id").slice(a, b - a), pa.array(n), k1, k2, bands))

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``node, n, sig, own`` of every ``node, text`` with a word: size, packed signature, and the set as ascending 64-bit values."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("own", pa.binary())])

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "text"):
                values, begins = shingles.sets(texts_of(batch, "text", a, b), size)
                there = np.flatnonzero(np.diff(begins))
                if len(there):
                    own = np.append(begins[there], len(values))
                    sig = signatures(values, own)[0]
                    raw = [values[x:y].tobytes() for x, y in zip(own[:-1], own[1:], strict=True)]
                    yield out_batch(schema, (batch.column("node").slice(a, b - a).take(pa.array(there)), pa.array(np.diff(own)), [x.tobytes() for x in sig], raw))

    return docs.mapInArrow(run, "node long, n long, sig binary, own binary")


def small(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if a count shows that they are few; more are shuffled."""
    return F.broadcast(rows) if rows.limit(FEW_IDS + 1).count() <= FEW_IDS else rows


def _packed(column) -> np.ndarray:
    """A column of signatures as rows of words."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Values that two ascending arrays share."""
    if len(x) < len(y):
        x, y = y, x
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())


def links(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``a, b`` that the estimate lets pass and that have 100 * intersection >= threshold * union on the full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"), F.col("own").alias("own_b"))
    fits = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    both = pairs.select("a", "b").join(right, "b").join(left, "a").filter(fits)
    least = passing(threshold / 100)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keep = estimate(_packed(batch.column("sig_a")), _packed(batch.column("sig_b"))) >= least
                left, right = batch.column("own_a"), batch.column("own_b")
                for i in np.flatnonzero(keep).tolist():
                    x, y = np.frombuffer(left[i].as_buffer(), "<u8"), np.frombuffer(right[i].as_buffer(), "<u8")
                    common = _common(x, y)
                    keep[i] = 100 * common >= threshold * (len(x) + len(y) - common)
                mask = pa.array(keep)
                yield out_batch(schema, (batch.column("a").filter(mask), batch.column("b").filter(mask)))

    return both.select("a", "b", "sig_a", "sig_b", "own_a", "own_b").mapInArrow(run, "a long, b long")


def roots(parents: DataFrame, rows: int) -> DataFrame:
    """``node, label`` for ``node, label`` that name each node's parent, a smaller node: parents are followed by pointer jumping.

    Each round is stored and halves the depth; the last changes nothing. ``rows`` bounds the nodes.
    """
    out = stored(parents, "labels", rows=rows)
    while True:
        up = small(out.select(F.col("node").alias("label"), F.col("label").alias("up")))
        step = stored(out.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label"), F.col("up").isNotNull().alias("moved")), "labels", rows=rows)
        out = step.select("node", "label")
        if not step.filter("moved").limit(1).count():
            return out


def components(edges: DataFrame, rows: int) -> DataFrame:
    """``node, label`` of every node of the edges ``a, b``; the label is the smallest node that can be reached.

    Rounds of taking the least label around and of following labels; each round is stored, and the last changes nothing. ``rows`` bounds the edges.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = stored(both, "edges", rows=rows)
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels", rows=rows)
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a, "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = stored(step.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "labels", rows=rows)
        labels = step.select("node", "label")
        if not step.filter("old <> label").limit(1).count():
            return labels


def relabel(nodes: DataFrame, labels: DataFrame, column: str = "label") -> DataFrame:
    """``column`` of ``nodes`` replaced by its label where it has one; ``labels`` may be marked for broadcast."""
    labels = labels.select(F.col("node").alias(column), F.col("label").alias("_to"))
    return nodes.join(labels, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


class Forest:
    """Labels that a task has joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def prefixes(n, threshold: int) -> tuple:
    """Long and short prefix of sets of ``n`` shingles.

    Of two sets that reach the threshold, in whatever order all shingles have, the long prefix of one
    and the short prefix of the other, the smaller or as large, have a shingle in common.
    """
    return n + (-threshold * n) // 100 + 1, n + (-2 * threshold * n) // (100 + threshold) + 1


class Tile:
    """Sets of a group, ``(node, label, sig, own)`` each, and what of them a set can be linked with."""

    def __init__(self, rows: list[tuple], threshold: int):
        self.threshold, self.least = threshold, passing(threshold / 100)
        self.node = [r[0] for r in rows]
        self.label = np.array([r[1] for r in rows], np.int64)
        self.sig = np.frombuffer(b"".join(r[2] for r in rows), "<u8").reshape(len(rows), -1)
        self.own = [np.frombuffer(r[3], "<u8") for r in rows]
        self.n = np.array([len(x) for x in self.own], np.int64)
        self.values = None
        if len(rows) > FEW_SETS:
            self._index()

    def _index(self) -> None:
        owner = np.repeat(np.arange(len(self.own)), self.n)
        values = np.concatenate(self.own)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]
        self.known, many = np.unique(self.values, return_counts=True)
        self.many = many
        rare = np.empty(len(values), np.int64)
        rare[order] = np.repeat(many, many)
        order = np.lexsort((values, rare, owner))  # a set's shingles, the rarest of the tile first
        at = np.arange(len(values)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        self.heads = []
        for many in prefixes(self.n, self.threshold):
            first = order[at < np.repeat(many, self.n)]
            first = first[np.argsort(values[first], kind="stable")]
            self.heads.append((values[first], owner[first]))

    @staticmethod
    def _met(values: np.ndarray, owner: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Owners of each of ``y`` among ascending ``values``."""
        lo = np.searchsorted(values, y, "left")
        m = np.searchsorted(values, y, "right") - lo
        return owner[np.repeat(lo - np.cumsum(m) + m, m) + np.arange(m.sum())]

    def linked(self, label: int, sig: bytes, own: bytes) -> np.ndarray:
        """Positions of sets of other labels that are linked with this one."""
        y = np.frombuffer(own, "<u8")
        if self.values is None:
            at = np.arange(len(self.own))
        else:
            k = np.minimum(np.searchsorted(self.known, y), len(self.known) - 1)
            rare = np.where(self.known[k] == y, self.many[k], 0)
            y_rare = y[np.lexsort((y, rare))]
            long, short = prefixes(len(y), self.threshold)
            at = np.unique(np.concatenate([self._met(*self.heads[0], y_rare[:short]), self._met(*self.heads[1], y_rare[:long])]))
        at = at[(self.label[at] != label) & (100 * np.minimum(self.n[at], len(y)) >= self.threshold * np.maximum(self.n[at], len(y)))]
        at = at[estimate(self.sig[at], np.frombuffer(sig, "<u8")) >= self.least]
        if self.values is not None and len(at) > MANY:
            common = np.bincount(self._met(self.values, self.owner, y), minlength=len(self.own))[at]
        else:
            common = np.array([_common(self.own[i], y) for i in at.tolist()], np.int64)
        return at[100 * common >= self.threshold * (self.n[at] + len(y) - common)]


def _forest(rows: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: a spanning forest of the links that each tile finds.

    ``rows`` are ``hub, tile, foreign, main, node, label, sig, own``: a tile's own sets come first, then
    those of other tiles. Own sets outside the label ``main`` and the others are held against the own sets.
    """
    names = ("hub", "tile", "foreign", "main", "node", "label", "sig", "own")
    rows = rows.select(*names).repartition("hub", "tile").sortWithinPartitions("hub", "tile", "foreign", "node")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        place, inside, tile, forest, out = None, [], None, Forest(), []

        def held(node, label, sig, own):
            at = tile.linked(label, sig, own)
            # one pair for each label that is met
            for k in at[np.unique(tile.label[at], return_index=True)[1]].tolist():
                if forest.join(int(tile.label[k]), label):
                    out.append((min(tile.node[k], node), max(tile.node[k], node)))

        def begin():
            """All own sets are there."""
            nonlocal tile
            if tile is None and inside:
                tile = Tile([r[1:] for r in inside], threshold)
                for main, *row in inside:
                    if row[1] != main:
                        held(*row)

        for batch in batches:
            for hub, t, foreign, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if place != (hub, t):
                    begin()
                    place, inside, tile, forest = (hub, t), [], None, Forest()
                if not foreign:
                    inside.append(row)
                elif inside:
                    begin()
                    held(*row[1:])
            if out:
                yield out_batch(schema, map(list, zip(*out, strict=True)))
                out.clear()
        begin()
        if out:
            yield out_batch(schema, map(list, zip(*out, strict=True)))

    return rows.mapInArrow(run, "a long, b long").distinct()


def _heads(rows: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``hub, tile, main, node, label, head, short`` for every shingle in a set's long prefix, and whether it is in the short one: what its hub has not comes first, then ascending."""
    own = sets.select("node", "own")
    of_hub = sets.select(F.col("node").alias("hub"), F.col("own").alias("of_hub")).groupBy("hub").agg(F.min("of_hub").alias("of_hub"))
    both = rows.join(own, "node").join(of_hub, "hub")
    names = ("hub", "tile", "main", "node", "label")
    schema = pa.schema([*((c, pa.int64()) for c in names), ("head", pa.int64()), ("short", pa.bool_())])

    def run(batches):
        for batch in batches:
            heads, shorts = [], []
            for x, y in zip(batch.column("own").to_pylist(), batch.column("of_hub").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                shared = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                long, short = prefixes(len(x), threshold)
                heads.append(np.concatenate([x[~shared], x[shared]])[:long])
                shorts.append(np.arange(long) < short)
            if heads:
                many = pa.array(np.repeat(np.arange(len(heads)), list(map(len, heads))))
                yield out_batch(schema, [*(batch.column(c).take(many) for c in names), pa.array(np.concatenate(heads).view(np.int64)), pa.array(np.concatenate(shorts))])

    return both.select(*names, "own", "of_hub").mapInArrow(run, "hub long, tile long, main long, node long, label long, head long, short boolean")


def _inside(members: DataFrame, best: DataFrame, labels: DataFrame, sets: DataFrame, threshold: int, many: int) -> DataFrame:
    """Links on full sets between nodes of one group and different labels, as forests. ``many`` are the members."""
    size = sets.groupBy("node").agg(F.sum(F.col("n") * 8 + 100).alias("bytes"))
    known = size.join(small(labels), "node", "left").select("node", "bytes", F.coalesce("label", "node").alias("label"))
    hubs = members.select("hub").distinct().select("hub", F.col("hub").alias("node"))
    rows = members.select("hub", "node").union(hubs).join(known, "node")
    part = rows.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("bytes").alias("bytes"), F.max("node").alias("top"))
    group = part.groupBy("hub").agg(F.sum("c").alias("c"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("c", "label")).alias("m"), F.max("top").alias("top")).filter("parts > 1")
    # a pair that has been tested is done
    tested = best.select(F.col("a").alias("hub"), F.col("b").alias("top"), F.lit(2).alias("c"))
    group = stored(group.join(tested, ["hub", "top", "c"], "left_anti").select("hub", F.col("m.label").alias("main"), F.greatest(F.lit(1), F.ceil(F.col("bytes") / TILE_BYTES)).cast("long").alias("tiles")), "groups", rows=many)
    mixed = stored(rows.join(small(group), "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("tiles")).alias("tile"), "main", "node", "label", "tiles"), "mixed", rows=2 * many)
    dealt = mixed.select("hub", "tile", F.lit(0).alias("foreign"), "main", "node", "label")
    if group.filter("tiles > 1").limit(1).count():
        heads = stored(_heads(mixed.filter("tiles > 1").drop("tiles"), sets, threshold), "heads")
        short = F.when(F.col("short"), F.col("label"))
        there = heads.groupBy("hub", "head", F.col("tile").alias("to")).agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min(short).alias("x_short"), F.max(short).alias("y_short"))
        rest = heads.filter("label <> main").join(there, ["hub", "head"]).filter("tile <> to and if(short, x <> label or y <> label, x_short <> label or y_short <> label)")
        dealt = dealt.union(rest.select("hub", F.col("to").alias("tile"), F.lit(1).alias("foreign"), "main", "node", "label").distinct())
    return _forest(dealt.join(sets, "node"), threshold)


def _joined(labels: DataFrame, pairs: DataFrame, rows: int) -> DataFrame:
    """Labels after further pairs of nodes: components of the labels, which stand for their nodes."""
    few = small(labels)
    more = components(relabel(relabel(pairs, few, "a"), few, "b").filter("a <> b"), 2 * rows)
    known = labels.select("node", "label").union(more.select("node", F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    return stored(relabel(known, small(more)), "labels", rows=2 * rows)


def _twins(full: DataFrame, copies: DataFrame, rows: int) -> DataFrame:
    """``a, b``: nodes of the different texts of one id, of every id that has several."""
    several = stored(full.groupBy("doc_id").agg(F.min("k1").alias("x1"), F.max("k1").alias("y1"), F.min("k2").alias("x2"), F.max("k2").alias("y2")).filter("x1 <> y1 or x2 <> y2").select("doc_id"), "several", rows=rows)
    own = full.select("doc_id", "k1", "k2").join(small(several), "doc_id", "left_semi").join(small(copies.select("k1", "k2", "node")), ["k1", "k2"], "left").select("doc_id", F.coalesce("node", "doc_id").alias("b"))
    return own.join(own.groupBy("doc_id").agg(F.min("b").alias("a")), "doc_id").filter("a <> b").select("a", "b").distinct()


def groups(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the smallest id of its near-duplicate group."""
    signed = stored(sign(docs, size, threshold, id_col, text_col), "signed", keep=True)
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    texts_many = signed.count()
    copies = stored(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("k1", "k2", "node"), "copies", keep=True, rows=texts_many)
    few_copies = small(copies)
    with scratch(docs.sparkSession):
        nodes = full.join(few_copies, ["k1", "k2"], "left").filter("node is null or node = doc_id")
        buckets = nodes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
        hubs = stored(buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub <> top").select("key", "hub"), "hubs", rows=BANDS * texts_many)
        members = stored(buckets.join(small(hubs), "key").filter("node <> hub").groupBy("hub", "node").agg(F.count(F.lit(1)).alias("bands")), "members", rows=BANDS * texts_many)
        many = members.count()
        ids = stored(members.select("node").union(members.select("hub")).distinct(), "ids", rows=2 * many)
        texts = docs.select(docs[id_col].cast("long").alias("node"), docs[text_col].cast("string").alias("text"))
        sets = stored(_sets(texts.join(small(ids), "node", "left_semi"), size), "sets")
        if sets.count() > ids.count():  # repeated rows
            sets = stored(sets.dropDuplicates(["node", "own"]), "sets")
        best = members.groupBy("node").agg(F.max(F.struct("bands", F.negative("hub").alias("minus"))).alias("best")).select(F.negative("best.minus").alias("a"), F.col("node").alias("b"))
        best = stored(best, "best", rows=many)
        labels = roots(links(best, sets, threshold).groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("node"), F.col("a").alias("label")), many)
        more = stored(_inside(members, best, labels, sets, threshold, many).union(_twins(full, copies, texts_many)), "links", rows=many)
        if more.limit(1).count():
            labels = _joined(labels, more, 2 * many + more.count())
        labels = stored(labels.filter("label <> node"), "labels", keep=True, rows=many)
    few_labels = small(labels)
    named = relabel(copies.withColumn("label", F.col("node")), few_labels).select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("label").alias("of_copies"))
    own = few_labels.select(F.col("node").alias("own"), F.col("label").alias("of_own"))
    out = signed.filter("n_shingles > 0").select("doc_id", "n_shingles", F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    out = out.join(F.broadcast(named) if few_copies is not copies else named, ["c1", "c2"], "left").join(own, out.doc_id == own.own, "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("of_copies", "of_own", "doc_id")).alias("component_id"))
    # rows without shingles have no key that they could all meet by
    return out.union(signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"), size=3, threshold=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)]) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id)
SELECT n.doc_id, n.n AS n_shingles, min(c) AS component_id, n.doc_id = min(c) AS kept FROM n JOIN r ON r.id = n.doc_id GROUP BY 1, 2
"""
