"""N-gram Jaccard self-join by metric-space regions, and its connected components.

A document's set holds its distinct shingles of ``shingle`` words (words between ASCII white space, A-Z
lower-cased; fewer words make one shingle). Two documents link when 100 * intersection >=
percent * union, i.e. when their Jaccard distance, a metric, is at most r = 1 - percent / 100.
Documents with equal sets are one node; nodes without shingles link with nothing.

Regions. In corpora, nearly all documents lie at distance 1 from any document taken as a pivot, so
cells of document pivots alone would replicate everything everywhere. The first level therefore
takes one-shingle sets as pivots, in one global order, rarest first by word frequencies: a set's
distance to a pivot is below 1 exactly if it holds the shingle, and its cell is that of its first
one. A neighbour within r misses at most floor(r * n) of a set's n shingles, so the first
floor(r * n) + 1 pivots of a set, its window, include the cell of a shared pivot: the set is
replicated there and no pair is lost. Cells of one member vanish, cells of the same members are one region.

Before sets travel, sketches (counts of shingles by class of their hash) bound what two sets of a region share, and split
it into groups that the bounds connect. Groups that have sets in common are one; if it is small, it becomes
a region by itself, so that each set travels once.

A large group is a region by itself too if one of its large cells holds half of its sets, as large groups of near copies have it: they share nearly all
cells of their windows, and each of those would be dealt again. Else its cells are the regions.

Regions above SMALL sets or ITEMS shingles are dealt again, over the cluster, to Voronoi regions. Their pivots, PIVOTS at
most, are points of the metric space that need not be documents: the majority sets of the clusters of a bounded sample
of the region, as many as bring it to the fewest cells. (Any pivots give whole results; the sample only makes them good.) A set's home is the region of its nearest
pivot, at distance d; by the triangle inequality a neighbour's home lies among the pivots within d + 2r, and the set is
replicated there. Let |x ^ p| be the number of x's differences from its region's pivot p and f(x) = (100 + percent) |x ^ p| -
(100 - percent) |x|. Sets x and y link if f(x) + f(y) <= 0, since |x ^ y| <= |x ^ p| + |y ^ p|; then each of them also links
with the region's set b of the least f, and that is how they are joined. All other links join sets whose differences from p
overlap. So each set is dealt on to the cells of its differences (of their window, as above), and cells of one set, of
sets that link with b, or of the same sets as another cell vanish. All sets of a cell agree on its difference, which is none
any more from the next pivots, so the recursion ends.

Smaller regions are read by one task each, which goes on in memory: Voronoi regions of PIVOTS documents while they
shrink, then one pivot at a time, until all sets that were no pivot are in one component. Only links between
components leave a region, at most one less than its sets, never its pairs.

Up to ONE_TASK links are joined to components by one task. More contract, over the cluster, along links to the smallest neighbour until no edge is
left; names are hashes, so the expected number of rounds grows with the logarithm.

Defined cases: null texts have no words; texts of any length are read whole. Null ids never name a component unless
all its ids are null. Repeated rows are one node. Nodes are named by 128-bit hashes of their sets, shingles by 64-bit ones.
Only the two named columns are read, and clashing names of others do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import BROADCAST_ROWS, CellFilter, asked, broadcast_if_small, checkpoint, fresh, join_totals, released, stored
from lodestone.llm.words import blocks, mixed, runs_of

SHINGLE = 3
PERCENT = 90
#: Words whose frequency the pivots' order takes into account; other words count as rarer than all of them.
FREQUENT = 65_536
#: Sets, and shingles of all sets together, of a region that one task reads; larger ones are dealt again.
SMALL = 2048
ITEMS = 1 << 22
#: Pivots of a region in each round, and the sets that they are made from.
PIVOTS = 4
SAMPLE = 64
#: Sets of a region that are dealt again by one task.
CHUNK = 2048
#: Links that one task may join to components; about 200 bytes each while it does.
ONE_TASK = 500_000
#: Counters of a set's sketch, at least and at most; a byte each.
SKETCH, LARGEST = 128, 8192
_SIZE = 0xD6E8FEB86659FD93


def _sized_by(words: int) -> np.uint64:
    return np.uint64(_SIZE * words % (1 << 64))


def _sets_of(column: pa.Array, shingle: int, rank: np.ndarray | None = None, weights: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Each text's distinct shingles, ascending, and their classes of frequency if words' ranks are given."""
    for _, n, hashes, bounds in blocks(column, lower=True):
        whole = mixed(runs_of(hashes, shingle) + _sized_by(shingle))
        classes = None
        if rank is not None:
            own = np.zeros(len(hashes), np.int64)
            if len(rank) and len(hashes):
                at = np.minimum(np.searchsorted(rank, hashes), len(rank) - 1)
                own = np.where(rank[at] == hashes, weights[at], 0)
            sums = np.concatenate([[0], np.cumsum(own)])
            classes = sums[shingle:] - sums[:-shingle]
        for i in range(n):
            begin, end = int(bounds[i]), int(bounds[i + 1])
            if end - begin >= shingle:
                out, first = np.unique(whole[begin : end - shingle + 1], return_index=True)
                yield out, None if classes is None else classes[begin : end - shingle + 1][first]
            elif end == begin:
                yield np.zeros(0, np.uint64), None if rank is None else np.zeros(0, np.int64)
            else:
                size = end - begin
                yield mixed(runs_of(hashes[begin:end], size) + _sized_by(size)), None if rank is None else np.array([int(own[begin:end].sum())])


def node_of(shingle_set: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingle_set.tobytes())


def sketch(shingle_set: np.ndarray) -> bytes:
    """How many of a set's hashes fall in each class of their last bits, 255 at most. There are enough classes, in powers of two from SKETCH
    on, that about four hashes share one; a sketch of half as many follows by adding its halves."""
    size = min(LARGEST, max(SKETCH, 1 << (len(shingle_set) // 4).bit_length()))
    return np.minimum(np.bincount((shingle_set % np.uint64(size)).astype(np.int64), minlength=size), 255).astype(np.uint8).tobytes()


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the FREQUENT most frequent words, ascending, and the logarithms of their documents' number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words[n > 1].view(np.int64)), pa.array(n[n > 1], pa.int64())], names=["w", "n"])

        for batch in batches:
            for _, n, hashes, bounds in blocks(batch.column(0), lower=True):
                for i in range(n):
                    held.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
                    size += len(held[-1])
                if size > 1_000_000:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    counted = texts.mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "w").limit(FREQUENT).collect()
    words = np.array([r.w for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r.n.bit_length() for r in top], np.int64)[order]


def _nodes(rows: DataFrame, rank: np.ndarray, weights: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """(id, row, key, g, n, window, sketch): each row's node, set size, first pivots and sketch. rows: (id, row, key, text)."""
    shared = rows.sparkSession.sparkContext.broadcast((rank, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weights = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                nodes, sizes, windows, sketches = [], [], [], []
                for own, classes in _sets_of(part.column(3), shingle, rank, weights):
                    n = len(own)
                    nodes.append(node_of(own))
                    sizes.append(n)
                    sketches.append(sketch(own))
                    most = n - -(-percent * n // 100) + 1 if n else 0
                    windows.append((own if most >= n else own[np.lexsort((own, classes))[:most]]).view(np.int64))
                ends = np.cumsum([0] + [len(w) for w in windows])
                flat = np.concatenate(windows) if windows else np.zeros(0, np.int64)
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), listed, pa.array(sketches, pa.binary())], names=["id", "row", "key", "g", "n", "window", "sketch"])

    return rows.mapInArrow(run, "id bigint, row bigint, key bigint, g binary, n bigint, window array<bigint>, sketch binary")


def _regions(cells: DataFrame) -> DataFrame:
    """(s, size, items) of the cells (s, g, n, ball) that may hold a link still unknown: two sets or more, one of them outside
    the pivot's ball; items counts their shingles. Of cells with the same sets (by 128 bits), one stays. Map-side aggregation takes hot cells in its stride."""
    found = cells.groupBy("s").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"), *(F.bit_xor(F.xxhash64("g", F.lit(i))).alias(f"bits{i}") for i in range(2)), F.bool_and("ball").alias("settled"))
    found = found.where((F.col("size") > 1) & ~F.col("settled"))
    return checkpoint(found.groupBy("size", "bits0", "bits1").agg(F.min("s").alias("s"), F.min("items").alias("items")).select("s", "size", "items"))


def _members(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """(s, g, n, size, items): the cells' rows of the regions. A filter keeps rows of other cells from being shuffled."""
    seen = CellFilter.members(regions.select("s"), regions.count())
    if seen is not None:
        cells = cells.where(asked(cells.sparkSession, seen)("s"))
    return stored(join_totals(cells.select("s", "g", "n"), "s", regions, "size"), "none")


def _sized(members: DataFrame) -> DataFrame:
    """The members (s, g, n, ...) with the size of their region and the number of its shingles."""
    sizes = checkpoint(members.groupBy("s").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("items")))
    return join_totals(members.select("s", "g", "n"), "s", sizes, "size")


def _grouped(percent: int):  # noqa: ANN202
    """The rows (s, g, n) of the rows (s, g, n, sketch), in order of s, that sketches leave a link to; s is hashed on with the group
    that the possible links connect. Sets share at most the sum of the lesser counters."""

    def groups(s: int, names: list, n: np.ndarray, sketches: list[bytes]) -> Iterator[tuple]:
        label, some = np.arange(len(names)), np.zeros(len(names), bool)
        sizes = np.array([len(x) for x in sketches])
        own = {z: np.flatnonzero(sizes == z) for z in np.unique(sizes).tolist()}
        counts = {z: np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint8).reshape(len(at), z) for z, at in own.items()}
        full = {z: (c == 255).any(axis=1) for z, c in counts.items()}
        for z, at in own.items():
            mine, other = counts[z], z
            while other >= SKETCH:
                if other not in own:
                    other //= 2
                    mine = mine[:, :other].astype(np.int32) + mine[:, other:]
                    continue
                for k, i in enumerate(at.tolist()):
                    rest = slice(k + 1, None) if other == z else slice(None)
                    near = own[other][rest]
                    total = n[i] + n[near]
                    fits = (100 * n[near] >= percent * n[i]) & (100 * n[i] >= percent * n[near])
                    if not fits.any():
                        continue
                    pick = np.flatnonzero(fits)
                    most = np.minimum(mine[k], counts[other][rest][pick]).sum(axis=1, dtype=np.int64)
                    may = (100 * most >= percent * (total[pick] - most)) | (full[z][k] & full[other][rest][pick])
                    found = near[pick[may]]
                    if len(found):
                        some[i] = some[found] = True
                        joined = np.unique(np.append(label[found], label[i]))
                        label[np.isin(label, joined)] = joined[0]
                other //= 2
                mine = mine[:, :other].astype(np.int32) + mine[:, other:]
        for i in np.flatnonzero(some).tolist():
            yield xxhash.xxh3_64_intdigest(s.to_bytes(8, "little", signed=True) + names[int(label[i])]) - (1 << 63), names[i], int(n[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("s", pa.int64()), ("g", pa.binary()), ("n", pa.int64())])
        current, names, n, counts, out = None, [], [], [], []

        def close() -> None:
            if len(names) > 1:
                out.extend(groups(current, names, np.array(n, np.int64), counts))

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for s, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if s != current:
                    close()
                    current, names, n, counts = s, [], [], []
                for held, x in zip((names, n, counts), row, strict=True):
                    held.append(x)
            if len(out) > 10_000:
                yield rows()
                out.clear()
        close()
        if out:
            yield rows()

    return run


def _wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts (text, key) with the columns of the wanted rows (key, ...), of which there may be several for a key. Beyond a number of wanted rows that may
    be broadcast, a filter keeps other texts from being shuffled, as long as it stays small itself."""
    count = wanted.count()
    if count <= BROADCAST_ROWS:
        return texts.join(F.broadcast(wanted), "key")
    seen = CellFilter.members(wanted.select("key"), count)
    return (texts if seen is None else texts.where(asked(texts.sparkSession, seen)("key"))).join(wanted, "key")


def _sets(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(g, set binary): the sets of the wanted nodes (key, g), each from its row of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [x.tobytes() for x, _ in _sets_of(part.column(1), shingle)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["g", "set"])

    return stored(_wanted(texts, wanted).dropDuplicates(["g"]).select("g", "text").mapInArrow(run, "g binary, set binary"), "none")


class Region:
    """The sets that one task joins in memory."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.n = percent, np.array([len(x) for x in sets], np.int64)
        ids, at = np.unique(np.concatenate(sets), return_inverse=True)
        # shingles of one set alone share nothing
        shared = np.bincount(at, minlength=len(ids)) > 1
        number = np.cumsum(shared) - 1
        owner = np.repeat(np.arange(len(sets)), self.n)
        keep = shared[at]
        self.flat, self.kinds = number[at[keep]], int(shared.sum())
        self.starts = np.searchsorted(owner[keep], np.arange(len(sets) + 1))
        self.label, self.links, self.probed = np.arange(len(sets)), [], np.zeros(len(sets), bool)

    def common(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """How many shingles the pivot shares with each member."""
        marks = np.zeros(self.kinds + 1, np.int64)
        marks[self.flat[self.starts[pivot] : self.starts[pivot + 1]]] = 1
        lengths = self.starts[members + 1] - self.starts[members]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1])) + np.repeat(self.starts[members] - ends + lengths, lengths)
        sums = np.concatenate([[0], np.cumsum(marks[self.flat[at]])])
        return sums[ends] - sums[ends - lengths]

    def probe(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """The members' distances to the pivot; those within the join's are linked."""
        common = self.common(pivot, members)
        total = self.n[members] + self.n[pivot] - common
        near = members[100 * common >= self.percent * total]
        for i in np.unique(self.label[near], return_index=True)[1].tolist():
            other = int(near[i])
            if self.label[other] != self.label[pivot]:
                self.links.append((pivot, other))
                self.label[self.label == self.label[other]] = self.label[pivot]
        return 1 - common / total

    def join(self, members: np.ndarray, depth: int = 0) -> None:
        """Finds a link between any two components of the members that have one."""
        if len(np.unique(self.label[members])) < 2:
            return
        if len(members) > 16 * PIVOTS:
            step = len(members) // PIVOTS
            pivots = [int(members[i * step + depth % step]) for i in range(PIVOTS)]
            far = np.stack([self.probe(p, members) for p in pivots])
            reach = far.min(axis=0) + 2 * (1 - self.percent / 100) + 1e-9
            cells = [members[far[j] <= reach] for j in range(PIVOTS)]
            if max(map(len, cells)) <= 0.7 * len(members):
                for cell in cells:
                    self.join(cell, depth + 1)
                return
        done = np.zeros(len(self.n), bool)
        while True:
            open_ = members[~done[members]]
            labels, sizes = np.unique(self.label[open_], return_counts=True)
            if len(labels) < 2:
                return
            rest = open_[self.label[open_] != labels[int(np.argmax(sizes))]]
            done[rest[0]] = True
            self.probe(int(rest[0]), members)


def _join_regions(percent: int, shingle: int | None = None):  # noqa: ANN202
    """Links (a, b) of the rows (s, g, set) or, with a shingle length, (s, g, text), which come in order of s; rows of one g may repeat."""

    def settle(found: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        names, links = list(found), []
        if len(names) > 1:
            region = Region(list(found.values()), percent)
            region.join(np.arange(len(names)))
            links = region.links
        return pa.RecordBatch.from_arrays([pa.array([names[a] for a, _ in links], pa.binary()), pa.array([names[b] for _, b in links], pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = None, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = (np.frombuffer(x.as_py(), np.uint64) for x in part.column(2)) if shingle is None else (x for x, _ in _sets_of(part.column(2), shingle))
                for s, g, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), sets, strict=True):
                    if s != current:
                        if found:
                            yield settle(found)
                        current, found = s, {}
                    found[g] = own
        if found:
            yield settle(found)

    return run


def _most(n: int, percent: int) -> int:
    """How many differences a set of n shingles has from a neighbour, at most."""
    return (100 - percent) * (n + 100 * n // percent + 1) // (100 + percent)


def _reached(own: np.ndarray, pivots: list[np.ndarray], percent: int) -> list[tuple[int, int, int]]:
    """(pivot, differences, cells) of the pivots whose regions a set comes to. A neighbour shares at least differences - most of them, and one."""
    n, most = len(own), _most(len(own), percent)
    common = [len(np.intersect1d(own, p, assume_unique=True)) for p in pivots]
    far = [1 - c / (n + len(p) - c) for c, p in zip(common, pivots, strict=True)]
    reach = min(far) + 2 * (1 - percent / 100) + 1e-9
    differ = [n + len(p) - 2 * c for c, p in zip(common, pivots, strict=True)]
    return [(j, d, d - max(1, d - most) + 1) for j, d in enumerate(differ) if far[j] <= reach]


def _majorities(percent: int):  # noqa: ANN202
    """(s, pivot, set): the majority sets of the clusters of each region's sample (s, set), which come in order of s. There are as many clusters as bring the
    sample to the fewest cells: pivots that don't lie apart would place each set in all their regions."""

    def pivots(s: int, sets: list[np.ndarray]) -> pa.RecordBatch:
        seeds, far = [0], None
        while len(seeds) < min(PIVOTS, len(sets)):  # each seed is the one farthest from those before it
            own = np.array([1 - len(np.intersect1d(x, sets[seeds[-1]], assume_unique=True)) / max(1, len(x)) for x in sets])
            far = own if far is None else np.minimum(far, own)
            if far.max() <= 0.5:  # near all of them already
                break
            seeds.append(int(np.argmax(far)))
        shared = np.array([[len(np.intersect1d(x, sets[i], assume_unique=True)) / max(1, len(x), len(sets[i])) for i in seeds] for x in sets])
        best, fewest = [], None
        for k in range(1, len(seeds) + 1):
            home, found = shared[:, :k].argmax(axis=1), []
            for j in range(k):
                own = [x for x, h in zip(sets, home.tolist(), strict=True) if h == j]
                if own:
                    ids, n = np.unique(np.concatenate(own), return_counts=True)
                    found.append(ids[2 * n > len(own)])
            cells = sum(c for x in sets for _, _, c in _reached(x, found, percent))
            if fewest is None or cells < fewest:
                best, fewest = found, cells
        return pa.RecordBatch.from_arrays([pa.array([s] * len(best), pa.int64()), pa.array(range(len(best)), pa.int32()), pa.array([x.tobytes() for x in best], pa.binary())], names=["s", "pivot", "set"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sets = None, []
        for batch in batches:
            for s, items in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if s != current:
                    if sets:
                        yield pivots(current, sets)
                    current, sets = s, []
                sets.append(np.frombuffer(items.as_py(), np.uint64))
        if sets:
            yield pivots(current, sets)

    return run


def _deal(percent: int):  # noqa: ANN202
    """The regions and cells of the rows (s, chunk, pivot, g, set), in order of s, chunk and pivot; sets that are dealt come
    last. A row (region, cell, g, n, f) without a cell places a set in a region, others place it in the cell of a difference."""
    schema = pa.schema([("region", pa.int64()), ("cell", pa.int64()), ("g", pa.binary()), ("n", pa.int64()), ("f", pa.int64())])

    def named(*parts: int) -> int:
        return xxhash.xxh3_64_intdigest(b"".join(x.to_bytes(8, "little", signed=True) for x in parts)) - (1 << 63)

    def dealt(s: int, pivots: list[np.ndarray], own: np.ndarray, g: bytes) -> Iterator[tuple]:
        n = len(own)
        for j, differ, keep in _reached(own, pivots, percent):
            p, region = pivots[j], named(s, j)
            f = (100 + percent) * differ - (100 - percent) * n
            yield (region, None, g, n, f)
            each = np.concatenate([np.setdiff1d(own, p, assume_unique=True), np.setdiff1d(p, own, assume_unique=True)])
            for e in each[:keep].view(np.int64).tolist():
                yield (region, named(region, e), g, n, f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pivots, out = None, [], []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for s, chunk, pivot, g, items in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (s, chunk) != current:
                    current, pivots = (s, chunk), []
                own = np.frombuffer(items, np.uint64)
                if pivot < PIVOTS:
                    pivots.append(own)
                    continue
                out += dealt(s, pivots, own, g)
                if len(out) > 50_000:
                    yield rows()
                    out = []
        if out:
            yield rows()

    return run


def _dealt(large: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The links (a, b) with the best sets of their regions, and the cells (s, g, n, ball), of large regions (s, g, n, size, items)."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / CHUNK)).cast("int")
    # about SAMPLE sets of a region, fewer of long ones
    share = F.greatest(F.lit(4), F.least(F.lit(SAMPLE), F.floor(F.lit(ITEMS) * F.col("size") / F.col("items"))))
    one = large.groupBy("s").agg(F.min_by("g", F.xxhash64("g", F.lit(1))).alias("g"))
    some = large.where(F.pmod(F.xxhash64("g", F.lit(2)), F.col("size")) < share).select("s", "g").union(one).distinct()
    sample = some.join(sets, "g").select("s", "set").repartition("s").sortWithinPartitions("s", F.xxhash64("set"))
    pivots = checkpoint(sample.mapInArrow(_majorities(percent), "s bigint, pivot int, set binary"))
    spread = large.groupBy("s").agg(F.max(chunks).alias("chunks"))
    copies = pivots.join(spread, "s").select("s", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "pivot", F.lit(b"").alias("g"), "set")
    others = large.join(sets, "g").select("s", F.pmod(F.xxhash64("g"), chunks).cast("int").alias("chunk"), F.lit(PIVOTS).alias("pivot"), "g", "set")
    placed = copies.unionByName(others).repartition("s", "chunk").sortWithinPartitions("s", "chunk", "pivot")
    found = stored(placed.mapInArrow(_deal(percent), "region bigint, cell bigint, g binary, n bigint, f bigint"), "none")
    homes = found.where("cell IS NULL")
    best = checkpoint(homes.groupBy("region").agg(F.min("f").alias("best"), F.min_by("g", F.struct("f", "g")).alias("b"), F.count(F.lit(1)).alias("size")))
    links = join_totals(homes.select("region", "g", "f"), "region", best, "size").where("f + best <= 0 AND g <> b").select(F.col("g").alias("a"), "b")
    cells = join_totals(found.where("cell IS NOT NULL"), "region", best, "size")
    return links, cells.select(F.col("cell").alias("s"), "g", "n", (F.col("f") + F.col("best") <= 0).alias("ball"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, name) of all links (a, b), which one task reads."""
    parent: dict = {}

    def root(x):  # noqa: ANN001, ANN202
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kind = pa.binary()
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    for at in range(0, len(nodes := list(parent)), 10_000):
        some = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, kind), pa.array([root(x) for x in some], kind)], names=["node", "name"])


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, name) of all nodes of the links (a, b): the same name in a component. Links that one task can hold (``one_task`` at most) are joined
    there; more contract along links to the smallest neighbour, round by round."""
    edges = checkpoint(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    if edges.count() <= one_task:
        kind = edges.schema["a"].dataType.simpleString()
        return checkpoint(edges.repartition(1).mapInArrow(_joined, f"node {kind}, name {kind}"))
    names = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("name", F.col("node"))
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        least = checkpoint(both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least")))
        left = edges.join(least, "a").select("b", F.col("least").alias("x"))
        moved = left.join(least.withColumnRenamed("a", "b"), "b").select("x", F.col("least").alias("y"))
        edges = checkpoint(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct())
        names = checkpoint(names.join(least.withColumnRenamed("a", "name"), "name", "left").select("node", F.coalesce("least", "name").alias("name")))
    return names


def _whole(cells: DataFrame, rest: DataFrame, small: Column) -> tuple[DataFrame, DataFrame]:
    """The groups (s, g, n, size, items) that are dealt whole, and the cells (s, g, n) of the others. cells: (s, g, n, group, sets), rest: (g, n, s, size, items), s
    being the group. A group is dealt whole if a cell that must be dealt anyway holds half of its sets: all its cells go for at most twice the rows of one."""
    held = cells.groupBy("s").agg(F.first("group").alias("group"), F.first("sets").alias("sets"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"))
    hot = broadcast_if_small(checkpoint(held.where(~small & (2 * F.col("size") >= F.col("sets"))).select("group").distinct()))
    whole = checkpoint(rest.join(hot.withColumnRenamed("group", "s"), "s", "left_semi").select("s", "g", "n", "size", "items"))
    return whole, stored(cells.join(hot, "group", "left_anti").select("s", "g", "n"), "none")


def _links(cells: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that join all nodes of each component, from the first level's cells (s, g, n, ball), the nodes (g, key, sketch) and
    the texts (key, text)."""
    members = _members(cells, _regions(cells))
    few = F.col("size") <= SMALL
    sketched = members.where(few).select("s", "g", "n").join(nodes.select("g", "sketch"), "g").select("s", "g", "n", "sketch")
    grouped = sketched.repartition("s").sortWithinPartitions("s").mapInArrow(_grouped(percent), "s bigint, g binary, n bigint")
    cells = stored(grouped.unionByName(members.where(~few).select("s", "g", "n")), "none")
    released(members)
    # groups that have sets in common
    least = cells.groupBy("s").agg(F.min("g").alias("least"), F.count(F.lit(1)).alias("size"))
    stars = join_totals(cells.select("s", "g"), "s", checkpoint(least), "size").select(F.col("g").alias("a"), F.col("least").alias("b"))
    named = components(stars).withColumnsRenamed({"node": "g", "name": "s"})
    one = checkpoint(cells.select("g", "n").distinct().join(named, "g").select("s", "g", "n"))
    sized = checkpoint(_sized(one))
    small = (F.col("size") <= SMALL) & ((F.col("items") <= ITEMS) | (F.col("size") <= 4 * PIVOTS))
    keyed = nodes.join(sized, "g").select("key", "g", "n", F.xxhash64("s").alias("s"), "size", "items", small.alias("small"))
    # texts are smaller than their sets, so they are what travels
    placed = _wanted(texts, checkpoint(keyed.where("small").select("key", "g", "s"))).select("s", "g", "text").repartition("s").sortWithinPartitions("s")
    links = checkpoint(placed.mapInArrow(_join_regions(percent, shingle), "a binary, b binary"))
    rest = checkpoint(keyed.where("NOT small").select("key", "g", "n", "s", "size", "items"))
    if not rest.limit(1).count():
        released(cells)
        return links
    sets = _sets(texts, rest.select("key", "g"), shingle)
    whole, others = _whole(cells.join(rest.select("g", F.col("s").alias("group"), F.col("size").alias("sets")), "g"), rest, small)
    first, cells = cells, others.withColumn("ball", F.lit(False))
    while True:
        members = _members(cells, _regions(cells))
        placed = members.where(small).select("s", "g").join(sets, "g").select("s", "g", "set").repartition("s").sortWithinPartitions("s")
        links = links.unionByName(checkpoint(placed.mapInArrow(_join_regions(percent), "a binary, b binary")))
        large = members.where(~small)
        large, whole = large if whole is None else large.unionByName(whole), None
        if not large.limit(1).count():
            released(first, members, sets)
            return links
        more, cells = _dealt(large, sets, percent)
        links = links.unionByName(checkpoint(more))
        released(members)


def _named(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows (row, id, n, g), and the nodes (g, times, c, component_id, first_row): their component's name, least id and its row.
    Positions may differ from scan to scan, so they come from one scan only, or from the column ``row``; a set is found again by a
    hash of a row's id and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rank, weights = _frequencies(docs.select(text))
    place = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), place.alias("row"), text).select("id", "row", F.xxhash64("id", "text").alias("key"), "text")
    nodes = stored(_nodes(rows, rank, weights, shingle, percent), "none")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
    distinct = checkpoint(nodes.where("n > 0").groupBy("g").agg(first, F.count(F.lit(1)).alias("times"), F.min("key").alias("key"), F.first("sketch").alias("sketch")))
    cells = nodes.where("n > 0").select("g", "n", "row", F.explode("window").alias("s"))
    if distinct.agg(F.sum("times"), F.count(F.lit(1))).first()[0] != distinct.count():
        chosen = distinct.select(F.col("first.row").alias("row"))  # of equal rows' windows, one
        cells = nodes.join(chosen, "row", "left_semi").select("g", "n", F.explode("window").alias("s"))
    cells = cells.select("s", "g", "n", F.lit(False).alias("ball"))
    links = _links(cells, distinct.select("g", "key", "sketch"), rows.select("text", "key"), shingle, percent)
    names = components(links).withColumnsRenamed({"node": "g", "name": "c"})
    labelled = distinct.join(names, "g", "left").select("g", "first", "times", F.coalesce("c", "g").alias("c"))
    totals = labelled.groupBy("c").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("size"))
    named = join_totals(checkpoint(labelled), "c", checkpoint(totals), "size").select("g", "times", "c", F.col("least.id").alias("component_id"), F.col("least.row").alias("first_row"))
    return nodes.select("row", "id", "n", "g"), checkpoint(named)


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, row: Column | None = None) -> DataFrame:
    """(row, id, n, c, component_id, first_row) of each row; a row without shingles is a component of its own."""
    rows, named = _named(docs, id_col, text_col, shingle, percent, row)
    found = join_totals(rows.where("n > 0"), "g", named, "times").select("row", "id", "n", F.hex("c").alias("c"), "component_id", "first_row")
    alone = rows.where("n = 0").select("row", "id", "n", F.concat(F.lit("row "), F.col("row").cast("string")).alias("c"), F.col("id").alias("component_id"), F.col("row").alias("first_row"))
    return found.unionByName(alone)


def assignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of each row."""
    classes = _classes(docs, id_col, text_col, shingle, percent)
    return classes.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs' row of the least id of each component."""
    position, lost = fresh(docs, "row_position", "lost_position")
    numbered = stored(docs.withColumn(position, F.monotonically_increasing_id()))
    dropped = _classes(numbered, id_col, text_col, shingle, percent, F.col(position)).where("row <> first_row").select(F.col("row").alias(lost))
    return numbered.join(broadcast_if_small(checkpoint(dropped)), F.col(position) == F.col(lost), "left_anti").drop(position)
