"""N-gram Jaccard self-join by prefix trees over globally ordered shingle sets.

A document's set holds the 64-bit hashes of its distinct word shingles; the order of the hashes is
the global order.  Documents with equal sets become one class, and only classes are joined.

*Routing.*  A set of ``n`` shingles shares at least ``needed(n)``, the threshold's share of ``n``,
with every set it links with.  In the global order, the first ``n - needed(n) + l(n)`` shingles of
two linking sets therefore share at least ``l`` of the smaller one.  Only these beginnings are
routed.  The frequency of each of their shingles over all classes is counted; every set then drops
the most frequent ones, one fewer than any partner must share, so the rarest common shingle of two
linking sets is kept by both.  Passages and lines that many documents share are what is dropped.
Sets that keep a common shingle are tied together if their sizes and their *sketches* allow a link,
and the connected groups of these ties are joined separately.  Bit ``i`` of a sketch is the parity of
the shingles whose hash ends in ``i``, so two sketches differ in no more bits than their sets differ
in shingles: a pair that is left untied cannot link.  Sketches grow with their sets, so sets that
meet by chance differ in half of the bits and large corpora are not tied together by common phrases.
Shingles of more than ``LONG_RUN`` sets tie without that comparison.

*Prefix trees.*  The sets of a group, in the global order, form a compressed trie.  A set walks all
branches at once, level by level.  Shared beginnings are intersected once.  A subtree is left when
the overlap so far plus the largest possible rest cannot reach the threshold, when no size in it
fits, or when it holds only documents already known to be in the walker's component.

A group above ``block`` sets is cut into blocks, and each pair of blocks is one task, so that no
task holds more than two blocks; each task returns a spanning forest of its links only.

Defined cases: null text counts as no text; documents without words have size 0, link with nothing
and are their own component; rows with one doc_id are one document that owns the links of all its
rows; rows with a null doc_id keep their size, get a null component and link with nothing.  Shingles
are compared by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import TEXT_CONF, in_pandas, send_package, stored
from faultline.llm.components import components
from faultline.session import settings

WIDTH = 3
THRESHOLD = Fraction(90, 100)
BLOCK = 2000
# Frequencies of routed shingles are told apart up to this number.
LONG_RUN = 20_000
# The bits of a sketch: powers of two from the one to the other.
LEAST_BITS, MOST_BITS = 64, 2048
# The bits of the filter of grouped documents: two to these powers at least and at most (16 MB).
LEAST_POWER, FILTER_POWER = 15, 27


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes; a text with fewer words than ``width`` is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    mixed = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - size + 1 + k])
    return np.unique(mixed)


def needed(size: int, threshold: Fraction) -> int:
    """The least number of shingles that a set of ``size`` shares with a set it links with."""
    return -(-size * threshold.numerator // threshold.denominator)


def _extra(size: int, threshold: Fraction) -> int:
    """How many shingles two linking beginnings share, by the smaller set; grows with ``size``."""
    least = needed(size, threshold)
    return min(least, max(1, (size - least) // 2))


def beginning(tokens: np.ndarray, threshold: Fraction = THRESHOLD) -> np.ndarray:
    """The shingles by which a sorted set is routed."""
    size = len(tokens)
    return tokens[: size - needed(size, threshold) + _extra(size, threshold)] if size else tokens


def dropped(size: int, threshold: Fraction = THRESHOLD) -> int:
    """How many of its most frequent routed shingles a set of ``size`` may drop."""
    return _extra(needed(size, threshold), threshold) - 1


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    low = int(_mix(tokens).sum(dtype=np.uint64).astype(np.int64))
    return low, int(_mix(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).astype(np.int64))


def sketch(tokens: np.ndarray, threshold: Fraction = THRESHOLD) -> bytes:
    """Parities of the shingles by the last bits of their hashes.

    There are enough bits that half of them are, but for few chances, more than a linking set may differ in.
    """
    up, down = threshold.numerator, threshold.denominator
    differ = 2 * len(tokens) * (down - up) / (up + down)
    bits = LEAST_BITS
    while bits < min(MOST_BITS, 2.3 * differ + 40):
        bits *= 2
    ends = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(ends, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _digests(frames: Iterator[pd.DataFrame], width: int, threshold: Fraction) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            tokens = shingle_set(text, width)
            signs = beginning(tokens, threshold).view(np.int64)
            drop = dropped(len(tokens), threshold)
            rows.append((doc_id, len(tokens), *_digest(tokens), drop, signs, sketch(tokens, threshold)))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "low", "high", "drop", "signs", "sketch"])


def _ties(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (sign, rep).  Ties every row to the first row of its run in this task;
    the first and last run, which may go on in another task, are returned by their first row."""
    sign = hub = None
    first = True
    for frame in frames:
        signs, reps = frame["sign"].to_numpy(), frame["rep"].to_numpy()
        if not len(signs):
            continue
        starts = np.concatenate(([True], signs[1:] != signs[:-1]))
        if sign is not None and signs[0] == sign:
            starts[0] = False
        hubs = np.where(starts, reps, 0)
        at = np.maximum.accumulate(np.where(starts, np.arange(len(signs)), -1))
        hubs = np.where(at >= 0, reps[np.maximum(at, 0)], hub if hub is not None else 0)
        tied = reps != hubs
        yield pd.DataFrame({"a": reps[tied], "b": hubs[tied], "sign": 0, "edge": True})
        if first:
            yield pd.DataFrame({"a": hubs[:1], "b": hubs[:1], "sign": signs[:1], "edge": False})
            first = False
        sign, hub = signs[-1], hubs[-1]
    if sign is not None:
        yield pd.DataFrame({"a": [hub], "b": [hub], "sign": [sign], "edge": False})


class _Sketches:
    """Sketches of several widths; two are compared at the smaller width, to which the larger folds."""

    def __init__(self, sketches: list[bytes]):
        self.words = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
        self.at: dict[int, np.ndarray] = {}
        widths = np.unique(self.words).tolist()
        for width in widths:
            self.at[width] = np.zeros((len(sketches), width), np.uint64)
        for width in widths:
            rows = np.flatnonzero(self.words == width)
            folded = np.frombuffer(b"".join(sketches[i] for i in rows.tolist()), np.uint64).reshape(-1, width)
            while True:
                if width in self.at:
                    self.at[width][rows] = folded
                if width <= widths[0]:
                    break
                width //= 2
                folded = folded[:, :width] ^ folded[:, width:]

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits in which the rows ``a`` and ``b`` differ."""
        out, words = np.zeros(len(a), np.int64), np.minimum(self.words[a], self.words[b])
        for width in np.unique(words).tolist():
            here = np.flatnonzero(words == width)
            bits = np.bitwise_count(self.at[width][a[here]] ^ self.at[width][b[here]])
            out[here] = bits.sum(axis=1, dtype=np.int64)
        return out


def _whole_runs(frames: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """Frames sorted by ``column``, cut where its value changes."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = frame[column].to_numpy()
        if held and held[-1][column].iloc[-1] != values[0]:
            yield pd.concat(held, ignore_index=True)
            held = []
        cut = int(np.searchsorted(values, values[-1]))
        if cut:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = []
        held.append(frame.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _near_ties(frames: Iterator[pd.DataFrame], threshold: Fraction) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (sign, n).  Spanning ties of the sets of one sign that may link by size and sketch."""
    up, down = threshold.numerator, threshold.denominator
    for rows in _whole_runs(frames, "sign"):
        sign, n = rows["sign"].to_numpy(), rows["n"].to_numpy()
        names, node = np.unique(rows["rep"].to_numpy(), return_inverse=True)
        sketches = _Sketches(rows["sketch"].tolist())
        root = np.arange(len(names))
        a: list[int] = []
        b: list[int] = []
        at, lag = np.arange(len(rows)), 1
        while True:
            # Behind a row that is too large, or of another sign, none fits.
            at = at[: np.searchsorted(at, len(rows) - lag)]
            at = at[(sign[at] == sign[at + lag]) & (n[at] * down >= n[at + lag] * up)]
            if not len(at):
                break
            apart = at[root[node[at]] != root[node[at + lag]]]
            differ = sketches.differ(apart, apart + lag)
            near = apart[differ * (up + down) <= (n[apart] + n[apart + lag]) * (down - up)]
            for i, j in zip(node[near].tolist(), node[near + lag].tolist()):
                first, second = i, j
                while root[first] != first:
                    first = root[first]
                while root[second] != second:
                    second = root[second]
                if first != second:
                    root[max(first, second)] = min(first, second)
                    a.append(i)
                    b.append(j)
            while len(near) and (root[root] != root).any():
                root = root[root]
            lag += 1
        yield pd.DataFrame({"a": names[a], "b": names[b]}) if a else pd.DataFrame({"a": [], "b": []}, dtype="int64")


def _sized(frames: Iterator[pd.DataFrame], long_run: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (sign, rep).  Rows of longer runs than one, with the run's length.

    Runs above ``long_run`` rows are not held and count as that long.  The length is null for the
    first and the last run of the task, which may go on in another task.
    """
    held: pd.DataFrame | None = None
    first_sign = long_sign = None
    for frame in frames:
        rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
        held = None
        if not len(rows):
            continue
        signs = rows["sign"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], signs[1:] != signs[:-1])))
        sizes = np.diff(np.append(starts, len(rows)))
        lengths = pd.array(np.minimum(sizes, long_run), dtype="Int64")
        leaves = sizes > 1
        if signs[0] == long_sign:
            lengths[0], leaves[0] = long_run, True
        first_sign = signs[0] if first_sign is None else first_sign
        if signs[0] == first_sign:
            lengths[0], leaves[0] = pd.NA, True
        if sizes[-1] > long_run or signs[-1] == long_sign:
            leaves[-1], long_sign = True, signs[-1]
        else:
            leaves[-1], long_sign = False, None
            held = rows.iloc[starts[-1] :]
        yield rows.assign(size=lengths.repeat(sizes))[np.repeat(leaves, sizes)]
    if held is not None:
        yield held.assign(size=pd.array([None] * len(held), dtype="Int64"))


def _ranged(rows: DataFrame) -> DataFrame:
    """A frequent sign is spread over tasks, whose rows stay in the order of (sign, rep)."""
    return rows.repartitionByRange("sign", "rep").sortWithinPartitions("sign", "rep")


def rare_signs(signed: DataFrame, long_run: int = LONG_RUN) -> DataFrame:
    """(rep, sign) without the ``drop`` most frequent signs of every rep and without signs of one rep,
    with the number of reps that had the sign, ``long_run`` at most.

    ``signed`` has rep, sign and drop, each (rep, sign) once.
    """
    counted_runs = in_pandas(
        _ranged(signed), lambda frames: _sized(frames, long_run), "rep long, sign long, drop int, size long"
    )
    sized = stored(counted_runs, "sized")
    # Two signs a task at most are open; a long run in another task counts as it does there.
    edges = sized.filter((F.col("size") >= long_run) | F.col("size").isNull()).groupBy("sign")
    totals = edges.agg(F.count(F.lit(1)).alias("n"), F.count("size").alias("long"))
    totals = totals.filter("n > long AND n > 1").select("sign", F.least("n", F.lit(long_run)).alias("size"))
    opened = sized.filter("size IS NULL").drop("size").join(F.broadcast(totals), "sign")
    counted = sized.filter("size IS NOT NULL").unionByName(opened)
    order = Window.partitionBy("rep").orderBy(F.desc("size"), F.desc("sign"))
    return counted.withColumn("_place", F.row_number().over(order)).filter("_place > drop").select("rep", "sign", "size")


def signature_ties(signed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all rows (sign, rep) of one sign.

    The runs at the ends of the tasks, two rows a task, are connected afterwards.
    """
    runs = stored(in_pandas(_ranged(signed), _ties, "a long, b long, sign long, edge boolean"), "runs")
    ends = runs.filter(~F.col("edge")).select("sign", "a").distinct()
    hubs = ends.groupBy("sign").agg(F.min("a").alias("b"))
    across = ends.join(hubs, "sign").filter("a <> b").select("a", "b")
    return runs.filter("edge").select("a", "b").union(across).distinct()


def near_ties(rare: DataFrame, sets: DataFrame, threshold: Fraction, long_run: int = LONG_RUN) -> DataFrame:
    """Edges (a, b) that connect all sets with a common sign that may link.

    ``rare`` has rep, sign and size, ``sets`` rep, n and sketch.  A task holds the rows of one sign;
    the signs of ``long_run`` sets or more, which are spread over tasks, tie whatever has them.
    """
    rare = stored(rare, "rare")
    rows = rare.filter(F.col("size") < long_run).select("rep", "sign").join(sets, "rep")
    sorted_rows = rows.repartition("sign").sortWithinPartitions("sign", "n", "rep")
    ties = in_pandas(sorted_rows, lambda frames: _near_ties(frames, threshold), "a long, b long").distinct()
    long = rare.filter(F.col("size") >= long_run).select("rep", "sign")
    return ties if long.isEmpty() else ties.union(signature_ties(long))


class _Forest:
    def __init__(self, nodes: np.ndarray):
        self.names, self.label = np.unique(nodes, return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def link_places(self, i: int, j: int) -> bool:
        return self.label[i] != self.label[j] and self.link(i, j)

    def link(self, i: int, j: int) -> bool:
        a, b = self.label[i], self.label[j]
        if a == b:
            return False
        self.label[self.label == max(a, b)] = min(a, b)
        self.links.append((int(self.names[a]), int(self.names[b])))
        return True


class PrefixTree:
    """Compressed trie of sorted sets; nodes are stored level by level in arrays."""

    def __init__(self, sets: list[np.ndarray]):
        """``sets`` are in lexicographic order."""
        self.sets = sets
        sizes = np.array([len(s) for s in sets])
        spans: list[tuple[int, int, int, int]] = []
        children: list[list[int]] = []
        common = [self._common(sets[i], sets[i + 1]) for i in range(len(sets) - 1)]
        pending = [(0, len(sets), 0, -1)]
        for lo, hi, depth, parent in pending:
            shared = min(common[lo : hi - 1], default=int(sizes[lo]))
            me = len(spans)
            spans.append((lo, hi, depth, shared))
            children.append([])
            if parent >= 0:
                children[parent].append(me)
            if hi - lo > 1:
                begin = lo
                for i in range(lo, hi - 1):
                    if common[i] == shared:
                        pending.append((begin, i + 1, shared, me))
                        begin = i + 1
                pending.append((begin, hi, shared, me))
        self.lo, self.hi, self.start, self.end = np.array(spans).T
        self.first = np.array([c[0] if c else 0 for c in children])
        self.n_children = np.array([len(c) for c in children])
        self.least = np.array([sizes[lo:hi].min() for lo, hi, _, _ in spans])
        self.most = np.array([sizes[lo:hi].max() for lo, hi, _, _ in spans])
        runs = [sets[lo][start:end] for lo, _, start, end in spans]
        self.offset = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
        self.tokens = np.concatenate(runs)
        self.last = np.array([r[-1] if len(r) else 0 for r in runs], dtype=np.uint64)
        self.sizes = sizes

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        at = int(differ.argmax()) if n else 0
        return at if n and differ[at] else n

    def partners(
        self, query: np.ndarray, mine: int, label: np.ndarray | None, after: int, threshold: Fraction
    ) -> list[int]:
        """Leaves from ``after`` on, outside component ``mine``, that link with ``query``; all of
        them without ``label``."""
        size = len(query)
        up, down = threshold.numerator, threshold.denominator
        nodes, overlap = np.array([0]), np.array([0])
        found: list[int] = []
        while len(nodes):
            fits = (self.hi[nodes] > after) & (self.most[nodes] * down >= size * up) & (self.least[nodes] * up <= size * down)
            nodes, overlap = nodes[fits], overlap[fits]
            if not len(nodes):
                break
            if label is not None:
                spans = np.stack((self.lo[nodes], self.hi[nodes]), 1).ravel()
                padded = np.append(label, -1)
                low = np.minimum.reduceat(padded, spans)[::2]
                high = np.maximum.reduceat(padded, spans)[::2]
                other = (low != mine) | (high != mine)
                nodes, overlap = nodes[other], overlap[other]
                if not len(nodes):
                    break
            lengths = self.offset[nodes + 1] - self.offset[nodes]
            total = int(lengths.sum())
            if total:
                ends = np.cumsum(lengths)
                take = np.arange(total) + np.repeat(self.offset[nodes] - (ends - lengths), lengths)
                run = self.tokens[take]
                place = np.searchsorted(query, run)
                hits = np.concatenate(([0], np.cumsum(query[np.minimum(place, size - 1)] == run)))
                overlap = overlap + hits[ends] - hits[ends - lengths]
            passed = np.where(self.end[nodes] > 0, np.searchsorted(query, self.last[nodes], side="right"), 0)
            passed = np.where(lengths > 0, passed, 0)
            rest = np.minimum(self.most[nodes] - self.end[nodes], size - passed)
            share = up + down
            alive = (overlap + rest) * share >= up * (size + self.least[nodes])
            leaf = self.n_children[nodes] == 0
            exact = overlap * share >= up * (size + self.least[nodes])
            for node in nodes[leaf & exact & (self.end[nodes] == self.least[nodes])].tolist():
                found.extend(range(max(after, int(self.lo[node])), int(self.hi[node])))
            inner = alive & ~leaf
            count = self.n_children[nodes[inner]]
            ends = np.cumsum(count)
            total = int(count.sum())
            nodes, overlap = (
                np.arange(total) + np.repeat(self.first[nodes[inner]] - (ends - count), count),
                np.repeat(overlap[inner], count),
            )
        return found


def join_block(nodes: list[int], sets: list[np.ndarray], sides: list[bool], threshold: Fraction) -> list[tuple[int, int]]:
    """Spanning links of one group.  ``sides`` marks the walkers when two blocks are joined;
    with one block all sets walk, each over the leaves behind its own."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    tree = PrefixTree([sets[i] for i in order])
    forest = _Forest(np.array([nodes[i] for i in order], dtype=np.int64))
    two = any(sides) and not all(sides)
    for leaf, i in enumerate(order):
        if two and not sides[i]:
            continue
        after = 0 if two else leaf + 1
        if after >= len(order):
            continue
        for other in tree.partners(sets[i], forest.label[leaf], forest.label, after, threshold):
            forest.link(leaf, other)
    return forest.links


def all_links(sets: list[np.ndarray], walks: list[bool] | None, threshold: Fraction) -> Iterator[tuple[int, list[int]]]:
    """Every link between different sets, as (place, partner places).  Without ``walks`` each link
    of the block comes once; with it, each link between a walking and a standing set."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    leaves = [i for i in order if not (walks and walks[i])]
    if not leaves:
        return
    tree = PrefixTree([sets[i] for i in leaves])
    for after, i in enumerate([i for i in order if walks[i]] if walks else order[:-1], 1):
        found = tree.partners(sets[i], -1, None, 0 if walks else after, threshold)
        if found:
            yield i, [leaves[leaf] for leaf in found]


def _grouped(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Groups of a stream sorted by ``keys``; a group may span batches."""
    held: list[pd.DataFrame] = []
    current = None
    for frame in frames:
        for key, part in frame.groupby(keys, sort=False):
            if held and key != current:
                yield current, pd.concat(held) if len(held) > 1 else held[0]
                held = []
            current = key
            held.append(part)
    if held:
        yield current, pd.concat(held) if len(held) > 1 else held[0]


def _join_tasks(frames: Iterator[pd.DataFrame], threshold: Fraction) -> Iterator[pd.DataFrame]:
    links: list[tuple[int, int]] = []
    for (_, left, right), part in _grouped(frames, ["group", "left", "right"]):
        sets = [np.frombuffer(b, np.uint64) for b in part["tokens"]]
        sides = (part["block"] == right).tolist() if left != right else [True] * len(part)
        links += join_block(part["rep"].tolist(), sets, sides, threshold)
        if len(links) > 20000:
            yield pd.DataFrame(links, columns=["a", "b"])
            links = []
    yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _full_tasks(frames: Iterator[pd.DataFrame], threshold: Fraction, pairs: bool) -> Iterator[pd.DataFrame]:
    """All links of the tasks' groups: as pairs of classes (n is 1), or as spanning links (n is
    null) and one row per class with the documents it links with (b is null)."""
    out: list[tuple] = []
    for (_, left, right), part in _grouped(frames, ["group", "left", "right"]):
        part = part.drop_duplicates(["rep", "low", "high"])
        walks = None if left == right else (part["block"] == right).tolist()
        sets = [np.frombuffer(b, np.uint64) for b in part["tokens"]]
        reps, docs = part["rep"].to_numpy(), part["docs"].to_numpy()
        keys = list(zip(part["low"].tolist(), part["high"].tolist()))
        counts = np.zeros(len(sets), np.int64)
        forest = _Forest(reps)
        for i, found in all_links(sets, walks, threshold):
            if pairs:
                out += [(int(reps[i]), int(reps[j]), 1, *keys[i], *keys[j]) for j in found]
            else:
                counts[i] += docs[found].sum()
                counts[found] += docs[i]
                for j in found:
                    forest.link_places(i, j)
            if len(out) > 20000:
                yield _full_frame(out)
                out = []
        out += [(a, b, None, None, None, None, None) for a, b in forest.links]
        out += [(int(reps[i]), None, int(counts[i]), *keys[i], None, None) for i in np.flatnonzero(counts).tolist()]
    yield _full_frame(out)


def _full_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["a", "b", "n", "low", "high", "b_low", "b_high"], dtype=object).astype("Int64")


def member_filter(members: DataFrame) -> np.ndarray:
    """Bits of the ids in ``members`` (rep): two to the power ``FILTER_POWER`` at most, so that
    texts of other documents, or most of them, are neither shuffled nor cut into shingles.  A filter
    too small for its ids lets more texts pass, to the exact join that follows."""
    power = min(FILTER_POWER, max(LEAST_POWER, (max(1, members.count()) * 32).bit_length()))
    places = members.select(F.shiftrightunsigned(F.xxhash64("rep"), 64 - power).alias("place"))
    bucket = F.shiftright("place", LEAST_POWER).alias("bucket")
    rows = places.groupBy(bucket).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << LEAST_POWER) - 1))).alias("bits"))
    out = np.zeros(1 << (power - 3), np.uint8)
    for row in rows.toLocalIterator():
        at = row.bucket << (LEAST_POWER - 3)
        out[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out


def _may_be_member(docs: DataFrame, bits: np.ndarray) -> Column:
    """False only where the doc_id is none of the filter's ids."""
    shift = np.uint64(64 - (len(bits) << 3).bit_length() + 1)
    send_package(docs.sparkSession)

    @F.pandas_udf("boolean")
    def may(key: pd.Series) -> pd.Series:
        place = key.to_numpy(np.int64).view(np.uint64) >> shift
        return pd.Series((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0)

    return may(F.xxhash64(F.col("doc_id").cast("long")))


def _member_sets(frames: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(tokens=[shingle_set(text, width).tobytes() for text in frame["text"]]).drop(columns="text")


def _keyed_sets(frames: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(rep, s.tobytes(), *_digest(s)) for rep, s in
                ((rep, shingle_set(text, width)) for rep, text in zip(frame["rep"], frame["text"]))]
        yield pd.DataFrame(rows, columns=["rep", "tokens", "low", "high"])


def group_links(
    docs: DataFrame, groups: DataFrame, width: int, threshold: Fraction, block: int,
    classes: DataFrame | None = None, pairs: bool = False,
) -> DataFrame:
    """Spanning links (a, b) inside the groups (node, component); with ``classes`` all links, as
    ``_full_tasks`` gives them."""
    sized = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = groups.join(sized, "component").select(
        F.col("node").alias("rep"), F.col("component").alias("group"), "size"
    )
    keyed = []
    if classes is not None:
        keyed = ["low", "high", "docs"]
        members = members.join(classes.select("rep", *keyed), "rep")
    members = stored(members, "members")
    bits = member_filter(members.select("rep").distinct())
    named = docs.filter(F.col("doc_id").isNotNull() & _may_be_member(docs, bits)).select(F.col("doc_id").alias("rep"), "text")
    if keyed:
        # A text of a repeated doc_id meets every class of that doc_id and goes on as its own only.
        sets = in_pandas(named, lambda frames: _keyed_sets(frames, width), "rep long, tokens binary, low long, high long")
        rows = sets.join(members, ["rep", "low", "high"])
    else:
        # Texts take less room than their sets, so they are joined first.
        texts = named.join(members, "rep").select("rep", "group", "size", "text")
        rows = in_pandas(texts, lambda frames: _member_sets(frames, width), "rep long, group long, size long, tokens binary")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("long")
    dealt = (
        rows.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "rep", "group", "block", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"),
            "tokens", *keyed,
        )
    )
    keys = ["group", "left", "right"]
    tasks = dealt.repartition(*keys).sortWithinPartitions(*keys)
    if keyed:
        schema = ", ".join(f"{name} long" for name in ("a", "b", "n", "low", "high", "b_low", "b_high"))
        return in_pandas(tasks, lambda frames: _full_tasks(frames, threshold, pairs), schema)
    return in_pandas(tasks, lambda frames: _join_tasks(frames, threshold), "a long, b long")


EQUAL = ["n_shingles", "low", "high"]


def _classes(docs: DataFrame, width: int, threshold: Fraction, sizes: bool = False) -> tuple[DataFrame, ...]:
    """Texts, digests, classes of equal sets (with their documents counted if ``sizes``), edges of
    documents in several classes, groups."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with settings(docs.sparkSession, TEXT_CONF):
        digests = stored(
            in_pandas(
                texts,
                lambda frames: _digests(frames, width, threshold),
                "doc_id long, n_shingles long, low long, high long, drop int, signs array<long>, sketch binary",
            ),
            "digests",
        )
    owned = digests.filter("doc_id IS NOT NULL AND n_shingles > 0")
    counted = owned.select("doc_id", *EQUAL).distinct() if sizes else owned
    docs_of = [F.count(F.lit(1)).alias("docs")] if sizes else []
    classes = stored(counted.groupBy(*EQUAL).agg(F.min("doc_id").alias("rep"), *docs_of), "classes")
    # A repeated doc_id ties the classes of all its texts together.
    repeated = owned.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    shared = owned.select("doc_id", *EQUAL).join(repeated, "doc_id", "left_semi").distinct().join(classes, EQUAL)
    own = shared.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    # Signs of documents that surely represent their class are not shuffled for that.
    copies = owned.select("doc_id", *EQUAL).join(classes, EQUAL).filter("doc_id <> rep")
    may_copy = _may_be_member(owned, member_filter(copies.select(F.col("doc_id").alias("rep")).distinct()))
    narrow = [F.col("doc_id").alias("rep"), *EQUAL, "drop", "signs"]
    looked_up = owned.filter(may_copy).select(*narrow).join(classes, ["rep", *EQUAL], "left_semi").select("rep", "drop", "signs")
    firsts = owned.filter(~may_copy).select(*narrow).select("rep", "drop", "signs").union(looked_up)
    firsts = firsts.select("rep", F.explode("signs").alias("sign"), "drop")
    # A rep of several classes meets with the sketch of each.
    shown = [F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch"]
    copied = owned.filter(may_copy).select(*shown).join(classes.select("rep"), "rep", "left_semi")
    sets = owned.filter(~may_copy).select(*shown).union(copied).distinct()
    ties = near_ties(rare_signs(firsts), sets, threshold)
    return texts, digests, classes, own, stored(components(ties), "groups")


def _labelled(digests: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``digests`` with component and the columns of ``classes``."""
    labels = components(links).select(F.col("node").alias("rep"), "component")
    named = classes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")).drop("rep")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return digests.drop("signs", "drop", "sketch").join(named, EQUAL, "left").withColumn("component_id", component)


def ngram_components(
    docs: DataFrame, width: int = WIDTH, threshold: Fraction = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (see the module for defined cases)."""
    texts, digests, classes, own, groups = _classes(docs, width, threshold)
    links = group_links(texts, groups, width, threshold, block).union(own)
    return _labelled(digests, classes, links).select("doc_id", "n_shingles", "component_id")


def ngram_links(
    docs: DataFrame, width: int = WIDTH, threshold: Fraction = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """``ngram_components`` and n_links, the other documents a row's text links with: the copies in
    its class and the sizes of all classes that link with it.  Every link between different texts
    is verified.  A document with several texts counts once for each of them."""
    texts, digests, classes, own, groups = _classes(docs, width, threshold, sizes=True)
    found = stored(group_links(texts, groups, width, threshold, block, classes), "links")
    partners = found.filter("b IS NULL").groupBy(F.col("a").alias("rep"), "low", "high").agg(F.sum("n").alias("partners"))
    counted = classes.join(partners, ["rep", "low", "high"], "left")
    rows = _labelled(digests, counted, found.filter("b IS NOT NULL").select("a", "b").union(own))
    n_links = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.coalesce(F.col("docs") - 1 + F.coalesce("partners", F.lit(0)), F.lit(0))
    )
    return rows.select("doc_id", "n_shingles", "component_id", n_links.cast("long").alias("n_links"))


def class_pairs(
    docs: DataFrame, width: int = WIDTH, threshold: Fraction = THRESHOLD, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """All pairs (a, a_low, a_high, b, b_low, b_high) of linking classes, each once, by their
    representatives and set hashes, and the membership (doc_id, rep, low, high) of the classes."""
    texts, digests, classes, _, groups = _classes(docs, width, threshold, sizes=True)
    found = group_links(texts, groups, width, threshold, block, classes, pairs=True)
    pairs = found.select("a", F.col("low").alias("a_low"), F.col("high").alias("a_high"), "b", "b_low", "b_high")
    named = digests.filter("doc_id IS NOT NULL").join(classes, EQUAL)
    return pairs, named.select("doc_id", "rep", "low", "high").distinct()


def first_of_each_component(docs: DataFrame, **options) -> DataFrame:
    """The documents whose id is their component's, each of their rows once; rows with a null id
    stay, equal ones once."""
    found = stored(ngram_components(docs, **options).select("doc_id", "component_id"), "found")
    others = found.filter("component_id <> doc_id").select("doc_id").distinct()
    # Texts that surely stay are not shuffled.
    may_go = _may_be_member(docs, member_filter(others.select(F.col("doc_id").alias("rep"))))
    looked_up = docs.filter(may_go).join(others, "doc_id", "left_anti").select(docs.columns)
    kept = docs.filter(~may_go).union(looked_up)
    counted = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id IS NULL OR n > 1")
    repeated = stored(counted.select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    single = kept.filter("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti")
    several = kept.join(repeated, "doc_id", "left_semi").union(kept.filter("doc_id IS NULL"))
    return single.select(docs.columns).union(several.select(docs.columns).distinct())
