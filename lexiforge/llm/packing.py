"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of fewer tokens than a sequence holds are sorted by length and dealt in turn to shards of SHARD pieces, so that
all shards have the same mix of lengths; a shard's packing is evolved on ISLANDS islands in their own tasks. A crossover
injects whole well-filled bins of one parent into the other, removes the bins with duplicates of their pieces, exchanges
one or two pieces of kept bins for displaced ones that fill them better, and best-fits the rest. After every epoch each
island's elite migrates to the next island of its shard's ring. The state of an island is one row, so an epoch is a
narrow map and the migration a join on (shard, island); every epoch is written to the shared folder. Every shard ends in
a bin that is not full; so the least filled bins of FAN shards are evolved again together, and so on until one shard is
left. Few pieces are packed by an exact search.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, release, remove, slices, written, written_at
from .tokens import END_ID, ROWS, encoder

SEQUENCE = 1024
#: Pieces of a shard; islands of a shard; epochs between which elites migrate; most tasks of an epoch.
SHARD, ISLANDS, EPOCHS, TASKS = 8192, 2, 2, 4096
#: Packings of an island; generations of an epoch, and those that may pass without a packing of fewer bins.
POPULATION, GENERATIONS, STALL = 8, 400, 30
#: Bins filled to this share are injected whole; shares of them that a child gets; share of bins that mutation dissolves.
WELL_FILLED, SHARES, MUTATION = 0.995, (0.02, 0.1, 0.5), 0.03
#: Kept bins of a child that may exchange pieces.
EXCHANGES = 400
#: Shards whose least filled bins are packed together, a FANth of the pieces of each (more where fewer shards are left).
FAN = 16
#: Pieces that an exact search packs, and the steps after which it gives up.
EXACT, STEPS = 28, 50_000


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """id, piece, start, length, ids_crc32 of each document's pieces; only documents of more than `size` ids are cut.

    The first piece takes what is left over, the others have `size` ids.
    """
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        own, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for b in (part for whole in batches for part in slices(whole, ROWS)):
            ids, ends = own.flat(b.column(1))
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            n = np.diff(ends, prepend=0) + 1  # with the end id
            count = -(-n // size)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            stop = n[doc] - (count[doc] - 1 - piece) * size
            start = np.maximum(stop - size, 0)
            base = (ends - (n - 1))[doc]
            last = piece == count[doc] - 1
            spans = zip((4 * (base + start)).tolist(), (4 * (base + stop - last)).tolist(), last.tolist(), strict=True)
            crc = [crc32(end, crc32(raw[a:z])) if final else crc32(raw[a:z]) for a, z, final in spans]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(stop - start), pa.array(crc, pa.int64())], names=["id", "piece", "start", "length", "ids_crc32"])
        release()

    ids = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))
    return ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


class Gaps:
    """Free space in bins by its size; the tightest bin that a piece fits into is one step on a bit mask."""

    def __init__(self, size: int, fill: np.ndarray | None = None, bins: np.ndarray | None = None):
        """fill: how full some bins are, which are numbered by bins."""
        self.size, self.by_free, self.mask = size, {}, 0
        if fill is not None and len(fill):
            free = size - fill
            order = np.argsort(free, kind="stable")
            kinds, starts = np.unique(free[order], return_index=True)
            for f, own in zip(kinds.tolist(), np.split(bins[order], starts[1:]), strict=True):
                if f:
                    self.by_free[f] = own.tolist()
                    self.mask |= 1 << f

    def fit(self, lengths: list[int], next_bin: int) -> list[int]:
        """Best-fits pieces in the order given; the bin of each. New bins are numbered from next_bin on."""
        out, by_free, size, mask = [], self.by_free, self.size, self.mask
        for n in lengths:
            high = mask >> n
            if high:
                free = n + (high & -high).bit_length() - 1
                stack = by_free[free]
                bin_ = stack.pop()
                if not stack:
                    mask &= ~(1 << free)
                free -= n
            else:
                bin_, free, next_bin = next_bin, size - n, next_bin + 1
            if free:
                by_free.setdefault(free, []).append(bin_)
                mask |= 1 << free
            out.append(bin_)
        self.mask = mask
        return out


def fills(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How full each bin is; a packing is the bin number, from 0 without gaps, of each piece."""
    return np.bincount(bins, lengths).astype(np.int64)


def fitness(bins: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (the sum of squared fills)."""
    fill = fills(bins, lengths) / size
    return -len(fill), float(fill @ fill)


class Pool:
    """Pieces by their length; the longest one of at most some length is one step on a bit mask."""

    def __init__(self, pieces: np.ndarray, lengths: np.ndarray):
        self.by_length: dict[int, list[int]] = {}
        self.mask = 0
        for k, n in zip(pieces.tolist(), lengths[pieces].tolist(), strict=True):
            self.add(k, n)

    def add(self, piece: int, n: int) -> None:
        self.by_length.setdefault(n, []).append(piece)
        self.mask |= 1 << n

    def longest(self, room: int, but: int = 0) -> int:
        """The greatest length of at most `room`, 0 if there is none; a piece of length `but` is taken already."""
        mask = self.mask & ~(1 << but) if but and len(self.by_length[but]) == 1 else self.mask
        return max(0, (mask & ((2 << room) - 1)).bit_length() - 1)

    def take(self, n: int) -> int:
        own = self.by_length[n]
        piece = own.pop()
        if not own:
            self.mask &= ~(1 << n)
        return piece

    def rest(self) -> np.ndarray:
        return np.array([k for own in self.by_length.values() for k in own], np.int64)


def exchange(bins: np.ndarray, fill: np.ndarray, kept: np.ndarray, displaced: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Puts one or two displaced pieces in the place of none, one or two of a kept bin where that fills it better; returns those displaced then.

    bins and fill are changed. Every exchange makes a bin fuller and the displaced pieces shorter in all.
    """
    open_ = kept[fill[kept] < size]
    if not len(open_) or not len(displaced):
        return displaced
    chosen = open_ if len(open_) <= EXCHANGES else rng.choice(open_, EXCHANGES, replace=False)
    wanted = np.zeros(len(fill), bool)
    wanted[chosen] = True
    own: dict[int, list[int]] = {}
    for k in np.flatnonzero(wanted[bins]).tolist():
        own.setdefault(int(bins[k]), []).append(k)
    pool = Pool(displaced, lengths)
    for bin_ in chosen.tolist():
        free = size - int(fill[bin_])
        if len(own[bin_]) > 8:  # pairs of a few pieces
            own[bin_] = rng.choice(own[bin_], 8, replace=False).tolist()
        lens = [int(lengths[k]) for k in own[bin_]]
        outs = [()] + [(i,) for i in range(len(lens))] + [(i, j) for i in range(len(lens)) for j in range(i)]
        gain, found = 0, None
        for out in outs:
            gone = sum(lens[i] for i in out)
            x = pool.longest(free + gone)
            y = pool.longest(free + gone - x, x) if x else 0
            if x + y - gone > gain:
                gain, found = x + y - gone, (out, x, y)
                if gain == free:
                    break
        if found:
            out, x, y = found
            for n in (x, y) if y else (x,):
                bins[pool.take(n)] = bin_
            for i in out:
                pool.add(own[bin_][i], lens[i])
            fill[bin_] += gain
    return pool.rest()


def exact_packing(lengths: np.ndarray, size: int, start: np.ndarray, least: int, steps: int = STEPS) -> np.ndarray:
    """A packing of the fewest bins by branch and bound from `start`; the best one found if that takes more than `steps` steps."""
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = [int(lengths[k]) for k in order]
    left = np.r_[np.cumsum(sizes[::-1])[::-1], 0].tolist()
    best, count = start, int(start.max(initial=-1)) + 1
    place, free = [0] * len(order), []
    budget = steps

    def search(k: int) -> None:
        nonlocal best, count, budget
        budget -= 1
        if budget < 0 or count <= least or len(free) + max(0, -(-(left[k] - sum(free)) // size)) >= count:
            return
        if k == len(order):
            best, count = np.empty(len(order), np.int32), len(free)
            best[order] = place
            return
        n, tried = sizes[k], set()
        for b in sorted(range(len(free)), key=free.__getitem__):
            if free[b] >= n and free[b] not in tried:
                tried.add(free[b])
                place[k] = b
                free[b] -= n
                search(k + 1)
                free[b] += n
                if free[b] == n:  # a piece that closes a bin need not go elsewhere
                    return
        if len(free) + 1 < count:
            place[k] = len(free)
            free.append(size - n)
            search(k + 1)
            free.pop()

    search(0)
    return best


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator, share: float = 0.5, well: float = WELL_FILLED, open_: int = 1) -> np.ndarray:
    """A child of a with well-filled bins of b injected whole.

    share: of b's well-filled bins, those that are injected. a's bins that hold a piece of these go, and so do (mutation) its
    open_ emptiest bins and a few at random; their other pieces are displaced and best-fitted, longest first.
    """
    fill = fills(b, lengths)
    inject = np.zeros(len(fill), bool)
    full = np.flatnonzero(fill >= well * size)
    inject[full[rng.random(len(full)) < share]] = True
    taken = inject[b]
    fill = fills(a, lengths)
    gone = rng.random(len(fill)) < MUTATION
    gone[np.argpartition(fill, min(open_, len(fill)) - 1)[:open_]] = True
    gone[a[taken]] = True
    displaced = np.flatnonzero(gone[a] & ~taken)
    kept = np.flatnonzero(~gone)
    child = a.copy()
    displaced = exchange(child, fill, kept, displaced, lengths, size, rng)
    # Lengths are blurred a little, so that equal displacements do not always end in the same bins.
    displaced = displaced[np.argsort(-lengths[displaced] * (1 + 0.1 * rng.random(len(displaced))))]
    child[taken] = len(fill) + b[taken]
    top = len(fill) + int(inject.nonzero()[0].max(initial=-1)) + 1
    child[displaced] = Gaps(size, fill[kept], kept).fit(lengths[displaced].tolist(), top)
    return compact(child)


def compact(bins: np.ndarray) -> np.ndarray:
    """The same packing with its bins numbered from 0 without gaps."""
    used = np.zeros(int(bins.max(initial=-1)) + 1, np.int64)
    used[bins] = 1
    return (np.cumsum(used) - 1)[bins].astype(np.int32)


def first_packing(lengths: np.ndarray, size: int, rng: np.random.Generator | None) -> np.ndarray:
    """Best fit by descending length; with a rng, lengths are blurred a little first."""
    order = np.argsort(-lengths * (1 if rng is None else 1 + 0.08 * rng.random(len(lengths))), kind="stable")
    out = np.empty(len(lengths), np.int32)
    out[order] = Gaps(size).fit(lengths[order].tolist(), 0)
    return out


def tight_packing(lengths: np.ndarray, size: int, tries: int = 48) -> np.ndarray:
    """Bin by bin: the largest piece left, then again and again the piece or pair of pieces that fills the rest best."""
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    for k, n in enumerate(lengths.tolist()):
        stacks[n].append(k)
    mask = sum(1 << n for n in range(1, size + 1) if stacks[n])
    out, bins = np.empty(len(lengths), np.int32), 0

    def top(bits: int) -> int:
        return bits.bit_length() - 1

    while mask:
        bin_, gap, chosen = [], size, (top(mask),)
        while chosen:
            for n in chosen:
                bin_.append(stacks[n].pop())
                if not stacks[n]:
                    mask &= ~(1 << n)
                gap -= n
            low, chosen = mask & ((2 << gap) - 1) & ~1, ()
            if not low:
                break
            best, m = top(low), low
            chosen = (best,)
            for _ in range(tries):
                if not m or best == gap:
                    break
                x = top(m)
                if 2 * x <= best:
                    break
                m &= ~(1 << x)
                fits = low & ((2 << min(gap - x, x)) - 1)
                if len(stacks[x]) < 2:
                    fits &= ~(1 << x)
                if fits and x + top(fits) > best:
                    best, chosen = x + top(fits), (x, top(fits))
        out[bin_] = bins
        bins += 1
    return out


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """No packing has fewer bins: ceil(sum / size), sharpened by pieces that can't share a bin (Martello and Toth's second bound).

    For a threshold a up to size / 2, pieces above size - a stand alone among those of at least a; of the others each above
    size / 2 needs a bin of its own, whose rest is all that smaller ones may use without another bin.
    """
    n = np.bincount(lengths, minlength=size + 2)
    above, load = np.r_[np.cumsum(n[::-1])[::-1], 0], np.r_[np.cumsum((n * np.arange(len(n)))[::-1])[::-1], 0]  # of lengths >= index
    a = np.arange(size // 2 + 1)
    half = size // 2 + 1
    alone, big, big_load = above[size - a + 1], above[half] - above[size - a + 1], load[half] - load[size - a + 1]
    over = (load[a] - load[half]) - (big * size - big_load)
    return int((alone + big + np.maximum(0, -(-over // size))).max())


def evolve(lengths: np.ndarray, size: int, seed: int, guests: list[np.ndarray] = (), population: int = POPULATION, generations: int = GENERATIONS, stall: int = STALL) -> np.ndarray:
    """The best packing of one island's epoch.

    It ends where the lower bound is reached, after `stall` generations that found no packing of fewer bins, or
    after `generations`. guests: packings of the epoch before, the island's own and the elite that came in.
    """
    least = lower_bound(lengths, size)
    group: list[np.ndarray] = []
    for seeded in (*(lambda g=g: g for g in guests), lambda: first_packing(lengths, size, None), lambda: tight_packing(lengths, size)):
        group.append(seeded())
        if int(group[-1].max(initial=-1)) + 1 <= least:
            return group[-1]
    if len(lengths) <= EXACT:
        group.append(exact_packing(lengths, size, min(group, key=lambda x: int(x.max())), least))
        if int(group[-1].max()) + 1 <= least:
            return group[-1]
    rng = np.random.default_rng(seed)
    while len(group) < population:
        group.append(first_packing(lengths, size, rng))
    scored = sorted(((fitness(x, lengths, size), -k, x) for k, x in enumerate(group)), key=lambda s: s[:2], reverse=True)[:population]
    born, best, still = len(group), scored[0][0][0], 0
    for _ in range(generations):
        for _ in range(population):
            i, j = rng.choice(len(scored), 2, replace=False).tolist()
            share = SHARES[int(rng.integers(len(SHARES)))]
            child = crossover(scored[i][2], scored[j][2], lengths, size, rng, share, open_=int(rng.integers(1, 5)))
            scored.append((fitness(child, lengths, size), -born, child))
            born += 1
        unlike = {s[0]: s for s in sorted(scored, key=lambda s: s[:2])}  # one packing of each fitness, so that the group stays mixed
        scored = sorted(unlike.values(), key=lambda s: s[:2], reverse=True)[:population]
        if len(scored) < 2:
            scored.append((fitness(x := first_packing(lengths, size, rng), lengths, size), -born, x))
            born += 1
        still = 0 if scored[0][0][0] > best else still + 1
        best = scored[0][0][0]
        if -best <= least or still >= stall:
            break
    return scored[0][2]


def evolved(rows: DataFrame, shards: int, size: int, islands: int, epochs: int, seed: list[int]) -> tuple[DataFrame, str]:
    """shard, lengths, rids, own (the bin of each piece) of the best packings, and where they are written.

    rows: one a shard, with `own` a packing that is there already (any numbers) or null. An island's epoch is one row of a
    narrow map. The number of tasks does not grow with the shards: beyond it each task evolves several.
    """
    import pyarrow as pa

    spark = rows.sparkSession
    tasks = min(shards * islands, max(TASKS, spark.sparkContext.defaultParallelism))
    state = rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))).withColumn("guest", F.lit(None).cast("array<long>"))
    names = ["shard", "lengths", "rids", "island", "own", "bins", "fill"]

    def epoch(no: int):
        def run(batches: Iterator) -> Iterator:
            for b in (part for whole in batches for part in slices(whole, 1)):
                shard_, island, lengths = b["shard"][0].as_py(), b["island"][0].as_py(), b["lengths"][0].values.to_numpy()
                guests = [np.unique(x.values.to_numpy(), return_inverse=True)[1].astype(np.int32) for x in (b["own"][0], b["guest"][0]) if x.is_valid]
                best = evolve(lengths, size, [*seed, no, shard_, island], guests)
                score = fitness(best, lengths, size)
                yield pa.RecordBatch.from_arrays([b["shard"], b["lengths"], b["rids"], b["island"], pa.array([best], pa.list_(pa.int64())), pa.array([-score[0]], pa.int32()), pa.array([score[1]])], names=names)

        return run

    before = None
    for no in range(epochs):
        if no:  # the elite migrates along the ring
            moved = state.select(F.col("shard").alias("g_shard"), F.pmod(F.col("island") + 1, F.lit(islands)).alias("g_island"), F.col("own").alias("guest"))
            state = state.join(moved, (F.col("shard") == F.col("g_shard")) & (F.col("island") == F.col("g_island")))
        dealt = state.select("shard", "lengths", "rids", "island", "own", "guest").repartition(tasks, "shard", "island")
        state, path = written_at(dealt.mapInArrow(epoch(no), "shard int, lengths array<long>, rids array<long>, island int, own array<long>, bins int, fill double"), "pack-epoch")
        if before:
            remove(spark, before)
        before = path
    best = state.groupBy("shard").agg(F.max(F.struct(-F.col("bins"), "fill", -F.col("island"), "lengths", "rids", "own")).alias("b"))
    return best.select("shard", "b.lengths", "b.rids", "b.own"), before


def dealt_by_length(part: DataFrame, shard: int) -> tuple[DataFrame, int]:
    """shard, length, rid, and the number of shards: pieces sorted by length are dealt in turn, so that all shards have equal mixes of lengths.

    (A shard with more long pieces than its short ones can fill up would waste what others lack.) The sort is by ranges of
    (length, hash), so that a length that many pieces have is spread; only the ranges' sizes come to the driver.
    """
    lot = F.xxhash64("rid")
    ranged = part.select("rid", "length").repartitionByRange("length", lot).sortWithinPartitions("length", lot)
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "pack-ranged")
    of, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(map(tuple, ranged.groupBy(of.alias("range")).count().collect()))
    ranks = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    shards = max(1, -(-ranks[-1] // shard))
    before = part.sparkSession.createDataFrame([(r, b) for (r, _), b in zip(sizes, ranks, strict=False)], "range long, before long")
    dealt = ranged.withColumn("range", of).join(F.broadcast(before), "range")  # one row for each range
    return dealt.select(F.pmod(F.col("before") + place, F.lit(shards)).cast("int").alias("shard"), "length", "rid"), shards


def least_filled(own: np.ndarray, lengths: np.ndarray, size: int, pieces: int) -> np.ndarray:
    """Whether each piece is in one of the least filled bins, which hold about so many pieces; full bins stay as they are."""
    fill, counts = fills(own, lengths), np.bincount(own)
    order = np.argsort(fill, kind="stable")
    order = order[fill[order] < size]
    some = order[: int(np.searchsorted(np.cumsum(counts[order]), pieces)) + 1]
    open_ = np.zeros(len(fill), bool)
    open_[some] = True
    return open_[own]


def pack(items: DataFrame, size: int = SEQUENCE, shard: int = SHARD, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 11, fan: int = FAN) -> DataFrame:
    """items (id, piece, start, length, ids_crc32; lengths 1 to size) plus sequence_id and offset.

    Whole pieces of `size` are sequences of their own. Ties, null ids and repeated rows are pieces like any other.
    """
    import pyarrow as pa

    items = written(items.withColumn("rid", F.monotonically_increasing_id()), "pack-pieces")
    full = items.filter(F.col("length") == size).select("id", "piece", "start", "length", "ids_crc32", (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = items.filter(F.col("length") < size)
    pieces_, shards = dealt_by_length(part, shard)
    pieces_ = pieces_.withColumn("old", F.lit(None).cast("long"))

    def place(level: int, shards: int):
        """Rows of pieces with a place each; open: they go to the next level, where a group of shards fills one."""
        many = max(8, shard // min(fan, shards))

        def run(batches: Iterator) -> Iterator:
            for b in (part for whole in batches for part in slices(whole, 1)):
                own, lengths, rids = (b[c][0].values.to_numpy() for c in ("own", "lengths", "rids"))
                open_ = least_filled(own, lengths, size, many) if shards > 1 else np.zeros(len(own), bool)
                order = np.lexsort((np.arange(len(own)), own))
                own, lengths, rids, open_ = own[order], lengths[order], rids[order], open_[order]
                starts = np.cumsum(lengths) - lengths
                first = np.r_[True, own[1:] != own[:-1]]
                offset = starts - np.maximum.accumulate(np.where(first, starts, 0))
                sequence = (level << 58) + (b["shard"][0].as_py() << 20) + own
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(own), b["shard"][0].as_py()), pa.int32()), "p_rid": pa.array(rids), "length": pa.array(lengths), "sequence_id": pa.array(sequence), "offset": pa.array(offset), "open": pa.array(open_)})

        return run

    level, placed = 0, None
    while True:
        lists = pieces_.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "rid", "old"))).alias("x"))
        rows = lists.select("shard", F.col("x.length").alias("lengths"), F.col("x.rid").alias("rids"), F.when(F.col("x")[0]["old"].isNotNull(), F.col("x.old")).alias("own"))
        best, at = evolved(rows, shards, size, islands, epochs if shards > 1 or not level else 1, [seed, level])
        out, _ = written_at(best.mapInArrow(place(level, shards), "shard int, p_rid long, length long, sequence_id long, offset long, open boolean"), "pack-placed")
        remove(items.sparkSession, at)
        closed = out.filter(~F.col("open")).select("p_rid", "sequence_id", "offset")
        placed = closed if placed is None else placed.unionByName(closed)
        if shards == 1:
            break
        pieces_ = out.filter("open").select(F.floor(F.col("shard") / fan).cast("int").alias("shard"), "length", F.col("p_rid").alias("rid"), F.col("sequence_id").alias("old"))
        level, shards = level + 1, -(-shards // fan)
    part = part.join(placed, F.col("rid") == F.col("p_rid"))
    return full.unionByName(part.select(*full.columns))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, **parameters) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset. Null texts are the end id alone.

    Other columns are ignored; an empty table gives an empty result.
    """
    out = pack(pieces(docs, tokenizer_path, id_col, text_col, size), size, **parameters)
    return out.withColumnRenamed("id", id_col)
