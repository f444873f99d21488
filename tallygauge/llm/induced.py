"""Suffixes of a text in order, with their common prefixes, by induced sorting on disk.

A suffix is of type S if it is smaller than the one after it, else L; an S suffix after an L one begins a
substring that ends where the next one begins.

1. These substrings are sorted and numbered. The text of their numbers is sorted by recursion, or in memory once it is
   short enough, and that orders the suffixes at which substrings begin: the seeds.
2. Seeds and L suffixes are taken in increasing order, and each gives its predecessor a place if that is an L suffix.
   Predecessors wait in a priority queue: a queue per first symbol, which is the order of suffixes because they come in order.
3. L suffixes are taken in decreasing order and give all S suffixes their place in the same way.

What waits in a queue is a position and how many symbols the suffix has in common with the one before it there: one more than
their successors have, which is the least of the common prefixes passed in between. Queues, sorted runs, seeds and orders live in files
of a folder of the task; ``memory`` items of them at most are held. Blocks of a queue are worked on together with numpy.
Common prefixes are counted up to ``cap`` and suffixes that agree so far may come in any order.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from pathlib import Path

import numpy as np

Block = tuple[np.ndarray, np.ndarray]
BLOCK = 1 << 16


def scratch_folder() -> tempfile.TemporaryDirectory:
    """A folder for what a task spills, where Spark spills too; it ends with the task and nothing else reads it."""
    places = [p for p in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if p]
    return tempfile.TemporaryDirectory(prefix="induced-", dir=places[0] if places else None)


class Log:
    """Blocks of pairs in a file, to be read again by number."""

    def __init__(self, path: Path):
        self.path, self.ends = path, [0]
        self.out = path.open("wb", buffering=1 << 20)

    def append(self, first: np.ndarray, second: np.ndarray) -> int:
        np.stack((first, second)).astype(np.int64).tofile(self.out)
        self.ends.append(self.ends[-1] + len(first))
        return len(self.ends) - 2

    def read(self, number: int) -> Block:
        self.out.flush()
        start, end = self.ends[number], self.ends[number + 1]
        both = np.fromfile(self.path, np.int64, 2 * (end - start), offset=16 * start)
        return both[: end - start], both[end - start :]


class Waiting:
    """The priority queue: by symbol, and in the order of arrival."""

    def __init__(self, path: Path, memory: int, sign: int):
        self.log, self.memory, self.sign = Log(path), memory, sign
        self.queues: dict[int, list] = defaultdict(list)
        self.symbols: list[int] = []
        self.held = 0

    def push(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        queue = self.queues[symbol]
        if not queue:
            heappush(self.symbols, self.sign * symbol)
        queue.append((positions, common))
        self.held += len(positions)
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        for queue in self.queues.values():
            on_disk = [part for part in queue if isinstance(part, int)]
            here = [part for part in queue if not isinstance(part, int)]
            if here:
                queue[:] = [*on_disk, self.log.append(*map(np.concatenate, zip(*here, strict=True)))]
        self.held = 0

    def next_symbol(self) -> int | None:
        while self.symbols and not self.queues.get(self.sign * self.symbols[0]):
            self.queues.pop(self.sign * heappop(self.symbols), None)
        return self.sign * self.symbols[0] if self.symbols else None

    def pop(self, symbol: int) -> Iterator[Block]:
        """Blocks of what waits at a symbol, until nothing does; more may arrive meanwhile."""
        while parts := self.queues.get(symbol):
            self.queues[symbol] = []
            whole: list[Block] = []
            for part in parts:
                if isinstance(part, int):
                    yield from cut(*joined(whole))
                    whole = []
                    yield from cut(*self.log.read(part))
                else:
                    self.held -= len(part[0])
                    whole.append(part)
            yield from cut(*joined(whole))
            if self.queues[symbol]:
                heappush(self.symbols, self.sign * symbol)


def joined(parts: list[Block]) -> Block:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def cut(positions: np.ndarray, common: np.ndarray) -> Iterator[Block]:
    for at in range(0, len(positions), BLOCK):
        yield positions[at : at + BLOCK], common[at : at + BLOCK]


class Sorter:
    """Rows of three numbers, sorted by the first two in runs on disk and merged."""

    def __init__(self, path: Path, memory: int):
        self.path, self.memory, self.held, self.size = path, memory, [], 0
        self.runs: list[list[int]] = []
        self.out = path.open("wb")

    def push(self, rows: np.ndarray) -> None:
        self.held.append(rows)
        self.size += len(rows)
        if self.size > self.memory:
            start = self.runs[-1][1] if self.runs else 0
            self.in_order(self.held).tofile(self.out)
            self.runs.append([start, start + self.size])
            self.held, self.size = [], 0

    @staticmethod
    def in_order(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))]

    def sorted(self) -> Iterator[np.ndarray]:
        self.out.flush()
        if not self.runs:
            if self.held:
                yield self.in_order(self.held)
            return
        if self.held:
            start = self.runs[-1][1]
            self.in_order(self.held).tofile(self.out)
            self.runs.append([start, start + self.size])
            self.held = []
            self.out.flush()
        share = max(1, self.memory // len(self.runs))
        heads: list[np.ndarray | None] = [None] * len(self.runs)
        while True:
            for i, run in enumerate(self.runs):
                if (heads[i] is None or not len(heads[i])) and run[0] < run[1]:
                    count = min(share, run[1] - run[0])
                    heads[i] = np.fromfile(self.path, np.uint64, 3 * count, offset=24 * run[0]).reshape(-1, 3)
                    run[0] += count
            live = [h for h in heads if h is not None and len(h)]
            if not live:
                return
            # What is not above the least last row of the runs that go on can be given out.
            going_on = [tuple(h[-1, :2].tolist()) for h, run in zip(heads, self.runs, strict=True) if run[0] < run[1]]
            least = min(going_on, default=None)
            out = []
            for i, head in enumerate(heads):
                if head is None or not len(head):
                    continue
                n = len(head)
                if least is not None:
                    n = int(np.sum((head[:, 0] < least[0]) | ((head[:, 0] == least[0]) & (head[:, 1] <= least[1]))))
                out.append(head[:n])
                heads[i] = head[n:]
            yield self.in_order(out)


class Passed:
    """The least common prefix since any place of the order."""

    def __init__(self, cap: int):
        self.cap, self.at = cap, 0
        # For each value the last place with a common prefix that is no longer.
        self.last_below = np.full(cap + 1, -1)

    def since(self, places: np.ndarray) -> np.ndarray:
        """The least after each of some places; ``cap`` if nothing came after."""
        return np.minimum(np.searchsorted(self.last_below, places + 1), self.cap)

    def add(self, common: np.ndarray) -> None:
        last = np.full(self.cap + 1, -1)
        last[common] = self.at + np.arange(len(common))
        self.last_below = np.maximum(self.last_below, np.maximum.accumulate(last))
        self.at += len(common)


def least_between(values: np.ndarray, after: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The least of ``values[after + 1 : upto + 1]`` for each pair."""
    table, reach = [values], 1
    widest = int((upto - after).max()) if len(after) else 0
    while 2 * reach <= widest:
        table.append(np.minimum(table[-1][:-reach], table[-1][reach:]))
        reach *= 2
    level = np.frexp((upto - after).astype(np.float64))[1] - 1
    out = np.empty(len(after), np.int64)
    for k, row in enumerate(table):
        own = level == k
        out[own] = np.minimum(row[after[own] + 1], row[upto[own] - (1 << k) + 1])
    return out


class Induction:
    """One pass over an order, which gives predecessors their places."""

    def __init__(self, text: np.ndarray, cap: int, waiting: Waiting, symbols: np.ndarray):
        self.text, self.cap, self.waiting = text, cap, waiting
        self.passed = Passed(cap)
        # Where in the order the last suffix stood whose predecessor has this symbol.
        self.last = symbols

    def take(self, positions: np.ndarray, common: np.ndarray, symbol: int, compare: np.ufunc) -> None:
        """The next block of the order, all beginning with ``symbol``."""
        before = self.text[np.maximum(positions - 1, 0)].astype(np.int64)
        own = np.flatnonzero((positions > 0) & compare(before, symbol))
        if len(own):
            symbols = before[own]
            order = np.argsort(symbols, kind="stable")
            own, symbols = own[order], symbols[order]
            first = np.append(True, symbols[1:] != symbols[:-1])
            least = np.empty(len(own), np.int64)
            later = np.flatnonzero(~first)
            least[later] = least_between(common, own[later - 1], own[later])
            begins = np.flatnonzero(first)
            earlier = self.last[symbols[begins]]
            upto = np.minimum.accumulate(common)[own[begins]]
            # A symbol that has nothing waiting or taken yet has no neighbour either.
            least[begins] = np.where(earlier < 0, -1, np.minimum(self.passed.since(earlier), upto))
            shared = np.minimum(least + 1, self.cap)
            ends = np.append(begins[1:], len(own))
            self.last[symbols[begins]] = self.passed.at + own[ends - 1]
            targets = positions[own] - 1
            for start, end in zip(begins.tolist(), ends.tolist(), strict=True):
                self.waiting.push(int(symbols[start]), targets[start:end], shared[start:end])
        self.passed.add(common)


def run_length(text: np.ndarray, at: int, symbol: int, cap: int) -> int:
    other = np.flatnonzero(text[at : at + cap] != symbol)
    return int(other[0]) if len(other) else min(cap, len(text) - at)


def seam(text: np.ndarray, a: int, b: int, symbol: int, cap: int) -> int:
    """Common prefix of an L and an S suffix: they differ where the shorter run of their first symbol ends."""
    return min(run_length(text, a, symbol, cap), run_length(text, b, symbol, cap))


def places_of_last(path: Path, symbols: int, memory: int) -> np.ndarray:
    if symbols <= memory:
        return np.full(symbols, -1)
    found = np.memmap(path, np.int64, "w+", shape=(symbols,))
    for at in range(0, symbols, memory):
        found[at : at + memory] = -1
    return found


def induced(text: np.ndarray, seeds: Iterator[Block], symbols: int, cap: int, memory: int, folder: Path) -> Iterator[Block]:
    """All suffixes in decreasing order: positions, and common prefix with the one given out before."""
    greater = Waiting(folder / "greater", memory, 1)
    rising = Induction(text, cap, greater, places_of_last(folder / "rising", symbols, memory))
    kept, buckets = Log(folder / "kept"), []
    runs = runs_by_symbol(text, seeds)
    run = next(runs, None)
    while True:
        waiting = greater.next_symbol()
        if run is None and waiting is None:
            break
        symbol = min(s for s in (waiting, run[0] if run else None) if s is not None)
        last = None
        for positions, common in greater.pop(symbol):
            buckets.append((symbol, kept.append(positions, common)))
            rising.take(positions, common, symbol, np.greater_equal)
            last = int(positions[-1])
        is_first = True
        while run is not None and run[0] == symbol:
            _, positions, common = run
            if is_first:
                common = common.copy()
                common[0] = seam(text, last, int(positions[0]), symbol, cap) if last is not None else 0
                is_first = False
            rising.take(positions, common, symbol, np.greater_equal)
            run = next(runs, None)

    smaller = Waiting(folder / "smaller", memory, -1)
    falling = Induction(text, cap, smaller, places_of_last(folder / "falling", symbols, memory))
    while True:
        waiting = smaller.next_symbol()
        if waiting is None and not buckets:
            break
        symbol = max(s for s in (waiting, buckets[-1][0] if buckets else None) if s is not None)
        last = None
        for positions, common in smaller.pop(symbol):
            yield positions, common
            falling.take(positions, common, symbol, np.less_equal)
            last = int(positions[-1])
        between = None
        while buckets and buckets[-1][0] == symbol:
            positions, common = kept.read(buckets.pop()[1])
            if between is None:
                between = seam(text, int(positions[-1]), last, symbol, cap) if last is not None else 0
            # A suffix was kept with what it shares with the smaller one, which now comes after it.
            shifted = np.append(between, common[:0:-1])
            between = int(common[0])
            yield positions[::-1], shifted
            falling.take(positions[::-1], shifted, symbol, np.less)
    yield np.array([len(text) - 1]), np.zeros(1, np.int64)


def runs_by_symbol(text: np.ndarray, blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for positions, common in blocks:
        own = text[positions]
        edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for start, end in zip(edges, edges[1:]):
            yield int(own[start]), positions[start:end], common[start:end]


def substring_starts(text: np.ndarray, memory: int, path: Path) -> np.ndarray:
    """Where an S suffix follows an L one, in increasing order; the last symbol, less than all others, is one of them."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    out, numbers, follows, is_small = Log(path.with_suffix(".log")), [], int(text[-1]), True
    for end in range(n - 1, 0, -memory):
        start = max(0, end - memory)
        own = text[start:end].astype(np.int64)
        rise = np.append(own[1:], follows) - own
        there = np.where(rise != 0, np.arange(len(own)), len(own))
        there = np.minimum.accumulate(there[::-1])[::-1]
        small = np.append(rise > 0, is_small)[there]
        # The type of the symbol after each one of the block.
        after = np.append(small[1:], is_small)
        found = np.flatnonzero(after & ~small) + start + 1
        numbers.append(out.append(found, found))
        follows, is_small = int(own[0]), bool(small[0])
    size = out.ends[-1]
    starts = np.memmap(path, np.int64, "w+", shape=(size,)) if size > memory else np.empty(size, np.int64)
    at = 0
    for number in reversed(numbers):
        found = out.read(number)[0]
        starts[at : at + len(found)] = found
        at += len(found)
    return starts


def numbered(text: np.ndarray, starts: np.ndarray, cap: int, memory: int, folder: Path) -> tuple[np.ndarray, bool]:
    """A number per substring in their order, equal for equal ones, and whether all differ.

    Substrings are compared eight bytes at a time; those that still agree are sorted again by the next eight. Where one
    ends, a sign above all others stands: of two that agree so far, the one that goes on goes on as an L suffix and is smaller.
    """
    n = len(starts)
    width = 8 // text.itemsize
    numbers = np.memmap(folder / "numbers", np.uint64, "w+", shape=(n,)) if n > memory else np.empty(n, np.uint64)
    sorter, all_differ = Sorter(folder / "round0", memory), True
    for at in range(0, n, BLOCK):
        own = np.arange(at, min(n, at + BLOCK), dtype=np.uint64)
        sorter.push(keys_of(text, starts, own, np.zeros(len(own), np.uint64), 0, width))
    depth, rounds = width, 1
    while sorter is not None:
        again, before, number = Sorter(folder / f"round{rounds}", memory), None, 0
        held, of_rank, base, seen = [], None, 0, 0
        for rows in groups_whole(sorter.sorted()):
            new_rank = np.append(True, rows[1:, 0] != rows[:-1, 0])
            new = new_rank | np.append(True, rows[1:, 1] != rows[:-1, 1])
            # A number is the rank a group had and how many came before within it.
            index = np.arange(len(rows))
            rank_start = np.maximum.accumulate(np.where(new_rank, index, 0))
            group_start = np.maximum.accumulate(np.where(new, index, 0))
            within = (group_start - rank_start).astype(np.uint64)
            if of_rank is not None and rows[0, 0] == of_rank:
                within[rows[:, 0] == of_rank] += np.uint64(base)
            tail = rows[:, 0] == rows[-1, 0]
            base = (base if of_rank == rows[-1, 0] else 0) + int(tail.sum())
            of_rank = rows[-1, 0]
            rank = rows[:, 0] + within
            numbers[rows[:, 2].astype(np.int64)] = rank
            sizes = np.diff(np.append(np.flatnonzero(new), len(rows)))
            several = np.repeat(sizes > 1, sizes)
            if several.any():
                ids = rows[several, 2].astype(np.int64)
                lengths = np.minimum(starts[np.minimum(ids + 1, n - 1)] - starts[ids] + 1, len(text))
                # One that ends here has yet to be told from one that goes on.
                more = (lengths >= depth) & (depth < cap)
                all_differ &= bool(more.all())
                for i in range(0, int(more.sum()), BLOCK):
                    some = ids[more][i : i + BLOCK].astype(np.uint64)
                    again.push(keys_of(text, starts, some, rank[several][more][i : i + BLOCK], depth, width))
        sorter = again if again.held or again.runs else None
        depth, rounds = depth + width, rounds + 1
    return numbers, all_differ


def groups_whole(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Blocks of sorted rows such that rows with equal keys are in one block."""
    held: list[np.ndarray] = []
    for rows in blocks:
        same = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
        end = len(rows) - int(same.sum())
        if held and end:
            first = (rows[:, 0] == held[0][0, 0]) & (rows[:, 1] == held[0][0, 1])
            yield np.concatenate([*held, rows[:end]]) if first[0] else np.concatenate(held)
            if not first[0]:
                yield rows[:end]
            held = [rows[end:]]
        elif held and not (rows[0, 0] == held[0][0, 0] and rows[0, 1] == held[0][0, 1]):
            yield np.concatenate(held)
            held = [rows]
        elif held:
            held.append(rows)
        else:
            if end:
                yield rows[:end]
            held = [rows[end:]]
    if held:
        yield np.concatenate(held)


def keys_of(text: np.ndarray, starts: np.ndarray, ids: np.ndarray, ranks: np.ndarray, depth: int, width: int) -> np.ndarray:
    """Rank, the next symbols as one number, and which substring."""
    at = starts[ids.astype(np.int64)]
    last = starts[np.minimum(ids.astype(np.int64) + 1, len(starts) - 1)]
    bits, sign = 8 * text.itemsize, np.uint64((1 << (8 * text.itemsize)) - 1)
    key = np.zeros(len(ids), np.uint64)
    for i in range(depth, depth + width):
        place = at + i
        symbol = np.where(place <= last, text[np.minimum(place, len(text) - 1)].astype(np.uint64), sign)
        key = key << np.uint64(bits) | symbol
    return np.stack((ranks, key, ids), axis=1)


def seeds_of(text: np.ndarray, cap: int, memory: int, folder: Path) -> Iterator[Block]:
    """The suffixes at which substrings begin, in increasing order, with the common prefix with the one before."""
    starts = substring_starts(text, memory, folder / "starts")
    numbers, all_differ = numbered(text, starts, cap, memory, folder)
    if all_differ and len(starts) <= memory:
        order = np.argsort(numbers, kind="stable")
        blocks = cut(order, np.zeros(len(order), np.int64))
    else:
        deeper = folder / "deeper"
        deeper.mkdir()
        blocks = in_order(short_numbers(numbers, deeper, memory), cap, memory, deeper)
    before = -1
    for own, common in blocks:
        a, b = np.append(before, own[:-1]), own
        before = own[-1]
        positions = starts[b]
        a = np.maximum(a, 0)
        # Whole substrings in common, and what the two that differ begin with.
        shared = np.minimum(starts[np.minimum(a + common, len(starts) - 1)] - starts[a], cap)
        x, y = starts[a] + shared, positions + shared
        alive = np.flatnonzero(shared < cap)
        while len(alive):
            inside = (x[alive] < len(text)) & (y[alive] < len(text))
            alive = alive[inside]
            alive = alive[(text[x[alive]] == text[y[alive]]) & (shared[alive] < cap) & (x[alive] != y[alive])]
            shared[alive] += 1
            x[alive] += 1
            y[alive] += 1
        yield positions, shared


def short_numbers(numbers: np.ndarray, folder: Path, memory: int) -> np.ndarray:
    """The numbers as a text of 32-bit symbols, on disk if it is long."""
    n = len(numbers)
    if n >= 1 << 32:
        raise ValueError("a shard of more than 2^32 substrings")
    text = np.memmap(folder / "text", np.uint32, "w+", shape=(n,)) if n > memory else np.empty(n, np.uint32)
    for at in range(0, n, BLOCK):
        text[at : at + BLOCK] = numbers[at : at + BLOCK]
    return text


def in_order(text: np.ndarray, cap: int, memory: int, folder: Path) -> Iterator[Block]:
    """All suffixes of a text in increasing order, with the common prefix with the one before."""
    if len(text) <= memory:
        yield from cut(*doubled(np.asarray(text), cap))
        return
    log = Log(folder / "order")
    numbers = [log.append(*block) for block in decreasing(text, cap, memory, folder)]
    # What a suffix shares with the larger one belongs, in increasing order, to the larger one.
    for i in reversed(numbers):
        positions, common = log.read(i)
        with_smaller = int(log.read(i + 1)[1][0]) if i + 1 < len(numbers) else 0
        yield positions[::-1], np.append(common[1:], with_smaller)[::-1]


def doubled(text: np.ndarray, cap: int) -> Block:
    """Suffixes in order by doubling in memory, and the common prefixes from the ranks of every step."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ranks, reach = [rank.astype(np.int32)], 1
    order = np.argsort(rank, kind="stable")
    while reach < cap and n and rank.max() + 1 < n:
        second = np.zeros(n, np.int64)
        second[: max(0, n - reach)] = rank[reach:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        ranks.append(rank.astype(np.int32))
        reach *= 2
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < n) & (y < n)
        same = inside & (ranks[level][np.minimum(x, n - 1)] == ranks[level][np.minimum(y, n - 1)])
        common += same.astype(np.int64) << level
    return order, np.append(0, np.minimum(common, cap))[: len(order)]


def decreasing(text: np.ndarray, cap: int, memory: int, folder: Path) -> Iterator[Block]:
    """All suffixes of a text, whose last symbol is 0 and its only one, in decreasing order."""
    symbols = 1 << 8 if text.itemsize == 1 else len(text) + 1
    yield from induced(text, seeds_of(text, cap, memory, folder), symbols, cap, memory, folder)
