"""Hierarchical Pitman-Yor language model over words, sampled by Gibbs in Chinese restaurants.

Three levels. A token is a customer of the restaurant of the whole word before it (of the start, for the first). That restaurant's
parent is the one of the word's ending, its last three bytes; each of its tables is a customer there. Their parent is the
root, and the root's is uniform over the V words seen in training and one unknown word. There are as many restaurants as the corpus has words
and endings.

Words are dealt by hash, and a task seats the customers of its words at all three levels. What a restaurant needs to know of all words, its
numbers of customers and tables, is summed by a shuffle on the restaurants and sent back to the tasks that ask; only the root's numbers are known
everywhere. A chunk of documents sends each of its pairs of word and word before once, with a count, and gets back one
probability for it. Words are in the order of their hashes wherever they are listed, so the range that gets the pairs keeps of a chunk only which
of its own pairs they are, as steps from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import gathered_chunks, mixed, narrow, pack, stored, unpack, words_of

#: Bytes of text in a chunk.
CHUNK_BYTES = 8 << 20
#: Bytes of text whose words come to one range of word hashes, at most on average.
RANGE_BYTES = 8 << 20
#: Sweeps before restaurants exchange their numbers, sweeps after that, and the sweeps then that are samples, to be averaged.
BURN_IN = 2
SETTLING = 1
SAMPLES = 2
#: Pairs of up to so many customers are seated anew in a sweep.
ANEW = 15
#: Pairs above that and of up to so many customers move them one by one; larger ones in as many blocks, of this many at most.
BLOCKS = 32
BLOCK_CUSTOMERS = 1 << 20
#: Strength of all restaurants.
STRENGTH = 1.0
SEED = 23
#: A log10 probability travels as a multiple of one over this.
STEPS = 1 << 13
#: Pairs whose probabilities are worked out at once; bounds a task's memory.
SCORED_TOGETHER = 1 << 17
#: Added to counts in the base score.
ADDED = 0.1

#: The end of a text as a word: no word holds white space. Before a text's first word stands an end too.
END = xxhash.xxh64_intdigest(" end")
END_ENDING = (1 << 32) - 1


def held_out(doc_id: Column) -> Column:
    """Whether a document teaches nothing; a null doc_id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def ending_of(word: str) -> int:
    """The last three bytes and how many there are, as a number."""
    last = word.encode()[-3:]
    return len(last) << 24 | int.from_bytes(last, "big")


def planes(values: np.ndarray, kind: str = "<u4") -> np.ndarray:
    """Non-negative integers as their first bytes, then their second bytes and so on, which compress better."""
    kind = np.dtype(kind)
    return values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.ravel()


def joined(parts: np.ndarray, kind: str = "<u4") -> np.ndarray:
    kind = np.dtype(kind)
    values = np.ascontiguousarray(parts.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return values if kind.itemsize == 8 else values.astype(np.int64)


def steps(hashes: np.ndarray) -> np.ndarray:
    """Ascending 64-bit hashes as the differences of neighbours, in planes."""
    return planes(np.diff(hashes, prepend=np.uint64(0)), "<u8")


def climbed(parts: np.ndarray) -> np.ndarray:
    return np.cumsum(joined(parts, "<u8"), dtype=np.uint64)


def steps_within(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Numbers that ascend within each of some runs (given by their lengths, none of them 0) as differences, in planes."""
    out, starts = np.diff(values, prepend=0), np.cumsum(runs) - runs
    out[starts] = values[starts]
    return planes(out)


def climbed_within(parts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    values = np.cumsum(own := joined(parts))
    starts = np.cumsum(runs) - runs
    return values - np.repeat(values[starts] - own[starts], runs)


def pairs_of(tokens: np.ndarray, words: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a word and the word before as ``word * words + before``, and each token's pair. The end of the
    text before stands before a first word."""
    return np.unique(tokens * words + np.r_[end, tokens[:-1]], return_inverse=True)


def endings_of(words: pa.Array) -> np.ndarray:
    """``ending_of`` of each word."""
    words = words.cast(pa.large_string())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    known = np.minimum(np.diff(ends), 3)
    out = known << 24
    for nth in range(3):
        at = np.flatnonzero(known > nth)
        out[at] |= raw[ends[1:][at] - 1 - nth].astype(np.int64) << 8 * nth
    return out


@dataclass
class Chunk:
    """Documents as numbers: words in the order of their hashes, ``end`` among them."""

    hashes: np.ndarray
    endings: np.ndarray
    end: int
    tokens: np.ndarray
    lengths: np.ndarray
    pairs: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, teaches: np.ndarray) -> Chunk:
        starts, ids, dictionary = words_of(texts)
        hashes = np.array([END, *map(xxhash.xxh64_intdigest, dictionary.to_pylist())], np.uint64)
        hashes, nth, number = np.unique(hashes, return_index=True, return_inverse=True)
        endings, end = np.r_[END_ENDING, endings_of(dictionary)][nth], int(number[0])
        tokens = np.insert(number[1:][ids], starts[1:], end)
        pairs, of = pairs_of(tokens, len(hashes), end)
        lengths = np.diff(starts) + 1
        counts = np.bincount(of, np.repeat(teaches, lengths), len(pairs)).astype(np.int64)
        return cls(hashes, endings, end, tokens, lengths, pairs, counts)


def running(values: np.ndarray) -> np.ndarray:
    """Running sums from 0 on, one more than there are values."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums


@dataclass
class Seating:
    """Tables of many pairs of restaurant and dish, side by side: pair i has ``sizes[starts[i]:starts[i + 1]]``."""

    sizes: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, tables: np.ndarray) -> Seating:
        return cls(sizes.astype(np.int64), running(tables))

    def tables(self) -> np.ndarray:
        return np.diff(self.starts)

    def customers(self) -> np.ndarray:
        return np.diff(running(self.sizes)[self.starts])

    def take(self, pairs: np.ndarray) -> Seating:
        tables = self.tables()[pairs]
        starts = running(tables)
        if (tables == 1).all():
            return Seating(self.sizes[self.starts[pairs]], starts)
        return Seating(self.sizes[np.arange(starts[-1]) + np.repeat(self.starts[pairs] - starts[:-1], tables)], starts)

    def choose(self, weights: np.ndarray, at: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """The table of each pair ``at`` where the running sum of the tables' weights passes ``drawn`` times their sum."""
        sums = running(weights)
        low, high = sums[self.starts[at]], sums[self.starts[at + 1]]
        return np.clip(np.searchsorted(sums, low + drawn * (high - low), "right") - 1, self.starts[at], self.starts[at + 1] - 1)

    def close_empty(self) -> None:
        empty = self.sizes == 0
        if empty.any():
            self.starts = self.starts - running(empty)[self.starts]
            self.sizes = self.sizes[~empty]

    def remove(self, at: np.ndarray, rng: np.random.Generator) -> None:
        """One customer of each pair ``at`` leaves, any with equal chance."""
        self.sizes[self.choose(self.sizes, at, rng.random(len(at)))] -= 1
        self.close_empty()

    def remove_some(self, at: np.ndarray, many: np.ndarray, rng: np.random.Generator) -> None:
        """So many customers of each pair ``at`` leave, any with equal chance."""
        own = self.take(at)
        pair = np.repeat(np.arange(len(at)), own.customers())
        table = np.repeat(np.arange(len(own.sizes)) + np.repeat(self.starts[at] - own.starts[:-1], own.tables()), own.sizes)
        order = np.lexsort([rng.random(len(pair)), pair])
        nth = np.arange(len(pair)) - np.repeat(np.r_[0, np.cumsum(own.customers())[:-1]], own.customers())
        self.sizes -= np.bincount(table[order][nth < many[pair]], minlength=len(self.sizes))
        self.close_empty()

    def add(self, at: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """A customer sits down for each item of ``at``, which ascends and may repeat a pair: at a table by its size less the
        discount, or at a new one by ``fresh``, a number for each pair of the seating."""
        weights = self.sizes - discount
        sums = running(weights)
        old = sums[self.starts[at + 1]] - sums[self.starts[at]]
        opens = (rng.random(len(at)) * (old + fresh[at]) >= old) | (self.starts[at + 1] == self.starts[at])
        stay = at[~opens]
        if len(stay):
            self.sizes += np.bincount(self.choose(weights, stay, rng.random(len(stay))), minlength=len(self.sizes))
        if opens.any():
            self.sizes = np.insert(self.sizes, self.starts[at[opens] + 1], 1)
            self.starts = self.starts + running(np.bincount(at[opens], minlength=len(self.starts) - 1))

    def fit(self, wanted: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> Seating:
        """The seating after customers left or came until each pair has as many as wanted; they come in eighths of those still missing."""
        have = self.customers()
        other = wanted != have
        less, more = np.flatnonzero(wanted < have), np.flatnonzero(wanted > have)
        fewer, grown = self.take(less), self.take(more)
        if len(less):
            fewer.remove_some(np.arange(len(less)), (have - wanted)[less], rng)
        missing, weights = (wanted - have)[more], fresh[more]
        while missing.any():
            coming = -(-missing // 8)
            grown.add(np.repeat(np.arange(len(more)), coming), weights, discount, rng)
            missing = missing - coming
        return together([np.flatnonzero(~other), less, more], [self.take(np.flatnonzero(~other)), fewer, grown])


def together(pairs: list[np.ndarray], parts: list[Seating]) -> Seating:
    """One seating of parts that hold these pairs."""
    tables = np.empty(sum(map(len, pairs)), np.int64)
    for own, part in zip(pairs, parts):
        tables[own] = part.tables()
    starts = running(tables)
    sizes = np.empty(starts[-1], np.int64)
    for own, part in zip(pairs, parts):
        each = part.tables()
        if (each == 1).all():
            sizes[starts[own]] = part.sizes
        else:
            sizes[np.arange(len(part.sizes)) + np.repeat(starts[own] - part.starts[:-1], each)] = part.sizes
    return Seating(sizes, starts)


def drawn_anew(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> Seating:
    """Pairs of up to three customers, all of whom leave and sit down again: the chances of their few seatings are known."""
    one = 1 - discount
    three = customers == 3
    together = np.where(three, one * (one + 1), one)
    split = np.where(three, 3 * one * fresh, fresh)
    alone = np.where(three, fresh * fresh, 0)
    drawn = rng.random(len(customers)) * (together + split + alone)
    tables = np.where(customers > 1, 1 + (drawn >= together) + (three & (drawn >= together + split)), customers)
    starts = running(tables)
    sizes = np.ones(starts[-1], np.int64)
    sizes[starts[:-1]] = customers - tables + 1
    return Seating(sizes, starts)


def sweep(seats: Seating, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> Seating:
    """All customers of pairs of up to ``ANEW`` leave, and sit down again one after another; the chances of the few seatings of up to three are
    known, and one customer alone has one. Every other pair makes as many moves as it has customers, in each of which a random one leaves
    and sits down again. Pairs above ``BLOCKS``
    customers move them by blocks: each customer of a pair leaves with the same chance, so that a block is a
    ``BLOCKS``-th of the pair on average, and those who left sit down without seeing each other."""
    customers = seats.customers()
    size = np.frexp(customers)[1]
    order, done = [], []
    for bits in np.flatnonzero(np.bincount(size)).tolist():
        own = np.flatnonzero(size == bits)
        number, weights = customers[own], fresh[own]
        most = int(number.max())
        if most == 1:
            part = Seating.of(number, number)
        elif most < 4:
            part = drawn_anew(number, weights, discount, rng)
        elif most <= ANEW:
            part = Seating.of(np.ones(len(own)), np.ones(len(own), np.int64))
            for seated in range(1, most):
                part.add(np.flatnonzero(number > seated), weights, discount, rng)
        elif most > BLOCKS:
            part = seats.take(own)
            blocks = max(BLOCKS, -(-most // BLOCK_CUSTOMERS))
            for _ in range(blocks):
                part.sizes = part.sizes - rng.binomial(part.sizes, 1 / blocks)
                part.close_empty()
                part.add(np.repeat(np.arange(len(own)), number - part.customers()), weights, discount, rng)
        else:
            part = seats.take(own)
            for done_so_far in range(most):
                at = np.flatnonzero(number > done_so_far)
                part.remove(at, rng)
                part.add(at, weights, discount, rng)
        order.append(own)
        done.append(part)
    return together(order, done) if done else seats


@dataclass
class Totals:
    """What all tasks know of the model: words, tokens, the discounts of words before, endings and root, and the root's customers and
    tables, by sample."""

    words: int
    tokens: int
    discounts: tuple[float, float, float]
    root_customers: np.ndarray
    root_tables: np.ndarray


def restaurants(before: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the restaurants of words before and then of (different) endings, ascending, and the place of each in that row."""
    ids = np.r_[before, mixed(endings.astype(np.uint64) + np.uint64(1 << 40))]
    order = np.argsort(ids, kind="stable")
    return ids[order], order


@dataclass
class Range:
    """The words of one range that training has, and the pairs with a word before. ``before`` are the hashes of all words before them; pairs of word and
    word before ascend."""

    words: np.ndarray
    before: np.ndarray
    endings: np.ndarray
    low_word: np.ndarray
    low_before: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        self.known_endings, self.ending_at = np.unique(self.endings, return_inverse=True)
        codes = self.low_word * max(len(self.known_endings), 1) + self.ending_at[self.low_before]
        self.mid_codes, self.low_mid = np.unique(codes, return_inverse=True)
        self.mid_word, self.mid_ending = self.mid_codes // max(len(self.known_endings), 1), self.mid_codes % max(len(self.known_endings), 1)
        self.ids, self.order = restaurants(self.before, self.known_endings)

    def columns(self, samples: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Of the restaurants, and of each sample (tables of the pairs with a word before, and with an ending) what they hold here:
        customers of all samples, then tables."""
        low = lambda weights: np.bincount(self.low_before, weights, len(self.before))
        mid = lambda weights: np.bincount(self.mid_ending, weights, len(self.known_endings))
        customers = [np.r_[low(self.counts), mid(np.bincount(self.low_mid, t, len(self.mid_codes)))] for t, _ in samples]
        tables = [np.r_[low(t), mid(m)] for t, m in samples]
        return [planes(c[self.order]) for c in customers + tables]

    def numbers(self, samples: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
        """Ids of the restaurants, and their columns."""
        return pack(steps(self.ids), *self.columns(samples))

    def totals(self, replies: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the restaurants of words before and of endings, by sample: customers and tables in all ranges."""
        columns = np.empty((len(replies[0]) if replies else 2, len(self.ids)))
        for i, column in enumerate(columns):
            column[self.order] = np.concatenate([joined(r[i]) for r in replies]) if replies else 0
        n, half = len(self.before), len(columns) // 2
        return columns[:half, :n], columns[half:, :n], columns[:half, n:], columns[half:, n:]


@dataclass
class Pairs:
    """All pairs of a range in the order of word and word before, as chunks have them; those that training lacks count 0."""

    words: np.ndarray
    before: np.ndarray
    endings: np.ndarray
    word: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    def packed(self) -> list[np.ndarray]:
        per_word = np.bincount(self.word, minlength=len(self.words))
        return [steps(self.words), steps(self.before), planes(self.endings), planes(per_word), steps_within(self.first, per_word), planes(self.counts)]

    @classmethod
    def of(cls, words, before, endings, per_word, first, counts) -> Pairs:
        per_word = joined(per_word)
        return cls(
            climbed(words), climbed(before), joined(endings), np.repeat(np.arange(len(per_word)), per_word), climbed_within(first, per_word), joined(counts),
        )

    def totalled(self) -> np.ndarray:
        return np.bincount(self.word, self.counts, len(self.words)).astype(np.int64)

    def taught(self) -> tuple[Range, np.ndarray]:
        """What training has of it, and each word's number there, -1 for one that training lacks."""
        known = self.totalled() > 0
        number = np.where(known, np.cumsum(known) - 1, -1)
        teaches = np.flatnonzero(self.counts)
        return Range(self.words[known], self.before, self.endings, number[self.word[teaches]], self.first[teaches], self.counts[teaches]), number


def at_root(held: np.ndarray, known: Totals, sample: int) -> np.ndarray:
    """The root's probability of words, of their customers less the discount of their tables."""
    fresh = (STRENGTH + known.discounts[2] * known.root_tables[sample]) / (known.words + 1)
    return (held + fresh) / (STRENGTH + known.root_customers[sample])


def seat(own: Range, totals: tuple, seats: list[Seating], known: Totals, sweeps: int, rng: np.random.Generator):
    """Sweeps over all customers: at words before, then endings, then the root. Tables that open or close on one level send or withdraw
    customers of the next. Yields after each sweep; ``seats`` are the three levels' and change."""
    _, before_tables, ending_customers, ending_tables = (t[-1] for t in totals)
    d, d_mid, d_root = known.discounts
    fresh_low = (STRENGTH + d * before_tables)[own.low_before]
    fresh_mid = (STRENGTH + d_mid * ending_tables)[own.mid_ending]
    among = (STRENGTH + ending_customers)[own.mid_ending]
    fresh_root = np.full(len(own.words), (STRENGTH + d_root * known.root_tables[-1]) / (known.words + 1))
    for _ in range(sweeps):
        low, mid, root = seats
        p = at_root(root.customers() - d_root * root.tables(), known, -1)[own.mid_word]
        p_mid = (mid.customers() - d_mid * mid.tables() + fresh_mid * p) / among
        seats[0] = low = sweep(low, fresh_low * p_mid[own.low_mid], d, rng)
        mid = mid.fit(np.bincount(own.low_mid, low.tables(), len(own.mid_codes)).astype(np.int64), fresh_mid * p, d_mid, rng)
        seats[1] = mid = sweep(mid, fresh_mid * p, d_mid, rng)
        root = root.fit(np.bincount(own.mid_word, mid.tables(), len(own.words)).astype(np.int64), fresh_root, d_root, rng)
        seats[2] = sweep(root, fresh_root, d_root, rng)
        yield


def chunk_messages(docs: DataFrame, range_bits: int, chunk_bytes: int) -> DataFrame:
    """Rows (part, kind, data): part -1 holds the documents of chunk ``kind`` as word numbers, the others the chunk's words, words before
    and counts of pairs by ranges of word hashes."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for nr, rows in enumerate(gathered_chunks(batches, most=chunk_bytes)):
            teaches = np.array([not h for h in rows.column("held_out").to_pylist()])
            c = Chunk.of(rows.column("text"), teaches)
            ids = rows.column("doc_id")
            sent = [(-1, pack(
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(ids.is_null().to_pylist(), np.uint8), teaches.astype(np.uint8),
                narrow(c.lengths), np.array([c.end]), planes(c.tokens),
            ))]
            word, before = np.divmod(c.pairs, len(c.hashes))
            parts = (c.hashes >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(c.hashes), np.int64)
            firsts_of = np.searchsorted(parts, np.arange((1 << range_bits) + 1))
            bounds = np.searchsorted(word, firsts_of).tolist()
            for part, (low, high, a, b) in enumerate(zip(firsts_of[:-1].tolist(), firsts_of[1:].tolist(), bounds[:-1], bounds[1:])):
                if a < b:
                    per_word = np.bincount(word[a:b] - low, minlength=high - low)
                    firsts, first = np.unique(before[a:b], return_inverse=True)
                    sent.append((part, pack(
                        steps(c.hashes[low:high]), planes(per_word), steps(c.hashes[firsts]), planes(c.endings[firsts]),
                        steps_within(first, per_word), planes(c.counts[a:b]),
                    )))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p for p, _ in sent], pa.int32()), "kind": pa.array([task + nr] * len(sent)), "data": pa.array([d for _, d in sent], pa.binary()),
            })

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(send, ROWS)


#: Rows that go to the ranges of words: kind is the number of a chunk (its pairs; later, which of the range's pairs they are), STATE (pairs and
#: their seating), SAMPLED (the tables of the samples), or ``-3 - r`` for totals from range r of restaurants.
ROWS = "part int, kind long, data binary"
STATE = -1
SAMPLED = -2
STATES = f"{ROWS}, totals binary, sums array<double>"


def states(part: int, kind: int, arrays: list[np.ndarray], totals: bytes, sums: list[float]) -> pa.Table:
    return pa.table({
        "part": pa.array([part], pa.int32()), "kind": pa.array([kind], pa.int64()), "data": pa.array([pack(*arrays)], pa.binary()),
        "totals": pa.array([totals], pa.binary()), "sums": pa.array([[float(x) for x in sums]]),
    })


def by_kind(group: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray], list[list[np.ndarray]], list[tuple[int, bytes]]]:
    """State, samples, totals in the order of their ranges, and messages of chunks."""
    rows = sorted(zip(group["kind"].to_pylist(), group["data"].to_pylist()), key=lambda r: -r[0])
    state, sampled = (next((unpack(d) for k, d in rows if k == kind), []) for kind in (STATE, SAMPLED))
    return state, sampled, [unpack(d) for k, d in rows if k < SAMPLED], [(k, d) for k, d in rows if k > STATE]


def summed(sums: DataFrame) -> list[float]:
    """The element-wise sum of an array column of fixed length."""
    rows = sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    return [r["sum"] for r in sorted(rows, key=lambda r: r["pos"])]


def once_and_twice(counts: np.ndarray) -> list[int]:
    return [(counts == 1).sum(), (counts == 2).sum()]


def merged(ranges: int):
    """One range of words from all chunks, counts added up, and for each chunk which of the range's pairs it has. The first sweeps
    are made at once, with the numbers of this range in place of all. The documents of a chunk, part -1, pass."""

    def merge(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        if part < 0:
            return with_nothing(group)
        pairs, held = range_of([unpack(v.as_py()) for v in group["data"]])
        asked = group.set_column(group.column_names.index("data"), "data", pa.array([pack(planes(np.diff(h, prepend=0))) for h in held], pa.binary()))
        packed, (own, _) = pairs.packed(), pairs.taught()
        del pairs, held, group
        ones, per_mid, per_word = np.ones(len(own.counts), np.int64), np.bincount(own.low_mid), np.bincount(own.mid_word)
        twos = [n for c in (own.counts, per_mid, per_word) for n in once_and_twice(c)]
        # Words are dealt by hash, so other ranges are like this one: root and endings are taken to have as many customers there.
        known = Totals(
            len(own.words) * ranges, int(own.counts.sum()) * ranges, discounts(twos), np.array([len(per_mid) * ranges]), np.array([len(own.words) * ranges]),
        )
        seats = [Seating.of(c, np.ones(len(c), np.int64)) for c in (own.counts, per_mid, per_word)]
        customers, tables, in_ending, of_ending = own.totals([own.columns([(ones, np.ones(len(per_mid), np.int64))])])
        local = (customers, tables, in_ending * ranges, of_ending * ranges)
        for _ in seat(own, local, seats, known, BURN_IN, np.random.default_rng([SEED, part])):
            pass
        state = states(
            part, STATE, [*packed, *[planes(a) for s in seats for a in (s.sizes, s.tables())]],
            pack(*own.columns([(seats[0].tables(), seats[1].tables())])),
            [len(own.words), own.counts.sum(), *twos, seats[2].customers().sum(), seats[2].tables().sum()],
        )
        return pa.concat_tables([state, with_nothing(asked)])

    return merge


def with_nothing(rows: pa.Table) -> pa.Table:
    """Rows that have no totals and no sums."""
    rows = rows.select(["part", "kind", "data"])
    return rows.append_column("totals", pa.nulls(len(rows), pa.binary())).append_column("sums", pa.array([[]] * len(rows), pa.list_(pa.float64())))


def range_of(messages: list[list[np.ndarray]]) -> tuple[Pairs, list[np.ndarray]]:
    """All pairs of a range, and which of them each message has."""
    listed = [(climbed(m[0]), climbed(m[2])) for m in messages]
    words = np.unique(np.concatenate([w for w, _ in listed]))
    before, nth = np.unique(np.concatenate([b for _, b in listed]), return_index=True)
    endings = np.concatenate([joined(m[3]) for m in messages])[nth]
    codes = []
    for (own, firsts), (_, per_word, _, _, first, _) in zip(listed, messages):
        per_word = joined(per_word)
        firsts = np.searchsorted(before, firsts)[climbed_within(first, per_word)]
        codes.append(np.repeat(np.searchsorted(words, own), per_word) * len(before) + firsts)
    ends = np.cumsum([len(c) for c in codes])
    codes, number = np.unique(np.concatenate(codes), return_inverse=True)
    counts = np.bincount(number, np.concatenate([joined(m[5]) for m in messages]), len(codes)).astype(np.int64)
    word, first = np.divmod(codes, len(before))
    return Pairs(words, before, endings, word, first, counts), np.split(number, ends[:-1])


def exchanged(state: DataFrame, range_bits: int) -> DataFrame:
    """The restaurants' numbers summed over all ranges of words, as rows for each of these. A row with pairs names its restaurants by them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, totals, pairs in zip(*[batch.column(c).to_pylist() for c in ("part", "totals", "pairs")]):
                columns = unpack(totals)
                if pairs is None:
                    ids = climbed(columns.pop(0))
                else:
                    _, before, endings, *_ = unpack(pairs)
                    ids, _ = restaurants(climbed(before), np.unique(joined(endings)))
                columns = [joined(c) for c in columns]
                ranges = (ids >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(ids), np.int64)
                bounds = np.searchsorted(ranges, np.arange((1 << range_bits) + 1))
                sent = [(r, a, b) for r, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if a < b]
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array([r for r, _, _ in sent], pa.int32()), "part": pa.array([part] * len(sent), pa.int32()),
                    "data": pa.array([pack(steps(ids[a:b]), *[planes(c[a:b]) for c in columns]) for _, a, b in sent], pa.binary()),
                })

    def add(group: pa.Table) -> pa.Table:
        messages = [[climbed(m[0]), *map(joined, m[1:])] for m in map(unpack, group["data"].to_pylist())]
        ids, at = np.unique(np.concatenate([m[0] for m in messages]), return_inverse=True)
        columns = [np.bincount(at, np.concatenate(c), len(ids)).astype(np.int64) for c in zip(*[m[1:] for m in messages])]
        ends = np.cumsum([len(m[0]) for m in messages]).tolist()
        replies = [pack(*[planes(c[at[a:b]]) for c in columns]) for a, b in zip([0, *ends], ends)]
        return pa.table({
            "part": group["part"], "kind": pa.array([-3 - group["range"][0].as_py()] * len(replies), pa.int64()), "data": pa.array(replies, pa.binary()),
        })

    rows = state.where("totals is not null").select("part", "totals", F.when(F.col("kind") == STATE, F.col("data")).alias("pairs"))
    return rows.mapInArrow(send, "range int, part int, data binary").groupBy("range").applyInArrow(add, ROWS)


def discount(once: float, twice: float) -> float:
    """The usual estimate from how many counts are one and two, kept within what is a discount."""
    return min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))


def discounts(twos: list[float]) -> tuple[float, float, float]:
    return tuple(discount(twos[i], twos[i + 1]) for i in (0, 2, 4))


def sampled(known: Totals):
    """Sweeps over a range from where its state left off, and what scoring needs of the samples."""

    def run(group: pa.Table) -> pa.Table:
        state, _, replies, _ = by_kind(group)
        (own, _), part = Pairs.of(*state[:6]).taught(), group["part"][0].as_py()
        seats = [Seating.of(*map(joined, state[i : i + 2])) for i in (6, 8, 10)]
        del state
        samples, root, kept = [], [], []
        sweeps = seat(own, own.totals(replies), seats, known, SETTLING + SAMPLES, np.random.default_rng([SEED, part, 1]))
        for nr, _ in enumerate(sweeps):
            if nr >= SETTLING:
                samples.append((seats[0].tables(), seats[1].tables()))
                kept += [planes(s.tables()) for s in seats]
                root += [seats[2].customers().sum(), seats[2].tables().sum()]
        return states(part, SAMPLED, kept, own.numbers(samples), root)

    return run


def looked_up(codes: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each wanted code's value, 0 where there is none; codes ascend."""
    if not len(codes):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, values[at], 0)


def log10_of(own: Range, totals: tuple, held: np.ndarray, mids: list, words: list, known: Totals, word: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 probability of words (numbers, -1 for one that training lacks) after words before (numbers), averaged over samples."""
    n, ends = max(len(own.before), 1), max(len(own.known_endings), 1)
    ending = own.ending_at[before]
    low_codes = own.low_word * n + own.low_before
    of_low, of_mid = np.where(word < 0, -1, word * n + before), np.where(word < 0, -1, word * ends + ending)
    d, d_mid, _ = known.discounts
    p = np.zeros(len(word))
    for s, (customers, tables, in_ending, of_ending) in enumerate(zip(*totals)):
        root = at_root(np.where(word < 0, 0, words[s][word]) if len(own.words) else np.zeros(len(word)), known, s)
        mid = (looked_up(own.mid_codes, of_mid, mids[s]) + (STRENGTH + d_mid * of_ending[ending]) * root) / (STRENGTH + in_ending[ending])
        p += (STRENGTH + d * tables[before]) * mid / (STRENGTH + customers[before]) / SAMPLES
    return np.log10(p + looked_up(low_codes, of_low, held) / (STRENGTH + totals[0][0][before]))


def answers(known: Totals):
    """For each chunk and a range of words: training counts of its words, log10 probabilities of its pairs."""

    def answer(group: pa.Table) -> pa.Table:
        state, sampled, replies, asked = by_kind(group)
        pairs, (d, d_mid, d_root) = Pairs.of(*state[:6]), known.discounts
        own, number = pairs.taught()
        tables = [joined(a) for a in sampled]
        tables = [tables[i : i + 3] for i in range(0, len(tables), 3)]
        held = sum(own.counts - d * low for low, _, _ in tables) / SAMPLES
        # Tables are the customers of the next level.
        mids = [np.bincount(own.low_mid, low, len(mid)) - d_mid * mid for low, mid, _ in tables]
        words = [np.bincount(own.mid_word, mid, len(root)) - d_root * root for _, mid, root in tables]
        del state, sampled, tables
        totals, totalled, out, logs = own.totals(replies), pairs.totalled(), [], np.empty(len(pairs.word), np.uint32)
        for low in range(0, len(logs), SCORED_TOGETHER):
            some = slice(low, low + SCORED_TOGETHER)
            logs[some] = np.rint(-STEPS * log10_of(own, totals, held, mids, words, known, number[pairs.word[some]], pairs.first[some]))
        for _, data in asked:
            at = np.cumsum(joined(unpack(data)[0]))
            word = pairs.word[at]
            out.append(pack(planes(totalled[word[np.flatnonzero(np.diff(word, prepend=-1))]]), planes(logs[at])))
        return pa.table({"chunk": pa.array([k for k, _ in asked], pa.int64()), "part": pa.array([group["part"][0].as_py()] * len(asked), pa.int32()), "reply": pa.array(out, pa.binary())})

    return answer


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored. Spark deletes the shuffle files that this took when it is done, by a session setting that is put back."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return stored(df, label)
    finally:
        conf.set(name, before)


def score_documents(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its log10 probability under the model.

    Text: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, then one end; null is the empty text, which is its end alone. The
    model learns from the documents that are not held out, and scores all. Columns: doc_id, held_out, n_tokens,
    n_known (tokens that training has), train_tokens, base_score (words alone, counts plus 0.1), score. A word
    that training lacks is the unknown word; after a word that training lacks, its ending decides, then the root.
    Probabilities are averaged over the samples; a token's log10 is rounded to
    a multiple of 2 ** -13. Words are told apart by 64 bits of hash. Repeated
    rows stay, and teach as often as they occur. An empty table gives no rows, and without training every score is 0.

    Every pair makes as many moves in a sweep as it has customers. While the ranges of words are seated side by side, restaurants count the tables of other ranges'
    words as they were at the last exchange (before the first: as this range would have them); seating is carried over it.

    Every chunk of ``chunk_bytes`` of text exchanges one message with every range of words, and ``range_bytes`` of text make a
    range. On very large tables raise both as far as a task's memory allows: messages are as many as chunks times ranges.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    range_bits = (size // range_bytes).bit_length()
    messages = chunk_messages(docs, range_bits, chunk_bytes)
    # Documents are a group for each chunk.
    merging = messages.groupBy("part", F.when(F.col("part") < 0, F.col("kind"))).applyInArrow(merged(1 << range_bits), STATES)
    state = written(merging, "word-counts")
    words, tokens, *twos, root_customers, root_tables = summed(state) or [0.0] * 10
    known = Totals(int(words), int(tokens), discounts(twos), np.array([root_customers]), np.array([root_tables]))
    pairs = state.select("part", "kind", "data").where("part >= 0")
    left = written(pairs.where(F.col("kind") == STATE).unionAll(exchanged(state, range_bits)).groupBy("part").applyInArrow(sampled(known), STATES), "samples")
    root = np.reshape(summed(left) or [0.0] * (2 * SAMPLES), (SAMPLES, 2))
    known = Totals(known.words, known.tokens, known.discounts, root[:, 0], root[:, 1])
    asked = pairs.unionAll(left.select("part", "kind", "data")).unionAll(exchanged(left, range_bits))
    replies = written(asked.groupBy("part").applyInArrow(answers(known), "chunk long, part int, reply binary"), "replies")

    def score(key: tuple, program: pa.Table, replies: pa.Table) -> pa.Table:
        ids, nameless, teaches, lengths, (end,), tokens = unpack(program["data"][0].as_py())
        tokens, n = joined(tokens), lengths.astype(np.int64)
        answered = [[joined(a) for a in unpack(v)] for v in replies.sort_by("part")["reply"].to_pylist()]
        own, logs = (np.concatenate(a) for a in zip(*answered))
        _, of = pairs_of(tokens, len(own), end)
        logs = logs / -STEPS
        base = np.log10((own + ADDED) / (known.tokens + ADDED * (known.words + 1)))
        starts = np.cumsum(n) - n
        return pa.table({
            "doc_id": pa.array(ids, mask=nameless.astype(bool)), "held_out": pa.array(teaches == 0), "n_tokens": pa.array(n),
            "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64)[tokens], starts)), "train_tokens": pa.array(np.full(len(n), known.tokens)),
            "base_score": pa.array(np.add.reduceat(base[tokens], starts)), "score": pa.array(np.add.reduceat(logs[of], starts)),
        })

    return (
        state.where("part < 0").select(F.col("kind").alias("chunk"), "data").groupBy("chunk").cogroup(replies.groupBy("chunk"))
        .applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
