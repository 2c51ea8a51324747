"""Periodic runs of words, found by block convolution at dyadic scales.

A run repeats with period q over at least LEAST words and ``times`` (3) periods, so what repeats at distance q spans two
periods and holds a whole aligned block of any size up to q. At scale B, B = 8, 16, 32 ..., every aligned block of B words is
sought in the words that follow at distances B to 2B - 1 (at the first scale 1 to 15): the sum of squared differences of word
numbers is sum t^2 + sum p^2 - 2 sum tp, whose last term is a cyclic correlation by a number-theoretic transform modulo
PRIME. Matrix products of residues stay below 2^53, so float64 holds them exactly. A sum of zero is an occurrence, its
distance a seed; a seed is extended both ways by comparing hashed stretches, and what comes out is compared word by word.
Occurrences inside a run of a smaller period repeat that period, so they are passed over; each stretch keeps its least period.

Texts lie end to end in stretches of about a MB, with a word of its own between two, and are treated in one task without a
shuffle; blocks are taken in batches, so memory follows the longest text.

Defined cases: a null text has no words and no runs; repeated rows each give a row; a null id stays null; other columns fall
away; a run may overlap others; nothing else than words (``[^\\x20\\x09-\\x0D]+``, unchanged) counts.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, FIRST = 24, 8
#: 7 * 2**20 + 1, of which 3 is a primitive root; residues take 23 bits, 64 products of two of them 52.
PRIME, ROOT = 7_340_033, 3
RADIX = 64
#: Longest block that is transformed (at larger scales it stands for the whole), and numbers per batch of transforms.
LONGEST, BATCH = 1 << 17, 1 << 20
CHUNK_WORDS = 1 << 17


def _mod(x: np.ndarray) -> np.ndarray:
    """Residues of exact integers below 2**53, in place."""
    x -= np.floor(x * (1.0 / PRIME)) * PRIME
    x[x < 0] += PRIME
    x[x >= PRIME] -= PRIME
    return x


@cache
def _dft(size: int, inverse: bool) -> np.ndarray:
    """The transform of ``size`` points as a matrix of residues."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.array([pow(root, k, PRIME) for k in range(size)], float)
    return powers[np.outer(np.arange(size), np.arange(size)) % size]


@cache
def _twiddles(rows: int, columns: int, inverse: bool) -> np.ndarray:
    size = rows * columns
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(size)
    step = 1
    while step < size:
        powers[step:2 * step] = _mod(powers[:step] * float(pow(root, step, PRIME)))[:size - step]
        step *= 2
    return powers[np.outer(np.arange(rows), np.arange(columns))]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row (a power of two long), without the factor 1/n of the inverse."""
    m, size = x.shape
    if size <= RADIX:
        return _mod(x @ _dft(size, inverse))
    rest = size // RADIX
    y = _mod(np.matmul(_dft(RADIX, inverse), x.reshape(m, RADIX, rest)))
    y = _mod(y * _twiddles(RADIX, rest, inverse))
    y = transform(y.reshape(m * RADIX, rest), inverse).reshape(m, RADIX, rest)
    return np.ascontiguousarray(y.transpose(0, 2, 1)).reshape(m, size)


def occurrences(numbers: np.ndarray, squares: np.ndarray, blocks: np.ndarray, size: int, near: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``blocks`` and distances in [near, near + count) at which the block of ``size`` words stands again.

    ``numbers`` are residues as floats, ``squares`` prefix sums of their squares modulo PRIME, whole numbers. A window that
    runs over the end of ``numbers`` is filled up with a residue of its own.
    """
    width = 1
    while width < count + size - 1:
        width *= 2
    padded = np.concatenate((numbers, np.full(near + width, float(PRIME - 1))))
    more = np.cumsum(np.append(0, np.full(near + width, pow(PRIME - 1, 2, PRIME), np.int64)))
    squares = np.concatenate((squares, squares[-1] + more[1:]))
    scale, at, distance = float(pow(width, -1, PRIME)), [], []
    step = max(1, BATCH // width)
    for lo in range(0, len(blocks), step):
        start = blocks[lo:lo + step]
        pattern = np.zeros((len(start), width))
        pattern[:, (-np.arange(size)) % width] = padded[start[:, None] + np.arange(size)]
        window = padded[(start + near)[:, None] + np.arange(width)]
        product = _mod(transform(pattern) * transform(window))
        both = _mod(transform(product, True)[:, :count] * scale)
        from_ = (start + near)[:, None] + np.arange(count)
        apart = squares[from_ + size] - squares[from_] + (squares[start + size] - squares[start])[:, None]
        row, column = np.nonzero((apart - 2 * both.astype(np.int64)) % PRIME == 0)
        at.append(start[row])
        distance.append(near + column)
    return np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.int64), *distance])


class Stretches:
    """Equality of stretches of a sequence by prefix sums of powers modulo two primes."""

    PRIMES = (2_147_483_629, 2_147_483_587)

    def __init__(self, numbers: np.ndarray):
        draw = np.random.default_rng()
        self.held = []
        for prime in self.PRIMES:
            base = int(draw.integers(1 << 20, prime - 1))
            powers = np.ones(len(numbers) + 1, np.uint64)
            step = 1
            while step < len(powers):
                powers[step:2 * step] = (powers[:step] * np.uint64(pow(base, step, prime)) % np.uint64(prime))[:len(powers) - step]
                step *= 2
            terms = (numbers.astype(np.uint64) + np.uint64(1)) % np.uint64(prime) * powers[:-1] % np.uint64(prime)
            self.held.append((np.uint64(prime), powers, np.append(np.uint64(0), np.cumsum(terms) % np.uint64(prime))))

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` symbols from ``a`` are those from ``b`` (``a`` < ``b``)."""
        same = np.ones(len(a), bool)
        for prime, powers, sums in self.held:
            one = (sums[a + size] + prime - sums[a]) % prime * powers[b - a] % prime
            same &= one == (sums[b + size] + prime - sums[b]) % prime
        return same

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """Symbols, ``most`` at most, that follow (or precede) both ``a`` and ``b`` alike."""
        sure, step = np.zeros(len(a), np.int64), 1
        while step <= most.max(initial=0):
            step *= 2
        while step:
            fits = sure + step <= most
            size = np.where(fits, step, 0)
            shift = sure if forward else -(sure + size)
            sure += np.where(fits & self.equal(a + shift, b + shift, size), step, 0)
            step //= 2
        return sure


def _extended(numbers: np.ndarray, place: np.ndarray, distance: np.ndarray, size: int, hashed: Stretches):
    """The whole stretches of period ``distance`` around seeds: start and end, neighbouring seeds of one distance once."""
    order = np.lexsort((place, distance))
    place, distance = place[order], distance[order]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(distance) != 0) | (np.diff(place) != size)
    place, distance = place[new], distance[new]
    left = hashed.reach(place, place + distance, place, False)
    right = hashed.reach(place, place + distance, len(numbers) - place - distance, True)
    found = np.unique(np.stack((place - left, place + distance + right, distance), 1), axis=0)
    long = (found[:, 1] - found[:, 0] >= LEAST) & (found[:, 1] - found[:, 0] >= 3 * found[:, 2])
    return found[long]


def _exact(numbers: np.ndarray, start: int, end: int, period: int) -> bool:
    same = np.array_equal(numbers[start:end - period], numbers[start + period:end])
    before = start == 0 or numbers[start - 1] != numbers[start - 1 + period]
    return same and before and (end == len(numbers) or numbers[end] != numbers[end - period])


def runs(numbers: np.ndarray, ends: np.ndarray, times: int = 3) -> np.ndarray:
    """start, end and least period of all runs in ``numbers``, whose texts end at ``ends`` in a number of their own."""
    residues = (numbers % PRIME).astype(float)
    squares = np.append(0, np.cumsum(_mod(residues * residues).astype(np.int64)))
    starts = np.append(0, ends[:-1] + 1)
    longest = int((ends - starts).max(initial=0))
    text = np.searchsorted(ends, np.arange(len(numbers) + 1), "left")
    hashed, found, scale = None, np.zeros((0, 3), np.int64), FIRST
    while times * (1 if scale == FIRST else scale) <= longest and longest >= LEAST:
        near, far = (1 if scale == FIRST else scale), 2 * scale
        size = min(scale, LONGEST)
        blocks = np.arange(0, len(numbers) - size, scale)
        end = ends[text[blocks]]
        enough = (end - starts[text[blocks]] >= max(LEAST, times * near)) & (blocks + size + near <= end)
        blocks = blocks[enough]
        seeds = [occurrences(residues, squares, blocks, size, lo, min(size if scale > FIRST else far - near, far - lo)) for lo in range(near, far, size if scale > FIRST else far)]
        place, distance = (np.concatenate(s) for s in zip(*seeds))
        inside = place + distance + size <= ends[text[place]]
        known = found[found[:, 2] <= size]
        if len(known):
            known = known[np.argsort(known[:, 0], kind="stable")]
            reach = np.maximum.accumulate(known[:, 1])
            last = np.searchsorted(known[:, 0], place, "right") - 1
            inside &= (last < 0) | (reach[last] < place + distance + size)
        place, distance = place[inside], distance[inside]
        if len(place):
            hashed = hashed or Stretches(numbers)
            more = _extended(numbers, place, distance, size, hashed)
            if not all(_exact(numbers, *map(int, r)) for r in more):
                return runs(numbers, ends, times)  # two stretches had one hash: draw other bases
            found = np.concatenate((found, more))
        scale *= 2
    order = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
    found = found[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    return found[first]


def _texts(texts: list[bytes]):
    """Word lists in groups of about ``CHUNK_WORDS`` words."""
    group, n = [], 0
    for text in texts:
        group.append(text.split())
        n += len(group[-1])
        if n >= CHUNK_WORDS:
            yield group
            group, n = [], 0
    if group:
        yield group


def text_runs(texts: list[bytes]):
    """Per text: number of words, its runs (start, length, period by start, then period) and its words outside repeats."""
    for group in _texts(texts):
        table: dict[bytes, int] = {}
        sizes = np.array([len(words) for words in group])
        ends = np.cumsum(sizes + 1) - 1
        numbers = np.empty(int(ends[-1]) + 1, np.int64)
        lo = 0
        for words in group:
            numbers[lo:lo + len(words)] = [table.setdefault(w, len(table)) for w in words]
            lo += len(words) + 1
        numbers[ends] = len(table) + np.arange(len(group))
        found = runs(numbers, ends)
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        cut = np.searchsorted(found[:, 0], np.append(0, ends))
        for k, words in enumerate(group):
            own = found[cut[k]:cut[k + 1]] - [[ends[k] - sizes[k]] * 2 + [0]]
            kept = words
            if len(own):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, own[:, 0] + own[:, 2], 1)
                np.add.at(edge, own[:, 1], -1)
                kept = [w for w, held in zip(words, np.cumsum(edge[:-1]).tolist()) if not held]
            yield len(words), np.stack((own[:, 0], own[:, 1] - own[:, 0], own[:, 2]), 1), b" ".join(kept)


RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words) and collapsed (the text without its repeats) of each row."""

    def find(batches):
        for batch in batches:
            held = list(text_runs(batch.column("text").cast(pa.large_binary()).to_pylist()))
            found = np.concatenate([np.zeros((0, 3), np.int64), *(h[1] for h in held)])
            cuts = np.cumsum([0, *(len(h[1]) for h in held)], dtype=np.int32)
            fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in range(3)], ["start", "length", "period"])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array([h[0] for h in held], pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(cuts), fields), "collapsed": pa.array([h[2] for h in held], pa.binary()).cast(pa.string()),
            })

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; one id in ten (by its checksum) gets a text that repeats from some word on."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.array_remove(F.split("text", r"[ \t-\r]+"), "")
    some = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g"))
    some = some.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    some = some.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    from_ = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    repeated = F.array_join(F.transform("w", lambda w, i: F.when(i >= F.col("a"), F.get("w", from_(i))).otherwise(w)), " ")
    return some.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def _greatest(runs: Column) -> Column:
    """The run with the greatest length / period, then the smallest start, then the smallest period."""

    def better(a: Column, b: Column) -> Column:
        one, other = a["length"].cast("decimal(38,0)") * b["period"], b["length"].cast("decimal(38,0)") * a["period"]
        return F.when(a.isNull() | (other > one), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def query(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))).withColumn("best", _greatest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
