"""Periodic runs of words, by enumeration of maximal pairs over the LCP-interval tree.

A run with period q is a stretch in which words q apart are identical. Its start i and i + q form a maximal pair: the words
before them differ (or there is none), and so do the words where their common beginning of L words ends. The other way
round, a maximal pair of distance q with L + q >= max(6, 4 q) is a run of length L + q. So the runs are read off
the pairs, and nothing has to be extended.

The pairs come from the tree of LCP intervals of the sorted suffixes, built bottom-up. A node keeps the places
of its suffixes in lists, one for each word to the left; children are merged from small to large, and a place looks
for partners in lists of other words, at most L // 3 words away. Occurrences of a stretch that lie so close
to each other are in steps of its period, and all but the first of such a series follow the same word; so only the two
ends of the window can name a list with partners, and a text of n words costs about n log n steps whatever repeats in it.

Suffixes whose first five words occur once in their text are in no pair that can be a run (L is at least 5), and stay
out of the sort. That is decided for many texts at once; a collision of hashes only leaves more suffixes in it.

Defined cases: a null or empty text has no words, no runs, and the hashes of empty strings. Rows that repeat an id are
taken each by themselves. Of pairs with the same stretch the smallest period counts. An empty table gives an empty
result. Other columns are dropped, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from circlet.llm.common import lean_worker, small_batches

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
SEED_WORDS = 5  # least common beginning of a pair that is a run: 6 words with period 1
BATCH_WORDS = 1 << 18
Run = tuple[int, int, int]  # start, length, period
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _repeated(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places whose five words occur again in the same text (as hashes)."""
    n = len(codes) - SEED_WORDS + 1
    if n < 2:
        return np.zeros(0, dtype=np.int64)
    c = codes.astype(np.uint64) + np.uint64(1)
    h = owner[:n].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    for k in range(SEED_WORDS):
        x = c[k : k + n] * _ODD[k]
        h += x ^ (x >> np.uint64(29))
    h[owner[:n] != owner[SEED_WORDS - 1 :]] = 0  # reaches into the next text
    order = np.argsort(h)
    s = h[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.flatnonzero(twice & (h != 0))


def _sorted_suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of a sequence, and the common beginning of each with the one before it.

    Ranks of stretches of 1, 2, 4, ... words, until all differ (the sequence must end stretches with unique numbers).
    The kept ranks then give every common beginning by halving steps.
    """
    _, rank = np.unique(words, return_inverse=True)
    m, levels, step = len(words), [], 1
    while True:
        levels.append(rank.astype(np.int32))
        if rank.max(initial=-1) + 1 >= m:
            break
        after = np.full(m, 0, dtype=np.int64)
        after[: max(0, m - step)] = rank[step:] + 1 if step < m else 0
        _, rank = np.unique(rank.astype(np.int64) * (m + 1) + after, return_inverse=True)
        step *= 2
    order = np.argsort(rank)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, m - 1), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < m) & (b < m)
        ranks = levels[k]
        same = inside & (ranks[np.minimum(a, m - 1)] == ranks[np.minimum(b, m - 1)])
        grown = np.where(same, 1 << k, 0)
        common += grown
        a += grown
        b += grown
    return order, common


class _Node:
    """An LCP interval: the places of its suffixes, and the same places by the word to their left."""

    __slots__ = ("size", "places", "classes")

    def __init__(self, size: int, place: int, left: int):
        self.size, self.places, self.classes = size, [place], {left: [place]}


def _join(big: _Node, small: _Node, window: int, left: list[int], found: list[tuple[int, int, int]], size: int) -> _Node:
    """Merges two children of an interval of ``size`` common words and adds the maximal pairs between them."""
    if len(big.places) < len(small.places):
        big, small = small, big
    places, classes = big.places, big.classes
    for x in small.places:
        low = bisect_left(places, x - window)
        high = bisect_right(places, x + window, low) - 1
        if low <= high:  # the lists of the window's ends are the only ones that can hold partners
            own = left[x]
            for word in {left[places[low]], left[places[high]]}:
                if word != own:
                    near = classes[word]
                    for y in near[bisect_left(near, x - window) : bisect_right(near, x + window)]:
                        found.append((x, y, size) if x < y else (y, x, size))
    for x in small.places:
        insort(places, x)
    for word, some in small.classes.items():
        mine = classes.get(word)
        if mine is None:
            classes[word] = some
        else:
            for x in some:
                insort(mine, x)
    return big


def maximal_pairs(order: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(i, j, L) of all maximal pairs with L >= 5 and j - i <= L // 3, bottom-up over the LCP intervals."""
    found: list[tuple[int, int, int]] = []
    stack: list[_Node] = []
    n = len(order)
    for i in range(n):
        size = common[i] if i + 1 < n else 0  # with the next suffix
        node = _Node(size, order[i], left[order[i]])
        while stack and stack[-1].size > size:  # intervals that end here
            top = stack.pop()
            node = _join(top, node, top.size // (LEAST_EXPONENT - 1), left, found, top.size)
        if size < SEED_WORDS:  # the next suffix belongs to another tree
            stack.clear()
            continue
        if stack and stack[-1].size == size:
            node = _join(stack.pop(), node, size // (LEAST_EXPONENT - 1), left, found, size)
        node.size = size
        stack.append(node)
    return found


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """Runs (start, length, period) of each sequence of word numbers, by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    codes = np.concatenate(texts).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    active = _repeated(codes, owner)
    if not len(active):
        return out
    # stretches of active places, with the words that their last five-word beginnings can still differ by
    cover = np.zeros(len(codes) + SEED_WORDS + 2, dtype=np.int64)
    np.add.at(cover, active, 1)
    np.add.at(cover, active + SEED_WORDS + 1, -1)
    inside = np.cumsum(cover)[: len(codes)] > 0
    place = np.flatnonzero(inside)
    ends = np.append((np.diff(place) > 1) | (np.diff(owner[place]) > 0), True)
    # a number that occurs once stands after each stretch; texts never share numbers
    width = int(codes.max()) + 1
    slots = np.arange(len(place)) + np.concatenate([[0], np.cumsum(ends)[:-1]])
    sequence = np.empty(len(place) + int(ends.sum()), dtype=np.int64)
    where = np.full(len(sequence), -1, dtype=np.int64)
    sequence[slots] = owner[place] * width + codes[place]
    sequence[slots[ends] + 1] = len(texts) * width + np.arange(int(ends.sum()))
    where[slots] = place
    order, common = _sorted_suffixes(sequence)
    # only intervals of five common words and more have pairs: cut the order into their groups
    linked = common >= SEED_WORDS
    member = np.zeros(len(order), dtype=bool)
    member[:-1] |= linked
    member[1:] |= linked
    kept = np.flatnonzero(member)
    shared = np.append(common, 0)[kept]
    shared[shared < SEED_WORDS] = 0
    places = where[order[kept]]
    left = np.full(len(codes), -1, dtype=np.int64)
    left[1:] = codes[:-1]
    left[first[sizes > 0]] = -1
    names = dict(zip(places.tolist(), left[places].tolist()))
    best: dict[tuple[int, int], int] = {}
    for i, j, size in maximal_pairs(places.tolist(), shared.tolist(), names):
        q, end = j - i, j + size
        if size + q >= max(LEAST_LENGTH, LEAST_EXPONENT * q) and q < best.get((i, end), 1 << 62):
            best[i, end] = q
    starts, texts_of = first.tolist(), owner
    for (i, end), q in sorted(best.items()):
        d = int(texts_of[i])
        out[d].append((i - starts[d], end - i, q))
    for row in out:
        row.sort(key=lambda r: (r[0], r[2]))
    return out


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes split at just space and 9 to 13


def strongest(runs: list[Run]) -> Run | None:
    """Greatest length / period, exactly; then the smallest start, then the smallest period."""
    best = None
    for run in runs:
        if best is None or (run[1] * best[2], -run[0], -run[2]) > (best[1] * run[2], -best[0], -best[2]):
            best = run
    return best


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without what runs repeat after their first period."""
    if not runs:
        return b" ".join(words)
    change = [0] * (len(words) + 1)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept, depth = [], 0
    for word, step in zip(words, change):
        depth += step
        if not depth:
            kept.append(word)
    return b" ".join(kept)


def crc_period(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The edit of the query: one id in ten gets a periodic end. A null id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


SCHEMA = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", edit: Callable[[object, list[bytes]], list[bytes]] | None = None, with_text: bool = False) -> DataFrame:
    """For every document its runs, the strongest of them, and hashes of the runs and of the text without repeats.

    ``edit`` maps (id, words) to other words first. ``with_text`` adds the collapsed text itself.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(SCHEMA).fields, *[T.StructField("collapsed_text", T.StringType())] * with_text])
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def solve(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        coded = [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
        out = []
        for doc_id, words, runs in zip(ids, texts, runs_of(coded)):
            top = strongest(runs)
            short = collapse(words, runs)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            numbers = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
            row = (doc_id, len(words), len(runs), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(short).hexdigest(), [dict(zip(("start", "length", "period"), r)) for r in runs])
            out.append((*row, short.decode("utf-8", "replace")) if with_text else row)
        columns = zip(*out) if out else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, arrow)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            ids, texts, total = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = split_words(text.as_py())
                words = edit(doc_id.as_py(), words) if edit else words
                ids.append(doc_id.as_py())
                texts.append(words)
                total += len(words)
                if total >= BATCH_WORDS:
                    yield solve(ids, texts)
                    ids, texts, total = [], [], 0
            if ids:
                yield solve(ids, texts)

    with small_batches(docs.sparkSession):
        return rows.mapInArrow(run, schema)
