"""Language-model scores by online logistic context mixing.

A text is a sequence of words (A-Z lower-cased) and one end.  A word of the
vocabulary is a symbol with a Huffman code; any other word is an escape and
its bytes, each with a code chosen by the byte before.  So a text is a
sequence of binary decisions.  A decision is predicted by hashed contexts, a
short history (the last very common word, or the last two bytes of a spelled
word) and a long one (the last word, or the last four bytes), each smoothed
towards the next shorter one and at last towards the code tree's own weights.
The predictions of both histories and of the tree are mixed in the logistic
domain with weights that a gate chooses (by the confidence of the two
histories) and that learn online while the text is read; an adaptive map then
refines the mixed probability.  The words of a text and the letters of its
spelled words are two streams, each with mixing weights and a map of its own,
which start from the same constants and run from the stream's first decision
to its last.  The negative logarithms add up to the text's total
bits, with bits per byte beside them.  Texts are computed side by side;
weights learn in steps of ``STEP``.

What is learnt grows with the training texts.  The vocabulary is every word
that occurs ``LEAST_COUNT`` times (Spark counts words; what is broadcast is a
hash and a tree node of each), the very common words are its square root, and
a context is counted exactly, in no table of a fixed size.  What is counted,
sent and asked for are pairs of a history and a word (or letter), not the ten
or so decisions of each: words are numbered in the order of the code tree's
leaves, so a node is a range of them, and a decision's counts are sums over
ranges of a history's pairs.  The pairs are dealt over shards by history: a
batch of texts sends each of its pairs once, with its count in the texts to
learn from; a shard sums them and answers, level by level down the tree, how
much of a node's count goes another way, until only the pair itself is counted.
A short history is followed by
nearly all words, so its top levels and each subtree below them are dealt
apart.  Counts of the words beyond the vocabulary are met by an equi-join, so
the base score is exact.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, spool

# Rarer training words are spelled, so that spelling and escapes are learnt from words as rare as unknown ones.
LEAST_COUNT = 3
WORD_BYTES = 64
# Weight of the shorter context in the smoothing of the short and the long history.
SHORT_PRIOR, LONG_PRIOR = 8.0, 4.0
STEP = 32
GATES = 16
LEVELS = 24  # of the adaptive map
RATE, MAP_RATE = 0.004, 0.02
# Bytes of text whose words are counted at once, that ask for pairs together, and that are mixed at once; asked pairs a task answers at once.
FLUSH, BATCH, MIXED, ASKS = 1 << 24, 1 << 22, 1 << 21, 200_000
# Levels of the code tree that are dealt by short history alone.
CROWN = 8
# Kinds of pairs: a short history's top levels and subtrees, a long history of words; both histories of letters.
TOP, BELOW, LONG, NEAR, FAR = range(5)
WORD_BITS, LETTER_BITS, KIND_BITS = 30, 8, 61
# The byte before a spelled word's first.
START = 256


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and how many each text has; the same words as those of ``words_of``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends of a text leave empty ones
    return flat.filter(some).cast(pa.binary()), np.bincount(parent.filter(some).to_numpy(), minlength=len(texts))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end of a text is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in together(batches, FLUSH):
            words, _ = split_words(held.column(0))
            found = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])
            yield pa.RecordBatch.from_pydict({"word": pa.array([b""], pa.binary()), "n": pa.array([held.num_rows], pa.int64())})

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches with a column ``text`` put together until their texts have ``size`` bytes."""
    held, have = [], 0
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        done = 0
        if batch.num_rows:
            # A batch of Spark's may hold far more; it is cut between texts.
            ends = np.cumsum(pc.binary_length(text).to_numpy())
            while done < batch.num_rows:
                gone = int(ends[done - 1]) if done else 0
                upto = min(batch.num_rows, 1 + int(np.searchsorted(ends, gone + size - have)))
                held.append(batch.slice(done, upto - done))
                have, done = have + int(ends[upto - 1]) - gone, upto
                if have >= size:
                    yield pa.concat_batches(held)
                    held, have = [], 0
    if held:
        yield pa.concat_batches(held)


def spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words, each word ended by a line feed (which no word
    holds), and the place of every byte in its word."""
    letters = np.frombuffer(b"\n".join(words) + b"\n" if words else b"", np.uint8).astype(np.int64)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    return letters, np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def before(letters: np.ndarray, inside: np.ndarray, k: int, at_start: int) -> np.ndarray:
    """The byte ``k`` places before each byte of its word."""
    moved = np.full(len(letters), at_start, np.int64)
    moved[k:] = letters[: max(0, len(letters) - k)]
    return np.where(inside >= k, moved, at_start)


def count_bytes(words: DataFrame) -> np.ndarray:
    """Counts (byte before, byte) over the spelled words (word, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((START + 1) * 256)
        for batch in batches:
            own = batch.column(0).to_pylist()
            letters, inside = spelling(own)
            n = np.repeat(batch.column(1).to_numpy(), [len(w) + 1 for w in own])
            total += np.bincount(before(letters, inside, 1, START) * 256 + letters, weights=n, minlength=len(total))
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pair, "n": total[pair].astype(np.int64)})

    summed = words.select("word", "n").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros((START + 1) * 256, np.int64)
    for r in summed.collect():  # at most 257 * 256 rows
        out[r["pair"]] = r["n"]
    return out.reshape(START + 1, 256)


class Codes:
    """Binary codes of many symbols in flat arrays: symbol s has the
    decisions ``first[s]`` to ``first[s] + length[s]``, each with its node,
    bit and the share of bit 1 at the node."""

    def __init__(self, length: np.ndarray, node: np.ndarray, bit: np.ndarray, share: np.ndarray):
        self.length, self.first = length, np.cumsum(length) - length
        self.node, self.bit, self.share = node.astype(np.uint32), bit.astype(np.uint8), share.astype(np.float32)

    def decisions(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all decisions of the symbols, and how many each has."""
        count = self.length[symbols]
        starts = self.first[symbols] - (np.cumsum(count) - count)
        return np.arange(int(count.sum()), dtype=np.int32) + np.repeat(starts.astype(np.int32), count), count


def huffman(weights: list[int]) -> Codes:
    """Huffman codes; nodes are numbered by rising weight."""
    return letter_tree(weights)[0]


def letter_tree(weights: list[int]) -> tuple[Codes, np.ndarray, np.ndarray]:
    """Huffman codes of few symbols, the leaves from left to right, and of all nodes the rank of the first leaf on side 1."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    up, side, share = np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.uint8), np.zeros(max(1, n - 1))
    for node in range(n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        up[i] = up[j] = node
        side[j] = 1
        share[node] = b / (a + b)
        heapq.heappush(heap, (a + b, n + node))
    leaf, middle, _ = leaf_ranks(up, side)
    return climb(up, side, share, np.arange(n)), leaf, middle


def code_tree(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree of many symbols: of all leaves and nodes the node above and the side, of the nodes the share of bit 1."""
    n = len(weights)
    order = np.argsort(weights, kind="stable")
    leaves, joined = weights[order].tolist(), []
    up, side, share = np.full(2 * n - 1, -1, np.int32), np.zeros(2 * n - 1, np.uint8), np.zeros(max(1, n - 1), np.float32)
    i = j = 0
    for node in range(n - 1):
        pair = []
        for bit in (0, 1):
            if j == len(joined) or i < n and leaves[i] <= joined[j]:
                at, w = order[i], leaves[i]
                i += 1
            else:
                at, w = n + j, joined[j]
                j += 1
            up[at], side[at] = node, bit
            pair.append(w)
        joined.append(pair[0] + pair[1])
        share[node] = pair[1] / joined[-1]
    return up, side, share


def climb(up: np.ndarray, side: np.ndarray, share: np.ndarray, symbols: np.ndarray) -> Codes:
    """Codes of the symbols in the order given."""
    n = (len(up) + 1) // 2
    # All symbols climb to the root together; a step is one decision of each that is still below it.
    at, length, climbed = np.array(symbols, np.int64), np.zeros(len(symbols), np.int64), []
    going = np.flatnonzero(up[at] >= 0)
    while len(going):
        climbed.append((going, up[at[going]], side[at[going]]))
        at[going] = n + up[at[going]]
        length[going] += 1
        going = going[up[at[going]] >= 0]
    last = np.cumsum(length) - 1
    node, bit = np.empty(int(length.sum()), np.int64), np.empty(int(length.sum()), np.uint8)
    for step, (symbols, nodes, bits) in enumerate(climbed):
        node[last[symbols] - step], bit[last[symbols] - step] = nodes, bits
    return Codes(length, node, bit, share[node])


def digests(words: list[bytes]) -> np.ndarray:
    """64-bit hashes by which words are looked up."""
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words), np.uint64)


def leaf_ranks(up: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a code tree: its leaves from left (bit 0) to right, of all nodes the
    rank of the first leaf on side 1, and of all ranks the number of the
    subtree below the ``CROWN`` top levels (or of a leaf among them)."""
    n = (len(up) + 1) // 2
    # Codes are shorter than 64 bits: a longer one takes more than 10**13 words.
    code, length, at = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.arange(n)
    going = np.flatnonzero(up[at] >= 0)
    while len(going):
        code[going] |= side[at[going]].astype(np.uint64) << length[going]
        length[going] += np.uint64(1)
        at[going] = n + up[at[going]]
        going = going[up[at[going]] >= 0]
    # From the left, as the leaves stand.
    code <<= np.where(length > 0, np.uint64(64) - length, np.uint64(0))
    leaf = np.argsort(code)
    rank = np.empty(n, np.int64)
    rank[leaf] = np.arange(n)
    middle, at = np.full(max(1, n - 1), n, np.int32), np.arange(n)
    going = np.flatnonzero(up[at] >= 0)
    while len(going):
        right = going[side[at[going]] > 0]
        np.minimum.at(middle, up[at[right]], rank[right].astype(np.int32))
        at[going] = n + up[at[going]]
        going = going[up[at[going]] >= 0]
    return leaf.astype(np.int32), middle, np.cumsum(np.diff(code[leaf] >> np.uint64(64 - CROWN), prepend=np.uint64(0)) > 0).astype(np.int32)


def pair_keys(kind: int, history: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Exact keys of (kind, history, rank of the word or letter), which sort in this order."""
    bits = WORD_BITS if kind < NEAR else LETTER_BITS
    return np.uint64(kind << KIND_BITS) | history.astype(np.uint64) << np.uint64(bits) | rank.astype(np.uint64)


def spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first key that a key's history can have, and how many it can have."""
    bits = np.where(keys < np.uint64(NEAR << KIND_BITS), np.uint64(WORD_BITS), np.uint64(LETTER_BITS))
    return keys >> bits << bits, np.uint64(1) << bits


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its keys) of every shard that has any; a history's keys share one."""
    mixed = spans(keys)[0] * np.uint64(0x9E3779B97F4A7C15)
    shard = ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.min_scalar_type(shards))
    order = np.argsort(shard, kind="stable")
    bounds = np.flatnonzero(np.diff(shard[order].astype(np.int64), prepend=-1))
    for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), len(keys)], strict=True):
        yield int(shard[order[lo]]), order[lo:hi]


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes, each with its length; keys (unsigned) as differences."""
    cut = [np.diff(x, prepend=np.uint64(0)) if x.dtype == np.uint64 else x.astype(np.min_scalar_type(x.max(initial=0))) for x in arrays]
    # The bytes of a kind stand together: the higher ones are nearly all zero.
    data = [x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in cut]
    kinds = "".join(f"{'K' if y.dtype == np.uint64 else x.dtype.char}{len(x)}," for x, y in zip(cut, arrays, strict=True))
    return zstandard.ZstdCompressor(level=3).compress(kinds.encode() + b" " + b"".join(data))


def unpacked(payload: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    lo = data.index(b" ") + 1
    out = []
    for kind in data[: lo - 1].decode().split(",")[:-1]:
        n, dtype = int(kind[1:]), np.dtype(np.uint64 if kind[0] == "K" else kind[0])
        values = np.frombuffer(data, np.uint8, dtype.itemsize * n, lo).reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(-1)
        out.append(np.cumsum(values, dtype=np.uint64) if kind[0] == "K" else values)
        lo += dtype.itemsize * n
    return out


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys of (keys, counts) with the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")  # runs that are sorted already are merged
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    if not len(first):
        return keys, np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(np.concatenate([n for _, n in parts])[order].astype(np.int64), first)


class Coder:
    """Turns texts into decisions with their contexts; the same in learning and scoring."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, escapes: int, byte_counts: np.ndarray):
        """Words are given by their digests, the most frequent first."""
        self.order = np.argsort(words).astype(np.int32)
        self.digests = words[self.order]
        self.escape = len(words)
        self.common = max(64, math.isqrt(len(words)))
        self.tree = code_tree(np.append(counts, escapes) + 1)
        self.leaf, self.middle, self.subtree = leaf_ranks(*self.tree[:2])
        self.top = np.flatnonzero(np.diff(self.subtree, prepend=-1))  # the first rank of every subtree
        self.rank = np.empty(len(self.leaf), np.int32)
        self.rank[self.leaf] = np.arange(len(self.leaf))
        trees = [letter_tree((weights * 16 + 1).tolist()) for weights in byte_counts]
        some = [t for t, *_ in trees]
        self.letters = Codes(
            np.concatenate([t.length for t in some]),
            np.concatenate([t.node + np.uint32(255 * i) for i, t in enumerate(some)]),
            np.concatenate([t.bit for t in some]),
            np.concatenate([t.share for t in some]),
        )
        self.letter_leaf = np.concatenate([leaf for _, leaf, _ in trees])
        self.letter_rank = np.concatenate([np.argsort(leaf) for _, leaf, _ in trees])
        self.letter_middle = np.concatenate([middle for *_, middle in trees])[self.letters.node]

    def tokens(self, texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """Of texts given by their words what ``histories`` returns."""
        flat = pa.array([w for words in texts for w in words], pa.binary())
        return self.histories(*self.numbered(flat, np.array([len(words) for words in texts], np.int64)))

    def numbered(self, flat: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Word ids of texts, of which text i has ``sizes[i]`` words, with their ends; the sizes with these; and the words to spell."""
        coded = flat.dictionary_encode()
        asked = digests([*coded.dictionary.to_pylist(), b""])
        spot = np.minimum(np.searchsorted(self.digests, asked), len(self.digests) - 1)
        known = np.where(self.digests[spot] == asked, self.order[spot], self.escape).astype(np.int64)
        words = known[coded.indices.to_numpy()]
        sizes = sizes + 1
        ids = np.full(int(sizes.sum()), known[-1])
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(sizes) - 1] = False
        ids[inside] = words
        return ids, sizes, flat.take(pa.array(np.flatnonzero(words == self.escape))).to_pylist()

    def histories(self, ids: np.ndarray, sizes: np.ndarray, spelled: list[bytes]) -> tuple[np.ndarray, ...]:
        """Word ids with their histories (last very common word, last word)
        and text numbers; the words to spell, and their texts."""
        text = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(ids))
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        # The last place before this one with a very common word, if in the same text.
        common = np.maximum.accumulate(np.concatenate(([-1], np.where(ids < self.common, place, -1)[:-1])))
        short = np.where(common >= start, ids[np.maximum(common, 0)], self.escape + 1)
        long = np.where(place > start, np.concatenate(([0], ids[:-1])), self.escape + 1)
        return ids, short, long, text, spelled, text[ids == self.escape]

    def letter_pairs(self, spelled: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Of all spelled words: every letter's symbol, its keys for both histories, and its word."""
        letters, inside = spelling(spelled)
        one = before(letters, inside, 1, START)
        two, three, four = (before(letters, inside, k, 0) for k in (2, 3, 4))
        symbols = one * 256 + letters
        near = one | two << 9
        keys = [pair_keys(kind, h, self.letter_rank[symbols]) for kind, h in ((NEAR, near), (FAR, near | three << 17 | four << 25))]
        return symbols, keys, np.repeat(np.arange(len(spelled)), [len(w) + 1 for w in spelled])

    def contexts(self, tokens: tuple[np.ndarray, ...]) -> tuple[list[np.ndarray], list[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Of a batch of texts the different keys by kind; for all words
        (``BELOW``, ``LONG``) and letters (``NEAR``, ``FAR``) the places of
        their keys, and for the keys of ``BELOW`` those of their keys of
        ``TOP``, which are a subtree's first word's; the letters' symbols and
        texts."""
        ids, short, long, _, spelled, owner = tokens
        rank = self.rank[ids].astype(np.int64)
        found, places = [], []
        history = np.minimum(short, self.common)  # the very common words, and none
        keys, back = np.unique(pair_keys(BELOW, history << CROWN | self.subtree[rank], rank), return_inverse=True)
        below = keys & np.uint64((1 << KIND_BITS) - 1)
        above = (below >> np.uint64(WORD_BITS)).astype(np.int64)
        new = np.diff(above, prepend=-1) > 0
        found += [pair_keys(TOP, above[new] >> CROWN, self.top[above[new] & ((1 << CROWN) - 1)]), keys]
        places += [np.cumsum(new) - 1, back]
        keys, back = np.unique(pair_keys(LONG, long, rank), return_inverse=True)
        found.append(keys)
        places.append(back)
        symbols, both, word = self.letter_pairs(spelled)
        for keys in both:
            keys, back = np.unique(keys, return_inverse=True)
            found.append(keys)
            places.append(back)
        return found, places, (symbols, owner[word])

    def counts(self, tokens: tuple[np.ndarray, ...], learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All different keys of a batch, sorted, and how often each stands in the texts to learn from."""
        found, (top, below, long, near, far), (_, owner) = self.contexts(tokens)
        words, letters = learn[tokens[3]], learn[owner]
        n = [np.bincount(at, weights=weights, minlength=len(keys)) for at, weights, keys in zip((below, long, near, far), (words, words, letters, letters), found[BELOW:], strict=True)]
        n.insert(TOP, np.bincount(top, weights=n[0], minlength=len(found[TOP])))
        return np.concatenate(found), np.rint(np.concatenate(n)).astype(np.int64)

    def paths(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of keys: the places of their first decisions and how many decisions
        they have; of all places the bit and the rank that parts the node's sides."""
        kind = (keys >> np.uint64(KIND_BITS)).astype(np.int64)
        word = kind < NEAR
        rank = (keys[word] & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
        met = np.zeros(len(self.leaf), bool)
        met[rank] = True
        codes, local = climb(*self.tree, self.leaf[met]), (np.cumsum(met, dtype=np.int32) - 1)[rank]
        letter = keys[~word]
        symbol = ((letter >> np.uint64(LETTER_BITS)) & np.uint64(511)).astype(np.int64) * 256
        symbol += self.letter_leaf[symbol + (letter & np.uint64(255)).astype(np.int64)]
        first, length = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        first[word], length[word] = codes.first[local], codes.length[local]
        first[~word], length[~word] = self.letters.first[symbol] + len(codes.bit), self.letters.length[symbol]
        first += np.where(kind == BELOW, np.minimum(length, CROWN), 0)
        length = np.where(kind == TOP, np.minimum(length, CROWN), np.where(kind == BELOW, np.maximum(length - CROWN, 0), length))
        return first, length, np.concatenate((codes.bit, self.letters.bit)), np.concatenate((self.middle[codes.node], self.letter_middle))

    def streams(
        self, tokens: tuple[np.ndarray, ...], places: list[np.ndarray], letters: tuple[np.ndarray, np.ndarray], starts: list[np.ndarray], n: int
    ) -> list[tuple]:
        """Of words and letters of ``n`` texts (codes, places of all decisions,
        places of their counts for both histories, decisions of every text),
        where ``starts`` has by kind the place of every key's first count, and
        the level from which on nothing but the key is counted."""
        ids, _, _, text, *_ = tokens
        met = np.zeros(len(self.leaf), bool)
        met[ids] = True
        codes, local = climb(*self.tree, np.flatnonzero(met)), (np.cumsum(met, dtype=np.int32) - 1)[ids]
        top, below, long, near, far = places
        place, count = codes.decisions(local)
        level, bit = levels(count), codes.bit[place]
        high = level < CROWN
        first, last = (
            np.where(high, np.repeat(up[top][below], count), np.repeat(down[below], count)) for up, down in zip(starts[TOP], starts[BELOW], strict=True)
        )
        entries = [
            counted_at(first, last, np.where(high, level, level - CROWN), bit),
            counted_at(*(np.repeat(x[long], count) for x in starts[LONG]), level, bit),
        ]
        out = [(codes, place, entries, np.bincount(text, weights=count, minlength=n).astype(np.int64))]
        symbols, owner = letters
        place, count = self.letters.decisions(symbols)
        level, bit = levels(count), self.letters.bit[place]
        entries = [counted_at(*(np.repeat(x[at], count) for x in starts[kind]), level, bit) for kind, at in ((NEAR, near), (FAR, far))]
        return [*out, (self.letters, place, entries, np.bincount(owner, weights=count, minlength=n).astype(np.int64))]


def levels(count: np.ndarray) -> np.ndarray:
    """0 to ``count[i] - 1`` for every i."""
    return np.arange(int(count.sum()), dtype=np.int32) - np.repeat((np.cumsum(count) - count).astype(np.int32), count)


def counted_at(start: np.ndarray, last: np.ndarray, level: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Places of the counts of decisions of keys, of which the levels from ``last`` on share two, by bit."""
    return start + np.where(level < last, level, last + bit)


ASKED = "shard int, batch long, payload binary"
ASKED_ARROW = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("payload", pa.binary())])


def asked_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ASKED_ARROW.types, strict=True)], schema=ASKED_ARROW)


def walk(groups: np.ndarray, paths: tuple[np.ndarray, ...], alone: np.ndarray, values) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Down the code tree level by level: the keys (those of a group are of
    one history, by rank) still followed and the counts of their nodes; a key
    is followed until its node counts no more than the key ``alone``.  Keys
    that go on to the same node share one value, and beside a node's side 0 its
    side 1 has what is left: ``values(level, keys, here, above)`` gives the
    counts of the keys marked, the first ones of their node, by their counts above."""
    first, length, bit, middle = paths
    live, level, above = np.arange(len(groups)), 0, np.zeros(len(groups), np.int64)
    while len(live):
        here = np.diff(groups[live], prepend=-1) != 0  # the first key of a node of the level above
        if level:
            at = first[live] + (level - 1)
            here |= np.diff(middle[at], prepend=-1) != 0
            rest = np.append(False, ~here[1:] & (np.diff(bit[at].view(np.int8)) > 0))
            node = np.cumsum(here) - 1
            seen = values(level, live, here, above[here])[node]
            # The keys of side 1 that stand beside keys of side 0, up to the node's end.
            after = np.cumsum(rest)
            beside = after > after[here][node]
            seen = np.where(beside, above - seen, seen)
        else:
            seen = values(level, live, here, above[here])[np.cumsum(here) - 1]
        yield live, seen
        on = (seen > alone[live]) & (length[live] > level)
        live, above, level = live[on], seen[on], level + 1


def answered(coder: Coder, table: tuple[np.ndarray, np.ndarray], asked: list[np.ndarray]) -> list[bytes]:
    """To all lists of keys the counts of the keys alone and, level by level,
    how much of their nodes' counts goes another way."""
    keys, sums = table
    every = np.concatenate(asked)
    first, _, bit, middle = paths = coder.paths(every)
    base, span = spans(every)
    bounds = np.cumsum([0, *map(len, asked)])
    new = np.diff(base, prepend=~base[:1]) != 0
    new[bounds[:-1]] = True
    at = np.searchsorted(keys, every)
    alone = np.zeros(len(every), np.int64)
    known = np.flatnonzero(np.append(keys, ~every[-1:])[at] == every) if len(keys) else at[:0]
    known = known[at[known] < len(keys)]
    alone[known] = sums[at[known] + 1] - sums[at[known]]
    group = np.cumsum(new) - 1
    lo, hi = np.searchsorted(keys, base[new])[group], np.searchsorted(keys, (base + span)[new])[group]
    out: list[list[np.ndarray]] = [[] for _ in asked]

    def counts(level: int, live: np.ndarray, here: np.ndarray, above: np.ndarray) -> np.ndarray:
        some = live[here]
        if level:
            split = np.searchsorted(keys, base[some] + middle[first[some] + (level - 1)].astype(np.uint64))[np.cumsum(here) - 1]
            right = bit[first[live] + (level - 1)] > 0
            lo[live], hi[live] = np.where(right, split, lo[live]), np.where(right, hi[live], split)
        seen = sums[hi[some]] - sums[lo[some]]
        sent = above - seen if level else seen
        cuts = np.searchsorted(some, bounds).tolist()
        for own, a, b in zip(out, cuts[:-1], cuts[1:], strict=True):
            if a < b:
                own.append(sent[a:b])
        return seen

    for _ in walk(group, paths, alone, counts):
        pass
    return [packed([alone[a:b], np.concatenate(sent)]) for sent, a, b in zip(out, bounds[:-1], bounds[1:], strict=True)]


def answer(batches: Iterator[pa.RecordBatch], coder) -> Iterator[pa.RecordBatch]:
    """Counts of the keys that every batch asks a shard for.  A shard's rows come
    twice, first to be summed (``turn`` 0), then to be answered."""
    shard, parts, table, waiting = None, [], None, []

    def replies() -> Iterator[pa.RecordBatch]:
        if waiting:
            payloads = answered(coder.value, table, [keys for _, keys in waiting])
            yield asked_rows([(shard, batch, payload) for (batch, _), payload in zip(waiting, payloads, strict=True)])
            waiting.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                yield from replies()
                shard, parts, table = row["shard"], [], None
            keys, n = unpacked(row["payload"])
            if not row["turn"]:
                parts.append((keys[n > 0], n[n > 0]))
                if sum(len(k) for k, _ in parts[1:]) > max(1 << 20, len(parts[0][0])):
                    parts = [summed(parts)]
                continue
            if table is None:
                learnt, sums = summed(parts)
                table, parts = (learnt, np.append(0, np.cumsum(sums))), []
            waiting.append((row["batch"], keys))
            if sum(len(keys) for _, keys in waiting) > ASKS:
                yield from replies()
    yield from replies()


def met_counts(coder: Coder, found: list[np.ndarray], payloads: dict[int, bytes], shards: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """From the answers to the keys ``found`` by kind: by kind the place of
    every key's first decision, and the level from which on only the key is
    counted; and ones and seen at all places.  The levels from there on share
    two places, for bit 0 and bit 1."""
    every = np.concatenate(found)
    every_first, every_length, bit, middle = coder.paths(every)
    starts, lasts = np.empty((2, len(every)), np.int32)
    parts, size = [], 0
    for shard, at in by_shard(every, shards):
        alone, sent = (x.astype(np.int64) for x in unpacked(payloads[shard]))
        keys, first, length, done = every[at], every_first[at], every_length[at], 0

        def received(level: int, live: np.ndarray, here: np.ndarray, above: np.ndarray) -> np.ndarray:
            nonlocal done
            done += len(above)
            return above - sent[done - len(above) : done] if level else sent[:done]

        last, above, met = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int64), []
        new = np.diff(spans(keys)[0], prepend=~keys[:1]) != 0
        for level, (live, below) in enumerate(walk(np.cumsum(new), (first, length, bit, middle), alone, received)):
            if level:
                met.append((live, above[live], np.where(bit[first[live] + (level - 1)] > 0, below, above[live] - below)))
                last[live] = level
            above[live] = below
        start = np.cumsum(last + 2) - (last + 2)
        counts = np.zeros((int(start[-1] + last[-1]) + 2, 2), np.float32)
        ones, seen = counts.T
        for level, (live, here, side) in enumerate(met):
            seen[start[live] + level], ones[start[live] + level] = here, side
        end = start + last
        seen[end] = seen[end + 1] = ones[end + 1] = alone
        starts[at], lasts[at] = start + size, last
        size += len(ones)
        parts.append(counts)
    cuts = np.cumsum([len(k) for k in found])[:-1]
    return list(zip(np.split(starts, cuts), np.split(lasts, cuts), strict=True)), *np.concatenate(parts).T


class Model:
    """The mixing that scores texts, from counts of the contexts they ask for."""

    def __init__(self):
        self.weights = np.tile(np.array([0.4, 0.6, 0.0], np.float32), (GATES, 1))
        level = (np.arange(LEVELS) + 0.5) - LEVELS / 2
        self.map = (1 / (1 + np.exp(-level))).astype(np.float32)

    def bits(self, streams: Iterator[tuple], counts: np.ndarray) -> np.ndarray:
        """Total bits of every text, from pairs of ones and seen."""
        pairs = counts.view(np.uint64).reshape(-1)  # what is read together stands together
        return sum(self.mixed(pairs, *stream) for stream in streams)

    def mixed(self, pairs: np.ndarray, codes: Codes, place: np.ndarray, entries: list[np.ndarray], per: np.ndarray) -> np.ndarray:
        """Bits of every text's decisions, of which text i has ``per[i]`` in a row."""
        if not len(place):
            return np.zeros(len(per))
        # One lane a text, the longest first; the decisions of a step stand together, lane by lane.
        owner = np.argsort(-per, kind="stable")[: np.count_nonzero(per)]
        length, n = per[owner], np.count_nonzero(per)
        inside = levels(length)
        step = inside // np.int32(STEP)
        step = step.astype(np.min_scalar_type(step.max()))
        order = np.argsort(step, kind="stable").astype(np.int32)
        ends = np.append(0, np.cumsum(np.bincount(step))).tolist()
        lane = np.repeat(np.arange(n, dtype=np.int32), length)[order]
        at = (inside + np.repeat((np.cumsum(per) - per)[owner].astype(np.int32), length))[order]
        place, entries = place[at], [e[at] for e in entries]
        y, p = codes.bit[place].astype(np.float32), codes.share[place]
        x = np.empty((3, len(y)), np.float32)
        x[2] = np.log(p / (1 - p)).clip(-11, 11)
        gate = np.zeros(len(y), np.int32)
        for k, (at, prior) in enumerate(zip(entries, (SHORT_PRIOR, LONG_PRIOR), strict=True)):
            ones, seen = pairs[at].view(np.float32).reshape(-1, 2).T
            p = (ones + np.float32(prior) * p) / (seen + np.float32(prior))
            x[k] = np.log(p / (1 - p)).clip(-11, 11)
            gate = gate * 4 + (seen >= 1) + (seen >= 16) + (seen >= 256)
        gate += lane * np.int32(GATES)
        weights, refined, final = np.tile(self.weights.T, n), np.tile(self.map, n), np.empty(len(y), np.float32)
        for t in range(0, int(length[0]), STEP):
            live = int(np.searchsorted(-length, -t, side="left"))
            lo, hi = ends[t // STEP], ends[t // STEP + 1]
            xs, ys, pick = x[:, lo:hi], y[lo:hi], gate[lo:hi]
            a, b, c = weights.take(pick, axis=1) * xs
            dot = np.clip(a + b + c, -11.9, 11.9)
            p = 1 / (1 + np.exp(-dot))
            spot = lane[lo:hi] * np.int32(LEVELS) + (dot + LEVELS / 2).astype(np.int32)
            q = refined[spot]
            final[lo:hi] = 0.5 * (p + q)
            error = (ys - p) * np.float32(RATE)
            for w, own in zip(weights, error * xs, strict=True):
                w[: live * GATES] += np.bincount(pick, weights=own, minlength=live * GATES).astype(np.float32)
            refined[: live * LEVELS] += np.bincount(spot, weights=(ys - q) * np.float32(MAP_RATE), minlength=live * LEVELS).astype(np.float32)
        new = np.append(True, lane[1:] != lane[:-1])
        new[ends[:-1]] = True
        part = np.flatnonzero(new)
        bits = np.bincount(np.repeat(np.arange(len(part)), np.diff(part, append=len(lane))), weights=np.log2(np.where(y > 0, final, 1 - final)))
        cost = np.bincount(lane[part], weights=-bits, minlength=n)
        np.clip(cost, 0, None, out=cost)
        return np.bincount(owner, weights=cost, minlength=len(per))


def lm_score(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text; learn from the rows where ``learn_from`` holds.

    Returns one row per input row: doc_id, n_tokens (words and the end),
    n_known (tokens seen in training), train_tokens, base_score (log10
    probability under the smoothed word counts of the training texts), score
    (log10 probability under the mixing model), bits and bits_per_byte (of
    the text as UTF-8; a text without bytes counts one).

    Defined cases: a null or empty text is the end alone; any byte sequence
    has a code, so no score is infinite; without training rows every count is
    0; repeated rows and null ids are scored row by row, and count in
    training as often as given; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    training = id_and_text(docs.where(learn_from), id_col, text_col)
    counted = spool(count_words(training), "lm-words")
    total, different = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    eligible = (F.length("word") <= WORD_BYTES) & (F.col("n") >= LEAST_COUNT)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"word": digests(batch.column(0).to_pylist()).view(np.int64), "n": batch.column(1)})

    top = counted.where(eligible).select("word", "n").mapInArrow(shorten, "word long, n long").toArrow()
    words, counts = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    end = digests([b""])
    if end[0] not in words:
        words, counts = np.append(words, end), np.append(counts, counted.where(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])  # the end always has a code
    order = np.lexsort((words, -counts))
    words, counts = words[order], counts[order]
    rare = counted.where(~eligible & (F.length("word") > 0))
    coder = spark.sparkContext.broadcast(Coder(words, counts, int(total - counts.sum()), count_bytes(rare)))
    # More training texts make more and larger shards.
    shards = max(32, math.isqrt(total) // 128)
    unit = float(np.log10(total + 0.5 * (different + 1)))
    known = spark.sparkContext.broadcast((np.append(np.log10(counts + 0.5) - unit, 0.0), np.append(counts > 0, False)))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for nth, held in enumerate(together(batches, BATCH)):
            doc_ids, texts, learn = held.columns
            ids, words, spelled = coder.value.numbered(*split_words(texts))
            letters = zstandard.ZstdCompressor(level=3).compress(b"\n".join(spelled))
            row = {"batch": part + nth, "ids": doc_ids.to_pylist(), "learn": learn.to_pylist(), "sizes": pc.binary_length(texts).to_pylist()}
            yield pa.RecordBatch.from_pylist([row | {"words": words.tolist(), "payload": packed([ids]), "letters": letters}], schema=GROUPED_ARROW)

    learn = F.coalesce(learn_from.cast("boolean"), F.lit(False)).alias("learn")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), learn)
    grouped = spool(rows.mapInArrow(group, GROUPED), "lm-batches")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The keys of every batch, by shard, each with how often it stands in the texts to learn from."""
        for batch in batches:
            for row in batch.to_pylist():
                found, n = coder.value.counts(tokens_in(row, coder.value), np.array(row["learn"]))
                yield asked_rows([(shard, row["batch"], packed([found[at], n[at]])) for shard, at in by_shard(found, shards)])

    asked = grouped.mapInArrow(ask, ASKED).repartition("shard")
    # A shard reads its rows twice: what is counted in them, then what is asked.
    turns = asked.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1)))).sortWithinPartitions("shard", "turn", "batch")
    answers = turns.mapInArrow(lambda batches: answer(batches, coder), ASKED)

    def finish(row: dict, payloads: dict[int, bytes]) -> pa.RecordBatch:
        own, (log, counts) = coder.value, known.value
        tokens = tokens_in(row, own)
        ids, _, _, text, spelled, owner = tokens
        found, places, letters = own.contexts(tokens)
        starts, ones, seen = met_counts(own, found, payloads, shards)
        met = np.stack((ones, seen), axis=1)
        del found, ones, seen
        payloads.clear()
        sizes = np.array(row["sizes"], np.int64)
        bits = []
        for lo, hi in cuts(sizes, MIXED):
            some, places_of, letters_of = part_of(tokens, places, letters, lo, hi)
            bits += Model().bits(own.streams(some, places_of, letters_of, starts, hi - lo), met).tolist()
        n_known = np.bincount(text, weights=counts[ids], minlength=len(sizes))
        base = np.bincount(text, weights=log[ids], minlength=len(sizes))
        others: list[Counter] = [Counter() for _ in sizes]
        for word, i in zip(spelled, owner.tolist(), strict=True):
            others[i][word] += 1
        out = [
            (doc_id, words, int(n_known[i]), float(base[i]), bits[i], bits[i] / max(1, size), [{"word": w, "k": k} for w, k in others[i].items()])
            for i, (doc_id, size, words) in enumerate(zip(row["ids"], row["sizes"], row["words"], strict=True))
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SCORED_ARROW.types, strict=True)], schema=SCORED_ARROW)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch's texts come first, then the answers to it."""
        own, payloads = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] < 0:
                    if own is not None:
                        yield finish(own, payloads)
                    own, payloads = row, {}
                else:
                    payloads[row["shard"]] = row["payload"]
        if own is not None:
            yield finish(own, payloads)

    texts_of = grouped.withColumn("shard", F.lit(-1))
    answers = answers.select("batch", "shard", "payload")
    met = texts_of.unionByName(answers, allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", "shard")
    scored = spool(met.mapInArrow(score, SCORED).withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    # Words beyond the vocabulary: their counts, by an equi-join.
    others = scored.select("row", F.inline("others"))
    met = (
        others.join(counted, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("k_known"),
            F.sum(F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - unit)).alias("k_log"),
        )
    )
    return scored.join(met, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("k_log", F.lit(0.0))).alias("base_score"),
        (-F.col("bits") * float(np.log10(2))).alias("score"),
        "bits",
        "bits_per_byte",
    )


# A batch's texts as word ids, with their sizes in bytes and in words (and the end), and the words to spell.
GROUPED = "batch long, ids array<bigint>, learn array<boolean>, sizes array<bigint>, words array<bigint>, payload binary, letters binary"
GROUPED_ARROW = pa.schema(
    [
        ("batch", pa.int64()), ("ids", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())),
        ("words", pa.list_(pa.int64())), ("payload", pa.binary()), ("letters", pa.binary()),
    ]
)


def tokens_in(row: dict, coder: Coder) -> tuple[np.ndarray, ...]:
    """The tokens of a batch's texts."""
    ids = unpacked(row["payload"])[0].astype(np.int64)
    spelled = zstandard.ZstdDecompressor().decompress(row["letters"]).split(b"\n") if (ids == coder.escape).any() else []
    return coder.histories(ids, np.array(row["words"], np.int64), spelled)


def cuts(sizes: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` bytes."""
    run = (np.cumsum(sizes) - sizes) // size
    first = np.flatnonzero(np.diff(run, prepend=-1)).tolist()
    yield from zip(first, [*first[1:], len(sizes)], strict=True)


def part_of(tokens: tuple[np.ndarray, ...], places: list[np.ndarray], letters: tuple[np.ndarray, np.ndarray], lo: int, hi: int) -> tuple:
    """Tokens, places and letters of texts ``lo`` to ``hi`` of a batch."""
    ids, short, long, text, spelled, owner = tokens
    top, *places = places
    symbols, letter_owner = letters
    a, b = np.searchsorted(text, (lo, hi)).tolist()
    c, d = np.searchsorted(owner, (lo, hi)).tolist()
    e, f = np.searchsorted(letter_owner, (lo, hi)).tolist()
    below, long_at, near, far = places
    some = ids[a:b], short[a:b], long[a:b], text[a:b] - lo, spelled[c:d], owner[c:d] - lo
    return some, [top, below[a:b], long_at[a:b], near[e:f], far[e:f]], (symbols[e:f], letter_owner[e:f] - lo)


SCORED = "doc_id long, n_tokens long, n_known long, base double, bits double, bits_per_byte double, others array<struct<word:binary,k:bigint>>"
SCORED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("bits", pa.float64()),
        ("bits_per_byte", pa.float64()), ("others", pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))),
    ]
)
