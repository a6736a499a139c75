"""Masked pseudo-likelihood of documents under a bidirectional window network."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import name_in, receive, refuse, saved, send, without

#: Tokens on either side that the network sees.
SIDE = 2
#: Ways a softmax chooses among; three of them, one below the other, choose a token.
WAYS, LEVELS = 16, 3
TOKENS = WAYS**LEVELS
#: Of a vocabulary's tokens: the end of a text is 0, then buckets for rare characters, characters, parts of words, and words.
RARE, CHARACTERS, PARTS = 128, 1024, 1024
#: Times a word, a part or a character occurs at least to be a token.
LEAST = 5
#: Characters of a part of a word.
PART = 4
#: A word with the blank before it, at most 32 letters of it, or any other character.
WORD = re.compile(r" ?[^\W\d_]{1,32}|[\s\S]")
#: Sixteenths of the documents that each round of training goes through; together all of them.
ROUNDS = (1, 1, 2, 4, 8)
#: Places a step of training, or a call of the network, works on.
BATCH = 1 << 14
RESULTS = ("n_tokens", "log_likelihood", "per_token")
_KEYS = 300_000  # of a task's table, before it is sent on
_CHUNK = 1 << 20
_GROUP, _COUNTED = 1 << 18, 1_900_000  # characters cut into tokens, or counted by words, at once, but for longer pieces of a text
_ADDERS = 64  # tasks that add up networks, at most; the driver gets a row of each
_EDGE = np.zeros(SIDE, np.uint16)


def pieces(text: str) -> Iterator[str]:
    """A whole text, some ``_CHUNK`` characters at a time, cut before a blank if one is near."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + _CHUNK, at + 2 * _CHUNK) if len(text) - at > _CHUNK else len(text)
        end = at + 2 * _CHUNK if end < 0 else end
        yield text[at:end]
        at = end


class Vocabulary:
    """Tokens of a corpus: its frequent words, and for all others the longest parts it has, at last characters.

    Nothing is folded: case, accents, digits and every script stay. Only characters too rare for a token of
    their own share ``RARE`` buckets, and the probability of a bucket is shared by all code points in it.
    """

    def __init__(self, units: Iterable[str]):
        self.ids = {unit: i for i, unit in enumerate(dict.fromkeys(units), 1 + RARE)}
        if len(self.ids) >= TOKENS - RARE:
            raise ValueError(f"more than {TOKENS - RARE - 1} tokens")
        self._cutter = _Cutter(self.ids)

    def tokens(self, text: str) -> np.ndarray:
        """The tokens of a whole text."""
        return np.frombuffer(self.packed([text])[0], "<u2")

    def packed(self, texts: Iterable[str]) -> list[bytes]:
        """The same of many texts, two bytes a token."""
        found: list[list[bytes]] = []
        group: list[tuple[list[bytes], str]] = []
        size = 0
        for text in texts:
            found.append([])
            for piece in pieces(text):
                group.append((found[-1], piece))
                size += len(piece)
                if size >= _GROUP:
                    self._cut(group)
                    group, size = [], 0
        self._cut(group)
        return [b"".join(x) for x in found]

    def _cut(self, group: list[tuple[list[bytes], str]]) -> None:
        for (to, _), tokens in zip(group, self._cutter.cut([piece for _, piece in group]) if group else (), strict=True):
            to.append(tokens)


class _Places:
    """Finds 64-bit keys in sorted ones, beginning where those with the same 16 bits do; keys should be spread evenly."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, ~np.uint64(0))
        self._first = np.searchsorted(keys, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of the first key that is not smaller, of each."""
        place = self._first[(keys >> np.uint64(48)).astype(np.int32)]
        left = np.flatnonzero(self.keys[place] < keys)
        while len(left):
            place[left] += 1
            left = left[self.keys[place[left]] < keys[left]]
        return place


class _Cutter:
    """Cuts many texts into tokens at once: words as ``WORD`` finds them, and those that are no token into the longest parts, one behind the other."""

    def __init__(self, ids: dict[str, int]):
        self._ids = ids
        self._single = (1 + np.arange(0x110000) % RARE).astype(np.uint16)  # the token of each character alone
        alone = [u for u in ids if len(u) == 1]
        self._single[_codes("".join(alone))] = [ids[u] for u in alone]
        parts = [u for u in ids if 1 < len(u) <= PART]
        self._letter = np.zeros(0x110000, np.uint16)  # numbers of the characters that longer parts have
        self._letter[_codes("".join(parts))] = 1
        self._letter[self._letter > 0] = np.arange(1, 1 + int(self._letter.sum()))
        self._parts = []  # of each size, their numbers, and their tokens
        for size in range(2, PART + 1):
            some = [u for u in parts if len(u) == size]
            numbers = _number(self._letter[_codes("".join(some))].reshape(-1, size).astype(np.uint64).T) * _ODD
            order = np.argsort(numbers)
            self._parts.append((_Places(numbers[order]), np.append(np.array([ids[u] for u in some], np.uint16)[order], np.uint16(0))))
        # Words by a hash, with their characters to compare; the last row is no word.
        longer = [u for u in ids if len(u) > 1]
        size = np.array([*map(len, longer), 0])
        table = np.zeros((len(size), max(1, size.max())), np.uint32)
        for row, unit in zip(table, longer, strict=False):
            row[: len(unit)] = _codes(unit)
        begins = np.cumsum(size) - size
        hashes = _hashes(_codes("".join(longer)), begins[:-1], begins[:-1] + size[:-1])
        order = np.append(np.argsort(hashes), len(longer))
        self._hash, self._size, self._table = _Places(hashes[order[:-1]]), size[order], table[order]
        self._word = np.append(np.array([ids[u] for u in longer], "<u2"), np.uint16(0))[order]

    def __reduce__(self):
        return _Cutter, (self._ids,)

    def cut(self, texts: list[str]) -> list[bytes]:
        """The tokens of each text, two bytes each."""
        codes = _codes("\0".join([*texts, ""]))  # whatever character, each text has one of no text behind it
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        begin, end = _word_places(codes)
        token = self._words(codes, begin, end)
        edges = np.searchsorted(begin, ends)
        missing = token == 0
        missing[edges], token[edges] = False, 0
        n, word = (token > 0).astype(np.int64), np.flatnonzero(missing)
        at, end, steps = begin[word], end[word], []
        letters = np.append(self._letter[codes], np.zeros(PART, np.uint16)).astype(np.uint64)
        while len(at):  # a part of every word that is not through
            part, size, number = self._single[codes[at]], np.ones(len(at), np.int64), letters[at]
            for k, (places, tokens) in enumerate(self._parts, 1):
                number = (number << np.uint64(16)) + letters[at + k]
                spread = number * _ODD
                place = places.find(spread)
                hit = np.flatnonzero((places.keys[place] == spread) & (at + k < end))
                part[hit], size[hit] = tokens[place[hit]], k + 1
            steps.append((word, part))
            n[word] += 1
            at = at + size
            going = np.flatnonzero(at < end)
            at, end, word = at[going], end[going], word[going]
        first = np.cumsum(n) - n
        found = np.empty(int(n.sum()), "<u2")
        whole = np.flatnonzero(token)
        found[first[whole]] = token[whole]
        for k, (word, part) in enumerate(steps):
            found[first[word] + k] = part
        data, bounds = found.tobytes(), (first[edges] * 2).tolist()
        return [data[a:b] for a, b in pairwise([0, *bounds])]

    def _words(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The token of each word, 0 where it is none."""
        size = end - begin
        token = np.where(size == 1, self._single[codes[begin]], np.uint16(0))
        some = np.flatnonzero(size > 1)
        hashes = _hashes(codes, begin[some], end[some])
        place = self._hash.find(hashes)
        like = np.flatnonzero((self._hash.keys[place] == hashes) & (self._size[place] == size[some]))
        some, place = some[like], place[like]
        left, row, k = some, place, 0
        wrong = []
        while len(left):
            same = self._table[row, k] == codes[begin[left] + k]
            wrong.append(left[~same])
            k += 1
            going = np.flatnonzero(same & (size[left] > k))
            left, row = left[going], row[going]
        token[some] = self._word[place]
        token[np.concatenate([*wrong, some[:0]])] = 0
        return token


#: Multiplied with it, no two numbers of 64 bits become the same, and the upper bits depend on all.
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _is_letter() -> np.ndarray:
    """Of each character, whether ``WORD`` takes it for a letter."""
    letter = np.zeros(0x110000, bool)
    letter[[ord(c) for c in re.findall(r"[^\W\d_]", "".join(map(chr, range(0x110000))))]] = True
    return letter


def _word_places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``WORD`` begin and end."""
    letter = _is_letter()[codes]
    begins = ~letter
    begins[1:] |= begins[:-1] & (codes[:-1] != 32)
    begins[0] = True
    begin = np.flatnonzero(begins)
    end = np.append(begin[1:], len(codes))
    long = np.flatnonzero(end - begin > 32)
    if len(long):
        lead = 1 - letter[begin[long]].astype(np.int64)
        for a, b in zip((begin[long] + lead + 32).tolist(), end[long].tolist(), strict=True):
            begins[a:b:32] = True
        begin = np.flatnonzero(begins)
        end = np.append(begin[1:], len(codes))
    return begin, end


def _hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of characters, wherever it stands."""
    up, down = _powers(1 << max(18, int(len(codes)).bit_length()))
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return (sums[end] - sums[begin]) * down[begin]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2**64."""
    return tuple(np.append(np.uint64(1), np.cumprod(np.full(n, x, np.uint64))) for x in (int(_ODD), pow(int(_ODD), -1, 1 << 64)))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _number(letters: Iterable[np.ndarray]) -> np.ndarray:
    """Letters one behind the other as a number, 16 bits each."""
    number, *rest = letters
    for letter in rest:
        number = (number << np.uint64(16)) + letter
    return number


def _told_counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["unit", "n"])


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of all texts, and how often in some ``_COUNTED`` characters."""
    group, size = [], 0
    for batch in batches:
        for value in batch.column("text"):
            for piece in pieces(value.as_py()):
                group.append(piece)
                size += len(piece)
                if size >= _COUNTED:
                    yield _told_counts(_counted(group))
                    group, size = [], 0
    if group:
        yield _told_counts(_counted(group))


def _counted(texts: list[str]) -> dict[str, int]:
    """How often each word stands in the texts: words are put in order by their hashes, and those of one hash compared."""
    text = "\0".join([*texts, ""])  # as the cutter has it
    codes = _codes(text)
    begin, end = _word_places(codes)
    own = np.ones(len(begin), bool)
    own[np.searchsorted(begin, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1)] = False
    begin, end = begin[own], end[own]
    hashes = _hashes(codes, begin, end)
    order = np.argsort(hashes)
    hashes, begin, end = hashes[order], begin[order], end[order]
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    n = np.diff(np.append(first, len(hashes)))
    found = [text[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
    if not _alike(codes, begin, end, hashes):
        return Counter(text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True))
    return dict(zip(found, n.tolist(), strict=True))


def _alike(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> bool:
    """Whether each word is the one before it, wherever they have one hash."""
    at = np.flatnonzero(hashes[1:] == hashes[:-1])
    a, b, size = begin[at], begin[at + 1], (end - begin)[at]
    if not np.array_equal(size, (end - begin)[at + 1]):
        return False
    while len(a):
        if not np.array_equal(codes[a], codes[b]):
            return False
        going = np.flatnonzero(size > 1)
        a, b, size = a[going] + 1, b[going] + 1, size[going] - 1
    return True


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to ``PART`` characters in counted words, and how often."""
    seen: Counter = Counter()
    for batch in batches:
        for unit, n in _parts(batch.column("unit").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)):
            seen.update(dict(zip(unit, n, strict=True)))
            if len(seen) > _KEYS:
                yield _told_counts(seen)
                seen.clear()
    yield _told_counts(seen)


def _parts(words: list[str], n: np.ndarray) -> Iterator[tuple[list[str], list[int]]]:
    text = "".join(words)
    codes = _codes(text)
    letters = np.unique(codes)
    if len(letters) > 1 << 16:  # four of them are to make a number of 64 bits
        half = len(words) // 2
        yield from _parts(words[:half], n[:half])
        yield from _parts(words[half:], n[half:])
        return
    letter = np.searchsorted(letters, codes).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    left, times = np.repeat(np.cumsum(size), size) - np.arange(len(codes)), np.repeat(n, size)
    places, run = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    for k in range(PART):
        keep = left[places] > k
        places = places[keep]
        if not len(places):
            return
        run = (run[keep] << np.uint64(16)) + letter[places + k]
        order = np.argsort(run)
        begins = np.flatnonzero(np.diff(run[order], prepend=~run[order[:1]]))
        yield [text[i : i + k + 1] for i in places[order[begins]].tolist()], np.add.reduceat(times[places[order]], begins).tolist()


def _sums(counted: DataFrame) -> DataFrame:
    return counted.groupBy("unit").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, *, text: str = "text") -> Vocabulary:
    """The vocabulary of all documents.

    Words are counted over all texts, parts and characters over the counted words. The driver
    gets the most frequent only (parts by the characters they save); of equal ones the first by its text.
    """
    rows = docs.select(name_in(docs, text).cast("string").alias("text")).where("text <> ''")
    found = saved(_sums(rows.mapInArrow(_words_of, "unit string, n long")), "words")
    parts = saved(_sums(found.mapInArrow(_parts_of, "unit string, n long")).withColumn("size", F.char_length("unit")), "parts")
    best = lambda df, by, most: [r["unit"] for r in df.where(F.col("n") >= LEAST).orderBy(by.desc(), "unit").limit(most).select("unit").collect()]
    units = best(parts.where("size = 1"), F.col("n"), CHARACTERS) + best(parts.where("size > 1"), F.col("n") * (F.col("size") - 1), PARTS)
    taken = set(units)
    room = TOKENS - RARE - 1
    # Words may be among the units already, so as many more are asked for.
    whole = [u for u in best(found, F.col("n"), room) if u not in taken]
    return Vocabulary((units + whole)[:room])


class Network:
    """Embeddings of the ``2 * SIDE`` tokens around a place, one hidden layer, and ``LEVELS`` softmaxes down to the token there.

    It works on runs of tokens: texts behind each other, each with ``SIDE`` ends of text (token 0) before and after.
    A place is a token of a run but for its first and last ``SIDE``. In a call, what belongs to a place lies together, in
    arrays that the next call uses again: new ones of that size would cost more than what is done in them.
    """

    def __init__(self, width: int = 8, hidden: int = 16, seed: int = 11):
        self._shapes = {"e": (width, TOKENS), "w": (2 * SIDE, hidden, width), "b": (hidden, 1)}
        self._shapes |= {f"u{k}": (WAYS**k, WAYS, hidden + 1) for k in range(LEVELS)}  # the last weight is the bias
        sizes = [int(np.prod(s)) for s in self._shapes.values()]
        random = np.random.default_rng(seed)
        self.use(random.normal(0, 0.2, sum(sizes)).astype(np.float32))
        self.values["b"][:] = 0
        self._mean = self._square = None
        self._steps, self._arrays = 0, {}

    def use(self, flat: np.ndarray) -> None:
        """Takes all its values from one array."""
        self.flat, self.values, at = flat, {}, 0
        for k, shape in self._shapes.items():
            size = int(np.prod(shape))
            self.values[k] = flat[at : at + size].reshape(shape)
            at += size

    def __getstate__(self):
        return {"_shapes": self._shapes, "flat": self.flat, "_mean": None, "_square": None, "_steps": 0, "_arrays": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.use(self.flat.copy())

    def start(self, tokens: np.ndarray, n: np.ndarray) -> None:
        """Begins with each token as likely as it was counted, one count more for all, whatever stands around it."""
        total = np.ones(TOKENS)
        total[tokens] += n
        for k in range(LEVELS):
            ways = total.reshape(WAYS**k, WAYS, -1).sum(axis=2)
            self.values[f"u{k}"][:] *= 0.1
            self.values[f"u{k}"][:, :, -1] = np.log(ways / ways.sum(axis=1, keepdims=True))

    def _array(self, name: str, rows: int, width: int) -> np.ndarray:
        """An array of the name, with whatever the last call left in it."""
        held = self._arrays.get(name)
        if held is None or len(held) < rows * width or held.dtype != self.flat.dtype:
            held = self._arrays[name] = np.empty(rows * width * 5 // 4, self.flat.dtype)
        return held[: rows * width].reshape(rows, width)

    def _hidden(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The embeddings of a run, and the hidden layer with a one behind it."""
        v, m = self.values, len(run) - 2 * SIDE
        width, hidden = len(v["e"]), len(v["b"])
        e = np.take(np.ascontiguousarray(v["e"].T), run, axis=0, out=self._array("e", len(run), width), mode="clip")
        h = self._array("h", m, hidden + 1)
        h[:, -1] = 1
        weights = np.concatenate([self._weights().reshape(hidden, -1), v["b"]], axis=1).T
        for a, b, around in self._around(e, m):
            np.tanh(np.dot(around, weights, out=self._array("total", b - a, hidden)), out=h[a:b, :-1])
        return e, h

    def _around(self, e: np.ndarray, m: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """The embeddings around each place, its own as well, and a one, for few places at a time: so many stay in a processor's cache."""
        windows = _windows(e, m)
        for a in range(0, m, _FEW):
            b = min(a + _FEW, m)
            around = self._array("around", b - a, windows.shape[1] + 1)
            around[:, :-1], around[:, -1] = windows[a:b], 1
            yield a, b, around

    def _weights(self) -> np.ndarray:
        """Of the hidden layer, for the tokens around a place in order; its own has none."""
        w = self.values["w"]
        whole = np.zeros((w.shape[1], _WIDE, w.shape[2]), w.dtype)
        whole[:, _AROUND] = w.transpose(1, 0, 2)
        return whole

    def _choices(self, target: np.ndarray) -> Iterator[tuple[str, list[tuple[int, int, int]], np.ndarray]]:
        """Of each level, for targets in order: its name, the stretch of places at each node, and the ways that were right, as places of a flat table."""
        at = np.arange(0, len(target) * WAYS, WAYS)
        for k in range(LEVELS):
            below = WAYS ** (LEVELS - 1 - k)
            bounds = np.searchsorted(target, np.arange(WAYS**k + 1) * (WAYS * below)).tolist()
            yield f"u{k}", [(g, a, b) for g, (a, b) in enumerate(pairwise(bounds)) if a < b], at + target // below % WAYS

    def _ordered(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places with a token of a text, in the order of their tokens, and these tokens."""
        target = run[SIDE : len(run) - SIDE]
        places = np.flatnonzero(target)
        order = places[np.argsort(target[places], kind="stable")]
        return order, target[order].astype(np.int64)

    def log_probability(self, run: np.ndarray) -> np.ndarray:
        """Of the token on each place, given those around it; 0 where a text has ended."""
        order, target = self._ordered(run)
        h = self._hidden(run)[1]
        out, logs = np.zeros(len(h)), np.zeros(len(order))
        h = np.take(h, order, axis=0, out=self._array("ordered", len(order), h.shape[1]), mode="clip")
        for name, nodes, right in self._choices(target):
            z = self._scores(name, nodes, h)
            logs += z.reshape(-1)[right]
            logs -= np.log(np.exp(z, out=z) @ np.ones(WAYS, z.dtype))
        out[order] = logs
        return out

    def _scores(self, name: str, nodes: list[tuple[int, int, int]], h: np.ndarray) -> np.ndarray:
        z, u = self._array("z", len(h), WAYS), np.ascontiguousarray(self.values[name].transpose(0, 2, 1))
        for g, a, b in nodes:
            np.dot(h[a:b], u[g], out=z[a:b])
        if z.size and not (z.max() < _FAR and z.min() > -_FAR):  # else the sum of exponentials is in range as it is
            z -= z.max(axis=1, keepdims=True)
        return z

    def gradient(self, run: np.ndarray) -> tuple[float, int, np.ndarray]:
        """Summed loss of a run, the number of its tokens, and the gradient of the sum."""
        flat = np.zeros_like(self.flat)
        sums, at = {}, 0
        for k, v in self.values.items():
            sums[k] = flat[at : at + v.size].reshape(v.shape)
            at += v.size
        order, target = self._ordered(run)
        e, whole = self._hidden(run)
        n, wide = len(order), whole.shape[1]
        h, loss = np.take(whole, order, axis=0, out=self._array("ordered", n, wide), mode="clip"), 0.0
        dh, some = self._array("dh", n + 1, wide), self._array("some", n, wide)
        dh[n] = 0
        for level, (name, nodes, right) in enumerate(self._choices(target)):
            p, u, du = self._scores(name, nodes, h), self.values[name], sums[name]
            ways = p.reshape(-1)
            loss -= float(ways[right].sum(dtype=np.float64))
            total = np.exp(p, out=p) @ np.ones(WAYS, p.dtype)
            loss += float(np.log(total).sum(dtype=np.float64))
            p /= total[:, None]
            ways[right] -= 1
            for g, a, b in nodes:
                np.dot(p[a:b].T, h[a:b], out=du[g])
                np.dot(p[a:b], u[g], out=(some if level else dh)[a:b])
            if level:
                dh[:n] += some
        h *= h
        h *= dh[:n]
        dh[:n] -= h
        m, width = len(whole), len(sums["e"])
        places = np.full(m, n)  # a text's end takes the row behind all others, of zeros
        places[order] = np.arange(n)
        padded = self._array("padded", m + 4 * SIDE, wide)
        padded[: 2 * SIDE] = padded[m + 2 * SIDE :] = 0
        back = np.take(dh, places, axis=0, out=padded[2 * SIDE : m + 2 * SIDE], mode="clip")
        dw = sum(back[a:b].T @ around for a, b, around in self._around(e, m))[:-1]
        sums["b"][:, 0] = dw[:, -1]
        sums["w"][:] = dw[:, :-1].reshape(wide - 1, _WIDE, width).transpose(1, 0, 2)[_AROUND]
        # A token stands beside the places of a window around it, the last of them being the first it is seen from.
        seen = np.zeros((_WIDE, wide, width), h.dtype)
        seen[:, :-1] = self._weights().transpose(1, 0, 2)[::-1]
        windows, de, seen = _windows(padded, len(run)), self._array("de", len(run), width), seen.reshape(-1, width)
        for a in range(0, len(run), _FEW):
            beside = self._array("beside", len(windows[a : a + _FEW]), _WIDE * wide)
            beside[:] = windows[a : a + _FEW]
            np.dot(beside, seen, out=de[a : a + _FEW])
        tokens = run.astype(np.intp)
        for row, d in zip(sums["e"], de.T, strict=True):
            row[:] = np.bincount(tokens, d, TOKENS)
        return loss, n, flat

    def step(self, gradient: np.ndarray, rate: float) -> None:
        """One step of Adam."""
        if self._mean is None:
            self._mean, self._square = np.zeros_like(gradient), np.zeros_like(gradient)
        self._steps += 1
        self._mean += 0.1 * (gradient - self._mean)
        self._square += 0.01 * (gradient * gradient - self._square)
        root = np.sqrt(self._square / (1 - 0.99**self._steps))
        root += 1e-8
        self.flat -= (rate / (1 - 0.9**self._steps)) * self._mean / root


_AROUND = [k for k in range(2 * SIDE + 1) if k != SIDE]
_WIDE = 2 * SIDE + 1
_FEW = 1 << 11
_FAR = 80.0  # exponentials of numbers nearer to 0 stay in the range of 32 bits


def _windows(rows: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` windows of ``_WIDE`` rows, side by side, without copies."""
    width = rows.shape[1]
    return np.lib.stride_tricks.sliding_window_view(rows.reshape(-1), _WIDE * width)[::width][:n]


def runs(texts: Iterable[tuple[int, np.ndarray]], size: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of some ``size`` places of texts given with their rows, and the row of each place.

    Long texts are cut; what stands around a place is the same, wherever the cut is.
    """
    held, n = [], 0
    for row, tokens in texts:
        if len(tokens):
            held.append((row, tokens))
            n += len(tokens)
            if n >= size:
                yield from _cut(held, size)
                held, n = [], 0
    if held:
        yield from _cut(held, size)


def _cut(held: list[tuple[int, np.ndarray]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    run = np.concatenate([_EDGE, *chain.from_iterable((t, _EDGE) for _, t in held)])
    rows, sizes = np.array([r for r, _ in held]), [len(t) + SIDE for _, t in held]
    m = len(run) - 2 * SIDE
    pieces = max(1, m // size)
    row = np.repeat(rows, sizes)[:m]
    for a, b in pairwise(m * i // pieces for i in range(pieces + 1)):
        yield run[a : b + 2 * SIDE], row[a:b]


def _tokens(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    for i, value in enumerate(batch.column(column)):
        yield i, np.frombuffer(value.as_buffer() or b"", "<u2")


def tokenized(docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text", tokens: str = "tokens", part: str = "part") -> DataFrame:
    """``docs`` with the tokens of each text, two bytes each, and the number of a part of the corpus, rows dealt in turn. Narrow."""
    shared, parts = send(docs.sparkSession, vocabulary), sum(ROUNDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, n = receive(shared), 0
        for batch in batches:
            found = pa.array(vocabulary.packed(t.as_py() or "" for t in batch.column(text)), pa.binary())
            # Odd steps reach every part; a task begins where no other part of the corpus is favoured.
            dealt = pa.array((np.arange(n, n + batch.num_rows) * 5 % parts).astype(np.int32))
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, found, dealt], names=[*batch.schema.names, tokens, part])

    return docs.mapInArrow(run, docs.withColumns({tokens: F.lit(None).cast("binary"), part: F.lit(None).cast("int")}).schema)


def count_tokens(rows: DataFrame, *, tokens: str = "tokens") -> DataFrame:
    """``token, n`` over all rows of ``tokenized``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(TOKENS, np.int64)
        for run, _ in runs(chain.from_iterable(_tokens(b, tokens) for b in batches)):
            sums += np.bincount(run[SIDE : len(run) - SIDE], minlength=TOKENS)
        sums[0] = 0  # ends of texts
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(sums[found])], names=["token", "n"])

    return rows.select(name_in(rows, tokens)).mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, *, rate: float = 0.01, batch: int = BATCH, tokens: str = "tokens", part: str = "part") -> Network:
    """A network trained once on every token of the corpus, ``rows`` being ``tokenized`` documents that were written.

    Round by round (``ROUNDS``), each task takes steps of ``batch`` places through its rows of the round's parts, and the
    networks of all tasks are averaged by their numbers of tokens. Networks are added up in tasks, so that the driver gets
    ``_ADDERS`` at most, of 107,000 numbers each, whatever the size of the corpus.
    """
    network, spark = Network(), rows.sparkSession
    seen = count_tokens(rows, tokens=tokens).collect()  # a row for each token
    if not seen:
        return network
    network.start(np.array([r["token"] for r in seen]), np.array([r["n"] for r in seen], np.float64))
    at, adders = 0, min(_ADDERS, 1 + rows.rdd.getNumPartitions() // 16)
    for k, width in enumerate(ROUNDS):
        shared, speed = send(spark, network), rate * (1 - k / (2 * len(ROUNDS)))

        def fit(batches: Iterator[pa.RecordBatch], shared=shared, speed=speed) -> Iterator[pa.RecordBatch]:
            network, n = receive(shared), 0
            for run, _ in runs(chain.from_iterable(_tokens(b, tokens) for b in batches), batch):
                _, some, gradient = network.gradient(run)
                network.step(gradient / some, speed)
                n += some
            if n:
                yield _told(n, network.flat.astype(np.float64) * n)

        mine = (name_in(rows, part) >= at) & (name_in(rows, part) < at + width)
        fitted = rows.where(mine).select(name_in(rows, tokens)).mapInArrow(fit, "n long, sum binary")
        n, flat = 0, np.zeros(network.flat.size)
        for row in fitted.repartition(adders).mapInArrow(_add, "n long, sum binary").collect():
            n += row["n"]
            flat += np.frombuffer(row["sum"])
        if n:
            network.use((flat / n).astype(np.float32))
        at += width
        shared.destroy()
    return network


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, flat = 0, None
    for batch in batches:
        for some, sums in zip(batch.column("n").to_pylist(), batch.column("sum"), strict=True):
            n += some
            values = np.frombuffer(sums.as_buffer())
            flat = values.copy() if flat is None else flat + values
    if n:
        yield _told(n, flat)


def _told(n: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["n", "sum"])


def _scored(rows: DataFrame, network: Network, tokens: str, part: str) -> DataFrame:
    """``tokenized`` rows with results in place of their tokens and parts."""
    shared = send(rows.sparkSession, network)
    rows = rows.drop(name_in(rows, part))
    kept = [c for c in rows.columns if c != tokens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = receive(shared)
        for batch in batches:
            n, sums = np.array([len(t) for _, t in _tokens(batch, tokens)], np.int64), np.zeros(batch.num_rows)
            for run, row in runs(_tokens(batch, tokens)):
                target = run[SIDE : len(run) - SIDE]
                logs = network.log_probability(run)
                logs[np.flatnonzero((target >= 1) & (target <= RARE))] += np.log(RARE / 0x110000)
                sums += np.bincount(row, logs, len(sums))
            mean = [s / k if k else None for s, k in zip(sums.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n, pa.int64()), pa.array(sums, pa.float64()), pa.array(mean, pa.float64())], names=[*kept, *RESULTS])

    schema = rows.drop(name_in(rows, tokens)).withColumns(dict(zip(RESULTS, (F.lit(None).cast(t) for t in ("long", "double", "double")), strict=True))).schema
    return rows.mapInArrow(run, schema)


def _names(docs: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """``docs`` without columns named like results, and two names that it has not."""
    refuse(text, RESULTS)
    taken = {c.lower() for c in docs.columns}
    free = lambda name: name if name not in taken else free(name + "_")
    return without(docs, RESULTS), free("tokens"), free("part")


def score(docs: DataFrame, network: Network, vocabulary: Vocabulary, *, text: str = "text") -> DataFrame:
    """Documents with ``n_tokens``, ``log_likelihood`` (the sum over all places) and ``per_token`` (its mean, null without tokens).

    Narrow; the network and the vocabulary it was trained with are broadcast, both of bounded size.
    """
    docs, tokens, part = _names(docs, text)
    return _scored(tokenized(docs, vocabulary, text=text, tokens=tokens, part=part), network, tokens, part)


def pseudo_likelihood(docs: DataFrame, *, text: str = "text", batch: int = BATCH) -> DataFrame:
    """All documents scored by a network trained on all of them: the higher ``per_token``, the more like the rest.

    Tokens are the words of the corpus, its rarer words in parts (see ``Vocabulary``). Every token is predicted from
    ``SIDE`` tokens on each side, and the log-probabilities are summed over the whole text. A text that repeats itself
    is likely under its own words, so a high score is no sign of quality alone. Documents are written once with
    their tokens; training reads tokens only, and scoring reads them again.
    Null and empty texts have no tokens, 0 and a null mean; repeated rows count as often
    as they occur; with no text at all the network stays as it was drawn. Input columns
    named like results are replaced; a text column named like one is refused.
    """
    rest, tokens, part = _names(docs, text)
    rows = saved(tokenized(rest, learn(docs, text=text), text=text, tokens=tokens, part=part), "tokens")
    return _scored(rows, train(rows, batch=batch, tokens=tokens, part=part), tokens, part)
