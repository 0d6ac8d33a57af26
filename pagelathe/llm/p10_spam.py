"""Problem 10: pages made of keywords, links or product tags instead of sentences.

A text is read as a sequence of function words and word classes; a trigram
model of such sequences is trained on prose. Stretches of a text whose
perplexity under the model lies outside what prose shows, on either side, are
no prose, and a page most of whose words stand in such stretches is flagged.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import use_checkpoints

#: Words whose kinds a Python worker remembers, and different words that it counts before it hands the counts on.
MEMORY = 200_000
#: Function words: the words that stand in most texts; the first COMMON of them may recur freely.
FUNCTION_WORDS, COMMON = 300, 80
#: A content word that comes again within so many tokens is a class of its own: prose seldom does that.
NEAR = 12
#: Tokens of a stretch; quantiles of the stretches of prose between which perplexity is normal.
STRETCH, LOWEST, HIGHEST = 20, 0.0005, 0.995
#: Perplexities are counted in steps of one bit over STEPS, so that their quantiles need no sorting of all texts.
STEPS = 1000
#: Bytes of texts, and tokens, that are worked on at a time; one longer text is taken alone.
BYTES, TOKENS = 4_000_000, 1_000_000
#: A page is flagged if more than this part of its words stands outside prose.
HALF = 0.5
#: A text is taken for prose if so many of its words stand in sentences of five words or more.
PROSE_SHARE = 0.6
#: Weights of the trigram, bigram, unigram and uniform parts.
WEIGHTS = (0.6, 0.3, 0.09, 0.01)

_TOKEN = re.compile(r"https?://\S+|\]\([^)]*\)|[^\W\d_]+|\d+(?:[.,]\d+)*|\n+|[^\w\s]|_+")
# A link that words follow on its line is prose with a link; one that stands alone keeps its mark.
_LINK_IN_TEXT = re.compile(r"!?\[([^\[\]]*)\]\([^)]*\)(?=[ \t]+[^\W_])")
_UNSPACED = re.compile(r"[぀-ゟ]|[゠-ヿ]+|[㐀-鿿]+|[^぀-ヿ㐀-鿿]+")
_MISREAD = re.compile("[\u0080-ÿ€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{2,}")
_MISREAD_SIGNS = ("Ã", "â€", "Ð", "ã", "æ")
_MARKS = ".,;:!?-–—()[]\"“”'’#*|/%&+=<>{}•·…~`$_\\。、"
CLASSES = {c: i for i, c in enumerate(["low", "Cap", "UP", "NUM", "URL", "LINK", "NL", "again", "again-unspaced", "unspaced", "other", *_MARKS])}


def _reread(m: re.Match) -> str:
    """UTF-8 that was read as a Western single-byte code, read again; unchanged if it isn't that.

    Bytes without a letter in that code are often written as one and the same
    capital; where a byte inside a letter is due, it stands for 0x81, the
    commonest of them.
    """
    data, due = bytearray(), 0
    for ch in m[0]:
        try:
            byte = ch.encode("cp1252")[0]
        except UnicodeEncodeError:
            if ord(ch) > 255:
                return m[0]
            byte = ord(ch)
        if due and byte == 0xC3:
            byte = 0x81
        due = due - 1 if due and byte & 0xC0 == 0x80 else 1 if 0xC2 <= byte < 0xE0 else 2 if 0xE0 <= byte < 0xF0 else 3 if 0xF0 <= byte < 0xF5 else 0
        data.append(byte)
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def tokens_of(text: str) -> list[str]:
    """Words, numbers, addresses, line breaks and marks; scripts without spaces are cut into runs."""
    if "](" in text:
        text = _LINK_IN_TEXT.sub(r"\1", text)
    if any(s in text for s in _MISREAD_SIGNS):
        text = _MISREAD.sub(_reread, text)
    found = _TOKEN.findall(text)
    if max(text, default="") < "぀":
        return found
    out: list[str] = []
    for t in found:
        if t[0] >= "぀":
            out += _UNSPACED.findall(t)
        else:
            out.append(t)
    return out


# What a token is apart from the function words: one byte with its class in the lower bits, whether it begins with a
# letter or digit, and whether it is a content word (or unspaced run) that came before within NEAR tokens.
CLASS_BITS, ALNUM, AGAIN = 63, 64, 128
_ADDRESS, _WORD_IN_SENTENCE, _STOP, _BREAK, _HTTP, _REPEATABLE = 1, 2, 4, 8, 16, 32


class _Kinds(dict):
    """Number of every token met; by number its byte, its hash (0 if it is no word) and its part in sentences."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.bytes, self.hashes, self.parts = bytearray(), array("I"), bytearray()

    def __missing__(self, t: str) -> int:
        c, part, hashed, code = t[0], 0, 0, 0
        if c.isalpha():
            low = t.lower()
            hashed = xxhash.xxh32_intdigest(low.encode("utf-8", "surrogatepass")) or 1
            if c >= "぀":
                code, part = CLASSES["unspaced"], _REPEATABLE
            else:
                code = CLASSES["URL" if "://" in t else "UP" if len(t) > 1 and t.isupper() else "Cap" if c.isupper() else "low"]
                part = _REPEATABLE if len(low) > 3 and not low.startswith("http") else 0
        elif c.isdigit():
            code = CLASSES["NUM"]
        elif c == "\n":
            code = CLASSES["NL"]
        elif t.startswith("]("):
            code = CLASSES["LINK"]
        else:
            code = CLASSES.get(c, CLASSES["other"])
        if t.startswith("http"):
            part |= _ADDRESS | (_HTTP if "://" in t else 0)
        elif c.isalnum():
            part |= _WORD_IN_SENTENCE
        elif t in ".!?。…":
            part |= _STOP
        elif c == "\n":
            part |= _BREAK
        elif "://" in t and c == "h":
            part |= _HTTP
        self[t] = number = len(self)
        self.bytes.append(code | (ALNUM if c.isalnum() else 0))
        self.hashes.append(hashed)
        self.parts.append(part)
        return number


_kinds = _Kinds()


@dataclass
class Tokens:
    """The tokens of some texts, one text after the other: a byte and a hash each, and what the texts' sentences say."""

    sizes: np.ndarray
    bytes: np.ndarray
    hashes: np.ndarray
    prose: np.ndarray  # by text: most words stand in sentences of at least five words, and it has no bare address


def read_texts(texts: list[str | None]) -> Tokens:
    """Tokens of texts, each read once; null texts have none.

    In sentences, an address is a word, but none of a sentence; a line break
    ends what is no sentence.
    """
    split = [tokens_of(t) if t else [] for t in texts]
    if len(_kinds) > MEMORY:
        _kinds.clear()
    sizes = np.array([len(t) for t in split], np.int64)
    numbers = np.fromiter(map(_kinds.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    codes = np.frombuffer(bytes(_kinds.bytes), np.uint8)[numbers] if len(numbers) else np.zeros(0, np.uint8)
    hashes = np.array(_kinds.hashes)[numbers] if len(numbers) else np.zeros(0, np.uint32)
    parts = np.frombuffer(bytes(_kinds.parts), np.uint8)[numbers] if len(numbers) else np.zeros(0, np.uint8)
    codes = codes | np.where(_recent(hashes, sizes) & (parts & _REPEATABLE > 0), np.uint8(AGAIN), np.uint8(0))
    text = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(text, parts & (_WORD_IN_SENTENCE | _ADDRESS) > 0, len(sizes))
    # A stretch of words ends at a stop, a line break or the end of its text; stops alone make it a sentence.
    ends = parts & (_STOP | _BREAK) > 0
    stretch = np.cumsum(ends) - ends + text
    words = np.bincount(stretch, parts & _WORD_IN_SENTENCE > 0) if len(stretch) else np.zeros(0)
    stops = (parts & _STOP) > 0
    here = words[stretch[stops]]
    good = np.bincount(text[stops], np.where(here >= 5, here, 0), len(sizes))
    share = good / np.maximum(total, 1)
    bare = np.bincount(text, parts & _HTTP > 0, len(sizes)) > 0
    return Tokens(sizes, codes, hashes, (sizes > 0) & (share >= PROSE_SHARE) & ~bare)


def _recent(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a word stands among the NEAR tokens before it in its text."""
    out = np.zeros(len(hashes), bool)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    for d in range(1, min(NEAR, len(hashes) - 1) + 1):
        out[d:] |= (hashes[d:] == hashes[:-d]) & (text[d:] == text[:-d])
    return out & (hashes > 0)


def class_sequence(codes: np.ndarray, hashes: np.ndarray, words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of function words and word classes of tokens; `words` are the function words' hashes in order, `places` their numbers."""
    first = len(words)
    kind = (codes & CLASS_BITS).astype(np.int64)
    out = first + kind
    again = codes & AGAIN > 0
    if first:
        at = np.minimum(np.searchsorted(words, hashes), first - 1)
        known = (words[at] == hashes) & (hashes > 0)
        place = places[at]
        out = np.where(known, place, out)
        again &= ~(known & (place < COMMON))
    unspaced = kind == CLASSES["unspaced"]
    return np.where(again, first + np.where(unspaced, CLASSES["again-unspaced"], CLASSES["again"]), out)


class _Table:
    """Where whole numbers stand in a sorted array, by a table of their hashes; -1 for those that don't."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        self.slots[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)
        # Of keys with one slot the last one holds it; the others are sought.
        self.lost = len(keys) > 0 and bool((self.slots[self._slot(keys)] != np.arange(len(keys))).any())

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int32)
        out = self.slots[self._slot(wanted)]
        other = np.flatnonzero((out >= 0) & (self.keys[out] != wanted))
        if len(other):
            at = np.minimum(np.searchsorted(self.keys, wanted[other]), len(self.keys) - 1)
            out[other] = np.where(self.keys[at] == wanted[other], at, -1)
        return out


def _starts(sizes: np.ndarray) -> np.ndarray:
    """For every token the place of the first one of its text."""
    return np.repeat(np.cumsum(sizes) - sizes, sizes)


def _means(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the values of each text; 0 for one without any."""
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), values, len(sizes)) / np.maximum(sizes, 1)


def stretch_means(costs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every token the mean cost of the stretch around it in its text; a shorter text is one stretch."""
    if not len(costs):
        return costs
    sums = np.concatenate(([0.0], np.cumsum(costs)))
    start, size = _starts(sizes), np.repeat(sizes, sizes)
    wide = np.minimum(size, STRETCH)
    first = start + np.clip(np.arange(len(costs)) - start - STRETCH // 2, 0, size - wide)
    return (sums[first + wide] - sums[first]) / wide


@dataclass
class ProseModel:
    words: np.ndarray  # hashes of the function words, in order
    places: np.ndarray  # their numbers, the commonest first
    keys: np.ndarray  # trigrams of prose, in order
    tri: np.ndarray  # bits of the last class of each of them
    bi: np.ndarray  # bits of the second class of all pairs of classes, if the trigram is none of prose
    low: float = 0.0
    high: float = np.inf

    def __post_init__(self):
        self.table = _Table(self.keys)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    @property
    def size(self) -> int:
        return _size(self.words)

    def costs_of(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last class of every trigram."""
        at = self.table.find(keys)
        n = self.size
        other = self.bi[keys % (n * n)]
        return np.where(at >= 0, self.tri[at], other) if len(self.tri) else other

    def judge_tokens(self, sizes: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By text: bits per token, part of the words in stretches that are no prose, flagged; 0, 0 and False without words."""
        costs = self.costs_of(trigrams(sizes, codes, hashes, self.words, self.places))
        means = stretch_means(costs, sizes)
        is_word = codes & ALNUM > 0
        odd = ((means > self.high) | (means < self.low)) & is_word
        text = np.repeat(np.arange(len(sizes)), sizes)
        words = np.bincount(text, is_word, len(sizes))
        share = np.bincount(text, odd, len(sizes)) / np.maximum(words, 1)
        return np.where(words > 0, _means(costs, sizes), 0.0), share, share > HALF

    def judge(self, text: str) -> tuple[float, float, bool]:
        t = read_texts([text])
        bits, share, flagged = self.judge_tokens(t.sizes, t.bytes, t.hashes)
        return float(bits[0]), float(share[0]), bool(flagged[0])


def _train(words: np.ndarray, places: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> ProseModel:
    """Counts of class trigrams, as bits; `keys` stay the same, whatever their counts are."""
    size = _size(words)

    def conditional(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        pasts, at = np.unique(keys // size, return_inverse=True)
        return counts / np.maximum(np.bincount(at, counts, len(pasts))[at], 1)

    ones = np.bincount(keys % size, counts, size)
    one = (ones + 0.5) / (ones.sum() + 0.5 * size)
    pairs, n = _sums(keys % (size * size), counts)
    two = np.zeros(size * size)
    two[pairs] = conditional(pairs, n)
    p = WEIGHTS[1] * two + np.tile(WEIGHTS[2] * one + WEIGHTS[3] / size, size)
    tri = -np.log2(p[keys % (size * size)] + WEIGHTS[0] * conditional(keys, counts))
    return ProseModel(words, places, keys, tri, -np.log2(p))


def _sums(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, with the sum of their counts."""
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.int64)


def _steps(bits: np.ndarray) -> np.ndarray:
    return np.floor(bits * STEPS).astype(np.int64)


def _quantile(steps: np.ndarray, counts: np.ndarray, part: float) -> int:
    """The least step up to which `part` of all lie."""
    return int(steps[np.searchsorted(np.cumsum(counts), part * counts.sum())])


def _fit(words: np.ndarray, places: np.ndarray, keys: np.ndarray, counts: np.ndarray, tally: Callable, rounds: int) -> ProseModel:
    """The model of all prose texts, of which each is a sequence of places in `keys`, the class trigrams in order.

    `tally(f)` gives the different values of `f(places, sizes)` over texts that
    stand one after the other, in order, with their counts over all texts.
    """

    def kept(x: np.ndarray, sizes: np.ndarray, costs: np.ndarray, limit: int) -> np.ndarray:
        return _steps(_means(costs[x], sizes)) <= limit

    costs, limit = np.zeros(len(keys)), 0
    for _ in range(rounds):
        costs = _train(words, places, keys, counts).tri
        limit = _quantile(*tally(lambda x, sizes: _steps(_means(costs[x], sizes))), 0.95)
        at, n = tally(lambda x, sizes: x[np.repeat(kept(x, sizes, costs, limit), sizes)])
        counts = np.zeros(len(keys), np.int64)
        counts[at] = n
    last = _train(words, places, keys, counts)
    steps, n = tally(lambda x, sizes: _steps(stretch_means(last.tri[x], sizes)[np.repeat(kept(x, sizes, costs, limit), sizes)]))
    known = counts > 0
    low, high = _quantile(steps, n, LOWEST) / STEPS, (_quantile(steps, n, HIGHEST) + 1) / STEPS
    return ProseModel(words, places, keys[known], last.tri[known], last.bi, low, high)


def trigrams(sizes: np.ndarray, codes: np.ndarray, hashes: np.ndarray, words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Class trigrams of texts, one for each token; two classes of their own mark the beginning of a text."""
    size = _size(words)
    x = class_sequence(codes, hashes, words, places)
    place = np.arange(len(x)) - _starts(sizes)
    before = np.concatenate(([0], x[:-1])) if len(x) else x
    last = np.where(place > 0, before, size - 1)
    second = np.where(place > 1, np.concatenate(([0], before[:-1])) if len(x) else x, size - 1)
    return (second * size + last) * size + x


def _size(words: np.ndarray) -> int:
    return len(words) + len(CLASSES) + 1


def _vocabulary(sizes: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, addresses left out, with the number of texts that have them."""
    kept = (hashes > 0) & (codes & CLASS_BITS != CLASSES["URL"])
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)[kept]
    once = np.unique((text << np.uint64(32)) | hashes[kept].astype(np.uint64))
    return np.unique((once & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)


def _function_words(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, places) of the FUNCTION_WORDS words of most texts; of equally common ones the smallest hashes."""
    best = np.lexsort((hashes, -counts))[:FUNCTION_WORDS]
    order = np.argsort(hashes[best])
    return hashes[best][order].astype(np.uint32), order


def fit(texts: list[str], rounds: int = 3) -> ProseModel | None:
    """The prose model of some texts; None if they hold no prose.

    Texts with most words in sentences and without bare addresses are taken for
    prose; after each round the twentieth with the highest perplexity, stuffed
    sentences among them, is set aside.
    """
    t = read_texts(texts)
    words, places = _function_words(*_vocabulary(t.sizes, t.bytes, t.hashes))
    prose = np.repeat(t.prose, t.sizes)
    sizes = t.sizes[t.prose]
    if not len(sizes):
        return None
    keys, rows, counts = np.unique(trigrams(sizes, t.bytes[prose], t.hashes[prose], words, places), return_inverse=True, return_counts=True)
    return _fit(words, places, keys, counts, lambda f: np.unique(f(rows, sizes), return_counts=True), rounds)


_READ = "doc_id bigint, codes binary, hashes binary, prose boolean"


def _parts(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where a column reaches `most` bytes, so that memory stays bounded whatever the texts' lengths are."""
    for batch in batches:
        place = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0), np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def tokens_table(documents: DataFrame) -> DataFrame:
    """(doc_id, codes, hashes, prose) for every row: its tokens as five bytes each, whatever the function words are.

    Texts are cut into tokens once; all that follows works on these numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "text", BYTES):
            t = read_texts(batch.column("text").to_pylist())
            ends = np.cumsum(t.sizes)
            own = lambda x: pa.array([x[e - n : e].tobytes() for e, n in zip(ends, t.sizes)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), own(t.bytes), own(t.hashes), pa.array(t.prose)], names=["doc_id", "codes", "hashes", "prose"]
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _READ)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, codes, hashes) of the texts of a batch."""
    codes = batch.column("codes").to_pylist()
    sizes = np.array([len(c) for c in codes], np.int64)
    return sizes, np.frombuffer(b"".join(codes), np.uint8), np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint32)


def _counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The driver's part of a count by value: rows (value, n) summed up, in the order of the values."""
    done = rows.groupBy("value").agg(F.sum("n").alias("n")).toArrow()
    values, n = (done[c].to_numpy() for c in ("value", "n"))
    order = np.argsort(values)
    return values[order], n[order]


def _value_batch(values: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(n, pa.int64())], names=["value", "n"])


def fit_tokens(read: DataFrame, rounds: int = 3) -> ProseModel | None:
    """The model that `fit` gives for all texts of a tokens_table, which should be kept.

    Only the function words and counts of trigrams and of steps reach the driver.
    """

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "codes", TOKENS):
            yield _value_batch(*_vocabulary(*_tokens(batch)))

    counts = read.mapInArrow(vocabulary, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "value").limit(FUNCTION_WORDS).toArrow()
    words, places = _function_words(np.asarray(top["value"], np.int64), np.asarray(top["n"], np.int64))
    prose = read.where("prose").select("codes", "hashes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "codes", TOKENS):
            yield _value_batch(*np.unique(trigrams(*_tokens(batch), words, places), return_counts=True))

    keys, n = _counted(prose.mapInArrow(count, "value bigint, n bigint"))
    if not len(keys):
        return None
    shared = read.sparkSession.sparkContext.broadcast(keys)

    def in_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Table(shared.value)
        for batch in _parts(batches, "codes", TOKENS):
            sizes, codes, hashes = _tokens(batch)
            found, ends = table.find(trigrams(sizes, codes, hashes, words, places)), np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([pa.array([found[e - k : e].tobytes() for e, k in zip(ends, sizes)], pa.binary())], names=["x"])

    rows = prose.mapInArrow(in_places, "x binary").checkpoint()

    def tally(f: Callable) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches, "x", 4 * TOKENS):
                x = batch.column("x").to_pylist()
                sizes = np.array([len(b) // 4 for b in x], np.int64)
                yield _value_batch(*np.unique(f(np.frombuffer(b"".join(x), np.int32), sizes), return_counts=True))

        return _counted(rows.mapInArrow(run, "value bigint, n bigint"))

    return _fit(words, places, keys, n, tally, rounds)


def fit_prose_model(documents: DataFrame, rounds: int = 3) -> ProseModel | None:
    """The model that `fit` gives for all texts, whole."""
    use_checkpoints(documents.sparkSession)
    return fit_tokens(tokens_table(documents).checkpoint(), rounds)


def scores(documents: DataFrame, model: ProseModel | None = None) -> DataFrame:
    """(doc_id, bits, odd_share, flagged) for every row: bits per token, the part of the words outside prose, the decision.

    Null, empty and blank texts have 0 and 0 and are not flagged; without a
    model (no prose at all) every row has. Repeated rows are scored each.
    """
    read = tokens_table(documents)
    if model is None:
        use_checkpoints(documents.sparkSession)
        read = read.checkpoint()
        model = fit_tokens(read)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _parts(batches, "codes", TOKENS):
            none = np.zeros(batch.num_rows)
            bits, share, flags = known.judge_tokens(*_tokens(batch)) if known is not None else (none, none, none > 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits), pa.array(share), pa.array(flags)], names=["doc_id", "bits", "odd_share", "flagged"])

    return read.mapInArrow(run, "doc_id bigint, bits double, odd_share double, flagged boolean")


def found(documents: DataFrame, model: ProseModel | None = None) -> DataFrame:
    """(doc_id) of every document most of whose words stand outside prose; each once."""
    return scores(documents, model).where("flagged").select("doc_id").distinct()
