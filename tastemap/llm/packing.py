r"""Operator 9, order-preserving packing into sequences of at most 4096 tokens.

Documents are tokenised with a public vocabulary, closed by one end id and laid end to end
in table order, one stream per scan task. Windows are cut by dynamic programming: a cut may
fall at a document end (free), a sentence end (``SENTENCE_COST``) or, in long runs without
either, every ``HARD_STEP`` ids (``HARD_COST``); a window costs its padding plus
``SEQUENCE_COST``. With ``P[j]`` the stream position of cut j,

    f[j] = cost(j) + min over P[j] - P[i] <= 4096 of f[i] + 4096 - (P[j] - P[i])

is a sliding-window minimum of ``f[i] + P[i]``, kept in a monotone queue, so each cut costs
constant time. Windows whose length is a power of two need no padding; those transitions
are added apart.

A stream is solved in blocks: all windows up to the cheapest cut near a block's end are
emitted and the rest is carried on, so memory holds one block and one document. Tasks do
not exchange anything; a sequence id is the task's number and the window's number in it, so
a repeated task gives the same rows. The last window of a stream is split into powers of
two when that costs less than its padding.

Edge cases: a null or empty text is the end id alone; a text longer than a window is cut; a
run without sentence ends is cut hard; repeated rows are packed each; an empty table gives
no sequences; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm._common import mix64, read_table, rows, text_bytes

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
WINDOW = 4096
BLOCK = 1 << 18
SENTENCE_COST = 8
HARD_COST = 48
HARD_STEP = 64
SEQUENCE_COST = 32
EXACT = (2048, 1024, 512, 256)  # shorter powers of two only end a stream
CACHE_WORDS = 1_500_000


_TAIL = ".,!?;:"
#: A word of one id, put between words that are encoded together.
_MARK = "~"
#: Longer words are encoded wherever they occur; texts are taken so many bytes at a time.
LONGEST = 48
SLICE = 1 << 20

_SPACE, _TAIL_BYTE, _PLAIN = (np.isin(np.arange(256), list(chars)) for chars in (
    b" \t\n\x0b\x0c\r", _TAIL.encode(), b"abcdefghijklmnopqrstuvwxyz0123456789"))
_WEIGHTS = [np.cumprod(np.full(LONGEST, odd, np.uint64)) for odd in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


class WordStore:
    """Ids of known words by a 64-bit hash, checked by a second one: sorted arrays (about 35
    bytes a word), the newest words in a smaller pair of arrays that is merged now and then."""

    RECENT = 1 << 15

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.empty(0, np.uint64)
        self._layers = [(none, none, none, none)] * 2  # keys, checks, starts in the pool, lengths
        self._pool, self._used = np.empty(1 << 16, "<u4"), 0

    def __len__(self) -> int:
        return sum(len(layer[0]) for layer in self._layers)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the keys are known, and where their ids lie in ``pool``."""
        known = np.zeros(len(keys), bool)
        starts, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for held, held_checks, held_starts, held_lengths in self._layers:
            if len(held):
                at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                hit = (held[at] == keys) & (held_checks[at] == checks)
                known |= hit
                starts[hit], lengths[hit] = held_starts[at[hit]], held_lengths[at[hit]]
        return known, starts, lengths

    @property
    def pool(self) -> np.ndarray:
        return self._pool

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """New words in ascending order of key, with their ids one after the other."""
        if self._used + len(ids) > len(self._pool):
            self._pool = np.concatenate([self._pool[:self._used], np.empty(self._used // 2 + len(ids), "<u4")])
        self._pool[self._used:self._used + len(ids)] = ids
        new = keys, checks, (self._used + np.cumsum(lengths) - lengths).astype(np.uint32), lengths.astype(np.uint32)
        self._used += len(ids)
        self._layers[1] = self._merged(self._layers[1], new)
        if len(self._layers[1][0]) > self.RECENT:
            self._layers = [self._merged(*self._layers), tuple(column[:0] for column in new)]

    @staticmethod
    def _merged(one: tuple, other: tuple) -> tuple:
        at = np.searchsorted(one[0], other[0])
        return tuple(np.insert(a, at, b) for a, b in zip(one, other)) if len(one[0]) else other


class WordTokenizer:
    """Token ids by word. The tokenizer lower-cases, drops white space, never joins what it
    separates and parts letters and digits from punctuation, so a text's ids are those of
    its words in a row, and a word's those of its stem and its closing punctuation. Ids are
    kept by word in a ``WordStore`` (emptied when it holds CACHE_WORDS), so each word is encoded
    about once. A text with ``<|``, where special tokens may stand, is encoded whole."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        self._tokenizer = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        mark = self._tokenizer.encode(_MARK, add_special_tokens=False).ids
        self._mark = mark[0] if len(mark) == 1 else None
        self._store = WordStore()
        self.ends_sentence = np.zeros(self._tokenizer.get_vocab_size(), bool)
        for token, number in self._tokenizer.get_vocab().items():
            bare = token.removesuffix("</w>").rstrip("\"')]")
            self.ends_sentence[number] = token.endswith("</w>") and bare[-1:] in (".", "!", "?")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(made.ids, "<u4") for made in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, from one text with a mark between them; one by one if a word
        holds the mark itself."""
        if self._mark is not None:
            ids, = self._whole([f" {_MARK} ".join(words)])
            cuts = np.flatnonzero(ids == self._mark)
            if len(cuts) == len(words) - 1:
                edges = [-1, *cuts.tolist(), len(ids)]
                return [ids[a + 1:b] for a, b in zip(edges, edges[1:])]
        return self._whole(words)

    def _learn(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words that are not in the store."""
        parts: list[tuple[str, ...]] = []
        for word in words:
            text = word.decode()
            stem = text.rstrip(_TAIL)
            apart = stem and len(stem) < len(text) and unicodedata.category(stem[-1])[0] in "LN"
            parts.append((stem, text[len(stem):]) if apart else (text,))
        new = list({p for found in parts for p in found})
        known: dict[str, np.ndarray] = {}
        for at in range(0, len(new), 1000):
            known.update(zip(new[at:at + 1000], self._encoded(new[at:at + 1000])))
        return [known[p[0]] if len(p) == 1 else np.concatenate([known[x] for x in p]) for p in parts]

    def _slice(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a lower-cased text, and for each of its words the end byte and the number
        of ids up to there."""
        raw = np.frombuffer(data, np.uint8)
        inside = ~_SPACE[raw]
        edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        starts, ends = edges[::2], edges[1::2]
        # closing punctuation behind a plain letter or digit is a word of its own
        place = np.arange(len(raw))
        stem_end = np.maximum.accumulate(np.where(_TAIL_BYTE[raw], -1, place))[ends - 1] + 1 if len(ends) else ends
        apart = (stem_end > starts) & (stem_end < ends)
        apart[apart] = _PLAIN[raw[stem_end[apart] - 1]]
        cut = stem_end[apart]
        starts, ends = np.sort(np.r_[starts, cut]), np.sort(np.r_[ends, cut])
        if not len(starts):
            return np.empty(0, "<u4"), ends, ends
        lengths = ends - starts
        short = np.flatnonzero(lengths <= LONGEST)
        word = np.repeat(np.arange(len(short)), lengths[short])
        first = np.cumsum(lengths[short]) - lengths[short]
        within = np.arange(len(word)) - first[word]
        value = raw[starts[short][word] + within].astype(np.uint64) + np.uint64(1)
        keys, checks = (mix64(np.add.reduceat(value * w[within], first)) if len(first) else np.empty(0, np.uint64)
                        for w in _WEIGHTS)
        keys, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
        different = checks != checks[at][inverse]  # two words of one key in this text
        checks = checks[at]
        known, where, size = self._store.find(keys, checks)
        long = np.r_[np.flatnonzero(lengths > LONGEST), short[different]]
        new = np.flatnonzero(~known)
        asked = np.r_[short[at[new]], long]
        made = self._learn([data[a:b] for a, b in zip(starts[asked].tolist(), ends[asked].tolist())])
        # the ids of this text's different words, then of its long ones
        fresh = np.concatenate([np.empty(0, "<u4"), *made])
        fresh_size = np.array([len(m) for m in made], np.int64)
        fresh_start = np.cumsum(fresh_size) - fresh_size
        took = size[known]
        held = self._store.pool[np.repeat(where[known] - (np.cumsum(took) - took), took) + np.arange(took.sum())]
        pool = np.concatenate([held, fresh])
        pool_start, pool_size = np.empty(len(keys), np.int64), size
        pool_start[known] = np.cumsum(took) - took
        pool_start[new], pool_size[new] = len(held) + fresh_start[:len(new)], fresh_size[:len(new)]
        begin, count = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        begin[short], count[short] = pool_start[inverse], pool_size[inverse]
        begin[long], count[long] = len(held) + fresh_start[len(new):], fresh_size[len(new):]
        upto = np.cumsum(count)
        ids = pool[np.repeat(begin - (upto - count), count) + np.arange(upto[-1])]
        if len(new):
            n = int(fresh_size[:len(new)].sum())
            self._store.add(keys[new], checks[new], fresh[:n], fresh_size[:len(new)])
        return ids, ends, upto

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        group: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if len(self._store) > CACHE_WORDS:
                self._store.clear()
            ids, ends, upto = self._slice(b" ".join(lowered))
            edges = np.cumsum([len(t) + 1 for t in lowered])
            words = np.searchsorted(ends, edges, "left")  # words that end within each text
            at = np.r_[0, upto][words].tolist()
            for i, a, b in zip(group, [0, *at], at):
                out[i].append(ids[a:b])
            group.clear()
            lowered.clear()
            size = 0

        lowered: list[bytes] = []
        for i, text in enumerate(texts):
            if b"<|" in text:
                out[i] += self._whole([text.decode()])
                continue
            text = text.lower()  # A-Z
            start = 0
            while start < len(text):
                stop = min(len(text), start + SLICE)
                while stop < len(text) and not _SPACE[text[stop]]:
                    stop += 1
                group.append(i)
                lowered.append(text[start:stop])
                size += stop - start
                start = stop
                if size >= SLICE:
                    flush()
        if group:
            flush()
        return [x[0] if len(x) == 1 else np.concatenate([np.empty(0, "<u4"), *x]) for x in out]


@functools.cache
def tokenizer(vocabulary: str) -> WordTokenizer:
    return WordTokenizer(vocabulary)


def cut_positions(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of a stream (0 first, its length last) and what a cut there costs."""
    total = len(ids)
    at = np.concatenate([[0], np.flatnonzero(ends_sentence[ids]) + 1, doc_ends, [total]])
    at = np.unique(at)
    gaps = np.flatnonzero(np.diff(at) > 4 * HARD_STEP)
    if len(gaps):
        at = np.unique(np.concatenate([at] + [np.arange(at[g] + HARD_STEP, at[g + 1], HARD_STEP) for g in gaps]))
    cost = np.full(len(at), HARD_COST)
    cost[np.concatenate([[False], ends_sentence[ids[at[1:] - 1]]])] = SENTENCE_COST
    cost[np.isin(at, doc_ends)] = 0
    cost[0] = 0
    return at, cost


def best_cuts(at: np.ndarray, cost: np.ndarray, final: bool, window: int = WINDOW) -> list[int]:
    """Stream positions of the cheapest cuts. ``final``: the last cut is the stream's end;
    otherwise it is the cheapest one in the last window. Gaps must not exceed ``window``."""
    exact: dict[int, list[int]] = {}
    for length in EXACT:
        if length < window:
            before = np.minimum(np.searchsorted(at, at - length), len(at) - 1)
            for j in np.flatnonzero(at[before] == at - length).tolist():
                exact.setdefault(j, []).append(int(before[j]))
    place, price = at.tolist(), cost.tolist()
    f, back = [0] * len(place), [0] * len(place)
    queue = deque([(0, 0)])  # (f[i] + P[i], i), increasing in both
    for j in range(1, len(place)):
        p = place[j]
        while place[queue[0][1]] < p - window:
            queue.popleft()
        value, i = queue[0]
        value += window - p
        for k in exact.get(j, ()):
            if f[k] < value:
                value, i = f[k], k
        value += price[j] + SEQUENCE_COST
        f[j], back[j] = value, i
        value += p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    j = len(place) - 1
    if not final:
        near = range(int(np.searchsorted(at, max(1, place[-1] - window))), len(place))
        j = min(near, key=lambda k: f[k])
    out = [place[j]]
    while j:
        j = back[j]
        out.append(place[j])
    return out[::-1]


def split_tail(length: int, window: int = WINDOW) -> list[int]:
    """Lengths for a stream's last window: powers of two if they cost less than padding."""
    powers = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    cheaper = len(powers) * (SEQUENCE_COST + HARD_COST) < window - length
    return powers if cheaper else [length]


class Stream:
    """Documents laid end to end; ``add`` and ``close`` give the pieces that are decided:
    ``doc_id, start, length, doc_tokens, sequence, offset, ids``."""

    def __init__(self, ends_sentence: np.ndarray):
        self._ends_sentence = ends_sentence
        self._parts: list[np.ndarray] = []
        self._docs: list[tuple] = []  # doc_id, tokens, start within the document, length here
        self._size = self._sequence = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        for start in range(0, len(ids), BLOCK):
            part = ids[start:start + BLOCK]
            self._parts.append(part)
            self._docs.append((doc_id, len(ids), start, len(part)))
            self._size += len(part)
            if self._size >= BLOCK:
                yield from self._solve(False)

    def close(self) -> Iterator[tuple]:
        if self._size:
            yield from self._solve(True)

    def _solve(self, final: bool) -> Iterator[tuple]:
        ids = np.concatenate(self._parts)
        edges = np.concatenate([[0], np.cumsum([d[3] for d in self._docs])])
        closed = [s + n == total for _, total, s, n in self._docs]
        cuts = best_cuts(*cut_positions(ids, edges[1:][closed], self._ends_sentence), final)
        if final:
            tail = cuts.pop()
            cuts += (cuts[-1] + np.cumsum(split_tail(tail - cuts[-1]))).tolist()
        d = 0
        for a, b in zip(cuts, cuts[1:]):
            at = a
            while at < b:
                while edges[d + 1] <= at:
                    d += 1
                doc_id, total, start, _ = self._docs[d]
                end = min(b, int(edges[d + 1]))
                yield (doc_id, start + at - int(edges[d]), end - at, total, self._sequence, at - a, ids[at:end].tobytes())
                at = end
            self._sequence += 1
        done = cuts[-1]
        d = int(np.searchsorted(edges, done, "right")) - 1
        rest = self._docs[d:]
        if rest:
            doc_id, total, start, n = rest[0]
            gone = done - int(edges[d])
            rest[0] = (doc_id, total, start + gone, n - gone)
        self._docs = [x for x in rest if x[3]]
        self._parts = [ids[done:]] if done < len(ids) else []
        self._size = len(ids) - done


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian unsigned 32-bit values.
    A document cut twice within one window run at a block's edge stays one piece per window."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        stream = Stream(coder.ends_sentence)
        first = TaskContext.get().partitionId() << 33
        end = np.uint32(END_ID)

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*pieces)]
            columns[4] = [first + s for s in columns[4]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.binary()])],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = list(rows(batch.slice(at, 64), "id", "text"))
                pieces = []
                for (doc_id, _), coded in zip(part, coder.encode([t for _, t in part])):
                    pieces += merged(stream.add(doc_id, np.append(coded, end)))
                if pieces:
                    yield batch_of(pieces)
        if pieces := list(merged(stream.close())):
            yield batch_of(pieces)

    return text_bytes(docs).mapInArrow(pack, PIECES)


def merged(pieces: Iterator[tuple]) -> Iterator[tuple]:
    """Join neighbouring pieces of one document in one window (a very long document comes
    in slices)."""
    last = None
    for x in pieces:
        if last and x[4] == last[4] and x[0] == last[0] and x[5] and x[1] == last[1] + last[2] \
                and x[3] == last[3]:
            last = (*last[:2], last[2] + x[2], *last[3:6], last[6] + x[6])
            continue
        if last:
            yield last
        last = x
    if last:
        yield last


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(read_table(spark, sf_dir, "documents")))
