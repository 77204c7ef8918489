"""BPE encoding and decoding with a memory-mapped lexicon of frequent words.

1. Frequent words: every task keeps a mergeable Misra-Gries summary of the words of its
   whole texts; the summaries are added up in Spark and the ``LEXICON`` most frequent
   words go to the driver. Only speed depends on this choice, never a result.
2. Lexicon: the words become a minimal acyclic automaton, built from sorted words with
   shared suffixes. Numbers on the arcs add up to a word's place, and that place gives
   its ids: a transducer from words to id sequences. It is shipped as a file and
   memory-mapped by the workers of an executor, which share its pages.
3. Encoding: slices of texts are cut at the special tokens and at white space; what is
   new in a slice is normalised (NFC, lower case) and split as the tokenizer file says.
   All new words walk the automaton side by side, one byte a step, and those that it lacks
   are merged exactly by rank, also side by side, one merge of every word a step. Ids of
   the slice are gathered from those of its distinct chunks.
4. Decoding: the file names no decoder, so decoding joins the pieces of the ids by spaces.

Defined results: a null or empty text has no ids and decodes to the empty string; very
long words are merged in n log n steps; repeated rows stay; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from workwindow.llm.common import mapped_bytes, parts_of, shared_bytes, text_buffers
from workwindow.session import stage

LEXICON = 1 << 16
#: Counters that a task's summary keeps, and chunks that a worker remembers.
SUMMARY, MEMO = 1 << 17, 400_000
#: Longer words are never put in the lexicon.
LONGEST = 64
#: Bytes of text that are encoded at once.
SLICE = 2 << 20

# line breaks, which no chunk holds, come through so that chunks can be split together
_ASCII_WORDS = re.compile(r"\n|[a-z]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^ \t-\ra-z0-9]+").findall
_WORDS = regex.compile(
    r"\n|\p{L}+|\p{N}|'(?:[stmd]|re|ve|ll)|[^\p{White_Space}\p{L}\p{N}]+"
).findall


#: Up to here every library's Unicode tables agree; beyond, unassigned characters may not be.
_LAST_SETTLED = "\u052f"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters for themselves, the others follow from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in visible)
    letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


_BYTE_OF = {c: b for b, c in enumerate(byte_letters())}


_NEVER = np.iinfo(np.int32).max


def _ranks(keys: np.ndarray, ranks: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Ranks of ``pairs`` among sorted ``keys``, ``_NEVER`` of those that do not merge."""
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    return np.where(keys[at] == pairs, ranks[at], _NEVER) if len(keys) else np.full(len(pairs), _NEVER)


class Merges:
    """Vocabulary and ranked merges of a word-end BPE tokenizer file."""

    def __init__(self, tokens: list[str], special: dict[str, int], head: str, pairs: np.ndarray):
        self.tokens, self.special, self.head = tokens, special, head
        ids = {t: i for i, t in enumerate(tokens)}
        self.first = [ids[c] for c in byte_letters()]
        self.last = [ids[c + "</w>"] for c in byte_letters()]
        self.rank = {a << 20 | b: i for i, (a, b) in enumerate(pairs[:, :2].tolist())}
        self.made = pairs[:, 2].tolist()
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")").split

    def words_of(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """Normalised words of chunks without white space or special tokens, and how many
        each chunk has. A line break composes with no character, so chunks joined by line
        breaks are normalised as they are alone."""
        words, counts = [], np.zeros(len(chunks), np.int64)
        place: list[np.ndarray] = []
        for which, split in self._kinds(chunks):
            if which:
                found = split("\n".join([chunks[i] for i in which]))
                breaks = np.flatnonzero(np.asarray(pc.equal(pa.array(found, pa.string()), "\n")))
                ends = np.append(breaks, len(found))
                sizes = np.diff(np.append(-1, ends)) - 1
                counts[which] = sizes
                words += [w for w in found if w != "\n"]
                place.append(np.repeat(which, sizes))
        order = np.argsort(np.concatenate(place), kind="stable") if place else np.zeros(0, np.int64)
        return [words[i] for i in order.tolist()] if len(place) > 1 else words, counts

    def _kinds(self, chunks: list[str]):
        """Numbers of the chunks of each kind, with the function that splits them."""
        ascii_ = [c.isascii() for c in chunks]
        plain = [i for i, yes in enumerate(ascii_) if yes]
        wide, young = [i for i, yes in enumerate(ascii_) if not yes], []
        unknown = {
            c for c in set().union(*(chunks[i] for i in wide)) if c > _LAST_SETTLED and unicodedata.category(c) == "Cn"
        }
        if unknown:
            young = [i for i in wide if not unknown.isdisjoint(chunks[i])]
            wide = [i for i in wide if unknown.isdisjoint(chunks[i])]
        yield plain, lambda text: _ASCII_WORDS(text.lower())
        # one character at a time: no word-final form of sigma
        yield wide, lambda text: _WORDS(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        # characters younger than Python's tables: the file's own steps decide
        yield young, self._by_file

    def _by_file(self, text: str) -> list[str]:
        steps, out = self.steps(), []
        for chunk in text.split("\n"):
            pieces = steps.pre_tokenizer.pre_tokenize_str(steps.normalizer.normalize_str(chunk))
            out += ["\n", *(bytes(map(_BYTE_OF.__getitem__, piece)).decode() for piece, _ in pieces)]
        return out[1:]

    @functools.cache
    def steps(self) -> Tokenizer:
        """The normalizer and the splitter of the tokenizer file, without its model."""
        return Tokenizer.from_str(self.head)

    @classmethod
    def parse(cls, content: bytes) -> Merges:
        file = json.loads(content)
        vocab = file["model"]["vocab"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in file["model"]["merges"]]
        empty = {"type": "BPE", "vocab": {}, "merges": []}
        head = json.dumps(file | {"model": empty, "added_tokens": []})
        return cls(tokens, special, head, np.array(pairs, np.int64))

    def dump(self) -> bytes:
        pairs = [(k >> 20, k & 0xFFFFF, m) for k, m in zip(self.rank, self.made)]
        return json.dumps([self.tokens, self.special, self.head, pairs]).encode()

    @classmethod
    def load(cls, content: bytes) -> Merges:
        tokens, special, head, pairs = json.loads(content)
        return cls(tokens, special, head, np.array(pairs, np.int64))

    def segments(self, column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Texts cut at special tokens: the pieces, the id of the special token that a piece
        stands for (-1: none, else the piece is empty), and where each row's pieces start."""
        if column.null_count:
            column = column.fill_null("")
        if not any(pc.any(pc.match_substring(column, token)).as_py() for token in self.special):
            return column, np.full(len(column), -1), np.arange(len(column) + 1)
        pieces, marks, rows = [], [], [0]
        for text in column.to_pylist():
            for piece in self.split(text):
                mark = self.special.get(piece, -1)
                pieces.append("" if mark >= 0 else piece)
                marks.append(mark)
            rows.append(len(pieces))
        return pa.array(pieces, pa.string()), np.array(marks), np.array(rows)

    @functools.cache
    def _tables(self) -> tuple[np.ndarray, ...]:
        """Ids of first and last bytes, ranks of byte pairs (the second first or last), keys
        of merges in order and their ranks."""
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        first, last = np.array(self.first), np.array(self.last)
        keys, ranks = keys[order], order.astype(np.int32)
        pairs = first[:, None] << 20 | np.append(first, last)[None, :]
        return first, last, _ranks(keys, ranks, pairs.ravel()).reshape(pairs.shape), keys, ranks

    def encode_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at byte ranges of ``data`` one after the other, and how many each
        has. Every step merges, in all words, the leftmost pair of the word's lowest rank."""
        first, last, of_bytes, keys, ranks = self._tables()
        made = np.array(self.made)
        size = ends - starts
        long = np.flatnonzero(size > 48)
        done = [(np.full(len(ids), i), np.array(ids)) for i in long for ids in [self.encode_word(bytes(data[starts[i] : ends[i]]))]]
        which = np.flatnonzero((size > 0) & (size <= 48))
        size = size[which]
        word = np.repeat(np.arange(len(which)), size)
        stop = np.cumsum(size)
        at = np.arange(len(word)) + np.repeat(starts[which] - (stop - size), size)
        byte = data[at].astype(np.int64)
        closing = np.zeros(len(word), bool)
        closing[stop - 1] = True
        symbol = np.where(closing, last[byte], first[byte])
        rank = np.full(len(word), _NEVER, np.int32)
        rank[:-1] = of_bytes[byte[:-1], byte[1:] + 256 * closing[1:]]
        rank[closing] = _NEVER
        while len(word):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(begin, len(word)))
            lowest = np.minimum.reduceat(rank, begin)
            ready = lowest == _NEVER
            if ready.any():
                out = np.repeat(ready, size)
                done.append((which[word[out]], symbol[out]))
                word, symbol, rank = word[~out], symbol[~out], rank[~out]
                size, lowest = size[~ready], lowest[~ready]
            if not len(word):
                break
            hits = np.flatnonzero(rank == np.repeat(lowest, size))
            hits = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]
            symbol[hits] = made[lowest]
            stay = np.ones(len(word), bool)
            stay[hits + 1] = False
            word, symbol, rank = word[stay], symbol[stay], rank[stay]
            hits -= np.arange(len(hits))
            for left in (hits, hits[(hits > 0) & (word[hits - 1] == word[hits])] - 1):
                right = np.minimum(left + 1, len(word) - 1)
                pair = np.where((word[right] == word[left]) & (right > left), symbol[left] << 20 | symbol[right], -1)
                rank[left] = _ranks(keys, ranks, pair)
        word = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in done)])
        ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i in done)])
        return ids[np.argsort(word, kind="stable")].astype(np.uint32), np.bincount(word, minlength=len(starts))

    def encode_word(self, word: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ids = [self.first[b] for b in word[:-1]] + [self.last[word[-1]]]
        return self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank, none = self.rank.get, len(self.made)
        ranks = [rank(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (lowest := min(ranks)) < none:
            i = ranks.index(lowest)
            ids[i : i + 2] = [self.made[lowest]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 20 | ids[i], none)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 20 | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n, rank = len(ids), self.rank
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or rank.get(ids[i] << 20 | ids[j]) != r:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    if (found := rank.get(ids[k] << 20 | ids[after[k]])) is not None:
                        heapq.heappush(heap, (found, k))
        return [x for x in ids if x >= 0]


class Lexicon:
    """Words to id sequences in a minimal acyclic automaton, read in place.

    Layout: five counts, then the arrays of arc starts of states, arc targets, arc
    numbers, starts of id sequences, ids, arc keys (state and label, ascending), then final
    flags and arc labels (bytes).
    """

    @staticmethod
    def compile(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
        """``entries`` sorted by word, each word once."""
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        words: list[int] = []  # accepted from each state

        def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in known:
                known[key] = len(states)
                states.append(key)
                words.append(final + sum(words[t] for _, t in arcs))
            return known[key]

        # the path of the last word, from the root: [final, arcs, label to here]
        path: list[list] = [[False, [], 0]]

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs, label = path.pop()
                path[-1][1].append((label, freeze(final, arcs)))

        previous, starts, ids = b"", [0], []
        for word, sequence in entries:
            same = next((i for i, (a, b) in enumerate(zip(word, previous)) if a != b), min(len(word), len(previous)))
            close(same)
            path.extend([False, [], byte] for byte in word[same:])
            path[-1][0] = True
            previous = word
            ids.extend(sequence)
            starts.append(len(ids))
        close(0)
        root = freeze(path[0][0], path[0][1])

        arc_starts, targets, numbers, labels, keys = [0], [], [], bytearray(), []
        for state, (final, arcs) in enumerate(states):
            number = int(final)
            for label, target in arcs:
                labels.append(label)
                keys.append(state << 8 | label)
                targets.append(target)
                numbers.append(number)
                number += words[target]
            arc_starts.append(len(targets))
        head = [len(states), len(targets), len(starts), len(ids), root]
        finals = bytes(final for final, _ in states)
        return np.array([*head, *arc_starts, *targets, *numbers, *starts, *ids, *keys], np.int32).tobytes() + finals + labels

    def __init__(self, data: mmap.mmap | bytes):
        self.data = data
        n_states, n_arcs, n_starts, n_ids, self.root = np.frombuffer(data, np.int32, 5).tolist()
        at = 20
        parts = []
        for n in (n_states + 1, n_arcs, n_arcs, n_starts, n_ids, n_arcs):
            parts.append(np.frombuffer(data, np.int32, n, at))
            at += 4 * n
        self.arcs, self.targets, self.numbers, self.starts, self.ids, self.keys = parts
        self.finals = np.frombuffer(data, np.bool_, n_states, at)
        self.labels_at = at + n_states

    def find(self, word: bytes) -> list[int] | None:
        data = np.frombuffer(word, np.uint8)
        place = int(self.find_all(data, np.array([0]), np.array([len(word)]))[0])
        return self.ids[self.starts[place] : self.starts[place + 1]].tolist() if place >= 0 else None

    def find_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the words at byte ranges of ``data``, -1 of those that it lacks."""
        places = np.full(len(starts), -1)
        which = np.flatnonzero(ends - starts <= LONGEST)
        at, state = starts[which], np.full(len(which), self.root)
        number = np.zeros(len(which), np.int64)
        while len(which):
            over = at == ends[which]
            final = over & self.finals[state]
            places[which[final]] = number[final]
            if not len(self.keys):
                break
            which, at, state, number = which[~over], at[~over], state[~over], number[~over]
            key = state << 8 | data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            which, at, arc = which[hit], at[hit] + 1, arc[hit]
            state, number = self.targets[arc].astype(np.int64), number[hit] + self.numbers[arc]
        return places


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranges of ``flat`` one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class Encoder:
    """Columns of texts to ids, and back to the bytes of the decoded texts.

    Remembers ids of at most ``MEMO`` chunks, of 16 ids on average, and those of one
    slice, then starts anew.
    """

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        pieces = pa.array([token + " " for token in merges.tokens], pa.large_string())
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other (unsigned 32-bit), and where each row starts."""
        pieces, marks, rows = self.merges.segments(column)
        chunks = pc.ascii_split_whitespace(pieces)
        coded = chunks.flatten().dictionary_encode()
        at = self._at(coded.dictionary.to_numpy(False).tolist())[np.asarray(coded.indices)]
        sizes = self.sizes[at]
        ids = _gather(self.flat, self.starts[at], sizes)
        ends = np.append(0, np.cumsum(sizes))
        offsets = np.asarray(chunks.offsets)
        starts = ends[offsets - offsets[0]]
        special = marks >= 0
        if special.any():
            ids = np.insert(ids, starts[:-1][special], marks[special])
            starts = starts + np.append(0, np.cumsum(special))
        return ids, starts[rows]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[memoryview]:
        """Per row the pieces of its ids joined by spaces, as UTF-8."""
        taken = self.pieces.take(pa.array(ids))
        data, offsets = text_buffers(taken)
        view, cut = memoryview(data), offsets[starts].tolist()
        return [view[a : max(a, b - 1)] for a, b in zip(cut, cut[1:])]

    def _at(self, chunks: list[str]) -> np.ndarray:
        """Where the ids of the chunks are remembered."""
        known = self.places.get
        found = np.array([known(c, -1) for c in chunks], np.int64)
        missing = np.flatnonzero(found < 0)
        if len(self.sizes) + len(missing) > MEMO or len(self.flat) > 16 * MEMO:
            self._forget()
            missing = np.arange(len(chunks))
        if len(missing):
            new = [chunks[i] for i in missing.tolist()]
            ids, sizes = self._ids_of(new)
            found[missing] = len(self.sizes) + np.arange(len(missing))
            self.places.update(zip(new, found[missing].tolist()))
            self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
            self.sizes, self.flat = np.append(self.sizes, sizes), np.append(self.flat, ids)
        return found

    def _ids_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and how many each has."""
        words, counts = self.merges.words_of(chunks)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        data, offsets = text_buffers(coded.dictionary)
        place = self.lexicon.find_all(data, offsets[:-1], offsets[1:])
        lacking = np.flatnonzero(place < 0)
        merged, n_merged = self.merges.encode_all(data, offsets[lacking], offsets[lacking + 1])
        listed = np.append(self.lexicon.ids.view(np.uint32), merged)
        starts, sizes = self.lexicon.starts[place].astype(np.int64), np.zeros(len(place), np.int64)
        known = place >= 0
        sizes[known] = self.lexicon.starts[place[known] + 1] - starts[known]
        starts[lacking] = len(self.lexicon.ids) + np.cumsum(n_merged) - n_merged
        sizes[lacking] = n_merged
        word = np.asarray(coded.indices)
        upto = np.append(0, np.cumsum(sizes[word]))[np.append(0, np.cumsum(counts))]
        return _gather(listed, starts[word], sizes[word]), np.diff(upto)


def frequent_words(documents: DataFrame, tokenizer_path: str, size: int = LEXICON) -> list[str]:
    """The words that a summary of all texts finds most frequent, at most ``size``.

    A task counts what stands between white space; when it holds more than twice ``SUMMARY`` counters it
    lowers all of them by the count of the one after the largest ``SUMMARY`` and drops
    those at zero. What has a larger share than 1 / ``SUMMARY`` of a task always stays.
    """
    name = _ship_merges(documents.sparkSession, tokenizer_path)

    def lower(counts: Counter, keep: int) -> Counter:
        if len(counts) <= keep:
            return counts
        floor = heapq.nlargest(keep + 1, counts.values())[-1]
        return Counter({w: n - floor for w, n in counts.items() if n > floor})

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges_of(name)
        chunks: Counter = Counter()
        for part in parts_of(batches, "text", SLICE):
            pieces, _, _ = merges.segments(part.column("text"))
            seen = pc.ascii_split_whitespace(pieces).flatten().value_counts()
            for chunk, n in zip(seen.field(0).to_numpy(False).tolist(), seen.field(1).to_numpy(False).tolist()):
                chunks[chunk] += n
            if len(chunks) > 2 * SUMMARY:
                chunks = lower(chunks, SUMMARY)
        counts: Counter = Counter()
        words, n_words = merges.words_of(list(chunks))
        for word, n in zip(words, np.repeat(np.fromiter(chunks.values(), np.int64, len(chunks)), n_words).tolist()):
            counts[word] += n
        kept = [(w, n) for w, n in lower(counts, size).items() if len(w) <= LONGEST // 4]
        for i in range(0, len(kept), 10_000):
            words, numbers = zip(*kept[i : i + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"]
            )

    counts = (
        documents.select("text")
        .mapInArrow(summarise, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counts = stage(counts, "bpe-words")
    # the count from which on there are ``size`` words, to an eighth of a power of e:
    # else every task would send as many words to the driver
    bins = counts.groupBy(F.floor(F.log("n") * 8).alias("bin")).agg(F.count("*").alias("words"))
    cutoff, found = 0, 0
    for row in bins.orderBy(F.desc("bin")).collect():
        cutoff, found = row.bin, found + row.words
        if found >= size:
            break
    often = counts.filter(F.floor(F.log("n") * 8) >= cutoff)
    return [r.word for r in stage(often.orderBy(F.desc("n"), "word").limit(size), "bpe-lexicon").collect()]


@functools.cache
def _parsed(tokenizer_path: str) -> Merges:
    with open(tokenizer_path, "rb") as file:
        return Merges.parse(file.read())


def _ship_merges(spark: SparkSession, tokenizer_path: str) -> str:
    return shared_bytes(spark, "merges", _parsed(tokenizer_path).dump())


@functools.lru_cache(1)
def _merges_of(name: str) -> Merges:
    return Merges.load(mapped_bytes(name)[:])


@functools.lru_cache(1)
def encoder_of(merges: str, lexicon: str) -> Encoder:
    """The encoder of a worker, made once."""
    return Encoder(_merges_of(merges), Lexicon(mapped_bytes(lexicon)))


def ship(spark: SparkSession, tokenizer_path: str, words: list[str]) -> tuple[str, str]:
    """Compile the lexicon of ``words`` and ship it with the merges."""
    merges = _parsed(tokenizer_path)
    raw = sorted({w.encode() for w in words if w})
    lexicon = Lexicon.compile((w, merges.encode_word(w)) for w in raw)
    return _ship_merges(spark, tokenizer_path), shared_bytes(spark, "lexicon", lexicon)


def encode_documents(
    documents: DataFrame, tokenizer_path: str, words: list[str] | None = None, decode: bool = True
) -> DataFrame:
    """doc_id, ids (array<int>) and, if wanted, decoded of every row of ``documents``
    (doc_id, text)."""

    def rows(part: pa.RecordBatch, encoder: Encoder) -> list[pa.Array]:
        ids, starts = encoder.encode(part.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.view(np.int32)))
        texts = [str(text, "utf-8") for text in encoder.decode(ids, starts)] if decode else []
        return [lists, *([pa.array(texts, pa.string())] if decode else [])]

    schema = "ids array<int>" + ", decoded string" * decode
    return _encoded(documents, tokenizer_path, words, rows, schema)


def encode_digests(documents: DataFrame, tokenizer_path: str, words: list[str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, without sending ids
    or pieces back to Spark."""

    def rows(part: pa.RecordBatch, encoder: Encoder) -> list[pa.Array]:
        ids, starts = encoder.encode(part.column("text"))
        raw, cut = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * starts).tolist()
        sha256 = hashlib.sha256
        return [
            pa.array(np.diff(starts), pa.int64()),
            pa.array([sha256(raw[a:b]).hexdigest() for a, b in zip(cut, cut[1:])], pa.string()),
            pa.array([sha256(text).hexdigest() for text in encoder.decode(ids, starts)], pa.string()),
        ]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _encoded(documents, tokenizer_path, words, rows, schema)


def _encoded(documents: DataFrame, tokenizer_path: str, words, rows, schema: str) -> DataFrame:
    if words is None:
        words = frequent_words(documents, tokenizer_path)
    names = ship(documents.sparkSession, tokenizer_path, words)
    columns = ["doc_id", *(c.split()[0] for c in schema.split(", "))]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(*names)
        for part in parts_of(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *rows(part, encoder)], columns)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, {schema}")
