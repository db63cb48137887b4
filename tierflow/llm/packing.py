"""Cost-balanced packing of token sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n ** 2``, as attention within it does. Documents
are read in groups of bounded size; in each, pieces are taken in descending length and given to the
sequence with the lowest cost so far that still has room for them. Sequences have ``capacity`` tokens,
and what is left of a group is covered by sequences whose lengths are the powers of two it is made of,
so a group's sequences hold its tokens exactly. A piece that fits nowhere whole is cut at the room of
the cheapest sequence that has any.

Each task packs the documents it reads, so no text or token is shuffled; a task that is run again makes
the same sequences under the same ids.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tierflow.llm.common import bytes_of, texts

CAPACITY = 2048
END_ID = 1
#: Tokens packed together; bounds a task's memory.
GROUP_TOKENS = 4_000_000
#: Cost of a token, and of a pair of tokens: a pair weighs as much as in a model of width 1024.
LINEAR, QUADRATIC = 1.0, 1.0 / 6144
#: Words whose ids a worker remembers.
CACHE_WORDS = 800_000
VOCABULARY = "word_bpe_49k.json"


def _byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable ones as they are, then from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class WordIds:
    """Ids of whole texts, tokenised word by word and remembered.

    The tokenizer never joins what white space separates, and it lower-cases; so a text's ids are those
    of its words, and words may be looked up with A-Z lower-cased unless they could hold a special token.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.limit = limit
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Words of Latin letters alone are one token sequence of the model; others take the whole tokenizer."""
        other = []
        for word in words:
            if word.isalpha():
                letters = word.lower().decode()
            else:
                text = word.decode("utf-8", "replace")
                if not text.isalpha() or max(text) > "\xff":
                    other.append((word, text))
                    continue
                letters = "".join(map(self.letters.__getitem__, text.lower().encode()))
            self.known[word] = np.array([t.id for t in self.pieces(letters)], dtype="<u4").tobytes()
        found = self.tokenizer.encode_batch([text for _, text in other], add_special_tokens=False)
        for (word, _), encoding in zip(other, found):
            self.known[word] = np.array(encoding.ids, dtype="<u4").tobytes()

    @staticmethod
    def _stem(word: bytes) -> bytes:
        """``word`` without final commas and points, where these surely are tokens of their own."""
        stem = word.rstrip(b".,")
        if stem != word and stem and (stem[-1:].isalnum() or (
                len(stem) > 1 and stem[-2] == 0xC3 and stem[-1] not in (0x97, 0xB7))):
            return stem
        return word

    def of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for text in texts:
            words = (text if b"<|" in text else text.lower()).split()
            known = self.known
            missing = [w for w in set(words) if w not in known]
            if missing:
                stems = {w: self._stem(w) for w in missing}
                ends = {w[len(s):] for w, s in stems.items() if s != w}
                fresh = [x for x in {*stems.values(), *ends} if x not in known]
                if len(known) + len(fresh) + len(missing) > self.limit:
                    known.clear()
                    fresh = list(dict.fromkeys(x for w in set(words) for s in [self._stem(w)] for x in (s, w[len(s):]) if x))
                    missing = list(set(words))
                    stems = {w: self._stem(w) for w in missing}
                self._learn(fresh)
                known = self.known
                for w, s in stems.items():
                    if s != w:
                        known[w] = known[s] + known[w[len(s):]]
            yield np.frombuffer(b"".join(map(known.__getitem__, words)), dtype="<u4")


def room_sizes(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences that hold ``total`` tokens exactly; short ones are powers of two."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces ``(document, start, length, sequence, offset)`` that cover documents of these lengths.

    Runs in time close to linear: whole sequences are filled first by what longer documents have in
    full, and of the rest each piece searches the sequences by cost.
    """
    rooms = room_sizes(sum(lengths), capacity)
    pieces: list[tuple[int, int, int, int, int]] = []
    full = 0
    queue = []
    for document, length in enumerate(lengths):
        at = 0
        while length - at >= capacity:
            pieces.append((document, at, capacity, full, 0))
            full += 1
            at += capacity
        if length > at:
            queue.append((-(length - at), document, at))
    heapq.heapify(queue)
    room = np.array(rooms[full:], dtype=np.int64)
    size = room.copy()
    cost = np.zeros(len(room))
    while queue:
        length, document, at = heapq.heappop(queue)
        length = -length
        fits = room >= length
        best = int(np.where(fits, cost, np.inf).argmin())
        if not fits[best]:
            best = int(np.where(room > 0, cost, np.inf).argmin())
        take = min(length, int(room[best]))
        pieces.append((document, at, take, full + best, int(size[best] - room[best])))
        room[best] -= take
        cost[best] += linear * take + quadratic * take * take
        if take < length:
            heapq.heappush(queue, (take - length, document, at + take))
    return pieces


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    A document is its text's ids and the id 1; a null or empty text is that id alone, so every row of
    ``docs`` has a piece. Texts are read whole and cut where sequences end. Rows that repeat, or whose
    id is null, are packed each on its own. An empty table gives an empty result. ``vocabulary`` is the
    path of the tokenizer file, the same on every machine.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, ids array<int>")
    end = np.array([END_ID], dtype="<u4")

    def rows(ids: list, tokens: list[np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
        pieces = assign([len(t) for t in tokens], capacity)
        base = (TaskContext.get().partitionId() << 40) | (number << 24)
        for at in range(0, len(pieces), 5000):
            part = pieces[at:at + 5000]
            cut = [tokens[d][s:s + n] for d, s, n, _, _ in part]
            document, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*part))
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[d] for d in document.tolist()], pa.int64()), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                pa.array([len(tokens[d]) for d in document.tolist()], pa.int64()),
                pa.array(base + sequence), pa.array(offset),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)),
                    pa.array(np.concatenate(cut).astype(np.int32))),
            ], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(vocabulary or public_tokenizers.path(VOCABULARY))
        ids: list = []
        tokens: list[np.ndarray] = []
        held = number = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                for doc, found in zip(part.column(0).to_pylist(), words.of(bytes_of(part.column(1)))):
                    ids.append(doc)
                    tokens.append(np.concatenate([found, end]))
                    held += len(tokens[-1])
                    if held >= group_tokens:
                        yield from rows(ids, tokens, number)
                        ids, tokens, held, number = [], [], 0, number + 1
        if ids:
            yield from rows(ids, tokens, number)

    return texts(docs, id_col, text_col).mapInArrow(run, schema)


_WORDS: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    """One set of remembered words for each worker."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]
