"""Alignment of two tokenizers over a corpus, with external spill counting.

Both tokenizers cut a text's bytes. Where both end a token the tokens so far form a group, and the two tokens that
end there are linked. How often two ids are linked in the whole corpus, and the most that a B id is linked to any A
id, is counted from records ``(b, a, document, links)``:

1. A task turns texts into records. A full buffer is sorted side-major (B's id before A's), cut by a radix of B's id
   and spilled as zstd runs: one row for each spill and radix.
2. Runs meet in cells of a radix and a bounded number of spills, so an id that is linked in every document is spread
   like any other. A cell merges its runs with a heap and counts each pair as it passes.
3. The counts of all cells, a row for each pair and cell, are added up and sorted by side; each B id's maximum is
   known when its pairs have passed. Counts and maxima are written in blocks, radix by radix.
4. Spills are read again beside these blocks, radix by radix, and each record adds its pair's count to its document.
   A spill holds whole documents, so one row for each document comes back.

Texts are tokenised by unit. Both tokenizers surely cut before a space or line break that follows a character other
than white space: the first by its pattern, the second because no piece of its vocabulary holds a space but in
front, or a line break. So a text's tokens are those of its units, and a unit met before is looked up.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of, staged

#: The first vocabulary as ranks (the ids of ``byte_bpe_50k.json``), and the second.
VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Links that a task holds before it spills, and documents of a spill; they bound its memory.
SPILL_LINKS, SPILL_DOCS = 2_000_000, 1 << 16
#: Radixes of B's ids.
RADIXES = 32
#: Spills whose runs meet in a cell, on average.
CELL_SPILLS = 64
#: Units that a worker remembers.
UNITS = 1_000_000
#: Pairs in a block of counts.
BLOCK_PAIRS = 200_000

_MARK = "▁"  # a space, as the second vocabulary writes it
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = {rank: token for token, rank in ranks.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = [len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)]
        self.size_b = [len(t) for t in self.bytes_b]
        self.names = [str(i) for i in range(max(len(self.size_a), len(self.size_b)))]
        self.space = self.b.piece_to_id(_MARK)
        if any(_MARK in p.lstrip(_MARK) or "\n" in p for p in pieces):
            raise ValueError("the second vocabulary joins what units separate")

    def tokens(self, units: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both for each unit, which starts with a space or a line break; None where their bytes are not the unit's."""
        out = []
        # The second tokenizer puts a space in front: it stands for the unit's own, or is dropped before a line break.
        found = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for unit, b in zip(units, found):
            if unit == " ":
                b = [self.space]
            elif unit[0] != " ":
                b = b[1:] if b[0] == self.space else []
            # The first is byte-level: its tokens spell any text.
            same = b"".join([self.bytes_b[i] for i in b]) == unit.encode()
            out.append((self.a.encode_ordinary(unit), b) if same else None)
        return out

    def aligned(self, a: list[int], b: list[int]) -> tuple[str, list[int]]:
        """The groups between the places where tokens of both end, as text, and the links ``b << 32 | a`` at these places."""
        size_a, size_b, names = self.size_a, self.size_b, self.names
        out, links = [], []
        i, j, last = 1, 1, len(a)
        end_a, end_b, in_a, in_b = size_a[a[0]], size_b[b[0]], names[a[0]], names[b[0]]
        while True:
            if end_a < end_b:
                end_a += size_a[a[i]]
                in_a += "," + names[a[i]]
                i += 1
            elif end_b < end_a:
                end_b += size_b[b[j]]
                in_b += "," + names[b[j]]
                j += 1
            else:
                out.append(in_a + "|" + in_b)
                links.append(b[j - 1] << 32 | a[i - 1])
                if i == last:
                    return ";".join(out), links
                end_a, end_b, in_a, in_b = end_a + size_a[a[i]], end_b + size_b[b[j]], names[a[i]], names[b[j]]
                i, j = i + 1, j + 1


class Units:
    """Aligned units by number: their groups as text, their counts, and their links."""

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies = vocabularies
        self.clear()

    def clear(self) -> None:
        #: Units of a space or line break and a word by the word, or the line break and the word; others with a space in front.
        self.number: dict[str, int] = {}
        self.bad: set[str] = set()
        self.texts: list[bytes] = []
        self._counts: list[int] = []
        self._links: list[int] = []
        self._parts: list[list[np.ndarray]] = [[np.empty((0, 3), np.int64)], [np.empty(0, np.int64)]]

    def __len__(self) -> int:
        return len(self.texts) + len(self.bad)

    def _add(self, found: tuple[list[int], list[int]]) -> int:
        text, links = self.vocabularies.aligned(*found)
        self.texts.append(text.encode())
        self._counts += (len(found[0]), len(found[1]), len(links))
        self._links += links
        return len(self.texts) - 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """By unit: tokens of A, tokens of B, groups. And the links ``b << 32 | a`` of all units in turn, one for each group."""
        if self._counts:
            self._parts[0].append(np.array(self._counts, np.int64).reshape(-1, 3))
            self._parts[1].append(np.array(self._links, np.int64))
            self._counts, self._links = [], []
        self._parts = [[np.concatenate(p)] for p in self._parts]
        return self._parts[0][0], self._parts[1][0]

    def _learn(self, units: dict[str, str]) -> bool:
        """Units by key; whether all have tokens."""
        new = [k for k in units if k not in self.number and k not in self.bad]
        for key, found in zip(new, self.vocabularies.tokens([units[k] for k in new]) if new else ()):
            if found is None:
                self.bad.add(key)
            else:
                self.number[key] = self._add(found)
        return self.bad.isdisjoint(units)

    def of(self, text: str) -> list[int] | None:
        """Numbers of the units of space+``text``; None if it has no tokens."""
        if not text:
            return None
        keys = text.replace("\n", " \n").split(" ")
        number = self.number
        try:
            return list(map(number.__getitem__, keys))
        except KeyError:
            missing = {k for k in keys if k not in number}
        if all(k and not k[-1].isspace() and not (k[1] if k[0] == "\n" else k[0]).isspace() for k in missing):
            good = self._learn({k: k if k[0] == "\n" else " " + k for k in missing})
        else:
            units = _CUT.split(" " + text)
            plain = [len(u) > 1 and not u[1].isspace() and not u[-1].isspace() for u in units]
            keys = [" " + u if not p else u[1:] if u[0] == " " else u for u, p in zip(units, plain)]
            good = self._learn(dict(zip(keys, units)))
        if good:
            return list(map(number.__getitem__, keys))
        found = self.vocabularies.tokens([" " + text])[0]
        return None if found is None else [self._add(found)]


def _framed(arrays: list[np.ndarray]) -> bytes:
    parts = [zstandard.ZstdCompressor(level=1).compress(a.tobytes()) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unframed(data: bytes, kinds: list[type]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(data[at:at + 8], "little")
        out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at + 8:at + 8 + size]), kind))
        at += 8 + size
    return out


def written_run(pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> bytes:
    """A run of records sorted by pair and document: pairs as differences, records for each, the records' columns."""
    first = np.nonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))[0]
    sizes = np.diff(np.append(first, len(pair)))
    totals = np.add.reduceat(links, first)
    return _framed([np.diff(pair[first], prepend=0), totals, sizes.astype(np.uint32), doc.astype(np.uint32), links.astype(np.uint32)])


_RUN = [np.int64, np.int64, np.uint32, np.uint32, np.uint32]


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """``(pair, links)`` of sorted runs, rising: a heap holds the next pair of each run."""
    streams = [zip(pairs.tolist(), totals.tolist()) for pairs, totals in runs if len(pairs)]
    heap = [(*next(s), i) for i, s in enumerate(streams)]
    heapq.heapify(heap)
    pair, total = None, 0
    while heap:
        key, links, i = heap[0]
        if key != pair:
            if pair is not None:
                yield pair, total
            pair, total = key, 0
        total += links
        head = next(streams[i], None)
        if head is None:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (*head, i))
    if pair is not None:
        yield pair, total


class Spill:
    """Units of documents until they are spilled."""

    def __init__(self, task: int, radixes: int):
        self.task, self.radixes, self.spills = task, radixes, 0
        self.clear()

    def clear(self) -> None:
        self.docs: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.links = 0

    def write(self, units: Units) -> Iterator[tuple[int, int, bytes]]:
        """``(spill, radix, data)``: the documents at radix -1, and a run for each radix that has one."""
        if not self.docs:
            return
        counts, links = units.arrays()
        end = np.cumsum(counts[:, 2])
        unit = np.concatenate(self.numbers)
        doc = np.repeat(np.arange(len(self.docs)), [len(n) for n in self.numbers])
        many = counts[unit, 2]
        place = np.arange(many.sum()) + np.repeat(end[unit] - np.cumsum(many), many)
        used = np.zeros(len(links), bool)
        used[place] = True
        pairs = np.unique(links[used])
        rank = np.zeros(len(links), np.int64)
        rank[used] = np.searchsorted(pairs, links[used])
        records = rank[place] << 32 | np.repeat(doc, many)
        records.sort()
        first = np.nonzero(np.concatenate([[True], records[1:] != records[:-1]]))[0]
        times = np.diff(np.append(first, len(records)))
        records = records[first]
        pair, doc = pairs[records >> 32], records & 0xFFFFFFFF
        spill = self.task << 32 | self.spills
        self.spills += 1
        yield spill, -1, _framed([np.array(self.docs, np.int64)])
        radix = (pair >> 32) % self.radixes
        for r in np.unique(radix).tolist():
            mine = radix == r
            yield spill, r, written_run(pair[mine], doc[mine], times[mine])
        self.clear()


_VOCABULARIES: dict[tuple[str, str], Units] = {}


def _units(path_a: str, path_b: str) -> Units:
    """One set of remembered units for each worker."""
    if (path_a, path_b) not in _VOCABULARIES:
        _VOCABULARIES[path_a, path_b] = Units(Vocabularies(path_a, path_b))
    return _VOCABULARIES[path_a, path_b]


_TOKENISED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
              "spill long, radix int, data binary")


def _tokenise(path_a: str, path_b: str, radixes: int, spill_links: int, unit_limit: int, with_groups: bool):
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64(), pa.int32(), pa.binary()]
    names = [field.split()[0] for field in _TOKENISED.split(", ")]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(path_a, path_b)
        spill = Spill(TaskContext.get().partitionId(), radixes)

        def spilled():
            for s, radix, data in spill.write(units):
                yield rows([(None,) * 8 + (s, radix, data)])
            if len(units) > unit_limit:
                units.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = []
                for text in bytes_of(part.column(2)):
                    try:
                        numbers = units.of(text.decode())
                    except UnicodeDecodeError:  # no token has such bytes
                        numbers = None
                    found.append(None if numbers is None else np.array(numbers, np.int64))
                counts, _ = units.arrays()
                out = []
                for row, doc_id, numbers in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), found):
                    if numbers is None:
                        out.append((row, doc_id, 0, 0, 0, 0, "", "", None, None, None))
                        continue
                    groups = b";".join(map(units.texts.__getitem__, numbers.tolist()))
                    a, b, n = counts[numbers].sum(axis=0).tolist()
                    out.append((row, doc_id, a, b, n, n, groups.decode() if with_groups else None,
                                hashlib.sha256(groups).hexdigest(), None, None, None))
                    spill.docs.append(row)
                    spill.numbers.append(numbers)
                    spill.links += n
                yield rows(out)
                if spill.links >= spill_links or len(spill.docs) >= SPILL_DOCS or len(units) > unit_limit:
                    yield from spilled()
        yield from spilled()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads runs by cell; emits each pair of a cell with its links."""
    def counted(runs):
        stream = merged(runs)
        while part := [x for _, x in zip(range(100_000), stream)]:
            pair, links = (np.array(x, np.int64) for x in zip(*part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair >> 32), pa.array(pair & 0xFFFFFFFF), pa.array(links)], names=["b", "a", "links"])

    cell, runs = None, []
    for batch in batches:
        for group, radix, data in zip(*(c.to_pylist() for c in batch.columns)):
            if (group, radix) != cell:
                yield from counted(runs)
                cell, runs = (group, radix), []
            steps, totals = _unframed(data, _RUN[:2])
            runs.append((np.cumsum(steps), totals))
    yield from counted(runs)


def _maxima(block: int):
    """Reads counted pairs sorted by radix and side; emits blocks of pairs with their counts and whether these are the
    highest of their B id."""
    def packed(radix, held):
        pair, links, best = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array([radix], pa.int32()), pa.array([int(pair[0])]), pa.array([_framed([pair, links, best])], pa.binary())],
            names=["radix", "first", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix, held, rest = None, [], None  # rest: pairs whose B id may go on

        def sealed(pair, links):
            b = pair >> 32
            first = np.nonzero(np.concatenate([[True], b[1:] != b[:-1]]))[0]
            most = np.repeat(np.maximum.reduceat(links, first), np.diff(np.append(first, len(b))))
            return pair, links, (links == most).astype(np.int8)

        for batch in batches:
            r, b, a, n = (batch.column(i).to_numpy() for i in range(4))
            edges = [0, *(np.nonzero(r[1:] != r[:-1])[0] + 1).tolist(), len(r)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if r[lo] != radix:
                    if rest is not None:
                        yield packed(radix, [*held, sealed(*rest)])
                    radix, held, rest = r[lo], [], None
                pair, links = b[lo:hi].astype(np.int64) << 32 | a[lo:hi].astype(np.int64), n[lo:hi].astype(np.int64)
                if rest is not None:
                    pair, links = np.concatenate([rest[0], pair]), np.concatenate([rest[1], links])
                cut = int(np.searchsorted(pair, pair[-1] >> 32 << 32))
                if cut:
                    held.append(sealed(pair[:cut], links[:cut]))
                    if sum(len(h[0]) for h in held) >= block:
                        yield packed(radix, held)
                        held = []
                rest = pair[cut:], links[cut:]
        if rest is not None:
            yield packed(radix, [*held, sealed(*rest)])

    return run


def _give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads, by group of spills, their documents and then, radix by radix, blocks of counts and runs; emits documents."""
    group, radix, docs, sums, blocks, table = None, None, {}, {}, [], None

    def done():
        for s, rows in docs.items():
            yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(x) for x in sums[s])], names=["row", "count_sum", "n_best"])

    for batch in batches:
        for g, r, spill, data in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if g != group:
                yield from done()
                group, docs, sums = g, {}, {}
            if (g, r) != radix:
                radix, blocks, table = (g, r), [], None
            if r < 0:
                docs[spill] = _unframed(data, [np.int64])[0]
                sums[spill] = np.zeros(len(docs[spill]), np.int64), np.zeros(len(docs[spill]), np.int64)
            elif spill is None:
                blocks.append(_unframed(data, [np.int64, np.int64, np.int8]))
            else:
                if table is None:
                    table = [np.concatenate(x) for x in zip(*blocks)]
                steps, _, sizes, doc, links = _unframed(data, _RUN)
                place = np.repeat(np.searchsorted(table[0], np.cumsum(steps)), sizes)
                links = links.astype(np.int64)
                np.add.at(sums[spill][0], doc, table[1][place] * links)
                np.add.at(sums[spill][1], doc, table[2][place] * links)
    yield from done()


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
          radixes: int = RADIXES, spill_links: int = SPILL_LINKS, cell_spills: int = CELL_SPILLS, unit_limit: int = UNITS,
          block: int = BLOCK_PAIRS, with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_a`` and ``n_b`` are the tokens of space+text in each vocabulary, ``n_groups`` the groups between places where tokens
    of both end, ``n_links`` the pairs of tokens that end together, which is one for each group. A pair of ids counts its
    links in all documents; ``count_sum`` adds the counts of a document's links, and ``n_best`` is the number of its links
    whose count no other A id has more of with the same B id; ties are all best. ``groups_sha256`` is over the groups as
    ``a,a|b;a|b,b``, which ``with_groups`` adds as the column ``groups``.

    Strings of special tokens are plain text. A text that is null, empty, not UTF-8, or not what its tokens spell has no
    tokens: zeros, and empty strings. Repeated rows count each; ids may be null. An empty table gives an empty result.
    Texts of any length are read whole. ``path_a`` and ``path_b`` are paths of the vocabulary files, the same on every machine.
    """
    path_a = path_a or public_tokenizers.path(VOCABULARY_A)
    path_b = path_b or public_tokenizers.path(VOCABULARY_B)
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    read = staged(source.mapInArrow(_tokenise(path_a, path_b, radixes, spill_links, unit_limit, with_groups), _TOKENISED), "tokenised")
    figures = read.where("row is not null").drop("spill", "radix", "data")
    runs = read.where("row is null").select("spill", "radix", "data")
    spills = runs.where("radix = -1").count()
    groups = max(1, -(-spills // cell_spills), min(spills, 2 * docs.sparkSession.sparkContext.defaultParallelism))
    runs = runs.withColumn("cells", F.pmod(F.xxhash64("spill"), F.lit(groups)).cast("int"))
    counts = runs.where("radix >= 0").select("cells", "radix", "data").repartition("cells", "radix").sortWithinPartitions(
        "cells", "radix").mapInArrow(_count, "b long, a long, links long")
    counts = counts.groupBy("b", "a").agg(F.sum("links").alias("links")).withColumn("radix", (F.col("b") % radixes).cast("int"))
    blocks = staged(counts.select("radix", "b", "a", "links").repartition("radix").sortWithinPartitions("radix", "b", "a").mapInArrow(
        _maxima(block), "radix int, first long, data binary"), "pair-counts")
    beside = blocks.withColumn("cells", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        "cells", "radix", F.lit(None).cast("long").alias("spill"), "first", "data")
    dealt = runs.select("cells", "radix", "spill", F.lit(0).cast("long").alias("first"), "data").union(beside)
    given = dealt.repartition("cells").sortWithinPartitions("cells", "radix", F.asc_nulls_first("spill"), "first").mapInArrow(
        _give_back, "row long, count_sum long, n_best long")
    out = figures.join(staged(given, "given-back"), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256", "groups")
    return out if with_groups else out.drop("groups")
