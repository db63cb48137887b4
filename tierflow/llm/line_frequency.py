"""Quality rules from the lines that documents of a host share.

A line is normalised (A-Z lower-cased, digits made zeros, white space squeezed) and hashed. For each host and line
the distinct documents that hold it are counted; documents with the same text are one. A line found in more than
``LINE_DOCS`` documents of its host is a template's, not an author's, and is removed. A document is rejected if a
base rule fails, or if too few of its words are left.

Texts are read once: each becomes its figures and its distinct lines, 16 bytes a line, which are staged. Counting is
in two steps, by line and text and then by line with partial sums, so that a line in a third of all documents is one
row for each task. The lines above the limit are joined back to the staged lines; a hot line there is a skewed key
with one row on the other side, which adaptive execution splits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import bytes_of, free_name, staged

#: Most documents of a host that may hold a line.
LINE_DOCS = 6
#: Least number of words, of a document and of what is left of it.
LEAST_WORDS = 20
#: Least percentage of a document's words that must be left.
LEAST_LEFT = 50
#: Words of a window, and the largest percentage of words that may stand in repeated windows.
WINDOW, MOST_REPEATED = 8, 30

_SPACE = b" \t\n\v\f\r"
_INNER = bytes(range(0x80, 0xC0))  # bytes of a character after its first
_SYMBOLS = b"#*$%&|<>"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")


def line_key(line: bytes) -> int:
    """Hash of a normalised line, as a signed 64-bit number."""
    key = xxhash.xxh64_intdigest(b" ".join(line.translate(_FOLD).split()))
    return key - (1 << 64) if key >> 63 else key


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of ``window`` words found twice or more.

    Rolling hashes name the windows that may repeat; the words themselves decide.
    """
    size = len(words) - window + 1
    if size < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(size, np.uint64)
    for j in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j:size + j]
    ordered = np.sort(rolled)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    maybe = np.nonzero(np.isin(rolled, twice))[0].tolist()
    found = [tuple(words[i:i + window]) for i in maybe]
    times = Counter(found)
    edges = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(maybe, found):
        if times[w] > 1:
            edges[i] += 1
            edges[i + window] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def figures(text: bytes) -> tuple:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text, and its distinct normalised lines
    with the words that stand on them."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    parts = [line.split() for line in lines]
    words = list(chain.from_iterable(parts))
    shared: dict[int, int] = {}
    for line, part in zip(lines, parts):
        key = line_key(line)
        shared[key] = shared.get(key, 0) + len(part)
    return (
        len(words), len(text.translate(None, _SPACE + _INNER)), len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), shared,
    )


_FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            found = [figures(t) for t in bytes_of(part.column(4))]
            *counts, shared = zip(*found)
            sizes = np.cumsum([0, *map(len, shared)]).astype(np.int32)
            lines = pa.StructArray.from_arrays(
                [pa.array(list(chain.from_iterable(shared)), pa.int64()),
                 pa.array(list(chain.from_iterable(s.values() for s in shared)), pa.int64())], names=["key", "words"])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:4], *(pa.array(c, pa.int64()) for c in counts), pa.ListArray.from_arrays(sizes, lines)],
                names=["row", "doc_id", "host", "text_key", *_FIGURES, "lines"])


def _judged(docs: DataFrame, host: str | Column, id_col: str, text_col: str, line_docs: int, least_words: int,
            least_left: int) -> tuple[DataFrame, DataFrame]:
    """Verdicts of all rows, by ``row``; and the lines each row loses: ``row, key, words``."""
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.col(f"`{host}`") if isinstance(host, str) else host).cast("string").alias("host"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_key"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    numbers = ", ".join(f"{c} long" for c in _FIGURES)
    read = staged(source.mapInArrow(
        _read, f"row long, doc_id long, host string, text_key long, {numbers}, lines array<struct<key:long,words:long>>"), "lines")
    lines = read.select("row", F.xxhash64("host").alias("host"), "text_key", F.inline("lines"))
    common = staged(
        lines.groupBy("host", "key").agg(F.count_distinct("text_key").alias("docs"))
        .where(F.col("docs") > line_docs).select("host", "key"), "common-lines")
    lost = staged(lines.join(common, ["host", "key"]).select("row", "key", "words"), "lost-lines")
    words_lost = lost.groupBy("row").agg(F.sum("words").alias("lost"), F.count("*").alias("n_common_lines"))
    left = F.col("n_words") - F.col("n_lost_words")
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    verdict = read.drop("lines", "text_key").join(words_lost, "row", "left").select(
        "row", "doc_id", *_FIGURES, F.coalesce("lost", F.lit(0)).alias("n_lost_words"),
        F.coalesce("n_common_lines", F.lit(0)).alias("n_common_lines"), base.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & (left >= least_words) & (100 * left >= least_left * F.col("n_words")))
    return verdict, lost


def judge(docs: DataFrame, host: str | Column = "source", id_col: str = "doc_id", text_col: str = "text",
          line_docs: int = LINE_DOCS, least_words: int = LEAST_WORDS, least_left: int = LEAST_LEFT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the five figures, ``n_lost_words``, ``n_common_lines``, ``base_failed``, ``kept``.

    Words are runs without ASCII white space. ``n_common_lines`` counts a row's distinct normalised lines that more than
    ``line_docs`` distinct texts of its host hold, ``n_lost_words`` the words on them. ``kept`` is false if
    ``base_failed`` (under ``least_words`` words, or over 30 % of them in repeated windows), or if what is left has
    under ``least_words`` words or under ``least_left`` percent of all. ``host`` is a column's name or an expression,
    such as ``parse_url(url, 'HOST')``; rows with a null host form one host. Null text counts as empty and fails the
    base rule. Repeated rows are all returned and count once, as do different rows with the same text on a host: copies
    do not deplete each other. Null ids stay null. An empty table gives an empty result. Texts of any length are read whole.
    """
    return _judged(docs, host, id_col, text_col, line_docs, least_words, least_left)[0].drop("row")


def clean(docs: DataFrame, host: str | Column = "source", id_col: str = "doc_id", text_col: str = "text",
          line_docs: int = LINE_DOCS, least_words: int = LEAST_WORDS, least_left: int = LEAST_LEFT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, their texts without the lines above the limit. Columns stay."""
    row, gone = free_name(docs, "row"), free_name(docs, "gone")
    keyed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    # A staged table is read again in the same splits, but rows are matched by the number written with them.
    verdict, lost = _judged(
        keyed.withColumn(gone, F.col(row)), host, gone, text_col, line_docs, least_words, least_left)
    number = verdict.select("row", F.col("doc_id").alias(row), "kept")
    cuts = lost.groupBy("row").agg(F.collect_set("key").alias(gone))
    chosen = number.where("kept").join(cuts, "row", "left").select(row, gone)
    out = keyed.join(chosen, row)
    at, cut = out.columns.index(text_col), out.columns.index(gone)
    kind = out.schema[text_col].dataType
    if not isinstance(kind, T.StringType):
        raise TypeError("texts must be strings")

    def shortened(batches):
        for batch in batches:
            texts = bytes_of(batch.column(at))
            for i, keys in enumerate(batch.column(cut).to_pylist()):
                if keys:
                    keys = set(keys)
                    texts[i] = b"\n".join(
                        line for line in texts[i].split(b"\n")
                        if not line or line.isspace() or line_key(line) not in keys)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.binary()).cast(batch.schema.field(at).type))

    return out.mapInArrow(shortened, out.schema).select(*docs.columns)
