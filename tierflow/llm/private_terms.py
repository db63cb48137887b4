"""Personal data, and the terms that disclose it.

Emails, addresses, card and phone numbers are found by their form. Each value is a protected entity. How much a
term in its documents reveals of it is estimated from the corpus: with the information content IC(e) = -log2 p(e) of an
entity and the pointwise mutual information PMI(t; e) = log2 p(t, e) / (p(t) p(e)) over documents, a term that
occurs with the entity alone has PMI = IC and gives it away. A term whose share PMI / IC reaches the upper
threshold is removed wherever it stands in a document that holds the entity, one that reaches the lower is
generalised to its kind. Evidence must come from several different texts, so copies of one text disclose nothing.

The corpus is read twice: for entities, and for the document frequency of the words in documents with an entity that
several texts show. The words looked for are told to tasks by a filter of fixed size, and joined exactly afterwards.
A pair occurs at most as often as its entity, so a term above a document frequency that follows from the entity's
cannot reach the lower threshold; such terms are left out before pairs are formed.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import appended, free_name, staged

# Kinds in order, and the forms of their spans.
KINDS = ("email", "ip", "card", "phone", "term")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Different texts that must show a term with an entity.
SUPPORT = 3
#: Shares of an entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.6, 0.8
FILTER_BITS = 1 << 24
#: Pairs of an entity and a term that a row forms in one deal.
PAIRS_AT_ONCE = 1_000_000
CACHE_WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all personal data, by start, then kind. Runs in linear time."""
    out = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    ip_end = card_end = 0
    for run in _DIGITS.finditer(text):
        at = run.start()
        if at >= ip_end and (m := _IP.match(text, at)):
            ip_end = m.end()
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                out.append((at, 1, ip_end))
        if at >= card_end and (m := _CARD.match(text, at)):
            card_end = m.end()
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((at, 2, card_end))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def entities_of(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """The different entities among the spans, by hash."""
    out = {}
    for start, kind, end in spans:
        value = text[start:end].lower() if kind == 0 else "".join(c for c in text[start:end] if c in "0123456789.")
        out[(xxhash.xxh3_64_intdigest(f"{KINDS[kind]}:{value}") ^ (1 << 63)) - (1 << 63)] = None
    return list(out)


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """``(term, start, end)``: all words that touch no span, in lower case."""
    edges = sorted((s, e) for s, _, e in spans)
    out, at, reach = [], 0, 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        while at < len(edges) and edges[at][0] < b:
            reach = max(reach, edges[at][1])
            at += 1
        if reach <= a:
            out.append((m.group().lower(), a, b))
    return out


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, str, int, int]]:
    """``(entity, term, start, end)``: each entity of the text with each word outside all spans."""
    words = words_outside(text, spans) if spans else []
    return [(entity, *word) for entity in entities_of(text, spans) for word in words]


def sanitised(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """``text`` with each ``(start, kind, end, replacement)`` applied; overlapping spans become the first's."""
    out, at = [], 0
    for start, _, end, put in sorted(spans):
        if start >= at:
            out += [text[at:start], put]
        at = max(at, end)
    return "".join([*out, text[at:]])


def generalised(term: str) -> str:
    """The kind a term is replaced by."""
    return "[NAME]" if term[:1].isupper() else "[WORD]"


_SPANS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "kind", "end")]))

def _found(docs: DataFrame, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with base spans, their entities, the text's hash and a row number, and these columns' names."""
    names = {k: free_name(docs, f"pii_{k}") for k in ("spans", "entities", "tk", "row")}

    def columns(texts):
        spans, entities, keys = [], [], []
        for first in range(0, len(texts), 500):
            for text in texts.slice(first, 500).to_pylist():
                text = text or ""
                base = base_spans(text)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                entities.append(entities_of(text, base))
                keys.append((xxhash.xxh3_64_intdigest(text) ^ (1 << 63)) - (1 << 63) if base else 0)
        i32 = pa.int32()
        return [
            pa.array(spans, pa.list_(pa.struct([("start", i32), ("kind", i32), ("end", i32)]))),
            pa.array(entities, pa.list_(pa.int64())),
            pa.array(keys, pa.int64()),
        ]

    fields = [T.StructField(names["spans"], _SPANS), T.StructField(names["entities"], T.ArrayType(T.LongType())), T.StructField(names["tk"], T.LongType())]
    return appended(docs, fields, columns, [text_col]).withColumn(names["row"], F.monotonically_increasing_id()), names


def _term_filter(terms: DataFrame) -> bytes:
    """Which slots the terms fall into; a table of fixed size."""
    slot = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    words = terms.select(F.floor(slot / 32).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(term), 32L) as int))").alias("bit"))
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most FILTER_BITS / 32 rows
        table[r.word] = r.bits & 0xFFFFFFFF
    return table.tobytes()


def _frequencies(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """``term``, ``df``: in how many documents each term occurs, among others that share a slot with one."""
    sent = docs.sparkSession.sparkContext.broadcast(_term_filter(terms))

    def run(batches):
        table = np.frombuffer(sent.value, np.uint32)
        known: dict[str, bool] = {}
        for batch in batches:
            met: Counter = Counter()
            for first in range(0, batch.num_rows, 500):
                for text in batch.column(0).slice(first, 500).to_pylist():
                    words = set(_WORD.findall(text.lower())) if text else ()
                    new = [w for w in words if w not in known]
                    if len(known) + len(new) > CACHE_WORDS:
                        known.clear()
                        new = list(words)
                    for w in new:  # Spark's xxhash64 is XXH64 with this seed
                        h = xxhash.xxh64_intdigest(w, 42)
                        slot = h % FILTER_BITS
                        known[w] = bool(table[slot >> 5] >> (h % 32) & 1)
                    met.update(w for w in words if known[w])
            yield pa.RecordBatch.from_arrays([pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], names=["term", "df"])

    rows = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(run, "term string, df long")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def _words(rows: DataFrame) -> DataFrame:
    """``row``, ``tk``, ``most``, ``term``: the different words of each text outside its spans."""
    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                words = [sorted({t for t, _, _ in words_outside(text, [(x["start"], x["kind"], x["end"]) for x in spans])})
                         for text, spans in zip(part.column(3).to_pylist(), part.column(4).to_pylist())]
                at = pa.array(np.repeat(np.arange(len(words)), [len(w) for w in words]))
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(at) for i in range(3)),
                                                  pa.array([w for ws in words for w in ws], pa.string())], names=["row", "tk", "most", "term"])

    return rows.mapInArrow(run, "row long, tk long, most double, term string")


def _pairs(held: DataFrame, rare: DataFrame, support: int) -> DataFrame:
    """``row, tk, term, df, entity, de``: each rare term of a row with each entity of it, where ``support`` texts can show them.

    A pair needs that many different texts, so all but its entity's ``support - 1`` texts with most terms hold it, too:
    pairs are formed there, and looked up in the largest. A row with many entities and many terms is dealt out by entity.
    """
    sizes = rare.groupBy("row", "tk").agg(F.count("*").alias("terms"))
    texts = held.select("entity", "tk").distinct().join(sizes.groupBy("tk").agg(F.max("terms").alias("terms")), "tk")
    first = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("terms"), "tk"))
    largest = staged(texts.withColumn("place", first).where(F.col("place") < support).select("entity", "tk"), "largest-texts")
    # Terms are repeated for as many deals as keep a deal's pairs below the bound; few rows have more than one.
    small = held.join(largest, ["entity", "tk"], "left_anti")
    pairs = F.col("entities") * F.col("terms")
    deals = small.groupBy("row").agg(F.count("*").alias("entities")).join(sizes.select("row", "terms"), "row").select(
        "row", F.ceil(pairs / PAIRS_AT_ONCE).cast("int").alias("deals"))
    dealt = small.join(deals, "row").withColumn("deal", F.pmod(F.xxhash64("entity"), F.col("deals")).cast("int"))
    spread = rare.join(deals, "row").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    columns = ["row", "tk", "term", "df", "entity", "de"]
    formed = staged(dealt.drop("tk", "deals").join(spread.drop("deals"), ["row", "deal"]).where(
        F.col("df") <= F.col("most")).select(*columns), "formed-pairs")
    asked = held.join(largest, ["entity", "tk"], "left_semi").join(formed.select("entity", "term").distinct(), "entity")
    return formed.union(asked.join(rare.select("row", "term", "df"), ["row", "term"]).select(*columns))


def _disclosed(docs: DataFrame, text_col: str, found: DataFrame, names: dict[str, str], support: int, low: float, high: float) -> DataFrame:
    """``row``, ``terms``: the terms that disclose an entity of the row, and whether they are removed."""
    held = found.where(F.size(names["entities"]) > 0).select(
        F.col(names["row"]).alias("row"), F.col(names["tk"]).alias("tk"), F.explode(names["entities"]).alias("entity"))
    total = found.count()
    entities = held.groupBy("entity", "tk").agg(F.count("*").alias("rows")).groupBy("entity").agg(
        F.count("*").alias("texts"), F.sum("rows").alias("de")).where((F.col("texts") >= support) & (F.col("de") < total))
    # Reaching the lower threshold takes a document frequency of at most this, if every document of the entity has the term.
    most = F.lit(float(total)) * F.pow(F.col("de") / F.lit(float(total)), F.lit(float(low))) * (1 + 1e-9)
    entities = staged(entities.select("entity", "de", most.alias("most")), "entities")
    if entities.isEmpty():
        return held.where("false").select("row", F.array(F.struct(F.lit("").alias("term"), F.lit(False).alias("removed"))).alias("terms"))
    held = staged(held.join(entities, "entity").select("row", "tk", "entity", "de", "most"), "entity-rows")
    by_row = held.groupBy("row").agg(F.first("tk").alias("tk"), F.max("most").alias("most"))
    texts = found.select(F.col(names["row"]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(names["spans"]).alias("spans"))
    words = staged(_words(texts.join(by_row, "row").select("row", "tk", "most", "text", "spans")), "entity-words")
    terms = words.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= support).select("term")
    frequencies = staged(_frequencies(docs, text_col, staged(terms, "terms")), "term-frequencies")
    rare = words.join(frequencies.where(F.col("df") >= support), "term").where(F.col("df") <= F.col("most"))
    rare = staged(rare.select("row", "tk", "term", "df"), "rare-terms")
    pairs = staged(_pairs(held, rare, support), "entity-terms")
    shown = pairs.groupBy("entity", "term", "df", "de", "tk").agg(F.count("*").alias("rows"))
    shown = shown.groupBy("entity", "term", "df", "de").agg(F.count("*").alias("texts"), F.sum("rows").alias("both")).where(F.col("texts") >= support)
    share = F.log2(F.col("both") * total / (F.col("de") * F.col("df"))) / F.log2(total / F.col("de"))
    rated = staged(shown.withColumn("share", share).where(F.col("share") >= low).select(
        "entity", "term", (F.col("share") >= high).alias("removed")), "disclosing-terms")
    return pairs.join(rated, ["entity", "term"]).groupBy("row", "term").agg(F.max("removed").alias("removed")).groupBy("row").agg(
        F.collect_list(F.struct("term", "removed")).alias("terms"))


def _marked(text: str, spans: list[dict], terms: list[dict] | None) -> list[tuple[int, int, bool]]:
    """``(start, end, removed)`` of every occurrence of the terms outside the spans."""
    if not terms:
        return []
    removed = {t["term"]: t["removed"] for t in terms}
    return [(a, b, removed[w]) for w, a, b in words_outside(text, [(s["start"], s["kind"], s["end"]) for s in spans]) if w in removed]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
         generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts by kind, ``base`` and ``spans`` as text, ``base_sha256``.

    Offsets are in code points, ends exclusive. A null or empty text has no spans; texts are read whole.
    Repeated rows and null ids are kept as rows. An empty table gives an empty result.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found, names = _found(source, "text")
    found = staged(found.withColumn("text", F.when(F.size(names["spans"]) > 0, F.col("text"))), "pii-spans")
    terms = _disclosed(source, "text", found, names, support, generalise, remove)

    def digest(batches):
        for batch in batches:
            out = []
            for base, more, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                more = [(a, 4, b) for a, b, _ in _marked(text, base, more)]
                base = [(s["start"], s["kind"], s["end"]) for s in base]
                text = joined(base)
                kinds = Counter(k for _, k, _ in base)
                out.append((*(kinds[k] for k in range(4)), len(more), text, hashlib.sha256(text.encode()).hexdigest(), joined(base + more)))
            columns = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base", "base_sha256", "spans"])

    rows = found.join(terms, found[names["row"]] == terms["row"], "left").select("doc_id", names["spans"], "terms", "text")
    return rows.mapInArrow(digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_term long, "
                                   "base string, base_sha256 string, spans string")


def sanitise(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, generalise: float = GENERALISE,
             remove: float = REMOVE) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing terms generalised or removed, in the text.

    Rows and columns stay; null texts stay null.
    """
    columns, schema = docs.columns, docs.schema
    found, names = _found(docs, text_col)
    found = staged(found, "pii-texts")
    terms = _disclosed(docs, text_col, found, names, support, generalise, remove).withColumnRenamed("row", names["row"])
    more = free_name(found, "pii_terms")
    rows = found.join(terms.withColumnRenamed("terms", more), names["row"], "left").select(
        *[F.col(f"`{c}`") for c in columns], names["spans"], more)
    at = columns.index(text_col)

    def put(batches):
        for batch in batches:
            texts = []
            for text, base, terms in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist(), batch.column(len(columns) + 1).to_pylist()):
                spans = [(s["start"], s["kind"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base or []]
                spans += [(a, 4, b, "" if removed else generalised(text[a:b])) for a, b, removed in _marked(text, base, terms)]
                texts.append(sanitised(text, spans) if spans else text)
            new = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(new, names=columns)

    return rows.mapInArrow(put, schema)
