import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tierflow.llm import private_terms as pt


def luhn(digits):
    odd = digits[::-1][::2]
    even = digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_spans(text):
    """The patterns as they are stated."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_spans_match_the_patterns():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@", ".", "-", "%", " ", "é", "1", "25", "255", "256", "00", "+", "(", ")", "4111 1111-1111 1111",
             "4111111111111111", "10.0.0.1", "+1 (555) 010-9999", "٣", "x@y.z", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pt.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 400_000, "a" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" + "(" * 400_000, "a@" * 200_000, "+1-" * 130_000):
        pt.base_spans(text)


def corpus():
    rng = random.Random(2)
    word = lambda: "w" + "".join(rng.choice("abcdefgh") for _ in range(2))
    rows = []
    for i in range(60):
        words = [word() for _ in range(30)]
        if i % 6 == 0:  # one person, always beside a rare word and a common one
            words[10:10] = ["Zorblax", "wab", "kim@corp.example.com"]
        elif i % 6 == 1:
            words[10:10] = ["wab", "reach", f"p{i}@corp.example.com"]
        elif i % 6 == 2:
            words[5:5] = ["reach", "wab"]
        rows.append(" ".join(words))
    rows += ["only copies call +1 555 010 99 99 quokka"] * 5 + [None, "", "😀 x@y.zz 1.2.3.4"]
    return list(enumerate(rows)) + [(None, "kim@corp.example.com"), (0, rows[0])]


def plain_terms(rows, support=3, low=0.6):
    texts = [t or "" for _, t in rows]
    near = [pt.contexts(t, plain_spans(t)) for t in texts]
    de = Counter(e for c in near for e in {x[0] for x in c})
    df = Counter(w for t in texts for w in set(re.findall(r"[^\W\d_]+", t.lower())))
    both = Counter(p for c in near for p in {x[:2] for x in c})
    shown = Counter(p for p, _ in {(x[:2], t) for t, c in zip(texts, near) for x in c})
    n = len(rows)
    hit = set()
    for (e, w), k in both.items():
        content = math.log2(n / de[e])
        if shown[e, w] >= support and content > 0 and math.log2(k * n / (de[e] * df[w])) / content >= low:
            hit.add((e, w))
    return [sorted({(a, 4, b) for e, w, a, b in c if (e, w) in hit}) for c in near]


def test_find_against_brute_force(docs):
    rows = corpus()
    want = []
    for (i, t), terms in zip(rows, plain_terms(rows)):
        base = plain_spans(t or "")
        text = ",".join(f"{pt.KINDS[k]}:{s}:{e}" for s, k, e in base)
        kinds = Counter(k for _, k, _ in base)
        want.append((str(i), *(kinds[k] for k in range(4)), hashlib.sha256(text.encode()).hexdigest(),
                     ",".join(f"{pt.KINDS[k]}:{s}:{e}" for s, k, e in sorted(base + terms))))
    got = [(str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pt.find(docs(rows, 4)).collect()]
    assert sorted(got) == sorted(want)
    assert any("term" in w[-1] for w in want) and not any("term" in w[-1] for w in want if "phone" in w[-1])


def test_sanitise(docs):
    rows = docs(corpus(), 3).withColumnRenamed("score", "pii_row")
    out = pt.sanitise(rows)
    assert out.columns == rows.columns and out.count() == rows.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[60] == "only copies call [PHONE] quokka" and texts[65] is None and texts[66] == ""
    assert "Zorblax" not in texts[6] and "[EMAIL]" in texts[6] and "wab" in texts[6]
    assert texts[67] == "😀 [EMAIL] [IP]"
    assert pt.find(rows.limit(0)).count() == 0
    assert pt.sanitised("abcdef", [(1, 0, 4, "X"), (2, 1, 5, "Y")]) == "aXf" and pt.generalised("Kim") == "[NAME]"


def test_share_decides_between_generalising_and_removing(docs):
    text = {r.doc_id: r.text for r in pt.sanitise(docs(corpus(), 3), remove=1.1).collect()}[6]
    assert "Zorblax" not in text and "[NAME]" in text


def document_wide(rows, support=3, low=0.6):
    """Places of disclosing terms, by counting whole documents."""
    texts = [t or "" for _, t in rows]
    spans = [plain_spans(t) for t in texts]
    held = [{(k, t[s:e].lower()) for s, k, e in found} for t, found in zip(texts, spans)]
    places = []
    for t, found in zip(texts, spans):
        inside = bytearray(len(t))
        for s, _, e in found:
            inside[s:e] = b"\1" * (e - s)
        places.append([(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W\d_]+", t) if not any(inside[m.start():m.end()])])
    de = Counter(e for es in held for e in es)
    df = Counter(w for t in texts for w in set(re.findall(r"[^\W\d_]+", t.lower())))
    pairs = [{(e, w) for e in es for w, _, _ in ws} for es, ws in zip(held, places)]
    both = Counter(p for ps in pairs for p in ps)
    shown = Counter(p for p, _ in {(p, t) for ps, t in zip(pairs, texts) for p in ps})
    n = len(rows)
    hit = {}
    for (e, w), k in both.items():
        if shown[e, w] >= support and de[e] < n and math.log2(k * n / (de[e] * df[w])) / math.log2(n / de[e]) >= low:
            hit.setdefault(w, set()).add(e)
    return [sorted((a, b) for w, a, b in ws if not hit.get(w, set()).isdisjoint(es)) for es, ws in zip(held, places)]


def test_terms_are_found_over_whole_documents(docs):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        words = ["".join(rng.choice("abcdefgh") for _ in range(2)) for _ in range(90)]
        if i % 6 == 0:  # far from the entity, before and after it
            words[0:0] = ["Zorblax"]
            words[45:45] = ["kim@corp.example.com"]
            words += ["zorblax", "end"]
        elif i % 6 == 1:
            words[3:3] = ["sam@corp.example.com"]
            words += ["Quux"] * (i % 4)
        rows.append((i, " ".join(words)))
    rows += [(60, "sam@corp.example.com"), (61, "Zorblax alone"), (62, None)]
    want = document_wide(rows)
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("term")] for r in pt.find(docs(rows, 4)).collect()}
    assert got == {i: p for (i, _), p in zip(rows, want)} and len(want[0]) >= 2
    texts = {r.doc_id: r.text for r in pt.sanitise(docs(rows, 4)).collect()}
    assert all("zorblax" not in texts[i].lower() for i in range(0, 60, 6)) and texts[61] == "Zorblax alone"


@pytest.mark.parametrize("at_once", [1_000_000, 50_000])
def test_a_log_with_ten_thousand_entities(docs, monkeypatch, at_once):
    monkeypatch.setattr(pt, "PAIRS_AT_ONCE", at_once)
    rng = random.Random(10)
    names = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(10_000)]
    words = [f"log{''.join(rng.choice('klmnop') for _ in range(4))}" for _ in range(200)]
    log = " ".join(f"{n}@ex.org {words[i % 200]}" for i, n in enumerate(names))
    rows = [(0, log), (1, log + " Logcopy")]
    for i in range(40):
        mine = names[i % 20 * 500:i % 20 * 500 + (500 if i < 30 else 60)]
        rows.append((10 + i, " ".join(f"{n}@ex.org" for n in mine) + f" group{chr(97 + i % 20)}x common words stand here {words[i]}"))
    rows += [(100 + i, f"nobody writes group{chr(97 + i % 3)}y common words {words[i % 200]}") for i in range(100)]
    want = document_wide(rows)
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("term")] for r in pt.find(docs(rows, 4)).collect()}
    assert got == {i: p for (i, _), p in zip(rows, want)} and any(want[2:42])
