"""The parts of the training-data operators that need no cluster, against plain versions."""

import hashlib
import random
import textwrap
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from innkeep.llm import components, langid, licenses, maxscore, neardup, packing, q_licenses, warc


def test_warc_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 4096, 50_000):
        payload = rng.randbytes(n)
        data = b"".join(warc.record_bytes(7, "http://a/\r\nb", payload, "D", "<urn:uuid:1>", None, 1000, 300))
        rows = [warc._row(r) for r in warc.parse_records(data)]
        if len(rows) == 1:
            assert (rows[0]["payload"], rows[0]["status"], rows[0]["row_id"]) == (payload, "ok", 7)
            continue
        rng.shuffle(rows)
        block, status = warc.join_segments([*rows, rows[0]])
        assert status == "ok" and warc.http_payload(block) == (payload, "ok")
        assert warc.join_segments(rows[1:])[1] != "ok"
    assert warc.decode_chunks(b"5\r\nhel") is None and warc.decode_chunks(b"zz\r\n") is None
    assert next(warc.parse_records(b"junk")) == {"error": "not a record"}


def test_words_equal_the_tokenizer():
    words, rng = packing.Words(packing.default_tokenizer()), random.Random(3)
    letters = "abzAZ'st0189 \t\n_-!?.,'re'LL\xa0éÉßªº²½µÀÿĀłŸžİŁ<|>~`^"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert words.ids(t) == words.whole(t)
    assert words.ids(None) == words.ids("") == b""


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 400)
    bins = packing.best_fit(lengths, 100)
    filled = np.bincount(bins, lengths)
    assert filled.max() <= 100 and len(filled) <= 1.25 * -(-lengths.sum() // 100)
    assert len(packing.best_fit(np.array([], int), 100)) == 0


def test_shingles_and_intersections():
    texts = [b"", None, b"One", b"a b", b"A B a b", b"x\x0by  z\tx y", "é É".encode()]
    for n in (1, 2, 5):
        plain = []
        for t in texts:
            w = (t or b"").lower().split()
            plain.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        got = neardup.shingle_sets(texts, n)
        assert [len(s) for s in got] == [len(s) for s in plain]
        assert neardup.intersections(got, got).tolist() == [[len(a & b) for b in plain] for a in plain]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.9):
        base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        both, a, b = base[: int(1000 * share)], base[1000:1500], base[1500:]
        one, two = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
        j = len(both) / (len(one) + len(two) - len(both))
        assert abs((neardup.signature(one) == neardup.signature(two)).mean() - j) < 0.15


def test_union_find():
    assert components.roots(6, np.array([1, 4, 2]), np.array([2, 5, 1])) == [0, 1, 1, 3, 4, 4]


@pytest.mark.parametrize("floor", [None, -1e9, 0.0, 500.0, 1e9])
def test_maxscore_block(floor):
    rng = np.random.default_rng(2)
    x, q = np.floor(rng.normal(0, 20, (300, 40))), np.floor(rng.normal(0, 20, 40))
    at, score = maxscore.search_block(q, x, x.min(axis=0), x.max(axis=0), floor)
    full = x @ q
    want = np.flatnonzero(full >= (floor if floor is not None else -np.inf))
    assert at.tolist() == want.tolist() and np.array_equal(score, full[want])


def test_viterbi_against_recursion():
    rng = np.random.default_rng(4)
    s = rng.normal(0, 4, (60, 3)).astype(np.float32)
    starts, ends = np.array([0, 1, 25]), np.array([1, 25, 60])
    for path, a, b in zip(langid._viterbi(s, starts, ends, 5.0), starts, ends, strict=True):
        got = sum(s[a + i, k] for i, k in enumerate(path)) - 5.0 * int((np.diff(path) != 0).sum())
        v = s[a].astype(float)
        for t in range(a + 1, b):
            v = np.maximum(v, v.max() - 5.0) + s[t]
        assert abs(got - v.max()) < 1e-3


def _random_model(rng, n):
    scripts = np.zeros((len(langid.SCRIPT_NAMES), n))
    scripts[langid.SCRIPT_NAMES.index("Latin")] = 1
    return langid.Model([f"l{k}" for k in range(n)], rng.integers(0, 4, (langid.BUCKETS, n)).astype(float) ** 3, scripts)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_labels_equal_those_of_the_plain_recursion(n):
    """With and without the proof that spares the recursion, on texts whose languages mostly mix."""
    rng = np.random.default_rng(n)
    model = _random_model(rng, n)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 7)))) for _ in range(4000)]
    best = {w: langid.label(model, [w])[0]["lang"] for w in words}
    of = {lang: [w for w in words if best[w] == lang] for lang in model.langs}
    texts = []
    for _ in range(4000):
        stretches = [rng.choice(of[model.langs[rng.integers(n)]], rng.integers(1, 9)).tolist() for _ in range(rng.integers(1, 5))]
        texts.append(" ".join(w for part in stretches for w in part))
    got = langid.label(model, texts, 12.0)
    spared = sum(len(g["spans"]) == 1 for g in got)
    for text, g in zip(texts, got, strict=True):
        c, _ = langid.codes([text])
        at, h = langid.trigrams(c)
        first = np.flatnonzero(c[at - 1] == 0)
        s = np.add.reduceat(model.logp[h], first, axis=0).astype(float)
        v, back = s[0], []
        for row in s[1:]:
            back.append(np.where(v >= v.max() - 12.0, np.arange(n), v.argmax()))
            v = np.maximum(v, v.max() - 12.0) + row
        path = [int(v.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        path.reverse()
        letters = [len(w) for w in text.split()]
        weight = np.bincount(path, letters, n)
        assert (g["lang"], round(g["score"], 9)) == (model.langs[int(weight.argmax())], round(weight.max() / sum(letters), 9))
        assert [x[2] for x in g["spans"]] == [model.langs[path[i]] for i in range(len(path)) if not i or path[i] != path[i - 1]]
    assert 0 < spared < len(texts)


def test_marks_belong_to_words():
    count = lambda t: len(np.flatnonzero(np.diff((langid.codes([t])[0] != 0).astype(int)) == 1))
    assert [count(t) for t in ("हिन्दी भाषा", "বাংলা", "ภาษาไทย", "e\u0301te\u0301", "\u0301 a", "a \u0301b", "\u0301")] == [2, 1, 1, 1, 1, 2, 0]
    model = _random_model(np.random.default_rng(1), 2)
    assert langid.label(model, ["\u0301\u0302", "a\u0301"])[0]["lang"] == "und" != langid.label(model, ["a\u0301"])[0]["lang"]


def test_language_scores_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, (langid.BUCKETS, 3)).astype(float)
    scripts = np.zeros((len(langid.SCRIPT_NAMES), 3))
    scripts[langid.SCRIPT_NAMES.index("Latin")] = 1
    model = langid.Model(["a", "b", "c"], counts, scripts)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, rng.integers(1, 9)))) for _ in range(n)) for n in (1, 40, 300)] + [None, "", "!"]
    want = langid.label(model, texts)
    for size in (1, 7, 100):
        monkeypatch.setattr(langid, "LETTERS_AT_ONCE", size)
        assert langid.label(model, texts) == want


def test_language_spans():
    texts = {"aa": "kal mor tek " * 200, "bb": "lusi ena vio " * 200}
    counts = np.zeros((langid.BUCKETS, 2))
    scripts = np.zeros((len(langid.SCRIPT_NAMES), 2))
    for k, t in enumerate(texts.values()):
        _, h = langid.trigrams(langid.codes([t])[0])
        counts[:, k] += np.bincount(h, minlength=langid.BUCKETS)
        scripts[langid.SCRIPT_NAMES.index("Latin"), k] = 100
    model = langid.Model(list(texts), counts, scripts)
    got = langid.label(model, ["kal mor tek kal mor lusi ena vio lusi ena vio vio", "", None, "123 !", "мир", "tek"])
    assert [g["lang"] for g in got] == ["bb", "und", "und", "und", "aa", "aa"]
    assert [x[2] for x in got[0]["spans"]] == ["aa", "bb"] and got[0]["spans"][1] == (20, 49, "bb")
    assert got[4]["score"] == 0.0 and got[5]["score"] == 1.0


def test_license_forms_are_told_apart():
    assert len(licenses.digests()) == len(licenses.KNOWN) + len(licenses.PUBLISHED)
    plain = licenses.canonical_text(licenses.KNOWN[0][1])
    assert licenses.canonical_text("Copyright (c) 2020 Some One\n" + licenses.KNOWN[0][1].upper().replace(",", " ;")) == plain


def test_license_digests_do_not_depend_on_wrapping():
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
    known = licenses.digests()
    name = lambda t: known.get(hashlib.sha256(licenses.canonical_text(t).encode()).hexdigest())
    for want, title, text in [("MIT", "MIT License", mit), ("ISC", "ISC License", isc)]:
        for full in [text, f"{title}\n\n{text}", f"{title}\n\nCopyright (c) 2020 Some One. All rights reserved.\n\n{text}", f"Copyright 2020 Some One\n{text}"]:
            assert [name(full), name(" ".join(full.split()))] == [want, want]
            assert {name(textwrap.fill(" ".join(full.split()), w)) for w in range(50, 121)} == {want}
    assert "liable" in licenses.canonical_text("copyright holders be liable\n(c) You must retain this") and "retain" in licenses.canonical_text("x\n(c) You must retain this")
    assert licenses.canonical_text("a\n# Copyright (C) 2001-2020 Permanent Press\r\n © Some One\nAll rights reserved.\nb") == "a b"


COMMON = Path("/usr/share/common-licenses")
FILES = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3-only", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0"}


def _wrappings(text):
    one = " ".join(text.split())
    return [text, one, textwrap.fill(one, 60, break_long_words=False, break_on_hyphens=False)]


@pytest.mark.skipif(not COMMON.is_dir(), reason="no published texts on this machine")
@pytest.mark.parametrize("file", sorted(FILES))
def test_published_texts_in_three_wrappings(file):
    known = licenses.digests()
    for text in _wrappings((COMMON / file).read_text()):
        assert known.get(hashlib.sha256(licenses.canonical_text(text).encode()).hexdigest()) == FILES[file]


def long_holders():
    """Licences below long lists of holders, plain statements, links and bullets, with their names."""
    mit, bsd = licenses._MIT, licenses._BSD_HEAD + licenses._BSD_NAMES + licenses._BSD_TAIL
    names = [f"Holder Number {i} of Some Place" for i in range(40)]
    return [
        ("MIT", "MIT License\n\nCopyright (c) 2020\n" + "\n".join(names[:14]) + "\n\n" + mit), ("MIT", "Copyright (c) 2020 " + "Jane Doe " * 120 + "\n\n" + mit),
        ("MIT", "MIT License Copyright (c) 2020 " + ", ".join(names) + " " + " ".join(mit.split())), ("MIT", "MIT License\n\nCopyright Jane Doe\n\nCopyright John Doe\n" + mit),
        ("MIT", mit + "\n\nhttps://opensource.org/licenses/MIT\n"), ("BSD-3-Clause", "Copyright Jane Doe\n\n" + licenses._bulleted(bsd)), ("Zlib", "Copyright (c) 2001 X\n\n" + licenses._ZLIB),
        ("0BSD", "Copyright (C) 2006 by X <x@example.org>\n\n" + licenses._0BSD), (None, "Copyright 2020 X\n\nA story of some length.\n\n" + mit),
    ]


def test_long_lists_of_holders():
    known = licenses.digests()
    assert [known.get(hashlib.sha256(licenses.canonical_text(t).encode()).hexdigest()) for _, t in long_holders()] == [n for n, _ in long_holders()]


def test_licenses_against_sql(spark):
    texts = [t for _, known in licenses.KNOWN for t in _wrappings(known)] + [(COMMON / f).read_text() for f in FILES if COMMON.is_dir()]
    texts += [t for _, t in long_holders()] + ["A text\nReleased under the MIT License.\nLicensed under CC BY 4.0.", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + licenses.KNOWN[0][1], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))
    want = con.execute(q_licenses.ORACLE["op10_license_digest"]).fetchall()
    out = licenses.scan(docs, "text").collect()
    assert sorted((r["doc_id"], r["digest"], r["license"], ",".join(r["notices"])) for r in out) == sorted(want)
    assert sum(r["license"] is not None for r in out) >= len(texts) - 5


def test_copyright_lines_agree_in_spark(spark):
    texts = [t for _, t in licenses.KNOWN] + ["Copyright (c) 2020 " + "word " * 5000, "MIT License Copyright (c) 2020 Some One\n" + licenses.KNOWN[0][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["digest"] for r in licenses.scan(docs, "text").collect()}
    assert got == {i: hashlib.sha256(licenses.canonical_text(t).encode()).hexdigest() for i, t in enumerate(texts)}
