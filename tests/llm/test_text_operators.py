"""Fingerprints, spelling variants and fill-in-the-middle against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fill_middle, lexicon, near_dup, spelling
from tessera.llm.common import ship, stored

EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "A."), (5, "the same words here again and again for all"), (5, "the same words here again and again for all"), (6, "word " * 30_000), (None, "no id at all"), (7, "é" * 50 + " ß 日本語 \U0001f600"), (8, "\n\nа б\r\nв"), (9, "x<P>y"), (10, "<S\n<M\n>"), (11, "日本語の文章はここで終わる")]


def docs_of(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit("x"), "n": F.lit(1), "word": F.lit("y"), "copies": F.lit(3)})


# -- fill in the middle ----------------------------------------------------------


UNITS = {"lines": r"[^\n]*\n|[^\n]+", "words": r"[^ \t\n\x0b\x0c\r]*[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+", "chars": r"(?s:.)"}


def brute_middle(doc, text, units="lines", rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    u = re.findall(UNITS[units], text)
    assert "".join(u) == text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc, len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return doc, len(u), "spm" if h4 % 100 < spm else "psm", len(p), len(m), out


@pytest.mark.parametrize("units,rate,spm", [("lines", 100, 50), ("words", 70, 20), ("chars", 100, 100)])
def test_fill_middle(units, rate, spm, spark, sf, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()] + EDGE
    expected = sorted((brute_middle(*r, units, rate, spm) for r in rows), key=repr)
    out = fill_middle.transform(docs_of(spark, rows), units=units, rate=rate, spm=spm)
    found = out.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in found), key=repr) == expected
    texts = Counter((d, t or "") for d, t in rows)
    assert Counter((r["doc_id"], r["back"]) for r in found) == texts
    assert {r["form"] for r in found} == ({"plain", "spm"} if spm == 100 else {"plain", "psm", "spm"})


def test_slices_and_long_documents_agree(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\n日") for _ in range(rng.choice([0, 1, 5, 400]))) for _ in range(200)] + [None, "long\n" * 5000]
    draws = [pa.array([rng.randrange(1 << 32) for _ in texts], pa.int64()) for _ in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), *draws], names=["doc_id", "text", "h1", "h2", "h3", "h4"])
    whole = fill_middle._form_batch(batch, "lines", 100, 50)
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 900)
    parts = [fill_middle._form_batch(p, "lines", 100, 50) for p in fill_middle.sliced(batch, 1, 900)]
    assert len(parts) > 5 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()


# -- spelling variants -----------------------------------------------------------


def brute_words(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute_variants(words):
    shorter = {}
    for w in words:
        for i in range(len(w)):
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in words}
    for cut, found in shorter.items():
        if cut in near:
            for w in found:
                near[w].add(cut)
                near[cut].add(w)
    for w in words:
        for i in range(len(w)):  # replaced: equal without the letter at i
            near[w] |= {v for v in shorter[w[:i] + w[i + 1 :]] if len(v) == len(w) and v != w and v[:i] + v[i + 1 :] == w[:i] + w[i + 1 :]}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_spelling_of_all_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_variants(brute_words(rows))
    assert any(r[1] for r in expected) and len(expected) > 1000
    found = spelling.op12(spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_spelling_chains_hubs_and_short_alphabets(spark):
    rng = random.Random(5)
    words = {"abcdefgh": 100_000, "abcdefghi": 10_000, "abcdefghij": 1000, "abcdefghijk": 100, "abcdefghijkl": 3, "abcdefgi": 100_000, "bcdefghi": 4, "a" * 3000: 5, "a" * 3001: 60, "a" * 2999 + "b": 2}
    words |= {"".join(rng.choice("ab") for _ in range(rng.choice([7, 8, 9]))): rng.choice([2, 5, 30, 400]) for _ in range(300)}  # repeated bigrams
    words |= {"hubword" + chr(97 + i % 26) + chr(97 + i // 26): 2 + i % 3 for i in range(200)} | {"hubworda": 500}
    vocab = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.variants(vocab).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(brute_variants(words), key=repr)
    assert {r["root"] for r in found if r["word"].startswith("abcdefghijk")} == {"abcdefgh"}


def test_spelling_edges(spark):
    rows = [*EDGE, (None, "Straßenbahn straßenbahn STRASSEN"), (12, "ÀÉÎÕÜÝÞ àéîõüýþ ÀÉÎÕÜÝÞ"), (13, "z" * 50_000 + " " + "z" * 50_000)]
    vocab, _ = stored(spelling.vocabulary(spelling.with_typos(spelling.runs(docs_of(spark, rows)))), "words")
    assert sorted(map(tuple, spelling.variants(vocab).collect()), key=repr) == sorted(brute_variants(brute_words(rows)), key=repr)


# -- I-Match ---------------------------------------------------------------------


def of_bytes(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


SCRIPTS = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"


def brute_terms(text):
    import regex

    found = regex.findall(rf"(?V1)[\p{{L}}\p{{M}}\p{{N}}--[{SCRIPTS}]]+|[{SCRIPTS}]", text.lower())
    return set(found) or ({text} if text else set())


def brute_fingerprint(text, in_band):
    terms = {signed(of_bytes(t.encode())) for t in brute_terms(text)}
    band = {t for t in terms if in_band(t)}
    chosen, out = band if len(band) >= 4 else terms, []
    for seed in range(24) if terms else ():
        hashes = [of_bytes(struct.pack("<i", seed), of_bytes(struct.pack("<q", t))) >> 1 for t in chosen]
        edge = (1 << min(hashes).bit_length()) - 1
        h = 42
        for x in sorted(x for x in hashes if x <= edge):
            h = of_bytes(struct.pack("<q", x), h)
        out.append(f"{h & 0xFFFFFFFF:08X}")
    return out


def brute_imatch(rows):
    texts = [(d, t or "") for d, t in rows]
    df = Counter(t for _, text in texts for t in brute_terms(text))
    bits = {signed(of_bytes(t.encode())) & 0xFFFFF for t, n in df.items() if 0.002 * len(texts) <= n <= 0.05 * len(texts)}
    in_band = lambda t: t & 0xFFFFF in bits
    order = sorted(set(texts), key=lambda x: (x[0] is None, -(x[0] or 0), signed(of_bytes(x[1].encode(), of_bytes(struct.pack("<q", x[0])) if x[0] is not None else 42))))
    following = {x: order[(i + 1) % len(order)] for i, x in enumerate(order)}
    like = lambda a, b: 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
    out = []
    for x in texts:
        doc, text = x
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[x][1][:cut]
        mine, theirs, edit = (brute_fingerprint(t, in_band) for t in (text, following[x][1], changed))
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), "".join(mine), "".join(edit), round(like(mine, edit), 9), round(like(mine, theirs), 9)))
    return out


def test_imatch_as_brute_force(spark, sf, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(120).collect()] + [(None if d is None else d + 10_000, t) for d, t in EDGE] + [(10_005, "the same id with another text")]
    path = f"file://{tmp_path}/data"
    docs_of(spark, rows).write.parquet(f"{path}/documents.parquet")
    found = [(*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in lexicon.op11(spark, path).collect()]
    assert sorted(found, key=repr) == sorted(brute_imatch(rows), key=repr)


def test_imatch_tells_edits_from_neighbours(spark, sf):
    rows = lexicon.op11(spark, sf).collect()
    assert np.mean([r["near_edited"] for r in rows]) > 0.35 and np.mean([r["near_next"] for r in rows]) < 0.05
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.95
    by_text = {}
    for t, f in zip(*(spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("text").toPandas()["text"], sorted(rows, key=lambda r: r["doc_id"]))):
        assert by_text.setdefault(t, f["fingerprint"]) == f["fingerprint"]


def test_a_document_alone_is_its_own_next(spark, tmp_path):
    path = f"file://{tmp_path}/one"
    docs_of(spark, [(3, "one text of a few words")]).write.parquet(f"{path}/documents.parquet")
    (row,) = lexicon.op11(spark, path).collect()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"one text of a fe" + b"one tex").hexdigest()


# -- near duplicates at the threshold ------------------------------------------------


@pytest.mark.parametrize("limit", [16, 4096])
def test_recall_of_near_duplicates_at_the_threshold(limit, spark, monkeypatch):
    """Pairs of similarity 0.80 to 0.87, all with a passage in common, in buckets small and large: nine of ten links at least."""
    monkeypatch.setattr(near_dup, "LIMIT", limit)
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage, rows, pairs = [word() for _ in range(60)], [], []
    for i in range(300):
        text = [word() for _ in range(140)]
        at = rng.randrange(140)
        text[at:at] = passage
        changed = list(text)
        for j in rng.sample(range(200), rng.randint(26, 40)):
            changed[j] = word()
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(changed))]
        pairs.append((2 * i, 2 * i + 1))
    docs = docs_of(spark, rows)
    docs.write.mode("overwrite").parquet(path := f"{near_dup.stored(docs, 'near')[1]}-docs/documents.parquet")
    classes = {r["doc_id"]: r["class_id"] for r in near_dup.op8(spark, path.removesuffix("/documents.parquet")).collect()}
    found = [classes[a] == classes[b] for a, b in pairs]
    assert np.mean(found) >= 0.9, np.mean(found)
    assert len(set(classes.values())) == 600 - sum(found)  # nothing else is joined
