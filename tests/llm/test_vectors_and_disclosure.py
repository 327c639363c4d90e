"""Whitening, vector codes and disclosure against plain versions, on small whole tables and odd rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import disclosure, equal_average, whitening
from ledgerloom.llm.integer_vectors import whole_vectors
from ledgerloom.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, size string, x string, n string, component int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "s", "x", "n", 1) for i, v, label in rows], VECTORS)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Null and broken vectors, extremes, repeated rows, a null id, ties, vectors of other lengths, clashing column names."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=20).tolist(), i % 3 if i % 5 else None) for i in range(90)]
    rows += [(i, rng.normal(size=3).tolist(), 1) for i in range(100, 110)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [math.nan] * 20, 1), (203, [math.inf] * 20, 1), (204, [], 1), (205, [1e300] * 20, 1)]
    rows += [(7, rows[7][1], 1), rows[8], rows[8], (None, [0.25] * 20, None), (301, [1e9] * 20, 2), (302, [-1e9] * 20, 2)]
    return vectors_of(spark, rows)


def good(df):
    """(vec_id, embedding, label) of the rows that stay, by vector length."""
    out = defaultdict(list)
    for r in df.collect():
        v = r["embedding"]
        if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 1e15 for c in v):
            out[len(v)].append((r["vec_id"], v, r["label"]))
    return out


# --- 11: whitening ---------------------------------------------------------------------------

@pytest.mark.parametrize("k", [1, 2, 3, 7, 40])
def test_rank_one_update_equals_a_full_decomposition(k):
    rng = np.random.default_rng(k)
    spread = rng.normal(size=(k + 3, k)) * 10.0 ** rng.integers(-4, 4, k)
    cases = [spread.T @ spread, np.zeros((k, k)), np.eye(k), np.diag(rng.integers(0, 3, k).astype(float)), np.ones((k, k))]
    for matrix in cases:
        for v in (rng.normal(size=k), rng.normal(size=k) * 1e-9, np.zeros(k), np.eye(k)[0] * 3.0, matrix[:, 0]):
            values, vectors = whitening.rank_one(*np.linalg.eigh(matrix), v)
            wanted = matrix + np.outer(v, v)
            size = max(float(np.abs(wanted).max()), 1e-300) * k
            assert np.abs(vectors @ np.diag(values) @ vectors.T - wanted).max() <= 1e-13 * size + 1e-300
            assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13 * k
            assert (np.diff(values) >= 0).all()


def test_spectra_of_parts_merge_to_that_of_all():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + 1000.0
    parts = []
    for part in (x[:3], x[3:3], x[3:150], x[150:]):
        s = whitening.Spectrum.empty(12)
        for v in part:
            s.add(v)
        parts.append(s)
    whole = parts[0]
    for s in parts[1:]:
        whole = whole.merge(s)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    assert whole.n == 400 and np.allclose(whole.mean, x.mean(axis=0), rtol=1e-13)
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - scatter).max() < 1e-11 * np.abs(scatter).max()


def plain_whitening(rows, k):
    """By vec_id and vector: deviation, whitened values and explained shares, from one decomposition of the covariance."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    spread = n * x - sums
    y = (spread / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return (spread * spread).sum(axis=1), y @ vectors, values, np.trace(y.T @ y / n)


def test_query_11_equals_one_decomposition(spark):
    found = defaultdict(dict)
    for r in REGISTRY["op11_whitened_embeddings"](spark, SF).collect():
        found[r["vec_id"]][r["component"]] = r
    rows = good(spark.read.parquet(f"{SF}/embeddings.parquet"))[64]
    deviation, projected, values, trace = plain_whitening(rows, 8)
    assert len(found) == len(rows) and all(sorted(r) == list(range(1, 9)) for r in found.values())
    first = [found[i] for i, _, _ in rows]
    assert [r[1]["deviation"] for r in first] == deviation.tolist() and {r[1]["n"] for r in first} == {len(rows)}
    for j in range(8):
        got, want = np.array([r[j + 1]["whitened"] for r in first]), projected[:, j] / np.sqrt(values[j])
        assert np.abs(got - want * np.sign(got @ want)).max() < 1e-9
        assert abs(first[0][j + 1]["explained"] - values[j] / trace) < 1e-12
    assert first[0][1]["identity_error"] < 1e-9


def test_incremental_spectrum_is_near_the_refined_one(spark):
    rows = whole_vectors(spark.read.parquet(f"{SF}/embeddings.parquet").repartition(5), whitening.SCALE, whitening.SHIFT)
    spectrum, = whitening.spectra(rows).values()
    model, = whitening.fit(rows).values()
    assert model.drift < 1e-11
    assert np.allclose(spectrum.values[::-1][:8] / spectrum.n, model.values, rtol=1e-10)


def test_whitening_of_odd_rows(spark, odd_vectors):
    got = whitening.whitened(odd_vectors).collect()
    kept = good(odd_vectors)
    by_n = defaultdict(list)
    for r in got:
        by_n[r["n"]].append(r)
    assert {n: len(rs) for n, rs in by_n.items()} == {len(kept[20]): 8 * len(kept[20]), len(kept[3]): 3 * len(kept[3])}
    assert sum(r["vec_id"] is None for r in got) == 8
    deviation, projected, values, trace = plain_whitening(kept[3], 3)
    small = sorted((r for r in by_n[len(kept[3])] if r["component"] == 2), key=lambda r: r["vec_id"])
    want = projected[:, 1] / np.sqrt(values[1])
    assert np.allclose(np.abs([r["whitened"] for r in small]), np.abs(want), rtol=1e-9)
    # The two extremes make the deviations too large for a long, and every other direction small but not zero.
    assert all(r["deviation"] is None for r in by_n[len(kept[20])] if r["vec_id"] == 301)
    assert whitening.whitened(vectors_of(spark, [])).count() == 0


def test_whitening_without_spread(spark):
    same = whitening.whitened(vectors_of(spark, [(i, [0.5, 0.25], 1) for i in range(4)])).collect()
    assert len(same) == 8 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in same)
    flat = whitening.whitened(vectors_of(spark, [(i, [float(i), 0.25], 1) for i in range(4)])).collect()
    assert sorted({(r["component"], r["whitened"] is None) for r in flat}) == [(1, False), (2, True)]
    assert flat[0]["identity_error"] < 1e-12


# --- 12: vector codes ------------------------------------------------------------------------

@pytest.mark.parametrize("width, most", [(4, 200), (3, 4), (1, 30), (6, 10 ** 12)])
def test_equal_average_search_finds_the_lowest_nearest_entry(width, most):
    rng = np.random.default_rng(width)
    rows, book = rng.integers(-most, most + 1, (300, width)), rng.integers(-most, most + 1, (50, width))
    book[7] = book[3]
    entry, distance = equal_average.nearest(rows, book)
    full = ((rows[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
    assert (entry == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, codebooks digest) of the rows of one length, number by number."""
    size = len(rows[0][1])
    width = -(-size // parts)
    cut = [[[*(math.floor(256 * c) for c in v), *[0] * (width * parts - size)][p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, cut[i]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            near = [min((sum((a - b) ** 2 for a, b in zip(row[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)]
            out.append(near)
        return out
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [row[p] for row, near in zip(cut, found) if near[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], bytes(j for _, j in near).hex(), sum(d for d, _ in near), digest) for r, near in zip(rows, assign())]


def test_codes_of_odd_rows_equal_plain_ones(spark, odd_vectors):
    got = equal_average.compressed(odd_vectors).collect()
    kept = good(odd_vectors)
    want = [row for rows in kept.values() for row in plain_codes(rows)]
    fits = lambda v: v if v < 1 << 63 else None
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted(((r["vec_id"], r["code"], r["error"], r["codebooks_sha256"]) for r in got), key=key) == sorted(
        ((i, c, fits(e), d) for i, c, e, d in want), key=key)
    errors = {(i, c): e for i, c, e, _ in want}
    sums = defaultdict(int)
    for rows in kept.values():
        for (_, _, label), (_, _, e, _) in zip(rows, plain_codes(rows)):
            sums[label] += e
    assert {r["label_error"] for r in got} == {fits(s) for s in sums.values()} and errors
    assert equal_average.compressed(vectors_of(spark, [])).count() == 0


def test_decoded_vectors_have_the_stated_error(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    kept = whole_vectors(vectors, equal_average.SCALE).cache()
    books = equal_average.fit(kept)
    near = equal_average.decoded(equal_average.encoded(kept, books), books, 64).join(kept.select("vec_id", "x"), "vec_id").collect()
    assert len(near) == kept.count()
    assert all(sum((a - b) ** 2 for a, b in zip(r["x"], r["approx"])) == r["error"] for r in near)


# --- 13: personal data -----------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    """Matches of the patterns as they are written, checked one by one."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            checks = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
            good = (True, all(int(p or 0) <= 255 for p in m[0].split(".") if p.isdigit()), 14 <= len(digits) <= 19 and checks % 10 == 0,
                    10 <= len(digits) <= 15)[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_spans_equal_the_patterns_as_written():
    rng = random.Random(3)
    for i in range(30_000):
        letters = "0123456789 -.+" if i % 3 else "ab0123459@@.. -+()4é\n"
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert [s[:3] for s in disclosure.base_spans(text)] == plain_spans(text), text
    assert [s[3] for s in disclosure.base_spans("A.b@C-d.ef 4111-1111 1111 1111 +1 (212) 555-0100, 1.2.3.004")] == [
        "a.b@c-d.ef", "4111111111111111", "+12125550100", "1.2.3.004"]


def line(spans):
    return ",".join(f"{disclosure.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check_report(spark, docs):
    got = defaultdict(list)
    for r in disclosure.report(docs).collect():
        got[r["doc_id"]].append(r)
    for doc in docs.collect():
        base = plain_spans(doc["text"])
        for r in got[doc["doc_id"]]:
            assert [r[f"n_{k}"] for k in disclosure.KINDS[:4]] == [sum(s[1] == i for s in base) for i in range(4)]
            assert r["base_sha256"] == hashlib.sha256(line(base).encode()).hexdigest()
            assert ",".join(s for s in r["spans"].split(",") if not s.startswith("term:")) == line(base)
    return got


def test_query_13_equals_the_patterns_on_the_supplied_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = check_report(spark, docs)
    assert sum(map(len, got.values())) == docs.count() == REGISTRY["op13_personal_data"](spark, SF).count()


@pytest.fixture(scope="module")
def corpus(spark):
    """A name that stands beside one address in many contexts, a nickname of a common class, a copied text, and plain text."""
    rng = random.Random(8)
    words = [a + b + c for a in ("ba", "co", "di", "fu", "ge", "lo", "mi", "nu") for b in ("ra", "se", "ti", "vo", "ka") for c in ("n", "l", "s", "m")]
    plain = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [plain(30) + ".\n" + plain(30) for _ in range(300)]
    texts += [f"{plain(6)} Zebulon {plain(5)} mail zeb@site.example.com {plain(6)}" for _ in range(8)]
    texts += [f"{plain(6)} ZEBULON went home" for _ in range(3)]                       # gives the address away without it
    texts += [f"{plain(6)} barbarossa {plain(5)} call +1 (212) 555-0100 {plain(6)}" for _ in range(8)]
    texts += [f"quibble {plain(12)} card 4111 1111 1111 1111"] * 9                      # copies are one context
    rare = plain(20)
    texts += [f"{rare} jabber 10.1.2.3 extra{i}" for i in range(9)]                    # near copies are one group
    return spark.createDataFrame([(i, t, "k", "b") for i, t in enumerate(texts)], "doc_id long, text string, terms string, base string")


def test_disclosing_terms_equal_plain_counts(spark, corpus):
    seen, groups, entities, together = defaultdict(int), defaultdict(lambda: defaultdict(set)), defaultdict(int), defaultdict(int)
    total = 0
    for doc in corpus.collect():
        spans = disclosure.base_spans(doc["text"])
        text = list(doc["text"])
        for a, _, b, _ in spans:
            text[a:b] = " " * (b - a)
        lines, at = [], 0
        for part in re.split(r"(?<=\n)|(?<=[.!?]\s)", "".join(text)):
            lines.append((at, at + len(part), part))
            at += len(part)
        for a, b, part in lines:
            found = re.findall(r"[^\W_]{3,}", part)
            for lo in range(0, len(found), disclosure.PASSAGE):
                terms = {w.lower() for w in found[lo:lo + disclosure.PASSAGE]}
                assert len(found) <= disclosure.PASSAGE
                total += 1
                terms |= {t[:3] + "*" for t in terms}
                for t in terms:
                    seen[t] += 1
                words = sorted(t for t in terms if t[-1] != "*")
                for e in {f"{disclosure.KINDS[k]}:{v}" for s, k, _, v in spans if a <= s < b}:
                    entities[e] += 1
                    for t in terms:
                        together[e, t] += 1
                        groups[e, t][min(map(disclosure._hash, words))].add(" ".join(words))
    plain = {}
    for (e, t), by_low in groups.items():
        sizes = [len(s) for s in by_low.values()]
        if sum(sizes) ** 2 / sum(s * s for s in sizes) >= 3:
            plain[e, t] = math.log(together[e, t] * total / (seen[t] * entities[e])) / math.log(total / entities[e])
    found = {(r["entity"], r["term"]): r["disclosure"] for r in disclosure.scored_pairs(disclosure.evidence(corpus)).collect()}
    assert found.keys() == plain.keys() and all(abs(found[k] - plain[k]) < 1e-9 for k in plain)
    wanted = {t: "" if plain.get((e, t[:3] + "*"), 0) >= 0.8 else t[:3] + "*" for (e, t), d in plain.items() if d >= 0.8 and t[-1] != "*"}
    terms = {r["term"]: r["replacement"] for r in disclosure.disclosing_terms(corpus).collect()}
    assert terms == wanted and terms["zebulon"] == "" and terms["barbarossa"] == "bar*"
    assert not {"quibble", "jabber", "went"} & terms.keys()


def test_term_spans_and_sanitised_texts(spark, corpus):
    got = check_report(spark, corpus)
    clean = {r["doc_id"]: r for r in disclosure.sanitised(corpus).collect()}
    assert len(clean) == corpus.count()
    for doc in corpus.collect():
        text, spans = doc["text"], got[doc["doc_id"]][0]["spans"]
        terms = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s.startswith("term:")]
        names = [m.span() for m in re.finditer("(?i)zebulon|barbarossa", text)]
        assert set(names) <= set(terms)
        row = clean[doc["doc_id"]]
        assert (row["terms"], row["base"]) == ("k", "b")
        assert not re.search("(?i)zebulon|barbarossa|@|555|1111|10\\.1", row["text"])
        if not spans:
            assert row["text"] == text
    assert "[EMAIL]" in clean[300]["text"] and "bar* " in clean[311]["text"] and clean[308]["text"].endswith("  went home")


def test_disclosure_of_odd_rows(spark):
    long = "x" * 2000 + "@" + "1" * 2000 + " a@b.cd"  # the patterns as written take the square of a run's length
    texts = [None, "", " ", "a", "@", "a@b", "1.2.3", long, "one two three " * 5000, "\x00 a@b.c ퟿ 中文字 1.2.3.4", "a@b.cd", "a@b.cd"]
    docs = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)] + [(None, "x a@b.cd", None), (3, "a", "y")], "doc_id long, text string, spans string")
    got = check_report(spark, docs)
    assert [len(disclosure.base_spans("x" * 500_000 + "@" + "1" * 500_000 + " a@b.cd"))] == [1]
    assert sum(map(len, got.values())) == 14 and got[0][0]["spans"] == "" and len(got[3]) == 2
    clean = disclosure.sanitised(docs)
    assert clean.columns == docs.columns and {r["text"] for r in clean.where("doc_id IS NULL").collect()} == {"x [EMAIL]"}
    assert clean.where("doc_id = 0 AND text IS NULL").count() == 1
    none = docs.limit(0)
    assert disclosure.report(none).count() == 0 and disclosure.sanitised(none).count() == 0
