"""The training-text operators against brute force, round trips and held-out labels, on small whole tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (bin_completion, centroid_language, chunk_recipes, collision_projections, dart_minhash, mixing,
                            pairwise_quality, token_rollup, toxicity, url_rules)
from ledgerloom.llm.bpe import TOKENIZER_FILE, byte_bpe, vocabulary_path
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, score string, fp string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, repeated rows, ties, clashing column names."""
    long_text = " ".join(f"w{i % 5000}x{i // 7}" for i in range(30000))
    texts = [None, "", "", "a", "one two", long_text, long_text, "x\n\ty  z \x0b", "<|endoftext|> é 中文 \u2003 it's", "a" * 5000, "  \n ", "12345 !!"]
    data = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None, "q", "r", None, "f") for i, t in enumerate(texts)]
    return spark.createDataFrame([*data, data[4], data[4], (None, "one two", None, None, None, None, None, None, None)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_check_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF}/{view}.parquet')")
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert rows(REGISTRY[name](spark, SF), *columns) == sorted(result.fetchall(), key=str)


# --- components ------------------------------------------------------------------------------

def test_components_match_a_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, None)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect())
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if b is not None and a != b:
            p, q = top(a), top(b)
            parent[max(p, q)] = min(p, q)
    assert found == {x: top(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --- 1: mixing -------------------------------------------------------------------------------

def test_targets_fill_up_to_a_common_level(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 50), ("d", 0)], "source string, size long")
    found = {r["source"]: r for r in mixing.targets(sized).collect()}
    assert [found[s]["weight"] for s in ("a", "b", "c", "d", None)] == [1, 2, 3, 1, 2]
    left, capped = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}, {}
    while True:  # plain rounds of capping
        level = (1160 - sum(capped.values())) / sum(w for s, w in left.items())
        over = [s for s, w in left.items() if w * level > 3 * found[s]["source_size"]]
        if not over:
            break
        for s in over:
            capped[s] = 3.0 * found[s]["source_size"]
            del left[s]
    want = capped | {s: w * level for s, w in left.items()}
    assert all(abs(found[s]["target"] - want[s]) < 1e-9 for s in want)


def test_mix_reaches_targets_and_reruns_agree(spark):
    docs = table(spark, "documents")
    once, again = (mixing.taken(docs) for _ in range(2))
    assert rows(once, "doc_id", "taken") == rows(again, "doc_id", "taken")
    for r in once.groupBy("source_size", "target").agg(F.sum("taken").alias("n"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(r["n"] - r["target"]) <= 1 and r["over"] <= 0


def test_schedule_is_even_at_every_length(spark):
    slots = mixing._slots(spark, [4000, 2000, 2000], 1).orderBy("slot").collect()
    assert Counter(r["k"] for r in slots) == {0: 4000, 1: 2000, 2: 2000}
    taken = np.cumsum([r["k"] == 0 for r in slots])
    assert np.abs(taken - 0.5 * np.arange(1, 8001)).max() < 12  # independent draws stray by about 45


def test_registered_schedule_is_even_and_whole(spark):
    found = REGISTRY["op1_mix_schedule"](spark, SF).collect()
    words, places = Counter(), {}
    for r in found:
        words[r["doc_id"]] += r["word_to"] - r["word_from"]
        assert places.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
    assert +words == +Counter({r["doc_id"]: r["taken"] for r in REGISTRY["op1_mix_to_weights"](spark, SF).collect()})
    order = [places[slot][0] for slot in sorted(places)]
    assert len(set(places.values())) == len(places)
    for source, n in Counter(order).items():
        gone = np.cumsum([x == source for x in order])
        assert np.abs(gone - n / len(order) * np.arange(1, len(order) + 1)).max() < 6
        assert [places[s][1] for s in sorted(places) if places[s][0] == source] == list(range(n))


def test_whole_documents_stand_in_the_order_of_the_schedule(spark):
    docs = table(spark, "documents")
    block = 64
    rank = defaultdict(list)                            # source -> the slots of its blocks, in order
    for r in sorted(mixing.schedule(docs, block).select("slot", "source", "block").distinct().collect(), key=lambda r: r["slot"]):
        rank[r["source"]].append(r["slot"])
    found = mixing.whole_documents(docs, block).collect()
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    at, last = Counter(), -1
    for r in found:                                     # each stands at the slot of the block that its first word falls into
        slot = rank[r["source"]][at[r["source"]] // block]
        assert slot >= last
        at[r["source"]], last = at[r["source"]] + size(r), slot
    assert len(found) > 100 and len({r["source"] for r in found[:40]}) > 3


def test_mix_keeps_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 1.5, "r"), (2, "d", "t", 2.5, "q")], "doc_id long, text string, source string, size double, row string")
    sized, _, mixed = mixing.mix(docs)
    assert rows(sized, "doc.size", "doc.row", "size") == [(1.5, "r", 3), (2.5, "q", 1)] and mixed.count() > 0
    assert rows(mixing.whole_documents(docs), "size", "row")[0] == (1.5, "r")


def test_mixed_documents_keep_words_and_columns(spark, odd_docs):
    found = mixing.mixed_documents(odd_docs)
    assert found.columns == odd_docs.columns
    words = Counter()
    for r in found.collect():
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    taken = Counter()
    for r in mixing.taken(odd_docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken
    assert mixing.taken(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0


def test_source_mix_keeps_documents_whole(spark, odd_docs):
    long_text = "\n".join(f"w{k}" for k in range(3000))  # the only one of its source, cut by the target
    lone = spark.createDataFrame([(0, "a b\nc", "s0"), (1, "d e", "s0"), (2, long_text, "s1"), (3, "f\ng", "s2")], "doc_id long, text string, source string")
    stage, cut = dict(corpus_pipeline.STAGES)["source_mix"], 0
    for docs in (table(spark, "documents"), odd_docs, lone):
        found = stage(spark, docs, SF)
        texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
        sizes = {(r["doc_id"], r["size"]) for r in mixing.taken(docs).collect()}
        times = Counter((r["doc_id"], r["text"]) for r in found.collect())
        assert found.columns == docs.columns and set(times) <= texts
        size = dict(sizes)
        names = {r["doc_id"]: r["source"] for r in docs.collect()}
        words, want, largest = Counter(), {}, Counter()
        for (doc_id, _), n in times.items():
            words[names[doc_id]] += n * size[doc_id]
        for r in mixing.taken(docs).collect():
            source = names[r["doc_id"]]
            want[source], largest[source] = r["target"], max(largest[source], r["size"])
            cut += r["size"] > 0 and r["taken"] % r["size"] > 0
        for source, target in want.items():
            assert words[source] > 0 or target < 0.5
            assert abs(words[source] - target) <= largest[source] / 2 + 1 or words[source] == largest[source]
    assert cut and stage(spark, empty(spark), SF).count() == 0


# --- 2: near copies --------------------------------------------------------------------------

def brute_classes(docs):
    sets = {}
    for doc_id, text in docs:
        w = (text or "").lower().split()
        sets[doc_id] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in holders[x] if e > d).items():
            if n >= 0.8 * (len(s) + len(sets[e]) - n):
                p, q = top(d), top(e)
                parent[max(p, q)] = min(p, q)
    return {d: top(d) for d in sets}


def test_near_classes_match_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    for k in range(60):  # a large class whose members are close to one hub, and less to each other
        words = list(base)
        for at in rng.sample(range(300), k % 8):
            words[at] = f"new{k}.{at}"
        docs.append((100_000 + k, " ".join(words)))
    found = dart_minhash.near_classes(spark.createDataFrame(docs, "doc_id long, text string"), 0.8).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(docs)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_blocks_of_a_cluster_lose_nothing(spark):
    docs = [(k, " ".join(f"w{i}" for i in range(100)) + f" end{k}") for k in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    listed = dart_minhash.described(frame)
    assert connected_components(dart_minhash.verified_edges(frame, listed, block=7), "t").agg(F.countDistinct("root")).first()[0] == 1


def test_classes_of_a_wide_cluster_match_brute_force(spark):
    """Copies of one text at all distances, sharing half of their words with another family: several classes, many blocks."""
    rng = random.Random(11)
    shared = [f"c{k}" for k in range(70)]
    families = [shared + [f"{f}{k}" for k in range(60)] for f in "xyz"]
    texts = []
    for k in range(160):
        words = list(families[0 if k % 4 else 1 + k % 3 % 2])
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_classes(list(enumerate(texts)))
    assert len(set(expected.values())) > 5
    for block in (9, 400):
        found = dart_minhash.near_classes(frame, block=block).collect()
        assert {r["doc_id"]: r["class_id"] for r in found} == expected


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    x, y = rng.uniform(0.1, 5.0, 60), rng.uniform(0.1, 5.0, 60)
    agree = np.mean(dart_minhash.signature(elements, x, 4096) == dart_minhash.signature(elements, y, 4096))
    assert abs(agree - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.04


def test_near_copies_odd_rows(spark, odd_docs):
    found = dart_minhash.near_classes(odd_docs).collect()
    by = defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
    assert len(found) == odd_docs.count() and {r["class_id"] for r in by[5] + by[6]} == {5}
    assert all(r["class_size"] == 1 and r["kept"] for d in (0, 1, 2, 10) for r in by[d])
    assert sum(r["kept"] for r in by[4] + by[None]) == 1 and by[None][0]["class_id"] == 4
    kept = dart_minhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in found)
    assert dart_minhash.near_classes(empty(spark)).count() == 0


def test_rows_without_words_are_no_copies_of_one_another(spark):
    """Every class keeps one row, in the classes and in the stage; columns with private-looking names survive."""
    texts = [(1, None), (1, None), (2, ""), (2, " \n\t "), (3, "a b"), (3, "a b"), (4, "\u2003"), (None, "")]
    docs = spark.createDataFrame([(i, t, f"o{k}", f"r{k}") for k, (i, t) in enumerate(texts)], "doc_id long, text string, __own string, __row string")
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in dart_minhash.drop_near_copies(docs).collect())
    assert kept == [(0, ""), (1, ""), (1, ""), (2, ""), (2, " \n\t "), (3, "a b"), (4, "\u2003")]
    assert sum(r["kept"] for r in dart_minhash.near_classes(docs).collect()) == len(kept)
    for stage in (dart_minhash.drop_near_copies, chunk_recipes.drop_copies):
        out = stage(docs)
        assert out.columns == docs.columns and all(r["__own"][0] == "o" and r["__row"][0] == "r" for r in out.collect())


@pytest.mark.parametrize("scale", [1e200, 1e-200, 5e-320])
def test_extreme_vectors_link_like_others(spark, scale):
    rng = np.random.default_rng(2)
    base, other = rng.normal(size=16), rng.normal(size=16)
    vectors = [base, base * 1.01 + 1e-3, base, other, np.zeros(16)]
    data = [(i, (np.clip(v, -9, 9) * scale).tolist()) for i, v in enumerate(vectors)] + [(None, (other * 1e-3).tolist()), (None, [0.0] * 16)]
    found = collision_projections.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    by = {r["vec_id"]: r for r in found if r["vec_id"] is not None}
    assert [(by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) for i in range(5)] == [
        (2, 0, True), (2, 0, False), (2, 0, False), (1, 3, True), (0, 4, True)]
    assert sorted((r["n_links"], r["component_id"], r["kept"]) for r in found if r["vec_id"] is None) == [(0, None, True), (1, 3, False)]


# --- 3, 7, 10: classifiers -------------------------------------------------------------------

@pytest.mark.parametrize("name, label, least", [("op3_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_labels(spark, name, label, least):
    sf = SF.replace("0.001", "0.01")
    found = REGISTRY[name](spark, sf).cache()
    pairs = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert found.count() == 1000 and found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert pairs.where(f"predicted = {label}").count() >= least * pairs.count()
    assert {r[0] for r in found.where("held_out").select("doc_id").collect()} == {d for d in range(1000) if zlib.crc32(str(d).encode()) % 5 == 0}


def test_classifiers_on_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2 if i % 5 else None, (i + 1) % 2) for i in range(12)] * 2, "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for score in (pairwise_quality.scored, toxicity.scored):
        for known in (labels, none):
            found = score(odd_docs, known).collect()
            assert len(found) == odd_docs.count() and all(0.0 <= r["score"] <= 1.0 for r in found)
        assert score(empty(spark), labels).count() == 0
    kept = toxicity.drop_toxic(odd_docs, labels)
    assert kept.columns == odd_docs.columns


def test_disguised_words_count():
    tokens = toxicity.Tokens(frozenset({"=moron", "idiot"}))
    at = {f: k for k, f in enumerate(toxicity.FEATURES)}
    plain, disguised, spelled, clean = (toxicity.features(t, tokens) for t in ("you moron go", "you m0r0n go", "such a m o r o n here", "you are kind"))
    assert plain[at["hit_density"]] > 0 and plain[at["near_person"]] == 1.0
    assert disguised[at["disguised_density"]] > 0 and spelled[at["log_hits"]] > 0 and clean[at["log_hits"]] == 0


def test_preferences_order_documents():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(1.0, 1.0, (300, 3)), rng.normal(0.0, 1.0, (200, 3))
    weights = pairwise_quality.bradley_terry(good, bad)
    assert (weights > 0.5).all()


def test_language_held_out_and_odd_rows(spark, odd_docs):
    found = REGISTRY["op10_language"](spark, SF.replace("0.001", "0.01")).join(
        spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    model = centroid_language.fit(odd_docs, F.lit(True))
    by = {r["doc_id"]: r for r in centroid_language.predict(odd_docs, model, -1.0).collect()}
    assert by[0]["lang_pred"] == by[1]["lang_pred"] == by[11]["lang_pred"] == "und" and by[3]["lang_pred"] == "en"
    assert centroid_language.predict(empty(spark), centroid_language.fit(empty(spark), F.lit(True))).count() == 0
    assert centroid_language.predict(odd_docs, model, 2.0).where("lang_pred <> 'und'").count() == 0  # everything is too far


def test_samples_hold_one_row_of_a_doc_id(spark):
    docs = spark.createDataFrame([(1 + k % 3 * (k % 10 == 0), f"word{k % 50} text", "en") for k in range(600)] + [(1, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    learned = {d for d in ids if zlib.crc32(str(d).encode()) % 5}
    for label in ("quality", "toxic"):
        found = toxicity.labelled_sample(docs, labels, label, 4000).collect()
        assert len(found) == len(learned) and {(r["doc_id"], r["label"]) for r in found} == {(d, d % 2) for d in learned}
    found = centroid_language.language_sample(docs, F.lit(True), 400).collect()
    assert sorted(r["doc_id"] for r in found) == sorted({r["doc_id"] for r in found}) and all(r["text"] for r in found) and found


# --- 4: embeddings ---------------------------------------------------------------------------

def test_vector_links_match_brute_force(spark):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((6, 24))
    data = np.concatenate([rng.standard_normal((150, 24)), *(c + s * rng.standard_normal((60, 24)) for c, s in zip(centre, (0.02, 0.1, 0.2, 0.3, 0.4, 0.5)))])
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    extra = [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [None] + [1.0] * 23), (9004, [1.0]), (9005, [])]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)] + extra, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in collision_projections.near_vectors(frame, block=25).collect()}
    exact = near.sum(axis=1)
    counted = np.array([found[i]["n_links"] for i in range(len(data))])
    assert (counted <= exact).all() and counted.sum() >= 0.99 * exact.sum()
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i and found[i]["kept"] for i, _ in extra)
    assert collision_projections.near_vectors(frame.limit(0)).count() == 0


def test_vector_copies_count_as_links(spark):
    """Copies link with one another and with whatever one of them links with; zero vectors and ids that repeat too."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((5, 24))
    near = base[0] + 0.05 * rng.standard_normal(24)
    data = [*[base[0]] * 90, near, near, *[base[1]] * 3, base[2], 2.0 * base[2], base[3], np.zeros(24), np.zeros(24)]
    ids = [500 - i for i in range(len(data) - 2)] + [7, 7]
    frame = spark.createDataFrame([(i, v.tolist(), "x", 1) for i, v in zip(ids, data)], "vec_id long, embedding array<double>, digest string, copies int")
    found = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in collision_projections.near_vectors(frame, block=25).collect())
    groups = [(ids[:92], 91), (ids[92:95], 2), (ids[95:97], 1), (ids[97:98], 0)]
    wanted = [(i, n, min(g), i == min(g)) for g, n in groups for i in g] + [(7, 0, 7, True)] * 2
    assert found == sorted(wanted)


def test_vectors_of_every_length_are_compared(spark):
    rng = np.random.default_rng(13)
    data, groups = [], []
    for size, families in ((24, 30), (16, 12), (5, 1)):
        for _ in range(families):
            centre = rng.standard_normal(size)
            groups.append(range(len(data), len(data) + 4))
            data += [centre, centre, 3.0 * centre, centre + 0.01 * rng.standard_normal(size)]
    data += [np.ones(7), np.ones(7), np.ones(3)]
    groups += [range(len(data) - 3, len(data) - 1), range(len(data) - 1, len(data))]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    unit = [v / np.linalg.norm(v) for v in data]
    exact = [sum(len(u) == len(v) and float(u @ v) >= 0.9 for v in unit) - 1 for u in unit]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in collision_projections.near_vectors(frame, block=25).collect()}
    assert [found[i][0] for i in range(len(data))] == exact and max(exact[120:168]) >= 3
    assert all(found[i][1] <= g[0] and len({found[k][1] for k in g}) == 1 for g in groups for i in g)


# --- 5: urls ---------------------------------------------------------------------------------

def test_url_rules(spark):
    urls = {1: "http://a.NET/x", 2: "http://net", 3: "https://m.example.net/en/1", 4: "https://example.com/de/?x", 5: "http://b.org/fr/", 6: "http://b.org/frx",
            7: None, 8: "no scheme", 9: "http://cheap-pills.example.com/x", 10: "x://y://example.com/de/#f", 11: "http://notexample.net/en/", 12: "http://net?/", 13: "http://myorg/fr/"}
    pages = spark.createDataFrame([(k, u, "h") for k, u in urls.items()] + [(1, urls[1], "h")], "page_id long, url string, host string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, url_rules.rule_table(spark)).collect()}
    assert found == {1: ("a.net", "/x", "net/", "block"), 2: ("net", "", None, "allow"), 3: ("m.example.net", "/en/1", "example.net/en/", "allow"),
                     4: ("example.com", "/de/", "example.com/de/", "block"), 5: ("b.org", "/fr/", "org/fr/", "allow"), 6: ("b.org", "/frx", None, "allow"),
                     7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("cheap-pills.example.com", "/x", None, "block"),
                     10: ("y:", "//example.com/de/", None, "allow"), 11: ("notexample.net", "/en/", "net/", "block"), 12: ("net", "", None, "allow"),
                     13: ("myorg", "/fr/", None, "allow")}
    assert url_rules.judge(pages, url_rules.rule_table(spark)).count() == 14
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark)).count() == 0


def test_rules_on_addresses_ports_and_paths(spark, plan_text):
    urls = {"http://10.1.2.3/a": "address", "http://10.1.2.3:81": "address", "http://10.1.2.3.org/": None, "http://a.org:8080/": "port 8080",
            "http://a.org:80801/": None, "http://a.org/8080/": None, "http://a.org/x/wp-login.php": "script wp-login.php", "http://a.org/wp-login.phpx": None,
            "http://a.org/cgi-bin/q": "script cgi-bin", "http://a.org/my-cgi-bin/": None, "http://a.org/p;jsessionid=1": "visit jsessionid",
            "http://a.org/jsessionid": None, "http://a.org/p?x;jsessionid=1": None, "http://a.org/f.tar.gz": "download tar.gz", "http://a.org/f.exe#x": "download exe",
            "http://a.org/f.exe.html": None, "http://a.org/exe": None, "http://f.zip": None, "http://a.net/f.zip": "net/", "": None}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = url_rules.judge(pages, url_rules.rule_table(spark))
    found = {r["page_id"]: (r["reason"], r["verdict"]) for r in judged.collect()}
    assert found == {i: (reason, "block" if reason else "allow") for i, reason in enumerate(urls.values())}
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan_text(judged)


def test_rules_without_a_token_are_tried_everywhere(spark):
    rules = url_rules.rule_table(spark, patterns=(), listed=[("\u4f8b\u3048", "/", "block"), ("example.net", "/en/", "allow")], words=["casino", "\u8ced", "b\u8ced"])
    none = spark.createDataFrame([("digits", r"^[^/]*[0-9]{3}", None, "block", 0, 6), ("slashes", "//", [], "block", 0, 7)], rules.schema)
    urls = {1: "http://\u4f8b\u3048/x", 2: "http://www.\u4f8b\u3048/", 3: "http://a123.org/", 4: "http://example.net/en/", 5: "http://b.org//x",
            6: "http://b.org/123", 7: None, 8: "http://casino.org/", 9: "http://a.\u8ced.org/x", 10: "http://b\u8ced.org/x"}
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    found = {r["page_id"]: (r["verdict"], r["reason"]) for r in url_rules.judge(pages, rules.union(none)).collect()}
    assert found == {1: ("block", "\u4f8b\u3048/"), 2: ("block", "\u4f8b\u3048/"), 3: ("block", "digits"), 4: ("allow", "example.net/en/"),
                     5: ("block", "slashes"), 6: ("allow", None), 7: ("allow", None), 8: ("block", "casino"), 9: ("block", "\u8ced"), 10: ("block", "b\u8ced")}


# --- 6: exact copies -------------------------------------------------------------------------

@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_copies(spark, odd_docs, digest_bytes):
    """One-byte digests stand for many contents; verification must still keep different texts apart."""
    found = chunk_recipes.dedup(odd_docs, digest_bytes).collect()
    groups = defaultdict(list)
    for r in odd_docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    for r in found:
        same = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(same) and r["keep_id"] == max(x for x in same if x is not None)
    assert sum(r["kept"] for r in found) == len(groups)
    if digest_bytes == 16:
        kept = chunk_recipes.drop_copies(odd_docs)
        assert kept.columns == odd_docs.columns and sorted(r["text"] or "" for r in kept.collect()) == sorted(groups)
        assert chunk_recipes.dedup(empty(spark)).count() == 0


def test_chunks_depend_on_content():
    rng = random.Random(1)
    data = bytes(rng.randrange(97, 123) for _ in range(100_000))
    cut = lambda x: {x[a:b] for a, b in zip([0, *chunk_recipes.chunk_ends(x)], chunk_recipes.chunk_ends(x))}
    assert len(cut(data) & cut(b"something in front" + data)) > 0.8 * len(cut(data)) and chunk_recipes.chunk_ends(b"") == [0]


# --- 8: token totals -------------------------------------------------------------------------

def test_rollup_is_idempotent(spark, tmp_path):
    kinds = "change string, source string, lang string, tokenizer string, tokens long, tokens_before long"
    rollup = token_rollup.Rollup(spark, str(tmp_path / "totals"))
    first = spark.createDataFrame([("insert", "a", "en", "t", 5, None), ("insert", "a", "en", "t", 7, None), ("insert", None, None, "t", None, None)], kinds)
    later = spark.createDataFrame([("revise", "a", "en", "t", 9, 5), ("delete", "a", "en", "t", None, 7)], kinds)
    for batch, changes in (("1", first), ("2", later), ("2", later), ("1", first)):
        rollup.commit(batch, changes)
    assert rows(rollup.totals(), "source", "lang", "tokenizer", "docs", "tokens") == sorted([("a", "en", "t", 1, 9), (None, None, "t", 1, 0)], key=str)


def test_rollup_commits_whole_or_not_at_all(spark, tmp_path):
    kinds = "change string, source string, lang string, tokenizer string, tokens long, tokens_before long"
    rollup = token_rollup.Rollup(spark, str(tmp_path / "totals"))
    assert rollup.totals().count() == 0 and rollup.deltas().columns == ["source", "lang", "tokenizer", "docs", "tokens", "batch"]
    insert = lambda n: spark.createDataFrame([("insert", "a", "en", "t", n, None)], kinds)
    rollup.prepare("1", insert(5))                     # the driver is lost before the marker is written
    assert rollup.totals().count() == 0
    rollup.commit("1", insert(5))
    lost = rollup.prepare("1", insert(50))             # a second delivery, written but not yet published
    rollup.prepare("2", insert(7))
    assert rows(rollup.totals(), "docs", "tokens") == [(1, 5)]
    rollup.publish("1", lost)
    assert rows(rollup.totals(), "docs", "tokens") == [(1, 50)]
    rollup.commit("2", insert(7).limit(0))
    assert rows(rollup.totals(), "docs", "tokens") == [(1, 50)]


def test_corpus_totals_match_a_plain_count(spark, odd_docs, tmp_path):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(vocabulary_path(TOKENIZER_FILE))
    for docs, k in ((table(spark, "documents"), 0), (odd_docs, 1)):
        last, want = {}, Counter()
        for r in docs.collect():
            last[r["text"] or ""] = max(last.get(r["text"] or "", (-1,)), (-1 if r["doc_id"] is None else r["doc_id"], r["source"] or "", r["lang"] or "", len(plain.encode(r["text"] or "", add_special_tokens=False).ids)))
        for _, source, lang, n in last.values():
            want[source, lang] += n
        found = token_rollup.corpus_totals(docs, str(tmp_path / f"t{k}")).where("tokenizer = 'byte_bpe_50k'").collect()
        assert sum(r["docs"] for r in found) == len(last)
        assert {(r["source"] or "", r["lang"] or ""): r["tokens"] for r in found if r["tokens"]} == dict(+want)


def test_whole_totals_cover_every_row(spark, odd_docs, tmp_path):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(vocabulary_path(TOKENIZER_FILE))
    docs = table(spark, "documents")
    for data, found in ((docs, REGISTRY["op8_token_totals"](spark, SF)), (odd_docs, token_rollup.whole_totals(odd_docs, str(tmp_path / "w")))):
        want, estimate = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for r in data.collect():
            text = r["text"] or ""
            for sums, n in ((want, len(plain.encode(text, add_special_tokens=False).ids)), (estimate, (len(text) + 3) // 4)):
                sums[r["source"], r["lang"]][0] += 1
                sums[r["source"], r["lang"]][1] += n
        got = found.collect()
        for tokenizer, sums in (("byte_bpe_50k", want), ("four_chars", estimate)):
            mine = [r for r in got if r["tokenizer"] == tokenizer]
            assert {(r["source"], r["lang"]): [r["docs"], r["tokens"]] for r in mine} == sums
            assert sum(r["unique_docs"] for r in mine) == len({r["text"] or "" for r in data.select("text").collect()})
            assert all(0 <= r["unique_docs"] <= r["docs"] and 0 <= r["unique_tokens"] <= r["tokens"] for r in mine)


# --- 9: packing ------------------------------------------------------------------------------

def test_packing_round_trip(spark, odd_docs):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(vocabulary_path(TOKENIZER_FILE))
    for docs in (table(spark, "documents"), odd_docs):
        found = bin_completion.pack(docs, capacity=256).collect()
        places, pieces = defaultdict(list), defaultdict(list)
        for r in found:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
            pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        for spans in places.values():
            assert all(o == sum(n for p, n in spans if p < o) for o, _ in spans) and sum(n for _, n in spans) <= 256
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r["doc_id"]].append(r["text"] or "")
        for doc_id, same in texts.items():
            want = []
            for text in same:
                ids = plain.encode(text, add_special_tokens=False).ids + [2]
                cuts = list(range(len(ids), 0, -256))[::-1]
                want += [(k, max(e - 256, 0), e - max(e - 256, 0), zlib.crc32(np.array(ids[max(e - 256, 0):e], dtype="<u4").tobytes())) for k, e in enumerate(cuts)]
            assert sorted(pieces[doc_id]) == sorted(want)
        assert len(places) <= 1.02 * bin_completion.least_bins(Counter(r["length"] for r in found), 256) + 1
    assert bin_completion.pack(empty(spark)).count() == 0


def test_bins_are_as_few_as_possible_on_small_cases():
    def fewest(items, capacity):
        best = [len(items)]

        def place(k, rooms):
            if len(rooms) >= best[0]:
                return
            if k == len(items):
                best[0] = len(rooms)
                return
            for i in {r: i for i, r in enumerate(rooms) if r >= items[k]}.values():
                place(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1:])
            place(k + 1, rooms + [capacity - items[k]])
        place(0, [])
        return best[0]
    rng = random.Random(4)
    for _ in range(25):
        items = sorted((rng.randrange(5, 70) for _ in range(rng.randrange(1, 10))), reverse=True)
        plan = bin_completion.complete_bins(Counter(items), 100)
        assert Counter(x for content, n in plan for x in content * n) == Counter(items) and all(sum(c) <= 100 for c, _ in plan)
        assert bin_completion.bins_of(plan) == fewest(items, 100)


def test_bins_mix_fillings_and_multiples():
    """All fillings of a room are found, and cases of few lengths that the first search leaves open are solved."""
    def brute(room, stock):
        fits = [x for x in sorted(stock, reverse=True) if x <= room and stock[x]]
        out = {()} if not fits else set()
        for x in fits:
            out |= {tuple(sorted((x, *rest), reverse=True)) for rest in brute(room - x, stock - Counter([x]))}
        return out
    stock = Counter({3: 9, 4: 9, 5: 2, 7: 3})
    counts = np.zeros(41, dtype=np.int64)
    for x, n in stock.items():
        counts[x] = n
    found = [f for f in bin_completion.every_filling(30, np.flatnonzero(counts), counts) if f is not None]
    tight = {f for f in brute(30, stock) if sum(f) == 30}
    assert len(found) == len(set(found)) and tight <= set(found) <= brute(30, stock) and any(len(f) > 5 for f in found)
    assert len(tight) > len(bin_completion.fillings(30, np.flatnonzero(counts), counts))
    cases = [({32: 3, 28: 3, 13: 4, 18: 1, 9: 5}, 50, 6), ({16: 1, 9: 6, 42: 6, 52: 5, 15: 3, 31: 5}, 100, 8),
             ({18: 6, 5: 4, 14: 4, 24: 2, 27: 2, 30: 5}, 50, 9), ({12: 5, 10: 6, 16: 4, 4: 5}, 30, 7)]
    for items, capacity, fewest in cases:
        plan = bin_completion.complete_bins(Counter(items), capacity)
        assert Counter(x for content, n in plan for x in content * n) == Counter(items) and bin_completion.bins_of(plan) == fewest


def test_encoder_equals_the_tokenizer(spark):
    from tokenizers import Tokenizer
    plain, fast = Tokenizer.from_file(vocabulary_path(TOKENIZER_FILE)), byte_bpe()
    texts = [r["text"] for r in table(spark, "documents").collect()] + ["a  b \n\n c", " \t x", "don't 'S ½²ª", "\x1c\x85\xa0 z", "<|endoftext|>", "中文 نص"]
    assert all(fast.ids(t) == plain.encode(t, add_special_tokens=False).ids for t in texts)


# --- pipeline --------------------------------------------------------------------------------

def test_pipeline_stages_follow_their_operators(spark):
    docs = table(spark, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "minhash_near_dedup", "source_mix", "best_fit_packing"]
    unique = stages["exact_dedup"](spark, docs, SF)
    last = {}
    for r in docs.collect():
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in unique.collect()} == set(last.values()) and unique.columns == docs.columns
    near = stages["minhash_near_dedup"](spark, docs, SF)
    assert {r["doc_id"] for r in near.collect()} == set(brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()]).values())
    packed = corpus_pipeline.run(spark, SF)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0 and packed.count() > 0


def test_pipeline_run_matches_a_brute_force_chain(spark):
    from tokenizers import Tokenizer
    docs, labels = table(spark, "documents"), table(spark, "labels")
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, labels).collect()}
    rest = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect() if score[r["doc_id"]] < toxicity.THRESHOLD}
    last = {text: doc_id for doc_id, (text, _) in sorted(rest.items())}
    unique = [(doc_id, text) for text, doc_id in last.items()]
    kept = {d: rest[d] for d in set(brute_classes(unique).values())}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for d, (text, _) in kept.items()}
    total = Counter()
    for d, (_, source) in kept.items():
        total[source] += size[d]
    left, want = {s: 1 + k % 3 for k, s in enumerate(sorted(total))}, {}
    while left:  # plain rounds of capping
        level = (sum(total.values()) - sum(want.values())) / sum(left.values())
        over = [s for s, w in left.items() if w * level > 3 * total[s]]
        for s in over or list(left):
            want[s] = 3.0 * total[s] if over else left[s] * level
            del left[s]
    times, at = Counter(), Counter()
    for d in sorted(kept, key=lambda d: hashlib.md5(str(d).encode()).hexdigest()):
        source = kept[d][1]
        for reading in range(4):
            first, goal = reading * total[source] + at[source], int(want[source] + 0.5)
            times[d] += size[d] > 0 and first < goal and (first == 0 or 2 * (goal - first) >= size[d])
        at[source] += size[d]
    plain, pieces = Tokenizer.from_file(vocabulary_path(TOKENIZER_FILE)), Counter()
    for d, n in times.items():
        ids = plain.encode(kept[d][0], add_special_tokens=False).ids + [2]
        for k, end in enumerate(range(len(ids), 0, -1024)[::-1]):
            start = max(end - 1024, 0)
            pieces[d, k, start, end - start, zlib.crc32(np.array(ids[start:end], dtype="<u4").tobytes())] += n
    found = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert found == +pieces and len({d for d, *_ in found}) > 20
