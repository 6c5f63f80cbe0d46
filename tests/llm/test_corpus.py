"""The corpus operators on small tables with every odd case, against brute force."""

from __future__ import annotations

import base64
import hashlib
import pickle
import re
import zlib
from collections import defaultdict

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourline.llm import chat, exact_dedup, fingerprints, licenses, minhash, mixing, packing, sharding, toxicity, warc
from hourline.llm.common import ready, table
from hourline.llm.queries import ORACLES, QUERIES
from hourline.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 977} x{i % 31}." for i in range(30_000))
BASE = " ".join(f"term{i}" for i in range(60))
TEXTS = [
    (1, "same text here", "a"), (2, "same text here", "a"), (2, "same text here", "a"), (3, None, None), (4, "", "b"), (5, " \t\n", "b"),
    (6, "One", "a"), (7, "one", "c"), (8, BASE, "c"), (9, BASE + " extra", "c"), (10, BASE.upper(), None), (11, LONG, "d"),
    (None, "no key at all", "d"), (12, "Ünï çödé ΣΑΣ ² ½ 'tis it's <|endoftext|> a\x1cb", "d"), (13, "x" * 5000, "e"), (14, "same text here ", "e"),
]
SCHEMA = "doc_id long, text string, source string, size string, kept string, copies string, part int, shard string, score string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ready(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", "k", "c", 1, "h", "z") for r in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    problem = oracle.difference(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name])
    assert problem is None, problem


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and mixing.mix(none).count() == 0
    sources = sorted({r[2] for r in TEXTS if r[2]}) + [None]
    sizes = {s: sum(len(re.findall(mixing.WORD, t or "")) for _, t, x in TEXTS if x == s) for s in sources}
    targets, left, weights = {}, dict(zip(sources, (1, 2, 3, 1, 2, 3), strict=True)), sum(sizes.values())
    while True:
        share = {s: weights * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            weights -= targets[s]
            del left[s]
    targets |= share
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]]) and 0 <= r["copies"] <= 3 and r["source_size"] == sizes[r["source"]]
        if r["size"] and abs(r["target"] - 3 * r["source_size"]) < 1e-9:
            assert r["copies"] == 3


def test_taken_rows_are_the_copies(docs, none):
    copies, found = defaultdict(int), defaultdict(int)
    for r in mixing.mix(docs).collect():
        copies[r["doc_id"], r["text"], r["source"]] += r["copies"]
    rows = mixing.taken(docs)
    assert rows.columns == docs.columns and mixing.taken(none).count() == 0
    for r in rows.collect():
        assert (r["size"], r["copies"], r["part"]) == ("s", "c", 1)
        found[r["doc_id"], r["text"], r["source"]] += 1
    assert found == {k: n for k, n in copies.items() if n}


def test_mixing_meets_targets_again_and_again(spark, sf_dir):
    runs = [QUERIES["op1_mixing"](spark, sf_dir).collect() for _ in range(2)]
    assert sorted(runs[0]) == sorted(runs[1])
    taken, targets = defaultdict(int), {}
    for r in runs[0]:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.05 * t for s, t in targets.items())


def test_chat_finds_the_least_cost(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    names = ["system", "user", "assistant", "tool", "odd", None, " Human "]
    rows, least = [], {}
    draw = np.random.default_rng(3)
    for conv in range(40):
        roles = [names[i] for i in draw.integers(0, len(names), draw.integers(1, 6))]
        rows += [(conv, i, r, f"t{i}", 0) for i, r in enumerate(roles)]

        def cost(i, state, roles=roles):
            if i == len(roles):
                return chat.INSERT * len(chat.ENDING[state])
            return min(s[1] + cost(i + 1, s[0]) for s in chat.STEPS[chat.role_of(roles[i])][state])

        least[conv] = cost(0, chat.START)
    rows += [(None, 0, "user", None, 0), (None, None, "user", "b", 0), (None, 0, "user", None, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, position int")
    out = chat.repair(df).collect()
    total = defaultdict(int)
    for r in out:
        total[r["conv_id"]] += r["cost"]
    assert {k: v for k, v in total.items() if k is not None} == least
    assert sum(r["part"] == 1 for r in out) == len(rows)
    joined = "".join(r["segment"] for r in sorted((r for r in out if r["conv_id"] is None), key=lambda r: (r["position"], r["part"])))
    assert joined == "<|user|>\n\n\n<|end|>\n<|assistant|>\nb<|end|>\n"
    assert chat.repair(df.where("false")).count() == 0
    # Turns of one number that differ only in which of role and text is NULL keep their own texts; equal turns all stay.
    alike = spark.createDataFrame([(1, 0, "user", None), (1, 0, None, "user"), (1, 0, None, "user")], "conv_id long, turn int, role string, text string")
    kept = [r["segment"] for r in chat.repair(alike).collect() if r["part"] == 1]
    assert len(kept) == 3 and sum("user" in k.split("|>\n")[-1] for k in kept) == 2


def test_exact_dedup(spark, docs, none):
    rows = exact_dedup.exact_groups(docs, "test_index").collect()
    groups = defaultdict(list)
    for key, text, _ in TEXTS:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(key)
    assert len(rows) == len(TEXTS)
    for r in rows:
        keys = groups[r["text_sha256"]]
        assert r["group_size"] == len(keys) and r["keep_id"] == max((k for k in keys if k is not None), default=None)
    once = exact_dedup.deduplicate(docs, "test_index")
    assert once.columns == docs.columns and once.count() == len(groups)
    assert exact_dedup.deduplicate(none, "test_index").count() == 0
    index = exact_dedup.DigestIndex(spark, "test_index")
    before = index.read().count() if index.exists() else 0
    index.absorb(spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "bb")], "doc_id long, digest string"))
    index.absorb(spark.createDataFrame([(9, "aa"), (4, "cc")], "doc_id long, digest string"))
    assert {r["digest"]: r["keep_id"] for r in index.read().collect() if len(r["digest"]) == 2} == {"aa": 2, "bb": 3, "cc": 4}
    assert index.read().count() == before + 3
    index.drop()


def test_near_duplicates(docs, none):
    for words in (2,):
        rows = {(r["doc_id"], r["n_shingles"]): r for r in minhash.near_duplicates(docs, words).collect()}
        sets = [set(minhash.shingle_set(t, words).tolist()) for _, t, _ in TEXTS]
        root = list(range(len(TEXTS)))
        for _ in TEXTS:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if a and b and 100 * len(a & b) >= 80 * len(a | b):
                        root[i] = root[j] = min(root[i], root[j])
        for i, (key, _, _) in enumerate(TEXTS):
            keys = [TEXTS[j][0] for j in range(len(TEXTS)) if root[j] == root[i] and TEXTS[j][0] is not None]
            assert rows[key, len(sets[i])]["component_id"] == (min(keys) if sets[i] and keys else key)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 11, 12, 13]
    assert minhash.drop_near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 99)], "a long, b long")
    found = {r["node"]: r["root"] for r in minhash.components(edges).collect()}
    assert found == {i: 0 for i in range(51)} | {99: 99, 100: 99}


def test_fingerprints(docs, none):
    rows = fingerprints.fingerprints(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    texts = {k: t or "" for k, t, _ in TEXTS if k is not None}
    order = sorted(texts)
    prints = defaultdict(set)
    for r in rows:
        own, after = texts[r["doc_id"]], texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        new = fingerprints.edited(own, after)
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        for other, near in ((new, r["near_edited"]), (after, r["near_next"])):
            a, b = (set(fingerprints.keys_of(t).tolist()) for t in (own, other))
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        prints[own].add(r["fingerprint"])
    assert len(rows) == len(order) and all(len(p) == 1 for p in prints.values())
    assert fingerprints.fingerprints(docs).count() == len(TEXTS) and fingerprints.fingerprints(none).count() == 0


def test_sketch_differences_are_complete():
    draw = np.random.default_rng(1)
    pairs = []
    for n in (0, 1, 5, 300):
        shared, left, right = (draw.integers(1, 2**63, k).astype(np.uint64) for k in (200, n, 2 * n))
        pairs.append((np.concatenate([shared, left]), np.concatenate([right, shared]), left, right))
    for (a, b), (_, _, left, right) in zip(fingerprints.differences([p[0] for p in pairs], [p[1] for p in pairs]), pairs, strict=True):
        assert sorted(a.tolist()) == sorted(left.tolist()) and sorted(b.tolist()) == sorted(right.tolist())


def test_packing(docs, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    rows = packing.pack(docs, WORDS, length=512, with_ids=True).cache()
    ids = lambda t: [*whole.encode(t or "", add_special_tokens=False).ids, 1]
    expected = sorted((str(k), i, zlib.crc32(np.array(ids(t)[i : i + 512], "<u4").tobytes())) for k, t, _ in TEXTS for i in range(0, len(ids(t)), 512))
    assert sorted((str(r["doc_id"]), r["start"], r["ids_crc32"]) for r in rows.collect()) == expected
    places = defaultdict(list)
    for r in rows.collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 512
    assert len(places) <= -(-sum(len(ids(t)) for _, t, _ in TEXTS) // 512) + 1
    assert all(len(r["ids"]) == 4 * sum(x[1] for x in places[r["sequence_id"]]) for r in packing.sequences(rows).collect())
    assert packing.pack(none, WORDS).count() == 0


def test_runs_of_latin_letters_are_put_together_from_words(monkeypatch):
    own = packing.WordTokenizer(WORDS)
    letters = [chr(n) for n in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]]
    texts = [*letters, *[f"l'{c}t{c}x9{c}!" for c in letters], "\u00c9T\u00c9 na\u00efve, 'S \u00fc's", "12\u00ed's", "stra\u00dfe", "\u00aa\u00d7"]
    whole = [packing._packed(own.whole.encode(t, add_special_tokens=False).ids) for t in texts]
    asked, all_ = [], own._all
    monkeypatch.setattr(own, "_all", lambda t: asked.append(t) or all_(t))
    assert [own.encode(t) for t in texts] == whole
    assert asked == ["\u00aa\u00d7"]  # not among those letters


def test_toxicity(spark, docs, none, sf_dir):
    labels = table(spark, sf_dir, "labels")
    known = table(spark, sf_dir, "documents")
    model = toxicity.fit(known, labels)
    out = toxicity.score(docs, model)
    assert out.count() == len(TEXTS) and all(0 <= r["score"] <= 1 for r in out.collect())
    scored = toxicity.score(known, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    toxic, clean = ([r["score"] for r in scored if r["toxic"] == y] for y in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) + 0.5 * np.mean([a == b for a in toxic for b in clean]) > 0.8
    assert np.mean(np.array(clean) < 0.5) > 0.97
    assert toxicity.drop_toxic(docs, labels.where("false")).columns == docs.columns
    assert toxicity.drop_toxic(none, labels).count() == 0


def test_nearest_examples_are_exact():
    """Equal to a plain comparison, with as many blocks left shut as the bounds allow: examples of two kinds that share little."""
    draw = np.random.default_rng(5)
    rows = []
    for n in range(1800):
        ids = draw.choice(40, draw.integers(1, 6), replace=False) + 40 * (n % 2)
        if n % 9 == 0:
            ids = np.append(ids, 80 + n % 5)
        w = draw.random(len(ids)) + 0.1
        rows.append(dict(zip(ids.tolist(), (w / np.linalg.norm(w)).tolist(), strict=True)))
    index = toxicity.BlockMaxIndex.build(rows, 90)
    asked = [*rows[:150], {89: 1.0}, {}, {0: 0.6, 40: 0.8}]
    at = np.concatenate([[0], np.cumsum([len(q) for q in asked])])
    ids, values = np.array([t for q in asked for t in q], np.int64), np.array([w for q in asked for w in q.values()])
    for query, (found, near) in zip(asked, index.nearest_all(at, ids, values, 10), strict=True):
        cosines = np.array([sum(w * r.get(t, 0) for t, w in query.items()) for r in rows])
        best = np.sort(cosines)[::-1][:10]
        assert np.allclose(near, best[best > 1e-5]) and np.allclose(cosines[found], near)
        alone, _ = index.nearest(query, 10)
        assert np.allclose(cosines[alone], near)
    assert 0 < index.opened < index.blocks
    for size in (0, 1, 3, 70):
        few = toxicity.BlockMaxIndex.build(rows[:size], 90)
        assert len(few.nearest(rows[0], 10)[0]) <= size and (not size or abs(few.nearest(rows[0], 10)[1][0] - 1) < 1e-6)
    same = toxicity.BlockMaxIndex.build([rows[0]] * 100, 90)  # ties: the first examples
    assert same.nearest(rows[0], 10)[0].tolist() == list(range(10))


def test_an_index_is_built_in_little_memory():
    """Beside what it keeps, a few bytes for each word of the examples: the workers of an executor build theirs at the same time."""
    import tracemalloc

    def taken(size: int, words: int = 100, dimensions: int = 20_000) -> int:
        draw = np.random.default_rng(1)
        example = np.repeat(np.arange(size), words).astype(np.int32)
        dimension = np.sort(draw.integers(0, dimensions, (size, words)).astype(np.int32)).ravel()
        weight = draw.random(size * words, np.float32)
        tracemalloc.start()
        index = toxicity.BlockMaxIndex.of(example, dimension, weight, size, dimensions)
        kept, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert len(index.order) >= size
        return peak - kept

    assert taken(40_000) - taken(10_000) < 15 * 3_000_000  # 34 bytes a word where all of them were masked at once


def learned(size: int, words: int, dimensions: int) -> tuple[toxicity.Learned, list[dict[int, int]]]:
    """Examples of drawn words, as they are shipped, and their counts."""
    draw = np.random.default_rng(2)
    rows = [dict(zip(draw.choice(dimensions, words, replace=False).tolist(), draw.choice([1, 1, 1, 2, 5000], words).tolist(), strict=True)) for _ in range(size)]
    rows[1] = {}
    packed = []
    for low in range(0, size, 700):
        some = [sorted(r.items()) for r in rows[low : low + 700]]
        lists = [pa.array([[x[i] for x in r] for r in some], pa.list_(pa.int32())) for i in (0, 1)]
        ids, toxic = pa.array(range(low, low + len(some)), pa.int64()), pa.array([low % 2] * len(some), pa.int32())
        batch = pa.RecordBatch.from_arrays([ids, ids, toxic, *lists], ["order", "id", "toxic", "__terms", "__counts"])
        packed += [(r["size"], r["payload"]) for b in toxicity._packed([batch]) for r in b.to_pylist()]
    held = np.zeros(toxicity.DIMENSIONS, np.int64)
    held[:dimensions] = 1 + np.arange(dimensions)
    return toxicity.Learned(packed, held, 2 * dimensions, []), rows


def test_shipped_examples_are_compared_exactly():
    """Postings of equal weight hold it once; neighbours are those of a plain comparison."""
    packed, rows = learned(1500, 12, 900)
    own = pickle.loads(pickle.dumps(packed))
    assert len(own.index.weight) < len(own.index.postings) / 5  # each had its own before
    assert own.ids.tolist() == list(range(1500))
    plain = np.zeros((len(rows), 900))
    for i, r in enumerate(rows):
        for t, n in r.items():
            plain[i, t] = (1 + np.log(n)) * own.weights[t]
    plain /= np.maximum(np.linalg.norm(plain, axis=1), 1e-9)[:, None]
    asked = range(0, 200)
    at = np.concatenate([[0], np.cumsum([len(rows[i]) for i in asked])])
    ids = np.array([t for i in asked for t in sorted(rows[i])], np.int64)
    values = np.concatenate([plain[i, sorted(rows[i])] for i in asked])
    for i, (found, near) in zip(asked, own.index.nearest_all(at, ids, values, 10), strict=True):
        cosines = plain @ plain[i]
        best = np.sort(cosines)[::-1][:10]
        assert np.allclose(near, best[best > 1e-5], atol=1e-6) and np.allclose(cosines[found], near, atol=1e-6)


def test_shipped_examples_are_unpacked_in_little_memory():
    """The words of all examples are never in memory at once beside the index."""
    import tracemalloc

    def peak(size: int) -> int:
        packed = pickle.dumps(learned(size, 100, 5000)[0])
        tracemalloc.start()
        own = pickle.loads(packed)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(own.ids) == size
        return most

    assert peak(12_000) - peak(4_000) < 16 * 800_000  # 31 bytes a word where all of them were unpacked at once, 12 now


def test_terms_are_counted_by_chunks():
    texts = ["Ab\u00e9b abe abe 1.2", "abcdefghijk abcdefgh \u00c4\u00d6-\u00fc", None, "", "\u4f60\u597d abcd", LONG, "abe \u00e9t\u00e9 x_y " + "q" * 40] * 60
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([i % 2 for i in range(len(texts))], pa.int32())], ["text", "toxic"])
    plain = defaultdict(int)
    for i, text in enumerate(texts):
        for t in {t for w in toxicity.WORD.findall((text or "").lower()) for p in toxicity.pieces(w) for t in toxicity.word_terms(p)}:
            plain[t, i % 2] += 1
    counted = {(r["term"], r["toxic"]): r["n"] for b in toxicity._counted([batch], toxicity._all_terms) for r in b.to_pylist()}
    assert counted == plain
    terms = {t: toxicity.DIMENSIONS + i for i, t in enumerate(sorted({t for t, _ in plain})[::2])}
    model = toxicity.Model(terms, {t.rstrip("$")[: toxicity.HEAD] for t in terms})
    for text in texts[:14]:  # words met before, too
        both = defaultdict(int)
        for word in toxicity.WORD.findall((text or "").lower()):
            for p in toxicity.pieces(word):
                both[zlib.crc32(p.encode("utf-8", "surrogatepass")) % toxicity.DIMENSIONS] += 1
                for t in toxicity.word_terms(p):
                    if t in terms:
                        both[terms[t]] += 1
        assert model.counts(text) == both


def test_words_are_found_in_chunks():
    model = toxicity.Model({})
    texts = ["A,b_c  d'e\u00a0f\u2014g 1.2", "\ud800 x", "", None, "\u00c4\u00d6-\u00fc \u4f60\u597d", LONG]
    for text in texts:
        plain = defaultdict(int)
        for word in toxicity.WORD.findall((text or "").lower()):
            for p in toxicity.pieces(word):
                plain[zlib.crc32(p.encode("utf-8", "surrogatepass")) % toxicity.DIMENSIONS] += 1
        assert model.counts(text) == plain


def test_all_words_and_examples_are_compared(spark):
    """Examples without a telling term stay in the index, and a copy of one finds it; so does a run without spaces."""
    said = ["".join(chr(97 + (i * k + k) % 26) for k in range(3, 8)) for i in range(400)]
    texts = [" ".join(said[(i * 7 + j * j) % 400] for j in range(30)) for i in range(60)] + ["这是一个完全不同的句子"]
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5][: len(texts)]
    known = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(n % 10 == 0)) for n, i in enumerate(ids)], "doc_id long, toxic int")
    model = toxicity.fit(known, labels)
    asked = spark.createDataFrame([(-1, texts[10]), (-2, texts[11]), (-3, "开头" + texts[-1])], "doc_id long, text string")
    found = {r["doc_id"]: r for r in toxicity.score(asked, model).collect()}
    assert found[-1]["neighbours"][0] == ids[10] and found[-2]["neighbours"][0] == ids[11] and found[-3]["neighbours"][0] == ids[-1]
    assert abs(found[-1]["cosines"][0] - 1) < 1e-6 and found[-1]["score"] > found[-2]["score"]


def test_archives(spark, none):
    pages = [(1, "http://a/ b\r\n", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (5, "u", LONG), (5, "u", LONG), (None, "u", "z")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, chunk string")
    for least in (0, 5):
        files, records = warc.archive(df, scratch_path(spark, "warc"), least, size=1000)
        rows = records.collect()
        assert len(rows) == len(pages) == sum(r["records"] for r in files.collect())
        for r in rows:
            text = next(p[2] for p in pages if p[0] == r["page_id"]) or ""
            first = min((p[0] for p in pages if (p[2] or "") == text and p[0] is not None), default=None)
            again = first != r["page_id"] and len(text) >= least
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode() and r["payload_bytes"] == len(text)
            assert (r["record_type"], r["refers_to"]) == (("revisit", first) if again else ("response", None))
    files, records = warc.archive(df.where("false"), scratch_path(spark, "warc"))
    assert files.count() == 0 and records.count() == 0


def test_shards(docs, none, spark, sf_dir):
    rows = sharding.interleave(docs, 5).collect()
    counts = defaultdict(list)
    for r in rows:
        counts[r["shard"]].append(r["slot"])
    assert sorted(map(len, counts.values())) == [3, 3, 3, 3, 4] and all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert sharding.interleave(none, 5).count() == 0
    per = table(spark, sf_dir, "documents").groupBy("source").count().collect()
    mixed = QUERIES["op9_sharding"](spark, sf_dir).groupBy("source", "shard").count().groupBy("source").agg(F.max("count").alias("most")).collect()
    total = {r["source"]: r["count"] for r in per}
    assert all(r["most"] <= total[r["source"]] / 40 + 3 for r in mixed)


def test_licences(spark, docs, none, sf_dir):
    known = table(spark, sf_dir, "documents")
    model = licenses.train(licenses.negatives(known))
    assert licenses.scan(docs, model).where("size(licences) = 0").count() == len(TEXTS) and licenses.scan(none, model).count() == 0
    lines = [("gpl-3.0", "copyright 2024 this work is licensed under the GNU General Public License, version 3 see file"), ("mit", "Released under the MIT License."),
             ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."), (None, "The driver had no license."), (None, "Licensed under the Example Company Terms, Edition 9.")]
    for family, line in lines:
        found = model.find(f"Some text.\n{line}\nMore.")[1]
        assert [f["family"] for f in found] == ([family] if family else [])
        assert all((f["start"], f["stop"]) == (11, 11 + len(line)) for f in found)
    clean = known.where("not text rlike '(?i)licen[cs]e|copyright|creative commons'")
    assert licenses.scan(clean, model).where("size(licences) > 0").count() == 0


WRAPPED = {
    "mit": """ * MIT License
 *
 * Copyright (c) 2024 The Authors
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    "gpl-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "gpl-2.0": """// This program is free software; you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation; either version 2 of the License, or
// (at your option) any later version.""",
    "lgpl-2.1": """   This library is free software; you can redistribute it and/or
   modify it under the terms of the GNU Lesser General Public
   License as published by the Free Software Foundation; either
   version 2.1 of the License, or (at your option) any later version.""",
    "agpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""",
    "apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at""",
    "bsd-3-clause": """Redistribution and use in source and binary
forms, with or without modification, are permitted
provided that the following conditions are met:""",
}


def test_wrapped_licences(spark, sf_dir):
    model = licenses.train(licenses.negatives(table(spark, sf_dir, "documents")))
    for family, notice in WRAPPED.items():
        for before, after in (("", ""), ("A first line.\n\n", "\n\nOther words follow.\n"), ("The code below\nis ours.\n", "\nint main() {\n")):
            count, found = model.find(before + notice + after)
            assert [f["family"] for f in found] == [family], (family, found)
            said = (before + notice + after)[found[0]["start"] : found[0]["stop"]]
            assert said.strip(" */#") in notice and "\n" in said and found[0]["paragraph"] < count
    two = "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."
    assert [(f["family"], f["start"]) for f in model.find(two)[1]] == [("mit", 0), ("cc-by-nc-4.0", 32), ("mit", 61)]
    assert model.find("One line\nand one more.\n \n# \nThe next.\n")[0] == 2


def test_pipeline(spark, sf_dir, docs):
    frame = table(spark, sf_dir, "documents").limit(150).withColumn("text", F.when(F.col("doc_id") % 50 == 0, None).otherwise(F.col("text")))
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, frame, sf_dir).write.parquet(path)
        frame = spark.read.parquet(path)
        assert name == "packing" or frame.columns == columns
    assert frame.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
