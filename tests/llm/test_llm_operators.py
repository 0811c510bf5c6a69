"""Small fixtures against brute force; nulls, empties, repeats, clashing columns and empty tables."""

import base64
import hashlib
import re
import time
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factloom.llm import (
    bpe, decontaminate, fingerprints, labelled, language, neardup, pieces, quality, records, shards, toxicity, urlfilter, words,
)

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = "the of and river stone quiet garden market window paper engine morning winter candle silver travel bridge".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("." if rng.random() < 0.1 else "") for i in rng.integers(0, len(WORDS), n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 120)
    near = base.replace("river", "lake", 1)
    odd = ["", None, " \t\n ", "one", "two words", "é中文 ab\x1c\x85 　x", "a" * 3000, base, base, base.upper(), near, near + " end", prose(3, 40), prose(4, 4000)]
    return odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", i * 2.0) for i, t in enumerate(texts)] + [(None, "no id here", None, 0.0), (7, texts[7], "en", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_give_the_tokens_of_whole_texts():
    enc, tok = library(), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own = records.Library(P.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(6)
    parts = [*"ab  \n\n\té'sZ9中.,!😀\u3000\x1c\x85\xa0×÷ñ<>-²Ⅷ", "'ll", "<|endoftext|>", " <|endoftext|>", "…", "a" * 300]
    for _ in range(30):
        docs = ["".join(rng.choice(parts, rng.integers(0, 50))) for _ in range(40)] + [""]
        ids, counts = bpe.encode_texts(docs, RANKS, P.PATTERN)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == list(map(enc.encode_ordinary, docs))
        want = [tok.encode(t, add_special_tokens=False).ids for t in docs]
        assert [np.frombuffer(v, "<u4").tolist() for v in own.encode(docs)] == want
    assert 50256 in tok.encode("x<|endoftext|>", add_special_tokens=False).ids
    plain = records.Library(P.path("byte_bpe_50k.json"), special=False)
    assert 50256 not in np.frombuffer(plain.encode(["x<|endoftext|>"])[0], "<u4")


def test_pieces_forget_what_does_not_recur():
    memory = pieces.Pieces(lambda new: [len(p).to_bytes(4, "little") for p in new])
    memory.ENTRIES = 50
    for i in range(40):
        docs = [f"word other{chr(97 + i % 26)}{chr(97 + i // 26)} " + " ".join("x" * (j + 1) for j in range(i % 7)), "word"]
        ids, counts = memory.of(docs)
        assert ids.sum() == sum(map(len, docs)) and counts.sum() == len(ids) and len(memory.at) < 70
    other = pieces.Memory(lambda new: new, 10)
    other.of([["a"]])
    assert len(memory.at) == 0  # one memory of a worker at a time


def test_bpe_equals_the_library(docs, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode_decode(docs.withColumn("ids", F.lit(1)), RANKS, P.PATTERN).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert list(r.ids) == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    rng = np.random.default_rng(5)
    alphabet = list("ab  \n\té'sZ9中.,!😀　\x1c")
    for _ in range(300):
        t = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert bpe.encode_texts([t], RANKS, P.PATTERN)[0].tolist() == enc.encode_ordinary(t)


def test_records_round_trip(spark, docs, texts):
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    folder = records.new_folder(spark)
    records.write(docs, folder, path)
    got = records.read(spark, folder).orderBy("start").collect()
    want = sorted([(-1, "no id here")] + [(i, t or "") for i, t in enumerate(texts)] + [(7, texts[7])], key=lambda x: x[0])
    start = 0
    for r, (i, t) in zip(got, want, strict=True):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, bytes(r.ids)) == (None if i < 0 else i, start, ids.tobytes())
        start += len(ids)
    order = np.random.default_rng(8).permutation(np.arange(len(got)).repeat(2)).tolist()
    picked = records.fetch(spark, folder, spark.createDataFrame([(i,) for i in order], "record long").coalesce(1)).collect()
    assert [(r.record, r.doc_id, r.start, r.ids) for r in picked] == [(i, *got[i]) for i in order]
    with pytest.raises(Exception, match="no record has such a number"):
        records.fetch(spark, folder, spark.createDataFrame([(len(got),)], "record long")).collect()
    empty = records.new_folder(spark)
    records.write(docs.limit(0), empty, path)
    assert records.read(spark, empty).count() == 0


def test_record_checksums():
    data = records.frame(b"payload")
    assert records.unframed(data, 0) == b"payload"
    for i in (0, 9, 13, len(data) - 1):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            records.unframed(bytes(broken), 0)


def brute_components(texts, k, percent):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, b in combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    return [len(s) for s in sets], label


def test_near_duplicates_match_brute_force(spark, docs, texts):
    got = neardup.near_duplicates(docs, k=3, percent=85).collect()
    sizes, label = brute_components(texts, 3, 85)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], label[r.doc_id], label[r.doc_id] == r.doc_id)
    assert neardup.near_duplicates(docs.limit(0), k=3, percent=85).count() == 0
    left = neardup.one_of_each(docs, k=3, percent=85)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted({x for i, x in enumerate(label)})


def test_word_hashes_cut_and_fold_like_bytes():
    rng = np.random.default_rng(8)
    alphabet = list("abAB \t\n\x0b\x1c\x85\u3000é中")
    docs = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(300)] + ["x" * 70_000 + " " + "x" * 70_001, "", "w " * 90_000]
    flat, counts = words.word_hashes(docs)
    want = [t.encode().lower().split() for t in docs]
    assert counts.tolist() == [len(w) for w in want]
    of = dict(zip((x for w in want for x in w), flat.tolist(), strict=True))
    assert len(set(of.values())) == len(of) and [of[x] for w in want for x in w] == flat.tolist()
    assert [len(g) for g in words.grouped(["a"] * 5, rows=2)] == [2, 2, 1]


def test_groups_alike_below_the_threshold_are_parted(spark):
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(100)]
    rows = [passage + [f"o{d}-{i}" for i in range(20)] for d in range(60)]  # alike at 0.71 to each other
    chain = list(rows[0])
    for d in range(12):  # each alike to the one before it, not to the first
        chain = list(chain)
        for i in rng.choice(len(chain), 2, replace=False):
            chain[i] = f"c{d}-{i}"
        rows.append(chain)
    texts = [" ".join(r) for r in rows]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sizes, label = brute_components(texts, 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, k=3, percent=85).collect()}
    assert got == {i: (sizes[i], label[i]) for i in range(len(texts))} and len(set(label)) < len(texts) - 5
    # all in one bucket, each a component of its own: those alike enough are candidates, most others are not
    nodes = spark.createDataFrame([(i, 7, i) for i in range(len(texts))], "node long, bucket long, comp long")
    sets = neardup.with_sets(docs, 3).select(F.col("doc_id").alias("node"), F.size("set").alias("n"), "set")
    bands = nodes.select("node", F.array("bucket").alias("bands"))
    pairs = {tuple(r) for r in neardup.unsettled(nodes.select("bucket", "node", "comp"), sets, bands, 85).collect()}
    grams = [{tuple(r[i : i + 3]) for i in range(len(r) - 2)} for r in rows]
    alike = {(a, b) for a, b in combinations(range(len(rows)), 2) if 100 * len(grams[a] & grams[b]) >= 85 * len(grams[a] | grams[b])}
    assert alike <= pairs and len(pairs) < 150


def test_one_id_with_several_texts(spark):
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (4, c), (None, c + " end"), (None, c + " end"), (9, "a b"), (9, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(docs, k=3, percent=80).collect())
    assert got == [(0, 0, True)] * 2 + [(1, 1, True)] * 2 + [(2, 1, False), (3, 1, False)] + [(4, 4, True)] * 2 + [(9, 9, True)] * 2
    left = neardup.one_of_each(docs, k=3, percent=80)
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(0, c + " end")] * 2 + [(1, a), (1, b), (4, c), (9, "a b")])


def listed(fingerprint):
    """The digests of a printed fingerprint, as the hashes of cells that hold one digest, peeled until all are empty."""
    count, _, rest = fingerprint.partition("-")
    found = []
    for part in filter(None, rest.split(".")):
        raw = base64.b64decode(part)
        cells = [[raw[i], int.from_bytes(raw[i + 1 : i + 7]), int.from_bytes(raw[i + 7 : i + 9])] for i in range(0, len(raw), 9)]
        third = len(cells) // 3
        attempt = (third // fingerprints.CELLS).bit_length() - 1
        assert third == fingerprints.CELLS << attempt
        while True:
            alone = next((k for n, k, c in cells if n == 1 and spark_hash(k, fingerprints.CHECK) >> 48 == c), None)
            if alone is None:
                break
            found.append(alone)
            h, check = spark_hash(alone, attempt), spark_hash(alone, fingerprints.CHECK) >> 48
            h -= (h >> 63) << 64
            for p in range(3):
                cell = cells[(h >> 21 * p) % third + p * third]
                cell[0], cell[1], cell[2] = cell[0] - 1, cell[1] ^ alone, cell[2] ^ check
        assert not any(map(any, cells))
    assert len(found) == len(set(found)) == int(count)
    return set(found)


def spark_hash(k, seed):
    """xxhash64 of a long and an int, as Spark chains them: each value's hash seeds the next."""
    first = xxhash.xxh64_intdigest(k.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest((seed & 0xFFFFFFFF).to_bytes(4, "little"), first)


def test_fingerprints_match_brute_force(spark, docs, texts):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprints.fingerprints(plain).collect()}

    def lines(t):
        cut = set(re.findall(rf"[^\n]{{1,{fingerprints.CUT}}}", t))
        return {xxhash.xxh64_intdigest(x.encode(), 42) >> 16 for x in cut}

    def near(x, y):
        return len(x & y) / len(x | y) if x | y else 1.0

    n = len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i - 1) % n] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        assert got[i].edited == edited and got[i].n_chars == len(t)
        own, new, following = listed(got[i].fingerprint), listed(got[i].edited_fingerprint), listed(got[(i - 1) % n].fingerprint)
        assert own == lines(t) and new == lines(edited) and following == lines(after)
        assert abs(got[i].near_edited - near(own, new)) < 1e-12 and abs(got[i].near_next - near(own, following)) < 1e-12
    assert got[7].fingerprint == got[8].fingerprint != got[10].fingerprint
    assert fingerprints.fingerprints(plain.limit(0)).count() == 0


def test_fingerprints_peel_to_the_digests_that_differ(spark):
    rng = np.random.default_rng(5)
    rows = []
    for shared, a, b in [(0, 0, 0), (0, 1, 0), (3, 0, 0), (500, 1, 2), (40, 40, 40), (0, 300, 4), (0, 2000, 2000)]:
        k = [int(v) for v in np.unique(rng.integers(0, 1 << 48, 2 * (shared + a + b)))][: shared + a + b]
        k = [int(v) for v in rng.permutation(k)]
        rows.append((k[: shared + a], k[:shared] + k[shared + a :]))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    for r in df.select("a", "b", fingerprints.differing(F.col("a"), F.col("b")).alias("d")).collect():
        assert sorted(r.d) == sorted(set(r.a) ^ set(r.b))


def test_fingerprints_of_long_texts_take_time_in_proportion(spark):
    texts = ["\n".join(f"{j} line {i} of many" for i in range(40_000)) for j in range(2)]
    rows = [(i, t) for i, t in enumerate(texts)]
    began = time.time()
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(listed(got[0].fingerprint)) == 40_000 and got[0].near_next == 0.0
    assert time.time() - began < 90


def test_fingerprints_next_document_of_any_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "STRETCH", 3)
    ids = [*range(0, 40, 3), 10**15, -(10**12), None, None, 7, 7]
    rows = [(i, f"t{j}") for j, i in enumerate(ids)]
    pairs = {(r.text, r.next_text) for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    follow = dict(pairs)
    at, seen = "t14", []
    for _ in rows:
        seen.append(at)
        at = follow[at]
    order = [ids[int(t[1:])] for t in seen]
    assert at == "t14" and len(set(seen)) == len(rows) == len(pairs)
    assert order == sorted((i for i in ids if i is not None), reverse=True) + [None, None]


def test_language_ranks(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the hat then", "aa"), ("ñandú ñoño años", "bb")] * 40)]
    rows += [(100, None, None), (101, "123 !", "aa"), (102, "then the hat", None), (103, "ñoños", " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.train(docs)).collect()}
    assert (got[100].lang_pred, got[101].lang_pred, got[100].score) == ("und", "und", 0.0)
    assert (got[102].lang_pred, got[103].lang_pred) == ("aa", "bb")
    assert got[5].held_out == (zlib.crc32(b"5") % 4 == 2)
    none = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def test_language_beyond_the_first_planes(spark):
    scripts = {"ff": 0x1E922, "ccp": 0x11107, "zh": 0x20000}
    text = {n: " ".join("".join(chr(c + (i * j) % 20) for j in range(4)) for i in range(8)) for n, c in scripts.items()}
    rows = [(3 * i + j, text[n], n) for i in range(20) for j, n in enumerate(scripts)] + [(100 + j, text[n], None) for j, n in enumerate(scripts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.train(docs)).collect()}
    assert [got[100 + j].lang_pred for j in range(3)] == list(scripts) and all(r.score > 0 for r in got.values())


def test_language_learns_every_label(spark):
    rows = [(i, chr(0x4E00 + i // 12) * 3, f"l{i // 12:03}") for i in range(520 * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs, language.train(docs))
    assert got.where("lang_pred <> lang").count() == 0


def test_language_distance_is_out_of_place():
    rng = np.random.default_rng(6)
    texts = {f"l{i}": prose(i, 80) + " " + "".join(map(chr, rng.integers(97, 123, 40))) for i in range(5)}
    profiles = {n: language.ranked(*language.grams(t), 50) for n, t in texts.items()}
    made = language.Profiles.of(profiles, 50)
    for t in [*texts.values(), prose(77, 30), "zzz", "ñ"]:
        top = language.ranked(*language.grams(t), 50).tolist()
        places = {n: {c: r for r, c in enumerate(p.tolist())} for n, p in profiles.items()}
        distance = {n: sum(abs(p[c] - i) if c in p else 50 for i, c in enumerate(top)) for n, p in places.items()}
        best = min(sorted(distance), key=distance.get)
        assert made.predict(t) == (best, 1 - distance[best] / (50 * len(top)))


def classifier_rows(spark):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(i, 60)
        rows.append((i, text.upper() + " !!" if bad else text, prose(i, 40) + (" nasty rotten" if bad else "")))
        labels.append((i, int(not bad), int(bad)))
    rows += [(900, None, None), (901, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string")
    return docs, spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"), rng


@pytest.mark.parametrize(("module", "label", "column"), [(quality, "quality", "text"), (toxicity, "toxic", "other")])
def test_classifiers_learn_and_hold_out(spark, module, label, column):
    docs, labels, _ = classifier_rows(spark)
    docs = docs.select("doc_id", F.col(column).alias("text"), F.lit(3).alias("Score"))
    got = module.classify(docs, module.train(docs, labels)).toPandas()
    assert len(got) == 402 and got["score"].between(0, 1).all()
    truth = labels.dropna().toPandas().set_index("doc_id")[label]
    held = got[got.held_out & got.doc_id.isin(truth.index)]
    assert (held.predicted.to_numpy() == truth.loc[held.doc_id].to_numpy()).mean() > 0.95
    blank = module.classify(docs, module.train(docs, labels.limit(0)))
    assert blank.select("score").distinct().count() == 1


def test_pairs_of_neutral_terms_decide():
    """Either term alone says nothing; a sum of weights can't tell, the vectors can."""
    rng = np.random.default_rng(0)
    a, b = np.arange(1500) % 2 == 1, np.arange(1500) // 2 % 2 == 1
    docs = [np.unique(np.r_[rng.choice(500, 20, replace=False) + 10, [1] * int(x), [2] * int(y)]).astype(np.int32) for x, y in zip(a, b, strict=True)]
    y = (a ^ b).astype(float)
    assert not {1, 2} & set(toxicity.informative(docs, y)) and {1, 2} <= set(toxicity.interacting(docs, y))
    model = toxicity.fit(docs[:1000], y[:1000])
    feature = model.place[np.concatenate(docs[1000:])]
    doc = np.repeat(np.arange(500), [len(d) for d in docs[1000:]])[feature >= 0]
    right = lambda m: ((m.logits(doc, feature[feature >= 0], 500) > 0) == y[1000:]).mean()
    whole = right(model)
    model.vector = model.vector * 0
    assert whole > 0.98 and right(model) < 0.8


def test_quality_scores_match_sums_of_bins():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # decided by a pair
    model = quality.fit(x[:400], y[:400])
    for row, score in zip(x, model.score(x), strict=True):
        z = model.prior + sum(t[sum(e <= v for e in edges)] for v, edges, t in zip(row, model.edges, model.tables, strict=True))
        z += sum(t[sum(e <= row[a] for e in model.coarse[a]), sum(e <= row[b] for e in model.coarse[b])] for a, b, t in model.pairs)
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9
    assert ((model.score(x[400:]) >= 0.5) == y[400:]).mean() > 0.9
    model.pairs = []
    assert ((model.score(x[400:]) >= 0.5) == y[400:]).mean() < 0.8


def test_quality_trees_take_the_best_cut():
    rng = np.random.default_rng(5)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.random(9) + 3
        gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 2.0)  # noqa: E731, B023
        first = max(range(1, 9), key=lambda c: gain(0, c) + gain(c, 9))
        ends = [0, first, 9]
        for low, high in ((0, first), (first, 9)):
            if high - low > 1:
                best = max(range(low + 1, high), key=lambda c: gain(low, c) + gain(c, high))
                if gain(low, best) + gain(best, high) > gain(low, high) + 1e-9:
                    ends.append(best)
        ends.sort()
        want = np.concatenate([np.full(b - a, g[a:b].sum() / (h[a:b].sum() + 2.0)) for a, b in zip(ends, ends[1:], strict=False)])
        assert np.allclose(quality._tree(g, h, 2.0, 0.0), want)


def test_toxicity_scores_match_sums_over_pairs():
    docs = [prose(i, 30) + (" nasty rotten" if i % 3 == 0 else " nasty" if i % 3 == 1 else " rotten") for i in range(120)]
    y = np.array([float(i % 3 == 0) for i in range(120)])
    doc, b = toxicity.buckets(docs)
    model = toxicity.fit([b[doc == i].astype(np.int32) for i in range(120)], y)
    assert len(model.weight) > 1
    for text, score in zip(docs, model.score(docs), strict=True):
        own = {toxicity.bucket(t) for token in text.split() for t in toxicity.terms(token)}
        own = [int(model.place[k]) for k in own if model.place[k] >= 0]
        z = model.bias + sum(model.weight[i] for i in own) + sum(model.vector[i] @ model.vector[j] for i, j in combinations(own, 2))
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9


def test_a_repeated_id_is_one_labelled_row(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (3, "c"), (None, "d")] + [(6, "e")] * 50, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in (1, 3, 6)] + [(None, 1)], "doc_id long, y int")
    kept = {i for i in (1, 3, 6) if zlib.crc32(str(i).encode()) % 3 != 1}
    got = labelled.sample(docs, marks, "y", 10).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((i, {1: "a", 3: "c", 6: "e"}[i]) for i in kept)


def test_scores_of_blank_and_repeated_texts(spark):
    docs, labels, _ = classifier_rows(spark)
    for module, column in ((quality, "text"), (toxicity, "other")):
        model = module.train(docs.select("doc_id", F.col(column).alias("text")), labels)
        rows = [(1, None), (2, ""), (None, "nasty rotten"), (4, "nasty rotten"), (4, "nasty rotten"), (5, "x " * 300_000)]
        got = module.classify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
        score = [r.score for r in got]
        assert len(got) == 6 and score[0] == score[1] and len(set(score[2:5])) == 1 and all(0 <= x <= 1 for x in score)
        assert module.classify(docs.limit(0), model).count() == 0
        if module is toxicity:
            assert abs(score[0] - 1 / (1 + np.exp(-model.bias))) < 1e-12 and score[2] > 0.7


def test_leaks_and_slots(spark):
    bench = spark.createDataFrame(
        [(1, "Tom buys 3 apples and gives Ann 3 pears on the 5 km road to Rome today"), (2, "short one"), (3, None)], "item_id long, text string"
    )
    docs = spark.createDataFrame(
        [
            (1, "Well. Tom buys 3 apples and gives Ann 3 pears on the 5 km road to Rome today. Yes."),
            (2, "Bob buys 7 apples and gives Eve 7 pears on the 9 miles road to Bern today"),
            (3, "Bob buys 7 apples and gives Eve 8 pears on the 9 miles road to Bern today"),  # 3 stands for two values
            (4, prose(9, 50)), (5, None), (6, ""), (None, "Tom buys 3 apples and gives Ann 3 pears on the 5 km road to Rome today"),
        ],
        "doc_id long, text string",
    )
    got = decontaminate.leaks(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 1)]
    assert decontaminate.leaks(docs, bench.limit(0)).count() == decontaminate.leaks(docs.limit(0), bench).count() == 0


def template_windows(text):
    """(pos, form, template, slots) of every window of five tokens, by the rules in words."""
    tokens, start = [], True
    for line in text.split("\n"):
        for raw in line.split():
            core = raw.strip(decontaminate._EDGE)
            if core:
                tokens.append((core, start))
            start = raw.rstrip("\"')]}*#&|_~`").endswith((".", "!", "?"))
        start = True
    kinds = []
    for i, (core, start) in enumerate(tokens):
        number = re.fullmatch(r"[+\-$€£]?\d[\d.,:/]*(?:%|[a-z]{1,3})?", core.lower()) is not None
        unit = not number and core.lower() in decontaminate.UNITS and i > 0 and kinds[i - 1] == "number"
        kinds.append("number" if number else "unit" if unit else "name" if core[0].isupper() and not start else "word")
    for i in range(len(tokens) - 4):
        part = list(zip((t for t, _ in tokens[i : i + 5]), kinds[i : i + 5], strict=True))
        names = any(k == "name" for _, k in part)
        for form, held in (("folded" if names else "plain", {"number", "unit"}), *([("named", {"number", "unit", "name"})] if names else [])):
            if any(k not in held for _, k in part):
                yield i, form, tuple((k,) if k in held else t.lower() for t, k in part), [t for t, k in part if k in held]


def brute_leaks(docs, items):
    found = {}
    for (d, text), (item, question) in ((a, b) for a in docs for b in items):
        ours, theirs, lines = list(template_windows(text)), list(template_windows(question)), {}
        for pos, form, template, slots in ours:
            for place, other, same, values in theirs:
                if template == same:
                    both = form == other == "plain"
                    for f in ("named", "folded") if both else ("named",) if form == "named" else ("folded",):
                        lines.setdefault((f, pos - place), []).append((place, list(zip(values, slots, strict=True))))
        covered, long = set(), False
        for (form, _), line in lines.items():
            pairs = {(a.lower(), b.lower()) if form == "folded" else (a, b) for _, p in line for a, b in p}
            verbatim = {place for place, p in line if all(a.lower() == b.lower() for a, b in p)}
            run = any(all(place + k in verbatim for k in range(9)) for place in verbatim)
            long |= run
            if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                covered |= {place for place, _ in line}
            elif run:
                covered |= verbatim
        n = len({place for place, *_ in theirs})
        if n and (long or len(covered) / n >= 0.8):
            found[d, item] = len(covered) / n
    return found


def test_leaks_match_brute_force(spark):
    rng = np.random.default_rng(12)
    names, units = ["Tom", "Ann", "Bob", "Eve", "Rome"], ["km", "kg", "hours"]

    def question(seed):
        words = prose(seed, 24).split()
        for k in rng.choice(24, 7, replace=False).tolist():
            words[k] = [str(rng.integers(2, 6)), str(rng.integers(2, 6)) + " " + rng.choice(units), rng.choice(names)][k % 3]
        return " ".join(words)

    items = [(i, question(i)) for i in range(12)]
    docs = []
    for i in range(150):
        words = items[i % 12][1].split()
        change = dict(zip("23456", rng.permutation(list("56789")), strict=True)) | dict(zip(names, rng.permutation(names), strict=True))
        kind = i % 6
        if kind in (0, 1, 2):
            words = [change.get(w.rstrip("."), w.rstrip(".")) + w[len(w.rstrip(".")) :] for w in words]
        for k in rng.choice(len(words), [0, 1, 2, 0, 1, 3][kind], replace=False).tolist():
            words[k] = str(rng.choice(["7", "stone", "Eve", "km"]))
        text = " ".join(words)
        docs.append((i, f"{prose(i + 99, 15)}\n{[text, text.upper(), text.lower()][i % 7 % 3]} {prose(i, 9)}"))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got, want = {(r.doc_id, r.item_id): r.coverage for r in got.collect()}, brute_leaks(docs, items)
    assert got == want and 30 < len(want) < 150


def test_leaks_whatever_the_case(spark):
    text = "Tom buys 3 apples and gives Ann 3 pears on the 5 km road to Rome and Straßburg today"
    bench = spark.createDataFrame([(1, text), (2, text.upper())], "item_id long, text string")
    low = text.lower()
    docs = spark.createDataFrame(
        [
            (1, f"WELL THEN. {text.upper()}. YES."), (2, f"well then. {low}. yes."), (3, text.title()), (4, text),
            (5, low.replace("ann 3", "ann 4").upper()),  # 3 stands for two values
            (6, prose(9, 50).upper()),
        ],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.coverage for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(d, i): 1.0 for d in (1, 2, 3, 4) for i in (1, 2)}


def test_leaks_by_a_long_run(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    words[30], words[50] = "7", "7"
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    other = prose(5, 30).replace(".", "").lower()
    docs = spark.createDataFrame(
        [
            (1, " ".join([other, *words[:45], other])), (2, " ".join([other, *words[20:33], other]).upper()),
            (3, " ".join([other, *words[20:32], other])), (4, " ".join([other, *words[20:30], "8", *words[31:35], other])),
            (5, " ".join([*words[:50], "9", *words[51:]])),  # 7 stands for two values
        ],
        "doc_id long, text string",
    )
    got = {r.doc_id: round(r.coverage * 55) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {1: 41, 2: 9, 5: 50}


def test_shards_are_exact_and_repeatable(spark):
    # a third of all rows have no id and are equal in every column
    docs = spark.range(1003).select(F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("doc_id"), F.lit("x").alias("text"), F.lit(1).alias("Slot")).repartition(5)
    run = lambda rows: shards.shuffle_into(docs, 16, rows=rows).toPandas()
    got = run(20)
    assert list(got.columns) == ["doc_id", "text", "shard", "slot"]
    sizes = got.groupby("shard")["slot"].agg(["min", "max", "count", "nunique"])
    assert len(got) == 1003 and len(sizes) == 16 and set(sizes["count"]) == {62, 63}
    assert (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    key = ["shard", "slot"]
    assert got.sort_values(key)["doc_id"].fillna(-1).tolist() == run(20).sort_values(key)["doc_id"].fillna(-1).tolist()
    null = got[got.doc_id.isna()].groupby("shard").size()  # equal rows are spread like others
    assert len(null) == 16 and null.max() < 40
    few = shards.shuffle_into(docs.limit(3), 16).toPandas()
    assert few["shard"].tolist() and set(few["shard"]) == {0, 1, 2} and set(few["slot"]) == {0}
    assert shards.shuffle_into(docs.limit(0), 16).count() == 0


def test_every_order_is_as_likely(spark):
    """Four rows of two partitions, dealt with many seeds: each row is at each place a quarter of the time."""
    docs = spark.createDataFrame([(i,) for i in range(4)], "doc_id long").repartition(2).persist()
    seen = np.zeros((4, 4))
    for seed in range(60):
        for r in shards.shuffle_into(docs, 2, seed=seed).collect():
            seen[r.doc_id, 2 * r.shard + r.slot] += 1
    assert (seen.sum(axis=0) == 60).all() and abs(seen - 15).max() < 14


def test_matrix_margins_and_law():
    parts, cells = np.array([5, 0, 17, 8]), np.array([10, 10, 10])
    until = np.concatenate([[0], np.cumsum(parts)])
    whole = lambda s: np.array([shards.line(until, p, cells, s) for p in range(4)])
    m = whole(3)
    assert (m.sum(axis=1) == parts).all() and (m.sum(axis=0) == cells).all()
    assert abs(np.mean([whole(s)[2, 0] for s in range(400)]) - 17 / 3) < 0.3
    rng = np.random.default_rng(4)
    for good, bad, need in ((7, 5, 6), (300, 4000, 900), (1, 3, 2), (0, 9, 4), (9, 0, 4)):
        got = np.array([shards.hypergeometric(rng, good, bad, need) for _ in range(4000)])
        want = np.random.default_rng(5).hypergeometric(good, bad, need, 4000)
        assert abs(got.mean() - want.mean()) < 0.6 and abs(got.std() - want.std()) < 0.5
    # beyond numpy's range: the mean and spread of the law itself
    good, bad, need = 3 * 10**9, 47 * 10**9, 10**6
    got = np.array([shards.hypergeometric(rng, good, bad, need) for _ in range(500)])
    assert abs(got.mean() - need * 0.06) < 40 and abs(got.std() - np.sqrt(need * 0.06 * 0.94)) < 25


@pytest.mark.parametrize("sent", [urlfilter.SENT, 0])
def test_url_lists(spark, monkeypatch, sent):
    monkeypatch.setattr(urlfilter, "SENT", sent)  # 0: the list is shuffled
    entries = spark.createDataFrame(
        [
            ("domain", "bad.org", "block", "2024-01-10", "add", 0), ("domain", "bad.org", "block", "2024-02-01", "remove", 1),
            ("prefix", "x.bad.org/ok", "allow", "2024-01-15", "add", 2), ("host", "y.org", "block", "2024-01-01", "add", 3),
            ("host", "y.org", "block", "2024-01-01", "remove", 4), (None, "z", "block", "2024-01-01", "add", 5),
        ],
        "kind string, value string, action string, day string, change string, seq int",
    )
    pages = spark.createDataFrame(
        [
            (1, "http://X.bad.org:80/OK/a?q", "2024-01-20"), (2, "http://x.bad.org/okay", "2024-01-20"), (3, "http://bad.org", "2024-02-01"),
            (4, "http://u@bad.org/", "2024-01-10"), (5, None, "2024-01-20"), (6, "nonsense", "2024-01-20"), (7, "http://y.org/", "2024-03-01"),
            (8, "http://bad.org/", None), (4, "http://u@bad.org/", "2024-01-10"), (9, "http://notbad.org/", "2024-01-20"),
        ],
        "page_id long, url string, fetched string",
    )
    got = urlfilter.evaluate(pages, entries).collect()
    assert len(got) == 10 and sum(r.page_id == 4 for r in got) == 2
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict == {1: "allow", 2: "block", 3: "none", 4: "block", 5: "none", 6: "none", 7: "none", 8: "none", 9: "none"}
    assert urlfilter.evaluate(pages.limit(0), entries.limit(0)).count() == 0


def test_digests(docs):
    row = bpe.digests(bpe.encode_decode(docs.where("doc_id = 3"), RANKS, P.PATTERN)).first()
    assert row.decoded_sha256 == hashlib.sha256(b"one").hexdigest()
